import pytest

from stellate.session import local_session, prepare


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        4,
        "tests",
        **{
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.maxMetadataStringLength": "10000",  # whole filters in plan texts
        },
    )
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_left_behind(spark):
    """Temporary views of one module would be listed, and an unset count of partitions would hold, in the next."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    yield
    spark.conf.set(key, before)
    for table in spark.catalog.listTables():
        if table.isTemporary:
            spark.catalog.dropTempView(table.name)
