import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from stellate.sources.landing import read_landing, read_sources, unknown_fields, write_lines
from stellate.sources.schemas import SCHEMAS
from tests.support import CLEAN, frame, rows, ts

FAILURE = (PySparkException, Py4JJavaError)
GOOD = '{"club_id":1,"name":"A","city":"B","country":"no","created_at":"2024-01-02T03:04:05Z"}'
CASES = {
    "bad number": '{"club_id":"one","name":"A"}',
    "bad time": '{"club_id":1,"created_at":"yesterday"}',
    "broken line": '{"club_id":1,',
}


@pytest.fixture
def lines(tmp_path):
    def write(*texts):
        path = tmp_path / "clubs.ndjson"
        path.write_text("\n".join(texts) + "\n")
        return str(path)

    return write


@pytest.mark.parametrize("strict", [False, True])
def test_typed_read(spark, lines, strict):
    path = lines(GOOD, "", '{"club_id":2,"name":null}')
    got = rows(read_landing(spark, path, SCHEMAS["clubs"], reject_unknown=strict))
    assert got[0]["created_at"].replace(tzinfo=dt.timezone.utc) == ts("2024-01-02T03:04:05")
    assert got[1] == dict(club_id=2, name=None, city=None, country=None, created_at=None)
    assert len(got) == 2


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("case", CASES)
def test_a_bad_row_fails_the_read(spark, lines, case, strict):
    with pytest.raises(FAILURE):
        read_landing(spark, lines(GOOD, CASES[case]), SCHEMAS["clubs"], reject_unknown=strict).collect()


def test_unknown_fields(spark, lines):
    path = lines(GOOD, '{"club_id":2,"extra":1,"more":[2]}', '{"club_id":3,"extra":{"x":null}}')
    found = unknown_fields(spark, path, SCHEMAS["clubs"]).collect()
    assert {r.field: r.row_count for r in found} == {"extra": 2, "more": 1}
    assert read_landing(spark, path, SCHEMAS["clubs"]).count() == 3
    with pytest.raises(FAILURE, match="fields outside the schema: extra"):
        read_landing(spark, path, SCHEMAS["clubs"], reject_unknown=True).collect()
    assert unknown_fields(spark, lines(GOOD), SCHEMAS["clubs"]).collect() == []


def test_export_and_read_of_all_tables(spark, tmp_path):
    for table, data in CLEAN.items():
        write_lines(frame(spark, table, data), str(tmp_path / f"{table}.ndjson"))
    for strict in (False, True):
        read = read_sources(spark, str(tmp_path), reject_unknown=strict)
        for table, data in CLEAN.items():
            assert rows(read[table]) == rows(frame(spark, table, data))
            assert read[table].dtypes == frame(spark, table, data).dtypes
