"""JSON-lines landing reads (SRC-1, SRC-2, SRC-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stellate.sources.schemas import SCHEMAS


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, reject_unknown: bool = True
) -> DataFrame:
    """One table of JSON lines under its declared schema; a row that does not fit fails the read.

    A missing field reads as NULL. A row with a field outside the schema fails the read too, in
    the same pass, unless ``reject_unknown`` is off: then such fields are ignored.
    """
    if not reject_unknown:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    lines = spark.read.text(path).where(F.btrim("value") != "")
    extra = _extra_fields(schema)
    parsed = F.from_json("value", schema, {"mode": "FAILFAST"})
    message = F.concat(F.lit("fields outside the schema: "), F.array_join(extra, ", "))
    checked = F.when(F.size(extra) > 0, F.raise_error(message)).otherwise(parsed)
    return lines.select(checked.alias("row")).select("row.*")


def unknown_fields(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Fields present in the lines but not in the schema, with the number of rows: (field, row_count)."""
    lines = spark.read.text(path)
    return (
        lines.select(F.explode(_extra_fields(schema)).alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def write_lines(df: DataFrame, path: str) -> None:
    """Export rows as JSON lines that ``read_landing`` reads back unchanged; NULL fields are left out."""
    df.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def read_sources(spark: SparkSession, root: str, reject_unknown: bool = True) -> dict[str, DataFrame]:
    """All six tables of an export folder, one ``<table>.ndjson`` file or folder each."""
    return {
        table: read_landing(spark, f"{root}/{table}.ndjson", schema, reject_unknown)
        for table, schema in SCHEMAS.items()
    }


def _extra_fields(schema: T.StructType):
    declared = F.array(*(F.lit(name) for name in schema.names))
    return F.array_except(F.json_object_keys("value"), declared)
