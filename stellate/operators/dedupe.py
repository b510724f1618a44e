"""Latest row per key (WIN-1, FLT-1, PRJ-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Stands for an unknown time: later in the order than any time Spark can hold.
_NO_TIME = 2**63 - 1


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """Keep one row per key: the one with the greatest timestamp ``newest``, NULL counting as oldest.

    Equal times are settled by every remaining column in turn, smaller first and NULL last,
    so rows still tied are identical and the result does not depend on how the input is split.

    This is row_number() = 1 written as the least row of each group. Both send one row per key
    and task to the shuffle, so a key holding a large share of the rows is not hot there;
    but the window first sorts such a key's rows by every column within each task, and the
    aggregate passes over them once.
    """
    rest = [c for c in df.columns if c not in (*keys, newest)]
    age = F.coalesce(-F.unix_micros(newest), F.lit(_NO_TIME)).alias("_age")
    settled = (part for c in rest for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c)))
    least = df.groupBy(*keys).agg(F.min(F.struct(age, *settled)).alias("_least"))

    least_age = F.col("_least._age")
    time = F.when(least_age != _NO_TIME, F.timestamp_micros(-least_age))
    values = {c: F.col(c) for c in keys} | {c: F.col(f"_least.{c}") for c in rest} | {newest: time}
    return least.select(*(values[c].alias(c) for c in df.columns))
