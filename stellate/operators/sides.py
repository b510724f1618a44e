"""Join sides that are broadcast by the size of their rows, not of their files (JN-1, JN-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

# What Spark holds of a row before its texts: a word for the nulls and one for each column.
_WORD = 8


def row_bytes(df: DataFrame) -> int:
    """The bytes of all rows in memory; they are added up where they lie, and one number reaches the driver."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    one = sum(texts, F.lit(_WORD * (1 + len(df.columns)))).cast("bigint")
    return df.agg(F.coalesce(F.sum(one), F.lit(0))).first()[0]


def broadcast_by_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` as the smaller side of a join that reads ``columns`` of it: sorted and merged if their rows are over the session's broadcast threshold.

    Spark takes the bytes of scanned files for those of their rows, which are up to a hundred times as many
    where the files compress well, and a broadcast passes through the driver as a whole. Under the threshold
    the choice is Spark's own. Meant for written tables, as ``df`` is read once more.
    """
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if threshold < 0 or row_bytes(df.select(*columns)) <= threshold:
        return df
    return df.hint("shuffle_merge")
