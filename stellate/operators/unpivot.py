"""Columns to rows in a single scan (SET-1, SET-2, PRJ-3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def unpivot_slots(df: DataFrame, slots: Mapping[str, int], value: str, group: str) -> DataFrame:
    """One row per input row and slot column.

    ``slots`` maps a column to its constant group number; the slot columns are replaced
    by ``value`` (the slot's content, NULL kept) and ``group``. The input is scanned
    once, where a UNION ALL of one select per slot would scan it once per slot.
    """
    pairs = F.array(
        *(
            F.struct(F.col(column).alias(value), F.lit(number).cast("bigint").alias(group))
            for column, number in slots.items()
        )
    )
    kept = [c for c in df.columns if c not in slots]
    return df.select(*kept, F.inline(pairs))
