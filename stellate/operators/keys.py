"""References checked by an anti join (JN-7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str, nullable: bool = False) -> DataFrame:
    """Child rows whose bigint reference is missing in the parent.

    NULL is an ordinary value unless ``nullable``: it is found only if the parent holds
    a NULL key. The parent is reduced to distinct keys before the join, so replayed parent
    rows cannot pile up on one task. The join shuffles these keys once more, on ``<=>``:
    as no aggregate then lies between its shuffles and the join, adaptive execution splits
    a hot child key.
    """
    known = parent.select(F.col(key).alias("_known")).distinct()
    rows = child.where(F.col(column).isNotNull()) if nullable else child
    return rows.join(known, F.col(column).eqNullSafe(F.col("_known")), "left_anti")
