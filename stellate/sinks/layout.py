"""Layout of partitioned and clustered files (SNK-3, SNK-4)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of each key in an interleaved order: 2**BITS ranges of equally many rows.
BITS = 4


def clustered(
    df: DataFrame,
    partition_by: str,
    cluster_by: Sequence[str],
    grain: Sequence[str] = (),
    interleave: bool = False,
) -> DataFrame:
    """Rows laid out for a partitioned write whose files cover narrow ranges of the cluster keys.

    Tasks receive contiguous ranges of (partition, cluster keys, grain): a task writes few
    partitions, so files stay few, and a partition or key with a large share of the rows
    is spread over several tasks, because the grain columns tell its rows apart. Within a
    task the sort matches the partitioned writer's own, so nothing is sorted twice.

    Rows sorted by several keys are narrow in the first only. With ``interleave`` they lie along a
    Z-curve over all (numeric, date or time) keys, so that a filter on any one key skips row groups; one
    more job takes the keys' quantiles.
    """
    keys = [partition_by, *cluster_by]
    if interleave:
        df = df.withColumn("__z", z_order(df, cluster_by))
        keys = [partition_by, "__z", *cluster_by]
    spread = [*keys, *(c for c in grain if c not in keys)]
    laid_out = df.repartitionByRange(*spread).sortWithinPartitions(*keys)
    return laid_out.drop("__z") if interleave else laid_out


def z_order(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The bits of each column's range, the first column's highest bit first; nulls lie in the lowest range.

    A column's ranges hold equally many rows by approximate quantiles of all of them; equal cuts of a
    hot value are one.
    """
    ranges = 2**bits
    shares = [k / ranges for k in range(1, ranges)]
    found = df.agg(*(F.percentile_approx(c, shares).alias(c) for c in columns)).first()
    z = F.lit(0).cast("bigint")
    for c in columns:
        cuts = sorted(set(found[c] or ()))
        place = reduce(lambda a, cut: a + F.coalesce((F.col(c) >= F.lit(cut)).cast("int"), F.lit(0)), cuts, F.lit(0))
        for b in range(bits):
            bit = F.shiftright(place, b).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - list(columns).index(c)))
    return z
