"""Offence counts of many rules in one pass per table (AGG-14, DQ-1..7)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Reference:
    """A column that must hold keys of another table."""

    table: str
    column: str
    parent: str
    nullable: bool = False


@dataclass(frozen=True)
class RowRule:
    """A condition no row of a table may meet; NULL does not meet it."""

    table: str
    column: str
    rule: str
    offends: Callable[[], Column]


def census(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, str],
    references: Sequence[Reference] = (),
    row_rules: Sequence[RowRule] = (),
) -> DataFrame:
    """Offences per rule: (table_name, column_name, rule, offending).

    ``offending`` is the number of surplus rows for a unique key, of child rows for a
    reference and of rows for a row rule.

    All rules share one scan per table and one shuffle. A table sends the values of its key
    and references, tagged with the table that owns the key, and a mark for each row rule a
    row breaks. Counting per (owner, value) then shows repeated keys and references without
    an owner. The counts combine before the shuffle, so no value is hot, and grouping
    treats NULL as a value. Keys are bigint, as in all source tables.
    """
    # An owner's slot 0 is its own key, its next slots are the references to it. A row rule
    # is an owner of its own, whose marks are counted in slot 0.
    slots = [
        [(owner, column, "unique", False)]
        + [(r.table, r.column, f"references {owner}", r.nullable) for r in references if r.parent == owner]
        for owner, column in keys.items()
    ]
    counts = [f"n{slot}" for slot in range(max(map(len, slots), default=1))]

    def entry(owner: int, slot: int, value: Column) -> Column:
        return F.struct(F.lit(owner).alias("owner"), F.lit(slot).alias("slot"), value.alias("value"))

    def sent_by(table: str) -> DataFrame:
        entries = []
        for owner, own in enumerate(slots):
            for slot, (source, column, _, nullable) in enumerate(own):
                if source == table:
                    value = entry(owner, slot, F.col(column).cast("bigint"))
                    entries.append(F.when(F.col(column).isNotNull(), value) if nullable else value)
        for number, rule in enumerate(row_rules, start=len(slots)):
            if rule.table == table:
                entries.append(F.when(rule.offends(), entry(number, 0, F.lit(None).cast("bigint"))))
        return tables[table].select(F.inline(F.array(*entries)))

    used = [source for own in slots for source, *_ in own] + [r.table for r in row_rules]
    sent = reduce(DataFrame.unionAll, (sent_by(table) for table in dict.fromkeys(used)))
    per_value = (
        sent.where(F.col("owner").isNotNull())
        .groupBy("owner", "value")
        .agg(*(F.count_if(F.col("slot") == slot).alias(n) for slot, n in enumerate(counts)))
    )
    surplus = F.when(F.col("owner") < len(slots), F.col("n0") - 1).otherwise(F.col("n0"))
    found = [F.when(F.col("n0") > 0, surplus)] + [F.when(F.col("n0") == 0, F.col(n)) for n in counts[1:]]
    per_owner = per_value.groupBy("owner").agg(*(F.sum(f).alias(n) for f, n in zip(found, counts)))

    # One row for all rules, so that a rule without any entry is reported with 0 offences.
    rules = [
        (owner, counts[slot], source, column, rule)
        for owner, own in enumerate(slots)
        for slot, (source, column, rule, _) in enumerate(own)
    ]
    rules += [(n, "n0", r.table, r.column, r.rule) for n, r in enumerate(row_rules, start=len(slots))]
    flat = per_owner.agg(
        *(
            F.coalesce(F.sum(F.when(F.col("owner") == owner, F.col(n))), F.lit(0)).alias(f"r{i}")
            for i, (owner, n, *_) in enumerate(rules)
        )
    )
    lines = (
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(rule).alias("rule"),
            F.col(f"r{i}").alias("offending"),
        )
        for i, (_, _, table, column, rule) in enumerate(rules)
    )
    return flat.select(F.inline(F.array(*lines)))
