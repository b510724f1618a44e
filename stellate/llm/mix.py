"""Mixing sources to target weights: a min-cost flow over membership patterns, then seeded documents."""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Mapping, Sequence
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stellate.llm.shared import WORD, row_key, stored

#: Cost of a word the first time, the second time, ...: convex, so nothing is repeated early.
EPOCH_COSTS = (1, 3)
SEED = 7
WEIGHTS = (3, 1, 2)
SHARE, MOST = Fraction(3, 2), 2
LEAST_BUCKET = 256


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """source, source_size and target: weighted shares of SHARE of all words, none above MOST times
    its source; the rest is reshared.

    `sizes` has one row for each source. Sources take the weights in turn, by code point, null last.
    They stay a table, however many there are: their turns come from a range partitioning, and the
    driver holds only the common level, an exact fraction that rises from round to round.
    """
    first_to_last = F.asc_nulls_last("source")
    ranged = stored(sizes.select("source", "source_size").orderBy(first_to_last).withColumn("part", F.spark_partition_id()), "sources")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start"))
    place = F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy(first_to_last)) - 1
    turns = stored(ranged.join(starts, "part").select("source", "source_size", (place % len(weights)).cast("int").alias("turn")), "turns")
    weight = F.get(F.array(*map(F.lit, weights)), F.col("turn"))
    total, open_weight = turns.agg(F.sum("source_size"), F.sum(weight)).first()
    level = SHARE * total / open_weight if open_weight else Fraction(0)
    while True:
        limit = F.col("source_size").cast("decimal(20,0)") * F.lit(Decimal(MOST * level.denominator))
        full = limit < weight.cast("decimal(4,0)") * F.lit(Decimal(level.numerator))
        held, open_weight = turns.agg(F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, weight))).first()
        higher = (SHARE * total - MOST * (held or 0)) / open_weight if open_weight else level
        if higher == level:
            break
        level = higher
    shared = F.get(F.array(*(F.lit(float(level * w)) for w in weights)), F.col("turn"))
    return turns.select("source", "source_size", F.when(full, (MOST * F.col("source_size")).cast("double")).otherwise(shared).alias("target"))


def flow(capacity: Mapping[str, int], members: Mapping[str, Sequence[str | None]], quotas: Mapping[str | None, int]) -> dict[tuple[str, str | None], int]:
    """Words of each pattern routed to each of its sources: as much of the quotas as can be met, at
    the least cost of repetition. Cheapest augmenting paths, whole words."""
    arcs: list[list] = []  # to, room, cost; an arc's reverse is its neighbour
    out: dict[object, list[int]] = defaultdict(list)

    def connect(a: object, b: object, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            out[x].append(len(arcs))
            arcs.append([y, r, c])
        return len(arcs) - 2

    routes = {}
    for p in sorted(capacity):
        for cost in EPOCH_COSTS:
            connect("start", ("pattern", p), capacity[p], cost)
        for s in members[p]:
            routes[p, s] = connect(("pattern", p), ("source", s), len(EPOCH_COSTS) * capacity[p], 0)
    for s in sorted(quotas, key=lambda s: (s is None, s or "")):
        connect(("source", s), "end", quotas[s], 0)
    while True:
        cost, via, queue, waiting = {"start": 0}, {}, deque(["start"]), {"start"}
        while queue:
            a = queue.popleft()
            waiting.discard(a)
            for k in out[a]:
                b, room, c = arcs[k]
                if room and cost[a] + c < cost.get(b, float("inf")):
                    cost[b], via[b] = cost[a] + c, k
                    if b not in waiting:
                        waiting.add(b)
                        queue.append(b)
        if "end" not in via:
            break
        path, at = [], "end"
        while at != "start":
            path.append(via[at])
            at = arcs[via[at] ^ 1][0]
        amount = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= amount
            arcs[k ^ 1][1] += amount
    return {route: arcs[k ^ 1][1] for route, k in routes.items() if arcs[k ^ 1][1]}


def routes(patterns: DataFrame, quotas: DataFrame) -> DataFrame:
    """`patterns` (pattern, words, docs) with `ends`: the words of a pattern, all epochs in turn, go to
    `source` up to the word `end`, then to the next one.

    The flow falls apart where nothing overlaps: a source that no pattern shares with another one gets
    what its own pattern holds, a row of a join, however many such sources there are. Only patterns of several
    sources, and those that share a source with them, reach the driver, where one flow routes them.
    """
    listed = patterns.withColumn("members", F.from_json("pattern", "array<string>"))
    several = listed.where(F.size("members") > 1)
    touched = several.select(F.explode("members").alias("source")).distinct()
    single = listed.where(F.size("members") == 1).withColumn("source", F.get("members", 0))
    goals = quotas.select(F.col("source").alias("named"), "quota")
    meets = F.col("source").eqNullSafe(F.col("named"))
    overlapped = touched.select(F.col("source").alias("named"))
    take = F.least(F.coalesce(F.col("quota"), F.lit(0)), len(EPOCH_COSTS) * F.col("words"))
    ends = F.when(take > 0, F.array(F.struct(take.alias("end"), "source"))).otherwise(F.array())
    kind = "array<struct<end:bigint,source:string>>"
    columns = ("pattern", "words", "docs")
    alone = single.join(overlapped, meets, "left_anti").join(goals, meets, "left").select(*columns, ends.cast(kind).alias("ends"))
    empty = listed.where(F.size("members") == 0).select(*columns, F.array().cast(kind).alias("ends"))

    linked = several.collect()
    if linked:
        linked += single.join(overlapped, meets, "left_semi").drop("source").collect()
    quota = {r["named"]: r["quota"] for r in goals.join(touched, meets, "left_semi").collect()} if linked else {}
    for r in linked:
        quota |= {s: 0 for s in r["members"] if quota.get(s) is None}
    reached = defaultdict(list)
    capacity = {r["pattern"]: r["words"] for r in linked}
    for (p, source), words in sorted(flow(capacity, {r["pattern"]: r["members"] for r in linked}, quota).items(), key=lambda x: (x[0][0], x[0][1] is None, x[0][1] or "")):
        reached[p].append(((reached[p][-1][0] if reached[p] else 0) + words, source))
    solved = [(*(r[c] for c in columns), reached[r["pattern"]]) for r in linked]
    return alone.union(empty).union(patterns.sparkSession.createDataFrame(solved, f"pattern string, words bigint, docs bigint, ends {kind}"))


def mix(docs: DataFrame, quotas: DataFrame, id_column: str, size: str, members: str, seed: int = SEED) -> DataFrame:
    """All columns and `repeats` (times taken), `taken` (words) and `mixed_for` (a source for each time).

    `members` is the array of sources a document belongs to; nulls are a source of that name. `quotas`
    has source and quota, in words; a missing or null quota is 0.
    Documents without a source, of no or unknown size, are not taken. None is taken more often than
    there are EPOCH_COSTS. Documents are whole, so what a source gets is off by a document at
    most. Documents of a pattern are ordered by a seeded hash of the id, then id and size: reruns agree, and
    rows that tie are alike. Input columns of the new names are replaced.

    A document's place in its pattern is a sum over buckets of its hash and a sum within its
    bucket; there are as many buckets as documents in one (square root), so even a pattern with a third of
    all rows is summed in small groups, over narrow rows.
    """
    names = [c for c in docs.columns if c not in ("repeats", "taken", "mixed_for")]
    hashed = [f.name for f in docs.schema if f.name in names and "map<" not in f.dataType.simpleString()]
    # json keeps nulls apart from the string "null" and makes the pattern a plain key
    pattern = F.to_json(F.array_sort(F.array_distinct(F.coalesce(F.col(members), F.array().cast("array<string>")))))
    rows = stored(
        docs.select(
            F.struct(*(F.col(f"`{c}`") for c in names)).alias("doc"), F.col(id_column).alias("id"),
            F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("bigint").alias("n"), pattern.alias("pattern"),
            # rows without an id are told apart by what they hold, or all would fall into one bucket
            F.when(F.col(id_column).isNull(), F.xxhash64(F.lit(seed), *(F.col(f"`{c}`") for c in hashed))).otherwise(F.xxhash64(F.lit(seed), F.col(id_column))).alias("h"),
        ),
        "sizes",
    )
    patterns = stored(rows.groupBy("pattern").agg(F.sum("n").alias("words"), F.count("*").alias("docs")), "patterns")
    buckets = F.greatest(F.lit(1), F.floor(F.col("docs") / F.greatest(F.lit(float(LEAST_BUCKET)), F.sqrt("docs")))).cast("int")
    plans = stored(routes(patterns, quotas).select("pattern", "words", "ends", buckets.alias("buckets")), "plans")
    # one key, so that the partitioning of a join by pattern never serves for a hot pattern's buckets
    cell = F.struct("pattern", F.pmod(F.col("h"), F.col("buckets")).alias("bucket")).alias("cell")
    dealt = rows.join(plans, "pattern").select("*", cell)
    within = Window.partitionBy("cell").orderBy("h", "id", "n").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inner", F.coalesce(F.sum("n").over(within), F.lit(0)))
    sums = dealt.groupBy("cell").agg(F.sum("n").alias("sum"))
    ahead = Window.partitionBy("cell.pattern").orderBy("cell.bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("cell", F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("before"))
    full = placed.join(starts, "cell")

    # the words of a pattern lie on a line, once for each epoch; a document belongs where its middle lies
    def source_at(epoch: int) -> Column:
        middle = 2 * (F.col("before") + F.col("inner") + epoch * F.col("words")) + F.col("n")
        hit = F.get(F.filter("ends", lambda e: 2 * e["end"] > middle), 0)
        return F.when((F.col("n") > 0) & hit.isNotNull(), F.struct(hit["source"].alias("source")))

    times = F.filter(F.array(*(source_at(e) for e in range(len(EPOCH_COSTS)))), lambda x: x.isNotNull())
    result = full.withColumn("times", times)
    return result.select(
        "doc.*",
        F.size("times").alias("repeats"),
        (F.size("times") * F.col("n")).cast("bigint").alias("taken"),
        F.transform("times", lambda t: t["source"]).alias("mixed_for"),
    )


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, `row` (a hash of the text) and more: documents by their one source.

    Every row gives one; null and empty texts have no size and are not taken, a null source is one of its own, null ids are
    told apart by their text, and an empty table gives no rows.
    """
    sized = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), row_key(F.col(text)).alias("row")
    )
    sized = stored(sized, "sized")
    goals = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    quotas = goals.select("source", F.bround("target").cast("bigint").alias("quota"))
    mixed = mix(sized.withColumn("members", F.array("source")), quotas, "doc_id", "size", "members")
    facts = goals.select(F.col("source").alias("__source"), "source_size", "target")
    joined = mixed.join(facts, F.col("source").eqNullSafe(F.col("__source")))
    return joined.select("doc_id", "size", "source_size", "target", "taken", "source", "repeats", "mixed_for", "row")


def op1_mix(spark, sf_dir: str) -> DataFrame:
    return mixed_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
