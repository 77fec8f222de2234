"""Mixing overlapping sources to target weights by min-cost flow."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from tessera.llm.common import cut, stored

BUCKETS = 4096
BROADCAST_PATTERNS = 10_000


def words(text: Column) -> Column:
    """Number of runs without ASCII white space; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_order(names) -> list:
    """By code point, null last."""
    return sorted(names, key=lambda s: (s is None, s or ""))


def capped_targets(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Share `total` by weight; a target stops at `most` times its source's size
    and what it leaves goes to the others by weight, until none is above."""
    full: set = set()
    while True:
        free = [s for s in sizes if s not in full]
        rest, weight = total - sum(most * sizes[s] for s in full), sum(weights[s] for s in free)
        share = {s: rest * weights[s] / weight for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {s: float(most * sizes[s]) if s in full else share[s] for s in sizes}
        full.update(over)


def min_cost_flow(patterns: list[tuple[tuple, int]], quotas: dict, most: int) -> list[int]:
    """Words to take of each pattern (set of sources, words).

    Network: start -> pattern with one arc of the pattern's words for each
    repetition, the k-th at cost k - 1 a word (convex); pattern -> each of its
    sources; source -> end with its quota. Cheapest paths are augmented until
    none is left, so all quota that can be met is met at the least repetition."""
    names = list(quotas)
    start, end = 0, 1 + len(patterns) + len(names)
    graph: list[list[int]] = [[] for _ in range(end + 1)]
    to, room, cost = [], [], []

    def arc(a, b, cap, price):
        for x, y, c, p in ((a, b, cap, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y)
            room.append(c)
            cost.append(p)

    at = {s: 1 + len(patterns) + i for i, s in enumerate(names)}
    levels = []
    for i, (members, size) in enumerate(patterns):
        levels.append(range(len(to), len(to) + 2 * most, 2))
        for k in range(most):
            arc(start, 1 + i, size, k)
        for s in members:
            arc(1 + i, at[s], most * size, 0)
    for s in names:
        arc(at[s], end, int(quotas[s]), 0)
    height = [0] * (end + 1)
    while True:
        dist, via, heap = [None] * (end + 1), [-1] * (end + 1), [(0, start)]
        dist[start] = 0
        while heap:
            d, x = heapq.heappop(heap)
            if d > dist[x]:
                continue
            for e in graph[x]:
                if room[e] and (dist[to[e]] is None or d + cost[e] + height[x] - height[to[e]] < dist[to[e]]):
                    dist[to[e]] = d + cost[e] + height[x] - height[to[e]]
                    via[to[e]] = e
                    heapq.heappush(heap, (dist[to[e]], to[e]))
        if dist[end] is None:
            break
        far = max(d for d in dist if d is not None)
        height = [h + (far if d is None else d) for h, d in zip(height, dist)]
        path, x = [], end
        while x != start:
            path.append(via[x])
            x = to[via[x] ^ 1]
        least = min(room[e] for e in path)
        for e in path:
            room[e] -= least
            room[e ^ 1] += least
    return [sum(room[e ^ 1] for e in own) for own in levels]


class Mix:
    """What `plan` decided: a row per membership pattern, on the driver and as
    the DataFrame `rules` (pattern, copies, up_to)."""

    def __init__(self, rules: DataFrame, n: int, sizes: dict, targets: dict):
        self.rules, self.n, self.sizes, self.targets = rules, n, sizes, targets

    def joined(self, rows: DataFrame) -> DataFrame:
        """`rows` (with _pattern, _order) plus _copies."""
        rules = F.broadcast(self.rules) if self.n <= BROADCAST_PATTERNS else self.rules
        both = rows.join(rules, F.col("_pattern").eqNullSafe(F.col("_rule")))
        return both.withColumn("_copies", F.col("_base") + (F.col("_order") <= F.col("_up_to")).cast("int")).drop("_rule", "_base", "_up_to")


def keyed(docs: DataFrame, sources: Column, seed: int) -> DataFrame:
    """Add _pattern (sorted distinct sources) and _order (seeded content order, 63 bits)."""
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 1)
    return docs.select("*", F.array_sort(F.array_distinct(sources)).alias("_pattern"), order.alias("_order"))


def plan(rows: DataFrame, weights, share: float, most: int) -> Mix:
    """rows: _pattern, _order and _size.

    Driver work is on patterns, not documents: their number is that of distinct
    source sets. Words meet in one aggregate by pattern and by 1 of BUCKETS
    slices of the seeded order; only each pattern's slice that holds its cut is
    then read row by row to place the cut."""
    bucket = F.shiftright("_order", 51).cast("int")
    slices = rows.groupBy("_pattern", bucket.alias("_slice")).agg(F.sum("_size").alias("words"))
    by = W.partitionBy("_pattern").orderBy("_slice")
    slices = cut(slices.withColumn("upto", F.sum("words").over(by)))
    patterns = [(tuple(r[0]), r[1]) for r in slices.groupBy("_pattern").agg(F.sum("words")).collect()]
    patterns.sort(key=lambda p: [(s is None, s or "") for s in p[0]])
    sizes: dict = {}
    for members, size in patterns:
        for s in members:
            sizes[s] = sizes.get(s, 0) + size
    names = source_order(sizes)
    sizes = {s: sizes[s] for s in names}
    price = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = share * sum(size for _, size in patterns)
    targets = capped_targets(sizes, price, total, most) if names else {}
    taken = min_cost_flow(patterns, {s: round(t) for s, t in targets.items()}, most)
    base = [t // size if size else 0 for t, (_, size) in zip(taken, patterns)]
    rest = [t - b * size for t, b, (_, size) in zip(taken, base, patterns)]

    spark = rows.sparkSession
    schema = "_rule array<string>, _base int, _rest long"
    wanted = spark.createDataFrame([(list(p), b, r) for (p, _), b, r in zip(patterns, base, rest)], schema)
    hint = F.broadcast if len(patterns) <= BROADCAST_PATTERNS else (lambda df: df)
    cuts = slices.join(hint(wanted), F.col("_pattern").eqNullSafe(F.col("_rule"))).filter("_rest > 0 AND upto >= _rest AND upto - words < _rest")
    cuts = cuts.select("_rule", F.col("_slice").alias("_at"), (F.col("_rest") - F.col("upto") + F.col("words")).alias("_left"))
    near = rows.withColumn("_slice", bucket).join(hint(cuts), F.col("_pattern").eqNullSafe(F.col("_rule")) & (F.col("_slice") == F.col("_at")))
    order = W.partitionBy("_rule").orderBy("_order").rangeBetween(W.unboundedPreceding, 0)
    near = near.withColumn("_sum", F.sum("_size").over(order))
    # the row on the cut goes in if at least half of it fits
    last = near.filter(F.col("_sum") - F.col("_size") / 2 <= F.col("_left")).groupBy(F.col("_rule").alias("_of")).agg(F.max("_order").alias("_last"))
    ends = cuts.join(last, F.col("_rule").eqNullSafe(F.col("_of")), "left").select("_rule", F.coalesce("_last", F.shiftleft(F.col("_at").cast("long"), 51) - 1).alias("_end"))
    ends = {tuple(r[0]): r[1] for r in ends.collect()}
    rules = [(list(p), b, ends.get(p, -1)) for (p, _), b in zip(patterns, base)]
    return Mix(spark.createDataFrame(rules, "_rule array<string>, _base int, _up_to long"), len(rules), sizes, targets)


def mix_documents(docs: DataFrame, sources: Column | None = None, weights=(5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 17) -> tuple[DataFrame, Mix]:
    """Copies of each document in a mix of `share` times all words.

    `sources`: array of the sources that hold a document (default: its `source`).
    Sources in code point order, null last, weigh `weights` in turn. Documents
    are taken in a seeded content order; those up to their pattern's cut get one
    copy more than the rest, at most `most`. Result: doc_id, size, _pattern and
    _copies, and the Mix.

    A null or empty text has size 0 and is never short of room; rows alike in
    doc_id and text are taken alike; an empty table gives an empty mix. Extra
    columns are ignored."""
    source = F.array("source") if sources is None else sources
    rows = keyed(docs, source, seed).select("doc_id", "_pattern", "_order", words(F.col("text")).alias("_size"))
    rows = stored(rows, "mix-rows")
    found = plan(rows, weights, share, most)
    return found.joined(rows).select("doc_id", F.col("_size").alias("size"), "_pattern", "_copies"), found


def with_targets(found: DataFrame, mix: Mix) -> DataFrame:
    """doc_id, size, source_size, target and taken for documents of one source each."""
    spark = found.sparkSession
    rows = [([s], mix.sizes[s], mix.targets[s]) for s in mix.sizes]
    per = spark.createDataFrame(rows, "_rule array<string>, source_size long, target double")
    per = F.broadcast(per) if len(rows) <= BROADCAST_PATTERNS else per
    return found.join(per, F.col("_pattern").eqNullSafe(F.col("_rule"))).select("doc_id", "size", "source_size", "target", (F.col("_copies") * F.col("size")).alias("taken"))


def take(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 17) -> DataFrame:
    """The mixed documents themselves: each row of `docs` as many times as the
    mix takes it. Only keys and sizes are aggregated; texts are not shuffled."""
    source = F.array("source")
    rows = keyed(docs, source, seed).select("_pattern", "_order", words(F.col("text")).alias("_size"))
    found = plan(stored(rows, "mix-rows"), weights, share, most)
    chosen = found.joined(keyed(docs, source, seed)).filter("_copies > 0")
    return chosen.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])
