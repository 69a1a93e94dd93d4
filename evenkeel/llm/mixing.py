"""Mixing sources to target weights as a minimum-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to.
Words flow from patterns, one arc for each repetition at a rising cost, through the
sources they may serve to the quotas of these sources. The flow says how many words
of each pattern the mix takes; the documents are then chosen in a seeded order: every
document as often as whole passes fit, and the first of the order once more.

The driver sees one row a pattern. Choosing needs no sort of a source: a digest puts
documents in order, sums by digest prefix find where the order is cut, and only the
documents of that one prefix are looked at one by one.

Defined results: a null text has size 0 and is taken 0 words; null is a source of its
own, ordered last; an empty table gives no rows. Rows that repeat an id share a place
in the order and are taken alike.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import n_words, packed, small
from evenkeel.session import stage

PREFIX = 3           # hex digits: 4096 prefixes of the order for each pattern
MOST_PATTERNS = 1_000_000  # rows the driver takes; more is refused, not cut


@dataclass(frozen=True)
class Recipe:
    weights: tuple[int, ...] = (5, 2, 1)   # by position among the ordered sources, repeating
    share: tuple[int, int] = (3, 2)        # words of the mix over words there are
    repeats: int = 2                       # times a document is taken at most
    seed: str = "mix-1"


def targets(sizes: dict[str | None, int], recipe: Recipe) -> dict[str | None, float]:
    """Words asked of each source: by weight, none above its limit.

    Sources are filled in the order in which they reach their limits; the rest of the
    words is shared by weight among those that do not reach it.
    """
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: recipe.weights[i % len(recipe.weights)] for i, s in enumerate(ordered)}
    limit = {s: recipe.repeats * sizes[s] for s in ordered}
    left = recipe.share[0] * sum(sizes.values()) / recipe.share[1]
    weights = sum(weight.values())
    result = {}
    for s in sorted(ordered, key=lambda s: (limit[s] / weight[s], s is None, s or "")):
        if left * weight[s] / weights < limit[s]:
            break
        result[s] = float(limit[s])
        left, weights = left - limit[s], weights - weight[s]
    return result | {s: left * weight[s] / weights for s in ordered if s not in result}


def _least_cost(arcs: list[list], source: int, sink: int, nodes: int) -> None:
    """Fills the arcs [from, to, capacity, cost, flow] by successive shortest paths."""
    around = defaultdict(list)
    for k, (a, b, *_) in enumerate(arcs):
        around[a].append((k, 1))
        around[b].append((k, -1))
    while True:
        cost, back = [float("inf")] * nodes, [None] * nodes
        cost[source], queue = 0, [source]
        waiting = {source}
        for node in queue:  # grows while nodes get cheaper
            waiting.discard(node)
            for k, way in around[node]:
                a, b, capacity, price, flow = arcs[k]
                left, other = (capacity - flow, b) if way > 0 else (flow, a)
                if left > 0 and cost[node] + way * price < cost[other]:
                    cost[other], back[other] = cost[node] + way * price, (k, way)
                    if other not in waiting:
                        waiting.add(other)
                        queue.append(other)
        if back[sink] is None:
            return
        path, node = [], sink
        while node != source:
            k, way = back[node]
            path.append((k, way))
            node = arcs[k][0] if way > 0 else arcs[k][1]
        amount = min(arcs[k][2] - arcs[k][4] if way > 0 else arcs[k][4] for k, way in path)
        for k, way in path:
            arcs[k][4] += way * amount


def _connected(patterns: list[frozenset]) -> list[list[frozenset]]:
    """Patterns in groups that share no source with another group."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for pattern in patterns:
        first, *rest = pattern
        for source in rest:
            parent[root(source)] = root(first)
    groups = defaultdict(list)
    for pattern in patterns:
        groups[root(next(iter(pattern)))].append(pattern)
    return list(groups.values())


def route(sizes: dict[frozenset, int], quotas: dict[str | None, int],
          repeats: int) -> dict[tuple[frozenset, str | None], int]:
    """Words that each pattern gives to each of its sources, least repetition first.

    The n-th pass over a pattern costs n: convex, so the flow spreads repetition over
    the patterns before it deepens it in one.
    """
    routed = {}
    for group in _connected([p for p in sizes if p]):
        names = sorted({s for p in group for s in p}, key=lambda s: (s is None, s or ""))
        group = sorted(group, key=lambda p: sorted((s is None, s or "") for s in p))
        at = {s: 1 + len(group) + i for i, s in enumerate(names)}
        sink = 1 + len(group) + len(names)
        arcs, served = [], {}
        for i, pattern in enumerate(group, 1):
            arcs += [[0, i, sizes[pattern], n, 0] for n in range(1, repeats + 1)]
            for s in sorted(pattern, key=lambda s: (s is None, s or "")):
                served[pattern, s] = arc = [i, at[s], repeats * sizes[pattern], 0, 0]
                arcs.append(arc)
        arcs += [[at[s], sink, quotas.get(s, 0), 0, 0] for s in names]
        _least_cost(arcs, 0, sink, sink + 1)
        routed |= {key: arc[4] for key, arc in served.items()}
    return routed


def _order(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _cuts(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """(pattern, passes, last): whole passes, and the last digest that is taken once more."""
    prefix = F.substring("digest", 1, PREFIX)
    sums = rows.groupBy("pattern", prefix.alias("prefix")).agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("pattern").orderBy("prefix")
    # One prefix in which the sum passes what is left.
    at = sums.withColumn("before", F.sum("words").over(up_to) - F.col("words")).join(
        small(asked, 100_000), "pattern").where(
        (F.col("before") <= F.col("left")) & (F.col("before") + F.col("words") > F.col("left")))
    single = rows.withColumn("prefix", prefix).groupBy("pattern", "prefix", "digest").agg(
        F.sum("size").alias("size"))
    order = Window.partitionBy("pattern").orderBy("digest")
    near = single.join(small(at.select("pattern", "prefix", "before", "left"), 100_000),
                       ["pattern", "prefix"]).withColumn(
        "total", F.col("before") + F.sum("size").over(order))
    # The document at the cut is taken if that comes nearer to what is asked.
    near = near.where(F.col("total") - F.col("left") <= F.col("left") - (F.col("total") - F.col("size")))
    last = near.groupBy("pattern").agg(F.max("digest").alias("last"))
    # Without one in that prefix, all the earlier prefixes are taken.
    return asked.join(at.select("pattern", "prefix"), "pattern", "left").join(
        last, "pattern", "left").select(
        "pattern", "passes", F.coalesce("last", "prefix").alias("last"))


def mix(docs: DataFrame, sources: Column, recipe: Recipe = Recipe()) -> DataFrame:
    """docs (doc_id, text, ...) with size, copies and taken added.

    sources is an array column: the sources a document belongs to, null among them.
    A document without any is in no mix.
    """
    by_pattern = F.transform(F.array_sort(F.array_distinct(sources)), lambda s: F.to_json(
        F.struct(s.alias("s"))))
    sized = docs.withColumns({
        "size": n_words(F.col("text")), "_pattern": F.array_join(by_pattern, "\n"),
        "_digest": _order(F.col("doc_id"), recipe.seed)})
    rows = stage(sized.select("size", F.col("_pattern").alias("pattern"), F.col("_digest").alias(
        "digest"), sources.alias("sources")), "mix-sizes")
    found = rows.groupBy("pattern").agg(
        F.sum("size").alias("size"), F.first("sources").alias("sources")
    ).limit(MOST_PATTERNS + 1).collect()
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    patterns = {r["pattern"]: frozenset(r["sources"] or ()) for r in found}
    sizes = {patterns[r["pattern"]]: r["size"] for r in found}
    per_source = defaultdict(int)
    for pattern, size in sizes.items():
        for s in pattern:
            per_source[s] += size
    asked = targets(per_source, recipe)
    routed = route(sizes, {s: int(t) for s, t in asked.items()}, recipe.repeats)
    words = defaultdict(int)
    for (pattern, _), amount in routed.items():
        words[pattern] += amount
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        [(key, *divmod(words[p], sizes[p])) if sizes[p] else (key, 0, 0)
         for key, p in patterns.items()], "pattern string, passes long, left long")
    cuts = _cuts(rows, plan).select(F.col("pattern").alias("_key"), "passes", "last")
    per = spark.createDataFrame(
        [(key, [(s, per_source[s], asked[s]) for s in sorted(p, key=lambda s: (s is None, s or ""))])
         for key, p in patterns.items()],
        "_key string, per_source array<struct<source:string,source_size:long,target:double>>")
    known = small(stage(cuts.join(per, "_key"), "mix-plan"), 100_000)
    # A digest is taken up to the last one; a bare prefix stands before its digests.
    extra = F.when(F.col("_digest") <= F.col("last"), 1).otherwise(0)
    return sized.join(known, sized["_pattern"] == F.col("_key"), "left").withColumn(
        "copies", F.coalesce(F.col("passes") + F.coalesce(extra, F.lit(0)), F.lit(0)).cast("long")
    ).withColumn("taken", F.col("copies") * F.col("size")).drop(
        "_key", "_pattern", "_digest", "passes", "last")


def repeated(docs: DataFrame, source: str = "source", recipe: Recipe = Recipe()) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their columns."""
    mixed = mix(packed(docs, "doc_id", "text", source), F.array(source), recipe)
    return mixed.where("copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
