"""Mixing of overlapping sources to target weights by min-cost flow.

Documents are summed up by membership pattern (the set of sources they belong to); the flow
network has one node per pattern and source, so its size does not depend on the number of
documents. Tokens of a pattern may be used again at a rising cost per use. The flow says how many
tokens each pattern gives to each source; documents are then chosen by a seeded hash: every
document is taken as often as the pattern is used as a whole, and a prefix of the hash order once
more. The prefix is found by histograms of the hash, so no pattern is ordered in one task.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import cut

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
REPEATS = 2
SEED = 7
#: Patterns held by the driver; more is an error, not a cut.
MAX_PATTERNS = 1_000_000
#: Hash digits resolved by each histogram, and how many histograms come before ordering.
DIGITS, LEVELS = 3, 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def target_sizes(sizes: dict, weights: Sequence[float] = WEIGHTS, total: float = TOTAL,
                 most: float = REPEATS) -> dict:
    """Target of each source: shares of ``total`` times all sizes by weight, given in turn to the
    sources in code point order (None last); no target exceeds ``most`` times its source's size,
    and what is above goes to the others by weight."""
    order = sorted(sizes, key=lambda s: (s is None, "" if s is None else s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, shares = total * sum(sizes.values()), float(sum(weight.values()))
    level, full = 0.0, set()
    for s in sorted(order, key=lambda s: most * sizes[s] / weight[s]):
        level = rest / shares if shares else 0.0
        if level * weight[s] <= most * sizes[s]:
            break
        full.add(s)
        rest -= most * sizes[s]
        shares -= weight[s]
    return {s: float(most * sizes[s]) if s in full else level * weight[s] for s in order}


def min_cost_flow(supplies: dict, quotas: dict, members: dict, repeats: int = REPEATS) -> dict:
    """{(pattern, source): tokens} that fills the quotas as far as possible at the least cost; the
    k-th use of a pattern's tokens costs k - 1 each (successive cheapest paths)."""
    graph: dict = defaultdict(list)

    def arc(a, b, room, cost):
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    given = {}
    for p, size in supplies.items():
        for k in range(repeats):
            arc("from", ("p", p), size, k)
        for s in members[p]:
            given[p, s] = len(graph["p", p])
            arc(("p", p), ("s", s), repeats * size, 0)
    for s, quota in quotas.items():
        arc(("s", s), "to", quota, 0)
    height: dict = defaultdict(int)
    while True:
        dist, back, queue, n = {"from": 0}, {}, [(0, 0, "from")], 0
        while queue:
            d, _, a = heapq.heappop(queue)
            if d > dist[a]:
                continue
            for i, (b, room, cost, _) in enumerate(graph[a]):
                new = d + cost + height[a] - height[b]
                if room > 0 and new < dist.get(b, float("inf")):
                    dist[b], back[b], n = new, (a, i), n + 1
                    heapq.heappush(queue, (new, n, b))
        if "to" not in dist:
            break
        for a in graph:
            height[a] += min(dist.get(a, dist["to"]), dist["to"])
        path, b = [], "to"
        while b != "from":
            path.append(back[b])
            b = back[b][0]
        room = min(graph[a][i][1] for a, i in path)
        for a, i in path:
            graph[a][i][1] -= room
            graph[graph[a][i][0]][graph[a][i][3]][1] += room
    return {(p, s): repeats * supplies[p] - graph["p", p][i][1] for (p, s), i in given.items()}


def _prefix(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """``sized(pattern, hash, size, ...)`` with ``extra``: whether the row is in the prefix of
    its pattern's hash order whose size comes nearest to ``wanted(pattern, r)``."""
    left, found = sized.join(F.broadcast(wanted), "pattern"), []
    left = left.withColumn("before", F.lit(0).cast("long"))
    for level in range(LEVELS):
        digits = F.substring("hash", 1 + level * DIGITS, DIGITS)
        bins = left.groupBy("pattern", "r", "before", digits.alias("bin")).agg(
            F.sum("size").alias("size"))
        upto = bins.select("pattern", "bin", "size", F.expr(
            "before + sum(size) OVER (PARTITION BY pattern ORDER BY bin)").alias("after"), "r")
        edge = cut(upto.where("after >= r").groupBy("pattern").agg(
            F.min(F.struct("bin", (F.col("after") - F.col("size")).alias("start"))).alias("e"))
            .select("pattern", F.col("e.bin").alias("bin"), F.col("e.start").alias("start")))
        split = left.join(F.broadcast(edge), "pattern", "left")
        low = F.coalesce(digits < F.col("bin"), F.lit(True))
        high = F.coalesce(digits > F.col("bin"), F.lit(False))
        found.append(split.where(low | high).withColumn("extra", low).drop("bin", "start"))
        left = (split.where(~low & ~high).withColumn("before", F.col("start"))
                .drop("bin", "start"))
    upto = F.expr("before + sum(size) OVER (PARTITION BY pattern ORDER BY hash, id, "
                  "_key, size ROWS UNBOUNDED PRECEDING)")
    last = left.withColumn("after", upto).withColumn(
        "extra", 2 * F.col("after") - F.col("size") <= 2 * F.col("r")).drop("after")
    for part in found:
        last = last.unionByName(part)
    return last.drop("r", "before")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights: Sequence[float] = WEIGHTS, total: float = TOTAL,
        repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, and _key (xxhash64 of the text): one row per row
    of ``docs``.

    ``source_col`` is a string, or an array of strings for documents of several sources; of an
    array's sources source_size and target are sums. size counts words, taken those that the mix
    takes, whole documents at a time, at most ``repeats`` times each, in an order drawn from id and
    text, so reruns agree on any layout, also where ids are shared or NULL. NULL and empty texts have
    size 0; NULL is a source of its own, the last; a document of no source (an empty array) is
    not taken; rows with equal id and text are interchangeable, each is counted; an empty table
    gives an empty result; other columns are not read.
    """
    several = docs.schema[source_col].dataType.simpleString().startswith("array")
    names = F.array_sort(F.array_distinct(source_col)) if several else F.array(source_col)
    names = F.coalesce(names, F.array(F.lit(None).cast("string")))
    sized = cut(docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("_key"),
        word_count(F.col(text_col)).alias("size"),
        F.to_json(names, {"ignoreNullFields": "false"}).alias("pattern"), names.alias("names"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                       F.lit(":"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))
        .alias("hash")))
    rows = (sized.groupBy("pattern").agg(F.first("names").alias("names"),
                                         F.sum("size").alias("size"))
            .limit(MAX_PATTERNS + 1).collect())
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    members = {r["pattern"]: list(r["names"]) for r in rows}
    supplies = {r["pattern"]: int(r["size"]) for r in rows}
    sizes: dict = defaultdict(int)
    for p, names in members.items():
        for s in names:
            sizes[s] += supplies[p]
    targets = target_sizes(sizes, weights, total, repeats)
    flow = min_cost_flow(supplies, {s: round(t) for s, t in targets.items()}, members, repeats)
    table = []
    for p, names in members.items():
        used = sum(flow[p, s] for s in names)
        times = used // supplies[p] if supplies[p] else 0
        table.append((p, sum(sizes[s] for s in names), float(sum(targets[s] for s in names)),
                      times, used - times * supplies[p]))
    plan = docs.sparkSession.createDataFrame(
        table, "pattern string, source_size long, target double, times int, r long")
    chosen = _prefix(sized.drop("names"), plan.select("pattern", "r"))
    return chosen.join(F.broadcast(plan.drop("r")), "pattern").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * (F.col("times") + F.col("extra").cast("int"))).alias("taken"), "_key")
