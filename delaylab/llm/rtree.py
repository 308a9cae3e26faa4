"""Hard-negative mining over an STR-packed R-tree.

Rows are dealt by range over label and leading coordinates, and every task tiles its rows: sort by
one coordinate, cut into slabs, go on with the next coordinate, until a tile fills one leaf. A leaf
has rows of one label and the minimum bounding box of their vectors; runs of neighbouring leaves
make the boxes of the levels above. The inner products of an anchor with a box lie in an interval
that its corners give per coordinate, so a best-first queue visits boxes by their highest possible
score inside the wanted window and skips those outside it or strictly below the k-th best (equal
ones may still hold a smaller id). Scores are exact integers, so the result is exact.

Anchors meet the leaves in groups of (anchors' block, rows' part): both are bounded in size, so no
task holds all anchors or all rows, and only the best k of a group leave it.
"""

from __future__ import annotations

import heapq
import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut

SCALE = 256
#: Rows of a leaf, children of a node.
LEAF, FANOUT = 128, 8
#: Rows of a part of the index and anchors of a block: one group of the search has one of each.
PART_ROWS, BLOCK_ANCHORS = 8192, 1024

_LEAVES = "part int, label int, ids binary, vectors binary, low binary, high binary"
_HITS = ("anchor_id long, query long, slot int, positive_id long, positive_score long, "
         "found_id long, found_score long")


def quantise(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, as long."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, label, v``: rows with an id, a label and a vector of finite components."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    fine = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
                      & F.col(vector_col).isNotNull() & ~bad)
    return fine.select(F.col(id_col).cast("long").alias("id"),
                       F.col(label_col).cast("int").alias("label"),
                       quantise(F.col(vector_col)).alias("v"))


def _tiles(points: np.ndarray, ids: np.ndarray, rows: np.ndarray, free: list[int]):
    """Row numbers of the leaves, neighbours next to each other."""
    if len(rows) <= LEAF:
        yield rows
        return
    leaves = -(-len(rows) // LEAF)
    if free:
        spread = points[rows][:, free]
        axis = free[int(np.argmax(spread.max(0) - spread.min(0)))]
        slabs = max(2, int(np.ceil(leaves ** (1 / len(free)))))
        order = rows[np.lexsort((ids[rows], points[rows, axis]))]
    else:
        axis, slabs, order = None, leaves, rows
    size = -(-leaves // slabs) * LEAF
    for at in range(0, len(order), size):
        yield from _tiles(points, ids, order[at:at + size], [f for f in free if f != axis])


def pack(rows: DataFrame, dim: int) -> DataFrame:
    """The leaves of the tree over ``rows(id, label, v)``, in parts of about ``PART_ROWS`` rows.
    Vectors shorter than ``dim`` are filled with zeros."""
    names, kinds = zip(*[(c.split()[0], pa.int32() if c.endswith("int") else pa.binary())
                         for c in _LEAVES.split(", ")])

    def tiled(batches: list):
        part, table = TaskContext.get().partitionId(), pa.Table.from_batches(batches)
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        points = _matrix(table.column("v"), dim)
        for label in np.unique(labels):
            mine = np.flatnonzero(labels == label)
            out = [(part, int(label), ids[t].tobytes(), points[t].tobytes(),
                    points[t].min(0).tobytes(), points[t].max(0).tobytes())
                   for t in _tiles(points, ids, mine, list(range(dim)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    def run(batches):
        held: list = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= 4 * PART_ROWS:  # a part larger than planned
                yield from tiled(held)
                held = []
        if held:
            yield from tiled(held)

    parts = -(-rows.count() // PART_ROWS) or 1
    lead = [F.coalesce(F.get("v", F.lit(i)), F.lit(0)) for i in range(min(2, dim))]
    return cut(rows.repartitionByRange(parts, "label", *lead, "id").mapInArrow(run, _LEAVES))


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.array([len(x) for x in flat], dtype=np.int64)
    out = np.zeros((len(sizes), dim), dtype=np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


class Tree:
    """The leaves of one part and the boxes above them."""

    def __init__(self, leaves: pa.Table, dim: int):
        rows = leaves.to_pylist()
        rows.sort(key=lambda r: r["label"])  # stable: packing order within a label
        self.label = [r["label"] for r in rows]
        self.ids = [np.frombuffer(r["ids"], np.int64) for r in rows]
        vectors = [np.frombuffer(r["vectors"], np.int64).reshape(-1, dim) for r in rows]
        box = [np.array([np.frombuffer(r[side], np.int64) for r in rows]).reshape(-1, dim)
               for side in ("low", "high")]
        most = max([0, *(int(np.abs(b).max(initial=0)) for b in box)])
        if dim * most * most >= 1 << 62:
            raise ValueError("inner products exceed 64 bits")
        # whole numbers below 2^53 are exact in floating point
        self.kind = np.float64 if dim * most * most < 1 << 53 else np.int64
        self.vectors = [v.astype(self.kind) for v in vectors]
        self.low, self.high = [box[0]], [box[1]]
        while len(self.low[-1]) > FANOUT:
            at = np.arange(0, len(self.low[-1]), FANOUT)
            self.low.append(np.minimum.reduceat(self.low[-1], at))
            self.high.append(np.maximum.reduceat(self.high[-1], at))

    def intervals(self, anchors: np.ndarray):
        """Lowest and highest inner product of every anchor with every box, by level."""
        up = np.maximum(anchors, 0).astype(self.kind).T
        down = np.minimum(anchors, 0).astype(self.kind).T
        levels = []
        for low, high in zip(self.low, self.high):
            low, high = low.astype(self.kind), high.astype(self.kind)
            levels.append(((low @ up + high @ down).T, (high @ up + low @ down).T))
        return levels

    def search(self, levels, which: int, vector, wanted, window, k: int, scores: dict):
        """The best ``k`` (score, id) in ``window``, highest first, ties by smaller id, among
        leaves whose label is ``wanted``; ``scores`` keeps what this anchor has scored."""
        least, most = window
        best: list[tuple] = []  # heap of (score, -id): the worst of the best k on top
        queue: list[tuple] = []

        def push(level, i):
            low, high = levels[level][0][which, i], levels[level][1][which, i]
            if low > most or high < least or (level == 0 and not wanted(self.label[i])):
                return
            reach = min(high, most)
            if len(best) < k or reach >= best[0][0]:
                heapq.heappush(queue, (-reach, level, i))

        top = len(self.low) - 1
        for i in range(len(self.low[top])):
            push(top, i)
        while queue:
            reach, level, i = heapq.heappop(queue)
            if len(best) == k and -reach < best[0][0]:
                break  # strictly below the k-th, as is everything left
            if level:
                for child in range(i * FANOUT, min((i + 1) * FANOUT, len(self.low[level - 1]))):
                    push(level - 1, child)
                continue
            if i not in scores:
                scores[i] = self.vectors[i] @ vector
            s = scores[i]
            floor = max(least, best[0][0]) if len(best) == k else least
            for at in np.flatnonzero((s >= floor) & (s <= most)).tolist():
                entry = (int(s[at]), -int(self.ids[i][at]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _searched(leaves: DataFrame, anchors: DataFrame, dim: int, k: int, same_label: bool
              ) -> DataFrame:
    """The best ``k`` rows of every part for each anchor and window: ``anchors(anchor_id, query,
    label, v, windows)`` with windows (slot, positive_id, positive_score, least, most)."""
    def run(key, found: pa.Table, asked: pa.Table):
        out: list[tuple] = []
        if found.num_rows and asked.num_rows:
            tree = Tree(found, dim)
            vectors = _matrix(asked.column("v"), dim)
            levels = tree.intervals(vectors)
            rows = asked.select(["anchor_id", "query", "label", "windows"]).to_pylist()
            for which, row in enumerate(rows):
                own, vector, scores = row["label"], vectors[which].astype(tree.kind), {}

                def wanted(label):
                    return (label == own) == same_label

                for w in row["windows"]:
                    # one more than k: the anchor itself may be among those of its label
                    hits = tree.search(levels, which, vector, wanted, (w["least"], w["most"]),
                                       k + w["own"], scores)
                    hits = [h for h in hits if h[1] != row["anchor_id"]][:k]
                    out += [(row["anchor_id"], row["query"], w["slot"], w["positive_id"],
                             w["positive_score"], i, s) for s, i in hits]
        columns = list(zip(*out)) if out else [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
        names = [c.split()[0] for c in _HITS.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    blocks = -(-anchors.count() // BLOCK_ANCHORS) or 1
    asked = anchors.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    last = leaves.agg(F.max("part")).first()[0] or 0
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(last))))
    spread = leaves.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return (spread.groupBy("block", "part").cogroup(asked.groupBy("block", "part"))
            .applyInArrow(run, _HITS))


def _first(hits: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("found_score"), "found_id")
    return hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label", k: int = 5,
                   positives: int = 5, ratio: tuple[int, int] = (80, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``id``. Components become floor(256 x); a score is the integer
    inner product with the anchor. Positives of an anchor are its first ``positives`` rows of the
    same label, negatives of a positive its first ``k`` rows of other labels whose score is at most
    the positive's and at least ``ratio`` of it; higher scores first, ties by smaller id.

    Rows with a NULL id, label, vector or component or a component that is not finite take no part.
    Shorter vectors count as filled with zeros. Rows with the anchor's own id are never its
    positives; repeated rows take a place each, a repeated anchor is asked once, and anchors of
    one id with different labels or vectors are asked each. An anchor without positives, or a
    positive without negatives, has no rows; an empty table gives an empty result.
    """
    points = cut(usable(rows, id_col, vector_col, label_col))
    dim = max(points.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    leaves = pack(points, dim)
    query = F.xxhash64("id", "label", "v")
    anchors = cut(points.where(is_anchor).select(
        F.col("id").alias("anchor_id"), query.alias("query"), "label", "v").distinct())
    window = "array<struct<slot:int,positive_id:bigint,positive_score:bigint,least:bigint," \
             "most:bigint,own:int>>"
    whole = F.array(F.struct(F.lit(0), F.lit(None).cast("long"), F.lit(None).cast("long"),
                             F.lit(-(1 << 62)), F.lit(1 << 62), F.lit(1))).cast(window)
    near = _first(_searched(leaves, anchors.withColumn("windows", whole), dim, positives, True),
                  positives, "anchor_id", "query")
    # ceil(ratio x score) in whole numbers: minus the floor of its negative
    down = f"-{ratio[0]} * found_score"
    least = F.expr(f"-(({down} - pmod({down}, {ratio[1]})) div {ratio[1]})")
    wanted = F.collect_list(F.struct(F.col("place").cast("int"), "found_id", "found_score", least,
                                     "found_score", F.lit(0)))
    asked = cut(anchors.join(near.groupBy("query").agg(wanted.cast(window).alias("windows")),
                             "query"))
    hits = _first(_searched(leaves, asked, dim, k, False), k, "anchor_id", "query", "slot")
    return hits.select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"),
                       F.col("found_id").alias("negative_id"), "positive_score",
                       F.col("found_score").alias("negative_score"))
