"""Hard-negative mining with an STR-packed R-tree searched by inner product.

Sort-tile-recursive packing happens twice: Spark cuts all vectors into tiles by quantiles of two coordinates, and inside a
tile the rows are sorted and cut along one wide coordinate after the other into leaves. Every leaf, group of leaves and
tile has a minimum bounding box, which bounds each coordinate's share of an inner product from both sides. A query walks a
tile's boxes best first: boxes outside its score windows are pruned, and so are those strictly below the k-th row found.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railloom.llm.batches import arrow_map
from railloom.operators.staging import stage

LEAF, GROUP = 128, 8
#: Rows of a tile: as many tiles as keep the cluster busy, each of which fits a worker.
LEAST_TILE, MOST_TILE, TILES = 4096, 1 << 18, 64
#: Inner products must be exact in doubles.
EXACT = 2.0**52
TILE = "tile long, id binary, label binary, vector binary, dims int"


def usable(df: DataFrame, id_col: str, vector: str, label: Column) -> DataFrame:
    """``id``, ``label`` and the integer vector ``q`` of the rows that take part."""
    x = F.col(f"`{vector}`")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    rows = df.where(F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & x.isNotNull() & sound)
    q = F.transform(x, lambda v: F.floor(256 * v.cast("double")))
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), q.alias("q"))


def _order(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, size: int, axes: list[int]) -> list[np.ndarray]:
    """Leaves of ``size`` rows: sorted by one axis and cut into slabs, which are packed along the other axes."""
    if len(rows) <= size:
        return [rows[np.argsort(ids[rows], kind="stable")]]
    leaves = math.ceil(len(rows) / size)
    slabs = leaves if len(axes) == 1 else math.ceil(leaves ** (1 / len(axes)))
    rows = rows[np.lexsort((ids[rows], vectors[rows, axes[0]]))]
    width = math.ceil(leaves / slabs) * size
    return [leaf for at in range(0, len(rows), width) for leaf in _order(vectors, ids, rows[at : at + width], size, axes[1:] or axes)]


class Tree:
    """Rows of a tile in leaves of ``LEAF`` and groups of ``GROUP`` leaves, with their boxes and smallest ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, packed: bool = False):
        if not packed:
            wide = np.argsort(-vectors.astype(np.float64).var(axis=0), kind="stable")[:3].tolist() if len(vectors) and vectors.shape[1] else []
            rows = np.concatenate(_order(vectors, ids, np.arange(len(ids)), LEAF, wide)) if wide else np.argsort(ids, kind="stable")
            ids, labels, vectors = ids[rows], labels[rows], vectors[rows]
        self.ids, self.labels, self.vectors = ids, labels, vectors.astype(np.float64)
        self.starts = np.arange(0, len(ids), LEAF)
        low, high = np.minimum.reduceat(self.vectors, self.starts, axis=0), np.maximum.reduceat(self.vectors, self.starts, axis=0)
        first = np.minimum.reduceat(ids, self.starts)
        inner = np.arange(0, len(self.starts), GROUP)
        self.leaves = (low, high, first)
        self.groups = (np.minimum.reduceat(low, inner, axis=0), np.maximum.reduceat(high, inner, axis=0), np.minimum.reduceat(first, inner))

    def bounds(self, boxes: tuple, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[query, box]: least and greatest inner product that a row in the box can have."""
        low, high, _ = boxes
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ low.T + down @ high.T, up @ high.T + down @ low.T

    def search(self, queries: np.ndarray, ids: np.ndarray, labels: np.ndarray, windows: list[list[tuple[float, float]]], same: bool, k: int) -> Iterator[tuple[int, int, int, int]]:
        """(query, window, id, score) of the first ``k`` rows of each window; rows of the query's own id never count."""
        leaf_low, leaf_high = self.bounds(self.leaves, queries)
        group_low, group_high = self.bounds(self.groups, queries)
        for n in range(len(queries)):
            for w, found in enumerate(self._walk(queries[n], ids[n], labels[n], windows[n], same, k, (leaf_low[n], leaf_high[n]), (group_low[n], group_high[n]))):
                for score, negative in found:
                    yield n, w, -negative, int(score)

    def _walk(self, query, own, label, windows, same, k, leaf, group) -> list[list[tuple[float, int]]]:
        best: list[list[tuple[float, int]]] = [[] for _ in windows]  # heaps of (score, -id), worst first
        takes = ((self.labels == label) == same) & (self.ids != own)

        def open_for(low: float, high: float, first: int) -> list[int]:
            """Windows to which a box can still add."""
            out = []
            for w, (least, most) in enumerate(windows):
                if high >= least and low <= most and (len(best[w]) < k or (min(high, most), -first) > best[w][0]):
                    out.append(w)
            return out

        queue = [(-group[1][g], 0, g) for g in range(len(group[1]))]
        heapq.heapify(queue)
        while queue:
            _, is_leaf, n = heapq.heappop(queue)
            bound, firsts = (leaf, self.leaves[2]) if is_leaf else (group, self.groups[2])
            wanted = open_for(bound[0][n], bound[1][n], firsts[n])
            if not wanted:
                continue
            if not is_leaf:
                for child in range(n * GROUP, min((n + 1) * GROUP, len(self.starts))):
                    heapq.heappush(queue, (-leaf[1][child], 1, child))
                continue
            at = slice(n * LEAF, (n + 1) * LEAF)
            scores = np.where(takes[at], self.vectors[at] @ query, np.nan)
            for w in wanted:
                least, most = windows[w]
                if len(best[w]) == k:
                    least = max(least, best[w][0][0])
                rows = np.flatnonzero((scores >= least) & (scores <= most))
                for row in rows[np.argsort(-scores[rows], kind="stable")]:
                    entry = (scores[row], -int(self.ids[n * LEAF + row]))
                    if len(best[w]) == k and entry[0] < best[w][0][0]:
                        break
                    if len(best[w]) < k:
                        heapq.heappush(best[w], entry)
                    elif entry > best[w][0]:
                        heapq.heapreplace(best[w], entry)
        return best


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` integers; a shorter vector has zeros behind."""
    out = np.zeros((len(lists), dims), np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def pack(points: DataFrame, dims: int, rows: int) -> DataFrame:
    """Tiles of the points, each with its rows in the order of its leaves.

    Slabs are cut at quantiles of the widest coordinate and tiles at quantiles of the next within a slab. Equal values
    stay together, so what is still too large, such as a vector that many rows share, is dealt out by a hash of the id.
    """
    size = min(MOST_TILE, max(LEAST_TILE, rows // TILES))
    cuts = math.ceil(math.sqrt(math.ceil(rows / size)))
    spread = points.select(F.posexplode("q")).groupBy("pos").agg(F.variance("col").alias("v")).orderBy(F.desc("v"), "pos").limit(2).collect()
    axes = ([r["pos"] for r in spread] * 2)[:2] or [0, 0]
    a, b = (F.coalesce(F.get("q", F.lit(x)), F.lit(0)).alias(n) for x, n in zip(axes, "ab", strict=True))
    shares = [n / cuts for n in range(1, cuts)] or [1.0]

    def place(value: Column, at: Column) -> Column:
        return F.size(F.filter(at, lambda cut: cut < value))

    placed = points.select("*", a, b)
    slabs = placed.select(F.percentile_approx("a", F.lit(shares)).alias("slabs")).first()["slabs"] or []
    placed = placed.withColumn("slab", place(F.col("a"), F.array(*[F.lit(s) for s in slabs]).cast("array<bigint>")))
    strips = placed.groupBy("slab").agg(F.percentile_approx("b", F.lit(shares)).alias("strips"))  # one row a slab
    placed = placed.join(strips, "slab").withColumn("tile", F.col("slab") * (cuts + 1) + place(F.col("b"), F.col("strips")))
    sized = placed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / (2 * size)).alias("pieces"))
    pieces = placed.join(sized, "tile").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")))
    whole = pieces.select((F.col("piece") * (cuts + 1) * (cuts + 1) + F.col("tile")).alias("tile"), "id", "label", "q")

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        tree = Tree(*[table.column(c).to_numpy() for c in ("id", "label")], _matrix(table.column("q").combine_chunks(), dims))
        parts = [pa.array([v.astype(np.int64).tobytes()], pa.binary()) for v in (tree.ids, tree.labels, tree.vectors)]
        return pa.Table.from_arrays([table.column("tile").slice(0, 1), *parts, pa.array([dims], pa.int32())], names=["tile", "id", "label", "vector", "dims"])

    return stage(whole.groupBy("tile").applyInArrow(build, TILE), "tiles")


def walk(tiles: DataFrame, queries: DataFrame, same: bool, k: int) -> DataFrame:
    """First ``k`` rows per query, window and tile: ``query``, ``window`` (its place), ``found`` and ``score``.

    ``queries`` has ``query``, ``own`` and ``own_label`` (id and label), ``q`` and ``windows`` (array of structs least, most).
    Every tile meets all queries: they follow it through one task in batches, so a task holds a tile and a batch.
    """
    every = [r["tile"] for r in tiles.select("tile").collect()]  # bounded: rows of the table / MOST_TILE, or TILES
    spread = queries.select(F.explode(F.array(*[F.lit(t) for t in every]).cast("array<bigint>")).alias("tile"), F.lit(1).alias("turn"), "*")
    met = tiles.select(F.lit(0).alias("turn"), "*").unionByName(spread, allowMissingColumns=True)
    met = met.repartition(max(1, len(every)), "tile").sortWithinPartitions("tile", "turn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            turns, at = batch.column("turn").to_numpy(), 0
            while at < len(turns):
                if turns[at] == 0:
                    row = {c: batch.column(c)[at].as_py() for c in ("id", "label", "vector", "dims")}
                    ids, labels, flat = (np.frombuffer(row[c], np.int64) for c in ("id", "label", "vector"))
                    tree, dims, at = Tree(ids, labels, flat.reshape(len(ids), row["dims"]), packed=True), row["dims"], at + 1
                    continue
                later = np.flatnonzero(turns[at:] == 0)
                part = batch.slice(at, later[0] if len(later) else len(turns) - at)
                at += len(part)
                own = part.column("own").to_numpy()
                asked = [[(w["least"], w["most"]) for w in row] for row in part.column("windows").to_pylist()]
                queries = _matrix(part.column("q"), dims).astype(np.float64)
                hits = list(tree.search(queries, own, part.column("own_label").to_numpy(), asked, same, k))
                n, window, found, score = np.array(hits, np.int64).reshape(-1, 4).T
                yield pa.RecordBatch.from_arrays([pa.array(part.column("query").to_numpy()[n]), pa.array(window), pa.array(found), pa.array(score)], names=["query", "window", "found", "score"])

    return arrow_map(met, run, "query long, window long, found long, score long")


def first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The first ``k`` per key by score, then smaller id; rows that repeat an id count one by one."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "found")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)


def mine(
    df: DataFrame, anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: Column | str = "label", positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: hard negatives of every anchor.

    ``anchor`` is a condition on the id, written on a column ``id``. Scores are inner products of floor(256 x). An anchor's
    positives are the first ``positives`` rows of its label; a positive's negatives are the first ``negatives`` rows of other
    labels whose score is between ``least`` and ``most`` percent of the positive's. Higher scores come first, then smaller
    ids. So a negative positive score has none, and 0 has those of score 0.

    Rows without id, label or vector, or with a null or non-finite component, take no part. Shorter vectors have zeros
    behind. Of rows that repeat an id each takes part, as a row found and as an anchor, but rows of the anchor's own id are
    neither its positives nor its negatives; equal anchor rows count once. An empty table gives no rows. Components whose
    products could not be summed exactly fail the job with a message.
    """
    points = stage(usable(df, id_col, vector, F.col(f"`{label}`") if isinstance(label, str) else label), "points")
    row = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("dims"), F.max(F.array_max(F.transform("q", F.abs))).alias("top")).first()
    dims, top = row["dims"] or 1, row["top"] or 0
    if dims * float(top) ** 2 >= EXACT:
        raise ValueError(f"components up to {top / 256} in {dims} dimensions do not give exact inner products")
    tiles = pack(points, dims, row["n"])
    anchors = points.where(anchor).distinct().withColumnsRenamed({"id": "own", "label": "own_label"})
    anchors = stage(anchors.withColumn("query", F.monotonically_increasing_id()), "anchors")
    everything = F.array(F.struct(F.lit(float("-inf")).alias("least"), F.lit(float("inf")).alias("most")))
    near = first(walk(tiles, anchors.withColumn("windows", everything), True, positives), positives, "query")
    near = near.select("query", F.struct("n", F.col("found").alias("positive_id"), F.col("score").alias("positive_score")).alias("p"))
    asked = anchors.join(near.groupBy("query").agg(F.array_sort(F.collect_list("p")).alias("ps")), "query")

    def window(p: Column) -> Column:
        score = p["positive_score"]
        return F.struct(
            F.when(score < 0, float("inf")).otherwise(F.ceil(score * F.lit(least) / 100)).cast("double").alias("least"),
            F.when(score < 0, float("-inf")).otherwise(F.floor(score * F.lit(most) / 100)).cast("double").alias("most"),
        )

    asked = stage(asked.withColumn("windows", F.transform("ps", window)), "windows")
    hard = first(walk(tiles, asked.drop("ps"), False, negatives), negatives, "query", "window")
    positive = asked.select("query", "own", F.posexplode("ps").alias("window", "p"))
    return hard.join(positive, ["query", "window"]).select(
        F.col("own").alias("anchor_id"),
        F.col("p.positive_id").alias("positive_id"),
        F.col("n").cast("int").alias("rank"),
        F.col("found").alias("negative_id"),
        F.col("p.positive_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
