"""Exact top-k search by inner product: a KD-tree per shard, best-first traversal, and a kth score that travels with the query
to the shards whose boxes can reach it.

Components become floor(1024 * x). A vector that is null, empty or holds a null or non-finite component takes no part, nor does
one without a vec_id; components and scores beyond the range of a long are cut to its ends. Vectors are compared only with
vectors of their length. Equal scores rank by smaller vec_id. Repeated vec_ids are candidates each, never for a query of
their own id; of several query rows with one id the smallest vector asks. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import partitions, settled

SCALE = 1024
#: Scores whose terms cannot sum up to this are exact in 64 bits; others are summed in unbounded integers.
EXACT = float(1 << 62)
#: Vectors of a shard, and of a leaf of its tree.
SHARD_ROWS = 8_192
LEAF_ROWS = 64
#: Queries whose bounds to all boxes of a tree are held at once.
QUERY_ROWS = 256
#: Rows (three numbers each) up to which the table of spaces is broadcast.
FEW = 65_536
#: Vector lengths that are cut into spaces, the most frequent ones; others have a single space, dealt by hash.
CUT_LENGTHS = 1_000
#: Bytes of all boxes of spaces, which go to every task, and of the vectors from which the driver finds the cuts.
BOX_BYTES = 16 << 20
SAMPLE_BYTES = 16 << 20
FOUND = "query_id long, vec_id long, score long"
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
NONE_YET = LOWEST


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray, extent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    queries = queries.astype(float)
    sizes = np.abs(queries) @ extent.T
    highest = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    return np.ceil(highest + sizes * (len(queries[0]) + 4) * 2.0**-50) + 1, sizes * 1.001


class KDTree:
    """Median splits along the widest axis; every node has a tight bounding box and its smallest id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        order = np.lexsort((ids,))
        self.ids, self.vectors = ids[order], vectors[order]
        self.rows: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        low, high = [], []
        work: list[tuple[np.ndarray, int | None, int]] = [(np.arange(len(ids)), None, 0)]
        while work:
            rows, parent, side = work.pop()
            node = len(self.rows)
            if parent is not None:
                pair = self.children[parent] or (0, 0)
                self.children[parent] = (node, pair[1]) if side == 0 else (pair[0], node)
            own = self.vectors[rows]
            low.append(own.min(0))
            high.append(own.max(0))
            self.rows.append(rows)
            self.children.append(None)
            axis = int((high[-1] - low[-1]).argmax())
            if len(rows) > leaf_rows and high[-1][axis] > low[-1][axis]:
                half = len(rows) // 2
                cut = np.argpartition(own[:, axis], half)
                work.append((np.sort(rows[cut[:half]]), node, 0))
                work.append((np.sort(rows[cut[half:]]), node, 1))
        self.low, self.high = np.array(low, float), np.array(high, float)
        self.extent = np.maximum(np.abs(self.low), np.abs(self.high))
        self.first_id = np.array([self.ids[r[0]] for r in self.rows])

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(queries, nodes): a bound of the inner products of a node's box, and of the sum of their terms' sizes.

        Both are doubles; the first is raised by more than all rounding can take away.
        """
        return _bounds(queries, self.low, self.high, self.extent)

    def search(
        self, query: np.ndarray, bounds: np.ndarray, sizes: np.ndarray, k: int, own_id: int, least: int
    ) -> list[tuple[int, int]]:
        """(score, id) of the best ``k`` rows, best first, leaving out scores below ``least``, which others already fill."""
        best: list[tuple[int, int]] = []  # a heap with the worst in front: score, -id
        open_nodes = [(-int(bounds[0]), int(self.first_id[0]), 0)]
        while open_nodes:
            bound, first_id, node = heapq.heappop(open_nodes)
            if -bound < least or len(best) == k and (-bound, -first_id) < best[0]:
                # Boxes come by falling bound and rising smallest id, so no other box can do better.
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(open_nodes, (-int(bounds[child]), int(self.first_id[child]), child))
                continue
            rows = self.rows[node]
            if sizes[node] < EXACT:
                scores = self.vectors[rows] @ query
            else:
                scores = np.clip(self.vectors[rows].astype(object) @ query.astype(object), LOWEST, HIGHEST)
            floor = max(least, best[0][0]) if len(best) == k else least
            for at in np.flatnonzero(scores >= floor):
                found = (int(scores[at]), -int(self.ids[rows[at]]))
                if -found[1] == own_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return [(score, -neg) for score, neg in sorted(best, reverse=True)]


def integers(vector: Column) -> Column:
    """The vector in integers, or null if it takes no part."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    # Infinite parts are kept out here, as floor() of them is a number.
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when((F.size(vector) > 0) & sound, scaled)


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Answers the queries of each shard; its vectors come before its queries (``side`` 0 before 1)."""
    place, held, tree = None, [], None
    for batch in batches:
        frame = batch.to_pandas()
        for own_place, own in frame.groupby(["dim", "leaf", "shard"], sort=False):
            if own_place != place:
                place, held, tree = own_place, [], None
            vectors, queries = own[own["side"] == 0], own[own["side"] == 1]
            if len(vectors):
                held.append((vectors["vec_id"].to_numpy(np.int64), np.stack(vectors["v"].to_list()).astype(np.int64)))
            if len(queries) and held:
                if tree is None:
                    tree = KDTree(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]))
                for start in range(0, len(queries), QUERY_ROWS):
                    part = queries.iloc[start : start + QUERY_ROWS]
                    asked = np.stack(part["v"].to_list()).astype(np.int64)
                    bounds, sizes = tree.bounds(asked)
                    out = [
                        (own_id, vec_id, score)
                        for own_id, q, b, s, least in zip(part["vec_id"].tolist(), asked, bounds, sizes, part["least"].tolist())
                        for score, vec_id in tree.search(q, b, s, k, own_id, least)
                    ]
                    if out:
                        columns = [pa.array(c, pa.int64()) for c in zip(*out)]
                        yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _cuts(vectors: np.ndarray, leaves: int, first: int = 0):
    """Median cuts (of an odd number of leaves, in proportion) along the widest axis as (axis, cut, part below the cut, part from it); an uncut part is its number."""
    if leaves > 1 and len(vectors) > 1:
        axis = int((vectors.max(0).astype(float) - vectors.min(0)).argmax())
        along = np.sort(vectors[:, axis])
        half = leaves // 2
        cut = along[len(along) * half // leaves]
        if cut == along[0]:  # the first greater value, if there is one
            cut = along[min(np.searchsorted(along, cut, "right"), len(along) - 1)]
        if cut > along[0]:
            below = vectors[:, axis] < cut
            return axis, int(cut), _cuts(vectors[below], half, first), _cuts(vectors[~below], leaves - half, first + half)
    return first


def _placed(vectors: np.ndarray, cuts) -> np.ndarray:
    """The number of the part that each vector falls into."""
    places = np.zeros(len(vectors), np.int32)
    work = [(np.arange(len(vectors)), cuts)]
    while work:
        rows, part = work.pop()
        if isinstance(part, int):
            places[rows] = part
        elif len(rows):
            axis, cut, low, high = part
            below = vectors[rows, axis] < cut
            work += [(rows[below], low), (rows[~below], high)]
    return places


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(length, its rows, their vectors) of a batch with columns ``dim`` and ``v``."""
    for dim in pc.unique(batch.column("dim")).to_pylist():
        own = batch.filter(pc.equal(batch.column("dim"), dim))
        yield dim, own, own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _in_spaces(rows: DataFrame, cuts: dict[int, tuple]) -> DataFrame:
    """``rows`` (vec_id, v, dim) with the number of their space in ``leaf``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own, vectors in _by_length(batch):
                leaf = _placed(vectors, cuts.get(dim, 0))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(leaf, pa.int32())], [*own.schema.names, "leaf"])

    return rows.mapInArrow(run, "vec_id long, v array<long>, dim int, leaf int") if cuts else rows.withColumn("leaf", F.lit(0))


def _find_cuts(rows: DataFrame, shard_rows: int) -> dict[int, tuple]:
    """Cuts by vector length, from a bounded sample (the first by hash): they decide where rows lie, never which are searched."""
    counted = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard_rows)
    lengths = counted.orderBy(F.desc("n"), "dim").limit(CUT_LENGTHS).collect()
    total = sum(r["n"] for r in lengths)
    # Every length has its share of the room for boxes: two numbers of eight bytes per axis.
    leaves = {r["dim"]: min(-(-r["n"] // shard_rows), int(BOX_BYTES * (r["n"] / total) / (16 * r["dim"]))) for r in lengths}
    leaves = {dim: n for dim, n in leaves.items() if n > 1}
    if not leaves:
        return {}
    most = max(1, SAMPLE_BYTES // (8 * max(leaves)))
    sample = rows.where(F.col("dim").isin(*leaves)).orderBy(F.xxhash64("vec_id", "v")).select("dim", "v").limit(most).toPandas()
    return {int(dim): _cuts(np.stack(own.to_list()).astype(np.int64), leaves[dim]) for dim, own in sample.groupby("dim")["v"]}


def _boxes(placed: DataFrame, cuts: dict[int, tuple]) -> dict[int, tuple[np.ndarray, ...]]:
    """(numbers, lowest, highest and largest components) of the spaces of each length that is cut, at most ``BOX_BYTES``."""
    if not cuts:
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for dim, own, vectors in _by_length(batch):
                places = own.column("leaf").to_numpy()
                for leaf in np.unique(places).tolist():
                    mine = vectors[places == leaf]
                    low, high = seen.get((dim, leaf), (mine[0], mine[0]))
                    seen[dim, leaf] = np.minimum(low, mine.min(0)), np.maximum(high, mine.max(0))
        for (dim, leaf), (low, high) in seen.items():
            arrays = pa.array([dim], pa.int32()), pa.array([leaf], pa.int32()), pa.array([low.tolist()]), pa.array([high.tolist()])
            yield pa.RecordBatch.from_arrays(list(arrays), ["dim", "leaf", "low", "high"])

    parts = placed.where(F.col("dim").isin(*cuts)).mapInArrow(run, "dim int, leaf int, low array<long>, high array<long>")
    axes = parts.select("dim", "leaf", F.posexplode(F.arrays_zip("low", "high")).alias("axis", "box"))
    axes = axes.groupBy("dim", "leaf", "axis").agg(F.min("box.low").alias("low"), F.max("box.high").alias("high"))
    whole = axes.groupBy("dim", "leaf").agg(F.array_sort(F.collect_list(F.struct("axis", "low", "high"))).alias("box"))
    found = whole.select("dim", "leaf", F.col("box.low").alias("low"), F.col("box.high").alias("high")).toPandas()
    boxes = {}
    for dim, own in found.groupby("dim"):
        low, high = (np.stack(own[c].to_list()).astype(float) for c in ("low", "high"))
        boxes[int(dim)] = own["leaf"].to_numpy(np.int32), low, high, np.maximum(np.abs(low), np.abs(high))
    return boxes


def _reached(asking: DataFrame, boxes: dict[int, tuple[np.ndarray, ...]], chosen: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """``asking`` (vec_id, v, dim, least) once for each space of its length that ``chosen`` takes by its bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own, vectors in _by_length(batch):
                for start in range(0, own.num_rows, QUERY_ROWS):
                    block = own.slice(start, QUERY_ROWS)
                    if dim in boxes:
                        leaves, *box = boxes[dim]
                        bounds, _ = _bounds(vectors[start : start + QUERY_ROWS], *box)
                        query, at = np.nonzero(chosen(bounds, block.column("least").to_numpy()))
                        leaf = leaves[at]
                    else:
                        query, leaf = np.arange(block.num_rows), np.zeros(block.num_rows, np.int32)
                    taken = block.take(pa.array(query))
                    yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaf, pa.int32())], [*taken.schema.names, "leaf"])

    return asking.select("vec_id", "v", "dim", "least").mapInArrow(run, "vec_id long, v array<long>, dim int, least long, leaf int")


def _best(bounds: np.ndarray, least: np.ndarray) -> np.ndarray:
    return np.arange(bounds.shape[1]) == bounds.argmax(1)[:, None]


def _promising(bounds: np.ndarray, least: np.ndarray) -> np.ndarray:
    # A score as a double may be too high by its rounding; cut scores are not below the lowest number.
    return np.maximum(bounds, float(LOWEST)) >= np.nextafter(least.astype(float), -np.inf)[:, None]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its ``k`` best rows of ``vectors``, both (vec_id, embedding).

    Median cuts divide the vectors of a length into spaces of about ``shard_rows``, each with a tight box; a space that holds
    more is dealt by hash into shards. A query first searches a shard of the space with the highest bound; its kth score
    there goes with it to the spaces whose boxes can reach it, and inside their trees other boxes are never opened. Queries
    reach a shard in blocks, so a task holds one shard and one block.
    """
    rows = settled(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding")).alias("v"))
        .where("vec_id is not null and v is not null")
        .withColumn("dim", F.size("v"))
    )
    asked = (
        queries.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding")).alias("v"))
        .where("vec_id is not null and v is not null")
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
        .withColumn("dim", F.size("v"))
    )
    cuts = _find_cuts(rows, shard_rows)
    placed = _in_spaces(rows, cuts)
    boxes = _boxes(placed, cuts)
    spaces = settled(placed.groupBy("dim", "leaf").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards")))
    # The table of spaces is broadcast if it has few rows; otherwise no length is frequent enough to be hot.
    spaces = F.broadcast(spaces) if spaces.count() <= FEW else spaces
    shard = F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int")
    columns = ["dim", "leaf", "shard", "side", "vec_id", "v", "least"]
    dealt = placed.join(spaces, ["dim", "leaf"]).withColumns({"shard": shard, "side": F.lit(0), "least": F.lit(NONE_YET)}).select(*columns)
    homes = _reached(asked.withColumn("least", F.lit(NONE_YET)), boxes, _best).join(spaces, ["dim", "leaf"])
    homes = settled(homes.select("vec_id", "v", "dim", "least", "leaf", shard.alias("shard")))

    def searched(asking: DataFrame) -> DataFrame:
        meeting = dealt.union(asking.withColumn("side", F.lit(1)).select(*columns))
        n = partitions(vectors.sparkSession)
        ordered = meeting.repartition(n, "dim", "leaf", "shard").sortWithinPartitions("dim", "leaf", "shard", "side")
        return ordered.mapInArrow(lambda b: _searched(b, k), FOUND)

    first = settled(searched(homes))
    kth = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(NONE_YET).alias("kth"))
    scored = homes.join(kth, F.col("vec_id") == F.col("query_id"), "left").withColumn("least", F.coalesce("kth", F.lit(NONE_YET)))
    others = _reached(scored, boxes, _promising).join(spaces, ["dim", "leaf"])
    others = others.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    others = others.join(homes.select("vec_id", "leaf", "shard"), ["vec_id", "leaf", "shard"], "left_anti")
    return _ranked(first.union(searched(others)), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
