"""Exact top-k inner product search with ball trees, one per shard of a cell."""

from __future__ import annotations

import heapq
from itertools import count, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources import stage, unstage

#: Vectors per shard, vectors per leaf, and queries that walk a tree together.
SHARD, LEAF, BLOCK = 4096, 64, 512
#: Cells are smaller than shards: a smaller ball has a closer bound.
CELLS_PER_SHARD = 8
#: Vectors from which centres are learned, centres at most, and moves of a centre.
SAMPLE, MOST_CELLS, MOVES = 4096, 1024, 4
#: Places of a query's cells, by bound, at which a round ends and floors are refreshed.
ROUNDS = (1, 4)


class BallTree:
    """Nodes ``(centre, radius, members, children)`` over the rows of a matrix."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.leaf = points, leaf
        self.root = self._node(np.arange(len(points)))

    def _node(self, members: np.ndarray) -> tuple:
        own = self.points[members]
        centre = own.mean(axis=0)
        distances = np.linalg.norm(own - centre, axis=1)
        children = ()
        if len(members) > self.leaf and distances.max() > 0:
            # Split between the point furthest from the centre and the one furthest from that.
            a = own[distances.argmax()]
            b = own[np.linalg.norm(own - a, axis=1).argmax()]
            order = np.argsort(own @ (b - a), kind="stable")
            half = len(order) // 2
            children = (self._node(members[order[:half]]), self._node(members[order[half:]]))
        return centre, float(distances.max()), members, children


def _bound(queries: np.ndarray, lengths: np.ndarray, node: tuple) -> np.ndarray:
    """No point of the node has a greater inner product; rounding is allowed for."""
    middle, reach = queries @ node[0], lengths * node[1]
    return middle + reach + 1e-9 * (1 + np.abs(middle) + reach + lengths * np.linalg.norm(node[0]))


def tree_search(
    tree: BallTree, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, floors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of each query's best points, ties to the smaller id; -inf where there are fewer.

    The queries walk the tree together, node with the greatest bound first. A query
    goes into a node only if the bound there reaches its k-th score so far, which
    starts at its floor: the k-th score that another shard has already found.
    """
    n = len(queries)
    lengths = np.linalg.norm(queries, axis=1)
    scores = np.full((n, k), -np.inf)
    found = np.full((n, k), np.iinfo(np.int64).max)
    turn = count()
    bound = _bound(queries, lengths, tree.root)
    heap = [(-bound.max(), next(turn), tree.root, np.arange(n), bound)]
    while heap:
        _, _, node, rows, bound = heapq.heappop(heap)
        reached = bound >= np.maximum(scores[rows, -1], floors[rows])
        rows = rows[reached]
        if not len(rows):
            continue
        if node[3]:
            for child in node[3]:
                bound = _bound(queries[rows], lengths[rows], child)
                heapq.heappush(heap, (-bound.max(), next(turn), child, rows, bound))
            continue
        for at in range(0, len(node[2]), 4 * LEAF):  # equal points make a large leaf
            members = node[2][at : at + 4 * LEAF]
            fresh = queries[rows] @ tree.points[members].T
            fresh[own[rows, None] == ids[None, members]] = -np.inf
            both = np.concatenate((scores[rows], fresh), axis=1)
            names = np.concatenate((found[rows], np.broadcast_to(ids[members], fresh.shape)), axis=1)
            order = np.lexsort((names, -both), axis=1)[:, :k]
            scores[rows] = np.take_along_axis(both, order, axis=1)
            found[rows] = np.take_along_axis(names, order, axis=1)
    return scores, found


def _search(rows: DataFrame, k: int) -> DataFrame:
    """``(query_id, id, score)``: each shard's best of each query sent to it.

    Rows ``(shard, kind, id, vector, floor)``; a shard's vectors (kind 0) come
    before its queries (kind 1), so a task holds one shard and a block of queries.
    """

    def walk(batches):
        shard, ids, points, tree, waiting = None, [], [], None, []

        def answer():
            nonlocal tree
            if not waiting or not ids:
                waiting.clear()
                return
            if tree is None:
                tree = BallTree(np.array(points, np.float64))
            own = np.array([w[0] for w in waiting], np.int64)
            matrix = np.array([w[1] for w in waiting], np.float64)
            floors = np.array([w[2] for w in waiting], np.float64)
            scores, found = tree_search(tree, np.array(ids, np.int64), matrix, own, floors, k)
            waiting.clear()
            row, column = np.nonzero(scores > -np.inf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[row]), pa.array(found[row, column]), pa.array(scores[row, column])],
                ["query_id", "id", "score"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("shard", "kind", "id", "vector", "floor")]
            for name, kind, key, vector, floor in zip(*columns, strict=True):
                if name != shard:
                    yield from answer()
                    shard, ids, points, tree = name, [], [], None
                if kind == 0:
                    ids.append(key)
                    points.append(vector)
                else:
                    waiting.append((key, vector, floor))
                    if len(waiting) == BLOCK:
                        yield from answer()
        yield from answer()

    ordered = rows.repartition("shard").sortWithinPartitions("shard", "kind", "id")
    return ordered.mapInArrow(walk, "query_id long, id long, score double")


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


class Cells:
    """Where vectors lie: centres by length of vector, and how far a cell's vectors are from its centre.

    Of a length without centres all vectors are in cell 0, which every query of that length searches.
    """

    def __init__(self, centres: dict[int, np.ndarray]):
        self.centres = centres
        self.reach = {dims: np.zeros(len(own)) for dims, own in centres.items()}

    def nearest(self, vectors: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector and its distance from the centre."""
        cell, far = np.zeros(len(vectors), np.int32), np.zeros(len(vectors))
        lengths = np.array([len(v) for v in vectors])
        for dims, own in self.centres.items():
            rows = np.flatnonzero(lengths == dims)
            if len(rows):
                x = np.array([vectors[i] for i in rows])
                gaps = (own**2).sum(axis=1) - 2 * (x @ own.T)
                cell[rows] = gaps.argmin(axis=1)
                far[rows] = np.linalg.norm(x - own[cell[rows]], axis=1)
        return cell, far

    def reached(self, vector: list[float], floor: float, first: int, last: int | None) -> list[int]:
        """Of a query's cells, greatest bound first, those from place ``first`` to ``last`` that may hold its floor."""
        own = self.centres.get(len(vector))
        if own is None:
            return [0] if not first else []
        query = np.array(vector)
        length = np.linalg.norm(query)
        middle, reach = own @ query, length * self.reach[len(vector)]
        bound = middle + reach + 1e-9 * (1 + np.abs(middle) + reach + length * np.linalg.norm(own, axis=1))
        order = np.argsort(-bound, kind="stable")[first:last]
        return order[bound[order] >= floor].tolist()


def _centres(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` centres at most: points far from each other, moved to the means of what is nearest to them."""
    rng = np.random.default_rng(7)
    chosen = [int(rng.integers(len(sample)))]
    gaps = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < n and gaps.max() > 0:
        chosen.append(int(rng.choice(len(sample), p=gaps / gaps.sum())))
        gaps = np.minimum(gaps, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    centres = sample[chosen]
    for _ in range(MOVES):
        nearest = ((centres**2).sum(axis=1) - 2 * (sample @ centres.T)).argmin(axis=1)
        for i in np.unique(nearest):
            centres[i] = sample[nearest == i].mean(axis=0)
    return centres


def learn_cells(vectors: DataFrame, cell: int) -> Cells:
    """Centres for cells of about ``cell`` rows of ``(id, vector, dims)``, from a sample of ``SAMPLE`` rows.

    At most ``MOST_CELLS`` cells: with more rows they hold more, and are dealt into several shards.
    """
    rows = vectors.orderBy(F.xxhash64("id", "vector"), "id").limit(SAMPLE).select("dims", "vector").collect()
    there = sorted({row.dims for row in rows})
    counts = vectors.where(F.col("dims").isin(there)).groupBy("dims").count().collect() if there else []
    sizes = {row.dims: row["count"] for row in counts}
    samples = {dims: np.array([row.vector for row in rows if row.dims == dims], np.float64) for dims in there}
    return Cells({dims: _centres(own, min(MOST_CELLS, -(-sizes[dims] // cell))) for dims, own in samples.items()})


_SHARD = ("dims", "cell", "part")


def sent(asked: DataFrame, cells: Cells, first: int, last: int | None) -> DataFrame:
    """``(dims, cell, id, vector, floor)``: queries, and the cells from place ``first`` to ``last`` they search."""

    @F.arrow_udf("array<int>")
    def reached(vectors: pa.Array, floors: pa.Array) -> pa.Array:
        pairs = zip(vectors.to_pylist(), floors.to_pylist(), strict=True)
        return pa.array([cells.reached(v, f, first, last) for v, f in pairs], pa.list_(pa.int32()))

    return asked.select("dims", F.explode(reached("vector", "floor")).alias("cell"), "id", "vector", "floor")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "vector", shard: int = SHARD
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` greatest inner products of each query, exactly.

    Candidates are all ``vectors`` with another key than the query's; ties go to
    the smaller key. Vectors are dealt into cells around centres, so that a cell is a ball, and
    a cell of more than ``shard`` rows into shards. In each round a query goes to some of its cells,
    greatest bound first, but only where the bound reaches its floor: the k-th score found in the
    rounds before. The last round has all cells that are left. Vectors that are null, empty, or hold
    null or non-finite components, and rows with a null key, take no part.
    Vectors of different length are not compared. A key given twice among the
    queries is asked once, by its smaller vector; among the candidates, each row
    counts. Scores are exact while they fit a double's 53 bits.
    """

    def read(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        return rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("dims", F.size("vector"))

    asked = stage(read(queries).groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dims", F.size("vector")), "queries")
    known = read(vectors)
    cells = learn_cells(known, max(1, shard // CELLS_PER_SHARD))

    @F.arrow_udf("cell int, far double")
    def placed(own: pa.Array) -> pa.Array:
        cell, far = cells.nearest(own.to_pylist())
        return pa.StructArray.from_arrays([pa.array(cell), pa.array(far)], ["cell", "far"])

    in_cells = known.withColumn("place", placed("vector")).withColumn("number", F.monotonically_increasing_id())
    # Written out: all rounds must see the same shards.
    dealt = stage(in_cells.select("dims", "place.*", "id", "vector", "number"), "cells")
    sizes = dealt.groupBy("dims", "cell").agg(F.max("far").alias("far"), F.ceil(F.count("*") / shard).cast("long").alias("shards"))
    sizes = stage(sizes, "sizes")
    # One row per centre: MOST_CELLS for each length of vector in the sample.
    for row in sizes.where(F.col("dims").isin(list(cells.centres))).collect() if cells.centres else ():
        cells.reach[row.dims][row.cell] = row.far
    part = (F.col("number") % F.col("shards")).alias("part")
    candidates = dealt.join(sizes.drop("far"), ["dims", "cell"]).select(
        "dims", "cell", part, F.lit(0).alias("kind"), "id", "vector", F.lit(0.0).alias("floor")
    )
    nothing = F.lit(float("-inf"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    found, floors = None, None
    for first, last in pairwise([0, *ROUNDS, None]):
        informed = asked.withColumn("floor", nothing)
        if floors is not None:
            informed = asked.join(floors, asked["id"] == floors["query_id"], "left").select(*asked.columns, F.coalesce("kth", nothing).alias("floor"))
        to = sent(informed, cells, first, last).join(sizes.drop("far"), ["dims", "cell"])
        parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("part")
        going = stage(to.select("dims", "cell", parts, F.lit(1).alias("kind"), "id", "vector", "floor"), "going")
        wanted = candidates.join(going.select(*_SHARD).distinct(), list(_SHARD), "left_semi")
        both = wanted.unionByName(going)
        fresh = _search(both.select(F.struct(*_SHARD).alias("shard"), "kind", "id", "vector", "floor"), k)
        rows = fresh if found is None else found.unionByName(fresh)
        ranked = rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        before, found = found, stage(ranked.select("query_id", "id", "score"), "found")
        unstage(going, *([before] if before is not None else []))
        kth = F.when(F.count("*") == k, F.min("score")).otherwise(nothing).alias("kth")
        floors = found.groupBy("query_id").agg(kth)
    unstage(dealt)
    ranked = found.withColumn("rank", F.row_number().over(best))
    return ranked.select("query_id", "rank", "id", "score")


def oracle_sql(table: str = "embeddings", k: int = 5) -> str:
    """The contract's rows, as DuckDB SQL that compares all pairs."""
    return f"""
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as vector from {table}
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, v.vec_id, list_inner_product(q.vector, v.vector)::bigint as score
  from vectors q join vectors v on q.vec_id <> v.vec_id and len(q.vector) = len(v.vector)
  where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= {k}"""
