"""Exact top-k by inner product as a Voronoi join: cells around pivots, bounds per group of queries,
local solutions, merged ranks."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged

MAX_PIVOTS = 2048  # bounds the table of distances between pivots; there are as many as the root of the rows
SAMPLED = 4  # rows looked at for each pivot
WIDER = 1.25  # cells of queries are solved together if none meets more than so many times the rows it needs
GROUP_QUERIES = 2000  # queries solved together
BLOCK_ROWS = 20_000  # rows a group is compared with at a time
BROADCAST_NEEDS = 500_000  # lines of 40 bytes
EXACT = float(1 << 53)


def integral(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, NULL where a component is NULL or not finite."""
    doubles = embedding.cast("array<double>")
    good = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(doubles, lambda x: F.floor(x * scale)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    out, sizes = np.zeros((len(column), width), np.int64), np.diff(offsets)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values[offsets[0]:offsets[-1]]
    return out


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exact for any components whose products fit a long."""
    reach = max(1, queries.shape[1]) * float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0))
    if reach < EXACT:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if reach < 2.0 ** 63:
        return queries @ rows.T
    wide = queries.astype(object) @ rows.T.astype(object)
    return np.clip(wide, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.nonzero(scores >= edge)[0]
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


class Cells:
    """Distances to pivots in a space where the nearest row has the highest inner product.

    Rows get one more component that brings all to the longest row's length; queries get 0 there."""

    def __init__(self, pivots: np.ndarray, longest: float) -> None:
        self.longest = longest
        self.pivots = self.raised(pivots.astype(np.float64))

    def raised(self, rows: np.ndarray, queries: bool = False) -> np.ndarray:
        short = 0.0 if queries else np.sqrt(np.maximum(self.longest - (rows * rows).sum(axis=1), 0.0))
        return np.hstack([rows, np.broadcast_to(np.reshape(short, (-1, 1)), (len(rows), 1))])

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        squares = (points * points).sum(1)[:, None] + (self.pivots * self.pivots).sum(1) - 2 * points @ self.pivots.T
        cell = squares.argmin(axis=1)
        return cell, np.sqrt(np.maximum(squares[np.arange(len(points)), cell], 0.0))


def _placed(rows: DataFrame, cells: Cells, width: int) -> DataFrame:
    """Adds the cell and the distance to its pivot, as a row and (``qcell, qdistance``) as a query."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = _matrix(b.column(2), width).astype(np.float64)
            cell, distance = cells.nearest(cells.raised(points))
            qcell, qdistance = cells.nearest(cells.raised(points, queries=True))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(cell.astype(np.int32)), pa.array(distance), pa.array(qcell.astype(np.int32)),
                 pa.array(qdistance)], names=["vec_id", "query", "vector", "cell", "distance", "qcell", "qdistance"])

    return rows.mapInArrow(each, "vec_id long, query boolean, vector array<bigint>, cell int, distance double, "
                                 "qcell int, qdistance double")


@dataclass(frozen=True)
class Plan:
    """Which rows go to which group of cells of queries.

    ``groups``: cells of queries; ``low, high`` (cells of queries x cells of rows): distances to the
    pivot between which a row may be among a query's k nearest, ``low > high`` where none can;
    ``sent``: rows per group, at most. ``compared`` and ``all_pairs`` count pairs of query and row.
    """

    groups: list[list[int]]
    asked: list[int]
    low: np.ndarray
    high: np.ndarray
    sent: list[int]
    compared: int
    all_pairs: int


def join_plan(cells: Cells, queries: dict[int, tuple[int, float]], rows: dict[int, tuple[int, float, float]],
              nearest: dict[int, list[float]], k: int) -> Plan:
    """From summaries of the cells: ``queries`` number and largest distance to the pivot, ``rows``
    number, smallest and largest distance, ``nearest`` the k + 1 smallest distances, by cell.

    The k + 1 nearest rows to the pivots bound how far the k-th neighbour of a cell's queries can be
    (one of them may be the query itself). Cells of queries that need nearly the same rows are
    solved together, those that need different ones are not, however near.
    """
    apart = _apart(cells.pivots)
    slack = 1e-6 * (1 + np.sqrt(cells.longest))
    n_cells = len(cells.pivots)
    counts, least, most = np.zeros(n_cells, np.int64), np.full(n_cells, np.inf), np.full(n_cells, -np.inf)
    for c, (n, near, far) in rows.items():
        counts[c], least[c], most[c] = n, near, far
    low, high = np.full((n_cells, n_cells), np.inf), np.full((n_cells, n_cells), -np.inf)
    owner = np.repeat(list(nearest), [len(d) for d in nearest.values()])
    at = np.concatenate([np.asarray(d, float) for d in nearest.values()])
    for c, (_, far) in queries.items():
        upper = far + apart[c, owner] + at
        reach = np.partition(upper, k)[k] if len(upper) > k else np.inf
        # a row at distance d from its pivot is at least | apart - d | - far from every query of the cell
        low[c] = np.maximum(least, apart[c] - far - reach - slack)
        high[c] = np.minimum(most, apart[c] + far + reach + slack)
    needs = low <= high
    left, groups = sorted(queries, key=lambda c: (-queries[c][0], c)), []
    while left:
        seed, group = left[0], [left[0]]
        union, held, fewest = needs[seed].copy(), queries[seed][0], counts[needs[seed]].sum()
        for c in sorted(left[1:], key=lambda c: (apart[seed, c], c)):
            both, fewer = union | needs[c], min(fewest, counts[needs[c]].sum())
            if held + queries[c][0] <= GROUP_QUERIES and counts[both].sum() <= WIDER * fewer:
                group.append(c)
                union, held, fewest = both, held + queries[c][0], fewer
        groups.append(group)
        left = [c for c in left if c not in set(group)]
    asked = [sum(queries[c][0] for c in g) for g in groups]
    sent = [int(counts[needs[g].any(axis=0)].sum()) for g in groups]
    return Plan(groups, asked, low, high, sent, sum(a * b for a, b in zip(asked, sent)), sum(asked) * int(counts.sum()))


def _spread(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the points, each the farthest from those before it."""
    floats = points.astype(np.float64)
    chosen, near = [0], np.full(len(points), np.inf)
    while len(chosen) < min(n, len(points)):
        near = np.minimum(near, ((floats - floats[chosen[-1]]) ** 2).sum(axis=1))
        chosen.append(int(near.argmax()))
    return points[chosen]


def _apart(points: np.ndarray) -> np.ndarray:
    """Distances between points, without a table of their differences."""
    squares = (points * points).sum(1)
    return np.sqrt(np.maximum(squares[:, None] + squares[None, :] - 2 * points @ points.T, 0.0))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, *, pivots: int | None = None,
          report: Callable[[Plan], None] | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of highest inner product with each query.

    ``vectors`` has ``vec_id, vector`` (longs). Pivots are far apart rows of a sample by hash, as many
    as the root of the number of rows. Every query and row belongs to the cell of its nearest pivot. From the
    distances of the k + 1 rows nearest to each pivot and the width of a cell of queries follows a
    bound that the k-th neighbour of any query of the cell keeps; a row goes to a group of such
    cells only if its distance to its pivot lets it come that near, and is sent once to a group.
    Groups are split by their number of queries and of rows into blocks, so a crowded cell is many
    tasks; each solves its part and the parts' ranks are merged. ``report`` is given the plan.

    A query's own id is no candidate. Of repeated ids the smallest vector counts, NULL ids and
    vectors take no part, shorter vectors are filled with zeros, scores beyond a long stop at its
    ends. No rows, or no queries: no rows.
    """
    spark = vectors.sparkSession
    rows = staged(
        vectors.filter("vec_id is not null and vector is not null").groupBy(F.col("vec_id").cast("long").alias("vec_id"))
        .agg(F.min("vector").alias("vector")).select("vec_id", F.coalesce(is_query, F.lit(False)).alias("query"), "vector"),
        "vectors")
    told = "query_id long, rank int, vec_id long, score long"
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    width, longest = rows.agg(F.max(F.size("vector")), F.max(square)).first()
    if not width:
        if width is None:
            return spark.createDataFrame([], told)
        width = 1  # empty vectors: every product is 0
    total = rows.count()
    pivots = pivots or min(MAX_PIVOTS, math.isqrt(total) + 1)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLED * pivots).select("vector").collect()
    points = np.array([r.vector + [0] * (width - len(r.vector)) for r in sample], np.int64)
    cells = Cells(_spread(points, pivots), longest)
    placed = staged(_placed(rows, cells, width), "cells")

    # summaries: a few numbers per cell
    of_queries = {r.qcell: (r.n, r.far) for r in placed.filter("query").groupBy("qcell").agg(
        F.max("qdistance").alias("far"), F.count("*").alias("n")).collect()}
    if not of_queries:
        return spark.createDataFrame([], told)
    ordered = Window.partitionBy("cell").orderBy("distance")
    nearest = {r.cell: r.d for r in placed.select("cell", "distance").withColumn("r", F.row_number().over(ordered))
               .filter(F.col("r") <= k + 1).groupBy("cell").agg(F.collect_list("distance").alias("d")).collect()}
    of_rows = {r.cell: (r.n, r.near, r.far) for r in placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("distance").alias("near"), F.max("distance").alias("far")).collect()}
    plan = join_plan(cells, of_queries, of_rows, nearest, k)
    if report:
        report(plan)

    member, needs = [], []
    for g, group in enumerate(plan.groups):
        split = (max(1, -(-plan.asked[g] // GROUP_QUERIES)), max(1, -(-plan.sent[g] // BLOCK_ROWS)))
        member += [(c, g, *split) for c in group]
        low, high = plan.low[group], plan.high[group]
        needed = low <= high
        low, high = np.where(needed, low, np.inf).min(axis=0), np.where(needed, high, -np.inf).max(axis=0)
        needs += [(int(cell), g, *split, float(low[cell]), float(high[cell])) for cell in np.nonzero(needed.any(axis=0))[0]]
    asked = spark.createDataFrame(member, "c int, g int, parts int, blocks int")
    wanted = spark.createDataFrame(needs, "c int, g int, parts int, blocks int, low double, high double")
    # as many lines as cells that can hold neighbours, per group: broadcast up to a size
    wanted = F.broadcast(wanted) if len(needs) <= BROADCAST_NEEDS else wanted
    data = placed.join(wanted, (F.col("cell") == F.col("c")) & F.col("distance").between(F.col("low"), F.col("high"))) \
        .select("g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), "vec_id", "vector")
    queries = placed.filter("query").join(F.broadcast(asked), F.col("qcell") == F.col("c")) \
        .select("g", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"),
                F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                F.col("vec_id").alias("vec_id"), F.col("vector").alias("vector"))

    def solve(asking: pa.Table, given: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if asking.num_rows and given.num_rows:
            qid = asking.column("vec_id").to_numpy()
            ids = given.column("vec_id").to_numpy()
            scores = products(_matrix(asking.column("vector").combine_chunks(), width),
                              _matrix(given.column("vector").combine_chunks(), width))
            for i, q in enumerate(qid):
                places = best(scores[i], ids, k + 1)
                places = places[ids[places] != q][:k]
                out += [(int(q), int(ids[p]), int(scores[i, p])) for p in places]
        q, v, s = zip(*out) if out else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.int64())})

    parts = queries.groupBy("g", "part", "block").cogroup(data.groupBy("g", "part", "block")) \
        .applyInArrow(solve, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return parts.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
