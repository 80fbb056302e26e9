"""Centroid clustering of integer vectors kept as bit planes: one 64-bit word holds one bit of all 64
components, and weighted popcounts of ANDed words are exact products."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged

WIDTH = 64
REACH = 1 << 61  # components beyond it count as it
SAFE_DEPTH = 27  # planes up to which all distances fit a long
LONGEST = (1 << 63) - 1


def integers(embedding: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of the 64 components; NULL for another number of them, and where one is NULL
    or not finite."""
    doubles = embedding.cast("array<double>")
    good = (F.size(doubles) == WIDTH) & F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = F.transform(doubles, lambda x: F.least(F.greatest(F.floor(x * scale), F.lit(-REACH)), F.lit(REACH)))
    return F.when(good, held)


def depth_of(low: int, high: int) -> int:
    """Planes that two's complement of ``low .. high`` needs."""
    return max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1


def packed(values: np.ndarray, depth: int) -> np.ndarray:
    """Rows of 64 longs to ``depth`` rows of words: bit j of word i of a vector is bit i of its
    component j."""
    out = np.empty((depth, len(values)), np.uint64)
    for i in range(depth):
        bits = ((values >> np.int64(i)) & 1).astype(np.uint8)
        out[i] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def weights(depth: int) -> list[int]:
    """What a bit of each plane is worth; the last plane is the sign."""
    return [1 << i for i in range(depth - 1)] + [-(1 << (depth - 1))]


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of all vectors of ``left`` with all of ``right``, both as planes: each pair of
    planes adds the weighted number of components with both bits. Python's integers where a long
    could overflow."""
    worth = weights(len(left))
    wide = len(left) > SAFE_DEPTH
    out = np.zeros((left.shape[1], right.shape[1]), object if wide else np.int64)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            both = np.bitwise_count(a[:, None] & b)
            out += (both.astype(object) if wide else both.astype(np.int64)) * (worth[i] * worth[j])
    return out


def squares(planes: np.ndarray) -> np.ndarray:
    """Squared lengths, the same way."""
    worth = weights(len(planes))
    wide = len(planes) > SAFE_DEPTH
    out = np.zeros(planes.shape[1], object if wide else np.int64)
    for i, a in enumerate(planes):
        for j in range(i + 1):
            both = np.bitwise_count(a & planes[j])
            out += (both.astype(object) if wide else both.astype(np.int64)) * (worth[i] * worth[j] * (1 + (i != j)))
    return out


def component_sums(planes: np.ndarray, group: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
    """For each group its number, its vectors and their componentwise sums: the ones of each plane's
    columns, weighted."""
    order = np.argsort(group, kind="stable")
    number, first, count = np.unique(group[order], return_index=True, return_counts=True)
    if not len(number):
        return
    sums = np.zeros((len(number), WIDTH), object)
    for worth, plane in zip(weights(len(planes)), planes):
        bits = np.unpackbits(plane[order].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums += np.add.reduceat(bits, first, axis=0, dtype=np.int64).astype(object) * worth
    for g, n, row in zip(number.tolist(), count.tolist(), sums.tolist()):
        yield g, n, row


@dataclass(frozen=True)
class Centroids:
    """Centroids as integers; ``nearest`` works on their planes."""

    values: list[list[int]]
    depth: int

    def nearest(self, planes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (the smaller of equal ones) and the squared distance."""
        own = packed(np.array(self.values, np.int64), self.depth)
        apart = squares(planes)[:, None] - 2 * products(planes, own) + squares(own)
        number = apart.argmin(axis=1).astype(np.int64)
        return number, apart[np.arange(len(number)), number]

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.values]


def planes_table(vectors: DataFrame, depth: int) -> DataFrame:
    """``vec_id, planes``: the vectors as ``depth`` words each, written once for all rounds."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
            words = packed(values, depth).T.copy().view(np.int64).ravel()
            ends = np.arange(0, len(words) + 1, depth, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(words))], names=["vec_id", "planes"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return staged(vectors.mapInArrow(each, f"vec_id {kind}, planes array<bigint>"), "planes")


def _words(column: pa.Array, depth: int) -> np.ndarray:
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, depth).T)


def moved(planes: DataFrame, centroids: Centroids) -> Centroids:
    """The centroids after one round: componentwise floor of the means, empty ones as they were.
    Tasks send sums per centroid, the driver gets as many numbers as the centroids have."""
    depth = centroids.depth

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for b in batches:
            words = _words(b.column(0), depth)
            for g, n, sums in component_sums(words, centroids.nearest(words)[0]):
                held = total.setdefault(g, [0, [0] * WIDTH])
                held[0] += n
                held[1] = [x + y for x, y in zip(held[1], sums)]
        rows = [(g, j, n, s) for g, (n, sums) in total.items() for j, s in enumerate(sums)]
        cluster, place, n, sums = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(n, pa.int64()),
             pa.array(sums, pa.decimal128(38, 0))], names=["cluster", "place", "n", "s"])

    summed = planes.select("planes").mapInArrow(each, "cluster int, place int, n long, s decimal(38,0)") \
        .groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))
    new = [list(c) for c in centroids.values]
    for r in summed.collect():  # one row per centroid and component
        new[r.cluster][r.place] = int(r.s) // r.n
    return Centroids(new, depth)


def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of ``vec_id, vector``
    (64 longs each; rows with a NULL vector take no part).

    The ``k`` vectors with the smallest sha256 of ``seed:vec_id`` start as centroids (all, if there are
    fewer; those of equal ids by their components, a NULL id last). Each round assigns every vector
    to the nearest centroid, ties to the smaller number, and moves the centroids to the floor of the
    means; then vectors are assigned once more. Distances are exact squares; one beyond a long is
    given as the longest long, as sums of them are. Repeated rows count each; other columns are
    ignored. No vectors, no rows.
    """
    kept = vectors.filter("vector is not null").select("vec_id", "vector")
    ends = kept.agg(F.min(F.array_min("vector")).alias("low"), F.max(F.array_max("vector")).alias("high")).first()
    kind = vectors.schema["vec_id"].dataType.simpleString()
    told = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if ends.low is None:
        return vectors.sparkSession.createDataFrame([], told)
    depth = depth_of(ends.low, ends.high)
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.orderBy(rank.asc_nulls_last(), "vector").limit(k).collect()
    centroids = Centroids([list(r.vector) for r in first], depth)
    planes = planes_table(kept, depth)
    for _ in range(rounds):
        before, centroids = centroids, moved(planes, centroids)
        if before == centroids:
            break  # further rounds change nothing

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number, apart = centroids.nearest(_words(b.column(1), depth))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(number.astype(np.int32)), pa.array([min(int(a), LONGEST) for a in apart], pa.int64())],
                names=["vec_id", "cluster", "distance"])

    assigned = staged(planes.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "assigned")
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}

    def by_cluster(values: list) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))

    inertia = [min(sums.get(i, 0), LONGEST) for i in range(len(centroids.values))]
    return assigned.select(
        "vec_id", "cluster", "distance", by_cluster(inertia).cast("long").alias("cluster_inertia"),
        F.lit(min(sum(sums.values()), LONGEST)).cast("long").alias("inertia"),
        by_cluster(centroids.digests()).alias("centroid_sha256"))
