"""Prefix tries of conversations: sequences are sorted, a sparse table over the common prefixes of
neighbours answers range minima, and each candidate prefix searches its members' interval by itself.

The sorted sequences are cut into slices. A slice finds all nodes of its sequences; nodes that reach
beyond it give partial sums, which meet under the node's first slice and depth. Which nodes do is
read from the same table over the first and last sequences of all slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .columns import WORD, whole

DIGEST = 32  # characters of a turn in a path
SLICE_BYTES = 4 << 20  # paths sorted and searched together
CHUNK_BITS = 8  # ids of one path are hashed in pieces of so many bits
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, " \
       "saved_tokens long, ends_sha256 string"
NOTHING = hashlib.sha256(b"").hexdigest()


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, path, words`` of ``conv_id, turn, role, text``: the conversation's turns in order
    as one string of digests of (role, text), and the words of each turn's text.

    NULL turns come first; turns of one number are ordered by digest; a NULL role or text is empty.
    Rows without a ``conv_id`` are left out. Texts stay where they are read: a conversation is
    gathered as 36 bytes a turn.
    """
    role, text = whole(F.col("role")), whole(F.col("text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, DIGEST)
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", digest.alias("digest"),
                 F.regexp_count(text, F.lit(WORD)).alias("words")).alias("turn"))
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return ordered.select("conv_id", F.array_join("turns.digest", "").alias("path"), F.col("turns.words").alias("words"))


def rebuilt(own: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Sequences that begin as others do: conversation c takes the first h turns of conversation
    ``c - c % every`` in place of its own first h, h = crc32(c) % ``heads``. A missing or shorter one
    gives what it has."""
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    head = own.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.substring("path", 1, DIGEST * heads).alias("head"),
        F.slice("words", 1, heads).alias("head_words"))
    none = F.array().cast("array<int>")
    met = own.withColumn("h", h).join(head, F.col("conv_id") - F.col("conv_id") % every == F.col("base"), "left")
    return met.select(
        "conv_id",
        F.concat(F.coalesce(F.expr(f"substring(head, 1, {DIGEST} * h)"), F.lit("")), F.expr(f"substring(path, {DIGEST} * h + 1)")).alias("path"),
        F.concat(F.coalesce(F.expr("slice(head_words, 1, h)"), none), F.expr("slice(words, h + 1, greatest(size(words), 1))")).alias("words"))


def distinct_paths(given: DataFrame) -> DataFrame:
    """``path, words, n, least, ends``: each different path with its conversations, the smallest id
    and the digest of all their ids in order.

    Ids of a path are sorted in pieces; the pieces pass through one running digest, so a path that
    a third of all conversations share is a stream of short texts.
    """
    pieces = given.groupBy("path", F.shiftright("conv_id", CHUNK_BITS).alias("piece")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"), F.first("words").alias("words"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, held = None, None

        def told(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.string(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["path", "words", "n", "least", "ends"])

        for b in batches:
            done = []
            for p, ids, words in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                text = ",".join(map(str, ids)).encode()
                if p == path:
                    held[1] += len(ids)
                    held[3].update(b"," + text)
                    continue
                if held:
                    done.append((path, held[0], held[1], held[2], held[3].hexdigest()))
                path, held = p, [words, len(ids), ids[0], hashlib.sha256(text)]
            yield told(done)
        if held:
            yield told([(path, held[0], held[1], held[2], held[3].hexdigest())])

    ordered = pieces.repartition("path").sortWithinPartitions("path", "piece")
    return ordered.mapInArrow(each, "path string, words array<int>, n long, least long, ends string")


def common(a: str, b: str) -> int:
    """Turns at the start that two paths share."""
    n, most = 0, min(len(a), len(b)) // DIGEST
    while n < most and a[n * DIGEST:(n + 1) * DIGEST] == b[n * DIGEST:(n + 1) * DIGEST]:
        n += 1
    return n


class Minima:
    """Sparse table: minima of all ranges whose length is a power of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [np.asarray(values, np.int64)]
        while 2 * (width := 1 << (len(self.levels) - 1)) <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-width], last[width:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of each range ``first .. last``: two overlapping ranges of the table."""
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        out = np.empty(len(first), np.int64)
        for at in np.unique(level):
            those = np.nonzero(level == at)[0]
            table = self.levels[at]
            out[those] = np.minimum(table[first[those]], table[last[those] - (1 << at) + 1])
        return out


class Neighbours:
    """Common prefixes of sorted sequences: ``shared[i]`` is that of sequences i and i + 1."""

    def __init__(self, shared: np.ndarray, n: int) -> None:
        self.table, self.n = Minima(shared), n

    def extents(self, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last sequence that share the first ``depth`` turns of sequence ``row``: a binary
        search to either side, for each prefix by itself."""
        left, right = row.copy(), row.copy()
        for level in range(len(self.table.levels) - 1, -1, -1):
            width, minima = 1 << level, self.table.levels[level]
            at = np.nonzero(left >= width)[0]
            at = at[minima[left[at] - width] >= depth[at]]
            left[at] -= width
            at = np.nonzero(right + width < self.n)[0]
            at = at[minima[right[at]] >= depth[at]]
            right[at] += width
        return left, right


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int64), np.cumsum(values)])


def slice_nodes(rows: list[tuple], slice_no: int, edges: Neighbours) -> pd.DataFrame:
    """Nodes of a slice's ``path, words, n, least, ends``, sorted by path. A node that reaches into
    another slice (``open``) has its part of the sums; its own saving and the children and leaves
    that are open themselves are added when the parts meet. The root has depth 0 and is open."""
    paths, words, n, least, ends = zip(*rows)
    size = np.array([len(p) // DIGEST for p in paths])
    own = Neighbours(np.array([common(a, b) for a, b in zip(paths, paths[1:])], np.int64), len(paths))
    # candidates: every prefix of every sequence; a node is the one at its interval's first sequence
    row = np.repeat(np.arange(len(paths)), size)
    depth = np.arange(len(row)) - np.repeat(_sums(size)[:-1], size) + 1
    left, right = own.extents(row, depth)
    node = left == row
    left, right, depth = left[node], right[node], depth[node]  # sorted by first sequence, then depth: preorder
    first = np.searchsorted(left, np.arange(len(paths)))  # a sequence's own first node

    edge = np.where(left == 0, 2 * slice_no, 2 * slice_no + 1)
    on_edge = (left == 0) | (right == len(paths) - 1)
    low, high = np.full(len(left), slice_no), np.full(len(left), slice_no)
    a, b = edges.extents(edge[on_edge], depth[on_edge])
    low[on_edge], high[on_edge] = a // 2, b // 2
    is_open = low < high

    n_convs = _sums(np.array(n))[right + 1] - _sums(np.array(n))[left]
    smallest = Minima(np.array(least)).least(left, right)
    flat = np.array([w for per_turn in words for w in per_turn], np.int64)
    turn_words = flat[_sums(size)[left] + depth - 1]
    block = np.searchsorted(left, right, "right")  # end of the node's subtree in preorder
    here = np.arange(len(left))
    saving = _sums(np.where(is_open, 0, (n_convs - 1) * turn_words))
    leaf = _sums(((block == here + 1) & ~is_open).astype(np.int64))

    above = np.nonzero(depth > 1)[0]
    parent = np.full(len(left), -1)
    holder = own.extents(left[above], depth[above] - 1)[0]
    parent[above] = first[holder] + depth[above] - 1 - depth[first[holder]]
    children = np.zeros(len(left), np.int64)
    counted = (parent >= 0) & ~is_open
    np.add.at(children, parent[counted], 1)
    at = np.maximum(parent, 0)
    inside = (parent >= 0) & ~is_open[at] if len(left) else np.zeros(0, bool)
    ended = size[left] == depth
    out = pd.DataFrame({
        "open": is_open, "low": low, "high": high, "depth": depth, "n_convs": n_convs, "conv_id": smallest,
        "n_children": children, "n_leaves": leaf[block] - leaf[here], "saved_tokens": saving[block] - saving[here],
        "words": turn_words, "ends_sha256": np.where(ended, np.array(ends, object)[left], None) if len(left) else [],
        "parent_conv_id": pd.array(np.where(inside, smallest[at], 0) if len(left) else [], dtype="Int64"),
        "parent_low": np.where(parent >= 0, low[at], 0) if len(left) else [],
    })
    out["parent_conv_id"] = out["parent_conv_id"].mask(~inside)
    root = {"open": True, "low": 0, "high": edges.n // 2 - 1, "depth": 0, "n_convs": sum(n), "conv_id": min(least),
            "n_children": int(((depth == 1) & ~is_open).sum()), "n_leaves": leaf[-1], "saved_tokens": saving[-1], "words": 0,
            "ends_sha256": ends[0] if size[0] == 0 else None, "parent_conv_id": None, "parent_low": 0}
    return pd.concat([out, pd.DataFrame([root]).astype({"parent_conv_id": "Int64"})], ignore_index=True)


PART = "open boolean, low long, high long, depth long, n_convs long, conv_id long, n_children long, n_leaves long, " \
       "saved_tokens long, words long, ends_sha256 string, parent_conv_id long, parent_low long"


def met_nodes(parts: pd.DataFrame, edges: Neighbours) -> pd.DataFrame:
    """Whole open nodes from their summed parts, one row per node."""
    parts = parts.sort_values(["low", "depth"], ignore_index=True)
    low, high, depth = (parts[c].to_numpy() for c in ("low", "high", "depth"))
    here = np.arange(len(parts))
    block = np.maximum(np.searchsorted(low, high, "left"), here + 1)
    block[depth == 0] = len(parts)
    saving = _sums((parts["n_convs"].to_numpy() - 1) * parts["words"].to_numpy())
    place = {key: i for i, key in enumerate(zip(low.tolist(), depth.tolist()))}
    # an open node passes the last sequence of its first slice
    holder = edges.extents(2 * low + 1, np.maximum(depth - 1, 0))[0] // 2
    parent = np.array([place[0 if d == 1 else h, d - 1] if d else -1 for h, d in zip(holder.tolist(), depth.tolist())])
    children = parts["n_children"].to_numpy().copy()
    np.add.at(children, parent[parent >= 0], 1)
    ids = parts["conv_id"].to_numpy()
    return pd.DataFrame({
        "low": low, "conv_id": ids, "depth": depth,
        "parent_conv_id": pd.array(ids[parent], dtype="Int64"), "n_convs": parts["n_convs"], "n_children": children,
        "n_leaves": np.where(children == 0, 1, parts["n_leaves"]),
        "saved_tokens": parts["saved_tokens"].to_numpy() + saving[block] - saving[here],
        "ends_sha256": parts["ends_sha256"].fillna(NOTHING),
    }).assign(parent_conv_id=lambda f: f["parent_conv_id"].mask(f["depth"] == 0))


def _edges(sliced: DataFrame) -> tuple[dict[int, int], Neighbours]:
    """Numbers of the slices that have rows, and the common prefixes of their first and last paths:
    two numbers per slice come to the driver."""
    ends = staged(sliced.groupBy("slice").agg(F.min("path").alias("first"), F.max("path").alias("last")), "edges")
    present = sorted(r.slice for r in ends.select("slice").collect())
    number = {s: i for i, s in enumerate(present)}
    after = sliced.sparkSession.createDataFrame(list(zip(present, present[1:])), "before int, slice int")
    inner = ends.select(F.col("slice").alias("at"), F.lit(0).alias("kind"), F.col("first").alias("a"), F.col("last").alias("b"))
    outer = ends.select("slice", F.col("first").alias("b")).join(F.broadcast(after), "slice") \
        .join(ends.select(F.col("slice").alias("before"), F.col("last").alias("a")), "before") \
        .select(F.col("before").alias("at"), F.lit(1).alias("kind"), "a", "b")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shared = [common(x, y) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shared, pa.int64())], names=["at", "kind", "shared"])

    shared = np.zeros(2 * len(present), np.int64)
    for r in inner.union(outer).mapInArrow(each, "at int, kind int, shared long").collect():
        shared[2 * number[r["at"]] + r.kind] = r.shared
    return number, Neighbours(shared[:-1], 2 * len(present))


def prefix_trie(given: DataFrame, *, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The trie of ``conv_id, path, words``, one row per node: ``conv_id`` (the smallest member's),
    ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A node is a different prefix of paths, from the root (depth 0, all conversations, also those
    without turns) on. Equal paths are one sequence with a number of members, so a conversation that
    many repeat is one row; the rest is sorted by ranges, so a prefix that many share is split over
    slices. Nodes that reach over several slices are those on the common prefix of neighbouring
    slices' edges, a few for each slice; they meet in one task. Repeated ids count each. No
    conversations, no rows.
    """
    spark = given.sparkSession
    paths = staged(distinct_paths(given), "paths")
    size = paths.agg(F.sum(F.length("path") + 1)).first()[0]
    if size is None:
        return spark.createDataFrame([], NODE)
    slices = paths.repartitionByRange(1 + size // slice_bytes, "path").withColumn("slice", F.spark_partition_id())
    sliced = staged(slices, "slices")
    number, edges = _edges(sliced)

    def solve(key: tuple, rows: pa.Table) -> pa.Table:
        columns = [rows.column(c).to_pylist() for c in ("path", "words", "n", "least", "ends")]
        found = slice_nodes(sorted(zip(*columns), key=lambda r: r[0]), number[key[0].as_py()], edges)
        return pa.Table.from_pandas(found, preserve_index=False).cast(part_schema)

    part_schema = pa.schema([(n, {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string()}[t])
                             for n, t in (c.split() for c in PART.split(", "))])
    parts = staged(sliced.groupBy("slice").applyInArrow(solve, PART), "nodes")

    def total(name: str) -> Column:
        return F.sum(name).alias(name)

    summed = parts.filter("open").groupBy("low", "depth").agg(
        F.max("high").alias("high"), F.min("conv_id").alias("conv_id"), total("n_convs"), total("n_children"),
        total("n_leaves"), total("saved_tokens"), F.max("words").alias("words"), F.max("ends_sha256").alias("ends_sha256"))
    across = staged(summed.groupBy().applyInPandas(lambda f: met_nodes(f, edges), "low long, " + NODE), "across")
    names = [c.split()[0] for c in NODE.split(", ")]
    parents = across.select(F.col("low").alias("at"), F.col("depth").alias("of"), F.col("conv_id").alias("holder"))
    closed = parts.filter("not open").join(
        parents, F.col("parent_conv_id").isNull() & (F.col("parent_low") == F.col("at")) & (F.col("depth") - 1 == F.col("of")), "left") \
        .select("conv_id", "depth", F.coalesce("parent_conv_id", "holder").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
    return closed.select(names).union(across.select(names))
