"""Repeated passages removed by super-k-mers: windows that share a minimiser travel as one packed
string to its bucket, where sorting finds equal windows exactly."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.staging import staged

CHUNK_WORDS = 200_000  # words looked at together; a longer text is cut into overlapping segments
FLUSH = 200_000  # strings a task holds before it sends them
LEVEL = 3  # of compression
BUCKET_BYTES = 32 << 20  # packed text of a bucket, as planned
LEAST_BUCKETS = 256
LEAST_CELLS, MOST_CELLS = 1 << 12, 1 << 22
HOT = 4  # times the mean of a cell, beyond which its windows are sent one by one
PLACE = 24  # low bits of a gram's rank that hold its place in the chunk
PACKED = ["minimiser", "packed", "doc_id", "start", "key", "windows"]
FACTOR, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Segment:
    """Words of a text, or of a part of a long one that starts at word ``base``."""

    row: int
    base: int
    words: list[bytes]


@dataclass
class Runs:
    """Super-k-mers of a chunk: first word (in the chunk), windows and minimiser of each; of the
    words their hashes and where they lie in ``flat``."""

    first: np.ndarray
    windows: np.ndarray
    minimiser: np.ndarray
    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    flat: bytes


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * SPREAD
    h ^= h >> np.uint64(32)
    return h * FACTOR


def segments(texts: Iterable[str | None], window: int) -> Iterator[list[Segment]]:
    """Chunks of segments. Each window of a text lies in exactly one of its segments."""
    held, n = [], 0
    for row, text in enumerate(texts):
        words = (text or "").encode().split()
        for base in range(0, len(words) - window + 1, CHUNK_WORDS):
            held.append(Segment(row, base, words[base:base + CHUNK_WORDS + window - 1]))
            n += len(held[-1].words)
            if n >= CHUNK_WORDS:
                yield held
                held, n = [], 0
    if held:
        yield held


def runs(chunk: list[Segment], window: int, gram: int) -> Runs:
    """Maximal runs of windows whose smallest gram, by hash and then by place, is the same one.

    Equal windows have it at the same distance, so no run holds a window twice.
    """
    words = [w for s in chunk for w in s.words]
    sizes = np.array([len(s.words) for s in chunk])
    n = len(words)
    hashes = _mixed(np.fromiter(map(crc32, words), np.uint64, n) + np.uint64(1))
    grams = n - gram + 1
    rank = np.zeros(grams, np.uint64)
    for j in range(gram):
        rank += hashes[j:j + grams] * np.uint64(2 * j + 1)
    low = (_mixed(rank) >> np.uint64(PLACE) << np.uint64(PLACE)) | np.arange(grams, dtype=np.uint64)
    width, wide = 1, window - gram + 1
    while width < wide:  # smallest of 2, 4, .. grams, at last of all grams of a window
        step = min(width, wide - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    ends = np.repeat(np.cumsum(sizes), sizes)[:len(low)]
    starts = np.nonzero(np.arange(len(low)) + window <= ends)[0]
    low = low[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (low[1:] != low[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.nonzero(new)[0]
    lengths = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(lengths + 1) - 1
    return Runs(starts[at], np.diff(np.append(at, len(starts))), low[at] >> np.uint64(PLACE), hashes,
                end - lengths, end, b" ".join(words))


def _dealt(key: np.ndarray, parts: int, salt: int) -> np.ndarray:
    return (_mixed(key + np.uint64(salt)) % np.uint64(parts)).astype(np.int64)


def crowded_cells(documents: DataFrame, window: int, gram: int, cells: int) -> list[int]:
    """Cells of minimisers that hold more than ``HOT`` times the mean of strings, at most
    ``cells / HOT``. Equal strings of a chunk count once, as they are sent once."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for b in batches:
            for chunk in segments(b.column(0).to_pylist(), window):
                r = runs(chunk, window, gram)
                upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(r.hashes)])
                content = upto[r.first + r.windows + window - 1] - upto[r.first]
                _, one = np.unique(content + r.minimiser * FACTOR, return_index=True)
                np.add.at(total, _dealt(r.minimiser[one], cells, 11), 1)
        held = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["cell", "n"])

    counted = documents.select("text").mapInArrow(each, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counted = staged(counted, "cells")
    total = counted.agg(F.sum("n")).first()[0] or 0
    return [r.cell for r in counted.filter(F.col("n") > HOT * total / cells + 1000).select("cell").collect()]


class _Held:
    """The strings a task has met, each with its earliest place, and what is known of the others."""

    def __init__(self, buckets: int, id_type: pa.DataType) -> None:
        self.buckets, self.id_type = buckets, id_type
        self.strings: dict[bytes, tuple] = {}
        self.ties: list[tuple] = []
        self.later: list[tuple] = []

    def add(self, packed: bytes, minimiser: int, place: tuple, key: int, windows: int) -> None:
        met = self.strings.get(packed)
        if met is None:
            self.strings[packed] = (place, key, minimiser, windows)
        elif place > met[0]:
            self.later.append((place, key, windows))
        elif place < met[0]:
            self.later.append((met[0], met[1], windows))
            self.strings[packed] = (place, key, minimiser, windows)
        elif key != met[1]:  # another text of the same id: neither is earlier
            self.ties.append((packed, place, key, minimiser, windows))

    def __len__(self) -> int:
        return len(self.strings) + len(self.ties) + len(self.later)

    def blocks(self) -> Iterator[pa.RecordBatch]:
        """Rows ``bucket, block``; a block is a compressed Arrow table of strings, or of places
        that are known to be later ones."""
        rows = [(m, p, *place, key, n) for p, (place, key, m, n) in self.strings.items()]
        rows += [(m, p, *place, key, n) for p, place, key, m, n in self.ties]
        rows += [(i, None, *place, key, n) for i, (place, key, n) in enumerate(_joined(self.later))]
        self.strings, self.ties, self.later = {}, [], []
        if not rows:
            return
        minimiser, packed, none, ids, starts, keys, sizes = zip(*rows)
        ids = [None if n else i for n, i in zip(none, ids)]
        minimiser = np.array(minimiser, np.uint64)
        table = pa.table([
            pa.array(minimiser.view(np.int64)), pa.array(packed, pa.binary()), pa.array(ids, self.id_type),
            pa.array(starts, pa.int64()), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32())], names=PACKED)
        bucket = _dealt(minimiser, self.buckets, 23)
        order = np.argsort(bucket, kind="stable")
        table, bucket = table.take(pa.array(order)).combine_chunks(), bucket[order]
        edges = np.append(np.nonzero(np.diff(bucket, prepend=-1))[0], len(bucket))
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))
        out = []
        for a, z in zip(edges[:-1], edges[1:]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
                writer.write_table(table.slice(a, z - a))
            out.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]]), pa.array(out, pa.binary())], names=["bucket", "block"])



def _place(doc_id, start: int) -> tuple:
    """Places compare as ids do, NULL after all, then by the first word."""
    return doc_id is None, doc_id if doc_id is not None else 0, start


def _joined(later: list[tuple]) -> list[tuple]:
    """``place, key, windows`` with adjoining ones of a row made one; NULL ids as None."""
    out: list[tuple] = []
    for (none, doc_id, start), key, windows in sorted(later, key=lambda r: (r[0][:2], r[1], r[0][2])):
        if out and out[-1][1] == key and out[-1][0][:2] == (none, doc_id) and out[-1][0][2] + out[-1][2] >= start:
            (_, _, first), _, n = out[-1]
            out[-1] = ((none, doc_id, first), key, max(n, start + windows - first))
        else:
            out.append(((none, doc_id, start), key, windows))
    return [((none, None if none else doc_id, start), key, n) for (none, doc_id, start), key, n in out]


def packed_strings(documents: DataFrame, window: int, gram: int, buckets: int, cells: int, crowded: list[int]) -> DataFrame:
    """Rows ``bucket, block`` of ``doc_id, key, text``. Equal strings of a task are sent once, with
    their earliest place; the others of them are known to be later ones. Windows of crowded cells are
    strings by themselves and are dealt by their own hash."""
    id_type = _arrow_type(documents)
    split = np.zeros(cells, bool)
    split[crowded] = True

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(buckets, id_type)
        for b in batches:
            ids, keys = b.column(0).to_pylist(), b.column(1).to_pylist()
            for chunk in segments(b.column(2).to_pylist(), window):
                r = runs(chunk, window, gram)
                base = np.cumsum([0, *(len(s.words) for s in chunk)])
                of = np.searchsorted(base, r.first, "right") - 1
                start = r.first - base[of]
                last = r.first + r.windows + window - 2
                crowd = split[_dealt(r.minimiser, cells, 11)]
                for s, begin, end, n, m, at, alone, first in zip(
                        of.tolist(), r.begin[r.first].tolist(), r.end[last].tolist(), r.windows.tolist(),
                        r.minimiser.tolist(), start.tolist(), crowd.tolist(), r.first.tolist()):
                    seg = chunk[s]
                    doc_id, key, at = ids[seg.row], keys[seg.row], seg.base + at
                    if not alone:
                        held.add(r.flat[begin:end], m, _place(doc_id, at), key, n)
                        continue
                    for j in range(n):
                        one = r.flat[r.begin[first + j]:r.end[first + j + window - 1]]
                        held.add(one, m ^ (crc32(one) << 20), _place(doc_id, at + j), key, 1)
                if len(held) > FLUSH:
                    yield from held.blocks()
        yield from held.blocks()

    return documents.select("doc_id", "key", "text").mapInArrow(each, "bucket long, block binary")


def _arrow_type(documents: DataFrame) -> pa.DataType:
    return to_arrow_type(documents.schema["doc_id"].dataType)


def later_windows(table: pa.Table, window: int) -> list[tuple]:
    """``place, key, windows`` of the strings' windows that also start earlier, of one bucket."""
    known = table.filter(table.column("packed").is_null())
    later = [(_place(d, s), k, n) for d, s, k, n in zip(*(known.column(c).to_pylist() for c in PACKED[2:]))]
    table = table.filter(table.column("packed").is_valid())
    minimiser = table.column("minimiser").to_numpy()
    order = np.argsort(minimiser, kind="stable")
    minimiser = minimiser[order]
    same = np.zeros(len(order), bool)
    same[1:] = minimiser[1:] == minimiser[:-1]
    same[:-1] |= same[1:]  # a minimiser met once has nothing to compare
    table = table.take(pa.array(order[same]))
    rows = zip(minimiser[same].tolist(), *(table.column(c).to_pylist() for c in PACKED[1:]))
    for _, group in groupby(rows, key=lambda r: r[0]):
        strings = sorted(((p, _place(d, s), k, n) for _, p, d, s, k, n in group), key=lambda r: r[:2])
        firsts = []
        for packed, equal in groupby(strings, key=lambda r: r[0]):
            _, first, key, n = next(equal)
            firsts.append((packed, first, key, n))
            for _, place, key, n in equal:
                if place > first:
                    later.append((place, key, n))
                else:
                    firsts.append((packed, place, key, n))
        if len(firsts) > 1:
            later += _compared(firsts, window)
    return later


def _compared(strings: list[tuple], window: int) -> Iterator[tuple]:
    """Windows of different strings, sorted: all of an equal lot but the earliest."""
    found = []
    for packed, (none, doc_id, start), key, n in strings:
        words = packed.split(b" ")
        found += [(b" ".join(words[i:i + window]), (none, doc_id, start + i), key) for i in range(n)]
    found.sort(key=lambda r: r[:2])
    for _, equal in groupby(found, key=lambda r: r[0]):
        _, first, _ = next(equal)
        for _, place, key in equal:
            if place > first:
                yield place, key, 1


def later_places(blocks: DataFrame, documents: DataFrame, window: int) -> DataFrame:
    """``at_id, at_key, start, windows``: runs of windows that also start earlier, of every text."""
    id_type = _arrow_type(documents)

    def solve(given: pa.Table) -> pa.Table:
        tables = [pa.ipc.open_stream(b.as_buffer()).read_all() for b in given.column("block")]
        found = _joined(later_windows(pa.concat_tables(tables), window))
        ids, starts = [p[1] for p, _, _ in found], [p[2] for p, _, _ in found]
        return pa.table({
            "at_id": pa.array(ids, id_type), "at_key": pa.array([k for _, k, _ in found], pa.int64()),
            "start": pa.array(starts, pa.int64()), "windows": pa.array([n for _, _, n in found], pa.int32())})

    kind = documents.schema["doc_id"].dataType.simpleString()
    return blocks.groupBy("bucket").applyInArrow(solve, f"at_id {kind}, at_key long, start long, windows int")


def pressed(rows: DataFrame) -> DataFrame:
    """``doc_id, key, pressed``: texts compressed one by one, as they cross the network once more."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            texts = [press((t or "").encode()) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.binary())], names=["doc_id", "key", "pressed"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "key", "text").mapInArrow(each, f"doc_id {kind}, key long, pressed binary")


def without_repeats(documents: DataFrame, window: int = 20, gram: int = 3) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row: its text without the words that a window
    covers whose words also start earlier, in a smaller ``doc_id`` or earlier in the same one.

    Windows are ``window`` consecutive words of a text, words are split at blanks and compared as
    they are; ``kept`` has the words left, one space between them. All windows of all texts are
    compared, whatever their length: a window is found in the bucket of its smallest gram of ``gram``
    words. A minimiser with very many different strings is no bucket of its own; its windows are
    dealt out one by one.

    NULL and empty texts, and those below ``window`` words, lose nothing. A NULL id comes after all
    others. Rows of one id are the same document to each other: at equal places neither is earlier,
    so repeated rows have equal results. Other columns are ignored. No documents, no rows.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram is from 1 to window")
    rows = documents.select("doc_id", F.xxhash64("text").alias("key"), "text")
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, 3 * n_bytes // BUCKET_BYTES)
    cells = min(MOST_CELLS, max(LEAST_CELLS, 16 * buckets))
    crowded = crowded_cells(rows, window, gram, cells)
    found = later_places(packed_strings(rows, window, gram, buckets, cells, crowded), rows, window)
    lost = found.groupBy("at_id", "at_key").agg(F.collect_set(F.struct("start", "windows")).alias("lost"))
    met = pressed(rows).join(lost, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("key").eqNullSafe(F.col("at_key"))), "left") \
        .select("doc_id", "pressed", F.col("lost.start").alias("starts"), F.col("lost.windows").alias("sizes"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for text, starts, sizes in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                words = whole(text).split()
                n = len(words)
                if starts:
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, np.array(starts) + np.array(sizes) + window - 1, -1)
                    words = [words[i] for i in np.nonzero(np.cumsum(edge[:-1]) == 0)[0].tolist()]
                out.append((n, n - len(words), b" ".join(words)))
            total, removed, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return met.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept string")
