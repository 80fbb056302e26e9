"""Language-model scores from a log-frequency Bloom filter of quantised word n-gram counts."""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .columns import fold

WORD_BITS = 63  # of a word's hash
SPARE_BITS = 13  # bits of an n-gram's hash beyond those that number all bytes of the input
CHUNK_BYTES = 8 << 20  # text that is scored together; one longer text is a chunk of its own
BLOCK_KEYS = 2_000_000  # places of n-grams for each block of the filter
STRIDE = 200_000  # words hashed at a time
EDGE = 256  # the code beside the 256 bytes: before and after a word
CODES = 257
FACTOR, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
VALUE = np.where(BLANK, 0, np.random.default_rng(7).integers(1, 1 << 62, 256)).astype(np.uint64)


@dataclass(frozen=True)
class Settings:
    """``base``: of the quantisation; ``hashes``: bits set for each level of a key; ``prior``: places
    of a context that the shorter context is worth (held-out texts of the given tables got likelier from
    0.5 to 30)."""

    base: float = 1.5
    hashes: int = 4
    prior: float = 30.0


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h + np.uint64(salt)) * SPREAD
    h ^= h >> np.uint64(32)
    return h * FACTOR


START, END = _mixed(np.array([1, 2], np.uint64), 77)


def spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words. The data begins and ends with a blank."""
    edges = np.flatnonzero(np.diff(BLANK[np.frombuffer(data, np.uint8)])) + 1
    return edges[::2], edges[1::2]


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial in its bytes, mixed."""
    raw, out = np.frombuffer(data, np.uint8), np.empty(len(starts), np.uint64)
    for low in range(0, len(starts), STRIDE):
        s, e = starts[low:low + STRIDE], ends[low:low + STRIDE]
        part, first = raw[s[0]:e[-1]], s - s[0]
        reach = np.diff(np.append(first, len(part)))
        place = np.arange(len(part)) - np.repeat(first, reach)  # blanks after a word have no value
        powers = np.cumprod(np.full(int(reach.max()) + 1, FACTOR))
        out[low:low + STRIDE] = np.add.reduceat(VALUE[part] * powers[place], first)
    return _mixed(out, 11)


def _steps(data: bytes) -> np.ndarray:
    """For each byte but the last: its code and the next one's, as one number."""
    raw = np.frombuffer(data, np.uint8)
    code = np.where(BLANK[raw], EDGE, raw.astype(np.int64))
    return code[:-1] * CODES + code[1:]


def byte_pairs(data: bytes) -> np.ndarray:
    """How often each code follows each in the words; blanks after blanks don't count."""
    out = np.zeros(CODES * CODES, np.int64)
    for low in range(0, len(data), 1 << 20):
        out += np.bincount(_steps(data[low:low + (1 << 20) + 1]), minlength=len(out))
    out[EDGE * CODES + EDGE] = 0
    return out


def spelling(pairs: np.ndarray) -> np.ndarray:
    """log10 of the chance of each code after each, every one counted once more than seen."""
    seen = pairs.reshape(CODES, CODES) + 1.0
    return np.log10(seen / seen.sum(axis=1, keepdims=True)).ravel()


def spelled(data: bytes, starts: np.ndarray, ends: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """log10 of each word's chance by its bytes."""
    out = np.empty(len(starts))
    for low in range(0, len(starts), STRIDE):
        s, e = starts[low:low + STRIDE], ends[low:low + STRIDE]
        begin = s[0] - 1
        upto = np.concatenate([[0.0], np.cumsum(chances[_steps(data[begin:e[-1] + 1])])])
        out[low:low + STRIDE] = upto[e - begin] - upto[s - 1 - begin]
    return out


class Filter:
    """Bits that hold, for a key of count c, the keys of all levels up to 1 + log c. Their number is
    a power of two."""

    def __init__(self, bits: np.ndarray, settings: Settings) -> None:
        self.bits, self.settings = bits, settings

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, settings: Settings) -> Filter:
        tall = cls.level(counts, settings.base)
        wanted = int(tall.sum() * settings.hashes / np.log(2)) + 8
        flags = np.zeros(1 << (wanted - 1).bit_length(), bool)
        for at in range(1, int(tall.max(initial=0)) + 1):
            for place in cls.places(keys[tall >= at], at, len(flags), settings.hashes):
                flags[place.astype(np.int64)] = True
        return cls(np.packbits(flags, bitorder="little"), settings)

    @staticmethod
    def level(count: np.ndarray, base: float) -> np.ndarray:
        return (1 + np.floor(np.log(np.maximum(count, 1)) / np.log(base) + 1e-9)).astype(np.int64)

    @staticmethod
    def worth(level: np.ndarray, base: float) -> np.ndarray:
        """The middle of the counts of each level; 0 for level 0."""
        at = np.arange(1, int(level.max(initial=0)) + 1)
        low = np.ceil(base ** (at - 1.0) - 1e-9)
        high = np.maximum(np.ceil(base ** at.astype(float) - 1e-9) - 1, low)
        return np.concatenate([[0.0], (low + high) / 2])[level]

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int, hashes: int) -> Iterator[np.ndarray]:
        h, step = _mixed(keys, 1000 + level), _mixed(keys, 5000 + level) | np.uint64(1)
        for i in range(hashes):
            yield ((h + np.uint64(i) * step) >> np.uint64(7)) & np.uint64(size - 1)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels by probing one after the other until one is missing."""
        level = np.zeros(len(keys), np.uint8)
        alive, size, at = np.arange(len(keys)), len(self.bits) * 8, 1
        while len(alive) and at < 256:
            held = np.ones(len(alive), bool)
            for place in self.places(keys[alive], at, size, self.settings.hashes):
                held &= (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            alive = alive[held]
            level[alive] = at
            at += 1
        return level

    def counts(self, keys: np.ndarray) -> np.ndarray:
        return self.worth(self.levels(keys), self.settings.base)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of the narrowest width that holds them, compressed."""
    width = next(w for w in (1, 2, 4, 8) if int(values.max(initial=0)) >> (8 * w) == 0)
    planes = np.ascontiguousarray(values, f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return zstandard.compress(bytes([width]) + planes, 1)


def _unpacked(blob: bytes) -> np.ndarray:
    raw = zstandard.decompress(blob)
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{raw[0]}").ravel().astype(np.uint64)


def _rising(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=np.uint64(0)))


def _risen(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(blob), dtype=np.uint64)


@dataclass(frozen=True)
class Places:
    """The places of a chunk's texts, an end after the words of each, with their hashes.

    ``words`` and ``pairs`` have one entry for each place, ``triples`` one for each place that isn't
    the first of its text; ``first`` and ``last`` are the places texts begin and end with.
    """

    words: np.ndarray
    pairs: np.ndarray
    triples: np.ndarray
    first: np.ndarray
    last: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, data: bytes, sizes: np.ndarray, bits: int) -> Places:
        starts, ends = spans(data)
        cuts = np.searchsorted(starts, np.cumsum(np.concatenate([[1], sizes + 1])))
        text = np.arange(len(sizes))
        first, last = cuts[:-1] + text, cuts[1:] + text
        words = np.empty(len(starts) + len(sizes), np.uint64)
        inner = np.ones(len(words), bool)
        inner[last] = False
        words[inner], words[last] = word_hashes(data, starts, ends), END
        before = np.roll(words, 1)
        before[first] = START
        pairs = _mixed(before * FACTOR + words, 2)
        later = np.ones(len(words), bool)
        later[first] = False
        triples = _mixed(np.roll(pairs, 1) * FACTOR + words, 3)[later]
        drop = np.uint64(64 - bits)
        return cls(words >> np.uint64(64 - WORD_BITS), pairs >> drop, triples >> drop, first, last, starts, ends)

    def training(self, held_out: np.ndarray) -> np.ndarray:
        return np.repeat(~held_out, self.last - self.first + 1).astype(np.uint64)

    def later(self, values: np.ndarray) -> np.ndarray:
        return np.delete(values, self.first)


def _distinct(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising distinct keys and how many of each have weight 1. Keys have 63 bits at most."""
    tagged = np.sort(keys << np.uint64(1) | weight)
    keys = tagged >> np.uint64(1)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(tagged & np.uint64(1), first)


def _ranks(keys: np.ndarray) -> np.ndarray:
    """The place of each key among the rising distinct ones."""
    order = np.argsort(keys)
    rising = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.append(False, rising[1:] != rising[:-1]))
    return out


def _bounds(bits: int, n_blocks: int) -> np.ndarray:
    return np.array([(b << bits) // n_blocks for b in range(1, n_blocks)], np.uint64)


def log_probabilities(at: Places, spelt: np.ndarray, word_counts: np.ndarray, pair_counts: np.ndarray,
                      triple_counts: np.ndarray, train_tokens: int, train_types: int, prior: float) -> np.ndarray:
    """log10 of the probability of each place after the two before it.

    A word's own chance is its count mixed with its spelling, the end being the empty word. A longer
    context adds its counts to ``prior`` places of the shorter one; a context that never occurs
    changes nothing. An n-gram counts at most as often as its context.
    """
    chance = _mixture(word_counts, train_types + 1.0, spelt) - np.log10(train_tokens + train_types + 1.0)
    total = np.roll(word_counts, 1)
    total[at.first] = word_counts[at.last]  # as many texts begin as end
    chance = _mixture(np.minimum(pair_counts, total), prior, chance) - np.log10(total + prior)
    longer = np.ones(len(chance), bool)
    longer[at.first] = False
    total = np.roll(pair_counts, 1)[longer]
    chance[longer] = _mixture(np.minimum(triple_counts, total), prior, chance[longer]) - np.log10(total + prior)
    return chance


def _mixture(count: np.ndarray, weight: float, logs: np.ndarray) -> np.ndarray:
    """log10 of ``count + weight * 10 ** logs``, without loss where the power is too small a number."""
    plain = np.log10(weight) + logs
    return np.where(count > 0, np.log10(np.maximum(count, 1e-300) + 10.0 ** np.maximum(plain, -300)), plain)


def _chunks(documents: DataFrame, held_out: int) -> DataFrame:
    """One row for each 8 MB of text of a task: ids, folds, the lower-case texts, byte pairs.

    Written once, so the number a chunk draws is the same wherever it is read.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, folds, texts, size = [], [], [], 0

        def chunk() -> pa.RecordBatch:
            learnt = b" " + b" ".join(t for t, h in zip(texts, folds) if not h) + b" "
            sizes = [len(t) for t in texts]
            data = zstandard.compress(b" " + b" ".join(texts) + b" ", 3)
            n_train = len(spans(learnt)[0]) + folds.count(False)
            names = ["chunk", "ids", "held_out", "sizes", "data", "bytes", "n_train", "pairs"]
            return pa.RecordBatch.from_arrays([
                pa.array([secrets.randbits(63)], pa.int64()), pa.ListArray.from_arrays([0, len(texts)], pa.concat_arrays(ids)),
                pa.array([folds], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([data], pa.binary()), pa.array([sum(sizes) + len(sizes)], pa.int64()),
                pa.array([n_train], pa.int64()), pa.array([_packed(byte_pairs(learnt))], pa.binary())], names=names)

        for b in batches:
            for i in range(b.num_rows):
                text = (b.column(2)[i].as_py() or "").encode().lower()
                if texts and size + len(text) > CHUNK_BYTES:
                    yield chunk()
                    ids, folds, texts, size = [], [], [], 0
                ids.append(b.column(0).slice(i, 1))
                folds.append(b.column(1)[i].as_py())
                texts.append(text)
                size += len(text) + 1
        if texts:
            yield chunk()

    rows = documents.select("doc_id", (fold(F.col("doc_id")) == held_out).alias("held_out"), "text")
    return staged(rows.mapInArrow(
        each, f"chunk long, ids array<{kind}>, held_out array<boolean>, sizes array<long>, data binary, bytes long, "
              "n_train long, pairs binary"), "chunks")


def _pair_counts(chunks: DataFrame) -> np.ndarray:
    """Byte pairs of all training words: at most 257 * 257 rows, summed by task first."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES * CODES, np.uint64)
        for b in batches:
            for blob in b.column(0):
                total += _unpacked(blob.as_py())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].view(np.int64))], names=["pair", "n"])

    out = np.zeros(CODES * CODES, np.int64)
    for row in chunks.select("pairs").mapInArrow(each, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[row.pair] = row.n
    return out


def _asked(chunks: DataFrame, bits: int, n_blocks: int) -> DataFrame:
    """``block, chunk, words, n_words, grams, n_grams``: the distinct hashes of a chunk that belong to a
    block, rising, with their training counts (0 where only held-out texts have them)."""
    word_bounds, gram_bounds = _bounds(WORD_BITS, n_blocks), _bounds(bits, n_blocks)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                held = np.array(b.column("held_out")[i].as_py(), bool)
                at = Places.of(zstandard.decompress(b.column("data")[i].as_py()), np.array(b.column("sizes")[i].as_py()), bits)
                train = at.training(held)
                words, n_words = _distinct(at.words, train)
                grams, n_grams = _distinct(np.concatenate([at.pairs, at.triples]), np.concatenate([train, at.later(train)]))
                wcut = [0, *np.searchsorted(words, word_bounds), len(words)]
                gcut = [0, *np.searchsorted(grams, gram_bounds), len(grams)]
                some = [k for k in range(n_blocks) if wcut[k] < wcut[k + 1] or gcut[k] < gcut[k + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array([b.column("chunk")[i].as_py()] * len(some), pa.int64()),
                     pa.array([_rising(words[wcut[k]:wcut[k + 1]]) for k in some], pa.binary()),
                     pa.array([_packed(n_words[wcut[k]:wcut[k + 1]]) for k in some], pa.binary()),
                     pa.array([_rising(grams[gcut[k]:gcut[k + 1]]) for k in some], pa.binary()),
                     pa.array([_packed(n_grams[gcut[k]:gcut[k + 1]]) for k in some], pa.binary())],
                    names=["block", "chunk", "words", "n_words", "grams", "n_grams"])

    return chunks.select("chunk", "held_out", "sizes", "data").mapInArrow(
        each, "block long, chunk long, words binary, n_words binary, grams binary, n_grams binary")


def _answers(asked: DataFrame, settings: Settings) -> DataFrame:
    """``chunk, block, counts, levels, kinds``: exact counts of the words and the levels that the block's
    filter holds for the n-grams, in the order they were asked; kinds, once a block, its training words."""
    def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, back = np.unique(np.concatenate(keys), return_inverse=True)
        return found, back, np.bincount(back, np.concatenate(counts).astype(float), len(found))

    def answer(rows: pa.Table) -> pa.Table:
        blobs = {c: rows.column(c).to_pylist() for c in ("words", "n_words", "grams", "n_grams")}
        words, grams = [_risen(x) for x in blobs["words"]], [_risen(x) for x in blobs["grams"]]
        _, word_at, total = summed(words, [_unpacked(x) for x in blobs["n_words"]])
        counts = np.split(total.astype(np.uint64)[word_at], np.cumsum([len(w) for w in words])[:-1])
        found, gram_at, seen = summed(grams, [_unpacked(x) for x in blobs["n_grams"]])
        held = Filter.of(found[seen > 0], seen[seen > 0], settings)
        levels = np.split(held.levels(found)[gram_at], np.cumsum([len(g) for g in grams])[:-1])
        return pa.table({
            "chunk": rows.column("chunk"), "block": rows.column("block"),
            "counts": pa.array([_packed(c) for c in counts], pa.binary()),
            "levels": pa.array([_packed(x) for x in levels], pa.binary()),
            "kinds": pa.array([int((total > 0).sum())] + [0] * (len(rows) - 1), pa.int64())})

    return staged(asked.groupBy("block").applyInArrow(
        answer, "chunk long, block long, counts binary, levels binary, kinds long"), "answers")


def scores(documents: DataFrame, *, held_out: int = 1, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    The model has the words, pairs and triples of words of all training rows (those whose fold is not
    ``held_out``), from a start before each text to an end after it. Each chunk of texts sends its
    distinct hashes, with their counts, to the blocks of hashes they belong to. A block adds them up,
    builds the log-frequency filter of its pairs and triples from the training counts, probes it for
    all that was asked and answers each chunk in its own order. The filter grows with the input, so
    it is never in one place. Word counts, on which the base score stands, are summed by 63-bit
    hashes and not quantised.

    NULL and empty texts have the end only. Long texts are taken whole, a text above 8 MB by itself.
    Repeated rows are counted and scored each; a NULL id counts as empty text for its fold; other
    columns are ignored. No documents, no rows.
    """
    chunks = _chunks(documents, held_out)
    sums = chunks.agg(F.sum("bytes").alias("bytes"), F.sum("n_train").alias("n")).first()
    n_bytes, train_tokens = sums.bytes or 0, sums.n or 0
    bits = min(WORD_BITS, max(32, n_bytes.bit_length() + SPARE_BITS))
    answers = _answers(_asked(chunks, bits, 1 + n_bytes // (3 * BLOCK_KEYS)), settings)
    train_types = answers.agg(F.sum("kinds").alias("n")).first().n or 0
    chances = spelling(_pair_counts(chunks))
    floor = train_tokens + 0.5 * (train_types + 1)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def told(texts: pa.Table, found: pa.Table) -> pa.Table:
        data, sizes = zstandard.decompress(texts.column("data")[0].as_py()), np.array(texts.column("sizes")[0].as_py())
        found = found.sort_by("block")
        counts = np.concatenate([_unpacked(x.as_py()) for x in found.column("counts")]).astype(float)
        levels = np.concatenate([_unpacked(x.as_py()) for x in found.column("levels")]).astype(np.int64)
        at = Places.of(data, sizes, bits)
        count = counts[_ranks(at.words)]
        grams = Filter.worth(levels, settings.base)[_ranks(np.concatenate([at.pairs, at.triples]))]
        spelt = np.full(len(count), chances[EDGE * CODES + EDGE])
        inner = np.ones(len(count), bool)
        inner[at.last] = False
        spelt[inner] = spelled(data, at.starts, at.ends, chances)
        logs = log_probabilities(at, spelt, count, grams[:len(count)], grams[len(count):], train_tokens, train_types, settings.prior)
        return pa.table({
            "doc_id": texts.column("ids").combine_chunks().flatten(),
            "held_out": texts.column("held_out").combine_chunks().flatten(),
            "n_tokens": pa.array(at.last - at.first + 1),
            "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64), at.first)),
            "train_tokens": pa.array(np.full(len(sizes), train_tokens)),
            "base_score": pa.array(np.add.reduceat(np.log10((count + 0.5) / floor), at.first)),
            "score": pa.array(np.add.reduceat(logs, at.first))})

    rows = chunks.select("chunk", "ids", "held_out", "sizes", "data")
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        told, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
