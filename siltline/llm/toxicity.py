"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .columns import carried, fold, sampled

WORD = re.compile(r"[^\W_]+")
SHORT = 30  # words up to this length are hashed together, so many at a time:
MATRIX = 1 << 15
CACHE = 400_000  # words whose weight a task remembers
CHUNK = 4_000_000  # characters whose words are held at a time
STEEPEST = 300


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled documents used, about, chosen by the hash of their ids."""

    sample: int = 8_000
    buckets: int = 1 << 17
    width: int = 8
    grams: tuple[int, int] = (3, 5)
    least_docs: int = 5
    prior: float = 400.0
    steps: int = 100
    rate: float = 0.3
    decay: float = 1e-4
    seed: int = 0


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def subwords(words: list[str], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' subwords in one array, and where each word begins in it.

    A word's bag is itself and its character n-grams, with marks for its ends."""
    rows, buckets = [], []
    short = [i for i, w in enumerate(words) if len(w) <= SHORT]
    for low in range(0, len(short), MATRIX):
        part = short[low:low + MATRIX]
        marked = np.array([f"<{words[i]}>" for i in part])
        codes = marked.view(np.uint32).reshape(len(part), -1).astype(np.uint64)
        _hashed(codes, np.array(part, np.int32), settings, rows, buckets)
    for i, w in enumerate(words):
        if len(w) > SHORT:
            codes = np.frombuffer(f"<{w}>".encode("utf-32-le"), np.uint32).astype(np.uint64)
            _hashed(codes[None, :], np.array([i], np.int32), settings, rows, buckets)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    row, bucket = np.concatenate(rows), np.concatenate(buckets)
    order = np.argsort(row, kind="stable")
    return bucket[order], np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(words)))])


def _hashed(codes: np.ndarray, ids: np.ndarray, settings: Settings, rows: list, buckets: list) -> None:
    factor, spread = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

    def emit(hashes: np.ndarray, kept: np.ndarray, kind: int) -> None:
        mixed = (hashes + np.uint64(kind)) * spread
        mixed ^= mixed >> np.uint64(32)
        mixed *= spread
        at = np.nonzero(kept)
        rows.append(ids[at[0]])
        buckets.append(((mixed[at] >> np.uint64(33)) % np.uint64(settings.buckets)).astype(np.int32))

    used = codes > 0
    with np.errstate(over="ignore"):
        total = np.zeros(len(codes), np.uint64)
        for j in range(codes.shape[1]):
            total = np.where(used[:, j], total * factor + codes[:, j], total)
        emit(total[:, None], np.ones((len(codes), 1), bool), 1)
        for n in range(settings.grams[0], settings.grams[1] + 1):
            span = codes.shape[1] - n + 1
            if span <= 0:
                continue
            run = np.zeros((len(codes), span), np.uint64)
            for j in range(n):
                run = run * factor + codes[:, j:j + span]
            emit(run, used[:, n - 1:], n)


def damped(counts: np.ndarray) -> np.ndarray:
    """What a word counts that stands n times: 1 + ln n, so that no repeated word fills the bag."""
    return 1.0 + np.log(counts)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring starts."""
    out, full = np.zeros(len(starts) - 1), starts[1:] > starts[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, starts[:-1][full])
    return out


def train(texts: list[str | None], labels: np.ndarray, settings: Settings = Settings()) -> dict:
    """Embeddings and softmax weights fitted together by full-batch steps; the classes weigh alike.

    Only subwords that ``least_docs`` texts hold are learnt. The average has ``prior`` empty subwords
    more, so that a short text needs more evidence.

    The result is what scoring needs of them: ``weights``, the difference of the class scores of
    each bucket's embedding, and ``bias``. Labels of one class only give a constant score."""
    index: dict[str, int] = {}
    doc_words, doc_counts, starts = [], [], [0]
    for text in texts:
        found, counts = np.unique([index.setdefault(w, len(index)) for w in words_of(text)], return_counts=True)
        doc_words.append(found.astype(np.int64))
        doc_counts.append(counts)
        starts.append(starts[-1] + len(found))
    rng = np.random.default_rng(settings.seed)
    share = float(np.mean(labels)) if len(labels) else 0.0
    if not index or share in (0.0, 1.0):
        odds = np.log((share * len(labels) + 0.5) / ((1 - share) * len(labels) + 0.5)) if len(labels) else -1.0
        return {"weights": np.zeros(settings.buckets, np.float32), "bias": float(odds)}
    bags, begins = subwords(list(index), settings)
    bags, sizes = bags.astype(np.int64), np.diff(begins)
    word, count, doc = np.concatenate(doc_words), damped(np.concatenate(doc_counts)), np.array(starts)
    of_doc = np.repeat(np.arange(len(texts)), np.diff(doc))
    bag_of_word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    seen_in = np.bincount(bags, np.bincount(word, minlength=len(sizes))[bag_of_word], settings.buckets)
    common = seen_in >= settings.least_docs
    length = _sums(count * sizes[word], doc) + settings.prior
    part = count / length[of_doc]
    weight = np.where(labels > 0.5, 0.5 / share, 0.5 / (1 - share)) / len(texts)

    table = rng.normal(0, 0.1, (settings.buckets, settings.width))
    soft = rng.normal(0, 0.5, (settings.width, 2))
    params = [table, soft]
    prior = np.log([1 - share, share])  # what a text without words is worth
    first, second = [np.zeros_like(p) for p in params], [0.0, 0.0]
    goal = np.stack([labels <= 0.5, labels > 0.5], axis=1).astype(float)
    for step in range(1, settings.steps + 1):
        class_scores = params[0] @ params[1]
        logits = np.empty((len(texts), 2))
        for c in range(2):
            per_word = _sums(class_scores[bags, c], begins)
            logits[:, c] = _sums(part * per_word[word], doc) + prior[c]
        logits -= logits.max(axis=1, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(axis=1, keepdims=True)
        slope = (chance - goal) * weight[:, None]
        # two classes: the slopes are each other's negative
        per_word = np.bincount(word, part * slope[of_doc, 1], len(sizes))
        per_bucket = np.bincount(bags, per_word[bag_of_word], settings.buckets)
        per_bucket *= common
        both = np.stack([-per_bucket, per_bucket], axis=1)
        slopes = [both @ params[1].T + settings.decay * params[0] / settings.buckets,
                  params[0].T @ both + settings.decay * params[1]]
        for i, g in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * g
            # one scale for a whole table: what few texts hold moves little and is not learnt by heart
            steepest = np.partition(g * g, max(0, g.size - STEEPEST), axis=None)[-STEEPEST:].mean()
            second[i] = 0.99 * second[i] + 0.01 * steepest
            move = (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-10)
            params[i] = params[i] - settings.rate * move
    gap = (params[0] * common[:, None]) @ (params[1][:, 1] - params[1][:, 0])
    return {"weights": gap.astype(np.float32), "bias": float(prior[1] - prior[0])}


def _learn(rows: DataFrame, settings: Settings) -> dict:
    """Trains in one task on ``text, label``, which has about ``settings.sample`` rows at most."""
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [(t, y) for b in batches for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        table.sort(key=lambda r: (r[0] or "", r[1]))  # the same order, however rows arrive
        model = train([t for t, _ in table], np.array([y for _, y in table], float), settings)
        yield pa.RecordBatch.from_arrays([pa.array([model["weights"].tobytes()]), pa.array([model["bias"]])],
                                         names=["weights", "bias"])

    row = rows.select("text", "label").repartition(1).mapInArrow(fit, "weights binary, bias double").first()
    if row is None:  # no labels, no partition
        return train([], np.zeros(0), settings)
    return {"weights": np.frombuffer(row.weights, np.float32), "bias": row.bias}


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", settings: Settings = Settings()) -> dict:
    """A model from the documents whose fold is not 0. Labels of an id are averaged; NULL labels
    don't count. Of texts that share an id the smallest is used. Without labels the score is
    constant and low."""
    chosen = sampled(staged(
        labels.filter(F.col(label).isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy(F.col("doc_id").alias("of")).agg((F.avg(label) >= 0.5).cast("double").alias("label")), "labels"),
        "of", settings.sample)
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("of")) \
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return _learn(texts, settings)


class Scorer:
    """Scores texts; remembers the weights of words."""

    def __init__(self, model: dict, settings: Settings) -> None:
        self.model, self.settings = model, settings
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.weight, self.size = np.zeros(0), np.zeros(0)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out, low = np.empty(len(texts)), 0
        while low < len(texts):
            high, held = low, 0
            while high < len(texts) and (high == low or held + len(texts[high] or "") <= CHUNK):
                held += len(texts[high] or "")
                high += 1
            out[low:high] = self._chunk(texts[low:high])
            low = high
        return out

    def _chunk(self, texts: list[str | None]) -> list[float]:
        if len(self.index) > CACHE:
            self.forget()
        bags = [words_of(t) for t in texts]
        index = self.index
        new = list({w for bag in bags for w in bag if w not in index})
        if new:
            buckets, begins = subwords(new, self.settings)
            index.update(zip(new, range(len(index), len(index) + len(new))))
            self.weight = np.concatenate([self.weight, _sums(self.model["weights"][buckets], begins)])
            self.size = np.concatenate([self.size, np.diff(begins)])
        out = []
        for bag in bags:
            ids, counts = np.unique(np.fromiter(map(index.__getitem__, bag), np.int64, len(bag)), return_counts=True)
            each = damped(counts)
            logit = each @ self.weight[ids] / (each @ self.size[ids] + self.settings.prior) + self.model["bias"]
            out.append(1.0 / (1.0 + np.exp(-logit)))
        return out


def score(text: Column, model: dict, settings: Settings = Settings()) -> Column:
    """0 to 1, higher is likelier toxic. NULL and empty texts get the share of toxic labels."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model, settings)
        for batch in batches:
            yield pd.Series(scorer.scores(list(batch)), dtype="float64")

    return F.pandas_udf(run, "double")(text)


def toxicity(documents: DataFrame, labels: DataFrame, *, threshold: float = 0.5,
             settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``documents``.

    Learns from labels outside fold 0 only; ids, languages and sources are no inputs. Repeated rows
    get a score each, a NULL id is in fold 0, other columns are ignored; no documents, no rows.
    """
    model = fit(documents, labels, settings=settings)
    return documents.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"),
                            score(F.col("text"), model, settings).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(documents: DataFrame, labels: DataFrame, *, threshold: float = 0.5,
                  settings: Settings = Settings()) -> DataFrame:
    """The documents that are not rejected, as they are: all columns stay, whatever their names.

    NULL and empty texts score like texts without subwords, long ones by all of their words; of
    repeated rows all stay or all go. No documents, no rows.
    """
    model = fit(documents, labels, settings=settings)
    return carried(documents, score(F.col("text"), model, settings).alias("_score")) \
        .filter(F.col("_score") < threshold).select("_row.*")
