"""Quality scores: random Fourier features of document statistics, ridge by partition-summed normal
equations, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .columns import fold, sampled

STATISTICS = [
    "words", "characters", "word_length", "word_spread", "upper", "digits", "marks", "symbols", "outside_ascii",
    "lines", "line_words", "repeated_lines", "distinct_words", "top_word", "distinct_pairs", "capitals", "closed_odd",
    "single", "sentence_ends",
]
FOLDS = (1, 2, 3, 4)  # of the training rows; fold 0 is held out
BINS, LOW, HIGH = 2000, -0.5, 1.5
CLASSES = np.zeros(256, np.int64)
CLASSES[ord("A"):ord("Z") + 1] = 1
CLASSES[ord("0"):ord("9") + 1] = 2
CLASSES[[ord(c) for c in ".,;:?'\"()-"]] = 3
CLASSES[[ord(c) for c in "!#$%&*+/<=>@[]\\^_`{|}~"]] = 4
CLASSES[128:] = 5
CLOSING = frozenset(b"!#$%&*+/<=>@\\^_`{|}~")


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled documents used, about; ``features``: random features."""

    sample: int = 100_000
    features: int = 256
    width: float = 1.0
    ridge: float = 1e-4
    seed: int = 0


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text, all 0 for an empty one."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(raw)
    kinds = np.bincount(CLASSES[np.frombuffer(raw, np.uint8)], minlength=6) / size
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [s for s in raw.split(b"\n") if s.strip()]
    counts = Counter(words)
    return [
        np.log1p(n), np.log1p(size), lengths.mean(), lengths.std(), kinds[1], kinds[2], kinds[3], kinds[4], kinds[5],
        np.log1p(len(lines)), np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines), len(counts) / n,
        max(counts.values()) / n, len(set(zip(words, words[1:]))) / max(1, n - 1),
        sum(map(bytes.isupper, words)) / n, sum(w[-1] in CLOSING for w in words) / n, float((lengths == 1).mean()),
        sum(w[-1] == 46 for w in words) / n,
    ]


def described(documents: DataFrame) -> DataFrame:
    """``doc_id, fold, stats`` for every row."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [statistics(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "fold", "stats"])

    columns = documents.select("doc_id", fold(F.col("doc_id")).cast("int").alias("fold"), "text")
    kind = columns.schema["doc_id"].dataType.simpleString()
    return columns.mapInArrow(each, f"doc_id {kind}, fold int, stats array<double>")


def fourier(stats: np.ndarray, model: dict) -> np.ndarray:
    """Random features whose products approximate a Gaussian kernel, and a constant."""
    x = np.clip((stats - model["mean"]) / model["spread"], -6, 6)
    z = np.sqrt(2.0 / len(model["phase"])) * np.cos(x @ model["waves"] + model["phase"])
    return np.hstack([z, np.ones((len(x), 1))])


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index(name)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, len(STATISTICS))


def isotonic(at: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the non-decreasing fit, one of each per pooled block."""
    blocks: list[list[float]] = []
    for x, y, w in zip(at, mean, weight):
        blocks.append([x * w, y * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(features: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = Settings()) -> dict:
    """A model from rows of ``described`` outside fold 0.

    Every partition sums its normal equations by fold, so the driver gets a few matrices. Each
    fold is scored by the equations of the others, and those scores are calibrated. Labels of an id
    are averaged, NULLs don't count; without labels of both classes the score is constant.
    """
    chosen = sampled(staged(
        labels.filter(F.col(label).isNotNull() & (fold(F.col("doc_id")) != 0))
        .groupBy(F.col("doc_id").alias("of")).agg(F.avg(label).alias("label")), "labels"), "of", settings.sample)
    rows = staged(
        features.filter("fold <> 0").join(F.broadcast(chosen), F.col("doc_id") == F.col("of"))
        .select("fold", "label", "stats").repartition(8), "training")
    share = rows.agg(F.avg("label")).first()[0]
    if share is None or share in (0.0, 1.0):
        return {"constant": 0.5 if share is None else share}
    moments = {r.pos: r for r in rows.select(F.posexplode("stats").alias("pos", "x")).groupBy("pos").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("spread")).collect()}
    rng, d = np.random.default_rng(settings.seed), len(STATISTICS)
    model = {
        "mean": np.array([moments[i]["mean"] for i in range(d)]),
        "spread": np.array([max(moments[i]["spread"], 1e-9) for i in range(d)]),
        "waves": rng.normal(0, settings.width / np.sqrt(d), (d, settings.features)),
        "phase": rng.uniform(0, 2 * np.pi, settings.features),
    }
    width = settings.features + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((len(FOLDS), width, width)), np.zeros((len(FOLDS), width))
        for b in batches:
            z, y, f = fourier(_matrix(b, "stats"), model), b.column(1).to_numpy(), b.column(0).to_numpy()
            for i, k in enumerate(FOLDS):
                left[i] += z[f == k].T @ z[f == k]
                right[i] += z[f == k].T @ y[f == k]
        yield pa.RecordBatch.from_arrays([pa.array([left.tobytes()]), pa.array([right.tobytes()])],
                                         names=["l", "r"])

    sums = rows.mapInArrow(equations, "l binary, r binary").collect()  # one row per partition, at most 8
    left = sum(np.frombuffer(s.l).reshape(len(FOLDS), width, width) for s in sums)
    right = sum(np.frombuffer(s.r).reshape(len(FOLDS), width) for s in sums)

    def solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.linalg.solve(a + (settings.ridge * a[-1, -1] + 1e-6) * np.eye(width), b)

    others = [solved(left.sum(0) - left[i], right.sum(0) - right[i]) for i in range(len(FOLDS))]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, positive = np.zeros(BINS), np.zeros(BINS)
        for b in batches:
            z, y, f = fourier(_matrix(b, "stats"), model), b.column(1).to_numpy(), b.column(0).to_numpy()
            raw = np.array([z[j] @ others[FOLDS.index(f[j])] for j in range(len(f))])
            at = np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
            n += np.bincount(at, minlength=BINS)
            positive += np.bincount(at, y, BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(n), pa.array(positive)],
                                         names=["bin", "n", "positive"])

    bins = rows.mapInArrow(binned, "bin long, n double, positive double").groupBy("bin") \
        .agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")).filter("n > 0").orderBy("bin").collect()
    n = np.array([r.n for r in bins])
    model["at"], model["value"] = isotonic(
        np.array([LOW + (r.bin + 0.5) * (HIGH - LOW) / BINS for r in bins]), np.array([r.positive for r in bins]) / n, n)
    model["ridge"] = solved(left.sum(0), right.sum(0))
    return model


def quality(documents: DataFrame, labels: DataFrame, *, threshold: float = 0.3,
            settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``documents``.

    Texts are read once, for their statistics. NULL and empty texts have all statistics 0 and are
    scored like any text. Repeated rows get a score each, a NULL id is in fold 0, other columns are
    ignored; no documents, no rows.
    """
    features = staged(described(documents), "statistics")
    model = fit(features, labels, settings=settings)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if "constant" in model:
                scores = np.full(b.num_rows, float(model["constant"]))
            else:
                scores = np.interp(fourier(_matrix(b, "stats"), model) @ model["ridge"], model["at"], model["value"])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.clip(scores, 0.0, 1.0))],
                                             names=["doc_id", "fold", "score"])

    kind = features.schema["doc_id"].dataType.simpleString()
    return features.mapInArrow(each, f"doc_id {kind}, fold int, score double").select(
        "doc_id", (F.col("fold") == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
