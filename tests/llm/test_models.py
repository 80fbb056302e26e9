"""Toxicity, quality and the language model."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltline.llm import lm, quality, toxicity
from siltline.llm.workload import op3_quality, op4_toxicity, op7_language_model

DOCS = "doc_id long, text string"
ODD = [(900_001, None), (900_002, ""), (None, "no id"), (900_003, "word " * 50_000), (900_004, "x" * 200_000), (900_003, "twice")]


def held_out(doc_id, remainder=0):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == remainder


def area(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("query,label,least,cut", [(op3_quality, "quality", 0.97, 0.3), (op4_toxicity, "toxic", 0.85, 0.5)])
def test_held_out_ranking(spark, query, label, least, cut):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = query(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= cut) and r.held_out == held_out(r.doc_id) for r in rows)
    assert area([(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]) > least


def made(n=600):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = [rng.choice(words) for _ in range(60)]
        if toxic:
            for _ in range(3):
                text[rng.randrange(60)] = rng.choice(["zorgnax", "quibblor", "wretchnik"])
        docs.append((i, " ".join(text)))
        labels.append((i, int(i % 3 != 0), int(toxic)))
    return docs, labels


def test_misspellings_share_subwords(spark):
    docs, labels = made()
    extra = [(10_000, "abc zorgnaxx wretchniks zorgnaks " * 3 + docs[1][1]), (10_001, docs[1][1] + " " + docs[2][1])]
    out = toxicity.toxicity(spark.createDataFrame(docs + extra, DOCS),
                            spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    scores = {r.doc_id: r.score for r in out}
    assert scores[10_000] > 0.5 > scores[10_001]
    assert sum((scores[i] >= 0.5) == t for i, _, t in labels) / len(labels) > 0.95


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality.quality])
def test_odd_rows(spark, operator):
    docs, labels = made(200)
    frame = spark.createDataFrame(docs + ODD, DOCS).withColumn("score", F.lit("x")).withColumn("label", F.lit(1))
    labelled = spark.createDataFrame(labels + [(0, 1, 1), (1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = operator(frame, labelled).collect()
    assert len(rows) == len(docs) + len(ODD)
    assert all(0 <= r.score <= 1 for r in rows)
    nothing = operator(frame, labelled.limit(0)).collect()
    assert len({r.score for r in nothing}) == 1 and len(nothing) == len(rows)
    assert operator(frame.limit(0), labelled).count() == 0


def test_rejected_documents_go(spark):
    docs, labels = made(300)
    frame = spark.createDataFrame(docs, DOCS).withColumn("_x", F.lit(1))
    kept = toxicity.without_toxic(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert kept.columns == frame.columns
    left = {r.doc_id for r in kept.collect()}
    assert sum((i in left) != bool(t) for i, _, t in labels) > 280


def test_isotonic():
    rng = np.random.default_rng(0)
    at, y = np.arange(60.0), np.clip(np.arange(60) / 60 + rng.normal(0, .2, 60), 0, 1)
    places, values = quality.isotonic(at, y, np.ones(60))
    assert (np.diff(values) > 0).all() and (np.diff(places) > 0).all()
    assert np.interp(30, places, values) == pytest.approx(0.5, abs=0.2)


def counted(docs):
    tokens = {k: (t or "").encode().lower().split() for k, t in docs}
    train = collections.Counter()
    for (i, _), words in zip([k for k, _ in docs], tokens.values()):
        if not held_out(i, 1):
            train.update([*words, None])
    return tokens, train


def check_base(docs, rows):
    docs = [((i, n), t) for n, (i, t) in enumerate(docs)]
    tokens, train = counted(docs)
    total, kinds = sum(train.values()), len(train)
    want = sorted((str(k[0]), held_out(k[0], 1), len(w) + 1, sum(train[x] > 0 for x in [*w, None]), total, round(sum(
        math.log10((train[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in [*w, None]), 5)) for k, w in tokens.items())
    have = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)
    assert [h[:5] for h in have] == [w[:5] for w in want]
    assert [h[5] for h in have] == pytest.approx([w[5] for w in want], rel=1e-6, abs=1e-4)


def test_base_score_against_plain_counts(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    rows = op7_language_model(spark, folder).collect()
    check_base(docs, rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    # a text of known words is likelier than the same letters in another order, which nobody learns from
    per_token = {r.doc_id: r.score / r.n_tokens for r in rows}
    fresh = [i for i in range(100_000, 101_000) if held_out(i, 1)]
    shuffled = [(fresh[n], "".join(random.Random(n).sample(t, len(t)))) for n, (_, t) in enumerate(docs[:40])]
    again = lm.scores(spark.createDataFrame(docs + shuffled, DOCS).withColumn("token", F.lit(1))).collect()
    after = {r.doc_id: r.score / r.n_tokens for r in again}
    assert np.mean([after[i] for i in fresh[:40]]) < np.mean([per_token[i] for i, _ in docs[:40]]) - 1


def test_language_model_odd_rows(spark):
    docs = [(i, f"a b c{i % 7} \xe9t\xe9 A\vB") for i in range(30)] + ODD
    rows = lm.scores(spark.createDataFrame(docs, DOCS)).collect()
    check_base(docs, rows)
    assert all(math.isfinite(r.score) for r in rows)
    assert lm.scores(spark.createDataFrame([], DOCS)).count() == 0
    only_held_out = [(i, "a b") for i in range(200) if held_out(i, 1)]
    check_base(only_held_out, lm.scores(spark.createDataFrame(only_held_out, DOCS)).collect())


def plain_model(docs, settings):
    """The model from exact counters; counts of n-grams rounded as the filter rounds them, or not."""
    grams, spelt = [collections.Counter() for _ in range(3)], collections.Counter()
    for i, text in docs:
        if not held_out(i, 1):
            line = [1, *(text or "").encode().lower().split(), 2]
            for n in (1, 2, 3):
                grams[n - 1].update(tuple(line[j - n + 1:j + 1]) for j in range(max(1, n - 1), len(line)))
            for w in line[1:-1]:
                spelt.update(zip([None, *w], [*w, None]))
    total, kinds = sum(grams[0].values()), len(grams[0])
    after = collections.Counter()
    for (a, _), n in spelt.items():
        after[a] += n

    def rounded(n, quantised):
        if not n or not quantised:
            return n
        level = math.floor(math.log(n) / math.log(settings.base) + 1e-9)
        low = math.ceil(settings.base ** level - 1e-9)
        return (low + max(math.ceil(settings.base ** (level + 1) - 1e-9) - 1, low)) / 2

    def score(words, quantised):
        line, out = [1, *words, 2], 0.0
        for j in range(1, len(line)):
            w = line[j]
            letters = zip([None, *w], [*w, None]) if w != 2 else [(None, None)]
            chance = math.prod((spelt[p] + 1) / (after[p[0]] + 257) for p in letters)
            chance = (grams[0][(w,)] + (kinds + 1) * chance) / (total + kinds + 1)
            n = grams[0][(line[j - 1],)] if j > 1 else grams[0][(2,)]
            own = min(rounded(grams[1][tuple(line[j - 1:j + 1])], quantised), n)
            chance = (own + settings.prior * chance) / (n + settings.prior)
            if j > 1:
                n = rounded(grams[1][tuple(line[j - 2:j])], quantised)
                own = min(rounded(grams[2][tuple(line[j - 2:j + 1])], quantised), n)
                chance = (own + settings.prior * chance) / (n + settings.prior)
            out += math.log10(chance)
        return out

    return score


def test_language_model_against_exact_counts(spark, monkeypatch):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in rows.collect()] + [(70_000, ""), (70_001, None), (70_002, "Zebra zebra q\xe9z the the the")]
    monkeypatch.setattr(lm, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(lm, "BLOCK_KEYS", 5_000)
    monkeypatch.setattr(lm, "SPARE_BITS", 40)  # nor shared hashes
    sure = lm.Settings(hashes=24)  # next to no false hits
    have = {r.doc_id: r.score for r in lm.scores(spark.createDataFrame(docs, DOCS).repartition(3), settings=sure).collect()}
    assert len(have) == len(docs)
    score = plain_model(docs, sure)
    for i, text in docs:
        words = (text or "").encode().lower().split()
        assert have[i] == pytest.approx(score(words, True), rel=1e-6)
        # a rounded count is within 1.25 of the count, and a place has three of them
        assert abs(have[i] - score(words, False)) <= 3 * math.log10(1.25) * (len(words) + 1)
    usual = {r.doc_id: r.score for r in lm.scores(spark.createDataFrame(docs, DOCS)).collect()}
    assert np.median([abs(usual[i] / have[i] - 1) for i, _ in docs]) < 0.1


def test_order_of_words_counts(spark):
    rng = random.Random(4)
    kinds = [f"w{i}" for i in range(60)]
    follow = {w: rng.sample(kinds, 3) for w in kinds}

    def text():
        out = [rng.choice(kinds)]
        while len(out) < 40:
            out.append(rng.choice(follow[out[-1]]))
        return out

    docs = [(i, " ".join(text())) for i in range(400)]
    fresh = [text() for _ in range(30)]
    held = [i for i in range(1000, 3000) if held_out(i, 1)]
    docs += [(held[i], " ".join(t)) for i, t in enumerate(fresh)]
    docs += [(held[i + 30], " ".join(rng.sample(t, len(t)))) for i, t in enumerate(fresh)]
    docs += [(held[i + 60], " ".join(t[::-1])) for i, t in enumerate(fresh)]
    rows = {r.doc_id: r for r in lm.scores(spark.createDataFrame(docs, DOCS)).collect()}
    for i in range(30):
        own, mixed, back = (rows[held[i + k]] for k in (0, 30, 60))
        assert own.base_score == pytest.approx(mixed.base_score) and own.score > mixed.score + 10 and own.score > back.score + 10


def test_language_model_ids_of_other_types(spark):
    rows = lm.scores(spark.createDataFrame([("a", "x y"), ("b", "x"), (None, None)], "doc_id string, text string")).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == [("None", 1), ("a", 3), ("b", 2)]


def test_filter_never_misses():
    rng = np.random.default_rng(1)
    keys, settings = rng.integers(0, 1 << 63, 2000).astype(np.uint64), lm.Settings()
    count = rng.integers(1, 5000, 2000)
    held = lm.Filter.of(keys, count, settings)
    found = held.counts(keys)
    assert (found >= count / settings.base).all() and np.median(found / count) < settings.base
    assert (held.counts(rng.integers(0, 1 << 63, 2000).astype(np.uint64)) == 0).mean() > 0.8


def test_words_as_python_splits_them():
    texts = [b"", b"a  b\x0bc\td", b" \n ", "x\u00a0y \u2003 z".encode(), b"w" * 300, b"\x1c \x85 a"]
    data = b" " + b" ".join(texts) + b" "
    starts, ends = lm.spans(data)
    assert [data[s:e] for s, e in zip(starts, ends)] == data.split()
    hashes = lm.word_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(data.split()))
    at = lm.Places.of(data, np.array([len(t) for t in texts]), 40)
    assert (at.last - at.first).tolist() == [len(t.split()) for t in texts]
    assert (lm._unpacked(lm._packed(hashes)) == hashes).all() and len(lm._unpacked(lm._packed(hashes[:0]))) == 0


def test_spellings_sum_to_less_than_one():
    pairs = lm.byte_pairs(b" abc ab  b ")
    assert pairs[lm.EDGE * lm.CODES + ord("a")] == 2 and pairs.sum() == 9
    data = b" a ab abc " + b"x" * 300 + b" "
    logs = lm.spelled(data, *lm.spans(data), lm.spelling(pairs))
    assert np.isfinite(logs).all() and (10 ** logs).sum() < 1
