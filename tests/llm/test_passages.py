import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from siltline.llm import passages

SCHEMA = "doc_id long, text string"


def expected(rows, window):
    """Every window of every text in one dictionary."""
    first = {}
    place = lambda d, i: (d is None, d or 0, i)
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, words in split:
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            first[w] = min(first.get(w, place(d, i)), place(d, i))
    out = []
    for d, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if place(d, i) > first[tuple(words[i:i + window])]:
                gone.update(range(i, i + window))
        out.append((d, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def got(frame, window, gram=2):
    return sorted((tuple(r) for r in passages.without_repeats(frame, window, gram).collect()), key=str)


def texts(seed, n, vocabulary=6, longest=60):
    draw = random.Random(seed)
    made = []
    for i in range(n):
        words = [f"w{draw.randrange(vocabulary)}" for _ in range(draw.randrange(longest))]
        if made and draw.random() < 0.6:  # a passage of another text
            other = draw.choice(made)[1].split()
            a = draw.randrange(len(other) + 1)
            words[draw.randrange(len(words) + 1):0] = other[a:a + draw.randrange(30)]
        made.append((i, " ".join(words)))
    return made


@pytest.mark.parametrize("window, gram", [(5, 1), (5, 2), (8, 3), (4, 4), (1, 1)])
def test_against_all_windows(spark, window, gram):
    rows = texts(window, 60)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5), window, gram) == expected(rows, window)


def test_odd_rows(spark):
    line = "a b c d e f g"
    rows = [(3, line), (None, line), (3, line), (3, "x " + line), (1, None), (2, ""), (5, "a b"), (None, "q " + line),
            (7, line + " " + line), (8, "\t" + line.replace(" ", " \n") + "\u00a0"), (9, line + " h"), (9, "é " + line + " é")]
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", key int, start string").repartition(4)
    assert got(frame, 5) == [tuple(r) for r in expected([(d, t) for d, t in rows], 5)]
    assert got(frame.limit(0), 5) == []
    named = frame.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert {r[0]: r[2] for r in got(named, 5) if r[0]}["d7"] == 14


def test_long_text_in_segments_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(passages, "CHUNK_WORDS", 50)
    monkeypatch.setattr(passages, "FLUSH", 20)
    draw = random.Random(1)
    long = " ".join(draw.choice("abcd") for _ in range(700))
    rows = [(1, "a " * 300), (2, long), (3, long[400:900]), (4, "b " * 120)]
    blocks = [b for c in passages.segments([t for _, t in rows], 6) for b in c]
    assert max(len(b.words) for b in blocks) == 55
    assert got(spark.createDataFrame(rows, SCHEMA), 6) == expected(rows, 6)


def test_crowded_minimiser_is_split(spark, monkeypatch):
    """A passage in every text, with different words around it."""
    rows = [(i, f"u{i} v{i} x{i} y{i} one two three four five p{i} q{i} r{i} s{i}") for i in range(400)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumn("key", F.xxhash64("text"))
    monkeypatch.setattr(passages, "HOT", 0)
    assert passages.crowded_cells(frame, 6, 3, 1 << 12) == []  # below 1000 strings nothing is crowded
    every = list(range(1 << 12))
    strings = passages.packed_strings(frame, 6, 3, 256, 1 << 12, every)
    found = passages.later_places(strings, frame, 6)
    plain = passages.later_places(passages.packed_strings(frame, 6, 3, 256, 1 << 12, []), frame, 6)
    assert found.count() == plain.count() == 0
    assert got(frame, 5) == expected(rows, 5)
    # dealt by themselves, the windows are spread over the buckets
    assert strings.select("bucket").distinct().count() > 200


def test_windows_travel_together(spark):
    """Super-k-mers: about (grams of a window + 1) / 2 windows each, every window once."""
    draw = random.Random(3)
    words = [f"w{draw.randrange(10 ** 6)}" for _ in range(20_000)]
    chunk = next(passages.segments([" ".join(words)], 20))
    found = passages.runs(chunk, 20, 4)
    assert found.windows.sum() == len(words) - 19
    assert 7.5 < found.windows.mean() < 10
    assert (found.first[1:] == found.first[:-1] + found.windows[:-1]).all()


def test_query_columns(spark):
    from siltline.llm.workload import work

    rows = {r.doc_id: r for r in work.queries["op12_repeated_passages"](spark, "/root/testdata/sf0.001").collect()}
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for d, n, gone, kept in expected(docs, 20):
        assert (rows[d].n_words, rows[d].n_removed, rows[d].kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
