import hashlib
import random
import zlib

import numpy as np
import pytest

from siltline.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string"


def conversations(rows):
    """conv_id -> turns in order; ties are not made here."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(turns)] for c, turns in own.items()}


def plain_rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def expected(seqs):
    members = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    if not seqs:
        return []
    own = {v: (len(m) - 1) * len(v[-1][1].split()) if v else 0 for v, m in members.items()}
    children = {v: 0 for v in members}
    for v in members:
        if v:
            children[v[:-1]] += 1
    out = []
    for v, m in members.items():
        below = [u for u in members if u[:len(v)] == v]
        ends = ",".join(map(str, sorted(c for c in m if len(seqs[c]) == len(v))))
        out.append((min(m), len(v), min(members[v[:-1]]) if v else None, len(m), children[v],
                    sum(children[u] == 0 for u in below), sum(own[u] for u in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(frame, **options):
    seqs = prefix_trie.rebuilt(prefix_trie.sequences(frame))
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(seqs, **options).collect()), key=str)


def made(seed, n, longest, choices=3):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(10 * n), n):
        for turn in range(draw.randrange(1, longest)):
            rows.append((c, turn, draw.choice(["user", "assistant"]), " ".join(["word"] * draw.randrange(choices))))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("slice_bytes", [1 << 20, 700, 60])
def test_against_all_prefixes(spark, slice_bytes):
    """One slice, some, and nearly one for each sequence."""
    rows = made(1, 120, 9)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(frame, slice_bytes=slice_bytes) == expected(plain_rebuilt(conversations(rows)))


def test_shared_turns_over_many_slices(spark):
    """One conversation that many repeat, one long shared beginning, and one first turn of all."""
    rows = [(c, t, "user", "hello there") for c in range(0, 60) for t in range(3)]
    rows += [(c, t, "user", f"turn {t}" if t < 40 else f"own {c}") for c in range(100, 130) for t in range(42)]
    rows += [(c, t, None, "hello there" if t == 0 else f"x {c % 7}") for c in range(200, 240) for t in range(4)]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = expected(plain_rebuilt(conversations(rows)))
    for slice_bytes in (1 << 20, 3000, 200):
        assert got(frame, slice_bytes=slice_bytes) == want


def test_odd_rows(spark):
    rows = [(0, 1, "u", "a b"), (1, None, None, "x"), (1, 0, "u", None), (1, 2, "", ""), (None, 0, "u", "no id"),
            (20, 5, "u", "only one"), (21, 0, "u", "short"), (45, 0, "u", "base is absent"), (-3, 0, "u", "negative"),
            (7, 0, "u", "a b"), (8, 0, "u", "a b"), (9, 0, "u:", "a"), (10, 0, "u", ":a")]
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows], SCHEMA + ", path string, words int")
    own = conversations(rows)
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:]
    assert any(not s for s in seqs.values())
    assert got(frame) == expected(seqs)
    assert got(frame.limit(0)) == []
    # nothing but conversations without turns: the root is a leaf
    bare = spark.createDataFrame([(4, "", [])], "conv_id long, path string, words array<int>")
    assert [tuple(r) for r in prefix_trie.prefix_trie(bare).collect()] == expected({4: []})


def test_extents_by_binary_search():
    draw = np.random.default_rng(4)
    for n in (1, 2, 3, 50, 257):
        shared = draw.integers(0, 4, n - 1)
        row, depth = draw.integers(0, n, 200), draw.integers(1, 5, 200)
        left, right = prefix_trie.Neighbours(shared, n).extents(row, depth)
        for r, d, a, b in zip(row, depth, left, right):
            low = high = r
            while low and shared[low - 1] >= d:
                low -= 1
            while high < n - 1 and shared[high] >= d:
                high += 1
            assert (low, high) == (a, b)


def test_ids_of_a_hot_path_stream_through_one_digest(spark):
    rows = [(c, "a" * 32, [2]) for c in range(5, 3000, 2)] + [(-9, "a" * 32, [2]), (0, "b" * 32, [1])]
    frame = spark.createDataFrame(rows, "conv_id long, path string, words array<int>").repartition(6)
    found = {r.path: r for r in prefix_trie.distinct_paths(frame).collect()}
    ids = ",".join(map(str, sorted(c for c, p, _ in rows if p[0] == "a")))
    assert found["a" * 32].ends == hashlib.sha256(ids.encode()).hexdigest()
    assert (found["a" * 32].n, found["a" * 32].least) == (1499, -9)
