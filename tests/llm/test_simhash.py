import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from siltline.llm import simhash
from siltline.llm.components import components
from siltline.llm.workload import op8_simhash_near_duplicates

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, near):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if near(a, b):
            root[find(b)] = find(a)
    return {n: find(n) for n in nodes}


def expected(docs, distance=2):
    prints = [plain_fingerprint(t) for _, t in docs]
    groups = plain_components(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= distance)
    least = {}
    for (i, _), p in zip(docs, prints):
        if i is not None:
            least[groups[p]] = min(least.get(groups[p], i), i)
    return sorted(((i, f"{p:016x}", least.get(groups[p])) for (i, _), p in zip(docs, prints)), key=str)


def test_table_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = [tuple(r) for r in op8_simhash_near_duplicates(spark, folder).collect()]
    assert sorted(found, key=str) == expected(docs)


def test_odd_rows(spark):
    docs = [(3, None), (4, ""), (None, "a b c d"), (None, "a b c d"), (5, " \t\n"), (6, "one"), (6, "one"),
            (7, "ONE"), (8, "É É"), (9, "x " * 70_000), (10, "a b c d"), (11, "a b\vc\fd")]
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("fp", F.lit(1)).withColumn("root", F.lit("r"))
    found = [tuple(r) for r in simhash.near_duplicates(frame)
             .select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(found, key=str) == expected(docs)
    only = [(None, "q r s"), (None, "q r s")]
    assert [r.component_id for r in simhash.near_duplicates(spark.createDataFrame(only, SCHEMA)).collect()] == [None] * 2
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_links_short_and_long_lists(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base[:6]:
        for _ in range(5):
            fps.add(b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    for _ in range(120):  # a dense group in one list
        fps.add(base[0] ^ (1 << rng.randrange(16)) ^ (1 << rng.randrange(16)) ^ (1 << rng.randrange(16)))
    signed = {f: f - (1 << 64) * (f >> 63) for f in fps}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    found = {r.node: r.root for r in components(simhash.link_fingerprints(frame, distance)).collect()}
    want = plain_components(sorted(fps), lambda a, b: (a ^ b).bit_count() <= distance)
    mine = {f: found.get(s, s) for f, s in signed.items()}
    for a, b in itertools.combinations(sorted(fps), 2):
        assert (mine[a] == mine[b]) == (want[a] == want[b])


@pytest.mark.parametrize("distance", [1, 2])
@pytest.mark.parametrize("long_list", [2, 32])
def test_shared_bytes_are_counted(spark, monkeypatch, distance, long_list):
    """The counted pairs are those with enough shared bytes, whatever their bits: without the count,
    pairs that share four or five bytes would be among them."""
    monkeypatch.setattr(simhash, "LONG_LIST", long_list)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(4)]
    fps = set(base)
    for b in base:
        for changed in (1, 1, 2, 2, 2, 3, 3, 4):
            fps.add(sum((b >> 8 * p & 255 ^ (rng.randrange(1, 256) if p in chosen else 0)) << 8 * p
                        for chosen in [rng.sample(range(8), changed)] for p in range(8)))
    fps.update(base[0] ^ last for last in (1, 77, 200, 255))  # a list that stays long
    signed = {f - (1 << 64) * (f >> 63): f for f in fps}
    pairs, long = simhash.tallied(spark.createDataFrame([(s,) for s in signed], "fp long"), distance)
    left = {}
    for r in long.collect():
        left.setdefault((r.choice, r.bytes), set()).add(signed[r.fp])
    found = {frozenset((signed[r.a], signed[r.b])) for r in pairs.collect()}
    found |= {frozenset(p) for members in left.values() for p in itertools.combinations(members, 2)}

    def apart(a, b):
        return sum((a ^ b) >> 8 * p & 255 != 0 for p in range(8))

    every = list(itertools.combinations(fps, 2))
    assert found == {frozenset(p) for p in every if apart(*p) <= distance}
    assert any(apart(*p) == 3 for p in every)
    assert bool(left) == (long_list == 2)


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark):
    docs = [(1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (9, "else where it is"), (9, "else where it is"),
            (None, "no id here at all"), (None, "no id here at all"), (12, None), (13, "")]
    kept = sorted((tuple(r) for r in simhash.keep_one(spark.createDataFrame(docs, SCHEMA)).collect()), key=str)
    assert kept == sorted([(1, "a b c d e"), (9, "else where it is"), (None, "no id here at all"), (12, None)], key=str)


def test_distance_beyond_the_index():
    with pytest.raises(ValueError):
        simhash.link_fingerprints(None, 3)
