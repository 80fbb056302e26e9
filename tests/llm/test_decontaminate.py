from pyspark.sql import functions as F

from siltline.llm.decontaminate import leaks
from siltline.llm.workload import op6_benchmark_leaks

ITEM = ("In the morning Maria buys 12 apples for 3 dollars each and walks 5 km home, then Maria sells 4 apples "
        "to her neighbour for 20 dollars.")
OTHER = ITEM.replace("Maria", "Peter").replace("12", "17").replace(" 3 dollars", " 9 dollars") \
    .replace("5 km", "8 km").replace("4 apples", "6 apples").replace("20", "31")
DOCS = "doc_id long, text string"


def found(spark, docs, items, **more):
    documents = spark.createDataFrame(docs, DOCS).withColumn("item_id", F.lit("x")).withColumn("key", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit(0))
    return {(r.doc_id, r.item_id): r for r in leaks(documents, benchmark, **more).collect()}


def test_table_against_plain_search(spark):
    import re
    folder = "/root/testdata/sf0.001"
    plain = {t: [(r[0], " ".join(re.findall(r"\w+", r[1].lower()))) for r in spark.read.parquet(
        f"{folder}/{t}.parquet").select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id"))}
    want = {(i, j) for i, t in plain["documents"] for j, u in plain["benchmark"] if u in t}
    assert {(r.doc_id, r.item_id) for r in op6_benchmark_leaks(spark, folder).collect()} == want and want


def test_other_values_are_caught_if_consistent(spark):
    mixed = OTHER.replace("then Peter", "then Paul")  # one name for another in one place only
    hits = found(spark, [(1, "Noise before it. " + ITEM), (2, "so it goes: " + OTHER + " And on."), (3, mixed),
                         (4, "In the morning he buys apples and walks home."), (5, ITEM[:60])], [(7, ITEM)], min_tokens=22)
    assert set(hits) == {(1, 7), (2, 7)}
    assert hits[1, 7].exact and not hits[2, 7].exact and hits[2, 7].n_slots >= 6
    assert hits[1, 7].first_token == 3


def test_odd_rows(spark):
    short = "Only six words are in here"
    docs = [(1, None), (2, ""), (None, "x " + ITEM), (4, ITEM), (4, ITEM), (5, "and " + short + " too"), (6, "1 " * 30_000 + ITEM)]
    items = [(7, ITEM), (7, ITEM), (8, None), (9, "too short"), (None, short), (10, "1 2 3 4 5 6 7 8 9 10 11 12 13")]
    assert set(found(spark, docs, items)) == {(None, 7), (4, 7), (5, None), (6, 7)}
    assert found(spark, docs, []) == {} and found(spark, [], items) == {}


def test_verbatim_copies_of_slots_and_short_items(spark):
    row, names, short = "What is the next number: 2, 4, 8, 16, 32, 64?", "Tom 3, Ann 4, Bob 5, Lucy 6, Emma 7, Jack 8", "Add 12 and 12"
    items = [(1, row), (2, names), (3, short)]
    docs = [(1, "A quiz. " + row + " Well."), (2, "so " + names + ". Then"), (3, "now Add 12 and 12. Well"),
            (4, "What is the next number: 3, 5, 9, 17, 33, 65?"), (5, "now Add 13 and 13. Well"), (6, "Tom 9, Ann 8, Bob 7, Lucy 6, Emma 5, Jack 4")]
    hits = found(spark, docs, items)
    assert {(1, 1), (2, 2), (3, 3)} == set(hits)
    assert all(r.exact for r in hits.values()) and hits[1, 1].n_tokens == 11


def test_a_shared_stem_is_no_leak(spark):
    stem = "Which of the following statements about the passage above is correct in every case: "
    items = [(1, stem + "whales"), (2, stem + "otters"), (3, stem + "otters"), (4, stem), (5, ITEM), (6, OTHER)]
    docs = [(1, "x " + stem + "foxes, he said."), (2, stem + "whales"), (3, "a " + stem + "otters."), (4, ITEM), (5, OTHER[:90])]
    hits = set(found(spark, docs, items[:3] + items[4:]))
    # items of one template hold the same windows, which are still their own
    assert hits == {(2, 1), (3, 2), (3, 3), (4, 5), (4, 6), (5, 5), (5, 6)}
    assert set(found(spark, docs[:1], items)) == {(1, 4)}


def test_joined_without_broadcast(spark, monkeypatch):
    from siltline.llm import decontaminate
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert set(found(spark, [(1, OTHER)], [(7, ITEM)])) == {(1, 7)}
