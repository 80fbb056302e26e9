import hashlib
import re

import pytest
from pyspark.sql import functions as F

from siltline.llm import pii
from siltline.llm.workload import op9_personal_data


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
]


def plain(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in PLAIN for m in re.finditer(p, text or "") if ok(m.group())]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_table_against_plain_search(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op9_personal_data(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k + ":") for w in want) for k, _, _ in PLAIN]


def test_odd_texts(spark):
    texts = [
        "a@b.c_d@e.f a@b..c x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004", "4111 1111 1111 1111-4111111111111111 1--5",
        "+1 (988) 555-2485) +12 +49-30.1234567 é+1 2", "a@" + "b." * 3000, "1 " * 3000, "9" * 3000 + ".1.2.3", "a" * 2000 + "@x.y",
        "é\U0001F600 a@b.de \U0001F600 1.2.3.4", "1.1.1.1 " * 450, None, "", " ", "+" * 50,
    ]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(None, "x@y.z"), (0, texts[0])], "doc_id long, text string") \
        .withColumn("found", F.lit(1)).withColumn("kind", F.lit("k"))
    rows = pii.personal_data(frame).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "x@y.z" if r.doc_id is None else texts[r.doc_id]
        assert [f"{m.kind}:{m.start}:{m.end}" for m in r.found if m.base] == plain(text)
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_added_kinds_and_context(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432", "DE88370400440532013000", "my ssn 123-45-6789",
             "part 123-45-6789", "visa card 4111111111111111", "order 4111111111111111"]
    rows = {r.doc_id: r.found for r in pii.personal_data(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [(m.kind, m.start, m.end) for m in rows[0]] == [("iban", 5, 32), ("iban", 37, 59)]
    assert rows[1] == [] and [m.kind for m in rows[2]] == ["ssn"] and rows[3] == []
    assert rows[4][0].score > 0.9 and rows[5][0].score < 0.5


def test_account_codes_before_capital_words(spark):
    code = "BE68 5390 0754 7034"
    texts = [f"account {code}{tail}" for tail in ("", " EUR", " TOTAL", " Total", " TOTAl", " PAID IN FULL", ", EUR", "\nEUR")]
    wrong = [f"account {code[:-1]}5 EUR", "account BE68539007547034EUR", "account BE68 5390 0754", "account BE68 5390 0754 703"]
    other = ["account NO93 8601 1117 947 NOK", "konto DE89370400440532013000 EUR"]
    rows = {r.doc_id: [(m.kind, m.start, m.end) for m in r.found if m.kind == "iban"] for r in pii.personal_data(
        spark.createDataFrame(list(enumerate(texts + wrong + other)), "doc_id long, text string")).collect()}
    assert all(rows[i] == [("iban", 8, 27)] for i in range(len(texts)))
    assert all(rows[len(texts) + i] == [] for i in range(len(wrong)))
    assert rows[len(rows) - 2] == [("iban", 8, 26)] and rows[len(rows) - 1] == [("iban", 6, 28)]


def test_long_texts_stay_near_linear(spark):
    long = [(1, "a" * 1_000_000), (2, "9" * 1_000_000), (3, "+1" * 300_000), (4, "AB12 " * 100_000)]
    rows = pii.personal_data(spark.createDataFrame(long, "doc_id long, text string")).select(F.size("found")).collect()
    assert len(rows) == 4
