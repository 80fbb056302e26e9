"""Personal data: proposed by patterns, confirmed by checksums, scored by context words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import matches, whole

# Groups are repeated possessively, which Java's matcher does in a loop; an unguarded start would
# scan a long run again from each of its characters.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}(?![a-z])){2,7}+"
        r"(?:\x20?[A-Z0-9]{1,3}+(?![A-Za-z0-9]))?+(?![A-Za-z0-9])")
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

# The number of characters of an IBAN by country.
IBAN_SIZES = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20,
}


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The Luhn sum of a string of digits is a multiple of ten."""
    def worth(c: Column, i: Column) -> Column:
        v = c.cast("int")
        return F.when(i % 2 == 1, 2 * v - F.when(v > 4, 9).otherwise(0)).otherwise(v)

    each = F.transform(F.split(F.reverse(number), ""), worth)
    return F.aggregate(each, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(code: Column) -> Column:
    """The remainder of an account code is 1, its first four characters moved to the end."""
    plain = F.replace(code, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        digit = c.between("0", "9")
        return F.when(digit, rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _own_size(m: Column) -> Column:
    """The match of an IBAN without the capital words behind it: cut to the country's number of characters,
    empty if it has fewer or more of them in one run. Other countries' are left as they are."""
    sizes = F.create_map(*[F.lit(x) for pair in IBAN_SIZES.items() for x in pair])
    size = F.try_element_at(sizes, F.left(m["found"], F.lit(2)))
    pattern = F.concat(F.lit(r"^(?:\x20?[A-Z0-9]){"), size.cast("string"), F.lit("}(?![A-Z0-9])"))
    kept = F.when(size.isNull(), m["found"]).otherwise(F.coalesce(F.regexp_substr(m["found"], pattern), F.lit("")))
    return F.struct(m["start"].alias("start"), (m["start"] + F.length(kept)).alias("end"), kept.alias("found"),
                    m["before"].alias("before"),
                    F.concat(F.substr(m["found"], F.length(kept) + 1), m["after"]).alias("after"))


def _octets(found: Column) -> Column:
    return F.forall(F.split(found, r"\."), lambda part: F.length(F.ltrim(part, F.lit("0"))) <= 3) & F.forall(
        F.split(found, r"\."), lambda part: F.try_to_number(
            F.lpad(F.right(part, F.lit(3)), 3, "0"), F.lit("999")) <= 255)


def _length(found: Column, low: int, high: int) -> Column:
    return F.length(digits(found)).between(low, high)


@dataclass(frozen=True)
class Kind:
    """A kind of span. ``score`` is what a confirmed match is worth, ``words`` near it add 0.3 and
    ``against`` take 0.3 away; kinds beyond the base ones need ``least``."""

    name: str
    pattern: str
    base: bool
    score: float
    words: str
    against: str
    least: float = 0.5


KINDS = [
    Kind("email", EMAIL, True, 0.7, "mail|contact|write|address|kontakt|correo", "example|noreply"),
    Kind("ip", IP, True, 0.6, r"\bip\b|host|server|address|login|client", "version|release|section"),
    Kind("card", CARD, True, 0.7, "card|visa|master|credit|debit|payment|karte|tarjeta|carte", "order|tracking|isbn|serial"),
    Kind("phone", PHONE, True, 0.6, "phone|call|tel|mobile|fax|cell", "version|isbn|score"),
    Kind("iban", IBAN, False, 0.7, "iban|account|bank|konto|cuenta|compte", "serial|order"),
    Kind("ssn", SSN, False, 0.3, r"\bssn\b|social security|taxpayer|tax id", "order|part|serial|phone"),
]
NEAR = 40


def _confirmed(kind: str, found: Column) -> Column:
    if kind == "ip":
        return _octets(found)
    if kind == "card":
        return F.when(_length(found, 13, 19), luhn(digits(found))).otherwise(F.lit(False))
    if kind == "phone":
        return _length(found, 9, 15)
    if kind == "iban":
        return mod97(found)
    return F.lit(True)


def _possible(kind: str) -> Column:
    """A cheap test that every text with such a match passes."""
    text = F.col("text")
    return {
        "email": text.contains("@"), "phone": text.contains("+"), "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike("[0-9]"), "iban": text.rlike("[A-Z]{2}[0-9]{2}"), "ssn": text.rlike("[0-9]-[0-9]{2}-"),
    }[kind]


def personal_data(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``found``: an array of ``kind, start, end, score, base`` by kind, then start.

    Places are code points, the end is exclusive. Matches of a kind don't overlap; one that fails
    its check is dropped and not tried again. Everything happens within a row: nothing is
    shuffled. Texts of any length are searched whole. NULL and empty texts have none, repeated rows each
    their own; a NULL id stays; other columns are ignored. No documents, no rows.
    """
    step = documents.select("doc_id", whole(F.col("text")).alias("text"))
    for kind in KINDS:
        step = matches(step, kind.pattern, "_" + kind.name, _possible(kind.name))
    return step.select("doc_id", F.concat(*[_scored(kind) for kind in KINDS]).alias("found"))


def _scored(kind: Kind) -> Column:
    every = F.transform("_" + kind.name, _own_size) if kind.name == "iban" else F.col("_" + kind.name)
    good = F.filter(every, lambda m: _confirmed(kind.name, m["found"]))

    def told(m: Column) -> Column:
        near = F.lower(F.concat_ws(" ", F.right(m["before"], F.lit(NEAR)), F.left(m["after"], F.lit(NEAR))))
        score = (F.lit(kind.score) + F.when(near.rlike(kind.words), 0.3).otherwise(0.0)
                 - F.when(near.rlike(kind.against), 0.3).otherwise(0.0))
        return F.struct(F.lit(kind.name).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
                        F.round(score, 1).alias("score"), F.lit(kind.base).alias("base"))

    scored = F.transform(good, told)
    return scored if kind.base else F.filter(scored, lambda m: m["score"] >= kind.least)
