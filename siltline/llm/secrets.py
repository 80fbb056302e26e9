"""Secret scans: proposed strings, judged by a random forest trained from labelled findings."""

from __future__ import annotations

from string import ascii_letters, digits

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import staged
from .columns import carried, matches, sampled

KEYWORDS = r"passwd|password|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth"
# Every place of every text is tried. Classes of single characters are one lookup each, ranges are several.
BEGINS = r"(?=[PpSsTtAaCc][AaEeOoPpCcRrUu][SsCcKkIiEeTt])"  # as all keywords do
LEAD = BEGINS + r"(?i:" + KEYWORDS + r")[A-Za-z0-9_]{0,20}+[\"']?[ \t]*+(?::=|=>?|:)[ \t]*+[\"']?"
USER = r"://[^\s/:@\"']*+:"
PREFIX = r"A[KS]IA[0-9A-Z]{16}|gh[opsru]_|github_pat_|glpat-|xox[abprs]-|[rs]k_live_|AIza"
IN_RUN = f"[{ascii_letters}{digits}+/_-]"
RUN = f"(?<!{IN_RUN})(?={IN_RUN}{{16}})(?={PREFIX}|[{ascii_letters}+/_-]*+[{digits}]){IN_RUN}{{16,}}+"
# all up to the closing quote, or up to a separator
VALUE = r"(?:(?<=\")[^\s\"]{6,}+(?=\")|(?<=')[^\s']{6,}+(?=')|[^\s\"',;=:]{6,}+)"
# a value assigned to a name that holds a keyword, a password in a URL, or a long run that holds a
# digit or starts as providers' keys do
PROPOSALS = LEAD + VALUE + r"|" + USER + r"[^\s/@\"']{6,}+(?=@)|" + RUN
HARMLESS = r"commit|sha1|sha256|sha512|md5|checksum|digest|revision|uuid|guid|hash|etag|version|isbn|image|example"
DICTIONARY = ("about|access|account|admin|api|app|article|auth|base|build|case|change|class|client|code|common|config|"
              "content|control|count|create|data|date|default|delete|demo|doc|dummy|error|event|example|fake|field|file|"
              "first|format|from|function|get|group|handler|header|html|how|http|image|index|info|item|json|key|last|"
              "library|list|load|local|main|manager|message|model|module|my|name|new|node|not|number|object|option|order|"
              "page|param|path|placeholder|product|query|read|real|request|response|result|sample|script|secret|server|"
              "service|set|size|source|src|start|state|string|style|system|table|test|text|the|time|title|to|token|type|"
              "update|url|use|user|util|value|version|view|web|with|word|write|your")
NEAR = 40  # characters on either side that count as neighbours
FEATURES = ["length", "transitions", "distinct", "digits", "uppercase", "hexadecimal", "coverage", "path",
            "assigned", "quoted", "warned", "harmless"]


def proposals(documents: DataFrame) -> DataFrame:
    """``doc_id, key, path, start, end, value, lead, before, after``, a row per proposed string.

    ``key`` is a hash of the text; rows repeated with id and text are told once."""
    texts = documents.select("doc_id", "text", F.col("source").cast("string").alias("path"))
    found = matches(texts.filter(F.col("text").rlike(PROPOSALS)).withColumn("key", F.xxhash64("text")), PROPOSALS, "spans")
    # no filter on the spans, not even the one that Spark adds to an inner inline: it would be pushed
    # to the scan, with a copy of all searches for every use of their results
    found = found.select("doc_id", "key", "path", F.inline_outer("spans"))
    lead = F.regexp_extract("found", f"^(?:{LEAD}|{USER})", 0)
    return found.select(
        "doc_id", "key", "path", (F.col("start") + F.length(lead)).alias("start"), "end",
        F.substr("found", F.length(lead) + 1).alias("value"), lead.alias("lead"),
        F.right("before", F.lit(NEAR)).alias("before"), F.left("after", F.lit(NEAR)).alias("after"),
    ).dropDuplicates(["doc_id", "key", "start"])


def features(findings: DataFrame) -> DataFrame:
    """Adds the forest's inputs to rows of ``value, lead, before, after, path``."""
    value, around = F.col("value"), F.lower(F.concat_ws(" ", "before", "lead", "after"))
    size = F.greatest(F.length(value), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(value, pattern, "")) / size

    turns = (r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"
             r"|(?<=[A-Za-z0-9])(?=[^A-Za-z0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])")
    made = {
        "length": F.least(size, F.lit(200.0)),
        "transitions": F.regexp_count(value, F.lit(turns)) / size,
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
        "digits": share("[^0-9]"),
        "uppercase": share("[^A-Z]"),
        "hexadecimal": share("[^0-9a-fA-F]"),
        "coverage": 1 - share("(?i:" + DICTIONARY + ")"),
        "path": (F.regexp_count(value, F.lit("/")) + F.coalesce(F.col("path"), F.lit("")).rlike(
            "(?i)test|example|sample|fixture|demo").cast("int")
            + F.coalesce("before", F.lit("")).rlike(r"[:/.\\]$").cast("int")).cast("double"),
        "assigned": (F.length("lead") > 0).cast("double"),
        "quoted": F.concat_ws("", "before", "lead").rlike("[\"']$").cast("double"),
        "warned": around.rlike(KEYWORDS).cast("double"),
        "harmless": around.rlike(HARMLESS).cast("double"),
    }
    return findings.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in made.items()})


def example_findings(spark: SparkSession, n: int = 6000) -> DataFrame:
    """Labelled findings made from a rule, for use where nobody has triaged any: the forms that
    providers and configuration files give secrets (label 1), and the commits, digests, ids, paths,
    numbers and placeholders that scanners report wrongly (label 0)."""
    i = F.col("id").cast("string")
    sha, md = F.sha1(i.cast("binary")), F.md5(i.cast("binary"))
    long, n_chars = F.sha2(i.cast("binary"), 256), (14 + F.col("id") % 8).cast("int")
    upper = F.translate(F.upper(F.left(long, F.lit(16))), "0123456789ABCDEF", "QWERTYUIOPLKJ274")
    b64 = F.translate(F.base64(F.unhex(long)), "=", "")
    card = F.concat(F.lit("4"), F.lpad(F.conv(F.left(md, F.lit(12)), 16, 10), 15, "0"))
    prose, lit = F.concat(F.translate(F.left(sha, F.lit(7)), "0123456789", "ghijklmnop"), F.lit(" of the ")), F.lit
    letters, mixed = F.translate(upper, "274", "ZXV"), F.concat(F.left(b64, lit(4)), lit("!"), F.substring(b64, 6, 5))
    name = F.translate(F.left(sha, (6 + F.col("id") % 4).cast("int")), "0123456789", "ghijklmnop")
    forms = [  # before, lead, value, after, label
        (F.concat(prose, lit("db")), lit("Password="), mixed, lit(" "), 1),
        (F.concat(prose, lit("client")), lit('Secret: "'), mixed, lit('"\n'), 1),
        (prose, lit('password  =  "'), F.left(b64, lit(10)), lit('"\n'), 1), (prose, lit("token\t=\t"), mixed, lit("\n"), 1),
        (prose, lit(""), F.concat(lit("AKIA"), letters), lit(" "), 1),
        (F.concat(prose, lit("postgres")), lit("://bob:"), F.left(b64, lit(10)), lit("@db/x"), 1),
        (F.concat(prose, lit("https")), lit("://admin:"), mixed, lit("@host/"), 1),
        (F.concat(prose, lit("https")), lit("://user:"), lit("password"), lit("@host/"), 0),
        (prose, lit("author: "), F.initcap(name), lit(" "), 0), (prose, lit("tokens: "), name, lit(", "), 0),
        (F.concat(prose, lit("user")), lit("Password = "), lit("request.getParameter"), lit("("), 0),
        (prose, lit('token = "'), sha, lit('" and '), 1), (prose, lit(""), F.concat(lit("AKIA"), upper), lit(" is "), 1),
        (prose, lit("password="), F.left(md, n_chars), lit(" in "), 1), (prose, lit('api_key: "'), b64, lit('"\n'), 1),
        (prose, lit("secret="), F.left(b64, n_chars), lit(" to "), 1), (prose, lit("auth_token: "), long, lit("\n"), 1),
        (prose, lit(""), F.concat(lit("ghp_"), F.left(b64, lit(36))), lit(" "), 1),
        (prose, lit(""), F.concat(lit("AKIA"), upper), lit(".\n"), 1),
        (F.concat(prose, lit("commit ")), lit(""), sha, lit(" and "), 0),
        (F.concat(prose, lit("sha256:")), lit(""), long, lit(" "), 0),
        (F.concat(prose, lit("uuid ")), lit(""), F.concat_ws("-", F.left(md, lit(8)), F.substring(md, 9, 4),
                                                              F.substring(md, 13, 4), F.right(md, lit(12))), lit(" "), 0),
        (prose, lit(""), card, lit(" is "), 0), (prose, lit(""), F.left(card, lit(16)), lit(". "), 0),
        (F.concat(prose, lit("http:")), lit(""), F.concat(lit("//web/article/how-to-use/"), F.left(md, lit(4)), lit("1")), lit(" "), 0),
        (prose, lit(""), F.concat(lit("src/module"), i, lit("/test_case/file_name")), lit(" "), 0),
        (prose, lit(""), F.concat(lit("getUserNameFromRequest"), i), lit("() "), 0),
        (prose, lit('token = "'), F.concat(lit("your_token_value_"), i), lit('" '), 0),
        (prose, lit("password="), F.concat(lit("example_password"), i), lit(" "), 0),
        (F.concat(prose, lit("md5 checksum ")), lit(""), md, lit(" "), 0),
    ]
    rows = F.array(*[F.struct(b.alias("before"), l.alias("lead"), v.alias("value"), a.alias("after"),
                              F.lit(float(y)).alias("label")) for b, l, v, a, y in forms])
    return spark.range(0, n, 1, 2).select(F.lit("src").alias("path"),
                                          F.get(rows, (F.col("id") % len(forms)).cast("int")).alias("r")) \
        .select("path", "r.*")


def train(labelled: DataFrame, *, sample: int = 20_000, trees: int = 30, depth: int = 7,
          seed: int = 0) -> RandomForestClassificationModel:
    """A forest from findings with ``label`` (1: a secret). About ``sample`` findings, chosen by the
    hash of their strings, are used if there are more; NULL labels are left out."""
    given = features(labelled.filter("label is not null").withColumn("label", F.col("label").cast("double")))
    chosen = sampled(staged(given.select("value", "label", *FEATURES), "labelled"), "value", sample)
    inputs = VectorAssembler(inputCols=FEATURES, outputCol="inputs").transform(chosen)
    return RandomForestClassifier(featuresCol="inputs", labelCol="label", numTrees=trees, maxDepth=depth,
                                  seed=seed).fit(inputs)


def judged(documents: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All proposals with ``score``, the forest's share of votes for a secret."""
    found = features(proposals(documents))
    model = train(example_findings(documents.sparkSession) if labelled is None else labelled)
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="inputs").transform(found))
    return scored.withColumn("score", vector_to_array("probability")[1])


def secrets(documents: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """The secrets in all texts: ``doc_id, start, end`` (code points, end exclusive), ``value``,
    ``score``, ``key`` (hash of the text).

    NULL and empty texts have none; a NULL id or source stays. Rows repeated with id and text give
    their findings once. Other columns are ignored.
    """
    return judged(documents, labelled).filter(F.col("score") >= threshold) \
        .select("doc_id", "start", "end", "value", "score", "key")


def redact(documents: DataFrame, labelled: DataFrame | None = None, *, mark: str = "[secret]",
           threshold: float = 0.5) -> DataFrame:
    """The documents with every secret replaced by ``mark`` where it was found, and ``n_chars``
    counted anew, where there is such a column and the text has changed.

    Findings that overlap get one mark. All rows and columns stay, whatever the names; NULL and empty
    texts are as they were, rows repeated with id and text change alike. Texts without proposals,
    however long, pass by unmoved; only the others are joined. No documents, no rows.
    """
    found = secrets(documents, labelled, threshold)
    lists = found.groupBy(F.col("doc_id").alias("_at"), F.col("key").alias("_of")) \
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    text = F.col("text")
    suspect = F.coalesce(text.rlike(PROPOSALS), F.lit(False))
    rows = carried(documents.filter(suspect), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key"), text.alias("_text"))
    joined = rows.join(lists, F.col("_id").eqNullSafe(F.col("_at")) & (F.col("_key") == F.col("_of")), "left")

    def marked(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]  # else it overlaps the one before
        between = F.substr(F.col("_text"), done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        return F.struct(F.greatest(done["at"], span["end"]).cast("int").alias("at"),
                        F.when(fresh, F.concat(done["out"], between, F.lit(mark))).otherwise(done["out"]).alias("out"))

    done = F.aggregate("_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), marked)
    clean = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(
        F.concat(done["out"], F.substr(F.col("_text"), done["at"] + 1, F.length("_text"))))
    changed = {"text": clean}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("_spans").isNull(), F.col("_row.n_chars")).otherwise(F.length(clean)).cast(kind)
    redacted = joined.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in documents.columns])
    return documents.filter(~suspect).unionByName(redacted)
