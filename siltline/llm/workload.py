"""The queries ``op1_`` to ``op13_``, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import staged
from ..workloads import Workload
from . import bitplanes, decontaminate, knn, licenses, lm, mixing, passages, pii, prefix_trie, quality, secrets, simhash, toxicity

work = Workload()


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def weights_in_turn(sources: DataFrame, turn: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Weights repeating over the sources by code point, NULL last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in turn])
    return sources.withColumn("weight", F.get(cycle, place % len(turn)))


@work.add("op1_mix_sources", r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS draw
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM d GROUP BY source
), r AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap,
         row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST) AS place FROM s
), f AS (
  SELECT a.source, a.source_size, a.w, a.cap, a.place,
         (SELECT sum(source_size) FROM r)::DOUBLE
           - coalesce(sum(b.cap) FILTER (b.place < a.place), 0) AS remaining,
         sum(b.w) FILTER (b.place >= a.place) AS weights
  FROM r a CROSS JOIN r b GROUP BY ALL
), g AS (
  SELECT min(place) AS first FROM f WHERE NOT cap * weights <= remaining * w
), t AS (
  SELECT f.source, f.source_size,
         CASE WHEN f.cap * f.weights <= f.remaining * f.w THEN f.cap
              ELSE least((SELECT f2.remaining FROM f f2, g WHERE f2.place = g.first) * f.w
                   / (SELECT f2.weights FROM f f2, g WHERE f2.place = g.first), f.cap) END AS target
  FROM f
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.source,
         coalesce(floor(t.target / nullif(t.source_size, 0)), 0)::BIGINT AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size / 2.0 AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), q AS (
  SELECT *, whole + CASE WHEN middle <= target - whole * source_size THEN 1 ELSE 0 END AS repeats FROM p
)
SELECT doc_id, size, source_size, target, (size * repeats)::BIGINT AS taken, source,
       repeats::BIGINT AS repeats
FROM q
""")
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, weights 5, 2, 1 in turn, at most three epochs of a source."""
    return mixing.mix(_read(spark, folder, "documents"), weights_in_turn, max_epochs=3.0)


@work.add("op8_simhash_near_duplicates")
def op8_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Three-word shingles, at most two differing bits."""
    return simhash.near_duplicates(_read(spark, folder, "documents"), 3, 2) \
        .select("doc_id", "fingerprint", "component_id")


@work.add("op6_benchmark_leaks")
def op6_benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """All documents against all items, windows of 8 template tokens."""
    return decontaminate.leaks(_read(spark, folder, "documents"), _read(spark, folder, "benchmark")).drop("key")


@work.add("op10_secret_scan")
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets in all documents; the strings themselves are not shown."""
    return secrets.secrets(_read(spark, folder, "documents")).drop("value", "key")


@work.add("op4_toxicity")
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents, learnt from 8,000 labels at most."""
    return toxicity.toxicity(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


@work.add("op5_license_scan")
def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All templates against all documents."""
    return licenses.licenses(_read(spark, folder, "documents")).drop("key")


@work.add("op9_personal_data")
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and places of personal data in all documents."""
    def told(spans):
        return F.array_join(F.transform(spans, lambda m: F.concat_ws(
            ":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("found", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = pii.personal_data(_read(spark, folder, "documents"))
    return found.select(
        "doc_id", *[count(kind.name) for kind in pii.KINDS if kind.base],
        F.sha2(told(F.filter("found", lambda m: m["base"])), 256).alias("base_sha256"), told(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda m: m["score"].cast("string")), ",").alias("scores"))


@work.add("op3_quality")
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents, learnt from about 100,000 labels at most."""
    return quality.quality(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


@work.add("op7_language_model")
def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, learnt from four of five folds."""
    return lm.scores(_read(spark, folder, "documents"))


@work.add("op2_top_neighbours", r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, rank::BIGINT AS rank, vec_id, score FROM r WHERE rank <= 20
""")
def op2_top_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every twentieth vector among all."""
    vectors = _read(spark, folder, "embeddings").select("vec_id", knn.integral(F.col("embedding")).alias("vector"))
    return knn.top_k(vectors, F.col("vec_id") % 20 == 0, 20)


@work.add("op12_repeated_passages", r"""
WITH w AS (
  SELECT doc_id, unnest(list) AS word, generate_subscripts(list, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS list FROM documents)
), v AS (
  SELECT doc_id, i, word, CASE WHEN count(*) OVER ahead = 20 THEN string_agg(word, ' ') OVER ahead END AS span
  FROM w WINDOW ahead AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), l AS (
  SELECT doc_id, i, word, span IS NOT NULL AND row_number() OVER (PARTITION BY span ORDER BY doc_id, i) > 1 AS later FROM v
), g AS (
  SELECT doc_id, i, word, bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM l
), k AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
  FROM g GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN k USING (doc_id)
""")
def op12_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of 20 words; the text without those that start earlier elsewhere, as a digest."""
    return passages.without_repeats(_read(spark, folder, "documents"), 20) \
        .select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _rounds(n: int) -> str:
    """SQL of ``n`` rounds: a<i> are the assignments by the centroids c<i>."""
    steps = []
    for i in range(n + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT vec_id, arg_min(c, (distance, c)) AS c, min(distance) AS distance
  FROM (SELECT vec_id, c, sum((x - m) * (x - m))::BIGINT AS distance FROM x JOIN c{i} USING (i) GROUP BY ALL) GROUP BY vec_id
)""")
        if i < n:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, m)::BIGINT AS m
  FROM c{i} LEFT JOIN (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{i} JOIN x USING (vec_id) GROUP BY ALL) USING (c, i)
)""")
    return ", ".join(steps)


@work.add("op13_centroid_clusters", f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept
), c0 AS MATERIALIZED (
  SELECT c, unnest(v) AS m, generate_subscripts(v, 1) AS i
  FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v FROM kept) WHERE c < 8
), {_rounds(10)}, named AS (
  SELECT c, sha256(string_agg(m::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c10 GROUP BY c
)
SELECT vec_id, c::BIGINT AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a10 JOIN named USING (c)
""")
def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Eight centroids, ten rounds, components times 1024."""
    vectors = _read(spark, folder, "embeddings").select("vec_id", bitplanes.integers(F.col("embedding")).alias("vector"))
    return bitplanes.clusters(vectors, k=8, rounds=10, seed=3)


@work.add("op11_conversation_trie", """
WITH t AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own,
         xor(list_reduce(flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
                         lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384), 4294967295::BIGINT), 4294967295) % 4 AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), r AS (
  SELECT t.conv_id, list_concat(coalesce(b.own, [])[1:t.h], t.own[t.h + 1:]) AS seq
  FROM t LEFT JOIN t b ON b.conv_id = t.conv_id - t.conv_id % 20
), p AS (
  SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM r
), n AS (
  SELECT seq[1:d] AS node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = d), '')) AS ends_sha256
  FROM p GROUP BY node, d
), c AS (
  SELECT node[1:d - 1] AS parent, count(*) AS n_children FROM n WHERE d > 0 GROUP BY parent
), o AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children,
         CASE WHEN d > 0 THEN (n_convs - 1) * len(regexp_extract_all(node[d].t, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS saved
  FROM n LEFT JOIN c ON n.node = c.parent
), u AS (
  SELECT node, saved, n_children, unnest(range(d + 1)) AS upto FROM o
), s AS (
  SELECT node[1:upto] AS top, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM u GROUP BY top
)
SELECT o.conv_id, o.d AS depth, q.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM o JOIN s ON o.node = s.top LEFT JOIN n q ON o.d > 0 AND o.node[1:o.d - 1] = q.node
""")
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all conversations, each begun like the one of its twenty."""
    own = staged(prefix_trie.sequences(_read(spark, folder, "conversations")), "sequences")
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(own, every=20, heads=4))
