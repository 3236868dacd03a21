"""The registered query of each operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm import (
    chat_format,
    embedding_dedup,
    exact_dedup,
    hard_negatives,
    jaccard_join,
    license_scan,
    lm_scoring,
    mixing,
    quality_fm,
    sentencepiece_codec,
    suffix_dedup,
    token_files,
    whitening,
)
from lociframe.llm.common import LOWER, UPPER
from lociframe.plans.registry import Query, rounded
from lociframe.session import shared_path

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


WORDS_SQL = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
LOWER_SQL = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"


@query()
def op1_entropy_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


@query(rf"""
WITH words AS (
  SELECT doc_id, {WORDS_SQL.format(text="coalesce(text, '')")} AS w FROM documents
), windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s + 1:s + 50], ' ')) AS h FROM words, unnest(range(0, greatest(len(w) - 49, 0))) AS r(s)
), repeats AS (
  SELECT DISTINCT doc_id, s FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
), opened AS (
  SELECT doc_id, s, CASE WHEN s - lag(s) OVER d > 50 THEN 1 ELSE 0 END AS o FROM repeats WINDOW d AS (PARTITION BY doc_id ORDER BY s)
), runs AS (SELECT doc_id, s, sum(o) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM opened)
SELECT doc_id, min(s)::BIGINT AS start_word, (max(s) - min(s) + 50)::BIGINT AS n_words FROM runs GROUP BY doc_id, run
""")
def op2_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query(f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {WORDS_SQL.format(text=LOWER_SQL)} AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words
), parts AS (SELECT doc_id, unnest(s) AS g FROM sets),
repeated AS (SELECT g FROM parts GROUP BY g HAVING count(*) > 1),
kept AS MATERIALIZED (SELECT doc_id, g FROM parts SEMI JOIN repeated USING (g)),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM kept a JOIN kept b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * c >= 80 * (len(x.s) + len(y.s) - c)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents UNION
  SELECT r.doc_id, e.b FROM reached r JOIN both_ways e ON r.other = e.a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) USING (doc_id)
""")
def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query(f"""
WITH words AS (
  SELECT doc_id, {WORDS_SQL.format(text=LOWER_SQL)} AS w FROM documents
), grams AS MATERIALIZED (
  SELECT doc_id, i, w[i] AS g1, CASE WHEN i > 1 THEN w[i - 1] END AS p1, CASE WHEN i > 2 THEN w[i - 2] END AS p2
  FROM words, unnest(range(1, len(w) + 1)) AS r(i)
), n1 AS (SELECT g1, count(*) AS c FROM grams GROUP BY 1),
n2 AS (SELECT p1, g1, count(*) AS c FROM grams WHERE p1 IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1),
n3 AS (SELECT p2, p1, g1, count(*) AS c FROM grams WHERE p2 IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) > 1),
scored AS (
  SELECT doc_id, CASE
    WHEN t.c IS NOT NULL THEN ln(t.c::DOUBLE) - ln(u.c::DOUBLE)
    WHEN b.c IS NOT NULL THEN ln(b.c::DOUBLE) - ln(x.c::DOUBLE) + CASE WHEN g.i > 2 THEN ln(0.4::DOUBLE) ELSE 0 END
    ELSE ln(a.c::DOUBLE) - ln((SELECT count(*) FROM grams)::DOUBLE) + least(g.i - 1, 2) * ln(0.4::DOUBLE) END AS s
  FROM grams g JOIN n1 a USING (g1) LEFT JOIN n1 x ON x.g1 = g.p1 LEFT JOIN n2 b ON b.p1 = g.p1 AND b.g1 = g.g1
  LEFT JOIN n2 u ON u.p1 = g.p2 AND u.g1 = g.p1 LEFT JOIN n3 t ON t.p2 = g.p2 AND t.p1 = g.p1 AND t.g1 = g.g1
), sums AS (SELECT doc_id, sum(s) AS s FROM scored GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(s, 0.0), 5) + 0.0 AS log_score FROM words LEFT JOIN sums USING (doc_id)
""")
def op4_stupid_backoff(spark: SparkSession, folder: str) -> DataFrame:
    scored = lm_scoring.stupid_backoff(table(spark, folder, "documents"))
    return scored.select(F.col("id").alias("doc_id"), "n_words", rounded("log_score", 5).alias("log_score"))


@query("""
WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM hashed WINDOW g AS (PARTITION BY text_sha256)
""")
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = exact_dedup.groups(exact_dedup.survivors(docs))
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest")
    rows = docs.select("doc_id", digest).join(found, "digest", "left")
    keep = F.coalesce("keep_id", "doc_id")
    size = F.coalesce("group_size", F.lit(1)).cast("long")
    return rows.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


@query()
def op6_chat_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    repaired = chat_format.repair(table(spark, folder, "conversations"))
    return chat_format.render(repaired).withColumnRenamed("conv", "conv_id")


@query()
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query()
def op8_sentencepiece_dropout(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_codec.encode(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query("""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND list_bool_and([isfinite(x) FOR x IN embedding]) AND list_bool_or([x <> 0 FOR x IN embedding])
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings UNION
  SELECT r.vec_id, e.b FROM reached r JOIN both_ways e ON r.other = e.a
), roots AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM both_ways GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN degrees USING (vec_id)
""")
def op9_embedding_forest(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


@query()
def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_fm.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.withColumnRenamed("id", "doc_id")


@query("""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * c::DOUBLE) FOR c IN embedding] AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
    AND list_bool_and([isfinite(c) FOR c IN embedding])
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score QUALIFY rank <= 3
""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings").withColumn("label", label), F.col("vec_id") % 50 == 0)


@query()
def op12_lanczos_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


@query()
def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = shared_path(spark, "token-files")
    token_files.write(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read(spark, path, tokens=False).withColumnRenamed("id", "doc_id")
