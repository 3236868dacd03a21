"""Queries over traits, identifiers, manifests and sample alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.functions import text as X
from lociframe.operators import filters, reshape, sumstats, traits
from lociframe.plans import domain as D
from lociframe.plans.registry import query, rounded, table
from lociframe.session import shared_path, stage
from lociframe.sources import sinks
from lociframe.sources import sumstats as files

_CELLS = " UNION ALL ".join(
    f"SELECT sample_id, '{t}' AS trait_id, sum(value) FILTER (trait_id = '{t}') AS value FROM trait_values GROUP BY sample_id"
    for t in D.TRAIT_IDS
)


@query(f"WITH {D.TRAITS_SQL} SELECT sample_id, trait_id, round(value, 4) + 0.0 AS value FROM ({_CELLS})")
def trait_unpivot(spark: SparkSession, d: str) -> DataFrame:
    long = reshape.unpivot_traits(D.trait_wide(spark, d))
    return long.select("sample_id", "trait_id", rounded("value", 4).alias("value"))


@query(
    f"""WITH {D.TRAITS_SQL}
SELECT sample_id, CAST({len(D.TRAIT_IDS)} AS INT) AS n_traits, count(value) AS n_values, round(sum(value), 4) + 0.0 AS total,
  round(sum(value) FILTER (trait_id = '{D.TRAIT_IDS[0]}'), 4) + 0.0 AS first_trait FROM trait_values GROUP BY sample_id"""
)
def trait_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Trait columns as one vector per sample."""
    vector, known = F.col("trait"), lambda v: v.isNotNull()
    return reshape.trait_matrix(D.trait_wide(spark, d)).select(
        "sample_id",
        F.size(vector).alias("n_traits"),
        F.size(F.filter(vector, known)).cast("long").alias("n_values"),
        rounded(F.aggregate(F.filter(vector, known), F.lit(0.0), lambda a, v: a + v), 4).alias("total"),
        rounded(vector[0], 4).alias("first_trait"),
    )


# Traits of the part table: many groups of uneven size.
_PART_TRAITS = "SELECT concat(replace(p_brand, 'Brand#', ''), '_', p_partkey) AS trait_id, p_name AS trait_name FROM {}"
_PART_SQL = f"""part_traits AS (SELECT trait_id, trait_name, CAST(split_part(trait_id, '_', 1) AS BIGINT) AS trait_group_id
  FROM ({_PART_TRAITS.format('part')}))"""


def _part_traits(spark: SparkSession, d: str) -> DataFrame:
    named = spark.sql(_PART_TRAITS.format("{part}"), part=table(spark, d, "part"))
    return named.withColumn("trait_group_id", X.id_group(F.col("trait_id")).cast("long"))


@query(
    f"""WITH {_PART_SQL}, {D.batches_sql("part_traits", "batched", 7)}
SELECT trait_id, trait_group_id, first_value(trait_name) OVER (PARTITION BY trait_group_id ORDER BY trait_id) AS group_name,
  CAST(batch_index AS INT) AS batch_index, CAST(row_number() OVER (PARTITION BY trait_group_id, batch_index ORDER BY trait_id) - 1 AS INT) AS trait_index,
  CAST(count(*) OVER (PARTITION BY trait_group_id, batch_index) AS INT) AS batch_size, CAST(k AS INT) AS n_batches,
  concat(lpad(CAST(batch_index AS VARCHAR), 3, '0'), '_', trait_group_id) AS batch_key FROM batched"""
)
def trait_batches(spark: SparkSession, d: str) -> DataFrame:
    return traits.batch_traits(_part_traits(spark, d), 7).drop("trait_name")


@query(f"WITH {_PART_SQL} SELECT trait_group_id, arg_min(trait_name, trait_id) AS trait_name, count(*) AS n_traits FROM part_traits GROUP BY trait_group_id")
def first_trait_name(spark: SparkSession, d: str) -> DataFrame:
    listed = _part_traits(spark, d)
    sizes = listed.groupBy("trait_group_id").agg(F.count(F.lit(1)).alias("n_traits"))
    return traits.first_trait_name(listed).join(sizes, "trait_group_id")


@query(
    f"""WITH {D.TRAITS_SQL}
SELECT batch_key, sample_id, round(max(CASE WHEN trait_index = 0 THEN value END), 4) + 0.0 AS y0, round(max(CASE WHEN trait_index = 1 THEN value END), 4) + 0.0 AS y1
FROM complete JOIN batches USING (batch_key) JOIN trait_values USING (trait_id, sample_id) GROUP BY batch_key, sample_id"""
)
def complete_cases(spark: SparkSession, d: str) -> DataFrame:
    cases = traits.complete_cases(D.trait_values(spark, d), D.trait_batches(spark, d))
    y = [rounded(c, 4).alias(f"y{i}") for i, c in enumerate(reshape.array_items(F.col("y"), 2))]
    return cases.select("batch_key", "sample_id", *y)


def _numbered_samples(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").selectExpr("c_custkey AS sample_id", "c_custkey AS sample_index")


@query(f"WITH {D.TRAITS_SQL} SELECT batch_key, sample_id, count(*) OVER (PARTITION BY batch_key) AS sample_size FROM complete JOIN customer ON c_custkey = sample_id")
def complete_case_bitmap(spark: SparkSession, d: str) -> DataFrame:
    """Complete cases of all batches and their number from one bitmap per (trait, sample block)."""
    presence = traits.presence_bitmaps(D.trait_values(spark, d), _numbered_samples(spark, d))
    complete = stage(traits.complete_case_bitmaps(presence, D.trait_batches(spark, d)), "complete")
    listed = traits.bitmap_samples(complete).withColumnRenamed("sample_index", "sample_id")
    return listed.join(traits.bitmap_sample_sizes(complete), "batch_key")


@query(f"WITH {D.TRAITS_SQL} SELECT batch_key, count(*) AS sample_size FROM complete GROUP BY batch_key HAVING count(*) >= 130")
def min_sample_gate(spark: SparkSession, d: str) -> DataFrame:
    return traits.gate_batches(traits.complete_cases(D.trait_values(spark, d), D.trait_batches(spark, d)), 130)


@query(
    f"""WITH {D.TRAITS_SQL}
SELECT c_custkey AS sample_id, c_mktsegment AS segment, round(sum(value) FILTER (trait_id = '50_0'), 4) + 0.0 AS first_trait,
  round(sum(value) FILTER (trait_id = '41210_4'), 4) + 0.0 AS last_trait
FROM customer LEFT JOIN trait_values ON sample_id = c_custkey GROUP BY ALL"""
)
def trait_left_join(spark: SparkSession, d: str) -> DataFrame:
    samples = table(spark, d, "customer").selectExpr("c_custkey AS sample_id", "c_mktsegment AS segment")
    wide = D.trait_wide(spark, d).withColumnRenamed("userId", "sample_id").withColumn("segment", F.lit("trait side"))
    joined = traits.add_traits(samples, wide)
    return joined.select(
        "sample_id", "segment", rounded("50_0", 4).alias("first_trait"), rounded("41210_4", 4).alias("last_trait")
    )


_STATUS = "SELECT o_custkey AS sample_id, concat('50_', o_orderstatus) AS trait_id, count(*) AS value FROM {} GROUP BY ALL"


@query(
    f"""WITH t AS ({_STATUS.format('orders')}), s AS (
  SELECT sample_id, row_number() OVER (ORDER BY sample_id) - 1 AS sample_index FROM (SELECT DISTINCT sample_id FROM t))
SELECT sample_id, sample_index, trait_id, CAST(value AS DOUBLE) AS value FROM t JOIN s USING (sample_id)"""
)
def sample_order_join(spark: SparkSession, d: str) -> DataFrame:
    """Trait rows in genotype sample order; samples without traits would fail the query."""
    orders = table(spark, d, "orders").selectExpr("o_custkey AS sample_id", "concat('50_', o_orderstatus) AS trait_id")
    values = orders.groupBy("sample_id", "trait_id").agg(F.count(F.lit(1)).cast("double").alias("value"))
    genotype = reshape.number_rows(orders.select("sample_id").distinct(), "sample_index", ["sample_id"])
    return traits.order_as_genotypes(values, genotype).select("sample_id", "sample_index", "trait_id", "value")


@query(
    """SELECT concat(p_partkey % 30, '_', p_brand) AS trait_id, p_partkey % 30 AS trait_group_id, n_name AS trait_name
FROM part LEFT JOIN nation ON n_nationkey = p_partkey % 30"""
)
def name_lookup(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "part").selectExpr("concat(p_partkey % 30, '_', p_brand) AS trait_id", "p_partkey % 30 AS trait_group_id")
    dictionary = table(spark, d, "nation").selectExpr("CAST(n_nationkey AS STRING) AS FieldID", "n_name AS Field")
    return traits.name_traits(listed, dictionary)


@query(
    f"""WITH {D.SAMPLE_QC_SQL}
SELECT o_custkey AS sample_id, o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT sample_id FROM kept_samples)"""
)
def sample_semi_join(spark: SparkSession, d: str) -> DataFrame:
    """Phenotype rows of samples that passed QC; the id list has duplicates."""
    rows = table(spark, d, "orders").selectExpr("o_custkey AS sample_id", "o_orderkey", "o_totalprice")
    kept = filters.sample_qc(D.sample_qc(spark, d)).select("sample_id")
    return rows.join(kept.unionByName(kept), "sample_id", "left_semi")


@query(
    """SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderstatus IN (SELECT l_linestatus FROM lineitem)"""
)
def trait_semi_join(spark: SparkSession, d: str) -> DataFrame:
    """Rows of traits that exist on the other side."""
    rows = table(spark, d, "orders").selectExpr("o_orderkey", "o_orderpriority", "o_orderstatus AS ot_trait_group_id")
    other = table(spark, d, "lineitem").selectExpr("l_linestatus AS gwas_trait_group_id")
    return sumstats.comparable(rows, other).select("o_orderkey", "o_orderpriority")


_WORK = "SELECT DISTINCT CAST(1 + p_partkey % 22 AS VARCHAR(9)) AS contig, CAST(p_size % 5 AS INT) AS batch_index, p_partkey % 40 AS trait_group_id FROM {}"
_DONE = "SELECT CAST(1 + l_partkey % 22 AS VARCHAR(9)) AS contig, CAST(l_linenumber % 5 AS INT) AS batch_index, l_suppkey % 40 AS trait_group_id FROM {}"


@query(
    f"""SELECT contig, batch_index, trait_group_id, concat(lpad(CAST(batch_index AS VARCHAR), 3, '0'), '_', trait_group_id) AS batch_key
FROM ({_WORK.format('part')} EXCEPT {_DONE.format('lineitem')})"""
)
def pending_work_anti(spark: SparkSession, d: str) -> DataFrame:
    work = spark.sql(_WORK.format("{part}"), part=table(spark, d, "part"))
    done = spark.sql(_DONE.format("{lineitem}"), lineitem=table(spark, d, "lineitem"))
    pending = traits.pending_work(work, done)
    return pending.withColumn("batch_key", X.batch_key(F.col("batch_index"), F.col("trait_group_id")))


_WANTED = "SELECT DISTINCT p_partkey % 60 AS trait_group_id FROM {}"


@query(f"SELECT trait_group_id FROM ({_WANTED.format('part')}) WHERE trait_group_id NOT IN (SELECT CAST(n_nationkey AS BIGINT) FROM nation)")
def missing_groups(spark: SparkSession, d: str) -> DataFrame:
    wanted = spark.sql(_WANTED.format("{part}"), part=table(spark, d, "part"))
    return traits.missing_groups(wanted, table(spark, d, "nation").selectExpr("CAST(n_nationkey AS BIGINT) AS trait_group_id"))


@query("SELECT CAST(p_size AS BIGINT) AS trait_group_id FROM part INTERSECT SELECT CAST(l_quantity AS BIGINT) FROM lineitem")
def trait_group_intersect(spark: SparkSession, d: str) -> DataFrame:
    ours = table(spark, d, "part").selectExpr("CAST(p_size AS BIGINT) AS trait_group_id")
    published = table(spark, d, "lineitem").selectExpr("CAST(l_quantity AS BIGINT) AS trait_group_id")
    return traits.common_groups(ours, published).orderBy("trait_group_id")


@query(
    f"""WITH {D.TRAITS_SQL}
SELECT 'all' AS form, trait_group_id, count(*) AS n_traits FROM traits GROUP BY trait_group_id
UNION ALL SELECT 'list', trait_group_id, count(*) FROM traits WHERE trait_group_id IN (1990, 20095) GROUP BY trait_group_id
UNION ALL SELECT 'text', trait_group_id, count(*) FROM traits WHERE trait_group_id IN (50, 23098) GROUP BY trait_group_id"""
)
def trait_param_forms(spark: SparkSession, d: str) -> DataFrame:
    """Trait groups given as nothing (all), as a sequence, or as comma text."""
    listed = D.traits(spark, d)

    def count(form: str, df: DataFrame) -> DataFrame:
        return df.groupBy("trait_group_id").agg(F.count(F.lit(1)).alias("n_traits")).select(F.lit(form).alias("form"), "*")

    every = filters.trait_group_members(spark, listed)
    some = filters.trait_group_members(spark, listed, [1990, "20095"])
    return (
        count("all", filters.member_filter(listed, "trait_group_id", every))
        .unionByName(count("list", filters.member_filter(listed, "trait_group_id", some)))
        .unionByName(count("text", filters.member_filter(listed, "trait_group_id", "50,23098")))
    )


@query("SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE CAST(1 + l_partkey % 22 AS VARCHAR) IN ('21', '22', '7')")
def member_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").selectExpr("l_orderkey", "l_partkey", "l_returnflag", "1 + l_partkey % 22 AS contig")
    return filters.member_filter(rows, "contig", "21,22,7").drop("contig")


_FIELD_TEXT = "CASE WHEN p_size % 4 = 0 THEN concat('userId', p_partkey) ELSE concat(p_size, '_', p_brand) END"


@query(
    f"""SELECT DISTINCT TRY_CAST(split_part({_FIELD_TEXT}, '_', 1) AS INT) AS field_id FROM part
WHERE TRY_CAST(split_part({_FIELD_TEXT}, '_', 1) AS INT) IS NOT NULL"""
)
def field_ids(spark: SparkSession, d: str) -> DataFrame:
    return traits.field_ids(table(spark, d, "part").selectExpr(f"{_FIELD_TEXT} AS trait_id"))


@query("SELECT DISTINCT o_custkey AS sample_id FROM orders")
def distinct_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_custkey").alias("sample_id")).distinct()


@query("SELECT DISTINCT l_partkey AS trait_group_id FROM lineitem ORDER BY l_partkey LIMIT 10")
def preview_limit(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("trait_group_id")).distinct().orderBy("trait_group_id").limit(10)


_RAW_TRAIT = "CASE WHEN p_size % 3 = 0 THEN CAST(p_partkey AS VARCHAR(20)) ELSE concat(p_partkey, '_', p_type, '_', p_size) END"


@query(
    f"""SELECT t AS trait_id, split_part(t, '_', 1) AS trait_group_id,
  CASE WHEN contains(t, '_') THEN substr(t, strpos(t, '_') + 1) ELSE '' END AS trait_code_id FROM (SELECT {_RAW_TRAIT} AS t FROM part)"""
)
def id_split(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("trait_id")
    return table(spark, d, "part").selectExpr(f"{_RAW_TRAIT} AS trait_id").select(
        "trait_id", X.id_group(t).alias("trait_group_id"), X.id_code(t).alias("trait_code_id")
    )


@query(f"WITH {D.VARIANTS_SQL} SELECT variant_index, replace(variant_id, '_', ':') AS variant_id FROM variants")
def variant_id_normalise(spark: SparkSession, d: str) -> DataFrame:
    """Variant ids stored as bytes to colon text."""
    stored = D.variants(spark, d).select("variant_index", F.col("variant_id").cast("binary").alias("variant_id"))
    return stored.select("variant_index", X.colon_variant_id(X.as_text(F.col("variant_id"))).alias("variant_id"))


# Manifests: file names made from the tables, with junk among them.
_OWN_NAME = """CASE WHEN l_linenumber = 1 THEN concat('notes/chr', l_partkey, '.txt')
  ELSE concat('sumstats/ukb_chr', CASE WHEN l_partkey % 24 = 0 THEN 'XY' ELSE CAST(l_partkey % 24 AS VARCHAR(9)) END, '_',
    lpad(CAST(l_linenumber AS VARCHAR(9)), 3, '0'), '_', l_suppkey, CASE WHEN l_tax > 0.04 THEN concat('_', l_returnflag, '_', l_linestatus) ELSE '' END, '.parquet') END"""


@query(
    f"""WITH files AS (SELECT DISTINCT {_OWN_NAME} AS file FROM lineitem),
parts AS (SELECT file, regexp_extract(file, 'ukb_chr(\\d+)_(\\d+)_(.*).parquet', ['contig', 'batch', 'trait_id']) AS m FROM files
  WHERE regexp_matches(file, 'ukb_chr(\\d+)_(\\d+)_(.*).parquet'))
SELECT m.contig AS contig, CAST(m.batch AS INT) AS batch, m.trait_id AS trait_id, split_part(m.trait_id, '_', 1) AS trait_group_id,
  CASE WHEN contains(m.trait_id, '_') THEN substr(m.trait_id, strpos(m.trait_id, '_') + 1) ELSE '' END AS trait_code_id, file FROM parts"""
)
def manifest_parse_own(spark: SparkSession, d: str) -> DataFrame:
    return files.own_manifest(table(spark, d, "lineitem").selectExpr(f"{_OWN_NAME} AS file").distinct())


def _published_name(group: str) -> str:
    return f"""concat('published/', {group}, CASE WHEN p_size % 3 = 0 THEN concat('_', p_type) ELSE '' END,
  CASE p_partkey % 4 WHEN 0 THEN '_irnt' WHEN 1 THEN '_raw' ELSE '' END, '.imputed.both_sexes', CASE WHEN p_size % 9 = 0 THEN '.log' ELSE '.tsv.gz' END)"""


_PUBLISHED_FILES = f"SELECT DISTINCT {_published_name('p_partkey')} AS file FROM part"


def _published_files(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").selectExpr(f"{_published_name('p_partkey')} AS file").distinct()


@query(
    f"""WITH files AS ({_PUBLISHED_FILES}), named AS (
  SELECT file, split_part(split_part(file, '/', -1), '.', 1) AS t FROM files WHERE ends_with(file, '.tsv.gz')),
stripped AS (SELECT file, CASE WHEN ends_with(t, '_raw') THEN replace(t, '_raw', '') ELSE t END AS t FROM named WHERE NOT ends_with(t, '_irnt'))
SELECT t AS trait_id, split_part(t, '_', 1) AS trait_group_id, CASE WHEN contains(t, '_') THEN substr(t, strpos(t, '_') + 1) ELSE '' END AS trait_code_id, file
FROM stripped"""
)
def manifest_parse_published(spark: SparkSession, d: str) -> DataFrame:
    return files.published_manifest(_published_files(spark, d))


@query(
    f"""WITH files AS ({_PUBLISHED_FILES})
SELECT DISTINCT CAST(split_part(split_part(split_part(file, '/', -1), '.', 1), '_', 1) AS BIGINT) AS trait_group_id
FROM files WHERE ends_with(file, '.tsv.gz')"""
)
def published_groups(spark: SparkSession, d: str) -> DataFrame:
    return files.published_trait_groups(_published_files(spark, d))



@query(
    f"""WITH {D.TRAITS_SQL}, wanted AS (SELECT DISTINCT CAST(o_custkey % 30000 AS BIGINT) AS trait_group_id FROM orders UNION SELECT 20095 UNION SELECT 50)
SELECT trait_id, trait_group_id FROM traits WHERE trait_group_id IN (SELECT trait_group_id FROM wanted)"""
)
def trait_groups_file(spark: SparkSession, d: str) -> DataFrame:
    """Traits of the groups that a TSV lists; most listed groups have no trait."""
    path = shared_path(spark, "trait-groups")
    wanted = table(spark, d, "orders").selectExpr("CAST(o_custkey % 30000 AS BIGINT) AS trait_group_id")
    wanted = wanted.unionByName(spark.range(1).selectExpr("explode(array(20095L, 50L)) AS trait_group_id")).distinct()
    sinks.write_tsv(wanted, path)
    listed = D.traits(spark, d)
    members = filters.trait_group_members(spark, listed, path)
    return listed.join(members, "trait_group_id", "left_semi").select("trait_id", "trait_group_id")
