"""Queries over readers, writers and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe import schema
from lociframe.functions import text as X
from lociframe.operators import filters, reshape
from lociframe.plans import domain as D
from lociframe.plans.registry import query, rounded, table
from lociframe.session import shared_path
from lociframe.sources import genotypes, participants, sinks
from lociframe.streaming import incremental

_RENAMED = ", ".join(
    f"{k} AS sample_{ {'eid': 'id', 'sex': 'qc_sex'}.get(v, v) }" for k, v in schema.SAMPLE_QC_FIELDS.items()
)


@query(f"WITH {D.PARTICIPANTS_SQL} SELECT {_RENAMED} FROM participants")
def sample_qc_rename(spark: SparkSession, d: str) -> DataFrame:
    return reshape.prefix_sample_qc(reshape.extract_sample_qc(D.participants(spark, d)))


_PC_SUM = " + ".join(f"coalesce(CAST(x22009_0_{i} AS BIGINT), 0)" for i in range(1, 41))


@query(
    f"""WITH {D.PARTICIPANTS_SQL}
SELECT CAST(eid AS BIGINT) AS sample_id, CAST(40 AS INT) AS n_components, CAST(x22009_0_1 AS DOUBLE) AS first_component,
  CAST(x22009_0_40 AS DOUBLE) AS last_component, CAST({_PC_SUM} AS BIGINT) AS total FROM participants"""
)
def pc_pack(spark: SparkSession, d: str) -> DataFrame:
    packed = D.sample_qc(spark, d)
    pc = F.col("sample_principal_component")
    return packed.select(
        "sample_id",
        F.size(pc).alias("n_components"),
        F.get(pc, F.lit(0)).alias("first_component"),
        F.get(pc, F.lit(39)).alias("last_component"),
        F.aggregate(pc, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0))).cast("long").alias("total"),
    )


@query(
    f"""WITH {D.VARIANTS_SQL}
SELECT variant_id, rsid, position, CAST(2 AS INT) AS n_alleles, allele1_ref AS allele_1, allele2_alt AS allele_2 FROM variants"""
)
def allele_pack(spark: SparkSession, d: str) -> DataFrame:
    packed = reshape.pack_alleles(D.variants(spark, d))
    return packed.select(
        "variant_id",
        "rsid",
        "position",
        F.size("allele").alias("n_alleles"),
        F.element_at("allele", 1).alias("allele_1"),
        F.element_at("allele", 2).alias("allele_2"),
    )


_WIDE = ["x22000_0_0", "x22007_0_0", "x22008_0_0", "x22006_0_0", "x22019_0_0", "x21022_0_0", "x22009_0_1", "x22009_0_40"]


@query(f"WITH {D.PARTICIPANTS_SQL} SELECT eid, {', '.join(_WIDE)} FROM participants")
def csv_wide_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Write the wide participant CSV with its original header names, read it with the header-derived schema."""
    wide = D.participants(spark, d)
    csv, parquet = shared_path(spark, "participants-csv"), shared_path(spark, "participants")
    wide.toDF(*["eid"] + [X.participant_header(c) for c in wide.columns[1:]]).write.csv(csv, header=True)
    sinks.write_table(participants.read_participants(spark, csv), parquet)
    return spark.read.parquet(parquet).select("eid", *_WIDE)


_PIVOT = ", ".join(f"round(sum(value) FILTER (trait_id = '{t}'), 4) + 0.0 AS t{t}" for t in D.TRAIT_IDS)


@query(f"WITH {D.TRAITS_SQL} SELECT sample_id, {_PIVOT} FROM trait_values GROUP BY sample_id")
def csv_infer_read(spark: SparkSession, d: str) -> DataFrame:
    """Write the phenotype TSV, read it with inferred types."""
    path = shared_path(spark, "phenotypes-tsv")
    sinks.write_tsv(D.trait_wide(spark, d), path)
    wide = participants.read_typed_table(spark, path)
    return wide.select(
        F.col("userId").cast("long").alias("sample_id"), *[rounded(F.col(t).cast("double"), 4).alias(f"t{t}") for t in D.TRAIT_IDS]
    )


@query(
    f"""WITH {D.VARIANTS_SQL}
SELECT variant_id, rsid AS variant_rsid, position AS variant_position, round(maf, 4) + 0.0 AS variant_maf,
  minor_allele AS variant_minor_allele, round(info, 4) + 0.0 AS variant_info, concat(allele1_ref, '/', allele2_alt) AS alleles FROM variants"""
)
def mfi_read(spark: SparkSession, d: str) -> DataFrame:
    """Write the headerless variant file, read it with its declared columns."""
    path = shared_path(spark, "variant-info")
    cols = [f.name for f in schema.VARIANT_INFO]
    D.variants(spark, d).withColumnRenamed("variant_id", "id").select(*cols).write.csv(path, sep="\t", header=False)
    info = genotypes.read_variant_info(spark, path)
    return info.select(
        "variant_id",
        "variant_rsid",
        "variant_position",
        rounded(F.col("variant_maf").cast("double"), 4).alias("variant_maf"),
        "variant_minor_allele",
        rounded(F.col("variant_info").cast("double"), 4).alias("variant_info"),
        F.concat_ws("/", "variant_allele").alias("alleles"),
    )


@query("SELECT CAST(c_custkey AS INT) AS sample_id, CAST(c_nationkey % 2 AS SMALLINT) AS sample_sex FROM customer")
def sample_file_read(spark: SparkSession, d: str) -> DataFrame:
    """Write the sample file with its type row, read it back without."""
    path = shared_path(spark, "samples")
    rows = table(spark, d, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS ID_1", "CAST(c_custkey AS STRING) AS ID_2", "'0' AS missing", "CAST(c_nationkey % 2 AS STRING) AS sex"
    )
    types = spark.createDataFrame([("0", "0", "0", "D")], rows.schema)
    types.unionByName(rows).write.csv(path, sep=" ", header=True)
    return genotypes.read_sample_file(spark, path)


_LABEL = "CASE WHEN p_size % 10 = 0 THEN '' WHEN p_size % 10 = 1 THEN 'NA' ELSE p_name END"


@query(f"SELECT p_partkey AS userId, {_LABEL} AS label, p_brand AS brand, length({_LABEL}) AS n_chars FROM part")
def string_tsv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Text fields keep empty and NA apart through a TSV."""
    path = shared_path(spark, "text-tsv")
    sinks.write_tsv(table(spark, d, "part").selectExpr("p_partkey AS userId", f"{_LABEL} AS label", "p_brand AS brand"), path)
    df = participants.read_text_table(spark, path, int_columns=("userId",))
    return df.select("userId", "label", "brand", F.length("label").cast("long").alias("n_chars"))


@query("SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def json_repartition(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines to Parquet in a given number of files."""
    json, parquet = shared_path(spark, "json"), shared_path(spark, "parquet")
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    part.write.json(json)
    sinks.write_repartitioned(participants.read_json(spark, json, part.schema), parquet, 4)
    return spark.read.parquet(parquet)


@query(
    f"""WITH {D.SPARSE_SQL}
SELECT CAST(1 + variant_index % 22 AS INT) AS contig, variant_index, sample_index, g AS dosage FROM sparse"""
)
def parquet_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """Calls written by contig and read back."""
    path = shared_path(spark, "calls")
    sinks.write_calls(D.sparse_dosages(spark, d), path)
    return genotypes.read_calls(spark, path).select(F.col("contig").cast("int"), "variant_index", "sample_index", "dosage")


@query(
    """SELECT l_partkey AS variant_index, CAST(4 * l_linenumber + slot AS BIGINT) AS sample_index, count(*) AS n_calls,
  CAST(sum(CASE code WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 0 THEN 0 END) AS BIGINT) AS n_copies,
  count(*) FILTER (code = 1) AS n_missing
FROM (SELECT l_partkey, l_linenumber, slot, (CAST(l_quantity AS INT) >> CAST(2 * slot AS INT)) & 3 AS code
  FROM lineitem, (SELECT range AS slot FROM range(4))) GROUP BY ALL"""
)
def packed_call_expand(spark: SparkSession, d: str) -> DataFrame:
    """Bytes of packed two-bit calls, counted per variant and sample."""
    packed = table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("variant_index"), F.col("l_linenumber").alias("byte_index"), F.col("l_quantity").cast("int").alias("byte")
    )
    calls = genotypes.expand_packed_calls(packed, "byte")
    return calls.groupBy("variant_index", "sample_index").agg(
        F.count(F.lit(1)).alias("n_calls"), F.sum("call").cast("long").alias("n_copies"), F.count_if(F.col("call").isNull()).alias("n_missing")
    )


_CONTIGS = ", ".join(f"('{i}', '{c}', '{n}', {s}, {v})" for i, c, n, s, v in schema.contig_rows())
CONTIGS_SQL = f"contigs AS (SELECT * FROM (VALUES {_CONTIGS}) AS t(idx, code, name, n_consent_samples, n_variants))"


@query(
    f"""WITH {D.VARIANTS_SQL}, {CONTIGS_SQL}
SELECT v.variant_index, v.contig AS contig_name, CAST(idx AS INT) AS contig_index, CAST(n_consent_samples AS BIGINT) AS n_consent_samples
FROM variants v JOIN contigs ON name = contig"""
)
def contig_dim_join(spark: SparkSession, d: str) -> DataFrame:
    """Contig index and expected sample count by contig name; the dimension has 24 rows."""
    dim = genotypes.contigs(spark).select(
        F.col("name").alias("contig_name"), F.col("index").cast("int").alias("contig_index"), F.col("n_consent_samples").cast("long")
    )
    found = D.variants(spark, d).select("variant_index", F.col("contig").alias("contig_name"))
    return found.join(F.broadcast(dim), "contig_name")


_NAMES = ", ".join(f"'{n}'" for n in schema.contig_names())


@query(
    f"""SELECT p_partkey AS variant_index, list_extract([{_NAMES}], CAST(p_size % 26 + 1 AS INT)) AS contig_name, CAST(24 AS INT) AS contig
FROM part"""
)
def contig_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """The file's own contig stays as a name, the contig index becomes the one of the file."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("variant_index"), (F.col("p_size") % 26).alias("contig"))
    return reshape.contig_columns(part, schema.contig_names(), 24).select("variant_index", "contig_name", "contig")


@query(
    f"""WITH {D.VARIANTS_SQL}, {D.DENSE_GP_SQL}
SELECT variant_id, sample_index AS sample_id, CAST(c_nationkey % 2 AS INT) AS sex, round(p1, 6) + 0.0 AS het, round(p2, 6) + 0.0 AS hom_alt
FROM gp JOIN variants USING (variant_index) JOIN customer ON c_custkey = sample_index"""
)
def positional_merge(spark: SparkSession, d: str) -> DataFrame:
    """Probabilities with variant info and samples, by stored positions."""
    samples = table(spark, d, "customer").selectExpr("c_custkey AS sample_index", "c_custkey AS sample_id", "CAST(c_nationkey % 2 AS INT) AS sex")
    info = D.variants(spark, d).select("variant_index", "variant_id")
    merged = reshape.merge_positions(D.dense_probabilities(spark, d), info, samples)
    return merged.select(
        "variant_id", "sample_id", "sex", rounded(F.col("gp")[1]).alias("het"), rounded(F.col("gp")[2]).alias("hom_alt")
    )


@query(
    f"""WITH {D.VARIANTS_SQL}
SELECT contig, variant_id, row_number() OVER (PARTITION BY contig ORDER BY position) - 1 AS contig_position FROM variants"""
)
def ordinal_position(spark: SparkSession, d: str) -> DataFrame:
    """0-based variant position within its contig."""
    placed = reshape.number_rows(D.variants(spark, d), "contig_position", ["position"], ["contig"])
    return placed.select("contig", "variant_id", "contig_position")


@query(
    """SELECT vec_id AS sample_index, CAST(v AS INT) AS variant_index, CAST(embedding[v + 1] AS DOUBLE) AS dosage
FROM embeddings, (SELECT range AS v FROM range(64))"""
)
def result_explode(spark: SparkSession, d: str) -> DataFrame:
    """Vectors to rows with 0-based positions."""
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("sample_index"), F.col("embedding").cast("array<double>"))
    return reshape.explode_vector(vectors, "embedding", "variant_index", "dosage")


@query(
    f"""WITH {D.DENSE_GP_SQL}, codes AS (
  SELECT variant_index, sample_index, CAST(1 + round_even(p1 * 254, 0) AS SMALLINT) AS gp_het, CAST(1 + round_even(p2 * 254, 0) AS SMALLINT) AS gp_hom_alt FROM gp)
SELECT variant_index, sample_index, gp_het, gp_hom_alt FROM codes"""
)
def gp_quantise(spark: SparkSession, d: str) -> DataFrame:
    """Probabilities as one-byte codes without the hom-ref one."""
    return genotypes.pack_calls(D.dense_probabilities(spark, d))


@query(
    f"""WITH {D.DENSE_GP_SQL}, codes AS (
  SELECT variant_index, sample_index, round_even(p1 * 254, 0) / 254 AS q1, round_even(p2 * 254, 0) / 254 AS q2 FROM gp)
SELECT variant_index, sample_index, round(1 - q1 - q2, 4) + 0.0 AS hom_ref, round(q1, 4) + 0.0 AS het, round(q2, 4) + 0.0 AS hom_alt,
  round(q1 + 2 * q2, 4) + 0.0 AS dosage FROM codes"""
)
def gp_unpack_dosage(spark: SparkSession, d: str) -> DataFrame:
    """Stored codes written, read back as probabilities and dosage."""
    path = shared_path(spark, "codes")
    genotypes.pack_calls(D.dense_probabilities(spark, d)).write.parquet(path)
    calls = genotypes.read_calls(spark, path, unpack=True)
    p = [rounded(F.get("gp", F.lit(i)).cast("double"), 4) for i in range(3)]
    return calls.select(
        "variant_index", "sample_index", p[0].alias("hom_ref"), p[1].alias("het"), p[2].alias("hom_alt"),
        rounded(F.col("dosage").cast("double"), 4).alias("dosage"),
    )


@query(
    """SELECT 'c_custkey' AS "column", 'bigint' AS type, count(c_custkey) AS non_null FROM customer
UNION ALL SELECT 'c_name', 'string', count(c_name) FROM customer
UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey) FROM customer
UNION ALL SELECT 'c_acctbal', 'double', count(c_acctbal) FROM customer
UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment) FROM customer"""
)
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return filters.column_profile(table(spark, d, "customer"))


@query(
    """SELECT event_type, count(*) AS n_rows, count(DISTINCT event_id) AS n_events, CAST(min(user_id) AS BIGINT) AS first_user FROM events GROUP BY event_type"""
)
def incremental_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Files taken in by a stream that is run twice; the second run finds nothing new."""
    out, state = shared_path(spark, "ingested"), shared_path(spark, "ingest-state")
    schema_ = table(spark, d, "events").schema

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    for _ in range(2):
        incremental.ingest_new_files(spark, d, schema_, state, sink, pathGlobFilter="events.parquet").awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("event_id").alias("n_events"), F.min("user_id").alias("first_user")
    )


@query(
    f"""WITH {D.TRAITS_SQL}
SELECT trait_group_id, CAST(batch_index AS INT) AS batch_index, CAST(count(*) AS BIGINT) AS n_values
FROM trait_values JOIN batches USING (trait_id) GROUP BY ALL"""
)
def incremental_rerun(spark: SparkSession, d: str) -> DataFrame:
    """Work run twice: the second run skips every finished (contig, batch, trait group)."""
    path = shared_path(spark, "results")
    batches, values = D.trait_batches(spark, d), D.trait_values(spark, d)
    work = batches.select(F.lit("21").alias("contig"), "batch_index", "trait_group_id").distinct()

    def compute(todo: DataFrame) -> DataFrame:
        wanted = batches.join(todo, ["batch_index", "trait_group_id"])
        return values.join(wanted, "trait_id").select("contig", "trait_group_id", "batch_index", "sample_id", "value")

    for _ in range(2):
        incremental.run_pending(spark, work, path, compute)
    done = spark.read.parquet(path)
    return done.groupBy(F.col("trait_group_id").cast("long"), "batch_index").agg(F.count(F.lit(1)).alias("n_values"))


@query(
    f"""WITH {D.TRAITS_SQL}
SELECT trait_group_id, CAST(batch_index AS INT) AS batch_index, count(value) FILTER (trait_group_id % 5 <> 0) AS n_values,
  round(sum(value) FILTER (trait_group_id % 5 <> 0), 4) + 0.0 AS total, trait_group_id % 5 <> 0 AS has_result, CAST(1 AS BIGINT) AS n_logged
FROM batches JOIN trait_values USING (trait_id) GROUP BY ALL"""
)
def commit_log_rerun(spark: SparkSession, d: str) -> DataFrame:
    """Work after a run that was ended between its files and its log: done again once, and logged also where it has no result."""
    path = shared_path(spark, "logged-results")
    batches, values = D.trait_batches(spark, d), D.trait_values(spark, d)
    work = batches.select(F.lit("21").alias("contig"), "batch_index", "trait_group_id").distinct()

    def compute(todo: DataFrame) -> DataFrame:
        wanted = batches.join(todo, ["batch_index", "trait_group_id"]).filter("trait_group_id % 5 <> 0")
        return values.join(wanted, "trait_id").select("contig", "trait_group_id", "batch_index", "sample_id", "value")

    unfinished = compute(work).filter("sample_id % 2 = 0").withColumn("value", F.lit(-1.0))
    sinks.write_results(unfinished, path)
    for _ in range(2):
        incremental.run_pending(spark, work, path, compute, settings="no fifth groups")
    stored = spark.read.parquet(path).withColumn("trait_group_id", F.col("trait_group_id").cast("long"))
    totals = stored.groupBy("trait_group_id", "batch_index").agg(F.count("value").alias("n_values"), rounded(F.sum("value"), 4).alias("total"))
    log = spark.read.parquet(incremental.log_path(path)).groupBy("trait_group_id", "batch_index")
    logged = log.agg(F.bool_or("has_result").alias("has_result"), F.count(F.lit(1)).alias("n_logged"))
    return logged.join(totals, ["trait_group_id", "batch_index"], "left").fillna({"n_values": 0})


_FIELD_NAME = "concat(p_name, ', \"', p_brand, '\"')"


@query(f"""SELECT CAST(p_partkey AS VARCHAR(20)) AS "FieldID", {_FIELD_NAME} AS "Field" FROM part""")
def dictionary_read(spark: SparkSession, d: str) -> DataFrame:
    """A data dictionary as quoted CSV, names with commas and quotes included, read back as text."""
    path = shared_path(spark, "dictionary")
    listed = table(spark, d, "part").selectExpr("p_size AS Category", "p_partkey AS FieldID", f"{_FIELD_NAME} AS Field")
    listed.write.csv(path, header=True, escape='"')
    return participants.read_dictionary(spark, path)


@query(
    f"""WITH {D.DENSE_GP_SQL}
SELECT '21' AS contig, concat('c', variant_index % 3) AS contig_name, variant_index, sample_index, round(p0, 6) + 0.0 AS hom_ref,
  round(p1, 6) + 0.0 AS het, round(p2, 6) + 0.0 AS hom_alt FROM gp"""
)
def probabilities_read(spark: SparkSession, d: str) -> DataFrame:
    """Decoded probabilities from a table that has more columns, in another order."""
    path = shared_path(spark, "probabilities")
    decoded = D.dense_probabilities(spark, d).selectExpr("gp", "'x' AS unused", "concat('c', variant_index % 3) AS contig_name", "variant_index", "sample_index", "'21' AS contig")
    sinks.write_table(decoded, path)
    read = genotypes.read_probabilities(spark, path)
    named = {n: rounded(F.col("gp")[i]) for i, n in enumerate(("hom_ref", "het", "hom_alt"))}
    return read.withColumns(named).drop("gp")


@query(
    f"""WITH {D.DENSE_GP_SQL}
SELECT variant_index, sample_index % 7 = 0 AS gp_mask, count(*) AS n_calls,
  CAST(sum(round_even(p1 * 254, 0) + 2 * round_even(p2 * 254, 0)) AS BIGINT) AS dosage_steps FROM gp GROUP BY ALL"""
)
def call_masks_read(spark: SparkSession, d: str) -> DataFrame:
    """Stored calls with a mask of zeros and ones, which comes back as a boolean; calls and the steps of 1/254 of their dosages per variant and mask."""
    path = shared_path(spark, "masked-calls")
    sinks.write_table(genotypes.pack_calls(D.dense_probabilities(spark, d)).withColumn("gp_mask", (F.col("sample_index") % 7 == 0).cast("byte")), path)
    calls = genotypes.read_calls(spark, path, unpack=True)
    steps = F.sum(F.round(F.col("dosage") * 254).cast("long"))
    return calls.groupBy("variant_index", "gp_mask").agg(F.count(F.lit(1)).alias("n_calls"), steps.alias("dosage_steps"))
