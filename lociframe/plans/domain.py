"""Association-study tables as projections of the driver tables, for Spark and for SQL.

``customer`` stands for participants, ``part`` for variant info, ``embeddings`` for dense
genotype probabilities, dosages and principal components, ``lineitem`` with ``orders`` for sparse
dosages, ``events`` for traits, and ``nation`` for the data dictionary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe import schema
from lociframe.operators import reshape
from lociframe.operators.traits import batch_traits
from lociframe.plans.registry import table

N_PC = 20
N_DENSE = 44
N_GP = 21

# Participants -----------------------------------------------------------------------------------

# Expressions valid in both dialects; all other fields follow a rule by field number.
PARTICIPANT_FIELDS = {
    "x22000_0_0": "c_mktsegment",
    "x22007_0_0": "concat('P', c_nationkey)",
    "x22008_0_0": "concat(substr('ABCDEFGH', CAST(1 + c_custkey % 8 AS INT), 1), 1 + c_custkey % 12)",
    "x22001_0_0": "CAST(c_nationkey % 2 AS VARCHAR(9))",
    "x22006_0_0": "CASE WHEN c_nationkey % 4 = 0 THEN '1' END",
    "x22019_0_0": "CASE WHEN c_custkey % 37 = 0 THEN '1' END",
    "x22027_0_0": "CASE WHEN c_custkey % 41 = 0 THEN '1' END",
    "x22020_0_0": "CASE WHEN c_custkey % 7 <> 0 THEN '1' ELSE '0' END",
    "x22028_0_0": "CASE WHEN c_custkey % 13 <> 0 THEN '1' ELSE '0' END",
    "x22029_0_0": "CASE WHEN c_custkey % 11 <> 0 THEN '1' ELSE '0' END",
    "x22030_0_0": "CASE WHEN c_custkey % 17 <> 0 THEN '1' ELSE '0' END",
    "x21022_0_0": "CASE WHEN c_custkey % 53 <> 0 THEN CAST(CAST(floor((c_acctbal + 1000) / 200) AS INT) AS VARCHAR(9)) END",
    "x31_0_0": "CAST(c_nationkey % 2 AS VARCHAR(9))",
    "x21000_0_0": "CAST(1001 + c_nationkey % 4 AS VARCHAR(9))",
}


def _participant_expr(field: str, element: str) -> str:
    if field in PARTICIPANT_FIELDS:
        return PARTICIPANT_FIELDS[field]
    number, _, array = (int(p) for p in field[1:].split("_"))
    if number == 22009:
        return f"CAST(CAST(floor(CAST({element.format(array - 1, array)} AS DOUBLE) * 10000) AS INT) AS VARCHAR(9))"
    return f"CAST((c_custkey + {number}) % 100 AS VARCHAR(9))"


def _participant_select(element: str) -> list[str]:
    fields = [f for f in schema.SAMPLE_QC_FIELDS if f != "eid"]
    return ["CAST(c_custkey AS INT) AS eid"] + [f"{_participant_expr(f, element)} AS {f}" for f in fields]


def participants(spark: SparkSession, d: str) -> DataFrame:
    """Wide participant table: integer id and text fields, 64 columns."""
    joined = table(spark, d, "customer").join(
        table(spark, d, "embeddings").withColumnRenamed("vec_id", "c_custkey"), "c_custkey", "left"
    )
    return joined.selectExpr(*_participant_select("get(embedding, {0})"))


PARTICIPANTS_SQL = (
    "participants AS (SELECT "
    + ", ".join(_participant_select("embedding[{1}]"))
    + " FROM customer LEFT JOIN embeddings ON vec_id = c_custkey)"
)

TEXT_QC = {"genotype_measurement_batch", "genotype_measurement_plate", "genotype_measurement_well"}


def packed_sample_qc(spark: SparkSession, d: str) -> DataFrame:
    """Typed sample QC table with packed principal components."""
    named = reshape.extract_sample_qc(participants(spark, d))
    typed = named.select(
        *[F.col(c) if c in TEXT_QC or c == "eid" else F.col(c).cast("double").alias(c) for c in named.columns]
    )
    return reshape.pack_principal_components(typed)


def sample_qc(spark: SparkSession, d: str) -> DataFrame:
    """The same with prefixed names."""
    return reshape.prefix_sample_qc(packed_sample_qc(spark, d)).withColumn("sample_id", F.col("sample_id").cast("long"))


SAMPLE_QC_SQL = (
    PARTICIPANTS_SQL
    + """, sample_qc AS (
  SELECT CAST(eid AS BIGINT) AS sample_id, CAST(x22019_0_0 AS DOUBLE) AS aneuploidy, CAST(x21022_0_0 AS DOUBLE) AS age,
    CAST(x22029_0_0 AS DOUBLE) AS phasing_x, CAST(x22028_0_0 AS DOUBLE) AS phasing, CAST(x22020_0_0 AS DOUBLE) AS in_pca,
    CAST(x21000_0_0 AS DOUBLE) AS ethnic_background, CAST(x22001_0_0 AS DOUBLE) AS genetic_sex, x22000_0_0 AS batch
  FROM participants),
kept_samples AS (
  SELECT * FROM sample_qc WHERE aneuploidy IS NULL AND age IS NOT NULL AND phasing_x = 1 AND phasing = 1 AND in_pca = 1
    AND ethnic_background IN (1001, 1002))"""
)

# Variants ---------------------------------------------------------------------------------------

_VARIANTS = """SELECT p_partkey AS variant_index, CAST(1 + p_partkey % 22 AS VARCHAR(9)) AS contig,
  concat(1 + p_partkey % 22, ':', 10000 + 100 * p_partkey, '_', substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1), '_',
    substr('ACGT', CAST(1 + (p_partkey + 1 + p_size % 3) % 4 AS INT), 1)) AS variant_id,
  concat('rs', p_partkey) AS rsid, CAST(10000 + 100 * p_partkey AS INT) AS position,
  substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS allele1_ref,
  substr('ACGT', CAST(1 + (p_partkey + 1 + p_size % 3) % 4 AS INT), 1) AS allele2_alt,
  substr('ACGT', CAST(1 + (p_partkey + 1 + p_size % 3) % 4 AS INT), 1) AS minor_allele,
  CAST(p_size - 1 AS DOUBLE) / 100 AS maf, CAST((p_partkey * 37) % 100 AS DOUBLE) / 100 AS info
FROM {}"""


def variants(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_VARIANTS.format("{part}"), part=table(spark, d, "part"))


VARIANTS_SQL = f"variants AS ({_VARIANTS.format('part')})"

# Calls ------------------------------------------------------------------------------------------


def dense_probabilities(spark: SparkSession, d: str) -> DataFrame:
    """One row per (variant, sample): the three numbers of each variant as probabilities (softmax)."""
    triples = F.array(
        *[F.struct(F.lit(v).cast("long").alias("variant_index"), F.slice("embedding", 3 * v + 1, 3).alias("raw")) for v in range(N_GP)]
    )
    calls = table(spark, d, "embeddings").select(F.col("vec_id").alias("sample_index"), F.inline(triples))
    e = [F.exp(F.get("raw", F.lit(i)).cast("double")) for i in range(3)]
    total = e[0] + e[1] + e[2]
    return calls.select("variant_index", "sample_index", F.array(*[x / total for x in e]).alias("gp"))


DENSE_GP_SQL = f"""raw_gp AS (
  SELECT v AS variant_index, vec_id AS sample_index, exp(CAST(embedding[3 * v + 1] AS DOUBLE)) AS e0,
    exp(CAST(embedding[3 * v + 2] AS DOUBLE)) AS e1, exp(CAST(embedding[3 * v + 3] AS DOUBLE)) AS e2
  FROM embeddings, (SELECT range AS v FROM range({N_GP}))),
gp AS (SELECT variant_index, sample_index, e0 / (e0 + e1 + e2) AS p0, e1 / (e0 + e1 + e2) AS p1, e2 / (e0 + e1 + e2) AS p2 FROM raw_gp),
calls AS (SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS g FROM gp),
counts AS (SELECT variant_index, count(*) FILTER (g = 1) AS n_het, count(*) FILTER (g = 0) AS n_hom_ref,
    count(*) FILTER (g = 2) AS n_hom_alt FROM calls GROUP BY variant_index)"""


def dense_dosages(spark: SparkSession, d: str, first: int = N_PC) -> DataFrame:
    """One row per (variant, sample): vector elements from ``first`` on as dosages."""
    tail = F.slice("embedding", first + 1, 64 - first)
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("sample_index"), tail.alias("v"))
    calls = reshape.explode_vector(vectors, "v", "variant_index", "dosage")
    return calls.select(
        F.lit("1").alias("contig"), F.col("variant_index").cast("long"), "sample_index", F.col("dosage").cast("double")
    )


def dense_dosage_sql(first: int = N_PC) -> str:
    return f"""dosages AS (
  SELECT vec_id AS sample_index, v AS variant_index, CAST(embedding[v + {first + 1}] AS DOUBLE) AS g
  FROM embeddings, (SELECT range AS v FROM range({64 - first})))"""


def sparse_dosages(spark: SparkSession, d: str) -> DataFrame:
    """Non-zero calls: a participant's dosage of a variant is the number of its line items, two at most."""
    lines = table(spark, d, "lineitem").select("l_orderkey", F.col("l_partkey").alias("variant_index"))
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("sample_index"))
    return (
        lines.join(orders, "l_orderkey")
        .groupBy("variant_index", "sample_index")
        .agg(F.least(F.count(F.lit(1)), F.lit(2)).cast("double").alias("dosage"))
        .select((F.lit(1) + F.col("variant_index") % 22).cast("string").alias("contig"), "variant_index", "sample_index", "dosage")
    )


SPARSE_SQL = """sparse AS (
  SELECT l_partkey AS variant_index, o_custkey AS sample_index, CAST(least(count(*), 2) AS DOUBLE) AS g
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""

SPARSE_COUNTS_SQL = """counts AS (SELECT variant_index, count(*) FILTER (g = 1) AS n_het,
  (SELECT count(*) FROM customer) - count(*) FILTER (g = 1) - count(*) FILTER (g = 2) AS n_hom_ref,
  count(*) FILTER (g = 2) AS n_hom_alt FROM sparse GROUP BY variant_index)"""

# Traits -----------------------------------------------------------------------------------------

# Trait groups that event types stand for.
TRAIT_GROUPS = {"click": 50, "error": 1990, "purchase": 20095, "signup": 23098, "view": 41210}
N_PERIODS = 6  # of six days; the last holds day 31
TRAIT_IDS = sorted(f"{g}_{p}" for g in TRAIT_GROUPS.values() for p in range(N_PERIODS))

_TRAIT_ID = (
    "concat(CASE event_type "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TRAIT_GROUPS.items())
    + " END, '_', CAST(floor((day(ts) - 1) / 6) AS INT))"
)


def trait_values(spark: SparkSession, d: str) -> DataFrame:
    """(sample, trait, value): values of one event type in one period."""
    events = table(spark, d, "events").selectExpr("user_id AS sample_id", f"{_TRAIT_ID} AS trait_id", "value")
    return events.groupBy("sample_id", "trait_id").agg(F.sum("value").alias("value"))


def traits(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "events").selectExpr(f"{_TRAIT_ID} AS trait_id").distinct()
    return reshape.describe_traits(ids)


def trait_batches(spark: SparkSession, d: str, batch_size: int = 2) -> DataFrame:
    return batch_traits(traits(spark, d), batch_size)


def trait_wide(spark: SparkSession, d: str) -> DataFrame:
    """Participants by traits, the layout of a normalised phenotype file."""
    events = table(spark, d, "events").selectExpr("user_id AS userId", f"{_TRAIT_ID} AS trait_id", "value")
    return events.groupBy("userId").pivot("trait_id", TRAIT_IDS).agg(F.sum("value"))


_BATCHED = """{name} AS (
  SELECT *, CASE WHEN r < rem * (base + 1) THEN r // (base + 1) ELSE rem + (r - rem * (base + 1)) // base END AS batch_index
  FROM (SELECT *, n // k AS base, n % k AS rem FROM (
    SELECT *, CAST(ceil(n / {size}.0) AS BIGINT) AS k FROM (
      SELECT *, row_number() OVER (PARTITION BY trait_group_id ORDER BY trait_id) - 1 AS r,
        count(*) OVER (PARTITION BY trait_group_id) AS n FROM {source}))))"""


def batches_sql(source: str, name: str, size: int) -> str:
    """Batches as array_split makes them."""
    return _BATCHED.format(source=source, name=name, size=size)


TRAITS_SQL = f"""trait_values AS (
  SELECT user_id AS sample_id, {_TRAIT_ID} AS trait_id, sum(value) AS value FROM events GROUP BY ALL),
traits AS (SELECT DISTINCT trait_id, CAST(split_part(trait_id, '_', 1) AS BIGINT) AS trait_group_id,
  split_part(trait_id, '_', 2) AS trait_code_id FROM trait_values),
{batches_sql("traits", "batched", 2)},
batches AS (
  SELECT *, concat(lpad(CAST(batch_index AS VARCHAR), 3, '0'), '_', trait_group_id) AS batch_key,
    row_number() OVER (PARTITION BY trait_group_id, batch_index ORDER BY trait_id) - 1 AS trait_index,
    count(*) OVER (PARTITION BY trait_group_id, batch_index) AS batch_size FROM batched),
complete AS (
  SELECT batch_key, sample_id FROM trait_values JOIN batches USING (trait_id)
  GROUP BY batch_key, sample_id, batch_size HAVING count(value) = batch_size)"""

# Cohort -----------------------------------------------------------------------------------------

_COHORT = """SELECT c_custkey AS sample_id, c_custkey AS sample_index, CAST(floor((c_acctbal + 1000) / 200) AS INT) AS age_at_recruitment,
  CAST(c_nationkey % 2 AS INT) AS genetic_sex FROM {}"""


def cohort(spark: SparkSession, d: str) -> DataFrame:
    """All participants with genotypes: age, sex and principal components."""
    people = spark.sql(_COHORT.format("{c}"), c=table(spark, d, "customer"))
    pcs = table(spark, d, "embeddings").select(
        F.col("vec_id").alias("sample_id"),
        F.slice("embedding", 1, N_PC).cast("array<double>").alias("principal_component"),
    )
    return people.join(pcs, "sample_id")


COHORT_SQL = f"""cohort AS (SELECT p.*, CAST(embedding[1:{N_PC}] AS DOUBLE[]) AS pc
  FROM ({_COHORT.format("customer")}) p JOIN embeddings ON vec_id = sample_id)"""


def covariates_sql(npc: int, source: str = "cohort") -> tuple[str, list[str]]:
    """CTE ``covariates`` with standardised columns x1..xk over the whole source, and their names."""
    raw = [
        "CAST(age_at_recruitment AS DOUBLE)",
        "CAST(age_at_recruitment AS DOUBLE) ** 2",
        "CAST(genetic_sex AS DOUBLE)",
        "CAST(genetic_sex * age_at_recruitment AS DOUBLE)",
        "CAST(genetic_sex AS DOUBLE) * CAST(age_at_recruitment AS DOUBLE) ** 2",
        *[f"pc[{i}]" for i in range(1, npc + 1)],
    ]
    names = [f"x{i + 1}" for i in range(len(raw))]
    columns = ", ".join(f"({e} - avg({e}) OVER ()) / stddev_pop({e}) OVER () AS {n}" for e, n in zip(raw, names))
    return f"covariates AS (SELECT sample_id, sample_index, {columns} FROM {source})", names


def adjusted_sql(rows: str, keys: str, xs: list[str], tolerance: float = 1e-9) -> str:
    """CTEs ending in ``fit``: the regression of y on g given xs within ``keys``, by successive residuals.

    ``rows`` is the CTE with the keys, y, g and the xs. A covariate without variation left is skipped.
    """
    columns = [*xs, "y", "g"]
    centred = ", ".join(f"{c} - avg({c}) OVER w AS {c}" for c in columns)
    steps = [f"r0 AS (SELECT {keys}, 0 AS used, {centred} FROM {rows} WINDOW w AS (PARTITION BY {keys}))"]
    for i, x in enumerate(xs):
        rest = columns[i + 1 :]
        kept = f"sum({x} * {x}) OVER w > {tolerance} * count(*) OVER w"
        swept = ", ".join(
            f"CASE WHEN {kept} THEN {c} - {x} * (sum({c} * {x}) OVER w / sum({x} * {x}) OVER w) ELSE {c} END AS {c}" for c in rest
        )
        steps.append(
            f"r{i + 1} AS (SELECT {keys}, used + CASE WHEN {kept} THEN 1 ELSE 0 END AS used, {swept} FROM r{i} "
            f"WINDOW w AS (PARTITION BY {keys}))"
        )
    steps.append(
        f"sums AS (SELECT {keys}, count(*) AS n, count(*) - max(used) - 2 AS dof, sum(g * g) AS gg, sum(g * y) AS gy, "
        f"sum(y * y) AS yy FROM r{len(xs)} GROUP BY {keys})"
    )
    steps.append(
        f"fit AS (SELECT {keys}, n, dof, CASE WHEN dof > 0 AND gg > 1e-12 THEN gy / gg END AS beta, "
        f"CASE WHEN dof > 0 AND gg > 1e-12 THEN sqrt(greatest(yy - gy * gy / gg, 0) / dof / gg) END AS se FROM sums)"
    )
    return ",\n".join(steps)


def p_value_sql(source: str, keys: str) -> str:
    """CTE ``tested``: two-sided p of t with whole degrees of freedom by the finite trigonometric series."""
    return f"""angles AS (SELECT *, atan(abs(t) / sqrt(dof)) AS a FROM {source}),
terms AS (SELECT {keys}, any_value(t) AS t, any_value(dof) AS dof, any_value(a) AS a,
    coalesce(sum(CASE WHEN dof % 2 = 0 AND j < dof // 2 THEN exp(lgamma(j + 0.5) - lgamma(j + 1)) / sqrt(pi()) * cos(a) ** (2 * j)
      WHEN dof % 2 = 1 AND j < (dof - 1) // 2 THEN sqrt(pi()) / 2 * exp(lgamma(j + 1) - lgamma(j + 1.5)) * cos(a) ** (2 * j + 1)
      ELSE 0 END), 0) AS s
  FROM angles, unnest(range(CAST(greatest(coalesce(dof, 0) // 2, 1) AS BIGINT))) AS u(j) GROUP BY {keys}),
tested AS (SELECT {keys}, t, dof, CASE WHEN t IS NOT NULL AND dof > 0 THEN
    greatest(CASE WHEN dof % 2 = 0 THEN 1 - sin(a) * s ELSE 1 - 2 / pi() * (a + sin(a) * s) END, 0) END AS p FROM terms)"""


HWE_SQL = """hwe AS (
  SELECT variant_index, any_value(n_het) AS n_het, any_value(n_hom_ref) AS n_hom_ref, any_value(n_hom_alt) AS n_hom_alt,
    least(1.0, sum(pr) FILTER (pr <= seen * (1 + 1e-9))) AS p
  FROM (SELECT *, max(CASE WHEN h = n_het THEN pr END) OVER (PARTITION BY variant_index) AS seen FROM (
    SELECT *, exp(h * ln(2) + lgamma(n + 1) - lgamma((rare - h) / 2 + 1) - lgamma(h + 1) - lgamma(n - h - (rare - h) / 2 + 1)
      + lgamma(rare + 1) + lgamma(2 * n - rare + 1) - lgamma(2 * n + 1)) AS pr
    FROM (SELECT *, rare % 2 + 2 * j AS h FROM (
      SELECT *, n_het + n_hom_ref + n_hom_alt AS n, n_het + 2 * least(n_hom_ref, n_hom_alt) AS rare FROM counts),
      unnest(range(CAST(rare // 2 + 1 AS BIGINT))) AS u(j))))
  GROUP BY variant_index)"""
