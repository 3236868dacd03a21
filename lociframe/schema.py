"""Declared schemas and fixed value tables."""

from __future__ import annotations

from pyspark.sql import types as T

VARIANT_INFO = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("rsid", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("allele1_ref", T.StringType()),
        T.StructField("allele2_alt", T.StringType()),
        T.StructField("maf", T.FloatType()),
        T.StructField("minor_allele", T.StringType()),
        T.StructField("info", T.FloatType()),
    ]
)

SAMPLE_FILE = T.StructType(
    [
        T.StructField("id1", T.StringType()),
        T.StructField("id2", T.StringType()),
        T.StructField("missing", T.StringType()),
        T.StructField("sex", T.StringType()),
    ]
)

CONTIG = T.StructType(
    [
        T.StructField("index", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("n_consent_samples", T.StringType()),
        T.StructField("n_variants", T.StringType()),
    ]
)

# Participant field -> sample QC column.
SAMPLE_QC_FIELDS = {
    "eid": "eid",
    "x22000_0_0": "genotype_measurement_batch",
    "x22007_0_0": "genotype_measurement_plate",
    "x22008_0_0": "genotype_measurement_well",
    "x22001_0_0": "genetic_sex",
    "x22021_0_0": "genetic_kinship_to_other_participants",
    "x22006_0_0": "genetic_ethnic_grouping",
    "x22019_0_0": "sex_chromosome_aneuploidy",
    "x22027_0_0": "outliers_for_heterozygosity_or_missing_rate",
    "x22003_0_0": "heterozygosity",
    "x22004_0_0": "heterozygosity_pca_corrected",
    "x22005_0_0": "missingness",
    "x22020_0_0": "used_in_genetic_principal_components",
    "x22022_0_0": "sex_inference_x_probe_intensity",
    "x22023_0_0": "sex_inference_y_probe_intensity",
    "x22025_0_0": "affymetrix_quality_control_metric_cluster_cr",
    "x22026_0_0": "affymetrix_quality_control_metric_dqc",
    "x22024_0_0": "dna_concentration",
    "x22028_0_0": "use_in_phasing_chromosomes_1_22",
    "x22029_0_0": "use_in_phasing_chromosome_x",
    "x22030_0_0": "use_in_phasing_chromosome_xy",
    "x21022_0_0": "age_at_recruitment",
    "x31_0_0": "sex",
    "x21000_0_0": "ethnic_background",
}
N_PRINCIPAL_COMPONENTS = 40
SAMPLE_QC_FIELDS.update(
    {f"x22009_0_{i}": f"genetic_principal_component_{i:02d}" for i in range(1, N_PRINCIPAL_COMPONENTS + 1)}
)

# Sample QC columns carried into the association input.
SAMPLE_QC_KEEP = [
    "sample_id",
    "sample_qc_sex",
    "sample_genetic_sex",
    "sample_age_at_recruitment",
    "sample_principal_component",
    "sample_ethnic_background",
    "sample_genotype_measurement_batch",
    "sample_genotype_measurement_plate",
    "sample_genotype_measurement_well",
]

# The columns of the final variables snapshot, by table.
SNAPSHOT_COLUMNS = {
    "variants": [
        "variant_contig",
        "variant_contig_name",
        "variant_id",
        "variant_rsid",
        "variant_position",
        "variant_allele",
        "variant_minor_allele",
        "variant_hwe_p_value",
        "variant_maf",
        "variant_info",
    ],
    "samples": [
        "sample_id",
        "sample_principal_component",
        "sample_covariate",
        "sample_genetic_sex",
        "sample_age_at_recruitment",
        "sample_ethnic_background",
    ],
    "traits": [
        "sample_trait",
        "sample_trait_id",
        "sample_trait_group_id",
        "sample_trait_code_id",
        "sample_trait_name",
    ],
}

# Contigs as (index, code, name, n_consent_samples, n_variants); numbers only for the imputed ones.
CONTIGS = [
    ("0", "1", "1", "487296", "7402791"),
    ("1", "2", "2", "487296", "8129063"),
    ("2", "3", "3", "487296", "6696680"),
    ("3", "4", "4", "487296", "6555871"),
    ("4", "5", "5", "487296", "6070641"),
    ("5", "6", "6", "487296", "5751712"),
    ("6", "7", "7", "487296", "5405524"),
    ("7", "8", "8", "487296", "5282223"),
    ("8", "9", "9", "487296", "4066774"),
    ("9", "10", "10", "487296", "4562904"),
    ("10", "11", "11", "487296", "4628348"),
    ("11", "12", "12", "487296", "4431052"),
    ("12", "13", "13", "487296", "3270217"),
    ("13", "14", "14", "487296", "3037521"),
    ("14", "15", "15", "487296", "2767971"),
    ("15", "16", "16", "487296", "3089612"),
    ("16", "17", "17", "487296", "2660711"),
    ("17", "18", "18", "487296", "2599579"),
    ("18", "19", "19", "487296", "2087017"),
    ("19", "20", "20", "487296", "2082571"),
    ("20", "21", "21", "487296", "1261158"),
    ("21", "22", "22", "487296", "1255683"),
    ("22", "23", "X", "486645", "3917799"),
    ("23", "24", "Y", None, None),
    ("24", "25", "XY", "486331", "45906"),
    ("25", "26", "MT", None, None),
]

# Keyword sets for the variable list.
TERM_SETS = {"basic": ["diabetes", "sleep", "depression", "cardiac", "addiction", "height", "weight"]}


def contig_names() -> list[str]:
    """The 26 hard-call contigs in index order."""
    return [row[2] for row in CONTIGS]


def contig_rows(imputed: bool = True) -> list[tuple]:
    """(index, code, name, n_consent_samples, n_variants), all text: the 24 imputed contigs, or all 26 without numbers."""
    if imputed:
        return [row for row in CONTIGS if row[4] is not None]
    return [(*row[:3], None, None) for row in CONTIGS]
