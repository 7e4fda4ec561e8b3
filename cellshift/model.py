"""Table schemas and the fixed values every module shares.

Cells, genes and the non-zero matrix entries are three plain tables; every
alignment between them is a join on ``cell_id`` or ``gene_symbol``.  Operators
only name columns, so a table may carry its keys as strings or as integers.
"""

from pyspark.sql import types as T


def _text_list() -> T.ArrayType:
    return T.ArrayType(T.StringType())


CELLS = T.StructType(
    [
        T.StructField("cell_id", T.StringType(), False),
        T.StructField("cell_type", T.StringType()),
        T.StructField("donor", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)

GENES = T.StructType(
    [
        T.StructField("gene_symbol", T.StringType(), False),
        T.StructField("chromosome", T.StringType()),
        T.StructField("gene_id", T.StringType()),
        T.StructField("is_target_gene", T.BooleanType()),
    ]
)

EXPRESSION = T.StructType(
    [
        T.StructField("cell_id", T.StringType(), False),
        T.StructField("gene_symbol", T.StringType(), False),
        T.StructField("value", T.FloatType()),
    ]
)

# One entry of the "perturbations" list in a config document.
SPEC_ENTRY = T.StructType(
    [
        T.StructField("perturbation_type", T.StringType()),
        T.StructField("gene", T.StringType()),
        T.StructField("genes", _text_list()),
        T.StructField("fold_change", T.DoubleType()),
        T.StructField("delta", T.DoubleType()),
        T.StructField("target_donors", _text_list()),
        T.StructField("target_cell_types", _text_list()),
    ]
)

SPEC_CONFIG = T.StructType(
    [
        T.StructField("perturbation_types", _text_list()),
        T.StructField("perturbations", T.ArrayType(SPEC_ENTRY)),
    ]
)

EMBEDDINGS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("experiment_id", T.StringType()),
        T.StructField("cell_id", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

CHECK_EVENTS = T.StructType(
    [
        T.StructField("storage_id", T.LongType(), False),
        T.StructField("ts", T.TimestampType()),
        T.StructField("asset_key", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("severity", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

# --- fixed values: these must equal the published ones -----------------------

PERTURBATION_TYPES = ("gene_knockout", "gene_overexpression", "gene_activation")

MODEL_NAMES = (
    "mock_foundation_model_1",
    "mock_foundation_model_2",
    "mock_foundation_model_3",
)
MODEL_VERSION = "0.1.0"
EMBEDDING_DIM = 512
EMBEDDING_DTYPE = "float32"

DEFAULT_OVEREXPRESSION_FOLD = 2.0
DEFAULT_ACTIVATION_FOLD = 1.5

REQUIRED_CELL_COLUMNS = ("cell_type", "donor", "batch")
REQUIRED_GENE_COLUMNS = ("gene_symbol", "chromosome", "gene_id", "is_target_gene")
REQUIRED_SUMMARY_FIELDS = (
    "experiment_id",
    "mean_distance",
    "median_distance",
    "n_target_cells",
)

CONTEXT_FIELDS = (
    "experiment_id",
    "perturbation_type",
    "gene",
    "genes",
    "involved_donors",
    "involved_cell_types",
    "target_donors",
    "target_cell_types",
)

PROFILE_PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
DESCRIBE_PERCENTILES = (0.25, 0.5, 0.75)

# Hours after which the latest materialization of an output counts as stale.
FRESHNESS_HOURS = {
    "synthetic_adata": 24,
    "preview_data": 12,
    "perturbation_run": 6,
    "comparison_results": 6,
    "perturbation_run_batch": 6,
    "comparison_results_batch": 6,
}

ALERT_FETCH_LIMIT = 200
# -----------------------------------------------------------------------------

# Where the jobs keep vectors and distances below their root; records name a run's folder there.
EMBEDDINGS_AT = "silver/embeddings"
DISTANCES_AT = "silver/distances"
