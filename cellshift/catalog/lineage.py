"""Registered queries over tokens, memoization and the merging of runs."""

from pyspark.sql import functions as F

from cellshift import model
from cellshift.catalog import binding as b
from cellshift.catalog.experiments import BATCH, SPECS
from cellshift.catalog.registry import query
from cellshift.functions.hashing import version_token
from cellshift.functions.text import normalized_label
from cellshift.operators import embed, lineage, specs as sp

# Work items: every user asks for one type of experiment on a dataset named
# after the user, with one of the models.
WORK_SQL = """
WITH work AS (
  SELECT DISTINCT 'data/' || user_id || '.h5ad' AS dataset,
    ['gene_knockout', 'gene_overexpression', 'gene_activation'][event_id % 3 + 1] AS perturbation_type,
    'mock_foundation_model_' || user_id % 3 + 1 AS model_name,
    left(sha256(user_id::VARCHAR), 20) AS dataset_fingerprint, event_type AS config_fingerprint,
    '0.1.0' AS model_version
  FROM events),
tokens AS (
  SELECT *, left(sha256(concat_ws('|', 'perturbation_typed', dataset, perturbation_type, model_name,
    dataset_fingerprint, config_fingerprint, model_version)), 24) AS token FROM work),
runs AS (SELECT *, perturbation_type || '__' || left(token, 12) AS run_id FROM tokens),
done AS (SELECT token FROM runs WHERE config_fingerprint IN ('click', 'error'))"""


def _work(spark, sf):
    user = F.col("user_id")
    types = F.array(*[F.lit(t) for t in model.PERTURBATION_TYPES])
    return (
        b.table(spark, sf, "events")
        .select(
            F.concat(F.lit("data/"), user.cast("string"), F.lit(".h5ad")).alias("dataset"),
            F.element_at(types, (F.col("event_id") % 3 + 1).cast("int")).alias("perturbation_type"),
            F.concat(F.lit("mock_foundation_model_"), (user % 3 + 1).cast("string")).alias("model_name"),
            F.left(F.sha2(user.cast("string"), 256), F.lit(20)).alias("dataset_fingerprint"),
            F.col("event_type").alias("config_fingerprint"),
            F.lit(model.MODEL_VERSION).alias("model_version"),
        )
        .distinct()
    )


def _tokens(spark, sf):
    return lineage.with_typed_token(_work(spark, sf))


def _done(spark, sf):
    """Work finished earlier: the runs of two of the configs."""
    return _tokens(spark, sf).where(F.col("config_fingerprint").isin("click", "error"))


@query("memo_tokens", WORK_SQL + "SELECT * FROM runs")
def memo_tokens(spark, sf):
    return _tokens(spark, sf)


@query("memo_to_do", WORK_SQL + "SELECT run_id, token FROM runs WHERE token NOT IN (SELECT token FROM done)")
def memo_to_do(spark, sf):
    return lineage.to_do(_tokens(spark, sf), _done(spark, sf)).select("run_id", "token")


@query("memo_reusable", WORK_SQL + "SELECT run_id, token FROM runs WHERE token IN (SELECT token FROM done)")
def memo_reusable(spark, sf):
    return lineage.reusable(_tokens(spark, sf), _done(spark, sf)).select("run_id", "token")


@query(
    "cache_counts",
    WORK_SQL
    + """
SELECT perturbation_type, count(*) FILTER (token IN (SELECT token FROM done)) AS cache_hits,
  count(*) FILTER (token NOT IN (SELECT token FROM done)) AS cache_misses
FROM runs GROUP BY 1""",
)
def cache_counts(spark, sf):
    hits = lineage.with_cache_hit(_tokens(spark, sf), _done(spark, sf))
    return lineage.cache_counts(hits, "perturbation_type")


BATCH_SQL = (
    SPECS
    + """
, rows AS (
  SELECT printf('batch_%04d', position // 7) AS batch_key, kind AS perturbation_type,
    concat_ws('|', position::VARCHAR, perturbation_type, coalesce(gene::VARCHAR, '')) AS text
  FROM typed),
prints AS (
  SELECT batch_key, perturbation_type, left(sha256(
    sum(('0x' || left(sha256(text), 15))::BIGINT::HUGEINT)::VARCHAR || '|' || count(*)), 24) AS specs_fingerprint
  FROM rows GROUP BY 1, 2),
tokens AS (
  SELECT *, left(sha256(concat_ws('|', 'perturbation_batch', perturbation_type, batch_key,
    'mock_foundation_model_1', 'data', 'config', '0.1.0', specs_fingerprint)), 24) AS token FROM prints)
SELECT batch_key, perturbation_type, specs_fingerprint, token,
  perturbation_type || '__' || batch_key || '__' || left(token, 12) AS run_id,
  left(sha256('comparison|' || perturbation_type || '__' || batch_key || '__' || left(token, 12) || '|baseline'), 24) AS comparison_token
FROM tokens"""
)


@query("batch_memo_tokens", BATCH_SQL)
def batch_memo_tokens(spark, sf):
    members = sp.with_batch(b.specs(spark, sf), BATCH).select(
        "batch_key",
        normalized_label(F.col("perturbation_type")).alias("perturbation_type"),
        F.concat_ws(
            "|",
            F.col("position").cast("string"),
            "perturbation_type",
            F.coalesce(F.col("gene").cast("string"), F.lit("")),
        ).alias("text"),
    )
    work = (
        lineage.rows_fingerprint(
            members, ["batch_key", "perturbation_type"], "text", "specs_fingerprint"
        )
        .withColumn("model_name", F.lit(model.MODEL_NAMES[0]))
        .withColumn("model_version", F.lit(model.MODEL_VERSION))
        .withColumn("dataset_fingerprint", F.lit("data"))
        .withColumn("config_fingerprint", F.lit("config"))
        .withColumn("baseline_fingerprint", F.lit("baseline"))
    )
    return lineage.with_comparison_token(lineage.with_batch_token(work)).select(
        "batch_key", "perturbation_type", "specs_fingerprint", "token", "run_id", "comparison_token"
    )


RUN_LOG_SQL = """
WITH runs AS (
  SELECT event_id AS position, event_type AS perturbation_type, user_id % 4 = 0 AS skipped,
    CASE WHEN user_id % 5 = 1 THEN NULL WHEN user_id % 5 = 2 THEN '' ELSE 'runs/' || event_type || '__' || event_id END AS run_prefix
  FROM events),
active AS (SELECT * FROM runs WHERE NOT skipped AND coalesce(run_prefix, '') <> ''),
last AS (SELECT a.* FROM active a JOIN (SELECT perturbation_type, max(position) AS position FROM active GROUP BY 1)
  USING (perturbation_type, position))"""


def _run_log(spark, sf):
    user, kind = F.col("user_id"), F.col("event_type")
    prefix = F.concat(F.lit("runs/"), kind, F.lit("__"), F.col("event_id").cast("string"))
    return b.table(spark, sf, "events").select(
        F.col("event_id").alias("position"),
        kind.alias("perturbation_type"),
        (user % 4 == 0).alias("skipped"),
        F.when(user % 5 == 1, F.lit(None)).when(user % 5 == 2, F.lit("")).otherwise(prefix).alias("run_prefix"),
    )


@query("active_runs", RUN_LOG_SQL + "SELECT * FROM active")
def active_runs(spark, sf):
    return lineage.active_runs(_run_log(spark, sf))


@query("merged_runs", RUN_LOG_SQL + "SELECT * FROM last")
def merged_runs(spark, sf):
    """One run set from three typed logs: the last active run of every type."""
    log = _run_log(spark, sf)
    kind = F.col("perturbation_type")
    return lineage.merged_runs(
        log.where(kind.isin("click", "view")), log.where(kind == "error"), log.where(kind.isin("signup", "purchase"))
    )


@query(
    "results_of_runs",
    RUN_LOG_SQL
    + """
SELECT perturbation_type, run_prefix, regexp_extract(run_prefix, '[^/]*$') AS run_id,
  'results/' || regexp_extract(run_prefix, '[^/]*$') AS results_prefix, value
FROM active a LEFT JOIN (SELECT event_id, value FROM events WHERE event_type <> 'view') ON event_id = position""",
)
def results_of_runs(spark, sf):
    """Each active run with its stored result, if there is one."""
    events = b.table(spark, sf, "events")
    results = events.where("event_type <> 'view'").select(
        F.concat("event_type", F.lit("__"), F.col("event_id").cast("string")).alias("run_id"), "value"
    )
    return lineage.results_of_runs(lineage.active_runs(_run_log(spark, sf)), results).select(
        "perturbation_type",
        "run_prefix",
        "run_id",
        lineage.result_prefix("results\\", F.col("run_prefix")).alias("results_prefix"),
        "value",
    )


@query(
    "new_batch_keys",
    SPECS
    + """
SELECT DISTINCT printf('batch_%04d', position // 3) AS batch_key FROM specs
WHERE printf('batch_%04d', position // 3) NOT IN (SELECT printf('batch_%04d', position // 7) FROM specs)""",
)
def new_batch_keys(spark, sf):
    specs = b.specs(spark, sf)
    return lineage.new_keys(sp.with_batch(specs, 3), sp.with_batch(specs, BATCH).select("batch_key").distinct(), "batch_key")


VERSION_SQL = (
    WORK_SQL
    + """
, versions AS (
  SELECT *, left(sha256('emb|' || token), 24) AS embeddings_fingerprint,
    left(sha256(concat_ws('|', 'perturbation_run', dataset, perturbation_type, run_id, dataset_fingerprint,
      left(sha256('emb|' || token), 24), model_version, model_name)), 24) AS data_version
  FROM runs)"""
)


def _versions(spark, sf):
    runs = _tokens(spark, sf).withColumn(
        "embeddings_fingerprint", version_token(F.lit("emb"), F.col("token"))
    )
    return lineage.run_versions(runs)


@query("run_versions", VERSION_SQL + "SELECT run_id, data_version FROM versions")
def run_versions(spark, sf):
    return _versions(spark, sf).select("run_id", "data_version")


@query(
    "aggregate_versions",
    VERSION_SQL
    + """
SELECT model_name, left(sha256('perturbation_run_aggregate|' || model_name || '|' || left(sha256(
  sum(('0x' || left(sha256(perturbation_type || ':' || data_version), 15))::BIGINT::HUGEINT)::VARCHAR
  || '|' || count(*)), 24)), 24) AS data_version
FROM (SELECT DISTINCT model_name, perturbation_type, data_version FROM versions) GROUP BY 1""",
)
def aggregate_versions(spark, sf):
    return lineage.aggregate_version(_versions(spark, sf))


@query(
    "comparison_version",
    RUN_LOG_SQL
    + """
, prints AS (SELECT left(sha256(run_prefix), 20) AS fingerprint FROM last)
SELECT left(sha256('comparison_results|' || string_agg(fingerprint, '|' ORDER BY fingerprint)
  || '|0.1.0|mock_foundation_model_1'), 24) AS data_version, count(*) AS n_result_sets FROM prints""",
)
def comparison_version(spark, sf):
    """Version over the result sets of a merged run set."""
    results = merged_runs(spark, sf).select(F.left(F.sha2("run_prefix", 256), F.lit(20)).alias("fingerprint"))
    return lineage.comparison_version(results, model.MODEL_VERSION, model.MODEL_NAMES[0])


MODELS_SQL = """
WITH runs AS (
  SELECT event_id AS run_id, CASE WHEN user_id % 5 = 0 THEN NULL
    ELSE 'mock_foundation_model_' || user_id % 5 END AS model_name FROM events),
named AS (SELECT run_id, coalesce(model_name, 'mock_foundation_model_1') AS model_name FROM runs)"""


def _model_runs(spark, sf):
    n = F.col("user_id") % 5
    name = F.concat(F.lit("mock_foundation_model_"), n.cast("string"))
    return b.table(spark, sf, "events").select(
        F.col("event_id").alias("run_id"), F.when(n != 0, name).alias("model_name")
    )


@query(
    "model_stamps",
    MODELS_SQL
    + """
SELECT run_id, model_name, '0.1.0' AS model_version, 512 AS embedding_dim, 'float32' AS embedding_dtype
FROM named WHERE model_name <> 'mock_foundation_model_4'""",
)
def model_stamps(spark, sf):
    return embed.stamped(_model_runs(spark, sf))


@query("models_unknown", MODELS_SQL + "SELECT run_id, model_name FROM named WHERE model_name = 'mock_foundation_model_4'")
def models_unknown(spark, sf):
    return embed.unknown_models(_model_runs(spark, sf)).select("run_id", "model_name")
