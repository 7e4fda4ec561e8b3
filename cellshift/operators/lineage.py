"""Memoization, data versions and the merging of runs, as joins on tokens."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellshift.functions.hashing import list_token, version_token
from cellshift.functions.text import batch_run_id, last_segment, root_key, typed_run_id
from cellshift.operators.latest import latest_by


def with_typed_token(work: DataFrame) -> DataFrame:
    """Token and run id of typed work: ``dataset, perturbation_type, model_name,
    dataset_fingerprint, config_fingerprint, model_version``."""
    token = version_token(
        F.lit("perturbation_typed"),
        F.col("dataset"),
        F.col("perturbation_type"),
        F.col("model_name"),
        F.col("dataset_fingerprint"),
        F.col("config_fingerprint"),
        F.col("model_version"),
    )
    return work.withColumn("token", token).withColumn(
        "run_id", typed_run_id(F.col("perturbation_type"), F.col("token"))
    )


def with_batch_token(work: DataFrame) -> DataFrame:
    """Token and run id of batch work.

    ``specs_fingerprint`` covers the experiments of the batch, so another batch
    size never reuses the results of the old one.
    """
    token = version_token(
        F.lit("perturbation_batch"),
        F.col("perturbation_type"),
        F.col("batch_key"),
        F.col("model_name"),
        F.col("dataset_fingerprint"),
        F.col("config_fingerprint"),
        F.col("model_version"),
        F.col("specs_fingerprint"),
    )
    return work.withColumn("token", token).withColumn(
        "run_id", batch_run_id(F.col("perturbation_type"), F.col("batch_key"), F.col("token"))
    )


def rows_fingerprint(rows: DataFrame, keys: list[str], text: str, name: str) -> DataFrame:
    """One fingerprint per group of rows, whatever the group's size.

    Row hashes are added up as exact decimals: the sum does not depend on the
    order of the rows and is formed by partial aggregates.
    """
    row = F.conv(F.left(F.sha2(F.col(text), 256), F.lit(15)), 16, 10).cast("decimal(38,0)")
    return (
        rows.groupBy(*keys)
        .agg(F.sum(row).cast("string").alias("_sum"), F.count(F.lit(1)).alias("_n"))
        .select(*keys, version_token(F.col("_sum"), F.col("_n")).alias(name))
    )


def with_comparison_token(work: DataFrame) -> DataFrame:
    """Token of a comparison; it covers the run and the baseline it is held against."""
    token = version_token(F.lit("comparison"), F.col("run_id"), F.col("baseline_fingerprint"))
    return work.withColumn("comparison_token", token)


def to_do(work: DataFrame, done: DataFrame, key: str = "token") -> DataFrame:
    return work.join(done.select(key), key, "left_anti")


def reusable(work: DataFrame, done: DataFrame, key: str = "token") -> DataFrame:
    return work.join(done.select(key), key, "left_semi")


def with_cache_hit(work: DataFrame, done: DataFrame, key: str = "token") -> DataFrame:
    seen = done.select(key, F.lit(True).alias("_seen")).distinct()
    return (
        work.join(seen, key, "left")
        .withColumn("cache_hit", F.coalesce("_seen", F.lit(False)))
        .drop("_seen")
    )


def cache_counts(work: DataFrame, *by: str) -> DataFrame:
    return work.groupBy(*by).agg(
        F.count_if("cache_hit").alias("cache_hits"), F.count_if(~F.col("cache_hit")).alias("cache_misses")
    )


def active_runs(runs: DataFrame) -> DataFrame:
    """Runs that were materialized: not skipped, with a prefix."""
    return runs.where(~F.col("skipped") & (F.coalesce("run_prefix", F.lit("")) != ""))


def last_run_per_type(runs: DataFrame) -> DataFrame:
    """Of several active runs of a type the last one, by ``position``, counts."""
    return latest_by(active_runs(runs), ["perturbation_type"], "position")


def merged_runs(*typed: DataFrame) -> DataFrame:
    """Typed runs as one run set: one row per active type."""
    whole = typed[0]
    for runs in typed[1:]:
        whole = whole.unionByName(runs)
    return last_run_per_type(whole)


def results_of_runs(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Each run with the result stored under the last segment of its prefix."""
    return runs.withColumn("run_id", last_segment(F.col("run_prefix"))).join(results, "run_id", "left")


def result_prefix(results_root: str, run_prefix):
    return F.concat(root_key(F.lit(results_root)), F.lit("/"), last_segment(run_prefix))


def new_keys(discovered: DataFrame, registered: DataFrame, key: str) -> DataFrame:
    """Discovered keys not registered yet.  Keys are only ever added."""
    return discovered.select(key).distinct().join(registered.select(key), key, "left_anti")


def run_versions(runs: DataFrame) -> DataFrame:
    """Data version of each run's output."""
    return runs.withColumn(
        "data_version",
        version_token(
            F.lit("perturbation_run"),
            F.col("dataset"),
            F.col("perturbation_type"),
            F.col("run_id"),
            F.col("dataset_fingerprint"),
            F.col("embeddings_fingerprint"),
            F.col("model_version"),
            F.col("model_name"),
        ),
    )


def aggregate_version(runs: DataFrame) -> DataFrame:
    """Version of a merged run set; it follows the versions of the runs inside."""
    member = F.concat_ws(":", "perturbation_type", "data_version")
    members = runs.select("model_name", member.alias("_member")).distinct()
    inside = rows_fingerprint(members, ["model_name"], "_member", "_inside")
    tag = F.lit("perturbation_run_aggregate")
    return inside.select(
        "model_name", version_token(tag, F.col("model_name"), F.col("_inside")).alias("data_version")
    )


def comparison_version(results: DataFrame, model_version: str, model_name: str) -> DataFrame:
    """Version of a set of comparison results, one per type, from their fingerprints."""
    return results.agg(
        list_token(
            F.lit("comparison_results"),
            F.collect_list("fingerprint"),
            F.lit(model_version),
            F.lit(model_name),
        ).alias("data_version"),
        F.count(F.lit(1)).alias("n_result_sets"),
    )
