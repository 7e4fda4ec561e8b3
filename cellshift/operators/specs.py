"""Experiment specifications: validity, genes, effect, ids and batches.

A spec table has ``position, perturbation_type, gene, genes, fold_change,
delta, target_donors, target_cell_types``.  Execution adds ``run_id`` and
``experiment_id``; the pair is the key of everything downstream.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellshift import model
from cellshift.functions.text import normalized_label, numbered_key
from cellshift.operators.numbering import with_ordinal

KEYS = ["run_id", "experiment_id"]


# --- types -------------------------------------------------------------------


def specs_of_type(specs: DataFrame, perturbation_type: str) -> DataFrame:
    return specs.where(normalized_label(F.col("perturbation_type")) == perturbation_type)


def unsupported_types(declared: DataFrame) -> DataFrame:
    """Declared types outside the supported ones; any row is a config error."""
    label = normalized_label(F.col("perturbation_type"))
    return (
        declared.select(label.alias("perturbation_type"))
        .where(~F.col("perturbation_type").isin(*model.PERTURBATION_TYPES))
        .distinct()
    )


def undeclared_specs(specs: DataFrame, declared: DataFrame) -> DataFrame:
    """Specs whose type the config does not declare, both sides normalized."""
    wanted = F.coalesce(normalized_label(F.col("perturbation_type")), F.lit(""))
    listed = declared.select(normalized_label(F.col("perturbation_type")).alias("_type"))
    return specs.withColumn("_type", wanted).join(listed, "_type", "left_anti").drop("_type")


# --- genes -------------------------------------------------------------------


def named_genes() -> Column:
    """``genes`` when it is a list, even an empty one; else the single ``gene``."""
    single = F.when(F.col("gene").isNotNull(), F.array("gene"))
    return F.array_distinct(F.coalesce(F.col("genes"), single))


def resolved_genes(specs: DataFrame, genes: DataFrame, *keep: str) -> DataFrame:
    """One row per spec and known gene it names; ``keep`` are the spec's columns."""
    named = specs.select(*keep, F.explode(named_genes()).alias("gene_symbol"))
    return named.join(genes.select("gene_symbol"), "gene_symbol", "left_semi").select(
        *keep, "gene_symbol"
    )


def invalid_specs(specs: DataFrame, genes: DataFrame) -> DataFrame:
    """Specs that cannot run, with the reason."""
    label = normalized_label(F.col("perturbation_type"))
    known = label.isin(*model.PERTURBATION_TYPES)
    unknown_type = specs.where(~F.coalesce(known, F.lit(False))).select(
        "position", F.lit("unknown perturbation_type").alias("reason")
    )
    hits = resolved_genes(specs, genes, "position").select("position")
    no_gene = (
        specs.where(known)
        .select("position")
        .join(hits, "position", "left_anti")
        .select("position", F.lit("no valid gene").alias("reason"))
    )
    return unknown_type.unionByName(no_gene)


def require_none(problems: DataFrame, what: str) -> None:
    """Stop the job and name the first problems, if there are any."""
    rows = problems.limit(10).collect()
    if rows:
        raise ValueError(f"{what}: {[row.asDict() for row in rows]}")


# --- effect ------------------------------------------------------------------


def _fold(default: float) -> Column:
    fold = F.coalesce(F.col("fold_change"), F.lit(default))
    # A fold change that is not above 1, or not a number, leaves values alone.
    return F.when((fold > 1.0) & ~F.isnan(fold), fold).otherwise(F.lit(1.0))


def with_effect(specs: DataFrame) -> DataFrame:
    """Every experiment is ``value * factor`` or, when ``shift`` is set, ``value + shift``."""
    label = normalized_label(F.col("perturbation_type"))
    knockout, over, activation = model.PERTURBATION_TYPES
    return specs.withColumn(
        "factor",
        F.when(label == knockout, F.lit(0.0))
        .when(label == over, _fold(model.DEFAULT_OVEREXPRESSION_FOLD))
        .when(label == activation, _fold(model.DEFAULT_ACTIVATION_FOLD)),
    ).withColumn("shift", F.when(label == activation, F.col("delta")))


# --- ids and batches ---------------------------------------------------------


def with_experiment_ids(specs: DataFrame) -> DataFrame:
    """``exp_0000`` by list position, for a run over the whole list."""
    return specs.withColumn("experiment_id", numbered_key("exp", F.col("position")))


def renumbered_experiment_ids(specs: DataFrame) -> DataFrame:
    """``exp_0000`` by list position, starting again in every ``run_id``."""
    return (
        with_ordinal(specs, ["run_id"], "position", "_ordinal")
        .withColumn("experiment_id", numbered_key("exp", F.col("_ordinal")))
        .drop("_ordinal")
    )


def with_batch(specs: DataFrame, batch_size: int) -> DataFrame:
    """Batch index and key of every spec, cut in list order."""
    index = F.floor(F.col("position") / F.lit(max(1, int(batch_size)))).cast("int")
    return specs.withColumn("batch_index", index).withColumn("batch_key", numbered_key("batch", index))


def batches(specs: DataFrame, batch_size: int) -> DataFrame:
    """One row per batch: members in list order and the types present.

    A batch holds at most ``batch_size`` specs, which bounds the lists.
    """
    member = F.struct("position", "perturbation_type", *_detail_columns(specs))
    return (
        with_batch(specs, batch_size)
        .groupBy("batch_index", "batch_key")
        .agg(
            F.array_sort(F.collect_list(member)).alias("perturbations"),
            F.array_sort(F.collect_set(normalized_label(F.col("perturbation_type")))).alias(
                "perturbation_types"
            ),
        )
    )


def _detail_columns(specs: DataFrame) -> list[str]:
    detail = [f.name for f in model.SPEC_ENTRY.fields if f.name != "perturbation_type"]
    return [name for name in detail if name in specs.columns]


def batch_by_key(wanted: DataFrame, all_batches: DataFrame) -> DataFrame:
    """Wanted batch keys with their batch; null columns where there is none."""
    return wanted.join(all_batches, "batch_key", "left")


def batch_summary(specs: DataFrame, batch_size: int) -> DataFrame:
    """How many batches there are, their largest index and the size in force."""
    return (
        with_batch(specs, batch_size)
        .agg(
            F.countDistinct("batch_index").alias("n_batches"),
            F.max("batch_index").alias("last_batch_index"),
        )
        .withColumn("batch_size", F.lit(max(1, int(batch_size))))
    )


def partition_grid(batch_keys: DataFrame) -> DataFrame:
    """Every supported type with every batch key."""
    types = F.array(*[F.lit(t) for t in model.PERTURBATION_TYPES])
    return batch_keys.select(F.explode(types).alias("perturbation_type"), "batch_key")


def partition_status(wanted: DataFrame, specs: DataFrame, batch_size: int) -> DataFrame:
    """What a (type, batch) partition will do: run, or why it is skipped."""
    members = (
        with_batch(specs, batch_size)
        .groupBy("batch_key", normalized_label(F.col("perturbation_type")).alias("perturbation_type"))
        .agg(F.count(F.lit(1)).alias("n_specs"))
    )
    present = members.select("batch_key", F.lit(True).alias("_present")).distinct()
    n = F.coalesce(F.col("n_specs"), F.lit(0))
    return (
        wanted.join(present, "batch_key", "left")
        .join(members, ["batch_key", "perturbation_type"], "left")
        .select(
            "perturbation_type",
            "batch_key",
            n.alias("n_specs"),
            F.when(F.col("_present").isNull(), F.lit("skipped_missing_batch"))
            .when(n == 0, F.lit("skipped_no_matching_partition_perturbation_type"))
            .otherwise(F.lit("run"))
            .alias("status"),
        )
    )


def comparison_status(upstream: DataFrame) -> DataFrame:
    """A comparison partition is skipped whenever its run was."""
    skipped = F.col("status").startswith("skipped")
    return upstream.withColumn(
        "comparison_status", F.when(skipped, F.lit("skipped_upstream_batch")).otherwise(F.lit("run"))
    )


def typed_runs(specs: DataFrame) -> DataFrame:
    """Each supported type with its number of specs; a type without any is skipped."""
    spark = specs.sparkSession
    types = spark.createDataFrame([(t,) for t in model.PERTURBATION_TYPES], "perturbation_type string")
    counts = specs.groupBy(
        normalized_label(F.col("perturbation_type")).alias("perturbation_type")
    ).agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    return types.join(counts, "perturbation_type", "left").select(
        "perturbation_type",
        n.alias("n_experiments"),
        (n == 0).alias("skipped"),
        F.when(n == 0, F.lit("skipped_no_matching_specs")).otherwise(F.lit("run")).alias("status"),
    )
