"""Manifests and the records handed to readers: selections and nestings."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellshift import model
from cellshift.functions.text import compact_tag, slug
from cellshift.operators.cohorts import involved_values, target_cell_counts
from cellshift.operators.specs import KEYS


def pick(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The given columns; a column the table lacks comes back null."""
    columns = [F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]
    return df.select(*keep, *columns)


def run_folder(table: str) -> Column:
    """The folder of a run's rows in a stored table; rows of one experiment carry its id."""
    return F.concat(F.lit(f"{table}/run_id="), F.col("run_id"))


def manifest_records(specs: DataFrame, cells: DataFrame) -> DataFrame:
    """One record per experiment.  Lists a spec leaves out are empty here."""
    none = F.array().cast("array<string>")
    involved = involved_values(cells).select(
        F.struct("involved_donors", "involved_cell_types").alias("involved")
    )
    return (
        specs.join(target_cell_counts(specs, cells), KEYS)
        .withColumn("_involved", involved.scalar())
        .select(
            "run_id",
            "position",
            "experiment_id",
            "perturbation_type",
            "gene",
            "genes",
            "_involved.*",
            F.coalesce("target_donors", none).alias("target_donors"),
            F.coalesce("target_cell_types", none).alias("target_cell_types"),
            "n_target_cells",
            run_folder(model.EMBEDDINGS_AT).alias("output_embeddings"),
        )
    )


def with_changed_counts(manifest: DataFrame, vectors: DataFrame) -> DataFrame:
    """Add ``n_changed``, the number of cells each experiment changes; none is 0."""
    counted = vectors.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_changed"))
    return manifest.join(counted, KEYS, "left").fillna(0, ["n_changed"])


def experiment_metadata(specs: DataFrame, cells: DataFrame, dim: int) -> DataFrame:
    """The per-experiment record: the spec as it was applied, shape and cohort."""
    spec_fields = [f.name for f in model.SPEC_ENTRY.fields if f.name in specs.columns]
    n_cells = cells.agg(F.count(F.lit(1)).alias("n")).scalar()
    applied = specs.select(*KEYS, F.struct(*spec_fields).alias("perturbation_spec"))
    return (
        manifest_records(specs, cells)
        .join(applied, KEYS)
        .select(
            *KEYS,
            "perturbation_spec",
            F.array(n_cells, F.lit(dim).cast("bigint")).alias("embedding_shape"),
            "involved_donors",
            "involved_cell_types",
            "target_donors",
            "target_cell_types",
            "n_target_cells",
        )
    )


def run_manifest(
    specs: DataFrame, cells: DataFrame, genes: DataFrame, declared: DataFrame | None = None
) -> DataFrame:
    """One row per run: input shape, declared types and number of experiments.

    ``declared`` holds ``perturbation_type``, and ``run_id`` where runs declare each their
    own; without it a run declares the types of its experiments.
    """
    from cellshift.operators.profile import dataset_shape

    shape = dataset_shape(cells, genes).select(F.struct("n_cells", "n_genes").alias("shape"))
    types = F.array_sort(F.collect_set("perturbation_type")).alias("perturbation_types_defined")
    counted = specs.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_experiments"))
    if declared is not None and "run_id" not in declared.columns:
        counted = counted.withColumn("perturbation_types_defined", declared.agg(types).scalar())
    else:
        named = specs if declared is None else declared
        counted = counted.join(named.groupBy("run_id").agg(types), "run_id", "left")
    return (
        counted.withColumn("_shape", shape.scalar())
        .select("run_id", "_shape.*", "perturbation_types_defined", "n_experiments")
    )


def ui_records(manifest: DataFrame) -> DataFrame:
    return pick(manifest, (*model.CONTEXT_FIELDS, "n_target_cells"), ["run_id", "position"])


def comparison_cards(summaries: DataFrame) -> DataFrame:
    fields = (*model.CONTEXT_FIELDS, "mean_distance", "mean_distance_target_subset", "n_target_cells")
    return pick(summaries, fields, ["run_id", "position"])


def comparison_records(manifest: DataFrame, summaries: DataFrame) -> DataFrame:
    """Context of every experiment with its distance summary.

    The number of target cells is the comparison's own, where an empty target
    list means every cell.
    """
    context = manifest.select("run_id", "position", *model.CONTEXT_FIELDS)
    return (
        context.join(summaries, KEYS)
        .withColumn("metric", F.lit("cosine_distance"))
        .withColumn("distance_file", run_folder(model.DISTANCES_AT))
    )


def comparison_manifest(records: DataFrame, manifest: DataFrame, baseline_source: str) -> DataFrame:
    """One row per compared run."""
    types = manifest.select("run_id", "perturbation_types_defined")
    return (
        records.groupBy("run_id")
        .agg(F.count(F.lit(1)).alias("n_experiments"))
        .join(types, "run_id")
        .withColumn("metric", F.lit("cosine_distance"))
        .withColumn("baseline_source", F.lit(baseline_source))
    )


def distance_bundle(records: DataFrame, distances: DataFrame) -> DataFrame:
    """Stored distances of the experiments a manifest lists; absent ones are skipped."""
    listed = records.where(F.coalesce("distance_file", F.lit("")) != "").select(*KEYS)
    return distances.join(listed, KEYS, "left_semi").select(
        *KEYS, "cell_id", F.col("distance").cast("float").alias("distance")
    )


def lineage_dimensions(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sorted distinct types, target cell types and target donors.

    Without ``by`` this is the union over all result sets.
    """
    def values(name: str, items):
        return F.transform(items, lambda v: F.struct(F.lit(name).alias("name"), v.cast("string").alias("v")))

    none = F.array().cast("array<string>")
    names = ("perturbation_types", "target_cell_types", "target_donors")
    found = F.concat(
        values(names[0], F.array("perturbation_type")),
        values(names[1], F.coalesce("target_cell_types", none)),
        values(names[2], F.coalesce("target_donors", none)),
    )
    # Distinct before gathering: a list holds each value once, however many rows carry it.
    distinct = records.select(*by, F.explode(found).alias("d")).select(*by, "d.*").distinct()
    return distinct.groupBy(*by).agg(
        *[
            F.array_sort(F.collect_list(F.when(F.col("name") == name, F.col("v")))).alias(name)
            for name in names
        ]
    )


def group_tags(df: DataFrame, keys: Sequence[str], label: Column) -> DataFrame:
    """``keys`` and ``tag``, the compact tag of each group's labels.

    A tag shows three slugs and whether there are more, so four distinct ones a group are
    all that is ever brought together.
    """
    keys = list(keys)
    slugs = df.select(*keys, F.when(label.rlike(r"(?U)\S"), slug(label)).alias("_slug")).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_slug")))
    first = slugs.withColumn("_place", place).where(F.col("_place") <= 4)
    return first.groupBy(*keys).agg(compact_tag(F.collect_list("_slug")).alias("tag"))
