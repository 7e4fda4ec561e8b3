"""The jobs: run experiments, compare them, hand the results on, all incremental.

Every job works on all of its runs in one plan; ``run_id`` is a column.  Runs
are written in an order that leaves their header row for last, so a header marks
a complete run and a lost job is simply run again: partitions are replaced as a
whole.
"""

import functools
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellshift import model
from cellshift.functions.text import normalized_label
from cellshift.operators import compare, embed, gold, lineage, specs as sp
from cellshift.operators.resting import resting_summary
from cellshift.operators.specs import KEYS
from cellshift.plans.layout import COMPUTED, choose_baseline, is_stored, of_runs, place, table_or_empty
from cellshift.session import in_job_folder, opened, stored
from cellshift.sources import tables

_RUNS = "run_id string, token string, n_experiments bigint, model_name string"
_COMPARED = "run_id string, comparison_token string, n_experiments bigint, baseline_source string"


@dataclass(frozen=True)
class Dataset:
    """The three tables, a name and a fingerprint that changes with the content."""

    name: str
    fingerprint: str
    cells: DataFrame
    genes: DataFrame
    expression: DataFrame


def open_dataset(spark: SparkSession, path: str, fingerprint: str, schemas=None) -> Dataset:
    """An existing dataset; reading one that is not there is an error."""
    return Dataset(path, fingerprint, *tables.read_dataset(spark, path, schemas))


# --- run ---------------------------------------------------------------------


def _vector_schema(dataset: Dataset) -> str:
    kind = dataset.cells.schema["cell_id"].dataType.simpleString()
    return f"cell_id {kind}, embedding array<float>"


Chosen = str | embed.UserModel | None  # a built-in model by name, or the user's own


def baseline(
    spark: SparkSession, root: str, dataset: Dataset, dim: int, model_name: Chosen
) -> DataFrame:
    """The baseline vectors of a dataset and model, computed once and stored."""
    key = _baseline_key(dataset, dim, model_name)
    path, marks = _baseline_path(root, dataset, dim, model_name), place(root, "silver/baseline_done")
    if not _marked(spark, marks, key):
        vectors = embed.baseline_of(dataset.cells, dataset.expression, dim, model_name)
        single = F.col("vector").cast("array<float>").alias("embedding")
        vectors.select("cell_id", single).write.mode("overwrite").parquet(path)
        spark.createDataFrame([(key,)], "key string").write.mode("append").parquet(marks)
    return spark.read.schema(_vector_schema(dataset)).parquet(path)


def _baseline_key(dataset: Dataset, dim: int, model_name: Chosen) -> str:
    return "-".join([*embed.identity(model_name), str(dim), dataset.fingerprint])


def _baseline_path(root: str, dataset: Dataset, dim: int, model_name: Chosen) -> str:
    return place(root, "silver/baseline", _baseline_key(dataset, dim, model_name))


def _marked(spark: SparkSession, path: str, key: str) -> bool:
    return not table_or_empty(spark, path, "key string").where(F.col("key") == key).isEmpty()


def _as_vector(df: DataFrame) -> DataFrame:
    return df.select("cell_id", F.col("embedding").cast("array<double>").alias("vector"))


@in_job_folder
def run_experiments(
    spark: SparkSession,
    root: str,
    dataset: Dataset,
    specs: DataFrame,
    runs: DataFrame,
    dim: int = model.EMBEDDING_DIM,
    model_name: Chosen = None,
    declared: DataFrame | None = None,
    as_entries: bool = False,
) -> None:
    """Run the experiments of all given runs and store them.

    ``specs`` carries ``run_id``; ``runs`` has ``run_id, token`` and, where each run
    declares a type of its own, ``perturbation_type``.  Everything is checked before the
    first write.  Vectors are stored for the cells an
    experiment changes; every other cell keeps its baseline vector.  The records
    say how many those are, so that a lost vector is not taken for an unchanged cell.

    ``as_entries`` keeps a changed cell's vector as the entries that move its baseline vector
    (``es``) in place of ``embedding``: the same vectors, made where they are compared or
    read (``handed_on``, ``embeddings_of``).  A user's model has no such entries.
    """
    if as_entries and isinstance(model_name, embed.UserModel):
        raise ValueError("vectors of a user's model cannot be kept as entries")
    if declared is not None:
        sp.require_none(sp.unsupported_types(declared), "unsupported perturbation types")
        sp.require_none(sp.undeclared_specs(specs, declared).select("position"), "undeclared types")
    sp.require_none(sp.invalid_specs(specs, dataset.genes), "experiments that cannot run")
    numbered = stored(sp.renumbered_experiment_ids(specs), "specs")
    base = _as_vector(baseline(spark, root, dataset, dim, model_name))
    tables_of = (numbered, dataset.cells, dataset.genes, dataset.expression, base)
    if as_entries:
        vectors = embed.perturbed_entries(*tables_of, model_name).withColumn("embedding", F.lit(None).cast("array<float>"))
    else:
        changed = embed.changed_of(*tables_of, dim, model_name)
        vectors = changed.select(*KEYS, "cell_id", F.lit(None).cast(embed.ENTRIES).alias("es"), F.col("after").alias("embedding"))
    path = place(root, model.EMBEDDINGS_AT)
    tables.write_embeddings(path, vectors, tables.groups_of(numbered))
    written = of_runs(table_or_empty(spark, path, "run_id string, experiment_id string"), runs)
    manifest = gold.manifest_records(numbered, dataset.cells)
    tables.write_by_run(place(root, "silver/experiments"), gold.with_changed_counts(manifest, written))
    if declared is None and "perturbation_type" in runs.columns:
        declared = runs.select("run_id", "perturbation_type")
    headers = gold.run_manifest(numbered, dataset.cells, dataset.genes, declared).join(
        runs.select("run_id", "token"), "run_id"
    )
    name, version = embed.identity(model_name)
    tables.write_by_run(
        place(root, "silver/runs"),
        headers.withColumn("model_name", F.lit(name))
        .withColumn("model_version", F.lit(version))
        .withColumn("dataset", F.lit(dataset.name))
        .withColumn("baseline_path", F.lit(_baseline_path(root, dataset, dim, model_name)))
        .withColumn("as_entries", F.lit(as_entries))
        .withColumn("run_created_at_utc", _now()),
    )


def _now() -> Column:
    return F.lit(datetime.now(UTC).isoformat())


def manifest_of(spark: SparkSession, root: str, runs: DataFrame) -> DataFrame:
    """Stored records of the given runs."""
    path = place(root, "silver/experiments")
    return of_runs(opened(spark, path), runs)


def embeddings_of(
    experiments: list[tuple[str, str]], changed: DataFrame, base: DataFrame
) -> DataFrame:
    """Vectors of every cell for chosen experiments: changed ones, baseline for the rest.

    ``base`` is the baseline of the runs: vectors kept as entries are made from it.
    """
    pairs = F.array(
        *[F.struct(F.lit(r).alias("run_id"), F.lit(e).alias("experiment_id")) for r, e in experiments]
    )
    chosen = F.struct(*KEYS).isin(*[F.struct(F.lit(r), F.lit(e)) for r, e in experiments])
    es = [c for c in changed.columns if c == "es"]
    mine = changed.where(chosen).select(*KEYS, "cell_id", F.col("embedding").alias("_changed"), *es)
    made = [embed.made_of("embedding", c) for c in es]
    return (
        base.select(F.explode(pairs).alias("x"), "cell_id", "embedding")
        .select("x.*", "cell_id", "embedding")
        .join(mine, [*KEYS, "cell_id"], "left")
        .select(*KEYS, "cell_id", F.coalesce("_changed", *made, "embedding").alias("embedding"))
    )


def _whole(changed: DataFrame, baselines: DataFrame) -> DataFrame:
    """Stored rows with every ``embedding`` in full.

    ``baselines`` (run_id, source) names the baseline of each run, from which vectors kept as
    entries are made; one that is not there stops the job.
    """
    spark = changed.sparkSession
    keys = [*KEYS, "cell_id"]
    out = changed.where("es IS NULL")
    kept = changed.where("es IS NOT NULL").drop("embedding").join(baselines, "run_id", "left")
    vector = f"cell_id {changed.schema['cell_id'].dataType.simpleString()}, embedding array<float>"
    before = spark.createDataFrame([], f"{vector}, source string")
    # as many as there are baselines
    for row in baselines.select("source").distinct().collect():
        before = before.unionByName(table_or_empty(spark, row.source, vector).withColumn("source", F.lit(row.source)))
    lost = F.raise_error(F.lit("no baseline vector to make a stored vector from")).cast("array<float>")
    made = F.when(F.col("embedding").isNull(), lost).otherwise(embed.made_of("embedding", "es"))
    found = kept.join(before, ["source", "cell_id"], "left").withColumn("embedding", made).drop("source")
    none = F.lit(None).cast(embed.ENTRIES).alias("es")
    return out.unionByName(found).select(*keys, "embedding", none)


def typed_work(dataset: Dataset, specs: DataFrame, config_fingerprint: str, model_name: Chosen) -> DataFrame:
    """One row per type, with token and run id; a type without experiments is skipped."""
    name, version = embed.identity(model_name)
    rows = (
        sp.typed_runs(specs)
        .withColumn("dataset", F.lit(dataset.name))
        .withColumn("dataset_fingerprint", F.lit(dataset.fingerprint))
        .withColumn("config_fingerprint", F.lit(config_fingerprint))
        .withColumn("model_name", F.lit(name))
        .withColumn("model_version", F.lit(version))
    )
    return lineage.with_typed_token(rows)


def run_types(
    spark: SparkSession,
    root: str,
    dataset: Dataset,
    specs: DataFrame,
    config_fingerprint: str,
    dim: int = model.EMBEDDING_DIM,
    model_name: Chosen = model.MODEL_NAMES[0],
    memoize: bool = True,
    as_entries: bool = False,
) -> DataFrame:
    """Run each type as its own run, reusing runs done before; returns one row per type."""
    work = typed_work(dataset, specs, config_fingerprint, model_name)
    members = specs.withColumn("perturbation_label", normalized_label(F.col("perturbation_type")))
    keyed = members.join(
        work.where(~F.col("skipped")).select(F.col("perturbation_type").alias("perturbation_label"), "run_id"),
        "perturbation_label",
    ).drop("perturbation_label")
    return _run_work(spark, root, dataset, work, keyed, dim, model_name, memoize, as_entries)


def batch_work(
    dataset: Dataset, specs: DataFrame, wanted: DataFrame, batch_size: int, config_fingerprint: str, model_name: Chosen
) -> DataFrame:
    """One row per wanted (type, batch) with its status, token and run id."""
    text = F.to_json(F.struct("position", *[f.name for f in model.SPEC_ENTRY.fields]))
    members = sp.with_batch(specs, batch_size).select(
        "batch_key",
        normalized_label(F.col("perturbation_type")).alias("perturbation_type"),
        text.alias("text"),
    )
    keys = ["batch_key", "perturbation_type"]
    prints = lineage.rows_fingerprint(members, keys, "text", "specs_fingerprint")
    name, version = embed.identity(model_name)
    rows = (
        sp.partition_status(wanted, specs, batch_size)
        .join(prints, keys, "left")
        .withColumn("skipped", F.col("status").startswith("skipped"))
        .withColumn("dataset_fingerprint", F.lit(dataset.fingerprint))
        .withColumn("config_fingerprint", F.lit(config_fingerprint))
        .withColumn("model_name", F.lit(name))
        .withColumn("model_version", F.lit(version))
    )
    return lineage.with_batch_token(rows)


def run_batches(
    spark: SparkSession,
    root: str,
    dataset: Dataset,
    specs: DataFrame,
    wanted: DataFrame,
    batch_size: int,
    config_fingerprint: str,
    dim: int = model.EMBEDDING_DIM,
    model_name: Chosen = model.MODEL_NAMES[0],
    memoize: bool = True,
    as_entries: bool = False,
) -> DataFrame:
    """Run the wanted (type, batch) partitions; returns one row per partition."""
    work = batch_work(dataset, specs, wanted, batch_size, config_fingerprint, model_name)
    label = normalized_label(F.col("perturbation_type"))
    members = sp.with_batch(specs, batch_size).withColumn("perturbation_label", label)
    keyed = members.join(
        work.where(~F.col("skipped")).select(
            "batch_key", F.col("perturbation_type").alias("perturbation_label"), "run_id"
        ),
        ["batch_key", "perturbation_label"],
    ).drop("batch_key", "batch_index", "perturbation_label")
    return _run_work(spark, root, dataset, work, keyed, dim, model_name, memoize, as_entries)


def _run_work(spark, root, dataset, work, keyed, dim, model_name, memoize, as_entries) -> DataFrame:
    work = stored(work, "work")
    done = table_or_empty(spark, place(root, "silver/runs"), _RUNS)
    if not memoize:
        done = done.limit(0)
    status = stored(lineage.with_cache_hit(work, done), "status")
    active = status.where(~F.col("skipped"))
    to_do = active.where(~F.col("cache_hit"))
    if not to_do.isEmpty():
        specs = keyed.join(to_do.select("run_id"), "run_id", "left_semi")
        run_experiments(spark, root, dataset, specs, to_do, dim, model_name, as_entries=as_entries)
    if not active.isEmpty():
        export_experiments(spark, root, active)
    return status


# --- compare -----------------------------------------------------------------


@in_job_folder
def compare_runs(
    spark: SparkSession,
    root: str,
    dataset: Dataset,
    runs: DataFrame,
    dim: int = model.EMBEDDING_DIM,
    model_name: Chosen = None,
    baseline_path: str | None = None,
) -> str:
    """Compare stored runs with the baseline and store distances and summaries.

    ``runs`` has ``run_id, comparison_token``.  Distances are stored for changed
    cells; every other cell of a run rests where it is without any experiment.
    Returns the baseline source used.
    """
    stored_runs = _require_headers(spark, place(root, "silver/runs"), runs, "runs without a manifest")
    own = baseline(spark, root, dataset, dim, model_name)
    base, source = choose_baseline(spark, baseline_path, own.schema, own)
    wrong = compare.baseline_width_problems(base, dim).where(~F.col("passed"))
    sp.require_none(wrong, f"baseline vectors must be {dim} wide")
    manifest = stored(manifest_of(spark, root, runs), "manifest")
    schema = f"run_id string, experiment_id string, {_vector_schema(dataset)}, es {embed.ENTRIES}"
    changed = of_runs(table_or_empty(spark, place(root, model.EMBEDDINGS_AT), schema), runs)
    sp.require_none(
        compare.lost_vectors(manifest, changed, dataset.cells), "stored vectors are not those of the run"
    )
    path, own_path = place(root, model.DISTANCES_AT), _baseline_path(root, dataset, dim, model_name)
    kept, whole = _by_keeping(changed, stored_runs, own_path)
    if whole is not None:
        whole = whole.join(
            own.select("cell_id", F.col("embedding").cast("array<double>").alias("before")), "cell_id"
        ).select(*KEYS, "cell_id", "before", compare.of_width("embedding", dim).alias("after"))
    if source == COMPUTED:
        parts = [
            None if whole is None else compare.changed_distances(whole, dataset.cells, manifest),
            None if kept is None else compare.kept_distances(kept, dataset.cells, manifest, own),
        ]
        dist = _union(parts)
        tables.write_by_experiment(path, dist, tables.groups_of(manifest))
        dist = _read_distances(spark, path, dist, runs)
        summaries = compare.changed_summary(dist, _as_vector(own), dataset.cells, manifest)
    else:
        named = own.select(F.lit("").alias("run_id"), F.lit("").alias("experiment_id"), "*")
        sp.require_none(
            compare.shape_problems(named, base), "baseline cells differ from the dataset's"
        )
        rest = compare.resting_distances(_as_vector(own), _as_vector(base), dataset.cells)
        rest = stored(rest, "resting")
        parts = [
            None if whole is None else compare.changed_distances_to(whole, _as_vector(base), rest, manifest),
            None if kept is None else compare.kept_distances(kept, rest, manifest, own, base),
        ]
        dist = _union(parts)
        tables.write_by_experiment(path, dist, tables.groups_of(manifest))
        dist = _read_distances(spark, path, dist, runs)
        summaries = resting_summary(dist, rest, manifest)
    records = gold.comparison_records(manifest, summaries)
    tables.write_by_run(place(root, "silver/summaries"), records)
    at = source if source != COMPUTED else own_path
    headers = (
        gold.comparison_manifest(records, stored_runs, source)
        .join(runs.select("run_id", "comparison_token"), "run_id")
        .withColumn("baseline_path", F.lit(at))
        .withColumn("source_run_path", gold.run_folder("silver/runs"))
        .withColumn("dataset", F.lit(dataset.name))
        .withColumn("computed_at_utc", _now())
    )
    tables.write_by_run(place(root, "silver/comparisons"), headers)
    return source


def _by_keeping(changed: DataFrame, headers: DataFrame, own_path: str) -> tuple[DataFrame | None, DataFrame | None]:
    """The stored rows that are entries moving the baseline at ``own_path``, and those that are whole vectors.

    Vectors kept as entries of another baseline are made in full.
    """
    if "as_entries" not in headers.columns or headers.where("as_entries").isEmpty():
        return None, changed
    mine, source = headers.where("as_entries"), F.col("baseline_path").alias("source")
    if not mine.where(F.col("baseline_path") != own_path).isEmpty():
        return None, _whole(changed, mine.select("run_id", source))
    others = headers.where("NOT as_entries")
    if others.isEmpty():
        return changed, None
    return of_runs(changed, mine), of_runs(changed, others)


def _union(parts: list[DataFrame | None]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def _read_distances(spark: SparkSession, path: str, like: DataFrame, runs: DataFrame) -> DataFrame:
    return of_runs(table_or_empty(spark, path, like.schema), runs)


def compare_incrementally(
    spark: SparkSession,
    root: str,
    dataset: Dataset,
    upstream: DataFrame,
    dim: int = model.EMBEDDING_DIM,
    model_name: Chosen = None,
    baseline_path: str | None = None,
    baseline_fingerprint: str = "",
    memoize: bool = True,
) -> DataFrame:
    """Compare upstream runs that have no result yet; skipped runs stay skipped.

    ``upstream`` is what ``run_types`` or ``run_batches`` returned.
    """
    print_ = F.lit(baseline_fingerprint or dataset.fingerprint)
    work = lineage.with_comparison_token(
        sp.comparison_status(upstream).drop("cache_hit").withColumn("baseline_fingerprint", print_)
    )
    done = table_or_empty(spark, place(root, "silver/comparisons"), _COMPARED)
    if not memoize:
        done = done.limit(0)
    status = stored(lineage.with_cache_hit(work, done, "comparison_token"), "comparisons")
    active = status.where(~F.col("skipped"))
    to_do = active.where(~F.col("cache_hit"))
    if not to_do.isEmpty():
        compare_runs(spark, root, dataset, to_do, dim, model_name, baseline_path)
    if not active.isEmpty():
        export_comparisons(spark, root, active)
    return status


# --- hand on -----------------------------------------------------------------

# What a run hands on is named, not copied: a row per artifact says which table holds it.  A
# run's rows are replaced in one step, after its documents, and carry the token they were
# made for; a run whose rows carry its token has been handed on already.
_POINTER = "run_id string, artifact string, source string, token string"
_EXPERIMENTS, _COMPARISONS = "gold/compute/experiment_pointers", "gold/compute/comparison_pointers"
#: Where the rows naming each artifact are kept, and whether the artifact has rows by run.
_ARTIFACTS = {
    "embeddings": (_EXPERIMENTS, True),
    "before": (_EXPERIMENTS, False),  # the baseline of a run, which its entries move
    "distances": (_COMPARISONS, True),
    "baseline": (_COMPARISONS, False),
}


def _write_run_documents(path: str, documents: DataFrame) -> None:
    (
        tables.spread_by_run(documents, F.col("part"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("run_id")
        .json(path)
    )


def _require_headers(spark: SparkSession, path: str, runs: DataFrame, what: str) -> DataFrame:
    headers = table_or_empty(spark, path, "run_id string")
    sp.require_none(runs.select("run_id").join(headers, "run_id", "left_anti"), what)
    return of_runs(opened(spark, path), runs)


def _not_handed_on(spark: SparkSession, root: str, pointers: str, headers: DataFrame, token: str) -> DataFrame:
    """The headers of runs whose pointers are absent or made for another token."""
    done = table_or_empty(spark, place(root, pointers), _POINTER).select("run_id", F.col("token").alias(token))
    return headers.join(done.distinct(), ["run_id", token], "left_anti")


def _write_pointers(root: str, table: str, headers: DataFrame, token: str, sources: dict[str, Column]) -> None:
    named = F.array(*[F.struct(F.lit(a).alias("artifact"), s.alias("source")) for a, s in sources.items()])
    rows = headers.select("run_id", F.inline(named), F.col(token).alias("token"))
    tables.write_by_run(place(root, table), rows)


def handed_on(
    spark: SparkSession, root: str, artifact: str, schema: str | T.StructType, runs: DataFrame | None = None
) -> DataFrame:
    """The rows of an artifact of the given runs (or of all), read where the pointers say.

    ``embeddings`` and ``distances`` have rows by run; a ``baseline`` may serve many runs and
    has its rows once, with the table they came from as ``source``.  Vectors kept as entries
    come in full where ``embedding`` is asked for.
    """
    table, by_run = _ARTIFACTS[artifact]
    pointers = table_or_empty(spark, place(root, table), _POINTER).where(F.col("artifact") == artifact)
    if runs is not None:
        pointers = of_runs(pointers, runs)
    pointers = stored(pointers, "pointers")
    out = spark.createDataFrame([], schema)
    out = out if by_run else out.withColumn("source", F.lit("").cast("string"))
    # as many as there are tables: one, or one a baseline
    for row in pointers.select("source").distinct().collect():
        found = table_or_empty(spark, row.source, schema)
        if by_run:
            runs_there = pointers.where(F.col("source") == row.source)
            if artifact == "embeddings" and "embedding" in found.columns:
                found = _vectors_at(spark, root, row.source, found.schema, runs_there)
            else:
                found = of_runs(found, runs_there)
        else:
            found = found.withColumn("source", F.lit(row.source))
        out = out.unionByName(found)
    return out


def _vectors_at(spark: SparkSession, root: str, path: str, schema: T.StructType, runs: DataFrame) -> DataFrame:
    """The stored vectors of runs in full, with the columns of ``schema``."""
    cell = opened(spark, path).schema["cell_id"].dataType.simpleString()
    like = f"run_id string, experiment_id string, cell_id {cell}, embedding array<float>, es {embed.ENTRIES}"
    pointers = table_or_empty(spark, place(root, _EXPERIMENTS), _POINTER).where("artifact = 'before'")
    found = _whole(of_runs(table_or_empty(spark, path, like), runs), of_runs(pointers, runs).select("run_id", "source"))
    return found.select(*[F.col(f.name).cast(f.dataType) for f in schema])


@in_job_folder
def export_experiments(spark: SparkSession, root: str, runs: DataFrame) -> None:
    """Readers' records, the experiment index and the pointers of complete runs not handed on yet."""
    headers = _require_headers(spark, place(root, "silver/runs"), runs, "runs without a manifest")
    headers = stored(_not_handed_on(spark, root, _EXPERIMENTS, headers, "token"), "headers")
    if headers.isEmpty():
        return
    metadata = headers.select(
        "run_id", "n_cells", "n_genes", "perturbation_types_defined", "n_experiments", "run_created_at_utc"
    )
    manifest = manifest_of(spark, root, headers)
    records = tables.run_documents(gold.ui_records(manifest), "position", metadata)
    _write_run_documents(place(root, "gold/ui/perturbation_records"), records)
    index = tables.run_documents(manifest, "position", metadata)
    _write_run_documents(place(root, "gold/compute/experiment_index"), index)
    sources = {"embeddings": F.lit(place(root, model.EMBEDDINGS_AT))}
    if "baseline_path" in headers.columns:
        sources["before"] = F.col("baseline_path")
    _write_pointers(root, _EXPERIMENTS, headers, "token", sources)


@in_job_folder
def export_comparisons(spark: SparkSession, root: str, runs: DataFrame) -> None:
    """Readers' cards, the comparison index and the pointers of complete comparisons not handed on yet."""
    headers = _require_headers(
        spark, place(root, "silver/comparisons"), runs, "runs without a comparison manifest"
    )
    headers = stored(_not_handed_on(spark, root, _COMPARISONS, headers, "comparison_token"), "headers")
    if headers.isEmpty():
        return
    records = of_runs(opened(spark, place(root, "silver/summaries")), headers)
    cards = tables.run_documents(gold.comparison_cards(records), "position")
    _write_run_documents(place(root, "gold/ui/comparison_cards"), cards)
    index = tables.run_documents(records, "position", headers)
    _write_run_documents(place(root, "gold/compute/comparison_index"), index)
    sources = {"distances": F.lit(place(root, model.DISTANCES_AT)), "baseline": F.col("baseline_path")}
    _write_pointers(root, _COMPARISONS, headers, "comparison_token", sources)


def distance_bundle(spark: SparkSession, root: str, runs: DataFrame | None = None) -> DataFrame:
    """The distances that the summaries list, in single precision, read through the pointers."""
    records = opened(spark, place(root, "silver/summaries"))
    like = opened(spark, place(root, model.DISTANCES_AT)).select(*KEYS, "cell_id", "distance").schema
    return gold.distance_bundle(records, handed_on(spark, root, "distances", like, runs))
