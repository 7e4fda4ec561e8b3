"""Cell vectors: the built-in projection and user models.

The built-in model is a fixed projection, ``sum over genes of log1p(value) *
w(gene, d)``.  The weight needs the gene's name only, so no gene table is
joined, and the model is linear in ``log1p(value)``: a perturbed vector is the
baseline vector plus the projected change of the touched entries.  A user's model is
any function of whole cells (``UserModel``); it sees the perturbed row of every cell an
experiment changes.
"""

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellshift import model
from cellshift.functions.vectors import kept_distances, moved_by, moved_distance, moved_single, weighted_sum
from cellshift.operators import perturb
from cellshift.operators.specs import KEYS
from cellshift.session import stored

# Ship this module's functions with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Weights repeat after this prime, above which a gene's code seldom lies; positions are this far apart.
MODULUS, STEP = 16_777_213, 6_700_417


def model_table(spark) -> DataFrame:
    rows = [
        (name, model.MODEL_VERSION, model.EMBEDDING_DIM, model.EMBEDDING_DTYPE)
        for name in model.MODEL_NAMES
    ]
    return spark.createDataFrame(
        rows, "model_name string, model_version string, embedding_dim int, embedding_dtype string"
    )


def unknown_models(runs: DataFrame) -> DataFrame:
    """Runs that name a model that does not exist; a null name means the first model."""
    return with_default_model(runs).join(model_table(runs.sparkSession), "model_name", "left_anti")


def with_default_model(runs: DataFrame) -> DataFrame:
    return runs.withColumn(
        "model_name", F.coalesce(F.col("model_name"), F.lit(model.MODEL_NAMES[0]))
    )


def stamped(runs: DataFrame) -> DataFrame:
    """Runs with the identity of their model."""
    return with_default_model(runs).join(model_table(runs.sparkSession), "model_name")


def model_seed(model_name: str | None) -> int:
    name = model_name or model.MODEL_NAMES[0]
    if name not in model.MODEL_NAMES:
        raise ValueError(f"unsupported model {name!r}; allowed: {sorted(model.MODEL_NAMES)}")
    return 331 * model.MODEL_NAMES.index(name)


def gene_code(gene: Column) -> Column:
    """A number below 2**24 from the gene's name."""
    return F.conv(F.left(F.md5(gene.cast("string")), F.lit(6)), 16, 10).cast("bigint")


def baseline_embeddings(
    cells: DataFrame, expression: DataFrame, dim: int, model_name: str | None = None
) -> DataFrame:
    """``cell_id, vector`` of every cell; a cell without entries has the zero vector.

    Narrow entries travel and are weighted where a cell's have come together, so no
    partial vector is shuffled.  A cell whose entries all lack a gene or a value has nulls.
    """
    code = (gene_code(F.col("gene_symbol")) * 7919 + model_seed(model_name)) % MODULUS
    amount = F.log1p(F.col("value").cast("double"))
    entry = F.struct(code.cast("int").alias("code"), amount.alias("amount"))
    known = code.isNotNull() & amount.isNotNull()
    # few bytes meet here, and a wide vector is made of each row: tasks are not sized by the bytes
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met, ids = expression.repartition(tasks, "cell_id"), cells.select("cell_id").repartition(tasks, "cell_id")
    entries = met.groupBy("cell_id").agg(F.array_sort(F.collect_list(F.when(known, entry))).alias("es"))
    none = F.array().cast(entries.schema["es"].dataType)
    rows = ids.join(entries.hint("merge"), "cell_id", "left")
    rows = rows.select("cell_id", F.size("es").eqNullSafe(0).alias("_unknown"), F.coalesce("es", none).alias("es"))
    vector = weighted_sum(dim, MODULUS, STEP)(F.col("es.code"), F.col("es.amount"))
    nulls = F.array_repeat(F.lit(None).cast("double"), dim)
    return rows.select("cell_id", F.when(F.col("_unknown"), nulls).otherwise(vector).alias("vector"))


def _code(gene: Column, model_name: str | None) -> Column:
    return ((gene_code(gene) * 7919 + model_seed(model_name)) % MODULUS).cast("int")


def _amount(old: Column, new: Column) -> Column:
    return F.log1p(new) - F.log1p(old)


def changed_embeddings(
    delta: DataFrame, baseline: DataFrame, dim: int, model_name: str | None = None, measured: bool = False
) -> DataFrame:
    """Vectors before and after, for the cells an experiment really changes.

    With ``measured`` there is ``distance`` in place of ``after``: the vector is measured
    where it is made, and not sent out and back in for that.

    Every other cell keeps its baseline vector, so nothing is computed for it.  An
    experiment changes few genes of a cell, so narrow entries travel: they are brought
    together by cell, where the baseline is joined, and weighted there.
    """
    entries = _entries_of(delta, baseline.withColumnRenamed("vector", "before"), model_name)
    return _moved(entries, dim, measured)


def _entries_of(delta: DataFrame, brought: DataFrame, model_name: str | None) -> DataFrame:
    """The entries ``es`` that an experiment changes in a cell, with the cell's columns of ``brought``."""
    code, amount = _code(F.col("gene_symbol"), model_name), _amount(F.col("old_value"), F.col("new_value"))
    entry = F.struct(code.alias("code"), amount.alias("amount")).alias("e")
    effective = delta.where(F.col("new_value") != F.col("old_value")).select(*KEYS, "cell_id", entry)
    entries = (
        effective.repartition("cell_id")
        .groupBy(*KEYS, "cell_id")
        .agg(F.array_sort(F.collect_list("e")).alias("es"))
    )
    return entries.join(brought, "cell_id")


def _moved(entries: DataFrame, dim: int, measured: bool) -> DataFrame:
    """The vector ``before`` moved by the entries ``es`` of its row."""
    made, name = (moved_distance, "distance") if measured else (moved_by, "after")
    out = made(dim, MODULUS, STEP)(F.col("before"), F.col("es.code"), F.col("es.amount"))
    return entries.select(*KEYS, "cell_id", "before", out.alias(name))


def perturbed_embeddings(
    specs: DataFrame,
    cells: DataFrame,
    genes: DataFrame,
    expression: DataFrame,
    baseline: DataFrame,
    dim: int,
    model_name: str | None = None,
    measured: bool = False,
) -> DataFrame:
    """``changed_embeddings`` of the delta table of ``specs``.

    Where an experiment fills in zeros, nearly every cell of its cohort changes.  Each cell
    brings its baseline vector to these experiments once, and its vectors are made where
    they meet.  Cells whose id repeats are brought together by id, as stored entries are.
    """
    before = baseline.withColumnRenamed("vector", "before")
    read, filled = _perturbed_lists(specs, cells, genes, expression, before, model_name)
    return _moved(read, dim, measured).unionByName(_moved(filled, dim, measured))


def _once_and_again(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells whose id does not repeat, and the others."""
    ids = cells.groupBy("cell_id").agg(F.count(F.lit(1)).alias("_n"))
    repeated = stored(ids.where("_n > 1").select("cell_id"), "repeated")
    once, again = (cells.join(repeated, "cell_id", how) for how in ("left_anti", "left_semi"))
    return once, again


def _perturbed_lists(
    specs: DataFrame, cells: DataFrame, genes: DataFrame, expression: DataFrame, brought: DataFrame, model_name: str | None
) -> tuple[DataFrame, DataFrame]:
    """The changed entries ``es`` by experiment and cell: those read, and those where zeros are filled in."""
    once, again = _once_and_again(cells)
    delta = perturb.delta_table(specs, cells, genes, expression, filled=again)
    filled = perturb.filled_lists(
        specs, once, genes, expression, brought, lambda gene: _code(gene, model_name), _amount
    )
    return _entries_of(delta, brought, model_name), filled


# --- vectors kept as entries ---------------------------------------------------

#: The entries that move a baseline vector: what ``perturbed_entries`` stores in place of a vector.
ENTRIES = "array<struct<code: int, amount: double>>"


def perturbed_entries(
    specs: DataFrame,
    cells: DataFrame,
    genes: DataFrame,
    expression: DataFrame,
    baseline: DataFrame,
    model_name: str | None = None,
) -> DataFrame:
    """``run_id, experiment_id, cell_id, es``: the rows of ``perturbed_embeddings``, not yet made.

    A vector is its cell's baseline vector moved by ``es``, so these rows and the baseline
    hold the same vectors to the last bit, in some bytes each whatever the width.
    """
    read, filled = _perturbed_lists(specs, cells, genes, expression, baseline.select("cell_id"), model_name)
    columns = [*KEYS, "cell_id", "es"]
    return read.select(*columns).unionByName(filled.select(*columns))


def made_of(before: str, es: str) -> Column:
    """The vector of single precision that entries make of a baseline vector; null without a list."""
    return moved_single(MODULUS, STEP)(F.col(before), F.col(f"{es}.code"), F.col(f"{es}.amount"))


def distances_of_kept(before: str, lists: str, against: str | None = None) -> Column:
    """The distances of a cell's vectors, kept as ``lists`` of entries, to ``before`` or to ``against``."""
    columns = [before, lists, *([against] if against else [])]
    return kept_distances(MODULUS, STEP, against is not None)(*[F.col(c) for c in columns])


# --- user models -------------------------------------------------------------

# What a user model computes: (gene arrays, value arrays), one pair of arrays per cell -> matrix.
Model = Callable[[Sequence[np.ndarray], Sequence[np.ndarray]], np.ndarray]

CHANGES = 256  # most experiments that share one copy of a cell's row
CALL = 256  # most cells in one call of a model


@dataclass(frozen=True)
class UserModel:
    """A model of the user's own: what identifies it, and its function of whole cells."""

    name: str
    version: str
    fn: Model


def identity(chosen: "str | UserModel | None") -> tuple[str, str]:
    """Name and version of a model; an unknown name is an error."""
    if isinstance(chosen, UserModel):
        return chosen.name, chosen.version
    model_seed(chosen)
    return chosen or model.MODEL_NAMES[0], model.MODEL_VERSION


def baseline_of(cells: DataFrame, expression: DataFrame, dim: int, chosen: "str | UserModel | None") -> DataFrame:
    """``cell_id, vector`` of every cell, by the built-in or a user's model."""
    if not isinstance(chosen, UserModel):
        return baseline_embeddings(cells, expression, dim, chosen)
    out = embed_with(expression, ["cell_id"], chosen.fn, dim, cells)
    return out.select("cell_id", F.col("embedding").cast("array<double>").alias("vector"))


def changed_of(
    specs: DataFrame,
    cells: DataFrame,
    genes: DataFrame,
    expression: DataFrame,
    baseline: DataFrame,
    dim: int,
    chosen: "str | UserModel | None",
) -> DataFrame:
    """``run_id, experiment_id, cell_id, after`` of the cells an experiment changes."""
    if not isinstance(chosen, UserModel):
        made = perturbed_embeddings(specs, cells, genes, expression, baseline, dim, chosen)
        return made.select(*KEYS, "cell_id", "after")
    after = F.col("embedding").cast("array<double>").alias("after")
    once, again = _once_and_again(cells)
    delta = perturb.delta_table(specs, cells, genes, expression, filled=again)
    read = embed_changed(delta, expression, chosen.fn, dim).join(baseline.select("cell_id"), "cell_id")
    filled = embed_filled(specs, once, genes, expression, baseline.select("cell_id"), chosen.fn, dim)
    return read.select(*KEYS, "cell_id", after).unionByName(filled.select(*KEYS, "cell_id", after))


def _row_of(entries: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The entries of each key as one array in the order of the genes."""
    entry = F.struct("gene_symbol", F.col(value).cast("double").alias("value"))
    return entries.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias(name))


def embed_changed(delta: DataFrame, expression: DataFrame, fn: Model, dim: int) -> DataFrame:
    """Run ``fn`` over the changed cells of all experiments: ``run_id, experiment_id, cell_id, embedding``.

    A cell's stored row meets the changes of up to ``CHANGES`` experiments at once, so it
    travels once for that many and not once an experiment.  Changes are dealt by a hash of
    the experiment, as many ways as the number of experiments asks for.  An entry set to 0
    is no entry.
    """
    effective = delta.where(F.col("new_value") != F.col("old_value"))
    n = delta.select(*KEYS).distinct().count()  # one number
    chunk = F.pmod(F.xxhash64(*KEYS), F.lit(-(-n // CHANGES) or 1))
    changes = (
        _row_of(effective, [*KEYS, "cell_id"], "new_value", "e")
        .groupBy("cell_id", chunk.alias("chunk"))
        .agg(F.collect_list(F.struct(*KEYS, "e")).alias("changes"))
    )
    touched = effective.select("cell_id").distinct()
    rows = _row_of(expression.join(touched, "cell_id", "left_semi"), ["cell_id"], "value", "base")
    return _embedded(changes.join(rows, "cell_id", "left"), fn, dim)


def embed_filled(
    specs: DataFrame, cells: DataFrame, genes: DataFrame, expression: DataFrame, brought: DataFrame, fn: Model, dim: int
) -> DataFrame:
    """``embed_changed`` of the experiments that fill in zeros; the ids of ``cells`` must not repeat.

    A cell's stored row meets up to about ``CHANGES`` experiments of its class at once, and what
    they change is listed there: no row an experiment and cell is shuffled before its vector is made.
    """
    rows = _row_of(expression, ["cell_id"], "value", "base")
    met = perturb.filled_changes(specs, cells, genes, expression, brought.join(rows, "cell_id", "left"), CHANGES)
    return _embedded(met, fn, dim)


def _embedded(met: DataFrame, fn: Model, dim: int) -> DataFrame:
    """The vectors of ``met``: a cell's row ``base``, null for none, and its ``changes`` by experiment."""
    empty = F.array().cast(met.schema["base"].dataType)
    met = met.select("cell_id", F.coalesce("base", empty).alias("base"), "changes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _changed_cells(batch, fn, dim)

    cell = met.schema["cell_id"].dataType.simpleString()
    schema = f"run_id string, experiment_id string, cell_id {cell}, embedding array<float>"
    return met.mapInArrow(run, schema)


def _entries(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each row's entries start and end, and all genes and values."""
    flat = column.flatten()
    starts = np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))])
    return starts, *(flat.field(name).to_numpy(zero_copy_only=False) for name in ("gene_symbol", "value"))


def _ragged(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the entries of the given rows, in turn: the place among ``rows`` and the index."""
    sizes = starts[rows + 1] - starts[rows]
    place = np.repeat(np.arange(len(rows)), sizes)
    ends = np.cumsum(sizes)
    return place, np.arange(len(place)) + np.repeat(starts[rows] - (ends - sizes), sizes)


def _changed_cells(batch: pa.RecordBatch, fn: Model, dim: int) -> Iterator[pa.RecordBatch]:
    """Calls ``fn`` with the rows of up to ``CALL`` changed cells, some entries replaced.

    A row is in the order of the genes; zeros leave it.  Rows are put together for a
    whole call at once.
    """
    starts, genes, values = _entries(batch.column("base"))
    listed = batch.column("changes")
    cell = np.repeat(np.arange(batch.num_rows), np.diff(listed.offsets.to_numpy()))
    changes = listed.flatten()
    new_starts, new_genes, new_values = _entries(changes.field("e"))
    every = np.concatenate([genes, new_genes]) if len(genes) else new_genes
    known, codes = np.unique(every, return_inverse=True)
    code, new_code = codes[: len(genes)], codes[len(genes) :]
    for first in range(0, len(cell), CALL):
        change = np.arange(first, min(first + CALL, len(cell)))
        place, at = _ragged(starts, cell[change])
        new_place, new_at = _ragged(new_starts, change)
        key, new_key = place * len(known) + code[at], new_place * len(known) + new_code[new_at]
        kept = ~np.isin(key, new_key)
        key = np.concatenate([key[kept], new_key])
        value = np.concatenate([values[at[kept]], new_values[new_at]])
        order = np.argsort(key, kind="stable")
        order = order[value[order] != 0]
        key, value = key[order], value[order]
        gene = known[key % len(known)]
        ends = np.searchsorted(key, np.arange(len(change) + 1) * len(known))
        spans = [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]
        vectors = _as_lists(fn([gene[s] for s in spans], [value[s] for s in spans]), len(change), dim)
        columns = [changes.field(k).slice(first, len(change)) for k in KEYS]
        cells = batch.column("cell_id").take(pa.array(cell[change]))
        yield pa.RecordBatch.from_arrays([*columns, cells, vectors], names=[*KEYS, "cell_id", "embedding"])


def _as_lists(matrix: np.ndarray, n: int, dim: int) -> pa.ListArray:
    out = np.asarray(matrix, dtype=np.float32)
    if out.shape != (n, dim):
        raise ValueError(f"model returned shape {out.shape}, expected {(n, dim)}")
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32)), pa.array(out.ravel()))


def embed_with(
    matrix: DataFrame, keys: Sequence[str], fn: Model, dim: int, rows_of: DataFrame | None = None
) -> DataFrame:
    """Run ``fn`` over the cells of a matrix, Arrow batch by Arrow batch.

    ``matrix`` holds ``keys, gene_symbol, value``.  A row of the matrix is
    gathered into two arrays; its length is bounded by the number of genes.
    ``rows_of`` has the ``keys`` of every row there is: one without an entry gets
    empty arrays.  Without it only rows with entries have a vector.
    """
    keys = list(keys)
    rows = _row_of(matrix, keys, "value", "e").select(
        *keys, F.col("e.gene_symbol").alias("genes"), F.col("e.value").alias("values")
    )
    if rows_of is not None:
        kinds = rows.schema
        empty = {n: F.array().cast(kinds[n].dataType) for n in ("genes", "values")}
        rows = rows_of.select(*keys).join(rows, keys, "left").select(
            *keys, *[F.coalesce(n, v).alias(n) for n, v in empty.items()]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            genes = [g.values.to_numpy(zero_copy_only=False) for g in batch.column("genes")]
            values = [v.values.to_numpy(zero_copy_only=False) for v in batch.column("values")]
            vectors = _as_lists(fn(genes, values), batch.num_rows, dim)
            columns = [batch.column(k) for k in keys] + [vectors]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "embedding"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{k} {types[k]}" for k in keys) + ", embedding array<float>"
    return rows.mapInArrow(run, schema)
