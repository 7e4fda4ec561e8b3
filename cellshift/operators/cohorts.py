"""Which cells an experiment targets.

A target list is matched against the distinct (donor, cell type) classes, never
against single cells: each class is offered under four keys (both values, one
value and a wildcard, two wildcards) and each spec asks under one kind of key,
so the match is a plain equi-join of two small tables.  Cells then join the
matched classes on their attributes and a chunk of their class, so that a class of a
third of all cells is many keys.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellshift.operators.specs import KEYS


def _has_no_restriction(targets: Column, rule: str) -> Column:
    if rule == "execution":  # an empty list selects no cell
        return targets.isNull()
    if rule == "comparison":  # an empty list selects every cell
        return F.coalesce(F.size(targets), F.lit(0)) == 0
    raise ValueError(f"rule must be 'execution' or 'comparison', not {rule!r}")


def is_target(rule: str) -> Column:
    """Predicate on a row that carries a cell's attributes and its spec's lists."""

    def allowed(targets: str, attribute: str) -> Column:
        listed = F.coalesce(F.array_contains(targets, F.col(attribute)), F.lit(False))
        return _has_no_restriction(F.col(targets), rule) | listed

    return allowed("target_donors", "donor") & allowed("target_cell_types", "cell_type")


def _asked(targets: str, attribute_type: str, rule: str) -> Column:
    wild = F.array(
        F.struct(F.lit(True).alias("any"), F.lit(None).cast(attribute_type).alias("value"))
    )
    values = F.array_distinct(F.filter(F.col(targets), lambda v: v.isNotNull()))
    exact = F.transform(
        values, lambda v: F.struct(F.lit(False).alias("any"), v.cast(attribute_type).alias("value"))
    )
    return F.explode(F.when(_has_no_restriction(F.col(targets), rule), wild).otherwise(exact))


def _offered(attribute: str, attribute_type: str) -> Column:
    return F.explode(
        F.array(
            F.struct(F.lit(True).alias("any"), F.lit(None).cast(attribute_type).alias("value")),
            F.struct(F.lit(False).alias("any"), F.col(attribute).alias("value")),
        )
    )


def with_attributes(cells: DataFrame, specs: DataFrame, rule: str) -> tuple[DataFrame, DataFrame]:
    """Give both sides the two attribute columns.

    A restriction on a column the cells lack is an error at execution and
    matches no cell at comparison.
    """
    for attribute, targets in (("donor", "target_donors"), ("cell_type", "target_cell_types")):
        if attribute in cells.columns:
            continue
        cells = cells.withColumn(attribute, F.lit(None).cast("string"))
        if rule == "execution":
            message = F.lit(f"{targets} provided but '{attribute}' is missing in cells")
            refused = F.when(F.col(targets).isNotNull(), F.raise_error(message).cast("array<string>"))
            specs = specs.withColumn(targets, refused)
    return cells, specs


def cohort_classes(cells: DataFrame, **measures: Column) -> DataFrame:
    return cells.groupBy("donor", "cell_type").agg(
        F.count(F.lit(1)).alias("n_cells"), *[m.alias(name) for name, m in measures.items()]
    )


def matched_classes(
    specs: DataFrame, cells: DataFrame, rule: str, *keep: str, **measures: Column
) -> DataFrame:
    """Spec keys (and ``keep``) with each attribute class they target.

    ``measures`` are further aggregates over the cells of a class.
    """
    cells, specs = with_attributes(cells, specs, rule)
    types = {f.name: f.dataType.simpleString() for f in cells.schema.fields}
    asked = (
        specs.select(*KEYS, *keep, "target_cell_types", _asked("target_donors", types["donor"], rule).alias("d"))
        .select(*KEYS, *keep, "d", _asked("target_cell_types", types["cell_type"], rule).alias("t"))
        .select(
            *KEYS,
            *keep,
            F.col("d.any").alias("d_any"),
            F.col("d.value").alias("d_value"),
            F.col("t.any").alias("t_any"),
            F.col("t.value").alias("t_value"),
        )
    )
    offered = (
        cohort_classes(cells, **measures)
        .select("*", _offered("donor", types["donor"]).alias("d"))
        .select("*", _offered("cell_type", types["cell_type"]).alias("t"))
        .select(
            "donor",
            "cell_type",
            "n_cells",
            *measures,
            F.col("d.any").alias("o_d_any"),
            F.col("d.value").alias("o_d_value"),
            F.col("t.any").alias("o_t_any"),
            F.col("t.value").alias("o_t_value"),
        )
    )
    on = (
        (F.col("d_any") == F.col("o_d_any"))
        & (F.col("t_any") == F.col("o_t_any"))
        & F.col("d_value").eqNullSafe(F.col("o_d_value"))
        & F.col("t_value").eqNullSafe(F.col("o_t_value"))
    )
    return asked.join(offered, on).select(*KEYS, *keep, "donor", "cell_type", "n_cells", *measures)


def target_cell_counts(specs: DataFrame, cells: DataFrame, rule: str = "execution") -> DataFrame:
    """Number of targeted cells of every experiment, from class sizes alone."""
    hits = matched_classes(specs, cells, rule).groupBy(*KEYS).agg(F.sum("n_cells").alias("n"))
    return (
        specs.select(*KEYS)
        .join(hits, KEYS, "left")
        .select(*KEYS, F.coalesce(F.col("n"), F.lit(0)).alias("n_target_cells"))
    )


CHUNK = 100_000  # cells of a class that share a key
FEWEST = 1_000  # a class is not cut finer for its rows, so what meets it is repeated for so many cells at least
ROWS = 2_000_000  # rows a task should make


def each_cell(asked: DataFrame, cells: DataFrame, chunk: int = CHUNK, rows: int = ROWS, fewest: int = FEWEST) -> DataFrame:
    """Each row of ``asked`` (of a class: ``donor, cell_type, n_cells``) with every cell of its class.

    Few bytes meet here and many rows come out, so tasks are set by the rows and not by the
    bytes shuffled.  A cell's chunk comes from its id and one number, how many chunks the
    class with the most cells or rows needs; ``asked`` is offered in every chunk.
    """
    per_class = asked.groupBy("donor", "cell_type").agg(F.max("n_cells").alias("n"), F.sum("n_cells").alias("out"))
    counted = per_class.agg(F.max("n").alias("largest"), F.max("out").alias("most"), F.sum("out").alias("all")).first()
    largest, most = counted.largest or 0, counted.most or 0
    chunks = max(1, -(-largest // chunk), min(-(-most // rows), -(-largest // fewest)))
    key = F.struct("donor", "cell_type").alias("_class")  # a null in it equals a null
    kept = [c for c in asked.columns if c not in ("donor", "cell_type", "n_cells")]
    offered = asked.select(*kept, key, F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("_chunk"))
    held = [c for c in cells.columns if c not in ("donor", "cell_type")]
    placed = cells.select(*held, key, F.pmod(F.xxhash64("cell_id"), F.lit(chunks)).cast("int").alias("_chunk"))
    if (counted["all"] or 0) > rows:
        least = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(least, -(-counted["all"] // rows))
        offered, placed = (side.repartition(min(tasks, 10_000), "_class", "_chunk") for side in (offered, placed))
    return placed.join(offered, ["_class", "_chunk"]).drop("_class", "_chunk")


def cohort_members(specs: DataFrame, cells: DataFrame, rule: str, *keep: str, chunk: int = CHUNK) -> DataFrame:
    """One row per experiment and targeted cell."""
    matched = matched_classes(specs, cells, rule, *keep)
    full, _ = with_attributes(cells, specs, rule)
    return each_cell(matched, full.select("cell_id", "donor", "cell_type"), chunk).select(*KEYS, *keep, "cell_id")


def involved_values(cells: DataFrame) -> DataFrame:
    """Sorted distinct donors and cell types over all cells, as one row."""

    def listed(column: str):
        if column not in cells.columns:
            return F.array().cast("array<string>")
        return F.array_sort(F.collect_set(F.col(column).cast("string")))

    present = [c for c in ("donor", "cell_type") if c in cells.columns]
    # Distinct first: the lists are then built from classes, not from cells.
    classes = cells.select(*present).distinct() if present else cells.limit(1)
    return classes.agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            listed(column).alias(name) if column in cells.columns else F.first(listed(column)).alias(name)
            for column, name in (("donor", "involved_donors"), ("cell_type", "involved_cell_types"))
        ],
    ).drop("_n")
