"""Distances between perturbed and baseline vectors, and their summaries."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellshift.functions.vectors import cosine_distance
from cellshift.operators import embed, ranks
from cellshift.operators.cohorts import is_target, matched_classes
from cellshift.operators.specs import KEYS
from cellshift.session import stored

METRIC = "cosine_distance"


# --- inputs ------------------------------------------------------------------


def vector_bytes(vectors: DataFrame) -> int:
    """Size of a table of vectors as doubles, counted in the cluster."""
    return vectors.agg(F.sum(F.size("embedding").cast("bigint") * 8 + 32)).first()[0] or 0


def missing_embeddings(experiments: DataFrame, perturbed: DataFrame) -> DataFrame:
    """Experiments of a run that have no embedding at all."""
    present = perturbed.select(*KEYS).distinct()
    return experiments.select(*KEYS).join(present, KEYS, "left_anti")


def lost_vectors(manifest: DataFrame, changed: DataFrame, cells: DataFrame) -> DataFrame:
    """Experiments whose stored vectors are not ``n_changed`` many, all of known cells."""
    known = cells.select("cell_id", F.lit(1).alias("_known"))
    counted = (
        changed.select(*KEYS, "cell_id")
        .join(known, "cell_id", "left")
        .groupBy(*KEYS)
        .agg(F.count(F.lit(1)).alias("n_stored"), F.count("_known").alias("n_known"))
    )
    found = manifest.join(counted, KEYS, "left").fillna(0, ["n_stored", "n_known"])
    right = F.col("n_stored").eqNullSafe(F.col("n_changed")) & (F.col("n_known") == F.col("n_stored"))
    return found.where(~right).select(*KEYS, "n_changed", "n_stored", "n_known")


def of_width(vector: str, dim: int) -> Column:
    """The vector as doubles; one of another width stops the job."""
    width = F.size(vector)
    said = F.concat(F.lit(f"expected vectors of width {dim}, got "), F.coalesce(width.cast("string"), F.lit("none")))
    return F.when(width == dim, F.col(vector).cast("array<double>")).otherwise(F.raise_error(said))


def shape_problems(perturbed: DataFrame, baseline: DataFrame) -> DataFrame:
    """Experiments whose cells or widths differ from the baseline's.

    Cells are counted as matched or not per experiment, so no table of
    experiments times cells is built.
    """
    base = baseline.select("cell_id", F.size("embedding").alias("_base_width"))
    expected = baseline.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = (
        perturbed.select(*KEYS, "cell_id", F.size("embedding").alias("_width"))
        .join(base, "cell_id", "left")
        .groupBy(*KEYS)
        .agg(
            F.count("_base_width").alias("n_matched"),
            F.count_if(F.col("_base_width").isNull()).alias("n_unmatched"),
            F.count_if(F.col("_width") != F.col("_base_width")).alias("n_width_differs"),
        )
    )
    return counted.select("*", (expected - F.col("n_matched")).alias("n_absent")).where(
        (F.col("n_unmatched") > 0) | (F.col("n_width_differs") > 0) | (F.col("n_absent") > 0)
    )


def baseline_width_problems(baseline: DataFrame, dim: int) -> DataFrame:
    """One row: baseline rows whose width is not ``dim`` and whether that is none."""
    wrong = F.count_if(F.coalesce(F.size("embedding"), F.lit(-1)) != dim)
    return baseline.agg(F.count(F.lit(1)).alias("n_rows"), wrong.alias("n_wrong_width")).withColumn(
        "passed", F.col("n_wrong_width") == 0
    )


# --- dense comparison --------------------------------------------------------


BROADCAST_BYTES = 256 * 1024 * 1024  # largest baseline copied to every executor


def distances(
    perturbed: DataFrame, baseline: DataFrame, baseline_bytes: int | None = None
) -> DataFrame:
    """``run_id, experiment_id, cell_id, distance`` for every perturbed vector.

    There are many perturbed vectors per baseline vector.  Where the checked
    size of the baseline allows it, it is copied to the executors and the
    perturbed vectors are not shuffled; otherwise both sides meet by cell.
    """
    base = baseline.select("cell_id", F.col("embedding").alias("_base"))
    if baseline_bytes is not None and baseline_bytes <= BROADCAST_BYTES:
        base = F.broadcast(base)
    return perturbed.join(base, "cell_id").select(
        *KEYS, "cell_id", cosine_distance(F.col("embedding"), F.col("_base")).alias("distance")
    )


def with_target_flag(dist: DataFrame, cells: DataFrame, experiments: DataFrame) -> DataFrame:
    """Mark the rows whose cell belongs to the experiment's target subset."""
    lists = experiments.select(*KEYS, "target_donors", "target_cell_types")
    for attribute in ("donor", "cell_type"):
        if attribute not in cells.columns:
            cells = cells.withColumn(attribute, F.lit(None).cast("string"))
    return (
        dist.join(cells.select("cell_id", "donor", "cell_type"), "cell_id")
        .join(lists, KEYS)
        .select(*KEYS, "cell_id", "distance", is_target("comparison").alias("is_target"))
    )


def _scopes(flag: str = "is_target") -> Column:
    """The summaries a row counts in: all cells, and the targets where it is one."""
    both = F.array(F.lit("all"), F.lit("target"))
    return F.explode(F.when(F.col(flag), both).otherwise(F.array(F.lit("all")))).alias("scope")


def distance_summary(flagged: DataFrame) -> DataFrame:
    """Per experiment: all cells and the target subset; subset values null when empty."""
    rows = stored(flagged.select(*KEYS, "distance", "is_target"), "distances")
    d = F.col("distance")
    target = F.when(F.col("is_target"), d)
    plain = rows.groupBy(*KEYS).agg(
        F.count(d).alias("n_cells"),
        F.count(target).alias("n_target_cells"),
        F.avg(d).alias("mean_distance"),
        F.stddev_pop(d).alias("std_distance"),
        F.min(d).alias("min_distance"),
        F.max(d).alias("max_distance"),
        F.avg(target).alias("mean_distance_target_subset"),
    )
    scoped = rows.where("distance IS NOT NULL").select(*KEYS, _scopes(), d.alias("v"))
    medians = ranks.percentiles(scoped, [*KEYS, "scope"], [0.5], ["median"])
    of = lambda scope: F.max(F.when(F.col("scope") == scope, F.col("median")))
    medians = medians.groupBy(*KEYS).agg(
        of("all").alias("median_distance"), of("target").alias("median_distance_target_subset")
    )
    return plain.join(medians, KEYS, "left")


# --- comparison from changed cells only --------------------------------------


def resting_distances(own: DataFrame, baseline: DataFrame, cells: DataFrame) -> DataFrame:
    """Distance of every unchanged cell to the baseline, with the cell's attributes."""
    base = baseline.select("cell_id", F.col("vector").alias("_base"))
    return (
        own.join(base, "cell_id")
        .select("cell_id", cosine_distance(F.col("vector"), F.col("_base")).alias("distance"))
        .join(cells.select("cell_id", "donor", "cell_type"), "cell_id")
    )


def changed_distances(changed: DataFrame, cells: DataFrame, experiments: DataFrame) -> DataFrame:
    """Distances of the changed cells to their own baseline, with the target flag.

    ``rest`` is the distance the cell had unchanged: 0, or 1 for a zero vector.  Vectors
    measured where they were made bring their ``distance`` in place of ``after``.
    """
    measured = "distance" in changed.columns
    dist = changed.select(
        *KEYS,
        "cell_id",
        F.col("distance") if measured else cosine_distance(F.col("after"), F.col("before")).alias("distance"),
        F.when(_is_empty("before"), F.lit(1.0)).otherwise(F.lit(0.0)).alias("rest"),
    )
    return _flagged(dist, cells, experiments)


TOGETHER = 256  # most changes of a cell that share one copy of its vectors


def kept_distances(kept: DataFrame, cells: DataFrame, experiments: DataFrame, own: DataFrame, to: DataFrame | None = None) -> DataFrame:
    """What ``changed_distances`` and ``changed_distances_to`` give, for vectors kept as entries ``es``.

    ``own`` (cell_id, embedding) is the baseline that the entries move.  Distances are to it,
    or to the vectors of ``to``; then ``cells`` are its ``resting_distances``.  Entries are
    brought together by cell, up to ``TOGETHER`` at a time, so a baseline vector travels
    once for so many vectors.
    """
    place = F.row_number().over(Window.partitionBy("cell_id").orderBy("cell_id")) - 1
    lists = (
        kept.withColumn("_chunk", F.floor(place / TOGETHER))
        .groupBy("cell_id", "_chunk")
        .agg(F.collect_list(F.struct(*KEYS, "es")).alias("changes"))
    )
    # a file of entries is small, but its rows are too many to be copied to every task
    met = lists.hint("merge").join(own.select("cell_id", F.col("embedding").alias("before")), "cell_id")
    met = met.withColumn("lists", F.col("changes.es"))
    if to is None:
        distances = embed.distances_of_kept("before", "lists")
        rest = F.when(_is_empty("before"), F.lit(1.0)).otherwise(F.lit(0.0))
    else:
        met = met.join(to.select("cell_id", F.col("embedding").alias("_base")), "cell_id")
        distances = embed.distances_of_kept("before", "lists", "_base")
        rest = F.col("_rest")
        met = met.join(cells.select("cell_id", F.col("distance").alias("_rest")), "cell_id")
    ids = F.transform("changes", lambda c: F.struct(*[c[k].alias(k) for k in KEYS]))
    rows = met.select("cell_id", rest.alias("rest"), ids.alias("ids"), distances.alias("distances"))
    dist = rows.select("cell_id", "rest", F.inline(F.arrays_zip("ids", "distances")))
    return _flagged(dist.select("ids.*", "cell_id", F.col("distances").alias("distance"), "rest"), cells, experiments)


def changed_distances_to(
    changed: DataFrame, baseline: DataFrame, rest: DataFrame, experiments: DataFrame
) -> DataFrame:
    """Distances of the changed cells to any baseline; ``rest`` from ``resting_distances``."""
    base = baseline.select("cell_id", F.col("vector").alias("_base"))
    dist = changed.join(base, "cell_id").select(
        *KEYS, "cell_id", cosine_distance(F.col("after"), F.col("_base")).alias("distance")
    )
    known = rest.select("cell_id", F.col("distance").alias("rest"))
    return _flagged(dist.join(known, "cell_id"), rest, experiments)


def _flagged(dist: DataFrame, cells: DataFrame, experiments: DataFrame) -> DataFrame:
    lists = experiments.select(*KEYS, "target_donors", "target_cell_types")
    return (
        dist.join(cells.select("cell_id", "donor", "cell_type"), "cell_id")
        .join(lists, KEYS)
        .select(*KEYS, "cell_id", "distance", "rest", is_target("comparison").alias("is_target"))
    )


def _is_empty(vector: str):
    return ~F.exists(vector, lambda v: v != 0.0)


def changed_summary(dist: DataFrame, baseline: DataFrame, cells: DataFrame, experiments: DataFrame) -> DataFrame:
    """The same summary as ``distance_summary`` over all cells, from changed cells only.

    A cell an experiment leaves alone is at distance 0 from its own baseline, or at
    distance 1 when that baseline is the zero vector.  Those two blocks enter as counts,
    taken from class sizes, instead of as rows; a rank that falls outside them is looked up
    among the changed cells.  ``dist`` and ``baseline`` are stored tables.
    """
    marked = baseline.select("cell_id", _is_empty("vector").alias("empty")).join(
        cells.select("cell_id", "donor", "cell_type"), "cell_id"
    )
    totals = marked.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if("empty").alias("n_empty")).alias("all")
    )
    targets = (
        matched_classes(experiments, marked, "comparison", n_empty=F.count_if("empty"))
        .groupBy(*KEYS)
        .agg(F.sum("n_cells").alias("t"), F.sum("n_empty").alias("t_empty"))
    )
    d = F.col("distance")
    target = F.when(F.col("is_target"), d)
    changed = dist.groupBy(*KEYS).agg(
        F.count(d).alias("c"),
        F.count_if(F.expr("rest = 1")).alias("c_empty"),
        F.count(target).alias("ct"),
        F.count_if(F.expr("is_target AND rest = 1")).alias("ct_empty"),
        F.avg(d).alias("c_mean"),
        F.var_pop(d).alias("c_var"),
        F.min(d).alias("c_min"),
        F.max(d).alias("c_max"),
        F.avg(target).alias("ct_mean"),
        F.count_if(d <= 1.0).alias("low"),
        F.count_if(target <= 1.0).alias("t_low"),
    )
    counts = ["t", "t_empty", "c", "c_empty", "ct", "ct_empty", "low", "t_low"]
    parts = (
        experiments.select(*KEYS)
        .join(targets, KEYS, "left")
        .join(changed, KEYS, "left")
        .na.fill(0, counts)
        .na.fill(0.0, ["c_mean", "c_var", "ct_mean"])
        .withColumn("all", totals.scalar())
        .select("*", "all.*")
        .drop("all")
        .selectExpr(
            "*",
            "n - n_empty - c + c_empty AS zeros",
            "n_empty - c_empty AS ones",
            "t - t_empty - ct + ct_empty AS t_zeros",
            "t_empty - ct_empty AS t_ones",
        )
        .withColumn("mean", F.expr("try_divide(c * c_mean + ones, n)"))
    )
    parts = stored(parts, "summary-parts")
    edge = "CASE WHEN zeros > 0 THEN 0D END, CASE WHEN ones > 0 THEN 1D END"
    return parts.join(_medians(parts, dist), KEYS, "left").selectExpr(
        *KEYS,
        "n AS n_cells",
        "t AS n_target_cells",
        "mean AS mean_distance",
        "median AS median_distance",
        "sqrt(try_divide(c * c_var + c * pow(c_mean - mean, 2) + zeros * pow(mean, 2)"
        " + ones * pow(1 - mean, 2), n)) AS std_distance",
        f"least({edge}, c_min) AS min_distance",
        f"greatest({edge}, c_max) AS max_distance",
        "try_divide(ct * ct_mean + t_ones, t) AS mean_distance_target_subset",
        "t_median AS median_distance_target_subset",
    )


def _medians(parts: DataFrame, dist: DataFrame) -> DataFrame:
    """``median`` and ``t_median`` per experiment: the mean of the values at the two middle ranks.

    In order there are the zeros, the changed distances up to 1, the ones, and the rest of
    the changed distances, so a middle rank is a 0, a 1 or a rank among the changed ones.
    """
    scopes = (("all", "n", "zeros", "ones", "low", "c"), ("target", "t", "t_zeros", "t_ones", "t_low", "ct"))
    rows = ", ".join(f"struct('{s}' AS scope, {n} AS n, {z} AS zeros, {o} AS ones, {low} AS low, {c} AS c)" for s, n, z, o, low, c in scopes)
    middles = (
        parts.selectExpr(*KEYS, f"inline(array({rows}))")
        .where("n > 0")
        .selectExpr(*KEYS, "scope", "zeros", "ones", "low", "c", "explode(array((n - 1) div 2, n div 2)) AS at")
        .selectExpr(
            *KEYS,
            "scope",
            "c AS n",
            "CASE WHEN at < zeros THEN 0D WHEN at >= zeros + low AND at < zeros + low + ones THEN 1D END AS fixed",
            "CASE WHEN at < zeros + low THEN at - zeros ELSE at - zeros - ones END AS rank",
        )
    )
    scoped = dist.where("distance IS NOT NULL").select(*KEYS, _scopes(), F.col("distance").alias("v"))
    group = [*KEYS, "scope"]
    found = ranks.at_ranks(scoped, group, middles.where("fixed IS NULL"))
    at = middles.join(found, [*group, "rank"], "left").withColumn("value", F.coalesce("fixed", "value"))
    of = lambda scope: F.avg(F.when(F.col("scope") == scope, F.col("value")))
    return at.groupBy(*KEYS).agg(of("all").alias("median"), of("target").alias("t_median"))
