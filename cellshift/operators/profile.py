"""Profile of a dataset: shape, totals, detection, categories, distributions."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellshift import model
from cellshift.operators import ranks
from cellshift.session import stored


def _totals(side: DataFrame, key: str, expression: DataFrame) -> DataFrame:
    sums = expression.groupBy(key).agg(
        F.sum("value").alias("_total"), F.count_if(F.col("value") > 0).alias("_detected")
    )
    return (
        side.select(key)
        .join(sums, key, "left")
        .select(
            key,
            F.coalesce(F.col("_total").cast("double"), F.lit(0.0)).alias("total"),
            F.coalesce("_detected", F.lit(0)).alias("detected"),
        )
    )


def cell_totals(cells: DataFrame, expression: DataFrame) -> DataFrame:
    """Total value and number of detected genes of every cell, zero cells included."""
    return _totals(cells, "cell_id", expression)


def gene_totals(genes: DataFrame, expression: DataFrame) -> DataFrame:
    """Total value and number of detecting cells of every gene, zero genes included."""
    return _totals(genes, "gene_symbol", expression)


def dataset_shape(cells: DataFrame, genes: DataFrame) -> DataFrame:
    """One row: number of cells and of genes."""
    n, zero = F.count(F.lit(1)), F.lit(0).cast("bigint")
    parts = cells.agg(n.alias("n_cells")).select("n_cells", zero.alias("n_genes"))
    parts = parts.unionByName(genes.agg(n.alias("n_genes")).select(zero.alias("n_cells"), "n_genes"))
    return parts.agg(F.sum("n_cells").alias("n_cells"), F.sum("n_genes").alias("n_genes"))


def matrix_overview(
    cells: DataFrame, genes: DataFrame, expression: DataFrame, zeros_in_range: bool = False
) -> DataFrame:
    """Non-zeros, density and value range.

    The range of a sparse matrix ignores its zeros; ``zeros_in_range`` counts
    them, as a dense matrix would.
    """
    entries = expression.where(F.col("value") != 0).agg(
        F.count(F.lit(1)).alias("non_zero"),
        F.min("value").cast("double").alias("_min"),
        F.max("value").cast("double").alias("_max"),
    )
    one = dataset_shape(cells, genes).unionByName(entries, allowMissingColumns=True)
    n_entries = F.col("n_cells") * F.col("n_genes")
    has_zero = F.lit(zeros_in_range) & (F.col("non_zero") < n_entries)
    density = F.when(n_entries > 0, F.col("non_zero") / n_entries).otherwise(F.lit(0.0))
    low, high = F.coalesce("_min", F.lit(0.0)), F.coalesce("_max", F.lit(0.0))
    return one.agg(*[F.max(c).alias(c) for c in one.columns]).select(
        "n_cells",
        "n_genes",
        "non_zero",
        density.alias("density"),
        (1.0 - density).alias("sparsity"),
        F.when(has_zero, F.least(low, F.lit(0.0))).otherwise(low).alias("min_value"),
        F.when(has_zero, F.greatest(high, F.lit(0.0))).otherwise(high).alias("max_value"),
    )


def category_counts(
    df: DataFrame, column: str, k: int = 20, domain: DataFrame | None = None
) -> DataFrame:
    """The ``k`` most frequent categories, null kept, ties by name.

    Categories of ``domain`` (one column ``category``) that never occur count 0.
    """
    counts = df.groupBy(F.col(column).cast("string").alias("category")).agg(
        F.count(F.lit(1)).alias("n")
    )
    if domain is not None:
        empty = domain.select(F.col("category").cast("string"), F.lit(0).cast("bigint").alias("n"))
        counts = counts.unionByName(empty).groupBy("category").agg(F.sum("n").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_last("category")).limit(k)


def flag_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a boolean column, null kept."""
    return df.groupBy(F.col(column).alias("flag")).agg(F.count(F.lit(1)).alias("n"))


def percentile_names(probabilities: Sequence[float]) -> list[str]:
    return [f"p{round(p * 100):02d}" for p in probabilities]


def describe(
    df: DataFrame, column: str, probabilities: Sequence[float] = model.PROFILE_PERCENTILES
) -> DataFrame:
    """One row: count, mean, sample std, min, percentiles, max; NaN counts as missing."""
    return describe_columns(df, [column], probabilities).drop("column_name")


def describe_columns(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = model.PROFILE_PERCENTILES
) -> DataFrame:
    """A row of ``column_name`` and the measures for every numeric column, from one pass over the rows."""
    listed = F.array(*[_named("column_name", c, ranks.observed(F.col(c))) for c in columns])
    return described(df.select(F.inline(listed)), ["column_name"], [(c,) for c in columns], probabilities)


def _named(key: str, name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias(key), value.alias("x"))


def described(
    rows: DataFrame, keys: Sequence[str], groups: Sequence[tuple], probabilities: Sequence[float]
) -> DataFrame:
    """``keys``, n, mean, std, min, percentiles and max of ``x`` for each of the ``groups``.

    A group without a value has n 0 and nulls.
    """
    keys, x = list(keys), F.col("v")
    data = ranks.values(rows, keys, F.col("x"))
    measures = data.groupBy(*keys).agg(
        F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")
    )
    names = percentile_names(probabilities)
    found = ranks.percentiles(data, keys, probabilities, names).join(measures, keys)
    listed = rows.sparkSession.createDataFrame(list(groups), ", ".join(f"{k} string" for k in keys))
    return listed.join(found, keys, "left").select(
        *keys, F.coalesce("n", F.lit(0)).alias("n"), "mean", "std", "min", *names, "max"
    )


def size_factors(totals: DataFrame) -> DataFrame:
    """Each cell's total divided by the median total; null where the median is 0.

    A total that is NaN takes no part in the median and has no factor.
    """
    known = stored(totals.select("cell_id", ranks.observed(F.col("total")).alias("total")), "totals")
    rows = known.where("total IS NOT NULL").select(F.lit("total").alias("of"), F.col("total").alias("v"))
    median = ranks.percentiles(rows, ["of"], [0.5], ["median"]).select("median")
    return known.select("cell_id", F.try_divide(F.col("total"), median.scalar()).alias("size_factor"))


def with_effects(df: DataFrame, effects: dict[str, DataFrame], name: str = "effect") -> DataFrame:
    """Product of per-category factors; each table holds ``<column>, effect``.

    The factor tables are left to the planner, which broadcasts a small one.
    """
    product = F.lit(1.0)
    for column, factors in effects.items():
        renamed = factors.select(column, F.col("effect").alias(f"_{column}_effect"))
        df = df.join(renamed, column, "left")
        product = product * F.coalesce(F.col(f"_{column}_effect"), F.lit(1.0))
    return df.withColumn(name, product).drop(*[f"_{c}_effect" for c in effects])


def first_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def _long(df: DataFrame, section: Column, name: Column, values: Sequence[str]) -> DataFrame:
    """Wide rows as (section, column_name, metric, value) rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in values]
    )
    return df.select(section.alias("section"), name.alias("column_name"), F.inline(pairs))


def top_categories(
    tables: Sequence[tuple[str, DataFrame, Sequence[str]]], k: int, domains: dict[str, DataFrame] | None = None
) -> DataFrame:
    """``section, column_name, category, n``: the most frequent values of many columns, each table read once.

    Like ``category_counts`` for every text or flag column of every (section, table, columns).
    """
    counts = None
    for section, df, columns in tables:
        cells = F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category")) for c in columns]
        )
        part = df.select(F.lit(section).alias("section"), F.inline(cells), F.lit(1).cast("bigint").alias("n"))
        for column in columns:
            if column in (domains or {}):
                named = domains[column].select(
                    F.lit(section).alias("section"), F.lit(column).alias("column_name"),
                    F.col("category").cast("string"), F.lit(0).cast("bigint").alias("n"),
                )
                part = part.unionByName(named)
        counts = part if counts is None else counts.unionByName(part)
    group = ["section", "column_name"]
    counts = counts.groupBy(*group, "category").agg(F.sum("n").alias("n"))
    # tasks keep k rows a column each before any of them travels
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("n"), F.asc_nulls_last("category")))
    return counts.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def dataset_profile(
    cells: DataFrame,
    genes: DataFrame,
    expression: DataFrame,
    k: int = 20,
    domains: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The whole profile as one long table (section, column_name, metric, value).

    The matrix is read by one aggregate over (cell, gene) grouped both ways and by its
    overview; the side tables once for their categories and once for their numbers.
    """
    expression = stored(expression, "matrix")
    overview = matrix_overview(cells, genes, expression)
    parts = [_long(overview, F.lit("matrix"), F.lit("value"), overview.columns)]
    numbers, groups, texts, shown = [], [], [], []
    for section, totals in (("cell", cell_totals(cells, expression)), ("gene", gene_totals(genes, expression))):
        numbers.append((section, totals, ("total", "detected")))
    for section, side, key in (("cells", cells, "cell_id"), ("genes", genes, "gene_symbol")):
        kinds = {f.name: f.dataType for f in side.schema.fields if f.name != key}
        numeric = [c for c, kind in kinds.items() if isinstance(kind, T.NumericType)]
        listed = [c for c, kind in kinds.items() if isinstance(kind, (T.StringType, T.BooleanType))]
        if numeric:
            shown.append((section, side, numeric))
        if listed:
            texts.append((section, side, listed))
    for batch, probabilities in ((numbers, model.PROFILE_PERCENTILES), (shown, model.DESCRIBE_PERCENTILES)):
        if not batch:
            continue
        rows, groups = None, []
        for section, df, columns in batch:
            listed = F.array(*[_named("column_name", c, ranks.observed(F.col(c))) for c in columns])
            part = df.select(F.lit(section).alias("section"), F.inline(listed))
            rows = part if rows is None else rows.unionByName(part)
            groups += [(section, c) for c in columns]
        wide = described(rows, ["section", "column_name"], groups, probabilities)
        order = ("n", "mean", "std", "min", *percentile_names(probabilities), "max")
        parts.append(_long(wide, F.col("section"), F.col("column_name"), order))
    if texts:
        metric = F.coalesce("category", F.lit("null"))
        parts.append(
            top_categories(texts, k, domains).select(
                "section", "column_name", metric.alias("metric"), F.col("n").cast("double").alias("value")
            )
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
