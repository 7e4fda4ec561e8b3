"""Registered queries that profile the dataset."""

from pyspark.sql import functions as F

from cellshift import model
from cellshift.catalog import binding as b
from cellshift.catalog.registry import query
from cellshift.operators import profile as pr

MATRIX = b.with_sql(b.MATRIX_SQL)
TOTALS = (
    MATRIX
    + """
, cell_sums AS (
  SELECT c.cell_id, coalesce(sum(value), 0)::DOUBLE AS total, count(*) FILTER (value > 0) AS detected
  FROM cells c LEFT JOIN expression e ON c.cell_id = e.cell_id GROUP BY 1),
gene_sums AS (
  SELECT g.gene_symbol, coalesce(sum(value), 0)::DOUBLE AS total, count(*) FILTER (value > 0) AS detected
  FROM genes g LEFT JOIN expression e ON g.gene_symbol = e.gene_symbol GROUP BY 1)"""
)


def _describe_sql(source: str, column: str, probabilities) -> str:
    names = pr.percentile_names(probabilities)
    points = ", ".join(
        f"round(quantile_cont({column}::DOUBLE, {p}), 6) AS {n}" for p, n in zip(probabilities, names)
    )
    return (
        f"SELECT count({column}) AS n, round(avg({column}), 6) AS mean,"
        f" round(stddev_samp({column}), 6) AS std, min({column})::DOUBLE AS min, {points},"
        f" max({column})::DOUBLE AS max FROM {source}"
    )


def _rounded(df):
    return df.select(
        *[
            F.round(f.name, 6).alias(f.name) if f.dataType.simpleString() == "double" else f.name
            for f in df.schema.fields
        ]
    )


def _matrix(spark, sf):
    return b.cells(spark, sf), b.genes(spark, sf), b.expression(spark, sf)


@query(
    "dataset_shape",
    "SELECT (SELECT count(*) FROM customer) AS n_cells, (SELECT count(*) FROM part) AS n_genes",
)
def dataset_shape(spark, sf):
    return pr.dataset_shape(b.cells(spark, sf), b.genes(spark, sf))


OVERVIEW_SQL = """
, o AS (SELECT (SELECT count(*) FROM cells) AS n_cells, (SELECT count(*) FROM genes) AS n_genes,
  count(*) AS non_zero, min(value) AS low, max(value) AS high FROM expression WHERE value <> 0)
SELECT n_cells, n_genes, non_zero, round(non_zero / (n_cells * n_genes), 6) AS density,
  round(1 - non_zero / (n_cells * n_genes), 6) AS sparsity, {low} AS min_value, high::DOUBLE AS max_value
FROM o"""


@query("matrix_overview_sparse", MATRIX + OVERVIEW_SQL.format(low="low::DOUBLE"))
def matrix_overview_sparse(spark, sf):
    return _rounded(pr.matrix_overview(*_matrix(spark, sf)))


@query("matrix_overview_dense", MATRIX + OVERVIEW_SQL.format(low="least(low, 0)::DOUBLE"))
def matrix_overview_dense(spark, sf):
    return _rounded(pr.matrix_overview(*_matrix(spark, sf), zeros_in_range=True))


@query("cell_totals", TOTALS + "SELECT * FROM cell_sums")
def cell_totals(spark, sf):
    return pr.cell_totals(b.cells(spark, sf), b.expression(spark, sf))


@query("gene_totals", TOTALS + "SELECT * FROM gene_sums")
def gene_totals(spark, sf):
    return pr.gene_totals(b.genes(spark, sf), b.expression(spark, sf))


def _register_describes() -> None:
    for side, source in (("cell", "cell_sums"), ("gene", "gene_sums")):
        for column in ("total", "detected"):

            def run(spark, sf, side=side, column=column):
                cells, genes, expression = _matrix(spark, sf)
                totals = (
                    pr.cell_totals(cells, expression)
                    if side == "cell"
                    else pr.gene_totals(genes, expression)
                )
                return _rounded(pr.describe(totals, column))

            query(
                f"describe_{side}_{column}",
                TOTALS + _describe_sql(source, column, model.PROFILE_PERCENTILES),
            )(run)


_register_describes()


@query(
    "describe_numeric_column",
    _describe_sql("customer", "c_acctbal", model.DESCRIBE_PERCENTILES),
)
def describe_numeric_column(spark, sf):
    return _rounded(pr.describe(b.table(spark, sf, "customer"), "c_acctbal", model.DESCRIBE_PERCENTILES))


WITH_NAN_SQL = """
WITH x AS (
  SELECT CASE WHEN l_orderkey % 17 = 3 THEN NULL WHEN l_orderkey % 17 = 5 THEN NULL
    WHEN l_linenumber = 7 THEN -l_extendedprice ELSE l_extendedprice * (1 - l_discount) END AS price
  FROM lineitem)
"""


@query("describe_with_nan", WITH_NAN_SQL + _describe_sql("x", "price", model.PROFILE_PERCENTILES))
def describe_with_nan(spark, sf):
    """Every line's price, of which some are null, some NaN and some negative."""
    order, price = F.col("l_orderkey"), F.col("l_extendedprice")
    lines = b.table(spark, sf, "lineitem").select(
        F.when(order % 17 == 3, F.lit(float("nan")))
        .when(order % 17 == 5, F.lit(None))
        .when(F.col("l_linenumber") == 7, -price)
        .otherwise(price * (1 - F.col("l_discount")))
        .alias("price")
    )
    return _rounded(pr.describe(lines, "price"))


@query(
    "category_counts",
    """
SELECT category, sum(n)::BIGINT AS n FROM (
  SELECT p_brand AS category, 1 AS n FROM part UNION ALL
  SELECT 'Brand#' || r_regionkey * 10, 0 FROM region)
GROUP BY 1 ORDER BY n DESC, category LIMIT 20""",
)
def category_counts(spark, sf):
    """Chromosomes of all genes; the domain also names categories that never occur."""
    domain = b.table(spark, sf, "region").select(
        F.concat(F.lit("Brand#"), (F.col("r_regionkey") * 10).cast("string")).alias("category")
    )
    return pr.category_counts(b.genes(spark, sf), "chromosome", 20, domain)


@query(
    "flag_counts",
    "SELECT p_size >= 10 AS flag, count(*) AS n FROM part GROUP BY 1",
)
def flag_counts(spark, sf):
    return pr.flag_counts(b.genes(spark, sf), "is_target_gene")


@query(
    "size_factors",
    TOTALS
    + """
SELECT cell_id, round(total / (SELECT median(total) FROM cell_sums), 6) AS size_factor FROM cell_sums""",
)
def size_factors(spark, sf):
    return _rounded(pr.size_factors(pr.cell_totals(b.cells(spark, sf), b.expression(spark, sf))))


@query(
    "size_factors_with_empty_cells",
    TOTALS
    + """
, all_cells AS (
  SELECT cell_id, total FROM cell_sums UNION ALL
  SELECT -vec_id - 1, CASE WHEN vec_id % 5 <> 2 THEN 0.0::DOUBLE END FROM embeddings)
SELECT cell_id, round(total / nullif((SELECT median(total) FROM all_cells), 0), 6) AS size_factor FROM all_cells""",
)
def size_factors_with_empty_cells(spark, sf):
    """Also cells without any entry, and some whose total is NaN."""
    totals = pr.cell_totals(b.cells(spark, sf), b.expression(spark, sf)).select("cell_id", "total")
    vec = F.col("vec_id")
    empty = b.table(spark, sf, "embeddings").select(
        (-vec - 1).alias("cell_id"), F.when(vec % 5 == 2, F.lit(float("nan"))).otherwise(F.lit(0.0)).alias("total")
    )
    return _rounded(pr.size_factors(totals.unionByName(empty)))


@query(
    "cell_effects",
    MATRIX
    + """
, by_type AS (SELECT c_mktsegment AS cell_type, avg(c_acctbal) / 1000 AS effect FROM customer GROUP BY 1),
by_donor AS (SELECT printf('donor_%02d', s_nationkey + 1) AS donor, avg(s_acctbal) / 1000 AS effect
  FROM supplier GROUP BY 1),
by_batch AS (SELECT printf('batch_%02d', c_custkey % 4 + 1) AS batch, avg(c_acctbal) / 1000 AS effect
  FROM customer GROUP BY 1)
SELECT cell_id, round(t.effect * coalesce(d.effect, 1) * bb.effect, 6) AS effect
FROM cells LEFT JOIN by_type t USING (cell_type) LEFT JOIN by_donor d USING (donor)
LEFT JOIN by_batch bb USING (batch)""",
)
def cell_effects(spark, sf):
    """Product of a cell-type, a donor and a batch factor for every cell."""
    cells = b.cells(spark, sf)
    customer = b.table(spark, sf, "customer").withColumnRenamed("c_custkey", "cell_id")
    known = customer.select("cell_id", "c_acctbal").join(cells, "cell_id")
    effect = (F.avg("c_acctbal") / 1000).alias("effect")
    donors = (
        b.table(spark, sf, "supplier")
        .groupBy(F.format_string("donor_%02d", F.col("s_nationkey") + 1).alias("donor"))
        .agg((F.avg("s_acctbal") / 1000).alias("effect"))
    )
    effects = {
        "cell_type": known.groupBy("cell_type").agg(effect),
        "donor": donors,
        "batch": known.groupBy("batch").agg(effect),
    }
    return pr.with_effects(cells, effects).select("cell_id", F.round("effect", 6).alias("effect"))


@query("first_cells", MATRIX + "SELECT * FROM cells ORDER BY cell_id LIMIT 5")
def first_cells(spark, sf):
    return pr.first_rows(b.cells(spark, sf), "cell_id")


@query("first_genes", MATRIX + "SELECT * FROM genes ORDER BY gene_symbol LIMIT 5")
def first_genes(spark, sf):
    return pr.first_rows(b.genes(spark, sf), "gene_symbol")


def _profile_sql() -> str:
    def long(section, column, source, columns):
        rows = ", ".join(f"('{c}', {c}::DOUBLE)" for c in columns)
        return (
            f"SELECT '{section}' AS section, '{column}' AS column_name, metric, value "
            f"FROM ({source}), LATERAL (VALUES {rows}) v(metric, value)"
        )

    names = pr.percentile_names(model.PROFILE_PERCENTILES)
    numbers = ["n", "mean", "std", "min", *names, "max"]
    overview = ["n_cells", "n_genes", "non_zero", "density", "sparsity", "min_value", "max_value"]
    parts = [long("matrix", "value", "SELECT * FROM overview", overview)]
    for section, source in (("cell", "cell_sums"), ("gene", "gene_sums")):
        for column in ("total", "detected"):
            parts.append(
                long(section, column, _describe_sql(source, column, model.PROFILE_PERCENTILES), numbers)
            )
    for section, columns in (
        ("cells", ("cell_type", "donor", "batch")),
        ("genes", ("chromosome", "gene_id", "is_target_gene")),
    ):
        for column in columns:
            parts.append(
                f"(SELECT '{section}', '{column}', {column}::VARCHAR, count(*)::DOUBLE "
                f"FROM {section} GROUP BY 3 ORDER BY 4 DESC, 3 LIMIT 20)"
            )
    head = TOTALS + ", overview AS (" + OVERVIEW_SQL.format(low="low::DOUBLE").replace(", o AS", "WITH o AS") + ")"
    return head + "\nUNION ALL\n".join(parts)


@query("dataset_profile", _profile_sql())
def dataset_profile(spark, sf):
    return _rounded(pr.dataset_profile(*_matrix(spark, sf)))
