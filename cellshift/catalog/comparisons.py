"""Registered queries over embeddings, distances and comparison summaries."""

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cellshift.catalog import binding as b
from cellshift.catalog.registry import query
from cellshift.functions.vectors import l2_norm
from cellshift.operators import compare, embed
from cellshift.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VECTORS = b.with_sql(b.VECTOR_SQL)


def rounded(df, digits: int = 6):
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else f.name
            for f in df.schema.fields
        ]
    )


def vector_distances(spark, sf):
    base = b.baseline_vectors(spark, sf)
    return compare.distances(b.perturbed_vectors(spark, sf), base, compare.vector_bytes(base))


@query(
    "vector_norms",
    "SELECT vec_id AS cell_id, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm FROM embeddings",
)
def vector_norms(spark, sf):
    return rounded(b.baseline_vectors(spark, sf).select("cell_id", l2_norm(F.col("embedding")).alias("norm")))


@query(
    "cosine_distances",
    VECTORS + "SELECT 'run_all' AS run_id, experiment_id, cell_id, round(distance, 6) AS distance FROM distances",
)
def cosine_distances(spark, sf):
    return rounded(vector_distances(spark, sf))


@query(
    "target_flags",
    VECTORS + "SELECT 'run_all' AS run_id, experiment_id, cell_id, round(distance, 6) AS distance, is_target FROM flagged",
)
def target_flags(spark, sf):
    return rounded(
        compare.with_target_flag(vector_distances(spark, sf), b.vector_cells(spark, sf), b.vector_specs(spark, sf))
    )


SUMMARY_SQL = """
  count(*) AS n_cells, count(*) FILTER (is_target) AS n_target_cells,
  round(avg(distance), 6) AS mean_distance, round(median(distance), 6) AS median_distance,
  round(stddev_pop(distance), 6) AS std_distance, round(min(distance), 6) AS min_distance,
  round(max(distance), 6) AS max_distance,
  round(avg(distance) FILTER (is_target), 6) AS mean_distance_target_subset,
  round(median(distance) FILTER (is_target), 6) AS median_distance_target_subset"""


def vector_summary(spark, sf):
    flagged = compare.with_target_flag(
        vector_distances(spark, sf), b.vector_cells(spark, sf), b.vector_specs(spark, sf)
    )
    return compare.distance_summary(flagged)


@query(
    "distance_summaries",
    VECTORS + "SELECT 'run_all' AS run_id, experiment_id," + SUMMARY_SQL + " FROM flagged GROUP BY 2",
)
def distance_summaries(spark, sf):
    return rounded(vector_summary(spark, sf))


@query(
    "missing_embeddings",
    b.with_sql(b.MATRIX_SQL, b.SPECS_SQL)
    + """
SELECT 'run_all' AS run_id, experiment_id FROM typed
WHERE experiment_id NOT IN ('exp_0000', 'exp_0001', 'exp_0002', 'exp_0003')""",
)
def missing_embeddings(spark, sf):
    return compare.missing_embeddings(b.run_specs(spark, sf), b.perturbed_vectors(spark, sf))


def _broken_vectors(spark, sf):
    """Perturbed vectors of four runs: whole, with rows missing, of other width, of unknown cells."""
    base = b.perturbed_vectors(spark, sf)
    e, cell = F.col("experiment_id"), F.col("cell_id")
    return base.where((e != "exp_0001") | (cell % 7 != 3)).select(
        "run_id",
        "experiment_id",
        F.when((e == "exp_0003") & (cell % 11 == 0), -1 - cell).otherwise(cell).alias("cell_id"),
        F.when((e == "exp_0002") & (cell % 5 == 0), F.slice("embedding", 1, 32))
        .otherwise(F.col("embedding"))
        .alias("embedding"),
    )


@query(
    "shape_problems",
    """
WITH c AS (SELECT vec_id, count(*) OVER () AS n FROM embeddings),
p AS (
  SELECT 'exp_0001' AS experiment_id, count(*) FILTER (vec_id % 7 <> 3) AS n_matched, 0 AS n_unmatched,
    0 AS n_width_differs, count(*) FILTER (vec_id % 7 = 3) AS n_absent FROM c
  UNION ALL
  SELECT 'exp_0002', count(*), 0, count(*) FILTER (vec_id % 5 = 0), 0 FROM c
  UNION ALL
  SELECT 'exp_0003', count(*) FILTER (vec_id % 11 <> 0), count(*) FILTER (vec_id % 11 = 0), 0,
    count(*) FILTER (vec_id % 11 = 0) FROM c)
SELECT 'run_all' AS run_id, * FROM p""",
)
def shape_problems(spark, sf):
    return compare.shape_problems(_broken_vectors(spark, sf), b.baseline_vectors(spark, sf))


@query(
    "baseline_width",
    "SELECT count(*) AS n_rows, count(*) FILTER (len(embedding) <> 512) AS n_wrong_width,"
    " count(*) FILTER (len(embedding) <> 512) = 0 AS passed FROM embeddings",
)
def baseline_width(spark, sf):
    return compare.baseline_width_problems(b.baseline_vectors(spark, sf), 512)


# --- built-in model and the whole chain --------------------------------------

DIMS_SQL = f"""
dims AS (SELECT unnest(range({b.DIM})) AS d),
codes AS (SELECT gene_symbol, (('0x' || substr(md5(gene_symbol::VARCHAR), 1, 6))::BIGINT * 7919 + {{seed}}) % {embed.MODULUS} AS code
  FROM genes),
weights AS (SELECT gene_symbol, d, ((code + d * {embed.STEP}) % {embed.MODULUS}) / {embed.MODULUS}::DOUBLE - 0.5 AS w FROM codes CROSS JOIN dims)"""

BASE_SQL = """
base AS (
  SELECT cell_id, d, coalesce(v, 0) AS v FROM (SELECT cell_id, d FROM cells CROSS JOIN dims)
  LEFT JOIN (
    SELECT cell_id, d, sum(ln(1 + value) * w) AS v FROM expression JOIN weights USING (gene_symbol) GROUP BY 1, 2)
  USING (cell_id, d))"""


@query(
    "baseline_embeddings",
    b.with_sql(b.MATRIX_SQL, DIMS_SQL.format(seed=331), BASE_SQL)
    + """
SELECT cell_id, (d // 64)::INTEGER AS block, round(sum(v), 4) AS total,
  round(sum(v * (d % 64 + 1)), 3) AS by_position FROM base GROUP BY 1, 2""",
)
def baseline_embeddings(spark, sf):
    vectors = embed.baseline_embeddings(
        b.cells(spark, sf), b.expression(spark, sf), b.DIM, "mock_foundation_model_2"
    )
    d = F.col("d")
    return (
        vectors.select("cell_id", F.posexplode("vector").alias("d", "v"))
        .groupBy("cell_id", F.floor(d / 64).cast("int").alias("block"))
        .agg(F.round(F.sum("v"), 4).alias("total"), F.round(F.sum(F.col("v") * (d % 64 + 1)), 3).alias("by_position"))
    )


def value_sums(genes, values):
    """A user model: per cell the sum, the largest and the number of values, and a gene sum."""
    return np.array(
        [[v.sum(), v.max(initial=0.0), len(v), float((g % 97).sum())] for g, v in zip(genes, values)]
    )


@query(
    "user_model_embeddings",
    b.with_sql(b.MATRIX_SQL)
    + """
SELECT c.c_custkey AS cell_id, coalesce(sum(value), 0)::BIGINT AS value_sum,
  coalesce(max(value), 0)::BIGINT AS value_max,
  count(value) AS n, coalesce(sum(gene_symbol % 97), 0)::BIGINT AS gene_sum
FROM customer c LEFT JOIN expression e ON e.cell_id = c.c_custkey GROUP BY 1""",
)
def user_model_embeddings(spark, sf):
    out = embed.embed_with(b.expression(spark, sf), ["cell_id"], value_sums, 4, b.cells(spark, sf))
    names = ("value_sum", "value_max", "n", "gene_sum")
    return out.select(
        "cell_id", *[F.col("embedding")[i].cast("bigint").alias(n) for i, n in enumerate(names)]
    )


FLAGS_SQL = """
flags AS (
  SELECT f.experiment_id, f.cell_id, distance,
    (coalesce(len(target_donors), 0) = 0 OR list_contains(target_donors, donor))
    AND (coalesce(len(target_cell_types), 0) = 0 OR list_contains(target_cell_types, cell_type)) AS is_target
  FROM far f JOIN typed USING (experiment_id) JOIN cells c ON c.cell_id = f.cell_id)"""

MOVES_SQL = """
moves AS (
  SELECT experiment_id, cell_id, d, sum((ln(1 + new_value) - ln(1 + old_value)) * w) AS v
  FROM touched JOIN weights USING (gene_symbol) GROUP BY 1, 2, 3)"""


def chain_sql(stored_as: str = "DOUBLE", against: str = "b.b") -> str:
    """Specs to flagged distances; ``stored_as`` is the type vectors are kept in, ``against`` the other vector."""
    return b.with_sql(
        b.MATRIX_SQL,
        b.SPECS_SQL,
        b.EFFECT_SQL,
        DIMS_SQL.format(seed=0),
        BASE_SQL,
        MOVES_SQL,
        f"""
kept AS (SELECT cell_id, d, v::{stored_as}::DOUBLE AS b FROM base),
pairs AS (
  SELECT b.experiment_id, b.cell_id, (b.b + coalesce(m.v, 0))::{stored_as}::DOUBLE AS a, ({against})::{stored_as}::DOUBLE AS o
  FROM (SELECT experiment_id, k.* FROM typed CROSS JOIN kept k) b LEFT JOIN moves m USING (experiment_id, cell_id, d)),
after AS (
  SELECT experiment_id, cell_id, sum(a * o) AS ab, sqrt(sum(a * a)) AS na, sqrt(sum(o * o)) AS nb FROM pairs GROUP BY 1, 2),
far AS (
  SELECT experiment_id, cell_id, 1 - greatest(-1, least(1, ab / greatest(na * nb, 1e-8))) AS distance FROM after)""",
        FLAGS_SQL,
    )


CHAIN_SQL = chain_sql() + "SELECT 'run_all' AS run_id, experiment_id, " + SUMMARY_SQL + " FROM flags GROUP BY 2"


def chain(spark, sf):
    specs, cells, genes = b.run_specs(spark, sf), b.cells(spark, sf), b.genes(spark, sf)
    expression = stored(b.expression(spark, sf), "matrix")
    baseline = stored(embed.baseline_embeddings(cells, expression, b.DIM), "baseline")
    changed = embed.perturbed_embeddings(specs, cells, genes, expression, baseline, b.DIM, measured=True)
    dist = stored(compare.changed_distances(changed, cells, specs), "distances")
    return compare.changed_summary(dist, baseline, cells, specs)


@query("experiment_comparison", CHAIN_SQL)
def experiment_comparison(spark, sf):
    """Specs to matrix changes to embeddings to distances to summaries, all experiments at once."""
    return rounded(chain(spark, sf))
