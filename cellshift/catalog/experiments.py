"""Registered queries over specs, cohorts and matrix changes."""

from pyspark.sql import functions as F

from cellshift.catalog import binding as b
from cellshift.catalog.registry import query
from cellshift.functions.text import normalized_label
from cellshift.operators import cohorts, perturb, specs as sp


def _inputs(spark, sf):
    return b.run_specs(spark, sf), b.cells(spark, sf), b.genes(spark, sf), b.expression(spark, sf)


@query(
    "experiment_summary",
    b.with_sql(b.MATRIX_SQL, b.SPECS_SQL, b.EFFECT_SQL)
    + """
SELECT 'run_all' AS run_id, experiment_id,
  coalesce(n_target_cells, 0) AS n_target_cells, count(gene_symbol) AS n_touched,
  count(*) FILTER (new_value <> old_value) AS n_changed,
  count(*) FILTER (old_value = 0 AND new_value <> 0) AS n_new_non_zero,
  round(coalesce(sum(old_value) FILTER (stored), 0), 6) AS old_sum,
  round(coalesce(sum(new_value) FILTER (stored), 0), 6) AS new_sum
FROM typed
LEFT JOIN (SELECT experiment_id, count(*) AS n_target_cells FROM members GROUP BY 1) USING (experiment_id)
LEFT JOIN (SELECT *, shift IS NOT NULL OR factor <> 1 AS stored FROM touched) USING (experiment_id)
GROUP BY ALL""",
)
def experiment_summary(spark, sf):
    return perturb.perturbation_summary(*_inputs(spark, sf))


SPECS = b.with_sql(b.MATRIX_SQL, b.SPECS_SQL)
DRAFTS = b.with_sql(b.MATRIX_SQL, b.SPECS_SQL, b.DRAFT_SQL)
TOUCHED = b.with_sql(b.MATRIX_SQL, b.SPECS_SQL, b.EFFECT_SQL)


def joined(column: str):
    """A list column as text, null kept, so both engines compare the same value."""
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)


# --- specs -------------------------------------------------------------------


@query(
    "specs_of_one_type",
    SPECS + "SELECT position, perturbation_type FROM typed WHERE kind = 'gene_knockout'",
)
def specs_of_one_type(spark, sf):
    return sp.specs_of_type(b.specs(spark, sf), "gene_knockout").select("position", "perturbation_type")


@query(
    "specs_undeclared",
    DRAFTS
    + """
SELECT position, perturbation_type FROM draft
WHERE coalesce(lower(trim(perturbation_type)), '') NOT IN
  (SELECT kind FROM typed WHERE kind <> 'gene_activation')""",
)
def specs_undeclared(spark, sf):
    """Every type but activation is declared."""
    declared = b.specs(spark, sf).select("perturbation_type").where(
        normalized_label(F.col("perturbation_type")) != "gene_activation"
    )
    return sp.undeclared_specs(b.draft_specs(spark, sf), declared).select("position", "perturbation_type")


@query(
    "types_unsupported",
    DRAFTS
    + """
SELECT DISTINCT lower(trim(perturbation_type)) AS perturbation_type FROM draft
WHERE lower(trim(perturbation_type)) NOT IN ('gene_knockout', 'gene_overexpression', 'gene_activation')""",
)
def types_unsupported(spark, sf):
    return sp.unsupported_types(b.draft_specs(spark, sf).select("perturbation_type"))


@query(
    "specs_invalid",
    DRAFTS
    + """
, named AS (SELECT position, unnest(coalesce(genes, [gene])) AS gene_symbol FROM draft),
hit AS (SELECT DISTINCT position FROM named JOIN genes USING (gene_symbol)),
kinds AS (SELECT position, lower(trim(perturbation_type)) IN
  ('gene_knockout', 'gene_overexpression', 'gene_activation') AS known FROM draft)
SELECT position, 'unknown perturbation_type' AS reason FROM kinds WHERE NOT coalesce(known, false)
UNION ALL
SELECT position, 'no valid gene' FROM kinds WHERE known AND position NOT IN (SELECT position FROM hit)""",
)
def specs_invalid(spark, sf):
    return sp.invalid_specs(b.draft_specs(spark, sf), b.genes(spark, sf))


@query(
    "resolved_genes",
    SPECS + "SELECT 'run_all' AS run_id, experiment_id, gene_symbol FROM known_genes",
)
def resolved_genes(spark, sf):
    return sp.resolved_genes(b.run_specs(spark, sf), b.genes(spark, sf), *sp.KEYS)


@query(
    "experiment_ids_per_typed_run",
    SPECS
    + """
SELECT kind AS run_id, position,
  printf('exp_%04d', row_number() OVER (PARTITION BY kind ORDER BY position) - 1) AS experiment_id
FROM typed""",
)
def experiment_ids_per_typed_run(spark, sf):
    runs = b.specs(spark, sf).withColumn("run_id", normalized_label(F.col("perturbation_type")))
    return sp.renumbered_experiment_ids(runs).select("run_id", "position", "experiment_id")


# --- batches -----------------------------------------------------------------

BATCH = 7


@query(
    "spec_batches",
    SPECS
    + """
SELECT (position // 7)::INTEGER AS batch_index, printf('batch_%04d', position // 7) AS batch_key,
  string_agg(position::VARCHAR, ',' ORDER BY position) AS positions,
  array_to_string(list_sort(list_distinct(list(kind))), ',') AS perturbation_types
FROM typed GROUP BY 1, 2""",
)
def spec_batches(spark, sf):
    return sp.batches(b.specs(spark, sf), BATCH).select(
        "batch_index",
        "batch_key",
        F.array_join(F.col("perturbations.position").cast("array<string>"), ",").alias("positions"),
        joined("perturbation_types"),
    )


@query(
    "batch_lookup",
    SPECS
    + """
, wanted AS (SELECT printf('batch_%04d', c_nationkey) AS batch_key, count(*) AS n_cells FROM customer GROUP BY 1),
found AS (SELECT printf('batch_%04d', position // 7) AS batch_key, (position // 7)::INTEGER AS batch_index,
  count(*) AS n_specs FROM typed GROUP BY 1, 2)
SELECT batch_key, n_cells, batch_index, coalesce(n_specs, 0) AS n_specs FROM wanted LEFT JOIN found USING (batch_key)""",
)
def batch_lookup(spark, sf):
    wanted = (
        b.table(spark, sf, "customer")
        .groupBy(F.format_string("batch_%04d", F.col("c_nationkey").cast("bigint")).alias("batch_key"))
        .agg(F.count(F.lit(1)).alias("n_cells"))
    )
    return sp.batch_by_key(wanted, sp.batches(b.specs(spark, sf), BATCH)).select(
        "batch_key",
        "n_cells",
        "batch_index",
        F.coalesce(F.size("perturbations"), F.lit(0)).cast("bigint").alias("n_specs"),
    )


@query(
    "batch_summary",
    SPECS
    + """
SELECT count(DISTINCT position // 7) AS n_batches, max(position // 7)::INTEGER AS last_batch_index,
  7 AS batch_size FROM typed""",
)
def batch_summary(spark, sf):
    return sp.batch_summary(b.specs(spark, sf), BATCH)


GRID_SQL = (
    SPECS
    + """
, keys AS (SELECT DISTINCT printf('batch_%04d', position // 5) AS batch_key FROM specs),
kinds AS (SELECT unnest(['gene_knockout', 'gene_overexpression', 'gene_activation']) AS perturbation_type),
members7 AS (SELECT printf('batch_%04d', position // 7) AS batch_key, kind AS perturbation_type,
  count(*) AS n_specs FROM typed GROUP BY 1, 2),
status AS (
  SELECT k.perturbation_type, g.batch_key, coalesce(n_specs, 0) AS n_specs,
    CASE WHEN g.batch_key NOT IN (SELECT batch_key FROM members7) THEN 'skipped_missing_batch'
      WHEN n_specs IS NULL THEN 'skipped_no_matching_partition_perturbation_type' ELSE 'run' END AS status
  FROM keys g CROSS JOIN kinds k LEFT JOIN members7 m
  ON m.batch_key = g.batch_key AND m.perturbation_type = k.perturbation_type)"""
)


@query(
    "partition_grid",
    GRID_SQL + "SELECT perturbation_type, batch_key FROM keys CROSS JOIN kinds",
)
def partition_grid(spark, sf):
    """Types by the keys of a finer batching, some of which the batching in force lacks."""
    keys = sp.with_batch(b.specs(spark, sf), 5).select("batch_key").distinct()
    return sp.partition_grid(keys)


@query(
    "partition_status",
    GRID_SQL
    + """
SELECT *, CASE WHEN status = 'run' THEN 'run' ELSE 'skipped_upstream_batch' END AS comparison_status
FROM status""",
)
def partition_status(spark, sf):
    status = sp.partition_status(partition_grid(spark, sf), b.specs(spark, sf), BATCH)
    return sp.comparison_status(status)


@query(
    "typed_run_status",
    DRAFTS
    + """
, kinds AS (SELECT unnest(['gene_knockout', 'gene_overexpression', 'gene_activation']) AS perturbation_type),
n AS (SELECT lower(trim(perturbation_type)) AS perturbation_type, count(*) AS n FROM draft
  WHERE lower(trim(perturbation_type)) <> 'gene_activation' GROUP BY 1)
SELECT perturbation_type, coalesce(n, 0) AS n_experiments, n IS NULL AS skipped,
  CASE WHEN n IS NULL THEN 'skipped_no_matching_specs' ELSE 'run' END AS status
FROM kinds LEFT JOIN n USING (perturbation_type)""",
)
def typed_run_status(spark, sf):
    """A config without activation experiments skips that type."""
    drafts = b.draft_specs(spark, sf)
    return sp.typed_runs(drafts.where(normalized_label(F.col("perturbation_type")) != "gene_activation"))


# --- cohorts -----------------------------------------------------------------


@query(
    "cohort_sizes_execution",
    SPECS
    + """
SELECT 'run_all' AS run_id, experiment_id, coalesce(n, 0) AS n_target_cells FROM typed
LEFT JOIN (SELECT experiment_id, count(*) AS n FROM members GROUP BY 1) USING (experiment_id)""",
)
def cohort_sizes_execution(spark, sf):
    return cohorts.target_cell_counts(b.run_specs(spark, sf), b.cells(spark, sf))


@query(
    "cohort_sizes_comparison",
    SPECS
    + """
SELECT 'run_all' AS run_id, experiment_id, coalesce(n, 0) AS n_target_cells FROM typed
LEFT JOIN (
  SELECT experiment_id, count(*) AS n FROM typed JOIN cells
  ON (coalesce(len(target_donors), 0) = 0 OR list_contains(target_donors, donor))
  AND (coalesce(len(target_cell_types), 0) = 0 OR list_contains(target_cell_types, cell_type))
  GROUP BY 1) USING (experiment_id)""",
)
def cohort_sizes_comparison(spark, sf):
    return cohorts.target_cell_counts(b.run_specs(spark, sf), b.cells(spark, sf), "comparison")


@query("cohort_members", SPECS + "SELECT 'run_all' AS run_id, experiment_id, cell_id FROM members")
def cohort_members(spark, sf):
    return cohorts.cohort_members(b.run_specs(spark, sf), b.cells(spark, sf), "execution")


@query(
    "involved_values",
    SPECS
    + """
SELECT string_agg(DISTINCT donor, ',' ORDER BY donor) AS involved_donors,
  (SELECT string_agg(DISTINCT cell_type, ',' ORDER BY cell_type) FROM cells) AS involved_cell_types
FROM cells""",
)
def involved_values(spark, sf):
    return cohorts.involved_values(b.cells(spark, sf)).select(
        joined("involved_donors"), joined("involved_cell_types")
    )


# --- matrix changes ----------------------------------------------------------


@query(
    "delta_entries",
    TOUCHED
    + """
SELECT 'run_all' AS run_id, experiment_id, cell_id, gene_symbol,
  round(old_value, 6) AS old_value, round(new_value, 6) AS new_value
FROM touched WHERE shift IS NOT NULL OR (factor <> 1 AND value IS NOT NULL)""",
)
def delta_entries(spark, sf):
    return perturb.delta_table(*_inputs(spark, sf), idle=True).select(
        *perturb.ENTRY, F.round("old_value", 6).alias("old_value"), F.round("new_value", 6).alias("new_value")
    )


@query(
    "dense_target_values",
    TOUCHED
    + """
SELECT 'run_all' AS run_id, experiment_id, cell_id, gene_symbol, old_value::DOUBLE AS value
FROM touched WHERE shift IS NOT NULL""",
)
def dense_target_values(spark, sf):
    specs, cells, genes, expression = _inputs(spark, sf)
    shifted = sp.with_effect(specs).where("shift IS NOT NULL")
    return perturb.dense_targets(shifted, cells, genes, expression)


@query(
    "perturbed_matrix",
    TOUCHED
    + """
, chosen AS (SELECT * FROM touched WHERE experiment_id IN ('exp_0002', 'exp_0003')),
ids AS (SELECT unnest(['exp_0002', 'exp_0003']) AS experiment_id)
SELECT 'run_all' AS run_id, experiment_id, cell_id, gene_symbol,
  round(coalesce(new_value, e.value), 6) AS value
FROM (SELECT * FROM ids CROSS JOIN expression) e
FULL JOIN (SELECT experiment_id, cell_id, gene_symbol, new_value FROM chosen) c
USING (experiment_id, cell_id, gene_symbol)
WHERE coalesce(new_value, e.value) <> 0""",
)
def perturbed_matrix(spark, sf):
    """The whole matrix after a shifting and after a knocking-out experiment."""
    specs, cells, genes, expression = _inputs(spark, sf)
    delta = perturb.delta_table(specs, cells, genes, expression)
    chosen = [(b.RUN, "exp_0002"), (b.RUN, "exp_0003")]
    return perturb.perturbed_matrix(chosen, specs, expression, delta).withColumn(
        "value", F.round("value", 6)
    )
