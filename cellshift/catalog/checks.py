"""Registered queries over data-quality checks, freshness and the alert feed."""

from pyspark.sql import functions as F

from cellshift.catalog import binding as b
from cellshift.catalog.comparisons import VECTORS, rounded, vector_distances, vector_summary
from cellshift.catalog.experiments import SPECS
from cellshift.catalog.registry import query
from cellshift.functions import cursors
from cellshift.operators import gold, quality
from cellshift.session import shared_path
from cellshift.sources import tables
from cellshift.streaming import alerts, inputs

EVENTS = b.with_sql(b.EVENTS_SQL)


@query(
    "dataset_schema_check",
    """
SELECT true AS passed, true AS ok_cells, true AS ok_genes, '' AS missing_cell_columns, '' AS missing_gene_columns,
  (SELECT count(*) FROM customer) AS n_cells, (SELECT count(*) FROM part) AS n_genes, 'WARN' AS severity""",
)
def dataset_schema_check(spark, sf):
    return quality.dataset_schema_check(b.cells(spark, sf), b.genes(spark, sf))


@query(
    "dataset_schema_check_failing",
    """
SELECT false AS passed, false AS ok_cells, false AS ok_genes, 'donor,batch' AS missing_cell_columns,
  'gene_id' AS missing_gene_columns, (SELECT count(*) FROM customer) AS n_cells,
  (SELECT count(*) FROM part) AS n_genes, 'ERROR' AS severity""",
)
def dataset_schema_check_failing(spark, sf):
    cells = b.cells(spark, sf).drop("donor", "batch")
    return quality.dataset_schema_check(cells, b.genes(spark, sf).drop("gene_id"))


FAILURE_SQL = (
    SPECS
    + """
, m AS (SELECT experiment_id, perturbation_type, position FROM typed),
failed AS (
  SELECT experiment_id, perturbation_type || ':' || experiment_id || ': ' ||
    CASE WHEN position % 9 = 4 THEN 'missing output_embeddings' WHEN position > 3 THEN 'missing embeddings'
      ELSE 'expected width 512, got 64 to 64' END AS failure FROM m)"""
)


def _listed(spark, sf):
    """A manifest that names outputs for most experiments; only four were ever stored."""
    manifest = gold.manifest_records(b.run_specs(spark, sf), b.cells(spark, sf))
    lost = F.col("position") % 9 == 4
    return manifest.withColumn("output_embeddings", F.when(~lost, F.col("output_embeddings")))


@query("embedding_failures", FAILURE_SQL + "SELECT 'run_all' AS run_id, experiment_id, failure FROM failed")
def embedding_failures(spark, sf):
    return quality.embedding_failures(_listed(spark, sf), b.perturbed_vectors(spark, sf), 512)


@query(
    "embedding_shape_check",
    FAILURE_SQL
    + """
SELECT 1::BIGINT AS n_runs, count(*) AS n_experiments, count(*) AS failures_count, false AS passed, 'ERROR' AS severity,
  array_to_string(list_sort(list(failure))[1:10], ';') AS failures FROM failed""",
)
def embedding_shape_check(spark, sf):
    check = quality.embedding_shape_check(_listed(spark, sf), b.perturbed_vectors(spark, sf), 512)
    return check.withColumn("failures", F.array_join("failures", ";"))


# Summaries as JSON: one per event, in a set per user, with some fields left out.
SUMMARIES_SQL = """
WITH s AS (
  SELECT event_id, 'set_' || user_id AS result_set,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place, event_type, value
  FROM events),
lost AS (
  SELECT result_set || ':' || f AS missing FROM s,
    LATERAL (SELECT unnest(CASE event_type WHEN 'error' THEN ['median_distance', 'n_target_cells']
      WHEN 'view' THEN ['experiment_id'] ELSE [] END) AS f))"""


def _summaries(spark, sf):
    kind = F.col("event_type")
    ok = F.struct(
        F.col("event_id").alias("experiment_id"),
        F.col("value").alias("mean_distance"),
        F.lit(None).cast("double").alias("median_distance"),
        F.lit(1).alias("n_target_cells"),
    )
    keep_null = {"ignoreNullFields": "false"}
    json = (
        F.when(kind == "error", F.to_json(ok.dropFields("median_distance", "n_target_cells"), keep_null))
        .when(kind == "view", F.to_json(ok.dropFields("experiment_id"), keep_null))
        .otherwise(F.to_json(ok, keep_null))
    )
    return b.table(spark, sf, "events").select(
        F.concat(F.lit("set_"), F.col("user_id").cast("string")).alias("result_set"),
        "event_id",
        json.alias("summary"),
    )


@query("summary_fields_missing", SUMMARIES_SQL + "SELECT missing FROM lost")
def summary_fields_missing(spark, sf):
    return quality.missing_summary_fields(_summaries(spark, sf), "result_set", "summary")


@query(
    "comparison_manifest_check",
    SUMMARIES_SQL
    + """
SELECT (SELECT count(DISTINCT result_set) FROM s) AS n_result_sets, (SELECT count(*) FROM s) AS n_experiments,
  count(*) AS n_missing, array_to_string(list_sort(list(missing))[1:20], ';') AS missing_fields_sample,
  count(*) = 0 AS passed, 'ERROR' AS severity FROM lost""",
)
def comparison_manifest_check(spark, sf):
    check = quality.comparison_manifest_check(_summaries(spark, sf), "result_set", "summary")
    return check.withColumn("missing_fields_sample", F.array_join("missing_fields_sample", ";"))


@query(
    "first_per_result_set",
    SUMMARIES_SQL + "SELECT result_set, event_id FROM s WHERE place <= 20",
)
def first_per_result_set(spark, sf):
    rows = _summaries(spark, sf).select("result_set", "event_id")
    return quality.first_per_set(rows, "result_set", "event_id", 20)


@query(
    "config_problems",
    SPECS
    + """
SELECT printf('config_%d', position // 10) AS config_file,
  CASE (position // 10) % 3 WHEN 1 THEN 'perturbation_types' ELSE 'perturbations' END AS missing
FROM specs WHERE (position // 10) % 3 <> 0 GROUP BY ALL""",
)
def config_problems(spark, sf):
    """Configs of ten experiments each; a third lack the types, a third the experiments."""
    specs = b.specs(spark, sf).withColumn("run_id", F.lit("all"))
    docs = tables.run_documents(specs, "position", size=10)
    third = F.col("part") % 3
    configs = docs.select(
        F.format_string("config_%d", "part").alias("config_file"),
        F.when(third != 1, F.array(F.lit("gene_knockout"))).alias("perturbation_types"),
        F.when(third != 2, F.col("experiments")).alias("perturbations"),
    )
    return tables.config_problems(configs)


# --- materializations and freshness ------------------------------------------


@query(
    "latest_materializations",
    EVENTS
    + """
SELECT m.* FROM materializations m JOIN (
  SELECT asset, "partition", max(storage_id) AS newest FROM materializations GROUP BY 1, 2) n
ON m.asset = n.asset AND m."partition" = n."partition" AND m.storage_id = n.newest""",
)
def latest_materializations(spark, sf):
    return quality.latest_materializations(b.materializations(spark, sf))


@query(
    "never_materialized",
    EVENTS
    + """
, wanted AS (SELECT DISTINCT e.event_type AS asset, printf('part_%02d', c_nationkey) AS "partition"
  FROM customer, (SELECT DISTINCT event_type FROM events) e)
SELECT * FROM wanted WHERE (asset, "partition") NOT IN (SELECT asset, "partition" FROM materializations)""",
)
def never_materialized(spark, sf):
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    wanted = b.table(spark, sf, "customer").select(
        F.explode(kinds).alias("asset"), F.format_string("part_%02d", "c_nationkey").alias("partition")
    ).distinct()
    return quality.never_materialized(wanted, b.materializations(spark, sf))


@query(
    "freshness",
    EVENTS
    + """
, asked AS (SELECT max(ts) + INTERVAL 5 MINUTE AS now FROM events),
last AS (SELECT 'user_' || user_id AS asset, (user_id % 24 + 1)::INTEGER AS hours, max(ts) AS last_ts FROM events GROUP BY 1, 2)
SELECT asset, hours, last_ts, last_ts + to_hours(hours) >= now AS passed FROM last, asked
UNION ALL SELECT 'user_never', 6, NULL, false""",
)
def freshness(spark, sf):
    """One output per user, each with a window of its own, five minutes after the last event."""
    events = b.table(spark, sf, "events")
    asset = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    windows = events.select(asset.alias("asset"), (F.col("user_id") % 24 + 1).cast("int").alias("hours")).distinct()
    absent = spark.createDataFrame([("user_never", 6)], "asset string, hours int")
    now = events.agg((F.max("ts") + F.expr("INTERVAL 5 MINUTES")).alias("now")).scalar()
    return quality.freshness(events.select(asset.alias("asset"), "ts"), windows.unionByName(absent), now)


# --- alert feed --------------------------------------------------------------

ALERT_SQL = (
    EVENTS
    + """
, alerts AS (
  SELECT 'asset_check_failure_' || storage_id AS run_key, storage_id, ts, asset_key, check_name,
    coalesce(severity, 'ERROR') AS severity,
    '[' || coalesce(severity, 'ERROR') || '] ' || coalesce(description, 'Asset check failed.') AS message,
    'asset_check_failure' AS alert_type
  FROM checks WHERE NOT passed)"""
)


@query("failed_check_alerts", ALERT_SQL + "SELECT * FROM alerts")
def failed_check_alerts(spark, sf):
    return alerts.failed_check_alerts(b.check_events(spark, sf))


@query(
    "alert_log_lines",
    ALERT_SQL
    + "SELECT run_key, 'ASSET CHECK ALERT | asset=' || asset_key || ' check=' || check_name || ' | ' || message AS line FROM alerts",
)
def alert_log_lines(spark, sf):
    return alerts.alert_log_line(failed_check_alerts(spark, sf))


@query(
    "next_events",
    EVENTS + "SELECT storage_id, passed FROM checks WHERE storage_id > 250 ORDER BY storage_id LIMIT 200",
)
def next_events(spark, sf):
    """The next 200 evaluations after the cursor ``250``."""
    last = cursors.cursor_id(F.lit("250"))
    return alerts.events_after(b.check_events(spark, sf), last).select("storage_id", "passed")


@query(
    "next_cursor",
    EVENTS
    + "SELECT max(storage_id) AS cursor FROM (SELECT storage_id FROM checks WHERE storage_id > 250 ORDER BY storage_id LIMIT 200)",
)
def next_cursor(spark, sf):
    return alerts.next_cursor(next_events(spark, sf), 250)


@query("alert_stream", ALERT_SQL + "SELECT * FROM alerts")
def alert_stream(spark, sf):
    """The alerts again, from a file stream that receives every event twice."""
    events = b.check_events(spark, sf).withColumn(
        "ts", F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("+00:00")))
    )
    source, sink = shared_path(spark, "check-events"), shared_path(spark, "alerts")
    events.write.parquet(f"{source}/first")
    events.write.parquet(f"{source}/again")
    stream = alerts.check_event_stream(spark, f"{source}/*", events.schema)
    alerts.deliver_alerts(stream, sink, shared_path(spark, "alerts-cursor")).awaitTermination()
    written = spark.read.parquet(sink).drop("id_block")
    utc = F.to_timestamp_ntz(F.date_format(F.to_utc_timestamp("ts", F.current_timezone()), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return written.withColumn("ts", utc)


@query(
    "batch_key_stream",
    SPECS + "SELECT DISTINCT printf('batch_%04d', position // 7) AS batch_key FROM specs",
)
def batch_key_stream(spark, sf):
    """Keys registered as specs arrive; half of them were registered before."""
    specs = b.specs(spark, sf).select("position")
    source, known = shared_path(spark, "specs"), shared_path(spark, "batch-keys")
    cursor = shared_path(spark, "batch-keys-cursor")
    specs.write.parquet(source)
    old = specs.select(F.format_string("batch_%04d", F.floor(F.col("position") / 14)).alias("batch_key"))
    old.distinct().write.parquet(known)
    alerts.register_batch_keys(spark, source, specs.schema, known, cursor, 7).awaitTermination()
    return spark.read.schema("batch_key string").parquet(known)


@query(
    "changed_inputs",
    """
SELECT 'data/' || event_id || '.h5ad' AS logical_path, epoch_us(ts) || '000:' || user_id AS cursor,
  'ann_data_' || epoch_us(ts) || '000:' || user_id AS run_key
FROM events WHERE event_type NOT IN ('view', 'click')""",
)
def changed_inputs(spark, sf):
    """Files of the events: views are unchanged since the last look, clicks are absent."""
    kind = F.col("event_type")
    ts = F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("+00:00")))
    files = b.table(spark, sf, "events").select(
        F.concat(F.lit("data/"), F.col("event_id").cast("string"), F.lit(".h5ad")).alias("logical_path"),
        ts.alias("modified"),
        F.when(kind != "click", F.col("user_id")).alias("size"),
        kind,
    )
    before = files.withColumn("size", F.when(kind == "view", F.col("size")).otherwise(F.col("size") + 1))
    return alerts.changed_inputs(files, before)


@query(
    "input_change_stream",
    """
WITH looks AS (
  SELECT 'data/' || user_id || '.h5ad' AS logical_path, ts AS seen_at,
    epoch_us(date_trunc('day', ts)) || '000:' || event_id % 2 AS cursor,
    epoch_us(date_trunc('day', ts)) AS micros, event_id % 2 AS size
  FROM events WHERE event_type <> 'click'),
told AS (
  SELECT *, lag(cursor) OVER (PARTITION BY logical_path ORDER BY seen_at, micros, size) AS before FROM looks)
SELECT logical_path, cursor, 'ann_data_' || cursor AS run_key, epoch_us(seen_at) AS seen_at
FROM told WHERE cursor IS DISTINCT FROM before""",
)
def input_change_stream(spark, sf):
    """Events of looks at files, in two runs of the stream: clicks find no file, others some time and size."""
    ts = F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("+00:00")))
    looks = b.table(spark, sf, "events").select(
        F.concat(F.lit("data/"), F.col("user_id").cast("string"), F.lit(".h5ad")).alias("logical_path"),
        F.date_trunc("day", ts).alias("modified"),
        F.when(F.col("event_type") != "click", F.col("event_id") % 2).cast("bigint").alias("size"),
        ts.alias("seen_at"),
    )
    listings, told, cursor = (shared_path(spark, x) for x in ("listings", "input-events", "input-cursor"))
    middle = looks.agg(F.timestamp_micros(F.avg(F.unix_micros("seen_at")).cast("bigint"))).scalar()
    for half in (F.col("seen_at") < middle, F.col("seen_at") >= middle):
        looks.where(half).write.mode("append").parquet(listings)
        inputs.follow_inputs(spark, listings, told, cursor).awaitTermination()
    return spark.read.schema(inputs.EVENT).parquet(told).withColumn("seen_at", F.unix_micros("seen_at"))


# --- gold of comparisons -----------------------------------------------------


def _comparison_records(spark, sf):
    listed = b.vector_specs(spark, sf).withColumn(
        "position", F.regexp_extract("experiment_id", r"(\d+)", 1).cast("bigint")
    )
    specs = listed.withColumn("gene", F.lit(None).cast("bigint")).withColumn(
        "genes", F.lit(None).cast("array<bigint>")
    )
    manifest = gold.manifest_records(specs, b.vector_cells(spark, sf))
    return gold.comparison_records(manifest, rounded(vector_summary(spark, sf)))


CARD_SQL = (
    VECTORS
    + """
, sums AS (
  SELECT experiment_id, round(avg(distance), 6) AS mean_distance,
    round(avg(distance) FILTER (is_target), 6) AS mean_distance_target_subset,
    count(*) FILTER (is_target) AS n_target_cells FROM flagged GROUP BY 1)"""
)


@query(
    "comparison_cards",
    CARD_SQL
    + """
SELECT 'run_all' AS run_id, experiment_id, 'gene_knockout' AS perturbation_type, s.mean_distance,
  s.mean_distance_target_subset, s.n_target_cells,
  array_to_string(coalesce(target_cell_types, []), ',') AS target_cell_types
FROM sums s JOIN vspecs USING (experiment_id)""",
)
def comparison_cards(spark, sf):
    cards = gold.comparison_cards(_comparison_records(spark, sf))
    return cards.select(
        "run_id",
        "experiment_id",
        "perturbation_type",
        "mean_distance",
        "mean_distance_target_subset",
        "n_target_cells",
        F.array_join("target_cell_types", ",").alias("target_cell_types"),
    )


@query(
    "comparison_manifest",
    CARD_SQL
    + """
SELECT 'run_all' AS run_id, count(*) AS n_experiments, 'gene_knockout' AS perturbation_types_defined,
  'cosine_distance' AS metric, 'stored' AS baseline_source FROM sums""",
)
def comparison_manifest(spark, sf):
    specs = b.vector_specs(spark, sf)
    runs = gold.run_manifest(specs, b.vector_cells(spark, sf), b.genes(spark, sf))
    made = gold.comparison_manifest(_comparison_records(spark, sf), runs, "stored")
    return made.withColumn(
        "perturbation_types_defined", F.array_join("perturbation_types_defined", ",")
    )


@query(
    "distance_bundle",
    VECTORS
    + """
SELECT 'run_all' AS run_id, experiment_id, cell_id, round(distance::FLOAT::DOUBLE, 5) AS distance
FROM distances WHERE experiment_id <> 'exp_0001'""",
)
def distance_bundle(spark, sf):
    """Distances of the experiments a manifest lists; one of them lists no distance file."""
    records = b.vector_specs(spark, sf).withColumn(
        "distance_file", F.when(F.col("experiment_id") != "exp_0001", F.lit("per_experiment"))
    )
    bundle = gold.distance_bundle(records, vector_distances(spark, sf))
    return bundle.withColumn("distance", F.round(F.col("distance").cast("double"), 5))
