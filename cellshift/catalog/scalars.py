"""Registered queries over the scalar functions."""

from pyspark.sql import functions as F

from cellshift.catalog import binding as b
from cellshift.catalog.experiments import SPECS, joined
from cellshift.catalog.registry import query
from cellshift.functions import cursors, hashing, text
from cellshift.operators import gold

SLUG_SQL = r"""CASE WHEN trim(regexp_replace({0}, '[^\p{{L}}\p{{N}}_-]', '_', 'g'), '_') = '' THEN 'default'
  ELSE trim(regexp_replace({0}, '[^\p{{L}}\p{{N}}_-]', '_', 'g'), '_') END"""


@query(
    "slugs",
    "SELECT event_id, " + SLUG_SQL.format("props") + " AS props_slug, "
    + SLUG_SQL.format("event_type || ' / ' || user_id") + " AS path_slug FROM events",
)
def slugs(spark, sf):
    path = F.concat("event_type", F.lit(" / "), F.col("user_id").cast("string"))
    return b.table(spark, sf, "events").select(
        "event_id", text.slug(F.col("props")).alias("props_slug"), text.slug(path).alias("path_slug")
    )


@query("text_slugs", "SELECT doc_id, " + SLUG_SQL.format("text") + " AS slug FROM documents")
def text_slugs(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", text.slug(F.col("text")).alias("slug"))


@query(
    "compact_tags",
    SPECS
    + r"""
, lists AS (
  SELECT p_brand, list_sort(list_distinct(list_transform(list_filter(list(DISTINCT p_name), lambda v: trim(v) <> ''),
    lambda v: trim(regexp_replace(v, '[^\p{L}\p{N}_-]', '_', 'g'), '_')))) AS s
  FROM part GROUP BY 1)
SELECT p_brand, CASE WHEN len(s) = 0 THEN 'none'
  ELSE rtrim(left(array_to_string(s[1:3], '_') || CASE WHEN len(s) > 3 THEN '_more' ELSE '' END, 63), '') END AS tag
FROM lists""",
)
def compact_tags(spark, sf):
    return gold.group_tags(b.table(spark, sf, "part"), ["p_brand"], F.col("p_name"))


@query(
    "compact_tags_cut",
    r"""
WITH slugs AS (
  SELECT DISTINCT source, trim(regexp_replace(left(text, 40), '[^\p{L}\p{N}_-]', '_', 'g'), '_') AS s
  FROM documents WHERE regexp_matches(left(text, 40), '\S')),
lists AS (SELECT source, list_sort(list(CASE s WHEN '' THEN 'default' ELSE s END)) AS s FROM slugs GROUP BY 1)
SELECT source, CASE WHEN len(j) <= 63 THEN j ELSE rtrim(left(j, 63), '_-.') END AS tag
FROM (SELECT source, array_to_string(s[1:3], '_') || CASE WHEN len(s) > 3 THEN '_more' ELSE '' END AS j FROM lists)""",
)
def compact_tags_cut(spark, sf):
    """Tags of the first 40 characters of each source's documents: longer than a tag may be."""
    return gold.group_tags(b.table(spark, sf, "documents"), ["source"], F.left("text", F.lit(40)))


@query(
    "lineage_tags",
    SPECS
    + """
, v AS (SELECT position, list_sort(list_distinct(list_transform(coalesce(target_cell_types, []),
  lambda x: lower(x)))) AS s FROM specs)
SELECT position, CASE WHEN len(s) = 0 THEN 'none' ELSE array_to_string(s, '_') END AS tag FROM v""",
)
def lineage_tags(spark, sf):
    """Tags of the target lists; an absent list is an empty one."""
    none = F.array().cast("array<string>")
    lists = F.transform(F.coalesce("target_cell_types", none), F.lower)
    return b.specs(spark, sf).select("position", text.compact_tag(lists).alias("tag"))


@query(
    "content_fingerprints",
    """
SELECT event_id, left(sha256(('outputs/' || event_type || '|' || props)), 20) AS fingerprint,
  left(sha256('perturbation_run|' || event_type || '|' || coalesce(NULLIF(user_id % 4, 0)::VARCHAR, '')), 24) AS token
FROM events""",
)
def content_fingerprints(spark, sf):
    part = F.when(F.col("user_id") % 4 != 0, F.col("user_id") % 4)
    return b.table(spark, sf, "events").select(
        "event_id",
        hashing.content_fingerprint(
            F.encode("props", "UTF-8"), F.concat(F.lit("outputs/"), "event_type")
        ).alias("fingerprint"),
        hashing.version_token(F.lit("perturbation_run"), F.col("event_type"), part).alias("token"),
    )


@query(
    "file_fingerprints",
    """
SELECT event_id, CASE WHEN user_id % 6 = 0 THEN 'missing' ELSE left(sha256(
  'outputs/' || event_id || '.h5ad|' || epoch_us(ts) || '000|' || user_id), 20) END AS fingerprint
FROM events""",
)
def file_fingerprints(spark, sf):
    """The hash over path, time and size, taken from the events' own columns."""
    path = F.concat(F.lit("/outputs/"), F.col("event_id").cast("string"), F.lit(".h5ad"))
    size = F.when(F.col("user_id") % 6 != 0, F.col("user_id"))
    modified = F.to_timestamp(F.concat(F.col("ts").cast("string"), F.lit("+00:00")))
    return b.table(spark, sf, "events").select(
        "event_id", hashing.file_fingerprint(text.path_key(path), modified, size).alias("fingerprint")
    )


@query(
    "run_ids",
    """
SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS timed,
  event_type || '__' || left(sha256(props), 12) AS typed,
  event_type || '__' || printf('batch_%04d', user_id) || '__' || left(sha256(props), 12) AS batched,
  printf('exp_%04d', event_id) AS experiment
FROM events""",
)
def run_ids(spark, sf):
    token = F.sha2("props", 256)
    return b.table(spark, sf, "events").select(
        "event_id",
        text.timed_run_id(F.col("ts")).alias("timed"),
        text.typed_run_id(F.col("event_type"), token).alias("typed"),
        text.batch_run_id(
            F.col("event_type"), text.numbered_key("batch", F.col("user_id")), token
        ).alias("batched"),
        text.numbered_key("exp", F.col("event_id")).alias("experiment"),
    )


@query(
    "path_keys",
    r"""
WITH p AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '/' || url || '/' WHEN 1 THEN '\\' || replace(url, '/', '\') || '//'
  ELSE url || '/data.H5AD/' END AS path FROM pages)
SELECT page_id, ltrim(replace(path, '\', '/'), '/') AS path_key, rtrim(replace(path, '\', '/'), '/') AS root_key,
  regexp_extract(rtrim(path, '/'), '[^/]*$') AS last_segment,
  lower(rtrim(replace(path, '\', '/'), '/')) LIKE '%.h5ad' AS is_dataset
FROM p""",
)
def path_keys(spark, sf):
    url, k = F.col("url"), F.col("page_id") % 3
    back = F.replace(url, F.lit("/"), F.lit("\\"))
    path = (
        F.when(k == 0, F.concat(F.lit("/"), url, F.lit("/")))
        .when(k == 1, F.concat(F.lit("\\\\"), back, F.lit("//")))
        .otherwise(F.concat(url, F.lit("/data.H5AD/")))
    )
    return b.table(spark, sf, "pages").select(
        "page_id",
        text.path_key(path).alias("path_key"),
        text.root_key(path).alias("root_key"),
        text.last_segment(path).alias("last_segment"),
        text.is_dataset_file(path).alias("is_dataset"),
    )


@query(
    "alert_texts",
    b.with_sql(b.EVENTS_SQL)
    + """
SELECT storage_id, CASE WHEN passed THEN 'WARN' ELSE 'ERROR' END AS check_severity,
  '[' || coalesce(severity, 'ERROR') || '] ' || coalesce(description, 'Asset check failed.') AS message,
  asset_key || '/' || check_name AS asset
FROM checks""",
)
def alert_texts(spark, sf):
    return b.check_events(spark, sf).select(
        "storage_id",
        text.check_severity(F.col("passed")).alias("check_severity"),
        text.alert_message(F.col("severity"), F.col("description")).alias("message"),
        text.asset_path(F.array("asset_key", "check_name")).alias("asset"),
    )


def _cursor(id_, ts):
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    n = id_.cast("string")
    return (
        F.when(id_ % 6 == 0, n)
        .when(id_ % 6 == 1, F.concat(F.lit('{"id": '), n, F.lit(', "run_updated_after": "'), iso, F.lit('Z"}')))
        .when(id_ % 6 == 2, F.concat(F.lit('{"id": "'), n, F.lit('", "run_updated_after": "'), iso, F.lit('+00:00"}')))
        .when(id_ % 6 == 3, F.lit('{"id": "none", "run_updated_after": "soon"}'))
        .when(id_ % 6 == 4, F.lit("{broken"))
    )


@query(
    "cursors_parsed",
    """
SELECT event_id, CASE WHEN event_id % 6 <= 2 THEN event_id ELSE 0 END AS cursor_id,
  CASE WHEN event_id % 6 IN (1, 2) THEN epoch_us(ts) ELSE 0 END AS cursor_micros
FROM events""",
)
def cursors_parsed(spark, sf):
    """Digits, two JSON forms, bad parts, broken JSON and no cursor at all."""
    cursor = _cursor(F.col("event_id"), F.col("ts"))
    return b.table(spark, sf, "events").select(
        "event_id",
        cursors.cursor_id(cursor).alias("cursor_id"),
        F.unix_micros(cursors.cursor_time(cursor)).alias("cursor_micros"),
    )


@query(
    "cursors_written",
    """
SELECT event_id, '{"id": ' || event_id || ', "run_updated_after": "' || strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
  CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || lpad((epoch_us(ts) % 1000000)::VARCHAR, 6, '0') END
  || '+00:00"}' AS cursor
FROM events""",
)
def cursors_written(spark, sf):
    return b.table(spark, sf, "events").select(
        "event_id", cursors.cursor_text(F.col("event_id"), F.col("ts")).alias("cursor")
    )


@query(
    "lineage_dimensions",
    SPECS
    + """
, t AS (SELECT kind, unnest(target_cell_types) AS v FROM typed),
d AS (SELECT kind, unnest(target_donors) AS v FROM typed)
SELECT kind AS result_set,
  string_agg(DISTINCT perturbation_type, ',' ORDER BY perturbation_type) AS perturbation_types,
  coalesce((SELECT string_agg(DISTINCT v, ',' ORDER BY v) FROM t WHERE t.kind = s.kind), '') AS target_cell_types,
  coalesce((SELECT string_agg(DISTINCT v, ',' ORDER BY v) FROM d WHERE d.kind = s.kind), '') AS target_donors
FROM typed s GROUP BY kind""",
)
def lineage_dimensions(spark, sf):
    sets = b.specs(spark, sf).withColumn(
        "result_set", text.normalized_label(F.col("perturbation_type"))
    )
    return gold.lineage_dimensions(sets, ["result_set"]).select(
        "result_set", joined("perturbation_types"), joined("target_cell_types"), joined("target_donors")
    )


@query(
    "lineage_dimensions_all",
    SPECS
    + """
SELECT (SELECT string_agg(DISTINCT perturbation_type, ',' ORDER BY perturbation_type) FROM specs) AS perturbation_types,
  (SELECT string_agg(DISTINCT v, ',' ORDER BY v) FROM (SELECT unnest(target_cell_types) AS v FROM specs)) AS target_cell_types,
  (SELECT string_agg(DISTINCT v, ',' ORDER BY v) FROM (SELECT unnest(target_donors) AS v FROM specs)) AS target_donors""",
)
def lineage_dimensions_all(spark, sf):
    return gold.lineage_dimensions(b.specs(spark, sf)).select(
        joined("perturbation_types"), joined("target_cell_types"), joined("target_donors")
    )
