"""Registered queries over the artifact registry, files and round trips."""

from pyspark.sql import functions as F

from cellshift.catalog import binding as b
from cellshift.catalog.comparisons import rounded
from cellshift.catalog.experiments import SPECS, joined
from cellshift.catalog.registry import query
from cellshift.functions.vectors import l2_norm
from cellshift.operators import gold
from cellshift.session import shared_path
from cellshift.sources import registry as reg
from cellshift.sources import tables

EVENTS = b.with_sql(b.EVENTS_SQL)

WANTED_SQL = """
, wanted AS (SELECT 'outputs/' || event_type || '/' || c_custkey % 400 || '.json' AS logical_path
  FROM customer, (SELECT DISTINCT event_type FROM events) GROUP BY 1)"""


def _text_content(df):
    return df.withColumn("content", F.decode("content", "UTF-8"))


def _stored(spark, sf):
    return reg.registry(b.artifact_log(spark, sf))


def _wanted(spark, sf):
    """Paths some of which exist: five kinds of output for up to 400 users."""
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase", "signup", "view")])
    path = F.concat(
        F.lit("\\outputs\\"), "kind", F.lit("/"), F.col("user").cast("string"), F.lit(".json")
    )
    return (
        b.table(spark, sf, "customer")
        .select((F.col("c_custkey") % 400).alias("user"))
        .distinct()
        .select("user", F.explode(kinds).alias("kind"))
        .select(path.alias("logical_path"))
    )


@query("registry_contents", EVENTS + "SELECT * FROM registry")
def registry_contents(spark, sf):
    return _text_content(_stored(spark, sf))


@query(
    "registry_lookup",
    EVENTS + WANTED_SQL + "SELECT logical_path, content, updated_at FROM wanted JOIN registry USING (logical_path)",
)
def registry_lookup(spark, sf):
    return _text_content(reg.lookup(_wanted(spark, sf), _stored(spark, sf)))


@query(
    "registry_existing",
    EVENTS + WANTED_SQL + "SELECT logical_path FROM wanted WHERE logical_path IN (SELECT logical_path FROM registry)",
)
def registry_existing(spark, sf):
    return reg.existing(_wanted(spark, sf), _stored(spark, sf))


@query(
    "artifacts_missing",
    EVENTS + WANTED_SQL + "SELECT logical_path FROM wanted WHERE logical_path NOT IN (SELECT logical_path FROM registry)",
)
def artifacts_missing(spark, sf):
    return reg.missing(_wanted(spark, sf), _stored(spark, sf))


FILES_SQL = """
, files AS (
  SELECT 'outputs/' || CASE WHEN c_custkey % 2 = 0 THEN 'error' ELSE 'file' END || '/' || c_custkey || '.json' AS logical_path,
    c_name AS content, c_nationkey AS n FROM customer),
layers AS (
  SELECT logical_path, coalesce(f.content, r.content) AS content,
    CASE WHEN f.content IS NOT NULL THEN 'file' ELSE 'registry' END AS tier
  FROM files f FULL JOIN registry r USING (logical_path))"""


def _files(spark, sf):
    key = F.col("c_custkey")
    kind = F.when(key % 2 == 0, F.lit("error")).otherwise(F.lit("file"))
    return b.table(spark, sf, "customer").select(
        F.concat(F.lit("/outputs/"), kind, F.lit("/"), key.cast("string"), F.lit(".json")).alias("logical_path"),
        F.encode("c_name", "UTF-8").alias("content"),
        F.timestamp_seconds(F.lit(1_700_000_000) + key).alias("modified"),
        F.col("c_nationkey").alias("size"),
    )


@query("layered_contents", EVENTS + FILES_SQL + "SELECT * FROM layers")
def layered_contents(spark, sf):
    return _text_content(reg.layered(_files(spark, sf), _stored(spark, sf)))


@query(
    "layered_existing",
    EVENTS + WANTED_SQL + FILES_SQL + "SELECT logical_path FROM wanted WHERE logical_path IN (SELECT logical_path FROM layers)",
)
def layered_existing(spark, sf):
    return reg.layered_existing(_wanted(spark, sf), _files(spark, sf), _stored(spark, sf))


@query(
    "artifact_fingerprints",
    EVENTS
    + FILES_SQL
    + """
SELECT l.logical_path, left(sha256(CASE WHEN tier = 'file'
  THEN l.logical_path || '|' || (1700000000 + regexp_extract(l.logical_path, '([0-9]+)\\.json', 1)::BIGINT) || '000000000|' || n
  ELSE l.logical_path || '|' || l.content END), 20) AS fingerprint
FROM layers l LEFT JOIN files f USING (logical_path)""".replace("\\\\", "\\"),
)
def artifact_fingerprints(spark, sf):
    files = _files(spark, sf)
    return reg.artifact_fingerprints(reg.layered(files, _stored(spark, sf)), files)


# --- round trips through files -----------------------------------------------


@query("dataset_round_trip", b.with_sql(b.MATRIX_SQL) + "SELECT cell_id, cell_type, gene_symbol, chromosome, value FROM expression JOIN cells USING (cell_id) JOIN genes USING (gene_symbol)")
def dataset_round_trip(spark, sf):
    parts = (b.cells(spark, sf), b.genes(spark, sf), b.expression(spark, sf))
    path = shared_path(spark, "dataset")
    tables.write_dataset(path, *parts)
    schemas = dict(zip(("cells", "genes", "expression"), [p.schema for p in parts]))
    cells, genes, expression = tables.read_dataset(spark, path, schemas)
    return (
        expression.join(cells.select("cell_id", "cell_type"), "cell_id")
        .join(genes.select("gene_symbol", "chromosome"), "gene_symbol")
        .select("cell_id", "cell_type", "gene_symbol", "chromosome", "value")
    )


@query(
    "config_round_trip",
    SPECS
    + """
SELECT (position // 50)::INTEGER AS part, (position % 50)::INTEGER AS position, perturbation_type, gene::VARCHAR AS gene,
  array_to_string(genes, ',') AS genes, fold_change, delta,
  array_to_string(target_donors, ',') AS target_donors, array_to_string(target_cell_types, ',') AS target_cell_types
FROM specs""",
)
def config_round_trip(spark, sf):
    """Specs written as config documents of 50 experiments and read back in list order.

    Config files stand for separate configs, so positions start again in each.
    """
    specs = b.specs(spark, sf)
    fields = [c for c in specs.columns if c != "position"]
    docs = tables.run_documents(specs.withColumn("run_id", F.lit("all")), "position", size=50)
    configs = docs.select(
        F.lit(list(("gene_knockout", "gene_overexpression", "gene_activation"))).alias("perturbation_types"),
        F.col("experiments").alias("perturbations"),
        "part",
    )
    path = shared_path(spark, "configs")
    configs.write.partitionBy("part").option("ignoreNullFields", "false").json(path)
    read = tables.read_config(spark, f"{path}/part=*/*.json")
    out = tables.config_specs(read)
    part = F.regexp_extract("config_file", r"part=(\d+)", 1).cast("int")
    return out.select(
        part.alias("part"),
        "position",
        *[joined(f) if f in ("genes", "target_donors", "target_cell_types") else f for f in fields],
    )


@query(
    "embeddings_round_trip",
    b.with_sql(b.VECTOR_SQL)
    + """
SELECT 'run_all' AS run_id, experiment_id, cell_id, len(a) AS width, round(sqrt(list_dot_product(a, a)), 6) AS norm
FROM vectors""",
)
def embeddings_round_trip(spark, sf):
    """Vectors of a run written by experiment and read back as one bundle."""
    vectors = b.perturbed_vectors(spark, sf)
    path = shared_path(spark, "embeddings")
    tables.write_embeddings(path, vectors)
    read = tables.read_embeddings(spark, path, b.RUN, schema=vectors.schema)
    return rounded(
        read.select(
            "run_id",
            "experiment_id",
            "cell_id",
            F.size("embedding").cast("bigint").alias("width"),
            l2_norm(F.col("embedding")).alias("norm"),
        )
    )


@query(
    "embeddings_of_one_experiment",
    b.with_sql(b.VECTOR_SQL)
    + "SELECT 'run_all' AS run_id, experiment_id, cell_id, round(a[1], 6) AS first FROM vectors WHERE experiment_id = 'exp_0002'",
)
def embeddings_of_one_experiment(spark, sf):
    vectors = b.perturbed_vectors(spark, sf)
    path = shared_path(spark, "embeddings")
    tables.write_embeddings(path, vectors)
    read = tables.read_embeddings(spark, path, b.RUN, "exp_0002", vectors.schema)
    return read.select(
        "run_id", "experiment_id", "cell_id", F.round(F.col("embedding")[0].cast("double"), 6).alias("first")
    )


RECORDS_SQL = """
, involved AS (SELECT string_agg(DISTINCT donor, ',' ORDER BY donor) AS involved_donors,
  (SELECT string_agg(DISTINCT cell_type, ',' ORDER BY cell_type) FROM cells) AS involved_cell_types FROM cells),
hits AS (SELECT experiment_id, count(*) AS n FROM members GROUP BY 1),
records AS (
  SELECT 'run_all' AS run_id, experiment_id, perturbation_type, gene, array_to_string(genes, ',') AS genes,
    involved_donors, involved_cell_types, array_to_string(coalesce(target_donors, []), ',') AS target_donors,
    array_to_string(coalesce(target_cell_types, []), ',') AS target_cell_types,
    coalesce(n, 0) AS n_target_cells, 'silver/embeddings/run_id=run_all' AS output_embeddings
  FROM typed CROSS JOIN involved LEFT JOIN hits USING (experiment_id))"""

LISTS = ("genes", "involved_donors", "involved_cell_types", "target_donors", "target_cell_types")


def flat_lists(df):
    return df.select(*[joined(c) if c in LISTS else c for c in df.columns])


def _manifest(spark, sf):
    return gold.manifest_records(b.run_specs(spark, sf), b.cells(spark, sf))


@query("manifest_records", SPECS + RECORDS_SQL + "SELECT * FROM records")
def manifest_records(spark, sf):
    return flat_lists(_manifest(spark, sf).drop("position"))


@query(
    "ui_records",
    SPECS + RECORDS_SQL + "SELECT * EXCLUDE (output_embeddings) FROM records",
)
def ui_records(spark, sf):
    return flat_lists(gold.ui_records(_manifest(spark, sf)).drop("position"))


@query(
    "experiment_metadata",
    SPECS
    + RECORDS_SQL
    + """
SELECT run_id, experiment_id, r.perturbation_type, delta, fold_change,
  (SELECT count(*) FROM cells) AS n_rows, 512::BIGINT AS width, r.n_target_cells
FROM records r JOIN typed USING (experiment_id)""",
)
def experiment_metadata(spark, sf):
    """The applied spec travels with the experiment's shape and cohort."""
    made = gold.experiment_metadata(b.run_specs(spark, sf), b.cells(spark, sf), b.DIM)
    return made.select(
        "run_id",
        "experiment_id",
        "perturbation_spec.perturbation_type",
        "perturbation_spec.delta",
        "perturbation_spec.fold_change",
        F.col("embedding_shape")[0].alias("n_rows"),
        F.col("embedding_shape")[1].alias("width"),
        "n_target_cells",
    )


@query(
    "run_manifest",
    SPECS
    + """
SELECT 'run_all' AS run_id, (SELECT count(*) FROM cells) AS n_cells, (SELECT count(*) FROM genes) AS n_genes,
  string_agg(DISTINCT perturbation_type, ',' ORDER BY perturbation_type) AS perturbation_types_defined,
  count(*) AS n_experiments
FROM typed""",
)
def run_manifest(spark, sf):
    made = gold.run_manifest(b.run_specs(spark, sf), b.cells(spark, sf), b.genes(spark, sf))
    return made.withColumn(
        "perturbation_types_defined", F.array_join("perturbation_types_defined", ",")
    )


@query(
    "run_documents",
    SPECS
    + RECORDS_SQL
    + """
SELECT r.* EXCLUDE (output_embeddings, gene), r.gene, (position // 40)::INTEGER AS part,
  (SELECT count(*) FROM cells) AS n_cells, (SELECT count(*) FROM genes) AS n_genes,
  (SELECT count(*) FROM typed) AS n_experiments
FROM records r JOIN typed USING (experiment_id)""",
)
def run_documents(spark, sf):
    """UI records nested under their run, written as JSON documents and read back."""
    manifest = _manifest(spark, sf)
    metadata = gold.run_manifest(b.run_specs(spark, sf), b.cells(spark, sf), b.genes(spark, sf))
    docs = tables.run_documents(gold.ui_records(manifest), "position", metadata, size=40)
    path = shared_path(spark, "documents")
    tables.write_documents(path, docs)
    read = tables.read_documents(spark, path, docs.schema)
    keep = ("run_id", "part", "run_metadata")
    return flat_lists(
        tables.document_records(read, keep)
        .select("*", "run_metadata.n_cells", "run_metadata.n_genes", "run_metadata.n_experiments")
        .drop("run_metadata")
    )
