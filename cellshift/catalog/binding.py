"""The data model bound to the driver's tables, in Spark and as oracle SQL.

cells come from customer, genes from part, the matrix from orders and lineitem,
experiments from supplier, embeddings from embeddings, check events and
materializations from events.  Each binding reads its whole table, so the work
of every query grows with the data.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellshift import model
from cellshift.operators.specs import with_experiment_ids

RUN = "run_all"
DIM = model.EMBEDDING_DIM  # width of the projected embedding in the registered queries

# Fixed value: the market segments of the driver's customer table.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# --- cells, genes, matrix ----------------------------------------------------


def cells(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("cell_id"),
        F.col("c_mktsegment").alias("cell_type"),
        F.format_string("donor_%02d", F.col("c_nationkey") + 1).alias("donor"),
        F.format_string("batch_%02d", F.col("c_custkey") % 4 + 1).alias("batch"),
    )


def genes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("gene_symbol"),
        F.col("p_brand").alias("chromosome"),
        F.format_string("ENSGSIM%011d", F.col("p_partkey")).alias("gene_id"),
        (F.col("p_size") >= 10).alias("is_target_gene"),
    )


def expression(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("cell_id"))
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("gene_symbol"), "l_quantity"
    )
    return (
        lines.join(orders, "o_orderkey")
        .groupBy("cell_id", "gene_symbol")
        .agg(F.sum("l_quantity").alias("value"))
    )


MATRIX_SQL = """
cells AS (
  SELECT c_custkey AS cell_id, c_mktsegment AS cell_type,
         printf('donor_%02d', c_nationkey + 1) AS donor,
         printf('batch_%02d', c_custkey % 4 + 1) AS batch
  FROM customer),
genes AS (
  SELECT p_partkey AS gene_symbol, p_brand AS chromosome,
         printf('ENSGSIM%011d', p_partkey) AS gene_id, p_size >= 10 AS is_target_gene
  FROM part),
expression AS (
  SELECT o_custkey AS cell_id, l_partkey AS gene_symbol, sum(l_quantity) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""


# --- experiments -------------------------------------------------------------


def _cases(key, values: dict, otherwise=None):
    out = None
    for k, v in values.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out.otherwise(otherwise) if otherwise is not None else out


def _segment(index):
    return F.element_at(F.array(*[F.lit(s) for s in SEGMENTS]), (index % 5 + 1).cast("int"))


def specs(spark: SparkSession, sf: str) -> DataFrame:
    """One runnable experiment per supplier, covering every kind of spec."""
    k = F.col("s_suppkey")
    nation = F.col("s_nationkey")
    kind = _cases(
        k % 7,
        {
            0: F.lit("gene_knockout"),
            1: F.lit("gene_overexpression"),
            2: F.lit("gene_activation"),
            3: F.lit(" Gene_Knockout "),
            4: F.lit("GENE_OVEREXPRESSION"),
            5: F.lit("gene_activation"),
            6: F.lit("gene_overexpression"),
        },
    )
    listed = _cases(
        k % 5, {0: F.array(k * 13, k * 13 + 1), 1: F.array(k * 17, k * 17, F.lit(-1).cast("bigint"))}
    )
    none = F.array().cast("array<string>")
    return table(spark, sf, "supplier").select(
        k.alias("position"),
        kind.alias("perturbation_type"),
        F.when((k % 11 == 5) & (k % 5 <= 1), F.lit(None)).otherwise(k * 13).alias("gene"),
        listed.alias("genes"),
        _cases(k % 4, {1: F.lit(0.5), 2: F.lit(2.5), 3: 1 + (k % 10) / 10.0}).alias("fold_change"),
        _cases(k % 6, {3: F.lit(0.35), 4: F.lit(-2.5), 5: F.lit(0.0)}).alias("delta"),
        F.when(k % 8 == 0, F.lit(None).cast("array<string>"))
        .when(k % 8 == 1, none)
        .otherwise(
            F.array(
                F.format_string("donor_%02d", nation + 1),
                F.format_string("donor_%02d", (nation + 1) % 25 + 1),
            )
        )
        .alias("target_donors"),
        F.when(k % 16 == 9, none)
        .when(k % 3 == 0, F.lit(None).cast("array<string>"))
        .when(k % 3 == 1, F.array(_segment(k)))
        .otherwise(F.array(_segment(k), _segment(k + 1)))
        .alias("target_cell_types"),
    )


SPECS_SQL = """
segments AS (SELECT ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'] AS names),
specs AS (
  SELECT s_suppkey AS position,
    CASE s_suppkey % 7 WHEN 0 THEN 'gene_knockout' WHEN 1 THEN 'gene_overexpression'
      WHEN 2 THEN 'gene_activation' WHEN 3 THEN ' Gene_Knockout ' WHEN 4 THEN 'GENE_OVEREXPRESSION'
      WHEN 5 THEN 'gene_activation' ELSE 'gene_overexpression' END AS perturbation_type,
    CASE WHEN s_suppkey % 11 = 5 AND s_suppkey % 5 <= 1 THEN NULL ELSE s_suppkey * 13 END AS gene,
    CASE s_suppkey % 5 WHEN 0 THEN [s_suppkey * 13, s_suppkey * 13 + 1]
      WHEN 1 THEN [s_suppkey * 17, s_suppkey * 17, -1] END AS genes,
    CASE s_suppkey % 4 WHEN 1 THEN 0.5::DOUBLE WHEN 2 THEN 2.5::DOUBLE
      WHEN 3 THEN 1 + (s_suppkey % 10) / 10.0::DOUBLE END AS fold_change,
    CASE s_suppkey % 6 WHEN 3 THEN 0.35::DOUBLE WHEN 4 THEN -2.5::DOUBLE WHEN 5 THEN 0.0::DOUBLE END AS delta,
    CASE WHEN s_suppkey % 8 = 0 THEN NULL WHEN s_suppkey % 8 = 1 THEN []::VARCHAR[]
      ELSE [printf('donor_%02d', s_nationkey + 1), printf('donor_%02d', (s_nationkey + 1) % 25 + 1)]
      END AS target_donors,
    CASE WHEN s_suppkey % 16 = 9 THEN []::VARCHAR[] WHEN s_suppkey % 3 = 0 THEN NULL
      WHEN s_suppkey % 3 = 1 THEN [names[s_suppkey % 5 + 1]]
      ELSE [names[s_suppkey % 5 + 1], names[(s_suppkey + 1) % 5 + 1]] END AS target_cell_types
  FROM supplier, segments),
typed AS (
  SELECT *, lower(trim(perturbation_type)) AS kind,
    printf('exp_%04d', row_number() OVER (ORDER BY position) - 1) AS experiment_id
  FROM specs),
spec_genes AS (
  SELECT DISTINCT experiment_id, unnest(coalesce(genes, [gene])) AS gene_symbol FROM typed),
known_genes AS (
  SELECT s.* FROM spec_genes s JOIN genes g USING (gene_symbol)),
members AS (
  SELECT experiment_id, cell_id FROM typed JOIN cells
  ON (target_donors IS NULL OR list_contains(target_donors, donor))
  AND (target_cell_types IS NULL OR list_contains(target_cell_types, cell_type)))"""


def run_specs(spark: SparkSession, sf: str) -> DataFrame:
    """All experiments as one run, with ids."""
    return with_experiment_ids(specs(spark, sf).withColumn("run_id", F.lit(RUN)))


def draft_specs(spark: SparkSession, sf: str) -> DataFrame:
    """The same specs with the mistakes a config can hold: bad types, genes and lists."""
    k = F.col("position")
    return (
        specs(spark, sf)
        .withColumn(
            "perturbation_type",
            F.when(k % 17 == 3, F.lit("gene_editing"))
            .when(k % 23 == 4, F.lit(None))
            .otherwise(F.col("perturbation_type")),
        )
        .withColumn(
            "genes",
            F.when(k % 13 == 6, F.array().cast("array<bigint>")).otherwise(F.col("genes")),
        )
        .withColumn("gene", F.when(k % 9 == 4, -1 - k).otherwise(F.col("gene")))
    )


DRAFT_SQL = """
draft AS (
  SELECT * REPLACE (
    CASE WHEN position % 17 = 3 THEN 'gene_editing' WHEN position % 23 = 4 THEN NULL
      ELSE perturbation_type END AS perturbation_type,
    CASE WHEN position % 13 = 6 THEN []::BIGINT[] ELSE genes END AS genes,
    CASE WHEN position % 9 = 4 THEN -1 - position ELSE gene END AS gene)
  FROM specs)"""

EFFECT_SQL = """
effects AS (
  SELECT experiment_id, kind, target_donors, target_cell_types,
    CASE kind WHEN 'gene_knockout' THEN 0.0
      WHEN 'gene_overexpression' THEN greatest(1.0, coalesce(fold_change, 2.0))
      ELSE greatest(1.0, coalesce(fold_change, 1.5)) END::DOUBLE AS factor,
    CASE WHEN kind = 'gene_activation' THEN delta END AS shift
  FROM typed),
touched AS (
  SELECT experiment_id, cell_id, gene_symbol, coalesce(value, 0) AS old_value,
    CASE WHEN shift IS NULL THEN coalesce(value, 0) * factor
      ELSE greatest(0, coalesce(value, 0) + shift) END AS new_value,
    value, factor, shift
  FROM members JOIN known_genes USING (experiment_id) JOIN effects USING (experiment_id)
  LEFT JOIN expression USING (cell_id, gene_symbol))"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


# --- embeddings --------------------------------------------------------------


def baseline_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("cell_id"), "embedding")


def vector_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells behind the embeddings table: label as type, eight donors."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("cell_id"),
        F.format_string("type_%02d", "label").alias("cell_type"),
        F.format_string("donor_%02d", F.col("vec_id") % 8 + 1).alias("donor"),
    )


VARIANTS = ("exp_0000", "exp_0001", "exp_0002", "exp_0003")


def perturbed_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Four fixed changes of every baseline vector, as the outputs of one run."""
    e = F.col("embedding")
    opposite = F.transform(e, lambda v: -v)
    flattened = F.transform(e, lambda v: F.when(v > 0, v).otherwise(F.lit(0.0).cast("float")))
    changes = (F.reverse(e), e, opposite, flattened)
    listed = F.array(
        *[F.struct(F.lit(x).alias("experiment_id"), c.alias("embedding")) for x, c in zip(VARIANTS, changes)]
    )
    return (
        table(spark, sf, "embeddings")
        .select(F.lit(RUN).alias("run_id"), F.col("vec_id").alias("cell_id"), F.explode(listed).alias("x"))
        .select("run_id", "x.experiment_id", "cell_id", "x.embedding")
    )


def vector_specs(spark: SparkSession, sf: str) -> DataFrame:
    """Targets of the four vector experiments, taken from the labels present.

    One has no list, one an empty list, one a label and one a label and donors.
    """
    top = table(spark, sf, "embeddings").agg(F.max("label").alias("label"))
    label = F.format_string("type_%02d", "label")
    none, null = F.array().cast("array<string>"), F.lit(None).cast("array<string>")
    lists = (
        (null, null),
        (none, none),
        (null, F.array(label)),
        (F.array(F.lit("donor_03"), F.lit("donor_05")), F.array(label, F.lit("type_00"))),
    )
    listed = F.array(
        *[
            F.struct(
                F.lit(x).alias("experiment_id"), d.alias("target_donors"), t.alias("target_cell_types")
            )
            for x, (d, t) in zip(VARIANTS, lists)
        ]
    )
    return (
        top.select(F.explode(listed).alias("s"))
        .select(F.when(F.col("s.experiment_id") >= "exp", F.lit(RUN)).alias("run_id"), "s.*")
        .withColumn("perturbation_type", F.lit(model.PERTURBATION_TYPES[0]))
    )


VECTOR_SQL = """
vcells AS (
  SELECT vec_id AS cell_id, printf('type_%02d', label) AS cell_type,
         printf('donor_%02d', vec_id % 8 + 1) AS donor, embedding AS base
  FROM embeddings),
top AS (SELECT printf('type_%02d', max(label)) AS label FROM embeddings),
vspecs AS (
  SELECT 'exp_0000' AS experiment_id, NULL::VARCHAR[] AS target_donors, NULL::VARCHAR[] AS target_cell_types
  UNION ALL SELECT 'exp_0001', [], []
  UNION ALL SELECT 'exp_0002', NULL, [label] FROM top
  UNION ALL SELECT 'exp_0003', ['donor_03', 'donor_05'], [label, 'type_00'] FROM top),
changed AS (
  SELECT 'exp_0000' AS experiment_id, vec_id AS cell_id, list_reverse(embedding) AS vec FROM embeddings
  UNION ALL SELECT 'exp_0001', vec_id, embedding FROM embeddings
  UNION ALL SELECT 'exp_0002', vec_id, list_transform(embedding, lambda v: -v) FROM embeddings
  UNION ALL SELECT 'exp_0003', vec_id, list_transform(embedding, lambda v: greatest(v, 0::FLOAT)) FROM embeddings),
vectors AS (
  SELECT experiment_id, cell_id, vec::DOUBLE[] AS a, base::DOUBLE[] AS b, cell_type, donor
  FROM changed JOIN vcells USING (cell_id)),
distances AS (
  SELECT experiment_id, cell_id, cell_type, donor,
    1 - greatest(-1, least(1, list_dot_product(a, b) /
      greatest(sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b)), 1e-8))) AS distance
  FROM vectors),
flagged AS (
  SELECT d.*, target_donors, target_cell_types,
    (coalesce(len(target_donors), 0) = 0 OR list_contains(target_donors, donor))
    AND (coalesce(len(target_cell_types), 0) = 0 OR list_contains(target_cell_types, cell_type)) AS is_target
  FROM distances d JOIN vspecs USING (experiment_id))"""


# --- events ------------------------------------------------------------------


def check_events(spark: SparkSession, sf: str) -> DataFrame:
    """Check evaluations: an ``error`` event is a failed check."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("storage_id"),
        "ts",
        F.concat(F.lit("runs/"), F.col("user_id").cast("string")).alias("asset_key"),
        F.col("event_type").alias("check_name"),
        (F.col("event_type") != "error").alias("passed"),
        F.when(F.col("user_id") % 3 != 0, F.lit("ERROR")).alias("severity"),
        F.when(F.col("user_id") % 5 != 0, F.col("props")).alias("description"),
    )


def materializations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("asset"),
        F.format_string("part_%02d", F.col("user_id") % 3).alias("partition"),
        "ts",
        F.col("event_id").alias("storage_id"),
        F.col("props").alias("metadata"),
    )


def artifact_log(spark: SparkSession, sf: str) -> DataFrame:
    """Every put of an artifact, in storage order; later puts replace earlier ones."""
    return table(spark, sf, "events").select(
        F.concat(
            F.lit("outputs/"), "event_type", F.lit("/"), F.col("user_id").cast("string"), F.lit(".json")
        ).alias("logical_path"),
        F.encode("props", "UTF-8").alias("content"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("sequence"),
    )


EVENTS_SQL = """
checks AS (
  SELECT event_id AS storage_id, ts, 'runs/' || user_id AS asset_key, event_type AS check_name,
    event_type <> 'error' AS passed, CASE WHEN user_id % 3 <> 0 THEN 'ERROR' END AS severity,
    CASE WHEN user_id % 5 <> 0 THEN props END AS description
  FROM events),
materializations AS (
  SELECT event_type AS asset, printf('part_%02d', user_id % 3) AS "partition", ts,
    event_id AS storage_id, props AS metadata
  FROM events),
artifact_log AS (
  SELECT 'outputs/' || event_type || '/' || user_id || '.json' AS logical_path,
    props AS content, ts AS updated_at, event_id AS sequence
  FROM events),
registry AS (
  SELECT logical_path, arg_max(content, sequence) AS content,
    arg_max(updated_at, sequence) AS updated_at
  FROM artifact_log GROUP BY 1)"""
