"""Artifacts by logical path: an append-only put log, reads and existence.

The log has ``logical_path, content, updated_at, sequence``; ``sequence`` is the
order of the puts.  Datasets themselves are never kept here.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellshift.functions.hashing import content_fingerprint, file_fingerprint
from cellshift.functions.text import is_dataset_file, path_key
from cellshift.operators.latest import latest_by


def registry(log: DataFrame) -> DataFrame:
    """The latest content per logical path; a later ``sequence`` replaces an earlier one."""
    puts = log.where(~is_dataset_file(F.col("logical_path"))).withColumn(
        "logical_path", path_key(F.col("logical_path"))
    )
    return latest_by(puts, ["logical_path"], "sequence").select(
        "logical_path", "content", "updated_at"
    )


def upsert(log: DataFrame, puts: DataFrame) -> DataFrame:
    """The log after further puts; replacing happens when the registry is read."""
    return log.unionByName(puts)


def wanted_key(wanted: DataFrame) -> DataFrame:
    return wanted.withColumn("logical_path", path_key(F.col("logical_path")))


def lookup(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Content of the wanted paths that are stored."""
    return wanted_key(wanted).join(stored, "logical_path")


def existing(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    return wanted_key(wanted).join(stored.select("logical_path"), "logical_path", "left_semi")


def missing(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Wanted paths that are not stored; a job needing them must stop and name them."""
    return wanted_key(wanted).join(stored.select("logical_path"), "logical_path", "left_anti")


def layered(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Both tiers as one: a file hides the registry row of the same path."""
    f = files.select(
        path_key(F.col("logical_path")).alias("logical_path"), F.col("content").alias("_file")
    )
    s = stored.select("logical_path", F.col("content").alias("_stored"))
    return f.join(s, "logical_path", "full_outer").select(
        "logical_path",
        F.coalesce("_file", "_stored").alias("content"),
        F.when(F.col("_file").isNotNull(), F.lit("file")).otherwise(F.lit("registry")).alias("tier"),
    )


def layered_existing(wanted: DataFrame, files: DataFrame, stored: DataFrame) -> DataFrame:
    present = files.select(path_key(F.col("logical_path")).alias("logical_path")).unionByName(
        stored.select("logical_path")
    )
    return existing(wanted, present)


def artifact_fingerprints(layers: DataFrame, file_facts: DataFrame) -> DataFrame:
    """A file's path, time and size when it is a file, else the hash of its stored bytes.

    ``file_facts`` has ``logical_path, modified, size``.
    """
    facts = file_facts.select(path_key(F.col("logical_path")).alias("logical_path"), "modified", "size")
    from_file: Column = F.when(
        F.col("size").isNotNull(), file_fingerprint(F.col("logical_path"), F.col("modified"), F.col("size"))
    )
    from_bytes = content_fingerprint(F.col("content"), F.col("logical_path"))
    return layers.join(facts, "logical_path", "left").select(
        "logical_path", F.coalesce(from_file, from_bytes).alias("fingerprint")
    )


def file_facts(spark, path: str, root: str = "") -> DataFrame:
    """``logical_path, modified, size`` of the files below a path, from file metadata only.

    The content column is not read: only the scan's metadata columns are selected.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    logical = F.col("path")
    if root:
        logical = F.replace(logical, F.lit(root), F.lit(""))
    return found.select(
        path_key(logical).alias("logical_path"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("size"),
    )
