"""Session defaults and the shared folder for tables that cut lineage."""

import functools
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

#: The folder of the job that runs, below which its tables go; none outside of a job.
_job: ContextVar[str | None] = ContextVar("job", default=None)


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cellshift")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir`` that every executor can reach.

    Only a local master may fall back to the machine's temporary folder: on a
    cluster a path one executor sees alone would lose data with that executor.
    """
    base = _job.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="cellshift-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/cellshift/{label}-{uuid.uuid4().hex}"


def stored(df, label: str):
    """Write ``df`` once to the shared folder and go on from the written table."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def opened(spark: SparkSession, path: str, schema=None):
    """The Parquet table at ``path``; its folders, one a run, are listed by some tasks a core and not by one each."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    finally:
        spark.conf.set(_LISTING, before)


@contextmanager
def job_folder(spark: SparkSession, label: str):
    """Tables stored inside go to one folder, which is deleted when the job has written its results.

    A job that fails leaves its folder, and so does one inside another job, to that one.
    """
    if _job.get():
        yield
        return
    path = shared_path(spark, label)
    token = _job.set(path)
    try:
        yield
    finally:
        _job.reset(token)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def in_job_folder(job):
    """A job, called with the session first, whose own tables go to a folder deleted at its end.

    What the job returns must not read them.
    """

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with job_folder(spark, job.__name__):
            return job(spark, *args, **kwargs)

    return run
