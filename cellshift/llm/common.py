"""What the operators share: reading a table, free column names, word patterns."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python a few megabytes at a time, unless the session says how many.

    Spark's own bound is 64 MB a batch, of which a task holds several copies on both sides.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, "4m")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        names.append(name)
    return names


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def same(left: Column, right: Column) -> Column:
    """Equality that also pairs nulls, as a join key Spark can hash."""
    return left.eqNullSafe(right)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value made once: what a lambda reads again and again is not inlined."""
    return F.transform(F.array(value), use)[0]
