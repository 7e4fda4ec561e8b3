"""Changed inputs as a stream: which watched files are new, or were written again.

Each look at a folder appends its listing (path, time, size) to a table.  A stream over that
table remembers the last time and size of every path and gives an event when they differ.
What has been looked at and what has been told live in the listing table and the
checkpoint, so a job that dies is started again and neither loses nor repeats an event.
A path that is absent, or listed without a size, is skipped and keeps what is remembered.
"""

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cellshift.sources.registry import file_facts

# Ship this module's functions with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING = "logical_path string, modified timestamp, size bigint, seen_at timestamp"
EVENT = "logical_path string, cursor string, run_key string, seen_at timestamp"


def record_listing(spark: SparkSession, watched: str, listings: str, root: str = "") -> None:
    """Append what the watched folder holds now; a folder that is not there has no files."""
    try:
        facts = file_facts(spark, watched, root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        facts = spark.createDataFrame([], "logical_path string, modified timestamp, size bigint")
    facts.withColumn("seen_at", F.current_timestamp()).write.mode("append").parquet(listings)


def _changes(key: tuple, looks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Events of one path: its looks in order, against the time and size remembered."""
    seen = pd.concat(list(looks)).sort_values(["seen_at", "micros", "size"])
    last = state.get[0] if state.exists else None
    rows = []
    for micros, size, seen_at in zip(seen["micros"], seen["size"], seen["seen_at"]):
        cursor = f"{int(micros) * 1000}:{int(size)}"
        if cursor != last:
            rows.append((key[0], cursor, f"ann_data_{cursor}", seen_at))
            last = cursor
    if rows:
        state.update((last,))
    yield pd.DataFrame(rows, columns=["logical_path", "cursor", "run_key", "seen_at"])


def input_changes(listings: DataFrame) -> DataFrame:
    """An event per path and change, from a stream of listings."""
    looks = listings.where("size IS NOT NULL").select(
        "logical_path", F.unix_micros("modified").alias("micros"), "size", "seen_at"
    )
    return looks.groupBy("logical_path").applyInPandasWithState(
        _changes, EVENT, "last string", "append", GroupStateTimeout.NoTimeout
    )


def follow_inputs(spark: SparkSession, listings: str, events: str, checkpoint: str) -> StreamingQuery:
    """Append the events of all listings since the checkpoint to a table, once each."""
    stream = spark.readStream.schema(LISTING).parquet(listings)
    return (
        input_changes(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", events)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
