"""Streams over check events, incoming specs and changing inputs."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cellshift import model
from cellshift.functions.text import alert_message, numbered_key
from cellshift.operators.lineage import new_keys
from cellshift.plans.layout import table_or_empty


def events_after(events: DataFrame, last_id: Column | int, limit: int = model.ALERT_FETCH_LIMIT) -> DataFrame:
    """The next events by id, at most ``limit``; their largest id is the new cursor."""
    return events.where(F.col("storage_id") > last_id).orderBy("storage_id").limit(limit)


def next_cursor(batch: DataFrame, last_id: int) -> DataFrame:
    return batch.agg(F.greatest(F.coalesce(F.max("storage_id"), F.lit(last_id)), F.lit(last_id)).alias("cursor"))


def failed_check_alerts(events: DataFrame) -> DataFrame:
    """An alert per failed check, for a table or a stream."""
    severity = F.coalesce("severity", F.lit("ERROR"))
    failed = events.where(~F.coalesce("passed", F.lit(True)))
    return failed.select(
        F.concat(F.lit("asset_check_failure_"), F.col("storage_id").cast("string")).alias("run_key"),
        "storage_id",
        "ts",
        F.coalesce("asset_key", F.lit("")).alias("asset_key"),
        F.coalesce("check_name", F.lit("unknown_check")).alias("check_name"),
        severity.alias("severity"),
        alert_message(F.col("severity"), F.col("description")).alias("message"),
        F.lit("asset_check_failure").alias("alert_type"),
    )


def alert_log_line(alerts: DataFrame) -> DataFrame:
    """The text an alert leaves in a log."""
    return alerts.select(
        "run_key",
        F.format_string("ASSET CHECK ALERT | asset=%s check=%s | %s", "asset_key", "check_name", "message").alias(
            "line"
        ),
    )


def check_event_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Check events from files as they arrive."""
    return spark.readStream.schema(schema).parquet(path)


ALERT_BLOCK = 1_000_000  # storage ids per partition of the alert table


def deliver_alerts(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append an alert per failed check to a table, exactly once per storage id.

    The alert table itself is the memory of what was sent: an event that is
    delivered twice, arrives late or belongs to a batch that is retried after a
    lost executor finds its alert there.  Nothing is dropped for being late and
    no state grows with the stream.  Only the id blocks from the
    batch's smallest to its largest are read back.
    """
    block = F.floor(F.col("storage_id") / F.lit(ALERT_BLOCK))
    alerts = failed_check_alerts(events).withColumn("id_block", block)
    schema = alerts.schema

    def add(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read three times; a lost part is read from its files again
        fresh = batch.dropDuplicates(["storage_id"])
        known = table_or_empty(batch.sparkSession, path, schema)
        # two numbers of the batch; a comparison prunes folders, the join alone would not
        first, last = batch.select(F.min("id_block"), F.max("id_block")).first()
        if first is not None:
            known = known.where(F.col("id_block").between(first, last))
        sent = known.join(batch.select("id_block").distinct(), "id_block", "left_semi")
        fresh = fresh.join(sent.select("storage_id"), "storage_id", "left_anti")
        fresh.select(*schema.names).write.mode("append").partitionBy("id_block").parquet(path)
        batch.unpersist()

    return (
        alerts.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def register_batch_keys(
    spark: SparkSession, specs_path: str, schema: T.StructType, registered_path: str, checkpoint: str, batch_size: int
) -> StreamingQuery:
    """Add the batch keys of newly arrived specs to the registered keys.

    A batch that is retried after a lost executor finds its own keys registered
    already and adds nothing twice.
    """
    specs = spark.readStream.schema(schema).parquet(specs_path)
    index = F.floor(F.col("position") / F.lit(max(1, batch_size)))
    keys = specs.select(numbered_key("batch", index).alias("batch_key"))

    def add(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        known = table_or_empty(session, registered_path, "batch_key string")
        new_keys(batch, known, "batch_key").write.mode("append").parquet(registered_path)

    return (
        keys.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def changed_inputs(current: DataFrame, last_seen: DataFrame) -> DataFrame:
    """Inputs whose time or size differs from the last look; absent ones are skipped.

    Both sides have ``logical_path, modified, size``.
    """
    micros = F.unix_micros(F.col("modified").cast("timestamp"))
    cursor = F.concat_ws(":", (micros * 1000).cast("string"), F.col("size").cast("string"))
    now = current.where(F.col("size").isNotNull()).select("logical_path", cursor.alias("cursor"))
    before = last_seen.select("logical_path", cursor.alias("cursor"))
    return now.join(before, ["logical_path", "cursor"], "left_anti").select(
        "logical_path", "cursor", F.concat(F.lit("ann_data_"), "cursor").alias("run_key")
    )


def on_new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    checkpoint: str,
    action: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    """Call ``action`` with the rows of input files that appeared since the checkpoint."""
    stream = spark.readStream.schema(schema).parquet(path)
    return (
        stream.writeStream.foreachBatch(action)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
