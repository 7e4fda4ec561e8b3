"""Streams against the batch results they must equal."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cellshift import model
from cellshift.session import shared_path
from cellshift.streaming import alerts, inputs

START = datetime(2024, 1, 1)


def events(spark, ids):
    rows = [
        (i, START + timedelta(minutes=i), f"runs/{i % 3}", "shape", i % 4 != 0, "ERROR" if i % 8 else None, None if i % 3 else f"text {i}")
        for i in ids
    ]
    return spark.createDataFrame(rows, model.CHECK_EVENTS).coalesce(1)


def test_alerts_arrive_once_late_or_repeated(spark):
    source, sink, cursor = (shared_path(spark, x) for x in ("events", "alerts", "cursor"))

    def deliver():
        stream = alerts.check_event_stream(spark, source, model.CHECK_EVENTS)
        alerts.deliver_alerts(stream, sink, cursor).awaitTermination()
        return spark.read.parquet(sink)

    events(spark, range(1000, 3000)).write.mode("append").parquet(source)
    assert deliver().count() == 500
    # Half of them again, and events a day older that were delayed.
    events(spark, range(2000, 3000)).write.mode("append").parquet(source)
    events(spark, range(0, 1000)).write.mode("append").parquet(source)
    got = deliver()
    wanted = alerts.failed_check_alerts(events(spark, range(3000)))
    assert got.count() == wanted.count() == 750
    assert wanted.exceptAll(got.select(*wanted.columns)).count() == 0
    assert deliver().count() == 750


def test_alert_defaults(spark):
    row = alerts.failed_check_alerts(events(spark, [8])).first()
    assert (row.run_key, row.severity, row.message) == (
        "asset_check_failure_8", "ERROR", "[ERROR] Asset check failed.",
    )


def test_events_are_read_in_bounded_steps(spark):
    log = events(spark, range(500))
    first = alerts.events_after(log, -1)
    assert alerts.next_cursor(first, -1).first().cursor == 199
    assert first.count() == 200
    last = alerts.events_after(log, 499)
    assert alerts.next_cursor(last, 499).first().cursor == 499


def test_batch_keys_are_added_once(spark):
    source, known, cursor = (shared_path(spark, x) for x in ("specs", "keys", "cursor"))
    for upto in (10, 25):
        spark.range(upto).select(F.col("id").alias("position")).write.mode("append").parquet(source)
        alerts.register_batch_keys(spark, source, "position bigint", known, cursor, 5).awaitTermination()
    got = sorted(r.batch_key for r in spark.read.parquet(known).collect())
    assert got == [f"batch_{i:04d}" for i in range(5)]


def test_new_files_trigger_an_action_once(spark):
    source, target, cursor = (shared_path(spark, x) for x in ("inputs", "seen", "cursor"))

    def action(batch, batch_id):
        batch.agg(F.count(F.lit(1)).alias("n")).write.mode("append").parquet(target)

    for rows in (3, 4):
        spark.range(rows).write.mode("append").parquet(source)
        alerts.on_new_files(spark, source, "id bigint", cursor, action).awaitTermination()
    assert sorted(r.n for r in spark.read.parquet(target).collect()) == [3, 4]


def test_changed_inputs(spark):
    schema = "logical_path string, modified timestamp, size bigint"
    now = spark.createDataFrame([("a", START, 1), ("b", START, 2), ("c", START, None)], schema)
    before = spark.createDataFrame([("a", START, 1), ("b", START, 1)], schema)
    row = alerts.changed_inputs(now, before).collect()
    assert [r.logical_path for r in row] == ["b"]
    assert row[0].run_key == f"ann_data_{row[0].cursor}" and row[0].cursor.endswith("000:2")


def _listed(spark, listings, *rows):
    """One look: (path, minute of writing, size)."""
    at = START + timedelta(days=1 + len(rows))
    looks = [(p, START + timedelta(minutes=m), s, at + timedelta(minutes=i)) for i, (p, m, s) in enumerate(rows)]
    spark.createDataFrame(looks, inputs.LISTING).coalesce(1).write.mode("append").parquet(listings)


def test_a_path_written_again_is_a_new_event(spark):
    listings, events_, cursor = (shared_path(spark, x) for x in ("looks", "told", "told-cursor"))

    def told():
        inputs.follow_inputs(spark, listings, events_, cursor).awaitTermination()
        return sorted((r.logical_path, r.cursor.split(":")[1]) for r in spark.read.schema(inputs.EVENT).parquet(events_).collect())

    _listed(spark, listings, ("a", 1, 10), ("b", 1, 20))
    assert told() == [("a", "10"), ("b", "20")]
    _listed(spark, listings, ("a", 1, 10), ("b", 1, None))  # unchanged; listed without a size
    assert told() == [("a", "10"), ("b", "20")]
    _listed(spark, listings, ("a", 2, 11), ("a", 3, 12), ("b", 1, 20))  # written twice between two runs
    assert told() == [("a", "10"), ("a", "11"), ("a", "12"), ("b", "20")]
    _listed(spark, listings, ("a", 2, 11))  # back to an older state is a change too
    assert told()[:2] == [("a", "10"), ("a", "11")] and len(told()) == 5
    assert len(told()) == 5  # started again without news: nothing is told twice


def test_a_watched_folder_is_listed_as_it_is(spark):
    watched, listings, events_, cursor = (shared_path(spark, x) for x in ("watched", "looks", "told", "told-cursor"))
    inputs.record_listing(spark, watched, listings)  # not there yet
    for rows in (3, 400):
        spark.range(rows).coalesce(1).write.mode("overwrite").json(watched)
        inputs.record_listing(spark, watched, listings)
        inputs.record_listing(spark, watched, listings)
        inputs.follow_inputs(spark, listings, events_, cursor).awaitTermination()
    found = spark.read.schema(inputs.EVENT).parquet(events_).where("logical_path LIKE '%.json'")
    assert found.count() == 2 and found.where("run_key = concat('ann_data_', cursor)").count() == 2
