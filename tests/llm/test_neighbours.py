"""Recall of the nearest vectors where codes, norms and hubs make it hard."""

from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from cellshift.llm import neighbours


def recall(spark, vectors, every=20, k=20):
    """The share of the true ``k`` nearest that is found, over the queries."""
    table = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in neighbours.nearest(table, F.col("vec_id") % every == 0, k).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = asked = 0
    for q in range(0, len(vectors), every):
        near = vectors @ vectors[q]
        near[q] = -np.inf
        hits += len(got[q] & set(np.lexsort((np.arange(len(near)), -near))[:k].tolist()))
        asked += k
    return hits / asked


def unit(rng, rows, width):
    x = rng.normal(size=(rows, width))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def noisy_copies(noise):
    rng = np.random.default_rng(8)
    x = unit(rng, 1800, 64)
    x[::3] = x[0] + noise * unit(rng, 600, 64)
    return x


def test_near_copies_find_each_other(spark):
    assert recall(spark, noisy_copies(0.001)) >= 0.95


def with_long_row(times):
    x = unit(np.random.default_rng(9), 1000, 16)
    x[7] *= times
    return x


def test_long_rows_do_not_hide_the_others(spark):
    for times in (100.0, 1e200):
        assert recall(spark, with_long_row(times)) >= 0.9


def test_more_neighbours_than_a_pool_holds(spark):
    x = unit(np.random.default_rng(10), 900, 16)
    assert recall(spark, x, every=100, k=neighbours.POOL + 50) >= 0.9


def test_a_hub_is_dealt_to_many_tasks(spark):
    ids = spark.range(4000).select(
        F.col("id").alias("node"),
        F.lit(b"code").alias("code"),
        F.lit(1.0).alias("size"),
        F.lit(0.0).alias("worst"),
        F.array(F.lit(0).cast("long")).alias("others"),
        F.array(F.lit(True)).alias("fresh"),
    )
    gathered = neighbours._gathered(neighbours._dealt(ids, 0), 16)
    sizes = [r["count"] for r in gathered.where("pivot = 0").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4001 and max(sizes) <= 1500


def test_equal_scores_make_no_hub(spark):
    rows = [(n, [float(n == m) for m in range(400)]) for n in range(400)]
    nodes = spark.createDataFrame(rows, "node long, vec array<double>")
    lists = neighbours.graph(neighbours.coded(nodes, 400, 1.0), 400, False)
    most = lists.select(F.explode("others").alias("o")).groupBy("o").count().agg(F.max("count")).first()[0]
    assert most <= 200
