"""Connected components by alternating large-star and small-star rounds.

Every round is two joins and two aggregates over the table of edges, which is
written to the shared folder after each round.  Nothing is gathered.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellshift.session import stored


def _star(edges: DataFrame, both: DataFrame, larger_only: bool) -> DataFrame:
    least = stored(both.groupBy("u").agg(F.min("v").alias("v")).select(
        F.col("u").alias("at"), F.least("u", "v").alias("root")
    ), "star-roots")
    pairs = both.join(least, F.col("u") == F.col("at"))
    if larger_only:
        moved = pairs.where("v > u").select(F.col("v").alias("u"), F.col("root").alias("v"))
    else:
        moved = pairs.select(F.col("v").alias("u"), F.col("root").alias("v")).unionByName(
            least.select(F.col("at").alias("u"), F.col("root").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (u, v: longs); the root is the smallest node reachable.

    Loops and repeated edges do no harm; an empty table gives no row.
    """
    down = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = stored(edges.where("u <> v").select(*down).distinct(), "edges")
    state = None
    while True:
        turned = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_star(now, turned, True).select(*down).distinct(), "edges")
        now = stored(_star(large, large, False).select(*down).distinct(), "edges")
        # one row: enough to see that a round changed nothing
        seen = now.select(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == state:
            break
        state = seen
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
