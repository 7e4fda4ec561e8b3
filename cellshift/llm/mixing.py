"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key divided by its quality weight; inside a
source, documents are taken by ascending key until the source's budget of words
is used up.  A budget over the source's size first gives complete epochs, and the
order decides only which documents the last, partial epoch holds.

Keys come from a hash of the id and the text, so that reruns agree.  The order
inside a source is never sorted as a whole: documents are dealt by sampled ranges of
source, key and row, which are even whatever the weights and however many rows are
alike; parts carry running sums, and only a part is sorted in one task.  Texts are read
once and never shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellshift.llm.common import WORD, free_names, same, text_or_empty
from cellshift.session import stored

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2


def uniform(doc_id: Column, text: Column) -> Column:
    """From 0 to 1, both excluded: 52 bits of a digest of the id and the text."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("#"), F.md5(text)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_EPOCHS) -> DataFrame:
    """source, source_size, n_docs, target: ``share`` of all words dealt by weight.

    No target is above ``most`` times its source; what is over goes to the others
    by weight.  Sources sorted by limit over weight fill up in that order, so
    running sums over the table of sources give the level at once.
    """
    table = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    named = W.orderBy(F.asc_nulls_last("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = table.withColumn(
        "weight", F.element_at(cycle, F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))) + 1)
    ).withColumn("limit", F.col("source_size") * float(most))
    filling = W.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    whole = W.partitionBy()
    before = F.sum("limit").over(filling.rowsBetween(W.unboundedPreceding, -1))
    rest = F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    goal = F.sum("source_size").over(whole) * float(share)
    table = table.select("*", F.coalesce(before, F.lit(0.0)).alias("before"), rest.alias("rest"), goal.alias("goal"))
    full = F.col("limit") * F.col("rest") <= (F.col("goal") - F.col("before")) * F.col("weight")
    table = table.withColumn("full", full)
    used = F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(whole)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(whole)
    level = F.try_divide(F.col("goal") - used, open_weight)
    return table.select(
        "source",
        "source_size",
        "n_docs",
        F.when(F.col("full"), F.col("limit")).otherwise(level * F.col("weight")).alias("target"),
    )


def mixed(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, u: how often the mix takes each document.

    ``quality`` has doc_id and weight (positive); documents without one weigh 1,
    several weights of one id count as their largest.  A null text has size 0;
    null sources form one source; an empty table gives no row.  Repeated rows are
    drawn one by one.  The document that crosses the budget is taken if that
    brings the sum nearer to it, so a source misses its target by half a document
    at most.  Columns of ``docs`` other than doc_id, text and source are not read.
    """
    base = docs.select(
        "doc_id",
        "source",
        F.regexp_count(text_or_empty("text"), F.lit(WORD)).cast("long").alias("size"),
        uniform(F.col("doc_id"), text_or_empty("text")).alias("u"),
    )
    if quality is None:
        base = base.withColumn("weight", F.lit(1.0))
    else:
        best = quality.where("doc_id is not null and weight > 0").groupBy(
            F.col("doc_id").alias("rated_id")
        ).agg(F.max(F.col("weight").cast("double")).alias("weight"))
        base = (
            base.join(best, F.col("doc_id") == F.col("rated_id"), "left")
            .drop("rated_id")
            .fillna({"weight": 1.0})
        )
    # rows alike in everything are told apart by their place in the stored table
    base = base.withColumn("key", -F.log("u") / F.col("weight")).withColumn("row", F.monotonically_increasing_id())
    base = stored(base.drop("weight"), "mix-sizes")
    targets = stored(source_targets(base), "mix-targets")
    named = targets.withColumnRenamed("source", "of_source")
    order = ["key", F.asc_nulls_first("doc_id"), "size", "row"]
    dealt = base.join(named, same(F.col("source"), F.col("of_source"))).select(
        *base.columns, "source_size", "target"
    )
    dealt = dealt.repartitionByRange("source", *order).withColumn("part", F.spark_partition_id())
    inside = W.partitionBy("source", "part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    parts = stored(dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))), "mix-parts")
    running = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        parts.groupBy("source", "part")
        .agg(F.sum("size").alias("part_size"))
        .select(
            F.col("source").alias("at_source"),
            F.col("part").alias("at_part"),
            F.coalesce(F.sum("part_size").over(running), F.lit(0)).alias("start"),
        )
    )
    placed = parts.join(starts, same(F.col("source"), F.col("at_source")) & (F.col("part") == F.col("at_part")))
    whole = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    left_over = F.col("target") - whole * F.col("source_size")
    middle = F.col("start") + F.col("inside") + F.col("size") / 2
    taken = ((left_over > 0) & (middle <= left_over)).cast("long")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", (whole + taken).alias("epochs"), "u"
    )


def apply_mix(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The documents the mix takes, as often as it takes them, with the columns of ``docs``.

    ``mix`` is what ``mixed`` returned for ``docs``.  Rows are matched by doc_id
    and the number their text gave; rows equal in both share the largest count.
    """
    u, key_id, key_u, epochs, copy = free_names(
        docs, "mix_u", "mix_id", "mix_at", "mix_epochs", "mix_copy"
    )
    chosen = (
        mix.where("epochs > 0")
        .groupBy(F.col("doc_id").alias(key_id), F.col("u").alias(key_u))
        .agg(F.max("epochs").alias(epochs))
    )
    marked = docs.withColumn(u, uniform(F.col("doc_id"), text_or_empty("text")))
    joined = marked.join(chosen, same(F.col("doc_id"), F.col(key_id)) & (F.col(u) == F.col(key_u)))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(epochs).cast("long")))).select(
        *docs.columns
    )
