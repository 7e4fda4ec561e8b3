"""How filters share out what they remove, over every order they may run in.

A document's failures are a row of a mask matrix: 0 for a filter it fails, no number for
one it passes.  An order of filters is a column of positions, the inverse permutation.
Their min-plus product, the smallest position among the failed filters, is the step that
removes the document in that order.  Documents with one mask behave alike, so the product
has 2 ** filters rows, and counts per part and mask are scattered to the steps.

The texts are read once, by column expressions.  Only digests, masks and label weights
travel.  Which copies of a text fail is settled by joining digest and smallest id together,
so a text that a third of the corpus shares is no hot key.

Defined results: a null text is empty; a null part is the empty string, together with
parts so called; rows without a doc_id are no copy of any and have no copies; of several
labels of one doc_id the best quality and the worst toxicity count; repeated rows, ids
included, are counted each and are not copies of each other; an empty table has no parts.
"""

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellshift.llm.common import WORD, bound, text_or_empty
from cellshift.session import stored

#: The filters by letter; the last tells copies and is no expression of one row.
LETTERS = "ABCDE"
COPY = "E"
WEIGHTS = ("n", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def row_mask(text: Column) -> Column:
    """The bits of the filters that one row decides, for a text that is not null."""

    def bit(letter: str, fails: Column) -> Column:
        return F.when(fails, 1 << LETTERS.index(letter)).otherwise(0)

    def by_words(words: Column) -> Column:
        n, distinct = F.size(words), F.size(F.array_distinct(words))
        return bit("A", n < 200).bitwiseOR(bit("B", 100 * distinct < 50 * n))

    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return (
        bound(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), by_words)
        .bitwiseOR(bit("C", 100 * capitals > 3 * F.length(text).cast("long")))
        .bitwiseOR(bit("D", text.rlike(r"[#$%&*|]")))
    )


def failing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents, and those labelled so, per combination of failed filters."""
    text = text_or_empty("text")
    found = docs.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        row_mask(text).alias("mask"),
    )
    # equal rows meet first: from here on a row is one doc_id of one text in one part
    rows = found.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    rated = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("rated_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("is_good"),
        F.max((F.col("toxic") == 1).cast("long")).alias("is_toxic"),
    )
    rows = rows.join(rated, F.col("doc_id") == F.col("rated_id"), "left").select(
        "doc_id", "part", "digest", "mask", "n",
        (F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
        (F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
    )
    return with_copies(stored(rows, "interactions"))


def with_copies(rows: DataFrame) -> DataFrame:
    """Sets the copy bit for all rows of a digest but those of its smallest doc_id, and counts.

    Everything with an id is counted as a copy, and what holds its digest's smallest id is
    moved back.  Those rows are found by digest and id together, so no key is hot.
    """
    copy = F.col("mask").bitwiseOR(1 << LETTERS.index(COPY))
    smallest = (
        rows.where("doc_id is not null")
        .groupBy(F.col("digest").alias("of"))
        .agg(F.min("doc_id").alias("smallest"))
    )
    firsts = rows.join(smallest, (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("smallest")))
    less = [(-F.col(w)).alias(w) for w in WEIGHTS]
    moved = (
        rows.select("part", F.when(F.col("doc_id").isNull(), F.col("mask")).otherwise(copy).alias("mask"), *WEIGHTS)
        .unionByName(firsts.select("part", copy.alias("mask"), *less))
        .unionByName(firsts.select("part", "mask", *WEIGHTS))
    )
    return moved.groupBy("part", "mask").agg(*[F.sum(w).alias(w) for w in WEIGHTS])


def removal_steps(n_filters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Orders (orders x step), masks (mask x filter, 0 or infinity), and the removing step (mask x order).

    A mask that fails nothing gets the step after the last.
    """
    orders = np.array(list(permutations(range(n_filters))))
    positions = np.argsort(orders, axis=1)  # the inverse of each order
    fails = (np.arange(1 << n_filters)[:, None] >> np.arange(n_filters)) & 1
    masks = np.where(fails == 1, 0.0, np.inf)
    steps = np.full((len(masks), len(orders)), np.inf)
    for f in range(n_filters):
        steps = np.minimum(steps, masks[:, f : f + 1] + positions[None, :, f])
    return orders, masks, np.where(np.isinf(steps), n_filters, steps).astype(int)


def audited(counts: DataFrame, letters: Sequence[str] = LETTERS) -> DataFrame:
    """part, filter_order, step, its filter's letter and ``COUNTS``, for every part, order and step.

    ``counts`` has part, mask, n, good, toxic.  A part's rows, at most one a mask, are one
    task's group; parts are spread by name.
    """
    n_filters = len(letters)
    orders, masks, steps = removal_steps(n_filters)
    names = ["".join(letters[f] for f in order) for order in orders]

    def scattered(weight: np.ndarray) -> np.ndarray:
        """Orders x steps: the weight of the masks removed there."""
        out = np.zeros((len(orders), n_filters + 1), dtype=np.int64)
        for order in range(len(orders)):
            np.add.at(out[order], steps[:, order], weight)
        return out[:, :n_filters]

    def of_part(table: pa.Table) -> pa.Table:
        held = np.zeros((len(WEIGHTS), len(masks)), dtype=np.int64)
        for i, w in enumerate(WEIGHTS):
            np.add.at(held[i], table["mask"].to_numpy(), table[w].to_numpy())
        n = held[0]
        removed, good, toxic = (scattered(h) for h in held)
        fails = masks == 0
        at = fails[:, orders]  # mask x order x step: fails the filter that runs there
        earlier = steps[:, :, None] < np.arange(n_filters)[None, None, :]
        redundant = np.einsum("m,mos->os", n, at & earlier)
        alone = (fails & (fails.sum(axis=1) == 1)[:, None]).T.astype(np.int64) @ n
        shapley = np.zeros(n_filters, dtype=np.int64)
        np.add.at(shapley, orders, removed)
        values = {
            "kept": n.sum() - np.cumsum(removed, axis=1),
            "removed": removed,
            "redundant": redundant,
            "unique_fails": alone[orders],
            "good_lost": good,
            "toxic_lost": toxic,
            "shapley": shapley[orders],
        }
        size = orders.size
        return pa.table(
            {
                "part": pa.array([table["part"][0].as_py()] * size, pa.string()),
                "filter_order": np.repeat(names, n_filters),
                "step": np.tile(np.arange(1, n_filters + 1, dtype=np.int32), len(orders)),
                "filter": [letters[f] for f in orders.ravel()],
                **{name: values[name].ravel().astype(np.int64) for name in COUNTS},
            }
        )

    schema = "part string, filter_order string, step int, filter string, " + ", ".join(f"{c} long" for c in COUNTS)
    typed = counts.select("part", F.col("mask").cast("int").alias("mask"), *[F.col(w).cast("long").alias(w) for w in WEIGHTS])
    return typed.groupBy("part").applyInArrow(of_part, schema)
