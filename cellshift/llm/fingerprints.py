"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph is a piece between line feeds.  Its SHA-256 is read as a vector of
64 digits from 0 to 15; the vectors of all paragraphs of a document are added,
each position modulo 2**32, together with their number.  So the fingerprint does
not depend on the order of paragraphs, and adding or taking away a paragraph is
one vector addition (``combined``).

The difference of two fingerprints is the summed vector of the paragraphs in
which they differ; its squared length, once the digits are centred, estimates
how many those are.  ``likeness`` sets that against the squared lengths of both.

Everything is a row-local expression: no paragraph is ever shuffled.
A null text counts as empty, and an empty text has one empty paragraph.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellshift.llm.common import same, text_or_empty
from cellshift.session import stored

LANES = 64
MODULUS = 1 << 32
MEAN = 7.5  # of a digit from 0 to 15
DIGITS = "0123456789abcdef"


def lanes(text: Column) -> Column:
    """The fingerprint as an array of longs: the number of paragraphs, then 64 sums."""
    digests = F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256))

    def lane(digests: Column, j: Column) -> Column:
        digit = lambda d: F.instr(F.lit(DIGITS), F.substr(d, j, F.lit(1))) - 1
        return F.aggregate(digests, F.lit(0).cast("long"), lambda s, d: s + digit(d))

    sums = lambda d: F.transform(F.sequence(F.lit(1), F.lit(LANES)), lambda j: lane(d, j))
    # one-element array: the digests are made once and then read by every lane
    built = F.transform(F.array(digests), lambda d: F.concat(F.array(F.size(d).cast("long")), sums(d)))
    return F.transform(built[0], lambda x: F.pmod(x, F.lit(MODULUS)))


def encoded(vector: Column) -> Column:
    return F.concat_ws("", F.transform(vector, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")))


def decoded(fingerprint: Column) -> Column:
    at = F.sequence(F.lit(0), F.lit(LANES))
    return F.transform(
        at, lambda i: F.conv(F.substr(fingerprint, i * 8 + 1, F.lit(8)), 16, 10).cast("long")
    )


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint vector with the paragraphs of ``b`` added (1) or taken away (-1)."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(MODULUS)))


def _squared(a: Column, b: Column | None = None) -> Column:
    """Squared length of the centred vector, or of the difference of two."""
    both = a if b is None else F.zip_with(a, b, lambda x, y: x - y)
    half = F.lit(MODULUS // 2)
    wrapped = F.transform(both, lambda x: F.pmod(x + half, F.lit(MODULUS)) - half)

    def total(v: Column) -> Column:
        centred = lambda x: x - F.lit(MEAN) * v[0]
        return F.aggregate(
            F.slice(v, 2, LANES), F.lit(0.0), lambda s, x: s + centred(x) * centred(x)
        )

    return F.transform(F.array(wrapped if b is not None else both), total)[0]


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1; 1 for equal fingerprints, near the share of common paragraphs else."""
    norms = _squared(a) + _squared(b)
    return F.when(a == b, 1.0).otherwise(
        F.greatest(F.lit(0.0), F.coalesce(1 - F.try_divide(_squared(a, b), norms), F.lit(0.0)))
    )


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of a text column; the other columns stay."""
    return df.withColumn(name, encoded(lanes(text_or_empty(text))))


def next_documents(keys: DataFrame) -> DataFrame:
    """For each key (doc_id, h, n) the one after it by descending doc_id; the first follows the last.

    Keys are dealt by range and written; inside a part the next key is the next
    row, and the last of a part takes the first of the following part from a
    table with one row a part.
    """
    order = [F.desc_nulls_last("doc_id"), F.asc("h")]
    dealt = stored(
        keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "next-keys"
    )
    inside = W.partitionBy("part").orderBy(*order)
    after = F.struct("doc_id", "h")
    rows = dealt.withColumn("follower", F.lead(after).over(inside))
    minus = (-F.col("doc_id").cast("decimal(20,0)")).alias("m")  # the smallest long has no negative
    firsts = dealt.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), minus, "h")).alias("f"))
    parts = W.orderBy("part")
    unpacked = F.struct((-F.col("f.m")).cast("long").alias("doc_id"), F.col("f.h").alias("h"))
    heads = firsts.select("part", unpacked.alias("head"))
    following = heads.select(
        "part",
        F.coalesce(
            F.lead("head").over(parts),
            F.first("head").over(parts.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        ).alias("turn"),
    )
    return rows.join(following, "part").select(
        "doc_id", "h", "n", F.coalesce("follower", "turn").alias("follower")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint every document, its edited text, and compare.

    The edited text has the last ``floor(n_chars / 3)`` code points replaced by
    the first as many of the next document, or by all it has.  Rows with the same
    doc_id and text are one document where the next is looked up; each of them
    returns its row.  A doc_id with several texts is ordered by a hash of the
    text.  Null ids come last.  An empty table returns no row.

    The whole text is shuffled once, by (doc_id, hash); both joins read that
    shuffle.  Of the next document only the characters needed travel, with its
    vector.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text")
    ).withColumn("h", F.xxhash64("text"))
    keys = base.select("doc_id", "h", F.length("text").cast("long").alias("n")).distinct()
    links = next_documents(keys).select(
        F.col("doc_id").alias("to_id"),
        F.col("h").alias("to_h"),
        F.expr("n div 3").alias("k"),
        F.col("follower.doc_id").alias("from_id"),
        F.col("follower.h").alias("from_h"),
    )
    sent = (
        base.join(links, same(F.col("doc_id"), F.col("from_id")) & (F.col("h") == F.col("from_h")))
        .select(
            "to_id", "to_h", "k", F.expr("substring(text, 1, cast(k as int))").alias("head"), "text"
        )
        .select("to_id", "to_h", "k", "head", lanes(F.col("text")).alias("next_lanes"))
        .groupBy("to_id", "to_h", "k")
        .agg(F.max(F.struct("head", "next_lanes")).alias("sent"))  # repeated rows sent the same
    )
    joined = base.join(sent, same(F.col("doc_id"), F.col("to_id")) & (F.col("h") == F.col("to_h")))
    rows = joined.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "text",
        F.concat(F.expr("substring(text, 1, cast(length(text) - k as int))"), "sent.head").alias("edited"),
        F.col("sent.next_lanes").alias("next_lanes"),
    )
    vectors = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        lanes(F.col("text")).alias("own"),
        lanes(F.col("edited")).alias("other"),
        "next_lanes",
    )
    return vectors.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        encoded(F.col("own")).alias("fingerprint"),
        encoded(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_lanes")).alias("near_next"),
    )
