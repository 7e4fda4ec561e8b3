"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most two bits share at least six of
their eight bytes at the same positions: the guaranteed minimum of the count
filter.  A posting list of one byte at one position would hold 1/256 of the
corpus at any size, so the index lists fingerprints under each choice of six
positions and their bytes, 28 lists a fingerprint.  Pairs that meet there have
their shared positional bytes tallied, count once although they may meet in
several lists, and are verified on their bits.

Only distinct fingerprints are indexed; copies are members of their fingerprint
and never paired.
"""

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellshift.llm.common import WORD, free_names, same, small_batches, text_or_empty
from cellshift.llm.components import components
from cellshift.session import stored

BITS = 2
SHINGLE = 3
SEED = 42
#: Only A to Z change their case.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_word = re.compile(WORD.encode())
_STEP = 1 << 16


def simhash(text: str | None) -> int:
    """The fingerprint of one text, as a signed long."""
    words = _word.findall((text or "").encode("utf-8", "surrogatepass").translate(LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    width = min(SHINGLE, len(words))
    spans = zip(begins[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashed = np.array(
        [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype=">u8"
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashed), _STEP):
        part = hashed[at : at + _STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashed)).view(">i8")[0])


@F.pandas_udf(T.LongType())
def simhash_of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([simhash(t) for t in batch], dtype="int64")


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _shared_bytes(x: Column) -> Column:
    """How many of the eight bytes of an exclusive or are zero."""
    total = F.lit(0)
    for k in range(8):
        total = total + (F.shiftrightunsigned(x, 8 * k).bitwiseAND(0xFF) == 0).cast("int")
    return total


def links(fingerprints: DataFrame) -> DataFrame:
    """u < v: the pairs of distinct fingerprints (column fp) at ``BITS`` bits or fewer."""
    entries = []
    for nth, (p, q) in enumerate(combinations(range(8), BITS)):
        mask = ((1 << 64) - 1) & ~((0xFF << 8 * p) | (0xFF << 8 * q))
        mask -= (mask >> 63) << 64  # as a signed long
        entries.append(F.struct(F.lit(nth).alias("choice"), F.col("fp").bitwiseAND(F.lit(mask)).alias("kept")))
    index = fingerprints.select("fp", F.explode(F.array(*entries)).alias("entry")).select(
        "fp", "entry.choice", "entry.kept"
    )
    a = index.select(F.col("fp").alias("u"), F.col("choice").alias("cu"), F.col("kept").alias("ku"))
    b = index.select(F.col("fp").alias("v"), F.col("choice").alias("cv"), F.col("kept").alias("kv"))
    x = F.col("u").bitwiseXOR(F.col("v"))
    tally = _shared_bytes(x)
    least = 8 - BITS
    # a pair sharing seven bytes meets in seven lists: it counts in the first of them
    first_byte_shared = x.bitwiseAND(0xFF) == 0
    once = (tally == least) | (
        (F.col("cu") < 7) & (first_byte_shared | (F.col("cu") == 0))
    )
    # 28 entries a fingerprint: a table whose file is small enough to broadcast is not so as an index
    return a.hint("merge").join(
        b,
        (F.col("cu") == F.col("cv"))
        & (F.col("ku") == F.col("kv"))
        & (F.col("u") < F.col("v"))
        & (F.bit_count(x) <= BITS)
        & (tally >= least)
        & once,
    ).select("u", "v")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp, digest, component_id, root for every row of ``docs`` (doc_id, text; others are not read).

    component_id is the smallest doc_id that can be reached over links, the
    document's own included; null ids are not smaller than any other, and a
    component of null ids alone has a null component_id.  A null or blank text has
    fingerprint zero.  digest is the MD5 of the text, which tells rows with one id
    apart.  Repeated rows return a row each.
    """
    small_batches(docs.sparkSession)
    digest = F.md5(text_or_empty("text"))
    base = stored(docs.select("doc_id", simhash_of("text").alias("fp"), digest.alias("digest")), "simhash")
    members = stored(base.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-members")
    found = stored(components(links(members)), "simhash-components")
    rooted = members.join(found, F.col("fp") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    rooted = stored(rooted.select(F.col("fp").alias("own"), "root", "least"), "simhash-roots")
    ids = stored(
        rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id")), "simhash-ids"
    )
    classes = stored(
        rooted.join(ids, F.col("root") == F.col("of")).select("own", "component_id", "root"),
        "simhash-classes",
    )
    return base.join(classes, F.col("fp") == F.col("own")).select(
        "doc_id", "fp", "digest", "component_id", "root"
    )


def one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One document of each component, with the columns of ``docs``.

    The document with the smallest doc_id stays; of several rows with that id the
    one with the smallest digest, and one of those equal in both.  ``classes`` is
    what ``near_duplicates`` returned for ``docs``.
    """
    own, named, number, kept_named, kept_number, least = free_names(
        docs, "own_digest", "has_id", "id_number", "kept_has_id", "kept_number", "kept_digest"
    )
    # keys without nulls, so that the rows of a key stay where the join brought them
    heads = (
        classes.where(same(F.col("doc_id"), F.col("component_id")))
        .groupBy("root")
        .agg(
            F.first(F.col("doc_id").isNotNull()).alias(kept_named),
            F.coalesce(F.first("doc_id"), F.lit(0)).alias(kept_number),
            F.min("digest").alias(least),
        )
        .drop("root")
    )
    marked = (
        docs.withColumn(own, F.md5(text_or_empty("text")))
        .withColumn(named, F.col("doc_id").isNotNull())
        .withColumn(number, F.coalesce("doc_id", F.lit(0)))
    )
    found = marked.join(
        heads,
        (F.col(named) == F.col(kept_named))
        & (F.col(number) == F.col(kept_number))
        & (F.col(own) == F.col(least)),
    )
    return found.dropDuplicates([named, number, own]).select(*docs.columns)
