"""The corpus pipeline: language ID, near-duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next stage's documents.  All but the last return the
columns of their input.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellshift.llm import language, mixing, simhash
from cellshift.llm.common import free_names
from cellshift.llm.queries import bpe_digests, quality_weights
from cellshift.session import stored

#: The share of ``und`` from which a document counts as being in none of the learned languages.
#: Set by a trial on sf0.1: short documents that are mostly numbers or marks reached 0.86, and
#: gibberish, other scripts, programs and markup had 0.96 and more with two and four languages.
LEAST_STRANGE = 0.9


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in one of the learned languages.

    Rejected are null texts, texts without a letter, and texts that the network takes for
    gibberish, programs, markup or another script: ``und`` has ``LEAST_STRANGE`` of their
    probability.  The labels of the stage's own input train the model, together with windows of
    no language made of them by rule; a disagreeing or missing label rejects nothing.  Without
    any label no language can be told, and all documents with a letter stay.
    """
    model = language.fitted(docs, F.lit(True), strange=True)
    (said,) = free_names(docs, "language")
    told = language.identified(docs, model, said)
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if not model.labels:
        return told.where(lettered).select(*docs.columns)
    strange = (F.col(f"{said}.lang") == language.UNKNOWN) & (F.col(f"{said}.score") >= LEAST_STRANGE)
    return told.where(lettered & ~strange).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: the one with the smallest doc_id."""
    return simhash.one_of_each(docs, simhash.near_duplicates(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as the mix does: not at all, once or twice."""
    mix = stored(mixing.mixed(docs, quality_weights(spark, sf_dir)), "mix")
    return mixing.apply_mix(docs, mix)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document taken, repeats included."""
    return bpe_digests(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("mix", mix_sources),
    ("bpe", encode_tokens),
]

#: Hashes of shingles and tokens have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
