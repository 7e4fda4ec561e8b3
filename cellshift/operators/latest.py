"""The newest row per key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows whose ``order``, a number unique within its key, is the largest of the key.

    The largest number is found on the key columns alone, by partial hash
    aggregates.  The wide rows then join on key and number together, a key that
    is unique, so a key with very many rows is spread like any other.
    """
    newest = df.groupBy(*keys).agg(F.max(order).alias(order))
    same = [df[k].eqNullSafe(newest[k]) for k in keys]
    condition = df[order] == newest[order]
    for c in same:
        condition = condition & c
    return df.join(newest, condition, "left_semi")
