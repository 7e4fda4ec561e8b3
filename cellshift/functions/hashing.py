"""Content fingerprints and version tokens."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_fingerprint(content: Column, label: Column) -> Column:
    """First 20 hex digits over ``label|content``; ``content`` is binary."""
    labelled = F.concat(F.encode(F.concat(label, F.lit("|")), "UTF-8"), content)
    return F.left(F.sha2(labelled, 256), F.lit(20))


def file_fingerprint(key: Column, modified: Column, size: Column) -> Column:
    """First 20 hex digits over path, modification time in ns and size.

    A null size means the file is absent.
    """
    nanos = F.unix_micros(modified) * F.lit(1000)
    raw = F.concat_ws("|", key, nanos.cast("string"), size.cast("string"))
    return F.when(size.isNull(), F.lit("missing")).otherwise(F.left(F.sha2(raw, 256), F.lit(20)))


def version_token(*parts: Column) -> Column:
    """First 24 hex digits over the bar-joined parts; a null part counts as empty text."""
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.left(F.sha2(F.concat_ws("|", *texts), 256), F.lit(24))


def list_token(first: Column, values: Column, *rest: Column) -> Column:
    """Version token whose middle parts are a list, joined in ascending order."""
    joined = F.array_join(F.array_sort(values), "|")
    return version_token(first, joined, *rest)
