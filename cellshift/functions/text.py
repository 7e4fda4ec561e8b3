"""Scalar columns over labels, paths and keys.  All stay inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters stripped from both ends of a label.
WHITESPACE = " \t\n\r\f\u000b"


def normalized_label(col: Column) -> Column:
    return F.lower(F.btrim(col, F.lit(WHITESPACE)))


def slug(col: Column) -> Column:
    """Letters, digits, ``-`` and ``_`` stay; anything else becomes ``_``."""
    cleaned = F.btrim(F.regexp_replace(col, r"[^\p{L}\p{N}_-]", "_"), F.lit("_"))
    return F.when(cleaned == "", F.lit("default")).otherwise(cleaned)


def compact_tag(values: Column) -> Column:
    """A short tag for a list of labels: three slugs, then ``_more``, 63 characters."""
    named = F.filter(values, lambda v: v.rlike(r"(?U)\S"))
    slugs = F.array_sort(F.array_distinct(F.transform(named, slug)))
    joined = F.concat(
        F.array_join(F.slice(slugs, 1, 3), "_"),
        F.when(F.size(slugs) > 3, F.lit("_more")).otherwise(F.lit("")),
    )
    cut = F.rtrim(F.left(joined, F.lit(63)), F.lit("_-."))
    return (
        F.when(F.size(slugs) == 0, F.lit("none"))
        .when(F.length(joined) <= 63, joined)
        .when(cut == "", F.lit("none"))
        .otherwise(cut)
    )


def numbered_key(prefix: str, ordinal: Column) -> Column:
    """``exp_0007`` style keys; numbers past four digits keep all their digits."""
    return F.format_string(prefix + "_%04d", ordinal.cast("bigint"))


def path_key(col: Column) -> Column:
    return F.ltrim(F.replace(col, F.lit("\\"), F.lit("/")), F.lit("/"))


def root_key(col: Column) -> Column:
    return F.rtrim(F.replace(col, F.lit("\\"), F.lit("/")), F.lit("/"))


def last_segment(prefix: Column) -> Column:
    return F.element_at(F.split(F.rtrim(prefix, F.lit("/")), "/"), -1)


def is_dataset_file(col: Column) -> Column:
    return F.lower(root_key(col)).endswith(".h5ad")


def check_severity(passed: Column) -> Column:
    return F.when(passed, F.lit("WARN")).otherwise(F.lit("ERROR"))


def alert_message(severity: Column, description: Column) -> Column:
    return F.concat(
        F.lit("["),
        F.coalesce(severity, F.lit("ERROR")),
        F.lit("] "),
        F.coalesce(description, F.lit("Asset check failed.")),
    )


def asset_path(parts: Column) -> Column:
    return F.array_join(parts, "/")


def timed_run_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def typed_run_id(perturbation_type: Column, token: Column) -> Column:
    return F.concat_ws("__", slug(perturbation_type), F.left(token, F.lit(12)))


def batch_run_id(perturbation_type: Column, batch_key: Column, token: Column) -> Column:
    return F.concat_ws("__", perturbation_type, batch_key, F.left(token, F.lit(12)))
