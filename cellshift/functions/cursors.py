"""Read and write the text cursor of the alert feed."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01T00:00:00Z"


def cursor_id(cursor: Column) -> Column:
    """Digits, or the integer under ``id`` of a JSON cursor; anything else is 0."""
    plain = F.when(cursor.rlike(r"^\p{Nd}+$"), cursor.try_cast("bigint"))
    nested = F.btrim(F.get_json_object(cursor, "$.id"), F.lit(" \t\n\r")).try_cast("bigint")
    return F.coalesce(plain, nested, F.lit(0).cast("bigint"))


def cursor_time(cursor: Column) -> Column:
    """The ISO time of a JSON cursor; epoch when it is absent or not a time."""
    nested = F.try_to_timestamp(F.get_json_object(cursor, "$.run_updated_after"))
    return F.coalesce(nested, F.to_timestamp(F.lit(_EPOCH)))


def cursor_text(last_id: Column, moment: Column) -> Column:
    """JSON text of a cursor; ``moment`` is read in the session's (UTC) zone."""
    fraction = F.date_format(moment, "SSSSSS")
    iso = F.concat(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
        F.lit("+00:00"),
    )
    return F.concat(
        F.lit('{"id": '), last_id.cast("string"), F.lit(', "run_updated_after": "'), iso, F.lit('"}')
    )
