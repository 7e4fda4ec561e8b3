"""A content-addressed web archive.

Three tables make an archive.  ``facts`` is scratch; ``payloads`` stores every
distinct payload once under its SHA-256; ``records`` keeps the exact header text
of every record and the address of its payload.  Reading joins the two again and
checks each payload against its address.

Of the records with equal payloads the one with the largest page_id is the
response, the others are revisits of it.  Payloads shorter than ``smallest``
bytes are always stored as responses.

Columns used are page_id, url and html; others are not read.  A null html is an
empty payload; a null url leaves out the target header; a null page_id is smaller
than any other.  Ties in page_id go to the largest url, and of wholly repeated
rows one is the response.  An empty table makes an empty archive.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellshift.llm.common import same

#: The base 32 alphabet, and the date written into records.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"


def base32(hex_digits: Column) -> Column:
    """A SHA-1 given as 40 hex digits, in base 32: five digits make four letters."""
    def letters(i: int) -> Column:
        bits = F.conv(F.substring(hex_digits, 5 * i + 1, 5), 16, 10).cast("int")
        return F.concat(
            *[
                F.substr(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1))
                for s in (15, 10, 5, 0)
            ]
        )

    return F.concat(*[letters(i) for i in range(8)])


def _payload() -> Column:
    return F.encode(F.coalesce("html", F.lit("")), "UTF-8")


def _record_id(page: str, url: str, copy: Column) -> Column:
    """Differs between any two records: page, a digest of payload and url, and the copy of what is alike in all."""
    what = F.sha2(F.concat(F.col("address"), F.coalesce(F.concat(F.lit(" "), url), F.lit(""))), 256)
    number = F.coalesce(F.col(page).cast("string"), F.lit("none"))
    return F.concat(F.lit("<urn:page:"), number, F.lit(":"), F.left(what, F.lit(32)), F.lit(":"), copy, F.lit(">"))


def _header() -> Column:
    """The exact header text: WARC fields, an empty line, then the HTTP head."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    body = F.when(F.col("kind") == "response", F.col("bytes")).otherwise(F.lit(0))
    revisit = F.col("kind") == "revisit"
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("kind")),
        line("WARC-Record-ID", _record_id("page_id", "url", F.col("copy").cast("string"))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", _record_id("first_id", "first_url", F.lit("1"))),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", (F.octet_length(http) + body).cast("string")),
        F.lit("\r\n"),
        http,
    )


def write_archive(pages: DataFrame, path: str, smallest: int = 0) -> None:
    """Write ``payloads`` and ``records`` below ``path``.

    Payloads travel once, by the address and a hash of address, page_id and url, so
    a payload that a third of all pages share is no hot key; everything else works
    on short rows.
    """
    spark = pages.sparkSession
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), _payload().alias("payload")
    ).withColumn("address", F.sha2("payload", 256))
    facts = own.select(
        "page_id",
        "url",
        "address",
        base32(F.sha1("payload")).alias("sha1"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )
    facts = facts.groupBy(*facts.columns).agg(F.count(F.lit(1)).alias("copies"))
    facts.write.parquet(f"{path}/facts")
    facts = spark.read.parquet(f"{path}/facts")

    def row(page: Column, url: Column) -> Column:
        return F.struct(page.alias("page_id"), url.alias("url"))

    facts.groupBy(F.col("address").alias("of")).agg(
        F.max(row(F.col("page_id"), F.col("url"))).alias("first"),
        F.min("sha1").alias("low"),
        F.max("sha1").alias("high"),
    ).select(
        "of",
        F.col("first.page_id").alias("first_id"),
        F.col("first.url").alias("first_url"),
        F.when(F.col("low") == F.col("high"), True)
        .otherwise(F.raise_error(F.lit("two payloads with one address")).cast("boolean"))
        .alias("checked"),
    ).write.parquet(f"{path}/firsts")
    firsts = spark.read.parquet(f"{path}/firsts").where("checked")

    joined = facts.join(firsts, F.col("address") == F.col("of"))
    is_first = same(F.col("page_id"), F.col("first_id")) & same(F.col("url"), F.col("first_url"))
    records = joined.withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    ).withColumn(
        "kind",
        F.when((F.col("bytes") < smallest) | (is_first & (F.col("copy") == 1)), "response").otherwise("revisit"),
    )
    records.select(
        "address", _header().alias("header")
    ).write.parquet(f"{path}/records")

    # keys without nulls, so that the rows of a key stay where the join brought them
    place = F.xxhash64("address", "page_id", "url").alias("place")
    named = firsts.select(
        F.col("of"),
        F.xxhash64(F.col("of"), F.col("first_id"), F.col("first_url")).alias("first_place"),
    )
    (
        own.select("address", place, "payload")
        .join(named, (F.col("address") == F.col("of")) & (F.col("place") == F.col("first_place")))
        .dropDuplicates(["address", "place"])
        .select("address", "payload")
        .write.option("compression", "zstd")
        .parquet(f"{path}/payloads")
    )


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?s)^WARC/1\.1\r\n(?:[^\r\n]+\r\n)*?{name}: ([^\r\n]*)\r\n", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """header, payload, payload_bytes, payload_digest and the parsed header fields of every record.

    Each payload is read once and checked against its address before the join;
    a record whose payload is lost or damaged stops the job.
    """
    payloads = spark.read.parquet(f"{path}/payloads").select(
        F.col("address").alias("at"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32(F.sha1("payload")).alias("payload_digest"),
        (F.sha2("payload", 256) == F.col("address")).alias("sound"),
    )
    records = spark.read.parquet(f"{path}/records")
    joined = records.join(payloads, F.col("address") == F.col("at"), "left")
    page = lambda name: F.regexp_extract(_field(name), r"<urn:page:(-?\d+):", 1)
    number = lambda c: F.when(c != "", c).cast("long")
    sound = F.col("sound") & (_field("WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest")))
    return joined.select(
        "header",
        "payload",
        F.when(F.coalesce(sound, F.lit(False)), F.col("payload_bytes"))
        .otherwise(F.raise_error(F.lit("a payload is lost or damaged")).cast("long"))
        .alias("payload_bytes"),
        "payload_digest",
        _field("WARC-Type").alias("record_type"),
        number(page("WARC-Record-ID")).alias("page_id"),
        number(page("WARC-Refers-To")).alias("refers_to"),
    )


def record_bytes(records: DataFrame) -> DataFrame:
    """The original records, byte for byte: header, payload of a response, two line ends."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.unhex(F.lit("")))
    return records.withColumn(
        "record", F.concat(F.encode("header", "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))
    )


def rebuilt(records: DataFrame) -> DataFrame:
    """Adds ``record``, its bytes, and takes payload, length and digest anew from what was rebuilt.

    The payload of a response is what lies between its header and the two line ends; that of
    a revisit is the one it refers to, which the archive joined by address.
    """
    whole = record_bytes(records)
    inside = F.expr("substring(record, octet_length(header) + 1, octet_length(record) - octet_length(header) - 4)")
    body = F.when(F.col("record_type") == "response", inside).otherwise(F.col("payload"))
    whole = whole.withColumn("payload", body)
    return whole.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", base32(F.sha1("payload"))
    )
