"""A content-addressed web archive: payload bytes once by SHA-256, exact record headers apart, records joined on reading.

`write_archive` makes two tables below a folder: `payloads` (digest, payload) with each distinct payload once, and
`headers` (page, digest, header) with one row per record, its header block byte for byte. `read_archive` joins
them back to records, recomputes every digest and refuses an archive whose bytes differ from their digest.

Of the records with equal payloads of at least `least` bytes, that with the smallest id is the response and the others
are revisits of it, whose WARC block is empty; shorter payloads are always responses.

Defined results: a null payload is empty; a null URL has no WARC-Target-URI; a null id has no WARC-Record-ID, sorts after
all others and, as a response, cannot be referred to. Rows that repeat the id and payload of a response are
responses too. Line breaks in a URL are percent-encoded. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Responses named in a broadcast (id and digest, about 100 bytes each); more are found by a shuffled join.
BROADCAST_ROWS = 300_000


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def _header(date: str) -> Column:
    revisit = F.col("record_type") == "revisit"
    return F.encode(
        F.concat(
            F.lit("WARC/1.1\r\n"),
            _field("WARC-Type", F.col("record_type")),
            _field("WARC-Record-ID", _urn(F.col("page"))),
            _field("WARC-Target-URI", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")),
            _field("WARC-Date", F.lit(date)),
            _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
            _field("WARC-Refers-To", F.when(revisit, _urn(F.col("first")))),
            _field("Content-Type", F.lit("text/html; charset=utf-8")),
            _field("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
        ),
        "UTF-8",
    )


def write_archive(pages: DataFrame, root: str, id: str = "page_id", url: str = "url", payload: str = "html",
                  least: int = 100, date: str = "1970-01-01T00:00:00Z") -> None:
    """Archive every row of `pages` below the folder `root`, which all executors share."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    full = pages.select(F.col(id).cast("long").alias("page"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    full = full.withColumn("digest", F.sha2("payload", 256))

    # Everything but the payloads, digested once.
    full.select("page", "url", "digest", F.octet_length("payload").cast("long").alias("n_bytes")).write.parquet(f"{root}/records")
    records = spark.read.parquet(f"{root}/records")
    same = records.groupBy("digest", "page").agg(F.count(F.lit(1)).alias("copies"))
    # A null id sorts last.
    same.groupBy("digest").agg(F.min(F.struct(F.col("page").isNull(), "page", "copies")).alias("of")).select(
        "digest", F.col("of.page").alias("first"), F.col("of.copies").alias("copies")
    ).write.parquet(f"{root}/firsts")
    firsts = spark.read.parquet(f"{root}/firsts")

    later = (F.col("n_bytes") >= least) & F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    headers = records.join(firsts, "digest").withColumn("record_type", F.when(later, F.lit("revisit")).otherwise(F.lit("response")))
    headers.select("page", "digest", _header(date).alias("header")).write.parquet(f"{root}/headers")

    known = firsts.agg(F.count(F.lit(1)), F.max("copies")).first()
    owners = firsts.select(F.col("digest").alias("own_digest"), F.col("first").alias("own_page"))
    owners = F.broadcast(owners) if known[0] <= BROADCAST_ROWS else owners
    once = full.join(owners, (F.col("digest") == F.col("own_digest")) & F.col("page").eqNullSafe(F.col("own_page")), "left_semi")
    once = once.select("digest", "payload")
    if (known[1] or 0) > 1:  # rows that repeat an id with its payload
        once = once.dropDuplicates(["digest"])
    once.write.option("compression", "zstd").parquet(f"{root}/payloads")


def _read_field(name: str) -> Column:
    found = F.regexp_extract("head", f"(?md)^{name}: (.*?)\r$", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """(page, url, record_type, refers_to, digest, payload, record) of every record below `root`.

    `payload` is the full payload, of revisits too; `record` is the WARC record as it stands in a file. The digest is
    computed anew from the joined payload; a difference ends the query.
    """
    joined = spark.read.parquet(f"{root}/headers").join(spark.read.parquet(f"{root}/payloads"), "digest", "left")
    held = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest"))
    joined = joined.withColumn("head", F.decode("header", "UTF-8"))
    page = lambda name: F.regexp_extract(_read_field(name), "^<urn:page:(-?[0-9]+)>$", 1).cast("long")
    block = F.when(_read_field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    ends = F.encode(F.lit("\r\n"), "UTF-8"), F.encode(F.lit("\r\n\r\n"), "UTF-8")
    return joined.select(
        page("WARC-Record-ID").alias("page"),
        _read_field("WARC-Target-URI").alias("url"),
        _read_field("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        F.coalesce(held, F.raise_error(F.concat(F.lit("the payload is not what its digest says: "), "digest")).cast("string")).alias("digest"),
        "payload",
        F.concat("header", ends[0], block, ends[1]).alias("record"),
    )
