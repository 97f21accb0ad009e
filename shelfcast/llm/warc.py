"""Content-addressed WARC archive.

``write_archive`` turns pages into WARC/1.1 records and stores them in two
Parquet tables under one folder: ``payloads`` (digest -> bytes, each once) and
``headers`` (the exact header bytes of every record).  ``read_archive`` parses the
headers, checks every stored payload against its digest, and rebuilds the
records by joining both on the digest.

Of records with equal payloads the one with the largest ``page_id`` is the
response, the others are revisits that refer to it.  Payloads are told apart
by SHA-1 as WARC writes it together with SHA-256 and length, so two
different payloads never share an entry even if their SHA-1 collide.

Defined cases: a null html is an empty payload; a null ``url`` is written as
an empty target; CR, LF and % in a url are percent-encoded in the header; a null
``page_id`` comes before all others; of repeated rows (equal ``page_id``, ``url``
and payload) one is the response and the rest revisit it; an empty table gives empty tables;
other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir, read_table

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(raw: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 digest (160 bits = 32 digits)."""
    digest = F.sha1(raw)
    digits = []
    for block in range(4):
        bits = F.conv(F.substring(digest, 10 * block + 1, 10), 16, 10).cast("bigint")      # 40 bits, 8 digits
        for j in range(8):
            digits.append(F.substring(F.lit(_BASE32), F.shiftright(bits, 35 - 5 * j).bitwiseAND(F.lit(31)).cast("int") + 1,
                                      F.lit(1)))
    return F.concat(*digits)


def _record_id(page_id: Column, copy: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"),
                    copy.cast("string"), F.lit(">"))


def _encoded(url: Column) -> Column:
    out = F.coalesce(url, F.lit(""))
    for raw, code in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        out = F.replace(out, F.lit(raw), F.lit(code))
    return out


def _decoded(url: Column) -> Column:
    for raw, code in (("\n", "%0A"), ("\r", "%0D"), ("%", "%25")):
        url = F.replace(url, F.lit(code), F.lit(raw))
    return url


def write_archive(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to ``path``/payloads and ``path``/headers."""
    raw = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    known = pages.select("page_id", "url", raw.alias("payload"), sha1_base32(raw).alias("sha1"),
                         F.concat_ws("-", F.sha2(raw, 256), F.length(raw).cast("string")).alias("key"))
    # identical rows are counted, so that every record has an identity
    records = known.groupBy("page_id", "url", "sha1", "key").agg(F.count("*").alias("copies"))
    best = records.groupBy("key").agg(F.max(F.struct(F.col("page_id").isNotNull(), "page_id", F.coalesce("url", F.lit(""))
                                                     .alias("u"), F.col("url").isNotNull().alias("named"), "url")).alias("best"))
    best = best.select("key", F.col("best.page_id").alias("best_id"), F.col("best.url").alias("best_url"))
    marked = (records.join(best, "key").select("*", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int")))
                                               .alias("copy")))
    is_best = F.col("page_id").eqNullSafe(F.col("best_id")) & F.col("url").eqNullSafe(F.col("best_url"))
    first = is_best & (F.col("copy") == 0)
    eol = F.lit("\r\n")
    length = F.when(first, F.element_at(F.split("key", "-"), 2)).otherwise(F.lit("0"))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(first, F.lit("response")).otherwise(F.lit("revisit")), eol,
        F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), _identity(F.col("url"), F.col("key"), F.col("copy"))), eol,
        F.lit("WARC-Target-URI: "), _encoded(F.col("url")), eol,
        F.lit(f"WARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"), F.col("sha1"), eol,
        F.when(first, F.lit("")).otherwise(F.concat(
            F.lit(f"WARC-Profile: {_REVISIT}\r\nWARC-Refers-To: "),
            _record_id(F.col("best_id"), _identity(F.col("best_url"), F.col("key"), F.lit(0))), eol)),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "), length, eol, eol)
    marked.select(header.cast("binary").alias("header"), "key").write.parquet(f"{path}/headers")
    # each payload once: the response's row; joined and de-duplicated under one exchange by page and key
    # (a plain equality on a name that is never null: the grouping then keeps the join's partitions)
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null")).alias("page")
    winners = best.select(named("best_id"), "key")
    stored = (known.select(named("page_id"), "key", "payload").join(winners, ["page", "key"])
              .groupBy("page", "key").agg(F.first("payload").alias("payload")))
    stored.select("key", "payload").write.parquet(f"{path}/payloads")


def _identity(url: Column, key: Column, copy: Column) -> Column:
    """Tells the records of one page_id apart."""
    return F.concat(F.substring(F.sha2(F.concat_ws("|", F.coalesce(url, F.lit("")), key), 256), 1, 16), F.lit("."),
                    copy.cast("string"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: page_id, url, record_type, refers_to, payload_digest, payload_bytes, header, payload.

    A stored payload whose digest does not fit is an error, not a silent loss.
    """
    head = F.col("header").cast("string")

    def field(name: str) -> Column:
        return F.regexp_extract(head, rf"\r\n{name}: ([^\r]*)\r\n", 1)

    def page_of(record_id: Column) -> Column:
        number = F.regexp_extract(record_id, r"<urn:page:(-?[0-9]+):", 1)
        return F.when(number != "", number.cast("bigint"))

    headers = spark.read.schema("header binary, key string").parquet(f"{path}/headers")
    parsed = headers.select("header", "key", field("WARC-Type").alias("record_type"),
                            page_of(field("WARC-Record-ID")).alias("page_id"), _decoded(field("WARC-Target-URI")).alias("url"),
                            page_of(field("WARC-Refers-To")).alias("refers_to"),
                            F.regexp_extract(head, r"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]{32})\r\n", 1).alias("payload_digest"))
    payloads = spark.read.schema("key string, payload binary").parquet(f"{path}/payloads")
    checked = payloads.select(
        F.col("key").alias("p_key"), "payload", sha1_base32(F.col("payload")).alias("found"),
        F.length("payload").cast("bigint").alias("payload_bytes"),
        (F.concat_ws("-", F.sha2("payload", 256), F.length("payload").cast("string")) == F.col("key")).alias("intact"))
    joined = parsed.join(checked, F.col("key") == F.col("p_key"), "left")
    fits = F.coalesce(F.col("intact") & (F.col("found") == F.col("payload_digest")), F.lit(False))
    # the check is part of the value, so it is never pruned away
    verified = F.when(fits, F.col("payload_bytes")).otherwise(
        F.raise_error(F.concat(F.lit("missing or damaged payload "), F.col("key"))).cast("bigint"))
    return joined.select("page_id", "url", "record_type", "refers_to", "payload_digest",
                         verified.alias("payload_bytes"), "header", "payload")


def record_bytes(records: DataFrame) -> DataFrame:
    """Adds ``record``: the exact bytes of the WARC record (revisits carry no block)."""
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return records.withColumn("record", F.concat("header", block, F.lit(b"\r\n\r\n")))


def op4(spark, sf_dir) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
with p as (
  select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as hex from pages
), ranked as (
  select *, max(page_id) over (partition by body) as best, row_number() over (partition by body order by page_id desc) as rn
  from p
)
select page_id, strlen(body)::bigint as payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('{_BASE32}',
         (1 + ((('0x' || substr(hex, (1 + 10 * (i // 8))::bigint, 10))::bigint >> (35 - 5 * (i % 8))::integer) & 31))::bigint, 1)),
         'string_agg', '') as payload_digest,
       case when rn = 1 then 'response' else 'revisit' end as record_type,
       case when rn > 1 then best end as refers_to
from ranked
"""
