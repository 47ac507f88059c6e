"""WARC archives: writing pages as transactions, reading and assembling them again.

Archives are written and read with Spark's text source, so they live wherever Spark's
tables do.  A record ends with a blank line and the next one begins with ``WARC/1.``; that
pair is the separator of the records, so large archives split and no record needs its
whole file in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import discard, keep, table

# Names and line ends of the WARC 1.1 and HTTP formats
VERSION = "WARC/1.1"
CRLF = "\r\n"
BLANK = "\r\n\r\n"
MARK = "WARC/1."
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _lines(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _urn(kind: str) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(kind), F.col("row_id"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")


def _record(kind: str, record_id: Column, headers: list, content_type: str, block: Column) -> Column:
    return _lines(
        f"{VERSION}{CRLF}WARC-Type: {kind}{CRLF}WARC-Record-ID: ", record_id, CRLF,
        "WARC-Date: ", F.col("captured"), CRLF, "WARC-Target-URI: ", F.col("uri"), CRLF, *headers,
        f"Content-Type: {content_type}{CRLF}Content-Length: ", F.octet_length(block).cast("string"), BLANK, block,
    )


def _body(payload: Column) -> tuple[Column, Column]:
    """Transfer header and body.  A payload that holds ``WARC/1.`` itself is sent in chunks

    whose borders cut that text, so that it can't be taken for the start of a record.
    """
    parts = F.split(payload, MARK.replace(".", r"\."), -1)
    head, tail = MARK[:5], MARK[5:]
    last = F.size(parts) - 1
    chunk = F.transform(
        parts,
        lambda p, i: F.concat(
            F.when(i > 0, tail).otherwise(""), p, F.when(i < last, head).otherwise("")
        ),
    )
    coded = F.transform(chunk, lambda c: F.concat(F.lower(F.hex(F.octet_length(c))), F.lit(CRLF), c, F.lit(CRLF)))
    chunked = F.concat(F.array_join(coded, ""), F.lit("0" + BLANK))
    split = F.contains(payload, F.lit(MARK))
    return F.when(split, f"Transfer-Encoding: chunked{CRLF}").otherwise(""), F.when(split, chunked).otherwise(payload)


def write_warc(
    pages: DataFrame, path: str, revisit_from: int = 1000, captured: str = "2026-01-01T00:00:00Z", compression: str = "gzip"
) -> None:
    """Write request, response or revisit, and metadata record of every row of ``pages``.

    Needs page_id, url and html; a null html is an empty payload, a null url becomes
    ``about:blank``.  Of rows with equal payloads of at least ``revisit_from`` bytes the
    one with the largest page_id (null smallest; of equal ids any one) is the response,
    the others are revisits that refer to it.  Control characters and spaces of urls are
    percent-coded.  No rows make an archive without records.  With ``gzip`` every file is
    one compressed stream; ``none`` leaves large files splittable.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    uri = F.coalesce(F.regexp_replace("url", r"[\x00-\x20]", "%20"), F.lit("about:blank"))
    rows = keep(
        pages.select("page_id", uri.alias("uri"), payload.alias("payload"))
        .withColumn("bytes", F.octet_length("payload"))
        .withColumn("digest", F.sha1("payload"))
        .withColumn("row_id", F.monotonically_increasing_id()),
        "pages",
    )
    # only payloads seen twice matter; both buffers have a fixed width
    rank = F.coalesce(F.col("page_id"), F.lit(-(2**63)))
    first = (
        rows.where(F.col("bytes") >= revisit_from)
        .groupBy("digest", "bytes")
        .agg(F.max_by("row_id", rank).alias("first_row"), F.max_by("page_id", rank).alias("first_page"), F.count("*").alias("n"))
        .where("n > 1")
    )
    first = keep(first, "first-captures")
    joined = rows.alias("r").join(first.alias("f"), ["digest", "bytes"], "left")
    revisit = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row_id"))
    ids = joined.select(
        "page_id", "uri", "payload", "bytes", "digest", F.lit(captured).alias("captured"), revisit.alias("revisit"),
        _urn("capture").alias("capture_id"), _urn("request").alias("request_id"), _urn("metadata").alias("metadata_id"),
        F.struct(F.col("first_page").alias("page_id"), F.col("first_row").alias("row_id")).alias("first"),
    )
    first_id = F.regexp_replace(
        F.md5(F.concat_ws(":", F.lit("capture"), F.col("first.row_id"), F.coalesce(F.col("first.page_id").cast("string"), F.lit("")))),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>",
    )
    http = _lines(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}X-Payload-Length: ", F.col("bytes").cast("string"), CRLF)
    transfer, body = _body(F.col("payload"))
    digest = [_lines("WARC-Payload-Digest: sha1:", F.col("digest"), CRLF)]
    with_request = [_lines("WARC-Concurrent-To: ", F.col("capture_id"), CRLF)]
    answer = F.when(
        F.col("revisit"),
        _record(
            "revisit", F.col("capture_id"),
            [*digest, f"WARC-Profile: {SAME_PAYLOAD}{CRLF}WARC-Refers-To: ", first_id, CRLF],
            "application/http; msgtype=response", _lines(http, CRLF),
        ),
    ).otherwise(
        _record("response", F.col("capture_id"), digest, "application/http; msgtype=response", _lines(http, transfer, CRLF, body))
    )
    host = F.regexp_extract("uri", r"^[a-zA-Z]+://([^/?#]*)", 1)
    asked = F.regexp_replace("uri", r"^[a-zA-Z]+://[^/?#]*", "")
    request = _record(
        "request", F.col("request_id"), with_request, "application/http; msgtype=request",
        _lines("GET ", F.when(asked == "", "/").otherwise(asked), f" HTTP/1.1{CRLF}Host: ", host, BLANK),
    )
    metadata = _record(
        "metadata", F.col("metadata_id"), with_request, "application/warc-fields",
        _lines("page_id: ", F.coalesce(F.col("page_id").cast("string"), F.lit("")), CRLF),
    )
    records = ids.select(F.explode(F.array(request, answer, metadata)).alias("value"))
    records.write.option("lineSep", BLANK).option("compression", compression).text(path)
    discard(rows, first)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of archives: type, id, concurrent_to (a list), refers_to, uri, date, digest, block, complete.

    Headers may come in any order and case, of version 1.0 or 1.1; a missing one is null.
    ``block`` has the stated Content-Length.  Where that can't be, ``complete`` is false
    and ``block`` what was found: the record was cut off, states no length, or its block
    holds a blank line and ``WARC/1.`` (what follows them is then a record without type).
    Blocks are read as UTF-8.
    """
    raw = spark.read.option("lineSep", BLANK + MARK).text(path)
    # the first record of a file has no blank line before it
    value = F.when(F.startswith("value", F.lit(MARK)), F.expr(f"substring(value, {len(MARK) + 1})")).otherwise(F.col("value"))
    raw = raw.select(value.alias("value")).where(F.trim("value", F.lit(CRLF)) != "")
    head = F.substring_index("value", BLANK, 1)
    split = raw.select(head.alias("head"), F.expr(f"substring(value, length(substring_index(value, '{_sql(BLANK)}', 1)) + 5)").alias("rest"))

    def field(name: str) -> Column:
        value = F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*?)[ \t]*(?=\r\n|$)", 1)
        return F.when(value != "", value)

    stated, found = field("Content-Length").try_cast("long"), F.octet_length("rest")
    # the last record of a file still has the blank line after it
    last = (found == stated + len(BLANK)) & F.endswith(F.col("rest"), F.lit(BLANK))
    block = F.when(last, F.expr(f"left(rest, greatest(length(rest) - {len(BLANK)}, 0))")).otherwise(F.col("rest"))
    return split.select(
        F.lower(field("WARC-Type")).alias("type"),
        field("WARC-Record-ID").alias("id"),
        F.regexp_extract_all("head", F.lit(r"(?i)\r\nWARC-Concurrent-To:[ \t]*([^\r\n]*[^\r\n \t])"), 1).alias("concurrent_to"),
        field("WARC-Refers-To").alias("refers_to"),
        field("WARC-Target-URI").alias("uri"),
        field("WARC-Date").alias("date"),
        field("WARC-Payload-Digest").alias("digest"),
        block.alias("block"),
        F.coalesce(last | (found == stated), F.lit(False)).alias("complete"),
    )


def unread(records: DataFrame) -> DataFrame:
    """One row: all records, and those of :func:`read_warc` that are incomplete, without type or without id."""
    return records.agg(
        F.count("*").alias("records"),
        F.count_if(~F.col("complete")).alias("incomplete"),
        F.count_if(F.col("type").isNull()).alias("without_type"),
        F.count_if(F.col("id").isNull()).alias("without_id"),
    )


def _sql(text: str) -> str:
    return text.replace("\r", "\\r").replace("\n", "\\n")


def http_payload(block: Column) -> Column:
    """Body of an HTTP message, chunks joined."""
    head = F.substring_index(block, BLANK, 1)
    body = F.substring(block, F.length(head) + 5, F.length(block))
    chunked = F.contains(head, F.lit("Transfer-Encoding: chunked"))
    # borders of our chunks lie inside MARK only, see _body
    cut = MARK[:5] + CRLF + "[0-9a-f]+" + CRLF + MARK[5:].replace(".", r"\.")
    joined = F.regexp_replace(F.regexp_replace(F.regexp_replace(body, "^[0-9a-f]+\r\n", ""), "\r\n0\r\n\r\n$", ""), cut, MARK)
    return F.when(chunked, joined).otherwise(body)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: its request, response or revisit, and metadata records

    joined through their concurrent-to identifiers, whichever side states them.
    ``requests`` and ``metadata`` are lists by record id (a record read twice is in them
    once), empty without such records.  Requests and metadata that belong to no response or
    revisit are left out; so are records without type.
    """
    answers = records.where(F.col("type").isin("response", "revisit"))
    beside = records.where(F.col("type").isin("request", "metadata"))
    record = F.struct("id", "date", "block").alias("record")
    # most archives state the links in the records beside the answer
    told = answers.select(F.col("id").alias("capture_id"), F.explode("concurrent_to").alias("id"))
    links = (
        beside.select(F.explode("concurrent_to").alias("capture_id"), "type", record)
        .unionByName(beside.join(told, "id").select("capture_id", "type", record))
        .groupBy("capture_id")
        .agg(*[F.array_sort(F.collect_set(F.when(F.col("type") == t, F.col("record")))).alias(n) for t, n in (("request", "requests"), ("metadata", "metadata"))])
    )
    digest = F.regexp_replace("digest", "^sha1:", "")
    is_response = F.col("type") == "response"
    answers = answers.select(
        F.col("id").alias("capture_id"), "uri", "date", "type", "refers_to", digest.alias("digest"),
        F.substring_index("block", BLANK, 1).alias("http"), F.when(is_response, http_payload(F.col("block"))).alias("payload"),
    )
    name = F.col("capture_id").alias("id")
    response = F.struct(name, "date", "http", "payload")
    size = F.regexp_extract("http", r"X-Payload-Length: (\d+)", 1).try_cast("long")
    revisit = F.struct(name, "date", "http", "refers_to", F.col("digest").alias("payload_digest"), size.alias("payload_bytes"))
    return answers.join(links, "capture_id", "left").select(
        "capture_id", "uri",
        F.coalesce("requests", F.array()).alias("requests"), F.coalesce("metadata", F.array()).alias("metadata"),
        F.when(is_response, response).alias("response"),
        F.when(F.col("type") == "revisit", revisit).alias("revisit"),
    )


def page_digests(rows: DataFrame) -> DataFrame:
    """Per capture of :func:`captures`: its page, payload digest and, for revisits, the page referred to."""
    page = F.regexp_extract(F.array_join("metadata.block", CRLF), r"page_id: (-?\d+)", 1)
    flat = rows.select(
        "capture_id",
        F.when(page != "", page.cast("long")).alias("page_id"),
        F.coalesce(F.octet_length("response.payload").cast("long"), "revisit.payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha1("response.payload"), "revisit.payload_digest").alias("payload_digest"),
        F.when(F.col("response").isNotNull(), "response").otherwise("revisit").alias("record_type"),
        F.col("revisit.refers_to").alias("target"),
    )
    flat = keep(flat, "captures")
    firsts = flat.where("record_type = 'response'").select(F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to"))
    pointed = flat.where("target IS NOT NULL").join(firsts, "target", "left")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    plain = flat.where("target IS NULL").withColumn("refers_to", F.lit(None).cast("long"))
    return plain.select(*names).unionByName(pointed.select(*names))


def op7_warc(spark, sf_dir):
    """All pages written as archives and read back."""
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return page_digests(captures(read_warc(spark, path)))


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
f AS (SELECT payload, max(page_id) AS first_page FROM p WHERE n >= 1000 GROUP BY payload)
SELECT page_id, n AS payload_bytes, sha1(p.payload) AS payload_digest,
  CASE WHEN first_page IS NULL OR first_page = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_page <> page_id THEN first_page END AS refers_to
FROM p LEFT JOIN f ON p.payload = f.payload
"""
