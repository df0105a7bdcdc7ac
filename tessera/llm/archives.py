"""Web archives (WARC 1.1): written, read back and assembled into captures.

Each capture is a transaction of three records: the request, the response (or a
revisit, where another capture holds the same payload) and metadata; request and
metadata name the capture's record in WARC-Concurrent-To.  ``write_archives``
composes records as text columns and lets Spark's text writer lay them into
gzip files, with the blank lines that end a record as line separator.
``read_archives`` lets Spark's text reader cut the files at version lines, and puts
a record together again where its payload holds such a line itself
(Content-Length decides); a file is streamed, so memory is bounded by a record.  ``captures`` joins the records by their identifiers, in
whichever direction a crawler wrote them, into one nested row per capture.

Of the pages with equal payloads the one with the largest page_id (then the
largest url) is the response and the others revisit it.  Payloads move between
machines once, one copy for each distinct payload.

Defined results: a null html is an empty payload; a null page_id is smaller than
any number; repeated rows are captures of their own (one response, the others
revisits); a null url gives records without a target; blanks and control
characters of a url are written as %20; an empty table gives empty archives; only
``page_id``, ``url`` and ``html`` are read, so other names cannot clash.  A capture
without request or metadata has nulls there; of several, the one with the least
record id stands.  A damaged record, or a payload unlike its digest, raises.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BATCH_ROWS, batch_rows
from tessera.session import cut_lineage, ensure_checkpoint_dir, remove

#: payloads below this size are always written as responses
MIN_REVISIT_BYTES = 0
#: the pages have no times
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
#: where the reader cuts: no part of it is a beginning of it, so that a reader
#: that works buffer by buffer finds every one
MARK = "\nWARC/1."

PAYLOAD = ["digest", "n", "x"]


def base32_sha1(data: Column) -> Column:
    """Base32 form of a SHA-1 digest: ten hex digits are eight of its digits."""
    digits = [F.lpad(F.conv(F.substring(F.sha1(data), at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(kind: str, digest: Column, page_id: Column, url: Column, copy: Column) -> Column:
    """A name-based identifier, the same in every run."""
    name = F.concat_ws("|", F.lit(kind), digest, F.coalesce(page_id.cast("string"), F.lit("null")), copy.cast("string"),
                       F.coalesce(F.concat(F.lit("u"), url), F.lit("null")))
    h = F.md5(name)
    cut = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)),
           F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: str, own_id: Column, uri: Column, fields: list[tuple[str, Column | str]], block: Column) -> Column:
    """A record without the blank lines behind it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n"), line("WARC-Record-ID", own_id), line("WARC-Date", DATE),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")), *[line(*f) for f in fields],
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def _transaction(kind: str, captures: DataFrame) -> DataFrame:
    """The records of captures (page_id, url, digest, n, copy, html or refers_to)."""
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    key = (F.col("digest"), F.col("page_id"), F.col("url"), F.col("copy"))
    own = record_id("capture", *key)
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n").cast("string"), F.lit(END))
    fields = [("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))]
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", F.col("refers_to"))]
    block = head if kind == "revisit" else F.concat(head, F.col("html"))
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\x00-\x20\x7F]*)", 1)
    asked = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("*")), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END))
    page = F.coalesce(F.concat(F.lit("page: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    records = [
        _record("request", record_id("request", *key), uri, [
            ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request")], asked),
        _record(kind, own, uri, [*fields, ("Content-Type", "application/http; msgtype=response")], block),
        _record("metadata", record_id("metadata", *key), uri, [
            ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")], page)]
    return captures.select(F.explode(F.array(*records)).alias("value"))


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write a transaction for every row of ``pages`` to gzip files in ``path``."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.select("*", base32_sha1(F.col("html").cast("binary")).alias("digest"),
                       F.octet_length("html").cast("long").alias("n"), F.xxhash64("html").alias("x"))
    large = rows.where(F.col("n") >= min_revisit_bytes)
    newest = F.max(F.struct("page_id", "url")).alias("newest")
    # the payload itself moves here only; copies meet in the map tasks already
    responses = large.groupBy(*PAYLOAD).agg(newest, F.first("html").alias("html")).select(
        "newest.page_id", "newest.url", "digest", "n", F.lit(1).alias("copy"), "html")
    small_rows = cut_lineage(large.groupBy(*PAYLOAD, "page_id", "url").agg(F.count("*").alias("rows")))
    shared = small_rows.groupBy(*PAYLOAD).agg(newest, F.sum("rows").alias("all")).where(F.col("all") > 1).select(*PAYLOAD, "newest")
    is_newest = F.col("page_id").eqNullSafe(F.col("newest.page_id")) & F.col("url").eqNullSafe(F.col("newest.url"))
    copies = small_rows.join(shared, PAYLOAD).select("*", F.sequence(
        F.when(is_newest, 2).otherwise(1).cast("long"), F.col("rows")).alias("copies")).where(~is_newest | (F.col("rows") > 1))
    revisits = copies.select("page_id", "url", "digest", "n", F.explode("copies").alias("copy"), record_id(
        "capture", F.col("digest"), F.col("newest.page_id"), F.col("newest.url"), F.lit(1)).alias("refers_to"))
    records = _transaction("response", responses).unionAll(_transaction("revisit", revisits))
    if min_revisit_bytes > 0:
        tiny = rows.where(F.col("n") < min_revisit_bytes).groupBy("page_id", "url", "html", "digest", "n").agg(F.count("*").alias("rows"))
        records = records.unionAll(_transaction("response", tiny.withColumn(
            "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))))
    records.write.option("lineSep", END).option("compression", "gzip").text(path)


RECORDS = ("record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, "
           "content_type string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary")
_SCHEMA = pa.schema([
    ("record_id", pa.string()), ("type", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
    ("target_uri", pa.string()), ("date", pa.string()), ("content_type", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])


def _fields(head: bytes) -> list[tuple[str, str]]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n") if b":" in line)
    return [(k.strip().lower().decode("utf-8", "replace"), v.strip().decode("utf-8", "replace")) for k, _, v in pairs]


def _length(piece: bytes) -> tuple[int, int]:
    """(where the block begins, where the record ends) of a piece that begins a record."""
    at = piece.find(b"\r\n\r\n")
    found = [v for k, v in _fields(piece[:at]) if k == "content-length"] if at >= 0 else []
    if not found or not found[0].isdigit():
        raise ValueError("a record has no length")
    return at + 4, at + 4 + int(found[0])


def _parsed(piece: bytes, begin: int, payloads: bool) -> dict:
    """A row of ``RECORDS`` from a whole record."""
    fields = _fields(piece[: begin - 4])
    of = dict(reversed(fields))
    kind, block, digest, n = of.get("warc-type"), piece[begin:], of.get("warc-payload-digest"), None
    own: list[tuple[str, str]] = []
    if of.get("content-type", "").startswith("application/http"):
        head, _, block = block.partition(b"\r\n\r\n")
        own = _fields(head)
    elif of.get("content-type") == "application/warc-fields":
        own = _fields(block)
    digest = digest and digest.rpartition(":")[2]
    if kind == "revisit":
        size = dict(own).get("content-length", "")
        n = int(size) if size.isdigit() else None
    else:
        n = len(block)
        if kind == "response":
            computed = base64.b32encode(hashlib.sha1(block).digest()).decode()
            if digest not in (None, computed):
                raise ValueError(f"the payload of {of.get('warc-record-id')} is unlike its digest")
            digest = computed
    return {"record_id": of.get("warc-record-id"), "type": kind, "refers_to": of.get("warc-refers-to"),
            "concurrent_to": [v for k, v in fields if k == "warc-concurrent-to"], "target_uri": of.get("warc-target-uri"),
            "date": of.get("warc-date"), "content_type": of.get("content-type"), "payload_digest": digest, "payload_bytes": n,
            "fields": list(dict(own).items()), "payload": block if payloads else None}


def records_of(pieces: Iterator[tuple[str, bytes]], payloads: bool = True) -> Iterator[dict]:
    """Records from the pieces (file, bytes) between two ``MARK``s, in order."""
    file, held, size, bounds = None, [], 0, (0, 0)

    def whole() -> dict:
        piece = MARK.encode().join(held)
        if piece[bounds[1] :].strip(b"\r\n"):
            raise ValueError(f"a record of {file} is longer than it says")
        return _parsed(piece[: bounds[1]], bounds[0], payloads)

    for path, piece in pieces:
        if path != file:
            if held:
                raise ValueError(f"{file} ends inside a record")
            file, piece = path, piece.removeprefix(b"WARC/1.")
        if not held:
            bounds, size = _length(piece), -len(MARK)
        held.append(piece)
        size += len(MARK) + len(piece)
        if size >= bounds[1]:
            yield whole()
            held = []
    if held:
        raise ValueError(f"{file} ends inside a record")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the gzip archives in ``path`` (columns of ``RECORDS``);
    without ``payloads`` the contents are checked and measured, not returned."""
    lines = spark.read.option("lineSep", MARK).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = ((f, v) for b in batches for f, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        rows: list[dict] = []
        n = 0
        for row in records_of(pieces, payloads):
            rows.append(row)
            n += len(row["payload"] or b"")
            if len(rows) >= BATCH_ROWS or n >= 16 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                rows, n = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    batch_rows(spark, BATCH_ROWS)
    return lines.mapInArrow(records, RECORDS)


def captures(records: DataFrame) -> DataFrame:
    """One row (record_id, type, target_uri, response, request, metadata) per
    capture, the last three nested; ``response`` is the response or revisit record."""
    main = records.where(F.col("type").isin("response", "revisit", "resource"))
    beside = records.where(F.col("type").isin("request", "metadata"))
    body = ["record_id", "date", "content_type", "payload_digest", "payload_bytes", "fields", "refers_to", "payload"]
    named = beside.select(F.explode("concurrent_to").alias("capture"), "type", "record_id", F.struct(*body).alias("record"))
    # crawlers that name the request in the response's own record
    back = main.select(F.explode("concurrent_to").alias("to"), F.col("record_id").alias("capture"))
    back = back.join(beside, back["to"] == beside["record_id"]).select("capture", "type", "record_id", F.struct(*body).alias("record"))
    least = lambda kind: F.expr(f"min_by(record, record_id) FILTER (WHERE type = '{kind}')").alias(kind)
    linked = named.unionAll(back).groupBy("capture").agg(least("request"), least("metadata"))
    return main.join(linked, F.col("record_id") == F.col("capture"), "left").select(
        "record_id", "type", "target_uri", F.struct(*body).alias("response"), "request", "metadata")


def archive_report(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every
    page, from archives that are written and read back."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives/{uuid.uuid4().hex}"
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    try:
        write_archives(pages, path, min_revisit_bytes)
        # written once: the assembly reads the records from three sides
        records = cut_lineage(read_archives(spark, path, payloads=False))
        found = cut_lineage(captures(records).select(
            "record_id", "type", F.col("metadata.fields")["page"].cast("long").alias("page_id"),
            "response.payload_bytes", "response.payload_digest", "response.refers_to"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        remove(spark, path)
    columns = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type")]
    responses = found.where("type = 'response'")
    to = responses.select(F.col("record_id").alias("to"), F.col("page_id").alias("to_page"))
    revisits = found.where("type = 'revisit'").join(to, F.col("refers_to") == F.col("to"), "left")
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionAll(
        revisits.select(*columns, F.col("to_page").alias("refers_to")))
