"""WARC archives: writing pages as transactions, reading records back, assembling captures.

A page becomes three records of one transaction: a request, a response (or a revisit, if an equal
payload of at least MIN_REVISIT bytes has a smaller page_id) and a metadata record; request and
metadata name the response in WARC-Concurrent-To, a revisit the record it repeats in WARC-Refers-To. Archives are gzipped text files whose line
separator is WARC's record end, so Spark's own committer writes them; the reader goes by
Content-Length alone and takes plain, gzipped and per-record-gzipped archives.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 100
FILE_BYTES = 24 << 20  # of a file, on average,
MOST_BYTES = 1 << 30  # and at most, unless one record has more
SALTS = 64  # parts that the revisits of one record are looked up in
CRLF = "\r\n"
RECORD = "warc_type string, record_id string, concurrent_to string, refers_to string, target_uri string, warc_date string, content_type string, page_id long, payload_bytes long, payload_digest string, payload binary, fields map<string,string>"


def _id(kind: str) -> Column:
    h = F.md5(F.concat_ws("\x1f", F.lit(kind), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.coalesce("url", F.lit("null")), F.col("digest")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without its end. Headers whose value is null are left out."""
    lines = [F.concat(F.lit(f"{k}: "), v, F.lit(CRLF)) for k, v in [*headers, ("Content-Length", F.octet_length(block).cast("string"))]]
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), F.concat_ws("", *lines), F.lit(CRLF), block)


def mark_revisits(pages: DataFrame, files: int) -> DataFrame:
    """page_id, url, html (null: empty), size, digest, id, first: (page_id, id) of the row of smallest page_id, then id, with the same payload if it has MIN_REVISIT bytes.

    The rows of a payload are spread over as many parts as there are files, so one that fills a third
    of the table fills a third of each file: each part's minimum, then the minimum of these, goes back
    to the parts.
    """
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text.alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("long").alias("size"), F.sha2(F.col("html").cast("binary"), 256).alias("digest"), F.pmod(F.xxhash64("page_id"), F.lit(files)).cast("int").alias("salt")).withColumn("id", _id("response"))
    least = rows.where(f"size >= {MIN_REVISIT} and page_id is not null").groupBy("digest", "salt").agg(F.min(F.struct("page_id", "id")).alias("first"))
    whole = least.groupBy(F.col("digest").alias("d")).agg(F.min("first").alias("first"), F.count("*").alias("parts"))
    back = least.select("digest", "salt").join(whole, F.col("digest") == F.col("d")).select("digest", "salt", "first")
    return rows.repartition(files, "digest", "salt").join(back.repartition(files, "digest", "salt"), ["digest", "salt"], "left")


def write_archives(pages: DataFrame, path: str) -> None:
    """Writes all pages (page_id, url, html; other columns are ignored) as archives under path.

    Null html is an empty payload, a null url an empty target, a null page_id goes without a number
    and is never the first of its payload. Rows that repeat a page_id are records of their own;
    those with the smallest page_id of a payload are all responses.
    """
    size = F.octet_length(F.col("html").cast("string")).cast("long")
    total, most = pages.agg(F.sum(F.coalesce(size, F.lit(0)) + 1500), F.max(size)).first()
    rows = mark_revisits(pages, max(1, -(-(total or 0) // FILE_BYTES)))
    page, null = F.col("page_id").cast("string"), F.lit(None).cast("string")
    uri = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), " ", "%20"), "\r", "%0D"), "\n", "%0A")
    again = F.col("first").isNotNull() & ~F.col("first.page_id").eqNullSafe(F.col("page_id"))
    date = F.lit("2024-01-01T00:00:00Z")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF * 2))
    common = [("WARC-Target-URI", uri), ("WARC-Date", date)]
    response = _record(
        [("WARC-Type", F.when(again, "revisit").otherwise("response")), ("WARC-Record-ID", F.col("id")), *common, ("Content-Type", F.lit("application/http; msgtype=response")), ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
         ("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), ("WARC-Refers-To", F.when(again, F.col("first.id")))],
        F.when(again, head).otherwise(F.concat(head, "html")),
    )
    request = _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", _id("request")), ("WARC-Concurrent-To", F.col("id")), *common, ("Content-Type", F.lit("application/http; msgtype=request"))], F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{CRLF * 2}")))
    facts = F.concat(F.concat(F.lit("payloadBytes: "), F.col("size").cast("string"), F.lit(CRLF)), F.coalesce(F.concat(F.lit("pageId: "), page, F.lit(CRLF)), F.lit("")))
    metadata = _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _id("metadata")), ("WARC-Concurrent-To", F.col("id")), *common, ("Content-Type", F.lit("application/warc-fields"))], facts)
    rows.select(F.explode(F.array(request, response, metadata)).alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", max(3, MOST_BYTES // ((most or 0) + 1500))).text(path)


def inflate(data: bytes) -> bytes:
    """A plain file, or all members of a gzipped one."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data[:2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        out += [d.decompress(data), d.flush()]
        data = d.unused_data
    return b"".join(out)


def records(data: bytes):
    """(headers with lower-cased names, block) of every record; a record that breaks off or has no valid length ends the file as (None, rest)."""
    at = 0
    while True:
        while data[at : at + 1] in (b"\r", b"\n"):
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\r\n\r\n", at)
        lines = data[at : max(end, at)].split(b"\r\n")
        headers = {k.strip().lower().decode("utf-8", "replace"): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in lines[1:])}
        length = headers.get("content-length", "")
        if end < 0 or not lines[0].startswith(b"WARC/") or not length.isdigit() or end + 4 + int(length) > len(data):
            yield None, data[at:]
            return
        at = end + 4 + int(length)
        yield headers, data[end + 4 : at]


def parsed(headers: dict | None, block: bytes, keep: bool) -> dict:
    """One row of RECORD."""
    row = dict.fromkeys(("warc_type", "record_id", "concurrent_to", "refers_to", "target_uri", "warc_date", "content_type", "page_id", "payload_bytes", "payload_digest", "payload", "fields"))
    if headers is None:
        return row | {"warc_type": "malformed", "payload": block if keep else None}
    names = {"warc-type": "warc_type", "warc-record-id": "record_id", "warc-concurrent-to": "concurrent_to", "warc-refers-to": "refers_to", "warc-target-uri": "target_uri", "warc-date": "warc_date", "content-type": "content_type"}
    row |= {column: headers[name] for name, column in names.items() if name in headers}
    kind = row["warc_type"]
    if row["content_type"] == "application/warc-fields":
        fields = dict(tuple(s.strip() for s in x.partition(":")[::2]) for x in block.decode("utf-8", "replace").split("\r\n") if ":" in x)
        number = lambda k: int(fields[k]) if fields.get(k, "").lstrip("-").isdigit() else None
        return row | {"fields": list(fields.items()), "page_id": number("pageId"), "payload_bytes": number("payloadBytes")}
    payload = block.partition(b"\r\n\r\n")[2] if (row["content_type"] or "").startswith("application/http") else block
    if kind == "revisit":
        return row | {"payload_digest": headers.get("warc-payload-digest", "").removeprefix("sha256:") or None}
    return row | {"payload_bytes": len(payload), "payload_digest": hashlib.sha256(payload).hexdigest(), "payload": payload if keep else None}


def read_records(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """All records of the archives under path, one row each; payloads only if asked for."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches):

        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for headers, block in records(inflate(content.as_py())):
                    rows.append(parsed(headers, block, keep_payload))
                    size += len(block) if keep_payload else 0
                    if len(rows) >= 2000 or size > 16 << 20:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    text = pa.string()
    arrow = pa.schema([(n, text) for n in ("warc_type", "record_id", "concurrent_to", "refers_to", "target_uri", "warc_date", "content_type")] + [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", text), ("payload", pa.binary()), ("fields", pa.map_(text, text))])
    return files.mapInArrow(run, RECORD)


def assemble(rows: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit, with the request and the metadata of its transaction.

    Records meet through WARC-Concurrent-To, whichever of the two names the other. Of several
    requests or metadata records of one capture that with the smallest record id is taken; a capture
    without one has a null there. Requests and metadata that name no capture are left out.
    """
    main = rows.where("warc_type in ('response', 'revisit')")
    ids = main.select(F.col("record_id").alias("capture"), F.col("concurrent_to").alias("other"))

    def side(kind: str, *columns: str) -> DataFrame:
        own = rows.where(F.col("warc_type") == kind)
        made = F.struct("record_id", *columns)
        named = own.where("concurrent_to is not null").select(F.col("concurrent_to").alias("capture"), made.alias(kind))
        naming = ids.where("other is not null").join(own.withColumn(kind, made).select(F.col("record_id").alias("other"), kind), "other").select("capture", kind)
        return named.union(naming).groupBy("capture").agg(F.min(kind).alias(kind))

    request, metadata = side("request", "target_uri", "warc_date"), side("metadata", "page_id", "payload_bytes")
    out = main.withColumnRenamed("record_id", "capture").drop("page_id", "concurrent_to").join(request, "capture", "left").join(metadata, "capture", "left")
    response = F.struct("target_uri", "warc_date", "content_type", "payload_digest", F.coalesce("payload_bytes", "metadata.payload_bytes").alias("payload_bytes"), "refers_to", "payload")
    return out.select("capture", F.col("warc_type").alias("record_type"), "request", response.alias("response"), "metadata")


def resolved(captures: DataFrame) -> DataFrame:
    """captures of assemble() with `original`: of a revisit the metadata of the capture that it refers to, null if that isn't there.

    The revisits of one record are looked up in SALTS parts. The captures are read three times.
    """
    salt = F.pmod(F.xxhash64("capture"), F.lit(SALTS)).cast("int")
    revisits = captures.where("record_type = 'revisit'").select("*", F.col("response.refers_to").alias("of"), salt.alias("salt"))
    asked = revisits.where("of is not null").select("of", "salt").distinct()
    named = captures.where("record_type = 'response'").groupBy(F.col("capture").alias("of")).agg(F.min("metadata").alias("original"))
    found = asked.join(named, "of")
    main = captures.where("record_type != 'revisit'")
    none = F.lit(None).cast(captures.schema["metadata"].dataType).alias("original")
    return revisits.join(found, ["of", "salt"], "left").select(*captures.columns, "original").union(main.select(*captures.columns, none))
