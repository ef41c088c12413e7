"""WARC archives: written from captures, read back, and assembled into one nested row per capture."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfold.llm.common import bounded_scan, new_folder, prepare, stored

# Fixed values of the format.
VERSION, CRLF, END = "WARC/1.1", "\r\n", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---------------------------------------------------------------- writing

def with_digests(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``pages`` (page_id, url, html) with payload_digest, and leader: the smallest page_id of its equal payloads, null for payloads under
    ``least_bytes`` or met once. Only digests that repeat are joined back."""
    spark = pages.sparkSession

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column("html").cast(pa.binary())
            digests = [payload_digest(h.as_py() or b"") for h in html]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.string())], [*batch.schema.names, "payload_digest"])

    def digested(columns: list[str]) -> DataFrame:
        schema = pages.select(*columns).withColumn("payload_digest", F.lit("")).schema
        return bounded_scan(pages, *columns).mapInArrow(scan, schema)

    large = F.coalesce(F.octet_length("html"), F.lit(0)) >= least_bytes
    repeated = stored(
        digested(["page_id", "html"]).where(large).groupBy("payload_digest").agg(F.min("page_id").alias("leader"), F.count("*").alias("n"))
        .where("n > 1").drop("n"), "warc-repeated")
    found = digested(["page_id", "url", "html"])
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return found.join(repeated, "payload_digest", "left").withColumn("leader", F.when(large, F.col("leader")))


def _record(kind: str, key: Column, headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """A record's text, without the two line ends that close it. A null header value leaves the header out."""
    lines = [F.concat(F.lit(f"{VERSION}{CRLF}WARC-Type: {kind}{CRLF}WARC-Record-ID: "), _name(key, kind), F.lit(f"{CRLF}WARC-Date: {DATE}{CRLF}"))]
    lines += [F.coalesce(F.concat(F.lit(f"{n}: "), v, F.lit(CRLF)), F.lit("")) for n, v in headers]
    lines += [F.concat(F.lit(f"Content-Type: {content_type}{CRLF}Content-Length: "), F.octet_length(block).cast("string"), F.lit(END)), block]
    return F.concat(*lines)


def _name(key: Column, kind: str) -> Column:
    return F.concat(F.lit("<urn:capture:"), key, F.lit(f":{kind}>"))


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, files: int | None = None) -> None:
    """Write request, response (or revisit) and metadata records for each row of ``pages`` (page_id, url, html) as gzip WARC files.

    Of equal payloads of at least ``least_bytes`` bytes the smallest page_id is the response, the others revisit it; rows that share that
    page_id are responses all. A null html is an empty payload; a null url is written as an empty target; line ends in a url are
    percent-encoded. Records of a capture are made from one row in one task and name each other by a key that this task draws, so
    rows with equal or null ids stay apart. Spark's text writer commits the files; ``files`` sets their number.
    """
    rows = with_digests(pages.select("page_id", "url", "html"), least_bytes)
    if files:
        rows = rows.repartition(files)
    key, uri = F.col("key").cast("string"), F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A")
    html = F.coalesce("html", F.lit(""))
    target, main = ("WARC-Target-URI", uri), F.when(F.col("revisit"), _name(key, "revisit")).otherwise(_name(key, "response"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest")))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(html).cast("string"), F.lit(END))
    path_ = F.regexp_extract(uri, "^[a-zA-Z]+://[^/?#]*(/[^?#]*)?", 1)
    request = _record("request", key, [target, ("WARC-Concurrent-To", main)], "application/http;msgtype=request",
                      F.concat(F.lit("GET "), F.when(path_ == "", "/").otherwise(path_), F.lit(f" HTTP/1.1{CRLF}Host: "), F.regexp_extract(uri, "^[a-zA-Z]+://([^/?#]*)", 1), F.lit(END)))
    response = _record("response", key, [target, digest], "application/http;msgtype=response", F.concat(http, html))
    revisit = _record("revisit", key, [target, digest, ("WARC-Profile", F.lit(REVISIT_PROFILE)), ("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("leader").cast("string"), F.lit(">")))],
                      "application/http;msgtype=response", http)
    fields = F.concat(F.coalesce(F.concat(F.lit("pageId: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit("")), F.lit("payloadBytes: "), F.octet_length(html).cast("string"), F.lit(CRLF))
    metadata = _record("metadata", key, [target, ("WARC-Concurrent-To", main)], "application/warc-fields", fields)
    records = rows.withColumns({"key": F.monotonically_increasing_id(), "revisit": F.coalesce(F.col("leader") != F.col("page_id"), F.col("leader").isNotNull())}).select(
        F.explode(F.array(request, F.when(F.col("revisit"), revisit).otherwise(response), metadata)).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").text(path)


# ---------------------------------------------------------------- reading

class Parser:
    """Records out of a stream of bytes, by their Content-Length: (headers in lower case, block)."""

    def __init__(self):
        self.held, self.size, self.need = [], 0, 0

    def feed(self, data: bytes) -> Iterator[tuple[dict, bytes]]:
        self.held.append(data)
        self.size += len(data)
        if self.size < self.need:
            return
        buffer, at = b"".join(self.held), 0
        while True:
            while buffer[at : at + 2] == b"\r\n":  # what closes the record before
                at += 2
            head = buffer.find(b"\r\n\r\n", at)
            self.need = 0
            if head < 0:
                break
            first, *lines = buffer[at:head].decode("utf-8", "replace").split(CRLF)
            if not first.startswith("WARC/"):
                raise ValueError(f"no record where one must begin: {first[:60]!r}")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            end = head + 4 + int(headers["content-length"])
            if end > len(buffer):
                self.need = end - at
                break
            yield headers, buffer[head + 4 : end]
            at = end
        self.held, self.size = [buffer[at:]], len(buffer) - at

    def close(self) -> None:
        if b"".join(self.held).strip():
            raise ValueError("the archive ends within a record")


RECORDS = "type string, record_id string, concurrent_to string, refers_to string, target_uri string, digest string, block binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under ``path``: type, record_id, concurrent_to, refers_to, target_uri, digest (as in its header) and block.

    A file is read by one task as a stream and parsed by the records' lengths, so blocks may hold anything, and no more than a record
    is held. A file that is cut off or no archive stops the read.
    """
    prepare(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("line"))
    names = ("warc-type", "warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-payload-digest")

    fields = ["type", "record_id", "concurrent_to", "refers_to", "target_uri", "digest", "block"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, parser, rows, size = None, None, [], 0

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 7
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns[:-1]), pa.array(columns[-1], pa.binary())], fields)

        for batch in batches:
            lines_, file = batch.column("line").to_pylist(), batch.column("file").dictionary_encode()
            number = file.indices.to_numpy()
            cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(lines_)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if (name := file.dictionary[number[a]].as_py()) != open_:
                    if parser:
                        parser.close()
                    open_, parser = name, Parser()
                for headers, block in parser.feed(b"\n".join(lines_[a:b]) + b"\n"):
                    rows.append((*map(headers.get, names), block))
                    size += len(block)
                    if len(rows) == 1000 or size > 4 << 20:
                        yield out()
                        rows.clear()
                        size = 0
        if parser:
            parser.close()
        yield out()

    return lines.mapInArrow(scan, RECORDS)


def assemble(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One nested row per capture: (capture_id, url, request, response, metadata), joined through concurrent-to identifiers.

    response is the response or revisit record: struct(type, refers_to, target_uri, payload_bytes, payload_digest[, payload]), of a revisit with the
    digest of its header; request is the head sent, metadata a map of its fields. A capture without a request or metadata record has null
    there, of several the first in order of text is taken; records that name no capture, or one that isn't there, are left out. Records meet
    in one shuffle on the identifier, with digests in place of payloads unless ``payloads`` is set.
    """
    names = ["capture_id", "type", "text", "main"]
    parts = "type: string, refers_to: string, target_uri: string, payload_bytes: long, payload_digest: string" + ", payload: binary" * payloads

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, main = [], [], []
            for r in batch.to_pylist():
                kind, block = r["type"], r["block"]
                own = kind in ("response", "revisit")
                keys.append(r["record_id"] if own else r["concurrent_to"] if kind in ("request", "metadata") else None)
                texts.append(None if own else block.decode("utf-8", "replace"))
                payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                found = {"type": kind, "refers_to": r["refers_to"], "target_uri": r["target_uri"]}
                if payload is None:
                    found |= {"payload_bytes": None, "payload_digest": (r["digest"] or "").removeprefix("sha1:") or None}
                else:
                    found |= {"payload_bytes": len(payload), "payload_digest": payload_digest(payload)}
                main.append((found | {"payload": payload} if payloads else found) if own else None)
            kinds = [("type", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
            struct = pa.struct(kinds + [("payload", pa.binary())] * payloads)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), batch.column("type"), pa.array(texts, pa.string()), pa.array(main, struct)], names)

    needed = ["type", "record_id", "concurrent_to", "refers_to", "target_uri", "digest", "block"]
    found = records.select(*needed).mapInArrow(scan, f"capture_id string, type string, text string, main struct<{parts}>").where("capture_id IS NOT NULL")
    first = lambda kind: F.min(F.when(F.col("type") == kind, F.col("text"))).alias(kind)
    joined = found.groupBy("capture_id").agg(F.min("main").alias("response"), first("request"), first("metadata")).where("response IS NOT NULL")
    fields = F.expr(r"str_to_map(rtrim('\r\n', metadata), '\r\n', ': ')")
    return joined.select("capture_id", F.col("response.target_uri").alias("url"), "request", "response", fields.alias("metadata"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "archives")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    captures = assemble(read_records(spark, path), payloads=False)
    number = lambda k: F.col("metadata")[k].cast("long")
    return captures.select(
        number("pageId").alias("page_id"), F.coalesce("response.payload_bytes", number("payloadBytes")).alias("payload_bytes"), "response.payload_digest",
        F.col("response.type").alias("record_type"), F.regexp_extract("response.refers_to", r"^<urn:page:(-?\d+)>$", 1).try_cast("long").alias("refers_to"))
