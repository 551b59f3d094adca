"""WARC archives: writing with identical payloads as revisits, and reading by a verified chain.

Archives are written by Spark's text writer with the record separator as line separator, so a file
is a plain (gzip-compressed) sequence of records.  A reader cannot trust the magic at
the start of a record, which may as well stand in a payload.  So each task emits, for every place
with the magic and a readable head, an edge to the place where that record would end.  Pointer
jumping from the start of each file then keeps the records on its chain and nothing else.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlift.llm.tables import new_path, written

#: Fixed values of the format.
MAGIC = b"WARC/1.1\r\n"
BETWEEN = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of one file at most, so that a task can hold a file.
RECORDS = 1024
DATE = "2024-01-01T00:00:00Z"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page, url, html, sha, first in zip(*(c.to_pylist() for c in batch.columns)):
            html = html or ""
            digest = base64.b32encode(bytes.fromhex(sha)).decode()
            head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(html.encode())}"]
            block = "\r\n".join([*head, "", "" if first is not None else html])
            fields = [f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {DATE}"]
            if url is not None:
                fields.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
            fields.append(f"WARC-Payload-Digest: sha1:{digest}")
            if first is not None:
                fields += [f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Profile: {REVISIT_PROFILE}"]
            fields += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block.encode())}"]
            out.append(MAGIC.decode() + "\r\n".join([*fields, "", block]))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write one record for each row of ``pages`` (page_id, url, html; others are ignored).

    A null html is an empty payload.  Among payloads of ``least_bytes`` at least that are equal, the one
    with the smallest page_id is a response and the others are revisits that name it; rows that
    share the smallest page_id are all responses, and so are all copies if none has a page_id.
    A null url leaves its header out.  An empty table gives an archive without records.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    copied = rows.where(F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    marked = rows.join(copied, "sha", "left").select("page_id", "url", "html", "sha", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))
    marked.mapInArrow(_records, "value string").write.option("lineSep", BETWEEN).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


def candidates(data: bytes) -> Iterator[tuple[int, int, int | None, int, str, str, int | None]]:
    """(place, end, page_id, payload bytes, digest, type, page referred to) of all that looks like a record."""
    at = data.find(MAGIC)
    while at >= 0:
        head_end = data.find(b"\r\n\r\n", at)
        if head_end < 0:
            return
        fields = {}
        for line in data[at + len(MAGIC) : head_end].split(b"\r\n"):
            name, _, value = line.partition(b": ")
            fields.setdefault(name.lower(), value)
        length = fields.get(b"content-length", b"")
        if length.isdigit():
            start = head_end + 4
            end = start + int(length)
            if data[end : end + 4] == BETWEEN.encode():
                block = data[start:end]
                http, _, payload = block.partition(b"\r\n\r\n")
                kind = fields.get(b"warc-type", b"").decode("utf-8", "replace")
                if kind == "revisit":
                    sizes = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                    size = int(sizes[0]) if sizes and sizes[0].isdigit() else 0
                    digest = fields.get(b"warc-payload-digest", b"").rpartition(b":")[2].decode("utf-8", "replace")
                else:
                    size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                yield at, end + 4, _page(fields.get(b"warc-record-id")), size, digest, kind, _page(fields.get(b"warc-refers-to"))
        at = data.find(MAGIC, at + 1)


def _page(name: bytes | None) -> int | None:
    digits = (name or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(digits) if digits.lstrip(b"-").isdigit() else None


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["at", "next", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for batch in batches:
        for file, value in zip(batch.column(0), batch.column(1)):
            found = list(zip(*candidates(value.as_py()))) or [()] * 7
            files = pa.array([file.as_py()] * len(found[0]), pa.string())
            yield pa.RecordBatch.from_arrays([files, *(pa.array(c, k) for c, k in zip(found, kinds))], names=["file", *names])


def chain(edges: DataFrame) -> DataFrame:
    """(file, at) of the places that are reachable from place 0 of their file along (file, at, next).

    In round k the reachable set takes in what lies 2^k records on, and jumps double.  A round
    is two joins on unique keys and a written table each.
    """
    jumps = edges.select("file", "at", "next")
    reached = edges.where("at = 0").select("file", "at")
    while True:
        ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
        reached = written(reached.unionByName(ahead), "warc-reached")
        jumps = written(jumps.join(jumps.select("file", F.col("at").alias("next"), F.col("next").alias("then")), ["file", "next"]).select("file", "at", F.col("then").alias("next")), "warc-jumps")
        if jumps.isEmpty():
            return reached.join(edges.select("file", "at"), ["file", "at"], "left_semi")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records on the chain of each file.

    Digests of responses are those of the payloads read; a revisit has those its head names.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    schema = "file string, at long, next long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    found = written(files.mapInArrow(_scan, schema), "warc-candidates")
    return found.join(chain(found), ["file", "at"], "left_semi").drop("file", "at", "next")


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes)
    return read_archives(pages.sparkSession, path)
