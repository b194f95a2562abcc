"""WARC archives: written with an index first, read back by coalesced byte ranges.

Writing: pages are joined with the one page per payload digest that holds the payload (the
largest page_id among equal payloads); it becomes a response record, the others revisit
records without payload.  Each task writes one archive of gzip members under a name of its
own and returns the index of its records: file, offset, length, URL, digest.  The index is
a Parquet table, committed by Spark: archives of failed or repeated attempts are in no
index and are never read.

Reading: the selected index rows are range-partitioned and sorted by file and offset, and
neighbouring ranges (gap up to ``GAP``) become one read of at most ``READ`` bytes, cut again
into records, each verified against its digest.

Null html is an empty payload.  A null URL has no target header; control characters in URLs
are percent-encoded in the header (the index keeps the URL as it is).  Null page_ids are
smallest, as are null URLs; of rows equal in page_id and payload the greatest URL is the
response, of rows equal in it too one is, and the others revisit it.  Extra columns are ignored; an empty table gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm.common import stored, table
from tributary.session import scratch_path

#: Equal payloads below so many bytes are not deduplicated.
MIN_REVISIT_BYTES = 0
GAP = 64 << 10
READ = 8 << 20
LEVEL = 1
#: Equal rows laid out again by one task.
REPEATS = 100_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("file string, offset long, length long, page_id long, url string, payload_bytes long, "
         "payload_digest string, record_type string, refers_to long")


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared path (local, hdfs, s3, gs) and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def sha1_base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(page_id, url, payload: bytes, size: int, digest: str, refers_to, revisit: bool) -> bytes:
    """One gzip member: a response with its payload, or a revisit with the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {DATE}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"X-Page-Id: {'' if page_id is None else page_id}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {'' if refers_to is None else refers_to}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
              f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return deflate.compress(raw) + deflate.flush()


def parse(raw: bytes) -> dict:
    """Headers and payload of one inflated record; revisits have the payload's size only."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                   for line in head.decode().split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    number = lambda k: int(headers[k]) if headers.get(k) else None
    return {"page_id": number("X-Page-Id"), "url": headers.get("WARC-Target-URI"), "payload": payload,
            "payload_bytes": size, "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
            "record_type": headers["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id")}


def roles(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, sha1, size, holder): holder is null where the page keeps its payload,
    else a struct with the page_id of the one that does.

    Of equal payloads the greatest (page_id, URL) keeps it, nulls being least; of rows equal in
    id, URL and payload one does.  Such rows are alike, so all are folded to one with a count
    (in part before the shuffle) and laid out again, the others without their payload."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    facts = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"), F.sha1(html).alias("sha1"),
                         F.octet_length(html).cast("long").alias("size"))
    rank = F.struct(F.col("page_id").isNotNull().alias("has_id"), F.coalesce("page_id", F.lit(0)).alias("p"),
                    F.col("url").isNotNull().alias("has_url"), F.coalesce("url", F.lit("")).alias("u"))
    # only payloads that occur twice meet their copies; one row per digest on this side
    alike = facts.filter(F.col("size") >= min_bytes).groupBy("sha1", "page_id", "url").agg(F.count("*").alias("n"))
    shared = stored(spark, alike.groupBy("sha1").agg(
        F.max(F.struct(rank.alias("top"), "n")).alias("best"), F.max("page_id").alias("keeper"), F.sum("n").alias("copies"))
        .filter("copies > 1").select("sha1", "best.top", F.col("best.n").alias("n"), "keeper"), "warc-shared")
    joined = facts.join(shared.hint("shuffle_hash"), "sha1", "left")
    keeper = F.struct(F.col("keeper").alias("id"))
    out = ["page_id", "url", "html", "sha1", "size"]
    is_top = F.col("top").isNotNull() & (rank == F.col("top"))
    marked = joined.select(*out, F.when(F.col("top").isNotNull() & ~is_top, keeper).alias("holder"), is_top.alias("is_top"), "n")
    if not shared.filter("n > 1").limit(1).count():
        return marked.select(*out, "holder")
    several = F.col("is_top") & (F.col("n") > 1)
    folded = marked.filter(several).groupBy("page_id", "url", "sha1", "size", "n").agg(F.first("html").alias("html"))
    others = (folded.select("page_id", "url", "sha1", "size", "n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n") - 1, F.lit(REPEATS))).alias("at"))
              .repartition("sha1", "page_id", "url", "at")  # a large group is many tasks
              .withColumn("k", F.explode(F.sequence("at", F.least(F.col("at") + REPEATS, F.col("n")) - 1)))
              .select("page_id", "url", F.lit("").alias("html"), "sha1", "size", F.struct(F.col("page_id").alias("id")).alias("holder")))
    none = F.lit(None).cast("struct<id: bigint>").alias("holder")
    return marked.filter(~several).select(*out, "holder").unionByName(folded.select(*out, none)).unionByName(others)


def write(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes the archives and their index (``<folder>/index``); returns the index."""
    spark = pages.sparkSession
    marked = roles(pages, min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, offset, rows = None, None, 0, []

        def index() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        try:
            for b in batches:
                for page_id, url, html, sha1, size, holder in zip(*(b.column(k) for k in range(6))):
                    page_id, url, holder = page_id.as_py(), url.as_py(), holder.as_py()
                    if out is None:
                        path = f"{folder}/pages-{uuid.uuid4().hex}.warc.gz"
                        fs, at = _fs(path)
                        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                        out = fs.open_output_stream(at, compression=None)
                    digest = sha1_base32(sha1.as_py())
                    data = record(page_id, url, b"" if holder else html.as_py().encode(), size.as_py(), digest,
                                  holder and holder["id"], holder is not None)
                    out.write(data)
                    rows.append((path, offset, len(data), page_id, url, size.as_py(), digest,
                                 "revisit" if holder else "response", holder and holder["id"]))
                    offset += len(data)
                    if len(rows) >= 10_000:
                        yield index()
                        rows = []
        finally:
            if out is not None:
                out.close()
        if rows:
            yield index()
    names = [c.split()[0] for c in INDEX.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int64() for c in INDEX.split(", ")]
    path = f"{folder}/index"
    marked.select("page_id", "url", "html", "sha1", "size", "holder").mapInArrow(run, INDEX).write.parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def read(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows: page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and, if asked for, the payload (null for revisits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        files: dict[str, pa.NativeFile] = {}

        def fetch() -> Iterator[pa.RecordBatch]:
            path, first = held[0][0], held[0][1]
            if path not in files:
                for f in files.values():
                    f.close()
                files.clear()
                fs, at = _fs(path)
                files[path] = fs.open_input_file(at)
            raw = files[path].read_at(held[-1][1] + held[-1][2] - first, first)
            rows = []
            for _, offset, length, digest, url in held:
                r = parse(zlib.decompress(raw[offset - first:offset - first + length], 31))
                if r["payload_digest"] != digest or r["record_type"] == "response" and (
                        base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode() != digest or len(r["payload"]) != r["payload_bytes"]):
                    raise ValueError(f"{path} at {offset}: the record differs from its digest")
                rows.append((r["page_id"], url, r["payload_bytes"], digest, r["record_type"], r["refers_to"])
                            + ((r["payload"] if r["record_type"] == "response" else None,) if with_payload else ()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (row[0] != held[0][0] or row[1] > held[-1][1] + held[-1][2] + GAP
                             or row[1] + row[2] - held[0][1] > READ):
                    yield from fetch()
                    held = []
                held.append(row)
        if held:
            yield from fetch()
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema += ", payload binary" if with_payload else ""
    names = [c.split()[0] for c in schema.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")]
    chosen = index.select("file", "offset", "length", "payload_digest", "url")
    return (chosen.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, schema))


def archive(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return write(pages, scratch_path(spark, "warc"))


def op1_warc(spark, sf_dir):
    return read(archive(spark, table(spark, sf_dir, "pages")), with_payload=False).drop("url")


_GROUP = "('0x' || substr(h, {k}, 5))::BIGINT"
_B32 = " || ".join("substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((" + _GROUP.format(k=5 * g + 1) + f") >> {s}) & 31)::INT + 1, 1)"
                   for g in range(8) for s in (15, 10, 5, 0))
SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top, row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST) AS k FROM p)
SELECT page_id, payload_bytes, {_B32} AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k = 1 THEN NULL ELSE top END AS refers_to FROM g
"""
