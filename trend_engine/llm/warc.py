"""WARC archives of web pages: a deterministic sharded writer and its reader.

Writer: pages are range-sorted by page_id; each partition writes its records to files that roll at
``ROLL_BYTES`` of compressed size (one gzip member per record). Headers and digests are made from
the payload and the page's values only, so the same pages give the same bytes. A file is written
under a temporary name that holds the task's attempt; the rows that the tasks return (one per file)
are written as the staging manifest by Spark's own committer, which takes one attempt of each task.
Only then are the files it names renamed, by tasks, and the final manifest is written last. A
reader sees the files of the final manifest alone; what a lost attempt left is in no manifest.

Records: a payload of at least ``LEAST_REVISIT`` bytes that several pages have is a response for the
one with the largest page_id, the others are revisit records that name it; all else is a response.

Storage: paths are opened with pyarrow's file systems (file, hdfs, s3, gs), under the shared folder.

Cases: null html is an empty payload; a null page_id is written like any other and sorts first;
rows equal in page_id and payload are one response, then revisits of it; a null url is left out of
the header; no pages give an empty manifest; extra columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trend_engine.session import scratch_dir

#: Compressed size at which a file is closed; bytes of html for each partition of the writer.
ROLL_BYTES, PARTITION_BYTES = 64 << 20, 128 << 20
LEAST_REVISIT = 1000
#: Date of all records (no clock: reruns give the same files).
DATE = "2020-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard's name space for URLs
_READ = 1 << 20


def _record_id(page, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page}:{digest}:{nth}')}>"


def _clean(url: str) -> str:
    return url.replace("\r", " ").replace("\n", " ")


def record(page, url: str | None, payload: bytes, digest: str, refers, nth: int) -> bytes:
    """The bytes of one record (without compression). refers: None, or the response's page_id."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    revisit = refers is not None
    block = http + (b"\r\n" if revisit else f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page, digest, nth)}",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
            f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}"]
    if page is not None:
        head.append(f"X-Page-Id: {page}")
    if url:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers, digest, 0)}", f"X-Refers-To-Page: {refers}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _plan(pages: DataFrame) -> DataFrame:
    """page_id, url, html, _digest, _refers, _own: the pages (_own 1), and ahead of each one whose
    payload several pages have a row (_own 0) with the response's page_id."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("_digest", F.sha1(F.col("html").cast("binary")))
    # Numbers and digests only: payloads that several pages have, counted before the shuffle.
    slim = rows.where(F.octet_length("html") >= LEAST_REVISIT).select("page_id", "_digest")
    same = slim.groupBy("_digest").agg(F.max("page_id").alias("_refers"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    ids = slim.join(same, "_digest").select("page_id", "_digest", "_refers").distinct()
    # A row ahead of the page's own tells its response: the html moves once, in the range sort.
    none = F.lit(None).cast("string")
    ahead = ids.select("page_id", none.alias("url"), none.alias("html"), "_digest", "_refers", F.lit(0).alias("_own"))
    return rows.select("page_id", "url", "html", "_digest", F.lit(None).cast("long").alias("_refers"), F.lit(1).alias("_own")).unionByName(ahead)


def write(pages: DataFrame, root: str, roll_bytes: int = ROLL_BYTES, partition_bytes: int = PARTITION_BYTES) -> str:
    """Write the archives of `pages` (page_id, url, html) under `root`; path of the manifest."""
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    rows = _plan(pages)
    parts = max(1, math.ceil(size / partition_bytes))
    ordered = rows.repartitionByRange(parts, "page_id", "_digest").sortWithinPartitions("page_id", "_digest", "_own", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, out = fs.FileSystem.from_uri(root)
        part, attempt = task.partitionId(), task.taskAttemptId()
        files.create_dir(f"{out}/temporary", recursive=True)
        stream, done, number, written, count, before, nth = None, [], 0, 0, 0, None, 0
        told: tuple | None = None
        for batch in batches:
            for page, url, html, digest, refers, own in zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True):
                if not own:
                    told = (page, digest, refers)
                    continue
                refers = told[2] if told and told[:2] == (page, digest) else None
                nth = nth + 1 if (page, digest) == before else 0
                before = (page, digest)
                # Of rows equal in page and payload, the first is the response.
                to = None if refers is None or (refers == page and nth == 0) else refers
                member = gzip.compress(record(page, url, html.encode(), digest, to, nth), 6, mtime=0)
                if stream is None:
                    name = f"pages-{part:06d}-{number:06d}.warc.gz"
                    temporary = f"{out}/temporary/{name}.{attempt}"
                    stream, written, count = files.open_output_stream(temporary, compression=None), 0, 0
                stream.write(member)
                written, count = written + len(member), count + 1
                if written >= roll_bytes:
                    stream.close()
                    done.append((name, temporary, count, written))
                    stream, number = None, number + 1
        if stream is not None:
            stream.close()
            done.append((name, temporary, count, written))
        yield pa.RecordBatch.from_arrays([pa.array([d[c] for d in done], t) for c, t in enumerate(
            (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["name", "temporary", "records", "bytes"])

    ordered.mapInArrow(run, "name string, temporary string, records long, bytes long").write.parquet(f"{root}/staging")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, out = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                # A repeated task finds the file renamed already.
                if files.get_file_info(temporary).type != fs.FileType.NotFound:
                    files.move(temporary, f"{out}/{name}")
            yield batch.select(["name", "records", "bytes"])

    spark = pages.sparkSession
    staged = spark.read.schema("name string, temporary string, records long, bytes long").parquet(f"{root}/staging")
    staged.mapInArrow(rename, "name string, records long, bytes long").write.parquet(f"{root}/manifest")
    return f"{root}/manifest"


def _members(stream) -> Iterator[bytes]:
    """The decompressed gzip members of a file, one after the other."""
    inflate, parts = zlib.decompressobj(31), []
    while chunk := stream.read(_READ):
        while chunk:
            parts.append(inflate.decompress(chunk))
            chunk = inflate.unused_data
            if inflate.eof:
                yield b"".join(parts)
                inflate, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the file ends within a record")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record; checks both digests."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if f"sha1:{hashlib.sha1(block).hexdigest()}" != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response" and f"sha1:{hashlib.sha1(payload).hexdigest()}" != fields["WARC-Payload-Digest"]:
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
    return fields, payload


def read(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """One row per record of the committed archives: page_id, url, record_type, payload_bytes,
    payload_digest, refers_to, payload (UTF-8 text; null for revisits, or if not asked for)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, out = fs.FileSystem.from_uri(root)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{out}/{name}", compression=None) as stream:
                    for raw in _members(stream):
                        f, payload = parse(raw)
                        response = f["WARC-Type"] == "response"
                        number = lambda k: int(f[k]) if k in f else None  # noqa: B023, E731
                        rows.append((number("X-Page-Id"), f.get("WARC-Target-URI"), f["WARC-Type"],
                                     len(payload) if response else number("X-Payload-Length"),
                                     f["WARC-Payload-Digest"].removeprefix("sha1:"), number("X-Refers-To-Page"),
                                     payload.decode() if response and payloads else None))
                        size += len(raw) if payloads else 200
                        if size > 8 << 20:
                            yield table(rows)
                            rows, size = [], 0
                yield table(rows)

    manifest = spark.read.schema("name string, records long, bytes long").parquet(f"{root}/manifest").select("name", "records")
    spread = manifest.repartition(max(1, manifest.count()), "name")
    return spread.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload string")


def op6_warc(spark, sf_dir):
    root = scratch_dir(spark, "warc")
    root = root if "://" in root or root.startswith("file:") else f"file://{root}"
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), root, roll_bytes=8 << 20, partition_bytes=16 << 20)
    return read(spark, root, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
