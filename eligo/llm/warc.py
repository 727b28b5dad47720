"""WARC archives as dictionary-compressed Zstandard files.

A dictionary is built from a bounded sample of the records.  Each file starts with a
skippable frame that holds the dictionary; every record is a frame of its own, so
a record can be read by its offset with nothing but the file's head.

Tasks write files into the shared folder under names of their own attempt and return
an index row for each record; the index is written by Spark, which keeps one attempt
of each task.  Files that the index does not name (of lost attempts) are never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import materialize, pick, scratch_path, type_of

SKIPPABLE = 0x184D2A5D
MOST_BROADCAST_ROWS = 1_000_000    # verdicts, of some 30 bytes
TASK_BYTES = 256 << 20             # of archives that a reading task takes
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(records: DataFrame, body_col: str, sample_records: int = 4000, sample_bytes: int = 8 << 20,
                     dict_bytes: int = 64 << 10) -> bytes:
    """A Zstandard dictionary of a sample of whole records, or b"" if there is too little to learn from.

    The sample is bounded: about ``sample_records`` rows by a hash of the body, none longer than
    ``sample_bytes / 64``, ``sample_bytes`` in total.
    """
    fit = records.select(F.col(body_col).alias("b")).where(F.octet_length("b").between(1, sample_bytes // 64))
    total = fit.count()
    if total > sample_records:
        share = F.pmod(F.xxhash64("b"), F.lit(1 << 30)) / float(1 << 30)
        fit = fit.where(share < sample_records / total)
    got, size = [], 0
    for (b,) in fit.distinct().orderBy(F.xxhash64("b"), "b").limit(sample_records).toLocalIterator():
        if size + len(b) > sample_bytes:
            break
        got.append(bytes(b))
        size += len(b)
    try:
        return zstandard.train_dictionary(min(dict_bytes, max(256, size // 8)), got).as_bytes() if len(got) >= 8 else b""
    except zstandard.ZstdError:  # too little variety
        return b""


def _record(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record.  A revisit keeps the HTTP head, with the payload's length, and no payload."""
    http = _HTTP.format(len(payload)).encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>",
            "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
            f"Content-Length: {len(block)}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of a record, its digest checked against the payload it holds."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    f = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(f["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
    if f["WARC-Type"] == "response" and (len(payload), payload_digest(payload)) != (length, digest):
        raise ValueError(f"page {f.get('X-Page-ID')}: payload and digest differ")
    return {"page_id": f.get("X-Page-ID"), "url": f.get("WARC-Target-URI"), "record_type": f["WARC-Type"],
            "payload_bytes": length, "payload_digest": digest, "refers_to": f.get("X-Refers-To-Page-ID"),
            "payload": payload if f["WARC-Type"] == "response" else None}


def numbered_pages(pages: DataFrame, id_col: str, url_col: str, body_col: str) -> DataFrame:
    """(id, url, body, row, sha, n), written: row numbers are made once and read from the table from now on."""
    src = pick(pages, id=id_col, url=url_col, body=body_col).select(
        "id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("body"), F.lit("")).cast("binary").alias("body"))
    path = scratch_path(pages.sparkSession, "warc-rows")
    rows = src.withColumns({"row": F.monotonically_increasing_id(), "sha": F.unhex(F.sha2("body", 256)),
                            "n": F.octet_length("body")})
    rows.write.option("compression", "zstd").parquet(path)  # whole bodies: the denser codec halves the copy
    return pages.sparkSession.read.parquet(path)


def dedup_plan(rows: DataFrame, min_bytes: int) -> DataFrame:
    """(id, url, body, refers_to, revisit): of equal payloads the smallest id is the response.

    Payloads are told apart by length and SHA-256.  Repeated rows of that id: one is the response (nulls last).
    Verdicts are found on keys alone, so no body is shuffled by its digest: groups of one payload are written before
    they are joined (a hot payload is then split), and a verdict finds its row by the row's number.
    """
    keys = rows.where(F.col("n") >= min_bytes).select("id", "row", "sha", "n")
    first = materialize(keys.groupBy("sha", "n").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1").select("sha", "n", "first"), "warc-firsts")
    revisits = materialize(keys.join(first, ["sha", "n"]).where(F.col("row") != F.col("first.row"))
                           .select("row", F.col("first.id").alias("refers_to"), F.lit(True).alias("revisit")), "warc-revisits")
    small = revisits.count() <= MOST_BROADCAST_ROWS
    return rows.join(F.broadcast(revisits) if small else revisits.hint("shuffle_hash"), "row", "left").select(
        "id", "url", "body", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit"))


def arrow_uri(uri: str) -> str:
    """A shared folder's address as Arrow names it; raises for schemes it has no store for."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return uri
    if scheme == "file":
        return "/" + rest.lstrip("/")
    known = {"s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "abfs": "abfs", "abfss": "abfss"}
    if scheme not in known:
        raise ValueError(f"no store for {scheme}:// addresses: {uri}")
    return f"{known[scheme]}:{rest}"


def write_warc(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
               body_col: str = "html", min_bytes: int = 0, level: int = 6, file_bytes: int = 256 << 20,
               **sample) -> DataFrame:
    """Writes a record for each row into files under ``path`` (a shared folder) and returns the index:
    ``file, offset, length, page_id, record_type``.

    A null body is empty; a record without an id or a URL lacks that header; an empty table writes no file.
    """
    folder = path or scratch_path(pages.sparkSession, "warc")
    target = arrow_uri(folder)    # refused before any work
    rows = numbered_pages(pages, id_col, url_col, body_col)
    plan = dedup_plan(rows, min_bytes)
    dictionary = train_dictionary(rows, "body", **sample)
    shared = pages.sparkSession.sparkContext.broadcast(dictionary)

    def write(batches):
        store, root = fs.FileSystem.from_uri(target)
        store.create_dir(root, recursive=True)
        t = TaskContext.get()
        zd = zstandard.ZstdCompressionDict(shared.value) if shared.value else None
        zip_ = zstandard.ZstdCompressor(level=level, dict_data=zd, write_checksum=True)
        out = name = None
        at = number = 0
        for b in batches:
            rows: list[tuple] = []
            for page_id, url, body, refers_to, revisit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name = f"part-{t.partitionId():05d}-{t.taskAttemptId()}-{number}.warc.zst"
                    out, at, number = store.open_output_stream(f"{root}/{name}", compression=None), 0, number + 1
                    head = struct.pack("<II", SKIPPABLE, len(shared.value)) + shared.value
                    out.write(head)
                    at += len(head)
                frame = zip_.compress(_record(page_id, url, body, refers_to, revisit))
                out.write(frame)
                rows.append((f"{folder}/{name}", at, len(frame), page_id, "revisit" if revisit else "response"))
                at += len(frame)
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, x) for c, x in zip(cols, (pa.string(), pa.int64(), pa.int64(), b.schema.field(0).type,
                                                       pa.string()), strict=True)],
                names=["file", "offset", "length", "page_id", "record_type"])
        if out is not None:
            out.close()

    return materialize(plan.mapInArrow(write, "file string, offset bigint, length bigint, "
                                              f"page_id {type_of(plan, 'id')}, record_type string"), "warc-index")


def read_warc(index: DataFrame) -> DataFrame:
    """Every record of the files in an index, parsed and checked; one task reads a file as a stream, frame by frame.

    ``page_id, refers_to`` (text), ``url, record_type, payload_bytes, payload_digest, payload`` (null for revisits).
    """
    # The list of names is written with the files' sizes and then dealt out evenly: names are small, the files are not,
    # and a repartition right above the grouping would be dropped for the grouping's own partitions, which AQE coalesces.
    files = materialize(index.groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("size")), "warc-files")
    count, size = files.agg(F.count("*"), F.sum("size")).first()
    tasks = max(int(index.sparkSession.conf.get("spark.sql.shuffle.partitions")), (size or 0) // TASK_BYTES)
    files = files.select("file").repartition(max(1, min(count, tasks)))
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)],
                                          names=names)

    def read(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                store, at = fs.FileSystem.from_uri(arrow_uri(uri))
                rows, size = [], 0
                with store.open_input_stream(at, compression=None) as f:
                    for raw in frames(f):
                        rows.append(parse_record(raw))
                        size += len(raw)
                        if size > 8 << 20:
                            yield batch(rows)
                            rows, size = [], 0
                yield batch(rows)

    return files.mapInArrow(read, "page_id string, url string, record_type string, payload_bytes bigint, "
                                  "payload_digest string, refers_to string, payload binary")


def frames(f):
    """The decompressed frames of a file that starts with its dictionary's skippable frame."""
    magic, size = struct.unpack("<II", f.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame at the head")
    raw = f.read(size)
    zd = zstandard.ZstdCompressionDict(raw) if raw else None
    unzip = zstandard.ZstdDecompressor(dict_data=zd)
    buffer, obj, out = b"", None, []
    while True:
        if not buffer:
            buffer = f.read(1 << 20)
            if not buffer:
                break
        if obj is None:
            obj, out = unzip.decompressobj(), []
        out.append(obj.decompress(buffer))
        buffer = b""
        if obj.eof:
            yield b"".join(out)
            buffer, obj = obj.unused_data, None
    if obj is not None:
        raise ValueError("the last frame is cut short")
