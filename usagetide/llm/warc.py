"""WARC archives: one gzip member per record, written by tasks and read back in sequence.

Of records with equal payloads the one with the smallest id is a ``response``; the others are
``revisit`` records that name it. Archives are files in a folder that all executors share, opened by
pyarrow's file systems (local paths, hdfs, s3, gs). A task names its files by its attempt, and the
list of files is itself a Parquet table, which Spark commits once per task: files of lost or repeated
attempts are on no list and are never read.

The reader feeds a file to zlib piece by piece, cuts records by their content length, checks that a
gzip member holds exactly one, and verifies block and payload digests. It keeps one record in memory.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import frames, text as T

ROLL_BYTES = 64 << 20
CHUNK_BYTES = 64 << 10
#: Digests with more than 1 / HOT_PARTS of all rows are resolved by broadcast; there are fewer than HOT_PARTS of them.
HOT_PARTS = 512
DATE = "1970-01-01T00:00:00Z"
_VERSION = "WARC/1.1"
_SAME = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URI_SAFE = "!#$%&'()*+,/:;=?@[]~"


class WarcError(ValueError):
    """A record that breaks the format or its digest."""


# ---------------------------------------------------------------- records


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(key: str, uri: str, payload: bytes, refers_to: str | None) -> bytes:
    """One record: a response with ``payload``, or a revisit of ``refers_to`` with its HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{quote(key, safe='')}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(uri, safe=_URI_SAFE)),
        ("WARC-Payload-Digest", "sha1:" + digest(payload)),
        ("WARC-Block-Digest", "sha1:" + digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields[4:4] = [("WARC-Refers-To", f"<urn:page:{quote(refers_to, safe='')}>"), ("WARC-Profile", _SAME)]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"{_VERSION}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member, equal for equal data."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _members(stream: BinaryIO) -> Iterator[bytes]:
    """The unpacked content of each gzip member, from pieces of the file."""
    pending = b""
    while True:
        pending = pending or stream.read(CHUNK_BYTES)
        if not pending:
            return
        unpack, out = zlib.decompressobj(31), io.BytesIO()
        while not unpack.eof:
            if not pending:
                pending = stream.read(CHUNK_BYTES)
                if not pending:
                    raise WarcError("the file ends inside a gzip member")
            try:
                out.write(unpack.decompress(pending))
            except zlib.error as e:
                raise WarcError(f"damaged gzip member: {e}") from e
            pending = b"" if not unpack.eof else unpack.unused_data
        yield out.getvalue()


def _head(data: bytes, start: int) -> tuple[str, dict[str, str], int]:
    """First line, fields (names in lower case) and end of a header block."""
    end = data.find(b"\r\n\r\n", start)
    if end < 0:
        raise WarcError("a header does not end")
    first, *lines = data[start:end].decode("utf-8", "replace").split("\r\n")
    return first, {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines)}, end + 4


def records(stream: BinaryIO) -> Iterator[dict]:
    """Every record of an archive, in order; WarcError where framing or a digest is wrong."""
    for data in _members(stream):
        version, fields, start = _head(data, 0)
        if not version.startswith("WARC/"):
            raise WarcError(f"not a WARC record: {version[:40]!r}")
        try:
            size = int(fields["content-length"])
        except (KeyError, ValueError) as e:
            raise WarcError("a record without a content length") from e
        block = data[start : start + size]
        if len(block) != size or data[start + size :] != b"\r\n\r\n":
            raise WarcError("a record whose content length does not fit its gzip member")
        if "warc-block-digest" in fields and fields["warc-block-digest"] != "sha1:" + digest(block):
            raise WarcError("block digest differs")
        _, http, body = _head(block, 0)
        payload, kind = block[body:], fields.get("warc-type", "")
        said = fields.get("warc-payload-digest", "")
        if kind == "response" and said and said != "sha1:" + digest(payload):
            raise WarcError("payload digest differs")
        refers = fields.get("warc-refers-to")
        yield {
            "record_id": _page(fields.get("warc-record-id", "")),
            "record_type": kind,
            "target_uri": unquote(fields.get("warc-target-uri", "")),
            "refers_to": _page(refers) if refers else None,
            "payload_digest": said.removeprefix("sha1:"),
            # A revisit leaves the payload out but keeps its HTTP head.
            "payload_bytes": len(payload) if kind == "response" else int(http.get("content-length", 0)),
            "payload": payload if kind == "response" else None,
        }


def _page(uri: str) -> str:
    return unquote(uri.strip("<>").removeprefix("urn:page:"))


# ---------------------------------------------------------------- jobs


def mark_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", least_bytes: int = 0) -> DataFrame:
    """``pages`` as ``wr_key``, ``wr_uri``-ready columns: adds ``wr_payload`` (bytes) and ``wr_first``.

    ``wr_first`` is the smallest key among rows with an equal payload of at least ``least_bytes``, or null
    where the row itself has it (rows that repeat key and payload are all responses), where no other row
    has the payload, or where all keys are null. Hot payloads are looked up in a broadcast of fewer than
    HOT_PARTS rows, all others by a join on the digest, so no join key is hot.
    """
    data = pages.withColumn("wr_payload", F.coalesce(T.utf8(payload), F.lit(b"")))
    named = data.withColumn("wr_digest", F.when(F.length("wr_payload") >= least_bytes, F.concat_ws("-", F.sha1("wr_payload"), F.length("wr_payload"))))
    groups = named.where("wr_digest IS NOT NULL").groupBy("wr_digest").agg(F.min(key).alias("wr_least"), F.count(F.lit(1)).alias("n"))
    shared = frames.materialize(groups.where("n > 1"))
    total = shared.agg(F.sum("n")).first()[0] or 0
    limit = F.lit(max(1, total // HOT_PARTS))
    hot = shared.where(F.col("n") > limit).select("wr_digest", F.col("wr_least").alias("wr_hot"))
    cold = shared.where(F.col("n") <= limit).select(F.col("wr_digest").alias("wr_join"), F.col("wr_least").alias("wr_cold"))
    looked = named.join(F.broadcast(hot), "wr_digest", "left")
    # Rows that need no second look get join keys of their own.
    own = F.concat(F.lit("own-"), F.xxhash64(key, F.monotonically_increasing_id()).cast("string"))
    looked = looked.withColumn("wr_join", F.when(F.col("wr_hot").isNull() & F.col("wr_digest").isNotNull(), F.col("wr_digest")).otherwise(own))
    least = F.coalesce("wr_hot", "wr_cold")
    return (
        looked.join(cold, "wr_join", "left")
        .withColumn("wr_first", F.when(least.eqNullSafe(F.col(key)), F.lit(None)).otherwise(least))
        .drop("wr_digest", "wr_join", "wr_hot", "wr_cold")
    )


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
                   least_bytes: int = 0, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write a record per row into ``folder`` and return the list of its archives (``path``, ``n_records``).

    Null keys, URLs and payloads are written as empty. Runs a job.
    """
    rows = mark_revisits(pages, key, payload, least_bytes).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(url).cast("string"), F.lit("")),
        "wr_payload", F.col("wr_first").cast("string"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        stem = f"part-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        done: list[tuple[str, int]] = []
        out, size, count = None, 0, 0
        for batch in batches:
            for k, u, data, first in zip(*batch.columns):
                if out is None:
                    name = f"{stem}-{len(done):05d}.warc.gz"
                    out, size, count = store.open_output_stream(f"{base}/{name}", compression=None), 0, 0
                packed = member(record(k.as_py(), u.as_py(), data.as_py(), first.as_py()))
                out.write(packed)
                size, count = size + len(packed), count + 1
                if size >= roll_bytes:
                    out.close()
                    done.append((f"{folder}/{name}", count))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["path", "n_records"]
        )

    return frames.written(rows.mapInArrow(write, "path string, n_records long"), "archives")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the files in ``path``: one task reads a file from its start to its end."""
    names = ["record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes"]
    kinds = [pa.string()] * 5 + [pa.int64()]
    schema = "record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long"
    if with_payload:
        names, kinds, schema = [*names, "payload"], [*kinds, pa.binary()], schema + ", payload binary"

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for path in batch.column(0).to_pylist():
            store, inner = fs.FileSystem.from_uri(path)
            with store.open_input_stream(inner, compression=None) as stream:
                held, size = [], 0
                for r in records(stream):
                    held.append(r)
                    size += len(r["payload"] or b"") + 500 if with_payload else 500
                    if size >= 4 * T.BUFFER_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([h[n] for h in held], k) for n, k in zip(names, kinds)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([h[n] for h in held], k) for n, k in zip(names, kinds)], names=names)

    count = max(1, archives.count())
    return T.map_batches(archives.select("path").repartition(count), read, schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the cluster's shared folder, as a URI or absolute path."""
    return frames.scratch_path(spark, "warc")
