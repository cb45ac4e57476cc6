"""WARC archives with a two-level capture index: compressed blocks and a sparse directory."""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweave.llm.common import materialise, small_batches
from feedweave.session import scratch_path

LEAST_REVISIT_BYTES = 100
BLOCK_LINES = 1000  # index lines of one compressed block
INDEX_LINES = 16_000  # index lines of one index file, about
OPEN_FILES = 64  # archives a task holds open
CAPTURED = "2020-01-01T00:00:00Z"
# The format's own names.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# (scheme)(user)(host)(port)(rest)
_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)(?::[0-9]*)?((?s:[/?#].*)?)$"


def surt(url: Column) -> Column:
    """The sort key of a URL: host parts reversed, then the rest; null is empty, other text stays itself."""
    host = F.lower(F.regexp_extract(url, _URL, 1))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_extract(url, _URL, 2))
    return F.coalesce(F.when(host != "", key).otherwise(url), F.lit(""))


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme, as tasks need it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


def _records(pages: DataFrame, id_col: str, url: str, html: str) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``digest``, ``key``, ``refers_to`` (null for responses)."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    slim = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"), surt(F.col(url)).alias("key")
    ).withColumn("digest", F.sha2("payload", 256))
    shared = (
        slim.where(F.octet_length("payload") >= LEAST_REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null")
        .select(F.col("digest").alias("d"), "first")
    )
    # a digest that very many pages share only meets a table of one row each
    joined = slim.join(shared, F.col("digest") == F.col("d"), "left")
    other = F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull())
    return joined.select("page_id", "url", "payload", "key", "digest", F.when(other, F.col("first")).alias("refers_to"))


def _header(value: str | None) -> str:
    """A header value on one line: control characters and blanks are percent-coded."""
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value or "")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed. A revisit has the HTTP header only, with the full payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {CAPTURED}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page: {refers_to}"]
    block = http + (payload if refers_to is None else b"")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers, and the payload of a response, of one uncompressed record; checks lengths and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {headers['WARC-Record-ID']} is damaged")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "page_id": number("X-Page-ID"),
        "record_type": kind,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number("X-Refers-To-Page"),
        "payload": payload if kind == "response" else None,
    }


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write one record for each row into archives under ``folder``; returns the sparse directory.

    The payload is the html in UTF-8 (null: empty). Of the rows with equal payloads of at
    least 100 bytes those with the smallest page id are responses, the others revisit them; a
    payload only rows without id have is never revisited. Null urls sort first and are left out of
    the record. An empty table writes nothing. Other columns are not archived.

    Every task writes one archive of gzip members, in the order its rows come, so payloads are not
    sorted. Their index lines are then range-partitioned by reversed-host key and page id, so a
    host or url with very many rows spreads over index files, and each index file is written as
    sorted, compressed blocks with its sparse directory beside it: first and last key and place
    of every block. File names are unique to the attempt; only files of finished attempts are
    named by the lines, and only their blocks by the returned directory (``file``, ``low``, ``high``).
    """
    spark = pages.sparkSession
    small_batches(spark)
    root = qualified(spark, folder)

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        name, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            lines: list[tuple] = []
            for page_id, url_, payload, key, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                member = zlib_member(record(page_id, url_, payload, digest, refers_to))
                out.write(member)
                lines.append((key, page_id, digest, name, at, len(member)))
                at += len(member)
            yield _table(lines, _LINE)
        if out is not None:
            out.close()

    lines = materialise(_records(pages, id_col, url, html).mapInArrow(archive, _LINE), "captures")
    parts = max(1, -(-lines.count() // INDEX_LINES))
    ordered = lines.repartitionByRange(parts, "key", "page_id", "digest", "file", "offset")
    ordered = ordered.sortWithinPartitions("key", "page_id", "digest", "file", "offset")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        name, out, at = f"{uuid.uuid4().hex}.cdx.gz", None, 0
        blocks: list[tuple] = []
        held: list[tuple] = []

        def close_block() -> None:
            nonlocal at
            packed = zlib_member("\n".join(map(json.dumps, held)).encode())
            out.write(packed)
            blocks.append((held[0][0], held[-1][0], at, len(packed)))
            at += len(packed)
            held.clear()

        for batch in batches:
            for line in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                held.append(line)
                if len(held) == BLOCK_LINES:
                    close_block()
        if held:
            close_block()
        if out is not None:
            out.close()
            with store.open_output_stream(f"{base}/{name}.dir", compression=None) as sparse:
                sparse.write(json.dumps(blocks).encode())
        yield _table([(name, low, high) for low, high, _, _ in blocks], _BLOCK)

    return materialise(ordered.mapInArrow(index, _BLOCK), "capture-directory")


def zlib_member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def lookup(keys: DataFrame, directory: DataFrame, folder: str, key: str = "key", with_payload: bool = True) -> DataFrame:
    """All records whose key is among ``keys``, read through the index.

    Repeated keys count once, null keys not at all; keys without a capture give no row. Each index
    file has one row of bounds that travels with the tasks, one for 16,000 captures. A key goes to the
    index files whose bounds hold it; there it is binary-searched in the file's sparse directory, the few
    blocks that can hold it are read by range, and so are its records. Returns ``key``, ``page_id``,
    ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to`` and ``payload`` (null for revisits, or
    when ``with_payload`` is off).
    """
    spark = keys.sparkSession
    small_batches(spark)
    root = qualified(spark, folder)
    bounds = directory.groupBy("file").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    files = sorted((r["low"], r["high"], r["file"]) for r in bounds.collect())
    lows, highs = [f[0] for f in files], [f[1] for f in files]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (files[i][2], k)
                for k in batch.column(0).to_pylist()
                for i in range(bisect.bisect_left(highs, k), bisect.bisect_right(lows, k))
            ]
            yield _table(found, "file string, key string")

    wanted = keys.select(F.col(key).alias("key")).where("key is not null").distinct()
    routed = wanted.mapInArrow(route, "file string, key string")
    asked = routed.repartition(max(1, len(files)), "file").sortWithinPartitions("file", "key")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        archives = lru_cache(maxsize=OPEN_FILES)(lambda name: store.open_input_file(f"{base}/{name}"))
        now = cached = cdx = None
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for file, wanted_key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if file != now:
                    now, cached, cdx = file, None, store.open_input_file(f"{base}/{file}")
                    with store.open_input_stream(f"{base}/{file}.dir", compression=None) as sparse:
                        blocks = json.loads(sparse.read())
                    block_lows, block_highs = [b[0] for b in blocks], [b[1] for b in blocks]
                first, last = bisect.bisect_left(block_highs, wanted_key), bisect.bisect_right(block_lows, wanted_key)
                for i in range(first, last):
                    if cached != i:
                        packed = cdx.read_at(blocks[i][3], blocks[i][2])
                        lines, cached = [json.loads(x) for x in gzip.decompress(packed).decode().split("\n")], i
                        line_keys = [x[0] for x in lines]
                    for j in range(bisect.bisect_left(line_keys, wanted_key), bisect.bisect_right(line_keys, wanted_key)):
                        _, _, _, archive, offset, length = lines[j]
                        r = parse(zlib.decompress(archives(archive).read_at(length, offset), 31))
                        body = r["payload"] if with_payload else None
                        rows.append((wanted_key, *[r[c] for c in _RECORD_FIELDS], body))
                        held += len(body or b"") + 200
                        if held > 1 << 23:
                            yield _table(rows, _RECORD)
                            rows, held = [], 0
            yield _table(rows, _RECORD)

    return asked.mapInArrow(fetch, _RECORD)


_LINE = "key string, page_id long, digest string, file string, offset long, length int"
_BLOCK = "file string, low string, high string"
_RECORD_FIELDS = ("page_id", "record_type", "payload_bytes", "payload_digest", "refers_to")
_RECORD = "key string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")
