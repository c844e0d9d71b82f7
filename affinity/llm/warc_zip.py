"""WARC records in ZIP-packaged archives: write them, and read single records without extraction.

An archive is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz`` (one gzip
member per WARC record) and ``indexes/index.cdxj`` (a line per record with its offset and length in
that member). A reader parses the end record and the central directory (ZIP64 forms included),
finds where the stored members lie, reads the index and then range-reads the records it wants.

Archives are written by tasks into a folder that all executors share. A file's name holds the task
attempt, and only files listed in the staged manifest are read, so a lost executor or a repeated
attempt leaves at most an unread file.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zipfile
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm.shared import open_store, shared_folder, staged

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# fixed values of the ZIP format: signatures of the end record, the ZIP64 locator and end record, a
# central entry and a local header; field limits that stand for "see the ZIP64 form"
END, LOCATOR, END64, CENTRAL, LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
MAX16, MAX32 = 0xFFFF, 0xFFFFFFFF
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:x-page:"


# ---- records -----------------------------------------------------------------------------------


def _line(value: str) -> str:
    """A header value without control characters."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def build_record(
    key: str | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: str | None, revisit: bool
) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{ID_PREFIX}{_line(key or '')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode(),
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line(url)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <{ID_PREFIX}{_line(refers_to or '')}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (x.split(":", 1) for x in raw.decode("utf-8").split("\r\n")[1:] if ":" in x)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def parse_record(raw: bytes) -> dict:
    """Fields and payload of one record; a response whose payload differs from its digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(warc["warc-payload-digest"].partition(":")[2]).hex()
    name = lambda v: (v or "").strip("<>").removeprefix(ID_PREFIX) or None
    kind = warc["warc-type"]
    size = int(_headers(http)["content-length"])
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {warc.get('warc-record-id')} does not match its digest")
    return {
        "record_id": name(warc.get("warc-record-id")),
        "url": warc.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": name(warc.get("warc-refers-to")),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload if kind == "response" else None,
    }


# ---- the ZIP container ---------------------------------------------------------------------------


class _Sink:
    """The write half of a file: the ZIP writer then never seeks."""

    def __init__(self, out):
        self.out = out

    def write(self, data):
        self.out.write(data)
        return len(data)

    def flush(self):
        pass


class ArchiveWriter:
    """Streams records into one archive; only the index lines are held in memory."""

    def __init__(self, out, level: int = 3):
        self.zip = zipfile.ZipFile(_Sink(out), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.level, self.at, self.lines = level, 0, []

    def add(self, key: str | None, record: bytes) -> None:
        pack = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        data = pack.compress(record) + pack.flush()
        self.member.write(data)
        self.lines.append(f"{key if key is not None else '-'} {json.dumps({'offset': self.at, 'length': len(data)})}")
        self.at += len(data)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines).encode())
        self.zip.close()


def _range(f, at: int, n: int) -> bytes:
    f.seek(at)
    data = f.read(n)
    if len(data) != n:
        raise ValueError(f"archive ends within bytes {at} to {at + n}")
    return data


def central_directory(f, size: int) -> tuple[int, int, int]:
    """Offset, length and entry count of the central directory, from the end record or its ZIP64 form."""
    tail = _range(f, max(0, size - 22 - MAX16), min(size, 22 + MAX16))
    at = tail.rfind(END, 0, max(0, len(tail) - 18))  # an end record takes 22 bytes
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP archive")
    count, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if MAX16 == count or MAX32 in (length, offset):
        locator = _range(f, size - len(tail) + at - 20, 20)
        if locator[:4] != LOCATOR:
            raise ValueError("no ZIP64 locator")
        end = _range(f, struct.unpack_from("<Q", locator, 8)[0], 56)
        if end[:4] != END64:
            raise ValueError("no ZIP64 end record")
        count, length, offset = struct.unpack_from("<QQQ", end, 32)
    return offset, length, count


def members(f, size: int):
    """``(name, method, data offset, stored size, size)`` of every member."""
    offset, length, count = central_directory(f, size)
    table, at = _range(f, offset, length), 0
    for _ in range(count):
        if table[at : at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", table, at + 8)
        packed, full, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", table, at + 20)
        header = struct.unpack_from("<I", table, at + 42)[0]
        name = table[at + 46 : at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = table[at + 46 + n_name : at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            tag, n = struct.unpack_from("<HH", extra)
            if tag == 1:  # ZIP64: only the fields that overflowed, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                full = next(wide) if full == MAX32 else full
                packed = next(wide) if packed == MAX32 else packed
                header = next(wide) if header == MAX32 else header
            extra = extra[4 + n :]
        local = _range(f, header, 30)
        if local[:4] != LOCAL:
            raise ValueError("broken local header")
        start = header + 30 + sum(struct.unpack_from("<HH", local, 26))
        yield name, method, start, packed, full
        at += 46 + n_name + n_extra + n_comment


def record_ranges(f, size: int) -> list[tuple[int, int]]:
    """Absolute ``(offset, length)`` of every record, from the index member."""
    found = {name: rest for name, *rest in members(f, size)}
    method, start, packed, _ = found[DATA]
    if method:
        raise ValueError(f"{DATA} is compressed: its records can't be read in place")
    kind, at, n, _ = found[INDEX]
    text = _range(f, at, n)
    if kind == 8:
        text = zlib.decompress(text, -15)
    spots = [json.loads(x.partition(b" ")[2]) for x in text.split(b"\n") if x]
    if any(x["offset"] + x["length"] > packed for x in spots):
        raise ValueError("index points beyond its member")
    return [(start + x["offset"], x["length"]) for x in spots]


# ---- tables to archives and back -------------------------------------------------------------------


def _payload(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string").cast("binary"), F.lit(b"").cast("binary"))


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_revisit_bytes: int = 1000,
    archive_bytes: int = 256 << 20,
    level: int = 3,
) -> DataFrame:
    """Write a record per row; returns the manifest ``(path, records, bytes)``.

    Of rows with equal payloads of at least ``min_revisit_bytes``, the one with the largest id is the
    response and the others revisit it. Rows that repeat that id and payload are responses too; a
    null id is never the largest (if all are null, all are responses). A null payload is empty. Other
    columns are ignored; an empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "archives")
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), _payload(payload_col).alias("payload")
    )
    rows = rows.select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n"))
    # repeated payloads only; as a staged table its size is known, so the planner broadcasts it below the
    # session's threshold and shuffles (with skew splitting) above
    tops = staged(
        rows.where(F.col("n") >= min_revisit_bytes)
        .groupBy("digest", "n", F.xxhash64("payload").alias("check"))
        .agg(F.max("id").alias("top"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select(F.concat_ws(":", "digest", "n", "check").alias("same"), "top"),
        "repeated_payloads",
    )
    same = F.when(
        F.col("n") >= min_revisit_bytes, F.concat_ws(":", "digest", "n", F.xxhash64("payload"))
    ).otherwise(F.concat(F.lit("-"), F.col("id").cast("string")))
    rows = rows.withColumn("same", same).join(tops, "same", "left")
    rows = rows.select(
        F.col("id").cast("string").alias("id"),
        "url",
        "payload",
        "digest",
        F.col("top").cast("string").alias("top"),
        F.coalesce(F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top")), F.lit(False)).alias("revisit"),
    )

    def run(batches):
        store, base = open_store(folder)
        task = TaskContext.get()
        out = writer = None
        number = count = 0

        def done():
            writer.close()
            out.close()
            return pa.RecordBatch.from_pylist(
                [{"path": path, "records": count, "bytes": writer.at}], manifest_schema
            )

        for batch in batches:
            for r in batch.to_pylist():
                if writer is None:
                    store.create_dir(base, recursive=True)
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number}.zip"
                    path = f"{folder}/{name}"
                    out = store.open_output_stream(f"{base}/{name}")
                    writer, count = ArchiveWriter(out, level), 0
                record = build_record(r["id"], r["url"], r["payload"], r["digest"], r["top"], r["revisit"])
                writer.add(r["id"], record)
                count += 1
                if writer.at >= archive_bytes:
                    yield done()
                    writer, number = None, number + 1
        if writer is not None:
            yield done()

    manifest_schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
    return staged(rows.mapInArrow(run, "path string, records bigint, bytes bigint"), "manifest")


def read_archives(
    spark: SparkSession, manifest: DataFrame, payloads: bool = True, chunk_bytes: int = 16 << 20
) -> DataFrame:
    """One row per record of the archives in ``manifest(path)``, each read by its byte range:
    ``record_id, url, record_type, refers_to, payload_digest, payload_bytes`` and, if asked for,
    ``payload`` (null for revisits). Archives are cut into chunks of about ``chunk_bytes``, so a large one
    is read by many tasks."""

    def locate(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = open_store(path)
                with store.open_input_file(name) as f:
                    found = record_ranges(f, f.size())
                for i in range(0, len(found), 10_000):
                    part = found[i : i + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path] * len(part)),
                            pa.array([o for o, _ in part], pa.int64()),
                            pa.array([n for _, n in part], pa.int64()),
                        ],
                        ["path", "offset", "length"],
                    )

    def fetch(batches):
        f = opened = None
        for batch in batches:
            rows, held = [], 0
            for path, offset, n in zip(*(c.to_pylist() for c in batch.columns)):
                if path != opened:
                    store, name = open_store(path)
                    f, opened = store.open_input_file(name), path
                rows.append(parse_record(zlib.decompress(_range(f, offset, n), 31)))
                if not payloads:
                    del rows[-1]["payload"]
                held += n
                if held > 8 << 20 or len(rows) >= 5000:
                    yield pa.RecordBatch.from_pylist(rows, out_schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, out_schema)

    fields = [("record_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())]
    fields += [("payload_digest", pa.string()), ("payload_bytes", pa.int64())]
    ddl = "record_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes bigint"
    if payloads:
        fields, ddl = [*fields, ("payload", pa.binary())], ddl + ", payload binary"
    out_schema = pa.schema(fields)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spots = manifest.select("path").repartition(parts, "path").mapInArrow(locate, "path string, offset bigint, length bigint")
    chunk = F.floor(F.col("offset") / chunk_bytes)
    spots = spots.repartition(parts, F.col("path"), chunk).sortWithinPartitions("path", "offset")
    return spots.mapInArrow(fetch, ddl)
