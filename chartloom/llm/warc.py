"""WARC archives: duplicate payloads as revisits, and a data source to read them.

Files hold one gzip member per record.  Each member carries its compressed and
its plain length in the extra field ``sl``, so that a reader can step over a
record without inflating it; members without that field are inflated instead.
The reader inflates the first bytes of a record, parses its headers, applies
the pushed predicates to them, and inflates the payload only if the record
passes and payloads are wanted.

A write publishes one list of its files with the places at which each may be
split.  Files that a lost or repeated task left behind are not in the list.

A null payload is an empty one.  Of equal payloads of at least MIN_REVISIT
bytes, all rows with the smallest id are responses (a null id is not the
smallest unless there is no other), so repeated rows lose nothing.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)

from chartloom.llm.common import materialize, small_or_not

MIN_REVISIT = 100
SPLIT_BYTES = 16 << 20
FILES = "_files.json"
SCHEMA = (
    "record_id string, target_uri string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to string, payload binary"
)
#: column -> header, for the predicates that headers can answer
HEADERS = {
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "record_type": "WARC-Type",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
HEAD_BYTES = 4096


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _urn(value: str) -> str:
    return f"<urn:page:{value}>"


def _clean(value: str | None) -> str:
    """Header values hold no line ends."""
    return (value or "").replace("\r", "%0D").replace("\n", "%0A")


def encode_record(row: dict, date: str) -> bytes:
    """One record as a gzip member with its lengths in the extra field."""
    revisit = row["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    body = http if revisit else http + row["payload"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        *([f"WARC-Record-ID: {_urn(_clean(row['record_id']))}"] if row["record_id"] is not None else []),
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {_clean(row['target_uri'])}"] if row["target_uri"] is not None else []),
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        f"X-Payload-Bytes: {row['payload_bytes']}",
        *([f"WARC-Refers-To: {_urn(_clean(row['refers_to']))}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    plain = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    data = deflate.compress(plain) + deflate.flush()
    total = 10 + 2 + 12 + len(data) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(plain) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + data + struct.pack("<II", zlib.crc32(plain), len(plain) & 0xFFFFFFFF)


class WarcSource(DataSource):
    """Format ``warc``: options path, and payload (false leaves payloads null)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, schema.names)


class Written(WriterCommitMessage):
    def __init__(self, files: list[dict]):
        self.files = files


class WarcWriter(DataSourceWriter):
    def __init__(self, options, columns):
        self.path, self.columns = options["path"].rstrip("/"), columns
        self.date = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(self, rows) -> Written:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        name, size, splits, out = f"{uuid.uuid4().hex}.warc.gz", 0, [0], None
        for row in rows:
            out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
            record = row.asDict()
            record["payload"] = bytes(record["payload"] or b"")
            if size - splits[-1] >= SPLIT_BYTES:
                splits.append(size)
            size += out.write(encode_record(record, self.date))
        if out:
            out.close()
        return Written([{"name": name, "size": size, "splits": splits}] if out else [])

    def commit(self, messages) -> None:
        fs, root = _open(self.path)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{FILES}") as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())

    def abort(self, messages) -> None:
        fs, root = _open(self.path)
        for message in messages:
            for file in message.files if message else []:
                fs.delete_file(f"{root}/{file['name']}")


class Range(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.payload = options.get("payload", "true").lower() == "true"
        self.wanted: dict[str, set] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters):
        """Take the predicates that headers answer; Spark applies the others."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, values) & values
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.present.add(column)
            else:
                yield f

    def partitions(self) -> list[Range]:
        fs, root = _open(self.path)
        with fs.open_input_stream(f"{root}/{FILES}") as listing:
            files = json.loads(listing.read())
        return [
            Range(f["name"], start, end)
            for f in files
            for start, end in zip(f["splits"], [*f["splits"][1:], f["size"]])
        ] or [Range("", 0, 0)]

    def passes(self, record: dict) -> bool:
        return all(record[c] in v for c, v in self.wanted.items()) and all(record[c] is not None for c in self.present)

    def read(self, part: Range) -> Iterator[tuple]:
        if not part.file:
            return
        fs, root = _open(self.path)
        with fs.open_input_file(f"{root}/{part.file}") as file:
            at = part.start
            while at < part.end:
                record, at = self._record(file, at)
                if record:
                    yield tuple(record.values())

    def _record(self, file, at: int) -> tuple[dict | None, int]:
        """The record at a place, or None if not wanted; and the next place."""
        file.seek(at)
        first = file.read(HEAD_BYTES)
        if first[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at byte {at}")
        length = 0
        if first[3] == 4 and first[12:14] == b"sl":
            length = struct.unpack_from("<I", first, 16)[0]
        inflate = zlib.decompressobj(31)
        plain = inflate.decompress(first[:length] if length else first, 1 << 16)
        while b"\r\n\r\n" not in plain:
            more = inflate.unconsumed_tail or file.read(HEAD_BYTES)
            if not more:
                raise ValueError(f"record at byte {at} ends inside its headers")
            plain += inflate.decompress(more, 1 << 16)
        head, _, rest = plain.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        record = {
            "record_id": _bare(fields.get("WARC-Record-ID")),
            "target_uri": fields.get("WARC-Target-URI"),
            "record_type": fields["WARC-Type"],
            "payload_digest": fields.get("WARC-Payload-Digest", "").partition(":")[2] or None,
            "payload_bytes": int(fields["X-Payload-Bytes"]) if "X-Payload-Bytes" in fields else None,
            "refers_to": _bare(fields.get("WARC-Refers-To")),
            "payload": None,
        }
        ok = self.passes(record)
        want = ok and self.payload and record["record_type"] != "revisit"
        if want or not length:
            parts, tail = [rest], inflate.unconsumed_tail
            used = len(first)
            while not inflate.eof:
                chunk = tail or file.read(max(HEAD_BYTES, length - used) if length else 1 << 16)
                if not chunk:
                    raise ValueError(f"record at byte {at} is cut off")
                used += 0 if tail else len(chunk)
                parts.append(inflate.decompress(chunk))
                tail = b""
            length = length or used - len(inflate.unused_data)
            if want:
                body = b"".join(parts)[: int(fields["Content-Length"])]
                record["payload"] = body.partition(b"\r\n\r\n")[2]
                if hashlib.sha256(record["payload"]).hexdigest() != record["payload_digest"]:
                    raise ValueError(f"payload of {record['record_id']} does not match its digest")
        return (record if ok else None), at + length


def _bare(urn: str | None) -> str | None:
    return None if urn is None else urn.removeprefix("<urn:page:").removesuffix(">")


def plan_records(pages: DataFrame) -> DataFrame:
    """The records of (page_id, url, html): equal payloads become revisits."""
    rows = pages.select(
        "page_id", F.col("url").alias("target_uri"), F.coalesce("html", F.lit("")).alias("html")
    ).withColumns({"payload_digest": F.sha2("html", 256), "payload_bytes": F.octet_length("html").cast("long")})
    firsts = materialize(
        rows.filter(F.col("payload_bytes") >= MIN_REVISIT)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n"),
        "equal-payloads",
    )
    joined = rows.join(small_or_not(firsts), "payload_digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        F.col("page_id").cast("string").alias("record_id"),
        "target_uri",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "payload_digest",
        "payload_bytes",
        F.when(revisit, F.col("first_id").cast("string")).alias("refers_to"),
        F.when(~revisit, F.encode("html", "utf-8")).alias("payload"),
    )


def write_archive(pages: DataFrame, path: str) -> None:
    """Write one record per row of (page_id, url, html) under a new folder."""
    pages.sparkSession.dataSource.register(WarcSource)
    plan_records(pages).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records under a folder written by :func:`write_archive`."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)
