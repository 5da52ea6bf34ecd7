"""WARC archives as a Spark data source, written in Python and read header first."""

from __future__ import annotations

import base64
import datetime
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from packwatch.llm.common import settle, table, work_folder

#: Named fields of a record that have a column; all but the payload come from its header.
HEADER_OF = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "payload_length": "X-Payload-Length",
}
SCHEMA = ", ".join(f"{c} {'long' if c == 'payload_length' else 'string'}" for c in HEADER_OF) + ", payload binary"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest"
FILE_BYTES = 64 << 20
BATCH_BYTES = 4 << 20
BATCH_ROWS = 500


def digest_field(hexadecimal: str) -> str:
    """A digest as archives write it; columns hold it in bare hexadecimal."""
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def digest_column(field: str | None) -> str | None:
    if field is None or not field.startswith("sha1:"):
        return field
    try:
        return base64.b32decode(field[5:]).hex()
    except ValueError:
        return field[5:].lower()


def _line(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def member(record: bytes) -> bytes:
    """A gzip member whose header tells its length, so that readers can step over it."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    # fixed gzip layout: flags 4 (extra field), subfield "sl" with both lengths
    length = 10 + 2 + 4 + 8 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, length & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def warc_record(fields: dict, payload: bytes | None) -> bytes:
    """A record as bytes; a payload stands behind an HTTP header, a revisit has that header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload or b"")
    if fields.get("payload_digest"):
        fields = fields | {"payload_digest": digest_field(fields["payload_digest"])}
    lines = [f"{name}: {_line(str(fields[c]))}" for c, name in HEADER_OF.items() if fields.get(c) is not None]
    if fields.get("record_type") == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    head = ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass")
    return head + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict:
    found = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


class _Commit(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files under names of its own; the commit lists those that count.

    A task that runs twice, or is lost halfway, leaves files that no manifest names, and
    readers open only what a manifest names.
    """

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        names, out = [], None
        now = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or out.tell() > FILE_BYTES:
                    if out is not None:
                        out.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
                row["date"] = row.get("date") or now
                out.write(member(warc_record(row, row.get("payload"))))
        if out is not None:
            out.close()
        return _Commit(names)

    def commit(self, messages) -> None:
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(root)):
                if old.base_name.startswith(MANIFEST):
                    store.delete_file(old.path)
        with store.open_output_stream(f"{root}/{MANIFEST}-{uuid.uuid4().hex}", compression=None) as out:
            out.write("\n".join(n for m in messages if m for n in m.names).encode())

    def abort(self, messages) -> None:
        store, root = _open(self.path)
        for m in messages:
            for name in m.names if m else ():
                store.delete_file(f"{root}/{name}")


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(0)
        self.paths = paths


def _holds(test, row: dict) -> bool:
    """Whether a pushed predicate holds for the header columns of a record."""
    if isinstance(test, Not):
        inner = test.child
        if not isinstance(inner, (IsNull, IsNotNull, EqualNullSafe)) and row[inner.attribute[0]] is None:
            return False
        return not _holds(inner, row)
    have = row[test.attribute[0]]
    if isinstance(test, IsNull):
        return have is None
    if isinstance(test, IsNotNull):
        return have is not None
    if isinstance(test, EqualNullSafe):
        return have == test.value
    if have is None:
        return False
    if isinstance(test, In):
        return have in test.value
    if test.value is None:
        return False
    return {
        EqualTo: lambda a, b: a == b,
        GreaterThan: lambda a, b: a > b,
        GreaterThanOrEqual: lambda a, b: a >= b,
        LessThan: lambda a, b: a < b,
        LessThanOrEqual: lambda a, b: a <= b,
        StringStartsWith: lambda a, b: a.startswith(b),
        StringEndsWith: lambda a, b: a.endswith(b),
        StringContains: lambda a, b: b in a,
    }[type(test)](have, test.value)


_SUPPORTED = (
    EqualTo, EqualNullSafe, In, IsNull, IsNotNull, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual,
    StringStartsWith, StringEndsWith, StringContains,
)


class WarcReader(DataSourceReader):
    """Headers are parsed and tested first; a payload is unpacked only for records that pass."""

    def __init__(self, path: str, payload: bool, partition_bytes: int):
        self.path, self.payload, self.partition_bytes = path, payload, partition_bytes
        self.tests: list = []

    def pushFilters(self, filters):
        for test in filters:
            inner = test.child if isinstance(test, Not) else test
            if isinstance(inner, _SUPPORTED) and len(inner.attribute) == 1 and inner.attribute[0] in HEADER_OF:
                self.tests.append(test)
            else:
                yield test

    def partitions(self):
        store, root = _open(self.path)
        listed = [f for f in store.get_file_info(fs.FileSelector(root)) if f.is_file]
        manifests = [f for f in listed if f.base_name.startswith(MANIFEST)]
        files = [f for f in listed if f.base_name.endswith((".warc.gz", ".warc"))]
        if manifests:
            named = set()
            for m in manifests:
                with store.open_input_stream(m.path, compression=None) as f:
                    named.update(f.read().decode().split("\n"))
            files = [f for f in files if f.base_name in named]
        groups, full = [], self.partition_bytes + 1
        for f in sorted(files, key=lambda f: f.base_name):
            if full + f.size > self.partition_bytes:
                groups.append([])
                full = 0
            groups[-1].append(f.base_name)
            full += f.size
        return [_Files(g) for g in groups] or [_Files([])]

    def read(self, partition):
        store, root = _open(self.path)
        schema = pa.schema([(c, pa.int64() if c == "payload_length" else pa.string()) for c in HEADER_OF] + [("payload", pa.binary())])
        rows, held = [], 0
        for name in partition.paths:
            with store.open_input_file(f"{root}/{name}") as f:
                for row in self._records(f, name.endswith(".gz")):
                    rows.append(row)
                    held += len(row["payload"] or b"")
                    if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def _row(self, head: dict) -> dict | None:
        row = {c: head.get(name.lower()) for c, name in HEADER_OF.items()}
        row["payload_digest"] = digest_column(row["payload_digest"])
        length = row["payload_length"]
        row["payload_length"] = int(length) if length and length.isdecimal() else None
        return row if all(_holds(t, row) for t in self.tests) else None

    def _records(self, f, gzipped: bool):
        at, end = 0, f.size()
        while at < end:
            if not gzipped:
                step = yield from self._plain(f, at)
                at += step
                continue
            start = f.read_at(min(24, end - at), at)
            told = start[3:4] == b"\x04" and start[12:14] == b"sl"
            if told:
                (length,) = struct.unpack_from("<I", start, 16)
                inflate = zlib.decompressobj(31)
                packed = f.read_at(length, at)
                text = inflate.decompress(packed, 2048)
            else:
                length, inflate, packed = 0, zlib.decompressobj(31), f.read_at(1 << 16, at)
                length, text = len(packed), inflate.decompress(packed, 2048)
            while b"\r\n\r\n" not in text and inflate.unconsumed_tail:
                text += inflate.decompress(inflate.unconsumed_tail, 2048)
            head, _, rest = text.partition(b"\r\n\r\n")
            fields = parse_head(head)
            row = self._row(fields)
            if told and (row is None or not self.payload):
                block = b""
            else:
                block = rest + inflate.decompress(inflate.unconsumed_tail)
                while not told and not inflate.eof:
                    more = f.read_at(1 << 16, at + length)
                    if not more:
                        break
                    length += len(more)
                    block += inflate.decompress(more)
            if not told:
                length -= len(inflate.unused_data)
            at += length
            if row is not None:
                yield self._with_payload(row, fields, block)

    def _plain(self, f, at: int):
        text = f.read_at(1 << 13, at)
        while b"\r\n\r\n" not in text:
            more = f.read_at(1 << 13, at + len(text))
            if not more:
                return max(len(text), 1)
            text += more
        head = text.partition(b"\r\n\r\n")[0]
        fields = parse_head(head)
        size = int(fields.get("content-length") or 0)
        row = self._row(fields)
        if row is not None:
            block = f.read_at(size, at + len(head) + 4) if self.payload else b""
            yield self._with_payload(row, fields, block)
        return len(head) + 4 + size + 4

    def _with_payload(self, row: dict, fields: dict, block: bytes) -> dict:
        block = block[: int(fields.get("content-length") or 0)]
        if fields.get("content-type", "").startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        row["payload"] = block if self.payload and row["record_type"] != "revisit" else None
        return row


class WarcDataSource(DataSource):
    """``format("warc")``: option ``payload=false`` leaves payloads packed and null."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        o = self.options
        return WarcReader(o["path"], o.get("payload", "true") == "true", int(o.get("partitionBytes", 32 << 20)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def write_archive(pages: DataFrame, path: str, least_bytes: int = 1000) -> None:
    """Write a record per page (page_id, url, html) with revisits for repeated payloads.

    Of equal payloads (same SHA-1) of at least ``least_bytes`` bytes the row with the largest
    page_id is the response and the others refer to it. Rows that repeat with that same id are
    responses too; a null id is never the largest, and a group of null ids has responses only.
    Null html is an empty payload, a null url has no target field; other columns of the
    input play no part. An empty table writes an archive without records.

    Only digests move to find the repeats, combined on the map side; the list of repeated
    digests is stored, so its measured size decides how the pages meet it.
    """
    register(pages.sparkSession)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.select("page_id", "url", payload.alias("payload"))
    pages = pages.withColumn("sha1", F.sha1("payload")).withColumn("payload_length", F.octet_length("payload").cast("long"))
    repeated = settle(
        pages.where(F.col("payload_length") >= least_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select("sha1", "first_id"),
        "warc-repeated",
    )
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    (
        pages.join(repeated, "sha1", "left")
        .select(
            F.when(again, "revisit").otherwise("response").alias("record_type"),
            urn(F.col("page_id")).alias("record_id"),
            F.col("url").alias("target_uri"),
            F.lit(None).cast("string").alias("date"),
            F.col("sha1").alias("payload_digest"),
            F.when(again, urn(F.col("first_id"))).alias("refers_to"),
            "payload_length",
            F.when(~again, F.col("payload")).alias("payload"),
        )
        .write.format("warc")
        .mode("append")
        .option("path", path)
        .save()
    )


def archived_pages(spark, folder: str) -> DataFrame:
    """op3: every page as its archive tells it; digests of responses are taken from the payload read."""
    path = work_folder(spark, "warc")
    write_archive(table(spark, folder, "pages"), path)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    archive = spark.read.format("warc").option("path", path)
    responses = archive.load().where("record_type = 'response'")
    revisits = archive.option("payload", "false").load().where("record_type = 'revisit'")
    columns = lambda size, digest: [
        page("record_id").alias("page_id"),
        size.cast("long").alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("record_type"),
        page("refers_to").alias("refers_to"),
    ]
    return responses.select(*columns(F.octet_length("payload"), F.sha1("payload"))).unionByName(
        revisits.select(*columns(F.col("payload_length"), F.col("payload_digest")))
    )
