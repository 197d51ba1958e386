"""WARC archives as a Spark data source, written and read by tasks.

A record is one gzip member whose extra field ``sl`` (the skip length of the format's annex) holds
its compressed size, so that a reader can pass over a record without decompressing its payload.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

from salesloom.llm.common import new_path, small_batches, spread_out, table, written

FIELDS = (
    "record_id string, record_type string, target_uri string, warc_date string, payload_digest string, "
    "refers_to string, payload_length long, headers map<string,string>, payload binary"
)
# Header of each column that a filter can be pushed to.
HEADER_OF = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
LENGTH_HEADER = "X-Payload-Length"  # of the full payload, where a revisit leaves it out
MEMBER = struct.Struct("<4BI2BH2sHII")  # gzip header with the extra field sl: two lengths
FILE_BYTES = 256 << 20  # a task begins another file beyond this
BATCH_BYTES = 8 << 20  # read payloads are handed on in batches of about this
HEAD_BYTES = 1 << 14  # decompressed at first; more where a header is longer
LONGEST_HEAD = 1 << 24
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """Any store that Arrow knows; a bare path is a local or mounted folder."""
    if re.match(r"[a-z][a-z0-9+.-]*:", uri):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))
    return pafs.LocalFileSystem(), uri


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(headers: list[tuple[str, str]], payload: bytes) -> bytes:
    """One record as a gzip member that tells its own size."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(payload)}", "", ""]
    record = "\r\n".join(lines).encode() + payload + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = MEMBER.size + len(body) + 8
    head = MEMBER.pack(0x1F, 0x8B, 8, 4, 0, 0, 255, 12, b"sl", 8, size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Rows of record_id, record_type, target_uri, warc_date, payload_digest, refers_to, payload_length, payload.

    Each attempt writes files of its own; only those that the driver lists in a manifest at commit
    count, so a task that is lost or run twice leaves no record behind.
    """

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, folder = file_system(self.path)
        names, out, size = [], None, 0
        store.create_dir(folder, recursive=True)
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size > FILE_BYTES:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = store.open_output_stream(f"{folder}/{names[-1]}", compression=None), 0
                    data = self.record(row)
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    @staticmethod
    def record(row: dict) -> bytes:
        payload = row["payload"] or b""
        headers = [(HEADER_OF[c], re.sub(r"[\r\n]", " ", row[c])) for c in HEADER_OF if row.get(c) is not None]
        headers.append((LENGTH_HEADER, str(row["payload_length"])))
        if row["record_type"] == "revisit":
            return member([*headers, ("WARC-Profile", PROFILE)], b"")
        return member([*headers, ("Content-Type", "text/html; charset=utf-8")], payload)

    def commit(self, messages: list[Written | None]) -> None:
        store, folder = file_system(self.path)
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, folder = file_system(self.path)
        for message in messages:
            for name in message.names if message else ():
                store.delete_file(f"{folder}/{name}")


@dataclass
class Archives(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    """``payload`` option: ``keep`` hands payloads on, ``verify`` only compares their digest, ``skip`` never decodes them."""

    def __init__(self, path: str, payload: str, split_bytes: int):
        self.path, self.payload, self.split_bytes = path, payload, split_bytes
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column not in HEADER_OF:
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[column] = self.wanted.get(column, values) & values

    def partitions(self) -> list[Archives]:
        """Committed files, or all ``*.warc`` and ``*.warc.gz`` where there is no manifest, in runs of about split_bytes."""
        store, folder = file_system(self.path)
        info = store.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True))
        lists = [i.path for i in info if i.base_name.startswith("_manifest-")]
        files = {i.path: i.size for i in info if i.is_file and re.search(r"\.warc(\.gz)?$", i.base_name)}
        if lists:
            listed = {n for p in lists for n in json.loads(store.open_input_stream(p).read())}
            files = {p: s for p, s in files.items() if p.rpartition("/")[2] in listed}
        runs, size = [], self.split_bytes
        for path, own in sorted(files.items()):
            if size + own > self.split_bytes:
                runs.append(Archives([]))
                size = 0
            runs[-1].paths.append(path)
            size += own
        return runs or [Archives([])]

    def read(self, partition: Archives) -> Iterator[pa.RecordBatch]:
        store, _ = file_system(self.path)
        schema = arrow_schema()
        rows, size = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as raw:
                data = io.BufferedReader(raw, 1 << 20)
                records = gzip_records if path.endswith(".gz") else plain_records
                for head, payload in records(data):
                    row = parsed(head)
                    if row is None or any(row[c] not in v for c, v in self.wanted.items()):
                        continue
                    row["payload"] = self.body(row, payload)
                    rows.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    def body(self, row: dict, payload) -> bytes | None:
        if self.payload == "skip" or row["record_type"] == "revisit":
            return None
        data = payload()
        digest = row["payload_digest"]
        if digest and digest.startswith("sha1:") and digest[5:] != base32_sha1(data):
            raise ValueError(f"payload of {row['record_id']} does not match its digest {digest}")
        return data if self.payload == "keep" else None


def parsed(head: bytes) -> dict | None:
    """The header block as a row without payload; None for what is no WARC record."""
    first, _, rest = head.partition(b"\r\n")
    if not first.startswith(b"WARC/"):
        return None
    headers = dict(line.partition(":")[::2] for line in rest.decode("utf-8", "replace").split("\r\n") if ":" in line)
    headers = {k.strip(): v.strip() for k, v in headers.items()}
    by_name = {k.lower(): v for k, v in headers.items()}
    row = {c: by_name.get(h.lower()) for c, h in HEADER_OF.items()}
    length = by_name.get(LENGTH_HEADER.lower(), by_name.get("content-length"))
    return {**row, "payload_length": int(length) if length else None, "headers": list(headers.items()), "content_length": int(by_name.get("content-length", 0))}


def plain_records(data: io.BufferedReader) -> Iterator[tuple[bytes, object]]:
    """Header block and a function for the payload; a payload that is not asked for is passed over by a seek."""
    while True:
        head = b""
        while not head.endswith(b"\r\n\r\n"):
            line = data.readline(LONGEST_HEAD)
            if not line:
                return
            head = head + line if head or line.strip() else b""
        start = data.tell()
        row = parsed(head[:-4])
        length = row["content_length"] if row else 0

        def payload():
            data.seek(start)
            return data.read(length)

        yield head[:-4], payload
        data.seek(start + length)


def gzip_records(data: io.BufferedReader) -> Iterator[tuple[bytes, object]]:
    """As ``plain_records`` for one gzip member a record: only the header block is decompressed unasked."""
    while True:
        at = data.tell()
        begin = data.read(MEMBER.size)
        if len(begin) < 18:
            return
        size = None
        if len(begin) == MEMBER.size:
            parts = MEMBER.unpack(begin)
            if parts[:4] == (0x1F, 0x8B, 8, 4) and parts[8] == b"sl":
                size = parts[10]
        data.seek(at)
        packed = data.read(size) if size else None
        unpack = zlib.decompressobj(31)
        if packed is not None:
            text, rest = unpack.decompress(packed, HEAD_BYTES), unpack.unconsumed_tail
            while b"\r\n\r\n" not in text and rest:
                text, rest = text + unpack.decompress(rest, HEAD_BYTES), unpack.unconsumed_tail
        else:  # an archive of another writer: its end is found by decompressing
            pieces = []
            while not unpack.eof and (chunk := data.read(1 << 16)):
                pieces.append(unpack.decompress(chunk))
            text, rest = b"".join(pieces), b""
            data.seek(-len(unpack.unused_data), 1)
        head, _, body = text.partition(b"\r\n\r\n")

        def payload():
            whole = body + (unpack.decompress(rest) + unpack.flush() if rest else b"")
            return whole[: (parsed(head) or {"content_length": 0})["content_length"]]

        yield head, payload


def arrow_schema() -> pa.Schema:
    text = [pa.field(n, pa.string()) for n in HEADER_OF]
    more = [("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
    return pa.schema([*text, *(pa.field(n, t) for n, t in more)])


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").mode("append").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return FIELDS

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "keep"), int(self.options.get("split_bytes", 64 << 20)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def to_records(pages: DataFrame, crawl_date: str, min_bytes: int = 0) -> DataFrame:
    """Pages (page_id, url, html) as records: of equal payloads the largest id keeps it, the others revisit.

    Null html is an empty payload, a null url has no target header, a null id is written as
    ``none`` and revisits like any other unless all ids are null. Rows that share the largest id
    all keep their payload. Payloads under ``min_bytes`` are always kept. Other columns are not used.
    """
    spread_out(pages.sparkSession)
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload"))
    own = own.withColumns({"sha1": F.sha1("payload"), "bytes": F.octet_length("payload").cast("long")})
    # Counted per task first and written: a hot payload then meets plain shuffles, which Spark can split.
    kept = (
        own.filter(F.col("bytes") >= min_bytes)
        .groupBy("sha1", "bytes")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    marked = own.join(written(kept, "warc-payloads"), ["sha1", "bytes"], "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    return marked.select(
        urn("page_id").alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(crawl_date).alias("warc_date"),
        F.concat(F.lit("sha1:"), base32(F.col("sha1"))).alias("payload_digest"),
        F.when(again, urn("first")).alias("refers_to"),
        F.col("bytes").alias("payload_length"),
        F.when(~again, F.col("payload")).alias("payload"),
    )


def base32(hex_digest):
    """Base 32 of a hexadecimal SHA-1: five hexadecimal digits, 20 bits, are four characters."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for at in range(1, 41, 5):
        value = F.conv(F.substring(hex_digest, at, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            parts.append(F.substring(alphabet, F.shiftright(value, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*parts)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    small_batches(spark)
    folder = new_path(spark, "archives")
    to_records(table(spark, sf_dir, "pages"), "1970-01-01T00:00:00Z").write.format("warc").mode("append").save(folder)
    records = spark.read.format("warc").option("payload", "verify").load(folder)
    page = lambda c: F.regexp_extract(F.col(c), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return records.filter(F.col("record_type").isin("response", "revisit")).select(
        page("record_id").alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )


# Equal payloads are grouped as texts. A digest's 160 bits are 32 characters of 5 bits, each read from a piece of 20.
OP10_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), marked AS (
    SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS digest,
           max(page_id) OVER (PARTITION BY payload) AS latest
    FROM p
)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(digest, 5 * (c // 4) + 1, 5))::BIGINT >> (15 - 5 * (c % 4))) & 31) + 1, 1)
           FOR c IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < latest THEN latest END AS refers_to
FROM marked
"""
