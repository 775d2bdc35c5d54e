"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each a group of whole WARC
records, and ends with the seek table of the public seekable format: a skippable
frame with the compressed and plain size of every frame.  Any Zstandard tool reads a
bundle from end to end; with the table a reader goes to one frame.  Beside the bundles
lies an index that maps the identifier of each record to its bundle, frame and offset
inside the frame.

Bundles are written and read through a data source, `warc_bundles`.  Each writing task
makes files of its own under fresh names, and the commit on the driver names the files
that count in a manifest, so retried and lost tasks leave nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import posixpath
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from millrace.llm.common import smaller_batches
from millrace.sources.storage import materialize

FRAME_BYTES = 256 << 10  # plain bytes after which a frame is closed
BUNDLE_BYTES = 64 << 20  # compressed bytes after which a bundle is closed
REVISIT_BYTES = 0  # least payload that may be revisited
DATE = "1970-01-01T00:00:00Z"  # of records whose rows carry none; fixed, so that reruns agree

# the seekable format
TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5E, 0x8F92EAB1
ENTRY, FOOTER = struct.Struct("<II"), struct.Struct("<IBI")

NAME = "warc_bundles"
RECORD = "page_id long, url string, payload binary, record_type string, record_id string, refers_id string, refers_to long"
READ = "record_id string, record_type string, page_id long, url string, payload binary, digest string, refers_id string, refers_to long"
INDEX = pa.schema(
    [("record_id", pa.string()), ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]
)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# records


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def spell_record(row: dict, date: str = DATE) -> bytes:
    """A WARC/1.1 record; what its row holds beside the payload is JSON in one header field."""
    payload = row["payload"] or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if row["record_type"] == "response" else http
    # control characters and what is not ASCII would end or garble a header line
    target = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in row["url"] or "")
    meta = {"page_id": row["page_id"], "url": row["url"]}
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", target or "about:blank"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["record_type"] == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{row['refers_id']}>")]
        meta["refers_to"] = row["refers_to"]
    fields += [("WARC-JSON-Metadata", json.dumps(meta)), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode("ascii") + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record at an offset of a plain frame, and where the next one begins."""
    body = data.index(b"\r\n\r\n", at) + 4
    lines = data[at : body - 4].decode("ascii").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at offset {at}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    end = body + int(fields["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError(f"the record at offset {at} is cut short")
    response = fields["WARC-Type"] == "response"
    payload = data[data.index(b"\r\n\r\n", body) + 4 : end]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if response and payload_digest(payload) != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not match its digest")
    meta = json.loads(fields["WARC-JSON-Metadata"])
    row = {
        "record_id": fields["WARC-Record-ID"].strip("<>"),
        "record_type": fields["WARC-Type"],
        "page_id": meta["page_id"],
        "url": meta["url"],
        "payload": payload if response else None,
        "digest": digest,
        "refers_id": None if response else fields["WARC-Refers-To"].strip("<>"),
        "refers_to": meta.get("refers_to"),
    }
    return row, end + 4


# bundles


class BundleWriter:
    """Groups records into frames and ends the file with their seek table."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES):
        self.sink, self.frame_bytes = sink, frame_bytes
        self.compressor = zstandard.ZstdCompressor(write_content_size=True, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.waiting: list[bytes] = []
        self.plain = self.size = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame and offset where the record will stand."""
        if self.plain and self.plain + len(record) > self.frame_bytes:
            self.close_frame()
        place = len(self.frames), self.plain
        self.waiting.append(record)
        self.plain += len(record)
        return place

    def close_frame(self) -> None:
        if self.waiting:
            frame = self.compressor.compress(b"".join(self.waiting))
            self.sink.write(frame)
            self.frames.append((len(frame), self.plain))
            self.size += len(frame)
            self.waiting, self.plain = [], 0

    def close(self) -> None:
        self.close_frame()
        entries = b"".join(ENTRY.pack(*frame) for frame in self.frames)
        footer = FOOTER.pack(len(self.frames), 0, FOOTER_MAGIC)
        self.sink.write(ENTRY.pack(TABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.sink.close()


class BundleReader:
    """Frames of a bundle by their number; reads the seek table first and then only what is asked for."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, flags, magic = FOOTER.unpack(source.read_at(FOOTER.size, size - FOOTER.size))
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table")
        width = ENTRY.size + (4 if flags & 0x80 else 0)  # others may add checksums
        table = source.read_at(count * width, size - FOOTER.size - count * width)
        self.frames, at = [], 0
        for k in range(count):
            compressed, plain = ENTRY.unpack_from(table, k * width)
            self.frames.append((at, compressed, plain))
            at += compressed

    def frame(self, number: int) -> bytes:
        at, compressed, plain = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self.source.read_at(compressed, at), max_output_size=plain)

    def records(self) -> Iterator[dict]:
        for number in range(len(self.frames)):
            data, at = self.frame(number), 0
            while at < len(data):
                row, at = parse_record(data, at)
                yield row


# the data source


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or a plain path; object stores go by their usual scheme."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


@dataclass
class Written(WriterCommitMessage):
    bundles: list[str]
    index: str | None


class BundleSink(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.root = options["path"].rstrip("/")
        self.frame_bytes = int(options.get("framebytes", FRAME_BYTES))
        self.bundle_bytes = int(options.get("bundlebytes", BUNDLE_BYTES))
        self.date = options.get("date", DATE)
        self.overwrite = overwrite
        self.session = uuid.uuid4().hex  # names the write, so a second one adds to the first

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, root = _store(self.root)
        files.create_dir(posixpath.join(root, "data"), recursive=True)
        files.create_dir(posixpath.join(root, "index"), recursive=True)
        bundles: list[str] = []
        bundle = index = None
        index_name = f"{uuid.uuid4().hex}.parquet"
        for batch in batches:
            places: list[list] = [[] for _ in INDEX.names]
            for row in batch.to_pylist():
                if bundle is None:
                    bundles.append(f"{uuid.uuid4().hex}.warc.zst")
                    sink = files.open_output_stream(posixpath.join(root, "data", bundles[-1]), compression=None)
                    bundle = BundleWriter(sink, self.frame_bytes)
                record = spell_record(row, self.date)
                frame, offset = bundle.add(record)
                for column, value in zip(places, (row["record_id"], row["page_id"], bundles[-1], frame, offset, len(record))):
                    column.append(value)
                if bundle.size >= self.bundle_bytes:
                    bundle.close()
                    bundle = None
            if batch.num_rows:
                index = index or pq.ParquetWriter(posixpath.join(root, "index", index_name), INDEX, filesystem=files)
                index.write_table(pa.table([pa.array(c, f.type) for c, f in zip(places, INDEX)], schema=INDEX))
        if bundle is not None:
            bundle.close()
        if index is not None:
            index.close()
        return Written(bundles, index_name if index else None)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _store(self.root)
        folder = posixpath.join(root, "manifest")
        files.create_dir(folder, recursive=True)
        old = [f.path for f in files.get_file_info(pafs.FileSelector(folder))] if self.overwrite else []
        done = [m for m in messages if m is not None]
        body = {"bundles": sorted(b for m in done for b in m.bundles), "index": sorted(m.index for m in done if m.index)}
        with files.open_output_stream(posixpath.join(folder, f"{self.session}.json")) as sink:
            sink.write(json.dumps(body).encode())
        for path in old:
            files.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _store(self.root)
        for message in messages:
            for name in message.bundles if message else []:
                files.delete_file(posixpath.join(root, "data", name))


def manifest(path: str) -> dict[str, list[str]]:
    """Names of the bundles and index files that were committed."""
    files, root = _store(path.rstrip("/"))
    found: dict[str, list[str]] = {"bundles": [], "index": []}
    for entry in files.get_file_info(pafs.FileSelector(posixpath.join(root, "manifest"), allow_not_found=True)):
        with files.open_input_stream(entry.path) as source:
            body = json.loads(source.readall())
        for key in found:
            found[key] += body[key]
    return found


@dataclass
class OneBundle(InputPartition):
    name: str


class BundleSource(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.root = options["path"].rstrip("/")
        self.names = schema.fieldNames()

    def partitions(self) -> list[OneBundle]:
        return [OneBundle(name) for name in manifest(self.root)["bundles"]]

    def read(self, partition: OneBundle) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, OneBundle):  # an archive without bundles has one empty partition
            return
        files, root = _store(self.root)
        rows, size = [], 0
        with files.open_input_file(posixpath.join(root, "data", partition.name)) as source:
            for row in BundleReader(source).records():
                rows.append(row)
                size += len(row["payload"] or b"")
                if size >= 4 << 20 or len(rows) >= 1000:
                    yield _read_batch(rows)
                    rows, size = [], 0
        if rows:
            yield _read_batch(rows)


def _read_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    names = [part.split()[0] for part in READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names)


class WarcBundles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> DataSourceReader:
        return BundleSource(self.options, schema)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return BundleSink(self.options, overwrite)


# the operator


def records_of(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", revisit_bytes: int = REVISIT_BYTES
) -> DataFrame:
    """One record per row: payloads seen before refer to the record with the smallest id.

    Payloads are equal if their SHA-256 and length are.  Rows that repeat the smallest id of
    their payload are the same record and all responses.  A missing id comes after all
    others; where all rows of a payload lack one, all are responses.  A null payload is empty.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    # the least row of the least id; its identifier is that of the record the others refer to
    first = F.struct(F.col("page_id").isNull().alias("unnumbered"), "page_id", "url").alias("row")
    firsts = rows.groupBy("key").agg(F.min(first).alias("first")).select("key", "first.page_id", "first.url")
    firsts = firsts.select("key", F.col("page_id").alias("refers_to"), _record_id("page_id", "url", "key").alias("refers_id"))
    # rows of one payload may be many: adaptive execution splits their side, the other has one row a payload
    joined = rows.join(firsts, "key")
    again = ~F.col("page_id").eqNullSafe(F.col("refers_to")) & (F.length("payload") >= revisit_bytes)
    only = lambda name: F.when(again, F.col(name)).alias(name)
    return joined.select(
        "page_id",
        "url",
        "payload",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        _record_id("page_id", "url", "key").alias("record_id"),
        only("refers_id"),
        only("refers_to"),
    )


def _record_id(id_col: str, url_col: str, key_col: str):
    """An identifier made from the record's id, address and payload, so that reruns agree."""
    quoted = F.coalesce(F.concat(F.lit("u"), F.col(url_col)), F.lit("-"))
    named = F.concat_ws("\n", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.col(key_col), quoted)
    return F.concat(F.lit("urn:sha256:"), F.sha2(named, 256))


def write_bundles(records: DataFrame, path: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> None:
    """Append records to the archive at `path`, a folder all executors share; one task writes one or more bundles."""
    spark = records.sparkSession
    smaller_batches(spark)
    spark.dataSource.register(WarcBundles)
    writer = records.select(*[part.split()[0] for part in RECORD.split(", ")]).write.format(NAME).mode("append")
    writer.option("framebytes", str(frame_bytes)).option("bundlebytes", str(bundle_bytes)).save(path)


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """All committed records, one partition a bundle; payloads are checked against their digests. Revisits have none."""
    spark.dataSource.register(WarcBundles)
    return spark.read.format(NAME).load(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Where each record stands: record_id, page_id, bundle, frame, offset inside the frame, length."""
    names = manifest(path)["index"]
    if not names:
        return spark.createDataFrame([], "record_id string, page_id long, bundle string, frame int, offset long, length long")
    return spark.read.parquet(*[f"{path.rstrip('/')}/index/{name}" for name in names])


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records whose record_id is in `wanted`; of each bundle only the frames that hold one are read."""
    smaller_batches(spark)
    places = read_index(spark, path).join(wanted.select("record_id").distinct(), "record_id").select("bundle", "frame", "offset")
    # records of a frame side by side in one task, so that it is read once
    ordered = places.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _store(path.rstrip("/"))
        name = number = source = reader = None
        data = b""
        for batch in batches:
            for place in batch.to_pylist():
                if place["bundle"] != name:
                    if source is not None:
                        source.close()
                    name, number = place["bundle"], None
                    source = files.open_input_file(posixpath.join(root, "data", name))
                    reader = BundleReader(source)
                if place["frame"] != number:
                    number = place["frame"]
                    data = reader.frame(number)
                yield _read_batch([parse_record(data, place["offset"])[0]])
        if source is not None:
            source.close()

    return ordered.mapInArrow(run, READ)


def resolve(records: DataFrame) -> DataFrame:
    """Payload size and digest of every record as read, those of revisits from the response they refer to.

    A revisit without its response, or with another digest, raises an error.
    """
    size = F.length("payload").cast("long").alias("size")
    key = F.coalesce("refers_id", "record_id").alias("key")
    own = materialize(records.select("record_id", "record_type", "page_id", "digest", "refers_to", size, key), "records")
    # rows that repeat a page give equal responses
    responses = own.where("record_type = 'response'").groupBy("key").agg(F.max("digest").alias("full_digest"), F.max("size").alias("full_size"))
    joined = own.join(responses, "key", "left")
    checked = F.when(F.col("digest") == F.col("full_digest"), F.col("full_digest")).otherwise(
        F.raise_error(F.concat(F.lit("no matching response for "), F.col("record_id"))).cast("string")
    )
    return joined.select(
        "page_id",
        F.col("full_size").alias("payload_bytes"),
        checked.alias("payload_digest"),
        "record_type",
        "refers_to",
        "record_id",
    )


def archive(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, **columns: str) -> DataFrame:
    """Write a record per page to bundles at `path` and read them back: page_id, payload_bytes,
    payload_digest, record_type (response or revisit), refers_to, record_id.

    Null and empty payloads are records of 0 bytes; ids and addresses may be null and
    come back so; very long payloads make frames of their own; an empty table makes an
    archive without bundles; other columns are not archived.
    """
    write_bundles(records_of(pages, revisit_bytes=revisit_bytes, **columns), path)
    return resolve(read_bundles(pages.sparkSession, path))
