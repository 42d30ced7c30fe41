"""Web archives as seekable Zstandard bundles.

Pages become WARC records. Tasks group them into frames that decompress on
their own, write frames to bundles in the shared folder, and end each bundle
with a seek table, so a reader finds any frame from the footer alone. An index
maps each record's identifier to its bundle, frame and offset in that frame.

Of records with equal payloads the one with the smallest page_id carries the
payload; the others are revisits that name it. Payloads below ``LEAST_BYTES``
are always written out.

A task streams its pages: it holds one frame at a time. Its bundles have the
same names and bytes whenever it runs, and each is moved to its name when it
is whole, so a repeated task replaces what a lost one left.

Cases: a null html is an empty payload; a null or odd url is left out or
escaped; of rows repeated with one page_id and payload the first place
responds and the others revisit it; null page_ids rank last; an empty table
gives no bundles and no rows; a very long payload is a frame of its own and is
held whole by its task; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispatchboard.llm.shared import located, saved, scratch

LEAST_BYTES = 100
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
# Packed bytes that a task reads back.
READ_BYTES = 8 << 20
LEVEL = 3
DATE = "2020-01-01T00:00:00Z"
SUFFIX = ".warc.zst"
# Fixed values of the seekable format and of revisit records.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PRINTABLE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _file_system(path: str):
    from pyarrow import fs
    if path.startswith("file:/"):
        path = "file:///" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def record_id(page_id: int | None, place: int) -> str:
    return uuid.uuid5(uuid.NAMESPACE_OID, f"{page_id} {place}").urn


def record(page_id: int | None, place: int, url: str | None, payload: bytes, digest: str,
           first: tuple[int | None, int] | None) -> bytes:
    """One record; ``first`` is the response it revisits, None for a response."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if first else http + payload
    head = [("WARC-Type", "revisit" if first else "response"),
            ("WARC-Record-ID", f"<{record_id(page_id, place)}>"), ("WARC-Date", DATE)]
    if url:
        head.append(("WARC-Target-URI", quote(url, safe=_PRINTABLE)))
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if first:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_id(*first)}>")]
        if first[0] is not None:
            head.append(("Refers-To-Page-ID", str(first[0])))
    if page_id is not None:
        head.append(("Page-ID", str(page_id)))
    head += [("Payload-Bytes", str(len(payload))),
             ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    fields = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + fields.encode() + b"\r\n" + block + b"\r\n\r\n"


def records(frame: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, header fields and block of each record in a frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        version, *lines = frame[at:end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(fields["Content-Length"])
        if version != "WARC/1.1" or frame[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"no record at {at}")
        yield at, stop + 4 - at, fields, frame[start:stop]
        at = stop + 4


class _Bundles:
    """Writes records to numbered bundles of one task."""

    def __init__(self, folder: str, task: int):
        import zstandard
        self.fs, self.folder = _file_system(folder)
        self.task, self.number, self.out = task, 0, None
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.raw, self.size = [], 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        """Bundle name, frame number and offset in the frame."""
        if self.size and self.size + len(data) > FRAME_BYTES:
            self._frame()
        if self.out is None:
            self.name = f"pages-{self.task:05d}-{self.number:05d}{SUFFIX}"
            self.draft = f"{self.folder}/.{self.name}-{uuid.uuid4().hex}"
            self.out, self.table, self.written = self.fs.open_output_stream(self.draft), [], 0
        place = (self.name, len(self.table), self.size)
        self.raw.append(data)
        self.size += len(data)
        return place

    def _frame(self) -> None:
        packed = self.packer.compress(b"".join(self.raw))
        self.out.write(packed)
        self.table.append((len(packed), self.size))
        self.written += len(packed)
        self.raw, self.size = [], 0
        if self.written >= BUNDLE_BYTES:
            self.close()

    def close(self) -> None:
        if self.size:
            self._frame()
        if self.out is None:
            return
        entries = b"".join(struct.pack("<II", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        self.fs.move(self.draft, f"{self.folder}/{self.name}")
        self.out, self.number = None, self.number + 1


def seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(start, packed bytes, bytes) of each frame, read from the footer."""
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * n)
    entries, out, at = file.read(8 * n), [], 0
    for packed, raw in struct.iter_unpack("<II", entries):
        out.append((at, packed, raw))
        at += packed
    return out


def read_frame(file, start: int, packed: int, raw: int) -> bytes:
    import zstandard
    file.seek(start)
    data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=raw)
    if len(data) != raw:
        raise ValueError("a frame is not as long as the seek table says")
    return data


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) to bundles in ``folder`` (a
    URI every executor can write to); the index, a saved table:
    ``record_id, page_id, bundle, frame, offset, length``."""
    rows, at = located(pages)
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = rows.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"),
                       F.sha2(payload, 256).alias("digest"), F.xxhash64(at).alias("place"), F.col(at).alias("at"))
    size = F.octet_length("payload")
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "at", "place")
    keys = rows.where(size >= LEAST_BYTES).select("digest", rank.alias("rank"))
    # Only payloads that occur more than once need the join, and of those only
    # digests and places move; a page's payload is shuffled once, to its task.
    firsts = (keys.groupBy("digest").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1).drop("n"))
    # A place's hash deals the rows; the place itself tells whose entry it is.
    entry = F.struct(F.col("rank.at").alias("at"), F.col("first.page_id").cast("string").alias("first_id"),
                     F.col("first.place").alias("first_place"))
    again = saved(keys.join(firsts, "digest").where(F.col("rank.at") != F.col("first.at"))
                  .groupBy(F.col("rank.place").alias("place")).agg(F.collect_list(entry).alias("entries")),
                  "revisits")
    total = rows.agg(F.sum(size)).first()[0] or 0
    tasks = max(1, -(-total // BUNDLE_BYTES))
    own = F.get(F.filter("entries", lambda e: e["at"] == F.col("at")), 0)
    marked = (rows.repartition(tasks, "place").join(again, "place", "left").withColumn("own", own)
              .select(F.col("page_id").cast("string"), "place", "url", "payload", "digest",
                      F.col("own").isNotNull().alias("again"), F.col("own.first_id").alias("first_id"),
                      F.coalesce("own.first_place", F.lit(0)).alias("first_place"))
              .sortWithinPartitions("place", "page_id"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundles = _Bundles(folder, TaskContext.get().partitionId())
        for batch in batches:
            made = []
            for page_id, place, url, text, digest, again, first_id, first_place in zip(
                    *(batch[c] for c in batch.columns)):
                own = None if page_id is None else int(page_id)
                first = (None if first_id is None else int(first_id), first_place) if again else None
                data = record(own, place, url, text.encode(), digest, first)
                made.append((record_id(own, place), own, *bundles.add(data), len(data)))
            yield pd.DataFrame(made, columns=INDEX).astype({"page_id": "Int64"})
        bundles.close()

    return saved(marked.mapInPandas(write, "record_id string, page_id long, bundle string, frame int, "
                                           "offset long, length long"), "index")


INDEX = ["record_id", "page_id", "bundle", "frame", "offset", "length"]


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """Every record in the bundles of ``folder``: ``record_id, page_id,
    payload_bytes, payload_digest, record_type, refers_to, bundle, frame,
    offset, length``. Frames are found by the seek tables and dealt to tasks
    one by one; a payload that doesn't have its digest is an error."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}")
             .load(folder).select("path", "length"))

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, size in zip(batch["path"], batch["length"]):
                fs, inner = _file_system(path)
                with fs.open_input_file(inner) as file:
                    table = seek_table(file, size)
                yield pd.DataFrame([(path, k, *e) for k, e in enumerate(table)],
                                   columns=["path", "frame", "start", "packed", "raw"])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, frame, start, packed, raw in batch.itertuples(index=False):
                fs, inner = _file_system(path)
                with fs.open_input_file(inner) as file:
                    data = read_frame(file, start, packed, raw)
                out = []
                for offset, length, fields, block in records(data):
                    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].split(":")[1]
                    size = int(fields["Payload-Bytes"])
                    if kind == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        size = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{path}: frame {frame}, offset {offset}: wrong digest")
                    number = {k: int(fields[k]) if k in fields else None
                              for k in ("Page-ID", "Refers-To-Page-ID")}
                    out.append((fields["WARC-Record-ID"].strip("<>"), number["Page-ID"], size, digest, kind,
                                number["Refers-To-Page-ID"], inner.rsplit("/", 1)[-1], frame, offset, length))
                yield pd.DataFrame(out, columns=RECORDS).astype({"page_id": "Int64", "refers_to": "Int64"})

    found = files.mapInPandas(frames, "path string, frame int, start long, packed long, raw long")
    # A frame's row is short but stands for much: the number of tasks follows
    # the bytes of the bundles, not of these rows.
    packed = files.agg(F.sum("length")).first()[0] or 0
    return found.repartition(max(1, -(-packed // READ_BYTES)), "path", "frame").mapInPandas(
        parse, "record_id string, page_id long, payload_bytes long, payload_digest string, "
               "record_type string, refers_to long, bundle string, frame int, offset long, length long")


RECORDS = ["record_id", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
           "bundle", "frame", "offset", "length"]


def fetch(folder: str, bundle: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Fields and block of one record, reading only its frame."""
    fs, inner = _file_system(f"{folder}/{bundle}")
    with fs.open_input_file(inner) as file:
        data = read_frame(file, *seek_table(file, file.size())[frame])
    _, _, fields, block = next(records(data[offset:offset + length]))
    return fields, block


def archive_folder(spark: SparkSession) -> str:
    """A new folder on the shared storage, as a URI that tasks can open."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch(spark, "warc"))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    return fs.makeQualified(path).toString()


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` to bundles and read them back: a row per record."""
    spark = pages.sparkSession
    folder = folder or archive_folder(spark)
    write_bundles(pages, folder)
    return read_bundles(spark, folder)
