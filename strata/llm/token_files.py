"""Token files: independent zstandard frames, a trailing seek table, a checksum per frame.

A file is a run of frames, each of whole documents, followed by the seek table of the public seekable
zstandard format (a skippable frame with the compressed size, size and XXH64 checksum of each frame). Readers take the table from
the end of the file, fetch only the frames of the documents they want, and verify each.

Every attempt of a task writes a file of its own name; the index, a Parquet table that Spark commits, names the files
that count. So lost or repeated tasks leave at most files that nobody reads. Tasks reach the files by ``pyarrow.fs``
(local or mounted folders, hdfs, s3, gs).
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.tokens import SLICE_BYTES, encoder, slices

#: The seekable format's numbers. Fixed values.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
FRAME_BYTES = 1 << 18
#: Frames that one reading task takes at a time.
READ_FRAMES = 64


class FrameWriter:
    """Writes frames to a stream; holds one open frame and the seek table."""

    def __init__(self, stream, level: int = 1):
        self.stream = stream
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.table: list[tuple[int, int, int]] = []
        self.open = bytearray()

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and place in the frame where ``data`` goes; a document is never split over frames."""
        if self.open and len(self.open) + len(data) > FRAME_BYTES:
            self.flush()
        place = len(self.table), len(self.open)
        self.open += data
        return place

    def flush(self) -> None:
        if self.open:
            data = bytes(self.open)
            packed = self.packer.compress(data)
            self.stream.write(packed)
            self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
            self.open.clear()

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.stream.close()


class FrameReader:
    """Reads single frames of a file by its seek table."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.stream = store.open_input_file(path)
        size = self.stream.size()
        count, flags, magic = struct.unpack("<IBI", self.stream.read_at(9, size - 9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        raw = self.stream.read_at(12 * count, size - 9 - 12 * count)
        self.entries = list(struct.iter_unpack("<III", raw))
        self.at = [0]
        for e in self.entries:
            self.at.append(self.at[-1] + e[0])
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        packed, size, check = self.entries[number]
        data = self.unpacker.decompress(self.stream.read_at(packed, self.at[number]), max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {number} is damaged")
        return data

    def close(self) -> None:
        self.stream.close()


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write(docs: DataFrame, tokenizer: str, to: str, *, key: str = "doc_id", text: str = "text", end: int = 2) -> DataFrame:
    """Encode ``docs`` into files below ``to`` in ascending order of ``key``; returns the index, read back from ``to``.

    The index has a row per document: ``key``, ``file``, ``part``, ``frame``, ``place`` (byte in the frame), ``start`` (ids of
    all documents before it) and ``n_tokens``. Null texts count as empty, so they hold the end id only; null keys
    come first; rows with equal keys follow each other, ordered by a hash of their text.
    """
    tail = struct.pack("<I", end)
    order = ["_key", "_hash"]
    source = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    dealt = source.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = docs.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, writer, local = encoder(tokenizer), None, 0
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.zst"
        for whole in batches:
            for batch in slices(whole, 1, SLICE_BYTES):
                if writer is None and len(batch):
                    store, root = opened(to)
                    store.create_dir(f"{root}/frames", recursive=True)
                    writer = FrameWriter(store.open_output_stream(f"{root}/frames/{name}", compression=None))
                rows: list[list] = [[], [], [], []]
                for ids in own.batch(batch.column(1)):
                    n = len(ids) // 4 + 1
                    for column, value in zip(rows, (*writer.add(ids + tail), local, n), strict=True):
                        column.append(value)
                    local += n
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([name] * len(batch)), pa.array([part] * len(batch), pa.int32()),
                     pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64())],
                    ["_key", "file", "part", "frame", "place", "local", "n_tokens"])
        if writer is not None:
            writer.close()

    shape = f"_key {kind}, file string, part int, frame int, place bigint, local bigint, n_tokens bigint"
    dealt.select("_key", "_text").mapInArrow(run, shape).write.parquet(f"{to}/documents")
    return index(docs.sparkSession, to).withColumnRenamed("_key", key)


def index(spark, to: str) -> DataFrame:
    """The index of the files below ``to``; ids before a file are the sums of the files before it, one row each."""
    rows = spark.read.parquet(f"{to}/documents")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file", "part").agg(F.sum("n_tokens").alias("_n"))
    base = files.select(F.col("file").alias("_file"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    joined = rows.join(base, F.col("file") == F.col("_file"))
    return joined.withColumn("start", F.col("_base") + F.col("local")).drop("_file", "_base", "local")


def read(wanted: DataFrame, to: str, key: str = "doc_id") -> DataFrame:
    """Rows of the index (all or a few) with ``ids``, read from the frames that hold them and no others."""
    fields = ["_key", "start", "n_tokens", "file", "frame", "place"]
    rows = wanted.withColumnRenamed(key, "_key").select(*fields)
    kind = rows.schema["_key"].dataType.simpleString()
    block = F.floor(F.col("frame") / READ_FRAMES)
    dealt = rows.repartition(F.col("file"), block).sortWithinPartitions("file", "frame", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(to)
        reader, at, data = None, (None, None), b""
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                found = []
                for n, name, frame, place in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True):
                    if at != (name, frame):
                        if at[0] != name:
                            if reader:
                                reader.close()
                            reader = FrameReader(store, f"{root}/frames/{name}")
                        data, at = reader.frame(frame), (name, frame)
                    found.append(data[place : place + 4 * n])
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.binary())], ["_key", "start", "n_tokens", "ids"])
        if reader:
            reader.close()

    return dealt.mapInArrow(run, f"_key {kind}, start bigint, n_tokens bigint, ids binary").withColumnRenamed("_key", key)
