"""Token-id files: independent zstandard frames with a trailing seek table.

Layout of a shard file, all integers little-endian:

* data frames: ids as unsigned 32-bit integers, each frame a zstandard frame of
  its own that holds whole documents up to FRAME_IDS ids (a longer document
  spans several frames);
* the document index: a skippable frame (magic 0x184D2A50) around one
  zstandard frame with doc_id int64, a byte that says whether doc_id is known,
  and the count of ids uint32, each as a column;
* the seek table: a skippable frame (magic 0x184D2A5E) in the public seekable
  format: for each frame, the document index included, compressed size,
  content size and the low 32 bits of the content's XXH64, then the number of
  frames, a descriptor byte with the checksum flag and the magic 0x8F92EAB1.

A reader takes the tail, then decompresses only the frames that hold the
documents asked for, and verifies each frame's checksum. Ids need 32 bits
because the format doesn't know the vocabulary.

Documents are range-partitioned by (doc_id, hash of the text), so shards are in
ascending doc_id order and repeated ids don't make one large partition. Each
task writes a file of its own under a name that no other attempt shares; the
manifest names the files of the attempts that counted. Null texts count as
empty; null ids sort first. Repeated rows are written as often as they occur.
An empty table gives no files and no rows. Other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bpe import encoder
from tessera.llm.common import bound_batches, new_path, persist_table, spread_prefix

MAGIC_INDEX, MAGIC_TABLE, MAGIC_SEEK = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FRAME_IDS = 1 << 16
#: Bytes of input, as the planner knows them, for each shard.
SHARD_BYTES = 512 << 20
#: The driver plans a border for each shard; beyond so many, shards grow.
MOST_SHARDS = 1 << 19
MANIFEST = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("path", T.StringType()),
    T.StructField("documents", T.LongType()), T.StructField("tokens", T.LongType()),
])
READ = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])


class Frame(NamedTuple):
    offset: int
    size: int
    content: int
    checksum: int


class ShardWriter:
    def __init__(self, out):
        self.out, self.frames, self.buffer, self.buffered = out, [], [], 0
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        if self.buffered and self.buffered + len(ids) > 4 * FRAME_IDS:
            self._flush()
        for at in range(0, len(ids), 4 * FRAME_IDS):
            part = ids[at : at + 4 * FRAME_IDS]
            self.buffer.append(part)
            self.buffered += len(part)
            if self.buffered >= 4 * FRAME_IDS:
                self._flush()

    def _flush(self) -> None:
        if self.buffered:
            self._frame(b"".join(self.buffer))
            self.buffer, self.buffered = [], 0

    def _frame(self, content: bytes, wrap: bool = False) -> None:
        packed = self.packer.compress(content)
        if wrap:
            self.out.write(struct.pack("<II", MAGIC_INDEX, len(packed)))
        self.out.write(packed)
        self.frames.append((len(packed) + 8 * wrap, len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        self._flush()
        known = np.array([d is not None for d in self.doc_ids], dtype=np.uint8)
        ids = np.array([d or 0 for d in self.doc_ids], dtype="<i8")
        self._frame(ids.tobytes() + known.tobytes() + np.array(self.counts, dtype="<u4").tobytes(), wrap=True)
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, MAGIC_SEEK)
        self.out.write(struct.pack("<II", MAGIC_TABLE, len(table)) + table)


class ShardReader:
    """Random access to a shard; decompressed counts the frames that were."""

    def __init__(self, source):
        self.source, self.decompressed = source, 0
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != MAGIC_SEEK or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        table = source.read_at(12 * n, size - 9 - 12 * n)
        at, self.frames = 0, []
        for i in range(n):
            frame = Frame(at, *struct.unpack_from("<III", table, 12 * i))
            self.frames.append(frame)
            at += frame.size
        index = self.frames.pop()
        content = self._content(index, skip=8)
        docs = len(content) // 13
        known = np.frombuffer(content, np.uint8, docs, 8 * docs).astype(bool)
        self.doc_ids = [d if k else None for d, k in zip(np.frombuffer(content, "<i8", docs).tolist(), known.tolist())]
        self.counts = np.frombuffer(content, "<u4", docs, 9 * docs).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.borders = np.cumsum([0, *(f.content // 4 for f in self.frames)])
        self.cached = (-1, b"")

    def _content(self, frame: Frame, skip: int = 0) -> bytes:
        packed = self.source.read_at(frame.size - skip, frame.offset + skip)
        content = zstandard.ZstdDecompressor().decompress(packed, max_output_size=frame.content)
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != frame.checksum:
            raise ValueError(f"checksum of the frame at {frame.offset} doesn't match")
        return content

    def _frame(self, number: int) -> bytes:
        if self.cached[0] != number:
            self.decompressed += 1
            self.cached = (number, self._content(self.frames[number]))
        return self.cached[1]

    def ids(self, position: int) -> bytes:
        """The ids of the document at a position in the shard."""
        start, end = self.starts[position], self.starts[position] + self.counts[position]
        out, frame = [], int(np.searchsorted(self.borders, start, side="right")) - 1
        while start < end:
            base, upto = self.borders[frame], min(end, self.borders[frame + 1])
            out.append(self._frame(frame)[4 * (start - base) : 4 * (upto - base)])
            start, frame = upto, frame + 1
        return b"".join(out)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a shared folder named by a URI or a plain path."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode documents (doc_id, text), write shards in doc_id order, and give the manifest."""
    spark = docs.sparkSession
    folder = folder or new_path(spark, "tokens")
    bound_batches(spark)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_t", F.xxhash64("text"))
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_SHARDS, size // SHARD_BYTES))
    ordered = keyed.repartitionByRange(shards, "doc_id", "_t").sortWithinPartitions("doc_id", "_t").drop("_t")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], dtype="<u4").tobytes()
        shard, writer = TaskContext.get().partitionId(), None
        fs, root = open_folder(folder)
        path = f"{root}/shard-{shard:06d}-{uuid.uuid4().hex}.tok"
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    writer = ShardWriter(fs.open_output_stream(path))
                writer.add(doc_id, encode(text or "") + end)
        if writer is not None:
            writer.close()
            writer.out.close()
            row = ([shard], [path], [len(writer.counts)], [sum(writer.counts)])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, (pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=MANIFEST.names)

    return persist_table(ordered.mapInArrow(write, MANIFEST).withColumn("folder", F.lit(folder)), "token-manifest")


def read_token_files(manifest: DataFrame, wanted: Iterable[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids of the documents in a manifest's shards.

    wanted: only these doc_ids; frames without any of them aren't decompressed.
    """
    spark: SparkSession = manifest.sparkSession
    keep = None if wanted is None else set(wanted)
    shards = spread_prefix(manifest.select("shard", "path", "folder", "tokens"), "shard", "tokens", "base")
    shards = shards.repartition(max(1, manifest.count()), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, folder, base in zip(*(batch[c].to_pylist() for c in ("path", "folder", "base"))):
                with open_folder(folder)[0].open_input_file(path) as source:
                    reader = ShardReader(source)
                    chosen = [i for i, d in enumerate(reader.doc_ids) if keep is None or d in keep]
                    for i in range(0, len(chosen), 500):
                        own = chosen[i : i + 500]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([reader.doc_ids[p] for p in own], pa.int64()),
                            pa.array([base + int(reader.starts[p]) for p in own], pa.int64()),
                            pa.array([reader.ids(p) for p in own], pa.binary()),
                        ], names=READ.names)

    return shards.mapInArrow(read, READ)
