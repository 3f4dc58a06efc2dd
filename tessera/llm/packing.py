"""Best-fit-decreasing packing of token sequences into bins of fixed capacity.

Best-fit decreasing looks at pieces from the longest to the shortest and puts
each into the open bin with the least room that still holds it. Pieces of one
length are alike, so the algorithm runs exactly on the histogram of lengths:
bins with equal room lie in runs of consecutive bin numbers, a segment tree
over the remaining capacities finds the tightest open run in logarithmic time,
and a run is filled by arithmetic. The driver holds at most one count for each
length up to the capacity; the plan's size depends on the capacity, not on the
number of documents. Documents get their places by rank within their length,
which is a count for each input partition plus a running number within it.

Null texts count as empty; a document has at least its end token, so every row
gets a piece. Repeated rows are packed as often as they occur. An empty table
gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.llm.bpe import encoder
from tessera.llm.common import map_texts, persist_table

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("part", T.LongType()), T.StructField("rank", T.LongType()),
])
PIECES_WITH_IDS = T.StructType([*PIECES.fields, T.StructField("ids", T.BinaryType())])


class OpenBins:
    """Runs of bins by remaining capacity, under a segment tree that knows which capacities have any."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = np.zeros(2 * self.leaves, dtype=bool)
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def push(self, room: int, first: int, count: int) -> None:
        if room and count:
            self.runs[room].append((first, count))
            self._mark(room, True)

    def pop(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        if not self.runs[room]:
            self._mark(room, False)
        return run

    def _mark(self, room: int, value: bool) -> None:
        node = self.leaves + room
        self.any[node] = value
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least length that an open bin has."""
        node = self.leaves + length
        if self.any[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.leaves:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit_plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, first bin, pieces for each bin, offset in the bin), by length and rank."""
    bins, opened, plan = OpenBins(capacity), 0, []
    for length in sorted(histogram, reverse=True):
        rank, total = 0, histogram[length]
        while rank < total:
            room = bins.tightest(length)
            if room is None:
                room = capacity
                first, count = opened, -(-(total - rank) // (capacity // length))
                opened += count
            else:
                first, count = bins.pop(room)
            each = room // length
            placed = min(count * each, total - rank)
            plan.append((length, rank, first, each, capacity - room))
            full, rest = divmod(placed, each)
            used = full + bool(rest)
            bins.push(room, first + used, count - used)
            if rest:
                bins.push(room - rest * length, first + full, 1)
            bins.push(room - each * length, first, full)
            rank += placed
    return np.array(sorted(plan), dtype=np.int64).reshape(-1, 5)


def cut(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document; the first takes what is left over."""
    start, size = 0, length % capacity or capacity
    while start < length:
        yield start, size
        start, size = start + size, capacity


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Pieces of every document, with their rank among the pieces of their length in their input partition."""
    schema = PIECES_WITH_IDS if with_ids else PIECES

    def step():
        encode, end = encoder(tokenizer).encode, np.array([end_id], dtype="<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)

        def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = encode(text or "") + end
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((doc_id, number, start, length, zlib.crc32(own), part, seen[length], *[own] * with_ids))
                    seen[length] += 1
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, *[pa.binary()] * with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=schema.names)

        return work

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), schema, step)


def assign(pieces: DataFrame, capacity: int) -> DataFrame:
    """Places for pieces with length, part and rank: adds sequence_id and offset.

    pieces must be a written table: part and rank are read more than once.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "part").agg((F.max("rank") + 1).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    plan = spark.sparkContext.broadcast(best_fit_plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("base")).drop("base", "part")
    schema = T.StructType([f for f in ranked.schema.fields if f.name != "rank"] + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = plan.value
        keys = (rows[:, 0] << 44) + rows[:, 1]
        for batch in batches:
            length, rank = (batch[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            row = rows[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
            nth, at = np.divmod(rank - row[:, 1], row[:, 3])
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(row[:, 2] + nth), pa.array(row[:, 4] + at * length)], names=schema.names)

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Tokenize documents (doc_id, text) and pack them; with_ids adds the pieces' ids as little-endian bytes."""
    pieces = persist_table(tokenized_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    return assign(pieces, capacity)
