"""BPE encoding with reuse of content-defined chunks, and decoding.

A rolling hash over a text's bytes picks chunk borders from the content alone,
so equal passages in different documents make equal chunks wherever they stand.
A chunk is encoded once for each worker process, in a memo of bounded bytes, and
its ids are joined to its neighbours'. Ids at a join may differ from those of
the whole text: the tail of the left chunk and the head of the right one are
encoded again together. Head and tail end where the pre-tokenizer always cuts,
at a space between two characters that aren't white space; a cut is taken only
if the chunk's ids agree exactly with the ids of its parts, else the next one
is tried, and at last the chunks are encoded as one text.

Nothing is shuffled: chunk ids aren't exchanged between executors, since moving
every chunk would cost more than encoding it (figures in the README). Null texts count as empty (no
ids). Repeated rows, empty tables and other columns need no special care: each
row gives one row with doc_id and its result.
"""

from __future__ import annotations

from collections.abc import Iterable
from sys import getsizeof
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.bpe import SAFE_CUT, Memo, encoder
from tessera.llm.common import map_texts

ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
DECODED = T.StructType([*ENCODED.fields, T.StructField("decoded", T.StringType())])
#: Bytes that the rolling hash sees; chunk lengths in bytes, with the mean a power of two.
WINDOW_STEPS, LEAST, MEAN, MOST = 5, 256, 1024, 4096
#: Bytes hashed at once; bytes of chunks, of joins and of words that a worker keeps.
BLOCK, KEPT_CHUNKS, KEPT_JOINS, KEPT_WORDS = 1 << 20, 12 << 20, 8 << 20, 48 << 20
_GEAR = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)


def chunk_borders(data: bytes) -> list[int]:
    """Ends of the content-defined chunks of UTF-8 data, never within a character."""
    if len(data) <= LEAST:
        return [len(data)] if data else []
    raw = np.frombuffer(data, dtype=np.uint8)
    hits: list[int] = []
    for at in range(0, len(raw), BLOCK):
        lead = min(at, 1 << WINDOW_STEPS)  # the bytes before the block that its hashes see
        rolled = _GEAR[raw[at - lead : at + BLOCK]]
        for step in range(WINDOW_STEPS):  # after step k the hash covers the last 2 ** (k + 1) bytes
            wide = 1 << step
            rolled[wide:] += rolled[:-wide] << np.uint64(wide)
        found = np.flatnonzero((rolled[lead:] >> np.uint64(64 - MEAN.bit_length() + 1)) == 0)
        hits += (found + at + 1).tolist()
    ends, start = [], 0
    for hit in [*hits, len(data)]:
        while hit - start > MOST:
            ends.append(start := _whole(raw, start + MOST))
        if hit - start >= LEAST or hit == len(data):
            hit = _whole(raw, hit)
            if hit > start:
                ends.append(start := hit)
    return ends


def _whole(raw: np.ndarray, end: int) -> int:
    while end < len(raw) and raw[end] & 0xC0 == 0x80:
        end += 1
    return end


class Chunk(NamedTuple):
    head: str  # text before the first agreed cut
    core: bytes  # ids between the two cuts
    tail: str  # text after the last agreed cut


class ChunkedEncoder:
    def __init__(self, path: str, chunk_bytes: int = KEPT_CHUNKS, join_bytes: int = KEPT_JOINS):
        self.encode_plain = encoder(path, KEPT_WORDS).encode
        self.chunks = Memo(self._chunk, chunk_bytes, MOST + 4, lambda chunk: sum(map(getsizeof, chunk or ())))
        self.joins = Memo(self.encode_plain, join_bytes, MOST)

    def _chunk(self, text: str) -> Chunk | None:
        """None: no cut of this chunk agrees, so that it can't be joined by its parts."""
        ids = self.encode_plain(text)
        cuts = [m.start() for m in SAFE_CUT.finditer(text)]
        first = next((c for c in cuts if ids.startswith(self.encode_plain(text[:c]))), None)
        last = next((c for c in reversed(cuts) if ids.endswith(self.encode_plain(text[c:]))), None)
        if first is None or last is None or first > last:
            return None
        head, tail = (len(self.encode_plain(t)) for t in (text[:first], text[last:]))
        return Chunk(text[:first], ids[head : len(ids) - tail], text[last:])

    def encode(self, text: str) -> bytes:
        data = text.encode()
        out, open_tail, start = [], "", 0
        for end in chunk_borders(data):
            piece = data[start:end].decode()
            start = end
            chunk = self.chunks[piece]
            if chunk is None:
                open_tail += piece
                continue
            out += [self.joins[open_tail + chunk.head], chunk.core]
            open_tail = chunk.tail
        out.append(self.joins[open_tail])
        return b"".join(out)


_LOADED: dict[str, ChunkedEncoder] = {}


def chunked_encoder(path: str) -> ChunkedEncoder:
    if path not in _LOADED:
        _LOADED[path] = ChunkedEncoder(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ids, an array of the tokenizer's ids for each whole text."""

    def step():
        encode = chunked_encoder(tokenizer).encode

        def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            ids = [encode(t or "") for t in batch["text"].to_pylist()]
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends), values, type=pa.list_(pa.field("element", pa.int32(), False)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], lists], names=ENCODED.names)

        return work

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ENCODED, step)


def byte_table(path: str) -> list[bytes]:
    """The bytes that each id of a byte-level vocabulary stands for."""
    lib = encoder(path)
    back = {c: b for b, c in lib.table.items()}
    size = lib.tokenizer.get_vocab_size(with_added_tokens=True)
    tokens = (lib.tokenizer.id_to_token(i) for i in range(size))
    return [t.encode() if t in lib.special else bytes(back[c] for c in t) for t in tokens]


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """Adds decoded, the text of ids; bytes that aren't UTF-8 become replacement characters."""

    def step():
        parts = byte_table(tokenizer).__getitem__

        def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            lists = batch["ids"]
            ends, flat = lists.offsets.to_pylist(), lists.values.to_numpy()
            texts = [b"".join(map(parts, flat[i:j].tolist())).decode("utf-8", "replace") for i, j in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], lists, pa.array(texts, pa.string())], names=DECODED.names)

        return work

    return map_texts(encoded.select("doc_id", "ids"), DECODED, step)
