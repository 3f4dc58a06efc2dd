"""Token counts of whole texts, without keeping any ids.

An Arrow function takes texts in batches of about equal bytes. A text is split
where no token of the vocabulary can reach across: in front of every run of
spaces, and inside a part of over LONG characters between any two neighbours
that stand side by side in no token. The parts are encoded in batches by the
sentencepiece library, which is asked for lengths only, and each distinct part
is encoded once while a memo of bounded bytes holds its length. The splits are
checked against the vocabulary when it is loaded: if a token has the space mark
after another character, or the library treats spaces otherwise than the probes
expect, no text is split.

Null texts count as empty (0 bytes, 0 tokens). Repeated rows give repeated
counts, empty tables give no rows, other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import by_size, map_texts

COUNTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
MARK = "▁"
#: Bytes of text in one batch for the library, and of parts in the memo; longer parts are split again and not kept.
BATCH_BYTES, KEPT, LONG = 4 << 20, 64 << 20, 2000
#: Characters split at once.
SLICE = 1 << 20
_RUN, _FIRST_SPACE = re.compile(" +[^ ]*"), re.compile(f"(?<=[^ {MARK}])[ {MARK}]")


def neighbours(pieces: Iterable[str]) -> np.ndarray:
    """Every two characters that stand side by side in a piece, as sorted numbers."""
    return np.array(sorted({ord(a) << 21 | ord(b) for p in pieces for a, b in zip(p, p[1:])}), dtype=np.int64)


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.joined = neighbours(p for i, p in enumerate(pieces) if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)))
        ordinary = not any(MARK in p.lstrip(MARK) for p in pieces)
        #: A part gets the space in front of it from the library, which must add one and keep all others.
        shown = [self.library.encode(x, out_type=str) for x in ("a", "a b", " a", "a  b", "a ")]
        again = [self.library.encode(x, out_type=str) for x in ("a", "b", " b")]
        self.splits = ordinary and shown[0] == [MARK + "a"] and shown[1] == again[0] + again[1] and shown[2] != shown[0]
        self.splits = self.splits and shown[3] == again[0] + again[2] and shown[4] == [MARK + "a", MARK]
        self.lead = len(self.library.encode("\n"))
        self.lengths: dict[str, int] = {"": 1}  # a space at the very end
        self.held = 0

    def parts(self, text: str) -> list[str]:
        """Parts to encode on their own, each without the space that the library puts in front."""
        text = text.replace(MARK, " ")
        if "  " not in text and text[0] != " ":
            return text.split(" ")
        return [run[1:] for run in _RUN.findall(" " + text)]

    def pieces_of(self, part: str) -> list[str]:
        """A long part in pieces between which no token reaches; all but the first get a line end in front in place of the space."""
        codes = np.frombuffer(part.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        pairs = codes[:-1] << 21 | codes[1:]
        at = np.searchsorted(self.joined, pairs)
        apart = np.flatnonzero(self.joined[np.minimum(at, len(self.joined) - 1)] != pairs) + 1
        cuts, last = [], 0
        for place in apart.tolist():
            if place - last >= LONG // 2 and part[place] not in (" ", "\n") and part[place - 1] not in (" ", "\n"):
                cuts.append(last := place)
        return [part[i:j] for i, j in zip([0, *cuts], [*cuts, len(part)])]

    def long_part(self, part: str) -> int:
        first, *rest = self.pieces_of(part)
        counts = map(len, chain.from_iterable(self.library.encode(x, num_threads=1) for x in ([first], ["\n" + p for p in rest])))
        return sum(counts) - self.lead * len(rest)

    def count_split(self, texts: list[str]) -> list[int]:
        """Counts of texts, or of slices, the last of which may be empty for a text that ends in a space."""
        split = [self.parts(t) if t else [""] for t in texts]
        known = self.lengths
        if self.held > KEPT:
            known.clear()
            known[""], self.held = 1, 0
        new = [p for p in set(chain.from_iterable(split)).difference(known) if len(p) <= LONG]
        for i, j in by_size([len(p) for p in new], BATCH_BYTES):
            known.update(zip(new[i:j], map(len, self.library.encode(new[i:j], num_threads=1))))
        self.held += sum(map(len, new)) + 150 * len(new)
        return [sum(self.long_part(p) if len(p) > LONG else known[p] for p in s) if max(map(len, s)) > LONG else sum(map(known.__getitem__, s)) for s in split]

    def count(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return [len(x) for x in self.library.encode(texts, num_threads=1)]
        out = [0] * len(texts)
        at = [i for i, t in enumerate(texts) if t and len(t) <= SLICE]
        for i, n in zip(at, self.count_split([texts[i] for i in at])):
            out[i] = n
        for i, text in enumerate(texts):
            if len(text) > SLICE:
                out[i] = sum(n for block in slices(text) for n in self.count_split([block]))
        return out


def slices(text: str) -> Iterator[str]:
    """A long text in slices of about SLICE characters that start after the first space of a run, which the library gives back."""
    start = 0
    while start < len(text):
        cut = _FIRST_SPACE.search(text, start + SLICE)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end + 1
        if cut and start == len(text):
            yield ""


_LOADED: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    if path not in _LOADED:
        _LOADED[path] = PieceCounter(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row's whole text."""

    def step():
        count = counter(model).count

        def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            texts = [t or "" for t in batch["text"].to_pylist()]
            sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).cast(pa.int64())
            lengths = list(chain.from_iterable(count(texts[i:j]) for i, j in by_size(sizes.to_pylist(), BATCH_BYTES)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], sizes, pa.array(lengths, pa.int64())], names=COUNTS.names)

        return work

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), COUNTS, step)
