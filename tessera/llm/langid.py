"""Language identification with bit-sliced Bloom filters of n-grams.

Each language's set is the letter n-grams that make up a least share of its
training text. All sets lie in one Bloom filter of masks: a slot holds one bit
for each language, so the AND of an n-gram's slots is the mask of all
languages that (seem to) have it. A text's n-grams are looked up at once, hits
are counted for each language, and every count is corrected for the false
positives that the language's share of set bits makes likely. The largest
corrected count decides; the score is its share of the two largest.

Training reads a bounded sample of labelled rows: about SAMPLE rows of each
language, drawn by a hash of doc_id. A set holds 1 / LEAST_SHARE n-grams of each
length at most, so the filter's size depends on the number of languages only.

A null text or one without a letter is `und` with score 0. A text with letters
but no known n-gram gets the language with the most training text, score 0.
Rows without a language aren't learned from; with nothing to learn from every
text is `und`. Repeated rows and other columns need no special care.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import map_texts

SIZES, SLOTS_BITS, HASHES = (3, 4), 20, 3
SAMPLE, LEAST_SHARE = 1500, 5e-5
UNKNOWN = "und"
#: Characters of a text whose n-grams are held at once.
BLOCK = 1 << 18
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
GRAMS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])
FOUND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), dtype=bool)


def normal(text: str, lead: np.ndarray | None = None) -> np.ndarray:
    """Code points of the lower-cased text after a space; a run of other characters than letters is one space.

    lead: what a slice of a longer text goes on from, in place of the space.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    is_letter = letters()[codes]
    codes = np.where(is_letter, codes, 32)
    lead = np.array([32], dtype=np.uint32) if lead is None else lead
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[:1] |= lead[-1] != 32
    return np.concatenate((lead, codes[keep])).astype(np.uint64)


def grams(codes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the n-grams of one size."""
    n = max(0, len(codes) - size + 1)
    out = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        out = (out ^ codes[i : i + n]) * _MULTIPLIERS[i]
        out ^= out >> np.uint64(29)
    return out


def gram_blocks(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """(size, hashes of n-grams) of a whole text, slice by slice; nothing for a text without a letter.

    Slices start at a space, so that no letter's lower case depends on another slice.
    """
    start, lead, any_letter, held = 0, None, False, []
    while start < len(text):
        cut = text.find(" ", start + BLOCK) if len(text) - start > BLOCK else -1
        end = cut if cut > 0 else len(text)
        codes = normal(text[start:end], lead)
        for size in SIZES:
            fresh = codes[max(0, (0 if lead is None else len(lead)) - size + 1) :]
            held.append((size, grams(fresh, size)))
        any_letter = any_letter or bool((codes != 32).any())
        if any_letter:
            yield from held
            held = []
        start, lead = end, codes[1 - max(SIZES) :].astype(np.uint32)


class Model(NamedTuple):
    langs: list[str]  # most training text first
    masks: np.ndarray  # (slots, words of 64 languages)
    false_rate: np.ndarray  # for each language


def slots(hashes: np.ndarray) -> np.ndarray:
    step = np.uint64(SLOTS_BITS)
    return np.stack([(hashes >> (np.uint64(k) * step)) & np.uint64((1 << SLOTS_BITS) - 1) for k in range(HASHES)]).astype(np.int64)


def build(sets: dict[str, np.ndarray]) -> Model:
    """sets: hashes for each language, in order of preference."""
    langs = list(sets)
    masks = np.zeros((1 << SLOTS_BITS, -(-max(1, len(langs)) // 64)), dtype=np.uint64)
    for i, lang in enumerate(langs):
        masks[np.unique(slots(sets[lang])), i // 64] |= np.uint64(1 << (i % 64))
    fill = np.array([np.count_nonzero(masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) / len(masks) for i in range(len(langs))])
    return Model(langs, masks, fill**HASHES)


def predict(model: Model, text: str | None) -> tuple[str, float]:
    hits, total, known = np.zeros(len(model.langs)), 0, False
    for _, hashes in gram_blocks(text or ""):
        known = True
        if len(hashes) and model.langs:
            first, *rest = slots(hashes)
            found = model.masks[first]
            for more in rest:
                found &= model.masks[more]
            hits += [np.count_nonzero(found[:, i // 64] & np.uint64(1 << (i % 64))) for i in range(len(model.langs))]
            total += len(hashes)
    if not known or not model.langs:
        return UNKNOWN, 0.0
    true = np.maximum(0.0, (hits - total * model.false_rate) / (1 - model.false_rate))
    best = int(true.argmax())
    if true[best] == 0:
        return model.langs[0], 0.0
    return model.langs[best], float(true[best] / np.sort(true)[-2:].sum())


def train(docs: DataFrame, sample: int = SAMPLE, least_share: float = LEAST_SHARE) -> Model:
    """Learn from documents with a language; about sample rows of each are read."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not sizes:
        return build({})
    share = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n))) for lang, n in sizes.items()])
    drawn = known.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < share * 1_000_000)

    def step():
        def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            by_set: dict[tuple[str, int], list[np.ndarray]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                for size, hashes in gram_blocks(text):
                    by_set.setdefault((lang, size), []).append(hashes)
            for (lang, size), hashes in by_set.items():
                found, n = np.unique(np.concatenate(hashes), return_counts=True)
                columns = [pa.array([lang] * len(n)), pa.array(np.full(len(n), size, np.int32)), pa.array(found.view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=GRAMS.names)

        return work

    counts = map_texts(drawn, GRAMS, step).groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    ranked = counts.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    totals = {(r.lang, r["size"]): r.n for r in ranked.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return build({})
    least = F.coalesce(*[F.when((F.col("lang") == lang) & (F.col("size") == size), F.lit(n * least_share)) for (lang, size), n in totals.items()])
    kept = ranked.filter(F.col("n") >= least).select("lang", "gram").toPandas()  # 1 / least_share rows of each language and size at most
    text_size = {lang: sum(n for (k, _), n in totals.items() if k == lang) for lang, _ in totals}
    order = sorted(text_size, key=lambda lang: (-text_size[lang], lang))
    return build({lang: kept.gram[kept.lang == lang].to_numpy().view(np.uint64) for lang in order})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every whole text, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step():
        def work(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
            found = [predict(shared.value, t) for t in batch["text"].to_pylist()]
            langs, scores = zip(*found)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=FOUND.names)

        return work

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), FOUND, step)
