"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint's 64 bits are taken as 32 segments of two bits, and each segment
is mapped to its bit count. The Manhattan distance of two such count vectors
never exceeds the Hamming distance of the fingerprints, since a flipped bit
moves one count by one. Counts are kept in unary code (0, 1, 2 as 00, 01, 11),
so the distance of two vectors is the bit count of one XOR.

Fingerprints within two bits have vectors within distance two. That is a range
join on a grid of unit cells: one side stands in its own cell and in those one
step up, the other side also in those one step down, and any two vectors within
distance two share such a cell. Few others do: random vectors agree in a cell
with probability (3/8)^32, so the pairs that meet grow nearly in proportion to
the fingerprints. Which steps may meet is fixed so that a pair meets once:
equal vectors in their own cell, vectors one step apart in the upper one's own
cell, two steps in opposite directions in the cell above both, two steps in one
direction in the cell that steps first in the lower segment. Pairs that meet
lie within the bound and are put to the exact test on the bits.

The graph's nodes are distinct fingerprints: exact copies, however many, are
one node. Links become components by alternating large and small stars, each
round a written table; joins on a hub are salted. Groups with a third of all
rows are met only by partial aggregates and by a join that Spark can split.
Spark judges an exploded table by the size of the file that it comes from, so
cells and salted tables, which have many rows for each of the file's, are
marked for a merge join: broadcast, they would fill the driver.

A null or empty text has no words and fingerprint zero, which links like any
other. Texts with fewer words than a shingle hash their whole word sequence.
Rows with equal texts are one class; rows without a doc_id belong to their
class but don't name it (a class with no id at all has a null component_id).
Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import drop_table, fresh_name, map_texts, persist_table

PRINTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("print", T.LongType())])
SEED, SHINGLE, RADIUS, SALTS = 42, 3, 2, 16
#: Links up to which a table of their nodes (two longs, two rows for each link at most) is broadcast instead of salted.
FEW = 50_000
#: Bytes of a text whose words are held at once.
BLOCK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_LOW = 0x5555555555555555


def word_blocks(text: str, shingle: int) -> Iterator[list[bytes]]:
    """Lower-cased words of a text, block by block; each block starts with the last words of the one before, as shingles need."""
    data, start, tail = text.encode().lower(), 0, []
    while start < len(data):
        cut = _SPACE.search(data, start + BLOCK) if len(data) - start > BLOCK else None
        end = cut.start() if cut else len(data)
        words = tail + data[start:end].split()
        start, tail = end, words[len(words) - shingle + 1 :] if len(words) >= shingle else words
        yield words


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half the XXH64 hashes of the text's word shingles."""
    counts, total, words = np.zeros(64, dtype=np.int64), 0, []
    for words in word_blocks(text, shingle):
        runs = zip(*(words[i:] for i in range(shingle)))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in map(b" ".join, runs)), dtype="<u8")
        total += len(hashes)
        for at in range(0, len(hashes), 1 << 15):
            rows = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, digest: bool = False) -> DataFrame:
    """doc_id and print, the fingerprint as a signed long, of every whole text; digest adds the text's digest."""
    kind = T.StructType([*PRINTS, T.StructField("digest", T.BinaryType())]) if digest else PRINTS
    own = [text_digest(F.col("text")).alias("digest")] * digest

    def step():
        def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch] | Iterable[pa.RecordBatch]:
            prints = np.array([simhash(t or "", shingle) for t in batch["text"].to_pylist()], dtype=np.uint64)
            more = [batch["digest"].cast(pa.binary())] if digest else []
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints.view(np.int64)), *more], names=kind.names)

        return work

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *own), kind, step)


def long(value: int) -> Column:
    """A 64-bit pattern as a signed literal."""
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def embed(bits: Column) -> Column:
    """Bit counts of the two-bit segments, each count in unary code."""
    upper = F.shiftrightunsigned(bits, 1)
    any_set, both_set = bits.bitwiseOR(upper).bitwiseAND(long(_LOW)), bits.bitwiseAND(upper).bitwiseAND(long(_LOW))
    return any_set.bitwiseOR(F.shiftleft(both_set, 1))


def cell_above(cell: Column, i: Column) -> Column:
    """The cell with one more in segment i, or null if that segment is full; i is twice the segment's number."""
    low, high = F.expr("1L"), F.expr("2L")
    at = lambda bit: F.call_function("shiftleft", bit, i)
    return F.when(cell.bitwiseAND(at(low)) == 0, cell.bitwiseOR(at(low))).when(cell.bitwiseAND(at(high)) == 0, cell.bitwiseOR(at(high)))


def cell_below(cell: Column, i: Column) -> Column:
    """The cell with one less in segment i, or null if that segment is empty."""
    low, high = F.expr("1L"), F.expr("2L")
    at = lambda bit: F.call_function("shiftleft", bit, i)
    return F.when(cell.bitwiseAND(at(high)) != 0, cell.bitwiseXOR(at(high))).when(cell.bitwiseAND(at(low)) != 0, cell.bitwiseXOR(at(low)))


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints, column print, that differ in at most radius (2 or fewer) bits."""
    if not 0 <= radius <= 2:
        raise ValueError("the grid join reaches two steps, so two differing bits")
    steps = F.array(*[F.lit(2 * i) for i in range(32)])

    def stepped(kind: int, move) -> Column:
        cells = F.transform(steps, lambda i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), move(F.col("own"), i).alias("cell")))
        return F.filter(cells, lambda c: c["cell"].isNotNull())

    still = F.array(F.struct(F.lit(0).alias("kind"), F.lit(0).alias("at"), F.col("own").alias("cell")))
    vectors = prints.select("print", embed(F.col("print")).alias("own"))
    ups, downs = stepped(1, cell_above), stepped(-1, cell_below)
    left = vectors.select(F.col("print").alias("a"), F.inline(F.concat(still, ups))).toDF("a", "kind", "at", "cell")
    right = vectors.select(F.col("print").alias("b"), F.inline(F.concat(still, ups, downs))).toDF("b", "kind_b", "at_b", "cell_b")
    k, j, i, h = F.col("kind"), F.col("kind_b"), F.col("at"), F.col("at_b")
    once = (
        ((k == 0) & (j == 0) & (F.col("a") < F.col("b")))
        | ((k == 1) & (j == 0))
        | ((k == 1) & (j == 1) & (i != h) & (F.col("a") < F.col("b")))
        | ((k == 1) & (j == -1) & (i <= h))
    )
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    meets = (F.col("cell") == F.col("cell_b")) & once & (differing <= radius)
    return left.hint("merge").join(right, meets).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _salted(rows: DataFrame, key: str, other: str, table: DataFrame, n: int) -> DataFrame:
    """Join rows with a table of one row for each key, without bringing a hub's rows to one task; n: the number of links."""
    if n <= FEW:
        return rows.join(F.broadcast(table), key)
    salts = F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("_salt")
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int"))
    return dealt.join(table.select("*", salts).hint("merge"), [key, "_salt"]).drop("_salt")


def connected_components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node it can reach, for every node of the links (a, b) but the roots."""
    edges = persist_table(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
    seen = None
    while True:  # the tables of a round are deleted by the next
        mark = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if not mark.n or mark == seen:
            return edges.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("root"))
        seen = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _salted(both, "u", "v", least, mark.n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, large = edges, persist_table(large.filter("u <> v").distinct(), "large-star")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = _salted(down, "u", "v", least, mark.n).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = persist_table(small.select("e.u", "e.v").filter("u <> v").distinct(), "small-star")
        drop_table(before)
        drop_table(large)


def components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """p, the print of its component that stands for it (group) and its smallest doc_id (component_id), for every distinct print."""
    nodes = persist_table(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "nodes")
    stars = connected_components(near_links(nodes.select("print"), radius))
    members = stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
    named = persist_table(members.join(nodes, members.node == nodes.print).select("node", "root", "first"), "members")
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    linked = _salted(named, "root", "node", smallest, stars.count()).select(F.col("node").alias("print"), F.col("root").alias("group"), "component")
    classes = nodes.join(linked, "print", "left").select(
        F.col("print").alias("p"), F.coalesce("group", "print").alias("group"), F.coalesce("component", "first").alias("component_id")
    )
    return persist_table(classes, "classes")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id, the smallest doc_id of its component, of every document."""
    prints = persist_table(fingerprints(docs, shingle), "prints")
    classes = components(prints, radius)
    found = prints.join(classes, prints["print"] == classes["p"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def text_digest(text: Column) -> Column:
    """The first 128 bits of a text's SHA-256; a null text counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def keep_rows(docs: DataFrame, places: DataFrame) -> DataFrame:
    """One row of docs for each (doc_id, digest) of places, whole and with all its columns.

    Rows that repeat are brought down to one in every task before they move, and
    the rows move once: the look-up uses the same partitioning.
    """
    name = fresh_name(docs, "_row_key")
    key = lambda doc_id, digest: F.concat(digest, F.coalesce(doc_id.cast("long").cast("string"), F.lit("none")).cast("binary"))
    wanted = places.select(key(F.col("doc_id"), F.col("digest")).alias(name))
    keyed = docs.withColumn(name, key(docs["doc_id"], text_digest(docs["text"])))
    return keyed.dropDuplicates([name]).join(wanted, name, "left_semi").drop(name)


def first_places(prints: DataFrame, group_of: DataFrame) -> DataFrame:
    """doc_id and digest of the first row of each group, by doc_id (nulls last) and then by digest; group_of: print p and its group."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    least = prints.groupBy("print").agg(F.min(place).alias("place")).join(group_of.select("p", "group"), F.col("print") == F.col("p"))
    return least.groupBy("group").agg(F.min("place").alias("place")).select("place.doc_id", "place.digest")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component of docs: the first by doc_id (nulls last) and then by the digest of its text.

    Documents without an id, or with one that others have too, are told apart
    by their texts, so a component never loses its last document.
    """
    prints = persist_table(fingerprints(docs, shingle, digest=True), "prints")
    return keep_rows(docs, first_places(prints, components(prints, radius)))
