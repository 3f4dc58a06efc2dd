"""Document fingerprints: a Merkle tree over paragraphs and sections, in DataFrame expressions only.

A paragraph is a line; its node is the SHA-256 of its exact text. A section is
a run of paragraphs that ends where a paragraph's digest says so (one in
SECTION_MEAN), so that an inserted paragraph moves no later border. A
section's node hashes its paragraphs' nodes, the root hashes the sections'
nodes. Equal roots mean equal texts; unequal roots are followed down into the
sections and paragraphs that differ, which locates an edit.

Below the paragraphs lie leaves for comparison: runs of characters that end
where the text itself says so, after a sentence's sign and the white space
behind it, after an ideographic sign, a line end, or a space behind a word that
ends in one of CLOSING. So a text of one long paragraph has leaves too, and an
edit moves no later border. Where no such place comes within LEAF characters,
the leaf ends there.

Likeness is 1 for equal roots, else the share (Dice) of code points in the
leaves that both trees have, each distinct leaf counted once.

A null text counts as empty. Repeated rows and repeated ids are neighbours of
each other in document order, by the text's hash; null ids come last. An empty
table gives no rows; other columns are ignored. A table of one row is its own
next document. Texts of any length are compared whole.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.quality_rules import let

SECTION_MEAN = 8
#: Most characters of a leaf; letters (about one word end in six in each language here) after which a space ends one.
LEAF, CLOSING = 200, "dfghkmpuwyz"
LEAF_PATTERN = rf"(?s).{{1,{LEAF}}}?(?:[.!?…।][ \t\n\f\r]+|[。！？]|[{CLOSING}] |\n|\z)|.{{{LEAF}}}"
#: Rows of a block in which neighbours meet, and the most blocks: their borders go to the driver (about 20 bytes each).
BLOCK_ROWS, MOST_BLOCKS, DRAWN = 1000, 1 << 18, 16
#: Bits of a leaf's number that hold its length.
_LENGTH_BITS = 12


def paragraphs(text: Column) -> Column:
    """Digests of a text's paragraphs."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256))


def sections(nodes: Column) -> Column:
    """Paragraph digests in runs: array of section digests, from the digests of their paragraphs."""
    closes = lambda d: F.conv(F.substring(d, 1, 2), 16, 10).cast("int") % SECTION_MEAN == 0
    marked = F.array_join(F.transform(nodes, lambda d: F.concat(d, F.when(closes(d), ";").otherwise(","))), "")
    return F.transform(F.filter(F.split(marked, ";"), lambda s: s != ""), lambda s: F.sha2(F.concat(F.lit("section:"), s), 256))


def root(text: Column) -> Column:
    """Equal for equal texts: the digest over the sections' digests."""
    return F.sha2(F.concat(F.lit("root:"), F.array_join(sections(paragraphs(text)), ",")), 256)


def leaves(text: Column) -> Column:
    """Distinct leaves as 52 hash bits over 12 bits of length."""
    mask = (1 << _LENGTH_BITS) - 1
    runs = F.regexp_extract_all(text, F.lit(LEAF_PATTERN), F.lit(0))
    return F.array_distinct(F.transform(runs, lambda s: F.xxhash64(s).bitwiseAND(F.lit(~mask)).bitwiseOR(F.char_length(s).cast("long"))))


def weight(found: Column) -> Column:
    return F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a + x.bitwiseAND(F.lit((1 << _LENGTH_BITS) - 1)))


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    both = (weight(leaves_a) + weight(leaves_b)).cast("double")
    shared = 2.0 * weight(F.array_intersect(leaves_a, leaves_b))
    return F.when(root_a == root_b, 1.0).when(both == 0, 0.0).otherwise(shared / both)


def fingerprint_tree(docs: DataFrame) -> DataFrame:
    """doc_id, root, sections and paragraphs (digests, in order), to locate where two versions differ."""
    text = F.coalesce(F.col("text"), F.lit(""))
    tree = docs.select("doc_id", root(text).alias("root"), paragraphs(text).alias("paragraphs"))
    return tree.withColumn("sections", sections(F.col("paragraphs")))


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Places (from 0) of the paragraphs of a, by digest, that b hasn't."""
    other = F.array_except(a, b)
    return F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: F.array_contains(other, F.get(a, i)))


def _place(doc_id: Column, text: Column) -> Column:
    """A row's place in document order, read backwards: null ids first, equal ids by the text's hash."""
    return F.struct(F.coalesce(doc_id, F.lit(-(1 << 63))).alias("k"), F.xxhash64(text).alias("h"))


def _block(place: Column, borders: list[tuple[int, int]]) -> Column:
    """Number of borders at or below a place, by two short looks instead of one long one."""
    if not borders:
        return F.lit(0)
    wide = math.isqrt(len(borders)) + 1
    rows = [borders[i : i + wide] for i in range(0, len(borders), wide)]
    of = lambda row: [{"k": k, "h": h} for k, h in row]
    kind = "array<struct<k:bigint,h:bigint>>"
    tops = F.from_json(F.lit(json.dumps(of(r[0] for r in rows))), kind)
    deep = F.from_json(F.lit(json.dumps([of(r) for r in rows])), f"array<{kind}>")
    row = lambda n: F.get(deep, n - 1)
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= place))
    return let(below(tops), lambda n: F.when(n == 0, 0).otherwise((n - 1) * wide + below(row(n))))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and block of every document, and last: the copy of the next block's first document.

    Documents lie in blocks of neighbouring places. A block also gets a copy of
    the document that follows its last one, so every neighbour is found within
    its block and texts move once. Borders are drawn from a sample of places,
    so that an id, or its want, that very many rows have is split by the texts'
    hashes; rows equal in both are one text, whose order doesn't matter. The
    borders steer only how even the blocks are.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    places = texts.select(_place(F.col("doc_id"), F.col("text")).alias("p"))
    blocks = max(1, min(MOST_BLOCKS, -(-(rows := docs.count()) // BLOCK_ROWS)))
    share = min(1.0, DRAWN * blocks / max(1, rows))
    drawn = sorted({(r.p.k, r.p.h) for r in places.sample(share, 7).distinct().collect()}) if blocks > 1 else []
    borders = [drawn[i * len(drawn) // blocks] for i in range(1, blocks)] if len(drawn) >= blocks else drawn[1:]
    firsts = places.groupBy(_block(F.col("p"), borders).alias("block")).agg(F.max("p").alias("p")).collect()  # a row for each block
    order = sorted(firsts, key=lambda r: -r["block"])
    follows = [(b["p"].k, b["p"].h, a["block"]) for a, b in zip(order, order[1:] + order[:1])]
    own = texts.withColumn("p", _place(F.col("doc_id"), F.col("text")))
    if not follows:
        return own.select("doc_id", "text", F.lit(0).alias("block"), F.lit(False).alias("last"))
    copies = F.broadcast(spark.createDataFrame(follows, "k long, h long, block int"))  # MOST_BLOCKS rows at most
    led = own.join(copies, (F.col("p.k") == F.col("k")) & (F.col("p.h") == F.col("h"))).groupBy("block", "doc_id").agg(F.first("text").alias("text"))
    own = own.select("doc_id", "text", _block(F.col("p"), borders).cast("int").alias("block"), F.lit(False).alias("last"))
    return own.unionByName(led.select("doc_id", "text", "block", F.lit(True).alias("last")))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Every document with its fingerprint, its edited text and that one's, and their likeness.

    The edited text has the last third of the code points replaced by the first
    as many of the next document in descending doc_id.
    """
    laid = with_next(docs).repartition("block")
    text = F.col("text")
    grown = laid.withColumns({"fingerprint": root(text), "leaves": leaves(text), "_h": F.xxhash64("text")})
    order = Window.partitionBy("block").orderBy("last", F.col("doc_id").desc_nulls_last(), F.col("_h").desc())
    nexts = {f"next_{c}": F.lead(c).over(order) for c in ("text", "fingerprint", "leaves")}
    found = grown.withColumns(nexts).filter(~F.col("last"))
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(text, F.lit(1), n - third), F.substring(F.col("next_text"), F.lit(1), third))
    found = found.select(
        "doc_id", n.cast("long").alias("n_chars"), "fingerprint", "leaves", edited.alias("edited_text"),
        likeness(F.col("fingerprint"), F.col("leaves"), F.col("next_fingerprint"), F.col("next_leaves")).alias("near_next"),
    )
    edited = F.col("edited_text")
    found = found.withColumns({"edited_fingerprint": root(edited), "_edited": leaves(edited)})
    near = likeness(F.col("fingerprint"), F.col("leaves"), F.col("edited_fingerprint"), F.col("_edited"))
    return found.withColumn("near_edited", near).drop("_edited", "leaves")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST) AS r, doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT d.*, length(t) // 3 AS third, coalesce(lead(t) OVER (ORDER BY r), first_value(t) OVER (ORDER BY r)) AS nt FROM d),
e AS (SELECT *, left(t, length(t) - third) || left(nt, third) AS et FROM n),
v AS (SELECT r, 0 AS kind, t AS x FROM e UNION ALL SELECT r, 1, et FROM e),
p AS (SELECT r, kind, x, list_transform(string_split(x, chr(10)), lambda y: sha256(y)) AS nodes FROM v),
m AS (SELECT *, list_filter(string_split(array_to_string(list_transform(nodes, lambda y: y ||
  CASE WHEN ('0x' || left(y, 2))::INT % {SECTION_MEAN} = 0 THEN ';' ELSE ',' END), ''), ';'), lambda y: y <> '') AS runs FROM p),
f AS (SELECT r, kind, sha256('root:' || array_to_string(list_transform(runs, lambda y: sha256('section:' || y)), ',')) AS root,
  list_distinct(regexp_extract_all(x, '{LEAF_PATTERN}')) AS leaves FROM m),
w AS (SELECT *, coalesce(list_sum(list_transform(leaves, lambda y: length(y))), 0) AS size FROM f),
j AS (SELECT a.r, a.root, b.root AS eroot, coalesce(lead(a.root) OVER o, first_value(a.root) OVER o) AS nroot,
  a.leaves, b.leaves AS eleaves, coalesce(lead(a.leaves) OVER o, first_value(a.leaves) OVER o) AS nleaves,
  a.size, b.size AS esize, coalesce(lead(a.size) OVER o, first_value(a.size) OVER o) AS nsize
  FROM w a JOIN w b ON a.r = b.r AND a.kind = 0 AND b.kind = 1 WINDOW o AS (ORDER BY a.r))
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(et) AS edited_sha256, root AS fingerprint, eroot AS edited_fingerprint,
  CASE WHEN root = eroot THEN 1.0 WHEN size + esize = 0 THEN 0.0
    ELSE 2.0::DOUBLE * coalesce(list_sum(list_transform(list_intersect(leaves, eleaves), lambda y: length(y))), 0) / (size + esize) END::DOUBLE AS near_edited,
  CASE WHEN root = nroot THEN 1.0 WHEN size + nsize = 0 THEN 0.0
    ELSE 2.0::DOUBLE * coalesce(list_sum(list_transform(list_intersect(leaves, nleaves), lambda y: length(y))), 0) / (size + nsize) END::DOUBLE AS near_next
FROM j JOIN e USING (r)
"""
