"""Near copies by the exact similarity of word shingles, on top of SimHash classes.

Two texts are near copies if the Jaccard similarity of their sets of five-word
shingles is 0.8 or more. Any two such sets share one of their first
n - ceil(0.8 n) + 1 shingles in any one order of all shingles, so texts that
share none of these need not be compared. The order puts shingles that are
frequent in a sample last and goes by hash otherwise; it steers the work, not
the result.

A shingle that several texts have among their first is a bucket. A group of
near copies shares hundreds of buckets, and its pairs grow with the square of
its size, so its pairs are not listed: first every text is compared with one
text only, the one that is the least of most of its buckets. The links found,
and SimHash's classes, join texts to groups; what lies within one group needs
no more comparing. Texts that hang together by heavy buckets are a family, and
a family is compared in blocks, two in a task. In the light buckets texts of
different groups are compared, each pair once, if their sizes, the first
shingles that they share and those shingles' places leave enough to share. So
no link between two groups is missed.

Texts are large, so sketches go first. A text's sketch has, for each of some
two to four times as many cells as it has shingles, whether an odd number of
its shingles fall there. Two sketches never differ in more cells than the sets
differ in shingles, so a pair whose sketches differ too much is ruled out
exactly; nearly all others have a similarity of 0.77 or more, and only their
texts move. A sketch is folded to compare it with a smaller one.

Texts with fewer words than a shingle are one shingle; texts without words are
copies of nothing, but for SimHash's classes. Shingles are compared by 64-bit
hashes. Null texts count as empty; rows with equal texts are one text; rows
without a doc_id, or with one that others have too, are told apart by their
texts. An empty table gives no rows; other columns are kept as they are.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import simhash
from tessera.llm.bpe import Memo
from tessera.llm.common import drop_table, map_texts, persist_table
from tessera.llm.simhash import connected_components, text_digest

SHINGLE, SEED = 5, 42
#: Least similarity, in tenths.
TENTHS = 8
#: Texts drawn to find frequent shingles, how often a frequent one is met there, and the most of them.
DRAWN, OFTEN, MOST = 4000, 4, 50_000
#: Rows of a table (of about 50 bytes each) up to which it is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 400_000
#: Texts of a block, and shingles compared at once, where a large family is compared in blocks.
BLOCK_TEXTS, COLUMNS = 256, 1 << 14
#: A bucket is heavy if it holds more texts than this and than the square root of all texts.
LEAST_HEAVY = 64
#: Least and most cells of a sketch, powers of two; the most bounds its bytes, not the result.
LEAST_CELLS, MOST_CELLS = 1 << 6, 1 << 17
#: Texts whose shingles a task remembers to have given, so that copies give them once.
SEEN = 200_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
FEATURES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("key", T.LongType()),
    T.StructField("print", T.LongType()), T.StructField("n", T.LongType()), T.StructField("first", T.ArrayType(T.LongType())),
    T.StructField("sketch", T.BinaryType()),
])
LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
PAIRS = T.StructType([T.StructField("ka", T.LongType()), T.StructField("kb", T.LongType())])
KEYS = T.StructType([T.StructField("key", T.LongType())])
SHINGLES = T.StructType([T.StructField("h", T.LongType()), T.StructField("n", T.LongType())])

_WORDS: list[Memo] = []


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    if not _WORDS:
        _WORDS.append(Memo(lambda w: xxhash.xxh64_intdigest(w, SEED), 24 << 20))
    found, words = [], []
    for words in simhash.word_blocks(text or "", SHINGLE):
        own = np.fromiter(map(_WORDS[0].__getitem__, words), dtype=np.uint64, count=len(words))
        n = len(own) - SHINGLE + 1
        if n > 0:
            h = np.zeros(n, dtype=np.uint64)
            for i in range(SHINGLE):
                h = (h ^ own[i : i + n]) * _MULTIPLIER
                h ^= h >> np.uint64(29)
            found.append(h)
    if not found:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], dtype=np.uint64)
    return np.unique(np.concatenate(found))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = sorted((len(a), len(b)))
    if not small or 10 * small < TENTHS * large:
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 10 * shared >= TENTHS * (small + large - shared)


def first_shingles(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The shingles that any near copy shares one of, in the common order."""
    n = len(found)
    late = frequent[np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)] == found if len(frequent) else np.zeros(n, bool)
    return np.concatenate([found[~late], found[late]])[: n - -(-TENTHS * n // 10) + 1 if n else 0]


def sketch(found: np.ndarray) -> bytes:
    """Which cells have an odd number of the shingles, as bits."""
    cells = min(MOST_CELLS, max(LEAST_CELLS, 1 << (2 * len(found) - 1).bit_length())) if len(found) else LEAST_CELLS
    odd = np.bincount((found & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def folded(own: bytes, size: int) -> np.ndarray:
    """A sketch's bytes as those of a sketch of size bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(own, np.uint8).reshape(-1, size), axis=0)


def may_be_near(differ, n):
    """Whether sets of n shingles together whose sketches differ in so many cells can be near copies."""
    return differ * (10 + TENTHS) <= n * (10 - TENTHS)


def differing(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, size) ^ folded(b, size)).sum(dtype=np.int64))


def possible(left: list[bytes], right: list[bytes], n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Which of left may be near copies of which of right, by sketches and counts of shingles."""
    out = np.zeros((len(left), len(right)), dtype=bool)
    long_left, long_right = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    for p in np.unique(long_left):
        for q in np.unique(long_right):
            i, j, size = np.flatnonzero(long_left == p), np.flatnonzero(long_right == q), min(p, q)
            n = n_left[i][:, None] + n_right[j][None, :]
            if 10 * min(n_left[i].max(), n_right[j].max()) < TENTHS * max(n_left[i].min(), n_right[j].min()):
                continue
            x, y = (np.stack([folded(side[k], size) for k in places]) for side, places in ((left, i), (right, j)))
            differ = np.zeros((len(i), len(j)), dtype=np.float32)
            for at in range(0, size, COLUMNS // 8):
                u, v = (np.unpackbits(z[:, at : at + COLUMNS // 8], axis=1).astype(np.float32) for z in (x, y))
                differ += u.sum(axis=1)[:, None] + v.sum(axis=1)[None, :] - 2 * (u @ v.T)
            out[np.ix_(i, j)] = may_be_near(differ.astype(np.int64), n)
    return out


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Hashes, sorted, of the shingles that a sample of the texts has often, MOST of them at most."""
    drawn = docs.select("text").sample(min(1.0, DRAWN / max(1, docs.count())), 7)

    def step():
        def work(batch: pa.RecordBatch):
            sets = [shingles(t) for t in batch["text"].to_pylist()]
            h, n = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=SHINGLES.names)

        return work

    counts = map_texts(drawn, SHINGLES, step).groupBy("h").agg(F.sum("n").alias("n"))
    rows = counts.filter(F.col("n") >= OFTEN).orderBy(F.desc("n"), "h").limit(MOST).collect()
    return np.sort(np.array([r.h for r in rows], dtype=np.int64).view(np.uint64))


def features(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """For every document its digest, a 64-bit key of its text, SimHash print, count of shingles, first shingles and sketch.

    Copies in one task give the first shingles and the sketch once.
    """

    def step():
        seen: set[bytes] = set()

        def work(batch: pa.RecordBatch):
            prints, sizes, firsts, sketches = [], [], [], []
            for digest, text in zip(batch["digest"].to_pylist(), batch["text"].to_pylist()):
                found = shingles(text)
                prints.append(simhash.simhash(text or ""))
                sizes.append(len(found))
                firsts.append(np.zeros(0, np.int64) if digest in seen else first_shingles(found, frequent).view(np.int64))
                sketches.append(None if digest in seen else sketch(found))
                if len(seen) < SEEN:
                    seen.add(digest)
            columns = [batch["doc_id"], batch["digest"].cast(pa.binary()), batch["key"], pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(firsts, pa.list_(pa.int64())), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=FEATURES.names)

        return work

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_digest(docs["text"]).alias("digest"), F.xxhash64(docs["text"]).alias("key"), docs["text"].alias("text"))
    return map_texts(own, FEATURES, step)


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """table, which must be a written one, to be broadcast if it has few rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of wanted (a written table with digest) with their texts, one for each digest, as a written table; only these texts move."""
    rest = [c for c in wanted.columns if c != "digest"]
    own = docs.select(text_digest(docs["text"]).alias("digest"), docs["text"].alias("text"))
    return persist_table(own.join(broadcast_if_small(wanted), "digest").dropDuplicates(["digest"]).select(*rest, "text"), "texts")


def sketches_of(marks: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of wanted (a written table with digest) with n and sketch, one for each digest, as a written table."""
    own = marks.filter("sketch IS NOT NULL").select("digest", "n", "sketch")
    return persist_table(own.join(broadcast_if_small(wanted), "digest").dropDuplicates(["digest"]), "sketches")


def with_both(pairs: DataFrame, table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """pairs (ka, kb) with columns of table, by its key, for a and for b; never broadcast: a few MB of a file can be many of texts."""
    of = lambda c: table.select(F.col("key").alias(f"k{c}"), *[F.col(x).alias(f"{y}{c}") for x, y in columns.items()]).hint("merge")
    return pairs.join(of("a"), "ka").join(of("b"), "kb")


def possible_pairs(marks: DataFrame, wanted: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of pairs (ka, kb) that may be near copies by their sketches, as a written table; wanted: (digest, key) of their texts."""
    sketches = sketches_of(marks, wanted.select("digest", "key"))

    def step():
        def work(batch: pa.RecordBatch):
            rows = zip(*(batch[c].to_pylist() for c in ("sa", "sb", "na", "nb")))
            kept = pa.array([may_be_near(differing(a, b), m + n) for a, b, m, n in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["ka"].filter(kept), batch["kb"].filter(kept)], names=PAIRS.names)

        return work

    left = persist_table(map_texts(with_both(pairs, sketches, {"n": "n", "sketch": "s"}), PAIRS, step).distinct(), "possible")
    drop_table(sketches)
    return left


def verified(docs: DataFrame, marks: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links (a, b) between groups, a < b, from the pairs of keys (ka, kb) whose texts are near copies.

    nodes: (key, digest, group) of every distinct text; only texts in pairs
    that their sketches allow move, each once for every pair. Texts that share
    a key are all compared.
    """

    def of_pairs(pairs: DataFrame) -> DataFrame:
        keys = pairs.select(F.explode(F.array("ka", "kb")).alias("key")).distinct()
        return persist_table(nodes.join(keys, "key").select("digest", "key", "group"), "wanted")

    met = persist_table(pairs, "pairs")
    first = of_pairs(met)
    pairs = possible_pairs(marks, first, met)
    for used in (met, first):
        drop_table(used)
    wanted = of_pairs(pairs)
    texts = texts_of(docs, wanted)
    met = with_both(pairs, texts, {"group": "g", "text": "t"}).filter("ga <> gb")

    def step():
        def work(batch: pa.RecordBatch):
            near = [similar(shingles(a), shingles(b)) for a, b in zip(batch["ta"].to_pylist(), batch["tb"].to_pylist())]
            kept = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["ga"].filter(kept), batch["gb"].filter(kept)], names=LINKS.names)

        return work

    links = map_texts(met.select("ga", "gb", "ta", "tb"), LINKS, step).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = persist_table(links.distinct(), "near-links")
    for used in (pairs, wanted, texts):
        drop_table(used)
    return found


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of left shares with each of right."""
    vocabulary = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    for at in range(0, len(vocabulary), COLUMNS):
        part = vocabulary[at : at + COLUMNS]

        def rows(sets: list[np.ndarray]) -> np.ndarray:
            filled = np.zeros((len(sets), len(part)), dtype=np.float32)
            for row, own in zip(filled, sets):
                place = np.minimum(np.searchsorted(own, part), max(0, len(own) - 1))
                row[:] = own[place] == part if len(own) else 0
            return filled

        out += rows(left) @ rows(right).T
    return out.astype(np.int64)


def joining(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """As many of the links (a, b) as join what they join."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in sorted(set(zip(a.tolist(), b.tolist()))):
        rx, ry = find(x), find(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((min(x, y), max(x, y)))
    return out


def in_blocks(rows: DataFrame, wanted: DataFrame, columns: list[str]) -> DataFrame:
    """Cells (family, i, j) of two blocks each, with the rows of both: columns, and own, the block that a row is in.

    rows: columns, key and family; wanted: a written table of the families' texts, by which a family's blocks are counted.
    """
    blocks = wanted.groupBy("family").agg(F.ceil(F.count("*") / BLOCK_TEXTS).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("key", F.lit("block")), F.col("blocks")).cast("int")
    dealt = rows.join(blocks, "family").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *columns)


def sides(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows of a cell's two blocks, which may be one."""
    own, i, j = cell["own"].to_numpy(), cell["i"][0].as_py(), cell["j"][0].as_py()
    left = np.flatnonzero(own == i)
    return left, left if i == j else np.flatnonzero(own != i)


def links_inside(docs: DataFrame, marks: DataFrame, placed: DataFrame) -> DataFrame:
    """Links (a, b) between roots inside each family, enough to join all that have near copies in each other.

    placed: (key, digest, family, root) of texts. A family's texts are dealt
    into blocks, and a task compares two blocks, so its work spreads however
    large it is. Sketches are compared first; only texts that may have a near
    copy under another root go on, and only links that join something leave
    the task.
    """
    sizes = placed.groupBy("family").agg(F.min("root").alias("least"), F.max("root").alias("_last")).filter("least <> _last")
    whole = persist_table(placed.join(sizes.select("family"), "family").select("digest", "key", "family", "root"), "families")
    sketches = sketches_of(marks, whole)

    def screen(cell: pa.Table) -> pa.Table:
        left, right = sides(cell)
        key, root, n, own = (cell["key"].to_numpy(), cell["root"].to_numpy(), cell["n"].to_numpy(), cell["sketch"].to_pylist())
        kept = np.zeros(len(key), dtype=bool)
        if len(left) and len(right):
            near = possible([own[k] for k in left], [own[k] for k in right], n[left], n[right]) & (root[left][:, None] != root[right][None, :])
            kept[left[near.any(axis=1)]] = True
            kept[right[near.any(axis=0)]] = True
        return pa.table({"key": pa.array(key[kept], pa.int64())})

    cells = in_blocks(sketches, whole, ["key", "root", "n", "sketch"])
    open_ = persist_table(cells.groupBy("family", "i", "j").applyInArrow(screen, KEYS).distinct(), "open-texts")
    wanted = persist_table(whole.join(open_, "key", "left_semi").select("digest", "key", "family", "root"), "open-families")
    for used in (whole, sketches, open_):
        drop_table(used)
    texts = texts_of(docs, wanted)

    def compare(cell: pa.Table) -> pa.Table:
        left, right = sides(cell)
        sets, root = [shingles(t) for t in cell["text"].to_pylist()], cell["root"].to_numpy()
        links: list[tuple[int, int]] = []
        if len(left) and len(right):
            shared = shared_counts([sets[k] for k in left], [sets[k] for k in right])
            n = np.array([len(s) for s in sets])
            near = (shared > 0) & (shared * (10 + TENTHS) >= TENTHS * (n[left][:, None] + n[right][None, :])) & (root[left][:, None] != root[right][None, :])
            x, y = np.nonzero(near)
            links = joining(root[left][x], root[right][y])
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    cells = in_blocks(texts, wanted, ["root", "text"])
    found = persist_table(cells.groupBy("family", "i", "j").applyInArrow(compare, LINKS).distinct(), "family-links")
    for used in (wanted, texts):
        drop_table(used)
    return found


def roots(links: DataFrame) -> DataFrame:
    """group and root of every group that is linked to another."""
    stars = persist_table(connected_components(links), "stars")
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "group")


def near_links(docs: DataFrame, marks: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links between groups of texts of docs: enough of them to join all groups that have near copies in each other.

    marks: a written table of features; nodes: a written table (key, digest, n, group) of the distinct texts.
    """
    place = F.shiftleft("n", 32).bitwiseOR(F.col("at").cast("long"))
    rows = marks.select("key", "n", F.posexplode("first").alias("at", "h")).select("h", "key", place.alias("place"))
    buckets = rows.groupBy("h").agg(F.min("key").alias("pivot"), F.max("key").alias("_last"), F.count("*").alias("held")).filter("pivot <> _last").drop("_last")
    heavy = F.col("held") > max(LEAST_HEAVY, math.isqrt(nodes.count()))
    members = persist_table(rows.hint("merge").join(buckets, "h").select("h", "key", "place", "pivot", heavy.alias("heavy")), "members")
    # One comparison for every text.
    one = members.filter("key <> pivot").groupBy("key", "pivot").agg(F.count("*").alias("_c"))
    one = one.groupBy("key").agg(F.max_by("pivot", F.struct("_c", F.bitwise_not("pivot"))).alias("pivot"))
    side = lambda c: nodes.select(F.col("key").alias(f"k{c}"), F.col("group").alias(f"g{c}"), F.col("n").alias(f"n{c}"))
    met = one.select(F.col("key").alias("ka"), F.col("pivot").alias("kb")).join(side("a"), "ka").join(side("b"), "kb")
    near_sizes = 10 * F.least("na", "nb") >= TENTHS * F.greatest("na", "nb")
    found = verified(docs, marks, nodes, met.filter((F.col("ga") != F.col("gb")) & near_sizes).select("ka", "kb").distinct())
    # Heavy buckets: families of texts that hang together by them, all against all in blocks.
    chained = members.filter("heavy AND key <> pivot").select(F.col("key").alias("a"), F.col("pivot").alias("b")).distinct()
    family = roots(chained).select(F.col("group").alias("key"), F.col("root").alias("family"))
    placed = nodes.join(roots(found), "group", "left").select("key", "digest", F.coalesce("root", "group").alias("root"))
    found = found.unionByName(links_inside(docs, marks, placed.join(family, "key")))
    # The other buckets: pairs of different groups.
    known = nodes.join(roots(found), "group", "left").select("key", F.coalesce("root", "group").alias("root")).distinct()
    weight = members.groupBy("key").agg(F.countDistinct(F.when(F.col("heavy"), F.col("h"))).alias("heavies"))
    placed = members.filter("NOT heavy").select("h", "key", "place").join(persist_table(known.join(weight, "key"), "roots"), "key")
    open_ = placed.groupBy("h").agg(F.min("root").alias("least"), F.max("root").alias("_last")).filter("least <> _last").drop("_last")
    left = persist_table(placed.hint("merge").join(open_, "h").distinct(), "open")
    side = lambda c: left.select("h", *[F.col(x).alias(f"{x}_{c}") for x in ("key", "place", "root", "least", "heavies")])
    size, at = (lambda c: F.shiftright(f"place_{c}", 32)), (lambda c: F.col(f"place_{c}").bitwiseAND(F.lit((1 << 32) - 1)))
    apart = (F.col("root_a") != F.col("root_b")) & ((F.col("root_b") == F.col("least_b")) | (F.col("key_a") < F.col("key_b")))
    near_sizes = 10 * F.least(size("a"), size("b")) >= TENTHS * F.greatest(size("a"), size("b"))
    met = side("a").filter("root_a <> least_a").hint("merge").join(side("b"), "h").filter(apart & near_sizes)
    first = F.col("key_a") < F.col("key_b")
    behind = lambda c: size(c) - 1 - at(c)
    pairs = met.select(
        F.least("key_a", "key_b").alias("ka"), F.greatest("key_a", "key_b").alias("kb"), (size("a") + size("b")).alias("both"), F.least("heavies_a", "heavies_b").alias("heavies"),
        F.when(first, behind("a")).otherwise(behind("b")).alias("behind_a"), F.when(first, behind("b")).otherwise(behind("a")).alias("behind_b"),
    )
    # What a pair can share: light first shingles met, heavy ones at most, and what lies behind the last one met.
    pairs = pairs.groupBy("ka", "kb", "both", "heavies").agg(F.count("*").alias("met"), F.min("behind_a").alias("behind_a"), F.min("behind_b").alias("behind_b"))
    most = F.col("met") + F.col("heavies") + F.least("behind_a", "behind_b")
    found = found.unionByName(verified(docs, marks, nodes, pairs.filter(most * (10 + TENTHS) >= F.col("both") * TENTHS).select("ka", "kb").distinct()))
    for used in (members, left):
        drop_table(used)
    return found


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of copies: SimHash components and near copies together.

    Of a group the first document stays, by doc_id (nulls last) and then by the
    digest of its text.
    """
    marks = persist_table(features(docs, frequent_shingles(docs)), "features")
    classes = simhash.components(marks.select("doc_id", "print"))
    group_of = classes.select("p", "group")
    nodes = marks.select("key", "digest", "n", "print").distinct().join(group_of, F.col("print") == F.col("p")).select("key", "digest", "n", "group")
    joined = roots(near_links(docs, marks, persist_table(nodes, "texts-of-groups")))
    final = group_of.join(joined, "group", "left").select("p", F.coalesce("root", "group").alias("group"))
    return simhash.keep_rows(docs, simhash.first_places(marks.select("doc_id", "digest", "print"), final))
