"""Exact and near-duplicate removal, quotas and the order-dependent accept loop."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.functions.numbers import rounded

#: Vectors of a slice, and pairs of which a task holds the products at once.
SLICE_ROWS, PAIRS_AT_ONCE = 1 << 14, 1 << 21


def first_of_each(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, in order, by a partial aggregate: no key's rows meet in one task."""
    first = F.min_by(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(first.alias("_row")).select("_row.*")


def near_pairs(vectors: DataFrame, threshold: float, block: str, id_col: str = "vec_id", vector: str = "embedding", slices: int = 8) -> DataFrame:
    """Pairs of vectors of one block with a dot product, which for unit vectors is the cosine, of at least threshold, exactly.

    Every pair is compared, so the work grows with the square of a block. A
    block's rows are dealt into slices, as many as keep one below SLICE_ROWS
    and `slices` at least, and a task compares two slices: its memory is
    bounded however large a block is. Matrix products rule out pairs that are
    clearly below; what is left is summed up in the order of the dimensions.
    Rows without an id, a block or a number in some place are in no pair.
    """
    own = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("v"), F.col(block).alias("_b"), F.size(vector).alias("_d"))
    own = own.filter(F.col("id").isNotNull() & F.col("_b").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    largest = vectors.groupBy(F.col(block)).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    n = max(slices, -(-largest // SLICE_ROWS))
    dealt = own.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn("_o", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    cells = dealt.select("id", F.col("v").cast("array<double>").alias("v"), "_b", "_d", "own", F.least("own", "_o").alias("i"), F.greatest("own", "_o").alias("j"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = pa.Table.from_batches(list(batches))
        ids, tag, i, j = cell["id"].to_numpy(), cell["own"].to_numpy(), cell["i"][0].as_py(), cell["j"][0].as_py()
        values = pa.concat_arrays([c.flatten() for c in cell["v"].chunks]).to_numpy().reshape(len(ids), cell["_d"][0].as_py())
        left = np.flatnonzero(tag == i)
        right = left if i == j else np.flatnonzero(tag != i)
        if not len(left) or not len(right):
            return
        columns, others = np.ascontiguousarray(values.T), values[right].T
        norms = np.sqrt((values**2).sum(axis=1))
        slack = 4 * (values.shape[1] + 1) * np.finfo(float).eps * norms[left].max() * norms[right].max()
        step = max(1, PAIRS_AT_ONCE // len(right))
        for part in np.split(left, range(step, len(left), step)):
            open_ = ~(values[part] @ others < threshold - slack)
            if i == j:
                open_ &= part[:, None] < right[None, :]
            x, y = np.nonzero(open_)
            x, y = part[x], right[y]
            found = np.zeros(len(x))
            for column in columns:
                found += column[x] * column[y]
            near = ~(found < threshold) & (ids[x] != ids[y])
            a, b, found = ids[x[near]], ids[y[near]], found[near]
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(np.where(a < b, a, b), cell.schema.field("id").type), pa.array(np.where(a < b, b, a), cell.schema.field("id").type), pa.array(found)], names=["a", "b", "similarity"])

    kind = vectors.schema[id_col].dataType
    pairs = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("similarity", T.DoubleType())])
    return cells.groupBy("_b", "_d", "i", "j").applyInArrow(compare, pairs)


def within_quota(rows: DataFrame, cell: list[str], order: list[str], quota: int) -> DataFrame:
    """The first rows of each cell; Spark keeps quota rows of a cell for each task before it shuffles."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*cell).orderBy(*order))).filter(F.col("_r") <= quota).drop("_r")


def grid(*sides: DataFrame) -> DataFrame:
    """Every combination of small dimension tables."""
    out, *rest = sides
    for side in rest:
        out = out.crossJoin(F.broadcast(side))
    return out


SOUND_SCHEMA = "language string, cell string, key string, vector array<float>, seq long"
ACCEPTED_SCHEMA = "seq long, language string, cell string, key string, nth int"
#: Rows of a cell that are tried at first, for each one that it takes.
FIRST = 8
#: The place of what an earlier run accepted.
BEFORE = -(1 << 62)


class Pool:
    """What a language has accepted: keys, counts by cell, and vectors in one growing array."""

    def __init__(self):
        self.keys, self.filled, self.n, self.vectors = set(), {}, 0, np.zeros((0, 0), dtype=np.float32)

    def near(self, v: np.ndarray, threshold: float) -> bool:
        return self.n > 0 and float((self.vectors[: self.n] @ v).max()) >= threshold

    def add(self, key: str, cell: str, v: np.ndarray | None) -> None:
        self.keys.add(key)
        self.filled[cell] = self.filled.get(cell, 0) + 1
        if v is not None:
            if self.n == len(self.vectors):
                grown = np.zeros((max(64, 2 * self.n), len(v)), dtype=np.float32)
                grown[: self.n] = self.vectors[: self.n] if self.n else 0
                self.vectors = grown
            self.vectors[self.n] = v
            self.n += 1


def sound_of(fault: str) -> Column:
    return F.coalesce(fault, F.lit("")) == ""


def sound_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pc.equal(pc.fill_null(batch["fault"], ""), "")).drop_columns(["fault"])


def accept_in_order(candidates: DataFrame, quota: int, threshold: float, earlier: DataFrame | None = None) -> DataFrame:
    """Fold candidates (seq, language, cell, key, fault, vector) in order of seq within each language.

    A candidate whose cell is full is not looked at and gets no outcome. Others
    get their fault, exact_duplicate, near_duplicate or accepted; accepted ones
    count in their cell and stand in the way of later ones. earlier: what an
    earlier run accepted (language, cell, key, vector); it counts as if it had
    come first and gets no outcome.

    The order decides, so a language's candidates stream through one task. Only
    those go there that can change what it has accepted: of a cell, the first
    rows without a fault, each kind of (key, vector) once, since its repeats
    find the first accepted or as near as before. FIRST times quota rows of a
    cell are tried; cells that these don't fill get more. So what a task reads
    depends on cells and quota; only a cell that most rows repeat or come near
    needs more. All other outcomes follow from the places of accepted rows, by
    joins. seq is unique in its language; candidates are read several times, so
    they must come out the same each time.
    """
    if quota < 1:
        return candidates.limit(0).select("seq", "language", "cell", F.col("fault").alias("outcome"))
    # Taken out here, not by a filter: under a filter Spark left the models of a projection with two kinds of them in the plan, where they can't run.
    sound = candidates.select("language", "cell", "key", "vector", "seq", "fault").mapInArrow(sound_rows, SOUND_SCHEMA)
    kinds = sound.groupBy("language", "cell", "key", "vector").agg(F.min("seq").alias("seq"))
    ranked = kinds.withColumn("place", F.row_number().over(Window.partitionBy("language", "cell").orderBy("seq")))
    held = None
    if earlier is not None:
        held = earlier.select("language", "cell", "key", "vector", F.lit(BEFORE).cast("long").alias("seq"), F.lit(0).alias("place"))
    columns, most = ["seq", "language", "cell", "key", "vector", "place"], FIRST * quota

    def accepted_of(most: int) -> list[Row]:
        """What is accepted if `most` rows of a cell are tried, and for cells that these don't fill a row with nth 0 if there are more."""

        def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            language, pool = None, Pool()
            for batch in batches:
                out = []
                for seq, own, cell, key, vector, place in zip(*(batch[c].tolist() for c in columns)):
                    if own != language:
                        language, pool = own, Pool()
                    if place and pool.filled.get(cell, 0) >= quota:
                        continue
                    if place > most:
                        out.append((int(seq), language, cell, key, 0))
                        continue
                    v = None if vector is None else np.asarray(vector, dtype=np.float32)
                    if place and (key in pool.keys or v is not None and pool.near(v, threshold)):
                        continue
                    pool.add(key, cell, v)
                    out.append((int(seq), language, cell, key, pool.filled[cell]))
                yield pd.DataFrame(out, columns=["seq", "language", "cell", "key", "nth"])

        rows = ranked.filter(F.col("place") <= most + 1).select(*columns)
        rows = rows if held is None else rows.unionByName(held)
        laid = rows.repartition("language").sortWithinPartitions("language", F.col("place") > 0, "seq")
        return laid.mapInPandas(fold, ACCEPTED_SCHEMA).collect()  # cells times quota, and what was there earlier

    accepted = accepted_of(most)
    while not all(r.nth for r in accepted):
        most *= 8
        accepted = accepted_of(most)
    table = candidates.sparkSession.createDataFrame(accepted, ACCEPTED_SCHEMA)
    ends = table.filter(F.col("nth") >= quota).groupBy("language", "cell").agg(F.min("seq").alias("_end"))
    firsts = table.groupBy("language", "key").agg(F.min("seq").alias("_first"))
    own = candidates.select("seq", "language", "cell", "key", "fault").alias("c")
    same = lambda side, *on: [F.col(f"c.{x}").eqNullSafe(F.col(f"{side}.{x}")) for x in on]
    own = own.join(F.broadcast(ends).alias("e"), reduce(and_, same("e", "language", "cell")), "left").filter("e._end IS NULL OR c.seq <= e._end")
    own = own.join(F.broadcast(firsts).alias("f"), reduce(and_, same("f", "language", "key")), "left")
    outcome = (
        F.when(~sound_of("c.fault"), F.col("c.fault")).when(F.col("c.seq") == F.col("f._first"), "accepted")
        .when(F.col("f._first") < F.col("c.seq"), "exact_duplicate").otherwise("near_duplicate")
    )
    return own.select("c.seq", "c.language", "c.cell", outcome.alias("outcome"))


def outcome_counts(outcomes: DataFrame, by: str = "outcome") -> DataFrame:
    return outcomes.groupBy(by).agg(F.count("*").alias("n"))


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """A rounded ratio; null where there is nothing to divide by."""
    return rounded(F.try_divide(part.cast("double"), whole.cast("double")), digits)
