"""Sentences and reference clips: language codes, round-robin pairs, utterances."""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a run, the most runs, and values drawn for each cut between them.
RUN_ROWS, MOST_RUNS, DRAWN_FOR_A_CUT = 10_000, 4096, 20


def with_code(references: DataFrame, codes: DataFrame) -> DataFrame:
    """References with the code of their language's name; an unmapped name is its own code. codes: (code, name), a fixed table."""
    names = codes.groupBy("name").agg(F.min("code").alias("code"))
    return references.join(F.broadcast(names), references.lang == names.name, "left").withColumn("code", F.coalesce("code", "lang")).drop("name")


def in_places(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Adds _k, a row's place among its key's rows by order, from 0; no key's rows meet in one task.

    Rows are dealt into runs of about RUN_ROWS neighbours (more, if there would
    be over MOST_RUNS), cut at values drawn by their hashes, so the same rows
    give the same cuts. Rows are counted run by run and numbered within a run.
    """
    total = rows.count()
    n_cuts, cuts = min(MOST_RUNS, total // RUN_ROWS), []
    if n_cuts:
        drawn = F.pmod(F.xxhash64(key, order), F.lit(max(1, total // (n_cuts * DRAWN_FOR_A_CUT)))) == 0
        cuts = sorted((r[0], r[1]) for r in rows.filter(drawn & F.col(order).isNotNull()).select(key, order).collect())[::DRAWN_FOR_A_CUT]

    @F.pandas_udf("int")
    def run(keys: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(cuts, (k,) if v is None else (k, v)) for k, v in zip(keys, values)], dtype="int32")

    dealt = rows.withColumn("_run", run(key, order) if cuts else F.lit(0))
    sizes = dealt.groupBy(key, "_run").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select(key, "_run", F.coalesce(before, F.lit(0)).alias("_base"))  # a row for each run
    own = F.row_number().over(Window.partitionBy(key, "_run").orderBy(order)) - 1
    numbered = dealt.withColumn("_own", own).join(F.broadcast(bases), [key, "_run"])
    return numbered.withColumn("_k", F.col("_base") + F.col("_own")).drop("_run", "_base", "_own")


def round_robin(sentences: DataFrame, references: DataFrame, key: str = "language") -> DataFrame:
    """The k-th sentence of a language with reference k mod n, in order of their ids.

    sentences: (language, id, ...); references: (language, ref_id, ...), a few
    for each language, so they are broadcast. Only sentences of languages with
    references are paired.
    """
    counts = references.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    counts = sentences.sparkSession.createDataFrame(counts.collect(), counts.schema)  # a row for each language
    j = F.row_number().over(Window.partitionBy(key).orderBy("ref_id")) - 1
    placed = in_places(sentences.join(F.broadcast(counts.select(key)), key, "left_semi"), key, "id")
    dealt = placed.join(F.broadcast(counts), key).withColumn("_j", F.pmod("_k", "_n").cast("int")).drop("_k", "_n")
    return dealt.join(F.broadcast(references.withColumn("_j", j)), [key, "_j"]).drop("_j")


def utterances(pairs: DataFrame) -> DataFrame:
    """One row for each pair, keyed by the sentence's id."""
    return pairs.select(
        F.col("id").alias("utt_id"), F.concat(F.lit("audio/"), "id", F.lit(".wav")).alias("audio_filepath"), "text", "speaker_id", "gender", "language", "ref_id",
        F.coalesce("ref_audio_path", F.lit("")).alias("ref_audio_path"), F.lit("synthesized").alias("status"),
    )
