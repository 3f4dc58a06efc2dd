"""Seeded stratified samples: ranks by a hash key take the place of a random generator's draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import draw, strip


def canonical_gender(raw: Column) -> Column:
    g = F.lower(strip(raw))
    return F.when(g.isin("m", "male"), "male").when(g.isin("f", "female"), "female").when(F.coalesce(g, F.lit("")) == "", "unknown").otherwise(g)


def eligible(clips: DataFrame, least: float = 3.0, most: float = 15.0) -> DataFrame:
    """Clips of a usable length with a text that isn't blank; a null text isn't usable."""
    return clips.filter(F.col("duration").between(least, most) & (F.length(strip(F.col("text"))) > 0))


def speaker_gender(clips: DataFrame) -> DataFrame:
    """The gender on a speaker's first clip, in catalogue order, that has one."""
    first = F.min_by("gender", F.struct("source_file", "row_index"))
    return clips.filter(F.col("gender").isNotNull()).groupBy("lang", "speaker_id").agg(first.alias("gender"))


def stratified_speakers(speakers: DataFrame, per_language: int, seed: int, balance: bool = True) -> DataFrame:
    """Speakers (lang, speaker_id, gender) drawn for each language.

    Half of them are men, who get the odd one, and half women; where a group is
    too small, the rest comes from all speakers not yet drawn. Unbalanced draws
    ignore gender.
    """
    key = draw(seed, F.col("lang"), F.col("speaker_id"))
    keyed = speakers.withColumn("_key", key)
    by = lambda *cols: Window.partitionBy(*cols).orderBy("_key", "speaker_id")
    if not balance:
        return keyed.withColumn("_r", F.row_number().over(by("lang"))).filter(F.col("_r") <= per_language).drop("_key", "_r")
    women = per_language // 2
    quota = F.when(F.col("gender") == "male", per_language - women).when(F.col("gender") == "female", women).otherwise(0)
    ranked = keyed.withColumn("_first", F.row_number().over(by("lang", "gender")) <= quota)
    order = Window.partitionBy("lang").orderBy(F.col("_first").desc(), "_key", "speaker_id")
    return ranked.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= per_language).drop("_key", "_first", "_r")


def clip_sample(clips: DataFrame, per_speaker: int, seed: int) -> DataFrame:
    key = draw(seed, F.col("lang"), F.col("speaker_id"), F.col("source_file"), F.col("row_index"))
    order = Window.partitionBy("lang", "speaker_id").orderBy(key, "source_file", "row_index")
    return clips.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= per_speaker).drop("_r")


def select_clips(clips: DataFrame, per_language: int, per_speaker: int, seed: int, balance: bool = True, least: float = 3.0, most: float = 15.0) -> DataFrame:
    """Eligible clips of the drawn speakers; the speakers' side is small by its quota, and AQE sees its size."""
    good = eligible(clips, least, most)
    chosen = stratified_speakers(speaker_gender(good), per_language, seed, balance)
    return clip_sample(good.drop("gender").join(chosen, ["lang", "speaker_id"]), per_speaker, seed)


def selection_manifest(selected: DataFrame, repo: str, split: str) -> DataFrame:
    """One record for each selected clip; the key holds the file, since row numbers start anew in each."""
    file_tag = F.substring(F.sha2("source_file", 256), 1, 8)
    return selected.select(
        F.concat(F.col("lang"), F.lit("_spk"), F.col("speaker_id").cast("string"), F.lit("_"), file_tag, F.lit("_"), F.col("row_index").cast("string")).alias("ref_id"),
        "lang", "speaker_id", "gender", F.lit(repo).alias("source_repo"), F.lit(split).alias("source_split"), "source_file", "row_index", "fname",
        F.coalesce("text", F.lit("")).alias("ref_text"), "duration", F.lit(None).cast("string").alias("local_audio_path"), F.lit("selected").alias("status"),
    )


def selection_summary(selection: DataFrame, available: DataFrame) -> DataFrame:
    """For each language: clips and speakers chosen, by gender, and speakers available."""
    speakers = lambda g: F.countDistinct(F.when(F.col("gender") == g, F.col("speaker_id")))
    chosen = selection.groupBy("lang").agg(
        F.count("*").alias("clips"), F.countDistinct("speaker_id").alias("chosen"), speakers("male").alias("male"), speakers("female").alias("female")
    )
    return chosen.join(available.groupBy("lang").agg(F.countDistinct("speaker_id").alias("available")), "lang")
