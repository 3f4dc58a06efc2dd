"""The voice bank's catalogue: projected scans with lineage, and late reading of audio."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.sampling import canonical_gender

log = logging.getLogger("tessera")
#: Records (a path and a number each) up to which their places are broadcast.
PLACES = 500_000
META = ["fname", "text", "duration", "gender", "speaker_id"]


def files_of(source: str, base: str, lang: str, split: str) -> str:
    if source not in ("hf", "local"):
        raise ValueError(f"unknown source {source!r}: hf or local")
    return f"{base}/{lang}/{split}-*.parquet"


def scan(spark: SparkSession, source: str, base: str, languages: list[str], split: str = "valid") -> DataFrame:
    """Metadata of every clip, with its file and row; audio columns aren't read. A language without files is warned of and left out."""
    parts = []
    for lang in languages:
        try:
            rows = spark.read.parquet(files_of(source, base, lang, split))
        except Exception as e:  # a language without files is left out
            if "PATH_NOT_FOUND" not in str(e):
                raise
            log.warning("no files for language %s under %s", lang, base)
            continue
        parts.append(rows.select(*META, F.lit(lang).alias("lang"), F.col("_metadata.row_index").alias("row_index"), F.col("_metadata.file_path").alias("source_file")))
    if not parts:
        raise ValueError("no files for any language")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("gender", canonical_gender(F.col("gender")))


def cached(spark: SparkSession, path: str, build, force: bool = False) -> DataFrame:
    """A table at path, built first if it isn't there or if forced."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    if force or not target.getFileSystem(conf).exists(target):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def sniff(content: Column, path: Column) -> Column:
    """A clip's extension: that of its path, else by its first bytes, else .bin."""
    suffix = F.lower(F.regexp_extract(F.coalesce(path, F.lit("")), r"(\.[A-Za-z0-9]+)$", 1))
    head = lambda at, text: F.substring(content, at, len(text)) == F.lit(text.encode("latin-1"))
    return (
        F.when(suffix != "", suffix)
        .when(head(1, "RIFF") & head(9, "WAVE"), ".wav").when(head(5, "ftyp"), ".m4a").when(head(1, "ID3") | head(1, "\xff\xfb"), ".mp3")
        .when(head(1, "OggS"), ".ogg").when(head(1, "fLaC"), ".flac").otherwise(".bin")
    )


def pull_audio(spark: SparkSession, selection: DataFrame) -> DataFrame:
    """Selected records with the bytes of their clip, its format and a status.

    Only files that the records name are listed, and only the audio column is
    read. The places of the records, few next to the bank, are sent to the scan
    if their count allows, so that no audio but theirs is moved; then they meet
    their records. Beyond PLACES records the audio is joined by a shuffle.
    """
    files = [r.source_file for r in selection.select("source_file").distinct().collect()]  # one entry for each selected file
    if not files:
        return selection.withColumns({"content": F.lit(None).cast("binary"), "ext": F.lit(None).cast("string")}).limit(0)
    banks = spark.read.parquet(*files)
    cell = dict(banks.dtypes)["audio_filepath"]
    content, path = (F.col("audio_filepath"), F.lit("")) if cell == "binary" else (F.col("audio_filepath.bytes"), F.col("audio_filepath.path"))
    audio = banks.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("row_index"), content.alias("content"), path.alias("_path"))
    places = selection.select("source_file", "row_index").distinct()
    hits = audio.join(F.broadcast(places) if places.count() <= PLACES else places, ["source_file", "row_index"])
    joined = selection.drop("status").join(hits, ["source_file", "row_index"], "left")
    good = F.octet_length("content") > 0
    return joined.withColumns({
        "ext": sniff(F.col("content"), F.col("_path")),
        "status": F.when(good, "downloaded").otherwise("failed"), "error": F.when(~F.coalesce(good, F.lit(False)), "no audio bytes"),
    }).drop("_path")


def in_order(rows: DataFrame) -> DataFrame:
    """Catalogue order: by language, file and row."""
    return rows.orderBy("lang", "source_file", "row_index")


def row_group_starts(groups: DataFrame) -> DataFrame:
    """First row of each row group (source_file, row_group, n_rows): a running sum within each file."""
    from pyspark.sql.window import Window

    before = Window.partitionBy("source_file").orderBy("row_group").rowsBetween(Window.unboundedPreceding, -1)
    return groups.withColumn("start", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))


def row_groups_touched(selection: DataFrame, groups: DataFrame) -> DataFrame:
    """Row groups that hold selected rows, with the rows wanted from each: groups (source_file, row_group, n_rows, n_bytes)."""
    laid = row_group_starts(groups)
    met = selection.select("source_file", "row_index").join(laid, "source_file").filter("row_index >= start AND row_index < start + n_rows")
    return met.groupBy("source_file", "row_group").agg(F.count("*").alias("rows_wanted"), F.first("n_bytes").alias("n_bytes"))
