"""Report tables over manifests. Every number comes from the manifests themselves, so a resumed run reports all of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.numbers import rounded
from tessera.operators.dedup import share
from tessera.operators.verdict import reason_name


def datacard(rows: DataFrame) -> DataFrame:
    passed = F.col("qc_passed")
    return rows.agg(
        F.count("*").alias("checked"), F.count_if(passed).alias("passed"), share(F.count_if(passed), F.count("*")).alias("pass_rate"),
        F.countDistinct("language").alias("languages"), F.countDistinct("language", "speaker_id").alias("speakers"),
        rounded(F.sum(F.when(passed, F.col("duration"))), 2).alias("valid_seconds"), rounded(F.sum(F.when(passed, F.col("duration"))) / 3600, 4).alias("valid_hours"),
    )


def speaker_gender(rows: DataFrame, order: str) -> DataFrame:
    """One gender for each speaker: that of the first row, everywhere."""
    return rows.groupBy("language", "speaker_id").agg(F.min_by("gender", order).alias("gender"))


def per_language(rows: DataFrame, order: str) -> DataFrame:
    speakers = rows.groupBy("language", "speaker_id").agg(
        F.count_if("qc_passed").alias("valid"), F.count("*").alias("total"), F.min_by("gender", order).alias("gender")
    )
    return speakers.groupBy("language").agg(
        F.sum("valid").alias("valid"), F.sum("total").alias("total"), F.count("*").alias("speakers"),
        F.count_if(F.col("gender") == "male").alias("male_speakers"), F.count_if(F.col("gender") == "female").alias("female_speakers"),
    )


def per_speaker(rows: DataFrame) -> DataFrame:
    """Totals for each (language, speaker, gender); valid rows count over all genders of the speaker."""
    by = rows.groupBy("language", "speaker_id", "gender").agg(F.count("*").alias("total"), F.count_if("qc_passed").alias("_valid"))
    return by.withColumn("valid", F.sum("_valid").over(Window.partitionBy("language", "speaker_id"))).drop("_valid")


def gender_balance(rows: DataFrame, order: str) -> DataFrame:
    utterances = rows.groupBy("gender").agg(F.count("*").alias("utterances"))
    speakers = speaker_gender(rows, order).groupBy("gender").agg(F.count("*").alias("speakers"))
    return utterances.join(speakers, "gender", "left").select("gender", "utterances", F.coalesce("speakers", F.lit(0)).alias("speakers"))


def summaries(rows: DataFrame, metrics: list[str], digits: int = 4) -> DataFrame:
    """min, avg and max of each metric, in one pass over the rows, as long form; metrics without values are left out."""
    mean = lambda m: F.try_divide(F.sum(m).cast("double"), F.count(m))  # noqa: E731  sums of whole numbers and decimals are exact
    aggregates = [f(m).cast("double").alias(f"{n}_{m}") for m in metrics for n, f in (("min", F.min), ("avg", mean), ("max", F.max))]
    wide = rows.select(*metrics).agg(*aggregates)
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), *[rounded(f"{n}_{m}", digits).alias(f"{n}_value") for n in ("min", "avg", "max")]) for m in metrics])
    return wide.select(F.inline(cells)).filter("min_value IS NOT NULL")


def rejections(rows: DataFrame) -> DataFrame:
    """Failed checks of failed rows: count, and percent of failed rows; a row may fail several."""
    failed = rows.filter(~F.col("qc_passed"))
    by = failed.select(F.explode("qc_reasons").alias("r")).groupBy(reason_name(F.col("r")).alias("failed_check")).agg(F.count("*").alias("utterances"))
    total = failed.agg(F.count("*").alias("failed"))
    return by.crossJoin(total).select("failed_check", "utterances", rounded(100 * F.col("utterances") / F.col("failed"), 2).alias("pct"))


def check_metrics(rows: DataFrame) -> DataFrame:
    c = rows.select(F.explode("qc_checks").alias("c"))
    by = c.groupBy(F.col("c.name").alias("check_name")).agg(
        F.min("c.metric").alias("lo"), F.avg("c.metric").alias("mid"), F.max("c.metric").alias("hi"), F.count_if(~F.col("c.passed")).alias("n_failed")
    )
    return by.filter("lo IS NOT NULL").select("check_name", *[rounded(x, 4).alias(f"{n}_value") for x, n in (("lo", "min"), ("mid", "avg"), ("hi", "max"))], "n_failed")


def reason_table(reasons: DataFrame) -> DataFrame:
    """Rejections by reason with their share of all rejections, the most frequent first."""
    by = reasons.groupBy("reason").agg(F.count("*").alias("n"))
    total = by.agg(F.sum("n").alias("total"))
    return by.crossJoin(total).select("reason", "n", rounded(100 * F.col("n") / F.col("total"), 2).alias("pct")).orderBy(F.col("n").desc(), "reason")


def stage_rates(stages: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Rows in and passed for each stage, one below the other."""
    parts = [
        rows.agg(F.count("*").alias("seen"), F.count_if(good).alias("passed")).select(F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), "seen", "passed")
        for i, (name, (rows, good)) in enumerate(stages.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("stage_no", "stage", "passed", (F.col("seen") - F.col("passed")).alias("failed"), share(F.col("passed"), F.col("seen")).alias("pass_rate"))


def throughput(stages: DataFrame) -> DataFrame:
    """Stages (stage, elapsed_s, load_s, items) with rates, and their total under the name `total`."""
    by = stages.rollup("stage").agg(F.sum("elapsed_s").alias("elapsed_s"), F.sum("load_s").alias("load_s"), F.sum("items").alias("items"), F.grouping("stage").alias("_all"))
    minutes = F.greatest(F.col("elapsed_s"), F.lit(1e-9)) / 60
    return by.select(
        F.when(F.col("_all") == 1, "total").otherwise(F.col("stage")).alias("stage"), rounded("elapsed_s", 2).alias("elapsed_s"), rounded(F.col("elapsed_s") - F.col("load_s"), 2).alias("process_s"),
        rounded(F.col("elapsed_s") / 3600, 4).alias("hours"), "items", rounded(F.col("items") / minutes, 3).alias("items_per_min"), share(F.col("load_s"), F.col("elapsed_s")).alias("load_share"),
    )


def value_counts(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Counts of each value of each field, in one pass; missing fields are left out, nulls count under 'null'."""
    there = [f for f in fields if f in rows.columns]
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("null")).alias("value")) for f in there])
    return rows.select(F.inline(pairs)).groupBy("field", "value").agg(F.count("*").alias("n"))


def status_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    """A table of counts by status."""
    return rows.groupBy(F.col(status).alias("status")).agg(F.count("*").alias("n"))


def one_document(table: DataFrame) -> DataFrame:
    """A small result table as one row: a table of counts as its map, a one-row table as it is."""
    return as_map(table, "status") if table.columns == ["status", "n"] else table


def keys_found(rows: DataFrame, document: str) -> DataFrame:
    """Every key of a column of JSON objects, with the rows that have it."""
    return rows.select(F.explode(F.json_object_keys(document)).alias("key")).groupBy("key").agg(F.count("*").alias("n"))


def as_map(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """A small table of counts as one map."""
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), F.col(n))))).alias("counts"))


def fields_report(rows: DataFrame, documented: list[str]) -> tuple[list[str], list[str]]:
    """Documented fields that are absent and fields beyond the documented."""
    return [f for f in documented if f not in rows.columns], [c for c in rows.columns if c not in documented]


def sample_rows(rows: DataFrame, n: int, hidden: list[str], most: int = 400) -> DataFrame:
    """The first rows as JSON, without noisy fields, cut to `most` characters: a look at the data."""
    shown = [c for c in rows.columns if c not in hidden]
    return rows.limit(n).select(F.substring(F.to_json(F.struct(*shown)), 1, most).alias("row"))


def markdown(table: DataFrame) -> str:
    """A small result table as Markdown."""
    rows = [[("n/a" if v is None else str(v)) for v in r] for r in table.collect()]
    return "\n".join("| " + " | ".join(r) + " |" for r in [table.columns, ["---"] * len(table.columns), *rows])
