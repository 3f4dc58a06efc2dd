"""Checks as an array of structs, verdicts over them, and their flat forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numbers import rounded

CHECKS = "array<struct<name: string, passed: boolean, metric: double, detail: string>>"
# Names of the checks, in the order in which they are reported.
CHECK_NAMES = ["silence", "clipping", "truncation", "dur_per_char", "looping_audio", "cer", "looping_text", "speaker_cos"]


def check(name: str, passed: Column, metric: Column, detail: Column | None = None) -> Column:
    return F.struct(F.lit(name).alias("name"), passed.alias("passed"), metric.cast("double").alias("metric"), (F.lit(None).cast("string") if detail is None else detail).alias("detail"))


def with_verdict(rows: DataFrame, *checks: Column) -> DataFrame:
    """Adds qc_checks, qc_reasons (failed ones, with detail) and qc_passed; a check that is null was skipped."""
    out = rows.withColumn("qc_checks", F.array_compact(F.array(*checks)))
    failed = F.filter("qc_checks", lambda c: ~c["passed"])
    reason = lambda c: F.concat(c["name"], F.coalesce(F.concat(F.lit("("), c["detail"], F.lit(")")), F.lit("")))
    return out.withColumns({"qc_reasons": F.transform(failed, reason), "qc_passed": F.size(failed) == 0})


def metric(name: str) -> Column:
    """The metric of the first check of a name, or null."""
    return F.get(F.filter("qc_checks", lambda c: c["name"] == name), F.lit(0))["metric"]


def flattened(rows: DataFrame, key: str, names: list[str] = CHECK_NAMES) -> DataFrame:
    """One column for each check's outcome and metric; no shuffle, since names are known."""
    first = lambda n: F.get(F.filter("qc_checks", lambda c: c["name"] == n), F.lit(0))
    cols = [c for n in names for c in (first(n)["passed"].alias(f"{n}_pass"), rounded(first(n)["metric"], 4).alias(f"{n}_metric"))]
    return rows.select(key, "qc_passed", F.array_join("qc_reasons", ";").alias("reasons"), *cols)


def reason_name(reason: Column) -> Column:
    return F.substring_index(reason, "(", 1)


def violations(rules: dict[str, Column]) -> Column:
    """Names of all the rules that a row breaks; a rule that is null isn't broken."""
    return F.array_compact(F.array(*[F.when(~rule, name) for name, rule in rules.items()]))
