"""Manifests as JSON lines with fixed schemas, and one-document summaries."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read(spark: SparkSession, path: str, schema: T.StructType, tolerant: bool = False) -> DataFrame:
    """Rows of a manifest; none if it isn't there.

    A malformed line is an error; a tolerant reader drops it. Blank lines are skipped.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    if not tolerant:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    parsed = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    rows = lines.select(F.from_json("value", parsed, {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    return rows.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def write(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_document(spark: SparkSession, path: str, text: str) -> None:
    """One small text file, in any store that Spark writes to."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target, True)
    out.write(text.encode())
    out.close()


def read_summary(spark: SparkSession, path: str) -> dict | None:
    """A summary document; null if it isn't there or isn't JSON."""
    if not exists(spark, path):
        return None
    try:
        return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))  # one small document
    except ValueError:
        return None


def summary(one_row: DataFrame) -> dict:
    """A one-row result as a document."""
    return json.loads(one_row.toJSON().first() or "{}")
