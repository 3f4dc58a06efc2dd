"""Shared plumbing: durable intermediate tables, Arrow batches, prefix sums."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Rows and bytes of whole documents in one Arrow batch; they bound a Python worker's memory.
ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only where the session names none and runs in one process (tests, a single
    machine) a temporary folder is made for the life of the process.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors of {master} share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, base.removeprefix("file://"), ignore_errors=True)
        spark.conf.set(CHECKPOINT_KEY, base)
    return base.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def persist_table(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.tessera_path = path
    return written


def drop_table(written: DataFrame | None) -> None:
    """Delete the files of a table that persist_table wrote, once nothing reads it any more."""
    if written is not None:
        context = written.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(written.tessera_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def bound_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Keep Arrow batches of whole texts small, by rows and by bytes; smaller settings of the session's own stay."""
    for what, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", ARROW_BYTES)):
        key = f"spark.sql.execution.arrow.{what}"
        now = spark.conf.get(key).rstrip("bB")
        if now.lstrip("-").isdigit() and not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that df doesn't have, whatever its letters' case."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_size(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Slices [i, j) of items with sizes of about limit in sum, one item at least."""
    i = total = 0
    for j, size in enumerate(sizes):
        if total and total + size > limit:
            yield i, j
            i, total = j, 0
        total += size
    if i < len(sizes):
        yield i, len(sizes)


def map_texts(
    df: DataFrame,
    schema: T.StructType,
    step: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]],
) -> DataFrame:
    """mapInArrow with state made once for each task: step() returns the function of a batch."""
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = step()
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return df.mapInArrow(run, schema)


def spread_prefix(df: DataFrame, order: str, value: str, out: str, width: int = 4096) -> DataFrame:
    """Exclusive running sum of value over unique integers order >= 0, in two levels.

    Blocks of width keys are summed first, so no window holds more than one
    block or one row for each block.
    """
    block = F.floor(F.col(order) / F.lit(width))
    totals = df.groupBy(block.alias("_b")).agg(F.sum(value).alias("_t"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("_b"), F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("_b", block).withColumn("_in", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return inner.join(totals, "_b").withColumn(out, F.col("_base") + F.col("_in")).drop("_b", "_in", "_base")


def base32_of_hex(hex_digest: Column) -> Column:
    """RFC 4648 base32 of a 160-bit hex digest: five hex digits are four base32 digits."""
    groups = [F.lpad(F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
