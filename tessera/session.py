"""A session with the settings that the library counts on."""

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "tessera", **more: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=SETTINGS | more).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once, unless their Python finds it by itself."""
    context, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if os.path.realpath(root) in known or getattr(context, "_tessera_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tessera-package-"), "tessera.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "tessera")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)  # Spark's file server hands it out
    context._tessera_shipped = True
