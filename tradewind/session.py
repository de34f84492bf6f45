"""Runtime settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot join key is split at run time even if that costs one more shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # shuffle files go when their action ends, not when the driver happens to collect the plan
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options the jobs rely on."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: the cluster's checkpoint folder, a local one in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not folder:
        folder = tempfile.mkdtemp(prefix="tradewind-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame that several jobs read, in reliable storage."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def send_package(spark: SparkSession) -> None:
    """Give Python workers on other machines this package, once per application."""
    context = spark.sparkContext
    if getattr(context, "_tradewind_sent", False):
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tradewind-code-")) / "tradewind-code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in package.rglob("*.py"):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tradewind_sent = True
