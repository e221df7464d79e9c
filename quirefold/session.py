"""Session helpers: table reading, checkpoint folder, size-checked broadcast."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a dimension table may be broadcast by ``bounded_broadcast``.
BROADCAST_ROWS = 50_000


def build_session(app: str = "quirefold", cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("QUIREFOLD_DRIVER_MEMORY", "6g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python once per context, so that workers can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_quirefold_shipped", False):
        return
    root = Path(__file__).resolve().parent
    packed = Path(tempfile.mkdtemp(prefix="quirefold-code-")) / "quirefold.zip"
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(packed))
    context._quirefold_shipped = True


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The table ``name`` of a data folder."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's ``spark.checkpoint.dir``; only a local session without one gets its own, deleted at exit."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return context._jsc.sc().getCheckpointDir().get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quirefold-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the files; survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows, otherwise unchanged, so that Spark shuffles it.

    The check reads at most ``limit`` + 1 rows.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
