"""Session factory and the helpers every job shares: table loading, lineage cuts, size-checked small tables."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession

#: The most rows a table may have to be taken to the driver or put into a literal.
SMALL_TABLE_ROWS = 10_000


def get_session(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and a partition count for the machine at hand."""
    builder = (
        SparkSession.builder.master(master)
        .appName("loomspark")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of a data folder (one file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by `spark.checkpoint.dir`; a folder of our own only where that is unset."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = context.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="loomspark-ckpt-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    context.setCheckpointDir(shared)


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder and read back, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def drop_unused(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of tables that nothing refers to any more; else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_rows(df: DataFrame, limit: int = SMALL_TABLE_ROWS) -> list[Row]:
    """All rows of a table that has to be small; raises ValueError when it has more than `limit` rows."""
    rows = df.take(limit + 1)
    if len(rows) > limit:
        raise ValueError(f"a table of at most {limit} rows was expected")
    return rows


def ship(spark: SparkSession) -> None:
    """Give the package to the session's Python workers, wherever they start; once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_loomspark_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="loomspark-ship-")) / "loomspark.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, str(Path(package.name) / file.relative_to(package)))
    context.addPyFile(str(target))  # Spark's file server hands it to the executors
    atexit.register(shutil.rmtree, target.parent, ignore_errors=True)
    context._loomspark_shipped = True
