"""Session settings the engine relies on, and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: UTC everywhere: stored timestamps are naive UTC, so the session zone must not shift them.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

#: Spark's setting that deletes the shuffle files of a query when it has ended.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build(app: str = "tidewrack", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``master`` only where none is set from outside."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in (CONF | conf).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once per context: they needn't have it installed. The driver serves the file."""
    context = spark.sparkContext
    if getattr(context, "_tidewrack_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tidewrack-")) / "tidewrack.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path("tidewrack") / f.relative_to(root))
    context.addPyFile(str(target))
    context._tidewrack_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, a Parquet file or a folder of them."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores, for costly work on each row: a small table in one file would keep one core
    busy. Tables of more files than half the cores stay as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if 2 * df.rdd.getNumPartitions() > cores else df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session. Where that is unset, a local one if all runs on one machine; on a
    cluster this raises."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local" and "TIDEWRACK_SHARED" not in os.environ:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = os.environ.get("TIDEWRACK_SHARED", "file://" + os.path.join(tempfile.gettempdir(), "tidewrack-checkpoints"))
    return d


def cut(df: DataFrame) -> DataFrame:
    """Writes df once to the shared folder and reads it back, so that neither its cost nor a lost executor makes it be computed again. The
    shuffle files of its plan are deleted at once: once it is written, nothing reads them."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a new plan, for which the setting holds
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)


def let_go(spark: SparkSession) -> None:
    """Collects the driver's garbage. Spark gives up broadcasts, checkpoints and shuffle files of plans that nobody holds any more only then, and
    the driver's heap shrinks only then; in a run of many short plans both would grow until it happens to collect all."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
