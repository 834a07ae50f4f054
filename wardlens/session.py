"""Session defaults and lineage cutting.

On a cluster the session is built by the platform; :func:`get_spark` is for
local runs and tests. Intermediate tables go to the shared folder that
``spark.checkpoint.dir`` names; a cluster session without it is an error.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every wardlens job relies on. AQE re-plans joins at runtime from real
# shuffle sizes (this is where small sides get broadcast: only after Spark has
# measured them), coalesces tiny partitions and splits skewed join partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Jobs of one search share the executors evenly (each has its own pool).
    "spark.scheduler.mode": "FAIR",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app_name: str = "wardlens",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the wardlens defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def split_skewed_joins(spark: SparkSession) -> None:
    """Let this session's joins split skewed partitions even where an aggregate on the key follows."""
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def checkpoint_root(configured: str | None, master: str) -> str:
    """The folder for intermediate tables: the configured one, or a temp folder for a local master.

    With a local master the driver and its tasks share one machine, so a temp
    folder serves. On a cluster every executor would write to its own disk;
    there the setting is required.
    """
    if configured:
        return configured
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="wardlens-ckpt-")
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder (see :func:`checkpoint_root` where none is set yet)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(spark.conf.get("spark.checkpoint.dir", None), sc.master))
    return sc.getCheckpointDir()


_WRITTEN: list[list[str]] = [[]]


def materialize(df: DataFrame, name: str = "table", min_partitions: int | None = None) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet under the checkpoint folder and read it back.

    Used before a DataFrame is read many times (class counts, levels, folds,
    every cross-validation fit). One job writes it (``DataFrame.checkpoint``
    would run the plan twice: once to count, once to write); afterwards a lost
    executor re-reads files from the shared folder instead of replaying the
    plan, and reads get column pruning and Parquet statistics.

    ``min_partitions`` spreads the rows round-robin over that many files first
    (no key, so no skew): CPU-heavy readers such as model fits then get that
    many tasks even when AQE has merged a small result into one partition.

    The files stay until :func:`drop_written`, or the end of the enclosing
    :func:`intermediates` block.
    """
    spark = df.sparkSession
    if min_partitions:
        df = df.repartition(int(min_partitions))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/wardlens-{name}-{uuid.uuid4().hex}"
    _WRITTEN[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete intermediate tables: ``paths``, or all that this session has written so far."""
    gone = list(paths) if paths is not None else [p for level in _WRITTEN for p in level]
    for p in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        for level in _WRITTEN:
            if p in level:
                level.remove(p)


@contextlib.contextmanager
def intermediates(spark: SparkSession):
    """Delete every intermediate table written inside the block when it ends."""
    _WRITTEN.append([])
    try:
        yield
    finally:
        drop_written(spark, _WRITTEN[-1])
        _WRITTEN.pop()


_APART: dict = {}
_APART_LOCK = threading.Lock()
_OPEN_COST = "spark.sql.files.openCostInBytes"


@contextlib.contextmanager
def one_task_per_file(spark: SparkSession):
    """Scans that run inside the block give every file a task of its own (a file over the split size gets several).

    Spark packs small files into one task up to ``spark.sql.files.maxPartitionBytes``. A reader that
    holds much more per row than the file does, such as a fit, then gets tasks that grow with the
    table; here the rows a task gets are those that its writer put into a file. Blocks may overlap
    in threads: the setting comes back when the last one ends.
    """
    with _APART_LOCK:
        if not _APART:
            _APART.update(before=spark.conf.get(_OPEN_COST), blocks=0)
            spark.conf.set(_OPEN_COST, "1t")
        _APART["blocks"] += 1
    try:
        yield
    finally:
        with _APART_LOCK:
            _APART["blocks"] -= 1
            if not _APART["blocks"]:
                spark.conf.set(_OPEN_COST, _APART["before"])
                _APART.clear()


_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context (as ``--py-files`` would)."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parent
    with _SHIPPING:  # fits of several threads ask for it
        if getattr(sc, "_wardlens_shipped", False) or not root.is_dir():  # no folder: the package itself was shipped
            return
        archive = Path(tempfile.mkdtemp(prefix="wardlens-py-")) / "wardlens.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))
        sc._wardlens_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    """Current ``spark.sql.shuffle.partitions`` as an int."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
