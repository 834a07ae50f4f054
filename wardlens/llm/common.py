"""Helpers shared by the training-data operators."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.session import ensure_checkpoint_dir, materialize, shuffle_partitions

__all__ = ["ASCII_SPACE", "bounded_batches", "drop_folder", "empty_like", "materialize", "open_read",
           "open_write", "shared_folder", "ship_package", "shuffle_partitions", "text_or_empty", "batch_of"]

ASCII_SPACE = b" \t\n\x0b\x0c\r"
# Rows handed to Python at once. Texts may be long, so this stays small; the byte bound
# below cuts a batch of long texts earlier where the Spark version knows it.
BATCH_ROWS = 512
BATCH_BYTES = 32 << 20


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context (as ``--py-files`` would)."""
    sc = spark.sparkContext
    if getattr(sc, "_wardlens_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    if root.is_dir():  # else the package itself was shipped
        archive = Path(tempfile.mkdtemp(prefix="wardlens-py-")) / "wardlens.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))
    sc._wardlens_shipped = True


def bounded_batches(spark: SparkSession) -> None:
    """Make ready for Python operators: ship the package and bound what one Arrow batch may hold.

    Memory then follows the longest text, not the row count.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_or_empty(col: str = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/wardlens-{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, through Spark's file system layer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def open_write(uri: str):
    """A binary output stream for ``uri`` in the shared store (any store pyarrow knows)."""
    fs, path = _file_system(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    return fs.open_output_stream(path, compression=None)


def open_read(uri: str):
    """A binary input stream for ``uri``."""
    fs, path = _file_system(uri)
    return fs.open_input_stream(path, compression=None)


def batch_of(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """A record batch with the columns of ``schema``, in its order."""
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
         for f in schema], schema=schema)


def empty_like(spark: SparkSession, schema) -> DataFrame:
    """An empty table of ``schema``."""
    return spark.createDataFrame([], schema)
