"""Loading the hospital tables from a folder of files.

Each ``<TABLE>.csv`` is read in one pass with the header as names and every
value as text, then names are trimmed and lower-cased (S2) and each declared
column is cast by name with ``try_cast`` (bad values become NULL; codes such
as ``0389`` stay text). A declared column missing from the file is NULL; file
columns that are not declared are kept as text after the declared ones. A
missing table is reported and skipped (S3).
"""

from __future__ import annotations

import warnings
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardlens.schemas import TABLE_NAMES, TABLE_SCHEMAS
from wardlens.sources.store import Files, publish_store, quality_metrics


def normalise_columns(df: DataFrame) -> DataFrame:
    """Trim and lower-case every column name (metadata only)."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def _conform(raw: DataFrame, table: str, observation: Observation | None = None) -> DataFrame:
    schema = TABLE_SCHEMAS.get(table)
    df = normalise_columns(raw)
    if schema is None:
        return df
    if observation is not None:
        df = quality_metrics(df, {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields if f.name in df.columns},
                             observation)
    declared = [f.name for f in schema.fields]
    cols = [(F.col(f.name).try_cast(f.dataType) if f.name in df.columns
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    extra = [F.col(c) for c in df.columns if c not in declared]
    return df.select(*cols, *extra)


def files_with_broken_lines(spark: SparkSession, path: str) -> list[str]:
    """The files of ``path`` in which a quoted value runs over a line break.

    One pass over the text: in such a file, and in no other, some line holds an odd
    number of quotes (a doubled quote inside a value keeps the count even).
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (quotes % 2).alias("odd"))
    return [r["file"] for r in lines.groupBy("file").agg(F.max("odd").alias("odd")).where("odd = 1").collect()]


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every value as text. Only files that need it are read as whole records; the others stay split."""
    reader = spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
    broken = files_with_broken_lines(spark, path)
    if not broken:
        return reader.option("multiLine", False).csv(path)
    # Both listings are made by Spark, which may spell one file's address in two ways.
    plain = lambda f: unquote(urlparse(f).path)
    whole = {plain(f) for f in broken}
    others = [f for f in spark.read.text(path).inputFiles() if plain(f) not in whole]
    records = reader.option("multiLine", True).csv([unquote(f) for f in broken])
    if not others:
        return records
    rest = reader.option("multiLine", False).csv([unquote(f) for f in others])
    return rest.unionByName(records, allowMissingColumns=True)


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "csv",
               observation: Observation | None = None) -> DataFrame:
    """Read one table file/folder and conform it to its declared schema.

    ``observation`` gets the rows and the values that could not be cast, per
    column, once the table has been read (S5).
    """
    raw = _read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    return _conform(raw, table, observation)


def load_tables(spark: SparkSession, data_dir: str, fmt: str = "csv", tables=TABLE_NAMES,
                observations: dict[str, Observation] | None = None) -> tuple[dict[str, DataFrame], list[str]]:
    """``({lower-case name: DataFrame}, [missing names])``.

    A table whose file is absent is skipped with a warning. Reading is lazy
    apart from Spark's file listing and, for CSV, one pass that looks for quoted
    line breaks. ``observations`` is filled with one observation per table.
    """
    loaded, missing = {}, []
    ext = "csv" if fmt == "csv" else fmt
    for name in tables:
        path = f"{data_dir.rstrip('/')}/{name}.{ext}"
        if not Files(spark).exists(path):
            warnings.warn(f"{path} not found, skipping {name}")
            missing.append(name.lower())
            continue
        seen = None if observations is None else Observation(f"load_{name.lower()}")
        df = read_table(spark, path, name.lower(), fmt, seen)
        loaded[name.lower()] = df
        if seen is not None and name.lower() in TABLE_SCHEMAS:
            observations[name.lower()] = seen
    return loaded, missing


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose each table to ``spark.sql`` under its lower-case name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def publish_tables(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet",
                   partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Write every table, replacing what was there; returns name -> path.

    ``partition_by`` maps a table to partition columns (for example an
    admission year) so later filters on them prune whole folders.
    """
    paths = {}
    for name, df in tables.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        writer = df.write.mode("overwrite").format(fmt)
        if partition_by and partition_by.get(name):
            writer = writer.partitionBy(*partition_by[name])
        writer.save(path)
        paths[name] = path
    return paths


def _own_session(spark: SparkSession) -> SparkSession:
    """A session of its own on the same context, with the settings of ``spark``.

    Once a session has observed a table, Spark cannot send a fitted logistic
    regression to its executors from it (the model's training summary holds the
    session, and that the observations). Loading therefore observes elsewhere.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def load_and_publish(spark: SparkSession, data_dir: str, store_dir: str, fmt: str = "csv",
                     buckets: int | None = None) -> list[str]:
    """Load a folder of tables into a store; returns the missing tables.

    The files' rows are read once, by the write; the quality figures are taken on
    the way (:func:`wardlens.sources.store.load_quality`).
    """
    observations: dict[str, Observation] = {}
    loaded, missing = load_tables(_own_session(spark), data_dir, fmt, observations=observations)
    if not loaded:
        raise FileNotFoundError(f"no table found in {data_dir}")
    publish_store(loaded, store_dir, buckets=buckets, observations=observations)
    return missing


def load_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``table, n_rows, n_columns``."""
    parts = [df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n_rows"),
                    F.lit(len(df.columns)).alias("n_columns"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
