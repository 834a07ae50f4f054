"""Published tables: bucketed for the joins, versioned, switched by a pointer.

A store is a folder of version folders and one small file that names the
current version. Publishing writes a whole new version and then replaces the
pointer, so a reader sees the old tables or the new ones and a publish that
fails changes nothing.

Tables are bucketed and sorted by the key their joins use (the role the
reference's indexes play). The admissions are stored once more joined with
their patients (J1), by ``hadm_id``: the feature table's joins and roll-ups then
all meet on ``hadm_id`` and read co-located buckets without an exchange.

A bucket is read by one task. Where one key holds so many rows that its bucket is
over ``MAX_SKEW`` times the mean (and over ``MIN_SKEWED_BYTES``), the table is opened
as plain files instead, so Spark shuffles it and may split the hot key.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.session import shuffle_partitions

# Bucket key per table: the key of the joins that read it.
BUCKET_KEYS = {
    "patients": "subject_id", "admissions": "hadm_id", "icustays": "hadm_id", "diagnoses_icd": "hadm_id",
    "labevents": "hadm_id", "d_icd_diagnoses": "icd9_code", "cohort_admissions": "hadm_id",
}
POINTER = "CURRENT"
MAX_SKEW = 4.0
MIN_SKEWED_BYTES = 128 << 20
KEPT_VERSIONS = 2


class Files:
    """Small files and folders in any store that Spark's file systems know."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return bool(fs.exists(p))

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def list(self, path: str) -> list[tuple[str, int, int]]:
        """(name, bytes, changed) of what a folder holds; of the file itself for a file."""
        fs, p = self._at(path)
        return [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)]

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Replace ``path`` by ``text`` in one step: a reader finds the old file or the new one."""
        fs, new = self._at(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(new, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        fc = self.jvm.org.apache.hadoop.fs
        rename = self.jvm.java.lang.reflect.Array.newInstance(getattr(fc, "Options$Rename").OVERWRITE.getClass(), 1)
        self.jvm.java.lang.reflect.Array.set(rename, 0, getattr(fc, "Options$Rename").OVERWRITE)
        fc.FileContext.getFileContext(fs.getUri(), self.conf).rename(new, self._at(path)[1], rename)


def _table_name(version: str, table: str) -> str:
    return re.sub(r"\W", "_", f"wardlens_{version}_{table}")


def _write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """One file per bucket: the shuffle deals rows as the buckets do."""
    spark, name = df.sparkSession, f"wardlens_tmp_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # the files stay


def quality_metrics(raw: DataFrame, casts: dict[str, F.Column], observation: Observation) -> DataFrame:
    """``raw`` with a tally of its rows and, per column, of the values whose cast gives NULL, taken as it is read."""
    bad = [F.count(F.when(F.col(c).isNotNull() & cast.isNull(), 1)).alias(f"bad_{c}") for c, cast in casts.items()]
    return raw.observe(observation, F.count(F.lit(1)).alias("rows"), *bad)


def publish_store(tables: dict[str, DataFrame], store_dir: str, *, buckets: int | None = None,
                  observations: dict[str, Observation] | None = None) -> str:
    """Write ``tables`` as a new version of the store and make it current; returns the version.

    ``observations`` of tables read with :func:`quality_metrics` are kept with the
    version (:func:`load_quality`); the rows are read once, by the write. On a
    failure the new folder is removed and the old version stays current.
    """
    spark = next(iter(tables.values())).sparkSession
    files, version = Files(spark), f"v{uuid.uuid4().hex[:12]}"
    n = buckets or shuffle_partitions(spark)
    folder = f"{store_dir.rstrip('/')}/{version}"
    said: dict = {"tables": {}, "quality": []}
    try:
        def put(name, df):
            path, key = f"{folder}/{name}", BUCKET_KEYS.get(name)
            key = key if key in df.columns else None
            if key:
                _write_bucketed(df, path, key, n)
            else:
                df.write.parquet(path)
            sizes = [size for f, size, _ in files.list(path) if f.startswith("part-")]
            said["tables"][name] = {"schema": df.schema.json(), "key": key, "buckets": n if key else None,
                                    "largest": max(sizes, default=0), "bytes": sum(sizes)}

        for name, df in tables.items():
            put(name, df)
        if {"admissions", "patients"} <= set(tables):
            from wardlens.operators.features import admission_patient

            here = {t: spark.read.schema(tables[t].schema).parquet(f"{folder}/{t}") for t in ("admissions", "patients")}
            put("cohort_admissions", admission_patient(here["admissions"], here["patients"]))
        for name, obs in (observations or {}).items():
            got = obs.get
            said["quality"] += [[name, c[4:], got["rows"], v] for c, v in got.items() if c.startswith("bad_")]
        files.write(f"{folder}/version.json", json.dumps(said))
        files.write(f"{store_dir.rstrip('/')}/{POINTER}", version)
    except BaseException:
        files.delete(folder)
        raise
    old = sorted((changed, f) for f, _, changed in files.list(store_dir) if re.fullmatch(r"v[0-9a-f]{12}", f) and f != version)
    for _, f in old[:len(old) - (KEPT_VERSIONS - 1)]:
        files.delete(f"{store_dir.rstrip('/')}/{f}")
    return version


def current_version(spark: SparkSession, store_dir: str) -> tuple[str, dict]:
    """Name and description of the store's current version."""
    files, root = Files(spark), store_dir.rstrip("/")
    if not files.exists(f"{root}/{POINTER}"):
        raise FileNotFoundError(f"nothing published in {store_dir}")
    version = files.read(f"{root}/{POINTER}").strip()
    return version, json.loads(files.read(f"{root}/{version}/version.json"))


def open_store(spark: SparkSession, store_dir: str) -> dict[str, DataFrame]:
    """The tables of the current version, bucketed where no bucket is much larger than the others."""
    version, said = current_version(spark, store_dir)
    out = {}
    for name, t in said["tables"].items():
        path = f"{store_dir.rstrip('/')}/{version}/{name}"
        schema = T.StructType.fromJson(json.loads(t["schema"]))
        skewed = t["key"] and t["largest"] > max(MIN_SKEWED_BYTES, MAX_SKEW * t["bytes"] / t["buckets"])
        if not t["key"] or skewed:
            out[name] = spark.read.schema(schema).parquet(path)
            continue
        table = _table_name(version, name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY (`{t['key']}`) "
                  f"SORTED BY (`{t['key']}`) INTO {t['buckets']} BUCKETS LOCATION '{path}'")
        out[name] = spark.table(table)
    return out


def load_quality(spark: SparkSession, store_dir: str) -> DataFrame:
    """``table, column, n_rows, n_bad`` of the load that made the current version."""
    rows = current_version(spark, store_dir)[1]["quality"]
    return spark.createDataFrame([tuple(r) for r in rows], "`table` string, `column` string, n_rows long, n_bad long")
