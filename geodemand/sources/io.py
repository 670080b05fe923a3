"""Scans and sinks.

Tables are replaced whole on each run, as the reference's
``CREATE OR REPLACE TABLE ... AS`` does; files are written by the executors,
never through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .._cols import require_columns
from ..session import ensure_checkpoint_dir

__all__ = [
    "coerce",
    "inline_table",
    "places",
    "scratch_path",
    "path_exists",
    "read_csv",
    "read_source",
    "read_table",
    "require_columns",
    "write_csv",
    "write_guarded",
    "write_metrics",
    "write_table",
]


def read_table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table when ``name`` is one, else a file path of ``fmt``."""
    if "/" not in name and spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.read.format(fmt).load(name)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Headered CSV with an explicit schema; header names must match it."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path if isinstance(path, str) else list(path))
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV, one file per partition, written by the executors."""
    df.write.mode(mode).option("header", True).csv(path)


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A constant dimension (e.g. a place list) from driver-side rows,
    hinted for broadcast: its size is the length of ``rows``."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


PLACE_SCHEMA = "city string, state string, center_lat double, center_lon double"


def places(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType = PLACE_SCHEMA) -> DataFrame:
    """An inline place list (A2): ``(city, state, centre lat, centre lon)``
    rows by default, broadcast-hinted (its size is ``len(rows)``)."""
    return inline_table(spark, rows, schema)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def _ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    parts = name.split(".")
    if len(parts) >= 2:
        loc = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {'.'.join(parts[:-1])}{loc}")


def _hadoop_path(spark: SparkSession, path: str):
    """A path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def _versions_folder(spark: SparkSession, name: str, path: str | None) -> str:
    """Where a table's versions lie: under ``path``, else beside the other tables of its database."""
    if path:
        return path.rstrip("/")
    *db, table = name.split(".")
    return f"{spark.catalog.getDatabase('.'.join(db) or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{table}.versions"


def _described(spark: SparkSession, name: str) -> tuple[list, str, bool]:
    """A catalog table's columns and layout, its folder, and whether it is external."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    facts = {r["col_name"]: r["data_type"] for r in rows}
    shape = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]
    layout = [facts.get(k) for k in ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns")]
    return [shape, layout, "# Partition Information" in facts], facts["Location"], facts.get("Type") == "EXTERNAL"


def _publish(spark: SparkSession, staged: str, name: str) -> None:
    """Let ``name`` show what the table ``staged`` shows; the version before stays on disk for running readers, older ones go."""
    new, location, _ = _described(spark, staged)
    folder, version = location.rsplit("/", 1)
    before = None
    if spark.catalog.tableExists(name):
        old, before, external = _described(spark, name)
        partitioned = new[2] or old[2]
        if external and old == new and not partitioned:
            # one catalog change: readers see the old rows or the new ones
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
            spark.sql(f"DROP TABLE {staged}")
            spark.catalog.refreshTable(name)
        else:
            spark.sql(f"DROP TABLE {name}")
            spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    else:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    p, fs = _hadoop_path(spark, folder)
    keep = {version, (before or "").rstrip("/").rsplit("/", 1)[-1]}
    for entry in fs.listStatus(p):
        found = entry.getPath().getName()
        if found.startswith("version-") and found not in keep:
            fs.delete(entry.getPath(), True)


def _stage(
    df: DataFrame,
    name: str,
    partition_by: str | Sequence[str] | None = None,
    fmt: str = "parquet",
    path: str | None = None,
    schema_location: str | None = None,
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> str:
    """Write ``df`` as a table of its own beside ``name``, in a new version folder; returns its name. Nothing stays of a write that fails."""
    spark = df.sparkSession
    _ensure_schema(spark, name, schema_location)
    mark = uuid.uuid4().hex
    staged, folder = f"{name}_staged_{mark}", f"{_versions_folder(spark, name, path)}/version-{mark}"
    w = df.write.format(fmt).option("path", folder)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if bucket_by:
        n, cols = bucket_by
        cols = [cols] if isinstance(cols, str) else list(cols)
        w = w.bucketBy(n, *cols).sortBy(*cols)
    try:
        w.saveAsTable(staged)
    except Exception:
        _discard(spark, staged, folder)
        raise
    return staged


def _discard(spark: SparkSession, staged: str, folder: str | None = None) -> None:
    folder = folder or _described(spark, staged)[1]
    spark.sql(f"DROP TABLE IF EXISTS {staged}")
    _delete(spark, folder)


def write_table(df: DataFrame, name: str, **layout) -> None:
    """Create or replace table ``name``.

    ``layout``: ``partition_by`` (large outputs only, e.g. a month column; place-day outputs are small and written
    unpartitioned), ``bucket_by=(n, cols)``, ``fmt``, ``path`` (folder of the table's versions, default beside the
    database's other tables) and ``schema_location`` (of a schema that is created). Bucketed rows are hash-bucketed
    and sorted by ``cols``: later joins or groupings on ``cols`` against a table bucketed the same way read
    co-located buckets instead of shuffling (e.g. resolved customers by ``customer_id``).

    The rows are written to a new version folder first; only then the table is pointed to it. A write that fails
    leaves the old table as it was, and who reads the old version meanwhile can finish: it stays until the next
    replacement. Columns, buckets and format unchanged, that is one change in the catalog; else, and for
    partitioned tables, the name is dropped and given to the new table.
    """
    _publish(df.sparkSession, _stage(df, name, **layout), name)


def _schema_items(schema: T.StructType | Mapping[str, str]) -> list[tuple[str, str]]:
    if isinstance(schema, T.StructType):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return list(schema.items())


def write_guarded(
    df: DataFrame, name: str, schema: T.StructType | Mapping[str, str], **kwargs
) -> DataFrame:
    """Refuse empty input and missing columns, keep and type the declared
    columns, then replace the table. Returns the table that was written.

    The rows are counted while they are written to the table's next version;
    an empty one is thrown away and the table stays as it was. So the input is
    computed once and kept nowhere else.
    """
    spark = df.sparkSession
    items = _schema_items(schema)
    cols = [c for c, _ in items]
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"The table needs columns that the frame lacks: {missing}")
    seen = Observation()
    typed = df.select(*[F.col(c).cast(t).alias(c) for c, t in items]).observe(seen, F.count(F.lit(1)).alias("rows"))
    staged = _stage(typed, name, **kwargs)
    if not seen.get["rows"]:
        _discard(spark, staged)
        raise ValueError(f"There are no rows to write to {name}.")
    _publish(spark, staged, name)
    return spark.table(name)


def coerce(df: DataFrame, schema: T.StructType | Mapping[str, str]) -> DataFrame:
    """Cast the named columns to their declared types; a bad value becomes null.

    Columns not named are passed through unchanged.
    """
    types = dict(_schema_items(schema))
    return df.select(
        *[
            F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
            for c in df.columns
        ]
    )


def write_metrics(df: DataFrame, path: str) -> None:
    """Model-metrics report (one row per model) as JSON lines.

    The frame has one row per candidate model, so a single output file is
    fine; it is still written by an executor.
    """
    df.coalesce(1).write.mode("overwrite").json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (or a glob) exists on its Hadoop file system."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(hconf)
    matches = fs.globStatus(p)
    return matches is not None and len(matches) > 0


def read_source(
    spark: SparkSession,
    table: str | None = None,
    path: str | Sequence[str] | None = None,
    schema: T.StructType | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """The catalog table when named and present, else the files.

    Fails naming every missing path when files are used.
    """
    if table and spark.catalog.tableExists(table):
        return spark.table(table)
    if path is None:
        raise FileNotFoundError(f"table {table!r} does not exist and no path was given")
    paths = [path] if isinstance(path, str) else list(path)
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError("Missing inputs:\n" + "\n".join(f"- {p}" for p in missing))
    if fmt == "csv":
        if schema is None:
            raise ValueError("CSV sources need an explicit schema")
        return read_csv(spark, paths, schema)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(paths)
