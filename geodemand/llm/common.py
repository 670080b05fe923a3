"""Column expressions and small helpers shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# The white space that separates words, as characters and as a pattern.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"


def words(text: Column) -> Column:
    """Words of a text in order (runs of non-white-space); an empty array for null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text modulo ``parts`` (a null id counts as empty text)."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts).cast("int")


def unit_hash(*cols: Column) -> Column:
    """Reproducible number in [0, 1) from the columns' hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") * F.lit(2.0**-53)


def row_hash(df: DataFrame) -> Column:
    """Hash of a whole row; nested and clashing names are addressed by position-safe quoting."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def fresh(name: str) -> str:
    """A column name that no user table carries."""
    return f"__gd_{name}"


def shared_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like a reliable checkpoint does, in columnar compressed
    form; a lost executor costs a re-read of shared files only.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete tables that :func:`shared_table` wrote, once nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            if "/table-" in folder:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` hinted for broadcast if it has at most ``max_rows`` rows (counted on the executors), else as it is."""
    return F.broadcast(df) if df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows else df
