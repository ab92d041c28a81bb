"""Shared helpers: input tables, scratch tables in the shared folder, word and field rules."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from barframe.config import shared_dir

# A word is a maximal run of anything but the six ASCII white-space characters.
SPACE_CLASS = r"[\\x20\\x09-\\x0D]"  # as written inside a Spark SQL string literal


def ship_package(spark: SparkSession) -> None:
    """Python workers are told where this package lies, as it may be imported from anywhere; where executors have it
    elsewhere, their own path (or --py-files) comes into play as usual."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, for a session whose Python workers find this package."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut there, so a lost executor costs a
    re-read, not a recomputation, and several readers share one computation."""
    spark = df.sparkSession
    ship_package(spark)
    path = shared_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again (their successors are written)."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def words_sql(col: str) -> str:
    """SQL text: the words of a text column as an array (null: empty). Splitting on runs of white space leaves
    an empty string at most at either end, which the filter takes off."""
    return f"filter(split(coalesce({col}, ''), '{SPACE_CLASS}+'), w -> w != '')"


def word_count_sql(col: str) -> str:
    """SQL text: the number of words of a text column (null: 0) as a long. The split counts an empty string before
    leading and after trailing white space (one for an empty text)."""
    text = f"coalesce({col}, '')"
    return (f"cast(size(split({text}, '{SPACE_CLASS}+')) - if({text} = '', 1, 0)"
            f" - if(substr({text}, 1, 1) rlike '{SPACE_CLASS}', 1, 0)"
            f" - if(substr({text}, -1) rlike '{SPACE_CLASS}', 1, 0) as bigint)")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` has not (names are compared as Spark does, without case)."""
    have = {c.lower() for c in df.columns}
    name, k = base, 0
    while name.lower() in have:
        k += 1
        name = f"{base}_{k}"
    return name
