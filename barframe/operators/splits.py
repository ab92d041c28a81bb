"""Train/test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import RANDOM_SPLIT, SEED


def hash_bucket(key: Column, seed: int = SEED) -> Column:
    """0..99 from the first 32 bits of md5(key|seed); independent of partitioning."""
    h = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % F.lit(100)).cast("long")


def hash_split(df: DataFrame, key: Column, ratio: float = RANDOM_SPLIT, seed: int = SEED) -> DataFrame:
    """Repeatable random split; adds ``bucket`` and ``part`` ('train' below ratio*100)."""
    b = hash_bucket(key, seed)
    return df.withColumn("bucket", b).withColumn(
        "part", F.when(F.col("bucket") < F.lit(int(round(ratio * 100))), F.lit("train")).otherwise(F.lit("test"))
    )


def split_parts(df: DataFrame, key: Column, ratio: float = RANDOM_SPLIT, seed: int = SEED):
    """T1 as two DataFrames (train, test)."""
    s = hash_split(df, key, ratio, seed)
    return s.filter(F.col("part") == "train").drop("bucket", "part"), s.filter(F.col("part") == "test").drop(
        "bucket", "part"
    )


def chrono_split(indexed: DataFrame) -> DataFrame:
    """First round(n*ratio) rows of each symbol train, the rest test (from the indexed series)."""
    return indexed.select(
        "symbol", "date", F.col("idx").cast("long").alias("idx"), "part",
        F.col("part_idx").cast("long").alias("part_idx"),
    )
