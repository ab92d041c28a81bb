"""Counts, bounds and offsets kept up to date as bar files arrive.

Count, minimum and maximum of a (symbol, month) merge, so what new files add is a small delta of their own. Structured
Streaming's file source knows which files are new: an update reads those and nothing else, and its checkpoint makes each
file count once also where a run stops half-way, as a delta is written under its batch's number. Bounds, lengths, split
points and the offset of every month in its series come from the merged deltas; the bars are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURES, INDEX_BUCKET, SERIES_SPLIT
from ..operators.series import _bucket, split_sql
from ..sources.bars import BAR_SCHEMA

_BOUNDS = ", ".join(f"mn_{f} DOUBLE, mx_{f} DOUBLE" for f in FEATURES)
STATS_SCHEMA = f"symbol STRING, bucket INT, n BIGINT, {_BOUNDS}"


def bucket_stats(bars: DataFrame, bucket: str = INDEX_BUCKET) -> DataFrame:
    """(symbol, bucket, n, mn_<f>, mx_<f>) of bars: one partial and final hash aggregate. Bars without a symbol or a date
    have no place in a series and are not counted."""
    return (bars.where("symbol IS NOT NULL AND date IS NOT NULL")
            .selectExpr("symbol", f"CAST({_bucket('date', bucket)} AS INT) AS bucket", *FEATURES)
            .groupBy("symbol", "bucket").agg(F.count("*").alias("n"), *[
                e for f in FEATURES for e in (F.min(f).alias(f"mn_{f}"), F.max(f).alias(f"mx_{f}"))]))


def update(spark: SparkSession, bars_dir: str, stats_dir: str, checkpoint_dir: str, max_files: int | None = None) -> int:
    """Take in the bar files (Parquet) that no update has seen; returns how many bars were read."""
    seen = []

    def write(batch: DataFrame, number: int) -> None:
        out = f"{stats_dir}/delta={number}"
        bucket_stats(batch).write.mode("overwrite").parquet(out)
        seen.append(spark.read.schema(STATS_SCHEMA).parquet(out).agg(F.sum("n")).first()[0] or 0)

    reader = spark.readStream.schema(BAR_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (reader.parquet(bars_dir).writeStream.foreachBatch(write)
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(seen)


def merged(spark: SparkSession, stats_dir: str) -> DataFrame:
    """The deltas as one row per (symbol, bucket)."""
    deltas = spark.read.schema(STATS_SCHEMA).option("recursiveFileLookup", "true").parquet(stats_dir)
    return deltas.groupBy("symbol", "bucket").agg(F.sum("n").alias("n"), *[
        e for f in FEATURES for e in (F.min(f"mn_{f}").alias(f"mn_{f}"), F.max(f"mx_{f}").alias(f"mx_{f}"))])


def compact(spark: SparkSession, stats_dir: str, into: str) -> None:
    """Write the merged deltas as one delta under the folder ``into``; later updates may go on there (with the same
    checkpoint, whose batch numbers go on)."""
    merged(spark, stats_dir).write.mode("error").parquet(f"{into}/delta=compact")


def symbol_stats(stats: DataFrame, ratio: float = SERIES_SPLIT) -> DataFrame:
    """(symbol, n, split, mn_<f>, mx_<f>) of every series."""
    whole = stats.groupBy("symbol").agg(F.sum("n").alias("n"), *[
        e for f in FEATURES for e in (F.min(f"mn_{f}").alias(f"mn_{f}"), F.max(f"mx_{f}").alias(f"mx_{f}"))])
    return whole.selectExpr("symbol", "n", f"{split_sql('n', ratio)} AS split",
                            *[f"{m}_{f}" for f in FEATURES for m in ("mn", "mx")])


def offsets(stats: DataFrame) -> DataFrame:
    """(symbol, bucket, n, offset): how many bars of the series lie before each bucket. A window over buckets, not bars."""
    return stats.selectExpr(
        "symbol", "bucket", "n", "CAST(coalesce(sum(n) OVER (PARTITION BY symbol ORDER BY bucket"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset")
