"""Normalisation."""

from __future__ import annotations

from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FEATURES
from .series import denorm, norm

# Order in which the profiling job assembles its vector.
PROFILE_ORDER = ("open", "low", "high", "volume", "close")


def normalized_bars(indexed: DataFrame) -> DataFrame:
    """Per-symbol min-max of the five features; bounds come with the indexed series."""
    return indexed.select("symbol", "date", "idx", *[norm(f).alias(f) for f in FEATURES])


def normalize_target(indexed: DataFrame, category: str) -> DataFrame:
    """Only the target column normalised."""
    c = category.lower()
    if c not in FEATURES:
        raise ValueError(f"unknown category {category!r}")
    return indexed.select("symbol", "date", "idx", norm(c).alias(c))


def denormalize_roundtrip(indexed: DataFrame) -> DataFrame:
    """N3 applied to N1: every feature back from [0, 1] to its own scale."""
    return indexed.select(
        "symbol", "date", *[denorm(norm(f), f).alias(f) for f in FEATURES]
    )


def global_minmax(bars: DataFrame, cols: tuple[str, ...] = PROFILE_ORDER, lo: float = 0.0,
                  hi: float = 1.0) -> DataFrame:
    """MinMaxScaler over one assembled vector across all symbols.

    Fitting is a single distributed summary (min/max per slot) over the rows that
    have all features. Every row is kept: a missing feature (NULL or NaN) is NULL,
    the others of its row are scaled by the same bounds. Without a complete row
    there are no bounds and all features are NULL. The vector is exposed as
    scalar columns beside date and symbol.
    """
    rows = bars.select("symbol", "date", *cols)
    complete = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="skip").transform(rows)
    if complete.isEmpty():
        return rows.select("symbol", "date", *[F.lit(None).cast("double").alias(c) for c in cols])
    model = MinMaxScaler(min=lo, max=hi, inputCol="features", outputCol="normalizedFeatures").fit(complete)
    assembled = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep").transform(rows)
    scaled = model.transform(assembled).select(
        "symbol", "date", vector_to_array("normalizedFeatures").alias("_v")
    )
    value = F.col("_v")
    return scaled.select("symbol", "date", *[F.when(~F.isnan(value[i]), value[i]).alias(c) for i, c in enumerate(cols)])
