"""Aggregations and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CHART_HIGH, CHART_LOW, FEATURES


def symbol_counts(bars: DataFrame) -> DataFrame:
    """A1: rows per symbol counting non-null dates (partial + final hash aggregate)."""
    return bars.groupBy("symbol").agg(F.count("date").alias("count"))


def num_symbols(bars: DataFrame) -> DataFrame:
    """A2: number of symbol groups; a NULL symbol is a group of its own, as with groupBy().count()."""
    return symbol_counts(bars).agg(F.count(F.lit(1)).alias("num_symbols"))


def feature_bounds(bars: DataFrame) -> DataFrame:
    """A3: min and max of every feature per symbol."""
    return bars.groupBy("symbol").agg(
        *[F.min(f).alias(f"min_{f}") for f in FEATURES], *[F.max(f).alias(f"max_{f}") for f in FEATURES]
    )


def bounds_by_category(bars: DataFrame, category: str = "all") -> DataFrame:
    """A4: bounds in long form (symbol, category, min_value, max_value), one category or all."""
    fb = feature_bounds(bars)
    stacked = fb.select(
        "symbol",
        F.explode(F.array(*[
            F.struct(F.lit(f).alias("category"), F.col(f"min_{f}").alias("min_value"),
                     F.col(f"max_{f}").alias("max_value"))
            for f in FEATURES
        ])).alias("b"),
    ).select("symbol", "b.*")
    c = category.lower()
    if c == "all":
        return stacked
    if c not in FEATURES:
        raise ValueError(f"unknown category {category!r}")
    return stacked.filter(F.col("category") == c)


def chart_bounds(pred: DataFrame, by: str = "symbol", p: str = "prediction", a: str = "actual") -> DataFrame:
    """A5: axis bounds over prediction and actual series: trunc(min*0.98), trunc(max*1.02)."""
    return pred.groupBy(by).agg(
        (F.min(F.least(p, a)) * F.lit(CHART_LOW)).cast("long").alias("y_min"),
        (F.max(F.greatest(p, a)) * F.lit(CHART_HIGH)).cast("long").alias("y_max"),
    )


def accuracy(scored: DataFrame, by: str | None = "symbol", p: str = "prediction", label: str = "label") -> DataFrame:
    """Share of rows whose prediction equals the label exactly."""
    hit = F.avg((F.col(p) == F.col(label)).cast("double")).alias("accuracy")
    n = F.count(F.lit(1)).alias("n")
    return scored.groupBy(by).agg(hit, n) if by else scored.agg(hit, n)


def mse(scored: DataFrame, by: str | None = "symbol", p: str = "prediction", a: str = "actual") -> DataFrame:
    """Mean squared error of a prediction column against the actual value."""
    e = F.avg(F.pow(F.col(p) - F.col(a), 2)).alias("mse")
    n = F.count(F.lit(1)).alias("n")
    return scored.groupBy(by).agg(e, n) if by else scored.agg(e, n)
