"""Projections, filters and category selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FEATURES
from ..sources.bars import parse_double


def symbol_filter(bars: DataFrame, symbol: str) -> DataFrame:
    """Keep one symbol; an equality on a scan column, pushed into the Parquet/CSV reader."""
    return bars.filter(F.col("symbol") == F.lit(symbol))


def drop_null_rows(df: DataFrame, subset: list[str] | tuple[str, ...]) -> DataFrame:
    """P5: drop rows with a NULL in any of ``subset``."""
    return df.na.drop(how="any", subset=list(subset))


def parse_prices(text: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Text columns to double (bad text and NaN to NULL), other columns kept."""
    return text.select(*[parse_double(c).alias(c) if c in cols else F.col(c) for c in text.columns])


def reject_rows(text: DataFrame, cols: list[str] | tuple[str, ...]) -> DataFrame:
    """Rows whose text does not parse to a number (the reject output of P6)."""
    bad = None
    for c in cols:
        cond = F.col(c).isNotNull() & parse_double(c).isNull()
        bad = cond if bad is None else bad | cond
    return text.filter(bad)


def category_long(bars: DataFrame, category: str) -> DataFrame:
    """The target column(s) of a category in long form (symbol, date, category, value).

    ALL yields the five features; any other unknown name raises.
    """
    c = category.lower()
    if c == "all":
        cols = list(FEATURES)
    elif c in FEATURES:
        cols = [c]
    else:
        raise ValueError(f"unknown category {category!r}")
    return bars.unpivot(["symbol", "date"], cols, "category", "value")
