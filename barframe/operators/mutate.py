"""Row mutations on an immutable collection (U1-U3): each returns a new DataFrame.

Written out to a new versioned directory they replace the old version; a table
format with MERGE would take the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update_by(docs: DataFrame, by: str, old: str, new: str, multi: bool = False,
              order_key: Column | None = None) -> DataFrame:
    """Set ``by`` to ``new`` where it equals ``old``.

    With ``multi=False`` only the first match changes, first meaning the
    smallest ``order_key``. Give the column that numbers the insertions (see
    :func:`..sources.documents.with_sequence`) where there is one. By default
    the first is the smallest id, numeric ids before text ids, and of equal ids
    the document of the smallest content hash, so that one document changes
    (documents equal in every field cannot be told apart without a sequence).
    The first key is a scalar subquery (one aggregate over the matches,
    partially aggregated, one value back), never a whole-table window.
    """
    hit = F.col(by) == F.lit(old)
    if multi:
        cond = hit
    else:
        key = order_key if order_key is not None else F.struct(
            F.expr("try_cast(id AS BIGINT)").isNull().alias("text_id"), F.expr("try_cast(id AS BIGINT)").alias("n"),
            F.col("id").alias("id"), F.xxhash64(*[F.col(c) for c in docs.columns]).alias("h"))
        first = docs.filter(hit).select(F.min(key)).scalar()
        cond = hit & key.eqNullSafe(first)
    return docs.select(*[F.when(cond, F.lit(new)).otherwise(F.col(c)).alias(c) if c == by else F.col(c)
                         for c in docs.columns])


def remove_by(docs: DataFrame, by: str, value: str | None) -> DataFrame:
    """Delete every document whose ``by`` equals ``value``; NULL fields never match a value."""
    return docs.filter(~F.col(by).eqNullSafe(F.lit(value)))


def remove(docs: DataFrame, value: str) -> DataFrame:
    """Delete every document with ``open`` equal to ``value``."""
    return remove_by(docs, "open", value)
