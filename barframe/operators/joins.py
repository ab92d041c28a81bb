"""Joins with a side of one row per key, whatever share of the other side one key holds."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Rows of one key that meet one copy of the key's row.
JOIN_ROWS = 1 << 20


def block_join(rows: DataFrame, per_key: DataFrame, key: str, row_sql: str, count_sql: str,
               block_rows: int = JOIN_ROWS, how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``per_key`` (one row per ``key``) where both sides know how long a series is.

    ``row_sql`` numbers the rows of a key from 0, and ``count_sql`` over ``per_key`` is no less than their number. A
    key's rows are cut into blocks of ``block_rows``, and its small row is copied once per block: a key with a third
    of all rows is spread over many tasks, a light key (one block) is not copied at all. Adaptive execution still turns
    the join into a broadcast where the small side measures small.
    """
    left = rows.selectExpr("*", f"CAST(({row_sql}) DIV {block_rows} AS BIGINT) AS _blk")
    right = per_key.selectExpr(
        "*", f"explode(sequence(0L, CAST((greatest({count_sql}, 1) - 1) DIV {block_rows} AS BIGINT))) AS _blk")
    return left.join(right, [key, "_blk"], how).drop("_blk")


def salted_join(rows: DataFrame, per_key: DataFrame, key: str, salt_sql: str, salts: int | None = None,
                how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``per_key`` (one row per ``key``).

    ``salt_sql`` gives each row a number; its remainder by ``salts`` (default: the session's shuffle partitions)
    spreads the rows of a key, and each row of the small side is copied to all remainders. Adaptive execution still
    turns the join into a broadcast when the small side measures small enough.
    """
    if salts is None:
        salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if salts < 1:
        raise ValueError("salts must be positive")
    left = rows.selectExpr("*", f"CAST(pmod({salt_sql}, {salts}) AS INT) AS _salt")
    right = per_key.selectExpr("*", f"explode(sequence(0, {salts - 1})) AS _salt")
    return left.join(right, [key, "_salt"], how).drop("_salt")
