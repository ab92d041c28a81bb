"""Fixed-length sequence windows over an indexed series.

Windows are built by Spark window functions over (symbol, part, block), where
a block is ``block_rows`` consecutive rows of one part plus the first
``WINDOW + HORIZON`` rows of the next block (copied by one ``explode``). Every
window and its label therefore lies inside one block, the shuffle moves each
row at most twice, and a very long series is spread over many tasks.

Start positions follow the reference loops: ``start < part_n - (L + H)``
(the last possible start is left out, as there); ``drop_last=False`` keeps it.

Expressions are SQL text: one driver round trip per projection instead of one
per expression node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BLOCK_ROWS, FEATURES, HORIZON, MINI_BATCH, SERIES_SPLIT, WINDOW
from .series import norm_sql, split_sql

BOUNDS = tuple(f"mn_{f}" for f in FEATURES) + tuple(f"mx_{f}" for f in FEATURES)
BLOCK_WINDOW = "PARTITION BY symbol, part, _blk ORDER BY part_idx"


def target_columns(category: str) -> list[str]:
    """Feature column(s) of a category; ALL gives the five features."""
    c = category.lower()
    if c == "all":
        return list(FEATURES)
    if c not in FEATURES:
        raise ValueError(f"unknown category {category!r}")
    return [c]


def bar_struct_sql(normalised: bool = True) -> str:
    return "named_struct(" + ", ".join(
        f"'{f}', {norm_sql(f) if normalised else f}" for f in FEATURES
    ) + ")"


def _blocked(indexed: DataFrame, span: int, block_rows: int) -> DataFrame:
    """Assign rows to blocks; rows within ``span`` of a block start are copied to the previous block.

    The explicit distribution on all three keys keeps a hot symbol spread over
    its blocks even when the input already arrives clustered by symbol.
    """
    if block_rows <= span:
        raise ValueError("block_rows must exceed the window span")
    own = f"CAST(floor(part_idx / {block_rows}) AS BIGINT)"
    return indexed.selectExpr(
        "*", f"{own} AS _own_blk",
        f"explode(CASE WHEN part_idx >= {block_rows} AND part_idx % {block_rows} < {span} "
        f"THEN array({own}, {own} - 1) ELSE array({own}) END) AS _blk",
    ).repartition("symbol", "part", "_blk")


def _starts(df: DataFrame, L: int, H: int, drop_last: bool) -> DataFrame:
    op = "<" if drop_last else "<="
    return df.filter(f"_blk = _own_blk AND part_idx {op} part_n - {L + H}")


def _missing_sql(L: int) -> str:
    nulls = " + ".join(f"CAST({f} IS NULL AS INT)" for f in FEATURES)
    return f"sum({nulls}) OVER ({BLOCK_WINDOW} ROWS BETWEEN CURRENT ROW AND {L - 1} FOLLOWING) AS missing"


def test_windows(indexed: DataFrame, category: str = "close", L: int = WINDOW, H: int = HORIZON,
                 drop_last: bool = True, block_rows: int = BLOCK_ROWS, part: str = "test",
                 count_missing: bool = False) -> DataFrame:
    """L normalised bars per start; label = raw target(s) of bar start+L.

    Result: symbol, start_idx, start_date, window ARRAY<STRUCT<open..volume>>,
    label DOUBLE (one category) or label STRUCT<open..volume> (ALL), plus the
    bounds columns so predictions can be denormalised without another join.
    """
    targets = target_columns(category)
    rows = _blocked(indexed.filter(f"part = '{part}'"), L + H, block_rows)
    label_of = targets[0] if len(targets) == 1 else bar_struct_sql(normalised=False)
    out = rows.selectExpr(
        "symbol", "part_idx", "part_n", "_blk", "_own_blk", "date", *BOUNDS,
        f"collect_list({bar_struct_sql()}) OVER ({BLOCK_WINDOW} ROWS BETWEEN CURRENT ROW AND {L - 1} FOLLOWING) AS window",
        f"lead({label_of}, {L}) OVER ({BLOCK_WINDOW}) AS label", _missing_sql(L),
    )
    return _starts(out, L, H, drop_last).selectExpr(
        "symbol", "part_idx AS start_idx", "date AS start_date", *BOUNDS, "window", "label",
        *(["missing"] if count_missing else []),
    )


def train_windows(indexed: DataFrame, category: str = "close", L: int = WINDOW, H: int = HORIZON,
                  drop_last: bool = True, block_rows: int = BLOCK_ROWS, count_missing: bool = False) -> DataFrame:
    """L normalised bars per start; labels = normalised target(s) of bars start+1..start+L.

    For ALL every feature is normalised with its own bounds. ``count_missing``
    adds how many of the window's prices are NULL (a constant feature is not
    missing, though its normalised value is NULL too).
    """
    targets = target_columns(category)
    rows = _blocked(indexed.filter("part = 'train'"), L + H, block_rows)
    lab = norm_sql(targets[0]) if len(targets) == 1 else bar_struct_sql()
    out = rows.selectExpr(
        "symbol", "part_idx", "part_n", "_blk", "_own_blk", "date",
        f"collect_list({bar_struct_sql()}) OVER ({BLOCK_WINDOW} ROWS BETWEEN CURRENT ROW AND {L - 1} FOLLOWING) AS window",
        # A struct is never NULL, so a missing label keeps its place in the list.
        f"transform(collect_list(named_struct('v', {lab})) OVER ({BLOCK_WINDOW} ROWS BETWEEN 1 FOLLOWING AND "
        f"{L} FOLLOWING), x -> x.v) AS labels", _missing_sql(L),
    )
    return _starts(out, L, H, drop_last).selectExpr(
        "symbol", "part_idx AS start_idx", "date AS start_date", "window", "labels",
        *(["missing"] if count_missing else []),
    )


def last_and_next(indexed: DataFrame, targets: list[str], L: int = WINDOW, H: int = HORIZON,
                  drop_last: bool = True, block_rows: int = BLOCK_ROWS, part: str = "test") -> DataFrame:
    """Of every window its newest target value and the one after: (symbol, start_idx, last_<f>, actual_<f>).

    The same starts as :func:`test_windows`, without building the windows.
    """
    rows = _blocked(indexed.filter(f"part = '{part}'"), L + H, block_rows)
    out = rows.selectExpr(
        "symbol", "part_idx", "part_n", "_blk", "_own_blk",
        *[f"lead({f}, {k}) OVER ({BLOCK_WINDOW}) AS {name}_{f}" for f in targets
          for name, k in (("last", L - 1), ("actual", L))])
    return _starts(out, L, H, drop_last).selectExpr(
        "symbol", "CAST(part_idx AS BIGINT) AS start_idx", *[f"{n}_{f}" for f in targets for n in ("last", "actual")])


def windows_long(windows: DataFrame) -> DataFrame:
    """One row per (symbol, start_idx, step): the five window values and the step label."""
    struct_label = windows.schema["labels"].dataType.elementType.typeName() == "struct"
    label_cols = [f"z.labels.{f} AS label_{f}" for f in FEATURES] if struct_label else ["z.labels AS label"]
    return windows.selectExpr(
        "symbol", "start_idx", "posexplode(arrays_zip(window, labels)) AS (step, z)"
    ).selectExpr(
        "symbol", "start_idx", "CAST(step AS BIGINT) AS step", *[f"z.window.{f} AS {f}" for f in FEATURES],
        *label_cols,
    )


def test_windows_long(windows: DataFrame) -> DataFrame:
    """One row per (symbol, start_idx, step) of test windows; the label repeats on each step."""
    struct_label = windows.schema["label"].dataType.typeName() == "struct"
    label_cols = [f"label.{f} AS label_{f}" for f in FEATURES] if struct_label else ["label"]
    return windows.selectExpr(
        "symbol", "start_idx", "label", "posexplode(window) AS (step, bar)"
    ).selectExpr(
        "symbol", "start_idx", "CAST(step AS BIGINT) AS step", *[f"bar.{f} AS {f}" for f in FEATURES], *label_cols,
    )


def latest_window(indexed: DataFrame, L: int = WINDOW) -> DataFrame:
    """The last L bars of every symbol, normalised, oldest first.

    idx and n are known per row, so the last L rows are a plain filter; the
    group per symbol is bounded by L.
    """
    raw = ", ".join(f"'raw_{f}', {f}" for f in FEATURES)
    normed = ", ".join(f"'{f}', {norm_sql(f)}" for f in FEATURES)
    agg = indexed.filter(f"idx >= n - {L}").groupBy("symbol").agg(
        F.expr(f"sort_array(collect_list(named_struct('idx', idx, 'date', date, {normed}, {raw})))").alias("_bars"),
        F.max("date").alias("as_of"),
        *[F.first(c).alias(c) for c in BOUNDS],
    )
    pick = lambda pre: ", ".join(f"'{f}', b.{pre}{f}" for f in FEATURES)
    return agg.selectExpr(
        "symbol", "as_of",
        f"transform(_bars, b -> named_struct({pick('')})) AS window",
        f"transform(_bars, b -> named_struct({pick('raw_')})) AS raw_window",
        *BOUNDS,
    )


def batch_assignment(windows: DataFrame, batch: int = MINI_BATCH) -> DataFrame:
    """Mini-batches of ``batch`` consecutive windows per symbol; the last one may be short."""
    return (
        windows.selectExpr("symbol", "start_idx", f"CAST(floor(start_idx / {batch}) AS BIGINT) AS batch_id")
        .groupBy("symbol", "batch_id")
        .agg(
            F.count(F.lit(1)).alias("n_windows"),
            F.min("start_idx").cast("long").alias("first_start"),
            F.max("start_idx").cast("long").alias("last_start"),
        )
    )


def export_training_windows(windows: DataFrame, path: str, batch: int = MINI_BATCH) -> None:
    """W4 export: windows with their batch id, one directory per symbol (partition pruning for readers).

    Rows are hash-distributed on (symbol, batch_id) before the write, so a hot
    symbol is written by many tasks and each task writes few directories.
    """
    (
        windows.selectExpr("*", f"CAST(floor(start_idx / {batch}) AS BIGINT) AS batch_id")
        .repartition("symbol", "batch_id")
        .write.mode("overwrite").partitionBy("symbol").parquet(path)
    )


def window_counts(bars: DataFrame, L: int = WINDOW, H: int = HORIZON, ratio: float = SERIES_SPLIT) -> DataFrame:
    """Training examples per symbol, n_train - L - H, clamped at 0 (the plain difference can go negative).

    A count per symbol and arithmetic; the series is not indexed for it.
    """
    counted = bars.filter("symbol IS NOT NULL AND date IS NOT NULL").groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    return counted.selectExpr("symbol", "n", f"{split_sql('n', ratio)} AS n_train").selectExpr(
        "symbol", "CAST(n_train AS BIGINT) AS n_train",
        f"CAST(greatest(n_train - {L + H}, 0) AS BIGINT) AS n_train_windows",
        f"CAST(greatest(n - n_train - {L + H}, 0) AS BIGINT) AS n_test_windows",
    )


def with_lead(indexed: DataFrame, cols: dict[str, Column | str], offset: int = 1, part: str | None = None,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``<name>`` = value of ``cols[name]`` ``offset`` rows later in the same part.

    Uses the same blocked layout as the windows, so the lookup never needs a
    whole-series partition. With ``part=None`` both parts are kept; the lead
    never crosses from train into test. Values may be SQL text or Columns.
    """
    src = indexed if part is None else indexed.filter(f"part = '{part}'")
    rows = _blocked(src, offset, block_rows)
    exprs = []
    for n, c in cols.items():
        if isinstance(c, str):
            exprs.append(F.expr(f"lead({c}, {offset}) OVER ({BLOCK_WINDOW})").alias(n))
        else:
            from pyspark.sql import Window

            w = Window.partitionBy("symbol", "part", "_blk").orderBy("part_idx")
            exprs.append(F.lead(c, offset).over(w).alias(n))
    return rows.select("*", *exprs).filter("_blk = _own_blk").drop("_blk", "_own_blk")
