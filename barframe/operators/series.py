"""Series indexing: position, length, split and bounds of every bar, per symbol.

A naive plan would sort each symbol's whole series in one window partition, so a
symbol holding a third of the data would land in one task. Here the series is
cut into calendar buckets (month by default):

1. ``row_number`` inside (symbol, bucket) — a bounded partition;
2. one small aggregate per (symbol, bucket): count plus min/max of every
   feature (partial aggregation, map-side combine);
3. a window over that small table gives each bucket its row offset, the
   series length and the whole-series bounds;
4. one equi-join on (symbol, bucket) brings them back; the big side keeps the
   hash partitioning of step 1, so only the small table moves.

``idx`` is the 0-based position in (date, open, close, low, high, volume)
order, which is a deterministic tie-break for duplicate dates. ``next_<f>``
is the successor bar's feature (NULL for the last bar), from ``lead`` inside
the bucket window or, for a bucket's last row, from the next bucket's first
row carried by the per-bucket table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FEATURES, INDEX_BUCKET, SERIES_SPLIT
from .joins import block_join

ORDER = ("date",) + FEATURES


def _bucket(date_col: str, bucket: str) -> str:
    """Integer calendar bucket (SQL text); NOT NULL whenever the date is, so no null filter is inferred."""
    d = date_col
    if bucket == "year":
        return f"year({d})"
    if bucket == "month":
        return f"year({d}) * 12 + month({d})"
    if bucket == "week":
        return f"floor((unix_date({d}) + 3) / 7)"
    if bucket == "day":
        return f"unix_date({d})"
    raise ValueError(f"unknown bucket {bucket!r}")


def split_sql(n: str, ratio: float) -> str:
    """Rows in the first part: round(n * ratio), halves rounded up (SQL text)."""
    return f"CAST(floor(CAST({n} AS DOUBLE) * {float(ratio)!r}D + 0.5D) AS BIGINT)"


def _mnmx(prefix_in: str, prefix_out: str, over: str = "") -> list[str]:
    return [f"min({prefix_in}{f}){over} AS {prefix_out}mn_{f}" for f in FEATURES] + [
        f"max({prefix_in}{f}){over} AS {prefix_out}mx_{f}" for f in FEATURES
    ]


def index_series(bars: DataFrame, ratio: float = SERIES_SPLIT, bucket: str = INDEX_BUCKET,
                 bounds_on: str = "all") -> DataFrame:
    """Add idx, n, split, part, part_idx, part_n, mn_<f>/mx_<f> bounds and next_<f> (successor bar).

    bounds_on="all" takes bounds over the whole series (train and test, as the
    reference does); "train" takes them over the first part only.
    Expressions are written as SQL text so building the plan costs a handful of
    driver round trips, not one per expression node.
    """
    if bounds_on not in ("all", "train"):
        raise ValueError("bounds_on must be 'all' or 'train'")
    order = ", ".join(ORDER)
    # A bar without symbol or date has no place in a series.
    b = bars.filter("symbol IS NOT NULL AND date IS NOT NULL").selectExpr(
        "*", f"{_bucket('date', bucket)} AS _bucket"
    ).filter("_bucket IS NOT NULL")
    wb = "OVER (PARTITION BY symbol, _bucket)"
    # Rank and bucket statistics come from one window operator over one
    # exchange; the small per-bucket table below is a filter of the same output,
    # so both sides of the join share that exchange and the bars are built once.
    # The successor of each bar (next_<f>) comes from the same windows: the next
    # row of the bucket, or for a bucket's last row the first row of the next
    # bucket (carried by the small per-bucket table). Catalyst prunes these
    # expressions from plans that do not read next_<f>.
    rank_order = f"OVER (PARTITION BY symbol, _bucket ORDER BY {order})"
    local = b.selectExpr(
        "*",
        f"row_number() {rank_order} - 1 AS _rank",
        *[f"lead({f}) {rank_order} AS _nb_{f}" for f in FEATURES],
        f"count(1) {wb} AS _cnt",
        *_mnmx("", "_", f" {wb}"),
    )
    stat_cols = ["_cnt"] + [f"_mn_{f}" for f in FEATURES] + [f"_mx_{f}" for f in FEATURES]
    per_bucket = local.filter("_rank = 0").selectExpr(
        "symbol", "_bucket", *stat_cols, *[f"{f} AS _first_{f}" for f in FEATURES]
    )
    local = local.drop(*stat_cols[1:])
    ws = "OVER (PARTITION BY symbol ORDER BY _bucket ROWS BETWEEN {lo} AND {hi})"
    whole = ws.format(lo="UNBOUNDED PRECEDING", hi="UNBOUNDED FOLLOWING")
    meta = per_bucket.selectExpr(
        "symbol", "_bucket",
        f"coalesce(sum(_cnt) {ws.format(lo='UNBOUNDED PRECEDING', hi='1 PRECEDING')}, 0) AS _offset",
        f"sum(_cnt) {whole} AS n",
        *[f"min(_mn_{f}) {whole} AS mn_{f}" for f in FEATURES],
        *[f"max(_mx_{f}) {whole} AS mx_{f}" for f in FEATURES],
        *[f"lead(_first_{f}) OVER (PARTITION BY symbol ORDER BY _bucket) AS _nf_{f}" for f in FEATURES],
    )
    internal = {"_bucket", "_rank", "_cnt"} | {f"_nb_{f}" for f in FEATURES}
    feat = [c for c in local.columns if c not in internal]
    out = (
        local.join(meta, ["symbol", "_bucket"])
        .selectExpr(*feat, "n", *[f"mn_{f}" for f in FEATURES], *[f"mx_{f}" for f in FEATURES],
                    "CAST(_offset + _rank AS BIGINT) AS idx",
                    f"{split_sql('n', ratio)} AS split",
                    *[f"CASE WHEN _rank = _cnt - 1 THEN _nf_{f} ELSE _nb_{f} END AS next_{f}" for f in FEATURES])
        .selectExpr("*",
                    "CASE WHEN idx < split THEN 'train' ELSE 'test' END AS part",
                    "CASE WHEN idx < split THEN idx ELSE idx - split END AS part_idx",
                    "CASE WHEN idx < split THEN split ELSE n - split END AS part_n")
    )
    if bounds_on == "train":
        tb = out.filter("part = 'train'").groupBy("symbol").agg(F.max("n").alias("_n"), *[F.expr(e) for e in _mnmx("", "")])
        out = out.drop(*[f"mn_{f}" for f in FEATURES], *[f"mx_{f}" for f in FEATURES])
        out = block_join(out, tb, "symbol", "idx", "_n").drop("_n")
    return out


def norm_sql(f: str, bound_of: str | None = None) -> str:
    g = bound_of or f
    return f"try_divide({f} - mn_{g}, mx_{g} - mn_{g})"


def norm(f: str, bound_of: str | None = None) -> Column:
    """(x - min) / (max - min); a constant feature gives NULL instead of 0/0."""
    return F.expr(norm_sql(f, bound_of))


def denorm(value: Column, f: str) -> Column:
    """p * (max - min) + min."""
    return value * F.expr(f"mx_{f} - mn_{f}") + F.col(f"mn_{f}")
