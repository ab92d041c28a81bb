"""Scoring and forecasting with a per-symbol AR(1) model.

AR(1): next = a + b * current on the normalised target, fitted per symbol by
``regr_slope`` / ``regr_intercept`` over training pairs (both bars in train).
The coefficient table has one row per symbol, with the symbol's bounds. Bars
meet it by blocks of a series, so no task holds a long one whole. A symbol without
coefficients (too few bars) keeps its rows, with a NULL prediction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (ACTUAL_SERIES, HORIZONS, PREDICT_SERIES, SERIES_NAMES, WINDOW)
from ..functions.calendar import next_trading_days_sql
from ..operators.joins import block_join
from ..operators.series import norm_sql
from ..operators.windows import last_and_next, latest_window, target_columns


def ar1_coefficients(indexed: DataFrame, category: str = "close") -> DataFrame:
    """One row per symbol: c_bars (length of its series) and, for each target, <f>_a (intercept), <f>_b (slope), <f>_n (pairs), c_mn_<f>, c_mx_<f>.

    A single partial/final aggregate per symbol over the training pairs
    (both bars in train), so the fit moves one small row per symbol and task;
    each bar's successor comes from ``index_series`` (``next_<f>``).
    """
    cols = target_columns(category)
    # Pairs with both bars in train; the successor comes with the index (no extra shuffle).
    xs = indexed.filter("idx + 1 < split").selectExpr(
        "symbol", "n", *[f"{m}_{f}" for f in cols for m in ("mn", "mx")], *[f"{norm_sql(f)} AS _x_{f}" for f in cols],
        *[f"try_divide(next_{f} - mn_{f}, mx_{f} - mn_{f}) AS _y_{f}" for f in cols],
    )
    return xs.groupBy("symbol").agg(F.max("n").alias("c_bars"), *[
        e for f in cols for e in (
            F.regr_intercept(f"_y_{f}", f"_x_{f}").alias(f"{f}_a"),
            F.regr_slope(f"_y_{f}", f"_x_{f}").alias(f"{f}_b"),
            F.regr_count(f"_y_{f}", f"_x_{f}").alias(f"{f}_n"),
            F.min(f"mn_{f}").alias(f"c_mn_{f}"),
            F.max(f"mx_{f}").alias(f"c_mx_{f}"),
        )
    ])


def ar1_fit(indexed: DataFrame, category: str = "close") -> DataFrame:
    """(symbol, category, slope, intercept, n_pairs) for each target feature (long form)."""
    cols = target_columns(category)
    wide = ar1_coefficients(indexed, category)
    rows = ", ".join(
        f"named_struct('category', '{f}', 'slope', {f}_b, 'intercept', {f}_a, 'n_pairs', {f}_n)" for f in cols
    )
    return wide.selectExpr("symbol", f"inline(array({rows}))")


def _pred_sql(f: str, z: str) -> str:
    """Denormalised AR(1) prediction from normalised input ``z``."""
    return f"({f}_a + {f}_b * {z}) * (mx_{f} - mn_{f}) + mn_{f}"


def _one_ahead_sql(f: str) -> str:
    """The same from the newest bar's raw value, with the bounds that come with the coefficients."""
    span = f"(c_mx_{f} - c_mn_{f})"
    return f"({f}_a + {f}_b * try_divide(last_{f} - c_mn_{f}, {span})) * {span} + c_mn_{f}"


def _long(cols: list[str], fields) -> str:
    """SQL text of one struct per category, to be inlined."""
    return "array(" + ", ".join(f"named_struct('category', '{f}', {fields(f)})" for f in cols) + ")"


def one_ahead(indexed: DataFrame, category: str = "close", coef: DataFrame | None = None,
              L: int = WINDOW) -> DataFrame:
    """M6/M7: score every test window one day ahead, denormalised, next to the actual.

    One category gives (symbol, start_idx, prediction, actual); ALL gives one
    row per (symbol, start_idx, category, series_name). An AR(1) model reads a
    window's newest bar only, so the windows themselves are not built.
    """
    cols = target_columns(category)
    coef = coef if coef is not None else ar1_coefficients(indexed, category)
    # A window's number is below its series' length, which comes with the coefficients.
    j = block_join(last_and_next(indexed, cols, L=L), coef, "symbol", "start_idx", "c_bars")
    if len(cols) == 1:
        f = cols[0]
        return j.selectExpr("symbol", "start_idx", f"{_one_ahead_sql(f)} AS prediction", f"actual_{f} AS actual")
    rows = _long(cols, lambda f: f"'series_name', '{SERIES_NAMES[f]}', 'prediction', {_one_ahead_sql(f)}, "
                                 f"'actual', actual_{f}")
    return j.selectExpr("symbol", "start_idx", f"inline({rows})")


def prediction_series(scored: DataFrame) -> DataFrame:
    """M8: long (symbol, series, x, y) with x = 0..n-1 in window order, two series."""
    return scored.selectExpr(
        "symbol", "start_idx AS x",
        f"inline(array(named_struct('series', '{PREDICT_SERIES}', 'y', prediction), "
        f"named_struct('series', '{ACTUAL_SERIES}', 'y', actual)))",
    ).select("symbol", "series", "x", "y")


def next_value(indexed: DataFrame, category: str = "close", coef: DataFrame | None = None,
               L: int = WINDOW) -> DataFrame:
    """M9: one denormalised next-day value per symbol from its latest window; ALL gives one per category too."""
    cols = target_columns(category)
    coef = coef if coef is not None else ar1_coefficients(indexed, category)
    j = latest_window(indexed, L).join(coef, "symbol", "left")
    value = lambda f: _pred_sql(f, f"element_at(window, -1).{f}")
    if len(cols) == 1:
        return j.selectExpr("symbol", "as_of", f"{value(cols[0])} AS prediction")
    rows = _long(cols, lambda f: f"'prediction', {value(f)}")
    return j.selectExpr("symbol", "as_of", f"inline({rows})")


def recursive_forecast(indexed: DataFrame, category: str = "close", steps: int = HORIZONS[-1][1],
                       coef: DataFrame | None = None, L: int = WINDOW) -> DataFrame:
    """Roll the one-step model forward ``steps`` times per symbol.

    Each step scores the current window, drops its oldest bar and appends a bar
    whose target is the prediction; with an AR(1) scorer only the newest target
    matters, so step k has a closed form, z_k = b^k z_0 + a (1 - b^k) / (1 - b)
    (z_0 + k a for b = 1): one pass over the steps, linear in their number.
    Symbols run in parallel. Dates come from the trading calendar after the
    last bar.

    Result per symbol: as_of, points ARRAY<STRUCT<step, date, prediction>>; ALL
    gives one row per category too.
    """
    cols = target_columns(category)
    coef = coef if coef is not None else ar1_coefficients(indexed, category)
    lw = latest_window(indexed, L).join(coef, "symbol", "left")

    def points(f: str) -> str:
        # Bound to a lambda variable, the newest value is computed once, not once per step.
        step = (f"CASE WHEN {f}_b = 1 THEN z0 + k * {f}_a "
                f"ELSE pow({f}_b, k) * z0 + {f}_a * (1 - pow({f}_b, k)) / (1 - {f}_b) END")
        zs = f"transform(array(element_at(window, -1).{f}), z0 -> transform(sequence(1, {steps}), k -> {step}))[0]"
        return (f"transform(zip_with({zs}, {next_trading_days_sql('as_of', steps)}, "
                f"(z, d) -> named_struct('z', z, 'd', d)), "
                f"(p, i) -> named_struct('step', CAST(i + 1 AS BIGINT), 'date', p.d, "
                f"'prediction', p.z * (mx_{f} - mn_{f}) + mn_{f}))")

    if len(cols) == 1:
        return lw.selectExpr("symbol", "as_of", f"{points(cols[0])} AS points")
    rows = _long(cols, lambda f: f"'points', {points(f)}")
    return lw.selectExpr("symbol", "as_of", f"inline({rows})")


def forecast_long(fc: DataFrame) -> DataFrame:
    keys = ["symbol", "category"] if "category" in fc.columns else ["symbol"]
    return fc.selectExpr(*keys, "inline(points)").select(*keys, "step", "date", "prediction")


def forecast_payload(fc: DataFrame) -> DataFrame:
    """symbol + five nested horizons, each a prefix of the same forecast; JSON text in ``payload``.

    Points are {prediction, date} with the date stamped 'yyyy-MM-dd HH:mm:00'.
    """
    pts = ("transform(points, p -> named_struct('prediction', p.prediction, "
           "'date', date_format(CAST(p.date AS TIMESTAMP), 'yyyy-MM-dd HH:mm:00')))")
    horizons = ", ".join(f"'{name}', slice(_pts, 1, {n})" for name, n in HORIZONS)
    return fc.selectExpr("symbol", f"{pts} AS _pts").selectExpr(
        "symbol", f"named_struct('symbol', symbol, {horizons}) AS forecast"
    ).selectExpr("symbol", "forecast", "to_json(forecast) AS payload")


def payload_horizons(payload: DataFrame) -> DataFrame:
    """Long form of the payload: (symbol, horizon, step, date, prediction)."""
    hs = ", ".join(f"named_struct('horizon', '{name}', 'pts', forecast.{name})" for name, _ in HORIZONS)
    return payload.selectExpr("symbol", f"inline(array({hs}))").selectExpr(
        "symbol", "horizon", "posexplode(pts) AS (pos, p)"
    ).selectExpr("symbol", "horizon", "CAST(pos + 1 AS BIGINT) AS step", "p.date AS date", "p.prediction AS prediction")
