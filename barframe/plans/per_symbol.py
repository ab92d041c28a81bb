"""One window regressor per symbol (M5, M6), all symbols fitted at once, and the roll-forward of fitted weights.

A ridge regression needs of its rows only the Gram matrix of (1, x, y). Tasks sum it per symbol over the window blocks
they hold, so a symbol with a third of all windows is summed by many tasks; what moves is one small matrix per symbol
and block, and the matrices of a symbol are summed as they stream by. The solve is a Cholesky factorisation per symbol.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..config import FEATURES, L2, WINDOW
from ..operators.joins import block_join
from ..operators.windows import target_columns, test_windows, train_windows

_COEF = "symbol string, n_windows bigint, intercept double, weights array<double>"


def flat_window_sql(col: str = "window", feats=FEATURES) -> str:
    """Step-major flattening of an ARRAY<STRUCT<features>> window; a constant feature (normalised: NULL) is 0.

    A missing price is NULL too: callers set windows that have one apart by their ``missing`` count.
    """
    return f"flatten(transform({col}, b -> array({', '.join(f'coalesce(b.{f}, 0D)' for f in feats)})))"


def _one(category: str) -> str:
    cols = target_columns(category)
    if len(cols) != 1:
        raise ValueError("one target at a time")
    return cols[0]


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _grams(batches):
    """(symbol, gram of (1, x, y)) for each run of rows of one symbol."""
    symbol, total = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([symbol], pa.string()), pa.array([total[_upper(len(total))]])],
                                          names=["symbol", "gram"])

    for b in batches:
        if not b.num_rows:
            continue
        names = np.array(b.column(0).to_pylist(), object)
        full = np.column_stack([np.ones(len(names)), _matrix(b.column(1)), b.column(2).to_numpy(zero_copy_only=False)])
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = full[lo:hi].T @ full[lo:hi]
            if total is not None and names[lo] == symbol:
                total += part
                continue
            if total is not None:
                yield row()
            symbol, total = names[lo], part
    if total is not None:
        yield row()


def _upper(size: int):
    return np.triu_indices(size)


def solve_ridge(gram: np.ndarray, l2: float) -> tuple[int, float, np.ndarray]:
    """(n, intercept, weights) that minimise mean((y - b - xw)^2) / 2 + l2 / 2 |w|^2, from the Gram matrix of (1, x, y)."""
    n = gram[0, 0]
    mean = gram[0, 1:] / n
    spread = gram[1:, 1:] / n - np.outer(mean, mean)
    low = np.linalg.cholesky(spread[:-1, :-1] + l2 * np.eye(len(mean) - 1))
    w = np.linalg.solve(low.T, np.linalg.solve(low, spread[:-1, -1]))
    return int(round(n)), float(mean[-1] - mean[:-1] @ w), w


def fit_per_symbol(indexed: DataFrame, category: str = "close", L: int = WINDOW, feats=FEATURES, l2: float = L2) -> DataFrame:
    """(symbol, n_windows, intercept, weights, c_bars): a ridge regression per symbol of the normalised next-day target
    on the flattened training windows; ``c_bars`` is the length of the symbol's series.

    Windows with a missing price or without a label are not trained on. A symbol without any is not in the result.
    """
    if l2 <= 0:
        raise ValueError("l2 must be positive")  # a constant feature's column is all zeros
    f = _one(category)
    size = L * len(feats) + 2
    rows = train_windows(indexed, f, L=L, count_missing=True).selectExpr(
        "symbol", f"{flat_window_sql('window', feats)} AS x", "try_element_at(labels, -1) AS y", "missing"
    ).filter("missing = 0 AND y IS NOT NULL").drop("missing")
    grams = rows.mapInArrow(_grams, "symbol string, gram array<double>")

    def solve(batches):
        symbol, total = None, None

        def row():
            gram = np.zeros((size, size))
            gram[_upper(size)] = total
            n, b, w = solve_ridge(np.triu(gram) + np.triu(gram, 1).T, l2)
            return pa.RecordBatch.from_arrays(
                [pa.array([symbol]), pa.array([n]), pa.array([b]), pa.array([w], pa.list_(pa.float64()))],
                names=["symbol", "n_windows", "intercept", "weights"])

        for batch in batches:
            for name, gram in zip(batch.column(0).to_pylist(), _matrix(batch.column(1))):
                if name == symbol:
                    total = total + gram
                    continue
                if total is not None:
                    yield row()
                symbol, total = name, gram
        if total is not None:
            yield row()

    coef = grams.repartition("symbol").sortWithinPartitions("symbol").mapInArrow(solve, _COEF)
    return coef.join(indexed.filter("idx = n - 1").selectExpr("symbol", "n AS c_bars"), "symbol")


def score_per_symbol(indexed: DataFrame, coef: DataFrame, category: str = "close", L: int = WINDOW, feats=FEATURES) -> DataFrame:
    """M6 by each symbol's own model: (symbol, start_idx, prediction, actual) of every test window, in price units. A
    window with a missing price, or of a symbol without a model, keeps its row with a NULL prediction."""
    f = _one(category)
    rows = test_windows(indexed, f, L=L, count_missing=True).selectExpr(
        "symbol", "CAST(start_idx AS BIGINT) AS start_idx", f"mn_{f} AS mn", f"mx_{f} AS mx", "label AS actual",
        f"{flat_window_sql('window', feats)} AS x", "missing")
    z = "intercept + aggregate(zip_with(x, weights, (a, w) -> a * w), 0D, (s, v) -> s + v)"
    return block_join(rows, coef, "symbol", "start_idx", "c_bars").selectExpr(
        "symbol", "start_idx", f"CASE WHEN missing = 0 THEN ({z}) * (mx - mn) + mn END AS prediction", "actual")


def roll_forward(windows: np.ndarray, weights: np.ndarray, intercept: np.ndarray, target: int, steps: int) -> np.ndarray:
    """Predictions (rows x steps) of rolling windows (rows x L x features) forward.

    Each step appends the oldest bar again with its target replaced by the prediction. So the other features go round
    with period L, and what they add to a prediction is known from L sums; the target's last L values are a ring, and a
    step costs L products whatever the number of steps before.
    """
    rows, L, _ = windows.shape
    own, others = weights[:, :, target], np.delete(weights, target, 2)
    rest = np.delete(windows, target, 2)
    forced = np.stack([np.einsum("slf,slf->s", others, np.roll(rest, -k, 1)) for k in range(L)], 1) + intercept[:, None]
    turned = [np.roll(own, k, 1) for k in range(L)]
    ring, out = windows[:, :, target].copy(), np.empty((rows, steps))
    for k in range(steps):
        at = k % L
        y = forced[:, at] + (ring * turned[at]).sum(1)
        ring[:, at] = out[:, k] = y
    return out


def rolled(latest: DataFrame, coef_sql: tuple[str, str], target: int, steps: int, L: int, feats=FEATURES) -> DataFrame:
    """``latest`` (window, whole and other columns) with ``ys``, the normalised predictions of ``steps`` steps; NULL
    where ``whole`` is false or there is no model. ``coef_sql``: SQL text of the intercept and the weights."""
    keep = [c for c in latest.columns if c not in ("window", "raw_window")]
    rows = latest.selectExpr(*keep, f"CASE WHEN whole THEN {flat_window_sql('window', feats)} END AS _x",
                             f"{coef_sql[0]} AS _b", f"{coef_sql[1]} AS _w")
    schema = rows.select(*keep).schema.add("ys", T.ArrayType(T.DoubleType()))
    names = [*keep, "ys"]

    def run(batches):
        for b in batches:
            x, c, w = (b.column(len(keep) + i) for i in range(3))
            good = np.flatnonzero(np.asarray(x.is_valid()) & np.asarray(w.is_valid()))
            ys = [None] * b.num_rows
            if len(good):
                take = pa.array(good)
                found = roll_forward(_matrix(x.take(take)).reshape(len(good), L, len(feats)),
                                     _matrix(w.take(take)).reshape(len(good), L, len(feats)),
                                     c.take(take).to_numpy(zero_copy_only=False), target, steps)
                for i, y in zip(good.tolist(), found):
                    ys[i] = y
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(ys, pa.list_(pa.float64()))], names=names)

    return rows.mapInArrow(run, schema)
