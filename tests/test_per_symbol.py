"""Per-symbol window regressors against NumPy, and the linear roll-forward against a plain fold."""
import datetime as dt
import time

import numpy as np
import pytest

from barframe.config import FEATURES
from barframe.operators.series import index_series
from barframe.plans import models as M
from barframe.plans import per_symbol as P
from barframe.sources.bars import load_bars


@pytest.fixture(scope="module")
def ix(spark):
    rng = np.random.default_rng(3)
    rows = []
    for s, n in (("hot", 900), ("b", 400), ("c", 70), ("short", 12)):
        close = 100 + np.cumsum(rng.normal(size=n))
        for i in range(n):
            o, h = close[i] + rng.normal(), close[i] + 2
            rows.append((dt.date(2015, 1, 1) + dt.timedelta(i), s, float(o), float(close[i]), float(o - 3), float(h),
                         5.0 if s == "c" else float(rng.integers(1, 99))))
    bars = spark.createDataFrame(rows, "date date, symbol string, open double, close double, low double, high double, volume double")
    return index_series(bars.repartition(6)).cache()


def numpy_ridge(x, y, l2):
    xm, ym = x.mean(0), y.mean()
    w = np.linalg.solve((x - xm).T @ (x - xm) / len(x) + l2 * np.eye(x.shape[1]), (x - xm).T @ (y - ym) / len(x))
    return ym - xm @ w, w


def test_coefficients_equal_a_numpy_ridge_for_every_symbol(ix, monkeypatch):
    from barframe.operators import windows as W

    # Small blocks: the long series is summed in many tasks.
    train = W.train_windows
    monkeypatch.setattr(P, "train_windows", lambda *a, **k: train(*a, block_rows=64, **k))
    frame = train(ix, "close", count_missing=True).selectExpr(
        "symbol", f"{P.flat_window_sql()} AS x", "try_element_at(labels, -1) AS y").collect()
    coef = {r["symbol"]: r for r in P.fit_per_symbol(ix).collect()}
    assert set(coef) == {r["symbol"] for r in frame} == {"hot", "b", "c"}
    for s, r in coef.items():
        x, y = np.array([f["x"] for f in frame if f["symbol"] == s]), np.array([f["y"] for f in frame if f["symbol"] == s])
        b, w = numpy_ridge(x, y, P.L2)
        assert r["n_windows"] == len(x) and r["intercept"] == pytest.approx(b, abs=1e-7)
        assert np.allclose(r["weights"], w, atol=1e-7)


def test_a_hot_symbol_is_summed_in_parts(spark, ix):
    from barframe.operators import windows as W

    train = W.train_windows
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = train(ix, "close", block_rows=64).selectExpr("symbol", f"{P.flat_window_sql()} AS x", "try_element_at(labels, -1) AS y")
    parts = rows.mapInArrow(P._grams, "symbol string, gram array<double>").groupBy("symbol").count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r["symbol"]: r["count"] for r in parts}["hot"] > 4


def test_scores_keep_windows_without_a_model(ix):
    coef = P.fit_per_symbol(ix).filter("symbol <> 'b'")
    scored = P.score_per_symbol(ix, coef).collect()
    assert {r["symbol"] for r in scored if r["prediction"] is None} == {"b"}
    hot = [r for r in scored if r["symbol"] == "hot"]
    naive = np.mean([(r["actual"] - 100) ** 2 for r in hot])
    assert len(hot) == 90 - 23 and np.mean([(r["actual"] - r["prediction"]) ** 2 for r in hot]) < naive


def fold(window, w, b, target, steps):
    win, out = [list(x) for x in window], []
    for _ in range(steps):
        y = b + sum(wi * v for wi, v in zip(w, (v for bar in win for v in bar)))
        old = win.pop(0)
        win.append([y if i == target else v for i, v in enumerate(old)])
        out.append(y)
    return out


def test_the_roll_forward_equals_a_fold():
    rng = np.random.default_rng(1)
    for L, feats, target in ((22, 5, 1), (3, 5, 4), (1, 1, 0)):
        x, w, b = rng.random((4, L, feats)), rng.normal(size=(4, L, feats)) / L / feats, rng.normal(size=4)
        got = P.roll_forward(x, w, b, target, 300)
        for s in range(4):
            assert np.allclose(got[s], fold(x[s], w[s].ravel(), b[s], target, 300), atol=1e-9)


def test_forecast_of_pooled_and_own_models_equals_a_fold(spark, ix):
    from barframe.operators.windows import latest_window

    coef = P.fit_per_symbol(ix)
    model = M.fit_window_regressor(M.window_training_frame(ix, "close"))
    lr = model.stages[-1]
    own = {r["symbol"]: (r["intercept"], r["weights"]) for r in coef.collect()}
    last = {r["symbol"]: r for r in latest_window(ix).selectExpr("symbol", f"{P.flat_window_sql()} AS x", "mn_close", "mx_close").collect()}
    for fc, weights in ((M.model_forecast(ix, steps=60, model=model), dict.fromkeys(own, (lr.intercept, lr.coefficients))),
                        (M.model_forecast(ix, steps=60, coef=coef), own)):
        got = {}
        for r in fc.orderBy("symbol", "step").collect():
            got.setdefault(r["symbol"], []).append(r["prediction"])
        assert got["short"] == [None] * 60
        for s, (b, w) in weights.items():
            z = fold(np.array(last[s]["x"]).reshape(22, 5), np.asarray(w), b, FEATURES.index("close"), 60)
            span = last[s]["mx_close"] - last[s]["mn_close"]
            assert np.allclose(got[s], np.array(z) * span + last[s]["mn_close"], rtol=1e-9)


def test_the_roll_forward_is_linear_in_the_steps():
    rng = np.random.default_rng(1)
    x, w, b = rng.random((50, 22, 5)), rng.normal(size=(50, 22, 5)) / 200, rng.normal(size=50)

    def seconds(steps):
        t = time.process_time()
        P.roll_forward(x, w, b, 1, steps)
        return time.process_time() - t

    seconds(100)
    assert min(seconds(10_000) for _ in range(3)) < 16 * min(seconds(1_200) for _ in range(3))


def test_pooled_forecast_needs_all_features(spark, sf_small):
    with pytest.raises(ValueError):
        M.model_forecast(index_series(load_bars(spark, sf_small)), "close", steps=3, L=2, feats=("close",))
