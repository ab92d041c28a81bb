"""Training that goes on where it stopped."""
import numpy as np
import pytest

from barframe.operators.series import index_series
from barframe.plans import per_symbol as P
from barframe.plans import training as T
from barframe.sources.bars import load_bars


@pytest.fixture(scope="module")
def ix(spark, sf_small):
    return index_series(load_bars(spark, sf_small)).cache()


def test_the_gram_is_the_sum_over_all_windows(ix):
    from barframe.operators.windows import train_windows

    rows = train_windows(ix, "close").selectExpr(f"{P.flat_window_sql()} AS x", "try_element_at(labels, -1) AS y").collect()
    full = np.array([[1.0, *r["x"], r["y"]] for r in rows])
    assert np.allclose(T.window_gram(ix), full.T @ full)
    w = np.random.default_rng(1).normal(size=111) / 50
    assert T.loss(full.T @ full, w) == pytest.approx(np.mean((full[:, -1] - full[:, :-1] @ w) ** 2) + T.L2 / 2 * (w[1:] @ w[1:]))


def test_fifty_and_fifty_equal_a_hundred_also_when_saved_between(spark, ix, tmp_path):
    gram = T.window_gram(ix, L=5)
    whole = T.train(gram, T.start(L=5), 100, report_every=25)
    half = T.train(gram, T.start(L=5), 50, report_every=25)
    T.save_state(spark, half, str(tmp_path / "m"))
    again = T.load_state(spark, str(tmp_path / "m"))
    assert again == half
    rest = T.train(gram, again, 50, report_every=25)
    assert rest == whole and [k for k, _ in whole.losses] == [0, 25, 50, 75, 100]
    T.save_state(spark, rest, str(tmp_path / "m"))
    assert T.load_state(spark, str(tmp_path / "m")) == whole and T.load_state(spark, str(tmp_path / "m"), 50) == half
    with pytest.raises(Exception):
        T.load_state(spark, str(tmp_path / "none"))


def test_training_comes_near_the_least_loss_and_scores(ix):
    gram = T.window_gram(ix, L=5)
    state = T.train(gram, T.start(L=5), 3_000, rate=0.002)
    n, b, w = P.solve_ridge(gram, T.L2 / 2)
    best = T.loss(gram, np.append(b, w))
    assert n == gram[0, 0] and best <= state.losses[-1][1] < best + 0.1 * (state.losses[0][1] - best)
    scored = P.score_per_symbol(ix, T.coefficients(ix, state), L=5).where("prediction IS NULL").count()
    assert scored == 0
    with pytest.raises(ValueError):
        T.train(gram, T.start(L=6), 1)
    with pytest.raises(ValueError):
        T.train(np.zeros((27, 27)), T.start(L=5), 1)


def test_perceptron_of_given_weights_is_the_fitted_one(spark):
    from pyspark.ml.linalg import Vectors

    from barframe.plans import models as M

    rows = [(Vectors.dense([float(i % 7), float(i % 3)]), float(i % 3)) for i in range(60)]
    frame = spark.createDataFrame(rows, ["features", "label"])
    fitted = M._mlp([2, 4, 3], 30).fit(frame)
    again = M.perceptron(spark, [2, 4, 3], fitted.weights.toArray())
    assert np.array_equal(again.weights.toArray(), fitted.weights.toArray())
    assert M.perceptron_scores(again, frame).collect() == M.perceptron_scores(fitted, frame).collect()
    with pytest.raises(ValueError):
        M.perceptron(spark, [2, 4, 3], [0.0])
