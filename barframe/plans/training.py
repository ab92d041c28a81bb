"""Iterative training that can go on where it stopped (M5, S9, S10, A7): one pooled linear window regressor by RMSProp.

Squared loss and its gradient are functions of the Gram matrix of (1, x, y), so the windows are read once, by tasks that
sum their own, and every iteration after that is a product with a matrix whose size is that of the model. The state of a
run is the weights, the optimiser's running squares, the iteration, and the losses reported so far; a run that is saved
and loaded goes on as if it had not stopped. Matrices of further windows can be added, so training can go on with them.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURES, L2, WINDOW
from ..operators.windows import train_windows
from .per_symbol import _grams, _matrix, _one, _upper, flat_window_sql

LEARNING_RATE = 0.01
DECAY = 0.95
EPSILON = 1e-8
REPORT_EVERY = 100
# Sums that reach the driver, each of the model's size squared.
PARTS = 64


@dataclass
class State:
    """A run so far. ``weights[0]`` is the intercept; ``squares`` are the optimiser's running squared gradients;
    ``losses`` are (iteration, loss) pairs."""

    category: str
    L: int
    features: tuple
    weights: list
    squares: list
    iteration: int = 0
    losses: list = field(default_factory=list)


def window_gram(indexed: DataFrame, category: str = "close", L: int = WINDOW, feats=FEATURES) -> np.ndarray:
    """The Gram matrix of (1, x, y) over all training windows of all symbols, without a missing price and with a label.

    Summed in tasks, then in ``PARTS`` sums of tasks, and those on the driver: ``PARTS`` matrices of the model's size
    whatever the input. Zeros where there is no window.
    """
    f, size = _one(category), L * len(feats) + 2
    rows = train_windows(indexed, f, L=L, count_missing=True).selectExpr(
        "'all' AS symbol", f"{flat_window_sql('window', feats)} AS x", "try_element_at(labels, -1) AS y", "missing"
    ).filter("missing = 0 AND y IS NOT NULL").drop("missing")

    def total(batches):
        import pyarrow as pa

        out = None
        for b in batches:
            if b.num_rows:
                part = _matrix(b.column(0)).sum(0)
                out = part if out is None else out + part
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], names=["gram"])

    sums = (rows.mapInArrow(_grams, "symbol string, gram array<double>")
            .select("gram", (F.spark_partition_id() % PARTS).alias("part"))
            .repartition(PARTS, "part").select("gram").mapInArrow(total, "gram array<double>"))
    gram = np.zeros((size, size))
    for r in sums.collect():
        gram[_upper(size)] += np.array(r["gram"])
    return np.triu(gram) + np.triu(gram, 1).T


def loss(gram: np.ndarray, weights: np.ndarray, l2: float = L2) -> float:
    """Mean squared error plus the penalty on the weights."""
    n, w = gram[0, 0], np.append(weights, -1.0)
    return float(w @ gram @ w / n + l2 / 2 * (weights[1:] @ weights[1:]))


def start(category: str = "close", L: int = WINDOW, feats=FEATURES) -> State:
    """A run that has not begun: all weights zero."""
    size = L * len(feats) + 1
    return State(_one(category), L, tuple(feats), [0.0] * size, [0.0] * size)


def train(gram: np.ndarray, state: State, iterations: int, rate: float = LEARNING_RATE, decay: float = DECAY,
          l2: float = L2, report_every: int = REPORT_EVERY) -> State:
    """``iterations`` more RMSProp steps; the loss is reported before the first step and at every ``report_every``-th."""
    if gram[0, 0] == 0:
        raise ValueError("no training window")
    w, sq = np.array(state.weights), np.array(state.squares)
    if len(gram) != len(w) + 1:
        raise ValueError("the windows are not those of this model")
    losses, penalty = [tuple(x) for x in state.losses], np.append(0.0, np.full(len(w) - 1, l2))
    if not state.iteration:
        losses = [(0, loss(gram, w, l2))]
    for k in range(state.iteration + 1, state.iteration + iterations + 1):
        g = 2 * (gram[:-1, :-1] @ w - gram[:-1, -1]) / gram[0, 0] + penalty * w
        sq = decay * sq + (1 - decay) * g * g
        w = w - rate * g / (np.sqrt(sq) + EPSILON)
        if k % report_every == 0:
            losses.append((k, loss(gram, w, l2)))
    return State(state.category, state.L, state.features, w.tolist(), sq.tolist(), state.iteration + iterations, losses)


def save_state(spark: SparkSession, state: State, path: str) -> str:
    """The whole state beside those saved before; returns its folder."""
    out = f"{path.rstrip('/')}/iteration={state.iteration:012d}"
    spark.createDataFrame([(json.dumps(asdict(state)),)], "value string").coalesce(1).write.mode("overwrite").text(out)
    return out


def load_state(spark: SparkSession, path: str, iteration: int | None = None) -> State:
    """A saved state, the latest unless an iteration is given; a folder without one raises."""
    found = f"{path.rstrip('/')}/iteration={'*' if iteration is None else f'{iteration:012d}'}"
    texts = [json.loads(r["value"]) for r in spark.read.text(found).collect()]
    latest = max(texts, key=lambda d: d["iteration"])
    return State(**{**latest, "features": tuple(latest["features"]), "losses": [tuple(x) for x in latest["losses"]]})


def coefficients(indexed: DataFrame, state: State) -> DataFrame:
    """The trained weights as a table of models, one row per symbol, as :func:`.per_symbol.score_per_symbol` and
    :func:`.models.model_forecast` take it."""
    return indexed.filter("idx = n - 1").select(
        "symbol", F.lit(state.weights[0]).alias("intercept"), F.lit(list(state.weights[1:])).cast("array<double>").alias("weights"),
        F.col("n").alias("c_bars"))
