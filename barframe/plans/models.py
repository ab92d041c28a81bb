"""MLlib models (M1-M5) and model/vector I/O.

Fitting is MLlib's distributed optimisation (tree-aggregated gradients), so
no data passes through the driver except model coefficients.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import RFormula, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (EPOCHS, FEATURES, L2, MLP_BLOCK, MLP_MAX_ITER, PRICE_CLASS_WIDTH, PRICE_CLASSES,
                      PRICE_MLP_HIDDEN, RANDOM_SPLIT, SEED, WINDOW)
from ..operators.series import denorm
from ..operators.splits import hash_split
from ..operators.windows import target_columns, test_windows, train_windows
from .per_symbol import flat_window_sql, rolled


def _fit(estimator, frame: DataFrame, passes: bool = True):
    """Fit; with ``passes`` the training frame is persisted for the fit, then released.

    Iterative estimators make many passes, and without this each would recompute
    the whole upstream plan. MEMORY_AND_DISK keeps it spill-safe; lost blocks are
    recomputed from lineage. A closed-form fit reads its input about once and
    does not pay for a copy.
    """
    from pyspark import StorageLevel

    if not passes:
        return estimator.fit(frame)

    cached = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(cached)
    finally:
        cached.unpersist()


def price_step(price: Column, width: float = PRICE_CLASS_WIDTH) -> Column:
    """Index of the price step a price lies on, of any sign and size."""
    return F.floor(price / F.lit(float(width))).cast("double")


def price_class(price: Column, width: float = PRICE_CLASS_WIDTH, classes: int = PRICE_CLASSES) -> Column:
    """Price to a class index in [0, classes-1], as MLlib needs it; NULL for a price beyond the classes."""
    step = price_step(price, width)
    return F.when((step >= 0) & (step < classes), step)


def price_class_frame(bars: DataFrame, width: float = PRICE_CLASS_WIDTH, classes: int = PRICE_CLASSES) -> DataFrame:
    """M2 input: feature = open (1-vector), label = class of close.

    Rows that have no class are in :func:`price_class_rejects`, the rest of the bars.
    """
    return bars.select(
        "symbol", "date", "open",
        F.when(F.col("open").isNotNull(), array_to_vector(F.array(F.coalesce("open", F.lit(0.0))))).alias("features"),
        price_class(F.col("close"), width, classes).alias("label"),
    ).filter("features IS NOT NULL AND label IS NOT NULL")


def price_class_rejects(bars: DataFrame, width: float = PRICE_CLASS_WIDTH, classes: int = PRICE_CLASSES) -> DataFrame:
    """Bars that :func:`price_class_frame` leaves out: (symbol, date, open, close, reason)."""
    reason = (F.when(F.col("open").isNull() | F.col("close").isNull(), "no price")
              .when(price_class(F.col("close"), width, classes).isNull(), "beyond the classes"))
    return bars.select("symbol", "date", "open", "close", reason.alias("reason")).filter("reason IS NOT NULL")


def previous_class_predictor(indexed: DataFrame, width: float) -> DataFrame:
    """An exact reference predictor for A6: today's price step predicted as yesterday's (test part)."""
    pairs = indexed.filter("part = 'test' AND idx + 1 < n AND next_close IS NOT NULL")
    return pairs.select(
        "symbol", "date",
        price_step(F.col("close"), width).alias("prediction"),
        price_step(F.col("next_close"), width).alias("label"),
    )


def _mlp(layers: list[int], max_iter: int, seed: int = SEED) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(layers=layers, blockSize=MLP_BLOCK, seed=seed, maxIter=max_iter)


def perceptron(spark: SparkSession, layers: list[int], weights):
    """M2/M3: the perceptron of the given weights, in the order of a fitted model's ``weights``: layer by layer, for each
    input the weights to all outputs, then the outputs' biases. Nothing is trained."""
    sizes = sum((a + 1) * b for a, b in zip(layers, layers[1:]))
    if len(weights) != sizes:
        raise ValueError(f"{len(weights)} weights for layers that take {sizes}")
    row = spark.createDataFrame([(Vectors.dense([0.0] * layers[0]), 0.0)], ["features", "label"])
    untrained = _mlp(layers, 0).setInitialWeights(Vectors.dense([float(w) for w in weights]))
    return untrained.fit(row)


def perceptron_scores(model, frame: DataFrame, digits: int = 6) -> DataFrame:
    """Rows of ``frame`` (features, label) with their predicted class and its probability."""
    top = F.round(F.array_max(vector_to_array("probability")), digits)
    return model.transform(frame).withColumn("top", top).drop("features", "rawPrediction", "probability")


def price_class_mlp(bars: DataFrame, width: float = PRICE_CLASS_WIDTH, classes: int = PRICE_CLASSES,
                    max_iter: int = MLP_MAX_ITER) -> DataFrame:
    """M2: 1-64-32-16-K perceptron on open -> class of close, 60/40 hash split; scored test rows.

    K is one more than the largest class that occurs (at most ``classes``): outputs for classes that no bar has would
    only cost iterations. No bar is lost by it.
    """
    frame = price_class_frame(bars, width, classes)
    classes = int(frame.agg(F.max("label")).first()[0] or 0) + 1
    split = hash_split(frame, F.concat_ws("|", F.col("symbol"), F.col("date").cast("string")), RANDOM_SPLIT, SEED)
    train = split.filter(F.col("part") == "train")
    test = split.filter(F.col("part") == "test")
    model = _fit(_mlp([1, *PRICE_MLP_HIDDEN, max(classes, 2)], max_iter), train.select("features", "label"))
    return model.transform(test).select("symbol", "date", "label", "prediction")


def embedding_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label DOUBLE, features VECTOR) from an array<float> column."""
    return embeddings.select(
        "vec_id", F.col("label").cast("double").alias("label"),
        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
    )


def vector_classifier(embeddings: DataFrame, max_iter: int = MLP_MAX_ITER) -> DataFrame:
    """M3: perceptron (dim-64-32-16-classes) on labelled vectors, 60/40 split; scored test rows."""
    vec = embedding_vectors(embeddings)
    first = embeddings.select(F.size("embedding").alias("d"), "label").agg(
        F.max("d").alias("d"), F.max("label").alias("k")).first()
    dim, classes = int(first["d"]), int(first["k"]) + 1
    split = hash_split(vec, F.col("vec_id"), RANDOM_SPLIT, SEED)
    train = split.filter(F.col("part") == "train")
    test = split.filter(F.col("part") == "test")
    model = _fit(_mlp([dim, *PRICE_MLP_HIDDEN, classes], max_iter), train.select("features", "label"))
    return model.transform(test).select("vec_id", "label", "prediction")


def write_libsvm(vectors: DataFrame, path: str) -> None:
    """(label, features) as LIBSVM text."""
    vectors.select("label", "features").write.mode("overwrite").format("libsvm").save(path)


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """LIBSVM text to (label, features); give ``num_features`` to skip the extra sizing pass."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", str(num_features))
    return r.load(path)


def flat_window(col: str = "window", feats=FEATURES) -> Column:
    """Flatten an ARRAY<STRUCT<features>> window into one vector (step-major)."""
    return array_to_vector(F.expr(flat_window_sql(col, feats)))


def window_training_frame(indexed: DataFrame, category: str = "close", L: int = WINDOW) -> DataFrame:
    """M5 input: flattened train windows, label = normalised target of the day after the window.

    A window with a missing price, or without a label (missing, or a constant
    target), is not trained on; :func:`window_training_rejects` lists those.
    """
    return _window_rows(indexed, category, L).filter("missing = 0 AND label IS NOT NULL").drop("missing")


def _window_rows(indexed: DataFrame, category: str, L: int) -> DataFrame:
    (f,) = _one_target(category)
    tw = train_windows(indexed, f, L=L, count_missing=True)
    return tw.select("symbol", "start_idx", flat_window().alias("features"),
                     F.expr("try_element_at(labels, -1)").alias("label"), "missing")


def window_training_rejects(indexed: DataFrame, category: str = "close", L: int = WINDOW) -> DataFrame:
    """(symbol, start_idx, reason) of train windows that are not trained on."""
    return _window_rows(indexed, category, L).filter("missing > 0 OR label IS NULL").selectExpr(
        "symbol", "start_idx", "CASE WHEN missing > 0 THEN 'missing price' ELSE 'no label' END AS reason")


def _one_target(category: str) -> list[str]:
    cols = target_columns(category)
    if len(cols) != 1:
        raise ValueError("one target at a time; see window_regressor and model_forecast for ALL")
    return cols


def _each_target(category: str, one) -> DataFrame:
    """``one(feature)`` for a single target, or for ALL the union over the five with a ``category`` column."""
    cols = target_columns(category)
    if len(cols) == 1:
        return one(cols[0])
    out = None
    for f in cols:
        part = one(f).withColumn("category", F.lit(f))
        out = part if out is None else out.unionByName(part)
    return out


def fit_window_regressor(train: DataFrame, kind: str = "linear", max_iter: int = EPOCHS):
    """M5 (re-aimed): linear regression with the L2 weight of the reference net, or GBT (``max_iter`` trees)."""
    if kind == "linear":
        est = LinearRegression(solver="normal", regParam=L2, elasticNetParam=0.0)
    elif kind == "gbt":
        from pyspark.ml.regression import GBTRegressor

        est = GBTRegressor(maxIter=max_iter, seed=SEED)
    else:
        raise ValueError(kind)
    return _fit(Pipeline(stages=[est]), train.select("features", "label"), passes=kind != "linear")


def save_model(model: PipelineModel, path: str) -> None:
    """Overwrite-save a fitted pipeline."""
    model.write().overwrite().save(path)


def model_exists(spark: SparkSession, path: str) -> bool:
    """S10 guard: does a saved model directory exist (Hadoop file system, any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline; a corrupt directory raises."""
    return PipelineModel.load(path)


def window_regressor(indexed: DataFrame, category: str = "close", model_dir: str | None = None,
                     kind: str = "linear", L: int = WINDOW) -> DataFrame:
    """M5 + M6: fit on train windows, save/load, score test windows, denormalise next to the actual.

    ALL fits one model per feature and adds a ``category`` column. A window with
    a missing price keeps its row, with a NULL prediction.
    """
    def one(f: str) -> DataFrame:
        model = fit_window_regressor(window_training_frame(indexed, f, L), kind)
        if model_dir:
            path = model_dir if category.lower() != "all" else f"{model_dir}/{f}"
            save_model(model, path)
            model = load_model(path)
        tw = test_windows(indexed, f, L=L, count_missing=True).select(
            "symbol", "start_idx", F.col(f"mn_{f}"), F.col(f"mx_{f}"), F.col("label").alias("actual"),
            flat_window().alias("features"), "missing",
        )
        return model.transform(tw).select(
            "symbol", F.col("start_idx").cast("long").alias("start_idx"),
            F.when(F.col("missing") == 0, denorm(F.col("prediction"), f)).alias("prediction"), "actual",
        )

    return _each_target(category, one)


def _dlit(x: float) -> str:
    """A double as Spark SQL literal text (exponent form is already DOUBLE)."""
    t = repr(float(x))
    return f"CAST({t} AS DOUBLE)" if ("e" in t or "E" in t) else f"{t}D"


def model_forecast(indexed: DataFrame, category: str = "close", steps: int = 1200, L: int = WINDOW,
                   model: PipelineModel | None = None, coef: DataFrame | None = None, feats=FEATURES) -> DataFrame:
    """M10 with fitted window regressors: roll each symbol's latest window forward ``steps`` times.

    Each step scores the window, drops its oldest bar and appends it again with the target replaced by the prediction;
    its cost does not grow with the steps before (:func:`.per_symbol.roll_forward`). The weights are those of one pooled
    linear ``model`` (fitted here unless given), or each symbol's own where ``coef`` is the table of
    :func:`.per_symbol.fit_per_symbol` on ``feats``. Symbols run in parallel.
    Result: (symbol, step, date, prediction) in price units; ALL fits one model
    per feature and adds a ``category`` column. A symbol with fewer than ``L``
    bars, with a price missing in its latest window, or without a model, keeps its steps with NULL predictions.
    """
    from ..functions.calendar import next_trading_days_sql
    from ..operators.windows import latest_window

    if len(target_columns(category)) > 1:
        if model is not None or coef is not None:
            raise ValueError("a given model has one target")
        return _each_target(category, lambda f: model_forecast(indexed, f, steps, L))
    (f,) = target_columns(category)
    if coef is None and tuple(feats) != tuple(FEATURES):
        raise ValueError("the pooled model reads all features")
    no_gap = " AND ".join(f"b.{g} IS NOT NULL" for g in feats)
    latest = latest_window(indexed, L).withColumn("whole", F.expr(
        f"size(window) = {L} AND forall(transform(raw_window, b -> {no_gap}), x -> x)"))
    latest = latest.selectExpr("symbol", "as_of", "window", "whole", f"mn_{f} AS mn", f"mx_{f} AS mx")
    if coef is not None:
        latest = latest.join(coef.select("symbol", "intercept", "weights"), "symbol", "left")
        sql = "coalesce(intercept, 0D)", "weights"
    else:
        lr = (model or fit_window_regressor(window_training_frame(indexed, f, L))).stages[-1]
        sql = _dlit(lr.intercept), "array(" + ", ".join(_dlit(w) for w in lr.coefficients.toArray()) + ")"
    points = (f"transform(zip_with(coalesce(ys, array()), {next_trading_days_sql('as_of', steps)}, "
              "(y, d) -> named_struct('y', y, 'd', d)), (p, i) -> named_struct('step', CAST(i + 1 AS BIGINT), "
              "'date', p.d, 'prediction', p.y * (mx - mn) + mn))")
    return rolled(latest, sql, list(feats).index(f), steps, L, feats).selectExpr("symbol", f"inline({points})")


def rformula_features(bars: DataFrame, formula: str = "close ~ open") -> DataFrame:
    """M4: formula-built (features, label) columns."""
    return RFormula(formula=formula, featuresCol="features", labelCol="label").fit(bars).transform(bars)


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    """M1: columns to one vector; rows with a NULL are skipped instead of failing."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


__all__ = [
    "price_step", "price_class", "price_class_frame", "price_class_rejects", "window_training_rejects", "previous_class_predictor", "price_class_mlp", "embedding_vectors",
    "vector_classifier", "write_libsvm", "read_libsvm", "flat_window", "window_training_frame",
    "fit_window_regressor", "save_model", "model_exists", "load_model", "window_regressor",
    "rformula_features", "assemble", "model_forecast",
]
