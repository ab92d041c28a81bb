"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (bars come from ``orders``, documents
and requests from ``events``, vectors from ``embeddings``) so its work grows
with them. SQL twins live in ``oracle.py`` under the same keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURES, HORIZONS, shared_dir
from ..functions import calendar as C
from ..operators import clean, mutate, normalize, splits, stats
from ..operators import windows as W
from ..operators.series import index_series
from ..sources import bars as B
from ..sources import documents as D
from . import forecast as FC
from . import oracle as O

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the fixture queries.
FILTER_SYMBOL = "3-MEDIUM"
DOC_FIELD = "open"
DOC_OLD = "6.55"
DOC_NEW = "0"
BAD_JSON = "{bad"
STORE_FIRST = "click"
STORE_ALL = "error"
STORE_GONE = "signup"
SMALL_L2 = 1e-4
BUCKETS = 8
CLASS_WIDTH = 5000.0
CLASS_COUNT = 120
# Perceptrons of given weights: hidden units, input and output units, and a scale that brings prices to order one.
SCORE_HIDDEN, VECTOR_DIM, VECTOR_CLASSES, PRICE_SCALE = 8, 64, 16, 1e-5
LIBSVM_DIM = 64


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def indexed_bars(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return index_series(B.load_bars(spark, sf_dir), **kw)


def r(c, n):
    return F.round(F.col(c), n).alias(c)


# ---- sources, projections -------------------------------------------------

def q_preview(spark, sf_dir):
    return B.load_bars(spark, sf_dir).orderBy("symbol", "date").limit(20)


def q_typed_bars(spark, sf_dir):
    return B.typed_bars(B.bars_as_text(B.load_bars(spark, sf_dir)))


def q_csv_bars_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "bars-csv")
    B.write_bars_csv(B.load_bars(spark, sf_dir), path)
    return B.read_bars_csv(spark, path)


def q_alt_layout_bars(spark, sf_dir):
    from ..config import LAYOUT_2

    path = shared_dir(spark, "bars-csv-alt")
    B.write_bars_csv(B.load_bars(spark, sf_dir), path, LAYOUT_2)
    return B.read_alt_bars_csv(spark, path).select("symbol", "date", *FEATURES)


def q_symbol_filter(spark, sf_dir):
    return clean.symbol_filter(B.load_bars(spark, sf_dir), FILTER_SYMBOL)


def q_drop_null_rows(spark, sf_dir):
    text = B.bars_as_text(B.load_bars(spark, sf_dir)).select("symbol", "date", "open", "close")
    typed = clean.parse_prices(text, ["open", "close"]).withColumn("date", F.col("date").cast("date"))
    return clean.drop_null_rows(typed, ["open", "close"])


def q_category_long(spark, sf_dir):
    return clean.category_long(B.load_bars(spark, sf_dir), "all")


# ---- aggregates -------------------------------------------------------------

def q_symbol_counts(spark, sf_dir):
    return stats.symbol_counts(B.load_bars(spark, sf_dir))


def q_num_symbols(spark, sf_dir):
    return stats.num_symbols(B.load_bars(spark, sf_dir))


def q_feature_bounds(spark, sf_dir):
    return stats.feature_bounds(B.load_bars(spark, sf_dir))


def q_bounds_by_category(spark, sf_dir):
    return stats.bounds_by_category(B.load_bars(spark, sf_dir), "all")


def q_window_counts(spark, sf_dir):
    return W.window_counts(B.load_bars(spark, sf_dir))


# ---- normalisation, splits -------------------------------------------------

def q_normalized_bars(spark, sf_dir):
    return normalize.normalized_bars(indexed_bars(spark, sf_dir)).withColumn("idx", F.col("idx").cast("long"))


def q_normalized_bars_train_bounds(spark, sf_dir):
    ix = indexed_bars(spark, sf_dir, bounds_on="train")
    return normalize.normalized_bars(ix).withColumn("idx", F.col("idx").cast("long"))


def q_global_minmax(spark, sf_dir):
    g = normalize.global_minmax(B.load_bars(spark, sf_dir))
    return g.select("symbol", "date", *[r(c, 9) for c in normalize.PROFILE_ORDER])


def q_denormalize_roundtrip(spark, sf_dir):
    return normalize.denormalize_roundtrip(indexed_bars(spark, sf_dir))


def q_hash_split(spark, sf_dir):
    bars = B.load_bars(spark, sf_dir).select("symbol", "date")
    key = F.concat_ws("|", F.col("symbol"), F.col("date").cast("string"))
    return splits.hash_split(bars, key)


def q_chrono_split(spark, sf_dir):
    return splits.chrono_split(indexed_bars(spark, sf_dir))


# ---- windows ------------------------------------------------------------------

def q_test_windows(spark, sf_dir):
    return W.test_windows_long(W.test_windows(indexed_bars(spark, sf_dir), "close"))


def q_test_windows_all(spark, sf_dir):
    return W.test_windows_long(W.test_windows(indexed_bars(spark, sf_dir), "all"))


def q_train_windows_long(spark, sf_dir):
    return W.windows_long(W.train_windows(indexed_bars(spark, sf_dir), "close"))


def q_train_windows_all(spark, sf_dir):
    return W.windows_long(W.train_windows(indexed_bars(spark, sf_dir), "all"))


def _gappy_bars(spark, sf_dir):
    """Bars with the close of every seventh day of a month missing."""
    return B.load_bars(spark, sf_dir).withColumn("close", F.expr("CASE WHEN day(date) % 7 <> 0 THEN close END"))


def q_train_windows_nulls(spark, sf_dir):
    return W.windows_long(W.train_windows(index_series(_gappy_bars(spark, sf_dir)), "close"))


def q_latest_window(spark, sf_dir):
    lw = W.latest_window(indexed_bars(spark, sf_dir))
    return lw.select("symbol", F.posexplode("window").alias("step", "bar")).select(
        "symbol", F.col("step").cast("long").alias("step"), *[F.col(f"bar.{f}").alias(f) for f in FEATURES]
    )


def q_batch_assignment(spark, sf_dir):
    return W.batch_assignment(W.train_windows(indexed_bars(spark, sf_dir), "close"))


# ---- calendar -----------------------------------------------------------------

def q_holiday_flag(spark, sf_dir):
    bars = B.load_bars(spark, sf_dir).select("symbol", "date")
    return bars.select("symbol", "date", C.is_holiday("date").alias("is_holiday"),
                       C.is_weekend("date").alias("is_weekend"))


def q_weekday_names(spark, sf_dir):
    bars = B.load_bars(spark, sf_dir).select("symbol", "date")
    return bars.select(
        "symbol", "date", C.weekday_name("date").alias("weekday_name"),
        C.weekday_number("date").cast("long").alias("weekday_number"),
        C.minute_stamp(F.col("date").cast("timestamp")).alias("stamp"),
    )


def q_trading_calendar(spark, sf_dir):
    n = HORIZONS[-1][1]
    last = B.load_bars(spark, sf_dir).groupBy("symbol").agg(F.max("date").alias("as_of"))
    return last.select("symbol", F.posexplode(C.next_trading_days("as_of", n)).alias("pos", "date")).select(
        "symbol", (F.col("pos") + 1).cast("long").alias("step"), "date"
    )


# ---- models and forecasts -------------------------------------------------------

def q_ar1_fit(spark, sf_dir):
    co = FC.ar1_fit(indexed_bars(spark, sf_dir), "all")
    return co.select("symbol", "category", r("slope", 6), r("intercept", 6), F.col("n_pairs").cast("long"))


def q_close_on_open_fit(spark, sf_dir):
    bars = B.load_bars(spark, sf_dir)
    return bars.groupBy("symbol").agg(
        F.round(F.regr_slope("close", "open"), 6).alias("slope"),
        F.round(F.regr_intercept("close", "open"), 2).alias("intercept"),
        F.regr_count("close", "open").cast("long").alias("n"),
    )


def _one_ahead(spark, sf_dir):
    return FC.one_ahead(indexed_bars(spark, sf_dir), "close")


def q_one_ahead(spark, sf_dir):
    return _one_ahead(spark, sf_dir).select("symbol", "start_idx", r("prediction", 2), "actual")


def q_one_ahead_all(spark, sf_dir):
    return FC.one_ahead(indexed_bars(spark, sf_dir), "all").select(
        "symbol", "start_idx", "category", "series_name", r("prediction", 2), "actual"
    )


def q_prediction_series(spark, sf_dir):
    return FC.prediction_series(_one_ahead(spark, sf_dir)).select("symbol", "series", "x", r("y", 2))


def q_chart_bounds(spark, sf_dir):
    return stats.chart_bounds(_one_ahead(spark, sf_dir))


def q_forecast_mse(spark, sf_dir):
    return stats.mse(_one_ahead(spark, sf_dir)).select("symbol", r("mse", 0), "n")


def q_next_value(spark, sf_dir):
    return FC.next_value(indexed_bars(spark, sf_dir), "close").select("symbol", "as_of", r("prediction", 2))


def q_next_value_all(spark, sf_dir):
    return FC.next_value(indexed_bars(spark, sf_dir), "all").select("symbol", "as_of", "category", r("prediction", 2))


def q_recursive_forecast_all(spark, sf_dir):
    fc = FC.recursive_forecast(indexed_bars(spark, sf_dir), "all")
    return FC.forecast_long(fc).select("symbol", "category", "step", "date", r("prediction", 2))


def _forecast(spark, sf_dir):
    return FC.recursive_forecast(indexed_bars(spark, sf_dir), "close")


def q_recursive_forecast(spark, sf_dir):
    return FC.forecast_long(_forecast(spark, sf_dir)).select("symbol", "step", "date", r("prediction", 2))


def q_forecast_payload(spark, sf_dir):
    p = FC.forecast_payload(_forecast(spark, sf_dir))
    mx = F.col("forecast.max")
    prefix = F.lit(True)
    for name, n in HORIZONS[:-1]:
        prefix = prefix & (F.col(f"forecast.{name}") == F.slice(mx, 1, n))
    return p.select(
        "symbol",
        *[F.size(f"forecast.{name}").cast("long").alias(f"{name}_n") for name, _ in HORIZONS],
        F.element_at(mx, 1)["date"].alias("first_date"),
        F.element_at(mx, -1)["date"].alias("last_date"),
        prefix.alias("prefix_ok"),
        F.round(F.aggregate(mx, F.lit(0.0), lambda acc, x: acc + x["prediction"]), 0).alias("sum_max"),
        F.get_json_object("payload", "$.symbol").alias("json_symbol"),
    )


def q_forecast_horizons(spark, sf_dir):
    p = FC.forecast_payload(_forecast(spark, sf_dir))
    return FC.payload_horizons(p).select("symbol", "horizon", "step", "date", r("prediction", 2))


def q_price_class_labels(spark, sf_dir):
    from . import models as M

    return M.price_class_frame(B.load_bars(spark, sf_dir), CLASS_WIDTH, CLASS_COUNT).select(
        "symbol", "date", "open", F.col("label")
    )


def q_accuracy(spark, sf_dir):
    from . import models as M

    return stats.accuracy(M.previous_class_predictor(indexed_bars(spark, sf_dir), CLASS_WIDTH))


def q_price_class_rejects(spark, sf_dir):
    from . import models as M

    # A narrower ladder than the classifier's, so that it has an end within the prices.
    return M.price_class_rejects(_gappy_bars(spark, sf_dir), CLASS_WIDTH, CLASS_COUNT // 2)


def q_price_class_split(spark, sf_dir):
    from . import models as M
    from ..config import RANDOM_SPLIT, SEED

    frame = M.price_class_frame(B.load_bars(spark, sf_dir), CLASS_WIDTH, CLASS_COUNT)
    key = F.concat_ws("|", F.col("symbol"), F.col("date").cast("string"))
    return splits.hash_split(frame, key, RANDOM_SPLIT, SEED).select("symbol", "date", "label", "part")


def q_window_regressor_frame(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    from . import models as M

    frame = M.window_training_frame(index_series(_gappy_bars(spark, sf_dir)), "close")
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return frame.select("symbol", F.col("start_idx").cast("long").alias("start_idx"), r("label", 9),
                        F.round(total, 6).alias("feature_sum"))


def q_model_forecast_keys(spark, sf_dir):
    return q_model_forecast(spark, sf_dir).select("symbol", "step", "date", F.col("prediction").isNotNull().alias("scored"))


def _classifier_report(scored):
    return stats.accuracy(scored.withColumn("symbol", F.lit("all"))).selectExpr(
        "n", "accuracy BETWEEN 0 AND 1 AS in_range")


def q_price_class_accuracy(spark, sf_dir):
    return _classifier_report(q_price_class_mlp(spark, sf_dir))


def q_vector_classifier_accuracy(spark, sf_dir):
    return _classifier_report(q_vector_classifier(spark, sf_dir))


def _small_models(spark, sf_dir):
    """Each symbol's own model of the next close on the last two closes (small enough to be solved in SQL too)."""
    from . import per_symbol as P

    ix = indexed_bars(spark, sf_dir)
    return ix, P.fit_per_symbol(ix, "close", L=2, feats=("close",), l2=SMALL_L2)


def q_symbol_regressor_fit(spark, sf_dir):
    _, coef = _small_models(spark, sf_dir)
    return coef.selectExpr("symbol", "n_windows", "round(intercept, 7) AS intercept", "round(weights[0], 7) AS w0",
                           "round(weights[1], 7) AS w1")


def q_symbol_regressor_scores(spark, sf_dir):
    from . import per_symbol as P

    ix, coef = _small_models(spark, sf_dir)
    return P.score_per_symbol(ix, coef, "close", L=2, feats=("close",)).select(
        "symbol", "start_idx", r("prediction", 2), "actual")


def q_symbol_forecast(spark, sf_dir):
    """Every symbol's latest window rolled forward by the symbol's own model."""
    from . import models as M

    ix, coef = _small_models(spark, sf_dir)
    return M.model_forecast(ix, "close", L=2, coef=coef, feats=("close",)).select(
        "symbol", "step", "date", r("prediction", 2))


def q_training_losses(spark, sf_dir):
    """Losses of 30 and, from the saved state, 20 more iterations of the next close on the last one. (Once near the least
    loss, steps of a fixed rate turn around it, and rounding decides where they are.)"""
    from . import training as TR

    gram = TR.window_gram(indexed_bars(spark, sf_dir), "close", L=1, feats=("close",))
    path = shared_dir(spark, "training")
    TR.save_state(spark, TR.train(gram, TR.start("close", 1, ("close",)), 30, report_every=10), path)
    state = TR.train(gram, TR.load_state(spark, path), 20, report_every=10)
    return spark.createDataFrame([(k, round(x, 7)) for k, x in state.losses], "iteration long, loss double")


def q_symbol_regressor(spark, sf_dir):
    """Each symbol's own model over whole windows of 22 days and five features."""
    from . import per_symbol as P

    ix = indexed_bars(spark, sf_dir)
    return P.score_per_symbol(ix, P.fit_per_symbol(ix, "close"), "close")


def _ruled_weights(inputs: int, classes: int, scale: float) -> list[float]:
    """Weights of a rule that SQL can follow, those on the inputs times ``scale``."""
    n = (inputs + 1) * SCORE_HIDDEN + (SCORE_HIDDEN + 1) * classes
    return [(i * 7919 % 2003 / 1001.5 - 1.0) * (scale if i < inputs * SCORE_HIDDEN else 1.0) for i in range(n)]


def q_price_class_scores(spark, sf_dir):
    """M2: every bar scored by a perceptron of given weights."""
    from . import models as M

    model = M.perceptron(spark, [1, SCORE_HIDDEN, CLASS_COUNT], _ruled_weights(1, CLASS_COUNT, PRICE_SCALE))
    frame = M.price_class_frame(B.load_bars(spark, sf_dir), CLASS_WIDTH, CLASS_COUNT)
    return M.perceptron_scores(model, frame).select("symbol", "date", "label", "prediction", "top")


def q_vector_classifier_scores(spark, sf_dir):
    """M3: every vector scored by a perceptron of given weights."""
    from . import models as M

    vectors = M.embedding_vectors(_t(spark, sf_dir, "embeddings"))
    model = M.perceptron(spark, [VECTOR_DIM, SCORE_HIDDEN, VECTOR_CLASSES], _ruled_weights(VECTOR_DIM, VECTOR_CLASSES, 1.0))
    return M.perceptron_scores(model, vectors).select("vec_id", "label", "prediction", "top")


def q_price_class_mlp(spark, sf_dir):
    from . import models as M

    return M.price_class_mlp(B.load_bars(spark, sf_dir), CLASS_WIDTH, CLASS_COUNT)


def q_vector_classifier(spark, sf_dir):
    from . import models as M

    return M.vector_classifier(_t(spark, sf_dir, "embeddings"))


def q_window_regressor(spark, sf_dir):
    from . import models as M

    return M.window_regressor(indexed_bars(spark, sf_dir), "close", model_dir=shared_dir(spark, "window-model"))


def q_model_forecast(spark, sf_dir):
    from . import models as M

    return M.model_forecast(indexed_bars(spark, sf_dir), "close")


def q_libsvm_roundtrip(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    from . import models as M

    emb = _t(spark, sf_dir, "embeddings")
    dim = LIBSVM_DIM
    path = shared_dir(spark, "libsvm")
    M.write_libsvm(M.embedding_vectors(emb), path)
    back = M.read_libsvm(spark, path, dim).select("label", vector_to_array("features").alias("_v"))
    return back.select("label", *[F.col("_v")[i].alias(f"f{i}") for i in range(dim)])


# ---- documents ------------------------------------------------------------------

def _docs(spark, sf_dir):
    return D.documents_from_events(_t(spark, sf_dir, "events"))


def q_docs_scan(spark, sf_dir):
    path = shared_dir(spark, "docs")
    D.write_collection(_docs(spark, sf_dir), path)
    return D.read_collection(spark, path)


def q_json_insert(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select(F.col("event_id"), F.col("props").alias("text"))
    bad = ev.groupBy().agg((F.max("event_id") + 1).alias("event_id")).select("event_id", F.lit(BAD_JSON).alias("text"))
    return D.insert_json(ev.unionByName(bad), "text").selectExpr(
        "event_id", "try_cast(fields['k'] AS BIGINT) AS k", "status")


def q_json_store(spark, sf_dir):
    """The collection after an insert: the stored event documents and the objects appended to them."""
    path, rejects = shared_dir(spark, "docs"), shared_dir(spark, "doc-rejects")
    D.write_collection(_docs(spark, sf_dir), path)
    text = _docs(spark, sf_dir).select(F.to_json(F.struct("open", F.concat(F.lit("new-"), F.col("id")).alias("id"))).alias("text"))
    D.store_json(text.unionByName(spark.range(1).select(F.lit(BAD_JSON).alias("text"))), path, rejects)
    return D.read_collection(spark, path)


def q_bar_rejects(spark, sf_dir):
    """CSV lines that hold no bar: the orders' bars with every seventh day of a month cut short or undated."""
    path = shared_dir(spark, "bars-csv-bad")
    bars = B.load_bars(spark, sf_dir)
    line = F.expr("CASE WHEN day(date) % 14 = 7 THEN concat_ws(',', date, symbol)"
                  " WHEN day(date) % 14 = 0 THEN concat_ws(',', 'someday', symbol, 1, 2, 3, 4, 5)"
                  " ELSE concat_ws(',', date, symbol, open, close, low, high, volume) END")
    bars.select(line.alias("value")).write.text(path)
    good, bad = B.read_bars_csv_checked(spark, path, header=False)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).unionByName(
        good.agg(F.lit("bar").alias("reason"), F.count(F.lit(1)).alias("n")))


def q_record_append(spark, sf_dir):
    bars = B.load_bars(spark, sf_dir)
    recs = bars.select(F.array(
        F.col("date").cast("string"), *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")],
        F.concat(F.lit("bar-"), F.col("symbol")),
    ).alias("record"))
    return D.append_records(_docs(spark, sf_dir), recs)


def q_update_first_match(spark, sf_dir):
    return mutate.update_by(_docs(spark, sf_dir), DOC_FIELD, DOC_OLD, DOC_NEW)


def q_update_all_matches(spark, sf_dir):
    return mutate.update_by(_docs(spark, sf_dir), DOC_FIELD, DOC_OLD, DOC_NEW, multi=True)


def q_delete_by_field(spark, sf_dir):
    return mutate.remove_by(_docs(spark, sf_dir), DOC_FIELD, DOC_OLD)


def q_nth_trading_day(spark, sf_dir):
    """For every event the (user_id % 250 + 1)-th trading day after it, in one of two calendars."""
    from ..functions import trading_days as TD

    holidays = TD.fixed_holidays(spark, "fixed").unionByName(
        spark.sql("SELECT 'none' AS calendar, CAST(NULL AS STRING) AS month_day, CAST(NULL AS DATE) AS date"))
    days = TD.trading_days(holidays, "2023-12-01", "2026-01-31")
    ev = _t(spark, sf_dir, "events").selectExpr("event_id", "CAST(ts AS DATE) AS as_of", "user_id % 250 + 1 AS n",
                                                "IF(user_id % 2 = 0, 'fixed', 'none') AS calendar")
    return TD.nth_trading_day(ev, days, "as_of", "n")


def q_maintained_stats(spark, sf_dir):
    """Bounds, length and split of each series, kept up to date over three arrivals of bar files."""
    from ..streaming import maintained as MT

    base = shared_dir(spark, "maintained")
    bars = B.load_bars(spark, sf_dir)
    for cond in ("year(date) < 1994", "year(date) BETWEEN 1994 AND 1996", "year(date) > 1996"):
        bars.where(cond).write.mode("append").parquet(f"{base}/bars")
        MT.update(spark, f"{base}/bars", f"{base}/stats", f"{base}/checkpoint")
    return MT.symbol_stats(MT.merged(spark, f"{base}/stats"))


def q_bucketed_bars(spark, sf_dir):
    """Bars and their symbol's bounds from two bucketed tables, joined where they lie."""
    base = shared_dir(spark, "bucketed")
    names = [f"bars_{base.rsplit('-', 1)[1]}", f"bounds_{base.rsplit('-', 1)[1]}"]
    B.write_bucketed_bars(B.load_bars(spark, sf_dir), names[0], f"{base}/bars", BUCKETS)
    bars = B.read_bucketed_bars(spark, names[0])
    highest = bars.groupBy("symbol").agg(F.max("high").alias("top"), F.max("date").alias("date"))
    B.write_bucketed_bars(highest, names[1], f"{base}/bounds", BUCKETS)
    tops = B.read_bucketed_bars(spark, names[1]).select("symbol", "top")
    return bars.join(tops, "symbol").selectExpr("symbol", "date", "close", "top", "high = top AS is_top")


def _typed_text(spark, sf_dir) -> DataFrame:
    """(k, text): every event as a JSON object of text fields, a number and a nested object; last a text that is none."""
    ev = _t(spark, sf_dir, "events").select(
        F.col("event_id").alias("k"),
        F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("value").cast("string").alias("open"),
                           F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("kind"),
                           F.struct(F.col("user_id").alias("user"), (F.col("user_id") % 2 == 0).alias("even")).alias("by")
                           )).alias("text"))
    return ev.unionByName(ev.groupBy().agg((F.max("k") + 1).alias("k")).select("k", F.lit(BAD_JSON).alias("text")))


def q_store_typed(spark, sf_dir):
    """Objects as they went into the store, read by typed paths, and how many texts were no objects."""
    from ..sources import store as S

    store = S.DocumentStore(spark, shared_dir(spark, "store"))
    store.insert_json(_typed_text(spark, sf_dir), order="k")
    docs = store.read().select(S.field("id", "bigint").alias("id"), S.field("open", "double").alias("price"),
                               S.field("by.user", "bigint").alias("user"), S.field("by.even", "boolean").alias("even"),
                               S.field("by.no").alias("missing"), F.to_json("doc").alias("text"))
    rejected = store.rejects().select(F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("double").alias("price"),
                                      F.lit(None).cast("bigint").alias("user"), F.lit(None).cast("boolean").alias("even"),
                                      F.lit(None).cast("string").alias("missing"), F.col("raw").alias("text"))
    return docs.unionByName(rejected)


def q_store_chain(spark, sf_dir):
    """Insert JSON, append records, update the first match, update all, delete: the store's last version."""
    from ..sources import store as S

    store = S.DocumentStore(spark, shared_dir(spark, "store"))
    store.insert_json(_typed_text(spark, sf_dir), order="k")
    recs = B.load_bars(spark, sf_dir).select("symbol", "date", F.array(
        F.col("date").cast("string"), *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")],
        F.concat(F.lit("bar-"), F.col("symbol"))).alias("record"))
    store.insert(S.records(recs), order=["symbol", "date"])
    store.update("kind", STORE_FIRST, "first")
    store.update("kind", STORE_ALL, "all", multi=True)
    store.remove_by("kind", STORE_GONE)
    store.remove(DOC_OLD)
    return store.read().select(*[S.field(c).alias(c) for c in ("date", "open", "high", "id", "kind")],
                               S.field("by.user", "bigint").alias("user"))


# ---- requests -------------------------------------------------------------------

def q_request_forecasts(spark, sf_dir):
    from ..streaming import requests as K

    req = K.requests_from_events(_t(spark, sf_dir, "events"), _t(spark, sf_dir, "orders"))
    path = shared_dir(spark, "forecasts")
    FC.forecast_payload(_forecast(spark, sf_dir)).write.parquet(path)
    return K.answer(req, spark.read.parquet(path)).select(
        "request_id", "symbol", "first_date", r("first_prediction", 2), "n_points"
    )


def q_stream_forecast_responses(spark, sf_dir):
    from ..streaming import requests as K

    sink, fc_dir = K.run_request_stream(spark, sf_dir)
    # Each stored payload is read back as JSON once, whatever the number of requests that it answers.
    parsed = K.forecasts(spark, fc_dir).selectExpr(
        "symbol", "version",
        "from_json(payload, 'max ARRAY<STRUCT<prediction: DOUBLE, date: STRING>>').max AS pts",
    ).selectExpr("symbol", "version", "pts[0].date AS first_date",
                 "round(pts[0].prediction, 2) AS first_prediction", "size(pts) AS n_points")
    return K.references(spark, sink).join(parsed, ["symbol", "version"], "left").select(
        "request_id", "symbol", "first_date", "first_prediction", "n_points")


QUERIES: dict[str, Query] = {
    "preview": q_preview,
    "typed_bars": q_typed_bars,
    "csv_bars_roundtrip": q_csv_bars_roundtrip,
    "alt_layout_bars": q_alt_layout_bars,
    "symbol_filter": q_symbol_filter,
    "drop_null_rows": q_drop_null_rows,
    "category_long": q_category_long,
    "symbol_counts": q_symbol_counts,
    "num_symbols": q_num_symbols,
    "feature_bounds": q_feature_bounds,
    "bounds_by_category": q_bounds_by_category,
    "window_counts": q_window_counts,
    "normalized_bars": q_normalized_bars,
    "normalized_bars_train_bounds": q_normalized_bars_train_bounds,
    "global_minmax": q_global_minmax,
    "denormalize_roundtrip": q_denormalize_roundtrip,
    "hash_split": q_hash_split,
    "chrono_split": q_chrono_split,
    "test_windows": q_test_windows,
    "test_windows_all": q_test_windows_all,
    "train_windows_long": q_train_windows_long,
    "train_windows_all": q_train_windows_all,
    "train_windows_nulls": q_train_windows_nulls,
    "latest_window": q_latest_window,
    "batch_assignment": q_batch_assignment,
    "holiday_flag": q_holiday_flag,
    "weekday_names": q_weekday_names,
    "trading_calendar": q_trading_calendar,
    "ar1_fit": q_ar1_fit,
    "close_on_open_fit": q_close_on_open_fit,
    "one_ahead": q_one_ahead,
    "one_ahead_all": q_one_ahead_all,
    "prediction_series": q_prediction_series,
    "chart_bounds": q_chart_bounds,
    "forecast_mse": q_forecast_mse,
    "next_value": q_next_value,
    "next_value_all": q_next_value_all,
    "recursive_forecast": q_recursive_forecast,
    "recursive_forecast_all": q_recursive_forecast_all,
    "forecast_payload": q_forecast_payload,
    "forecast_horizons": q_forecast_horizons,
    "price_class_labels": q_price_class_labels,
    "price_class_rejects": q_price_class_rejects,
    "price_class_split": q_price_class_split,
    "accuracy": q_accuracy,
    "price_class_accuracy": q_price_class_accuracy,
    "price_class_scores": q_price_class_scores,
    "vector_classifier_scores": q_vector_classifier_scores,
    "vector_classifier_accuracy": q_vector_classifier_accuracy,
    "window_regressor_frame": q_window_regressor_frame,
    "model_forecast_keys": q_model_forecast_keys,
    "price_class_mlp": q_price_class_mlp,
    "vector_classifier": q_vector_classifier,
    "window_regressor": q_window_regressor,
    "symbol_regressor_fit": q_symbol_regressor_fit,
    "symbol_regressor_scores": q_symbol_regressor_scores,
    "symbol_forecast": q_symbol_forecast,
    "symbol_regressor": q_symbol_regressor,
    "training_losses": q_training_losses,
    "model_forecast": q_model_forecast,
    "libsvm_roundtrip": q_libsvm_roundtrip,
    "docs_scan": q_docs_scan,
    "json_insert": q_json_insert,
    "json_store": q_json_store,
    "nth_trading_day": q_nth_trading_day,
    "maintained_stats": q_maintained_stats,
    "bucketed_bars": q_bucketed_bars,
    "store_typed": q_store_typed,
    "store_chain": q_store_chain,
    "bar_rejects": q_bar_rejects,
    "record_append": q_record_append,
    "update_first_match": q_update_first_match,
    "update_all_matches": q_update_all_matches,
    "delete_by_field": q_delete_by_field,
    "request_forecasts": q_request_forecasts,
    "stream_forecast_responses": q_stream_forecast_responses,
}

SQL: dict[str, str] = O.build(
    filter_symbol=FILTER_SYMBOL, doc_field=DOC_FIELD, doc_old=DOC_OLD, doc_new=DOC_NEW, bad_json=BAD_JSON,
    class_width=CLASS_WIDTH, class_count=CLASS_COUNT, score_sizes=(SCORE_HIDDEN, VECTOR_DIM, VECTOR_CLASSES, PRICE_SCALE), store_first=STORE_FIRST, store_all=STORE_ALL,
    store_gone=STORE_GONE, small_l2=SMALL_L2,
)
