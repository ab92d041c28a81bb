"""Sources, cleaning, calendar, documents, mutations, forecasts, streaming and models."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from barframe.config import FEATURES, HOLIDAYS, HORIZONS, shared_dir
from barframe.functions import calendar as C
from barframe.operators import clean, mutate, stats
from barframe.operators.series import index_series
from barframe.plans import forecast as FC
from barframe.plans import models as M
from barframe.sources import bars as B
from barframe.sources import documents as D
from barframe.streaming import requests as K


def _write_text(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_bad_prices_are_null_and_rejected(spark, tmp_path):
    path = str(tmp_path / "bars.csv")
    _write_text(path, [
        "date,symbol,open,close,low,high,volume",
        "2020-01-01,AAA,1.5,2,1,3,10",
        "2020-01-02,AAA,,2,1,3,10",
        "2020-01-03,AAA,abc,2,1,3,10",
        "2020-01-06,AAA,NaN,2,1,3,10",
        "2020-01-07,AAA,1.25,2.5,1,3,10",
    ])
    bars = B.read_bars_csv(spark, path)
    assert bars.count() == 5
    assert bars.filter(F.col("open").isNull()).count() == 3  # empty, abc, NaN
    kept = clean.drop_null_rows(bars, ["open", "close"])
    assert kept.count() == 2
    raw = spark.read.csv(path, header=True, schema=B.BAR_STRINGS)
    rej = clean.reject_rows(raw, ["open"]).select("open").collect()
    assert sorted(r["open"] for r in rej) == ["NaN", "abc"]  # empty text is read as NULL, not rejected
    # NaN never widens the bounds
    ix = index_series(bars)
    assert ix.select("mx_open").first()[0] == 1.5


def test_layout_two_equals_layout_one(spark, tmp_path):
    p1, p2 = str(tmp_path / "l1.csv"), str(tmp_path / "l2.csv")
    _write_text(p1, ["date,symbol,open,close,low,high,volume", "2020-01-01,AAA,1,2,0.5,3,10"])
    _write_text(p2, ["symbol,date,open,high,low,close,volume", "AAA,2020-01-01,1,3,0.5,2,10"])
    a = B.read_bars_csv(spark, p1).select("symbol", "date", *FEATURES).collect()
    b = B.read_alt_bars_csv(spark, p2).select("symbol", "date", *FEATURES).collect()
    assert a == b


def test_category_long_and_bounds(spark, sf_small):
    bars = B.load_bars(spark, sf_small)
    assert clean.category_long(bars, "close").count() == bars.count()
    assert clean.category_long(bars, "ALL").count() == 5 * bars.count()
    with pytest.raises(ValueError):
        clean.category_long(bars, "price")
    assert stats.bounds_by_category(bars, "VOLUME").count() == 5
    assert stats.num_symbols(bars).first()[0] == 5


def test_calendar_across_year_end(spark):
    df = spark.createDataFrame([(dt.date(2018, 12, 27),)], "as_of date")
    days = df.select(C.next_trading_days("as_of", 5).alias("d")).first()["d"]
    assert days == [dt.date(2018, 12, 31), dt.date(2019, 1, 2), dt.date(2019, 1, 3),
                    dt.date(2019, 1, 4), dt.date(2019, 1, 7)]
    ts = spark.createDataFrame([(dt.datetime(2018, 12, 31, 14, 37, 12),)], "ts timestamp")
    assert ts.select(C.minute_stamp("ts")).first()[0] == "2018-12-31 14:37:00"  # calendar year, not week-year


def test_calendar_properties(spark):
    df = spark.createDataFrame([(dt.date(2015, 1, 1) + dt.timedelta(days=37 * i),) for i in range(40)], "as_of date")
    n = 1200
    out = df.select("as_of", F.posexplode(C.next_trading_days("as_of", n)).alias("pos", "d"))
    assert out.count() == 40 * n
    assert out.filter(C.is_weekend("d") | C.is_holiday("d")).count() == 0
    assert out.filter(F.col("d") < F.date_add("as_of", 2)).count() == 0
    names = out.select(C.weekday_name("d").alias("w")).distinct().collect()
    assert {r["w"] for r in names} == {"Mon", "Tue", "Wed", "Thu", "Fri"}
    assert len(HOLIDAYS) == 9


def test_update_first_and_all_matches(spark):
    docs = spark.createDataFrame(
        [("d", "x", "1", "1", "1", "1", "5"), ("d", "x", "1", "1", "1", "1", "2"),
         ("d", "y", "1", "1", "1", "1", "3"), ("d", "x", "1", "1", "1", "1", "9")], D.DOC_SCHEMA)
    one = {r["id"]: r["open"] for r in mutate.update_by(docs, "open", "x", "z").collect()}
    assert one == {"5": "x", "2": "z", "3": "y", "9": "x"}
    allm = {r["id"]: r["open"] for r in mutate.update_by(docs, "open", "x", "z", multi=True).collect()}
    assert allm == {"5": "z", "2": "z", "3": "y", "9": "z"}
    none = {r["id"]: r["open"] for r in mutate.update_by(docs, "open", "nope", "z").collect()}
    assert none == {"5": "x", "2": "x", "3": "y", "9": "x"}


def test_delete_keeps_null_fields(spark):
    docs = spark.createDataFrame([("value", "1"), ("other", "2"), (None, "3")], "open string, id string")
    left = sorted(r["id"] for r in mutate.remove_by(docs, "open", "value").collect())
    assert left == ["2", "3"]
    assert mutate.remove(docs, "other").count() == 2


def test_malformed_json_is_rejected_not_fatal(spark):
    text = spark.createDataFrame([(1, '{"k": 4}'), (2, "{bad"), (3, '{"k": 7}')], "id long, text string")
    out = D.insert_json(text, "text")
    ok, bad = out.filter("status = 'inserted'"), out.filter("status = 'rejected'")
    assert sorted((r["id"], r["fields"]["k"]) for r in ok.collect()) == [(1, "4"), (3, "7")]
    assert [(r["id"], r["text"]) for r in bad.collect()] == [(2, "{bad")]


def test_collection_roundtrip_and_record_append(spark, sf_small):
    docs = D.documents_from_events(spark.read.parquet(f"{sf_small}/events.parquet"))
    path = shared_dir(spark, "test-docs")
    D.write_collection(docs, path)
    back = D.read_collection(spark, path)
    assert sorted(back.collect()) == sorted(docs.collect())
    rec = spark.createDataFrame([(["2020-05-04", "17", "20.5", "16.25", "19.75", "301", "rec-1"],)],
                                "record array<string>")
    out = D.append_records(back, rec)
    assert out.count() == docs.count() + 1
    assert out.filter(F.col("id") == "rec-1").filter(F.col("open") == "17").count() >= 1


def test_forecast_payload_prefixes(spark, sf_small):
    ix = index_series(B.load_bars(spark, sf_small))
    p = FC.forecast_payload(FC.recursive_forecast(ix, "close")).collect()
    assert len(p) == 5
    import json

    for row in p:
        obj = json.loads(row["payload"])
        assert list(obj) == ["symbol"] + [name for name, _ in HORIZONS]
        full = obj["max"]
        for name, n in HORIZONS:
            assert obj[name] == full[:n]
        assert set(full[0]) == {"prediction", "date"}
        assert full[0]["date"].endswith(" 00:00:00")


def test_ar1_recovers_a_known_process(spark):
    # close_t+1 = 0.2 + 0.7 * close_t exactly; normalising moves the intercept and leaves the slope.
    vals = [1.0]
    for _ in range(40):
        vals.append(0.2 + 0.7 * vals[-1])
    rows = [("S", dt.date(2000, 1, 1) + dt.timedelta(days=i), v, v, v, v, 1.0 + i) for i, v in enumerate(vals)]
    bars = spark.createDataFrame(rows, B.BAR_SCHEMA)
    co = FC.ar1_fit(index_series(bars), "close").first()
    assert co["n_pairs"] == round(len(vals) * 0.9) - 1
    low, span = min(vals), max(vals) - min(vals)
    assert co["slope"] == pytest.approx(0.7, abs=1e-9)
    assert co["intercept"] == pytest.approx((0.2 + low * (0.7 - 1)) / span, abs=1e-9)


def test_stream_answers_each_request_once_across_restart(spark, sf_small):
    base = shared_dir(spark, "test-stream")
    req_dir, fc_dir, sink, ckpt = f"{base}/in", f"{base}/fc", f"{base}/out", f"{base}/ckpt"
    ix = index_series(B.load_bars(spark, sf_small))
    FC.forecast_payload(FC.recursive_forecast(ix, "close", steps=20)).select("symbol", "payload") \
        .write.mode("overwrite").parquet(fc_dir)
    reqs = K.requests_from_events(spark.read.parquet(f"{sf_small}/events.parquet"),
                                  spark.read.parquet(f"{sf_small}/orders.parquet"))
    first = reqs.filter(F.col("request_id") < 500)
    second = reqs.filter(F.col("request_id") >= 500)
    first.write.mode("append").parquet(req_dir)
    K.start_request_stream(spark, req_dir, fc_dir, sink, ckpt).awaitTermination()
    n1 = spark.read.parquet(sink).count()
    assert n1 == first.count()
    second.write.mode("append").parquet(req_dir)
    K.start_request_stream(spark, req_dir, fc_dir, sink, ckpt).awaitTermination()  # restart from checkpoint
    out = spark.read.parquet(sink)
    assert out.count() == reqs.count()
    assert out.select("request_id").distinct().count() == reqs.count()
    assert out.filter(F.col("response").isNull()).count() == 0


def test_window_regressor_save_load_and_skill(spark):
    # A noiseless upward trend: a window model must beat the mean predictor.
    n = 400
    rows = [("T", dt.date(2001, 1, 1) + dt.timedelta(days=i), 100.0 + i, 100.5 + i, 99.0 + i, 101.0 + i,
             1000.0 + (i % 7)) for i in range(n)]
    bars = spark.createDataFrame(rows, B.BAR_SCHEMA)
    ix = index_series(bars)
    path = shared_dir(spark, "test-model")
    scored = M.window_regressor(ix, "close", model_dir=path)
    assert M.model_exists(spark, path)
    again = M.load_model(path)
    fitted = M.fit_window_regressor(M.window_training_frame(ix, "close"))
    from barframe.operators import windows as W

    tw = W.test_windows(ix, "close").select("symbol", "start_idx", M.flat_window().alias("features"))
    a = {(r["symbol"], r["start_idx"]): r["prediction"] for r in fitted.transform(tw).collect()}
    b = {(r["symbol"], r["start_idx"]): r["prediction"] for r in again.transform(tw).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) <= 1e-9 * max(1.0, abs(a[k])) for k in a)
    res = scored.agg(F.avg(F.pow(F.col("prediction") - F.col("actual"), 2)).alias("mse"),
                     F.variance("actual").alias("var")).first()
    assert res["mse"] < res["var"]
    rows2 = scored.select("prediction").collect()
    assert all(r["prediction"] == r["prediction"] for r in rows2)  # finite, no NaN


def test_vector_classifier_and_libsvm(spark, sf_small):
    emb = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    out = M.vector_classifier(emb, max_iter=5)
    assert out.count() > 0
    path = shared_dir(spark, "test-libsvm")
    vec = M.embedding_vectors(emb)
    M.write_libsvm(vec, path)
    back = M.read_libsvm(spark, path, 64)
    assert back.count() == emb.count()
    assert stats.accuracy(out, by=None).first()["n"] == out.count()


@pytest.mark.parametrize("limit", [None, 1])
def test_stream_join_broadcast_or_salted(spark, sf_small, limit):
    """Both join strategies give the same answers (limit=1 byte forces the salted path)."""
    base = shared_dir(spark, "test-stream-salt")
    req_dir, fc_dir, sink, ckpt = f"{base}/in", f"{base}/fc", f"{base}/out", f"{base}/ckpt"
    ix = index_series(B.load_bars(spark, sf_small))
    FC.forecast_payload(FC.recursive_forecast(ix, "close", steps=5)).select("symbol", "payload") \
        .write.mode("overwrite").parquet(fc_dir)
    reqs = K.requests_from_events(spark.read.parquet(f"{sf_small}/events.parquet"),
                                  spark.read.parquet(f"{sf_small}/orders.parquet"))
    reqs.write.mode("overwrite").parquet(req_dir)
    K.start_request_stream(spark, req_dir, fc_dir, sink, ckpt, max_broadcast_bytes=limit).awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == reqs.count()
    assert out.select("request_id").distinct().count() == reqs.count()
    assert out.filter(F.col("response").isNull()).count() == 0


def test_training_export_and_observed_count(spark, sf_small):
    from barframe.operators import windows as W

    ix = index_series(B.load_bars(spark, sf_small))
    tw = W.train_windows(ix, "close")
    path = shared_dir(spark, "test-export")
    W.export_training_windows(tw, path)
    back = spark.read.parquet(path)
    assert back.count() == tw.count()
    one = back.filter(F.col("symbol") == "2-HIGH")
    assert "PartitionFilters: [isnotnull(symbol" in one._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    df, obs = B.counted(B.load_bars(spark, sf_small))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["n"] == B.load_bars(spark, sf_small).count()


def test_model_forecast_shape(spark):
    n = 300
    rows = [("T", dt.date(2003, 1, 1) + dt.timedelta(days=i), 50.0 + i, 50.5 + i, 49.0 + i, 51.0 + i,
             500.0 + (i % 5)) for i in range(n)]
    ix = index_series(spark.createDataFrame(rows, B.BAR_SCHEMA))
    out = M.model_forecast(ix, "close", steps=30).orderBy("step").collect()
    assert [r["step"] for r in out] == list(range(1, 31))
    dates = [r["date"] for r in out]
    assert all(a < b for a, b in zip(dates, dates[1:]))
    assert all(d.weekday() < 5 for d in dates)
    assert all(r["prediction"] == r["prediction"] and abs(r["prediction"]) < 1e9 for r in out)


def test_bars_table_partition_pruning(spark, sf_small):
    bars = B.load_bars(spark, sf_small)
    path = shared_dir(spark, "test-bars-table")
    B.write_bars_table(bars, path)
    back = B.read_bars_table(spark, path)
    assert sorted(back.collect()) == sorted(bars.select("symbol", "date", *FEATURES).collect())
    one = clean.symbol_filter(back, "4-NOT SPECIFIED")
    plan = one._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(symbol" in plan and "4-NOT SPECIFIED" in plan
    assert one.count() == bars.filter(F.col("symbol") == "4-NOT SPECIFIED").count()


def test_gbt_window_regressor_runs(spark, sf_small):
    ix = index_series(B.load_bars(spark, sf_small))
    model = M.fit_window_regressor(M.window_training_frame(ix, "close"), kind="gbt", max_iter=5)
    from barframe.operators import windows as W

    tw = W.test_windows(ix, "close").select(M.flat_window().alias("features"))
    out = model.transform(tw).select("prediction").collect()
    assert len(out) == tw.count() and all(r["prediction"] == r["prediction"] for r in out)
    with pytest.raises(ValueError):
        M.fit_window_regressor(M.window_training_frame(ix, "close"), kind="lstm")


def test_every_delivered_response_is_the_stored_payload(spark, sf_small):
    sink, fc_dir = K.run_request_stream(spark, sf_small)
    want = {r["symbol"]: r["payload"] for r in K.forecasts(spark, fc_dir).collect()}
    got = K.delivered(spark, sink, fc_dir).collect()
    events = spark.read.parquet(f"{sf_small}/events.parquet").count()
    assert len(got) == events == len({r["request_id"] for r in got})
    assert all(r["response"] == want.get(r["symbol"]) for r in got) and len(want) == 5
    assert K.references(spark, sink).select("symbol", "version").distinct().count() <= 6


def test_a_request_keeps_the_version_that_answered_it(spark, tmp_path):
    rows = lambda k: spark.createDataFrame([("a", f"old{k}"), ("b", f"b{k}")], "symbol string, payload string")
    base = str(tmp_path)
    req = lambda ids: spark.createDataFrame([(i, s) for i, s in ids], K.REQUEST_SCHEMA).write.mode("append").parquet(f"{base}/in")
    K.write_forecasts(rows(1), f"{base}/fc", 1)
    req([(1, "a"), (2, "none")])
    K.start_reference_stream(spark, f"{base}/in", f"{base}/fc", 1, f"{base}/out", f"{base}/ck").awaitTermination()
    K.write_forecasts(rows(2), f"{base}/fc", 2)
    req([(3, "a"), (4, None)])
    K.start_reference_stream(spark, f"{base}/in", f"{base}/fc", 2, f"{base}/out", f"{base}/ck", max_broadcast_bytes=0).awaitTermination()
    got = {r["request_id"]: r["response"] for r in K.delivered(spark, f"{base}/out", f"{base}/fc").collect()}
    assert got == {1: "old1", 2: None, 3: "old2", 4: None}
