"""Edge rows: missing prices, constant series, text ids, permuted headers, bad lines, settings."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from barframe.config import shared_dir
from barframe.operators import mutate
from barframe.operators import windows as W
from barframe.operators.joins import salted_join
from barframe.operators.normalize import global_minmax
from barframe.operators.series import index_series
from barframe.plans import forecast as FC
from barframe.plans import models as M
from barframe.sources import bars as B
from barframe.sources import documents as D
from barframe.streaming import requests as K

D0 = dt.date(2021, 1, 4)


def series(spark, symbols, n=120):
    rows = [(s, D0 + dt.timedelta(days=i), *value(i)) for s, value in symbols.items() for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, date date, open double, close double, low double, high double, volume double")


def wave(i):
    c = 50 + 10 * ((i * 7) % 11) / 11 + i * 0.1
    return c - 1, c, c - 2, c + 2, 100.0 + i % 5


def gap(i):
    o, c, lo, h, v = wave(i)
    return o, (None if i == 30 else c), lo, h, v


def flat(i):
    return 5.0, 5.0, 5.0, 5.0, 5.0


def test_missing_label_keeps_its_place(spark):
    ix = index_series(series(spark, {"g": gap}))
    for r in W.train_windows(ix, "close").collect():
        assert len(r["labels"]) == len(r["window"]) == 22
        for k, v in enumerate(r["labels"]):
            assert (v is None) == (r["start_idx"] + k + 1 == 30)


def test_regressor_survives_constant_and_missing(spark):
    ix = index_series(series(spark, {"w": wave, "g": gap, "c": flat}))
    frame = M.window_training_frame(ix, "close")
    rejects = M.window_training_rejects(ix, "close")
    assert frame.count() + rejects.count() == W.train_windows(ix, "close").count()
    assert {r["symbol"] for r in frame.select("symbol").distinct().collect()} == {"w", "g"}
    assert frame.filter("start_idx = 3").count() == 2
    assert frame.filter("symbol = 'g' AND start_idx BETWEEN 8 AND 30").count() == 0
    out = M.window_regressor(ix, "close")
    assert out.filter("symbol = 'w' AND prediction IS NULL").count() == 0
    fc = M.model_forecast(ix, "all", steps=4)
    assert fc.groupBy("symbol", "category").count().filter("count = 4").count() == 15


def test_all_targets_match_single_ones(spark):
    ix = index_series(series(spark, {"w": wave, "g": gap}))
    both = {(r["symbol"], r["category"]): r["prediction"] for r in FC.next_value(ix, "all").collect()}
    for f in ("open", "close", "volume"):
        for r in FC.next_value(ix, f).collect():
            assert both[r["symbol"], f] == pytest.approx(r["prediction"])
    fc = FC.forecast_long(FC.recursive_forecast(ix, "all", steps=30))
    assert fc.count() == 2 * 5 * 30


def test_closed_form_is_the_recursion(spark):
    ix = index_series(series(spark, {"w": wave}))
    c = FC.ar1_coefficients(ix, "close").first()
    last = FC.latest_window(ix).first()
    z, want = last["window"][-1]["close"], []
    for _ in range(200):
        z = c["close_a"] + c["close_b"] * z
        want.append(z * (last["mx_close"] - last["mn_close"]) + last["mn_close"])
    got = [r["prediction"] for r in FC.forecast_long(FC.recursive_forecast(ix, "close", steps=200)).orderBy("step").collect()]
    assert got == pytest.approx(want, rel=1e-9)


def test_short_symbol_is_kept_without_prediction(spark):
    bars = series(spark, {"w": wave}).unionByName(series(spark, {"one": wave}, n=1))
    out = {r["symbol"]: r["prediction"] for r in FC.next_value(index_series(bars)).collect()}
    assert out["one"] is None and out["w"] is not None


def test_price_classes_and_rejects_are_all_bars(spark):
    bars = series(spark, {"w": wave, "g": gap}).withColumn("close", F.expr("CASE WHEN volume = 104 THEN -close WHEN volume = 103 THEN close * 100 ELSE close END"))
    frame, rejects = M.price_class_frame(bars, 1.0, 100), M.price_class_rejects(bars, 1.0, 100)
    assert frame.count() + rejects.count() == bars.count()
    assert {r["reason"] for r in rejects.collect()} == {"no price", "beyond the classes"}
    assert frame.agg(F.max("label")).first()[0] < 100


def test_update_first_with_text_and_equal_ids(spark):
    docs = spark.createDataFrame([(None, "x", "1", "1", "1", str(i), "bar-5-LOW") for i in range(3)], D.DOC_SCHEMA)
    out = mutate.update_by(docs, "open", "x", "z").collect()
    assert sorted(r["open"] for r in out) == ["x", "x", "z"]
    numbered = D.with_sequence(docs.coalesce(1))
    assert [r["open"] for r in mutate.update_by(numbered, "open", "x", "z", order_key=F.col("seq")).orderBy("seq").collect()] == ["z", "x", "x"]


def test_store_chain_insert_append_update_delete(spark):
    path, rejects, versions = (shared_dir(spark, n) for n in ("chain", "chain-rejects", "chain-versions"))
    text = spark.createDataFrame([('{"open":"50","id":"a"}',), ('{"k":"x"}',), ("[1]",), ("{bad",), (None,)], "text string")
    D.store_json(text, path, rejects)
    assert spark.read.text(rejects).count() == 3
    back = D.read_collection(spark, path)
    assert back.filter("open = '50' AND id = 'a'").count() == 1 and back.count() == 2
    records = spark.createDataFrame([(["2020-01-01", "50", "2", "3", "4", "5", "a"],)], "record array<string>")
    first = D.write_version(D.append_records(back, records), versions)
    second = D.write_version(mutate.update_by(D.with_sequence(D.read_collection(spark, first)), "open", "50", "51", order_key=F.col("seq")), versions)
    third = D.write_version(mutate.remove(D.read_collection(spark, second), "50"), versions)
    assert [p.rsplit("/", 1)[1] for p in (first, second, third)] == ["v=0", "v=1", "v=2"]
    assert [D.read_collection(spark, p).count() for p in (first, second, third)] == [3, 3, 2]
    assert D.read_collection(spark, third).filter("open = '51'").count() == 1


def test_second_layout_is_bound_by_name(spark, tmp_path):
    (tmp_path / "p.csv").write_text("symbol,date,open,close,low,high,volume\nA,2020-01-02,1,2,3,4,5\n")
    r = B.read_alt_bars_csv(spark, str(tmp_path)).first()
    assert (r["open"], r["close"], r["low"], r["high"], r["volume"]) == (1, 2, 3, 4, 5)
    (tmp_path / "p.csv").write_text("symbol,date,open\nA,2020-01-02,1\n")
    with pytest.raises(ValueError):
        B.read_alt_bars_csv(spark, str(tmp_path))


def test_second_layout_with_headers_of_several_orders(spark, tmp_path):
    (tmp_path / "a.csv").write_text("symbol,date,open,high,low,close,volume\nA,2020-01-02,1,2,3,4,5\nA,2020-01-03,,2,3,4,5\n")
    (tmp_path / "b.csv").write_text('date,symbol,note,volume,close,low,high,open\n2020-01-02,B,"x,y",50,40,30,20,10\n')
    with pytest.raises(Exception, match="(?i)header"):
        B.read_alt_bars_csv(spark, str(tmp_path)).select("symbol").collect()
    got = {(r["symbol"], str(r["date"])): (r["open"], r["high"], r["low"], r["close"], r["volume"])
           for r in B.read_alt_bars_csv(spark, str(tmp_path), mixed_headers=True).collect()}
    assert got == {("A", "2020-01-02"): (1, 2, 3, 4, 5), ("A", "2020-01-03"): (None, 2, 3, 4, 5),
                   ("B", "2020-01-02"): (10, 20, 30, 40, 50)}
    (tmp_path / "c.csv").write_text("C,2020-01-02,1,2,3,4,5\n")
    with pytest.raises(Exception, match="no header with all columns"):
        B.read_alt_bars_csv(spark, str(tmp_path), mixed_headers=True).collect()


def test_global_scaling_keeps_rows_without_a_feature(spark):
    nan = float("nan")
    rows = [("A", D0, 0.0, 10.0, 1.0, 2.0, 5.0), ("A", D0 + dt.timedelta(1), 10.0, 20.0, 3.0, 4.0, 15.0),
            ("B", D0, None, 15.0, 2.0, 3.0, 10.0), ("B", D0 + dt.timedelta(1), 5.0, nan, 5.0, 3.0, None)]
    df = spark.createDataFrame(rows, "symbol string, date date, open double, close double, low double, high double, volume double")
    got = {(r["symbol"], (r["date"] - D0).days): tuple(r)[2:] for r in global_minmax(df, ("open", "close", "low", "high", "volume")).collect()}
    assert got == {("A", 0): (0, 0, 0, 0, 0), ("A", 1): (1, 1, 1, 1, 1), ("B", 0): (None, 0.5, 0.5, 0.5, 0.5),
                   ("B", 1): (0.5, None, 2.0, 0.5, None)}
    alone = global_minmax(df.where("symbol = 'B'")).collect()
    assert len(alone) == 2 and all(v is None for r in alone for v in tuple(r)[2:])


def test_bad_csv_lines_are_rejected(spark, tmp_path):
    (tmp_path / "b.csv").write_text("date,symbol,open,close,low,high,volume\n2020-01-02,A,1,2,3,4,5\n2020-01-03,A,1\n"
                                    "2020-01-03,A,1,2,3,4,5,6\nnever,A,1,2,3,4,5\n2020-01-06,A,x,2,3,4,5\n")
    good, bad = B.read_bars_csv_checked(spark, str(tmp_path))
    assert sorted(r["reason"] for r in bad.collect()) == ["date", "fields", "fields"]
    assert good.count() == 2 and good.filter("open IS NULL").count() == 1


def test_size_settings_and_salts(spark):
    assert K.size_bytes(spark, "10MB") == 10 << 20 and K.size_bytes(spark, "10485760b") == 10 << 20
    assert K.size_bytes(spark, "-1") == -1
    rows = spark.range(3000).selectExpr("id AS request_id", "if(id % 3 = 0, 'hot', cast(id AS string)) AS symbol")
    small = spark.createDataFrame([("hot", 1), ("1", 2)], "symbol string, v int")
    out = salted_join(rows, small, "symbol", "request_id", salts=8)
    assert out.count() == 3000 and out.filter("v = 1").count() == 1000 and out.filter("v = 2").count() == 1
    spread = rows.filter("symbol = 'hot'").selectExpr("pmod(xxhash64(request_id), 8) AS s").groupBy("s").count()
    assert spread.count() == 8 and spread.agg(F.max("count")).first()[0] < 300


def test_shared_dir_needs_the_setting_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")


def test_stream_stopped_with_files_pending_resumes_exactly_once(spark, sf_small):
    import time

    base = shared_dir(spark, "cut-stream")
    req_dir, fc_dir, sink, ckpt = f"{base}/in", f"{base}/fc", f"{base}/out", f"{base}/ckpt"
    ix = index_series(B.load_bars(spark, sf_small))
    FC.forecast_payload(FC.recursive_forecast(ix, "close", steps=3)).select("symbol", "payload").write.parquet(fc_dir)
    reqs = K.requests_from_events(spark.read.parquet(f"{sf_small}/events.parquet"), spark.read.parquet(f"{sf_small}/orders.parquet"))
    reqs.repartition(12).write.parquet(req_dir)
    q = K.start_request_stream(spark, req_dir, fc_dir, sink, ckpt, max_files=1)
    while q.isActive and not q.recentProgress:
        time.sleep(0.05)
    q.stop()
    done = spark.read.parquet(sink).count()
    K.start_request_stream(spark, req_dir, fc_dir, sink, ckpt, max_files=4).awaitTermination()
    out = spark.read.parquet(sink)
    assert 0 < done < reqs.count()
    assert out.count() == reqs.count() == out.select("request_id").distinct().count()
