"""Trading-day tables, maintained statistics and bucketed bars."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from barframe.config import FEATURES
from barframe.functions import calendar as C
from barframe.functions import trading_days as TD
from barframe.operators.series import index_series
from barframe.sources import bars as B
from barframe.streaming import maintained as MT


def test_ranked_days_equal_the_column_function(spark):
    days = TD.trading_days(TD.fixed_holidays(spark), "2016-01-01", "2024-12-31").cache()
    rows = spark.sql("SELECT explode(sequence(DATE'2017-12-01', DATE'2018-12-31')) AS as_of, 'default' AS calendar")
    want = {r["as_of"]: r["days"] for r in rows.withColumn("days", C.next_trading_days("as_of", 60)).collect()}
    assert {r["as_of"]: r["days"] for r in TD.next_days(rows, days, "as_of", 60).collect()} == want
    for n in (1, 5, 60):
        got = {r["as_of"]: r["day"] for r in TD.nth_trading_day(rows, days, "as_of", str(n)).collect()}
        assert got == {d: w[n - 1] for d, w in want.items()}


def test_calendars_dates_and_rows_without_an_answer(spark):
    holidays = spark.createDataFrame([("a", "01-02", None), ("a", None, dt.date(2020, 1, 6)), ("b", None, None)],
                                     "calendar string, month_day string, date date")
    days = TD.trading_days(holidays, "2020-01-01", "2020-02-01")
    rows = spark.createDataFrame([(1, dt.date(2019, 12, 31), 1, "a"), (2, dt.date(2019, 12, 31), 1, "b"), (3, dt.date(2020, 1, 1), 2, "a"),
                                  (4, None, 1, "a"), (5, dt.date(2020, 1, 3), None, "a"), (6, dt.date(2020, 1, 3), 0, "a"),
                                  (7, dt.date(2020, 1, 30), 9, "a"), (8, dt.date(2020, 1, 3), 1, "c")],
                                 "id int, as_of date, n int, calendar string")
    got = {r["id"]: r["day"] for r in TD.nth_trading_day(rows, days, "as_of", "n", first_offset_days=2).collect()}
    assert got == {1: dt.date(2020, 1, 3), 2: dt.date(2020, 1, 2), 3: dt.date(2020, 1, 7),
                   4: None, 5: None, 6: None, 7: None, 8: None}


def bars_of(spark, n, first=0):
    return spark.range(first, first + n).selectExpr(
        "IF(id % 3 = 0, 'a', concat('s', id % 7)) AS symbol", "date_add(DATE'2020-01-01', CAST(id AS INT)) AS date",
        *[f"CAST(hash(id, '{f}') % 1000 AS DOUBLE) AS {f}" for f in FEATURES])


def test_an_update_reads_new_files_alone_and_equals_a_whole_run(spark, tmp_path):
    base = str(tmp_path)
    bars_of(spark, 1_000).write.parquet(f"{base}/bars")
    assert MT.update(spark, f"{base}/bars", f"{base}/stats", f"{base}/ck", max_files=2) == 1_000
    bars_of(spark, 10, 1_000).write.mode("append").parquet(f"{base}/bars")
    assert MT.update(spark, f"{base}/bars", f"{base}/stats", f"{base}/ck") == 10
    assert MT.update(spark, f"{base}/bars", f"{base}/stats", f"{base}/ck") == 0
    stats = MT.merged(spark, f"{base}/stats")
    whole = index_series(bars_of(spark, 1_010))
    want = {tuple(r) for r in whole.select("symbol", "n", "split", *[f"{m}_{f}" for f in FEATURES for m in ("mn", "mx")]).distinct().collect()}
    assert {tuple(r) for r in MT.symbol_stats(stats).collect()} == want
    firsts = whole.groupBy("symbol", F.expr("year(date) * 12 + month(date)").alias("bucket")).agg(
        F.count("*").alias("n"), F.min("idx").alias("offset"))
    assert {tuple(r) for r in MT.offsets(stats).collect()} == {tuple(r) for r in firsts.collect()}
    MT.compact(spark, f"{base}/stats", f"{base}/stats2")
    bars_of(spark, 5, 1_010).write.mode("append").parquet(f"{base}/bars")
    assert MT.update(spark, f"{base}/bars", f"{base}/stats2", f"{base}/ck") == 5
    assert MT.merged(spark, f"{base}/stats2").agg(F.sum("n")).first()[0] == 1_015


@pytest.fixture
def tables(spark, tmp_path):
    names = ["bucketed_a", "bucketed_b"]
    for k, name in enumerate(names):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        B.write_bucketed_bars(bars_of(spark, 900, 300 * k), name, str(tmp_path / name), 4)
    yield names
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_bucketed_bars_are_joined_and_counted_without_a_shuffle_on_symbol(spark, tables):
    a, b = (B.read_bucketed_bars(spark, t) for t in tables)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b.select("symbol", "date", F.col("close").alias("other")), ["symbol", "date"])
        assert joined.count() == 600
        for df in (a.join(b.groupBy("symbol").count(), "symbol"), a.groupBy("symbol").count()):
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_symbol_filter_reads_one_bucket(spark, tables):
    # Spark prunes buckets in any scan, but prints it only of scans that it keeps bucketed.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    df = B.read_bucketed_bars(spark, tables[0]).where("symbol = 's1'")
    assert df.count() == bars_of(spark, 900).where("symbol = 's1'").count()
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert re.search(r"SelectedBucketsCount: 1 out of 4", plan)
