"""Hand-sized goldens, edge rows and properties of indexing, splits and windows."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from barframe.config import FEATURES, HORIZON, WINDOW
from barframe.operators import windows as W
from barframe.operators.normalize import global_minmax, normalized_bars
from barframe.operators.series import index_series
from barframe.sources.bars import BAR_SCHEMA, load_bars

L, H = WINDOW, HORIZON


def bars_df(spark, n, symbol="AAA", start=dt.date(2020, 1, 1), volume=None, price=lambda i: 100.0 + i):
    rows = []
    for i in range(n):
        p = price(i)
        rows.append((symbol, start + dt.timedelta(days=i), p, p + 1, p - 1, p + 2,
                     float(volume if volume is not None else 10 + i)))
    return spark.createDataFrame(rows, BAR_SCHEMA)


def test_empty_input_keeps_schema(spark):
    empty = spark.createDataFrame([], BAR_SCHEMA)
    tw = W.test_windows(index_series(empty), "close")
    assert tw.count() == 0
    assert "window" in tw.columns and "label" in tw.columns


@pytest.mark.parametrize("n,expected", [(L + H, 0), (L + H + 1, 1), (L + H + 5, 5), (3, 0)])
def test_window_count_strict_bound(spark, n, expected):
    ix = index_series(bars_df(spark, n), ratio=0.0)  # everything in the test part
    assert W.test_windows(ix, "close").count() == expected
    assert W.test_windows(ix, "close", drop_last=False).count() == max(0, n - L - H + 1)


def test_half_rounding_split(spark):
    ix = index_series(bars_df(spark, 25), ratio=0.9)
    parts = {r["part"]: r["c"] for r in ix.groupBy("part").agg(F.count("*").alias("c")).collect()}
    assert parts == {"train": 23, "test": 2}  # 22.5 rounds up


def test_constant_feature(spark):
    b = bars_df(spark, 30, volume=7.0)
    nb = normalized_bars(index_series(b))
    assert nb.filter(F.col("volume").isNotNull()).count() == 0  # N1: 0/0 -> NULL
    g = global_minmax(b)
    assert {r["volume"] for r in g.select("volume").collect()} == {0.5}  # N2: constant -> 0.5


def test_non_positive_feature_true_max(spark):
    b = bars_df(spark, 30, price=lambda i: -50.0 - i)
    r = index_series(b).select("mx_open", "mn_open").first()
    assert r["mx_open"] == -50.0 and r["mn_open"] == -79.0


def test_duplicate_dates_deterministic(spark):
    d = dt.date(2021, 3, 1)
    rows = [("S", d, 2.0, 2.0, 2.0, 2.0, 1.0), ("S", d, 1.0, 1.0, 1.0, 1.0, 1.0),
            ("S", d + dt.timedelta(days=1), 3.0, 3.0, 3.0, 3.0, 1.0)]
    ix = index_series(spark.createDataFrame(rows, BAR_SCHEMA))
    got = [(r["idx"], r["open"]) for r in ix.orderBy("idx").collect()]
    assert got == [(0, 1.0), (1, 2.0), (2, 3.0)]


def test_unsorted_input_and_partitioning_do_not_matter(spark):
    b = bars_df(spark, 80).union(bars_df(spark, 60, symbol="BBB"))
    one = W.test_windows_long(W.test_windows(index_series(b.coalesce(1), ratio=0.5), "close"))
    many = W.test_windows_long(W.test_windows(index_series(b.orderBy(F.rand(7)).repartition(8), ratio=0.5), "close"))
    assert sorted(one.collect()) == sorted(many.collect())


def test_small_blocks_equal_default(spark):
    # Blocks of 30 rows force the overlap path on a 200-bar series.
    b = bars_df(spark, 200).union(bars_df(spark, 140, symbol="BBB"))
    ix = index_series(b, ratio=0.6)
    for cat in ("close", "all"):
        a = W.test_windows_long(W.test_windows(ix, cat))
        s = W.test_windows_long(W.test_windows(ix, cat, block_rows=30))
        assert sorted(a.collect()) == sorted(s.collect())
        a = W.windows_long(W.train_windows(ix, cat))
        s = W.windows_long(W.train_windows(ix, cat, block_rows=30))
        assert sorted(a.collect()) == sorted(s.collect())
    lead_a = W.with_lead(ix, {"nxt": F.col("close")}, 1).select("symbol", "idx", "nxt")
    lead_s = W.with_lead(ix, {"nxt": F.col("close")}, 1, block_rows=30).select("symbol", "idx", "nxt")
    assert sorted(lead_a.collect()) == sorted(lead_s.collect())


@pytest.mark.parametrize("bucket", ["day", "week", "year"])
def test_bucket_choice_does_not_change_index(spark, bucket):
    b = bars_df(spark, 400)
    base = index_series(b).select("symbol", "date", "idx", "part", "part_idx")
    other = index_series(b, bucket=bucket).select("symbol", "date", "idx", "part", "part_idx")
    assert sorted(base.collect()) == sorted(other.collect())


def test_golden_l3(spark):
    """30 bars, L=3: windows checkable by eye."""
    ix = index_series(bars_df(spark, 30), ratio=0.0)
    tw = W.test_windows(ix, "close", L=3, H=1).orderBy("start_idx").collect()
    assert len(tw) == 26
    first = tw[0]
    # close = 101 + i, bounds 101..130 -> normalised (i) / 29
    assert [round(b["close"] * 29, 9) for b in first["window"]] == [0.0, 1.0, 2.0]
    assert first["label"] == 104.0  # raw close of bar 3
    tr = W.train_windows(index_series(bars_df(spark, 30), ratio=1.0), "close", L=3, H=1)
    r0 = tr.orderBy("start_idx").first()
    assert [round(x * 29, 9) for x in r0["labels"]] == [1.0, 2.0, 3.0]
    assert tr.count() == 26


def test_properties_on_fixture(spark, sf_small):
    ix = index_series(load_bars(spark, sf_small))
    per = ix.groupBy("symbol").agg(F.max("n").alias("n"), F.max("split").alias("split"),
                                   F.count("*").alias("rows")).collect()
    for r in per:
        assert r["rows"] == r["n"]
    tw = W.test_windows(ix, "close").groupBy("symbol").count().collect()
    counts = {r["symbol"]: r["count"] for r in tw}
    for r in per:
        assert counts.get(r["symbol"], 0) == max(0, r["n"] - r["split"] - L - H)
    nb = normalized_bars(ix)
    for f in FEATURES:
        lo, hi = nb.agg(F.min(f), F.max(f)).first()
        assert lo == 0.0 and hi == 1.0
    from barframe.operators.normalize import denormalize_roundtrip

    bad = denormalize_roundtrip(ix).alias("a").join(load_bars(spark, sf_small).alias("b"), ["symbol", "date"]).filter(
        " OR ".join(f"abs(a.{f} - b.{f}) > 1e-9 * abs(b.{f}) + 1e-9" for f in FEATURES)
    )
    assert bad.count() == 0


def test_bounds_on_train(spark):
    b = bars_df(spark, 100)
    ix = index_series(b, ratio=0.5, bounds_on="train")
    r = ix.select("mn_close", "mx_close").first()
    assert (r["mn_close"], r["mx_close"]) == (101.0, 150.0)
    with pytest.raises(ValueError):
        index_series(b, bounds_on="bogus")


def test_unknown_category_raises(spark):
    with pytest.raises(ValueError):
        W.target_columns("price")
    assert math.isfinite(len(W.target_columns("ALL")))


def test_hash_split_is_partitioning_independent(spark):
    from barframe.operators.splits import hash_split, split_parts

    b = bars_df(spark, 400).union(bars_df(spark, 300, symbol="BBB"))
    key = F.concat_ws("|", F.col("symbol"), F.col("date").cast("string"))
    one = hash_split(b.coalesce(1), key).select("symbol", "date", "part").collect()
    many = hash_split(b.repartition(7), key).select("symbol", "date", "part").collect()
    assert sorted(one) == sorted(many)
    share = sum(r["part"] == "train" for r in one) / len(one)
    assert 0.5 < share < 0.7
    train, test = split_parts(b, key)
    assert train.count() + test.count() == b.count()


def test_hot_symbol_is_spread_over_tasks(spark):
    """A single symbol with 100k bars: the block layout spreads its window work over many partitions."""
    from barframe.operators.windows import _blocked

    n = 100_000
    bars = spark.range(n).selectExpr(
        "'HOT' AS symbol", "date_add(DATE'1800-01-01', CAST(id AS INT)) AS date",
        *[f"CAST(id % 997 AS DOUBLE) + {k}.0 AS {f}" for k, f in enumerate(FEATURES)],
    )
    ix = index_series(bars, ratio=0.9)
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = _blocked(ix.filter("part = 'train'"), L + H, 16_384)
        sizes = rows.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    assert sum(sizes) > 0.9 * n
    assert max(sizes) < 0.5 * sum(sizes)  # no single task holds the hot symbol
    assert sum(1 for x in sizes if x) >= 3
    assert W.test_windows(ix, "close").count() == n - int(n * 0.9 + 0.5) - L - H
