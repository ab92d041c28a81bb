"""Windows, splits and pairs against a brute-force Python model on random small series.

Blocks of 7 rows (L=3, H=1) force many overlaps; dates have gaps and duplicates;
input order is shuffled.
"""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barframe.config import FEATURES
from barframe.operators import windows as W
from barframe.operators.series import index_series
from barframe.sources.bars import BAR_SCHEMA

L, H, RATIO, BLOCK = 3, 1, 0.7, 7


def make_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for s in range(rnd.randint(1, 3)):
        d = dt.date(2010, 1, 1) + dt.timedelta(days=rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 60)):
            d += dt.timedelta(days=rnd.choice([0, 1, 1, 1, 3, 40]))
            vals = [float(rnd.randint(1, 50)) for _ in FEATURES]
            rows.append((f"S{s}", d, *vals))
    rnd.shuffle(rows)
    return rows


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    test_out, train_out, pairs = set(), set(), set()
    for sym, bars in by.items():
        bars.sort(key=lambda r: (r[1],) + tuple(r[2:]))
        n = len(bars)
        mn = [min(b[2 + i] for b in bars) for i in range(5)]
        mx = [max(b[2 + i] for b in bars) for i in range(5)]

        def nz(b, i):
            return None if mx[i] == mn[i] else (b[2 + i] - mn[i]) / (mx[i] - mn[i])

        split = int((n * RATIO) + 0.5)
        train, test = bars[:split], bars[split:]
        for i in range(len(test) - (L + H)):
            win = tuple(tuple(nz(test[j], k) for k in range(5)) for j in range(i, i + L))
            test_out.add((sym, i, win, test[i + L][3]))  # raw close
        for i in range(len(train) - (L + H)):
            win = tuple(tuple(nz(train[j], k) for k in range(5)) for j in range(i, i + L))
            labels = tuple(nz(train[j + 1], 1) for j in range(i, i + L))
            train_out.add((sym, i, win, labels))
        for i in range(len(train) - 1):
            pairs.add((sym, i, train[i + 1][3]))
    return test_out, train_out, pairs


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5, 6])
def test_windows_match_brute_force(spark, seed):
    rows = make_rows(seed)
    bars = spark.createDataFrame(rows, BAR_SCHEMA).repartition(3)
    ix = index_series(bars, ratio=RATIO, bucket="week")
    exp_test, exp_train, exp_pairs = brute(rows)

    tw = W.test_windows(ix, "close", L=L, H=H, block_rows=BLOCK).collect()
    got_test = {(r["symbol"], r["start_idx"], tuple(tuple(b[f] for f in FEATURES) for b in r["window"]), r["label"])
                for r in tw}
    assert got_test == exp_test

    trw = W.train_windows(ix, "close", L=L, H=H, block_rows=BLOCK).collect()
    got_train = {(r["symbol"], r["start_idx"], tuple(tuple(b[f] for f in FEATURES) for b in r["window"]),
                  tuple(r["labels"])) for r in trw}
    assert got_train == exp_train

    ld = W.with_lead(ix, {"nxt": "close"}, 1, part="train", block_rows=BLOCK)
    got_pairs = {(r["symbol"], r["part_idx"], r["nxt"]) for r in ld.filter(F.col("nxt").isNotNull()).collect()}
    assert got_pairs == exp_pairs


def _next_days_loop(as_of, n, holidays):
    """Day-by-day loop: first candidate as_of + 2, skip Saturdays, Sundays and fixed month-day holidays."""
    out, d = [], as_of + dt.timedelta(days=1)
    while len(out) < n:
        d += dt.timedelta(days=1)
        if d.weekday() >= 5 or d.strftime("%m-%d") in holidays:
            continue
        out.append(d)
    return out


def test_calendar_matches_day_loop(spark):
    from barframe.config import HOLIDAYS
    from barframe.functions.calendar import next_trading_days

    rnd = random.Random(11)
    starts = [dt.date(2018, 12, 27), dt.date(2019, 12, 31), dt.date(2020, 2, 28)] + [
        dt.date(1990, 1, 1) + dt.timedelta(days=rnd.randint(0, 15000)) for _ in range(40)
    ]
    df = spark.createDataFrame([(d,) for d in starts], "as_of date")
    for n in (1, 7, 260):
        got = {r["as_of"]: r["days"] for r in df.select("as_of", next_trading_days("as_of", n).alias("days")).collect()}
        for d in starts:
            assert got[d] == _next_days_loop(d, n, set(HOLIDAYS)), (d, n)


@pytest.mark.parametrize("seed", [7, 8, 9])
@pytest.mark.parametrize("bucket", ["day", "week", "month"])
def test_next_bar_columns_match_sorted_successor(spark, seed, bucket):
    rows = make_rows(seed)
    ix = index_series(spark.createDataFrame(rows, BAR_SCHEMA).repartition(4), ratio=RATIO, bucket=bucket)
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    expected = set()
    for sym, bars in by.items():
        bars.sort(key=lambda r: (r[1],) + tuple(r[2:]))
        for i, b in enumerate(bars):
            nxt = bars[i + 1] if i + 1 < len(bars) else (None,) * 7
            expected.add((sym, i, *nxt[2:]))
    got = {(r["symbol"], r["idx"], *[r[f"next_{f}"] for f in FEATURES]) for r in ix.collect()}
    assert got == expected
