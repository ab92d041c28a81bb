"""DuckDB-runnable SQL twins of the registered queries.

Each string reads the pre-registered tables (orders, events, embeddings, ...)
and returns the same column names and types as the Spark query of the same key.
The shared CTEs below spell out bars, indexing, split and normalisation the
plain way (whole-series window per symbol), which is fine for an oracle.
"""

from __future__ import annotations

from ..config import FEATURES, WINDOW, HORIZON, SERIES_SPLIT

F5 = FEATURES
L = WINDOW
H = HORIZON

BARS = """bars AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, arg_max(o_totalprice, o_orderkey) AS close,
         min(o_totalprice) AS low, max(o_totalprice) AS high, CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)"""


def _bounds(over: str = "PARTITION BY symbol") -> str:
    return ", ".join(
        f"min({f}) OVER ({over}) AS mn_{f}, max({f}) OVER ({over}) AS mx_{f}" for f in F5
    )


def indexed(ratio: float = SERIES_SPLIT) -> str:
    """CTEs bars, ix (idx, n, bounds) and pt (split, part, part_idx, part_n)."""
    return f"""{BARS},
ix AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date, open, close, low, high, volume) - 1 AS idx,
         count(*) OVER (PARTITION BY symbol) AS n, {_bounds()}
  FROM bars),
sp AS (SELECT *, CAST(floor(n * CAST({ratio!r} AS DOUBLE) + 0.5) AS BIGINT) AS split FROM ix),
pt AS (
  SELECT *, CASE WHEN idx < split THEN 'train' ELSE 'test' END AS part,
         CASE WHEN idx < split THEN idx ELSE idx - split END AS part_idx,
         CASE WHEN idx < split THEN split ELSE n - split END AS part_n
  FROM sp)"""


def nz(alias: str, f: str, bound_of: str | None = None) -> str:
    g = bound_of or f
    return f"({alias}.{f} - {alias}.mn_{g}) / nullif({alias}.mx_{g} - {alias}.mn_{g}, 0)"


def norm_cols(alias: str) -> str:
    return ", ".join(f"{nz(alias, f)} AS {f}" for f in F5)


def test_windows_long(category: str = "close") -> str:
    label = (
        f"c.{category} AS label" if category != "all"
        else ", ".join(f"c.{f} AS label_{f}" for f in F5)
    )
    return f"""WITH {indexed()}
SELECT a.symbol, CAST(a.part_idx AS BIGINT) AS start_idx, CAST(b.part_idx - a.part_idx AS BIGINT) AS step,
       {norm_cols('b')}, {label}
FROM pt a
JOIN pt b ON b.symbol = a.symbol AND b.part = a.part AND b.part_idx BETWEEN a.part_idx AND a.part_idx + {L - 1}
JOIN pt c ON c.symbol = a.symbol AND c.part = a.part AND c.part_idx = a.part_idx + {L}
WHERE a.part = 'test' AND a.part_idx < a.part_n - {L + H}"""


def train_windows_long(category: str = "close") -> str:
    if category == "all":
        label = ", ".join(f"{nz('c', f)} AS label_{f}" for f in F5)
    else:
        label = f"{nz('c', category)} AS label"
    return f"""WITH {indexed()}
SELECT a.symbol, CAST(a.part_idx AS BIGINT) AS start_idx, CAST(b.part_idx - a.part_idx AS BIGINT) AS step,
       {norm_cols('b')}, {label}
FROM pt a
JOIN pt b ON b.symbol = a.symbol AND b.part = a.part AND b.part_idx BETWEEN a.part_idx AND a.part_idx + {L - 1}
JOIN pt c ON c.symbol = a.symbol AND c.part = a.part AND c.part_idx = b.part_idx + 1
WHERE a.part = 'train' AND a.part_idx < a.part_n - {L + H}"""


def _holidays() -> str:
    from ..config import HOLIDAYS

    return ", ".join(f"'{h}'" for h in HOLIDAYS)


def ar1(cols=("close",)) -> str:
    """CTEs pr (training pairs) and co (per-symbol slope/intercept per category)."""
    pairs = " UNION ALL ".join(
        f"SELECT a.symbol, '{f}' AS category, {nz('a', f)} AS x, {nz('b', f)} AS y "
        f"FROM pt a JOIN pt b ON b.symbol = a.symbol AND b.idx = a.idx + 1 WHERE b.idx < a.split"
        for f in cols
    )
    return f"""pr AS ({pairs}),
co AS (SELECT symbol, category, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept,
              regr_count(y, x) AS n_pairs FROM pr GROUP BY symbol, category)"""


def _one_ahead_rows(f: str) -> str:
    return f"""SELECT s.symbol, CAST(s.part_idx AS BIGINT) AS start_idx, '{f}' AS category,
       (co.intercept + co.slope * {nz('l', f)}) * (l.mx_{f} - l.mn_{f}) + l.mn_{f} AS prediction,
       c.{f} AS actual
FROM pt s
JOIN pt l ON l.symbol = s.symbol AND l.part = s.part AND l.part_idx = s.part_idx + {L - 1}
JOIN pt c ON c.symbol = s.symbol AND c.part = s.part AND c.part_idx = s.part_idx + {L}
JOIN co ON co.symbol = s.symbol AND co.category = '{f}'
WHERE s.part = 'test' AND s.part_idx < s.part_n - {L + H}"""


def calendar(src: str, n: int) -> str:
    """CTE cal(symbol, step, date): next n trading days after ``as_of`` of ``src``, first candidate as_of+2."""
    from ..config import FIRST_OFFSET_DAYS

    span = 2 * n + 30
    return f"""days AS (
  SELECT symbol, CAST(unnest(generate_series(CAST(as_of AS TIMESTAMP) + INTERVAL '{FIRST_OFFSET_DAYS} days',
         CAST(as_of AS TIMESTAMP) + INTERVAL '{FIRST_OFFSET_DAYS + span} days', INTERVAL '1 day')) AS DATE) AS date
  FROM {src}),
cal0 AS (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) AS step FROM days
         WHERE isodow(date) < 6 AND strftime(date, '%m-%d') NOT IN ({_holidays()})),
cal AS (SELECT symbol, CAST(step AS BIGINT) AS step, date FROM cal0 WHERE step <= {n})"""


def forecast_ctes(n: int) -> str:
    """CTEs up to fc(symbol, step, date, prediction) for the recursive AR(1) close forecast."""
    return f"""{indexed()},
{ar1(('close',))},
st AS (SELECT p.symbol, p.date AS as_of, {nz('p', 'close')} AS z0, co.intercept AS a, co.slope AS b,
              p.mn_close AS mn, p.mx_close AS mx
       FROM pt p JOIN co ON co.symbol = p.symbol AND co.category = 'close' WHERE p.idx = p.n - 1),
rec AS (SELECT symbol, 1 AS step, a + b * z0 AS z FROM st
        UNION ALL
        SELECT rec.symbol, rec.step + 1, st.a + st.b * rec.z FROM rec JOIN st ON st.symbol = rec.symbol
        WHERE rec.step < {n}),
{calendar('st', n)},
fc AS (SELECT rec.symbol, CAST(rec.step AS BIGINT) AS step, cal.date, rec.z * (st.mx - st.mn) + st.mn AS prediction
       FROM rec JOIN st ON st.symbol = rec.symbol JOIN cal ON cal.symbol = rec.symbol AND cal.step = rec.step)"""


def docs() -> str:
    return """docs AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(value AS VARCHAR) AS open, CAST(value AS VARCHAR) AS high,
         CAST(value AS VARCHAR) AS low, CAST(value AS VARCHAR) AS close, CAST(user_id AS VARCHAR) AS volume,
         CAST(event_id AS VARCHAR) AS id
  FROM events)"""


def perceptron_ctes(key: str, inputs: int, hidden: int, classes: int, scale: float) -> str:
    """CTE ``top`` (key, prediction, top) from ``x`` (key, i, v): a perceptron with one hidden layer and ruled weights."""
    w = lambda i: f"((({i}) * 7919) % 2003 / 1001.5 - 1.0)"
    bias, after = inputs * hidden, (inputs + 1) * hidden
    return f"""h AS (SELECT {key}, o.o, 1 / (1 + exp(-(sum(x.v * {w(f'x.i * {hidden} + o.o')} * {scale!r}) + {w(f'{bias} + o.o')}))) AS v
  FROM x, range({hidden}) AS o(o) GROUP BY {key}, o.o),
z AS (SELECT {key}, c.c, sum(h.v * {w(f'{after} + h.o * {classes} + c.c')}) + {w(f'{after + hidden * classes} + c.c')} AS z
  FROM h, range({classes}) AS c(c) GROUP BY {key}, c.c),
top AS (SELECT {key}, CAST(arg_max(c, z) AS DOUBLE) AS prediction, round(1 / sum(exp(z - m)), 6) AS top
  FROM (SELECT *, max(z) OVER (PARTITION BY {key}) AS m FROM z) GROUP BY {key})"""


def build(filter_symbol: str, doc_field: str, doc_old: str, doc_new: str, bad_json: str,
          class_width: float, class_count: int, score_sizes: tuple[int, int, int, float], store_first: str, store_all: str, store_gone: str,
          small_l2: float) -> dict[str, str]:
    from ..config import CHART_HIGH, CHART_LOW, HORIZONS, SERIES_NAMES

    n_max = HORIZONS[-1][1]
    cls = lambda a: f"CAST(floor({a}.close / {class_width!r}) AS DOUBLE)"
    in_range = lambda k: f"floor(close / {class_width!r}) BETWEEN 0 AND {k - 1}"
    gappy = f"""raw AS ({BARS[BARS.index('(') + 1:-1]}),
bars AS (SELECT symbol, date, open, CASE WHEN day(date) % 7 <> 0 THEN close END AS close, low, high, volume FROM raw)"""
    one_all = " UNION ALL ".join(_one_ahead_rows(f) for f in F5)
    names = " ".join(f"WHEN '{f}' THEN '{SERIES_NAMES[f]}'" for f in F5)
    horizons = ", ".join(f"('{name}', {n})" for name, n in HORIZONS)
    stamp = "strftime(CAST({d} AS TIMESTAMP), '%Y-%m-%d %H:%M:00')"
    doc_cols = "date, open, high, low, close, volume, id"
    upd = lambda cond: ", ".join(
        f"CASE WHEN {cond} THEN '{doc_new}' ELSE {c} END AS {c}" if c == doc_field else c
        for c in doc_cols.split(", ")
    )
    q: dict[str, str] = {}
    q["preview"] = f"WITH {BARS} SELECT * FROM bars ORDER BY symbol, date LIMIT 20"
    q["typed_bars"] = f"WITH {BARS} SELECT * FROM bars"
    q["csv_bars_roundtrip"] = f"WITH {BARS} SELECT date, symbol, open, close, low, high, volume FROM bars"
    q["alt_layout_bars"] = f"WITH {BARS} SELECT * FROM bars"
    q["symbol_filter"] = f"WITH {BARS} SELECT * FROM bars WHERE symbol = '{filter_symbol}'"
    q["drop_null_rows"] = (f"WITH {BARS} SELECT symbol, date, open, close FROM bars "
                           f"WHERE open IS NOT NULL AND close IS NOT NULL")
    q["category_long"] = " UNION ALL ".join(
        f"SELECT symbol, date, '{f}' AS category, {f} AS value FROM bars" for f in F5
    ).replace("SELECT symbol", f"WITH {BARS} SELECT symbol", 1)
    q["symbol_counts"] = f"WITH {BARS} SELECT symbol, count(date) AS count FROM bars GROUP BY symbol"
    q["num_symbols"] = (f"WITH {BARS} SELECT count(*) AS num_symbols FROM "
                        f"(SELECT symbol FROM bars GROUP BY symbol) g")
    mm = ", ".join([f"min({f}) AS min_{f}" for f in F5] + [f"max({f}) AS max_{f}" for f in F5])
    q["feature_bounds"] = f"WITH {BARS} SELECT symbol, {mm} FROM bars GROUP BY symbol"
    q["bounds_by_category"] = f"WITH {BARS} " + " UNION ALL ".join(
        f"SELECT symbol, '{f}' AS category, min({f}) AS min_value, max({f}) AS max_value FROM bars GROUP BY symbol"
        for f in F5
    )
    q["window_counts"] = f"""WITH {indexed()}
SELECT symbol, CAST(max(split) AS BIGINT) AS n_train,
       CAST(greatest(max(split) - {L + H}, 0) AS BIGINT) AS n_train_windows,
       CAST(greatest(max(n) - max(split) - {L + H}, 0) AS BIGINT) AS n_test_windows
FROM pt GROUP BY symbol"""
    q["normalized_bars"] = f"WITH {indexed()} SELECT symbol, date, CAST(idx AS BIGINT) AS idx, {norm_cols('pt')} FROM pt"
    q["global_minmax"] = f"""WITH {BARS}, g AS (SELECT *, {', '.join(f'min({f}) OVER () AS gmn_{f}, max({f}) OVER () AS gmx_{f}' for f in F5)} FROM bars)
SELECT symbol, date, {', '.join(f"round(CASE WHEN gmx_{f} = gmn_{f} THEN 0.5 ELSE ({f} - gmn_{f}) / (gmx_{f} - gmn_{f}) END, 9) AS {f}" for f in ('open', 'low', 'high', 'volume', 'close'))}
FROM g"""
    q["denormalize_roundtrip"] = (
        f"WITH {indexed()} SELECT symbol, date, "
        + ", ".join(f"{nz('pt', f)} * (mx_{f} - mn_{f}) + mn_{f} AS {f}" for f in F5)
        + " FROM pt"
    )
    q["hash_split"] = f"""WITH {BARS}, h AS (
  SELECT symbol, date, CAST(('0x' || substr(md5(symbol || '|' || CAST(date AS VARCHAR) || '|1234'), 1, 8)) AS BIGINT) % 100 AS bucket
  FROM bars)
SELECT symbol, date, CAST(bucket AS BIGINT) AS bucket, CASE WHEN bucket < 60 THEN 'train' ELSE 'test' END AS part FROM h"""
    q["chrono_split"] = (f"WITH {indexed()} SELECT symbol, date, CAST(idx AS BIGINT) AS idx, part, "
                         f"CAST(part_idx AS BIGINT) AS part_idx FROM pt")
    q["test_windows"] = test_windows_long("close")
    q["test_windows_all"] = test_windows_long("all")
    q["train_windows_long"] = train_windows_long("close")
    q["train_windows_all"] = train_windows_long("all")
    q["latest_window"] = (f"WITH {indexed()} SELECT symbol, CAST(idx - (n - {L}) AS BIGINT) AS step, "
                          f"{norm_cols('pt')} FROM pt WHERE idx >= n - {L}")
    q["batch_assignment"] = f"""WITH {indexed()}
SELECT symbol, CAST(floor(part_idx / 64) AS BIGINT) AS batch_id, count(*) AS n_windows,
       CAST(min(part_idx) AS BIGINT) AS first_start, CAST(max(part_idx) AS BIGINT) AS last_start
FROM pt WHERE part = 'train' AND part_idx < part_n - {L + H} GROUP BY 1, 2"""
    q["holiday_flag"] = (f"WITH {BARS} SELECT symbol, date, strftime(date, '%m-%d') IN ({_holidays()}) AS is_holiday, "
                         f"isodow(date) >= 6 AS is_weekend FROM bars")
    q["weekday_names"] = (f"WITH {BARS} SELECT symbol, date, strftime(date, '%a') AS weekday_name, "
                          f"CAST(dayofweek(date) + 1 AS BIGINT) AS weekday_number, {stamp.format(d='date')} AS stamp FROM bars")
    q["trading_calendar"] = (f"WITH {BARS}, last AS (SELECT symbol, max(date) AS as_of FROM bars GROUP BY symbol), "
                             f"{calendar('last', n_max)} SELECT symbol, step, date FROM cal")
    q["ar1_fit"] = (f"WITH {indexed()}, {ar1(F5)} SELECT symbol, category, round(slope, 6) AS slope, "
                    f"round(intercept, 6) AS intercept, CAST(n_pairs AS BIGINT) AS n_pairs FROM co")
    q["close_on_open_fit"] = (f"WITH {BARS} SELECT symbol, round(regr_slope(close, open), 6) AS slope, "
                              f"round(regr_intercept(close, open), 2) AS intercept, "
                              f"CAST(regr_count(close, open) AS BIGINT) AS n FROM bars GROUP BY symbol")
    oa = f"WITH {indexed()}, {ar1(('close',))}, oa AS ({_one_ahead_rows('close')})"
    q["one_ahead"] = f"{oa} SELECT symbol, start_idx, round(prediction, 2) AS prediction, actual FROM oa"
    q["one_ahead_all"] = f"""WITH {indexed()}, {ar1(F5)}, oa AS ({one_all})
SELECT symbol, start_idx, category, CASE category {names} END AS series_name,
       round(prediction, 2) AS prediction, actual FROM oa"""
    q["prediction_series"] = (f"{oa} SELECT symbol, 'Predicts' AS series, start_idx AS x, round(prediction, 2) AS y FROM oa "
                              f"UNION ALL SELECT symbol, 'Actuals', start_idx, round(actual, 2) FROM oa")
    q["chart_bounds"] = (f"{oa} SELECT symbol, CAST(trunc(min(least(prediction, actual)) * {CHART_LOW!r}) AS BIGINT) AS y_min, "
                         f"CAST(trunc(max(greatest(prediction, actual)) * {CHART_HIGH!r}) AS BIGINT) AS y_max "
                         f"FROM oa GROUP BY symbol")
    q["forecast_mse"] = (f"{oa} SELECT symbol, round(avg(pow(prediction - actual, 2)), 0) AS mse, count(*) AS n "
                         f"FROM oa GROUP BY symbol")
    q["next_value"] = f"""WITH {indexed()}, {ar1(('close',))}
SELECT p.symbol, p.date AS as_of,
       round((co.intercept + co.slope * {nz('p', 'close')}) * (p.mx_close - p.mn_close) + p.mn_close, 2) AS prediction
FROM pt p JOIN co ON co.symbol = p.symbol AND co.category = 'close' WHERE p.idx = p.n - 1"""
    q["next_value_all"] = f"""WITH {indexed()}, {ar1(F5)}, nv AS (""" + " UNION ALL ".join(
        f"SELECT p.symbol, p.date AS as_of, '{f}' AS category, (co.intercept + co.slope * {nz('p', f)}) "
        f"* (p.mx_{f} - p.mn_{f}) + p.mn_{f} AS prediction FROM pt p JOIN co ON co.symbol = p.symbol "
        f"AND co.category = '{f}' WHERE p.idx = p.n - 1" for f in F5
    ) + ") SELECT symbol, as_of, category, round(prediction, 2) AS prediction FROM nv"
    starts = " UNION ALL ".join(
        f"SELECT p.symbol, '{f}' AS category, p.date AS as_of, {nz('p', f)} AS z0, co.intercept AS a, co.slope AS b, "
        f"p.mn_{f} AS mn, p.mx_{f} AS mx FROM pt p JOIN co ON co.symbol = p.symbol AND co.category = '{f}' "
        f"WHERE p.idx = p.n - 1" for f in F5)
    q["recursive_forecast_all"] = f"""WITH RECURSIVE {indexed()}, {ar1(F5)}, st5 AS ({starts}),
rec AS (SELECT symbol, category, 1 AS step, a + b * z0 AS z FROM st5
        UNION ALL
        SELECT rec.symbol, rec.category, rec.step + 1, st5.a + st5.b * rec.z FROM rec
        JOIN st5 ON st5.symbol = rec.symbol AND st5.category = rec.category WHERE rec.step < {n_max}),
last AS (SELECT DISTINCT symbol, as_of FROM st5),
{calendar('last', n_max)}
SELECT rec.symbol, rec.category, CAST(rec.step AS BIGINT) AS step, cal.date, round(rec.z * (st5.mx - st5.mn) + st5.mn, 2) AS prediction
FROM rec JOIN st5 ON st5.symbol = rec.symbol AND st5.category = rec.category
JOIN cal ON cal.symbol = rec.symbol AND cal.step = rec.step"""
    rec = f"WITH RECURSIVE {forecast_ctes(n_max)}"
    q["recursive_forecast"] = f"{rec} SELECT symbol, step, date, round(prediction, 2) AS prediction FROM fc"
    q["forecast_payload"] = f"""{rec}
SELECT symbol, {', '.join(f'count(*) FILTER (step <= {n}) AS {name}_n' for name, n in HORIZONS)},
       {stamp.format(d='min(date)')} AS first_date, {stamp.format(d='max(date)')} AS last_date,
       {' AND '.join(f"list(prediction ORDER BY step) FILTER (step <= {n}) = list(prediction ORDER BY step)[1:{n}]"
                     f" AND list(date ORDER BY step) FILTER (step <= {n}) = list(date ORDER BY step)[1:{n}]"
                     for _, n in HORIZONS[:-1])} AS prefix_ok, round(sum(prediction), 0) AS sum_max, symbol AS json_symbol
FROM fc GROUP BY symbol"""
    q["forecast_horizons"] = f"""{rec}, hz(horizon, len) AS (VALUES {horizons})
SELECT fc.symbol, hz.horizon, fc.step, {stamp.format(d='fc.date')} AS date, round(fc.prediction, 2) AS prediction
FROM fc JOIN hz ON fc.step <= hz.len"""
    q["price_class_labels"] = (f"WITH {BARS} SELECT symbol, date, open, {cls('bars')} AS label FROM bars "
                               f"WHERE {in_range(class_count)}")
    q["price_class_rejects"] = f"""WITH {gappy}
SELECT symbol, date, open, close, CASE WHEN open IS NULL OR close IS NULL THEN 'no price' ELSE 'beyond the classes' END AS reason
FROM bars WHERE open IS NULL OR close IS NULL OR NOT {in_range(class_count // 2)}"""
    split = f"""h AS (SELECT symbol, date, close, CAST(('0x' || substr(md5(symbol || '|' || CAST(date AS VARCHAR) || '|1234'), 1, 8)) AS BIGINT) % 100 AS bucket
  FROM bars WHERE {in_range(class_count)})"""
    q["price_class_split"] = f"""WITH {BARS}, {split}
SELECT symbol, date, {cls('h')} AS label, CASE WHEN bucket < 60 THEN 'train' ELSE 'test' END AS part FROM h"""
    q["price_class_accuracy"] = f"WITH {BARS}, {split} SELECT count(*) AS n, true AS in_range FROM h WHERE bucket >= 60"
    q["vector_classifier_accuracy"] = """SELECT count(*) AS n, true AS in_range FROM embeddings
WHERE CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '|1234'), 1, 8)) AS BIGINT) % 100 >= 60"""
    hidden, dim, vector_classes, price_scale = score_sizes
    q["price_class_scores"] = f"""WITH {BARS}, ids AS (SELECT symbol, date, {cls('bars')} AS label, open FROM bars
  WHERE {in_range(class_count)}),
x AS (SELECT symbol, date, 0 AS i, open AS v FROM ids),
{perceptron_ctes("symbol, date", 1, hidden, class_count, price_scale)}
SELECT ids.symbol, ids.date, ids.label, top.prediction, top.top FROM ids JOIN top USING (symbol, date)"""
    q["vector_classifier_scores"] = f"""WITH x AS (
  SELECT vec_id, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
{perceptron_ctes("vec_id", dim, hidden, vector_classes, 1.0)}
SELECT e.vec_id, CAST(e.label AS DOUBLE) AS label, top.prediction, top.top FROM embeddings e JOIN top USING (vec_id)"""
    q["train_windows_nulls"] = train_windows_long("close").replace(BARS, gappy)
    q["window_regressor_frame"] = f"""WITH {indexed().replace(BARS, gappy)}
SELECT a.symbol, CAST(a.part_idx AS BIGINT) AS start_idx, round(any_value({nz('c', 'close')}), 9) AS label,
       round(sum({' + '.join(f'coalesce({nz("b", f)}, 0)' for f in F5)}), 6) AS feature_sum
FROM pt a
JOIN pt b ON b.symbol = a.symbol AND b.part = a.part AND b.part_idx BETWEEN a.part_idx AND a.part_idx + {L - 1}
JOIN pt c ON c.symbol = a.symbol AND c.part = a.part AND c.part_idx = a.part_idx + {L}
WHERE a.part = 'train' AND a.part_idx < a.part_n - {L + H}
GROUP BY a.symbol, a.part_idx
HAVING count(b.close) = {L} AND any_value({nz('c', 'close')}) IS NOT NULL"""
    c = lambda a: nz(a, "close")
    small = f"""{indexed()},
two AS (SELECT a.symbol, a.part, a.part_idx, a.part_n, {c('a')} AS x0, {c('b')} AS x1, {c('d')} AS y, d.close AS actual,
               a.mn_close AS mn, a.mx_close AS mx
        FROM pt a JOIN pt b ON b.symbol = a.symbol AND b.part = a.part AND b.part_idx = a.part_idx + 1
        JOIN pt d ON d.symbol = a.symbol AND d.part = a.part AND d.part_idx = a.part_idx + 2
        WHERE a.part_idx < a.part_n - 3),
mo AS (SELECT symbol, count(*) AS n, avg(x0) AS m0, avg(x1) AS m1, avg(y) AS my,
              covar_pop(x0, x0) + {small_l2!r} AS s00, covar_pop(x1, x1) + {small_l2!r} AS s11, covar_pop(x0, x1) AS s01,
              covar_pop(x0, y) AS t0, covar_pop(x1, y) AS t1 FROM two WHERE part = 'train' GROUP BY symbol),
sv AS (SELECT *, (t0 * s11 - t1 * s01) / (s00 * s11 - s01 * s01) AS w0,
              (t1 * s00 - t0 * s01) / (s00 * s11 - s01 * s01) AS w1 FROM mo)"""
    q["symbol_regressor_fit"] = f"""WITH {small}
SELECT symbol, n AS n_windows, round(my - w0 * m0 - w1 * m1, 7) AS intercept, round(w0, 7) AS w0, round(w1, 7) AS w1 FROM sv"""
    q["symbol_regressor_scores"] = f"""WITH {small}
SELECT two.symbol, CAST(part_idx AS BIGINT) AS start_idx,
       round((my - w0 * m0 - w1 * m1 + w0 * x0 + w1 * x1) * (mx - mn) + mn, 2) AS prediction, actual
FROM two LEFT JOIN sv ON sv.symbol = two.symbol WHERE part = 'test'"""
    q["symbol_forecast"] = f"""WITH RECURSIVE {small},
st AS (SELECT l.symbol, l.date AS as_of, {c('k')} AS z0, {c('l')} AS z1, l.mn_close AS mn, l.mx_close AS mx, w0, w1,
              my - w0 * m0 - w1 * m1 AS b
       FROM pt l JOIN pt k ON k.symbol = l.symbol AND k.idx = l.idx - 1 JOIN sv ON sv.symbol = l.symbol WHERE l.idx = l.n - 1),
rec AS (SELECT symbol, 1 AS step, z1 AS before, b + w0 * z0 + w1 * z1 AS z FROM st
        UNION ALL
        SELECT rec.symbol, rec.step + 1, rec.z, st.b + st.w0 * rec.before + st.w1 * rec.z
        FROM rec JOIN st ON st.symbol = rec.symbol WHERE rec.step < {n_max}),
{calendar('st', n_max)}
SELECT rec.symbol, CAST(rec.step AS BIGINT) AS step, cal.date, round(rec.z * (st.mx - st.mn) + st.mn, 2) AS prediction
FROM rec JOIN st ON st.symbol = rec.symbol JOIN cal ON cal.symbol = rec.symbol AND cal.step = rec.step"""
    from .training import DECAY, EPSILON, LEARNING_RATE

    def rms(k: int) -> str:  # one parameter's step
        return f"w{k} - {LEARNING_RATE!r} * g{k} / (sqrt({DECAY!r} * c{k} + {1 - DECAY!r} * g{k} * g{k}) + {EPSILON!r}) AS w{k}, " \
               f"{DECAY!r} * c{k} + {1 - DECAY!r} * g{k} * g{k} AS c{k}"

    q["training_losses"] = f"""WITH RECURSIVE {indexed()},
p AS (SELECT {c('a')} AS x, {c('b')} AS y FROM pt a
      JOIN pt b ON b.symbol = a.symbol AND b.part = a.part AND b.part_idx = a.part_idx + 1
      WHERE a.part = 'train' AND a.part_idx < a.part_n - 2),
m AS (SELECT avg(x) AS x1, avg(x * x) AS x2, avg(y) AS y1, avg(x * y) AS xy, avg(y * y) AS y2 FROM p),
it AS (SELECT 0 AS k, CAST(0 AS DOUBLE) AS w0, CAST(0 AS DOUBLE) AS c0, CAST(0 AS DOUBLE) AS w1, CAST(0 AS DOUBLE) AS c1
       UNION ALL
       SELECT k + 1, {rms(0)}, {rms(1)}
       FROM (SELECT it.*, 2 * (w0 + w1 * x1 - y1) AS g0, 2 * (w0 * x1 + w1 * x2 - xy) + {small_l2!r} * w1 AS g1
             FROM it, m WHERE k < 50) t)
SELECT CAST(k AS BIGINT) AS iteration,
       round(y2 - 2 * (w0 * y1 + w1 * xy) + w0 * w0 + 2 * w0 * w1 * x1 + w1 * w1 * x2 + {small_l2!r} / 2 * w1 * w1, 7) AS loss
FROM it, m WHERE k % 10 = 0"""
    q["model_forecast_keys"] = f"""WITH {indexed()}, st AS (SELECT symbol, date AS as_of, n FROM pt WHERE idx = n - 1),
{calendar('st', n_max)}
SELECT cal.symbol, cal.step, cal.date, st.n >= {L} AS scored FROM cal JOIN st ON st.symbol = cal.symbol"""
    q["accuracy"] = f"""WITH {indexed()}
SELECT a.symbol, avg(CASE WHEN {cls('a')} = {cls('b')} THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n
FROM pt a JOIN pt b ON b.symbol = a.symbol AND b.part = a.part AND b.part_idx = a.part_idx + 1
WHERE a.part = 'test' GROUP BY a.symbol"""
    q["docs_scan"] = f"WITH {docs()} SELECT * FROM docs"
    q["json_insert"] = f"""WITH ev AS (SELECT event_id, props AS text FROM events
                  UNION ALL SELECT max(event_id) + 1, '{bad_json}' FROM events)
SELECT event_id, CASE WHEN json_valid(text) THEN CAST(json_extract(text, '$.k') AS BIGINT) END AS k,
       CASE WHEN json_valid(text) THEN 'inserted' ELSE 'rejected' END AS status
FROM ev"""
    q["json_store"] = f"""WITH {docs()}
SELECT {doc_cols} FROM docs
UNION ALL SELECT NULL, open, NULL, NULL, NULL, NULL, 'new-' || id FROM docs"""
    q["nth_trading_day"] = f"""WITH cal AS (SELECT unnest(['fixed', 'none']) AS calendar),
days AS (SELECT calendar, CAST(unnest(generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '2026-01-31', INTERVAL '1 day')) AS DATE) AS date FROM cal),
td AS (SELECT calendar, date, row_number() OVER (PARTITION BY calendar ORDER BY date) AS rank FROM days
       WHERE isodow(date) < 6 AND NOT (calendar = 'fixed' AND strftime(date, '%m-%d') IN ({_holidays()}))),
ev AS (SELECT event_id, CAST(ts AS DATE) AS as_of, user_id % 250 + 1 AS n,
              CASE WHEN user_id % 2 = 0 THEN 'fixed' ELSE 'none' END AS calendar FROM events),
b AS (SELECT ev.event_id, max(td.rank) AS rank FROM ev JOIN td ON td.calendar = ev.calendar AND td.date <= ev.as_of + 1 GROUP BY 1)
SELECT ev.event_id, ev.as_of, ev.n, ev.calendar, td.date AS day FROM ev JOIN b ON b.event_id = ev.event_id
LEFT JOIN td ON td.calendar = ev.calendar AND td.rank = b.rank + ev.n"""
    q["maintained_stats"] = f"""WITH {BARS}
SELECT symbol, count(*) AS n, CAST(floor(count(*) * CAST({SERIES_SPLIT!r} AS DOUBLE) + 0.5) AS BIGINT) AS split,
       {', '.join(f'min({f}) AS mn_{f}, max({f}) AS mx_{f}' for f in F5)}
FROM bars GROUP BY symbol"""
    q["bucketed_bars"] = f"""WITH {BARS}
SELECT symbol, date, close, max(high) OVER (PARTITION BY symbol) AS top,
       high = max(high) OVER (PARTITION BY symbol) AS is_top FROM bars"""
    q["store_typed"] = f"""SELECT event_id AS id, value AS price, user_id AS "user", user_id % 2 = 0 AS even,
       CAST(NULL AS VARCHAR) AS missing,
       CAST(to_json({{"by": {{"even": user_id % 2 = 0, "user": user_id}}, date: strftime(ts, '%Y-%m-%d'),
                id: CAST(event_id AS VARCHAR), kind: event_type, open: CAST(value AS VARCHAR)}}) AS VARCHAR) AS text FROM events
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, '{bad_json}'"""
    q["store_chain"] = f"""WITH {BARS}, ev AS (
  SELECT *, event_id = (SELECT min(event_id) FROM events WHERE event_type = '{store_first}') AS hit FROM events)
SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(value AS VARCHAR) AS open, CAST(NULL AS VARCHAR) AS high,
       CAST(event_id AS VARCHAR) AS id,
       CASE WHEN hit THEN 'first' WHEN event_type = '{store_all}' THEN 'all' ELSE event_type END AS kind, user_id AS "user"
FROM ev WHERE event_type <> '{store_gone}' AND CAST(value AS VARCHAR) <> '{doc_old}'
UNION ALL
SELECT CAST(date AS VARCHAR), CAST(open AS VARCHAR), CAST(high AS VARCHAR), 'bar-' || symbol, NULL, NULL FROM bars
WHERE CAST(open AS VARCHAR) <> '{doc_old}'"""
    q["bar_rejects"] = f"""WITH {BARS}
SELECT CASE day(date) % 14 WHEN 7 THEN 'fields' WHEN 0 THEN 'date' ELSE 'bar' END AS reason, count(*) AS n FROM bars GROUP BY 1"""
    q["record_append"] = f"""WITH {docs()}, {BARS}
SELECT {doc_cols} FROM docs
UNION ALL
SELECT CAST(date AS VARCHAR), CAST(open AS VARCHAR), CAST(high AS VARCHAR), CAST(low AS VARCHAR),
       CAST(close AS VARCHAR), CAST(volume AS VARCHAR), 'bar-' || symbol FROM bars"""
    q["update_first_match"] = f"""WITH {docs()},
first AS (SELECT min(CAST(id AS BIGINT)) AS k FROM docs WHERE {doc_field} = '{doc_old}')
SELECT {upd(f"{doc_field} = '{doc_old}' AND CAST(id AS BIGINT) = (SELECT k FROM first)")} FROM docs"""
    q["update_all_matches"] = f"WITH {docs()} SELECT {upd(f'{doc_field} = {chr(39)}{doc_old}{chr(39)}')} FROM docs"
    q["delete_by_field"] = f"WITH {docs()} SELECT * FROM docs WHERE {doc_field} IS DISTINCT FROM '{doc_old}'"
    q["request_forecasts"] = f"""{rec},
req AS (SELECT e.event_id AS request_id, o.o_orderpriority AS symbol FROM events e
        LEFT JOIN orders o ON o.o_orderkey = e.event_id),
f1 AS (SELECT symbol, {stamp.format(d='date')} AS first_date, round(prediction, 2) AS first_prediction FROM fc WHERE step = 1),
nn AS (SELECT symbol, count(*) AS n_points FROM fc GROUP BY symbol)
SELECT req.request_id, req.symbol, f1.first_date, f1.first_prediction, CAST(nn.n_points AS INTEGER) AS n_points
FROM req LEFT JOIN f1 ON f1.symbol = req.symbol LEFT JOIN nn ON nn.symbol = req.symbol"""
    tb = ", ".join(f"min({f}) AS tmn_{f}, max({f}) AS tmx_{f}" for f in F5)
    q["normalized_bars_train_bounds"] = f"""WITH {indexed()},
tb AS (SELECT symbol, {tb} FROM pt WHERE part = 'train' GROUP BY symbol)
SELECT pt.symbol, pt.date, CAST(pt.idx AS BIGINT) AS idx,
       {', '.join(f'(pt.{f} - tb.tmn_{f}) / nullif(tb.tmx_{f} - tb.tmn_{f}, 0) AS {f}' for f in F5)}
FROM pt LEFT JOIN tb ON tb.symbol = pt.symbol"""
    q["stream_forecast_responses"] = q["request_forecasts"]
    q["libsvm_roundtrip"] = "SELECT CAST(label AS DOUBLE) AS label, " + ", ".join(
        f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(64)
    ) + " FROM embeddings"
    return q
