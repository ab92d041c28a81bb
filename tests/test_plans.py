"""Physical-plan checks: pushdown, pruning, one scan per input, no whole-symbol partitions."""
import re

import __spark_entry__ as E
from barframe.plans import catalog


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_symbol_filter_reaches_the_scan(spark, sf_small):
    df = E.queries()["symbol_filter"](spark, sf_small)
    plan = _formatted(df)
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,3-MEDIUM)]" in plan


def test_bars_read_only_needed_columns(spark, sf_small):
    plan = _formatted(E.queries()["feature_bounds"](spark, sf_small))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert "o_custkey" not in schema and "o_orderstatus" not in schema
    assert "o_totalprice" in schema and "o_orderkey" in schema


def test_series_input_scanned_once(spark, sf_small):
    for name in ("normalized_bars", "test_windows", "recursive_forecast", "window_counts", "json_insert"):
        plan = _final_plan(E.queries()[name](spark, sf_small))
        assert plan.count("FileScan parquet") <= (2 if name == "json_insert" else 1), name


def test_one_ahead_moves_no_windows_and_no_whole_symbol(spark, sf_small):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("one_ahead", "one_ahead_all", "prediction_series", "chart_bounds", "forecast_mse",
                     "normalized_bars_train_bounds"):
            plan = _formatted(E.queries()[name](spark, sf_small))
            # The join that bars meet is on (symbol, block), and no window array is built for scoring.
            assert re.search(r"Left keys \[2\]: \[symbol#\d+, _blk#\d+L\]", plan), name
            assert "collect_list" not in plan, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_whole_symbol_partition_for_ranking_or_windows(spark, sf_small):
    plan = _final_plan(E.queries()["train_windows_long"](spark, sf_small))
    found = list(re.finditer(r"(row_number|collect_list)\(.{0,400}?windowspecdefinition\(([^,]+), ([^,]+)", plan))
    assert len(found) >= 2
    for m in found:
        second_key = m.group(3)
        assert second_key.startswith("_bucket") or second_key.startswith("part"), m.group(0)
    # the block window is preceded by its own (symbol, part, block) exchange
    assert re.search(r"Exchange hashpartitioning\(symbol#\d+, part#\d+, _blk#\d+L?", plan)


def test_no_python_udf_in_sql_queries(spark, sf_small):
    for name in catalog.SQL:
        if name in ("csv_bars_roundtrip", "alt_layout_bars", "docs_scan", "json_store", "bar_rejects"):
            continue  # these write files first; their plans are plain scans
        plan = _formatted(E.queries()[name](spark, sf_small))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_light_keys_are_not_copied_and_heavy_ones_are_cut(spark):
    from barframe.operators.joins import block_join

    rows = spark.range(1000).selectExpr("IF(id < 900, 'hot', concat('s', id)) AS symbol", "IF(id < 900, id, 0L) AS i")
    small = rows.groupBy("symbol").count()
    out = block_join(rows, small, "symbol", "i", "count", block_rows=100)
    assert out.columns == ["symbol", "i", "count"]
    assert sorted(map(tuple, out.collect())) == sorted((f"s{k}", 0, 1) if k >= 900 else ("hot", k, 900) for k in range(1000))
    copies = small.selectExpr("symbol", "explode(sequence(0L, (count - 1) DIV 100)) AS b").groupBy("symbol").count()
    assert {r["symbol"]: r["count"] for r in copies.collect()} == {"hot": 9, **{f"s{k}": 1 for k in range(900, 1000)}}


def test_requests_of_a_hot_symbol_are_split_at_run_time(spark, sf_small):
    from barframe.streaming import requests as K

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        req = spark.range(20_000).selectExpr("id AS request_id", "IF(id % 3 > 0, 'hot', concat('s', id % 40)) AS symbol")
        req = req.repartition(8)
        fc = spark.range(41).selectExpr("IF(id = 40, 'hot', concat('s', id)) AS symbol").selectExpr(
            "symbol", "concat('{', symbol, '}') AS payload",
            "named_struct('max', array(named_struct('prediction', 1D, 'date', '2020-01-01'))) AS forecast")
        out = K.answer(req, fc)
        assert "skew=true" in _final_plan(out)
        assert out.where("response = concat('{', symbol, '}') AND n_points = 1").count() == 20_000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
