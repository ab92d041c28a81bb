"""Forecast requests answered by Structured Streaming (K1).

Requests arrive as files (any file source; a message bus is a ``format`` swap).
Each micro-batch is joined stream-static with the per-symbol forecast table
and appended to a file sink. The checkpoint plus the file sink's commit log
make every request answered exactly once across restarts. The forecast table
is written once per version, so micro-batches never recompute it.

A forecast is long (1,200 points) and there is one per symbol, so the stream
answers with a reference, (request, symbol, version), and
:func:`delivered` gives the text with it: a payload is stored once however
many requests ask for it. :func:`start_request_stream` is the form that writes
the text beside every request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import shared_dir
from ..operators.joins import salted_join

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType(), False),
    T.StructField("symbol", T.StringType(), True),
])


def requests_from_events(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Fixture adapter: one request per event; its symbol is the priority of the order with the same key."""
    o = orders.select(F.col("o_orderkey").alias("request_id"), F.col("o_orderpriority").alias("symbol"))
    return events.select(F.col("event_id").alias("request_id")).join(o, "request_id", "left")


def answer(requests: DataFrame, payload: DataFrame) -> DataFrame:
    """Batch twin: every request with its symbol's forecast (NULL when the symbol has none).

    Give ``payload`` as a written table: adaptive execution splits the requests of a symbol that measures skewed only
    where the other side of the join is shuffled for the join itself, and then copies no payload but that symbol's.
    """
    pts = F.col("forecast.max")
    fc = payload.select(
        "symbol", "payload",
        F.element_at(pts, 1)["date"].alias("first_date"),
        F.element_at(pts, 1)["prediction"].alias("first_prediction"),
        F.size(pts).alias("n_points"),
    )
    return requests.join(fc, "symbol", "left").select(
        "request_id", "symbol", "first_date", "first_prediction", "n_points", F.col("payload").alias("response")
    )


def path_bytes(spark: SparkSession, path: str) -> int:
    """On-disk size of a path (file-system metadata only, any Hadoop scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def size_bytes(spark: SparkSession, text: str) -> int:
    """A size setting in bytes, read as Spark reads it ('10MB', '10485760b', '-1')."""
    text = str(text).strip()
    if text.lstrip("-").isdigit():
        return int(text)
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def sized_join(spark: SparkSession, stream: DataFrame, static: DataFrame, static_path: str, key: str = "symbol",
               salts: int | None = None, max_broadcast_bytes: int | None = None) -> DataFrame:
    """Stream-static left join with the strategy chosen from the static table's measured size.

    Micro-batches run without adaptive execution, so there is no runtime
    broadcast or skew split. The static side is broadcast only when its files
    are under the limit (default: ``spark.sql.autoBroadcastJoinThreshold``);
    beyond it the join is salted: each static row is copied to ``salts``
    buckets and each request goes to one bucket chosen by its id, so a symbol
    holding a third of the requests is spread over ``salts`` tasks (default: the
    session's shuffle partitions).
    """
    if max_broadcast_bytes is None:
        max_broadcast_bytes = size_bytes(spark, spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    if 0 < path_bytes(spark, static_path) <= max_broadcast_bytes:
        return stream.join(F.broadcast(static), key, "left")
    return salted_join(stream, static, key, "xxhash64(request_id)", salts)


def start_request_stream(spark: SparkSession, requests_dir: str, forecast_dir: str, sink_dir: str,
                         checkpoint_dir: str, max_broadcast_bytes: int | None = None,
                         max_files: int | None = None):
    """Start the streaming query; returns the StreamingQuery (trigger: all available, then stop).

    ``max_files`` bounds the request files of a micro-batch.
    """
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    reqs = reader.parquet(requests_dir)
    fc = spark.read.parquet(forecast_dir).select("symbol", "payload")
    out = sized_join(spark, reqs, fc, forecast_dir, max_broadcast_bytes=max_broadcast_bytes).select(
        "request_id", "symbol", F.col("payload").alias("response")
    )
    return (
        out.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start(sink_dir)
    )


def write_forecasts(payload: DataFrame, forecast_dir: str, version: int) -> None:
    """The forecasts of one version, one row per symbol; earlier versions stay for the requests they answered."""
    payload.select("symbol", "payload").write.mode("error").parquet(f"{forecast_dir}/version={int(version)}")


def start_reference_stream(spark: SparkSession, requests_dir: str, forecast_dir: str, version: int, sink_dir: str,
                           checkpoint_dir: str, max_broadcast_bytes: int | None = None, max_files: int | None = None):
    """Answer requests with (request_id, symbol, version) of the forecasts; version is NULL for a symbol without one.

    Only symbols meet the requests, so the static side is broadcast unless their table itself is over the limit, and
    the salted join beyond it copies symbols, never payloads.
    """
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    known_dir = f"{forecast_dir}/symbols-{int(version)}"
    spark.read.parquet(f"{forecast_dir}/version={int(version)}").select("symbol", F.lit(int(version)).alias("version")) \
        .write.mode("overwrite").parquet(known_dir)
    out = sized_join(spark, reader.parquet(requests_dir), spark.read.parquet(known_dir), known_dir,
                     max_broadcast_bytes=max_broadcast_bytes).select("request_id", "symbol", "version")
    return (
        out.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start(sink_dir)
    )


def references(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.schema("request_id BIGINT, symbol STRING, version INT").parquet(sink_dir)


def forecasts(spark: SparkSession, forecast_dir: str) -> DataFrame:
    """(symbol, version, payload) of every version written."""
    return spark.read.schema("symbol STRING, payload STRING, version INT").option("basePath", forecast_dir) \
        .parquet(f"{forecast_dir}/version=*")


def delivered(spark: SparkSession, sink_dir: str, forecast_dir: str) -> DataFrame:
    """(request_id, symbol, response): every answered request with the text of the forecast it refers to."""
    return references(spark, sink_dir).join(forecasts(spark, forecast_dir), ["symbol", "version"], "left").select(
        "request_id", "symbol", F.col("payload").alias("response"))


def run_request_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Registered form: requests derived from events, answered by the stream; the sink and the forecasts' folder."""
    from ..operators.series import index_series
    from ..plans.forecast import forecast_payload, recursive_forecast
    from ..sources.bars import load_bars

    base = shared_dir(spark, "requests")
    req_dir, fc_dir, sink, ckpt = (f"{base}/in", f"{base}/forecast", f"{base}/out", f"{base}/checkpoint")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    # Requests land as many files (one per writer task), as they would from many producers.
    parts = spark.sparkContext.defaultParallelism
    requests_from_events(events, orders).repartition(parts, "request_id").write.mode("overwrite").parquet(req_dir)
    write_forecasts(forecast_payload(recursive_forecast(index_series(load_bars(spark, sf_dir)), "close")), fc_dir, 1)
    start_reference_stream(spark, req_dir, fc_dir, 1, sink, ckpt).awaitTermination()
    return sink, fc_dir
