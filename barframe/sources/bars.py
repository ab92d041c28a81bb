"""Price-bar sources: CSV layouts, typing, and the orders adapter used as fixture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import FEATURES, LAYOUT_1, LAYOUT_2

BAR_STRINGS = T.StructType([T.StructField(c, T.StringType(), True) for c in LAYOUT_1])

BAR_SCHEMA = T.StructType(
    [T.StructField("symbol", T.StringType(), True), T.StructField("date", T.DateType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in FEATURES]
)


def parse_double(c: Column | str) -> Column:
    """Text to double; bad text and NaN become NULL instead of failing the job."""
    v = F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def typed_bars(raw: DataFrame) -> DataFrame:
    """Type a string bar frame (P2/P3): one projection, named columns, no positional rename."""
    return raw.select(
        F.col("symbol").cast("string").alias("symbol"),
        F.expr("try_cast(date AS DATE)").alias("date"),
        *[parse_double(c).alias(c) for c in FEATURES],
    )


def read_bars_csv(spark: SparkSession, path: str) -> DataFrame:
    """Layout 1 (date, symbol, open, close, low, high, volume), header row, all text."""
    raw = spark.read.csv(path, header=True, schema=BAR_STRINGS, enforceSchema=True)
    return typed_bars(raw)


def read_bars_csv_checked(spark: SparkSession, path: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Layout 1 with a reject output: (bars, rejects).

    A line with too few or too many fields, without a symbol, or with a date
    that is not one is rejected: (line, reason). Every line but the header is in
    one of the two. A price that is no number is NULL, as in :func:`read_bars_csv`.
    """
    schema = T.StructType([*BAR_STRINGS.fields, T.StructField("_line", T.StringType(), True)])
    # With pruned columns a line would be counted against the columns read, not those it should have.
    raw = spark.read.option("columnPruning", False).csv(path, header=header, schema=schema, enforceSchema=True, mode="PERMISSIVE",
                         columnNameOfCorruptRecord="_line")
    reason = (F.when(F.col("_line").isNotNull(), "fields")
              .when(F.expr("try_cast(date AS DATE)").isNull(), "date")
              .when(F.col("symbol").isNull(), "symbol"))
    line = F.coalesce("_line", F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in LAYOUT_1]))
    checked = raw.withColumn("reason", reason)
    return (typed_bars(checked.filter("reason IS NULL")),
            checked.filter("reason IS NOT NULL").select(line.alias("line"), "reason"))


def read_alt_bars_csv(spark: SparkSession, path: str, mixed_headers: bool = False) -> DataFrame:
    """Layout 2 (symbol, date, open, high, low, close, volume), UTF-8, header (S3).

    Columns are bound by the names in the header, in whatever order the file has them. In a folder all files must have
    the header of one: another one fails the read. With ``mixed_headers`` each file's columns are bound by its own
    header, in a second scan that looks for the headers; a file without all names in a header fails the read.
    """
    if mixed_headers:
        return typed_bars(_by_own_header(spark, path))
    # Headers are compared with the columns read: all of them, whatever a query selects.
    raw = spark.read.option("columnPruning", False).csv(path, header=True, inferSchema=False, encoding="UTF-8",
                                                        enforceSchema=False)
    missing = [c for c in LAYOUT_2 if c not in raw.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path}")
    return typed_bars(raw)


def _by_own_header(spark: SparkSession, path: str) -> DataFrame:
    """Text rows (LAYOUT_2) of files whose headers may differ: the header is a row that holds all the names."""
    line = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    width = line.agg(F.max(F.size(F.split("value", ",")))).first()[0] or 1
    cells = [f"c{i}" for i in range(width)]
    rows = spark.read.csv(path, header=False, encoding="UTF-8", schema=", ".join(f"{c} string" for c in cells)).select(
        F.array(*cells).alias("cells"), F.col("_metadata.file_path").alias("file"))
    is_header = F.lit(True)
    for name in LAYOUT_2:
        is_header &= F.coalesce(F.array_contains("cells", name), F.lit(False))
    # One row per file, in a join that is a broadcast only where it measures small.
    heads = rows.where(is_header).groupBy(F.col("file").alias("of")).agg(F.min("cells").alias("names"))
    names = F.expr("coalesce(names, raise_error(concat('no header with all columns in ', file)))")
    bound = rows.where(~is_header).join(heads, F.col("file") == F.col("of"), "left").select("cells", names.alias("names"))
    return bound.select(*[F.expr(f"cells[array_position(names, '{c}') - 1]").alias(c) for c in LAYOUT_2])


def counted(df: DataFrame, name: str = "rows"):
    """Attach a row-count observation; read ``obs.get["n"]`` after the first action (no extra job)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs


def write_bars_csv(bars: DataFrame, path: str, layout: tuple[str, ...] = LAYOUT_1) -> None:
    """Write bars as text in one of the two layouts (header row)."""
    cols = [F.col(c).cast("string").alias(c) for c in layout]
    bars.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def write_bars_table(bars: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bars as Parquet, one directory per symbol: a symbol filter on read becomes partition pruning.

    Rows are hash-distributed on (symbol, year) before the write, so a symbol
    holding a third of the data is written by many tasks.
    """
    (
        bars.select("symbol", "date", *FEATURES)
        .repartition("symbol", F.year("date"))
        .write.mode(mode).partitionBy("symbol").parquet(path)
    )


def read_bars_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a bars table written by :func:`write_bars_table` (symbol comes back from the directory names)."""
    return spark.read.schema(BAR_SCHEMA).parquet(path).select("symbol", "date", *FEATURES)


def write_bucketed_bars(bars: DataFrame, table: str, path: str, buckets: int, by: str = "symbol") -> None:
    """Bars as a table of ``buckets`` hash buckets by symbol, sorted inside, with a Bloom filter on the symbol.

    Tables with the same buckets are joined and aggregated by symbol without a shuffle, and a filter on symbols reads
    their buckets only; unlike :func:`write_bars_table` the number of files does not grow with the symbols. Rows are
    brought to their bucket before the write, so a bucket is one file; a symbol with a third of the rows is one bucket,
    so give such series to :func:`write_bars_table`, which cuts them by year.
    """
    names = ["symbol", "date", *[c for c in bars.columns if c not in ("symbol", "date")]]
    (bars.select(*names).repartition(buckets, by).write.mode("error").bucketBy(buckets, by).sortBy(by, "date")
     .option("path", path).option(f"parquet.bloom.filter.enabled#{by}", "true").saveAsTable(table))


def read_bucketed_bars(spark: SparkSession, table: str) -> DataFrame:
    """A table written by :func:`write_bucketed_bars`."""
    return spark.table(table)


def bars_from_orders(orders: DataFrame) -> DataFrame:
    """Fixture adapter: daily bars from the orders table.

    symbol = order priority, date = order day, open/close = price of the
    first/last order key of the day, low/high = min/max price, volume = orders.
    A partial (map-side) hash aggregate, so a hot symbol is combined before the
    shuffle and each (symbol, date) group is one row.
    """
    return (
        orders.select(
            F.col("o_orderpriority").alias("symbol"),
            F.to_date("o_orderdate").alias("date"),
            "o_orderkey",
            "o_totalprice",
        )
        .groupBy("symbol", "date")
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.min("o_totalprice").alias("low"),
            F.max("o_totalprice").alias("high"),
            F.count(F.lit(1)).cast("double").alias("volume"),
        )
    )


def load_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"))


def bars_as_text(bars: DataFrame) -> DataFrame:
    """Bars rendered the way a CSV file holds them: every column a string."""
    return bars.select(*[F.col(c).cast("string").alias(c) for c in LAYOUT_1])

