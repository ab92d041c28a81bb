"""Trading days by rank and select over a holiday table per calendar (F1, F2).

The column functions of ``calendar`` know one fixed list and lay out 2n + 30 days for each row that asks for n. Here a
calendar is data: a table of holidays, by month and day of every year or by date. Its days are numbered once (366 rows a
year and calendar), and then the n-th trading day after a date is two look-ups: the date's rank, and the day whose rank
is n higher. A calendar's table is bounded by its years, never by the rows that ask.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIRST_OFFSET_DAYS, HOLIDAYS

DEFAULT = "default"


def fixed_holidays(spark: SparkSession, calendar: str = DEFAULT) -> DataFrame:
    """The fixed month-day list as a holiday table: (calendar, month_day, date), the date being NULL."""
    return spark.createDataFrame([(calendar, d, None) for d in HOLIDAYS], "calendar string, month_day string, date date")


def trading_days(holidays: DataFrame, start: str, end: str) -> DataFrame:
    """(calendar, date, trading, rank) for every day from ``start`` to ``end`` of every calendar in ``holidays``.

    ``holidays`` has (calendar, month_day, date): a row with a month_day ('MM-dd') is a holiday of every year, a row with a
    date one of that day, and a row with neither only names a calendar. ``rank`` is the number of trading days from
    ``start`` up to and with the day.
    """
    days = holidays.select("calendar").distinct().selectExpr(
        "calendar", f"explode(sequence(DATE'{start}', DATE'{end}')) AS date")
    yearly = holidays.where("month_day IS NOT NULL").select("calendar", F.col("month_day").alias("md")).distinct()
    single = holidays.where("date IS NOT NULL").select("calendar", "date", F.lit(True).alias("closed")).distinct()
    flagged = (days.withColumn("md", F.date_format("date", "MM-dd"))
               .join(yearly.withColumn("yearly", F.lit(True)), ["calendar", "md"], "left")
               .join(single, ["calendar", "date"], "left")
               .selectExpr("calendar", "date", "weekday(date) < 5 AND yearly IS NULL AND closed IS NULL AS trading"))
    return flagged.selectExpr("calendar", "date", "trading",
                              "sum(CAST(trading AS INT)) OVER (PARTITION BY calendar ORDER BY date) AS rank")


def nth_trading_day(rows: DataFrame, days: DataFrame, as_of: str, n: str, calendar: str = "calendar", out: str = "day",
                    first_offset_days: int = FIRST_OFFSET_DAYS) -> DataFrame:
    """``rows`` with column ``out``: the n-th trading day after ``as_of`` in the row's calendar, ``as_of`` +
    ``first_offset_days`` being the first candidate. ``as_of``, ``n`` and ``calendar`` are SQL expressions. NULL where
    any is NULL, n is below 1, or the day lies beyond the table. Rows are joined twice with the table of days, which
    adaptive execution broadcasts where it measures small."""
    ranks = days.select(F.col("calendar").alias("_c1"), F.col("date").alias("_before"), F.col("rank").alias("_rank"))
    selects = days.where("trading").select(F.col("calendar").alias("_c2"), F.col("rank").alias("_nth"), F.col("date").alias(out))
    asked = rows.selectExpr("*", f"{calendar} AS _cal", f"date_add({as_of}, {first_offset_days - 1}) AS _day",
                            f"CASE WHEN {n} >= 1 THEN CAST({n} AS BIGINT) END AS _n")
    found = asked.join(ranks, (F.col("_cal") == F.col("_c1")) & (F.col("_day") == F.col("_before")), "left")
    found = found.withColumn("_want", F.expr("_rank + _n"))
    found = found.join(selects, (F.col("_cal") == F.col("_c2")) & (F.col("_want") == F.col("_nth")), "left")
    return found.select(*[F.col(c) for c in rows.columns], out)


def next_days(rows: DataFrame, days: DataFrame, as_of: str, n: int, calendar: str = "calendar", out: str = "days",
              first_offset_days: int = FIRST_OFFSET_DAYS) -> DataFrame:
    """``rows`` with the array of the next ``n`` trading days: a slice of the calendar's one list at the rank of the day."""
    lists = days.where("trading").groupBy("calendar").agg(F.sort_array(F.collect_list("date")).alias("_all")) \
        .withColumnRenamed("calendar", "_c2")
    ranks = days.select(F.col("calendar").alias("_c1"), F.col("date").alias("_before"), F.col("rank").alias("_rank"))
    asked = rows.selectExpr("*", f"{calendar} AS _cal", f"date_add({as_of}, {first_offset_days - 1}) AS _day")
    found = asked.join(ranks, (F.col("_cal") == F.col("_c1")) & (F.col("_day") == F.col("_before")), "left")
    found = found.join(lists, F.col("_cal") == F.col("_c2"), "left")
    return found.select(*[F.col(c) for c in rows.columns],
                        F.expr(f"slice(_all, CAST(_rank AS INT) + 1, {n})").alias(out))
