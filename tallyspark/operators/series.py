"""Dated series (id, d, v): last of a period, change over a year, spread, growth, merge of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators import joins


def last_of_period(series: DataFrame, period: str) -> DataFrame:
    """The last point of each id in each period: 'month', or 'week' from Monday."""
    start = F.trunc("d", "MM") if period == "month" else F.date_trunc("week", F.col("d")).cast("date")
    g = series.withColumn("period", start).groupBy("id", "period")
    return g.agg(F.max("d").alias("d"), F.max_by("v", "d").alias("v"))


def year_over_year(series: DataFrame) -> DataFrame:
    """Percent change against the same month of the year before; months without that one have none."""
    m = last_of_period(series, "month").select("id", "period", "v")
    before = m.select("id", F.add_months("period", 12).alias("period"), F.col("v").alias("base"))
    return m.join(before, ["id", "period"]).filter("base != 0").select("id", "period", F.round((F.col("v") - F.col("base")) / F.col("base") * 100, 2).alias("yoy"))


def spread(series: DataFrame, long: str, short: str) -> DataFrame:
    """round((long - short) * 100) on days that have both."""
    a = series.filter(F.col("id") == long).select("d", F.col("v").alias("a"))
    b = series.filter(F.col("id") == short).select("d", F.col("v").alias("b"))
    return a.join(b, "d").filter("a is not null and b is not null").select("d", F.round((F.col("a") - F.col("b")) * 100).cast("long").alias("spread"))


def growth(series: DataFrame) -> DataFrame:
    """v / previous v - 1 along the id's points; null for the first."""
    w = Window.partitionBy("id").orderBy("d")
    return series.select("id", "d", "v", F.round(F.try_divide(F.col("v"), F.lag("v").over(w)) - 1, 6).alias("growth"))


def merge_fresh(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """Fresh points win by date; a series that failed, or a date that is missing now, keeps its old ones."""
    return joins.prefer([fresh, old], ["id", "d"])


def trailing(rows: DataFrame, day: str, days: int) -> DataFrame:
    """Rows at most ``days`` older than the newest row: anchored on the data, not on the clock."""
    newest = rows.agg(F.max(day).alias("__newest"))
    return rows.crossJoin(F.broadcast(newest)).filter(F.datediff("__newest", day) <= days).drop("__newest")  # one row
