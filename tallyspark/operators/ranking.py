"""Ranks, caps, picks and interleaving, all with stated tie-breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(rows: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= n)


def global_cap(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    return rows.orderBy(*order).limit(n)


def round_robin(rows: DataFrame, group: str, order: list[Column], cap: int) -> DataFrame:
    """One row of each group in turn, groups by name, until ``cap``; at most ``cap`` rows of a group are looked at."""
    picked = top_n(rows, [group], order, cap).withColumnRenamed("rank", "round")
    return picked.orderBy("round", group).limit(cap)


def card_and_detail(pages: DataFrame, key: str, page: str, score: Column, kind: Column) -> DataFrame:
    """(key, card, detail): the page of the best score, ties to the lesser page, and of the others the first by (kind, score, page); null if there is none.

    The two best by the second order hold the detail page whichever the card is, so one aggregate does.
    """
    in_turn = F.row_number().over(Window.partitionBy(key).orderBy(kind, score.desc(), F.col(page)))
    p = pages.select(key, page, score.alias("__s"), in_turn.alias("__n"))
    g = p.groupBy(key).agg(F.max_by(page, F.struct("__s", -F.col(page))).alias("card"), F.max(F.when(F.col("__n") == 1, F.col(page))).alias("__1"), F.max(F.when(F.col("__n") == 2, F.col(page))).alias("__2"))
    return g.select(key, "card", F.when(F.col("__1") != F.col("card"), F.col("__1")).otherwise(F.col("__2")).alias("detail"))


def pick_three(rows: DataFrame, key: str, day: str, value: str, area: str) -> DataFrame:
    """The newest; the largest of the rest; the newest of another area than both; then the newest left: three rows with ``pick``."""
    newest = [F.desc(day), F.asc(key)]
    one = rows.orderBy(*newest).limit(1).withColumn("pick", F.lit(1))
    rest = rows.join(F.broadcast(one.select(key)), key, "left_anti")
    two = rest.orderBy(F.desc_nulls_last(value), *newest).limit(1).withColumn("pick", F.lit(2))
    used = one.unionByName(two)
    rest = rows.join(F.broadcast(used.select(key)), key, "left_anti")
    other = rest.join(F.broadcast(used.select(area).withColumn("__seen", F.lit(1)).distinct()), area, "left")
    three = other.orderBy(F.col("__seen").isNotNull(), *newest).limit(1).drop("__seen").withColumn("pick", F.lit(3))
    return used.unionByName(three.select(*used.columns))


def stratified_cap(rows: DataFrame, stratum: str, order: list[Column], cap: int) -> DataFrame:
    """At most ``cap`` rows, taken evenly over the strata."""
    return round_robin(rows, stratum, order, cap)


def best_by_score(rows: DataFrame, group: list[str], score: Column, order: list[Column]) -> DataFrame:
    return top_n(rows.withColumn("score", score), group, [F.desc("score"), *order], 1).drop("rank")
