"""Daily series on a calendar: grades, moves, adjustment, ranges, volatility, drawdown.

Observations are rows (symbol, i, price, trades, dollars); i counts calendar
slots from zero, and a slot without a row is a gap.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.arrays import quotient
from tallyspark.operators import joins

#: Share ratios of stock splits, held against a price move in either direction.
SPLIT_SHAPES = (2.0, 3.0, 4.0, 5.0, 6.0, 8.0, 10.0, 12.0, 15.0, 20.0, 25.0, 30.0, 40.0, 50.0, 1.5, 2.5)
BIG_MOVE, SHAPE_TOLERANCE, LOOK_BACK, VOLUME_SESSIONS = 1.4, 0.03, 5, 21
COVERAGE = 0.8


def daily(trades: DataFrame) -> DataFrame:
    """Rows (symbol, i, at, seq, price, size) to one a symbol and slot: the last price by (at, seq), trades and dollars."""
    money = (F.col("price") * F.col("size")).cast("decimal(18,4)")
    return trades.groupBy("symbol", "i").agg(
        F.max_by("price", F.struct("at", "seq")).alias("price"), F.count("*").alias("trades"), F.sum(money).cast("double").alias("dollars")
    )


def last_unbroken(trades: DataFrame, breaks: DataFrame) -> DataFrame:
    """The last trade of each symbol and slot after those that a break undid are gone."""
    return daily(trades.join(breaks.select("symbol", "seq"), ["symbol", "seq"], "left_anti"))


def grade(trades: Column, dollars: Column, late: Column, seconds: Column) -> Column:
    """H for a well-traded close, U for a usable one, else null."""
    return (
        F.when((trades >= 100) & (dollars >= 1_000_000) & (late >= 10) & (seconds <= 300), "H")
        .when((trades >= 20) & (dollars >= 100_000) & (late >= 3) & (seconds <= 1800), "U")
        .otherwise(F.lit(None).cast("string"))
    )


def _own() -> Window:
    return Window.partitionBy("symbol").orderBy("i")


def overnight_moves(obs: DataFrame, big: float = BIG_MOVE) -> DataFrame:
    """Moves of more than ``big`` in log terms against the last observation at most five slots back.

    ``ordinary_volume``: dollars at most three times the median of the up to 21
    observed slots within the 21 slots before.
    """
    w = obs.withColumn("prev", F.lag("price").over(_own())).withColumn("gap", F.col("i") - F.lag("i").over(_own()))
    before = Window.partitionBy("symbol").orderBy("i").rangeBetween(-VOLUME_SESSIONS, -1)
    w = w.withColumn("usual", F.percentile("dollars", 0.5).over(before))
    change = F.col("price") / F.col("prev")
    moved = w.filter((F.col("gap") <= LOOK_BACK) & (F.col("prev") > 0) & (F.col("price") > 0) & (F.abs(F.log(change)) > math.log(big)))
    return moved.select("symbol", "i", "prev", "price", change.alias("change"), (F.col("dollars") <= 3 * F.col("usual")).alias("ordinary_volume"))


def split_shape(change: Column, tolerance: float = SHAPE_TOLERANCE) -> Column:
    """The first split ratio that explains a price change within the tolerance: shares for one of before; null if none."""
    tried = []
    for f in SPLIT_SHAPES:
        tried.append(F.when(F.abs(change * f - 1) <= tolerance, F.lit(f)))
        tried.append(F.when(F.abs(change / f - 1) <= tolerance, F.lit(1.0 / f)))
    return F.coalesce(*tried)


def back_adjusted(obs: DataFrame, ratios: DataFrame) -> DataFrame:
    """Prices divided by every later ratio (symbol, i, ratio): a reverse cumulative product over the symbol."""
    j = obs.join(ratios, ["symbol", "i"], "left")
    later = Window.partitionBy("symbol").orderBy("i").rowsBetween(1, Window.unboundedFollowing)
    factor = F.coalesce(F.product(F.coalesce("ratio", F.lit(1.0))).over(later), F.lit(1.0))
    return j.select("symbol", "i", "price", (F.col("price") / factor).alias("adjusted"))


def high_low(obs: DataFrame, last: int, slots: int = 252, coverage: float = COVERAGE) -> DataFrame:
    """High and low with their slots over the last ``slots``; the first slot of equals; null under ``coverage``."""
    seen = obs.filter((F.col("i") > last - slots) & (F.col("i") <= last))
    g = seen.groupBy("symbol").agg(
        F.count("*").alias("n"),
        F.max("price").alias("high"),
        F.max_by("i", F.struct(F.col("price"), -F.col("i"))).alias("high_at"),
        F.min("price").alias("low"),
        F.min_by("i", F.struct("price", "i")).alias("low_at"),
    )
    enough = F.col("n") >= F.ceil(F.lit(coverage * slots))
    return g.select("symbol", "n", *[F.when(enough, F.col(c)).alias(c) for c in ("high", "high_at", "low", "low_at")])


def base_prices(obs: DataFrame, last: int, backs: tuple[int, ...], slack: int = 3, coverage: float = COVERAGE) -> DataFrame:
    """The change of each symbol since ``last - back``: the nearest price within ``slack`` slots, if enough slots between are observed."""
    newest = obs.groupBy("symbol").agg(F.max_by("price", "i").alias("now"), F.max("i").alias("newest"))
    targets = newest.select("symbol", F.explode(F.array(*[F.lit(b) for b in backs])).alias("back")).withColumn("target", F.lit(last) - F.col("back"))
    based = joins.nearest(targets, obs.select("symbol", "i", F.col("price").alias("value")), "symbol", slack)
    counts = targets.join(obs.select("symbol", "i"), "symbol").filter(F.col("i") >= F.col("target")).groupBy("symbol", "target").agg(F.count("*").alias("points"))
    j = based.join(counts, ["symbol", "target"], "left").join(newest, "symbol")
    enough = F.coalesce("points", F.lit(0)) >= F.ceil((F.col("back") + 1) * coverage)
    return j.select("symbol", "back", F.when(enough, F.col("value")).alias("base"), F.when(enough, F.round(quotient(F.col("now"), F.col("value")) - 1, 6)).alias("change"))


def realised_volatility(obs: DataFrame, least: int = 2, year: int = 252) -> DataFrame:
    """Sample deviation of log returns between adjacent slots, by year; null under ``least`` returns."""
    w = obs.filter("price > 0").withColumn("prev", F.lag("price").over(_own())).withColumn("gap", F.col("i") - F.lag("i").over(_own()))
    r = F.when(F.col("gap") == 1, F.log(F.col("price") / F.col("prev")))
    g = w.withColumn("r", r).groupBy("symbol").agg(F.count("r").alias("returns"), F.stddev_samp("r").alias("sd"))
    return g.select("symbol", "returns", F.when(F.col("returns") >= least, F.round(F.col("sd") * math.sqrt(year), 6)).alias("volatility"))


def max_drawdown(obs: DataFrame) -> DataFrame:
    """The largest fall from a running high and the first slot that reaches it."""
    w = obs.withColumn("peak", F.max("price").over(_own().rowsBetween(Window.unboundedPreceding, 0)))
    w = w.withColumn("fall", 1 - quotient(F.col("price"), F.col("peak")))
    return w.groupBy("symbol").agg(F.round(F.max("fall"), 6).alias("drawdown"), F.max_by("i", F.struct(F.col("fall"), -F.col("i"))).alias("at"))


def staleness(obs: DataFrame, last: int, most: int = 2) -> DataFrame:
    g = obs.groupBy("symbol").agg((F.lit(last) - F.max("i")).alias("lag"))
    return g.withColumn("stale", F.col("lag") > most)


def event_boundary(actions: DataFrame) -> DataFrame:
    """The last slot of each symbol with an action that history can't be carried over."""
    cut = F.col("kind").isin("other", "unresolved")
    return actions.groupBy("symbol").agg(F.max(F.when(cut, F.col("i"))).alias("boundary"))


def two_deep(trades: DataFrame, breaks: DataFrame) -> DataFrame:
    """(symbol, i, price): the last trade of a slot, or the one before if a break undid it; null if both are undone, as no third is kept.

    Breaks (symbol, seq) come after the slot's trades; trades broken earlier are for ``last_unbroken``.
    """
    undone = breaks.select("symbol", "seq").distinct().withColumn("undone", F.lit(True))
    last = Window.partitionBy("symbol", "i").orderBy(F.desc("at"), F.desc("seq"))
    two = trades.withColumn("k", F.row_number().over(last)).filter("k <= 2").join(undone, ["symbol", "seq"], "left")
    return two.groupBy("symbol", "i").agg(F.min(F.when(F.col("undone").isNull(), F.struct("k", "price")))["price"].alias("price"))


def replayed(messages: DataFrame) -> DataFrame:
    """(symbol, i, price): the last trade of each slot after its trades and breaks in order, two trades deep.

    ``messages`` is (symbol, i, seq, kind, price, ref): a "trade", or a "break" of the trade whose seq is ref. A break of
    the last trade leaves the one before, with none behind it; one of the trade before leaves the last one alone; one of
    an earlier or unknown trade changes nothing. The price is null where a third trade would be needed. Two
    trades in a row fix the state whatever came before, so only what
    follows a slot's last such pair is replayed: about as many messages as it has breaks. Breaks before any trade,
    and rows of another kind, count for nothing.
    """
    m = messages.filter(F.col("kind").isin("trade", "break"))
    own = Window.partitionBy("symbol", "i").orderBy("seq")
    trade = F.col("kind") == "trade"
    m = m.withColumns({"__pair": trade & (F.lag("kind").over(own) == "trade"), "__before": F.lag("seq").over(own)})
    start = F.max(F.when(F.col("__pair"), F.struct("seq", "__before"))).over(Window.partitionBy("symbol", "i"))
    tail = m.withColumn("__from", start["__before"]).filter(F.col("__from").isNull() | (F.col("seq") >= F.col("__from")))
    kept = tail.groupBy("symbol", "i").agg(F.array_sort(F.collect_list(F.struct("seq", "kind", F.col("price").cast("double").alias("price"), F.col("ref").cast("long").alias("ref")))).alias("m"), F.bool_or(trade).alias("traded"))
    slot = lambda seq, price: F.struct(seq.cast("long").alias("seq"), price.cast("double").alias("price"))
    none = slot(F.lit(None), F.lit(None))

    def step(s: Column, x: Column) -> Column:
        pair = lambda last, before: F.struct(last.alias("last"), before.alias("before"))
        undone = F.when(x["ref"] == s["last"]["seq"], pair(s["before"], none)).when(x["ref"] == s["before"]["seq"], pair(s["last"], none)).otherwise(s)
        return F.when(x["kind"] == "trade", pair(slot(x["seq"], x["price"]), s["last"])).otherwise(undone)

    last = F.aggregate("m", F.struct(none.alias("last"), none.alias("before")), step)["last"]["price"]
    return kept.filter("traded").select("symbol", "i", last.alias("price"))


def late_trades(trades: DataFrame, close: Column, minutes: int = 30) -> DataFrame:
    """(symbol, i, late, late_minutes): trades in the last ``minutes`` before a slot's close, and how many of those minutes have one."""
    late = (F.col("at") < close) & (F.col("at") >= close - F.expr(f"interval {minutes} minutes"))
    return trades.groupBy("symbol", "i").agg(F.count_if(late).alias("late"), F.count_distinct(F.when(late, F.date_trunc("minute", "at"))).alias("late_minutes"))
