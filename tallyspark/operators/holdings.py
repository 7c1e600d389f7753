"""Quarterly holdings: positions, moves between adjacent quarters, prices, splits, overlap.

Positions are rows (manager, security, q, value, shares); q counts quarters
(4 * year + quarter - 1), so adjacent quarters differ by one and a gap never
compares. Sums of money and shares are decimals until they are divided.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StructType

from tallyspark.operators import overlaps
from tallyspark.operators.state import checkpoint_folder

#: Split factors that a share count or a price is held against, whole and inverse.
SPLIT_FACTORS = (2.0, 3.0, 4.0, 5.0, 10.0, 20.0)
COMPARABLE_SHARE, PRICE_TOLERANCE, LEAST_PRICED = 0.75, 0.05, 3
#: Managers in a block of the overlap: a pair of blocks has its square in cells. Positions that a task holds.
OVERLAP_BLOCK, OVERLAP_UNIT = 2048, 1 << 20

_KEY = ["manager", "security"]


def quarter_index(day: Column) -> Column:
    return (F.year(day) * 4 + F.quarter(day) - 1).cast("int")


def quarter_name(q: Column) -> Column:
    return F.concat(F.floor(q / 4).cast("int").cast("string"), F.lit("Q"), (q % 4 + 1).cast("string"))


def positions(lines: DataFrame) -> DataFrame:
    """Sums rows (manager, security, q, value decimal, shares decimal) to one a key; blank securities go."""
    known = lines.filter(F.col("security").isNotNull() & (F.trim("security") != ""))
    summed = known.groupBy("manager", F.upper("security").alias("security"), "q").agg(F.sum("value").alias("value"), F.sum("shares").alias("shares"))
    return summed.select(*_KEY, "q", F.col("value").cast("double").alias("value"), F.col("shares").cast("double").alias("shares"))


def value_scale(lines: DataFrame, least: int = 10) -> DataFrame:
    """(manager, q, scale): 1 where the median of value by share says dollars (>= 2), 1000 for thousands (<= 0.5), else null.

    Books with fewer than ``least`` priced lines stay undecided.
    """
    ratio = F.when(F.col("shares") > 0, F.col("value").cast("double") / F.col("shares").cast("double"))
    seen = lines.withColumn("r", ratio).groupBy("manager", "q").agg(F.median("r").alias("m"), F.count("r").alias("n"))
    scale = F.when(F.col("n") < least, None).when(F.col("m") >= 2, 1).when(F.col("m") <= 0.5, 1000)
    return seen.select("manager", "q", F.col("n").alias("n_priced"), scale.cast("int").alias("scale"))


def book_metrics(pos: DataFrame) -> DataFrame:
    """Total, positions, share of the ten largest and sum of squared weights of each book."""
    book = Window.partitionBy("manager", "q")
    w = pos.withColumn("total", F.sum(F.col("value").cast("decimal(18,2)")).over(book).cast("double"))
    w = w.withColumn("rank", F.row_number().over(book.orderBy(F.desc("value"), "security")))
    weight = F.col("value") / F.col("total")
    return w.groupBy("manager", "q").agg(
        F.max("total").alias("total"),
        F.count("*").alias("positions"),
        F.round(F.sum(F.when(F.col("rank") <= 10, weight)), 4).alias("top10"),
        F.round(F.sum(weight * weight), 4).alias("hhi"),
    )


def filed(pos: DataFrame) -> DataFrame:
    return pos.select("manager", "q").distinct()


def moves(pos: DataFrame) -> DataFrame:
    """Each position with shares and value of the quarter before, its action, and whether it's gone from the next book.

    Only an adjacent quarter compares: without one the action is held and
    ``comparable`` false; no next book proves no exit. One window over a
    position's quarters gives both neighbours, one aggregate the quarters filed.
    """
    own = Window.partitionBy(*_KEY).orderBy("q")
    w = pos.withColumns({"__pq": F.lag("q").over(own), "__ps": F.lag("shares").over(own), "__pv": F.lag("value").over(own), "__nq": F.lead("q").over(own)})
    j = w.join(pos.groupBy("manager").agg(F.collect_set("q").alias("__filed")), "manager")
    adjacent, had = F.col("__pq") == F.col("q") - 1, F.array_contains("__filed", F.col("q") - 1)
    prior = F.when(adjacent, F.col("__ps"))
    action = F.when(~had, "held").when(prior.isNull(), "new").when(F.col("shares") > prior, "added").when(F.col("shares") < prior, "trimmed").otherwise("held")
    gone = F.array_contains("__filed", F.col("q") + 1) & ~F.coalesce(F.col("__nq") == F.col("q") + 1, F.lit(False))
    return j.select(*pos.columns, prior.alias("prior_shares"), F.when(adjacent, F.col("__pv")).alias("prior_value"), action.alias("action"), had.alias("comparable"), gone.alias("gone_next"))


def actions(pos: DataFrame) -> DataFrame:
    """``moves`` without what comes after: each position with the quarter before and its action."""
    return moves(pos).drop("gone_next")


def exits(pos: DataFrame) -> DataFrame:
    """Positions of a quarter that are gone from the manager's next book; no next book proves no exit."""
    gone = moves(pos).filter("gone_next")
    return gone.select(*_KEY, (F.col("q") + 1).alias("q"), F.col("value").alias("prior_value"), F.col("shares").alias("prior_shares"))


def action_counts(pos: DataFrame) -> DataFrame:
    """New, added, trimmed, held and exited of each comparable book."""
    counts = [F.count_if(F.col("action") == a).alias(f"n_{a}") for a in ("new", "added", "trimmed", "held")]
    g = moves(pos).groupBy("manager", "q").agg(*counts, F.count_if("gone_next").alias("__gone"), F.bool_or("comparable").alias("__c"))
    before = F.lag("__gone").over(Window.partitionBy("manager").orderBy("q"))
    return g.withColumn("n_exited", before).filter("__c").drop("__gone", "__c")


def turnover(pos: DataFrame) -> DataFrame:
    """min(bought, sold) over the mean of the book's totals now and a quarter before."""
    price, change = F.col("value") / F.col("shares"), F.col("shares") - F.col("prior_shares")
    g = moves(pos).groupBy("manager", "q").agg(
        F.sum(F.when(F.col("comparable") & (F.col("action") == "new"), F.col("value")).when(F.col("action") == "added", change * price)).alias("bought"),
        F.sum(F.when(F.col("action") == "trimmed", -change * price)).alias("sold"),
        F.sum("value").alias("total"),
        F.sum(F.when(F.col("gone_next"), F.col("value"))).alias("closes"),
        F.bool_or("comparable").alias("comparable"),
    )
    own = Window.partitionBy("manager").orderBy("q")
    j = g.withColumns({"prior_total": F.lag("total").over(own), "closed": F.lag("closes").over(own)}).filter("comparable")
    zero = F.lit(0.0)
    least = F.least(F.coalesce("bought", zero), F.coalesce("sold", zero) + F.coalesce("closed", zero))
    return j.select("manager", "q", F.round(least / ((F.col("total") + F.col("prior_total")) / 2), 4).alias("turnover"))


def implied_prices(pos: DataFrame) -> DataFrame:
    return pos.filter("shares > 0").withColumn("price", F.col("value") / F.col("shares"))


def consensus_price(pos: DataFrame, least: int = LEAST_PRICED) -> DataFrame:
    """Median implied price of each security and quarter with at least ``least`` priced lines."""
    seen = implied_prices(pos).groupBy("security", "q").agg(F.median("price").alias("price"), F.count("*").alias("n"))
    return seen.filter(F.col("n") >= least)


def price_flags(pos: DataFrame, tolerance: float = PRICE_TOLERANCE, least: int = LEAST_PRICED) -> DataFrame:
    """Each priced line with the median of the other lines and whether it's further off than ``tolerance``.

    The sorted prices of a group are gathered once; a line's own place, by its
    rank, is skipped. Groups are bounded by the number of managers.
    """
    p = implied_prices(pos)
    place = Window.partitionBy("security", "q").orderBy("price", "manager")
    p = p.withColumn("at", F.row_number().over(place))
    sorted_prices = p.groupBy("security", "q").agg(F.array_sort(F.collect_list("price")).alias("all"))
    j = p.join(sorted_prices, ["security", "q"]).withColumn("others", F.size("all") - 1).filter(F.col("others") >= least - 1)

    def other(k: Column) -> Column:
        """The k-th of the others, from 1."""
        return F.element_at("all", F.when(k < F.col("at"), k).otherwise(k + 1).cast("int"))

    half = F.floor(F.col("others") / 2).cast("int")
    median = F.when(F.col("others") % 2 == 1, other(half + 1)).otherwise((other(half) + other(half + 1)) / 2)
    j = j.withColumn("others_median", median)
    return j.select(*_KEY, "q", "price", "others_median", (F.abs(F.col("price") / F.col("others_median") - 1) > tolerance).alias("flagged"))


def stale_valuation(pos: DataFrame, least: int = 20) -> DataFrame:
    """(manager, q, judged, stale): books priced as the quarter before.

    Judged are lines whose consensus moved over 5%; stale needs 20 of them, 80%
    within 2% of the old consensus and under half within 5% of the new one.
    """
    now = consensus_price(pos).select("security", "q", F.col("price").alias("now"))
    old = consensus_price(pos).select("security", (F.col("q") + 1).alias("q"), F.col("price").alias("old"))
    j = implied_prices(pos).join(now, ["security", "q"]).join(old, ["security", "q"])
    j = j.filter(F.abs(F.col("now") / F.col("old") - 1) > 0.05)
    seen = j.groupBy("manager", "q").agg(
        F.count("*").alias("judged"),
        F.count_if(F.abs(F.col("price") / F.col("old") - 1) <= 0.02).alias("n_old"),
        F.count_if(F.abs(F.col("price") / F.col("now") - 1) <= 0.05).alias("n_now"),
    )
    stale = (F.col("judged") >= least) & (F.col("n_old") >= 0.8 * F.col("judged")) & (F.col("n_now") < 0.5 * F.col("judged"))
    return seen.withColumn("stale", stale)


def _factors(factors: tuple[float, ...]) -> Column:
    return F.array(*[F.lit(x) for f in factors for x in (f, 1.0 / f)])


def split_by_holders(pos: DataFrame, tolerance: float = 0.03, factors: tuple[float, ...] = SPLIT_FACTORS) -> DataFrame:
    """The factor that most continuing holders' share counts moved by; a split with two or more of them and 70%."""
    held = actions(pos).filter(F.col("prior_shares") > 0).withColumn("ratio", F.col("shares") / F.col("prior_shares"))
    pairs = held.select("security", "q", "ratio").withColumn("factor", F.explode(_factors(factors)))
    near = F.abs(F.col("ratio") - F.col("factor")) <= tolerance * F.col("factor")
    counts = pairs.groupBy("security", "q", "factor").agg(F.count_if(near).alias("near"), F.count("*").alias("holders"))
    best = counts.groupBy("security", "q").agg(F.max_by("factor", F.struct("near", F.col("factor"))).alias("factor"), F.max("near").alias("near"), F.max("holders").alias("holders"))
    return best.withColumn("is_split", (F.col("near") >= 2) & (F.col("near") >= 0.7 * F.col("holders")))


def split_by_price(pos: DataFrame, least: int = 5, factors: tuple[float, ...] = SPLIT_FACTORS) -> DataFrame:
    """The factor nearest, by logarithm, to the median share ratio, with the inverse ratio of median prices."""
    held = actions(pos).filter((F.col("prior_shares") > 0) & (F.col("shares") > 0))
    seen = held.groupBy("security", "q").agg(
        F.count("*").alias("n"),
        F.median(F.col("shares") / F.col("prior_shares")).alias("ratio"),
        (F.median(F.col("prior_value") / F.col("prior_shares")) / F.median(F.col("value") / F.col("shares"))).alias("price_ratio"),
    )
    seen = seen.filter(F.col("n") >= least).withColumn("factor", F.explode(_factors(factors)))
    gap = F.abs(F.log(F.col("ratio") / F.col("factor")))
    best = seen.withColumn("gap", gap).groupBy("security", "q", "n", "ratio", "price_ratio").agg(F.min_by("factor", F.struct("gap", "factor")).alias("factor"), F.min("gap").alias("gap"))
    band = F.abs(F.log(F.col("price_ratio") / F.col("factor"))) <= F.log(F.lit(1.2))
    return best.select("security", "q", "n", "factor", ((F.col("gap") <= F.log(F.lit(1.15))) & band).alias("is_split"))


def net_shares(pos: DataFrame) -> DataFrame:
    """Breadth and net shares of each security: one unknown side makes the net unknown.

    A line counts where its manager's books are comparable; a line of another
    manager is an unknown side.
    """
    a = actions(pos).select("security", "q", "comparable", "action", (F.col("shares") - F.coalesce("prior_shares", F.lit(0.0))).alias("change"), F.coalesce("prior_shares", F.lit(0.0)).alias("prior"))
    gone = exits(pos).select("security", "q", F.lit(True).alias("comparable"), F.lit("exited").alias("action"), (-F.col("prior_shares")).alias("change"), F.col("prior_shares").alias("prior"))
    g = a.unionByName(gone).groupBy("security", "q").agg(
        F.count_if(F.col("comparable") & F.col("action").isin("new", "added")).alias("buyers"),
        F.count_if(F.col("comparable") & F.col("action").isin("trimmed", "exited")).alias("sellers"),
        F.when(F.bool_or(~F.col("comparable")), None).otherwise(F.sum("change")).alias("net_shares"),
        F.sum(F.when(F.col("comparable"), F.col("change"))).alias("known_change"),
        F.sum(F.when(F.col("comparable"), F.col("prior"))).alias("known_prior"),
    )
    conviction = F.when(F.col("known_prior") > 0, F.round(F.col("known_change") / F.col("known_prior"), 4))
    return g.select("security", "q", "buyers", "sellers", (F.col("buyers") - F.col("sellers")).alias("breadth"), "net_shares", conviction.alias("conviction"))


def coverage(pos: DataFrame, on_file: int | None = None) -> DataFrame:
    """Managers that filed each quarter, those comparable, those ever on file, and the default quarter.

    The default is the newest quarter with at least 75% of the managers on file.
    """
    f = filed(pos)
    had = f.select("manager", (F.col("q") + 1).alias("q"), F.lit(1).alias("had"))
    counts = f.join(had, ["manager", "q"], "left").groupBy("q").agg(F.count("*").alias("filed"), F.count("had").alias("comparable"))
    total = f.agg(F.countDistinct("manager").alias("on_file")) if on_file is None else f.sparkSession.range(1).select(F.lit(on_file).alias("on_file"))
    counts = counts.crossJoin(F.broadcast(total))  # one row
    default = counts.filter(F.col("filed") >= COMPARABLE_SHARE * F.col("on_file")).agg(F.max("q").alias("d"))
    return counts.crossJoin(F.broadcast(default)).select("q", "filed", "comparable", "on_file", (F.col("q") == F.col("d")).alias("is_default"))


def overlap(pos: DataFrame, peers: int = 25, block: int = OVERLAP_BLOCK, unit: int = OVERLAP_UNIT) -> DataFrame:
    """Each manager's ``peers`` most alike books of the same quarter: the sum of the lesser weights over shared securities.

    Books are packed into blobs, which are written once. A quarter's blobs are
    dealt into units of about ``unit`` positions: one task holds a unit, compares
    its books with each other and with the quarter's other blobs as they are streamed past, and keeps
    ``peers`` a book. Pairs are never rows, so what is shuffled is the blobs, times the units
    of their quarter. Null managers, securities and quarters take no part.
    """
    spark = pos.sparkSession
    book = Window.partitionBy("manager", "q")
    w = pos.select("q", "manager", "security", (F.col("value") / F.sum(F.col("value").cast("decimal(18,2)")).over(book).cast("double")).alias("w"))
    w = w.filter(F.col("q").isNotNull() & F.col("manager").isNotNull() & F.col("security").isNotNull() & F.col("w").isNotNull()).sortWithinPartitions("manager", "q")
    kind, named = (pos.schema[c].dataType.simpleString() for c in ("manager", "security"))
    fields = StructType.fromDDL(f"q int, id bigint, n int, managers array<{kind}>, securities array<{named}>, counts binary, codes binary, weights binary")
    kinds = {f.name: to_arrow_type(f.dataType.elementType if isinstance(f.dataType, ArrayType) else f.dataType) for f in fields}
    path = f"{checkpoint_folder(spark).rstrip('/')}/overlap-{uuid.uuid4().hex}"
    w.mapInArrow(overlaps.pack(" ".join(fields.names), kinds), fields).write.parquet(path)
    blobs = spark.read.schema(fields).parquet(path)
    parts = blobs.groupBy("q").agg(F.ceil(F.sum("n") / unit).cast("int").alias("parts"))
    units, most = parts.agg(F.sum("parts"), F.max("parts")).first()
    dealt = blobs.join(F.broadcast(parts), "q").withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))  # one row a quarter
    rest = [f for f in fields.names if f != "q"]
    rows = dealt.select("q", F.col("own").alias("s"), F.lit(0).alias("side"), *rest)
    if (most or 0) > 1:
        others = dealt.withColumn("s", F.explode(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda s: s != F.col("own"))))
        bare = [F.col(f) if f in ("id", "n", "managers") else F.lit(None).cast(fields[f].dataType).alias(f) for f in rest]
        rows = rows.unionByName(others.select("q", "s", F.lit(1).alias("side"), *bare)).unionByName(others.select("q", "s", F.lit(2).alias("side"), *rest))
    rows = rows.repartition(4 * (units or 1), "q", "s").sortWithinPartitions("q", "s", "side", "id")
    found = f"manager {kind}, q int, peer {kind}, overlap double, shared bigint, rank int"
    return rows.mapInArrow(overlaps.meet(peers, block), found)


def first_last_seen(pos: DataFrame) -> DataFrame:
    """First and last quarter, distinct holders and the largest holder of the last quarter, of each security."""
    return pos.groupBy("security").agg(
        F.min("q").alias("first_q"),
        F.max("q").alias("last_q"),
        F.countDistinct("manager").alias("holders"),
        F.max_by("manager", F.struct("q", "value", "manager")).alias("last_holder"),
    )


def holders_spark(pos: DataFrame, length: int = 8) -> DataFrame:
    """Holders of each security in the last ``length`` quarters of all, zero where there are none."""
    last = pos.agg(F.max("q").alias("last"))
    grid = pos.select("security").distinct().crossJoin(F.broadcast(last)).select("security", F.explode(F.sequence(F.col("last") - (length - 1), F.col("last"))).alias("q"))
    counts = pos.groupBy("security", "q").agg(F.countDistinct("manager").alias("n"))
    full = grid.join(counts, ["security", "q"], "left")
    packed = full.groupBy("security").agg(F.array_sort(F.collect_list(F.struct("q", F.coalesce("n", F.lit(0)).alias("n")))).alias("s"))
    return packed.select("security", F.array_join(F.transform("s", lambda x: x["n"].cast("string")), ",").alias("spark"))


def listing_status(pos: DataFrame) -> DataFrame:
    """(security, q, status): new-listing in its first quarter, recent-listing one later unless widely held before, ended after its last."""
    counts = pos.groupBy("security", "q").agg(F.countDistinct("manager").alias("holders"))
    own = Window.partitionBy("security")
    c = counts.withColumns({"first": F.min("q").over(own), "last": F.max("q").over(own), "prior": F.lag("holders").over(own.orderBy("q"))})
    newest = pos.agg(F.max("q").alias("newest"))
    c = c.crossJoin(F.broadcast(newest))
    recent = (F.col("q") == F.col("first") + 1) & (F.col("prior") <= F.greatest(F.lit(3), F.floor(F.col("holders") / 4)))
    status = F.when(F.col("q") == F.col("first"), "new-listing").when(recent, "recent-listing").when((F.col("q") == F.col("last")) & (F.col("last") < F.col("newest")), "ended").otherwise("listed")
    return c.select("security", "q", "holders", status.alias("status"))


def category_weights(pos: DataFrame, categories: DataFrame, top: int = 3) -> DataFrame:
    """Share of a book's value by category (rows security, category; a security may have several), the ``top`` of each book."""
    total = pos.groupBy("manager", "q").agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))
    by = pos.join(categories, "security").groupBy("manager", "q", "category").agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("v"))
    w = by.join(total, ["manager", "q"]).select("manager", "q", "category", F.round(F.col("v") / F.col("total"), 4).alias("weight")).filter("weight > 0")
    rank = F.row_number().over(Window.partitionBy("manager", "q").orderBy(F.desc("weight"), "category"))
    return w.withColumn("rank", rank).filter(F.col("rank") <= top)
