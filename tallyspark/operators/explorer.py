"""The explorer's tables: symbols by quarter, stocks, holders and managers, from one read of the books.

Lines are (manager, symbol, q, value, shares): a manager's positions summed by
symbol, rights apart. ``moves`` gives each one its quarter before and adds the
positions that are gone; all tables are aggregates of that one, published together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions.arrays import quotient
from tallyspark.operators.books import is_right
from tallyspark.operators.holdings import COMPARABLE_SHARE

SPARK_QUARTERS = 8
#: A security ended when at most this share of those that left still hold it: at least so many left, and shares fell so far.
LEFT, STRAY, FALL = 5, 10, -0.85


def symbol_lines(pos: DataFrame, symbols: DataFrame) -> DataFrame:
    """(manager, symbol, q, value, shares) of positions (manager, security, class, q, value, shares) without a right."""
    held = pos.filter(~is_right(F.col("class"))).join(symbols, "security")
    return held.groupBy("manager", "symbol", "q").agg(F.sum("value").alias("value"), F.sum("shares").alias("shares"))


def filings(pos: DataFrame, whole: DataFrame) -> DataFrame:
    """(manager, filed, whole): the quarters of a manager's books, and those (manager, q) that were read whole, as arrays."""
    filed = pos.groupBy("manager").agg(F.array_sort(F.collect_set("q")).alias("filed"))
    known = whole.groupBy("manager").agg(F.collect_set("q").alias("whole"))
    return filed.join(known, "manager", "left").withColumn("whole", F.coalesce("whole", F.array().cast("array<int>")))


def moves(lines: DataFrame, filed: DataFrame) -> DataFrame:
    """Lines with prior_shares and prior_value, comparable, proven and action; a line gone from the next book is one there.

    A line is comparable if its manager filed the quarter before. Without one
    there it is "new" if that book was read whole, else "unknown"; gone, it has "exited" if the
    new book was read whole, else it is "unknown" too. Gone lines have no value and no shares.
    """
    own = Window.partitionBy("manager", "symbol").orderBy("q")
    w = lines.withColumns({"__pq": F.lag("q").over(own), "__ps": F.lag("shares").over(own), "__pv": F.lag("value").over(own), "__nq": F.lead("q").over(own)}).join(filed, "manager")
    q = F.col("q")
    has = lambda sets, at: F.array_contains(sets, at)
    before = F.col("__pq") == q - 1
    prior = F.when(before, F.col("__ps"))
    action = (
        F.when(~has("filed", q - 1), "held").when(prior.isNull(), F.when(has("whole", q - 1), "new").otherwise("unknown"))
        .when(F.col("shares") > prior, "added").when(F.col("shares") < prior, "trimmed").otherwise("held")
    )
    here = F.struct(
        q.alias("q"), F.col("value").alias("value"), F.col("shares").alias("shares"), prior.alias("prior_shares"), F.when(before, F.col("__pv")).alias("prior_value"),
        has("filed", q - 1).alias("comparable"), action.alias("action"), F.lit(True).alias("holds"),
    )
    gone = has("filed", q + 1) & ~F.coalesce(F.col("__nq") == q + 1, F.lit(False))
    there = F.struct(
        (q + 1).cast("int").alias("q"), F.lit(0.0).alias("value"), F.lit(0.0).alias("shares"), F.col("shares").alias("prior_shares"), F.col("value").alias("prior_value"),
        F.lit(True).alias("comparable"), F.when(has("whole", q + 1), "exited").otherwise("unknown").alias("action"), F.lit(False).alias("holds"),
    )
    return w.select("manager", "symbol", F.explode(F.array_compact(F.array(here, F.when(gone, there)))).alias("m")).select("manager", "symbol", "m.*")


def coverage(filed: DataFrame) -> DataFrame:
    """(q, filed, comparable, complete, is_default): complete if every comparable manager's two books were read whole.

    The default is the newest quarter that at least 75 % of the managers filed. One row a quarter.
    """
    each = filed.select("manager", "filed", "whole", F.explode("filed").alias("q"))
    had, q = F.array_contains("filed", F.col("q") - 1), F.col("q")
    both = F.array_contains("whole", q) & F.array_contains("whole", q - 1)
    g = each.groupBy("q").agg(F.count("*").alias("filed"), F.count_if(had).alias("comparable"), F.coalesce(F.bool_and(F.when(had, both)), F.lit(False)).alias("complete"))
    total = filed.agg(F.count("*").alias("managers"))
    g = g.crossJoin(F.broadcast(total))  # one row
    default = g.agg(F.max(F.when(F.col("filed") >= COMPARABLE_SHARE * F.col("managers"), q)).alias("d"))
    return g.crossJoin(F.broadcast(default)).select("q", "filed", "comparable", "complete", F.coalesce(q == F.col("d"), F.lit(False)).alias("is_default"))


def first_quarters(pos: DataFrame, symbols: DataFrame) -> DataFrame:
    """(symbol, first_security, first_symbol): the first quarter with any of its securities in a book, rights too, and the first without a right."""
    return pos.join(symbols, "security").groupBy("symbol").agg(F.min("q").alias("first_security"), F.min(F.when(~is_right(F.col("class")), F.col("q"))).alias("first_symbol"))


def quarters(moved: DataFrame, cover: DataFrame, first: DataFrame, split: DataFrame, flagged: DataFrame, reissued: DataFrame) -> DataFrame:
    """A row for each symbol and quarter, over comparable managers.

    holders, value, shares, new, added, trimmed, held, exited, buyers, sellers, breadth, flagged,
    net_shares, conviction, coverage, listing and ranked. ``split`` has (symbol, q), ``flagged``
    (manager, symbol, q), ``reissued`` (symbol, q). A manager flagged now or a quarter before is left
    out of net shares; one unknown side makes them unknown, a split or reissue too. listing is
    new-listing, recent-listing, new-coverage, ended or reissued, else null: only those without one are ranked.
    """
    f = flagged.select("manager", "symbol", "q").distinct()
    out = f.select("manager", "symbol", F.explode(F.array("q", F.col("q") + 1)).alias("q")).distinct().withColumn("out", F.lit(True))
    m = moved.join(f.withColumn("flag", F.lit(True)), ["manager", "symbol", "q"], "left").join(out, ["manager", "symbol", "q"], "left")
    cmp, act, counts = F.col("comparable"), F.col("action"), F.col("out").isNull()
    n = lambda kind: F.count_if(cmp & (act == kind))
    g = m.groupBy("symbol", "q").agg(
        F.count_if(cmp & F.col("holds")).alias("holders"), F.count_if(F.col("holds")).alias("everyone"),
        F.coalesce(F.sum(F.when(cmp, F.col("value"))), F.lit(0.0)).alias("value"), F.coalesce(F.sum(F.when(cmp, F.col("shares"))), F.lit(0.0)).alias("shares"),
        *[n(k).alias(k) for k in ("new", "added", "trimmed", "held", "exited")],
        F.count_if(cmp & F.col("holds") & F.col("flag").isNotNull()).alias("flagged"), F.coalesce(F.bool_or(cmp & counts & (act == "unknown")), F.lit(False)).alias("unknown"),
        F.sum(F.when(cmp & counts, F.col("shares") - F.coalesce("prior_shares", F.lit(0.0)))).alias("net"), F.sum(F.when(cmp & counts, F.col("prior_shares"))).alias("before"),
    )
    own = Window.partitionBy("symbol").orderBy("q")
    g = g.withColumn("prior_holders", F.when(F.lag("q").over(own) == F.col("q") - 1, F.lag("everyone").over(own)).otherwise(0))
    g = g.join(split.select("symbol", "q", F.lit(True).alias("split")).distinct(), ["symbol", "q"], "left").join(reissued.select("symbol", "q", F.lit(True).alias("re")).distinct(), ["symbol", "q"], "left")
    g = g.join(cover.select("q", "complete"), "q").join(first, "symbol")
    plain, q = F.col("split").isNull(), F.col("q")
    g = g.withColumn("net", F.when(plain & ~F.col("unknown"), F.coalesce("net", F.lit(0.0))))
    conviction = F.when(F.col("complete") & (F.col("before") > 0), F.round(F.col("net") / F.col("before"), 4))
    g = g.withColumn("conviction", conviction)
    thin = F.col("prior_holders") <= F.greatest(F.lit(3), F.floor(F.col("everyone") / 4))
    stray = (F.col("exited") >= LEFT) & (F.col("holders") <= F.greatest(F.lit(1), F.floor(F.col("exited") / STRAY))) & F.coalesce(F.col("conviction") <= FALL, F.lit(True))
    listing = (
        F.when(F.col("first_security") == q, "new-listing").when((F.col("first_security") == q - 1) & (F.col("everyone") > 0) & thin, "recent-listing")
        .when((F.col("first_symbol") == q) & (F.col("first_security") < q), "new-coverage").when((F.col("exited") > 0) & ((F.col("holders") == 0) | stray), "ended").when(F.col("re"), "reissued")
    )
    g = g.withColumn("listing", listing).filter("holders > 0 OR exited > 0")
    off = F.coalesce(F.col("listing") == "reissued", F.lit(False))
    return g.select(
        "symbol", "q", "holders", "value", "shares", "new", "added", "trimmed", "held", "exited",
        (F.col("new") + F.when(plain, F.col("added")).otherwise(0)).alias("buyers"), (F.col("exited") + F.when(plain, F.col("trimmed")).otherwise(0)).alias("sellers"),
        (F.col("new") + F.col("added") - F.col("trimmed") - F.col("exited")).alias("breadth"), "flagged", F.when(~off, F.col("net")).alias("net_shares"), F.when(~off, F.col("conviction")).alias("conviction"),
        F.when(F.col("complete"), "complete").otherwise("listed").alias("coverage"), "listing", F.col("listing").isNull().alias("ranked"),
    )


def stocks(moved: DataFrame, by_quarter: DataFrame, cover: DataFrame) -> DataFrame:
    """A row for each symbol: the last quarter held, its figures at the default quarter, and its holders over the quarters up to that."""
    last = moved.filter("holds").groupBy("symbol").agg(F.max("q").alias("last_q"))
    window = cover.filter("is_default").select(F.col("q").alias("d"))
    at = by_quarter.crossJoin(F.broadcast(window)).filter(F.col("q").between(F.col("d") - SPARK_QUARTERS + 1, F.col("d")))  # one row
    figures = ["holders", "value", "shares", "new", "added", "trimmed", "held", "exited"]
    now = F.max(F.when(F.col("q") == F.col("d"), F.struct(*figures, "listing")))
    seen = F.map_from_entries(F.collect_list(F.struct((F.col("q") - F.col("d")).alias("k"), F.col("holders").alias("v"))))  # eight at most
    g = at.groupBy("symbol").agg(now.alias("now"), seen.alias("seen"))
    j = last.join(g, "symbol", "left")
    spark = F.array_join(F.array(*[F.coalesce(F.element_at("seen", F.lit(k)), F.lit(0)).cast("string") for k in range(1 - SPARK_QUARTERS, 1)]), ",")
    zero = lambda c: F.coalesce(F.col("now")[c], F.lit(0).cast("double" if c in ("value", "shares") else "long")).alias(c)
    return j.select("symbol", "last_q", *[zero(c) for c in figures], F.col("now.listing").alias("listing"), F.coalesce(spark, F.lit(",".join("0" * SPARK_QUARTERS))).alias("spark"))


def holders(moved: DataFrame, cover: DataFrame) -> DataFrame:
    """(symbol, q, manager, value, shares, action, prior_shares): comparable lines and exits of the quarters read whole."""
    whole = cover.filter("complete").select("q")
    return moved.filter("comparable").join(F.broadcast(whole), "q").select("symbol", "q", "manager", "value", "shares", "action", "prior_shares")  # one row a quarter


def managers(moved: DataFrame, filed: DataFrame, cover: DataFrame) -> DataFrame:
    """(manager, at, q, value, positions, top, new, added, trimmed, exited): each manager's latest quarter and, if filed, the default one.

    A manager who only left positions then has no value, and a top of NaN.
    """
    default = cover.filter("is_default").agg(F.max("q").alias("d"))
    when = filed.crossJoin(F.broadcast(default)).select("manager", F.array_max("filed").alias("latest"), F.when(F.array_contains("filed", F.col("d")), F.col("d")).alias("d"))  # one row
    at = when.select("manager", F.inline(F.array(F.struct(F.lit("latest").alias("at"), F.col("latest").alias("q")), F.struct(F.lit("default").alias("at"), F.col("d").alias("q"))))).filter("q is not null")
    n = lambda kind: F.count_if(F.col("action") == kind).alias(kind)
    g = moved.groupBy("manager", "q").agg(F.sum("value").alias("value"), F.count_if("holds").alias("positions"), F.max("value").alias("most"), n("new"), n("added"), n("trimmed"), n("exited"))
    return at.join(g, ["manager", "q"]).select("manager", "at", "q", "value", "positions", F.round(quotient(F.col("most"), F.col("value")), 4).alias("top"), "new", "added", "trimmed", "exited")


def tables(pos: DataFrame, symbols: DataFrame, whole: DataFrame, split: DataFrame, flagged: DataFrame, reissued: DataFrame, keep) -> dict[str, DataFrame]:
    """All tables by name. ``keep`` writes a shared intermediate once and gives it back; positions are read for that only."""
    filed = keep(filings(pos, whole), "filed")
    moved = keep(moves(symbol_lines(pos, symbols), filed), "moves")
    cover, first = keep(coverage(filed), "coverage"), keep(first_quarters(pos, symbols), "first")
    by_quarter = keep(quarters(moved, cover, first, split, flagged, reissued), "quarters")
    return {"quarters": by_quarter, "stocks": stocks(moved, by_quarter, cover), "holders": holders(moved, cover), "managers": managers(moved, filed, cover), "coverage": cover}


def keeper(spark: SparkSession, folder: str):
    """Writes a table under ``folder`` and reads it back: short lineage, and a lost executor's part is read again."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep
