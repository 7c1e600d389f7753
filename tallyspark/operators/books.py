"""Books at the grain of a class: rights apart from shares, moves by one window, splits by three tests, prices with exemptions.

Lines are rows (manager, security, issuer, class, right, q, value, shares); a
position is of one manager, security, class with its right (``PUT``, ``CALL`` or
none) and quarter. q counts quarters, so adjacent ones differ by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.holdings import SPLIT_FACTORS

PLACEHOLDER = "000000000"
#: Least pairs, sum ratio's tolerance, least factor, median's tolerance, least share near, price band of the aggregate test.
AGGREGATE = (10, 0.05, 3.0, 0.25, 0.15, 2.5, 1.4)
#: Least pairs, tolerance of the median, of a near pair and least share near, and the bands of prices.
BY_PRICE = (5, 0.15, 0.10, 0.15, 1.2, 1.4)

_GRAIN = ["manager", "security", "class"]


def is_right(cls: Column) -> Column:
    """Whether a class with its right is an option: it ends in PUT or CALL."""
    return F.upper(cls).rlike("(PUT|CALL)$")


def class_positions(lines: DataFrame) -> DataFrame:
    """(manager, security, class, q, issuer, value, shares), summed; placeholders and blank securities go.

    The issuer is that of the first line by value; shares are rounded half-even.
    """
    known = lines.filter((F.coalesce(F.trim("security"), F.lit("")) != "") & (F.col("security") != PLACEHOLDER))
    cls = F.upper(F.concat(F.coalesce("class", F.lit("")), F.coalesce("right", F.lit(""))))
    g = known.groupBy("manager", F.upper("security").alias("security"), cls.alias("class"), "q").agg(
        F.max_by("issuer", F.struct("value", "issuer")).alias("issuer"), F.sum("value").alias("value"), F.sum("shares").alias("shares")
    )
    return g.select(*_GRAIN, "q", "issuer", F.col("value").cast("double").alias("value"), F.bround("shares", 0).cast("double").alias("shares"))


def declared_scale(lines: DataFrame, least: int = 10) -> DataFrame:
    """(manager, q, scale): by the median of value by share of lines without a right, else as the schema version declares.

    At least ``least`` priced lines decide; from X0202 on a schema declares dollars.
    """
    priced = F.when((F.col("shares") > 0) & F.col("right").isNull(), F.col("value").cast("double") / F.col("shares").cast("double"))
    g = lines.groupBy("manager", "q").agg(F.median(priced).alias("m"), F.count(priced).alias("n"), F.max("schema").alias("schema"))
    declared = F.when(F.col("schema") >= "X0202", 1).otherwise(1000)
    scale = F.when((F.col("n") >= least) & (F.col("m") >= 2), 1).when((F.col("n") >= least) & (F.col("m") <= 0.5), 1000).otherwise(declared)
    return g.select("manager", "q", scale.cast("int").alias("scale"))


def class_moves(pos: DataFrame) -> DataFrame:
    """Each position with the shares and value of the quarter before, whether its class stays, and its action.

    One window over a position's quarters gives both neighbours; the quarters a
    manager filed come from one aggregate.
    """
    own = Window.partitionBy(*_GRAIN).orderBy("q")
    w = pos.withColumns({"__pq": F.lag("q").over(own), "__ps": F.lag("shares").over(own), "__pv": F.lag("value").over(own), "__nq": F.lead("q").over(own)})
    adjacent = F.col("__pq") == F.col("q") - 1
    filed = pos.groupBy("manager").agg(F.collect_set("q").alias("__filed"))
    j = w.join(filed, "manager")
    had = F.array_contains("__filed", F.col("q") - 1)
    prior = F.when(adjacent, F.col("__ps"))
    action = (
        F.when(~had, "held").when(prior.isNull(), "new").when(F.col("shares") > prior, "added").when(F.col("shares") < prior, "trimmed").otherwise("held")
    )
    follows = F.array_contains("__filed", F.col("q") + 1)
    gone = follows & ~F.coalesce(F.col("__nq") == F.col("q") + 1, F.lit(False))
    return j.select(*pos.columns, prior.alias("prior_shares"), F.when(adjacent, F.col("__pv")).alias("prior_value"), had.alias("comparable"), action.alias("action"), gone.alias("gone_next"))


def class_exits(moves: DataFrame) -> DataFrame:
    """(manager, security, q, prior_shares, prior_value): securities with no class left in the manager's next book, classes summed."""
    g = moves.groupBy("manager", "security", "q").agg(F.bool_or("gone_next").alias("gone"), F.sum("shares").alias("prior_shares"), F.sum("value").alias("prior_value"))
    g = g.withColumn("next", F.lead("q").over(Window.partitionBy("manager", "security").orderBy("q")))
    g = g.filter(F.col("gone") & ~F.coalesce(F.col("next") == F.col("q") + 1, F.lit(False)))
    return g.select("manager", "security", (F.col("q") + 1).cast("int").alias("q"), "prior_shares", "prior_value")


def turnover_by_class(moves: DataFrame) -> DataFrame:
    """min(bought, sold) over the mean of a book's totals now and a quarter before, from moves alone."""
    price, change = F.col("value") / F.col("shares"), F.col("shares") - F.col("prior_shares")
    now = moves.groupBy("manager", "q").agg(
        F.sum(F.when(F.col("action") == "new", F.col("value")).when(F.col("action") == "added", change * price)).alias("bought"),
        F.sum(F.when(F.col("action") == "trimmed", -change * price)).alias("sold"),
        F.sum("value").alias("total"),
        F.sum(F.when(F.col("gone_next"), F.col("value"))).alias("closes"),
        F.bool_or("comparable").alias("comparable"),
    )
    own = Window.partitionBy("manager").orderBy("q")
    w = now.withColumns({"prior_total": F.lag("total").over(own), "closed": F.lag("closes").over(own)}).filter("comparable")
    zero = F.lit(0.0)
    least = F.least(F.coalesce("bought", zero), F.coalesce("sold", zero) + F.coalesce("closed", zero))
    return w.select("manager", "q", F.round(least / ((F.col("total") + F.col("prior_total")) / 2), 4).alias("turnover"))


def paired(pos: DataFrame, listed: DataFrame) -> DataFrame:
    """(manager, q, whole) of managers with this book and the one before; whole where both list all their positions.

    ``listed`` has (manager, q, listed): the positions that the filing states.
    """
    n = pos.groupBy("manager", "q").agg(F.count("*").alias("n")).join(listed, ["manager", "q"], "left")
    full = n.select("manager", "q", (F.coalesce("listed", F.lit(0)) >= F.col("n")).alias("full"))
    before = full.select("manager", (F.col("q") + 1).alias("q"), F.col("full").alias("full_before"))
    return full.join(before, ["manager", "q"]).select("manager", "q", (F.col("full") & F.col("full_before")).alias("whole"))


def _near(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(F.log(a / b)) <= F.log(F.lit(1 + tolerance))


def splits(moves: DataFrame) -> DataFrame:
    """(security, q, factor, test): the split that holders' counts show, else that prices show, else that sums show.

    Pairs are positions without a right that a manager holds now and held a
    quarter before. Three tests in order: two holders and 70 % moved by one
    factor within 3 %; five pairs whose median is near a factor, some pairs near
    it and prices that answer; ten pairs whose sums moved by one.
    """
    pairs = moves.filter(~is_right(F.col("class")) & (F.col("prior_shares") > 0) & (F.col("shares") > 0))
    pairs = pairs.select("security", "q", "shares", "prior_shares", (F.col("shares") / F.col("prior_shares")).alias("ratio"), (F.col("value") / F.col("shares")).alias("now"), (F.col("prior_value") / F.col("prior_shares")).alias("before"))
    g = pairs.groupBy("security", "q").agg(
        F.count("*").alias("n"), F.median("ratio").alias("m"), (F.sum("shares") / F.sum("prior_shares")).alias("sums"), (F.median("before") / F.median("now")).alias("price")
    )
    factors = F.array(*[F.lit(x) for f in SPLIT_FACTORS for x in (f, 1.0 / f)])
    tried = g.withColumn("factor", F.explode(factors))
    near = pairs.select("security", "q", "ratio").withColumn("factor", F.explode(factors)).groupBy("security", "q", "factor").agg(
        F.count_if(F.abs(F.col("ratio") - F.col("factor")) <= 0.03 * F.col("factor")).alias("same"), F.count_if(_near(F.col("ratio"), F.col("factor"), BY_PRICE[2])).alias("close")
    )
    t = tried.join(near, ["security", "q", "factor"])
    f, up = F.col("factor"), F.greatest(F.col("factor"), 1 / F.col("factor"))
    holders = (F.col("same") >= 2) & (F.col("same") >= 0.7 * F.col("n"))
    band = F.when(F.col("close") >= 0.5 * F.col("n"), F.lit(BY_PRICE[5])).otherwise(F.lit(BY_PRICE[4]))
    price = (F.col("n") >= BY_PRICE[0]) & _near(F.col("m"), f, BY_PRICE[1]) & (F.col("close") >= BY_PRICE[3] * F.col("n")) & (F.abs(F.log(F.col("price") / f)) <= F.log(band))
    least, tolerance, smallest, middle, share, low, high = AGGREGATE
    turned = F.when(f >= 1, F.col("price")).otherwise(1 / F.col("price"))
    sums = (F.col("n") >= least) & _near(F.col("sums"), f, tolerance) & (up >= smallest) & _near(F.col("m"), f, middle) & (F.col("close") >= share * F.col("n")) & (turned >= up / low) & (turned <= high * up)
    test = F.when(holders, 1).when(price, 2).when(sums, 3)
    hit = t.withColumn("k", test).filter("k is not null")
    best = hit.groupBy("security", "q").agg(F.min_by(F.struct("factor", "k"), F.struct("k", F.abs(F.log(F.col("m") / F.col("factor"))), "factor")).alias("x"))
    return best.select("security", "q", "x.factor", F.element_at(F.array(F.lit("holders"), F.lit("price"), F.lit("aggregate")), F.col("x.k")).alias("test"))


def flagged_prices(pos: DataFrame, stale: DataFrame, tolerance: float = 0.05, least: int = 3) -> DataFrame:
    """(manager, security, class, q, price, others, verdict) of priced lines: stale, rounding, flagged or ok.

    The median of a line's others needs only the two middle prices of its group
    and their neighbours: those are joined to the lines, not all prices. Filings
    in ``stale`` (manager, q) are exempt, then lines whose value, to half a unit,
    can't carry the tolerance.
    """
    p = pos.filter("shares > 0").withColumn("price", F.col("value") / F.col("shares"))
    group = ["security", "class", "q"]
    p = p.withColumn("at", F.row_number().over(Window.partitionBy(*group).orderBy("price", "manager")))
    n = p.groupBy(*group).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    half = F.floor(F.col("n") / 2).cast("int")
    middle = p.join(n, group).filter(F.col("at").between(half - 1, half + 2)).groupBy(*group, "n").agg(F.map_from_entries(F.collect_list(F.struct("at", "price"))).alias("mid"))
    j = p.join(middle, group)

    def other(k: Column) -> Column:
        return F.element_at("mid", F.when(k < F.col("at"), k).otherwise(k + 1).cast("int"))

    left = F.col("n") - 1
    k = F.floor(left / 2).cast("int")
    j = j.withColumn("others", F.when(left % 2 == 1, other(k + 1)).otherwise((other(k) + other(k + 1)) / 2))
    j = j.join(stale.select("manager", "q", F.lit(True).alias("old")).distinct(), ["manager", "q"], "left")
    verdict = (
        F.when(F.col("old"), "stale").when(0.5 / F.col("shares") > tolerance * F.col("others"), "rounding").when(F.abs(F.col("price") / F.col("others") - 1) > tolerance, "flagged").otherwise("ok")
    )
    return j.select("manager", *group, "price", "others", verdict.alias("verdict"))


def net_by_symbol(moves: DataFrame, split: DataFrame, flagged: DataFrame) -> DataFrame:
    """(security, q, buyers, sellers, net_shares): rights and flagged managers apart.

    A security that split has no net and its added and trimmed lines are neither
    buyers nor sellers; a line whose manager can't be compared makes the net unknown.
    """
    m = moves.filter(~is_right(F.col("class"))).join(flagged.select("manager", "q").distinct(), ["manager", "q"], "left_anti")
    m = m.join(split.select("security", "q", F.lit(True).alias("split")), ["security", "q"], "left").withColumn("split", F.coalesce("split", F.lit(False)))
    counts = F.col("comparable")
    g = m.groupBy("security", "q").agg(
        F.count_if(counts & ((F.col("action") == "new") | ((F.col("action") == "added") & ~F.col("split")))).alias("buyers"),
        F.count_if(counts & (F.col("action") == "trimmed") & ~F.col("split")).alias("sellers"),
        F.when(F.bool_or("split") | F.bool_or(~counts), None).otherwise(F.sum(F.col("shares") - F.coalesce("prior_shares", F.lit(0.0)))).alias("net_shares"),
    )
    return g


def name_spans(pos: DataFrame) -> DataFrame:
    """(security, issuer, first_q, last_q, managers, latest): the spans of a security's names, and whether each is the latest."""
    g = pos.groupBy("security", "issuer").agg(F.min("q").alias("first_q"), F.max("q").alias("last_q"), F.countDistinct("manager").alias("managers"))
    newest = F.row_number().over(Window.partitionBy("security").orderBy(F.desc("last_q"), "issuer"))
    return g.withColumn("latest", newest == 1)


def reissued(pos: DataFrame, least: int = 3) -> DataFrame:
    """(old, new, q, holders, kept): a security whose holders all left and a new one that at least half of them hold.

    Holders are managers with both books; the new one stood in no book before.
    """
    held = pos.select("manager", "security", "q").distinct()
    filed = held.select("manager", "q").distinct()
    span = held.groupBy("security").agg(F.min("q").alias("first_q"), F.max("q").alias("last_q"))
    gone = held.join(span, "security").filter("q = last_q").select("manager", F.col("security").alias("old"), (F.col("q") + 1).alias("q"))
    gone = gone.join(filed, ["manager", "q"], "left_semi")
    fresh = held.join(span, "security").filter("q = first_q").select("manager", F.col("security").alias("new"), "q")
    sizes = gone.groupBy("old", "q").agg(F.count("*").alias("holders")).filter(F.col("holders") >= least)
    both = gone.join(fresh, ["manager", "q"]).groupBy("old", "new", "q").agg(F.count("*").alias("kept"))
    return both.join(sizes, ["old", "q"]).filter(F.col("kept") * 2 >= F.col("holders")).select("old", "new", "q", "holders", "kept")


def book_aggregates(pos: DataFrame, symbols: DataFrame) -> DataFrame:
    """(manager, q, symbol, value, shares, securities, first_q): sums by symbol without rights, and the symbol's first quarter with the manager."""
    j = pos.filter(~is_right(F.col("class"))).join(symbols, "security")
    g = j.groupBy("manager", "q", "symbol").agg(F.sum("value").alias("value"), F.sum("shares").alias("shares"), F.array_join(F.array_sort(F.collect_set("security")), ",").alias("securities"))
    return g.withColumn("first_q", F.min("q").over(Window.partitionBy("manager", "symbol")))


def manager_snapshot(moves: DataFrame, most: int = 200, most_exits: int = 100) -> DataFrame:
    """(manager, security, class, kind, value): the newest book's largest positions and the largest exits into it."""
    newest = Window.partitionBy("manager")
    m = moves.withColumn("last", F.max("q").over(newest))
    held = m.filter("q = last").select("manager", "security", "class", F.lit("held").alias("kind"), "value")
    gone = m.filter("q = last - 1 and gone_next").select("manager", "security", "class", F.lit("exited").alias("kind"), "value")
    ranked = held.unionByName(gone).withColumn("n", F.row_number().over(Window.partitionBy("manager", "kind").orderBy(F.desc("value"), "security", "class")))
    return ranked.filter(F.col("n") <= F.when(F.col("kind") == "held", most).otherwise(most_exits)).drop("n")
