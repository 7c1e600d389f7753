"""Deal rows: value, multiples and doubts, duplicate intervals, the primary reading, borrowed fields, FX guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.dedupe import fold_first_fit
from tallyspark.operators.joins import first_per_key

#: Days between readings of one deal: of its agreement, or where a reading states none, of its announcement.
SAME_AGREEMENT_DAYS, SAME_DEAL_DAYS = 7, 180
DUPLICATE_DAYS, OFFER_TOLERANCE, MOST_FX_MOVE = 180, 0.005, 0.2


def valued(deals: DataFrame) -> DataFrame:
    """Adds unaffected price, equity value, enterprise value and multiples, and the doubts about them.

    From offer, premium, shares, net_debt, revenue, ebitda; an unknown part makes
    what needs it unknown.
    """
    d = deals.withColumn("unaffected", F.try_divide(F.col("offer"), 1 + F.col("premium")))
    d = d.withColumn("equity", F.col("offer") * F.col("shares")).withColumn("ev", F.col("equity") + F.col("net_debt"))
    d = d.withColumn("ev_revenue", F.when(F.col("revenue") > 0, F.col("ev") / F.col("revenue"))).withColumn("ev_ebitda", F.when(F.col("ebitda") > 0, F.col("ev") / F.col("ebitda")))
    doubts = [
        (F.col("offer") > 2000, "offer"), (F.col("premium") > 1.5, "premium"), (F.col("net_debt").isNull(), "balance"), (F.col("ev") <= 0, "ev"),
        (F.col("revenue") < 0, "revenue"), (~F.col("ev_ebitda").between(1, 75), "ev_ebitda"), (F.col("ev_revenue") > 60, "ev_revenue"),
    ]
    return d.withColumn("doubts", F.array_join(F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for c, n in doubts])), ","))


def duplicate_intervals(candidates: DataFrame, known: DataFrame, key: str, days: int = DUPLICATE_DAYS) -> DataFrame:
    """Candidates (key, filed) with the nearest known deal of the key announced at most ``days`` apart."""
    j = candidates.join(known.select(key, "announced", "deal"), key)
    gap = F.abs(F.datediff("filed", "announced"))
    return first_per_key(j.withColumn("gap", gap).filter(F.col("gap") <= days), ["candidate"], [F.col("gap"), F.col("deal")]).select("candidate", "deal", "gap")


def _within(a: Column, b: Column, days: int) -> Column:
    return F.abs(F.datediff(a, b)) <= days


def same_deal(a: Column, b: Column) -> Column:
    """Whether two readings of one target, structs of (day, agreed, original, buyer, parties), are of one deal.

    ``original`` is the day of the agreement that a revised one amends: a
    reading of that agreement by the same or an unnamed buyer is the same deal.
    Else two buyers are two deals, unless either reading names the other's buyer
    as a party; then the agreements' days decide, or, with one unstated, the days of announcement.
    """
    both = a["buyer"].isNotNull() & b["buyer"].isNotNull()
    one_buyer = ~both | (a["buyer"] == b["buyer"])
    amends = lambda x, y: F.coalesce(_within(x["original"], F.coalesce(y["agreed"], y["original"]), SAME_AGREEMENT_DAYS), F.lit(False))
    named = lambda x, y: F.coalesce(F.array_contains(x["parties"], y["buyer"]), F.lit(False))
    agreed = F.when(a["agreed"].isNotNull() & b["agreed"].isNotNull(), _within(a["agreed"], b["agreed"], SAME_AGREEMENT_DAYS))
    near = F.coalesce(agreed, _within(a["day"], b["day"], SAME_DEAL_DAYS), F.lit(False))
    return ((amends(a, b) | amends(b, a)) & one_buyer) | ((one_buyer | named(a, b) | named(b, a)) & near)


def deal_groups(readings: DataFrame) -> DataFrame:
    """(target, reading, deal, readings): the deal of each reading (target, reading, day, filed, agreed, original, buyer, parties).

    In order of (day, filed, reading) a reading joins the first deal of its
    target with all of whose readings it is of one deal. A deal is called by its
    target and the first day that any of its readings states, with a number where several
    would be called alike; readings without a target are no deal's. No date of one deal lies further than half a year from
    all others, so stretches of a target's readings between longer gaps are
    folded one by one: a task holds a stretch.
    """
    dated = F.array_compact(F.array("day", "agreed", "original"))
    r = readings.filter(F.col("target").isNotNull()).withColumns({"__from": F.array_min(dated), "__to": F.array_max(dated)})
    own = Window.partitionBy("target").orderBy(F.col("__from").asc_nulls_first(), "reading")
    so_far = F.max("__to").over(own.rowsBetween(Window.unboundedPreceding, -1))
    parted = F.when(F.datediff("__from", so_far) <= SAME_DEAL_DAYS, 0).otherwise(1)
    r = r.withColumn("__stretch", parted).withColumn("__stretch", F.sum("__stretch").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    member = F.struct("day", "filed", "reading", "agreed", "original", "buyer", "parties", F.array_min(F.array_compact(F.array("day", "original"))).alias("first"))
    kind = r.select(F.array(member).alias("a")).schema["a"].dataType.simpleString()
    folded = r.groupBy("target", "__stretch").agg(F.array_sort(F.collect_list(member)).alias("rows"))
    deals = folded.select("target", F.explode(fold_first_fit(F.col("rows"), same_deal, kind)).alias("members"))
    deals = deals.withColumn("first", F.array_min(F.transform("members", lambda m: m["first"]))).withColumn("least", F.array_min(F.transform("members", lambda m: m["reading"])))
    again = F.row_number().over(Window.partitionBy("target", "first", F.when(F.col("first").isNull(), F.col("least"))).orderBy("least"))
    name = F.concat_ws(":", F.col("target").cast("string"), F.coalesce(F.col("first").cast("string"), F.col("least").cast("string")), F.when(again > 1, again.cast("string")))
    named = deals.withColumn("deal", name).select("target", "deal", F.size("members").alias("readings"), F.explode("members").alias("m"))
    return named.select("target", F.col("m.reading").alias("reading"), "deal", "readings")


def primary_reading(readings: DataFrame) -> DataFrame:
    """Each deal's reading to show: among priced ones if there are any, the newest, with fewest doubts, of least id."""
    priced = F.col("offer").isNotNull()
    return first_per_key(readings, ["deal"], [F.desc(priced.cast("int")), F.desc("filed"), F.col("n_doubts"), F.col("reading")])


def borrowed(readings: DataFrame, fields: list[str]) -> DataFrame:
    """Each reading with its null fields from the deal's latest other one that has them; a premium only beside an offer within 0.5%."""
    own = Window.partitionBy("deal").orderBy("filed", "reading").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = readings
    for f in fields:
        held = F.struct(F.col(f).alias("v"), F.col("offer").alias("o"))
        last = F.last(F.when(F.col(f).isNotNull(), held), ignorenulls=True).over(own)
        near = F.abs(last["o"] / F.col("offer") - 1) <= OFFER_TOLERANCE if f == "premium" else F.lit(True)
        out = out.withColumn(f"{f}_full", F.coalesce(F.col(f), F.when(near, last["v"])))
    return out


def fx_rates(rates: DataFrame) -> DataFrame:
    """(day, usd, eur, gbp) per dollar from rates per euro: EUR = 1 / usd, GBP = gbp / usd, six places."""
    g = rates.filter(F.col("currency").isin("USD", "GBP")).groupBy("day").pivot("currency", ["USD", "GBP"]).agg(F.first("rate"))
    return g.select("day", F.lit(1.0).alias("usd"), F.round(1 / F.col("USD"), 6).alias("eur"), F.round(F.col("GBP") / F.col("USD"), 6).alias("gbp"))


def fx_problem(old: Column, new: Column, old_day: Column, new_day: Column, today: Column) -> Column:
    """Why a new rate can't replace the old one; null if it can."""
    return (
        F.when(new_day > today, "future").when(new_day < old_day, "older").when(F.abs(new / old - 1) > MOST_FX_MOVE, "move").otherwise(F.lit(None).cast("string"))
    )


def size_bucket(millions: Column) -> Column:
    edges = [(250, "micro"), (1000, "small"), (5000, "middle"), (20000, "large")]
    out = F.when(millions.isNull(), "unknown")
    for edge, name in edges:
        out = out.when(millions < edge, name)
    return out.otherwise("mega")
