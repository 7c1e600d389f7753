"""One reference row a symbol: its latest price and every figure that its history supports.

Observations of a symbol are gathered once and laid out on the whole calendar;
all windows then read that grid, which is already dealt by symbol. A corporate
action that history can't be carried over bounds every window: a figure is
stated only if its whole window, base included, starts at the boundary or after.
"""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.arrays import logarithm, quotient, scaled_round

YEAR, COVERAGE, MOST_LAG, SLACK = 252, 0.8, 2, 3
#: Slots back of the changes that a row states, and the one that its shorter volatility spans.
CHANGES = {"1m": 21, "3m": 63, "6m": 126, "12m": 252}
BOUNDING = ("other", "unresolved")

_SEEN = ("price", "grade", "seconds", "trades", "late", "dollars")


def grid(obs: DataFrame, actions: DataFrame, slots: int) -> DataFrame:
    """A row for each symbol and slot from 0 to ``slots`` - 1: what was observed, or nulls, and what holds for the symbol.

    ``obs`` is (symbol, i, price, grade, seconds, trades, late, dollars), one row a symbol and
    slot, ``actions`` (symbol, i, kind, ratio) with a kind of split, other, unresolved or
    ordinary. A split of ratio r turns an earlier price p into r * p. Symbols
    without an observation have no rows. A symbol holds at most ``slots`` of each, so
    gathering it is bounded by the calendar.
    """
    action = F.struct("i", "kind", "ratio")
    rows = obs.select("symbol", F.struct("i", *_SEEN).alias("seen"), F.lit(None).cast("struct<i:int,kind:string,ratio:double>").alias("action"))
    typed = actions.select("symbol", F.lit(None).cast(rows.schema["seen"].dataType).alias("seen"), action.cast("struct<i:int,kind:string,ratio:double>").alias("action"))
    own = rows.unionByName(typed).filter(F.coalesce("seen.i", "action.i").between(0, slots - 1)).groupBy("symbol").agg(F.collect_list("seen").alias("seen"), F.array_sort(F.collect_list("action")).alias("actions"))
    own = own.filter(F.size("seen") > 0).withColumn("last", F.array_max(F.transform("seen", lambda s: s["i"])))
    bounding = F.filter("actions", lambda a: a["kind"].isin(*BOUNDING))
    own = own.withColumn("boundary", F.array_max(F.transform(bounding, lambda a: a["i"])))
    by_slot = F.map_from_entries(F.transform("seen", lambda s: F.struct(s["i"].alias("key"), s.alias("value"))))
    ratios = F.filter("actions", lambda a: (a["kind"] == "split") & (a["ratio"] > 0))
    ratio_at = F.map_from_entries(F.transform(ratios, lambda a: F.struct(a["i"].alias("key"), a["ratio"].alias("value"))))
    kind_at = F.map_from_entries(F.transform("actions", lambda a: F.struct(a["i"].alias("key"), a["kind"].alias("value"))))
    own = own.select("symbol", "actions", "last", "boundary", by_slot.alias("at"), ratio_at.alias("ratio_at"), F.element_at(kind_at, F.col("last")).alias("latest_kind"))
    each = own.select("*", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("i"))
    later = Window.partitionBy("symbol").orderBy("i").rowsBetween(1, Window.unboundedFollowing)
    each = each.select(
        "symbol", "i", "last", "boundary", "latest_kind", "actions", *[F.element_at("at", F.col("i"))[c].alias(c) for c in _SEEN],
        F.coalesce(F.element_at("ratio_at", F.col("i")), F.lit(1.0)).alias("ratio"),
    )
    return each.withColumn("adjusted", F.col("price") * F.coalesce(F.product("ratio").over(later), F.lit(1.0)))


def reference_rows(
    obs: DataFrame, actions: DataFrame, calendar: list[datetime.date], year: int = YEAR, changes: dict[str, int] | None = None, short: str = "3m", coverage: float = COVERAGE
) -> DataFrame:
    """The reference row of each symbol, on the calendar's slots, the last of which is the day it is as of.

    lag, status (ok, stale, discontinuity), date, grade, seconds, trades, late, dollars,
    price, splits, corporate_actions, valid_from, coverage and stats_status; then, where the
    status is ok and the window lies after the boundary and is observed enough:
    base_K and base_K_date of each change, vol_short, high, low and their dates,
    vol_year, and the drawdown's peak and trough; ``weekly`` holds the last
    observation of each week. Dates are slots of the calendar. A price whose day's big move nothing explains, seen at a
    grade other than H, is withheld as a discontinuity; what isn't supported is null. A price
    of zero counts: the steps to and from it are infinite, and a volatility over them is NaN.
    """
    changes = CHANGES if changes is None else changes
    slots = len(calendar)
    g = grid(obs, actions, slots)
    i, last, bound, p = F.col("i"), F.col("last"), F.col("boundary"), F.col("adjusted")
    own = Window.partitionBy("symbol").orderBy("i")
    first = last - year + 1
    within = lambda a: (i >= a) & (i <= last)
    day = F.element_at(F.array(*[F.lit(d) for d in calendar]), i + 1)
    g = g.withColumn("step", logarithm(quotient(p, F.lag(p).over(own))))
    g = g.withColumn("top", F.max(F.when(within(first) & p.isNotNull(), F.struct(p.alias("p"), (-i).alias("less")))).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    g = g.withColumn("fall", F.when(within(first) & (p < F.col("top.p")), 1 - quotient(p, F.col("top.p"))))
    week = Window.partitionBy("symbol", F.date_trunc("week", day))
    charted = p.isNotNull() & (i >= F.greatest(F.lit(slots - year), F.coalesce(bound, F.lit(0))))
    g = g.withColumn("charted", charted & (i == F.max(F.when(charted, i)).over(week)))

    seen = lambda a: F.count_if(within(a) & p.isNotNull())
    of_last = lambda c: F.max(F.when(i == last, F.col(c)))
    in_year = F.when(within(first), p)
    found: dict[str, Column] = {c: F.first(c) for c in ("last", "boundary", "latest_kind", "actions")}
    found |= {c: of_last(c) for c in _SEEN} | {"in_year": seen(first)}
    for name, back in changes.items():
        start = last - back
        usable = p.isNotNull() & (F.abs(i - start) <= SLACK) & ((i <= start) | (i < last))
        found[f"seen_{name}"] = seen(start)
        found[f"near_{name}"] = F.min(F.when(usable, F.struct(F.abs(i - start).alias("off"), (i > start).alias("later"), i.alias("i"), p.alias("p"))))
    for name, start in (("short", last - changes[short]), ("year", first - 1)):
        steps = F.when((i > start) & (i <= last), F.col("step"))
        found |= {f"n_{name}": F.count(steps), f"sd_{name}": F.stddev_samp(steps)}
    found["high"] = F.max(F.struct(in_year.alias("p"), (-i).alias("less")))
    found["low"] = F.min(F.when(in_year.isNotNull(), F.struct(in_year.alias("p"), i.alias("i"))))
    found["deepest"] = F.max(F.when(F.col("fall") > 0, F.struct("fall", (-i).alias("less"), p.alias("p"), "top")))
    found["weekly"] = F.array_sort(F.collect_list(F.when(F.col("charted"), F.struct(i.alias("date"), scaled_round(p, 4).alias("price")))))
    r = g.groupBy("symbol").agg(*[c.alias(f"_{k}") for k, c in found.items()])

    c = {k: F.col(f"_{k}") for k in found}
    bound, last = c["boundary"], c["last"]
    first = last - year + 1
    lag = F.lit(slots - 1) - last
    unexplained = c["latest_kind"].isin("ordinary", "unresolved") & ~F.coalesce(c["grade"] == "H", F.lit(False))
    status = F.when(lag > MOST_LAG, "stale").when(unexplained, "discontinuity").otherwise("ok")
    enough = lambda n, of: n >= math.ceil(of * coverage)
    whole = (first >= 0) & after(bound, first) & enough(c["in_year"], year)
    ok, full = status == "ok", (status == "ok") & whole
    say = lambda when, x: F.when(F.coalesce(when, F.lit(False)), x)
    price = lambda x: scaled_round(x, 4)
    actions_of = lambda kinds: F.filter(c["actions"], lambda a: a["kind"].isin(*kinds))
    out = {
        "lag": lag, "status": status, "date": last, "grade": c["grade"], "seconds": c["seconds"], "trades": c["trades"], "late": c["late"], "dollars": c["dollars"],
        "price": say(ok, price(c["price"])), "splits": F.transform(actions_of(("split",)), lambda a: F.struct(a["i"].alias("date"), a["ratio"].alias("ratio"))),
        "corporate_actions": F.transform(actions_of(("split", *BOUNDING)), lambda a: F.struct(a["i"].alias("date"), a["kind"].alias("kind"))),
        "valid_from": bound, "coverage": scaled_round(c["in_year"] / year, 2), "stats_status": F.when(whole, "ok").otherwise("history"),
    }
    for name, back in changes.items():
        near = c[f"near_{name}"]
        stated = ok & (last - back >= 0) & after(bound, last - back) & enough(c[f"seen_{name}"], back + 1) & after(bound, near["i"])
        out |= {f"base_{name}": say(stated, price(near["p"])), f"base_{name}_date": say(stated, near["i"])}
    for name, when, start, least in (("short", ok, last - changes[short], changes[short]), ("year", full, first - 1, year - 1)):
        stated = when & after(bound, start) & enough(c[f"n_{name}"], least)
        out |= {f"vol_{name}": say(stated, price(c[f"sd_{name}"] * math.sqrt(YEAR))), f"vol_{name}_returns": say(stated, c[f"n_{name}"])}
    high, low, deep = c["high"], c["low"], c["deepest"]
    out |= {"high": say(full, price(high["p"])), "high_date": say(full, -high["less"]), "low": say(full, price(low["p"])), "low_date": say(full, low["i"])}
    out |= {
        "drawdown_peak": say(full, price(deep["top"]["p"])), "drawdown_peak_date": say(full, -deep["top"]["less"]),
        "drawdown_trough": say(full, price(deep["p"])), "drawdown_trough_date": say(full, -deep["less"]),
        "weekly": say(ok, c["weekly"]),
    }
    return r.select("symbol", *[x.alias(k) for k, x in out.items()])


def after(boundary: Column, at: Column) -> Column:
    """Whether a window that starts ``at`` this slot lies after the boundary, if there is one."""
    return boundary.isNull() | (at >= boundary)


def weekly_shards(rows: DataFrame) -> DataFrame:
    """(shard, symbol, date, price): the weekly observations of priced symbols, by first letter."""
    return rows.filter("status = 'ok'").select(F.substring("symbol", 1, 1).alias("shard"), "symbol", F.inline("weekly"))
