"""Reported facts: periods, choice of tag, trailing twelve months, aligned EBITDA, net debt, multiples.

Facts are rows (cik, tag, start, end, val, filed); start is null for an instant.
What wasn't reported stays null: it's never zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import first_per_key

YEAR_DAYS, QUARTER_DAYS, STALE_DAYS, ALIGN_DAYS, BALANCE_DAYS = (340, 400), (80, 100), 456, 7, 100


def days(fact_start: str = "start", fact_end: str = "end") -> Column:
    return F.datediff(fact_end, fact_start)


def period_kind(start: Column, end: Column) -> Column:
    n = F.datediff(end, start)
    return F.when(start.isNull() | (n <= 1), "instant").when(n.between(*YEAR_DAYS), "year").when(n.between(*QUARTER_DAYS), "quarter").otherwise("other")


def earliest_filed(facts: DataFrame) -> DataFrame:
    """One fact for each (cik, tag, start, end): the earliest filed, the lesser value of equals."""
    return first_per_key(facts, ["cik", "tag", "start", "end"], [F.col("filed"), F.col("val")])


def as_of(facts: DataFrame, day: Column) -> DataFrame:
    """Facts that end and were filed on or before a day."""
    return facts.filter((F.col("end") <= day) & (F.col("filed") <= day))


def chosen_tag(facts: DataFrame, ranked: list[str]) -> DataFrame:
    """(cik, tag): of tags for the same line, the one that reaches furthest, then with most facts, then of best rank."""
    rank = F.array_position(F.array(*[F.lit(t) for t in ranked]), F.col("tag"))
    g = facts.filter(F.col("tag").isin(ranked)).groupBy("cik", "tag").agg(F.max("end").alias("last"), F.count("*").alias("n"))
    return g.groupBy("cik").agg(F.max_by("tag", F.struct(F.col("last"), F.col("n"), -rank)).alias("tag"))


def trailing_year(facts: DataFrame) -> DataFrame:
    """(cik, tag, end, ltm, basis): the last year plus what the running year has so far less the same of the year before.

    Without a matching pair of part-years the last year stands, with basis FY.
    Lengths of the two parts differ by at most seven days, and so do their ends
    from a year apart.
    """
    f = earliest_filed(facts).filter(F.col("start").isNotNull()).withColumn("n", days())
    years = f.filter(F.col("n").between(*YEAR_DAYS))
    last = years.groupBy("cik", "tag").agg(F.max("end").alias("fy_end"), F.max_by("val", "end").alias("fy"))
    part = f.filter((F.col("n") > 1) & (F.col("n") < YEAR_DAYS[0])).join(last, ["cik", "tag"])
    now = part.filter((F.col("end") > F.col("fy_end")) & (F.abs(F.datediff("start", "fy_end")) <= ALIGN_DAYS))
    now = now.groupBy("cik", "tag").agg(F.max_by(F.struct("end", "val", "n"), F.struct("end", "n")).alias("now"))
    before = f.select("cik", "tag", F.col("end").alias("b_end"), F.col("val").alias("b_val"), F.col("n").alias("b_n"))
    paired = now.join(before, ["cik", "tag"]).filter(
        (F.abs(F.datediff(F.col("now.end"), F.col("b_end")) - 365) <= ALIGN_DAYS) & (F.abs(F.col("now.n") - F.col("b_n")) <= ALIGN_DAYS)
    )
    paired = paired.groupBy("cik", "tag").agg(F.first("now").alias("now"), F.min_by("b_val", F.abs(F.col("now.n") - F.col("b_n"))).alias("b_val"))
    j = last.join(paired, ["cik", "tag"], "left")
    has = F.col("b_val").isNotNull()
    return j.select(
        "cik", "tag", F.when(has, F.col("now.end")).otherwise(F.col("fy_end")).alias("end"),
        F.when(has, F.col("fy") + F.col("now.val") - F.col("b_val")).otherwise(F.col("fy")).alias("ltm"), F.when(has, "LTM").otherwise("FY").alias("basis"),
    )


def ebitda(lines: DataFrame, ebit: str, depreciation: list[str]) -> DataFrame:
    """(cik, ebitda) from trailing rows (cik, tag, end, ltm): EBIT and the first depreciation tag whose end is at most seven days off."""
    base = lines.filter(F.col("tag") == ebit).select("cik", F.col("end").alias("e_end"), F.col("ltm").alias("e"))
    rank = F.array_position(F.array(*[F.lit(t) for t in depreciation]), F.col("tag"))
    d = lines.filter(F.col("tag").isin(depreciation)).select("cik", F.col("end").alias("d_end"), F.col("ltm").alias("d"), rank.alias("r"))
    near = base.join(d, "cik").filter(F.abs(F.datediff("e_end", "d_end")) <= ALIGN_DAYS).groupBy("cik").agg(F.min_by("d", "r").alias("d"))
    return base.join(near, "cik", "left").select("cik", (F.col("e") + F.col("d")).alias("ebitda"))


def net_debt(balances: DataFrame, debt: list[str], cash: list[str], mode: str = "skill") -> DataFrame:
    """(cik, net_debt) from the last instants: debt less cash and the like.

    Mode skill: null without any debt tag, missing cash counts as none. Mode
    precedent: parts over 100 days older than the newest are left out first.
    """
    last = first_per_key(balances.filter(F.col("tag").isin(debt + cash)), ["cik", "tag"], [F.desc("end"), F.col("filed")])
    if mode == "precedent":
        newest = F.max("end").over(Window.partitionBy("cik"))
        last = last.withColumn("__newest", newest).filter(F.datediff("__newest", "end") <= BALANCE_DAYS)
    g = last.groupBy("cik").agg(
        F.sum(F.when(F.col("tag").isin(debt), F.col("val"))).alias("debt"), F.coalesce(F.sum(F.when(F.col("tag").isin(cash), F.col("val"))), F.lit(0.0)).alias("cash")
    )
    return g.select("cik", (F.col("debt") - F.col("cash")).alias("net_debt"))


def growth(axis: DataFrame) -> DataFrame:
    """v over the period before, less one, along rows (cik, tag, end, v); null for the first and after zero."""
    w = Window.partitionBy("cik", "tag").orderBy("end")
    return axis.withColumn("growth", F.round(F.try_divide(F.col("v"), F.lag("v").over(w)) - 1, 6))


def statements(facts: DataFrame, revenue: str, lines: list[str], years: int = 5) -> DataFrame:
    """Rows (cik, end, revenue, growth, and each line with its margin): a company's last ``years`` annual revenues and what was reported at those ends.

    A line takes the annual fact that ends nearest, at most seven days off; one
    that isn't reported is null, and so is its margin. Growth is over the year
    before on the axis, also beyond the years shown. Margins of no revenue are null.
    """
    f = earliest_filed(facts).filter(period_kind(F.col("start"), F.col("end")) == "year").select("cik", "tag", "end", "val")
    own = Window.partitionBy("cik")
    axis = f.filter(F.col("tag") == revenue).groupBy("cik", "end").agg(F.min("val").alias("revenue"))
    axis = axis.withColumn("growth", F.round(F.try_divide("revenue", F.lag("revenue").over(own.orderBy("end"))) - 1, 6))
    axis = axis.withColumn("__k", F.row_number().over(own.orderBy(F.desc("end")))).filter(F.col("__k") <= years).drop("__k")
    other = f.filter(F.col("tag").isin(lines)).select("cik", "tag", F.col("end").alias("__end"), "val")
    gap = F.abs(F.datediff("end", "__end"))
    near = axis.select("cik", "end").join(other, "cik").filter(gap <= ALIGN_DAYS)
    held = near.groupBy("cik", "end").agg(*[F.min(F.when(F.col("tag") == t, F.struct(gap.alias("gap"), "__end", "val")))["val"].alias(t) for t in lines])
    full = axis.join(held, ["cik", "end"], "left")
    return full.select("cik", "end", "revenue", "growth", *[c for t in lines for c in (F.col(t), F.round(F.try_divide(F.col(t), F.col("revenue")), 6).alias(f"{t}_margin"))])


def fiscal_years(ends: DataFrame, filings: DataFrame, key: str, within: int = 150) -> DataFrame:
    """(key, end, fy): a period end's fiscal year by the first filing (key, filed, fy) at most ``within`` days after it, else by its own year.

    Ends in January and February are of the year before, whatever is filed.
    """
    j = ends.join(filings, key).filter(F.datediff("filed", "end").between(1, within)).groupBy(key, "end").agg(F.min_by("fy", F.struct("filed", "fy")).alias("fy"))
    own = F.when(F.month("end") <= 2, F.year("end") - 1).otherwise(F.year("end"))
    return ends.join(j, [key, "end"], "left").select(key, "end", F.coalesce(F.when(F.month("end") > 2, F.col("fy")), own).cast("int").alias("fy"))
