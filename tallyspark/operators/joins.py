"""Joins by order, interval, range and precedence.

Ranges and as-of matches are turned into equalities on buckets or into one sort
of both sides, so that no plan falls back to comparing all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a stated order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__n", rank).filter("__n = 1").drop("__n")


def unambiguous(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) for keys that map to one value only; the others are left out rather than guessed."""
    known = pairs.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    one = known.groupBy(key).agg(F.count_distinct(value).alias("__n"), F.min(value).alias(value))
    return one.filter("__n = 1").drop("__n")


def fill_from_group(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Nulls of ``value`` take the group's value if all known ones agree."""
    agreed = unambiguous(rows, group, value).withColumnRenamed(value, "__v")
    return rows.join(agreed, group, "left").withColumn(value, F.coalesce(value, "__v")).drop("__v")


def all_ranges(rows: DataFrame, code: str, ranges: DataFrame) -> DataFrame:
    """Each row with every range (key, low, high, rank) that holds its integer code: ranges become their codes."""
    codes = ranges.select("key", "rank", F.explode(F.sequence("low", "high")).alias("__code"))
    return rows.join(codes, rows[code] == codes["__code"]).drop("__code")


def first_range(rows: DataFrame, code: str, ranges: DataFrame) -> DataFrame:
    """Each row with the first range that holds its code, by rank; null outside all of them."""
    codes = ranges.select("key", "rank", F.explode(F.sequence("low", "high")).alias("__code"))
    first = codes.groupBy("__code").agg(F.min_by("key", "rank").alias("key"))
    return rows.join(first, rows[code] == first["__code"], "left").drop("__code")


def longest_prefix(rows: DataFrame, code: str, table: DataFrame, longest: int = 4, shortest: int = 2) -> DataFrame:
    """Each row with the value of the longest prefix of its code in ``table`` (prefix, value)."""
    lengths = F.array(*[F.lit(n) for n in range(longest, shortest - 1, -1)])
    tried = rows.select(code).distinct().withColumn("__n", F.explode(lengths))
    tried = tried.withColumn("prefix", F.substring(F.col(code), F.lit(1), F.col("__n"))).filter(F.length("prefix") == F.col("__n"))
    best = tried.join(table, "prefix").groupBy(code).agg(F.max_by("value", "__n").alias("value"), F.max_by("prefix", "__n").alias("prefix"))
    return rows.join(best, code, "left")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Each row of ``left`` with the last ``value`` of its key in ``right`` at or before ``at``: one sort of both sides."""
    carried = right.select(key, at, F.struct(F.col(at).alias("at"), F.col(value).alias("value")).alias("__v"), F.lit(0).alias("__side"), F.lit(None).alias("__row"))
    asked = left.select(key, at, F.lit(None).alias("__v"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"))
    both = carried.select(key, at, "__v", "__side", F.lit(None).cast(asked.schema["__row"].dataType).alias("__row")).unionByName(
        asked.withColumn("__v", F.lit(None).cast(carried.schema["__v"].dataType))
    )
    w = Window.partitionBy(key).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumn("__last", F.last("__v", ignorenulls=True).over(w)).filter("__side = 1")
    return seen.select("__row.*", F.col("__last.value").alias(value), F.col("__last.at").alias(f"{value}_at"))


def nearest(targets: DataFrame, series: DataFrame, key: str, slack: int) -> DataFrame:
    """For targets (key, target int) the nearest point (key, i int, value) at most ``slack`` away, the earlier of two equals."""
    spread = targets.distinct().withColumn("i", F.explode(F.sequence(F.col("target") - slack, F.col("target") + slack)))
    j = spread.join(series, [key, "i"])
    gap = F.struct(F.abs(F.col("i") - F.col("target")).alias("d"), F.col("i"))
    best = j.groupBy(key, "target").agg(F.min_by("value", gap).alias("value"), F.min_by("i", gap).alias("at"))
    return targets.join(best, [key, "target"], "left")


def within_days(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str, before: int, after: int) -> DataFrame:
    """Pairs of one key whose right day lies in [left - before, left + after].

    Days are put in buckets as wide as the interval; a left row asks for the two
    or three buckets its interval touches, so pairs meet by equality.
    """
    width = before + after + 1
    number = lambda c: F.unix_date(F.col(c).cast("date"))
    asked = left.withColumn("__b", F.explode(F.sequence(F.floor((number(left_day) - before) / width), F.floor((number(left_day) + after) / width))))
    held = right.withColumn("__b", F.floor(number(right_day) / width))
    gap = F.datediff(F.col(right_day), F.col(left_day))
    return asked.join(held, [key, "__b"]).filter(gap.between(-before, after)).drop("__b")


def effective_on(rows: DataFrame, table: DataFrame, key: str, day: str) -> DataFrame:
    """Rows with ``status``: resolved if one entry of ``table`` (key, valid_from, valid_to, value; null ends are open) holds on the day, ambiguous if more, else unresolved.

    Entries are looked up once for each key and day; repeated rows stay, and an
    entry that stands twice in ``table`` is one.
    """
    asked = rows.select(key, day).distinct()
    j = asked.join(table.distinct(), key)
    holds = (F.col("valid_from").isNull() | (F.col("valid_from") <= F.col(day))) & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col(day)))
    g = j.filter(holds & F.col("value").isNotNull()).groupBy(key, day).agg(F.count("*").alias("__n"), F.min("value").alias("__v"))
    status = F.when(F.col("__n") == 1, "resolved").when(F.col("__n") > 1, "ambiguous").otherwise("unresolved")
    found = rows.join(g, [key, day], "left")
    return found.select(*rows.columns, F.when(F.col("__n") == 1, F.col("__v")).alias("value"), status.alias("status"))


def movement(old: DataFrame, new: DataFrame, group: str) -> DataFrame:
    """Rows of each group before and now: (group, from_n, to_n, delta)."""
    a, b = old.groupBy(group).agg(F.count("*").alias("from_n")), new.groupBy(group).agg(F.count("*").alias("to_n"))
    j = a.join(b, group, "full")
    j = j.select(group, F.coalesce("from_n", F.lit(0)).alias("from_n"), F.coalesce("to_n", F.lit(0)).alias("to_n"))
    return j.withColumn("delta", F.col("to_n") - F.col("from_n"))


def prefer(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union of ``sources`` with, for each key, the row of the first that has it."""
    both = None
    for k, s in enumerate(sources):
        s = s.withColumn("__rank", F.lit(k))
        both = s if both is None else both.unionByName(s, allowMissingColumns=True)
    return first_per_key(both, keys, [F.col("__rank")]).drop("__rank")


def refresh(old: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """``fresh`` and the rows of ``old`` whose key isn't in it."""
    return fresh.unionByName(old.join(fresh.select(key).distinct(), key, "left_anti"))


def carry_forward(previous: DataFrame, today: DataFrame, failed: DataFrame, key: str, group: str) -> DataFrame:
    """Today's rows, and of the groups that failed today the previous rows not collected again, marked ``carried``."""
    kept = previous.join(failed.select(group).distinct(), group, "left_semi").join(today.select(key).distinct(), key, "left_anti")
    return today.withColumn("carried", F.lit(False)).unionByName(kept.withColumn("carried", F.lit(True)))


def changed_fields(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, before, after, change) for fields that differ; change is added, lost or changed."""

    def long(df: DataFrame, name: str) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(name)) for f in fields]))
        return df.select(key, pairs.alias("p")).select(key, "p.field", f"p.{name}")

    j = long(old, "before").join(long(new, "after"), [key, "field"], "full").filter(~F.col("before").eqNullSafe(F.col("after")))
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "lost").otherwise("changed")
    return j.withColumn("change", change)
