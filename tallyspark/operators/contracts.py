"""Publication contracts and regression guards as rows of checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.joins import movement

MIN_RATIO, MAX_RATIO, GROUP_FLOOR = 0.6, 2.0, 20
LOSS_ROWS, LOSS_SHARE = 25, 0.05


def count_checks(old: DataFrame, new: DataFrame, least: int, low: float = MIN_RATIO, high: float = MAX_RATIO) -> DataFrame:
    """(name, value, ok): rows now, and their ratio to those before."""
    a, b = old.agg(F.count("*").alias("before")), new.agg(F.count("*").alias("now"))
    c = a.crossJoin(b)  # one row each
    ratio = F.when(F.col("before") > 0, F.col("now") / F.col("before"))
    checks = F.array(
        F.struct(F.lit("least_rows").alias("name"), F.col("now").cast("double").alias("value"), (F.col("now") >= least).alias("ok")),
        F.struct(F.lit("ratio").alias("name"), ratio.alias("value"), F.coalesce(ratio.between(low, high), F.lit(True)).alias("ok")),
    )
    return c.select(F.inline(checks))


def missing_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(name, value, ok) for each required field: rows in which it's null or blank."""
    counts = rows.agg(*[F.count_if(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) == "").alias(f) for f in fields])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(f).alias("name"), F.col(f).alias("value"), (F.col(f) == 0).alias("ok")) for f in fields])).alias("c")).select("c.*")


def collapsed_groups(old: DataFrame, new: DataFrame, group: str, floor: int = GROUP_FLOOR) -> DataFrame:
    """Groups of at least ``floor`` rows that lost half of them."""
    return movement(old, new, group).withColumn("ok", (F.col("from_n") < floor) | (F.col("to_n") * 2 > F.col("from_n")))


def stamp_checks(rows: DataFrame, stamp: str, today: Column, most_days: int) -> DataFrame:
    """(name, value, ok): the days since the newest stamp; without one, or with one in the future, it isn't ok."""
    g = rows.agg(F.datediff(today, F.max(stamp)).cast("double").alias("value"))
    return g.select(F.lit("stamp_age").alias("name"), "value", F.coalesce(F.col("value").between(0, most_days), F.lit(False)).alias("ok"))


def never_shrinks(old: DataFrame, new: DataFrame, group: str) -> DataFrame:
    """(group, from_n, to_n, ok) of each group there was: ok if it has as many rows as before, or more."""
    return movement(old, new, group).filter("from_n > 0").withColumn("ok", F.col("to_n") >= F.col("from_n"))


def immutable_changes(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, change, fields): published rows that are "gone", or "changed" in fields that never may; null to null is no change.

    Rows that are new aren't listed. Fields are comma-joined in the order given.
    """
    b = new.select(key, *[F.col(f).alias(f"__{f}") for f in fields], F.lit(True).alias("__there"))
    j = old.join(b, key, "left")
    differ = F.array_join(F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"__{f}")), F.lit(f)) for f in fields])), ",")
    change = F.when(F.col("__there").isNull(), "gone").when(differ != "", "changed")
    return j.select(key, change.alias("change"), F.when(change == "changed", differ).alias("fields")).filter("change is not null")


def field_losses(old: DataFrame, new: DataFrame, key: str, fields: list[str], rows: int = LOSS_ROWS, share: float = LOSS_SHARE) -> DataFrame:
    """(field, had, lost, refused): filled values of rows in both that are null now; refused from ``rows`` and over ``share``."""
    b = new.select(key, *[F.col(f).alias(f"__{f}") for f in fields])
    j = old.join(b, key)
    parts = [x for f in fields for x in (F.count(f).alias(f"had_{f}"), F.count_if(F.col(f).isNotNull() & F.col(f"__{f}").isNull()).alias(f"lost_{f}"))]
    g = j.agg(*parts)
    s = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"had_{f}").alias("had"), F.col(f"lost_{f}").alias("lost")) for f in fields])).alias("s")
    return g.select(s).select("s.*").withColumn("refused", (F.col("lost") >= rows) & (F.col("lost") > share * F.col("had")))


def protect(old: DataFrame, new: DataFrame, key: str, fields: list[str], version: str) -> DataFrame:
    """``new`` with values that were there before and are null now restored, unless the reader's version advanced."""
    before = old.select(key, *[F.col(f).alias(f"__{f}") for f in fields], F.col(version).alias("__version"))
    j = new.join(before, key, "left")
    advanced = F.coalesce(F.col(version) > F.col("__version"), F.lit(False))
    kept = [F.when(advanced, F.col(f)).otherwise(F.coalesce(f, f"__{f}")).alias(f) if f in fields else F.col(f) for f in new.columns]
    restored = sum((F.when(~advanced & F.col(f).isNull() & F.col(f"__{f}").isNotNull(), 1).otherwise(0) for f in fields), F.lit(0))
    return j.select(*kept, restored.alias("restored"))
