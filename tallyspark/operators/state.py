"""Keyed state kept between runs, as functions of the state before and the new rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import first_per_key

BACKOFF_BASE, BACKOFF_MOST, FORGET_DAYS, RETAIN_DAYS, ARCHIVE_DAYS, HISTORY = 3, 21, 45, 7, 365, 120


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as ``spark.checkpoint.dir`` names it; a temporary one in local runs without."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors see")
    return tempfile.mkdtemp(prefix="tallyspark-")


def backoff(misses: Column, base: int = BACKOFF_BASE, most: int = BACKOFF_MOST) -> Column:
    """Days until the next try: base * 2^(misses - 1), at most ``most``."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), F.least(misses, F.lit(30)) - 1), F.lit(most)).cast("int")


def ledger(state: DataFrame, seen: DataFrame, today: Column, forget: int = FORGET_DAYS) -> DataFrame:
    """Deadlines (id, closing, first_seen, last_seen, misses) after a day's readings (id, closing; null closing is a miss).

    A hit clears the misses and keeps the first day; a miss counts one more;
    entries past their closing or unseen for more than ``forget`` days go.
    """
    now = seen.groupBy("id").agg(F.max("closing").alias("hit"))
    j = state.join(now.withColumn("checked", F.lit(True)), "id", "full")
    hit, checked = F.col("hit").isNotNull(), F.col("checked").isNotNull()
    out = j.select(
        "id",
        F.coalesce("hit", "closing").alias("closing"),
        F.when(hit, F.coalesce("first_seen", today)).otherwise(F.col("first_seen")).alias("first_seen"),
        F.when(hit, today).otherwise(F.col("last_seen")).alias("last_seen"),
        F.when(hit, 0).when(checked, F.coalesce("misses", F.lit(0)) + 1).otherwise(F.coalesce("misses", F.lit(0))).cast("int").alias("misses"),
    )
    alive = F.col("last_seen").isNull() | (F.datediff(today, "last_seen") <= forget)
    return out.filter((F.col("closing").isNull() | (F.col("closing") >= today)) & alive)


def retain(previous: DataFrame, today_rows: DataFrame, failed: DataFrame, key: str, group: str, today: Column, days: int = RETAIN_DAYS) -> DataFrame:
    """Today's keys, and of failed groups the earlier ones confirmed at most ``days`` ago, marked unconfirmed."""
    carried = previous.join(failed.select(group).distinct(), group, "left_semi").join(today_rows.select(key).distinct(), key, "left_anti")
    carried = carried.filter(F.datediff(today, "last_confirmed") <= days)
    fresh = today_rows.withColumn("last_confirmed", today).withColumn("unconfirmed", F.lit(False))
    return fresh.unionByName(carried.select(*today_rows.columns, "last_confirmed").withColumn("unconfirmed", F.lit(True)))


def archive(state: DataFrame, today_rows: DataFrame, key: str, today: Column, days: int = ARCHIVE_DAYS) -> DataFrame:
    """(key, first_seen, last_seen) with today's keys in and those unseen for more than ``days`` out."""
    now = today_rows.select(key, today.alias("first_seen"), today.alias("last_seen"))
    both = state.select(key, "first_seen", "last_seen").unionByName(now)
    g = both.groupBy(key).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
    return g.filter(F.datediff(today, "last_seen") <= days)


def history_ring(state: DataFrame, today_row: DataFrame, most: int = HISTORY) -> DataFrame:
    """Snapshots by day: a day's later one replaces it, the last ``most`` stay."""
    both = state.withColumn("__r", F.lit(1)).unionByName(today_row.withColumn("__r", F.lit(0)))
    one = first_per_key(both, ["day"], [F.col("__r")]).drop("__r")
    return one.orderBy(F.desc("day")).limit(most)


def register(registry: DataFrame, rows: DataFrame, item: str, slug: str) -> DataFrame:
    """Known ids keep their slug for good; a new id gets its own if no id, now or ever, has it, else with its id's end."""
    new = rows.join(registry.select(item), item, "left_anti")
    taken = registry.select(F.col(slug).alias("__taken")).distinct()
    ranked = new.withColumn("__n", F.row_number().over(Window.partitionBy(slug).orderBy(item)))
    j = ranked.join(taken, ranked[slug] == taken["__taken"], "left")
    clash = F.col("__taken").isNotNull() | (F.col("__n") > 1)
    named = j.select(item, F.when(clash, F.concat_ws("-", slug, F.col(item).cast("string"))).otherwise(F.col(slug)).alias(slug))
    return registry.select(item, slug).unionByName(named)


def absence_spells(presence: DataFrame, key: str, day: str) -> DataFrame:
    """Spells of each key's presence by day number, and how often it was back after an absence: gaps and islands."""
    p = presence.select(key, F.col(day).alias("__d")).distinct()
    w = Window.partitionBy(key).orderBy("__d")
    p = p.withColumn("__back", F.when(F.col("__d") - F.lag("__d").over(w) > 1, 1).otherwise(0))
    return p.groupBy(key).agg(F.min("__d").alias("first_day"), F.max("__d").alias("last_day"), F.count("*").alias("days"), F.sum("__back").alias("returns"))


def freshness(age_hours: Column, cadence_hours: Column, failed: Column) -> Column:
    """fresh within the cadence; degraded if the last try failed; not-due within 1.5 of it; else stale."""
    return F.when(age_hours <= cadence_hours, "fresh").when(failed, "degraded").when(age_hours <= 1.5 * cadence_hours, "not-due").otherwise("stale")


def transitions(rows: DataFrame, key: str, order: str, state: str, silent: str) -> DataFrame:
    """Each meaningful state with the meaningful one before it: silence neither changes nor becomes the baseline."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(F.col(state) != silent, F.col(state)), ignorenulls=True).over(w)
    out = rows.withColumn("before", before)
    kind = F.when(F.col(state) == silent, "silent").when(F.col("before").isNull(), "first").when(F.col("before") == F.col(state), "same").otherwise("changed")
    return out.withColumn("kind", kind)


def legal(transitions_seen: DataFrame, allowed: DataFrame) -> DataFrame:
    """Transitions (from_state, to_state) that no row of ``allowed`` permits."""
    return transitions_seen.join(allowed, ["from_state", "to_state"], "left_anti")


def changed_signatures(old: DataFrame, new: DataFrame, key: str, quarter: str) -> DataFrame:
    """(key, quarter) to recompute: those whose signature changed or is new, and each one's next quarter if it's there."""
    j = new.join(old.select(key, quarter, F.col("signature").alias("__old")), [key, quarter], "left")
    changed = j.filter(~F.col("signature").eqNullSafe(F.col("__old"))).select(key, quarter)
    follow = changed.select(key, (F.col(quarter) + 1).alias(quarter)).join(new.select(key, quarter), [key, quarter], "left_semi")
    return changed.unionByName(follow).distinct()
