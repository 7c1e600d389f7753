"""Matches with a stated precedence: both sides of a date, spans, several keys, contained names, overrides, amendments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import first_per_key

CAMPAIGN_DAYS = 45


def both_sides(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """``left`` with the last value of its key at or before its time, and the first one after.

    Both sides go through one sort by key and time instead of a range join;
    ``right`` has one row a key and time.
    """
    columns = left.columns
    a = left.select(F.col(key).alias("__k"), F.col(at).alias("__at"), F.lit(1).alias("__side"), F.struct(*columns).alias("__row"), F.lit(None).cast(right.schema[value].dataType).alias("__v"))
    b = right.select(F.col(key).alias("__k"), F.col(at).alias("__at"), F.lit(0).alias("__side"), F.lit(None).cast(left.select(F.struct(*columns).alias("r")).schema["r"].dataType).alias("__row"), F.col(value).alias("__v"))
    own = Window.partitionBy("__k").orderBy("__at", "__side")
    both = a.unionByName(b)
    before = F.last("__v", ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("__v", ignorenulls=True).over(own.rowsBetween(1, Window.unboundedFollowing))
    told = both.select("__side", "__row", before.alias("before"), after.alias("after")).filter("__side = 1")
    return told.select(*[F.col("__row")[c].alias(c) for c in columns], "before", "after")


def absorbed(groups: DataFrame, matters: DataFrame, key: str, group: str, matter: str, days: int = CAMPAIGN_DAYS) -> DataFrame:
    """(key, group, matter): the first matter of the key whose span, ``days`` wider on both ends, holds the whole group; else null.

    Both have first_day and last_day.
    """
    m = matters.select(F.col(key).alias("__k"), F.col(matter), F.date_sub("first_day", days).alias("__from"), F.date_add("last_day", days).alias("__to"))
    inside = (groups[key] == m["__k"]) & (groups["first_day"] >= m["__from"]) & (groups["last_day"] <= m["__to"])
    return groups.join(m, inside, "left").groupBy(groups[key], groups[group]).agg(F.min(matter).alias(matter))


def first_key_match(rows: DataFrame, index: DataFrame, keys: list[str], item: str) -> DataFrame:
    """``rows`` with the least ``item`` of ``index`` found by the first of ``keys`` that finds any, and that key's name."""
    out = rows
    for k in keys:
        found = index.filter(F.col(k).isNotNull()).groupBy(F.col(k).alias(f"__{k}")).agg(F.min(item).alias(f"__by_{k}"))
        out = out.join(found, out[k] == found[f"__{k}"], "left").drop(f"__{k}")
    matched = F.coalesce(*[F.col(f"__by_{k}") for k in keys])
    name = F.coalesce(*[F.when(F.col(f"__by_{k}").isNotNull(), F.lit(k)) for k in keys])
    return out.withColumn("matched", matched).withColumn("matched_by", name).drop(*[f"__by_{k}" for k in keys])


def _runs(words: Column, most: Column) -> Column:
    """All runs of at most ``most`` consecutive words, space-joined."""
    size = F.size(words)
    starts = F.sequence(F.lit(1), size)
    each = F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.least(size - i + 1, most)), lambda n: F.array_join(F.slice(words, i, n), " ")))
    return F.array_distinct(F.flatten(each))


def contained_names(rows: DataFrame, name: str, table: DataFrame, value: str) -> DataFrame:
    """(name, value, how): table rows (name, value) met exactly, else in lower case, else as whole words within one another.

    A stage that gives two values is ambiguous and gives none, and ends the
    search. Containment is an equality of one name with a run of the other's
    words, so there's no nested loop; runs have at most as many words as the
    longest name of the other side, however long the name is itself.
    """
    left = rows.select(F.col(name).alias("__name")).distinct()
    right = table.select(F.col(name).alias("__t"), F.col(value).alias("__v"))
    lower = lambda c: F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))
    l2, r2 = left.withColumn("__l", lower(F.col("__name"))), right.withColumn("__r", lower(F.col("__t")))
    exact = left.join(right, left["__name"] == right["__t"]).select("__name", "__v", F.lit(0).alias("__how"))
    folded = l2.join(r2, l2["__l"] == r2["__r"]).select("__name", "__v", F.lit(1).alias("__how"))
    n_words = lambda c: F.size(F.split(c, " "))
    l_most, r_most = l2.agg(F.greatest(F.max(n_words(F.col("__l"))), F.lit(1)).alias("__most")), r2.agg(F.greatest(F.max(n_words(F.col("__r"))), F.lit(1)).alias("__most"))
    l_runs = l2.crossJoin(F.broadcast(r_most)).select("__name", F.explode(_runs(F.split("__l", " "), F.col("__most"))).alias("__run"))
    r_runs = r2.crossJoin(F.broadcast(l_most)).select("__v", F.explode(_runs(F.split("__r", " "), F.col("__most"))).alias("__run"))
    inner = l_runs.join(r2, l_runs["__run"] == r2["__r"]).select("__name", "__v", F.lit(2).alias("__how"))
    outer = l2.join(r_runs, l2["__l"] == r_runs["__run"]).select("__name", "__v", F.lit(2).alias("__how"))
    every = exact.unionByName(folded).unionByName(inner).unionByName(outer)
    stages = every.groupBy("__name", "__how").agg(F.countDistinct("__v").alias("n"), F.min("__v").alias("v"))
    first = first_per_key(stages, ["__name"], [F.col("__how")])
    how = F.when(F.col("__how") == 0, "exact").when(F.col("__how") == 1, "folded").when(F.col("__how") == 2, "contained")
    return left.join(first, "__name", "left").select(F.col("__name").alias(name), F.when(F.col("n") == 1, F.col("v")).alias(value), how.alias("how"))


def overridden(rows: DataFrame, overrides: DataFrame, item: str, group: str, text: str, value: str) -> DataFrame:
    """``rows`` with ``value`` from the last override (by seq) that names the item, or its group and a part of its text.

    ``overrides``: seq, item, group, part, value; one with an item applies to
    that alone, one without a part to all of the group.
    """
    o = overrides.select("seq", F.col(item).alias("__i"), F.col(group).alias("__g"), "part", F.col(value).alias("__v"))
    r = rows.select(item, group, text)
    by_item = r.join(o.filter(F.col("__i").isNotNull()), r[item] == F.col("__i")).select(item, "seq", "__v")
    by_group = r.join(o.filter(F.col("__i").isNull()), r[group] == F.col("__g"))
    by_group = by_group.filter(F.col("part").isNull() | F.lower(F.col(text)).contains(F.lower("part"))).select(item, "seq", "__v")
    last = by_item.unionByName(by_group).groupBy(item).agg(F.max_by("__v", "seq").alias("__new"))
    return rows.join(last, item, "left").withColumn(value, F.coalesce("__new", value)).drop("__new")


def in_force(filings: DataFrame, keys: list[str]) -> DataFrame:
    """Filings (kind, filed, accession) that count for their keys: the latest full one and additions after it.

    A full one is an original or a restatement, by (filed, accession); an
    addition without a full one before it doesn't count.
    """
    at = F.struct("filed", "accession")
    own = Window.partitionBy(*keys)
    base = F.max(F.when(F.col("kind") != "addition", at)).over(own)
    return filings.withColumn("__base", base).filter(((F.col("kind") == "addition") & (at > F.col("__base"))) | ((F.col("kind") != "addition") & (at == F.col("__base")))).drop("__base")


def filer_changes(rows: DataFrame, key: str, period: str, filer: str, amount: str) -> DataFrame:
    """Adjacent periods of a key under different filers: (key, period, old filer, filer, ratio of amounts)."""
    own = Window.partitionBy(key).orderBy(period)
    r = rows.withColumns({"__p": F.lag(period).over(own), "before": F.lag(filer).over(own), "__a": F.lag(amount).over(own)})
    r = r.filter((F.col(period) == F.col("__p") + 1) & (F.col(filer) != F.col("before")))
    return r.select(key, period, "before", filer, F.when(F.col("__a") != 0, F.col(amount) / F.col("__a")).alias("ratio"))
