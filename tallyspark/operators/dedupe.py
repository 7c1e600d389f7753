"""Duplicate groups, collapse with a stated survivor, near-duplicates of titles, interval merge, anchored groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.explorer import keeper
from tallyspark.operators.joins import first_per_key
from tallyspark.operators.state import checkpoint_folder

#: Link, title and time rules of near-duplicates of dated items.
DAYS_APART, ALIKE, ALIKE_WITH_NAMES, SHARED_NAMES = 2, 0.6, 0.2, 2
#: Items of one title and day that are written out as pairs at once with so many others.
MEMBERS = 256
#: Words too common to pair items by.
COMMON_WORDS = frozenset("the of and to in a is that for it on with as by at from this are or an".split())


def first_wins(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return first_per_key(rows, keys, order)


def duplicate_groups(rows: DataFrame, key: str, item: str) -> DataFrame:
    """(key, n, first): keys with more than one row; the least item of each stands for it."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(item).alias("first")).filter("n > 1")


def dropped_in_any(rows: DataFrame, keys: list[list[str]], order: list[Column], item: str) -> DataFrame:
    """Rows that survive every key's collapse: a row that loses under any key goes."""
    lost = None
    for key in keys:
        rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        losers = rows.withColumn("__n", rank).filter("__n > 1").select(item)
        lost = losers if lost is None else lost.unionByName(losers)
    return rows.join(lost.distinct(), item, "left_anti")


def merge_provenance(rows: DataFrame, key: str, source: str, rank: str) -> DataFrame:
    """One row a key: the source of least rank owns it, the others are listed in order."""
    g = rows.groupBy(key).agg(F.min_by(source, F.struct(rank, source)).alias("owner"), F.array_sort(F.collect_set(source)).alias("__all"))
    return g.select(key, "owner", F.array_join(F.array_remove("__all", F.col("owner")), ",").alias("also"))


def repeats(rows: DataFrame, key: list[str], order: list[Column], item: str) -> DataFrame:
    """Each row with the first item of its key, null for that one itself."""
    w = Window.partitionBy(*key).orderBy(*order)
    first = F.first_value(item).over(w)
    return rows.withColumn("repeats", F.when(first != F.col(item), first))


def merge_spans(spans: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Touching or overlapping spans (start <= reach + 1) of a key merged, with how many went in."""
    own = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(own.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("__new", F.when(F.col(start) <= reach + 1, 0).otherwise(1))
    marked = marked.withColumn("__g", F.sum("__new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "__g").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("__g")


def same_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: how many keys each side has alone, and whether the two agree."""
    j = a.select(key).distinct().withColumn("__a", F.lit(1)).join(b.select(key).distinct().withColumn("__b", F.lit(1)), key, "full")
    g = j.agg(F.sum(F.when(F.col("__b").isNull(), 1).otherwise(0)).alias("only_left"), F.sum(F.when(F.col("__a").isNull(), 1).otherwise(0)).alias("only_right"))
    return g.withColumn("agree", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def words(title: Column) -> Column:
    """Distinct lower-case words of three letters and more, common ones left out."""
    every = F.regexp_extract_all(F.lower(title), F.lit(r"([\p{L}\p{N}]{3,})"))
    return F.array_distinct(F.filter(every, lambda w: ~w.isin(*sorted(COMMON_WORDS))))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def word_sets(items: DataFrame, item: str, title: str, day: str) -> DataFrame:
    """(id, set, d): items with a word, an id and a day; ``set`` is a title's words in order, d the day's number."""
    i = items.select(F.col(item).alias("id"), F.array_join(F.array_sort(words(F.col(title))), " ").alias("set"), F.unix_date(F.col(day).cast("date")).alias("d"))
    return i.filter("id IS NOT NULL AND set <> '' AND d IS NOT NULL").distinct()


def alike_sets(sets: DataFrame) -> DataFrame:
    """Pairs (x, y, similarity) of different word sets (set) at least 0.6 alike, each once.

    Words are put in one order, rare ones first. Sets of p and q words that are alike
    share at least t = 0.6 / 1.6 * (p + q), so the first that they share is among the first p - t + 1
    and q - t + 1 of them, with t - 1 after it: they meet on that word and on their
    sizes, and only there. What meets is weighed at once; none is left out.
    """
    each = sets.select("set", F.explode(F.split("set", " ")).alias("word"))
    counts = each.groupBy("word").agg(F.count("*").alias("n"))
    w = F.transform(F.array_sort(F.collect_list(F.struct("n", "word"))), lambda x: x["word"])
    ordered = each.join(counts, "word").groupBy("set").agg(w.alias("w")).withColumn("p", F.size("w"))
    # In whole numbers: t = ceil(3 (p + q) / 8); the smaller of two alike sets has three fifths of the larger's words at least.
    shared = lambda p, q: F.expr(f"int((3 * ({p} + {q}) + 7) div 8)")
    small = ordered.withColumn("q", F.explode(F.expr("sequence(p, int(5 * p div 3))")))
    small = small.select("p", "q", F.col("w").alias("wx"), F.posexplode(F.slice("w", F.lit(1), F.col("p") - shared("p", "q") + 1)).alias("i", "word"))
    large = ordered.select(F.col("p").alias("q"), F.col("w").alias("wy"), F.posexplode(F.slice("w", F.lit(1), F.col("p") - shared("p", "int((3 * p + 4) div 5)") + 1)).alias("j", "word"))
    j = small.join(large, ["word", "q"]).filter((F.least(F.col("p") - F.col("i"), F.col("q") - F.col("j")) >= shared("p", "q")) & ((F.col("p") < F.col("q")) | (F.col("wx") < F.col("wy"))))
    j = j.withColumn("both", F.array_intersect("wx", "wy")).filter((F.size("both") >= shared("p", "q")) & (F.element_at("both", 1) == F.col("word")))
    plain = lambda c: F.array_join(F.array_sort(c), " ")
    j = j.withColumn("similarity", F.size("both") / (F.col("p") + F.col("q") - F.size("both"))).filter(F.col("similarity") >= ALIKE)
    return j.select(plain("wx").alias("x"), plain("wy").alias("y"), "similarity")


def alike_pairs(items: DataFrame, item: str, title: str, day: str, block: int = MEMBERS) -> DataFrame:
    """Pairs (a, b, similarity) of items at most two days apart with similar titles.

    Only different word sets are compared. The items of a set and day are dealt
    into blocks, and each pair of blocks of alike sets (a set and itself
    too) is a row that is written out as pairs in place: what many items share is no
    key with their square in one task.
    """
    spark = items.sparkSession
    i = keeper(spark, checkpoint_folder(spark).rstrip("/"))(word_sets(items, item, title, day), "titles")
    each = i.withColumn("k", F.floor(F.row_number().over(Window.partitionBy("set", "d").orderBy("id")) / block))
    each = each.groupBy("set", "d", "k").agg(F.collect_list("id").alias("ids"))
    alike = alike_sets(i.select("set").distinct())
    own = i.select(F.col("set").alias("x"), F.col("set").alias("y"), F.lit(1.0).alias("similarity")).distinct()
    one = each.select(F.col("set").alias("x"), F.col("d").alias("dx"), F.col("k").alias("kx"), F.col("ids").alias("ix"))
    two = each.select(F.col("set").alias("y"), F.col("d").alias("dy"), F.col("k").alias("ky"), F.col("ids").alias("iy"))
    met = alike.unionByName(own).join(one, "x").join(two, "y").filter(F.abs(F.col("dx") - F.col("dy")) <= DAYS_APART)
    once = (F.col("x") != F.col("y")) | (F.struct("dx", "kx") <= F.struct("dy", "ky"))
    same = (F.col("x") == F.col("y")) & (F.col("dx") == F.col("dy")) & (F.col("kx") == F.col("ky"))
    # A few rows can stand for most pairs: they are dealt out by their number, not their size.
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = met.filter(once).repartition(spread, "x", "dx", "kx", "y", "dy", "ky").select("ix", "iy", "similarity", same.alias("same"))
    out = met.select(F.explode("ix").alias("s"), "iy", "similarity", "same").select("s", F.explode("iy").alias("t"), "similarity", "same")
    out = out.filter((F.col("s") < F.col("t")) | ((F.col("s") > F.col("t")) & ~F.col("same")))
    return out.select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b"), "similarity")


def names(title: Column) -> Column:
    """Distinct capitalised words of three letters and more."""
    return F.array_distinct(F.regexp_extract_all(title, F.lit(r"(?:^|[^\p{L}\p{N}])(\p{Lu}[\p{L}\p{N}]{2,})"), 1))


def near_duplicate_pairs(items: DataFrame, item: str, title: str, day: str, link: str) -> DataFrame:
    """(a, b, rule) of near-duplicates: the same link, the same title, or alike within two days.

    Alike are titles with a similarity of at least 0.6, or of 0.2 with two names
    in common. Items of one link, or of one title, pair with the first of them
    only. Titles alike are paired once a title and day, by the first item;
    pairs of names meet by equality on two names and a bucket of days.
    """
    rows = items.select(F.col(item).alias("id"), F.col(title).alias("title"), F.unix_date(F.col(day).cast("date")).alias("d"), F.col(link).alias("link"))
    rows = rows.withColumn("plain", F.array_join(F.array_sort(words(F.col("title"))), " "))

    def same(key: str, rule: str) -> DataFrame:
        known = rows.filter(F.col(key).isNotNull() & (F.col(key) != ""))
        first = known.groupBy(key).agg(F.min("id").alias("a"))
        return known.join(first, key).filter("id != a").select("a", F.col("id").alias("b"), F.lit(rule).alias("rule"))

    one = rows.groupBy("plain", "d").agg(F.min_by(F.struct("id", "title"), "id").alias("x")).select("x.*", "d")
    dated = one.withColumn("day", F.date_from_unix_date("d"))
    alike = alike_pairs(dated, "id", "title", "day").select("a", "b", F.lit("alike").alias("rule"))
    named = one.select("id", "d", words(F.col("title")).alias("w"), F.array_sort(names(F.col("title"))).alias("n")).filter(F.size("n") >= SHARED_NAMES)
    two = F.flatten(F.transform("n", lambda x, i: F.transform(F.slice(F.col("n"), i + 2, F.size("n")), lambda y: F.concat_ws(" ", x, y))))
    posted = named.withColumn("two", F.explode(two))
    bucket = F.floor(F.col("d") / 3)
    left = posted.select("two", F.col("id").alias("a"), F.col("w").alias("wa"), F.col("d").alias("da"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("b3"))
    right = posted.select("two", F.col("id").alias("b"), F.col("w").alias("wb"), F.col("d").alias("db"), bucket.alias("b3"))
    j = left.join(right, ["two", "b3"]).filter((F.col("a") < F.col("b")) & (F.abs(F.col("da") - F.col("db")) <= DAYS_APART))
    j = j.dropDuplicates(["a", "b"]).filter(jaccard(F.col("wa"), F.col("wb")) >= ALIKE_WITH_NAMES).select("a", "b", F.lit("names").alias("rule"))
    every = same("link", "link").unionByName(same("plain", "title")).unionByName(alike).unionByName(j)
    order = F.when(F.col("rule") == "link", 0).when(F.col("rule") == "title", 1).when(F.col("rule") == "alike", 2).otherwise(3)
    return every.groupBy("a", "b").agg(F.min_by("rule", order).alias("rule"))


def keep_first_alike(items: DataFrame, pairs: DataFrame, item: str) -> DataFrame:
    """Greedy choice in order of ``item``: an item goes if a kept, earlier one is alike.

    Each round settles items with no earlier undecided partner, as the fold in
    order would; the rounds are as many as the longest chain of decisions, and
    go on until nothing is open. A round's state is checkpointed, so plans stay
    small whatever the number of rounds. Items in no pair stay.
    """
    spark = items.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))
    edges = pairs.select("a", "b").filter("a < b").distinct().checkpoint()
    gone = edges.select(F.col("b").alias("id")).limit(0)
    while True:
        # Open edges: neither end is decided; an item with no earlier open partner stays, and its later ones go.
        heads = edges.select(F.col("a").alias("id")).distinct().join(edges.select(F.col("b").alias("id")).distinct(), "id", "left_anti")
        hit = edges.join(heads.withColumnRenamed("id", "a"), "a", "left_semi").select(F.col("b").alias("id")).distinct().checkpoint()
        if not hit.take(1):
            break
        gone = gone.unionByName(hit).checkpoint()
        edges = edges.join(hit.withColumnRenamed("id", "a"), "a", "left_anti").join(hit.withColumnRenamed("id", "b"), "b", "left_anti").checkpoint()
    return items.join(gone.withColumnRenamed("id", item), item, "left_anti")


def keep_first_titles(items: DataFrame, item: str, title: str) -> DataFrame:
    """Greedy choice in order of ``item``: an item goes if a kept, earlier one has a similar title; those without a word stay.

    Items of the same words as an earlier one always go: it is kept, or what it
    went for is like them too. So only the first of each word set is compared.
    """
    spark = items.sparkSession
    keep = keeper(spark, checkpoint_folder(spark).rstrip("/"))
    i = keep(word_sets(items.withColumn("__day", F.current_date()), item, title, "__day"), "titles")
    first = keep(i.groupBy("set").agg(F.min("id").alias("first")), "firsts")
    pairs = alike_sets(first.select("set")).join(first.select(F.col("set").alias("x"), F.col("first").alias("s")), "x").join(first.select(F.col("set").alias("y"), F.col("first").alias("t")), "y")
    later = i.join(first, "set").filter("id <> first").select(F.col("id").alias(item)).distinct()
    firsts = keep_first_alike(first.select("first"), pairs.select(F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b")), "first")
    gone = first.join(firsts, "first", "left_anti").select(F.col("first").alias(item)).unionByName(later).distinct()
    return items.join(gone, item, "left_anti")


def anchored_groups(rows: DataFrame, key: str, day: str, days: int) -> DataFrame:
    """Rows with ``group``: a row more than ``days`` after the FIRST of its group starts a new one.

    The anchor depends on all rows before it, so it's a fold: one key's days are
    folded in sorted order with ``aggregate``, whose state is the anchors.
    """
    dates = rows.groupBy(key).agg(F.array_sort(F.collect_set(F.col(day).cast("date"))).alias("__days"))
    anchors = F.aggregate(
        "__days",
        F.array().cast("array<date>"),
        lambda acc, d: F.when((F.size(acc) == 0) | (F.datediff(d, F.element_at(acc, -1)) > days), F.concat(acc, F.array(d))).otherwise(acc),
    )
    folded = dates.select(key, anchors.alias("__anchors"))
    j = rows.join(folded, key)
    return j.withColumn("group", F.size(F.filter("__anchors", lambda a: a <= F.col(day).cast("date")))).drop("__anchors")


def fold_first_fit(ordered: Column, fits: Callable[[Column, Column], Column], members: str) -> Column:
    """Groups of an array's elements: in order, each joins the first group all of whose members it fits, or starts one.

    ``ordered`` is an array of structs and ``members`` its type; the result is an array of arrays of them.
    """

    def place(groups: Column, one: Column) -> Column:
        open_to = F.array_position(F.transform(groups, lambda g: F.forall(g, lambda member: F.coalesce(fits(one, member), F.lit(False)))), True)
        joined = F.transform(groups, lambda g, k: F.when(k == open_to - 1, F.array_append(g, one)).otherwise(g))
        return F.when(open_to > 0, joined).otherwise(F.array_append(groups, F.array(one)))

    return F.aggregate(ordered, F.array().cast(f"array<{members}>"), place)


def first_fit_groups(rows: DataFrame, key: str, item: str, at: str, apart: int) -> DataFrame:
    """Incremental grouping: in order, a row joins the first group of its key whose every member is within ``apart`` of it.

    No group spans a gap of more than ``apart``, so each stretch between such
    gaps is folded by itself and its groups are numbered on from those before: a
    task holds a stretch, not a key.
    """
    own = Window.partitionBy(key).orderBy(at, item)
    parted = rows.select(key, item, at).withColumn("new", F.when(F.col(at) - F.lag(at).over(own) <= apart, 0).otherwise(1))
    parted = parted.withColumn("stretch", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0))).drop("new")
    member = F.struct(F.col(at).alias("at"), F.col(item).alias("item"))
    kind = parted.select(F.array(member).alias("a")).schema["a"].dataType.simpleString()
    folded = parted.groupBy(key, "stretch").agg(F.array_sort(F.collect_list(member)).alias("rows"))
    folded = folded.select(key, "stretch", fold_first_fit(F.col("rows"), lambda a, b: F.abs(a["at"] - b["at"]) <= apart, kind).alias("groups"))
    earlier = Window.partitionBy(key).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    folded = folded.withColumn("before", F.coalesce(F.sum(F.size("groups")).over(earlier), F.lit(0)))
    each = folded.select(key, "before", F.posexplode("groups").alias("g", "members"))
    return each.select(key, (F.col("g") + F.col("before")).cast("int").alias("group"), F.explode("members").alias("m")).select(key, F.col("m.item").alias(item), "group")


def unique_slugs(rows: DataFrame, item: str, base: str, region: str) -> DataFrame:
    """(item, slug): the first item of a base gets it, the next of each region base-region, later ones a counter from 2."""
    r = rows.select(item, base, region).withColumn("__first", F.row_number().over(Window.partitionBy(base).orderBy(item)) == 1)
    r = r.withColumn("__k", F.row_number().over(Window.partitionBy(base, region, "__first").orderBy(item)))
    named = F.concat_ws("-", base, region, F.when(F.col("__k") > 1, F.col("__k").cast("string")))
    return r.select(item, F.when(F.col("__first"), F.col(base)).otherwise(named).alias("slug"))
