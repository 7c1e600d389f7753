"""Decisions over joined evidence: corporate actions, names and subjects, stored results, gaps, versions, windows of state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tolerances of a stated split, of one that other evidence backs, of share counts, and days after which a mention needs backing.
STATED, BACKED, CONTRADICTED, STALE_DAYS = 0.15, 0.10, 0.25, 75
REPORT_BEFORE, REPORT_AFTER = 45, 15
SESSIONS, TRIES = 262, 3


def classify_moves(moves: DataFrame, stated: DataFrame, counts: DataFrame, reports: DataFrame) -> DataFrame:
    """(symbol, day, class, ratio, reason) of overnight moves (symbol, day, change, shape).

    ``stated`` has split ratios that filings tell (symbol, filed, ratio), the
    first that matches counts; ``counts`` share counts around the day (symbol,
    day, growth); ``reports`` current reports (symbol, filed, kind) of a
    distribution or an exchange. In order: a stated split that share counts
    don't contradict, an old mention only with their backing; a report in the
    window; a move shaped like a split without evidence; else ordinary.
    """
    s = moves.select("symbol", "day", "change").join(stated, "symbol").filter(F.col("filed") <= F.col("day"))
    off = F.abs(F.col("change") * F.col("ratio") - 1)
    s = s.filter(off <= STATED).groupBy("symbol", "day").agg(F.min_by(F.struct("ratio", "filed"), F.struct("filed", "ratio")).alias("s"))
    near = F.datediff("filed", "day").between(-REPORT_BEFORE, REPORT_AFTER)
    r = moves.select("symbol", "day").join(reports, "symbol").filter(near).groupBy("symbol", "day").agg(F.min_by("kind", F.struct("filed", "kind")).alias("report"))
    j = moves.join(s, ["symbol", "day"], "left").join(r, ["symbol", "day"], "left").join(counts, ["symbol", "day"], "left")
    gap = F.abs(F.col("growth") / F.col("s.ratio") - 1)
    old = F.datediff("day", F.col("s.filed")) > STALE_DAYS
    has = F.col("s").isNotNull()
    backed = F.coalesce(gap <= BACKED, F.lit(False))
    against = F.coalesce(gap > CONTRADICTED, F.lit(False))
    split = has & ~against & (~old | backed)
    cls = (
        F.when(has & against, "unresolved").when(split, "split").when(F.col("report").isNotNull(), F.col("report")).when(F.col("shape").isNotNull(), "unresolved")
    )
    reason = (
        F.when(has & against, "share counts contradict").when(split, F.when(old, "old mention, backed").otherwise("stated")).when(F.col("report").isNotNull(), "report").when(F.col("shape").isNotNull(), "shaped like a split")
    )
    return j.select("symbol", "day", cls.alias("class"), F.when(split, F.col("s.ratio")).alias("ratio"), reason.alias("reason"))


def reuse_results(moves: DataFrame, results: DataFrame) -> DataFrame:
    """``moves`` (symbol, day, change, shape) with the stored class of exactly this move, unless that is stale and ordinary."""
    r = results.select("symbol", "day", F.col("change").alias("__c"), F.col("shape").alias("__s"), "class", "stale")
    hit = r.filter(~(F.col("stale") & F.col("class").isNull()))
    same = F.col("shape").eqNullSafe(F.col("__s")) & (F.abs(F.col("change") - F.col("__c")) < 1e-9)
    j = moves.join(hit, ["symbol", "day"], "left")
    return j.select(*moves.columns, F.when(same, F.col("class")).alias("class"), F.coalesce(same, F.lit(False)).alias("reused"))


def choose_subject(filers: DataFrame, reports: DataFrame, most: int = 5) -> DataFrame:
    """(filing, subject): the named subject, else by firm, vehicle, person the first of ``most`` filers with periodic reports.

    ``filers`` has (filing, filer, listed, kind, named), ``reports`` filers that report.
    """
    rank = F.when(F.col("named"), 0).when(F.col("kind") == "firm", 1).when(F.col("kind") == "vehicle", 2).otherwise(3)
    f = filers.withColumn("rank", rank)
    f = f.withColumn("n", F.row_number().over(Window.partitionBy("filing").orderBy("rank", "listed", "filer")))
    known = f.filter(F.col("n") <= most).join(reports.select("filer").distinct().withColumn("__r", F.lit(True)), "filer", "left")
    fit = F.col("named") | F.coalesce("__r", F.lit(False))
    return known.filter(fit).groupBy("filing").agg(F.min_by("filer", "n").alias("subject"))


def resolve_names(rows: DataFrame, explicit: DataFrame, candidates: DataFrame) -> DataFrame:
    """(name, id, how): an explicit match, else the only candidate, else the one of exactly this name, else unresolved.

    ``candidates`` has (name, id, plain): ids proposed for a name with their own names.
    """
    c = candidates.distinct()
    g = c.groupBy("name").agg(F.countDistinct("id").alias("n"), F.min("id").alias("only"), F.array_distinct(F.collect_list(F.when(F.col("plain") == F.col("name"), F.col("id")))).alias("exact"))
    e = explicit.groupBy("name").agg(F.min("id").alias("told"))
    j = rows.select("name").distinct().join(e, "name", "left").join(g, "name", "left")
    one = F.size(F.coalesce("exact", F.array().cast("array<bigint>"))) == 1
    how = F.when(F.col("told").isNotNull(), "explicit").when(F.col("n") == 1, "single").when(one, "name").otherwise("unresolved")
    return j.withColumn("how", how).select("name", F.when(F.col("how") == "explicit", F.col("told")).when(F.col("how") == "single", F.col("only")).when(F.col("how") == "name", F.get("exact", F.lit(0))).alias("id"), "how")


def adopt_orphans(rows: DataFrame, deals: DataFrame) -> DataFrame:
    """``rows`` (accession, subject); one stored under an accession that another deal lists takes that deal's subject.

    ``deals`` has (subject, accessions array); an accession in several deals goes to the least subject.
    """
    listed = deals.select(F.col("subject").alias("__s"), F.explode("accessions").alias("accession")).groupBy("accession").agg(F.min("__s").alias("__s"))
    j = rows.join(listed, "accession", "left")
    moved = F.col("__s").isNotNull() & ~F.col("__s").eqNullSafe(F.col("subject"))
    return j.select(*[F.coalesce("__s", "subject").alias(c) if c == "subject" else F.col(c) for c in rows.columns], moved.alias("moved"))


def fill_gaps(fresh: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """Fresh rows, and for keys without one the last published row, marked ``stand_in``."""
    missing = published.join(fresh.select(key).distinct(), key, "left_anti")
    return fresh.withColumn("stand_in", F.lit(False)).unionByName(missing.withColumn("stand_in", F.lit(True)))


def to_reread(rows: DataFrame, version: int, order: list[Column], most: int) -> DataFrame:
    """Rows that an older reader wrote, in order, at most ``most``."""
    return rows.filter(F.coalesce("reader_version", F.lit(0)) < version).orderBy(*order).limit(most)


def carry_by_versions(previous: DataFrame, now: DataFrame, key: str, versions: list[str]) -> DataFrame:
    """(key, carried): whether the earlier extraction holds: its status is ok and all ``versions`` are the same."""
    p = previous.select(key, F.col("status").alias("__ok"), *[F.col(v).alias(f"__{v}") for v in versions])
    j = now.join(p, key, "left")
    same = F.lit(True)
    for v in versions:
        same = same & (F.col(v) == F.col(f"__{v}"))
    return j.select(key, F.coalesce((F.col("__ok") == "ok") & same, F.lit(False)).alias("carried"))


def prune_lookback(days: DataFrame, calendar: DataFrame, sessions: int = SESSIONS, tries: int = TRIES) -> DataFrame:
    """Days of state (day, attempts, read) within the last ``sessions`` of the calendar, and whether each is to be read: not read yet, with tries left."""
    window = calendar.select("day").distinct().orderBy(F.desc("day")).limit(sessions)
    j = window.join(days, "day", "left")
    due = ~F.coalesce("read", F.lit(False)) & (F.coalesce("attempts", F.lit(0)) < tries)
    return j.select("day", F.coalesce("attempts", F.lit(0)).alias("attempts"), F.coalesce("read", F.lit(False)).alias("read"), due.alias("due"))


def with_unknowns(expected: DataFrame, seen: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """(key, n, status): seen keys with their rows, keys whose source failed unknown with no number, others zero."""
    counts = seen.groupBy(key).agg(F.count("*").alias("__n"))
    j = expected.select(key).distinct().join(counts, key, "left").join(failed.select(key).distinct().withColumn("__f", F.lit(True)), key, "left")
    status = F.when(F.col("__n").isNotNull() & F.col("__f").isNotNull(), "partial").when(F.col("__n").isNotNull(), "seen").when(F.col("__f").isNotNull(), "unknown").otherwise("absent")
    return j.select(key, F.when(status != "unknown", F.coalesce("__n", F.lit(0))).alias("n"), status.alias("status"))


def complete_days(messages: DataFrame, day: str, kind: str, carry: str) -> DataFrame:
    """(day, complete): an open, a close and an end of messages seen, and no bytes carried over."""
    seen = lambda k: F.bool_or(F.col(kind) == k)
    return messages.groupBy(day).agg((seen("open") & seen("close") & seen("end") & (F.max(F.coalesce(F.col(carry), F.lit(0))) == 0)).alias("complete"))


def recent_then_tiers(rows: DataFrame, day: str, tier: str, today: Column, recent: int, key: str) -> DataFrame:
    """Rows with ``place``: those of the last ``recent`` days newest first, then the others by tier and newness."""
    new = F.datediff(today, F.col(day)) <= recent
    order = [F.when(new, 0).otherwise(1), F.when(new, 0).otherwise(F.col(tier)), F.desc(day), F.col(key)]
    # The place is a number within all rows: counted by group first, so no task sees them all.
    group = F.struct(F.when(new, 0).otherwise(F.col(tier) + 1).alias("g"), F.date_trunc("month", F.col(day)).alias("m"))
    marked = rows.withColumn("__g", group)
    sizes = marked.groupBy("__g").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy(F.col("__g.g"), F.desc("__g.m")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a tier and month
    offsets = sizes.withColumn("__before", before).drop("__n")
    within = F.row_number().over(Window.partitionBy("__g").orderBy(*order))
    return marked.join(offsets, "__g").withColumn("place", within + F.col("__before")).drop("__g", "__before")


def share_sums(cover: DataFrame) -> DataFrame:
    """(company, shares): on the latest date, in its latest accession, distinct counts summed."""
    w = Window.partitionBy("company").orderBy(F.desc("as_of"), F.desc("accession"))
    last = cover.withColumn("r", F.rank().over(w)).filter("r = 1")
    return last.groupBy("company").agg(F.sum_distinct("shares").alias("shares"))


def adviser_mentions(mentions: DataFrame, least: int = 2) -> DataFrame:
    """(document, adviser, strong): advisers mentioned ``least`` times; where one is an author, those in a role only go."""
    g = mentions.groupBy("document", "adviser").agg(F.count("*").alias("n"), F.bool_or("author").alias("strong")).filter(F.col("n") >= least)
    any_strong = F.bool_or("strong").over(Window.partitionBy("document"))
    return g.withColumn("__any", any_strong).filter(F.col("strong") | ~F.col("__any")).select("document", "adviser", "strong")


def phrase_sources(phrases: DataFrame, docs: DataFrame) -> DataFrame:
    """(phrase_id, doc_id): the first document that a phrase stands in, none for the others.

    Pairs meet on a phrase's rarest word, then the whole phrase is looked for.
    """
    split = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    posted = docs.select("doc_id", F.explode(split(F.col("text"))).alias("w"))
    df = posted.groupBy("w").agg(F.count("*").alias("df"))
    asked = phrases.select("phrase_id", "phrase", F.explode(split(F.col("phrase"))).alias("w")).join(df, "w", "left")
    rare = asked.groupBy("phrase_id", "phrase").agg(F.min_by("w", F.struct(F.coalesce("df", F.lit(0)), "w")).alias("w"))
    pairs = rare.join(posted, "w").join(docs.select("doc_id", "text"), "doc_id").filter(F.contains("text", F.col("phrase")))
    first = pairs.groupBy("phrase_id").agg(F.min("doc_id").alias("doc_id"))
    return phrases.select("phrase_id").join(first, "phrase_id", "left")
