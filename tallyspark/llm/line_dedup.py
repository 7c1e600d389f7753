"""Line dedup over overlapping windows of three lines, with built-in functions only.

Every window of consecutive lines has a 128-bit hash. Windows that occur again,
in any text, are found by an aggregate; each occurrence after the first covers
its three lines, covered lines are merged and left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import saved

WINDOW = 3


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """(h1, h2, doc, text_hash, pos): a row for each window; h1 and h2 are two independent hashes of its lines."""
    d = docs.select("__doc", "__text_hash", F.split("__text", "\n").alias("lines"))
    d = d.filter(F.size("lines") >= window)
    d = d.select(
        "__doc",
        "__text_hash",
        F.transform("lines", lambda x: F.xxhash64(x)).alias("a"),
        F.transform("lines", lambda x: F.xxhash64(F.lit(1), x)).alias("b"),
    )

    def mixed(name: str, i):
        return F.xxhash64(*[F.get(F.col(name), i + j) for j in range(window)])

    each = F.transform(
        F.sequence(F.lit(0), F.size("a") - window),
        lambda i: F.struct(mixed("a", i).alias("h1"), mixed("b", i).alias("h2"), i.alias("pos")),
    )
    d = d.select("__doc", "__text_hash", F.explode(each).alias("w"))
    return d.select("w.h1", "w.h2", "__doc", "__text_hash", "w.pos")


def covered_starts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(__doc, __text_hash, starts): the sorted places at which a later occurrence of a window starts."""
    base = docs.select(F.col(doc_id).alias("__doc"), F.col(text).cast("string").alias("__text"))
    base = base.filter(F.col("__text").isNotNull()).withColumn("__text_hash", F.xxhash64("__text"))
    place = F.struct("__doc", "__text_hash", "pos")
    windows = _windows(base, window)
    # A window with a third of all occurrences is one row a task after the map-side part.
    repeated = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    # Written once: the join below then has a shuffle of its own on both sides, which adaptive execution can split.
    repeated = saved(repeated.select("h1", "h2", "first"), "windows")
    later = windows.join(repeated, ["h1", "h2"]).filter(~place.eqNullSafe(F.col("first")))
    return later.groupBy("__doc", "__text_hash").agg(F.array_sort(F.collect_set("pos")).alias("starts"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated windows' lines left out of ``text``, and ``n_lines`` and ``n_removed`` added.

    The first occurrence, by id, then by a hash of the text, then by place,
    stays; null ids come first. Lines are compared as they are, parted by line
    feeds. A later occurrence covers its lines even where it overlaps the first
    one, so a run of one line shrinks to a single one. A text of fewer lines than a window never changes; a null text stays
    null with no lines; a text all of whose lines are covered becomes empty.
    Rows that repeat an id and its text are one document and get the same
    result each; ids are of any type with an order. All other columns stay; ones named n_lines or n_removed are
    replaced. An empty table gives an empty result.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    starts = covered_starts(docs, doc_id, text, window)
    starts = starts.select(
        F.coalesce(F.col("__doc").cast("string"), F.lit("")).alias("__k"), F.col("__doc").isNull().alias("__m"), F.col("__text_hash").alias("__h"), "starts"
    )
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"), F.col(doc_id).alias("__doc"), F.col(text).cast("string").alias("__text"))
    row = row.select(
        "__row",
        "__text",
        F.coalesce(F.col("__doc").cast("string"), F.lit("")).alias("__k"),
        F.col("__doc").isNull().alias("__m"),
        F.xxhash64("__text").alias("__h"),
    )
    met = row.join(starts, ["__k", "__m", "__h"], "left")
    met = met.select("__row", "__text", "starts", F.split("__text", "\n").alias("__lines"))
    # What stays is what lies between merged covers: from the end of one start's window to the next start.
    spans = F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform("starts", lambda p: p + window)),
        F.concat(F.col("starts"), F.array(F.size("__lines"))),
        lambda a, b: F.struct(a.alias("a"), F.greatest(b - a, F.lit(0)).alias("n")),
    )
    met = met.withColumn("__spans", F.when(F.col("starts").isNotNull(), F.filter(spans, lambda x: x["n"] > 0)))
    stay = F.flatten(F.transform("__spans", lambda x: F.slice(F.col("__lines"), x["a"] + 1, x["n"])))
    size = F.coalesce(F.size("__lines"), F.lit(0))
    n_lines = F.when(F.col("__text").isNull(), 0).otherwise(size).cast("long")
    kept = F.aggregate("__spans", F.lit(0), lambda t, x: t + x["n"])
    removed = F.when(F.col("starts").isNull(), 0).otherwise(size - kept).cast("long")
    met = met.select("__row", F.when(F.col("starts").isNull(), F.col("__text")).otherwise(F.array_join(stay, "\n")).alias("__new"), n_lines.alias("n_lines"), removed.alias("n_removed"))
    return met.select(*[F.col("__new").alias(c) if c == text else F.col("__row")[c].alias(c) for c in columns], "n_lines", "n_removed")
