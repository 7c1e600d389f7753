"""Whether a paged scan was complete, told from its pages: reasons to stop, verdicts of passes, agreement of two passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.joins import first_per_key


def page_ends(pages: DataFrame, board: str = "board") -> DataFrame:
    """Pages (board, page, asked, keys array, total) with ``fresh``, how many keys no earlier page had, and ``stop``.

    stop: empty, replay (nothing new), short (fewer than asked), total (all
    that is stated was seen), in this order; null where a walk goes on.
    """
    each = pages.select(board, "page", F.explode("keys").alias("key"))
    first = each.groupBy(board, "key").agg(F.min("page").alias("page")).groupBy(board, "page").agg(F.count("*").alias("fresh"))
    p = pages.join(first, [board, "page"], "left").withColumn("fresh", F.coalesce("fresh", F.lit(0).cast("long")))
    seen = F.sum("fresh").over(Window.partitionBy(board).orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    p = p.withColumn("seen", seen)
    n = F.size(F.coalesce("keys", F.array().cast("array<string>")))
    stop = F.when(n == 0, "empty").when(F.col("fresh") == 0, "replay").when(n < F.col("asked"), "short").when(F.col("seen") >= F.col("total"), "total")
    return p.withColumn("stop", stop)


def walked(pages: DataFrame, board: str = "board") -> DataFrame:
    """The pages up to each board's first stop, that one included: what a reader that stops there would have fetched."""
    p = page_ends(pages, board)
    stopped = F.sum(F.when(F.col("stop").isNotNull(), 1).otherwise(0)).over(Window.partitionBy(board).orderBy("page").rowsBetween(Window.unboundedPreceding, -1))
    return p.withColumn("__stopped", F.coalesce(stopped, F.lit(0))).filter("__stopped = 0").drop("__stopped")


def pass_verdicts(pages: DataFrame, budget: int, board: str = "board") -> DataFrame:
    """(board, verdict, rows): failures, replay, unstable (the stated total moved), budget, else complete.

    ``pages`` has failed, a boolean, beside the columns of ``page_ends``.
    """
    p = walked(pages, board)
    g = p.groupBy(board).agg(
        F.bool_or("failed").alias("failed"),
        F.bool_or(F.col("stop") == "replay").alias("replay"),
        F.countDistinct("total").alias("totals"),
        F.max("stop").alias("stop"),
        F.count("*").alias("n"),
        F.sum("fresh").alias("rows"),
    )
    off = lambda c: F.coalesce(F.col(c), F.lit(False))
    verdict = F.when(off("failed"), "failures").when(off("replay"), "replay").when(F.col("totals") > 1, "unstable")
    return g.select(board, verdict.when((F.col("n") >= budget) & F.col("stop").isNull(), "budget").when(F.col("stop").isNull(), "open").otherwise("complete").alias("verdict"), "rows")


def agreed_rows(first: DataFrame, second: DataFrame, board: str, key: str) -> DataFrame:
    """The union of two passes' rows, the first pass's where both have a key, and ``agreed``: whether a board's key sets are the same."""
    a = first.select(board, key).distinct().withColumn("__a", F.lit(1))
    b = second.select(board, key).distinct().withColumn("__b", F.lit(1))
    met = a.join(b, [board, key], "full").groupBy(board).agg(F.bool_and(F.col("__a").isNotNull() & F.col("__b").isNotNull()).alias("agreed"))
    both = first.withColumn("__pass", F.lit(1)).unionByName(second.withColumn("__pass", F.lit(2)))
    return first_per_key(both, [board, key], [F.col("__pass")]).drop("__pass").join(met, board)
