"""Amendments of a period's filing, merged by what they hold: added to the book, or taken in its place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.matching import in_force

#: A repeated table: this share of its value stands on lines of unchanged shares; or it has this share of the book's value and
#: lines, and stands by that share on lines the book knows.
SAME_SHARES, KNOWN, BY_VALUE, BY_LINES = 0.5, 0.5, 0.9, 0.5
PERIOD = ("manager", "q")


def amendment_steps(filings: DataFrame) -> DataFrame:
    """Filings (manager, q, accession, filed, kind) in force, numbered: 0 the full one, then its additions by (filed, accession)."""
    order = Window.partitionBy(*PERIOD).orderBy(F.col("kind") == "addition", "filed", "accession")
    return in_force(filings, list(PERIOD)).withColumn("step", F.row_number().over(order) - 1)


def merged_books(filings: DataFrame, lines: DataFrame) -> DataFrame:
    """(manager, q, security, class, value, shares, outcomes): each period's book after all its amendments.

    ``lines`` is (accession, security, class, value, shares). Additions come in the order filed; each one either joins
    the book as it stands, summed where security and class are known, or - a whole
    table under the wrong label - takes its place. ``outcomes`` says which, in
    order: "appended" or "replaced", comma-joined. Classes are told without case;
    a filing's lines of one security and class are summed first. Periods without
    a full filing have no book, and so has a filing without lines.

    Every step is a column over the same windows by period, so lines are shuffled
    twice in all, however many amendments there are.
    """
    steps = amendment_steps(filings).select(*PERIOD, "accession", "step")
    most = steps.agg(F.max("step")).first()[0] or 0
    key = ["security", "class"]
    each = steps.join(lines.withColumn("class", F.upper("class")), "accession")
    at = lambda c, k: F.sum(F.when(F.col("step") == k, F.col(c)))
    cells = {f"{c[0]}{k}": at(c, k) for k in range(most + 1) for c in ("value", "shares")}
    book = each.groupBy(*PERIOD, *key).agg(*[c.alias(n) for n, c in cells.items()])
    own = Window.partitionBy(*PERIOD)
    book = book.withColumns({"value": F.col("v0"), "shares": F.col("s0"), "outcomes": F.array().cast("array<string>")})
    for k in range(1, most + 1):
        value, shares = F.col(f"v{k}"), F.col(f"s{k}")
        known = F.col("value").isNotNull()
        sums = {
            "__base": F.sum("value"), "__extra": F.sum(value), "__known": F.sum(F.when(known, value)), "__same": F.sum(F.when(F.col("shares") == shares, value)),
            "__lines": F.count("value"), "__more": F.count(value),
        }
        book = book.withColumns({n: F.coalesce(c.over(own), F.lit(0)) for n, c in sums.items()})
        extra = F.col("__extra")
        whole = (F.col("__base") > 0) & (extra >= BY_VALUE * F.col("__base")) & (F.col("__known") > KNOWN * extra) & (F.col("__more") >= BY_LINES * F.col("__lines"))
        instead = (extra > 0) & ((F.col("__same") > SAME_SHARES * extra) | whole)
        book = book.withColumn("__instead", F.when(F.col("__more") > 0, instead))
        joined = lambda now, more: F.when(F.coalesce("__instead", F.lit(False)), more).when(now.isNull(), more).otherwise(now + F.coalesce(more, F.lit(0)))
        said = F.when(F.col("__instead").isNull(), F.col("outcomes")).otherwise(F.array_append("outcomes", F.when(F.col("__instead"), "replaced").otherwise("appended")))
        book = book.withColumns({"value": joined(F.col("value"), value), "shares": joined(F.col("shares"), shares), "outcomes": said})
    return book.filter("value IS NOT NULL").select(*PERIOD, *key, "value", "shares", F.array_join("outcomes", ",").alias("outcomes"))
