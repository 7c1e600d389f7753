"""Row screens: wanted and unwanted patterns, horizons, restricted hosts, paragraphs, earlier decisions, listings, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.text import canonical_url
from tallyspark.operators.joins import first_per_key

HORIZON_DAYS = 120
PARAGRAPH_CHARS, PARAGRAPH_TABS = 160, 2
#: An enumerated clause: (a), 1., iv) at the start.
ENUMERATED = r"^\(?[0-9a-z]{1,3}[.)]"


def allowed_fields(fields: Column, allowed: tuple[str, ...], forbidden: tuple[str, ...]) -> tuple[list[Column], Column]:
    """The allowed entries of a map as columns in a fixed order, null where missing, and the forbidden ones that it has, comma-joined by name."""
    bad = F.array_sort(F.map_keys(F.map_filter(fields, lambda k, v: k.isin(*forbidden))))
    return [F.element_at(fields, k).alias(k) for k in allowed], F.array_join(bad, ",")


def keep_matching(rows: DataFrame, text: str, wanted: str, noise: str) -> DataFrame:
    """Rows whose text has the wanted pattern and not the noise, letters in either case; null texts go."""
    return rows.filter(F.col(text).rlike(f"(?i){wanted}") & ~F.col(text).rlike(f"(?i){noise}"))


def within_horizon(rows: DataFrame, day: str, as_of: Column, relevant: Column, days: int = HORIZON_DAYS) -> DataFrame:
    """Rows from ``as_of`` to ``days`` later, both included, for which ``relevant`` holds."""
    return rows.filter(F.col(day).between(as_of, F.date_add(as_of, days)) & relevant)


def host(url: Column) -> Column:
    """The host of an absolute URL in lower case, without user and port; empty for others."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def without_hosts(rows: DataFrame, url: str, restricted: DataFrame) -> DataFrame:
    """``rows`` without those whose host is in ``restricted`` (column host), or under such a host.

    Each distinct host meets the register on all its dotted ends, by equality.
    """
    parts = F.split("__host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    hosts = rows.select(host(F.col(url)).alias("__host")).distinct()
    hit = hosts.select("__host", F.explode(ends).alias("__end")).join(restricted.select(F.lower("host").alias("__end")), "__end", "left_semi")
    return rows.withColumn("__host", host(F.col(url))).join(hit.select("__host").distinct(), "__host", "left_anti").drop("__host")


def paragraphs(docs: DataFrame, key: str, text: str, parting: str = r"\n[ \t]*\n", chars: int = PARAGRAPH_CHARS, tabs: int = PARAGRAPH_TABS) -> DataFrame:
    """(key, k, body): paragraphs of prose, the first copy of each by key, then place.

    Short ones, tables (more than ``tabs`` tabs) and enumerated clauses go. The
    first copy is a minimum by paragraph, so one that stands in a third of all
    documents is one row a task before the shuffle.
    """
    p = docs.select(F.col(key), F.posexplode(F.split(F.col(text), parting))).withColumnsRenamed({"pos": "k", "col": "body"})
    n_tabs = F.length("body") - F.length(F.replace("body", F.lit("\t"), F.lit("")))
    p = p.filter((F.length("body") >= chars) & (n_tabs <= tabs) & ~F.col("body").rlike(ENUMERATED))
    first = p.groupBy("body").agg(F.min(F.struct(key, "k")).alias("__first"))
    return first.select(F.col("__first")[key].alias(key), F.col("__first.k").alias("k"), "body")


def not_rejected(claims: DataFrame, decisions: DataFrame, fingerprint: list[str], order: list[Column], rejected: Column) -> DataFrame:
    """Claims whose fingerprint's latest decision (first by ``order``) isn't a rejection."""
    latest = first_per_key(decisions, fingerprint, order)
    return claims.join(latest.filter(rejected).select(*fingerprint), fingerprint, "left_anti")


def eligible_listings(listings: DataFrame, collected: DataFrame, today: Column, key: str) -> DataFrame:
    """Listings (link, approved, expires, closing) that run today and whose link no collected row has; one a link.

    Links are compared in canonical form. Of several the latest approved stays,
    then the least key.
    """
    live = listings.filter((F.col("approved") <= today) & (F.col("expires") >= today) & (F.col("closing").isNull() | (F.col("closing") >= today)))
    live = live.withColumn("__link", canonical_url(F.col("link")))
    seen = collected.select(canonical_url(F.col("link")).alias("__link")).distinct()
    return first_per_key(live.join(seen, "__link", "left_anti"), ["__link"], [F.desc("approved"), F.col(key)]).drop("__link")


def stage_costs(calls: DataFrame, prices: DataFrame, stage: str, units: str) -> DataFrame:
    """(stage, calls, cost): a stage with any unpriced call has no cost; ``prices`` has one row a stage and column price."""
    j = calls.join(prices, stage, "left")
    known = F.bool_and(F.col("price").isNotNull() & F.col(units).isNotNull())
    return j.groupBy(stage).agg(F.count("*").alias("calls"), F.when(known, F.sum(F.col(units) * F.col("price"))).alias("cost"))


def admitted(calls: DataFrame, key: str, order: list[Column], cost: str, budget: Column) -> DataFrame:
    """Each call with the spent sum of its key up to it, and whether that stays within the budget."""
    spent = F.sum(cost).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return calls.withColumn("spent", spent).withColumn("admitted", F.col("spent") <= budget)
