"""A deal's row from its documents: each field from the source that is trusted most for it, with the document it came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import mergers

#: For each field the kinds of documents that may state it, the most trusted first.
PRECEDENCE = {
    "offer": ("agreement", "proxy", "release"),
    "target": ("proxy", "agreement", "release"),
    "agreed": ("agreement", "proxy", "release"),
    "premium": ("proxy", "release"),
}
OLDEST_FINANCIALS = 550


def read_documents(documents: DataFrame) -> DataFrame:
    """(deal, doc, kind, filed, offer, target, agreed, premium, problem) of documents (deal, doc, kind, filed, name, sic, text)."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        "deal", "doc", "kind", "filed", mergers.offer(text)["price"].alias("offer"), F.nullif(F.trim("name"), F.lit("")).alias("target"), mergers.agreement_date(text).alias("agreed"),
        mergers.premium(text).alias("premium"), mergers.target_problem(F.coalesce("name", F.lit("")), F.coalesce("sic", F.lit(0)), F.lit("common")).alias("problem"),
    )


def deal_rows(readings: DataFrame, financials: DataFrame, precedence: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """(deal, status, docs, each field with FIELD_doc, conflicts, revenue, ebitda, period).

    A field's value is that of its most trusted kind that states it, there of the
    newest document, then of the greater id; kinds not listed for a field don't
    state it. ``conflicts`` names the fields on which documents of the chosen kind differ.
    A deal with a document whose target is none is "rejected"; else it is "ok" with offer and
    target, or says what is "missing". ``financials`` is (target, period, revenue, ebitda): the last period
    that ended before the agreement, at most 550 days, counts. Deals have few
    documents; one aggregate by deal chooses all fields, with map-side combine.
    """
    precedence = PRECEDENCE if precedence is None else precedence

    def rank(field: str) -> Column:
        out = F.lit(None).cast("int")
        for k, kind in enumerate(precedence[field]):
            out = F.when((F.col("kind") == kind) & F.col(field).isNotNull(), k) if k == 0 else out.when((F.col("kind") == kind) & F.col(field).isNotNull(), k)
        return out

    ranked = readings.withColumns({f"__{f}": rank(f) for f in precedence})
    best = {f: F.max(F.when(F.col(f"__{f}").isNotNull(), F.struct((-F.col(f"__{f}")).alias("k"), "filed", "doc", F.col(f).alias("v")))) for f in precedence}
    # What each kind says of a field, least and greatest, tells whether its documents differ.
    spread = {
        f"{f}_{k}": F.struct(*[g(F.when((F.col("kind") == kind), F.col(f))).alias(n) for n, g in (("low", F.min), ("high", F.max))]) for f, kinds in precedence.items() for k, kind in enumerate(kinds)
    }
    g = ranked.groupBy("deal").agg(F.count("*").alias("docs"), F.bool_or(F.col("problem").isNotNull()).alias("__no"), *[c.alias(f"__b_{f}") for f, c in best.items()], *[c.alias(f"__s_{n}") for n, c in spread.items()])

    def differs(f: str) -> Column:
        chosen = F.element_at(F.array(*[F.col(f"__s_{f}_{k}")["low"] != F.col(f"__s_{f}_{k}")["high"] for k in range(len(precedence[f]))]), 1 - F.col(f"__b_{f}")["k"])
        return F.when(F.col(f"__b_{f}").isNotNull() & F.coalesce(chosen, F.lit(False)), F.lit(f))

    missing = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"__b_{f}").isNull(), F.lit(f)) for f in ("offer", "target")])), ",")
    status = F.when(F.col("__no"), "rejected").when(missing == "", "ok").otherwise(F.concat(F.lit("missing "), missing))
    fields = [c for f in precedence for c in (F.col(f"__b_{f}")["v"].alias(f), F.col(f"__b_{f}")["doc"].alias(f"{f}_doc"))]
    row = g.select("deal", status.alias("status"), "docs", *fields, F.array_join(F.array_compact(F.array(*[differs(f) for f in precedence])), ",").alias("conflicts"))
    stated = row.select("deal", "target", "agreed").join(financials, "target").filter(F.datediff("agreed", "period").between(1, OLDEST_FINANCIALS))
    last = stated.groupBy("deal").agg(F.max_by(F.struct("revenue", "ebitda", "period"), "period").alias("x"))
    return row.join(last, "deal", "left").select(*row.columns, "x.revenue", "x.ebitda", "x.period")
