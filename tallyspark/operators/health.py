"""Verdicts over sources and filers, and what a state machine can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.operators.state import checkpoint_folder

#: Verdicts from best to worst.
VERDICTS = ("ok", "partial", "failed")


def worst(*verdicts: Column) -> Column:
    """The worst of several verdicts; an unknown one counts as failed."""
    order = F.array(*[F.lit(v) for v in VERDICTS])
    rank = [F.coalesce(F.nullif(F.array_position(order, v), F.lit(0)), F.lit(len(VERDICTS))) for v in verdicts]
    return F.element_at(order, (F.greatest(*rank) if len(rank) > 1 else rank[0]).cast("int"))


def pass_verdict(rows: Column, stated: Column, failures: Column) -> Column:
    """failed without rows but with failures; partial with failures or fewer rows than stated; else ok."""
    return F.when((rows == 0) & (failures > 0), "failed").when((failures > 0) | (rows < stated), "partial").otherwise("ok")


def filer_status(due: Column, last_report: Column, last_notice: Column, stopped: Column) -> Column:
    """current, notice, stopped or overdue against the latest period that is due."""
    return F.when(last_report >= due, "current").when(last_notice >= due, "notice").when(stopped.isNotNull() & (stopped > F.coalesce(last_report, stopped - 1)), "stopped").otherwise("overdue")


def source_health(checks: DataFrame, source: str, at: str, ok: Column) -> DataFrame:
    """(source, last_success, failing_since, failures): failures since the last success, null and 0 if there are none."""
    own = Window.partitionBy(source)
    c = checks.withColumn("__ok", ok).withColumn("__last", F.max(F.when(F.col("__ok"), F.col(at))).over(own))
    failing = ~F.col("__ok") & (F.col("__last").isNull() | (F.col(at) > F.col("__last")))
    return c.groupBy(source).agg(F.max("__last").alias("last_success"), F.min(F.when(failing, F.col(at))).alias("failing_since"), F.count(F.when(failing, 1)).alias("failures"))


def reachable(edges: DataFrame, start: str, most_rounds: int = 1000) -> DataFrame:
    """(state): all states that edges (from_state, to_state) lead to from ``start``, which is among them only if an edge leads back.

    A round follows the edges out of the states found last, until it finds none
    that is new; what is found is written in the shared folder. More rounds than
    ``most_rounds`` are an error, never a shorter answer. Edges with a null end lead nowhere.
    """
    spark = edges.sparkSession
    root = f"{checkpoint_folder(spark).rstrip('/')}/reachable-{uuid.uuid4().hex}"
    known = edges.select("from_state", "to_state").distinct()
    newest = known.filter(F.col("from_state") == start).select(F.col("to_state").alias("state")).filter("state is not null").distinct()
    schema = newest.schema
    newest.write.parquet(f"{root}/round=0")
    for k in range(1, most_rounds + 1):
        newest = spark.read.schema(schema).parquet(f"{root}/round={k - 1}")
        so_far = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/round={j}" for j in range(k)]).select("state")
        more = newest.join(known, newest["state"] == known["from_state"]).select(F.col("to_state").alias("state")).filter("state is not null").distinct().join(so_far, "state", "left_anti")
        more.write.parquet(f"{root}/round={k}")
        if not spark.read.schema(schema).parquet(f"{root}/round={k}").take(1):
            return so_far
    raise RuntimeError(f"states are still found after {most_rounds} rounds")


EMPTY_SHARE, EDGE_SHARE, REPLACED_SHARE, FEWEST_MARKERS, SHORT_TEXT = 0.3, 0.6, 0.001, 3, 2000


def text_health(units: DataFrame, doc: str, text: str, markers: list[str]) -> DataFrame:
    """A row a document: how sound its extracted text is, from its units (pages, sections).

    Shares of empty units and of units that open or close with the same line
    (none for two units or fewer), replacement characters, how many of the
    lower-case markers occur anywhere, and what to be warned of. A null unit is
    an empty one.
    """
    t = units.select(doc, F.coalesce(F.col(text), F.lit("")).alias("t"))
    lines = F.filter(F.transform(F.split("t", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    said = t.groupBy(doc).agg(
        F.count("*").alias("n_units"),
        (F.sum(F.length("t")) + F.count("*") - 1).alias("n_chars"),
        F.count_if(F.trim(F.regexp_replace("t", r"\s+", " ")) == "").alias("n_empty"),
        F.sum(F.regexp_count("t", F.lit("�"))).alias("n_replaced"),
        *[F.max(F.contains(F.lower("t"), F.lit(m)).cast("int")).alias(f"__m{k}") for k, m in enumerate(markers)],
    )
    edge = t.select(doc, lines.alias("l")).select(doc, F.explode(F.array(F.struct(F.lit("head").alias("side"), F.get("l", F.lit(0)).alias("line")), F.struct(F.lit("foot").alias("side"), F.get("l", F.size("l") - 1).alias("line")))).alias("e"))
    most = edge.filter("e.line is not null").groupBy(doc, "e").agg(F.count("*").alias("n")).groupBy(doc).agg(F.max("n").alias("most"))
    j = said.join(most, doc, "left").withColumn("n_markers", sum([F.col(f"__m{k}") for k in range(len(markers))], F.lit(0)))
    share = F.when(F.col("n_units") > 2, F.coalesce("most", F.lit(0)) / F.col("n_units")).otherwise(F.lit(0.0))
    empty, replaced = F.col("n_empty") / F.col("n_units"), F.coalesce(F.try_divide("n_replaced", "n_chars"), F.lit(0.0))
    warned = [(empty > EMPTY_SHARE, "empty"), (share > EDGE_SHARE, "edges"), (replaced > REPLACED_SHARE, "encoding"), (F.col("n_markers") < FEWEST_MARKERS, "markers"), (F.col("n_chars") < SHORT_TEXT, "short")]
    warnings = F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in warned])), ",")
    return j.select(doc, "n_units", "n_chars", F.round(empty, 6).alias("empty_ratio"), F.round(share, 6).alias("edge_ratio"), F.round(replaced, 6).alias("replaced_rate"), "n_markers", warnings.alias("warnings"))
