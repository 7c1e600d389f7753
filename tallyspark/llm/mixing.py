"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source starts with the same expected number of copies, the
source's target over its size. The whole part is taken; fractional parts are
paired, and mass moves at random between the two, so that their words stay
constant and each probability keeps its mean, until one of them is integral.
A leaf of documents leaves one fractional document a source and passes on a few
small ones; these residuals meet in a tree of the same step, and in its root the
small documents make up for the last residual. A source ends within about its
smallest documents of the target however its rows are spread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import WORD_CLASS, saved, shuffle_partitions

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0
#: Documents in a leaf, and leaves that meet in a node of the tree.
LEAF, FAN_IN = 2048, 32
#: Sources in a bucket of the tree, and equal rows that go to a leaf together.
SOURCES, SAME = 64, 128
#: The smallest documents of a source that a node passes on unrounded.
RESERVE = 8
_EPS = 1e-9


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``size``: the words of each text, 0 for a null one."""
    words = F.regexp_count(F.col(text).cast("string"), F.lit(WORD_CLASS + "+"))
    return docs.withColumn("size", F.coalesce(words, F.lit(0)).cast("long"))


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` (distinct, column source) with ``rank`` from 0 by code point, null last.

    Ranges of the order are counted first, so no task sees all sources.
    """
    spark = sources.sparkSession
    order = [F.col("source").isNull(), F.col("source")]
    ranged = sources.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    placed = saved(ranged.withColumn("range", F.spark_partition_id()), "sources")
    counts = sorted((r["range"], r["count"]) for r in placed.groupBy("range").count().collect())  # one a range
    before, total = {}, 0
    for at, n in counts:
        before[at] = total
        total += n
    within = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    base = spark.createDataFrame(list(before.items()), "range int, before long")
    placed = placed.withColumn("within", within).join(F.broadcast(base), "range")  # a row for each range
    return placed.select("source", (F.col("within") + F.col("before")).cast("long").alias("rank"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in order of rank weigh ``weights`` in turn and share ``share`` times
    all words; what exceeds ``most`` times a source's size is shared again by
    weight until none is above. Each turn is one aggregate over the sources.
    """
    totals = saved(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    ranks = ranked(totals.select("source")).select(F.col("source").alias("__s"), weight.alias("weight"))
    weighed = saved(totals.join(ranks, totals["source"].eqNullSafe(ranks["__s"])).drop("__s"), "weights")
    limit = F.col("source_size") * F.lit(most)
    goal = (weighed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, None
    while True:
        over = F.col("weight") * F.lit(level) > limit
        full, free, n = weighed.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)), F.count(F.when(over, 1))
        ).first()
        if n == capped:
            break
        capped = n
        level = (goal - full) / free if free > 0 else float("inf")
    return weighed.select("source", "source_size", F.least(F.col("weight") * F.lit(level), limit).alias("target"))


def pivot(p: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, int]:
    """Rounds ``p`` in turn; the position of the one that stays fractional, or -1. sum(p * size) stays."""
    p = p.copy()
    left = -1
    coins = draw.random(len(p))
    for i in range(len(p)):
        if not _EPS < p[i] < 1 - _EPS or size[i] == 0:
            continue
        if left < 0:
            left = i
            continue
        a, b = left, i
        ratio = size[b] / size[a]
        up, down = min(1 - p[a], p[b] * ratio), min(p[a], (1 - p[b]) * ratio)
        step = up if coins[i] * (up + down) < down else -down
        p[a] += step
        p[b] -= step / ratio
        for x in (a, b):
            if p[x] < _EPS or p[x] > 1 - _EPS:
                p[x] = round(p[x])
        left = a if _EPS < p[a] < 1 - _EPS else b if _EPS < p[b] < 1 - _EPS else -1
    return p, left


def settle(p: np.ndarray, size: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Rounds all of ``p``, largest size first, each against the bundle of all smaller ones.

    A document's coin falls by its own probability; the mass that this gains or
    loses moves to the bundle, whose common probability is what the words still
    wanted ask of it. Where the bundle couldn't make up for one of the outcomes,
    the other is taken.
    """
    out = p.copy()
    order = np.argsort(-size, kind="stable")
    wanted, words = float(p @ size), float(size.sum())
    for k, i in enumerate(order):
        left = words - size[i]
        fits, spared = size[i] <= wanted, wanted <= left
        if fits and spared:
            taken = draw.random() < (p[i] if k == 0 else wanted / words)
        elif fits or spared:
            taken = fits
        else:  # either way misses: the nearer one
            taken = size[i] - wanted < wanted - left
        out[i] = float(taken)
        wanted, words = wanted - out[i] * size[i], left
    return out


def bundled(p: np.ndarray, size: np.ndarray) -> int:
    """How many of the smallest documents (sizes ascend) the root leaves unpaired.

    Half of them, or more until their words make up for any one document,
    taken or not: p / (1 - p) or its inverse times that one's words.
    """
    if not len(p):
        return 0
    odds = p / (1 - p)
    need = (size * np.maximum(odds, 1 / odds)).max()
    return min(len(p), max(len(p) // 2, int(np.searchsorted(np.cumsum(size), need)) + 1))


def _round_node(seed: int, last: bool):
    """A function for one node: rows of all sources, rounded source by source in a fixed order.

    A node passes on its residual and its ``RESERVE`` smallest documents of a
    source; in the root these make up for the residual's words.
    """

    def run(rows: pa.Table) -> pa.Table:
        if "copies" in rows.column_names:
            rows = rows.take(pa.array(np.repeat(np.arange(rows.num_rows), rows["copies"].to_numpy()))).drop_columns(["copies"])
        rows = rows.sort_by([(c, "ascending") for c in ("source", "size", "doc_id", "whole", "part")]).combine_chunks()
        source = rows["source"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        part, size = rows["part"].to_numpy(), rows["size"].to_numpy().astype(float)
        draw = np.random.default_rng([seed, rows["node"][0].as_py(), rows["bucket"][0].as_py()])
        cuts = [0, *(np.flatnonzero(source[1:] != source[:-1]) + 1), len(source)]
        out = part.copy()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = a + np.flatnonzero((part[a:b] > _EPS) & (part[a:b] < 1 - _EPS) & (size[a:b] > 0))
            small = bundled(part[at], size[at]) if last else min(RESERVE, len(at) // 2)
            large = at[small:]
            out[large], left = pivot(part[large], size[large], draw)
            if last:
                rest = np.append(at[:small], large[left]) if left >= 0 else at[:small]
                out[rest] = settle(out[rest], size[rest], draw)
        return rows.set_column(rows.schema.get_field_index("part"), "part", pa.array(out))

    return run


_ROW = "doc_id long, source string, size long, whole long, part double, bucket long, node long"


def rounded(rows: DataFrame, seed: int = 0, leaf: int = LEAF, fan_in: int = FAN_IN) -> DataFrame:
    """(doc_id, source, size, copies) from rows (doc_id, source, size, x), x the expected copies of each.

    Leaves are dealt by a hash of the rows' own values and coins by the leaf, so
    reruns agree; a source with a third of all rows is spread over all leaves.
    Equal rows are counted and dealt in blocks. Above the leaves the tree is one
    for each bucket of ``SOURCES`` sources, so a node's rows have a bound however
    many sources there are.
    """
    n, sources = rows.agg(F.count("*"), F.approx_count_distinct("source")).first()
    nodes, buckets = max(1, -(-n // leaf)), max(1, -(-sources // SOURCES))
    whole = F.floor("x").cast("long")
    counted = rows.groupBy("doc_id", "source", "size", "x").agg(F.count("*").alias("n"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(SAME).cast("long"))).alias("at")
    counted = counted.select("*", block).withColumn("copies", F.least(F.col("n") - F.col("at"), F.lit(SAME)))
    node = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed), "at"), F.lit(nodes))
    bucket = F.pmod(F.xxhash64("source"), F.lit(buckets)) if nodes == 1 else F.lit(0).cast("long")
    level = counted.select("doc_id", "source", "size", whole.alias("whole"), (F.col("x") - whole).alias("part"), bucket.alias("bucket"), node.alias("node"), "copies")
    done = []
    depth = 0
    while True:
        last = nodes == 1
        out = saved(level.groupBy("bucket", "node").applyInArrow(_round_node(seed + depth, last), _ROW), "rounded")
        open_part = (F.col("part") > _EPS) & (F.col("part") < 1 - _EPS) & (F.col("size") > 0)
        done.append(out if last else out.filter(~open_part))
        if last:
            break
        nodes, depth = -(-nodes // fan_in), depth + 1
        up = F.floor(F.col("node") / fan_in).cast("long")
        level = out.filter(open_part).withColumns({"bucket": F.pmod(F.xxhash64("source"), F.lit(buckets)), "node": up})
    all_done = done[0]
    for more in done[1:]:
        all_done = all_done.unionByName(more)
    return all_done.select("doc_id", "source", "size", (F.col("whole") + F.when(F.col("part") > 0.5, 1).otherwise(0)).cast("long").alias("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    ``copies`` is 0, 1 or 2 and ``taken`` its words. Null texts have size 0 and
    take nothing; null sources are one source, the last. Null ids and repeated
    rows are rounded like others, each row by itself. Other columns aren't read.
    An empty table, or one without words, takes nothing.
    """
    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    rows = saved(sized(picked).select("doc_id", "source", "size"), "sizes")
    aims = saved(targets(rows), "targets").select(F.col("source").alias("__s"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shared = rows.join(aims, rows["source"].eqNullSafe(aims["__s"])).drop("__s")
    took = rounded(shared.filter("size > 0").select("doc_id", "source", "size", rate.alias("x")), seed)
    took = took.unionByName(rows.filter("size = 0").withColumn("copies", F.lit(0).cast("long")))
    full = took.join(aims, took["source"].eqNullSafe(aims["__s"])).drop("__s")
    return full.withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns.

    Decisions and rows meet on id, source and size; of rows alike in these
    three, as many take two, one or no copies as were decided, by order of text.
    """
    columns = docs.columns
    null_id, null_source = F.col("__id").isNull().cast("int"), F.col("__source").isNull().cast("int")

    def keyed(df: DataFrame) -> DataFrame:
        return df.select(
            *[c for c in df.columns if c not in ("__id", "__source")],
            F.coalesce("__id", F.lit(0).cast("long")).alias("__k1"),
            F.coalesce("__source", F.lit("")).alias("__k2"),
            (null_id + 2 * null_source).alias("__k3"),
        )

    took = mix(docs, doc_id, text, source, seed).filter("copies > 0")
    took = keyed(took.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), "copies"))
    keys = ["__k1", "__k2", "__k3", "__size"]
    plan = took.groupBy(*keys).agg(F.count(F.when(F.col("copies") == 2, 1)).alias("__two"), F.count("*").alias("__any"))
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"),
        F.col(doc_id).cast("long").alias("__id"),
        F.col(source).cast("string").alias("__source"),
        F.col(text).alias("text"),
    )
    row = keyed(sized(row).withColumnRenamed("size", "__size").withColumn("__text", F.xxhash64(F.col("text").cast("string"))).drop("text"))
    met = row.join(plan, keys)
    # Dealt by the same keys as the join: no further shuffle.
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("__text"))
    times = F.when(nth <= F.col("__two"), 2).when(nth <= F.col("__any"), 1).otherwise(0)
    repeated = met.withColumn("__times", times).withColumn("__one", F.explode(F.array_repeat(F.lit(1), F.col("__times"))))
    return repeated.select(*[F.col("__row")[c].alias(c) for c in columns])
