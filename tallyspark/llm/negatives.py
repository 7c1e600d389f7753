"""Hard-negative mining by blocked dense products.

Vectors are packed into rows of whole blocks. Every block of anchors meets every
block of candidates in one Spark job - the anchors broadcast where they are
small - and a pair of blocks is one matrix product in float64, exact below 2^53.
A first pass keeps each anchor's best rows of its own label, block by block, and
merges them; a second pass takes, for each positive, the best rows of other
labels whose scores lie in the window that the positive's score gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import Saved, saved, shuffle_partitions
from tallyspark.llm.topk import SCALE, quantised

#: Vectors in a block, and cells of a score matrix that are looked at together.
CANDIDATE_ROWS, ANCHOR_ROWS, CELLS = 4096, 1024, 1 << 20
#: Whole numbers up to here are exact in float64.
EXACT = 1 << 53
#: Stands for no score; no product reaches it in float64, and it fits a long.
NONE = -(1 << 62)

_PACKED = "ids binary, labels binary, row_keys binary, vectors binary, extra binary, kind string"


def _lists(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers, short ones filled with zeros, in the least type that holds them."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    top = int(max(values.max(initial=0), -values.min(initial=0) - 1))  # of Python, so that no long overflows
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(k).max)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), kind)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _pack(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(n: int) -> pa.RecordBatch:
            nonlocal held
            table = pa.Table.from_batches(held).combine_chunks()
            held = table.slice(n).to_batches() if table.num_rows > n else []
            part = table.slice(0, n).combine_chunks().to_batches()[0]
            # Ids ascend within a block: of equal scores the first has the least id.
            order = np.argsort(part.column(0).to_numpy(), kind="stable")
            part = part.take(pa.array(order))
            vectors = _lists(part.column(3))
            cells = [part.column(k).to_numpy().tobytes() for k in range(3)]
            extra = _lists(part.column(4)).astype(np.int64).tobytes() if part.num_columns > 4 else b""
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in [*cells, vectors.tobytes(), extra, vectors.dtype.str]], ["ids", "labels", "row_keys", "vectors", "extra", "kind"])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= rows:
                yield block(rows)
        left = sum(b.num_rows for b in held)
        if left:
            yield block(left)

    return run


def _packed(vectors: DataFrame, rows: int, name: str) -> Saved:
    """Rows of whole blocks, written once: both passes read them, and a lost executor's blocks are read again."""
    return Saved(vectors.mapInArrow(_pack(rows), _PACKED), name)


def _dealt(blocks: DataFrame) -> DataFrame:
    """Blocks over as many tasks as a shuffle has: products cost far more than their blocks' bytes tell."""
    return blocks.repartition(shuffle_partitions(blocks.sparkSession), F.xxhash64("row_keys"))


class _Block:
    """A block as arrays; ``key`` tells blocks apart."""

    def __init__(self, row: dict, side: str, extra: int = 0):
        read = {n: row[f"{side}_{n}"].as_py() for n in ("ids", "labels", "row_keys", "vectors", "extra", "kind")}
        self.ids, self.labels, self.row_keys = (np.frombuffer(read[n], np.int64) for n in ("ids", "labels", "row_keys"))
        self.vectors = np.frombuffer(read["vectors"], read["kind"]).reshape(len(self.ids), -1)
        if extra:
            self.extra = np.frombuffer(read["extra"], np.int64).reshape(len(self.ids), extra)

    def largest(self) -> int:
        return max(int(self.vectors.max(initial=0)), -int(self.vectors.min(initial=0)))


def _products(a: _Block, c: _Block) -> Iterator[tuple[slice, np.ndarray]]:
    """Slices of anchors and their scores with all candidates of a block."""
    width = min(a.vectors.shape[1], c.vectors.shape[1])
    # Windows multiply a score by up to 100; beyond what is exact the product is one of Python's integers.
    exact = a.largest() * c.largest() * max(width, 1) * 100 < EXACT
    kind = np.float64 if exact else object
    step = max(1, CELLS // max(len(c.ids), 1))
    right = c.vectors[:, :width].astype(kind).T
    for at in range(0, len(a.ids), step):
        left = a.vectors[at : at + step, :width].astype(kind)
        scores = left @ right if width else np.zeros((len(left), len(c.ids)), kind)
        yield slice(at, at + step), scores if exact else np.clip(scores, NONE + 1, -NONE - 1)


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k best allowed cells, the first columns of equals."""
    masked = np.where(allowed, scores, NONE)
    n = masked.shape[1]
    if n > k:
        least = np.partition(masked, n - k, axis=1)[:, n - k, None]
        allowed = allowed & (masked >= least)
    rows, columns = np.nonzero(allowed)
    if not len(rows):
        return rows, columns
    order = np.lexsort((columns, -masked[rows, columns].astype(np.int64), rows))
    rows, columns = rows[order], columns[order]
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    place = np.arange(len(rows)) - np.repeat(first, np.diff([*first, len(rows)]))
    return rows[place < k], columns[place < k]


def _distinct(block: _Block, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and scores of a block's (id, label), each with the highest score of its rows."""
    pairs = np.stack([block.ids, block.labels])
    if len(block.ids) < 2 or (np.diff(block.ids) > 0).all():
        return block.ids, block.labels, scores
    order = np.lexsort((block.labels, block.ids))
    pairs, scores = pairs[:, order], scores[:, order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(pairs, axis=1) != 0).any(axis=0)]))
    return pairs[0, first], pairs[1, first], np.maximum.reduceat(scores, first, axis=1)


def _pairs(batches: Iterator[pa.RecordBatch], extra: int = 0) -> Iterator[tuple[_Block, _Block]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
            yield _Block(row, "a", extra), _Block(row, "c")


_FOUND = "row_key long, anchor_id long, anchor_label long, other_id long, score long, slot int"


def _rows(a: _Block, at: np.ndarray, ids: np.ndarray, scores: np.ndarray, slot: int) -> pa.RecordBatch:
    cells = [a.row_keys[at], a.ids[at], a.labels[at], ids, scores.astype(np.int64), np.full(len(at), slot, np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in cells], [f.split()[0] for f in _FOUND.split(", ")])


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, c in _pairs(batches):
            for part, scores in _products(a, c):
                ids, labels, scores = _distinct(c, scores)
                allowed = (a.labels[part, None] == labels) & (a.ids[part, None] != ids)
                rows, columns = _best(scores, allowed, k)
                yield _rows(a, rows + part.start, ids[columns], scores[rows, columns], 0)

    return run


def _negatives(k: int, positives: int, low: int, high: int):
    """For each positive (slot) of an anchor: the k best rows of other labels with low * p <= 100 * score <= high * p."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, c in _pairs(batches, positives):
            for part, scores in _products(a, c):
                ids, labels, scores = _distinct(c, scores)
                other = (a.labels[part, None] != labels) & (a.ids[part, None] != ids)
                for slot in range(positives):
                    own = a.extra[part, slot, None]
                    asked = own != NONE
                    own = np.where(asked, own, 0)
                    limits = own.astype(scores.dtype)
                    allowed = other & asked & (100 * scores >= low * limits) & (100 * scores <= high * limits)
                    rows, columns = _best(scores, allowed, k)
                    if len(rows):
                        yield _rows(a, rows + part.start, ids[columns], scores[rows, columns], slot)

    return run


def _met(anchors: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each block of anchors with each block of candidates, a row a pair.

    Spark sends the anchors' blocks to all tasks if their table is below its
    limit for broadcasts, else deals pairs of partitions; nothing passes the driver.
    """
    left, right = (d.select(*[F.col(n).alias(f"{side}_{n}") for n in d.columns]) for d, side in ((anchors, "a"), (candidates, "c")))
    return left.crossJoin(right)


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best distinct other ids of each key, ties to the lesser id."""
    best = found.groupBy(*keys, "other_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    positives: int = 5,
    k: int = 3,
    low: int = 50,
    high: int = 95,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    anchor_rows: int = ANCHOR_ROWS,
    candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Each row that ``is_anchor`` marks has as positives its ``positives`` best
    other rows of its label, and for each of them come the ``k`` best rows of
    other labels with ``low * p <= 100 * score <= high * p``, p the positive's
    score. Scores are inner products of floor(scale * component); ties go to the
    lesser id. Rows with a null id, label or vector or with a null or non-finite
    component take no part. Missing components count as zero. Rows that repeat
    an id, a label and a vector count once; an id with several labels or vectors is an
    anchor with each of them, never its own positive or negative, and as another
    row it counts once a label, with its highest score. Components beyond a
    long and scores beyond 2^62 are cut to those limits. Other columns aren't read; no anchors, no
    positives or no negatives within a window give no rows.
    """
    label = F.col(label) if isinstance(label, str) else label
    base = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), quantised(F.col(vector), scale).alias("v"), is_anchor.alias("asks"))
    base = base.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    keyed = base.select("vec_id", "label", F.xxhash64("vec_id", "label", "v").alias("row_key"), "v", "asks")
    anchors = saved(keyed.filter("asks").drop("asks").dropDuplicates(["row_key"]), "anchors")
    candidates = _packed(keyed.drop("asks"), candidate_rows, "candidates")

    first = _packed(anchors, anchor_rows, "anchor-blocks")
    found = _met(first.df, _dealt(candidates.df)).mapInArrow(_positives(positives), _FOUND)
    chosen = saved(_ranked(found, ["row_key", "anchor_id", "anchor_label"], positives), "positives")
    first.remove()

    scores = F.map_from_entries(F.collect_list(F.struct((F.col("rank") - 1).alias("slot"), "score")))  # at most ``positives`` of them
    slots = F.array(*[F.coalesce(F.element_at("found", F.lit(s)), F.lit(NONE)) for s in range(positives)])
    asking = anchors.join(chosen.groupBy("row_key").agg(scores.alias("found")), "row_key").select("vec_id", "label", "row_key", "v", slots.alias("extra"))
    second = _packed(asking, anchor_rows, "asking-blocks")
    found = _met(second.df, _dealt(candidates.df)).mapInArrow(_negatives(k, positives, low, high), _FOUND)
    mined = _ranked(found, ["row_key", "slot"], k)
    own = chosen.select("row_key", (F.col("rank") - 1).alias("slot"), "anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return mined.join(own, ["row_key", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
