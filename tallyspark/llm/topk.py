"""Exact top-k search by term-at-a-time accumulation.

Queries are sparse rows of (term, weight). For each block of candidates every
term's postings - the candidates with a component there, and its values - are
scattered, times the query's weight, into a dense array of scores; a partition
of that array selects the block's best, and blocks merge in one aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import saved, shared_path

SCALE = 256
#: Bytes of queries that are broadcast at once, and candidates in a block.
QUERY_BYTES, BLOCK_ROWS = 32 << 20, 4096
#: Cells of a dense score array: it stays in a core's cache.
CELLS = 1 << 17


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as double; null for a vector that takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(vector.isNotNull() & ~bad, whole)


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of integers, short ones filled with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _scores(weights: np.ndarray, postings: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Dense scores (queries, n), one term after the other."""
    scores = np.zeros((len(weights), n), weights.dtype)
    for term, (rows, values) in enumerate(postings[: weights.shape[1]]):
        asked = np.flatnonzero(weights[:, term])
        if not len(asked) or not len(rows):
            continue
        added = weights[asked, term][:, None] * values
        if len(asked) == len(weights) and len(rows) == n:
            scores += added
        elif len(rows) == n:
            scores[asked] += added
        else:
            scores[np.ix_(asked, rows)] += added
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, k: int):
    """(query, candidate) positions of each query's k best; ids ascend, so the first of equals has the least id."""
    for q in range(len(scores)):
        row = scores[q]
        own = np.searchsorted(ids, query_ids[q])
        allowed = np.arange(len(ids)) if own >= len(ids) or ids[own] != query_ids[q] else np.delete(np.arange(len(ids)), own)
        if not len(allowed):
            continue
        if len(allowed) > k:
            values = row[allowed]
            least = np.partition(values, len(values) - k)[len(values) - k]
            above, equal = np.flatnonzero(values > least), np.flatnonzero(values == least)
            allowed = allowed[np.concatenate([above, equal[: k - len(above)]])]
        yield np.full(len(allowed), query_ids[q]), ids[allowed], row[allowed]


def _block_search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, weights: np.ndarray, k: int):
    """The k best distinct candidate ids of one block for each row of queries."""
    bound = int(np.abs(vectors).max(initial=0)) * int(np.abs(weights).max(initial=0)) * max(vectors.shape[1], 1)
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 62 else object  # Python's integers where a long could overflow
    unique, where = np.unique(ids, return_inverse=True)
    vectors = vectors.astype(kind)
    postings = []
    for term in range(vectors.shape[1]):
        rows = np.flatnonzero(vectors[:, term])
        postings.append((rows, vectors[rows, term]))
    step = max(1, CELLS // max(len(ids), 1))
    for at in range(0, len(query_ids), step):
        scores = _scores(weights[at : at + step].astype(kind), postings, len(ids))
        if len(unique) < len(ids):  # an id in several rows counts with its highest score
            order = np.argsort(where, kind="stable")
            first = np.flatnonzero(np.diff(where[order], prepend=-1))
            scores = np.maximum.reduceat(scores[:, order], first, axis=1)
        else:
            order = np.argsort(ids, kind="stable")
            scores = scores[:, order]
        yield from _best(scores, unique, query_ids[at : at + step], k)


def _search(queries, k: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, weights = queries.value
        longs = np.iinfo(np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                block = batch.slice(at, block_rows)
                found = list(_block_search(block.column(0).to_numpy(), _matrix(block.column(1)), query_ids, weights, k))
                if found:
                    q, c, s = (np.concatenate(x) for x in zip(*found, strict=True))
                    s = np.clip(s, longs.min, longs.max).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(c), pa.array(s)], ["query_id", "vec_id", "score"])

    return run


_FOUND = "query_id long, vec_id long, score long"


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    query_bytes: int = QUERY_BYTES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other vectors for each vector that ``is_query`` marks.

    ``is_query`` is a condition on ``vec_id``. Ties go to the lesser id; a query
    with fewer candidates returns them all. Vectors that are null or hold null
    or non-finite components, and rows with null ids, take no part; missing
    components count as zero, an empty vector as zeros. An id in several rows is
    one candidate and one query, with the highest score of its rows, and never
    its own candidate. Scores beyond a long are cut to its limits. Other columns
    aren't read. No queries give an empty result. Queries go out in blocks of
    about ``query_bytes``, one after the other; each block meets all candidates,
    where they lie, and its best ones are written before the next goes out.
    """
    spark = vectors.sparkSession
    base = vectors.filter(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), quantised(F.col(vector)).alias("v"), is_query.alias("asks"))
    base = base.filter(F.col("v").isNotNull())
    asking = saved(base.filter("asks").select("vec_id", "v"), "queries")
    n, width = asking.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = max(1, -(-n * (width or 1) * 8 // query_bytes))
    path = shared_path(spark, "top-k")
    for b in range(blocks):
        part = asking.filter(F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == b).toArrow().combine_chunks()  # at most about query_bytes
        lists = part["v"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        sent = spark.sparkContext.broadcast((part["vec_id"].to_numpy(), _matrix(lists)))
        found = base.select("vec_id", "v").mapInArrow(_search(sent, k, block_rows), _FOUND)
        found.write.mode("append").parquet(path)
        sent.destroy()  # one block at a time, on the driver too
    merged = spark.read.schema(_FOUND).parquet(path)
    # Each block sends at most k rows a query; an id's best score in any block is its score.
    best = merged.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
