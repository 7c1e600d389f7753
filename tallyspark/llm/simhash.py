"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint's 64 bits are cut into three segments. Two fingerprints at most
four bits apart differ by at most one bit in some segment, so that segment's
one-wildcard variants (the segment with one bit blanked) meet in an equality on
a variant. All candidates of a variant are verified; the links found span each
cluster instead of listing all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import saved, shuffle_partitions
from tallyspark.llm.components import components

DISTANCE = 4
#: (first bit, bits) of the segments; with three of them one differs by one bit at most at distance 4.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: A variant with more fingerprints than this is split into pairs of blocks of half the size.
BLOCK = 4096
#: Runs longer than this give spanning links, shorter ones all their links.
SMALL_RUN = 12
VOTE_BLOCK = 1 << 16

_ONE = np.uint64(1)
_MASKS = [np.uint64(((1 << n) - 1) << at) for at, n in SEGMENTS]
_FIRST = [np.uint64(1 << at) for at, _ in SEGMENTS]


def fingerprint(body: bytes, words_a_shingle: int = 4) -> int:
    """The signed 64-bit SimHash of a UTF-8 text: XXH64 (seed 42) of its word shingles, repeats included, by majority."""
    words = body.lower().split()  # bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words_a_shingle, len(words))
    first, last = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), VOTE_BLOCK):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(first[at : at + VOTE_BLOCK], last[at : at + VOTE_BLOCK], strict=True)], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    bits = (votes * 2 > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_a_shingle: int = 4, hashes: bool = False) -> DataFrame:
    """(doc_id, fp long) for every row; a null or wordless text has fingerprint zero. ``hashes`` adds t1 and t2, two hashes of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(x or b"", words_a_shingle) for x in b.column(1).cast(pa.binary()).to_pylist()]
            kept = [k for k in range(b.num_columns) if k != 1]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in kept], pa.array(fps, pa.int64())], [*[b.schema.names[k] for k in kept], "fp"])

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    if not hashes:
        return picked.mapInArrow(run, "doc_id long, fp long")
    return picked.select("doc_id", "text", *_text_hashes(F.col("text"))).mapInArrow(run, "doc_id long, t1 long, t2 long, fp long")


def _text_hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def variant_keys(fp: Column) -> Column:
    """The 64 one-wildcard variants of a fingerprint: the blanked bit and what is left of its segment, as one long."""
    keys = []
    for at, n in SEGMENTS:
        segment = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << n) - 1))
        keys += [segment.bitwiseAND(F.lit(((1 << n) - 1) & ~(1 << j))).bitwiseOR(F.lit((at + j) << 22)) for j in range(n)]
    return F.array(*keys)


def _counts_here(x: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Whether a pair with difference x links, and is to be told by the variant that blanks ``bit``.

    That is the variant of the first segment with at most one difference: the
    one that blanks the difference, or the segment's first bit if there is none.
    """
    near = np.bitwise_count(x) <= DISTANCE
    teller = np.zeros_like(x)
    for mask, first in zip(reversed(_MASKS), reversed(_FIRST), strict=True):
        part = x & mask
        teller = np.where(part & (part - _ONE) == 0, np.where(part == 0, first, part), teller)
    return near & (teller == bit)


def _links_of_run(fp: np.ndarray, bit: np.uint64) -> list[tuple[int, int]]:
    """Links that span the clusters of one variant's fingerprints, at most one fewer than those."""
    label = np.arange(len(fp))
    found = []
    for i in range(len(fp) - 1):
        linked = np.flatnonzero(_counts_here(fp[i + 1 :] ^ fp[i], bit)) + i + 1
        if not len(linked):
            continue
        labels, where = np.unique(label[linked], return_index=True)
        for other, j in zip(labels, linked[where], strict=True):
            if other != label[i]:
                found.append((i, int(j)))
                label[label == other] = label[i]
    return found


def _links(key: np.ndarray, unit: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within whole runs of equal (key, unit)."""
    n = len(key)
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (unit[1:] != unit[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    run = np.cumsum(new) - 1
    left_in_run = (start + size)[run] - np.arange(n)
    bits = _ONE << (key.astype(np.uint64) >> np.uint64(22))
    a, b = [], []
    active = np.flatnonzero((left_in_run > 1) & (size[run] <= SMALL_RUN))
    step = 1
    while len(active):
        hit = active[_counts_here(fp[active] ^ fp[active + step], bits[active])]
        a.append(fp[hit])
        b.append(fp[hit + step])
        step += 1
        active = active[left_in_run[active] > step]
    for r in np.flatnonzero(size > SMALL_RUN):
        own = fp[start[r] : start[r] + size[r]]
        pairs = _links_of_run(own, bits[start[r]])
        a.append(own[[i for i, _ in pairs]] if pairs else own[:0])
        b.append(own[[j for _, j in pairs]] if pairs else own[:0])
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *a]), np.concatenate([empty, *b])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, unit, fp) sorted by all three; a run that a batch's end cuts waits for the next batch."""
    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]

    def told(key, unit, fp):
        a, b = _links(key, unit, fp)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        more = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        key, unit, fp = (np.concatenate([h, m.view(h.dtype)]) for h, m in zip(held, more, strict=True))
        last = np.flatnonzero((key != key[-1]) | (unit != unit[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield told(key[:cut], unit[:cut], fp[:cut])
        held = [key[cut:], unit[cut:], fp[cut:]]
    if len(held[0]):
        yield told(*held)


def near_links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links that span every cluster of distinct fingerprints at most ``DISTANCE`` bits apart.

    ``fps`` has one row for each distinct fingerprint in column fp. A variant
    with more than ``block`` fingerprints is dealt out as pairs of blocks, so no
    task holds more than ``block`` of them at once and none is left out.
    """
    spark = fps.sparkSession
    keys = fps.select("fp", F.explode(variant_keys(F.col("fp"))).alias("key"))
    large = saved(keys.groupBy("key").count().filter(F.col("count") > block), "variants")
    half = F.lit(max(1, block // 2))
    dealt = keys.join(large, "key", "left").withColumn("parts", F.coalesce(F.ceil(F.col("count") / half), F.lit(1)).cast("int"))
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    units = F.when(F.col("parts") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda c: (F.least(mine, c).cast("long") * F.col("parts") + F.greatest(mine, c)))
    )
    dealt = dealt.select("key", F.explode(units).alias("unit"), "fp")
    ordered = dealt.repartition(shuffle_partitions(spark), "key", "unit").sortWithinPartitions("key", "unit", "fp")
    return ordered.mapInArrow(_verify, "a long, b long")


def _rooted(prints: DataFrame, order: Column) -> DataFrame:
    """(fp, least, root): the least ``order`` of each fingerprint and the root of its component."""
    nodes = saved(prints.groupBy("fp").agg(F.min(order).alias("least")), "nodes")
    rooted = components(near_links(nodes.select("fp")))
    named = nodes.join(rooted.select(F.col("node").alias("fp"), "root"), "fp", "left")
    return saved(named.select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_a_shingle: int = 4) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fp, component_id.

    component_id is the least doc_id that links reach, the row's own included.
    Null and wordless texts share fingerprint zero. Equal ids and repeated rows
    each keep their row; null ids take no part in the least id, and a component
    with no other id has a null one. Other columns aren't read. Exact copies
    share one fingerprint and are never expanded into pairs. An empty table
    gives an empty result.
    """
    prints = saved(fingerprints(docs, doc_id, text, words_a_shingle), "fingerprints")
    named = _rooted(prints, F.col("doc_id"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = saved(named.join(least, "root").select("fp", "component_id"), "by-print")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_a_shingle: int = 5) -> DataFrame:
    """One row of each component of ``docs``, all columns: that of the least id, nulls last, then of the least text hash.

    The row is found by its id and text, so any number of components without an
    id keep a row each. A stated id stays once: of components whose rows chosen
    share it, the one of least text hash keeps its row. Of rows that repeat an id
    and its text any one stays. Shingles here are of five words, the default of
    the near-duplicate operators.
    """
    columns = docs.columns
    key = ["__m", "__k", "__t1", "__t2"]

    def keys(id_: Column, t1: Column, t2: Column) -> list[Column]:
        each = (id_.isNull().cast("int"), F.coalesce(id_, F.lit(0).cast("long")), t1, t2)
        return [c.alias(k) for c, k in zip(each, key, strict=True)]

    prints = saved(fingerprints(docs, doc_id, text, words_a_shingle, hashes=True), "fingerprints")
    named = _rooted(prints, F.struct(*keys(F.col("doc_id"), F.col("t1"), F.col("t2"))))
    chosen = named.groupBy("root").agg(F.min("least").alias("least")).select("least.*")
    once = chosen.filter("__m = 0").groupBy("__m", "__k").agg(F.min(F.struct("__t1", "__t2")).alias("t")).select("__m", "__k", "t.*")
    keepers = saved(chosen.filter("__m = 1").unionByName(once), "keepers")
    t1, t2 = _text_hashes(F.col(text).cast("string"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row"), *keys(F.col(doc_id).cast("long"), t1, t2))
    # Repeated rows meet combined, so none of them can make a large partition; the join then needs no other shuffle.
    each = row.groupBy(*key).agg(F.first("__row").alias("__row"))
    return each.join(keepers, key, "left_semi").select(*[F.col("__row")[c].alias(c) for c in columns])
