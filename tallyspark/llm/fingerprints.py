"""Document fingerprints by winnowing.

Every run of GRAM code points has a rolling hash; of every WINDOW consecutive
hashes the least is kept, the rightmost of equals, with its place. Windows that
reach over an end of the text hold what lies within it, so that short texts keep
several hashes. Any passage of GRAM + WINDOW - 1 code points that two texts share
leaves a hash in both.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import shuffle_partitions

#: Code points in a gram, hashes in a window (at most 255: gaps between places are bytes).
GRAM, WINDOW = 8, 16
#: A hash and the gap from the place before, as they stand in a fingerprint: ten hexadecimal digits.
RECORD = np.dtype([("hash", ">u4"), ("gap", "u1")])
#: Buckets of consecutive ids for each shuffle partition, and characters that a task gives out at once.
BUCKETS, FLUSH = 8, 4 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def gram_hashes(points: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """32-bit hashes of all grams; a shorter text is one gram, an empty one none."""
    n = len(points)
    if not n:
        return np.zeros(0, np.uint32)
    gram = min(gram, n)
    # A polynomial in _BASE, doubled from grams of one code point on: a gram of a + b is the first a, shifted, and the next b.
    part, size = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9), 1
    whole, held = None, 0
    left = gram
    while True:
        if left & 1:
            if whole is None:
                whole, held = part, size
            else:
                count = n - held - size + 1
                whole = whole[:count] * np.uint64(pow(_BASE, size, 1 << 64)) + part[held : held + count]
                held += size
        left >>= 1
        if not left:
            break
        count = n - 2 * size + 1
        part = part[:count] * np.uint64(pow(_BASE, size, 1 << 64)) + part[size : size + count]
        size *= 2
    whole = whole ^ (whole >> np.uint64(31))
    return ((whole * np.uint64(0x94D049BB133111EB)) >> np.uint64(32)).astype(np.uint32)


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the hashes kept: each window's least, the rightmost of equals; of windows over an end too."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    window = min(window, n)
    low = np.uint64(0xFFFFFFFF)
    best = (hashes.astype(np.uint64) << np.uint64(32)) | (low - np.arange(n, dtype=np.uint64))
    head, tail = np.minimum.accumulate(best[: window - 1]), np.minimum.accumulate(best[::-1][: window - 1])[::-1]
    size = 1
    while 2 * size <= window:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    if size < window:
        rest = window - size
        best = np.minimum(best[:-rest], best[rest:])
    best = np.concatenate([head, best, tail])
    places = (low - (best & low)).astype(np.int64)  # never falls from window to window
    return places[np.concatenate([[True], places[1:] != places[:-1]])]


def encode(hashes: np.ndarray, places: np.ndarray) -> str:
    records = np.zeros(len(places), RECORD)
    records["hash"] = hashes[places]
    records["gap"] = np.diff(places, prepend=0)
    return records.tobytes().hex()


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and their places."""
    records = np.frombuffer(bytes.fromhex(fingerprint), RECORD)
    return records["hash"].astype(np.uint32), np.cumsum(records["gap"].astype(np.int64))


def fingerprint(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[str, np.ndarray]:
    """The fingerprint and its hashes in order, with a number to each that tells repeats apart."""
    hashes = gram_hashes(code_points(text), gram)
    places = winnow(hashes, window)
    ordered = np.sort(hashes[places]).astype(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    again = np.arange(len(ordered)) - np.repeat(first, np.diff(first, append=len(ordered)))
    return encode(hashes, places), (ordered << np.uint64(32)) | again.astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two multisets of hashes as ``fingerprint`` gives them; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _print(gram: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, first, chars = [], 0, 0
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py() or ""
                found.append((fingerprint(text, gram, window)[0], len(text)))
                chars += len(text)
                if chars > FLUSH or k + 1 == batch.num_rows:
                    prints, sizes = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(found)), pa.array(sizes, pa.int64()), pa.array(prints)], ["doc_id", "n_chars", "fingerprint"])
                    found, first, chars = [], k + 1, 0

    return run


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, fingerprint of each row's whole text.

    A fingerprint is ten hexadecimal digits a record, in the order of places: a
    hash and the gap from the record before. Null texts count as empty, and an
    empty text has an empty fingerprint; one shorter than a gram is a gram.
    Repeated rows fare alike, null ids stay, other columns aren't read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_print(gram, window), f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_chars long, fingerprint string")


_KEY = ["__some", "__id", "__h1", "__h2"]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows with a key of (id is there, id, two hashes of the text): equal keys are equal documents."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("__id"), body.alias("__text"))
    return rows.select(F.col("__id").isNotNull().alias("__some"), "__id", F.xxhash64("__text").alias("__h1"), F.xxhash64(F.lit(1), "__text").alias("__h2"), "__text")


def _edges(keyed: DataFrame, buckets: int) -> list[tuple]:
    """The last key of each of about so many ranges, ascending: a row a range comes to the driver."""
    keys = keyed.select(F.struct(*_KEY).alias("key"))
    last = keys.repartitionByRange(buckets, "key").groupBy(F.spark_partition_id()).agg(F.max("key").alias("key"))
    return sorted(tuple(r["key"]) for r in last.collect())


def _comparable(key: tuple) -> tuple:
    some, value, h1, h2 = key
    return (some, value, h1, h2) if some else (some, h1, h2)


def _deal(edges: list[tuple]):
    """Rows to the bucket of their key; the last of a bucket also leads the next one, the last of all the first."""
    order = [_comparable(e) for e in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_comparable(k) for k in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)]
            copies: dict[tuple, int] = {}
            first: list[int] = []
            for k, key in enumerate(keys):  # rows that repeat an id and its text go on once a batch
                if key not in copies:
                    first.append(k)
                copies[key] = copies.get(key, 0) + 1
            at, bucket, count = [], [], []
            for k in first:
                b = bisect_left(order, keys[k])
                at.append(k)
                bucket.append(b)
                count.append(copies[keys[k]])
                if order[b] == keys[k]:
                    at.append(k)
                    bucket.append((b + 1) % len(order))
                    count.append(0)
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(bucket, pa.int32()), pa.array(count, pa.int32())], [*batch.schema.names, "__bucket", "__copies"])

    return run


def edited_text(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much, or all, of the start of ``following``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _compare(gram: int, window: int):
    names = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "copies"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before_key = now_key = None
        before = now = None  # (text, fingerprint, hashes) of the document before and of this one
        for batch in batches:
            ids, copies = batch.column(1), batch.column(6).to_pylist()
            keys = list(zip(*(batch.column(i).to_pylist() for i in (5, 0, 1, 2, 3)), [c > 0 for c in copies], strict=True))
            at, out, chars = [], [], 0
            for k in range(batch.num_rows):
                if now_key is None or keys[k] != now_key:
                    text = batch.column(4)[k].as_py()
                    before_key, before = now_key, now
                    now_key, now = keys[k], (text, *fingerprint(text, gram, window))
                if copies[k]:
                    edited = edited_text(now[0], before[0])
                    print_, hashes = fingerprint(edited, gram, window)
                    at.append(k)
                    out.append((len(now[0]), edited, now[1], print_, likeness(now[2], hashes), likeness(now[2], before[2]), copies[k]))
                    chars += 4 * len(edited)
                if out and (chars > FLUSH or k + 1 == batch.num_rows):
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), *columns], names)
                    at, out, chars = [], [], 0

    return run


def compare_with_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next for each row.

    ``edited`` is the text with its last third replaced by the start of the next
    document's; the next one is that of the next lower id, then of a lower hash
    of the text where an id has several texts; null ids come last, and after the
    last comes the first. ``near_edited`` and ``near_next`` are the likeness of
    the fingerprint to the edited text's and to the next document's. Null texts
    count as empty; rows that repeat an id and its text are one document with a
    row each; a document alone is its own next. Other columns aren't read, and
    an empty table gives an empty result.

    Consecutive documents meet in buckets of consecutive keys, each of which also
    has the document before its first: texts are shuffled once, and a task
    holds a document and the one before it.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    keyed = _keyed(docs, doc_id, text)
    edges = _edges(keyed, BUCKETS * shuffle_partitions(spark))
    names = f"doc_id {kind}, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, copies int"
    if not edges:
        return spark.createDataFrame([], names).drop("copies")
    dealt = keyed.mapInArrow(_deal(edges), f"__some boolean, __id {kind}, __h1 long, __h2 long, __text string, __bucket int, __copies int")
    # A bucket's leading document has no copies there and, but for the first bucket's, the least key.
    lead = F.col("__copies") > 0
    rows = dealt.repartition("__bucket").sortWithinPartitions("__bucket", lead, *_KEY)
    found = rows.mapInArrow(_compare(gram, window), names)
    return found.withColumn("__copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("__copy", "copies")
