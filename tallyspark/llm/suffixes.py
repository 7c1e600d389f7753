"""Passages that repeat, through a sparse suffix array.

Suffixes start at content-selected places: minimisers of word 8-grams, so equal
passages select equal places. Of a suffix its first words are one hash; suffixes
whose hash occurs once can't repeat and go. The others are sorted by hash and by
the words that follow. Lengths of neighbours' common prefixes part the order into
runs of equal prefixes, to the right and, in a second order, to the left; along
runs of both the least suffix is carried, and all others are later occurrences.
Every text of ``MIN_WORDS`` words that returns contains such a place
with its first words inside; overlapping matches of one document are merged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import WORD_CLASS, Saved, saved, shuffle_partitions

MIN_WORDS = 50
GRAM, WINDOW = 8, 20
#: Words of a suffix under its hash; words kept on either side to extend over.
HEAD = MIN_WORDS - WINDOW + 1
SIDE = MIN_WORDS - HEAD

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words from hashes of words: powers of two are doubled, then joined."""
    with np.errstate(over="ignore"):
        total, done, block, size = None, 0, h, 1
        while n:
            if n & 1:
                part = block[done:]
                total = part if total is None else (total[: len(part)] * _MULTIPLY) ^ (part + (total[: len(part)] >> np.uint64(29)))
                done += size
            n >>= 1
            if n:
                a, b = block[:-size], block[size:]
                block = (a * _MULTIPLY) ^ (b + (a >> np.uint64(31)))
                size *= 2
    return total


def selected(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes of the suffixes' heads) of a document's words."""
    empty = np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(words) < MIN_WORDS:
        return empty
    digest = xxhash.xxh64_intdigest
    h = np.fromiter(map(digest, words), np.uint64, len(words))
    grams = _rolled(h, GRAM)
    windows = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    places = np.unique(np.arange(len(windows)) + windows.argmin(axis=1))
    places = places[places + HEAD <= len(words)]
    return places, _rolled(h, HEAD)[places]


_ANCHOR = "doc long, t1 long, t2 long, place long, head long"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, t1, t2, text) to a row for each suffix, t2 left out, and one for the text: place -1, its number of words as head."""
    for b in batches:
        keys, counts, places, heads = [], [], [], []
        for k, body in enumerate(b.column(3).cast(pa.binary()).to_pylist()):
            words = body.split()
            if len(words) < MIN_WORDS:
                continue
            at, head = selected(words)
            keys.append(k)
            counts.append(len(at) + 1)
            places += [[-1], at]
            heads += [[len(words)], head.view(np.int64)]
        if keys:
            row = np.repeat(keys, counts)
            place = np.concatenate(places).astype(np.int64)
            doc, t1, t2 = (b.column(k).take(pa.array(row)) for k in range(3))
            t2 = pa.array(t2.to_numpy(), mask=place >= 0)
            yield pa.RecordBatch.from_arrays([doc, t1, t2, pa.array(place), pa.array(np.concatenate(heads).astype(np.int64))], ["doc", "t1", "t2", "place", "head"])


_CONTEXT = "head long, head2 long, right binary, left binary, doc long, t1 long, place long"
_CONTEXT_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
_CONTEXT_NAMES = ["head", "head2", "right", "left", "doc", "t1", "place"]
#: Suffixes that a task looks at together.
CHUNK = 50_000


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, t1, text, places) to suffixes: 128 bits for the head, the words after it, and those before it, nearest first.

    Each word is followed by a space, so texts with equal first words are neighbours by byte order.
    """
    digest = xxhash.xxh64_intdigest
    out: list[list] = [[] for _ in _CONTEXT_NAMES]

    def told() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _CONTEXT_TYPES, strict=True)], _CONTEXT_NAMES)
        for column in out:
            column.clear()
        return rows

    for b in batches:
        bodies = b.column(2).cast(pa.binary())
        for k, doc, t1, found in zip(range(b.num_rows), b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
            words = bodies[k].as_py().split()
            for x in found:
                at = x["place"]
                end = at + HEAD
                out[0].append(x["head"])
                out[1].append(digest(b" ".join(words[at:end]), 7) - (1 << 63))
                out[2].append(b" ".join([*words[end : end + SIDE], b""]))
                out[3].append(b" ".join([*words[max(0, at - SIDE) : at][::-1], b""]))
                out[4].append(doc)
                out[5].append(t1)
                out[6].append(at)
            if len(out[0]) >= CHUNK // 4:
                yield told()
    if out[0]:
        yield told()


def _word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(codes (rows, SIDE), words of each row): equal words have equal codes, -1 stands where there is none."""
    parts = pc.split_pattern(texts, b" ")  # the last part is what follows the last space: nothing
    codes = parts.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    sizes = np.diff(parts.offsets.to_numpy())
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    word = column < sizes[row] - 1
    out = np.full((len(sizes), SIDE), -1, np.int32)
    out[row[word], column[word]] = codes[word]
    return out, sizes - 1


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading words in common of the rows of two tables of codes."""
    return np.logical_and.accumulate((a == b) & (a >= 0), axis=1).sum(axis=1)


_FOUND = "doc long, t1 long, start long, end long, other long, first boolean, k1 long, k2 long"
_FOUND_TYPES = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.int64()]
_FOUND_NAMES = ["doc", "t1", "start", "end", "other", "first", "k1", "k2"]


def _settled(rows: pa.Table) -> pa.RecordBatch:
    """The matches of sorted suffixes within runs of equal prefixes to the right and to the left.

    A run of ``MIN_WORDS`` words around a head takes r words after it and the
    rest before it. Suffixes that share the first r words are neighbours in the
    order by right sides, those that share the rest in the order by left sides;
    of the ones in the same run of both orders, all but the least are later
    occurrences. Only for the least ones of a run that may go on beyond these
    rows the words themselves go out as a key (k1, k2): equal ones meet there.
    """
    column = {name: rows[name].combine_chunks() for name in _CONTEXT_NAMES}
    n = rows.num_rows
    doc, t1, place, h1, h2 = (column[c].to_numpy() for c in ("doc", "t1", "place", "head", "head2"))
    right, n_right = _word_codes(column["right"])
    left, n_left = _word_codes(column["left"])
    same_head = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
    common = np.full(n, -1)
    common[1:] = np.where(same_head, _common(right[1:], right[:-1]), -1)
    head = np.append(0, np.cumsum(~same_head))
    by_left = np.lexsort((*left.T[::-1], head))
    ordered = left[by_left]
    common_left = np.full(n, -1)
    common_left[1:] = np.where(head[by_left][1:] == head[by_left][:-1], _common(ordered[1:], ordered[:-1]), -1)
    order = np.lexsort((place, t1, doc))
    new = np.ones(n, bool)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (t1[order][1:] != t1[order][:-1]) | (place[order][1:] != place[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(new) - 1
    row_of = order[new]

    none = np.iinfo(np.int64).max
    low, high, by = np.full(n, -1), np.full(n, -1), np.full(n, none)  # words on the left of a suffix's later runs, and its earlier one
    first_low, first_high, first_by = low.copy(), high.copy(), by.copy()
    left_run = np.empty(n, np.int64)
    asked: list[tuple[np.ndarray, int]] = []
    for r in range(SIDE, -1, -1):
        before = SIDE - r
        run = np.cumsum(common < r) - 1
        size = np.bincount(run)
        at_edge = (run == 0) | (run == run[-1])
        looked = np.flatnonzero(((size[run] > 1) | at_edge) & (n_left >= before) & (n_right >= r))
        if not len(looked):
            continue
        left_run[by_left] = np.cumsum(common_left < before)
        both = run[looked] * (n + 1) + left_run[looked]
        sorted_ = np.argsort(both, kind="stable")
        looked, both = looked[sorted_], both[sorted_]
        starts = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        least = np.repeat(np.minimum.reduceat(rank[looked], starts), np.diff(np.append(starts, len(looked))))
        later = rank[looked] > least
        a, b = looked[later], row_of[least[later]]
        low[a] = np.where(low[a] < 0, before, low[a])
        high[a] = before
        by[a] = np.minimum(by[a], least[later])
        first_low[b] = np.where(first_low[b] < 0, before, first_low[b])
        first_high[b] = before
        np.minimum.at(first_by, b, rank[a])
        asked.append((looked[~later & at_edge[looked]], before))

    out: list[np.ndarray] = [[] for _ in range(8)]
    for lows, highs, others, first in ((low, high, by, False), (first_low, first_high, first_by, True)):
        at = np.flatnonzero(highs >= 0)
        spans = (doc[at], t1[at], place[at] - highs[at], place[at] - lows[at] + MIN_WORDS, doc[row_of[others[at]]], np.full(len(at), first))
        for c, values in zip(out, spans, strict=False):
            c.append(values)
    n_spans = sum(map(len, out[0]))
    keys = []
    for x, before in asked:
        for k in x.tolist():
            words = [*column["left"][k].as_py().split()[:before], b"", *column["right"][k].as_py().split()[: SIDE - before]]
            key = xxhash.xxh3_128_intdigest(b"%d %d " % (h1[k], h2[k]) + b" ".join(words))
            keys.append(((key >> 64) - (1 << 63), (key & ((1 << 64) - 1)) - (1 << 63)))
        for c, values in zip(out, (doc[x], t1[x], place[x] - before, place[x] - before + MIN_WORDS), strict=False):
            c.append(values)
    columns = [np.concatenate(c) for c in out[:4]]
    spare = len(keys)
    arrays = [pa.array(c, pa.int64()) for c in columns]
    arrays += [pa.concat_arrays([pa.array(np.concatenate(c), t), pa.nulls(spare, t)]) for c, t in zip(out[4:6], _FOUND_TYPES[4:6], strict=True)]
    arrays += [pa.concat_arrays([pa.nulls(n_spans, pa.int64()), pa.array([key[k] for key in keys], pa.int64())]) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(arrays, _FOUND_NAMES)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes, a chunk at a time; a run that a chunk's end cuts is one that may go on."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= CHUNK:
            yield _settled(pa.Table.from_batches(held))
            held = []
    if any(x.num_rows for x in held):
        yield _settled(pa.Table.from_batches(held))


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start_word, n_words, match_doc_id, kept: merged spans of words that stand elsewhere too.

    Words are runs of other characters than ASCII spaces, compared as they are.
    ``kept`` spans are first occurrences, by document, then place; for each
    other span ``match_doc_id`` is the least document among those that showed it
    as a later one. The two kinds of a document don't overlap, so a kept span
    can be shorter than ``MIN_WORDS``. An exact copy of a text with
    ``MIN_WORDS`` words gives one span over all of it, from the least id with
    this text; only that one is searched further. Shorter and null texts give no
    rows. Null ids take no part; rows that repeat an id and its text are one
    document, and of different texts under one id each is searched. Other
    columns aren't read. An empty table gives an empty result.
    """
    return _spans(docs, doc_id, text).select(
        F.col("doc").alias("doc_id"),
        F.col("start").alias("start_word"),
        (F.col("end") - F.col("start")).alias("n_words"),
        F.col("other").alias("match_doc_id"),
        F.col("first").alias("kept"),
    )


def _spans(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, t1, start, end, other, first): the rows of ``repeated_passages`` with the hash of their text."""
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    base = base.filter(F.col("doc").isNotNull() & F.col("text").isNotNull())
    keyed = base.select("doc", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), "text")
    anchors = Saved(keyed.mapInArrow(_anchors, _ANCHOR), "anchors")
    hashed = anchors.df.filter("place < 0").select("doc", "t1", "t2", F.col("head").alias("n_words")).distinct()
    hashed = saved(hashed, "texts")
    texts = saved(hashed.groupBy("t1", "t2").agg(F.min("doc").alias("least"), F.count("*").alias("n"), F.first("n_words").alias("n_words")), "distinct-texts")
    shared = texts.filter("n > 1")
    copies = hashed.join(shared.select("t1", "t2", "least"), ["t1", "t2"]).filter("doc != least")
    copies = copies.select("doc", "t1", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"), F.col("least").alias("other"), F.lit(False).alias("first"))
    copied = shared.join(hashed.select("t1", "t2", "doc"), ["t1", "t2"]).filter("doc != least").groupBy("t1", "least", "n_words").agg(F.min("doc").alias("other"))
    copied = copied.select(F.col("least").alias("doc"), "t1", F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"), "other", F.lit(True).alias("first"))

    # Only light rows are shuffled until the texts of documents with a head that returns are fetched, once.
    # A head at one place of one text, however often that is copied, doesn't return.
    suffixes = anchors.df.filter("place >= 0").select("doc", "t1", "place", "head")
    spot = F.xxhash64("t1", "place")
    again = suffixes.groupBy("head").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).filter("a != b").select("head")
    again = saved(again, "heads")
    places = suffixes.join(again, "head", "left_semi")
    # One text of each group of copies is searched.
    places = places.join(texts.select("t1", F.col("least").alias("doc")), ["doc", "t1"], "left_semi")
    places = places.groupBy("doc", "t1").agg(F.collect_set(F.struct("place", "head")).alias("found"))
    met = keyed.select("doc", "t1", "text").join(places, ["doc", "t1"]).select("doc", "t1", "text", "found")
    contexts = Saved(met.mapInArrow(_contexts, _CONTEXT), "contexts")
    anchors.remove()
    order = ["head", "head2", "right", "doc", "t1", "place"]
    # A head with a third of all rows spreads over ranges.
    ranged = contexts.df.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    found = saved(ranged.mapInArrow(_compared, _FOUND), "compared")
    contexts.remove()

    columns = ["doc", "t1", "start", "end", "other", "first"]
    spot = F.struct("doc", "t1", "start")
    keys = found.filter(F.col("k1").isNotNull())
    first = keys.groupBy("k1", "k2").agg(F.min(spot).alias("spot"), F.max(spot).alias("last")).filter(F.col("spot") != F.col("last"))
    first = saved(first.select("k1", "k2", "spot"), "first-runs")
    pairs = saved(keys.select("k1", "k2", "doc", "t1", "start", "end").join(first, ["k1", "k2"]).filter(spot != F.col("spot")).select("doc", "t1", "start", "end", "spot"), "later-runs")
    shown = pairs.groupBy("spot").agg(F.min("doc").alias("other"))
    shown = shown.select("spot.*", (F.col("spot.start") + MIN_WORDS).alias("end"), "other", F.lit(True).alias("first"))
    later = pairs.select("doc", "t1", "start", "end", F.col("spot.doc").alias("other"), F.lit(False).alias("first"))

    spans = found.filter(F.col("k1").isNull()).select(*columns).unionByName(later).unionByName(shown).unionByName(copies).unionByName(copied)
    # What is a later occurrence by any match is one: it's taken off the spans that seem first.
    merged = saved(_merged(spans), "spans")
    seems = merged.filter("first").select("doc", "t1", "start", "end", "other")
    gone = merged.filter(~F.col("first")).groupBy("doc", "t1").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gone"))
    left = seems.join(gone, ["doc", "t1"], "left")
    left = left.withColumn("inside", F.filter(F.coalesce("gone", F.array().cast("array<struct<start:bigint,end:bigint>>")), lambda g: (g["end"] > F.col("start")) & (g["start"] < F.col("end"))))
    pieces = F.zip_with(
        F.concat(F.array("start"), F.transform("inside", lambda g: g["end"])),
        F.concat(F.transform("inside", lambda g: g["start"]), F.array("end")),
        lambda a, b: F.struct(a.alias("start"), b.alias("end")),
    )
    left = left.select("doc", "t1", "other", F.explode(F.filter(pieces, lambda x: x["end"] > x["start"])).alias("x"))
    left = left.select("doc", "t1", F.col("x.start").alias("start"), F.col("x.end").alias("end"), "other", F.lit(True).alias("first"))
    return merged.filter(~F.col("first")).select(*columns).unionByName(left)


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping spans of one text and kind as one: a span starts a new one beyond all ends before it."""
    own = Window.partitionBy("doc", "t1", "first").orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.distinct().withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
    marked = marked.withColumn("span", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("doc", "t1", "first", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("other").alias("other"))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the words of spans that aren't kept left out of the text, and the space after each of them.

    Spans meet rows by id and text, so different texts under one id lose only
    their own. Rows with a null id or text, texts without such spans and other
    columns stay as they are, whatever their names; repeated rows are cut alike.
    An empty table gives an empty result.
    """
    columns = docs.columns
    gone = _spans(docs, doc_id, text).filter(~F.col("first"))
    gone = gone.groupBy("doc", "t1").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gone"))
    word = re.compile(rf"{WORD_CLASS}+")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for body, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if body is not None and spans:
                    at = [m.start() for m in word.finditer(body)] + [len(body)]
                    kept, end = [], 0
                    for s in spans:
                        kept.append(body[end : at[min(s["start"], len(at) - 1)]])
                        end = at[min(s["end"], len(at) - 1)]
                    body = "".join(kept) + body[end:]
                texts.append(body)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["row", "text"])

    body = F.col(f"`{text}`").cast("string")
    row = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)]).alias("row"), body.alias("text"), F.col(f"`{doc_id}`").cast("long").alias("doc"), F.xxhash64(body).alias("t1"))
    met = row.join(gone, ["doc", "t1"], "left").select("row", "text", "gone")
    done = met.mapInArrow(cut, T.StructType([T.StructField("row", row.schema["row"].dataType), T.StructField("text", T.StringType())]))
    return done.select(*[F.col("text").alias(c) if c == text else F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(columns)])
