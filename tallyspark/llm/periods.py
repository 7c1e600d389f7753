"""Periodic runs of words, by a suffix automaton whose end-position sets merge small into large.

Words that can lie in a run are in a short n-gram that occurs twice in their
text; arrays find those stretches for many texts at once. Each stretch gets an
automaton. States are visited from the longest on, and each one's ordered set of
end positions merges into its link's set: where two positions become neighbours
at a distance within the state's length, a square ends, and a square that
neither side prolongs any more is a run.
"""

from __future__ import annotations

import itertools
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of texts that are numbered at once, and positions in a block of an ordered set.
CHUNK_WORDS, BLOCK = 500_000, 1024


class Positions:
    """An ordered set of positions in blocks of bounded size."""

    def __init__(self, first: int):
        self.blocks, self.last, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        return itertools.chain.from_iterable(self.blocks)

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Takes ``x`` in and gives the positions before and after it."""
        b = min(bisect_left(self.last, x), len(self.blocks) - 1)
        block = self.blocks[b]
        at = bisect_left(block, x)
        before = block[at - 1] if at else self.last[b - 1] if b else None
        after = block[at] if at < len(block) else None  # x beyond a block is beyond all
        insort(block, x)
        self.last[b] = block[-1]
        self.size += 1
        if len(block) > 2 * BLOCK:
            self.blocks[b : b + 1] = [block[:BLOCK], block[BLOCK:]]
            self.last[b : b + 1] = [block[BLOCK - 1], block[-1]]
        return before, after


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length, suffix link and end position (-1 for a copied state) of each state."""
    steps: list[dict[int, int]] = [{}]
    length, link, end = [0], [-1], [-1]
    newest = 0
    for at, word in enumerate(words):
        state, newest = newest, len(steps)
        steps.append({})
        length.append(at + 1)
        end.append(at)
        link.append(0)
        while state >= 0 and word not in steps[state]:
            steps[state][word] = newest
            state = link[state]
        if state < 0:
            continue
        met = steps[state][word]
        if length[met] > length[state] + 1:
            copy = len(steps)
            steps.append(steps[met].copy())
            length.append(length[state] + 1)
            end.append(-1)
            link.append(link[met])
            link[met] = copy
            while state >= 0 and steps[state].get(word) == met:
                steps[state][word] = copy
                state = link[state]
            met = copy
        link[newest] = met
    return length, link, end


def shortest_state(exponent: int, least: int) -> int:
    """The least overlap of a run with itself, one period on."""
    return max(1, min(max(least - q, (exponent - 1) * q) for q in range(1, least + 1)))


def squares_to_runs(words: list[int], exponent: int, least: int) -> dict[tuple[int, int], int]:
    """{(start, end): smallest period} of the maximal runs of ``words``; ``end`` is the last word's number."""
    length, link, end = automaton(words)
    floor, n = shortest_state(exponent, least), len(words)
    sets = [Positions(e) if e >= 0 else None for e in end]
    runs: dict[tuple[int, int], int] = {}

    def seed(left: int, right: int, common: int) -> None:
        period, start = right - left, left - common + 1
        if period > common or common + period < max(least, exponent * period):
            return
        if right + 1 < n and words[left + 1] == words[right + 1]:
            return  # the pair one further right has this run
        if start > 0 and words[start - 1] == words[start - 1 + period]:
            return  # a longer state has this run
        runs[start, right] = min(period, runs.get((start, right), period))

    for state in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
        above, own = link[state], sets[state]
        sets[state] = None
        if length[above] < floor:
            continue
        into = sets[above]
        if into is None:
            sets[above] = own
            continue
        if into.size < own.size:
            into, own = own, into
        for x in own:
            before, after = into.add(x)
            if before is not None:
                seed(before, x, length[above])
            if after is not None:
                seed(x, after, length[above])
        sets[above] = into
    return runs


def _stretches(ids: np.ndarray, edges: np.ndarray, gram: int) -> list[tuple[int, int]]:
    """Ends of the stretches of words that lie in a gram found twice in its text; texts lie between ``edges``."""
    n = len(ids)
    if n < gram:
        return []
    text = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    mixed = text[: n - gram + 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(gram):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[j : n - gram + 1 + j].astype(np.uint64)
    whole = text[: n - gram + 1] == text[gram - 1 :]
    ordered = np.sort(mixed[whole])
    again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])  # two grams of one hash only add a stretch
    if not len(again):
        return []
    starts = np.flatnonzero(whole & (again[np.minimum(np.searchsorted(again, mixed), len(again) - 1)] == mixed))
    change = np.zeros(n + 1, np.int64)
    change[starts] += 1
    change[starts + gram] -= 1
    inside = np.cumsum(change[:-1]) > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = edges[:-1][edges[:-1] < edges[1:]]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[heads[1:] - 1] = inside[heads[1:] - 1]
    return list(zip(np.flatnonzero(first).tolist(), (np.flatnonzero(last) + 1).tolist(), strict=True))


def runs_of_texts(texts: list[list[bytes]], exponent: int, least: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs by start, then period."""
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    edges = np.cumsum([0, *map(len, texts)])
    ids = np.fromiter(map(numbers.__getitem__, itertools.chain.from_iterable(texts)), np.int64, int(edges[-1]))
    gram = max(1, min(max(least, exponent * q) - 2 * q + 1 for q in range(1, least + 1)))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in _stretches(ids, edges, gram):
        text = int(np.searchsorted(edges, a, "right")) - 1
        at = a - int(edges[text])
        for (start, end), period in squares_to_runs(ids[a:b].tolist(), exponent, least).items():
            found[text].append((at + start, end - start + 1, period))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: what follows its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep)]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _scan(exponent: int, least: int):
    def some(ids: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of_texts(texts, exponent, least)
        kept = [b" ".join(collapsed(w, r)) for w, r in zip(texts, runs, strict=True)]
        found = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in of] for of in runs], pa.list_(_RUN))
        counts = pa.array([len(w) for w in texts], pa.int64())
        return pa.RecordBatch.from_arrays([ids, counts, found, pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, n, texts = 0, 0, []
            for k, text in enumerate(batch.column(1).cast(pa.binary())):
                words = (text.as_py() or b"").split()  # bytes are split at the six separators of words and no others
                texts.append(words)
                n += len(words)
                if n >= CHUNK_WORDS:
                    yield some(batch.column(0).slice(first, len(texts)), texts)
                    first, n, texts = k + 1, 0, []
            if texts:
                yield some(batch.column(0).slice(first, len(texts)), texts)

    return run


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", exponent: int = 4, least: int = 6) -> DataFrame:
    """doc_id, n_words, runs and collapsed for each row of ``docs``.

    ``runs`` holds (start, length, period) of each maximal stretch of words that
    has that smallest period and is at least ``least`` words and ``exponent``
    (2 or more) periods long, by start, then period; ``collapsed`` joins by one
    space the words that no run repeats. A null, empty or wordless text has no
    words, no runs and an empty ``collapsed``. Each row is scanned by itself
    where it lies: repeated rows fare alike, ids may be null or of any type,
    other columns aren't read, an empty table gives an empty result. Runs may
    overlap; ties don't arise, as a stretch has one smallest period.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_scan(exponent, least), f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def longest_run(runs: Column) -> Column:
    """The longest run, of equals the one of the least start, then period; null without runs."""
    by_length = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(by_length)
