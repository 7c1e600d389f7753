"""The array side of ``holdings.overlap``: books packed into blobs, and blobs that meet in numpy.

A blob holds whole books of one quarter: managers, positions of each, codes into
the blob's own list of securities, and weights. A unit is a share of a quarter's
blobs in memory, 2^20 positions or so; the quarter's other blobs are streamed past it. Blocks
of a unit meet by sums of lesser weights in small integers, rounded up; only
pairs whose sum could be among a manager's best are weighed exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Positions read before blobs are made of them, cells of a block of dense weights, rows of a strip that stays in cache.
CHUNK, CELLS, STRIP = 1 << 18, 1 << 22, 64
#: Books of more positions are summed in 32 bits, as each position is rounded up.
LONG_BOOK = 512
#: Pairs weighed at once; what a key's imaginary part has for the number of shared securities.
PAIRS, SHARED = 1 << 17, 1 << 21


def pack(fields: str, kinds: dict[str, pa.DataType], chunk: int = CHUNK) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function from positions (q, manager, security, w), those of a book together, to blobs, one a quarter and chunk."""

    def blobs(rows: pa.Table, first: int) -> Iterator[dict]:
        qs = rows["q"].to_numpy()
        order = np.argsort(qs, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(qs[order])) + 1) if len(order) else []:
            some = rows.take(pa.array(at))
            managers = some["manager"].combine_chunks().dictionary_encode()
            ends = np.append(np.flatnonzero(np.diff(managers.indices.to_numpy())) + 1, len(at))
            starts = np.append(0, ends[:-1])
            coded = some["security"].combine_chunks().dictionary_encode()
            codes = coded.indices.to_numpy().astype(np.min_scalar_type(len(coded.dictionary)))
            yield {
                "q": int(qs[at[0]]), "id": first, "n": len(at), "managers": some["manager"].take(pa.array(starts)).combine_chunks(), "securities": coded.dictionary,
                "counts": (ends - starts).astype(np.int32).tobytes(), "codes": codes.tobytes(), "weights": some["w"].to_numpy().astype(np.float64).tobytes(),
            }
            first += 1

    def batch(found: list[dict]) -> pa.RecordBatch:
        columns = []
        for name in fields.split():
            values = [b[name] for b in found]
            if name in ("managers", "securities"):
                flat = pa.concat_arrays([v.cast(kinds[name]) for v in values])
                columns.append(pa.ListArray.from_arrays(np.cumsum([0, *map(len, values)]).astype(np.int32), flat))
            else:
                columns.append(pa.array(values, kinds[name]))
        return pa.record_batch(columns, fields.split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, n = TaskContext.get().partitionId() << 32, [], 0
        for one in batches:
            held.append(one)
            n += one.num_rows
            if n < chunk:
                continue
            rows = pa.Table.from_batches(held)
            book = rows["manager"].combine_chunks().dictionary_encode().indices.to_numpy()
            new = np.flatnonzero((np.diff(book) != 0) | (np.diff(rows["q"].to_numpy()) != 0)) + 1
            cut = int(new[-1]) if len(new) else 0  # the last book may go on
            found = list(blobs(rows.slice(0, cut), number))
            if found:
                number += len(found)
                yield batch(found)
            held, n = rows.slice(cut).to_batches(), len(rows) - cut
        found = list(blobs(pa.Table.from_batches(held), number)) if n else []
        if found:
            yield batch(found)

    return run


class Block:
    """Some books as dense columns: ``q`` small integers by security, ``w`` exact weights by book."""

    def __init__(self, start: int, rank: np.ndarray, row: np.ndarray, code: np.ndarray, small: np.ndarray, w: np.ndarray, securities: int):
        self.start, self.rank, self.n = start, rank, len(rank)
        self.q, self.w = np.zeros((securities, self.n), small.dtype), np.zeros((self.n, securities))
        self.q[code, row], self.w[row, code] = small, w
        self.held = np.zeros((self.n, securities), bool)
        self.held[row, code] = True
        self.counts = np.bincount(code, minlength=securities)


def bounds(a: Block, b: Block) -> np.ndarray:
    """For each pair of books the sum of the lesser rounded-up weights: never less than the exact one."""
    out = np.zeros((a.n, b.n), a.q.dtype)
    dense = []
    for k in np.flatnonzero((a.counts > 0) & (b.counts > 0)):
        if 16 * a.counts[k] * b.counts[k] < a.n * b.n:
            x, y = np.flatnonzero(a.q[k]), np.flatnonzero(b.q[k])
            out[np.ix_(x, y)] += np.minimum.outer(a.q[k, x], b.q[k, y])
        else:
            dense.append(k)
    less = np.empty((STRIP, b.n), out.dtype)
    for r in range(0, a.n, STRIP):
        rows = out[r : r + STRIP]
        for k in dense:
            np.minimum(a.q[k, r : r + STRIP, None], b.q[k], out=less[: len(rows)])
            rows += less[: len(rows)]
    return out


class Unit:
    """A share of a quarter's books and the best peers of each, found among all books of the quarter."""

    def __init__(self, q: int, peers: int, block: int):
        self.q, self.peers, self.block, self.own, self.others, self.ready = q, peers, block, [], [], False

    def add(self, side: int, blob: dict) -> None:
        """Sides 0: a blob of the share, 1: the names of another blob, 2: that blob."""
        if side == 0:
            self.own.append(blob)
        elif not self.ready and not self.own:
            return  # no blob was dealt to this share
        elif side == 1:
            self.others.append((blob["id"], blob["managers"]))
        else:
            self.prepare()
            self.stream(blob)

    def prepare(self) -> None:
        if self.ready:
            return
        self.ready = True
        blobs, self.own = self.own, None
        names = pa.concat_arrays([b["managers"] for b in blobs] + [m for _, m in self.others])
        order = np.argsort(names.to_numpy(zero_copy_only=False), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.names = names.take(pa.array(order))
        self.rank = rank[: (n := sum(len(b["managers"]) for b in blobs))]
        self.other, at = {}, n
        for number, m in self.others:
            self.other[number] = rank[at : at + len(m)]
            at += len(m)
        self.codes = {}
        for b in blobs:
            for s in b["securities"].to_pylist():
                self.codes.setdefault(s, len(self.codes))
        row, code, w = (np.concatenate(x) for x in zip(*(self.unpack(b) for b in blobs), strict=True))
        row += np.repeat(np.cumsum([0, *(len(b["managers"]) for b in blobs[:-1])]), [b["n"] for b in blobs])
        self.longest = int(np.bincount(row).max())
        kind = np.uint16 if self.longest <= LONG_BOOK else np.uint32
        self.most = np.iinfo(kind).max
        sums = np.bincount(row, np.maximum(w, 0), n)
        self.scale, self.kind, self.negative = (self.most - self.longest - 1) / (sums.max() or 1.0), kind, bool((w < 0).any())
        self.state = np.full((n, self.peers), np.inf, np.complex128)
        self.least = np.ones(n, kind)
        self.size = size = max(1, min(self.block, max(STRIP, CELLS // len(self.codes))))
        small, ends = self.small(w), np.searchsorted(row, np.arange(0, n + size, size))
        parts = [(k * size, slice(ends[k], ends[k + 1])) for k in range(-(-n // size))]
        make = lambda start, s: Block(start, self.rank[start : start + size], row[s] - start, code[s], small[s], w[s], len(self.codes))
        self.blocks = lambda after=0: (make(*p) for p in parts[after:])
        for k, a in enumerate(self.blocks()):
            self.meet(a, a)
            for b in self.blocks(k + 1):
                self.meet(a, b)

    def unpack(self, blob: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Book, code and weight of each position; a security that the share doesn't hold has a code of -1."""
        counts = np.frombuffer(blob["counts"], np.int32)
        own = np.frombuffer(blob["codes"], f"u{len(blob['codes']) // blob['n']}")
        table = np.array([self.codes.get(s, -1) for s in blob["securities"].to_pylist()], np.int64)
        return np.repeat(np.arange(len(counts)), counts), table[own], np.frombuffer(blob["weights"], np.float64)

    def small(self, w: np.ndarray) -> np.ndarray:
        return np.clip(np.ceil(np.maximum(w, 0) * self.scale), 1, self.most).astype(self.kind)

    def stream(self, blob: dict) -> None:
        row, code, w = self.unpack(blob)
        rank, known = self.other[blob["id"]], code >= 0
        row, code, w = row[known], code[known], w[known]
        for start in range(0, len(rank), self.size):
            s = slice(*np.searchsorted(row, [start, start + self.size]))
            b = Block(-1, rank[start : start + self.size], row[s] - start, code[s], self.small(w[s]), w[s], len(self.codes))
            for a in self.blocks():
                self.meet(a, b)

    def meet(self, a: Block, b: Block) -> None:
        """Books of ``a`` take peers of ``b`` and the reverse; those of a streamed block (start -1), or of the same one, the first only."""
        top, both = bounds(a, b), b.start not in (-1, a.start)
        if a.start == b.start:
            np.fill_diagonal(top, 0)
        self.raise_least(a, top)
        mask = top >= self.least[a.start : a.start + a.n, None]
        if both:
            self.raise_least(b, top.T)
            mask |= top >= self.least[b.start : b.start + b.n]
        flat = np.flatnonzero(mask)
        for at in range(0, len(flat), PAIRS):
            i, j = np.divmod(flat[at : at + PAIRS], b.n)
            held = a.held[i] & b.held[j]
            less = np.minimum(a.w[i], b.w[j])
            total = np.where(held, less, 0.0).sum(1) * 1e6
            micro, shared = np.trunc(total + np.copysign(0.5, total)), held.sum(1)
            self.take(a.start + i, micro, b.rank[j], shared)
            if both:
                by = np.argsort(j, kind="stable")
                self.take(b.start + j[by], micro[by], a.rank[i[by]], shared[by])

    def raise_least(self, a: Block, top: np.ndarray) -> None:
        """A book without all its peers yet: as many sums of this block are at least so much, less what was rounded up."""
        s = slice(a.start, a.start + a.n)
        open_ = np.flatnonzero(np.isinf(self.state[s, -1].real))
        if self.negative or top.shape[1] < self.peers or not len(open_):
            return
        kth = np.partition(top[open_], top.shape[1] - self.peers, axis=1)[:, -self.peers].astype(np.int64)
        self.least[a.start + open_] = np.maximum(self.least[a.start + open_], np.maximum(kth - self.longest - 1, 1).astype(self.kind))

    def take(self, rows: np.ndarray, micro: np.ndarray, rank: np.ndarray, shared: np.ndarray) -> None:
        """Pairs of ascending rows go into the best of each: the greatest overlap, then the least name."""
        good = -micro <= self.state[rows, -1].real
        rows = rows[good]
        if not len(rows):
            return
        keys = np.empty(len(rows), np.complex128)
        keys.real, keys.imag = -micro[good], rank[good] * SHARED + shared[good]
        starts = np.append(0, np.flatnonzero(np.diff(rows)) + 1)
        counts, touched = np.diff(np.append(starts, len(rows))), rows[starts]
        all_ = np.full((len(touched), self.peers + counts.max()), np.inf, np.complex128)
        all_[:, : self.peers] = self.state[touched]
        all_[np.repeat(np.arange(len(touched)), counts), self.peers + np.arange(len(rows)) - np.repeat(starts, counts)] = keys
        all_.sort(axis=1)
        self.state[touched] = all_[:, : self.peers]
        last = -all_[:, self.peers - 1].real
        full = np.isfinite(last)
        needed = np.clip(np.floor((last[full] - 0.51) / 1e6 * self.scale), 1, self.most).astype(self.kind)
        self.least[touched[full]] = np.maximum(self.least[touched[full]], needed)

    def rows(self, strip: int = 4096) -> Iterator[pa.RecordBatch]:
        if not self.ready and not self.own:
            return
        self.prepare()
        for start in range(0, len(self.state), strip):
            keys = self.state[start : start + strip]
            book, place = np.nonzero(np.isfinite(keys.real))
            found = keys[book, place]
            packed = found.imag.astype(np.int64)
            manager, peer = self.names.take(pa.array(self.rank[start + book])), self.names.take(pa.array(packed // SHARED))
            columns = [manager, pa.array(np.full(len(book), self.q), pa.int32()), peer, pa.array(-found.real / 1e6), pa.array(packed % SHARED), pa.array(place + 1, pa.int32())]
            yield pa.record_batch(columns, ["manager", "q", "peer", "overlap", "shared", "rank"])


def meet(peers: int, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function from blobs (q, s, side and a blob's fields), sorted by q, s and side, to each manager's ``peers`` best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = unit = None
        for one in batches:
            for k in range(one.num_rows):
                row = {name: one.column(name)[k] for name in one.schema.names}
                q, s, side = (row.pop(x).as_py() for x in ("q", "s", "side"))
                if (q, s) != key:
                    if unit:
                        yield from unit.rows()
                    key, unit = (q, s), Unit(q, peers, block)
                unit.add(side, {name: v.values if name in ("managers", "securities") else v.as_py() for name, v in row.items()})
        if unit:
            yield from unit.rows()

    return run
