"""Best-fit packing of token sequences, bettered by swaps between underfull bins.

Documents become pieces of at most a sequence's length. Leaves of pieces are
packed best fit, largest first; then a local search exchanges pieces between
bins that aren't full - one for one, two for one, or a plain move - whenever the
sum of squared fills grows, until bins empty. Bins that stay underfull are dealt
anew and searched again together with those of other leaves.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tallyspark.llm.common import saved

CAPACITY = 1024
END_ID = 2
#: Pieces in a leaf and in a later group, later rounds, and passes of the search over a group's bins.
LEAF, ROUNDS, PASSES = 8192, 3, 4
#: A later group has this many times the pieces of one in the round before, up to GROWN times a leaf's.
GROWTH, GROWN = 4, 8
#: Equal pieces that go to a leaf together.
SAME = 512
#: Sizes, and bins with a size, that the search for one exchange looks at.
TRIES = 8

#: The vocabulary's own pattern starts a token at a space between two characters of _PLAIN, and between
#: a letter and a mark or a single line feed; the apostrophe is no such mark.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARK = r"!-&(-/:-@\[-`{-~"
_PLAIN = frozenset(c for c in map(chr, range(33, 256)) if re.match(rf"[!-~{_LETTER}]", c))
_BETWEEN = re.compile(rf"(?<=[{_LETTER}])(?=[{_MARK}\n])|(?<=[{_MARK}])(?=[{_LETTER}])|(?<=[{_LETTER}{_MARK}]\n)(?=[{_LETTER}])")
_MARKS = "".join(c for c in map(chr, range(33, 127)) if re.match(rf"[{_MARK}]", c))
_WORD = re.compile(rf" ?[{_LETTER}]+")
#: Bytes of texts that are looked up together.
BLOCK = 8 << 20
#: Strings with known ids that a worker keeps, and the longest of them.
KNOWN, LONGEST = 700_000, 64
_PACK = [struct.Struct(f"<{n}I").pack for n in range(LONGEST)]


class Ids:
    """Ids of texts by a tokenizers file, as little-endian unsigned 32-bit integers.

    A text is cut at spaces where a token starts, and the tokenizer is asked
    once for each distinct piece; what can't be cut there, such as a long run of
    white space, it gets as a whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.exact = Tokenizer.from_file(path)
        self.merge = self.exact.model.tokenize
        spell = ByteLevel(add_prefix_space=False).pre_tokenize_str
        self.spelled = {ord(c): spell(c)[0][0] for c in (" ", *_PLAIN) if _WORD.fullmatch(f" {c}".rstrip()) or c == " "}
        self.space = self.spelled[ord(" ")]
        special = [re.escape(t.content) for t in self.exact.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or r"(?!)").search
        self.known: dict[str, bytes] = {}  # of pieces after a space
        self.parts: dict[str, bytes] = {}

    def _merged(self, word: str) -> bytes:
        """A word of the pattern, spelled as the vocabulary does: straight to its merges."""
        ids = [t.id for t in self.merge(word)]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def _asked(self, part: str) -> bytes:
        """One token by the pattern, or any other text."""
        if _WORD.fullmatch(part):
            return self._merged(part.translate(self.spelled))
        ids = self.exact.encode(part, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            found = self._asked(part)
            if len(part) <= LONGEST:
                if len(self.parts) >= KNOWN:
                    self.parts.clear()
                self.parts[part] = found
        return found

    def _word(self, word: str) -> bytes:
        """A space and letters, of which the first and the last are plain: no cut."""
        found = self.known.get(word)
        if found is None:
            found = self._merged(self.space + word) if word.isascii() else self._asked(" " + word)
            if len(word) <= LONGEST:
                self.known[word] = found
        return found

    def _whole(self, text: str) -> bytes:
        if self.special(text):
            return self._part(text)
        word = text[1:].rstrip(_MARKS)
        if text[:1] == " " and word.isalpha() and word[0] in _PLAIN and word[-1] in _PLAIN:
            return self._word(word) + self._part(text[len(word) + 1 :])
        head, *parts = _BETWEEN.split(text)
        return b"".join([self._whole(head), *map(self._part, parts)]) if parts else self._part(head)

    def _pieces(self, pieces: list[str]) -> list[bytes | None]:
        """Of each piece the ids with a space ahead; none if no token starts or ends with the piece."""
        found = list(map(self.known.get, pieces))
        for k in [k for k, ids in enumerate(found) if ids is None]:
            x = pieces[k]
            if x and x[0] in _PLAIN and x[-1] in _PLAIN:
                if x.isalpha():
                    found[k] = self._word(x)
                else:
                    found[k] = own = self._whole(" " + x)
                    if len(x) <= LONGEST and "\n" not in x:  # the ends of two lines seldom meet again
                        self.known[x] = own
        return found

    def _uneven(self, pieces: list[str]) -> bytes:
        """For texts with pieces that no token starts or ends with: those stay with the ones around them."""
        out, group, lead = [], [pieces[0]], ""
        for x in pieces[1:]:
            before = group[-1]
            if before and before[-1] in _PLAIN and x and x[0] in _PLAIN:
                out.append(self.known[before] if lead and len(group) == 1 and before in self.known else self._whole(lead + " ".join(group)))
                group, lead = [x], " "
            else:
                group.append(x)
        return b"".join([*out, self._whole(lead + " ".join(group))])

    def packed(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each text's with ``end`` behind, and where each text's end."""
        split = pc.split_pattern(texts, " ")
        words = split.flatten().dictionary_encode()
        which, spelled = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False)
        at, n, rows = split.offsets.to_numpy(), len(spelled), np.arange(len(texts))
        first = at[:-1]
        led = np.ones(len(which), bool)
        led[first] = False
        asked = np.zeros(n, bool)
        asked[which[led]] = True
        found = np.full(n, b"", object)
        found[asked] = self._pieces(spelled[asked].tolist())
        odd = np.equal(found, None)
        found[odd] = b""
        uneven = np.logical_or.reduceat(odd[which] & led, first)
        firsts = []
        for k, x in enumerate(spelled[which[first]].tolist()):
            uneven[k] |= not x or x[-1] not in _PLAIN
            firsts.append(self._uneven(texts[k].as_py().split(" ")) if uneven[k] else self._whole(x))
        bodies = [*found, end, b"", *firsts]
        if len(self.known) >= KNOWN:
            self.known.clear()
        # which body each piece has, and each text's end behind its last one; an uneven text has all ids in its first
        body = np.insert(which, at[1:], n)
        body[first + rows] = n + 2 + rows
        body[np.repeat(uneven, np.diff(at) + 1) & (body < n)] = n + 1
        sizes = np.fromiter(map(len, bodies), np.int64, len(bodies)) // 4
        starts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(bodies), "<u4")
        sizes = sizes[body]
        ends = np.cumsum(sizes)
        narrow = np.int32 if max(len(ids), ends[-1]) < 2**31 else np.int64
        take = np.repeat((starts[body] - ends + sizes).astype(narrow), sizes)
        take += np.arange(len(take), dtype=narrow)
        return ids[take], ends[at[1:] + rows]

    def __call__(self, text: str) -> list[int]:
        return self.packed(pa.array([text]))[0].tolist()


_TOKENIZERS: dict[str, Ids] = {}


def tokenizer(path: str) -> Ids:
    """Text to ids by the byte-level vocabulary at ``path`` (a tokenizers file), once a worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Ids(path)
    return _TOKENIZERS[path]


def blocks(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of texts: in each, those behind the first hold less than ``BLOCK`` bytes together."""
    block = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64) // BLOCK
    at = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]
    return [(low, high) for low, high in zip(at, at[1:], strict=False) if low < high]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full ones after a first that may be shorter."""
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of every document's ids, the end id last; ``with_ids`` adds them as an array."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([END_ID], "<u4").tobytes()
        for b in batches:
            out: list[list] = [[] for _ in names]
            keys, texts = b.column(0).to_pylist(), pc.fill_null(b.column(1), "")
            for low, high in blocks(texts):
                ids, ends = tokenizer(path).packed(texts[low:high], end)
                for key, own in zip(keys[low:high], np.split(ids, ends[:-1]), strict=True):
                    for k, (at, n) in enumerate(cut(len(own), capacity)):
                        part = own[at : at + n]
                        for column, value in zip(out, (key, k, at, n, zlib.crc32(part), part), strict=False):
                            column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=False)], names)

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, _PIECE + ", ids array<int>" * with_ids)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions in ``sizes``: each size, in the order given, to the fullest bin that holds it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0  # a bit for each gap that some bin has
    for i, s in enumerate(sizes):
        fits = gaps >> s
        if fits:
            gap = s + (fits & -fits).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
            bins[b].append(i)
        else:
            gap, b = capacity, len(bins)
            bins.append([i])
        if gap > s:
            by_gap[gap - s].append(b)
            gaps |= 1 << (gap - s)
    return bins


class Swaps:
    """Local search over the bins that aren't full."""

    def __init__(self, bins: dict[int, list[int]], sizes: list[int], capacity: int):
        self.bins, self.sizes, self.capacity = bins, sizes, capacity
        self.fill = {b: sum(sizes[i] for i in own) for b, own in bins.items()}
        self.holders: dict[int, dict[int, int]] = defaultdict(dict)  # size -> bin -> how many
        self.present = 0  # a bit for each size that some bin holds
        for b, own in bins.items():
            for i in own:
                self._note(sizes[i], b, 1)

    def _note(self, size: int, b: int, by: int) -> None:
        own = self.holders[size]
        n = own.get(b, 0) + by
        if n:
            own[b] = n
            self.present |= 1 << size
        else:
            del own[b]
            if not own:
                self.present &= ~(1 << size)

    def _shift(self, i: int, source: int, to: int) -> None:
        self.bins[source].remove(i)
        self.bins[to].append(i)
        s = self.sizes[i]
        self._note(s, source, -1)
        self._note(s, to, 1)
        self.fill[source] -= s
        self.fill[to] += s

    def _close(self, b: int) -> None:
        """A full bin neither gives nor takes: its pieces leave the index."""
        for i in self.bins[b]:
            self._note(self.sizes[i], b, -1)

    def _giver(self, size: int, to: int, gain: int) -> int | None:
        """A bin other than ``to`` with a piece of this size, for which the squared fill grows."""
        for tried, b in enumerate(self.holders[size]):
            if b != to and self.fill[b] < self.fill[to] + gain:
                return b
            if tried > TRIES:
                return None
        return None

    def _piece(self, size: int, b: int) -> int:
        return next(i for i in self.bins[b] if self.sizes[i] == size)

    def better(self, to: int) -> bool:
        """One exchange that fills bin ``to`` further: the one that adds most among those looked at."""
        gap = self.capacity - self.fill[to]
        own = self.bins[to]
        outs: list[tuple[int, ...]] = [(), *[(i,) for i in own]]
        outs += [(own[x], own[y]) for x in range(min(len(own), 6)) for y in range(x)]
        best = None
        for out in outs:  # a move, one for one, one for two
            given = sum(self.sizes[i] for i in out)
            under = self.present & ((1 << (given + gap + 1)) - 1)
            for _ in range(TRIES):
                size = under.bit_length() - 1
                if size <= given or best and size - given <= best[0]:
                    break
                giver = self._giver(size, to, size - given)
                if giver is not None:
                    best = (size - given, out, giver, (self._piece(size, giver),))
                    break
                under &= ~(1 << size)
            if best and best[0] == gap:
                break
        if not best or best[0] < gap:
            found = self._two(to, gap, best[0] if best else 0)
            best = found or best
        if not best:
            return False
        _, out, giver, taken = best
        for i in out:
            self._shift(i, to, giver)
        for i in taken:
            self._shift(i, giver, to)
        if not self.bins[giver]:
            del self.bins[giver], self.fill[giver]
        if self.fill[to] == self.capacity:
            self._close(to)
        return True

    def _two(self, to: int, gap: int, least: int):
        """Two pieces of one bin for one piece of ``to`` that fill it exactly."""
        for i in self.bins[to][:6]:
            total = self.sizes[i] + gap
            small = self.present & ((1 << (total // 2 + 1)) - 1)
            for _ in range(12):
                a = small.bit_length() - 1
                if a <= 0:
                    break
                small &= ~(1 << a)
                if not self.present >> (total - a) & 1:
                    continue
                for tried, b in enumerate(self.holders[a]):
                    if tried > TRIES:
                        break
                    if b == to or self.fill[b] >= self.fill[to] + gap:
                        continue
                    if self.holders[total - a].get(b, 0) > (a == total - a):
                        first = self._piece(a, b)
                        second = next(j for j in self.bins[b] if j != first and self.sizes[j] == total - a)
                        return (gap, (i,), b, (first, second))
        return None

    def run(self, passes: int) -> None:
        """Fullest bins first, each until nothing betters it; ends when a pass changes nothing."""
        for _ in range(passes):
            changed = False
            for b in sorted(self.bins, key=lambda b: (-self.fill[b], b)):
                while b in self.bins and self.fill[b] < self.capacity and self.better(b):
                    changed = True
            if not changed:
                break


def _pack_group(capacity: int, passes: int, first: bool):
    def run(rows: pa.Table) -> pa.Table:
        if first:
            rows = rows.take(pa.array(np.repeat(np.arange(rows.num_rows), rows["copies"].to_numpy())))
            rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
            sizes = rows["length"].to_pylist()
            node = rows["node"][0].as_py()
            found = {(node << 32) + k: b for k, b in enumerate(best_fit(sizes, capacity))}
        else:
            rows = rows.sort_by([("bin", "ascending"), ("offset", "ascending")])
            sizes = rows["length"].to_pylist()
            found = defaultdict(list)
            for i, b in enumerate(rows["bin"].to_pylist()):
                found[b].append(i)
            order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
            anew = best_fit([sizes[i] for i in order], capacity)
            if len(anew) < len(found):  # a better start for the search
                found = {b: [order[i] for i in own] for b, own in zip(list(found), anew, strict=False)}
        under = {b: list(own) for b, own in found.items() if sum(sizes[i] for i in own) < capacity}
        search = Swaps(under, sizes, capacity)
        search.run(passes)
        done = {b: own for b, own in found.items() if sum(sizes[i] for i in own) == capacity}
        bins, offsets, fills = [0] * len(sizes), [0] * len(sizes), [0] * len(sizes)
        for b, own in [*done.items(), *search.bins.items()]:
            at, total = 0, sum(sizes[i] for i in own)
            for i in own:
                bins[i], offsets[i], fills[i] = b, at, total
                at += sizes[i]
        kept = rows.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        for name, values in (("bin", bins), ("offset", offsets), ("fill", fills)):
            kept = kept.append_column(name, pa.array(values, pa.int64()))
        return kept

    return run


_PLACED = _PIECE + ", bin long, offset long, fill long"


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, leaf: int = LEAF, rounds: int = ROUNDS, passes: int = PASSES) -> DataFrame:
    """Places rows of ``pieces``: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Groups are dealt by hashes of the pieces' own values, so reruns agree. What
    a group leaves underfull goes on to the next round; a group's rows bound a
    task's memory: equal rows, say of documents without id and text, are counted
    and dealt in blocks of at most ``SAME``. Rows stay rows: repeated documents,
    null ids and ties by length each get a place of their own.
    """
    todo = saved(cut_pieces, "pieces")
    n = todo.count()
    done = None
    for k in range(rounds + 1):
        nodes = max(1, -(-n // (leaf * min(GROWTH**k, GROWN))))
        if k == 0:
            counted = todo.groupBy("doc_id", "piece", "start", "length", "ids_crc32").agg(F.count("*").alias("n"))
            block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(SAME).cast("long"))).alias("at")
            todo = counted.select("*", block).withColumn("copies", F.least(F.col("n") - F.col("at"), F.lit(SAME)))
            by = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "at"), F.lit(nodes))
        else:
            by = F.pmod(F.xxhash64("bin", F.lit(k)), F.lit(nodes))
        grouped = todo.withColumn("node", by).groupBy("node")
        out = saved(grouped.applyInArrow(_pack_group(capacity, passes, k == 0), _PLACED), "packed")
        last = k == rounds
        closed = out if last else out.filter(F.col("fill") == capacity)
        done = closed if done is None else done.unionByName(closed)
        if last:
            break
        todo = out.filter(F.col("fill") < capacity)
        n = todo.count()
        if n == 0:
            break
        if k and nodes == 1:
            done = done.unionByName(todo)
            break
    return done.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``pack`` over the pieces of every row of ``docs``.

    A null or empty text is its end id alone. Rows are packed one by one, so
    repeated rows and null ids keep their places; other columns aren't read. An
    empty table gives an empty result.
    """
    return pack(pieces(docs, path, doc_id, text, capacity), capacity)


def sequences(placed: DataFrame, with_ids: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed token sequences, from ``pack`` and ``pieces(..., with_ids=True)`` with unique ids."""
    keys = ["doc_id", "piece"]
    parts = placed.join(with_ids.select(*keys, "ids"), keys).groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda x: x["ids"])).alias("ids"))
