"""Near copies at a stated similarity, by wide SimHash fingerprints and their deletion variants.

Pairs of texts whose five-word shingles are 0.8 alike differ in too many of 64
bits to be told from others. Here a fingerprint has SEGMENTS segments of
BITS bits, voted by pairs of words, which a changed word touches less than longer
shingles; two texts meet where some segment differs in one bit at most, by an
equality on its one-wildcard variants. A further 64 bits sort out chance meetings, and every
link is verified on the shingles themselves before it counts.

Where many texts meet, their pairs aren't told one by one: the links of a minimum spanning
forest are verified first, and texts that those leave in different groups, though candidates
connect them, are compared with all texts of the other groups.
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

#: More documents need longer segments: chance meetings a pair are SEGMENTS * (BITS + 1) / 2^BITS.
SEGMENTS, BITS = 9, 20
#: Of the 64 further bits, how many a candidate pair may differ in.
CHECK_DISTANCE, FAR = 11, 65
#: Texts of a variant up to here are told pair by pair; of larger runs, a spanning forest of the pairs.
SMALL_RUN = 32
#: A variant with more texts than this is dealt out, by another hash for each variant.
BLOCK = 4096
#: Texts of a part, in which texts that links left apart meet the others: a share of theirs, within bounds; and shingles.
PARTS, LEAST_PART, MOST_PART, PART_SHINGLES = 32, 128, 4096, 1 << 22
WORDS_A_SHINGLE, SIMILARITY = 5, 0.8
_VOTES = 1 << 15


def _grams(words: list[bytes], size: int) -> list[bytes]:
    size = min(size, len(words))
    return [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] if words else []


def _fingerprint(words: list[bytes]) -> tuple[list[int], int]:
    """Segments and the further 64 bits: by majority of the distinct word pairs' 256 hash bits."""
    pairs = list(set(_grams(words, 2)))
    votes = np.zeros(256, np.int64)
    for at in range(0, len(pairs), _VOTES):
        some = pairs[at : at + _VOTES]
        digests = b"".join([d for p in some for d in (xxhash.xxh3_128_digest(p, 1), xxhash.xxh3_128_digest(p, 2))])
        votes += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(len(some), 32), axis=1).sum(axis=0, dtype=np.int64)
    bits = 2 * votes > len(pairs)
    weights = 1 << np.arange(BITS, dtype=np.int64)
    return (bits[: SEGMENTS * BITS].reshape(SEGMENTS, BITS) @ weights).tolist(), int(np.packbits(bits[-64:]).view(np.int64)[0])


_PRINTED = "rank {kind}, node long, segments array<int>, check long"


def _print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, segments, checks = [], [], []
        for text in batch.column(1).cast(pa.binary()):
            words = (text.as_py() or b"").lower().split()
            own, check = _fingerprint(words)
            nodes.append(xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63))
            segments.append(own)
            checks.append(check)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(segments, pa.list_(pa.int32())), pa.array(checks, pa.int64())], ["rank", "node", "segments", "check"])


def _variants(nodes: DataFrame) -> DataFrame:
    """(key, node, check): a row for each one-wildcard variant of each segment."""
    each = nodes.select("node", "check", F.posexplode("segments").alias("at", "s"))
    keys = [
        F.col("s").bitwiseAND(F.lit(~(1 << j) & ((1 << BITS) - 1))).cast("long").bitwiseOR(F.shiftleft((F.col("at") * BITS + j).cast("long"), BITS))
        for j in range(BITS)
    ]
    return each.select(F.explode(F.array(*keys)).alias("key"), "node", "check")


def _forest(node: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (one, other) of a minimum spanning forest of the pairs whose further bits are close.

    It connects whatever those pairs connect. Equal distances are ordered by
    the pair itself, so that runs that share texts share links.
    """
    near = np.zeros(len(node), bool)
    for at in range(0, len(node), 256):
        bits = np.bitwise_count((check[at : at + 256, None] ^ check[None, :]).view(np.uint64))
        near[at : at + 256] = (bits <= CHECK_DISTANCE).sum(axis=1) > 1  # itself is one
    of = np.flatnonzero(near)
    if not len(of):
        return of, of
    node, check, never = node[of], check[of], np.iinfo(np.int64).max
    best, other, waits = np.full(len(of), never), np.zeros(len(of), np.int64), np.ones(len(of), bool)
    one, mate, now = [], [], 0
    for _ in range(len(of) - 1):
        waits[now], best[now] = False, never
        far = np.bitwise_count((check ^ check[now]).view(np.uint64)).astype(np.int64) << 56 | (node ^ node[now]) & (1 << 56) - 1
        less = np.flatnonzero(waits & (far < best))
        best[less], other[less] = far[less], now
        now = int(best.argmin())
        if best[now] >> 56 <= CHECK_DISTANCE:
            one.append(now)
            mate.append(other[now])
    return of[np.array(one, np.int64)], of[np.array(mate, np.int64)]


def _met(key: np.ndarray, node: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of nodes of whole runs of equal keys, and whether they stand for all pairs of a larger run."""
    n = len(key)
    new = np.concatenate([[True], key[1:] != key[:-1]])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, n))
    run = np.cumsum(new) - 1
    left = (start + size)[run] - np.arange(n)
    small = size[run] <= SMALL_RUN
    a, b, large = [node[:0]], [node[:0]], [np.empty(0, bool)]

    def apart(at: np.ndarray, step: int) -> np.ndarray:
        bits = np.bitwise_count((check[at] ^ check[at + step]).view(np.uint64)).astype(np.int64)
        return np.where(node[at] == node[at + step], FAR, bits)

    def link(at: np.ndarray, other: np.ndarray, stands: bool) -> None:
        a.append(np.minimum(node[at], node[other]))
        b.append(np.maximum(node[at], node[other]))
        large.append(np.full(len(at), stands))

    for step in range(1, SMALL_RUN):
        at = np.flatnonzero(small & (left > step))
        if not len(at):
            break
        near = at[apart(at, step) <= CHECK_DISTANCE]
        link(near, near + step, False)
    for k in np.flatnonzero(size > SMALL_RUN):
        whole = slice(start[k], start[k] + size[k])
        one, mate = _forest(node[whole], check[whole])
        link(start[k] + one, start[k] + mate, True)
    return np.concatenate(a), np.concatenate(b), np.concatenate(large)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, check) sorted by key; a run that a batch's end cuts waits for the next batch."""
    held = [np.empty(0, np.int64)] * 3

    def told(key, node, check):
        a, b, large = _met(key, node, check)
        if len(a):
            a, b, large = np.unique(np.stack([a, b, large]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(large.astype(bool))], ["a", "b", "large"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key, node, check = (np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held))
        other = np.flatnonzero(key != key[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield told(key[:cut], node[:cut], check[:cut])
        held = [key[cut:], node[cut:], check[cut:]]
    if len(held[0]):
        yield told(*held)


def candidate_links(nodes: DataFrame) -> DataFrame:
    """(a, b, large), a < b: distinct pairs of nodes that a variant brings together and whose further bits are close.

    Pairs of small runs are told one by one. Those that are ``large`` connect
    what all pairs of their runs connect; ``missed_links`` finds the links
    among these pairs. Texts of a variant that is dealt out are all connected,
    each by a pair with the variant's least node.
    """
    rows = _variants(nodes)
    large = saved(rows.groupBy("key").agg(F.count("*").alias("count"), F.min("node").alias("hub")).filter(F.col("count") > BLOCK), "variants")
    dealt = rows.join(large, "key", "left")
    part = F.when(F.col("count").isNull(), 0).otherwise(F.pmod(F.xxhash64("key", "node"), F.ceil(F.col("count") / (BLOCK // 2)))).cast("int")
    # A part of a large variant has a key of its own: what lies beyond SEGMENTS * BITS variants.
    dealt = dealt.select(F.when(part == 0, F.col("key")).otherwise(F.xxhash64("key", part).bitwiseOR(F.lit(1 << 62))).alias("key"), "node", "check")
    ordered = dealt.repartition(shuffle_partitions(nodes.sparkSession), "key").sortWithinPartitions("key")
    found = ordered.mapInArrow(_meet, "a long, b long, large boolean")
    if not large.isEmpty():
        spokes = rows.join(large, "key").filter("node > hub").select(F.col("hub").alias("a"), F.col("node").alias("b"), F.lit(True).alias("large"))
        found = found.unionByName(spokes)
    return found.groupBy("a", "b").agg(F.max("large").alias("large"))


def _shingles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sorted({xxhash.xxh3_64_intdigest(g) - (1 << 63) for g in _grams((t.as_py() or b"").lower().split(), size)}) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return run


def shingle_sets(links: DataFrame, texts: DataFrame, words_a_shingle: int = WORDS_A_SHINGLE) -> DataFrame:
    """(node, shingles) for the nodes of ``links``; ``texts`` has (node, text)."""
    asked = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return texts.join(asked, "node", "left_semi").mapInArrow(_shingles(words_a_shingle), "node long, shingles array<long>")


def verified_links(links: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The links whose texts' distinct shingles have at least that Jaccard similarity; ``sets`` has (node, shingles)."""
    met = links.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return met.filter(both >= similarity * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _meet_others(similarity: float):
    """Pairs of roots, as few as connect them, of similar texts of a part of those left apart and a part of all."""

    def run(rows: pa.Table) -> pa.Table:
        aside = rows["aside"].to_numpy()
        sets = rows["shingles"].combine_chunks()
        sizes, root = np.diff(sets.offsets.to_numpy()), rows["root"].to_numpy()
        values, starts = sets.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
        own = np.flatnonzero(~aside)
        held = np.repeat(~aside, sizes)
        owner = np.repeat(np.cumsum(~aside) - 1, sizes)[held]
        order = np.argsort(values[held], kind="stable")
        posted, owner = values[held][order], owner[order]
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while up.get(x, x) != x:
                x = up[x] = up.get(up[x], up[x])
            return x

        a, b = [], []
        for k in np.flatnonzero(aside):
            words = values[starts[k] : starts[k + 1]]
            low, high = np.searchsorted(posted, words, "left"), np.searchsorted(posted, words, "right")
            n = high - low
            places = np.arange(n.sum()) + np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            both = np.bincount(owner[places], minlength=len(own))
            alike = own[both >= similarity * (sizes[k] + sizes[own] - both)]
            for other in np.unique(root[alike]).tolist():
                x, y = find(int(root[k])), find(other)
                if x != y:
                    up[max(x, y)] = min(x, y)
                    a.append(int(root[k]))
                    b.append(other)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def missed_links(links: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b): roots of groups that a link joins which the ``large`` ones of ``links`` stand for and verified links lack.

    ``roots`` has (node, root), the groups by verified links. Groups that large
    links connect are a family; every text outside the family's largest group
    meets all the family's texts, a part of these and a part of those at a
    time, so what is done grows with the texts left apart, not with all pairs.
    """
    rooted = lambda n: roots.select(F.col("node").alias(n), F.col("root").alias(f"root_{n}"))
    across = links.filter("large").join(rooted("a"), "a", "left").join(rooted("b"), "b", "left")
    across = across.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).filter("a <> b").distinct()
    across = saved(across, "across")
    if across.isEmpty():
        return across
    families = components(across).select(F.col("node").alias("root"), F.col("root").alias("family"))
    member = sets.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "shingles").join(families, "root")
    member = saved(member, "members")
    groups = member.groupBy("family", "root").agg(F.count("*").alias("n"), F.sum(F.size("shingles")).alias("w"))
    group = groups.groupBy("family").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.struct("n", "w", "root")).alias("main"))
    size = F.least(F.greatest(F.col("n") / PARTS, F.lit(LEAST_PART)), F.lit(MOST_PART))
    parts = lambda n, w: F.greatest(F.lit(1), F.ceil(n / size), F.ceil(w / PART_SHINGLES))
    dealt = group.select("family", F.col("main.root").alias("main"), parts(F.col("n"), F.col("w")).alias("of"), parts(F.col("n") - F.col("main.n"), F.col("w") - F.col("main.w")).alias("of_aside"))
    row = member.join(dealt, "family")
    place = lambda of: F.pmod(F.xxhash64("node", F.lit(of)), F.col(of))
    each = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    aside = row.filter("root <> main").select("family", place("of_aside").alias("i"), each("of").alias("j"), F.lit(True).alias("aside"), "root", "shingles")
    others = row.select("family", each("of_aside").alias("i"), place("of").alias("j"), F.lit(False).alias("aside"), "root", "shingles")
    met = aside.unionByName(others).groupBy("family", "i", "j")
    return met.applyInArrow(_meet_others(similarity), "a long, b long")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_a_shingle: int = WORDS_A_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each group of ``docs``, all columns: that of the least id, nulls last, then of the least text hash.

    Texts of the same words, letters A-Z in either case, are copies; a group is
    what verified links between different texts reach. Null, empty and wordless
    texts are one group; a text shorter than a shingle is a shingle. Ids are
    whole numbers; rows that repeat an id and its text stay once, an id whose texts are in several
    groups stays with each of them. An empty table gives an empty result. Copies
    are never expanded into pairs: a node is a text, by 64 bits of a hash of its words.
    """
    columns = docs.columns
    rank_of = lambda: F.struct(F.col(doc_id).isNull().alias("m"), F.col(doc_id).cast("long").alias("k"), F.xxhash64("__text").alias("t1"), F.xxhash64(F.lit(1), "__text").alias("t2"))
    rows = docs.withColumn("__text", F.col(text).cast("string")).withColumn("__rank", rank_of())
    printed = rows.select("__rank", "__text").mapInArrow(_print, _PRINTED.format(kind="struct<m:boolean,k:bigint,t1:bigint,t2:bigint>"))
    nodes = saved(printed.groupBy("node").agg(F.min("rank").alias("rank"), F.min(F.struct("segments", "check")).alias("f")).select("node", "rank", "f.*"), "nodes")
    links = saved(candidate_links(nodes), "candidates")
    asked = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    key = ["m", "k", "t1", "t2"]

    def joined(kept: DataFrame, others: list[Column]) -> DataFrame:
        """Rows of the documents that ``kept`` names, each once."""
        own = rows.select(*[F.coalesce(F.col("__rank")[c], F.lit(0)).alias(c) if c == "k" else F.col("__rank")[c].alias(c) for c in key], *others)
        own = own.groupBy(*key).agg(*[F.first(c).alias(c) for c in own.columns[4:]])  # repeated rows meet combined
        return own.join(kept, key)

    flat = [F.coalesce(F.col("rank")[c], F.lit(0)).alias(c) if c == "k" else F.col("rank")[c].alias(c) for c in key]
    of_node = saved(nodes.join(asked, "node", "left_semi").select("node", *flat), "asked")
    texts = joined(of_node, [F.col("__text").alias("text")]).select("node", "text")
    sets = saved(shingle_sets(links, texts, words_a_shingle), "shingles")
    rooted = components(saved(verified_links(links, sets, similarity), "links"))
    named = nodes.select("node", "rank").join(rooted, "node", "left").select(F.coalesce("root", "node").alias("root"), "rank")
    missed = saved(missed_links(links, rooted, sets, similarity), "missed")
    if not missed.isEmpty():
        last = components(missed).select(F.col("node").alias("root"), F.col("root").alias("last"))
        named = named.join(last, "root", "left").select(F.coalesce("last", "root").alias("root"), "rank")
    kept = saved(named.groupBy("root").agg(F.min("rank").alias("rank")).select(*flat), "kept")
    whole = [F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row")]
    return joined(kept, whole).select(*[F.col("__row")[c].alias(c) for c in columns])
