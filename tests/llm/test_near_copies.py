"""The near-copy stage against all pairs of shingle sets."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import near_copies
from tests.llm.helpers import empty, odd, odd_rows


def words_of(text):
    return tuple((text or "").encode().lower().split())


def plain_pairs(texts):
    """Pairs of distinct word sequences whose five-word shingles are 0.8 alike."""
    distinct = sorted({words_of(t) for t in texts})
    sets = [{w[i : i + 5] for i in range(max(1, len(w) - 4))} for w in distinct]
    return {(distinct[i], distinct[j]) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}


def plain_groups(rows, pairs):
    root = {words_of(t): words_of(t) for _, t in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for key, text in rows:
        groups[find(words_of(text))].append(key)
    return list(groups.values())


def varied(rng, n_bases, copies, words=120):
    rows = []
    for _ in range(n_bases):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(copies):
            one = list(base)
            for _ in range(rng.randrange(3)):
                one[rng.randrange(len(one))] = f"x{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(one)))
    return rows


@pytest.mark.parametrize("copies", [3, 60])
def test_groups_of_near_copies(spark, copies):
    """Small groups meet all among themselves, large ones through many variants; none is lost, none is wrong."""
    rows = varied(random.Random(copies), 240 // copies, copies)
    rows += [(9000 + k, f"a text that stands alone {k} " * (k + 1)) for k in range(20)]
    groups = plain_groups(rows, plain_pairs([t for _, t in rows]))
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(min(g) for g in groups)


def test_every_link_is_verified_and_few_are_lost(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    pairs = plain_pairs([t for _, t in rows])
    want = {min(g) for g in plain_groups(rows, pairs)}
    kept = {r["doc_id"] for r in near_copies.keep_one(docs).select("doc_id").collect()}
    assert want <= kept and len(kept - want) <= 0.1 * len(pairs)


def test_hot_variants_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 32)
    rows = varied(random.Random(5), 1, 200)
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r["doc_id"] for r in kept.collect()] == [0]


def test_odd_rows(spark):
    groups = plain_groups([(k, r[1]) for k, r in enumerate(odd_rows())], plain_pairs([r[1] for r in odd_rows()]))
    kept = near_copies.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns and kept.count() == len(groups)
    order = lambda k: (odd_rows()[k][0] is None, odd_rows()[k][0])
    assert sorted((r["doc_id"], r["rank"]) for r in kept.collect()) == sorted((odd_rows()[k][0], odd_rows()[k][6 - 1]) for k in (min(g, key=order) for g in groups))
    assert near_copies.keep_one(empty(spark)).count() == 0
    nulls = spark.createDataFrame([(None, f"text {k % 7} of the many without an id") for k in range(40)], "doc_id long, text string")
    assert near_copies.keep_one(nulls).count() == 7
    same = spark.createDataFrame([(1, "A b  c"), (1, "a B c"), (2, "a b c"), (1, "other words altogether")], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.keep_one(same).collect()) == [1, 1]
    assert near_copies.keep_one(same.withColumn("links", F.lit(1))).columns == ["doc_id", "text", "links"]


def met_pairs(texts):
    """``plain_pairs`` that a variant brings together and whose further bits are close."""
    found = set()
    for a, b in plain_pairs(texts):
        (sa, ca), (sb, cb) = near_copies._fingerprint(list(a)), near_copies._fingerprint(list(b))
        if any((x ^ y).bit_count() <= 1 for x, y in zip(sa, sb, strict=True)) and ((ca ^ cb) & (1 << 64) - 1).bit_count() <= near_copies.CHECK_DISTANCE:
            found.add((a, b))
    return found


def differing(seed, copies=260):
    """Texts of one base that each differ in some words of their own: many variants, few links."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(90)]
    rows = []
    for k in range(copies):
        one = list(base)
        for at in rng.sample(range(90), rng.choice([1, 2, 2, 3, 3, 4, 4, 5])):
            one[at] = f"x{rng.randrange(9999)}"
        rows.append((k, " ".join(one)))
    return rows


def left_over(rows, pairs):
    return sorted(min(g) for g in plain_groups(rows, pairs))


def kept_of(spark, rows):
    return sorted(r["doc_id"] for r in near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id").collect())


def test_no_link_of_a_large_run_is_lost(spark):
    """Texts that all pairs of a large run connect are one group."""
    rows = differing(3)
    assert kept_of(spark, rows) == left_over(rows, met_pairs([t for _, t in rows]))


def test_no_link_across_parts_is_lost(spark, monkeypatch):
    """Nor are those between the parts of variants that are dealt out; groups meet in parts as well."""
    monkeypatch.setattr(near_copies, "BLOCK", 32)
    monkeypatch.setattr(near_copies, "LEAST_PART", 16, raising=False)
    monkeypatch.setattr(near_copies, "MOST_PART", 16, raising=False)
    rows = differing(2)
    texts = [t for _, t in rows]
    kept = set(kept_of(spark, rows))
    assert set(left_over(rows, plain_pairs(texts))) <= kept <= set(left_over(rows, met_pairs(texts)))


@pytest.mark.parametrize("block", [near_copies.BLOCK, 64])
def test_candidates_connect_what_all_pairs_connect(spark, monkeypatch, block):
    """400 texts of one variant, each close to one other: no matter how far apart they stand in the run."""
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rng = random.Random(11)
    checks = [rng.getrandbits(63) for _ in range(200)]
    nodes = [(2 * k + side, [5] * near_copies.SEGMENTS, c ^ (0b1011 * side)) for k, c in enumerate(checks) for side in (0, 1)]
    found = near_copies.candidate_links(spark.createDataFrame(nodes, "node long, segments array<int>, check long")).collect()
    if block > len(nodes):
        assert sorted((r["a"], r["b"]) for r in found) == [(2 * k, 2 * k + 1) for k in range(200)]
    groups = plain_groups([(n, str(n)) for n, _, _ in nodes], [((str(r["a"]).encode(),), (str(r["b"]).encode(),)) for r in found])
    assert all((2 * k in g) == (2 * k + 1 in g) for g in groups for k in range(200))


def test_texts_that_links_left_apart_meet_the_others(spark):
    """Of a chain of large links none holds, but its ends are alike; a pair that stands for itself isn't a family."""
    sets = [(1, list(range(100))), (2, list(range(40, 140))), (3, list(range(5, 100))), (4, list(range(60, 160))), (7, list(range(100))), (8, list(range(50)))]
    links = spark.createDataFrame([(1, 2, True), (2, 3, True), (3, 4, True), (7, 8, False)], "a long, b long, large boolean")
    roots = spark.createDataFrame([], "node long, root long")
    found = near_copies.missed_links(links, roots, spark.createDataFrame(sets, "node long, shingles array<long>"))
    assert {tuple(sorted((r["a"], r["b"]))) for r in found.collect()} == {(1, 3)}
