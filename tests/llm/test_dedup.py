"""Line dedup, SimHash and suffix arrays against brute force."""

import collections

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyspark.llm import line_dedup, simhash, suffixes
from tallyspark.llm.components import components
from tests.llm.helpers import WORD, documents, empty, odd, odd_rows


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def test_components_on_chains_stars_and_repeats(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 400)]
    edges = [*chain, *star, (1, 2), (2, 1), (2, 2), (5, 4), (5, 4), (9, 9)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(parent, x) for x in parent if x != 9}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(text)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    parent = {f: f for f in fps}
    values = np.array(sorted(fps), np.uint64)
    for k, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values[k + 1 :] ^ v) <= 4) + k + 1:
            a, b = find(parent, int(v)), find(parent, int(values[j]))
            parent[max(a, b)] = min(a, b)
    return {f: find(parent, f) for f in fps}


@pytest.mark.parametrize("table", [documents, odd])
def test_simhash_is_exact(spark, table):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in table(spark).collect()]
    root = plain_components({f for _, f in rows})
    least = collections.defaultdict(lambda: None)
    for d, f in rows:
        if d is not None and (least[root[f]] is None or d < least[root[f]]):
            least[root[f]] = d
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(table(spark)).collect())
    assert got == sorted((d is None, d or 0, f, least[root[f]]) for d, f in rows)


@pytest.mark.parametrize("block", [4, simhash.BLOCK])
def test_links_span_dense_clusters(spark, block):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = {int(c) for c in centres} | {int(x) for x in rng.integers(0, 1 << 63, 300, dtype=np.uint64)}
    for c in centres:
        for _ in range(60):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(1, 6)):
                x ^= 1 << int(b)
            fps.add(x)
    want = plain_components(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), block).collect()
    assert all(np.bitwise_count(np.uint64((r["a"] ^ r["b"]) & (2**64 - 1))) <= 4 for r in links)
    parent = {f: f for f in fps}
    for r in links:
        a, b = find(parent, r["a"] & (2**64 - 1)), find(parent, r["b"] & (2**64 - 1))
        parent[max(a, b)] = min(a, b)
    assert {f: find(parent, f) for f in fps} == want


def test_keep_one(spark):
    kept = simhash.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert len(ids) == len(set(ids)) and 0 in ids and 1 not in ids and ids.count(6) == 1
    assert simhash.keep_one(empty(spark)).count() == 0 and simhash.near_duplicates(empty(spark)).count() == 0


def test_keep_one_keeps_a_row_of_each_component(spark):
    rng = np.random.default_rng(11)
    a, b, c, d, e = ("".join(rng.choice(list("abcdefgh "), 400)) for _ in range(5))
    rows = [(None, a), (None, a), (None, b), (None, c), (9, c), (3, d), (4, d), (4, e), (5, e), (7, d), (7, b + " ")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # Each text once; 4 stays for e, not for d, whose least id is 3; b + " " is b by its words, and has an id.
    assert sorted((r["text"].strip(), r["doc_id"] or -1) for r in got) == sorted([(a.strip(), -1), (b.strip(), 7), (c.strip(), 9), (d.strip(), 3), (e.strip(), 4)])


def test_keep_one_of_many_null_ids(spark):
    texts = [f"text {k} " + " ".join(f"{k}w{j}" for j in range(30)) for k in range(40)]
    df = spark.createDataFrame([(None, t) for t in texts for _ in range(3)], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.keep_one(df).collect()) == sorted(texts)


def plain_lines(rows):
    texts = sorted({(r[0] is not None, r[0] or 0, r[1]) for r in rows if r[1] is not None}, key=lambda x: x[:2])
    return texts


def test_line_dedup_cases(spark):
    got = line_dedup.dedup_lines(odd(spark))
    assert got.count() == len(odd_rows()) and set(odd(spark).columns) <= set(got.columns)
    by_id = collections.defaultdict(list)
    for r in got.collect():
        by_id[r["doc_id"]].append(r)
    assert by_id[7][0]["n_removed"] == 0
    assert by_id[8][0]["text"] == "fifth line here" and by_id[8][0]["n_removed"] == 4
    assert by_id[2][0]["text"] is None and by_id[2][0]["n_lines"] == 0
    assert by_id[0][0]["text"] == by_id[1][0]["text"], "texts shorter than a window never change"
    assert by_id[10][0]["text"] == "" and by_id[10][0]["n_removed"] == 4, "later windows cover lines of the first too"
    assert by_id[9][0]["n_removed"] == 0
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_line_dedup_of_repeated_rows(spark):
    text = "a\nb\nc\nd"
    rows = spark.createDataFrame([(1, text), (1, text), (None, text), (None, text)], "doc_id long, text string")
    got = sorted((r["doc_id"] is not None, r["text"]) for r in line_dedup.dedup_lines(rows).collect())
    assert got == [(False, text), (False, text), (True, ""), (True, "")]


def plain_passages(docs, n=50):
    places = collections.defaultdict(list)
    for k, w in sorted(docs.items()):
        for i in range(len(w) - n + 1):
            places[tuple(w[i : i + n])].append((k, i))
    every, later = collections.defaultdict(set), collections.defaultdict(set)
    for at in places.values():
        for j, (k, i) in enumerate(at if len(at) > 1 else []):
            every[k].update(range(i, i + n))
            if j:
                later[k].update(range(i, i + n))
    return every, later


def spans(rows):
    every, later = collections.defaultdict(set), collections.defaultdict(set)
    for r in rows:
        words = range(r["start_word"], r["start_word"] + r["n_words"])
        every[r["doc_id"]].update(words)
        if not r["kept"]:
            later[r["doc_id"]].update(words)
    return every, later


def test_suffixes_find_all_repeats(spark):
    docs = {r["doc_id"]: WORD.findall(r["text"] or "") for r in documents(spark).collect()}
    assert spans(suffixes.repeated_passages(documents(spark)).collect()) == plain_passages(docs)


def test_suffixes_on_planted_passages(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    passage = [word() for _ in range(51)]
    docs = {}
    for k in range(40):
        own = [word() for _ in range(rng.integers(0, 200))]
        if k % 3 == 0:
            at = rng.integers(0, len(own) + 1)
            own[at:at] = passage
        if k % 5 == 0:
            own += passage[:49]
        docs[k] = own
    docs[50] = passage + passage
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")
    every, later = plain_passages(docs)
    got_every, got_later = spans(suffixes.repeated_passages(df).collect())
    assert got_every == every and got_later == later
    cleaned = {r["doc_id"]: WORD.findall(r["text"]) for r in suffixes.without_repeats(df).collect()}
    assert cleaned == {k: [x for i, x in enumerate(w) if i not in later[k]] for k, w in docs.items()}


def test_suffixes_find_passages_by_their_left_sides(spark):
    rng = np.random.default_rng(17)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    docs = {}
    for size in (32, 36, 40, 45, 49):
        notice, pair = [word() for _ in range(size)], [word() for _ in range(50 - size)]
        for k in range(30):
            lead = pair if k in (4, 23) else [word() for _ in range(20)]
            docs[len(docs)] = [word() for _ in range(40)] + lead + notice + ([] if k % 3 else [word() for _ in range(30)])
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in docs.items()], "doc_id long, text string")
    every, later = plain_passages(docs)
    assert len(every) == 10 and spans(suffixes.repeated_passages(df).collect()) == (every, later)


def test_suffixes_cases(spark):
    rows = suffixes.repeated_passages(odd(spark)).collect()
    assert rows == [] or all(r["n_words"] >= 50 for r in rows)
    assert suffixes.repeated_passages(empty(spark)).count() == 0
    long = " ".join(f"w{k}" for k in range(60))
    df = spark.createDataFrame([(3, long), (1, long), (1, long), (None, long), (2, long)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_words"], r["match_doc_id"], r["kept"]) for r in suffixes.repeated_passages(df).collect())
    assert got == [(1, 60, 2, True), (2, 60, 1, False), (3, 60, 1, False)]
    assert suffixes.without_repeats(df.withColumn("start", F.lit(1))).count() == 5


def test_line_dedup_of_named_documents(spark):
    text = "a\nb\nc\nd"
    rows = spark.createDataFrame([("x1", text), ("x2", text), (None, "e\nf\ng"), ("x2", "h")], "doc_id string, text string")
    got = sorted((r["doc_id"] or "", r["text"]) for r in line_dedup.dedup_lines(rows).collect())
    assert got == [("", "e\nf\ng"), ("x1", text), ("x2", ""), ("x2", "h")]


def test_suffixes_of_two_texts_under_one_id(spark):
    shared = " ".join(f"s{k}" for k in range(60))
    first, second = " ".join(f"w{k}" for k in range(90)), "start of " + shared + " and its end"
    rows = [(1, shared), (2, first), (2, second), (None, shared)]
    df = spark.createDataFrame(rows, "`__id` long, `a.text` string").withColumn("__gone", F.lit(1))
    got = sorted((r[0] is None, r[0] or 0, r[1]) for r in suffixes.without_repeats(df, "__id", "a.text").collect())
    assert got == sorted([(False, 1, shared), (False, 2, first), (False, 2, "start of and its end"), (True, 0, shared)])
