"""Periodic runs, document fingerprints and hard negatives against plain Python."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import fingerprints, negatives, periods, queries
from tests.llm.helpers import SF, WORD, documents, empty, odd, odd_rows


def plain_runs(words, exponent=4, least=6):
    """Every maximal stretch of a period, compared word by word; a stretch of a smaller period has that one."""
    found, n = {}, len(words)
    for period in range(1, n // 2 + 1):
        i = 0
        while i + period < n:
            start = i
            while i + period < n and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            if length > period and length >= exponent * period:
                found.setdefault((start, length), period)
            i += 1
    return sorted(((s, n, p) for (s, n), p in found.items() if n >= least), key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


blocks = st.lists(st.tuples(st.text("abc", min_size=1, max_size=6), st.integers(1, 8), st.text("abcd", max_size=3)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(blocks, min_size=1, max_size=3), st.sampled_from([(4, 6), (2, 2), (3, 6), (5, 3)]))
def test_runs_of_words(texts, rule):
    texts = [[c.encode() for c in "".join(u * n + t for u, n, t in b)] for b in texts]
    assert periods.runs_of_texts(texts, *rule) == [plain_runs(t, *rule) for t in texts]


def test_ordered_positions_in_many_blocks():
    rng = np.random.default_rng(1)
    order = rng.permutation(9000).tolist()
    own, plain = periods.Positions(order[0]), [order[0]]
    for x in order[1:]:
        before, after = own.add(x)
        k = int(np.searchsorted(plain, x))
        assert (before, after) == (plain[k - 1] if k else None, plain[k] if k < len(plain) else None)
        plain.insert(k, x)
    assert list(own) == plain and own.size == 9000 and max(map(len, own.blocks)) <= 2 * periods.BLOCK


def test_long_periodic_texts():
    one, seven = [b"a"] * 60_000, [b"%d" % (k % 7) for k in range(60_000)]
    assert periods.runs_of_texts([one, [], seven], 4, 6) == [[(0, 60_000, 1)], [], [(0, 60_000, 7)]]


def test_runs_of_odd_rows(spark):
    got = periods.periodic_runs(odd(spark)).collect()
    want = collections.Counter()
    for r in odd_rows():
        words = WORD.findall(r[1] or "")
        runs = plain_runs(words) if len(words) < 3000 else None
        if runs is not None:
            want[r[0], len(words), tuple(runs), plain_collapse(words, runs)] += 1
    short = collections.Counter((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in got if r["n_words"] < 3000)
    assert short == want and len(got) == len(odd_rows())
    assert periods.periodic_runs(empty(spark)).count() == 0


def check_runs(rows, texts):
    want = collections.Counter()
    for doc_id, text in texts:
        words = planted(doc_id, text)
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, plain_collapse(words, runs))]
        want[doc_id, len(runs), *best, milli, *digests] += 1
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert collections.Counter(tuple(r[n] for n in names) for r in rows) == want


def test_periodic_runs_query(spark, tmp_path):
    texts = [(r["doc_id"], r["text"]) for r in documents(spark).filter(F.length("text") < 6000).collect()]
    texts += [(k, "a b c " * 9 + "é" * (k % 3)) for k in range(1000, 1060)] + [(5000, None), (5001, ""), (5002, "\n \t"), (5000, None), (None, "x y " * 6)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    check_runs(queries.op11_periodic_runs(spark, str(tmp_path)).collect(), texts)


# Fingerprints


def plain_winnow(hashes, window):
    out = []
    for end in range(1, len(hashes) + window if hashes else 0):
        within = range(max(0, end - window), min(end, len(hashes)))
        low = min(hashes[k] for k in within)
        place = max(k for k in within if hashes[k] == low)
        if not out or out[-1] != place:
            out.append(place)
    return out


@settings(max_examples=300, deadline=None)
@given(st.text("ab é𝔸", max_size=60), st.integers(1, 9), st.integers(1, 9))
def test_winnowing(text, gram, window):
    hashes = fingerprints.gram_hashes(fingerprints.code_points(text), gram)
    assert len(hashes) == (len(text) - min(gram, len(text)) + 1 if text else 0)
    seen = {}
    for k, h in enumerate(hashes.tolist()):
        assert seen.setdefault(text[k : k + gram], h) == h
    places = fingerprints.winnow(hashes, window)
    assert places.tolist() == plain_winnow(hashes.tolist(), min(window, len(hashes)))
    back, at = fingerprints.decode(fingerprints.encode(hashes, places))
    assert (back == hashes[places]).all() and (at == places).all()


@settings(max_examples=200, deadline=None)
@given(st.text("abcdefg ", max_size=40), st.text("abcdefg ", min_size=23, max_size=40), st.text("abcdefg ", max_size=40))
def test_shared_passages_are_met(before, passage, after):
    """A passage of GRAM + WINDOW - 1 code points leaves a hash at the same place of it in both texts."""
    assert fingerprints.GRAM + fingerprints.WINDOW - 1 == 23
    texts = (before + passage + after, after[::-1] + passage + before[::-1])
    starts = (len(before), len(after))
    found = []
    for text, start in zip(texts, starts, strict=True):
        hashes, places = fingerprints.decode(fingerprints.fingerprint(text)[0])
        found.append({(h, p - start) for h, p in zip(hashes.tolist(), places.tolist(), strict=True) if start <= p <= start + len(passage) - fingerprints.GRAM})
    assert found[0] & found[1]


def check_fingerprints(rows, texts):
    """``texts`` are distinct documents in descending order; each row's fingerprint is that of its text."""
    follows = {texts[k]: texts[(k + 1) % len(texts)] for k in range(len(texts))}
    for r, (doc_id, text) in rows:
        n = len(text)
        edited = text[: n - n // 3] + follows[doc_id, text][1][: n // 3]
        assert r["doc_id"] == doc_id and r["n_chars"] == n
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        sets = []
        for t in (text, edited, follows[doc_id, text][1]):
            hashes = fingerprints.gram_hashes(fingerprints.code_points(t))
            sets.append((fingerprints.encode(hashes, fingerprints.winnow(hashes)), collections.Counter(hashes[fingerprints.winnow(hashes)].tolist())))
        assert r["fingerprint"] == sets[0][0] and r["edited_fingerprint"] == sets[1][0]
        for name, other in (("near_edited", sets[1][1]), ("near_next", sets[2][1])):
            both, either = (sets[0][1] & other).total(), (sets[0][1] | other).total()
            assert r[name] == pytest.approx(both / either if either else 1.0)


def test_fingerprints_query(spark):
    texts = [(r["doc_id"], r["text"] or "") for r in documents(spark).select("doc_id", "text").collect()]
    texts.sort(reverse=True)
    by_id = dict(texts)
    rows = queries.op12_document_fingerprints(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(by_id)
    check_fingerprints([(r, (r["doc_id"], by_id[r["doc_id"]])) for r in rows], texts)
    assert np.median([r["near_edited"] for r in rows]) > 0.4 and np.median([r["near_next"] for r in rows]) < 0.05


def test_fingerprints_of_odd_rows(spark, tmp_path):
    odd(spark).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op12_document_fingerprints(spark, str(tmp_path)).collect()
    texts = collections.Counter((r[0], r[1] or "") for r in odd_rows())
    assert collections.Counter((r["doc_id"], r["n_chars"]) for r in rows) == collections.Counter((k, len(t)) for k, t in texts.elements())
    got = collections.defaultdict(set)
    for r in rows:
        got[r["fingerprint"]].add((r["doc_id"], r["n_chars"]))
    same = collections.defaultdict(set)
    for key, text in texts:
        same[text].add((key, len(text)))
    assert sorted(map(sorted, map(repr, got.values()))) == sorted(map(sorted, map(repr, same.values())))
    lone = {r["doc_id"]: r for r in rows}
    only = spark.createDataFrame([(7, "one text, alone", *["x"] * 3)], "doc_id int, text string, fingerprint string, edited string, copies string")
    alone = fingerprints.compare_with_edited(only).first()
    assert alone["near_next"] == 1.0 and alone["edited"] == "one text, " + "one t" and lone
    none = fingerprints.compare_with_edited(empty(spark))
    assert none.count() == 0 and none.columns == fingerprints.compare_with_edited(only).columns
    first = fingerprints.fingerprint_documents(odd(spark)).collect()
    assert collections.Counter((r["doc_id"], r["fingerprint"]) for r in first) == collections.Counter((r["doc_id"], r["fingerprint"]) for r in rows)


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "the first of the texts is here"), *[(2, "the second one that is repeated")] * 5000, (3, "a third text for the end"), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    found = collections.Counter((r["doc_id"], r["edited"], round(r["near_next"], 6)) for r in fingerprints.compare_with_edited(docs).collect())
    texts = {None: "", 1: rows[0][1], 2: rows[1][1], 3: rows[-3][1]}
    order = [3, 2, 1, None]
    for k, key in enumerate(order):
        text, after = texts[key], texts[order[(k + 1) % 4]]
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        assert sum(n for (d, e, _), n in found.items() if (d, e) == (key, edited)) == {2: 5000, None: 2}.get(key, 1)


# Hard negatives


def plain_mined(rows, every, positives, k, low, high):
    ok = {(i, y, tuple(int(np.floor(256 * float(x))) for x in v)) for i, y, v in rows if None not in (i, y, v) and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, y, v in ok:
        if i % every:
            continue
        scores = {}
        for j, z, w in ok:
            if i != j:
                s = max(min(sum(a * b for a, b in zip(v, w)), 2**62 - 1), 1 - 2**62)
                scores[j, z] = max(s, scores.get((j, z), s))
        chosen = sorted(((-s, j) for (j, z), s in scores.items() if z == y))[:positives]
        for p, j in chosen:
            best = {}
            for (n, z), s in scores.items():
                if z != y and low * -p <= 100 * s <= high * -p:
                    best[n] = max(s, best.get(n, s))
            for r, (s, n) in enumerate(sorted((-s, n) for n, s in best.items())[:k]):
                out.append((i, j, r + 1, n, -p, -s))
    return sorted(out)


def mined(df):
    return sorted(tuple(r[n] for n in "anchor_id positive_id rank negative_id positive_score negative_score".split()) for r in df.collect())


@pytest.mark.parametrize("block", [3, 4096])
def test_hard_negatives(spark, block):
    rng = np.random.default_rng(5)
    rows = [(int(i), int(y), [float(np.float32(x)) for x in rng.integers(-2, 9, 6) / 64]) for i, y in zip(rng.permutation(300)[:160], rng.integers(0, 3, 160), strict=True)]
    rows += [(0, 1, None), (10, None, [1.0] * 6), (20, 1, [float("nan"), 1.0]), (30, 1, [None]), (None, 1, [1.0]), rows[3], rows[3], (500, 1, [0.1, 0.2]), (500, 2, [0.1, 0.2, 0.3]), (510, 1, [])]
    rows += [(501, 1, rows[0][2]), (502, 1, rows[0][2]), (503, 2, rows[0][2]), (500, 1, [0.2, 0.1])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, label int, embedding array<float>, row_key string, score string").repartition(3)
    exact = [(i, y, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, y, v in rows]
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, anchor_rows=block, candidate_rows=block)
    want = plain_mined(exact, 10, 5, 3, 50, 95)
    assert mined(got) == want and len(want) > 50
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_hard_negatives_beyond_exact_floats(spark):
    rows = [(k * 10, k % 2, [float(np.float32(4e5 * (k + 3))), float(np.float32(-1e4 * k - 0.3))]) for k in range(12)] + [(7, 1, [float(np.float32(3e25))])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    cut = [(i, y, [np.float32(x) for x in v]) for i, y, v in rows]
    longs = 2**63 - 1
    want = plain_mined([(i, y, [min(float(x), longs / 256) for x in v]) for i, y, v in cut], 10, 5, 3, 50, 95)
    assert mined(negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)) == want and want


def test_hard_negatives_by_hand(spark):
    vectors = [(0, 0, [1.0]), (1, 0, [1.0]), (2, 0, [0.5]), (3, 1, [0.96]), (4, 1, [0.9]), (5, 1, [0.9]), (6, 2, [0.5]), (8, 2, [0.4])]
    df = spark.createDataFrame(vectors, "vec_id long, label int, embedding array<float>")
    got = mined(negatives.hard_negatives(df, F.col("vec_id") == 0))
    assert [(p, r, n) for _, p, r, n, _, _ in got] == [(1, 1, 4), (1, 2, 5), (1, 3, 6), (2, 1, 8)]
