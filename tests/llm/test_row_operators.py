"""Quality rules, personal data and secrets: row by row, against plain Python and SQL."""

import collections
import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import oracles, pii, quality, queries, secrets
from tests.llm.helpers import SF, WORD, documents, empty, odd, odd_rows
from tests.oracle import connect, duck_rows, spark_rows


def test_sql_queries(spark):
    duck = connect(SF)
    for name, sql in oracles.SQL.items():
        assert spark_rows(queries.QUERIES[name](spark, SF)) == duck_rows(duck, sql), name


def counted(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    for docs in (documents(spark), odd(spark)):
        texts = [r["text"] for r in docs.collect()]
        got = quality.judge(docs).collect()
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert sorted(tuple(r[n] for n in names) for r in got) == sorted(map(counted, texts))
        assert all(r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) for r in got)
        assert not any(r["kept"] and r["base_failed"] for r in got)


def test_quality_keeps_clean_rows_whole(spark):
    kept = quality.keep_good(odd(spark))
    assert kept.columns == odd(spark).columns
    assert {r["doc_id"] for r in kept.collect()} >= {0, 1, 12, None}
    assert quality.keep_good(empty(spark)).count() == 0
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/labels.parquet")
    judged = quality.judge(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")).join(labels, "doc_id").filter("not base_failed").toPandas()
    good, bad = judged[judged.quality == 1], judged[judged.quality == 0]
    assert good.kept.mean() > 0.99 and bad.kept.mean() < 0.35


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_pii(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15],
    }


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@+-% 0123456789()é\n", max_size=60))
def test_pii_base_spans(text):
    assert pii.base_spans(text) == plain_pii(text)


def test_pii_validators_and_context():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765431")
    found = lambda t: {(k, t[a:b]) for k, a, b, _ in pii.find(t)[1]}
    assert found("pay to GB82 WEST 1234 5698 7654 32 today") == {("iban", "GB82 WEST 1234 5698 7654 32")}
    assert found("pay to GB82 WEST 1234 5698 7654 31 today") == set()
    assert found("my SSN 123-45-6789 is") == {("ssn", "123-45-6789")} and found("part 123-45-6789 is") == set()
    assert found("call 555-123-4567 now") == {("phone", "555-123-4567")} and found("number 555-123-4567") == set()
    assert ("card", "4539578763621486") in found("cards 4539578763621486 4539578763621487 here")


def test_pii_rows(spark):
    for docs in (documents(spark), odd(spark)):
        texts = collections.Counter(r["text"] for r in docs.collect())
        got = pii.scan(docs)
        assert got.count() == sum(texts.values())
        hashes = collections.Counter(r["base_sha256"] for r in got.collect())
        want = collections.Counter()
        for t, n in texts.items():
            base = plain_pii(t or "")
            want[hashlib.sha256(",".join(f"{k}:{a}:{b}" for k in pii.BASE_KINDS for a, b in base[k]).encode()).hexdigest()] += n
        assert hashes == want
    assert pii.scan(empty(spark)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="AKIAtokensecretpw=:\"' 0123456789abcdef-_", max_size=90))
def test_secret_base_spans(text):
    want = [("assign", *m.span()) for m in secrets.ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    want += [("access", *m.span()) for m in secrets.ACCESS.finditer(text) if len(m.group()) >= 16]
    want += [("hex", *m.span()) for m in secrets.HEX.finditer(text) if m.end() - m.start() >= 32]
    assert secrets.base_spans(text) == sorted(want, key=lambda x: (x[1], secrets.KINDS.index(x[0])))


def test_secret_network_on_held_out_findings():
    net = secrets.default_network()
    findings = secrets.labelled(2000, seed=101)
    y = np.array([f[3] for f in findings])
    taken = net.probability(np.stack([secrets._codes(*f[:3]) for f in findings])) >= net.threshold
    assert taken[y == 1].mean() > 0.9 and taken[y == 0].mean() < 0.01


def test_secret_gradients():
    net = secrets.train(secrets.labelled(40), epochs=1)
    findings = secrets.labelled(8, seed=3)
    codes, y = np.stack([secrets._codes(*f[:3]) for f in findings]), np.array([f[3] for f in findings], float)

    def loss():
        z = net._forward(codes)[-1]
        return np.mean(np.logaddexp(0, z) - y * z)

    grads = net.gradients(codes, y)
    for name in ("embed", "conv", "conv_bias", "dense"):
        value = getattr(net, name)
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        value[at] += 1e-5
        up = loss()
        value[at] -= 2e-5
        down = loss()
        value[at] += 1e-5
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-4


def test_secret_rows(spark):
    got = secrets.scan(odd(spark))
    assert got.count() == len(odd_rows()) and secrets.scan(empty(spark)).count() == 0
    key = "Zx9Q2kLm84RtYw7PbN3vHs6JdF1gTc5A"
    row = spark.createDataFrame([(1, f'the key is "{key}" for now')], "doc_id long, text string")
    spans = secrets.scan(row).first()["spans"]
    assert spans == f"network:12:{12 + len(key)}"
    found = secrets.scan(documents(spark)).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark).collect()}
    for r in found:
        base = secrets.base_spans(texts[r["doc_id"]])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(b[0] == k for b in base) for k in secrets.KINDS)


def plain_probability(net, codes):
    """The network's forward pass, number by number."""
    x = [[float(v) for v in net.embed[c]] for c in codes]
    width, wide = len(net.conv) // len(x[0]), len(x[0])
    places = len(x) - width + 1
    features = []
    for kind in ("top", "mean"):
        for f in range(len(net.conv_bias)):
            values = []
            for p in range(places):
                z = float(net.conv_bias[f]) + sum(x[p + w][e] * float(net.conv[w * wide + e, f]) for w in range(width) for e in range(wide))
                values.append(max(z, 0.0))
            features.append(max(values) if kind == "top" else sum(values[secrets.BEFORE :]) / (places - secrets.BEFORE))
    logit = sum(a * float(b) for a, b in zip(features, net.dense, strict=True)) + float(net.bias)
    return 1 / (1 + np.exp(-(net.scale * logit + net.shift)))


def test_secret_network_by_plain_loops():
    net = secrets.default_network()
    for text, a, b, _ in secrets.labelled(6, seed=5):
        codes = secrets._codes(text, a, b)
        assert abs(plain_probability(net, codes) - net.probability(codes[None])[0]) < 1e-9


def test_secret_recall_on_findings_not_used_in_fitting():
    net = secrets.default_network()
    for seed in (201, 202, 203):
        findings = secrets.labelled(3000, seed=seed)
        y = np.array([f[3] for f in findings])
        taken = net.highest([secrets.views(*f[:3]) for f in findings]) >= net.threshold
        assert taken[y == 1].mean() >= 0.95 and taken[y == 0].mean() < 0.02


def test_secret_network_sees_whole_candidates():
    net = secrets.default_network()
    key = "Zx9Q2kLm84RtYw7PbN3vHs6JdF1gTc5A"
    text = "see " + "usr/share/lib/ration/unding/ester/ingen/" * 6 + key + " end"
    seen = secrets.views(text, 4, len(text) - 4)
    assert net.highest([seen])[0] >= net.threshold > net.highest([seen[:1]])[0]
    ends = np.array([v[secrets.BEFORE + secrets.BODY :] for v in seen])
    assert "".join(secrets._ALPHABET[c - 2] for c in ends[-1][:4]) == " end"


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_secrets(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def test_secret_hashes_and_spans_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = secrets.default_network()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in secrets.scan(docs).collect():
        base = plain_secrets(texts[r["doc_id"]])
        told = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(told(base).encode()).hexdigest()
        text = texts[r["doc_id"]]
        runs = [m.span() for m in re.finditer("[A-Za-z0-9+/_=-]{16,}", text)]
        runs = [x for x in runs if not any(a <= x[0] and x[1] <= b for _, a, b in base)]
        more = [("network", a, b) for a, b in runs if net.highest([secrets.views(text, a, b)])[0] >= net.threshold]
        kinds = (*secrets.KINDS, "network")
        assert r["spans"] == told(sorted(base + more, key=lambda x: (x[1], kinds.index(x[0])))) and r["n_spans"] == len(base + more)


def test_pii_spans_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in pii.scan(docs).collect():
        base = plain_pii(texts[r["doc_id"]])
        first = [(k, a, b) for k in pii.BASE_KINDS for a, b in base[k]]
        added = [(k, a, b) for k, a, b, _ in pii.find(texts[r["doc_id"]])[1]]
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [len(base[k]) for k in pii.BASE_KINDS]
        assert not any(a < e and s < b for _, a, b in added for _, s, e in first)
        want = sorted(first + added, key=lambda x: (pii.KINDS.index(x[0]), x[1], x[2]))
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in want) and r["n_spans"] == len(want)


def test_many_spans_in_a_text_take_little_time():
    import time

    began = time.perf_counter()
    text = "a@b.cd call 555-123-4567 +1 555 123 4567; " * 20_000
    assert len(pii.find(text)[1]) == 20_000
    text = "token=abcdefgh1234 deadbeefdeadbeefdeadbeefdeadbeef some/long-path_of_words " * 20_000
    assert len(secrets.candidates(text, secrets.base_spans(text))) == 20_000
    assert time.perf_counter() - began < 8


def test_very_long_clean_document_is_kept(spark):
    sentence = "The house of the river and the garden {k} is an old one that was in the town by the sea for a long time.\n"
    text = "".join(sentence.format(k=f"n{k}x") for k in range(52_000))
    row = quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_words"] > 1_000_000 and row["kept"] == (not row["base_failed"])
