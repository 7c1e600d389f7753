"""Secret scan: patterns, and a character convolutional network over every candidate in its context.

The network is small and written in numpy. It is trained on labelled findings
made from rules (``labelled``; their number is a parameter), its scores are
calibrated on findings held out from training, and its threshold is the highest
that still recalls the wanted share of secrets in a third part. It slides over
the whole of a candidate; the highest score counts.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

#: Characters of a candidate, of the text before and after them that the network sees at once, and its step along a candidate.
BODY, BEFORE, AFTER, STEP = 64, 24, 16, 32
#: Labelled findings, the shares of them for calibration and for the threshold, and the share of secrets to recall.
LABELLED = 6000
CALIBRATE, DECIDE = 0.2, 0.25
RECALL = 0.98
_WIDTH, _EMBED, _FILTERS = 5, 8, 24
_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-.:;,\"'()<>@#$%&*!? \n"
_CODE = {c: k + 2 for k, c in enumerate(_ALPHABET)}  # 0: nothing there, 1: any other


def _codes(text: str, start: int, end: int, at: int = 0) -> np.ndarray:
    """What the network sees of a candidate from its character ``at`` on."""
    left, right = start + at, min(end, start + at + BODY)
    before = text[max(0, left - BEFORE) : left].rjust(BEFORE, "\0")
    body = text[left:right].ljust(BODY, "\0")
    after = text[right : right + AFTER].ljust(AFTER, "\0")
    return np.array([0 if c == "\0" else _CODE.get(c, 1) for c in before + body + after], np.uint8)


def views(text: str, start: int, end: int) -> list[np.ndarray]:
    """``_codes`` at overlapping places that cover a candidate, its last characters included."""
    last = max(0, end - start - BODY)
    return [_codes(text, start, end, at) for at in [*range(0, last, STEP), last]]


def labelled(n: int, seed: int = 7) -> list[tuple[str, int, int, int]]:
    """``n`` findings (text, start, end, label): random keys in the places where keys stand, and what only looks like one.

    Some are longer than the network sees at once: paths, and paths that end in a key.
    """
    rng = random.Random(seed)
    hexes, base64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    syllables = "ing er th an on re ed ti es or st en at ar nt al le is ur schen keit ver ung ción mente tion eau que".split()

    clusters = "sch pf tz ch st th ng nd rt tr br gl str pfl schl cht lich pfung chst".split()

    def word() -> str:
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def chars(of: str, a: int, b: int) -> str:
        return "".join(rng.choice(of) for _ in range(rng.randint(a, b)))

    def long_word() -> str:
        out = ""
        while len(out) < 16:
            out += rng.choice(syllables).encode("ascii", "ignore").decode()
        return rng.choice((str, str.capitalize, str.upper))(out)

    def rough_word() -> str:
        """Letters of one case, clusters of consonants and all: no language's words in particular."""
        out = ""
        while len(out) < 16:
            out += chars("bcdfghklmnprstvwz", 1, 5) + chars("aeiou", 1, 2) if rng.random() < 0.6 else rng.choice(clusters) + chars("aeiou", 0, 2)
        return rng.choice((str, str.capitalize, str.upper))(out + chars("aeiounrst", 0, 8))

    def path(most: int) -> str:
        out = ""
        while len(out) < most:
            out += (word().encode("ascii", "ignore").decode() or "a") + rng.choice("/-_/")
        return out

    secret = (
        lambda: chars(hexes, 32, 64),
        lambda: chars(base64, 20, 60),
        lambda: chars(base64[:62], 20, 44),
        lambda: chars(base64[:62], 38, 60) + "=",
        lambda: rng.choice(("sk", "pk", "key", "ghp", "live")) + rng.choice("_-") + chars(base64[:62], 16, 40),
        lambda: "AKIA" + chars(base64[:26] + base64[52:62], 16, 16),
    )
    plain = (
        long_word,
        rough_word,
        rough_word,
        rough_word,
        lambda: rng.choice("-_/").join(word().encode("ascii", "ignore").decode() or "a" for _ in range(rng.randint(4, 8))).ljust(16, "a"),
        lambda: chars("0123456789", 16, 24),
        lambda: rng.choice("=-_+/") * rng.randint(16, 60),
        lambda: rng.choice("abcxyz") * rng.randint(16, 40),
        lambda: "/".join(long_word() for _ in range(2)),
        lambda: f"{rng.randint(1990, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}" + rng.choice(("T", "_", "-")) + chars("0123456789", 6, 6),
        lambda: "".join(long_word().capitalize() for _ in range(2)),
    )
    named = ('key = "', "secret: ", "Authorization: Bearer ", "export TOKEN=", 'auth="', "credential ", "pwd=", "access key ")
    unnamed = (" ", " ", ", ", "\n", ". ", " | ", "(", "see ", "the ")
    out = []
    for k in range(n):
        label = k % 2
        body = rng.choice(secret if label else plain)()
        if rng.random() < 0.04:
            body = path(rng.randint(70, 160)) + (body if label else word().encode("ascii", "ignore").decode())
        lead = rng.choice(named) if rng.random() < (0.6 if label else 0.05) else rng.choice(unnamed)
        before = " ".join(word() for _ in range(5)) + " " * rng.randint(0, 1) + lead
        out.append((before + body + rng.choice((" ", '"', ".", "\n")) + word(), len(before), len(before) + len(body), label))
    return out


@dataclass
class Network:
    """Embedding, one convolution, maximum and mean over places, one dense layer; then scale and shift of the logit."""

    embed: np.ndarray
    conv: np.ndarray
    conv_bias: np.ndarray
    dense: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def _forward(self, codes: np.ndarray):
        x = self.embed[codes]
        seen = np.lib.stride_tricks.sliding_window_view(x, _WIDTH, axis=1)  # (n, places, embed, width)
        flat = np.ascontiguousarray(seen.transpose(0, 1, 3, 2)).reshape(len(codes), seen.shape[1], -1)
        z = flat @ self.conv + self.conv_bias
        a = np.maximum(z, 0)
        top = a.argmax(axis=1)
        features = np.concatenate([np.take_along_axis(a, top[:, None], 1)[:, 0], a[:, BEFORE:].mean(axis=1)], axis=1)
        return flat, z, top, features, features @ self.dense + self.bias

    def probability(self, codes: np.ndarray) -> np.ndarray:
        logit = self._forward(codes)[-1]
        return 1 / (1 + np.exp(-np.clip(self.scale * logit + self.shift, -30, 30)))

    def highest(self, seen: list[list[np.ndarray]], batch: int = 512) -> np.ndarray:
        """The highest probability among the views of each candidate."""
        if not seen:
            return np.empty(0)
        flat = [v for views_ in seen for v in views_]
        scores = np.concatenate([self.probability(np.stack(flat[at : at + batch])) for at in range(0, len(flat), batch)])
        return np.maximum.reduceat(scores, np.cumsum([0, *map(len, seen[:-1])]))

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        flat, z, top, features, logit = self._forward(codes)
        n, places = z.shape[:2]
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) / n
        d = error[:, None] * self.dense
        da = np.zeros_like(z)
        np.put_along_axis(da, top[:, None], d[:, None, :_FILTERS], 1)
        da[:, BEFORE:] += d[:, None, _FILTERS:] / (places - BEFORE)
        dz = da * (z > 0)
        dflat = (dz @ self.conv.T).reshape(n, places, _WIDTH, _EMBED)
        dembed = np.zeros_like(self.embed)
        for w in range(_WIDTH):
            np.add.at(dembed, codes[:, w : w + places], dflat[:, :, w])
        conv = np.tensordot(flat, dz, axes=((0, 1), (0, 1)))
        return {"embed": dembed, "conv": conv, "conv_bias": dz.sum((0, 1)), "dense": features.T @ error, "bias": error.sum()}


def train(findings: list[tuple[str, int, int, int]], recall: float = RECALL, epochs: int = 6, seed: int = 7) -> Network:
    """Adam on the larger part of the findings, scale and shift from a second, the threshold from a third.

    Of a long secret the last view is learnt, where the key of ``labelled`` stands; of what is none, all views.
    """
    rng = np.random.default_rng(seed)
    seen = [views(t, a, b) for t, a, b, _ in findings]
    labels = np.array([y for *_, y in findings], float)
    calibrate, decide, used = np.split(rng.permutation(len(seen)), [int(len(seen) * CALIBRATE), int(len(seen) * (CALIBRATE + DECIDE))])
    learnt = [(v, labels[i]) for i in used for v in (seen[i][-1:] if labels[i] else seen[i])]
    codes, of = np.stack([v for v, _ in learnt]), np.array([y for _, y in learnt])
    net = Network(
        rng.normal(0, 0.3, (len(_ALPHABET) + 2, _EMBED)), rng.normal(0, 0.2, (_WIDTH * _EMBED, _FILTERS)), np.zeros(_FILTERS), rng.normal(0, 0.2, 2 * _FILTERS), 0.0
    )
    first: dict = {}
    second: dict = {}
    step = 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(codes)), max(1, len(codes) // 64)):
            step += 1
            for name, g in net.gradients(codes[part], of[part]).items():
                first[name] = 0.9 * first.get(name, 0) + 0.1 * g
                second[name] = 0.999 * second.get(name, 0) + 0.001 * g * g
                move = 0.01 * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, getattr(net, name) - move)
    p = net.highest([seen[i] for i in calibrate])
    logit, y = np.log(p / (1 - p)), labels[calibrate]
    for _ in range(200):  # scale and shift by gradient descent
        p = 1 / (1 + np.exp(-np.clip(net.scale * logit + net.shift, -30, 30)))
        net.scale -= 0.1 * float(((p - y) * logit).mean())
        net.shift -= 0.1 * float((p - y).mean())
    found = np.sort(net.highest([seen[i] for i in decide if labels[i]]))
    net.threshold = float(found[int((1 - recall) * len(found))]) if len(found) else 0.5
    return net


@lru_cache(maxsize=4)
def default_network(n: int = LABELLED) -> Network:
    return train(labelled(n))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds by start, then kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m.group()) >= 16]
    found += [("hex", *m.span()) for m in _LONG_HEX.finditer(text)]
    found.sort(key=lambda x: (x[1], KINDS.index(x[0])))
    return found


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Long runs of key characters that aren't within a base span, which is judged itself."""
    starts = [a for _, a, _ in base]  # ascending
    reach = list(accumulate((e for *_, e in base), max))
    found = []
    for m in CANDIDATE.finditer(text):
        before = bisect_right(starts, m.start())
        if not before or reach[before - 1] < m.end():
            found.append(m.span())
    return found


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", network: Network | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans, found.

    Counts and hash are of the base spans; ``spans`` joins these and the
    candidates that the network takes (kind network), by start, then kind;
    ``n_spans`` counts them and ``found`` adds the calibrated probability. Base
    spans stay whatever theirs is. Offsets are code points of the whole text. A null text counts as an empty one. Rows are
    scanned one by one: repeated rows and null ids pass through, other columns
    aren't read, an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network or default_network())  # a few kB whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for b in batches:
            texts = [x or "" for x in b.column(1).to_pylist()]
            bases = [base_spans(x) for x in texts]
            asked = [(k, *x) for k, base in enumerate(bases) for x in (*base, *[("network", *c) for c in candidates(texts[k], base)])]
            every: list[list] = [[] for _ in texts]
            for at in range(0, len(asked), 512):
                part = asked[at : at + 512]
                for (k, kind, a, e), p in zip(part, net.highest([views(texts[k], a, e) for k, _, a, e in part]), strict=True):
                    if kind != "network" or p >= net.threshold:
                        every[k].append((kind, a, e, round(float(p), 6)))
            out: list[list] = [[] for _ in range(7)]
            for base, found in zip(bases, every, strict=True):
                found.sort(key=lambda x: (x[1], (*KINDS, "network").index(x[0])))
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows = [dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in found]
                for column, value in zip(out, (*[sum(x[0] == k for x in base) for k in KINDS], digest, joined(x[:3] for x in found), len(found), rows), strict=True):
                    column.append(value)
            span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.string(), pa.int64(), span]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(out, kinds, strict=True)]], ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_spans", "found"])

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return picked.mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string, n_spans long, found array<struct<kind: string, start: bigint, end: bigint, score: double>>")
