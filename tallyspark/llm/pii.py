"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Proposals of the base kinds are taken as they are. Further proposals - card
numbers inside longer runs of digits, account numbers (mod 97), numbers that
nearby words call a phone or a social security number - start from their kind's
score, gain by a valid checksum and by context words, and are kept from
``KEEP`` on.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
KEEP = 0.6
CONTEXT = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GROUP = re.compile(r"[0-9]+(?:-[0-9]+)*")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_PLAIN_PHONE = re.compile(r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")

#: kind: (score of a proposal, gain by a valid checksum, gain by a context word, the words)
SCORES = {
    "card": (0.2, 0.4, 0.3, re.compile(r"card|visa|master|amex|credit|debit|karte|carte|tarjeta", re.I)),
    "iban": (0.2, 0.5, 0.2, re.compile(r"iban|account|bank|konto|compte|cuenta", re.I)),
    "ssn": (0.3, 0.0, 0.4, re.compile(r"\bssn\b|social security", re.I)),
    "phone": (0.3, 0.0, 0.4, re.compile(r"phone|\btel\b|\bcall\b|mobile|\bfax\b|telefon|téléphone|teléfono", re.I)),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number, spaces left out, has the remainder 1."""
    turned = account[4:] + account[:4]
    return 15 <= len(account) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """By the at signs, so that long runs without one cost nothing."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Each four parts of a dotted run, if all are at most 255."""
    for run in _DOTTED.finditer(text):
        at = run.start()
        parts = run.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            n = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield at, at + n
            at += n + 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The base kinds' spans, leftmost and without overlap within a kind."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE_KINDS}
    if "@" in text:
        found["email"] = list(_emails(text))
    runs = list(_DIGITS.finditer(text))
    if not runs:
        return found | {"ip": list(_ips(text)), "phone": _phones(text)}
    found["ip"] = list(_ips(text))
    found["card"] = [m.span() for m in runs if 13 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
    found["phone"] = _phones(text)
    return found


def _phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15] if "+" in text else []


def _proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, checksum holds) of what may be added."""
    for run in _DIGITS.finditer(text):
        n = len(_digits(run.group()))
        if n > 19 or n >= 13 and not luhn(_digits(run.group())):
            for m in _GROUP.finditer(text, *run.span()):
                d = m.group().replace("-", "")
                if m.span() != run.span() and 13 <= len(d) <= 19:
                    yield "card", *m.span(), luhn(d)
    for m in _IBAN.finditer(text):
        yield "iban", *m.span(), mod97(m.group().replace(" ", ""))
    for m in _SSN.finditer(text):
        yield "ssn", *m.span(), False
    for m in _PLAIN_PHONE.finditer(text):
        yield "phone", *m.span(), False


def find(text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int, float]]]:
    """The base spans, and the scored spans added to them: (kind, start, end, score)."""
    base = base_spans(text)
    starts, ends = [], []  # of what is taken, as disjoint stretches in order
    for a, b in sorted(x for spans in base.values() for x in spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    added = []
    if any("0" <= c <= "9" for c in text):
        for kind, a, b, valid in _proposals(text):
            start, checksum, context, words = SCORES[kind]
            near = text[max(0, a - CONTEXT) : a] + " " + text[b : b + CONTEXT]
            score = start + checksum * valid + context * bool(words.search(near))
            at = bisect_left(starts, b)
            if score >= KEEP - 1e-9 and (at == 0 or ends[at - 1] <= a):
                added.append((kind, a, b, round(score, 3)))
                starts.insert(at, a)
                ends.insert(at, b)
    return base, added


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans, found.

    Counts and hash are of the base spans; ``spans`` joins all of them,
    ``n_spans`` counts them and ``found`` lists them as (kind, start, end, score) with score 1 for base
    ones. Offsets are code points of the whole text. A null text counts as an
    empty one. Rows are scanned one by one: repeated rows and null ids pass
    through, other columns aren't read, an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for body in b.column(1).to_pylist():
                base, added = find(body or "")
                first = [(k, a, e) for k in BASE_KINDS for a, e in base[k]]
                every = [(k, a, e, 1.0) for k, a, e in first] + added
                every.sort(key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
                digest = hashlib.sha256(joined(first).encode()).hexdigest()
                row = (*[len(base[k]) for k in BASE_KINDS], digest, joined([x[:3] for x in every]), len(every), [dict(zip(("kind", "start", "end", "score"), x, strict=True)) for x in every])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64(), span]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(out, kinds, strict=True)]], ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "n_spans", "found"])

    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return picked.mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string, n_spans long, found array<struct<kind: string, start: bigint, end: bigint, score: double>>")
