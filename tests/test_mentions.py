"""Mentions against a plain scan."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.operators import mentions


def plain(text, aliases):
    """Leftmost, longest, none within another."""
    spans = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(mentions.WORD, text or "")]
    at, out = 0, []
    while at < len(spans):
        fits = [a for a in aliases if [s[2] for s in spans[at : at + len(a.split())]] == a.split()]
        best = max(fits, key=lambda a: len(a.split()), default=None)
        if best is None:
            at += 1
            continue
        n = len(best.split())
        out.append((spans[at][0], spans[at + n - 1][1], best))
        at += n
    return out


ROWS = [("Acme", 1), ("ACME Tools", 1), ("acme, tools & dies", 2), ("tools dies inc", 3), ("blue", 4), ("Blue", 5), ("!!", 6), (None, 7)]


@pytest.mark.parametrize("most", [2, 1000])
def test_mentions(spark, most):
    texts = ["Acme Tools  & dies inc sells Blue.", "tools dies INC; acme tools, acme", "", None, "nothing", "ácme Acme.", "acme acme tools dies blue blue"]
    aliases = mentions.alias_table(spark.createDataFrame(ROWS, "alias string, entity int"), "entity", "alias")
    known = {r["words"]: r["entity"] for r in aliases.collect()}
    assert known == {"acme": 1, "acme tools": 1, "acme tools dies": 2, "tools dies inc": 3, "blue": None}
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = sorted((r["k"], r["start"], r["stop"], r["words"], r["entity"]) for r in mentions.mentions(df, "k", "t", aliases, most).collect())
    assert got == sorted((k, a, b, w, known[w]) for k, t in enumerate(texts) for a, b, w in plain(t, known)) and len(got) > 9
    assert mentions.mentions(df, "k", "t", aliases.limit(0)).count() == 0 and mentions.mentions(df.limit(0), "k", "t", aliases).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ab ,", max_size=30), min_size=1, max_size=5))
def test_mentions_in_any_text(spark, texts):
    aliases = mentions.alias_table(spark.createDataFrame([("a", 1), ("a b", 2), ("b b a", 3), ("ab", 4)], "alias string, entity int"), "entity", "alias")
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = sorted((r["k"], r["start"], r["stop"], r["words"]) for r in mentions.mentions(df, "k", "t", aliases).collect())
    assert got == sorted((k, *m) for k, t in enumerate(texts) for m in plain(t, ["a", "a b", "b b a", "ab"]))
