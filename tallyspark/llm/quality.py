"""Quality rules as one projection of built-in functions.

A table of thresholds is compiled into a single boolean expression over length,
symbol, stop-word and line ratios. There is no join, no shuffle and no user
function: one narrow pass over the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import SPACE_CLASS, WORD_CLASS

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
REPEAT_WINDOW = 8

STOP_WORDS = {
    "en": "the of and to in a is that for it was on be with as by at from this are or an not which",
    "de": "der die das und in den von zu mit ist des im für auf ein eine nicht als auch es dem",
    "fr": "le la les de des et un une du que qui dans est en pour pas sur au il elle",
    "es": "el la los las de y que en un una por con no es se del lo para su al",
}


@dataclass(frozen=True)
class Rule:
    """Keep a document while ``low * per <= measure <= high * per`` (a missing bound is open)."""

    name: str
    measure: str
    per: str | None
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        per = F.col(self.per) if self.per else F.lit(1)
        held = F.lit(True)
        if self.low is not None:
            held &= F.col(self.measure) >= F.lit(self.low) * per
        if self.high is not None:
            held &= F.col(self.measure) <= F.lit(self.high) * per
        return held


#: The production thresholds, one row a rule.
RULES = (
    Rule("length", "n_words", None, 20),
    Rule("word_length", "word_chars", "n_words", 2.5, 10.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("stop_words", "n_stop_words", "n_words", 0.04, None),
    Rule("letters", "n_letter_words", "n_words", 0.7, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.4),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 0.5),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.3),
)


def measures(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the counts that the rules compare.

    Each array is referred to more than once by the step after it, so that the
    optimizer evaluates it once instead of inlining it into a lambda.
    """
    stop = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    size, k = F.size, REPEAT_WINDOW
    body = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(*keep, body.alias("__body"))
    d = d.select(
        *keep,
        "__body",
        F.array_remove(F.split("__body", SPACE_CLASS + "+"), "").alias("__words"),
        F.filter(F.split("__body", "\n"), lambda line: line.rlike(WORD_CLASS)).alias("__lines"),
    )
    d = d.select(
        *keep,
        size("__words").cast("long").alias("n_words"),
        F.length(F.translate("__body", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("__body") - F.length(F.translate("__body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        size("__lines").cast("long").alias("n_lines"),
        (size("__lines") - size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        size(F.filter("__lines", lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long").alias("n_ellipsis_lines"),
        size(F.filter("__words", lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")).isin(stop))).cast("long").alias("n_stop_words"),
        size(F.filter("__words", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"),
    )
    counts = [c for c in d.columns if not c.startswith("__") and c not in keep]
    d = d.select(
        *keep,
        *counts,
        F.when(
            size("__hashes") >= k,
            F.transform(
                F.sequence(F.lit(0), size("__hashes") - k),
                lambda i: F.xxhash64(*[F.get("__hashes", i + j) for j in range(k)]),
            ),
        ).alias("__windows"),
    )
    # Only texts in which a window returns pay for the sort.
    returns = size("__windows") > size(F.array_distinct("__windows"))
    d = d.select(
        *keep,
        *counts,
        F.when(
            returns,
            F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("__sorted"),
    )

    def same(x: Column, j: Column) -> Column:
        return F.coalesce(F.get("__sorted", j)["h"] == x["h"], F.lit(False))

    d = d.select(
        *keep,
        *counts,
        F.array_sort(
            F.transform(F.filter("__sorted", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"])
        ).alias("__starts"),
    )
    covered = F.aggregate(
        F.transform("__starts", lambda p, i: F.least(F.lit(k), F.coalesce(F.get("__starts", i + 1) - p, F.lit(k)))),
        F.lit(0),
        lambda a, b: a + b,
    )
    # The zero counts as not deterministic: else a filter on the verdict would be pushed below, with all arrays inlined.
    zero = F.monotonically_increasing_id() * 0
    return d.select(*keep, *counts, (F.coalesce(covered, F.lit(0)) + zero).cast("long").alias("n_repeat_words"))


def judge(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each row of ``docs``: ``keep``, the counts, ``base_failed``, ``failed_rules`` and ``kept``.

    A null text counts as an empty one and fails. Rows are judged one by one, so
    repeated rows and null ids pass through; an empty table gives an empty
    result. Columns of ``docs`` beside ``keep`` and ``text`` aren't read, so
    extra columns can have any name. A text with no word has no ratio and fails
    by its length alone.
    """
    m = measures(docs, text, list(keep))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]))
    m = m.withColumns({"base_failed": base, "failed_rules": failed})
    return m.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    columns = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("__row")
    packed = docs.select(row, F.col(text).alias("__text"))
    judged = judge(packed, "__text", ("__row",), rules)
    return judged.filter("kept").select(*[F.col("__row")[c].alias(c) for c in columns])
