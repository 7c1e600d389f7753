"""Readers of merger texts as column expressions: offers, stock terms, premiums, dates, parties.

A reader gathers every passage of its kind in the text and chooses among them in
a stated order; patterns are this module's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_DATE = rf"((?:{MONTHS}) [0-9]{{1,2}}, [0-9]{{4}})"
#: Passages that state an offer, in order of trust.
OFFER_PATTERNS = (
    r"right to receive \$([0-9]+(?:\.[0-9]+)?) in cash",
    r"\$([0-9]+(?:\.[0-9]+)?) per (?:share|ADS) in cash",
    r"offer price of \$([0-9]+(?:\.[0-9]+)?)",
)
#: What makes a passage no offer: an earlier proposal, a self-tender, a contingent payment, a number of shares.
REFUSALS = r"(?i)(earlier proposal|previously proposed|initial proposal|repurchase|self-tender|contingent value|milestone)"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), 1)


def _once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value worked out once, however often it is named there: a lambda names a variable, not its expression."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def offer(text: Column) -> Column:
    """struct(price, stated, refused): the figure stated most often, ties to the earlier pattern, then the higher figure.

    Sentences of an earlier proposal, a repurchase or a contingent payment don't
    count; where all are such, there is no price and ``refused`` is true.
    """
    sentences = F.split(F.regexp_replace(text, r"\s+", " "), r"(?<=[.;!?]) (?=[A-Z\"])")
    named = F.filter(sentences, lambda s: s.contains("$"))  # every pattern has one

    def stated(sentence: Column) -> Column:
        figures = lambda no, pattern, k: F.transform(_all(sentence, pattern), lambda v: F.struct(v.cast("double").alias("v"), F.lit(k).alias("k"), no.alias("no")))
        return _once(sentence.rlike(REFUSALS), lambda no: F.concat(*[figures(no, pattern, k) for k, pattern in enumerate(OFFER_PATTERNS)]))

    def choose(every: Column, paid: Column) -> Column:
        ranked = F.transform(
            F.array_distinct(F.transform(paid, lambda x: x["v"])),
            lambda v: _once(F.filter(paid, lambda x: x["v"] == v), lambda of: F.struct(F.size(of).alias("n"), (-F.array_min(F.transform(of, lambda x: x["k"]))).alias("k"), v.alias("v"))),
        )
        refused = (F.size(paid) == 0) & (F.size(every) > 0)
        return _once(F.array_max(ranked), lambda best: F.struct(best["v"].alias("price"), F.coalesce(best["n"], F.lit(0)).alias("stated"), refused.alias("refused")))

    return _once(F.flatten(F.transform(named, stated)), lambda every: _once(F.filter(every, lambda x: ~x["no"]), lambda paid: choose(every, paid)))


def consideration(text: Column) -> Column:
    """cash, stock, mixed or none, by what a holder has the right to receive."""
    cash, stock = text.rlike(r"(?i)\$[0-9.]+ (?:per (?:share|ADS) )?in cash"), text.rlike(r"(?i)[0-9.]+ (?:of a )?shares? of [A-Z]?[\w ]{0,40}common stock")
    return F.when(cash, F.when(stock, "mixed").otherwise("cash")).otherwise(F.when(stock, "stock").otherwise("none"))


def exchange_ratio(text: Column) -> Column:
    """Shares for one, as first stated."""
    return F.try_to_number(F.regexp_extract(text, r"(?i)exchange ratio of ([0-9]+\.[0-9]+)", 1), F.lit("99.999999")).cast("double")


def ads_ratio(text: Column) -> Column:
    """Ordinary shares that one ADS stands for; null if not told."""
    words = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "ten": 10}
    said = F.lower(F.regexp_extract(text, r"(?i)each ADS represent(?:s|ing) ([a-z]+|[0-9]+) (?:ordinary|common|Class A)", 1))
    table = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return F.coalesce(F.element_at(table, said), F.expr("try_cast(null as int)"), F.when(said.rlike("^[0-9]+$"), said.cast("int")))


def offer_unit(text: Column) -> Column:
    """ads or share: what the text quotes its price for more often; share on a tie."""
    return F.when(F.regexp_count(text, F.lit(r"per ADS\b")) > F.regexp_count(text, F.lit(r"per (?:ordinary )?share\b")), "ads").otherwise("share")


def premium(text: Column) -> Column:
    """The premium that most speaks for an undisturbed price: one over an unaffected price, then over a closing price, then the first; as a share."""
    found = [F.get(_all(text, p), F.lit(0)) for p in (r"(?i)premium of (?:approximately )?([0-9]+(?:\.[0-9]+)?)% [^.]*unaffected", r"(?i)premium of (?:approximately )?([0-9]+(?:\.[0-9]+)?)% [^.]*closing", r"(?i)premium of (?:approximately )?([0-9]+(?:\.[0-9]+)?)%")]
    return F.round(F.coalesce(*found).cast("double") / 100, 6)


def agreement_date(text: Column) -> Column:
    """The date most often given for the agreement, the earlier of equals."""
    stated = _all(text, rf"(?:dated as of|entered into (?:as of|on)|dated) {_DATE}")
    dates = F.filter(F.transform(stated, lambda d: F.try_to_date(d, "MMMM d, yyyy")), lambda d: d.isNotNull())
    counted = F.transform(F.array_distinct(dates), lambda d: F.struct(F.size(F.filter(dates, lambda x: x == d)).alias("n"), (-F.unix_date(d)).alias("k"), d.alias("d")))
    return F.array_max(counted)["d"]


def amendment_date(text: Column) -> Column:
    """The latest date of an amendment to the agreement."""
    return F.array_max(F.transform(_all(text, rf"(?i)amend(?:ed|ment)[^.]{{0,60}}? (?:as of|on|dated) {_DATE}"), lambda d: F.try_to_date(d, "MMMM d, yyyy")))


def parties(text: Column) -> Column:
    """Names between 'by and among' and the end of the list, without what is said of each."""
    listed = F.regexp_extract(text, r"by and (?:among|between) (.+?)(?:\(the \"Merger Agreement\"\)|\.(?: |$))", 1)
    bare = F.regexp_replace(listed, r" \([^)]*\)|, an? [^,]*?(?:corporation|company|partnership)", "")
    return F.filter(F.transform(F.split(bare, r",? and |, (?!Inc|Ltd|LLC)"), F.trim), lambda x: x != "")


def is_shell(text: Column) -> Column:
    """A blank-check shell: a hundred mentions of the trust account, and five of the initial business combination."""
    low = F.lower(text)
    return (F.regexp_count(low, F.lit("trust account")) >= 100) & (F.regexp_count(low, F.lit("initial business combination")) >= 5)


def target_problem(name: Column, sic: Column, security: Column) -> Column:
    """Why a target isn't one: blank-check shell, closed-end fund, senior or derivative class; null if it is."""
    return (
        F.when((sic == 6770) | name.rlike(r"(?i)\bacquisition corp\b"), "shell")
        .when(name.rlike(r"(?i)\b(closed-end|income fund|municipal fund)\b"), "fund")
        .when(security.rlike(r"(?i)\b(notes?|debentures?|preferred|warrants?|units?|rights?)\b"), "class")
    )


def fee_perimeter(total: Column, parts: Column, tolerance: float = 0.03) -> Column:
    """struct(sum, left_out): the components' sum, and the fewest (one to three) components without which it comes within ``tolerance`` of the total."""
    n = F.size(parts)
    every = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    gap = every - total
    near = lambda v: F.abs(v - gap) <= tolerance * total
    at, none = F.sequence(F.lit(0), n - 1), F.array().cast("array<int>")
    part = lambda i: F.get(parts, i)
    first = lambda places, found: F.aggregate(places, F.lit(None).cast("array<int>"), lambda held, i: F.coalesce(held, found(i)))
    after = lambda i: F.filter(at, lambda j: j > i)

    def last(sofar: Column, places: Column, *taken: Column) -> Column:
        k = F.get(F.filter(places, lambda k: near(sofar + part(k))), F.lit(0))
        return F.when(k.isNotNull(), F.array(*taken, k))

    # One combination is held at a time; the fewest components come first, then the first ones.
    one = last(F.lit(0.0), at)
    two = first(at, lambda i: last(part(i), after(i), i))
    three = first(at, lambda i: first(after(i), lambda j: last(part(i) + part(j), after(j), i, j)))
    out = F.when((n == 0) | (F.abs(gap) <= tolerance * total), none).otherwise(F.coalesce(one, two, three))
    return F.struct(every.alias("sum"), out.alias("left_out"))
