"""Text as column expressions: normalising, slugs, names, links, HTML, amounts, ratios, chunks."""

from __future__ import annotations

import unicodedata
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Lower-case Latin letters with marks and the letters that decomposition leaves of them.
_PAIRS = [(c, unicodedata.normalize("NFKD", c)[0]) for c in map(chr, (*range(0xDF, 0x250), *range(0x1E00, 0x1F00))) if c.islower() and len(unicodedata.normalize("NFKD", c)) > 1]
_ACCENTED, _PLAIN = ("".join(x) for x in zip(*[(a, b) for a, b in _PAIRS if "a" <= b <= "z"], strict=True))
#: Endings that don't tell one company from another.
COMPANY_SUFFIXES = "incorporated|inc|corporation|corp|company|co|limited|ltd|llc|lp|plc|sa|ag|nv|holdings|group|trust"
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|source"
TRANSITION_WORDS = ("said", "told", "reported")


def squash(text: Column) -> Column:
    """Space-like characters to one space, invisible ones out, trimmed."""
    shown = F.regexp_replace(text, "[​‌‍⁠﻿­]", "")
    return F.trim(F.regexp_replace(shown, r"[\s  -  　]+", " "))


def fold(text: Column) -> Column:
    """Lower case, marks stripped, & to and, other than letters and digits to single spaces."""
    low = F.translate(F.lower(text), _ACCENTED, _PLAIN)
    return F.trim(F.regexp_replace(F.regexp_replace(F.replace(low, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "), " +", " "))


def slug(text: Column) -> Column:
    return F.replace(fold(text), F.lit(" "), F.lit("-"))


def company_core(name: Column) -> Column:
    """A folded company name without its legal endings."""
    return F.trim(F.regexp_replace(fold(name), rf"( ({COMPANY_SUFFIXES}))+$", ""))


def title_core(title: Column, places: Column) -> Column:
    """A title without up to three trailing segments (after ' - ', ',' or ' | ') that name a place."""
    out = title
    for _ in range(3):
        last = F.trim(F.regexp_extract(out, r"(?:\s-\s|,|\s\|\s)([^,|]+)$", 1))
        cut = F.trim(F.regexp_replace(out, r"(?:\s-\s|,|\s\|\s)([^,|]+)$", ""))
        out = F.when((last != "") & F.array_contains(places, F.lower(last)), cut).otherwise(out)
    return out


def ticker(symbol: Column) -> Column:
    return F.upper(F.regexp_replace(F.trim(symbol), r"[./ ]", "-"))


def canonical_url(url: Column) -> Column:
    """Fragment and tracking parameters dropped, scheme, www. and m. dropped, host lower, no trailing slash."""
    bare = F.regexp_replace(url, "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[a-zA-Z]+://([^/?]*)", 1)), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[a-zA-Z]+://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"^({TRACKING})=")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def html_text(html: Column) -> Column:
    """Scripts, styles, comments and tags out, the common entities decoded, space squashed."""
    t = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def visible_text(html: Column) -> Column:
    """``html_text`` with every entity decoded, named and numeric, and all space-like characters squashed."""
    t = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?s)<!--.*?-->", " "), r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(entities_decoded(t), r"[\s\u00a0]+", " "))


#: Named entities beside the five of XML: fixed names of the standard's Latin and punctuation sets.
_NAMED = [(f"&{n};", chr(c)) for n, c in sorted(name2codepoint.items()) if n not in ("amp", "nbsp")]


def entities_decoded(text: Column) -> Column:
    """Numeric entities, decimal and hexadecimal, then named ones; the ampersand last, so nothing is decoded twice."""

    def char(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def valid(code: Column) -> Column:
        return (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)

    whole = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};)"), 1))
    code = lambda e: F.when(F.lower(e).startswith("&#x"), F.conv(F.regexp_extract(e, "[xX]([0-9a-fA-F]+)", 1), 16, 10)).otherwise(F.regexp_extract(e, "([0-9]+)", 1)).cast("long")
    t = F.aggregate(whole, text, lambda t, e: F.when(valid(code(e)), F.replace(t, e, char(code(e)))).otherwise(t))
    # Only entities that stand in the text are looked up.
    named = F.array_distinct(F.regexp_extract_all(t, F.lit("(&[A-Za-z0-9]{2,8};)"), 1))
    table = F.create_map(*[F.lit(x) for pair in _NAMED for x in pair])
    t = F.aggregate(named, t, lambda t, e: F.replace(t, e, F.coalesce(F.element_at(table, e), e)))
    return F.replace(F.replace(t, F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))


def links(html: Column) -> Column:
    """href of each anchor, in order, whatever its quotes and other attributes."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']?([^"'\s>]*)"""), 1)


def amount_billions(text: Column) -> Column:
    """The first money amount in billions: $, EUR or GBP figures with bn, b, million, m."""
    value = F.regexp_extract(text, r"(?i)(?:\$|€|£|eur |gbp )\s*([0-9]+(?:\.[0-9]+)?)\s*(?:billion|bn|b|million|mn|m)\b", 1)
    unit = F.lower(F.regexp_extract(text, r"(?i)(?:\$|€|£|eur |gbp )\s*[0-9]+(?:\.[0-9]+)?\s*(billion|bn|b|million|mn|m)\b", 1))
    return F.when(value != "", value.cast("double") / F.when(unit.startswith("b"), 1.0).otherwise(1000.0))


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def within_caps(text: Column, words: int = 25, chars: int = 200) -> Column:
    return (word_count(text) <= words) & (F.length(text) <= chars)


def chunks(text: Column, size: int = 8000, overlap: int = 400) -> Column:
    """array<struct<k, start, text>>: pieces of ``size`` characters that overlap.

    A piece ends at its last line feed if that lies past half of it, else at its
    full size; the next starts ``overlap`` before that end. The cuts depend on
    each other: they are folded over the most pieces there can be.
    """
    n = F.length(text)
    most = F.ceil(n / F.lit(size // 2 - overlap)).cast("int") + 1

    def step(acc: Column, _: Column) -> Column:
        start = acc["next"]
        piece = F.substring(text, start + 1, F.lit(size))
        whole = start + size >= n
        feed = F.length(piece) - F.coalesce(F.nullif(F.instr(F.reverse(piece), F.lit("\n")), F.lit(0)), F.lit(size + 1)) + 1
        length = F.when(whole, n - start).when(feed > size // 2, feed).otherwise(F.lit(size))
        done = acc["done"]
        added = F.struct(F.size(acc["out"]).alias("k"), start.alias("start"), F.substring(text, start + 1, length).alias("text"))
        return F.struct(
            F.when(done, start).otherwise(start + length - overlap).cast("int").alias("next"),
            (done | whole).alias("done"),
            F.when(done, acc["out"]).otherwise(F.concat(acc["out"], F.array(added))).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("next"), F.lit(False).alias("done"), F.array().cast("array<struct<k:int,start:int,text:string>>").alias("out"))
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), most), zero, step)["out"])


def occurrences(text: Column, excerpt: Column) -> Column:
    """How often the excerpt stands in the text, overlapping ones not counted twice."""
    return F.when(F.length(excerpt) > 0, (F.length(text) - F.length(F.replace(text, excerpt, F.lit("")))) / F.length(excerpt)).cast("int")


def unique_place(text: Column, excerpt: Column) -> Column:
    """The offset of the excerpt if it stands there once, else null."""
    at = F.instr(text, excerpt)
    again = F.locate(excerpt, text, at + 1) if isinstance(excerpt, str) else F.call_function("locate", excerpt, text, at + 1)
    return F.when((at > 0) & (again == 0), at - 1)
