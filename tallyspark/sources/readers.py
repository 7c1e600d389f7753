"""Readers: each gives a flat DataFrame with a stated schema; what can't be read becomes null or a rejected row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.text import visible_text

HOLDING_SCHEMA = (
    "nameOfIssuer string, titleOfClass string, cusip string, value string, "
    "shrsOrPrnAmt struct<sshPrnamt: string, sshPrnamtType: string>, putCall string"
)


def holdings_xml(spark: SparkSession, path: str) -> DataFrame:
    """A row for each infoTable: identifiers trimmed and upper, missing or odd numbers 0, type SH unless stated. Not aggregated."""
    raw = spark.read.format("xml").option("rowTag", "infoTable").option("ignoreNamespace", "true").schema(HOLDING_SCHEMA).load(path)
    number = lambda c: F.coalesce(F.expr(f"try_cast(replace({c}, ',', '') as double)"), F.lit(0.0))
    return raw.select(
        F.upper(F.trim("cusip")).alias("cusip"),
        F.trim("nameOfIssuer").alias("issuer"),
        F.trim("titleOfClass").alias("class"),
        F.coalesce(F.upper(F.trim("putCall")), F.lit("")).alias("put_call"),
        F.coalesce(F.upper(F.trim("shrsOrPrnAmt.sshPrnamtType")), F.lit("SH")).alias("type"),
        number("value").alias("value"),
        number("shrsOrPrnAmt.sshPrnamt").alias("shares"),
    )


def reference_rates(spark: SparkSession, path: str) -> DataFrame:
    """(day, currency, rate) from a file with exactly one dated block; more blocks, a repeated currency or an odd rate is an error."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(
        F.regexp_extract_all("value", F.lit(r"""<Cube\s+time=['"]([0-9-]+)['"]"""), 1).alias("days"),
        F.regexp_extract_all("value", F.lit(r"""currency=['"]([A-Z]{3})['"]"""), 1).alias("c"),
        F.regexp_extract_all("value", F.lit(r"""rate=['"]([^'"]*)['"]"""), 1).alias("r"),
    )
    sound = (F.size("days") == 1) & (F.size("c") == F.size("r")) & (F.size(F.array_distinct("c")) == F.size("c")) & ~F.exists("r", lambda x: ~x.rlike(r"^[0-9]+(\.[0-9]+)?$"))
    checked = rows.withColumn("days", F.when(sound, F.col("days")).otherwise(F.raise_error(F.lit("not one dated block of decimal rates"))))
    pairs = checked.select(F.to_date(F.get("days", F.lit(0))).alias("day"), F.explode(F.arrays_zip("c", "r")).alias("x"))
    return pairs.select("day", F.col("x.c").alias("currency"), F.col("x.r").cast("double").alias("rate"))


def tolerant_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON documents; an unreadable one gives a row of nulls with its text in ``_corrupt``."""
    return spark.read.schema(f"{schema}, _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def zipped_columns(rows: DataFrame, keep: list[str], arrays: list[str]) -> DataFrame:
    """A struct of parallel arrays as rows: row i has each array's i-th element, null where one is short."""
    return rows.select(*keep, F.explode(F.arrays_zip(*arrays)).alias("__x")).select(*keep, *[F.col(f"__x.{a}").alias(a) for a in arrays])


def observations(facts: DataFrame, tag: str, unit: str = "USD", taxonomies: tuple[str, ...] = ("us-gaap", "ifrs-full", "dei")) -> DataFrame:
    """Rows of one tag from facts map<taxonomy, map<tag, map<unit, array<struct>>>>: the first taxonomy that has it, numbers only."""
    tried = F.coalesce(*[F.col("facts")[t][tag][unit] for t in taxonomies])
    rows = facts.select("cik", F.explode(tried).alias("x")).select("cik", F.lit(tag).alias("tag"), "x.*")
    return rows.filter(F.col("val").isNotNull())


def decoded_holders(docs: DataFrame) -> DataFrame:
    """Rows (ticker, quarter, manager_id, value, action, shares) from dictionary-coded lists.

    docs: ticker, managers array<array<string>>, quarters map<string, array<array<string>>>;
    a row is [manager index, value, action, shares?] and the fourth may be missing.
    """
    rows = docs.select("ticker", "managers", F.explode("quarters").alias("quarter", "list")).select("ticker", "managers", "quarter", F.explode("list").alias("r"))
    return rows.select(
        "ticker",
        "quarter",
        F.get(F.get("managers", F.get("r", F.lit(0)).cast("int")), F.lit(0)).alias("manager_id"),
        F.expr("try_cast(get(r, 1) as double)").alias("value"),
        F.get("r", F.lit(2)).alias("action"),
        F.expr("try_cast(get(r, 3) as double)").alias("shares"),
    )


def dated_csv(spark: SparkSession, path: str, date_pattern: str, value_pattern: str) -> DataFrame:
    """(d, v) from the columns whose headers match the patterns; m/d/yyyy or ISO days, what isn't finite to null."""
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    import re

    date = next(c for c in raw.columns if re.search(date_pattern, c, re.I))
    value = next(c for c in raw.columns if re.search(value_pattern, c, re.I))
    d, v = F.col(f"`{date}`"), F.col(f"`{value}`").try_cast("double")
    return raw.select(F.coalesce(F.try_to_date(d, "M/d/yyyy"), F.try_to_date(d, "yyyy-MM-dd")).alias("d"), F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v).alias("v"))


_INDEX_LINE = r"^(\S+)\s+(.*?)\s+(\d{1,10})\s+(\d{4}-?\d{2}-?\d{2})\s+(edgar/data/\S+)\s*$"


def form_index(lines: DataFrame, forms: list[str]) -> DataFrame:
    """Fixed-width index lines (column value), read from the right: form, name, cik, day, file, accession; others are left out.

    A form may hold one space; the wanted forms are looked for before anything is parsed.
    """
    wanted = lines.filter(" or ".join(f"startswith(value, '{f} ')" for f in forms))
    form = F.coalesce(*[F.when(F.col("value").startswith(f + " "), F.lit(f)) for f in sorted(forms, key=len, reverse=True)])
    part = lambda k: F.regexp_extract("value", _INDEX_LINE, k)
    rows = wanted.select(
        form.alias("form"),
        F.trim(F.regexp_extract(F.expr("value"), r"^\S+(?: \S+)?\s{2,}(.*?)\s{2,}\d", 1)).alias("name"),
        part(3).try_cast("long").alias("cik"),
        F.try_to_date(F.replace(part(4), F.lit("-"), F.lit("")), "yyyyMMdd").alias("day"),
        part(5).alias("file"),
    )
    accession = F.regexp_extract("file", r"(\d{10}-\d{2}-\d{6})", 1)
    return rows.withColumn("accession", accession).filter("accession <> '' and day is not null")


def newest_symbols(files: DataFrame) -> DataFrame:
    """(cusip, symbol) from pipe-delimited lines (file, value): the newest file wins, padding and misshapen rows out."""
    cells = files.select("file", F.split("value", r"\|").alias("c")).select("file", F.upper(F.trim(F.get("c", F.lit(1)))).alias("cusip"), F.upper(F.trim(F.get("c", F.lit(2)))).alias("symbol"))
    sound = cells.filter(F.col("cusip").rlike("^[0-9A-Z]{9}$") & F.col("symbol").rlike("^[A-Z][A-Z0-9.-]{0,9}$"))
    return sound.groupBy("cusip").agg(F.max_by("symbol", F.struct("file", "symbol")).alias("symbol"))


def rss(feeds: DataFrame) -> DataFrame:
    """(source, title, link, published) for each item of feeds (source, value); CDATA taken off, entities decoded twice, odd dates null."""
    items = feeds.select("source", F.explode(F.regexp_extract_all("value", F.lit(r"(?s)<item\b[^>]*>(.*?)</item>"), 1)).alias("item"))

    def tag(name: str) -> Column:
        t = F.regexp_extract("item", rf"(?s)<{name}\b[^>]*>(.*?)</{name}>", 1)
        t = F.regexp_replace(t, r"(?s)^\s*<!\[CDATA\[(.*?)\]\]>\s*$", "$1")
        for _ in range(2):
            for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
                t = F.replace(t, F.lit(entity), F.lit(char))
        return F.trim(t)

    day = F.regexp_extract(tag("pubDate"), r"(\d{1,2} \w{3} \d{4} \d{2}:\d{2}:\d{2})", 1)
    return items.select("source", tag("title").alias("title"), tag("link").alias("link"), F.try_to_timestamp(day, F.lit("d MMM yyyy HH:mm:ss")).alias("published"))


def ics(calendars: DataFrame) -> DataFrame:
    """(summary, day, time) of each event: folded lines joined, dates with or without a time."""
    whole = F.regexp_replace(F.replace("value", F.lit("\r\n"), F.lit("\n")), r"\n[ \t]", "")
    events = calendars.select(F.explode(F.regexp_extract_all(whole, F.lit(r"(?s)BEGIN:VEVENT\n(.*?)END:VEVENT"), 1)).alias("e"))
    start = F.regexp_extract("e", r"(?m)^DTSTART[^:\n]*:(\d{8})(?:T(\d{6}))?", 1)
    time = F.regexp_extract("e", r"(?m)^DTSTART[^:\n]*:(\d{8})(?:T(\d{6}))?", 2)
    summary = F.regexp_replace(F.trim(F.regexp_extract("e", r"(?m)^SUMMARY[^:\n]*:(.*)$", 1)), r"\\([,;])", "$1")
    return events.select(summary.alias("summary"), F.try_to_date(start, "yyyyMMdd").alias("day"), F.nullif(F.concat_ws(":", F.nullif(F.substring(time, 1, 2), F.lit("")), F.nullif(F.substring(time, 3, 2), F.lit(""))), F.lit("")).alias("time")).filter("day is not null")


def anchors(pages: DataFrame, key: str, html: str, least: int = 6, most: int = 140) -> DataFrame:
    """(key, title, url): anchors with titles of 6 to 140 characters, the first link of each title."""
    found = F.arrays_zip(F.regexp_extract_all(html, F.lit(r'(?s)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>'), 1).alias("u"), F.regexp_extract_all(html, F.lit(r'(?s)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>'), 2).alias("t"))
    rows = pages.select(key, F.posexplode(found).alias("__k", "x")).select(key, "__k", F.trim(F.regexp_replace("x.t", "<[^>]*>", "")).alias("title"), F.col("x.u").alias("url"))
    fit = rows.filter(F.length("title").between(least, most))
    return fit.groupBy(key, "title").agg(F.min_by("url", "__k").alias("url"))


MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def dated_entries(pages: DataFrame, key: str, text: str, around: int = 80) -> DataFrame:
    """(key, raw, day, context): every d Month yyyy and Month d, yyyy of a text, odd dates left out.

    The context is up to ``around`` characters on both sides, no further than the next date.
    """
    date = rf"(?:\d{{1,2}} (?:{MONTHS}) \d{{4}})|(?:(?:{MONTHS}) \d{{1,2}}, \d{{4}})"
    rows = pages.select(key, F.split(text, date).alias("__parts"), F.posexplode(F.regexp_extract_all(text, F.lit(f"({date})"), 1)).alias("__k", "raw"))
    before, after = F.get("__parts", F.col("__k")), F.get("__parts", F.col("__k") + 1)
    context = F.concat(F.substring(before, F.greatest(F.length(before) - around + 1, F.lit(1)), F.lit(around)), F.col("raw"), F.substring(after, 1, around))
    day = F.coalesce(F.try_to_date("raw", "d MMMM yyyy"), F.try_to_date("raw", "MMMM d, yyyy"))
    return rows.select(key, "raw", day.alias("day"), context.alias("context")).filter("day is not null")


def _pieces(html: Column, opening: str) -> Column:
    """What follows each opening tag of these names, up to the next one or the end; the tag's name and attributes are left in."""
    return F.slice(F.split(html, rf"(?i)<(?={opening})"), F.lit(2), F.lit(1 << 30))


def _attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, rf"""(?i)^[^>]*?\b{name}\s*=\s*["']?([^"'\s>]*)""", 1)


def _content(tag: Column) -> Column:
    return F.regexp_replace(tag, "^[^>]*>", "")


def filing_documents(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, seq, description, filename, href, inline, type, size): rows of an index page's file tables.

    Cells are taken by their headings, fixed values of these pages; rows with
    fewer cells than five, headings among them, are none. A link without a name
    is called by the last part of its path; a size of nothing is null.
    """
    tables = pages.select(key, F.posexplode(_pieces(F.col(html), r"table\b")).alias("t", "tag")).filter(_attribute(F.col("tag"), "class") == "tableFile")
    body = F.element_at(F.split("tag", "(?i)</table"), 1)
    rows = tables.select(key, F.explode(_pieces(body, r"tr\b")).alias("row")).select(key, _pieces(F.col("row"), r"td\b").alias("tags")).filter("size(tags) >= 5")
    said = F.transform("tags", lambda t: visible_text(_content(t)))
    rows = rows.withColumn("cell", F.map_from_arrays(F.array(*[F.lit(h) for h in ("Seq", "Description", "Document", "Type", "Size")]), F.slice(said, 1, 5)))
    link = F.element_at(F.concat(_pieces(F.get("tags", F.lit(2)), r"a\b"), F.array(F.lit(""))), 1)
    rows = rows.withColumn("href", F.nullif(_attribute(link, "href"), F.lit(""))).withColumn("named", visible_text(F.concat(F.lit("<"), link)))
    cell = lambda heading: F.col("cell")[heading]
    path = F.coalesce("href", F.lit(""))
    return rows.select(
        key,
        cell("Seq").alias("seq"),
        cell("Description").alias("description"),
        F.when(F.col("named") != "", F.col("named")).otherwise(F.element_at(F.split(path, "/"), -1)).alias("filename"),
        "href",
        F.contains(F.lower(path), F.lit("ix?doc=")).alias("inline"),
        cell("Type").alias("type"),
        F.nullif(F.array_join(F.regexp_extract_all(cell("Size"), F.lit("([0-9]+)"), 1), "").try_cast("long"), F.lit(0)).alias("size"),
    )


#: What index pages say of a party in brackets; fixed values.
PARTY_ROLES = {"subject": "subject", "filed by": "filer", "filer": "filer"}


def filing_parties(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, name, role, cik) of an index page's company spans.

    The first bracket that states a role ends the name; without one the role is
    "other". The number is the span's first of just ten digits.
    """
    spans = pages.select(key, F.explode(_pieces(F.col(html), r"span\b")).alias("tag")).filter(_attribute(F.col("tag"), "class") == "companyName")
    inner = _content(F.element_at(F.split("tag", "(?i)</span"), 1))
    rows = spans.select(key, visible_text(inner).alias("said"), F.regexp_extract("tag", r"(?<![0-9])([0-9]{10})(?![0-9])", 1).alias("digits"))
    roles = F.create_map(*[F.lit(x) for pair in PARTY_ROLES.items() for x in pair])
    brackets = F.filter(F.regexp_extract_all("said", F.lit(r"\(([^()]*)\)"), 1), lambda b: F.map_contains_key(roles, F.lower(b)))
    rows = rows.withColumn("stated", F.get(brackets, F.lit(0)))
    name = F.when(F.col("stated").isNull(), F.col("said")).otherwise(F.expr("substring_index(said, concat('(', stated, ')'), 1)"))
    role = F.coalesce(F.element_at(roles, F.lower("stated")), F.lit("other"))
    return rows.select(key, F.trim(name).alias("name"), role.alias("role"), F.nullif("digits", F.lit("")).alias("cik"))


def filing_facts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, period, filed, accepted) from an index page's headed cells; what isn't there is null."""
    tags = F.transform(_pieces(F.col(html), r"div\b"), lambda t: F.struct(_attribute(t, "class").alias("kind"), visible_text(_content(F.element_at(F.split(t, "(?i)</div"), 1))).alias("said")))
    each = pages.select(key, tags.alias("tags"))
    headed = F.zip_with("tags", F.slice("tags", F.lit(2), F.greatest(F.size("tags"), F.lit(1))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    pairs = F.filter(headed, lambda p: (p["a"]["kind"] == "infoHead") & (p["b"]["kind"] == "info"))
    each = each.withColumn("pairs", pairs)
    value = lambda heading: F.nullif(F.get(F.filter("pairs", lambda p: F.lower(p["a"]["said"]) == heading), F.lit(0))["b"]["said"], F.lit(""))
    return each.select(key, value("period of report").alias("period"), value("filing date").alias("filed"), value("accepted").alias("accepted"))


SERIES_SCHEMA = "status string, message array<string>, Results struct<series: array<struct<seriesID: string, data: array<struct<year: string, period: string, value: string>>>>>"


def year_windows(first: int, last: int, years: int = 10) -> list[tuple[int, int]]:
    """Windows of at most ten years from ``first`` to ``last``, as one request each may ask for."""
    return [(a, min(a + years - 1, last)) for a in range(first, last + 1, years)]


def monthly_series(answers: DataFrame) -> DataFrame:
    """(series, d, v) of JSON answers (column value): months only, no annual averages, gaps that aren't numbers out; a refused answer is an error."""
    read = answers.select(F.from_json("value", SERIES_SCHEMA).alias("a"))
    refused = F.raise_error(F.concat(F.lit("series refused: "), F.coalesce(F.array_join("a.message", "; "), F.lit("unreadable"))))
    series = read.select(F.explode(F.when(F.col("a.status") == "REQUEST_SUCCEEDED", F.col("a.Results.series")).otherwise(refused)).alias("s"))
    points = series.select(F.col("s.seriesID").alias("series"), F.explode("s.data").alias("p"))
    v = F.col("p.value").try_cast("double")
    months = points.filter(F.col("p.period").rlike("^M(0[1-9]|1[0-2])$") & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return months.select("series", F.to_date(F.concat("p.year", F.lit("-"), F.substring("p.period", 2, 2), F.lit("-01"))).alias("d"), v.alias("v"))


def sitemap_paths(maps: DataFrame, prefixes: list[str]) -> DataFrame:
    """Distinct paths of <loc> entries under the prefixes."""
    loc = maps.select(F.explode(F.regexp_extract_all("value", F.lit(r"<loc>\s*https?://[^/<]+([^<\s]*)\s*</loc>"), 1)).alias("path"))
    allowed = None
    for p in prefixes:
        hit = F.col("path").startswith(p)
        allowed = hit if allowed is None else allowed | hit
    return loc.filter(allowed).distinct()
