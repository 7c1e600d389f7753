"""Queries of decisions, rule tables and name functions over orders, events, pages and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions import arrays, dates, identifiers, tables, text
from tallyspark.operators import decisions as d
from tallyspark.operators import deals, facts, market, state
from tallyspark.plans.holdings import table
from tallyspark.plans.records import event_days, orders

TODAY = "1999-06-01"


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as moves: a price's digits make the change, line items the stated ratios, share counts and reports."""
    o = orders(spark, sf_dir)
    change = F.element_at(F.array(*[F.lit(x) for x in (0.5, 0.3333, 0.26, 0.7, 2.0)]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    moves = o.select(F.col("o_orderkey").alias("symbol"), "day", change.alias("change")).withColumn("shape", market.split_shape(F.col("change")))
    i = table(spark, sf_dir, "lineitem")
    told = i.filter("l_linenumber <= 2").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "day"), "l_orderkey")
    ratio = F.when(F.col("l_linenumber") == 1, F.lit(2.0)).otherwise(3.0)
    stated = told.select(F.col("l_orderkey").alias("symbol"), F.date_sub("day", F.col("l_quantity").cast("int") * 3).alias("filed"), ratio.alias("ratio"))
    counts = o.filter("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("symbol"), "day", (F.lit(1.0) + (F.col("o_orderkey") % 4) * 0.4).alias("growth"))
    reports = i.filter("l_linenumber = 3").select(F.col("l_orderkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("filed"), F.when(F.col("l_returnflag") == "R", "exchange").otherwise("distribution").alias("kind"))
    return d.classify_moves(moves, stated, counts, reports)


def reused(spark, sf_dir):
    o = orders(spark, sf_dir)
    moves = o.select(F.col("o_custkey").alias("symbol"), "day", (F.col("price") / 1000).alias("change"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(2.0)).alias("shape"))
    moves = moves.groupBy("symbol", "day").agg(F.max("change").alias("change"), F.max("shape").alias("shape"))
    n = F.col("symbol") % 4
    stored = moves.select("symbol", "day", F.when(n == 1, F.col("change") + 1e-6).otherwise(F.col("change")).alias("change"), "shape", F.when(n != 2, "split").alias("class"), (n == 2).alias("stale"))
    return d.reuse_results(moves, stored)


def subjects(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_returnflag") == "A", "firm").when(F.col("l_returnflag") == "N", "vehicle").otherwise("person")
    filers = i.select(F.col("l_orderkey").alias("filing"), F.col("l_suppkey").alias("filer"), F.col("l_linenumber").alias("listed"), kind.alias("kind"), (F.col("l_quantity") == 50).alias("named"))
    return d.choose_subject(filers, table(spark, sf_dir, "supplier").filter("s_acctbal > 3000").select(F.col("s_suppkey").alias("filer")))


def name_ids(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_brand", "p_size")
    rows = p.select(F.col("p_brand").alias("name"))
    explicit = p.filter("p_size = 50").select(F.col("p_brand").alias("name"), F.col("p_partkey").cast("long").alias("id"))
    candidates = p.filter("p_size < 5").select(F.col("p_brand").alias("name"), F.col("p_partkey").cast("long").alias("id"), F.when(F.col("p_size") == 1, F.col("p_brand")).otherwise(F.col("p_name")).alias("plain"))
    return d.resolve_names(rows, explicit, candidates)


def orphans(spark, sf_dir):
    o = orders(spark, sf_dir)
    rows = o.select(F.col("o_orderkey").alias("accession"), F.col("o_custkey").alias("subject"))
    listed = table(spark, sf_dir, "lineitem").filter("l_linenumber = 1").groupBy(F.col("l_suppkey").alias("subject")).agg(F.collect_set("l_orderkey").alias("accessions"))
    return d.adopt_orphans(rows, listed)


def gaps(spark, sf_dir):
    e = event_days(spark, sf_dir)
    newest = lambda df: df.groupBy("user_id", "event_type").agg(F.max("day").alias("day"))
    key = F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("key")
    return d.fill_gaps(newest(e.filter("d >= 15")).select(key, "day"), newest(e.filter("d < 15")).select(key, "day"), "key")


def rereads(spark, sf_dir):
    o = orders(spark, sf_dir).withColumn("reader_version", F.when(F.col("o_orderkey") % 6 > 0, (F.col("o_orderkey") % 6).cast("int")))
    return d.to_reread(o, 4, [F.desc("day"), F.col("o_orderkey")], 100).select("o_orderkey", "day", "reader_version")


def carried(spark, sf_dir):
    o = orders(spark, sf_dir)
    version = lambda n, shift: ((F.col("o_orderkey") + shift) % n).cast("int")
    before = o.select("o_orderkey", F.when(F.col("status") == "F", "failed").otherwise("ok").alias("status"), version(7, 0).alias("parser"), version(5, 0).alias("schema"), F.lit(1).alias("config"))
    now = o.select("o_orderkey", F.when(F.col("o_orderkey") % 9 == 0, 99).otherwise(version(7, 0)).alias("parser"), version(5, 5).alias("schema"), F.when(F.col("price") > 200000, 2).otherwise(1).alias("config"))
    return d.carry_by_versions(before, now, "o_orderkey", ["parser", "schema", "config"])


def lookback(spark, sf_dir):
    o = orders(spark, sf_dir)
    days = o.groupBy("day").agg(F.count_if(F.col("status") == "F").cast("int").alias("attempts"), F.bool_or(F.col("priority") == "1-URGENT").alias("read"))
    return d.prune_lookback(days, o.select("day"))


def unknowns(spark, sf_dir):
    e = event_days(spark, sf_dir).filter("event_type is not null")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return d.with_unknowns(c.unionByName(e.select("user_id")), e, e.filter("event_type = 'error'").select((F.col("user_id") + 3).alias("user_id")), "user_id")


def complete(spark, sf_dir):
    e = event_days(spark, sf_dir)
    kind = F.when(F.col("event_type") == "signup", "open").when(F.col("event_type") == "view", "close").when(F.col("event_type") == "purchase", "end").otherwise("other")
    return d.complete_days(e.select("d", kind.alias("kind"), F.when(F.col("event_type") == "error", F.floor(F.col("value") / 100)).alias("carry")), "d", "kind", "carry")


def tiers(spark, sf_dir):
    o = orders(spark, sf_dir).withColumn("tier", F.substring("priority", 1, 1).cast("int"))
    return d.recent_then_tiers(o, "day", "tier", F.lit(TODAY).cast("date"), 60, "o_orderkey").select("o_orderkey", F.col("place").cast("long").alias("place"))


def cover_shares(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem")
    return d.share_sums(i.select(F.col("l_suppkey").alias("company"), F.col("l_shipdate").cast("date").alias("as_of"), F.col("l_orderkey").alias("accession"), F.col("l_quantity").cast("long").alias("shares")))


def advisers(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem")
    return d.adviser_mentions(i.select((F.col("l_orderkey") % 500).alias("document"), (F.col("l_suppkey") % 5).alias("adviser"), ((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40)).alias("author")))


def phrases(spark, sf_dir):
    """Runs of a benchmark item's text, looked for in all documents."""
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("phrase_id"), F.array_join(F.slice(F.split("text", " "), 3, 12), " ").alias("phrase"))
    return d.phrase_sources(b, table(spark, sf_dir, "documents"))


def ring(spark, sf_dir):
    e = event_days(spark, sf_dir)
    old = e.filter("d < 20").groupBy("day").agg(F.count("*").alias("n"))
    new = e.filter("d >= 19").groupBy("day").agg((F.count("*") + 1000).alias("n"))
    return state.history_ring(old, new, 25)


def fx(spark, sf_dir):
    o = orders(spark, sf_dir)
    r = o.groupBy("day").agg(F.max(F.when(F.col("status") == "F", F.col("price"))).alias("a"), F.max(F.when(F.col("status") == "O", F.col("price"))).alias("b"))
    r = r.filter("a is not null and b is not null")
    rates = r.select("day", F.explode(F.array(F.struct(F.lit("USD").alias("currency"), (F.col("a") / 100000).alias("rate")), F.struct(F.lit("GBP").alias("currency"), (F.col("b") / 100000).alias("rate"))))).select("day", "col.*")
    return deals.fx_rates(rates)


def fx_guard(spark, sf_dir):
    o = orders(spark, sf_dir)
    new = F.col("price") * (1 + (F.col("o_orderkey") % 5) * 0.1)
    moved = F.date_add("day", (F.col("o_orderkey") % 7).cast("int") - 3)
    return o.select("o_orderkey", deals.fx_problem(F.col("price"), new, F.col("day"), moved, F.lit("1999-01-01").cast("date")).alias("problem"))


def _titles(spark, sf_dir):
    """Titles of postings made from the orders' own values."""
    o = orders(spark, sf_dir)
    seat = F.element_at(F.array(*[F.lit(x) for x in TITLES]), (F.col("o_orderkey") % len(TITLES) + 1).cast("int"))
    return o.select("o_orderkey", seat.alias("title"), (F.col("o_custkey") % 2 == 0).alias("campus"), F.element_at(F.array(F.lit("trading"), F.lit("quant"), F.lit("bank")), (F.col("o_custkey") % 3 + 1).cast("int")).alias("tier"))


#: Titles with the vertical, level and refusal expected of each (campus, at a bank): a table of expected results.
EXPECTED = [
    ("Graduate Consulting Analyst", "Consulting", "graduate", None),
    ("Quantitative Trader", "Quant", None, None),
    ("Managing Director, Private Equity", "Private Equity", "senior", "senior"),
    ("Vice President - Risk", "Risk", "manager", "manager"),
    ("Senior Software Engineer", "Software", "experienced", None),
    ("Summer Internship, Investment Banking", "Investment Banking", "internship", None),
    ("Junior Trader", "Sales & Trading", "junior", "junior"),
    ("Talent Community - Sales & Trading", "Sales & Trading", None, "not a seat"),
    ("Spring Insight Programme, Markets", "Sales & Trading", "insight", None),
    ("Women in Finance webinar", "Finance & Accounting", None, "not a seat"),
    ("Analyst Programme open day", "Other", "junior", "not a seat"),
    ("Payments Operations Associate", "Corporate Banking", "junior", None),
    ("Equity Research Analyst", "Equity Research", "junior", None),
    ("Machine Learning Research Intern", "AI Research", "internship", None),
    ("Event Manager", "Other", "experienced", None),
]
TITLES = [x[0] for x in EXPECTED]


def verticals(spark, sf_dir):
    t = F.col("title")
    return _titles(spark, sf_dir).filter("true").select("o_orderkey", tables.vertical(t).alias("vertical"), tables.level(t).alias("level"))


def admissions(spark, sf_dir):
    return _titles(spark, sf_dir).select("o_orderkey", tables.admitted(F.col("title"), F.lit(True), F.lit("bank")).alias("refused"))


FORMS = [("10-K", "report", "high"), ("8-K/A", "report", "medium"), ("DEFM14A", "solicitation", "high"), ("PRE 14A", "other", "low"), ("SC 13E3", "schedule", "high"), ("SC 13D/A", "schedule", "medium"), ("SC TO-T", "schedule", "high"), ("424B3", "other", "low")]


def forms(spark, sf_dir):
    f = orders(spark, sf_dir).select("o_orderkey", F.element_at(F.array(*[F.lit(x[0]) for x in FORMS]), (F.col("o_orderkey") % len(FORMS) + 1).cast("int")).alias("form"))
    return f.select("o_orderkey", "form", tables.by_form(F.col("form")).alias("x")).select("o_orderkey", "form", "x.kind", "x.confidence")


BUYER_NAMES = [("Orion Acquisition Corp", "vehicle"), ("Northern Capital Partners", "sponsor"), ("Acme Tools Inc", "strategic"), ("Mary J. Stone", "person"), ("Bright Growth Fund", "sponsor"), ("Blue plc", "strategic"), ("shareholders", None)]


def buyers(spark, sf_dir):
    n = orders(spark, sf_dir).select("o_orderkey", F.element_at(F.array(*[F.lit(x[0]) for x in BUYER_NAMES]), (F.col("o_orderkey") % len(BUYER_NAMES) + 1).cast("int")).alias("name"))
    kind = None
    for pattern, label in tables.BUYERS:
        hit = F.col("name").rlike(pattern if label == "person" else f"(?i){pattern}")
        kind = F.when(hit, label) if kind is None else kind.when(hit, label)
    return n.select("o_orderkey", kind.alias("kind"))


def locations(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    city = F.when(F.col("c_custkey") % 3 == 0, " ldn ").when(F.col("c_custkey") % 3 == 1, F.col("n_name"))
    return j.select("c_custkey", tables.location(city, F.when(F.col("c_custkey") % 2 == 0, "North"), F.col("n_name")).alias("place"))


def pretty(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lower("p_type"), F.lit(" OF THE "), F.upper("p_name"), F.lit(" PLC"))
    return p.select("p_partkey", tables.pretty_name(raw).alias("name"))


def companies(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    other = F.when(k == 0, F.concat(F.upper("p_name"), F.lit(" Inc."))).when(k == 1, F.concat("p_name", F.lit("s, Ltd"))).when(k == 2, F.concat("p_name", F.lit(" works"))).otherwise(F.initcap("p_name"))
    return p.select("p_partkey", tables.same_company(F.col("p_name"), other).alias("same"), tables.same_registrant(F.col("p_name"), other).alias("registrant"))


def lookalikes(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", (tables.latin_lookalikes(F.translate("p_name", "aeopcx", "аеорсх")) == F.col("p_name")).alias("same"))


def visible(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.visible_text(F.col("html")).alias("body"))


def symbols(spark, sf_dir):
    """Publishable symbols: one to five letters with an optional class, no test symbol."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.upper(F.concat(F.regexp_replace("p_name", "[^a-z]", ""), F.when(F.col("p_size") % 3 == 0, F.lit(".b")).otherwise(F.lit("")))).alias("s"))
    s = F.when(F.col("p_partkey") % 5 == 0, F.substring("s", 1, 4)).when(F.col("p_partkey") % 5 == 1, F.lit("ZVZZT")).otherwise(F.col("s"))
    return p.select("p_partkey", s.alias("symbol")).filter(identifiers.publishable(F.col("symbol")))


def roundings(spark, sf_dir):
    """Half up, half even and six places of the same number."""
    o = orders(spark, sf_dir)
    v = F.floor(F.col("price")).cast("decimal(18,4)") / 8
    return o.select("o_orderkey", arrays.rounded(v).alias("up"), arrays.rounded(v, half_even=True).alias("even"), F.round(F.col("price") / 7, 6).alias("six"))


def capped(spark, sf_dir):
    """The first five distinct parts of a supplier and how many were left out."""
    i = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("parts"))
    i = i.withColumn("x", arrays.capped(F.col("parts"), 5))
    return i.select("l_suppkey", F.array_join(F.transform("x.kept", lambda x: x.cast("string")), ",").alias("kept"), "x.left_out")


def periods(spark, sf_dir):
    """FYyyyy for a year's end, yyyyH1 for a half's end, else FYyyyy with the half running."""
    o = orders(spark, sf_dir)
    return o.select("o_orderkey", dates.reporting_period(F.col("day")).alias("period"))


def fiscal_years(spark, sf_dir):
    """A period end's fiscal year from the first filing within 150 days after it, else its own year; January and February ends take the one before."""
    o = orders(spark, sf_dir)
    ends = o.select("o_custkey", F.last_day("day").alias("end")).distinct()
    filed = o.select("o_custkey", F.col("day").alias("filed"), F.year("day").alias("fy"))
    return facts.fiscal_years(ends, filed, "o_custkey")


def filing_ids(spark, sf_dir):
    """Accession, company and index address of a filing's address."""
    o = orders(spark, sf_dir)
    accession = F.concat_ws("-", F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.date_format("day", "yy"), F.lpad(F.col("o_orderkey").cast("string"), 6, "0"))
    url = F.concat(F.lit("https://www.example.org/Archives/data/"), F.col("o_custkey"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/doc.htm"))
    return o.select("o_orderkey", identifiers.accession(url).alias("accession"), identifiers.index_address(url).alias("index"))


QUERIES = {
    "decide_actions": classified, "decide_reuse": reused, "decide_subjects": subjects, "decide_name_ids": name_ids, "decide_orphans": orphans, "decide_gap_fill": gaps,
    "state_version_gate": rereads, "state_carry_versions": carried, "state_lookback": lookback, "state_late_data": unknowns, "filter_complete_days": complete, "rank_recent_tiers": tiers,
    "agg_cover_shares": cover_shares, "agg_advisers": advisers, "agg_phrase_sources": phrases, "state_history_ring": ring, "deals_fx_rates": fx, "deals_fx_problems": fx_guard,
    "rules_verticals": verticals, "rules_admission": admissions, "rules_forms": forms, "rules_buyers": buyers, "text_locations": locations, "text_pretty_names": pretty,
    "text_same_company": companies, "text_lookalikes": lookalikes, "text_visible": visible, "filter_symbols": symbols, "math_roundings": roundings, "arrays_capped": capped,
    "dates_periods": periods, "dates_fiscal_years": fiscal_years, "ids_filings": filing_ids,
}

_E = "e AS (SELECT *, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS d, CAST(ts AS DATE) AS day FROM events)"
_O = "o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price, o_orderpriority AS priority, o_orderstatus AS status FROM orders)"


def _pick(column: str, values: list, n: int) -> str:
    """An expected value by a key's remainder."""
    cases = " ".join(f"WHEN {k} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for k, v in enumerate(values))
    return f"CASE {column} % {n} {cases} END"


_TITLED = len(EXPECTED)

SQL = {
    "decide_actions": f"""WITH {_O}, m AS (SELECT o_orderkey AS symbol, day, [0.5::DOUBLE, 0.3333, 0.26, 0.7, 2.0][o_orderkey % 5 + 1] AS change, o_orderkey % 5 <> 3 AND o_orderkey % 5 <> 2 AS shaped FROM o),
      s AS (SELECT l_orderkey AS symbol, day - CAST(l_quantity AS INTEGER) * 3 AS filed, CASE l_linenumber WHEN 1 THEN 2.0::DOUBLE ELSE 3.0 END AS ratio FROM lineitem JOIN o ON o_orderkey = l_orderkey WHERE l_linenumber <= 2),
      b AS (SELECT m.symbol, filed, ratio FROM m JOIN s USING (symbol) WHERE filed <= day AND abs(change * ratio - 1) <= 0.15::DOUBLE QUALIFY row_number() OVER (PARTITION BY m.symbol ORDER BY filed, ratio) = 1),
      r AS (SELECT symbol, first(kind ORDER BY filed, kind) AS report FROM (SELECT l_orderkey AS symbol, CAST(l_shipdate AS DATE) AS filed, CASE l_returnflag WHEN 'R' THEN 'exchange' ELSE 'distribution' END AS kind FROM lineitem WHERE l_linenumber = 3)
        JOIN m USING (symbol) WHERE date_diff('day', day, filed) BETWEEN -45 AND 15 GROUP BY 1),
      j AS (SELECT m.*, b.ratio, b.filed, report, CASE WHEN symbol % 3 > 0 THEN 1 + (symbol % 4) * 0.4::DOUBLE END AS growth FROM m LEFT JOIN b USING (symbol) LEFT JOIN r USING (symbol)),
      k AS (SELECT *, ratio IS NOT NULL AND coalesce(abs(growth / ratio - 1) > 0.25::DOUBLE, false) AS bad, date_diff('day', filed, day) > 75 AS old, coalesce(abs(growth / ratio - 1) <= 0.1::DOUBLE, false) AS backed FROM j),
      x AS (SELECT *, ratio IS NOT NULL AND NOT bad AND (NOT old OR backed) AS split FROM k)
      SELECT symbol, day, CASE WHEN bad THEN 'unresolved' WHEN split THEN 'split' WHEN report IS NOT NULL THEN report WHEN shaped THEN 'unresolved' END AS class, CASE WHEN split THEN ratio END AS ratio,
        CASE WHEN bad THEN 'share counts contradict' WHEN split AND old THEN 'old mention, backed' WHEN split THEN 'stated' WHEN report IS NOT NULL THEN 'report' WHEN shaped THEN 'shaped like a split' END AS reason FROM x""",
    "decide_reuse": f"""WITH {_O}, m AS (SELECT o_custkey AS symbol, day, max(price / 1000) AS change, max(CASE WHEN o_orderkey % 2 = 0 THEN 2.0::DOUBLE END) AS shape FROM o GROUP BY ALL)
      SELECT *, CASE WHEN symbol % 4 IN (0, 3) THEN 'split' END AS class, symbol % 4 IN (0, 3) AS reused FROM m""",
    "decide_subjects": """WITH f AS (SELECT l_orderkey AS filing, l_suppkey AS filer, l_linenumber AS listed, l_quantity = 50 AS named, CASE WHEN l_quantity = 50 THEN 0 WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 ELSE 3 END AS rank FROM lineitem),
      n AS (SELECT *, row_number() OVER (PARTITION BY filing ORDER BY rank, listed, filer) AS n FROM f)
      SELECT filing, first(filer ORDER BY n) AS subject FROM n WHERE n <= 5 AND (named OR filer IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000)) GROUP BY 1""",
    "decide_name_ids": """WITH n AS (SELECT DISTINCT p_brand AS name FROM part), e AS (SELECT p_brand AS name, min(p_partkey) AS told FROM part WHERE p_size = 50 GROUP BY 1),
      c AS (SELECT p_brand AS name, count(DISTINCT p_partkey) AS n, min(p_partkey) AS sole, count(DISTINCT p_partkey) FILTER (p_size = 1) AS k, min(p_partkey) FILTER (p_size = 1) AS exact FROM part WHERE p_size < 5 GROUP BY 1)
      SELECT name, CASE WHEN told IS NOT NULL THEN told WHEN n = 1 THEN sole WHEN k = 1 THEN exact END AS id, CASE WHEN told IS NOT NULL THEN 'explicit' WHEN n = 1 THEN 'single' WHEN k = 1 THEN 'name' ELSE 'unresolved' END AS how
      FROM n LEFT JOIN e USING (name) LEFT JOIN c USING (name)""",
    "decide_orphans": """WITH l AS (SELECT l_orderkey AS accession, min(l_suppkey) AS s FROM lineitem WHERE l_linenumber = 1 GROUP BY 1)
      SELECT o_orderkey AS accession, coalesce(s, o_custkey) AS subject, s IS NOT NULL AND s <> o_custkey AS moved FROM orders LEFT JOIN l ON accession = o_orderkey""",
    "decide_gap_fill": f"""WITH {_E}, n AS (SELECT concat(user_id, '-', event_type) AS key, max(day) FILTER (d >= 15) AS now, max(day) FILTER (d < 15) AS before FROM e GROUP BY 1)
      SELECT key, coalesce(now, before) AS day, now IS NULL AS stand_in FROM n""",
    "state_version_gate": f"""WITH {_O}, v AS (SELECT *, CASE WHEN o_orderkey % 6 > 0 THEN CAST(o_orderkey % 6 AS INTEGER) END AS reader_version FROM o)
      SELECT o_orderkey, day, reader_version FROM v WHERE coalesce(reader_version, 0) < 4 ORDER BY day DESC, o_orderkey LIMIT 100""",
    "state_carry_versions": f"WITH {_O} SELECT o_orderkey, status <> 'F' AND o_orderkey % 9 <> 0 AND price <= 200000 AS carried FROM o",
    "state_lookback": f"""WITH {_O}, s AS (SELECT day, CAST(count(*) FILTER (status = 'F') AS INTEGER) AS attempts, bool_or(priority = '1-URGENT') AS read FROM o GROUP BY 1 ORDER BY day DESC LIMIT 262)
      SELECT *, NOT read AND attempts < 3 AS due FROM s""",
    "state_late_data": f"""WITH {_E}, k AS (SELECT c_custkey AS user_id FROM customer UNION SELECT user_id FROM e), n AS (SELECT user_id, count(*) AS n FROM e GROUP BY 1), f AS (SELECT DISTINCT user_id + 3 AS user_id FROM e WHERE event_type = 'error')
      SELECT user_id, CASE WHEN n IS NOT NULL THEN n WHEN f.user_id IS NULL THEN 0 END AS n, CASE WHEN n IS NOT NULL AND f.user_id IS NOT NULL THEN 'partial' WHEN n IS NOT NULL THEN 'seen' WHEN f.user_id IS NOT NULL THEN 'unknown' ELSE 'absent' END AS status
      FROM k LEFT JOIN n USING (user_id) LEFT JOIN f ON f.user_id = k.user_id""",
    "filter_complete_days": f"""WITH {_E} SELECT d, bool_or(event_type = 'signup') AND bool_or(event_type = 'view') AND bool_or(event_type = 'purchase') AND max(CASE WHEN event_type = 'error' THEN floor(value / 100) ELSE 0 END) = 0 AS complete FROM e GROUP BY 1""",
    "rank_recent_tiers": f"""WITH {_O}, t AS (SELECT *, CAST(substr(priority, 1, 1) AS INTEGER) AS tier, date_diff('day', day, DATE '{TODAY}') <= 60 AS new FROM o)
      SELECT o_orderkey, row_number() OVER (ORDER BY NOT new, CASE WHEN new THEN 0 ELSE tier END, day DESC, o_orderkey) AS place FROM t""",
    "agg_cover_shares": """WITH r AS (SELECT l_suppkey AS company, l_quantity, rank() OVER (PARTITION BY l_suppkey ORDER BY CAST(l_shipdate AS DATE) DESC, l_orderkey DESC) AS r FROM lineitem)
      SELECT company, CAST(sum(DISTINCT CAST(l_quantity AS BIGINT)) AS BIGINT) AS shares FROM r WHERE r = 1 GROUP BY 1""",
    "agg_advisers": """WITH g AS (SELECT l_orderkey % 500 AS document, l_suppkey % 5 AS adviser, bool_or(l_returnflag = 'R' AND l_quantity > 40) AS strong FROM lineitem GROUP BY ALL HAVING count(*) >= 2)
      SELECT document, adviser, strong FROM g QUALIFY strong OR NOT bool_or(strong) OVER (PARTITION BY document)""",
    "agg_phrase_sources": """WITH b AS (SELECT item_id AS phrase_id, array_to_string(list_slice(string_split(text, ' '), 3, 14), ' ') AS phrase FROM benchmark)
      SELECT phrase_id, (SELECT min(doc_id) FROM documents d WHERE contains(d.text, b.phrase)) AS doc_id FROM b""",
    "state_history_ring": f"""WITH {_E} SELECT day, CASE WHEN d >= 19 THEN count(*) + 1000 ELSE count(*) END AS n FROM e GROUP BY day, d ORDER BY day DESC LIMIT 25""",
    "deals_fx_rates": f"""WITH {_O}, r AS (SELECT day, max(price) FILTER (status = 'F') / 100000 AS a, max(price) FILTER (status = 'O') / 100000 AS b FROM o GROUP BY 1)
      SELECT day, 1.0::DOUBLE AS usd, round(1 / a, 6) AS eur, round(b / a, 6) AS gbp FROM r WHERE a IS NOT NULL AND b IS NOT NULL""",
    "deals_fx_problems": f"""WITH {_O}, x AS (SELECT o_orderkey, day, day + CAST(o_orderkey % 7 AS INTEGER) - 3 AS new_day, (o_orderkey % 5) * 0.1::DOUBLE AS move FROM o)
      SELECT o_orderkey, CASE WHEN new_day > DATE '1999-01-01' THEN 'future' WHEN new_day < day THEN 'older' WHEN move > {deals.MOST_FX_MOVE}::DOUBLE THEN 'move' END AS problem FROM x""",
    "rules_verticals": f"SELECT o_orderkey, {_pick('o_orderkey', [x[1] for x in EXPECTED], _TITLED)} AS vertical, {_pick('o_orderkey', [x[2] for x in EXPECTED], _TITLED)} AS level FROM orders",
    "rules_admission": f"SELECT o_orderkey, {_pick('o_orderkey', [x[3] for x in EXPECTED], _TITLED)} AS refused FROM orders",
    "rules_forms": f"SELECT o_orderkey, {_pick('o_orderkey', [x[0] for x in FORMS], len(FORMS))} AS form, {_pick('o_orderkey', [x[1] for x in FORMS], len(FORMS))} AS kind, {_pick('o_orderkey', [x[2] for x in FORMS], len(FORMS))} AS confidence FROM orders",
    "rules_buyers": f"SELECT o_orderkey, {_pick('o_orderkey', [x[1] for x in BUYER_NAMES], len(BUYER_NAMES))} AS kind FROM orders",
    "text_locations": """WITH p AS (SELECT c_custkey, [CASE c_custkey % 3 WHEN 0 THEN 'London' WHEN 1 THEN n_name END, CASE WHEN c_custkey % 2 = 0 THEN 'North' END, CASE WHEN c_custkey % 3 <> 1 THEN n_name END] AS parts FROM customer JOIN nation ON c_nationkey = n_nationkey)
      SELECT c_custkey, array_to_string(list_filter(parts, lambda x: x IS NOT NULL), ', ') AS place FROM p""",
    "text_pretty_names": """SELECT p_partkey, upper(p_type[1]) || lower(p_type[2:]) || ' of the ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') || ' PLC' AS name FROM part""",
    "text_same_company": "SELECT p_partkey, p_partkey % 4 <> 2 AS same, p_partkey % 4 = 3 AS registrant FROM part",
    "text_lookalikes": "SELECT p_partkey, true AS same FROM part",
    "text_visible": r"""WITH t AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)\b.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g') AS t FROM pages),
      n AS (SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(t, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS t FROM t)
      SELECT page_id, trim(regexp_replace(t, '[\s\x{00a0}]+', ' ', 'g')) AS body FROM n""",
    "filter_symbols": """WITH s AS (SELECT p_partkey, upper(regexp_replace(p_name, '[^a-z]', '', 'g') || CASE WHEN p_size % 3 = 0 THEN '.b' ELSE '' END) AS s FROM part),
      x AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN substr(s, 1, 4) WHEN 1 THEN 'ZVZZT' ELSE s END AS symbol FROM s)
      SELECT * FROM x WHERE regexp_full_match(symbol, '[A-Z]{1,5}([.-][A-Z]{1,2})?') AND symbol NOT IN ('ZVZZT', 'ZWZZT', 'ZXZZT', 'ZJZZT', 'TEST')""",
    "math_roundings": """WITH x AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS n, o_totalprice AS p FROM orders), y AS (SELECT *, n * 125 AS k FROM x)
      SELECT o_orderkey, (k // 10 + CASE WHEN k % 10 >= 5 THEN 1 ELSE 0 END) / 100 AS up, (k // 10 + CASE WHEN k % 10 > 5 OR k % 10 = 5 AND (k // 10) % 2 = 1 THEN 1 ELSE 0 END) / 100 AS even, round(p / 7, 6) AS six FROM y""",
    "arrays_capped": """WITH g AS (SELECT l_suppkey, list_sort(list(DISTINCT l_partkey)) AS p FROM lineitem GROUP BY 1)
      SELECT l_suppkey, array_to_string(list_slice(p, 1, 5), ',') AS kept, CAST(greatest(len(p) - 5, 0) AS INTEGER) AS left_out FROM g""",
    "dates_periods": f"""WITH {_O} SELECT o_orderkey, CASE WHEN strftime(day, '%m-%d') = '12-31' THEN concat('FY', year(day)) WHEN strftime(day, '%m-%d') = '06-30' THEN concat(year(day), 'H1') ELSE concat('FY', year(day), CASE WHEN month(day) <= 6 THEN 'H1' ELSE 'H2' END) END AS period FROM o""",
    "dates_fiscal_years": f"""WITH {_O}, n AS (SELECT DISTINCT o_custkey, last_day(day) AS "end" FROM o),
      f AS (SELECT n.o_custkey, n."end", first(year(o.day) ORDER BY o.day) AS fy FROM n JOIN o ON o.o_custkey = n.o_custkey AND date_diff('day', n."end", o.day) BETWEEN 1 AND 150 GROUP BY ALL)
      SELECT o_custkey, "end", CAST(CASE WHEN month("end") <= 2 THEN year("end") - 1 ELSE coalesce(fy, year("end")) END AS INTEGER) AS fy FROM n LEFT JOIN f USING (o_custkey, "end")""",
    "ids_filings": f"""WITH {_O}, a AS (SELECT o_orderkey, o_custkey, concat_ws('-', lpad(CAST(o_custkey AS VARCHAR), 10, '0'), strftime(day, '%y'), lpad(CAST(o_orderkey AS VARCHAR), 6, '0')) AS accession FROM o)
      SELECT o_orderkey, accession, concat('https://www.example.org/Archives/data/', o_custkey, '/', replace(accession, '-', ''), '/', accession, '-index.htm') AS "index" FROM a""",
}
