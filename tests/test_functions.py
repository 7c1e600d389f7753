"""Column functions on cases that turn on ties, nulls and odd input."""

import datetime as dt

from pyspark.sql import functions as F

from tallyspark.functions import dates, identifiers, rules, text
from tallyspark.operators import facts, market, state


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_tolerant_dates(spark):
    cases = {"2026-02-31": None, "3 March 2026": dt.date(2026, 3, 3), "march 3, 2026": dt.date(2026, 3, 3), "13/02/2026": dt.date(2026, 2, 13), "02/13/2026": dt.date(2026, 2, 13), "02/03/2026": None, "05/05/2026": dt.date(2026, 5, 5), "junk": None}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", dates.tolerant_date(F.col("t")).alias("d")).collect()
    assert {r["t"]: r["d"] for r in rows} == cases


def test_quarters_and_cohorts(spark):
    assert one(spark, dates.previous_quarter(F.lit("2026Q1"))) == "2025Q4"
    assert one(spark, dates.due_quarter(F.lit("2026-05-19").cast("date"))) == "2026Q1"
    assert one(spark, dates.due_quarter(F.lit("2026-05-18").cast("date"))) == "2025Q4"
    assert one(spark, dates.cohort_year(F.lit("Summer 2025/26 analyst"))) == 2026
    assert one(spark, dates.cohort_year(F.lit("Analyst FY27"))) == 2027
    assert one(spark, dates.next_friday(F.lit("2026-11-27").cast("date"))) == dt.date(2026, 11, 27)
    today = F.lit("2026-01-10").cast("date")
    assert one(spark, dates.relative_day(F.lit("Posted 3 days ago"), today)) == dt.date(2026, 1, 7)
    assert one(spark, dates.relative_day(F.lit("Posted 30+ days ago"), today)) is None


def test_text(spark):
    assert one(spark, text.slug(F.lit("  Société & Fils, S.A. "))) == "societe-and-fils-s-a"
    assert one(spark, text.company_core(F.lit("Acme Holdings, Inc."))) == "acme"
    assert one(spark, text.canonical_url(F.lit("HTTPS://www.Ex.com/a/?utm_x=1&b=2#f"))) == "ex.com/a?b=2"
    assert one(spark, text.amount_billions(F.lit("worth $1.5bn and EUR 3m"))) == 1.5
    assert one(spark, text.amount_billions(F.lit("EUR 300 million"))) == 0.3
    assert one(spark, text.unique_place(F.lit("ab cd ab"), F.lit("cd"))) == 3
    assert one(spark, text.unique_place(F.lit("ab cd ab"), F.lit("ab"))) is None
    assert one(spark, text.title_core(F.lit("Analyst - London, UK"), F.array(F.lit("london"), F.lit("uk")))) == "Analyst"
    assert one(spark, text.occurrences(F.lit("aaa"), F.lit("a"))) == 3


def test_identifiers(spark):
    assert one(spark, identifiers.cusip_check_digit(F.lit("03783310"))) == 0
    assert one(spark, identifiers.cusip_check_digit(F.lit("bad"))) is None
    a = one(spark, identifiers.fingerprint(F.lit(" A "), F.lit(None).cast("string")))
    assert a == one(spark, identifiers.fingerprint(F.lit("a"), F.lit("")))


def test_rules_and_backoff(spark):
    assert one(spark, rules.first_failure([(F.lit(True), "a"), (F.lit(None).cast("boolean"), "b")])) == "b"
    assert [one(spark, state.backoff(F.lit(n))) for n in (1, 2, 3, 4, 60)] == [3, 6, 12, 21, 21]
    assert one(spark, market.split_shape(F.lit(0.501))) == 2.0
    assert one(spark, market.split_shape(F.lit(1.02))) is None
    assert one(spark, facts.period_kind(F.lit(None).cast("date"), F.lit("2026-01-01").cast("date"))) == "instant"


def test_as_of_on_equal_times_and_missing_keys(spark):
    from tallyspark.operators.joins import as_of

    left = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("b", 5, 3)], "k string, t int, id int")
    right = spark.createDataFrame([("a", 5, "x"), ("a", 2, "y")], "k string, t int, v string")
    got = {r["id"]: r["v"] for r in as_of(left, right, "k", "t", "v").collect()}
    assert got == {1: "x", 2: None, 3: None}


def test_fee_perimeter_of_many_parts(spark):
    import itertools

    from tallyspark.functions.mergers import fee_perimeter

    parts = [float(3 * k * k + 7) for k in range(60)]
    cases = [(parts, sum(parts)), (parts, sum(parts) - parts[7]), (parts, sum(parts) - parts[3] - parts[50]), (parts, sum(parts) - parts[1] - parts[30] - parts[59]), (parts, 1.0), ([], 5.0), ([4.0], 0.0)]
    rows = spark.createDataFrame(cases, "parts array<double>, total double").select("parts", "total", fee_perimeter(F.col("total"), F.col("parts"), 1e-9).alias("x")).collect()
    for r, (own, total) in zip(rows, cases, strict=True):
        gap = sum(own) - total
        fits = [c for n in range(4) for c in itertools.combinations(range(len(own)), n) if abs(sum(own[i] for i in c) - gap) <= 1e-9 * total] if own else [()]
        assert (None if r["x"]["left_out"] is None else tuple(r["x"]["left_out"])) == (fits[0] if fits else None)


def test_functions_moved_from_queries(spark):
    from tallyspark.functions import arrays, identifiers
    from tallyspark.functions.unicode import nfkc
    from tallyspark.operators import ranking, screens

    symbols = {"ABC": True, "BRK.B": True, "ZVZZT": False, "TOOLONG": False, "a": False, "AB-CDE": False}
    got = spark.createDataFrame([(s,) for s in symbols], "s string").select("s", identifiers.publishable(F.col("s"))).collect()
    assert dict(map(tuple, got)) == symbols
    url = "https://www.example.org/Archives/data/12/000000001224000007/doc.htm"
    r = spark.createDataFrame([(url,), ("https://www.example.org/",)], "u string").select(identifiers.accession(F.col("u")).alias("a"), identifiers.index_address(F.col("u")).alias("i")).collect()
    assert r[0]["a"] == "0000000012-24-000007" and r[0]["i"].endswith("/000000001224000007/0000000012-24-000007-index.htm") and r[1]["a"] == ""
    days = {dt.date(2024, 12, 31): "FY2024", dt.date(2024, 6, 30): "2024H1", dt.date(2024, 6, 29): "FY2024H1", dt.date(2024, 7, 1): "FY2024H2"}
    assert {r[0]: r[1] for r in spark.createDataFrame([(d,) for d in days], "d date").select("d", dates.reporting_period(F.col("d"))).collect()} == days
    (r,) = spark.createDataFrame([([3, 1, 3, 2],)], "a array<int>").select(arrays.capped(F.col("a"), 2).alias("x"), arrays.rounded(F.lit("0.125")).alias("u"), arrays.rounded(F.lit("0.125"), half_even=True).alias("e")).collect()
    assert (list(r["x"]["kept"]), r["x"]["left_out"], r["u"], r["e"]) == ([3, 1], 1, 0.13, 0.12)
    assert [r[0] for r in spark.createDataFrame([("ﬁxＡ",), (None,)], "t string").select(nfkc("t")).collect()] == ["fixA", None]
    m = spark.createDataFrame([({"a": "1", "z": "2", "b": "3"},), ({},)], "m map<string,string>")
    kept, bad = screens.allowed_fields(F.col("m"), ("b", "a"), ("z", "y"))
    assert [tuple(r) for r in m.select(*kept, bad).collect()] == [("3", "1", "z"), (None, None, "")]
    pages = spark.createDataFrame([("k", 1, 5, "b"), ("k", 2, 9, "a"), ("k", 3, 9, "a"), ("one", 4, 1, "a")], "k string, page int, s int, kind string")
    rows = ranking.card_and_detail(pages, "k", "page", F.col("s"), F.col("kind")).collect()
    assert {r["k"]: (r["card"], r["detail"]) for r in rows} == {"k": (2, 3), "one": (4, None)}
    ends = spark.createDataFrame([("c", dt.date(2024, 1, 31)), ("c", dt.date(2024, 3, 31)), ("c", dt.date(2023, 3, 31))], "k string, end date")
    filed = spark.createDataFrame([("c", dt.date(2024, 5, 1), 2099), ("c", dt.date(2024, 6, 1), 2098)], "k string, filed date, fy int")
    assert {r["end"].year * 100 + r["end"].month: r["fy"] for r in facts.fiscal_years(ends, filed, "k").collect()} == {202401: 2023, 202403: 2099, 202303: 2023}


def test_quotients_and_logarithms_of_zero(spark):
    import duckdb

    from tallyspark.functions import arrays

    each = [0.0, 2.0, -3.0, None, float("nan"), float("inf"), float("-inf")]
    rows = spark.createDataFrame([(a, b) for a in each for b in each], "a double, b double")
    got = rows.select(arrays.quotient(F.col("a"), F.col("b")), arrays.logarithm(F.col("a"))).collect()
    c = duckdb.connect()
    want = [c.execute("SELECT a / b, ln(a) FROM (SELECT ?::DOUBLE AS a, ?::DOUBLE AS b)", [a, b]).fetchone() for a in each for b in each]
    assert [repr(tuple(r)) for r in got] == [repr(tuple(r)) for r in want]
