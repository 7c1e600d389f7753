"""Readers and writers over small hand-made files."""

import datetime as dt

import pytest

from tallyspark.sources import readers, sinks


def write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_holdings_xml(spark, tmp_path):
    row = "<ns1:infoTable><ns1:nameOfIssuer> Acme </ns1:nameOfIssuer><ns1:titleOfClass>COM</ns1:titleOfClass><ns1:cusip> 00a </ns1:cusip><ns1:value>{v}</ns1:value><ns1:shrsOrPrnAmt><ns1:sshPrnamt>7</ns1:sshPrnamt></ns1:shrsOrPrnAmt></ns1:infoTable>"
    path = write(tmp_path, "t.xml", '<ns1:informationTable xmlns:ns1="u">' + row.format(v="1,200") + row.format(v="none") + "</ns1:informationTable>")
    got = sorted((r["cusip"], r["type"], r["value"], r["shares"]) for r in readers.holdings_xml(spark, path).collect())
    assert got == [("00A", "SH", 0.0, 7.0), ("00A", "SH", 1200.0, 7.0)]


def test_reference_rates(spark, tmp_path):
    block = "<Cube time='2026-01-02'><Cube currency='USD' rate='1.25'/><Cube currency='GBP' rate='0.8'/></Cube>"
    good = readers.reference_rates(spark, write(tmp_path, "a.xml", f"<Cube>{block}</Cube>")).collect()
    assert sorted((r["currency"], r["rate"]) for r in good) == [("GBP", 0.8), ("USD", 1.25)]
    from tallyspark.operators import deals

    fx = deals.fx_rates(spark.createDataFrame(good)).first()
    assert (fx["eur"], fx["gbp"]) == (0.8, 0.64)
    with pytest.raises(Exception, match="one dated block"):
        readers.reference_rates(spark, write(tmp_path, "b.xml", f"<Cube>{block}{block}</Cube>")).collect()


def test_tolerant_json_and_zipped_columns(spark, tmp_path):
    write(tmp_path, "good.json", '{"form": ["A", "B"], "day": ["2026-01-01"]}')
    write(tmp_path, "bad.json", "{oops")
    rows = readers.tolerant_json(spark, str(tmp_path / "*.json"), "form array<string>, day array<string>")
    assert rows.count() == 2
    got = readers.zipped_columns(rows.filter("_corrupt is null").drop("_corrupt"), [], ["form", "day"]).collect()
    assert [(r["form"], r["day"]) for r in got] == [("A", "2026-01-01"), ("B", None)]


def test_decoded_holders(spark):
    docs = spark.createDataFrame([("T", [["m1", "One"], ["m2", "Two"]], {"2026Q1": [["1", "10", "new", "5"], ["0", "20", "held"]]})], "ticker string, managers array<array<string>>, quarters map<string, array<array<string>>>")
    got = sorted((r["manager_id"], r["value"], r["shares"]) for r in readers.decoded_holders(docs).collect())
    assert got == [("m1", 20.0, None), ("m2", 10.0, 5.0)]


def test_observations_prefers_the_first_taxonomy(spark):
    schema = "cik long, facts map<string, map<string, map<string, array<struct<end: string, val: double>>>>>"
    facts = {"ifrs-full": {"Revenue": {"USD": [("2025", 1.0)]}}, "us-gaap": {"Revenue": {"USD": [("2026", 2.0), ("2027", None)]}}}
    got = readers.observations(spark.createDataFrame([(1, facts)], schema), "Revenue").collect()
    assert [(r["end"], r["val"]) for r in got] == [("2026", 2.0)]


def test_dated_csv(spark, tmp_path):
    path = write(tmp_path, "c.csv", 'When,"10 Yr",x\n1/2/2026,4.5,1\n2026-01-03,n/a,1\n')
    got = readers.dated_csv(spark, path, "^when", "10 ?yr").orderBy("d").collect()
    assert [(r["d"], r["v"]) for r in got] == [(dt.date(2026, 1, 2), 4.5), (dt.date(2026, 1, 3), None)]


def test_form_index(spark):
    lines = [("DEFM14A       BIG CO 2 INC            1234567    2026-01-05  edgar/data/1234567/0001234567-26-000001.txt",), ("10-K          OTHER                   1          2026-01-05  edgar/data/1/0000000001-26-000002.txt",), ("DEFM14A bad line",)]
    got = readers.form_index(spark.createDataFrame(lines, "value string"), ["DEFM14A", "SC 13D"]).collect()
    assert [(r["form"], r["name"], r["cik"], r["accession"]) for r in got] == [("DEFM14A", "BIG CO 2 INC", 1234567, "0001234567-26-000001")]


def test_newest_symbols(spark):
    rows = [("f1", "d|123456789|OLD|x"), ("f2", "d|123456789|NEW|x"), ("f2", "d|12345678|BAD|x"), ("f2", "junk")]
    got = readers.newest_symbols(spark.createDataFrame(rows, "file string, value string")).collect()
    assert [(r["cusip"], r["symbol"]) for r in got] == [("123456789", "NEW")]


def test_feeds_and_calendars(spark):
    item = "<item><title><![CDATA[A &amp;amp; B]]></title><link>http://x/1</link><pubDate>Fri, 02 Jan 2026 10:00:00 GMT</pubDate></item><item><title>C</title><pubDate>soon</pubDate></item>"
    got = readers.rss(spark.createDataFrame([("s", item)], "source string, value string")).collect()
    assert [(r["title"], r["published"]) for r in got] == [("A & B", dt.datetime(2026, 1, 2, 10)), ("C", None)]
    cal = "BEGIN:VEVENT\r\nSUMMARY:Rate\r\n  day\\, late\r\nDTSTART;TZID=X:20260301T143000\r\nEND:VEVENT\r\nBEGIN:VEVENT\nSUMMARY:All\nDTSTART;VALUE=DATE:20260302\nEND:VEVENT"
    rows = readers.ics(spark.createDataFrame([(cal,)], "value string")).orderBy("day").collect()
    assert [(r["summary"], r["day"], r["time"]) for r in rows] == [("Rate day, late", dt.date(2026, 3, 1), "14:30"), ("All", dt.date(2026, 3, 2), None)]


def test_html_parts(spark):
    html = '<a href="/1"><b>Summer analyst</b></a><a href="/2">Summer analyst</a><a href="/3">x</a> on 3 March 2026 and April 31, 2026'
    pages = spark.createDataFrame([(1, html)], "k int, html string")
    assert [(r["title"], r["url"]) for r in readers.anchors(pages, "k", "html").collect()] == [("Summer analyst", "/1")]
    assert [r["day"] for r in readers.dated_entries(pages, "k", "html").collect()] == [dt.date(2026, 3, 3)]
    m = spark.createDataFrame([("<loc>https://x.org/a/1</loc><loc>https://x.org/b</loc><loc>https://x.org/a/1</loc>",)], "value string")
    assert [r["path"] for r in readers.sitemap_paths(m, ["/a"]).collect()] == ["/a/1"]


def test_write_changed_only_rewrites_what_differs(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("b", 3, "x")], "k string, v int, generated_at string")
    assert sinks.write_changed(rows, path, "k") == 2
    assert sinks.write_changed(rows.withColumn("generated_at", rows["v"].cast("string")), path, "k") == 0
    changed = spark.createDataFrame([("a", 9, "y"), ("b", 2, "x"), ("b", 3, "x")], rows.schema)
    assert sinks.write_changed(changed, path, "k") == 1
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 9), ("b", 2), ("b", 3)]


def test_merge_ledger_and_markdown(spark, tmp_path):
    old = spark.createDataFrame([(1, "o"), (2, "o")], "id int, s string")
    new = spark.createDataFrame([(2, "n"), (3, "n")], "id int, s string")
    assert sorted((r["id"], r["s"]) for r in sinks.merge_write(new, old, ["id"]).collect()) == [(1, "o"), (2, "n"), (3, "n")]
    assert sorted((r["id"], r["s"]) for r in sinks.partial_refresh(new, old, "id").collect()) == [(1, "o"), (2, "n"), (3, "n")]
    path = str(tmp_path / "ledger")
    sinks.append_ledger(spark.createDataFrame([("late", "2026-01-01"), ("late", "2026-01-02")], "reason string, day string"), path, ["late"])
    assert [(r["reason"], r["n"], r["last"]) for r in sinks.ledger_summary(spark.read.json(path)).collect()] == [("late", 2, "2026-01-02")]
    with pytest.raises(Exception, match="unknown reason"):
        sinks.append_ledger(spark.createDataFrame([("why", "2026-01-01")], "reason string, day string"), path, ["late"])
    table = sinks.markdown_table(spark.createDataFrame([(2, "b|c"), (1, None)], "k int, t string"), ["k"], ["k", "t"]).first()["table"]
    assert table.splitlines()[2:] == ["| 1 |  |", "| 2 | b\\|c |"]
    assert sorted(r["shard"] for r in sinks.sharded(spark.createDataFrame([("abc",), ("9x",)], "s string"), "s").collect()) == ["#", "A"]


def test_filing_pages_with_nothing_in_them(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, '<table class="tableFile"><tr><td>1<td>2</table><span class="companyName"></span>')], "k int, html string")
    assert readers.filing_documents(pages, "k", "html").count() == 0
    assert [(r["k"], r["name"], r["role"], r["cik"]) for r in readers.filing_parties(pages, "k", "html").collect()] == [(3, "", "other", None)]
    assert sorted((r["k"], r["filed"]) for r in readers.filing_facts(pages, "k", "html").collect()) == [(1, None), (2, None), (3, None)]


def test_monthly_series_and_refusals(spark):
    assert readers.year_windows(2004, 2026) == [(2004, 2013), (2014, 2023), (2024, 2026)]
    answer = '{"status": "REQUEST_SUCCEEDED", "Results": {"series": [{"seriesID": "S", "data": [{"year": "2025", "period": "M10", "value": "-"}, {"year": "2025", "period": "M09", "value": "3.5"}, {"year": "2025", "period": "M13", "value": "3"}]}]}}'
    got = readers.monthly_series(spark.createDataFrame([(answer,)], "value string")).collect()
    assert [(r["series"], r["d"], r["v"]) for r in got] == [("S", dt.date(2025, 9, 1), 3.5)]
    for refused in ('{"status": "REQUEST_FAILED", "message": ["daily limit"]}', "no json"):
        with pytest.raises(Exception, match="series refused"):
            readers.monthly_series(spark.createDataFrame([(refused,)], "value string")).collect()


def test_job_boards_that_are_odd(spark):
    from tallyspark.sources import postings

    rows = [
        ("oracle", "b", "h", None), ("oracle", "b", "h", "{oops"), ("unknown", "b", "h", '{"jobs": [{"id": 1}]}'), (None, "b", "h", '{"jobs": []}'),
        ("eightfold", "b", "h", '{"positions": [{"id": 7, "name": "T", "t_create": 1700000000000, "department": "", "business_unit": "U"}, {"id": 8, "name": " "}]}'),
        ("recruitee", "Firm", "h", '{"offers": [{"id": 1, "title": "T", "company_name": "firm", "careers_url": "u", "status": "draft"}, {"id": 2, "title": "T", "company_name": "firm", "careers_url": "u", "published_at": "soon"}, {"id": 3, "title": "T", "company_name": "other", "careers_url": "u"}]}'),
    ]
    df = spark.createDataFrame(rows, "family string, board string, host string, value string")
    got = sorted((r["family"], r["id"], r["posted"], r["department"], r["url"]) for r in postings.jobs(df).collect())
    assert got == [("eightfold", "7", None, "U", "https://h/careers/job/7"), ("recruitee", "2", None, None, "u")]
    assert postings.jobs(df.limit(0)).count() == 0


def test_a_published_version_stays_whole(spark, tmp_path):
    root = str(tmp_path / "t")
    one, two = spark.range(3), spark.range(5)
    sinks.publish(one, root)
    before = sinks.published(spark, root)
    sinks.publish(two, root)
    assert before.count() == 3 and sinks.published(spark, root).count() == 5


def test_two_deep_and_text_health_edges(spark):
    from pyspark.sql import functions as F

    from tallyspark.operators import health, market

    t = spark.createDataFrame([("a", 1, 1, 1, 5.0), ("a", 1, 2, 2, 6.0), ("a", 1, 3, 3, 7.0), ("b", 1, 1, 4, 8.0)], "symbol string, i int, at int, seq int, price double")
    undone = lambda *k: t.filter(F.col("seq").isin(*k))
    price = lambda *k: {r["symbol"]: r["price"] for r in market.two_deep(t, undone(*k)).collect()}
    assert price() == {"a": 7.0, "b": 8.0} and price(3) == {"a": 6.0, "b": 8.0} and price(3, 2, 4) == {"a": None, "b": None} and price(1) == {"a": 7.0, "b": 8.0}
    units = spark.createDataFrame([(1, None), (1, "")], "d int, t string")
    (r,) = health.text_health(units, "d", "t", ["x"]).collect()
    assert (r["n_units"], r["empty_ratio"], r["edge_ratio"], r["replaced_rate"], r["warnings"]) == (2, 1.0, 0.0, 0.0, "empty,markers,short")
    assert health.text_health(units.limit(0), "d", "t", ["x"]).count() == 0
