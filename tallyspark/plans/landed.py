"""Reader and writer queries: files written from the test tables into the shared folder, read back, and the SQL over the tables."""

from __future__ import annotations

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tallyspark.operators.health import text_health
from tallyspark.operators.state import checkpoint_folder
from tallyspark.plans.holdings import table
from tallyspark.sources import files, postings, readers, sinks


def fresh(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed when the application ends."""
    where = f"{checkpoint_folder(spark).rstrip('/')}/tallyspark-landed/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return where


def text_files(df: DataFrame, *parts: Column | str, by: str | None = None) -> str:
    """One line a row."""
    line = F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]).alias("value")
    path = fresh(df.sparkSession, "text")
    if by:
        df.select(line, by).write.partitionBy(by).text(path)
    else:
        df.select(line).write.text(path)
    return path


def text_column(df: DataFrame, key: str, *parts: Column | str) -> DataFrame:
    """(key, value) written and read back as Parquet, as pages and feeds land."""
    value = F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]).alias("value")
    path = fresh(df.sparkSession, "pages")
    df.select(key, value).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date")).withColumn("even", F.col("o_orderkey") % 2 == 0)


def holdings_xml(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    odd, kind = F.col("l_linenumber") == 7, F.when(F.col("l_returnflag") == "R", "prn")
    right = F.when(F.col("l_linenumber") == 1, F.when(F.col("l_linestatus") == "O", "Put"))
    path = fresh(spark, "xml")
    rows.select(
        F.concat(F.lit(" "), "p_name").alias("nameOfIssuer"), F.col("l_returnflag").alias("titleOfClass"), F.concat(F.lit(" "), F.lower("p_brand")).alias("cusip"),
        F.when(odd, "none").otherwise(F.format_number("l_extendedprice", 2)).alias("value"), F.struct(F.col("l_quantity").cast("string").alias("sshPrnamt"), kind.alias("sshPrnamtType")).alias("shrsOrPrnAmt"), right.alias("putCall"),
    ).write.format("xml").option("rootTag", "informationTable").option("rowTag", "infoTable").save(path)
    return readers.holdings_xml(spark, path)


def reference_rates(spark, sf_dir):
    cube = F.concat(F.lit("<Cube currency='N"), F.char(65 + F.floor(F.col("n_nationkey") / 26)), F.char(65 + F.col("n_nationkey") % 26), F.lit("' rate='"), (F.col("n_nationkey") + 1) / 8, F.lit("'/>"))
    one = table(spark, sf_dir, "nation").agg(F.array_join(F.array_sort(F.collect_list(cube)), "\n").alias("cubes"))  # the nations, 25 of them
    return readers.reference_rates(spark, text_files(one, "<Cube><Cube time='2026-01-02'>", F.col("cubes"), "</Cube></Cube>"))


def json_files(spark, sf_dir):
    """A file for each region with its nations as parallel arrays; one file can't be read."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    one = n.groupBy("r_regionkey", "r_name").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("n"))
    doc = F.to_json(F.struct("r_name", F.col("n.n_nationkey").alias("id"), F.col("n.n_name").alias("name")))
    docs = one.select("r_regionkey", F.when(F.col("r_regionkey") == 2, "{oops").otherwise(doc).alias("doc")).repartition("r_regionkey")
    got = readers.tolerant_json(spark, text_files(docs, F.col("doc"), by="r_regionkey"), "r_name string, id array<int>, name array<string>")
    rows = readers.zipped_columns(got.filter("_corrupt is null").drop("_corrupt"), ["r_name"], ["id", "name"])
    return rows.unionByName(got.filter("_corrupt is not null").select(F.coalesce("r_name", F.lit("unreadable")).alias("r_name"), F.get("id", F.lit(0)).alias("id"), F.coalesce(F.get("name", F.lit(0)), F.regexp_replace("_corrupt", r"\s+$", "")).alias("name")))


def lines_of_orders(spark, sf_dir):
    row = F.struct("l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(row)).alias("r"))


def columnar(spark, sf_dir):
    """An order's lines as parallel arrays, the prices' one element short."""
    o = lines_of_orders(spark, sf_dir)
    path = fresh(spark, "json")
    o.select("l_orderkey", F.col("r.l_suppkey").alias("supplier"), F.slice("r.l_extendedprice", F.lit(1), F.size("r") - 1).alias("price")).write.json(path)
    return readers.zipped_columns(spark.read.schema("l_orderkey long, supplier array<long>, price array<double>").json(path), ["l_orderkey"], ["supplier", "price"])


def observations(spark, sf_dir):
    o = lines_of_orders(spark, sf_dir)
    kept = F.transform("r", lambda x: F.struct(x["day"].alias("end"), F.when(x["l_linenumber"] != 3, x["l_extendedprice"]).alias("val")))
    decoy = F.array(F.struct(F.lit("2000-01-01").alias("end"), F.lit(-1.0).alias("val")))
    unit = lambda rows: F.create_map(F.lit("Price"), F.create_map(F.lit("USD"), rows))
    facts = F.when(F.col("l_orderkey") % 2 == 1, F.create_map(F.lit("ifrs-full"), unit(decoy), F.lit("us-gaap"), unit(kept))).otherwise(F.create_map(F.lit("ifrs-full"), unit(kept)))
    path = fresh(spark, "json")
    o.select(F.col("l_orderkey").alias("cik"), facts.alias("facts")).write.json(path)
    schema = "cik long, facts map<string, map<string, map<string, array<struct<end: string, val: double>>>>>"
    return readers.observations(spark.read.schema(schema).json(path), "Price")


def decoded_holders(spark, sf_dir):
    """An order as a ticker: managers in one list, each quarter's rows by their place in it; the fourth cell is missing for line 1."""
    o = lines_of_orders(spark, sf_dir)
    s = lambda c: c.cast("string")
    cells = F.transform("r", lambda x, i: F.concat(F.array(s(i), s(x["l_extendedprice"]), F.lit("held")), F.when(x["l_linenumber"] == 1, F.array().cast("array<string>")).otherwise(F.array(s(x["l_quantity"])))))
    path = fresh(spark, "json")
    o.select(F.col("l_orderkey").cast("string").alias("ticker"), F.transform("r", lambda x: F.array(s(x["l_suppkey"]), F.lit("name"))).alias("managers"), F.create_map(F.lit("2026Q1"), cells).alias("quarters")).write.json(path)
    return readers.decoded_holders(spark.read.schema("ticker string, managers array<array<string>>, quarters map<string, array<array<string>>>").json(path))


def dated_csv(spark, sf_dir):
    path = fresh(spark, "csv")
    day = F.when(F.col("even"), F.date_format("day", "M/d/yyyy")).otherwise(F.date_format("day", "yyyy-MM-dd"))
    value = F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    orders(spark, sf_dir).select(F.col("o_orderkey").alias("Key"), day.alias("Observation Date"), value.alias("10 Yr (pct)")).write.option("header", True).csv(path)
    return readers.dated_csv(spark, path, "^observation", r"10 ?yr")


def form_index(spark, sf_dir):
    form = F.element_at(F.array(F.lit("DEFM14A"), F.lit("SC 13D"), F.lit("10-K"), F.lit("DEFM14A/A")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    file = F.concat(F.lit("edgar/data/"), F.col("o_custkey") + 1, F.lit("/"), F.lpad(F.col("o_custkey") + 1, 10, "0"), F.lit("-26-"), F.lpad(F.col("o_orderkey") % 1000000, 6, "0"), F.lit(".txt"))
    path = text_files(orders(spark, sf_dir), F.rpad(form, 17, " "), F.rpad(F.concat(F.lit("BIG CO "), F.col("o_orderkey"), F.lit(" INC")), 40, " "), F.rpad((F.col("o_custkey") + 1).cast("string"), 12, " "), F.date_format("day", "yyyy-MM-dd"), "  ", file)
    return readers.form_index(spark.read.text(path), ["DEFM14A", "SC 13D"])


def newest_symbols(spark, sf_dir):
    """Two files of pipe-delimited lines; of the older one's odd parts the newer has no sound row."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array(F.lit("2026a"), F.lit("2026b"))).alias("file"))
    late = F.col("file") == "2026b"
    symbol = F.when(late & (F.col("p_partkey") % 2 == 1), "9BAD").when(late, "NEW").otherwise("OLD")
    path = text_files(p, "20260101|", F.lpad(F.col("p_partkey").cast("string"), 9, "0"), "| ", symbol, " |100", by="file")
    return readers.newest_symbols(spark.read.schema("value string, file string").text(path))


@F.pandas_udf(BinaryType())
def archive(names: pd.Series, bodies: pd.Series) -> pd.Series:
    """An archive of members (names, bodies) in each row."""

    def one(n, b):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, body in zip(n, b, strict=True):
                z.writestr(name, body)
        return out.getvalue()

    return pd.Series([one(n, b) for n, b in zip(names, bodies, strict=True)])


def archives(df: DataFrame, key: Column, names: Column, bodies: Column) -> DataFrame:
    path = fresh(df.sparkSession, "archives")
    df.select(F.concat(F.lit("f"), key).alias("path"), archive(names, bodies).alias("content")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def zipped(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    body = F.concat(F.col("s_suppkey"), F.lit("|"), F.col("s_name"), F.lit("\r\n|"), F.col("s_nationkey"), F.lit("|"))
    df = archives(s, F.col("s_suppkey"), F.array(F.lit("x.txt"), F.lit("empty.txt")), F.array(body, F.lit("")))
    return files.zipped_lines(df).select("path", "member", "line_no", F.array_join("cells", ";").alias("cells"))


def sheets(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    strings = F.concat(F.lit(f"<sst {ns}><si><t>Country</t></si><si><r><t>Tax </t></r><r><t>rate</t></r></si><si><t>"), F.col("s_name"), F.lit("</t></si></sst>"))
    head = '<row r="1"><c r="A1" t="inlineStr"><is><t>Notes</t></is></c></row><row r="3"><c r="B3" t="s"><v>0</v></c><c r="D3" t="s"><v>1</v></c></row>'
    sheet = F.concat(F.lit(f'<worksheet {ns}><sheetData>{head}<row r="4"><c r="B4" t="s"><v>2</v></c><c r="D4"><v>'), F.col("s_nationkey"), F.lit("</v></c></row></sheetData></worksheet>"))
    df = archives(s, F.col("s_suppkey"), F.array(F.lit("xl/sharedStrings.xml"), F.lit("xl/worksheets/sheet1.xml")), F.array(strings, sheet))
    found = files.after_header(files.sheet_rows(df), ["path", "sheet"], "^tax")
    return found.select("path", F.get("cells", F.lit(1)).alias("country"), F.get("cells", F.lit(3)).cast("int").alias("rate"), F.get("header", F.lit(3)).alias("head"))


def images(spark, sf_dir):
    """A raster of two blocks a supplier: one all of a shade, one white."""
    s = table(spark, sf_dir, "supplier")
    row = F.concat(F.repeat(F.lpad(F.hex(F.col("s_suppkey") % 200), 2, "0"), 12), F.lit("FF" * 12))
    content = F.concat(F.encode(F.lit("P5\n24 12\n255\n"), "US-ASCII"), F.unhex(F.repeat(row, 12)))
    path = fresh(spark, "images")
    s.select(F.concat(F.lit("i"), F.col("s_suppkey")).alias("path"), content.alias("content")).write.parquet(path)
    return files.image_blocks(spark.read.parquet(path))


def sections(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    pages = text_column(p, "p_partkey", "<h1>", F.col("p_name"), "</h1>lead<p>one <b>", F.col("p_brand"), "</b><script>x()</script></p><table><tr><td>a<td>", F.col("p_size"), "</table><ul><li>", F.col("p_type"), "</ul>")
    return files.sections(pages, "p_partkey", "value").select("p_partkey", "k", "tag", "body")


def feeds(spark, sf_dir):
    o = orders(spark, sf_dir)
    rows = text_column(o.withColumnRenamed("o_orderkey", "source"), "source", "<rss><item><title><![CDATA[A &amp;amp; ", F.col("o_orderpriority"), "]]></title><link>http://x/", F.col("o_custkey"), "</link><pubDate>",
                       F.when(F.col("source") % 3 == 0, "soon").otherwise(F.date_format("day", "'Fri, 'd MMM yyyy' 10:00:00 GMT'")), "</pubDate></item><item><title>C &quot;D&quot;</title></item></rss>")
    return readers.rss(rows)


def calendars(spark, sf_dir):
    start = F.when(F.col("even"), F.concat(F.lit(";VALUE=DATE:"), F.date_format("day", "yyyyMMdd"))).otherwise(F.concat(F.lit(";TZID=X:"), F.date_format("day", "yyyyMMdd"), F.lit("T143000")))
    rows = text_column(orders(spark, sf_dir), "o_orderkey", "BEGIN:VEVENT\r\nSUMMARY:Order ", F.col("o_orderkey"), "\\, fol\r\n ded\r\nDTSTART", start, "\r\nEND:VEVENT\r\nBEGIN:VEVENT\nSUMMARY:no day\nDTSTART:soon\nEND:VEVENT")
    return readers.ics(rows)


def dated(spark, sf_dir):
    rows = text_column(orders(spark, sf_dir), "o_orderkey", "The board met on ", F.date_format("day", "d MMMM yyyy"), " to vote; order ", F.col("o_orderkey"), " follows on ", F.date_format(F.date_add("day", 30), "MMMM d, yyyy"), ", never on April 31, 2026.")
    return readers.dated_entries(rows, "o_orderkey", "value", 20)


def anchors(spark, sf_dir):
    return readers.anchors(table(spark, sf_dir, "pages"), "page_id", "html")


def sitemaps(spark, sf_dir):
    rows = text_column(table(spark, sf_dir, "pages"), "page_id", "<url><loc>", F.col("url"), "</loc></url>\n<url><loc> https://x.org/en/extra </loc></url>")
    return readers.sitemap_paths(rows, ["/en/", "/de/"])


def filing_pages(spark, sf_dir):
    o = orders(spark, sf_dir)
    row = lambda seq, what, href, name, kind, size: (f"<TR class=x><td>{seq}</td><td>", what, '</td><td><a href="', href, '">', name, f"</a></td><td>{kind}</td><td>", size, "</td></TR>")
    dir_ = F.concat(F.lit("/Archives/"), F.col("o_custkey"), F.lit("/"))
    return text_column(
        o, "o_orderkey", '<div class="infoHead">Filing Date</div>\n<div class="info">', F.date_format("day", "yyyy-MM-dd"), '</div><div class="infoHead">Accepted</div><div class="info"> </div>',
        '<table class="tableFile" summary="a"><tr><th>Seq</th></tr>', *row(1, F.concat(F.lit("Main &amp; "), F.col("o_orderstatus")), F.concat(F.lit("/ix?doc="), dir_, F.lit("main.htm")), F.lit("<b>main.htm</b>"), "8-K", F.format_number("o_orderkey", 0)),
        "<tr><td>short</td><td>row</td></tr></table><table class='other'><tr><td>1<td></table>", '<table class="tableFile">', *row(2, F.lit(" "), F.concat(dir_, F.lit("ex.htm")), F.lit(""), "EX-99", F.lit("")), "</table>",
        '<span class="companyName">Acme ', F.col("o_custkey"), ' (Subject) <acronym>CIK</acronym>: <a href="/x?CIK=', F.lpad(F.col("o_custkey").cast("string"), 10, "0"), '">all</a></span>',
        '<span class="companyName">Holder &amp; Co (Filed by) ', F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), ' (see all company filings)</span><span class="companyName">Other Inc</span>',
    )


def filing_documents(spark, sf_dir):
    return readers.filing_documents(filing_pages(spark, sf_dir), "o_orderkey", "value")


def filing_parties(spark, sf_dir):
    return readers.filing_parties(filing_pages(spark, sf_dir), "o_orderkey", "value")


def filing_facts(spark, sf_dir):
    return readers.filing_facts(filing_pages(spark, sf_dir), "o_orderkey", "value")


def monthly(spark, sf_dir):
    """A series a customer, its orders as months, an annual average and a gap after them."""
    o = orders(spark, sf_dir)
    points = F.collect_list(F.struct(F.date_format("day", "yyyy").alias("year"), F.date_format("day", "'M'MM").alias("period"), F.col("o_totalprice").cast("string").alias("value")))
    c = table(spark, sf_dir, "customer").join(o.groupBy("o_custkey").agg(points.alias("p")), F.col("c_custkey") == F.col("o_custkey"))
    more = F.array(*[F.struct(F.lit("2026").alias("year"), F.lit(m).alias("period"), F.lit(v).alias("value")) for m, v in (("M13", "1"), ("M10", "-"))])
    series = F.array(F.struct(F.col("c_name").alias("seriesID"), F.concat("p", more).alias("data")))
    doc = F.to_json(F.struct(F.lit("REQUEST_SUCCEEDED").alias("status"), F.struct(series.alias("series")).alias("Results")))
    return readers.monthly_series(text_column(c, "c_custkey", doc).select("value"))


def job_boards(spark, sf_dir):
    """Orders as postings of six families, one board an order; each board lists another that must go."""
    o = orders(spark, sf_dir).withColumn("family", F.element_at(F.array(*[F.lit(f) for f in postings.FAMILIES]), (F.col("o_orderkey") % 6 + 1).cast("int")))
    o = o.withColumn("id", F.col("o_orderkey").cast("string")).withColumn("title", F.concat(F.lit(" Analyst "), F.col("o_orderpriority"))).withColumn("on", F.date_format("day", "yyyy-MM-dd"))
    n = lambda **c: F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in c.items()])
    id_, title, on = F.col("id"), F.col("title"), F.col("on")
    city = n(city="Lima", country="Peru")
    lists = {
        "oracle": n(items=F.array(n(Id=id_, Title=title, PrimaryLocation="Lima", PostedDate=on, ShortDescriptionStr="one", ExternalQualificationsStr="two"), n(Id="x", Title=" ", PrimaryLocation="", PostedDate=on, ShortDescriptionStr="", ExternalQualificationsStr=""))),
        "eightfold": n(positions=F.array(n(id=id_, name=title, locations=F.array(F.lit("Lima"), F.lit("Oslo")), t_create=F.unix_timestamp("o_orderdate"), business_unit="M"))),
        "smartrecruiters": n(content=F.array(n(id=id_, name=title, company=n(identifier="FIRM"), location=n(city="London", region="London", country="gb", remote=True), function=n(label="F"), releasedDate=on), n(id="x", name="t", company=n(identifier="another"), location=n(city="a", region="b", country="c", remote=False), function=n(label="F"), releasedDate=on))),
        "recruitee": n(offers=F.array(n(id=id_, title=title, status="published", careers_url="https://r", locations=F.array(city, city), published_at=F.concat(on, F.lit(" 14:53:05 UTC")), close_at=on), n(id="x", title="(Closed) t", status="published", careers_url="https://r", locations=F.array(city, city), published_at="", close_at=""))),
        "pinpoint": n(data=F.array(n(id=id_, title=title, url="https://p", location=n(city="Lima", name="Lima"), job=n(department=n(name="D")), deadline_at=on, description="a"), n(id="x", title="t", url="", location=n(city="", name=""), job=n(department=n(name="D")), deadline_at=on, description="a"))),
        "workable": n(jobs=F.array(n(shortcode=id_, title=title, shortlink="https://w", city="Lima", country="Peru", published_on=on), n(shortcode=id_, title=title, shortlink="https://w", city="Oslo", country="", published_on=on), n(shortcode=id_, title=title, shortlink="https://w", city="Lima", country="Peru", published_on=on))),
    }
    doc = F.lit(None)
    for family, one in lists.items():
        doc = F.when(F.col("family") == family, F.to_json(one)).otherwise(doc)
    boards = text_column(o.withColumn("key", F.struct("family", F.lit("firm").alias("board"), F.lit("h.org").alias("host"))), "key", doc).select("key.*", "value")
    return postings.jobs(boards)


def board_links(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    other = F.when(k % 4 != 3, '<a href="https://boards.greenhouse.io/acme">x</a>')
    lateral = F.when(k % 4 < 2, "<a href='//acme.wd5.myworkdayjobs.com/Lateral-us'>x</a>")
    plain = F.when(k % 2 == 0, F.when(k % 4 == 0, '"https://acme.wd5.myworkdayjobs.com/Jobs"'))
    campus = F.when(k % 8 == 0, "<a href='https://acme.wd5.myworkdayjobs.com/Campus'>x</a>")
    pages = text_column(s, "s_suppkey", "<a href='https://example.org/lever.co'>no</a>", other, lateral, plain, campus)
    return postings.board_of_page(pages, "s_suppkey", "value")


def guessed(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", F.array_join(postings.guessed_tokens(F.concat("p_name", F.lit(" & Co Capital"))), ",").alias("tokens"))


def write_changed(spark, sf_dir):
    """Orders by status, written, then again with F's prices changed and other stamps: what is stored, and how many parts were written."""
    o = orders(spark, sf_dir).select("o_orderkey", "o_totalprice", F.lit("a").alias("generated_at"), "o_orderstatus")
    path = fresh(spark, "changed")
    first = sinks.write_changed(o, path, "o_orderstatus")
    again = sinks.write_changed(o.withColumn("generated_at", F.lit("b")), path, "o_orderstatus")
    new = o.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).withColumn("generated_at", F.lit("c"))
    third = sinks.write_changed(new, path, "o_orderstatus")
    return spark.read.schema(o.schema).parquet(path).withColumns({"first": F.lit(first), "again": F.lit(again), "third": F.lit(third)})


def merged(spark, sf_dir):
    o = orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "o_orderstatus")
    old, new = o.filter("o_orderstatus <> 'F'"), o.filter("o_orderstatus <> 'O'").withColumn("o_totalprice", -F.col("o_totalprice"))
    return sinks.merge_write(new, old, ["o_orderkey"])


def sharded(spark, sf_dir):
    path = fresh(spark, "shards")
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(F.col("p_size").cast("string")).alias("symbol"))
    sinks.sharded(p, "symbol").write.partitionBy("shard").parquet(path)
    return spark.read.schema("p_partkey long, symbol string, shard string").parquet(path)


def ledger(spark, sf_dir):
    path = fresh(spark, "ledger")
    entries = orders(spark, sf_dir).select(F.col("o_orderpriority").alias("reason"), F.date_format("day", "yyyy-MM-dd").alias("day"))
    known = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    sinks.append_ledger(entries, path, known)
    sinks.append_ledger(entries.filter("reason = '5-LOW'"), path, known)
    return sinks.ledger_summary(spark.read.schema("reason string, day string").json(path))


def markdown(spark, sf_dir):
    return sinks.markdown_table(table(spark, sf_dir, "nation").withColumn("name", F.concat("n_name", F.lit("|"))), ["n_nationkey"], ["n_nationkey", "name"])


def quarter_cache(spark, sf_dir):
    """A cache by quarter: the running one is read anew, closed ones stay as they were, new ones come in."""
    o = orders(spark, sf_dir).select("o_orderkey", F.col("o_totalprice").alias("price"), F.concat(F.year("day"), F.lit("Q"), F.quarter("day")).alias("quarter"))
    path = fresh(spark, "quarters")
    sinks.refresh_quarters(o.filter("quarter <= '1998Q1'"), path, "1998Q1")
    return sinks.refresh_quarters(o.withColumn("price", -F.col("price")), path, "1998Q1")


def split_positions(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long").alias("manager"), F.col("l_partkey").alias("security"), F.concat(F.year("l_shipdate"), F.lit("Q"), F.quarter("l_shipdate")).alias("quarter"), F.col("l_extendedprice").cast("decimal(18,2)").alias("v"))
    s = li.withColumn("manager", F.col("manager") % 10)  # a few managers, a folder each and year
    return s.groupBy("manager", "security", "quarter").agg(F.sum("v").cast("double").alias("value"))


def index_split(spark, sf_dir):
    index, series = sinks.index_and_years(split_positions(spark, sf_dir), fresh(spark, "split"), "manager", "security", "quarter", "value", 3)
    return series.join(index.select("manager", "security", "quarter", "rank"), ["manager", "security", "quarter"], "left")


def replaced(spark, sf_dir):
    o = orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    root = fresh(spark, "published")
    sinks.publish(o, root)
    sinks.publish(sinks.published(spark, root).withColumn("o_totalprice", -F.col("o_totalprice")), root)
    return sinks.published(spark, root)


MARKERS = ["the", "you", "that", "stand", "ou.", "xyz"]


def health_of_texts(spark, sf_dir):
    """Conversations as documents, turns as units; every seventh turn is blank, every ninth ends in odd characters."""
    t = F.when(F.col("turn") % 7 == 6, " \n ").when(F.col("turn") % 9 == 3, F.concat("text", F.lit("\ufffd\ufffd\nfooter"))).otherwise(F.col("text"))
    return text_health(table(spark, sf_dir, "conversations").select("conv_id", t.alias("t")), "conv_id", "t", MARKERS)


QUERIES = {
    "read_holdings_xml": holdings_xml, "read_reference_rates": reference_rates, "read_json_files": json_files, "read_json_columns": columnar, "read_observations": observations,
    "read_decoded_holders": decoded_holders, "read_dated_csv": dated_csv, "read_form_index": form_index, "read_newest_symbols": newest_symbols, "read_zipped_lines": zipped, "read_sheets": sheets,
    "read_image_blocks": images, "read_sections": sections, "read_feeds": feeds, "read_calendars": calendars, "read_dated_entries": dated, "read_anchors": anchors, "read_sitemaps": sitemaps,
    "read_filing_documents": filing_documents, "read_filing_parties": filing_parties, "read_filing_facts": filing_facts, "read_monthly_series": monthly, "read_job_boards": job_boards,
    "read_board_links": board_links, "text_board_tokens": guessed, "write_changed": write_changed, "write_merged": merged, "write_sharded": sharded, "write_ledger": ledger, "write_markdown": markdown,
    "write_quarter_cache": quarter_cache, "write_index_split": index_split, "write_replaced": replaced, "text_health": health_of_texts,
}

_O = "o AS (SELECT *, CAST(o_orderdate AS DATE) AS day, o_orderkey % 2 = 0 AS even FROM orders)"

SQL = {
    "text_health": f"""WITH u AS (SELECT conv_id, CASE WHEN turn % 7 = 6 THEN ' ' || chr(10) || ' ' WHEN turn % 9 = 3 THEN text || chr(65533) || chr(65533) || chr(10) || 'footer' ELSE coalesce(text, '') END AS t FROM conversations),
      l AS (SELECT conv_id, t, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS l FROM u),
      e AS (SELECT conv_id, max(n) AS most FROM (SELECT conv_id, side, line, count(*) AS n FROM (SELECT conv_id, 0 AS side, l[1] AS line FROM l UNION ALL SELECT conv_id, 1, l[-1] FROM l) WHERE line IS NOT NULL GROUP BY ALL) GROUP BY ALL),
      g AS (SELECT conv_id, count(*) AS n_units, CAST(sum(length(t)) + count(*) - 1 AS BIGINT) AS n_chars, count(*) FILTER (len(l) = 0) AS n_empty, sum(length(t) - length(replace(t, chr(65533), ''))) AS n_r, lower(string_agg(t, chr(10))) AS whole FROM l GROUP BY ALL),
      m AS (SELECT *, CASE WHEN n_units > 2 THEN coalesce(most, 0) / n_units ELSE 0 END AS er, CASE WHEN n_chars > 0 THEN n_r / n_chars ELSE 0 END AS rr,
        CAST({" + ".join(f"contains(whole, '{m}')::INTEGER" for m in MARKERS)} AS INTEGER) AS n_markers FROM g LEFT JOIN e USING (conv_id))
      SELECT conv_id, n_units, n_chars, round(n_empty / n_units, 6) AS empty_ratio, round(er, 6) AS edge_ratio, round(rr, 6) AS replaced_rate, n_markers,
        array_to_string(list_filter([CASE WHEN n_empty / n_units > 0.3 THEN 'empty' END, CASE WHEN er > 0.6 THEN 'edges' END, CASE WHEN rr > 0.001 THEN 'encoding' END, CASE WHEN n_markers < 3 THEN 'markers' END,
        CASE WHEN n_chars < 2000 THEN 'short' END], lambda x: x IS NOT NULL), ',') AS warnings FROM m""",
    "read_holdings_xml": """SELECT upper(p_brand) AS cusip, p_name AS issuer, l_returnflag AS class, CASE WHEN l_linenumber = 1 AND l_linestatus = 'O' THEN 'PUT' ELSE '' END AS put_call,
      CASE WHEN l_returnflag = 'R' THEN 'PRN' ELSE 'SH' END AS type, CASE WHEN l_linenumber = 7 THEN 0 ELSE l_extendedprice END AS value, l_quantity AS shares FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "read_reference_rates": "SELECT DATE '2026-01-02' AS day, 'N' || chr(65 + n_nationkey // 26) || chr(65 + n_nationkey % 26) AS currency, (n_nationkey + 1) / 8 AS rate FROM nation",
    "read_json_files": """SELECT r_name, n_nationkey AS id, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey <> 2
      UNION ALL SELECT 'unreadable', NULL, '{oops' FROM region WHERE r_regionkey = 2""",
    "read_json_columns": """SELECT l_orderkey, l_suppkey AS supplier, CASE WHEN row_number() OVER w < count(*) OVER (PARTITION BY l_orderkey) THEN l_extendedprice END AS price
      FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_extendedprice)""",
    "read_observations": """SELECT l_orderkey AS cik, 'Price' AS tag, strftime(l_shipdate, '%Y-%m-%d') AS "end", l_extendedprice AS val FROM lineitem WHERE l_linenumber <> 3""",
    "read_decoded_holders": """SELECT CAST(l_orderkey AS VARCHAR) AS ticker, '2026Q1' AS quarter, CAST(l_suppkey AS VARCHAR) AS manager_id, l_extendedprice AS value, 'held' AS action,
      CASE WHEN l_linenumber <> 1 THEN l_quantity END AS shares FROM lineitem""",
    "read_dated_csv": f"WITH {_O} SELECT day AS d, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS v FROM o",
    "read_form_index": f"""WITH {_O}, f AS (SELECT *, lpad(CAST(o_custkey + 1 AS VARCHAR), 10, '0') || '-26-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS accession FROM o)
      SELECT CASE o_orderkey % 4 WHEN 0 THEN 'DEFM14A' ELSE 'SC 13D' END AS form, 'BIG CO ' || o_orderkey || ' INC' AS name, o_custkey + 1 AS cik, day,
      'edgar/data/' || (o_custkey + 1) || '/' || accession || '.txt' AS file, accession FROM f WHERE o_orderkey % 4 < 2""",
    "read_newest_symbols": "SELECT lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS cusip, CASE WHEN p_partkey % 2 = 1 THEN 'OLD' ELSE 'NEW' END AS symbol FROM part",
    "read_zipped_lines": """SELECT 'f' || s_suppkey AS path, 'x.txt' AS member, k AS line_no, CASE k WHEN 0 THEN s_suppkey || ';' || s_name ELSE ';' || s_nationkey || ';' END AS cells
      FROM supplier, (VALUES (0), (1)) t(k)""",
    "read_sheets": "SELECT 'f' || s_suppkey AS path, s_name AS country, s_nationkey AS rate, 'Tax rate' AS head FROM supplier",
    "read_image_blocks": """SELECT 'i' || s_suppkey AS path, 0 AS row, k AS col, CASE k WHEN 0 THEN CAST(s_suppkey % 200 AS DOUBLE) ELSE 255 END AS mean, 0::DOUBLE AS sd,
      CASE k WHEN 0 THEN 0::DOUBLE ELSE 1 END AS light FROM supplier, (VALUES (0), (1)) t(k)""",
    "read_sections": """SELECT p_partkey, k, t[k + 1][1] AS tag, t[k + 1][2] AS body FROM (SELECT p_partkey, [['h1', p_name], ['body', 'lead'], ['p', 'one ' || p_brand],
      ['table', 'a ' || p_size], ['li', p_type]] AS t FROM part), (VALUES (0), (1), (2), (3), (4)) x(k)""",
    "read_feeds": f"""WITH {_O} SELECT o_orderkey AS source, CASE k WHEN 0 THEN 'A & ' || o_orderpriority ELSE 'C "D"' END AS title, CASE k WHEN 0 THEN 'http://x/' || o_custkey ELSE '' END AS link,
      CASE WHEN k = 0 AND o_orderkey % 3 <> 0 THEN day + INTERVAL 10 HOUR END AS published FROM o, (VALUES (0), (1)) t(k)""",
    "read_calendars": f"WITH {_O} SELECT 'Order ' || o_orderkey || ', folded' AS summary, day, CASE WHEN NOT even THEN '14:30' END AS time FROM o",
    "read_dated_entries": f"""WITH {_O}, t AS (SELECT o_orderkey, k, CASE k WHEN 0 THEN day ELSE day + 30 END AS day, strftime(day, '%-d %B %Y') AS a, strftime(day + 30, '%B %-d, %Y') AS b FROM o, (VALUES (0), (1)) t(k))
      SELECT o_orderkey, CASE k WHEN 0 THEN a ELSE b END AS raw, CAST(day AS DATE) AS day,
      CASE k WHEN 0 THEN 'The board met on ' || a || left(' to vote; order ' || o_orderkey || ' follows on ', 20) ELSE right(' to vote; order ' || o_orderkey || ' follows on ', 20) || b || ', never on ' END AS context FROM t""",
    "read_anchors": """WITH a AS (SELECT page_id, regexp_extract_all(html, '(?s)<a\\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1) AS u, regexp_extract_all(html, '(?s)<a\\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2) AS t FROM pages),
      e AS (SELECT page_id, i, u[i] AS url, trim(regexp_replace(t[i], '<[^>]*>', '', 'g')) AS title FROM a, LATERAL (SELECT unnest(range(1, len(u) + 1)) AS i))
      SELECT page_id, title, min_by(url, i) AS url FROM e WHERE length(title) BETWEEN 6 AND 140 GROUP BY ALL""",
    "read_sitemaps": """SELECT DISTINCT p AS path FROM (SELECT regexp_extract(url, '^https?://[^/]+(.*)$', 1) AS p FROM pages UNION ALL SELECT '/en/extra' FROM pages) WHERE starts_with(p, '/en/') OR starts_with(p, '/de/')""",
    "read_filing_documents": f"""WITH {_O} SELECT o_orderkey, '1' AS seq, 'Main & ' || o_orderstatus AS description, 'main.htm' AS filename, '/ix?doc=/Archives/' || o_custkey || '/main.htm' AS href, true AS inline, '8-K' AS type,
      nullif(o_orderkey, 0) AS size FROM o UNION ALL SELECT o_orderkey, '2', '', 'ex.htm', '/Archives/' || o_custkey || '/ex.htm', false, 'EX-99', NULL FROM o""",
    "read_filing_parties": f"""WITH {_O} SELECT o_orderkey, 'Acme ' || o_custkey AS name, 'subject' AS role, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik FROM o
      UNION ALL SELECT o_orderkey, 'Holder & Co', 'filer', lpad(CAST(o_orderkey AS VARCHAR), 10, '0') FROM o UNION ALL SELECT o_orderkey, 'Other Inc', 'other', NULL FROM o""",
    "read_filing_facts": f"WITH {_O} SELECT o_orderkey, NULL::VARCHAR AS period, strftime(day, '%Y-%m-%d') AS filed, NULL::VARCHAR AS accepted FROM o",
    "read_monthly_series": f"WITH {_O} SELECT c_name AS series, CAST(date_trunc('month', day) AS DATE) AS d, o_totalprice AS v FROM o JOIN customer ON c_custkey = o_custkey",
    "read_job_boards": f"""WITH {_O}, p AS (SELECT *, o_orderkey % 6 AS f, CAST(o_orderkey AS VARCHAR) AS id, strftime(day, '%Y-%m-%d') AS dd FROM o)
      SELECT ['oracle', 'eightfold', 'smartrecruiters', 'recruitee', 'pinpoint', 'workable'][f + 1] AS family, 'firm' AS board, id, 'Analyst ' || o_orderpriority AS title,
      ['Lima', 'Lima, Oslo', 'London, gb (Remote)', 'Lima, Peru', 'Lima', 'Lima, Peru; Oslo'][f + 1] AS location,
      ['https://h.org/hcmUI/CandidateExperience/en/sites/firm/job/' || id, 'https://h.org/careers/job/' || id, 'https://jobs.smartrecruiters.com/FIRM/' || id, 'https://r', 'https://p', 'https://w'][f + 1] AS url,
      [NULL, 'M', 'F', NULL, 'D', NULL][f + 1] AS department, [dd, dd || 'T00:00:00.000Z', dd, dd || 'T14:53:05Z', NULL, dd][f + 1] AS posted, CASE WHEN f IN (3, 4) THEN dd END AS deadline,
      ['one two', '', '', '', 'a', ''][f + 1] AS description FROM p""",
    "read_board_links": """SELECT s_suppkey, CASE WHEN s_suppkey % 4 < 2 THEN 'workday' ELSE 'greenhouse' END AS family,
      CASE WHEN s_suppkey % 8 = 0 THEN 'https://acme.wd5.myworkdayjobs.com/Campus' WHEN s_suppkey % 4 = 0 THEN 'https://acme.wd5.myworkdayjobs.com/Jobs'
        WHEN s_suppkey % 4 = 1 THEN 'https://acme.wd5.myworkdayjobs.com/Lateral-us' ELSE 'https://boards.greenhouse.io/acme' END AS url FROM supplier WHERE s_suppkey % 4 <> 3""",
    "text_board_tokens": """WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
      SELECT p_partkey, array_to_string(list_distinct_in_order, ',') AS tokens FROM (SELECT p_partkey, [array_to_string(w, '') || 'andcocapital', array_to_string(w, '-') || '-and-co-capital', w[1], array_to_string(w, '') || 'and'] AS list_distinct_in_order FROM w)""",
    "write_changed": """SELECT o_orderkey, o_totalprice + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 'c' ELSE 'a' END AS generated_at, o_orderstatus,
      CAST((SELECT count(DISTINCT o_orderstatus) FROM orders) AS INTEGER) AS first, 0 AS again, 1 AS third FROM orders""",
    "write_merged": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE -o_totalprice END AS o_totalprice, o_orderstatus FROM orders",
    "write_sharded": """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS symbol, CASE WHEN p_size > 25 THEN upper(left(p_name, 1)) ELSE '#' END AS shard FROM part""",
    "write_ledger": "SELECT o_orderpriority AS reason, count(*) * CASE WHEN o_orderpriority = '5-LOW' THEN 2 ELSE 1 END AS n, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders GROUP BY o_orderpriority",
    "write_markdown": r"""SELECT '| n_nationkey | name |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || n_nationkey || ' | ' || n_name || '\| |', chr(10) ORDER BY n_nationkey) AS "table" FROM nation""",
    "write_quarter_cache": f"WITH {_O}, q AS (SELECT o_orderkey, o_totalprice, year(day) || 'Q' || quarter(day) AS quarter FROM o) SELECT o_orderkey, CASE WHEN quarter < '1998Q1' THEN o_totalprice ELSE -o_totalprice END AS price, quarter FROM q",
    "write_index_split": """WITH p AS (SELECT l_suppkey % 10 AS manager, l_partkey AS security, year(l_shipdate) || 'Q' || quarter(l_shipdate) AS quarter, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY ALL),
      r AS (SELECT *, row_number() OVER (PARTITION BY manager, quarter ORDER BY value DESC, security) AS rank FROM p)
      SELECT manager, security, quarter, value, CAST(CASE WHEN rank <= 3 THEN rank END AS INTEGER) AS rank FROM r WHERE (manager, security) IN (SELECT (manager, security) FROM r WHERE rank <= 3)""",
    "write_replaced": "SELECT o_orderkey, -o_totalprice AS o_totalprice FROM orders",
}
