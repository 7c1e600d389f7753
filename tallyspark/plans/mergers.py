"""Queries of merger-text readers over texts printed from the orders' values, and of builders that put decisions together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions import mergers as m
from tallyspark.functions.unicode import nfkc
from tallyspark.operators import ranking, screens
from tallyspark.plans.holdings import table
from tallyspark.plans.records import event_days, orders


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text for each order: its price stated once or twice, an earlier proposal in every third, stock in every fourth."""
    o = orders(spark, sf_dir)
    k = F.col("o_orderkey")
    price = F.concat(F.floor(F.col("price") / 1000).cast("string"), F.lit(".25"))
    day, later = F.date_format("day", "MMMM d, yyyy"), F.date_format(F.date_add("day", 9), "MMMM d, yyyy")
    earlier = F.when(k % 3 == 0, F.lit("In an earlier proposal the buyer named $1.00 per share in cash. In an earlier proposal before it, $1.00 per share in cash was named. ")).otherwise("")
    firm = F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("Each holder has the right to receive $"), price, F.lit(" in cash. The board holds $"), price, F.lit(" per share in cash to be fair. An adviser spoke of $999.00 per share in cash. ")))
    stock = F.when(k % 4 == 0, F.lit("Holders also get 0.5 shares of Acme common stock at an exchange ratio of 0.5000. ")).otherwise("")
    ads = F.when(k % 7 == 0, F.lit("Prices are per ADS, per ADS and per ADS; each ADS represents two ordinary shares. ")).otherwise("")
    dated = F.concat(F.lit("The agreement, dated as of "), day, F.lit(" by and among Acme, Inc., Blue Parent LLC and Merger Sub Corp. It was dated as of "), day, F.lit(", a letter dated "), later, F.lit(" says. The agreement was amended on "), later, F.lit(". "))
    prem = F.concat(F.lit("That is a premium of "), (k % 50 + 1).cast("string"), F.lit("% over the closing price, and a premium of approximately "), (k % 30 + 1).cast("string"), F.lit(".5% over the unaffected price of the stock."))
    return o.select("o_orderkey", "day", "price", F.concat(earlier, firm, stock, ads, dated, prem).alias("body"))


def offers(spark, sf_dir):
    f = filings(spark, sf_dir).select("o_orderkey", m.offer(F.col("body")).alias("x"), m.consideration(F.col("body")).alias("paid_in"))
    return f.select("o_orderkey", "x.price", "x.stated", "x.refused", "paid_in")


def terms(spark, sf_dir):
    b = F.col("body")
    f = filings(spark, sf_dir)
    return f.select("o_orderkey", m.exchange_ratio(b).alias("ratio"), m.ads_ratio(b).alias("ads"), m.offer_unit(b).alias("unit"), m.premium(b).alias("premium"))


def dates(spark, sf_dir):
    return filings(spark, sf_dir).select("o_orderkey", m.agreement_date(F.col("body")).alias("agreed"), m.amendment_date(F.col("body")).alias("amended"))


def named_parties(spark, sf_dir):
    return filings(spark, sf_dir).select("o_orderkey", F.array_join(m.parties(F.col("body")), "|").alias("parties"))


TARGETS = [("Orion Acquisition Corp", 1, "common", "shell"), ("Bright Income Fund", 2, "common", "fund"), ("Acme Tools", 3, "5% Notes due 2030", "class"), ("Acme Tools", 6770, "common", "shell"), ("Acme Tools", 3, "Class A common", None)]


def targets(spark, sf_dir):
    k = (F.col("o_orderkey") % len(TARGETS) + 1).cast("int")
    pick = lambda i: F.element_at(F.array(*[F.lit(x[i]) for x in TARGETS]), k)
    return orders(spark, sf_dir).select("o_orderkey", m.target_problem(pick(0), pick(1), pick(2)).alias("problem"))


def perimeter(spark, sf_dir):
    """An order's items as a fee table whose total leaves out one or two of them."""
    i = table(spark, sf_dir, "lineitem")
    parts = i.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_extendedprice"))), lambda x: F.ceil(x["l_extendedprice"] / 1000) * 1000.0).alias("parts"))
    every = F.aggregate("parts", F.lit(0.0), lambda a, x: a + x)
    total = F.when(F.col("l_orderkey") % 3 == 0, every).when(F.col("l_orderkey") % 3 == 1, every - F.coalesce(F.get("parts", F.lit(1)), F.lit(0.0))).otherwise(every - F.get("parts", F.lit(0)) - F.coalesce(F.get("parts", F.lit(2)), F.lit(0.0)))
    f = parts.withColumn("total", total).withColumn("x", m.fee_perimeter(F.col("total"), F.col("parts"), 1e-9))
    left = F.aggregate(F.coalesce("x.left_out", F.array().cast("array<int>")), F.lit(0.0), lambda a, i: a + F.get("parts", i))
    return f.select("l_orderkey", F.col("x.sum").alias("sum"), (F.abs(F.col("x.sum") - left - F.col("total")) < 0.01).alias("explained"))


def normalised(spark, sf_dir):
    """Full-width and ligature writings of part names come back to the plain ones."""
    p = table(spark, sf_dir, "part")
    wide = F.translate("p_name", "abcdefghijklmnopqrstuvwxyz", "".join(chr(0xFF41 + k) for k in range(26)))
    return p.select("p_partkey", nfkc(F.concat(wide, F.lit(" ﬁx"))).alias("name"))


def daily_post(spark, sf_dir):
    """A day's post: its calendar entry, else its largest deal, else a puzzle."""
    o = orders(spark, sf_dir)
    days = o.select("day").distinct()
    calendar = o.filter("priority = '1-URGENT' and status = 'P'").groupBy("day").agg(F.min("o_orderkey").alias("entry"))
    deals = o.filter("price > 250000").groupBy("day").agg(F.max_by("o_orderkey", F.struct("price", "o_orderkey")).alias("deal"))
    j = days.join(calendar, "day", "left").join(deals, "day", "left")
    kind = F.when(F.col("entry").isNotNull(), "calendar").when(F.col("deal").isNotNull(), "deal").otherwise("puzzle")
    return j.select("day", kind.alias("kind"), F.coalesce("entry", "deal").alias("o_orderkey"))


def transactions(spark, sf_dir):
    """One row a deal: the first stated value, the first filer with a code, and all advisers, in order of filing."""
    i = table(spark, sf_dir, "lineitem")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    value, coded = F.when(F.col("l_quantity") > 10, F.col("l_extendedprice")), F.when(F.col("l_returnflag") != "N", F.col("l_suppkey"))
    first = lambda c: F.min_by(c, F.when(c.isNotNull(), order))
    advisers = F.array_join(F.transform(F.array_sort(F.collect_set("l_suppkey")), lambda x: x.cast("string")), ",")
    return i.groupBy("l_orderkey").agg(first(value).alias("value"), first(coded).alias("target"), advisers.alias("advisers"))


def adviser_cleanup(spark, sf_dir):
    """Advisers of each deal without the removals that were recorded for it."""
    i = table(spark, sf_dir, "lineitem")
    rows = i.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_suppkey")).alias("has"))
    removed = i.filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("gone"))
    j = rows.join(removed, "l_orderkey", "left")
    left = F.array_except("has", F.coalesce("gone", F.array().cast("array<bigint>")))
    return j.select("l_orderkey", F.array_join(F.transform(left, lambda x: x.cast("string")), ",").alias("advisers"))


def experienced(spark, sf_dir):
    """Postings that the campus path refused, taken in turn over segments up to a cap."""
    from tallyspark.operators import ranking

    c = table(spark, sf_dir, "customer")
    campus = c.filter("c_acctbal > 0").select("c_custkey")
    return ranking.round_robin(c.join(campus, "c_custkey", "left_anti"), "c_mktsegment", [F.col("c_acctbal"), F.col("c_custkey")], 60).select("c_custkey", "c_mktsegment", "round")


def catalogue(spark, sf_dir):
    """Facts filled in, fields of judgement blank, an id from the name that no other has."""
    from tallyspark.functions import text
    from tallyspark.operators import dedupe

    p = table(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("base"), F.lower(F.col("p_type")).alias("region"))
    return dedupe.unique_slugs(p, "p_partkey", "base", "region").select("p_partkey", "slug", F.lit(None).cast("string").alias("comment"))


def allowed(spark, sf_dir):
    """Only allowed fields in a fixed order; forbidden ones are named."""
    e = table(spark, sf_dir, "events").select("event_id", F.from_json(F.to_json(F.struct("event_type", "user_id", "value")), "map<string,string>").alias("m"))
    kept, bad = screens.allowed_fields(F.col("m"), ("event_type",), ("user_id", "email"))
    return e.select("event_id", *kept, bad.alias("forbidden"))


def page_choice(spark, sf_dir):
    """Of a customer's judged pages the best card and, among the others, the best detail page."""
    o = orders(spark, sf_dir)
    return ranking.card_and_detail(o, "o_custkey", "o_orderkey", F.floor(F.col("price") / 10000), F.col("priority"))


def editions(spark, sf_dir):
    """Why a turn can't be published: a verb of forecast, too few or too many sentences, a source that isn't listed."""
    from tallyspark.functions import rules

    c = table(spark, sf_dir, "conversations")
    n = F.regexp_count("text", F.lit(r"[.!?](?:\s|$)"))
    return c.select(
        "conv_id", "turn",
        rules.problems([(~F.col("text").rlike(r"(?i)\b(will|expects?|forecasts?)\b"), "forecast"), (n.between(1, 8), "sentences"), (F.col("role").isin("user", "assistant"), "source")]).alias("problems"),
    )


def feed_checks(spark, sf_dir):
    """A published feed read back: forbidden fields, a cap, and cover of what was expected, as rows of checks."""
    e = event_days(spark, sf_dir)
    g = e.agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.count_if(F.col("event_type").isNull()).alias("untyped"))
    checks = F.array(
        F.struct(F.lit("rows").alias("name"), (F.col("n") <= 1_000_000_000).alias("ok")), F.struct(F.lit("users").alias("name"), (F.col("users") > 0).alias("ok")), F.struct(F.lit("typed").alias("name"), (F.col("untyped") == 0).alias("ok"))
    )
    return g.select(F.inline(checks))


QUERIES = {
    "merger_offers": offers, "merger_terms": terms, "merger_dates": dates, "merger_parties": named_parties, "merger_targets": targets, "merger_perimeter": perimeter, "text_normalised": normalised,
    "build_daily_post": daily_post, "build_transactions": transactions, "build_adviser_cleanup": adviser_cleanup, "build_experienced": experienced, "build_catalogue": catalogue,
    "filter_allowed_fields": allowed, "rank_page_choice": page_choice, "rules_editions": editions, "rules_feed_checks": feed_checks,
}

_O = "o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price, o_orderpriority AS priority, o_orderstatus AS status FROM orders)"

SQL = {
    "merger_offers": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN floor(o_totalprice / 1000) + 0.25::DOUBLE END AS price, CAST(CASE WHEN o_orderkey % 5 <> 0 THEN 2 ELSE 0 END AS INTEGER) AS stated,
      o_orderkey % 15 = 0 AS refused, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 3 <> 0 THEN CASE WHEN o_orderkey % 4 = 0 THEN 'stock' ELSE 'none' END WHEN o_orderkey % 4 = 0 THEN 'mixed' ELSE 'cash' END AS paid_in FROM orders""",
    "merger_terms": """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 0.5::DOUBLE END AS ratio, CAST(CASE WHEN o_orderkey % 7 = 0 THEN 2 END AS INTEGER) AS ads,
      CASE WHEN o_orderkey % 7 = 0 THEN CASE WHEN 3 > (CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END) + (CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE 2 END) THEN 'ads' ELSE 'share' END ELSE 'share' END AS unit,
      round((o_orderkey % 30 + 1.5::DOUBLE) / 100, 6) AS premium FROM orders""",
    "merger_dates": f"WITH {_O} SELECT o_orderkey, day AS agreed, day + 9 AS amended FROM o",
    "merger_parties": "SELECT o_orderkey, 'Acme, Inc.|Blue Parent LLC|Merger Sub Corp' AS parties FROM orders",
    "merger_targets": "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'shell' WHEN 1 THEN 'fund' WHEN 2 THEN 'class' WHEN 3 THEN 'shell' END AS problem FROM orders",
    "merger_perimeter": """SELECT l_orderkey, sum(ceil(l_extendedprice / 1000) * 1000.0::DOUBLE) AS sum, true AS explained FROM lineitem GROUP BY 1""",
    "text_normalised": "SELECT p_partkey, p_name || ' fix' AS name FROM part",
    "build_daily_post": f"""WITH {_O}, g AS (SELECT day, min(o_orderkey) FILTER (priority = '1-URGENT' AND status = 'P') AS entry, first(o_orderkey ORDER BY price DESC, o_orderkey DESC) FILTER (price > 250000) AS deal FROM o GROUP BY 1)
      SELECT day, CASE WHEN entry IS NOT NULL THEN 'calendar' WHEN deal IS NOT NULL THEN 'deal' ELSE 'puzzle' END AS kind, coalesce(entry, deal) AS o_orderkey FROM g""",
    "build_transactions": """SELECT l_orderkey, first(l_extendedprice ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) FILTER (l_quantity > 10) AS value, first(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) FILTER (l_returnflag <> 'N') AS target,
      array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS advisers FROM lineitem GROUP BY 1""",
    "build_adviser_cleanup": """SELECT l_orderkey, coalesce(array_to_string(list_sort(list(DISTINCT l_suppkey) FILTER (l_suppkey NOT IN (SELECT x.l_suppkey FROM lineitem x WHERE x.l_orderkey = lineitem.l_orderkey AND x.l_returnflag = 'R'))), ','), '') AS advisers FROM lineitem GROUP BY 1""",
    "build_experienced": """WITH n AS (SELECT c_custkey, c_mktsegment, CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS INTEGER) AS round FROM customer WHERE NOT c_acctbal > 0)
      SELECT * FROM n ORDER BY round, c_mktsegment LIMIT 60""",
    "build_catalogue": """WITH b AS (SELECT p_partkey, replace(p_name, ' ', '-') AS base, lower(p_type) AS region FROM part), f AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) = 1 AS one FROM b),
      k AS (SELECT *, row_number() OVER (PARTITION BY base, region, one ORDER BY p_partkey) AS k FROM f)
      SELECT p_partkey, CASE WHEN one THEN base WHEN k = 1 THEN base || '-' || region ELSE base || '-' || region || '-' || k END AS slug, CAST(NULL AS VARCHAR) AS comment FROM k""",
    "filter_allowed_fields": "SELECT event_id, event_type, CASE WHEN user_id IS NULL THEN '' ELSE 'user_id' END AS forbidden FROM events",
    "rank_page_choice": f"""WITH {_O}, c AS (SELECT o_custkey, first(o_orderkey ORDER BY floor(price / 10000) DESC, o_orderkey) AS card FROM o GROUP BY 1)
      SELECT o_custkey, card, first(o_orderkey ORDER BY priority, floor(price / 10000) DESC, o_orderkey) FILTER (o_orderkey <> card) AS detail FROM o JOIN c USING (o_custkey) GROUP BY 1, 2""",
    "rules_editions": r"""SELECT conv_id, turn, array_to_string(list_filter([CASE WHEN regexp_matches(text, '(?i)\b(will|expects?|forecasts?)\b') THEN 'forecast' END,
      CASE WHEN len(regexp_extract_all(text, '[.!?](?:\s|$)')) NOT BETWEEN 1 AND 8 THEN 'sentences' END, CASE WHEN role NOT IN ('user', 'assistant') THEN 'source' END], lambda x: x IS NOT NULL), ',') AS problems FROM conversations""",
    "rules_feed_checks": "SELECT 'rows' AS name, true AS ok UNION ALL SELECT 'users', true UNION ALL SELECT 'typed', count(*) FILTER (event_type IS NULL) = 0 FROM events",
}
