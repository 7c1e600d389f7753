"""Queries of deal terms over texts printed from the orders in several wordings, and of what the SQL knows of the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import deal_rows, terms
from tallyspark.plans.holdings import table
from tallyspark.plans.records import orders

def _key():
    return F.col("o_orderkey")


def deals(spark, sf_dir):
    """An order is a deal: its offer, its premium, the price it is over, its day."""
    o = orders(spark, sf_dir).withColumn("offer", F.floor(F.col("price") / 1000) + 1.25).withColumn("p", _key() % 50 + 5)
    o = o.withColumn("over", F.floor(F.col("offer") / (1 + F.col("p") / 100) * 100) / 100)
    return o.select(_key().alias("deal"), "o_orderkey", "day", "offer", "p", "over", (F.col("o_custkey") % 10).alias("acquirer"), F.col("day").alias("agreed"))


def _said(*parts):
    cells = {"O": F.format_string("$%.2f", "offer"), "R": F.format_string("$%.2f", "over"), "P": F.col("p").cast("string"), "D": F.date_format("day", "MMMM d, yyyy"), "L": F.date_format(F.date_add("day", 40), "MMMM d, yyyy")}
    return F.concat(*[cells[x] if x in cells else F.lit(x) for x in parts])


def _one_of(texts):
    n = len(texts)
    out = texts[-1]
    for k, t in enumerate(texts[:-1]):
        out = F.when(_key() % n == k, t).otherwise(out)
    return out


def premiums(spark, sf_dir):
    text = _one_of([
        _said("The offer of ", "O", " is a premium of ", "P", "% to the unaffected closing price of ", "R", " on ", "D", ". An earlier proposal was a premium of 99% to the closing price."),
        _said("Holders receive ", "P", " percent above the last reported sale price of ", "R", " on ", "D", " and a premium of 7% to the 52-week high. The 60-day average stands 3% higher than that."),
        _said("That is a premium of 8", "P", "% to the closing price of ", "R", " on ", "D", "."),
        _said("The price is a premium of ", "P", "% to the undisturbed price, and a premium of 12% to the 30-day volume-weighted average price. A buyer had proposed a 40% premium to the 30-day VWAP."),
        _said("A premium of ", "P", "% to the close is paid. Again: a premium of ", "P", "% to the close. It was a premium of ", "P", ".5% to the close."),
    ])
    d = deals(spark, sf_dir)
    return terms.chosen_premiums(terms.premium_statements(d.select("deal", text.alias("text")), d.select("deal", "offer", "agreed")))


def stock_values(spark, sf_dir):
    text = _one_of([
        _said("Shares at an exchange ratio of 0.5000 have an implied value of approximately ", "O", " on ", "D", ". On ", "L", " they had an implied value of $999.00."),
        _said("A holder gets 0.25 multiplied by ", "R", " plus $3.00 in cash."),
        _said("Each share is converted into 0.75 shares. Holders get $2.00 per share in cash."),
        _said("Each ADS stands for two shares. The exchange ratio of 0.5000 has an aggregate value of ", "O", " per share."),
        _said("Holders are paid ", "O", " in cash."),
        _said("Holders get 1.25 shares of Blue. They are valued at about $1,234.50 per share on ", "L", "."),
    ])
    d = deals(spark, sf_dir)
    closes = d.groupBy("acquirer", "day").agg(F.max("offer").alias("close"))
    return terms.stock_values(d.select("deal", text.alias("text")), d.select("deal", "acquirer", "agreed"), closes)


def share_counts(spark, sf_dir):
    n = F.format_number(_key() + 1000, 0)
    text = _one_of([
        F.concat(F.lit("There were "), n, F.lit(" shares of Class A common stock issued and outstanding and 2,000 shares of Class B common stock outstanding. Each share of Class A common stock will have the right to receive $20.00. Each share of Class B common stock is converted into $0.10.")),
        F.concat(n, F.lit(" common shares were outstanding. "), n, F.lit(" shares of common stock were outstanding. 9,999,999 shares of common stock outstanding. There are 50 preferred shares outstanding.")),
        F.concat(F.lit("Class A common stock: "), n, F.lit(". Class B common stock: 700. Class C common stock: 60. Class C has no economic rights.")),
        F.lit("The number of shares isn't told."),
        F.concat(n, F.lit(" ordinary shares are outstanding and 77 shares of Series B preferred stock outstanding. Each outstanding share of Series B preferred stock and each outstanding share of ordinary stock is exchanged for $4.00.")),
    ])
    return terms.share_counts(deals(spark, sf_dir).select("deal", text.alias("text")))


def rows_of_deals(spark, sf_dir):
    """An order's lines as its deal's documents; suppliers are targets, some of them shells, with their sales by year as financials."""
    i = table(spark, sf_dir, "lineitem")
    n, day = F.col("l_linenumber"), F.col("l_shipdate").cast("date")
    i = i.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("l_suppkey"), F.min(day).alias("day"), F.min("l_quantity").alias("quantity"))
    said = F.concat(
        F.when(F.col("quantity") < 40, F.concat(F.lit("Each holder has the right to receive $"), F.floor("quantity").cast("string"), F.lit(".50 in cash. "))).otherwise(""),
        F.when(n % 2 == 1, F.concat(F.lit("The agreement is dated as of "), F.date_format("day", "MMMM d, yyyy"), F.lit(". "))).otherwise(""),
        F.when(F.col("quantity") > 25, F.concat(F.lit("That is a premium of "), F.floor("quantity").cast("string"), F.lit("% over the closing price."))).otherwise(""),
    )
    kind = F.element_at(F.array(*[F.lit(k) for k in ("release", "proxy", "agreement", "proxy", "letter", "agreement", "release")]), n)
    name = F.when(n == 5, "").when(F.col("l_suppkey") % 50 == 7, F.concat(F.lit("Orion "), "l_suppkey", F.lit(" Acquisition Corp"))).otherwise(F.concat(F.lit("Acme "), F.col("l_suppkey") % 10))
    docs = i.select(F.col("l_orderkey").alias("deal"), n.alias("doc"), kind.alias("kind"), F.col("day").alias("filed"), name.alias("name"), F.lit(3500).alias("sic"), said.alias("text"))
    years = table(spark, sf_dir, "lineitem").groupBy(F.concat(F.lit("Acme "), F.col("l_suppkey") % 10).alias("target"), F.last_day(F.make_date(F.year("l_shipdate"), F.lit(12), F.lit(1))).alias("period"))
    financials = years.agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("ebitda"))
    return deal_rows.deal_rows(deal_rows.read_documents(docs), financials)


QUERIES = {"build_deal_rows": rows_of_deals, "terms_premiums": premiums, "terms_stock_values": stock_values, "terms_share_counts": share_counts}

_D = """d AS (SELECT o_orderkey AS deal, CAST(o_orderdate AS DATE) AS day, floor(o_totalprice / 1000) + 1.25 AS offer, o_orderkey % 50 + 5 AS p, o_custkey % 10 AS acquirer FROM orders),
e AS (SELECT *, floor(offer / (1 + p / 100.0::DOUBLE) * 100) / 100 AS over FROM d)"""

_CHOICE = "arg_max(struct_pack(v := {v}, doc := doc, kind := kind), struct_pack(a := -list_position([{kinds}], kind), b := filed, c := doc)) FILTER ({v} IS NOT NULL AND kind IN ({kinds})) AS {f}"
_KINDS = {f: ", ".join(f"'{k}'" for k in kinds) for f, kinds in deal_rows.PRECEDENCE.items()}

SQL = {
    "build_deal_rows": f"""WITH i AS (SELECT l_orderkey AS deal, l_linenumber AS doc, min(l_suppkey) AS s, min(CAST(l_shipdate AS DATE)) AS filed, CAST(floor(min(l_quantity)) AS BIGINT) AS q FROM lineitem GROUP BY ALL),
      d AS (SELECT deal, doc, ['release', 'proxy', 'agreement', 'proxy', 'letter', 'agreement', 'release'][doc] AS kind, filed, CASE WHEN q < 40 THEN q + 0.5::DOUBLE END AS offer, CASE WHEN doc % 2 = 1 THEN filed END AS agreed,
        CASE WHEN doc = 5 THEN NULL WHEN s % 50 = 7 THEN 'Orion ' || s || ' Acquisition Corp' ELSE 'Acme ' || s % 10 END AS target, CASE WHEN q > 25 THEN round(q / 100.0::DOUBLE, 6) END AS premium, doc <> 5 AND s % 50 = 7 AS no FROM i),
      g AS (SELECT deal, count(*) AS docs, bool_or(no) AS no, {", ".join(_CHOICE.format(v=f, f="b_" + f, kinds=k) for f, k in _KINDS.items())} FROM d GROUP BY deal),
      c AS (SELECT g.deal, {", ".join(f"CASE WHEN count(DISTINCT d.{f}) FILTER (d.kind = g.b_{f}.kind) > 1 THEN '{f}' END AS c_{f}" for f in _KINDS)} FROM g JOIN d USING (deal) GROUP BY ALL),
      y AS (SELECT 'Acme ' || l_suppkey % 10 AS target, make_date(year(l_shipdate), 12, 31) AS period, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS ebitda FROM lineitem GROUP BY ALL),
      x AS (SELECT g.deal, arg_max(struct_pack(revenue := revenue, ebitda := ebitda, period := period), period) AS x FROM g JOIN y ON y.target = g.b_target.v AND g.b_agreed.v - y.period BETWEEN 1 AND 550 GROUP BY g.deal)
      SELECT g.deal, CASE WHEN no THEN 'rejected' WHEN b_offer IS NOT NULL AND b_target IS NOT NULL THEN 'ok' ELSE 'missing ' || concat_ws(',', CASE WHEN b_offer IS NULL THEN 'offer' END, CASE WHEN b_target IS NULL THEN 'target' END) END AS status, docs,
        {", ".join(f"b_{f}.v AS {f}, b_{f}.doc AS {f}_doc" for f in _KINDS)}, concat_ws(',', {", ".join(f"c_{f}" for f in _KINDS)}) AS conflicts, x.revenue, x.ebitda, x.period FROM g LEFT JOIN c ON c.deal = g.deal LEFT JOIN x ON x.deal = g.deal""",
    "terms_premiums": f"""WITH {_D}
      SELECT deal, 'close' AS basis, round(p / 100.0::DOUBLE, 6) AS premium, over AS price, day AS date, 'reproduced' AS verdict, 2 AS stated, 0 AS refused FROM e WHERE deal % 5 = 0
      UNION ALL SELECT deal, 'close', round(p / 100.0::DOUBLE, 6), over, day, 'reproduced', 1, 0 FROM e WHERE deal % 5 = 1
      UNION ALL SELECT deal, 'high', 0.07, NULL, day, 'unchecked', 1, 0 FROM e WHERE deal % 5 = 1
      UNION ALL SELECT deal, 'close', NULL, NULL, NULL, 'contradicted', 1, 1 FROM e WHERE deal % 5 = 2
      UNION ALL SELECT deal, 'close', round(p / 100.0::DOUBLE, 6), NULL, NULL, 'unchecked', 1, 0 FROM e WHERE deal % 5 = 3
      UNION ALL SELECT deal, 'average', 0.12, NULL, NULL, 'unchecked', 2, 0 FROM e WHERE deal % 5 = 3
      UNION ALL SELECT deal, 'close', round(p / 100.0::DOUBLE, 6), NULL, NULL, 'unchecked', 3, 0 FROM e WHERE deal % 5 = 4""",
    "terms_stock_values": f"""WITH {_D}, c AS (SELECT acquirer, day, max(offer) AS close FROM e GROUP BY ALL),
      j AS (SELECT e.*, x.close, x.day AS on_day, deal % 6 AS k FROM e ASOF LEFT JOIN c x ON x.acquirer = e.acquirer AND e.day >= x.day)
      SELECT deal, [0.5, NULL, 0.75, 0.5, NULL, 1.25][k + 1] AS ratio, [NULL, 3.0, 2.0, NULL, offer, NULL][k + 1] AS cash,
        round([offer, 0.25 * over + 3, 0.75 * close + 2, NULL, NULL, 1.25 * close][k + 1], 4) AS implied, ['stated', 'summed', 'priced', NULL, NULL, 'priced'][k + 1] AS method,
        CASE k WHEN 0 THEN day WHEN 2 THEN on_day WHEN 5 THEN on_day END AS date, [NULL, NULL, NULL, 'ads', 'terms', NULL][k + 1] AS unresolved FROM j""",
    "terms_share_counts": f"""WITH {_D}, n AS (SELECT deal, CAST(deal + 1000 AS DOUBLE) AS n, deal % 5 AS k FROM e WHERE deal % 5 <> 3)
      SELECT deal, [n, n, n + 700, NULL, n + 77][k + 1] AS shares, ['a', 'common', 'a,b', NULL, 'b,ordinary'][k + 1] AS classes, ['b', '', 'c', NULL, ''][k + 1] AS excluded,
        ['considered', 'all', 'all', NULL, 'considered'][k + 1] AS basis FROM n""",
}
