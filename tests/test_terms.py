"""Terms of deals against texts written by hand."""

import datetime as dt

import pytest

from tallyspark.operators import terms

PREMIUMS = [
    ("five", "Acme will pay $62.00 per share. An earlier proposal of $50.00 was a premium of 11% to the closing price of $45.00 on May 2, 2024. "
     "The $62.00 offer is a premium of 24.0% to the unaffected closing price of $50.00 on June 3, 2024, a premium of 18% to the 30-day volume-weighted average price and a premium of 5% to the 52-week high of $59.05. "
     "Holders will see a premium of 37% over the closing price of $61.00 on June 28, 2024.", [("average", 0.18, None, "unchecked"), ("close", 0.24, 50.0, "reproduced"), ("high", 0.05, 59.05, "reproduced")]),
    ("percent", "The price represents a 30 percent premium to the last reported sale price of $47.69 on June 3, 2024.", [("close", 0.3, 47.69, "reproduced")]),
    ("above", "At $62.00 holders receive 40% above the undisturbed price.", [("close", 0.4, None, "unchecked")]),
    ("wrong", "It is a premium of 60% to the closing price of $60.00.", [("close", None, None, "contradicted")]),
    ("repeat", "A premium of 20% to the close. It's a premium of 20% to the close. We saw a premium of 21.5% to the close.", [("close", 0.2, None, "unchecked")]),
    ("sixty", "A premium of 9% to the 60-day average price was seen.", []),
    ("none", "No premium was stated in 2024.", []), ("null", None, []),
]


def test_premiums(spark):
    texts = spark.createDataFrame([(d, t) for d, t, _ in PREMIUMS], "deal string, text string")
    offers = spark.createDataFrame([(d, 62.0, dt.date(2024, 6, 4)) for d, _, _ in PREMIUMS], "deal string, offer double, agreed date")
    got = {}
    for r in terms.chosen_premiums(terms.premium_statements(texts, offers)).collect():
        got.setdefault(r["deal"], []).append((r["basis"], r["premium"], r["price"], r["verdict"]))
    assert {d: sorted(v) for d, v in got.items()} == {d: w for d, _, w in PREMIUMS if w}
    assert terms.chosen_premiums(terms.premium_statements(texts.limit(0), offers)).count() == 0


STOCK = [
    ("stated", "At an exchange ratio of 0.5000 holders get an implied value of approximately $25.10 on June 4, 2024. On July 1, 2024 it had an implied value of $30.00.", (0.5, None, 25.1, "stated", None)),
    ("undated", "Each share is valued at about $1,024.50 per share. Holders get 2.5 shares of Blue.", (2.5, None, 1024.5, "stated", None)),
    ("summed", "The value is 0.40 multiplied by $20.00 plus $3.00 in cash for holders.", (None, 3.0, 11.0, "summed", None)),
    ("priced", "Each share is converted into 0.5 shares and $2.00 in cash.", (0.5, 2.0, 22.5, "priced", None)),
    ("late", "The package had an implied value of $30.00 on July 30, 2024, at 0.5 of a share of Blue.", (0.5, None, 20.5, "priced", None)),
    ("ads", "Each ADS represents two shares; the exchange ratio of 0.5000 has an implied value of $9.00.", (0.5, None, None, None, "ads")),
    ("cash", "Holders get $5.00 in cash.", (None, 5.0, None, None, "terms")),
    ("unknown", "An exchange ratio of 0.25 holds.", (0.25, None, None, None, "price")),
]


def test_stock_values(spark):
    texts = spark.createDataFrame([(d, t) for d, t, _ in STOCK], "deal string, text string")
    deals = spark.createDataFrame([(d, "other" if d == "unknown" else "blue", dt.date(2024, 6, 4)) for d, _, _ in STOCK], "deal string, acquirer string, agreed date")
    closes = [("blue", dt.date(2024, 6, 1), 41.0), ("blue", dt.date(2024, 5, 1), 7.0), ("blue", dt.date(2024, 6, 5), 99.0), ("other", dt.date(2024, 5, 1), 9.0)]
    rows = terms.stock_values(texts, deals, spark.createDataFrame(closes, "acquirer string, day date, close double")).collect()
    assert {r["deal"]: (r["ratio"], r["cash"], r["implied"], r["method"], r["unresolved"]) for r in rows} == {d: w for d, _, w in STOCK}
    assert {r["deal"]: r["date"] for r in rows}["priced"] == dt.date(2024, 6, 1)


CLASSES = [
    ("two", "There were 1,000,000 shares of Class A common stock issued and outstanding and 200,000 shares of Class B common stock outstanding. Each share of Class A common stock will be converted into the right to receive $20.00. "
     "Each share of Class B common stock will be converted into $20.00.", (1200000.0, "a,b", "", "considered")),
    ("three", "Class A common stock: 500,000. Class B common stock: 90,000. Class C common stock: 70,000. Each share of Class A common stock shall be exchanged for $10.00 and each share of Class B common stock shall be exchanged for $0.01. "
     "The Class C common stock has no economic rights.", (500000.0, "a", "b,c", "considered")),
    ("votes", "5,000 shares of common stock were outstanding. 5,000 common shares outstanding. 6,000 shares of common stock were outstanding.", (5000.0, "common", "", "all")),
    ("preferred", "There are 800 ordinary shares outstanding and 50 preferred shares outstanding.", (800.0, "ordinary", "", "all")),
    ("named", "There are 800 shares of common stock outstanding and 50 shares of Series B preferred stock outstanding. Each share of common stock is converted into $4.00.", (800.0, "common", "", "considered")),
    ("both", "There are 800 ordinary shares outstanding and 50 shares of Series B preferred stock outstanding. Each share of Series B preferred stock and each share of ordinary stock is exchanged for $4.00.", (850.0, "b,ordinary", "", "considered")),
    ("none", "No shares are told.", None), ("null", None, None),
]


@pytest.mark.parametrize("parted", [False, True])
def test_share_counts(spark, parted):
    rows = [(d, t) for d, t, _ in CLASSES]
    if parted:  # the same in several documents a deal
        rows = [(d, s) for d, t in rows if t for s in terms.sentences(spark.createDataFrame([(d, t)], "deal string, text string")).toPandas()["s"]]
    got = {r["deal"]: tuple(r)[1:] for r in terms.share_counts(spark.createDataFrame(rows, "deal string, text string")).collect()}
    assert got == {d: w for d, _, w in CLASSES if w}


def test_deal_rows_by_precedence(spark):
    from tallyspark.operators import deal_rows

    d = dt.date
    text = "Each holder has the right to receive $20.50 in cash. It is dated as of March 3, 2024. That is a premium of 31% over the closing price."
    docs = [
        ("x", 1, "release", d(2024, 3, 4), "Acme", 1, "Each holder has the right to receive $19.00 in cash."),
        ("x", 2, "agreement", d(2024, 3, 3), " ", 1, text), ("x", 3, "proxy", d(2024, 5, 1), "Acme Tools", 1, "Each holder has the right to receive $21.00 in cash. That is a premium of 29.5% over the closing price."),
        ("x", 4, "proxy", d(2024, 6, 1), "Acme Tools, Inc.", 1, "Nothing new."), ("x", 5, "letter", d(2024, 9, 1), "Other", 1, "Each holder has the right to receive $99.00 in cash."),
        ("y", 6, "release", d(2024, 3, 4), "Bright Income Fund", 2, text), ("z", 7, "release", d(2024, 3, 4), None, None, None),
    ]
    schema = "deal string, doc int, kind string, filed date, name string, sic int, text string"
    money = [("Acme Tools, Inc.", d(2023, 12, 31), 9.0, 2.0), ("Acme Tools, Inc.", d(2022, 12, 31), 8.0, 1.0), ("Acme Tools, Inc.", d(2024, 12, 31), 99.0, 9.0)]
    financials = spark.createDataFrame(money, "target string, period date, revenue double, ebitda double")
    rows = {r["deal"]: r for r in deal_rows.deal_rows(deal_rows.read_documents(spark.createDataFrame(docs, schema)), financials).collect()}
    x = rows["x"]
    assert (x["status"], x["docs"], x["offer"], x["offer_doc"], x["target"], x["target_doc"], x["agreed"], x["premium"], x["premium_doc"]) == ("ok", 5, 20.5, 2, "Acme Tools, Inc.", 4, d(2024, 3, 3), 0.295, 3)
    assert (x["conflicts"], x["revenue"], x["period"]) == ("target", 9.0, d(2023, 12, 31))
    assert rows["y"]["status"] == "rejected" and rows["z"]["status"] == "missing offer,target" and rows["z"]["revenue"] is None
    assert deal_rows.deal_rows(deal_rows.read_documents(spark.createDataFrame([], schema)), financials).count() == 0
