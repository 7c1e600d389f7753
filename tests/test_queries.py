"""Every registered query against its SQL, and the few without against plain Python."""

import pytest

from tallyspark.plans import registry
from tests.oracle import connect, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    got = spark_rows(registry.queries()[name](spark, SF))
    assert got == duck_rows(duck, registry.oracle_sql()[name])


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(registry.queries()) <= set(e.queries())


def test_first_fit_groups(spark):
    from tallyspark.operators.dedupe import first_fit_groups

    rows = spark.createDataFrame([(1, k, d) for k, d in enumerate([0, 5, 6, 7, 13, 12, 30])], "key int, item int, at int")
    got = {r["item"]: r["group"] for r in first_fit_groups(rows, "key", "item", "at", 6).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 1, 5: 1, 4: 1, 6: 2}


def test_kept_titles_is_the_greedy_choice(spark):
    from tallyspark.operators.dedupe import keep_first_alike

    items = spark.createDataFrame([(k,) for k in range(8)], "id int")
    pairs = [(0, 1), (1, 2), (2, 3), (3, 4), (1, 5), (5, 6), (6, 7)]
    kept = []
    for k in range(8):
        if not any((a, k) in pairs for a in kept):
            kept.append(k)
    df = spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "a int, b int, similarity double")
    assert sorted(r["id"] for r in keep_first_alike(items, df, "id").collect()) == kept


def test_round_robin_and_pick_three_on_ties(spark):
    from pyspark.sql import functions as F

    from tallyspark.operators import ranking

    rows = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 3, 5), ("c", 4, 1)], "g string, k int, d int")
    got = [r["k"] for r in ranking.round_robin(rows, "g", [F.desc("d"), F.col("k")], 4).collect()]
    assert got == [1, 3, 4, 2]
    picks = {r["pick"]: r["k"] for r in ranking.pick_three(rows.withColumn("v", F.col("k")), "k", "d", "v", "g").collect()}
    assert picks == {1: 1, 2: 4, 3: 3}


def test_overlap_in_small_blocks(spark):
    from tallyspark.operators.holdings import overlap

    books = [("a", "x", 1, 60.0), ("a", "y", 1, 40.0), ("b", "x", 1, 10.0), ("b", "y", 1, 30.0), ("c", "y", 1, 5.0), ("d", "z", 1, 5.0), ("e", "x", 2, 5.0), (None, "x", 1, 5.0), ("f", None, 1, 5.0), ("g", "x", 1, 1.0)]
    pos = spark.createDataFrame(books, "manager string, security string, q int, value double")
    shares = {}
    for m, _, q, v in books:
        shares[m, q] = shares.get((m, q), 0) + v
    weight = {(m, q, s): v / shares[m, q] for m, s, q, v in books if m and s}
    want = {}
    for m, q, s in weight:
        for n, p, t in weight:
            if m != n and q == p and s == t:
                one = want.setdefault((m, q, n), [0.0, 0])
                one[0] += min(weight[m, q, s], weight[n, p, t])
                one[1] += 1
    for block in (1, 2, 100):
        got = {(r["manager"], r["q"], r["peer"]): (r["overlap"], r["shared"]) for r in overlap(pos, 25, block).collect()}
        assert got == {k: (round(v, 6), n) for k, (v, n) in want.items()}
        top = {(r["manager"], r["peer"]) for r in overlap(pos, 1, block).collect()}
        assert top == {(m, min((-round(v, 6), n) for (k, _, n), (v, _) in want.items() if k == m)[1]) for m, _, _ in want}
    assert overlap(pos.limit(0)).count() == 0


def test_kept_titles_of_a_long_chain(spark):
    from tallyspark.operators.dedupe import keep_first_alike

    items = spark.range(60).toDF("id")
    pairs = spark.range(59).selectExpr("id AS a", "id + 1 AS b")
    assert sorted(r["id"] for r in keep_first_alike(items, pairs, "id").collect()) == list(range(0, 60, 2))


def test_effective_on_of_repeated_rows(spark):
    from tallyspark.operators.joins import effective_on

    rows = spark.createDataFrame([("a", 5), ("a", 5), ("b", 5), ("c", 1)], "k string, d int")
    entries = [("a", 1, 9, "x"), ("b", 1, None, "y"), ("b", 4, 6, "z"), ("c", 2, 3, "w")]
    table = spark.createDataFrame([*entries, entries[0]], "k string, valid_from int, valid_to int, value string")
    got = sorted((r["k"], r["value"], r["status"]) for r in effective_on(rows, table, "k", "d").collect())
    assert got == [("a", "x", "resolved"), ("a", "x", "resolved"), ("b", None, "ambiguous"), ("c", None, "unresolved")]


def test_first_fit_groups_go_on_after_a_gap(spark):
    from tallyspark.operators.dedupe import first_fit_groups

    rows = spark.createDataFrame([(1, k, d) for k, d in enumerate([0, 4, 7, 30, 35, 37, 90])], "key int, item int, at int")
    got = {r["item"]: r["group"] for r in first_fit_groups(rows, "key", "item", "at", 6).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 2, 4: 2, 5: 3, 6: 4}


def test_visible_text_and_links(spark):
    from tallyspark.functions import text

    html = "<p>A&#233;b &#x41;&eacute;&amp;lt; &nbsp; end</p><A class=x HREF='/one'>1</A><a href=/two>2</a>"
    row = spark.createDataFrame([(html,)], "h string").select(text.visible_text("h").alias("t"), text.links("h").alias("l")).first()
    assert row["t"] == "Aéb Aé&lt; end 1 2" and row["l"] == ["/one", "/two"]


def test_tables_of_expected_amounts_and_dates(spark):
    from pyspark.sql import functions as F

    from tallyspark.functions import dates, text

    amounts = [("worth $1.5 billion", 1.5), ("GBP 250 million deal", 0.25), ("€3bn, then $9bn", 3.0), ("EUR 40m", 0.04), ("no figure", None)]
    got = spark.createDataFrame([(a,) for a, _ in amounts], "t string").select(text.amount_billions(F.col("t"))).collect()
    assert [None if r[0] is None else round(r[0], 6) for r in got] == [b for _, b in amounts]
    days = [("2024-02-29", "2024-02-29"), ("3 March 2021", "2021-03-03"), ("March 3, 2021", "2021-03-03"), ("31/12/2020", "2020-12-31"), ("soon", None)]
    got = spark.createDataFrame([(a,) for a, _ in days], "t string").select(dates.tolerant_date(F.col("t"))).collect()
    assert [None if r[0] is None else str(r[0]) for r in got] == [b for _, b in days]


def test_reference_row_by_hand(spark):
    import datetime as dt

    from tallyspark.operators import reference_rows

    seen = "symbol string, i int, price double, grade string, seconds int, trades long, late long, dollars double"
    one = lambda s, i, p, g="H": (s, i, p, g, 60, 200, 20, 2e6)
    rows = [one("rise", i, 10.0 + i) for i in range(12)]
    rows += [one("split", i, 20.0 if i < 6 else 10.0) for i in range(12)]
    rows += [one("bound", i, 5.0 + i % 3) for i in range(12)]
    rows += [one("gone", i, 1.0) for i in range(9)] + [one("jump", i, 1.0 if i < 11 else 3.0, "U") for i in range(12)]
    rows += [one("gaps", i, float(i)) for i in (1, 2, 8, 11)] + [one("late", 12, 1.0)]
    actions = [("split", 6, "split", 0.5), ("bound", 9, "other", None), ("jump", 11, "ordinary", None), ("none", 3, "split", 2.0)]
    calendar = [dt.date(2024, 1, 1) + dt.timedelta(k) for k in range(12)]
    changes = {"1m": 2, "3m": 4}
    found = reference_rows.reference_rows(spark.createDataFrame(rows, seen), spark.createDataFrame(actions, "symbol string, i int, kind string, ratio double"), calendar, 10, changes)
    got = {r["symbol"]: r for r in found.collect()}
    assert set(got) == {"rise", "split", "bound", "gone", "jump", "gaps"}
    r = got["rise"]
    assert (r["status"], r["stats_status"], r["price"], r["base_1m"], r["base_3m_date"], r["high"], r["low"], r["low_date"], r["drawdown_peak"]) == ("ok", "ok", 21.0, 19.0, 7, 21.0, 12.0, 2, None)
    assert [(w["date"], w["price"]) for w in r["weekly"]] == [(6, 16.0), (11, 21.0)]
    r = got["split"]
    assert (r["price"], r["high"], r["low"], r["vol_year"], r["splits"][0]["ratio"], r["valid_from"]) == (10.0, 10.0, 10.0, 0.0, 0.5, None)
    r = got["bound"]
    assert (r["valid_from"], r["stats_status"], r["base_1m"], r["base_3m"], r["high"], r["vol_short"]) == (9, "history", 5.0, None, None, None)
    assert [w["date"] for w in r["weekly"]] == [11] and r["corporate_actions"][0]["kind"] == "other"
    assert (got["gone"]["status"], got["gone"]["lag"], got["gone"]["price"], got["gone"]["weekly"]) == ("stale", 3, None, None)
    assert (got["jump"]["status"], got["jump"]["price"]) == ("discontinuity", None)
    r = got["gaps"]
    assert (r["coverage"], r["base_1m"], r["base_3m"], r["stats_status"]) == (0.3, None, None, "history")
    assert found.limit(0).count() == 0 and reference_rows.reference_rows(spark.createDataFrame([], seen), spark.createDataFrame(actions, "symbol string, i int, kind string, ratio double"), calendar, 10, changes).count() == 0


def test_deals_by_complete_link(spark):
    import datetime as dt

    from tallyspark.operators import deals

    d = lambda m, k=1, y=2022: dt.date(y, m, k)
    rows = [
        ("t", 1, d(1), d(1), None, None, "acme", None), ("t", 2, d(3), d(3), None, None, None, None), ("t", 3, d(4), d(4), None, None, "blue", None),
        ("t", 4, d(8, 1), d(8), None, None, "acme", None),  # within half a year of 2 and 3, not of 1
        ("t", 5, d(5), d(5), None, None, "blue", ["acme"]),
        ("u", 6, d(8), d(8), d(8, 4), None, "robo", None), ("u", 7, d(7, 24, 2023), d(7), d(7, 24, 2023), d(8, 5), "robo", None), ("u", 8, d(7, 30, 2023), d(7), d(7, 30, 2023), None, "robo", None),
        ("v", 9, None, d(1), None, None, None, None), ("v", 10, None, d(1), None, None, None, None), (None, 11, d(1), d(1), None, None, None, None),
        ("w", 12, d(1), d(1), d(1), None, None, None), ("w", 13, d(1, 20), d(1), d(1, 20), None, None, None),
    ]
    schema = "target string, reading int, day date, filed date, agreed date, original date, buyer string, parties array<string>"
    found = {}
    for r in deals.deal_groups(spark.createDataFrame(rows, schema)).collect():
        found.setdefault(r["deal"], set()).add(r["reading"])
    assert found == {
        "t:2022-01-01": {1, 2, 5}, "t:2022-04-01": {3}, "t:2022-08-01": {4}, "u:2022-08-01": {6, 7}, "u:2023-07-30": {8}, "v:9": {9}, "v:10": {10}, "w:2022-01-01": {12}, "w:2022-01-20": {13},
    }
    assert deals.deal_groups(spark.createDataFrame([], schema)).count() == 0


def test_breaks_replayed_in_order(spark):
    import random

    from tallyspark.operators import market

    rng, rows, want = random.Random(8), [], {}
    for symbol in range(200):
        last = before = None
        traded = False
        for seq in range(rng.randrange(1, 14)):
            ids = [r[2] for r in rows if r[0] == symbol and r[3] == "trade"]
            if rng.random() < 0.55 or not ids:
                kind = "trade" if rng.random() < 0.9 else "break"
            else:
                kind = "break"
            if kind == "trade":
                rows.append((symbol, 0, seq, "trade", float(seq), None))
                last, before, traded = seq, last, True
                continue
            ref = rng.choice(ids[-3:]) if ids else 99
            rows.append((symbol, 0, seq, "break", None, ref))
            if ref == last:
                last, before = before, None
            elif ref == before:
                before = None
        if traded:
            want[symbol] = None if last is None else float(last)
    rows.append((500, 0, 1, "note", 1.0, None))
    got = market.replayed(spark.createDataFrame(rows, "symbol int, i int, seq long, kind string, price double, ref long"))
    assert {r["symbol"]: r["price"] for r in got.collect()} == want and None in want.values()
