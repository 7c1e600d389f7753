"""Screens, matches and verdicts on nulls, ties and empty tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import deadlines
from tallyspark.operators import health, matching, screens


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_hosts_under_a_restricted_one_go(spark):
    urls = [(1, "https://a.b.org/x"), (2, "http://B.org:80/"), (3, "https://notb.org"), (4, None), (5, "/relative"), (6, "https://u@c.b.org?q")]
    df = spark.createDataFrame(urls, "id int, url string")
    barred = spark.createDataFrame([("b.ORG",)], "host string")
    assert rows(screens.without_hosts(df, "url", barred), "id") == [(3,), (4,), (5,)]
    assert screens.without_hosts(df, "url", barred.limit(0)).count() == 6


def test_first_copy_of_a_paragraph_stays(spark):
    prose, table = "word " * 40, "a\tb\tc\td " * 40
    docs = [(2, f"{prose}\n \n(a) {prose}"), (1, f"short\n\n{prose}\n\n{table}"), (3, None), (4, "")]
    df = spark.createDataFrame(docs, "id int, text string")
    assert rows(screens.paragraphs(df, "id", "text"), "id", "k") == [(1, 1)]


def test_latest_decision_counts(spark):
    claims = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, f string")
    decisions = spark.createDataFrame([("x", 1, "no"), ("x", 2, "yes"), ("y", 1, "no"), (None, 1, "no")], "f string, at int, verdict string")
    found = screens.not_rejected(claims, decisions, ["f"], [F.desc("at")], F.col("verdict") == "no")
    assert rows(found, "id") == [(1,), (3,)]


def test_unpriced_calls_give_no_cost(spark):
    calls = spark.createDataFrame([("a", 2), ("a", 3), ("b", 1), ("c", None)], "stage string, n int")
    prices = spark.createDataFrame([("a", 5), ("c", 1)], "stage string, price int")
    assert rows(screens.stage_costs(calls, prices, "stage", "n"), "stage", "calls", "cost") == [("a", 2, 25), ("b", 1, None), ("c", 1, None)]


def test_budget_runs_in_order(spark):
    calls = spark.createDataFrame([("k", 1, 4), ("k", 2, 4), ("k", 3, 4), ("m", 1, 9)], "key string, at int, cost int")
    found = screens.admitted(calls, "key", [F.col("at")], "cost", F.lit(8))
    assert rows(found, "key", "at", "spent", "admitted") == [("k", 1, 4, True), ("k", 2, 8, True), ("k", 3, 12, False), ("m", 1, 9, False)]


def test_both_sides_of_equal_times(spark):
    left = spark.createDataFrame([(1, 5, "p"), (1, 5, "q"), (2, 5, "r"), (None, 5, "s")], "key int, at int, id string")
    right = spark.createDataFrame([(1, 5, 50), (1, 3, 30), (1, 9, 90)], "key int, at int, v int")
    found = matching.both_sides(left, right, "key", "at", "v")
    assert rows(found, "id", "before", "after") == [("p", 50, 90), ("q", 50, 90), ("r", None, None), ("s", None, None)]


def test_keys_in_order_of_precedence(spark):
    index = spark.createDataFrame([(7, "A", "u"), (5, "A", "w"), (3, None, "u")], "item int, acc string, url string")
    df = spark.createDataFrame([(1, "A", "u"), (2, None, "u"), (3, "B", None)], "id int, acc string, url string")
    found = matching.first_key_match(df, index, ["acc", "url"], "item")
    assert rows(found, "id", "matched", "matched_by") == [(1, 5, "acc"), (2, 3, "url"), (3, None, None)]


def test_contained_names_have_no_longest_name(spark):
    long = "the very old and quite large iron works company of the far north"
    names = [(long,), ("old and",), ("works of gold",)]
    table = spark.createDataFrame([("iron works", 1), ("a b c d e f g h works of gold", 2), ("so old and so long that nobody reads all of it", 3)], "name string, v int")
    got = {r["name"]: (r["v"], r["how"]) for r in matching.contained_names(spark.createDataFrame(names, "name string"), "name", table, "v").collect()}
    assert got == {long: (1, "contained"), "old and": (3, "contained"), "works of gold": (2, "contained")}


def test_contained_names_are_unique_or_none(spark):
    table = spark.createDataFrame([("Republic of Iron", 1), ("iron", 2), ("Gold Coast", 3), ("coast", 4)], "name string, v int")
    names = [("Iron",), ("iron",), ("the gold  coast",), ("of iron",), ("coastal",), (None,), ("",)]
    found = matching.contained_names(spark.createDataFrame(names, "name string"), "name", table, "v")
    got = {r["name"]: (r["v"], r["how"]) for r in found.collect()}
    # "of iron" holds "iron" and is held by the first entry: two hits tell nothing.
    assert got == {"Iron": (2, "folded"), "iron": (2, "exact"), "the gold  coast": (None, "contained"), "of iron": (None, "contained"), "coastal": (None, None), None: (None, None), "": (None, None)}


def test_amendments(spark):
    filings = [("k", "original", 1, "a"), ("k", "addition", 2, "b"), ("k", "restatement", 3, "c"), ("k", "addition", 3, "d"), ("k", "addition", 4, "e"), ("m", "addition", 1, "f"), ("n", "original", 1, "g"), ("n", "original", 1, "h")]
    df = spark.createDataFrame(filings, "key string, kind string, filed int, accession string")
    assert rows(matching.in_force(df, ["key"]), "accession") == [("c",), ("d",), ("e",), ("h",)]


def test_changes_need_adjacent_periods(spark):
    df = spark.createDataFrame([("k", 1, "a", 2.0), ("k", 2, "b", 3.0), ("k", 4, "c", 1.0), ("k", 5, "c", 1.0), ("m", 1, "a", 0.0), ("m", 2, "b", 1.0)], "key string, p int, filer string, amount double")
    assert rows(matching.filer_changes(df, "key", "p", "filer", "amount"), "key", "p", "before", "filer", "ratio") == [("k", 2, "a", "b", 1.5), ("m", 2, "a", "b", None)]


def test_worst_verdict(spark):
    df = spark.createDataFrame([("ok", "partial"), ("failed", "ok"), ("ok", "odd"), (None, "ok"), ("ok", "ok")], "a string, b string")
    assert [r[0] for r in df.select(health.worst(F.col("a"), F.col("b"))).collect()] == ["partial", "failed", "failed", "failed", "ok"]


def test_health_of_sources(spark):
    checks = [("a", 1, True), ("a", 2, False), ("a", 3, False), ("b", 1, False), ("c", 1, False), ("c", 2, True)]
    df = spark.createDataFrame(checks, "source string, at int, ok boolean")
    assert rows(health.source_health(df, "source", "at", F.col("ok")), "source", "last_success", "failing_since", "failures") == [("a", 1, 2, 2), ("b", None, 1, 1), ("c", 2, None, 0)]


def test_reachable_through_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("d", "e")], "from_state string, to_state string")
    assert rows(health.reachable(edges, "a"), "state") == [("b",), ("c",)]
    assert health.reachable(edges, "e").count() == 0
    chain = spark.range(30).selectExpr("concat('s', id) AS from_state", "concat('s', id + 1) AS to_state")
    assert health.reachable(chain, "s0").count() == 30
    with pytest.raises(RuntimeError, match="still found"):
        health.reachable(chain, "s0", 5)


def test_deadlines(spark):
    today = F.lit("2024-06-01").cast("date")
    texts = [
        "Applications close soon. The deadline is 3 July 2024, at noon.",
        "Closing date: 2023-01-01, then closing 2024-08-09",
        "Apply by July 15, 2024 or call before 2 May 2025",
        "Posted 2024-07-01 on a rolling basis",
        "deadline 2029-01-01",
        None,
        "",
    ]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", deadlines.deadline(F.col("t"), today).alias("d"), deadlines.is_rolling(F.col("t"), today).alias("r"))
    day = datetime.date
    assert [(r["d"], r["r"]) for r in df.orderBy("k").collect()] == [
        (day(2024, 7, 3), False), (day(2024, 8, 9), False), (day(2024, 7, 15), False), (None, True), (None, False), (None, False), (None, False),
    ]


def test_publication_contract_edges(spark):
    from tallyspark.operators import contracts

    today = F.lit("2024-06-01").cast("date")
    stamps = spark.createDataFrame([(datetime.date(2024, 5, 20),), (None,), (datetime.date(2024, 5, 1),)], "d date")
    age = lambda df: tuple(contracts.stamp_checks(df, "d", today, 14).first())
    assert age(stamps) == ("stamp_age", 12.0, True) and age(stamps.filter("d < '2024-05-10'")) == ("stamp_age", 31.0, False) and age(stamps.limit(0)) == ("stamp_age", None, False)
    assert age(stamps.withColumn("d", F.date_add("d", 30)))[2] is False  # the newest lies ahead
    old = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, "b", "y")], "k int, g string, v string")
    new = spark.createDataFrame([(1, "a", None), (2, "c", "x"), (4, "b", "y")], "k int, g string, v string")
    assert {r["g"]: r["ok"] for r in contracts.never_shrinks(old, new, "g").collect()} == {"a": False, "b": True}
    assert sorted(map(tuple, contracts.immutable_changes(old, new, "k", ["g", "v"]).collect())) == [(2, "changed", "g"), (3, "gone", None)]
    assert contracts.immutable_changes(old.limit(0), new, "k", ["g"]).count() == 0
