"""Amended books and the explorer's tables on small rows."""

from tallyspark.operators import amendments

FILED = "manager string, q int, accession string, filed int, kind string"
LINES = "accession string, security string, class string, value double, shares double"


def test_amendments_by_what_they_hold(spark):
    filings = [
        ("a", 1, "a1", 1, "original"), ("a", 1, "a2", 2, "addition"), ("a", 1, "a3", 2, "addition"),
        ("b", 1, "b1", 1, "original"), ("b", 1, "b2", 3, "addition"), ("b", 2, "b3", 1, "addition"),
        ("c", 1, "c1", 1, "original"), ("c", 1, "c2", 2, "restatement"), ("c", 1, "c0", 1, "addition"),
        ("d", 1, "d1", 1, "original"), ("d", 1, "d2", 2, "addition"), ("e", 1, "e1", 1, "original"),
    ]
    lines = [
        ("a1", "x", "com", 100.0, 10.0), ("a1", "y", "com", 50.0, 5.0), ("a2", "x", "COM", 30.0, 3.0), ("a2", "z", "COM", 20.0, 2.0), ("a3", "z", "Com", 5.0, 1.0),
        ("b1", "x", "COM", 100.0, 10.0), ("b1", "y", "COM", 50.0, 5.0), ("b2", "x", "COM", 90.0, 10.0), ("b2", "z", "COM", 40.0, 4.0), ("b3", "x", "COM", 1.0, 1.0),
        ("c1", "x", "COM", 1.0, 1.0), ("c2", "x", "COM", 2.0, 2.0), ("c0", "y", "COM", 7.0, 7.0),
        ("d1", "x", "COM", 60.0, 6.0), ("d1", "y", "COM", 40.0, 4.0), ("d2", "x", "COM", 55.0, 7.0), ("d2", "w", "COM", 41.0, 3.0),
    ]
    book = lambda f, x: sorted((r["manager"], r["q"], r["security"], r["value"], r["shares"], r["outcomes"]) for r in amendments.merged_books(spark.createDataFrame(f, FILED), spark.createDataFrame(x, LINES)).collect())
    assert book(filings, lines) == [
        ("a", 1, "x", 130.0, 13.0, "appended,appended"), ("a", 1, "y", 50.0, 5.0, "appended,appended"), ("a", 1, "z", 25.0, 3.0, "appended,appended"),
        ("b", 1, "x", 90.0, 10.0, "replaced"), ("b", 1, "z", 40.0, 4.0, "replaced"),  # most of it on lines of the same shares
        ("c", 1, "x", 2.0, 2.0, ""),
        ("d", 1, "w", 41.0, 3.0, "replaced"), ("d", 1, "x", 55.0, 7.0, "replaced"),  # as large as the book, mostly on lines it knows
    ]
    assert book([], lines) == [] and book(filings, []) == []


def test_explorer_tables_by_hand(spark):
    from tallyspark.operators import explorer

    own = "manager string, security string, class string, q int, value double, shares double"
    rows = [(m, "x", "COM", q, 10.0 * q, 5.0 + (q if m == "a" else 0)) for m in "abcdef" for q in (1, 2)]
    rows += [(m, "y", "COM", q, 1.0, 1.0) for m in "abcdef" for q in (1, 2, 3, 4)]
    rows += [("a", "x", "COM", 3, 1.0, 1.0), ("g", "z", "COM", 4, 9.0, 3.0), ("g", "y", "COM", 3, 1.0, 1.0), ("a", "w", "COMPUT", 2, 1.0, 1.0), ("a", "w", "COM", 4, 1.0, 1.0)]
    pos = spark.createDataFrame(rows, own)
    symbols = pos.select("security").distinct().selectExpr("security", "upper(security) AS symbol")
    whole = pos.select("manager", "q").distinct().filter("manager <> 'g'")
    none = spark.createDataFrame([], "manager string, symbol string, q int")
    found = explorer.tables(pos, symbols, whole, none.select("symbol", "q"), none, none.select("symbol", "q"), lambda df, name: df)
    by = {(r["symbol"], r["q"]): r for r in found["quarters"].collect()}
    assert (by["X", 2]["holders"], by["X", 2]["added"], by["X", 2]["net_shares"], by["X", 2]["conviction"]) == (6, 1, 1.0, round(1 / 31, 4))
    left = by["X", 3]  # five of six left, one stray holder with hardly a share
    assert (left["exited"], left["holders"], left["listing"], left["ranked"]) == (5, 1, "ended", False)
    assert by["X", 4]["listing"] == "ended" and by["X", 4]["holders"] == 0
    assert by["W", 4]["listing"] == "new-coverage"  # only a right was held before
    z = by["Z", 4]
    assert (z["coverage"], z["new"], z["net_shares"], z["listing"]) == ("listed", 0, None, "new-listing")  # g's books weren't read whole
    assert by["Y", 4]["net_shares"] is None and by["Y", 4]["exited"] == 0
    stock = {r["symbol"]: r for r in found["stocks"].collect()}
    assert stock["X"]["spark"] == "0,0,0,0,0,6,1,0" and stock["X"]["last_q"] == 3 and stock["Y"]["holders"] == 6
    held = {(r["symbol"], r["q"], r["manager"], r["action"]) for r in found["holders"].collect()}
    assert ("X", 3, "b", "exited") in held and ("X", 2, "a", "added") in held and all(q < 4 for _, q, _, _ in held)
    who = {(r["manager"], r["at"]): r for r in found["managers"].collect()}
    assert who["g", "latest"]["positions"] == 1 and who["a", "default"]["new"] == 1
    empty = explorer.tables(pos.limit(0), symbols.limit(0), whole.limit(0), none.select("symbol", "q"), none, none.select("symbol", "q"), lambda df, name: df)
    assert all(t.count() == 0 for t in empty.values())
