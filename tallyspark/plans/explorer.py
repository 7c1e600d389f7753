"""Queries of amended books and of the explorer's tables: suppliers are managers, brands securities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import amendments, explorer
from tallyspark.operators import books as b
from tallyspark.operators import holdings as h
from tallyspark.plans.holdings import table
from tallyspark.plans.landed import fresh
from tallyspark.sources import sinks


def amended(spark, sf_dir):
    """Books of suppliers by quarter: full filings, restated ones, additions, and whole tables labelled additions."""
    i = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    i = i.join(p, i["l_partkey"] == p["p_partkey"]).select(
        F.col("l_suppkey").alias("manager"), h.quarter_index(F.col("l_shipdate")).alias("q"), F.col("p_brand").alias("security"), F.lower("l_linestatus").alias("class"),
        "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("value"), F.col("l_quantity").cast("decimal(18,2)").alias("shares"),
    )
    m, first = F.col("manager"), F.col("l_linenumber") <= 4
    dec = lambda c: c.cast("decimal(18,2)")
    kinds = [
        ("original", 1, m % 5 == 0, first, F.col("value") * 2, F.col("shares")),  # restated below
        ("restatement", 2, F.lit(True), first, F.col("value"), F.col("shares")),
        ("addition", 1, m % 5 == 1, ~first, F.col("value"), F.col("shares")),  # before any full filing
        ("addition", 3, m % 4 == 1, ~first, F.col("value"), F.col("shares")),
        ("addition", 3, m % 4 == 2, first | (F.col("l_linenumber") == 5), F.when(first, F.col("value")).otherwise(F.floor(F.col("value").cast("double") / 8)), F.col("shares")),
        ("addition", 3, m % 4 == 3, first, F.col("value"), F.col("shares") + 1),
        ("addition", 4, m % 2 == 0, ~first, F.col("value"), F.col("shares")),
    ]
    filings = lines = None
    for n, (kind, filed, who, which, value, shares) in enumerate(kinds):
        of = i.filter(who & which).withColumn("accession", F.concat_ws("-", "manager", "q", F.lit(n)))
        f = of.select("manager", "q", "accession", F.lit(filed).alias("filed"), F.lit(kind).alias("kind")).distinct()
        rows = of.select("accession", "security", F.upper("class").alias("class") if n % 2 else F.col("class"), dec(value).alias("value"), dec(shares).alias("shares"))
        filings, lines = (f, rows) if filings is None else (filings.unionByName(f), lines.unionByName(rows))
    book = amendments.merged_books(filings, lines)
    return book.withColumns({"value": F.col("value").cast("double"), "shares": F.col("shares").cast("double")})


def positions(spark, sf_dir):
    """Books whose securities live for six quarters; of some only rights are held at first, and one manager in ten stays a quarter longer."""
    i = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    i = i.join(p, i["l_partkey"] == p["p_partkey"]).withColumn("q", h.quarter_index(F.col("l_shipdate")))
    stays = (F.col("l_suppkey") % 10 == 1) & F.col("p_brand").endswith("3")
    lived = F.col("q") - stays.cast("int")
    early = (F.col("q") % 6 == 0) & F.col("p_brand").endswith("5")
    return b.class_positions(
        i.select(
            F.col("l_suppkey").alias("manager"), F.concat_ws("/", "p_brand", F.floor(lived / 6).cast("string")).alias("security"), F.col("p_name").alias("issuer"), F.col("l_linestatus").alias("class"),
            F.when((F.col("l_linenumber") == 6) | early, "put").alias("right"), "q", F.col("l_extendedprice").cast("decimal(18,2)").alias("value"), F.col("l_quantity").cast("decimal(18,2)").alias("shares"),
        )
    )


def build(spark, sf_dir):
    keep = explorer.keeper(spark, fresh(spark, "explorer"))
    pos = keep(positions(spark, sf_dir), "positions")
    symbols = pos.select("security").distinct().withColumn("symbol", F.regexp_replace("security", "^BRAND#", ""))
    whole = pos.select("manager", "q").distinct().filter("q < 7985 or q > 7988 or manager % 9 <> 0")
    ends = lambda with_, q: symbols.filter(F.col("symbol").rlike(with_)).select("symbol", F.explode(F.array(*[F.lit(x) for x in q])).alias("q"))
    flagged = explorer.symbol_lines(pos, symbols).filter("manager % 11 = 0 and q % 5 = 0")
    return explorer.tables(pos, symbols, whole, ends("^.2/", (7977, 7983)), flagged, ends("^.4/", (7979, 7992)), keep)


def one(name):
    return lambda spark, sf_dir: build(spark, sf_dir)[name]


def published(spark, sf_dir):
    """Rows of each table of the version that readers see after a second publication."""
    root, found = fresh(spark, "published"), build(spark, sf_dir)
    sinks.publish_together({n: d.limit(0) for n, d in found.items()}, root)
    sinks.publish_together(found, root)
    counts = [sinks.published(spark, root, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in found]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3]).unionByName(counts[4])


QUERIES = {
    "books_amended": amended, "explorer_quarters": one("quarters"), "explorer_stocks": one("stocks"), "explorer_holders": one("holders"), "explorer_managers": one("managers"),
    "explorer_coverage": one("coverage"), "build_explorer": published,
}


_AMENDED = """WITH i AS (SELECT l_suppkey AS manager, year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS q, p_brand AS security, l_linestatus AS class, l_linenumber <= 4 AS first, l_linenumber AS k,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS value, CAST(l_quantity AS DECIMAL(18,2)) AS shares FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT manager, q, security, class, sum(value) AS v, sum(shares) AS s FROM i WHERE first GROUP BY ALL),
x AS (SELECT manager, q, security, class,
    sum(CASE WHEN manager % 4 = 1 AND NOT first THEN value WHEN manager % 4 = 2 AND first THEN value WHEN manager % 4 = 2 AND k = 5 THEN CAST(floor(CAST(value AS DOUBLE) / 8) AS DECIMAL(18,2)) WHEN manager % 4 = 3 AND first THEN value END) AS v,
    sum(CASE WHEN manager % 4 = 1 AND NOT first THEN shares WHEN manager % 4 = 2 AND (first OR k = 5) THEN shares WHEN manager % 4 = 3 AND first THEN shares + 1 END) AS s,
    sum(CASE WHEN manager % 2 = 0 AND NOT first THEN value END) AS v2, sum(CASE WHEN manager % 2 = 0 AND NOT first THEN shares END) AS s2 FROM i GROUP BY ALL),
j AS (SELECT manager, q, security, class, b.v, b.s, x.v AS v1, x.s AS s1, v2, s2 FROM x LEFT JOIN b USING (manager, q, security, class)
    WHERE (manager, q) IN (SELECT (manager, q) FROM b)),
d1 AS (SELECT *, sum(v) OVER w AS bt, coalesce(sum(v1) OVER w, 0) AS et, coalesce(sum(v1) FILTER (v IS NOT NULL) OVER w, 0) AS kn, coalesce(sum(v1) FILTER (s = s1) OVER w, 0) AS sm,
    count(v) OVER w AS nb, count(v1) OVER w AS ne FROM j WINDOW w AS (PARTITION BY manager, q)),
c1 AS (SELECT *, CASE WHEN ne > 0 THEN et > 0 AND (sm > 0.5 * et OR (et >= 0.9 * bt AND kn > 0.5 * et AND ne >= 0.5 * nb)) END AS r1 FROM d1),
a1 AS (SELECT manager, q, security, class, v2, s2, r1, CASE WHEN r1 THEN v1 WHEN v IS NULL THEN v1 ELSE v + coalesce(v1, 0) END AS v, CASE WHEN r1 THEN s1 WHEN s IS NULL THEN s1 ELSE s + coalesce(s1, 0) END AS s FROM c1),
d2 AS (SELECT *, sum(v) OVER w AS bt, coalesce(sum(v2) OVER w, 0) AS et, coalesce(sum(v2) FILTER (v IS NOT NULL) OVER w, 0) AS kn, coalesce(sum(v2) FILTER (s = s2) OVER w, 0) AS sm,
    count(v) OVER w AS nb, count(v2) OVER w AS ne FROM a1 WINDOW w AS (PARTITION BY manager, q)),
c2 AS (SELECT *, CASE WHEN ne > 0 THEN et > 0 AND (sm > 0.5 * et OR (et >= 0.9 * bt AND kn > 0.5 * et AND ne >= 0.5 * nb)) END AS r2 FROM d2),
a2 AS (SELECT *, CASE WHEN r2 THEN v2 WHEN v IS NULL THEN v2 ELSE v + coalesce(v2, 0) END AS value, CASE WHEN r2 THEN s2 WHEN s IS NULL THEN s2 ELSE s + coalesce(s2, 0) END AS shares FROM c2)
SELECT manager, q, security, class, CAST(value AS DOUBLE) AS value, CAST(shares AS DOUBLE) AS shares,
  concat_ws(',', CASE r1 WHEN true THEN 'replaced' WHEN false THEN 'appended' END, CASE r2 WHEN true THEN 'replaced' WHEN false THEN 'appended' END) AS outcomes FROM a2 WHERE value IS NOT NULL"""

_X = """l AS (SELECT l_suppkey AS manager, p_brand, l_linestatus AS class, l_linenumber AS k, CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS v, CAST(l_quantity AS DECIMAL(18,2)) AS s
  FROM lineitem JOIN part ON l_partkey = p_partkey),
p AS (SELECT manager, replace(p_brand, 'Brand#', '') || '/' || ((q - CASE WHEN manager % 10 = 1 AND p_brand LIKE '%3' THEN 1 ELSE 0 END) // 6) AS symbol, class, k = 6 OR (q % 6 = 0 AND p_brand LIKE '%5') AS rt, q,
  CAST(sum(v) AS DOUBLE) AS value, round_even(CAST(sum(s) AS DOUBLE), 0) AS shares FROM l GROUP BY ALL),
f AS (SELECT DISTINCT manager, q, q < 7985 OR q > 7988 OR manager % 9 <> 0 AS whole FROM p),
c AS (SELECT f.manager, f.q, f.whole, b.q IS NOT NULL AS had, coalesce(b.whole, false) AS whole_before FROM f LEFT JOIN f b ON b.manager = f.manager AND b.q = f.q - 1),
v0 AS (SELECT q, count(*) AS filed, count(*) FILTER (had) AS comparable, coalesce(bool_and(whole AND whole_before) FILTER (had), false) AS complete FROM c GROUP BY q),
cov AS (SELECT *, coalesce(q = (SELECT max(q) FROM v0 WHERE filed >= 0.75 * (SELECT count(DISTINCT manager) FROM f)), false) AS is_default FROM v0),
h AS (SELECT manager, symbol, q, sum(value) AS value, sum(shares) AS shares FROM p WHERE NOT rt GROUP BY ALL),
m AS (SELECT h.manager, h.symbol, h.q, h.value, h.shares, b.shares AS prior_shares, c.had AS comparable, true AS holds,
    CASE WHEN NOT c.had THEN 'held' WHEN b.q IS NULL THEN CASE WHEN c.whole_before THEN 'new' ELSE 'unknown' END WHEN h.shares > b.shares THEN 'added' WHEN h.shares < b.shares THEN 'trimmed' ELSE 'held' END AS action
  FROM h JOIN c USING (manager, q) LEFT JOIN h b ON b.manager = h.manager AND b.symbol = h.symbol AND b.q = h.q - 1
  UNION ALL SELECT h.manager, h.symbol, CAST(h.q + 1 AS INTEGER), 0, 0, h.shares, true, false, CASE WHEN f.whole THEN 'exited' ELSE 'unknown' END
  FROM h JOIN f ON f.manager = h.manager AND f.q = h.q + 1 WHERE NOT EXISTS (SELECT 1 FROM h n WHERE n.manager = h.manager AND n.symbol = h.symbol AND n.q = h.q + 1)),
w AS (SELECT *, holds AND manager % 11 = 0 AND q % 5 = 0 AS flag,
    NOT (manager % 11 = 0 AND (q % 5 = 0 AND holds OR (q - 1) % 5 = 0 AND prior_shares IS NOT NULL)) AS counts FROM m),
g AS (SELECT symbol, q, count(*) FILTER (comparable AND holds) AS holders, count(*) FILTER (holds) AS everyone, coalesce(sum(value) FILTER (comparable), 0) AS value, coalesce(sum(shares) FILTER (comparable), 0) AS shares,
    count(*) FILTER (comparable AND action = 'new') AS "new", count(*) FILTER (comparable AND action = 'added') AS added, count(*) FILTER (comparable AND action = 'trimmed') AS trimmed,
    count(*) FILTER (comparable AND action = 'held') AS held, count(*) FILTER (comparable AND action = 'exited') AS exited, count(*) FILTER (comparable AND flag) AS flagged,
    count(*) FILTER (comparable AND counts AND action = 'unknown') > 0 AS unknown, coalesce(sum(shares - coalesce(prior_shares, 0)) FILTER (comparable AND counts), 0) AS net, sum(prior_shares) FILTER (comparable AND counts) AS before FROM w GROUP BY ALL),
fs AS (SELECT symbol, min(q) AS first_security, min(q) FILTER (NOT rt) AS first_symbol FROM p GROUP BY symbol),
g1 AS (SELECT g.*, complete, first_security, first_symbol, coalesce(o.everyone, 0) AS prior_holders, regexp_matches(g.symbol, '^.2/') AND g.q IN (7977, 7983) AS split, regexp_matches(g.symbol, '^.4/') AND g.q IN (7979, 7992) AS re
  FROM g JOIN cov USING (q) JOIN fs USING (symbol) LEFT JOIN g o ON o.symbol = g.symbol AND o.q = g.q - 1),
g2 AS (SELECT * REPLACE (CASE WHEN split OR unknown THEN NULL ELSE net END AS net), CASE WHEN NOT split AND NOT unknown AND complete AND before > 0 THEN round(net / before, 4) END AS conviction FROM g1),
g3 AS (SELECT *, CASE WHEN first_security = q THEN 'new-listing' WHEN first_security = q - 1 AND everyone > 0 AND prior_holders <= greatest(3, everyone // 4) THEN 'recent-listing'
    WHEN first_symbol = q AND first_security < q THEN 'new-coverage' WHEN exited > 0 AND (holders = 0 OR exited >= 5 AND holders <= greatest(1, exited // 10) AND coalesce(conviction <= -0.85, true)) THEN 'ended' WHEN re THEN 'reissued' END AS listing FROM g2 WHERE holders > 0 OR exited > 0),
qs AS (SELECT symbol, q, holders, value, shares, "new", added, trimmed, held, exited, "new" + CASE WHEN split THEN 0 ELSE added END AS buyers, exited + CASE WHEN split THEN 0 ELSE trimmed END AS sellers, "new" + added - trimmed - exited AS breadth, flagged,
  CASE WHEN coalesce(listing, '') <> 'reissued' THEN net END AS net_shares, CASE WHEN coalesce(listing, '') <> 'reissued' THEN conviction END AS conviction, CASE WHEN complete THEN 'complete' ELSE 'listed' END AS coverage, listing, listing IS NULL AS ranked FROM g3),
d AS (SELECT q AS d FROM cov WHERE is_default),
st AS (SELECT s.symbol, last_q, coalesce(holders, 0) AS holders, coalesce(value, 0) AS value, coalesce(shares, 0) AS shares, coalesce("new", 0) AS "new", coalesce(added, 0) AS added, coalesce(trimmed, 0) AS trimmed, coalesce(held, 0) AS held, coalesce(exited, 0) AS exited, listing,
  (SELECT string_agg(coalesce(x.holders, 0), ',' ORDER BY k) FROM range(-7, 1) r(k) LEFT JOIN qs x ON x.symbol = s.symbol AND x.q = (SELECT d FROM d) + k) AS spark
  FROM (SELECT symbol, max(q) AS last_q FROM h GROUP BY symbol) s LEFT JOIN (SELECT * FROM qs WHERE q = (SELECT d FROM d)) x ON x.symbol = s.symbol),
ho AS (SELECT symbol, q, manager, value, shares, action, prior_shares FROM m JOIN cov USING (q) WHERE m.comparable AND complete),
tq AS (SELECT manager, 'latest' AS "at", max(q) AS q FROM f GROUP BY manager UNION ALL SELECT manager, 'default', q FROM f WHERE q = (SELECT d FROM d)),
mg AS (SELECT manager, "at", q, sum(value) AS value, count(*) FILTER (holds) AS positions, round(max(value) / sum(value), 4) AS top, count(*) FILTER (action = 'new') AS "new", count(*) FILTER (action = 'added') AS added,
  count(*) FILTER (action = 'trimmed') AS trimmed, count(*) FILTER (action = 'exited') AS exited FROM tq JOIN m USING (manager, q) GROUP BY ALL)"""

SQL = {
    "books_amended": _AMENDED,
    "explorer_quarters": f"WITH {_X} SELECT * FROM qs",
    "explorer_stocks": f"WITH {_X} SELECT * FROM st",
    "explorer_holders": f"WITH {_X} SELECT * FROM ho",
    "explorer_managers": f"WITH {_X} SELECT * FROM mg",
    "explorer_coverage": f"WITH {_X} SELECT * FROM cov",
    "build_explorer": f"WITH {_X} SELECT 'quarters' AS name, count(*) AS n FROM qs UNION ALL SELECT 'stocks', count(*) FROM st UNION ALL SELECT 'holders', count(*) FROM ho UNION ALL SELECT 'managers', count(*) FROM mg UNION ALL SELECT 'coverage', count(*) FROM cov",
}
