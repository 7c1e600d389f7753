"""Queries of books at the grain of a class: line status is the class, return flags stand for rights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import books as b
from tallyspark.operators import holdings as h
from tallyspark.plans.holdings import table


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    j = i.join(p, i["l_partkey"] == p["p_partkey"])
    return j.select(
        F.col("l_suppkey").alias("manager"),
        F.when(F.col("l_partkey") % 40 == 7, "000000000").otherwise(F.col("p_brand")).alias("security"),
        F.col("p_name").alias("issuer"),
        F.col("l_linestatus").alias("class"),
        F.when(F.col("l_linenumber") == 6, "put").when(F.col("l_linenumber") == 7, "Call").alias("right"),
        h.quarter_index(F.col("l_shipdate")).alias("q"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
        F.col("l_quantity").cast("decimal(18,2)").alias("shares"),
        F.when(F.col("l_suppkey") % 2 == 0, "X0101").otherwise("X0202").alias("schema"),
    )


def positions(spark, sf_dir):
    return b.class_positions(lines(spark, sf_dir))


def moves(spark, sf_dir):
    return b.class_moves(positions(spark, sf_dir))


def pairing(spark, sf_dir):
    pos = positions(spark, sf_dir)
    listed = pos.groupBy("manager", "q").agg((F.count("*") - (F.col("manager") % 3 == 0).cast("int")).alias("listed"))
    return b.paired(pos, listed)


def price_verdicts(spark, sf_dir):
    pos = positions(spark, sf_dir)
    stale = pos.select("manager", "q").distinct().filter("manager % 5 = 0 and q % 2 = 0")
    return b.flagged_prices(pos, stale)


def net(spark, sf_dir):
    m = moves(spark, sf_dir)
    split = m.select("security", "q").distinct().filter("q % 4 = 1 and security like '%1'")
    flagged = m.select("manager", "q").distinct().filter("manager % 7 = 0")
    return b.net_by_symbol(m, split, flagged)


def aggregates(spark, sf_dir):
    symbols = table(spark, sf_dir, "part").select(F.upper("p_brand").alias("security")).distinct().withColumn("symbol", F.substring("security", 1, 7))
    return b.book_aggregates(positions(spark, sf_dir), symbols)


def reissues(spark, sf_dir):
    """Orders' customers stand for managers, clerk months for securities: each security lives for two quarters."""
    o = table(spark, sf_dir, "orders")
    q = h.quarter_index(F.col("o_orderdate"))
    pos = o.select((F.col("o_custkey") % 30).alias("manager"), q.alias("q"), F.concat_ws("-", (F.col("o_custkey") % 3).cast("string"), F.floor(q / 2).cast("string")).alias("security"))
    return b.reissued(pos)


def _moved(operator):
    return lambda spark, sf_dir: operator(moves(spark, sf_dir))


QUERIES = {
    "books_positions": positions, "books_moves": moves, "books_exits": _moved(b.class_exits), "books_turnover": _moved(b.turnover_by_class), "books_pairing": pairing,
    "books_splits": _moved(b.splits), "books_price_verdicts": price_verdicts, "books_net_shares": net, "books_scale": lambda spark, sf_dir: b.declared_scale(lines(spark, sf_dir)),
    "books_name_spans": lambda spark, sf_dir: b.name_spans(positions(spark, sf_dir)), "books_reissued": reissues, "build_book_aggregates": aggregates,
    "build_manager_snapshot": _moved(b.manager_snapshot),
}

_L = """l AS (SELECT l_suppkey AS manager, CASE WHEN l_partkey % 40 = 7 THEN '000000000' ELSE p_brand END AS security, p_name AS issuer, l_linestatus AS class,
  CASE l_linenumber WHEN 6 THEN 'put' WHEN 7 THEN 'Call' END AS rt, CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS q,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS v, CAST(l_quantity AS DECIMAL(18,2)) AS s, CASE WHEN l_suppkey % 2 = 0 THEN 'X0101' ELSE 'X0202' END AS schema
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_P = f"""{_L}, p AS (SELECT manager, upper(security) AS security, upper(coalesce(class, '') || coalesce(rt, '')) AS class, q, first(issuer ORDER BY v DESC, issuer DESC) AS issuer,
  CAST(sum(v) AS DOUBLE) AS value, round_even(CAST(sum(s) AS DOUBLE), 0) AS shares FROM l WHERE trim(security) <> '' AND security <> '000000000' GROUP BY ALL)"""
_M = f"""{_P}, f AS (SELECT DISTINCT manager, q FROM p), m AS (SELECT p.*, b.shares AS prior_shares, b.value AS prior_value, f.q IS NOT NULL AS comparable,
    CASE WHEN f.q IS NULL THEN 'held' WHEN b.shares IS NULL THEN 'new' WHEN p.shares > b.shares THEN 'added' WHEN p.shares < b.shares THEN 'trimmed' ELSE 'held' END AS action,
    g.q IS NOT NULL AND n.q IS NULL AS gone_next
  FROM p LEFT JOIN p b ON b.manager = p.manager AND b.security = p.security AND b.class = p.class AND b.q = p.q - 1
  LEFT JOIN f ON f.manager = p.manager AND f.q = p.q - 1 LEFT JOIN f g ON g.manager = p.manager AND g.q = p.q + 1
  LEFT JOIN p n ON n.manager = p.manager AND n.security = p.security AND n.class = p.class AND n.q = p.q + 1)"""
_FACTORS = "(SELECT unnest([2.0::DOUBLE, 0.5, 3.0, 1/3.0::DOUBLE, 4.0, 0.25, 5.0, 0.2, 10.0, 0.1, 20.0, 0.05]) AS factor)"
_RIGHT = "regexp_matches(class, '(PUT|CALL)$')"

SQL = {
    "books_positions": f"WITH {_P} SELECT * FROM p",
    "books_moves": f"WITH {_M} SELECT * FROM m",
    "books_exits": f"""WITH {_P}, s AS (SELECT manager, security, q, sum(shares) AS s, sum(value) AS v FROM p GROUP BY ALL), f AS (SELECT DISTINCT manager, q FROM p)
      SELECT s.manager, s.security, CAST(s.q + 1 AS INTEGER) AS q, s.s AS prior_shares, s.v AS prior_value FROM s JOIN f ON f.manager = s.manager AND f.q = s.q + 1
      WHERE NOT EXISTS (SELECT 1 FROM s n WHERE n.manager = s.manager AND n.security = s.security AND n.q = s.q + 1)""",
    "books_turnover": f"""WITH {_M}, n AS (SELECT manager, q, sum(CASE action WHEN 'new' THEN value WHEN 'added' THEN (shares - prior_shares) * (value / shares) END) AS bought,
        sum(CASE action WHEN 'trimmed' THEN -(shares - prior_shares) * (value / shares) END) AS sold, sum(value) AS total, bool_or(comparable) AS comparable FROM m GROUP BY ALL),
      c AS (SELECT manager, q + 1 AS q, sum(value) FILTER (gone_next) AS closed, sum(value) AS before FROM m GROUP BY ALL)
      SELECT n.manager, n.q, round(least(coalesce(bought, 0), coalesce(sold, 0) + coalesce(closed, 0)) / ((total + before) / 2), 4) AS turnover FROM n JOIN c USING (manager, q) WHERE comparable""",
    "books_pairing": f"""WITH {_P}, n AS (SELECT manager, q, manager % 3 <> 0 AS whole FROM p GROUP BY manager, q)
      SELECT a.manager, a.q, a.whole AND b.whole AS whole FROM n a JOIN n b ON b.manager = a.manager AND b.q = a.q - 1""",
    "books_splits": f"""WITH {_M}, x AS (SELECT security, q, shares, prior_shares, shares / prior_shares AS ratio, value / shares AS now, prior_value / prior_shares AS before FROM m
        WHERE NOT {_RIGHT} AND prior_shares > 0 AND shares > 0),
      g AS (SELECT security, q, count(*) AS n, median(ratio) AS mid, sum(shares) / sum(prior_shares) AS sums, median(before) / median(now) AS price FROM x GROUP BY ALL),
      c AS (SELECT security, q, factor, count(*) FILTER (abs(ratio - factor) <= 0.03::DOUBLE * factor) AS same, count(*) FILTER (abs(ln(ratio / factor)) <= ln(1.1::DOUBLE)) AS near FROM x, {_FACTORS} GROUP BY ALL),
      t AS (SELECT *, greatest(factor, 1 / factor) AS up, CASE WHEN factor >= 1 THEN price ELSE 1 / price END AS turned FROM g JOIN c USING (security, q)),
      k AS (SELECT *, CASE WHEN same >= 2 AND same >= 0.7::DOUBLE * n THEN 1
        WHEN n >= 5 AND abs(ln(mid / factor)) <= ln(1.15::DOUBLE) AND near >= 0.15::DOUBLE * n AND abs(ln(price / factor)) <= ln(CASE WHEN near >= 0.5::DOUBLE * n THEN 1.4::DOUBLE ELSE 1.2::DOUBLE END) THEN 2
        WHEN n >= 10 AND abs(ln(sums / factor)) <= ln(1.05::DOUBLE) AND up >= 3 AND abs(ln(mid / factor)) <= ln(1.25::DOUBLE) AND near >= 0.15::DOUBLE * n AND turned BETWEEN up / 2.5::DOUBLE AND 1.4::DOUBLE * up THEN 3 END AS k FROM t)
      SELECT security, q, factor, ['holders', 'price', 'aggregate'][k] AS test FROM k WHERE k IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY security, q ORDER BY k, abs(ln(mid / factor)), factor) = 1""",
    "books_price_verdicts": f"""WITH {_P}, x AS (SELECT *, value / shares AS price FROM p WHERE shares > 0), n AS (SELECT *, count(*) OVER (PARTITION BY security, class, q) AS n FROM x),
      o AS (SELECT a.manager, a.security, a.class, a.q, a.price, a.shares, median(b.price) AS others FROM n a JOIN x b ON b.security = a.security AND b.class = a.class AND b.q = a.q AND b.manager <> a.manager WHERE a.n >= 3 GROUP BY ALL)
      SELECT manager, security, class, q, price, others, CASE WHEN manager % 5 = 0 AND q % 2 = 0 THEN 'stale' WHEN 0.5::DOUBLE / shares > 0.05::DOUBLE * others THEN 'rounding'
        WHEN abs(price / others - 1) > 0.05::DOUBLE THEN 'flagged' ELSE 'ok' END AS verdict FROM o""",
    "books_net_shares": f"""WITH {_M}, x AS (SELECT *, q % 4 = 1 AND security LIKE '%1' AS split FROM m WHERE NOT {_RIGHT} AND manager % 7 <> 0)
      SELECT security, q, count(*) FILTER (comparable AND (action = 'new' OR action = 'added' AND NOT split)) AS buyers, count(*) FILTER (comparable AND action = 'trimmed' AND NOT split) AS sellers,
        CASE WHEN bool_or(split) OR bool_or(NOT comparable) THEN NULL ELSE sum(shares - coalesce(prior_shares, 0)) END AS net_shares FROM x GROUP BY ALL""",
    "books_scale": f"""WITH {_L}, r AS (SELECT manager, q, schema, CASE WHEN s > 0 AND rt IS NULL THEN CAST(v AS DOUBLE) / CAST(s AS DOUBLE) END AS r FROM l)
      SELECT manager, q, CAST(CASE WHEN count(r) >= 10 AND median(r) >= 2 THEN 1 WHEN count(r) >= 10 AND median(r) <= 0.5 THEN 1000 WHEN max(schema) >= 'X0202' THEN 1 ELSE 1000 END AS INTEGER) AS scale FROM r GROUP BY ALL""",
    "books_name_spans": f"""WITH {_P}, g AS (SELECT security, issuer, min(q) AS first_q, max(q) AS last_q, count(DISTINCT manager) AS managers FROM p GROUP BY ALL)
      SELECT *, row_number() OVER (PARTITION BY security ORDER BY last_q DESC, issuer) = 1 AS latest FROM g""",
    "books_reissued": """WITH h AS (SELECT DISTINCT o_custkey % 30 AS manager, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS q,
        concat(o_custkey % 3, '-', (year(o_orderdate) * 4 + quarter(o_orderdate) - 1) // 2) AS security FROM orders), f AS (SELECT DISTINCT manager, q FROM h),
      s AS (SELECT security, min(q) AS a, max(q) AS b FROM h GROUP BY 1), g AS (SELECT h.manager, h.security AS old, h.q + 1 AS q FROM h JOIN s USING (security) JOIN f ON f.manager = h.manager AND f.q = h.q + 1 WHERE h.q = s.b),
      n AS (SELECT h.manager, h.security AS new, h.q FROM h JOIN s USING (security) WHERE h.q = s.a), z AS (SELECT old, q, count(*) AS holders FROM g GROUP BY ALL HAVING count(*) >= 3)
      SELECT old, new, CAST(q AS INTEGER) AS q, holders, count(*) AS kept FROM g JOIN n USING (manager, q) JOIN z USING (old, q) GROUP BY ALL HAVING count(*) * 2 >= holders""",
    "build_book_aggregates": f"""WITH {_P}, g AS (SELECT manager, q, substr(security, 1, 7) AS symbol, sum(value) AS value, sum(shares) AS shares, array_to_string(list_sort(list(DISTINCT security)), ',') AS securities
        FROM p WHERE NOT {_RIGHT} GROUP BY ALL) SELECT *, min(q) OVER (PARTITION BY manager, symbol) AS first_q FROM g""",
    "build_manager_snapshot": f"""WITH {_M}, w AS (SELECT *, max(q) OVER (PARTITION BY manager) AS last FROM m), u AS (SELECT manager, security, class, 'held' AS kind, value FROM w WHERE q = last
        UNION ALL SELECT manager, security, class, 'exited', value FROM w WHERE q = last - 1 AND gone_next)
      SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY manager, kind ORDER BY value DESC, security, class) <= CASE kind WHEN 'held' THEN 200 ELSE 100 END""",
}
