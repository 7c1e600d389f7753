"""Holdings queries: suppliers stand for managers, brands for securities, ship quarters for report quarters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import holdings as h
from tallyspark.operators import joins


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
    brands = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = items.join(brands, items["l_partkey"] == brands["p_partkey"])
    return j.select(
        F.col("l_suppkey").alias("manager"),
        F.col("p_brand").alias("security"),
        h.quarter_index(F.col("l_shipdate")).alias("q"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
        F.col("l_quantity").cast("decimal(18,2)").alias("shares"),
    )


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.positions(lines(spark, sf_dir))


def _on_book(operator):
    return lambda spark, sf_dir: operator(book(spark, sf_dir))


SIZE_RANGES = [("small", 1, 15), ("middle", 10, 35), ("large", 30, 50)]


def sector_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value by the first range that holds a part's size, with a total: grouping sets over sector."""
    parts = table(spark, sf_dir, "part")
    ranges = spark.createDataFrame([(k, a, b, i) for i, (k, a, b) in enumerate(SIZE_RANGES)], "key string, low int, high int, rank int")
    sectors = joins.first_range(parts, "p_size", ranges).select("p_partkey", F.col("key").alias("sector"))
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("v"))
    j = items.join(sectors, items["l_partkey"] == sectors["p_partkey"])
    g = j.rollup("sector").agg(F.sum("v").cast("double").alias("value"), F.countDistinct("l_suppkey").alias("holders"), F.grouping("sector").cast("int").alias("is_total"))
    return g


def theme_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct managers by theme; a part counts in every theme whose range holds it."""
    parts = table(spark, sf_dir, "part")
    ranges = spark.createDataFrame([(k, a, b, i) for i, (k, a, b) in enumerate(SIZE_RANGES)], "key string, low int, high int, rank int")
    themes = joins.all_ranges(parts, "p_size", ranges).select("p_partkey", F.col("key").alias("theme"))
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    j = items.join(themes, items["l_partkey"] == themes["p_partkey"])
    return j.groupBy("theme").agg(F.countDistinct("l_suppkey").alias("holders"), F.countDistinct("l_partkey").alias("parts"))


def book_category_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three heaviest price classes of each book; a brand counts in every type it sells."""
    categories = table(spark, sf_dir, "part").select(F.upper("p_brand").alias("security"), F.col("p_type").alias("category")).distinct()
    return h.category_weights(book(spark, sf_dir), categories)


def overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are dealt by manager and quarter at once: their sums and weights need no second shuffle."""
    return h.overlap(h.positions(lines(spark, sf_dir).repartition("manager", "q")))


def scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.value_scale(lines(spark, sf_dir))


QUERIES = {
    "holdings_actions": _on_book(h.actions),
    "holdings_positions": book,
    "holdings_value_scale": scale,
    "holdings_book_metrics": _on_book(h.book_metrics),
    "holdings_exits": _on_book(h.exits),
    "holdings_action_counts": _on_book(h.action_counts),
    "holdings_turnover": _on_book(h.turnover),
    "holdings_consensus_price": _on_book(h.consensus_price),
    "holdings_price_flags": _on_book(h.price_flags),
    "holdings_stale_valuation": _on_book(h.stale_valuation),
    "holdings_split_by_holders": _on_book(h.split_by_holders),
    "holdings_split_by_price": _on_book(h.split_by_price),
    "holdings_net_shares": _on_book(h.net_shares),
    "holdings_coverage": _on_book(h.coverage),
    "holdings_overlap": overlap,
    "holdings_first_last_seen": _on_book(h.first_last_seen),
    "holdings_spark_line": _on_book(h.holders_spark),
    "holdings_listing_status": _on_book(h.listing_status),
    "holdings_sector_rollup": sector_rollup,
    "holdings_theme_holders": theme_holders,
    "holdings_category_weights": book_category_weights,
}

_LINES = """lines AS (
  SELECT l_suppkey AS manager, upper(p_brand) AS security, CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS q,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS v, CAST(l_quantity AS DECIMAL(18,2)) AS s
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_POS = f"""{_LINES}, pos AS (
  SELECT manager, security, q, CAST(sum(v) AS DOUBLE) AS value, CAST(sum(s) AS DOUBLE) AS shares FROM lines GROUP BY ALL),
filed AS (SELECT DISTINCT manager, q FROM pos)"""
_ACT = f"""{_POS}, act AS (
  SELECT p.*, b.shares AS prior_shares, b.value AS prior_value,
    CASE WHEN f.q IS NULL THEN 'held' WHEN b.shares IS NULL THEN 'new' WHEN p.shares > b.shares THEN 'added'
      WHEN p.shares < b.shares THEN 'trimmed' ELSE 'held' END AS action, f.q IS NOT NULL AS comparable
  FROM pos p LEFT JOIN pos b ON b.manager = p.manager AND b.security = p.security AND b.q = p.q - 1
  LEFT JOIN filed f ON f.manager = p.manager AND f.q = p.q - 1),
gone AS (
  SELECT b.manager, b.security, b.q + 1 AS q, b.value AS prior_value, b.shares AS prior_shares FROM pos b
  WHERE EXISTS (SELECT 1 FROM filed f WHERE f.manager = b.manager AND f.q = b.q + 1)
    AND NOT EXISTS (SELECT 1 FROM pos p WHERE p.manager = b.manager AND p.security = b.security AND p.q = b.q + 1))"""
_PRICE = f"""{_ACT}, priced AS (SELECT *, value / shares AS price FROM pos WHERE shares > 0),
consensus AS (SELECT security, q, median(price) AS price, count(*) AS n FROM priced GROUP BY ALL HAVING count(*) >= 3)"""
_FACTORS = "unnest([CAST(2 AS DOUBLE), 1/2.0::DOUBLE, 3, 1/3.0::DOUBLE, 4, 1/4.0::DOUBLE, 5, 1/5.0::DOUBLE, 10, 1/10.0::DOUBLE, 20, 1/20.0::DOUBLE])"

SQL = {
    "holdings_positions": f"WITH {_POS} SELECT * FROM pos",
    "holdings_value_scale": f"""WITH {_LINES} SELECT manager, q, count(r) AS n_priced,
      CAST(CASE WHEN count(r) < 10 THEN NULL WHEN median(r) >= 2 THEN 1 WHEN median(r) <= 0.5 THEN 1000 END AS INTEGER) AS scale
      FROM (SELECT *, CASE WHEN s > 0 THEN CAST(v AS DOUBLE) / CAST(s AS DOUBLE) END AS r FROM lines) GROUP BY ALL""",
    "holdings_actions": f"WITH {_ACT} SELECT * FROM act",
    "holdings_book_metrics": f"""WITH {_POS}, w AS (
      SELECT manager, q, value, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY manager, q) AS DOUBLE) AS total,
        row_number() OVER (PARTITION BY manager, q ORDER BY value DESC, security) AS rank FROM pos)
      SELECT manager, q, max(total) AS total, count(*) AS positions, round(sum(value / total) FILTER (WHERE rank <= 10), 4) AS top10,
        round(sum((value / total) * (value / total)), 4) AS hhi FROM w GROUP BY ALL""",
    "holdings_exits": f"WITH {_ACT} SELECT * FROM gone",
    "holdings_action_counts": f"""WITH {_ACT}, m AS (SELECT manager, q, action FROM act WHERE comparable UNION ALL SELECT manager, q, 'exited' FROM gone)
      SELECT manager, q, count(*) FILTER (action = 'new') AS n_new, count(*) FILTER (action = 'added') AS n_added,
        count(*) FILTER (action = 'trimmed') AS n_trimmed, count(*) FILTER (action = 'held') AS n_held, count(*) FILTER (action = 'exited') AS n_exited
      FROM m GROUP BY ALL""",
    "holdings_turnover": f"""WITH {_ACT}, m AS (
      SELECT manager, q, coalesce(sum(CASE action WHEN 'new' THEN value WHEN 'added' THEN (shares - prior_shares) * (value / shares) END), 0) AS bought,
        coalesce(sum(CASE action WHEN 'trimmed' THEN -(shares - prior_shares) * (value / shares) END), 0) AS sold, sum(value) AS total
      FROM act WHERE comparable GROUP BY ALL),
      c AS (SELECT manager, q, sum(prior_value) AS closed FROM gone GROUP BY ALL),
      b AS (SELECT manager, q + 1 AS q, sum(value) AS prior_total FROM pos GROUP BY ALL)
      SELECT m.manager, m.q, round(least(bought, sold + coalesce(closed, 0)) / ((total + prior_total) / 2), 4) AS turnover
      FROM m JOIN b USING (manager, q) LEFT JOIN c USING (manager, q)""",
    "holdings_consensus_price": f"WITH {_PRICE} SELECT * FROM consensus",
    "holdings_price_flags": f"""WITH {_PRICE}, o AS (
      SELECT a.manager, a.security, a.q, a.price, median(b.price) AS others_median, count(*) AS n FROM priced a
      JOIN priced b ON a.security = b.security AND a.q = b.q AND a.manager <> b.manager GROUP BY ALL)
      SELECT manager, security, q, price, others_median, abs(price / others_median - 1) > 0.05 AS flagged FROM o WHERE n >= 2""",
    "holdings_stale_valuation": f"""WITH {_PRICE}, j AS (
      SELECT p.manager, p.q, p.price, n.price AS now, o.price AS old FROM priced p JOIN consensus n ON n.security = p.security AND n.q = p.q
      JOIN consensus o ON o.security = p.security AND o.q = p.q - 1 WHERE abs(n.price / o.price - 1) > 0.05),
      s AS (SELECT manager, q, count(*) AS judged, count(*) FILTER (abs(price / old - 1) <= 0.02) AS n_old,
        count(*) FILTER (abs(price / now - 1) <= 0.05) AS n_now FROM j GROUP BY ALL)
      SELECT *, judged >= 20 AND n_old >= 0.8 * judged AND n_now < 0.5 * judged AS stale FROM s""",
    "holdings_split_by_holders": f"""WITH {_ACT}, r AS (SELECT security, q, shares / prior_shares AS ratio, {_FACTORS} AS factor FROM act WHERE prior_shares > 0),
      c AS (SELECT security, q, factor, count(*) FILTER (abs(ratio - factor) <= CAST(0.03 AS DOUBLE) * factor) AS near, count(*) AS holders FROM r GROUP BY ALL)
      SELECT security, q, factor, near, holders, near >= 2 AND near >= 0.7 * holders AS is_split FROM c
      QUALIFY row_number() OVER (PARTITION BY security, q ORDER BY near DESC, factor DESC) = 1""",
    "holdings_split_by_price": f"""WITH {_ACT}, s AS (
      SELECT security, q, count(*) AS n, median(shares / prior_shares) AS ratio,
        median(prior_value / prior_shares) / median(value / shares) AS price_ratio FROM act WHERE prior_shares > 0 AND shares > 0 GROUP BY ALL HAVING count(*) >= 5),
      f AS (SELECT *, {_FACTORS} AS factor FROM s), g AS (SELECT *, abs(ln(ratio / factor)) AS gap FROM f)
      SELECT security, q, n, factor, gap <= ln(1.15) AND abs(ln(price_ratio / factor)) <= ln(1.2) AS is_split FROM g
      QUALIFY row_number() OVER (PARTITION BY security, q ORDER BY gap, factor) = 1""",
    "holdings_net_shares": f"""WITH {_ACT}, m AS (
      SELECT security, q, comparable, action, shares - coalesce(prior_shares, 0) AS change, coalesce(prior_shares, 0) AS prior FROM act
      UNION ALL SELECT security, q, true, 'exited', -prior_shares, prior_shares FROM gone),
      g AS (SELECT security, q, count(*) FILTER (comparable AND action IN ('new', 'added')) AS buyers,
        count(*) FILTER (comparable AND action IN ('trimmed', 'exited')) AS sellers,
        CASE WHEN bool_or(NOT comparable) THEN NULL ELSE sum(change) END AS net_shares,
        sum(change) FILTER (comparable) AS kc, sum(prior) FILTER (comparable) AS kp FROM m GROUP BY ALL)
      SELECT security, q, buyers, sellers, buyers - sellers AS breadth, net_shares, CASE WHEN kp > 0 THEN round(kc / kp, 4) END AS conviction FROM g""",
    "holdings_coverage": f"""WITH {_POS}, c AS (
      SELECT f.q, count(*) AS filed, count(b.q) AS comparable FROM filed f LEFT JOIN filed b ON b.manager = f.manager AND b.q = f.q - 1 GROUP BY f.q),
      t AS (SELECT count(DISTINCT manager) AS on_file FROM filed)
      SELECT q, filed, comparable, on_file, q = (SELECT max(q) FROM c, t WHERE filed >= 0.75 * on_file) AS is_default FROM c, t""",
    "holdings_overlap": f"""WITH {_POS}, w AS (
      SELECT manager, security, q, value / CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY manager, q) AS DOUBLE) AS w FROM pos),
      p AS (SELECT a.manager, a.q, b.manager AS peer, round(sum(least(a.w, b.w)), 6) AS overlap, count(*) AS shared FROM w a
        JOIN w b ON a.q = b.q AND a.security = b.security AND a.manager <> b.manager GROUP BY ALL)
      SELECT *, CAST(row_number() OVER (PARTITION BY manager, q ORDER BY overlap DESC, peer) AS INTEGER) AS rank FROM p QUALIFY rank <= 25""",
    "holdings_first_last_seen": f"""WITH {_POS} SELECT security, min(q) AS first_q, max(q) AS last_q, count(DISTINCT manager) AS holders,
      (SELECT manager FROM pos i WHERE i.security = o.security ORDER BY q DESC, value DESC, manager DESC LIMIT 1) AS last_holder FROM pos o GROUP BY security""",
    "holdings_spark_line": f"""WITH {_POS}, g AS (
      SELECT security, unnest(range(last - 7, last + 1)) AS q FROM (SELECT DISTINCT security FROM pos), (SELECT max(q) AS last FROM pos)),
      n AS (SELECT security, q, count(DISTINCT manager) AS n FROM pos GROUP BY ALL)
      SELECT security, string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY g.q) AS spark FROM g LEFT JOIN n USING (security, q) GROUP BY security""",
    "holdings_listing_status": f"""WITH {_POS}, c AS (SELECT security, q, count(DISTINCT manager) AS holders FROM pos GROUP BY ALL),
      w AS (SELECT *, min(q) OVER (PARTITION BY security) AS f, max(q) OVER (PARTITION BY security) AS l,
        lag(holders) OVER (PARTITION BY security ORDER BY q) AS prior, max(q) OVER () AS newest FROM c)
      SELECT security, q, holders, CASE WHEN q = f THEN 'new-listing' WHEN q = f + 1 AND prior <= greatest(3, holders // 4) THEN 'recent-listing'
        WHEN q = l AND l < newest THEN 'ended' ELSE 'listed' END AS status FROM w""",
    "holdings_sector_rollup": """WITH s AS (
      SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 15 THEN 'small' WHEN p_size BETWEEN 10 AND 35 THEN 'middle' WHEN p_size BETWEEN 30 AND 50 THEN 'large' END AS sector FROM part)
      SELECT sector, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value, count(DISTINCT l_suppkey) AS holders, CAST(grouping(sector) AS INTEGER) AS is_total
      FROM lineitem JOIN s ON l_partkey = p_partkey GROUP BY ROLLUP (sector)""",
    "holdings_theme_holders": """WITH r AS (SELECT * FROM (VALUES ('small', 1, 15), ('middle', 10, 35), ('large', 30, 50)) t(theme, low, high))
      SELECT theme, count(DISTINCT l_suppkey) AS holders, count(DISTINCT l_partkey) AS parts FROM lineitem JOIN part ON l_partkey = p_partkey
      JOIN r ON p_size BETWEEN low AND high GROUP BY theme""",
    "holdings_category_weights": f"""WITH {_POS}, c AS (SELECT DISTINCT upper(p_brand) AS security, p_type AS category FROM part),
      t AS (SELECT manager, q, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM pos GROUP BY ALL),
      b AS (SELECT manager, q, category, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v FROM pos JOIN c USING (security) GROUP BY ALL),
      w AS (SELECT manager, q, category, round(v / total, 4) AS weight FROM b JOIN t USING (manager, q))
      SELECT *, CAST(row_number() OVER (PARTITION BY manager, q ORDER BY weight DESC, category) AS INTEGER) AS rank FROM w WHERE weight > 0 QUALIFY rank <= 3""",
}
