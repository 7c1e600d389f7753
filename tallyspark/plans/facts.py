"""Fact and deal queries: suppliers report by return flag; customers' orders are readings of deals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import deals, facts
from tallyspark.plans.holdings import table


def fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly sums and sums from January to the end of March, June and September, of each supplier and flag."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("cik"), F.col("l_returnflag").alias("tag"), F.col("l_shipdate").cast("date").alias("d"), F.col("l_extendedprice").cast("decimal(18,2)").alias("v")
    )
    start = F.trunc("d", "year")
    ends = F.array(*[F.date_sub(F.add_months(start, m), 1) for m in (3, 6, 9, 12)])
    spread = items.withColumn("end", F.explode(F.filter(ends, lambda e: e >= F.col("d"))))
    g = spread.groupBy("cik", "tag", start.alias("start"), "end").agg(F.sum("v").cast("double").alias("val"))
    return g.withColumn("filed", F.date_add("end", 40))


def known_facts(spark, sf_dir):
    return facts.as_of(fact_rows(spark, sf_dir), F.lit("2000-08-20").cast("date"))


def trailing(spark, sf_dir):
    return facts.trailing_year(known_facts(spark, sf_dir)).withColumn("ltm", F.round("ltm", 2))


def kinds(spark, sf_dir):
    f = known_facts(spark, sf_dir)
    return f.groupBy("cik", facts.period_kind(F.col("start"), F.col("end")).alias("kind")).agg(F.count("*").alias("n"))


def chosen(spark, sf_dir):
    return facts.chosen_tag(known_facts(spark, sf_dir), ["R", "A", "N"])


def ebitda(spark, sf_dir):
    return facts.ebitda(facts.trailing_year(known_facts(spark, sf_dir)), "A", ["R", "N"]).withColumn("ebitda", F.round("ebitda", 2))


def net_debt(spark, sf_dir):
    f = known_facts(spark, sf_dir).filter(F.month("end") != F.when(F.col("tag") == "N", 6).otherwise(0))
    return facts.net_debt(f, ["A", "R"], ["N"], "precedent").withColumn("net_debt", F.round("net_debt", 2))


def growth(spark, sf_dir):
    f = known_facts(spark, sf_dir).filter(facts.period_kind(F.col("start"), F.col("end")) == "year")
    return facts.growth(f.select("cik", "tag", "end", F.col("val").alias("v")))


def statements(spark, sf_dir):
    return facts.statements(known_facts(spark, sf_dir), "R", ["A", "N"], 4)


def identities(spark, sf_dir):
    """Orders as readings of deals, five customers a target: buyers known, unknown or joint; agreements; amended ones."""
    o = table(spark, sf_dir, "orders")
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    buyer = F.when(k % 3 != 0, F.concat(F.lit("b"), F.floor(k / 8) % 3))
    rows = o.select(
        F.floor(F.col("o_custkey") / 5).alias("target"), k.alias("reading"), day.alias("day"), F.date_add(day, 30).alias("filed"),
        F.when(k % 4 == 0, F.date_sub(day, (k % 10).cast("int"))).alias("agreed"), F.when(k % 7 == 0, F.date_sub(day, (k % 100 + 20).cast("int"))).alias("original"),
        buyer.alias("buyer"), F.when(k % 5 == 0, F.array(F.lit("b0"), F.lit("b1"))).alias("parties"),
    )
    return deals.deal_groups(rows)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("reading"),
        F.concat(F.col("o_custkey"), F.lit(":"), F.year("o_orderdate")).alias("deal"),
        F.col("o_orderdate").cast("date").alias("filed"),
        F.when(k % 5 != 0, F.col("o_totalprice") / 1000).alias("offer"),
        F.when(k % 3 == 0, (k % 17) / 10.0).alias("premium"),
        ((k % 90) + 10).cast("double").alias("shares"),
        F.when(k % 7 != 0, ((k % 50) * 100 - 1000).cast("double")).alias("net_debt"),
        ((k % 400) * 10 - 20).cast("double").alias("revenue"),
        ((k % 150) * 5).cast("double").alias("ebitda"),
        (k % 4).cast("int").alias("n_doubts"),
    )


def valued(spark, sf_dir):
    v = deals.valued(readings(spark, sf_dir))
    return v.select("reading", F.round("unaffected", 12).alias("unaffected"), F.round("ev", 12).alias("ev"), F.round("ev_revenue", 12).alias("ev_revenue"), F.round("ev_ebitda", 12).alias("ev_ebitda"), "doubts")


def duplicates(spark, sf_dir):
    r = readings(spark, sf_dir).withColumn("target", F.split("deal", ":")[0])
    known = r.filter("n_doubts = 0").select("target", F.col("filed").alias("announced"), F.col("reading").alias("deal"))
    return deals.duplicate_intervals(r.filter("n_doubts > 0").select("target", "filed", F.col("reading").alias("candidate")), known, "target")


def primary(spark, sf_dir):
    return deals.primary_reading(readings(spark, sf_dir)).select("deal", "reading")


def borrowed(spark, sf_dir):
    return deals.borrowed(readings(spark, sf_dir), ["premium", "net_debt"]).select("reading", F.col("premium_full"), F.col("net_debt_full"))


def size_buckets(spark, sf_dir):
    return readings(spark, sf_dir).groupBy(deals.size_bucket(F.col("offer") * F.col("shares") / 2).alias("bucket")).agg(F.count("*").alias("n"))


QUERIES = {
    "facts_trailing_year": trailing, "facts_period_kinds": kinds, "facts_chosen_tag": chosen, "facts_ebitda": ebitda, "facts_net_debt": net_debt, "facts_growth": growth, "facts_statements": statements,
    "deals_groups": identities, "deals_valued": valued, "deals_duplicate_intervals": duplicates, "deals_primary_reading": primary, "deals_borrowed": borrowed, "deals_size_buckets": size_buckets,
}

_F = """i AS (SELECT l_suppkey AS cik, l_returnflag AS tag, CAST(l_shipdate AS DATE) AS d, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem),
x AS (SELECT cik, tag, v, CAST(date_trunc('year', d) AS DATE) AS start, d, unnest([3, 6, 9, 12]) AS m FROM i),
f AS (SELECT cik, tag, start, CAST(start + to_months(m) - INTERVAL 1 DAY AS DATE) AS stop, CAST(sum(v) AS DOUBLE) AS val FROM x WHERE CAST(start + to_months(m) - INTERVAL 1 DAY AS DATE) >= d GROUP BY ALL),
k AS (SELECT *, CASE WHEN stop - start BETWEEN 340 AND 400 THEN 'year' WHEN stop - start BETWEEN 80 AND 100 THEN 'quarter' ELSE 'other' END AS kind FROM f WHERE stop + 40 <= DATE '2000-08-20')"""
_LTM = f"""{_F}, fy AS (SELECT cik, tag, max(stop) AS fy_end, last(val ORDER BY stop) AS fy FROM k WHERE kind = 'year' GROUP BY ALL),
n AS (SELECT fy.*, (SELECT max(stop) FROM k WHERE k.cik = fy.cik AND k.tag = fy.tag AND k.stop > fy_end AND abs(start - fy_end) <= 7 AND kind <> 'year') AS now_end FROM fy),
t AS (SELECT n.cik, n.tag, CASE WHEN b.val IS NOT NULL THEN now_end ELSE fy_end END AS stop, CASE WHEN b.val IS NOT NULL THEN fy + c.val - b.val ELSE fy END AS ltm,
  CASE WHEN b.val IS NOT NULL THEN 'LTM' ELSE 'FY' END AS basis FROM n LEFT JOIN k c ON c.cik = n.cik AND c.tag = n.tag AND c.stop = now_end AND year(c.start) = year(now_end)
  LEFT JOIN k b ON b.cik = n.cik AND b.tag = n.tag AND abs(now_end - b.stop - 365) <= 7 AND abs((c.stop - c.start) - (b.stop - b.start)) <= 7)"""
_R = """r AS (SELECT o_orderkey AS reading, concat(o_custkey, ':', year(o_orderdate)) AS deal, CAST(o_custkey AS VARCHAR) AS target, CAST(o_orderdate AS DATE) AS filed,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice / 1000 END AS offer, CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 17) / 10.0::DOUBLE END AS premium,
  CAST(o_orderkey % 90 + 10 AS DOUBLE) AS shares, CASE WHEN o_orderkey % 7 <> 0 THEN CAST((o_orderkey % 50) * 100 - 1000 AS DOUBLE) END AS net_debt,
  CAST((o_orderkey % 400) * 10 - 20 AS DOUBLE) AS revenue, CAST((o_orderkey % 150) * 5 AS DOUBLE) AS ebitda, CAST(o_orderkey % 4 AS INTEGER) AS n_doubts FROM orders)"""

_SAME = """coalesce((coalesce(abs(x.original - coalesce(m.agreed, m.original)) <= 7, false) OR coalesce(abs(m.original - coalesce(x.agreed, x.original)) <= 7, false)) AND (x.buyer IS NULL OR m.buyer IS NULL OR x.buyer = m.buyer), false)
  OR ((x.buyer IS NULL OR m.buyer IS NULL OR x.buyer = m.buyer OR coalesce(list_contains(x.parties, m.buyer), false) OR coalesce(list_contains(m.parties, x.buyer), false))
    AND CASE WHEN x.agreed IS NOT NULL AND m.agreed IS NOT NULL THEN abs(x.agreed - m.agreed) <= 7 ELSE abs(x.day - m.day) <= 180 END)"""

SQL = {
    "deals_groups": f"""WITH RECURSIVE o AS (SELECT o_custkey // 5 AS target, o_orderkey AS k, CAST(o_orderdate AS DATE) AS day FROM orders),
      r AS (SELECT target, k AS reading, row_number() OVER (PARTITION BY target ORDER BY day, k) AS i, struct_pack(reading := k, day := day, agreed := CASE WHEN k % 4 = 0 THEN day - CAST(k % 10 AS INTEGER) END,
          original := CASE WHEN k % 7 = 0 THEN day - CAST(k % 100 + 20 AS INTEGER) END, buyer := CASE WHEN k % 3 <> 0 THEN 'b' || (k // 8) % 3 END, parties := CASE WHEN k % 5 = 0 THEN ['b0', 'b1'] END) AS x FROM o),
      fold AS (SELECT target, 1 AS i, [[x]] AS groups FROM r WHERE i = 1
        UNION ALL SELECT target, i, CASE WHEN coalesce(pos, 0) = 0 THEN list_append(groups, [x]) ELSE list_concat(list_concat(groups[:pos - 1], [list_append(groups[pos], x)]), groups[pos + 1:]) END FROM (
          SELECT f.target, f.i + 1 AS i, f.groups, r.x, list_position(list_transform(f.groups, lambda g: len(list_filter(g, lambda m: NOT ({_SAME}))) = 0), true) AS pos
          FROM fold f JOIN r ON r.target = f.target AND r.i = f.i + 1)),
      done AS (SELECT target, unnest(arg_max(groups, i)) AS g FROM fold GROUP BY target),
      d AS (SELECT target, g, list_min(list_concat(list_transform(g, lambda m: m.day), list_transform(g, lambda m: m.original))) AS first, list_min(list_transform(g, lambda m: m.reading)) AS least FROM done),
      n AS (SELECT *, row_number() OVER (PARTITION BY target, first ORDER BY least) AS again FROM d)
      SELECT target, unnest(list_transform(g, lambda m: m.reading)) AS reading, concat(target, ':', first, CASE WHEN again > 1 THEN ':' || again ELSE '' END) AS deal, CAST(len(g) AS INTEGER) AS readings FROM n""",
    "facts_trailing_year": f"""WITH {_LTM} SELECT cik, tag, stop AS "end", round(ltm, 2) AS ltm, basis FROM t""",
    "facts_period_kinds": f"WITH {_F} SELECT cik, kind, count(*) AS n FROM k GROUP BY ALL",
    "facts_chosen_tag": f"""WITH {_F}, g AS (SELECT cik, tag, max(stop) AS l, count(*) AS n FROM k WHERE tag IN ('R', 'A', 'N') GROUP BY ALL)
      SELECT cik, tag FROM g QUALIFY row_number() OVER (PARTITION BY cik ORDER BY l DESC, n DESC, CASE tag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END) = 1""",
    "facts_ebitda": f"""WITH {_LTM}, e AS (SELECT cik, stop, ltm FROM t WHERE tag = 'A'), d AS (SELECT e.cik, first(t.ltm ORDER BY CASE t.tag WHEN 'R' THEN 1 ELSE 2 END) AS d
      FROM e JOIN t ON t.cik = e.cik AND t.tag IN ('R', 'N') AND abs(e.stop - t.stop) <= 7 GROUP BY e.cik)
      SELECT e.cik, round(e.ltm + d.d, 2) AS ebitda FROM e LEFT JOIN d USING (cik)""",
    "facts_net_debt": f"""WITH {_F}, l AS (SELECT * FROM k WHERE NOT (tag = 'N' AND month(stop) = 6) QUALIFY row_number() OVER (PARTITION BY cik, tag ORDER BY stop DESC) = 1),
      w AS (SELECT *, max(stop) OVER (PARTITION BY cik) AS newest FROM l)
      SELECT cik, round(sum(val) FILTER (tag IN ('A', 'R')) - coalesce(sum(val) FILTER (tag = 'N'), 0), 2) AS net_debt FROM w WHERE newest - stop <= 100 GROUP BY cik""",
    "facts_growth": f"""WITH {_F} SELECT cik, tag, stop AS "end", val AS v, round(val / lag(val) OVER (PARTITION BY cik, tag ORDER BY stop) - 1, 6) AS growth FROM k WHERE kind = 'year'""",
    "facts_statements": f"""WITH {_F}, y AS (SELECT * FROM k WHERE kind = 'year'),
      a AS (SELECT cik, stop, val, round(val / lag(val) OVER (PARTITION BY cik ORDER BY stop) - 1, 6) AS growth FROM y WHERE tag = 'R' QUALIFY row_number() OVER (PARTITION BY cik ORDER BY stop DESC) <= 4)
      SELECT a.cik, a.stop AS "end", a.val AS revenue, growth, p.val AS "A", round(p.val / a.val, 6) AS "A_margin", q.val AS "N", round(q.val / a.val, 6) AS "N_margin" FROM a
      LEFT JOIN y p ON p.cik = a.cik AND p.stop = a.stop AND p.tag = 'A' LEFT JOIN y q ON q.cik = a.cik AND q.stop = a.stop AND q.tag = 'N'""",
    "deals_valued": f"""WITH {_R}, v AS (SELECT *, offer / (1 + premium) AS unaffected, offer * shares + net_debt AS ev FROM r),
      m AS (SELECT *, CASE WHEN revenue > 0 THEN ev / revenue END AS er, CASE WHEN ebitda > 0 THEN ev / ebitda END AS ee FROM v)
      SELECT reading, round(unaffected, 12) AS unaffected, round(ev, 12) AS ev, round(er, 12) AS ev_revenue, round(ee, 12) AS ev_ebitda,
        array_to_string(list_filter([CASE WHEN offer > 2000 THEN 'offer' END, CASE WHEN premium > 1.5::DOUBLE THEN 'premium' END, CASE WHEN net_debt IS NULL THEN 'balance' END, CASE WHEN ev <= 0 THEN 'ev' END,
        CASE WHEN revenue < 0 THEN 'revenue' END, CASE WHEN NOT ee BETWEEN 1 AND 75 THEN 'ev_ebitda' END, CASE WHEN er > 60 THEN 'ev_revenue' END], lambda x: x IS NOT NULL), ',') AS doubts FROM m""",
    "deals_duplicate_intervals": f"""WITH {_R} SELECT c.reading AS candidate, k.reading AS deal, CAST(abs(c.filed - k.filed) AS INTEGER) AS gap FROM r c JOIN r k ON c.target = k.target
      AND c.n_doubts > 0 AND k.n_doubts = 0 AND abs(c.filed - k.filed) <= 180 QUALIFY row_number() OVER (PARTITION BY c.reading ORDER BY abs(c.filed - k.filed), k.reading) = 1""",
    "deals_primary_reading": f"""WITH {_R} SELECT deal, reading FROM r QUALIFY row_number() OVER (PARTITION BY deal ORDER BY offer IS NULL, filed DESC, n_doubts, reading) = 1""",
    "deals_borrowed": f"""WITH {_R}, b AS (SELECT *, last_value(CASE WHEN premium IS NOT NULL THEN {{'v': premium, 'o': offer}} END IGNORE NULLS) OVER w AS lp, last_value(net_debt IGNORE NULLS) OVER w AS ln FROM r
      WINDOW w AS (PARTITION BY deal ORDER BY filed, reading ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
      SELECT reading, coalesce(premium, CASE WHEN abs(lp.o / offer - 1) <= 0.005::DOUBLE THEN lp.v END) AS premium_full, coalesce(net_debt, ln) AS net_debt_full FROM b""",
    "deals_size_buckets": f"""WITH {_R}, b AS (SELECT CASE WHEN x IS NULL THEN 'unknown' WHEN x < 250 THEN 'micro' WHEN x < 1000 THEN 'small' WHEN x < 5000 THEN 'middle' WHEN x < 20000 THEN 'large' ELSE 'mega' END AS bucket
      FROM (SELECT offer * shares / 2 AS x FROM r)) SELECT bucket, count(*) AS n FROM b GROUP BY 1""",
}
