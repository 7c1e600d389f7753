"""Market and series queries: users stand for symbols, event days for sessions, order priorities for series."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.operators import joins, market, ranking, reference_rows, series
from tallyspark.plans.holdings import table

FIRST_DAY = "2024-01-01"
LAST = 29


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    slot = F.datediff(F.col("ts").cast("date"), F.lit(FIRST_DAY).cast("date")).cast("int")
    return e.select(F.col("user_id").alias("symbol"), slot.alias("i"), F.col("ts").alias("at"), F.col("event_id").alias("seq"), F.col("value").alias("price"), F.lit(100).alias("size"), "event_type")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.daily(trades(spark, sf_dir))


def unbroken(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trades(spark, sf_dir)
    return market.last_unbroken(t, t.filter(F.col("event_type") == "error"))


def two_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trades(spark, sf_dir)
    return market.two_deep(t, t.filter(F.col("event_type") == "error"))


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week's events of a user: errors break the event one, two or three before."""
    t = trades(spark, sf_dir).withColumn("i", F.floor(F.col("i") / 7).cast("int"))
    own = Window.partitionBy("symbol", "i").orderBy("at", "seq")
    back = F.when(F.col("seq") % 3 == 0, F.lag("seq", 1).over(own)).when(F.col("seq") % 3 == 1, F.lag("seq", 2).over(own)).otherwise(F.lag("seq", 3).over(own))
    m = t.select("symbol", "i", F.row_number().over(own).alias("n"), "seq", back.alias("back"), "price", F.when(F.col("event_type") == "error", "break").otherwise("trade").alias("kind"))
    # Messages are numbered in their order; a break names its trade by that number.
    numbers = m.select("symbol", "i", F.col("seq").alias("back"), F.col("n").alias("ref"))
    return market.replayed(m.join(numbers, ["symbol", "i", "back"], "left").select("symbol", "i", F.col("n").alias("seq"), "kind", "price", "ref"))


def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.late_trades(trades(spark, sf_dir), F.date_trunc("day", "at") + F.expr("interval 1 day"), 360)


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = obs(spark, sf_dir)
    g = market.grade(F.col("trades") * 20, F.col("dollars") * 200, F.col("trades") * 3, F.col("trades") * 60)
    return o.select("symbol", "i", g.alias("grade"))


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = market.overnight_moves(obs(spark, sf_dir))
    return m.select("symbol", "i", F.round("change", 9).alias("change"), "ordinary_volume", market.split_shape(F.col("change")).alias("shape"))


def adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = obs(spark, sf_dir)
    m = market.overnight_moves(o).select("symbol", "i", market.split_shape(F.col("change")).alias("ratio")).filter("ratio is not null")
    return market.back_adjusted(o, m).select("symbol", "i", "price", F.round("adjusted", 9).alias("adjusted"))


def boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = market.overnight_moves(obs(spark, sf_dir))
    kind = F.when(market.split_shape(F.col("change")).isNotNull(), "unresolved").when(F.col("ordinary_volume"), "ordinary").otherwise("other")
    return market.event_boundary(m.select("symbol", "i", kind.alias("kind")))


#: The reference row's windows, scaled to the thirty days of the events.
CALENDAR = [datetime.date(2024, 1, 1) + datetime.timedelta(k) for k in range(LAST + 1)]
YEAR, CHANGES, COVERAGE = 25, {"1m": 5, "3m": 10, "6m": 15, "12m": 20}, 0.5


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = obs(spark, sf_dir)
    n = F.col("trades")
    seen = o.select("symbol", "i", "price", market.grade(n * 40, F.col("dollars") * 400, n * 5, n * 60).alias("grade"), (n * 60).alias("seconds"), "trades", (n * 3).alias("late"), "dollars")
    moved = market.overnight_moves(o).withColumn("shape", market.split_shape(F.col("change")))
    known, ordinary = F.col("shape").isNotNull(), F.coalesce("ordinary_volume", F.lit(False))
    kind = F.when(known & (F.col("symbol") % 3 != 1), "split").when(known & ordinary & (F.col("i") < 20), "unresolved").when(~ordinary & (F.col("symbol") % 2 == 0), "other").otherwise("ordinary")
    actions = moved.select("symbol", "i", kind.alias("kind"), (1 / F.col("shape")).alias("ratio"))
    return reference_rows.reference_rows(seen, actions, CALENDAR, YEAR, CHANGES, coverage=COVERAGE)


def market_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots_of = lambda c: F.array_join(F.transform(c, lambda a: a["date"].cast("string")), ",").alias(c)
    r = reference(spark, sf_dir)
    return r.select(*[slots_of(c) if c in ("splits", "corporate_actions") else F.col(c) for c in r.columns if c != "weekly"])


def weekly_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_rows.weekly_shards(reference(spark, sf_dir).withColumn("symbol", F.col("symbol").cast("string")))


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    g = o.groupBy(F.col("o_orderpriority").alias("id"), F.col("o_orderdate").cast("date").alias("d"))
    return g.agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("v"))


def as_of_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the last view of the same user at or before it."""
    e = table(spark, sf_dir, "events")
    left = e.filter(F.col("event_type") == "purchase").select("user_id", "ts", "event_id")
    right = e.filter(F.col("event_type") == "view").groupBy("user_id", "ts").agg(F.max("value").alias("viewed"))
    return joins.as_of(left, right, "user_id", "ts", "viewed")


def evidence_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups with the purchases of the same user from two days before to three after, the nearest five first."""
    e = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    left = e.filter(F.col("event_type") == "signup").select("user_id", F.col("event_id").alias("signup"), F.col("day").alias("signup_day"))
    right = e.filter(F.col("event_type") == "purchase").select("user_id", F.col("event_id").alias("purchase"), F.col("day").alias("purchase_day"))
    j = joins.within_days(left, right, "user_id", "signup_day", "purchase_day", 2, 3)
    return ranking.top_n(j, ["signup"], [F.abs(F.datediff("purchase_day", "signup_day")), F.col("purchase")], 5).select("signup", "purchase", "rank")


def merged_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old series until 1999 and a fresh one from 1998 in which one id failed: fresh wins by date."""
    s = order_series(spark, sf_dir)
    old = s.filter(F.col("d") < F.lit("1999-01-01").cast("date")).withColumn("v", F.col("v") + 1.0)
    fresh = s.filter((F.col("d") >= F.lit("1998-01-01").cast("date")) & (F.col("id") != "5-LOW"))
    return series.merge_fresh(old, fresh)


QUERIES = {
    "market_daily": obs,
    "market_last_unbroken": unbroken,
    "market_two_deep": two_deep,
    "market_late_trades": late,
    "market_replayed": replayed,
    "market_grade": graded,
    "market_overnight_moves": moves,
    "market_back_adjusted": adjusted,
    "market_event_boundary": boundary,
    "market_high_low": lambda spark, sf_dir: market.high_low(obs(spark, sf_dir), LAST, 25, 0.6),
    "market_base_prices": lambda spark, sf_dir: market.base_prices(obs(spark, sf_dir), LAST, (5, 10, 20), 3, 0.6),
    "market_realised_volatility": lambda spark, sf_dir: market.realised_volatility(obs(spark, sf_dir)),
    "market_max_drawdown": lambda spark, sf_dir: market.max_drawdown(obs(spark, sf_dir)),
    "market_staleness": lambda spark, sf_dir: market.staleness(obs(spark, sf_dir), LAST),
    "build_market_reference": market_reference,
    "build_weekly_shards": weekly_shards,
    "join_as_of": as_of_value,
    "join_evidence_window": evidence_window,
    "series_last_of_month": lambda spark, sf_dir: series.last_of_period(order_series(spark, sf_dir), "month"),
    "series_last_of_week": lambda spark, sf_dir: series.last_of_period(order_series(spark, sf_dir), "week"),
    "series_year_over_year": lambda spark, sf_dir: series.year_over_year(order_series(spark, sf_dir)),
    "series_spread": lambda spark, sf_dir: series.spread(order_series(spark, sf_dir), "1-URGENT", "5-LOW"),
    "series_growth": lambda spark, sf_dir: series.growth(order_series(spark, sf_dir)),
    "series_merge_fresh": merged_series,
    "series_trailing": lambda spark, sf_dir: series.trailing(order_series(spark, sf_dir), "d", 60),
}

_OBS = """t AS (
  SELECT user_id AS symbol, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS i, ts AS tm, event_id AS seq, value AS price, event_type FROM events),
obs AS (
  SELECT symbol, i, last(price ORDER BY tm, seq) AS price, count(*) AS trades, CAST(sum(CAST(price * 100 AS DECIMAL(18,4))) AS DOUBLE) AS dollars FROM t GROUP BY ALL)"""
_SHAPE = "coalesce(" + ", ".join(
    f"CASE WHEN abs(change * {f}::DOUBLE - 1) <= 0.03::DOUBLE THEN {f}::DOUBLE END, CASE WHEN abs(change / {f}::DOUBLE - 1) <= 0.03::DOUBLE THEN 1.0::DOUBLE / {f}::DOUBLE END"
    for f in market.SPLIT_SHAPES
) + ")"
_MOVES = f"""{_OBS}, w AS (
  SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY i) AS prev, i - lag(i) OVER (PARTITION BY symbol ORDER BY i) AS gap,
    quantile_cont(dollars, 0.5) OVER (PARTITION BY symbol ORDER BY i RANGE BETWEEN 21 PRECEDING AND 1 PRECEDING) AS usual FROM obs),
m AS (SELECT symbol, i, price / prev AS change, dollars <= 3 * usual AS ordinary_volume FROM w WHERE gap <= 5 AND prev > 0 AND price > 0 AND abs(ln(price / prev)) > ln(1.4)),
s AS (SELECT *, {_SHAPE} AS shape FROM m)"""
_KIND = """CASE WHEN shape IS NOT NULL AND symbol % 3 <> 1 THEN 'split' WHEN shape IS NOT NULL AND coalesce(ordinary_volume, false) AND i < 20 THEN 'unresolved'
    WHEN NOT coalesce(ordinary_volume, false) AND symbol % 2 = 0 THEN 'other' ELSE 'ordinary' END"""
_GRID = f"""{_MOVES}, a AS (SELECT symbol, i, {_KIND} AS kind, 1 / shape AS ratio FROM s),
sy AS (SELECT symbol, max(i) AS last FROM obs GROUP BY symbol),
b AS (SELECT symbol, max(i) FILTER (kind IN ('other', 'unresolved')) AS boundary, string_agg(i, ',' ORDER BY i) FILTER (kind = 'split') AS splits,
  string_agg(i, ',' ORDER BY i) FILTER (kind <> 'ordinary') AS corporate_actions FROM a GROUP BY symbol),
g0 AS (SELECT sy.symbol, k.i, last, last - {YEAR - 1} AS first, boundary, coalesce(splits, '') AS splits, coalesce(corporate_actions, '') AS corporate_actions, o.price, o.trades, o.dollars, a.kind,
  o.price * coalesce(product(CASE WHEN a.kind = 'split' THEN ratio ELSE 1 END) OVER (PARTITION BY sy.symbol ORDER BY k.i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1) AS p
  FROM sy CROSS JOIN range(30) k(i) LEFT JOIN b USING (symbol) LEFT JOIN obs o ON o.symbol = sy.symbol AND o.i = k.i LEFT JOIN a ON a.symbol = sy.symbol AND a.i = k.i),
g1 AS (SELECT *, ln(p / lag(p) OVER w) AS step, CASE WHEN i BETWEEN first AND last THEN p END AS py FROM g0 WINDOW w AS (PARTITION BY symbol ORDER BY i)),
g2 AS (SELECT *, max(py) OVER w AS top, arg_max(i, py) OVER w AS top_i FROM g1 WINDOW w AS (PARTITION BY symbol ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT *, CASE WHEN py < top THEN 1 - py / top END AS fall,
  CASE WHEN trades * 40 >= 100 AND dollars * 400 >= 1000000 AND trades * 5 >= 10 AND trades * 60 <= 300 THEN 'H' WHEN trades * 40 >= 20 AND dollars * 400 >= 100000 AND trades * 5 >= 3 AND trades * 60 <= 1800 THEN 'U' END AS grade FROM g2)"""
_BASE = "".join(
    f""", count(p) FILTER (i BETWEEN last - {n} AND last) AS seen_{k}, arg_min(struct_pack(p := p, i := i), abs(i - last + {n}) * 2 + CASE WHEN i > last - {n} THEN 1 ELSE 0 END)
      FILTER (p IS NOT NULL AND abs(i - last + {n}) <= 3 AND (i <= last - {n} OR i < last)) AS near_{k}"""
    for k, n in CHANGES.items()
)
_ROWS = f"""{_GRID}, r AS (SELECT symbol, any_value(last) AS last, any_value(first) AS first, any_value(boundary) AS boundary, any_value(splits) AS splits, any_value(corporate_actions) AS corporate_actions,
  max(price) FILTER (i = last) AS price, max(grade) FILTER (i = last) AS grade, max(kind) FILTER (i = last) AS kind, max(trades) FILTER (i = last) AS trades, max(dollars) FILTER (i = last) AS dollars,
  count(py) AS in_year, arg_max(i, py) AS high_date, max(py) AS high, arg_min(i, py) AS low_date, min(py) AS low, arg_max(struct_pack(p := p, i := i, top := top, top_i := top_i), fall) FILTER (fall > 0) AS deep,
  count(step) FILTER (i > last - 10 AND i <= last) AS n_short, stddev_samp(step) FILTER (i > last - 10 AND i <= last) AS sd_short,
  count(step) FILTER (i > first - 1 AND i <= last) AS n_year, stddev_samp(step) FILTER (i > first - 1 AND i <= last) AS sd_year{_BASE} FROM g GROUP BY symbol),
q AS (SELECT *, CASE WHEN 29 - last > 2 THEN 'stale' WHEN kind IN ('ordinary', 'unresolved') AND coalesce(grade, '') <> 'H' THEN 'discontinuity' ELSE 'ok' END AS status,
  first >= 0 AND (boundary IS NULL OR first >= boundary) AND in_year >= 13 AS whole FROM r),
f AS (SELECT *, status = 'ok' AS ok, status = 'ok' AND whole AS okay FROM q)"""
_AFTER = "(boundary IS NULL OR {0} >= boundary)"
_STATED = {k: f"ok AND last >= {n} AND {_AFTER.format(f'last - {n}')} AND seen_{k} >= {-(-(n + 1) // 2)} AND {_AFTER.format(f'near_{k}.i')}" for k, n in CHANGES.items()}
_VOLS = {"short": f"ok AND {_AFTER.format('last - 10')} AND n_short >= 5", "year": f"okay AND {_AFTER.format('first - 1')} AND n_year >= 12"}
_REFERENCE = f"""WITH {_ROWS} SELECT symbol, CAST(29 - last AS INTEGER) AS lag, status, last AS date, grade, trades * 60 AS seconds, trades, trades * 3 AS late, dollars, CASE WHEN ok THEN round(price, 4) END AS price,
  splits, corporate_actions, boundary AS valid_from, round(in_year / 25.0::DOUBLE, 2) AS coverage, CASE WHEN whole THEN 'ok' ELSE 'history' END AS stats_status,
  {", ".join(f"CASE WHEN {w} THEN round(near_{k}.p, 4) END AS base_{k}, CASE WHEN {w} THEN CAST(near_{k}.i AS INTEGER) END AS base_{k}_date" for k, w in _STATED.items())},
  {", ".join(f"CASE WHEN {w} THEN round(sd_{k} * sqrt(252), 4) END AS vol_{k}, CASE WHEN {w} THEN n_{k} END AS vol_{k}_returns" for k, w in _VOLS.items())},
  CASE WHEN okay THEN round(high, 4) END AS high, CASE WHEN okay THEN CAST(high_date AS INTEGER) END AS high_date, CASE WHEN okay THEN round(low, 4) END AS low, CASE WHEN okay THEN CAST(low_date AS INTEGER) END AS low_date,
  CASE WHEN okay THEN round(deep.top, 4) END AS drawdown_peak, CASE WHEN okay THEN CAST(deep.top_i AS INTEGER) END AS drawdown_peak_date,
  CASE WHEN okay THEN round(deep.p, 4) END AS drawdown_trough, CASE WHEN okay THEN CAST(deep.i AS INTEGER) END AS drawdown_trough_date FROM f"""
_WEEKLY = f"""WITH {_ROWS}, c AS (SELECT g.symbol, g.i, g.p, date_trunc('week', DATE '2024-01-01' + CAST(g.i AS INTEGER)) AS week FROM g JOIN f USING (symbol)
    WHERE f.ok AND g.p IS NOT NULL AND g.i >= greatest(5, coalesce(f.boundary, 0)))
  SELECT left(CAST(symbol AS VARCHAR), 1) AS shard, CAST(symbol AS VARCHAR) AS symbol, CAST(max(i) AS INTEGER) AS date, round(arg_max(p, i), 4) AS price FROM c GROUP BY symbol, week"""
_SERIES = """s AS (
  SELECT o_orderpriority AS id, CAST(o_orderdate AS DATE) AS d, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY ALL)"""

SQL = {
    "market_daily": f"WITH {_OBS} SELECT * FROM obs",
    "market_last_unbroken": f"""WITH {_OBS} SELECT symbol, i, last(price ORDER BY tm, seq) AS price, count(*) AS trades,
      CAST(sum(CAST(price * 100 AS DECIMAL(18,4))) AS DOUBLE) AS dollars FROM t WHERE event_type <> 'error' GROUP BY ALL""",
    "market_two_deep": f"""WITH {_OBS}, r AS (SELECT *, row_number() OVER (PARTITION BY symbol, i ORDER BY tm DESC, seq DESC) AS k FROM t)
      SELECT symbol, i, arg_min(price, k) FILTER (k <= 2 AND event_type <> 'error') AS price FROM r GROUP BY ALL""",
    "market_replayed": f"""WITH RECURSIVE {_OBS}, w AS (SELECT symbol, i // 7 AS i, tm, seq, price, event_type = 'error' AS broken FROM t),
      m AS (SELECT symbol, i, seq, price, broken, row_number() OVER p AS n, CASE seq % 3 WHEN 0 THEN lag(seq) OVER p WHEN 1 THEN lag(seq, 2) OVER p ELSE lag(seq, 3) OVER p END AS ref FROM w WINDOW p AS (PARTITION BY symbol, i ORDER BY tm, seq)),
      f AS (SELECT symbol, i, n, CASE WHEN NOT broken THEN seq END AS a, CASE WHEN NOT broken THEN price END AS pa, CAST(NULL AS BIGINT) AS b, CAST(NULL AS DOUBLE) AS pb, NOT broken AS traded FROM m WHERE n = 1
        UNION ALL SELECT m.symbol, m.i, m.n, CASE WHEN NOT broken THEN m.seq WHEN ref = a THEN b ELSE a END, CASE WHEN NOT broken THEN m.price WHEN ref = a THEN pb ELSE pa END,
          CASE WHEN NOT broken THEN a WHEN ref = a OR ref = b THEN NULL ELSE b END, CASE WHEN NOT broken THEN pa WHEN ref = a OR ref = b THEN NULL ELSE pb END, traded OR NOT broken
        FROM f JOIN m ON m.symbol = f.symbol AND m.i = f.i AND m.n = f.n + 1)
      SELECT symbol, CAST(i AS INTEGER) AS i, arg_max(struct_pack(p := pa), n).p AS price FROM f GROUP BY symbol, i HAVING bool_or(traded)""",
    "market_late_trades": f"""WITH {_OBS} SELECT symbol, i, count(*) FILTER (hour(tm) >= 18) AS late, count(DISTINCT date_trunc('minute', tm)) FILTER (hour(tm) >= 18) AS late_minutes FROM t GROUP BY ALL""",
    "market_grade": f"""WITH {_OBS} SELECT symbol, i, CASE WHEN trades * 20 >= 100 AND dollars * 200 >= 1000000 AND trades * 3 >= 10 AND trades * 60 <= 300 THEN 'H'
      WHEN trades * 20 >= 20 AND dollars * 200 >= 100000 AND trades * 3 >= 3 AND trades * 60 <= 1800 THEN 'U' END AS grade FROM obs""",
    "market_overnight_moves": f"WITH {_MOVES} SELECT symbol, i, round(change, 9) AS change, ordinary_volume, shape FROM s",
    "market_back_adjusted": f"""WITH {_MOVES} SELECT o.symbol, o.i, o.price, round(o.price / coalesce(product(coalesce(s.shape, 1))
      OVER (PARTITION BY o.symbol ORDER BY o.i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1), 9) AS adjusted FROM obs o LEFT JOIN s USING (symbol, i)""",
    "market_event_boundary": f"""WITH {_MOVES} SELECT symbol, max(i) FILTER (WHERE shape IS NOT NULL OR NOT coalesce(ordinary_volume, false)) AS boundary FROM s GROUP BY symbol""",
    "market_high_low": f"""WITH {_OBS}, x AS (SELECT * FROM obs WHERE i > 4 AND i <= 29),
      g AS (SELECT symbol, count(*) AS n, max(price) AS high, first(i ORDER BY price DESC, i) AS high_at, min(price) AS low, first(i ORDER BY price, i) AS low_at FROM x GROUP BY symbol)
      SELECT symbol, n, CASE WHEN n >= 15 THEN high END AS high, CASE WHEN n >= 15 THEN high_at END AS high_at,
        CASE WHEN n >= 15 THEN low END AS low, CASE WHEN n >= 15 THEN low_at END AS low_at FROM g""",
    "market_base_prices": f"""WITH {_OBS}, b AS (SELECT symbol, unnest([5, 10, 20]) AS back, last(price ORDER BY i) AS now FROM obs GROUP BY symbol),
      n AS (SELECT b.symbol, b.back, b.now, (SELECT price FROM obs o WHERE o.symbol = b.symbol AND abs(o.i - (29 - b.back)) <= 3 ORDER BY abs(o.i - (29 - b.back)), o.i LIMIT 1) AS base,
        (SELECT count(*) FROM obs o WHERE o.symbol = b.symbol AND o.i >= 29 - b.back) AS points FROM b)
      SELECT symbol, back, CASE WHEN points >= ceil((back + 1) * 0.6::DOUBLE) THEN base END AS base,
        CASE WHEN points >= ceil((back + 1) * 0.6::DOUBLE) THEN round(now / base - 1, 6) END AS change FROM n""",
    "market_realised_volatility": f"""WITH {_OBS}, w AS (SELECT symbol, CASE WHEN i - lag(i) OVER o = 1 THEN ln(price / lag(price) OVER o) END AS r FROM obs WHERE price > 0 WINDOW o AS (PARTITION BY symbol ORDER BY i))
      SELECT symbol, count(r) AS returns, CASE WHEN count(r) >= 2 THEN round(stddev_samp(r) * sqrt(252), 6) END AS volatility FROM w GROUP BY symbol""",
    "market_max_drawdown": f"""WITH {_OBS}, w AS (SELECT symbol, i, 1 - price / max(price) OVER (PARTITION BY symbol ORDER BY i) AS fall FROM obs)
      SELECT symbol, round(max(fall), 6) AS drawdown, first(i ORDER BY fall DESC, i) AS at FROM w GROUP BY symbol""",
    "market_staleness": f"WITH {_OBS} SELECT symbol, 29 - max(i) AS lag, 29 - max(i) > 2 AS stale FROM obs GROUP BY symbol",
    "build_market_reference": _REFERENCE,
    "build_weekly_shards": _WEEKLY,
    "join_as_of": """WITH r AS (SELECT user_id, ts, max(value) AS viewed FROM events WHERE event_type = 'view' GROUP BY ALL)
      SELECT l.user_id, l.ts, l.event_id, r.viewed, r.ts AS viewed_at FROM (SELECT * FROM events WHERE event_type = 'purchase') l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts""",
    "join_evidence_window": """WITH j AS (SELECT s.event_id AS signup, p.event_id AS purchase, abs(date_diff('day', CAST(s.ts AS DATE), CAST(p.ts AS DATE))) AS gap
      FROM events s JOIN events p ON s.user_id = p.user_id AND s.event_type = 'signup' AND p.event_type = 'purchase'
      AND date_diff('day', CAST(s.ts AS DATE), CAST(p.ts AS DATE)) BETWEEN -2 AND 3)
      SELECT signup, purchase, CAST(row_number() OVER (PARTITION BY signup ORDER BY gap, purchase) AS INTEGER) AS rank FROM j QUALIFY rank <= 5""",
    "series_last_of_month": f"WITH {_SERIES} SELECT id, CAST(date_trunc('month', d) AS DATE) AS period, max(d) AS d, last(v ORDER BY d) AS v FROM s GROUP BY ALL",
    "series_last_of_week": f"WITH {_SERIES} SELECT id, CAST(date_trunc('week', d) AS DATE) AS period, max(d) AS d, last(v ORDER BY d) AS v FROM s GROUP BY ALL",
    "series_year_over_year": f"""WITH {_SERIES}, m AS (SELECT id, CAST(date_trunc('month', d) AS DATE) AS period, last(v ORDER BY d) AS v FROM s GROUP BY ALL)
      SELECT a.id, a.period, round((a.v - b.v) / b.v * 100, 2) AS yoy FROM m a JOIN m b ON a.id = b.id AND b.period = CAST(a.period - INTERVAL 12 MONTH AS DATE) WHERE b.v <> 0""",
    "series_spread": f"WITH {_SERIES} SELECT a.d, CAST(round((a.v - b.v) * 100) AS BIGINT) AS spread FROM s a JOIN s b ON a.d = b.d AND a.id = '1-URGENT' AND b.id = '5-LOW'",
    "series_growth": f"WITH {_SERIES} SELECT id, d, v, round(v / lag(v) OVER (PARTITION BY id ORDER BY d) - 1, 6) AS growth FROM s",
    "series_merge_fresh": f"""WITH {_SERIES}, o AS (SELECT id, d, v + 1 AS v FROM s WHERE d < DATE '1999-01-01'), f AS (SELECT * FROM s WHERE d >= DATE '1998-01-01' AND id <> '5-LOW')
      SELECT id, d, coalesce(f.v, o.v) AS v FROM o FULL JOIN f USING (id, d)""",
    "series_trailing": f"WITH {_SERIES} SELECT * FROM s WHERE date_diff('day', d, (SELECT max(d) FROM s)) <= 60",
}
