"""Queries of screens, matches, verdicts, builders and time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.functions import dates, deadlines, text
from tallyspark.operators import boards, health, matching, screens
from tallyspark.operators import mentions as named
from tallyspark.plans.holdings import book, table
from tallyspark.plans.records import event_days, orders


def wanted_parts(spark, sf_dir):
    return screens.keep_matching(table(spark, sf_dir, "part"), "p_name", "widget|bolt", "cold|small").select("p_partkey", "p_name")


def horizon(spark, sf_dir):
    as_of = F.lit("1998-03-01").cast("date")
    relevant = F.col("priority").rlike("URGENT|HIGH") | (F.col("status") == "P")
    return screens.within_horizon(orders(spark, sf_dir), "day", as_of, relevant).select("o_orderkey", "day")


def allowed_pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    barred = p.filter("page_id % 17 = 0").select(F.regexp_extract(screens.host(F.col("url")), r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("host")).distinct()
    return screens.without_hosts(p, "url", barred)


def prose(spark, sf_dir):
    return screens.paragraphs(table(spark, sf_dir, "documents"), "doc_id", "text", parting="\n").select("doc_id", "k", F.length("body").alias("n"))


def undecided(spark, sf_dir):
    """Open orders whose customer and priority weren't last closed."""
    o = orders(spark, sf_dir)
    claims, decisions = o.filter("day >= '1998-07-01'"), o.filter("day < '1998-07-01'")
    found = screens.not_rejected(claims, decisions, ["o_custkey", "priority"], [F.desc("day"), F.desc("o_orderkey")], F.col("status") == "F")
    return found.select("o_orderkey")


def listings(spark, sf_dir):
    o = orders(spark, sf_dir)
    rows = o.select(
        "o_orderkey",
        F.concat(F.lit("https://www.example.org/c/"), F.col("o_custkey"), F.lit("/?utm_source=x")).alias("link"),
        F.col("day").alias("approved"),
        F.date_add("day", 60).alias("expires"),
        F.when(F.col("o_orderkey") % 4 != 0, F.date_add("day", (F.col("o_orderkey") % 90).cast("int"))).alias("closing"),
    )
    seen = table(spark, sf_dir, "customer").filter("c_nationkey % 5 = 0").select(F.concat(F.lit("http://example.org/c/"), F.col("c_custkey")).alias("link"))
    return screens.eligible_listings(rows, seen, F.lit("1998-02-15").cast("date"), "o_orderkey").select("o_orderkey")


def alias_mentions(spark, sf_dir):
    """Passages of two and three words of the benchmark's items, wherever whole documents have them; some open several items."""
    b = table(spark, sf_dir, "benchmark")
    words = F.regexp_extract_all(F.lower("text"), F.lit(f"({named.WORD})"), 1)
    cuts = [(1, 2), (1, 3), (4, 3), (8, 2)]
    names = b.select("item_id", F.explode(F.array(*[F.array_join(F.slice(words, a, n), " ") for a, n in cuts])).alias("alias")).filter("size(split(alias, ' ')) > 1")
    return named.mentions(table(spark, sf_dir, "documents"), "doc_id", "text", named.alias_table(names, "item_id", "alias"))


def costs(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", F.col("value").cast("decimal(18,2)").alias("units"))
    prices = spark.createDataFrame([("view", 1), ("click", 2), ("purchase", 5), ("signup", 3)], "event_type string, price int")
    return screens.stage_costs(e, prices, "event_type", "units").withColumn("cost", F.col("cost").cast("double"))


def budget(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.col("value").cast("decimal(18,2)").alias("cost"))
    a = screens.admitted(e, "user_id", [F.col("ts"), F.col("event_id")], "cost", F.lit(1000))
    return a.select("event_id", F.col("spent").cast("double").alias("spent"), "admitted")


def around(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    left = e.filter(F.col("event_type") == "signup").select("user_id", "ts", "event_id")
    right = e.filter(F.col("event_type") == "view").groupBy("user_id", "ts").agg(F.max("value").alias("v"))
    return matching.both_sides(left, right, "user_id", "ts", "v")


def campaigns(spark, sf_dir):
    e = event_days(spark, sf_dir)
    spans = [F.min("day").alias("first_day"), F.max("day").alias("last_day")]
    groups = e.filter("event_type = 'signup'").groupBy("user_id", F.floor(F.col("d") / 3).cast("int").alias("grp")).agg(*spans)
    matters = e.filter("event_type = 'purchase'").groupBy("user_id", (F.col("event_id") % 40).cast("int").alias("matter")).agg(*spans)
    return matching.absorbed(groups, matters, "user_id", "grp", "matter", 2)


def key_matches(spark, sf_dir):
    """Orders from July 1998 on against all earlier ones."""
    o = orders(spark, sf_dir)
    url = F.concat_ws("|", "priority", "status", F.round("price", -3).cast("long").cast("string")).alias("url")
    keyed = o.filter("day >= '1998-07-01'").select("o_orderkey", F.when(F.col("o_orderkey") % 4 == 1, F.col("o_custkey")).alias("accession"), url)
    index = o.filter("day < '1998-07-01'").select("o_orderkey", F.col("o_custkey").alias("accession"), url)
    return matching.first_key_match(keyed, index, ["accession", "url"], "o_orderkey").select("o_orderkey", "matched", "matched_by")


NAMES = [("Cold Widget", 1), ("bolt", 2), ("rod", 3), ("large bolt", 4), ("a small widget press", 5), ("blue rod", 6)]


def names(spark, sf_dir):
    t = spark.createDataFrame(NAMES, "p_name string, code int")
    return matching.contained_names(table(spark, sf_dir, "part"), "p_name", t, "code")


OVERRIDES = [(1, None, "1-URGENT", None, "1999-01-01"), (2, None, "1-URGENT", "f", "1999-02-02"), (3, 8, None, None, "1999-03-03"), (4, None, "2-HIGH", "o", "1999-04-04"), (5, 3, None, None, "1999-05-05")]


def override(spark, sf_dir):
    o = orders(spark, sf_dir).select("o_orderkey", "priority", "status", F.col("day").alias("closing"))
    t = spark.createDataFrame(OVERRIDES, "seq int, o_orderkey long, priority string, part string, closing string").withColumn("closing", F.col("closing").cast("date"))
    return matching.overridden(o, t, "o_orderkey", "priority", "status", "closing").select("o_orderkey", "closing")


def amendments(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem")
    kind = F.when(F.col("l_linenumber") == 1, "original").when(F.col("l_linenumber") == 2, "restatement").otherwise("addition")
    f = i.select(
        "l_suppkey", F.year("l_shipdate").alias("year"), kind.alias("kind"), F.col("l_shipdate").cast("date").alias("filed"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("accession")
    )
    return matching.in_force(f, ["l_suppkey", "year"])


def changed_filers(spark, sf_dir):
    e = event_days(spark, sf_dir)
    g = e.groupBy("user_id", "d").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("filer"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("amount"))
    return matching.filer_changes(g, "user_id", "d", "filer", "amount").withColumn("ratio", F.round("ratio", 6))


def joint_filings(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem")
    filers = F.array_join(F.transform(F.array_sort(F.collect_set("l_suppkey")), lambda x: x.cast("string")), ",")
    return i.groupBy("l_orderkey").agg(filers.alias("filers"), F.min(F.col("l_shipdate").cast("date")).alias("filed"))


def mentions(spark, sf_dir):
    """Capitalised pairs of words that stand in a text more than once, with how often and where first."""
    d = table(spark, sf_dir, "documents").filter("text is not null")
    found = F.regexp_extract_all("text", F.lit(r"(?:^|\P{L})([A-Z][a-z]{2,} [a-z]{2,})(?:$|\P{L})"), 1)
    d = d.select("doc_id", "text", found.alias("all")).withColumn("again", F.array_distinct("all"))
    each = F.filter(F.transform("again", lambda m: F.struct(m.alias("mention"), F.size(F.filter("all", lambda x: x == m)).cast("long").alias("n"))), lambda x: x["n"] > 1)
    # Only what returns is looked for in the text.
    placed = F.transform(each, lambda x: F.struct(x["mention"].alias("mention"), x["n"].alias("n"), (F.instr(F.col("text"), x["mention"]) - 1).alias("first_at")))
    return d.select("doc_id", F.inline(placed))


BATTERY = [("money", "[$€£]", 2), ("years", "(19|20)[0-9][0-9]", 1), ("links", "https?://", 1), ("marks", "[#*|<>]", 5)]


def battery(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    low = F.lower(F.coalesce("text", F.lit("")))
    return d.select("doc_id", *[(F.regexp_count(low, F.lit(p)) >= least).alias(name) for name, p, least in BATTERY])


def amounts(spark, sf_dir):
    o = orders(spark, sf_dir)
    unit = F.when(F.col("o_orderkey") % 3 == 0, " billion").when(F.col("o_orderkey") % 3 == 1, "m").otherwise(" units")
    body = F.concat(F.lit("buys it for $"), F.format_string("%.1f", F.col("price") / 1000), unit, F.lit(", then EUR 7bn"))
    return o.select("o_orderkey", F.round(text.amount_billions(body), 6).alias("billions"))


def tolerant(spark, sf_dir):
    o = orders(spark, sf_dir)
    k = F.col("o_orderkey") % 4
    body = F.when(k == 0, F.date_format("day", "yyyy-MM-dd")).when(k == 1, F.date_format("day", "d MMMM yyyy")).when(k == 2, F.date_format("day", "MMMM d, yyyy")).otherwise(F.date_format("day", "d/M/yyyy"))
    return o.select("o_orderkey", dates.tolerant_date(body).alias("day"))


def stated_deadlines(spark, sf_dir):
    o = orders(spark, sf_dir)
    k = F.col("o_orderkey") % 5
    body = (
        F.when(k == 0, F.concat(F.lit("Apply by "), F.date_format("day", "d MMMM yyyy"), F.lit(".")))
        .when(k == 1, F.concat(F.lit("The deadline, as told, is "), F.date_format("day", "yyyy-MM-dd")))
        .when(k == 2, F.concat(F.lit("Closing date "), F.lpad(F.lit(""), 100, "x"), F.date_format("day", " yyyy-MM-dd")))
        .when(k == 3, F.concat(F.lit("Posted "), F.date_format("day", "yyyy-MM-dd"), F.lit(", read on a rolling basis")))
        .otherwise(F.concat(F.lit("closes 1990-01-01, deadline "), F.date_format("day", "MMMM d, yyyy")))
    )
    today = F.lit("1997-06-15").cast("date")
    return o.select("o_orderkey", deadlines.deadline(body, today).alias("deadline"), deadlines.is_rolling(body, today).alias("rolling"))


def pages_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' orders as pages of a scan: five a page asked for, every seventh page served again in place of the next."""
    o = orders(spark, sf_dir)
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    page = F.floor(n / 5).cast("int")
    p = o.select(F.col("o_custkey").alias("board"), page.alias("page"), F.col("o_orderkey").cast("string").alias("key"))
    g = p.groupBy("board", "page").agg(F.collect_list("key").alias("keys"))
    total = p.groupBy("board").agg(F.count("*").cast("int").alias("total"))
    again = g.filter("page = 0 and board % 7 = 0").select("board", F.lit(1).alias("page"), F.col("keys").alias("__again"))
    g = g.join(again, ["board", "page"], "left").withColumn("keys", F.coalesce("__again", "keys")).drop("__again")
    return g.join(total, "board").withColumn("asked", F.lit(5)).withColumn("failed", (F.col("board") % 11 == 0) & (F.col("page") == 1))


def scan_verdicts(spark, sf_dir):
    return boards.pass_verdicts(pages_of_orders(spark, sf_dir), 2)


def statuses(spark, sf_dir):
    e = event_days(spark, sf_dir)
    last = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("d")))
    g = e.groupBy("user_id").agg(last("purchase").alias("r"), last("signup").alias("n"), last("error").alias("s"))
    return g.select("user_id", health.filer_status(F.lit(27), F.col("r"), F.col("n"), F.col("s")).alias("status"))


def verdicts(spark, sf_dir):
    e = event_days(spark, sf_dir)
    g = e.groupBy("user_id", "d").agg(F.count(F.when(F.col("event_type") != "error", 1)).alias("rows"), F.count(F.when(F.col("event_type") == "error", 1)).alias("failures"))
    g = g.withColumn("v", health.pass_verdict(F.col("rows"), F.lit(2), F.col("failures")))
    two = g.filter("d % 2 = 0").join(g.filter("d % 2 = 1").select("user_id", (F.col("d") - 1).alias("d"), F.col("v").alias("w")), ["user_id", "d"])
    return two.select("user_id", "d", "v", "w", health.worst(F.col("v"), F.col("w")).alias("worst"))


def healths(spark, sf_dir):
    return health.source_health(table(spark, sf_dir, "events"), "user_id", "ts", F.col("event_type") != "error")


def reached(spark, sf_dir):
    """Kinds of orders, a month of the year and priority each, that follow one another at a customer within a month: what one kind leads to."""
    o = orders(spark, sf_dir)
    state = F.concat_ws("/", F.date_format("day", "MM"), F.substring("priority", 1, 1))
    own = Window.partitionBy("o_custkey").orderBy("day", "o_orderkey")
    edges = o.select(state.alias("from_state"), F.lead(state).over(own).alias("to_state"), F.datediff(F.lead("day").over(own), "day").alias("gap"))
    return health.reachable(edges.filter("gap <= 31").select("from_state", "to_state"), "01/1")


def by_security(spark, sf_dir):
    """Books turned from managers to securities: holders, value and the largest holder; two holders at least."""
    g = book(spark, sf_dir).groupBy("security", "q").agg(
        F.countDistinct("manager").alias("holders"), F.sum("value").cast("double").alias("value"), F.max_by("manager", F.struct("value", -F.col("manager"))).alias("largest")
    )
    return g.filter("holders >= 2")


def peers(spark, sf_dir):
    """Customers of a nation and segment, in order: the peer set of each of them."""
    c = table(spark, sf_dir, "customer")
    listed = F.array_join(F.transform(F.slice(F.array_sort(F.collect_list("c_custkey")), 1, 10), lambda x: x.cast("string")), ",")
    return c.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"), listed.alias("peers"))


def nation_table(spark, sf_dir):
    """Country by measure, unpivoted, with an override and what it replaced."""
    c = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").cast("double").alias("customers"), F.round(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double") / F.count("*"), 6).alias("balance"))
    long = c.unpivot("c_nationkey", ["customers", "balance"], "measure", "v")
    fixed = spark.createDataFrame([(3, "customers", 99.0), (7, "balance", 1.5)], "c_nationkey int, measure string, fixed double")
    j = long.join(fixed, ["c_nationkey", "measure"], "left")
    return j.select("c_nationkey", "measure", F.coalesce("fixed", "v").alias("v"), F.when(F.col("fixed").isNotNull(), F.col("v")).alias("replaced"))


def shortlist(spark, sf_dir):
    """Three newest urgent orders, then the three largest others, then up to eight newest of what is left, none twice."""
    o = orders(spark, sf_dir)
    key = F.col("o_orderkey")
    news = o.filter("priority = '1-URGENT'").orderBy(F.desc("day"), key).limit(3)
    rest = o.join(news.select("o_orderkey"), "o_orderkey", "left_anti")
    deals = rest.orderBy(F.desc("price"), key).limit(3)
    moves = rest.join(deals.select("o_orderkey"), "o_orderkey", "left_anti").orderBy(F.desc("day"), key).limit(8)
    parts = [d.select("o_orderkey", F.lit(n).alias("slot")) for d, n in ((news, "news"), (deals, "deals"), (moves, "moves"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def gold_scores(spark, sf_dir):
    """Recall of a benchmark item's long words in each document that shares three of them or more.

    Three shared words of an item are at least one beyond its two commonest, so
    pairs meet by those only; the two commonest of an item never join.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z]+"), lambda w: F.length(w) >= 9))
    gold = table(spark, sf_dir, "benchmark").select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    docs = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", words(F.col("text")).alias("have"))
    posted = docs.select("doc_id", F.explode("have").alias("x"))
    asked = gold.select("item_id", "w", F.explode("w").alias("x"))
    common = posted.join(asked.select("x").distinct(), "x", "left_semi").groupBy("x").agg(F.count("*").alias("df"))
    rare = asked.join(common, "x").withColumn("r", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("df"), "x"))).filter("r > 2")
    pairs = posted.join(rare.select("item_id", "x"), "x").select("doc_id", "item_id").distinct()
    met = pairs.join(docs, "doc_id").join(gold, "item_id").withColumn("hits", F.size(F.array_intersect("have", "w"))).filter("hits >= 3")
    return met.select("doc_id", "item_id", F.round(F.col("hits") / F.size("w"), 6).alias("recall"))


def tumbling(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    g = e.groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


def session_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    g = e.groupBy("user_id", F.session_window("ts", "8 hours").alias("w")).agg(F.count("*").alias("n"), F.max("ts").alias("last"))
    return g.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "last", "n")


QUERIES = {
    "text_alias_mentions": alias_mentions,
    "filter_wanted": wanted_parts, "filter_horizon": horizon, "filter_hosts": allowed_pages, "text_paragraphs": prose, "filter_not_rejected": undecided,
    "filter_listings": listings, "agg_stage_costs": costs, "window_budget": budget, "join_both_sides": around, "join_campaigns": campaigns,
    "join_first_key": key_matches, "join_contained_names": names, "join_overrides": override, "join_amendments": amendments,
    "window_filer_changes": changed_filers, "agg_joint_filings": joint_filings, "text_mentions": mentions, "text_keyword_battery": battery,
    "text_amounts": amounts, "dates_tolerant": tolerant, "dates_deadline": stated_deadlines, "state_scan_verdicts": scan_verdicts, "state_filer_status": statuses, "state_verdicts": verdicts, "state_source_health": healths,
    "state_reachable": reached, "build_by_security": by_security, "build_peers": peers, "build_nation_table": nation_table,
    "build_shortlist": shortlist, "build_gold_scores": gold_scores, "window_tumbling": tumbling, "window_sessions": session_counts,
}

_E = "e AS (SELECT *, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS d, CAST(ts AS DATE) AS day FROM events)"
_O = "o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice AS price, o_orderpriority AS priority, o_orderstatus AS status FROM orders)"
_NAMES = ", ".join(f"('{n}', {v})" for n, v in NAMES)
_HOST = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))"

SQL = {
    "text_alias_mentions": """WITH RECURSIVE bw AS (SELECT item_id, regexp_extract_all(lower(text), '[A-Za-z0-9]+') AS w FROM benchmark),
      n AS (SELECT item_id, unnest([array_to_string(w[1:2], ' '), array_to_string(w[1:3], ' '), array_to_string(w[4:6], ' '), array_to_string(w[8:9], ' ')]) AS words FROM bw),
      a AS (SELECT words, CASE WHEN count(DISTINCT item_id) = 1 THEN min(item_id) END AS entity, len(string_split(words, ' ')) AS n FROM n WHERE contains(words, ' ') GROUP BY words),
      pieces AS (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9]+') AS ps FROM documents),
      p AS (SELECT doc_id, unnest(ps) AS piece, unnest(range(len(ps))) AS i FROM pieces),
      o AS (SELECT doc_id, i, piece, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) - length(piece) AS start FROM p),
      t AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos, lower(piece) AS w, start, start + length(piece) AS stop FROM o WHERE regexp_matches(piece, '^[A-Za-z0-9]')),
      g AS (SELECT doc_id, pos, start, w || ' ' || lead(w) OVER d AS two, lead(stop) OVER d AS stop2, w || ' ' || lead(w) OVER d || ' ' || lead(w, 2) OVER d AS three, lead(stop, 2) OVER d AS stop3 FROM t WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
      c AS (SELECT doc_id, pos, start, coalesce(x.words, y.words) AS words, CASE WHEN x.words IS NOT NULL THEN stop3 ELSE stop2 END AS stop, CASE WHEN x.words IS NOT NULL THEN x.entity ELSE y.entity END AS entity, CASE WHEN x.words IS NOT NULL THEN 3 ELSE 2 END AS n
        FROM g LEFT JOIN a x ON x.words = g.three LEFT JOIN a y ON y.words = g.two WHERE x.words IS NOT NULL OR y.words IS NOT NULL),
      r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM c),
      f AS (SELECT doc_id, k, pos + n AS free, true AS taken FROM r WHERE k = 1
        UNION ALL SELECT r.doc_id, r.k, CASE WHEN r.pos >= f.free THEN r.pos + r.n ELSE f.free END, r.pos >= f.free FROM f JOIN r ON r.doc_id = f.doc_id AND r.k = f.k + 1)
      SELECT r.doc_id, CAST(start AS INTEGER) AS start, CAST(stop AS INTEGER) AS stop, words, entity FROM r JOIN f USING (doc_id, k) WHERE taken""",
    "filter_wanted": "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(?i)widget|bolt') AND NOT regexp_matches(p_name, '(?i)cold|small')",
    "filter_horizon": f"WITH {_O} SELECT o_orderkey, day FROM o WHERE day BETWEEN DATE '1998-03-01' AND DATE '1998-03-01' + 120 AND (regexp_matches(priority, 'URGENT|HIGH') OR status = 'P')",
    "filter_hosts": rf"""WITH p AS (SELECT page_id, url, {_HOST} AS host FROM pages), b AS (SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS host FROM p WHERE page_id % 17 = 0)
      SELECT page_id, url FROM p WHERE NOT EXISTS (SELECT 1 FROM b WHERE p.host = b.host OR ends_with(p.host, '.' || b.host))""",
    "text_paragraphs": r"""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
      p AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS k, ls[i] AS body FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l))
      SELECT doc_id, k, CAST(length(body) AS INTEGER) AS n FROM p WHERE length(body) >= 160 AND length(body) - length(replace(body, chr(9), '')) <= 2 AND NOT regexp_matches(body, '^\(?[0-9a-z]{1,3}[.)]')
      QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, k) = 1""",
    "filter_not_rejected": f"""WITH {_O}, d AS (SELECT * FROM o WHERE day < DATE '1998-07-01' QUALIFY row_number() OVER (PARTITION BY o_custkey, priority ORDER BY day DESC, o_orderkey DESC) = 1)
      SELECT o_orderkey FROM o WHERE day >= DATE '1998-07-01' AND NOT EXISTS (SELECT 1 FROM d WHERE d.o_custkey = o.o_custkey AND d.priority = o.priority AND d.status = 'F')""",
    "filter_listings": f"""WITH {_O}, l AS (SELECT o_orderkey, o_custkey, day AS approved, day + 60 AS expires, CASE WHEN o_orderkey % 4 <> 0 THEN day + CAST(o_orderkey % 90 AS INTEGER) END AS closing FROM o)
      SELECT o_orderkey FROM l WHERE approved <= DATE '1998-02-15' AND expires >= DATE '1998-02-15' AND (closing IS NULL OR closing >= DATE '1998-02-15')
      AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey % 5 = 0) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY approved DESC, o_orderkey) = 1""",
    "agg_stage_costs": """WITH p AS (SELECT * FROM (VALUES ('view', 1), ('click', 2), ('purchase', 5), ('signup', 3)) t(event_type, price))
      SELECT event_type, count(*) AS calls, CASE WHEN bool_and(price IS NOT NULL AND value IS NOT NULL) THEN CAST(sum(CAST(value AS DECIMAL(18,2)) * price) AS DOUBLE) END AS cost FROM events LEFT JOIN p USING (event_type) GROUP BY 1""",
    "window_budget": """WITH s AS (SELECT event_id, sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spent FROM events)
      SELECT event_id, CAST(spent AS DOUBLE) AS spent, spent <= 1000 AS admitted FROM s""",
    "join_both_sides": """WITH r AS (SELECT user_id, ts, max(value) AS v FROM events WHERE event_type = 'view' GROUP BY ALL), l AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup'),
      b AS (SELECT l.*, r.v AS before FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts)
      SELECT b.user_id, b.ts, b.event_id, b.before, r.v AS after FROM b ASOF LEFT JOIN r ON b.user_id = r.user_id AND b.ts < r.ts""",
    "join_campaigns": f"""WITH {_E}, g AS (SELECT user_id, CAST(floor(d / 3) AS INTEGER) AS grp, min(day) AS a, max(day) AS b FROM e WHERE event_type = 'signup' GROUP BY ALL),
      m AS (SELECT user_id, CAST(event_id % 40 AS INTEGER) AS matter, min(day) AS a, max(day) AS b FROM e WHERE event_type = 'purchase' GROUP BY ALL)
      SELECT g.user_id, g.grp, min(m.matter) AS matter FROM g LEFT JOIN m ON m.user_id = g.user_id AND g.a >= m.a - 2 AND g.b <= m.b + 2 GROUP BY ALL""",
    "join_first_key": f"""WITH {_O}, u AS (SELECT *, concat_ws('|', priority, status, CAST(round(price, -3) AS BIGINT)) AS url FROM o),
      i AS (SELECT o_orderkey AS id, o_custkey AS accession, url FROM u WHERE day < DATE '1998-07-01'),
      c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN o_custkey END AS accession, url FROM u WHERE day >= DATE '1998-07-01'),
      m AS (SELECT o_orderkey, (SELECT min(id) FROM i WHERE i.accession = c.accession) AS a, (SELECT min(id) FROM i WHERE i.url = c.url) AS u FROM c)
      SELECT o_orderkey, coalesce(a, u) AS matched, CASE WHEN a IS NOT NULL THEN 'accession' WHEN u IS NOT NULL THEN 'url' END AS matched_by FROM m""",
    "join_contained_names": f"""WITH t AS (SELECT * FROM (VALUES {_NAMES}) t(name, code)), l AS (SELECT DISTINCT p_name FROM part),
      h AS (SELECT p_name, code, CASE WHEN p_name = name THEN 0 WHEN lower(p_name) = lower(name) THEN 1 ELSE 2 END AS how FROM l, t
        WHERE contains(' ' || lower(p_name) || ' ', ' ' || lower(name) || ' ') OR contains(' ' || lower(name) || ' ', ' ' || lower(p_name) || ' ')),
      f AS (SELECT p_name, how, count(DISTINCT code) AS n, min(code) AS code FROM h WHERE how = (SELECT min(how) FROM h x WHERE x.p_name = h.p_name) GROUP BY ALL)
      SELECT p_name, CASE WHEN n = 1 THEN code END AS code, CASE how WHEN 0 THEN 'exact' WHEN 1 THEN 'folded' WHEN 2 THEN 'contained' END AS how FROM l LEFT JOIN f USING (p_name)""",
    "join_overrides": f"""WITH {_O}, t AS (SELECT * FROM (VALUES (1, NULL, '1-URGENT', NULL, DATE '1999-01-01'), (2, NULL, '1-URGENT', 'f', DATE '1999-02-02'), (3, 8, NULL, NULL, DATE '1999-03-03'),
        (4, NULL, '2-HIGH', 'o', DATE '1999-04-04'), (5, 3, NULL, NULL, DATE '1999-05-05')) v(seq, id, grp, part, closing)),
      n AS (SELECT o_orderkey, last(t.closing ORDER BY seq) AS c FROM o JOIN t ON t.id = o_orderkey OR t.id IS NULL AND grp = priority AND (part IS NULL OR contains(lower(status), part)) GROUP BY 1)
      SELECT o_orderkey, coalesce(c, day) AS closing FROM o LEFT JOIN n USING (o_orderkey)""",
    "join_amendments": """WITH f AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CASE l_linenumber WHEN 1 THEN 'original' WHEN 2 THEN 'restatement' ELSE 'addition' END AS kind,
        CAST(l_shipdate AS DATE) AS filed, l_orderkey || '-' || l_linenumber AS accession FROM lineitem),
      b AS (SELECT l_suppkey, year, filed AS bf, accession AS ba FROM f WHERE kind <> 'addition' QUALIFY row_number() OVER (PARTITION BY l_suppkey, year ORDER BY filed DESC, accession DESC) = 1)
      SELECT f.* FROM f JOIN b USING (l_suppkey, year) WHERE kind = 'addition' AND (filed > bf OR filed = bf AND accession > ba) OR kind <> 'addition' AND filed = bf AND accession = ba""",
    "window_filer_changes": f"""WITH {_E}, g AS (SELECT user_id, d, last(event_type ORDER BY ts, event_id) AS filer, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM e GROUP BY ALL),
      w AS (SELECT *, lag(d) OVER x AS p, lag(filer) OVER x AS before, lag(amount) OVER x AS a FROM g WINDOW x AS (PARTITION BY user_id ORDER BY d))
      SELECT user_id, d, before, filer, round(amount / CASE WHEN a <> 0 THEN a END, 6) AS ratio FROM w WHERE d = p + 1 AND filer <> before""",
    "agg_joint_filings": "SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS filers, min(CAST(l_shipdate AS DATE)) AS filed FROM lineitem GROUP BY 1",
    "text_mentions": r"""WITH m AS (SELECT doc_id, text, unnest(regexp_extract_all(text, '(?:^|\P{L})([A-Z][a-z]{2,} [a-z]{2,})(?:$|\P{L})', 1)) AS mention FROM documents WHERE text IS NOT NULL)
      SELECT doc_id, mention, count(*) AS n, CAST(min(instr(text, mention) - 1) AS INTEGER) AS first_at FROM m GROUP BY 1, 2 HAVING count(*) > 1""",
    "text_keyword_battery": "SELECT doc_id, " + ", ".join(f"len(regexp_extract_all(lower(coalesce(text, '')), '{p}')) >= {n} AS {name}" for name, p, n in BATTERY) + " FROM documents",
    "text_amounts": """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(printf('%.1f', o_totalprice / 1000) AS DOUBLE) WHEN 1 THEN round(CAST(printf('%.1f', o_totalprice / 1000) AS DOUBLE) / 1000, 6) ELSE 7.0 END AS billions FROM orders""",
    "dates_tolerant": f"WITH {_O} SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 AND day(day) <= 12 AND day(day) <> month(day) THEN NULL ELSE day END AS day FROM o",
    "dates_deadline": f"""WITH {_O}, x AS (SELECT o_orderkey, day, o_orderkey % 5 AS k, day BETWEEN DATE '1997-06-15' AND DATE '1999-06-15' AS soon FROM o)
      SELECT o_orderkey, CASE WHEN k IN (0, 1, 4) AND soon THEN day END AS deadline, k = 3 AS rolling FROM x""",
    "state_scan_verdicts": f"""WITH {_O}, n AS (SELECT o_custkey AS board, o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 5) AS INTEGER) AS page, count(*) OVER (PARTITION BY o_custkey) AS total FROM o),
      p AS (SELECT board, page, total, count(*) AS n, page = 1 AND board % 7 = 0 AS again, page = 1 AND board % 11 = 0 AS failed FROM n GROUP BY ALL),
      q AS (SELECT *, CASE WHEN again THEN 0 ELSE n END AS fresh, CASE WHEN again THEN 5 ELSE n END AS shown FROM p),
      s AS (SELECT *, CASE WHEN fresh = 0 THEN 'replay' WHEN shown < 5 THEN 'short' WHEN sum(fresh) OVER (PARTITION BY board ORDER BY page) >= total THEN 'total' END AS stop FROM q),
      w AS (SELECT *, coalesce(count(stop) OVER (PARTITION BY board ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
      SELECT board, CASE WHEN bool_or(failed) THEN 'failures' WHEN bool_or(coalesce(stop = 'replay', false)) THEN 'replay' WHEN count(*) >= 2 AND max(stop) IS NULL THEN 'budget' WHEN max(stop) IS NULL THEN 'open' ELSE 'complete' END AS verdict,
        CAST(sum(fresh) AS BIGINT) AS rows FROM w WHERE before = 0 GROUP BY board""",
    "state_filer_status": f"""WITH {_E}, g AS (SELECT user_id, max(d) FILTER (event_type = 'purchase') AS r, max(d) FILTER (event_type = 'signup') AS n, max(d) FILTER (event_type = 'error') AS s FROM e GROUP BY 1)
      SELECT user_id, CASE WHEN r >= 27 THEN 'current' WHEN n >= 27 THEN 'notice' WHEN s > coalesce(r, s - 1) THEN 'stopped' ELSE 'overdue' END AS status FROM g""",
    "state_verdicts": f"""WITH {_E}, g AS (SELECT user_id, d, count(*) FILTER (event_type <> 'error') AS r, count(*) FILTER (event_type = 'error') AS f FROM e GROUP BY ALL),
      v AS (SELECT user_id, d, CASE WHEN r = 0 AND f > 0 THEN 2 WHEN f > 0 OR r < 2 THEN 1 ELSE 0 END AS v FROM g), n AS (SELECT unnest([0, 1, 2]) AS k, unnest(['ok', 'partial', 'failed']) AS name)
      SELECT a.user_id, a.d, x.name AS v, y.name AS w, z.name AS worst FROM v a JOIN v b ON a.user_id = b.user_id AND b.d = a.d + 1 AND a.d % 2 = 0
      JOIN n x ON x.k = a.v JOIN n y ON y.k = b.v JOIN n z ON z.k = greatest(a.v, b.v)""",
    "state_source_health": """WITH l AS (SELECT user_id, max(ts) FILTER (event_type <> 'error') AS last_success FROM events GROUP BY 1)
      SELECT l.user_id, last_success, min(ts) FILTER (event_type = 'error' AND (last_success IS NULL OR ts > last_success)) AS failing_since,
        count(*) FILTER (event_type = 'error' AND (last_success IS NULL OR ts > last_success)) AS failures FROM l JOIN events e USING (user_id) GROUP BY 1, 2""",
    "state_reachable": f"""WITH RECURSIVE {_O}, e AS (SELECT strftime(day, '%m') || '/' || priority[1] AS a, lead(strftime(day, '%m') || '/' || priority[1]) OVER w AS b, lead(day) OVER w - day AS gap
        FROM o WINDOW w AS (PARTITION BY o_custkey ORDER BY day, o_orderkey)),
      r AS (SELECT b AS state FROM e WHERE a = '01/1' AND gap <= 31 UNION SELECT e.b FROM r JOIN e ON e.a = r.state WHERE gap <= 31) SELECT state FROM r""",
    "build_by_security": """WITH l AS (SELECT l_suppkey AS manager, upper(p_brand) AS security, year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem JOIN part ON l_partkey = p_partkey),
      b AS (SELECT manager, security, q, sum(v) AS value FROM l GROUP BY ALL)
      SELECT security, CAST(q AS INTEGER) AS q, count(DISTINCT manager) AS holders, CAST(sum(value) AS DOUBLE) AS value, first(manager ORDER BY value DESC, manager) AS largest FROM b GROUP BY 1, 2 HAVING count(DISTINCT manager) >= 2""",
    "build_peers": "SELECT c_nationkey, c_mktsegment, count(*) AS n, array_to_string(list_slice(list_sort(list(c_custkey)), 1, 10), ',') AS peers FROM customer GROUP BY 1, 2",
    "build_nation_table": """WITH g AS (SELECT c_nationkey, CAST(count(*) AS DOUBLE) AS customers, round(CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS balance FROM customer GROUP BY 1), u AS (UNPIVOT g ON customers, balance INTO NAME measure VALUE v),
      x AS (SELECT *, CASE WHEN c_nationkey = 3 AND measure = 'customers' THEN 99.0::DOUBLE WHEN c_nationkey = 7 AND measure = 'balance' THEN 1.5::DOUBLE END AS fixed FROM u)
      SELECT c_nationkey, measure, coalesce(fixed, v) AS v, CASE WHEN fixed IS NOT NULL THEN v END AS replaced FROM x""",
    "build_shortlist": f"""WITH {_O}, n AS (SELECT o_orderkey FROM o WHERE priority = '1-URGENT' ORDER BY day DESC, o_orderkey LIMIT 3),
      d AS (SELECT o_orderkey FROM o WHERE o_orderkey NOT IN (FROM n) ORDER BY price DESC, o_orderkey LIMIT 3),
      m AS (SELECT o_orderkey FROM o WHERE o_orderkey NOT IN (FROM n) AND o_orderkey NOT IN (FROM d) ORDER BY day DESC, o_orderkey LIMIT 8)
      SELECT o_orderkey, 'news' AS slot FROM n UNION ALL SELECT o_orderkey, 'deals' FROM d UNION ALL SELECT o_orderkey, 'moves' FROM m""",
    "build_gold_scores": """WITH g AS (SELECT item_id, list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: length(w) >= 9)) AS w FROM benchmark),
      a AS (SELECT item_id, len(w) AS n, unnest(w) AS x FROM g), d AS (SELECT doc_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: length(w) >= 9))) AS x FROM documents WHERE text IS NOT NULL)
      SELECT doc_id, item_id, round(count(*) / max(n), 6) AS recall FROM d JOIN a USING (x) GROUP BY 1, 2 HAVING count(*) >= 3""",
    "window_tumbling": "SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '2024-01-01') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "window_sessions": """WITH w AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 8 HOUR THEN 0 ELSE 1 END AS new FROM events),
      s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM w)
      SELECT user_id, min(ts) AS start, max(ts) AS last, count(*) AS n FROM s GROUP BY user_id, k""",
}
