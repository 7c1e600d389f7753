"""Queries against their SQL on tables with odd values."""

import os
import shutil

import duckdb
import pytest

from tallyspark.plans import registry
from tests.oracle import connect, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"


def changed(folder, **selects):
    """The smallest tables in ``folder``, some of them replaced by what a SELECT over the original gives."""
    c = duckdb.connect()
    for name in os.listdir(SF):
        if (t := name.removesuffix(".parquet")) in selects:
            c.execute(f"COPY ({selects[t].format(f"'{SF}/{name}'")}) TO '{folder}/{name}' (FORMAT parquet)")
        else:
            shutil.copy(f"{SF}/{name}", folder)
    return str(folder)


def same(spark, folder, name):
    rows = spark_rows(registry.queries()[name](spark, folder))
    assert rows == duck_rows(connect(folder), registry.oracle_sql()[name])
    return rows[1]


#: A user's price is zero in one slot: the first, one that a base is taken from, the last, or in all of them.
ZEROS = """SELECT * EXCLUDE (day) REPLACE (CASE WHEN user_id = 0 AND day < 1 OR user_id = 1 AND day = 9 OR user_id = 2 AND day = 24 OR user_id = 3 AND day = 29 OR user_id = 4 THEN 0.0 ELSE value END AS value)
  FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day FROM {})"""


@pytest.fixture(scope="module")
def zero_prices(tmp_path_factory):
    return changed(tmp_path_factory.mktemp("zeros"), events=ZEROS)


#: A manager's newest book holds rights only: all that it held has left.
RIGHTS = """SELECT * REPLACE (CASE WHEN l_suppkey = 1 AND l_shipdate >= (SELECT date_trunc('quarter', max(l_shipdate)) FROM {0} WHERE l_suppkey = 1) THEN 6 ELSE l_linenumber END AS l_linenumber) FROM {0}"""


@pytest.fixture(scope="module")
def rights_only(tmp_path_factory):
    return changed(tmp_path_factory.mktemp("rights"), lineitem=RIGHTS)


def test_published_tables_with_a_manager_who_only_left(spark, rights_only):
    assert len(same(spark, rights_only, "build_explorer")) == 5


def test_managers_who_only_left(spark, rights_only):
    assert "nan" in repr(same(spark, rights_only, "explorer_managers"))


def test_reference_rows_with_zero_prices(spark, zero_prices):
    assert "nan" in repr(same(spark, zero_prices, "build_market_reference"))


def test_base_prices_of_zero(spark, zero_prices):
    assert "inf" in repr(same(spark, zero_prices, "market_base_prices"))


def test_drawdown_from_a_zero_price(spark, zero_prices):
    assert "nan" in repr(same(spark, zero_prices, "market_max_drawdown"))


def test_overlap_of_streamed_units(spark):
    import random

    from tallyspark.operators.holdings import overlap

    rng, books = random.Random(5), []
    for q in (1, 2, 3):
        for m in range(40):
            held = [(f"s{s}", float(rng.choice([0, 1, 1, 2, 5, 900]))) for s in rng.sample(range(14), rng.randrange(1, 9))] if m % 5 or not books else held
            held = [*held, ("s3x", -0.5)] if q == 3 and m % 7 == 1 else held
            if sum(v for _, v in held) > 0:
                books += [(f"m{m}", s, q, v) for s, v in held]
    totals, weight = {}, {}
    for m, _, q, v in books:
        totals[m, q] = totals.get((m, q), 0) + v
    for m, s, q, v in books:
        weight.setdefault((q, m), {})[s] = v / totals[m, q]
    want = set()
    for (q, m), a in weight.items():
        found = []
        for (p, n), b in weight.items():
            if p == q and n != m and (both := a.keys() & b.keys()):
                found.append((-round(sum(min(a[s], b[s]) for s in both), 6), n, len(both)))
        want |= {(m, q, n, round(-o, 6), c, k + 1) for k, (o, n, c) in enumerate(sorted(found)[:4])}
    pos = spark.createDataFrame(books, "manager string, security string, q int, value double")
    columns = ["manager", "q", "peer", "overlap", "shared", "rank"]
    for block, unit in ((7, 30), (3, 200), (2048, 1 << 20)):
        found = overlap(pos, 4, block, unit)
        assert {(*r[:3], round(r[3], 6), *r[4:]) for r in found.select(columns).collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan  # positions aren't multiplied, pairs aren't ranked as rows


def random_titles():
    import random

    rng = random.Random(3)
    said = [" ".join(rng.sample("alpha beta gamma delta epsilon zeta eta theta iota kappa".split(), rng.randrange(1, 9))) for _ in range(40)]
    rows = [(k, rng.choice(said[: 5 + k // 4]) if k % 13 else rng.choice(["", "of the", None]), 1 + rng.randrange(6)) for k in range(160)]
    rows += [(k + 1000, " ".join(reversed(t.split())).upper(), d) for k, t, d in rows[:30] if t]
    sets = [(k, {w for w in (t or "").lower().split() if w not in ("of", "the")}, d) for k, t, d in rows]
    alike = lambda a, b: bool(a and b) and len(a & b) / len(a | b) >= 0.6
    return rows, sets, alike


def test_titles_kept_of_many_alike(spark):
    from tallyspark.operators.dedupe import keep_first_titles

    rows, sets, alike = random_titles()
    kept = []
    for k, s, _ in sorted(sets, key=lambda x: x[0]):
        if not any(alike(s, t) for _, t in kept):
            kept.append((k, s))
    items = spark.createDataFrame([*rows, rows[0], (None, rows[0][1], 1)], "id long, title string, d int")
    got = sorted(r["id"] if r["id"] is not None else -1 for r in keep_first_titles(items, "id", "title").collect())
    assert got == sorted([-1, *(k for k, _ in kept), *(k for k, _ in kept if k == rows[0][0])])
    assert keep_first_titles(items.limit(0), "id", "title").count() == 0


def test_pairs_of_titles_in_small_blocks(spark):
    from pyspark.sql import functions as F

    from tallyspark.operators.dedupe import alike_pairs

    rows, sets, alike = random_titles()
    want = {(a, b, round(len(s & t) / len(s | t), 6)) for a, s, d in sets for b, t, e in sets if a < b and abs(d - e) <= 2 and alike(s, t)}
    items = spark.createDataFrame([*rows, rows[1], (None, rows[1][1], 1), (7000, rows[1][1], None)], "id long, title string, d int").withColumn("day", F.date_from_unix_date("d"))
    for block in (1, 3, 256):
        got = [(r["a"], r["b"], round(r["similarity"], 6)) for r in alike_pairs(items, "id", "title", "day", block).collect()]
        assert len(got) == len(want) and set(got) == want
    assert alike_pairs(items.limit(0), "id", "title", "day").count() == 0


def test_offers_are_read_once(spark):
    from pyspark.sql import functions as F

    from tallyspark.functions import mergers

    plan = registry.queries()["merger_offers"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert [plan.count(p) for p in mergers.OFFER_PATTERNS] == [1, 1, 1] and plan.count(mergers.REFUSALS) == 1
    texts = [
        ("The offer price of $7.5 stands. Holders get $9 per share in cash. All get $9 per share in cash.", (9.0, 2, False)), ("An offer price of $7. A right to receive $8 in cash.", (8.0, 1, False)),
        ("An earlier proposal had an offer price of $7.", (None, 0, True)), ("Costs of $3.", (None, 0, False)), ("", (None, 0, False)), (None, (None, 0, None)),
    ]
    got = spark.createDataFrame([(t,) for t, _ in texts], "t string").select(mergers.offer(F.col("t")).alias("x"), mergers.consideration(F.col("t")).alias("c")).collect()
    assert [tuple(r["x"]) for r in got] == [x for _, x in texts]
    assert [r["c"] for r in got] == ["cash", "cash", "none", "none", "none", "none"]
