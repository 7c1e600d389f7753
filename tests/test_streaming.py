"""Streams over a file source give what the same rows give in a batch."""

from pyspark.sql import functions as F

from tallyspark.streaming import events as s

SF = "/root/testdata/sf0.001"


def folder(spark, tmp_path):
    """The events in four files, in order of time."""
    path = str(tmp_path / "events")
    e = spark.read.parquet(f"{SF}/events.parquet")
    e.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(path)
    return path, e.withColumn("ts", F.col("ts").cast("timestamp"))


def drained(stream, name, tmp_path, mode="complete"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.sql(f"SELECT * FROM {name}")


def same(a, b):
    columns = sorted(a.columns)
    key = lambda r: repr([round(r[c], 6) if isinstance(r[c], float) else r[c] for c in columns])
    return sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_tumbling_and_sliding(spark, tmp_path):
    path, batch = folder(spark, tmp_path)
    assert same(drained(s.tumbling(s.read_events(spark, path, 10)), "tumbling", tmp_path), s.tumbling(batch))
    assert same(drained(s.tumbling(s.read_events(spark, path, 10), "2 hours", slide="1 hour"), "sliding", tmp_path), s.tumbling(batch, "2 hours", slide="1 hour"))


def test_sessions(spark, tmp_path):
    path, batch = folder(spark, tmp_path)
    got = drained(s.sessions(s.read_events(spark, path, 10)), "sessions", tmp_path)
    assert same(got, s.sessions(batch))


def test_dedupe_and_join(spark, tmp_path):
    path, batch = folder(spark, tmp_path)
    stream = s.read_events(spark, path, 10)
    assert drained(s.first_by_key(stream, ["event_id"]), "firsts", tmp_path, "append").count() == batch.count()
    views, buys = (stream.filter(F.col("event_type") == t) for t in ("view", "purchase"))
    got = drained(s.joined_within(views, buys), "joined", tmp_path, "append")
    b_views, b_buys = (batch.filter(F.col("event_type") == t) for t in ("view", "purchase"))
    assert got.count() == s.joined_within(b_views, b_buys).count()


def test_state_between_batches(spark, tmp_path):
    path, batch = folder(spark, tmp_path)
    q = s.keep_state(s.read_events(spark, path, 1), str(tmp_path / "state"), s.counts_by_user, str(tmp_path / "ck"))
    q.awaitTermination()
    versions = sorted(int(p.name.split("=")[1]) for p in (tmp_path / "state").glob("v=*"))
    assert len(versions) >= 4
    got = spark.read.parquet(str(tmp_path / "state" / f"v={versions[-1]}"))
    assert same(got, s.counts_by_user(None, batch))


def test_ledger_as_a_stream(spark, tmp_path):
    """The stream's entries are those of a batch run a day; what lapses goes by timers, once."""
    import datetime as dt
    import random

    from tallyspark.operators.state import ledger
    from tallyspark.streaming import ledger as stream

    rng, start = random.Random(4), dt.date(2024, 1, 1)
    day = lambda k: start + dt.timedelta(k)
    rows = []
    for k in range(40):
        for _ in range(6):
            hit = rng.random() < 0.6
            rows.append((f"i{rng.randrange(12)}", day(k), dt.datetime.combine(day(k), dt.time(12)), day(k + rng.randrange(-1, 15)) if hit else None))
    rows += [("once", day(2), dt.datetime.combine(day(2), dt.time(1)), day(30)), ("soon", day(5), dt.datetime.combine(day(5), dt.time(1)), day(6))]
    schema = "id string, day date, ts timestamp, closing date"
    path, forget = str(tmp_path / "readings"), 6
    for part, days in enumerate((range(0, 9), range(9, 20), range(20, 30), range(30, 40))):
        spark.createDataFrame([r for r in rows if (r[1] - start).days in days], schema).coalesce(1).write.mode("append").parquet(f"{path}/p={part}")
    state = spark.createDataFrame([], "id string, closing date, first_seen date, last_seen date, misses int")
    held = {}
    for k in range(40):  # the batch operator, run by run; the rows are few, so the state goes through the driver here
        today = spark.createDataFrame([(r[0], r[3]) for r in rows if r[1] == day(k)], "id string, closing date")
        held = {r["id"]: tuple(r)[1:] for r in ledger(state, today, F.lit(day(k)), forget).collect()}
        state = spark.createDataFrame([(i, *v) for i, v in held.items()], state.schema)
    readings = spark.readStream.schema(schema + ", p int").option("maxFilesPerTrigger", 1).parquet(path).drop("p")
    changes = drained(stream.ledger_changes(readings, forget), "ledger", tmp_path, "update").collect()
    last = {}
    for r in changes:
        if r["id"] not in last or (r["day"], r["gone"]) >= (last[r["id"]]["day"], last[r["id"]]["gone"]):
            last[r["id"]] = r
    alive = {i: tuple(r)[2:6] for i, r in last.items() if not r["gone"] and (r["closing"] is None or r["closing"] >= day(39)) and (r["last_seen"] is None or (day(39) - r["last_seen"]).days <= forget)}
    assert alive == held and len(held) > 3
    assert last["once"]["gone"] and last["once"]["day"] == day(9) and last["soon"]["gone"] and last["soon"]["day"] == day(7)
    assert sum(r["gone"] for r in changes if r["id"] == "once") == 1
