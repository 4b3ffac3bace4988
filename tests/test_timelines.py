"""As-of join, interval join and sessions by pause: ties, missing keys, heavy users, plans."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shoptrail.operators.asof import as_of
from shoptrail.operators.gaps import gap_sessions, gap_session_stream
from shoptrail.operators.intervals import holding, in_bins
from shoptrail.session import work_path

START = dt.datetime(2024, 1, 1)


def at(seconds: float | None) -> dt.datetime | None:
    return None if seconds is None else START + dt.timedelta(seconds=seconds)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------------- as of
ROWS = "id long, user string, ts timestamp, last_name string"
STATES = "user string, since timestamp, pk string, name string, id long"


def joined(spark, rows, states, **more):
    left = spark.createDataFrame([(i, u, at(s), "kept") for i, u, s in rows], ROWS)
    right = spark.createDataFrame([(u, at(s), pk, name, 9) for u, s, pk, name in states], STATES)
    return as_of(left, right, ["user"], "ts", "since", "pk", ("name", "since"), prefix="found_", **more)


def brute(rows, states):
    out = []
    for i, u, s in rows:
        known = [(t, pk, name) for v, t, pk, name in states if u is not None and v == u and t is not None and s is not None and t <= s]
        best = max(known, default=(None, None, None))
        out.append((i, u, at(s), "kept", best[2], at(best[0])))
    return sorted(out, key=str)


def test_as_of_equals_brute_force(spark):
    rng = random.Random(4)
    users = ["a", "a", "a", "b", "c", None]  # half of all rows are one user's
    moment = lambda: rng.choice([None, *[rng.randrange(0, 500_000, 250) for _ in range(9)]])
    rows = [(i, rng.choice(users), moment()) for i in range(300)]
    states = [(rng.choice([*users, "d"]), moment(), f"p{k:03}", f"n{k}") for k in range(120)]
    states += [(u, s, "p999", "tie") for u, s, *_ in states[:30]]
    rows += rows[:20]
    for seconds in (3_600, 86_400, 10**9):
        assert sorted(map(tuple, joined(spark, rows, states, slice_seconds=seconds).collect()), key=str) == brute(rows, states)


def test_as_of_edges(spark):
    states = [("a", 100, "p1", "first"), ("a", 100, "p2", "tie"), ("a", 200, "p0", "later"), (None, 0, "p", "nobody"), ("a", None, "p", "never")]
    got = {r.id: r.found_name for r in joined(spark, [(1, "a", 99), (2, "a", 100), (3, "a", 199.9), (4, "a", 200), (5, None, 300), (6, "a", None), (7, "b", 300)], states).collect()}
    assert got == {1: None, 2: "tie", 3: "tie", 4: "later", 5: None, 6: None, 7: None}
    assert joined(spark, [], states).collect() == []
    assert [r.found_name for r in joined(spark, [(1, "a", 100)], []).collect()] == [None]


def test_as_of_splits_a_user_with_half_of_all_rows(spark):
    """No task sorts more than a slice of a key, rows without a user or time are dealt out, and no join stands in the plan."""
    many = spark.range(40_000).select(F.col("id"), F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 4 == 1, F.concat(F.lit("u"), (F.col("id") % 97).cast("string"))).alias("user"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    states = many.select("user", F.col("ts").alias("since"), F.col("id").cast("string").alias("pk"))
    out = as_of(many, states, ["user"], "ts", "since", "pk", ("pk",))
    text = plan(out)
    assert "Join" not in text
    assert out.filter("user is null and last_pk is null or last_pk = cast(id as string)").count() == 40_000
    from pyspark.sql.functions import spark_partition_id

    spread = out.groupBy(spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in spread) < 0.6 * 40_000


# ------------------------------------------------------------------ intervals
def test_holding_equals_brute_force(spark):
    rng = random.Random(6)
    users = ["a", "a", "b", None]
    events = [(i, rng.choice(users), rng.choice([None, rng.randrange(0, 3_000_000, 100)])) for i in range(400)]
    spans = []
    for k in range(150):
        start = rng.randrange(0, 3_000_000, 100)
        length = rng.choice([0, -50, 1, 100, 300, 301, 4_000, 54_000, 90_000, 2_000_000])
        spans.append((k, rng.choice(users), start, rng.choice([start + length, start + length, None])))
    left = spark.createDataFrame([(i, u, at(s)) for i, u, s in events], "id long, user string, ts timestamp")
    right = spark.createDataFrame([(k, u, at(a), at(b)) for k, u, a, b in spans], "span long, user string, since timestamp, until timestamp")
    want = sorted((i, k) for i, u, s in events for k, v, a, b in spans if None not in (u, s, b) and u == v and a <= s < b)
    for bins in ((300, 3_600, 86_400, 2_592_000), (60,), (7, 500_000)):
        got = holding(left, right, ["user"], "ts", "since", "until", ("span",), bins)
        assert sorted((r.id, r.span) for r in got.collect()) == want
    assert len(want) > 300


def test_holding_bounds_and_views_of_hours(spark):
    events = spark.createDataFrame([(i, "a", at(s)) for i, s in enumerate((0, 99.999999, 100, 9 * 3600, 10 * 3600))], "id long, user string, ts timestamp")
    spans = spark.createDataFrame([(1, "a", at(0), at(100)), (2, "a", at(100), at(10 * 3600)), (3, "a", at(50), at(50))], "span long, user string, since timestamp, until timestamp")
    got = sorted((r.id, r.span) for r in holding(events, spans, ["user"], "ts", "since", "until", ("span",)).collect())
    assert got == [(0, 1), (1, 1), (2, 2), (3, 2)]


def test_holding_is_an_equality_join_of_few_bins(spark):
    events = spark.range(5_000).select(F.lit("hot").alias("user"), F.timestamp_seconds(F.col("id") * 10).alias("ts"))
    spans = spark.range(500).select(F.col("id").alias("span"), F.lit("hot").alias("user"), F.timestamp_seconds(F.col("id") * 100).alias("since"), F.timestamp_seconds(F.col("id") * 100 + 100).alias("until"))
    out = holding(events, spans, ["user"], "ts", "since", "until", ("span",))
    text = plan(out)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert out.count() == 5_000
    assert out.filter("span != floor(unix_seconds(ts) / 100)").count() == 0


def test_intervals_make_few_rows(spark):
    """an interval of ten hours stood in eleven bins, and its row was shuffled as often; now in at most four, of any length to 90 days."""
    lengths = (1, 600, 899, 36_000, 86_400, 200_000, 7_000_000)
    spans = spark.createDataFrame([(k, "a", at(7 * k), at(7 * k + n)) for k, n in enumerate(lengths)], "span long, user string, since timestamp, until timestamp")
    for values in (("span",), ("span", "since", "until")):
        rows = in_bins(spans, ["user"], "since", "until", values)
        assert max(r["count"] for r in rows.groupBy("span").count().collect()) <= 4
        events = spans.select(F.col("user"), F.col("since").alias("ts"))
        got = {(r.span, r.ts) for r in holding(events, spans, ["user"], "ts", "since", "until", values).collect()}
        assert got == {(k, at(7 * e)) for e in range(7) for k, n in enumerate(lengths) if 7 * k <= 7 * e < 7 * k + n}


def test_holding_refuses_clashing_names(spark):
    events = spark.createDataFrame([(1, "a", at(0))], "span long, user string, ts timestamp")
    with pytest.raises(ValueError, match="span"):
        holding(events, events, ["user"], "ts", "ts", "ts", ("span",))


# --------------------------------------------------------------- gap sessions
def brute_sessions(events, gap):
    by = defaultdict(list)
    for u, s, kind in events:
        if s is not None:
            by[u].append((s, kind))
    out = []
    for u, rows in by.items():
        rows.sort()
        number, start = 0, None
        for k, (s, _) in enumerate(rows):
            if k == 0 or s - rows[k - 1][0] > gap:
                number, start = number + 1, s
                out.append([u, number, at(start), at(s), 0, 0])
            out[-1][3] = at(s)
            out[-1][4] += 1
            out[-1][5] += rows[k][1] == "x"
    return sorted(map(tuple, out), key=str)


def gap_events(n=600):
    rng = random.Random(8)
    events = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *[rng.randrange(0, 600_000, 900) for _ in range(6)]]), rng.choice("xy")) for _ in range(n)]
    # Exactly the gap apart, just above it, over the end of a day, and a session of several days.
    events += [("c", s, "x") for s in (0, 1800, 3600.000001, 86_300, 86_400, 86_400 + 1800)]
    events += [("d", 1000 + 1700 * k, "y") for k in range(200)]
    return events


@pytest.mark.parametrize("slice_seconds", [3_600, 86_400])
def test_gap_sessions_equal_brute_force(spark, slice_seconds):
    events = gap_events()
    df = spark.createDataFrame([(u, at(s), k) for u, s, k in events], "user string, ts timestamp, kind string")
    got = gap_sessions(df, ["user"], "ts", 1800, {"n_x": F.col("kind") == "x"}, slice_seconds)
    assert sorted(map(tuple, got.select("user", "session_number", "session_start_ts", "session_end_ts", "events", "n_x").collect()), key=str) == brute_sessions(events, 1800)
    assert got.filter("user = 'd'").count() == 1 and got.filter("user = 'c'").count() == 3


def test_a_heavy_user_is_reduced_by_day_first(spark):
    """The rows that meet per key are runs of a day, however many events there are."""
    df = spark.range(50_000).select(F.lit("hot").alias("user"), F.timestamp_seconds(F.col("id") * 20).alias("ts"))
    out = gap_sessions(df, ["user"], "ts")
    assert [tuple(r)[1:] for r in out.select("user", "session_number", "events").collect()] == [(1, 50_000)]
    text = plan(out)
    assert text.count("MergingSessions") >= 1 and "_slice" in text


def test_a_stream_gives_the_sessions_of_the_batch(spark):
    """Several micro-batches, and a restart from the checkpoint between them."""
    events = sorted((e for e in gap_events() if e[1] is not None), key=lambda e: e[1])
    rows = [(u, at(s), k) for u, s, k in events] + [("end", at(10**7), "y")]
    schema = "user string, ts timestamp, kind string"
    source, target, progress = (work_path(spark, f"gap-{n}") for n in ("source", "target", "progress"))
    cut = len(rows) // 2
    for part in (rows[:cut], rows[cut:-1], rows[-1:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        found = gap_session_stream(read, ["user"], "ts", 1800, "1 hour", {"n_x": F.col("kind") == "x"})
        found.writeStream.format("parquet").outputMode("append").option("checkpointLocation", progress).trigger(availableNow=True).start(target).awaitTermination()
    got = spark.read.parquet(target).select("user", "session_start_ts", "session_end_ts", "events", "n_x").collect()
    want = [(u, a, b, n, x) for u, _, a, b, n, x in brute_sessions(events, 1800)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
