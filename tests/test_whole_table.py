"""Ranks over all rows, exact cubes, rolling counts and states of days: ties, missing values, plans."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shoptrail.operators.activity import rolling_activity
from shoptrail.operators.cubes import distinct_cube
from shoptrail.operators.ranks import numbered, ranked
from shoptrail.operators.sketches import daily_states, over_ranges
from shoptrail.plans import segments
from shoptrail.session import work_path


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def by_sql(spark, df, descending, tiles):
    """The same by window functions over all rows."""
    df.createOrReplaceTempView("ranked_rows")
    order = "value desc" if descending else "value"
    return spark.sql(f"""select id, value, row_number() over (order by {order}, id) as row_number, rank() over (order by {order}) as rank,
        percent_rank() over (order by {order}) as percent_rank, ntile({tiles}) over (order by {order}, id) as tile from ranked_rows""")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize(("n", "ranges", "tiles"), [(1, 3, 5), (3, 4, 5), (47, 7, 5), (500, 13, 7), (500, 1, 4)])
def test_ranks_equal_window_functions(spark, descending, n, ranges, tiles):
    rng = random.Random(n)
    # Over half of all rows share one value, so it is cut over ranges; some have none.
    rows = [(i, rng.choice([None, 0.0, 0.0, 0.0, 0.0, float(rng.randrange(6)), rng.random()])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, value double")
    got = ranked(df, "value", "id", descending, tiles, ranges=ranges)
    assert sorted(map(tuple, got.select("id", "value", "row_number", "rank", "percent_rank", "tile").collect()), key=str) == sorted(map(tuple, by_sql(spark, df, descending, tiles).collect()), key=str)


def test_ranks_of_equal_rows_and_none(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(40)], "id long, value double")
    out = ranked(df, "value", "id", tiles=4, ranges=9)
    assert {r["rank"] for r in out.collect()} == {1} and sorted(r.row_number for r in out.collect()) == list(range(1, 41))
    assert ranked(df.limit(0), "value", "id", tiles=4).collect() == []


def test_no_window_over_all_rows(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.rand(1)).alias("value"))
    text = plan(ranked(df, "value", "id", tiles=5))
    assert "SinglePartition" not in text and "Join" not in text


def test_numbers_without_gaps(spark):
    df = spark.range(1000).select((F.col("id") % 77).cast("string").alias("user")).unionByName(spark.createDataFrame([(None,)], "user string"))
    got = {r["user"]: r["n"] for r in numbered(df, "user", "n").collect()}
    assert sorted(got.values()) == list(range(77)) and None not in got


def test_cube_equals_distinct_counts(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["x", "y", None]), rng.choice(["m", "d", None]), rng.choice(["hot", "hot", None, *[f"u{k}" for k in range(60)]]), rng.choice("abc")) for _ in range(900)]
    rows += [("z", "m", None, "a"), (None, None, None, "b")]
    df = spark.createDataFrame(rows, "source string, device string, user string, kind string")
    counted = {"users": F.lit(True), "with_a": F.col("kind") == "a", "with_b": F.col("kind") == "b"}
    got = distinct_cube(df, ["source", "device"], "user", counted)
    want = df.cube("source", "device").agg(
        F.grouping_id().cast("long").alias("grouping_id"), F.countDistinct("user").alias("users"),
        *[F.countDistinct(F.when(F.col("kind") == k, F.col("user"))).alias(f"with_{k}") for k in "ab"],
    )
    names = ["source", "device", "grouping_id", "users", "with_a", "with_b"]
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(map(tuple, want.select(*names).collect()), key=str)
    assert got.filter("source = 'z' and device = 'm'").first()["users"] == 0


def test_cube_numbers_over_one_bitmap(spark):
    """Ids beyond the first 32768 are counted in further bitmaps."""
    df = spark.range(100_000).select((F.col("id") % 70_000).alias("user"), (F.col("id") % 2).alias("source"))
    got = {(r["source"], r["grouping_id"]): r["users"] for r in distinct_cube(df, ["source"], "user", {"users": F.lit(True)}).collect()}
    assert got == {(None, 1): 70_000, (0, 0): 35_000, (1, 0): 35_000}


def test_cube_copies_reduced_rows_only(spark):
    df = spark.range(5000).select((F.col("id") % 100).alias("user"), (F.col("id") % 3).alias("source"), (F.col("id") % 2).alias("device"))
    text = plan(distinct_cube(df, ["source", "device"], "user", {"users": F.lit(True)}))
    expand = text.index("Expand [")
    assert "bitmap_construct_agg" in text[expand:] and "bitmap_construct_agg" not in text[:expand]


# ----------------------------------------------------------- rolling activity
def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_rolling_activity_equals_brute_force(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["x", "y", None]), rng.choice([None, *range(0, 20), *range(90, 120)]), rng.choice(["hot", "hot", "hot", None, "a", "b", "c"])) for _ in range(250)]
    rows += [("x", n, "daily") for n in range(120)]
    rows += [("z", 5, "once"), ("z", 5 + 7, "once"), ("z", 5 + 7 + 6, "once")]  # a pause of just the frame, and one day less
    df = spark.createDataFrame([(g, day(n), u, 1) for g, n, u in rows], "source string, day date, user string, rows int")
    got = rolling_activity(df.drop("rows"), ["source"], "day", "user", "rows", (7, 28))
    want = []
    for g in {g for g, *_ in rows}:
        own = [(n, u) for h, n, u in rows if h == g and n is not None]
        for d in range(min(n for n, _ in own), max(n for n, _ in own) + 1):
            held = {k: [u for n, u in own if d - k < n <= d] for k in (1, 7, 28)}
            users = {k: len({u for u in v if u is not None}) for k, v in held.items()}
            want.append((g, day(d), len(held[1]), users[1], len(held[7]), len(held[28]), users[7], users[28]))
    names = ["source", "day", "rows", "users", "rows_7d", "rows_28d", "users_7d", "users_28d"]
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want, key=str)


def test_rolling_activity_has_no_frame_over_rows(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("string").alias("source"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 50).cast("int")).alias("day"), F.lit("hot").alias("user"))
    out = rolling_activity(df, ["source"], "day", "user")
    assert "SinglePartition" not in plan(out) and "NestedLoop" not in plan(out)
    assert {r["users_28d"] for r in out.collect()} == {1}
    assert rolling_activity(df.limit(0), ["source"], "day", "user").collect() == []


# -------------------------------------------------------------- states of days
def test_states_answer_any_range_without_rows(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), day(rng.randrange(60)), f"u{rng.randrange(9000)}", rng.choice([None, float("nan"), rng.random() * 100])) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "source string, day date, user string, lcp double")
    path = work_path(spark, "states")
    daily_states(df, ["source"], "day", ["user"], ["lcp"]).write.parquet(path)
    states = spark.read.parquet(path)  # from here on no row is read
    ranges = [("all", 0, 59), ("week", 10, 16), ("day", 20, 20), ("never", 90, 95), ("overlap", 12, 30)]
    table = spark.createDataFrame([(n, day(a), day(b)) for n, a, b in ranges], "range_name string, range_from date, range_to date")
    out = over_ranges(states, table, ["source"], "day", ["user"], {"lcp": [0.5, 0.75]})
    assert "user_state" in states.columns and set(out.columns) >= {"days", "row_count", "user_estimate", "lcp_p50", "lcp_p75"}
    got = {(r.range_name, r.source): r for r in out.collect()}
    assert set(got) == {(n, s) for n, *_ in ranges if n != "never" for s in "xy"}
    for name, a, b in ranges:
        for s in "xy" if name != "never" else "":
            held = [r for r in rows if r[0] == s and day(a) <= r[1] <= day(b)]
            users = len({r[2] for r in held})
            values = sorted(r[3] for r in held if r[3] is not None and r[3] == r[3])
            r = got[name, s]
            assert r.row_count == len(held) and r.days == len({h[1] for h in held})
            assert abs(r.user_estimate - users) <= max(1, 0.03 * users)
            for q in (50, 75):
                assert abs(sum(v <= r[f"lcp_p{q}"] for v in values) / len(values) - q / 100) < 0.02


def test_states_of_nothing_known(spark):
    df = spark.createDataFrame([("x", day(0), None, None), ("x", None, "u", 1.0)], "source string, day date, user string, lcp double")
    ranges = spark.createDataFrame([("d", day(0), day(3))], "range_name string, range_from date, range_to date")
    out = over_ranges(daily_states(df, ["source"], "day", ["user"], ["lcp"]), ranges, ["source"], "day", ["user"], {"lcp": [0.75]}).collect()
    assert [(r.row_count, r.user_estimate, r.lcp_p75) for r in out] == [(1, 0, None)]


def test_quintiles(spark):
    users = spark.createDataFrame([(f"u{i}", i, 100 - i, float(i // 50)) for i in range(100)], "user_pk string, days_since_last_visit long, total_sessions long, total_revenue double")
    got = {r.user_pk: r for r in segments.rfm_quintiles(users).collect()}
    assert got["u0"].rfm[:2] == "55" and got["u99"].rfm[:2] == "11"
    assert got["u49"].monetary_percent_rank == 0 and got["u50"].monetary_percent_rank == 50 / 99
