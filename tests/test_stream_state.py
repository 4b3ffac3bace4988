"""Streams with state: page flow with timers and late views, purchases with carts."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from shoptrail.operators.flow import page_flow
from shoptrail.session import work_path
from shoptrail.streaming import flow as S
from shoptrail.streaming import joins

START = dt.datetime(2024, 1, 1)
VIEWS = "source string, user_fk string, ga_session_id string, pageview_pk string, pageview_ts timestamp, page_location string"


def view(user, session, minute, n):
    return ("ga4", user, session, f"pk{n:04}", None if minute is None else START + dt.timedelta(minutes=minute), f"/p{n}")


def run_batches(spark, parts):
    """Each part is a file and a batch of its own; the stream is started anew for each, from its checkpoint."""
    source, target, progress = (work_path(spark, f"flow-{n}") for n in ("source", "target", "progress"))
    for part in parts:
        spark.createDataFrame(part, VIEWS).coalesce(1).write.mode("append").parquet(source)
        read = spark.readStream.schema(VIEWS).parquet(source)
        S.write_flow(S.page_flow_stream(read), target, progress).awaitTermination()
    return spark.read.parquet(target)


def test_several_batches_equal_the_batch_fact_and_late_views_are_kept(spark):
    rng = random.Random(1)
    views, n = [], 0
    for s in range(40):
        minute = rng.randrange(0, 3000, 10)
        for _ in range(rng.choice([1, 2, 5, 9])):
            views.append(view(f"u{s % 7}", f"s{s}", minute, n := n + 1))
            minute += rng.choice([0, 1, 29])
    views.sort(key=lambda v: v[4])
    ordered = [views[:60], views[60:120], views[120:]]
    rng.shuffle(ordered[1])
    end = [view("end", "end", 10**6, 9998)]
    late = [view("u0", "s0", 1, 9001), view("new", "long ago", 5, 9002), view("u1", None, 7, 9003), view("u1", "s1", None, 9004)]
    got = run_batches(spark, [*ordered, end, late])
    flow = got.filter("kind = 'flow'").drop("kind", "batch")
    want = page_flow(spark.createDataFrame(views, VIEWS)).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pageview_ts", "next_page_ts")})
    names = want.columns
    assert sorted(map(tuple, flow.select(*names).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert sorted(r.pageview_pk for r in got.filter("kind = 'late'").collect()) == ["pk9001", "pk9002"]


def test_a_late_view_of_an_open_session_joins_it(spark):
    """It comes behind the watermark, but its session has not ended."""
    parts = [[view("u", "s", 0, 1), view("u", "s", 20, 2)], [view("v", "t", 100, 3)], [view("u", "s", 10, 4)], [view("end", "end", 10**6, 5)]]
    got = run_batches(spark, parts)
    assert [(r.pageview_pk, r.page_number_in_session, r.previous_page_location) for r in got.filter("user_fk = 'u'").orderBy("pageview_ts").collect()] == [("pk0001", 1, None), ("pk0004", 2, "/p1"), ("pk0002", 3, "/p4")]
    assert got.filter("kind = 'late'").count() == 0


def test_a_view_after_the_end_is_late_though_the_timer_runs_after_it(spark):
    """The batch that lets the watermark pass the session's end brings one more view of it."""
    parts = [[view("u", "s", 0, 1)], [view("end", "end", 10**6, 2)], [view("u", "s", 5, 3)], [view("u", "s", 6, 4)]]
    got = {r.pageview_pk: (r.kind, r.total_pages_in_session) for r in run_batches(spark, parts).collect()}
    assert got == {"pk0001": ("flow", 1), "pk0003": ("late", None), "pk0004": ("late", None)}


# ------------------------------------------------------- purchases with carts
def item(pk, user, item_id, minute):
    return (pk, user, item_id, None if minute is None else START + dt.timedelta(minutes=minute))


def join_batches(spark, parts):
    """Files of both streams arrive together; the query is started anew from its checkpoint for each."""
    bought, put, target, progress = (work_path(spark, f"join-{n}") for n in ("bought", "put", "target", "progress"))
    kinds = ("purchase_pk string, user_fk string, item_id string, purchase_ts timestamp", "add_to_cart_pk string, user_fk string, item_id string, add_to_cart_ts timestamp")
    for pair in parts:
        for rows, kind, path in zip(pair, kinds, (bought, put), strict=True):
            spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(path)
        streams = [spark.readStream.schema(kind).parquet(path) for kind, path in zip(kinds, (bought, put), strict=True)]
        out = joins.purchases_with_carts(*streams, within="1 hour", purchase_delay="10 minutes", cart_delay="10 minutes")
        out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", progress).trigger(availableNow=True).start(target).awaitTermination()
    return sorted(((r.purchase_pk, r.add_to_cart_pk) for r in spark.read.parquet(target).collect()), key=str)


def test_outer_rows_come_out_once_and_bounds_hold(spark):
    parts = [
        ([item("p1", "u", "a", 60), item("p2", "u", "b", 60)], [item("c1", "u", "a", 0), item("c2", "u", "a", 30), item("c3", "v", "a", 30)]),
        # A cart that comes after its purchase was read, one just too old, one after the purchase; and a purchase of no user.
        ([item("p3", "u", "a", 62), item("p4", None, "a", 62)], [item("c4", "u", "b", 59), item("c5", "u", "a", 61)]),
        ([item("end", "end", "end", 10**6)], [item("end", "end", "end", 10**6)]),
        # Behind both watermarks: left out.
        ([item("p5", "u", "a", 63)], [item("c6", "u", "a", 60)]),
    ]
    got = [r for r in join_batches(spark, parts) if r[0] != "end"]
    assert got == [("p1", "c1"), ("p1", "c2"), ("p2", "c4"), ("p3", "c2"), ("p3", "c5"), ("p4", None)]



# ------------------------------------------------------------- calls per bucket
def test_state_is_called_per_bucket_and_not_per_session(spark):
    """Sessions of one bucket share its calls, its timer and its state; users may be NULL."""
    views = [view(None if n % 3 == 0 else f"u{n % 5}", f"s{n % 200}", n // 200 * 10, n) for n in range(1000)]
    seen = []

    class Handle:
        def getListState(self, name, schema):
            return Held()

        getValueState = getListState

        def registerTimer(self, at):
            seen.append(at)

        def deleteTimer(self, at):
            seen.remove(at)

    class Held:
        def __init__(self):
            self.values = []

        def exists(self):
            return bool(self.values)

        def get(self):
            return self.values if self.is_list else self.values[0]

        is_list = False

        def appendValue(self, value):
            self.is_list = True
            self.values.append(value)

        def put(self, values):
            self.values = list(values)

        def update(self, value):
            self.values = [value]

        def clear(self):
            self.values = []

    class Clock:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

    names = VIEWS.replace(" timestamp", "").replace(" string", "").split(", ")
    rows = pd.DataFrame(views, columns=names)
    state = S.Sessions(30 * 60_000, 7 * 86_400_000)
    state.init(Handle())
    assert list(state.handleInputRows((0,), iter([rows[:500], rows[500:]]), Clock(0))) == []
    assert len(seen) == 1
    out = pd.concat(state.handleExpiredTimer((0,), Clock(10**15), None))
    seen.clear()
    keys = list(S.KEYS)
    assert sorted(out["pageview_pk"]) == sorted(rows["pageview_pk"])
    sizes = rows.groupby(keys, dropna=False)["pageview_pk"].size()
    assert sorted(out.groupby(keys, dropna=False)["total_pages_in_session"].first()) == sorted(sizes)
    assert (out.groupby(keys, dropna=False)["page_number_in_session"].max() == out.groupby(keys, dropna=False)["total_pages_in_session"].first()).all()
    again = pd.concat(state.handleInputRows((0,), iter([rows[:200]]), Clock(0)))
    assert set(again["kind"]) == {"late"} and len(again) == 200
