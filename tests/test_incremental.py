from __future__ import annotations

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from shoptrail.config import Options
from shoptrail.operators import quality, upsert
from shoptrail.plans import facts, integration, staging
from shoptrail.plans.run import FACTS, Feeds, Run, _one_each, published, run_all
from shoptrail.session import work_path
from shoptrail.sources import readers, tables
from tests.feeds import cs_frame, ga4, ga4_frame, param, same_rows, snowplow, snowplow_frame

NULL_SESSIONS = [
    f"{model}.ga_session_id.not_null"
    for model in ("int__pageview", "int__add_to_cart", "int__purchase", "int__product_view", "pageview_fct")
]
AS_OF = dt.date(2024, 2, 1)


def day_frame(spark, rows):
    return spark.createDataFrame(rows, "event_date date, key string, value int")


D = [dt.date(2024, 1, n) for n in range(1, 10)]


# ---------------------------------------------------------------------- marks
def test_marks_are_kept_per_source(spark):
    rows = spark.createDataFrame([("a", D[0]), ("a", D[4]), ("b", D[1])], "source string, event_date date")
    marks = upsert.high_water_marks(rows)
    assert marks == {"a": D[4], "b": D[1]}
    new = spark.createDataFrame([(s, d) for s in "abc" for d in D[:6]], "source string, event_date date")
    fresh = upsert.newer_than(new, marks).groupBy("source").agg(F.min("event_date"), F.count(F.lit(1)))
    assert {r[0]: (r[1], r[2]) for r in fresh.collect()} == {"a": (D[5], 1), "b": (D[2], 4), "c": (D[0], 6)}
    again = upsert.newer_than(new, marks, lookback_days=2).filter("source = 'a'")
    assert sorted(r.event_date for r in again.collect()) == D[3:6]


def test_missing_or_empty_target_filters_nothing(spark):
    empty = day_frame(spark, [])
    assert upsert.high_water_marks(None) == upsert.high_water_marks(empty) == {}
    rows = day_frame(spark, [(D[0], "x", 1)])
    assert upsert.newer_than(rows, {}).count() == 1


# ---------------------------------------------------------------------- merge
def test_merge_replaces_adds_and_moves(spark):
    path = tables.table_path(work_path(spark, "t"), "warehouse", "t")
    tables.write_days(day_frame(spark, [(D[0], "a", 1), (D[0], "b", 1), (D[1], "c", 1), (D[2], "d", 1)]), path)
    target = tables.read_table(spark, path).select("event_date", "key", "value")
    new = day_frame(spark, [(D[0], "b", 2), (D[3], "e", 2), (D[3], "c", 2)])
    merge = upsert.merge_by_key(target, new, ["key"])
    assert merge.days == (D[0], D[1], D[3])
    assert sorted(tuple(r) for r in merge.rows.collect()) == [(D[0], "a", 1), (D[0], "b", 2), (D[3], "c", 2), (D[3], "e", 2)]


def test_null_keys_do_not_pile_up(spark):
    target, new = day_frame(spark, [(D[0], None, 1)]), day_frame(spark, [(D[0], None, 2)])
    merge = upsert.merge_by_key(target, new, ["event_date", "key"])
    assert [r.value for r in merge.rows.collect()] == [2]


def test_a_day_that_loses_its_rows_is_removed(spark):
    run = Run(spark, work_path(spark, "t"), "incremental", Options())
    run.publish("warehouse", "t", day_frame(spark, [(D[0], "a", 1), (D[1], "b", 1)]), ["key"])
    run.publish("warehouse", "t", day_frame(spark, [(D[2], "a", 2)]), ["key"])
    assert sorted(tuple(r) for r in run.table("warehouse", "t").select("event_date", "key", "value").collect()) == [
        (D[1], "b", 1), (D[2], "a", 2)]


def test_one_row_per_key_takes_the_newest(spark):
    rows = day_frame(spark, [(D[0], "a", 1), (D[2], "a", 3), (D[1], "a", 2), (D[0], None, 1)] + [(D[0], "b", 7)] * 50)
    got = upsert.one_per_key(rows, ["key"], ["event_date"]).collect()
    assert sorted((str(r.key), r.event_date, r.value) for r in got) == [("None", D[0], 1), ("a", D[2], 3), ("b", D[0], 7)]


def test_only_events_that_come_again_are_compared(spark):
    """F8: all rows of a feed were shuffled and sorted to look for copies, also where there are none."""
    run = Run(spark, work_path(spark, "t"), "full", Options())
    columns = "event_pk string, event_ts timestamp, name string"
    once = spark.createDataFrame([(k, dt.datetime(2024, 1, 1), "n") for k in ("a", "b", None)], columns)
    again = once.unionByName(spark.createDataFrame([(k, dt.datetime(2024, 1, d), f"n{d}") for k in ("b", None) for d in (1, 3, 2)], columns))
    with run.work_files():
        assert _one_each(run, once) is once
        got = _one_each(run, again)
        want = upsert.one_per_key(again, ["event_pk"], ["event_ts"])
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 3
        assert _one_each(run, once.limit(0)).count() == 0


def test_replaced_days_are_written_and_others_kept(spark):
    path = tables.table_path(work_path(spark, "t"), "warehouse", "t")
    tables.write_days(day_frame(spark, [(D[0], "a", 1), (D[1], "b", 1)]), path)
    tables.replace_days(day_frame(spark, [(D[1], "c", 2)]), path)
    assert sorted(tuple(r) for r in tables.read_table(spark, path).select("key", "value").collect()) == [("a", 1), ("c", 2)]
    assert tables.read_table(spark, path + "-missing") is None
    with pytest.raises(ValueError, match="unknown layer"):
        tables.table_path("/x", "gold", "t")


# ------------------------------------------------------------------ whole runs
def sample(spark, until=None):
    """A few days of three feeds: sessions over midnight, views without session, several sources."""
    rng = random.Random(5)
    web, app, views, clicks = [], [], [], []
    for n in range(160):
        day = rng.randrange(1, 7)
        ts = f"2024-01-{day:02d} {rng.choice([0, 9, 23]):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}"
        user = rng.choice(["u1", "u2", "u3"])
        name = rng.choice(["page_view", "page_view", "view_item", "add_to_cart", "begin_checkout", "purchase"])
        session = rng.choice([11, 12, None])
        if until is not None and day > until:
            continue
        items = [{"item_id": f"i{n % 4}", "price": 2.0, "quantity": 1, "item_revenue_in_usd": 2.0}] * (n % 3)
        web.append(ga4(user, ts, name, session, n, params=[param("page_location", f"https://a.b/{n % 5}")], items=items,
                       ecommerce={"purchase_revenue_in_usd": float(n)}))
        app.append(snowplow(f"e{n}", user, ts, name, "11", ecommerce={"value": float(n), "items": []}, device={"category": "desktop"}))
        views.append({"event_id": str(n), "user_id": user, "session_id": "11", "time": ts, "path": f"/{n % 5}", "view_number": "1"})
        clicks.append({"event_id": str(n), "user_id": user, "session_id": "11", "time": ts, "frustration_score": n, "value": 4})
    return Feeds(
        ga4=ga4_frame(spark, web), snowplow=snowplow_frame(spark, app),
        contentsquare={"pageviews": cs_frame(spark, "pageviews", views), "rage_click": cs_frame(spark, "rage_click", clicks)},
    )


@pytest.fixture(scope="module")
def full(spark):
    root = work_path(spark, "full")
    run = run_all(spark, sample(spark), root, options=Options(as_of=AS_OF), warn_only=NULL_SESSIONS)
    return root, run


def test_full_run_publishes_and_tests_every_table(spark, full):
    root, run = full
    found = published(spark, root)
    assert set(found) == set(FACTS) - {
        "js_error_fct", "user_interaction_fct", "cs_purchase_fct", "api_error_fct", "excessive_hovering_fct"}
    assert all(df.count() > 0 for df in found.values())
    by_status = {r["status"] for r in run.results}
    assert by_status == {"pass", "warn"}
    assert spark.table("users").columns[0] == "user_pseudo_id"
    assert spark.table("sessions").count() == found["session_fct"].count()


def test_day_by_day_gives_the_full_run(spark, full):
    root = work_path(spark, "daily")
    for day in (3, 6):
        run_all(spark, sample(spark, until=day), root, "incremental", Options(as_of=AS_OF), NULL_SESSIONS)
    wanted, got = published(spark, full[0]), published(spark, root)
    for name in wanted:
        same_rows(got[name], wanted[name])


def test_loading_the_last_days_again_changes_nothing(spark):
    root = work_path(spark, "twice")
    feeds = Feeds(ga4=sample(spark).ga4)
    run_all(spark, feeds, root, "full", Options(as_of=AS_OF), NULL_SESSIONS)
    wanted = {name: spark.createDataFrame(df.collect(), df.schema) for name, df in published(spark, root).items()}
    run_all(spark, feeds, root, "incremental", Options(as_of=AS_OF, lookback_days=2), NULL_SESSIONS)
    got = published(spark, root)
    for name in wanted:
        same_rows(got[name], wanted[name])


def test_whole_sessions_grow_with_later_days(spark):
    root, options = work_path(spark, "whole"), Options(as_of=AS_OF, session_grain="session")
    rows = [ga4("u", f"2024-01-0{n} 10:00:00", "page_view", 1, n) for n in (1, 2, 3)] + [ga4("v", "2024-01-02 10:00:00", "page_view", 2)]
    for until in ("20240101", "20240102", "20240103"):
        feeds = Feeds(ga4=ga4_frame(spark, [r for r in rows if r["event_date"] <= until]))
        run_all(spark, feeds, root, "incremental", options)
    got = published(spark, root)["session_fct"].collect()
    assert sorted((r.user_fk, r.event_date, r.events_per_session) for r in got) == [("u", D[0], 3), ("v", D[1], 1)]


def late_feeds(spark, late):
    rows = [ga4("u", "2024-01-01 10:00:00", "page_view", 1, 0), ga4("u", "2024-01-02 10:00:00", "page_view", 1, 1)]
    if late:
        rows += [ga4("u", "2024-01-02 11:00:00", "page_view", 1, 2), ga4("u", "2024-01-03 10:00:00", "page_view", 2, 3)]
    return Feeds(ga4=ga4_frame(spark, rows))


@pytest.mark.parametrize(("lookback", "views"), [(0, 3), (1, 4)])
def test_late_rows_need_a_lookback(spark, lookback, views):
    root = work_path(spark, "late")
    options = Options(lookback_days=lookback, as_of=AS_OF)
    for late in (False, True):
        run_all(spark, late_feeds(spark, late), root, "incremental", options)
    pages = published(spark, root)["pageview_fct"]
    assert pages.count() == views
    assert pages.filter("ga_session_id = '1'").first().total_pages_in_session == views - 1


def test_events_delivered_again_count_once(spark):
    row = ga4("u", "2024-01-01 10:00:00", "page_view", 1)
    feeds = Feeds(ga4=ga4_frame(spark, [row] * 30))
    root = work_path(spark, "copies")
    run_all(spark, feeds, root, options=Options(as_of=AS_OF))
    assert published(spark, root)["session_fct"].first().events_per_session == 1
    with pytest.raises(quality.GateError, match="stg_ga4__event.event_pk.unique"):
        run_all(spark, feeds, work_path(spark, "copies"), options=Options(drop_copies=False))


def test_an_earlier_first_visit_that_comes_later_is_repaired(spark):
    """A source that lags behind brings a visit before the known first one: loads in parts give the full run."""
    items = [{"item_id": "i", "price": 2.0, "quantity": 1, "item_revenue_in_usd": 2.0}]
    web = []
    for user in ("u1", "u2"):
        web += [ga4(user, "2024-01-10 10:00:00", "page_view", 1, 0), ga4(user, "2024-01-10 12:00:00", "purchase", 1, 1, items=items, ecommerce={"purchase_revenue_in_usd": 2.0})]
    app = [snowplow("e1", "u1", "2024-01-05 09:30:00", "page_view", "s1")]
    root, whole = work_path(spark, "lag"), work_path(spark, "whole")
    parts = (Feeds(ga4=ga4_frame(spark, web)), Feeds(ga4=ga4_frame(spark, web), snowplow=snowplow_frame(spark, app)))
    for feeds in parts:
        run_all(spark, feeds, root, "incremental", Options(as_of=AS_OF), NULL_SESSIONS)
    run_all(spark, parts[-1], whole, options=Options(as_of=AS_OF), warn_only=NULL_SESSIONS)
    got = published(spark, root)["purchase_fct"]
    assert {r.user_fk: r.hours_to_purchase_from_first_visit for r in got.collect()} == {"u1": 122, "u2": 2}
    same_rows(got, published(spark, whole)["purchase_fct"])


def test_a_table_is_there_until_the_new_one_is_written(spark, tmp_path):
    """A rebuild that fails leaves the old content; one that succeeds leaves nothing beside it."""
    path = f"file://{tmp_path}/warehouse/t"
    for write in (tables.write_whole, tables.write_days):
        write(day_frame(spark, [(D[0], "old", 1), (D[1], "old", 1)]), path)
        with pytest.raises(Exception, match="divide|DIVIDE|zero"):
            write(day_frame(spark, [(D[0], "new", 0)]).withColumn("value", F.expr("cast(1 / value as int)")), path)
        assert {r.key for r in tables.read_table(spark, path).collect()} == {"old"}
        write(day_frame(spark, [(D[2], "new", 2)]), path)
        assert {(r.event_date, r.key) for r in tables.read_table(spark, path).collect()} == {(D[2], "new")}
    assert [p.name for p in (tmp_path / "warehouse").iterdir()] == ["t"]


def test_work_files_go_when_a_test_fails(spark, tmp_path):
    spark_root = f"{tmp_path}/tables"
    run = Run(spark, spark_root, "full", Options())
    paths = []
    with pytest.raises(RuntimeError), run.work_files():
        kept = run.written(day_frame(spark, [(D[0], "x", 1)]), "kept")
        with run.work_files():
            run.written(day_frame(spark, [(D[0], "y", 1)]), "inner")
            paths += run.used
        assert kept.count() == 1  # what the inner step wrote is gone, this is not
        paths += run.used
        raise RuntimeError
    assert len(paths) == 2 and run.used == []
    assert [tables.read_table(spark, path) for path in paths] == [None, None]


def _counted_copies(run, monkeypatch):
    copies = []
    written = run.written
    monkeypatch.setattr(run, "written", lambda df, name: (copies.append(name), written(df, name))[1])
    return copies


def test_a_load_writes_its_table_once(spark, tmp_path, monkeypatch):
    """F8, F11, F13: what is tested is what is published; a full load needs no copy, a merge one of its new rows."""
    run = Run(spark, str(tmp_path), "incremental", Options())
    copies = _counted_copies(run, monkeypatch)
    seen = []
    monkeypatch.setattr(run, "test", lambda name, df, wanted: seen.append(sorted(map(tuple, df.select("event_date", "key", "value").collect()))))
    first = [(D[0], "a", 1), (D[1], "b", 1), (D[2], "c", 1)]
    run.publish("warehouse", "t", day_frame(spark, first), ["key"], tests=[quality.not_null("key")])
    assert (copies, seen) == ([], [first])
    # One key moves to another day, so that its old day, which no row is left on, goes.
    run.publish("warehouse", "t", day_frame(spark, [(D[0], "b", 2), (D[3], "d", 2)]), ["key"], tests=[quality.not_null("key")])
    assert copies == ["t"]
    rows = run.table("warehouse", "t").select("event_date", "key", "value").collect()
    assert sorted(map(tuple, rows)) == [(D[0], "a", 1), (D[0], "b", 2), (D[2], "c", 1), (D[3], "d", 2)]
    assert seen[1] == [(D[0], "a", 1), (D[0], "b", 2), (D[3], "d", 2)]
    assert sorted(p.name for p in (tmp_path / "warehouse").iterdir()) == ["t"]
    assert not (tmp_path / "warehouse" / "t" / f"event_date={D[1]}").exists()


def _shuffle_files(spark):
    """Files of shuffles that the session still holds."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (blocks.apply(n).getName() for n in range(blocks.size())) if f.startswith("shuffle_")}


def test_a_run_leaves_no_shuffle_files(spark):
    """a statement's shuffle files go at its end, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old, before = spark.conf.get(name), _shuffle_files(spark)
    run_all(spark, late_feeds(spark, False), work_path(spark, "lean"), options=Options(as_of=AS_OF), warn_only=NULL_SESSIONS)
    assert spark.conf.get(name) == old
    for _ in range(50):  # they are deleted beside the run
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left


def test_rows_by_day_are_not_shuffled_again(spark, tmp_path):
    """a fact of one staged row each, read by day, is sorted and written; days and rows stay, also without a day."""
    staged, fact = str(tmp_path / "staged"), str(tmp_path / "fact")
    rows = [(day, key, n) for n, day in enumerate([*D, None]) for key in "ba"]
    tables.write_days(day_frame(spark, rows), staged, ("key",))
    laid = tables._laid_out(tables.read_table(spark, staged), ("key",), gathered=True)
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "Sort [event_date" in plan and "Exchange" not in plan
    tables.write_days(
        tables.read_table(spark, staged), fact, ("key",), gathered=True, shape=lambda df: df.withColumn("twice", F.col("value") * 2)
    )
    got = tables.read_table(spark, fact).select("event_date", "key", "value", "twice").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((day, key, n, 2 * n)) for day, key, n in rows)


def test_what_follows_from_a_row_is_made_after_its_shuffle(spark):
    """a projection given to the writer stands above the exchange by day."""
    laid = tables._laid_out(day_frame(spark, [(D[0], "a", 1)]), ("key",), shape=lambda df: df.withColumn("late", F.md5("key")))
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "md5" in plan[:plan.index("Exchange")] and "md5" not in plan[plan.index("Exchange"):]


def test_a_run_gives_the_page_views_of_the_fact(spark, full):
    """views written between the two shuffles, their URL parts after both: the rows are those of the fact's own plan."""
    feeds = sample(spark)
    unified = integration.unify_pageviews(
        spark, staging.stage_ga4_event(feeds.ga4), staging.stage_snowplow_event(feeds.snowplow),
        staging.stage_cs_pageview(feeds.contentsquare["pageviews"]),
    )
    wanted = facts.pageview_fct(unified)
    got = published(spark, full[0])["pageview_fct"].select(*wanted.columns)
    assert got.count() > 0
    same_rows(got, wanted)


def test_days_that_fail_their_test_stay_as_they_were(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_days(day_frame(spark, [(D[0], "a", 1), (None, "n", 1)]), path)

    def fails(df):
        raise quality.GateError(f"{df.count()} rows")

    with pytest.raises(quality.GateError, match="2 rows"):
        tables.exchange_days(day_frame(spark, [(D[0], "b", 2), (None, "m", 2)]), path, [D[0], None], test=fails)
    assert sorted(r.key for r in tables.read_table(spark, path).collect()) == ["a", "n"]
    tables.exchange_days(day_frame(spark, [(None, "m", 2)]), path, [D[0], None])
    assert [(r.event_date, r.key) for r in tables.read_table(spark, path).collect()] == [(None, "m")]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_failed_tests_leave_the_old_table(spark):
    root = work_path(spark, "gate")
    run_all(spark, late_feeds(spark, False), root, options=Options(as_of=AS_OF))
    before = published(spark, root)["session_fct"].count()
    bad = Feeds(ga4=ga4_frame(spark, [ga4("u", "2024-01-05 10:00:00", "page_view", 1, device={"category": "fridge"})]))
    with pytest.raises(quality.GateError, match="device_category.accepted_values"):
        run_all(spark, bad, root, "incremental", Options(as_of=AS_OF))
    assert published(spark, root)["session_fct"].count() == before
    with pytest.raises(ValueError, match="unknown mode"):
        run_all(spark, bad, root, "weekly")


def test_ga4_scan_opens_only_the_days_asked_for(spark):
    path = work_path(spark, "ga4")
    ga4_frame(spark, [ga4("u", f"2024-01-0{n} 10:00:00", "x", 1) for n in range(1, 6)]).write.partitionBy("event_date").parquet(path)
    days = readers.read_ga4(spark, path, "20240102", "20240103")
    assert days.count() == 2
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and ">= 20240102" in plan
