from __future__ import annotations

from shoptrail import schemas
from shoptrail.plans import facts, integration, staging
from shoptrail.session import work_path
from shoptrail.sources import tables
from shoptrail.streaming import load
from tests.feeds import ga4, ga4_frame, same_rows

KEYS = ["source", "event_date", "user_fk", "ga_session_id"]
FIRST = [ga4("u", "2024-01-01 23:50:00", "page_view", 1, 0), ga4("v", "2024-01-01 10:00:00", "purchase", 2, 1)]
SECOND = [ga4("u", "2024-01-01 23:59:00", "purchase", 1, 2), ga4("u", "2024-01-02 00:10:00", "page_view", 1, 3)]


def test_sessions_arriving_in_parts_equal_the_batch(spark):
    source, target, progress = (work_path(spark, n) for n in ("feed", "sessions", "progress"))
    for rows in (FIRST, SECOND):
        ga4_frame(spark, rows).write.mode("append").parquet(source)
        events = staging.stage_ga4_event(load.read_feed(spark, source, schemas.GA4_EVENTS, files_per_batch=1))
        stream = load.merge_stream(load.ga4_session_stream(events), target, KEYS, progress, mode="update")
        stream.awaitTermination()
    batch = staging.stage_ga4_event(ga4_frame(spark, FIRST + SECOND))
    same_rows(
        facts.session_fct(tables.read_table(spark, target)),
        facts.session_fct(integration.unify_sessions(spark, batch)),
    )


def test_copies_are_dropped_within_and_across_batches(spark):
    source, target, progress = (work_path(spark, n) for n in ("feed", "events", "progress"))
    for rows in (FIRST + FIRST, FIRST + SECOND):
        ga4_frame(spark, rows).write.mode("append").parquet(source)
        events = staging.stage_ga4_event(load.read_feed(spark, source, schemas.GA4_EVENTS))
        stream = load.merge_stream(load.without_copies(events), target, ["event_pk"], progress)
        stream.awaitTermination()
    stored = tables.read_table(spark, target)
    assert stored.count() == stored.select("event_pk").distinct().count() == 4


def test_a_batch_merged_twice_changes_nothing(spark):
    target = work_path(spark, "events")
    events = staging.stage_ga4_event(ga4_frame(spark, FIRST))
    for _ in range(2):
        load.merge_batch(events, target, ["event_pk"], ("event_name",))
    assert tables.read_table(spark, target).count() == 2
