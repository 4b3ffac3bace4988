"""A run over all layers: stage, test, integrate, test, build facts, publish.

``mode='full'`` rebuilds every table. ``mode='incremental'`` loads the days
after each source's last loaded one and merges them by key. Every table is
written beside the published one and tested there; only a table that passed
replaces the published one, so a failed run leaves the old data in place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptrail.config import CONTENTSQUARE, Options
from shoptrail.operators import quality
from shoptrail.operators import upsert as up
from shoptrail.operators.flow import page_flow
from shoptrail.plans import checks, facts, integration, marts, staging
from shoptrail.session import lean_steps, use_utc, work_path
from shoptrail.sources import tables

FULL = "full"
INCREMENTAL = "incremental"
_CLUSTER = ("user_fk", "ga_session_id")


@dataclass(frozen=True)
class Feeds:
    """The raw frames of a run; a missing feed counts as switched off."""

    ga4: DataFrame | None = None
    snowplow: DataFrame | None = None
    contentsquare: dict[str, DataFrame] = field(default_factory=dict)


@dataclass
class Run:
    """What a run shares between its steps, and the test results it gathers.

    ``warn_only`` names tests whose failure is reported but stops nothing.
    """

    spark: SparkSession
    root: str
    mode: str
    options: Options
    warn_only: Collection[str] = ()
    results: list = field(default_factory=list)
    used: list[str] = field(default_factory=list)
    known_marks: dict[tuple[str, str], dict] = field(default_factory=dict)

    @property
    def incremental(self) -> bool:
        return self.mode == INCREMENTAL

    def path(self, layer: str, name: str) -> str:
        return tables.table_path(self.root, layer, name)

    def table(self, layer: str, name: str) -> DataFrame | None:
        return tables.read_table(self.spark, self.path(layer, name))

    def test(self, model: str, df: DataFrame, wanted: Sequence[quality.Check]) -> None:
        if not wanted:
            return
        results = quality.run_checks(model, df, wanted)
        excused = F.col("test_id").isin(list(self.warn_only)) & (F.col("status") == "fail")
        results = results.withColumn("status", F.when(excused, "warn").otherwise(F.col("status")))
        self.results += quality.gate(results)

    @contextmanager
    def work_files(self) -> Iterator[None]:
        """What is written to the work folder inside goes at its end, also if a test fails."""
        before, self.used = self.used, []
        try:
            yield
        finally:
            tables.remove(self.spark, self.used)
            self.used = before

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a written copy: computed once, and safe from lost executors."""
        path = work_path(self.spark, name)
        self.used.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def marks(self, layer: str, name: str) -> dict[str | None, dt.date]:
        """A table's marks before this run's load of it, read once."""
        if (layer, name) not in self.known_marks:
            self.known_marks[layer, name] = up.high_water_marks(self.table(layer, name))
        return self.known_marks[layer, name]

    def publish(
        self,
        layer: str,
        name: str,
        new: DataFrame,
        keys: Sequence[str],
        cluster: Sequence[str] = _CLUSTER,
        key_fixes_day: bool = False,
        replaced: Column | None = None,
        tests: Sequence[quality.Check] = (),
        gathered: bool = False,
        shape: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Write ``new`` beside the table, by day, test it there, then publish it (SNK-5, DQ-14).

        What is tested is the copy that takes the table's place: rows are written once. ``gathered`` tells that each
        row comes, under its own day, from a table by day; ``shape`` is a projection still to be made of ``new``.
        """
        path = self.path(layer, name)
        target = self.table(layer, name) if self.incremental else None

        def test(df: DataFrame) -> None:
            self.test(name, df, tests)

        if target is None:
            tables.write_days(new, path, cluster, test, gathered, shape)
            return
        with self.work_files():
            # Days, keys and rows of what is new are read from one copy.
            fresh = self.written(new if shape is None else shape(new), name)
            merge = up.merge_by_key(target, fresh, keys, key_fixes_day, replaced)
            if merge.days:
                tables.exchange_days(merge.rows, path, merge.days, cluster, test)

    def news(self, layer: str, name: str, rows: DataFrame, last_day: Column | None = None) -> tuple[DataFrame, Column | None]:
        """The rows to load into a table, and the target rows they replace.

        ``last_day`` is the day compared with the marks where a row goes on after its own day.
        """
        if not self.incremental:
            return rows, None
        marks = self.marks(layer, name)
        compared = rows
        if last_day is not None:
            compared = rows.withColumns({"_own_day": F.col(tables.DAY), tables.DAY: last_day})
        fresh = up.newer_than(compared, marks, self.options.lookback_days)
        if last_day is not None:
            fresh = fresh.withColumn(tables.DAY, F.col("_own_day")).select(*rows.columns)
        return fresh, replaced_days(marks, self.options.lookback_days)


def replaced_days(marks: dict[str | None, dt.date], lookback_days: int) -> Column | None:
    """Target rows a lookback loads again; those that do not come again go."""
    if lookback_days <= 0 or not marks:
        return None
    condition = F.lit(False)
    for source, mark in marks.items():
        again = F.col(tables.DAY) >= F.lit(mark + dt.timedelta(days=1 - lookback_days))
        condition = condition | (again if source is None else again & (F.col("source") == source))
    return condition


# --------------------------------------------------------------------- staging
_CS_STAGES: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "pageviews": ("stg_contentsquare__pageview", staging.stage_cs_pageview),
    "add_to_cart": ("stg_contentsquare__add_to_cart", staging.stage_cs_add_to_cart),
    "ecommerce_transactions": ("stg_contentsquare__purchase", staging.stage_cs_purchase),
    "rage_click": ("stg_contentsquare__rage_click", staging.stage_cs_rage_click),
    "excessive_hovering": ("stg_contentsquare__excessive_hovering", staging.stage_cs_excessive_hovering),
    "js_errors": ("stg_contentsquare__js_error", staging.stage_cs_js_error),
    "api_errors": ("stg_contentsquare__api_error", staging.stage_cs_api_error),
}


def _one_each(run: Run, events: DataFrame) -> DataFrame:
    """One row per event. Most events come once: keys that come again are looked for first, in their column
    alone, and only rows of these are shuffled and sorted to be compared."""
    if not run.options.drop_copies:
        return events
    repeated = run.written(up.repeated_keys(events, ["event_pk"]), "repeated_keys")
    return events if repeated.isEmpty() else up.one_of_repeated(events, repeated, ["event_pk"], ["event_ts"])


def _stored(run: Run, name: str, staged: DataFrame, cluster: Sequence[str]) -> DataFrame:
    """The staged table of a feed, with its new days loaded and tested."""
    rows, replaced = run.news("staging", name, staged)
    with run.work_files():
        run.publish("staging", name, _one_each(run, rows), ["event_pk"], cluster=cluster, replaced=replaced, tests=_tests(name))
    stored = run.table("staging", name)
    return staged.limit(0) if stored is None else stored.select(*staged.columns)


def stage_feeds(run: Run, feeds: Feeds) -> dict[str, DataFrame]:
    """Staged frames by name.

    A feed's rows after its last loaded day are picked first, then reduced to
    one per key, then written once: tests, integration and facts read that
    table. The two event feeds are sorted by event name, so that a reader of
    one event name skips the rest. ContentSquare sessions have one reader.
    """
    on = run.options.sources
    staged: dict[str, DataFrame] = {}
    event_feeds = {
        "stg_ga4__event": (on.ga4, feeds.ga4, partial(staging.stage_ga4_event, strict=run.options.strict_params)),
        "stg_snowplow__event": (on.snowplow, feeds.snowplow, staging.stage_snowplow_event),
    }
    for name, (enabled, raw, stage) in event_feeds.items():
        if enabled and raw is not None:
            staged[name] = _stored(run, name, stage(raw), ("event_name", "user_pseudo_id"))
    if on.contentsquare:
        for table, raw in feeds.contentsquare.items():
            if table == "sessions":
                staged["stg_contentsquare__session"] = staging.stage_cs_session(raw)
                continue
            name, stage = _CS_STAGES.get(table, (f"stg_contentsquare__{table}", partial(staging.stage_cs_signal, event_name=table)))
            staged[name] = _stored(run, name, stage(raw), ("user_pseudo_id",))
    return staged


# ----------------------------------------------------------------- integration
def integrate(run: Run, staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    spark, options = run.spark, run.options
    ga4, snowplow = staged.get("stg_ga4__event"), staged.get("stg_snowplow__event")
    return {
        "int__session": integration.unify_sessions(
            spark, ga4, snowplow, staged.get("stg_contentsquare__session"),
            staged.get("stg_contentsquare__purchase"), options,
        ),
        "int__pageview": integration.unify_pageviews(
            spark, ga4, snowplow, staged.get("stg_contentsquare__pageview"), options
        ),
        "int__add_to_cart": integration.unify_add_to_cart(spark, ga4, snowplow, options),
        "int__purchase": integration.unify_purchases(spark, ga4, snowplow, options),
        "int__product_view": integration.unify_product_views(spark, ga4, snowplow, options),
    }


# ----------------------------------------------------------------------- facts
def _tests(model: str) -> list[quality.Check]:
    declared = checks.declared_checks(model) if model in checks.DECLARED else []
    return [*declared, *checks.logical_checks(model)]


def _load(run: Run, name: str, rows: DataFrame, build: Callable[[DataFrame], DataFrame], keys: Sequence[str], last_day: Column | None = None, **how) -> None:
    """Load one fact from the rows after its own marks."""
    news, replaced = run.news("warehouse", name, rows, last_day)
    run.publish("warehouse", name, build(news), keys, replaced=replaced, tests=_tests(name), **how)


def load_pageviews(run: Run, pageviews: DataFrame) -> None:
    """Page views, with sessions that run over the load boundary numbered anew."""
    groups = ("source", "user_fk", "ga_session_id")
    news, replaced = run.news("warehouse", "pageview_fct", pageviews)
    target = run.table("warehouse", "pageview_fct") if run.incremental else None
    with run.work_files():
        if target is None:
            # Whole rows are shuffled by session, then by day. A copy between lets the first shuffle's files go before
            # the second one's come, and what follows from a row's own columns is made after both.
            rows = run.written(page_flow(facts.bare_pageviews(news)), "pageview_flow")
            run.publish(
                "warehouse", "pageview_fct", rows, ["pageview_pk"], tests=_tests("pageview_fct"),
                shape=lambda rows: facts.placed(facts.with_url_parts(rows, run.options)),
            )
            return
        # Read for its sessions, its keys and its rows.
        rows = run.written(facts.pageview_rows(news, run.options), "pageview_rows")
        kept, changed = target, rows.select(*groups)
        if replaced is not None:
            kept = target.filter(~F.coalesce(replaced, F.lit(False)))
            changed = changed.unionByName(target.filter(replaced).select(*groups))
        again = up.rows_of_groups(kept, changed, groups).select(*rows.columns)
        new_keys = rows.select("pageview_pk")
        again = again.join(new_keys, "pageview_pk", "left_anti")
        # Few rows: sessions over the boundary. The flow reads them twice, the new rows are written already.
        rows = rows.unionByName(run.written(again, "pageview_rows"))
        run.publish(
            "warehouse", "pageview_fct", facts.with_flow(rows), ["pageview_pk"],
            replaced=replaced, tests=_tests("pageview_fct"),
        )


def _session_load(run: Run) -> tuple[list[str], Column | None]:
    """The key of a session row, and the day it is compared by."""
    if run.options.session_grain == "date":
        return ["source", "event_date", "user_fk", "ga_session_id"], None
    # A whole session has its first day but goes on; a feed's own day may be one ahead of the time's.
    return ["source", "user_fk", "ga_session_id"], F.greatest(F.col(tables.DAY), F.date_add(F.to_date("session_end_ts"), 1))


def load_purchases(run: Run, purchases: DataFrame, before: DataFrame | None, visits: DataFrame) -> None:
    """Purchases with the time since the user's first visit, in a run's written tables of users and first visits.

    If a source that lags behind has brought an earlier first visit than the one known ``before``, the user's
    purchases loaded earlier are written again with it, so that loads in parts give what one load gives.
    """
    target = run.table("warehouse", "purchase_fct") if run.incremental else None

    def build(rows: DataFrame) -> DataFrame:
        new = facts.timed_purchases(rows, visits)
        if before is None or target is None:
            return new
        known = before.select(F.col("user_fk").alias("_user"), F.col("first_session_ts").alias("_before"))
        moved = visits.join(known, F.col("user_fk") == F.col("_user"), "left").filter(F.col("_before").isNull() | (F.col("first_session_ts") < F.col("_before")))
        moved = run.written(moved.select(F.col("user_fk").alias("_moved"), "first_session_ts"), "moved_visits")
        if moved.isEmpty():
            return new
        held = target.join(moved, F.col("user_fk") == F.col("_moved")).join(new.select("purchase_pk"), "purchase_pk", "left_anti")
        return new.unionByName(facts.since_first_visit(held, "purchase_ts").select(*new.columns))

    _load(run, "purchase_fct", purchases, build, ["purchase_pk"], cluster=("user_fk", "transaction_id"))


def load_facts(run: Run, staged: dict[str, DataFrame], unified: dict[str, DataFrame]) -> None:
    session_key, last_day = _session_load(run)
    held = run.table("warehouse", "session_fct") if run.incremental else None
    with run.work_files():
        before = None if held is None else run.written(facts.first_visits(held), "visits_before")
        _load(run, "session_fct", unified["int__session"], facts.session_fct, session_key, last_day)
        sessions = run.table("warehouse", "session_fct")
        if sessions is None:  # a run without sessions, for example of friction events alone
            sessions = facts.session_fct(unified["int__session"].limit(0))
        load_pageviews(run, unified["int__pageview"])
        # One staged row's items, or one staged row: staged tables are read by day.
        _load(run, "product_view_fct", unified["int__product_view"], facts.product_view_fct, ["product_view_pk"], gathered=True)
        _load(run, "add_to_cart_fct", unified["int__add_to_cart"], facts.add_to_cart_fct, ["add_to_cart_pk"], gathered=True)
        load_purchases(run, unified["int__purchase"], before, run.written(facts.first_visits(sessions), "first_visits"))
    events = staged.get("stg_ga4__event", staged.get("stg_snowplow__event"))
    if events is not None:
        _load(run, "conversion_funnel_fct", events, facts.conversion_funnel_fct, ["funnel_pk"],
              cluster=("traffic_source_full",), key_fixes_day=True)
    friction = {
        "rage_click_fct": ("stg_contentsquare__rage_click", facts.rage_click_fct, "rage_click_pk"),
        "js_error_fct": ("stg_contentsquare__js_error", facts.js_error_fct, "js_error_pk"),
        "user_interaction_fct": ("stg_contentsquare__add_to_cart", facts.user_interaction_fct, "interaction_pk"),
        "cs_purchase_fct": ("stg_contentsquare__purchase", facts.cs_purchase_fct, "cs_purchase_pk"),
        "api_error_fct": ("stg_contentsquare__api_error", facts.api_error_fct, "api_error_pk"),
        "excessive_hovering_fct": (
            "stg_contentsquare__excessive_hovering", facts.excessive_hovering_fct, "excessive_hovering_pk"
        ),
    }
    for name, (stage, build, key) in friction.items():
        if stage in staged:
            _load(run, name, staged[stage], build, [key], gathered=True)
    with run.work_files():
        users = run.written(facts.user_dim(sessions, run.options), "user_dim")
        run.test("user_dim", users, _tests("user_dim"))
        tables.write_whole(users, run.path("warehouse", "user_dim"))


FACTS = (
    "session_fct", "pageview_fct", "product_view_fct", "add_to_cart_fct", "purchase_fct", "conversion_funnel_fct",
    "user_dim", "rage_click_fct", "js_error_fct", "user_interaction_fct", "cs_purchase_fct", "api_error_fct",
    "excessive_hovering_fct",
)


_FACT_OF = {
    "int__session": "session_fct", "int__pageview": "pageview_fct", "int__add_to_cart": "add_to_cart_fct",
    "int__purchase": "purchase_fct", "int__product_view": "product_view_fct",
}


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The fact tables below ``root``."""
    found = {name: tables.read_table(spark, tables.table_path(root, "warehouse", name)) for name in FACTS}
    return {name: df for name, df in found.items() if df is not None}


def run_all(
    spark: SparkSession,
    feeds: Feeds,
    root: str,
    mode: str = FULL,
    options: Options | None = None,
    warn_only: Collection[str] = (),
) -> Run:
    """Load every table below ``root`` and register the mart views (SNK-6)."""
    if mode not in (FULL, INCREMENTAL):
        raise ValueError(f"unknown mode {mode}")
    run = Run(use_utc(spark), root, mode, options or Options(), warn_only)
    with lean_steps(run.spark):
        staged = stage_feeds(run, feeds)
        for name in checks.STAGING:
            # All others were tested before they were published.
            if name in staged and name == "stg_contentsquare__session":
                run.test(name, _recent(run, staged[name]), checks.declared_checks(name))
        with run.work_files():
            unified = {}
            for name, df in integrate(run, staged).items():
                # What the fact will load. Sessions are aggregates, written once: the declared tests and the fact both read
                # that copy. The others are projections of staged tables: the tests read few columns of those, and the
                # fact its own.
                last_day = _session_load(run)[1] if name == "int__session" else None
                fresh, _ = run.news("warehouse", _FACT_OF[name], df, last_day)
                unified[name] = run.written(fresh, name) if name == "int__session" else fresh
                run.test(name, unified[name], checks.declared_checks(name))
            load_facts(run, staged, unified)
    marts.register_marts(published(spark, root))
    return run


def _recent(run: Run, df: DataFrame) -> DataFrame:
    """The rows an incremental run is about: those after the session marks."""
    if not run.incremental:
        return df
    marks = run.marks("warehouse", "session_fct")
    if "source" not in df.columns:
        mark = marks.get(CONTENTSQUARE)
        marks = {} if mark is None else {None: mark}
    return up.newer_than(df, marks, run.options.lookback_days)
