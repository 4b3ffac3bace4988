"""Page flow of a stream: positions and neighbours of a session's views, once it is over.

Sessions are dealt into buckets by their key's hash. A bucket is a key in the state store that
holds the views of its open sessions and when each session ends. An event-time timer ends a
session when the watermark has passed its last view by ``idle``; its views then come out
numbered, once. A mark stays for ``remember`` so that a view that comes after the end is known
as late. Late views are not dropped: they come out on their own side, as rows of kind ``late``,
to be counted or merged into days again.

One call handles all of a bucket's rows of a batch, and one timer stands for the next end in it,
so the calls to the state store follow the buckets and not the sessions. A task holds one bucket.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

KEYS = ("source", "user_fk", "ga_session_id")
_BY = list(KEYS)
OUTPUT = (
    "source string, user_fk string, ga_session_id string, pageview_pk string, pageview_ts timestamp_ntz, page_location string,"
    " kind string, next_page_ts timestamp_ntz, previous_page_location string, page_number_in_session long, total_pages_in_session long"
)
_NAMES = [part.split()[0] for part in OUTPUT.split(", ")]
# What the state holds, packed as Arrow: one chunk of views for each batch, and a row for each session.
_VIEWS = pa.schema([*[(k, pa.string()) for k in KEYS], ("pageview_pk", pa.string()), ("pageview_ts", pa.timestamp("us")), ("page_location", pa.string())])
_ENDS = pa.schema([*[(k, pa.string()) for k in KEYS], ("at", pa.int64()), ("over", pa.bool_())])
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _pack(rows: pd.DataFrame, schema: pa.Schema) -> tuple[bytes]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_table(pa.Table.from_pandas(rows[schema.names], schema=schema, preserve_index=False))
    return (sink.getvalue().to_pybytes(),)


def _unpack(chunks: list[tuple[bytes]], schema: pa.Schema) -> pd.DataFrame:
    parts = [pa.ipc.open_stream(bytes(chunk)).read_all() for (chunk,) in chunks]
    return pa.concat_tables([schema.empty_table(), *parts]).to_pandas()


class Sessions(StatefulProcessor):
    """State of a bucket: the views of its open sessions; when each session ends, or until when its end is remembered."""

    def __init__(self, idle_ms: int, remember_ms: int):
        self.idle_ms, self.remember_ms = idle_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.views = handle.getListState("views", "chunk binary")
        self.ends = handle.getValueState("ends", "chunk binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows), ignore_index=True)
        found["_ms"] = found["pageview_ts"].astype("datetime64[us]").astype("int64") // 1000
        watermark = timerValues.getCurrentWatermarkInMs()
        known = self._known()
        # NULL keys are equal here, as in any group.
        met = found.groupby(_BY, dropna=False, sort=False, as_index=False)["_ms"].max().merge(known, on=_BY, how="left")
        new = met["at"].isna()
        ends = met["_ms"] + self.idle_ms
        at = met["at"].where(~new, ends).astype("int64")
        # Over already (timers of a batch run after its rows), or so old that it would have been if it had come in time.
        met["_ended"] = (met["over"].astype("boolean").fillna(False).astype(bool)) | (at <= watermark)
        ended = found[_BY].merge(met[[*_BY, "_ended"]], on=_BY, how="left")["_ended"].to_numpy(bool)
        if ended.any():
            yield self._rows(found[ended], "late")
        if ended.all():
            return
        self.views.appendValue(_pack(found[~ended], _VIEWS))
        goes_on = met[~met["_ended"]].assign(at=ends.where(ends > at, at), over=False)
        self._keep(known, pd.concat([known, goes_on[[*_BY, "at", "over"]]], ignore_index=True).drop_duplicates(_BY, keep="last"))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        known = self._known()
        due = known["at"] <= watermark
        ending = known[due & ~known["over"]]
        marks = ending.assign(at=ending["at"] + self.remember_ms, over=True)
        # The timer that ran is gone from the store.
        self._keep(known[:0], pd.concat([known[~due], marks], ignore_index=True))
        if ending.empty:
            return
        views = _unpack(list(self.views.get()), _VIEWS)
        ended = views[_BY].merge(ending[_BY].assign(_ended=True), on=_BY, how="left")["_ended"].notna().to_numpy()
        if ended.all():
            self.views.clear()
        else:
            self.views.put([_pack(views[~ended], _VIEWS)])
        views = views[ended].sort_values([*_BY, "pageview_ts", "pageview_pk"], ignore_index=True)
        session = views.groupby(_BY, dropna=False, sort=False)
        views = views.assign(
            next_page_ts=session["pageview_ts"].shift(-1), previous_page_location=session["page_location"].shift(1),
            page_number_in_session=session.cumcount() + 1, total_pages_in_session=session["pageview_pk"].transform("size"),
        )
        yield self._rows(views, "flow")

    def close(self) -> None:
        pass

    def _known(self) -> pd.DataFrame:
        return _unpack([self.ends.get()] if self.ends.exists() else [], _ENDS)

    def _keep(self, before: pd.DataFrame, ends: pd.DataFrame) -> None:
        """Store the ends, and let the bucket's one timer run at the first of them."""
        old, first = (None if e.empty else int(e["at"].min()) for e in (before, ends))
        if first is None:
            self.ends.clear()
        else:
            self.ends.update(_pack(ends, _ENDS))
        if old != first:
            if old is not None:
                self.handle.deleteTimer(old)
            if first is not None:
                self.handle.registerTimer(first)

    @staticmethod
    def _rows(views: pd.DataFrame, kind: str) -> pd.DataFrame:
        out = views.assign(kind=kind)
        return out.reindex(columns=_NAMES).astype(object).where(lambda d: d.notna(), None)


def page_flow_stream(
    views: DataFrame,
    delay: str = "1 hour",
    idle: dt.timedelta = dt.timedelta(minutes=30),
    remember: dt.timedelta = dt.timedelta(days=7),
    buckets: int = 256,
) -> DataFrame:
    """Numbered views of sessions that are over (kind ``flow``), and views that came after their session's end (kind ``late``).

    ``views`` has KEYS, pageview_pk, pageview_ts and page_location. Views without a session id or a time
    are left out: they belong to no session that ends. Of one session's views in one batch that come
    after the end all are late. Needs the RocksDB state store. ``buckets`` should give a bucket some
    thousand open or remembered sessions; it belongs to the checkpoint, as the sessions are dealt by it.
    """
    whole = views.filter(F.col("ga_session_id").isNotNull() & F.col("pageview_ts").isNotNull())
    # Spark drops late rows where the watermark's own column goes on; a copy of the time does, so the operator sees them.
    marked = whole.withColumn("_clock", F.col("pageview_ts").cast("timestamp")).withWatermark("_clock", delay)
    slim = marked.select(
        F.pmod(F.xxhash64(*KEYS), F.lit(buckets)).alias("bucket"),
        *KEYS, "pageview_pk", F.expr("cast(pageview_ts as timestamp_ntz)").alias("pageview_ts"), "page_location",
    )
    milliseconds = lambda t: int(t.total_seconds() * 1000)
    return slim.groupBy("bucket").transformWithStateInPandas(Sessions(milliseconds(idle), milliseconds(remember)), OUTPUT, "Append", "EventTime")


def write_flow(flow: DataFrame, target: str, progress: str) -> StreamingQuery:
    """Append to ``target``, one folder for each kind and batch: a batch that is run again replaces its own folder."""
    def write(rows: DataFrame, batch: int) -> None:
        rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "batch").parquet(target)

    conf = flow.sparkSession.conf
    before = conf.get(PROVIDER)
    conf.set(PROVIDER, ROCKSDB)
    try:  # a stream keeps the settings it was started with
        return flow.writeStream.foreachBatch(write).option("checkpointLocation", progress).trigger(availableNow=True).start()
    finally:
        conf.set(PROVIDER, before)
