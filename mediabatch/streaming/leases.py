"""Record opening as a stateful stream: one lease per creator and day, held in the state store, with a timeout.

The log form (`state.create_records`, `update_records`, `expire_stale`) reads the stored records in every micro-batch. Here
each key's record lies with its key: a request opens it, or is refused while it is in progress; an update closes it;
and a timeout fails it once it has been open too long, also if nothing more arrives for its key.

Within one micro-batch records that exist already come first, then updates, the last by `ord` and status deciding, then
requests: the smallest by (batch_id, content_hash, image_count) gets through, as in the log form, and every other is
refused. Rows are looked at one after the other; the best so far and at most `ROWS` outcomes are held, so a creator with
any number of requests takes little memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mediabatch.operators.state import KEY, STALE_MINUTES

# kind is `record` (an existing one: status, batch_id, version in ord), `close` (status; ord orders the updates of a key)
# or `open` (batch_id, content_hash, image_count).
EVENTS = (
    "kind STRING, creator_name STRING, processing_date DATE, batch_id STRING, content_hash STRING, image_count LONG,"
    " status STRING, ord LONG"
)
# deadline: processing time in milliseconds. Spark clears a key's time-out whenever rows come for it.
LEASE = "status STRING, batch_id STRING, version LONG, deadline LONG"
OUTCOMES = (
    "creator_name STRING, processing_date DATE, outcome STRING, status STRING, batch_id STRING, content_hash STRING,"
    " image_count LONG, version LONG"
)
NAMES = [c.split()[0] for c in OUTCOMES.split(", ")]
READ = ["kind", "batch_id", "content_hash", "image_count", "status", "ord"]
# Outcomes of a key that are handed on at a time.
ROWS = 10_000


def _plain(value):
    return None if value is None or pd.isna(value) else value


def _rank(request: tuple) -> tuple:
    """Order of requests with missing values first, as Spark orders structs."""
    return tuple((v is not None, v) for v in request)


def _row(key: tuple, outcome: str, status, request: tuple, version) -> tuple:
    return (*key, outcome, status, *request, version)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    """Outcomes as they are: typed columns would take most of the time of a key."""
    return pd.DataFrame(rows, columns=NAMES, dtype=object)


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, milliseconds: int) -> Iterator[pd.DataFrame]:
    lease = state.get if state.exists else None
    if state.hasTimedOut:
        if lease[0] == "processing":
            state.update(("failed", lease[1], lease[2] + 1, lease[3]))
            yield _frame([_row(key, "timed out", "failed", (lease[1], None, None), lease[2] + 1)])
        return
    now = state.getCurrentProcessingTimeMs()
    best = close = record = None
    out: list[tuple] = []
    for frame in frames:
        for kind, batch_id, content_hash, count, status, order in zip(*(frame[c].tolist() for c in READ)):
            if kind == "record":
                record = (status, _plain(batch_id), int(order), now + milliseconds)
            elif kind == "close":
                own = (_plain(order) or 0, status)
                close = own if close is None else max(close, own)
            else:
                count = _plain(count)
                request = (_plain(batch_id), _plain(content_hash), None if count is None else int(count))
                if best is None:
                    best = request
                    continue
                best, other = sorted((best, request), key=_rank)
                out.append(_row(key, "refused", None, other, None))
                if len(out) == ROWS:
                    yield _frame(out)
                    out = []
    lease = lease or record
    if close is not None and lease:
        lease = (close[1], lease[1], lease[2] + 1, lease[3])
        out.append(_row(key, "closed", close[1], (lease[1], None, None), lease[2]))
    elif close is not None:
        out.append(_row(key, "unmatched", close[1], (None, None, None), None))
    if best is not None:
        if lease and lease[0] == "processing":
            out.append(_row(key, "refused", None, best, None))
        else:
            lease = ("processing", best[0], lease[2] + 1 if lease else 0, now + milliseconds)
            out.append(_row(key, "opened", "processing", best, lease[2]))
    if lease:
        state.update(lease)
        if lease[0] == "processing":  # a refused request leaves the deadline as it was
            state.setTimeoutDuration(max(1, lease[3] - now))
    if out:
        yield _frame(out)


def records(current: DataFrame) -> DataFrame:
    """Existing records (key, status, batch_id, version) as events, to begin a stream with."""
    none = F.lit(None).cast("string")
    return current.select(
        F.lit("record").alias("kind"), *KEY, "batch_id", none.alias("content_hash"), none.cast("long").alias("image_count"),
        "status", F.col("version").cast("long").alias("ord"),
    )


def leases(events: DataFrame, minutes: float = STALE_MINUTES) -> DataFrame:
    """Outcomes of a stream of events: opened, refused, closed, unmatched, timed out."""
    milliseconds = int(minutes * 60_000)
    return events.groupBy(*KEY).applyInPandasWithState(
        lambda key, frames, state: _advance(key, frames, state, milliseconds),
        OUTCOMES,
        LEASE,
        "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )


def lease_stream(events: DataFrame, out: str, checkpoint: str, minutes: float = STALE_MINUTES, **trigger):
    """Writes the outcomes under `out`; a restart from the checkpoint goes on with the leases that are open.

    Without a trigger the stream takes what is there and ends. Spark would make empty micro-batches for ever to see time-outs
    through; they are turned off for such a run, so that its time-outs come with its events.
    """
    spark, name = events.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled"
    old = spark.conf.get(name)
    if not trigger:
        spark.conf.set(name, "false")
    try:
        return (
            leases(events, minutes)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        spark.conf.set(name, old)
