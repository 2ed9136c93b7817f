import time
from datetime import date, datetime, timedelta
from types import SimpleNamespace

import pandas as pd
import pytest

from mediabatch import schemas
from mediabatch.operators import state
from mediabatch.sources.state_log import StateLog
from mediabatch.streaming import leases

AS_OF = datetime(2024, 1, 31, 12)
DAY = date(2024, 1, 31)


def record(creator, status, version, day=DAY, ttl=None, minutes=0):
    at = AS_OF + timedelta(minutes=minutes)
    return (creator, day, status, "b", "h", 1, "{}", at, at, ttl, "r", 0, "", None, version)


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.STATE)


# -- snapshots ---------------------------------------------------------------------------------


def test_snapshot_and_tail_equal_the_whole_log(spark, tmp_path, rows_of):
    log = StateLog(spark, str(tmp_path / "log"))
    assert log.current(AS_OF).count() == 0 and log.last_segment() == -1
    now = state.epoch_seconds(AS_OF)
    old = date(2023, 1, 1)
    parts = [
        [record("a", "processing", 0), record("b", "processing", 0, ttl=now + 9), record("never", "completed", 0, old)],
        [record("a", "completed", 1, minutes=1), record("gone", "failed", 0, ttl=now - 1), record("late", "failed", 0, old, now * 2)],
        [record("a", "failed", 2, minutes=2), record("c", "processing", 0)],
    ]
    for i, rows in enumerate(parts):
        assert log.append(frame(spark, rows)) == i
        if i == 1:
            assert log.write_snapshot(AS_OF) == 1
    whole = frame(spark, sum(parts, []))
    expected = rows_of(state.current_state(whole, AS_OF))
    assert rows_of(log.current(AS_OF)) == expected
    assert {r[0] for r in expected} == {"a", "b", "c", "never", "late"}
    # Only the snapshot and the segment after it are read.
    files = log.versions().inputFiles()
    assert all("upto=1" in f or "seq=2" in f for f in files if "/segments/" not in f or "seq=2" in f)
    plan = log.tail(1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(seq" in plan
    log.drop_covered()
    assert rows_of(log.current(AS_OF)) == expected
    with pytest.raises(ValueError, match="part of a snapshot"):
        log.append(frame(spark, parts[0]), 1)


def test_a_crash_before_the_manifest_changes_nothing(spark, tmp_path, rows_of, monkeypatch):
    log = StateLog(spark, str(tmp_path / "log"))
    log.append(frame(spark, [record("a", "processing", 0)]))
    log.write_snapshot(AS_OF)
    log.append(frame(spark, [record("a", "completed", 1, minutes=1)]))

    def crash(seq):
        raise OSError("crash")

    with monkeypatch.context() as broken, pytest.raises(OSError, match="crash"):
        broken.setattr(log, "_validate", crash)
        log.write_snapshot(AS_OF)
    assert log.snapshot_at() == 0 and log.current(AS_OF).first().status == "completed"
    # The stream goes on, and the next snapshot replaces the one left behind.
    log.append(frame(spark, [record("a", "failed", 2, minutes=2)]), 1)
    assert log.write_snapshot(AS_OF) == 1 and log.write_snapshot(AS_OF) == 1
    assert [(r.status, r.version) for r in log.current(AS_OF).collect()] == [("failed", 2)]


def test_a_replayed_segment_is_replaced(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"))
    for _ in range(2):
        log.append(frame(spark, [record("a", "processing", 0)]), 7)
    assert log.versions().count() == 1 and log.last_segment() == 7


# -- leases ------------------------------------------------------------------------------------


def opening(creator, batch="b", count=1):
    return ("open", creator, DAY, batch, "h", count, None, None)


def closing(creator, status, order=0):
    return ("close", creator, DAY, None, None, None, status, order)


class Stream:
    """The lease stream over an inbox; each call adds events and runs it from its checkpoint."""

    def __init__(self, spark, folder, minutes):
        self.spark, self.folder, self.minutes = spark, folder, minutes

    def __call__(self, *events):
        inbox = f"{self.folder}/in"
        self.spark.createDataFrame(list(events), leases.EVENTS).coalesce(1).write.mode("append").parquet(inbox)
        arriving = self.spark.readStream.schema(leases.EVENTS).parquet(inbox)
        leases.lease_stream(arriving, f"{self.folder}/out", f"{self.folder}/cp", self.minutes).awaitTermination()
        found = self.spark.read.schema(leases.OUTCOMES).parquet(f"{self.folder}/out")
        return sorted(((r.creator_name, r.outcome, r.batch_id, r.version) for r in found.collect()), key=repr)


def test_leases_open_refuse_and_close(spark, tmp_path):
    run = Stream(spark, tmp_path, 30.0)
    current = spark.createDataFrame([("p", DAY, "processing", "x", 4), ("d", DAY, "completed", "x", 2)],
                                    "creator_name string, processing_date date, status string, batch_id string, version long")
    before = [tuple(r) for r in leases.records(current).collect()]
    first = run(opening("a", "b2"), opening("a", "b1"), opening("a", "b1"), opening("p"), opening("d"), closing("x", "failed"), *before)
    assert first == sorted(
        [("a", "opened", "b1", 0), ("a", "refused", "b1", None), ("a", "refused", "b2", None), ("p", "refused", "b", None),
         ("d", "opened", "b", 3), ("x", "unmatched", None, None)], key=repr)
    # A second start knows what is open; updates come before requests.
    second = run(opening("a", "b9"), closing("p", "processing", 0), closing("p", "completed", 1), opening("p", "b3"))
    added = [r for r in second if r not in first]
    assert added == [("a", "refused", "b9", None), ("p", "closed", "x", 5), ("p", "opened", "b3", 6)]


def test_a_lease_times_out_after_a_restart(spark, tmp_path):
    run = Stream(spark, tmp_path, 0.02)
    assert run(opening("a")) == [("a", "opened", "b", 0)]
    time.sleep(1.5)
    # A request that is refused does not put the end off.
    assert ("a", "refused", "b2", None) in run(opening("a", "b2"))
    assert ("a", "timed out", "b", 1) in run(opening("z"))
    assert ("a", "opened", "b", 2) in run(opening("a"))


def test_outcomes_of_a_key_are_handed_on_together(monkeypatch):
    """Refused requests come in groups of bounded size, not as a table each; values and nulls stay."""
    monkeypatch.setattr(leases, "ROWS", 4, raising=False)
    kept = []
    fresh = SimpleNamespace(exists=False, hasTimedOut=False, getCurrentProcessingTimeMs=lambda: 0, update=kept.append,
                            setTimeoutDuration=lambda ms: None)
    rows = [("open", "u", DAY, f"b{i}", None, i or None, None, None) for i in (3, 1, 0, 2, 6, 5, 4)]
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in leases.EVENTS.split(", ")])
    frames = list(leases._advance(("u", DAY), iter([frame]), fresh, 1000))
    assert [len(f) for f in frames] == [4, 3]
    got = sorted((row[4], row[2], row[6], row[7]) for f in frames for row in f.astype(object).values.tolist())
    assert got[0] == ("b0", "opened", None, 0) and kept == [("processing", "b0", 0, 1000)]
    assert got[1:] == [(f"b{i}", "refused", i, None) for i in range(1, 7)]
