"""The state log as numbered segments, with snapshots of what the earlier ones come to.

A reader takes the newest snapshot that a manifest names and the segments after it; the folder number prunes all others, so the
cost of reading grows with the records and the tail, not with the log's age. Nothing is cut off by date: a record
without expiry, or with a late one, stays until it expires.

Layout below the root: `segments/seq=N` (one append each), `snapshots/upto=N` (newest version of each record in the
segments up to N) and `manifests/upto=N` (empty; written last, it makes the snapshot valid). There is one writer. Appending a
number again replaces that segment, so a replayed micro-batch changes nothing; a snapshot without its manifest is as
good as none and is replaced by the next attempt.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediabatch import schemas
from mediabatch.operators.state import current_state


class StateLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{path}")
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, folder: str) -> list[int]:
        place, files = self._place(folder)
        if not files.exists(place):
            return []
        return sorted(int(s.getPath().getName().partition("=")[2]) for s in files.listStatus(place))

    def last_segment(self) -> int:
        """The highest segment number, -1 without any; a stream uses its epochs as numbers."""
        return max([*self._numbers("segments"), self.snapshot_at()])

    def snapshot_at(self) -> int:
        """The last segment that the newest valid snapshot covers, -1 without one."""
        return max(self._numbers("manifests"), default=-1)

    def append(self, rows: DataFrame, seq: int | None = None) -> int:
        """Adds record versions as one segment and returns its number."""
        seq = self.last_segment() + 1 if seq is None else seq
        if seq <= self.snapshot_at():
            raise ValueError(f"segment {seq} is part of a snapshot")
        rows.write.mode("overwrite").parquet(f"{self.root}/segments/seq={seq}")
        return seq

    def tail(self, after: int) -> DataFrame:
        """The segments after a number; earlier folders are not read."""
        if not self._numbers("segments"):
            return self.spark.createDataFrame([], schemas.STATE)
        log = self.spark.read.schema(f"{schemas.STATE}, seq LONG").parquet(f"{self.root}/segments")
        return log.where(F.col("seq") > after).drop("seq")

    def versions(self) -> DataFrame:
        """The newest snapshot's records and all later versions."""
        at = self.snapshot_at()
        if at < 0:
            return self.tail(-1)
        base = self.spark.read.schema(schemas.STATE).parquet(f"{self.root}/snapshots/upto={at}")
        return base.unionByName(self.tail(at))

    def current(self, as_of: datetime | None = None) -> DataFrame:
        """The current records, as of the whole log."""
        return current_state(self.versions(), as_of)

    def write_snapshot(self, as_of: datetime) -> int:
        """Folds the log as it is into a snapshot without expired records; returns the last segment in it."""
        seq = self.last_segment()
        if seq <= self.snapshot_at():
            return seq
        self.current(as_of).write.mode("overwrite").parquet(f"{self.root}/snapshots/upto={seq}")
        self._validate(seq)
        return seq

    def _validate(self, seq: int) -> None:
        place, files = self._place(f"manifests/upto={seq}")
        files.mkdirs(place.getParent())
        files.create(place, True).close()

    def drop_covered(self) -> None:
        """Removes the segments and older snapshots that the newest snapshot makes needless; no reader may be at them."""
        at = self.snapshot_at()
        for folder, name in (("segments", "seq"), ("manifests", "upto"), ("snapshots", "upto")):
            for n in self._numbers(folder):
                if n < at or folder == "segments" and n == at:
                    place, files = self._place(f"{folder}/{name}={n}")
                    files.delete(place, True)
