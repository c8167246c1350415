"""Polling a table for changes, with its state saved after every cycle.

A state is a folder of versions, one for each cycle: the rows known then, and the cursors, with their types. A version
counts once its cursors are written whole. A cycle reads the table once into the shared folder, so that all
of its phases see the same rows; it gives its changes to a sink with the cycle's number, and then saves the next version. A
run that is cut short between the two gives that cycle again: delivery is at least once, and the number lets a sink
put it in the same place.
"""

from __future__ import annotations

import time as clock
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import changelog as cl
from ..plans.stage import written

Sink = Callable[[DataFrame, int], None]
_KEPT = 2


class PollState:
    """The versions in a folder that all executors see."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _files(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _path(self, version: int) -> str:
        return f"{self.folder}/v{version:010d}"

    def versions(self) -> list[int]:
        files, path = self._files()
        if not files.exists(path):
            return []
        named = [s.getPath().getName() for s in files.listStatus(path)]
        make = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(int(n[1:]) for n in named if n[:1] == "v" and n[1:].isdigit() and files.exists(make(f"{self.folder}/{n}/cursor/_SUCCESS")))

    def load(self, version: int) -> tuple[DataFrame, cl.Cursor]:
        row = self.spark.read.parquet(f"{self._path(version)}/cursor").first()
        return self.spark.read.parquet(f"{self._path(version)}/rows"), cl.Cursor(*row)

    def save(self, version: int, known: DataFrame, cursor: cl.Cursor, key: str, time: str | None) -> None:
        kinds = {f.name: f.dataType for f in known.schema}
        schema = T.StructType().add("last_key", kinds[key]).add("last_time", kinds[time] if time else T.NullType()).add("last_update_key", kinds[key])
        known.write.mode("overwrite").parquet(f"{self._path(version)}/rows")
        one = self.spark.createDataFrame([(cursor.last_key, cursor.last_time, cursor.last_update_key)], schema)
        one = one if time else one.withColumn("last_time", F.lit(None).cast("timestamp_ntz"))
        one.coalesce(1).write.mode("overwrite").parquet(f"{self._path(version)}/cursor")
        files, _ = self._files()
        for old in self.versions()[:-_KEPT]:
            files.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path(old)), True)


def poll(
    spark: SparkSession, read: Callable[[], DataFrame], sink: Sink, folder: str, key: str, time: str | None = None, size: int = 1000,
    snapshot: bool = True, start: tuple[DataFrame, cl.Cursor] | None = None,
) -> int:
    """One cycle; its number. Cycle 0 is the snapshot: its rows go to the sink as reads, unless ``snapshot`` is off, and the
    cursors stand behind them; or ``start`` gives the rows and cursors to begin with."""
    state = PollState(spark, folder)
    done = state.versions()
    if not done:
        known, cursor = start or (written(read(), "poll-snapshot"), None)
        cursor = cursor or cl.initial_cursor(known, key, time)
        if snapshot:
            image = F.struct(*(c for c in known.columns if c != key))
            sink(known.select(F.lit(0).alias("_phase"), F.lit(cl.READ).alias("_op"), key, F.when(F.lit(False), image).alias("before"), image.alias("after")), 0)
        state.save(0, known, cursor, key, time)
        return 0
    known, cursor = state.load(done[-1])
    current = written(read(), "poll-current")
    changes = written(cl.poll_cycle(known, current, key, cursor, size, time), "poll-changes")
    cycle = done[-1] + 1
    sink(changes.select("_phase", "_op", key, "before", "after"), cycle)
    state.save(cycle, cl.known_after(known, current, key, cursor, size, time), cl.next_cursor(current, key, cursor, size, time), key, time)
    return cycle


def run(interval_s: float, cycles: int | None = None, **options) -> None:
    """Cycle after cycle, with a pause between them; without end unless ``cycles`` says how many."""
    done = 0
    while cycles is None or done < cycles:
        poll(**options)
        done += 1
        if cycles is None or done < cycles:
            clock.sleep(interval_s)
