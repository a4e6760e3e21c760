"""A monitor of predictions by key: state for each key, timers in event time, records of drift."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shelfwise.session import workers_see_library

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

RECORD = (
    "key string, window_start timestamp, status string, n bigint, mean double, deviation double, reference_n bigint, reference_mean double, z double"
)


class DriftMonitor(StatefulProcessor):
    """Compares each window of a key with the first windows of the key.

    State of a key: for each open window its count, sum and sum of squares; the same for the reference; the end of the
    window closed last. All of it is added up, so the order in which rows arrive changes nothing. A timer at a window's
    end closes it; a timer ``ttl`` later forgets a key that has been silent since.
    """

    def __init__(self, width: int, reference: int, limit: float, ttl: int) -> None:
        self.width, self.reference, self.limit, self.ttl = width, reference, limit, ttl  # times in milliseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start bigint", "n bigint, total double, squares double")
        self.known = handle.getValueState("known", "windows bigint, n bigint, total double, squares double, closed bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sums: dict[int, tuple[int, float, float]] = {}
        for frame in rows:
            at = frame["at"].to_numpy() // self.width * self.width
            tally = pd.DataFrame({"at": at, "x": frame["value"], "xx": frame["value"] ** 2}).groupby("at").agg(n=("x", "size"), total=("x", "sum"), squares=("xx", "sum"))
            for start, n, total, squares in tally.itertuples():
                old = sums.get(int(start), (0, 0.0, 0.0))
                sums[int(start)] = (old[0] + int(n), old[1] + float(total), old[2] + float(squares))
        for start, new in sums.items():
            if self.open.containsKey((start,)):
                old = self.open.getValue((start,))
                new = tuple(a + b for a, b in zip(old, new))
            else:
                self.handle.registerTimer(start + self.width)
            self.open.updateValue((start,), new)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        known = self.known.get() if self.known.exists() else (0, 0, 0.0, 0.0, 0)
        out = []
        for start in sorted(k[0] for k in self.open.keys() if k[0] + self.width <= now):
            n, total, squares = self.open.getValue((start,))
            self.open.removeKey((start,))
            mean = total / n
            deviation = max(squares / n - mean * mean, 0.0) ** 0.5
            windows, ref_n, ref_total, ref_squares, _ = known
            ref_mean = ref_total / ref_n if ref_n else None
            z = None
            if windows < self.reference:
                status = "reference"
                known = (windows + 1, ref_n + n, ref_total + total, ref_squares + squares, start + self.width)
            else:
                spread = max(ref_squares / ref_n - ref_mean * ref_mean, 0.0) ** 0.5
                z = (mean - ref_mean) / (spread / n**0.5) if spread else None
                drifted = abs(z) > self.limit if z is not None else mean != ref_mean
                status = "drift" if drifted else "ok"
                known = (*known[:4], start + self.width)
            out.append((key[0], start, status, n, mean, deviation, ref_n, ref_mean, z))
            self.handle.registerTimer(start + self.width + self.ttl)
        if out:
            self.known.update(known)
        elif known[4] and known[4] + self.ttl <= now and not any(True for _ in self.open.keys()):
            out.append((key[0], known[4], "expired", 0, None, None, known[1], known[2] / known[1], None))
            self.known.clear()
        columns = ["key", "window_start", "status", "n", "mean", "deviation", "reference_n", "reference_mean", "z"]
        frame = pd.DataFrame(out, columns=columns)
        frame["window_start"] = pd.to_datetime(frame["window_start"], unit="ms", utc=True).dt.tz_convert(None)
        yield frame

    def close(self) -> None:
        pass


def monitor_drift(
    scored: DataFrame, key: str, time: str, value: str, width_s: int = 86_400, delay: str = "1 day", reference: int = 5, limit: float = 3.0, ttl_s: int = 30 * 86_400,
) -> DataFrame:
    """A stream of records: one for each window of ``width_s`` of each key when the watermark passes its end.

    ``status`` is ``reference`` for a key's first windows, then ``drift`` where the mean lies more than ``limit`` standard
    errors from the reference's (z; with a reference that does not vary: any other mean), else ``ok``. A key that had no
    row for ``ttl_s`` after its last window gets a record ``expired`` with that window's end, and is forgotten.

    Rows with a null key, time or value take no part. Rows behind the watermark are dropped by Spark and counted in the
    query's progress; ``windows.start_windows`` keeps such rows. State lies in the RocksDB store, which the session has to
    name (``use_rocks``). A restarted query goes on from its checkpoint with the same records.
    """
    workers_see_library(scored.sparkSession)
    at = F.unix_millis(F.col(time))
    rows = scored.filter(F.col(key).isNotNull() & F.col(time).isNotNull() & F.col(value).isNotNull()).withWatermark(time, delay)
    rows = rows.select(F.col(key).cast("string").alias("key"), F.col(time).alias("__time"), at.alias("at"), F.col(value).cast("double").alias("value"))
    processor = DriftMonitor(width_s * 1000, reference, limit, ttl_s * 1000)
    return rows.groupBy("key").transformWithStateInPandas(processor, RECORD, "Append", "EventTime")


def use_rocks(spark) -> None:
    spark.conf.set(STORE, ROCKS)
