"""Event-time windows over a stream, with late rows kept in a table of their own.

Spark's stateful operators drop rows behind the watermark and tell their number
only. Here every micro-batch first passes a gate: rows behind the watermark go to
a table of late rows, all others to a table of rows. The windows are Spark's own
stateful aggregations in append mode over the latter, advanced once for each
micro-batch, so that their watermark never passes the gate's and nothing is
dropped there.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shelfwise.session import scratch_path

ROWS_A_FILE = 100_000
SLICES = "spark.sql.shuffle.partitions"


class Windows(NamedTuple):
    """One kind of window: its expression, the keys beside it, and the aggregates by name."""

    window: Column
    keys: tuple[str, ...]
    aggregates: dict[str, Column]


def tumbling(time: str, width: str, keys: tuple[str, ...], **aggregates: Column) -> Windows:
    return Windows(F.window(time, width), keys, aggregates)


def sliding(time: str, width: str, step: str, keys: tuple[str, ...], **aggregates: Column) -> Windows:
    return Windows(F.window(time, width, step), keys, aggregates)


def sessions(time: str, gap: str, keys: tuple[str, ...], **aggregates: Column) -> Windows:
    """Windows that end when a key has been silent for ``gap``. Keys are needed: sessions of all rows would be one group."""
    if not keys:
        raise ValueError("sessions need a key")
    return Windows(F.session_window(time, gap), keys, aggregates)


def aggregate(rows: DataFrame, kind: Windows) -> DataFrame:
    """(window_start, window_end, keys, aggregates): the same for batch and stream."""
    grouped = rows.groupBy(kind.window.alias("window"), *kind.keys).agg(*[c.alias(n) for n, c in kind.aggregates.items()])
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *kind.keys, *kind.aggregates)


class WindowTables(NamedTuple):
    """The tables of a job below its folder."""

    base: str

    def batch(self, batch_id: int) -> str:
        return f"{self.base}/rows/batch_id={batch_id}"

    def windows(self, spark: SparkSession, name: str) -> DataFrame:
        """The windows closed so far."""
        return spark.read.parquet(f"{self.base}/windows-{name}")

    def rows(self, spark: SparkSession) -> DataFrame:
        """Every row that came, with ``batch_id`` and whether it was ``late``."""
        return spark.read.parquet(f"{self.base}/rows").withColumn("late", F.col("late").cast("boolean"))

    def late_rows(self, spark: SparkSession) -> DataFrame:
        return self.rows(spark).filter("late").drop("late")

    def watermarks(self, spark: SparkSession) -> DataFrame:
        """(batch_id, latest, watermark): the latest time of each micro-batch, and the watermark its rows were held against."""
        return spark.read.parquet(f"{self.base}/watermarks")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


@contextmanager
def _a_slice_a_core(spark: SparkSession) -> Iterator[None]:
    """While a query starts: its state in no more slices than there are cores.

    Each slice is opened, read back and written in every micro-batch, whatever it holds. A checkpoint keeps the number it was
    begun with.
    """
    given = spark.conf.get(SLICES)
    spark.conf.set(SLICES, str(min(int(given), spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(SLICES, given)


def _advance(spark: SparkSession, tables: WindowTables, schema: StructType, time: str, delay: str, kinds: dict[str, Windows]) -> None:
    """Let every kind of window take the rows that are new to it, and close what the watermark allows."""
    for name, kind in kinds.items():
        rows = spark.readStream.schema(schema).parquet(f"{tables.base}/rows/batch_id=*/late=false").withWatermark(time, delay)
        writer = aggregate(rows, kind).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{tables.base}/progress-{name}")
        with _a_slice_a_core(spark):
            running = writer.trigger(availableNow=True).start(f"{tables.base}/windows-{name}")
        running.awaitTermination()
        lost = sum(op.get("numRowsDroppedByWatermark", 0) for p in running.recentProgress for op in json.loads(p.json)["stateOperators"])
        if lost:
            raise RuntimeError(f"{lost} rows were dropped by the windows {name}")


def start_windows(
    stream: DataFrame, base: str, time: str, delay: str, kinds: dict[str, Windows], trigger: dict | None = None,
) -> StreamingQuery:
    """Run the windows over a stream; the tables are those of ``WindowTables(base)``.

    A row is late if its time is before the watermark: the latest time of all earlier micro-batches less ``delay``. Rows
    with a null time are late, too. A window is closed when the watermark reaches its end.

    Everything is written under the number of the micro-batch. A micro-batch that is run again after a failure keeps the
    rows it had written whole, and the windows go on from their own checkpoints: nothing doubles and nothing is lost.
    """
    spark, tables, schema = stream.sparkSession, WindowTables(base), stream.schema

    def gate(batch: DataFrame, batch_id: int) -> None:
        if not _exists(spark, f"{tables.batch(batch_id)}/_SUCCESS"):
            session = batch.sparkSession
            mark = None
            if _exists(spark, f"{base}/watermarks"):
                mark = session.read.parquet(f"{base}/watermarks").filter(F.col("batch_id") < batch_id).agg((F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("mark")).first()["mark"]
            edge = F.lit(mark).cast("timestamp")
            rows = batch.withColumn("late", F.col(time).isNull() | F.coalesce(F.col(time) < edge, F.lit(False)))
            rows.write.mode("overwrite").partitionBy("late").parquet(tables.batch(batch_id))
            written = session.read.parquet(tables.batch(batch_id))
            written.agg(F.max(time).alias("latest"), edge.alias("watermark")).write.mode("overwrite").parquet(f"{base}/watermarks/batch_id={batch_id}")
        _advance(spark, tables, schema, time, delay, kinds)

    writer = stream.writeStream.option("checkpointLocation", f"{base}/progress").trigger(**(trigger or {"availableNow": True}))
    return writer.foreachBatch(gate).start()


def in_batches(df: DataFrame, number: Column, folder: str, read: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """A table as a stream whose micro-batches are the given numbers, in their order, as if it arrived so.

    For replaying a stored table, which is read once. All numbers have equally many files, and a trigger takes that many:
    one file for each 100,000 rows of the largest number, up to the cores there are. Numbers of few rows are filled up with
    empty files. A ``read`` of the caller's own meets one file for each number.
    """
    spark = df.sparkSession
    numbered, staged = df.withColumn("arrival", number), scratch_path(spark, "arrivals")
    numbered.write.partitionBy("arrival").parquet(staged)
    arrived = spark.read.schema(numbered.schema).parquet(staged)
    counts = {r["arrival"]: r["count"] for r in arrived.groupBy("arrival").count().collect()}  # the caller's number of micro-batches
    files = 1 if read else max(1, min(spark.sparkContext.defaultParallelism, -(-max(counts.values(), default=0) // ROWS_A_FILE)))
    for i, n in enumerate(sorted(counts), 1):
        rows = arrived.filter(F.col("arrival") == n).select(df.columns)
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.mode("append").parquet(folder)
        for _ in range(i * files - len(spark.read.schema(df.schema).parquet(folder).inputFiles())):
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(folder)
    # A list kept between triggers could be cut inside a number.
    whole = lambda s, at: s.readStream.schema(df.schema).option("maxFilesPerTrigger", files).option("maxCachedFiles", 0).parquet(at)
    return (read or whole)(spark, folder)
