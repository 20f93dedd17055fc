"""Streams over flight records. Each runs what is available, then stops; a checkpoint remembers what was seen."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def stream_of(spark: SparkSession, path: str, files_per_batch: int | None = None, glob: str | None = None) -> DataFrame:
    schema = spark.read.parquet(path if glob is None else f"{path}/{glob}").schema
    r = spark.readStream.schema(schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


def process_new(flights: DataFrame, keys: list[str], done_path: str, checkpoint: str, work: Callable[[DataFrame], DataFrame]) -> None:
    """Each new flight once: a batch leaves out what the status table has, works, and appends its status.

    A batch that is run again after a failure finds its own earlier status by ``epoch`` and leaves it alone, so the
    sink is exactly-once by key."""
    spark = flights.sparkSession

    def step(batch: DataFrame, epoch: int) -> None:
        fresh = batch.dropDuplicates(keys)
        try:
            seen = spark.read.parquet(done_path).select(*keys)
        except Exception as e:  # the first batch has no table yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        else:
            fresh = fresh.join(seen, keys, "left_anti")
        work(fresh).withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(done_path)

    flights.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def replace_by_key(batch: DataFrame, keys: list[str], path: str, epoch: int) -> None:
    """Rows of ``batch`` take the place of those with the same keys. Each call writes a table of its own, ``epoch=<n>``, and
    the highest committed one holds; a batch that runs again writes the same table again, so the sink is exactly-once."""
    spark = batch.sparkSession
    before = current(spark, path, epoch)
    if before is not None:
        batch = before.join(batch.select(*keys).distinct(), keys, "left_anti").unionByName(batch)
    batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def current(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """The table of the highest committed epoch (below ``below``), or None."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    done = [int(n[6:]) for n in names if n.startswith("epoch=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    done = [n for n in done if below is None or n < below]
    return spark.read.parquet(f"{path}/epoch={max(done)}") if done else None


def recheck(results: DataFrame, keys: list[str], status_path: str, checkpoint: str, reason: Callable[[], object]) -> None:
    """After a run, each flight's files are checked again: its status is ok, or incomplete with the ``reason()`` column."""

    def step(batch: DataFrame, epoch: int) -> None:
        told = batch.dropDuplicates(keys).withColumn("reason", reason())
        replace_by_key(told.select(*keys, F.when(F.col("reason").isNull(), "ok").otherwise("incomplete").alias("status"), "reason"), keys, status_path, epoch)

    results.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class _Carry(StatefulProcessor):
    """The good offsets of a field by flight. A flight that comes late is told by the flights before it, and those after it
    that this changes are told again."""

    def __init__(self, least: int):
        self.least = least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.offsets = handle.getMapState("offsets", "flight string", "offset double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  names of the interface
        known = {f[0]: v[0] for f, v in self.offsets.iterator()} if self.offsets.exists() else {}
        before = dict(self._told(known))
        fresh = {}
        for pdf in rows:
            for flight, n, off in zip(pdf["flight"], pdf["n"], pdf["offset"], strict=True):
                fresh[flight] = float(off) if n >= self.least and off == off else None
        for flight, off in fresh.items():
            self.offsets.updateValue((flight,), (off,))
        now = self._told(known | fresh)
        told = [(key[0], f, off) for f, off in now if f in fresh or before[f] != off]
        yield pd.DataFrame({"field": [t[0] for t in told], "flight": [t[1] for t in told], "off": pd.array([t[2] for t in told], dtype="Float64")})

    @staticmethod
    def _told(offsets: dict) -> list[tuple]:
        last, out = None, []
        for flight in sorted(offsets):
            last = offsets[flight] if offsets[flight] is not None else last
            out.append((flight, last))
        return out

    def close(self) -> None:
        pass


def carry_forward(records: DataFrame, least: int = 8000) -> DataFrame:
    """``field, flight, n, offset`` in, the last good offset by field out (a good one has ``least`` pixels).

    State is one number a flight of a field; in whatever order flights come, the last row told of each is what the ordered
    table gives, so the sink replaces by (field, flight). The session's state store becomes RocksDB, which this needs."""
    records.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return records.groupBy("field").transformWithStateInPandas(
        statefulProcessor=_Carry(least), outputStructType="field string, flight string, off double", outputMode="Append", timeMode="None")


def to_table(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> None:
    """Drain a stream into a table by key."""
    step = lambda batch, epoch: replace_by_key(batch, keys, path, epoch)
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(events: DataFrame, time: str, keys: list[str], width: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts by tumbling or sliding window; what is later than the watermark goes."""
    return events.withWatermark(time, late).groupBy(F.window(time, width, slide), *keys).agg(F.count(F.lit(1)).alias("n"))


def sessions(events: DataFrame, time: str, keys: list[str], gap: str, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(F.count(F.lit(1)).alias("n"))
