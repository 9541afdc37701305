"""Late transcripts, repeated imports, staleness, rolling counts and gated loads as Structured Streaming."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


def wait_for_transcript(episodes: DataFrame, transcripts: DataFrame, days: int = 7) -> DataFrame:
    """Episodes with the transcript that comes within ``days``, else (once the watermark has passed) with their notes.

    Streams ``episodes`` (episode_id, published, notes) and ``transcripts`` (t_episode_id, arrived, transcript).
    """
    e = episodes.withWatermark("published", "0 seconds")
    t = transcripts.withWatermark("arrived", "0 seconds")
    near = F.expr(f"t_episode_id = episode_id AND arrived >= published AND arrived <= published + interval {days} days")
    out = e.join(t, near, "left_outer")
    return out.select("episode_id", "published", F.coalesce("transcript", "notes").alias("text"), F.when(F.col("transcript").isNotNull(), "transcript").otherwise("show_notes").alias("source"))


def drop_repeats(rows: DataFrame, key: str, at: str, within: str = "30 days") -> DataFrame:
    """Each key once, as long as its repeats come within the watermark."""
    return rows.withWatermark(at, within).dropDuplicatesWithinWatermark([key])


def day_counts(rows: DataFrame, at: str, *keys: str, delay: str = "1 day") -> DataFrame:
    """Rows for each day and key, final once the watermark has passed the day."""
    return rows.withWatermark(at, delay).groupBy(F.window(at, "1 day").alias("w"), *keys).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("day"), *keys, "n")


def rolling_counts(rows: DataFrame, at: str, *keys: str, days: int = 15, delay: str = "1 day") -> DataFrame:
    """Rows of the last ``days`` days, for each day and key."""
    return rows.withWatermark(at, delay).groupBy(F.window(at, f"{days} days", "1 day").alias("w"), *keys).agg(F.count("*").alias("n")).select(F.to_date(F.col("w.end")).alias("until"), *keys, "n")


class _Watch(StatefulProcessor):
    """One time stamp and one timer for each source; a source fires once when its timer passes, until it sends again."""

    def __init__(self, wait_ms: int):
        self.wait = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last long")

    def _set(self, last: int, watermark: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.last.update((last,))
        # A timer can't be set in the past; a source that lags behind the watermark is asked for at once.
        self.handle.registerTimer(max(last + self.wait, watermark + 1))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = max(int(p["at"].max().timestamp() * 1000) for p in rows)
        known = self.last.get()
        self._set(max(newest, known[0]) if known else newest, timerValues.getCurrentWatermarkInMs())
        yield pd.DataFrame({"source": [], "last_seen": []}).astype({"source": "object", "last_seen": "datetime64[ns]"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.last.get()
        self.last.clear()
        if known:
            yield pd.DataFrame({"source": [key[0]], "last_seen": [pd.Timestamp(known[0], unit="ms")]})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._set(int(initialState["at"].max().timestamp() * 1000), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def stale_sources(rows: DataFrame, source: str, at: str, days: int, delay: str = "1 day", known: DataFrame | None = None) -> DataFrame:
    """(source, last_seen): a row whenever a source has sent nothing for ``days`` of event time.

    ``known`` (source, at) are sources with the time they were last seen before the stream began, so that one that never
    sends again is told too. State is a time stamp and a timer a source; it lies in RocksDB (stateful_session() sets
    that), so it may outgrow memory, and a restart goes on with the timers that were set.
    """
    typed = lambda x, s, t: x.select(F.col(s).cast("string").alias("source"), F.col(t).cast("timestamp").alias("at"))
    kept = typed(rows, source, at).withWatermark("at", delay)
    first = typed(known, "source", "at").groupBy("source") if known is not None else None
    return kept.groupBy("source").transformWithStateInPandas(_Watch(days * 86_400_000), "source string, last_seen timestamp", "Append", "EventTime", initialState=first)


def stateful_session(spark: SparkSession) -> None:
    """State of streams that start from now on lies in RocksDB with a log of changes, which timers and typed state need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def load_each_batch(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str, gate: Callable[[DataFrame], Column | None] | None = None):
    """Start a query that loads every micro-batch; a gate that names a reason stops it before anything is written."""
    def each(batch: DataFrame, n: int) -> None:
        batch = batch.persist()
        try:
            if gate is not None:
                reason = gate(batch)
                if reason:
                    raise ValueError(f"batch {n} stopped: {reason}")
            load(batch, n)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_once(stream: DataFrame, path: str, checkpoint: str, rows: Callable[[DataFrame, int], DataFrame] | None = None, measures: dict[str, Column] | None = None, gate: Callable[[dict], str | None] | None = None):
    """Start a query that loads each micro-batch exactly once, and is gated by measures of the rows as they are written.

    What ``rows`` makes of a batch goes to a folder named by the batch's number, which a replay overwrites, so a load that
    died half-way or was not recorded by the checkpoint leaves no row twice. ``measures`` are observed on that write; no
    second pass is made. If the gate names a reason, the query stops and the batch stays out of the ledger; else the
    ledger gets a row (number and measures), and loaded() shows the batch. A path belongs to one checkpoint.
    """
    measures = measures or {"n_rows": F.count(F.lit(1))}

    def each(batch: DataFrame, n: int) -> None:
        seen = Observation(f"load-{n}-{uuid.uuid4().hex}")
        out = rows(batch, n) if rows else batch
        named = [c.alias(k) for k, c in measures.items()]
        out.observe(seen, *named).write.mode("overwrite").parquet(f"{path}/rows/batch={n}")
        found = seen.get
        reason = gate(found) if gate is not None else None
        if reason:
            raise ValueError(f"batch {n} stopped: {reason}")
        line = batch.sparkSession.range(1).select(F.lit(n).cast("long").alias("n"), *(F.lit(found[f.name]).cast(f.dataType).alias(f.name) for f in out.agg(*named).schema))
        line.coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/batch={n}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(batch, n, measures...): the batches that were loaded."""
    return spark.read.parquet(f"{path}/ledger")


def loaded(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The rows of loaded batches, with their number ``batch``; folders of batches that were stopped aren't read."""
    reader = spark.read.schema(schema + ", batch int") if schema else spark.read
    return reader.parquet(f"{path}/rows").join(ledger(spark, path).select("batch"), "batch", "left_semi")


def redo_late(transcripts: DataFrame, extracted: Callable[[], DataFrame], path: str, checkpoint: str):
    """Start a query that names whole batches to extract anew when a transcript comes after its episode was read from notes.

    ``transcripts`` is a stream (episode_id); ``extracted`` gives the current table (episode_id, batch, source). The
    named batches lie under ``path`` and are read by loaded(); a replay names those of its own micro-batch once.
    """
    def named(batch: DataFrame, n: int) -> DataFrame:
        from ..operators.changes import damaged_batches

        came = batch.select("episode_id").distinct().withColumn("came", F.lit(True))
        rows = extracted().withColumnRenamed("batch", "redo").join(came, "episode_id", "left")
        return damaged_batches(rows, "redo", "episode_id", F.coalesce("came", F.lit(False)) & (F.col("source") == "show_notes"))

    return load_once(transcripts, path, checkpoint, named)
