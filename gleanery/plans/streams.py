"""Streaming jobs over the test tables as file streams, drained once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import change_of
from ..operators.mentions import search_queries
from ..operators.sinks import replace_batches, write_batch
from ..streaming import jobs as J
from .base import EPISODES, MENTIONS, SYNC, query, scratch, table, view


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as a stream of its files, whether it is one file or a folder of them."""
    batch = table(spark, sf_dir, name)
    files = "/*.parquet" if any(f.rsplit("/", 1)[0].endswith(f"{name}.parquet") for f in batch.inputFiles()[:1]) else ""
    pattern = f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet{files}"
    return spark.readStream.schema(batch.schema).parquet(pattern)


def _drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run until nothing is left; the result is written by batch and read back."""
    spark = stream.sparkSession
    root = scratch(spark, name)
    save = lambda df, n: df.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{root}/out")
    stream.writeStream.foreachBatch(save).outputMode(mode).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


@query("st01_late_transcripts", "SELECT doc_id AS episode_id, text, CASE WHEN doc_id % 5 <> 0 AND doc_id % 3 <> 0 THEN 'transcript' ELSE 'show_notes' END AS source FROM documents")
def st01(spark, sf_dir):
    """A transcript comes after 2 days, or after 10 days, which is too late; a later row of both streams moves the watermark past all.

    Waiting texts are the state: it lies in RocksDB, as it may be as large as the table. Each load of files takes two passes
    over the state (rows, then what the new watermark lets go).
    """
    root = scratch(spark, "st01")
    J.stateful_session(spark)
    k = F.col("doc_id")
    at = lambda days: F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(days)
    d = table(spark, sf_dir, "documents")
    episodes = d.select(k.alias("episode_id"), at(k.cast("int") % 120).alias("published"), F.col("text").alias("notes"))
    transcripts = d.where(k % 5 != 0).select(k.alias("t_episode_id"), at(k.cast("int") % 120 + F.when(k % 3 == 0, 10).otherwise(2)).alias("arrived"), F.col("text").alias("transcript"))
    for step in (0, 1):
        for rows, name in ((episodes, "episodes"), (transcripts, "transcripts")):
            later = spark.range(1).select(F.lit(-1 - step).cast("long"), at(F.lit(1000 * step)), F.lit("later"))
            (later.toDF(*rows.columns) if step else rows).write.mode("append").parquet(f"{root}/{name}")
        e, t = (spark.readStream.schema(rows.schema).parquet(f"{root}/{name}") for rows, name in ((episodes, "episodes"), (transcripts, "transcripts")))
        stream = J.wait_for_transcript(e, t)
        save = lambda df, n: df.write.mode("append").parquet(f"{root}/out")
        stream.writeStream.foreachBatch(save).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out").where("episode_id >= 0").select("episode_id", "text", "source")


@query("st03_drop_repeats", "SELECT DISTINCT user_id FROM events")
def st03(spark, sf_dir):
    e = _stream(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("at"))
    return _drain(J.drop_repeats(e, "user_id", "at", "3650 days"), "st03").select("user_id")


@query("st05_day_counts", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def st05(spark, sf_dir):
    e = _stream(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("at"))
    return _drain(J.day_counts(e, "at", "event_type"), "st05", "complete")


@query("st05_rolling_counts", "WITH d AS (SELECT unnest(generate_series(CAST(min(ts) AS DATE) + 1, CAST(max(ts) AS DATE) + 15, INTERVAL 1 DAY)) AS u FROM events) SELECT CAST(u AS DATE) AS until, count(*) AS n FROM d JOIN events ON ts >= u - INTERVAL 15 DAY AND ts < u GROUP BY 1")
def st05r(spark, sf_dir):
    e = _stream(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("at"))
    return _drain(J.rolling_counts(e, "at"), "st05r", "complete")


@query("st06_sync_changes", f"WITH s AS ({SYNC}) SELECT id, CASE WHEN page_id IS NULL THEN 'create' ELSE 'update' END AS change FROM s WHERE page_id IS NULL OR synced_on IS NULL OR updated_on > synced_on OR last_on > synced_on")
def st06(spark, sf_dir):
    root = scratch(spark, "st06")

    def changes(batch: DataFrame, n: int) -> DataFrame:
        batch.createOrReplaceTempView("gleanery_st06")
        rows = batch.sparkSession.sql(SYNC.replace("FROM orders", "FROM gleanery_st06"))
        return rows.select("id", change_of().alias("change")).where("change <> 'unchanged'")

    J.load_once(_stream(spark, sf_dir, "orders"), root, f"{root}/state", changes).awaitTermination()
    return J.loaded(spark, root).drop("batch")


@query("st07_gated_load", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def st07(spark, sf_dir):
    """The share of rows without a value is measured while they are written."""
    root = scratch(spark, "st07")
    measures = {"n_rows": F.count(F.lit(1)), "missing": F.count_if(F.col("value").isNull())}
    gate = lambda m: "no confidence" if m["missing"] else None
    J.load_once(_stream(spark, sf_dir, "events"), root, f"{root}/state", measures=measures, gate=gate).awaitTermination()
    return J.loaded(spark, root).groupBy("event_type").agg(F.count("*").alias("n"))


@query("k01_write_batch", f"WITH m AS ({MENTIONS}) SELECT episode_id, count(*) AS mention_count, count(*) FILTER (needs_review) AS review_count FROM m GROUP BY 1")
def k01(spark, sf_dir):
    root = scratch(spark, "k01")
    write_batch(view(spark, sf_dir, MENTIONS), root)
    return spark.read.schema("episode_id long, mention_count long, review_count long").option("header", True).csv(f"{root}/episode_summary")


@query("k03_replace_batches", "SELECT user_id % 5 AS show_id, event_type AS batch, count(*) AS n, round(sum(CASE WHEN event_type = 'click' THEN value * 2 ELSE value END), 4) AS total FROM events GROUP BY ALL")
def k03(spark, sf_dir):
    root = scratch(spark, "k03")
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("show_id"), F.col("event_type").alias("batch"), "value")
    replace_batches(e, root, ["show_id", "batch"])
    for _ in range(2):  # a repeated load changes nothing more
        replace_batches(e.where("batch = 'click'").withColumn("value", F.col("value") * 2), root, ["show_id", "batch"])
    return spark.read.parquet(root).groupBy(F.col("show_id").cast("long").alias("show_id"), "batch").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("n29_search_queries", f"WITH m AS ({MENTIONS}) SELECT mention_id, 0 AS pos, canonical_name AS query FROM m UNION ALL SELECT mention_id, 1, concat(canonical_name, ' ', mention_type) FROM m")
def n29(spark, sf_dir):
    return search_queries(view(spark, sf_dir, MENTIONS).withColumn("platform", F.lit(None).cast("string")))


@query("e08_baseline", f"WITH e AS ({EPISODES}), w AS (SELECT id, show_slug, notes, row_number() OVER (PARTITION BY show_slug ORDER BY publish_date DESC NULLS LAST, id) AS rn FROM e) SELECT id, show_slug, sha256(left(notes, 5000)) AS input_sha256 FROM w WHERE rn <= 5")
def e08(spark, sf_dir):
    from ..functions.text import input_hash
    from ..operators.rollups import newest_per_group

    e = newest_per_group(view(spark, sf_dir, EPISODES), "show_slug", 5, F.col("publish_date").desc_nulls_last(), F.col("id"))
    return e.select("id", "show_slug", input_hash(F.col("notes"), 5000).alias("input_sha256"))


@query("st02_redo_late", "WITH d AS (SELECT doc_id AS episode_id, doc_id % 40 AS batch, CASE WHEN doc_id % 6 = 0 THEN 'show_notes' ELSE 'transcript' END AS source FROM documents), b AS (SELECT DISTINCT batch FROM d WHERE source = 'show_notes' AND episode_id % 9 = 0) SELECT batch, array_to_string(list_sort(list_distinct(list(CAST(episode_id AS VARCHAR)))), ',') AS items, count(DISTINCT episode_id) AS n FROM d WHERE batch IN (SELECT batch FROM b) GROUP BY 1")
def st02(spark, sf_dir):
    root = scratch(spark, "st02")
    k = F.col("doc_id")
    done = lambda: table(spark, sf_dir, "documents").select(k.alias("episode_id"), (k % 40).alias("batch"), F.when(k % 6 == 0, "show_notes").otherwise("transcript").alias("source"))
    came = _stream(spark, sf_dir, "documents").where(k % 9 == 0).select(k.alias("episode_id"))
    J.redo_late(came, done, root, f"{root}/state").awaitTermination()
    # A batch that several micro-batches name is done anew once.
    return J.loaded(spark, root).drop("batch").withColumnRenamed("redo", "batch").dropDuplicates(["batch"])


@query(
    "st04_stale_sources",
    """WITH d AS (SELECT event_type, ts, max(ts) OVER () AS newest, min(ts) OVER () AS oldest FROM events), k AS (SELECT * FROM d WHERE event_type <> 'error' OR ts < newest - INTERVAL 20 DAY)
    SELECT event_type AS source, date_trunc('milliseconds', max(ts)) AS last_seen FROM k WHERE event_type = 'error' GROUP BY 1 UNION ALL SELECT concat('silent ', event_type), date_trunc('milliseconds', min(oldest)) FROM d GROUP BY 1""",
)
def st04(spark, sf_dir):
    """Errors stop 20 days before the end; files come in three steps of time, so timers see the watermark pass.

    For each kind of event a source is known from before the stream that never sends.
    """
    root = scratch(spark, "st04")
    J.stateful_session(spark)
    e = table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("at"))
    span = e.agg(F.max("at").alias("newest"), F.min("at").alias("oldest"))
    known = e.select(F.concat(F.lit("silent "), "event_type").alias("source")).distinct().crossJoin(F.broadcast(span)).select("source", F.col("oldest").alias("at"))
    e = e.join(F.broadcast(span), F.lit(True)).withColumn("left", F.col("newest").cast("double") - F.col("at").cast("double")).where("event_type <> 'error' or left > 20 * 86400").drop("newest", "oldest")
    for low, high in ((20, 10_000), (1, 20), (-1, 1)):
        e.where((F.col("left") > low * 86400) & (F.col("left") <= high * 86400)).drop("left").write.mode("append").parquet(f"{root}/landed")
        rows = spark.readStream.schema("event_type string, at timestamp").parquet(f"{root}/landed")
        stale = J.stale_sources(rows, "event_type", "at", 14, known=known)
        save = lambda df, n: df.write.mode("overwrite").parquet(f"{root}/out/step={low}/batch={n}")  # noqa: B023, E731
        stale.writeStream.foreachBatch(save).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stale.schema).parquet(f"{root}/out").select("source", F.col("last_seen").cast("timestamp_ntz").alias("last_seen"))
