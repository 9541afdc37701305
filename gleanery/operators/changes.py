"""Change sets, selections of pending work, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def change_of(page: str = "page_id", synced: str = "synced_on", updated: str = "updated_on", last: str = "last_on") -> Column:
    """create without a page; update if never synced, changed since, or mentioned since; else unchanged."""
    newer = F.col(synced).isNull() | (F.col(updated) > F.col(synced)) | (F.col(last) > F.col(synced))
    return F.when(F.col(page).isNull(), "create").when(F.coalesce(newer, F.lit(False)), "update").otherwise("unchanged")


def unsynced(rows: DataFrame, text: str, date: str, id_col: str, synced: Column, limit: int | None = None) -> DataFrame:
    """Rows to sync, newest first and undated last; blank texts are marked, not synced."""
    out = rows.where(~synced).withColumn("action", F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "blank").otherwise("sync")).orderBy(F.col(date).desc_nulls_last(), id_col)
    return out.limit(limit) if limit else out


def eligible(episodes: DataFrame, done: DataFrame, key: str, as_of, grace_days: int = 7, window_days: int = 90, backfill: bool = False, notes_only: Column | None = None) -> DataFrame:
    """Episodes ready for extraction and what to read: the transcript, or the notes once the grace is over.

    Episodes of sources that never have transcripts (``notes_only``) are ready at once. Without ``backfill`` only the
    window counts.
    """
    age = F.datediff(F.lit(as_of), F.col("publish_date"))
    at_once = notes_only if notes_only is not None else F.lit(False)
    source = F.when(F.col("transcript").isNotNull(), "transcript").when(F.col("notes").isNotNull() & (at_once | (age > grace_days)), "show_notes")
    out = episodes.withColumn("read", source).where("read is not null")
    if not backfill:
        out = out.where(age <= window_days)
    return out.join(done.select(key), key, "left_anti")


def damaged_batches(rows: DataFrame, batch: str, item: str, damaged: Column) -> DataFrame:
    """(batch, items, n): batches with a damaged row, with all their items."""
    bad = rows.where(damaged).select(batch).distinct()
    return rows.join(bad, batch, "left_semi").groupBy(batch).agg(F.array_join(F.array_sort(F.collect_set(F.col(item).cast("string"))), ",").alias("items"), F.countDistinct(item).alias("n"))


def _dealt(rows: DataFrame, *order: Column | str) -> DataFrame:
    """Rows in ranges of the order, with the range's number ``__p``, written once.

    Two branches read the numbers, and a branch that dealt the rows anew could draw other bounds. The frame goes to the
    folder in spark.checkpoint.dir; a session without one keeps it in its executors.
    """
    dealt = rows.repartitionByRange(*order).withColumn("__p", F.spark_partition_id())
    return dealt.checkpoint() if rows.sparkSession.conf.get("spark.checkpoint.dir", None) else dealt.persist()


def within_budget(groups: DataFrame, order: str, size: str, cap: int) -> DataFrame:
    """Whole groups in order until the sum reaches the cap; at least the first.

    The running sum takes two passes as in batch_ids(): inside ranges of the order, and over the ranges' totals.
    """
    dealt = _dealt(groups, order)
    so_far = lambda w: w.rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = dealt.withColumn("__s", F.sum(size).over(so_far(W.partitionBy("__p").orderBy(order))))
    sums = dealt.groupBy("__p").agg(F.sum(size).alias("__t"))
    base = sums.select("__p", (F.sum("__t").over(so_far(W.orderBy("__p"))) - F.col("__t")).alias("__b"))
    out = inside.join(base, "__p").withColumn("total", F.col("__b") + F.col("__s")).drop("__p", "__s", "__b")
    first = dealt.agg(F.min(order).alias("__first"))
    return out.join(F.broadcast(first), F.col(order) == F.col("__first"), "left").where(F.col("__first").isNotNull() | (F.col("total") <= cap)).drop("__first")


def capped_intake(candidates: DataFrame, known: DataFrame, key: str, cap: int, *order: Column) -> tuple[DataFrame, DataFrame]:
    """The first ``cap`` new candidates, and one row with the number of those left out."""
    new = candidates.join(known.select(key), key, "left_anti")
    return new.orderBy(*order).limit(cap), new.agg(F.greatest(F.count("*") - cap, F.lit(0)).alias("dropped"))


def import_accounting(rows: DataFrame, group: str, outcome: Column, outcomes: list[str]) -> DataFrame:
    """Rows of each group by outcome."""
    return rows.withColumn("__o", outcome).groupBy(group).agg(*(F.count_if(F.col("__o") == o).alias(o) for o in outcomes))


def batch_ids(rows: DataFrame, size: int, *order: Column) -> DataFrame:
    """Adds batch, pos: rows in order, ``size`` to a batch.

    Two passes instead of one global window: rows are range-partitioned by the order, numbered inside each partition,
    and the partitions' counts (few rows) give the offsets.
    """
    dealt = _dealt(rows, *order)
    inside = dealt.withColumn("__n", F.row_number().over(W.partitionBy("__p").orderBy(*order)) - 1)
    counts = dealt.groupBy("__p").agg(F.count("*").alias("__c"))
    base = counts.select("__p", (F.sum("__c").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("__c")).alias("__b"))
    pos = F.col("__b") + F.col("__n")
    return inside.join(F.broadcast(base), "__p").withColumns({"batch": F.floor(pos / size), "pos": (pos % size).cast("long")}).drop("__p", "__n", "__b")
