"""Roll-ups and reports over mentions, episodes and sync rows.

All are grouped sums with partial aggregation before the shuffle; "newest context" is a maximum over a struct, so hot
entities need no window and no collected group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_runs(mentions: DataFrame) -> DataFrame:
    """Mentions of the latest run of each episode only."""
    last = mentions.groupBy("episode_id").agg(F.max("run_id").alias("run_id"))
    return mentions.join(last, ["episode_id", "run_id"])


def repeated_mentions(mentions: DataFrame, least: int = 2) -> DataFrame:
    """Entities by show, type and name that occur in ``least`` episodes or more, with dates, links and review counts."""
    linked = F.col("source_url").isNotNull()
    out = latest_runs(mentions).groupBy("show_id", "mention_type", "canonical_name").agg(
        F.count("*").alias("mention_rows"),
        F.countDistinct("episode_id").alias("episodes"),
        F.min("publish_date").alias("first_date"),
        F.max("publish_date").alias("last_date"),
        F.count_if(linked).alias("linked"),
        F.count_if("needs_review").alias("review"),
    )
    share = F.round(F.try_divide(F.col("linked").cast("double"), F.col("mention_rows")), 4)
    return out.where(F.col("episodes") >= least).withColumn("link_coverage", share)


def newest(value: Column, when: Column, tie: Column) -> Column:
    """Aggregate: the value with the greatest date, undated rows last, ties to the smaller id."""
    rank = F.struct(when.isNotNull(), when, -tie)
    return F.max_by(value, rank)


def entity_rollup(mentions: DataFrame, least: int, curated: Column) -> DataFrame:
    """Mentions, episodes, dates and newest context of each entity, if it has ``least`` episodes or a curated mention."""
    out = mentions.groupBy("entity_id").agg(
        F.count("*").alias("mentions"),
        F.countDistinct("episode_id").alias("items"),
        F.min("publish_date").alias("first_date"),
        F.max("publish_date").alias("last_date"),
        newest(F.col("canonical_name"), F.col("publish_date"), F.col("mention_id")).alias("newest_name"),
        newest(F.col("mention_id"), F.col("publish_date"), F.col("mention_id")).alias("newest_id"),
        F.count_if(curated).alias("curated"),
    )
    return out.where((F.col("items") >= least) | (F.col("curated") >= 1))


def run_summary(runs: DataFrame, mentions: DataFrame) -> DataFrame:
    """Counts for each run, runs without mentions included with zeros."""
    per = mentions.groupBy("run_id").agg(F.countDistinct("episode_id").alias("episodes"), F.countDistinct("mention_id").alias("mentions"), F.countDistinct("entity_id").alias("entities"), F.count_if("needs_review").alias("review"), F.count_if(F.col("source_url").isNotNull()).alias("linked"))
    return runs.select("run_id").join(per, "run_id", "left").na.fill(0)


def top_entities(mentions: DataFrame, n: int, *keys: str) -> DataFrame:
    """The n most mentioned; ties by key."""
    counted = mentions.groupBy(*keys).agg(F.count("*").alias("mentions"))
    return counted.orderBy(F.col("mentions").desc(), *keys).limit(n)


def overlap(mentions: DataFrame, least: int = 2) -> DataFrame:
    """Entities in several episodes."""
    out = mentions.groupBy("mention_type", "canonical_name").agg(F.countDistinct("episode_id").alias("episodes"), F.count("*").alias("mentions"))
    return out.where(F.col("episodes") >= least)


def link_listing(mentions: DataFrame) -> DataFrame:
    """Mentions with their place in the link report: linked ones first, then by confidence, unknown last."""
    linked = F.col("source_url").isNotNull()
    order = [F.when(linked, 0).otherwise(1), F.col("confidence").desc_nulls_last(), F.col("mention_id")]
    return mentions.select("mention_id", "source_url", "confidence").orderBy(*order)


def mention_histograms(mentions: DataFrame) -> DataFrame:
    """(kind, key, n): mentions by type and by (type, name), and those for review."""
    by_type = mentions.groupBy(F.col("mention_type").alias("key")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("type"))
    by_name = mentions.groupBy(F.concat_ws("/", "mention_type", "canonical_name").alias("key")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("name"))
    review = mentions.agg(F.count_if("needs_review").alias("n")).select(F.lit("review").alias("key"), "n", F.lit("review").alias("kind"))
    return by_type.unionByName(by_name).unionByName(review).select("kind", "key", "n")


def pulse(groups: DataFrame, items: DataFrame, key: str, date: str, as_of, recent_days: int = 15) -> DataFrame:
    """Each group's items, newest date, days since, and items of the last days; groups without items included."""
    per = items.groupBy(key).agg(F.count("*").alias("items"), F.max(date).alias("newest"), F.count_if(F.col(date) >= F.date_sub(F.lit(as_of), recent_days)).alias("recent"))
    out = groups.select(key).join(per, key, "left").na.fill(0, ["items", "recent"])
    return out.withColumn("days_since", F.datediff(F.lit(as_of), F.col("newest")).cast("long"))


def safe_ratio(part: Column, whole: Column, digits: int) -> Column:
    """Quotient rounded half up; null where the divisor is 0."""
    return F.round(F.try_divide(part.cast("double"), whole), digits)


def progress(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row: total, with, remaining, by distinct key."""
    marks = items.select(key).distinct().join(done.select(key).distinct().withColumn("__d", F.lit(1)), key, "left")
    out = marks.agg(F.count("*").alias("total"), F.count("__d").alias("done"))
    return out.withColumn("remaining", F.col("total") - F.col("done"))


def dominant(rows: DataFrame, value: str) -> DataFrame:
    """The most frequent value, ties by name."""
    return rows.groupBy(value).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), value).limit(1)


def newest_per_group(rows: DataFrame, group: str, n: int, *order: Column) -> DataFrame:
    """The first n rows of each group. Spark limits the groups before the shuffle, so hot groups stay small."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("rank") <= n)


def failure_rate(outcomes: DataFrame, key: str, failed: Column, alert_over: float = 0.10) -> DataFrame:
    """Failed share by phase, and whether it calls for an alert."""
    out = outcomes.groupBy(key).agg(F.count("*").alias("n"), F.count_if(failed).alias("failed"))
    return out.withColumn("rate", safe_ratio(F.col("failed"), F.col("n"), 4)).withColumn("alert", F.col("failed") > F.col("n") * alert_over)
