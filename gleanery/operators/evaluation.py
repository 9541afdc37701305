"""Scores of extraction runs against gold labels and frozen baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import entity_key


def collapse_mentions(mentions: DataFrame) -> DataFrame:
    """(episode_id, key, entity_type, confidence, n): mentions (episode_id, pos, canonical_name, entity_type, confidence) by name.

    The type is that of the surest mention, ties by how often the type occurs, then by position.
    """
    m = mentions.withColumn("key", entity_key(F.col("canonical_name"))).where("key <> ''")
    freq = F.count("*").over(W.partitionBy("episode_id", "key", "entity_type"))
    best = F.struct(F.coalesce("confidence", F.lit(-1.0)), F.col("freq"), -F.col("pos"))
    return m.withColumn("freq", freq).groupBy("episode_id", "key").agg(F.max_by("entity_type", best).alias("entity_type"), F.max("confidence").alias("confidence"), F.count("*").alias("n"))


def _or_one(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(1.0)).otherwise(part / whole)


def precision_recall(predicted: DataFrame, truth: DataFrame, group: str, key: str, kind: str) -> DataFrame:
    """Precision, recall, F1 and type accuracy for each group; empty output has precision 1, empty truth recall 1."""
    p = predicted.select(group, key, F.col(kind).alias("pk"), F.lit(1).alias("p"))
    t = truth.select(group, key, F.col(kind).alias("tk"), F.lit(1).alias("t"))
    both = p.join(t, [group, key], "full_outer")
    n = both.groupBy(group).agg(F.count("p").alias("predicted"), F.count("t").alias("truth"), F.count_if(F.col("p").isNotNull() & F.col("t").isNotNull()).alias("hits"), F.count_if(F.col("pk") == F.col("tk")).alias("typed"))
    precision, recall = _or_one(F.col("hits"), F.col("predicted")), _or_one(F.col("hits"), F.col("truth"))
    f1 = F.when(precision + recall == 0, F.lit(0.0)).otherwise(2 * precision * recall / (precision + recall))
    return n.select(group, "predicted", "truth", "hits", F.bround(precision, 4).alias("precision"), F.bround(recall, 4).alias("recall"), F.bround(f1, 4).alias("f1"), F.bround(_or_one(F.col("typed"), F.col("hits")), 4).alias("type_accuracy"))


def drift(now: DataFrame, baseline: DataFrame, group: str, key: str, kind: str, confidence: str, core_from: float = 0.9) -> DataFrame:
    """Jaccard, retained, dropped, added, type changes, mean confidence change and recall of core entities by group."""
    a = now.select(group, key, F.col(kind).alias("ak"), F.col(confidence).alias("ac"), F.lit(1).alias("a"))
    b = baseline.select(group, key, F.col(kind).alias("bk"), F.col(confidence).alias("bc"), F.lit(1).alias("b"))
    x = a.join(b, [group, key], "full_outer")
    kept = F.col("a").isNotNull() & F.col("b").isNotNull()
    core = F.col("b").isNotNull() & (F.col("bc") >= core_from)
    n = x.groupBy(group).agg(
        F.count_if(kept).alias("retained"),
        F.count_if(F.col("a").isNull()).alias("dropped"),
        F.count_if(F.col("b").isNull()).alias("added"),
        F.count_if(kept & (F.col("ak") != F.col("bk"))).alias("type_changes"),
        F.bround(F.avg(F.when(kept, F.abs(F.col("ac") - F.col("bc")))), 4).alias("confidence_delta"),
        F.count_if(core).alias("__core"),
        F.count_if(core & kept).alias("__kept"),
    )
    union = F.col("retained") + F.col("dropped") + F.col("added")
    jaccard = F.bround(_or_one(F.col("retained"), union), 4)
    return n.select(group, jaccard.alias("jaccard"), "retained", "dropped", "added", "type_changes", "confidence_delta", F.bround(F.try_divide(F.col("__kept"), F.col("__core")), 4).alias("core_recall"))


def confidence_contract(rows: DataFrame, confidence: Column) -> DataFrame:
    """One row: how many confidences are present, missing or out of range, their range and distinct values at 2 places."""
    c = rows.select(confidence.try_cast("double").alias("c"))
    return c.agg(F.count("*").alias("n"), F.count_if(F.col("c").isNull()).alias("missing"), F.count_if((F.col("c") < 0) | (F.col("c") > 1)).alias("out_of_range"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.countDistinct(F.bround("c", 2)).alias("distinct_2dp"))


def macro_average(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Means over groups, nulls left out."""
    return rows.agg(*(F.bround(F.avg(c), 4).alias(c) for c in columns))


def distribution_shift(now: DataFrame, baseline: DataFrame, kind: str) -> DataFrame:
    """(type, now, baseline, delta): shares of each type and their difference."""
    def share(rows: DataFrame, name: str) -> DataFrame:
        counts = rows.groupBy(kind).agg(F.count("*").alias("n"))
        return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("all")))).select(kind, (F.col("n") / F.col("all")).alias(name))

    x = share(now, "now").join(share(baseline, "baseline"), kind, "full_outer").na.fill(0.0)
    return x.withColumn("delta", F.bround(F.col("now") - F.col("baseline"), 4))


# Limits of a report.
FLOORS = {"yield_low": 0.55, "yield_high": 1.70, "shift": 0.20, "gold_recall": 0.60, "type_accuracy": 0.80}


def breaches(report: DataFrame) -> DataFrame:
    """Names of the limits that a report (yield_ratio, max_shift, gold_recall, type_accuracy, failures, out_of_range) breaks."""
    f = FLOORS
    rules = {
        "yield": ~F.col("yield_ratio").between(f["yield_low"], f["yield_high"]),
        "shift": F.col("max_shift") > f["shift"],
        "gold_recall": F.col("gold_recall") < f["gold_recall"],
        "type_accuracy": F.col("type_accuracy") < f["type_accuracy"],
        "failures": F.col("failures") > 0,
        "confidence": F.col("out_of_range") > 0,
    }
    named = F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()))
    return report.withColumn("breaches", F.filter(named, lambda x: x.isNotNull()))
