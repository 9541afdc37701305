"""Duplicate groups, survivors, merges of donors, entities and their aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import alias_key, compact_key, entity_key
from ..functions.urls import canonical_url


def duplicate_groups(rows: DataFrame, id_col: str, *keys: Column) -> DataFrame:
    """(k1, k2, ..., n, keep): groups of rows that share every key, none of which is null, and their least id."""
    named = [k.alias(f"k{i}") for i, k in enumerate(keys, 1)]
    cols = [f"k{i}" for i in range(1, len(keys) + 1)]
    out = rows.select(F.col(id_col), *named).na.drop(subset=cols).groupBy(*cols).agg(F.count("*").alias("n"), F.min(id_col).alias("keep"))
    return out.where("n > 1")


def survivor_score(rules: list[tuple[Column, int]]) -> Column:
    """Sum of the points of the conditions that hold."""
    score = F.lit(0)
    for condition, points in rules:
        score = score + F.when(F.coalesce(condition, F.lit(False)), points).otherwise(0)
    return score


def choose_survivor(rows: DataFrame, id_col: str, score: Column, *keys: str) -> DataFrame:
    """(id, survivor): the row of each group with the best score, ties to the least id. One grouped maximum, no window."""
    best = rows.groupBy(*keys).agg(F.max_by(id_col, F.struct(score, -F.col(id_col))).alias("survivor"))
    return rows.join(best, list(keys)).select(id_col, "survivor")


def merge_donors(rows: DataFrame, id_col: str, survivors: DataFrame, fill: list[str], flags: list[str] = (), latest: list[str] = ()) -> DataFrame:
    """One row for each survivor: nulls are filled from donors in order of id, flags are true if any is, dates the latest.

    A flag is null only if it is null in all rows.
    """
    both = rows.join(survivors.select(id_col, "survivor"), id_col)
    own = F.col(id_col) != F.col("survivor")
    order = lambda c: F.when(F.col(c).isNotNull(), F.struct(own, F.col(id_col)))
    aggs = [F.min_by(c, order(c)).alias(c) for c in fill] + [F.bool_or(c).alias(c) for c in flags] + [F.max(c).alias(c) for c in latest]
    return both.groupBy(F.col("survivor").alias(id_col)).agg(*aggs)


def repoint(children: DataFrame, ref: str, survivors: DataFrame, id_col: str, unique: list[str]) -> DataFrame:
    """Children with their reference moved to the survivor, and of equal children one."""
    m = survivors.select(F.col(id_col).alias(ref), "survivor")
    out = children.join(m, ref, "left").withColumn(ref, F.coalesce("survivor", ref)).drop("survivor")
    return out.dropDuplicates([ref, *unique])


def keep_lowest(rows: DataFrame, id_col: Column, *keys: str) -> DataFrame:
    """One row for each key: the one with the least id."""
    return rows.withColumn("__r", F.row_number().over(W.partitionBy(*keys).orderBy(id_col))).where("__r = 1").drop("__r")


def merge_aliases(rows: DataFrame, key: str, position: Column, alias: str) -> DataFrame:
    """(key, aliases): aliases in order of position, of equal entity keys the first spelling, blanks dropped."""
    norm = entity_key(F.col(alias))
    one = rows.withColumn("__n", norm).where("__n <> ''").groupBy(key, "__n").agg(F.min(F.struct(position.alias("p"), F.col(alias).alias("a"))).alias("x"))
    # An entity's distinct spellings: small next to its mentions.
    return one.groupBy(key).agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["a"]).alias("aliases"))


def backfill_aliases(entities: DataFrame, mentions: DataFrame) -> DataFrame:
    """(id, aliases) of the entities whose aliases grow: own ones first, then spellings of mentions in order, then the name.

    ``entities`` (id, canonical_name, aliases array), ``mentions`` (entity_id, mention_text). Of spellings with one alias
    key the first stays. Spellings are made distinct before they are collected.
    """
    own = entities.select("id", F.posexplode("aliases").alias("p", "a")).select("id", F.lit(0).alias("g"), "p", F.trim("a").alias("a"))
    said = mentions.select(F.col("entity_id").alias("id"), F.lit(1).alias("g"), F.lit(0).alias("p"), F.col("mention_text").alias("a")).join(entities.select("id"), "id", "left_semi").distinct()
    name = entities.select("id", F.lit(2).alias("g"), F.lit(0).alias("p"), F.col("canonical_name").alias("a"))
    every = own.unionByName(said).unionByName(name).withColumn("k", alias_key(F.col("a"))).where("k <> ''")
    first = every.groupBy("id", "k").agg(F.min(F.struct("g", "p", "a")).alias("x"))
    out = first.groupBy("id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["a"]).alias("aliases"), F.count_if(F.col("x.g") == 0).alias("had"))
    return out.where(F.size("aliases") > F.col("had")).select("id", "aliases")


def build_entities(mentions: DataFrame) -> DataFrame:
    """(entity_type, normalized_name, platform, canonical_name, n, aliases) from mentions in order of ``pos``.

    The first mention of each key in a batch names the entity; other spellings become aliases.
    """
    m = mentions.withColumn("normalized_name", entity_key(F.col("canonical_name"))).where("normalized_name <> ''").withColumn("platform", F.coalesce("platform", F.lit("")))
    keys = ["entity_type", "normalized_name", "platform"]
    named = m.groupBy(*keys).agg(F.min_by("canonical_name", "pos").alias("canonical_name"), F.count("*").alias("n"), F.array_sort(F.collect_set("mention_text")).alias("spellings"))
    return named.select(*keys, "canonical_name", "n", F.filter("spellings", lambda s: s != F.col("canonical_name")).alias("aliases"))


def exact_merges(entities: DataFrame) -> DataFrame:
    """(id, winner): entities of a type with equal names, whatever the platform; the least id wins."""
    win = entities.groupBy("entity_type", "normalized_name").agg(F.min("id").alias("winner"))
    return entities.join(win, ["entity_type", "normalized_name"]).select("id", "winner")


def curated_merges(entities: DataFrame, merges: DataFrame, rounds: int = 20) -> DataFrame:
    """(id, winner) from a list (entity_type, winner_name, loser_name) of normalised names; missing pairs are skipped.

    Chains are followed to their end; a cycle ends at its least id. The list is configuration and is broadcast.
    """
    e = entities.groupBy("entity_type", "normalized_name").agg(F.min("id").alias("id"))
    m = merges
    a = m.join(e.select("entity_type", F.col("normalized_name").alias("loser_name"), F.col("id").alias("loser")), ["entity_type", "loser_name"])
    pairs = a.join(e.select("entity_type", F.col("normalized_name").alias("winner_name"), F.col("id").alias("to")), ["entity_type", "winner_name"]).where("loser <> to").groupBy("loser").agg(F.min("to").alias("to"))
    step = pairs.select(F.col("loser").alias("id"), F.col("to").alias("winner"), F.least("loser", "to").alias("low"))
    for _ in range(rounds.bit_length()):  # each turn doubles the length of chain that is followed
        nxt = step.select(F.col("id").alias("winner"), F.col("winner").alias("w2"), F.col("low").alias("l2"))
        step = step.join(nxt, "winner", "left").select("id", F.when(F.col("w2") == F.col("id"), F.least("id", "winner")).otherwise(F.coalesce("w2", "winner")).alias("winner"), F.least("low", F.coalesce("l2", "low")).alias("low"))
    return entities.join(step.select("id", F.col("winner").alias("__w")), "id", "left").select("id", F.coalesce("__w", "id").alias("winner"))


def alias_splits(entities: DataFrame, name: str, id_col: str, kind: str) -> DataFrame:
    """Names of one type that are equal without blanks and signs but differ as entity keys."""
    e = entities.withColumns({"compact": compact_key(F.col(name)), "key": entity_key(F.col(name))}).where("compact <> ''")
    out = e.groupBy(kind, "compact").agg(F.countDistinct("key").alias("keys"), F.array_join(F.array_sort(F.collect_set("key")), "|").alias("names"))
    return out.where("keys > 1")


def collapse_urls(rows: DataFrame, url: str, count: str, when: str, tie: str, keep: list[str]) -> DataFrame:
    """One row for each canonical address: counts added, other fields from the newest spelling."""
    newest = F.struct(F.col(when).isNotNull(), F.col(when), -F.col(tie))
    return rows.withColumn("canonical", canonical_url(F.col(url))).groupBy("canonical").agg(F.sum(count).alias(count), *(F.max_by(c, newest).alias(c) for c in keep))


def upsert_oneoff(existing: DataFrame, incoming: DataFrame, title: str, quality: str) -> DataFrame:
    """By lower-case title, the better source quality of both sides; flags created and upgraded. Never a downgrade."""
    key = F.lower(F.trim(title))
    best = incoming.withColumn("__k", key).groupBy("__k").agg(F.max_by(F.struct(*incoming.columns), F.struct(F.col(quality), F.col(title))).alias("new"))
    old = existing.withColumn("__k", key).groupBy("__k").agg(F.max_by(F.struct(*existing.columns), F.struct(F.col(quality), F.col(title))).alias("old"))
    both = old.join(best, "__k", "full_outer")
    better = F.col("old").isNull() | (F.col(f"new.{quality}") > F.col(f"old.{quality}"))
    took = F.when(F.col("new").isNotNull() & better, F.col("new")).otherwise(F.col("old"))
    return both.select("__k", took.alias("row"), F.col("old").isNull().alias("created"), (F.col("old").isNotNull() & F.col("new").isNotNull() & better).alias("upgraded")).select(F.col("__k").alias("key"), "row.*", "created", "upgraded")
