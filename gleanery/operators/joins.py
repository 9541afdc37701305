"""Joins that find gaps, orphans, new keys and desired-against-actual differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def without_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks."""
    return left.join(right.select(key), key, "left_anti")


def with_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key ``right`` has, each once."""
    return left.join(right.select(key), key, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Children whose reference is set and points nowhere."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def number_gaps(rows: DataFrame, number: str, step: int = 1_000_000) -> DataFrame:
    """Numbers from 1 to the greatest that do not occur. The range is made in blocks, so no row holds all of it."""
    top = rows.agg(F.max(number).cast("long").alias("top")).where("top is not null")
    blocks = top.select("top", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("top") - 1) / step))).alias("b"))
    every = blocks.select(F.explode(F.sequence(F.col("b") * step + 1, F.least((F.col("b") + 1) * step, F.col("top")))).alias(number))
    return every.join(rows.select(F.col(number).cast("long").alias(number)).distinct(), number, "left_anti")


def resolve_source(rows: DataFrame, domain: Column, sources: DataFrame, default: str) -> DataFrame:
    """Adds ``source`` by domain; ``sources`` (domain, source) is a small table of configuration."""
    return rows.withColumn("domain", domain).join(sources, "domain", "left").withColumn("source", F.coalesce("source", F.lit(default)))


def first_needle(rows: DataFrame, text: str, needles: list[tuple[str, str]]) -> DataFrame:
    """Adds ``needle_value`` of the first needle (in list order) that the text contains; null if none does.

    The list is configuration, so it becomes one expression and needs no join.
    """
    hit = F.lit(None).cast("string")
    for needle, value in reversed(needles):
        hit = F.when(F.lower(text).contains(needle.lower()), value).otherwise(hit)
    return rows.withColumn("needle_value", hit)


def by_domain_or_type(rows: DataFrame, domain: Column, domains: list[str], kind: Column, kinds: list[str]) -> DataFrame:
    return rows.where(domain.isin(*domains) | kind.isin(*kinds))


def provenance(episodes: DataFrame, recorded: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds transcript_id and inferred. A recorded value wins even if it is null; the lookup's counts as inferred."""
    r = recorded.select("episode_id", F.col("transcript_id").alias("__rec"), F.lit(True).alias("__has"))
    k = lookup.select("episode_id", F.col("transcript_id").alias("__look"))
    out = episodes.join(r, "episode_id", "left").join(k, "episode_id", "left")
    own = F.coalesce("__has", F.lit(False))
    return out.withColumns({"transcript_id": F.when(own, F.col("__rec")).otherwise(F.col("__look")), "inferred": ~own & F.col("__look").isNotNull()}).drop("__rec", "__has", "__look")


def to_add(desired: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Keys that are wanted and not there yet, each once."""
    return desired.select(key).where(F.col(key).isNotNull()).distinct().join(actual.select(key), key, "left_anti")


def adopt_or_create(rows: DataFrame, remote: DataFrame, key: str, remote_id: str) -> DataFrame:
    """Adds the remote id and ``action``: adopt where the other side has the row already, else create."""
    one = remote.groupBy(key).agg(F.min(remote_id).alias(remote_id))
    return rows.join(one, key, "left").withColumn("action", F.when(F.col(remote_id).isNotNull(), "adopt").otherwise("create"))


def tiered_match(rows: DataFrame, catalog: DataFrame, tiers: list[tuple[str, str, str]]) -> DataFrame:
    """Match in tiers (band, key column of both, ...): the first tier that hits decides, its least catalog id is taken.

    ``rows`` has id and the key columns; ``catalog`` has catalog_id and the same key columns. Each tier is an equality
    join of what is still open.
    """
    open_rows, done = rows, None
    for band, key, _ in tiers:
        best = catalog.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("catalog_id").alias("catalog_id"))
        hit = open_rows.join(best, key, "left").select("id", "catalog_id", *(c for c in rows.columns if c != "id"))
        got = hit.where("catalog_id is not null").select("id", "catalog_id", F.lit(band).alias("band"))
        done = got if done is None else done.unionByName(got)
        open_rows = hit.where("catalog_id is null").drop("catalog_id")
    return done.unionByName(open_rows.select("id", F.lit(None).cast("long").alias("catalog_id"), F.lit("NOT_FOUND").alias("band")))


def containment_match(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """(id, catalog_id, band): a catalog row of the same artist, else one of an artist with the row's first artist word.

    ``rows`` (id, title, artist), ``catalog`` (catalog_id, title, artist). Of the same artist (equal in lower case) the
    titles must share a word: HIGH if one holds the other, else MEDIUM. LOW needs a shared title word and the first word
    of the artist among the artist's words of the catalog. Better bands first, then the least catalog_id. All joins are
    equalities on (artist, title word). MEDIUM and LOW ask for the least catalog_id alone, so they meet one row for each
    artist (or artist word) and title word; HIGH compares different titles of one artist that share a word, each once.
    """
    form = lambda c: F.lower(F.trim(c))
    split = lambda c: F.array_distinct(F.array_remove(F.split(c, r"[^\p{L}\p{N}#]+"), ""))
    least = F.min(F.struct("catalog_id")).alias("x")
    r = rows.select("id", form("title").alias("t"), form("artist").alias("a"))
    rw = r.select("t", "a").distinct().withColumn("w", F.explode(split(F.col("t"))))
    c = catalog.groupBy(form("title").alias("ct"), form("artist").alias("a")).agg(least).select("ct", "a", "x.catalog_id")
    cw = c.withColumn("w", F.explode(split(F.col("ct"))))
    holds = F.col("t").contains(F.col("ct")) | F.col("ct").contains(F.col("t"))
    high = rw.join(cw, ["a", "w"]).where(holds)
    medium = rw.join(cw.groupBy("a", "w").agg(least), ["a", "w"])
    by_word = cw.select(F.explode(split(F.col("a"))).alias("aw"), "w", "catalog_id").groupBy("aw", "w").agg(least)
    low = rw.withColumn("aw", F.get(split(F.col("a")), F.lit(0))).join(by_word, ["aw", "w"])
    found = [x.select("t", "a", F.struct(F.lit(tier).alias("tier"), F.col(of).alias("catalog_id")).alias("x")) for tier, x, of in ((0, high, "catalog_id"), (1, medium, "x.catalog_id"), (2, low, "x.catalog_id"))]
    each = found[0].unionByName(found[1]).unionByName(found[2]).groupBy("t", "a").agg(F.min("x").alias("x"))
    best = r.join(each, ["t", "a"]).groupBy("id").agg(F.min("x").alias("x"))
    band = F.element_at(F.array(F.lit("HIGH"), F.lit("MEDIUM"), F.lit("LOW")), F.col("x.tier") + 1)
    return rows.select("id").join(best, "id", "left").select("id", "x.catalog_id", F.when(F.col("x").isNull(), "NOT_FOUND").otherwise(band).alias("band"))


def best_per(rows: DataFrame, key: str, *order: Column, n: int = 1) -> DataFrame:
    return rows.withColumn("__r", F.row_number().over(W.partitionBy(key).orderBy(*order))).where(F.col("__r") <= n).drop("__r")
