"""Table maintenance on plain Parquet: upserts, batch replacement, sync state, payloads, text pieces, repairs.

A table that is upserted lies in folders by a hash of its key. An upsert reads and writes the folders of incoming keys
alone; Spark's dynamic overwrite puts them in place when the job has succeeded, so one that fails leaves the table as it
was. One writer at a time; readers that began before must not be reading the folders that change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_buckets(rows: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Write a new table in folders by a hash of the key; rows without one go."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    rows.where(F.col(key).isNotNull()).withColumn("bucket", bucket).repartition("bucket").write.partitionBy("bucket").parquet(path)


def upsert_buckets(incoming: DataFrame, path: str, key: str, order: Column, keep_old_when_null: list[str] = (), buckets: int = 64) -> None:
    """Put rows over the table at ``path`` by key, as upsert() does; folders without an incoming key aren't touched.

    The folders are at most ``buckets`` numbers; they are named in the read, so Spark prunes the others. ``created``
    tells for each row of a touched folder whether this upsert made it. A repeated upsert changes nothing but that flag.
    """
    spark = incoming.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    touched = [r[0] for r in incoming.where(F.col(key).isNotNull()).select(bucket).distinct().collect()]
    if touched:
        old = spark.read.parquet(path).where(F.col("bucket").isin(*touched))
        new = upsert(old.drop("bucket", "created"), incoming, key, order, keep_old_when_null).withColumn("bucket", bucket)
        new.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def delete_keys(keys: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Take rows out of the table at ``path`` by key; folders without such a key aren't touched.

    A folder of which no row is left keeps an empty file, as an overwrite of nothing would leave the folder as it is.
    """
    spark = keys.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    touched = [r[0] for r in keys.where(F.col(key).isNotNull()).select(bucket).distinct().collect()]
    if not touched:
        return
    old = spark.read.parquet(path).where(F.col("bucket").isin(*touched))
    left = old.join(keys.select(key).distinct(), key, "left_anti")
    full = {r[0] for r in left.select("bucket").distinct().collect()}
    if full:
        left.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    for empty in sorted(set(touched) - full):
        spark.createDataFrame([], left.drop("bucket").schema).write.mode("overwrite").parquet(f"{path}/bucket={empty}")


def upsert(existing: DataFrame | None, incoming: DataFrame, key: str, order: Column, keep_old_when_null: list[str] = ()) -> DataFrame:
    """Existing rows with the incoming ones put over them by key, and a flag ``created``.

    Of several incoming rows for a key the first by ``order`` counts. Columns in ``keep_old_when_null`` keep the old
    value where the new one is null; all others are overwritten, nulls included.
    """
    from .joins import best_per

    new = best_per(incoming.where(F.col(key).isNotNull()), key, order)
    if existing is None:
        return new.withColumn("created", F.lit(True))
    cols = [c for c in new.columns if c != key]
    old = existing.select(key, F.struct(*cols).alias("o"), F.lit(True).alias("has_old"))
    both = old.join(new.select(key, F.struct(*cols).alias("n"), F.lit(True).alias("has_new")), key, "full_outer")
    value = lambda c: F.when(F.col("has_new"), F.coalesce(f"n.{c}", f"o.{c}") if c in keep_old_when_null else F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return both.select(key, *(value(c).alias(c) for c in cols), F.col("has_old").isNull().alias("created"))


def replace_batches(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write rows so that the batches they belong to are replaced whole and all others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def sync_state(events: DataFrame, key: str) -> DataFrame:
    """Latest state of each row from append-only sync events (key, at, event_id, state, page_id, error); errors are cut to 500."""
    last = events.groupBy(key).agg(F.max_by(F.struct("state", "page_id", "error", "at"), F.struct("at", "event_id")).alias("x"))
    return last.select(key, "x.state", "x.page_id", F.substring("x.error", 1, 500).alias("error"), "x.at")


def page_payload(rows: DataFrame, key: str, properties: dict[str, Column], most: int = 2000) -> DataFrame:
    """(key, payload): a JSON object of the properties; texts are cut and nulls left out."""
    def cut(c: Column, kind: str) -> Column:
        return F.substring(c, 1, most) if kind == "string" else c

    typed = rows.select(key, *(c.alias(n) for n, c in properties.items()))
    kinds = dict(typed.dtypes)
    return typed.select(key, F.to_json(F.struct(*(cut(F.col(n), kinds[n]).alias(n) for n in properties))).alias("payload"))


def pieces_of(text: str, most: int) -> list[str]:
    """Pieces of at most ``most`` characters, cut behind the last blank that fits, or hard where there is none; the rule of text_pieces()."""
    out, at = [], 0
    if not text.strip():
        return out
    while len(text) - at > most:
        cut = max(text.rfind(b, at, at + most) for b in " \n\t")
        end = cut if cut > at else at + most
        out.append(text[at:end])
        at = end + 1 if cut > at else end
    out.append(text[at:])
    return [p for p in out if p]


#: What str.strip() takes for blank, as a class of characters.
_BLANK = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def text_pieces(rows: DataFrame, key: str, text: str, most: int = 1900, per_request: int = 100) -> DataFrame:
    """(key, request, pos, piece): text in pieces as pieces_of() cuts it, ``per_request`` to a request.

    A match is what is left if it fits, else up to the last blank that does, else a hard cut; one that isn't the last ends
    with a blank only if it was cut there.
    """
    at_blank = rf".{{1,{most - 1}}}[ \n\t]|" if most > 1 else ""
    found = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{most}}}\z|{at_blank}.{{{most}}}"), F.lit(0))
    each = rows.select(key, F.when(F.col(text).rlike(f"[^{_BLANK}]"), found).alias("found")).select(key, F.size("found").alias("n"), F.posexplode("found").alias("pos", "piece"))
    cut = (F.col("pos") < F.col("n") - 1) & F.right("piece", F.lit(1)).isin(" ", "\n", "\t") & F.lit(most > 1)
    piece = F.when(cut, F.col("piece").substr(F.lit(1), F.length("piece") - 1)).otherwise(F.col("piece"))
    return each.select(key, "pos", piece.alias("piece"), F.floor(F.col("pos") / per_request).cast("int").alias("request"))


def fill_missing(rows: DataFrame, repaired: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with nulls filled from a repaired source, and ``changed``: the columns with old and new value."""
    r = repaired.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    x = rows.join(r, key, "left")
    change = lambda c: F.when(F.col(c).isNull() & F.col(f"__{c}").isNotNull(), F.struct(F.lit(c).alias("column"), F.col(f"__{c}").cast("string").alias("new")))
    x = x.withColumn("changed", F.filter(F.array(*(change(c) for c in columns)), lambda y: y.isNotNull()))
    return x.withColumns({c: F.coalesce(c, f"__{c}") for c in columns}).drop(*(f"__{c}" for c in columns))


def write_batch(mentions: DataFrame, path: str) -> None:
    """Mentions, review queue, summary by episode and manifest of one batch, each from one stored frame."""
    out = f"{path}/mentions"
    mentions.write.mode("overwrite").parquet(out)
    m = mentions.sparkSession.read.parquet(out)
    m.where("needs_review").select("episode_id", "canonical_name", "mention_type", "confidence").write.mode("overwrite").option("header", True).csv(f"{path}/review_queue")
    per = m.groupBy("episode_id").agg(F.count("*").alias("mention_count"), F.count_if("needs_review").alias("review_count"))
    per.write.mode("overwrite").option("header", True).csv(f"{path}/episode_summary")
    types = m.groupBy("mention_type").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("mention_type", "n")))).alias("summary"))
    types.crossJoin(per.agg(F.count("*").alias("episodes"), F.sum("mention_count").alias("mentions"))).write.mode("overwrite").json(f"{path}/manifest")
