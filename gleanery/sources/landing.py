"""Landing of files that change: a table of their contents that a run brings up to date by reading what is new.

The listing (path, time, size) is read without contents. Contents are read from the oldest time that the listing shows
as new or changed on; Spark's reader of binary files skips older ones by that filter. What a file holds is told by its
hash, so one that was only touched changes nothing, and files that are gone leave the table. Spark's file sources don't
show empty files, so a file that was emptied is gone.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sinks import delete_keys, upsert_buckets, write_buckets

FILES = "path string, modified timestamp, length long, hash string, content string"


def _files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return reader.load(path)


def landed(spark: SparkSession, table: str) -> DataFrame:
    """The table of contents so far; empty before the first run."""
    try:
        return spark.read.schema(FILES).parquet(table)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], FILES)
        raise


def changes(spark: SparkSession, path: str, table: str, pattern: str = "*") -> tuple[DataFrame | None, DataFrame]:
    """(fresh, gone): contents of files that may be new or changed, None if there are none, and the paths that are gone.

    A file counts as seen if path, time and size are those of the table. A file with an old time that was moved in is
    new by its path, and the contents are then read from its time on.
    """
    now = _files(spark, path, pattern).select("path", F.col("modificationTime").alias("modified"), "length")
    old = landed(spark, table).select("path", "modified", "length")
    unseen = now.join(old, ["path", "modified", "length"], "left_anti")
    gone = old.select("path").join(now.select("path"), "path", "left_anti")
    since = unseen.agg(F.min("modified")).first()[0]
    if since is None:
        return None, gone
    fresh = _files(spark, path, pattern).where(F.col("modificationTime") >= F.lit(since))
    return fresh.select("path", F.col("modificationTime").alias("modified"), "length", F.sha2("content", 256).alias("hash"), F.col("content").cast("string").alias("content")), gone


def land_files(spark: SparkSession, path: str, table: str, pattern: str = "*", buckets: int = 64) -> None:
    """Bring the table at ``table`` up to date with the files under ``path``; folders without a change aren't written."""
    fresh, gone = changes(spark, path, table, pattern)
    first = not landed(spark, table).limit(1).count()
    gone = gone.checkpoint() if spark.conf.get("spark.checkpoint.dir", None) else gone.persist()
    if fresh is not None:
        if first:
            write_buckets(fresh, table, "path", buckets)
        else:
            known = landed(spark, table).select("path", F.col("modified").alias("m"), F.col("hash").alias("h"))
            changed = fresh.join(known, "path", "left").where(F.col("h").isNull() | (F.col("h") != F.col("hash")) | (F.col("m") != F.col("modified"))).drop("m", "h")
            upsert_buckets(changed, table, "path", F.col("modified").desc(), buckets=buckets)
    if not first:
        delete_keys(gone, table, "path", buckets)
