"""Registration of queries, and the views of the test tables that several queries share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL twin if SQL can express it."""

    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the storage that the cluster shares; only a local session may do without such a setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-gleanery-", dir="/tmp")
    return f"{root.rstrip('/')}/gleanery/{name}-{uuid.uuid4().hex}"


#: Views in SQL that Spark and the oracle read alike: events as mentions, documents as episodes, orders as sync rows.
MENTIONS = """
SELECT event_id AS mention_id, event_id % 997 AS episode_id, (event_id % 997) % 7 AS show_id,
       CAST(floor(event_id / 100) AS BIGINT) AS run_id, user_id AS entity_id,
       concat('Name ', CAST(user_id % 60 AS VARCHAR(12))) AS canonical_name, event_type AS mention_type,
       least(value / 50, 1.0) AS confidence, CAST(ts AS DATE) AS publish_date, value < 5 AS needs_review,
       CASE WHEN user_id % 3 = 0 THEN concat('https://site.example/', CAST(user_id AS VARCHAR(12))) END AS source_url,
       props
FROM events"""
EPISODES = """
SELECT doc_id AS id, source AS show_slug, doc_id % 1000 AS number, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE split_part(text, chr(10), 1) END AS title,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE text END AS transcript, text AS notes,
       CASE WHEN doc_id % 13 = 0 THEN NULL ELSE DATE '2024-01-01' + CAST(doc_id % 120 AS INTEGER) END AS publish_date, n_chars
FROM documents"""
SYNC = """
SELECT o_orderkey AS id, o_custkey AS entity_id, o_orderpriority AS grp,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('page-', CAST(o_orderkey AS VARCHAR(20))) END AS page_id,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 3 END AS synced_on,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 8 AS INTEGER) AS updated_on, CAST(o_orderdate AS DATE) AS last_on,
       o_totalprice AS amount
FROM orders"""


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """One of the views above (or any SQL on one test table), bound to the tables of ``sf_dir``."""
    name = sql.split("FROM")[-1].split()[0]
    return spark.sql(sql.replace(f"FROM {name}", "FROM {source}"), source=table(spark, sf_dir, name))
