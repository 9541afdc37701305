"""Roll-ups and reports over the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import rollups as R
from .base import EPISODES, MENTIONS, query, table, view

_M = f"WITH m AS ({MENTIONS})"
_DAY = dt.date(1998, 8, 2)


@query(
    "a01_repeated_mentions",
    f"""{_M}, l AS (SELECT episode_id, max(run_id) AS run_id FROM m GROUP BY 1)
    SELECT show_id, mention_type, canonical_name, count(*) AS mention_rows, count(DISTINCT episode_id) AS episodes, min(publish_date) AS first_date, max(publish_date) AS last_date,
    count(source_url) AS linked, count(*) FILTER (needs_review) AS review, round(count(source_url) / count(*), 4) AS link_coverage
    FROM m JOIN l USING (episode_id, run_id) GROUP BY ALL HAVING count(DISTINCT episode_id) >= 2""",
)
def a01(spark, sf_dir):
    return R.repeated_mentions(view(spark, sf_dir, MENTIONS))


@query(
    "a02_entity_rollup",
    f"""{_M}, w AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY publish_date DESC NULLS LAST, mention_id) AS rn FROM m)
    SELECT entity_id, count(*) AS mentions, count(DISTINCT episode_id) AS items, min(publish_date) AS first_date, max(publish_date) AS last_date,
    max(CASE WHEN rn = 1 THEN canonical_name END) AS newest_name, max(CASE WHEN rn = 1 THEN mention_id END) AS newest_id, count(*) FILTER (confidence >= 1) AS curated
    FROM w GROUP BY 1 HAVING count(DISTINCT episode_id) >= 70 OR count(*) FILTER (confidence >= 1) >= 1""",
)
def a02(spark, sf_dir):
    return R.entity_rollup(view(spark, sf_dir, MENTIONS), 70, F.col("confidence") >= 1)


@query(
    "a03_run_summary",
    f"""{_M}, r AS (SELECT DISTINCT run_id FROM m UNION ALL SELECT -1)
    SELECT r.run_id, count(DISTINCT episode_id) AS episodes, count(DISTINCT mention_id) AS mentions, count(DISTINCT entity_id) AS entities, count(*) FILTER (needs_review) AS review, count(source_url) AS linked FROM r LEFT JOIN m USING (run_id) GROUP BY 1""",
)
def a03(spark, sf_dir):
    m = view(spark, sf_dir, MENTIONS)
    runs = m.select("run_id").distinct().unionByName(spark.range(1).select((F.col("id") - 1).alias("run_id")))
    return R.run_summary(runs, m)


@query("a04_top_entities", f"{_M} SELECT mention_type, canonical_name, count(*) AS mentions FROM m GROUP BY ALL ORDER BY mentions DESC, mention_type, canonical_name LIMIT 20")
def a04(spark, sf_dir):
    return R.top_entities(view(spark, sf_dir, MENTIONS), 20, "mention_type", "canonical_name")


@query("a05_overlap", f"{_M} SELECT mention_type, canonical_name, count(DISTINCT episode_id) AS episodes, count(*) AS mentions FROM m GROUP BY ALL HAVING count(DISTINCT episode_id) >= 2")
def a05(spark, sf_dir):
    return R.overlap(view(spark, sf_dir, MENTIONS))


@query("a06_filtered_listing", f"WITH e AS ({EPISODES}) SELECT id, show_slug, left(notes, 160) AS preview FROM e WHERE show_slug = 'src1' AND publish_date >= DATE '2024-03-01'")
def a06(spark, sf_dir):
    return view(spark, sf_dir, EPISODES).where("show_slug = 'src1' and publish_date >= date'2024-03-01'").select("id", "show_slug", F.substring("notes", 1, 160).alias("preview")).orderBy("id")


@query("a07_link_listing", f"{_M} SELECT mention_id, source_url, confidence FROM m")
def a07(spark, sf_dir):
    return R.link_listing(view(spark, sf_dir, MENTIONS))


@query("a08_period_top", "SELECT o_custkey, count(*) AS mentions FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1 ORDER BY mentions DESC, o_custkey LIMIT 25")
def a08(spark, sf_dir):
    return R.top_entities(table(spark, sf_dir, "orders").where("o_orderdate >= timestamp_ntz'1995-01-01' and o_orderdate < timestamp_ntz'1996-01-01'"), 25, "o_custkey")


@query("a09_platform_accounts", f"{_M} SELECT mention_id, entity_id FROM m WHERE lower(coalesce(mention_type, '')) IN ('click', 'error')")
def a09(spark, sf_dir):
    return view(spark, sf_dir, MENTIONS).where(F.lower(F.coalesce("mention_type", F.lit(""))).isin("click", "error")).select("mention_id", "entity_id")


@query("a10_missing_link_queue", f"{_M} SELECT mention_id, canonical_name, confidence FROM m WHERE source_url IS NULL ORDER BY confidence DESC, mention_id LIMIT 100")
def a10(spark, sf_dir):
    return view(spark, sf_dir, MENTIONS).where("source_url is null").select("mention_id", "canonical_name", "confidence").orderBy(F.col("confidence").desc_nulls_last(), "mention_id").limit(100)


@query("a11_by_fact", f"{_M} SELECT entity_id, count(*) AS mentions, min(publish_date) AS first_seen, max(publish_date) AS last_seen FROM m WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50 OR mention_type = 'error' GROUP BY 1")
def a11(spark, sf_dir):
    m = view(spark, sf_dir, MENTIONS).withColumn("facts", F.from_json("props", "map<string,string>"))
    m = m.where((F.col("facts")["k"].try_cast("long") >= 50) | (F.col("mention_type") == "error"))
    return m.groupBy("entity_id").agg(F.count("*").alias("mentions"), F.min("publish_date").alias("first_seen"), F.max("publish_date").alias("last_seen"))


@query(
    "a12_mention_summary",
    f"""{_M} SELECT 'type' AS kind, mention_type AS key, count(*) AS n FROM m GROUP BY 2 UNION ALL SELECT 'name', concat(mention_type, '/', canonical_name), count(*) FROM m GROUP BY 2
    UNION ALL SELECT 'review', 'review', count(*) FILTER (needs_review) FROM m""",
)
def a12(spark, sf_dir):
    return R.mention_histograms(view(spark, sf_dir, MENTIONS))


@query(
    "a13_candidates",
    f"""{_M}, w AS (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY publish_date DESC NULLS LAST, mention_id) AS rn FROM m WHERE source_url IS NOT NULL)
    SELECT source_url, count(DISTINCT episode_id) AS cited_in, max(publish_date) AS last_cited, max(CASE WHEN rn = 1 THEN canonical_name END) AS newest, array_to_string(list_sort(list_distinct(list(CAST(show_id AS VARCHAR)))), ',') AS shows FROM w GROUP BY 1""",
)
def a13(spark, sf_dir):
    m = view(spark, sf_dir, MENTIONS).where("source_url is not null")
    shows = F.array_join(F.array_sort(F.collect_set(F.col("show_id").cast("string"))), ",")
    return m.groupBy("source_url").agg(F.countDistinct("episode_id").alias("cited_in"), F.max("publish_date").alias("last_cited"), R.newest(F.col("canonical_name"), F.col("publish_date"), F.col("mention_id")).alias("newest"), shows.alias("shows"))


@query(
    "a14_pulse",
    """SELECT c_custkey AS o_custkey, count(o_orderkey) AS items, max(CAST(o_orderdate AS DATE)) AS newest, count(*) FILTER (CAST(o_orderdate AS DATE) >= DATE '1998-08-02' - 15) AS recent,
    date_diff('day', max(CAST(o_orderdate AS DATE)), DATE '1998-08-02') AS days_since FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""",
)
def a14(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    return R.pulse(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey")), o, "o_custkey", "d", _DAY)


@query("a15_playlist_stats", "SELECT o_orderpriority, count(DISTINCT CASE WHEN o_totalprice > 100000 THEN o_custkey END) AS matched, count(*) AS scraped, max(CAST(o_orderdate AS DATE)) AS latest, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS latest_id FROM orders GROUP BY 1")
def a15(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupBy("o_orderpriority").agg(F.countDistinct(F.when(F.col("o_totalprice") > 100000, F.col("o_custkey"))).alias("matched"), F.count("*").alias("scraped"), F.max(F.to_date("o_orderdate")).alias("latest"), F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("latest_id"))


@query("a16_band_breakdown", "SELECT p_brand AS artist, CASE WHEN p_retailprice >= 1500 THEN 'HIGH' WHEN p_retailprice >= 1000 THEN 'MEDIUM' ELSE 'NOT_FOUND' END AS band, count(*) AS n, count(*) FILTER (p_name LIKE '%re%') AS featured FROM part GROUP BY ALL")
def a16(spark, sf_dir):
    band = F.when(F.col("p_retailprice") >= 1500, "HIGH").when(F.col("p_retailprice") >= 1000, "MEDIUM").otherwise("NOT_FOUND")
    return table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("artist"), band.alias("band")).agg(F.count("*").alias("n"), F.count_if(F.col("p_name").like("%re%")).alias("featured"))


@query("a17_songs_per_show", "SELECT c_nationkey, count(DISTINCT o_orderkey) AS songs, count(DISTINCT c_custkey) AS episodes, round(count(DISTINCT o_orderkey) / nullif(count(DISTINCT c_custkey), 0), 1) AS per_episode FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def a17(spark, sf_dir):
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    out = table(spark, sf_dir, "customer").join(per, "c_custkey", "left").groupBy("c_nationkey").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("songs"), F.count("*").alias("episodes"))
    return out.withColumn("per_episode", R.safe_ratio(F.col("songs"), F.col("episodes"), 1))


@query("a18_dashboard", "SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS d, count(l_orderkey) AS songs FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5) o LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL")
def a18(spark, sf_dir):
    five = table(spark, sf_dir, "orders").orderBy(F.col("o_orderdate").desc_nulls_last(), "o_orderkey").limit(5).select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey").join(F.broadcast(five.select(F.col("o_orderkey").alias("l_orderkey"))), "l_orderkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("songs"))
    return five.join(lines, "o_orderkey", "left").na.fill(0, ["songs"])


@query("a19_progress", "SELECT count(DISTINCT c_custkey) AS total, count(DISTINCT o_custkey) AS done, count(DISTINCT c_custkey) - count(DISTINCT o_custkey) AS remaining FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
def a19(spark, sf_dir):
    return R.progress(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("a20_dominant_model", f"{_M} SELECT mention_type, count(*) AS n FROM m GROUP BY 1 ORDER BY n DESC, mention_type LIMIT 1")
def a20(spark, sf_dir):
    return R.dominant(view(spark, sf_dir, MENTIONS), "mention_type")


@query("a21_newest_per_group", "SELECT o_custkey, o_orderkey, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def a21(spark, sf_dir):
    return R.newest_per_group(table(spark, sf_dir, "orders"), "o_custkey", 3, F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")).select("o_custkey", "o_orderkey", "rank")


@query("a22_batch_parse_stats", "SELECT count(*) AS total, count(*) FILTER (contains(html, '404')) AS not_found, count(*) FILTER (length(html) >= 2000) AS valid, CAST(sum(len(regexp_extract_all(html, '(?i)<p>'))) AS BIGINT) AS paragraphs FROM pages")
def a22(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.agg(F.count("*").alias("total"), F.count_if(F.col("html").contains("404")).alias("not_found"), F.count_if(F.length("html") >= 2000).alias("valid"), F.sum(F.regexp_count("html", F.lit("(?i)<p>"))).alias("paragraphs"))


@query("a23_failure_rate", f"{_M} SELECT show_id, count(*) AS n, count(*) FILTER (mention_type = 'error') AS failed, round(count(*) FILTER (mention_type = 'error') / count(*), 4) AS rate, count(*) FILTER (mention_type = 'error') > count(*) * 0.1 AS alert FROM m GROUP BY 1")
def a23(spark, sf_dir):
    return R.failure_rate(view(spark, sf_dir, MENTIONS), "show_id", F.col("mention_type") == "error")
