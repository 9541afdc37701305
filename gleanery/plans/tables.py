"""Joins, duplicates, checks, change sets and scores over the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..operators import changes as C
from ..operators import checks as Q
from ..operators import dedup as D
from ..operators import evaluation as E
from ..operators import joins as J
from .base import EPISODES, MENTIONS, SYNC, query, scratch, table, view
from .rows import _HOST, _KEY, CANONICAL

_M = f"WITH m AS ({MENTIONS})"
_E = f"WITH e AS ({EPISODES})"
_S = f"WITH s AS ({SYNC})"
_APRIL = dt.date(2024, 4, 30)

# ---------------------------------------------------------------- joins


@query("j01_inner_join", "SELECT l_orderkey, l_linenumber, c_name, o_orderpriority FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE l_quantity > 45")
def j01(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey"), "l_linenumber")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return li.join(o, "l_orderkey").join(c, "o_custkey").select("l_orderkey", "l_linenumber", "c_name", "o_orderpriority")


@query("j02_left_join_gaps", "SELECT count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS matched, count(*) FILTER (o_orderkey IS NULL) AS gaps FROM customer LEFT JOIN orders ON o_custkey = c_custkey")
def j02(spark, sf_dir):
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(per, "c_custkey", "left").agg(F.count("*").alias("customers"), F.coalesce(F.sum("n"), F.lit(0)).alias("matched"), F.count_if(F.col("n").isNull()).alias("gaps"))


@query("j03_anti_join", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j03(spark, sf_dir):
    """Customers without any order."""
    return J.without_match(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("j04_semi_join", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j04(spark, sf_dir):
    return J.with_match(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("j05_orphans", "SELECT l_orderkey, l_linenumber, l_partkey * 2 AS p_partkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey * 2)")
def j05(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") * 2).alias("p_partkey"))
    return J.orphans(li, table(spark, sf_dir, "part"), "p_partkey").select("l_orderkey", "l_linenumber", "p_partkey")


@query("j06_key_list", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)")
def j06(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(F.col("o_orderkey").isin(1, 2, 3, 5, 8, 13, 21, 34, 55, 89)).select("o_orderkey", "o_totalprice")


@query("j07_discover_new", f"SELECT DISTINCT {CANONICAL} AS url FROM pages WHERE {CANONICAL} NOT IN (SELECT {CANONICAL} FROM pages WHERE page_id % 2 = 0)")
def j07(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", U.canonical_url(F.col("url")).alias("url"))
    return J.to_add(p, p.where("page_id % 2 = 0"), "url")


@query("j08_number_gaps", "SELECT n AS o_orderkey FROM (SELECT unnest(range(1, (SELECT max(o_orderkey) FROM orders WHERE o_orderkey % 3 <> 0) + 1)) AS n) WHERE n NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)")
def j08(spark, sf_dir):
    return J.number_gaps(table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0"), "o_orderkey")


@query("j09_resolve_source", f"SELECT page_id, CASE regexp_extract({_HOST.format(u='url')}, '[^.]+$') WHEN 'com' THEN 'A' WHEN 'org' THEN 'B' ELSE 'other' END AS source FROM pages")
def j09(spark, sf_dir):
    known = spark.createDataFrame([("com", "A"), ("org", "B")], "domain string, source string")
    p = table(spark, sf_dir, "pages")
    return J.resolve_source(p, F.regexp_extract(U.host(F.col("url")), "[^.]+$", 0), known, "other").select("page_id", "source")


@query("j10_first_needle", "SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') THEN 'r' WHEN contains(lower(p_name), 'blue') THEN 'b' WHEN contains(lower(p_name), 'a') THEN 'a' END AS needle_value FROM part")
def j10(spark, sf_dir):
    return J.first_needle(table(spark, sf_dir, "part"), "p_name", [("red", "r"), ("blue", "b"), ("a", "a")]).select("p_partkey", "needle_value")


@query("j11_domain_or_type", f"SELECT page_id FROM pages WHERE regexp_extract({_HOST.format(u='url')}, '[^.]+$') IN ('org') OR page_id % 4 = 0")
def j11(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return J.by_domain_or_type(p, F.regexp_extract(U.host(F.col("url")), "[^.]+$", 0), ["org"], F.col("page_id") % 4, [0]).select("page_id")


@query("j14_tiered_match", """WITH s AS (SELECT p_partkey AS id, lower(CASE WHEN p_partkey % 3 = 0 THEN concat(p_name, ' live') ELSE p_name END) AS a, CASE WHEN p_partkey % 5 = 0 THEN 'x' ELSE p_brand END AS b FROM part), c AS (SELECT p_partkey AS catalog_id, lower(p_name) AS a, p_brand AS b FROM part),
    ta AS (SELECT a, min(catalog_id) AS k FROM c GROUP BY 1), tb AS (SELECT b, min(catalog_id) AS k FROM c GROUP BY 1)
    SELECT id, coalesce(ta.k, tb.k) AS catalog_id, CASE WHEN ta.k IS NOT NULL THEN 'HIGH' WHEN tb.k IS NOT NULL THEN 'LOW' ELSE 'NOT_FOUND' END AS band FROM s LEFT JOIN ta USING (a) LEFT JOIN tb USING (b)""")
def j14(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    songs = p.select(k.alias("id"), F.lower(F.concat("p_name", F.when(k % 3 == 0, " live").otherwise(""))).alias("a"), F.when(k % 5 == 0, "x").otherwise(F.col("p_brand")).alias("b"))
    return J.tiered_match(songs, p.select(k.alias("catalog_id"), F.lower("p_name").alias("a"), F.col("p_brand").alias("b")), [("HIGH", "a", ""), ("LOW", "b", "")])


@query("j14_containment_match", """WITH s AS (SELECT p_partkey AS id, lower(CASE WHEN p_partkey % 2 = 0 THEN concat(p_name, ' live') ELSE p_name END) AS t, lower(concat(p_type, ' ', CASE WHEN p_partkey % 4 = 0 THEN 'x' ELSE p_brand END)) AS a FROM part),
    c AS (SELECT p_partkey AS catalog_id, lower(p_name) AS ct, lower(concat(p_type, ' ', p_brand)) AS ca FROM part),
    sw AS (SELECT DISTINCT id, t, a, string_split(a, ' ')[1] AS aw, unnest(string_split(t, ' ')) AS w FROM s), cw AS (SELECT DISTINCT catalog_id, ct, ca, unnest(string_split(ct, ' ')) AS w FROM c),
    n AS (SELECT id, catalog_id, CASE WHEN contains(t, ct) OR contains(ct, t) THEN 0 ELSE 1 END AS tier FROM sw JOIN cw ON a = ca AND sw.w = cw.w UNION ALL SELECT id, catalog_id, 2 FROM sw JOIN cw ON sw.w = cw.w AND list_contains(string_split(ca, ' '), aw)),
    b AS (SELECT id, arg_min(catalog_id, (tier, catalog_id)) AS catalog_id, min(tier) AS tier FROM n GROUP BY 1)
    SELECT s.id, b.catalog_id, CASE WHEN tier = 0 THEN 'HIGH' WHEN tier = 1 THEN 'MEDIUM' WHEN tier = 2 THEN 'LOW' ELSE 'NOT_FOUND' END AS band FROM s LEFT JOIN b USING (id)""")
def j14c(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rows = p.select(k.alias("id"), F.concat("p_name", F.when(k % 2 == 0, " live").otherwise("")).alias("title"), F.concat_ws(" ", "p_type", F.when(k % 4 == 0, "x").otherwise(F.col("p_brand"))).alias("artist"))
    return J.containment_match(rows, p.select(k.alias("catalog_id"), F.col("p_name").alias("title"), F.concat_ws(" ", "p_type", "p_brand").alias("artist")))


@query("j21_provenance", "SELECT doc_id AS episode_id, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN doc_id * 10 END WHEN doc_id % 5 <> 0 THEN doc_id * 100 END AS transcript_id, doc_id % 3 <> 0 AND doc_id % 5 <> 0 AS inferred FROM documents")
def j21(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("episode_id"))
    k = F.col("episode_id")
    recorded = d.where(k % 3 == 0).withColumn("transcript_id", F.when(k % 2 == 0, k * 10))
    return J.provenance(d, recorded, d.where(k % 5 != 0).withColumn("transcript_id", k * 100))


@query("j22_to_add", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 30 EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1")
def j22(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return J.to_add(li.where("l_quantity > 30"), li.where("l_returnflag = 'R' and l_linenumber = 1"), "l_partkey")


@query("j23_adopt_or_create", "SELECT o_orderkey, m.r AS remote_id, CASE WHEN m.r IS NULL THEN 'create' ELSE 'adopt' END AS action FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS r FROM lineitem WHERE l_linenumber = 3 GROUP BY 1) m ON l_orderkey = o_orderkey")
def j23(spark, sf_dir):
    remote = table(spark, sf_dir, "lineitem").where("l_linenumber = 3").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("remote_id"))
    return J.adopt_or_create(table(spark, sf_dir, "orders").select("o_orderkey"), remote, "o_orderkey", "remote_id")


# ---------------------------------------------------------------- duplicates and entities


@query("d01_duplicate_groups", "SELECT source AS k1, lower(trim(split_part(text, chr(10), 1))) AS k2, count(*) AS n, min(doc_id) AS keep FROM documents GROUP BY ALL HAVING count(*) > 1")
def d01(spark, sf_dir):
    return D.duplicate_groups(table(spark, sf_dir, "documents"), "doc_id", F.col("source"), F.lower(F.trim(F.split_part("text", F.lit("\n"), F.lit(1)))))


@query(
    "d02_survivors",
    """WITH s AS (SELECT c_custkey, c_nationkey, c_mktsegment, (CASE WHEN c_acctbal > 5000 THEN 100 ELSE 0 END) + (CASE WHEN c_custkey % 2 = 0 THEN 30 ELSE 0 END) + (CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE 0 END) AS score FROM customer)
    SELECT c_custkey, first_value(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY score DESC, c_custkey) AS survivor FROM s""",
)
def d02(spark, sf_dir):
    k = F.col("c_custkey")
    score = D.survivor_score([(F.col("c_acctbal") > 5000, 100), (k % 2 == 0, 30), (k % 3 == 0, -1)])
    return D.choose_survivor(table(spark, sf_dir, "customer"), "c_custkey", score, "c_nationkey", "c_mktsegment")


@query(
    "d03_merge_donors",
    """WITH e AS (SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN split_part(text, chr(10), 1) END AS title, CASE WHEN doc_id % 7 = 0 THEN doc_id % 2 = 0 END AS flag, n_chars, min(doc_id) OVER (PARTITION BY source, lang) AS survivor FROM documents)
    SELECT survivor AS doc_id, arg_min(title, doc_id) FILTER (title IS NOT NULL) AS title, bool_or(flag) AS flag, max(n_chars) AS n_chars FROM e GROUP BY 1""",
)
def d03(spark, sf_dir):
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.when(k % 3 == 0, F.split_part("text", F.lit("\n"), F.lit(1))).alias("title"), F.when(k % 7 == 0, k % 2 == 0).alias("flag"), "n_chars")
    survivors = D.choose_survivor(d, "doc_id", F.lit(0), "source", "lang")
    return D.merge_donors(d, "doc_id", survivors, ["title"], ["flag"], ["n_chars"])


@query("d04_keep_lowest", "SELECT l_orderkey, l_suppkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1, 2")
def d04(spark, sf_dir):
    return D.keep_lowest(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber"), F.col("l_linenumber"), "l_orderkey", "l_suppkey")


_SPELL = "CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE replace(p_name, ' ', '-') END"


@query(
    "d05_entities",
    f"""WITH m AS (SELECT p_partkey AS pos, p_brand AS entity_type, {_SPELL} AS name FROM part), k AS (SELECT *, {_KEY.format(c='name')} AS key FROM m)
    SELECT entity_type, key AS normalized_name, '' AS platform, arg_min(name, pos) AS canonical_name, count(*) AS n, array_to_string(list_sort(list_filter(list_distinct(list(name)), lambda x: x <> arg_min(name, pos))), '|') AS aliases FROM k WHERE key <> '' GROUP BY 1, 2""".replace("list_filter(list_distinct(list(name)), lambda x: x <> arg_min(name, pos))", "list_filter(list_distinct(list(name)), lambda x: x <> first(c))").replace("k AS (SELECT *,", "k0 AS (SELECT *,").replace(" FROM m)\n", " FROM m), k AS (SELECT *, first_value(name) OVER (PARTITION BY entity_type, key ORDER BY pos) AS c FROM k0)\n"),
)
def d05(spark, sf_dir):
    spell = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit("-")))
    m = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.col("p_brand").alias("entity_type"), spell.alias("canonical_name"), spell.alias("mention_text"), F.lit(None).cast("string").alias("platform"))
    return D.build_entities(m).withColumn("aliases", F.array_join("aliases", "|"))


@query(
    "d06_merge_aliases",
    f"""WITH m AS (SELECT p_partkey AS pos, p_brand, {_SPELL} AS name FROM part), k AS (SELECT *, {_KEY.format(c='name')} AS key FROM m), f AS (SELECT p_brand, key, arg_min(name, pos) AS a, min(pos) AS p FROM k WHERE key <> '' GROUP BY 1, 2)
    SELECT p_brand, string_agg(a, '|' ORDER BY p) AS aliases FROM f GROUP BY 1""",
)
def d06(spark, sf_dir):
    spell = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit("-")))
    m = table(spark, sf_dir, "part").select("p_partkey", "p_brand", spell.alias("name"))
    return D.merge_aliases(m, "p_brand", F.col("p_partkey"), "name").withColumn("aliases", F.array_join("aliases", "|"))


@query("d07_exact_merges", f"SELECT p_partkey AS id, min(p_partkey) OVER (PARTITION BY {_KEY.format(c='p_name')}) AS winner FROM part")
def d07(spark, sf_dir):
    e = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lit("x").alias("entity_type"), T.entity_key(F.col("p_name")).alias("normalized_name"))
    return D.exact_merges(e)


@query("d08_curated_merges", "SELECT p_partkey AS id, CASE WHEN p_brand IN ('Brand#11', 'Brand#12', 'Brand#13') AND p_partkey = (SELECT min(p_partkey) FROM part q WHERE q.p_brand = part.p_brand) THEN (SELECT min(p_partkey) FROM part WHERE p_brand = 'Brand#13') ELSE p_partkey END AS winner FROM part")
def d08(spark, sf_dir):
    merges = spark.createDataFrame([("x", "Brand#12", "Brand#11"), ("x", "Brand#13", "Brand#12"), ("x", "none", "Brand#21")], "entity_type string, winner_name string, loser_name string")
    e = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lit("x").alias("entity_type"), F.col("p_brand").alias("normalized_name"))
    return D.curated_merges(e, merges)


@query("d09_alias_backfill", f"""{_M}, e AS (SELECT DISTINCT user_id AS id, concat('Name ', user_id % 60) AS canonical_name, CASE WHEN user_id % 2 = 0 THEN concat('name-', user_id % 60) END AS own FROM events),
    x AS (SELECT id, 0 AS g, own AS a FROM e WHERE own IS NOT NULL UNION SELECT entity_id, 1, concat(canonical_name, CASE WHEN mention_type = 'click' THEN '' ELSE concat('  (', mention_type, ')') END) FROM m UNION SELECT id, 2, canonical_name FROM e),
    k AS (SELECT id, g, a, trim(regexp_replace(lower(trim(a)), '[^a-z0-9]+', ' ', 'g')) AS k FROM x), f AS (SELECT id, k, arg_min(a, (g, a)) AS a, min(g) AS g FROM k WHERE k <> '' GROUP BY 1, 2)
    SELECT id, array_to_string(list(a ORDER BY g, a), '|') AS aliases FROM f GROUP BY id HAVING count(*) > count(*) FILTER (g = 0)""")
def d09(spark, sf_dir):
    m = view(spark, sf_dir, MENTIONS)
    own = F.when(F.col("id") % 2 == 0, F.array(F.concat(F.lit("name-"), F.col("id") % 60))).otherwise(F.array().cast("array<string>"))
    e = m.select(F.col("entity_id").alias("id"), "canonical_name").distinct().withColumn("aliases", own)
    said = m.select("entity_id", F.concat("canonical_name", F.when(F.col("mention_type") == "click", "").otherwise(F.concat(F.lit("  ("), "mention_type", F.lit(")")))).alias("mention_text"))
    return D.backfill_aliases(e, said).select("id", F.array_join("aliases", "|").alias("aliases"))


@query("d10_alias_splits", f"""WITH m AS (SELECT p_brand, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE replace(p_name, ' ', '') END AS name FROM part), k AS (SELECT p_brand, {_KEY.format(c='name')} AS key FROM m)
    SELECT p_brand, replace(key, ' ', '') AS compact, count(DISTINCT key) AS keys, array_to_string(list_sort(list_distinct(list(key))), '|') AS names FROM k WHERE key <> '' GROUP BY 1, 2 HAVING count(DISTINCT key) > 1""")
def d10(spark, sf_dir):
    name = F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit("")))
    return D.alias_splits(table(spark, sf_dir, "part").select("p_partkey", "p_brand", name.alias("name")), "name", "p_partkey", "p_brand")


@query("d11_collapse_urls", f"SELECT {CANONICAL} AS canonical, CAST(sum(page_id % 5) AS BIGINT) AS cited, arg_max(url, page_id) AS url FROM pages GROUP BY 1")
def d11(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", (F.col("page_id") % 5).alias("cited"), F.col("page_id").alias("at"))
    return D.collapse_urls(p, "url", "cited", "at", "page_id", ["url"])


@query("d12_upsert_oneoff", """WITH o AS (SELECT lower(trim(split_part(text, chr(10), 1))) AS key, max(doc_id % 3) AS q FROM documents WHERE doc_id % 2 = 0 GROUP BY 1), n AS (SELECT lower(trim(split_part(text, chr(10), 1))) AS key, max(doc_id % 4) AS q FROM documents WHERE doc_id % 2 = 1 GROUP BY 1)
    SELECT key, greatest(coalesce(o.q, -1), coalesce(n.q, -1)) AS quality, o.q IS NULL AS created, coalesce(o.q IS NOT NULL AND n.q > o.q, false) AS upgraded FROM o FULL JOIN n USING (key)""")
def d12(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"))
    k = F.col("doc_id")
    out = D.upsert_oneoff(d.where(k % 2 == 0).select("title", (k % 3).alias("quality")), d.where(k % 2 == 1).select("title", (k % 4).alias("quality")), "title", "quality")
    return out.select("key", "quality", "created", "upgraded")


@query("d13_export_ids", r"SELECT regexp_extract(url, '([0-9]+)', 1) AS export_id, min(page_id) AS page_id FROM pages WHERE regexp_extract(url, '([0-9]+)', 1) <> '' GROUP BY 1")
def d13(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "([0-9]+)", 1).alias("export_id")).where("export_id <> ''")
    return D.keep_lowest(p, F.col("page_id"), "export_id").select("export_id", "page_id")


# ---------------------------------------------------------------- checks


@query("q01_expected_against_table", "SELECT coalesce(n_nationkey, k) AS n_nationkey, CASE WHEN n_nationkey IS NULL THEN 'missing' WHEN k IS NULL THEN 'extra' ELSE 'mismatch' END AS state FROM nation FULL JOIN (SELECT n_nationkey + 2 AS k, n_regionkey AS r FROM nation) ON k = n_nationkey WHERE n_nationkey IS NULL OR k IS NULL OR r <> n_regionkey")
def q01(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return Q.expected_against_table(n.withColumn("n_nationkey", F.col("n_nationkey") + 2), n, "n_nationkey", "n_regionkey")


@query("q02_required_fields", f"{_E} SELECT show_slug, count(*) AS n, count(*) FILTER (title IS NULL OR trim(title) = '') AS no_title, count(*) FILTER (publish_date IS NULL) AS no_publish_date FROM e GROUP BY 1")
def q02(spark, sf_dir):
    return Q.null_counts(view(spark, sf_dir, EPISODES), "show_slug", ["title", "publish_date"])


@query(
    "q03_transcript_coverage",
    f"""{_E}, g AS (SELECT show_slug, count(*) AS items, count(transcript) AS covered, date_diff('day', max(publish_date) FILTER (transcript IS NOT NULL), max(publish_date)) AS lag FROM e GROUP BY 1)
    SELECT show_slug, items, covered, lag AS lag_days, CASE WHEN show_slug = 'src2' THEN 'skip' WHEN show_slug = 'src1' AND covered < items THEN 'fail' WHEN show_slug IN ('src3', 'src4') AND (lag IS NULL OR lag > 2) THEN 'warn' WHEN show_slug IN ('src3', 'src4') AND covered / items < 0.5 THEN 'warn' WHEN show_slug NOT IN ('src1','src3','src4') THEN 'skip' ELSE 'pass' END AS status FROM g""",
)
def q03(spark, sf_dir):
    p = spark.createDataFrame([("src1", "complete", 0, 0.0), ("src2", "none", 0, 0.0), ("src3", "latest", 2, 0.5), ("src4", "latest", 2, 0.5)], "show_slug string, mode string, max_lag_days int, min_coverage double")
    e = view(spark, sf_dir, EPISODES)
    return Q.coverage(e.select("show_slug").distinct(), e, "show_slug", F.col("transcript").isNotNull(), "publish_date", p)


@query("q04_freshness", f"{_E} SELECT show_slug, date_diff('day', max(publish_date), DATE '2024-05-12') AS age_days, CASE WHEN show_slug = 'src1' THEN 'skip' WHEN date_diff('day', max(publish_date), DATE '2024-05-12') > (CASE WHEN show_slug = 'src2' THEN 30 ELSE 14 END) THEN 'fail' ELSE 'pass' END AS status FROM e GROUP BY 1")
def q04(spark, sf_dir):
    limits = spark.createDataFrame([("src1", None, True), ("src2", 30, False)], "show_slug string, days int, skip boolean")
    return Q.freshness(view(spark, sf_dir, EPISODES), "show_slug", "publish_date", dt.date(2024, 5, 12), limits)


@query("q05_sync_drift", f"{_S} SELECT grp, count(*) FILTER (synced_on IS NULL AND date_diff('day', updated_on, DATE '1998-08-10') > 30) AS waiting, count(*) FILTER (updated_on > synced_on) AS stale, CASE WHEN count(*) FILTER (synced_on IS NULL AND date_diff('day', updated_on, DATE '1998-08-10') > 30) > 0 OR count(*) FILTER (updated_on > synced_on) > 0 THEN 'fail' ELSE 'pass' END AS status FROM s GROUP BY 1")
def q05(spark, sf_dir):
    return Q.sync_drift(view(spark, sf_dir, SYNC), "grp", dt.date(1998, 8, 10), 30)


@query("q06_second_source_lag", f"""{_E}, o AS (SELECT show_slug, max(publish_date) AS newest FROM e WHERE id % 4 <> 0 GROUP BY 1), s AS (SELECT show_slug, publish_date + 3 AS d FROM e WHERE show_slug <> 'src5' AND publish_date + 3 <= DATE '2024-04-30'),
    c AS (SELECT show_slug, count(*) FILTER (newest IS NULL OR d > newest) AS behind FROM s JOIN o USING (show_slug) GROUP BY 1) SELECT show_slug, coalesce(behind, 0) AS behind, CASE WHEN behind IS NULL THEN 'unverified' WHEN behind > 0 THEN 'behind' ELSE 'ok' END AS status FROM o LEFT JOIN c USING (show_slug)""")
def q06(spark, sf_dir):
    e = view(spark, sf_dir, EPISODES)
    return Q.second_source_lag(e.where("id % 4 <> 0"), e.where("show_slug <> 'src5'").select("show_slug", F.date_add("publish_date", 3).alias("publish_date")), "show_slug", "publish_date", _APRIL)


@query("q07_extraction_integrity", "SELECT 'without_lines' AS finding, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10) UNION ALL SELECT 'orphan_lines', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def q07(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "k"), table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "k")
    one = J.without_match(o, li.where("l_quantity > 10"), "k").agg(F.count("*").alias("n")).select(F.lit("without_lines").alias("finding"), "n")
    return one.unionByName(J.orphans(li, o.where("o_orderstatus = 'F'"), "k").agg(F.count("*").alias("n")).select(F.lit("orphan_lines").alias("finding"), "n"))


@query("q08_late_sources", f"{_E} SELECT id, date_diff('day', publish_date, DATE '2024-04-30') AS days, CASE WHEN date_diff('day', publish_date, DATE '2024-04-30') > 3 THEN 'fail' ELSE 'warn' END AS status FROM e WHERE id % 3 = 0 AND publish_date IS NOT NULL")
def q08(spark, sf_dir):
    return Q.late_source_queue(view(spark, sf_dir, EPISODES), "id", F.col("id") % 3 == 0, "publish_date", _APRIL)


_RULES = f"{_M} SELECT 'blank_name' AS rule, count(*) FILTER (trim(canonical_name) = '') AS n FROM m UNION ALL SELECT 'confidence', count(*) FILTER (confidence < 0.1 OR confidence > 0.9) FROM m UNION ALL SELECT 'no_link', count(*) FILTER (source_url IS NULL) FROM m"


def _rules():
    return {"blank_name": F.trim("canonical_name") == "", "confidence": (F.col("confidence") < 0.1) | (F.col("confidence") > 0.9), "no_link": F.col("source_url").isNull()}


@query("q09_field_rules", _RULES)
def q09(spark, sf_dir):
    return Q.field_rules(view(spark, sf_dir, MENTIONS), _rules())


@query("q09_rules_on_load", _RULES)
def q09w(spark, sf_dir):
    """The same rules, counted while the mentions are written."""
    return Q.rules_on_write(view(spark, sf_dir, MENTIONS), scratch(spark, "q09"), _rules())


@query("q10_alias_split_check", f"""WITH k AS (SELECT p_brand, {_KEY.format(c="CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE replace(p_name, ' ', '') END")} AS key FROM part), f AS (SELECT p_brand, replace(key, ' ', '') AS c FROM k WHERE key <> '' GROUP BY 1, 2 HAVING count(DISTINCT key) > 1)
    SELECT 'alias_splits' AS name, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END AS status, concat(count(*), ' findings') AS summary FROM f""")
def q10(spark, sf_dir):
    return Q.as_check(d10(spark, sf_dir), "alias_splits", F.col("names"), "warn").select("name", "status", "summary")


@query("q11_null_map", "SELECT source, count(*) AS n, count(*) FILTER (CASE WHEN doc_id % 4 = 0 THEN NULL ELSE lang END IS NULL) AS no_lang, count(*) FILTER (doc_id % 6 = 0) AS no_text FROM documents GROUP BY 1")
def q11(spark, sf_dir):
    k = F.col("doc_id")
    return Q.null_counts(table(spark, sf_dir, "documents").select("source", F.when(k % 4 != 0, F.col("lang")).alias("lang"), F.when(k % 6 != 0, F.lit("x")).otherwise(" ").alias("text")), "source", ["lang", "text"])


@query("q12_batch_gate", f"""{_M}, b AS (SELECT run_id AS batch, count(DISTINCT episode_id % 10) AS episodes, count(*) AS mentions, count(*) FILTER (needs_review) AS review, count(*) FILTER (mention_type IN ('click', 'view')) AS core FROM m GROUP BY 1)
    SELECT batch, CASE WHEN mentions = 0 THEN 'no_mentions' WHEN review / mentions > 0.4 THEN 'review_rate' WHEN mentions / episodes < 5 THEN 'too_few' WHEN mentions / episodes > 30 THEN 'too_many' WHEN core / episodes < 3 THEN 'few_core' END AS reason FROM b""")
def q12(spark, sf_dir):
    b = view(spark, sf_dir, MENTIONS).groupBy(F.col("run_id").alias("batch")).agg(F.countDistinct(F.col("episode_id") % 10).alias("episodes"), F.count("*").alias("mentions"), F.count_if("needs_review").alias("review"), F.count_if(F.col("mention_type").isin("click", "view")).alias("core"))
    return Q.batch_gate(b)


@query("q13_repair_flags", "WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 2 = 0 END AS flag, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 40) AS has FROM orders) SELECT o_orderkey, flag AS old, has AS new FROM o WHERE flag <> has")
def q13(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 3 != 0, k % 2 == 0).alias("flag"))
    return Q.repair_flags(o, table(spark, sf_dir, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "flag")


@query("q14_enum_conformance", "SELECT l_shipdate IS NOT NULL AS dated, l_returnflag AS value, count(*) AS n FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY ALL")
def q14(spark, sf_dir):
    return Q.not_in_enum(table(spark, sf_dir, "lineitem"), "l_returnflag", ["A", "N"]).select(F.lit(True).alias("dated"), "value", "n")


@query("q15_digest", f"{_E}, f AS (SELECT show_slug, CASE WHEN date_diff('day', max(publish_date), DATE '2024-05-12') > 14 THEN 'fail' ELSE 'pass' END AS status FROM e GROUP BY 1) SELECT count(*) FILTER (status = 'pass') AS pass, CAST(0 AS BIGINT) AS warn, count(*) FILTER (status = 'fail') AS fail, CAST(0 AS BIGINT) AS unverified, CAST(0 AS BIGINT) AS behind, count(*) FILTER (status = 'fail') AS issues, count(*) FILTER (status = 'fail') = 0 AS green FROM f")
def q15(spark, sf_dir):
    return Q.roll_up(Q.freshness(view(spark, sf_dir, EPISODES), "show_slug", "publish_date", dt.date(2024, 5, 12)))


# ---------------------------------------------------------------- change sets


@query("c01_change_set", f"{_S} SELECT id, CASE WHEN page_id IS NULL THEN 'create' WHEN synced_on IS NULL OR updated_on > synced_on OR last_on > synced_on THEN 'update' ELSE 'unchanged' END AS change FROM s")
def c01(spark, sf_dir):
    return view(spark, sf_dir, SYNC).select("id", C.change_of().alias("change"))


@query("c02_unsynced", f"{_E} SELECT id, CASE WHEN trim(coalesce(transcript, '')) = '' THEN 'blank' ELSE 'sync' END AS action FROM e WHERE id % 2 = 0 ORDER BY publish_date DESC NULLS LAST, id LIMIT 50")
def c02(spark, sf_dir):
    return C.unsynced(view(spark, sf_dir, EPISODES), "transcript", "publish_date", "id", F.col("id") % 2 == 1, 50).select("id", "action")


@query("c03_eligible", f"""{_E}, r AS (SELECT id, CASE WHEN transcript IS NOT NULL THEN 'transcript' WHEN notes IS NOT NULL AND (show_slug = 'src1' OR date_diff('day', publish_date, DATE '2024-04-30') > 7) THEN 'show_notes' END AS read, date_diff('day', publish_date, DATE '2024-04-30') AS age FROM e)
    SELECT id, read FROM r WHERE read IS NOT NULL AND age <= 90 AND id % 3 <> 0""")
def c03(spark, sf_dir):
    e = view(spark, sf_dir, EPISODES)
    return C.eligible(e, e.where("id % 3 = 0"), "id", _APRIL, notes_only=F.col("show_slug") == "src1").select("id", "read")


@query("c04_damaged_batches", f"{_M} SELECT run_id, array_to_string(list_sort(list_distinct(list(CAST(episode_id AS VARCHAR)))), ',') AS items, count(DISTINCT episode_id) AS n FROM m WHERE run_id IN (SELECT run_id FROM m WHERE confidence >= 1 AND mention_type = 'error') GROUP BY 1")
def c04(spark, sf_dir):
    return C.damaged_batches(view(spark, sf_dir, MENTIONS), "run_id", "episode_id", (F.col("confidence") >= 1) & (F.col("mention_type") == "error"))


@query("c05_within_budget", "WITH g AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1), t AS (SELECT o_custkey, n, CAST(sum(n) OVER (ORDER BY o_custkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total, row_number() OVER (ORDER BY o_custkey) AS r FROM g) SELECT o_custkey, n, total FROM t WHERE r = 1 OR total <= 500")
def c05(spark, sf_dir):
    return C.within_budget(table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")), "o_custkey", "n", 500)


@query("c06_capped_intake", f"WITH n AS (SELECT page_id FROM pages WHERE page_id % 2 = 1) SELECT (SELECT count(*) FROM (SELECT * FROM n LIMIT 25)) AS taken, (SELECT greatest(count(*) - 25, 0) FROM n) AS dropped, (SELECT max(page_id) FROM (SELECT * FROM n ORDER BY page_id LIMIT 25)) AS last")
def c06(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    took, left = C.capped_intake(p, p.where("page_id % 2 = 0"), "page_id", 25, F.col("page_id"))
    return took.agg(F.count("*").alias("taken"), F.max("page_id").alias("last")).crossJoin(left)


@query("c07_still_damaged", f"{_M}, a AS (SELECT DISTINCT run_id FROM m WHERE confidence >= 1), b AS (SELECT DISTINCT run_id FROM m WHERE mention_type = 'error' AND episode_id % 5 = 0) SELECT run_id FROM a WHERE run_id IN (SELECT run_id FROM b)")
def c07(spark, sf_dir):
    m = view(spark, sf_dir, MENTIONS)
    first = C.damaged_batches(m, "run_id", "episode_id", F.col("confidence") >= 1)
    return J.with_match(first.select("run_id"), C.damaged_batches(m, "run_id", "episode_id", (F.col("mention_type") == "error") & (F.col("episode_id") % 5 == 0)), "run_id")


@query("c08_import_accounting", "SELECT source, count(*) FILTER (n_chars < 200) AS short, count(*) FILTER (n_chars >= 200 AND doc_id % 10 = 0) AS failed, count(*) FILTER (n_chars >= 200 AND doc_id % 10 <> 0) AS imported FROM documents GROUP BY 1")
def c08(spark, sf_dir):
    outcome = F.when(F.col("n_chars") < 200, "short").when(F.col("doc_id") % 10 == 0, "failed").otherwise("imported")
    return C.import_accounting(table(spark, sf_dir, "documents"), "source", outcome, ["short", "failed", "imported"])


@query("c09_pending_work", f"{_S} SELECT id FROM s WHERE page_id IS NULL AND synced_on IS NULL ORDER BY id LIMIT 200")
def c09(spark, sf_dir):
    return view(spark, sf_dir, SYNC).where("page_id is null and synced_on is null").select("id").orderBy("id").limit(200)


@query("c10_repair_candidates", f"{_E}, g AS (SELECT show_slug, lower(trim(title)) AS t FROM e WHERE title IS NOT NULL GROUP BY ALL HAVING count(*) > 1) SELECT e.id FROM e LEFT JOIN g ON g.show_slug = e.show_slug AND g.t = lower(trim(e.title)) WHERE e.title IS NULL OR e.publish_date IS NULL OR g.t IS NOT NULL")
def c10(spark, sf_dir):
    e = view(spark, sf_dir, EPISODES).withColumn("k2", F.lower(F.trim("title")))
    groups = D.duplicate_groups(e, "id", F.col("show_slug"), F.col("k2")).select(F.col("k1").alias("show_slug"), "k2", F.lit(True).alias("dup"))
    return e.join(groups, ["show_slug", "k2"], "left").where("title is null or publish_date is null or dup").select("id")


@query("c11_approved_queue", f"{_S} SELECT id, CASE WHEN amount > 100000 THEN 'pulled' ELSE 'failed' END AS outcome FROM s WHERE grp = '1-URGENT' AND page_id IS NOT NULL")
def c11(spark, sf_dir):
    return view(spark, sf_dir, SYNC).where("grp = '1-URGENT' and page_id is not null").select("id", F.when(F.col("amount") > 100000, "pulled").otherwise("failed").alias("outcome"))


@query("c12_link_hunt", f"{_M} SELECT mention_id FROM m WHERE coalesce(trim(source_url), '') = '' AND mention_type IN ('click', 'view') AND run_id IN (1, 2, 3) ORDER BY mention_id LIMIT 500")
def c12(spark, sf_dir):
    m = view(spark, sf_dir, MENTIONS).where(F.coalesce(F.trim("source_url"), F.lit("")) == "").where(F.col("mention_type").isin("click", "view") & F.col("run_id").isin(1, 2, 3))
    return m.select("mention_id").orderBy("mention_id").limit(500)


@query("k07_batch_ids", "SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) / 100) AS BIGINT) AS batch, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) % 100 AS pos FROM orders")
def k07(spark, sf_dir):
    return C.batch_ids(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), 100, F.col("o_orderdate"), F.col("o_orderkey")).select("o_orderkey", "batch", "pos")


# ---------------------------------------------------------------- scores

_GOLD = "g AS (SELECT doc_id % 50 AS episode_id, CAST(doc_id AS VARCHAR) AS key, CASE WHEN toxic = 1 THEN 'b' ELSE 'a' END AS kind, 0.5 + (doc_id % 50) / 100.0 AS conf FROM labels WHERE quality = 1), p AS (SELECT doc_id % 50 AS episode_id, CAST(doc_id AS VARCHAR) AS key, CASE WHEN doc_id % 9 = 0 THEN 'b' ELSE 'a' END AS kind, 0.5 + (doc_id % 40) / 100.0 AS conf FROM labels WHERE doc_id % 4 <> 0)"


def _gold(spark, sf_dir):
    k = F.col("doc_id")
    x = table(spark, sf_dir, "labels")
    base = [(k % 50).alias("episode_id"), k.cast("string").alias("key")]
    g = x.where("quality = 1").select(*base, F.when(F.col("toxic") == 1, "b").otherwise("a").alias("kind"), (0.5 + (k % 50) / 100.0).alias("conf"))
    p = x.where(k % 4 != 0).select(*base, F.when(k % 9 == 0, "b").otherwise("a").alias("kind"), (0.5 + (k % 40) / 100.0).alias("conf"))
    return g, p


@query("e01_collapse_mentions", f"""{_M}, k AS (SELECT episode_id, {_KEY.format(c='canonical_name')} AS key, mention_type, confidence, mention_id FROM m), f AS (SELECT *, count(*) OVER (PARTITION BY episode_id, key, mention_type) AS freq FROM k WHERE key <> '')
    SELECT episode_id, key, arg_max(mention_type, (confidence, freq, -mention_id)) AS entity_type, max(confidence) AS confidence, count(*) AS n FROM f GROUP BY 1, 2""")
def e01(spark, sf_dir):
    m = view(spark, sf_dir, MENTIONS).select("episode_id", F.col("mention_id").alias("pos"), "canonical_name", F.col("mention_type").alias("entity_type"), F.col("confidence").cast("double").alias("confidence"))
    return E.collapse_mentions(m)


@query("e02_precision_recall", f"""WITH {_GOLD}, x AS (SELECT coalesce(g.episode_id, p.episode_id) AS episode_id, g.key AS gk, p.key AS pk, g.kind AS gt, p.kind AS pt FROM g FULL JOIN p ON g.episode_id = p.episode_id AND g.key = p.key),
    n AS (SELECT episode_id, count(pk) AS predicted, count(gk) AS truth, count(*) FILTER (pk IS NOT NULL AND gk IS NOT NULL) AS hits, count(*) FILTER (pt = gt) AS typed FROM x GROUP BY 1),
    r AS (SELECT *, CASE WHEN predicted = 0 THEN 1.0 ELSE CAST(hits AS DOUBLE) / predicted END AS p, CASE WHEN truth = 0 THEN 1.0 ELSE CAST(hits AS DOUBLE) / truth END AS r FROM n)
    SELECT episode_id, predicted, truth, hits, round_even(p, 4) AS precision, round_even(r, 4) AS recall, round_even(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END, 4) AS f1, round_even(CASE WHEN hits = 0 THEN 1.0 ELSE CAST(typed AS DOUBLE) / hits END, 4) AS type_accuracy FROM r""")
def e02(spark, sf_dir):
    g, p = _gold(spark, sf_dir)
    return E.precision_recall(p, g, "episode_id", "key", "kind")


@query("e03_drift", f"""WITH {_GOLD}, x AS (SELECT coalesce(g.episode_id, p.episode_id) AS episode_id, g.key AS gk, p.key AS pk, g.kind AS gt, p.kind AS pt, CAST(g.conf AS DOUBLE) AS gc, CAST(p.conf AS DOUBLE) AS pc FROM g FULL JOIN p ON g.episode_id = p.episode_id AND g.key = p.key)
    SELECT episode_id, round_even(CAST(count(*) FILTER (gk IS NOT NULL AND pk IS NOT NULL) AS DOUBLE) / count(*), 4) AS jaccard, count(*) FILTER (gk IS NOT NULL AND pk IS NOT NULL) AS retained, count(*) FILTER (pk IS NULL) AS dropped, count(*) FILTER (gk IS NULL) AS added,
    count(*) FILTER (gt <> pt) AS type_changes, round_even(avg(abs(pc - gc)), 4) AS confidence_delta, round_even(CAST(count(*) FILTER (gc >= 0.9 AND pk IS NOT NULL) AS DOUBLE) / nullif(count(*) FILTER (gc >= 0.9), 0), 4) AS core_recall FROM x GROUP BY 1""")
def e03(spark, sf_dir):
    g, p = _gold(spark, sf_dir)
    return E.drift(p, g, "episode_id", "key", "kind", "conf")


@query("e04_confidence_contract", "WITH c AS (SELECT CASE WHEN event_id % 7 <> 0 THEN value / 100 - 0.02 END AS c FROM events) SELECT count(*) AS n, count(*) FILTER (c IS NULL) AS missing, count(*) FILTER (c < 0 OR c > 1) AS out_of_range, min(c) AS lo, max(c) AS hi, count(DISTINCT round_even(c, 2)) AS distinct_2dp FROM c")
def e04(spark, sf_dir):
    return E.confidence_contract(table(spark, sf_dir, "events"), F.when(F.col("event_id") % 7 != 0, F.col("value") / 100 - 0.02))


@query("e05_macro_average", "SELECT round_even(avg(CAST(quality AS DOUBLE)), 4) AS quality, round_even(avg(CASE WHEN doc_id % 3 = 0 THEN CAST(toxic AS DOUBLE) END), 4) AS toxic FROM labels")
def e05(spark, sf_dir):
    x = table(spark, sf_dir, "labels").select("quality", F.when(F.col("doc_id") % 3 == 0, F.col("toxic")).alias("toxic"))
    return E.macro_average(x, ["quality", "toxic"])


@query("e06_distribution_shift", f"{_M}, a AS (SELECT mention_type, count(*) / sum(count(*)) OVER () AS now FROM m WHERE run_id % 2 = 0 GROUP BY 1), b AS (SELECT mention_type, count(*) / sum(count(*)) OVER () AS baseline FROM m WHERE run_id % 2 = 1 GROUP BY 1) SELECT mention_type, coalesce(now, 0) AS now, coalesce(baseline, 0) AS baseline, round_even(coalesce(now, 0) - coalesce(baseline, 0), 4) AS delta FROM a FULL JOIN b USING (mention_type)")
def e06(spark, sf_dir):
    m = view(spark, sf_dir, MENTIONS)
    return E.distribution_shift(m.where("run_id % 2 = 0"), m.where("run_id % 2 = 1"), "mention_type")


@query("e07_report_floors", f"""WITH {_GOLD}, x AS (SELECT coalesce(g.episode_id, p.episode_id) AS episode_id, g.key AS gk, p.key AS pk, g.kind AS gt, p.kind AS pt FROM g FULL JOIN p ON g.episode_id = p.episode_id AND g.key = p.key),
    n AS (SELECT episode_id, count(pk) AS predicted, count(gk) AS truth, count(*) FILTER (pk IS NOT NULL AND gk IS NOT NULL) AS hits, count(*) FILTER (pt = gt) AS typed FROM x GROUP BY 1),
    r AS (SELECT CAST(sum(predicted) AS DOUBLE) / sum(truth) AS y, avg(round_even(CASE WHEN truth = 0 THEN 1.0 ELSE CAST(hits AS DOUBLE) / truth END, 4)) AS gr, avg(round_even(CASE WHEN hits = 0 THEN 1.0 ELSE CAST(typed AS DOUBLE) / hits END, 4)) AS ta FROM n),
    a AS (SELECT kind, count(*) / sum(count(*)) OVER () AS s FROM p GROUP BY 1), b AS (SELECT kind, count(*) / sum(count(*)) OVER () AS s FROM g GROUP BY 1), d AS (SELECT max(abs(round_even(coalesce(a.s, 0) - coalesce(b.s, 0), 4))) AS m FROM a FULL JOIN b USING (kind)),
    c AS (SELECT count(*) FILTER (conf < 0 OR conf > 1) AS o FROM p)
    SELECT round(y, 6) AS yield_ratio, round(gr, 6) AS gold_recall, round(ta, 6) AS type_accuracy, m AS max_shift, o AS out_of_range, array_to_string(list_filter([CASE WHEN NOT y BETWEEN 0.55 AND 1.70 THEN 'yield' END, CASE WHEN m > 0.20 THEN 'shift' END, CASE WHEN gr < 0.60 THEN 'gold_recall' END, CASE WHEN ta < 0.80 THEN 'type_accuracy' END, CASE WHEN o > 0 THEN 'confidence' END], lambda v: v IS NOT NULL), ',') AS breaches
    FROM r, d, c""")
def e07(spark, sf_dir):
    g, p = _gold(spark, sf_dir)
    pr = E.precision_recall(p, g, "episode_id", "key", "kind")
    shift = E.distribution_shift(p, g, "kind").agg(F.max(F.abs("delta")).alias("max_shift"))
    report = pr.agg((F.sum("predicted") / F.sum("truth")).alias("yield_ratio"), F.avg("recall").alias("gold_recall"), F.avg("type_accuracy").alias("type_accuracy"), F.lit(0).alias("failures")).crossJoin(shift)
    contract = E.confidence_contract(p, F.col("conf")).select("out_of_range")
    out = E.breaches(report.crossJoin(contract))
    return out.select(*(F.round(c, 6).alias(c) for c in ("yield_ratio", "gold_recall", "type_accuracy")), "max_shift", "out_of_range", F.array_join("breaches", ",").alias("breaches"))
