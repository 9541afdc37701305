"""Landed files and model answers: the test tables are written in the files' formats and read through the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import mentions as M
from ..sources import readers as R
from ..sources.landing import land_files, landed
from .base import MENTIONS, query, table, view
from .base import scratch


#: Files that one task writes where each row is a file.
FILES_PER_TASK = 200


def _landed(lines: DataFrame, name: str, one_each: bool = False) -> str:
    """Folder with the one text column of ``lines``, a line for each row, or a file for each.

    Files for each row are dealt over as many tasks as they need, so no task writes them all.
    """
    path = scratch(lines.sparkSession, name)
    if not one_each:
        lines.write.text(path)
        return path
    tasks = -(-lines.count() // FILES_PER_TASK) or 1
    lines.repartition(tasks).write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("s01_feed", """SELECT concat('Show: ', source, ' #', doc_id) AS title, CASE WHEN doc_id % 3 = 0 THEN concat('https://l.example/', doc_id) WHEN doc_id % 3 = 1 THEN concat('guid-', doc_id) ELSE concat('https://a.example/', doc_id, '.mp3') END AS url,
    CASE WHEN doc_id % 3 = 2 THEN concat('https://a.example/', doc_id, '.mp3') END AS audio_url, DATE '2024-01-01' + CAST(doc_id % 300 AS INTEGER) + 1 AS publish_date, CAST(doc_id AS INTEGER) AS episode_number, concat(n_chars, ' & more in ', lang) AS description_body FROM documents WHERE doc_id % 10 <> 0""")
def s01(spark, sf_dir):
    k = F.col("doc_id")
    source = F.when(k % 3 == 0, F.concat(F.lit("<link>https://l.example/"), k, F.lit("</link>"))).when(k % 3 == 1, F.concat(F.lit('<guid isPermaLink="false"> guid-'), k, F.lit("</guid><link>https://other.example</link>"))).otherwise(F.concat(F.lit('<enclosure url="https://a.example/'), k, F.lit('.mp3"/><link>https://other.example</link>')))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int")), "dd MMM yyyy")
    item = F.concat(F.lit("<item><title>"), F.when(k % 10 == 0, "Other: ").otherwise("Show: "), "source", F.lit(" #"), k, F.lit("</title>"), source, F.lit("<pubDate>Mon, "), day, F.lit(" 23:30:00 -0400</pubDate><description>&lt;p&gt;"), "n_chars", F.lit(" &amp;amp; more&lt;/p&gt;&lt;p&gt;in "), "lang", F.lit("&lt;/p&gt;</description></item>"))
    feeds = table(spark, sf_dir, "documents").groupBy(F.floor(k / 100)).agg(F.array_join(F.collect_list(item), "").alias("items"))
    feeds = feeds.select(F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>")).alias("value"))
    return R.read_feed(spark, _landed(feeds, "s01", one_each=True), "show", "Show")


@query("s04_markdown", "SELECT s_name AS title, DATE '2024-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS publish_date, length(s_name) * 60 > 0 AS has_text FROM supplier WHERE s_suppkey % 4 <> 0")
def s04(spark, sf_dir):
    k = F.col("s_suppkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int")).cast("string")
    body = F.repeat(F.concat("s_name", F.lit(" text\n")), F.when(k % 4 == 0, 2).otherwise(60))
    docs = table(spark, sf_dir, "supplier").select(F.concat(F.lit("---\ndate: "), day, F.lit("\n---\n# "), "s_name", F.lit("\n"), body).alias("value"))
    found = R.read_markdown(spark, _landed(docs, "s04", one_each=True), names="*.txt")
    return found.select("title", "publish_date", F.col("text").contains(F.col("title")).alias("has_text"))


@query("s04_incremental_landing", "SELECT CAST(doc_id % 20 AS INTEGER) AS f, CAST(sum(1 + length(CASE WHEN doc_id % 20 < 5 THEN concat(doc_id, ' changed') ELSE concat(doc_id, ' ', lang) END)) AS BIGINT) AS n FROM documents WHERE doc_id % 20 <> 9 GROUP BY 1")
def s04i(spark, sf_dir):
    """Files land, some are replaced and one becomes empty; the second run brings the table up to date."""
    k, root = F.col("doc_id"), scratch(spark, "s04-landing")
    d = table(spark, sf_dir, "documents").withColumn("f", (k % 20).cast("int"))
    d.select("f", F.concat(k, F.lit(" "), "lang").alias("value")).repartition("f").write.partitionBy("f").text(f"{root}/files")
    land_files(spark, f"{root}/files", f"{root}/table", "*.txt")
    d.where("f < 5").select("f", F.concat(k, F.lit(" changed")).alias("value")).repartition("f").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("f").text(f"{root}/files")
    d.limit(0).select(F.lit("").alias("value")).write.mode("overwrite").text(f"{root}/files/f=9")
    land_files(spark, f"{root}/files", f"{root}/table", "*.txt")
    rows = landed(spark, f"{root}/table").where("length > 0")
    return rows.groupBy(F.regexp_extract("path", "/f=([0-9]+)/", 1).cast("int").alias("f")).agg(F.sum(F.length("content")).alias("n"))


@query("s05_page_cache", "SELECT page_id AS db_id, url, page_id % 6 <> 0 AS success, length(html) AS n, CASE WHEN page_id % 6 <> 0 THEN substring(url, 1, 12) END AS site FROM pages")
def s05(spark, sf_dir):
    k = F.col("page_id")
    meta = F.when(k % 6 != 0, F.create_map(F.lit("site"), F.substring("url", 1, 12)))
    page = F.struct(k.alias("db_id"), "url", (k % 6 != 0).alias("success"), F.col("html").alias("markdown"), meta.alias("metadata"), F.lit("2024-01-01T00:00:00").alias("fetched_at"))
    batches = table(spark, sf_dir, "pages").groupBy(F.floor(k / 40)).agg(F.collect_list(page).alias("p")).select(F.to_json("p").alias("value"))
    got = R.read_pages(spark, _landed(batches, "s05", one_each=True))
    return got.select("db_id", "url", "success", F.length("markdown").cast("long").alias("n"), F.col("metadata")["site"].alias("site"))


@query("s06_mention_batch", f"""WITH m AS ({MENTIONS}) SELECT mention_id, concat('two', chr(10), 'lines, "', canonical_name, '"') AS mention_text, mention_id % 3 = 0 AS is_editorial, needs_review,
    CASE WHEN mention_id % 10 = 0 THEN NULL ELSE round(confidence, 4) END AS confidence, CASE WHEN mention_id % 4 = 0 THEN 0 ELSE 1 END AS n_facts, CASE WHEN mention_id % 4 <> 0 THEN mention_type END AS domain FROM m""")
def s06(spark, sf_dir):
    k = F.col("mention_id")
    m = view(spark, sf_dir, MENTIONS)
    conf = F.when(k % 10 == 0, "none").otherwise(F.format_string("%.4f", F.round("confidence", 4)))
    facts = F.when(k % 4 == 0, "not json").otherwise(F.to_json(F.array(F.struct(F.lit("domain").alias("fact_key"), F.col("mention_type").alias("fact_value")))))
    text = F.concat(F.lit('two\nlines, "'), "canonical_name", F.lit('"'))
    given = {"episode_id": "episode_id", "entity_type": "mention_type", "canonical_name": "canonical_name", "mention_text": text, "is_editorial": (k % 3 == 0).cast("string"), "confidence": conf, "needs_review": F.col("needs_review").cast("string"), "context_snippet": k.cast("string"), "facts_json": facts}
    names = [c.split()[0] for c in R.MENTION.split(", ")]
    path = scratch(spark, "s06")
    rows = m.select(*((F.col(given[n]) if isinstance(given.get(n), str) else given.get(n, F.lit(None).cast("string"))).alias(n) for n in names))
    rows.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    got = R.require_rows(R.read_mentions(spark, path), "batch")
    return got.select(F.col("context_snippet").cast("long").alias("mention_id"), "mention_text", "is_editorial", "needs_review", F.col("confidence").cast("double").alias("confidence"), F.size("facts").alias("n_facts"), F.get("facts", F.lit(0))["fact_value"].alias("domain"))


def _as_csv(rows: DataFrame, name: str) -> str:
    path = scratch(rows.sparkSession, name)
    rows.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


@query("s06_review_queue", f"WITH m AS ({MENTIONS}) SELECT mention_id, episode_id, concat('two', chr(10), 'lines, \"', canonical_name, '\"') AS mention_text, CASE WHEN mention_id % 10 <> 0 THEN round(confidence, 4) END AS confidence, CASE WHEN mention_id % 3 = 0 THEN 'low_confidence' END AS review_reason, source_url FROM m WHERE needs_review")
def s06r(spark, sf_dir):
    k = F.col("mention_id")
    conf = F.when(k % 10 == 0, "n/a").otherwise(F.format_string("%.4f", F.round("confidence", 4)))
    given = {"episode_id": F.col("episode_id"), "entity_type": F.col("mention_type"), "canonical_name": F.col("canonical_name"), "mention_text": F.concat(F.lit('two\nlines, "'), "canonical_name", F.lit('"')), "confidence": conf, "review_reason": F.when(k % 3 == 0, "low_confidence"), "platform": F.lit(None).cast("string"), "source_url": F.col("source_url"), "context_snippet": k.cast("string")}
    rows = view(spark, sf_dir, MENTIONS).where("needs_review").select(*(c.alias(n) for n, c in given.items()))
    got = R.read_review_queue(spark, _as_csv(rows, "s06-review"))
    return got.select(F.col("context_snippet").cast("long").alias("mention_id"), "episode_id", "mention_text", F.col("confidence").cast("double").alias("confidence"), "review_reason", "source_url")


@query("s06_episode_summary", f"WITH m AS ({MENTIONS}) SELECT episode_id, CASE WHEN episode_id % 6 <> 0 THEN min(publish_date) END AS publish_date, count(*) AS mention_count, count(*) FILTER (needs_review) AS review_count, CASE WHEN episode_id % 4 = 0 THEN 0 ELSE 10 * count(*) END AS total_tokens, CASE WHEN episode_id % 4 <> 0 THEN count(*) / 8 END AS cost FROM m GROUP BY 1")
def s06s(spark, sf_dir):
    e = F.col("episode_id")
    per = view(spark, sf_dir, MENTIONS).groupBy("episode_id").agg(F.min("publish_date").alias("d"), F.count("*").alias("n"), F.count_if("needs_review").alias("r"))
    given = {"episode_id": e, "publish_date": F.when(e % 6 == 0, "soon").otherwise(F.col("d").cast("string")), "title": F.concat(F.lit('Part "'), e, F.lit('",\nsecond line')), "episode_url": F.lit(None).cast("string"), "transcript_path": F.lit("x.txt"), "mention_count": F.col("n"), "review_count": F.col("r")}
    given |= {c: F.when(e % 4 != 0, F.col("n") * x) for c, x in (("prompt_tokens", 8), ("completion_tokens", 2), ("total_tokens", 10))} | {"estimated_total_cost_usd": F.when(e % 4 != 0, F.format_string("%.6f", F.col("n") / 8)).otherwise("None")}
    got = R.read_episode_summary(spark, _as_csv(per.select(*(c.alias(n) for n, c in given.items())), "s06-summary"))
    return got.select("episode_id", "publish_date", F.col("mention_count").cast("long").alias("mention_count"), F.col("review_count").cast("long").alias("review_count"), "total_tokens", F.col("estimated_total_cost_usd").cast("double").alias("cost"))


@query("s07_manifests", "SELECT concat('batch-', CAST(floor(event_id / 500) AS BIGINT)) AS batch_name, event_type AS type, count(*) AS n FROM events GROUP BY ALL")
def s07(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 500).alias("b"), "event_type").agg(F.count("*").alias("n"))
    summary = F.map_from_entries(F.collect_list(F.struct("event_type", "n")))
    one = counts.groupBy("b").agg(F.concat(F.lit("batch-"), F.col("b")).alias("batch_name"), F.lit("m").alias("model"), summary.alias("summary")).drop("b")
    got = R.read_manifests(spark, _landed(one.select(F.to_json(F.struct("batch_name", "model", "summary")).alias("value")), "s07", one_each=True))
    return got.select("batch_name", F.explode("summary").alias("type", "n"))


@query("s08_fixture", "SELECT doc_id AS episode_id, sha256(text) AS input_sha256, CASE WHEN doc_id % 7 <> 0 THEN lang END AS key, CASE WHEN doc_id % 7 <> 0 THEN source END AS canonical_name, CASE WHEN doc_id % 7 <> 0 THEN (doc_id % 100) / 100.0 END AS confidence FROM documents")
def s08(spark, sf_dir):
    k = F.col("doc_id")
    entity = F.struct(F.col("source").alias("canonical_name"), F.col("lang").alias("entity_type"), ((k % 100) / 100.0).alias("confidence"))
    empty = F.create_map().cast("map<string,struct<canonical_name:string,entity_type:string,confidence:double>>")
    episode = F.struct(k.alias("episode_id"), F.sha2("text", 256).alias("input_sha256"), F.when(k % 7 != 0, F.create_map(F.col("lang"), entity)).otherwise(empty).alias("entities"))
    files = table(spark, sf_dir, "documents").groupBy(F.floor(k / 200)).agg(F.collect_list(episode).alias("episodes")).select(F.to_json(F.struct(F.create_map(F.lit("model"), F.lit("m")).alias("_meta"), "episodes")).alias("value"))
    return R.read_fixture(spark, _landed(files, "s08", one_each=True)).select("episode_id", "input_sha256", "key", "canonical_name", "confidence")


@query("s09_provenance", "SELECT doc_id AS episode_id, CASE WHEN doc_id % 3 <> 0 THEN doc_id * 10 END AS transcript_id FROM documents")
def s09(spark, sf_dir):
    k = F.col("doc_id")
    entry = F.struct(k.cast("string").alias("key"), F.when(k % 3 != 0, k * 10).alias("value"))
    files = table(spark, sf_dir, "documents").groupBy(F.floor(k / 200)).agg(F.map_from_entries(F.collect_list(entry)).alias("m"))
    return R.read_provenance(spark, _landed(files.select(F.to_json("m", {"ignoreNullFields": "false"}).alias("value")), "s09", one_each=True))


# ---------------------------------------------------------------- model answers

TYPES = ["report", "person", "organization", "survey", "benchmark", "account"]
_KIND = "CASE user_id % 5 WHEN 0 THEN 'report' WHEN 2 THEN 'person' WHEN 3 THEN 'survey' WHEN 4 THEN 'organization' ELSE {other} END"
_CONTEXT = "CASE user_id % 4 WHEN 0 THEN 'a fan survey' WHEN 1 THEN 'they posted it' WHEN 2 THEN 'a poll in the Times' ELSE 'an mmlu paper' END"
_STEPS = f"""a AS (SELECT event_id, user_id, event_id % 7 <> 0 AS editorial, concat('Name ', user_id % 60) AS name, lower({_CONTEXT}) AS ctx, {_KIND.format(other="'other'")} AS t0, user_id % 5 = 1 AS odd, greatest(0.0, least(1.0, value / 20)) AS conf FROM events),
    b AS (SELECT *, CASE WHEN odd THEN 'model_proposed_unknown_type' WHEN conf < 0.78 THEN 'low_confidence' END AS r0, CASE WHEN t0 = 'report' AND ctx LIKE '%times%' THEN 'organization' ELSE t0 END AS t1 FROM a),
    c AS (SELECT *, coalesce(r0, CASE WHEN t1 <> t0 THEN 'media_outlet_not_report' END) AS r1, CASE WHEN t1 = 'survey' AND ctx LIKE '%survey%' THEN ' survey' WHEN t1 = 'survey' AND ctx LIKE '%poll%' THEN ' poll' ELSE '' END AS suffix FROM b),
    d AS (SELECT *, coalesce(r1, CASE WHEN suffix <> '' THEN 'survey_suffix_added' END) AS r2, CASE WHEN t1 IN ('other', 'organization', 'person') AND ctx LIKE '%survey%' THEN 'survey' ELSE t1 END AS t2 FROM c),
    e AS (SELECT *, coalesce(r2, CASE WHEN t2 <> t1 THEN 'survey_retyped_from_context' END) AS r3, CASE WHEN t2 IN ('other', 'organization', 'person') AND ctx LIKE '%mmlu%' THEN 'benchmark' ELSE t2 END AS t3 FROM d),
    f AS (SELECT *, coalesce(r3, CASE WHEN t3 <> t2 THEN 'benchmark_retyped_from_context' END) AS r4, CASE WHEN t3 IN ('person', 'organization') AND ctx LIKE '%posted%' THEN 'account' ELSE t3 END AS t4 FROM e),
    g AS (SELECT event_id AS mention_id, concat(name, suffix) AS canonical_name, t4 AS mention_type, editorial, CASE WHEN t4 <> t3 THEN 'x' END AS platform, round(conf, 6) AS confidence, coalesce(r4, CASE WHEN t4 <> t3 THEN 'posting_context_retyped_to_account' WHEN t4 = 'other' THEN 'other_type_needs_review' END) AS review_reason FROM f)"""


def _mentions(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id AS mention_id", "concat('Name ', user_id % 60) AS canonical_name", "concat('Name ', user_id % 60) AS mention_text", _KIND.format(other="'dragon'") + " AS mention_type", f"{_CONTEXT} AS context_snippet", "CAST(NULL AS STRING) AS quoted_text", "CAST(NULL AS STRING) AS platform", "'neutral' AS sentiment_label", "CAST(value / 20 AS STRING) AS confidence", "event_id % 7 <> 0 AS is_editorial", "concat('Type ', user_id % 9) AS proposed")


def _answers(spark, sf_dir) -> DataFrame:
    """(episode_id, response): fenced JSON as a model gives it, 20 mentions to an episode."""
    m = _mentions(spark, sf_dir)
    one = F.struct(*(c for c in m.columns if c != "proposed"))
    per = m.groupBy(F.floor(F.col("mention_id") / 20).alias("episode_id")).agg(F.collect_list(one).alias("mentions"), F.collect_list("proposed").alias("new_type_candidates"))
    return per.select("episode_id", F.concat(F.lit("```json\n"), F.to_json(F.struct("mentions", "new_type_candidates")), F.lit("\n```")).alias("response"))


@query("n16_retype", f"WITH {_STEPS} SELECT mention_id, canonical_name, mention_type, platform, review_reason FROM g")
def n16(spark, sf_dir):
    clean = M.sanitize_mentions(_mentions(spark, sf_dir), TYPES)
    return M.retype_mentions(clean, M.tech_rules(), TYPES).select("mention_id", "canonical_name", "mention_type", "platform", "review_reason")


@query("n17_mention_pipeline", f"WITH {_STEPS} SELECT mention_id, canonical_name, mention_type, confidence, review_reason IS NOT NULL AS needs_review, review_reason FROM g WHERE editorial AND mention_type IN ('survey', 'report', 'account', 'other')")
def n17(spark, sf_dir):
    out = M.process_responses(_answers(spark, sf_dir), TYPES, ["survey", "report", "account"])
    return out.select("mention_id", "canonical_name", "mention_type", F.round("confidence", 6).alias("confidence"), "needs_review", "review_reason")


@query("n17_rejected_answers", "WITH e AS (SELECT DISTINCT CAST(floor(event_id / 20) AS BIGINT) AS id FROM events) SELECT id AS episode_id, CASE id % 9 WHEN 0 THEN 'not_json' WHEN 1 THEN 'empty' WHEN 2 THEN 'not_an_object' WHEN 3 THEN 'no_mentions' ELSE 'mentions_not_a_list' END AS reason FROM e WHERE id % 9 < 5")
def n17r(spark, sf_dir):
    """Answers of which some are cut off, empty or of another shape; they are told apart, not lost."""
    k = F.col("episode_id") % 9
    bad = F.when(k == 0, F.left("response", F.lit(40))).when(k == 1, "```json\n```").when(k == 2, '[1, 2]').when(k == 3, '{"new_type_candidates": []}').when(k == 4, '```{"mentions": {"x": 1}}```')
    answers = _answers(spark, sf_dir).withColumn("response", F.coalesce(bad, "response"))
    return M.rejected_responses(answers).select("episode_id", "reason")


@query("n18_new_types", "SELECT concat('type ', user_id % 9) AS type, count(*) AS n FROM events WHERE user_id % 9 NOT IN (1, 2, 3) GROUP BY 1")
def n18(spark, sf_dir):
    read = _answers(spark, sf_dir).select(F.from_json(F.regexp_extract("response", r"(?s)\{.*\}", 0), M.RESPONSE).alias("r")).select("r.new_type_candidates")
    known = table(spark, sf_dir, "events").where("user_id % 9 in (1, 2, 3)").select(F.concat(F.lit("type "), F.col("user_id") % 9).alias("type")).distinct()
    return M.new_type_candidates(read, known, "new_type_candidates")


# ---------------------------------------------------------------- song pages


def _pages(spark, sf_dir, text) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("t"))


@query("n21_song_lines", """SELECT p_partkey, 0 AS pos, p_brand AS artist, p_name AS title FROM part WHERE p_partkey % 3 <> 2 UNION ALL SELECT p_partkey, 1, p_type, p_name FROM part WHERE p_partkey % 3 = 0""")
def n21(spark, sf_dir):
    listed = F.concat(F.lit("# T\nIntro.\n\n**Songs Discussed**\n- "), "p_brand", F.lit(" – "), "p_name", F.lit("\n- "), "p_type", F.lit(" - "), "p_name", F.lit("\n\n**Credits**\n- No – Song"))
    quoted = F.concat(F.lit("**Songs Discussed**\n"), "p_brand", F.lit(" “"), "p_name", F.lit("”\n"))
    k = F.col("p_partkey")
    return R.song_lines(_pages(spark, sf_dir, F.when(k % 3 == 0, listed).when(k % 3 == 1, quoted).otherwise("no songs")), "p_partkey", "t")


@query("n22_song_sections", "SELECT p_partkey, 0 AS pos, p_name AS title, p_brand AS artist FROM part WHERE p_partkey % 3 <> 2")
def n22(spark, sf_dir):
    k = F.col("p_partkey")
    by = F.concat(F.lit("text\n## Song: “"), "p_name", F.lit("” by "), "p_brand", F.lit(" (live)\nmore"))
    dash = F.concat(F.lit("## Song: "), "p_brand", F.lit(" – "), "p_name")
    return R.song_sections(_pages(spark, sf_dir, F.when(k % 3 == 0, by).when(k % 3 == 1, dash).otherwise("# 404")), "p_partkey", "t")


@query("n23_episode_list", "SELECT p_partkey, 0 AS pos, p_name AS title, concat('https://e.example/', p_partkey) AS url, CASE WHEN p_partkey % 4 <> 0 THEN DATE '2024-01-01' + CAST(p_partkey % 300 AS INTEGER) END AS publish_date FROM part")
def n23(spark, sf_dir):
    k = F.col("p_partkey")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int")), "MMMM d, yyyy")
    return R.episode_list(_pages(spark, sf_dir, F.concat(F.when(k % 4 != 0, day).otherwise("undated"), F.lit("\n\n["), "p_name", F.lit("](https://e.example/"), k, F.lit(")\n"))), "p_partkey", "t")


@query("n24_description", "SELECT p_partkey, concat(p_brand, ' talks.', CASE WHEN p_partkey % 2 = 0 THEN concat(chr(10), chr(10), 'More on ', p_type) ELSE '' END) AS body FROM part")
def n24(spark, sf_dir):
    k = F.col("p_partkey")
    text = F.concat(F.lit("# "), "p_name", F.lit("\n"), "p_brand", F.lit(" talks."), F.when(k % 2 == 0, F.concat(F.lit("\n\nMore on "), "p_type")).otherwise(""), F.lit("\n\n**Songs**\nx\n## End"))
    return _pages(spark, sf_dir, text).select("p_partkey", R.description_body(F.col("t")).alias("body"))
