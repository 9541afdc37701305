"""Row-level jobs over the test tables."""

from __future__ import annotations

from html import unescape
from html.entities import html5

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from .base import query, table

_KEY = r"trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '[\s\-_]+', ' ', 'g'), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g'))"
_ALIAS = r"trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g'))"
_NAME = "concat(' ', upper(p_name), '-', p_brand, '!! ')"


def _named(spark, sf_dir):
    return table(spark, sf_dir, "part").withColumn("raw", F.concat(F.lit(" "), F.upper("p_name"), F.lit("-"), F.col("p_brand"), F.lit("!! ")))


@query("n01_entity_key", f"SELECT p_partkey, {_KEY.format(c=_NAME)} AS k FROM part")
def n01(spark, sf_dir):
    return _named(spark, sf_dir).select("p_partkey", T.entity_key(F.col("raw")).alias("k"))


@query("n02_alias_key", f"SELECT p_partkey, {_ALIAS.format(c=_NAME)} AS k FROM part")
def n02(spark, sf_dir):
    return _named(spark, sf_dir).select("p_partkey", T.alias_key(F.col("raw")).alias("k"))


@query("n03_compact_key", f"SELECT p_partkey, replace({_KEY.format(c=_NAME)}, ' ', '') AS k FROM part")
def n03(spark, sf_dir):
    return _named(spark, sf_dir).select("p_partkey", T.compact_key(F.col("raw")).alias("k"))


@query("n04_text_forms", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS flat, trim(regexp_replace(lower(text), '[^\p{L}\p{N}\p{M}]+', ' ', 'g')) AS form FROM documents")
def n04(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.collapse_blanks(F.col("text")).alias("flat"), T.match_form(F.col("text")).alias("form"))


# What html.unescape() takes for a reference, and Unicode's white space.
_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_BLANKS = r"[\t-\r \x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _references() -> str:
    """Character references of HTML as html.unescape() reads them: whole table of names, with or without the semicolon, and numbers."""
    text = lambda v: "'" + v.replace("'", "''") + "'"
    names = ", ".join(f"({text(n)}, {text(v)})" for n, v in sorted(html5.items()))
    low = ", ".join(f"({n}, {text(v) if '\x00' not in v else 'NULL'})" for n in range(160) for v in (unescape(f"&#{n};"),))
    return rf"""names AS (SELECT * FROM (VALUES {names}) v(name, value)), low AS (SELECT * FROM (VALUES {low}) v(n, value)),
    b AS (SELECT page_id, row_number() OVER () AS r, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script[\s\x0b]*>|<style\b.*?</style[\s\x0b]*>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') AS t FROM pages),
    p AS (SELECT r, unnest(string_split_regex(t, '{_REFERENCE}')) AS gap, unnest(list_prepend('', regexp_extract_all(t, '{_REFERENCE}'))) AS ref, generate_subscripts(string_split_regex(t, '{_REFERENCE}'), 1) AS k FROM b),
    x AS (SELECT DISTINCT ref, substr(ref, 2) AS s, ltrim(regexp_extract(ref, '^&#([0-9]+)', 1), '0') AS d, ltrim(regexp_extract(ref, '^&#[xX]([0-9a-fA-F]+)', 1), '0') AS h FROM p),
    y AS (SELECT ref, s, starts_with(ref, '&#') AS number, CASE WHEN greatest(length(d), length(h)) > 7 THEN 2000000 WHEN d <> '' THEN CAST(d AS BIGINT) WHEN h <> '' THEN CAST(concat('0x', h) AS BIGINT) ELSE 0 END AS n FROM x),
    named AS (SELECT ref, arg_max(value || substr(s, length(name) + 1), length(name)) AS value FROM y JOIN names ON starts_with(s, name) WHERE NOT number GROUP BY 1),
    d AS (SELECT ref, CASE WHEN NOT number THEN coalesce(named.value, ref) WHEN y.n < 160 THEN low.value WHEN y.n BETWEEN 55296 AND 57343 OR y.n > 1114111 THEN chr(65533) WHEN y.n BETWEEN 64976 AND 65007 OR y.n & 65534 = 65534 THEN '' ELSE chr(CAST(y.n AS INTEGER)) END AS value
      FROM y LEFT JOIN named USING (ref) LEFT JOIN low ON low.n = y.n),
    u AS (SELECT r, string_agg(value || gap, '' ORDER BY k) AS t FROM p JOIN d USING (ref) GROUP BY 1)"""


@query("n05_html_text", rf"""WITH {_references()}
    SELECT page_id, trim(regexp_replace(trim(regexp_replace(u.t, '{_BLANKS}', ' ', 'g')), ' +([.,;:!?])', '\1', 'g')) AS text FROM b LEFT JOIN u USING (r)""")
def n05(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query(
    "n06_page_metadata",
    r"""SELECT page_id, nullif(trim(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title>', 1)), '') AS title,
    nullif(trim(regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1>', 1)), '') AS heading,
    nullif(regexp_extract(html, '(?is)<meta[^>]*(?:property|name)=["'']og:title["''][^>]*content=["'']([^"'']*)["'']', 1), '') AS og FROM pages""",
)
def n06(spark, sf_dir):
    c = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", U.element_text(c, "title").alias("title"), U.element_text(c, "h1").alias("heading"), U.meta_content(c, "og:title").alias("og"))


_HOST = r"regexp_replace(lower(regexp_extract({u}, '^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?', 2)), '^www\.', '')"
_PATH = r"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_QUERY = r"regexp_extract({u}, '^[^?#]*\?([^#]*)', 1)"
_KEPT = f"array_to_string(list_filter(string_split({_QUERY.format(u='url')}, '&'), lambda p: p <> '' AND NOT list_contains(['ref','source','fbclid','gclid','mc_cid','mc_eid'], string_split(p, '=')[1]) AND NOT starts_with(p, 'utm_')), '&')"
CANONICAL = f"concat('https://', {_HOST.format(u='url')}, regexp_replace({_PATH.format(u='url')}, '/+$', ''), CASE WHEN {_KEPT} <> '' THEN concat('?', {_KEPT}) ELSE '' END)"


@query("n07_canonical_url", f"SELECT page_id, {CANONICAL} AS url FROM pages")
def n07(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.canonical_url(F.col("url")).alias("url"))


_SEG = f"list_filter(string_split({_PATH.format(u='url')}, '/'), lambda s: s <> '')"


@query("n08_is_post", f"SELECT page_id, len({_SEG}) >= 2 OR (len({_SEG}) = 1 AND (contains({_SEG}[1], '-') OR length({_SEG}[1]) >= 20)) AS is_post, ends_with(lower({_PATH.format(u='url')}), '.pdf') AS is_pdf FROM pages")
def n08(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.is_post(F.col("url")).alias("is_post"), U.is_pdf(F.col("url")).alias("is_pdf"))


@query(
    "n09_domain_platform",
    rf"""WITH p AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN concat('https://www.github.com/@User', page_id, '/x') ELSE url END AS url FROM pages)
    SELECT page_id, {_HOST.format(u='url')} AS domain, CASE WHEN page_id % 3 = 0 THEN 'github' END AS platform, CASE WHEN page_id % 3 = 0 THEN concat('user', page_id) END AS handle FROM p""",
)
def n09(spark, sf_dir):
    p = table(spark, sf_dir, "pages").withColumn("url", F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("https://www.github.com/@User"), F.col("page_id"), F.lit("/x"))).otherwise(F.col("url")))
    return p.select("page_id", U.host(F.col("url")).alias("domain"), U.platform(F.col("url")).alias("platform"), U.handle(F.col("url")).alias("handle"))


@query(
    "n10_publish_date",
    """WITH p AS (SELECT page_id, concat(url, '/2026/', lpad(CAST(page_id % 14 AS VARCHAR), 2, '0'), '/', lpad(CAST(page_id % 33 AS VARCHAR), 2, '0'), '/') AS url,
    CASE WHEN page_id % 4 = 0 THEN '2025-11-30T10:00:00Z' WHEN page_id % 4 = 1 THEN 'yesterday' END AS meta FROM pages)
    SELECT page_id, coalesce(try_cast(substring(CASE WHEN page_id % 4 = 0 THEN meta END, 1, 10) AS DATE),
    CASE WHEN url LIKE '%?%' OR url LIKE '%#%' OR true THEN try_cast(replace(nullif(regexp_extract(url, '/([0-9]{4}/[0-9]{2}/[0-9]{2})(?:/|$)', 1), ''), '/', '-') AS DATE) END) AS published FROM p""",
)
def n10(spark, sf_dir):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    k = F.col("page_id")
    p = table(spark, sf_dir, "pages").select("page_id", F.concat("url", F.lit("/2026/"), two(k % 14), F.lit("/"), two(k % 33), F.lit("/")).alias("url"), F.when(k % 4 == 0, "2025-11-30T10:00:00Z").when(k % 4 == 1, "yesterday").alias("meta"))
    return p.select("page_id", U.publish_date(F.col("url"), F.col("meta")).alias("published"))


@query(
    "n11_pick_title",
    r"""WITH p AS (SELECT page_id, url, CASE WHEN page_id % 2 = 0 THEN concat(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title>', 1), ' | Some Site') END AS og, CASE WHEN page_id % 3 = 0 THEN ' ' ELSE 'Plain' END AS plain FROM pages)
    SELECT page_id, coalesce(nullif(trim(regexp_replace(og, '\s+\|\s+[^|]*$', '')), ''), nullif(trim(plain), ''), url) AS title FROM p""",
)
def n11(spark, sf_dir):
    k = F.col("page_id")
    og = F.when(k % 2 == 0, F.concat(F.regexp_extract("html", r"(?is)<title\b[^>]*>(.*?)</title>", 1), F.lit(" | Some Site")))
    p = table(spark, sf_dir, "pages").select("page_id", "url", og.alias("og"), F.when(k % 3 == 0, " ").otherwise("Plain").alias("plain"))
    return p.select("page_id", U.pick_title(F.col("url"), F.col("og"), F.col("plain")).alias("title"))


@query("n12_word_and_link_counts", r"""SELECT page_id, CAST(len(regexp_extract_all(html, '\S+')) AS BIGINT) AS words, CAST(len(regexp_extract_all(html, '(?i)href=["'']https?://')) AS BIGINT) AS links FROM pages""")
def n12(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.word_count(F.col("html")).alias("words"), U.links_out(F.col("html")).alias("links"))


@query("n13_input_hash", "SELECT doc_id, sha256(left(text, 2000)) AS hash, CAST(least(length(text), 2000) AS BIGINT) AS used, doc_id % 2 = 1 AS drifted FROM documents")
def n13(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("hash", T.input_hash(F.col("text"), 2000))
    stored = F.when(F.col("doc_id") % 2 == 0, F.col("hash")).otherwise("0")
    return d.select("doc_id", "hash", F.least(F.length("text"), F.lit(2000)).cast("long").alias("used"), (F.col("hash") != stored).alias("drifted"))


@query("n14_slug", r"SELECT page_id, regexp_replace(left(regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 30), '-+$', '') AS slug FROM pages")
def n14(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.slug(F.col("url"), 30).alias("slug"))


@query("n25_strip_quotes", "SELECT p_partkey, p_name AS title FROM part")
def n25(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.strip_quotes(F.concat(F.lit("“'"), F.col("p_name"), F.lit('"'))).alias("title"))


@query("n26_number_in_path", rf"SELECT page_id, try_cast(nullif(regexp_extract({_PATH.format(u='url')}, '/([0-9]+)(?:/|$)', 1), '') AS BIGINT) AS number FROM pages")
def n26(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.number_in_path(F.col("url")).alias("number"))


@query("n27_confidence_band", "SELECT event_id, CASE WHEN least(value/50,1.0) >= 0.9 THEN 'HIGH' WHEN least(value/50,1.0) >= 0.7 THEN 'MEDIUM' ELSE 'LOW' END AS band FROM events")
def n27(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", T.confidence_band(F.least(F.col("value") / 50, F.lit(1.0))).alias("band"))


@query(
    "n28_token_cost",
    """SELECT e.event_type AS model, round(sum(CAST(floor(value * 100) AS BIGINT) * p.a / 1000000 + CAST(floor(value * 10) AS BIGINT) * p.b / 1000000), 6) AS cost
    FROM events e JOIN (VALUES ('click', 0.4, 1.6), ('view', 2.0, 8.0), ('error', 0.1, 0.4)) p(m, a, b) ON p.m = e.event_type GROUP BY 1""",
)
def n28(spark, sf_dir):
    prices = spark.createDataFrame([("click", 0.4, 1.6), ("view", 2.0, 8.0), ("error", 0.1, 0.4)], "event_type string, a double, b double")
    e = table(spark, sf_dir, "events").join(F.broadcast(prices), "event_type")
    cost = T.token_cost(F.floor(F.col("value") * 100).cast("long"), F.floor(F.col("value") * 10).cast("long"), F.col("a"), F.col("b"))
    return e.groupBy(F.col("event_type").alias("model")).agg(F.round(F.sum(cost), 6).alias("cost"))


@query("n30_short_quote", r"""WITH f AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS f FROM documents) SELECT doc_id, CASE WHEN length(f) <= 480 THEN f ELSE concat(regexp_replace(left(f, 240), ' [^ ]*$', ''), ' … ', regexp_replace(right(f, 240), '^[^ ]* ', '')) END AS quote FROM f""")
def n30(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.short_quote(F.col("text")).alias("quote"))


@query("n31_suspect_scrapes", "SELECT doc_id, text IS NULL OR lang IS NULL AS missing_core, length(text) < 500 AS thin, contains(text, '**') OR contains(text, '](') AS markdown_left FROM documents WHERE text IS NULL OR lang IS NULL OR length(text) < 500 OR contains(text, '**') OR contains(text, '](')")
def n31(spark, sf_dir):
    from ..operators.mentions import suspect_scrapes

    return suspect_scrapes(table(spark, sf_dir, "documents"), "text", ["text", "lang"]).select("doc_id", "missing_core", "thin", "markdown_left")


@query("n19_facts_and_tags", """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 0 ELSE 2 END AS n_facts, CASE WHEN event_id % 3 = 0 THEN 'x' END AS platform, CASE WHEN user_id % 2 = 0 THEN 'true' END AS is_account,
    CASE WHEN event_id % 5 <> 0 THEN json_extract_string(props, '$.k') END AS domain, CASE WHEN event_id % 5 <> 0 THEN CASE WHEN user_id % 4 = 0 THEN 'false' ELSE 'true' END END AS questions FROM events""")
def n19(spark, sf_dir):
    from ..operators.mentions import derive_tags, parse_facts

    k, u = F.col("event_id"), F.col("user_id")
    text = F.concat(F.lit('[{"fact_key": " Domain", "fact_value": "'), F.get_json_object("props", "$.k"), F.lit('"}, 7, {"fact_key": "has_survey_questions", "fact_value": '), F.when(u % 4 == 0, "false").otherwise("true"), F.lit("}]"))
    facts = parse_facts(F.when(k % 5 == 0, "no json").otherwise(text))
    e = table(spark, sf_dir, "events").select("event_id", F.when(u % 2 == 0, "account").otherwise(F.col("event_type")).alias("kind"), F.when(k % 3 == 0, "X").alias("platform"), facts.alias("facts"))
    # Facts are a column first, so they are read from their JSON once.
    e = e.select("event_id", "facts", derive_tags(F.col("kind"), F.col("platform"), F.col("facts")).alias("tags"))
    return e.select("event_id", F.size("facts").alias("n_facts"), *(F.col("tags")[t].alias(n) for t, n in (("platform", "platform"), ("is_account", "is_account"), ("domain", "domain"), ("contains_survey_questions", "questions"))))


@query(
    "n15_sanitize_mentions",
    """WITH m AS (SELECT event_id, CASE WHEN user_id % 10 = 0 THEN ' ' ELSE concat('Name ', user_id) END AS name, CASE WHEN event_id % 9 = 0 THEN 'dragon' ELSE event_type END AS type,
      CASE WHEN event_id % 8 = 0 THEN 'nope' ELSE CAST(value / 20 - 0.2 AS VARCHAR) END AS conf FROM events),
    c AS (SELECT event_id, trim(name) AS name, CASE WHEN type IN ('click','view','purchase','error') THEN type ELSE 'other' END AS type, type NOT IN ('click','view','purchase','error') AS odd,
      greatest(0.0, least(1.0, coalesce(try_cast(conf AS DOUBLE), 0.5))) AS confidence FROM m WHERE trim(name) <> '')
    SELECT event_id, name, type, round(confidence, 6) AS confidence, odd OR confidence < 0.78 AS needs_review, CASE WHEN odd THEN 'model_proposed_unknown_type' WHEN confidence < 0.78 THEN 'low_confidence' END AS review_reason FROM c""",
)
def n15(spark, sf_dir):
    from ..operators.mentions import sanitize_mentions

    k = F.col("event_id")
    m = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("user_id") % 10 == 0, " ").otherwise(F.concat(F.lit("Name "), F.col("user_id"))).alias("canonical_name"),
        F.lit("text").alias("mention_text"),
        F.lit("context").alias("context_snippet"),
        F.when(k % 9 == 0, "dragon").otherwise(F.col("event_type")).alias("mention_type"),
        F.lit("odd").alias("sentiment_label"),
        F.when(k % 8 == 0, "nope").otherwise((F.col("value") / 20 - 0.2).cast("string")).alias("confidence"),
    )
    out = sanitize_mentions(m, ["click", "view", "purchase", "error"])
    return out.select("event_id", F.col("canonical_name").alias("name"), F.col("mention_type").alias("type"), F.round("confidence", 6).alias("confidence"), "needs_review", "review_reason")
