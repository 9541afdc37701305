"""Search and fuzzy matching over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matching as M
from ..operators import search as S
from ..operators import text_index as X
from .base import query, scratch, table
from .landing import PIECES

_W = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
_POST = f"p AS (SELECT doc_id, unnest({_W}) AS term, generate_subscripts({_W}, 1) - 1 AS pos FROM documents)"


def _index(spark, sf_dir) -> str:
    path = scratch(spark, "text-index")
    X.build_index(table(spark, sf_dir, "documents"), "doc_id", "text", path)
    return path


@query("f01_term_index", f"WITH {_POST} SELECT term, count(DISTINCT doc_id) AS docs, count(*) AS n, CAST(max(pos) AS BIGINT) AS last FROM p GROUP BY 1")
def f01(spark, sf_dir):
    """Counts from the measures of a stored index; no postings are read."""
    rows = spark.read.parquet(f"{_index(spark, sf_dir)}/postings")
    return rows.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.max("last").cast("long").alias("last"))


@query(
    "f02_web_search",
    f"""WITH {_POST}, t AS (SELECT doc_id, term, count(*) AS tf FROM p WHERE term IN ('thand', 'that', 'of', 'the', 'stupid') GROUP BY ALL), d AS (SELECT term, count(*) AS df FROM t GROUP BY 1),
    s AS (SELECT doc_id, sum(CASE WHEN term <> 'stupid' THEN tf * ln((SELECT count(*) FROM documents) / df) ELSE 0 END) AS score FROM t JOIN d USING (term) GROUP BY 1
      HAVING bool_or(term = 'that') AND (bool_or(term = 'thand') OR bool_or(term = 'of')) AND NOT bool_or(term = 'stupid')),
    ph AS (SELECT DISTINCT a.doc_id FROM p a JOIN p b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 WHERE a.term = 'of' AND b.term = 'the')
    SELECT doc_id, round(score, 6) AS score FROM s JOIN ph USING (doc_id)""",
)
def f02(spark, sf_dir):
    found = X.search_index(spark, _index(spark, sf_dir), **S.web_terms('that thand OR of -stupid "of the"'))
    return found.withColumn("score", F.round("score", 6))


_HIT = "h AS (SELECT doc_id, pos, term FROM p SEMI JOIN top USING (doc_id) WHERE term IN ('that', 'of'))"


def _best(name: str, hits: str, more: str = "") -> str:
    """The best window of hits for each document, widened to 6 words."""
    return f"""{name}0 AS (SELECT a.doc_id, a.pos AS s, b.pos AS e, count(DISTINCT c.term) AS d FROM {hits} a JOIN {hits} b ON a.doc_id = b.doc_id AND b.pos BETWEEN a.pos AND a.pos + 21 JOIN {hits} c ON c.doc_id = a.doc_id AND c.pos BETWEEN a.pos AND b.pos {more} GROUP BY ALL),
    {name}1 AS (SELECT doc_id, s, least(len - 1, greatest(e, s + 5)) AS e, len FROM (SELECT * FROM {name}0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d DESC, e - s, s) = 1) JOIN size USING (doc_id)), {name} AS (SELECT doc_id, greatest(0, least(s, e - 5)) AS s, e FROM {name}1)"""


@query(
    "f03_snippets",
    rf"""WITH {_POST}, t AS (SELECT doc_id, term, count(*) AS tf FROM p WHERE term IN ('that', 'of') GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM t GROUP BY 1),
    top AS (SELECT doc_id, sum(tf * ln((SELECT count(*) FROM documents) / df)) AS score FROM t JOIN f USING (term) GROUP BY 1 HAVING count(*) = 2 ORDER BY 2 DESC, 1 LIMIT 20),
    {_HIT}, size AS (SELECT doc_id, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+')) AS len FROM documents SEMI JOIN top USING (doc_id)), {_best("x", "h")},
    h2 AS (SELECT h.* FROM h JOIN x ON h.doc_id = x.doc_id AND NOT h.pos BETWEEN x.s AND x.e), {_best("y", "h2", "AND NOT EXISTS (FROM x WHERE x.doc_id = a.doc_id AND a.pos < x.s AND b.pos >= x.s)")},
    m AS (SELECT x.doc_id, CASE WHEN y.s IS NULL THEN [(x.s, x.e)] WHEN y.s <= x.e + 1 AND x.s <= y.e + 1 THEN [(least(x.s, y.s), greatest(x.e, y.e))] WHEN x.s < y.s THEN [(x.s, x.e), (y.s, y.e)] ELSE [(y.s, y.e), (x.s, x.e)] END AS f FROM x LEFT JOIN y USING (doc_id)),
    w AS (SELECT doc_id, f, list_transform(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+[^\p{{L}}\p{{N}}]*'), lambda v: CASE WHEN lower(regexp_extract(v, '^[\p{{L}}\p{{N}}]+')) IN ('that', 'of') THEN regexp_replace(v, '^([\p{{L}}\p{{N}}]+)', '[\1]') ELSE v END) AS w FROM m JOIN documents USING (doc_id))
    SELECT doc_id, round(score, 6) AS score, list_transform(f, lambda q: trim(regexp_replace(array_to_string(w[q[1] + 1 : q[2] + 1], ''), '\s+', ' ', 'g'))) AS fragments FROM w JOIN top USING (doc_id)""",
)
def f03(spark, sf_dir):
    path = _index(spark, sf_dir)
    terms = ["that", "of"]
    top = X.search_index(spark, path, every=terms, limit=20)
    return S.snippets(top, X.places_of(X.rows_of(spark, path, terms)), table(spark, sf_dir, "documents"), "doc_id", "text", terms).withColumn("score", F.round("score", 6))


@query("f04_keyword", "SELECT doc_id FROM documents WHERE text ILIKE '%license%'")
def f04(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("text").ilike("%license%")).select("doc_id")


@query("f05_vector_top", "WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 7) SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT v FROM q)), 8) AS score FROM embeddings WHERE label % 2 = 0 ORDER BY list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT v FROM q)) DESC, vec_id LIMIT 10")
def f05(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id = 7").select("embedding").first()[0]
    return S.vector_top(e, q, 10, "vec_id", "embedding", F.col("label") % 2 == 0).withColumn("score", F.round("score", 8))


@query(
    "f06_chunks",
    r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents), c AS (SELECT doc_id, w, unnest(range(0, CAST(greatest(0, ceil((len(w) - 200) / 160)) AS BIGINT) + 1)) AS chunk FROM w WHERE len(w) > 0)
    SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, array_to_string(w[chunk * 160 + 1 : chunk * 160 + 200], ' ') AS text FROM c""",
)
def f06(spark, sf_dir):
    return S.chunks(table(spark, sf_dir, "documents"), "doc_id", "text", 200, 40)


@query("j12_title_resolution")
def j12(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    wanted = p.select(k.alias("wanted_id"), F.lit("x").alias("source"), F.concat("p_name", F.when(k % 3 == 0, "s").otherwise("")).alias("title"))
    return M.resolve_titles(wanted, p.select(k.alias("episode_id"), F.lit("x").alias("source"), F.col("p_name").alias("title")))


# Longest common subsequences of all pairs of texts of two tables (x) and (y), one row of the table of lengths at a time.
_LCS = """list_reduce(list_transform(string_split(x, ''), lambda c: [CAST(unicode(c) AS BIGINT)]), lambda r, c: list_reduce(list_transform(range(1, len(y) + 1), lambda j: [j]),
      lambda n, j: list_append(n, CASE WHEN unicode(y[j[1]]) = c[1] THEN r[j[1]] + 1 ELSE greatest(r[j[1] + 1], n[j[1]]) END), [CAST(0 AS BIGINT)]), list_transform(range(len(y) + 1), lambda j: CAST(0 AS BIGINT)))[len(y) + 1]"""


@query("j13_catalog_match", f"""WITH s AS (SELECT p_partkey AS song_id, lower(concat(p_name, ' ok')) AS a, trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g')) AS r, p_partkey FROM part), c AS (SELECT p_partkey AS catalog_id, lower(p_name) AS b, trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g')) AS r FROM part),
    t AS (SELECT a AS x, b AS y FROM (SELECT DISTINCT a FROM s) JOIN (SELECT DISTINCT b FROM c) ON len(list_intersect(string_split(a, ' '), string_split(b, ' '))) > 0), n AS (SELECT i.r AS x, j.r AS y FROM (SELECT DISTINCT r FROM s) i, (SELECT DISTINCT r FROM c) j),
    tr AS (SELECT x AS a, y AS b, round_even(100.0::DOUBLE * 2 * ({_LCS}) / (len(x) + len(y)), 0) / 100 AS t FROM t), nr AS (SELECT x, y, round_even(100.0::DOUBLE * 2 * ({_LCS}) / (len(x) + len(y)), 0) / 100 AS q FROM n),
    k AS (SELECT b, r, min(catalog_id) AS catalog_id FROM c GROUP BY ALL), d AS (SELECT DISTINCT a, r FROM s),
    m AS (SELECT d.a, d.r, catalog_id, round(CAST(CAST(0.55::DOUBLE * t + 0.45::DOUBLE * q AS VARCHAR) AS DECIMAL(30, 20)), 3)::DOUBLE AS score FROM d JOIN tr USING (a) JOIN k USING (b) JOIN nr ON nr.x = d.r AND nr.y = k.r),
    best AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY a, r ORDER BY score DESC, catalog_id) = 1)
    SELECT song_id, catalog_id, score, CASE WHEN score >= 0.9 THEN 'HIGH' WHEN score >= 0.7 THEN 'MEDIUM' ELSE 'LOW' END AS band FROM s JOIN best USING (a, r)""")
def j13(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    songs = p.select(k.alias("song_id"), F.concat(F.col("p_name"), F.lit(" ok")).alias("title"), F.col("p_brand").alias("artist"))
    return M.match_catalog(songs, p.select(k.alias("catalog_id"), F.col("p_name").alias("title"), F.array("p_brand").alias("artists")))


@query("j15_weighted_match")
def j15(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    wanted = p.select(k.alias("wanted_id"), F.col("p_name").alias("title"), F.when(k % 40 == 0, F.col("p_brand")).alias("source"))
    return M.weighted_title_match(wanted, p.select(k.alias("episode_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("source")))


def _laid(name: str, needle: str, docs: str) -> str:
    """Equal words of needles (item_id, nw) and texts (item_id or none, doc_id, w) by offset, in runs with what their neighbours share."""
    pair = "USING (item_id, t)" if docs == "rest" else "USING (t)"
    also = "item_id, " if docs == "rest" else ""
    same = "list_max(list_filter(range(least(len(x), len(y)) + 1), lambda q: {side}(x, q) = {side}(y, q)))"
    return f"""{name}h AS (SELECT item_id, doc_id, pos - j AS lay, j FROM (SELECT {also}doc_id, unnest(w) AS t, unnest(range(len(w))) AS pos FROM {docs}) JOIN (SELECT item_id, unnest(nw) AS t, unnest(range(len(nw))) AS j FROM {needle}) {pair}),
    {name}i AS (SELECT item_id, doc_id, lay, min(j) AS a, max(j) AS b FROM (SELECT *, j - row_number() OVER (PARTITION BY item_id, doc_id, lay ORDER BY j) AS g FROM {name}h) GROUP BY item_id, doc_id, lay, g),
    {name}c AS (SELECT {name}i.*, nw, len(array_to_string(nw, ' ')) AS length, len(array_to_string(nw[a + 1 : b + 1], ' ')) AS core FROM {name}i JOIN {needle} USING (item_id)
      WHERE core + 2 + coalesce(len(nw[a]), 0) + coalesce(len(nw[b + 2]), 0) >= floor(length * 0.6::DOUBLE)),
    {name}e AS (SELECT {name}c.*, CASE WHEN b + 1 < len(nw) AND lay + b + 1 < len(w) THEN 1 + (SELECT {same.format(side="left")} FROM (SELECT nw[b + 2] AS x, w[lay + b + 2] AS y)) ELSE 0 END AS after,
      CASE WHEN a > 0 AND lay + a > 0 THEN 1 + (SELECT {same.format(side="right")} FROM (SELECT nw[a] AS x, w[lay + a] AS y)) ELSE 0 END AS before FROM {name}c JOIN {docs} USING ({also}doc_id)),
    {name} AS (SELECT *, core + after + before AS size FROM {name}e WHERE core + after + before >= floor(length * 0.6::DOUBLE) QUALIFY row_number() OVER (PARTITION BY item_id, doc_id ORDER BY size DESC, lay + a, before DESC, a) = 1)"""


@query(
    "j16_locate_passages",
    rf"""WITH d AS (SELECT doc_id, {_W} AS w FROM documents), p AS (SELECT item_id, {_W} AS p FROM benchmark), n AS (SELECT item_id, p[1:12] AS nw FROM p), m AS (SELECT item_id, p[greatest(len(p) - 12, 0) + 1 : len(p)] AS nw FROM p),
    {_laid("x", "n", "d")},
    rest AS (SELECT item_id, doc_id, greatest(lay, 0) AS since, w[greatest(lay, 0) + 1 : len(w)] AS w FROM x JOIN d USING (doc_id)), {_laid("y", "m", "rest")}
    SELECT item_id AS passage_id, doc_id, CAST(greatest(x.lay, 0) AS INTEGER) AS first_word, CAST(since + least(y.lay + len(y.nw), len(rest.w)) - 1 AS INTEGER) AS last_word, CAST(len(p) AS INTEGER) AS words, round(x.size / x.length, 4) AS share
    FROM x JOIN p USING (item_id) JOIN rest USING (item_id, doc_id) LEFT JOIN y USING (item_id, doc_id)""",
)
def j16(spark, sf_dir):
    return M.locate_passages(table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "passage_id"), table(spark, sf_dir, "documents"))


@query("j18_link_candidates", r"""WITH m AS (SELECT p_partkey AS mention_id, list_filter(string_split_regex(lower(p_name), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS mt FROM part),
    k AS (SELECT DISTINCT url, list_filter(string_split_regex(lower(concat(p_name, ' ', url)), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS lt FROM pages JOIN part ON page_id = p_partkey),
    s AS (SELECT mention_id, url, round(greatest(0.0, least(1.0, 0.45 * len(list_intersect(mt, lt)) / len(list_distinct(mt)) + CASE WHEN contains(replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1)), '^www\.', ''), '.', ''), array_to_string(mt, '')) THEN 0.30 ELSE 0 END
      + CASE WHEN ends_with(lower(url), '.pdf') THEN 0.15 ELSE 0 END - CASE WHEN regexp_matches(url, '(?i)[/?](search|s)\b') THEN 0.30 ELSE 0 END + 0.1)), 4) AS score FROM m JOIN k ON len(list_intersect(mt, lt)) > 0),
    o AS (SELECT mention_id, url, max(score) AS score FROM s GROUP BY 1, 2)
    SELECT mention_id, url, score, CAST(row_number() OVER w AS INTEGER) AS rank FROM o WINDOW w AS (PARTITION BY mention_id ORDER BY score DESC, url) QUALIFY row_number() OVER w <= 3""")
def j18(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    mentions = p.select(F.col("p_partkey").alias("mention_id"), F.col("p_name").alias("canonical_name"), F.lit("report").alias("mention_type"))
    links = table(spark, sf_dir, "pages").select("page_id", "url").join(p.select(F.col("p_partkey").alias("page_id"), F.col("p_name").alias("title")), "page_id").select("url", "title")
    return M.link_candidates(mentions, links)


_FORM = r"trim(regexp_replace(lower({t}), '[^\p{{L}}\p{{N}}\p{{M}}]+', ' ', 'g'))"
_RUNS3 = "list_distinct(list_transform(range(greatest(len(w) - 2, 0)), lambda i: array_to_string(w[i + 1 : i + 3], ' ')))"


@query(
    "j17_anchor_blocks",
    f"""{PIECES}, b AS (SELECT doc_id, pos, {_FORM.format(t="piece")} AS bf, {_W.replace("lower(text)", "lower(piece)")} AS w FROM r WHERE piece <> ''),
    p AS (SELECT doc_id, {_W.replace("lower(text)", "lower(substr(text, length(text) // 2 + 1, 300))")} AS w FROM documents WHERE text IS NOT NULL), ph AS (SELECT doc_id, array_to_string(w[1:8], ' ') AS head, {_RUNS3} AS runs FROM p), bh AS (SELECT doc_id, pos, bf, {_RUNS3} AS runs FROM b),
    s AS (SELECT doc_id, pos, contains(bf, head) AS has, len(list_intersect(ph.runs, bh.runs)) AS n FROM ph JOIN bh USING (doc_id))
    SELECT doc_id AS passage_id, doc_id, pos FROM s WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY has DESC, n DESC, pos) = 1""",
)
def j17(spark, sf_dir):
    from ..operators.sinks import text_pieces

    # From the middle of each text on.
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    passages = d.select(F.col("doc_id").alias("passage_id"), "doc_id", F.col("text").substr(F.floor(F.length("text") / 2).cast("int") + 1, F.lit(300)).alias("text"))
    return M.anchor_blocks(passages, text_pieces(d, "doc_id", "text"))


@query("j19_j20_promoted_links")
def j20(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    mentions = p.select(k.alias("mention_id"), (k % 50).alias("entity_id"), F.col("p_name").alias("canonical_name"), F.lit("report").alias("mention_type"), F.when(k % 30 == 0, F.lit("https://kept.example/x")).alias("source_url"), F.lit("missing").alias("link_status"), F.lit(None).cast("double").alias("link_confidence"))
    links = table(spark, sf_dir, "pages").select("page_id", "url").join(p.select(k.alias("page_id"), F.col("p_name").alias("title")), "page_id").select("url", "title")
    best = M.link_candidates(mentions, links).join(mentions.select("mention_id", "canonical_name"), "mention_id").join(links, "url")
    entities = mentions.select(F.col("entity_id").alias("id")).distinct().withColumn("primary_url", F.lit(None).cast("string"))
    return M.promote_links(mentions, entities, M.safe_links(best, 0.4))[0].select("mention_id", "source_url", "link_status", "link_confidence")
