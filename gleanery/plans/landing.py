"""Source-shaped and sink-shaped queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sinks as K
from ..operators.mentions import link_status, source_label
from ..sources import readers as S
from .base import EPISODES, MENTIONS, query, scratch, table, view


@query("s02_epoch_dates", "SELECT event_id, CAST(to_timestamp(event_id * 4321) AT TIME ZONE 'UTC' AS DATE) AS d FROM events")
def s02(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.epoch_date(F.col("event_id") * 4321).alias("d"))


@query("s03_paragraphs", "SELECT conv_id, string_agg(trim(text), chr(10) || chr(10) ORDER BY turn, trim(text)) AS transcript FROM conversations WHERE trim(text) <> '' GROUP BY 1")
def s03(spark, sf_dir):
    return S.join_paragraphs(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@query("s10_subtitle_text", r"""WITH l AS (SELECT conv_id, turn, unnest(list_transform(string_split_regex(text, '\r?\n'), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')))) AS x, unnest(range(len(string_split_regex(text, '\r?\n')))) AS k FROM conversations)
    SELECT c.conv_id, c.turn, CASE WHEN c.text IS NOT NULL THEN coalesce(string_agg(x, ' ' ORDER BY k), '') END AS text FROM conversations c LEFT JOIN l ON l.conv_id = c.conv_id AND l.turn = c.turn AND x <> '' AND NOT regexp_matches(x, '^\d+$') AND NOT contains(x, '-->') AND NOT regexp_matches(x, '^(WEBVTT|NOTE|Kind:|Language:)') GROUP BY c.conv_id, c.turn, c.text""")
def s10(spark, sf_dir):
    from ..functions.text import subtitle_text

    cue = F.concat(F.lit("WEBVTT\n\n1\n00:00:01.000 --> 00:00:02.000\n<v A>"), F.col("text"), F.lit("\n"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", subtitle_text(cue).alias("text"))


@query("s11_best_text", f"WITH e AS ({EPISODES}) SELECT id, CASE WHEN length(transcript) > 500 THEN transcript WHEN id % 3 = 0 THEN 'generated' ELSE notes END AS text, CASE WHEN length(transcript) > 500 THEN 'official' WHEN id % 3 = 0 THEN 'generated' ELSE 'notes' END AS source FROM e")
def s11(spark, sf_dir):
    text, source = S.best_text(F.col("transcript"), F.when(F.col("id") % 3 == 0, "generated"), F.col("notes"))
    return view(spark, sf_dir, EPISODES).select("id", text.alias("text"), source.alias("source"))


@query(
    "k02_upsert",
    """WITH o AS (SELECT o_orderkey, o_totalprice AS price, o_clerk AS note FROM (SELECT *, concat('c', o_custkey) AS o_clerk FROM orders) WHERE o_orderkey % 3 <> 0), n AS (SELECT o_orderkey, o_totalprice * 2 AS price, CASE WHEN o_orderkey % 2 = 0 THEN 'new' END AS note FROM orders WHERE o_orderkey % 4 = 0)
    SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN n.o_orderkey IS NOT NULL THEN n.price ELSE o.price END AS price, CASE WHEN n.o_orderkey IS NOT NULL THEN coalesce(n.note, o.note) ELSE o.note END AS note, o.o_orderkey IS NULL AS created FROM o FULL JOIN n ON n.o_orderkey = o.o_orderkey""",
)
def k02(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    old = o.where(k % 3 != 0).select("o_orderkey", F.col("o_totalprice").alias("price"), F.concat(F.lit("c"), "o_custkey").alias("note"))
    new = o.where(k % 4 == 0).select("o_orderkey", (F.col("o_totalprice") * 2).alias("price"), F.when(k % 2 == 0, "new").alias("note"))
    path = scratch(spark, "k02")
    K.write_buckets(old, path, "o_orderkey")
    K.upsert_buckets(new, path, "o_orderkey", F.col("price"), ["note"])
    return spark.read.schema("o_orderkey long, price double, note string, created boolean").parquet(path).select("o_orderkey", "price", "note", F.coalesce("created", F.lit(False)).alias("created"))


@query("k04_sync_state", f"WITH m AS ({MENTIONS}), w AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY publish_date DESC, mention_id DESC) AS rn FROM m) SELECT entity_id, mention_type AS state, source_url AS page_id FROM w WHERE rn = 1")
def k04(spark, sf_dir):
    e = view(spark, sf_dir, MENTIONS).select("entity_id", F.col("publish_date").alias("at"), F.col("mention_id").alias("event_id"), F.col("mention_type").alias("state"), F.col("source_url").alias("page_id"), F.col("props").alias("error"))
    return K.sync_state(e, "entity_id").select("entity_id", "state", "page_id")


PIECES = r"""WITH RECURSIVE r AS (SELECT doc_id, text AS t, -1 AS pos, CAST(NULL AS VARCHAR) AS piece FROM documents WHERE regexp_matches(text, '\S')
    UNION ALL SELECT doc_id, CASE WHEN length(t) > 1900 THEN CASE WHEN cut >= 1 THEN substr(t, cut + 2) ELSE substr(t, 1901) END END, pos + 1, CASE WHEN length(t) <= 1900 THEN t WHEN cut >= 1 THEN left(t, cut) ELSE left(t, 1900) END
      FROM (SELECT *, 1899 - length(regexp_extract(left(t, 1900), '[^ \n\t]*$')) AS cut FROM r WHERE t IS NOT NULL))"""


@query(
    "k05_payload",
    f"""{PIECES},
    n AS (SELECT doc_id, count(*) AS n_blocks FROM r WHERE piece <> '' GROUP BY 1)
    SELECT CAST(doc_id AS VARCHAR) AS key, left(text, 2000) AS body, lang, coalesce(n_blocks, 0) AS n_blocks, CAST(greatest(1, ceil(coalesce(n_blocks, 0) / 100)) AS BIGINT) AS n_requests, 'synced' AS state FROM documents LEFT JOIN n USING (doc_id)""",
)
def k05(spark, sf_dir):
    """Pages are sent through the sink; what arrived is read back with the state that the sync events give."""
    from ..operators.page_sink import push_pages

    d, root = table(spark, sf_dir, "documents"), scratch(spark, "k05")
    p = K.page_payload(d, "doc_id", {"body": F.col("text"), "lang": F.col("lang"), "none": F.lit(None).cast("string")})
    blocks = K.text_pieces(d, "doc_id", "text").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("b"))
    push_pages(p.join(blocks, "doc_id", "left"), F.col("doc_id"), F.col("payload"), F.col("b.piece"), root, "2024-01-01T00:00:00Z")
    came = spark.read.schema("key string, page_id string, request int, payload string, blocks array<string>").json(f"{root}/requests")
    pages = came.groupBy("key").agg(F.max(F.from_json("payload", "body string, lang string")).alias("p"), F.sum(F.size("blocks")).alias("n_blocks"), F.count("*").alias("n_requests"))
    events = spark.read.schema("key string, at string, state string, page_id string, error string").json(f"{root}/events").withColumn("event_id", F.col("page_id"))
    return pages.join(K.sync_state(events, "key"), "key").select("key", F.col("p.body").alias("body"), F.col("p.lang").alias("lang"), "n_blocks", "n_requests", "state")


@query("k06_text_pieces", f"""{PIECES}
    SELECT doc_id, pos, piece, CAST(floor(pos / 100) AS INTEGER) AS request FROM r WHERE piece <> ''""")
def k06(spark, sf_dir):
    return K.text_pieces(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("k08_fill_missing", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_name END, CASE WHEN c_custkey % 2 = 0 THEN concat('fixed ', c_custkey) END) AS c_name, CAST(CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_changed FROM customer")
def k08(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer")
    rows = c.select("c_custkey", F.when(k % 3 != 0, F.col("c_name")).alias("c_name"))
    fixed = c.where(k % 2 == 0).select("c_custkey", F.concat(F.lit("fixed "), k).alias("c_name"))
    return K.fill_missing(rows, fixed, "c_custkey", ["c_name"]).select("c_custkey", "c_name", F.size("changed").alias("n_changed"))


@query("n20_link_status", f"WITH m AS ({MENTIONS}) SELECT mention_id, CASE WHEN source_url IS NOT NULL THEN 'manual_verified' ELSE 'missing' END AS status, CASE WHEN source_url IS NOT NULL THEN CAST(1.0 AS DOUBLE) END AS confidence FROM m")
def n20(spark, sf_dir):
    status, confidence = link_status(F.col("source_url"))
    return view(spark, sf_dir, MENTIONS).select("mention_id", status.alias("status"), confidence.alias("confidence"))


@query("n32_source_label", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN concat('Source ', event_type) WHEN event_id % 3 = 0 THEN 'Override' ELSE event_type END AS label FROM events")
def n32(spark, sf_dir):
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"source_name": "Source, '), "event_type", F.lit('"}')))
    return table(spark, sf_dir, "events").select("event_id", source_label(raw, F.when(F.col("event_id") % 3 == 0, "Override"), F.col("event_type")).alias("label"))
