"""Rules pinned by example, on small frames."""

from __future__ import annotations

import datetime as dt
import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from gleanery.functions import text as T
from gleanery.functions import urls as U


def one(spark, expression, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(expression.alias("x")).first().x


def each(spark, f, values):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string").select("k", f(F.col("v")).alias("x"))
    return [r.x for r in rows.orderBy("k").collect()]


def test_names(spark):
    assert each(spark, T.entity_key, ["  GPT-4.1 / Mini!!  ", "open_ai", None, ""]) == ["gpt 41 mini", "open ai", None, ""]
    assert each(spark, T.alias_key, ["GPT-4.1"]) == ["gpt 4 1"]
    assert each(spark, T.compact_key, ["Open AI", "open-ai", "OpenAI"]) == ["openai"] * 3
    assert each(spark, T.match_form, ["Hello,   World! It's——fine."]) == ["hello world it s fine"]
    assert each(spark, T.collapse_blanks, ["a \n b"]) == ["a b"]


def test_html(spark):
    assert each(spark, T.html_to_text, ["<p>Steve &amp; Dana on <i>Backrooms</i>.</p>", "<script>x < 1</script>a<br>b", None]) == ["Steve & Dana on Backrooms.", "a b", None]


def test_subtitles(spark):
    vtt = "WEBVTT\nKind: captions\n\n1\n00:00:01.000 --> 00:00:02.000\n<v A>Hello   there\n\n2\n00:00:02.000 --> 00:00:03.000\nfriend"
    assert each(spark, T.subtitle_text, [vtt]) == ["Hello there friend"]


def test_canonical_urls(spark):
    same = ["http://openai.com/index/abc/", "http://openai.com/index/abc?utm_source=newsletter", "https://OPENAI.com/index/abc#section", "https://www.openai.com/index/abc"]
    assert set(each(spark, U.canonical_url, same)) == {"https://openai.com/index/abc"}
    assert each(spark, U.canonical_url, ["https://example.com/post?id=42&utm_medium=email"]) == ["https://example.com/post?id=42"]


def test_posts(spark):
    urls = ["https://a.com/news/claude-fable-5", "https://a.com/index/abc", "https://a.com/ai-and-jobs-the-final-word", "https://a.com", "https://a.com/news"]
    assert each(spark, U.is_post, urls) == [True, True, True, False, False]


def test_publish_dates(spark):
    d = lambda meta, url: one(spark, U.publish_date(F.col("u"), F.col("m")), u=url, m=meta)
    assert d("2026-05-26T10:00:00Z", "https://a.com/x") == dt.date(2026, 5, 26)
    assert d("yesterday", "https://a.com/x") is None
    assert d("yesterday", "https://a.com/2026/05/26/x") == dt.date(2026, 5, 26)
    assert d("yesterday", "https://a.com/2026/99/99/x") is None
    assert d("2026-01-02", "https://a.com/2026/05/26/x") == dt.date(2026, 1, 2)


def test_titles_and_platforms(spark):
    assert one(spark, U.pick_title(F.col("u"), F.col("a")), u="https://a.com", a="A reality check | MIT Technology Review") == "A reality check"
    assert each(spark, U.platform, ["https://x.com/@Foo/1", "https://blog.github.com/a", "https://example.org"]) == ["x", "github", None]
    assert each(spark, U.handle, ["https://x.com/@Foo/1", "https://example.org/a"]) == ["foo", None]
    page = '<meta content="T1" property="og:title"><meta name="date" content="2024-01-02">'
    assert each(spark, lambda c: U.meta_content(c, "og:title"), [page]) == ["T1"] and each(spark, lambda c: U.meta_content(c, "date"), [page]) == ["2024-01-02"]


def mention(**x):
    base = {"canonical_name": "A", "mention_text": "a", "context_snippet": "c", "mention_type": "model", "sentiment_label": "positive", "confidence": "0.9"}
    return tuple({**base, **x}.values())


MENTION = "canonical_name string, mention_text string, context_snippet string, mention_type string, sentiment_label string, confidence string"


def test_sanitize_mentions(spark):
    from gleanery.operators.mentions import sanitize_mentions

    rows = [mention(confidence="1.5"), mention(confidence="-0.2"), mention(confidence="nope"), mention(mention_type="dragon"), mention(mention_type="dragon", confidence="0.05"), mention(canonical_name=" "), mention(context_snippet=None), mention(sentiment_label="odd")]
    got = [(r.mention_type, r.confidence, r.needs_review, r.review_reason, r.sentiment_label) for r in sanitize_mentions(spark.createDataFrame(rows, MENTION), ["model"]).collect()]
    odd = "model_proposed_unknown_type"
    assert got == [("model", 1.0, False, None, "positive"), ("model", 0.0, True, "low_confidence", "positive"), ("model", 0.5, True, "low_confidence", "positive"), ("other", 0.9, True, odd, "positive"), ("other", 0.05, True, odd, "positive"), ("model", 0.9, False, None, "unknown")]


def test_retype_rules_run_in_order(spark):
    from gleanery.operators.mentions import retype_mentions, sanitize_mentions, tech_rules

    rows = [
        mention(mention_type="other", context_snippet="a big survey of fans"),
        mention(mention_type="report", canonical_name="Evening Journal"),
        mention(mention_type="report", canonical_name="Evening Journal", context_snippet="their survey"),
        mention(mention_type="survey", canonical_name="Fans", context_snippet="a poll"),
        mention(mention_type="survey", canonical_name="Reuters"),
        mention(mention_type="person", context_snippet="she posted it"),
        mention(mention_type="book"),
        mention(mention_type="other", context_snippet="nothing"),
    ]
    types = ["report", "book", "organization", "survey", "account", "person"]
    m = sanitize_mentions(spark.createDataFrame(rows, MENTION), types)
    got = [(r.mention_type, r.canonical_name, r.review_reason) for r in retype_mentions(m, tech_rules(), types).collect()]
    name = got[0][1]
    assert got == [("survey", name, "survey_retyped_from_context"), ("organization", "Evening Journal", "media_outlet_not_report"), ("survey", "Evening Journal", "media_outlet_not_report"), ("survey", "Fans poll", "survey_suffix_added"), ("organization", "Reuters", "media_outlet_not_survey"), ("account", name, "posting_context_retyped_to_account"), ("book", name, None), ("other", name, "other_type_needs_review")]
    assert [r.mention_type for r in retype_mentions(m, []).collect()] == ["other", "report", "report", "survey", "survey", "person", "book", "other"]


def test_web_search_strings():
    from gleanery.operators.search import web_terms

    none = {"every": [], "some": [], "none": [], "phrases": []}
    assert web_terms('a "b c" d OR e OR f -g -"h i" "j"') == {"every": ["a", "j"], "some": [["d", "e", "f"]], "none": ["g", "h", "i"], "phrases": [["b", "c"]]}
    assert web_terms("x-y Z") == {**none, "phrases": [["x", "y"]], "every": ["z"]} and web_terms("OR a OR") == {**none, "every": ["a"]} and web_terms("") == none


def test_upsert_rewrites_touched_folders_alone(spark, tmp_path):
    import os

    from gleanery.operators import sinks as K

    path, made = str(tmp_path / "t"), "id long, note string, n int"
    K.write_buckets(spark.createDataFrame([(k, f"a{k}", k) for k in range(200)] + [(None, "x", 1)], made), path, "id", 16)
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}
    before = files()
    new = spark.createDataFrame([(3, None, 9), (3, "b", 50), (500, "new", 1), (None, "y", 2)], made)
    touched = {r.b for r in new.where("id is not null").select(F.pmod(F.xxhash64("id"), F.lit(16)).alias("b")).collect()}
    wanted = sorted([(k, f"a{k}", k) for k in range(200) if k != 3] + [(3, "a3", 9), (500, "new", 1)])
    for _ in range(2):
        K.upsert_buckets(new, path, "id", F.col("n"), ["note"], 16)
        assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "note", "n").collect()) == wanted
    gone = {int(f.split("bucket=")[1].split("/")[0]) for f in before - files()}
    assert gone == touched and len(touched) < 16
    K.upsert_buckets(new.limit(0), path, "id", F.col("n"), ["note"], 16)
    # An upsert that fails leaves the table as it was.
    with pytest.raises(Exception, match="bad row"):
        K.upsert_buckets(new.withColumn("n", F.raise_error(F.lit("bad row")).cast("int")), path, "id", F.lit(1), ["note"], 16)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "note", "n").collect()) == wanted


def test_page_sink_publishes_at_commit(spark, tmp_path):
    import glob
    import json

    from gleanery.operators import sinks as K
    from gleanery.operators.page_sink import FolderService, PageWriter, push_pages

    rows = spark.createDataFrame([(1, "p", [f"b{k}" for k in range(250)]), (2, "q", []), (3, None, ["x"]), (None, "r", ["x"]), (4, "s", None)], "id long, payload string, blocks array<string>").repartition(3)
    path = str(tmp_path / "service")
    for _ in range(2):  # a page that is sent again is the same page
        push_pages(rows, F.col("id"), F.col("payload"), F.col("blocks"), path, "2024-05-01")
    sent = [json.loads(x) for f in glob.glob(f"{path}/requests/*.json") for x in open(f)]
    assert sorted((x["key"], x["request"], len(x["blocks"])) for x in sent) == sorted(2 * [("1", 0, 100), ("1", 1, 100), ("1", 2, 50), ("2", 0, 0), ("4", 0, 0)]) and len({x["page_id"] for x in sent}) == 3
    events = spark.read.schema("key string, at string, state string, page_id string, error string").json(f"{path}/events").withColumn("event_id", F.col("page_id"))
    assert {(r.key, r.state, r.error) for r in K.sync_state(events, "key").collect()} == {("1", "synced", None), ("2", "synced", None), ("4", "synced", None), ("3", "failed", "no payload"), (None, "failed", "no key")}
    # A job that fails publishes nothing, nor does a task whose message never came.
    other = str(tmp_path / "other")
    bad = rows.withColumn("payload", F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("payload")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        push_pages(bad, F.col("id"), F.col("payload"), F.col("blocks"), other, "2024-05-01")
    assert not glob.glob(f"{other}/requests/*") and not glob.glob(f"{other}/events/*")
    writer = PageWriter({"path": other, "perrequest": "2"})
    two = [writer.write(iter(rows.where("id < 3").selectExpr("string(id) as key", "payload", "blocks").collect())) for _ in range(2)]
    writer.abort([two[0], None])
    writer.commit([two[1]])
    assert two[1].requests == 126 and len(glob.glob(f"{other}/requests/*")) == 1 and not glob.glob(f"{other}/_staged/requests/{two[0].name}*")
    with pytest.raises(ValueError, match="mounted"):
        FolderService("s3://bucket/x")


def test_children_of_merged_rows_are_repointed(spark):
    from gleanery.operators.dedup import repoint

    children = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "a")], "ref long, t string")
    moved = repoint(children, "ref", spark.createDataFrame([(1, 1), (2, 1)], "id long, survivor long"), "id", ["t"])
    assert sorted((r.ref, r.t) for r in moved.collect()) == [(1, "a"), (1, "b"), (3, "a")]


def test_parse_and_profile(spark):
    from gleanery.operators.mentions import keep_for_profile, new_type_candidates, parse_responses

    schema = "mentions array<struct<canonical_name:string,mention_type:string,is_editorial:boolean>>, new_type_candidates array<string>"
    good = '```json\n{"mentions": [{"canonical_name": "A", "mention_type": "model", "is_editorial": true}, {"canonical_name": "B", "mention_type": "person", "is_editorial": true}, {"canonical_name": "C", "mention_type": "model", "is_editorial": false}]}\n```'
    df = spark.createDataFrame([(1, good), (2, "{}"), (3, "broken"), (4, '{"mentions": 5}')], "episode_id long, response string")
    m = parse_responses(df, schema)
    assert [(r.episode_id, r.canonical_name) for r in m.collect()] == [(1, "A"), (1, "B"), (1, "C")]
    assert [r.canonical_name for r in keep_for_profile(m, ["model"]).collect()] == ["A"]
    assert keep_for_profile(m, ["model"], False, False).count() == 3
    types = spark.createDataFrame([("model",)], "type string")
    assert [tuple(r) for r in new_type_candidates(spark.createDataFrame([(["model", "Robot "],), (["robot"],)], "proposed_type array<string>"), types).collect()] == [("robot", 2)]


def test_unreadable_answers_are_kept_with_a_reason(spark):
    from gleanery.operators.mentions import RESPONSE, parse_responses, rejected_responses, response_shape

    good = '{"mentions": [{"canonical_name": "X", "confidence": "0.9"}]}'
    rows = [(1, good), (2, f"```json\n{good}\n```"), (3, '{"mentions": []}'), (4, good[:20]), (5, None), (6, "``` ```"), (7, "sorry"), (8, "[1]"), (9, '{"mentions": null}'), (10, '{"notes": []}'), (11, '{"mentions": {"a": 1}}'), (12, "7")]
    df = spark.createDataFrame(rows, "id int, response string")
    assert {r.id: r.reason for r in rejected_responses(df).collect()} == {4: "not_json", 5: "empty", 6: "empty", 7: "not_json", 8: "not_an_object", 9: "no_mentions", 10: "no_mentions", 11: "mentions_not_a_list", 12: "not_an_object"}
    assert sorted(r.id for r in parse_responses(df, RESPONSE).collect()) == [1, 2]
    assert "mentions" in response_shape(df.where("id < 4")).first().shape and rejected_responses(df.limit(0)).count() == 0


def test_alias_merge_keeps_first_spelling(spark):
    from gleanery.operators.dedup import merge_aliases

    rows = spark.createDataFrame([(1, k, a) for k, a in enumerate(["OpenAI", " open-ai ", "Open AI", "", "ChatGPT"])], "e int, p int, a string")
    assert merge_aliases(rows, "e", F.col("p"), "a").first().aliases == ["OpenAI", " open-ai ", "ChatGPT"]


def test_provenance(spark):
    from gleanery.operators.joins import provenance

    e = spark.createDataFrame([(1,), (2,), (3,), (4,)], "episode_id long")
    rec = spark.createDataFrame([(1, None), (2, 2384)], "episode_id long, transcript_id long")
    look = spark.createDataFrame([(1, 2385), (3, 42)], "episode_id long, transcript_id long")
    assert sorted((r.episode_id, r.transcript_id, r.inferred) for r in provenance(e, rec, look).collect()) == [(1, None, False), (2, 2384, False), (3, 42, True), (4, None, False)]


def test_budget_takes_whole_groups(spark):
    from gleanery.operators.changes import within_budget

    groups = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "g string, n long")
    assert [r.g for r in within_budget(groups, "g", "n", 3).collect()] == ["a"]
    assert [r.g for r in within_budget(spark.createDataFrame([("a", 5)], "g string, n long"), "g", "n", 3).collect()] == ["a"]


def test_text_pieces(spark):
    from gleanery.operators.sinks import pieces_of, text_pieces

    assert pieces_of("hello world", 1900) == ["hello world"] and pieces_of("  ", 1900) == [] and pieces_of("", 1900) == []
    long = "word " * 5000
    assert all(len(p) <= 1900 for p in pieces_of(long, 1900)) and " ".join(pieces_of(long, 1900)).split() == long.split()
    assert all(p.endswith("alpha") for p in pieces_of("alpha " * 400, 1900)[:-1])
    assert "".join(pieces_of("x" * 2400, 1900)) == "x" * 2400
    df = spark.createDataFrame([(1, "a " * 150_000), (2, None)], "id int, t string")
    got = text_pieces(df, "id", "t").toPandas()
    assert set(got.request) == {0, 1} and set(got.id) == {1}


def test_text_pieces_are_cut_without_python(spark):
    from gleanery.operators.sinks import pieces_of, text_pieces

    rng = random.Random(7)
    texts = ["".join(rng.choices("ab \n\t\r\u00a0é😀", [9, 4, 2, 1, 1, 1, 1, 2, 2], k=rng.randrange(0, 60))) for _ in range(400)]
    texts += [c * n for c in ("x", " ", "\n", "\u2003", "\x1c", "\x0b", "😀", "x ", " x") for n in (1, 2, 6, 7, 8, 13, 14, 15, 21)]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "id int, t string")
    for most in (1, 2, 7, 20):
        out = text_pieces(df, "id", "t", most, 2)
        assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())
        want = {(k, n, p, n // 2) for k, t in enumerate(texts) for n, p in enumerate(pieces_of(t, most))}
        assert {(r.id, r.pos, r.piece, r.request) for r in out.collect()} == want


def test_page_sink_holds_few_rows_of_a_batch_at_a_time(tmp_path, monkeypatch):
    import pyarrow as pa
    from pyspark.sql.datasource import DataSourceArrowWriter
    from pyspark.sql.types import StructType

    from gleanery.operators import page_sink as P

    writer = P.PageSink({"path": str(tmp_path)}).writer(StructType().add("key", "string").add("payload", "string").add("blocks", "string"), False)
    assert isinstance(writer, DataSourceArrowWriter)
    batch = pa.RecordBatch.from_arrays([pa.array([str(k) for k in range(150)]), pa.array(["p"] * 149 + [None]), pa.array([["b"] * (k % 3) for k in range(150)])], ["key", "payload", "blocks"])
    taken = []

    class Batch:
        num_rows = batch.num_rows

        def slice(self, first, n):
            taken.append(n)
            return batch.slice(first, n)

    sent = writer.write(iter([Batch(), Batch()]))
    assert (sent.pages, sent.requests, sent.blocks) == (298, 298, 296) and taken == 2 * [64, 64, 64]


def test_scores(spark):
    from gleanery.operators.evaluation import breaches, collapse_mentions, precision_recall

    m = spark.createDataFrame([(1, 0, "ChatGPT", "model", 0.7), (1, 1, "chatgpt", "model", 0.95), (1, 2, "Gemini", "organization", 0.6), (1, 3, "Gemini", "model", 0.92), (1, 4, " ", "model", 0.5)], "episode_id long, pos long, canonical_name string, entity_type string, confidence double")
    assert sorted(tuple(r) for r in collapse_mentions(m).collect()) == [(1, "chatgpt", "model", 0.95, 2), (1, "gemini", "model", 0.92, 2)]
    p = spark.createDataFrame([(1, k, "x") for k in "abc"] + [(2, "a", "y"), (3, "a", "x")], "e int, k string, t string")
    t = spark.createDataFrame([(1, k, "x") for k in "abd"] + [(2, "a", "x"), (4, "a", "x")], "e int, k string, t string")
    got = {r.e: (r.precision, r.recall, r.f1, r.type_accuracy) for r in precision_recall(p, t, "e", "k", "t").collect()}
    assert got == {1: (0.6667, 0.6667, 0.6667, 1.0), 2: (1.0, 1.0, 1.0, 0.0), 3: (0.0, 1.0, 0.0, 1.0), 4: (1.0, 0.0, 0.0, 1.0)}
    r = spark.createDataFrame([(0.5, 0.3, 0.7, 0.9, 0, 1)], "yield_ratio double, max_shift double, gold_recall double, type_accuracy double, failures int, out_of_range int")
    assert breaches(r).first().breaches == ["yield", "shift", "confidence"]


def test_fuzzy_matches(spark):
    from gleanery.operators.matching import _lcs, match_catalog, resolve_titles, safe_links

    assert _lcs("kitten", "sitting") == 4
    w = spark.createDataFrame([(1, "s", "The Big Episode"), (2, "s", "A completely other thing"), (3, "s", "the big episode one")], "wanted_id long, source string, title string")
    e = spark.createDataFrame([(10, "s", "the big episode"), (11, "t", "The Big Episode"), (12, "s", "The big episode on e")], "episode_id long, source string, title string")
    got = {r.wanted_id: r.episode_id for r in resolve_titles(w, e).collect()}
    assert got == {1: 10, 3: 12}
    songs = spark.createDataFrame([(1, "Yellow Moon", "Band"), (2, "Nothing", "None")], "song_id long, title string, artist string")
    cat = spark.createDataFrame([(5, "Yellow Moon (Live)", ["Band"]), (6, "Yellow Moon", ["Other", "band"])], "catalog_id long, title string, artists array<string>")
    got = {r.song_id: (r.catalog_id, r.band) for r in match_catalog(songs, cat).collect()}
    assert got == {1: (6, "HIGH"), 2: (None, "NOT_FOUND")}
    c = spark.createDataFrame([(1, "MIT", "https://a.edu", "Massachusetts Institute Technology", 0.8, 1), (2, "Foo Bar", "https://foo.com/bar", "x", 0.9, 1)], "mention_id long, canonical_name string, url string, title string, score double, rank int")
    assert [r.mention_id for r in safe_links(c).collect()] == [1]


def test_batches_are_replaced_whole(spark, tmp_path):
    from gleanery.operators import sinks as K

    path = str(tmp_path / "b")
    K.replace_batches(spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 3)], "show int, batch string, v int"), path, ["show", "batch"])
    K.replace_batches(spark.createDataFrame([(1, "x", 9)], "show int, batch string, v int"), path, ["show", "batch"])
    assert sorted((r.show, r.batch, r.v) for r in spark.read.parquet(path).collect()) == [(1, "x", 9), (1, "y", 2), (2, "x", 3)]


def test_missing_text_counts_as_none(spark):
    assert each(spark, T.word_count, [None, "", "a b"]) == [0, 0, 2]


@pytest.mark.parametrize("days,status", [(0, "pass"), (1, "warn"), (45, "fail")])
def test_late_sources(spark, days, status):
    from gleanery.operators.checks import as_check, late_source_queue

    as_of = dt.date(2026, 6, 1)
    rows = spark.createDataFrame([(1, True, as_of - dt.timedelta(days=days) if days else None)], "id int, notes boolean, arrived date")
    queue = late_source_queue(rows, "id", F.col("notes"), "arrived", as_of)
    got = [r.status for r in queue.collect()]
    assert (got or ["pass"]) == [status] and as_check(queue, "x", F.col("id").cast("string")).count() == 1


def test_page_dates(spark):
    pages = ['<meta content="2024-01-02T03:04:05Z" property="article:published_time">', '<script type="application/ld+json">{"datePublished": "2024-02-03"}</script>', '<time datetime="2024-03-04">x</time>', "<p>2024-05-06</p>"]
    assert each(spark, U.page_date, pages) == [dt.date(2024, 1, 2), dt.date(2024, 2, 3), dt.date(2024, 3, 4), None]


def test_frequent_words_lose_no_candidate(spark):
    """Titles that share only words of many titles: the equal one, the nearest one and a one-word name are found."""
    from gleanery.operators import matching as M

    songs = spark.createDataFrame([(1, "Intro", "Low"), (2, "The One", "Low")], "song_id long, title string, artist string")
    catalog = spark.createDataFrame([(k, f"Intro {k}", ["x"]) for k in range(40)] + [(90, "intro", ["Low"]), (91, "One Other The", ["Low"])], "catalog_id long, title string, artists array<string>")
    got = {r.song_id: (r.catalog_id, r.band) for r in M.match_catalog(songs, catalog, block=4).collect()}
    assert got[1] == (90, "HIGH") and got[2][0] == 91
    wanted = spark.createDataFrame([(1, "s", "the intro of a"), (2, "s", "intro")], "wanted_id long, source string, title string")
    episodes = spark.createDataFrame([(k, "s", f"intro {k} and much more text") for k in range(40)] + [(90, "s", "the intro of b"), (91, "s", "INTRO")], "episode_id long, source string, title string")
    for most in (0, 1000):
        assert {r.wanted_id: r.episode_id for r in M.resolve_titles(wanted, episodes, most_common=most).collect()} == {1: 90, 2: 91}
    names = spark.createDataFrame([(1, "intro", "report")], "mention_id long, canonical_name string, mention_type string")
    links = spark.createDataFrame([(f"https://s{k}.example/x", "intro page") for k in range(30)] + [("https://intro.example/", "intro")], "url string, title string")
    assert M.link_candidates(names, links, block=4).where("rank = 1").first().url == "https://intro.example/"


@pytest.mark.parametrize("titles", [900, 1100])
def test_best_title_over_a_frequent_word(spark, titles):
    """A song that shares a rare word with one odd title still finds the title that it shares a very frequent word with."""
    from gleanery.operators.matching import match_catalog

    songs = spark.createDataFrame([(1, "intro zeta", "ann")], "song_id long, title string, artist string")
    rows = [(5, "intro zetas", ["ann"]), (6, "zeta of something else altogether", ["bob"])] + [(100 + k, f"intro a{k}", ["x"]) for k in range(titles)]
    found = match_catalog(songs, spark.createDataFrame(rows, "catalog_id long, title string, artists array<string>")).first()
    assert (found.catalog_id, found.score, found.band) == (5, 0.972, "HIGH")


def test_matches_equal_all_pairs_over_skewed_words(spark):
    from gleanery.operators import matching as M

    rng = random.Random(6)
    often, rare = ["the", "love", "of"], [f"w{k}" for k in range(60)]
    title = lambda: " ".join(rng.choice(often if rng.random() < 0.7 else rare) for _ in range(rng.randrange(0, 5))) + rng.choice(["", "", "s", "!"])
    who = lambda: rng.choice(["ann", "Bo", "ann lee", None, "", "zoë " * 80])
    songs = [(k, title(), who()) for k in range(160)] + [(900, None, "ann"), (901, "love", "ann"), (902, "love " * 70, "Bo")]
    catalog = [(k, title(), rng.choice([None, [], [who()], [who(), who()]])) for k in range(400)] + [(1000, "love", ["ann"]), (1001, "love", ["ann"]), (1002, None, ["x"])]
    s = spark.createDataFrame(songs, "song_id long, title string, artist string").select("*", T.match_form(F.col("title")).alias("a"), T.match_form(F.col("artist")).alias("r"))
    c = spark.createDataFrame(catalog, "catalog_id long, title string, artists array<string>").select("*", T.match_form(F.col("title")).alias("b"))
    cut = lambda x: {w for w in re.split(r"[\W_]+", (x or "").lower()) if w}
    forms = {r.catalog_id: [None if x is None else re.sub(r"[\W_]+", " ", x.lower()).strip() for x in (r.artists or [])] for r in c.collect()}
    rows, wanted = c.collect(), {}

    def ratio(x, y):
        n = len(x or "") + len(y or "")
        return round(100 * 2 * M._lcs(x, y) / n) / 100 if x and y else 0.0

    for x in s.collect():
        best = [(M._half_up(0.55 * ratio(x.a, y.b) + 0.45 * max((ratio(x.r, z) for z in forms[y.catalog_id]), default=0.0), 3), -y.catalog_id) for y in rows if x.a is not None and y.b is not None and (cut(x.a) & cut(y.b) or x.a == y.b)]
        wanted[x.song_id] = max(best) if best else (None, None)
    for block in (16, 1024):
        got = {r.song_id: (r.score, None if r.catalog_id is None else -r.catalog_id) for r in M.match_catalog(s.select("song_id", "title", "artist"), c.drop("b"), block=block).collect()}
        assert got == wanted

    links = spark.createDataFrame([(f"https://{rng.choice(['thelove', 'w3', 'site'])}.com/{k % 90}{rng.choice(['', '.pdf', '/search'])}", title()) for k in range(300)], "url string, title string")
    names = [(k, title(), rng.choice(["report", "tool", None])) for k in range(120)]
    names_frame = spark.createDataFrame(names, "mention_id long, canonical_name string, mention_type string")
    plain = {}
    for m, name, kind in names:
        mt, score = [w for w in re.split(r"[\W_]+", name.lower()) if w], {}
        for r in links.collect():
            lt = cut(f"{r.title} {r.url}")
            if set(mt) & lt:
                host = re.match(r"https://([^/]*)", r.url)[1].replace(".", "")
                v = 0.45 * (len(set(mt) & lt) / len(set(mt))) + (0.3 if "".join(mt) in host else 0.0) + (0.15 if kind == "report" and r.url.endswith(".pdf") else 0.0) - (0.3 if re.search(r"[/?](search|s)\b", r.url) else 0.0) + 0.1
                score[r.url] = max(score.get(r.url, 0), M._half_up(max(0.0, min(1.0, v)), 4))
        for place, (v, u) in enumerate(sorted((-v, u) for u, v in score.items())[:3]):
            plain[m, u] = (-v, place + 1)
    assert {(r.mention_id, r.url): (r.score, r["rank"]) for r in M.link_candidates(names_frame, links, block=32).collect()} == plain


def test_stored_index_equals_a_search_over_plain_postings(spark, tmp_path):
    from gleanery.operators import search as S
    from gleanery.operators import text_index as X

    rng = random.Random(4)
    words = ["the", "love", "of", "zeta", "Ring", "a1", "rare"]
    text = lambda: " ".join(rng.choices(words, [30, 8, 20, 2, 5, 3, 1], k=rng.randrange(0, 60)))
    rows = [(k * 7, text()) for k in range(1500)] + [(20_000, None), (20_001, ""), (None, "the love")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path, later = str(tmp_path / "index"), docs.where("doc_id % 5 = 0")
    X.build_index(docs.where("doc_id % 5 <> 0 or doc_id is null"), "doc_id", "text", path)
    X.build_index(later, "doc_id", "text", path)  # ranges that are there already get further rows
    asks = ["the love", "rare OR zeta", 'love -the "of love"', '"the of the" ring', "nowhere", "-the", ""]

    def check(path, docs):
        n = docs.where("doc_id is not null").count()
        plain = S.postings(docs.where("doc_id is not null"), "doc_id", "text").cache()
        for ask in asks:
            for limit in (None, 7):
                got = [(r.doc_id, round(r.score, 9)) for r in X.search_index(spark, path, **S.web_terms(ask), limit=limit).orderBy(F.desc("score"), "doc_id").collect()]
                wanted = [(r.doc_id, round(r.score, 9)) for r in S.search(plain, n, **S.web_terms(ask), limit=limit).orderBy(F.desc("score"), "doc_id").collect()] if ask and ask != "-the" else []
                if ask != "-the":
                    assert got == wanted, (ask, limit)

    check(path, docs)
    # Replaced, emptied, removed and new documents.
    changed = spark.createDataFrame([(0, "zeta zeta rare"), (7, ""), (14, None), (99_999, "rare love of the ring")], "doc_id long, text string")
    X.refreshed(spark, path, changed, "doc_id", "text", str(tmp_path / "next"))
    check(str(tmp_path / "next"), docs.join(changed.select("doc_id"), "doc_id", "left_anti").unionByName(changed.where("text is not null")))
    # Only the folders of the terms are read, and only rows of these terms.
    plan = X.rows_of(spark, path, ["zeta", "rare"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*bucket", plan) and re.search(r"PushedFilters: \[.*In\(term", plan)
    assert len({f.split("bucket=")[1].split("/")[0] for f in X.rows_of(spark, path, ["zeta"]).inputFiles()}) >= 1
    read = spark.read.parquet(f"{path}/postings").where("term = 'the'")
    assert read.agg(F.max(F.size("entries"))).first()[0] <= X.RANGE and read.count() > 1


def test_words_of_an_index_are_grouped_where_their_text_is(spark, tmp_path, monkeypatch):
    """Only texts are exchanged before words are grouped, and tasks follow the bytes of text; a repeated id is one document."""
    from gleanery.operators import text_index as X

    monkeypatch.setattr(X, "TASK_BYTES", 10_000, raising=False)
    docs = spark.createDataFrame([(k, "the ring of the ring") for k in range(-30, 3000)] + [(7, "ring rare"), (8, None), (None, "rare")], "doc_id long, text string")
    rows = X.index_rows(docs, "doc_id", "text")
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert re.findall(r"Exchange (\w+)\((\w+?)#\w+, (\d+)\)", plan) == [("hashpartitioning", "block", str(3031 * 20 // 10_000 + 1))]
    X.build_index(docs, "doc_id", "text", str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index") + "/postings")
    total = {r.term: (r.docs, r.n, r.most, r.last) for r in stored.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.max("most").alias("most"), F.max("last").alias("last")).collect()}
    assert total == {"the": (3030, 6060, 2, 3), "ring": (3030, 6061, 3, 4), "of": (3030, 3030, 1, 2), "rare": (1, 1, 1, 1)}
    entries = {(r.term, r.block): [(e["at"], e["pos"]) for e in r.entries] for r in stored.collect()}
    assert entries["ring", 0][7] == (7, [0, 1, 4]) and entries["the", -1] == [(k, [0, 3]) for k in range(994, 1024)] and entries["rare", 0] == [(7, [1])]


def test_snippets_exchange_the_texts_of_the_result_alone(spark):
    from gleanery.operators import search as S

    docs = spark.createDataFrame([(k, f"the ring of {k}") for k in range(50)], "doc_id long, text string")
    found = spark.createDataFrame([(3, 1.0), (41, 0.5)], "doc_id long, score double")
    out = S.snippets(found, S.postings(docs, "doc_id", "text"), docs, "doc_id", "text", ["ring"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2 and plan.count("rightHint=(strategy=broadcast)") == 2
    assert {r.doc_id: r.fragments for r in out.collect()} == {3: ["the [ring] of 3"], 41: ["the [ring] of 41"]}


def test_promising_ranges_are_read_first(spark, tmp_path, monkeypatch):
    """Ranges that can't reach the last of the best rows are left out; the rows are the same."""
    from gleanery.operators import search as S
    from gleanery.operators import text_index as X

    monkeypatch.setattr(X, "PROBE", 1)
    docs = spark.createDataFrame([(k, "ring " * (1 + (k // 1024 == 2) * (k % 50)) + "of") for k in range(5000)] + [(9000, "none")], "doc_id long, text string")
    path = str(tmp_path / "index")
    X.build_index(docs, "doc_id", "text", path)
    got = X.search_index(spark, path, every=["ring", "of"], limit=5)
    assert [r.doc_id for r in got.collect()] == [r.doc_id for r in S.search(S.postings(docs, "doc_id", "text"), 5001, every=["ring", "of"], limit=5).collect()]
    bounds = spark.read.parquet(f"{path}/postings").where("term = 'ring'").select("block", "most")
    assert {r.block: r.most for r in bounds.collect()} == {0: 1, 1: 1, 2: 50, 3: 1, 4: 1}


def test_best_fragments_equal_all_windows():
    from gleanery.operators.search import best_fragments

    rng = random.Random(9)
    for _ in range(300):
        n = rng.randrange(1, 80)
        hits = [(k, rng.choice("abc")) for k in sorted(rng.sample(range(n), rng.randrange(1, min(n, 12) + 1)))]
        width, least = rng.choice([6, 10, 22]), rng.choice([1, 6])
        windows = [(-len({t for p, t in hits if s <= p <= e}), e - s, s) for s, _ in hits for e, _ in hits if 0 <= e - s < width]
        d, size, s = min(windows)
        e = min(n - 1, max(s + size, s + least - 1))
        first = (max(0, min(s, e - least + 1)), e)
        assert best_fragments(hits, n, 1, least, width) == [first]
        two = best_fragments(hits, n, 2, least, width)
        assert len(two) <= 2 and any(a <= first[0] and first[1] <= b for a, b in two) and (len(two) == 1 or two[1][0] > two[0][1] + 1)
        if len(two) == 1 and two[0] == first:
            assert all(first[0] <= p <= first[1] for p, _ in hits)


def plain_span(clip: str, text: str, window: int = 12, least: float = 0.6):
    """The rule over whole texts with difflib: word of the start, word of the end."""
    cut = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    p, w = cut(clip), cut(text)

    def best(needle, hay):
        n, h = " ".join(needle), " ".join(hay)
        m = difflib.SequenceMatcher(None, h, n, autojunk=False).find_longest_match(0, len(h), 0, len(n))
        if not needle or m.size < int(len(n) * least):
            return None
        # A word that both hold lays the needle on the text.
        for a, b in ((m.a + k, m.b + k) for k in range(m.size)):
            if (b == 0 or n[b - 1] == " ") and (a == 0 or h[a - 1] == " ") and h[a:].split(" ")[0] == n[b:].split(" ")[0] and len(n[b:].split(" ")[0]) <= m.size - (b - m.b):
                return h[:a].count(" ") - n[:b].count(" ")
        return None

    at = best(p[:window], w)
    if at is None:
        return None
    since = max(at, 0)
    end = best(p[-window:], w[since:])
    return since, None if end is None else since + min(end + len(p[-window:]), len(w) - since) - 1


def test_clips_are_located_as_by_plain_block_search(spark):
    from gleanery.operators.matching import locate_passages

    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdeéo") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    texts = [[rng.choice(vocabulary) for _ in range(rng.randrange(80, 250))] for _ in range(12)]
    clips = []
    for k in range(90):
        text, size = rng.choice(texts), rng.choice([1, 3, 5, 7, 8, 12, 20, 40, 60])
        start = rng.randrange(0, len(text) - size)
        clip = list(text[start : start + size])
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            at = rng.randrange(len(clip))
            clip[at : at + 1] = rng.choice([[], [clip[at] + "s"], [rng.choice(vocabulary)], [clip[at], "um"]])
            clip = clip or ["um"]
        clips.append((k, " ".join(clip).title() if k % 2 else ", ".join(clip) + "."))
    clips += [(900, None), (901, "..."), (902, "nothing in common here but gravel seagulls lanterns marmalade velvet staircases")]
    docs = [(d, " -- ".join(t)) for d, t in enumerate(texts)] + [(100, None), (101, "")]
    wanted = {}
    for k, c in clips:
        for d, t in docs:
            if c and t and (span := plain_span(c, t)):
                wanted[k, d] = span
    got = locate_passages(spark.createDataFrame(clips, "passage_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.passage_id, r.doc_id): (r.first_word, r.last_word) for r in got} == wanted and len(wanted) > 60
    least = locate_passages(spark.createDataFrame(clips, "passage_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string"), least_words=8).collect()
    assert {(r.passage_id, r.doc_id) for r in least} == {(r.passage_id, r.doc_id) for r in got if r.words >= 8}


def test_clips_despite_drift_of_punctuation(spark):
    from gleanery.operators.matching import locate_passages

    text = "So much for the weather. " * 20 + "The committee printed a thin booklet on seven quiet paths by which bakeries keep their ovens warm, it names them slow habits. " + "And now some music again. " * 20
    clips = [(1, "the committee printed a thin booklet on seven quiet paths by which bakeries keep their ovens warm. It names them: slow habits"), (2, "nothing in common here but gravel seagulls lanterns marmalade velvet staircases and thunder every winter morning")]
    got = locate_passages(spark.createDataFrame(clips, "passage_id long, text string"), spark.createDataFrame([(5, text)], "doc_id long, text string")).collect()
    assert [(r.passage_id, r.first_word, r.last_word, r.share) for r in got] == [(1, 100, 121, 1.0)]


def test_anti_join_asks_all_orders(spark, tmp_path):
    """A customer with any order is no gap, whatever the order's number."""
    from gleanery.plans import registry

    spark.range(1, 8).toDF("c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (6, None)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.queries()["j03_anti_join"](spark, str(tmp_path))
    assert sorted(r.c_custkey for r in got.collect()) == [5, 6, 7]
    assert "%" not in registry.oracle_sql()["j03_anti_join"]


def test_html_text_equals_its_sql_on_all_references(spark, tmp_path):
    """References with and without the semicolon, cut-off ones, numbers beyond the code points, and every blank of Unicode."""
    import html

    import duckdb

    from gleanery.plans import registry

    texts = ["&&&amp", "a &amp; b &amp b &am", "&ampx &notit; &notin; &nosuch; &lt&gt", "&mdash;&Aacute&CounterClockwiseContourIntegral;&fjlig;", "&#x41&#65;&#0;&#128;&#xD800;&#x110000;&#99999999999999999999;&#xfdd0;&#1;&#13;x&#x1F600;",
             "&# &#x; &; & &amp;lt; &amp;amp;", "a\u2003\u3000b \u0085 c\x0bd .", None, "", " <p>x</p> ! ", "<script>1</script\x0b>y<!-- z -->"]
    texts += [f"<b>{n}</b>&{n} &{n}x" for n in html.entities.html5]
    spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.text for r in registry.queries()["n05_html_text"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    wanted = dict(con.sql(registry.oracle_sql()["n05_html_text"]).fetchall())
    assert len(got) == len(texts) and {k: (got[k], wanted[k]) for k in got if got[k] != wanted[k]} == {}
    assert got[0] == "&&&" and got[1] == "a & b & b &am"


def test_first_blocks_equal_a_plain_loop_with_two_exchanges(spark):
    """Texts are exchanged once a side, no side is broadcast, and runs stay in their row."""
    from gleanery.operators.matching import anchor_blocks

    rng = random.Random(3)
    words = [f"w{k}" for k in range(30)]
    blocks = [(d, k, " ".join(rng.choice(words) for _ in range(40))) for d in range(6) for k in range(5)] + [(7, 0, None), (None, 0, "w1 w2 w3"), (8, 0, "a b")]
    passages = [(10 * d + k, d, " ".join(blocks[5 * d + k][2].split()[20:]) + " " + blocks[5 * d][2][:30]) for d in range(6) for k in range(5)] + [(90, 7, "w1 w2 w3"), (91, None, "w1 w2 w3"), (92, 8, "a b"), (93, 1, None)]
    runs = lambda t: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)}
    wanted = {}
    for i, d, t in passages:
        fit = [(" ".join(t.split()[:8]) in b, len(runs(t) & runs(b)), -pos) for e, pos, b in blocks if t and b and d == e and d is not None and runs(t) & runs(b)]
        if fit:
            wanted[i] = -max(fit)[2]
    out = anchor_blocks(spark.createDataFrame(passages, "passage_id long, doc_id long, text string"), spark.createDataFrame(blocks, "doc_id long, pos int, piece string"))
    assert {r.passage_id: r.pos for r in out.collect()} == wanted and len(wanted) == 30
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(re.findall(r"\bExchange ", plan)) == 2 and "Broadcast" not in plan


def test_containment_match_meets_each_pair_of_titles_once(spark):
    """Copies of titles multiply no pairs; bands and least ids are those of all pairs."""
    from gleanery.operators.joins import containment_match

    titles = ["red ring", "ring", "red", "blue ring live", "Blue Ring", "bolt", None, ""]
    rows = [(k, titles[k % 8], ["large one", "large two", "x", None, "small one"][k % 5]) for k in range(400)]
    catalog = [(1000 - k, titles[(k + k // 7) % 8], ["large one", "small one", "one large", "two"][k % 4]) for k in range(400)]
    split = lambda t: re.findall("[^\\W_]+", t.lower())
    wanted = {}
    for i, t, a in rows:
        fit = []
        for c, ct, ca in catalog:
            if t and ct and a and set(split(t)) & set(split(ct)):
                if a == ca:
                    fit.append((0 if t.lower() in ct.lower() or ct.lower() in t.lower() else 1, c))
                elif split(a)[0] in split(ca):
                    fit.append((2, c))
        tier, c = min(fit, default=(3, None))
        wanted[i] = (c, ["HIGH", "MEDIUM", "LOW", "NOT_FOUND"][tier])
    out = containment_match(spark.createDataFrame(rows, "id long, title string, artist string"), spark.createDataFrame(catalog, "catalog_id long, title string, artist string"))
    assert {r.id: (r.catalog_id, r.band) for r in out.collect()} == wanted
    # Artist words and title words meet as one row each, not as all catalog rows.
    assert re.search(r"Aggregate \[aw#\d+, w#\d+\]", out._jdf.queryExecution().optimizedPlan().toString())


def test_facts_are_read_once_for_all_tags(spark):
    from gleanery.operators.mentions import derive_tags, parse_facts

    texts = ['[{"fact_key": " Domain", "fact_value": "a"}, 7, {"fact_key": "domain"}]', '[{"fact_key": "has_survey_questions", "fact_value": " FALSE "}]', '[{"fact_key": "contains_survey_questions"}]', '[{"fact_key": "modality", "fact_value": "x"}, {"fact_key": "has_survey_questions", "fact_value": 1}]', "no json", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    out = rows.select("k", derive_tags(F.when(F.col("k") == 0, "account"), F.when(F.col("k") == 1, "X"), parse_facts(F.col("t"))).alias("tags"))
    wanted = [{"is_account": "true", "domain": "null"}, {"platform": "x", "contains_survey_questions": "false"}, {"contains_survey_questions": "false"}, {"modality": "x", "contains_survey_questions": "true"}, {}, {}]
    assert [r.tags for r in out.orderBy("k").collect()] == wanted
    assert out._jdf.queryExecution().optimizedPlan().toString().lower().count("fact_key") < 12
