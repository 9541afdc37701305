"""Readers on landed files, and streams replayed in two batches."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F


def test_feed(spark, tmp_path):
    from gleanery.sources.readers import read_feed

    item = lambda title, extra: f"<item><title>{title}</title>{extra}<pubDate>Mon, 01 Jun 2026 23:30:00 -0400</pubDate><description>&lt;p&gt;A &amp;amp; B&lt;/p&gt;</description></item>"
    (tmp_path / "f.xml").write_text("<rss><channel>" + item("Show: one", '<guid isPermaLink="false">g1</guid><link>https://l/1</link>') + item("Show: two #12", '<enclosure url="https://a/2.mp3"/><link>https://l/2</link>') + item("Other", "<link>https://l/3</link>") + item("Show: four", "") + "</channel></rss>")
    got = {r.title: r for r in read_feed(spark, str(tmp_path / "f.xml"), "gab", "Show").collect()}
    assert {t: r.url for t, r in got.items()} == {"Show: one": "g1", "Show: two #12": "https://a/2.mp3", "Show: four": "gab:Show: four:Mon, 01 Jun 2026 23:30:00 -0400"}
    assert got["Show: two #12"].episode_number == 12 and got["Show: one"].publish_date == dt.date(2026, 6, 2) and got["Show: one"].description_body == "A & B"


def test_json_files(spark, tmp_path):
    from gleanery.sources import readers as S

    (tmp_path / "e.json").write_text(json.dumps({"uuid": "u", "name": "n", "datePublished": 86400 * 3 + 5}))
    assert S.read_provider_episodes(spark, str(tmp_path / "e.json")).first().publish_date == dt.date(1970, 1, 4)
    (tmp_path / "p.json").write_text(json.dumps({"7": None, "8": 2384}))
    assert sorted((r.episode_id, r.transcript_id) for r in S.read_provenance(spark, str(tmp_path / "p.json")).collect()) == [(7, None), (8, 2384)]
    (tmp_path / "g.json").write_text(json.dumps({"_meta": {"model": "m"}, "episodes": [{"episode_id": 1, "input_sha256": "x", "entities": {"a": {"canonical_name": "A", "entity_type": "t", "confidence": 0.5}}}, {"episode_id": 2, "entities": {}}]}, indent=1))
    assert sorted((r.episode_id, r.key) for r in S.read_fixture(spark, str(tmp_path / "g.json")).collect()) == [(1, "a"), (2, None)]
    (tmp_path / "w.json").write_text(json.dumps({"db_id": 1, "url": "u", "success": True, "markdown": "m", "metadata": {"a": "b"}}, indent=1))
    assert S.read_pages(spark, str(tmp_path / "w.json")).first().metadata == {"a": "b"}
    (tmp_path / "m.json").write_text(json.dumps({"batch_name": "b", "episodes": [{"episode_id": 1, "mention_count": 2}], "summary": {"model": 2}}, indent=1))
    assert S.read_manifests(spark, str(tmp_path / "m.json")).first().summary == {"model": 2}


def test_mention_batch(spark, tmp_path):
    from gleanery.sources.readers import MENTION, read_mentions, require_rows

    names = [c.split()[0] for c in MENTION.split(", ")]
    facts = '"[{""fact_key"": ""domain"", ""fact_value"": ""x""}, {}]"'
    row = lambda conf, f: ",".join(["1", "model", "A", '"two\nlines, ""q"""', "", "", "positive", "true", conf, "false", "", "ctx", "", f])
    (tmp_path / "m.csv").write_text(",".join(names) + "\n" + row("0.9000", facts) + "\n" + row("bad", "not json") + "\n")
    got = read_mentions(spark, str(tmp_path / "m.csv")).collect()
    assert got[0].mention_text == 'two\nlines, "q"' and got[0].is_editorial is True and len(got[0].facts) == 1 and float(got[0].confidence) == 0.9
    assert got[1].confidence is None and got[1].facts == []
    with pytest.raises(ValueError, match="empty"):
        require_rows(spark.createDataFrame([], "a int"), "batch")


def test_markdown(spark, tmp_path):
    from gleanery.sources.readers import read_markdown

    body = "x" * 600
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "2026-01-02-note.md").write_text(f"# A title\n{body}")
    (tmp_path / "plain.md").write_text(f"---\ndate: 2025-12-31\n---\n{body}")
    (tmp_path / "README.md").write_text(f"# no\n{body}")
    (tmp_path / "short.md").write_text("# short")
    assert sorted((r.title, r.publish_date) for r in read_markdown(spark, str(tmp_path)).collect()) == [("A title", dt.date(2026, 1, 2)), ("plain", dt.date(2025, 12, 31))]


def test_song_pages(spark):
    from gleanery.sources.readers import description_body, episode_list, song_lines, song_sections

    notes = "# T\nIntro text.\n\n**Songs Discussed**\n- Big Thief – Not\n- Low - Days Like These\n- A – B\n\n**Credits**\nx"
    df = spark.createDataFrame([(1, notes), (2, "**Songs Discussed**\nBjork “Joga”\n"), (3, "none")], "id int, t string")
    assert sorted((r.id, r.artist, r.title) for r in song_lines(df, "id", "t").collect()) == [(1, "A", "B"), (1, "Big Thief", "Not"), (1, "Low", "Days Like These"), (2, "Bjork", "Joga")]
    assert df.where("id = 1").select(description_body(F.col("t")).alias("x")).first().x == "Intro text."
    s = spark.createDataFrame([(1, '## Song: “Hello” by Adele (live)\n## Song: Blur – Song 2\n')], "id int, t string")
    assert [(r.title, r.artist) for r in song_sections(s, "id", "t").orderBy("pos").collect()] == [("Hello", "Adele"), ("Song 2", "Blur")]
    e = spark.createDataFrame([(1, "May 3, 2024\n\n[First](https://a/1)\n\nJune 10, 2024 [Second](https://a/2)")], "id int, t string")
    assert [(r.title, r.url, r.publish_date) for r in episode_list(e, "id", "t").orderBy("pos").collect()] == [("First", "https://a/1", dt.date(2024, 5, 3)), ("Second", "https://a/2", dt.date(2024, 6, 10))]


# ---------------------------------------------------------------- streams


class Landing:
    """A folder into which batches of rows are put, read as a stream."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema
        path.mkdir()

    def put(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.path)


def drain(df, name, checkpoint, mode="append"):
    """Everything that is there now; the rows so far of a memory sink."""
    q = df.writeStream.format("parquet").option("path", f"{checkpoint}/out").option("checkpointLocation", f"{checkpoint}/cp").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.read.schema(df.schema).parquet(f"{checkpoint}/out")


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_late_transcripts(spark, tmp_path):
    from gleanery.streaming.jobs import wait_for_transcript

    e = Landing(spark, tmp_path / "e", "episode_id long, published timestamp, notes string")
    t = Landing(spark, tmp_path / "t", "t_episode_id long, arrived timestamp, transcript string")
    e.put([(1, day(0), "n1"), (2, day(0), "n2")])
    t.put([(1, day(3), "t1")])
    run = lambda: {r.episode_id: (r.text, r.source) for r in drain(wait_for_transcript(e.stream(), t.stream()), "w", str(tmp_path / "c")).collect()}
    assert run() == {1: ("t1", "transcript")}
    for k in (30, 31):  # later events on both sides move the watermark
        e.put([(k, day(k), "n")])
        t.put([(k + 100, day(k), "x")])
        got = run()
    assert got[2] == ("n2", "show_notes") and got[1] == ("t1", "transcript")


def test_repeats_and_counts(spark, tmp_path):
    from gleanery.streaming.jobs import day_counts, drop_repeats, rolling_counts

    x = Landing(spark, tmp_path / "x", "url string, at timestamp")
    x.put([("a", day(0)), ("b", day(0))])
    first = drain(drop_repeats(x.stream(), "url", "at"), "d", str(tmp_path / "c1")).count()
    x.put([("a", day(1)), ("c", day(1))])
    assert first == 2 and drain(drop_repeats(x.stream(), "url", "at"), "d", str(tmp_path / "c1")).count() == 3
    x.put([("z", day(40))])
    counts = drain(day_counts(x.stream(), "at"), "n", str(tmp_path / "c2"))
    x.put([("z", day(41))])
    counts = drain(day_counts(x.stream(), "at"), "n", str(tmp_path / "c2"))
    assert {(r.day, r.n) for r in counts.collect()} >= {(day(0).date(), 2), (day(1).date(), 2)}
    assert rolling_counts(x.stream(), "at").isStreaming


def test_stale_sources(spark, tmp_path):
    """Timers survive a restart; a source that is known but never sends is told; one that sends again can fire again."""
    from gleanery.streaming.jobs import stale_sources, stateful_session

    stateful_session(spark)
    x = Landing(spark, tmp_path / "x", "source string, at timestamp")
    known = spark.createDataFrame([("silent", day(-5)), ("old", day(-2)), ("silent", day(-30))], "source string, at timestamp")
    x.put([("old", day(0)), ("new", day(0))])

    def run():
        q = stale_sources(x.stream(), "source", "at", 14, known=known)
        return sorted((r.source, (r.last_seen - day(0)).days) for r in drain(q, "s", str(tmp_path / "c")).collect())

    assert run() == []
    x.put([("new", day(20))])
    run()
    x.put([("new", day(21))])
    assert run() == [("old", 0), ("silent", -5)]
    x.put([("old", day(22)), ("new", day(23))])
    assert run() == [("old", 0), ("silent", -5)]
    x.put([("new", day(60))])
    run()
    x.put([("new", day(61))])
    assert [r for r in run() if r[0] == "old"] == [("old", 0), ("old", 22)]


def test_gate_stops_before_load(spark, tmp_path):
    from gleanery.streaming.jobs import load_each_batch

    x = Landing(spark, tmp_path / "x", "id long, ok boolean")
    x.put([(1, True)])
    out = str(tmp_path / "out")
    load = lambda df, n: df.write.mode("append").parquet(out)
    gate = lambda df: "bad rows" if df.where("not ok").count() else None
    load_each_batch(x.stream(), load, str(tmp_path / "c"), gate).awaitTermination(60)
    x.put([(2, False)])
    with pytest.raises(Exception, match="bad rows"):
        load_each_batch(x.stream(), load, str(tmp_path / "c"), gate).awaitTermination(60)
    assert spark.read.parquet(out).count() == 1


def test_a_replayed_load_leaves_each_row_once(spark, tmp_path):
    """A load that dies after its rows were written, a gate that stops a batch, and a replay of both."""
    from pyspark.sql import functions as F

    from gleanery.streaming import jobs as J

    x = Landing(spark, tmp_path / "x", "id long, ok boolean")
    out, state, broken = str(tmp_path / "out"), str(tmp_path / "c"), []
    measures = {"n_rows": F.count(F.lit(1)), "bad": F.count_if(~F.col("ok")), "most": F.max("id")}

    def gate(m):
        if broken:
            raise OSError("the machine went away")
        return "bad rows" if m["bad"] else None

    load = lambda: J.load_once(x.stream(), out, state, lambda df, n: df.where("id is not null"), measures, gate).awaitTermination(60)
    x.put([(1, True), (2, True), (None, True)])
    broken.append(1)
    with pytest.raises(Exception, match="went away"):
        load()
    assert len(list((tmp_path / "out" / "rows").glob("batch=0/part-*"))) > 0 and not (tmp_path / "out" / "ledger").exists()
    broken.clear()
    load()
    assert sorted(r.id for r in J.loaded(spark, out).collect()) == [1, 2]
    x.put([(3, True), (4, False)])
    with pytest.raises(Exception, match="bad rows"):
        load()
    assert sorted(r.id for r in J.loaded(spark, out).collect()) == [1, 2]
    measures["bad"] = F.count_if(F.lit(False))  # someone has looked at the batch and lets it pass
    load()
    x.put([(None, True)])  # a batch of which no row is left
    load()
    assert sorted(r.id for r in J.loaded(spark, out).collect()) == [1, 2, 3, 4]
    assert sorted((r.n, r.n_rows, r.most) for r in J.ledger(spark, out).collect()) == [(0, 2, 2), (1, 2, 4), (2, 0, None)]


def test_landing_reads_what_changed(spark, tmp_path):
    import os
    import time

    from gleanery.sources.landing import changes, land_files, landed

    files, table = tmp_path / "files", str(tmp_path / "table")
    (files / "deep").mkdir(parents=True)
    put = lambda name, text, at: ((files / name).write_text(text), os.utime(files / name, (at, at)))
    rows = lambda t: sorted((r.path.rsplit("files/", 1)[1], r.content, r.length) for r in landed(spark, t).collect())
    begin = time.time() - 10_000
    for k in range(12):
        put(f"{k}.md", f"text {k}", begin + k)
    put("deep/x.md", "deep", begin)
    put("other.txt", "no", begin)
    land_files(spark, str(files), table, "*.md", 4)
    assert len(rows(table)) == 13
    fresh, gone = changes(spark, str(files), table, "*.md")
    assert fresh is None and gone.count() == 0
    put("3.md", "text three", begin + 500)  # changed
    put("new.md", "new", begin + 501)
    put("8.md", "", begin + 503)  # an emptied file counts as gone
    os.utime(files / "5.md", (begin + 502, begin + 502))  # touched alone
    os.remove(files / "7.md")
    fresh, gone = changes(spark, str(files), table, "*.md")
    assert sorted(r.path.rsplit("/", 1)[1] for r in fresh.collect()) == ["3.md", "5.md", "new.md"] and gone.count() == 2
    land_files(spark, str(files), table, "*.md", 4)
    put("old.md", "moved in with an old time", begin + 2)
    land_files(spark, str(files), table, "*.md", 4)
    land_files(spark, str(files), str(tmp_path / "full"), "*.md", 4)
    assert rows(table) == rows(str(tmp_path / "full")) and len(rows(table)) == 13
    for f in files.rglob("*.md"):
        os.remove(f)
    land_files(spark, str(files), table, "*.md", 4)
    assert rows(table) == []


def test_measures_are_taken_on_the_write(spark, tmp_path):
    from gleanery.operators.checks import field_rules, rules_on_write

    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.createDataFrame([(1, 0.5), (2, None), (3, 7.0)], "id int, c double")
    rules = {"missing": F.col("c").isNull(), "range": F.col("c") > 1}
    got = rules_on_write(rows.mapInPandas(look, rows.schema), str(tmp_path / "t"), rules)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, field_rules(rows, rules).collect())) == [("missing", 1), ("range", 1)]
    assert seen.value == 3 and spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_a_file_for_each_row_is_written_by_several_tasks(spark, monkeypatch):
    import collections
    import glob
    import re

    from pyspark.sql import functions as F

    from gleanery.plans import files

    monkeypatch.setattr(files, "FILES_PER_TASK", 20)
    path = files._landed(spark.range(100).coalesce(1).select(F.concat(F.lit("row "), "id").alias("value")), "dealt", one_each=True)
    names = glob.glob(path.removeprefix("file://") + "/*.txt")
    tasks = collections.Counter(re.search("part-([0-9]+)", n)[1] for n in names)
    assert len(names) == 100 and len(tasks) == 5
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(f"row {k}" for k in range(100))
    empty = files._landed(spark.range(0).select(F.lit("x").alias("value")), "dealt", one_each=True)
    assert spark.read.text(empty).count() == 0


def test_late_transcripts_pass_over_their_state_four_times(spark, tmp_path, monkeypatch):
    """Texts wait in RocksDB, and no pass is made once the watermark is past every episode."""
    import glob

    from gleanery.plans import streams

    monkeypatch.setattr(streams, "scratch", lambda spark, name: str(tmp_path / name))
    docs = [(k, f"text {k}") for k in range(60)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "in/documents.parquet"))
    got = streams.st01(spark, str(tmp_path / "in")).collect()
    assert sorted(tuple(r) for r in got) == [(k, t, "transcript" if k % 5 and k % 3 else "show_notes") for k, t in docs]
    assert len(glob.glob(f"{tmp_path}/st01/state/commits/[0-9]*")) == 4
    kinds = {f.rsplit(".", 1)[-1] for f in glob.glob(f"{tmp_path}/st01/state/state/**/*", recursive=True) if "." in f.rsplit("/", 1)[-1]}
    assert kinds & {"changelog", "zip"} and "delta" not in kinds
