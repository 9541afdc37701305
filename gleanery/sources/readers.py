"""Readers of landed files: feeds, provider JSON, Markdown, scraped pages, mention batches, manifests, fixtures.

Schemas are declared, so nothing is inferred and a reader costs no extra pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import html_to_text
from ..operators.mentions import parse_facts

RSS = "title string, guid struct<_VALUE:string,_isPermaLink:boolean>, link string, enclosure struct<_url:string>, pubDate string, description string"
EPISODE = "uuid string, name string, description string, audioUrl string, datePublished long, episodeNumber int, imageUrl string"
PAGE = "db_id long, url string, success boolean, markdown string, metadata map<string,string>, fetched_at string"
MENTION = "episode_id long, entity_type string, canonical_name string, mention_text string, platform string, source_url string, sentiment_label string, is_editorial string, confidence string, needs_review string, review_reason string, context_snippet string, quoted_text string, facts_json string"
FIXTURE = "_meta map<string,string>, episodes array<struct<episode_id:long,input_sha256:string,entities:map<string,struct<canonical_name:string,entity_type:string,confidence:double>>>>"


def feed_date(c: Column) -> Column:
    """Date in UTC of an RFC 822 time stamp; null if it can't be read."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(c), "^[A-Za-z]{3}, *", ""), "(?:GMT|UTC|Z)$", "+0000")
    return F.to_date(F.to_utc_timestamp(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), F.current_timezone()))


def read_feed(spark: SparkSession, path: str, slug: str, title_prefix: str | None = None) -> DataFrame:
    """Items of RSS files: title, url (guid, else link), audio, publish_date, episode number, plain description.

    An item without guid, enclosure and link is keyed by show, title and date.
    """
    raw = spark.read.format("xml").option("rowTag", "item").schema(RSS).load(path)
    if title_prefix:
        raw = raw.where(F.col("title").startswith(title_prefix))
    synthetic = F.concat_ws(":", F.lit(slug), F.trim("title"), F.trim("pubDate"))
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    return raw.select(
        F.trim("title").alias("title"),
        F.coalesce(text(F.col("guid._VALUE")), text(F.col("enclosure._url")), text(F.col("link")), synthetic).alias("url"),
        F.col("enclosure._url").alias("audio_url"),
        feed_date(F.col("pubDate")).alias("publish_date"),
        F.regexp_extract("title", "(?i)(?:#|ep(?:isode)?\\.? *)([0-9]+)", 1).try_cast("int").alias("episode_number"),
        html_to_text(F.col("description")).alias("description_body"),
    )


def epoch_date(c: Column) -> Column:
    """Date in UTC of seconds since 1970."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(c / 86400).cast("int"))


def read_provider_episodes(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(EPISODE).json(path)
    return raw.select("uuid", F.col("name").alias("title"), F.col("description").alias("description_body"), F.col("audioUrl").alias("audio_url"), epoch_date(F.col("datePublished")).alias("publish_date"), F.col("episodeNumber").alias("episode_number"), F.col("imageUrl").alias("image_url"))


def episode_url(slug: Column, audio: Column, uuid: Column, title: Column) -> Column:
    """Key of an imported episode: provider id, else audio address, else show and title."""
    full = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(F.concat(F.lit("provider://"), full(uuid)), full(audio), F.concat_ws(":", slug, full(title)))


def join_paragraphs(rows: DataFrame, key: str, position: str, text: str) -> DataFrame:
    """(key, transcript): paragraphs in order with an empty line between, blank ones dropped.

    The collected group is one transcript.
    """
    kept = rows.where(F.trim(F.coalesce(text, F.lit(""))) != "")
    parts = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.trim(text).alias("t"))))
    return kept.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["t"]), "\n\n").alias("transcript"))


def read_markdown(spark: SparkSession, path: str, exclude: str = r"/(node_modules|\.git|templates|archive)/|/(README|CLAUDE|INDEX)\.md$", least_chars: int = 500, names: str = "*.md") -> DataFrame:
    """Documents below a folder: path, title (first heading of the first ten lines), date (name, front matter, change time), text."""
    raw = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", names).load(path)
    d = raw.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("changed"))
    d = d.where(~F.col("path").rlike(exclude) & (F.length("value") >= least_chars))
    head = F.slice(F.split("value", "\r?\n"), 1, 10)
    heading = F.get(F.filter(head, lambda x: x.startswith("# ")), F.lit(0))
    name = F.regexp_extract("path", "([^/]+)\\.[A-Za-z]+$", 1)
    in_name = F.regexp_extract(name, "(\\d{4}-\\d{2}-\\d{2})", 1)
    in_front = F.regexp_extract("value", "(?s)^---.*?\\ndate: *[\"']?(\\d{4}-\\d{2}-\\d{2})", 1)
    read = lambda c: F.try_to_date(F.nullif(c, F.lit("")), "yyyy-MM-dd")
    return d.select("path", F.coalesce(F.trim(F.regexp_replace(heading, "^# +", "")), name).alias("title"), F.coalesce(read(in_name), read(in_front), F.to_date("changed")).alias("publish_date"), F.col("value").alias("text"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE).option("multiLine", True).json(path)


def read_mentions(spark: SparkSession, path: str) -> DataFrame:
    """A mention batch; flags and confidences are typed, facts read from their JSON (unreadable: none)."""
    raw = spark.read.schema(MENTION).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    flag = lambda c: F.when(F.lower(c) == "true", True).when(F.lower(c) == "false", False)
    return raw.withColumns({"is_editorial": flag("is_editorial"), "needs_review": flag("needs_review"), "confidence": F.col("confidence").try_cast("decimal(5,4)"), "facts": F.filter(parse_facts(F.col("facts_json")), lambda f: f["fact_key"].isNotNull())}).drop("facts_json")


#: Columns of a batch's review queue and of its summary by episode.
REVIEW = "episode_id long, entity_type string, canonical_name string, mention_text string, confidence string, review_reason string, platform string, source_url string, context_snippet string"
SUMMARY = "episode_id long, publish_date string, title string, episode_url string, transcript_path string, mention_count int, review_count int, prompt_tokens long, completion_tokens long, total_tokens long, estimated_total_cost_usd string"


def _read_batch(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


def read_review_queue(spark: SparkSession, path: str) -> DataFrame:
    """The review queue of a batch; confidences that are no numbers are null."""
    return _read_batch(spark, path, REVIEW).withColumn("confidence", F.col("confidence").try_cast("decimal(5,4)"))


def read_episode_summary(spark: SparkSession, path: str) -> DataFrame:
    """A batch's summary by episode; dates and costs that can't be read are null, missing token counts are 0."""
    typed = _read_batch(spark, path, SUMMARY).withColumns({"publish_date": F.to_date(F.try_to_timestamp("publish_date")), "estimated_total_cost_usd": F.col("estimated_total_cost_usd").try_cast("decimal(12,6)")})
    return typed.na.fill(0, ["prompt_tokens", "completion_tokens", "total_tokens"])


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame, or an error if it is empty."""
    if not df.limit(1).count():
        raise ValueError(f"{what} is empty")
    return df


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("batch_name string, model string, episodes array<struct<episode_id:long,mention_count:int,review_count:int>>, summary map<string,long>, total_cost double").option("multiLine", True).json(path)


def read_fixture(spark: SparkSession, path: str) -> DataFrame:
    """(episode_id, input_sha256, key, canonical_name, entity_type, confidence) of a gold or baseline file."""
    raw = spark.read.schema(FIXTURE).option("multiLine", True).json(path)
    e = raw.select(F.explode("episodes").alias("e")).select("e.episode_id", "e.input_sha256", F.explode_outer("e.entities").alias("key", "x"))
    return e.select("episode_id", "input_sha256", "key", "x.canonical_name", "x.entity_type", "x.confidence")


def read_provenance(spark: SparkSession, path: str) -> DataFrame:
    """(episode_id, transcript_id) of a JSON map; a null transcript stays a row."""
    raw = spark.read.format("text").option("wholetext", True).load(path)
    return raw.select(F.explode(F.from_json("value", "map<string,bigint>")).alias("k", "transcript_id")).select(F.col("k").cast("long").alias("episode_id"), "transcript_id")


def best_text(official: Column, generated: Column, notes: Column, least: int = 500) -> tuple[Column, Column]:
    """Text and its source: the official transcript if it is longer than ``least``, else a generated one, else the notes."""
    good = F.length(official) > least
    return F.coalesce(F.when(good, official), generated, notes), F.when(good, "official").when(generated.isNotNull(), "generated").when(notes.isNotNull(), "notes")


def song_lines(pages: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, pos, artist, title) of a notes page's song section: list lines ``- Artist – Title``, else ``Artist "Title"``."""
    section = F.regexp_extract(text, "(?is)\\*\\*songs discussed[^*]*\\*\\*(.*?)(?:\\n\\s*\\*\\*|\\z)", 1)
    dash = F.regexp_extract_all(section, F.lit("(?m)^\\s*[-*]\\s+(.+? [–—-] .+?)\\s*$"), 1)
    quoted = F.regexp_extract_all(section, F.lit("(?m)^\\s*[-*]?\\s*([^\"“\\n]+[\"“][^\"”\\n]+[\"”])"), 1)
    lines = pages.select(id_col, F.posexplode(F.when(F.size(dash) > 0, dash).otherwise(quoted)).alias("pos", "line"))
    artist = F.trim(F.regexp_extract("line", "^(.+?)(?: [–—-] |\\s*[\"“])", 1))
    title = F.trim(F.regexp_replace(F.regexp_extract("line", "(?: [–—-] |[\"“])(.+)$", 1), "[\"”“]", ""))
    return lines.select(id_col, "pos", artist.alias("artist"), title.alias("title")).where("artist <> '' and title <> ''")


def song_sections(pages: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, pos, title, artist) of sections ``## Song: "Title" by Artist`` or ``## Song: Artist – Title``; notes in brackets are cut."""
    heads = F.regexp_extract_all(text, F.lit("(?m)^##+ *Songs?: *(.+?) *$"), 1)
    x = pages.select(id_col, F.posexplode(heads).alias("pos", "h")).withColumn("h", F.trim(F.regexp_replace(F.translate("h", "“”‘’", "\"\"''"), " *\\([^)]*\\)$", "")))
    by = F.col("h").rlike("(?i) by ")
    title = F.when(by, F.regexp_extract("h", "(?i)^(.*?) by ", 1)).otherwise(F.regexp_extract("h", " [–—-] (.+)$", 1))
    artist = F.when(by, F.regexp_extract("h", "(?i) by (.+)$", 1)).otherwise(F.regexp_extract("h", "^(.+?) [–—-] ", 1))
    return x.select(id_col, "pos", F.regexp_replace(F.trim(title), "^[\"']+|[\"']+$", "").alias("title"), F.trim(artist).alias("artist"))


def episode_list(pages: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, pos, title, url, publish_date) of list links ``[Title](url)`` with the date in the 100 characters before each."""
    rows = F.regexp_extract_all(text, F.lit("(?s)([^\\[\\]]{0,100}\\[[^\\]\\n]+\\]\\(https?://[^)\\s]+\\))"), 1)
    x = pages.select(id_col, F.posexplode(rows).alias("pos", "r"))
    date = F.regexp_extract("r", "([A-Z][a-z]+ \\d{1,2}, \\d{4})", 1)
    return x.select(id_col, "pos", F.regexp_extract("r", "\\[([^\\]]+)\\]", 1).alias("title"), F.regexp_extract("r", "\\((https?://[^)\\s]+)\\)", 1).alias("url"), F.try_to_date(F.nullif(date, F.lit("")), "MMMM d, yyyy").alias("publish_date"))


def description_body(text: Column) -> Column:
    """Notes between the title and the first section; footers of subscriptions and credits are cut."""
    body = F.regexp_replace(text, "(?s)^\\s*#[^\\n]*\\n", "")
    body = F.regexp_replace(body, "(?s)\\n\\s*(?:\\*\\*[^\\n]*\\*\\*|##).*$", "")
    return F.trim(F.regexp_replace(body, "(?im)^(?:subscribe|follow us|support the show|learn more about).*$", ""))
