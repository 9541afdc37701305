"""Mentions as a model proposes them: cleaning, retyping, review flags."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of sentiment.
SENTIMENTS = ("positive", "neutral", "negative", "mixed", "unknown")


def _blank_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def sanitize_mentions(mentions: DataFrame, types: list[str], review_below: float = 0.78) -> DataFrame:
    """Mentions fit for loading.

    A mention needs a name, its text and a context, or it is dropped. An unknown type becomes ``other`` and goes to
    review; an unknown sentiment becomes ``unknown``; a confidence that is no number counts as 0.5, others are held in
    0 to 1, and under ``review_below`` the mention goes to review. The first reason for a review stays.
    """
    m = mentions.withColumns({c: _blank_null(F.col(c)) for c in ("canonical_name", "mention_text", "context_snippet")})
    m = m.where("canonical_name is not null and mention_text is not null and context_snippet is not null")
    kind = F.lower(F.trim("mention_type"))
    odd = ~F.coalesce(kind.isin(*types, "other"), F.lit(False))
    number = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col("confidence").try_cast("double"), F.lit(0.5))))
    m = m.withColumns({"__odd": odd, "mention_type": F.when(odd, "other").otherwise(kind), "confidence": number})
    tone = F.lower(F.trim("sentiment_label"))
    low = F.col("confidence") < review_below
    reason = F.when(F.col("__odd"), "model_proposed_unknown_type").when(low, "low_confidence")
    return m.withColumns({"sentiment_label": F.when(tone.isin(*SENTIMENTS), tone).otherwise("unknown"), "needs_review": F.col("__odd") | low, "review_reason": reason}).drop("__odd")


class Rule(NamedTuple):
    """Where ``when`` holds (null: it doesn't), a mention gets the type, name or platform given, and the reason to review it.

    ``when`` and ``name`` are functions of the mention, a struct with mention_type, canonical_name, context_snippet,
    platform, and blob (all its words in lower case, as they were before the first rule).
    """

    when: Callable[[Column], Column]
    reason: str
    kind: str | None = None
    name: Callable[[Column], Column] | None = None
    platform: str | None = None


def retype_mentions(mentions: DataFrame, rules: list[Rule], types: list[str] | None = None) -> DataFrame:
    """Apply rules in order; each sees the types and names that earlier rules gave.

    A mention that a rule changes goes to review with the rule's reason, unless it has a reason already. With ``types``,
    any other type becomes ``other`` at the end, and ``other`` always goes to review. A platform that is set stays.
    """
    text = [F.coalesce(c, F.lit("")) for c in ("mention_text", "canonical_name", "context_snippet", "quoted_text") if c in mentions.columns]
    platform = F.col("platform") if "platform" in mentions.columns else F.lit(None).cast("string")
    if types is not None:
        odd = Rule(lambda m: ~F.coalesce(m["mention_type"].isin(*types, "other"), F.lit(False)), "postprocess_unknown_type", "other")
        rules = [*rules, odd, Rule(lambda m: m["mention_type"] == "other", "other_type_needs_review", "other")]

    def step(rule: Rule) -> Callable[[Column], Column]:
        return lambda m: apply(rule, m)

    def apply(rule: Rule, m: Column) -> Column:
        hit = F.coalesce(rule.when(m), F.lit(False))
        new = {
            "mention_type": m["mention_type"] if rule.kind is None else F.when(hit, rule.kind).otherwise(m["mention_type"]),
            "canonical_name": m["canonical_name"] if rule.name is None else F.when(hit, rule.name(m)).otherwise(m["canonical_name"]),
            "context_snippet": m["context_snippet"],
            "platform": m["platform"] if rule.platform is None else F.when(hit, F.coalesce(_blank_null(m["platform"]), F.lit(rule.platform))).otherwise(m["platform"]),
            "blob": m["blob"],
            "needs_review": m["needs_review"] | hit,
            "review_reason": F.coalesce(m["review_reason"], F.when(hit, rule.reason)),
        }
        return F.struct(*(c.alias(n) for n, c in new.items()))

    # A list of one mention: each step's lambda names the state, so expressions stay as long as the rules and no longer.
    state = F.array(F.struct("mention_type", "canonical_name", "context_snippet", platform.alias("platform"), F.lower(F.concat_ws(" ", *text)).alias("blob"), "needs_review", "review_reason"))
    for rule in rules:
        state = F.transform(state, step(rule))
    changed = [c for c in ("mention_type", "canonical_name", "platform", "needs_review", "review_reason") if c in mentions.columns]
    done = mentions.select(F.struct("*").alias("row"), F.get(state, F.lit(0)).alias("new"))
    return done.select(*(F.col("new")[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in mentions.columns))


# Words that the rules of the technology profile look for.
OUTLET_WORDS = ("journal", "times", "bloomberg", "reuters")
OUTLET_NAMES = ("wall street journal", "wsj", "new york times", "nyt", "bloomberg", "reuters", "the information")
SURVEY_WORDS = ("survey", "poll", "barometer", "census", "questionnaire")
BENCHMARK_NAMES = ("gpqa", "mmlu", "swe-bench", "swebench", "lm arena", "lmarena", "livecodebench", "terminal bench", "humanitys last exam", "hellaswag")
POSTING_WORDS = ("tweeted", "posted", "reposted", "thread on x", "on x")


def tech_rules(pulse_names: tuple[str, ...] = ("ai daily brief", "the ai daily brief"), pulse: str = "AI Usage Pulse Survey") -> list[Rule]:
    """Rules of the technology profile in their order; the media profile has none but the check of types.

    ``pulse_names``: names under which a programme's own survey is proposed where its text speaks of a pulse survey.
    """
    any_of = lambda c, words: c.rlike("|".join(re.escape(w) for w in words))
    name = lambda m: F.lower(m["canonical_name"])
    is_a = lambda m, *kinds: m["mention_type"].isin(*kinds)
    own = lambda m: name(m).isin(*pulse_names) & m["blob"].contains("pulse survey")
    outlet = lambda m: is_a(m, "survey") & ~own(m) & any_of(name(m), OUTLET_NAMES)
    bare = lambda m, word: is_a(m, "survey") & ~any_of(name(m), OUTLET_NAMES + SURVEY_WORDS) & F.lower(m["context_snippet"]).contains(word)
    loose = lambda m: is_a(m, "other", "organization", "person")
    with_word = lambda word: lambda m: F.trim(F.concat_ws(" ", m["canonical_name"], F.lit(word)))
    return [
        Rule(lambda m: is_a(m, "report") & any_of(m["blob"], OUTLET_WORDS), "media_outlet_not_report", "organization"),
        Rule(lambda m: is_a(m, "survey") & own(m), "survey_name_normalized", name=lambda m: F.lit(pulse)),
        Rule(outlet, "media_outlet_not_survey", "organization"),
        Rule(lambda m: bare(m, "survey"), "survey_suffix_added", name=with_word("survey")),
        Rule(lambda m: bare(m, "poll"), "survey_suffix_added", name=with_word("poll")),
        Rule(lambda m: loose(m) & m["blob"].contains("survey"), "survey_retyped_from_context", "survey"),
        Rule(lambda m: loose(m) & any_of(m["blob"], BENCHMARK_NAMES), "benchmark_retyped_from_context", "benchmark"),
        Rule(lambda m: is_a(m, "person", "organization") & any_of(m["blob"], POSTING_WORDS), "posting_context_retyped_to_account", "account", platform="x"),
    ]


#: What a model answers for one episode.
RESPONSE = "mentions array<struct<mention_id:bigint,canonical_name:string,mention_text:string,mention_type:string,context_snippet:string,quoted_text:string,platform:string,sentiment_label:string,confidence:string,is_editorial:boolean>>, new_type_candidates array<string>"


def process_responses(responses: DataFrame, types: list[str], core_types: list[str], tech: bool = True, column: str = "response") -> DataFrame:
    """Model answers to the mentions that a profile loads: read, cleaned, retyped, editorial, of core types or ``other``."""
    clean = sanitize_mentions(parse_responses(responses, RESPONSE, column), types)
    return keep_for_profile(retype_mentions(clean, tech_rules() if tech else [], types), core_types)


# Facts that become tags.
TAG_FACTS = ("modality", "model_modality", "benchmark_domain", "domain", "category")
QUESTION_FACTS = ("contains_survey_questions", "has_survey_questions")
FACT = "struct<fact_key:string,fact_value:string,confidence:double>"


def parse_facts(text: Column) -> Column:
    """Facts from JSON text; blank or unreadable text gives none, elements that are no objects are dropped."""
    parts = F.from_json(F.nullif(F.trim(text), F.lit("")), "array<string>")
    read = F.transform(parts, lambda x: F.from_json(x, FACT))
    return F.filter(F.coalesce(read, F.array().cast(f"array<{FACT}>")), lambda f: f.isNotNull() & (f["fact_key"].isNotNull() | f["fact_value"].isNotNull() | f["confidence"].isNotNull()))


def derive_tags(kind: Column, platform: Column, facts: Column) -> Column:
    """Map of tags (texts) from a mention's type, platform and listed facts; of equal facts the last counts.

    Values stay JSON texts; a question flag is ``false`` for false, 0, null and empty values, else ``true``. Facts, and then
    the last of each kind, are a list of one whose lambda names them, so an expression that reads facts is evaluated once.
    """
    def once(value: Column, f: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(value), f), F.lit(0))

    def lasts(found: Column) -> Column:
        last_of = lambda *keys: F.try_element_at(F.filter(found, lambda f: f["key"].isin(*keys)), F.lit(-1))["value"]
        return F.struct(last_of(*QUESTION_FACTS).alias("asked"), *(last_of(k).alias(k) for k in TAG_FACTS))

    def tags_of(last: Column) -> Column:
        no = F.lower(F.trim(last["asked"])).isin("", "false", "0", "null")
        tags = {"platform": F.nullif(F.lower(platform), F.lit("")), "is_account": F.when(kind == "account", "true"), "is_survey": F.when(kind == "survey", "true"), "contains_survey_questions": F.when(last["asked"].isNotNull(), F.when(no, "false").otherwise("true"))}
        pairs = F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in (tags | {k: last[k] for k in TAG_FACTS}).items()))
        return F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull()))

    # A fact without a value counts as JSON's null.
    keyed = F.transform(facts, lambda f: F.struct(F.lower(F.trim(f["fact_key"])).alias("key"), F.coalesce(f["fact_value"], F.lit("null")).alias("value")))
    return once(keyed, lambda found: once(lasts(found), tags_of))


def _bare(column: str) -> Column:
    """A model's answer without the fence around its JSON."""
    return F.regexp_replace(F.regexp_replace(F.trim(column), "^```(?:json)?\\s*", ""), "\\s*```$", "")


def parse_responses(responses: DataFrame, schema: str, column: str = "response") -> DataFrame:
    """Model answers to one row for each mention; answers without a list of mentions are in rejected_responses()."""
    read = responses.withColumn("__r", F.from_json(_bare(column), schema, {"mode": "PERMISSIVE"}))
    return read.withColumn("m", F.explode("__r.mentions")).drop("__r", column).select("*", "m.*").drop("m")


def rejected_responses(responses: DataFrame, column: str = "response") -> DataFrame:
    """Answers that give no mention, with ``reason``: empty, not_json, not_an_object, no_mentions, mentions_not_a_list.

    The answer is read as a variant, so its shape need not be known. An empty list of mentions is a good answer.
    """
    kind = lambda v: F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    found = F.try_variant_get("__v", "$.mentions", "variant")
    reason = (
        F.when(F.coalesce(F.trim(_bare(column)), F.lit("")) == "", "empty")
        .when(F.col("__v").isNull(), "not_json")
        .when(kind(F.col("__v")) != "OBJECT", "not_an_object")
        .when(found.isNull() | F.is_variant_null(found), "no_mentions")
        .when(kind(found) != "ARRAY", "mentions_not_a_list")
    )
    return responses.withColumn("__v", F.try_parse_json(_bare(column))).withColumn("reason", reason).drop("__v").where("reason is not null")


def response_shape(responses: DataFrame, column: str = "response") -> DataFrame:
    """One row (shape): the schema that all readable answers fit."""
    return responses.select(F.try_parse_json(_bare(column)).alias("v")).where("v is not null").agg(F.schema_of_variant_agg("v").alias("shape"))


def keep_for_profile(mentions: DataFrame, core_types: list[str], editorial_only: bool = True, core_only: bool = True) -> DataFrame:
    """Mentions that a profile loads: editorial ones, of its core types or ``other``."""
    out = mentions
    if editorial_only:
        out = out.where(F.coalesce("is_editorial", F.lit(True)))
    return out.where(F.col("mention_type").isin(*core_types, "other")) if core_only else out


def new_type_candidates(mentions: DataFrame, taxonomy: DataFrame, proposed: str = "proposed_type") -> DataFrame:
    """(type, n): proposed types that the taxonomy (column type) lacks."""
    named = mentions.select(F.explode(proposed).alias("type")).select(F.lower(F.trim("type")).alias("type")).where("type <> ''")
    return named.join(taxonomy.select("type"), "type", "left_anti").groupBy("type").agg(F.count("*").alias("n"))


def link_status(source_url: Column) -> tuple[Column, Column]:
    """Status and confidence of a mention's link at load."""
    has = F.length(F.trim(F.coalesce(source_url, F.lit("")))) > 0
    return F.when(has, "manual_verified").otherwise("missing"), F.when(has, F.lit(1.0))


def suspect_scrapes(pages: DataFrame, text: str, core: list[str], thin_under: int = 500) -> DataFrame:
    """Rows with missing core fields, hardly any text, or markdown left in it, and which of these it is."""
    missing = F.lit(False)
    for c in core:
        missing = missing | F.col(c).isNull()
    body = F.coalesce(F.col(text), F.lit(""))
    out = pages.withColumns({"missing_core": missing, "thin": F.length(body) < thin_under, "markdown_left": body.contains("**") | body.contains("](")})
    return out.where("missing_core or thin or markdown_left")


def source_label(raw: Column, override: Column, name: Column) -> Column:
    """Shown source: the field source_name of the raw JSON without commas (100 characters), else an override, else the name."""
    own = F.nullif(F.trim(F.substring(F.regexp_replace(F.get_json_object(raw, "$.source_name"), ",", ""), 1, 100)), F.lit(""))
    return F.coalesce(own, override, name)


def search_queries(mentions: DataFrame) -> DataFrame:
    """(mention_id, pos, query): what to search for a mention, in order, without repeats."""
    name, kind = F.col("canonical_name"), F.col("mention_type")
    options = F.array(name, F.when(kind.isin("software_product", "organization"), F.concat(name, F.lit(" official site"))), F.when(kind == "report", F.concat(name, F.lit(" report pdf"))), F.when(kind == "social_account", F.concat(name, F.lit(" "), F.coalesce("platform", F.lit("profile")))), F.concat(name, F.lit(" "), F.coalesce(F.regexp_replace(kind, "_", " "), F.lit(""))))
    clean = F.array_distinct(F.filter(F.transform(options, lambda q: F.trim(q)), lambda q: q.isNotNull() & (q != "")))
    return mentions.select("mention_id", F.posexplode(clean).alias("pos", "query"))
