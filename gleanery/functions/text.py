"""Column expressions for names, texts and hashes. All run inside Spark's generated code unless said otherwise."""


import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _blank_free(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "(?U)\\s+", " "))


def entity_key(c: Column) -> Column:
    """Key of an entity's name: lower case; blanks, hyphens and underscores are one blank; other signs go."""
    spaced = F.regexp_replace(F.lower(c), "(?U)[\\s\\-_]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(spaced, "[^a-z0-9 ]", ""), " +", " "))


def alias_key(c: Column) -> Column:
    """Key of an alias: every run of other signs than letters and digits is one blank."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def compact_key(c: Column) -> Column:
    """entity_key without blanks; names that differ only in spacing share it."""
    return F.regexp_replace(entity_key(c), "[^a-z0-9]", "")


def collapse_blanks(c: Column) -> Column:
    return _blank_free(c)


def match_form(c: Column) -> Column:
    """Lower-case words with single blanks between, punctuation dropped."""
    return F.trim(F.regexp_replace(F.lower(c), "(?U)[\\W_]+", " "))


def strip_quotes(c: Column) -> Column:
    """Without straight or curly quotes at either end."""
    return F.regexp_replace(c, "^[\"'“”‘’]+|[\"'“”‘’]+$", "")


def input_hash(c: Column, most: int) -> Column:
    """SHA-256 of the first ``most`` characters, the text that was given to a model."""
    return F.sha2(F.substring(c, 1, most).cast("binary"), 256)


def slug(c: Column, most: int = 120) -> Column:
    """Lower-case letters and digits joined by hyphens, at most ``most`` characters."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.regexp_replace(F.substring(s, 1, most), "-+$", "")


def word_count(c: Column) -> Column:
    """Words between blanks; 0 for null and blank texts."""
    return F.coalesce(F.regexp_count(c, F.lit("\\S+")), F.lit(0)).cast("long")


def confidence_band(c: Column) -> Column:
    """HIGH from 0.90, MEDIUM from 0.70, else LOW."""
    return F.when(c >= 0.90, "HIGH").when(c >= 0.70, "MEDIUM").otherwise("LOW")


def short_quote(c: Column, most: int = 240) -> Column:
    """A text of up to twice ``most`` characters whole; else its first and last words with an ellipsis between."""
    flat = _blank_free(c)
    head = F.regexp_replace(F.substring(flat, 1, most), " [^ ]*$", "")
    tail = F.regexp_replace(F.substring(flat, -most, most), "^[^ ]* ", "")
    return F.when(F.length(flat) <= 2 * most, flat).otherwise(F.concat(head, F.lit(" … "), tail))


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


def html_to_text(c: Column) -> Column:
    """Visible text: scripts, styles and tags go, entities are read, no blank stands before punctuation.

    Only entities need Python (one vectorised function); the tags are cut first, so less text crosses over.
    """
    bare = F.regexp_replace(F.regexp_replace(c, "(?is)<(script|style)\\b.*?</\\1\\s*>|<!--.*?-->", " "), "(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(_blank_free(_unescape(bare)), " +([.,;:!?])", "$1"))


def subtitle_text(c: Column) -> Column:
    """Spoken text of VTT or SRT: no header, cue numbers, timing lines or markup; one blank between lines."""
    lines = F.transform(F.split(c, "\\r?\\n"), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]*>", " "), "(?U)\\s+", " ")))
    kept = F.filter(lines, lambda x: (x != "") & ~x.rlike("^\\d+$") & ~x.contains("-->") & ~x.rlike("^(WEBVTT|NOTE|Kind:|Language:)"))
    return F.array_join(kept, " ")


def token_cost(prompt: Column, completion: Column, per_million_in: Column, per_million_out: Column) -> Column:
    """Price of a call from its tokens and a model's prices for a million tokens each."""
    return prompt * per_million_in / 1_000_000 + completion * per_million_out / 1_000_000
