"""Personal data: fixed base kinds, and identifiers that corpus-wide bootstrapping finds by their contexts.

Seeds are the base spans (mail addresses, IPv4 addresses, card and phone numbers) and what stands in a seed pattern (a
label such as ``password=``, or a published format of keys). Every seed and every other token that looks like an
identifier is a mention with lexical patterns: the words beside it, the key glued to it, its label, its format. Spark
scores the graph of patterns and instances in turns: a pattern by the mean score of its distinct instances, an instance
by the chance that one of its patterns is right. Mentions that patterns of high score vouch for become ``found`` spans.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import boxed, stored

KINDS = ("email", "ip", "card", "phone")
#: A pattern counts with at least so many distinct instances, and is accepted from this score on.
MIN_SUPPORT, ACCEPT, TURNS = 5, 0.8, 3
MIN_CHARS, MIN_DIGITS = 8, 3

# Words of labels that name a secret, and published formats of keys.
SECRET_WORDS = ("password", "passwd", "pwd", "passphrase", "secret", "token", "api_key", "api-key", "apikey", "access_key", "access-key", "accesskey", "private_key", "credential")
KEY_FORMATS = {
    "aws": r"A(?:KIA|SIA)[0-9A-Z]{16}",
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "google": r"AIza[0-9A-Za-z_-]{35}",
    "stripe": r"[srp]k_(?:live|test)_[0-9A-Za-z]{16,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
}
#: Score of a seed pattern, whatever its support.
SEED_PATTERN = 0.95
_SEED_PATTERN = "^(F .*|[KL] .*(" + "|".join(SECRET_WORDS) + ")[a-z_-]*[\"')\\]]* ?[:=]+[\"'(\\[]*)$"
_FORMATS = [(name, re.compile(form)) for name, form in KEY_FORMATS.items()]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Dotted digits can only start where a run of digits starts; the look-behind keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
_TRIM = "\"'`()[]{}<>,.;:!?|*#%&"


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping; found from the @ signs, as only there a match can be."""
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            spans.append((start, host.end()))
            free = host.end()
        at = text.find("@", max(at + 1, free))
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in order of start, then of kind as listed."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m.group())
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return [(a, b, KINDS[k]) for a, k, b in sorted(found)]


_LETTER = re.compile(r"[^\W\d_]")


def _near(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a mention: glued key, label with a colon, two words before, words on both sides, format.

    A single common word says nothing about what follows it, so it's no pattern; nor do signs, so each side of a pattern
    holds a word with a letter: cells of a table and quoted numbers have no context but their own words.
    """
    before, behind = text[max(0, start - 80) : start], text[end : end + 40]
    glued = re.search(r"\S+$", before)
    key = glued.group().lower()[-40:] if glued else ""
    words = [w.lower()[-40:] for w in (before[: glued.start()] if glued else before).split()[-2:]]
    nxt = behind.split()[:1]
    patterns = ["K " + key] if _LETTER.search(key) else []
    if words and words[-1][-1] in ":=#":
        # A sign that stands alone belongs to the word before it.
        patterns.append("L " + (" ".join(words) if len(words[-1]) == 1 else words[-1]))
    if len(words) == 2 and _LETTER.search(words[0]) and _LETTER.search(words[1] + key):
        patterns.append("LL " + " ".join(words) + " " + key)
    if words and nxt and _LETTER.search(words[-1] + key) and _LETTER.search(nxt[0]):
        patterns.append("LR " + words[-1] + " " + key + " " + nxt[0].lower()[:40])
    patterns = [p for p in patterns if _LETTER.search(p[2:]) and not _DIGITS.search(p)]
    return patterns + ["F " + name for name, form in _FORMATS if form.fullmatch(text, start, end)]


#: What is no identifier: dates, times, versions, amounts and plain numbers. Such mentions count against their patterns.
_PLAIN = re.compile(r"[$€£~±+-]?\d+(?:[.,:/\u2013-]\d+)*(?:[.,]\d+)?(?:st|nd|rd|th|%|[a-z]{1,2})?|\d{4}-\d\d?-\d\d?[T_]\d\d?:\d\d(?::\d\d(?:\.\d+)?)?(?:Z|[+-]\d\d:?\d\d)?|[vV]\d+(?:\.\d+)*")


def mentions(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, bool, list[str]]]:
    """(start, end, instance, is a seed, patterns) of base spans and of other tokens that look like identifiers."""
    out = [(a, b, text[a:b], True, _near(text, a, b)) for a, b, _ in base]
    done = 0
    for m in _DIGITS.finditer(text):
        if m.start() < done:
            continue
        a, b = m.start(), m.end()
        while a > done and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        done = b
        if (cut := text.rfind("=", a, b - 1)) >= 0:
            a = cut + 1
        while a < b and text[a] in _TRIM:
            a += 1
        if a and text[a - 1] in "\"'`" and (end := text.find(text[a - 1], a, b)) >= 0:
            b = end
        while b > a and text[b - 1] in _TRIM:
            b -= 1
        token = text[a:b]
        if len(token) >= MIN_CHARS and sum(c.isdigit() for c in token) >= MIN_DIGITS and not any(a < y and x < b for x, y, _ in base):
            out.append((a, b, token, False, _near(text, a, b)))
    return out


def is_plain(token: str) -> bool:
    return _PLAIN.fullmatch(token) is not None


SPAN = "array<struct<start:bigint,end:bigint,kind:string>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, n_email, n_ip, n_card, n_phone, base, seen): hash of the text, base spans and mentions of every whole text."""

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                seen = mentions(text, base) if _DIGITS.search(text) or base else []
                rows.append(
                    {f"n_{k}": sum(x[2] == k for x in base) for k in KINDS}
                    | {"base": [{"start": a, "end": b, "kind": k} for a, b, k in base]}
                    | {"seen": [{"start": a, "end": b, "instance": hashlib.sha256(i.encode()).hexdigest()[:32], "seed": s, "plain": not s and is_plain(text[a:b]), "patterns": p} for a, b, i, s, p in seen]}
                )
            got = pa.Table.from_pylist(rows, schema=_SCAN).combine_chunks().to_batches()
            for part in got:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *part.columns], ["doc_id", "th", *part.schema.names])

    schema = f"doc_id {docs.select(id_col).schema[0].dataType.simpleString()}, th long, n_email long, n_ip long, n_card long, n_phone long, base {SPAN}, seen array<struct<start:bigint,end:bigint,instance:string,seed:boolean,plain:boolean,patterns:array<string>>>"
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th")).mapInArrow(run, schema)


_SEEN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()), ("seed", pa.bool_()), ("plain", pa.bool_()), ("patterns", pa.list_(pa.string()))])
_SCAN = pa.schema([*((f"n_{k}", pa.int64()) for k in KINDS), ("base", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))), ("seen", pa.list_(_SEEN))])


def pattern_scores(scanned: DataFrame, turns: int = TURNS, min_support: int = MIN_SUPPORT) -> DataFrame:
    """(pattern, score) after ``turns`` rounds over the graph of patterns and instances.

    Edges are distinct pairs, so copies of a text add nothing. Both directions are plain grouped sums. Dates and plain
    numbers are counter-examples: they keep the score 0 and count twice in the mean of a pattern.
    """
    edges = scanned.select(F.explode("seen").alias("m")).select("m.instance", "m.seed", "m.plain", F.explode("m.patterns").alias("pattern"))
    edges = stored(edges.groupBy("instance", "pattern").agg(F.max("seed").alias("seed"), F.min("plain").alias("plain")), "pii-edges")
    known = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("seed"), F.min("plain").alias("plain"))
    score = stored(known.withColumn("score", F.col("seed")), "pii-instances")
    patterns = None
    for _ in range(turns):
        rated = edges.select("instance", "pattern").join(score.select("instance", "score", "plain"), "instance")
        # One instance of doubt is added to each pattern, so a few seeds alone never make it certain.
        rate = F.col("s") / (F.col("n") + 1)
        seed = F.col("pattern").rlike(_SEED_PATTERN)
        patterns = rated.groupBy("pattern").agg((F.count("*") + F.count_if("plain")).alias("n"), F.sum("score").alias("s")).where(seed | (F.col("n") >= min_support))
        patterns = stored(patterns.select("pattern", F.when(seed, F.greatest(rate, F.lit(SEED_PATTERN))).otherwise(rate).alias("rate")), "pii-patterns")
        vouched = edges.select("instance", "pattern").join(patterns, "pattern").groupBy("instance").agg((1 - F.exp(F.sum(F.log1p(-F.least(F.lit(0.999), F.col("rate")) * 0.9)))).alias("v"))
        score = stored(score.select("instance", "seed", "plain").join(vouched, "instance", "left").select("instance", "seed", "plain", F.greatest("seed", F.when(F.col("plain"), 0.0).otherwise(F.coalesce("v", F.lit(0.0)) * 0.95)).alias("score")), "pii-instances")
    return patterns.withColumnRenamed("rate", "score")


def discovered(scanned: DataFrame, patterns: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, th, found): spans of mentions that are no base spans and stand in a context of an accepted pattern.

    Dates and plain numbers are found behind the label of a secret alone.
    """
    m = scanned.select("doc_id", "th", F.explode("seen").alias("m")).where("not m.seed").select("doc_id", "th", "m.start", "m.end", "m.plain", F.explode("m.patterns").alias("pattern"))
    fits = ~F.col("plain") | F.col("pattern").rlike(_SEED_PATTERN)
    hit = m.join(patterns.where(F.col("score") >= accept).select("pattern"), "pattern").where(fits).select("doc_id", "th", "start", "end").distinct()
    # Spans of one text only; their number is bounded by its length.
    return hit.groupBy("doc_id", "th").agg(F.array_sort(F.collect_list(F.struct("start", "end", F.lit("found").alias("kind")))).alias("found"))


def _with_found(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Adds ``found`` to rows (doc_id, th, ...), by id and text; null ids are a value like any other."""
    found = found.withColumnsRenamed({"doc_id": "__doc", "th": "__text"})
    both = rows.join(found, rows["doc_id"].eqNullSafe(found["__doc"]) & rows["th"].eqNullSafe(found["__text"]), "left").drop("__doc", "__text")
    return both.withColumn("found", F.coalesce("found", F.array().cast(SPAN)))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, n_email, n_ip, n_card, n_phone, base, found): spans in code points, end exclusive.

    Null and empty texts have no span; very long ones are read whole. Each row gets the spans of its own text, also rows
    that repeat an id or have none (``th`` is the text's hash). Spans that start together stand in the order of kinds. An
    empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    scanned = stored(scan(docs, id_col, text_col), "pii-scan")
    found = discovered(scanned, pattern_scores(scanned))
    return _with_found(scanned, found).select("doc_id", "th", *(f"n_{k}" for k in KINDS), "base", "found")


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base kinds, base_sha256, all spans as text, and how many were found and are there in all."""
    rows = find_pii(docs)
    rank = lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*(F.lit(k) for k in (*KINDS, "found"))), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    every = F.array_sort(F.transform(F.concat("base", "found"), rank))
    return rows.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined(every).alias("spans"), F.size("found").cast("long").alias("n_found"), (F.size("base") + F.size("found")).cast("long").alias("n_spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first.

    All rows and columns stay, whatever their names. A text without personal data is unchanged; a null text stays null.
    Each row is covered by the spans of its own text, also where an id stands on several rows or is missing. Very long
    texts are read whole; an empty table stays empty.
    """
    text = F.col(text_col).cast("string")
    rows = boxed(docs, doc_id=F.col(id_col), text=text, th=F.xxhash64(text))
    found = find_pii(docs, id_col, text_col).where(F.size("found") > 0).groupBy("doc_id", "th").agg(F.first("found").alias("found"))

    @F.pandas_udf("string")
    def cover(texts, more):
        import pandas as pd

        out = []
        for text, extra in zip(texts, more, strict=True):
            if text is None or not (_DIGITS.search(text) or "@" in text):
                out.append(text)
                continue
            base = base_spans(text)
            spans = sorted([(a, b, k) for a, b, k in base] + [(x["start"], x["end"], x["kind"]) for x in extra])
            parts, at = [], 0
            for a, b, kind in spans:
                if a >= at:
                    parts += [text[at:a], f"[{kind.upper()}]"]
                at = max(at, b)
            out.append("".join(parts) + text[at:])
        return pd.Series(out, dtype=object)

    covered = _with_found(rows, found).select("row", cover("text", "found").alias("covered"))
    return covered.select(*(F.col("covered").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
