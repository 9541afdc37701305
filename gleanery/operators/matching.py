"""Fuzzy matches of titles, songs, passages and links. Candidates always come from an equality join on blocking keys."""

from __future__ import annotations

import decimal
import difflib
import math
import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..functions.text import confidence_band, match_form
from ..functions.urls import host
from .search import words


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of characters in matching blocks."""
    return pd.Series([None if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype=float)


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-word row at a time (bit-parallel)."""
    where: dict[str, int] = {}
    for k, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << k
    full = (1 << len(a)) - 1
    s = full
    for ch in b:
        u = s & where.get(ch, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - bin(s).count("1")


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """2 * LCS over both lengths, rounded to hundredths; 0 where one is missing."""
    out = []
    for x, y in zip(a, b, strict=True):
        n = len(x or "") + len(y or "")
        out.append(round(100 * 2 * _lcs(x, y) / n) / 100 if n and x and y else 0.0)
    return pd.Series(out, dtype=float)


#: Rows that a packed block holds, about; two blocks at a time are all that a task keeps.
BLOCK = 1024
#: Neighbouring classes of lengths differ by this factor, and classes of floors by a tenth.
LENGTHS = 1.15


def _by_length(left: DataFrame, right: DataFrame, lid: str, ltext: str, rid: str, rtext: str, same: list[str], most_common: int, floor: float) -> DataFrame:
    """(lid, rid) pairs that share a token (and the columns ``same``), found without a quadratic bucket of a frequent word.

    Tokens of at most ``most_common`` rows on the right side pair rows as they are, equal texts always meet. Over more
    frequent tokens rows meet if their lengths allow the ratio ``floor`` of matching characters (2 * matches over both
    lengths), so no pair that reaches it is lost.
    """
    rt = right.select(rid, *same, F.length(rtext).alias("rl"), F.explode(F.array_distinct(words(F.col(rtext)))).alias("t"))
    lt = left.select(lid, *same, F.length(ltext).alias("ll"), F.explode(F.array_distinct(words(F.col(ltext)))).alias("t"))
    freq = rt.groupBy("t").agg(F.count("*").alias("n"))
    rare, often = freq.where(F.col("n") <= most_common).select("t"), freq.where(F.col("n") > most_common).select("t")
    equal = left.select(lid, *same, F.col(ltext).alias("x")).join(right.select(rid, *same, F.col(rtext).alias("x")), ["x", *same])
    found = lt.join(rt.join(rare, "t"), ["t", *same]).select(lid, rid).unionByName(equal.select(lid, rid))
    # Lengths of a pair that reaches the floor differ at most by this factor: one class of lengths or the next.
    factor = math.log((2 - floor) / floor)
    step = lambda c: F.floor(F.log(F.greatest(F.col(c), F.lit(1))) / factor).cast("int")
    near = rt.join(often, "t").withColumn("c", F.explode(F.array(*(step("rl") + d for d in (-1, 0, 1)))))
    fits = 2 * F.least("ll", "rl") >= floor * (F.col("ll") + F.col("rl")) - 1e-9
    more = lt.withColumn("c", step("ll")).join(near, ["t", "c", *same]).where(fits)
    return found.unionByName(more.select(lid, rid)).distinct()


def resolve_titles(wanted: DataFrame, episodes: DataFrame, least: float = 0.85, most_common: int = 1000) -> DataFrame:
    """(wanted_id, episode_id, ratio): equal titles first (lower case, same source), else the best ratio from ``least`` on.

    ``wanted`` (wanted_id, source, title), ``episodes`` (episode_id, source, title). Ties go to the least episode_id.
    Equal titles of a source are one title, on either side.
    """
    w = wanted.withColumn("lt", F.lower(F.trim("title")))
    e = episodes.withColumn("lt", F.lower(F.trim("title"))).groupBy("source", "lt").agg(F.min("episode_id").alias("episode_id"))
    exact = w.join(e, ["source", "lt"]).select("wanted_id", "episode_id", F.lit(1.0).alias("ratio"))
    rest = w.join(exact.select("wanted_id"), "wanted_id", "left_anti")
    asked = rest.groupBy("source", "lt").agg(F.min("wanted_id").alias("ask"))
    pairs = _by_length(asked, e, "ask", "lt", "episode_id", "lt", ["source"], most_common, least)
    scored = pairs.join(asked.select("ask", F.col("lt").alias("a")), "ask").join(e.select("episode_id", F.col("lt").alias("b")), "episode_id").withColumn("ratio", sequence_ratio("a", "b")).where(F.col("ratio") >= least)
    best = scored.groupBy("ask").agg(F.max(F.struct("ratio", (-F.col("episode_id")).alias("k"))).alias("x"))
    named = rest.join(asked.join(best, "ask"), ["source", "lt"])
    return exact.unionByName(named.select("wanted_id", (-F.col("x.k")).alias("episode_id"), F.col("x.ratio").alias("ratio")))


def weighted_title_match(wanted: DataFrame, episodes: DataFrame, floor: float = 0.80, most_common: int = 1000) -> DataFrame:
    """(wanted_id, episode_id, score): 0.7 title + 0.3 source similarity, source 0.5 where one is unknown, title from ``floor`` on.

    Rows of equal title and source are one row, on either side.
    """
    form = lambda rows: rows.withColumns({"lt": match_form(F.col("title")), "ls": F.lower("source")})
    w = form(wanted)
    e = form(episodes).groupBy("lt", "ls").agg(F.min("episode_id").alias("episode_id"))
    asked = w.groupBy("lt", "ls").agg(F.min("wanted_id").alias("ask"))
    pairs = _by_length(asked, e, "ask", "lt", "episode_id", "lt", [], most_common, floor)
    x = pairs.join(asked.select("ask", F.col("lt").alias("a"), F.col("ls").alias("sa")), "ask").join(e.select("episode_id", F.col("lt").alias("b"), F.col("ls").alias("sb")), "episode_id")
    x = x.withColumn("t", sequence_ratio("a", "b")).where(F.col("t") >= floor).withColumn("s", F.coalesce(sequence_ratio("sa", "sb"), F.lit(0.5)))
    x = x.withColumn("score", F.round(0.7 * F.col("t") + 0.3 * F.when(F.isnan("s"), 0.5).otherwise(F.col("s")), 4))
    best = x.groupBy("ask").agg(F.max(F.struct("score", (-F.col("episode_id")).alias("k"))).alias("m"))
    named = asked.join(best, "ask").select(F.col("lt").alias("nt"), F.col("ls").alias("ns"), "m")
    return w.join(named, F.col("lt").eqNullSafe(F.col("nt")) & F.col("ls").eqNullSafe(F.col("ns"))).select("wanted_id", (-F.col("m.k")).alias("episode_id"), F.col("m.score").alias("score"))


def _with_tokens(rows: DataFrame, text: str, freq: DataFrame | None = None) -> DataFrame:
    """A row for each distinct token ``t`` of a text; a text without any has itself as its token.

    With ``freq`` (t, n) tokens that it doesn't hold go, and ``place`` numbers a text's tokens from the rarest on.
    """
    own = F.array_distinct(words(F.col(text)))
    rows = rows.withColumn("t", F.explode(F.when(F.size(own) > 0, own).otherwise(F.array(F.concat(F.lit("\0"), F.col(text))))))
    if freq is None:
        return rows
    keys = [c for c in rows.columns if c != "t"]
    # Tokens of one text only; equal texts are one row.
    near = rows.join(freq, "t").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("n", "t"))).alias("ts"))
    return near.select(*keys, F.posexplode("ts").alias("place", "x")).select(*keys, "place", F.col("x.t").alias("t"))


def _packed(rows: DataFrame, classes: list[str], measures: list[Column], block: int) -> DataFrame:
    """Blocks (t, classes..., split, measures..., rows) of about ``block`` rows; a frequent token has many blocks."""
    n = rows.groupBy("t", *classes).agg(F.count("*").alias("__n"))
    payload = [c for c in rows.columns if c not in ("t", *classes)]
    split = F.pmod(F.xxhash64(*payload), F.ceil(F.col("__n") / block)).cast("int")
    dealt = rows.join(n, ["t", *classes]).withColumn("split", split)
    return dealt.groupBy("t", *classes, "split").agg(*measures, F.collect_list(F.struct(*payload)).alias("rows"))


def _meeting_blocks(left: DataFrame, right: DataFrame, reach: Column, block: int) -> DataFrame:
    """(lrows, rrows): packed blocks of rows (t, length, floor, ...) and (t, length, ...) that share a token.

    Rows lie in blocks with others of like length (and floor, on the left). ``reach`` is the greatest score that lengths
    l1..l2 and r1..r2 of two blocks allow; blocks that stay under the left block's least floor don't meet. Which blocks
    meet is found on their measures alone, then each block is sent there by its own key, so a frequent token is many
    small tasks and no row of the result exceeds two blocks.
    """
    size = F.floor(F.log(F.greatest("length", F.lit(1))) / math.log(LENGTHS)).cast("int")
    lb = _packed(left.withColumns({"lc": size, "fc": F.floor(F.col("floor") * 10).cast("int")}), ["lc", "fc"], [F.min("length").alias("l1"), F.max("length").alias("l2"), F.min("floor").alias("least")], block)
    rb = _packed(right.withColumn("rc", size), ["rc"], [F.min("length").alias("r1"), F.max("length").alias("r2")], block)
    lb, rb = lb.withColumnRenamed("split", "ls"), rb.withColumnRenamed("split", "rs")
    meets = lb.drop("rows").join(rb.drop("rows"), "t").where(reach >= F.col("least")).select("t", "lc", "fc", "ls", "rc", "rs")
    return meets.join(lb.select("t", "lc", "fc", "ls", F.col("rows").alias("lrows")), ["t", "lc", "fc", "ls"]).join(rb.select("t", "rc", "rs", F.col("rows").alias("rrows")), ["t", "rc", "rs"]).select("lrows", "rrows")


def _half_up(x: float, digits: int) -> float:
    """Rounded as Spark rounds a double: the shortest decimal that stands for it, halves up."""
    return float(decimal.Decimal(repr(float(x))).quantize(decimal.Decimal(1).scaleb(-digits), decimal.ROUND_HALF_UP))


def _bags(texts: list[str]) -> np.ndarray:
    """How often each of 64 classes of characters occurs; the sum of the lesser counts of two texts bounds their LCS."""
    out = np.zeros((len(texts), 64), np.uint8)
    for k, t in enumerate(texts):
        got = np.bincount(np.frombuffer(t.encode("utf-32-le"), np.uint32) & 63, minlength=64)
        out[k] = np.minimum(got, 255)
    return out


def _ratio(lcs, n):
    """2 * LCS over both lengths, rounded to hundredths."""
    return np.where(n > 0, np.rint(100 * 2 * lcs / np.maximum(n, 1)) / 100, 0.0)


def _best_songs(lrows: list, rrows: list) -> list[tuple]:
    """(a, artist, score, catalog_id) of the best row for each song that reaches its floor; rows that can't win aren't compared.

    Candidates come by descending bounds from bags of characters; the first bound under the best score ends the search.
    """
    titles, sizes = [r["b"] for r in rrows], np.array([len(r["b"]) for r in rrows])
    names = [x or "" for r in rrows for x in (r["artists"] or [""])]
    first = np.concatenate([[0], np.cumsum([len(r["artists"] or [""]) for r in rrows])])[:-1]
    tb, nb, ns = _bags(titles), _bags(names), np.array([len(x) for x in names])
    long = max((*map(len, titles), *map(len, names)), default=0) > 255
    out = []
    for row in lrows:
        a, artist = row["a"], row["artist"] or ""
        bound = lambda bags, text, n: _ratio(np.minimum(np.minimum(bags, _bags([text])).sum(1, dtype=np.int64), np.minimum(n, len(text))), n + len(text)) * ((n > 0) & (len(text) > 0))
        if long or len(a) > 255 or len(artist) > 255:
            reach = np.ones(len(titles))
        else:
            reach = 0.55 * bound(tb, a, sizes) + 0.45 * np.maximum.reduceat(bound(nb, artist, ns), first)
        best, key = row["floor"], None
        for j in np.argsort(-reach, kind="stable").tolist():
            if reach[j] + 0.0006 < best:
                break
            t = float(_ratio(_lcs(a, titles[j]), len(a) + len(titles[j]))) if a and titles[j] else 0.0
            r = max((float(_ratio(_lcs(artist, x), len(artist) + len(x))) if artist and x else 0.0 for x in (rrows[j]["artists"] or [])), default=0.0)
            score = _half_up(0.55 * t + 0.45 * r, 3)
            if score > best or score == best and (key is None or rrows[j]["catalog_id"] < key):
                best, key = score, rrows[j]["catalog_id"]
        if key is not None:
            out.append((a, row["artist"], best, key))
    return out


def _each_meeting(meetings: DataFrame, best, schema: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                found = best(batch.column(0)[k].as_py(), batch.column(1)[k].as_py())
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*found, strict=True)], names).cast(kinds)

    empty = meetings.sparkSession.createDataFrame([], schema)
    names = empty.columns
    kinds = to_arrow_schema(empty.schema)
    return meetings.mapInArrow(run, schema)


def match_catalog(songs: DataFrame, catalog: DataFrame, block: int = BLOCK) -> DataFrame:
    """(song_id, catalog_id, score, band): 0.55 title + 0.45 artist similarity, the best candidate, NOT_FOUND without any.

    ``songs`` (song_id, title, artist), ``catalog`` (catalog_id, title, artists array). Candidates are all catalog rows
    that share a word of the title, however frequent it is; ties go to the least catalog_id. Songs of equal title and
    artist are one question, equal catalog rows one answer. Null titles have no candidates.

    Each song asks the blocks of its rarest word first. What it finds there is its floor for the blocks of its other
    words: blocks whose lengths can't reach it aren't met, and rows whose characters can't aren't compared.
    """
    form = lambda c: match_form(F.col(c))
    artists = F.array_sort(F.transform("artists", lambda x: match_form(x)))
    c = catalog.select(form("title").alias("b"), artists.alias("artists"), "catalog_id").where("b is not null").groupBy("b", "artists").agg(F.min("catalog_id").alias("catalog_id"))
    keyed = songs.select("song_id", form("title").alias("a"), form("artist").alias("artist"))
    s = keyed.where("a is not null").select("a", "artist").distinct()
    right = _with_tokens(c, "b").withColumn("length", F.length("b"))
    left = _with_tokens(s, "a", right.groupBy("t").agg(F.count("*").alias("n"))).withColumn("length", F.length("a"))
    near = 2 * F.least("l2", "r2") / (F.least("l2", "r2") + F.greatest("l1", "r1"))
    reach = F.when(F.greatest("l1", "r1") <= F.least("l2", "r2"), 1.0006).otherwise(0.55 * F.coalesce(near, F.lit(1.0)) + 0.4566)
    schema = f"a string, artist string, score double, catalog_id {c.schema['catalog_id'].dataType.simpleString()}"
    ask = lambda rows: _each_meeting(_meeting_blocks(rows, right, reach, block), _best_songs, schema)
    top = lambda rows: rows.groupBy("a", "artist").agg(F.max(F.struct("score", (-F.col("catalog_id")).alias("k"))).alias("m"))
    first = top(ask(left.where("place = 0").withColumn("floor", F.lit(0.0))))
    floors = first.select(F.col("a").alias("fa"), F.col("artist").alias("fr"), F.col("m.score").alias("floor"))
    rest = left.where("place > 0").join(floors, (F.col("a") == F.col("fa")) & F.col("artist").eqNullSafe(F.col("fr"))).drop("fa", "fr")
    more = ask(rest).unionByName(first.select("a", "artist", F.col("m.score").alias("score"), (-F.col("m.k")).alias("catalog_id")))
    best = top(more).select(F.col("a").alias("ba"), F.col("artist").alias("br"), "m")
    out = keyed.join(best, (F.col("a") == F.col("ba")) & F.col("artist").eqNullSafe(F.col("br")), "left")
    return out.select("song_id", (-F.col("m.k")).alias("catalog_id"), F.col("m.score").alias("score"), F.when(F.col("m").isNull(), "NOT_FOUND").otherwise(confidence_band(F.col("m.score"))).alias("band"))


def whole_words(needle: list[str], least: float) -> int:
    """Whole words that every stretch of ``least`` of a needle's characters holds, however it is laid."""
    text = " ".join(needle)
    ends, starts, at = [], [], 0
    for w in needle:
        starts.append(at)
        ends.append(at + len(w))
        at += len(w) + 1
    size = int(len(text) * least)
    return min((sum(a <= s and e <= a + size for s, e in zip(starts, ends, strict=True)) for a in range(len(text) - size + 1)), default=0)


def laid_block(needle: list[str], text: list[str], at: int) -> tuple[int, int, int]:
    """(characters, first word, characters before it) of the longest common block of a needle laid on a text from word ``at`` on.

    A block is a run of equal words with the characters that their neighbours share at either end, as it stands in both
    texts when words are joined by blanks. Of equally long ones the first counts.
    """
    best, j = (0, 0, 0), 0
    fits = lambda k: 0 <= k < len(needle) and 0 <= at + k < len(text)
    while j < len(needle):
        if not (fits(j) and needle[j] == text[at + j]):
            j += 1
            continue
        first = j
        while fits(j) and needle[j] == text[at + j]:
            j += 1
        before = after = 0
        if fits(first - 1):
            before = 1 + len(os.path.commonprefix([needle[first - 1][::-1], text[at + first - 1][::-1]]))
        if fits(j):
            after = 1 + len(os.path.commonprefix([needle[j], text[at + j]]))
        size = before + sum(map(len, needle[first:j])) + j - first - 1 + after
        if size > best[0]:
            best = (size, first, before)
    return best


@F.pandas_udf(IntegerType())
def _whole_words(needles: pd.Series, least: pd.Series) -> pd.Series:
    return pd.Series([min(5, max(1, whole_words(list(n), x))) for n, x in zip(needles, least, strict=True)], dtype="int32")


@F.pandas_udf(StructType([StructField(c, IntegerType()) for c in ("size", "first", "before")]))
def _laid_block(needles: pd.Series, texts: pd.Series, at: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([laid_block(list(n), list(t), a) for n, t, a in zip(needles, texts, at, strict=True)], columns=["size", "first", "before"]).astype("int32")


def _longest_blocks(needles: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """(passage_id, doc_id, at, size, length): where the longest common block lays a needle on a text, if it is long enough.

    ``needles`` (passage_id, needle) are short lists of words, ``docs`` (doc_id, w) all words of texts. Every block that is long enough holds a run of whole words
    of known width, so such runs of both sides meet in an equality join; each meeting lays the needle on the text, and the
    places that differ are compared word by word.
    """
    def runs(rows: DataFrame, words_: str, *keep: str, width: Column) -> DataFrame:
        at = F.explode(F.sequence(F.lit(0), F.size(words_) - width))
        return rows.where(F.size(words_) >= width).select(*keep, width.alias("k"), words_, at.alias("pos")).select(*keep, "k", "pos", F.xxhash64("k", F.array_join(F.slice(words_, F.col("pos") + 1, F.col("k")), " ")).alias("h"))

    n = needles.where("size(needle) > 0").withColumn("width", _whole_words("needle", F.lit(least)))
    asked = runs(n, "needle", "passage_id", width=F.col("width")).select("passage_id", "h", F.col("pos").alias("np"))
    widths = n.select("width").distinct()  # five at most
    held = runs(docs.crossJoin(F.broadcast(widths)), "w", "doc_id", width=F.col("width")).select("doc_id", "h", "pos")
    laid = held.join(asked, "h").select("passage_id", "doc_id", (F.col("pos") - F.col("np")).alias("at")).distinct()
    # Only the words under the needle and one on either side go to the comparison.
    low = F.greatest(F.col("at") - 1, F.lit(0))
    x = laid.join(needles, "passage_id").join(docs, "doc_id").withColumn("part", F.slice("w", low + 1, F.size("needle") + 2)).withColumn("block", _laid_block("needle", "part", F.col("at") - low))
    length = F.length(F.array_join("needle", " "))
    x = x.select("passage_id", "doc_id", "at", "block.*", length.alias("length")).where(F.col("size") >= F.floor(F.col("length") * F.lit(least)))
    # The longest, then the one that begins first in the text, then in the needle.
    rank = F.struct(F.col("size"), -(F.col("at") + F.col("first")), F.col("before"), -F.col("first"))
    return x.groupBy("passage_id", "doc_id").agg(F.max_by(F.struct("at", "size", "length"), rank).alias("b")).select("passage_id", "doc_id", "b.*")


def locate_passages(passages: DataFrame, docs: DataFrame, window: int = 12, least: float = 0.6, least_words: int = 1) -> DataFrame:
    """(passage_id, doc_id, first_word, last_word, words, share): where a passage stands in a text, punctuation and case ignored.

    The first ``window`` words of a passage are laid where the text holds the longest block of characters in common with
    them; the block must make ``least`` of their characters, its part is ``share``. The last ``window`` words are looked
    for from there on in the same way and give ``last_word``, else null. Short passages are looked for too, unless
    ``least_words`` says otherwise. A block that holds no whole word isn't seen. Null and wordless texts hold nothing;
    ids must be unique.
    """
    p = passages.select("passage_id", words(F.col("text")).alias("p")).where(F.size("p") >= least_words)
    d = docs.select("doc_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    cut = lambda start: p.select("passage_id", F.slice("p", start, F.lit(window)).alias("needle"))
    head = _longest_blocks(cut(F.lit(1)), d, least)
    # For the tail a text begins where the head was found; a pair is a text of its own.
    since = F.greatest(F.col("at"), F.lit(0))
    pairs = head.select(F.struct("passage_id", "doc_id").alias("pair"), "passage_id", "doc_id", since.alias("since"))
    rest = pairs.join(d, "doc_id").select(F.col("pair"), "passage_id", "since", F.expr("slice(w, since + 1, size(w))").alias("w"))
    ends = _longest_tails(cut(F.greatest(F.size("p") - window, F.lit(0)) + 1), rest, least)
    out = head.join(p.select("passage_id", F.size("p").alias("words")), "passage_id").join(ends, ["passage_id", "doc_id"], "left")
    return out.select("passage_id", "doc_id", since.alias("first_word"), "last_word", "words", F.round(F.col("size") / F.col("length"), 4).alias("share"))


def _longest_tails(tails: DataFrame, rest: DataFrame, least: float) -> DataFrame:
    """(passage_id, doc_id, last_word): the tail of each pair's passage in the rest of its text, which few rows have."""
    x = rest.join(tails, "passage_id")
    best = x.withColumn("b", _tail_block("needle", "w", F.lit(least))).where(F.col("b").isNotNull())
    return best.select("pair.*", (F.col("since") + F.least(F.col("b") + F.size("needle"), F.size("w")) - 1).alias("last_word"))


@F.pandas_udf(IntegerType())
def _tail_block(needles: pd.Series, texts: pd.Series, least: pd.Series) -> pd.Series:
    """Where the longest block lays a needle on a text, or null: only places with a common word are looked at."""
    out: list[int | None] = []
    for needle, text, share in zip(needles, texts, least, strict=True):
        needle, text, own = list(needle), list(text), {}
        for j, w in enumerate(needle):
            own.setdefault(w, []).append(j)
        places = {k - j for k, w in enumerate(text) if w in own for j in own[w]}
        found = [(size, -(at + first), before, -first, at) for at in places for size, first, before in (laid_block(needle, text, at),)]
        best = max(found, default=None)
        out.append(best[4] if best and best[0] >= int(len(" ".join(needle)) * share) else None)
    return pd.Series(out, dtype="Int32")


def _best_links(keep: int):
    """For each mention of a block its ``keep`` best addresses among the links of another, by score, then address."""

    def best(lrows: list, rrows: list) -> list[tuple]:
        holds: dict[str, list[int]] = {}
        for k, r in enumerate(rrows):
            for w in set(r["lt"]):
                holds.setdefault(w, []).append(k)
        at = {w: np.array(x) for w, x in holds.items()}
        hosts, urls = [r["squeezed"] for r in rrows], [r["url"] for r in rrows]
        malus, pdf = np.array([r["malus"] for r in rrows]), np.array([r["pdf"] for r in rrows])
        rounded: dict[float, float] = {}
        out = []
        for row in lrows:
            tokens, shared = set(row["mt"]), np.zeros(len(rrows))
            for w in tokens:
                if w in at:
                    shared[at[w]] += 1
            own = np.flatnonzero(shared)
            name = "".join(row["mt"])
            bonus = np.where([name in (hosts[k] or "") for k in own], 0.30, 0.0) + np.where(pdf[own] & (row["mention_type"] == "report"), 0.15, 0.0)
            raw = np.clip(0.45 * (shared[own] / len(tokens)) + bonus - malus[own] + 0.1, 0.0, 1.0)
            for x in np.unique(raw).tolist():
                if x not in rounded:
                    rounded[x] = _half_up(x, 4)
            score = [rounded[x] for x in raw.tolist()]
            seen: set[str] = set()
            for s, u in sorted((-s, urls[k]) for s, k in zip(score, own.tolist(), strict=True) if s >= row["floor"]):
                if len(seen) == keep:
                    break
                if u not in seen:
                    seen.add(u)
                    out.append((row["canonical_name"], row["mention_type"], u, -s))
        return out

    return best


def link_candidates(mentions: DataFrame, links: DataFrame, keep: int = 3, block: int = BLOCK) -> DataFrame:
    """(mention_id, url, score, rank): the best ``keep`` links of a mention by shared tokens, domain and kind of page.

    All links that share a token are ranked, however frequent it is; of several entries for one address the best counts,
    ties go to the lesser address. Mentions of equal name and type are one question. Names without a token have no links.

    Each mention asks the links of its rarest token first. A link that lacks that token can share all others at most, so
    a mention that has ``keep`` better links by then asks no further; the rest ask block by block.
    """
    from .joins import best_per

    type_ = F.coalesce(F.col("mention_type"), F.lit(""))
    name = F.coalesce(F.col("canonical_name"), F.lit(""))
    m = mentions.select(name.alias("canonical_name"), type_.alias("mention_type"), words(F.col("canonical_name")).alias("mt")).where("size(mt) > 0").distinct()
    both = F.concat_ws(" ", "title", "url")
    k = links.where("url is not null").select("url", both.alias("both"), words(both).alias("lt"), F.replace(host(F.col("url")), F.lit("."), F.lit("")).alias("squeezed"), F.lower("url").endswith(".pdf").alias("pdf"), F.when(F.col("url").rlike("(?i)[/?](search|s)\\b"), 0.30).otherwise(0.0).alias("malus")).distinct()
    right = _with_tokens(k, "both").drop("both").withColumn("length", F.lit(1))
    left = _with_tokens(m, "canonical_name", right.groupBy("t").agg(F.count("*").alias("n"))).withColumn("length", F.lit(1))
    ask = lambda rows: _each_meeting(_meeting_blocks(rows, right, F.lit(1.0), block), _best_links(keep), "canonical_name string, mention_type string, url string, score double")
    one = lambda rows: best_per(rows.groupBy("canonical_name", "mention_type", "url").agg(F.max("score").alias("score")).withColumn("of", F.struct("canonical_name", "mention_type")), "of", F.col("score").desc(), F.col("url"), n=keep).drop("of")
    first = one(ask(left.where("place = 0").withColumn("floor", F.lit(0.0))))
    floors = first.groupBy("canonical_name", "mention_type").agg(F.count("*").alias("have"), F.min("score").alias("floor")).withColumn("floor", F.when(F.col("have") == keep, F.col("floor")).otherwise(0.0))
    reach = F.round(0.45 * (F.size(F.array_distinct("mt")) - 1) / F.size(F.array_distinct("mt")) + 0.55, 4)
    rest = left.where("place > 0").join(floors.drop("have"), ["canonical_name", "mention_type"]).where(reach >= F.col("floor"))
    top = one(ask(rest).unionByName(first.select("canonical_name", "mention_type", "url", "score")))
    best = W.partitionBy("canonical_name", "mention_type").orderBy(F.col("score").desc(), "url")
    ranked = top.withColumn("rank", F.row_number().over(best)).withColumnsRenamed({"canonical_name": "__name", "mention_type": "__type"})
    return mentions.select("mention_id", name.alias("__n"), type_.alias("__t")).join(ranked, (F.col("__n") == F.col("__name")) & (F.col("__t") == F.col("__type"))).select("mention_id", "url", "score", "rank")


def is_acronym(short: Column, long: Column) -> Column:
    """Whether the letters of ``short`` are the initials of the words of ``long``."""
    return (F.length(short) >= 2) & (F.lower(short) == F.array_join(F.transform(words(long), lambda w: F.substring(w, 1, 1)), ""))


def safe_links(candidates: DataFrame, least: float = 0.75) -> DataFrame:
    """Best links (mention_id, canonical_name, url, title, score, rank) that may be taken without a person's look.

    The score must reach ``least`` and every token of the name must stand in title or host, or the title's initials
    must spell the name.
    """
    seen = words(F.concat_ws(" ", "title", host(F.col("url"))))
    every = F.size(F.array_except(words(F.col("canonical_name")), seen)) == 0
    return candidates.where((F.col("rank") == 1) & (F.col("score") >= least) & (every | is_acronym(F.col("canonical_name"), F.col("title"))))


def promote_links(mentions: DataFrame, entities: DataFrame, accepted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mentions with accepted links set, and entities whose empty primary address takes the first mention's link."""
    a = accepted.select("mention_id", F.col("url").alias("__url"), F.col("score").alias("__score"))
    m = mentions.join(a, "mention_id", "left")
    took = F.col("source_url").isNull() & F.col("__url").isNotNull()
    m = m.withColumns({"link_status": F.when(took, "auto_matched").otherwise(F.col("link_status")), "source_url": F.coalesce("source_url", "__url"), "link_confidence": F.when(took, F.col("__score")).otherwise(F.col("link_confidence"))}).drop("__url", "__score")
    first = m.where("source_url is not null").groupBy("entity_id").agg(F.min_by("source_url", "mention_id").alias("__first"))
    e = entities.join(first, entities["id"] == first["entity_id"], "left").withColumn("primary_url", F.coalesce("primary_url", "__first")).drop("__first", "entity_id")
    return m, e


def anchor_blocks(passages: DataFrame, blocks: DataFrame, head_words: int = 8, width: int = 3) -> DataFrame:
    """(passage_id, doc_id, pos): the text piece in which a passage begins.

    ``passages`` (passage_id, doc_id, text), ``blocks`` (doc_id, pos, piece). A block that holds the first words of the
    passage is taken, the first of several; else the block that shares most runs of ``width`` words with it. A block
    without a common run is none. Only blocks of the passage's own document are looked at.

    What is exchanged are the texts, once, by document; runs are made behind the exchange and never leave their row. The
    sides meet by a merge, so neither is held whole in one place.
    """
    def runs(w: Column) -> Column:
        n = F.greatest(F.size(w) - (width - 1), F.lit(0))
        zipped = F.arrays_zip(*(F.slice(w, k + 1, n).alias(f"w{k}") for k in range(width)))
        return F.transform(zipped, lambda x: F.xxhash64(*(x[f"w{k}"] for k in range(width))))

    # Sorted before the runs are made, so a merge sorts no row with its runs.
    dealt = lambda rows: rows.where("doc_id is not null").repartition("doc_id").sortWithinPartitions("doc_id")
    p = dealt(passages.select("passage_id", "doc_id", "text")).withColumn("w", words(F.col("text")))
    p = p.select("passage_id", "doc_id", F.array_join(F.slice("w", 1, head_words), " ").alias("head"), runs(F.col("w")).alias("r"))
    b = dealt(blocks.select("doc_id", "pos", "piece")).withColumn("w", words(F.col("piece"))).select("doc_id", "pos", match_form(F.col("piece")).alias("bf"), runs(F.col("w")).alias("br"))
    x = p.hint("merge").join(b, "doc_id").withColumn("n", F.size(F.array_intersect("r", "br"))).where("n > 0")
    rank = F.struct(F.col("bf").contains(F.col("head")), F.col("n"), -F.col("pos"))
    return x.groupBy("passage_id", "doc_id").agg(F.max_by("pos", rank).alias("pos"))
