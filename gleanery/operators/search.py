"""Text search over postings, snippets for the final rows, vector search and chunks."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(term, doc_id, pos): a row for each word; text_index keeps them."""
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(words(F.col(text_col))).alias("pos", "term")).select("term", "doc_id", "pos")


def web_terms(text: str) -> dict[str, list]:
    """Arguments of search() from a web-style string: words, "phrases", -excluded words, and words joined by OR."""
    every, none, phrases, groups, joined = [], [], [], [], False
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|([^\s"]+))', text):
        if word == "OR" and not minus:
            joined = bool(every or groups)
            continue
        terms = [t for t in re.split(r"[\W_]+", (phrase or word).lower()) if t]
        if minus:
            none += terms
        elif len(terms) > 1:
            phrases.append(terms)
        elif terms and joined:
            if groups and groups[-1] and groups[-1][-1] == last:
                groups[-1].append(terms[0])
            else:
                groups.append([every.pop(), terms[0]])
            last = terms[0]
        elif terms:
            every.append(terms[0])
            last = terms[0]
        joined = False
    return {"every": every, "some": groups, "none": none, "phrases": phrases}


def search(index: DataFrame, n_docs: int, every: list[str] = (), some: list[list[str]] = (), none: list[str] = (), phrases: list[list[str]] = (), limit: int | None = None) -> DataFrame:
    """(doc_id, score): documents with every term, one of each ``some`` group, all phrases and no ``none`` term.

    ``index`` are plain postings (term, doc_id, pos). The score sums tf * ln(N / df) over the wanted terms.
    """
    tf = index.where(F.col("term").isin(*named_terms(every, some, none, phrases))).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    return ranked(tf, tf.groupBy("term").agg(F.count("*").alias("df")), index, n_docs, every, some, none, phrases, limit)


def named_terms(every: list[str] = (), some: list[list[str]] = (), none: list[str] = (), phrases: list[list[str]] = ()) -> list[str]:
    return list(dict.fromkeys([*every, *(t for g in some for t in g), *(t for p in phrases for t in p), *none]))


def ranked(tf: DataFrame, df: DataFrame, places: DataFrame, n_docs: int, every: list[str] = (), some: list[list[str]] = (), none: list[str] = (), phrases: list[list[str]] = (), limit: int | None = None) -> DataFrame:
    """search() from counts (doc_id, term, tf), document counts (term, df) and places (term, doc_id, pos).

    A document's conditions are sums of flags, so no list of positions is collected; phrases are an equality join on
    (doc, position minus place). ``df`` has a row for each named term and is broadcast. Scores are rounded to 9 digits, so
    that the order of a sum breaks no tie.
    """
    wanted = named_terms(every, some, (), phrases)
    weight = F.when(F.col("term").isin(*wanted), F.col("tf") * F.log(F.lit(float(n_docs)) / F.col("df"))).otherwise(0.0)
    has = lambda terms: F.max(F.col("term").isin(*terms).cast("int")) == 1
    rules = [has([t]) for t in every] + [has(g) for g in some] + ([~has(list(none))] if none else [])
    rule = F.lit(True)
    for r in rules:
        rule = rule & r
    out = tf.join(F.broadcast(df), "term").groupBy("doc_id").agg(F.round(F.sum(weight), 9).alias("score"), rule.alias("ok")).where("ok").drop("ok")
    for p in phrases:
        at = F.array(*(F.struct(F.lit(t).alias("term"), F.lit(k).alias("k")) for k, t in enumerate(p)))
        table = F.broadcast(tf.sparkSession.range(1).select(F.inline(at)))
        full = places.join(table, "term").groupBy("doc_id", (F.col("pos") - F.col("k")).alias("at")).agg(F.count("*").alias("n")).where(F.col("n") == len(p)).select("doc_id").distinct()
        out = out.join(full, "doc_id", "left_semi")
    return out.orderBy(F.col("score").desc(), "doc_id").limit(limit) if limit else out


#: Words of a fragment at least and at most, and fragments of a document.
LEAST_WORDS, MOST_WORDS, FRAGMENTS = 6, 22, 2


def best_fragments(hits: list[tuple[int, str]], n_words: int, most: int = FRAGMENTS, least: int = LEAST_WORDS, width: int = MOST_WORDS) -> list[tuple[int, int]]:
    """(first, last) word of the best fragments around hits (position, term), in order of place.

    The best window of at most ``width`` words, from one hit to another, holds most distinct terms; of several the
    shortest, then the first. It is widened to ``least`` words. The next is the best one apart from those before;
    fragments that touch become one.
    """
    hits, taken = sorted(hits), []
    while len(taken) < most:
        free = [h for h in hits if not any(a <= h[0] <= b for a, b in taken)]
        best = None
        for i, (start, _) in enumerate(free):
            terms: set[str] = set()
            for pos, term in free[i:]:
                if pos - start >= width or any(start < a <= pos for a, _ in taken):
                    break
                if term not in terms:
                    terms.add(term)
                    key = (-len(terms), pos - start, start)
                    best = min(best, key) if best else key
        if best is None:
            break
        first, last = best[2], best[2] + best[1]
        last = min(n_words - 1, max(last, first + least - 1))
        first = max(0, min(first, last - least + 1))
        taken.append((first, last))
    out: list[tuple[int, int]] = []
    for a, b in sorted(taken):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def snippets(found: DataFrame, places: DataFrame, docs: DataFrame, id_col: str, text_col: str, terms: list[str]) -> DataFrame:
    """Adds ``fragments``: the best fragments around hits, hits in brackets; for the rows of a result, not for a corpus.

    ``places`` (term, doc_id, pos) come from the index; a text is cut into words only to show the chosen ones. The ids of
    the result are broadcast, so texts and places of other documents are not exchanged.
    """
    @F.pandas_udf("array<struct<first:int,last:int>>")
    def choose(hits: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([[{"first": a, "last": b} for a, b in best_fragments([(h["pos"], h["term"]) for h in x], k)] for x, k in zip(hits, n, strict=True)])

    ids = F.broadcast(found.select("doc_id"))
    hits = places.where(F.col("term").isin(*terms)).join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_list(F.struct("pos", "term")).alias("hits"))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(ids, "doc_id", "left_semi")
    d = own.select("doc_id", F.regexp_extract_all("text", F.lit(r"([\p{L}\p{N}]+[^\p{L}\p{N}]*)"), 1).alias("w"))
    x = found.join(hits, "doc_id").join(d, "doc_id")
    run = lambda w: F.regexp_extract(w, r"^[\p{L}\p{N}]+", 0)
    mark = lambda w: F.when(F.lower(run(w)).isin(*terms), F.concat(F.lit("["), run(w), F.lit("]"), F.substring(w, F.length(run(w)) + 1, F.length(w)))).otherwise(w)
    shown = F.transform(choose("hits", F.size("w")), lambda f: F.trim(F.regexp_replace(F.array_join(F.transform(F.slice("w", f["first"] + 1, f["last"] - f["first"] + 1), mark), ""), r"\s+", " ")))
    return x.withColumn("fragments", shown).drop("w", "hits")


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision."""
    d = lambda x: x.cast("array<double>")
    dot = lambda x, y: F.aggregate(F.zip_with(d(x), d(y), lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_top(vectors: DataFrame, query: list[float], k: int, id_col: str, vec_col: str, condition: Column | None = None) -> DataFrame:
    """The k nearest rows to one vector, exact; filters come first and each task keeps k rows."""
    rows = vectors.where(condition) if condition is not None else vectors
    q = F.array(*(F.lit(float(x)) for x in query))
    return rows.select(id_col, cosine(F.col(vec_col), q).alias("score")).orderBy(F.col("score").desc(), id_col).limit(k)


def chunks(docs: DataFrame, id_col: str, text_col: str, size: int, overlap: int) -> DataFrame:
    """(id, chunk, text): windows of ``size`` words, each sharing ``overlap`` words with the one before; the last ends the text."""
    step = size - overlap
    d = docs.select(id_col, F.array_remove(F.split(F.coalesce(text_col, F.lit("")), r"\s+"), "").alias("w")).where("size(w) > 0")
    last = F.greatest(F.lit(0), F.ceil((F.size("w") - size) / step)).cast("int")
    return d.select(id_col, "w", F.explode(F.sequence(F.lit(0), last)).alias("chunk")).select(id_col, "chunk", F.array_join(F.slice("w", F.col("chunk") * step + 1, size), " ").alias("text"))
