"""Ranked search without an index: an automaton of all item terms reads the texts and counts.

The terms of a block of items form one Aho-Corasick automaton. A term stands between guards (a blank on either side) and
so do the words of a text, so that a hit is a whole term. Each text is read once for a block; the automaton's outputs are
numbers of terms, from which the sparse table term -> (item, repeats) leads to the items. Scores come from whole counts
over all documents, hence the order: count, sum up, then rank.
"""

from __future__ import annotations

import itertools
import math
import operator
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch_path, stored, text_buffer

#: A term: letters, digits and whatever isn't ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of terms and postings of items that one automaton (and its broadcast) may hold; more items make more blocks.
BLOCK_BYTES = 2 << 20
#: Cells that numpy handles at once, and tasks whose best rows are brought together before the last ranking.
CELLS, MEET = 1 << 20, 64

_FORM = np.full(256, 32, np.uint8)
for _c in itertools.chain(range(48, 58), range(97, 123), range(128, 256)):
    _FORM[_c] = _c
_FORM[65:91] = np.arange(97, 123)


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term, n): the terms of each item with their repeats; rows of one id count together."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), _UPPER, _LOWER)
    cut = items.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item_id"), F.explode(F.regexp_extract_all(text, F.lit(f"({TERM})"), 1)).alias("term"))
    return cut.groupBy("item_id", "term").agg(F.count("*").alias("n"))


def in_blocks(terms: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Adds ``block``: items are dealt by a hash until no block of several items weighs over ``most`` bytes."""
    blocks = 0
    weight = terms.groupBy("item_id").agg(F.sum(F.octet_length("term") + 24).alias("bytes"))
    total = weight.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    while True:
        blocks = max(2 * blocks, -(-2 * total // most), 1)
        dealt = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
        heavy = weight.groupBy(dealt.alias("block")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("items")).where((F.col("bytes") > most) & (F.col("items") > 1))
        if not heavy.limit(1).count():
            return terms.withColumn("block", dealt), blocks


_AUTOMATA: dict = {}


def automaton(shared):
    """The guarded automaton of a broadcast list of terms; a worker builds it once and holds one at a time."""
    import ahocorasick

    if shared.value[0] not in _AUTOMATA:
        _AUTOMATA.clear()
        built = ahocorasick.Automaton()
        for k, term in enumerate(shared.value[1]):
            built.add_word(f" {term} ", k)
        built.make_automaton()
        _AUTOMATA[shared.value[0]] = built
    return _AUTOMATA[shared.value[0]]


def counted(docs: DataFrame, shared, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tf): number of all terms of each text, and how often each wanted one stands there."""
    kind = docs.schema[id_col].dataType.simpleString()
    out = pa.schema([("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))])

    def run(batches):
        built, value = automaton(shared), operator.itemgetter(1)
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            plain = _FORM[data]
            word = np.concatenate([[False], plain != 32])
            edge = np.zeros(len(plain) + 1, bool)
            edge[offsets] = True
            starts = word[1:] & (~word[:-1] | edge[:-1])
            before = np.concatenate([[0], np.cumsum(starts)])
            text, rows = plain.tobytes(), []
            for a, b in itertools.pairwise(offsets.tolist()):
                hits = Counter(map(value, built.iter(" " + text[a:b].decode("utf-8", "replace") + " "))) if len(built) else {}
                rows.append({"n": int(before[b] - before[a]), "terms": list(hits), "tf": list(hits.values())})
            for part in pa.Table.from_pylist(rows, schema=out).combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays([batch.column(0), *part.columns], ["doc_id", "n", "terms", "tf"])

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tf array<int>")


class Best:
    """The k best (score, least id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item, self.score, self.doc = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """A table of documents by items; what lies under an item's k-th score so far is left out at once."""
        r, i = np.nonzero(scores >= self.least)
        item, score, doc = np.concatenate([self.item, i]), np.concatenate([self.score, scores[r, i]]), np.concatenate([self.doc, docs[r]])
        order = np.lexsort((doc, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = order[place < self.k]
        last = order[place == self.k - 1]
        self.least[item[place == self.k - 1]] = score[last]
        self.item, self.score, self.doc = (np.concatenate([self.item, i])[keep], score[keep], doc[keep])


def _ranges(size: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of several runs of the given sizes."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def scored(counts: DataFrame, shared, n_docs: int, length: int, k: int) -> DataFrame:
    """(part, item, doc_id, score): the best documents of each item among those of a task; items by number."""

    def run(batches):
        weight, start, item, repeats, n_items = shared.value
        best = Best(n_items, k)
        for batch in batches:
            doc, n = np.asarray(batch.column(0).cast(pa.int64())), np.asarray(batch.column(1))
            lists, tf = batch.column(2), np.asarray(batch.column(3).flatten()).astype(np.int64)
            term, size = np.asarray(lists.flatten()), np.diff(np.asarray(lists.offsets))
            m = 75 + 25 * n * n_docs // max(length, 1)
            row = np.repeat(np.arange(len(doc)), size)
            worth = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[row]))
            spread = start[term + 1] - start[term]
            # Rows are taken together while their cells and their steps from terms to items fit.
            steps = np.concatenate([[0], np.cumsum(np.bincount(row, weights=spread, minlength=len(doc)).astype(np.int64) + n_items)])
            ends = np.concatenate([[0], np.cumsum(size)])
            a = 0
            while a < len(doc):
                b = max(a + 1, int(np.searchsorted(steps, steps[a] + CELLS, side="right")) - 1)
                own = slice(ends[a], ends[b])
                to = np.repeat(start[term[own]], spread[own]) + _ranges(spread[own])
                cell = np.repeat(row[own] - a, spread[own]) * n_items + item[to]
                value = np.repeat(worth[own], spread[own]) * repeats[to]
                # Doubles add whole numbers exactly up to 2^53, so high and low bits are added apart.
                total = lambda x: np.bincount(cell, weights=x, minlength=(b - a) * n_items).astype(np.int64)  # noqa: E731, B023
                best.add((total(value & 0xFFFFFF) + (total(value >> 24) << 24)).reshape(b - a, n_items), doc[a:b])
                a = b
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best.item), part, np.int32)), pa.array(best.item.astype(np.int32)), pa.array(best.doc), pa.array(best.score)], ["part", "item", "doc_id", "score"])

    return counts.mapInArrow(run, "part int, item int, doc_id long, score long")


def _top(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    best = W.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id"))
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest score above 0 for each item, ties by doc_id.

    Null, empty and termless texts score nothing, on either side; very long texts are read whole. Rows without an id take
    no part; each row of a repeated doc_id is a document of its own, rows of a repeated item_id are one item. Empty tables
    give no rows. Other columns of both tables are not read. Document ids must be whole numbers.

    Items are handled in blocks of at most ``block_bytes`` (or one item), so what is broadcast is bounded however many
    there are. A task keeps k rows for each item of a block; they meet in two steps, so no group grows with the tasks.
    """
    spark = docs.sparkSession
    terms, blocks = in_blocks(stored(item_terms(items, item_col, item_text), "rank-terms"), block_bytes)
    kind = items.schema[item_col].dataType.simpleString()
    n_docs = length = None
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(blocks):
        own = terms.where(F.col("block") == block)
        rows = own.select("item_id", "term", "n").collect()  # at most block_bytes, or one item
        if not rows:
            continue
        names = sorted({r.term for r in rows})
        ids = list(dict.fromkeys(r.item_id for r in rows))
        term_no, item_no = {t: i for i, t in enumerate(names)}, {x: i for i, x in enumerate(ids)}
        at = np.array([(term_no[r.term], item_no[r.item_id], r.n) for r in rows], np.int64)
        at = at[np.argsort(at[:, 0], kind="stable")]
        start = np.searchsorted(at[:, 0], np.arange(len(names) + 1))
        counts = stored(counted(docs, spark.sparkContext.broadcast((scratch_path(spark, "terms"), names)), id_col, text_col), "rank-counts")
        if n_docs is None:
            n_docs, length = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(names), np.int64)
        for t, d in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect():  # one row for each term of the block
            df[t] = d
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        given = spark.sparkContext.broadcast((weight, start, at[:, 1].copy(), at[:, 2].copy(), len(ids)))
        part = stored(scored(counts, given, n_docs, length, k), "rank-best")
        part = _top(part.withColumn("meet", F.floor(F.col("part") / MEET)), k, "item", "meet")
        # Numbers of the block go back to ids in a join with its items.
        named = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {kind}")
        found = found.unionByName(_top(part.drop("rank"), k, "item").join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return found
