"""A stored text index: postings by term and range of documents, in folders by a hash of the term.

A row holds the postings of one term in RANGE neighbouring document numbers, sorted, with what a search needs to know
before it reads them: how many documents there are and how often the term occurs in one at most. Rows are sorted by term
within the files of a folder, so a search opens the folders of its terms and skips row groups by their statistics.
Numbers are written as differences (Parquet's delta encoding). New documents are further rows in the same folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .search import named_terms, ranked, words

#: Folders of an index, documents of a row, and rows that a ranked search reads before it knows a bound.
BUCKETS, RANGE, PROBE = 64, 1024, 8
#: Bytes of text (about) whose words a task sorts, so that the sort stays in memory.
TASK_BYTES = 8 << 20
#: Lists aren't kept by dictionary, so that their numbers become differences.
FORMAT = {"parquet.writer.version": "v2", "parquet.enable.dictionary#entries.list.element.at": "false", "parquet.enable.dictionary#entries.list.element.pos.list.element": "false"}


def bucket_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def index_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(term, block, places): a row for each term and range of document numbers.

    ``places`` are sorted whole numbers, a document's place in its range above the position, so a row travels in 8 bytes
    an occurrence. Ids must be whole numbers and stand on one row each; rows without an id and texts without words have no
    places.

    Whole texts are dealt by range, and words are grouped where their text is: nothing as large as the words is exchanged,
    and a task sorts the words of about TASK_BYTES of text (or of one range) at any size of the corpus. A frequent term is
    as many groups as there are ranges.
    """
    known = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tasks = (known.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // TASK_BYTES + 1
    dealt = known.withColumn("block", F.floor(F.col("doc_id") / RANGE)).repartition(tasks, "block")
    each = dealt.select("block", (F.col("doc_id") - F.col("block") * RANGE).cast("long").alias("at"), F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return each.groupBy("term", "block").agg(F.array_sort(F.collect_list(_place(F.col("at"), F.col("pos")))).alias("places"))


def _place(at: Column, pos: Column) -> Column:
    return F.shiftleft(at.cast("long"), 32).bitwiseOR(pos.cast("long"))


def _kept(rows: DataFrame) -> DataFrame:
    """Rows as they are stored, from index_rows()."""
    at = lambda x: F.shiftright(x, 32).cast("int")
    pos = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    place = lambda i: F.get("places", i)
    first = F.filter(F.sequence(F.lit(0), F.size("places") - 1), lambda i: (i == 0) | (at(place(i)) != at(place(i - 1))))
    cut = rows.withColumn("first", first)
    entry = lambda i, k: F.struct(at(place(i)).alias("at"), F.transform(F.slice("places", i + 1, F.coalesce(F.get("first", k + 1), F.size("places")) - i), pos).alias("pos"))
    out = cut.withColumn("entries", F.transform("first", entry))
    return out.select(
        bucket_of(F.col("term")).alias("bucket"), "term", "block", F.size("entries").cast("long").alias("docs"), F.size("places").cast("long").alias("n"), F.array_max(F.transform("entries", lambda e: F.size(e["pos"]))).alias("most"),
        F.array_max(F.transform("places", pos)).alias("last"), "entries",
    )


def write_index(rows: DataFrame, docs: DataFrame, id_col: str, path: str) -> None:
    """Append rows of index_rows() to the index at ``path``, and the ids of the documents that they come from.

    A folder's rows are rebalanced, so one with a very frequent term is written by several tasks.
    """
    even = rows.withColumn("bucket", bucket_of(F.col("term"))).hint("rebalance", "bucket").sortWithinPartitions("bucket", "term", "block")
    _kept(even).write.mode("append").options(**FORMAT).partitionBy("bucket").parquet(f"{path}/postings")
    docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id")).write.mode("append").parquet(f"{path}/documents")


def build_index(docs: DataFrame, id_col: str, text_col: str, path: str) -> None:
    """Index new documents at ``path``, whether or not there is an index yet; ids must be new to it."""
    write_index(index_rows(docs, id_col, text_col), docs, id_col, path)


def refreshed(spark: SparkSession, path: str, docs: DataFrame, id_col: str, text_col: str, to: str) -> None:
    """Write the index at ``path`` to ``to`` with documents replaced or added; a null text takes a document out.

    Only rows of ranges with a changed document are looked into: the ids that change are a list of at most RANGE places
    for each range, and the entries at these places go. All other rows are copied as they are.
    """
    docs = docs.where(F.col(id_col).isNotNull())
    old = spark.read.parquet(f"{path}/postings")
    block = F.floor(F.col(id_col) / RANGE)
    gone = docs.groupBy(block.alias("block")).agg(F.collect_set((F.col(id_col) - block * RANGE).cast("int")).alias("gone"))
    kept = old.join(gone, "block", "left").select("term", "block", F.when(F.col("gone").isNull(), F.col("entries")).otherwise(F.filter("entries", lambda e: ~F.array_contains("gone", e["at"]))).alias("entries")).where("size(entries) > 0")
    now = docs.where(F.col(text_col).isNotNull())
    ids = spark.read.parquet(f"{path}/documents").join(docs.select(F.col(id_col).cast("long").alias("doc_id")), "doc_id", "left_anti").unionByName(now.select(F.col(id_col).cast("long").alias("doc_id")))
    places = F.flatten(F.transform("entries", lambda e: F.transform(e["pos"], lambda p: _place(e["at"], p))))
    write_index(kept.select("term", "block", places.alias("places")).unionByName(index_rows(now, id_col, text_col)), ids, "doc_id", to)


def rows_of(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """The index rows of some terms: their folders are named, so no other is opened."""
    buckets = [r[0] for r in spark.sql("SELECT explode(transform(:terms, t -> CAST(pmod(xxhash64(t), :n) AS INT)))", args={"terms": F.array(*map(F.lit, terms)), "n": BUCKETS}).collect()]
    return spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(*sorted(set(buckets))) & F.col("term").isin(*terms))


def places_of(rows: DataFrame) -> DataFrame:
    """(term, doc_id, pos) of index rows."""
    each = rows.select("term", "block", F.explode("entries").alias("e"))
    return each.select("term", (F.col("block") * RANGE + F.col("e.at")).alias("doc_id"), F.explode("e.pos").alias("pos"))


def search_index(spark: SparkSession, path: str, every: list[str] = (), some: list[list[str]] = (), none: list[str] = (), phrases: list[list[str]] = (), limit: int | None = None) -> DataFrame:
    """search() over a stored index: (doc_id, score) of the documents that fulfil all conditions.

    Ranges of documents that lack a required term are never read. With a ``limit``, a range's greatest possible score (for
    each term the occurrences in one document at most, times its weight) is compared with what the PROBE most promising
    ranges already give: ranges that stay below the last of their ``limit`` best are not read either.
    """
    terms = named_terms(every, some, none, phrases)
    if not terms:
        return spark.createDataFrame([], "doc_id long, score double")
    rows = rows_of(spark, path, terms)
    n_docs = spark.read.parquet(f"{path}/documents").count()
    df = rows.groupBy("term").agg(F.sum("docs").alias("df"))
    # New documents of a range are rows of their own, so a term may stand on several rows of a range.
    wanted = named_terms(every, some, (), phrases)
    of = rows.groupBy("block", "term").agg(F.max("most").alias("most")).join(F.broadcast(df), "term")
    has = lambda ts: F.max(F.col("term").isin(*ts).cast("int")) == 1
    needs = [has([t]) for t in dict.fromkeys([*every, *(t for p in phrases for t in p)])] + [has(g) for g in some]
    need = F.lit(True)
    for x in needs:
        need = need & x
    bound = F.sum(F.when(F.col("term").isin(*wanted), F.col("most") * F.log(F.lit(float(n_docs)) / F.col("df"))).otherwise(0.0))
    blocks = of.groupBy("block").agg(bound.alias("bound"), need.alias("ok")).where("ok").select("block", "bound")

    def within(own: DataFrame) -> DataFrame:
        part = rows.join(own.select("block"), "block", "left_semi")
        tf = part.select("term", "block", F.explode("entries").alias("e")).select((F.col("block") * RANGE + F.col("e.at")).alias("doc_id"), "term", F.size("e.pos").alias("tf"))
        return ranked(tf, df, places_of(part), n_docs, every, some, none, phrases, limit)

    if limit:
        best = within(blocks.orderBy(F.col("bound").desc(), "block").limit(PROBE)).collect()  # at most ``limit`` rows
        if len(best) == limit:
            blocks = blocks.where(F.col("bound") >= best[-1].score - 1e-9)
    return within(blocks)
