"""Benchmark decontamination with spaced seeds, in DataFrame functions alone.

A mask fixes which of SPAN neighbouring tokens count; the others may differ. Training positions and benchmark positions
meet in a join on the hash of the counted tokens. Around each hit the item is laid on the document at that offset and
token by token compared; a window of WINDOW tokens with at least MATCH of them equal is a leak. An item of fewer than
SPAN tokens is a leak where all its tokens follow one another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tokens that count in each mask (fixed values, found by search). However the tokens that MATCH lets differ lie in a
#: window (WINDOW tokens, or a whole item of SPAN to WINDOW), one mask fits at some offset; a test goes through all cases.
MASKS = ("10100111", "111011", "11001011")
SPAN = 10
WINDOW, MATCH = 20, 0.8
#: Tokens of a text that are handled at once; a longer one is cut into blocks that share a window less a token, so every
#: window lies whole in a block.
BLOCK_TOKENS = 4096
#: Benchmark tokens up to which the seeds (a few hundred bytes a token with the item's tokens) are broadcast.
BROADCAST_TOKENS = 40_000


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; null gives none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def token_blocks(docs: DataFrame, id_col: str, text_col: str, most: int | None = None) -> DataFrame:
    """(doc_id, block, words): the tokens of each text in blocks of ``most`` and an overlap; short texts are one block.

    The tokens stand in an array of one element that is exploded, so that they are cut once and not for every block.
    """
    most, share = most or BLOCK_TOKENS, WINDOW - 1
    whole = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.explode_outer(F.array(tokens(F.col(text_col)))).alias("all"))
    last = F.greatest(F.ceil((F.size("all") - share) / most).cast("int"), F.lit(1)) - 1
    at = whole.select("doc_id", "all", F.explode(F.sequence(F.lit(0), last)).alias("block"))
    return at.select("doc_id", "block", F.slice("all", F.col("block") * most + 1, F.lit(most + share)).alias("words"))


def spread_seeds(rows: DataFrame, words: str, keep: tuple[str, ...], masks: tuple[str, ...] = MASKS) -> DataFrame:
    """A row (keep..., pos, seed) for each position and mask that ends inside the text; else the seed is null.

    Shifted copies of the token list are zipped, so every position becomes a row of columns and the hashes are
    computed in generated code; a lambda over positions takes twice as long. explode_outer: with explode, a filter on
    the zipped list would be inferred and the list computed twice.
    """
    zipped = F.arrays_zip(*(F.slice(words, k + 1, F.size(words)).alias(f"w{k}") for k in range(max(map(len, masks)))))
    at = rows.select(*keep, F.posexplode_outer(zipped).alias("pos", "at"))
    hashes = (F.when(F.col(f"at.w{len(mask) - 1}").isNotNull(), F.xxhash64(F.lit(int(mask, 2)), *(F.col(f"at.w{j}") for j, bit in enumerate(mask) if bit == "1"))) for mask in masks)
    return at.select(*keep, "pos", F.explode(F.array(*hashes)).alias("seed"))


def _overlap(words: Column, item: Column, diag: Column) -> Column:
    """Most equal tokens in a window of the overlap of document and item, or null if the overlap is too short."""
    at = F.greatest(diag, F.lit(0))
    part = F.slice(words, at + 1, F.size(item) - (at - diag))
    same = F.zip_with(part, F.slice(item, at - diag + 1, F.size(part)), lambda a, b: F.when(a == b, 1).otherwise(0))
    width = F.least(F.size(item), F.lit(WINDOW))
    sums = F.transform(F.sequence(F.lit(0), F.size(part) - width), lambda i: F.aggregate(F.slice(same, i + 1, width), F.lit(0), lambda x, y: x + y))
    return F.when(F.size(part) >= width, F.array_max(sums))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, matched, window): items of which a document holds a passage, and the best window's count.

    Null and empty texts hold no passage. Items under SPAN tokens are found where they stand whole and unchanged. Rows
    without an id take no part; an id or item on several rows counts once, and of equally full windows it doesn't matter
    which. Very long texts are read whole, in blocks that share the tokens of a window less one. Either table may be
    empty. Other columns of both are not read.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), tokens(F.col(item_text)).alias("item")).where(F.col("item_id").isNotNull() & (F.size("item") > 0)).distinct()
    # Short items: a full mask of each length that occurs, laid on their first token.
    size, short = items.agg(F.coalesce(F.sum(F.size("item")), F.lit(0)), F.collect_set(F.when(F.size("item") < SPAN, F.size("item")))).first()
    runs = tuple("1" * n for n in sorted(short))
    probes = spread_seeds(items.where(F.size("item") >= SPAN), "item", ("item_id", "item"))
    for run in runs:
        probes = probes.unionByName(spread_seeds(items.where(F.size("item") == len(run)), "item", ("item_id", "item"), (run,)))
    probes = probes.where("seed is not null").withColumnRenamed("pos", "ipos")
    masks = (*MASKS, *runs)
    cut = token_blocks(docs, id_col, text_col)
    if size <= BROADCAST_TOKENS:
        # Generators and join stand in one stage, so a document's tokens are at hand for each hit without being copied.
        hits = spread_seeds(cut, "words", ("doc_id", "words"), masks).join(F.broadcast(probes), "seed").withColumn("diag", F.col("pos") - F.col("ipos"))
    else:
        light = spread_seeds(cut, "words", ("doc_id", "block"), masks).join(probes.drop("item"), "seed").select("doc_id", "block", "item_id", (F.col("pos") - F.col("ipos")).alias("diag")).distinct()
        hits = light.join(cut, ["doc_id", "block"]).join(items, "item_id")
    window = F.least(F.size("item"), F.lit(WINDOW))
    # The bound is put behind the grouping: as part of the join it would keep generators and join out of one stage.
    best = hits.select("doc_id", "item_id", _overlap(F.col("words"), F.col("item"), F.col("diag")).alias("matched"), window.alias("window")).groupBy("doc_id", "item_id").agg(F.max("matched").cast("long").alias("matched"), F.max("window").cast("long").alias("window"))
    return best.where(F.col("matched") >= F.ceil(F.col("window") * MATCH))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark passage, with their columns, whatever their names; rows without an id stay.

    If an id stands on several rows and one of them holds a passage, all rows of the id go. Null and empty texts stay,
    very long ones are read whole; with an empty table on either side nothing goes.
    """
    bad = leaks(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("bad")).distinct()
    return docs.join(bad, docs[id_col] == bad["bad"], "left_anti")
