"""Token-ID output: Parquet shards with an id list per document, and reads of single documents or of metadata.

Shards follow one another in ascending document order. The ids are one list column, delta or dictionary encoded; row
groups and pages have set sizes and Spark's Parquet writer adds column and offset indexes, so that a filter on doc_id
reads only the pages it needs and the metadata columns can be read without the ids.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, scratch_path

#: Distinct pieces that a worker remembers; beyond it keeps those that it has used KEEP_USES times, or starts anew if
#: they are more than half. Memory stays bounded.
MEMO_PIECES, KEEP_USES = 700_000, 3
#: Bytes of text in a shard.
SHARD_BYTES = 32 << 20
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])


def _byte_table() -> list[str]:
    """The usual letters for bytes in byte-level vocabularies: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in plain)}
    return [rest.get(b, chr(b)) for b in range(256)]


#: ASCII signs but for the apostrophe, which the pre-tokenizer may join with letters.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PARTS = re.compile("([" + re.escape(SIGNS) + "]*)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([" + re.escape(SIGNS) + "]*)")


class _Memo(dict):
    """Pieces to places. A piece that is looked up for the first time gets the next place and is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = k = len(self)
        self.new.append(piece)
        return k


class Encoder:
    """Texts to ids with a tokenizers file, each distinct piece encoded once.

    The file's pre-tokenizer never joins text over blanks, so a text's ids are those of its blank-separated chunks. The
    full pipeline encodes a chunk; a chunk of Latin-1 letters with signs before or behind is made of the ids of the
    word, which the model alone gives in less time, and of the signs, so a word is encoded once in whatever case and
    with whatever signs. Only files known to allow that (lower case, letters separate from signs, no added token of such
    a form) take this road; with any other the whole text goes through the library as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = [t.get("content", "") for t in spec.get("added_tokens", [])]
        norm = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = [x.get("pattern", {}).get("Regex", "") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.by_piece = norm == ["NFC", "Replace", "Lowercase"] and split[:1] == ["'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"]
        self.by_piece &= all(_PARTS.fullmatch(t) is None or (t[0] in SIGNS and t[-1] in SIGNS) for t in added)
        self.by_piece &= not any(set(t) <= set(SIGNS) for t in added)
        self.table = dict(enumerate(_byte_table()))
        self.clear()

    def clear(self) -> None:
        self.memo = _Memo()
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.count, self.pieces = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0
        self.uses = np.zeros(1 << 14, np.int32)
        self._keep([[]], np.zeros(1, np.int64), 1)
        self.memo[""] = 0

    def _keep(self, ids: list, at: np.ndarray, pieces: int) -> None:
        """Store the ids of the pieces with places ``at``; places under ``pieces`` are in use then."""
        n = pieces
        if n > len(self.start):
            self.start, self.count, self.uses = (np.concatenate([x, np.zeros(max(len(x), n), x.dtype)]) for x in (self.start, self.count, self.uses))
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        self._store(np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), at, counts)
        self.pieces = n

    def _store(self, flat: np.ndarray, at: np.ndarray, counts: np.ndarray) -> None:
        size = self.used + len(flat)
        if size > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), size), np.int32)])
        self.flat[self.used : size] = flat
        self.start[at] = self.used + np.cumsum(counts) - counts
        self.count[at] = counts
        self.used = size

    def _shrink(self) -> None:
        """Forget the pieces that were rarely used."""
        old, flat, start, count = self.memo, self.flat, self.start, self.count
        often = self.uses >= KEEP_USES
        self.clear()
        if often.sum() <= MEMO_PIECES // 2:
            kept = [(piece, flat[start[k] : start[k] + count[k]]) for piece, k in old.items() if often[k] and piece]
            self._keep([i for _, i in kept], np.arange(1, len(kept) + 1), len(kept) + 1)
            self.memo.update(zip((p for p, _ in kept), range(1, len(kept) + 1), strict=True))

    def _letters(self, word: str) -> list[int]:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.table)
        return [t.id for t in self.full.model.tokenize(word)]

    def _learn(self) -> None:
        """Encode the pieces that the memo has noted as new; the list grows by the parts that pieces are made of."""
        memo, known, letters = self.memo, self.pieces, self._letters
        words, words_at, hard, hard_at, made, left, right = [], [], [], [], [], [], []
        for at, piece in enumerate(memo.new, known):
            if (m := _PARTS.fullmatch(piece)) is None:
                hard.append(piece)
                hard_at.append(at)
                continue
            head, word, tail = m.groups()
            low = word.lower()
            if low == piece:
                words.append(letters(low))
                words_at.append(at)
            elif head and tail:
                hard.append(piece)
                hard_at.append(at)
            else:
                made.append(at)
                left.append(memo[head or low])
                right.append(memo[low if head else tail])
        memo.new = []
        words += [x.ids for x in self.full.encode_batch_fast(hard, add_special_tokens=False)]
        self._keep(words, np.array(words_at + hard_at, np.int64), self.pieces + len(words) + len(made))
        self._join(np.array(made, np.int64), np.array(left, np.int64), np.array(right, np.int64))

    def _join(self, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """Give the places ``at`` the ids of the pieces ``left`` and ``right``, one behind the other."""
        both = np.stack([left, right], axis=1).ravel()
        count = self.count[both]
        ends = np.cumsum(count)
        ids = self.flat[np.repeat(self.start[both] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        self._store(ids, at, count.reshape(-1, 2).sum(axis=1))

    def _places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of all pieces of the texts in the memo, and the number of pieces of each text."""
        if len(self.memo) > MEMO_PIECES:
            self._shrink()
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self.memo.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if self.memo.new:
            gc.disable()  # many short lists are made, none of them in a cycle
            self._learn()
            gc.enable()
        self.uses[: self.pieces] += np.bincount(at, minlength=self.pieces).astype(np.int32)
        return at, sizes

    def lengths(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text."""
        if not self.by_piece:
            return np.array([len(x.ids) for x in self.full.encode_batch_fast(texts, add_special_tokens=False)], np.int64)
        at, sizes = self._places(texts)
        total = np.concatenate([[0], np.cumsum(self.count[at])])
        ends = np.cumsum(sizes)
        return total[ends] - total[ends - sizes]

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, each text's followed by end_id, and the n+1 offsets of the texts."""
        if not self.by_piece:
            rows = [[*x.ids, end_id] for x in self.full.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for r in rows for i in r], np.int32), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        at, sizes = self._places(texts)
        # Ids of all pieces one after another, with one further place behind each text's.
        count = self.count[at]
        last = np.cumsum(sizes) - 1
        ends = np.cumsum(count)
        offsets = np.concatenate([[0], ends[last] + np.arange(1, len(texts) + 1)]) if len(texts) else np.zeros(1, np.int64)
        ids = np.full(offsets[-1], end_id, np.int32)
        inside = np.ones(len(ids), bool)
        inside[offsets[1:] - 1] = False
        total = int(ends[-1]) if len(ends) else 0
        ids[inside] = self.flat[np.repeat(self.start[at] - (ends - count), count) + np.arange(total)]
        return ids, offsets


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2) -> DataFrame:
    """(doc_id, n_tokens, ids), in the row order of ``docs``; a null text gives the end id alone."""

    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            for a, b in chunks(np.concatenate([[0], np.cumsum(sizes)]), 1 << 20):
                ids, offsets = enc.encode([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()], end_id)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(offsets)), lists], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, SCHEMA)


def shard_number(size: int, shard_bytes: int, cores: int) -> int:
    """Shards for ``size`` bytes of text."""
    return max(1, -(-size // shard_bytes), min(cores, size >> 20))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    shards: int | None = None,
    shard_bytes: int = SHARD_BYTES,
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2000,
    encoding: str = "delta",
) -> None:
    """Encode documents and write them as shards in ascending order of id; rows without an id are left out.

    ``encoding``: "delta" (DELTA_BINARY_PACKED) or "dictionary". Documents with equal ids all stay, next to each other.
    Ranges of ids are dealt out before encoding, so texts move once and are encoded once. The number of shards follows
    the bytes of text: about ``shard_bytes`` in each, but a shard for each core while they hold a MB or more.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    n = shards or shard_number(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0, shard_bytes, spark.sparkContext.defaultParallelism)
    dealt = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    encoded = encode_documents(dealt, tokenizer, "doc_id", "text", end_id)
    (
        encoded.write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.writer.version", "v2")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """Chosen columns of the files; a filter on doc_id is pushed down to row groups and pages."""
    return spark.read.schema(SCHEMA).parquet(path).select(*columns)


def _with_starts(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Adds ``start`` to rows (shard, doc_id, n_tokens, ...) of the files.

    Shards hold disjoint ranges of ids (an id that occurs several times lies in one shard), so a running sum within
    each shard and one over the shards' totals suffice; the second sees one row for each shard.
    """
    so_far = lambda w: w.rowsBetween(W.unboundedPreceding, W.currentRow)
    sizes = read_token_files(spark, path, ("doc_id", "n_tokens")).withColumn("shard", F.input_file_name())
    totals = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("ids_in"), F.min("doc_id").alias("lo"))
    before = totals.select("shard", (F.sum("ids_in").over(so_far(W.orderBy("lo"))) - F.col("ids_in")).alias("base"))
    inside = F.sum("n_tokens").over(so_far(W.partitionBy("shard").orderBy("doc_id"))) - F.col("n_tokens")
    return rows.withColumn("inside", inside).join(before, "shard").withColumn("start", F.col("base") + F.col("inside")).drop("base", "inside")


def document_starts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, start): the number of ids in all documents before each, from the metadata columns alone."""
    rows = read_token_files(spark, path, ("doc_id", "n_tokens")).withColumn("shard", F.input_file_name())
    return _with_starts(spark, path, rows).select("doc_id", "n_tokens", "start")


def id_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, shard): unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            offsets = np.asarray(lists.offsets)
            raw = np.asarray(lists.values).astype("<u4").tobytes()
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64()), batch.column(2)], ["doc_id", "n_tokens", "ids_crc32", "shard"])

    rows = read_token_files(spark, path, ("doc_id", "ids")).withColumn("shard", F.input_file_name())
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, shard string")


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the files, read them back: doc_id, start, n_tokens, ids_crc32.

    Empty and null texts hold the end id alone; very long texts are encoded whole, a piece at a time; an empty table
    gives an empty result. Ids on several rows are returned for each, in an order of their own that ``start`` follows;
    rows without an id are left out. Other columns of ``docs`` are not read and may have any name.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id=end_id)
    return _with_starts(spark, path, id_checksums(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")
