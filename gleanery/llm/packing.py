"""Best-fit packing into sequences of several permitted lengths.

Pieces come longest first. A piece goes into the open bin that it fills best; if none has room, the bin size is opened
that costs least for each token it is likely to hold, given how full bins of that size have become so far. At the end
every bin shrinks to the least permitted length that holds its contents. Texts over the greatest length are cut into
full bins and a rest, so no token is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks
from .token_files import encoder

#: Permitted sequence lengths in tokens, and what a sequence costs besides its length.
SIZES = (256, 512, 1024, 2048)
OVERHEAD = 32
#: Documents that are packed together at most; a task packs its rows in such blocks.
BLOCK_DOCS = 50_000
SCHEMA = "doc_id long, piece int, bin_id long, bin_size int, start int, length int"


class _Open:
    """Open bins by free space: a stack for each value and a bit set of the values in use."""

    def __init__(self, most: int):
        self.stacks: list[list[int]] = [[] for _ in range(most + 1)]
        self.used = 0

    def put(self, free: int, k: int) -> None:
        if free:
            self.stacks[free].append(k)
            self.used |= 1 << free

    def take(self, need: int) -> tuple[int, int] | None:
        """Bin with the least free space that is at least ``need``, and that space."""
        above = self.used >> need
        if not above:
            return None
        free = need + (above & -above).bit_length() - 1
        k = self.stacks[free].pop()
        if not self.stacks[free]:
            self.used ^= 1 << free
        return k, free


def pack(lengths: np.ndarray, sizes: tuple[int, ...] = SIZES, overhead: int = OVERHEAD):
    """Bins of texts with these lengths (each at least 1).

    Returns arrays (text, piece, bin, start, length) and the final size of each bin. Ties are broken by position.
    """
    sizes = tuple(sorted(set(sizes)))
    top = sizes[-1]
    full, rest = np.divmod(lengths, top)
    text, piece, bin_, start, length = [], [], [], [], []
    filled: list[int] = []
    for t in np.flatnonzero(full):
        for p in range(full[t]):
            text.append(t), piece.append(p), bin_.append(len(filled)), start.append(0), length.append(top)
            filled.append(top)
    bins = _Open(top)
    held = dict.fromkeys(sizes, 1.0)  # tokens in bins of a size, and their number times that size: mean fill
    room = dict.fromkeys(sizes, 1.0)
    size_of: dict[int, int] = {}
    order = np.lexsort((np.arange(len(rest)), -rest))
    for t in order[rest[order] > 0].tolist():
        n = int(rest[t])
        found = bins.take(n)
        if found is None:
            size = min((s for s in sizes if s >= n), key=lambda s: ((s + overhead) / max(n, s * held[s] / room[s]), s))
            k, free = len(filled), size
            filled.append(0)
            size_of[k] = size
            room[size] += size
        else:
            k, free = found
        text.append(t), piece.append(int(full[t])), bin_.append(k), start.append(filled[k]), length.append(n)
        filled[k] += n
        held[size_of[k]] += n
        bins.put(free - n, k)
    final = np.array(sizes)[np.searchsorted(sizes, np.array(filled, np.int64))] if filled else np.zeros(0, np.int64)
    return *(np.array(x, np.int64) for x in (text, piece, bin_, start, length)), final


def pack_documents(docs: DataFrame, tokenizer: str | None = None, length: Column | None = None, id_col: str = "doc_id", text_col: str = "text", sizes: tuple[int, ...] = SIZES, overhead: int = OVERHEAD, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(doc_id, piece, bin_id, bin_size, start, length): where each piece of each document lies.

    Lengths are the ids that ``tokenizer`` (a file of the tokenizers library) gives a text, with one end mark; or the
    column ``length``; without either, words and an end mark. A length that is null or under 1 counts as 1, so null and
    empty texts are packed too; a text over the greatest size is cut into full bins and a rest. Each row is packed, also
    rows that repeat an id and rows without one; equal lengths go in the order of rows. Other columns are not read. Only
    ids and lengths leave a batch; every task packs its own rows, so nothing is shuffled and a lost task is simply done
    again. An empty table gives no rows.
    """
    if tokenizer is not None:
        n = F.col(text_col).cast("string")
    else:
        words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(r"\S+")), F.lit(0)) + 1
        n = F.greatest(F.coalesce(words if length is None else length, F.lit(1)).cast("long"), F.lit(1))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), n.alias("n"))

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        if tokenizer is None:
            return batch
        size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
        enc, found = encoder(tokenizer), [np.zeros(0, np.int64)]
        for a, b in chunks(np.concatenate([[0], np.cumsum(size)])):
            found.append(enc.lengths([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]) + 1)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found))], ["doc_id", "n"])

    def flush(ids: list[pa.Array], counts: list[np.ndarray], first: int):
        id_array = pa.concat_arrays(ids)
        text, piece, bin_, start, size, final = pack(np.concatenate(counts), sizes, overhead)
        out = [id_array.take(pa.array(text)), pa.array(piece, pa.int32()), pa.array(bin_ + first), pa.array(final[bin_], pa.int32()), pa.array(start, pa.int32()), pa.array(size, pa.int32())]
        return pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "bin_id", "bin_size", "start", "length"]), len(final)

    def run(batches):
        base, made = TaskContext.get().partitionId() << 33, 0
        ids, counts, held = [], [], 0
        for batch in map(counted, batches):
            for a in range(0, batch.num_rows, block_docs):
                part = batch.slice(a, block_docs)
                if held and held + part.num_rows > block_docs:
                    out, n_bins = flush(ids, counts, base + made)
                    yield out
                    ids, counts, held, made = [], [], 0, made + n_bins
                ids.append(part.column(0))
                counts.append(part.column(1).to_numpy())
                held += part.num_rows
        if held:
            yield flush(ids, counts, base + made)[0]

    return rows.mapInArrow(run, SCHEMA)
