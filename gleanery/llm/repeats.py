"""Removal of byte strings that occur more than once, by merging the Burrows-Wheeler transforms of shards.

Sampling. In a window of SPAN bytes the leftmost least hash of its GRAM-byte strings marks the window's anchor. Equal
windows have their anchor at the same place, so a window that occurs again has an anchor that occurs again, and only the
texts around such anchors need an order: to the right up to the end of the last window of the anchor, and to the left,
read backwards, up to the start of the first.

Shards. These strings are cut into blocks of BLOCK bytes; the distinct blocks in lexicographic order are the alphabet.
Each shard of strings gets its own Burrows-Wheeler transform over blocks: for every suffix of its strings, in order, the
block that stands before it. Shards are merged by interleave refinement: the interleave says from which shard each next
suffix comes; at first shard stands after shard. A turn reads the transforms in the order of the interleave and deals
the shard numbers out by the symbols read, stably. After t turns the suffixes are in order of their first t blocks,
and a boundary that appears in turn t parts suffixes with t - 1 common blocks; the bytes of the two blocks in which
neighbours part give the rest of their common prefix. No suffix is compared or sorted anew.

Repeats. In the merged right order, strings with a common prefix of at least r form intervals, likewise backwards for
left strings. A window that starts o bytes before its anchor occurs again exactly if another string lies in the same
left interval at depth o and in the same right interval at depth SPAN - o.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix64, stored, text_buffer

SPAN, GRAM = 400, 32
#: Bytes of a block, the symbol of the transforms; a block and its length are four numbers of 64 bits.
BLOCK = 31
#: Strings of one shard, and contexts that a task merges together (about).
SHARD_ROWS, BUCKET_ROWS = 1024, 4096


# ---------------------------------------------------------------- anchors


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position on (shorter array by gram - 1)."""
    wide = data.astype(np.uint64)
    word = wide[: max(0, len(wide) - 7)].copy()
    for k in range(1, 8):
        word |= wide[k : len(wide) - 7 + k] << np.uint64(8 * k)
    word = word * np.uint64(0x9E3779B97F4A7C15)
    word ^= word >> np.uint64(32)
    m = len(data) - gram + 1
    total = np.zeros(m, np.uint64)
    steps = [*range(0, gram - 7, 8)]
    if steps[-1] != gram - 8:
        steps.append(gram - 8)
    for k in steps:
        total = (total + word[k : k + m]) * np.uint64(0xC2B2AE3D27D4EB4F)
        total ^= total >> np.uint64(29)
    return total


def _window_minima(values: np.ndarray, width: int, valid: np.ndarray) -> np.ndarray:
    """Positions of the leftmost least value of each valid window of ``width`` values in order, each with its first and last window."""
    n = len(valid)
    pad = -len(values) % width
    v = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(v, axis=1).ravel()
    back = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
    fresh = np.concatenate([[True], (low[1:] != low[:-1]) | (valid[1:] != valid[:-1])])
    starts = np.flatnonzero(fresh)
    ends = np.concatenate([starts[1:], [n]])
    keep = valid[starts]
    starts, ends = starts[keep], ends[keep]
    # A minimum that falls came in at the right end of the window; one that rises is looked for.
    fell = (starts > 0) & (low[starts] < low[starts - 1]) & valid[starts - 1]
    place = np.where(fell, starts + width - 1, -1)
    more = []
    for k in np.flatnonzero((place < 0) | (place + 1 < ends)).tolist():
        at, end = int(starts[k]), int(ends[k])
        if place[k] >= 0:
            at = int(place[k]) + 1
        while at < end:  # the windows of one run share the minimum, ties follow one another
            p = at + int(values[at : at + width].argmin())
            more.append((p, at, min(p, end - 1)))
            at = p + 1
    more = np.array(more, np.int64).reshape(-1, 3)
    first = np.stack([place[fell], starts[fell], np.minimum(place[fell], ends[fell] - 1)], axis=1)
    found = np.concatenate([first, more])
    return found[np.argsort(found[:, 0], kind="stable")]


def anchors(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, position in the row, least and greatest offset, gram hash) of the anchors of each text of at least ``span`` bytes.

    The windows of an anchor start at those offsets before it; each window of a text has one anchor.
    """
    n = len(data) - span + 1
    if n <= 0:
        return (*(np.zeros(0, np.int64) for _ in range(4)), np.zeros(0, np.uint64))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    h = _gram_hashes(data, gram)
    at, first, last = _window_minima(h, span - gram + 1, row[:n] == row[span - 1 :]).T
    return row[at], at - offsets[row[at]], at - last, at - first, h[at]


# ---------------------------------------------------------------- transforms of shards and their merge


def symbols_of(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of the blocks of each string (0 behind its end), the blocks as four numbers each, and the strings' lengths.

    The fourth number ends with the block's length, so symbols are in the order of the blocks and a block that ends a
    string differs from one that goes on with zeros.
    """
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    wide = max(1, -(-int(lengths.max(initial=0)) // BLOCK))
    rows = np.zeros((len(strings), wide, 32), np.uint8)
    rows[:, :, :BLOCK] = np.frombuffer(b"".join(s.ljust(wide * BLOCK, b"\0") for s in strings), np.uint8).reshape(len(strings), wide, BLOCK)
    rows[:, :, BLOCK] = np.clip(lengths[:, None] - BLOCK * np.arange(wide), 0, BLOCK)
    words = rows.view(">u8").astype(np.uint64)
    present = rows[:, :, BLOCK] > 0
    flat = words[present]
    key = flat[:, 0]
    for k in range(1, 4):
        key = mix64(key) + flat[:, k]
    _, first, which = np.unique(mix64(key), return_index=True, return_inverse=True)
    if (flat[first[which]] != flat).any():  # two blocks with one hash
        _, first, which = np.unique(flat, axis=0, return_index=True, return_inverse=True)
    alphabet = flat[first]
    rank = np.empty(len(alphabet), np.int32)
    rank[np.lexsort(alphabet.T[::-1])] = np.arange(1, len(alphabet) + 1)
    symbols = np.zeros((len(strings), wide), np.int32)
    symbols[present] = rank[which.ravel()]
    return symbols, words, lengths


def transform(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of the strings of one shard, and for each of its places the string that the suffix there is, or -1.

    Suffixes are ordered by doubling the number of blocks looked at; equal ones by string. The end of a string is less
    than every block, and 0 stands before a string's first block.
    """
    n, wide = symbols.shape
    text = np.concatenate([symbols, np.zeros((n, 1), symbols.dtype)], axis=1)
    rank, step = text.astype(np.int64), 1
    while step <= wide:
        ahead = np.zeros_like(rank)
        ahead[:, :-step] = rank[:, step:]
        key = rank * (int(rank.max()) + 1) + ahead
        rank = np.unique(key, return_inverse=True)[1].reshape(rank.shape)
        step *= 2
    string, at = np.nonzero(np.arange(wide + 1) <= (symbols > 0).sum(axis=1)[:, None])
    order = np.argsort(rank[string, at], kind="stable")
    string, at = string[order], at[order]
    return np.where(at > 0, text[string, at - 1], 0), np.where(at == 0, string, -1)


def _dealt(symbols: np.ndarray) -> np.ndarray:
    """Stable order of symbols, 16 bits at a time."""
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    if len(symbols) and symbols.max() > 0xFFFF:
        order = order[np.argsort((symbols >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def merge(shards: list[tuple[np.ndarray, np.ndarray]], turns: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of all strings of the shards by their first ``turns`` blocks, and the blocks that each shares with the one before.

    Only the transforms are read. Shards must be transforms of sorted suffixes: places are taken from each in its order.
    """
    symbols = np.concatenate([s for s, _ in shards])
    strings = [int((w >= 0).sum()) for _, w in shards]
    base = np.concatenate([[0], np.cumsum(strings)])
    whole = np.concatenate([np.where(w >= 0, w + b, -1) for (_, w), b in zip(shards, base, strict=False)])
    kind = np.uint8 if len(shards) < 256 else np.uint16
    ends = np.repeat(np.arange(len(shards), dtype=kind), strings)
    mix = np.repeat(np.arange(len(shards), dtype=kind), [len(s) for s, _ in shards])
    new = np.zeros(len(mix), bool)
    new[:1] = True
    group_of = np.zeros(len(ends), np.int64)
    place, groups = np.empty(len(mix), np.int64), []
    for turn in range(turns + 1):
        # The k-th place of the interleave that names a shard is that shard's k-th place.
        place[np.argsort(mix, kind="stable")] = np.arange(len(mix))
        group, at = np.cumsum(new), np.flatnonzero(whole[place] >= 0)
        group_of[whole[place[at]]] = group[at]
        if turn:
            groups.append(group_of.copy())
        if turn == turns:
            break
        read = symbols[place]
        live = np.flatnonzero(read)
        live = live[_dealt(read[live])]
        fresh = np.zeros(len(mix), bool)
        fresh[[0, len(ends)][: 1 + (len(live) > 0)]] = True
        x, g = read[live], group[live]
        fresh[len(ends) + 1 :] = (x[1:] != x[:-1]) | (g[1:] != g[:-1])
        dealt = np.concatenate([ends, mix[live]])
        if turn and (dealt == mix).all() and (fresh == new).all():
            groups += groups[-1:] * (turns - turn)  # settled: what is together now is equal
            break
        mix, new = dealt, fresh
    order = whole[place[at]]
    shared = np.zeros(len(order), np.int64)
    for g in groups:
        shared[1:] += g[order[1:]] == g[order[:-1]]
    return order, shared


def merged_order(strings: list[bytes], shard_rows: int = SHARD_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings and the bytes that each shares with the one before it (-1 for the first)."""
    symbols, words, lengths = symbols_of(strings)
    order, shared = merge([transform(symbols[a : a + shard_rows]) for a in range(0, len(strings), shard_rows)], symbols.shape[1])
    at = np.minimum(shared[1:], symbols.shape[1] - 1)
    differ = (words[order[1:], at] ^ words[order[:-1], at]).astype(">u8").view(np.uint8) != 0
    same = np.where(differ.any(axis=1), np.minimum(differ.argmax(axis=1), BLOCK), BLOCK)
    common = np.where(shared[1:] < symbols.shape[1], BLOCK * shared[1:] + same, BLOCK * symbols.shape[1])
    return order, np.concatenate([[-1], np.minimum(common, np.minimum(lengths[order[1:]], lengths[order[:-1]]))])


def repeated_reach(left: list[bytes], right: list[bytes], times: np.ndarray, lo: np.ndarray, hi: np.ndarray, span: int = SPAN, shard_rows: int = SHARD_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest offset (-1: none) at which a window around each context's anchor occurs again.

    ``left`` is read backwards from the anchor. Only offsets in [lo, hi] of a row count. All windows of an anchor hold
    the anchor, so what they cover together reaches from the greatest offset before it to the least one's end.
    """
    m = len(left)
    (order_r, lcp_r), (order_l, lcp_l) = (merged_order(x, shard_rows) for x in (right, left))
    least, most = np.full(m, -1, np.int64), np.full(m, -1, np.int64)
    best = lambda order, lcp: np.maximum(lcp, np.concatenate([lcp[1:], [-1]]))[np.argsort(order)]
    alive = (best(order_r, lcp_r) + best(order_l, lcp_l) >= span) | (times > 1)
    if not alive.any():
        return least, most
    in_r, in_l = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in range(int(lo[alive].min()), int(hi[alive].max()) + 1):
        on = np.flatnonzero(alive & (lo <= o) & (o <= hi))
        if not len(on):
            continue
        in_r[order_r] = np.cumsum(lcp_r < span - o)
        in_l[order_l] = np.cumsum(lcp_l < o)
        both = in_r[on] * (m + 1) + in_l[on]
        s = np.argsort(both, kind="stable")
        eq = both[s[1:]] == both[s[:-1]]
        again = times[on] > 1
        again[s[1:][eq]] = True
        again[s[:-1][eq]] = True
        hit = on[again]
        most[hit] = o
        least[hit[least[hit] < 0]] = o
    return least, most


# ---------------------------------------------------------------- Spark


#: Distinct contexts that meet in one task at most; more under one key are split by ranges of offsets.
HOT_CONTEXTS = 2048
#: Ranges into which a range of offsets is split.
RANGES = 8


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _anchor_rows(rows: DataFrame, span: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for a, b in chunks(offsets, 1 << 20):
                row, at, lo, hi, h = anchors(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], span, gram)
                take = pa.array(row + a)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *(pa.array(x, pa.int32()) for x in (at, lo, hi)), pa.array(h.view(np.int64))], ["doc_id", "th", "pos", "lo", "hi", "h"])

    return rows.mapInArrow(run, "doc_id long, th long, pos int, lo int, hi int, h long")


def _context_rows(rows: DataFrame, span: int) -> DataFrame:
    """(doc_id, th, ctx, h, left, right, places): each distinct context of a document once, left read backwards.

    A periodic text has an anchor in every period, so positions stay in numpy arrays and rows leave in small batches.
    """

    def run(batches):
        for whole in batches:
            for first in range(0, whole.num_rows, 128):
                batch = whole.slice(first, 128)
                out = {k: [] for k in ("doc", "ctx", "h", "left", "right", "places")}
                lists = batch.column(3)
                ends = np.asarray(lists.offsets)
                pos, lo, hi, h = (np.asarray(lists.values.field(c)) for c in ("pos", "lo", "hi", "h"))
                for k in range(batch.num_rows):
                    raw, seen = batch.column(2)[k].as_py().encode(), {}
                    for x in range(ends[k], ends[k + 1]):
                        p = int(pos[x])
                        both = raw[p - hi[x] : p], raw[p : p - lo[x] + span]
                        seen.setdefault(both, (int(h[x]), []))[1].append(p)
                    for (left, right), (anchor, places) in seen.items():
                        out["doc"].append(k)
                        out["ctx"].append(hashlib.blake2b(len(left).to_bytes(4, "big") + left + right, digest_size=16).digest())
                        out["h"].append(anchor)
                        out["left"].append(left[::-1])
                        out["right"].append(right)
                        out["places"].append(np.array(places, np.int32))
                take = pa.array(out["doc"], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(out["ctx"], pa.binary()), pa.array(out["h"], pa.int64()), pa.array(out["left"], pa.binary()), pa.array(out["right"], pa.binary()), pa.array(out["places"], pa.list_(pa.int32()))],
                    ["doc_id", "th", "ctx", "h", "left", "right", "places"],
                )

    return rows.mapInArrow(run, "doc_id long, th long, ctx binary, h long, left binary, right binary, places array<int>")


def _reaches(contexts: DataFrame, span: int, gram: int, hot: int, shard_rows: int) -> DataFrame:
    """(ctx, least, most) of each distinct context that holds a repeated window.

    Contexts meet under their anchor. All windows at offsets a to b share a bytes before the anchor and span - b bytes
    from it on, so where a key has more than ``hot`` contexts, its range of offsets is split and equal windows meet
    under the hash of what the windows of a smaller range share; and again, until few contexts are left or one offset,
    at which equal keys are equal windows. So no task sees more than ``hot`` contexts of a key, however many share it.
    """
    bits = lambda a, b: F.xxhash64("h", a, F.col("left").substr(F.lit(1), a), F.col("right").substr(F.lit(1), F.lit(span) - b))
    # Offsets of a context: up to the bytes on its left, from what the bytes on its right leave.
    rows = contexts.select(F.col("h").alias("key"), "h", "ctx", "left", "right", "times", (F.lit(span) - F.octet_length("right")).alias("lo"), F.octet_length("left").alias("hi"))
    total, width, parts, decided = contexts.count(), span - gram + 1, [], None
    while True:
        # Keys over the bound are at most one for each ``hot`` contexts; Spark broadcasts them if they are small.
        many = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot), "hot-keys")
        extra = many.agg(F.sum("n")).first()[0]
        if not extra:
            parts.append(rows)
            break
        parts.append(rows.join(many, "key", "left_anti"))
        rows = rows.join(many.select("key"), "key", "left_semi")
        if width == 1:
            decided = rows.select("ctx", F.col("lo").alias("least"), F.col("hi").alias("most"))
            break
        width = -(-width // RANGES)
        total += extra * RANGES
        split = rows.withColumn("k", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width)))).withColumn("a", (F.col("k") * width).cast("int")).withColumn("b", (F.col("k") * width + width - 1).cast("int"))
        split = split.withColumn("key", bits(F.col("a"), F.least("b", F.lit(span - gram)))).withColumn("lo", F.greatest("lo", "a")).withColumn("hi", F.least("hi", "b"))
        rows = stored(split.drop("k", "a", "b"), "split-contexts")
    spark = contexts.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_ROWS)
    for k, part in enumerate(parts):
        parts[k] = part.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "ctx", "left", "right", "times", "lo", "hi")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)

    def run(table):
        cols = [table.column(c).to_numpy().astype(np.int64) for c in ("times", "lo", "hi")]
        least, most = repeated_reach(table.column("left").to_pylist(), table.column("right").to_pylist(), *cols, span, shard_rows)
        hit = np.flatnonzero(most >= 0)
        return pa.table({"ctx": table.column("ctx").take(pa.array(hit)).cast(pa.binary()), "least": pa.array(least[hit], pa.int32()), "most": pa.array(most[hit], pa.int32())})

    found = rows.groupBy("bucket").applyInArrow(run, "ctx binary, least int, most int")
    return found if decided is None else found.unionByName(decided)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int = GRAM, hot: int = HOT_CONTEXTS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, th, spans): byte ranges (start, end) of each text, unsorted and overlapping, that windows which occur again cover."""
    rows = _read(docs, id_col, text_col)
    same = lambda x: F.col("__d").eqNullSafe(F.col(f"{x}.doc_id")) & (F.col("__t") == F.col(f"{x}.th"))  # noqa: E731  null ids are a value like any other
    found = stored(_anchor_rows(rows.where(F.octet_length("text") >= span), span, gram), "anchors")
    # Tables of their own on the small side let Spark split a hot key of the large side.
    often = stored(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "frequent-anchors")
    places = found.join(often, "h").groupBy("doc_id", "th").agg(F.collect_set(F.struct("pos", "lo", "hi", "h")).alias("found"))
    keyed = rows.withColumnsRenamed({"doc_id": "__d", "th": "__t"})
    both = keyed.join(places.alias("p"), same("p")).select("doc_id", "th", "text", "found")
    held = stored(_context_rows(both, span), "contexts")
    # Rows that repeat one id and text are rows of their own here, so their windows count as often as they occur.
    weight = F.sum(F.size("places")).alias("times")
    distinct = stored(held.groupBy("ctx").agg(F.first("h").alias("h"), F.first("left").alias("left"), F.first("right").alias("right"), weight), "distinct-contexts")
    reach = stored(_reaches(distinct, span, gram, hot, shard_rows).groupBy("ctx").agg(F.min("least").alias("least"), F.max("most").alias("most")), "reaches")
    hit = held.select("doc_id", "th", "ctx", "places").distinct().join(reach, "ctx")
    spans = F.transform("places", lambda p: F.struct((p - F.col("most")).alias("start"), (p - F.col("least") + span).alias("end")))
    return hit.groupBy("doc_id", "th").agg(F.flatten(F.collect_list(spans)).alias("spans"))


def _kept(raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[bytes, int, int]:
    """What is left of a text, removed bytes and maximal removed runs."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.concatenate([[True], start[1:] > reach[:-1]])
    a, b = start[first], reach[np.concatenate([np.flatnonzero(first)[1:] - 1, [len(start) - 1]])]
    parts = [raw[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(raw)], strict=True)]
    return b"".join(parts), int((b - a).sum()), len(a)


def removal_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    Null and empty texts have 0 bytes and the hash of nothing. Rows that repeat a text make all its windows occur again,
    whether they repeat the id too or have none. Very long texts are read in whole; of a periodic one every distinct
    context is kept once. An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    rows = _read(docs, id_col, text_col)
    spans = repeated_spans(docs, id_col, text_col, **how).withColumnRenamed("doc_id", "__d").withColumnRenamed("th", "__t")
    none = F.array().cast("array<struct<start:int,end:int>>")
    both = rows.join(spans, F.col("__d").eqNullSafe(F.col("doc_id")) & (F.col("__t") == F.col("th")), "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))

    def run(batches):
        for batch in batches:
            n, removed, runs, sha = [], [], [], []
            lists = batch.column(2)
            ends = np.asarray(lists.offsets)
            start, end = (np.asarray(lists.values.field(c)) for c in ("start", "end"))
            for row in range(batch.num_rows):
                raw = batch.column(1)[row].as_py().encode()
                x, y = ends[row], ends[row + 1]
                kept, r, k = _kept(raw, start[x:y], end[x:y]) if y > x else (raw, 0, 0)
                n.append(len(raw)), removed.append(r), runs.append(k), sha.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n, removed, runs)), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
