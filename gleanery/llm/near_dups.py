"""MinHash-style near-duplicate detection on SetSketch registers.

Every document becomes the set of its word shingles. Each of ``registers`` hash functions gives the minimum of an
exponential variate over the set; the register keeps ``1 - log_b`` of that minimum, floored and truncated to 16 bits.
Such registers can be merged (maximum) and two sets agree in a register with a probability that grows with their
Jaccard similarity. Bands of registers give candidate pairs, the joint likelihood of the numbers of larger, equal and
smaller registers estimates the similarity of a pair, and the full sets decide.

Hot groups: documents with equal sets are one class from the start. Within a band's bucket only pairs with a hub are
formed; classes that are joined already need no further pair. What then still stands apart in a bucket is compared in
blocks of bounded size, so no task holds a whole bucket and no quadratic number of rows leaves one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, connected_components, mix64, release_memory, shingle_sets, stored, text_buffer

REGISTERS, BAND_ROWS = 128, 4
BASE = 1.001
TOP = (1 << 16) - 2
#: An estimate so far below the threshold (five standard errors at 128 registers) is not worth a look at the sets.
MARGIN = 0.2
BLOCK_ROWS = 2048
#: Bytes of a pair of blocks from which a worker gives memory back; most buckets are a few rows and stay below.
RELEASE_BYTES = 4 << 20
HUB_ROUNDS = 3

_RNG = np.random.default_rng(77)
_MUL = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)


def sketch(values: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes (uint16; all 0 for an empty set)."""
    if not len(values):
        return np.zeros(REGISTERS, np.uint16)
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    short = (values >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(short), 2048):
        np.minimum(low, (short[a : a + 2048, None] * _MUL + _ADD).min(axis=0), out=low)
    variate = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32)
    # Scaled so that sets of one to 2**32 members fall into the range of the registers.
    return np.clip(np.floor(1 - np.log(variate / 40.0) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate(more: np.ndarray, fewer: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Most likely Jaccard similarities, given the numbers of registers where a is larger and where b is larger."""
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    top = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 101)[None, :] * top
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    pa_, pb_ = p(u - v * grid), p(v - u * grid)
    equal = registers - more - fewer
    tiny = 1e-300
    like = more[:, None] * np.log(pa_ + tiny) + fewer[:, None] * np.log(pb_ + tiny) + equal[:, None] * np.log(np.maximum(1 - pa_ - pb_, 0) + tiny)
    return grid[np.arange(len(like)), like.argmax(axis=1)]


def _bands(registers: np.ndarray) -> np.ndarray:
    rows = registers.reshape(len(registers), -1, BAND_ROWS).astype(np.uint64)
    key = rows[:, :, 0].copy()
    for k in range(1, BAND_ROWS):
        key = key << np.uint64(16) | rows[:, :, k]
    # The band's number is part of the key.
    return mix64(key ^ (np.arange(key.shape[1], dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc_id, th, n, f1, f2, bands, regs): hash of the text, set size, 128-bit fingerprint of the set, band keys, registers."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            data, offsets = text_buffer(batch.column(1))
            for a, b in chunks(offsets):
                sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                regs = np.stack([sketch(s) for s in sets])
                n = np.array([len(s) for s in sets], np.int64)
                f1 = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                f2 = np.array([mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                bands = _bands(regs)
                lists = pa.ListArray.from_arrays(np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32), pa.array(bands.ravel()))
                raw = pa.array([r.tobytes() for r in regs], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(n), pa.array(f1), pa.array(f2), lists, raw], ["doc_id", "th", "n", "f1", "f2", "bands", "regs"])
            release_memory()

    return _texts(docs, id_col, text_col).where("doc_id is not null").mapInArrow(run, "doc_id long, th long, n long, f1 long, f2 long, bands array<long>, regs binary")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))


def shingle_table(rows: DataFrame, width: int) -> DataFrame:
    """Of rows (rep, text): (rep, shingles), the sorted full set of each text."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, b in chunks(offsets):
                sets = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(ends, pa.array(flat))], ["rep", "shingles"])
            release_memory()

    return rows.select("rep", "text").mapInArrow(run, "rep long, shingles array<long>")


def _likely(pairs: DataFrame, threshold: float) -> DataFrame:
    """Of rows (a, b, na, nb, ra, rb) those whose estimated similarity comes near the threshold, with the estimate."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (4, 5))
            na, nb = (batch.column(k).to_numpy().astype(float) for k in (2, 3))
            est = estimate((ra > rb).sum(1), (ra < rb).sum(1), na, nb)
            keep = (est >= threshold - MARGIN) & (np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9)
            out = pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(est)], ["a", "b", "na", "nb", "est"])
            yield out.filter(pa.array(keep))

    return pairs.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long, na long, nb long, est double")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets meet 100 * intersection >= percent * union."""
    one = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
    two = one.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return two.withColumn("both", both).where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _in_blocks(rows: DataFrame, threshold: float, percent: int, exact: bool) -> DataFrame:
    """Pairs across components within each bucket, block against block.

    rows: (key, i, j, rep, comp, n, regs[, shingles]); a group holds two blocks of a bucket. Pairs are looked at in the
    first bucket that both share. Without sets: the rows that have a partner whose estimate comes near the threshold.
    With sets: verified links, one for each row and component, which is all that components depend on.
    """

    def run(key, table):
        table = table.combine_chunks()
        here = key[0].as_py()
        rep, comp = table.column("rep").to_numpy(), table.column("comp").to_numpy()
        n = table.column("n").to_numpy().astype(float)
        regs = np.frombuffer(b"".join(table.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        bands = _bands(regs)
        if exact:
            lists = table.column("shingles").combine_chunks() if isinstance(table.column("shingles"), pa.ChunkedArray) else table.column("shingles")
            at = np.asarray(lists.offsets)
            flat = np.asarray(lists.values).view(np.uint64)
        flagged, links = np.zeros(len(rep), bool), []
        for x in range(len(rep) - 1):
            y = np.flatnonzero((comp[x + 1 :] != comp[x]) & (np.minimum(n[x + 1 :], n[x]) >= threshold * np.maximum(n[x + 1 :], n[x]) - 1e-9)) + x + 1
            if not len(y):
                continue
            y = y[bands[y, (bands[y] == bands[x]).argmax(axis=1)] == here]
            est = estimate((regs[x] > regs[y]).sum(1), (regs[x] < regs[y]).sum(1), np.full(len(y), n[x]), n[y])
            y = y[est >= threshold - MARGIN]
            if not len(y):
                continue
            flagged[x] = True
            flagged[y] = True
            if exact:
                own = flat[at[x] : at[x + 1]]
                theirs = np.concatenate([flat[at[k] : at[k + 1]] for k in y])
                same = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
                both = np.add.reduceat(same.astype(np.int64), np.concatenate([[0], np.cumsum(n[y].astype(np.int64))[:-1]]))
                y = y[100 * both >= percent * (n[x] + n[y] - both)]
                y = y[np.unique(comp[y], return_index=True)[1]]
                links += [(rep[x], rep[k]) for k in y]
        if table.nbytes > RELEASE_BYTES:
            release_memory()
        if exact:
            a, b = zip(*links, strict=True) if links else ((), ())
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        kept = table.filter(pa.array(flagged))
        return pa.table({c: kept.column(c) for c in ("key", "i", "j", "rep", "comp")})

    return rows.groupBy("key", "i", "j").applyInArrow(run, "a long, b long" if exact else "key long, i int, j int, rep long, comp long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = 5) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id reachable over links), kept.

    Documents are linked when 100 * |A and B| >= percent * |A or B| for their sets of ``width``-word shingles.
    Null, empty and blank texts have an empty set: n_shingles 0, no link, kept. Rows without an id are left out. An id
    that occurs on several rows is returned for each row with the size of its own set; the links of all its texts are
    the id's links. Very long texts are read whole. Other columns of ``docs`` are not read and may have any name. An
    empty table gives an empty result.
    """
    threshold = percent / 100
    sk = stored(sketches(docs, id_col, text_col, width), "sketches")
    # A class is one set of shingles; ``rep`` numbers it, the number is fixed once the table is written.
    same = sk.where("n > 0").groupBy("f1", "f2", "n").agg(F.min(F.struct("doc_id", "th")).alias("own"), F.first("regs").alias("regs"), F.first("bands").alias("bands"))
    classes = stored(same.withColumn("rep", F.monotonically_increasing_id()), "classes")
    # A table of its own on one side lets Spark split a class of very many documents on the other.
    member = stored(sk.select("doc_id", "n", "f1", "f2").join(classes.select("f1", "f2", "n", "rep"), ["f1", "f2", "n"], "left").select("doc_id", "n", "rep"), "members")
    reps = classes.select("rep", "n", "regs", "bands")
    twice = member.where("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select("doc_id", "a")
    links = stored(member.join(twice, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct(), "id-links")
    spread = reps.select("rep", F.explode("bands").alias("key"))
    full = spread.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("least")).where("size > 1")
    buckets = stored(spread.join(full, "key"), "buckets")
    if not buckets.limit(1).count() and not links.limit(1).count():
        least = classes.select("rep", F.col("own.doc_id").alias("least"))
        return _labelled_members(member, least)
    inside = buckets.select("rep").distinct()
    regs = stored(reps.select("rep", "n", "regs").join(inside, "rep"), "regs")
    wanted = classes.join(inside, "rep").select("rep", "own.doc_id", "own.th")
    sets = stored(shingle_table(_texts(docs, id_col, text_col).join(wanted, ["doc_id", "th"]).dropDuplicates(["rep"]), width), "sets")
    comps = connected_components(links) if links.limit(1).count() else None

    def attach(pairs: DataFrame) -> DataFrame:
        side = lambda x: regs.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
        return _likely(pairs.join(side("a"), "a").join(side("b"), "b"), threshold)

    def labelled(rows: DataFrame) -> DataFrame:
        if comps is None:
            return rows.withColumn("comp", F.col("rep"))
        return rows.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("comp", F.coalesce("component", "rep")).drop("component")

    def add(found: DataFrame):
        nonlocal links, comps
        links = stored(links.unionByName(found), "links")
        comps = connected_components(links)

    open_rows = labelled(buckets)
    for round_ in range(HUB_ROUNDS):
        # A hub per bucket, another one each round; every class tries the one that it shares most buckets with.
        order = F.xxhash64("rep", F.lit(round_)) if round_ else F.col("rep")
        hubs = open_rows.groupBy("key").agg(F.min_by(F.struct("rep", "comp"), order).alias("hub"))
        pairs = open_rows.join(hubs, "key").where("comp <> hub.comp").select(F.col("rep").alias("a"), F.col("hub.rep").alias("b"))
        pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("shared")).groupBy("a").agg(F.max_by("b", F.struct("shared", F.xxhash64("b"))).alias("b"))
        before = links.count()
        add(_confirmed(attach(pairs), sets, percent))
        mixed = labelled(buckets)
        spans = mixed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
        open_rows = stored(mixed.join(spans, "key"), "open")
        if links.count() == before:
            break
    if open_rows.limit(1).count():
        blocks = F.ceil(F.col("size") / BLOCK_ROWS).cast("int")
        dealt = open_rows.select("key", "rep", "comp", blocks.alias("blks")).withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("blks")).cast("int"))
        rows = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blks") - 1))).select("key", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "rep", "comp")
        # First which rows have a likely partner, on registers alone; only those bring their sets.
        likely = stored(_in_blocks(rows.join(regs, "rep"), threshold, percent, exact=False), "likely")
        add(stored(_in_blocks(likely.join(regs, "rep").join(sets, "rep"), threshold, percent, exact=True), "block-links"))
    own = classes.select("rep", "own.doc_id").join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = stored(own.groupBy("component").agg(F.min("doc_id").alias("least")), "least-ids")
    return _labelled_members(member, stored(own.join(least, "component").select("rep", "least"), "class-labels"))


def _labelled_members(member: DataFrame, least: DataFrame) -> DataFrame:
    out = member.join(least, "rep", "left").withColumn("component_id", F.coalesce("least", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("component_id") == F.col("doc_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = 5) -> DataFrame:
    """The documents that represent their group: one of each, and every document that is alike to none.

    All columns are kept, whatever their names. Rows without an id stay as they are; of several rows with one kept id
    each stays.
    """
    gone = near_duplicates(docs, id_col, text_col, percent, width).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["gone"], "left_anti")
