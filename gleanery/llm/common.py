"""What several operators of this subpackage share: shared storage, word hashing, components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a numpy step handles at once; a step needs about 60 times as much memory.
CHUNK_BYTES = 1 << 18
#: Bytes of rows that a Python worker gets at once while a frame is written: wide texts would otherwise come 10,000 rows
#: at a time, once in the JVM's direct memory and some times over in the worker.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    A local session (tests) that names none gets a new temporary folder; on a cluster that would lose data, so it raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-gleanery-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gleanery/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of at most BATCH_BYTES; the session's setting comes back afterwards."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write a frame to the shared folder and read it: lineage is cut and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def boxed(docs: DataFrame, **columns) -> DataFrame:
    """The whole row as one struct ``row`` beside new columns: names of the user's columns can't clash with ours.

    ``select("row.*")`` gives the table back as it was.
    """
    return docs.select(F.struct("*").alias("row"), *(c.alias(name) for name, c in columns.items()))


def release_memory() -> None:
    """Give what is free back to the system: a worker serves task after task, and what it keeps adds to the executor's."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library than glibc keeps what it has
        ctypes.CDLL("libc.so.6").malloc_trim(0)


# ---------------------------------------------------------------- text buffers


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n+1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Row ranges of about ``most`` bytes; a longer row is a range of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, min(b, n)
        a = b


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _POWERS[kind]
    while len(have) < n:
        step = np.uint64(pow(_BASE if kind == "up" else _BASE_INV, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    _POWERS[kind] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """n+1 prefix sums from which span_hash() takes the hash of any span."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, whatever its place."""
    down = _power("down", len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """Words `[^\\x20\\x09-\\x0D]+` of each row, ASCII letters lower-cased.

    Returns start and end of every word, its hash, and for each row the number of words before it (n+1 values).
    """
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    word = np.concatenate([[False], ~gap, [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word[1:] & (~word[:-1] | edge))
    ends = np.flatnonzero(word[:-1] & (~word[1:] | edge))
    return starts, ends, span_hash(prefix_hash(data), starts, ends), np.searchsorted(starts, offsets)


_PLACE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its word shingles; with fewer words the whole sequence is one."""
    _, _, hashes, first = words_of(data, offsets)
    n = len(hashes)
    if n >= width:
        rolled = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            rolled += hashes[k : n - width + 1 + k] * _PLACE[k]
        rolled = mix64(rolled)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            s = np.sort(rolled[a : b - width + 1])
            sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            sets.append(mix64(np.array([(hashes[a:b] * _PLACE[8 : 8 + b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


# ---------------------------------------------------------------- components


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest reachable id of each node of an undirected graph given as rows (a long, b long).

    Each round takes the least label among neighbours and then follows labels once more (pointer jumping), so the number
    of rounds grows with the logarithm of a component's diameter on chains and is 2 or 3 on stars. Every round is
    written to the shared folder. Returns (node, component); nodes without an edge do not appear.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), "cc-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc-labels")
    for _ in range(rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        took = labels.join(near, "node").select("node", F.least("label", "near").alias("mid"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        new = stored(took.join(jump, "mid", "left").select("node", F.least("mid", F.coalesce("far", "mid")).alias("label"), "old"), "cc-labels")
        moved = new.where("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError("components did not settle")
