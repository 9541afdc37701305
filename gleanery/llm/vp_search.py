"""Nearest neighbours by cosine with a vantage-point tree for each shard.

Unit vectors are searched by chord distance, which orders like the cosine and obeys the triangle inequality. A tree node
splits its vectors at the median distance to a vantage point; a query skips a side if the inequality shows that it can
hold nothing nearer than the query's k-th best so far. ``factor`` relaxes that: the k-th best distance is multiplied by
it before the test, so 1 keeps the search exact and smaller values skip more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch_path, stored

LEAF = 128
#: Bytes of vectors in a shard, and of the queries that are broadcast at once.
SHARD_BYTES, BLOCK_BYTES = 4 << 20, 16 << 20
FACTOR = 1.0
#: Squared distances are compared to 12 digits, so equal vectors tie; the tests of the tree allow for their square roots.
_SLACK = 2e-6


def build(unit: np.ndarray, leaf: int = LEAF, seed: int = 3):
    """(order of the vectors, nodes): nodes hold (vantage row or -1, radius, first, middle, end, inner node, outer node)."""
    rng = np.random.default_rng(seed)
    order, nodes = np.arange(len(unit)), []

    def grow(a: int, b: int) -> int:
        me = len(nodes)
        nodes.append((-1, 0.0, a, b, b, -1, -1))
        if b - a > leaf:
            rows = order[a:b]
            v = int(rows[rng.integers(len(rows))])
            d = np.linalg.norm(unit[rows] - unit[v], axis=1)
            s = np.argsort(d, kind="stable")
            order[a:b], d = rows[s], d[s]
            m = (b - a) // 2
            if d[-1] > 0:
                nodes[me] = (v, float(d[m]), a, a + m, b, grow(a, a + m), grow(a + m, b))
        return me

    grow(0, len(unit))
    return order, nodes


def search(unit: np.ndarray, order: np.ndarray, nodes: list, queries: np.ndarray, k: int, factor: float = FACTOR, skip: np.ndarray | None = None, ids: np.ndarray | None = None):
    """Rows and squared chord distances of the k nearest of each query (-1 where there are fewer). All queries go down together.

    ``skip`` holds the id of each query that may not be found, ``ids`` those of the vectors; ties go to smaller ids.
    """
    ids = np.arange(len(unit)) if ids is None else ids
    near = np.full((len(queries), k), np.inf)
    rows = np.full((len(queries), k), -1, np.int64)

    def leaf(a: int, b: int, q: np.ndarray) -> None:
        at = order[a:b]
        for part in range(0, len(q), 256):
            own = q[part : part + 256]
            d = np.round(np.maximum(0, 2 - 2 * (queries[own] @ unit[at].T)), 12)
            if skip is not None:
                d[ids[at][None, :] == skip[own][:, None]] = np.inf
            all_d = np.concatenate([near[own], d], axis=1)
            all_r = np.concatenate([rows[own], np.broadcast_to(at, d.shape)], axis=1)
            tie = np.where(all_r >= 0, ids[all_r], np.iinfo(np.int64).max)
            pick = np.lexsort((tie, all_d), axis=1)[:, :k]
            near[own] = np.take_along_axis(all_d, pick, 1)
            rows[own] = np.take_along_axis(all_r, pick, 1)

    def visit(node: int, q: np.ndarray) -> None:
        v, radius, a, m, b, inner, outer = nodes[node]
        if v < 0:
            leaf(a, b, q)
            return
        d = np.linalg.norm(queries[q] - unit[v], axis=1)
        first = d < radius
        for side in (True, False):  # each query takes the side it lies on first
            for child, own in ((inner, first == side), (outer, first != side)):
                x = q[own]
                if not len(x):
                    continue
                gap = d[own] - radius if child == inner else radius - d[own]
                x = x[gap <= np.sqrt(near[x, -1]) * factor + _SLACK]
                if len(x):
                    visit(child, x)

    visit(0, np.arange(len(queries)))
    rows[~np.isfinite(near)] = -1
    return rows, near


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten()).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): rows with an id and a vector of finite numbers that aren't all zero."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(fine).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of x with that of y, sums taken from the first number to the last."""
    total = lambda a, b: np.cumsum(a * b, axis=1)[:, -1]
    return total(x, y) / np.sqrt(total(x, x) * total(y, y))


def nearest(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", factor: float = FACTOR, shard_vectors: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row that ``queries`` selects, by cosine in double precision.

    A query's own id is no candidate. Vectors null, zero, or with null or non-finite numbers take no part; vectors of
    another length than the query's are no candidates. Ties go to smaller ids. Ids on several rows: every such row is a
    candidate for others, and one query is asked for each id: its least vector, number by number. Other columns are not
    read and may have any name; empty tables give no rows.

    Shards are dealt by a hash of id and vector; their number follows the bytes of the vectors, so a shard fits a task.
    Queries are broadcast in rounds of about BLOCK_BYTES; a tree is asked where it lies and never travels. k rows for each
    query come back from each tree, and the best are kept. With more than one round trees are written once, and the
    finished queries of a round too.
    """
    rows = stored(usable(vectors, id_col, vec_col).withColumn("dim", F.size("v")), "vectors")
    n, numbers = rows.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first()
    shards = max(1, -(-n // shard_vectors) if shard_vectors else -(-8 * numbers // SHARD_BYTES))
    # Equal ids may be many; their rows are dealt by content too.
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int"))
    asked = stored(rows.where(queries).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")), "queries")
    size = 8 * asked.agg(F.coalesce(F.sum("dim"), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    packed = asked.groupBy("block", "dim").agg(F.collect_list(F.struct("vec_id", "v")).alias("asked"))  # about BLOCK_BYTES each

    def plant(key, table):
        table = table.combine_chunks()
        x = _matrix(table.column("v").combine_chunks() if isinstance(table.column("v"), pa.ChunkedArray) else table.column("v"))
        order, nodes = build(_unit(x))
        node = np.array(nodes, np.float64)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "dim": pa.array([key[1].as_py()], pa.int32()), "ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()), "raw": pa.array([x.tobytes()], pa.binary()), "ord": pa.array([order.astype(np.int64).tobytes()], pa.binary()), "node": pa.array([node.tobytes()], pa.binary())})

    trees = dealt.groupBy("shard", "dim").applyInArrow(plant, "shard int, dim int, ids binary, raw binary, ord binary, node binary")

    def ask(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r] for c in batch.schema.names}
                dim = row["dim"].as_py()
                ids = np.frombuffer(row["ids"].as_py(), np.int64)
                x = np.frombuffer(row["raw"].as_py(), np.float64).reshape(-1, dim)
                order = np.frombuffer(row["ord"].as_py(), np.int64)
                nodes = [(int(v), rad, int(a), int(m), int(b), int(i), int(o)) for v, rad, a, m, b, i, o in np.frombuffer(row["node"].as_py(), np.float64).reshape(-1, 7)]
                asked = row["asked"].values
                q_ids = asked.field("vec_id").to_numpy()
                q = _matrix(asked.field("v"))
                # A few more than k, as chord distances are rounded and the scores below decide.
                found, _ = search(_unit(x), order, nodes, _unit(q), k + 3, factor, q_ids, ids)
                who, col = np.nonzero(found >= 0)
                at = found[who, col]
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[who]), pa.array(ids[at]), pa.array(cosines(q[who], x[at]))], ["query_id", "vec_id", "score"])

    from pyspark.sql import Window as W

    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))

    def ranked(own: DataFrame, which: DataFrame) -> DataFrame:
        found = own.join(F.broadcast(which), "dim").mapInArrow(ask, "query_id long, vec_id long, score double")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    if blocks == 1:
        return ranked(trees, packed.drop("block"))
    trees, path = stored(trees, "vp-trees"), scratch_path(vectors.sparkSession, "vp-rounds")
    for block in range(blocks):
        ranked(trees, packed.where(F.col("block") == block).drop("block")).write.parquet(f"{path}/round={block}")
    return vectors.sparkSession.read.parquet(path).select("query_id", "rank", "vec_id", "score")
