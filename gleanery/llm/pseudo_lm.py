"""Masked pseudo-likelihood: every token predicted from the tokens on both sides.

The network sums one vector for each place of a window around the masked token, applies tanh, and gives the token's
probability in two softmax steps (its class, then the token within the class). The log-probabilities of all tokens of a
document are its score. Words are counted over the whole corpus for the vocabulary; each partition trains the network
on all its texts from a common start by stochastic gradient descent in numpy; the networks are averaged by tokens.

The network's ids are the most frequent words and RARE cells that the other words share by hash. A word of a cell has
the cell's probability times its share of the cell's tokens in the whole corpus, so every word has a probability of its
own and those of all words sum to one. Shares of words over a count floor are broadcast, those of the rest are joined;
the floor changes no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, stored, text_buffer, words_of

CLASSES, MEMBERS = 32, 32
VOCABULARY = CLASSES * MEMBERS
#: Ids: 0 stands beyond a text's edges, the next RARE share the rest of the words by hash, then frequent words.
RARE = 63
FREQUENT = VOCABULARY - RARE - 1
SIDE, DIM = 2, 12
BATCH_TOKENS, RATE = 8192, 0.6
#: The pass over the corpus has the rate of the start, so that the corpus and not the start sets the network.
CORPUS_RATE = RATE
#: Most words of cells whose shares are broadcast; a token of any other word becomes a row of a join.
KNOWN_WORDS = 1 << 18
#: The common start is trained on at most so many documents.
START_DOCS = 1500
#: Bytes of a text of the start sample at most, so that the one task that sees the sample is bounded.
START_BYTES = 64 << 10

_SHAPES = {"ctx": (2 * SIDE, VOCABULARY, DIM), "hb": (DIM,), "cw": (DIM, CLASSES), "cb": (CLASSES,), "mw": (CLASSES, DIM, MEMBERS), "mb": (CLASSES, MEMBERS)}
PARAMETERS = sum(int(np.prod(s)) for s in _SHAPES.values())


#: An id from VOCABULARY on names a word of a cell: VOCABULARY + place in the list of known words * CELLS + cell.
CELLS = RARE + 1


def cells_of(ids: np.ndarray) -> np.ndarray:
    """The ids that the network knows."""
    return np.where(ids >= VOCABULARY, (ids - VOCABULARY) % CELLS, ids)


class Network:
    """Behind its parameters, ``flat`` may hold the log shares of words that share a cell."""

    def __init__(self, flat: np.ndarray):
        self.flat, self.p, at = flat[:PARAMETERS].astype(np.float32), {}, 0
        self.shares = flat[PARAMETERS:].astype(np.float32)
        for name, shape in _SHAPES.items():
            n = int(np.prod(shape))
            self.p[name] = self.flat[at : at + n].reshape(shape)
            at += n

    @classmethod
    def fresh(cls, seed: int = 9) -> Network:
        rng = np.random.default_rng(seed)
        net = cls(np.zeros(PARAMETERS, np.float32))
        for name in ("ctx", "cw", "mw"):
            net.p[name][:] = rng.normal(0, 0.1, _SHAPES[name])
        return net

    def hidden(self, around: np.ndarray) -> np.ndarray:
        h = self.p["hb"] + self.p["ctx"][0][around[0]]
        for k in range(1, 2 * SIDE):
            h += self.p["ctx"][k][around[k]]
        return np.tanh(h, out=h)

    def step(self, ids: np.ndarray, around: np.ndarray, rate: float | None = None) -> np.ndarray:
        """Log-probabilities of the ids; with a rate the network also learns from them."""
        p, n = self.p, len(ids)
        named = np.flatnonzero(ids >= VOCABULARY)
        share = self.shares[(ids[named] - VOCABULARY) // CELLS]
        ids, around = cells_of(ids), cells_of(around)
        h = self.hidden(around)
        cls = ids // MEMBERS
        order = np.argsort(cls.astype(np.uint8), kind="stable")
        bounds = np.searchsorted(cls[order], np.arange(CLASSES + 1))
        z = h @ p["cw"] + p["cb"]
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        total = e.sum(axis=1)
        rows = np.arange(n)
        log_p = z[rows, cls] - np.log(total)
        sorted_h, member = h[order], (ids % MEMBERS)[order]
        within = np.empty(n, np.float32)
        back = np.zeros_like(h) if rate else None
        for c in range(CLASSES):
            a, b = bounds[c], bounds[c + 1]
            if a == b:
                continue
            x, m = sorted_h[a:b], member[a:b]
            zc = x @ p["mw"][c] + p["mb"][c]
            zc -= zc.max(axis=1, keepdims=True)
            ec = np.exp(zc)
            sc = ec.sum(axis=1)
            k = np.arange(b - a)
            within[a:b] = zc[k, m] - np.log(sc)
            if rate:
                g = ec / sc[:, None]
                g[k, m] -= 1
                back[a:b] = g @ p["mw"][c].T
                p["mw"][c] -= rate / n * CLASSES * (x.T @ g)
                p["mb"][c] -= rate / n * CLASSES * g.sum(axis=0)
        log_p[order] += within
        log_p[named] += share
        if rate:
            g = e / total[:, None]
            g[rows, cls] -= 1
            d = np.empty_like(h)
            d[order] = back
            d += g @ p["cw"].T
            p["cw"] -= rate / n * (h.T @ g)
            p["cb"] -= rate / n * g.sum(axis=0)
            d *= 1 - h * h
            p["hb"] -= rate / n * d.sum(axis=0)
            for k in range(2 * SIDE):
                seq = np.argsort(around[k].astype(np.uint16), kind="stable")
                seen, first, count = np.unique(around[k][seq], return_index=True, return_counts=True)
                grad = np.add.reduceat(d[seq], first, axis=0)
                # Summed over a word's tokens, damped for the most frequent words.
                p["ctx"][k][seen] -= rate * grad / np.sqrt(count)[:, None] / 8
        return log_p


class Vocabulary:
    """Word hashes to ids: frequent words by one probe of a table without collisions, known words of cells by search.

    The first words of the list have ids of the network, the others share cells.
    """

    def __init__(self, words: np.ndarray):
        frequent, known = words[:FREQUENT].astype(np.uint64), words[FREQUENT:].astype(np.uint64)
        self.keys = np.concatenate([np.zeros(1, np.uint64), frequent])
        self.place = np.argsort(known)
        self.known = known[self.place]
        for seed in range(1, 10_000):
            self.mul = np.uint64(0x9E3779B97F4A7C15 * (2 * seed + 1) & (1 << 64) - 1)
            slot = (frequent * self.mul) >> np.uint64(44)
            if len(np.unique(slot)) == len(frequent):
                break
        self.table = np.zeros(1 << 20, np.int32)
        self.table[slot] = np.arange(1, len(frequent) + 1)

    def cells(self, hashes: np.ndarray) -> np.ndarray:
        at = self.table[(hashes * self.mul) >> np.uint64(44)]
        known = (at > 0) & (self.keys[at] == hashes)
        return np.where(known, at + RARE, 1 + (hashes % np.uint64(RARE)).astype(np.int64))

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """A word of a cell that is not in the list has the cell's id."""
        ids = self.cells(hashes)
        if len(self.known):
            rare = np.flatnonzero(ids <= RARE)
            at = np.minimum(np.searchsorted(self.known, hashes[rare]), len(self.known) - 1)
            found = self.known[at] == hashes[rare]
            rare, at = rare[found], at[found]
            ids[rare] += VOCABULARY + self.place[at] * CELLS
        return ids


def windows(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Ids at the 2 * SIDE places around each token; 0 beyond the edges of its text."""
    n = len(ids)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.zeros((2 * SIDE, n), np.int64)
    for k, shift in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        a, b = max(0, -shift), n - max(0, shift)
        if b > a:
            out[k, a:b] = np.where(row[a:b] == row[a + shift : b + shift], ids[a + shift : b + shift], 0)
    return out


def _batches(column: pa.Array, vocabulary: Vocabulary):
    """Rows a to b, the network's ids of their tokens, the ids around them, and where each row's tokens begin."""
    data, offsets = text_buffer(column)
    for a, b in chunks(offsets, 2 << 20):
        _, _, hashes, first = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        ids = vocabulary.cells(hashes)
        yield a, b, ids, windows(ids, first), first, hashes


def learn(net: Network, ids: np.ndarray, around: np.ndarray, rate: float) -> None:
    for a in range(0, len(ids), BATCH_TOKENS):
        net.step(ids[a : a + BATCH_TOKENS], around[:, a : a + BATCH_TOKENS], rate)


def score(net: Network, ids: np.ndarray, around: np.ndarray) -> np.ndarray:
    parts = [net.step(ids[a : a + BATCH_TOKENS], around[:, a : a + BATCH_TOKENS]) for a in range(0, len(ids), BATCH_TOKENS)]
    return np.concatenate([*parts, np.zeros(0, np.float32)])


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, n): how often each word of the column ``text`` occurs in the whole corpus, by hash of the word."""

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            hashes = [words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[2] for a, b in chunks(offsets)]
            h, n = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def cell_column(h: Column) -> Column:
    """The cell of a hash as in Vocabulary.cells: the rest of the unsigned number (2^64 leaves 16 when divided by 63)."""
    return F.pmod(F.pmod(h, F.lit(RARE)) + F.when(h < 0, (1 << 64) % RARE).otherwise(0), F.lit(RARE)) + 1


def word_shares(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """Of the table (h, n): hashes of the frequent and then of the known words, log shares of the known ones in their
    cells, and a frame (h, share) of all other words."""
    top = [r.h for r in counts.orderBy(F.col("n").desc(), "h").limit(FREQUENT).collect()]
    own = F.broadcast(counts.sparkSession.createDataFrame([(h,) for h in top], "h long"))
    rest = counts.join(own, "h", "left_anti").withColumn("cell", cell_column(F.col("h")))
    total = rest.groupBy("cell").agg(F.sum("n").alias("total"))
    shares = rest.join(F.broadcast(total), "cell").select("h", "n", F.log(F.col("n") / F.col("total")).alias("share"))
    # The floor is the least count over which the words are few enough.
    floor, words = None, 0
    # Each count has a word at least, so KNOWN_WORDS + 1 rows tell it, however many counts there are.
    for r in rest.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.col("n").desc()).limit(KNOWN_WORDS + 1).collect():
        words += r.words
        if words > KNOWN_WORDS:
            break
        floor = r.n
    is_known = F.lit(False) if floor is None else F.col("n") >= floor
    known = shares.where(is_known).select("h", "share").toArrow()
    hashes = np.concatenate([np.array(top, np.int64), known.column("h").to_numpy()]).view(np.uint64)
    return hashes, known.column("share").to_numpy().astype(np.float32), shares.where(~is_known).select("h", "share")


def train(docs: DataFrame, start_docs: int = START_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the frequent and the known words, parameters of the averaged network and log shares of the known words)
    of a frame (doc_id, text)."""
    return train_with_rest(docs, start_docs)[:2]


def train_with_rest(docs: DataFrame, start_docs: int = START_DOCS) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """As train(), and the frame (h, share) of the words that are not known."""
    spark = docs.sparkSession
    hashes, shares, rest = word_shares(stored(word_counts(docs), "word-counts"))
    frequent = hashes[:FREQUENT]
    words = spark.sparkContext.broadcast(frequent)

    def start(table):
        net, vocabulary = Network.fresh(), Vocabulary(words.value)
        parts = list(_batches(table.sort_by("k").column("text").combine_chunks(), vocabulary))
        for turn in range(3):
            for _, _, ids, around, *_ in parts:
                learn(net, ids, around, RATE / (1 + turn))
        return pa.table({"net": pa.array([net.flat.tobytes()], pa.binary())})

    # The sample is chosen by hashes alone, so tasks hand on numbers, not texts. It only gives the point from which every
    # partition goes on with all of its texts, the longest ones included.
    hashed = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= START_BYTES).withColumn("k", F.xxhash64("doc_id", "text", F.lit(4)))
    chosen = hashed.select("k").orderBy("k").limit(start_docs).distinct()
    sample = hashed.join(F.broadcast(chosen), "k").dropDuplicates(["k"]).select("k", "text").withColumn("g", F.lit(1))
    first = sample.groupBy("g").applyInArrow(start, "net binary").collect()
    begin = spark.sparkContext.broadcast(np.frombuffer(first[0].net, np.float32) if first else Network.fresh().flat)

    def run(batches):
        net, vocabulary, seen = Network(begin.value.copy()), Vocabulary(words.value), 0
        for batch in batches:
            for _, _, ids, around, *_ in _batches(batch.column(0), vocabulary):
                learn(net, ids, around, CORPUS_RATE)
                seen += len(ids)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([net.flat.tolist()], pa.list_(pa.float32()))], ["w", "v"])

    # One network for each partition; the mean of every parameter is a grouped sum, no task sees all networks.
    nets = docs.select("text").mapInArrow(run, "w double, v array<float>").select("w", F.posexplode("v").alias("i", "x"))
    mean = nets.groupBy("i").agg((F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("x")).collect()
    flat = begin.value.copy()
    for r in mean:
        flat[r.i] = r.x
    return hashes, np.concatenate([flat[:PARAMETERS], shares]), rest


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", start_docs: int = START_DOCS) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob): the pseudo-likelihood of every whole text.

    Null, empty and blank texts have no token: log_prob 0, mean null. Every row gets a result, also rows that repeat
    an id or have none; equal texts have equal scores. Very long texts are learnt from and scored whole. An empty table
    gives an empty result. Other columns are not read and may have any name.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    *parts, rest = train_with_rest(rows, start_docs)
    model = spark.sparkContext.broadcast(tuple(parts))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        vocabulary, net = Vocabulary(model.value[0]), Network(model.value[1])
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b, _, around, first, hashes in _batches(batch.column(1), vocabulary):
                ids = vocabulary.ids(hashes)
                total = np.concatenate([[0], np.cumsum(score(net, ids, around), dtype=np.float64)])
                other = np.flatnonzero((ids > 0) & (ids <= RARE))
                lists = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(other, first)), pa.array(hashes[other].view(np.int64)))
                n, s = np.diff(first), total[first[1:]] - total[first[:-1]]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + b - a)), batch.column(0).slice(a, b - a), pa.array(n.astype(np.int64)), pa.array(s), lists.cast(pa.list_(pa.int64()))], ["row", "doc_id", "n_tokens", "log_prob", "other"])
                row += b - a

    scored = rows.mapInArrow(run, f"row long, doc_id {kind}, n_tokens long, log_prob double, other array<long>")
    if not rest.isEmpty():
        # Numbers of rows hold only for one run of the scoring, so its result is written before they are used.
        scored = stored(scored, "scores")
        shares = scored.select("row", F.explode("other").alias("h")).join(rest, "h").groupBy("row").agg(F.sum("share").alias("share"))
        scored = scored.join(shares, "row", "left").withColumn("log_prob", F.col("log_prob") + F.coalesce("share", F.lit(0.0)))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
    return scored.select("doc_id", "n_tokens", "log_prob", mean.alias("mean_log_prob"))
