"""Operators of the llm subpackage against brute force, round trips and held-out accuracy, with odd inputs."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


class Largest(AccumulatorParam):
    def zero(self, value):
        return [0]

    def addInPlace(self, a, b):
        return [max(a[0], b[0])]


def odd(spark, extra: str = ""):
    """Nulls, empty and blank texts, repeated rows, a long text, and columns with names that operators use inside."""
    long = " ".join(f"w{k % 977}x{k}" for k in range(20_000))
    rows = [(1, None, None, None, None, 5), (2, "", "en", "s", 0, 1), (3, " \n\t", "en", "s", 3, 1), (4, "one two", "en", "s", 7, 1), (4, "one two", "en", "s", 7, 1), (5, long, "en", "s", 9, 2), (6, long, "de", "t", 9, 2), (None, "no id here at all", "en", "s", 1, 1), (7, "é 漢字 \U0001f600 naïve text here now", "fr", "s", 1, 0)]
    return spark.createDataFrame(rows, DOCS + ", rep long")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


# ---------------------------------------------------------------- near duplicates


def shingles(text: str | None) -> set:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_groups(rows):
    sets, parent = {d: shingles(t) for d, t in rows}, {}
    parent.update({d: d for d in sets})

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    from gleanery.llm import near_dups as N

    rng = random.Random(4)
    base = [[f"a{rng.randrange(400)}" for _ in range(60)] for _ in range(3)]
    rows = []
    for d in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = f"b{rng.randrange(10_000)}"
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block, hubs in ((2048, 3), (8, 0)):  # the second: everything through small blocks
        monkeypatch.setattr(N, "BLOCK_ROWS", block)
        monkeypatch.setattr(N, "HUB_ROUNDS", hubs)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(df).collect()}
        assert got == brute_groups(rows)


def test_one_id_on_two_texts_keeps_all_links(spark):
    from gleanery.llm.near_dups import near_duplicates

    text = lambda k, n=60: " ".join(f"{k}w{j}" for j in range(n))
    rows = [(1, text("a")), (1, text("z")), (2, text("z") + " more"), (9, text("p")), (9, text("q")), (4, text("p") + " x"), (3, text("q") + " y"), (7, text("r")), (7, text("r")), (8, text("r") + " v")]
    for part in (1, 4):
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(part)).collect())
        assert got == [(1, 56, 1), (1, 56, 1), (2, 57, 1), (3, 57, 3), (4, 57, 3), (7, 56, 7), (7, 56, 7), (8, 57, 7), (9, 56, 3), (9, 56, 3)]


#: Names that operators use inside.
NAMES = "row score gone bad found th n rep component_id shard words item seed pos covered k g a b h __score __id __found __bad __gone __doc __text"


def clashing(spark, rows):
    """Rows (id, text) with further columns of such names."""
    names = NAMES.split()
    return spark.createDataFrame([(d, t, *range(len(names))) for d, t in rows], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))


def test_clashing_columns_stay_as_they_are(spark):
    from gleanery.llm.decontaminate import drop_leaks, leaks
    from gleanery.llm.licenses import scan_licenses
    from gleanery.llm.near_dups import drop_near_duplicates
    from gleanery.llm.packing import pack_documents
    from gleanery.llm.pii import redact
    from gleanery.llm.pseudo_lm import lm_scores
    from gleanery.llm.quality import keep_quality
    from gleanery.llm.repeats import removal_digest

    text = " ".join(f"w{k}" for k in range(40))
    docs = clashing(spark, [(1, text), (2, text + " more"), (3, None), (None, "mail to a@b.cd now"), (5, "mail to a@b.cd now"), (6, "q " + text[40:80] + " r " * 30)])
    bench = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(10, 22)))], "item_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 7)], "doc_id long, quality int")
    for out in (drop_near_duplicates(docs), drop_leaks(docs, bench), redact(docs), keep_quality(docs, labels)):
        assert out.columns == docs.columns and out.select(docs.columns[2:]).distinct().count() <= 1
        assert out.select("doc_id", *docs.columns[2:]).exceptAll(docs.select("doc_id", *docs.columns[2:])).count() == 0
    assert drop_near_duplicates(docs).count() == 5 and {r.doc_id for r in leaks(docs, bench).collect()} == {1, 2} and redact(docs).where("text = 'mail to [EMAIL] now'").count() == 2
    for out, n in ((scan_licenses(docs), 5), (pack_documents(docs), 6), (lm_scores(docs), 6), (removal_digest(docs), 6)):
        assert out.count() == n


def test_near_duplicates_odd_rows(spark):
    from gleanery.llm.near_dups import drop_near_duplicates, near_duplicates

    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(odd(spark)).collect())
    assert got == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (5, 19996, 5, True), (6, 19996, 5, False), (7, 3, 7, True)]
    kept = drop_near_duplicates(odd(spark))
    assert kept.columns == odd(spark).columns and kept.count() == 8
    assert near_duplicates(odd(spark).limit(0)).count() == 0


def test_sketches_merge_and_estimate():
    from gleanery.llm.near_dups import estimate, merge, sketch

    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = x[:2000], x[1000:]
    assert (merge(sketch(a), sketch(b)) == sketch(x)).all()
    ra, rb = sketch(a), sketch(b)
    est = estimate(np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([2000.0]), np.array([2000.0]))
    assert abs(est[0] - 1 / 3) < 0.15


def test_components_of_a_chain(spark):
    from gleanery.llm.common import connected_components

    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


# ---------------------------------------------------------------- repeats


def brute_repeats(rows, span):
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(r[i : i + span] for _, r in raw for i in range(len(r) - span + 1))
    out = []
    for d, r in raw:
        mark = bytearray(len(r))
        for i in range(len(r) - span + 1):
            if seen[r[i : i + span]] > 1:
                mark[i : i + span] = b"\1" * span
        kept = bytes(b for b, m in zip(r, mark, strict=True) if not m)
        runs = sum(1 for k in range(len(mark)) if mark[k] and (k == 0 or not mark[k - 1]))
        out.append((d, len(r), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_repeats_match_brute_force(spark):
    from gleanery.llm.repeats import removal_digest

    rng = random.Random(3)
    base = ["".join(rng.choice("ab c") for _ in range(120)) for _ in range(6)]
    rows = []
    for d in range(60):
        t = ""
        for _ in range(rng.randint(0, 6)):
            x, a = rng.choice(base), rng.randint(0, 100)
            t += x[a : a + rng.randint(5, 90)] + rng.choice(["", "x", "\0\0", "é" * rng.randint(0, 30), "ab" * rng.randint(0, 40)])
        rows.append((d if d % 19 else None, t if d % 17 else None))
    rows += [(3, rows[3][1]), (5, "zz" * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for hot in (20_000, 2, 1):  # the others: anchors split down to single offsets
        got = sorted((tuple(r) for r in removal_digest(df, span=48, gram=16, hot=hot, shard_rows=7).collect()), key=str)
        assert got == brute_repeats(rows, 48)


def test_hot_passages_are_split_to_a_bound(spark, monkeypatch):
    """A passage that hundreds of documents share, shorter and longer than a window: no task sees more contexts than the bound."""
    from gleanery.llm import repeats as R

    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    short, long = noise(396), noise(450)
    rows = [(d, noise(rng.randint(300, 900)) + (short if d % 2 else long) + noise(rng.randint(300, 900))) for d in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = spark.sparkContext.accumulator([0], Largest())
    inner = R.repeated_reach

    def counted(left, right, times, lo, hi, span, shard_rows):
        for o in range(int(lo.min()), int(hi.max()) + 1, 7):  # contexts with one window at this offset
            same = collections.Counter((a[:o], b[: span - o]) for a, b, c, d in zip(left, right, lo, hi, strict=True) if c <= o <= d)
            seen.add([max(same.values(), default=0)])
        return inner(left, right, times, lo, hi, span, shard_rows)

    monkeypatch.setattr(R, "repeated_reach", counted)
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in R.removal_digest(df, hot=20).collect()}
    want = {r[0]: (r[2], r[3]) for r in brute_repeats(rows, 400)}
    assert got == want and sum(n for n, _ in got.values()) >= 150 * 450 and 0 < seen.value[0] <= 20


def test_merge_of_transforms_is_the_sorted_order():
    from gleanery.llm.repeats import merge, merged_order, symbols_of, transform

    rng = random.Random(1)
    for most, wide in ((20, 20), (200, 3), (3, 400)):
        s = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, wide))) + b"c" * rng.randint(0, 200) for _ in range(most)]
        s += [rng.choice(s)[: rng.randint(0, 500)] for _ in range(most)]
        for shard in (1000, 30, 1):
            order, lcp = merged_order(s, shard)
            assert [s[k] for k in order] == sorted(s) and lcp[0] == -1
            for k in range(1, len(s)):
                x, y = s[order[k - 1]], s[order[k]]
                assert lcp[k] == next((i for i in range(min(len(x), len(y))) if x[i] != y[i]), min(len(x), len(y)))
    # A transform tells the text: the symbols of a shard are those of its strings.
    symbols, _, _ = symbols_of(s)
    shards = [transform(symbols[a : a + 3]) for a in range(0, len(s), 3)]
    assert sorted(np.concatenate([t for t, _ in shards]).tolist()) == sorted([*symbols[symbols > 0].tolist(), *[0] * len(s)])
    # The merge reads the shards in their order: with the places of one shard out of order it goes wrong.
    right = [s[k] for k in merge(shards, symbols.shape[1])[0]]
    text, whole = shards[0]
    shards[0] = text[::-1].copy(), whole[::-1].copy()
    assert right == sorted(s) and [s[k] for k in merge(shards, symbols.shape[1])[0]] != right


def test_anchor_of_each_window():
    from gleanery.llm.repeats import _gram_hashes, anchors

    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (0, 47, 48, 49, 300, 1000)] + [b"a" * 500, b"ab" * 300]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = {(r, p - o): p for r, p, lo, hi, _ in zip(*(x.tolist() for x in anchors(data, offsets, 48, 16)), strict=True) for o in range(lo, hi + 1)}
    want = {}
    for r, t in enumerate(texts):
        for a in range(len(t) - 47):
            h = _gram_hashes(np.frombuffer(t[a : a + 48], np.uint8), 16)
            want[(r, a)] = a + int(h.argmin())
    assert found == want


def test_repeats_odd_rows(spark):
    from gleanery.llm.repeats import removal_digest

    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    got = sorted((tuple(r) for r in removal_digest(odd(spark)).collect()), key=str)
    by = {(r[0], r[1]): r for r in got}
    assert len(got) == len(rows) and by[(5, len(rows[5][1]))][2] == len(rows[5][1]) and by[(2, 0)][4] == hashlib.sha256(b"").hexdigest()
    assert removal_digest(odd(spark).limit(0)).count() == 0


# ---------------------------------------------------------------- leaks


def test_leaks_find_passages_with_substitutions(spark):
    from gleanery.llm import decontaminate as X

    rng = random.Random(8)
    items = [(k, " ".join(f"t{rng.randrange(10_000)}" for _ in range(n))) for k, n in enumerate([14, 20, 40, 59, 9])]
    rows, want = [], set()
    for d in range(60):
        filler = lambda n: [f"f{rng.randrange(10_000)}" for _ in range(n)]
        w = filler(30)
        if d % 3 == 0:
            k = (d // 3) % 4
            x = items[k][1].split()
            for p in range(3, len(x), 7):  # one token of seven replaced
                x[p] = "other"
            w = w + x + filler(10)
            want.add((d, k))
        elif d % 3 == 1:
            w += items[2][1].split()[:8]  # a phrase only
        rows.append((d, ", ".join(w).upper()))
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in X.leaks(docs, bench).collect()} == want
    X.BROADCAST_TOKENS, keep = 0, X.BROADCAST_TOKENS
    try:
        assert {(r.doc_id, r.item_id) for r in X.leaks(docs, bench).collect()} == want
    finally:
        X.BROADCAST_TOKENS = keep
    assert X.drop_leaks(docs, bench).count() == 60 - len({d for d, _ in want})
    assert X.leaks(odd(spark), bench).count() == 0 and X.leaks(docs, bench.limit(0)).count() == 0 and X.drop_leaks(odd(spark), bench).count() == 9


def test_leaks_with_null_items_repeated_rows_and_ties(spark):
    from gleanery.llm.decontaminate import drop_leaks, leaks

    passage = " ".join(f"p{k}" for k in range(12))
    bench = spark.createDataFrame([(1, passage), (1, passage), (2, passage), (3, None), (4, ""), (None, passage), (5, " .,; ")], "item_id long, text string")
    rows = [(1, f"a b {passage} c {passage}"), (1, f"a b {passage} c {passage}"), (2, passage.upper()), (3, None), (4, "p0 p1 p2"), (None, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in leaks(df, bench).collect()) == [(1, 1, 12, 12), (1, 2, 12, 12), (2, 1, 12, 12), (2, 2, 12, 12)]
    assert sorted((r.doc_id for r in drop_leaks(df, bench).collect()), key=str) == [3, 4, None]


def test_leaks_in_very_long_texts(spark, monkeypatch):
    """A text of 600,000 tokens in the memory of a small task; windows over the edge of a block; blocks make no difference."""
    from gleanery.llm import decontaminate as X

    rng = random.Random(3)
    item = [f"q{k}" for k in range(26)]
    near = [w if k % 6 else "other" for k, w in enumerate(item)]
    long = [f"f{rng.randrange(50_000)}" for _ in range(600_000)]
    edge = X.BLOCK_TOKENS * 100
    long[edge - 13 : edge + 13] = near
    rows = [(1, " ".join(long)), (2, " ".join(long[: edge - 4]))]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "q0 q1")], "item_id long, text string")
    assert [tuple(r)[:2] for r in X.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()] == [(1, 7)]
    # The item at every offset around the edges of short blocks, and no passage where only a part of it stands.
    rows = [(k, " ".join(["x"] * k + near + ["y"] * 30)) for k in range(70)] + [(100 + k, " ".join(["x"] * k + near[:13] + ["y"] * 30)) for k in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, X.leaks(docs, bench).collect()))
    for most in (X.BROADCAST_TOKENS, 0):
        monkeypatch.setattr(X, "BROADCAST_TOKENS", most)
        monkeypatch.setattr(X, "BLOCK_TOKENS", 23)
        assert sorted(map(tuple, X.leaks(docs, bench).collect())) == whole and {d for d, *_ in whole} == set(range(70))


def test_a_mask_fits_every_allowed_pattern():
    import itertools
    import math

    from gleanery.llm import decontaminate as X

    for n in range(X.SPAN, X.WINDOW + 1):
        laid = [sum(1 << (a + j) for j, bit in enumerate(m) if bit == "1") for m in X.MASKS for a in range(n - len(m) + 1)]
        for other in itertools.combinations(range(n), n - math.ceil(n * X.MATCH)):
            gone = sum(1 << k for k in other)
            assert any(not m & gone for m in laid), (n, other)


def test_leaks_with_each_fifth_token_replaced_and_of_short_items(spark, monkeypatch):
    from gleanery.llm import decontaminate as X

    items = [(n, " ".join(f"i{n}t{k}" for k in range(n))) for n in (1, 3, 9, 10, 15, 20, 45)]
    rows, want = [], set()
    for n, text in items:
        for start in range(5):
            w = text.split()
            if n >= X.SPAN:
                w[start::5] = ["other"] * len(w[start::5])
            rows.append((len(rows), " ".join(["x"] * start + w + ["y"] * (4 - start))))
            want.add((len(rows) - 1, n))
    rows += [(900, "i3t0 i3t1 x i3t2"), (901, " ".join(f"i9t{k}" for k in range(8))), (902, "i3t0 i3t1")]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for most in (X.BROADCAST_TOKENS, 0):
        monkeypatch.setattr(X, "BROADCAST_TOKENS", most)
        assert {(r.doc_id, r.item_id) for r in X.leaks(docs, bench).collect()} == want


# ---------------------------------------------------------------- personal data


def test_base_spans_are_those_of_the_patterns():
    from gleanery.llm.pii import KINDS, _luhn, base_spans

    e, i = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    c, p = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def brute(t):
        f = [(m.start(), 0, m.end()) for m in e.finditer(t)]
        f += [(m.start(), 1, m.end()) for m in i.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
        for m in c.finditer(t):
            d = re.sub("[^0-9]", "", m.group())
            if 14 <= len(d) <= 19 and _luhn(d):
                f.append((m.start(), 2, m.end()))
        f += [(m.start(), 3, m.end()) for m in p.finditer(t) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
        return [(a, b, KINDS[k]) for a, k, b in sorted(f)]

    rng = random.Random(2)
    for _ in range(20_000):
        t = "".join(rng.choice("ab@@..-1123+ ()é_%0000") for _ in range(rng.randint(0, 40)))
        assert brute(t) == base_spans(t)
    assert base_spans("x" * 200_000 + "1" * 100_000) == []


def test_digest_against_plain_patterns(spark):
    """Every document of the table: base kinds by the patterns as the contract has them, and the secrets that were put in."""
    from gleanery.llm.pii import KINDS, _luhn, pii_digest

    digits = lambda x: re.sub("[^0-9]", "", x)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda x: 14 <= len(digits(x)) <= 19 and _luhn(digits(x))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 10 <= len(digits(x)) <= 15),
    }
    secrets = r"(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}|AKIA[0-9A-Z]{16}"
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got, total = {r.doc_id: r for r in pii_digest(docs).collect()}, 0
    for d, t in docs.collect():
        spans = [(m.start(), n, m.end(), k) for n, k in enumerate(KINDS) for m in re.finditer(kinds[k][0], t or "") if kinds[k][1](m.group())]
        found = [(m.start(), 4, m.end(), "found") for m in re.finditer(secrets, t or "") if not any(a < m.end() and m.start() < b for a, _, b, _ in spans)]
        total += len(found)
        line = lambda x: ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(x))
        r = got[d]
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[3] == k for s in spans) for k in KINDS]
        assert r.base_sha256 == hashlib.sha256(line(spans).encode()).hexdigest()
        assert r.spans == line(spans + found) and (r.n_found, r.n_spans) == (len(found), len(spans) + len(found)), d
    assert len(got) == docs.count() and total > 10


def test_one_id_on_two_texts_is_redacted_row_by_row(spark):
    from gleanery.llm.pii import redact

    seeds = [(k, f"please write to account holder user{k}@mail.example.com today and thanks") for k in range(12)]
    rows = [(100, "please write to account holder KX-99817-22 today and thanks"), (100, "nothing was ever written here in number 1234567 of them"), (None, "please write to account holder KX-99817-23 today and thanks")]
    out = {r.text for r in redact(spark.createDataFrame(seeds + rows, "doc_id long, text string")).where("doc_id is null or doc_id = 100").collect()}
    assert out == {"please write to account holder [FOUND] today and thanks", rows[1][1]}


def test_contexts_find_unseen_identifiers(spark):
    from gleanery.llm.pii import find_pii, redact

    seeds = [(k, f"please write to account holder user{k}@mail.example.com today and thanks") for k in range(12)]
    unseen = [(100, "please write to account holder KX-99817-22 today and thanks"), (101, "the version build-20240102 is out")]
    df = spark.createDataFrame(seeds + unseen, "doc_id long, text string")
    got = {r.doc_id: [unseen[r.doc_id - 100][1][x.start : x.end] for x in r.found] for r in find_pii(df).collect() if r.doc_id >= 100}
    assert got == {100: ["KX-99817-22"], 101: []}
    text = {r.doc_id: r.text for r in redact(df).collect()}
    assert text[3] == "please write to account holder [EMAIL] today and thanks" and "[FOUND]" in text[100] and text[101] == unseen[1][1]
    assert redact(odd(spark)).columns == odd(spark).columns and redact(odd(spark)).count() == 9 and find_pii(odd(spark).limit(0)).count() == 0


def test_dates_numbers_and_cells_are_left_alone(spark):
    """Contexts that hold personal data and ordinary values alike give nothing away; unseen identifiers are still found."""
    from gleanery.llm.pii import find_pii, is_plain, redact

    assert all(map(is_plain, ("2024-05-10", "12/11/2024", "12345678", "1,234,567.89", "$1200.50", "10:45:00", "2024-05-10T10:45:00Z", "v1.20.300", "1990-2004", "99.95%", "3000km")))
    assert not any(map(is_plain, ("KX-99817-22", "a8f5f167f44f4964e6c998dee827110c", "AB123456C", "user20240102")))
    seeds = [(k, f"| mail | user{k}@mail.example.com | open | 4{k:03} |\nreach me at customer account user{k}@x{k}.example.org for details") for k in range(40)]
    cells = [(1000 + k, f"| item{k} | 2024-05-{10 + k} | sold | 1234567{k} |\nsum = \"20240511{k}\" | 1.234.567{k} |\norder 2024-06-1{k} was paid") for k in range(10)]
    mixed = [(2000 + k, f"the meeting with mister {f'u{k}@a.example.com' if k % 3 else f'2024-06-{k + 10}'} was moved") for k in range(18)]
    unseen = [(3000 + k, f"reach me at customer account QX{k}-77-{k}{k}81 for details") for k in range(8)] + [(3100, "reach me at customer account 2024-05-10 for details")]
    df = spark.createDataFrame([*seeds, *cells, *mixed, *unseen], "doc_id long, text string")
    text = dict([*seeds, *cells, *mixed, *unseen])
    got = {r.doc_id: [text[r.doc_id][x.start : x.end] for x in r.found] for r in find_pii(df).collect() if r.found}
    assert got == {3000 + k: [f"QX{k}-77-{k}{k}81"] for k in range(8)}
    after = {r.doc_id: r.text for r in redact(df).collect()}
    assert all(after[d] == t for d, t in cells) and after[3100] == text[3100]


# ---------------------------------------------------------------- quality


def test_classifier_on_held_out_rows(spark):
    from gleanery.llm.quality import keep_quality, quality_report, quality_scores

    sf = "/root/testdata/sf0.01"
    d, y = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    x = quality_report(d, y).join(y, "doc_id").toPandas()
    for r in x.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    h = x[x.held_out]
    assert len(h) > 50 and (h.predicted == h.quality).mean() > 0.9
    assert quality_scores(odd(spark), y.limit(0)).where("score = 1").count() == 9
    scored = quality_scores(odd(spark).withColumnRenamed("rep", "score"), spark.createDataFrame([(1, 1, 0), (7, 0, 0)], "doc_id long, quality int, toxic int"))
    assert scored.count() == 9 and scored.where("score is null").count() == 0
    assert keep_quality(odd(spark).limit(0), y).count() == 0


# ---------------------------------------------------------------- packing


def test_packing_keeps_all_tokens(spark):
    from gleanery.llm.packing import SIZES, pack, pack_documents

    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(0, 60))
        lengths = np.maximum(1, rng.lognormal(5.5, 1.3, n)).astype(np.int64)
        text, _, bins, start, length, final = pack(lengths)
        total, fill = np.zeros(n, np.int64), np.zeros(len(final), np.int64)
        np.add.at(total, text, length)
        np.add.at(fill, bins, length)
        assert (total == lengths).all() and (fill <= final).all()
        for k in range(len(final)):
            assert final[k] == min(s for s in SIZES if s >= fill[k])
            at = np.sort(start[bins == k])
            assert at[0] == 0 and (np.sort(start[bins == k] + length[bins == k])[:-1] == at[1:]).all()
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    ids = collections.Counter()
    for r in odd(spark).collect():
        ids[r.doc_id] += 1 + len(tk.encode(r.text or "", add_special_tokens=False).ids)
    by_ids = pack_documents(odd(spark), path).toPandas()
    assert {None if d != d else int(d): n for d, n in by_ids.groupby("doc_id", dropna=False).length.sum().items()} == ids
    got = pack_documents(odd(spark), block_docs=3).toPandas()
    assert got.groupby("doc_id", dropna=False).length.sum().to_dict()[5] == 20_001 and len(got[got.doc_id == 4]) == 2 and got.bin_id.nunique() >= 3
    assert (got.groupby("bin_id").length.sum() <= got.groupby("bin_id").bin_size.first()).all() and pack_documents(odd(spark).limit(0)).count() == 0


def test_packing_equals_a_plain_search():
    """The same rule over a list of all open bins, looked through for each piece."""
    from gleanery.llm.packing import OVERHEAD, pack

    rng = np.random.default_rng(11)
    for sizes in ((8, 16, 64), (10,), (5, 7, 11, 100)):
        for _ in range(40):
            lengths = rng.integers(1, 2 * max(sizes), int(rng.integers(0, 50)))
            top, want, bins = max(sizes), {}, []
            held, room = dict.fromkeys(sizes, 1.0), dict.fromkeys(sizes, 1.0)
            for t, n in enumerate(lengths.tolist()):
                for p in range(n // top):
                    want[(t, p)] = (top, 0, top)
            for t in sorted(range(len(lengths)), key=lambda t: (-(lengths[t] % top), t)):
                n = int(lengths[t] % top)
                if not n:
                    continue
                fit = [(b["size"] - b["fill"], -b["used"], k) for k, b in enumerate(bins) if b["size"] - b["fill"] >= n]
                if fit:
                    k = min(fit)[2]  # least free space; of equal ones the bin that was used last
                else:
                    size = min((s for s in sizes if s >= n), key=lambda s: ((s + OVERHEAD) / max(n, s * held[s] / room[s]), s))
                    room[size] += size
                    bins.append({"size": size, "fill": 0, "used": 0, "in": []})
                    k = len(bins) - 1
                b = bins[k]
                b["in"].append((t, int(lengths[t] // top), b["fill"], n))
                b["fill"] += n
                held[b["size"]] += n
                b["used"] = sum(len(x["in"]) for x in bins)
            for b in bins:
                final = min(s for s in sizes if s >= b["fill"])
                want |= {(t, p): (final, start, n) for t, p, start, n in b["in"]}
            text, piece, which, start, length, final = pack(lengths, sizes)
            got = {(t, p): (int(final[b]), s, n) for t, p, b, s, n in zip(text.tolist(), piece.tolist(), which.tolist(), start.tolist(), length.tolist(), strict=True)}
            assert got == want and len(final) == len(bins) + sum(n // top for n in lengths.tolist())


def test_best_fit_beats_one_size():
    from gleanery.llm.packing import OVERHEAD, SIZES, pack

    rng = np.random.default_rng(5)
    lengths = np.maximum(1, rng.lognormal(5, 1, 3000)).astype(np.int64)
    cost = lambda f: (f + OVERHEAD).sum()
    assert cost(pack(lengths)[-1]) <= 1.02 * min(cost(pack(lengths, (s,))[-1]) for s in SIZES if s >= lengths.max() or s == SIZES[-1])


# ---------------------------------------------------------------- tokens


def test_token_files_round_trip(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    from gleanery.llm.common import scratch_path
    from gleanery.llm.token_files import document_starts, read_token_files, token_digests, write_token_files

    path = public_tokenizers.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    start, want = 0, []
    for r in sorted(docs.select("doc_id", "text").collect(), key=lambda r: r.doc_id):
        ids = [*tk.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in token_digests(docs, path).collect()) == want
    for encoding in ("delta", "dictionary"):
        out = scratch_path(spark, "t")
        write_token_files(odd(spark), out, path, encoding=encoding, page_rows=2)
        assert read_token_files(spark, out).where("doc_id = 1").first().ids == [2]
        assert [r.start for r in document_starts(spark, out).orderBy("start").collect()][:3] == [0, 1, 2]
    assert token_digests(odd(spark).limit(0), path).count() == 0


def test_token_file_footers(spark):
    """Encodings, row groups and page indexes as they stand in the files."""
    import glob

    import public_tokenizers
    import pyarrow.parquet as pq

    from gleanery.llm.common import scratch_path
    from gleanery.llm.token_files import read_token_files, shard_number, write_token_files

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for encoding, want, other in (("delta", "DELTA_BINARY_PACKED", "RLE_DICTIONARY"), ("dictionary", "RLE_DICTIONARY", "DELTA_BINARY_PACKED")):
        out = scratch_path(spark, "footers")
        write_token_files(docs, out, path, shards=2, row_group_bytes=200_000, page_rows=64, encoding=encoding)
        files = sorted(glob.glob(out.removeprefix("file://") + "/part-*.parquet"))
        assert len(files) == 2
        last = None
        for f in files:
            meta = pq.ParquetFile(f).metadata
            assert meta.num_row_groups > 1
            for g in range(meta.num_row_groups):
                cols = {meta.row_group(g).column(k).path_in_schema.split(".")[0]: meta.row_group(g).column(k) for k in range(meta.num_columns)}
                assert want in cols["ids"].encodings and other not in cols["ids"].encodings and cols["ids"].compression == "ZSTD"
                assert all(cols[c].has_offset_index and cols[c].has_column_index for c in ("doc_id", "n_tokens"))
                low, high = cols["doc_id"].statistics.min, cols["doc_id"].statistics.max
                assert last is None or low >= last
                last = high
        some = read_token_files(spark, out, ("doc_id", "n_tokens")).where("doc_id = 77")
        plan = some._jdf.queryExecution().toString()
        assert "EqualTo(doc_id,77)" in plan and "ids" not in plan.split("ReadSchema")[-1] and some.count() == 1
    assert [shard_number(*x) for x in ((0, 32 << 20, 8), (5 << 20, 32 << 20, 8), (1 << 30, 32 << 20, 8))] == [1, 5, 32]


def test_encoder_equals_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    from gleanery.llm.token_files import Encoder

    rng = random.Random(1)
    signs = ["a", "B", " ", "\n", "é", "É", "'s", "1", "23", "́", "\xa0", "\x1c", "İ", "ß", "Σ", "<|endoftext|>", "don't", ".", ",", "!", "漢", "ª", "µ", "Ω", "\x85", "\t", "ǅ", "\U0001f642", "\x00", "***", "(", "-", "<|", "|>", "endoftext", "ÿ", "µ"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        enc, tk = Encoder(path), Tokenizer.from_file(path)
        for _ in range(1500):
            x = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(2)]
            ids, at = enc.encode(x, 2)
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [[*tk.encode(t, add_special_tokens=False).ids, 2] for t in x]


# ---------------------------------------------------------------- vectors


def test_search_is_exact_at_factor_one(spark, monkeypatch):
    from pyspark.sql import functions as F

    from gleanery.llm import vp_search as V
    from gleanery.llm.vp_search import nearest

    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[200:500] = x[7]  # a third of all vectors are equal
    rows = [(k, [float(v) for v in x[k]]) for k in range(900)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (None, [1.0] * 16), (950, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    u = x.astype(float)
    norm = np.linalg.norm(u, axis=1)
    for factor, least, most in ((1.0, 1.0, 16 << 20), (1.0, 1.0, 0), (0.7, 0.9, 16 << 20)):
        monkeypatch.setattr(V, "BLOCK_BYTES", most or 500)  # 0: queries are asked in several rounds
        got = nearest(df, F.col("vec_id") % 50 == 0, shard_vectors=200, factor=factor).toPandas()
        assert set(got.query_id) == set(range(0, 900, 50))
        hit = 0
        for q in range(0, 900, 50):
            s = u @ u[q] / norm / norm[q]
            s[q] = -9
            want = np.lexsort((np.arange(900), -np.round(s, 12)))[:5]
            g = got[got.query_id == q].sort_values("rank")
            hit += len(set(want) & set(g.vec_id))
            if factor == 1.0:
                assert list(g.vec_id) == list(want) and np.allclose(g.score, s[want])
        assert hit / 90 >= least
    assert nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# ---------------------------------------------------------------- licences


def test_a_query_on_two_vectors_is_its_least(spark):
    from gleanery.llm.vp_search import nearest

    rows = [(50, [1.0, 0.0], 7), (50, [0.0, 1.0], 7), (1, [1.0, 0.1], 7), (2, [0.1, 1.0], 7)]
    for order in (rows, rows[::-1]):
        v = spark.createDataFrame(order, "vec_id long, embedding array<double>, dim long").selectExpr("*", "1 as shard", "2 as block")
        got = nearest(v, F.col("vec_id") % 50 == 0, 1).collect()
        assert [(r.query_id, r.vec_id) for r in got] == [(50, 2)]


def test_licence_rules(spark):
    from gleanery.llm.licenses import scan_licenses

    mit = open_text = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'
    rows = [(1, f"# Copyright (c) 2020 A. B.\n\n{mit}"), (2, "Some words.\nLicensed under the Apache License, Version 2.0.\nMore."), (3, "// SPDX-License-Identifier: BSD-3-Clause\nx"), (4, "A licence to bore."), (5, "This work is licensed under the GNU General Public License, version 3.\nAll rights reserved."), (6, open_text.upper())]
    got = {r.doc_id: ([x.licence for x in r.licences], r.n_unknown) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (["MIT"], 0), 2: (["Apache-2.0"], 0), 3: (["BSD-3-Clause"], 0), 4: ([], 1), 5: (["GPL-3", "All-Rights-Reserved"], 0), 6: (["MIT"], 0)}
    assert scan_licenses(odd(spark)).count() == 8 and scan_licenses(odd(spark).limit(0)).count() == 0


def test_licences_in_wrapped_comments(spark):
    import textwrap

    from gleanery.llm.licenses import scan_licenses

    mit = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'
    apache = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    gpl = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n3. Neither the name of the Example Project nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    zlib = "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"
    rows, want, k = [], {}, 0
    for text, name in ((mit, "MIT"), (apache, "Apache-2.0"), (gpl, "GPL-3-or-later"), (bsd, "BSD-3-Clause"), (zlib, "Zlib")):
        for lead, first, last in (("", "", ""), (" * ", "/*\n", "\n */"), ("# ", "", ""), ("// ", "", ""), ("", "<!--\n", "\n-->")):
            for width in (60, 76, 10_000):
                lines = [x for p in text.split("\n") for x in (textwrap.wrap(p, width) or [""])]
                rows.append((k, "Some title\n\n" + first + "\n".join((lead + x).rstrip() for x in lines) + last + "\n\nint main() {}"))
                want[k] = name
                k += 1
    got = {r.doc_id: r.licences for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: [x.licence for x in v] for d, v in got.items()} == {d: [n] for d, n in want.items()}
    text = dict(rows)
    for d, v in got.items():
        part = text[d][v[0].start : v[0].end]
        assert part[:9].lower() in ("permissio", "licensed ", "this prog", "redistrib", "this soft") and part[-1] in ".:"


def test_licence_names_in_documents(spark):
    from gleanery.llm.licenses import licence_digest

    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text for r in d.select("doc_id", "text").collect()}
    for r in licence_digest(d).collect():
        for line, name in (("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Released under the MIT License.", "MIT"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0")):
            assert (line in text[r.doc_id]) == (name in r.licences)


# ---------------------------------------------------------------- language model


def test_probabilities_sum_to_one_and_learn():
    from gleanery.llm.pseudo_lm import VOCABULARY, Network, learn, score, windows

    net = Network.fresh()
    ids = np.arange(VOCABULARY)
    assert abs(np.exp(net.step(ids, np.tile([[3], [99], [500], [7]], (1, VOCABULARY))).astype(float)).sum() - 1) < 1e-3
    seq = np.tile([70, 81, 92, 103], 5000)
    around = windows(seq, np.array([0, len(seq)]))
    before = score(net, seq, around).mean()
    for _ in range(5):
        learn(net, seq, around, 0.5)
    assert score(net, seq, around).mean() > before + 2
    assert windows(np.array([5, 6, 7]), np.array([0, 2, 3])).tolist() == [[0, 0, 0], [0, 5, 0], [6, 0, 0], [0, 0, 0]]


def test_scores_equal_a_plain_loop(spark, docs):
    from gleanery.llm.common import text_buffer, words_of
    from gleanery.llm.pseudo_lm import SIDE, Network, Vocabulary, lm_scores, train

    import pyarrow as pa

    rows = docs.select("doc_id", "text").limit(40)
    frequent, flat = train(rows)
    net, voc = Network(flat), Vocabulary(frequent)
    got = {r.doc_id: r for r in lm_scores(rows).collect()}
    for r in rows.take(5):
        data, offsets = text_buffer(pa.array([r.text]))
        ids = voc.ids(words_of(data, offsets)[2])
        total = 0.0
        for k in range(len(ids)):
            around = np.array([[ids[k + s] if 0 <= k + s < len(ids) else 0] for s in [*range(-SIDE, 0), *range(1, SIDE + 1)]])
            total += float(net.step(ids[k : k + 1], around)[0])
        assert got[r.doc_id].n_tokens == len(ids) and abs(got[r.doc_id].log_prob - total) < 1e-2 * max(1, abs(total))
    x = lm_scores(odd(spark))
    assert x.count() == 9 and x.where("n_tokens = 0 and log_prob = 0 and mean_log_prob is null").count() == 3 and lm_scores(odd(spark).limit(0)).count() == 0


def test_scores_by_hand(spark, docs):
    """Sums of log-probabilities from the parameters and word counts alone, a token at a time in plain Python."""
    import math

    from gleanery.llm import pseudo_lm as M
    from gleanery.llm.common import text_buffer, words_of

    import pyarrow as pa

    rows = docs.select("doc_id", "text").limit(30)
    hashes, flat = M.train(rows)
    at, p = 0, {}
    for name, shape in M._SHAPES.items():
        size = int(np.prod(shape))
        p[name] = flat[at : at + size].astype(float).reshape(shape)
        at += size
    frequent = {h: M.RARE + 1 + k for k, h in enumerate(hashes[: M.FREQUENT].tolist())}
    texts = {r.doc_id: r.text for r in rows.collect()}
    words = {d: words_of(*text_buffer(pa.array([t])))[2].tolist() for d, t in texts.items()}
    count = collections.Counter(h for w in words.values() for h in w)
    cell = lambda h: frequent.get(h, 1 + h % M.RARE)
    in_cell = collections.Counter()
    for h, n in count.items():
        in_cell[cell(h)] += n
    soft = lambda z, k: z[k] - max(z) - math.log(sum(math.exp(x - max(z)) for x in z))
    got = {r.doc_id: r for r in M.lm_scores(rows).collect()}
    for d in sorted(words, key=lambda d: len(words[d]))[:12]:
        ids, total = [cell(h) for h in words[d]], 0.0
        for k, i in enumerate(ids):
            places = [*range(k - M.SIDE, k), *range(k + 1, k + M.SIDE + 1)]
            h = np.tanh(p["hb"] + sum(p["ctx"][n][ids[x] if 0 <= x < len(ids) else 0] for n, x in enumerate(places)))
            c, m = divmod(i, M.MEMBERS)
            total += soft((h @ p["cw"] + p["cb"]).tolist(), c) + soft((h @ p["mw"][c] + p["mb"][c]).tolist(), m)
            if i <= M.RARE:
                total += math.log(count[words[d][k]] / in_cell[i])
        assert got[d].n_tokens == len(ids) and abs(got[d].log_prob - total) < 1e-3 * max(1, abs(total)), d


def test_every_word_has_its_own_probability(spark, docs, monkeypatch):
    from gleanery.llm import pseudo_lm as M

    rows = docs.select("doc_id", "text").limit(60)
    hashes, flat = M.train(rows)
    assert len(hashes) == M.word_counts(rows).count() > 5 * M.FREQUENT
    net, voc = M.Network(flat), M.Vocabulary(hashes)
    ids = voc.ids(hashes)
    unused = np.setdiff1d(np.arange(M.VOCABULARY), M.cells_of(ids))
    at = np.tile([[3], [99], [500], [7]], (1, len(ids)))
    rest = np.exp(net.step(unused, at[:, : len(unused)]).astype(float)).sum()
    assert len(np.unique(ids)) == len(ids) and abs(np.exp(net.step(ids, at).astype(float)).sum() + rest - 1) < 1e-3
    # One word three times and another once, in one cell and one context.
    n = {r.h & (1 << 64) - 1: r.n for r in M.word_counts(rows).collect()}
    pair = sorted((h for h in hashes[M.FREQUENT :].tolist() if h % M.RARE == 5), key=n.get)
    low, high = net.step(voc.ids(np.array([pair[0], pair[-1]], np.uint64)), at[:, :2])
    assert n[pair[-1]] > n[pair[0]] and abs(high - low - np.log(n[pair[-1]] / n[pair[0]])) < 1e-3
    # Shares that are joined give what shares that are broadcast give, also for repeated rows and null ids.
    both = rows.unionByName(odd(spark).select("doc_id", "text")).unionByName(rows.limit(9))
    by = lambda: sorted((tuple(r) for r in M.lm_scores(both).collect()), key=str)
    want = by()
    for most in (0, 3000):
        monkeypatch.setattr(M, "KNOWN_WORDS", most)
        got = by()
        assert len(got) == len(want) and all(x[:2] == y[:2] and (x[2] == y[2] == 0 or abs(x[2] / y[2] - 1) < 1e-3) for x, y in zip(sorted(got, key=lambda r: (str(r[0]), r[1])), sorted(want, key=lambda r: (str(r[0]), r[1])), strict=True))


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        assert out.count() <= docs.count()
        docs = out
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    packed = P.run(spark, SF).select("doc_id").distinct().collect()
    assert {r.doc_id for r in packed} == kept and 50 < len(kept) < 200


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, an id on two texts, and columns with names that the stages use."""
    import corpus_pipeline as P

    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(9000)}" for _ in range(n))
    twin, leak = text(80), text(30)
    rows = [(1, twin), (2, twin), (3, twin + " more"), (4, None), (5, ""), (6, "a b"), (6, text(50)), (7, f"x {leak} y"), (None, text(40)), (8, "write to me@example.com now"), (8, "write to me@example.com now"), (9, text(3000))]
    names = ("row", "gone", "score", "th", "found", "bin_id")
    sf = f"file://{tmp_path}"
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names)
    spark.createDataFrame([(d, t, "en", "s", 0, *range(len(names))) for d, t in rows], schema).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes, name
        docs = after
    kept = sorted((r.doc_id for r in docs.collect()), key=str)
    assert kept == [1, 4, 5, 6, 6, 8, 8, 9, None] and docs.where("text like '%[EMAIL]%'").count() == 2
    packed = P.run(spark, sf).toPandas()
    assert sorted(set(packed.doc_id.dropna().astype(int))) == [1, 4, 5, 6, 8, 9] and (packed.length > 0).all()
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{tmp_path}/empty/documents.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{sf}/empty/{name}.parquet")
    assert P.run(spark, f"{sf}/empty").count() == 0
