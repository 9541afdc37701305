"""Automaton ranking, URL models and spelling variants against plain loops, with odd inputs."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
import zlib

import pytest

from .test_llm import DOCS, odd

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def low(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---------------------------------------------------------------- ranking


def plain_ranking(docs, items, k):
    cut = [(d, TERM.findall(low(t or ""))) for d, t in docs if d is not None]
    n_docs, length = sum(bool(w) for _, w in cut), sum(len(w) for _, w in cut)
    df = collections.Counter(t for _, w in cut for t in set(w))
    wanted = collections.defaultdict(list)
    for i, t in items:
        if i is not None:
            wanted[i] += TERM.findall(low(t or ""))
    out = []
    for i, terms in wanted.items():
        rows = []
        for d, w in cut:
            tf = collections.Counter(w)
            m = 75 + 25 * len(w) * n_docs // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in terms)
            if score > 0:
                rows.append((-score, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(rows)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_ranking_equals_a_plain_loop(spark, block_bytes):
    from gleanery.llm.text_rank import rank_documents

    rng = random.Random(5)
    words = [f"w{k}" for k in range(40)] + ["Été", "漢字", "x1y", "w"]
    docs = [(d, "".join(rng.choice(words) + rng.choice([" ", "-", ". ", "\n"]) for _ in range(rng.randrange(60)))) for d in range(150)]
    docs += [(200, docs[0][1]), (200, docs[0][1]), (201, None), (202, ""), (203, "--- ..."), (None, "w1 w2 w3"), (204, "w1 " * 50_000), (205, "\U0001f600 w1\x00w2")]
    items = [(i, " ".join(rng.choice(words).upper() for _ in range(rng.randrange(12)))) for i in range(20)] + [(30, None), (31, ""), (32, "nowhere"), (None, "w1"), (5, "w3 w3"), (33, "été été")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 as n", "2 as score", "3 as item", "4 as terms")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "1 as n", "2 as term", "3 as block")
    got = sorted(tuple(r) for r in rank_documents(d.repartition(7), i, 20, block_bytes=block_bytes).select("item_id", "rank", "doc_id", "score").collect())
    assert got == plain_ranking(docs, items, 20)


def test_ranking_of_empty_tables(spark):
    from gleanery.llm.text_rank import rank_documents

    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert rank_documents(odd(spark).limit(0), items).count() == 0
    assert rank_documents(odd(spark), items.limit(0)).count() == 0
    # Two equal rows of an id are two documents.
    assert [(r.doc_id, r["rank"]) for r in rank_documents(odd(spark), items).orderBy("rank").collect()] == [(4, 1), (4, 2)]


def test_best_rows_of_an_item_are_kept():
    import numpy as np

    from gleanery.llm.text_rank import Best

    rng = np.random.default_rng(3)
    scores, docs = rng.integers(0, 9, (200, 6)), rng.permutation(200)
    best = Best(6, 4)
    for a in range(0, 200, 13):
        best.add(scores[a : a + 13], docs[a : a + 13])
    for i in range(6):
        wanted = sorted((-s, d) for s, d in zip(scores[:, i], docs, strict=True) if s > 0)[:4]
        assert sorted((-s, d) for s, d, k in zip(best.score, best.doc, best.item, strict=True) if k == i) == wanted


# ---------------------------------------------------------------- URLs


def plain_urls(urls, rules, order, mu, known, held):
    def split(u):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        return (low(m[1]), m[2]) if m else ("", "")

    def rule(u):
        host, path = split(u)
        fit = [(r, v) for r, v in rules if (host == (own := r.split("/", 1)[0]) or host.endswith("." + own)) and path.startswith("/" + r.split("/", 1)[1])]
        return max(fit, key=lambda x: len(x[0]), default=(None, None))

    text = lambda u: re.sub(r"(?s)^.*?://", "", u or "", count=1)
    import hashlib

    kept_back = lambda t: hashlib.md5(t.encode()).hexdigest()[0] in held
    learn = {(text(u), rule(u)[1]) for u in urls if rule(u)[1]}
    count = {v: collections.Counter() for v in ("allow", "block")}
    total = collections.Counter()
    for t, v in learn:
        if not kept_back(t):
            m = "\x02" + t
            for i in range(1, len(m)):
                total[v] += 1
                for k in range(min(order, i) + 1):
                    count[v][m[i - k : i + 1]] += 1
    grams = {g for v in count for g in count[v] if count[v][g] * known >= total[v]}
    inner = {v: collections.Counter() for v in count}
    for v, g in itertools.product(count, grams):
        inner[v][g[:-1]] += count[v][g]
    alphabet = sum(len(g) == 1 for g in grams) + 1

    def p(v, h, c):
        below = p(v, h[1:], c) if h else 1 / alphabet
        return ((count[v][h + c] if h + c in grams else 0) + mu * below) / (inner[v][h] + mu)

    def score(t):
        m = "\x02" + t
        values = [math.log(p("allow", m[max(0, i - order) : i], m[i])) - math.log(p("block", m[max(0, i - order) : i], m[i])) for i in range(1, len(m))]
        return sum(values) / len(values) if values else 0.0

    back = [(score(t), v) for t, v in learn if kept_back(t)]
    steps = sorted({math.floor(s * 100 + 1e-9) for s, _ in back} | {0})

    def gain(least):
        a, r = [s for s, v in back if v == "allow"], [s for s, v in back if v == "block"]
        return round(sum(math.floor(s * 100 + 1e-9) >= least for s in a) / len(a) + sum(math.floor(s * 100 + 1e-9) < least for s in r) / len(r), 9) if a and r else 0

    least = max(steps, key=lambda x: (gain(x), -abs(x), x))
    return [(u, *split(u), *(rule(u) if rule(u)[1] else (None, "allow" if score(text(u)) * 100 >= least - 1e-3 else "block")), None if rule(u)[1] else score(text(u))) for u in urls]


ODD_URLS = [None, "", "no scheme", "http://", "http://x.net", "://A.Org/y", "http://b.ORG/é/\U0001f600?q=1", "http://org/x", "http://xorg/x", "http://example.org/es/5", "http://a.example.org/es/5#t", "http://example.org/en/12", "http://q.com/de", "http://q.com/de/", "http://u@h.org:80/z", "http://long.net/" + "ab" * 3000]


@pytest.mark.parametrize("known", [20_000, 300])
def test_urls_against_a_plain_model(spark, monkeypatch, known):
    from gleanery.llm import url_filter as U

    monkeypatch.setattr(U, "KNOWN", known)
    rng = random.Random(2)
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(['good', 'fine', 'spam', 'win'])}{rng.randrange(4)}.example.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'es', 'de', 'fr'])}/{rng.randrange(300)}" for _ in range(150)] + ODD_URLS + ODD_URLS[:6]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("page_id", "url", "'x' as host", "'y' as text", "1 as told", "2 as g")
    got = {r.page_id: r for r in U.filter_urls(pages).collect()}
    assert len(got) == len(urls)
    for k, (_, host, path, rule, verdict, score) in enumerate(plain_urls(urls, U.RULES, U.ORDER, U.MU, known, U.HELD)):
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (host, path, rule, verdict), (urls[k], got[k], score)
        assert (got[k].score is None) == (score is None) and (score is None or abs(got[k].score / U.UNIT - score) < 1e-4)


def test_rules_are_those_of_the_contract(spark):
    """Each rule with its word, on a URL of its own host, a subdomain and a path just beside it."""
    from gleanery.llm.url_filter import filter_urls

    wanted = {
        "http://some.org/en/1": ("org/", "allow"), "http://example.org/es/5": ("example.org/es/", "block"), "http://a.Example.ORG/es/": ("example.org/es/", "block"),
        "http://example.org/en/1": ("example.org/en/1", "block"), "http://b.example.org/en/12?x": ("example.org/en/1", "block"), "http://example.org/en/2": ("org/", "allow"),
        "http://x.com/fr/9": ("com/fr/", "allow"), "http://x.com/de/9": ("com/de/", "block"),
    }
    pages = spark.createDataFrame(list(enumerate(wanted)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in filter_urls(pages).collect()}
    assert [got[k] for k in range(len(wanted))] == list(wanted.values())


def test_urls_without_anything_to_learn(spark):
    from gleanery.llm.url_filter import filter_urls

    pages = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (None, None)], "page_id long, url string")
    assert sorted((r.page_id or 0, r.rule, r.verdict, r.score) for r in filter_urls(pages).collect()) == [(0, None, "allow", 0), (1, None, "allow", 0), (1, None, "allow", 0)]
    assert filter_urls(pages.limit(0)).count() == 0


def test_models_tell_what_they_have_learnt(spark):
    """A word that stands in rejected URLs alone speaks against a URL, one of accepted ones for it."""
    from gleanery.llm.url_filter import filter_urls

    rows = [(k, f"http://{w}{k}.shop.com/{p}/{k}") for k in range(200) for w, p in ((("casino", "de") if k % 2 else ("garden", "fr")),)]
    pages = spark.createDataFrame([*rows, (1000, "http://casino9.shop.net/en/7"), (1001, "http://garden8.shop.net/en/7")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in filter_urls(pages).collect()}
    assert (got[1000], got[1001]) == ("block", "allow")


def test_url_filter_runs_no_python(spark):
    from gleanery.llm import url_filter as U

    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.net/y")], "page_id long, url string")
    plan = U.filter_urls(pages)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- words


def plain_variants(docs, typo):
    n = collections.Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = low(run)
            if d is not None and (h := zlib.crc32(f"{d}:{w}".encode())) % typo == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out = {}
    for w in n:
        found = sorted((-n[o], o) for o in n if near(w, o))
        fits = bool(found) and -found[0][0] >= 5 * n[w]
        out[w] = [found[0][1] if fits else None, n[w], len(found), -found[0][0] if fits else None]
    root = {}
    for w in n:
        root[w] = w
        while out[root[w]][0]:
            root[w] = out[root[w]][0]
    return sorted((w, f, root[w], k, m, fn) for w, (f, k, m, fn) in out.items())


def test_variants_equal_all_pairs(spark):
    from gleanery.llm.spelling import group_variants

    rng = random.Random(8)
    base = ["".join(rng.choice("abÀé") for _ in range(rng.randrange(6, 10))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "ababab", "bababab"]
    docs = []
    for d in range(260):
        w = [rng.choice(base) for _ in range(rng.choice([0, 20, 60]))]
        for k in range(0, len(w), 9):
            p = rng.randrange(len(w[k]))
            w[k] = w[k][:p] + rng.choice(["", "a", "b", "ba"]) + w[k][p + 1 :]
        docs.append((d, " ".join(w).title() if d % 5 == 0 else "1".join(w)))
    docs += [(7, docs[7][1]), (None, docs[4][1]), (300, None), (301, ""), (302, "aaaaab " * 9000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 as word", "2 as n", "3 as root")
    got = group_variants(frame, typo=13).select("word", "form", "root", "n", "n_near", "form_n").collect()
    wanted = plain_variants(docs, 13)
    assert sorted(map(tuple, got)) == wanted and sum(r[1] is not None for r in wanted) > 10 and any(r[1] not in (None, r[2]) for r in wanted)


def test_variants_of_odd_rows(spark):
    from gleanery.llm.spelling import group_variants

    assert group_variants(odd(spark).limit(0)).count() == 0
    assert group_variants(odd(spark)).count() == 0
    many = spark.createDataFrame([(1, "letter " * 5, "e", "s", 1)], DOCS)
    assert [tuple(r) for r in group_variants(many, typo=None).collect()] == [("letter", None, "letter", 5, 0, None)]


def test_pivots_are_the_cheapest_pair_that_is_disjoint():
    from gleanery.llm.spelling import GRAM, pivots_of, prefix_grams

    rng = random.Random(1)
    for _ in range(500):
        at = sorted(rng.sample(range(12), rng.randrange(3, 7)))
        places = [(p, rng.randrange(1, 9)) for p in at]
        pairs = [(places[i][1] + places[j][1]) for i in range(len(at)) for j in range(i) if at[i] - at[j] >= GRAM]
        a, b = pivots_of(places)
        assert at[b] - at[a] >= GRAM and places[a][1] + places[b][1] == min(pairs)
    # Rarest three grams, and the pair of them that doesn't overlap.
    often = {"ab": 9, "bc": 1, "cd": 2, "de": 3, "ef": 9}
    assert prefix_grams("abcdef", often) == [("bc", 1, True), ("cd", 2, False), ("de", 3, True)]
