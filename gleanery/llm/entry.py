"""Queries of this subpackage over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import leaks
from .licenses import licence_digest
from .near_dups import near_duplicates
from .packing import pack_documents
from .pii import pii_digest
from .pseudo_lm import lm_scores
from .quality import labels_of, quality_report
from .repeats import removal_digest
from .spelling import group_variants
from .text_rank import rank_documents
from .token_files import token_digests
from .url_filter import filter_urls
from .vp_search import nearest


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op7_sentence_rule_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named or quoted in every document."""
    return licence_digest(_docs(spark, sf_dir))


def op8_merged_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without byte strings that occur elsewhere too."""
    return removal_digest(_docs(spark, sf_dir))


def op9_setsketch_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of documents."""
    return near_duplicates(_docs(spark, sf_dir))


def op1_masked_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document."""
    return lm_scores(_docs(spark, sf_dir))


def op2_vantage_point_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op3_variable_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of several permitted lengths that hold the ids of all documents."""
    import public_tokenizers

    return pack_documents(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op4_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_report(_docs(spark, sf_dir), labels_of(spark, sf_dir))


def op6_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii_digest(_docs(spark, sf_dir))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to token files and read back."""
    import public_tokenizers

    return token_digests(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op10_spaced_seed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages, with the items."""
    return leaks(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_automaton_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that rank highest for each benchmark item."""
    return rank_documents(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_markov_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_pivotal_gram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the corpus with the frequent words that they are variants of."""
    return group_variants(_docs(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_masked_pseudo_likelihood": op1_masked_pseudo_likelihood,
    "op2_vantage_point_search": op2_vantage_point_search,
    "op3_variable_best_fit": op3_variable_best_fit,
    "op4_subword_quality": op4_subword_quality,
    "op6_bootstrapped_pii": op6_bootstrapped_pii,
    "op5_token_files": op5_token_files,
    "op7_sentence_rule_licenses": op7_sentence_rule_licenses,
    "op8_merged_bwt_repeats": op8_merged_bwt_repeats,
    "op9_setsketch_near_dups": op9_setsketch_near_dups,
    "op10_spaced_seed_leaks": op10_spaced_seed_leaks,
    "op11_automaton_ranking": op11_automaton_ranking,
    "op12_markov_url_filter": op12_markov_url_filter,
    "op13_pivotal_gram_variants": op13_pivotal_gram_variants,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKENS = r"list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BEYOND = "".join(chr(c) for c in range(0xC0, 0x100))


def _url_sql() -> str:
    """The rules, then a count of grams of each order, both models' probabilities and a sum over the characters of each text."""
    from .url_filter import HELD, KNOWN, MU, ORDER, RULES, STEP, UNIT

    sql = f"""WITH b AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
      coalesce(regexp_replace(url, '(?s)^.*?://', ''), '') AS text FROM pages),
      rules AS (SELECT * FROM (VALUES {", ".join(f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in RULES)}) v(rule, own, cut, told)),
      k AS (SELECT DISTINCT ON (host, path) host, path, rule, told FROM b JOIN rules ON (host = own OR ends_with(host, '.' || own)) AND starts_with(path, cut) ORDER BY host, path, length(rule) DESC, rule),
      f AS (SELECT b.*, rule, told FROM b LEFT JOIN k USING (host, path)),
      u AS (SELECT DISTINCT text, told, substr(md5(text), 1, 1) IN ({", ".join(f"'{x}'" for x in HELD)}) AS held FROM f),
      c AS (SELECT text, told, held, unnest(range(2, length(text) + 2)) AS i, chr(2) || text AS m FROM u WHERE text <> ''),
      g AS (SELECT text, told, held, substr(m, greatest(i - {ORDER}, 1), i - greatest(i - {ORDER}, 1) + 1) AS g FROM c),
      l AS (SELECT g, count(*) FILTER (told = 'allow') AS a, count(*) FILTER (told = 'block') AS r FROM g WHERE told IS NOT NULL AND NOT held GROUP BY 1), t AS (SELECT coalesce(sum(a), 0) AS ta, coalesce(sum(r), 0) AS tr FROM l)"""
    for k in range(ORDER + 1):
        low = f"JOIN s{k - 1} p ON p.g = substr(n.g, 2)" if k else "JOIN (SELECT 1.0::DOUBLE / (count(*) + 1) AS qa, 1.0::DOUBLE / (count(*) + 1) AS qr FROM n0) p ON true"
        sql += f""",
      n{k} AS (SELECT * FROM (SELECT right(g, {k + 1}) AS g, sum(a) AS a, sum(r) AS r FROM l WHERE length(g) >= {k + 1} GROUP BY 1), t WHERE (a > 0 AND a * {KNOWN} >= ta) OR (r > 0 AND r * {KNOWN} >= tr)),
      h{k} AS (SELECT left(g, {k}) AS h, sum(a) AS ha, sum(r) AS hr, CAST(round((ln(sum(r) + {MU}::DOUBLE) - ln(sum(a) + {MU}::DOUBLE)) * {UNIT}) AS BIGINT) AS back FROM n{k} GROUP BY 1),
      s{k} AS (SELECT n.g, (n.a + {MU}::DOUBLE * p.qa) / (ha + {MU}::DOUBLE) AS qa, (n.r + {MU}::DOUBLE * p.qr) / (hr + {MU}::DOUBLE) AS qr FROM n{k} n JOIN h{k} ON h = left(n.g, {k}) {low}),
      w{k} AS (SELECT g, CAST(round((ln(qa) - ln(qr)) * {UNIT}) AS BIGINT) AS worth FROM s{k})"""
    value = "0"
    for k in range(ORDER + 1):
        value = f"coalesce(w{k}.worth, {value} + coalesce(h{k}.back, 0))"
    joins = " ".join(f"LEFT JOIN w{k} ON length(q.g) >= {k + 1} AND w{k}.g = right(q.g, {k + 1}) LEFT JOIN h{k} ON length(q.g) >= {k + 1} AND h{k}.h = right(left(q.g, length(q.g) - 1), {k})" for k in range(ORDER + 1))
    return sql + f""",
      v AS (SELECT text, CAST(floor(CAST(sum({value}) AS DOUBLE) / count(*)) AS BIGINT) AS score FROM (SELECT text, g FROM g WHERE told IS NULL OR held) q {joins} GROUP BY 1 UNION ALL SELECT DISTINCT text, 0 FROM u WHERE text = ''),
      e AS (SELECT CAST(floor(score / {STEP}) AS BIGINT) AS step, told FROM v JOIN u USING (text) WHERE told IS NOT NULL AND held),
      y AS (SELECT DISTINCT step AS least FROM e UNION SELECT 0), z AS (SELECT least, count(*) FILTER (told = 'allow' AND step >= least) AS a, count(*) FILTER (told = 'block' AND step < least) AS r, count(*) FILTER (told = 'allow') AS ta, count(*) FILTER (told = 'block') AS tr FROM y LEFT JOIN e ON true GROUP BY 1),
      o AS (SELECT least FROM z ORDER BY CASE WHEN ta > 0 AND tr > 0 THEN round(a / ta + r / tr, 9) ELSE 0 END DESC, abs(least), least DESC LIMIT 1)
      SELECT page_id, host, path, rule, CASE WHEN told IS NOT NULL THEN told WHEN score >= least * {STEP} THEN 'allow' ELSE 'block' END AS verdict, CASE WHEN told IS NULL THEN score END AS score FROM f LEFT JOIN v USING (text), o"""


ORACLE_SQL: dict[str, str] = {
    # Every query against every vector.
    "op2_vantage_point_search": """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
      u AS (SELECT * FROM v WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
      s AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score FROM u q JOIN u c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
      SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
    # All pairs of documents with a common shingle, and labels that spread over the links.
    "op9_setsketch_near_dups": f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL),
      s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 4], ' ') END AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
      n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
      p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
      l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * c >= 75 * (x.n + y.n - c)),
      r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
      c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1)
      SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)""",
    # Equal tokens of all documents and items by offset; the fullest window that starts at an equal token is a fullest window.
    "op10_spaced_seed_leaks": f"""WITH d AS (SELECT doc_id, {_TOKENS} AS w FROM documents), i AS (SELECT DISTINCT item_id, {_TOKENS} AS w FROM benchmark),
      dt AS (SELECT doc_id, len(w) AS m, unnest(w) AS t, unnest(range(len(w))) AS p FROM d), it AS (SELECT item_id, len(w) AS n, unnest(w) AS t, unnest(range(len(w))) AS q FROM i WHERE len(w) > 0),
      e AS (SELECT doc_id, item_id, p - q AS diag, q, m, n, least(n, 20) AS k FROM dt JOIN it USING (t)),
      x AS (SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, diag ORDER BY q RANGE BETWEEN CURRENT ROW AND 19 FOLLOWING) AS full_, count(*) OVER (PARTITION BY doc_id, item_id, diag) AS every FROM e)
      SELECT doc_id, item_id, max(CASE WHEN n <= 20 THEN every ELSE full_ END) AS matched, max(k) AS "window" FROM x
      WHERE least(m, diag + n) - greatest(diag, 0) >= k GROUP BY 1, 2 HAVING max(CASE WHEN n <= 20 THEN every ELSE full_ END) >= max(CASE WHEN n < 10 THEN n ELSE ceil(k * 0.8) END)""",
    # Counts of every term of every document, joined with the items' terms.
    "op11_automaton_ranking": f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS w FROM documents WHERE doc_id IS NOT NULL),
      i AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS t FROM benchmark WHERE item_id IS NOT NULL), it AS (SELECT item_id, t, count(*) AS k FROM i GROUP BY ALL),
      g AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d WHERE len(w) > 0),
      tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) SEMI JOIN it USING (t) GROUP BY ALL), df AS (SELECT t, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, g GROUP BY t, nn),
      s AS (SELECT item_id, r, CAST(sum(k * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.w) * nn) // ll)))) AS BIGINT) AS score FROM tf JOIN df USING (t) JOIN it USING (t) JOIN d USING (r), g GROUP BY ALL)
      SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM s JOIN d USING (r) WHERE score > 0 WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 20""",
    "op12_markov_url_filter": _url_sql(),
    # All pairs of words of like length; letters beyond ASCII take the place of unused signs, as levenshtein counts bytes.
    "op13_pivotal_gram_variants": f"""WITH RECURSIVE c AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, n)) AS c),
      r AS (SELECT doc_id, translate(w, '{_UPPER}', '{_LOWER}') AS w, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS w FROM documents) GROUP BY ALL),
      b AS (SELECT doc_id, w, k, hex(encode(concat(CAST(doc_id AS VARCHAR), ':', w))) AS x FROM r),
      h AS (SELECT doc_id, w, k, xor(4294967295, list_reduce(list_transform(range(len(x) // 2), lambda i: CAST(concat('0x', x[2 * i + 1 : 2 * i + 2]) AS BIGINT)), lambda z, y: xor(z >> 8, c[(xor(z, y) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS h FROM b, c),
      f AS (SELECT CASE WHEN h % 199 = 0 THEN concat(left(w, CAST(h % length(w) AS BIGINT)), substr(w, CAST(h % length(w) AS BIGINT) + 2)) ELSE w END AS word, k FROM h),
      n AS (SELECT word, CAST(sum(k) AS BIGINT) AS n, translate(word, '{_BEYOND}', '{_UPPER}0123456789!#$%&()*+,-./:;<=>?@[]^_{{|}}~') AS z FROM f WHERE length(word) >= 6 GROUP BY 1 HAVING sum(k) >= 5),
      p AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM n a JOIN n b ON length(b.z) BETWEEN length(a.z) - 1 AND length(a.z) + 1 AND levenshtein(a.z, b.z) = 1),
      q AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near FROM p QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, other) = 1),
      o AS (SELECT n.word, CASE WHEN q.m >= 5 * n.n THEN other END AS form, n.n, coalesce(n_near, 0) AS n_near, CASE WHEN q.m >= 5 * n.n THEN m END AS form_n FROM n LEFT JOIN q USING (word)),
      t AS (SELECT word, word AS root FROM o UNION ALL SELECT t.word, o.form FROM t JOIN o ON o.word = t.root WHERE o.form IS NOT NULL)
      SELECT o.word, o.form, t.root, o.n, o.n_near, o.form_n FROM o JOIN t USING (word) JOIN o AS e ON e.word = t.root WHERE e.form IS NULL""",
}
