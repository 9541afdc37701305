"""URL filter: rules first, then the ratio of two character models, in DataFrame functions alone.

URLs that a rule accepts or rejects teach a model each: characters are predicted from up to ORDER characters before them,
where the corpus has seen them often enough, and each order is smoothed with the one below. A URL without a rule is judged
by the difference of its log-likelihoods, divided by its length, against a threshold that is calibrated on URLs with a
rule that the models haven't seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Fixed values: (rule, verdict); host before the first slash, path from it on.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Characters before the predicted one at most, and the weight of the lower order beside an order's counts.
ORDER, MU = 4, 4.0
#: A gram is known if it makes one part in so many of its class, so each order knows at most twice as many grams.
KNOWN = 20_000
#: Log-likelihoods are whole numbers of millionths, so sums don't depend on their order; thresholds are steps of 0.01.
UNIT, STEP = 1_000_000, 10_000
#: First digits of a hash of the URL's text that are kept for calibration.
HELD = ("0", "1", "2")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as they stand; both empty for null and where no ``://`` is."""
    part = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def first_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as (rule, verdict), else null: a plain expression, no join, as rules are few."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0]))[::-1]:
        own, cut = rule.split("/", 1)
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + cut)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep..., g): for every character of ``text`` itself behind the ORDER characters before it; the start counts as one."""
    marked = F.concat(F.lit("\x02"), F.col("text"))
    at = F.explode(F.sequence(F.lit(2), F.length("marked"))).alias("i")
    cut = rows.where(F.length("text") > 0).select(*keep, marked.alias("marked")).select(*keep, "marked", at)
    first = F.greatest(F.col("i") - ORDER, F.lit(1))
    return cut.select(*keep, F.substring("marked", first, F.col("i") - first + 1).alias("g"))


def _tail(c: Column | str, n: int) -> Column:
    """The last n characters."""
    return F.substring(c, F.greatest(F.length(c) - (n - 1), F.lit(1)), F.lit(n))


def ratio_tables(rows: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 0: (g, worth) of known grams, and (g, back) of their contexts, both in units of a millionth.

    ``rows`` (text, accepted) are the URLs to learn from. ``worth`` is the difference of the logarithms of both models'
    probabilities of a gram's last character, ``back`` what is added when a context doesn't know the character.
    """
    long = stored(grams(rows, "accepted").groupBy("accepted", "g").agg(F.count("*").alias("n")), "url-grams")
    total = long.groupBy().agg(*(F.coalesce(F.sum(F.when(F.col("accepted") == x, F.col("n"))), F.lit(0)).alias(c) for c, x in (("ta", True), ("tr", False))))
    ln_ratio = lambda a, b: F.round((F.log(a) - F.log(b)) * UNIT).cast("long")
    tables, below = [], None
    for k in range(ORDER + 1):
        # Counts of an order come from the longest grams, not from the texts again.
        full = long.where(F.length("g") >= k + 1).select(_tail("g", k + 1).alias("g"), "accepted", "n")
        both = full.groupBy("g").agg(*(F.coalesce(F.sum(F.when(F.col("accepted") == x, F.col("n"))), F.lit(0)).alias(c) for c, x in (("a", True), ("r", False))))
        known = both.join(F.broadcast(total), F.lit(True)).where((F.col("a") * KNOWN >= F.col("ta")) & (F.col("a") > 0) | (F.col("r") * KNOWN >= F.col("tr")) & (F.col("r") > 0))
        known = known.select("g", F.substring("g", F.lit(1), F.lit(k)).alias("h"), "a", "r")
        context = known.groupBy("h").agg(F.sum("a").alias("ha"), F.sum("r").alias("hr"))
        seen = known.join(context, "h")
        if k:
            seen = seen.join(below.select(F.col("g").alias("lower"), "pa", "pr"), F.substring("g", F.lit(2), F.lit(k)) == F.col("lower"))
        else:
            # Under order 0 lies the same chance for every character; one stands for all that were never seen.
            seen = seen.join(F.broadcast(known.agg((F.lit(1.0) / (F.count("*") + 1)).alias("pa"))), F.lit(True)).withColumn("pr", F.col("pa"))
        p = lambda n, of, low: ((F.col(n) + MU * F.col(low)) / (F.col(of) + MU))
        seen = stored(seen.select("g", "h", "ha", "hr", p("a", "ha", "pa").alias("qa"), p("r", "hr", "pr").alias("qr")), f"url-order-{k}")
        below = seen.select("g", F.col("qa").alias("pa"), F.col("qr").alias("pr"))
        back = seen.groupBy("h").agg(F.first("ha").alias("ha"), F.first("hr").alias("hr")).select("h", ln_ratio(F.col("hr") + MU, F.col("ha") + MU).alias("back"))
        tables.append((seen.select("g", ln_ratio("qa", "qr").alias("worth")), back))
    return tables


def url_scores(texts: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(text, score): difference of the log-likelihoods by character; ``texts`` (text) must be distinct; empty ones score 0.

    The tables are bounded by KNOWN and ORDER, whatever the corpus, so all are broadcast.
    """
    at = grams(texts, "text")
    for k, (worth, back) in enumerate(tables):
        at = at.join(F.broadcast(worth.select(F.col("g").alias(f"g{k}"), F.col("worth").alias(f"w{k}"))), F.when(F.length("g") >= k + 1, _tail("g", k + 1)) == F.col(f"g{k}"), "left")
        context = F.substring("g", F.lit(1), F.length("g") - 1)
        own = F.when(F.length("g") >= k + 1, _tail(context, k) if k else F.lit(""))
        at = at.join(F.broadcast(back.select(F.col("h").alias(f"h{k}"), F.col("back").alias(f"b{k}"))), own == F.col(f"h{k}"), "left").drop(f"g{k}", f"h{k}")
    # The longest known gram counts, and each longer context that doesn't know the character.
    value = F.lit(0).cast("long")
    for k in range(len(tables)):
        value = F.coalesce(F.col(f"w{k}"), value + F.coalesce(F.col(f"b{k}"), F.lit(0)))
    sums = at.select("text", value.alias("v")).groupBy("text").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
    none = texts.where(F.length("text") == 0).select("text", F.lit(0).cast("long").alias("score"))
    return sums.select("text", F.floor(F.col("s") / F.col("n")).cast("long").alias("score")).unionByName(none)


def threshold(held: DataFrame) -> DataFrame:
    """One row (least): the step from which on URLs are accepted, where both classes (score, accepted) are told best.

    The shares of accepted URLs from a step on and of rejected ones under it are added; ties go to the step nearest to 0.
    Without URLs of both classes the step is 0. Steps are few, whatever the number of URLs.
    """
    steps = held.groupBy(F.floor(F.col("score") / STEP).cast("long").alias("step")).agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))
    steps = stored(steps.unionByName(held.sparkSession.range(1).select(*(F.lit(0).cast("long").alias(c) for c in ("step", "a", "r")))).coalesce(1), "url-steps")
    cut = steps.select(F.col("step").alias("least")).distinct()
    told = cut.join(F.broadcast(steps), F.lit(True)).groupBy("least").agg(F.sum(F.when(F.col("step") >= F.col("least"), F.col("a")).otherwise(0)).alias("a"), F.sum(F.when(F.col("step") < F.col("least"), F.col("r")).otherwise(0)).alias("r"), F.sum("a").alias("ta"), F.sum("r").alias("tr"))
    gain = F.when((F.col("ta") > 0) & (F.col("tr") > 0), F.round(F.col("a") / F.col("ta") + F.col("r") / F.col("tr"), 9)).otherwise(0.0)
    return told.agg(F.max_by("least", F.struct(gain.alias("g"), (-F.abs("least")).alias("d"), "least")).alias("least"))


def filter_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score): the rule's verdict, else the models'; the score is null where a rule decides.

    Every row stays, repeated ones and those without an id too. Null and empty URLs score 0. Characters are code points;
    very long URLs are read whole. Without URLs to learn from all scores are 0, and 0 is accepted unless calibration
    says otherwise. An empty table gives no rows. Other columns are not read.

    Equal texts are learnt from and scored once, so a URL on many rows is one row until the last join, which only rows
    without a rule take part in.
    """
    if len(rules) > 200:
        raise ValueError("rules are an expression; more than 200 need a join on hosts")
    url = F.col(url_col).cast("string")
    host, path = host_and_path(url)
    base = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.coalesce(F.regexp_replace(url, r"(?s)^.*?://", ""), F.lit("")).alias("text"))
    base = base.withColumn("found", first_rule(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", "text", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("told"))
    texts = stored(base.groupBy("text", "told").agg(F.substring(F.md5(F.col("text").cast("binary")), 1, 1).isin(*HELD).alias("held")), "url-texts")
    labelled = texts.where("told is not null").select("text", (F.col("told") == "allow").alias("accepted"), "held")
    tables = ratio_tables(labelled.where("not held"))
    scores = stored(url_scores(texts.where("told is null or held").select("text").distinct(), tables), "url-scores")
    least = threshold(labelled.where("held").join(scores, "text"))
    none = F.lit(None).cast("long")
    ruled = base.where("told is not null").select("page_id", "host", "path", "rule", F.col("told").alias("verdict"), none.alias("score"))
    rest = base.where("told is null").join(scores, "text").join(F.broadcast(least), F.lit(True))
    verdict = F.when(F.col("score") >= F.col("least") * STEP, "allow").otherwise("block")
    return ruled.unionByName(rest.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score"))
