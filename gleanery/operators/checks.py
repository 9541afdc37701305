"""Data-quality checks with one result: name, status (pass, warn, fail), summary, details."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

RESULT = ["name", "status", "summary", "details"]


def as_check(findings: DataFrame, name: str, detail: Column, bad: str = "fail", most: int = 10) -> DataFrame:
    """One result row: pass without findings, else ``bad`` with their number and the first ``most`` details.

    Only the least details are kept on the way (a bounded aggregate), never all findings.
    """
    top = findings.select(detail.alias("d")).orderBy("d").limit(most).agg(F.array_sort(F.collect_list("d")).alias("details"))
    n = findings.agg(F.count("*").alias("n"))
    return n.crossJoin(top).select(F.lit(name).alias("name"), F.when(F.col("n") == 0, "pass").otherwise(bad).alias("status"), F.concat(F.col("n").cast("string"), F.lit(" findings")).alias("summary"), "details")


def roll_up(results: DataFrame) -> DataFrame:
    """Number of checks by status, and whether all is well: green only without failures and anything unverified."""
    out = results.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("pass", "warn", "fail", "unverified")), F.count_if(F.col("status") == "behind").alias("behind"))
    return out.withColumn("issues", F.col("fail") + F.col("behind")).withColumn("green", (F.col("issues") == 0) & (F.col("unverified") == 0))


def expected_against_table(expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """(key, state) of keys that are missing, extra, or have another value than expected."""
    both = expected.select(key, F.col(value).alias("e"), F.lit(1).alias("__e")).join(actual.select(key, F.col(value).alias("a"), F.lit(1).alias("__a")), key, "full_outer")
    state = F.when(F.col("__a").isNull(), "missing").when(F.col("__e").isNull(), "extra").when(~F.col("e").eqNullSafe(F.col("a")), "mismatch")
    return both.select(key, state.alias("state")).where("state is not null")


def null_counts(rows: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Rows of each group and how many are null or blank in each column; one pass."""
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    return rows.groupBy(group).agg(F.count("*").alias("n"), *(F.count_if(blank(c)).alias(f"no_{c}") for c in columns))


def coverage(groups: DataFrame, items: DataFrame, group: str, has: Column, date: str, policies: DataFrame) -> DataFrame:
    """Status of each group by its policy.

    Policies (group, mode, max_lag_days, min_coverage): ``complete`` fails unless every item is covered; ``latest``
    warns if the newest covered item lies too far behind the newest; ``none`` and empty groups are skipped; a coverage
    under the minimum warns.
    """
    per = items.groupBy(group).agg(F.count("*").alias("items"), F.count_if(has).alias("covered"), F.max(date).alias("newest"), F.max(F.when(has, F.col(date))).alias("newest_covered"))
    out = groups.select(group).join(per, group, "left").join(policies, group, "left").na.fill(0, ["items", "covered"])
    share = F.try_divide(F.col("covered").cast("double"), F.col("items"))
    lag = F.datediff("newest", "newest_covered")
    status = (
        F.when((F.col("items") == 0) | (F.coalesce("mode", F.lit("none")) == "none"), "skip")
        .when((F.col("mode") == "complete") & (F.col("covered") < F.col("items")), "fail")
        .when((F.col("mode") == "latest") & (lag.isNull() | (lag > F.col("max_lag_days"))), "warn")
        .when(share < F.col("min_coverage"), "warn")
        .otherwise("pass")
    )
    return out.select(group, "items", "covered", lag.cast("long").alias("lag_days"), status.alias("status"))


def freshness(items: DataFrame, group: str, date: str, as_of, limits: DataFrame | None = None, default_days: int = 14) -> DataFrame:
    """Days since each group's newest item against its limit; groups marked ``skip`` in ``limits`` pass as skipped."""
    out = items.groupBy(group).agg(F.max(date).alias("newest"))
    if limits is not None:
        out = out.join(limits, group, "left")
    else:
        out = out.withColumns({"days": F.lit(None).cast("int"), "skip": F.lit(False)})
    age = F.datediff(F.lit(as_of), F.col("newest"))
    status = F.when(F.coalesce("skip", F.lit(False)), "skip").when(age > F.coalesce("days", F.lit(default_days)), "fail").otherwise("pass")
    return out.select(group, age.cast("long").alias("age_days"), status.alias("status"))


def sync_drift(rows: DataFrame, group: str, as_of, days: int) -> DataFrame:
    """Rows of each group that wait for a first sync longer than ``days``, and pages that are older than their row."""
    waiting = F.col("synced_on").isNull() & (F.datediff(F.lit(as_of), F.col("updated_on")) > days)
    stale = F.col("synced_on").isNotNull() & (F.col("updated_on") > F.col("synced_on"))
    return rows.groupBy(group).agg(F.count_if(waiting).alias("waiting"), F.count_if(stale).alias("stale")).withColumn("status", F.when((F.col("waiting") > 0) | (F.col("stale") > 0), "fail").otherwise("pass"))


def second_source_lag(ours: DataFrame, source_dates: DataFrame, group: str, date: str, as_of) -> DataFrame:
    """How many dates of another source are later than our newest; groups it says nothing of are ``unverified``.

    Dates in the future do not count.
    """
    last = ours.groupBy(group).agg(F.max(date).alias("newest"))
    s = source_dates.where(F.col(date) <= F.lit(as_of)).select(group, F.col(date).alias("__d"))
    counted = s.join(last, group).groupBy(group).agg(F.count_if(F.col("newest").isNull() | (F.col("__d") > F.col("newest"))).alias("behind"))
    out = last.join(counted, group, "left")
    return out.select(group, F.coalesce("behind", F.lit(0)).alias("behind"), F.when(F.col("behind").isNull(), "unverified").when(F.col("behind") > 0, "behind").otherwise("ok").alias("status"))


def late_source_queue(items: DataFrame, key: str, from_notes: Column, arrived: str, as_of, fail_after: int = 3) -> DataFrame:
    """Items made from notes although the better source has come since, with days waiting and status."""
    days = F.datediff(F.lit(as_of), F.col(arrived))
    return items.where(from_notes & F.col(arrived).isNotNull()).select(key, days.cast("long").alias("days"), F.when(days > fail_after, "fail").otherwise("warn").alias("status"))


def measured_write(rows: DataFrame, path: str, measures: dict[str, Column]) -> dict:
    """Write rows and return measures of them that were taken on the way; no second pass is made."""
    seen = Observation(f"write-{uuid.uuid4().hex}")
    rows.observe(seen, *(c.alias(n) for n, c in measures.items())).write.mode("overwrite").parquet(path)
    return seen.get


def rules_on_write(rows: DataFrame, path: str, rules: dict[str, Column]) -> DataFrame:
    """field_rules() of rows while they are written."""
    found = measured_write(rows, path, {r: F.count_if(F.coalesce(c, F.lit(False))) for r, c in rules.items()})
    return rows.sparkSession.createDataFrame(list(found.items()), "rule string, n long")


def field_rules(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n): rows that break each rule, all rules in one pass."""
    counted = rows.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(r) for r, c in rules.items()))
    pairs = F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("n")) for r in rules))
    return counted.select(F.inline(pairs))


def batch_gate(batches: DataFrame, max_review: float = 0.40, least: float = 5, most: float = 30, core_least: float = 3) -> DataFrame:
    """(batch, reason): first failing rule of batches (batch, episodes, mentions, review, core), null if all hold."""
    per = F.try_divide(F.col("mentions").cast("double"), F.col("episodes"))
    reason = (
        F.when(F.col("mentions") == 0, "no_mentions")
        .when(F.try_divide(F.col("review").cast("double"), F.col("mentions")) > max_review, "review_rate")
        .when(per < least, "too_few")
        .when(per > most, "too_many")
        .when(F.try_divide(F.col("core").cast("double"), F.col("episodes")) < core_least, "few_core")
    )
    return batches.select("batch", reason.alias("reason"))


def repair_flags(items: DataFrame, children: DataFrame, key: str, flag: str) -> DataFrame:
    """(key, old, new) of items whose set flag says otherwise than their children; null flags stay."""
    n = children.groupBy(key).agg(F.lit(True).alias("__has"))
    new = F.coalesce("__has", F.lit(False))
    return items.where(F.col(flag).isNotNull()).join(n, key, "left").where(F.col(flag) != new).select(key, F.col(flag).alias("old"), new.alias("new"))


def not_in_enum(rows: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """(value, n) of values outside an enumeration; null is allowed."""
    return rows.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
