"""Health of links: a table keyed by URL, with a time to live by class, and first-match gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hours that an answer stays good, by class; others are never kept.
TTL_HOURS = {"reachable": 72, "confirmed_dead": 24, "blocked": 168, "invalid": 168}
#: The classes, and the answers that tell that a page is gone.
CLASSES, GONE = (*TTL_HOURS, "indeterminate"), (404, 410)


def classify(status: Column, confirmed: Column, valid: Column, blocked: Column) -> Column:
    """Class of a link by its answers: a 404 or 410 counts only if a second request gives one again."""
    gone = status.isin(404, 410)
    return F.when(blocked, "blocked").when(~valid, "invalid").when(gone & confirmed.isin(404, 410), "confirmed_dead").when(status.between(200, 399), "reachable").otherwise("indeterminate")


def fresh(kind: Column, age_hours: Column) -> Column:
    """Whether an answer of this class and age is still good."""
    c = None
    for k, h in TTL_HOURS.items():
        c = F.when(kind == k, age_hours <= h) if c is None else c.when(kind == k, age_hours <= h)
    return F.coalesce(c.otherwise(False), F.lit(False))


def health_violations(health: DataFrame) -> DataFrame:
    """(url, issue) of a table of link health: empty and repeated URLs, unknown classes, and links held for dead without a
    404 or 410; empty if it is sound. ``health`` has url, classification, status_code."""
    u = F.coalesce("url", F.lit(""))
    empty = health.where(u == "").select(u.alias("url"), F.lit("empty url").alias("issue"))
    again = health.where(u != "").groupBy("url").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("url", F.lit("repeated url").alias("issue"))
    unknown = health.where(~F.coalesce("classification", F.lit("")).isin(*CLASSES)).select(u.alias("url"), F.lit("unknown class").alias("issue"))
    dead = health.where((F.col("classification") == "confirmed_dead") & ~F.coalesce("status_code", F.lit(0)).isin(*GONE)).select(u.alias("url"), F.lit("dead without 404 or 410").alias("issue"))
    return empty.unionByName(again).unionByName(unknown).unionByName(dead)


def with_health(sources: DataFrame, health: DataFrame) -> DataFrame:
    """``sources`` (with url and decision) with classification, '' where the link wasn't looked at, and decision and basis
    after the gate that a dead link closes, whatever was decided before."""
    h = health.select(F.col("url").alias("_u"), F.col("classification").alias("_c")).dropDuplicates(["_u"])
    joined = sources.join(h, F.col("url") == F.col("_u"), "left")
    dead = F.coalesce(F.col("_c") == "confirmed_dead", F.lit(False))
    return joined.withColumns({"classification": F.coalesce("_c", F.lit("")), "basis": F.when(dead, "dead link").otherwise("decision"), "decision": F.when(dead, "exclude").otherwise(F.col("decision"))}).drop("_u", "_c")


def cached(health: DataFrame, now: Column, scope: Column, wanted: str) -> DataFrame:
    """The rows of a cache of link health that are of the wanted scope, of a class that is kept, and still good."""
    return health.where((scope == wanted) & fresh(F.col("classification"), (now.cast("double") - F.col("checked_at").cast("double")) / 3600))


def by_class(references: DataFrame, health: DataFrame) -> DataFrame:
    """(classification, n_urls, n_references): links and what refers to them by class; links that weren't looked at are
    'unchecked'. References are counted by link before the join."""
    n = references.where("url != ''").groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    j = n.join(health.select("url", "classification").dropDuplicates(["url"]), "url", "left")
    return j.groupBy(F.coalesce("classification", F.lit("unchecked")).alias("classification")).agg(F.count(F.lit(1)).alias("n_urls"), F.sum("n").alias("n_references"))


def coverage(expected: DataFrame, checked: DataFrame) -> DataFrame:
    """URLs that should have been checked and weren't."""
    return expected.select("url").where("url != ''").distinct().join(checked.select("url"), "url", "left_anti")


def first_match(rules: list[tuple[Column, str, str]], decision: str, reason: str) -> Column:
    """struct(decision, reason) of the first rule that holds; the order of the rules is their meaning."""
    c = None
    for test, d, r in rules:
        value = F.struct(F.lit(d).alias("decision"), F.lit(r).alias("reason"))
        c = F.when(test, value) if c is None else c.when(test, value)
    default = F.struct(F.lit(decision).alias("decision"), F.lit(reason).alias("reason"))
    return default if c is None else c.otherwise(default)
