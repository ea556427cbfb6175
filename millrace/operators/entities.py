"""Who a source is: joins of sources with a registry of subjects by alias, host or certification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import host, normalized
from millrace.plans.lineage import small


def unambiguous(registry: DataFrame, key: Column) -> DataFrame:
    """(key, subject): keys of the registry that stand for one subject only. ``registry`` has subject, name."""
    return registry.select(key.alias("key"), "subject").where("key != ''").groupBy("key").agg(F.min("subject").alias("subject"), F.count_distinct("subject").alias("n")).where("n = 1").select("key", "subject")


def by_alias(sources: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, subject) of sources whose normalised author is an unambiguous alias; subject null elsewhere."""
    return sources.select("id", normalized(F.col("author")).alias("key")).join(small(unambiguous(registry, normalized(F.col("name")))), "key", "left").select("id", "subject")


def host_suffixes(h: Column) -> Column:
    """A host and all domains above it, longest first."""
    parts = F.split(h, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "."))


def by_domain(sources: DataFrame, domains: DataFrame) -> DataFrame:
    """(id, domain, subject) of the longest domain that the source's host is or lies under; one equi-join on suffixes.

    ``domains`` has domain, subject. Sources without host or match are left out; level domains go by the domain's name.
    """
    rows = sources.select("id", host(F.col("url")).alias("h")).where("h != ''").select("id", F.posexplode(host_suffixes(F.col("h"))).alias("depth", "domain"))
    return rows.join(small(domains.dropDuplicates(["domain"])), "domain").groupBy("id").agg(F.min_by(F.struct("domain", "subject"), F.struct("depth", "domain")).alias("m")).select("id", "m.domain", "m.subject")


def by_certification(sources: DataFrame, registry: DataFrame) -> DataFrame:
    """(id, subject) of sources whose certification text holds names of exactly one subject; the longest name counts.

    Names are looked up as substrings of the text's own runs of letters (of the lengths that names have), so that the join
    is on equal strings. Nulls match nothing.
    """
    names = registry.select(normalized(F.col("name")).alias("key"), "subject").where("length(key) >= 2").distinct()
    lengths = names.agg(F.array_sort(F.collect_set(F.length("key"))).alias("lengths"))  # bounded by the longest name
    row = lengths.collect()[0].lengths or []
    infos = sources.select("id", normalized(F.col("certification_info")).alias("info"), F.array(*map(F.lit, row)).cast("array<int>").alias("lengths")).where("info != ''")
    pieces = F.array_distinct(F.flatten(F.transform("lengths", lambda n: F.when(F.length("info") >= n, F.transform(F.sequence(F.lit(1), F.length("info") - n + 1), lambda i: F.substring(F.col("info"), i, n))).otherwise(F.array().cast("array<string>")))))
    hits = infos.select("id", F.explode(pieces).alias("key")).join(small(names), "key")
    return hits.groupBy("id").agg(F.count_distinct("subject").alias("n"), F.max_by("subject", F.length("key")).alias("subject")).where("n = 1").select("id", "subject")
