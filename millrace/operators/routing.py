"""Routing of sources to clusters, ranking and sampling."""

from __future__ import annotations

from collections import Counter
from heapq import nlargest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.plans.lineage import small

#: Sources and share of its batch from which on a cluster is too broad.
BROAD_ROWS, BROAD_SHARE = 80, 0.25


def routed(sources: DataFrame, definitions: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ranking, array of (score, def_idx, cluster): each source's clusters of its batch, best first, ties to the
    earlier definition. A score is the sum of weighted keyword counts: of each up to three in the text, two in the title.

    ``sources`` has id, batch, title, text; ``definitions`` batch, cluster, def_idx, keywords: array<struct<term, weight>>, a
    few rows a batch, which become one row a batch; so a source's clusters are ranked within its row, without a shuffle.
    Sources of a batch without definitions are left out.
    """
    d = small(definitions.groupBy("batch").agg(F.collect_list(F.struct("def_idx", "cluster", "keywords")).alias("_defs")))  # bounded: one batch's definitions
    count = lambda t, w: F.when(F.length(w) > 0, F.try_divide(F.length(t) - F.length(F.replace(t, w, F.lit(""))), F.length(w))).otherwise(0)
    one = lambda k: k.weight * (F.least(F.lit(3.0), count(F.col("text"), k.term)) + F.least(F.lit(2.0), count(F.col("title"), k.term)))
    score = lambda c: F.aggregate(c.keywords, F.lit(0.0), lambda acc, k: acc + one(k))
    ranking = F.array_sort(F.transform("_defs", lambda c: F.struct((-score(c)).alias("s"), c.def_idx.alias("def_idx"), c.cluster.alias("cluster"))))
    return sources.join(d, "batch").select(*keep, F.transform(ranking, lambda x: F.struct((-x.s).alias("score"), x.def_idx.alias("def_idx"), x.cluster.alias("cluster"))).alias("ranking"))


def keyword_scores(sources: DataFrame, definitions: DataFrame) -> DataFrame:
    """(id, score, def_idx, cluster): the score of each source for each cluster of its batch."""
    return routed(sources, definitions, ["id"]).select("id", F.inline("ranking"))


def with_best(ranked: DataFrame) -> DataFrame:
    """``ranked`` with cluster, score and margin, the distance to the best other cluster, in place of its ranking."""
    top = F.col("ranking")[0]
    margin = top.score - F.coalesce(F.get("ranking", F.lit(1)).score, F.lit(0.0))
    return ranked.where(F.size("ranking") > 0).select(*(c for c in ranked.columns if c != "ranking"), top.cluster.alias("cluster"), top.score.alias("score"), margin.alias("margin"))


def with_overrides(assigned: DataFrame, overrides: DataFrame) -> DataFrame:
    """``assigned`` (with id, cluster) with the override's cluster where there is one, and basis; overrides to no cluster
    (null) exclude the source: its cluster is null and its basis 'excluded'. ``overrides`` has id, cluster, one row a source."""
    o = overrides.select("id", F.col("cluster").alias("_to"), F.lit(True).alias("_o"))
    j = assigned.join(o, "id", "left")
    basis = F.when(F.col("_o").isNull(), "automatic").when(F.col("_to").isNull(), "excluded").otherwise("override")
    return j.withColumns({"basis": basis, "cluster": F.when(F.col("_o").isNull(), F.col("cluster")).otherwise(F.col("_to"))}).drop("_to", "_o")


def with_secondary(ranked: DataFrame, share: float = 0.5) -> DataFrame:
    """(id, cluster, role): each source's best cluster, and its second one if that has a score above 0 and at least ``share``
    of the best one's. ``ranked`` has id, ranking (see routed); a source without any score has its primary cluster only."""
    best, second = F.col("ranking")[0], F.get("ranking", F.lit(1))
    role = lambda c, name: F.struct(c.cluster.alias("cluster"), F.lit(name).alias("role"))
    both = F.when(F.coalesce((second.score > 0) & (second.score >= share * best.score), F.lit(False)), F.array(role(best, "primary"), role(second, "secondary"))).otherwise(F.array(role(best, "primary")))
    return ranked.where(F.size("ranking") > 0).select("id", F.inline(both))


def from_cache(sources: DataFrame, cache: DataFrame, version: int) -> DataFrame:
    """(id, hit): whether a source's routing can be taken from the cache: same row and same definitions by their fingerprints,
    and of this version. ``sources`` has id, row_print, contract; ``cache`` these and cache_version."""
    good = cache.where((F.col("cache_version") == version) & (F.coalesce("id", F.lit("")) != "")).select("id", "row_print", "contract", F.lit(True).alias("_hit")).distinct()
    return sources.select("id", "row_print", "contract").join(good, ["id", "row_print", "contract"], "left").select("id", F.coalesce("_hit", F.lit(False)).alias("hit"))


def display_coverage(assigned: DataFrame, dropped: DataFrame, *group: str) -> DataFrame:
    """(group, n_assigned, n_kept, n_dropped): what of each cluster is shown. ``dropped`` has id."""
    d = dropped.select("id", F.lit(1).alias("_d")).distinct()
    n, gone = F.count(F.lit(1)), F.count("_d")
    return assigned.join(d, "id", "left").groupBy(*group).agg(n.alias("n_assigned"), (n - gone).alias("n_kept"), gone.alias("n_dropped"))


def top_k(scores: DataFrame, group: str, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each group, with their place (a top-k report)."""
    return scores.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= k)


def round_robin(df: DataFrame, channel: str, limit: int, *order: Column) -> DataFrame:
    """The first ``limit`` rows of a round robin over channels: a row's round is its place in its channel.

    Each channel gives at most ``limit`` rows, so that the final order is over few rows.
    """
    w = Window.partitionBy(channel).orderBy(*order)
    few = df.withColumn("round", F.row_number().over(w)).where(F.col("round") <= limit)
    return few.orderBy("round", channel).limit(limit)


def quotas(sizes: dict[str, int], limit: int, floor: int = 20) -> dict[str, int]:
    """How many rows of each stratum: ``floor`` of each where there are so many, then one by one to the stratum with most
    of sqrt(size) / (quota + 1), ties to the last name."""
    base = {k: min(n, floor) for k, n in sizes.items()}
    left = max(0, limit - sum(base.values()))
    # what a stratum offers falls with each row it gives, so that the largest offers of all are the rows taken one by one
    offers = ((n**0.5 / (k + 1), name) for name, n in sizes.items() for k in range(base[name], min(n, base[name] + left)))
    taken = Counter(name for _, name in nlargest(left, offers))
    return {k: n + taken[k] for k, n in base.items()}


def stratified(df: DataFrame, group: str, stratum: str, limit: int, floor: int, *order: Column) -> DataFrame:
    """A sample of each group by quotas of its strata, the first rows of each stratum in ``order``. Groups of up to ``limit``
    rows come whole. Quotas come from the counts, a few rows for each group."""
    counts = df.groupBy(group, F.coalesce(stratum, F.lit("")).alias("stratum")).count()

    def plan(pdf):
        import pandas as pd

        sizes = dict(zip(pdf["stratum"], pdf["count"], strict=True))
        q = {k: int(n) for k, n in sizes.items()} if sum(sizes.values()) <= limit else quotas({k: int(n) for k, n in sizes.items()}, limit, floor)
        return pd.DataFrame({group: pdf[group], "stratum": pdf["stratum"], "quota": [q[k] for k in pdf["stratum"]]})

    planned = counts.groupBy(group).applyInPandas(plan, f"{group} {df.schema[group].dataType.simpleString()}, stratum string, quota long")
    ranked = df.withColumn("stratum", F.coalesce(stratum, F.lit(""))).withColumn("place", F.row_number().over(Window.partitionBy(group, "stratum").orderBy(*order)))
    return ranked.join(small(planned), [group, "stratum"]).where("place <= quota").drop("quota")


def profile(assigned: DataFrame) -> DataFrame:
    """(batch, cluster, n_sources, n_authors, max_author, share_of_batch, too_broad): sizes of clusters and of their greatest
    author; too broad is what holds BROAD_ROWS sources and BROAD_SHARE of its batch."""
    by_author = assigned.groupBy("batch", "cluster", F.coalesce("author", F.lit("")).alias("author")).agg(F.count(F.lit(1)).alias("n"))
    c = by_author.groupBy("batch", "cluster").agg(F.sum("n").alias("n_sources"), F.count_if(F.col("author") != "").alias("n_authors"), F.max(F.when(F.col("author") != "", F.col("n"))).alias("max_author"))
    share = F.col("n_sources") / F.sum("n_sources").over(Window.partitionBy("batch"))  # one row a cluster
    return c.withColumn("share_of_batch", share).withColumn("too_broad", (F.col("n_sources") >= BROAD_ROWS) & (F.col("share_of_batch") >= BROAD_SHARE))


def facet_coverage(df: DataFrame, *order: Column) -> DataFrame:
    """The rows that are best for one of (channel, facet): ``df`` has id, channel, facets; each row once."""
    best = df.select("*", F.explode("facets").alias("facet")).withColumn("_n", F.row_number().over(Window.partitionBy("channel", "facet").orderBy(*order))).where("_n = 1")
    return best.groupBy("id", "channel").agg(F.array_join(F.array_sort(F.collect_list("facet")), ",").alias("covers"))  # bounded: a row's facets
