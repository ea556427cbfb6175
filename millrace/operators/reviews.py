"""Answers of reviewers joined with what they are about."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest(ledger: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key by ``order`` (a total order with the last column): an upsert of a ledger."""
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in order))
    return ledger.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert(ledger: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``ledger`` with the rows of ``updates`` in place of those of the same key."""
    return ledger.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(updates)


def merged(old: DataFrame, new: DataFrame, key: str, position: str) -> DataFrame:
    """``old`` with ``new``: rows of a key in both are the new ones in the old one's place, other new ones come after all old
    ones; place from 1, by ``position`` of the old rows and then of the new. One row a key (a page's batches)."""
    a = old.select(key, F.col(position).alias("_at"))
    mine = upsert(old, new, [key]).join(a, key, "left")
    order = Window.orderBy(F.col("_at").isNull(), F.coalesce("_at", position))  # one row a batch
    return mine.withColumn("place", F.row_number().over(order).cast("bigint")).drop("_at")


def decided(sources: DataFrame, reviews: DataFrame, automatic: str = "auto") -> DataFrame:
    """``sources`` with decision and basis: the review's where there is one, else the automatic one."""
    return sources.join(reviews.select("id", F.col("decision").alias("_r")), "id", "left").withColumns({"decision": F.coalesce("_r", automatic), "basis": F.when(F.col("_r").isNotNull(), "review").otherwise("automatic")}).drop("_r")


def missing(queue: DataFrame, reviews: DataFrame, key: str = "id") -> DataFrame:
    """What is in the queue and has no review."""
    return queue.join(reviews.select(key).distinct(), key, "left_anti")


def unknown(reviews: DataFrame, sources: DataFrame, key: str = "id") -> DataFrame:
    """Reviews of what isn't there."""
    return reviews.join(sources.select(key).distinct(), key, "left_anti")


def conflicts(decisions: DataFrame, group: str, value: str) -> DataFrame:
    """Groups whose rows have different decisions (nulls aside)."""
    return decisions.groupBy(group).agg(F.count_distinct(value).alias("n_values"), F.count(F.lit(1)).alias("n_rows")).where("n_values > 1")


def propagated(rows: DataFrame, group: str, value: str, strict: bool = False) -> DataFrame:
    """Rows with the decision of their group where it has exactly one; else their own.

    Rows without a group (null or '': texts without letters have an empty fingerprint and are no copies of each other) keep
    their own. Decisions are gathered from the decided rows alone. With ``strict``, groups with different decisions raise
    ValueError, as where a selection rests on them.
    """
    given = rows.where(F.col(group).isNotNull() & (F.col(group) != "") & F.col(value).isNotNull())
    if strict and (bad := conflicts(given, group, value).limit(5).collect()):
        raise ValueError(f"different decisions on one group: {[r[group] for r in bad]}")
    one = given.groupBy(group).agg(F.min(value).alias("_one"), F.max(value).alias("_most")).where("_one = _most").select(group, "_one")
    return rows.join(one, group, "left").withColumn(value, F.coalesce("_one", value)).drop("_one")


def keyed(payloads: DataFrame, scope: str, key: str = "source_id") -> DataFrame:
    """(key, review) of review documents in column ``value`` (JSON), whose reviews are a list of objects with the key or a map
    from key to object; ``review`` is the object as text. Documents of another scope raise ValueError, as do empty keys and
    repeated ones."""
    doc = payloads.select(F.get_json_object("value", "$.scope").alias("scope"), F.get_json_object("value", "$.reviews").alias("r"))
    if doc.where(~F.coalesce(F.col("scope") == scope, F.lit(False))).limit(1).count():
        raise ValueError(f"a review document isn't of the scope {scope}")
    is_list = F.col("r").startswith("[")
    items = doc.where(is_list).select(F.explode(F.from_json("r", "array<string>")).alias("review")).select(F.get_json_object("review", f"$.{key}").alias("key"), "review")
    named = doc.where(~is_list).select(F.explode(F.from_json("r", "map<string,string>")).alias("key", "review"))
    out = items.unionByName(named).withColumn("key", F.trim(F.coalesce("key", F.lit(""))))
    if out.groupBy("key").count().where("key = '' or count > 1").limit(1).count():
        raise ValueError("a review document has empty or repeated keys")
    return out


def flattened(overrides: DataFrame) -> DataFrame:
    """(source_id, override) of documents in column ``value``: a map from source to override (an object with a cluster), or
    such maps by batch. ``override`` is the object as text; what is neither is left out."""
    outer = overrides.select(F.explode(F.from_json(F.get_json_object("value", "$.overrides"), "map<string,string>")).alias("k", "v")).where(F.col("v").startswith("{"))
    flat = F.get_json_object("v", "$.cluster").isNotNull()
    inner = outer.where(~flat).select(F.explode(F.from_json("v", "map<string,string>")).alias("k", "v")).where(F.col("v").startswith("{"))
    return outer.where(flat).unionByName(inner).select(F.trim("k").alias("source_id"), F.col("v").alias("override"))


def expanded(answers: DataFrame, items: DataFrame, binding: str) -> DataFrame:
    """Answers of few words with what their item knows: (id, decision, reason), the decision as answered.

    Only an answer bound to the current items (column binding) is filled in: a missing reason of an exclusion that agrees
    with the automatic decision is the automatic reason. ``items`` has id, auto_decision, auto_reason.
    """
    joined = answers.join(items.select("id", "auto_decision", "auto_reason"), "id", "left")
    agrees = F.coalesce((F.col("binding") == binding) & (F.col("decision") == "exclude") & (F.col("auto_decision") == "exclude"), F.lit(False))
    reason = F.coalesce("reason", F.lit(""))
    return joined.select("id", "decision", F.when(agrees & (F.trim(reason) == ""), F.coalesce("auto_reason", F.lit(""))).otherwise(reason).alias("reason"))


def template(queue: DataFrame, answered: DataFrame, columns: dict[str, str], key: str = "id") -> DataFrame:
    """What is still to be answered, with empty columns (name -> default) for the answers."""
    return missing(queue, answered, key).withColumns({c: F.lit(v) for c, v in columns.items()})


def next_chunk(chunks: DataFrame, pending: DataFrame, group: str) -> DataFrame:
    """(group, chunk_no, n_pending): of each group the first chunk with something pending. ``chunks`` has id, chunk_no."""
    n = chunks.join(pending.select("id").distinct(), "id", "left_semi").groupBy(group, "chunk_no").agg(F.count(F.lit(1)).alias("n"))
    first = n.groupBy(group).agg(F.min_by(F.struct("chunk_no", "n"), "chunk_no").alias("c"))
    return first.select(group, "c.chunk_no", F.col("c.n").alias("n_pending"))


def key_violations(reviews: DataFrame, key: str, allowed: dict[str, list[str]]) -> DataFrame:
    """(key, issue): empty and repeated keys and values outside of the allowed ones; empty if the reviews are sound."""
    k = F.col(key).cast("string")
    parts = [reviews.where(k.isNull() | (k == "")).select(F.coalesce(k, F.lit("")).alias("key"), F.lit("empty key").alias("issue")), reviews.where(k.isNotNull()).groupBy(k.alias("key")).count().where("count > 1").select("key", F.lit("repeated key").alias("issue"))]
    parts += [reviews.where(F.col(c).isNull() | ~F.col(c).cast("string").isin(v)).select(k.alias("key"), F.lit(f"bad {c}").alias("issue")) for c, v in allowed.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
