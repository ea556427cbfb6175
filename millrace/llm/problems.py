"""Queries of the problems on texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.fields import aliases
from millrace.llm import lines, lookalikes, mixing, quality, sentences, severity, stuffing, tokens
from millrace.operators.instants import raw_field
from millrace.plans.lineage import written
from millrace.sources.tables import table


def titles_and_bodies(spark: SparkSession, d: str, once: bool = False) -> DataFrame:
    """(tab, id, channel, text): titles of records and bodies of normalized_sources, all rows. With ``once`` the titles, which
    are a small part of their JSON objects, are written to the shared folder for several uses."""
    one = raw_field(table(spark, d, "records"), aliases(spark, d), "title", ["id", "channel"], as_name="text")
    one = written(one) if once else one
    two = table(spark, d, "normalized_sources").select("id", "channel", F.col("body").alias("text"))
    return one.select(F.lit("records").alias("tab"), "*").unionByName(two.select(F.lit("normalized_sources").alias("tab"), "*"))


def p1_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every title and body with its severity."""
    texts = titles_and_bodies(spark, d, once=True)
    return severity.scored(texts, table(spark, d, "review_labels"), ["tab", "id", "channel"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_scores(spark, d).where("found").select("tab", "id")


def p1_rates(spark: SparkSession, d: str) -> DataFrame:
    """Found texts and their share by channel; texts without channel are one group of their own."""
    return p1_scores(spark, d).groupBy("tab", "channel").agg(F.count("severity").alias("n_texts"), F.count_if("found").alias("n_found"), severity.rate().alias("rate"), F.avg("severity").alias("mean_severity"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return lines.repeated_places(table(spark, d, "normalized_sources"), "id", "channel", "body")


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every body without its channel's repeated lines."""
    return lines.without_repeated(table(spark, d, "normalized_sources"), "id", "channel", "body", ["id"])


def bodies_and_asr(spark: SparkSession, d: str) -> DataFrame:
    """(tab, id, field_name, text): bodies of normalized_sources and ASR of records, all rows."""
    one = raw_field(table(spark, d, "records"), aliases(spark, d), "asr", ["id"], as_name="text").select(F.lit("records").alias("tab"), "id", F.lit("asr").alias("field_name"), "text")
    two = table(spark, d, "normalized_sources").select(F.lit("normalized_sources").alias("tab"), "id", F.lit("body").alias("field_name"), F.col("body").alias("text"))
    return one.unionByName(two)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "sentence_sample").select("tab", F.col("source_id").alias("id"), "field_name").distinct()
    ids = asked.select("id").distinct()
    # rows that aren't asked for leave before their texts are read out of the JSON objects
    rows = table(spark, d, "records").join(ids, "id", "left_semi")
    asr = raw_field(rows, aliases(spark, d), "asr", ["id"], as_name="asr")
    body = raw_field(rows, aliases(spark, d), "body", ["id"], as_name="body")
    own = table(spark, d, "normalized_sources").join(ids, "id", "left_semi")
    texts = None
    for tab, df, field, column in (("records", asr, "asr", "asr"), ("records", body, "body", "body"), ("normalized_sources", own, "body", "body"), ("normalized_sources", own, "asr", "asr")):
        part = df.select(F.lit(tab).alias("tab"), "id", F.lit(field).alias("field_name"), F.col(column).alias("text")).join(asked, ["tab", "id", "field_name"], "left_semi")
        texts = part if texts is None else texts.unionByName(part)
    return sentences.units(texts, "text", ["tab", "id"]).select("tab", "id", "end_pos").distinct()


def p5_units(spark: SparkSession, d: str) -> DataFrame:
    """Sentence units of every body and every ASR."""
    return sentences.units(bodies_and_asr(spark, d), "text", ["tab", "id", "field_name"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.alike_pairs(lookalikes.form_keys(titles_and_bodies(spark, d), "text", ["tab", "id"]))


def p6_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every title and body that has anything visible, with the class of those that look like it and its number of links."""
    return lookalikes.alike_classes(lookalikes.form_keys(titles_and_bodies(spark, d), "text", ["tab", "id"]))


def p6_forms(spark: SparkSession, d: str) -> DataFrame:
    """Every title and body in its one form."""
    return lookalikes.with_form(titles_and_bodies(spark, d), "text", ["tab", "id"])


def p7_rates(spark: SparkSession, d: str) -> DataFrame:
    return stuffing.redundancy(p3_clean(spark, d), "id", "body")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_rates(spark, d).where(stuffing.is_stuffed()).select("id")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_ids(table(spark, d, "documents"), "doc_id", "text")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(spark, table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(spark, table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.no_prose(table(spark, d, "documents"), "doc_id", "text")


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The statistics of every document; null for a null text."""
    return quality.with_statistics(table(spark, d, "documents"), "text", ["doc_id"])


QUERIES = {f.__name__: f for f in (p1_found, p1_scores, p1_rates, p3_found, p3_clean, p5_found, p5_units, p6_found, p6_classes, p6_forms, p7_found, p7_rates, p8_ids, p9_mixture, p9_shares, p10_found, p10_statistics)}
