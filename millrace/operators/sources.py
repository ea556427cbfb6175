"""Rows of sources: composition of their text, periods, channels and topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import clean, hashtags, iso_timestamp, normalized
from millrace.plans.lineage import once, small

#: Post types whose title isn't part of their own text.
ANSWERS = ("评论", "转帖")
#: The channels, looked for in this order in a file's and sheet's name, and then other words for two of them.
CHANNELS = ("境内新闻", "公众文章", "今日头条", "微博", "小红书", "抖音")
OTHER_WORDS = (("公号", "公众文章"), ("微信", "公众文章"), ("新闻", "境内新闻"))


def with_text(df: DataFrame, fingerprint: bool = False) -> DataFrame:
    """``df`` with its title cleaned and text: body, else ASR, else title; before it the title, unless it is an answer or
    holds the title already. Each part is cleaned once. With ``fingerprint`` that column too, the normalised text, put
    together from the parts, which are then normalised once."""
    body, asr = (F.nullif(clean(F.col(c)), F.lit("")) for c in ("body", "asr"))
    parts = once(df, _own=F.coalesce(body, asr, F.lit("")), _title=clean(F.col("title")))
    own, title = F.when(F.col("_own") == "", F.col("_title")).otherwise(F.col("_own")), F.col("_title")
    norm_own, norm_title = normalized(own), normalized(title)
    if fingerprint:
        parts = once(parts, _norm_own=norm_own, _norm_title=norm_title)
        norm_own, norm_title = F.col("_norm_own"), F.col("_norm_title")
    plain = F.coalesce(F.col("post_type"), F.lit("")).isin(*ANSWERS) | (title == "") | F.contains(norm_own, norm_title)
    more = {"_fingerprint": F.when(plain, norm_own).otherwise(F.concat(norm_title, norm_own))} if fingerprint else {}
    made = once(parts, _text=F.when(plain, own).otherwise(F.concat(title, F.lit(" "), own)), **more).withColumns({"title": title, "text": F.col("_text")})
    return (made.withColumn("fingerprint", F.col("_fingerprint")) if fingerprint else made).drop("_own", "_title", "_text", "_norm_own", "_norm_title", "_fingerprint")


def channel_of(name: Column, strict: bool = False) -> Column:
    """The channel by the names and words that stand in a file's name; where none does null, or with ``strict`` an error."""
    words = [*zip(CHANNELS, CHANNELS, strict=True), *OTHER_WORDS]
    found = [F.when(F.contains(name, F.lit(word)), F.lit(channel)) for word, channel in words]
    unknown = F.raise_error(F.concat(F.lit("no channel in the name "), name)).cast("string") if strict else F.lit(None).cast("string")
    return F.coalesce(*found, unknown)


def file_period(name: Column) -> list[Column]:
    """[start, end] that a file's name tells: dates with hours and minutes, or dates alone; null where it has none."""
    long = r"(\d{4})\.(\d{2})\.(\d{2}) (\d{2})_(\d{2})至(\d{4})\.(\d{2})\.(\d{2}) (\d{2})_(\d{2})"
    short = r"(\d{4})[.-](\d{2})[.-](\d{2})至(\d{4})[.-](\d{2})[.-](\d{2})"
    g = lambda p, k: F.regexp_extract(name, p, k)
    at = lambda p, k, rest: F.concat(g(p, k), F.lit("-"), g(p, k + 1), F.lit("-"), g(p, k + 2), F.lit(" "), rest).try_cast("timestamp_ntz")
    clock = lambda k, s: F.concat(g(long, k), F.lit(":"), g(long, k + 1), F.lit(s))
    start = F.when(name.rlike(long), at(long, 1, clock(4, ":00"))).otherwise(at(short, 1, F.lit("00:00:00")))
    end = F.when(name.rlike(long), at(long, 6, clock(9, ":59"))).otherwise(at(short, 4, F.lit("23:59:59")))
    return [start, end]


def boundary(c: Column, end: bool = False) -> Column:
    """A boundary of a period; a date alone as an end means that day's last microsecond."""
    t = iso_timestamp(c)
    return F.when(clean(c).rlike(r"^\d{4}[-/]\d{2}[-/]\d{2}$"), t + F.expr("INTERVAL '0 23:59:59.999999' DAY TO SECOND")).otherwise(t) if end else t


def with_period_state(sources: DataFrame, windows: DataFrame) -> DataFrame:
    """``sources`` with period_state: in_period, out_of_period (the interval is closed) or unconfigured.

    ``windows`` has batch, period_start, period_end, one row a batch, and is broadcast if it is small. A batch without
    window takes the period from the file's name. Where start, end or time are unreadable the row is unconfigured.
    """
    w = windows.select("batch", boundary(F.col("period_start")).alias("_s"), boundary(F.col("period_end"), end=True).alias("_e"), F.lit(True).alias("_w"))
    s, e = file_period(F.col("source_file"))
    joined = sources.join(small(w), "batch", "left").withColumns({"_s": F.when(F.col("_w"), F.col("_s")).otherwise(s), "_e": F.when(F.col("_w"), F.col("_e")).otherwise(e), "_t": iso_timestamp(F.col("published"))})
    state = F.when(F.col("_s").isNull() | F.col("_e").isNull() | F.col("_t").isNull(), "unconfigured").when(F.col("_t").between(F.col("_s"), F.col("_e")), "in_period").otherwise("out_of_period")
    return joined.withColumn("period_state", state).drop("_s", "_e", "_t", "_w")


def derived_topics(sources: DataFrame, batches: DataFrame, most: int = 40) -> DataFrame:
    """(batch, term, n_supporting, n_sources, basis, rank): topics of a batch's sources that aren't its strong terms.

    ``sources`` has id, batch, text. A topic needs two sources with a strong term of the batch, or three sources; the first
    ``most`` of each batch by basis, both counts, length and term. Counting is by (batch, term), pre-aggregated.
    """
    cfg = batches.select("batch", F.transform(F.filter("strong_terms", lambda t: F.length(t) >= 2), normalized).alias("_anchors"), F.col("strong_terms").alias("_strong"))
    rows = sources.join(small(cfg), "batch").select("id", "batch", F.exists("_strong", lambda t: (F.length(t) >= 2) & F.contains(F.col("text"), t)).alias("strong"), "_anchors", F.explode(F.array_distinct(hashtags(F.col("text")))).alias("term"))
    compact = normalized(F.col("term"))
    rows = rows.where(F.length(compact).between(4, 36) & ~F.exists("_anchors", lambda a: F.contains(compact, a) | F.contains(a, compact)))
    counted = rows.groupBy("batch", "term").agg(F.count_distinct(F.when(F.col("strong"), F.col("id"))).alias("n_supporting"), F.count_distinct("id").alias("n_sources")).where("n_supporting >= 2 or n_sources >= 3")
    counted = counted.withColumn("basis", F.when(F.col("n_supporting") >= 2, "cooccurrence").otherwise("recurrent"))
    order = Window.partitionBy("batch").orderBy((F.col("basis") == "cooccurrence").desc(), F.desc("n_supporting"), F.desc("n_sources"), F.length(normalized(F.col("term"))).desc(), F.desc("term"))
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
