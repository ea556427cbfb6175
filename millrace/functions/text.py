"""Scalar text functions as Column -> Column, all native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.fields import NULL_TOKENS

# Default lexicons, each a pattern that any caller can replace by its own.
POSITIVE = "出彩|惊喜|细腻|精彩|自然|扎实|用心|干净利落|有分寸|余味悠长|经得起细看|well judged|tender|confident|precise"
NEGATIVE = "拖沓|单薄|仓促|出戏|悬浮|失误|浪费|不够可信|前后不搭|过于用力|overwritten|too thin|rushed|flat in the middle"
HUMOUR, COMPLAINT = "哈哈|笑死|笑疯|有梗|可爱", "批评|质疑|问题|尴尬|难看|出戏|拖沓|悬浮|劝退|用力过猛"
CONTRAST = "但是|不过|然而|可是|尽管|但| but "
PROMOTION = "扫码|关注|下载|点个|转发|抽奖|优惠|包邮"
#: Upper ends of the length bands and the score of each band, the last for all longer texts.
LENGTH_BANDS = ((20, -5.0), (50, -3.0), (100, -1.5), (200, 0.0), (300, 1.0), (600, 2.0), (1000, 3.0))
LONGEST_SCORE = 4.0
HASHTAG = r"#([^#\n\r]{2,40})#"


def clean(c: Column) -> Column:
    """Blanks of any kind collapsed and trimmed; null and null tokens become ''."""
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))
    return F.when(t.isin(*NULL_TOKENS), "").otherwise(t)


def normalized(c: Column) -> Column:
    """Ideographs, Latin letters and digits only, in lower case; null becomes ''."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^一-鿿A-Za-z0-9]+", ""))


def stable_id(*parts: Column) -> Column:
    """The first 16 hex digits of the SHA-256 of the parts, joined by |."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)


def host(c: Column) -> Column:
    """Lower-case host of a URL, without a leading www. and trailing dots; '' where there is none."""
    h = F.lower(F.regexp_extract(clean(c), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(F.regexp_replace(h, r"\.+$", ""), r"^www\.", "")


def safe_url(c: Column, blocked: str | None = None) -> Column:
    """The URL if it is http(s), has a host and the host isn't (under) the blocked one; else ''."""
    u, h = clean(c), host(c)
    bad = ~u.rlike("^https?://") | (h == "")
    if blocked:
        bad = bad | (h == blocked) | h.endswith("." + blocked)
    return F.when(bad, "").otherwise(u)


def polarity(c: Column, positive: str = POSITIVE, negative: str = NEGATIVE, contrast: str = CONTRAST) -> Column:
    """positive, negative or neutral: by what follows the last word of contrast, else by the whole text."""
    tail = F.element_at(F.split(c, contrast), -1)
    count = lambda t, p: F.regexp_count(t, F.lit(p))
    tp, tn, p, n = count(tail, positive), count(tail, negative), count(c, positive), count(c, negative)
    return F.when(tp > tn, "positive").when(tn > tp, "negative").when(p > n, "positive").when(n > p, "negative").otherwise("neutral")


def stance(c: Column, humour: str, complaint: str, **lexicon: str) -> Column:
    """The polarity of a text, where laughter (a pattern) without a complaint (a pattern) is positive whatever else it says."""
    return F.when(c.rlike(humour) & ~c.rlike(complaint), "positive").otherwise(polarity(c, **lexicon))


def supports(expected: Column, evidence: Column) -> Column:
    """Whether a piece of evidence is worded as the expected stance (positive, negative, objective) would be."""
    p = polarity(clean(evidence))
    return F.coalesce(F.when(expected == "objective", p == "neutral").when(expected.isin("positive", "negative"), p == expected), F.lit(False))


def conflicts(expected: Column, evidence: Column) -> Column:
    """Whether a piece of evidence is worded as the contrary of the expected stance; an unknown stance conflicts with all."""
    p = polarity(clean(evidence))
    against = F.when(expected == "positive", p == "negative").when(expected == "negative", p == "positive").when(expected == "objective", p != "neutral")
    return F.coalesce(against, F.lit(True))


def stands_alone(c: Column) -> Column:
    """Whether a text has an opinion of its own and no call to act, which would make it an advertisement."""
    t = clean(c)
    return ~t.rlike(PROMOTION) & t.rlike(f"{POSITIVE}|{NEGATIVE}")


# Facts of a schedule that a passage can evidence; every passage evidences the first.
FACETS = (
    ("schedule_announcement", ""), ("airing_date", r"\d{1,2}月\d{1,2}日|\d{4}[-/.年]\d{1,2}[-/.月]\d{1,2}"), ("airing_time", r"\d{1,2}[：:]\d{2}|晚间|黄金档"),
    ("airing_platform", "腾讯视频|爱奇艺|优酷|芒果TV|CCTV-?\\d+|央视|卫视|双平台|多平台"), ("update_cadence", "每日|每周[一二三四五六日天]|日更|连更|首更|更新\\d+集|会员|VIP"),
)


def fact_facets(c: Column) -> Column:
    """Which facts of a schedule a passage tells, in the order of FACETS."""
    t = clean(c)
    return F.array_compact(F.array(*(F.when(t.rlike(f"(?i){p}"), F.lit(n)) for n, p in FACETS)))


def capped_sum(base: Column, *terms: tuple[Column, float, float]) -> Column:
    """A score: ``base`` and for each (count, weight, cap) count x weight, no further from 0 than the cap."""
    for count, weight, cap in terms:
        base = base + (F.least(F.lit(cap), count * weight) if weight > 0 else F.greatest(F.lit(-cap), count * weight))
    return base


def length_score(n: Column) -> Column:
    """Score of a length by its band."""
    score = None
    for end, value in LENGTH_BANDS:
        score = F.when(n < end, value) if score is None else score.when(n < end, value)
    return score.otherwise(LONGEST_SCORE)


def term_hits(text: Column, terms: Column) -> Column:
    """Terms of two characters and more that stand in the text, in the terms' order; null terms are none."""
    return F.filter(F.coalesce(terms, F.array().cast("array<string>")), lambda t: (F.length(t) >= 2) & F.contains(text, t))


def grams(c: Column) -> Column:
    """The set of runs of three characters of a normalised text."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?=(...))"), F.lit(1)))


def hashtags(c: Column) -> Column:
    """Topics between # signs, cleaned, in order, with repetitions."""
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(HASHTAG), F.lit(1)), clean)


def iso_timestamp(c: Column) -> Column:
    """A zone-less timestamp of an ISO text (also with /), null where it is none."""
    t = F.regexp_replace(clean(c), "/", "-")
    t = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"), t)
    return t.try_cast("timestamp_ntz")


def merged_spans(text: Column, terms: Column) -> Column:
    """Places of the terms in the text, overlapping ones merged: array of (start, end), from 0, half-open.

    Every occurrence counts, also overlapping ones of one term. One fold over the sorted places.
    """
    def places(term: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.length(text) - F.length(term), F.lit(0))), lambda i: F.substring(text, i + 1, F.length(term)) == term)
        return F.transform(starts, lambda i: F.struct(i.alias("a"), (i + F.length(term)).alias("b")))

    every = F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(terms, lambda t: F.length(t) > 0), places))))
    kind = "array<struct<a:int,b:int>>"

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last.a.alias("a"), F.greatest(last.b, x.b).alias("b"))))
        return F.when((F.size(acc) > 0) & (x.a < last.b), joined).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(every.cast(kind), F.array().cast(kind), step)
