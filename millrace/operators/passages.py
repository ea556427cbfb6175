"""Passages for display and review: cleaned excerpts, windows of sentences, packed segments, varied samples."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import PROMOTION, clean, grams, normalized
from millrace.operators.evidence import with_span_lists
from millrace.plans.lineage import cut, once, small, written
from millrace.plans.ranking import first_of, ranked

# Entities that exports leave in texts, and what each stands for.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))
#: Markup that carries no opinion, in the order in which it is taken out, each left as a blank.
MARKUP = (
    ("link", r"!?\[[^\[\]]{0,80}\]\(https?://[^()\s]*\)"), ("address", r"(?:https?://|www\.)[A-Za-z0-9._~/?#@!$&*+;=%:-]+"), ("topic", r"#[^#\s][^#\n]{0,38}#"), ("tag", r"#[^\s#]{1,30}"),
    ("emote", r"\[[一-鿿A-Za-z0-9]{1,6}\]"), ("mention", r"@[一-鿿A-Za-z0-9_-]{1,20}"), ("fold", "网页链接|共创视频|展开全文|收起全文"), ("sign", r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}]"),
)
_HIDDEN = r"[\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}\x{FEFF}\x{FE0F}]"
_EDGE = " /|｜·•←→，,；;：:"
_PIECES = r"[^，。！？；：,.!?;:]*[，。！？；：,.!?;:]|[^，。！？；：,.!?;:]+$"


#: Signs that HTML gives a name, & first.
HTML_SIGNS = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;"))


def display(c: Column) -> Column:
    """An excerpt without markup: entities, links, topics, emotes, mentions, folds, signs, hidden characters, blanks before
    punctuation and separators at the ends. Null becomes ''."""
    t = reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES, clean(c))
    t = reduce(lambda x, m: F.regexp_replace(x, m[1], " "), MARKUP, t)
    t = F.regexp_replace(F.regexp_replace(t, _HIDDEN, ""), r"\s+", " ")
    t = F.regexp_replace(t, r" ([，。！？；：、,.!?;:])", "$1")
    return F.btrim(t, F.lit(_EDGE))


def has_markup(c: Column) -> Column:
    """Whether an excerpt still has any of the markup."""
    return F.coalesce(c, F.lit("")).rlike("|".join(f"(?:{p})" for _, p in MARKUP))


def first_pattern(c: Column, patterns: list[tuple[str, str]]) -> Column:
    """struct(label, found) of the first pattern that stands in the text; both '' if none does."""
    out = F.struct(F.lit("").alias("label"), F.lit("").alias("found"))
    for label, p in reversed(patterns):
        out = F.when(c.rlike(p), F.struct(F.lit(label).alias("label"), F.regexp_extract(c, p, 0).alias("found"))).otherwise(out)
    return out


def reason_fingerprint(c: Column) -> Column:
    """A reason with quotations, long hexadecimal ids and numbers set aside, so that template reasons are the same."""
    t = F.regexp_replace(F.lower(clean(c)), "“[^”]*”|\"[^\"]*\"|‘[^’]*’", "<q>")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\b[0-9a-f]{12,}\b", "<id>"), r"[0-9]+", "#"), r"\s+", "")


def packed(c: Column, most: int = 58) -> Column:
    """Segments of a text that give it again when joined: pieces between punctuation, packed up to ``most`` characters.

    One fold over the pieces: a segment is closed when the next piece would make it too long and it has eight letters; a
    rest of less than six letters joins the segment before.
    """
    pieces = F.regexp_extract_all(c, F.lit(_PIECES), F.lit(0))
    letters = lambda x: F.length(normalized(x))
    none = F.array().cast("array<string>")

    def step(acc: Column, piece: Column) -> Column:
        close = (acc.open != "") & (F.length(acc.open) + F.length(piece) > most) & (letters(acc.open) >= 8)
        return F.struct(F.when(close, F.concat(acc.done, F.array(acc.open))).otherwise(acc.done).alias("done"), F.when(close, piece).otherwise(F.concat(acc.open, piece)).alias("open"))

    def finish(acc: Column) -> Column:
        n = F.size(acc.done)
        joined = F.concat(F.slice(acc.done, F.lit(1), F.greatest(n - 1, F.lit(0))), F.array(F.concat(F.try_element_at(acc.done, F.lit(-1)), acc.open)))
        return F.when(acc.open == "", acc.done).when((n > 0) & (letters(acc.open) < 6), joined).otherwise(F.concat(acc.done, F.array(acc.open)))

    return F.aggregate(pieces, F.struct(none.alias("done"), F.lit("").alias("open")), step, finish)


def segments(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep``, segment_no (from 1) and segment of each text; joined they are the text. Null and empty texts have none."""
    return df.select(*keep, F.posexplode(packed(F.col(text))).alias("_n", "segment")).select(*keep, (F.col("_n") + 1).alias("segment_no"), "segment")


def windows(df: DataFrame, most: int = 3) -> DataFrame:
    """(id, batch, start, end, fragment): every run of one to ``most`` consecutive sentence spans. ``df`` has id, batch, text."""
    spans = with_span_lists(df, "text", ["id", "batch", "text"])
    n = F.size("spans")
    each = F.flatten(F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.transform(F.sequence(i, F.least(i + most, n) - 1), lambda j: F.struct(F.get("spans", i)["start"].alias("start"), F.get("spans", j)["end"].alias("end")))))
    return spans.select("id", "batch", "text", F.inline(each)).select("id", "batch", "start", "end", F.expr("substring(text, start + 1, end - start)").alias("fragment"))


def best_windows(df: DataFrame, batches: DataFrame, opinion: str, most: int = 2) -> DataFrame:
    """(id, start, end, score): of each source the window with the highest score, ties to the earlier and shorter.

    A window gains 20 for each strong and 8 for each weak term of its batch and 3 for each word of opinion.
    """
    hits = lambda terms: F.size(F.filter(F.coalesce(terms, F.array().cast("array<string>")), lambda t: (F.length(t) >= 2) & F.contains(F.col("fragment"), t)))
    w = windows(df, most).join(small(batches.select("batch", "strong_terms", "weak_terms")), "batch")
    scored = w.select("id", "start", "end", (hits(F.col("strong_terms")) * 20 + hits(F.col("weak_terms")) * 8 + F.regexp_count("fragment", F.lit(opinion)) * 3).alias("score"))
    return scored.groupBy("id").agg(F.max_by(F.struct("start", "end", "score"), F.struct("score", -F.col("start"), -F.col("end"))).alias("w")).select("id", "w.start", "w.end", "w.score")


def not_contained(candidates: DataFrame, most: int = 3) -> DataFrame:
    """The best ``most`` windows of each source that don't lie in a better one. ``candidates`` has id, start, end, score."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "start", "end")))  # bounded: one source's windows
    kind = "array<struct<s:int,start:int,end:int>>"
    keep = F.aggregate(ordered.cast(kind), F.array().cast(kind), lambda acc, x: F.when(F.exists(acc, lambda o: (x.start >= o.start) & (x.end <= o.end)) | (F.size(acc) >= most), acc).otherwise(F.concat(acc, F.array(x))))
    return candidates.groupBy("id").agg(keep.alias("k")).select("id", F.posexplode("k").alias("place", "w")).select("id", (F.col("place") + 1).alias("place"), "w.start", "w.end", (-F.col("w.s")).alias("score"))


def other_titles(df: DataFrame, names: Column, context: str, reach: int = 28) -> DataFrame:
    """(id, title): titles in 《》 that aren't among ``names`` and at any of their places stand within ``reach`` characters of
    a word of ``context``.

    The text is taken as titles and what lies between, in pieces of one character at least, so that ``reach`` pieces on each
    side hold the characters around a title.
    """
    known = F.transform(F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda t: normalized(t) != ""), normalized)
    pieces = F.regexp_extract_all(clean(F.col("text")), F.lit("(?s)《[^》]{1,40}》|.[^《]*"), F.lit(0))
    parts = df.select("id", known.alias("_known"), pieces.alias("_p"))
    around = f"concat(right(array_join(slice(_p, greatest(i - {reach - 1}, 1), least(i, {reach})), ''), {reach}), x, left(array_join(slice(_p, i + 2, {reach}), ''), {reach}))"
    each = F.expr(f"filter(transform(_p, (x, i) -> CASE WHEN x RLIKE '^《[^》]{{1,40}}》$' THEN struct(substring(x, 2, length(x) - 2) AS title, {around} AS near) END), y -> y IS NOT NULL)")
    places = parts.select("id", "_known", F.explode(F.array_distinct(F.transform(F.filter(each, lambda y: y.near.rlike(context)), lambda y: y.title))).alias("title"))
    key = normalized(F.col("title"))
    return places.where((key != "") & ~F.exists("_known", lambda n: F.contains(n, key) | F.contains(key, n))).select("id", "title")


def valid_positions(body: Column, fragment: Column, start: Column, end: Column) -> Column:
    """Whether a fragment is what stands between two places (from 0, half-open) of the body."""
    return F.coalesce((start >= 0) & (end >= start) & (end <= F.length(body)) & (F.substring(body, start + 1, end - start) == fragment), F.lit(False))


def varied(df: DataFrame, group: str, limit: int) -> DataFrame:
    """(group, id, place): up to ``limit`` rows of each group, each next one the least like those taken (Jaccard of grams),
    ties to the least id; the first is the least id. One round over all rows for each place, written to the shared folder."""
    rows = cut(df.select(group, "id", grams(normalized(F.col("text"))).alias("g")))
    state = rows.withColumns({"near": F.lit(0.0), "place": F.lit(None).cast("int")})
    for k in range(limit):
        chosen = state.where("place is null").groupBy(group).agg(F.min_by(F.struct("id", "g"), F.struct("near", "id")).alias("c"))
        both = F.size(F.array_intersect("g", F.col("c.g")))
        alike = F.coalesce(F.try_divide(both.cast("double"), F.size("g") + F.size(F.col("c.g")) - both), F.lit(0.0))
        state = cut(state.join(chosen, group, "left").select(group, "id", "g", F.when(F.col("c").isNull(), F.col("near")).otherwise(F.greatest("near", alike)).alias("near"), F.when(F.col("place").isNull() & (F.col("id") == F.col("c.id")), F.lit(k + 1)).otherwise(F.col("place")).alias("place")))
    return state.where("place is not null").select(group, "id", "place")


def leading_unrelated(segments: Column, terms: Column, unrelated: str) -> Column:
    """Indexes (from 0) of the segments before the first one with any of the terms that speak of something else (a pattern);
    none where no segment has a term."""
    has = lambda s: F.exists(terms, lambda t: (t != "") & F.contains(s, t))
    first = F.array_position(F.transform(segments, has), F.lit(True)).cast("int") - 1
    before = F.transform(F.slice(segments, F.lit(1), F.greatest(first, F.lit(0))), lambda s, i: F.when(s.rlike(unrelated), i))
    return F.array_compact(before)


def evidence_menu(spans: Column, text: Column, terms: Column, most: int = 3, longest: int = 260) -> Column:
    """The first ``most`` spans of a text that hold one of the terms, as array of (start, end, part), each cut at ``longest``."""
    part = lambda s: F.substring(text, s.start + 1, F.least(s.end - s.start, F.lit(longest)))
    found = F.filter(spans, lambda s: F.exists(terms, lambda t: (t != "") & F.contains(part(s), t)))
    return F.transform(F.slice(found, 1, most), lambda s: F.struct(s.start.alias("start"), F.least(s.end, s.start + longest).alias("end"), part(s).alias("part")))


#: Letters and characters of an excerpt, the length it should have, and how it must not begin.
LEAST_EXCERPT, LONGEST_EXCERPT, GOOD_EXCERPT = 18, 150, 70
BEGINS_BADLY = r"^[\s，。！？；：、,.!?;:)）」』”》】]"


def excerpt_candidates(df: DataFrame, opinion: str, most: int = 3) -> DataFrame:
    """(id, place, start, end, excerpt): excerpts around the best window of each text, best first; a top-k report per text.

    ``df`` has id, text, w_start, w_end. Excerpts are runs of one to three sentence spans that touch the window or stand
    beside one that does, and hold at least one that does. They have enough letters, are short enough once cleaned for
    display, and don't begin with a sign. Operational promotion goes last, then short ones, then by words of opinion and
    length, then by place. ``place`` counts from 1; those that still have markup or unbalanced quotes are left out.
    """
    s = with_span_lists(df, "text", ["id", "text", "w_start", "w_end"]).where(F.size("spans") > 0)
    touched = F.transform("spans", lambda x: (x.start < F.col("w_end")) & (x.end > F.col("w_start")))
    s = s.withColumn("_t", touched)
    n = F.size("spans")
    each = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(F.sequence(i, F.least(i + most, n) - 1), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    runs = s.select("id", "text", "spans", "_t", F.inline(each)).where(F.exists(F.slice("_t", F.col("i") + 1, F.col("j") - F.col("i") + 1), lambda x: x))
    near = F.exists(F.slice("_t", F.greatest(F.col("i"), F.lit(1)), F.least(F.col("i") + 2, F.lit(3))), lambda x: x)  # its first span touches, or is beside one that does
    cut_out = runs.where(near).select("id", F.get("spans", F.col("i"))["start"].alias("start"), F.get("spans", F.col("j"))["end"].alias("end"), "text")
    cut_out = cut_out.select("id", "start", "end", F.trim(F.expr("substring(text, start + 1, end - start)")).alias("raw"))
    shown = once(cut_out, excerpt=display(F.col("raw")))
    long = F.length("excerpt")
    good = shown.where((F.length(normalized(F.col("raw"))) >= LEAST_EXCERPT) & long.between(1, LONGEST_EXCERPT) & ~F.col("raw").rlike(BEGINS_BADLY) & ~has_markup(F.col("excerpt")) & (F.regexp_count("excerpt", F.lit("“")) == F.regexp_count("excerpt", F.lit("”"))))
    worth = F.regexp_count("excerpt", F.lit(opinion)) * 2.2 + F.least(long, F.lit(GOOD_EXCERPT)) / 20
    ordered = good.select("id", "start", "end", "excerpt", F.col("excerpt").rlike(PROMOTION).alias("promo"), (long < GOOD_EXCERPT).alias("short"), worth.alias("worth"))
    return first_of(ordered, ["id"], most, F.col("promo"), F.col("short"), F.desc("worth"), F.col("start"), F.col("end")).select("id", F.col("place").cast("int").alias("place"), "start", "end", "excerpt")


def highlighted(c: Column, query: str) -> Column:
    """HTML of a text with every occurrence of the query, whatever its case, between <mark> and </mark>; null becomes ''."""
    safe = F.coalesce(c, F.lit(""))
    for sign, name in HTML_SIGNS:
        safe, query = F.replace(safe, F.lit(sign), F.lit(name)), query.replace(sign, name)
    return F.regexp_replace(safe, "(?iu)" + re.sub(r"([^\w\s])", r"\\\1", query), "<mark>$0</mark>") if query else safe


def representatives(df: DataFrame, group: str, top: int, low: int, order: list[str]) -> DataFrame:
    """The first ``top`` and the last ``low`` rows of each group by ``order`` (columns, all falling), with what they stand for.

    Both ends are first rows of an order, so that each task passes on only so many rows of a group. A row of both is strong.
    """
    strong = first_of(df, [group], top, *(F.desc(c) for c in order)).drop("place").withColumn("stands_for", F.lit("strongest"))
    weak = first_of(df, [group], low, *(F.asc(c) for c in order)).drop("place").withColumn("stands_for", F.lit("weakest"))
    return strong.unionByName(weak.join(strong.select("id"), "id", "left_anti"))


def spread_members(df: DataFrame, group: list[str], order: list[Column], weakest: list[Column], limit: int = 8) -> DataFrame:
    """Up to ``limit`` rows that stand for each group: all of a group of so many rows; else its first four by ``order``, its
    first two by ``weakest``, and of what remains by ``order`` as many of the first as make six, then the middle and the last.

    ``df`` has id. ``order`` and ``weakest`` are total orders, with the best and the weakest first.
    """
    n = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    placed = ranked(ranked(df, group, *order, name="_p"), group, *weakest, name="_w").join(small(n), group)
    marked = written(placed.withColumn("_in", (F.col("_n") <= limit) | (F.col("_p") <= 4) | (F.col("_w") <= 2)))
    taken = marked.where("_in").select(*df.columns)
    rest = ranked(marked.where(~F.col("_in")), group, F.col("_p"), name="_r")
    m = rest.groupBy(*group).agg(F.count(F.lit(1)).alias("_m"))
    heads = 6 - (F.col("_n") - F.col("_m"))  # where a row is strong and weak
    middle = heads + F.bround((F.col("_m") - heads - 1) / 2).cast("bigint") + 1
    more = rest.join(small(m), group).where((F.col("_r") <= heads) | (F.col("_r") == middle) | (F.col("_r") == F.col("_m")))
    return taken.unionByName(more.select(*df.columns))


def valid_fragments(body: Column, fragments: Column, positions: Column, most: int = 2) -> Column:
    """Whether one to ``most`` fragments stand in the body where they should: array of texts, array of (start, end) in order,
    without overlap, from 0 and half-open."""
    n = F.size(fragments)
    each = F.zip_with(fragments, positions, lambda f, p: valid_positions(body, f, p.start, p.end))
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.coalesce(F.get(positions, i).end <= F.get(positions, i + 1).start, F.lit(True)))
    return F.coalesce(n.between(1, most) & (n == F.size(positions)) & F.forall(each, lambda x: x) & F.forall(pairs, lambda x: x), F.lit(False))


def cuts_into(positions: Column, spans: Column) -> Column:
    """Whether any of the (start, end) begins or ends inside one of the spans, as a topic's name taken out of its # signs."""
    inside = lambda x, s: (x > s.start) & (x < s.end)
    return F.exists(positions, lambda p: F.exists(spans, lambda s: inside(p.start, s) | inside(p.end, s)))


def topic_spans(text: Column) -> Column:
    """Array of (start, end) of the topics between # signs, each # used once: pieces of the text and their running length."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?s)#[^#\n\r]{2,40}#|#|[^#]+"), F.lit(0))
    ends = F.transform(pieces, lambda p, i: F.length(F.array_join(F.slice(pieces, 1, i + 1), "")))
    spans = F.zip_with(pieces, ends, lambda p, e: F.when(p.rlike("^#[^#]+#$"), F.struct((e - F.length(p)).alias("start"), e.alias("end"))))
    return F.array_compact(spans)
