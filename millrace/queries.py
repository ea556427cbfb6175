"""Queries of the core operators over the project's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import checks, dedup, entities, evidence, links, passages, reviews, routing, sources
from millrace.operators.instants import utc_micros
from millrace.plans.lineage import once, small, written
from millrace.plans.ranking import first_of, ranked
from millrace.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql  # a function where it rests on SQL that stands below
        return f

    return add


# ---- pieces of SQL ------------------------------------------------------------------------------------------------

_WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _clean(x: str) -> str:
    t = f"trim(regexp_replace(coalesce({x}, ''), '{_WS}', ' ', 'g'))"
    return f"(CASE WHEN {t} IN ('-', '--', 'None', 'null') THEN '' ELSE {t} END)"


def _norm(x: str) -> str:
    return f"lower(regexp_replace(coalesce({x}, ''), '[^一-鿿A-Za-z0-9]+', '', 'g'))"


def _host(x: str) -> str:
    return f"regexp_replace(rtrim(lower(regexp_extract({_clean(x)}, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.'), '^www\\.', '')"


def _count(x: str, p: str) -> str:
    return f"len(regexp_extract_all({x}, '{p}'))"


_OWN = f"coalesce(nullif({_clean('body')}, ''), nullif({_clean('asr')}, ''), {_clean('title')})"
_SOURCES = f"""src AS (SELECT *, {_clean('title')} AS t, {_OWN} AS own FROM normalized_sources),
sources AS (SELECT id, batch, channel, author, url, t AS title, CASE WHEN coalesce(post_type, '') IN ('评论', '转帖') OR t = '' OR contains({_norm('own')}, {_norm('t')}) THEN own ELSE t || ' ' || own END AS text FROM src)"""


def source_rows(spark: SparkSession, d: str) -> DataFrame:
    """id, batch, channel, author, url, title, text of every source, cleaned."""
    return sources.with_text(table(spark, d, "normalized_sources")).select("id", "batch", "channel", "author", "url", "title", "text")


# ---- scalar functions ---------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {_clean('text')} AS cleaned FROM documents")
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean(F.col("text")).alias("cleaned"))


@query(f"SELECT doc_id, {_norm('text')} AS fingerprint FROM documents")
def normalize_fingerprint(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalized(F.col("text")).alias("fingerprint"))


@query("SELECT id, substring(sha256(concat_ws('|', source_path, sheet, CAST(row_no AS VARCHAR), id)), 1, 16) AS stable_id FROM records")
def stable_id(spark, d):
    return table(spark, d, "records").select("id", T.stable_id(F.col("source_path"), F.col("sheet"), F.col("row_no").cast("string"), F.col("id")).alias("stable_id"))


@query("""SELECT source_file, CASE WHEN contains(source_file, '境内新闻') THEN '境内新闻' WHEN contains(source_file, '公众文章') THEN '公众文章' WHEN contains(source_file, '今日头条') THEN '今日头条'
WHEN contains(source_file, '微博') THEN '微博' WHEN contains(source_file, '小红书') THEN '小红书' WHEN contains(source_file, '抖音') THEN '抖音'
WHEN contains(source_file, '公号') OR contains(source_file, '微信') THEN '公众文章' WHEN contains(source_file, '新闻') THEN '境内新闻' END AS channel FROM source_files""")
def channel_inference(spark, d):
    return table(spark, d, "source_files").select("source_file", sources.channel_of(F.col("source_file")).alias("channel"))


_LONG = r"\d{4}\.\d{2}\.\d{2} \d{2}_\d{2}至\d{4}\.\d{2}\.\d{2} \d{2}_\d{2}"
_FROM = r"(\d{4})\.(\d{2})\.(\d{2}) (\d{2})_(\d{2})至"
_TO = r"至(\d{4})\.(\d{2})\.(\d{2}) (\d{2})_(\d{2})"
_SHORT = r"(\d{4})[.-](\d{2})[.-](\d{2})至(\d{4})[.-](\d{2})[.-](\d{2})"


def _file_end(first: bool, sec: str, clock: str) -> str:
    e = lambda p, i: f"regexp_extract(source_file, '{p}', {i})"
    long, s = (_FROM, 1) if first else (_TO, 4)
    return f"CASE WHEN regexp_matches(source_file, '{_LONG}') THEN try_cast({e(long, 1)} || '-' || {e(long, 2)} || '-' || {e(long, 3)} || ' ' || {e(long, 4)} || ':' || {e(long, 5)} || ':{sec}' AS TIMESTAMP) ELSE try_cast({e(_SHORT, s)} || '-' || {e(_SHORT, s + 1)} || '-' || {e(_SHORT, s + 2)} || ' {clock}' AS TIMESTAMP) END"


@query(f"SELECT source_file, CAST({_file_end(True, '00', '00:00:00')} AS VARCHAR) AS period_start, CAST({_file_end(False, '59', '23:59:59')} AS VARCHAR) AS period_end FROM source_files")
def filename_period(spark, d):
    a, b = sources.file_period(F.col("source_file"))
    return table(spark, d, "source_files").select("source_file", a.cast("string").alias("period_start"), b.cast("string").alias("period_end"))


@query(f"WITH {_SOURCES} SELECT id, text FROM sources")
def source_text_compose(spark, d):
    return source_rows(spark, d).select("id", "text")


@query(f"SELECT id, {_host('url')} AS host FROM normalized_sources")
def host_normalize(spark, d):
    return table(spark, d, "normalized_sources").select("id", T.host(F.col("url")).alias("host"))


@query(f"SELECT id, CASE WHEN NOT regexp_matches({_clean('url')}, '^https?://') OR {_host('url')} = '' OR {_host('url')} = 'p8.read.example' OR ends_with({_host('url')}, '.p8.read.example') THEN '' ELSE {_clean('url')} END AS url FROM normalized_sources")
def safe_url(spark, d):
    return table(spark, d, "normalized_sources").select("id", T.safe_url(F.col("url"), "p8.read.example").alias("url"))


def _polarity(x: str) -> str:
    tail = f"list_extract(string_split_regex({x}, '{T.CONTRAST}'), -1)"
    p, n, tp, tn = _count(x, T.POSITIVE), _count(x, T.NEGATIVE), _count(tail, T.POSITIVE), _count(tail, T.NEGATIVE)
    return f"CASE WHEN {tp} > {tn} THEN 'positive' WHEN {tn} > {tp} THEN 'negative' WHEN {p} > {n} THEN 'positive' WHEN {n} > {p} THEN 'negative' ELSE 'neutral' END"


@query(f"WITH {_SOURCES} SELECT id, {_polarity('text')} AS stance FROM sources")
def stance(spark, d):
    return source_rows(spark, d).select("id", T.polarity(F.col("text")).alias("stance"))


_BANDS = "CASE " + " ".join(f"WHEN n < {e} THEN CAST({v} AS DOUBLE)" for e, v in T.LENGTH_BANDS) + f" ELSE CAST({T.LONGEST_SCORE} AS DOUBLE) END"


@query(f"WITH {_SOURCES} SELECT id, {_BANDS} AS length_score FROM (SELECT id, length({_norm('text')}) AS n FROM sources)")
def length_score(spark, d):
    return source_rows(spark, d).select("id", T.length_score(F.length(T.normalized(F.col("text")))).alias("length_score"))


@query(f"WITH {_SOURCES} SELECT s.id, array_to_string(list_filter(b.strong_terms, lambda t: length(t) >= 2 AND contains(s.text, t)), '|') AS hits FROM sources s JOIN batches b USING (batch)")
def term_hits(spark, d):
    cfg = table(spark, d, "batches").select("batch", "strong_terms")
    return source_rows(spark, d).join(small(cfg), "batch").select("id", F.array_join(T.term_hits(F.col("text"), F.col("strong_terms")), "|").alias("hits"))


@query(f"""WITH {_SOURCES}, t AS (SELECT s.id, s.text, unnest(b.strong_terms) AS term FROM sources s JOIN batches b USING (batch)),
p AS (SELECT DISTINCT id, i AS a, i + length(term) AS b FROM t, LATERAL (SELECT unnest(range(0, length(text))) AS i) WHERE length(term) > 0 AND substring(text, i + 1, length(term)) = term),
m AS (SELECT *, max(b) OVER (PARTITION BY id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM p),
c AS (SELECT id, count(*) FILTER (WHERE seen IS NULL OR a >= seen) AS n, min(a) AS first FROM m GROUP BY id)
SELECT s.id, coalesce(c.n, 0)::BIGINT AS n_spans, coalesce(c.first, -1)::BIGINT AS first_at, CASE WHEN coalesce(c.n, 0) * 120.0::DOUBLE / greatest(length(s.text), 1) > 1 THEN 1.0::DOUBLE ELSE coalesce(c.n, 0) * 120.0::DOUBLE / greatest(length(s.text), 1) END AS density
FROM (SELECT s.* FROM sources s JOIN batches b USING (batch)) s LEFT JOIN c USING (id)""")
def anchor_density(spark, d):
    cfg = table(spark, d, "batches").select("batch", "strong_terms")
    s = source_rows(spark, d).join(small(cfg), "batch").select("id", "text", T.merged_spans(F.col("text"), F.col("strong_terms")).alias("spans"))
    n = F.size("spans")
    return s.select("id", n.cast("bigint").alias("n_spans"), F.coalesce(F.try_element_at("spans", F.lit(1)).a, F.lit(-1)).cast("bigint").alias("first_at"), F.least(F.lit(1.0), n * 120.0 / F.greatest(F.length("text"), F.lit(1))).alias("density"))


@query(f"WITH {_SOURCES} SELECT id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{T.PROMOTION}'))), '|') AS markers FROM sources")
def promotion_markers(spark, d):
    return source_rows(spark, d).select("id", F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("text", F.lit(T.PROMOTION), F.lit(0)))), "|").alias("markers"))


@query("SELECT id, len(regexp_extract_all(coalesce(body, ''), '“')) <> len(regexp_extract_all(coalesce(body, ''), '”')) AS unbalanced FROM normalized_sources")
def unbalanced_quotes(spark, d):
    b = F.coalesce("body", F.lit(""))
    return table(spark, d, "normalized_sources").select("id", (F.regexp_count(b, F.lit("“")) != F.regexp_count(b, F.lit("”"))).alias("unbalanced"))


_GRAMS = f"""SELECT doc_id, count(DISTINCT substring(n, i, 3)) AS n_grams FROM (SELECT doc_id, {_norm('text')} AS n FROM documents), LATERAL (SELECT unnest(range(1, length(n) - 1)) AS i) GROUP BY doc_id"""


@query(f"SELECT d.doc_id, coalesce(g.n_grams, 0)::BIGINT AS n_grams FROM documents d LEFT JOIN ({_GRAMS}) g USING (doc_id)")
def trigram_sets(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(T.grams(T.normalized(F.col("text")))).cast("bigint").alias("n_grams"))


# ---- filters, rules -----------------------------------------------------------------------------------------------

_ISO = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$"


def _iso(x: str) -> str:
    t = f"regexp_replace({_clean(x)}, '/', '-', 'g')"
    return f"CASE WHEN regexp_matches({t}, '{_ISO}') THEN try_cast({t} AS TIMESTAMP) END"


@query(f"""WITH w AS (SELECT batch, {_iso('period_start')} AS s, CASE WHEN regexp_matches({_clean('period_end')}, '^\\d{{4}}[-/]\\d{{2}}[-/]\\d{{2}}$') THEN ({_iso('period_end')}) + INTERVAL '86399.999999 seconds' ELSE {_iso('period_end')} END AS e FROM batches),
f AS (SELECT id, n.batch, w.batch IS NOT NULL AS has, w.s, w.e, {_file_end(True, '00', '00:00:00')} AS fs, {_file_end(False, '59', '23:59:59')} AS fe, {_iso('published')} AS t FROM normalized_sources n LEFT JOIN w USING (batch)),
g AS (SELECT id, batch, CASE WHEN has THEN s ELSE fs END AS s, CASE WHEN has THEN e ELSE fe END AS e, t FROM f)
SELECT id, CASE WHEN s IS NULL OR e IS NULL OR t IS NULL THEN 'unconfigured' WHEN t BETWEEN s AND e THEN 'in_period' ELSE 'out_of_period' END AS period_state FROM g""")
def period_partition(spark, d):
    return sources.with_period_state(table(spark, d, "normalized_sources"), table(spark, d, "batches").select("batch", "period_start", "period_end")).select("id", "period_state")


def _rules(text, n, hits):
    return [(n == 0, "exclude", "no text"), (hits == 0, "exclude", "no target"), (n < 18, "exclude", "too short"), (text.rlike(T.PROMOTION) & ~text.rlike(f"{T.POSITIVE}|{T.NEGATIVE}"), "exclude", "promotion"), (~text.rlike(f"{T.POSITIVE}|{T.NEGATIVE}"), "review", "no opinion")]


@query(f"""WITH {_SOURCES}, f AS (SELECT s.id, s.text, length({_norm('text')}) AS n, len(list_filter(b.strong_terms, lambda t: length(t) >= 2 AND contains(s.text, t))) AS hits FROM sources s JOIN batches b USING (batch)),
g AS (SELECT id, CASE WHEN n = 0 THEN 'exclude:no text' WHEN hits = 0 THEN 'exclude:no target' WHEN n < 18 THEN 'exclude:too short' WHEN regexp_matches(text, '{T.PROMOTION}') AND NOT regexp_matches(text, '{T.POSITIVE}|{T.NEGATIVE}') THEN 'exclude:promotion' WHEN NOT regexp_matches(text, '{T.POSITIVE}|{T.NEGATIVE}') THEN 'review:no opinion' ELSE 'retain:default' END AS r FROM f)
SELECT id, split_part(r, ':', 1) AS decision, split_part(r, ':', 2) AS reason FROM g""")
def rule_gate(spark, d):
    cfg = table(spark, d, "batches").select("batch", "strong_terms")
    f = source_rows(spark, d).join(small(cfg), "batch").select("id", "text", F.length(T.normalized(F.col("text"))).alias("n"), F.size(T.term_hits(F.col("text"), F.col("strong_terms"))).alias("hits"))
    return f.select("id", links.first_match(_rules(F.col("text"), F.col("n"), F.col("hits")), "retain", "default").alias("r")).select("id", "r.decision", "r.reason")


@query("SELECT batch, coalesce(channel, '') AS channel, count(*)::BIGINT AS n FROM normalized_sources GROUP BY ALL")
def group_counts(spark, d):
    return table(spark, d, "normalized_sources").groupBy("batch", F.coalesce("channel", F.lit("")).alias("channel")).agg(F.count(F.lit(1)).alias("n"))


# ---- copies -------------------------------------------------------------------------------------------------------


def prints(spark, d):
    return once(source_rows(spark, d).select("id", "batch", "text"), fingerprint=T.normalized(F.col("text"))).select("id", "batch", "fingerprint", F.length("text").alias("len"))


def digests(spark, d):
    return once(prints(spark, d), digest=dedup.digest(F.col("fingerprint"))).select("id", "batch", "digest", "len")


_PRINTS = f"{_SOURCES}, prints AS (SELECT id, batch, {_norm('text')} AS fingerprint, length(text) AS len FROM sources)"


@query(f"WITH {_PRINTS} SELECT batch, substring(sha256(fingerprint), 1, 32) AS digest, arg_max(id, (len, id)) AS representative, count(*)::BIGINT AS n_copies FROM prints WHERE fingerprint <> '' GROUP BY batch, fingerprint")
def exact_copy_collapse(spark, d):
    return dedup.collapse_copies(digests(spark, d), ["batch", "digest"], [F.col("len")])


@query(f"WITH {_PRINTS} SELECT id, CASE WHEN fingerprint = '' THEN id ELSE min(id) OVER (PARTITION BY fingerprint) END AS family FROM prints")
def copy_families(spark, d):
    return dedup.copy_families(prints(spark, d).select("id", "fingerprint"))


@query(f"""WITH {_PRINTS}, v AS (SELECT source_id AS id, max(abusive) AS v FROM review_labels WHERE tab = 'normalized_sources' GROUP BY source_id),
r AS (SELECT p.id, p.fingerprint, v.v FROM prints p LEFT JOIN v USING (id)), o AS (SELECT fingerprint, min(v) AS one FROM r WHERE fingerprint <> '' GROUP BY fingerprint HAVING count(DISTINCT v) = 1)
SELECT r.id, coalesce(o.one, r.v) AS v FROM r LEFT JOIN o USING (fingerprint)""")
def decision_propagation(spark, d):
    v = table(spark, d, "review_labels").where("tab = 'normalized_sources'").groupBy(F.col("source_id").alias("id")).agg(F.max("abusive").alias("v"))
    rows = prints(spark, d).select("id", "fingerprint").join(v, "id", "left")
    return reviews.propagated(rows, "fingerprint", "v").select("id", "v")


def _reps(spark, d):
    """Written once: (batch, id, norm, digest) of every row; (batch, digest, representative) of texts of several rows; and
    (batch, id, norm) of one row for each different text of a batch. Digests are shuffled, and texts only where the copies
    are too many for a broadcast."""
    texts = sources.with_text(table(spark, d, "normalized_sources"), fingerprint=True).select("batch", "id", F.col("fingerprint").alias("norm"), F.length("text").alias("len"))
    rows = written(once(texts, digest=dedup.digest(F.col("norm"))).select("batch", "id", "norm", "digest", "len"))
    copies = written(dedup.collapse_copies(rows, ["batch", "digest"], [F.col("len")]).where("n_copies > 1").select("batch", "digest", "representative"))
    c = small(copies.select(F.col("batch").alias("_b"), F.col("digest").alias("_d"), "representative"), dedup.BROADCAST_IDS)
    reps = rows.where("digest != ''").join(c, F.col("batch").eqNullSafe(F.col("_b")) & (F.col("digest") == F.col("_d")), "left").where("representative is null or representative = id")
    return rows, copies, reps.select("batch", "id", "norm")


@query(f"""WITH {_PRINTS}, reps AS (SELECT batch, fingerprint AS norm, arg_max(id, (len, id)) AS id FROM prints WHERE fingerprint <> '' GROUP BY batch, fingerprint),
g AS (SELECT DISTINCT batch, id, substring(norm, i, 3) AS gram FROM reps, LATERAL (SELECT unnest(range(1, length(norm) - 1)) AS i)),
n AS (SELECT batch, id, count(*) AS n FROM g GROUP BY batch, id),
c AS (SELECT a.batch, a.id AS left_id, b.id AS right_id, count(*) AS n_common FROM g a JOIN g b ON a.batch = b.batch AND a.gram = b.gram AND a.id < b.id GROUP BY ALL)
SELECT c.batch, left_id, right_id, n_common::BIGINT AS n_common, l.n::BIGINT AS n_left, r.n::BIGINT AS n_right FROM c JOIN n l ON l.batch = c.batch AND l.id = left_id JOIN n r ON r.batch = c.batch AND r.id = right_id
WHERE n_common >= 0.84::DOUBLE * (l.n + r.n - n_common) - 1e-9 OR n_common >= 0.94::DOUBLE * least(l.n, r.n) - 1e-9""")
def near_dup_pairs(spark, d):
    p = dedup.near_pairs(_reps(spark, d)[2])
    return p.select("batch", "left_id", "right_id", *(F.col(c).cast("bigint").alias(c) for c in ("n_common", "n_left", "n_right")))


@query()
def near_dup_greedy(spark, d):
    """Every source with the representative of its exact copies and the row kept for it; near_dup_pairs are of representatives."""
    every, copies, reps = _reps(spark, d)
    rows = ranked(reps.select("batch", "id", F.length("norm").alias("n")), ["batch"], F.desc("n"), F.desc("id")).select("batch", "id", "place")
    kept = dedup.greedy_survivors(rows, dedup.near_pairs(reps))
    return dedup.memberships(every.select("batch", "id", F.col("digest").alias("fingerprint")), copies.withColumnRenamed("digest", "fingerprint"), kept)


# ---- topics, entities ---------------------------------------------------------------------------------------------

_TAGS = f"""{_SOURCES}, cfg AS (SELECT batch, list_transform(list_filter(strong_terms, lambda t: length(t) >= 2), lambda t: {_norm('t')}) AS anchors, strong_terms FROM batches),
tags AS (SELECT DISTINCT s.id, s.batch, len(list_filter(c.strong_terms, lambda t: length(t) >= 2 AND contains(s.text, t))) > 0 AS strong, c.anchors, {_clean('raw')} AS term FROM sources s JOIN cfg c USING (batch), LATERAL (SELECT unnest(regexp_extract_all(s.text, '#([^#\\n\\r]{{2,40}})#', 1)) AS raw)),
ok AS (SELECT * FROM tags WHERE length({_norm('term')}) BETWEEN 4 AND 36 AND len(list_filter(anchors, lambda a: contains({_norm('term')}, a) OR contains(a, {_norm('term')}))) = 0)"""


@query(f"""WITH {_TAGS}, c AS (SELECT batch, term, count(DISTINCT CASE WHEN strong THEN id END) AS n_supporting, count(DISTINCT id) AS n_sources FROM ok GROUP BY batch, term),
k AS (SELECT *, CASE WHEN n_supporting >= 2 THEN 'cooccurrence' ELSE 'recurrent' END AS basis FROM c WHERE n_supporting >= 2 OR n_sources >= 3),
r AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY (basis = 'cooccurrence') DESC, n_supporting DESC, n_sources DESC, length({_norm('term')}) DESC, term DESC) AS rank FROM k)
SELECT batch, term, n_supporting::BIGINT AS n_supporting, n_sources::BIGINT AS n_sources, basis, rank::BIGINT AS rank FROM r WHERE rank <= 40""")
def hashtag_topics(spark, d):
    t = sources.derived_topics(source_rows(spark, d).select("id", "batch", "text"), table(spark, d, "batches"))
    return t.select("batch", "term", "n_supporting", "n_sources", "basis", F.col("rank").cast("bigint").alias("rank"))


@query(f"""WITH reg AS (SELECT DISTINCT channel AS subject, author AS name FROM normalized_sources WHERE channel IS NOT NULL), u AS (SELECT {_norm('name')} AS key, min(subject) AS subject FROM reg WHERE {_norm('name')} <> '' GROUP BY 1 HAVING count(DISTINCT subject) = 1)
SELECT id, u.subject FROM normalized_sources LEFT JOIN u ON u.key = {_norm('author')}""")
def alias_join(spark, d):
    s = table(spark, d, "normalized_sources")
    return entities.by_alias(s, s.where("channel is not null").select(F.col("channel").alias("subject"), F.col("author").alias("name")).distinct())


_DOMAINS = [("example", "all"), ("read.example", "readers"), ("p8.read.example", "eight"), ("p12.read.example", "twelve"), ("p35.read.example", "thirty-five")]


@query(f"""WITH h AS (SELECT id, {_host('url')} AS h FROM normalized_sources), dom AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}')" for a, b in _DOMAINS)}) t(domain, subject))
SELECT id, arg_max(domain, length(domain)) AS domain, arg_max(subject, length(domain)) AS subject FROM h JOIN dom ON h.h = domain OR ends_with(h.h, '.' || domain) WHERE h.h <> '' GROUP BY id""")
def domain_suffix_join(spark, d):
    return entities.by_domain(table(spark, d, "normalized_sources"), spark.createDataFrame(_DOMAINS, "domain string, subject string"))


@query(f"""WITH reg AS (SELECT DISTINCT channel AS subject, {_norm('channel')} AS key FROM normalized_sources WHERE channel IS NOT NULL), n AS (SELECT * FROM reg WHERE length(key) >= 2),
s AS (SELECT id, {_norm('certification_info')} AS info FROM normalized_sources WHERE {_norm('certification_info')} <> ''), hits AS (SELECT s.id, n.key, n.subject FROM s JOIN n ON contains(s.info, n.key))
SELECT id, arg_max(subject, length(key)) AS subject FROM hits GROUP BY id HAVING count(DISTINCT subject) = 1""")
def certification_match(spark, d):
    s = table(spark, d, "normalized_sources")
    return entities.by_certification(s.select("id", "certification_info"), s.where("channel is not null").select(F.col("channel").alias("subject"), F.col("channel").alias("name")).distinct())


# ---- reviews ------------------------------------------------------------------------------------------------------

_LEDGER = "ledger AS (SELECT tab, source_id, abusive, reviewer FROM (SELECT *, row_number() OVER (PARTITION BY tab, source_id ORDER BY reviewed_at DESC NULLS LAST, review_id DESC) AS k FROM review_labels) WHERE k = 1)"


@query(f"WITH {_LEDGER} SELECT * FROM ledger")
def ledger_upsert(spark, d):
    return reviews.latest(table(spark, d, "review_labels"), ["tab", "source_id"], "reviewed_at", "review_id").select("tab", "source_id", "abusive", "reviewer")


def _answers(spark, d):
    return ledger_upsert(spark, d).where("tab = 'normalized_sources'").select(F.col("source_id").alias("id"), F.when(F.col("abusive") == 1, "exclude").when(F.col("abusive") == 0, "retain").alias("decision"))


@query(f"WITH {_LEDGER}, r AS (SELECT source_id AS id, CASE abusive WHEN 1 THEN 'exclude' WHEN 0 THEN 'retain' END AS decision FROM ledger WHERE tab = 'normalized_sources') SELECT n.id, coalesce(r.decision, CASE WHEN length(coalesce(body, '')) = 0 THEN 'exclude' ELSE 'pending' END) AS decision, CASE WHEN r.decision IS NULL THEN 'automatic' ELSE 'review' END AS basis FROM normalized_sources n LEFT JOIN r USING (id)")
def review_coalesce(spark, d):
    auto = table(spark, d, "normalized_sources").select("id", F.when(F.length(F.coalesce("body", F.lit(""))) == 0, "exclude").otherwise("pending").alias("auto"))
    return reviews.decided(auto, _answers(spark, d)).select("id", "decision", "basis")


@query("SELECT id FROM normalized_sources WHERE id NOT IN (SELECT source_id FROM review_labels WHERE tab = 'normalized_sources')")
def review_missing_anti(spark, d):
    return reviews.missing(table(spark, d, "normalized_sources").select("id"), _answers(spark, d))


@query("SELECT CAST(source_id AS VARCHAR) AS source_id FROM review_labels WHERE tab = 'records' AND source_id NOT IN (SELECT id FROM normalized_sources)")
def review_unknown_anti(spark, d):
    return reviews.unknown(table(spark, d, "review_labels").where("tab = 'records'").select(F.col("source_id").alias("id")), table(spark, d, "normalized_sources")).select(F.col("id").alias("source_id"))


@query("SELECT source_id AS key, 'repeated key' AS issue FROM review_labels GROUP BY source_id HAVING count(*) > 1 UNION ALL SELECT source_id, 'bad abusive' FROM review_labels WHERE abusive IS NULL OR CAST(abusive AS VARCHAR) NOT IN ('0', '1')")
def review_key_violations(spark, d):
    return reviews.key_violations(table(spark, d, "review_labels"), "source_id", {"abusive": ["0", "1"]})


@query("SELECT source_id, count(DISTINCT abusive)::BIGINT AS n_values, count(*)::BIGINT AS n_rows FROM review_labels GROUP BY source_id HAVING count(DISTINCT abusive) > 1")
def review_conflicts(spark, d):
    return reviews.conflicts(table(spark, d, "review_labels"), "source_id", "abusive")


@query(f"WITH {_PRINTS}, seen AS (SELECT id, sha256(fingerprint) AS h FROM prints WHERE id IN (SELECT source_id FROM review_labels)) SELECT p.id, s.h IS NOT NULL AS fresh FROM prints p LEFT JOIN seen s ON s.id = p.id AND s.h = sha256(p.fingerprint)")
def fingerprint_join(spark, d):
    p = prints(spark, d).select("id", F.sha2("fingerprint", 256).alias("h"))
    seen = p.join(table(spark, d, "review_labels").select(F.col("source_id").alias("id")).distinct(), "id", "left_semi").select("id", "h", F.lit(True).alias("fresh"))
    return p.join(seen, ["id", "h"], "left").select("id", F.coalesce("fresh", F.lit(False)).alias("fresh"))


# ---- links --------------------------------------------------------------------------------------------------------


@query(f"SELECT DISTINCT u AS url FROM (SELECT {_clean('url')} AS u FROM normalized_sources) WHERE u <> '' AND u NOT IN (SELECT {_clean('url')} FROM normalized_sources WHERE channel = '微博')")
def link_coverage(spark, d):
    s = table(spark, d, "normalized_sources").select("channel", T.clean(F.col("url")).alias("url"))
    return links.coverage(s, s.where("channel = '微博'"))


_KINDS = {"view": "reachable", "signup": "confirmed_dead", "click": "blocked", "error": "invalid", "purchase": "indeterminate"}


@query("SELECT event_id, CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _KINDS.items()) + " END AS kind, coalesce(CASE event_type " + " ".join(f"WHEN '{k}' THEN epoch_us(TIMESTAMP '2024-01-31') - epoch_us(ts) <= {links.TTL_HOURS[v]} * 3600000000" for k, v in _KINDS.items() if v in links.TTL_HOURS) + " ELSE false END, false) AS fresh FROM events")
def ttl_cache(spark, d):
    kind = F.create_map(*(F.lit(x) for kv in _KINDS.items() for x in kv))
    e = table(spark, d, "events").select("event_id", kind[F.col("event_type")].alias("kind"), ((F.lit(1_706_659_200_000_000) - utc_micros("ts")) / 3_600_000_000).alias("age"))
    return e.select("event_id", "kind", links.fresh(F.col("kind"), F.col("age")).alias("fresh"))


@query("SELECT url, count(*)::BIGINT AS n_references, min(id) AS first_id FROM normalized_sources WHERE url IS NOT NULL GROUP BY url")
def link_references(spark, d):
    return table(spark, d, "normalized_sources").where("url is not null").groupBy("url").agg(F.count(F.lit(1)).alias("n_references"), F.min("id").alias("first_id"))


# ---- evidence -----------------------------------------------------------------------------------------------------


@query()
def sentence_spans(spark, d):
    return evidence.with_spans(table(spark, d, "normalized_sources"), "body", ["id"])


@query("SELECT id, CASE WHEN strpos(body, '“') > 0 THEN strpos(body, '“') - 1 END::BIGINT AS opened, CASE WHEN strpos(body, '“') > 0 AND strpos(substring(body, strpos(body, '“') + 1), '”') > 0 THEN strpos(body, '“') + strpos(substring(body, strpos(body, '“') + 1), '”') - 1 END::BIGINT AS closed FROM normalized_sources")
def fragment_positions(spark, d):
    a, b = evidence.locate(F.col("body"), F.lit("“"), F.lit("”"))
    return table(spark, d, "normalized_sources").select("id", a.cast("bigint").alias("opened"), b.cast("bigint").alias("closed"))


@query("SELECT id, title AS fragment, contains(body, title) AS verbatim, (strpos(body, title) - 1)::BIGINT AS at FROM normalized_sources WHERE title <> '' AND body IS NOT NULL")
def verbatim_evidence(spark, d):
    s = table(spark, d, "normalized_sources")
    out = evidence.contained(s.where("title <> '' and body is not null").select("id", F.col("title").alias("fragment")), s.select("id", F.col("body").alias("text")))
    return out.withColumn("at", F.col("at").cast("bigint"))


@query(f"""WITH {_SOURCES}, p AS (SELECT s.id AS source_id, strpos(s.text, t) - 1 AS a, strpos(s.text, t) - 1 + length(t) AS b FROM (SELECT s.id, s.text, unnest(b.strong_terms) AS t FROM sources s JOIN batches b USING (batch)) s WHERE t <> '' AND contains(s.text, t)),
w AS (SELECT *, max(b) OVER (PARTITION BY source_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM p)
SELECT DISTINCT source_id, 'overlap' AS issue FROM w WHERE a < seen UNION ALL SELECT source_id, 'too many' FROM p GROUP BY source_id HAVING count(*) > 2""")
def passage_overlap_check(spark, d):
    """Sources whose passages (first places of their strong terms) overlap or are more than two."""
    cfg = table(spark, d, "batches").select("batch", F.explode("strong_terms").alias("t"))
    p = source_rows(spark, d).select("id", "batch", "text").join(small(cfg), "batch").where("t <> '' and contains(text, t)")
    start = F.instr("text", F.col("t")) - 1
    return evidence.overlap_violations(p.select(F.col("id").alias("source_id"), start.alias("start"), (start + F.length("t")).alias("end")))


# ---- routing, ranking, sampling -----------------------------------------------------------------------------------

_WEIGHTS = (("strong", "strong_terms", 3.0), ("weak", "weak_terms", 1.5), ("auxiliary", "auxiliary_terms", 2.0))


def definitions(spark, d):
    """One cluster for each layer of a batch's terms."""
    terms = lambda c, w: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda t: F.struct(t.alias("term"), F.lit(w).alias("weight")))
    rows = F.array(*(F.struct(F.lit(n).alias("cluster"), F.lit(k).alias("def_idx"), terms(c, w).alias("keywords")) for k, (n, c, w) in enumerate(_WEIGHTS)))
    return table(spark, d, "batches").select("batch", F.inline(rows))


_TIMES = lambda x, t: f"CASE WHEN length({t}) > 0 THEN (length({x}) - length(replace({x}, {t}, ''))) / length({t}) ELSE 0 END"
_SCORES = f"""{_SOURCES}, defs AS ({' UNION ALL '.join(f"SELECT batch, '{n}' AS cluster, {k} AS def_idx, coalesce({c}, []) AS terms, {w}::DOUBLE AS w FROM batches" for k, (n, c, w) in enumerate(_WEIGHTS))}),
scores AS (SELECT s.id, s.batch, d.cluster, d.def_idx, coalesce(list_sum(list_transform(d.terms, lambda t: d.w * (least(3.0::DOUBLE, {_TIMES('s.text', 't')}) + least(2.0::DOUBLE, {_TIMES('s.title', 't')})))), 0.0::DOUBLE)::DOUBLE AS score FROM sources s JOIN defs d USING (batch))"""


@query(f"WITH {_SCORES} SELECT id, cluster, score FROM scores")
def keyword_score(spark, d):
    return routing.keyword_scores(source_rows(spark, d), definitions(spark, d)).select("id", "cluster", "score")


_RANKED = f"{_SCORES}, k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, def_idx) AS n FROM scores)"


@query(f"WITH {_RANKED} SELECT a.id, a.cluster, a.score, a.score - coalesce(b.score, 0) AS margin FROM k a LEFT JOIN k b ON a.id = b.id AND b.n = 2 WHERE a.n = 1")
def route_top1_margin(spark, d):
    return routing.with_best(routing.routed(source_rows(spark, d), definitions(spark, d), ["id"]))


@query(f"WITH {_RANKED} SELECT id, cluster, n::BIGINT AS place FROM k WHERE n <= 3")
def route_top3(spark, d):
    t = routing.routed(source_rows(spark, d), definitions(spark, d), ["id"])
    return t.select("id", F.posexplode(F.slice("ranking", 1, 3)).alias("k", "c")).select("id", "c.cluster", (F.col("k") + 1).cast("bigint").alias("place"))


def _assigned(spark, d, *more: str):
    """id, batch, author, channel, len, best cluster, score and margin of each source; texts only where ``more`` asks for them."""
    s = source_rows(spark, d).withColumn("len", F.length("text"))
    return routing.with_best(routing.routed(s, definitions(spark, d), ["id", "batch", "author", "channel", "len", *more]))


_ASSIGNED = f"{_RANKED}, assigned AS (SELECT k.id, k.batch, k.cluster, k.score, s.author, s.channel, length(s.text) AS len, s.text, s.title FROM k JOIN sources s USING (id) WHERE n = 1)"


@query(f"WITH {_ASSIGNED}, a AS (SELECT batch, cluster, coalesce(author, '') AS author, count(*) AS n FROM assigned GROUP BY ALL), c AS (SELECT batch, cluster, sum(n)::BIGINT AS n_sources, count(*) FILTER (WHERE author <> '')::BIGINT AS n_authors, max(n) FILTER (WHERE author <> '')::BIGINT AS max_author FROM a GROUP BY ALL) SELECT *, share_of_batch >= 0.25 AND n_sources >= 80 AS too_broad FROM (SELECT *, n_sources / sum(n_sources) OVER (PARTITION BY batch) AS share_of_batch FROM c)")
def cluster_profile(spark, d):
    return routing.profile(_assigned(spark, d))


@query(f"WITH {_ASSIGNED} SELECT batch, count(DISTINCT cluster)::BIGINT AS n, CASE WHEN count(DISTINCT cluster) BETWEEN 9 AND 16 THEN 'in range' ELSE 'out of range' END AS status FROM assigned GROUP BY batch")
def count_range(spark, d):
    n = F.count_distinct("cluster")
    return _assigned(spark, d).groupBy("batch").agg(n.alias("n")).withColumn("status", F.when(F.col("n").between(9, 16), "in range").otherwise("out of range"))


@query(f"WITH {_ASSIGNED} SELECT id, batch, cluster, row_number() OVER (PARTITION BY batch, cluster ORDER BY score DESC, len DESC, id DESC)::BIGINT AS position FROM assigned")
def position_in_cluster(spark, d):
    return ranked(_assigned(spark, d), ["batch", "cluster"], F.desc("score"), F.desc("len"), F.desc("id"), name="position").select("id", "batch", "cluster", "position")


@query(f"WITH {_ASSIGNED}, r AS (SELECT *, row_number() OVER (PARTITION BY batch, cluster ORDER BY score DESC, len DESC, id DESC) AS position, count(*) OVER (PARTITION BY batch, cluster) AS n FROM assigned) SELECT id, batch, cluster, greatest(n - 5, 0)::BIGINT AS more FROM r WHERE position <= 5")
def first_five_per_cluster(spark, d):
    a = _assigned(spark, d)
    n = a.groupBy("batch", "cluster").agg(F.count(F.lit(1)).alias("n"))
    return first_of(a, ["batch", "cluster"], 5, F.desc("score"), F.desc("len"), F.desc("id")).join(small(n), ["batch", "cluster"]).select("id", "batch", "cluster", F.greatest(F.col("n") - 5, F.lit(0)).alias("more"))


@query("WITH r AS (SELECT id, coalesce(channel, '') AS channel, row_number() OVER (PARTITION BY coalesce(channel, '') ORDER BY length(coalesce(body, '')) DESC, id) AS round FROM normalized_sources) SELECT id, channel, round::BIGINT AS round FROM r ORDER BY round, channel LIMIT 180")
def round_robin(spark, d):
    s = table(spark, d, "normalized_sources").select("id", F.coalesce("channel", F.lit("")).alias("channel"), F.length(F.coalesce("body", F.lit(""))).alias("len"))
    return routing.round_robin(s, "channel", 180, F.desc("len"), F.col("id")).select("id", "channel", F.col("round").cast("bigint").alias("round"))


@query()
def stratified_quota(spark, d):
    s = source_rows(spark, d).select("id", "batch", T.polarity(F.col("text")).alias("stance"), F.length("text").alias("len"))
    return routing.stratified(s, "batch", "stance", 60, 20, F.desc("len"), F.col("id")).select("id", "batch", "stratum", F.col("place").cast("bigint").alias("place"))


@query(f"WITH {_SOURCES}, f AS (SELECT id, coalesce(channel, '') AS channel, length(text) AS len, unnest(list_distinct(regexp_extract_all(text, '摄影|剪辑|配乐|台词|美术|结局'))) AS facet FROM sources), b AS (SELECT *, row_number() OVER (PARTITION BY channel, facet ORDER BY len DESC, id) AS n FROM f) SELECT id, channel, string_agg(facet, ',' ORDER BY facet) AS covers FROM b WHERE n = 1 GROUP BY id, channel")
def facet_coverage(spark, d):
    s = source_rows(spark, d).select("id", F.coalesce("channel", F.lit("")).alias("channel"), F.length("text").alias("len"), F.array_distinct(F.regexp_extract_all("text", F.lit("摄影|剪辑|配乐|台词|美术|结局"), F.lit(0))).alias("facets"))
    return routing.facet_coverage(s, F.desc("len"), F.col("id"))


# ---- page: search, tabs, nesting, checks --------------------------------------------------------------------------


@query(f"WITH {_ASSIGNED} SELECT batch, cluster, count(*)::BIGINT AS n FROM assigned WHERE contains(lower(coalesce(author, '') || ' ' || title || ' ' || text), lower('镜头')) GROUP BY batch, cluster")
def page_search(spark, d):
    hay = F.lower(F.concat_ws(" ", F.coalesce("author", F.lit("")), "title", "text"))
    return _assigned(spark, d, "text", "title").where(F.contains(hay, F.lower(F.lit("镜头")))).groupBy("batch", "cluster").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_SOURCES}, s AS (SELECT batch, {_polarity('text')} AS stance, count(*) AS n FROM sources GROUP BY ALL) SELECT batch, stance, n::BIGINT AS n_sources FROM s")
def stance_tabs(spark, d):
    return source_rows(spark, d).groupBy("batch", T.polarity(F.col("text")).alias("stance")).agg(F.count(F.lit(1)).alias("n_sources"))


@query(f"WITH {_ASSIGNED}, r AS (SELECT *, row_number() OVER (PARTITION BY batch, cluster ORDER BY score DESC, len DESC, id DESC) AS k FROM assigned), c AS (SELECT batch, cluster, count(*) AS n, string_agg(id, ',' ORDER BY k) FILTER (WHERE k <= 5) AS items FROM r GROUP BY ALL) SELECT batch, sum(n)::BIGINT AS n_items, string_agg(cluster || ':' || n || ':' || items, ';' ORDER BY cluster) AS clusters FROM c GROUP BY batch")
def nested_workbench(spark, d):
    """Batches with their clusters, counts and the items that a page shows first, nested; a row holds so many items a cluster."""
    a = _assigned(spark, d)
    n = a.groupBy("batch", "cluster").agg(F.count(F.lit(1)).alias("n"))
    shown = first_of(a, ["batch", "cluster"], 5, F.desc("score"), F.desc("len"), F.desc("id")).groupBy("batch", "cluster").agg(F.array_sort(F.collect_list(F.struct("place", "id"))).alias("shown"))  # bounded: five items
    nested = n.join(shown, ["batch", "cluster"]).groupBy("batch").agg(F.sum("n").alias("n_items"), F.array_sort(F.collect_list(F.struct("cluster", "n", "shown"))).alias("cs"))  # bounded: a batch's clusters
    one = lambda c: F.concat_ws(":", c.cluster, c.n.cast("string"), F.array_join(F.transform(c.shown, lambda x: x.id), ","))
    return nested.select("batch", "n_items", F.array_join(F.transform("cs", one), ";").alias("clusters"))


@query("""WITH o AS (SELECT batch, count(*) AS n, min(id) AS first FROM normalized_sources WHERE batch IS NOT NULL GROUP BY batch), p AS (SELECT batch, count(*) AS n, min(id) AS first FROM records WHERE batch IS NOT NULL GROUP BY batch),
a AS (SELECT coalesce(o.batch, p.batch) AS batch, coalesce(p.n, o.n) AS n, p.n IS NOT NULL AS replaced, o.batch IS NULL AS added, coalesce(o.first, p.first) AS first FROM o FULL JOIN p USING (batch))
SELECT batch, n::BIGINT AS n, row_number() OVER (ORDER BY added, first)::BIGINT AS place FROM a""")
def merge_replace(spark, d):
    """Batches of one page merged with those of another: the same name replaces in its place, others come after."""
    by_batch = lambda t: table(spark, d, t).where("batch is not null").groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    return reviews.merged(by_batch("normalized_sources"), by_batch("records"), "batch", "first").select("batch", "n", "place")


@query("SELECT 'repeated post' AS \"check\", url AS key FROM normalized_sources WHERE url <> '' GROUP BY url HAVING count(*) > 1 UNION ALL SELECT 'no channel', id FROM normalized_sources WHERE channel IS NULL UNION ALL SELECT 'unknown batch', id FROM normalized_sources WHERE batch NOT IN (SELECT batch FROM batches)")
def verify_constraints(spark, d):
    s = table(spark, d, "normalized_sources")
    stray = s.where("batch is not null").join(small(table(spark, d, "batches").select("batch")), "batch", "left_anti")
    return checks.violations(("repeated post", checks.repeated(s.where("url <> ''"), "url"), F.col("url")), ("no channel", s.where("channel is null"), F.col("id")), ("unknown batch", stray, F.col("id")))


@query(f"WITH {_ASSIGNED} SELECT batch, count(*) FILTER (WHERE score = 0)::BIGINT AS n_gaps, count(*) FILTER (WHERE score = 0) >= greatest(12, floor(0.08 * count(*))) AS triggered FROM assigned GROUP BY batch")
def gap_trigger(spark, d):
    gaps = F.count_if(F.col("score") == 0)
    return _assigned(spark, d).groupBy("batch").agg(gaps.alias("n_gaps"), (gaps >= F.greatest(F.lit(12), F.floor(0.08 * F.count(F.lit(1))))).alias("triggered"))


# ---- generic joins and aggregates on the star schema --------------------------------------------------------------


@query("SELECT l_returnflag, l_linestatus, sum(CAST(round(l_quantity) AS BIGINT))::BIGINT AS sum_qty, count(*)::BIGINT AS n_lines, count(DISTINCT l_orderkey)::BIGINT AS n_orders, max(l_shipdate) AS last_shipdate FROM lineitem WHERE l_shipdate <= DATE '1998-09-02' GROUP BY ALL")
def pricing_summary(spark, d):
    li = table(spark, d, "lineitem").where("l_shipdate <= date'1998-09-02'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.round("l_quantity").cast("bigint")).alias("sum_qty"), F.count(F.lit(1)).alias("n_lines"), F.count_distinct("l_orderkey").alias("n_orders"), F.max("l_shipdate").alias("last_shipdate"))


@query("SELECT r_name, n_name, count(*)::BIGINT AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def star_join(spark, d):
    dims = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    per_customer = table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return per_customer.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.sum("n").alias("n_orders")).join(dims, F.col("c_nationkey") == F.col("n_nationkey")).select("r_name", "n_name", "n_orders")


# ---- passages -----------------------------------------------------------------------------------------------------


def _display(x: str) -> str:
    t = _clean(x)
    for a, b in passages.ENTITIES:
        t = f"replace({t}, '{a}', '{b.replace(chr(39), chr(39) * 2)}')"
    for _, p in passages.MARKUP:
        t = f"regexp_replace({t}, '{p}', ' ', 'g')"
    t = f"regexp_replace(regexp_replace({t}, '{passages._HIDDEN}', '', 'g'), '\\s+', ' ', 'g')"
    t = f"regexp_replace({t}, ' ([，。！？；：、,.!?;:])', '\\1', 'g')"
    return f"trim({t}, '{passages._EDGE}')"


@query(f"SELECT id, {_display('body')} AS excerpt FROM normalized_sources")
def display_clean(spark, d):
    return table(spark, d, "normalized_sources").select("id", passages.display(F.col("body")).alias("excerpt"))


@query("SELECT id, regexp_matches(coalesce(body, ''), '" + "|".join(f"(?:{p})" for _, p in passages.MARKUP) + "') AS has_markup FROM normalized_sources")
def display_has_markup(spark, d):
    return table(spark, d, "normalized_sources").select("id", passages.has_markup(F.col("body")).alias("has_markup"))


_NOTES = [("site line", "来源：[^\n]{0,20}"), ("copyright", "版权声明|Copyright"), ("call", "扫码关注|点个关注|下载[^\n]{0,12}客户端")]


@query("SELECT id, CASE " + " ".join(f"WHEN regexp_matches(b, '{p}') THEN '{n}'" for n, p in _NOTES) + " ELSE '' END AS label, CASE " + " ".join(f"WHEN regexp_matches(b, '{p}') THEN regexp_extract(b, '{p}')" for _, p in _NOTES) + " ELSE '' END AS found FROM (SELECT id, coalesce(body, '') AS b FROM normalized_sources)")
def first_labelled_pattern(spark, d):
    return table(spark, d, "normalized_sources").select("id", passages.first_pattern(F.coalesce("body", F.lit("")), _NOTES).alias("m")).select("id", "m.label", "m.found")


@query(rf"""SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({_clean('title')}), '“[^”]*”|"[^"]*"|‘[^’]*’', '<q>', 'g'), '\b[0-9a-f]{{12,}}\b', '<id>', 'g'), '[0-9]+', '#', 'g'), '\s+', '', 'g') AS fingerprint FROM normalized_sources""")
def reason_fingerprint(spark, d):
    return table(spark, d, "normalized_sources").select("id", passages.reason_fingerprint(F.col("title")).alias("fingerprint"))


@query()
def excerpt_segments(spark, d):
    """Segments with the check that they give the text again."""
    s = source_rows(spark, d)
    parts = passages.segments(s, "text", ["id"])
    whole = parts.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_no", "segment"))), lambda x: x.segment), "").alias("joined"))  # one text's segments
    return parts.join(whole.join(s.select("id", "text"), "id").select("id", (F.col("joined") == F.col("text")).alias("lossless")), "id")


@query()
def candidate_windows(spark, d):
    """The three best windows of each source that don't lie in each other."""
    s = source_rows(spark, d).select("id", "batch", "text")
    w = passages.windows(s, 3)
    scored = w.select("id", "start", "end", (F.regexp_count("fragment", F.lit(T.POSITIVE)) * 3 + F.regexp_count("fragment", F.lit(T.NEGATIVE)) * 3).alias("score")).where("score > 0")
    return passages.not_contained(scored)


@query()
def best_window(spark, d):
    return passages.best_windows(source_rows(spark, d).select("id", "batch", "text"), table(spark, d, "batches"), f"{T.POSITIVE}|{T.NEGATIVE}")


_WORKS = "电视剧|电影|综艺|导演|主演|原著|片名|剪辑|摄影|同样是写|比上一部"


@query(f"""WITH {_SOURCES}, w AS (SELECT id, batch, {_clean('text')} AS t, unnest(list_distinct(regexp_extract_all({_clean('text')}, '《([^》]{{1,40}})》', 1))) AS work FROM sources),
p AS (SELECT w.id, w.t, w.work, {_norm('w.work')} AS key, list_filter(list_transform(b.strong_terms, lambda x: {_norm('x')}), lambda x: x <> '') AS known, strpos(w.t, '《' || w.work || '》') AS pos FROM w JOIN batches b USING (batch))
SELECT id, work AS title FROM p WHERE key <> '' AND len(list_filter(known, lambda n: contains(n, key) OR contains(key, n))) = 0 AND regexp_matches(substring(t, greatest(pos - 28, 1), length(work) + 2 + least(pos - 1, 28) + 28), '{_WORKS}')""")
def other_work_titles(spark, d):
    s = source_rows(spark, d).join(small(table(spark, d, "batches").select("batch", "strong_terms")), "batch").select("id", "text", "strong_terms")
    return passages.other_titles(s, F.col("strong_terms"), _WORKS)


@query("WITH s AS (SELECT id, coalesce(body, '') AS body, coalesce(title, '') AS title FROM normalized_sources), p AS (SELECT *, strpos(body, title) - 1 AS a FROM s) SELECT id, coalesce(a >= 0 AND a + length(title) <= length(body) AND substring(body, a + 1, length(title)) = title, false) AS valid FROM p")
def fragment_validation(spark, d):
    s = table(spark, d, "normalized_sources").select("id", F.coalesce("body", F.lit("")).alias("body"), F.coalesce("title", F.lit("")).alias("title"))
    a = F.instr("body", F.col("title")) - 1
    return s.select("id", passages.valid_positions(F.col("body"), F.col("title"), a, a + F.length("title")).alias("valid"))


@query("WITH a AS (SELECT l_orderkey AS k, list(struct_pack(s := l_linenumber, e := l_linenumber + CAST(floor(l_quantity / 20) AS INT))) AS w FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), b AS (SELECT l_orderkey AS k, list(struct_pack(s := l_linenumber, e := l_linenumber + 2)) AS w FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) SELECT a.k AS l_orderkey, len(list_filter(a.w, lambda x: len(list_filter(b.w, lambda y: greatest(x.s, y.s) < least(x.e, y.e))) > 0)) > 0 AS overlaps FROM a JOIN b USING (k)")
def window_overlap(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", F.col("l_linenumber").alias("start"), "l_quantity")
    side = lambda flag, end, name: li.where(F.col("l_returnflag") == flag).groupBy("l_orderkey").agg(F.collect_list(F.struct("start", end.alias("end"))).alias(name))
    a = side("R", F.col("start") + F.floor(F.col("l_quantity") / 20).cast("int"), "a")  # bounded: the lines of one order
    b = side("N", F.col("start") + 2, "b")
    return a.join(b, "l_orderkey").select("l_orderkey", evidence.overlap(F.col("a"), F.col("b")).alias("overlaps"))


@query("WITH f AS (SELECT batch, min(id) AS first_id FROM normalized_sources GROUP BY batch) SELECT batch, row_number() OVER (ORDER BY first_id)::BIGINT AS place FROM f")
def first_seen_batches(spark, d):
    from pyspark.sql.window import Window

    f = table(spark, d, "normalized_sources").groupBy("batch").agg(F.min("id").alias("first_id"))
    return f.select("batch", F.row_number().over(Window.orderBy("first_id")).cast("bigint").alias("place"))  # one row a batch


@query("WITH t AS (SELECT batch, unnest(strong_terms) AS term, unnest(range(1, len(strong_terms) + 1)) AS k, auxiliary_terms FROM batches), o AS (SELECT batch, term, min(k) AS k FROM t WHERE length(" + _norm("term") + ") >= 2 AND NOT list_contains(auxiliary_terms, term) GROUP BY batch, term), r AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY k) AS n FROM o) SELECT b.batch, coalesce(string_agg(r.term, '|' ORDER BY r.n), '') AS terms FROM batches b LEFT JOIN r ON r.batch = b.batch AND r.n <= 4 GROUP BY b.batch")
def effective_terms(spark, d):
    ok = F.filter("strong_terms", lambda t: F.length(T.normalized(t)) >= 2)
    return table(spark, d, "batches").select("batch", F.array_join(F.slice(F.array_except(F.array_distinct(ok), F.coalesce("auxiliary_terms", F.array().cast("array<string>"))), 1, 4), "|").alias("terms"))


@query("SELECT batch, 'no weak terms' AS issue FROM batches WHERE weak_terms IS NULL OR len(weak_terms) = 0 UNION ALL SELECT batch, 'no strong terms' FROM batches WHERE strong_terms IS NULL OR len(strong_terms) = 0 UNION ALL SELECT batch, 'layers overlap' FROM batches WHERE len(list_intersect(strong_terms, coalesce(weak_terms, []))) > 0 UNION ALL SELECT batch, 'open period' FROM batches WHERE period_end IS NULL")
def definition_violations(spark, d):
    b = table(spark, d, "batches")
    none = F.array().cast("array<string>")
    parts = [("no weak terms", F.size(F.coalesce("weak_terms", none)) == 0), ("no strong terms", F.size(F.coalesce("strong_terms", none)) == 0), ("layers overlap", F.arrays_overlap("strong_terms", F.coalesce("weak_terms", none))), ("open period", F.col("period_end").isNull())]
    return checks.violations(*((name, b.where(test), F.col("batch")) for name, test in parts)).select(F.col("key").alias("batch"), F.col("check").alias("issue"))


@query()
def diverse_sample(spark, d):
    return passages.varied(source_rows(spark, d).select("id", "batch", "text"), "batch", 4)


@query(f"WITH {_ASSIGNED}, r AS (SELECT id, batch, row_number() OVER (PARTITION BY batch ORDER BY score DESC, len DESC, id DESC) AS k, count(*) OVER (PARTITION BY batch) AS n FROM assigned) SELECT id, batch, CASE WHEN k <= 4 THEN 'strongest' ELSE 'weakest' END AS stands_for FROM r WHERE k <= 4 OR k > n - 2")
def representative_members(spark, d):
    return passages.representatives(_assigned(spark, d), "batch", 4, 2, ["score", "len", "id"]).select("id", "batch", "stands_for")


@query("SELECT coalesce(batch, '') AS batch, coalesce(post_type, '') AS post_type, count(*)::BIGINT AS n, count(DISTINCT author)::BIGINT AS n_authors FROM normalized_sources GROUP BY ROLLUP (batch, post_type)")
def rollup_counts(spark, d):
    r = table(spark, d, "normalized_sources").rollup("batch", "post_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("author").alias("n_authors"))
    return r.select(F.coalesce("batch", F.lit("")).alias("batch"), F.coalesce("post_type", F.lit("")).alias("post_type"), "n", "n_authors")


# ---- more of the review and page operators ------------------------------------------------------------------------


@query(f"WITH {_RANKED}, top AS (SELECT a.id, a.batch, a.cluster, a.score, a.score - coalesce(b.score, 0) AS margin FROM k a LEFT JOIN k b ON a.id = b.id AND b.n = 2 WHERE a.n = 1), first AS (SELECT id, cluster FROM (SELECT *, row_number() OVER (PARTITION BY batch, cluster ORDER BY score DESC, id DESC) AS p FROM top) WHERE p <= 5) SELECT id, cluster, margin FROM top WHERE margin < 6 AND (id, cluster) IN (SELECT id, cluster FROM first)")
def low_confidence_semi(spark, d):
    top = _assigned(spark, d)
    first = first_of(top, ["batch", "cluster"], 5, F.desc("score"), F.desc("id")).select("id", "cluster")
    return top.where("margin < 6").join(first, ["id", "cluster"], "left_semi").select("id", "cluster", "margin")


_NAME = "SELECT b.batch, list_extract(b.strong_terms, 1) AS name FROM batches b"


@query(f"WITH n AS ({_NAME}) SELECT s.id, len(list_filter(regexp_extract_all(coalesce(s.body, ''), '#[^#\\n\\r]{{2,40}}#'), lambda t: contains(t, n.name) AND t <> n.name)) > 0 AS inside_topic FROM normalized_sources s JOIN n USING (batch)")
def topic_interior(spark, d):
    """Whether a source names its work inside of a topic, where taking the name alone would hide that it was a topic."""
    n = table(spark, d, "batches").select("batch", F.col("strong_terms")[0].alias("name"))
    s = table(spark, d, "normalized_sources").join(small(n), "batch")
    tags = F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit(r"#[^#\n\r]{2,40}#"), F.lit(0))
    return s.select("id", F.exists(tags, lambda t: F.contains(t, F.col("name")) & (t != F.col("name"))).alias("inside_topic"))


@query("SELECT id, coalesce(array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(coalesce(body, ''), '@([一-鿿A-Za-z0-9_-]{1,20})', 1)), lambda m: m <> coalesce(author, ''))), '|'), '') AS mentions FROM normalized_sources")
def entity_mentions(spark, d):
    found = F.array_distinct(F.regexp_extract_all(F.coalesce("body", F.lit("")), F.lit("@([一-鿿A-Za-z0-9_-]{1,20})"), F.lit(1)))
    return table(spark, d, "normalized_sources").select("id", F.array_join(F.array_sort(F.array_except(found, F.array(F.coalesce("author", F.lit(""))))), "|").alias("mentions"))


@query("SELECT batch, count(*)::BIGINT AS n_sources, count(*) FILTER (WHERE id IN (SELECT source_id FROM review_labels))::BIGINT AS n_reviewed, count(*) = count(*) FILTER (WHERE id IN (SELECT source_id FROM review_labels)) AS complete FROM normalized_sources GROUP BY batch")
def review_completeness(spark, d):
    seen = table(spark, d, "review_labels").select(F.col("source_id").alias("id"), F.lit(True).alias("seen")).distinct()
    s = table(spark, d, "normalized_sources").select("id", "batch").join(seen, "id", "left")
    n = s.groupBy("batch").agg(F.count(F.lit(1)).alias("n_sources"), F.count("seen").alias("n_reviewed"))
    return n.withColumn("complete", F.col("n_sources") == F.col("n_reviewed"))


_PRIORITY = "CASE channel WHEN '境内新闻' THEN 5 WHEN '公众文章' THEN 4 WHEN '今日头条' THEN 3 WHEN '微博' THEN 2 WHEN '小红书' THEN 1 ELSE 0 END"


@query(lambda: f"""WITH {_SOURCES}, q AS ({ORACLES['quality_score']}), r AS (SELECT s.id, s.batch, coalesce(n.certification_info LIKE '%官方账号', false)::INT AS media, CASE s.channel WHEN '境内新闻' THEN 5 WHEN '公众文章' THEN 4 WHEN '今日头条' THEN 3 WHEN '微博' THEN 2 WHEN '小红书' THEN 1 ELSE 0 END AS priority,
({_polarity('s.text')} <> 'neutral')::INT AS core, q.quality, length({_norm('s.text')}) AS len FROM sources s JOIN normalized_sources n USING (id) JOIN q USING (id))
SELECT id, batch, row_number() OVER (PARTITION BY batch ORDER BY media DESC, priority DESC, core DESC, quality DESC, len DESC, id DESC)::BIGINT AS place FROM r""")
def rank_order(spark, d):
    """Sources of each batch by medium, channel, stance of their own, quality, length and id."""
    n = table(spark, d, "normalized_sources").select("id", F.coalesce(F.col("certification_info").endswith("官方账号"), F.lit(False)).alias("media"))
    s = source_rows(spark, d).select("id", "batch", F.expr(_PRIORITY).alias("priority"), (T.polarity(F.col("text")) != "neutral").alias("core"), F.length(T.normalized(F.col("text"))).alias("len"))
    r = s.join(n, "id").join(quality_score(spark, d), "id")
    return ranked(r, ["batch"], *(F.desc(c) for c in ("media", "priority", "core", "quality", "len", "id"))).select("id", "batch", "place")


@query(f"WITH {_ASSIGNED}, r AS (SELECT id, batch, cluster, {_PRIORITY} AS priority, row_number() OVER (PARTITION BY batch, cluster ORDER BY score DESC, len DESC, id DESC) AS position FROM assigned), w AS (SELECT *, lag(priority) OVER (PARTITION BY batch, cluster ORDER BY position) AS b FROM r) SELECT id, batch, cluster FROM w WHERE priority > b")
def media_order_violations(spark, d):
    """Sources that stand in their cluster below one of a lower channel priority."""
    a = _assigned(spark, d).withColumn("priority", F.expr(_PRIORITY))
    placed = ranked(a, ["batch", "cluster"], F.desc("score"), F.desc("len"), F.desc("id"), name="position").withColumn("group", F.struct("batch", "cluster"))
    return checks.rises(placed, "group", ["position"], "priority").select("id", "batch", "cluster")


@query(" UNION ALL ".join(f"SELECT batch, '{n}' AS layer, k::BIGINT AS place, term, {w}::DOUBLE AS weight FROM (SELECT batch, unnest({c}) AS term, unnest(range(1, len({c}) + 1)) AS k FROM batches WHERE {c} IS NOT NULL)" for n, c, w in _WEIGHTS))
def term_layers(spark, d):
    """The nested layers of terms of each batch, flattened."""
    e = definitions(spark, d).select("batch", F.col("cluster").alias("layer"), F.posexplode("keywords").alias("_k", "w"))
    return e.select("batch", "layer", (F.col("_k") + 1).cast("bigint").alias("place"), "w.term", "w.weight")


@query(ORACLES["rule_gate"].replace("SELECT id, split_part(r, ':', 1) AS decision, split_part(r, ':', 2) AS reason FROM g", "SELECT split_part(r, ':', 1) AS decision, split_part(r, ':', 2) AS reason, count(*)::BIGINT AS n FROM g GROUP BY ALL"))
def gate_summary(spark, d):
    return rule_gate(spark, d).groupBy("decision", "reason").agg(F.count(F.lit(1)).alias("n"))


@query()
def review_chunks(spark, d):
    """Chunks of a batch's review queue, bounded in rows and in bytes."""
    from millrace.sources.files import chunked

    s = table(spark, d, "normalized_sources").select("batch", "id", "body")
    return chunked(s, "batch", "id", "body").select("batch", "id", "chunk_no")


# ---- facts, evidence and scores -----------------------------------------------------------------------------------


@query(f"WITH {_SOURCES} SELECT id, NOT regexp_matches(c, '扫码|关注|下载|点个|转发|抽奖|优惠|包邮') AND regexp_matches(c, '{T.POSITIVE}|{T.NEGATIVE}') AS stands_alone FROM (SELECT id, {_clean('text')} AS c FROM sources)")
def promotion_independence(spark, d):
    return source_rows(spark, d).select("id", T.stands_alone(F.col("text")).alias("stands_alone"))


@query(f"""WITH {_SOURCES}, c AS (SELECT id, {_clean('text')} AS c FROM sources)
SELECT id, concat_ws('|', 'schedule_announcement', CASE WHEN regexp_matches(c, '\\d{{1,2}}月\\d{{1,2}}日|\\d{{4}}[-/.年]\\d{{1,2}}[-/.月]\\d{{1,2}}') THEN 'airing_date' END, CASE WHEN regexp_matches(c, '\\d{{1,2}}[：:]\\d{{2}}|晚间|黄金档') THEN 'airing_time' END,
CASE WHEN regexp_matches(c, '(?i)腾讯视频|爱奇艺|优酷|芒果TV|CCTV-?\\d+|央视|卫视|双平台|多平台') THEN 'airing_platform' END, CASE WHEN regexp_matches(c, '(?i)每日|每周[一二三四五六日天]|日更|连更|首更|更新\\d+集|会员|VIP') THEN 'update_cadence' END) AS facets FROM c""")
def schedule_facets(spark, d):
    return source_rows(spark, d).select("id", F.array_join(T.fact_facets(F.col("text")), "|").alias("facets"))


@query(f"""WITH {_SOURCES}, s AS (SELECT id, {_polarity('text')} AS whole, {_polarity('title')} AS own FROM sources), e AS (SELECT id, own, CASE whole WHEN 'neutral' THEN 'objective' ELSE whole END AS expected FROM s)
SELECT id, CASE expected WHEN 'objective' THEN own = 'neutral' ELSE own = expected END AS supports, CASE expected WHEN 'positive' THEN own = 'negative' WHEN 'negative' THEN own = 'positive' ELSE own <> 'neutral' END AS conflicts FROM e""")
def stance_evidence(spark, d):
    """Whether a source's title is worded as the source's stance is."""
    s = source_rows(spark, d).select("id", "title", T.polarity(F.col("text")).alias("w"))
    expected = F.when(F.col("w") == "neutral", "objective").otherwise(F.col("w"))
    return s.select("id", T.supports(expected, F.col("title")).alias("supports"), T.conflicts(expected, F.col("title")).alias("conflicts"))


_BASE = "CASE channel WHEN '境内新闻' THEN 3.5 WHEN '公众文章' THEN 3.5 WHEN '今日头条' THEN 2.5 WHEN '微博' THEN 1.0 WHEN '小红书' THEN 0.5 WHEN '抖音' THEN -2.0 ELSE 0.0 END"


@query(f"""WITH {_SOURCES}, f AS (SELECT id, channel, length({_norm('text')}) AS n, {_count('text', T.POSITIVE + '|' + T.NEGATIVE)} AS opinion, {_count('text', T.PROMOTION)} AS calls FROM sources)
SELECT id, CAST(round((CAST({_BASE} AS DOUBLE) + {_BANDS} + least(5.0::DOUBLE, opinion * 0.55::DOUBLE) - least(5.0::DOUBLE, calls * 1.35::DOUBLE)) * 1000) AS BIGINT) AS quality FROM f""")
def quality_score(spark, d):
    """Channel and length, words of opinion up to a cap, calls to act taken off up to a cap; in thousandths."""
    s = source_rows(spark, d)
    n = lambda p: F.regexp_count("text", F.lit(p))
    score = T.capped_sum(F.expr(_BASE).cast("double") + T.length_score(F.length(T.normalized(F.col("text")))), (n(f"{T.POSITIVE}|{T.NEGATIVE}"), 0.55, 5.0), (n(T.PROMOTION), -1.35, 5.0))
    return s.select("id", F.round(score * 1000).cast("bigint").alias("quality"))


# ---- health of links ----------------------------------------------------------------------------------------------

_HEALTH = "health AS (SELECT url, CASE ascii(substring(md5(url), 1, 1)) % 5 WHEN 0 THEN 'reachable' WHEN 1 THEN 'confirmed_dead' WHEN 2 THEN 'blocked' WHEN 3 THEN 'indeterminate' ELSE 'gone' END AS classification, CASE WHEN ascii(substring(md5(url), 2, 1)) % 2 = 0 THEN 404 ELSE 200 END AS status_code FROM normalized_sources WHERE url IS NOT NULL AND ascii(substring(md5(url), 3, 1)) % 3 > 0)"


def _health(spark, d):
    """A table of link health with what can be wrong in one; no link is looked up."""
    h = lambda k: F.ascii(F.substring(F.md5("url"), k, 1))
    kind = F.element_at(F.array(*map(F.lit, ("reachable", "confirmed_dead", "blocked", "indeterminate", "gone"))), h(1) % 5 + 1)
    return table(spark, d, "normalized_sources").where(F.col("url").isNotNull() & (h(3) % 3 > 0)).select("url", kind.alias("classification"), F.when(h(2) % 2 == 0, 404).otherwise(200).alias("status_code"))


@query(f"""WITH {_HEALTH} SELECT '' AS url, 'empty url' AS issue FROM health WHERE url = '' UNION ALL SELECT url, 'repeated url' FROM health WHERE url <> '' GROUP BY url HAVING count(*) > 1
UNION ALL SELECT url, 'unknown class' FROM health WHERE classification NOT IN ('reachable', 'confirmed_dead', 'indeterminate', 'blocked', 'invalid') UNION ALL SELECT url, 'dead without 404 or 410' FROM health WHERE classification = 'confirmed_dead' AND status_code NOT IN (404, 410)""")
def link_health_violations(spark, d):
    return links.health_violations(_health(spark, d))


@query(f"""WITH {_HEALTH}, h AS (SELECT DISTINCT url, classification FROM health) SELECT id, coalesce(classification, '') AS classification, CASE WHEN classification = 'confirmed_dead' THEN 'exclude' WHEN coalesce(body, '') = '' THEN 'exclude' ELSE 'retain' END AS decision, CASE WHEN classification = 'confirmed_dead' THEN 'dead link' ELSE 'decision' END AS basis FROM normalized_sources LEFT JOIN h USING (url)""")
def link_health_join(spark, d):
    s = table(spark, d, "normalized_sources").select("id", "url", F.when(F.coalesce("body", F.lit("")) == "", "exclude").otherwise("retain").alias("decision"))
    return links.with_health(s, _health(spark, d)).select("id", "classification", "decision", "basis")


@query(f"""WITH {_HEALTH}, h AS (SELECT DISTINCT url, classification FROM health), n AS (SELECT url, count(*) AS n FROM normalized_sources WHERE url <> '' GROUP BY url) SELECT coalesce(classification, 'unchecked') AS classification, count(*)::BIGINT AS n_urls, sum(n)::BIGINT AS n_references FROM n LEFT JOIN h USING (url) GROUP BY 1""")
def link_class_counts(spark, d):
    return links.by_class(table(spark, d, "normalized_sources").select("url"), _health(spark, d))


# ---- routing with answers, caches and what is shown ---------------------------------------------------------------

_LATEST = f"{_LEDGER}, over AS (SELECT source_id AS id, CASE abusive WHEN 0 THEN 'auxiliary' END AS cluster FROM ledger WHERE tab = 'normalized_sources')"


def _overrides(spark, d):
    """An answer of 0 moves a source to one cluster, others take it out."""
    return ledger_upsert(spark, d).where("tab = 'normalized_sources'").select(F.col("source_id").alias("id"), F.when(F.col("abusive") == 0, "auxiliary").alias("cluster"))


@query(f"WITH {_ASSIGNED}, {_LATEST} SELECT a.id, CASE WHEN o.id IS NULL THEN a.cluster ELSE o.cluster END AS cluster, CASE WHEN o.id IS NULL THEN 'automatic' WHEN o.cluster IS NULL THEN 'excluded' ELSE 'override' END AS basis FROM assigned a LEFT JOIN over o USING (id)")
def override_join(spark, d):
    return routing.with_overrides(_assigned(spark, d).select("id", "cluster"), _overrides(spark, d)).select("id", "cluster", "basis")


@query(f"WITH {_RANKED} SELECT id, cluster, 'primary' AS role FROM k WHERE n = 1 UNION ALL SELECT b.id, b.cluster, 'secondary' FROM k b JOIN k a ON a.id = b.id AND a.n = 1 WHERE b.n = 2 AND b.score > 0 AND b.score >= 0.5::DOUBLE * a.score")
def secondary_cluster(spark, d):
    return routing.with_secondary(routing.routed(source_rows(spark, d), definitions(spark, d), ["id"]))


@query(f"""WITH {_SOURCES}, p AS (SELECT id, substring(sha256(concat_ws('|', batch, title, text)), 1, 16) AS row_print, substring(sha256(array_to_string(b.strong_terms, '|')), 1, 16) AS contract FROM sources JOIN batches b USING (batch)),
c AS (SELECT DISTINCT id, CASE WHEN ascii(substring(id, 2, 1)) % 4 = 0 THEN 'old' ELSE row_print END AS row_print, contract FROM p WHERE ascii(substring(id, 1, 1)) % 2 = 0 AND ascii(substring(id, 3, 1)) % 5 > 0)
SELECT p.id, c.id IS NOT NULL AS hit FROM p LEFT JOIN c ON p.id = c.id AND p.row_print = c.row_print AND p.contract = c.contract""")
def routing_cache(spark, d):
    """What of the routing could be taken from a cache that holds some rows, some of them as they were or of another version."""
    b = table(spark, d, "batches").select("batch", F.substring(F.sha2(F.array_join("strong_terms", "|"), 256), 1, 16).alias("contract"))
    s = source_rows(spark, d).join(small(b), "batch").select("id", F.substring(F.sha2(F.concat_ws("|", "batch", "title", "text"), 256), 1, 16).alias("row_print"), "contract")
    a = lambda k: F.ascii(F.substring("id", k, 1))
    cache = s.where(a(1) % 2 == 0).select("id", F.when(a(2) % 4 == 0, "old").otherwise(F.col("row_print")).alias("row_print"), "contract", F.when(a(3) % 5 > 0, 3).otherwise(2).alias("cache_version"))
    return routing.from_cache(s, cache, 3)


@query(f"WITH {_ASSIGNED}, {_LATEST}, x AS (SELECT id FROM over WHERE cluster IS NULL) SELECT batch, cluster, count(*)::BIGINT AS n_assigned, count(*) FILTER (WHERE id NOT IN (SELECT id FROM x))::BIGINT AS n_kept, count(*) FILTER (WHERE id IN (SELECT id FROM x))::BIGINT AS n_dropped FROM assigned GROUP BY batch, cluster")
def display_coverage(spark, d):
    return routing.display_coverage(_assigned(spark, d).select("id", "batch", "cluster"), _overrides(spark, d).where("cluster is null"), "batch", "cluster")


@query(f"WITH {_RANKED}, top AS (SELECT a.id, a.batch, a.cluster, a.score - coalesce(b.score, 0) AS margin FROM k a LEFT JOIN k b ON a.id = b.id AND b.n = 2 WHERE a.n = 1), r AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY margin, id) AS place FROM top) SELECT id, batch, cluster, place::BIGINT AS place FROM r WHERE place <= 60")
def residual_queue(spark, d):
    """The sixty sources of each batch whose cluster is least certain, for review."""
    return first_of(_assigned(spark, d), ["batch"], 60, F.col("margin"), F.col("id")).select("id", "batch", "cluster", F.col("place").cast("bigint").alias("place"))


@query(f"WITH {_ASSIGNED}, s AS (SELECT batch, cluster, CASE WHEN avg(score) > 0 THEN 'scored' ELSE 'unscored' END AS stance, min(def_idx) AS def_idx FROM (SELECT a.*, d.def_idx FROM assigned a JOIN defs d USING (batch, cluster)) GROUP BY batch, cluster) SELECT batch, cluster, stance, row_number() OVER (PARTITION BY batch, stance ORDER BY def_idx)::BIGINT AS number FROM s")
def stance_numbering(spark, d):
    """Clusters numbered within their tab in the order of the definitions."""
    order = definitions(spark, d).select("batch", "cluster", "def_idx")
    c = _assigned(spark, d).groupBy("batch", "cluster").agg(F.when(F.avg("score") > 0, "scored").otherwise("unscored").alias("stance")).join(small(order), ["batch", "cluster"])
    return ranked(c, ["batch", "stance"], F.col("def_idx"), name="number").select("batch", "cluster", "stance", "number")


_HTML = lambda x: f"replace(replace(replace(replace(replace(coalesce({x}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')"


@query(f"SELECT id, regexp_replace({_HTML('title')}, '(no\\.)', '<mark>\\1</mark>', 'gi') AS html FROM normalized_sources")
def highlight(spark, d):
    return table(spark, d, "normalized_sources").select("id", passages.highlighted(F.col("title"), "No.").alias("html"))


@query(f"""WITH {_SOURCES}, s AS (SELECT x.id, string_split(x.text, '。') AS segs, list_filter(b.strong_terms, lambda t: t <> '') AS terms FROM sources x JOIN batches b USING (batch)),
h AS (SELECT id, segs, list_position(list_transform(segs, lambda g: len(list_filter(terms, lambda t: contains(g, t))) > 0), true) AS first FROM s)
SELECT id, coalesce(array_to_string(list_filter(list_transform(range(1, greatest(coalesce(first, 1), 1)), lambda i: CASE WHEN regexp_matches(segs[i], '路透|花絮|热搜') THEN i - 1 END), lambda i: i IS NOT NULL), ','), '') AS leading FROM h""")
def leading_unrelated(spark, d):
    """Sentences before the first one that names the work and that speak of something else."""
    b = table(spark, d, "batches").select("batch", F.filter("strong_terms", lambda t: t != "").alias("terms"))
    s = source_rows(spark, d).join(small(b), "batch").select("id", F.split("text", "。").alias("segs"), "terms")
    return s.select("id", F.array_join(passages.leading_unrelated(F.col("segs"), F.col("terms"), "路透|花絮|热搜").cast("array<string>"), ",").alias("leading"))


_VERSIONS = [("both", ["标题", "正文内容"]), ("content", ["标题", "内容"]), ("title", ["标题"])]


@query("WITH k AS (SELECT json_keys(data) AS k FROM records) SELECT CASE WHEN list_contains(k, '标题') AND list_contains(k, '正文内容') THEN 'both' WHEN list_contains(k, '标题') AND list_contains(k, '内容') THEN 'content' WHEN list_contains(k, '标题') THEN 'title' ELSE 'unknown' END AS version, count(*)::BIGINT AS n FROM k GROUP BY 1")
def schema_version_counts(spark, d):
    return checks.schema_counts(table(spark, d, "records"), "data", _VERSIONS)


# ---- answers: filled in, asked for, chunk by chunk ----------------------------------------------------------------

_ANSWERS = """a AS (SELECT source_id AS id, review_id, CASE abusive WHEN 1 THEN 'exclude' ELSE 'retain' END AS decision, CASE WHEN reviewer < 'r3' THEN '' ELSE reviewer END AS reason, CASE WHEN review_id % 3 = 0 THEN 'stale' ELSE 'now' END AS binding FROM review_labels WHERE tab = 'normalized_sources')"""


@query(f"""WITH {_ANSWERS}, i AS (SELECT id, CASE WHEN length(coalesce(body, '')) < 400 THEN 'exclude' ELSE 'retain' END AS auto_decision, 'short: ' || coalesce(channel, '') AS auto_reason FROM normalized_sources)
SELECT a.id, a.decision, CASE WHEN binding = 'now' AND decision = 'exclude' AND auto_decision = 'exclude' AND trim(coalesce(reason, '')) = '' THEN coalesce(auto_reason, '') ELSE coalesce(reason, '') END AS reason FROM a LEFT JOIN i USING (id)""")
def answer_expansion(spark, d):
    answers = table(spark, d, "review_labels").where("tab = 'normalized_sources'").select(F.col("source_id").alias("id"), F.when(F.col("abusive") == 1, "exclude").otherwise("retain").alias("decision"), F.when(F.col("reviewer") < "r3", "").otherwise(F.col("reviewer")).alias("reason"), F.when(F.col("review_id") % 3 == 0, "stale").otherwise("now").alias("binding"))
    items = table(spark, d, "normalized_sources").select("id", F.when(F.length(F.coalesce("body", F.lit(""))) < 400, "exclude").otherwise("retain").alias("auto_decision"), F.concat(F.lit("short: "), F.coalesce("channel", F.lit(""))).alias("auto_reason"))
    return reviews.expanded(answers, items, "now")


@query("SELECT id, batch, '' AS decision, '' AS reason FROM normalized_sources WHERE id NOT IN (SELECT source_id FROM review_labels WHERE tab = 'normalized_sources')")
def submission_template(spark, d):
    return reviews.template(table(spark, d, "normalized_sources").select("id", "batch"), _answers(spark, d), {"decision": "", "reason": ""})


_CHUNKS = """WITH RECURSIVE r AS (SELECT batch, id, strlen(coalesce(body, '')) AS b, row_number() OVER (PARTITION BY batch ORDER BY id) AS k FROM normalized_sources),
c AS (SELECT batch, id, k, b AS bytes, 1 AS n, 0 AS chunk_no FROM r WHERE k = 1 UNION ALL
SELECT r.batch, r.id, r.k, CASE WHEN c.n >= 60 OR c.bytes + r.b > 120000 THEN r.b ELSE c.bytes + r.b END, CASE WHEN c.n >= 60 OR c.bytes + r.b > 120000 THEN 1 ELSE c.n + 1 END, CASE WHEN c.n >= 60 OR c.bytes + r.b > 120000 THEN c.chunk_no + 1 ELSE c.chunk_no END
FROM c JOIN r ON r.batch IS NOT DISTINCT FROM c.batch AND r.k = c.k + 1)"""
ORACLES["review_chunks"] = f"{_CHUNKS} SELECT batch, id, chunk_no::INT AS chunk_no FROM c"


@query(f"{_CHUNKS}, p AS (SELECT id FROM normalized_sources WHERE id NOT IN (SELECT source_id FROM review_labels WHERE tab = 'normalized_sources')), n AS (SELECT batch, chunk_no, count(*) AS n FROM c WHERE id IN (SELECT id FROM p) GROUP BY batch, chunk_no) SELECT batch, min(chunk_no)::INT AS chunk_no, arg_min(n, chunk_no)::BIGINT AS n_pending FROM n GROUP BY batch")
def next_chunk(spark, d):
    """The first chunk of each batch that has unanswered sources."""
    pending = reviews.missing(table(spark, d, "normalized_sources").select("id"), _answers(spark, d))
    return reviews.next_chunk(review_chunks(spark, d), pending, "batch")


_SIZES = f"""{_SOURCES}, s AS (SELECT id, batch, {_polarity('text')} AS stratum, length(text) AS len FROM sources), n AS (SELECT batch, stratum, count(*) AS n FROM s GROUP BY batch, stratum), t AS (SELECT batch, sum(n)::BIGINT AS total, sum(least(n, 20))::BIGINT AS base FROM n GROUP BY batch),
o AS (SELECT n.batch, stratum, sqrt(n::DOUBLE) / (k + 1) AS offer FROM n JOIN t USING (batch), LATERAL (SELECT unnest(range(least(n, 20), least(n, least(n, 20) + greatest(60 - base, 0)))) AS k) WHERE total > 60),
g AS (SELECT batch, stratum, count(*) AS more FROM (SELECT o.*, row_number() OVER (PARTITION BY batch ORDER BY offer DESC, stratum DESC) AS r, base FROM o JOIN t USING (batch)) WHERE r <= 60 - base GROUP BY batch, stratum),
q AS (SELECT n.batch, n.stratum, CASE WHEN total <= 60 THEN n ELSE least(n, 20) + coalesce(more, 0) END AS quota FROM n JOIN t USING (batch) LEFT JOIN g ON g.batch = n.batch AND g.stratum = n.stratum)"""
ORACLES["stratified_quota"] = f"WITH {_SIZES} SELECT id, s.batch, s.stratum, place::BIGINT AS place FROM (SELECT *, row_number() OVER (PARTITION BY batch, stratum ORDER BY len DESC, id) AS place FROM s) s JOIN q ON q.batch = s.batch AND q.stratum = s.stratum WHERE place <= quota"
_GREEDY = f"""WITH RECURSIVE {ORACLES['near_dup_pairs'].removeprefix('WITH ').rsplit('SELECT c.batch, left_id', 1)[0].rstrip().rstrip(',')},
near AS (SELECT c.batch, left_id, right_id FROM c JOIN n l ON l.batch = c.batch AND l.id = left_id JOIN n r ON r.batch = c.batch AND r.id = right_id WHERE n_common >= 0.84::DOUBLE * (l.n + r.n - n_common) - 1e-9 OR n_common >= 0.94::DOUBLE * least(l.n, r.n) - 1e-9),
placed AS (SELECT batch, id, norm, row_number() OVER (PARTITION BY batch ORDER BY length(norm) DESC, id DESC) AS k FROM reps),
both_ways AS (SELECT batch, left_id AS a, right_id AS b FROM near UNION ALL SELECT batch, right_id, left_id FROM near),
before AS (SELECT p.batch, p.id, list(q.id ORDER BY q.k) AS nb FROM placed p JOIN both_ways w ON w.batch = p.batch AND w.a = p.id JOIN placed q ON q.batch = p.batch AND q.id = w.b AND q.k < p.k GROUP BY p.batch, p.id),
todo AS (SELECT p.batch, p.id, p.k, coalesce(b.nb, []) AS nb FROM placed p LEFT JOIN before b ON b.batch = p.batch AND b.id = p.id),
walk AS (SELECT batch, id, k, id AS kept_id, [id] AS kept FROM todo WHERE k = 1 UNION ALL
SELECT t.batch, t.id, t.k, coalesce(list_filter(t.nb, lambda x: list_contains(w.kept, x))[1], t.id), CASE WHEN len(list_filter(t.nb, lambda x: list_contains(w.kept, x))) > 0 THEN w.kept ELSE list_append(w.kept, t.id) END FROM walk w JOIN todo t ON t.batch = w.batch AND t.k = w.k + 1)
SELECT p.batch, p.id, coalesce(r.id, p.id) AS representative, coalesce(w.kept_id, p.id) AS kept_id FROM prints p LEFT JOIN reps r ON r.batch = p.batch AND r.norm = p.fingerprint LEFT JOIN walk w ON w.batch = r.batch AND w.id = r.id"""
ORACLES["near_dup_greedy"] = _GREEDY
ORACLES["other_work_titles"] = f"""WITH {_SOURCES}, w AS (SELECT id, batch, {_clean('text')} AS t FROM sources), o AS (SELECT w.id, t, i, list_transform(list_filter(b.strong_terms, lambda x: {_norm('x')} <> ''), lambda x: {_norm('x')}) AS known FROM w JOIN batches b USING (batch), LATERAL (SELECT unnest(range(1, length(t) + 1)) AS i) WHERE substring(t, i, 1) = '《'),
m AS (SELECT id, t, i, known, regexp_extract(substring(t, i, 42), '^《([^》]{{1,40}})》', 1) AS title FROM o)
SELECT DISTINCT id, title FROM m WHERE title <> '' AND {_norm('title')} <> '' AND len(list_filter(known, lambda n: contains(n, {_norm('title')}) OR contains({_norm('title')}, n))) = 0 AND regexp_matches(substring(t, greatest(i - 28, 1), length(title) + 2 + least(i - 1, 28) + 28), '{_WORKS}')"""


@query()
def excerpts(spark, d):
    """The three best excerpts around each source's best window."""
    best = best_window(spark, d).select("id", F.col("start").alias("w_start"), F.col("end").alias("w_end"))
    return passages.excerpt_candidates(source_rows(spark, d).select("id", "text").join(best, "id"), f"{T.POSITIVE}|{T.NEGATIVE}")


@query()
def target_evidence(spark, d):
    """Spans of each source that name its work, to choose from."""
    b = table(spark, d, "batches").select("batch", "strong_terms")
    s = evidence.with_span_lists(source_rows(spark, d), "text", ["id", "batch", "text"]).join(small(b), "batch")
    return s.select("id", F.posexplode(passages.evidence_menu(F.col("spans"), F.col("text"), F.col("strong_terms"))).alias("k", "m")).select("id", "k", "m.start", "m.end", "m.part")


_SAME = "SELECT source_id AS a, lead(source_id) OVER (ORDER BY review_id) AS b, review_id FROM review_labels WHERE tab = 'normalized_sources'"


@query(f"""WITH RECURSIVE {_PRINTS}, fam AS (SELECT id, CASE WHEN fingerprint = '' THEN id ELSE min(id) OVER (PARTITION BY fingerprint) END AS f FROM prints),
pairs AS (SELECT a, b FROM ({_SAME}) WHERE b IS NOT NULL AND review_id % 3 = 0), e AS (SELECT x.f AS p, y.f AS q FROM pairs JOIN fam x ON x.id = a JOIN fam y ON y.id = b), both_ways AS (SELECT p, q FROM e UNION SELECT q, p FROM e),
reach AS (SELECT p, q FROM both_ways UNION SELECT r.p, w.q FROM reach r JOIN both_ways w ON w.p = r.q), least AS (SELECT p, min(q) AS q FROM reach GROUP BY p)
SELECT fam.id, least(fam.f, coalesce(least.q, fam.f)) AS family FROM fam LEFT JOIN least ON least.p = fam.f""")
def copy_families_reviewed(spark, d):
    """Copy families where every third answered pair of sources was reviewed to be one copy."""
    from pyspark.sql.window import Window

    r = table(spark, d, "review_labels").where("tab = 'normalized_sources'").select(F.col("source_id").alias("left_id"), F.lead("source_id").over(Window.partitionBy().orderBy("review_id")).alias("right_id"), "review_id")
    same = r.where("right_id is not null and review_id % 3 = 0").select("left_id", "right_id")
    return dedup.copy_families(prints(spark, d).select("id", "fingerprint"), same)


@query(f"WITH {_SOURCES} SELECT id, CASE WHEN regexp_matches(text, '{T.HUMOUR}') AND NOT regexp_matches(text, '{T.COMPLAINT}') THEN 'positive' ELSE {_polarity('text')} END AS stance FROM sources")
def stance_with_humour(spark, d):
    return source_rows(spark, d).select("id", T.stance(F.col("text"), T.HUMOUR, T.COMPLAINT).alias("stance"))


@query("""WITH t AS (SELECT batch, unnest(strong_terms) AS term, unnest(range(1, len(strong_terms) + 1)) AS k, 0 AS layer, 3.0 AS w FROM batches UNION ALL SELECT batch, unnest(weak_terms), unnest(range(1, len(weak_terms) + 1)), 1, 1.5 FROM batches WHERE weak_terms IS NOT NULL UNION ALL SELECT batch, unnest(auxiliary_terms), unnest(range(1, len(auxiliary_terms) + 1)), 2, 2.0 FROM batches WHERE auxiliary_terms IS NOT NULL),
o AS (SELECT batch, term, max(w) AS w, min(layer * 1000 + k) FILTER (WHERE true) AS k FROM t WHERE length(""" + _norm("term") + """) >= 2 GROUP BY batch, term), s AS (SELECT o.*, row_number() OVER (PARTITION BY o.batch ORDER BY w DESC, k) AS n FROM o JOIN batches b USING (batch) WHERE term <> b.strong_terms[1])
SELECT b.batch, coalesce(string_agg(s.term, '|' ORDER BY s.n), '') AS terms FROM batches b LEFT JOIN s ON s.batch = b.batch AND s.n <= 4 GROUP BY b.batch""")
def weighted_terms(spark, d):
    """The four heaviest terms of each batch, ties in their order, without the work's own name."""
    e = definitions(spark, d).select("batch", "def_idx", F.posexplode("keywords").alias("k", "w")).where(F.length(T.normalized(F.col("w.term"))) >= 2)
    t = e.groupBy("batch", F.col("w.term").alias("term")).agg(F.max("w.weight").alias("weight"), F.min(F.col("def_idx") * 1000 + F.col("k")).alias("k"))
    b = table(spark, d, "batches").select("batch", F.col("strong_terms")[0].alias("name"))
    few = first_of(t.join(small(b), "batch").where("term != name"), ["batch"], 4, F.desc("weight"), F.col("k"))
    joined = few.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("place", "term"))).alias("t"))  # bounded: four terms
    return b.join(joined, "batch", "left").select("batch", F.coalesce(F.array_join(F.transform("t", lambda x: x.term), "|"), F.lit("")).alias("terms"))


@query(f"""WITH {_RANKED}, top AS (SELECT a.id, a.batch, a.cluster, a.score, length(s.text) AS len, a.score - coalesce(b.score, 0) AS margin FROM k a JOIN sources s ON s.id = a.id LEFT JOIN k b ON a.id = b.id AND b.n = 2 WHERE a.n = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY len DESC, id DESC) AS p, row_number() OVER (PARTITION BY batch ORDER BY score, margin, id) AS w, count(*) OVER (PARTITION BY batch) AS n FROM top),
i AS (SELECT *, n <= 8 OR p <= 4 OR w <= 2 AS taken FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY p) AS r, count(*) OVER (PARTITION BY batch) AS m FROM i WHERE NOT taken)
SELECT id, batch FROM i WHERE taken UNION ALL SELECT id, batch FROM r WHERE r <= 6 - (n - m) OR r = m OR r = 6 - (n - m) + round_even((m - (6 - (n - m)) - 1) / 2.0, 0)::BIGINT + 1""")
def spread_members(spark, d):
    """Eight sources that stand for each batch: strongest, weakest and what lies between."""
    a = _assigned(spark, d).select("id", "batch", "score", "margin", "len")
    return passages.spread_members(a, ["batch"], [F.desc("len"), F.desc("id")], [F.asc("score"), F.asc("margin"), F.asc("id")]).select("id", "batch")


@query("""WITH s AS (SELECT id, coalesce(body, '') AS body, coalesce(title, '') AS f1 FROM normalized_sources), p AS (SELECT *, strpos(body, f1) - 1 AS a, strpos(body, '。') - 1 AS c FROM s)
SELECT id, coalesce(a >= 0 AND a + length(f1) <= length(body) AND substring(body, a + 1, length(f1)) = f1 AND c >= 0 AND a + length(f1) <= c, false) AS valid FROM p""")
def fragment_pair_validation(spark, d):
    """Whether the title and a full stop stand in the body, in this order and apart, at the first places of both."""
    s = table(spark, d, "normalized_sources").select("id", F.coalesce("body", F.lit("")).alias("body"), F.coalesce("title", F.lit("")).alias("t"))
    a, c = F.instr("body", F.col("t")) - 1, F.instr("body", F.lit("。")) - 1
    place = lambda x, n: F.struct(x.alias("start"), (x + n).alias("end"))
    return s.select("id", passages.valid_fragments(F.col("body"), F.array("t", F.lit("。")), F.array(place(a, F.length("t")), place(c, F.lit(1)))).alias("valid"))


@query("""WITH n AS (SELECT b.batch, b.strong_terms[1] AS name FROM batches b), s AS (SELECT x.id, coalesce(body, '') AS body, name FROM normalized_sources x JOIN n USING (batch)),
t AS (SELECT id, unnest(range(1, len(p) + 1)) AS k, p FROM (SELECT id, regexp_extract_all(body, '#[^#\n\r]{2,40}#|#|[^#]+') AS p FROM s)), e AS (SELECT id, length(array_to_string(p[1:k], '')) AS e, p[k] AS piece FROM t), h AS (SELECT id, e - length(piece) AS a, e AS b FROM e WHERE regexp_matches(piece, '^#[^#]+#$')),
m AS (SELECT id, strpos(body, name) - 1 AS a, strpos(body, name) - 1 + length(name) AS b FROM s WHERE contains(body, name))
SELECT s.id, s.id IN (SELECT m.id FROM m JOIN h ON h.id = m.id WHERE (m.a > h.a AND m.a < h.b) OR (m.b > h.a AND m.b < h.b)) AS inside FROM s""")
def topic_interior_spans(spark, d):
    """Whether the first place where a source names its work lies inside of a topic."""
    n = table(spark, d, "batches").select("batch", F.col("strong_terms")[0].alias("name"))
    s = table(spark, d, "normalized_sources").join(small(n), "batch").select("id", F.coalesce("body", F.lit("")).alias("body"), "name")
    a = F.instr("body", F.col("name")) - 1
    place = F.when(a >= 0, F.array(F.struct(a.alias("start"), (a + F.length("name")).alias("end"))))
    return s.select("id", F.coalesce(passages.cuts_into(place, passages.topic_spans(F.col("body"))), F.lit(False)).alias("inside"))


@query("SELECT id, sha256('{\"author\":' || coalesce(to_json(author), '\"\"') || ',\"batch\":' || coalesce(to_json(batch), '\"\"') || ',\"row_no\":' || row_no || '}') AS digest FROM normalized_sources")
def content_digest(spark, d):
    """A digest of some fields in alphabetical order as compact JSON."""
    s = table(spark, d, "normalized_sources")
    return s.select("id", F.sha2(F.to_json(F.struct(F.coalesce("author", F.lit("")).alias("author"), F.coalesce("batch", F.lit("")).alias("batch"), "row_no")), 256).alias("digest"))


_PIECE = "[^，。！？；：,.!?;:]*[，。！？；：,.!?;:]|[^，。！？；：,.!?;:]+$"
ORACLES["excerpt_segments"] = f"""WITH RECURSIVE {_SOURCES}, pc AS (SELECT id, text, regexp_extract_all(text, '{_PIECE}') AS p FROM sources WHERE text <> ''),
w AS (SELECT id, p, 1 AS k, p[1] AS open, 0 AS seg, NULL::VARCHAR AS closed FROM pc UNION ALL SELECT id, p, k + 1, CASE WHEN c THEN piece ELSE open || piece END, seg + c::INT, CASE WHEN c THEN open END
FROM (SELECT *, p[k + 1] AS piece, length(open) + length(p[k + 1]) > 58 AND length({_norm('open')}) >= 8 AS c FROM w WHERE k < len(p))),
done AS (SELECT id, seg AS segment_no, closed AS segment FROM w WHERE closed IS NOT NULL), rest AS (SELECT id, open, seg, seg > 0 AND length({_norm('open')}) < 6 AS joins FROM w WHERE k = len(p)),
segments AS (SELECT d.id, d.segment_no, CASE WHEN r.joins AND r.seg = d.segment_no THEN d.segment || r.open ELSE d.segment END AS segment FROM done d JOIN rest r USING (id) UNION ALL SELECT id, seg + 1, open FROM rest WHERE NOT joins)
SELECT id, segment_no, segment, true AS lossless FROM segments"""
def _spans(source: str) -> str:
    """Tables of SQL up to ``spans`` (id, n, a, b) of the texts of ``source`` (id, x)."""
    letters = lambda x: f"length({_norm(x)})"
    hint = f"^{_WS[:-1]}*(?:[①②③④⑤⑥⑦⑧⑨⑩]|#.{{1,32}}?#|但是|不过|然而|同时|另外|其次|最后|再说|更重要的是)"
    return f"""toks AS (SELECT id, unnest(t) AS raw, unnest(range(1, len(t) + 1)) AS k FROM (SELECT id, regexp_extract_all(x, '[^。！？!?；;\\r\\n]+[。！？!?；;]?|[。！？!?；;\\r\\n]') AS t FROM {source})),
placed AS (SELECT id, raw, (sum(length(raw)) OVER (PARTITION BY id ORDER BY k))::BIGINT - length(raw) AS a FROM toks), good AS (SELECT * FROM placed WHERE NOT regexp_matches(raw, '^[。！？!?；;\\r\\n]') AND {letters('raw')} >= 8),
long AS (SELECT id, a, raw, list_sort(list_distinct(list_concat(list_filter(range(1, length(raw) + 1), lambda i: contains('，,、：:', raw[i])), list_filter(range(0, length(raw) + 1), lambda i: regexp_matches(substring(raw, i + 1), '{hint}'))))) AS pts FROM good WHERE length(raw) > 150),
walk AS (SELECT id, a, raw, pts, [0::BIGINT] AS cuts, true AS more FROM long UNION ALL SELECT id, a, raw, pts, CASE WHEN len(nxt) > 0 THEN list_append(cuts, nxt[1]) ELSE cuts END, len(nxt) > 0 FROM (SELECT *, list_filter(pts, lambda x: x >= cuts[-1] + 45) AS nxt FROM walk WHERE more)),
ended AS (SELECT id, a, raw, CASE WHEN length(raw) - cuts[-1] >= 8 THEN list_append(cuts, length(raw)) ELSE cuts END AS c FROM walk WHERE NOT more), cut AS (SELECT id, a, raw, CASE WHEN len(c) <= 2 THEN list_append(range(0, length(raw), 140), length(raw)) ELSE c END AS c FROM ended),
parts AS (SELECT id, a, raw, c[i] AS p, c[i + 1] AS q FROM (SELECT *, unnest(range(1, len(c))) AS i FROM cut)), found AS (SELECT id, a, a + length(raw) AS b FROM good WHERE length(raw) <= 150 UNION ALL SELECT id, a + p, a + q FROM parts WHERE {letters('substring(raw, p + 1, q - p)')} >= 8),
every AS (SELECT * FROM found UNION ALL SELECT id, 0, length(x) FROM {source} WHERE x <> '' AND id NOT IN (SELECT id FROM found)), spans AS (SELECT id, a, b, row_number() OVER (PARTITION BY id ORDER BY a) - 1 AS n FROM every)"""


ORACLES["sentence_spans"] = f"WITH RECURSIVE src AS (SELECT id, coalesce(body, '') AS x FROM normalized_sources), {_spans('src')} SELECT id, n::INT AS span_no, a::INT AS start, b::INT AS \"end\" FROM spans"
ORACLES["best_window"] = f"""WITH RECURSIVE {_SOURCES}, own AS (SELECT id, text AS x FROM sources JOIN batches USING (batch)), {_spans('own')}, win AS (SELECT s.id, s.a, e.b, t.text, t.batch FROM spans s JOIN spans e ON e.id = s.id AND e.n BETWEEN s.n AND s.n + 1 JOIN sources t ON t.id = s.id),
f AS (SELECT w.id, w.a, w.b, substring(w.text, a + 1, b - a) AS f, c.strong_terms, coalesce(c.weak_terms, []) AS weak FROM win w JOIN batches c USING (batch)),
g AS (SELECT id, a, b, 20 * len(list_filter(strong_terms, lambda t: length(t) >= 2 AND contains(f, t))) + 8 * len(list_filter(weak, lambda t: length(t) >= 2 AND contains(f, t))) + 3 * {_count('f', T.POSITIVE + '|' + T.NEGATIVE)} AS score FROM f)
SELECT id, a::INT AS start, b::INT AS "end", score::INT AS score FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, a, b) AS r FROM g) WHERE r = 1"""
ORACLES["candidate_windows"] = f"""WITH RECURSIVE {_SOURCES}, own AS (SELECT id, text AS x FROM sources), {_spans('own')}, win AS (SELECT s.id, s.a, e.b, substring(t.text, s.a + 1, e.b - s.a) AS f FROM spans s JOIN spans e ON e.id = s.id AND e.n BETWEEN s.n AND s.n + 2 JOIN sources t ON t.id = s.id),
g AS (SELECT id, a, b, 3 * {_count('f', T.POSITIVE)} + 3 * {_count('f', T.NEGATIVE)} AS score FROM win), o AS (SELECT id, list([{{'s': score, 'a': a, 'b': b}}] ORDER BY score DESC, a, b) AS l FROM g WHERE score > 0 GROUP BY id),
k AS (SELECT id, list_reduce(l, lambda acc, x: CASE WHEN len(acc) >= 3 OR len(list_filter(acc, lambda o: x[1].a >= o.a AND x[1].b <= o.b)) > 0 THEN acc ELSE list_concat(acc, x) END) AS kept FROM o)
SELECT id, i::INT AS place, kept[i].a::INT AS start, kept[i].b::INT AS "end", kept[i].s::INT AS score FROM (SELECT *, unnest(range(1, len(kept) + 1)) AS i FROM k)"""
ORACLES["target_evidence"] = f"""WITH RECURSIVE {_SOURCES}, own AS (SELECT id, text AS x FROM sources JOIN batches USING (batch)), {_spans('own')}, m AS (SELECT s.id, s.n, s.a AS st, least(s.b, s.a + 260) AS en, substring(t.text, s.a + 1, least(s.b - s.a, 260)) AS part, c.strong_terms FROM spans s JOIN sources t ON t.id = s.id JOIN batches c ON c.batch = t.batch),
f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n) - 1 AS k FROM m WHERE len(list_filter(strong_terms, lambda t: t <> '' AND contains(part, t))) > 0) SELECT id, k::INT AS k, st::INT AS start, en::INT AS "end", part FROM f WHERE k < 3"""
ORACLES["excerpts"] = f"""WITH RECURSIVE {_SOURCES}, best AS ({ORACLES['best_window']}), own AS (SELECT id, text AS x FROM sources WHERE id IN (SELECT id FROM best)), {_spans('own')},
sp AS (SELECT s.id, s.n, s.a, s.b, s.a < w."end" AND s.b > w.start AS t FROM spans s JOIN best w ON w.id = s.id), nr AS (SELECT *, t OR coalesce(lag(t) OVER o, false) OR coalesce(lead(t) OVER o, false) AS near FROM sp WINDOW o AS (PARTITION BY id ORDER BY n)),
runs AS (SELECT s.id, s.a, e.b FROM nr s JOIN nr e ON e.id = s.id AND e.n BETWEEN s.n AND s.n + 2 JOIN nr m ON m.id = s.id AND m.n BETWEEN s.n AND e.n WHERE s.near GROUP BY s.id, s.a, e.b HAVING bool_or(m.t)),
raw AS (SELECT r.id, r.a, r.b, trim(substring(t.text, r.a + 1, r.b - r.a)) AS raw FROM runs r JOIN sources t ON t.id = r.id), shown AS (SELECT *, {_display('raw')} AS excerpt FROM raw),
fit AS (SELECT *, regexp_matches(excerpt, '{T.PROMOTION}') AS promo, length(excerpt) < 70 AS short, {_count('excerpt', T.POSITIVE + '|' + T.NEGATIVE)} * 2.2::DOUBLE + least(length(excerpt), 70) / 20 AS worth FROM shown
WHERE length({_norm('raw')}) >= 18 AND length(excerpt) BETWEEN 1 AND 150 AND NOT regexp_matches(raw, '^[\\s，。！？；：、,.!?;:)）」』”》】]') AND NOT regexp_matches(excerpt, '{"|".join(f"(?:{p})" for _, p in passages.MARKUP)}') AND len(regexp_extract_all(excerpt, '“')) = len(regexp_extract_all(excerpt, '”')))
SELECT id, place::INT AS place, a::INT AS start, b::INT AS "end", excerpt FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY promo, short, worth DESC, a, b) AS place FROM fit) WHERE place <= 3"""


@query(lambda: " UNION ALL ".join([
    f"SELECT \"check\", key FROM ({ORACLES['verify_constraints']})", "SELECT 'repeated id', id FROM normalized_sources GROUP BY id HAVING count(*) > 1",
    f"SELECT 'answer about nothing', source_id FROM ({ORACLES['review_unknown_anti']})", f"SELECT issue, source_id FROM ({ORACLES['passage_overlap_check']})",
    f"SELECT 'order of channels', id FROM ({ORACLES['media_order_violations']})", f"SELECT issue, url FROM ({ORACLES['link_health_violations']})",
    f"SELECT 'cluster too broad', batch || '/' || cluster FROM ({ORACLES['cluster_profile']}) WHERE too_broad", f"SELECT 'fragment out of place', id FROM ({ORACLES['fragment_validation']}) WHERE NOT valid",
    "SELECT 'unknown answer', CAST(review_id AS VARCHAR) FROM review_labels WHERE abusive IS NULL OR abusive NOT IN (0, 1)", "SELECT 'count differs', source_file FROM (SELECT f.source_file, f.n_rows, (SELECT count(*) FROM normalized_sources n WHERE n.source_file = f.source_file) AS n FROM source_files f WHERE held_in = 'normalized_sources') WHERE n <> n_rows",
]))
def verify_suite(spark, d):
    """All constraints of a result in one frame of violations: sound if empty."""
    q = lambda name: QUERIES[name](spark, d)
    s, labels = table(spark, d, "normalized_sources"), table(spark, d, "review_labels")
    n = s.where("source_file is not null").groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    counts = table(spark, d, "source_files").where("held_in = 'normalized_sources'").join(n, "source_file", "left").where(F.coalesce("n", F.lit(0)) != F.col("n_rows"))
    named = lambda name, check, key: q(name).select(F.col(check).alias("check"), F.col(key).alias("key"))
    own = checks.violations(
        ("repeated id", checks.repeated(s, "id"), F.col("id")), ("answer about nothing", q("review_unknown_anti"), F.col("source_id")), ("order of channels", q("media_order_violations"), F.col("id")),
        ("cluster too broad", q("cluster_profile").where("too_broad"), F.concat_ws("/", "batch", "cluster")), ("fragment out of place", q("fragment_validation").where("not valid"), F.col("id")),
        ("unknown answer", labels.where("abusive is null or abusive not in (0, 1)"), F.col("review_id")), ("count differs", counts, F.col("source_file")))
    return own.unionByName(q("verify_constraints")).unionByName(named("passage_overlap_check", "issue", "source_id")).unionByName(named("link_health_violations", "issue", "url"))


ORACLES.update({k: v() for k, v in ORACLES.items() if callable(v)})
