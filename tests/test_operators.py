import io
import json
import random
import re
import unicodedata
import zipfile
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import checks, dedup, entities, evidence, links, reviews, routing
from millrace.sources import files, xlsx


def test_clean_and_normalized_agree_with_python(spark):
    r = random.Random(3)
    pool = [chr(c) for c in range(0x20, 0x3100) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")] + list("一二三ABCabc 　\xa0\n\t--")
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 20))) for _ in range(400)] + [None, "", " - ", "--", "None"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    for row in df.select("k", T.clean(F.col("t")).alias("c"), T.normalized(F.col("t")).alias("n")).collect():
        t = texts[row.k] or ""
        c = re.sub(r"[\t-\r \x85\xa0  -     　]+", " ", t).strip(" ")
        assert row.c == ("" if c in ("-", "--", "None", "null") else c)
        assert row.n == re.sub(r"[^一-鿿A-Za-z0-9]+", "", t).lower()


def test_merged_spans(spark):
    df = spark.createDataFrame([("abcabcx", ["abc", "cab"]), ("", ["a"]), ("aaa", ["aa"]), ("zz", [])], "t string, terms array<string>")
    got = [[tuple(x) for x in r.s] for r in df.select(T.merged_spans(F.col("t"), F.col("terms")).alias("s")).collect()]
    assert got == [[(0, 6)], [], [(0, 3)], []]


def grams(t):
    return {t[k : k + 3] for k in range(len(t) - 2)}


def near(a, b):
    i, u = len(a & b), len(a | b)
    return i >= 0.84 * u - 1e-9 or i >= 0.94 * min(len(a), len(b)) - 1e-9


def test_near_pairs_and_greedy_against_brute_force(spark):
    r = random.Random(5)
    base = ["".join(r.choice("abcdefgh") for _ in range(60)) for _ in range(6)]
    texts = []
    for b in base:
        for _ in range(6):
            t = list(b)
            for _ in range(r.randint(0, 4)):
                t[r.randrange(len(t))] = r.choice("abcdefgh")
            texts.append("".join(t)[: r.randint(20, 60)])
    texts = [*dict.fromkeys(texts), "ab", "xyz"]
    df = spark.createDataFrame([("b", f"i{k:03d}", t) for k, t in enumerate(texts)], "batch string, id string, norm string")
    g = [grams(t) for t in texts]
    want = {(f"i{a:03d}", f"i{b:03d}") for a, b in combinations(range(len(texts)), 2) if g[a] and g[b] and near(g[a], g[b])}
    pairs = dedup.near_pairs(df)
    assert {(p.left_id, p.right_id) for p in pairs.collect()} == want and want
    order = sorted(range(len(texts)), key=lambda k: (-len(texts[k]), -k))
    kept, of = [], {}
    for k in order:
        first = next((j for j in kept if tuple(sorted((f"i{j:03d}", f"i{k:03d}"))) in want), None)
        if first is None:
            kept.append(k)
        of[f"i{k:03d}"] = f"i{k if first is None else first:03d}"
    rows = spark.createDataFrame([("b", f"i{k:03d}", n) for n, k in enumerate(order)], "batch string, id string, place int")
    assert {x.id: x.kept_id for x in dedup.greedy_survivors(rows, pairs).collect()} == of
    assert dedup.greedy_survivors(rows.limit(0), pairs.limit(0)).count() == 0


def test_families_with_reviews(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("d", "y"), ("e", ""), ("f", ""), ("g", "z")], "id string, fingerprint string")
    same = spark.createDataFrame([("d", "b"), ("g", "d")], "left_id string, right_id string")
    apart = spark.createDataFrame([("c", "a")], "left_id string, right_id string")
    assert {r.id: r.family for r in dedup.copy_families(df, same, apart).collect()} == {"a": "a", "b": "a", "c": "c", "d": "a", "e": "e", "f": "f", "g": "a"}


def test_quotas_and_round_robin(spark):
    assert routing.quotas({"a": 5, "b": 500, "c": 100}, 60) == {"a": 5, "b": 35, "c": 20}
    assert routing.quotas({}, 10) == {}
    # worked by hand: beyond the floors of 10, offers of a are 5/11, 5/12, ..., of b 10/11, 10/12, ..., of c 3
    assert routing.quotas({"a": 25, "b": 100}, 26, 10) == {"a": 10, "b": 16}
    assert routing.quotas({"a": 25, "b": 100}, 31, 10) == {"a": 10, "b": 21}
    assert routing.quotas({"a": 25, "b": 100}, 32, 10) == {"a": 10, "b": 22}  # 10/22 and 5/11 are level
    assert routing.quotas({"a": 25, "b": 100}, 33, 10) == {"a": 11, "b": 22}
    assert routing.quotas({"a": 4, "b": 4}, 3, 1) == {"a": 1, "b": 2}  # level offers: the last name first
    assert routing.quotas({"a": 3, "b": 2}, 80, 10) == {"a": 3, "b": 2}
    df = spark.createDataFrame([(f"{c}{k}", c, k) for c in "xyz" for k in range(5)], "id string, channel string, k int")
    assert [r.id for r in routing.round_robin(df, "channel", 5, F.col("k")).collect()] == ["x0", "y0", "z0", "x1", "y1"]
    got = routing.stratified(df, "channel", "channel", 3, 1, F.col("k"))
    assert got.groupBy("channel").count().where("count != 3").count() == 0


def test_certification_needs_one_subject(spark):
    reg = spark.createDataFrame([("s1", "晨报"), ("s1", "晨报社"), ("s2", "晚报")], "subject string, name string")
    src = spark.createDataFrame([("a", "城市晨报社官方"), ("b", "晨报与晚报"), ("c", None), ("d", "无")], "id string, certification_info string")
    assert {r.id: r.subject for r in entities.by_certification(src, reg).collect()} == {"a": "s1"}


def test_reviews(spark):
    ledger = spark.createDataFrame([("a", 1, 1), ("a", 0, 2), ("b", None, 1)], "id string, v int, t int")
    assert {(r.id, r.v) for r in reviews.latest(ledger, ["id"], "t").collect()} == {("a", 0), ("b", None)}
    assert reviews.conflicts(ledger, "id", "v").count() == 1
    bad = reviews.key_violations(spark.createDataFrame([("", 1), (None, 0), ("k", 5), ("k", 1)], "key string, v int"), "key", {"v": ["0", "1"]})
    assert sorted((r.key, r.issue) for r in bad.collect()) == [("", "empty key"), ("", "empty key"), ("k", "bad v"), ("k", "repeated key")]


def test_links(spark):
    df = spark.createDataFrame([(404, 410, True, False), (404, 200, True, False), (200, None, True, False), (None, None, False, False), (200, None, True, True)], "s int, c int, v boolean, b boolean")
    kinds = [r.k for r in df.select(links.classify(F.col("s"), F.col("c"), F.col("v"), F.col("b")).alias("k")).collect()]
    assert kinds == ["confirmed_dead", "indeterminate", "reachable", "invalid", "blocked"]


def test_spans_are_places(spark):
    text = "第一句话在这里写得足够长。短。" + "很长的一句没有句号，" * 20 + "结束了这一段文字"
    spans = evidence.spans_of(text)
    assert all(0 <= a < b <= len(text) for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    assert max(b - a for a, b in spans) < 200
    assert evidence.spans_of("") == [] and evidence.spans_of("短") == [(0, 1)]
    df = spark.createDataFrame([(text, "一"), (None, "二")], "text string, id string")
    assert evidence.with_spans(df, "text", ["id"]).count() == len(spans)


def test_overlaps(spark):
    p = spark.createDataFrame([("a", 0, 5), ("a", 5, 9), ("b", 0, 5), ("b", 4, 6), ("c", 0, 1), ("c", 1, 2), ("c", 2, 3)], "source_id string, start int, end int")
    assert {tuple(r) for r in evidence.overlap_violations(p).collect()} == {("b", "overlap"), ("c", "too many")}


def test_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert checks.repeated(df, "k").count() == 1


def workbook(rows):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda c, k, v: "" if v is None else f'<c r="{c}{k}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{c}{k}" s="{1 if isinstance(v, float) else 0}"><v>{v}</v></c>'
    body = "".join(f'<row r="{k}">' + "".join(cell("ABCDEF"[i], k, v) for i, v in enumerate(row)) + "</row>" for k, row in enumerate(rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="微博" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def test_spreadsheets(spark, tmp_path):
    content = workbook([[None, None], ["标题", None, "发表时间"], ["一", 5, 45539.5], [None], ["二"]])
    assert [r[2] for r in xlsx.rows(content)][2] == ["一", 5, "2024-09-04 12:00:00"]
    (tmp_path / "批次甲").mkdir()
    (tmp_path / "批次甲" / "x-微博.xlsx").write_bytes(content)
    (tmp_path / "批次甲" / "~$x.xlsx").write_bytes(b"")
    got = files.read_spreadsheets(spark, str(tmp_path), [("标题", "title")]).orderBy("row_no").collect()
    assert [(r.channel, r.row_no, json.loads(r.data)) for r in got] == [("微博", 3, {"标题": "一", "未命名列2": 5, "发表时间": "2024-09-04 12:00:00"}), ("微博", 5, {"标题": "二", "未命名列2": None, "发表时间": None})]
    assert files.manifest(spark, str(tmp_path)).count() == 1


def test_json_lines_and_pages(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('﻿{"a": 1}\n\n{"a": 1, "a": 2}\n[1]\n{bad\n', encoding="utf-8")
    assert [r.problem for r in files.read_jsonl(spark, str(tmp_path / "a.jsonl")).collect()].count(None) == 1
    page = files.render_page("<script>const DATA=__DATA__;</script>", {"batches": [{"name": "b", "clusters": [{"id": "c", "items": [{"url": "u</x>"}]}]}]})
    (tmp_path / "p.html").write_text(page, encoding="utf-8")
    items = files.read_pages(spark, str(tmp_path / "p.html")).select(F.inline(files.page_items(F.col("data")))).collect()
    assert [tuple(i) for i in items] == [("b", "c", "u</x>")]
    assert json.loads(files.embedded_data(files.replace_data(page, {"batches": []}))) == {"batches": []}


def test_chunks(spark):
    df = spark.createDataFrame([("g", k, "x" * n) for k, n in enumerate([5, 5, 5, 20, 1, 1, 1])], "g string, k int, t string")
    assert [r.chunk_no for r in files.chunked(df, "g", "k", "t", 3, 12).orderBy("k").collect()] == [0, 0, 1, 2, 3, 3, 3]


def test_stream_upsert(spark, tmp_path):
    from millrace.streaming import ledger

    src = tmp_path / "in"
    for k, rows in enumerate([[("a", 1, 1), ("b", 1, 1)], [("a", 2, 2)]]):
        spark.createDataFrame(rows, "id string, v int, t int").coalesce(1).write.mode("append").parquet(str(src))
        s = spark.readStream.schema("id string, v int, t int").parquet(str(src))
        ledger.upsert_stream(s, str(tmp_path / "out"), ["id"], ["t"], str(tmp_path / "cp")).awaitTermination()
        got = {(r.id, r.v) for r in ledger.current(spark, str(tmp_path / "out")).collect()}
        assert got == ({("a", 1), ("b", 1)} if k == 0 else {("a", 2), ("b", 1)})


def test_passages(spark):
    from millrace.operators import passages

    text = "先说一点别的，再说这部电视剧，节奏其实很好；但是结尾仓促。" * 4
    got = {r.id: r.p for r in spark.createDataFrame([("a", text), ("b", ""), ("c", None), ("d", "短")], "id string, t string").select("id", passages.packed(F.col("t")).alias("p")).collect()}
    assert "".join(got["a"]) == text and max(map(len, got["a"])) <= 66 and len(got["a"]) >= 2
    assert got["b"] == [] and got["c"] is None and got["d"] == ["短"]
    df = spark.createDataFrame([("看 [这里](https://a.example/x) #话题# 好看 ，真的&amp;好 @某人 😀",), (None,), ("",)], "t string")
    assert [r.d for r in df.select(passages.display(F.col("t")).alias("d")).collect()] == ["看 好看，真的&好", "", ""]
    w = spark.createDataFrame([("a", 0, 9, 5), ("a", 0, 4, 4), ("a", 10, 12, 3), ("a", 11, 12, 2), ("b", 0, 1, 1)], "id string, start int, end int, score int")
    assert {tuple(r) for r in passages.not_contained(w).collect()} == {("a", 1, 0, 9, 5), ("a", 2, 10, 12, 3), ("b", 1, 0, 1, 1)}
    s = spark.createDataFrame([("g", "a", "abcdef"), ("g", "b", "abcdeg"), ("g", "c", "uvwxyz"), ("h", "d", None)], "grp string, id string, text string")
    assert [r.id for r in passages.varied(s, "grp", 2).where("grp = 'g'").orderBy("place").collect()] == ["a", "c"]
    v = spark.createDataFrame([("abc", "bc", 1, 3), ("abc", "bc", 0, 2), ("abc", "c", 2, 9), (None, "c", 0, 1)], "b string, f string, s int, e int")
    assert [r.v for r in v.select(passages.valid_positions(F.col("b"), F.col("f"), F.col("s"), F.col("e")).alias("v")).collect()] == [True, False, False, False]


def test_other_titles_at_any_place(spark):
    import re

    from millrace.operators import passages

    far = "一" * 40
    texts = {
        "later": f"《回声》{far}原著《回声》很好",
        "first": f"原著《回声》{far}《回声》",
        "none": f"《回声》{far}原著",
        "two": f"《甲书》《乙书》{far}《甲书》的导演《丙书》{far}《丁书》",
        "edge": "原著" + "一" * 26 + "《近》" + "二" * 60 + "原著" + "一" * 27 + "《远》",
        "nested": f"《《外》{far}《" + "长" * 50 + "《内》电影",
        "known": "电影《雾港》",
        "many": "《一》" * 40 + "电影" + "《二》" * 40,
        "empty": "",
    }
    df = spark.createDataFrame([(k, v, ["雾港"]) for k, v in texts.items()] + [("null", None, None)], "id string, text string, names array<string>")
    want = set()
    for k, v in texts.items():
        for m in re.finditer(r"《([^》]{1,40})》", v):
            if re.search("原著|电影|导演", v[max(0, m.start() - 28) : m.end() + 28]) and m.group(1) != "雾港":
                want.add((k, m.group(1)))
    got = [tuple(r) for r in passages.other_titles(df, F.col("names"), "原著|电影|导演").collect()]
    assert sorted(got) == sorted(want) and ("later", "回声") in want and ("none", "回声") not in want


def test_every_source_has_its_kept_row(spark, data):
    from millrace import catalog, queries

    rows = {(r.batch, r.id): r.fingerprint or "" for r in queries.prints(spark, data).collect()}
    got = {(r.batch, r.id): r for r in catalog.QUERIES["near_dup_greedy"](spark, data).collect()}
    assert set(got) == set(rows)
    for (b, i), r in got.items():
        assert rows[b, r.representative] == rows[b, i] and got[b, r.kept_id].kept_id == r.kept_id == got[b, r.representative].kept_id
        assert rows[b, i] or r.representative == r.kept_id == i
    df = spark.createDataFrame([("x", "a", "abc"), ("x", "b", "abc"), ("x", "c", "abcd"), ("x", "d", ""), ("x", "e", ""), (None, "f", "abc"), (None, "g", "abc")], "batch string, id string, fingerprint string")
    reps = dedup.collapse_copies(df, ["batch", "fingerprint"], [F.length("id")])
    kept = spark.createDataFrame([("x", "b", "c"), ("x", "c", "c"), (None, "g", "g")], "batch string, id string, kept_id string")
    assert {r.id: (r.representative, r.kept_id) for r in dedup.memberships(df, reps, kept).collect()} == {"a": ("b", "c"), "b": ("b", "c"), "c": ("c", "c"), "d": ("d", "d"), "e": ("e", "e"), "f": ("g", "g"), "g": ("g", "g")}


def test_fingerprints_from_parts_are_those_of_texts(spark, data):
    from millrace.operators import sources
    from millrace.sources.tables import table

    odd = spark.createDataFrame([(None, "Ab 《一》", "x ab一 y", None), ("评论", "T", "body", "a"), (None, "-", None, "Asr!"), (None, "T", "-", None), (None, None, None, None), (None, "。。", "正文", None)], "post_type string, title string, body string, asr string")
    rows = sources.with_text(odd.union(table(spark, data, "normalized_sources").select(*odd.columns)), fingerprint=True)
    assert rows.columns == [*odd.columns, "text", "fingerprint"]
    assert rows.where("fingerprint is null").count() == 0 == rows.where(F.col("fingerprint") != T.normalized(F.col("text"))).count()


def test_documents_of_reviews(spark):
    doc = lambda x: spark.createDataFrame([(json.dumps(x, ensure_ascii=False),)], "value string")
    got = reviews.keyed(doc({"scope": "now", "reviews": [{"source_id": " a ", "decision": "keep"}, {"source_id": "b"}]}), "now").collect()
    assert {r.key: json.loads(r.review).get("decision") for r in got} == {"a": "keep", "b": None}
    assert {r.key for r in reviews.keyed(doc({"scope": "now", "reviews": {"x": {"decision": "keep"}}}), "now").collect()} == {"x"}
    for bad in ({"scope": "old", "reviews": []}, {"reviews": []}, {"scope": "now", "reviews": [{"source_id": ""}]}, {"scope": "now", "reviews": [{"source_id": "a"}, {"source_id": "a"}]}):
        with pytest.raises(ValueError, match="a review document"):
            reviews.keyed(doc(bad), "now")
    flat = reviews.flattened(doc({"overrides": {"a": {"cluster": "c1"}, "batch": {"b": {"cluster": "c2", "reason": "r"}, " d ": {"cluster": None}}, "e": "text"}}))
    assert {r.source_id: json.loads(r.override)["cluster"] for r in flat.collect()} == {"a": "c1", "b": "c2", "d": None}


def test_answers_are_filled_in_only_where_bound(spark):
    items = spark.createDataFrame([("a", "exclude", "short"), ("b", "retain", "x"), ("c", "exclude", None)], "id string, auto_decision string, auto_reason string")
    answers = spark.createDataFrame([("a", "exclude", None, "now"), ("a", "exclude", None, "old"), ("b", "exclude", " ", "now"), ("c", "exclude", "", "now"), ("d", "exclude", None, "now"), ("a", "exclude", "mine", "now")], "id string, decision string, reason string, binding string")
    assert sorted((r.id, r.reason) for r in reviews.expanded(answers, items, "now").collect()) == [("a", ""), ("a", "mine"), ("a", "short"), ("b", " "), ("c", ""), ("d", "")]


def test_health_of_links(spark):
    h = spark.createDataFrame([("u", "reachable", 200), ("u", "reachable", 200), ("", "blocked", None), ("v", "gone", 404), ("w", "confirmed_dead", None), ("x", "confirmed_dead", 410)], "url string, classification string, status_code int")
    assert sorted((r.url, r.issue) for r in links.health_violations(h).collect()) == [("", "empty url"), ("u", "repeated url"), ("v", "unknown class"), ("w", "dead without 404 or 410")]
    s = spark.createDataFrame([("1", "x", "retain"), ("2", "u", "retain"), ("3", None, "exclude")], "id string, url string, decision string")
    assert {r.id: (r.classification, r.decision, r.basis) for r in links.with_health(s, h).collect()} == {"1": ("confirmed_dead", "exclude", "dead link"), "2": ("reachable", "retain", "decision"), "3": ("", "exclude", "decision")}
    c = spark.createDataFrame([("a", "reachable", 71, "s"), ("b", "reachable", 73, "s"), ("c", "confirmed_dead", 23, "s"), ("d", "indeterminate", 0, "s"), ("e", "blocked", 100, "other")], "url string, classification string, age int, scope string")
    c = c.withColumn("checked_at", F.timestamp_seconds(F.lit(1_700_000_000) - F.col("age") * 3600))
    assert {r.url for r in links.cached(c, F.timestamp_seconds(F.lit(1_700_000_000)), F.col("scope"), "s").collect()} == {"a", "c"}


def test_excerpts_and_menus(spark):
    from millrace.operators import passages

    sentences = ["开头先说一点不相干的事情然后才进入正题。", "这部片子的摄影真的很细腻而且节奏自然。", "扫码关注公众号可以领取优惠和更多的资源。", "结尾有些仓促不过整体完成得相当不错了。"]
    text = "".join(sentences)
    at = text.index("这部")
    df = spark.createDataFrame([("a", text, at, at + 10), ("b", "", 0, 0), ("c", None, 0, 5), ("d", "短。", 0, 1)], "id string, text string, w_start int, w_end int")
    got = {(r.id, r.place): r for r in passages.excerpt_candidates(df, "细腻|自然|仓促").collect()}
    assert {k[0] for k in got} == {"a"} and all(text[r.start : r.end] == r.excerpt for r in got.values())
    assert got["a", 1].excerpt == "".join(sentences[:2]) and all("扫码" not in got["a", k].excerpt for k in (1, 2))
    menu = spark.createDataFrame([(text, [(0, 20), (at, at + 19)], ["摄影", ""])], "text string, spans array<struct<start:int,end:int>>, terms array<string>")
    m = menu.select(F.explode(passages.evidence_menu(F.col("spans"), F.col("text"), F.col("terms"), longest=12)).alias("m")).collect()
    assert [(r.m.start, r.m.end, r.m.part) for r in m] == [(at, at + 12, text[at : at + 12])]
    segs = spark.createDataFrame([(["路透不断", "别的", "片子好看", "路透"], ["片子"]), (["路透"], ["片子"]), ([], ["x"])], "s array<string>, t array<string>")
    assert [r.x for r in segs.select(passages.leading_unrelated(F.col("s"), F.col("t"), "路透").alias("x")).collect()] == [[0], [], []]
    h = spark.createDataFrame([("a<b & A<B",), (None,), ("x",)], "t string").select(passages.highlighted(F.col("t"), "a<B").alias("h"))
    assert [r.h for r in h.collect()] == ["<mark>a&lt;b</mark> &amp; <mark>A&lt;B</mark>", "", "x"]


def test_routing_with_answers_and_a_cache(spark):
    a = spark.createDataFrame([("a", "c1"), ("b", "c1"), ("c", "c2")], "id string, cluster string")
    o = spark.createDataFrame([("a", "c9"), ("b", None)], "id string, cluster string")
    assert {r.id: (r.cluster, r.basis) for r in routing.with_overrides(a, o).collect()} == {"a": ("c9", "override"), "b": (None, "excluded"), "c": ("c2", "automatic")}
    s = spark.createDataFrame([("a", "1", "x"), ("b", "1", "x"), ("c", "1", "x")], "id string, row_print string, contract string")
    c = spark.createDataFrame([("a", "1", "x", 2), ("a", "1", "x", 2), ("b", "0", "x", 2), ("c", "1", "x", 1), ("", "1", "x", 2)], "id string, row_print string, contract string, cache_version int")
    assert {r.id: r.hit for r in routing.from_cache(s, c, 2).collect()} == {"a": True, "b": False, "c": False}
    r = spark.createDataFrame([("a", [(9.0, 0, "x"), (5.0, 1, "y")]), ("b", [(9.0, 0, "x"), (4.0, 1, "y")]), ("c", [(0.0, 0, "x"), (0.0, 1, "y")]), ("d", [(1.0, 0, "x")]), ("e", [])], "id string, ranking array<struct<score:double,def_idx:int,cluster:string>>")
    assert sorted(tuple(x) for x in routing.with_secondary(r).collect()) == [("a", "x", "primary"), ("a", "y", "secondary"), ("b", "x", "primary"), ("c", "x", "primary"), ("d", "x", "primary")]
    assert {x.id: (x.cluster, x.margin) for x in routing.with_best(r).collect()} == {"a": ("x", 4.0), "b": ("x", 5.0), "c": ("x", 0.0), "d": ("x", 1.0)}


def test_pages_of_versions_and_columns(spark):
    from millrace.operators import checks

    df = spark.createDataFrame([('{"a": 1, "b": 2}',), ('{"a": 1}',), ("[]",), (None,), ("{bad",)], "data string")
    assert {r.version: r.n for r in checks.schema_counts(df, "data", [("two", ["a", "b"]), ("one", ["a"])]).collect()} == {"two": 1, "one": 1, "unknown": 3}
    assert checks.present(df.withColumn("Secret", F.lit(1)), "secret", "other") == ["Secret"]
    old, new = (spark.createDataFrame(x, "batch string, n int, first string") for x in ([("p", 1, "1"), ("q", 2, "2")], [("q", 9, "7"), ("r", 8, "0")]))
    assert {r.batch: (r.n, r.place) for r in reviews.merged(old, new, "batch", "first").collect()} == {"p": (1, 1), "q": (9, 2), "r": (8, 3)}


def test_fragments_topics_and_spread_members(spark):
    from millrace.operators import passages

    places = "array<struct<start:int,end:int>>"
    df = spark.createDataFrame([("abcdef", ["b", "de"], [(1, 2), (3, 5)]), ("abcdef", ["de", "b"], [(3, 5), (1, 2)]), ("abcdef", ["bc", "cd"], [(1, 3), (2, 4)]), ("abcdef", ["x"], [(1, 2)]), ("abcdef", [], []), ("abcdef", ["a", "b", "c"], [(0, 1), (1, 2), (2, 3)]), (None, ["a"], [(0, 1)]), ("abcdef", ["a"], [(0, 1), (1, 2)])], f"b string, f array<string>, p {places}")
    assert [r.v for r in df.select(passages.valid_fragments(F.col("b"), F.col("f"), F.col("p")).alias("v")).collect()] == [True, False, False, False, False, False, False, False]
    t = spark.createDataFrame([("前#话题#后#a#b##题目#",), ("",), (None,)], "t string").select(passages.topic_spans(F.col("t")).alias("s"))
    assert [[(x.start, x.end) for x in r.s] for r in t.collect()] == [[(1, 5), (11, 15)], [], []]
    c = spark.createDataFrame([([(2, 4)], [(1, 5)]), ([(1, 5)], [(1, 5)]), ([(0, 3)], [(1, 5)]), (None, [(1, 5)])], f"p {places}, s {places}")
    assert [r.x for r in c.select(passages.cuts_into(F.col("p"), F.col("s")).alias("x")).collect()] == [True, False, True, None]
    rows = [("g", f"{k:02}", k, (k * 7) % 20) for k in range(20)] + [("h", f"h{k}", k, k) for k in range(8)]
    m = passages.spread_members(spark.createDataFrame(rows, "g string, id string, v int, w int"), ["g"], [F.desc("v")], [F.asc("w")])
    got = {}
    for r in m.collect():
        got.setdefault(r.g, []).append(r.id)
    strong, weak = ["19", "18", "17", "16"], sorted(range(20), key=lambda k: (k * 7) % 20)[:2]
    rest = [k for k in range(19, -1, -1) if f"{k:02}" not in strong and k not in weak]
    assert sorted(got["g"]) == sorted([*strong, *(f"{k:02}" for k in weak), f"{rest[round((len(rest) - 1) / 2)]:02}", f"{rest[-1]:02}"]) and len(got["h"]) == 8


def test_items_of_files(spark, tmp_path):
    page = files.render_page("<script>const DATA=__DATA__;</script>", {"batches": [{"name": "b", "clusters": [{"id": "c", "items": [{"sourceId": "s1", "author": "x", "url": "u"}, {"viewId": "v2"}]}]}]})
    for name, text in (("p.html", page), ("r.jsonl", '{"id": "i1", "batch": "b", "url": "u"}\n{"source_id": "i2"}\n'), ("d.json", '{"results": [{"source_id": "d1", "channel": "c"}, 5]}'), ("l.json", '[{"source_id": "l1"}]')):
        (tmp_path / name).write_text(text, encoding="utf-8")
    got = {n: sorted((r.source_id, r.batch, r.url) for r in files.read_items(spark, str(tmp_path / n)).collect()) for n in ("p.html", "r.jsonl", "d.json", "l.json")}
    assert got == {"p.html": [("s1", "b", "u"), ("v2", "b", None)], "r.jsonl": [("i1", "b", "u"), ("i2", None, None)], "d.json": [("d1", None, None)], "l.json": [("l1", None, None)]}
    with pytest.raises(ValueError, match="no way to read"):
        files.read_items(spark, str(tmp_path / "x.txt"))
