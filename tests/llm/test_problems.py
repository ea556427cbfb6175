import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import catalog, lines, lookalikes, mixing, quality, sentences, severity, stuffing, tokens
from millrace.llm.codepoints import from_code_points, slices, to_code_points


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_runs_over_whole_tables(spark, data, name):
    df = catalog.QUERIES[name](spark, data)
    rows = df.count()
    if name.endswith("_found"):
        assert df.distinct().count() == rows
    size = {n: spark.read.parquet(f"{data}/{n}.parquet").count() for n in ("documents", "normalized_sources", "records")}
    expected = {"p8_ids": size["documents"], "p10_statistics": size["documents"], "p3_clean": size["normalized_sources"], "p6_forms": size["normalized_sources"] + size["records"], "p1_scores": size["normalized_sources"] + size["records"]}
    assert rows == expected.get(name, rows) and rows > 0


# ---- code points, one form ----------------------------------------------------------------------------------------


def texts(seed, n, size=30):
    r = random.Random(seed)
    pool = [c for c in range(0x20, 0x3100) if unicodedata.category(chr(c)) not in ("Cn", "Cc", "Cf", "Zs", "Zl", "Zp", "Cs", "Co") and c not in lookalikes.INKLESS and not 0x2E80 <= c <= 0x2FDF and not unicodedata.decomposition(chr(c)).startswith("<")]
    pool += [*range(0xAC00, 0xAD00), *range(0x1100, 0x1113), *range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]
    marks = [c for c in pool if unicodedata.combining(chr(c))]
    return ["".join(chr(r.choice(pool if r.random() < 0.5 else marks if r.random() < 0.6 else range(0x41, 0x7B))) for _ in range(r.randint(0, size))) for _ in range(n)]


def test_code_points_round_trip():
    t = [*texts(1, 500), None, "", "🔥😀", "一" * 1000]
    col = pa.array(t)
    assert from_code_points(*to_code_points(col)).to_pylist() == [x or "" for x in t]
    assert from_code_points(*to_code_points(col.slice(3, 100))).to_pylist() == t[3:103]
    batch = pa.RecordBatch.from_arrays([col], names=["t"])
    assert sum(s.num_rows for s in slices(batch, 0, 100)) == len(t)


def test_composition_is_nfc():
    lookalikes.tables.cache_clear()
    t = texts(2, 4000)
    same = dict(lookalikes.LOOK_ALIKE)
    lookalikes.LOOK_ALIKE.clear()
    try:
        got = from_code_points(*lookalikes.one_form(*to_code_points(pa.array(t)), look_alike=False)).to_pylist()
    finally:
        lookalikes.LOOK_ALIKE.update(same)
        lookalikes.tables.cache_clear()
    assert got == [unicodedata.normalize("NFC", x) for x in t]


@pytest.mark.parametrize("a, b, alike", [("Ａｂｃ１２！", "Abc12!", True), ("café", "café", True), ("ab​c", "abc", True), ("a b", "a b", True), ("Моѕѕ", "Mocc", False), ("Mоss", "Moss", True), ("⼈家", "人家", True), ("浪", "浪", True), ("ｶﾞ", "ガ", True), ("①", "1", False), ("abc", "Abc", False), ("a。", "a.", False), ("a  b", "a b", False), ("한", "한", True)])
def test_looks_alike(a, b, alike):
    x, y = from_code_points(*lookalikes.one_form(*to_code_points(pa.array([a, b])))).to_pylist()
    assert (x == y) is alike


def test_pairs_of_a_hot_form(spark):
    r = random.Random(1)
    rows = [("t", f"i{k:04}", r.choice(["Abc", "Abc", "Ａbc", "Аbc"])) for k in range(300)] + [("t", f"j{k}", f"text {k}") for k in range(300)]
    keys = lookalikes.form_keys(spark.createDataFrame(rows, "tab string, id string, text string"), "text", ["tab", "id"])
    want = {(x[1], y[1]) for x in rows[:300] for y in rows[:300] if x[1] < y[1] and x[2] != y[2]}
    got = lookalikes.alike_pairs(keys, block_rows=40).collect()
    assert len(got) == len(want) and {(x.id_a, x.id_b) for x in got} == want
    links = {x.id: x.n_links for x in lookalikes.alike_classes(keys).collect()}
    assert all(links[i] == sum(i in p for p in want) for _, i, _ in rows)


def test_digests_tell_texts_apart():
    some = texts(6, 3000) + ["", "a", "ab", "ba", "aa", "a\x00", "\x00a", "\x00"]
    p, at = to_code_points(pa.array(some))
    got = lookalikes.digests(p, at).to_pylist()
    assert len(set(got)) == len(set(some)) and all(len(d) == 16 for d in got)
    again = lookalikes.digests(*to_code_points(pa.array(some[::-1]))).to_pylist()
    assert again == got[::-1]


@pytest.mark.parametrize("a, b, alike", [("σοω", "oow", False), ("γη", "yn", False), ("νοw", "vow", True), ("ⲟк", "oк", True), ("ᴄᴏᴍ", "coм", True), ("т", "τ", False)])
def test_what_readers_tell_apart(a, b, alike):
    x, y = from_code_points(*lookalikes.one_form(*to_code_points(pa.array([a, b])))).to_pylist()
    assert (x == y) is alike


def test_pairs(spark):
    rows = [("t", "a", "Ａ1"), ("t", "b", "A1"), ("t", "c", "A1"), ("t", "d", None), ("t", "e", ""), ("t", "f", "​"), ("u", "g", "Ａ1"), ("t", "h", "A１")]
    df = spark.createDataFrame(rows, "tab string, id string, text string")
    keys = lookalikes.form_keys(df, "text", ["tab", "id"])
    want = {("t", "a", "b"), ("t", "a", "c"), ("t", "a", "h"), ("t", "b", "h"), ("t", "c", "h")}
    assert {tuple(r) for r in lookalikes.alike_pairs(keys).collect()} == want
    assert {tuple(r) for r in lookalikes.alike_pairs(keys, block_rows=1, spread=3).collect()} == want
    classes = {(r.tab, r.id): (r["class"], r.n_links) for r in lookalikes.alike_classes(keys).collect()}
    assert classes == {("t", "a"): ("a", 3), ("t", "b"): ("a", 2), ("t", "c"): ("a", 2), ("t", "h"): ("a", 3), ("u", "g"): ("g", 0)}
    assert lookalikes.alike_pairs(keys.limit(0)).count() == 0
    forms = {r.id: r.form for r in lookalikes.with_form(df, "text", ["id"]).collect()}
    assert forms["d"] is None and forms["e"] == "" and forms["a"] == "A1"


# ---- tokens -------------------------------------------------------------------------------------------------------


def reference(texts):
    import base64

    import tiktoken

    with open(tokens.vocabulary_path("byte_bpe_50k"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=tokens.WORDS.pattern, mergeable_ranks=ranks, special_tokens={})
    return [enc.encode_ordinary(t) if t else [] for t in texts]


def test_ids_are_those_of_the_public_tokenizer(spark):
    t = [*texts(3, 300), None, "", " ", "\n\n  x", "a" * 5000, "ha" * 900, "！" * 700, "ก" * 400, "🤮" * 90, "don't you'll WE'VE", "<|endoftext|>", "\x00\x01é�", "naïve Ünïcödé", "مرحبا بالعالم", "数え切れないほどの言葉", "x" * 100_000 + " y"]
    df = spark.createDataFrame([(k, x, "s") for k, x in enumerate(t)], "doc_id long, text string, ids string")
    got = {r.doc_id: r.ids for r in tokens.token_ids(df, "doc_id", "text").collect()}
    assert [got[k] for k in range(len(t))] == reference(t)
    counts = {r.doc_id: r.n_tokens for r in tokens.token_ids(df, "doc_id", "text", counts=True, keep=("ids",)).collect()}
    assert counts == {k: len(v) for k, v in got.items()}
    assert tokens.token_ids(df.limit(0), "doc_id", "text").count() == 0


def test_corpus_ids(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.ids for r in catalog.QUERIES["p8_ids"](spark, data).collect()}
    assert [got[d.doc_id] for d in docs] == reference([d.text for d in docs])


def test_encoder_forgets_and_still_agrees():
    keep = tokens.KEEP_WORDS, tokens.KEEP_ATOMS
    tokens.KEEP_WORDS = tokens.KEEP_ATOMS = 5
    try:
        enc = tokens.Encoder(tokens.vocabulary_path("byte_bpe_50k"))
        for part in (texts(4, 50), texts(5, 50), texts(4, 50)):
            ids, at = enc.encode(part)
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == reference(part)
    finally:
        tokens.KEEP_WORDS, tokens.KEEP_ATOMS = keep


def test_long_words_are_joined_from_windows():
    r = random.Random(7)
    letters = lambda n, pool="abcdefghijklmnopqrstuvwxyz": "".join(r.choice(pool) for _ in range(n))
    whole = [letters(n) for n in (63, 64, 65, 97, 129, 800, 20_000)] + ["=" * 5000, "abc" * 3000, "=-" * 900, letters(4000, "аеиост"), letters(2000, "ab"), "0123456789" * 300]
    whole += [letters(r.randint(60, 400), ("the", "ing", "a", "z", "tion", "Q")) for _ in range(200)]
    enc = tokens.Encoder(tokens.vocabulary_path("byte_bpe_50k"))
    ids, at = enc.encode(whole)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == reference(whole)


# ---- repeated lines -----------------------------------------------------------------------------------------------


def brute_lines(rows):
    n, hits, places = {}, {}, []
    for i, s, b in rows:
        if s is None:
            continue
        n[s] = n.get(s, 0) + 1
        seen = set()
        for k, line in enumerate((b or "").split("\n"), 1):
            f = lines.line_form(line)
            if f:
                places.append((i, k, s, f))
                seen.add(f)
        for f in seen:
            hits[s, f] = hits.get((s, f), 0) + 1
    return {(i, k) for i, k, s, f in places if hits[s, f] >= 5 and hits[s, f] >= 0.05 * n[s]}


@pytest.mark.parametrize("prune, most", [(20_000, 200_000), (3, 200_000), (3, 0)])
def test_repeated_lines_against_brute_force(spark, monkeypatch, prune, most):
    monkeypatch.setattr(lines, "PRUNE_AT", prune)
    monkeypatch.setattr(lines, "BROADCAST_LINES", most)
    r = random.Random(9)
    site = ["版权所有 2024", "关注我们！", "Share this", "阅读 12  点赞 3"]
    rows = []
    for k in range(600):
        s = r.choice(["a", "a", "b", None])
        body = [f"post {r.random()}" for _ in range(r.randint(0, 4))] + [x.replace("12", str(r.randint(1, 99))).replace(" ", r.choice((" ", "　"))) for x in site if r.random() < {"a": 0.3, "b": 0.04}.get(s, 0.5)]
        r.shuffle(body)
        rows.append((f"i{k}", s, r.choice(["\n".join(body)] * 9 + [None, "", "ＳＨＡＲＥ this\nshare​ this\n\n"])))
    df = spark.createDataFrame(rows, "id string, channel string, body string").repartition(5)
    want = brute_lines(rows)
    got = {tuple(x) for x in lines.repeated_places(df, "id", "channel", "body").collect()}
    assert got == want and want
    clean = {x.id: x.body for x in lines.without_repeated(df, "id", "channel", "body", ["id"]).collect()}
    for i, _, b in rows:
        assert clean[i] == (None if b is None else "\n".join(x for k, x in enumerate(b.split("\n"), 1) if (i, k) not in want))


@pytest.mark.parametrize("prune", [20, 300, 10**6])
def test_summaries_stay_small_and_miss_nothing(monkeypatch, prune):
    monkeypatch.setattr(lines, "PRUNE_AT", prune)  # here and not in a worker, which wouldn't see it
    r = random.Random(5)
    rows = [(f"s{min(int(r.expovariate(0.4)), 40)}", "\n".join([f"x{r.random()}"] * 2 + [f"site {r.choice('abcdef') * 2}"] * (r.random() < 0.3))) for _ in range(4000)]
    most, seen, n = {}, {}, {}
    for a in range(0, 4000, 1000):  # four tasks
        batch = pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows[a : a + 1000]]) for c in (0, 1)], names=["source", "body"])
        for out in lines._summaries(iter([batch.slice(k, 100) for k in range(0, 1000, 100)])):
            for s, k, m, c in zip(*(out.column(j).to_pylist() for j in range(4)), strict=True):
                if k is None:
                    n[s] = n.get(s, 0) + c
                else:
                    most[s, k], seen[s, k] = most.get((s, k), 0) + m, seen.get((s, k), 0) + c
    true = {}
    for s, b in rows:
        for k in set(lines.line_keys(b, {})):
            true[s, k] = true.get((s, k), 0) + 1
    assert sum(n.values()) == 4000
    for (s, k), c in true.items():
        assert c <= most.get((s, k), 0) + lines.EPS * (n[s] - seen.get((s, k), 0)) + 1e-9


def test_lines_of_one_form_have_the_same_ends():
    r = random.Random(8)
    alike = [("e\u0301t\u00e9", "\u00e9te\u0301"), ("\uff21bc\uff01", "abc!"), (" \u200b\u2460\u3000x", "1x"), ("\u1100\u1161\u11a8", "\uac01"), ("\ufb01n", "FIN"), ("\u00df", "SS"), ("\u0130x", "i\u0307x"), ("12\u00bd", "31\u20442"), ("\u00a8a", "\u0308a"), ("\u2075", "7")]
    for a, b in alike:
        assert lines.line_form(a) == lines.line_form(b) and lines.line_ends(a) == lines.line_ends(b), (a, b)
    for t in texts(9, 4000):
        same = r.choice((unicodedata.normalize("NFD", t), unicodedata.normalize("NFKC", t), t.upper(), f" {t}\u200b", unicodedata.normalize("NFKD", t).casefold()))
        if lines.line_form(same) == lines.line_form(t):
            assert lines.line_ends(same) == lines.line_ends(t), (t, same)
        if not lines.line_form(t):
            assert lines.line_ends(t) == ""


def test_no_lines(spark):
    df = spark.createDataFrame([], "id string, channel string, body string")
    assert lines.repeated_places(df, "id", "channel", "body").count() == 0
    assert lines.without_repeated(df, "id", "channel", "body", ["id"]).count() == 0
    few = spark.createDataFrame([(str(k), "c", "same") for k in range(4)], "id string, channel string, body string")
    assert lines.repeated_places(few, "id", "channel", "body").count() == 0


# ---- sentences ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "parts",
    [
        ["他走了。", "她也走了？！", "真的……。"],
        ["“先别关灯。等我说完。”老人对他说道。", "天亮了。"],
        ["庾暮遥问：“你看懂结局了吗？”", "回过头看，一切都清楚。"],
        ["她只回了一句“别回头。”就走进了渡口。", "他停了很久……才说出名字。"],
        ["字幕里写着“第34集（v2.0）完”，大家才反应过来；成本是3.7万。", "好。"],
        ["No.24展厅循环播放花絮。", "官方资料见www.show1.example，里面有说明。"],
        ["Dr. Okvara told us that it took 40 days.", " We left at 4:38 p.m.", " We never came back."],
        ['"Wait. Listen to it again," Haldrey said, and it dropped out.', " It ended."],
        ['She only said, "It was never about the boat."', " Nobody spoke."],
        ["Ｄｒ． Ｂｒｕｎｔｅｌ ｔｏｌｄ ｕｓ ｉｔ ｔｏｏｋ ３．２ ｄａｙｓ．", " Ｗｅ ｌｅｆｔ．"],
        ['问："你看懂了吗？"', "回过头看，一切都清楚。"],
        ["The editing ... well, it is too thin.", " Viewers in the U.K. saw it 43 days earlier."],
        ["See No. 38 at www.reel1.example for the notes.", " J. R. Bruntel edited it, i.e. alone!"],
        ["« Éteignez la lampe ! » crie le gardien à minuit.", " La note est de 3,5."],
        ["Dr. Vosmere lobt z. B. den Schnitt.", " Am 3. März lief er."],
        ["La Dra. Tessling habló del guión en EE. UU. y aquí.", " ¿Por qué quemó la carta?"],
        ["「まだ終わっていない。」と彼女は言った。", "彼は一言、「帰ろう。」", "雨が降った。"],
        ["संवाद छोटे हैं।", " उसने पत्र क्यों जलाया?"],
        ["صاح الحارس: «لا تطفئ المصباح!»", " لماذا أحرق الرسالة؟"],
        ["ตอนจบรีบไปหน่อย", " คะแนน 4.8 จากผู้ชมรอบแรก", " ดีมาก"],
        ["没有标点的一句", " 第二句也没有", " 结束了"],
        ["第一行没有句号", "\n\n第二行。", "还有。"],
    ],
)
def test_sentences(parts):
    ends, at = [], 0
    for p in parts:
        at += len(p)
        ends.append(at)
    assert sentences.sentence_ends("".join(parts)) == ends


def test_sentences_of_nothing_and_of_much(spark):
    assert sentences.sentence_ends("") == [] and sentences.sentence_ends(" \n　\n") == []
    long = "一句话。" * 50_000
    assert len(sentences.sentence_ends(long)) == 50_000
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "好。“没有闭合的引号。然后结束。")], "id string, text string")
    assert sentences.units(df, "text", ["id"]).where("id != 'c'").count() == 0


def brute_line_ends(line):
    """The best chain of spans by trying every beginning of every span."""
    last = len(line.rstrip())
    places = [p for p in sentences._weights(line, False) if p[0] < last]
    cuts = [0, *(e for e, _, _ in places), last]
    gains, quoted = [0.0, *(w for _, _, w in places), 0.0], sentences._quotations(line)
    broken = [sentences.UNBALANCED if 0 < k < len(cuts) - 1 and any(a <= c <= b for a, b in quoted) else 0.0 for k, c in enumerate(cuts)]
    letters = lambda i, j: len(sentences._LETTER.findall(line, cuts[i], cuts[j]))
    short = lambda n: sentences.SHORT[n] if n < len(sentences.SHORT) else 0.0
    best = [(0.0, [])]
    for j in range(1, len(cuts)):
        each = [(round(best[i][0] + gains[j] - broken[i] - broken[j] - short(letters(i, j)), 6), -i) for i in range(j)]
        score, i = max(each)
        best.append((score, [*best[-i][1], cuts[j]]))
    ends = best[-1][1]
    if len(ends) > 1 and sentences._EMOTE.fullmatch(line, ends[-2], ends[-1]):
        del ends[-2]
    return ends


def test_spans_over_any_number_of_possible_ends():
    quotation = "他说：“" + "等一等……" * 150 + "”后来他走了。"
    assert sentences.sentence_ends(quotation + "天晴了。") == [len(quotation) - 6, len(quotation), len(quotation) + 4]
    decimals = "The values are " + " ".join(f"{k}.{k}" for k in range(200)) + " in this run."
    assert sentences.sentence_ends(decimals + " It ended.") == [len(decimals), len(decimals) + 10]


def test_a_quotation_of_any_number_of_sentences_is_one_unit():
    for n in (1, 3, 6, 40, 500):
        for a, b in ("“”", "「」", "«»", '""', "„“", "（）"):
            whole = "他说：" + a + "".join(f"第{k}次不行。" for k in range(n)) + b + "，然后他离开了。"
            assert sentences.sentence_ends(whole + "天晴了。") == [len(whole), len(whole) + 4]
            whole = "He said " + a + " ".join(f"It failed {k} times." for k in range(n)) + b + " and then he left."
            assert sentences.sentence_ends(whole + " It rained.") == [len(whole), len(whole) + 11]


def test_marks_without_their_other_half_bound_nothing():
    for stray in ("“", "”", "「", "(", ")", "»", '"'):
        text = f"第一句{stray}在这里。第二句话。第三句话。"
        assert sentences.sentence_ends(text) == [8, 13, 18]
    assert sentences.sentence_ends('A 5" screen is small. It is dark. A 7" one is better.') == [21, 33, 53]


def test_best_spans_against_brute_force():
    r = random.Random(12)
    parts = ["。", "！", ". ", "? ", "…", "“", "”", "「", "」", "(", ")", "\"", "3.14", "1.2.3", "他走了", "很好", "The cat", "it", "Mr", "a", "!", " ", "，", "：", "说"]
    for n in (5, 20, 60, 150):
        for _ in range(60):
            line = "好" + "".join(r.choice(parts) for _ in range(n))
            assert sentences._line_ends(line, False) == brute_line_ends(line), line


# ---- severity -----------------------------------------------------------------------------------------------------


def test_severity_on_held_out_texts(spark):
    r = random.Random(4)
    who = ["导演", "编剧", "女主", "楼上", "这位", "大家"]
    bad = ["{}就是个蠢材，看见就恶心", "给我滚出去，{}这个败类", "{}怎么还有脸活着", "想把{}打到爬着走"]
    good = ["{}的采访写得很好", "我和{}一起看了首映", "{}谈到自己被网友辱骂", "这一集{}的表现平平", "剧情烂透了，{}浪费时间"]
    def make(n, p):
        return [((r.choice(bad) if y else r.choice(good)).format(r.choice(who)) + r.choice(("", "。", "！")), y) for y in (r.random() < p for _ in range(n))]
    train, test = make(400, 0.3), make(300, 0.3)
    long = [("天气很好。" + t + "。我们去散步。", y) for t, y in make(60, 0.5)]
    rows = [("t", f"a{k}", t) for k, (t, _) in enumerate(train + test + long)]
    df = spark.createDataFrame(rows + [("t", "n", None), ("t", "e", "")], "tab string, id string, text string")
    labels = spark.createDataFrame([("t", f"a{k}", int(y) if r.random() > 0.03 else 1 - int(y)) for k, (_, y) in enumerate(train)] + [("t", "a0", None)], "tab string, source_id string, abusive int")
    got = {x.id: x for x in severity.scored(df, labels, ["id"]).collect()}
    truth = [y for _, y in train + test + long]
    held = range(len(train), len(rows))
    right = sum(got[f"a{k}"].found == truth[k] for k in held)
    assert right / len(held) > 0.95
    assert got["n"].severity is None and not got["n"].found and not got["e"].found
    assert not any(x.found for x in severity.scored(df, labels.limit(0), ["id"]).collect())
    assert severity.scored(df.limit(0), labels, ["id"]).count() == 0


def test_thresholds_are_ordered():
    m = severity.train(["坏人坏人坏蛋", "好人好人好事"] * 30, [2, 0] * 30)
    assert (np.diff(m.thresholds) > 0).all()


def test_disguises_make_the_same_letters():
    s = severity.streams(*to_code_points(pa.array(["狗~东~西", "狗 东​西", "狗东西"])))
    assert [s.letters[s.sentence == k].tolist() for k in range(3)] == [[ord(c) for c in "狗东西"]] * 3
    a = severity.streams(*to_code_points(pa.array(["D1E p!g", "die pig"])))
    assert a.letters[a.sentence == 0].tolist() == a.letters[a.sentence == 1].tolist()


# ---- stuffing, quality --------------------------------------------------------------------------------------------


def test_stuffed_pages(spark):
    r = random.Random(6)
    docs = quality.labelled_documents(600, 5)
    rows = [(f"p{k}", t) for k, (t, j) in enumerate(docs) if not j]
    spam = ["，".join(["雾港之夜下载"] * 40), "\n".join(f"入口{k} https://dl{k}.example/p/{r.randint(1, 10**6)}" for k in range(30)), "#水杯 #雨伞# #背包 #茶壶# " * 12]
    rows += [(f"s{k}", t) for k, t in enumerate(spam)] + [("n", None), ("e", "")]
    got = {x.id: x.hit for x in stuffing.redundancy(spark.createDataFrame(rows, "id string, body string"), "id", "body").withColumn("hit", stuffing.is_stuffed()).collect()}
    assert all(got[f"s{k}"] for k in range(3))
    # the sample's texts are made of a few phrases each, more redundant than others
    assert sum(v for k, v in got.items() if k[0] == "p") <= 0.08 * len(rows)
    assert "n" not in got and got["e"] is False
    assert stuffing.redundancy(spark.createDataFrame([], "id string, body string"), "id", "body").count() == 0


def test_short_and_long_tags_and_short_bodies(spark):
    rows = [("tags", "#手机壳 #钢化膜# #包邮"), ("links", "https://a.example/1 https://b.example/2"), ("words", "手机壳 膜 手机壳 膜 手机壳 手机壳 膜"), ("one", "#电影# 今晚去看"), ("talk", "好看，好看，真好看。"), ("laugh", "哈哈哈哈哈哈"), ("two", "推荐 #电影# #追剧# 这部片子的摄影真的很用心")]
    rows += [("wide", " ".join("#" + "好" * 60 + str(k) + "#" for k in range(30))), ("cells", "".join(f'<td data-x="{"a" * 400}{k}">1</td>' for k in range(20)))]
    rows += [(f"p{k}", t) for k, (t, j) in enumerate(quality.labelled_documents(600, 5)) if not j]
    got = stuffing.redundancy(spark.createDataFrame(rows, "id string, body string"), "id", "body").where(stuffing.is_stuffed())
    assert {x.id for x in got.collect() if x.id[0] != "p"} == {"tags", "links", "words", "wide", "cells"}


def test_stuffed_pages_that_are_many(spark):
    r = random.Random(4)
    signs, thai = [chr(c) for c in range(0x4E00, 0x4E00 + 700)], [chr(c) for c in range(0xE01, 0xE2F)]
    sentence = lambda pool, mark: "".join(r.choice(pool) for _ in range(r.randint(6, 24))) + mark
    rows = [(f"p{k}", "".join(sentence(signs, "。") for _ in range(r.randint(8, 20)))) for k in range(300)]
    rows += [(f"p{k}", " ".join(sentence(thai, "") for _ in range(r.randint(8, 20)))) for k in range(300, 500)]
    word = lambda pool, n: "".join(r.choice(pool) for _ in range(n))
    rows += [(f"s{k}", f"{word(signs, 4)}下载。" * 40) for k in range(60)]  # a sixth of the language, with full stops
    rows += [(f"s{k}", f"{word(thai, 9)} " * 30) for k in range(60, 90)]
    copy = f"{word(signs, 4)}资源。" * 40
    rows += [(f"s{k}", copy) for k in range(90, 690)]  # two thirds of the rows are one page
    got = stuffing.redundancy(spark.createDataFrame(rows, "id string, body string"), "id", "body")
    assert set(got.columns) == {"id", "language", "n", "text_rate", "outline_rate", "marks_rate", "depth", "n_signs", "sign_share", "repeated"}
    found = {x.id for x in got.where(stuffing.is_stuffed()).collect()}
    assert found == {k for k, _ in rows if k[0] == "s"}


def test_rules_on_held_out_documents(spark):
    docs = quality.labelled_documents(600, 99)  # another seed than the rules' own
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(docs)] + [(9001, None), (9002, ""), (9003, " \n　")], "doc_id long, text string")
    found = {r.doc_id for r in quality.no_prose(df, "doc_id", "text").collect()}
    assert sum((k in found) == j for k, (_, j) in enumerate(docs)) / len(docs) > 0.95
    assert not found & {9001, 9002, 9003}
    assert quality.no_prose(df.limit(0), "doc_id", "text").count() == 0


def test_statistics(spark):
    df = spark.createDataFrame([(1, "The cat sat. It is 12.\nNo end"), (2, "他的书，很好。"), (3, ""), (4, None)], "doc_id int, text string")
    got = {r.doc_id: r for r in quality.with_statistics(df, "text", ["doc_id"]).collect()}
    a, b = got[1], got[2]
    assert (a.n_words, a.n_lines, a.ended_lines) == (8, 2, 0.5) and a.mean_word_length == 20 / 8
    assert (b.n_words, b.ended_lines, b.ended_share) == (5, 1.0, 1.0)
    assert got[3].n_chars == 0 and got[3].symbol_ratio is None and got[4].n_chars is None


def test_junk_whose_lines_end_in_marks(spark):
    r = random.Random(8)
    base64 = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(400)) + "."
    texts = {
        "run": "ha" * 200 + "!",
        "data": base64,
        "json": "{" + ",".join(f'"k{k}":{r.randint(0, 9999)}' for k in range(40)) + "}.",
        "log": "\n".join(f"[{r.randint(1, 9999)}] INFO id={r.randint(1, 9999)} t=0.{r.randint(1, 9999)} rc=0 done." for _ in range(20)),
        "table": "\n".join(f"| {r.randint(1, 999)} | {r.randint(1, 999)} | {r.randint(1, 999)} |." for _ in range(20)),
        "items": "\n".join(f"{k}. 东港旧事{k}!" for k in range(1, 30)),
        "wide": "\n".join("｜".join(("ＡＢＣＤ", "ＧＨＪ", "ＫＬ", "ＰＱ")) for _ in range(20)),
        "prose": "\n".join("他昨天在图书馆里等了很久，后来还是决定先走。" for _ in range(4)),
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = {x.doc_id: x for x in quality.with_statistics(df, "text", ["doc_id"]).collect()}
    assert got["run"].run_share > 0.9 and got["data"].data_share > 0.9 and got["json"].data_share > 0.3 and got["log"].data_share > 0.4
    assert got["table"].table_share > 0.9 and got["items"].item_share > 0.9 and got["wide"].table_share > 0.9
    assert got["prose"].table_share == 0 and got["prose"].item_share == 0
    assert {x.doc_id for x in quality.no_prose(df, "doc_id", "text").collect()} == set(texts) - {"prose"}


def test_full_width_text_counts_as_the_usual_one():
    pairs = [("ＴＨＥ　ＯＦ　ＡＮＤ　ＦＯＲ", "the of and for"), ("ｗｅ ｗｅｒｅ ｈｅｒｅ", "we were here"), ("Ａ：Ｂ", "A:B"), ("好：看", "好：看")]
    got = quality.measured(pa.array([t for p in pairs for t in p]))
    for name, v in got.items():
        assert np.array_equal(v[::2], v[1::2], equal_nan=True), name


def test_statistics_of_texts_together_are_those_of_each():
    some = [t for t, _ in quality.labelled_documents(300, 4)] + ["", "\n", "\n\n\nab\r\n", "\r", "a\u2028b</s>c", "  ", "😀" * 30, "\u200b"]
    together = quality.measured(pa.array(some))
    for k, t in enumerate(some):
        for name, v in quality.measured(pa.array([t])).items():
            assert np.array_equal(v[0], together[name][k], equal_nan=True), (name, t)


def test_statistics_of_hidden_and_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert quality.with_statistics(df, "text", ["doc_id"]).count() == 0
    assert set(quality.with_statistics(df, "text", ["doc_id"]).columns) == {"doc_id", *quality.COUNTS, *quality.SHARES}


def test_induction_finds_a_plain_rule():
    r = np.random.default_rng(1)
    x = {"a": r.random(900), "b": r.random(900)}
    y = (x["a"] > 0.6) & (x["b"] <= 0.5)
    rules = quality.best_rules(x, y)
    hit = np.any([quality._covers(t, x) for t in rules], axis=0)
    assert (hit == y).mean() > 0.97


# ---- mixing -------------------------------------------------------------------------------------------------------


def test_permutation():
    for n in (1, 2, 3, 10, 1000):
        for key in (0, 7):
            assert sorted(mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key))) == list(range(n))


def test_quotas():
    give = mixing.quotas(np.array([0.5, 0.3, 0.2, 0.1]), np.array([100, 10, 50, 0]), np.array([1, 3, 2, 5]))
    assert give.sum() == 100 and give.tolist() == [50, 30, 20, 0]
    assert mixing.quotas(np.zeros(2), np.array([1, 1]), np.array([1, 1])).sum() == 0


def test_mixture(spark):
    words = "one two three four five six seven eight nine ten ".split()
    r = random.Random(2)
    docs = [(k, " ".join(r.choice(words) for _ in range(r.randint(0, 900))), r.choice(["a", "a", "a", "b", "c", None])) for k in range(120)] + [(500, None, "a"), (501, "", "b")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.5, 3), ("c", 0.1, 4), ("none", 0.1, 1)], "source string, target_share double, max_repeats int")
    size = mixing.sizes(df, targets)
    total = {x.source: x.n for x in size.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    p = mixing.pieces(size)
    assert {x.source: x.n for x in p.groupBy("source").agg(F.sum("n").alias("n")).collect()} == total
    blocks = p.groupBy("source", "block").agg(F.sum("n").alias("n"))
    assert blocks.where(F.col("n") > mixing.BLOCK_TOKENS).count() == 0
    short = blocks.where(F.col("n") < mixing.BLOCK_TOKENS).groupBy("source").count().where("count > 1")
    assert short.count() == 0
    rows = mixing.mixture(spark, df, targets).collect()
    again = mixing.mixture(spark, df, targets).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again)) and rows
    limits = {"a": 1, "b": 3, "c": 4}
    read = {}
    for x in rows:
        read[x.source, x.block] = read.get((x.source, x.block), 0) + 1
    assert all(n <= limits[s] for (s, _), n in read.items())
    got = {x.source: x for x in mixing.shares(spark, df, targets).collect()}
    out = {s: sum(x.n_tokens for x in rows if x.source == s) for s in limits}
    for s, share in (("a", 1 / 3), ("b", 5 / 9), ("c", 1 / 9)):
        assert got[s].tokens_out == out[s] and abs(got[s].actual_share - share) < 0.03
    assert got["none"].blocks_out == 0
    assert mixing.mixture(spark, df.limit(0), targets).count() == 0
    assert mixing.mixture(spark, df, targets.limit(0)).count() == 0


def test_draws_meet_the_quotas(spark):
    give, blocks = np.array([40_000, 700, 0, 9_300]), np.array([40_000, 100, 5, 4_000])
    p = mixing.Plan(["a", "b", "c", "d"], give / give.sum(), np.array([1, 7, 1, 3]), blocks * 512, blocks, give)
    drawn = {(x.shard, x.k): x.n for x in mixing.draws(spark, p).collect()}
    shards = mixing.shard_count(p)
    assert {s for s, _ in drawn} == set(range(shards)) and sum(drawn.values()) == give.sum()
    rows = mixing.slots(spark, p).collect()
    by = {}
    for x in rows:
        by.setdefault(x.source, []).append((x.reading, x.block))
    assert {s: len(v) for s, v in by.items()} == {"a": 40_000, "b": 700, "d": 9_300}
    assert all(len(set(v)) == len(v) for v in by.values())
    assert {x for x in by["b"]} == {(k, b) for k in range(7) for b in range(100)}
    size = [sum(n for (s, _), n in drawn.items() if s == k) for k in range(shards)]
    slots = {}
    for x in rows:
        slots.setdefault(x.shard, set()).add(x.slot)
    assert [slots[k] for k in range(shards)] == [set(range(n)) for n in size]


def test_mixture_holds_its_records(spark):
    r = random.Random(3)
    docs = [(k, " ".join(r.choice(("one", "two", "three", "four")) for _ in range(r.choice((3, 40, 1300)))), r.choice("ab")) for k in range(90)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    size = {x.doc_id: x.n_tokens for x in mixing.sizes(df, targets).collect()}
    rows = mixing.mixture(spark, df, targets).collect()
    assert max(x.n_docs for x in rows) > 2 and {x.reading for x in rows} > {0}
    blocks = {(x.source, x.block): x for x in rows}
    for x in rows:
        assert x.pieces == blocks[x.source, x.block].pieces and x.first_doc_id == x.pieces[0].doc_id
        assert len(x.pieces) == x.n_docs and sum(p.n for p in x.pieces) == x.n_tokens
    # read block by block, a source's documents follow each other, each from its first token to its last
    whole = [s for s in "ab" if sum(k[0] == s for k in blocks) == 1 + max(k[1] for k in blocks if k[0] == s)]
    assert whole
    for s in whole:
        joined = {}
        for _, x in sorted((k, x) for k, x in blocks.items() if k[0] == s):
            for p in x.pieces:
                assert p.first == joined.get(p.doc_id, 0)
                joined[p.doc_id] = p.first + p.n
        own = {k: size[k] for k, _, source in docs if source == s}
        missing = set(own) - set(joined)
        assert not missing and joined == own
