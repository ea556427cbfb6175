"""Groups of any size: ranges, buckets and copies under one hot key, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import dedup, evidence, passages, reviews, sources
from millrace.plans import lineage, ranking
from millrace.sources import files


def test_places_in_ranges_are_those_of_one_window(spark, monkeypatch):
    r = random.Random(3)
    rows = [(r.choice(["hot", "hot", "a", None]), k, r.randint(0, 9)) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(7)
    plain = {tuple(x) for x in ranking.ranked(df, ["g"], F.desc("v"), F.col("k")).collect()}
    monkeypatch.setattr(ranking, "GROUP_ROWS", 100)
    assert {tuple(x) for x in ranking.ranked(df, ["g"], F.desc("v"), F.col("k")).collect()} == plain
    assert ranking.ranked(df.limit(0), ["g"], F.col("k")).count() == 0


@pytest.mark.parametrize("bucket_rows", [1, 3, 50, 10_000])
def test_chunks_against_a_plain_loop(spark, bucket_rows):
    r = random.Random(bucket_rows)
    rows = [(r.choice(["hot", "hot", "b", None]), f"k{k:04}", "x" * r.choice((0, 1, 3, 9, 30, 200)) if r.random() < 0.9 else None) for k in range(400)]
    want, state = {}, {}
    for g, k, t in sorted(rows, key=lambda x: x[1]):
        n, size, chunk = state.get(g, (0, 0, 0))
        b = len(t or "")
        if n and (n >= 7 or size + b > 60):
            n, size, chunk = 0, 0, chunk + 1
        state[g] = n + 1, size + b, chunk
        want[g, k] = chunk
    df = spark.createDataFrame(rows, "g string, k string, t string")
    got = files.chunked(df, "g", "k", "t", 7, 60, bucket_rows)
    assert {(x.g, x.k): x.chunk_no for x in got.collect()} == want and got.columns == ["g", "k", "t", "chunk_no"]
    assert files.chunked(df.limit(0), "g", "k", "t", 7, 60, bucket_rows).count() == 0


def brute_near(rows):
    """Pairs and greedy survivors from their definitions."""
    grams = {i: {t[k : k + 3] for k in range(len(t) - 2)} for _, i, t in rows}
    near = set()
    for b, i, _ in rows:
        for c, j, _ in rows:
            if b == c and b is not None and i < j and grams[i] and grams[j]:
                both = len(grams[i] & grams[j])
                if both >= 0.84 * len(grams[i] | grams[j]) - 1e-9 or both >= 0.94 * min(len(grams[i]), len(grams[j])) - 1e-9:
                    near.add((b, i, j))
    kept = {}
    for b, i, t in sorted(rows, key=lambda x: (-len(x[2]), x[1])):
        first = next((j for j in kept if kept[j] == j and ((b, *sorted((i, j))) in near)), i)
        kept[i] = first
    return near, kept


def test_near_copies_against_brute_force(spark):
    r = random.Random(11)
    base = ["".join(r.choice("春夏秋冬山水风雨花鸟abc12") for _ in range(r.choice((5, 9, 20, 60, 150)))) for _ in range(25)]
    rows, seen = [], set()
    for k in range(260):
        t = r.choice(base)
        for _ in range(r.choice((0, 1, 2, 4))):
            p = r.randrange(len(t))
            t = t[:p] + r.choice("春夏秋x") + t[p + r.randint(0, 1) :]
        if r.random() < 0.3:
            t += r.choice(base)
        b = r.choice(["hot", "hot", "hot", "b", None])
        if (b, t) not in seen:
            seen.add((b, t))
            rows.append((b, f"i{k:03}", t))
    rows += [("hot", "short", "ab"), ("hot", "none", "")]
    near, kept = brute_near(rows)
    df = spark.createDataFrame(rows, "batch string, id string, norm string")
    pairs = dedup.near_pairs(df)
    got = {(x.batch, x.left_id, x.right_id) for x in pairs.collect()}
    assert got == near and len(near) > 100
    placed = ranking.ranked(df.select("batch", "id", F.length("norm").alias("n")), ["batch"], F.desc("n"), F.col("id"))
    assert {x.id: x.kept_id for x in dedup.greedy_survivors(placed, pairs).collect()} == kept
    assert len(set(kept.values())) < len(rows)
    assert dedup.near_pairs(df.limit(0)).count() == 0


def shuffled(spark):
    """Bytes written to shuffles so far."""
    each = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(each.apply(k).totalShuffleWrite() for k in range(each.size()))


def test_only_grams_that_are_looked_up_are_shuffled(spark):
    r = random.Random(5)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(600)]
    texts = ["".join(r.choices(words, range(600, 0, -1), k=60)) for _ in range(1500)]
    texts += [t[9:] + "zq" for t in texts[:40]]
    df = spark.createDataFrame([(f"b{k % 2}", f"i{k % 1500:04}{k // 1500}", t) for k, t in enumerate(texts)], "batch string, id string, norm string").repartition(4).localCheckpoint()
    began = shuffled(spark)
    got = {(x.left_id, x.right_id) for x in dedup.near_pairs(df).collect()}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert got == {(f"i{k:04}0", f"i{k:04}1") for k in range(40)}
    grams = sum(len({t[k : k + 3] for k in range(len(t) - 2)}) for t in texts)
    assert shuffled(spark) - began < 4 * grams


def test_near_copies_in_blocks_of_a_large_batch(spark, monkeypatch):
    r = random.Random(12)
    base = ["".join(r.choice("春夏秋冬山水风雨花鸟abc12") for _ in range(r.choice((5, 20, 60)))) for _ in range(12)]
    texts = sorted({t[:p] + r.choice("春夏秋x") + t[p + r.randint(0, 1) :] for t in base * 12 for p in [r.randrange(len(t))]})
    rows = [("hot" if k % 4 else "b", f"i{k:03}", t) for k, t in enumerate(texts)]
    monkeypatch.setattr(dedup, "BLOCK_CHARS", 1000)
    monkeypatch.setattr(dedup, "BROADCAST_IDS", 10)
    pairs = dedup.near_pairs(spark.createDataFrame(rows, "batch string, id string, norm string")).collect()
    near, _ = brute_near(rows)
    assert {(x.batch, x.left_id, x.right_id) for x in pairs} == near and len(pairs) == len(near) > 30


def test_meetings_are_counted_in_parts(monkeypatch):
    import numpy as np
    import pyarrow as pa

    r = random.Random(4)
    keys = [sorted(r.sample(range(60), r.randint(20, 40))) for _ in range(30)]
    keys += [k[1:] for k in keys[:10]]
    n, none = np.array([len(k) for k in keys], np.int32), np.zeros(len(keys), np.int32)
    table = pa.table({"one": [0], "two": [0], "side": pa.array([0], pa.int32()), "ids": [[str(k) for k in range(len(keys))]], "n": [n.tobytes()], "probes": [n.tobytes()], "others": [none.tobytes()], "keys": [np.array(sum(keys, []), np.uint32).tobytes()]})
    found = lambda: sorted(tuple(sorted(x)) for a, b in dedup._met(table, 0.84, 0.94, 0.9) for x in zip(a.to_pylist(), b.to_pylist(), strict=True))
    whole = found()
    assert {(str(k), str(k + 30)) for k in range(10)} <= {tuple(sorted(x, key=int)) for x in whole}
    monkeypatch.setattr(dedup, "MEETINGS_AT_ONCE", 3)
    assert found() == whole


def test_letters_beyond_a_small_alphabet():
    far = "".join(chr(0x4E00 + k) for k in range(0, 20_000)) + "".join(chr(0x20000 + k) for k in range(40_000))
    for texts in (["abcabcd", "", "ab", "zabc"], [far, far[5:] + "abc", "abc"]):
        row, g = dedup._gram_sets(texts)
        want = [(k, x) for k, t in enumerate(texts) for x in sorted({ord(t[i]) << 42 | ord(t[i + 1]) << 21 | ord(t[i + 2]) for i in range(len(t) - 2)})]
        assert list(zip(row.tolist(), g.tolist(), strict=True)) == want


def test_families_of_a_hot_text_and_of_no_text(spark):
    rows = [(f"i{k:04}", "same" if k % 2 else "") for k in range(2000)] + [("z", None), ("y", "alone")]
    got = {x.id: x.family for x in dedup.copy_families(spark.createDataFrame(rows, "id string, fingerprint string")).collect()}
    assert all(got[i] == ("i0001" if f == "same" else i) for i, f in rows)


def test_answers_go_to_copies_but_not_to_texts_without_letters(spark):
    df = spark.createDataFrame([("a", "x", "keep"), ("b", "x", None), ("c", "", "drop"), ("d", "", None), ("e", None, "drop"), ("f", None, None), ("g", "y", "keep"), ("h", "y", "drop"), ("i", "y", None)], "id string, fp string, v string")
    assert {r.id: r.v for r in reviews.propagated(df, "fp", "v").collect()} == {"a": "keep", "b": "keep", "c": "drop", "d": None, "e": "drop", "f": None, "g": "keep", "h": "drop", "i": None}
    with pytest.raises(ValueError, match="different decisions"):
        reviews.propagated(df, "fp", "v", strict=True)
    assert reviews.propagated(df.where("fp = 'x'"), "fp", "v", strict=True).where("v is null").count() == 0


def test_channels_in_their_order(spark):
    names = {"微博与境内新闻.xlsx": "境内新闻", "抖音小红书.xlsx": "小红书", "某公号.xlsx": "公众文章", "微信.xlsx": "公众文章", "新闻.xlsx": "境内新闻", "其他.xlsx": None}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n: r.c for r in df.select("n", sources.channel_of(F.col("n")).alias("c")).collect()} == names
    with pytest.raises(Exception, match="no channel in the name"):
        df.select(sources.channel_of(F.col("n"), strict=True).alias("c")).collect()


def test_ends_of_groups(spark):
    df = spark.createDataFrame([("g", str(k), k) for k in range(9)] + [("h", "x", 1)], "g string, id string, v int")
    got = {(r.g, r.id): r.stands_for for r in passages.representatives(df, "g", 2, 3, ["v", "id"]).collect()}
    assert got == {("g", "8"): "strongest", ("g", "7"): "strongest", ("g", "0"): "weakest", ("g", "1"): "weakest", ("g", "2"): "weakest", ("h", "x"): "strongest"}


def test_spans_of_many_texts_are_those_of_each():
    r = random.Random(2)
    pool = ["今天天气不错", "，", "。", "！", "\n", "\r", "但是", "①", "#话题#", " ", "一" * 30, "x", "；", ":"]
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 60))) for _ in range(200)]
    row, a, b = evidence.spans(texts)
    got = [[] for _ in texts]
    for i, x, y in zip(row.tolist(), a.tolist(), b.tolist(), strict=True):
        got[i].append((x, y))
    assert got == [evidence.spans_of(t) for t in texts]
    assert evidence.spans_of("好" * 200 + "，" + "坏" * 20) == [(0, 201), (201, 221)]
    assert evidence.spans_of("好" * 100 + " ①" + "坏" * 100) == [(0, 100), (100, 202)]
    assert evidence.spans_of("好" * 300) == [(0, 140), (140, 280), (280, 300)]


def test_no_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.shared_dir(Session())
