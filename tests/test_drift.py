from datetime import datetime

from pyspark.sql import functions as F

from millrace.operators import drift

NAMES = [("标题", "title"), ("点赞数", "likes"), ("点赞量", "likes"), ("正文", "body")]


def frames(spark, rows, files):
    return spark.createDataFrame(rows, "source_file string, data string"), spark.createDataFrame([(f, "feed", datetime(2024, 1, k + 1), "records") for k, f in enumerate(files)], "source_file string, feed string, exported_at timestamp, held_in string")


def test_changes(spark):
    rows = [("f1", '{"标题": "x", "点赞数": 3, "备注": 1}'), ("f1", '{"标题": "y", "点赞数": "--"}'), ("f2", '{"标题": 5, "点 赞量": "1", "新": null}'), ("f2", "no json"), ("f3", '{"标题": 5, "点赞量": 2, "新": 1}'), ("f3", None), ("f4", '{"标题": 5, "点赞量": true, "新": 1}')]
    r, f = frames(spark, rows, ["f1", "f2", "f3", "f4"])
    got = {tuple(x) for x in drift.schema_changes(r, f, NAMES).collect()}
    assert got == {("f2", "renamed", "点赞数", "点 赞量"), ("f2", "removed", "备注", ""), ("f2", "added", "", "新"), ("f2", "retyped", "标题", "标题"), ("f3", "renamed", "点 赞量", "点赞量"), ("f4", "retyped", "点赞量", "点赞量")}


def test_level_types_and_gaps(spark):
    rows = [("f1", '{"标题": "x"}'), ("f1", '{"标题": 1}'), ("f2", '{"标题": 1}'), ("f3", '{"正文": "b"}'), ("f4", '{"标题": "x"}')]
    r, f = frames(spark, rows, ["f1", "f2", "f3", "f4"])
    got = {tuple(x) for x in drift.schema_changes(r, f, NAMES).collect()}
    assert got == {("f3", "removed", "标题", ""), ("f3", "added", "", "正文"), ("f4", "added", "", "标题"), ("f4", "removed", "正文", "")}


def test_empty(spark):
    r, f = frames(spark, [("f1", "{}")], ["f1"])
    assert drift.schema_changes(r.limit(0), f, NAMES).count() == 0
    assert drift.schema_changes(r, f.limit(0), NAMES).count() == 0


def test_one_table(spark):
    r = spark.createDataFrame([("a", "f", 1, '{"标题": "-", "点赞数": "1.4万", "x": 2}'), ("b", "f", 2, '{"点赞量": 16272, "标题 ": "t"}'), ("c", "f", 3, None)], "id string, source_file string, row_no int, data string")
    got = {x.id: (x.title, x.likes, x.extra) for x in drift.conformed(r, NAMES).collect()}
    assert got == {"a": (None, 14000, {"x": "2"}), "b": ("t", 16272, {}), "c": (None, None, {})}


def test_counts(spark):
    df = spark.createDataFrame([("16,272",), ("10万+",), ("3.2k",), ("1.5亿",), ("--",), (None,), ("",)], "t string")
    assert [r.n for r in df.select(drift.count_value(F.col("t")).alias("n")).collect()] == [16272, 100000, 3200, 150000000, None, None, None]


def test_casts_come_from_the_alias_table(spark):
    import pytest

    names = [("点赞", "likes"), ("赞", "likes"), ("题", "title"), ("原创", "own")]
    assert drift.cast_rules(names, {"likes": "count", "own": "flag", "other": "count"}) == [("likes", "count"), ("title", "text"), ("own", "flag")]
    with pytest.raises(ValueError, match="no cast for date"):
        drift.cast_rules(names, {"title": "date"})
    df = spark.createDataFrame([("a", "f", 1, '{"点赞": "1.4万", "题": 5, "原创": "是"}'), ("b", "f", 2, '{"赞": "x", "原创": "?"}'), ("c", "f", 3, None)], "id string, source_file string, row_no int, data string")
    got = {r.id: (r.likes, r.title, r.own) for r in drift.conformed(df, names, {"likes": "count", "own": "flag"}).collect()}
    assert got == {"a": (14_000, "5", True), "b": (None, None, None), "c": (None, None, None)}
