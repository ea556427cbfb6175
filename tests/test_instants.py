from datetime import UTC, datetime

import pytest

from millrace.operators import instants
from millrace.operators.instants import parse_batch

EXPORTED = int(datetime(2024, 7, 1, 3, 0, 30, 500000, tzinfo=UTC).timestamp() * 1_000_000)


def at(value, zone="Asia/Shanghai", locale="zh-CN", exported=EXPORTED):
    got = parse_batch([value], [zone], [locale], [exported])[0]
    return got if got is None else datetime.fromtimestamp(got, UTC).strftime("%Y-%m-%d %H:%M:%S")


@pytest.mark.parametrize(
    "value, zone, locale, want",
    [
        ("2024-06-22 15:40:07", None, None, "2024-06-22 07:40:07"),
        ("2024/6/3 6:02", "Europe/London", "en-GB", "2024-06-03 05:02:00"),
        ("2024-06-22", "Asia/Tokyo", "ja-JP", "2024-06-21 15:00:00"),
        ("2024-06-23T11:59:40.999Z", None, None, "2024-06-23 11:59:40"),
        ("2024-06-27T01:55:31+08:00[Asia/Shanghai]", "Europe/London", "en-GB", "2024-06-26 17:55:31"),
        ("20240710T132502Z", None, None, "2024-07-10 13:25:02"),
        ("20251115153549", "Asia/Shanghai", "zh-CN", "2025-11-15 07:35:49"),
        ("２０２４－０６－１９　０５：０２：４８", None, None, "2024-06-18 21:02:48"),
        ("2024年8月14日 星期三 晚上6点23分", None, None, "2024-08-14 10:23:00"),
        ("2024年7月13日 星期六 中午12点42分", None, None, "2024-07-13 04:42:00"),
        ("2024年6月20日 凌晨12点41分", None, None, "2024-06-19 16:41:00"),
        ("北京时间2024年6月27日20时56分", "America/New_York", "en-US", "2024-06-27 12:56:00"),
        ("Wed, 26 Jun 2024 22:09:32 +0100", None, None, "2024-06-26 21:09:32"),
        ("Jul 5, 2024 11:44:03 PM EDT", None, None, "2024-07-06 03:44:03"),
        ("2024/08/13 12:28:31 UTC+5:30", None, None, "2024-08-13 06:58:31"),
        ("23-Jun-2024 13:23:59", "Asia/Kolkata", "en-IN", "2024-06-23 07:53:59"),
        ("3/10/2024 3:22 AM", "Asia/Shanghai", "en-US", "2024-03-09 19:22:00"),
        ("3/10/2024 13:22", "Asia/Shanghai", "en-GB", "2024-10-03 05:22:00"),
        ("1719310297", None, None, "2024-06-25 10:11:37"),
        ("1718913663203", None, None, "2024-06-20 20:01:03"),
        ("1756831556709788", None, None, "2025-09-02 16:45:56"),
        ("45539.5", "Asia/Shanghai", "zh-CN", "2024-09-04 04:00:00"),
        ("8小时前", None, None, "2024-06-30 19:00:30"),
        ("昨天 08:11", "America/New_York", "en-US", "2024-06-29 12:11:00"),
    ],
)
def test_one_instant(value, zone, locale, want):
    assert at(value, zone, locale) == want


@pytest.mark.parametrize("value", [None, "", "  ", "-", "未知", "刚刚", "发布于首播当晚", "2025-02-30 10:15:00", "2025/11/31 09:10", "2024-06-22 24:01:00", "29/02/2023", "13点", "0", "123", "9" * 40, "2024-06-22 15:40:07" * 3])
def test_no_instant(value):
    assert at(value) is None


def test_wall_times_twice_or_never():
    assert at("2025-03-09 02:51:10", "America/New_York") is None
    assert at("2024-10-27 01:00:26", "Europe/London") is None
    assert at("2025-03-09 03:00:00", "America/New_York") == "2025-03-09 07:00:00"
    assert at("2025-03-09 01:59:59", "America/New_York") == "2025-03-09 06:59:59"


def test_relative_needs_the_export_time():
    assert at("昨天 08:11", exported=None) is None


def test_every_hour_agrees_with_zoneinfo():
    from zoneinfo import ZoneInfo

    import numpy as np

    for zone in ("Europe/London", "America/New_York", "Australia/Sydney", "Asia/Kolkata"):
        local = np.arange(1_700_000_000, 1_735_000_000, 1800)
        utc, ok = instants.local_to_utc(local, zone)
        info = ZoneInfo(zone)
        for t, u, o in list(zip(local, utc, ok, strict=True))[::7]:
            wall = datetime.fromtimestamp(int(t), UTC).replace(tzinfo=None)
            both = {wall.replace(tzinfo=info, fold=f).timestamp() for f in (0, 1)}
            there = {b for b in both if datetime.fromtimestamp(b, info).replace(tzinfo=None) == wall}
            assert o == (len(there) == 1)
            if o:
                assert u in there


def test_tables_with_nulls_and_more_columns(spark):
    records = spark.createDataFrame([("a", "f", '{"发 表时间": "2024-06-22 15:40:07"}', 1), ("b", None, None, 1), ("c", "x", "[1]", 1), ("d", "f", '{"published": null, "发布时间": 1719310297}', 1)], "id string, source_file string, data string, zone int")
    sources = spark.createDataFrame([("e", "f", None), ("f", "f", "昨天 08:11")], "id string, source_file string, published string")
    files = spark.createDataFrame([("f", None, "zh-CN", datetime(2024, 7, 1))], "source_file string, export_zone string, export_locale string, exported_at timestamp")
    names = [("发表时间", "published"), ("发布时间", "published")]
    rows = {r.id: r.utc_sec for r in instants.published_instants(records, sources, files, names).collect()}
    assert rows == {"a": 1719042007, "b": None, "c": None, "d": 1719310297, "e": None, "f": 1719706260}
    empty = instants.published_instants(records.limit(0), sources.limit(0), files.limit(0), names)
    assert empty.count() == 0


def test_instants_where_the_manifest_is_joined_by_a_shuffle(spark, data, monkeypatch):
    from millrace import catalog
    from millrace.operators import instants

    few = {tuple(r) for r in catalog.QUERIES["p2_instants"](spark, data).collect()}
    monkeypatch.setattr(instants, "BROADCAST_FILES", 0)
    assert {tuple(r) for r in catalog.QUERIES["p2_instants"](spark, data).collect()} == few
