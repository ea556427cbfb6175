"""Moments in many notations to one instant of UTC.

One alternation of all notations (named groups, compiled once) takes a value apart in a single match. Calendar
ranges are validated and instants assembled for a whole Arrow batch with integer day arithmetic in numpy; the zone
of the file is applied through tables of the zone's offset changes.
"""

from __future__ import annotations

import functools
import math
import unicodedata
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.fields import FieldPicker
from millrace.plans.lineage import fits_broadcast

DEFAULT_ZONE = "Asia/Shanghai"
#: Manifests up to this many rows are broadcast to the rows; beyond it the join shuffles both sides by file.
BROADCAST_FILES = 100_000

# Names of months, of day parts and of zones with one meaning (offset in minutes).
MONTHS = {name: k + 1 for k, name in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())}
ZONE_NAMES = {"z": 0, "utc": 0, "gmt": 0, "est": -300, "edt": -240, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "cet": 60, "cest": 120, "jst": 540, "kst": 540, "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780, "hkt": 480, "msk": 180}
FORENOON = ("am", "a.m.", "上午", "早上", "凌晨", "清晨", "早晨", "午前")
AFTERNOON = ("pm", "p.m.", "下午", "晚上", "傍晚", "夜里", "夜间", "午后", "中午", "午後")

_MONTH = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\.?"
_DAY_NAME = r"(?:(?:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\.?,?\s+)?"
_HALF = "(?:" + "|".join(map(regex.escape, (*FORENOON, *AFTERNOON))) + ")"
_CLOCK = rf"(?P<ap>{_HALF})?\s*(?P<h>\d{{1,2}}):(?P<mi>\d{{1,2}})(?::(?P<s>\d{{1,2}})(?:[.,](?P<f>\d+))?)?\s*(?P<ap>{_HALF})?"
_OFFSET = r"(?:\s*(?P<z>(?:utc|gmt)?\s*(?P<zs>[+-])(?P<zh>\d{1,2})(?::?(?P<zm>\d{2}))?|" + "|".join(sorted(ZONE_NAMES, key=len, reverse=True)) + r"))?(?:\s*\[(?P<zn>[a-z_]+(?:/[a-z_+-]+)*)\])?"
NOTATIONS = regex.compile(
    "|".join(
        (
            # 2024-06-22 15:40:07.25+0800, 2024/7/3 16:11, 2024.06.20, 2024-06-27T01:55:31+08:00[Asia/Shanghai]
            rf"(?P<y>\d{{4}})(?P<p>[-/.])(?P<mo>\d{{1,2}})(?P=p)(?P<d>\d{{1,2}})(?:(?:\s*t\s*|\s+){_CLOCK}{_OFFSET})?",
            # 20240710T132502Z, 20251115153549, 20240710
            r"(?P<y>(?:19|20)\d{2})(?P<mo>\d{2})(?P<d>\d{2})(?:[t\s]?(?P<h>\d{2})(?P<mi>\d{2})(?P<s>\d{2})?(?:[.,](?P<f>\d+))?" + _OFFSET + ")?",
            # 2024年8月14日 星期三 晚上6点23分, 北京时间2024年6月27日20时56分, 2024年05月18日 09时10分27秒
            rf"(?P<cn>北京时间)?\s*(?P<y>\d{{4}})年(?P<mo>\d{{1,2}})月(?P<d>\d{{1,2}})[日号]\s*[(（]?(?:(?:星期|周|礼拜)[一二三四五六日天])?[)）]?\s*(?:(?P<ap>{_HALF})?\s*(?P<h>\d{{1,2}})[:时点時](?:(?P<mi>\d{{1,2}})分?)?(?::?(?P<s>\d{{1,2}})(?:\.(?P<f>\d+))?秒?)?{_OFFSET})?",
            # Wed, 26 Jun 2024 22:09:32 +0100, 23-Jun-2024 13:23:59
            rf"{_DAY_NAME}(?P<d>\d{{1,2}})(?:st|nd|rd|th)?[-\s]+(?P<mn>{_MONTH})[-,\s]+(?P<y>\d{{4}})(?:,?\s+{_CLOCK}{_OFFSET})?",
            # Jul 5, 2024 11:44:03 PM EDT
            rf"{_DAY_NAME}(?P<mn>{_MONTH})\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}})(?:,?\s+(?:at\s+)?{_CLOCK}{_OFFSET})?",
            # 3/10/2024 3:22 AM, 29.03.2024: which of the two is the month says the locale of the file
            rf"(?P<a>\d{{1,2}})(?P<p>[/.-])(?P<b>\d{{1,2}})(?P=p)(?P<y>\d{{4}})(?:,?\s+{_CLOCK}{_OFFSET})?",
            # 8小时前, 51分钟前, 3 days ago
            r"(?P<ago>\d{1,6})\s*(?:(?P<u>秒|分钟|分|小时|个小时|天|日)(?:钟)?前|(?P<u>sec(?:ond)?s?|min(?:ute)?s?|hours?|hrs?|days?)\s+ago)",
            # 昨天 08:11, yesterday at 8:11
            rf"(?P<rel>今天|昨天|前天|大前天|today|yesterday)\s*(?:at\s+)?(?:{_CLOCK})?",
            # 1719310297, 1718913663203, 45539.7806863426
            r"(?P<n>\d{1,19})(?P<nf>\.\d+)?(?:e\+?(?P<ne>\d{1,2}))?",
        )
    ),
    regex.I,
)
_UNITS = {"秒": 1, "sec": 1, "分": 60, "min": 60, "小": 3600, "个": 3600, "hou": 3600, "hrs": 3600, "hr": 3600, "天": 86400, "日": 86400, "day": 86400}
_DAYS_BACK = {"今天": 0, "today": 0, "昨天": 1, "yesterday": 1, "前天": 2, "大前天": 3}


def days_from_civil(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970-01-01 of proleptic Gregorian dates, in integers (years counted from March)."""
    y = y - (m <= 2)
    era = y // 400
    of_era = y - era * 400
    of_year = (153 * (m + np.where(m > 2, -3, 9)) + 2) // 5 + d - 1
    return era * 146097 + of_era * 365 + of_era // 4 - of_era // 100 + of_year - 719468


def month_length(y: np.ndarray, m: np.ndarray) -> np.ndarray:
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    return np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[np.clip(m, 0, 12)] + ((m == 2) & leap)


@functools.lru_cache(maxsize=700)
def offset_changes(zone: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(starts, offsets): from starts[k] (UTC second) on, local time is UTC + offsets[k]. None for an unknown zone."""
    try:
        info = ZoneInfo(zone)
    except Exception:
        return None

    def offset(t: int) -> int:
        return int((datetime(1970, 1, 1, tzinfo=UTC) + timedelta(seconds=t)).astimezone(info).utcoffset().total_seconds())

    starts, offsets, step = [-(1 << 62)], [offset(-5_000_000_000)], 21 * 86400
    for a in range(-5_000_000_000, 5_000_000_000, step):
        if offset(a + step) != offsets[-1] or offset(a + step // 2) != offsets[-1]:
            for low, high in ((a, a + step // 2), (a + step // 2, a + step)):
                if offset(high) != offsets[-1]:
                    while high - low > 1:
                        middle = (low + high) // 2
                        low, high = (middle, high) if offset(middle) == offsets[-1] else (low, middle)
                    starts.append(high)
                    offsets.append(offset(high))
    return np.array(starts), np.array(offsets)


def local_to_utc(local: np.ndarray, zone: str) -> tuple[np.ndarray, np.ndarray]:
    """(utc seconds, ok): ok is False where the wall time never occurs in the zone, or occurs twice."""
    changes = offset_changes(zone)
    if changes is None:
        return local, np.zeros(len(local), bool)
    starts, offsets = changes
    hits, utc = np.zeros(len(local), np.int64), np.zeros(len(local), np.int64)
    for k in {-1, 0, 1}:  # the offsets that hold about this time
        at = np.clip(np.searchsorted(starts, local, side="right") - 1 + k, 0, len(starts) - 1)
        t = local - offsets[at]
        end = np.where(at + 1 < len(starts), starts[np.minimum(at + 1, len(starts) - 1)], 1 << 62)
        fits = (t >= starts[at]) & (t < end) & ((k == 0) | (at != np.clip(np.searchsorted(starts, local, side="right") - 1, 0, len(starts) - 1)))
        hits += fits
        utc = np.where(fits, t, utc)
    return utc, hits == 1


def _number(digits: str, fraction: str | None, power: str | None) -> tuple[str, int] | None:
    """('utc', second) of epoch numbers by their length, ('local', second) of a spreadsheet's day number."""
    if power:
        whole = float(f"{digits}{fraction or ''}e{power}")
        digits, fraction = str(int(whole)), None
    n = len(digits)
    if n >= 9:
        unit = {9: 1, 10: 1, 11: 1, 13: 1000, 16: 10**6, 19: 10**9}.get(n)
        return ("utc", int(digits) // unit) if unit and digits[0] != "0" else None
    if n == 5 or (n == 4 and fraction):
        part = round(float(fraction or 0) * 86400, 4)
        return "local", (int(digits) - 25569) * 86400 + math.floor(part)
    return None


def parse_batch(values: list, zones: list, locales: list, exported: list) -> list[int | None]:
    """UTC seconds of one batch; None where a value denotes no instant, or more than one.

    ``exported`` are UTC microseconds, or None. Null values, blank and unreadable texts, impossible dates,
    relative values of a file without export time, and wall times that occur twice or never give None.
    """
    n = len(values)
    out: list[int | None] = [None] * n
    parts: dict[str, list[int]] = {k: [] for k in ("i", "y", "mo", "d", "h", "mi", "s", "off")}
    walls: dict[str, tuple[list[int], list[int]]] = {}

    def wall(i: int, second: int, zone: str | None) -> None:
        at, seconds = walls.setdefault(zone or DEFAULT_ZONE, ([], []))
        at.append(i)
        seconds.append(second)

    own: dict[int, str] = {}
    for i, value in enumerate(values):
        if not isinstance(value, str):
            continue
        text = unicodedata.normalize("NFKC", value).strip()
        m = NOTATIONS.fullmatch(text)
        if m is None:
            continue
        g = m.groupdict()
        if g["n"]:
            got = _number(g["n"], g["nf"], g["ne"])
            if got and got[0] == "utc":
                out[i] = got[1]
            elif got:
                wall(i, got[1], zones[i])
            continue
        h, mi, s = int(g["h"] or 0), int(g["mi"] or 0), int(g["s"] or 0)
        if g["ap"]:
            half = g["ap"].lower()
            english = half[0] in "ap"
            if english and not 1 <= h <= 12:
                continue
            if half in AFTERNOON:
                h += 12 * (h < 12 and not (half == "中午" and h >= 10))
            elif h == 12 and half not in ("上午",):
                h = 0
        if g["ago"] or g["rel"]:
            if exported[i] is None:
                continue
            now = exported[i] // 1_000_000
            if g["ago"]:
                unit = next(v for k, v in _UNITS.items() if g["u"].lower().startswith(k))
                if unit < 86400:
                    out[i] = now - int(g["ago"]) * unit
                    continue
                back = int(g["ago"])
            else:
                back = _DAYS_BACK[g["rel"].lower()]
            changes = offset_changes(zones[i] or DEFAULT_ZONE)
            if changes is None or h > 23 or mi > 59 or s > 59:
                continue
            here = now + int(changes[1][np.searchsorted(changes[0], now, side="right") - 1])
            wall(i, (here // 86400 - back) * 86400 + h * 3600 + mi * 60 + s, zones[i])
            continue
        if g["a"]:
            a, b = int(g["a"]), int(g["b"])
            mo, d = (a, b) if (locales[i] or "").endswith("-US") else (b, a)
        else:
            mo, d = MONTHS[g["mn"][:3].lower()] if g["mn"] else int(g["mo"]), int(g["d"])
        off = 1 << 30
        if g["zs"]:
            zh, zm = int(g["zh"]), int(g["zm"] or 0)
            if zh > 15 or zm > 59:
                continue
            off = (zh * 60 + zm) * (-1 if g["zs"] == "-" else 1)
        elif g["z"]:
            off = ZONE_NAMES[g["z"].lower()]
        elif g["cn"]:
            own[i] = DEFAULT_ZONE
        elif g["zn"]:
            own[i] = text[m.start("zn") : m.end("zn")]
        for k, v in zip(parts, (i, int(g["y"]), mo, d, h, mi, s, off), strict=True):
            parts[k].append(v)
    if parts["i"]:
        i, y, mo, d, h, mi, s, off = (np.array(parts[k], np.int64) for k in parts)
        ok = (y >= 1) & (mo >= 1) & (mo <= 12) & (d >= 1) & (d <= month_length(y, mo)) & (h < 24) & (mi < 60) & (s < 60)
        local = days_from_civil(y, mo, d) * 86400 + h * 3600 + mi * 60 + s
        for k in np.flatnonzero(ok):
            at = int(i[k])
            if off[k] != 1 << 30:
                out[at] = int(local[k] - off[k] * 60)
            else:
                wall(at, int(local[k]), own.get(at, zones[at]))
    for zone, (at, seconds) in walls.items():
        utc, ok = local_to_utc(np.array(seconds, np.int64), zone)
        for k in np.flatnonzero(ok):
            out[at[k]] = int(utc[k])
    return out


def raw_field(df: DataFrame, names: list[tuple[str, str]], field: str, keep: list[str], data: str = "data", as_name: str = "value") -> DataFrame:
    """``keep`` columns and the field's raw value as text, taken out of the JSON objects in column ``data``.

    Numbers come out as Python writes them, booleans and nested values as null.
    """
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), f"`{as_name}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picker = FieldPicker(names, field)
        for batch in batches:
            got = []
            for text in batch.column(0).to_pylist():
                v = picker.pick(text)
                got.append(v if isinstance(v, str) else None if v is None or isinstance(v, (bool, dict, list)) else repr(v))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(got, pa.string())], names=[*keep, as_name])

    return df.select(data, *keep).mapInArrow(run, schema)


def to_instants(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``utc_sec`` of a frame with columns value, zone, locale, exported_us; null where there is no instant."""
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "utc_sec bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = parse_batch(*(batch.column(k).to_pylist() for k in range(4)))
            yield pa.RecordBatch.from_arrays([*batch.columns[4:], pa.array(got, pa.int64())], names=[*keep, "utc_sec"])

    return df.select("value", "zone", "locale", "exported_us", *keep).mapInArrow(run, schema)


def utc_micros(c: str) -> Column:
    """Microseconds of a zone-less timestamp read as UTC, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({c} AS TIMESTAMP_NTZ))")


def published_instants(records: DataFrame, sources: DataFrame, files: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """(tab, id, value, utc_sec) for every row of both tables; utc_sec is null where the time is no single instant.

    ``files`` gives zone, locale and export time by source_file; rows of an unknown file are read in the default zone,
    and their relative values have no instant. Rows go to the join with the value alone, never with their texts.
    """
    one = raw_field(records, names, "published", ["id", "source_file"]).select(F.lit("records").alias("tab"), "id", "source_file", "value")
    two = sources.select(F.lit("normalized_sources").alias("tab"), "id", "source_file", F.col("published").alias("value"))
    manifest = files.select("source_file", F.col("export_zone").alias("zone"), F.col("export_locale").alias("locale"), utc_micros("exported_at").alias("exported_us")).dropDuplicates(["source_file"])
    if fits_broadcast(files, BROADCAST_FILES):
        manifest = F.broadcast(manifest)
    return to_instants(one.unionByName(two).join(manifest, "source_file", "left"), ["tab", "id", "value"])
