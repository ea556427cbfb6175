"""One form for texts that look alike and differ in their characters.

Arrow text becomes one numpy array of code points; a lookup table of replacements and expansions takes off width forms,
invisible characters, kinds of blanks, compatibility ideographs and letters of another script with the same shape, and
takes composed letters apart; marks are put in canonical order and composed again, all on whole arrays.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.codepoints import from_code_points, slices, to_code_points
from millrace.plans.lineage import written

# Letters of other scripts, and the letter of the same shape that stands for each. What a reader can tell apart
# isn't here: ω and w, η and n, mathematical letters.
LOOK_ALIKE = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ѵ": "v", "ɡ": "g", "ү": "y", "к": "k", "ԍ": "g", "ո": "n",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ү": "Y", "Ӏ": "I", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Һ": "h", "З": "3",
    # Greek
    "ο": "o", "ν": "v", "ρ": "p", "κ": "k", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    # Armenian and Latin letters from other alphabets
    "օ": "o", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "յ": "j", "Օ": "O", "Ս": "U", "Տ": "S", "Լ": "L", "ɑ": "a", "ı": "i", "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m", "ⅰ": "i", "ⅴ": "v", "ⅹ": "x", "Ⅰ": "I", "Ⅴ": "V", "Ⅹ": "X", "Ⅼ": "L", "Ⅽ": "C", "Ⅾ": "D", "Ⅿ": "M",
    # Latin small capitals that are as their small letters, or as Cyrillic ones
    "ᴄ": "c", "ᴏ": "o", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s", "ʙ": "в", "ᴍ": "м", "ʜ": "н", "ᴛ": "т",
    # Coptic and Deseret
    "ⲟ": "o", "ⲣ": "p", "ⲥ": "c", "Ⲃ": "B", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "Ⲣ": "P", "Ⲥ": "C", "Ⲧ": "T", "Ⲭ": "X", "𐐄": "O", "𐐬": "o", "𐐕": "C", "𐐽": "c",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮤ": "W", "Ꮓ": "Z",
    # kana, bopomofo and ideographs
    "ロ": "口", "エ": "工", "カ": "力", "タ": "夕", "ニ": "二", "ハ": "八", "ト": "卜", "チ": "千", "オ": "才", "ミ": "三", "ヘ": "へ", "ベ": "べ", "ペ": "ぺ", "リ": "り", "ㄧ": "一", "ー": "一", "〸": "十", "〇": "○", "囗": "口",
    # hyphens and dots
    "‐": "-", "‑": "-", "․": ".",
}
#: Radicals of the CJK supplement that have no decomposition, and their ideographs.
RADICALS = dict(zip("⺠⺟⻁⻄⻅⻆⻉⻋⻓⻔⻘⻙⻚⻛⻜⻝⻢⻤⻥⻦⻨⻩⻬⻰⺝⺩⺫⻊⻌⻏⺼⺢⺮", "民母虎西见角贝车长门青韦页风飞食马鬼鱼鸟麦黄齐龙月王罒足辶阝月水竹", strict=True))
#: Characters without ink that are not format characters (category Cf).
INKLESS = [0x034F, 0x115F, 0x1160, 0x3164, 0xFFA0, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]
_POINTS = 0x110000
_DELETE, _EXPAND = 0xFFFFFFFF, 0x80000000


def _whole(c: int, seen: dict[int, tuple[int, ...]]) -> tuple[int, ...]:
    """Full decomposition: canonical, of width forms, and of radicals to their ideographs."""
    if c in seen:
        return seen[c]
    d = unicodedata.decomposition(chr(c))
    got = (c,)
    if d:
        tag, parts = (d.split(" ", 1)[0], d.split(" ", 1)[1]) if d[0] == "<" else ("", d)
        if tag in ("", "<wide>", "<narrow>", "<small>", "<noBreak>") or (tag == "<compat>" and 0x2E80 <= c <= 0x2FDF):
            got = tuple(p for x in parts.split() for p in _whole(int(x, 16), seen))
    elif 0xAC00 <= c < 0xAC00 + 11172:
        s = c - 0xAC00
        got = (0x1100 + s // 588, 0x1161 + s % 588 // 28, *((0x11A7 + s % 28,) if s % 28 else ()))
    seen[c] = got
    return got


@functools.lru_cache(maxsize=2)
def tables(look_alike: bool = True) -> tuple[np.ndarray, ...]:
    """(map, pool, pool starts, combining classes, composition keys, composites), built from the Unicode database by rule."""
    to = np.arange(_POINTS, dtype=np.uint32)
    ccc = np.zeros(_POINTS, np.uint8)
    pool: list[int] = []
    starts = [0]
    seen: dict[int, tuple[int, ...]] = {}
    same = {ord(a): ord(b) for a, b in LOOK_ALIKE.items()} if look_alike else {}
    same |= {ord(a): ord(b) for a, b in RADICALS.items()}
    inkless = set(INKLESS)
    for c in (*range(0x30000), *range(0xE0000, 0xE0200)):
        kind = unicodedata.category(chr(c))
        if kind in ("Cn", "Co", "Cs") and c not in inkless:
            continue
        ccc[c] = unicodedata.combining(chr(c))
        if kind == "Cf" or c in inkless or (kind == "Cc" and c not in (9, 10, 0x85)):
            to[c] = _DELETE
        elif kind == "Zs" or c == 9:
            to[c] = 0x20
        elif kind in ("Zl", "Zp") or c == 0x85:
            to[c] = 10
        else:
            got = tuple(same.get(p, p) for p in _whole(c, seen))
            if len(got) == 1:
                to[c] = got[0]
            else:
                to[c] = _EXPAND | (len(starts) - 1)
                pool.extend(got)
                starts.append(len(pool))
    pairs: dict[int, int] = {}
    for c in range(0x30000):
        d = unicodedata.decomposition(chr(c))
        if d and d[0] != "<" and " " in d:
            a, b = (int(x, 16) for x in d.split())
            if unicodedata.normalize("NFC", chr(a) + chr(b)) == chr(c):
                pairs[a << 21 | b] = c
    for s in range(11172):
        if s % 28 == 0:
            pairs[(0x1100 + s // 588) << 21 | (0x1161 + s % 588 // 28)] = 0xAC00 + s
        else:
            pairs[(0xAC00 + s - s % 28) << 21 | (0x11A7 + s % 28)] = 0xAC00 + s
    keys = np.array(sorted(pairs), np.int64)
    return to, np.array(pool, np.uint32), np.array(starts, np.int64), ccc, keys, np.array([pairs[int(k)] for k in keys], np.uint32)


def _compose(points: np.ndarray, row: np.ndarray, ccc: np.ndarray, keys: np.ndarray, composites: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks in canonical order, then composed with the letter before them; ``row`` is the text of each code point."""
    while True:
        c = ccc[points]
        marks = c > 0
        if not marks.any() and not ((points >= 0x1161) & (points <= 0x11C2)).any():
            break
        # canonical order within each run of marks
        group = np.cumsum(~marks)
        change = np.flatnonzero((c[1:] < c[:-1]) & marks[1:] & (row[1:] == row[:-1]))
        if len(change):
            bad = np.isin(group, group[change + 1])
            at = np.flatnonzero(bad)
            points = points.copy()
            points[at] = points[at[np.lexsort((c[at], row[at], group[at]))]]
            c = ccc[points]
        i = np.arange(len(points))
        starter = np.maximum.accumulate(np.where(~marks, i, -1))
        before = np.concatenate([[-1], starter[:-1]])
        ok = (i > 0) & (before >= 0)
        ok &= row[np.maximum(before, 0)] == row
        previous = np.maximum(i - 1, 0)
        ok &= np.where(marks, (before == i - 1) | (c[previous] < c), before == i - 1)
        if not ok.any():
            break
        cand = np.flatnonzero(ok)
        key = points[before[cand]].astype(np.int64) << 21 | points[cand]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[at] == key
        cand, at = cand[hit], at[hit]
        if not len(cand):
            break
        _, first = np.unique(before[cand], return_index=True)  # of each letter the first mark that composes
        cand, at = cand[first], at[first]
        free = np.concatenate([[True], before[cand][1:] != cand[:-1]])  # a letter taken in this round composes in the next
        cand, at = cand[free], at[free]
        points = points.copy()
        points[before[cand]] = composites[at]
        keep = np.ones(len(points), bool)
        keep[cand] = False
        points, row = points[keep], row[keep]
    return points, row


def one_form(points: np.ndarray, starts: np.ndarray, look_alike: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(code points, starts) of the texts in their one form."""
    to, pool, pool_starts, ccc, keys, composites = tables(look_alike)
    n = len(starts) - 1
    row = np.repeat(np.arange(n), np.diff(starts))
    got = to[points]
    wide = got >= _EXPAND
    size = np.ones(len(got), np.int64)
    if wide.any():
        gone = got == _DELETE
        more = wide & ~gone
        which = (got[more] & 0x7FFFFFFF).astype(np.int64)
        size[gone] = 0
        size[more] = pool_starts[which + 1] - pool_starts[which]
        out = np.repeat(got, size)
        row = np.repeat(row, size)
        ends = np.cumsum(size)
        begin = (ends - size)[more]
        spread = np.repeat(begin, size[more]) + np.arange(int(size[more].sum())) - np.repeat(np.cumsum(size[more]) - size[more], size[more])
        out[spread] = pool[np.repeat(pool_starts[which], size[more]) + spread - np.repeat(begin, size[more])]
        got = out
    got, row = _compose(got, row, ccc, keys, composites)
    return got, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int64)


def with_form(df: DataFrame, text: str, keep: list[str], look_alike: bool = True) -> DataFrame:
    """``keep`` and ``form``, the text in its one form; null stays null, empty stays empty."""
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "form string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                form = from_code_points(*one_form(*to_code_points(part.column(0)), look_alike))
                if part.column(0).null_count:
                    form = pa.compute.if_else(part.column(0).is_valid(), form, None)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], form], names=[*keep, "form"])

    return df.select(F.col(text).alias("_text"), *keep).mapInArrow(run, schema)


def digests(points: np.ndarray, starts: np.ndarray) -> pa.Array:
    """128 bits for each row: sums of two mixings of every code point with its place, all rows at once."""
    n = len(starts) - 1
    out = np.zeros((n, 2), np.uint64)
    size = np.diff(starts)
    some = np.flatnonzero(size)
    if len(some):
        place = (np.arange(len(points)) - np.repeat(starts[:-1], size)).astype(np.uint64)
        with np.errstate(over="ignore"):
            for k, (a, b, c) in enumerate(((0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB), (0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))):
                h = (place + np.uint64(1)) * np.uint64(a) ^ points.astype(np.uint64) * np.uint64(b)
                h = (h ^ (h >> np.uint64(30))) * np.uint64(b)
                h = (h ^ (h >> np.uint64(27))) * np.uint64(c)
                out[some, k] = np.add.reduceat(h ^ (h >> np.uint64(31)), starts[some])
            out[:, 1] ^= size.astype(np.uint64)
    return pa.Array.from_buffers(pa.binary(16), n, [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())


def form_keys(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep``, ``form_key`` and ``text_key``: 128-bit digests of the one form and of the text itself.

    Null texts and texts without anything visible are left out.
    """
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "form_key binary, text_key binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                points, starts = to_code_points(part.column(0))
                form, at = one_form(points, starts)
                ink = np.concatenate([[0], np.cumsum((form != 0x20) & (form != 10))])
                seen = pa.array(ink[at[1:]] > ink[at[:-1]])
                cols = [*part.columns[1:], digests(form, at), digests(points, starts)]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "form_key", "text_key"]).filter(seen)

    return df.select(F.col(text).alias("_text"), *keep).mapInArrow(run, schema)


def alike_pairs(keys: DataFrame, block_rows: int = 2_000, spread: int = 32) -> DataFrame:
    """(tab, id_a, id_b), id_a < id_b: rows of one table with one form and different texts.

    ``keys`` has tab, id, form_key, text_key, and is written once. Only rows of groups that hold different texts go on:
    these groups, few of all, are found by sums combined before the shuffle, and stand ``spread`` times in the join that
    picks their rows, so that the rows of a hot group are spread over tasks. A group of more than ``block_rows`` rows is cut
    into blocks, and each two blocks meet in a task of their own. Rows of equal text never meet as a pair.
    """
    keys = written(keys)
    groups = keys.groupBy("tab", "form_key").agg(F.min("text_key").alias("least"), F.max("text_key").alias("most"), F.count(F.lit(1)).alias("n")).where("least != most")
    groups = groups.select("tab", "form_key", (F.floor((F.col("n") - 1) / block_rows) + 1).cast("int").alias("blocks"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"))
    rows = keys.withColumn("part", F.expr(f"int(pmod(xxhash64(id, text_key), {spread}))")).join(groups, ["tab", "form_key", "part"])
    rows = written(rows.select("tab", "form_key", "id", "text_key", "blocks", F.expr("int(pmod(xxhash64(id), blocks))").alias("block")))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = rows.select("tab", "form_key", F.col("id").alias("id_a"), F.col("text_key").alias("text_a"), F.col("block").alias("i"), every.alias("j"))
    right = rows.select("tab", "form_key", F.col("id").alias("id_b"), F.col("text_key").alias("text_b"), every.alias("i"), F.col("block").alias("j"))
    return left.join(right, ["tab", "form_key", "i", "j"]).where("id_a < id_b and text_a != text_b").select("tab", "id_a", "id_b").distinct()


def alike_classes(keys: DataFrame) -> DataFrame:
    """(tab, id, class, n_links) of every row of ``keys``: the least id of the rows of its form, and with how many of them it
    looks alike and differs. Linear in the rows, whatever the size of a group."""
    keys = written(keys)
    texts = keys.groupBy("tab", "form_key", "text_key").agg(F.count(F.lit(1)).alias("same"), F.min("id").alias("_id"))
    forms = texts.groupBy("tab", "form_key").agg(F.sum("same").alias("all"), F.min("_id").alias("class"))
    each = texts.join(forms, ["tab", "form_key"]).select("tab", "form_key", "text_key", "class", (F.col("all") - F.col("same")).alias("n_links"))
    return keys.join(each, ["tab", "form_key", "text_key"]).select("tab", "id", "class", "n_links")
