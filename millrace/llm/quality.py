"""Statistics of each text, and texts that are no natural prose.

The statistics come from code points of whole batches of texts. An ordered rule list is induced by incremental reduced-error
pruning on labelled documents, which are built here from phrases in many languages and from the forms that such data
take; its thresholds go into a CASE expression that Spark applies natively.
"""

from __future__ import annotations

import functools
import random
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.codepoints import slices, to_code_points

#: Labelled documents for the rules (the bound of the training sample), and the seed that builds them.
LABELLED, SEED = 20_000, 11

# Sentence marks, signs that may follow them, and frequent words or particles by language.
MARKS = "。．.！!？?…｡।؟"
CLOSERS = "”’»」』）)\\]\"'\\s\\p{Z}\\p{So}\\p{Sk}\\u200d\\ufe0f"
COMMON_SIGNS = "的了在是我有不他她它这那个们来到就说都也把得着过为从让被很但而且与又再会能对后只时因所如果可没要去好看人一以之其"
COMMON_KANA = "のにはをがともでただてしれいなかっる"
COMMON_WORDS = {
    "en": "the of and to a in is it that was for on with as at by be this are i you he she they not but from or have has had we his her their an which were been its who what when if so about out up all there one would will can my me do did just more than then only after ever",
    "fr": "le la les de des du un une et est en que qui pour pas dans ce il elle au aux sur avec plus par je ne se sont mais nous vous son sa ses cette était a été",
    "de": "der die das und ist ein eine nicht zu den von mit dem sich auf für im es er sie als auch an war wie aber nach bei aus wird noch nur sind ich dass mich",
    "es": "el los las y es un una que en no se del por con para su al lo como más pero sus le ya fue son este esta muy sin hay está durante",
    "ru": "и в не на что я с он а как это по но из у за от так же она они мы бы был была было для к о",
    "ar": "في من على إلى أن هذا هذه كان لا ما مع عن التي الذي هو هي لم لماذا بعد كل قد",
    "hi": "है हैं के की का में से को ने और पर यह वह था थी लगे लगा मगर भी नहीं कि हो रहा गया हुआ बहुत",
}
COMMON_PIECES = "ที่ และ ได้ เป็น ของ ไป มา ใน มี ไม่ จน นี้ แล้ว ให้ กับ ตอน เรา ผู้ ถูก จาก ว่า นาน 습니다 았다 었다 니다 하는 에서 으로 은 는 이 가 을 를 의 도 지만 네요 어요 까요".split()

#: Every piece holds one of these, so that a text without them has none.
_PIECE_SIGNS = sorted({p[0] for p in COMMON_PIECES})

_CJK = ((0x3400, 0x9FFF), (0x3040, 0x30FF), (0xF900, 0xFAFF), (0x20000, 0x323AF))
#: Characters without width. Full-width forms but the marks of ideographic text, which are the usual forms there and count
#: as full-width ones only between others.
_HIDDEN = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\ufeff"
_WIDE_MARKS = "！（），．：；？"
_BULLETS = "-*•·◦▪‣①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"
_ITEM = regex.compile(rf"[ \t]*(?:[{regex.escape(_BULLETS)}]|\d{{1,3}}[.、)）])[ \t]*[^{MARKS}]{{1,40}}+[{MARKS}]*[{CLOSERS}]*", regex.V0)
_GAPS = regex.compile(r"(?:[^\s,，]+ {2,}){2,}\S+ *")
_CELLS = regex.compile(r"(?:[^,，;。]{1,24}[,;]){2,}[^,，;。]{1,24}")
_LINK = regex.compile(r"(?:https?://|www\.)[A-Za-z0-9._~/?#@!$&*+;=%:-]+|<[^<>\n]+>|#[^\s#]+#?|\]\(")
_DATA = regex.compile(r"[A-Za-z0-9+/=_]{36,}|\"[A-Za-z_]\w*\" ?: ?|\b\w{1,12}=[\w.:-]+|\[\d+\]|(?:\d[\d.,:%/-]*[\s|;]+){3,}", regex.ASCII)
_DAMAGED = regex.compile(r"[�□\xa4▯]|\p{IsHan}[?]\p{IsHan}|[\xc2-\xf4][\x80-\xbf]|锟斤|烫烫")
#: A line of at most so many characters is short. Runs of one, two or three characters that repeat: characters at least.
_SHORT_LINE, _RUN_CHARS = 26, {1: 8, 2: 16, 3: 21}

_LETTER, _NUMBER, _IDEOGRAPH, _BLANK, _SYMBOL, _MARK, _CLOSER, _COMMON_SIGN = (1 << k for k in range(8))


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(classes, what each character is read as, lower case, hashes of frequent words), from the Unicode database by rule."""
    kind, to, lower = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        k = unicodedata.category(chr(c))
        if k[0] in "LM":
            kind[c] = _LETTER
            if k == "Lu" and len(low := chr(c).lower()) == 1:
                lower[c] = ord(low)
        elif k[0] == "N":
            kind[c] = _NUMBER
        elif k[0] == "S" and not 0x1F000 <= c <= 0x1FAFF or k in ("Co", "Cn"):
            kind[c] = _SYMBOL
        elif k[0] == "Z" or c in (9, 11, 12, 13, 0x85):
            kind[c] = _BLANK
        if k[0] == "Z" or c in (9, 11, 12, 13) or k in ("So", "Sk"):
            kind[c] |= _CLOSER
    for a, b in _CJK:
        kind[a : b + 1] = kind[a : b + 1] & ~np.uint8(_SYMBOL) | _IDEOGRAPH
    for signs, bit in (("#&*/\\@_|<>={}[]^~`%+", _SYMBOL), (MARKS, _MARK), ("”’»」』）)]\"'\u200d\ufe0f", _CLOSER), (COMMON_SIGNS + COMMON_KANA, _COMMON_SIGN)):
        kind[[ord(c) for c in signs]] |= bit
    to[[0x2028, 0x2029, 0x85]] = 10
    for c in range(0xFF01, 0xFF5F):
        to[c] = c - 0xFEE0
    to[[ord(c) for c in _WIDE_MARKS]] = [ord(c) for c in _WIDE_MARKS]
    words = sorted({w for v in COMMON_WORDS.values() for w in v.split()})
    p = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(w) for w in words])
    return kind, to, lower, np.sort(_run_hashes(p, ends - [len(w) for w in words], ends))


def _run_hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of points[start:end]: sums over powers of an odd number, set back to the first power by its inverse."""
    with np.errstate(over="ignore"):
        odd, inverse = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        power = lambda x: np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(points), x, np.uint64))])
        sums = np.concatenate([[np.uint64(0)], np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power(odd)[:-1])])
        h = (sums[end] - sums[start]) * power(inverse)[start]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + (end - start).astype(np.uint64)
    return h ^ (h >> np.uint64(29))


def _plain(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, row of each) with line ends of any kind as \n, full-width forms as the usual ones, and without
    characters without width."""
    _, to, _, _ = _tables()
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    gone = np.isin(points, [ord(c) for c in _HIDDEN]) if (points == 0xAD).any() or (points >= 0x200B).any() else np.zeros(len(points), bool)
    if (cr := points == 13).any():
        after = np.append((points[1:] == 10) & (row[1:] == row[:-1]), False)
        gone |= cr & after
        points = np.where(cr, np.uint32(10), points)
    if gone.any():
        points, row = points[~gone], row[~gone]
    out = to[points]
    wide = (points >= 0xFF01) & (points <= 0xFF5E)
    if wide.any():
        other = wide & (out != points)
        between = wide & ~other
        between[1:] &= other[:-1] & (row[1:] == row[:-1])
        between[:-1] &= other[1:] & (row[1:] == row[:-1])
        between[[0, -1]] = False
        out = np.where(between, points - 0xFEE0, out)
    return out, row


#: Columns besides those of counts are shares of the text's characters, null for an empty text.
COUNTS = ("n_chars", "n_words", "n_lines")
SHARES = ("mean_word_length", "symbol_ratio", "digit_ratio", "ended_lines", "ended_share", "common_words", "table_share", "item_share", "open_items", "short_share", "open_short", "link_share", "data_share", "run_share", "damaged_share", "odd_share")
FEATURES = ("odd_share", *SHARES[:-1])


def measured(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of all texts of a column at once, as float arrays; NaN where there is none (null is read as '').

    One array of code points holds all texts; classes, runs of letters and lines are counted by row. Only lines and texts
    with signs that begin a pattern are looked at one by one. Shares are of the whole text, whatever its lines end in;
    ``open_items`` and ``open_short`` are of lines that don't end in a sentence mark.
    """
    kinds, _, lower, frequent = _tables()
    points, starts = to_code_points(pc.replace_substring(texts, "</s>", "\n"))
    p, row = _plain(points, starts)
    rows = len(starts) - 1
    n = np.bincount(row, minlength=rows)
    begin = np.cumsum(n) - n
    kind = kinds[p]
    per_row = lambda mask: np.bincount(row[mask], minlength=rows)
    head = np.ones(len(p), bool)
    head[1:] = row[1:] != row[:-1]
    tail = np.append(head[1:], True) if len(p) else head

    def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = mask & (head | ~np.concatenate([[False], mask[:-1]]))
        last = mask & (tail | ~np.concatenate([mask[1:], [False]]))
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    ideograph = (kind & _IDEOGRAPH) > 0
    letter = ((kind & _LETTER) > 0) & ~ideograph
    number = (kind & _NUMBER) > 0
    in_word = letter | (number & ~ideograph)
    signs, letters, digits = per_row(ideograph), per_row(in_word), per_row(number)
    others = np.bincount(row[runs(in_word)[0]], minlength=rows)
    words = signs + others
    a, b = runs(letter)
    h = _run_hashes(lower[p], a, b)
    at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
    common = per_row((kind & _COMMON_SIGN) > 0) + np.bincount(row[a[frequent[at] == h]], minlength=rows)
    for k in np.unique(row[np.isin(p, _PIECE_POINTS)]):
        common[k] += len(_PIECES.findall(_text(p[begin[k] : begin[k] + n[k]])))

    # lines: of each its row, and whether it ends in a sentence mark and signs that may follow one
    breaks = np.flatnonzero(p == 10)
    start = np.sort(np.concatenate([begin[n > 0], breaks[breaks + 1 < len(p)][~head[breaks[breaks + 1 < len(p)] + 1]] + 1])) if len(p) else np.zeros(0, np.int64)
    of = row[start]
    end = np.concatenate([start[1:], [len(p)]]) if len(start) else start
    end = end - ((end > start) & (p[end - 1] == 10)) if len(start) else end
    size = end - start
    ink = np.concatenate([[0], np.cumsum((kind & _BLANK) == 0)])
    full = ink[end] > ink[start]
    weight = np.concatenate([[-1], np.maximum.accumulate(np.where((kind & _CLOSER) == 0, np.arange(len(p)), -1))]) if len(p) else np.array([-1])
    last = weight[end]
    ended = (size > 0) & (last >= start) & ((kind[np.maximum(last, 0)] & _MARK) > 0) if len(p) else np.zeros(0, bool)
    chars = lambda mask: np.bincount(of[mask], size[mask], minlength=rows)
    lines = np.bincount(of[full], minlength=rows)
    first_ink = np.append(np.flatnonzero((kind & _BLANK) == 0), len(p))
    lead = p[np.minimum(first_ink[np.searchsorted(first_ink, start)], max(0, len(p) - 1))] if len(p) else start
    line = lambda k: _text(p[start[k] : end[k]])

    def matching(candidates: np.ndarray, pattern: regex.Pattern) -> np.ndarray:
        out = np.zeros(len(start), bool)
        for k in np.flatnonzero(candidates):
            out[k] = pattern.fullmatch(line(k)) is not None
        return out

    item = matching(full & (np.isin(lead, [ord(c) for c in _BULLETS]) | ((kinds[lead] & _NUMBER) > 0)), _ITEM) if len(p) else full
    inside = lambda mask: (lambda c: c[end] - c[start])(np.concatenate([[0], np.cumsum(mask)]))
    bars, tabs = inside(p == 124), inside(p == 9)
    gap = np.zeros(len(p), bool)
    gap[1:] = (p[1:] == 32) & (p[:-1] == 32)
    gaps = inside(gap)
    commas = inside((p == 44) | (p == 59))
    plain = inside(np.isin(p, [ord(c) for c in "，。"])) == 0
    table = np.zeros(rows)
    by_comma = chars(matching((commas > 1) & plain & (size <= 25 * (commas + 1)), _CELLS))
    free = np.ones(rows, bool)  # of several signs that part cells, the first of these counts
    for there, share in ((per_row(p == 124) > 0, chars(bars > 1)), (per_row(p == 9) > 0, chars(tabs > 1)), (per_row(gap) > 0, chars(matching(gaps > 1, _GAPS)))):
        table = np.where(free & there, share, table)
        free &= ~there
    table = np.maximum(table, by_comma)

    def found(some: np.ndarray, pattern: regex.Pattern) -> np.ndarray:
        out = np.zeros(rows)
        for k in np.flatnonzero(some):
            out[k] = sum(m.end() - m.start() for m in pattern.finditer(_text(p[begin[k] : begin[k] + n[k]])))
        return out

    pair = lambda x, y: per_row(np.append((p[:-1] == x) & (p[1:] == y) & (row[1:] == row[:-1]), False) if len(p) else p > 0) > 0
    links = found(pair(0x2F, 0x2F) | pair(0x77, 0x77) | (per_row((p == 0x3C) | (p == 0x23)) > 0) | pair(0x5D, 0x28), _LINK)
    data = found((per_row((p == 0x3D) | (p == 0x5B)) > 0) | pair(0x22, 0x3A) | (digits * 12 > n) | (letters > 7 * others), _DATA)
    odd_signs = np.isin(p, (0xFFFD, 0x25A1, 0xA4, 0x25AF, 0x951F, 0x70EB)) | ((p >= 0x80) & (p <= 0xBF))
    odd_signs |= (p == 63) & np.concatenate([[False], ideograph[:-1]])
    damaged = found(per_row(odd_signs) > 0, _DAMAGED)
    repeats = np.zeros(len(p), bool)
    for period, least in _RUN_CHARS.items():
        same = np.zeros(len(p), bool)
        same[period:] = (p[period:] == p[:-period]) & (row[period:] == row[:-period]) & (p[period:] != 10) if len(p) > period else False
        x, y = runs(same)
        long = y - x >= least - period
        step = np.zeros(len(p) + 1, np.int64)
        np.add.at(step, x[long] - period, 1)
        np.add.at(step, y[long], -1)
        repeats |= np.cumsum(step[:-1]) > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        out = {
            "n_chars": n, "n_words": words, "n_lines": lines, "mean_word_length": (signs + letters) / words, "symbol_ratio": per_row((kind & _SYMBOL) > 0) / n, "digit_ratio": digits / n,
            "ended_lines": np.bincount(of[ended], minlength=rows) / lines, "ended_share": chars(ended) / n, "common_words": common / words, "table_share": table / n, "item_share": chars(item) / n,
            "open_items": chars(item & ~ended) / n, "short_share": chars((size > 0) & (size <= _SHORT_LINE)) / n, "open_short": chars((size > 0) & (size <= _SHORT_LINE) & ~ended) / n,
            "link_share": links / n, "data_share": data / n, "run_share": per_row(repeats) / n, "damaged_share": damaged / n,
        }
        out["odd_share"] = functools.reduce(np.fmax, (out[k] for k in ("table_share", "link_share", "data_share", "run_share", "damaged_share", "symbol_ratio", "digit_ratio")))
    return out


def _text(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


_PIECES = regex.compile("|".join(sorted(map(regex.escape, COMMON_PIECES), key=len, reverse=True)))
_PIECE_POINTS = np.array([ord(c) for c in _PIECE_SIGNS], np.uint32)


def with_statistics(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and all statistics of the text; null for a null text. Counts of an empty text are 0, shares of it null."""
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), *(f"{c} int" for c in COUNTS), *(f"{c} double" for c in SHARES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, 1 << 20):
                null = np.asarray(part.column(0).is_null())
                got = measured(part.column(0))
                counts = [pa.array(got[c], pa.int32(), mask=null) for c in COUNTS]
                shares = [pa.array(got[c], pa.float64(), mask=null | np.isnan(got[c])) for c in SHARES]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *counts, *shares], names=[*keep, *COUNTS, *SHARES])

    return df.select(F.col(text).cast("string").alias("_text"), *keep).mapInArrow(run, schema)


# ---- labelled documents -------------------------------------------------------------------------------------------

# Phrases the labelled documents are made of. {n} is a number, {w} a name.
PROSE = {
    "zh": ("昨天{w}在图书馆里等了{n}分钟，后来还是决定先走。", "这本小说的第{n}章写得很慢，但读到最后会觉得值得！", "你们有没有想过，他为什么一直不肯说出真相？", "我和同事聊了很久，大家都认为结尾处理得不错。", "从车站走到河边只要{n}分钟，路上有很多卖早点的小店。", "{w}说：“别急，等雨停了再走。”", "导演用了三年时间，把这个故事重新讲了一遍。", "如果明天天气好，我们就去山上看看那座老房子。", "上半年全市图书销量超过{n}万册。", "摄制组凌晨三点抵达片场准备开机。", "{w}负责夜景拍摄，副手负责录音。", "第{n}集平均份额升至百分之六。", "作者花费{n}天完成初稿，随后修改七遍。", "河边小店每天早晨六点开门营业！", "票价涨到{n}元。", "评分从{n}分跌到{n}分。", "片尾字幕列出{n}名群众演员。", "开拍前{w}学习骑马，减重五公斤。", "编曲配乐克制沉稳，钢琴声部尤其动人。", "第{n}集节奏明显放缓，悬念提前揭晓。", "{w}与搭档默契十足，雨夜告别场面感人至深。", "票房升至{n}.{n}亿，口碑同步上涨！", "如若删减支线剧情，全片会更加紧凑？", "摄影师连续{n}天蹲守雪山，终于拍到日出。", "同样描写码头生活，续集略显单薄。"),
    "en": ("{w} waited at the station for {n} minutes before the train arrived.", "I don't think the second half is as good as the first, but it is worth reading.", "Have you ever wondered why she never answered the letter?", "The music was too loud for a room of that size, and we left early.", "\"Leave it there,\" he said, and closed the door.", "They met at {n}:30 p.m.", "It starts at 9:15 and takes {n} minutes.", "I give it {n} out of 1000.", "It took them {n} days to repair the bridge after the flood.", "{w} plays a young postmaster, quietly and convincingly.", "Does this ensemble ever stop being hard to believe?", "Critics praise sound, lighting, pacing."),
    "fr": ("{w} a attendu {n} minutes devant la gare avant de partir.", "Le livre est long, mais la fin est très belle.", "Pourquoi ne dit-il jamais la vérité ?", "Pourquoi quitter Paris si vite ?", "Nous avons marché dans les rues de la ville pendant des heures."),
    "de": ("{w} hat {n} Minuten auf den Zug gewartet und ist dann gegangen.", "Das Buch ist nicht schlecht, aber der Schluss wirkt etwas müde.", "Warum hat sie den Brief nie gelesen?", "Wir sind mit dem Rad durch die Stadt gefahren."),
    "es": ("{w} esperó {n} minutos en la estación antes de volver a casa.", "La novela es larga, pero el final es muy bueno.", "¿Por qué no dijo la verdad desde el principio?", "Caminamos por la playa durante toda la tarde."),
    "ja": ("{w}は駅で{n}分待ってから家に帰った。", "この本は長いけれど、最後まで読む価値があると思う。", "どうして彼女は手紙に返事をしなかったのだろうか？", "雨が止んだので、私たちは海まで歩くことにした。"),
    "ko": ("{w}은 역에서 {n}분 동안 기다렸습니다.", "이 소설은 길지만 끝까지 읽을 만합니다.", "왜 그녀는 편지에 답장을 하지 않았을까요?", "점수는 {n}점이고 관객은 {n}명이었습니다.", "공사는 {n}일 걸렸다.", "비가 그쳐서 우리는 바다까지 걸어가기로 했습니다."),
    "ar": ("انتظر {w} في المحطة {n} دقيقة ثم عاد إلى البيت.", "هذا الكتاب طويل ولكن نهايته جميلة.", "لماذا لم تقل الحقيقة من البداية؟"),
    "hi": ("{w} ने स्टेशन पर {n} मिनट तक इंतज़ार किया।", "यह किताब लंबी है मगर अंत बहुत अच्छा है।", "उसने पत्र का जवाब क्यों नहीं दिया?", "काम में {n} दिन लगे।"),
    "th": ("{w}รอรถไฟอยู่ที่สถานีนาน {n} นาที", "หนังสือเล่มนี้ยาวแต่ตอนจบดีมาก", "ทำไมเธอถึงไม่ตอบจดหมายฉบับนั้น", "เราเดินไปที่ทะเลหลังจากฝนหยุดแล้ว"),
    "pl": ("{w} czekał na dworcu {n} minut, a potem wrócił do domu.", "Ta książka jest długa, ale zakończenie bardzo mi się podobało.", "Dlaczego nigdy nie odpowiedziała na list?"),
    "fi": ("{w} odotti asemalla {n} minuuttia ja lähti sitten kotiin.", "Kirja oli pitkä, mutta loppu yllätti minut.", "Miksi hän ei vastannut kirjeeseen?"),
    "vi": ("{w} đợi ở nhà ga {n} phút rồi về nhà.", "Cuốn sách này dài nhưng kết thúc rất hay.", "Tại sao cô ấy không trả lời bức thư?"),
    "tr": ("{w} istasyonda {n} dakika bekledi ve sonra eve döndü.", "Bu kitap uzun ama sonu çok güzel.", "Mektuba neden cevap vermedi?"),
    "el": ("{w} περίμενε στον σταθμό {n} λεπτά και μετά γύρισε σπίτι.", "Το βιβλίο είναι μεγάλο, αλλά το τέλος είναι πολύ ωραίο."),
    "ru": ("{w} ждал на вокзале {n} минут, а потом пошёл домой.", "Эта книга длинная, но конец очень хороший.", "Почему она не ответила на письмо?"),
}
NAMES = "李雪 王海涛 陈立 Anna Boris Clara Dupont Müller García 佐藤 김민수 Omar Priya สมชาย Иван 赵小满 周岩 Elena Tom".split()
NOUNS = "水杯 雨伞 台历 背包 键盘 地毯 花瓶 毛毯 耳塞 茶壶 镜框 靠垫 lamp cable mouse tripod backpack kettle blanket".split()
TAILS = "下载 资源 全本 完结 免费 高清 官网 价格 图片 批发 正版 最新章节 txt online free hd torrent".split()
PLACES = "东港 西岭 南浦 北原 青山 白石 Lakeview Riverton".split()
MENU = "首页 新闻 体育 登录 注册 帮助 关于我们 联系我们 返回顶部 更多>> 下载 设置 Home About Login Help Contact Menu Search".split()
ROLES = "编剧 配音 制片 护士 司机 老师 店主 邮差 船长 记者 编辑 法医 厂长 学徒 director editor nurse driver sound camera".split()
LABELS = "作者 类型 出版社 页数 语言 编辑 封面 译者 Author Genre Pages Year".split()


#: Languages of which no frequent words are listed.
UNLISTED = ("pl", "fi", "vi", "tr", "el")


def _sentence(r: random.Random, lang: str) -> str:
    return r.choice(PROSE[lang]).format(n=r.randint(2, 900), w=r.choice(NAMES))


def _prose(r: random.Random, n: int) -> str:
    lang = r.choice([*PROSE, "zh", "zh", "zh", "en"])
    s = [_sentence(r, lang) for _ in range(n)]
    if r.random() < 0.2:  # two languages in one text
        other = r.choice([k for k in PROSE if k not in UNLISTED or lang in UNLISTED])
        s[n // 2 :] = [_sentence(r, other) for _ in s[n // 2 :]]
    joint = "" if lang in ("zh", "ja") else " "
    kind = r.random() * (0.7 if lang in UNLISTED else 1)  # without marks, only what has known words can be told from keywords
    bare = [x.rstrip("。.!?！？।؟ ") for x in s]
    if kind < 0.35:
        return joint.join(s)
    if kind < 0.5:
        return "\n".join(joint.join(s[k : k + 3]) for k in range(0, n, 3))
    if kind < 0.6:
        return "\n".join(f"{r.choice(NAMES)}{r.choice('：:')}{'' if joint == '' else ' '}{x}" for x in s)
    if kind < 0.7:
        return "\n".join(f"{r.choice('-•*①')} {x}" for x in s)
    if kind < 0.8:
        return " ".join(bare)
    if kind < 0.9:
        return "\n".join(bare)
    return "\n\n".join(x + r.choice(("", "😀", "🔥🔥", "")) for x in s)


def _junk(r: random.Random, n: int) -> str:
    kind = r.choice((*range(28), 17, 11, 11, 12, 24, 26, 27))
    num = lambda: r.randint(1, 99_999)
    day = lambda: f"20{r.randint(10, 29)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}"
    link = lambda: f"{r.choice(('http', 'https'))}://{r.choice(('a', 'm', 'shop', 'dl'))}{r.randint(1, 99)}.{r.choice(('example', 'test'))}/{r.choice('abpv')}/{num()}"
    word = lambda: r.choice(NOUNS)
    title = r.choice(PLACES) + r.choice(("旧事", "之夜", "小记", " Stories"))
    if kind < 4:
        cut = ("|", "\t", ",", "  ", " | ")[r.randrange(5)]
        rows = [cut.join((day(), str(num()), str(num()), f"{r.randint(0, 99)}.{r.randint(0, 9)}%")) for _ in range(n)]
        return "\n".join([cut.join(("日期", "数量", "次数", "比例")), *rows])
    if kind == 4:
        return "\n".join(f"| {word()} | {num()} | {r.choice(PLACES)} |" for _ in range(n))
    if kind == 5:
        return "\n".join(r.choice(MENU) for _ in range(n * 2))
    if kind == 6:
        return "\n".join(f"{r.choice('-*•·')} {r.choice(NAMES)}" for _ in range(n * 2))
    if kind == 7:
        return "\n".join(f"{k}. {r.choice(PLACES)}{r.choice(('旧事', '之夜', '小记'))}" for k in range(1, n * 2))
    if kind == 8:
        return "\n".join(f"{r.choice(('点击', '入口', '播放', 'link'))}{k} {link()}" for k in range(1, n + 1))
    if kind == 9:
        return r.choice((" ", "\n")).join(f"[{word()}]({link()})" for _ in range(n))
    if kind == 10:
        return r.choice((" ", "")).join(f"#{r.choice(NOUNS + TAILS)}{r.choice(('', '#'))} " for _ in range(n * 3))
    if kind == 11:
        return r.choice(("\n", " ", "，", "|", ", ", "、")).join(title + r.choice(TAILS) for _ in range(n * 2))
    if kind == 12:
        return "\n".join(f"{r.choice(PLACES)}{word()}{r.choice(TAILS)} {r.choice(PLACES)}{word()}" for _ in range(n * 2))
    if kind == 13:
        return "".join(f'<div class="c{num()}"><span style="width:{r.randint(1, 99)}px"></span></div>' for _ in range(n))
    if kind == 14:
        return "<table>" + "".join(f"<tr><td>{r.choice(PLACES)}</td><td>{num()}</td></tr>" for _ in range(n)) + "</table>"
    if kind == 15:
        return "{" + ",".join(f'"{r.choice("abcdk")}{k}":{num()}' for k in range(n * 2)) + "}"
    if kind == 16:
        return "\n".join(f"[{num()}] {r.choice(('INFO', 'WARN', 'ERR'))} id={num()} t={r.random():.4f} rc={r.randint(0, 9)}" for _ in range(n))
    if kind == 17:
        return "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(n * r.randint(8, 40)))
    if kind == 18:
        return "".join(r.choice("&#■◆★>=*/\\@^~_$%|-") * r.randint(1, 6) for _ in range(n * 8))
    if kind == 19:
        return r.choice(("哈", "6", "ha", "啊啊", "==", "www", "lol")) * (n * 20)
    if kind >= 26:
        name = lambda: " ".join(r.choice("River Hill Garden Winter Silver Stone Night Letter Bridge Harvest Mirror Journey".split()) for _ in range(r.randint(1, 3)))
        if kind == 26:
            return r.choice(("; ", ", ", "\n", " / ")).join(f"{name()}{r.choice((f' ({r.randint(1950, 2025)})',) * 3 + ('',))}" for _ in range(n * 2))
        thing = name().lower()
        return r.choice((", ", "\n", " | ", "; ")).join(f"{r.choice(('buy', 'cheap', 'best', 'get', 'order', 'read'))} {thing} {r.choice(('online', 'price', 'free', 'pdf', 'review', 'near me', 'deals'))}" for _ in range(n * 2))
    if kind == 25:
        return r.choice("😀😂🔥👍🎉") * (n * 12) if r.random() < 0.5 else "\n".join(" ".join(r.choice("0123456789abcdef") + r.choice("0123456789abcdef") for _ in range(16)) for _ in range(n))
    if kind == 24:
        return "\n".join(r.choice((f"{r.randint(1, 12)}月{r.randint(1, 28)}日 {r.randint(6, 23)}:{r.choice(('00', '30', '15'))} {r.choice(PLACES)}{r.choice(('旧事', '之夜', '小记'))} 第{r.randint(1, 40)}集", f"{r.randint(1, 12)}月{r.randint(1, 28)}日 {r.randint(6, 23)}:{r.choice(('00', '30', '15'))} {r.choice(PLACES)}{r.choice(('旧事', '之夜', '小记'))} 第{r.randint(1, 40)}集", f"{r.randint(6, 23)}:00 {word()} {r.choice(PLACES)}")) for _ in range(n))
    if kind == 23:
        return "".join(_sentence(r, r.choice(("zh", "ja", "ko", "ru"))) for _ in range(n)).encode().decode("latin-1").replace("\n", "")
    if kind == 21:
        return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 11))) for _ in range(n * 4))
    if kind == 22:
        with_role = r.random() < 0.5
        return r.choice(("/", "; ", " / ", "、", "，")).join(f"{r.choice(NAMES)}{r.choice(('（{}）', ' ({})')).format(r.choice(ROLES)) if with_role else r.choice(('', '', f' ({r.randint(1950, 2025)})'))}" for _ in range(n * 3))
    if kind == 20:
        text = "".join(_sentence(r, "zh") for _ in range(n))
        return "".join(r.choice("�□¤??") if r.random() < 0.42 else c for c in text)
    return "\n".join(f"{r.choice(LABELS)}：{r.choice(NAMES)}" for _ in range(n * 2)) if r.random() < 0.5 else "\n".join(f"{r.choice(NAMES)}, {r.choice(NAMES)}" for _ in range(n * 2))


def _closed(r: random.Random, text: str) -> str:
    """Lines that end in a sentence mark, as those of prose do: all, some, or the last one."""
    lines, mark, kind = text.split("\n"), r.choice((".", ".", "。", "!", "！", "...", "…", "……", "?", " done.")), r.random()
    return "\n".join(x + mark if x.strip() and (kind < 0.5 or k == len(lines) - 1 or kind < 0.7 and r.random() < 0.6) else x for k, x in enumerate(lines))


@functools.lru_cache(maxsize=2)
def labelled_documents(size: int = LABELLED, seed: int = SEED) -> tuple[tuple[str, bool], ...]:
    """(text, is junk): half of each; a fourth holds a smaller part of the other kind, at its beginning or end.
    Of a third of the junk, lines end in sentence marks."""
    r, closing = random.Random(seed), random.Random(seed + 1)  # the other documents don't depend on the closed ones
    out = []
    while len(out) < size:
        junk = len(out) % 2 == 1
        text = _junk(r, r.randint(5, 25)) if junk else _prose(r, r.choice((1, 1, 2, 3, r.randint(1, 25), r.randint(1, 25))))
        if junk and closing.random() < 1 / 3:
            text = _closed(closing, text)
        if r.random() < 0.25 and len(text) > 60:
            other = ""
            while len(other) < len(text) * 0.15:
                other += ("\n" if other else "") + (_prose(r, 1) if junk else _junk(r, 2))
            if len(other) > len(text) * 0.4:
                continue
            text = f"{other}\n{text}" if r.random() < 0.5 else f"{text}\n{other}"
        out.append((text, junk))
    return tuple(out)


# ---- rules --------------------------------------------------------------------------------------------------------


class Test(NamedTuple):
    feature: str
    above: bool
    threshold: float


def _covers(rule: list[Test], x: dict[str, np.ndarray]) -> np.ndarray:
    hit = np.ones(len(next(iter(x.values()))), bool)
    for t in rule:
        hit &= x[t.feature] > t.threshold if t.above else x[t.feature] <= t.threshold
    return hit


def _grow(x: dict[str, np.ndarray], y: np.ndarray) -> list[Test]:
    """Adds the test of most information gain until no negative is left."""
    rule: list[Test] = []
    hit = np.ones(len(y), bool)
    orders = {name: np.argsort(v, kind="stable") for name, v in x.items()}
    while (hit & ~y).any() and len(rule) < 6:
        p, n = (hit & y).sum(), (hit & ~y).sum()
        base = np.log2(p / (p + n))
        best, gain = None, 0.0
        for name, v in x.items():
            order = orders[name]
            order = order[hit[order]]
            values, positive = v[order], y[order]
            edge = np.flatnonzero(values[1:] > values[:-1])
            if not len(edge):
                continue
            below_p = np.cumsum(positive)[edge]
            below_n = edge + 1 - below_p
            for above, pp, nn in ((False, below_p, below_n), (True, p - below_p, n - below_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - base), -1)
                k = int(np.argmax(g))
                if g[k] > gain + 1e-12:
                    best, gain = Test(name, above, float((values[edge[k]] + values[edge[k] + 1]) / 2)), float(g[k])
        if best is None:
            break
        rule.append(best)
        hit = _covers(rule, x)
    return rule


def induce(x: dict[str, np.ndarray], y: np.ndarray, seed: int = SEED, patience: int = 12) -> list[list[Test]]:
    """The ordered rules for y: each is grown on two thirds of what is left and cut back on the other third. A rule that
    is no better there than chance is dropped; after ``patience`` of these in a row the list is complete."""
    rng = np.random.default_rng(seed)
    left = np.ones(len(y), bool)
    rules: list[list[Test]] = []
    failed = 0
    while (left & y).sum() > 5 and failed < patience:
        at = rng.permutation(np.flatnonzero(left))
        grow, prune = at[: 2 * len(at) // 3], at[2 * len(at) // 3 :]
        part = lambda k: {n: v[k] for n, v in x.items()}
        if not y[grow].any():
            break
        rule = _grow(part(grow), y[grow])
        px, py = part(prune), y[prune]

        def worth(r: list[Test], px=px, py=py) -> float:
            h = _covers(r, px)
            p, n = (h & py).sum(), (h & ~py).sum()
            return (p - n) / (p + n) if p + n else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        if not rule or worth(rule) <= 0.7:
            failed += 1
            continue
        failed = 0
        rules.append(rule)
        left &= ~_covers(rule, x)
    return rules


def best_rules(x: dict[str, np.ndarray], y: np.ndarray, seed: int = SEED, runs: int = 6) -> list[list[Test]]:
    """Of ``runs`` inductions, each with its own splits into growing and pruning sets, the ordered list with fewest errors."""

    def errors(rules: list[list[Test]]) -> int:
        hit = np.zeros(len(y), bool)
        for r in rules:
            hit |= _covers(r, x)
        return int((hit != y).sum())

    return list(map(_tightest, min((induce(x, y, seed + k) for k in range(runs)), key=errors)))


def _tightest(rule: list[Test]) -> list[Test]:
    """The rule with one test for each statistic and direction."""
    best: dict[tuple[str, bool], float] = {}
    for t in rule:
        k = t.feature, t.above
        best[k] = t.threshold if k not in best else max(best[k], t.threshold) if t.above else min(best[k], t.threshold)
    return [Test(f, above, v) for (f, above), v in best.items()]


def case_sql(rules: list[list[Test]]) -> str:
    """The rules as one CASE expression over the statistics; null ones have to be filled with 0, as in the training."""
    if not rules:
        return "false"
    arms = " ".join("WHEN " + " AND ".join(f"{t.feature} {'>' if t.above else '<='} {t.threshold!r}D" for t in r) + " THEN true" for r in rules)
    return f"CASE {arms} ELSE false END"


@functools.lru_cache(maxsize=2)
def learned_rules(size: int = LABELLED, seed: int = SEED) -> list[list[Test]]:
    """Rules from the labelled documents, whose statistics are measured as those of the corpus are."""
    docs = labelled_documents(size, seed)
    parts = [measured(pa.array([t for t, _ in docs[k : k + 2_000]], pa.string())) for k in range(0, len(docs), 2_000)]
    x = {f: np.nan_to_num(np.concatenate([m[f] for m in parts])) for f in FEATURES}
    return best_rules(x, np.array([j for _, j in docs]), seed)


def no_prose(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key) of the texts that the rules take for no prose; null, empty and blank texts are none of them."""
    rules = learned_rules()
    some = df.where(F.col(text).rlike(r"[^\s\p{Z}\p{C}]"))
    return with_statistics(some, text, [key]).fillna(0.0, list(SHARES)).where(F.expr(case_sql(rules))).select(key)
