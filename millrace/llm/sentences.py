"""Sentence units by a semi-Markov choice of whole spans.

In each line, places where a sentence may end are collected with a weight from the words that close before and open after
them (abbreviations, initials, numbers, letter case, quotations and what introduces or follows them). Dynamic programming
then takes the chain of spans of the highest total: weights of the ends, the spans' lengths, and a heavy loss for each end of
a span that lies inside a quotation or bracket, so that no end inside a quotation pays.
"""

from __future__ import annotations

import unicodedata
from collections import deque
from collections.abc import Iterator
from itertools import islice, pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.codepoints import slices

#: Loss of a span for each of its two ends that lies inside a quotation or bracket: two spans pay it for one cut, more than
#: any cut gains, whatever the number of sentences in the quotation.
UNBALANCED = 9.0
#: Loss of a span by its number of letters; none from as many letters on as there are entries.
SHORT = (3.0, 3.0, 0.75, 0.4, 0.2, 0.1)

# Abbreviations after which a sentence goes on, and those that may also close one.
GOES_ON = set("pág págs núm cap mr mrs ms dr prof st no nr vol vs e.g i.e eg ie approx ca cf fig art op mme mlle m sr sra srta dra d z b z.b bzw mio mrd usw inkl ggf str p ex p.ex av bd j. jr lt col gen sen rep capt sgt ed eds pp ch sec al ee د م أ डॉ श्री г ул им".split())
MAY_CLOSE = set("p.m a.m u.k u.s u.s.a etc inc ltd co corp uu ee.uu usw et.al u.a o.ä".split())
OPENERS = set("the a an it he she they we i you this that there in on at when who what why how does do did is are was were nobody nothing say to for my our his her its one if but and viewers see prof dr ms mr mrs".split())
MONTHS = set("januar februar märz april mai juni juli august september oktober november dezember jahrhundert januára".split())
REPORTING = regex.compile(r"^[^，。！？：:；“”「」\n]{1,18}(?:说道|问道|喊道|叫道|答道|低声道|说|喊|问)[。！？!?]")
CLOSING = "”’」』»\"'）)]】〉》›"
PAIRS = {"„": ("l", 1), "“": ("q", 1), "”": ("q", -1), "「": ("k", 1), "」": ("k", -1), "『": ("w", 1), "』": ("w", -1), "«": ("g", 1), "»": ("g", -1), "（": ("b", 1), "）": ("b", -1), "(": ("b", 1), ")": ("b", -1)}
_PAIRED = regex.compile("[" + regex.escape("".join(PAIRS), special_only=False) + '"]')
_OPEN = {"”": "“", "」": "「", "』": "『", "»": "«", '"': '"'}

_BLANK = r"[\s\p{Z}\u200b-\u200f\u2060-\u2064\ufeff]"
_MARKS = regex.compile(rf"(?P<m>[.．。｡！？!?।؟۔…‥]+)(?P<c>(?:{_BLANK}?»|[”’」』»\"'）)\]】〉》›])*)")
_THAI = regex.compile(r"(?<=[ก-๏])[ \t\p{Zs}]+(?=[ก-๏])")
_BLANKS = regex.compile(rf"(?<=\S){_BLANK}+(?=\S)")
_LINES = regex.compile(r"[^\n\r\u2028\u2029\u0085\v\f]+")
_TOKEN = regex.compile(r"[\p{L}\p{M}.．’']+$")
_NEXT = regex.compile(rf"{_BLANK}*(?P<q>[“\"'‘«「『(（¿¡]*)(?P<w>[\p{{L}}\p{{M}}\p{{N}}]*)")
_HAN, _KANA = regex.compile(r"[㐀-鿿]"), regex.compile(r"[぀-ヿ가-힣฀-๿]")
_STRONG = set("。｡！？!?।؟۔")
_LETTER = regex.compile(r"[\p{L}\p{N}]")
_EMOTE = regex.compile(rf"(?:\[[^\[\]\s]{{1,6}}\]|[^\p{{L}}\p{{N}}])+")


def _is_cjk(c: str) -> bool:
    return "⺀" <= c <= "鿿" or "぀" <= c <= "ヿ" or "＀" <= c <= "￯"


def _quoted(line: str, end: int) -> float | None:
    """For an end at a closing quotation mark: whether the quotation closes the sentence (>0) or the sentence goes on."""
    k = end - 1
    while k >= 0 and line[k] not in _OPEN and line[k] in CLOSING:
        k -= 1
    if k < 0 or line[k] not in _OPEN:
        return None
    mark = _OPEN[line[k]]
    o = line.rfind(mark, 0, k)
    if o < 0:
        return None
    before = line[:o].rstrip()
    rest = line[end:].lstrip()
    if not rest:
        return 4.0
    if REPORTING.match(rest):
        return -6.0
    first = rest[0]
    if first in "，,、；;：:—-–" or first.islower():
        return -6.0
    if not before or before[-1] in "。！？!?.｡।؟…":
        return -5.0  # it opens its sentence: who speaks follows
    if before[-1] in "：:，,、":
        return 4.0  # it was introduced
    return -5.0


def _weights(line: str, chinese_bare: bool) -> list[tuple[int, int, float]]:
    """(end, start of what follows, weight) of each place where a sentence of this line may end."""
    out: dict[int, tuple[int, float]] = {}
    n = len(line)
    for m in _MARKS.finditer(line):
        marks, end = m.group("m"), m.end()
        rest = _NEXT.match(line, end)
        word = rest.group("w")
        spaced = rest.start("q") > end
        if not line[end:].strip():
            continue  # the line's end is one anyway
        strong = any(c in _STRONG for c in marks)
        weight: float
        quoted = _quoted(line, end) if m.group("c") else None
        if quoted is not None:
            weight = quoted
        elif m.group("c") and not strong and set(marks) <= {"…", "‥"}:
            weight = -4.0
        elif strong:
            weight = 4.0
            if word[:1].islower() and all(c in "!?" for c in marks) and spaced:
                weight = -3.0
            if m.group("c").endswith((")", "）")) and not word[:1].isupper():
                weight = -2.0 if spaced or _is_cjk(line[end]) else -4.0
            if not spaced and word and word[0].isascii() and all(c in "!?" for c in marks) and m.start() and line[m.start() - 1].isascii() and line[m.start() - 1].isalnum():
                weight = -4.0
        elif len(marks) > 1:
            weight = -4.0 if not (spaced and word[:1].isupper() and marks[0] == "." and m.start() and line[m.start() - 1].isalnum()) else 0.5
        elif marks in "…‥":
            weight = -4.0
        else:  # one full stop
            previous = line[m.start() - 1] if m.start() else " "
            token = _TOKEN.search(line, max(0, m.start() - 24), m.start())
            name = unicodedata.normalize("NFKC", token.group()).lower().strip("'’") if token else ""
            word = unicodedata.normalize("NFKC", word)
            if not spaced and not m.group("c"):
                weight = 2.5 if _HAN.match(previous) and _HAN.match(word[:1] or " ") else -9.0
            elif name in GOES_ON or name.split(".")[-1] in GOES_ON and "." in name and name not in MAY_CLOSE:
                weight = -7.0
            elif len(name) == 1 and (token.group().isupper() or "؀" <= name <= "ۿ"):
                weight = -7.0
            elif name in MAY_CLOSE or ("." in name and len(name.replace(".", "")) <= 3):
                weight = 3.0 if word[:1].isupper() and (word.lower() in OPENERS or not word.isascii()) else 1.0 if word[:1].isupper() or not word[:1].isascii() else -6.0
            elif word[:1].islower():
                weight = -5.0
            elif previous.isdigit() and word.lower() in MONTHS:
                weight = -6.0  # an ordinal
            elif previous.isdigit() and word[:1].isdigit():
                weight = -3.0
            elif not name and previous.isdigit() and m.start() <= 4:
                weight = -5.0  # a number that opens the line
            else:
                weight = 4.0
        out[end] = (rest.start("q") if spaced else end, weight)
    for m in _THAI.finditer(line):
        out[m.start()] = (m.end(), 5.0)
    if chinese_bare:
        for m in _BLANKS.finditer(line):
            out[m.start()] = (m.end(), 5.0)
    return [(e, *out[e]) for e in sorted(out) if 0 < e < n]


def _quotations(line: str) -> list[tuple[int, int]]:
    """(first place inside, place of the closing mark) of every quotation or bracket of the line, outer ones only, in order.

    Marks are matched within the line, the nearest of a kind with each other; a mark without its other half bounds nothing.
    A straight mark that can't open, as a sign of inches after a number, opens nothing.
    """
    opened: dict[str, list[int]] = {}
    straight, found = -1, []
    for m in _PAIRED.finditer(line):
        k, c = m.start(), m.group()
        if c == '"':
            if straight >= 0:
                found.append((straight + 1, k))
                straight = -1
            elif k + 1 < len(line) and not (line[k + 1].isspace() and k and not line[k - 1].isspace()) and not (k and line[k - 1].isdigit()):
                straight = k
            continue
        key, d = PAIRS[c]
        if c in "“”" and opened.get("l"):  # a low mark is closed by either
            key, d = "l", -1
        if d > 0:
            opened.setdefault(key, []).append(k)
        elif opened.get(key):
            found.append((opened[key].pop() + 1, k))
    outer: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if not outer or a > outer[-1][1]:
            outer.append((a, b))
        elif b > outer[-1][1]:
            outer[-1] = outer[-1][0], b
    return outer


def _line_ends(line: str, chinese_bare: bool) -> list[int]:
    """Ends of the sentences of one line that has something visible, the last one being the line's own end."""
    last = len(line.rstrip())
    places = [p for p in _weights(line, chinese_bare) if p[0] < last]
    if not places:
        return [last]
    cuts = [0, *(e for e, _, _ in places), last]
    gains = [0.0, *(w for _, _, w in places), 0.0]
    broken, k, inside = [0.0] * len(cuts), 0, _quotations(line)
    for j in range(1, len(cuts) - 1):
        while k < len(inside) and inside[k][1] < cuts[j]:
            k += 1
        if k < len(inside) and inside[k][0] <= cuts[j]:
            broken[j] = UNBALANCED  # paid by the span that ends there and by the one that begins there
    letters = [0]
    for a, b in pairwise(cuts):  # more than the short lengths needn't be told apart
        letters.append(letters[-1] + sum(1 for _ in islice(_LETTER.finditer(line, a, b), len(SHORT))))
    # Where a span begins counts by its best total and by the number of letters before it. So the best beginning for each of
    # the last few numbers of letters, and the best of all further back, hold the best one. Ties go to the earliest.
    best, back = [0.0] + [float("-inf")] * (len(cuts) - 1), [0] * len(cuts)
    near: dict[int, int] = {}
    far, waiting = -1, deque()
    for j in range(1, len(cuts)):
        i, n = j - 1, letters[j - 1]
        worth = lambda x: best[x] - broken[x]
        if n not in near:
            near[n] = i
            waiting.append(n)
        elif worth(i) > worth(near[n]):
            near[n] = i
        while waiting and letters[j] - waiting[0] >= len(SHORT):
            i = near.pop(waiting.popleft())
            far = i if far < 0 or worth(i) > worth(far) else far
        for i, loss in ((far, 0.0), *((near[n], SHORT[letters[j] - n]) for n in waiting)):
            if i >= 0 and (score := worth(i) + gains[j] - broken[j] - loss) > best[j]:
                best[j], back[j] = score, i
    chain, j = [], len(cuts) - 1
    while j:
        chain.append(cuts[j])
        j = back[j]
    ends = chain[::-1]
    # signs without letters and emotes after the last end belong to it
    if len(ends) > 1 and _EMOTE.fullmatch(line, ends[-2], ends[-1]):
        del ends[-2]
    return ends


def sentence_ends(text: str) -> list[int]:
    """Code points from the text's start to the end of each sentence. An empty or blank text has none."""
    bare = False
    if _HAN.search(text) and not any(c in _STRONG for c in text) and not _KANA.search(text):
        bare = len(_HAN.findall(text)) * 2 > len(_LETTER.findall(text)) and not regex.search(r"\p{L}\.(?:\s|$)", text)
    out = []
    for m in _LINES.finditer(text):
        line = m.group()
        if line.strip(" \t　\xa0"):
            lead = m.start()
            out.extend(lead + e for e in _line_ends(line, bare) if e)
    return out


def with_sentences(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``ends``, the ends of the text's sentences; an empty list for null and empty texts."""
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "ends array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                ends = [sentence_ends(t) if t else [] for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(ends, pa.list_(pa.int32()))], names=[*keep, "ends"])

    return df.select(F.col(text).cast("string").alias("_text"), *keep).mapInArrow(run, schema)


def units(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row for each sentence: ``keep``, its number and end."""
    return with_sentences(df, text, keep).select(*keep, F.posexplode("ends").alias("sentence_no", "end_pos"))
