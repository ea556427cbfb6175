"""Places in texts: sentence spans, verbatim fragments and overlaps. Places are code points from 0, half-open."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Signs that end a span; letters a span or a part needs; characters from which on it is parted, least distance
# of two softer places, and the distance where there are none; what makes a softer place.
ENDS, LINE_ENDS = "。！？!?；;", "\r\n"
LEAST_LETTERS, LONGEST, LEAST_PIECE, STEP = 8, 150, 45, 140
PAUSES = "，,、：:"
ITEMS = "①②③④⑤⑥⑦⑧⑨⑩"
TURNS = "但是|不过|然而|同时|另外|其次|最后|再说|更重要的是"
TOPIC = "#.{1,32}?#"

_BEFORE = regex.compile(rf"(?=\s*(?:[{ITEMS}]|{TOPIC}|{TURNS}))")
_TEXT, _END, _LINE = 0, 1, 2
_KIND = np.zeros(0x110000, np.uint8)
_KIND[[ord(c) for c in ENDS]] = _END
_KIND[[ord(c) for c in LINE_ENDS]] = _LINE
_LETTER = np.zeros(0x110000, bool)
for _a, _b in ("一鿿", "AZ", "az", "09"):
    _LETTER[ord(_a) : ord(_b) + 1] = True
_PAUSE = np.zeros(0x110000, bool)
_PAUSE[[ord(c) for c in PAUSES]] = True
#: Texts are worked on together up to so many characters.
SLICE_CHARS = 1 << 20


def _parts(raw: str, pauses: np.ndarray) -> list[int]:
    """Where a long span is parted, from 0 to its end: at the softer places that are far enough from the last one taken."""
    soft = sorted({*(pauses + 1).tolist(), *(m.start() for m in _BEFORE.finditer(raw))})
    cuts, k = [0], bisect_left(soft, LEAST_PIECE)
    while k < len(soft):
        cuts.append(soft[k])
        k = bisect_left(soft, soft[k] + LEAST_PIECE)
    if len(raw) - cuts[-1] >= LEAST_LETTERS:
        cuts.append(len(raw))  # a shorter rest is lost, unless nothing was parted
    return cuts if len(cuts) > 2 else [*range(0, len(raw), STEP), len(raw)]


def spans(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, start, end) of the spans of all these texts, in order. A text without any is one whole span, an empty
    text has none.

    The texts are one array of code points, parted by line ends, so that spans are found between changes of kind.
    """
    joined = "\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(size + 1) - size - 1
    inside = np.concatenate([[False], _KIND[points] == _TEXT, [False]])
    start, end = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    closed = np.append(_KIND[points], _LINE)[end] == _END
    end = end + closed
    letters = np.concatenate([[0], np.cumsum(_LETTER[points])])
    ok = letters[end] - letters[start] >= LEAST_LETTERS
    start, end = start[ok], end[ok]
    if len(long := np.flatnonzero(end - start > LONGEST)):
        pauses = np.flatnonzero(_PAUSE[points])
        low, high = np.searchsorted(pauses, start[long]), np.searchsorted(pauses, end[long])
        cuts = [np.array(_parts(joined[a:b], pauses[x:y] - a)) + a for a, b, x, y in zip(start[long].tolist(), end[long].tolist(), low, high, strict=True)]
        start = np.sort(np.concatenate([np.delete(start, long), *(c[:-1] for c in cuts)]))
        end = np.sort(np.concatenate([np.delete(end, long), *(c[1:] for c in cuts)]))
        ok = letters[end] - letters[start] >= LEAST_LETTERS
        start, end = start[ok], end[ok]
    row = np.searchsorted(first, start, side="right") - 1
    bare = np.setdiff1d(np.flatnonzero(size), row)
    row = np.concatenate([row, bare])
    start, end = np.concatenate([start, first[bare]]), np.concatenate([end, first[bare] + size[bare]])
    order = np.lexsort((start, row))
    row = row[order]
    return row, start[order] - first[row], end[order] - first[row]


def spans_of(text: str) -> list[tuple[int, int]]:
    """Spans of one text."""
    _, a, b = spans([text])
    return list(zip(a.tolist(), b.tolist(), strict=True))


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def span_lists(texts: pa.Array) -> pa.Array:
    """The spans of each text of an Arrow column; none for null."""
    values = [t or "" for t in texts.to_pylist()]
    parts, at = [], 0
    while at < len(values):
        upto, n = at, 0
        while upto < len(values) and (upto == at or n + len(values[upto]) <= SLICE_CHARS):
            n += len(values[upto])
            upto += 1
        row, a, b = spans(values[at:upto])
        offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=upto - at))]).astype(np.int32)
        both = pa.StructArray.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32())], fields=list(SPANS.value_type))
        parts.append(pa.ListArray.from_arrays(pa.array(offsets), both).cast(SPANS))
        at = upto
    return pa.concat_arrays(parts) if parts else pa.array([], SPANS)


def with_span_lists(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and spans, an array of (start, end). Long spans need state, so texts go through Arrow batches."""
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "spans array<struct<start:int,end:int>>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[1:], span_lists(b.column(0))], names=[*keep, "spans"])

    return df.select(F.col(text).alias("_text"), *keep).mapInArrow(run, schema)


def with_spans(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep``, span_no, start and end of each span."""
    return with_span_lists(df, text, keep).select(*keep, F.posexplode("spans").alias("span_no", "_s")).select(*keep, "span_no", "_s.start", "_s.end")


def locate(text: Column, first: Column, second: Column) -> list[Column]:
    """[start of first, start of second after the first's end], from 0; null where one isn't there, in that order."""
    a = F.when(F.instr(text, first) > 0, F.instr(text, first) - 1)
    rest = F.substring(text, a + F.length(first) + 1, F.length(text))
    b = F.when(F.instr(rest, second) > 0, F.instr(rest, second) - 1 + a + F.length(first))
    return [a, b]


def overlap(a: Column, b: Column) -> Column:
    """Whether any interval of one array of (start, end) overlaps one of the other; half-open."""
    return F.exists(a, lambda x: F.exists(b, lambda y: F.greatest(x.start, y.start) < F.least(x.end, y.end)))


def overlap_violations(passages: DataFrame, most: int = 2) -> DataFrame:
    """(source_id, issue) of sources with passages that overlap the one before, or more than ``most`` of them."""
    w = Window.partitionBy("source_id").orderBy("start", "end")
    seen = passages.withColumns({"_before": F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))})
    crossing = seen.where(F.col("start") < F.col("_before")).select("source_id", F.lit("overlap").alias("issue")).distinct()
    many = passages.groupBy("source_id").count().where(F.col("count") > most).select("source_id", F.lit("too many").alias("issue"))
    return crossing.unionByName(many)


def contained(fragments: DataFrame, texts: DataFrame) -> DataFrame:
    """Fragments with whether their own text holds them word for word, and where: joined on id, never all with all."""
    return fragments.join(texts, "id").select("id", "fragment", F.contains("text", F.col("fragment")).alias("verbatim"), (F.instr("text", F.col("fragment")) - 1).alias("at"))
