"""Lines that one site repeats through its documents, and bodies without them.

A first pass keeps a lossy-counting summary for every source in every task: a line is dropped from it only while it is
in at most ``EPS`` of the task's rows of that source, so merged summaries miss no line at or above the wanted share.
The merged upper bounds give a few candidates for each source; a second pass counts them exactly, and the confirmed
ones are taken out with broadcast sets.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.codepoints import slices
from millrace.plans.lineage import cut

#: A repeated line is in at least so many rows and in at least this share of its source's rows.
LEAST_ROWS, LEAST_SHARE = 5, 0.05
#: Error of the summaries, a share of the rows; below LEAST_SHARE.
EPS = 0.02
#: A task's summaries of all sources together hold so many entries at most: then they are pruned, and where that doesn't
#: halve them, sent on, and the task begins new ones.
PRUNE_AT = 400_000
#: Candidates go to the tasks as a broadcast set up to this many; beyond it they are joined.
BROADCAST_LINES = 200_000

_DIGITS = re.compile(r"\d+")
_FORMAT = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0xAD, 0xAD), (0x600, 0x605), (0x61C, 0x61C), (0x6DD, 0x6DD), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFF9, 0xFFFB), (0x1D173, 0x1D17A), (0xE0001, 0xE01EF))) + "͏ᅟᅠㅤﾠ\x00-\x08\x0e-\x1b\x7f]")
_KEEP_KEYS = 200_000


def line_form(line: str) -> str:
    """A line with compatibility forms, letter case, blanks, invisible characters and the values of digit runs set aside."""
    if not line.isascii():
        line = _FORMAT.sub("", unicodedata.normalize("NFKC", _FORMAT.sub("", line)))
    return _DIGITS.sub("0", "".join(line.casefold().split()))


def line_keys(body: str, seen: dict[str, bytes | None]) -> list[bytes | None]:
    """The key of each line; None for a line with nothing left. ``seen`` is a bounded cache."""
    out = []
    for line in body.split("\n"):
        try:
            key = seen[line]
        except KeyError:
            form = line_form(line)
            key = xxhash.xxh3_128_digest(form.encode("utf-8", "surrogatepass")) if form else None
            if len(line) < 120:
                if len(seen) > _KEEP_KEYS:
                    seen.clear()
                seen[line] = key
        out.append(key)
    return out


def _outer(c: str, end: int) -> str:
    """What a character at the begin (0) or end (-1) of a line's form is, its marks aside; '' if it is blank, invisible or a mark."""
    d = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", _FORMAT.sub("", c)).casefold())
    d = "".join(x for x in d if unicodedata.category(x)[0] != "M" and not x.isspace())
    return "0" if d and _DIGITS.fullmatch(d[end]) else d[end] if d else ""


class Ends(dict):
    """Character -> what it is at one end of a form; a bounded cache."""

    def __init__(self, end: int):
        self.end = end

    def __missing__(self, c: str) -> str:
        if len(self) > 50_000:
            self.clear()
        got = self[c] = _outer(c, self.end)
        return got


_FIRST, _LAST = Ends(0), Ends(-1)


def line_ends(line: str) -> str:
    """The first and last character of a line's form, marks aside: lines of one form have the same. '' for nothing visible."""
    a = next((x for c in line if (x := _FIRST[c])), "")
    return a + next((x for c in reversed(line) if (x := _LAST[c])), "") if a else ""


class Repeated(NamedTuple):
    #: (source, key, ends), the confirmed lines
    lines: DataFrame
    #: (id, line_no, source, key), every occurrence of a candidate; written to the shared folder
    occurrences: DataFrame


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(source, key, most, rows, ends): upper bound of the rows with that line in this task; key null: the task's rows of the source."""
    counts: dict[str, dict[bytes, list]] = {}
    rows: dict[str, int] = {}
    seen: dict[str, bytes | None] = {}
    entries = 0

    def prune() -> int:
        for source, own in counts.items():
            least = EPS * rows[source]
            counts[source] = {k: c for k, c in own.items() if c[0] + c[1] > least}
        return sum(map(len, counts.values())) + len(rows)

    def sent() -> pa.RecordBatch:
        out = [(s, None, n, n, None) for s, n in rows.items()]
        out += [(s, k, c[0] + c[1], rows[s], c[2]) for s, own in counts.items() for k, c in own.items()]
        cols = [*zip(*out, strict=True)]
        counts.clear()
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.string())], names=["source", "key", "most", "rows", "ends"])

    for batch in batches:
        for part in slices(batch, 1):
            for source, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                entries += source not in rows
                rows[source] = n = rows.get(source, 0) + 1
                if not body:
                    continue
                own = counts.setdefault(source, {})
                floor = int(EPS * (n - 1))
                for key, line in dict(zip(line_keys(body, seen), body.split("\n"), strict=True)).items():
                    if key is not None:
                        c = own.get(key)
                        if c is None:
                            own[key] = [1, floor, line_ends(line)]
                            entries += 1
                        else:
                            c[0] += 1
                if entries > PRUNE_AT:
                    entries = prune()
                    if entries > PRUNE_AT // 2:
                        yield sent()
                        entries = 0
    if rows:
        prune()
        yield sent()


def _by_ends(rows: list) -> dict[str, dict[str, set[bytes]]]:
    """source -> ends -> keys."""
    out: dict[str, dict[str, set[bytes]]] = {}
    for r in rows:
        out.setdefault(r.source, {}).setdefault(r.ends, set()).add(bytes(r.key))
    return out


def _known_keys(body: str, own: dict[str, set[bytes]], seen: dict[str, bytes | None]) -> list[bytes | None]:
    """The key of each line that is among ``own``; None for others. Only lines with the ends of one of these are formed."""
    out: list[bytes | None] = []
    for line in body.split("\n"):
        keys = own.get(line_ends(line)) if line else None
        key = line_keys(line, seen)[0] if keys else None
        out.append(key if key is not None and key in keys else None)
    return out


def repeated_lines(df: DataFrame, key: str, source: str, body: str) -> Repeated:
    """The lines repeated in each source of ``df``, with their places.

    Rows without source belong to none; a null or empty body counts as a row and has no lines. Lines are parted by \\n and
    counted from 1. A line that stands twice in a row counts once for its source and is given twice. Repeated rows count
    as rows. An empty table gives empty results.
    """
    rows = df.where(F.col(source).isNotNull()).select(F.col(source).alias("source"), F.col(body).alias("body"), F.col(key).alias("id"))
    merged = cut(rows.select("source", "body").mapInArrow(_summaries, "source string, key binary, most bigint, rows bigint, ends string").groupBy("source", "key").agg(F.sum("most").alias("most"), F.sum("rows").alias("rows"), F.max("ends").alias("ends")))
    totals = merged.where("key is null").select("source", F.col("rows").alias("n"))
    bound = F.col("most") + F.lit(EPS) * (F.col("n") - F.col("rows"))
    least = F.greatest(F.lit(float(LEAST_ROWS)), F.lit(LEAST_SHARE) * F.col("n") - 1e-9)
    candidates = merged.where("key is not null").join(totals, "source").where(bound >= least).select("source", "key", "ends")
    few = candidates.limit(BROADCAST_LINES + 1).collect()  # at most lines per row / (LEAST_SHARE - EPS) for each source
    shared = df.sparkSession.sparkContext.broadcast(_by_ends(few)) if len(few) <= BROADCAST_LINES else None

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = shared.value if shared is not None else None
        seen: dict[str, bytes | None] = {}
        for batch in batches:
            for part in slices(batch, 1):
                out = []
                for s, b, i in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    own = sets.get(s) if sets is not None else None
                    if not b or (sets is not None and own is None):
                        continue
                    met = set()
                    for n, k in enumerate(line_keys(b, seen) if own is None else _known_keys(b, own, seen), 1):
                        if k is not None:
                            out.append((i, n, s, k, k not in met))
                            met.add(k)
                if out:
                    cols = [*zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.bool_())], names=["id", "line_no", "source", "key", "first"])

    found = rows.select("source", "body", F.col("id").cast("string")).mapInArrow(places, "id string, line_no int, source string, key binary, first boolean")
    if shared is None:
        found = found.join(candidates, ["source", "key"], "left_semi")
    found = cut(found)
    ends = candidates if shared is None else df.sparkSession.createDataFrame([(r.source, bytes(r.key), r.ends) for r in few], "source string, key binary, ends string")
    exact = found.groupBy("source", "key").agg(F.sum(F.col("first").cast("bigint")).alias("n_rows"))
    confirmed = exact.join(totals, "source").where(F.col("n_rows") >= least).select("source", "key").join(ends, ["source", "key"])
    return Repeated(cut(confirmed), found)


def repeated_places(df: DataFrame, key: str, source: str, body: str) -> DataFrame:
    """(id, line_no) of every line that is repeated in its source."""
    got = repeated_lines(df, key, source, body)
    return got.occurrences.join(got.lines, ["source", "key"], "left_semi").select("id", "line_no")


def without_repeated(df: DataFrame, key: str, source: str, body: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``body`` without the lines repeated in the row's source; null stays null.

    Confirmed lines are sent to the tasks as a set where they are few, else the places are joined to the rows by id.
    """
    got = repeated_lines(df, key, source, body)
    few = got.lines.limit(BROADCAST_LINES + 1).collect()
    cols = list(dict.fromkeys(keep))
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols), "body string"])
    rows = df.select(F.col(source).alias("_source"), F.col(body).alias("_body"), *cols)
    if len(few) > BROADCAST_LINES:
        places = got.occurrences.join(got.lines, ["source", "key"], "left_semi").groupBy("id").agg(F.collect_set("line_no").alias("_lines"))  # bounded: the lines of one row
        numbered = df.join(places, df[key].cast("string") == places["id"], "left").select(*(df[c] for c in cols), df[body].alias("_body"), "_lines")
        kept = F.array_join(F.expr("transform(filter(transform(split(_body, '\n', -1), (x, i) -> struct(i, x)), p -> not array_contains(coalesce(_lines, array()), p.i + 1)), p -> p.x)"), "\n")
        return numbered.select(*cols, F.when(F.col("_body").isNotNull(), kept).alias("body"))
    shared = df.sparkSession.sparkContext.broadcast(_by_ends(few))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, bytes | None] = {}
        for batch in batches:
            for part in slices(batch, 1):
                out = []
                for s, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    own = shared.value.get(s)
                    if b and own:
                        b = "\n".join(line for line, k in zip(b.split("\n"), _known_keys(b, own, seen), strict=True) if k is None)
                    out.append(b)
                yield pa.RecordBatch.from_arrays([*part.columns[2:], pa.array(out, pa.string())], names=[*cols, "body"])

    return rows.mapInArrow(run, schema)
