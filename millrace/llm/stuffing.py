"""Pages of repeated keywords, links or product tags instead of sentences.

Each text is compressed block by block, and so is its outline, in which links, tags, runs of letters and numbers are
each one sign, so that lists of ever new names or addresses show as what they are. Both rates are set against the median
of texts of the same language and length. Extreme redundancy of the text itself is flagged at once; other redundancy
only where sentence marks are also rare for the language.
"""

from __future__ import annotations

import functools
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.codepoints import slices, to_code_points
from millrace.llm.quality import COMMON_WORDS
from millrace.plans.lineage import cut

#: Bytes of a block. Texts of more than a block are all of one length class.
BLOCK = 1024
#: Redundant beyond confirmation: the text's rate is so many of the language's spreads below the median, what the outline's
#: rate is below its median added; more in a language without sentence marks, where nothing can be confirmed.
EXTREME, EXTREME_UNMARKED = 2.65, 3.3
#: The spread of a language's rates: so many times the distance from its median to its upper quartile, which redundant
#: texts hardly move as they lie below both (about where the lowest twentieth of other texts begins); at least LEAST_SPREAD.
QUARTILES, LEAST_SPREAD = 2.5, 0.17
#: Redundant if confirmed: the lower of both rates.
REDUNDANT = 0.8
#: Few sentence marks: this share of the language's median density.
FEW_MARKS = 0.27
#: A class of language and length counts for its yardstick by its number of texts against so many of the language, and a
#: language by its number of texts against so many of its script.
BLEND_ROWS = 30
#: Texts of fewer characters than this say too little to a compressor: they have no rates, and are stuffed if this share of
#: their characters is in two and more links, tags and hashtags, or if they have no sentence mark and this share of their
#: words (three at least) repeats others.
LEAST_CHARS, SIGN_SHARE, REPEATED_SHARE = 40, 0.6, 0.6

# First and last code points of the scripts told apart.
SCRIPTS = {"zh": [(0x3400, 0x9FFF), (0x20000, 0x323AF)], "ja": [(0x3040, 0x30FF)], "ko": [(0xAC00, 0xD7A3), (0x1100, 0x11FF)], "th": [(0xE00, 0xE7F)], "ar": [(0x600, 0x6FF), (0x750, 0x77F)], "hi": [(0x900, 0x97F)], "cy": [(0x400, 0x52F)], "la": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F)]}
_CODES = list(SCRIPTS)
#: Languages of the Latin script that are told apart, by their frequent words: this share of a text's words at least.
LATIN, FREQUENT_SHARE = ("en", "fr", "de", "es"), 0.12
_FREQUENT: dict[str, list[str]] = {}
for _name in LATIN:
    for _w in COMMON_WORDS[_name].split():
        _FREQUENT.setdefault(_w, []).append(_name)
_SCRIPT = np.full(0x110000, len(_CODES), np.uint8)
for _k, _name in enumerate(_CODES):
    for _a, _b in SCRIPTS[_name]:
        _SCRIPT[_a : _b + 1] = _k
_LINK = regex.compile(r"(?:https?://|www\.)[A-Za-z0-9._~/?#@!$&*+;=%-]+")
_HASHTAG = regex.compile(r"#[^\s#]+#?")
_TAG = regex.compile(r"<[^<>]+>")
_WORD = regex.compile(r"[\p{L}\p{M}]+")
#: Sentence marks, and what may follow a full stop that is one.
_STRONG = np.array([ord(c) for c in "。！？!?…।؟"], np.uint32)
_AFTER_STOP = np.array([ord(c) for c in " \t\n\r\v\f\x85\xa0\u2028\u2029\u3000\"”’)"], np.uint32)
#: A link, a tag and a hashtag are each one of these private characters in an outline.
_LINK_SIGN, _TAG_SIGN, _HASHTAG_SIGN = "\ue000", "\ue001", "\ue002"
#: Signs of runs of letters by their length, of 18 and more the last.
_SIGNS = np.frombuffer(b"aaabbbccccdddddddde", np.uint8)


@functools.lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """1 for letters and marks, 2 for digits, 0 for other characters."""
    out = np.zeros(0x110000, np.uint8)
    for c in (*range(0x3400), *range(0xA000, 0xD7FC), *range(0xF900, 0x20000)):
        k = unicodedata.category(chr(c))
        out[c] = 1 if k[0] in "LM" else 2 if k == "Nd" else 0
    out[0x3400:0xA000] = out[0x20000:0x323B0] = 1
    return out


def _outlines(points: np.ndarray, starts: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(bytes, starts): one sign for each run of letters or digits, and the low byte of each other character."""
    if not len(points):
        return b"", np.zeros(len(starts), np.int64)
    kind = _kinds()[points]
    first = np.ones(len(points), bool)
    first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 0)
    first[starts[:-1][starts[:-1] < len(points)]] = True
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(points)))
    k = kind[at]
    sign = np.where(k == 1, _SIGNS[np.minimum(size, len(_SIGNS) - 1)], np.where(k == 2, 48, points[at] & 0xFF)).astype(np.uint8)
    return sign.tobytes(), np.searchsorted(at, starts)


def _packed(raw: bytes) -> int:
    """Bytes after compression of each block by itself, without the fixed cost of a block."""
    total = 0
    for k in range(0, len(raw), BLOCK):
        packer = zlib.compressobj(6, zlib.DEFLATED, -10, 5)  # the window is one block
        total += len(packer.compress(raw[k : k + BLOCK])) + len(packer.flush()) - 2
    return total


def scripts_of(counts: np.ndarray) -> list[str]:
    """The script class of each text by its counts of each script's letters (the last column: of no script)."""
    total = counts[:, :-1].sum(1)
    share = dict(zip(_CODES, (counts[:, :-1] / np.maximum(total, 1)[:, None]).T, strict=True))
    tests = [total == 0, share["ja"] > 0.1, *(share[k] > 0.3 for k in ("th", "ko", "ar", "hi", "cy")), share["zh"] > 0.25]
    return np.select(tests, ["none", "ja", "th", "ko", "ar", "hi", "cy", "zh"], "la").tolist()


def latin(text: str) -> str:
    """The language of a text in Latin letters by its frequent words; "la" where none has enough of them."""
    words = _WORD.findall(text.lower())
    hits = dict.fromkeys(LATIN, 0)
    for w in words:
        for k in _FREQUENT.get(w, ()):
            hits[k] += 1
    best = max(LATIN, key=lambda k: hits[k])
    return best if hits[best] > FREQUENT_SHARE * len(words) else "la"


def _repeated(text: str) -> float:
    """The share of a short text's words that occur before in it; 0 for fewer than three words."""
    words = _WORD.findall(text.lower())
    return 1 - len(set(words)) / len(words) if len(words) > 2 else 0.0


@functools.lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """Each character's compatibility form, where that is one character."""
    out = np.arange(0x110000, dtype=np.uint32)
    for c in (*range(0xA0, 0x3400), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F253), *range(0x2F800, 0x2FA20)):
        if len(n := unicodedata.normalize("NFKC", chr(c))) == 1:
            out[c] = ord(n)
    return out


def _bytes_of(points: np.ndarray, starts: np.ndarray) -> tuple[bytes, list[int]]:
    """(UTF-8 of all rows, where each begins and the last ends)."""
    data = points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return data, np.concatenate([[0], np.cumsum(width)])[starts].tolist()


def _without_signs(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[int, str]]:
    """(code points, starts, row -> text) with one private character for each link, tag and hashtag; the texts of the rows
    that have any of the characters these are made of."""
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    some = (points == 0x23) | (points == 0x3C)
    some[1:] |= ((points[1:] == 0x2F) & (points[:-1] == 0x2F)) | ((points[1:] == 0x77) & (points[:-1] == 0x77))
    rows = np.unique(row[some])
    texts = {int(k): points[starts[k] : starts[k + 1]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass") for k in rows}
    if not texts:
        return points, starts, texts
    parts = {k: _HASHTAG.sub(_HASHTAG_SIGN, _TAG.sub(_TAG_SIGN, _LINK.sub(_LINK_SIGN, t))) for k, t in texts.items()}
    size = np.diff(starts)
    bare = [np.frombuffer(parts[k].encode("utf-32-le", "surrogatepass"), np.uint32) if k in parts else points[starts[k] : starts[k + 1]] for k in range(len(size))]
    size[list(parts)] = [len(t) for t in parts.values()]
    return np.concatenate(bare), np.concatenate([[0], np.cumsum(size)]), texts


def _marks(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sentence marks of each row, those in a row as one: a full stop only before a blank, a closing mark or the end."""
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    strong = np.isin(points, _STRONG)
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    follows = np.append(np.isin(points[1:], _AFTER_STOP), True) if len(row) else last
    first = strong.copy()
    first[1:] &= ~(strong[:-1] & ~last[:-1])
    return np.bincount(row[first | ((points == 0x2E) & (last | follows))], minlength=len(starts) - 1)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 0):
            part = part.filter(part.column(0).is_valid())
            points, starts = to_code_points(part.column(0))
            points = _fold()[points]
            raw, at = _bytes_of(points, starts)
            bare, begins, texts = _without_signs(points, starts)
            outline, begin = _outlines(bare, begins)
            rows = np.repeat(np.arange(part.num_rows), np.diff(begins))
            width = len(_CODES) + 1
            counts = np.bincount(rows * width + _SCRIPT[bare], minlength=part.num_rows * width).reshape(-1, width)
            marks = _marks(bare, begins)
            private = np.bincount(rows[(bare >= 0xE000) & (bare <= 0xE002)], minlength=part.num_rows)
            n, n_bare = np.diff(starts), np.diff(begins)
            scripts = scripts_of(counts)
            out = []
            for k, script in enumerate(scripts):
                t = texts.get(k)
                if script == "none" and t is not None:  # nothing but links, tags and hashtags: their own letters tell
                    own = _SCRIPT[np.frombuffer(_TAG.sub("", _LINK.sub("", t)).encode("utf-32-le", "surrogatepass"), np.uint32)]
                    script = scripts_of(np.bincount(own, minlength=width)[None, :])[0]
                size = int(n[k])
                own_text = lambda k=k: bare[begins[k] : begins[k + 1]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                tongue = latin(own_text()) if script == "la" else script
                n_signs = int(private[k]) if t is not None else 0
                signs = (size - int(n_bare[k]) + n_signs) / max(1, size)
                if size < LEAST_CHARS:
                    out.append((tongue, script, size, 0, None, None, float(marks[k] > 0), n_signs, signs, _repeated(own_text())))
                    continue
                data = raw[at[k] : at[k + 1]]
                text_class = min(len(data).bit_length() - 1, 10)
                out.append((tongue, script, size, text_class, _packed(data) / len(data), max(0, _packed(outline[begin[k] : begin[k + 1]])) / size, int(marks[k]) / size, n_signs, signs, None))
            cols = [*zip(*out, strict=True)] if out else [[]] * 10
            kinds_of = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *(pa.array(c, t) for c, t in zip(cols, kinds_of, strict=True))], names=["id", "hash", "language", "script", "n", "size", "packed", "outline", "marks", "n_signs", "sign_share", "repeated"])


def redundancy(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, language, n, text_rate, outline_rate, marks_rate, depth, n_signs, sign_share, repeated) of every text that isn't null.

    Rates are against the median of the texts' class of language and length (one block and more is one class), blended with
    the median of the language and of its script by the numbers of texts; ``depth`` counts how far the text's rate is below
    the median, in the script's spreads. Medians and quartiles are over one row for each different text, so that copies of a
    page don't move them. ``n_signs`` links, tags and hashtags hold ``sign_share`` of the characters. A text of fewer than
    LEAST_CHARS characters has null rates; only there ``repeated`` is the share of words that stand before in it, 0 with a
    sentence mark.
    """
    own = F.col(text).cast("string")
    m = cut(df.select(own.alias("_t"), F.col(key).cast("string").alias("id"), F.xxhash64(own).alias("hash")).mapInArrow(_measure, "id string, hash bigint, language string, script string, n bigint, size int, packed double, outline double, marks double, n_signs int, sign_share double, repeated double"))
    some = m.where("packed is not null").select("hash", "language", "script", "size", "packed", "outline", "marks").dropDuplicates(["hash"])
    # keywords have no frequent words, so what is of no known language is measured by all texts of the script
    some = some.select(F.explode(F.when(F.col("script") == F.col("language"), F.array("language")).otherwise(F.array("language", "script"))).alias("language"), *(c for c in some.columns if c != "language"))
    median = lambda c: F.percentile_approx(c, 0.5, 1000)
    by_class = some.groupBy("language", "size").agg(F.count(F.lit(1)).alias("n_class"), median("packed").alias("p"), median("outline").alias("o"))
    by_language = some.groupBy("script", "language").agg(F.count(F.lit(1)).alias("n_language"), median("packed").alias("lp"), median("outline").alias("lo"), median("marks").alias("lm"))
    by_script = some.groupBy("script").agg(median("packed").alias("sp"), median("outline").alias("so"), median("marks").alias("sm"))
    blend = lambda a, b, n: (F.col(n) * a + BLEND_ROWS * b) / (F.col(n) + BLEND_ROWS)
    tongues = by_language.join(F.broadcast(by_script), "script").select("language", *(blend(F.col(f"l{c}"), F.col(f"s{c}"), "n_language").alias(f"l{c}") for c in "pom"))
    # at most fourteen languages by eleven lengths
    usual = F.broadcast(by_class.join(F.broadcast(tongues), "language").select("language", "size", "lm", *(blend(F.col(c), F.col(f"l{c}"), "n_class").alias(c) for c in "po")))
    rated = m.join(usual, ["language", "size"], "left").select("id", "hash", "language", "script", "n", F.try_divide("packed", "p").alias("text_rate"), F.try_divide("outline", "o").alias("outline_rate"), F.when(F.col("lm") > 0.002, F.col("marks") / F.col("lm")).alias("marks_rate"), "n_signs", "sign_share", F.when(F.col("packed").isNull(), F.col("repeated") * (1 - F.col("marks"))).alias("repeated"))
    middle, upper = (F.percentile_approx("text_rate", q, 1000) for q in (0.5, 0.75))
    spread = rated.select("hash", "script", "text_rate").dropDuplicates(["hash"]).groupBy("script").agg(F.greatest((upper - middle) * QUARTILES, F.lit(LEAST_SPREAD)).alias("spread"))
    return rated.join(F.broadcast(spread), "script", "left").withColumn("depth", (1 - F.col("text_rate")) / F.col("spread")).select("id", "language", "n", "text_rate", "outline_rate", "marks_rate", "depth", "n_signs", "sign_share", "repeated")


def is_stuffed() -> Column:
    """The rule on the rates, and on signs and words where a text is too short for rates or has no script to compare with."""
    confirmed = (F.col("marks_rate") < FEW_MARKS) & (F.least("text_rate", "outline_rate") < REDUNDANT)
    short = (F.col("text_rate").isNull() | (F.col("language") == "none")) & (((F.col("n_signs") > 1) & (F.col("sign_share") >= SIGN_SHARE)) | (F.col("repeated") >= REPEATED_SHARE))
    extreme = F.col("depth") + 1 - F.col("outline_rate") > F.when(F.col("marks_rate").isNull(), EXTREME_UNMARKED).otherwise(EXTREME)
    return F.coalesce(extreme, F.lit(False)) | F.coalesce(confirmed, F.lit(False)) | F.coalesce(short, F.lit(False))
