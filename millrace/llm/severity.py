"""Severity of abusive, hateful or sexual language, sentence by sentence, from human answers.

Texts become streams of letters in their one form (look-alikes, signs between letters, digits for letters and invisible
characters undone), cut into sentences; hashed runs of 2 to 5 letters are the sparse features. A cumulative-link model
shares one weight vector between ordered thresholds: P(grade > j) = sigmoid(w.x - t_j). A text's severity is the
expected grade of its worst sentence. Answers are about whole texts, so that of a text marked abusive the sentence that
the model holds for the worst is taken as the example, again in each round.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.codepoints import slices, to_code_points
from millrace.llm.lookalikes import one_form
from millrace.plans.counting import bucket_sums

#: The model is fitted on at most so many labelled texts, those of the least hash; all of them where there are fewer.
LABELLED_TEXTS = 6_000
#: Runs of letters in fewer different sentences of the sample than this are no features.
LEAST_SENTENCES = 2
#: Features are hashed to so many bits.
BITS = 18
#: Sentences of more letters are also scored in windows of so many letters, a step apart.
LONG, WINDOW, STRIDE = 45, 30, 10
#: Lengths of the runs of letters.
RUNS = (2, 3, 4, 5)
#: Grades: 0 all answers say no, 1 answers differ, 2 one answer says yes, 3 several say yes.
GRADES = 4
#: A text is found from this expected grade on.
FOUND_FROM = 0.4
#: A run of letters is known if a sentence of all texts has it KNOWN_RATE times on average, and if how much more often those
#: marked alone have it is at most this share of what the purest runs reach (the quantile PUREST of runs in two marked ones).
#: Known runs never speak for abuse. A text marked abusive is doubtful, and left out, if
#: models of the other texts give it less than DOUBT_BELOW and more than KNOWN_SHARE of its runs is known. Sentences marked
#: abusive weigh so much more.
KNOWN_RATE, KNOWN_PURITY, PUREST, KNOWN_SHARE, DOUBT_BELOW, POSITIVE_WEIGHT = 1e-4, 0.17, 0.9, 0.7, 0.5, 4.0
FOLDS = 3
#: Of a text marked abusive, a sentence with more than this share of known runs is its worst one only if it leads by so much.
USUAL_SHARE, USUAL_LOSS = 0.9, 3.0
#: Weight of a sentence without any features, as a clean example, against all others together.
EMPTY_WEIGHT = 1.0

# Signs and digits written for letters between Latin letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}
ENDS = "。！？!?;；\n…"
QUOTES = "“”\"「」『』«»《》〈〉"

_N = 0x110000
_LOWER = np.arange(_N, dtype=np.uint32)
for _c in (*range(0x600), *range(0x1E00, 0x2000)):
    _low = chr(_c).lower()
    if len(_low) == 1:
        _LOWER[_c] = ord(_low)
_LEET = np.zeros(_N, np.uint32)
for _a, _b in LEET.items():
    _LEET[ord(_a)] = ord(_b)
#: 0 dropped, 1 letter, 2 quotation mark, 3 digit, 4 end of a sentence
_KIND = np.zeros(_N, np.uint8)


def _kinds() -> np.ndarray:
    if not _KIND[ord("a")]:
        import unicodedata

        for c in (*range(0x3200), *range(0x3400, 0xA000), *range(0xAC00, 0xD7A4), *range(0xF900, 0xFB00), *range(0x20000, 0x2A6E0)):
            k = unicodedata.category(chr(c))
            _KIND[c] = 1 if k[0] in "LM" else 3 if k == "Nd" else 0
        _KIND[[ord(c) for c in QUOTES]] = 2
        _KIND[[ord(c) for c in ENDS]] = 4
    return _KIND


class Streams(NamedTuple):
    #: letters, and the number of the sentence and of the text that each belongs to
    letters: np.ndarray
    sentence: np.ndarray
    #: of each sentence its text
    text: np.ndarray


def streams(points: np.ndarray, starts: np.ndarray) -> Streams:
    """Letters by sentence. Each text has at least one sentence, an empty one if it has no letters."""
    n = len(starts) - 1
    p, at = one_form(points, starts)
    row = np.repeat(np.arange(n), np.diff(at))
    p = _LOWER[p]
    kind = _kinds()[p]
    latin = (p >= 97) & (p <= 122)
    before, after = np.concatenate([[False], latin[:-1]]), np.concatenate([latin[1:], [False]])
    as_letter = (_LEET[p] > 0) & before & after
    p = np.where(as_letter, _LEET[p], p)
    kind = np.where(as_letter, 1, kind)
    blank = np.concatenate([(p[1:] == 32) | (p[1:] == 10), [True]]) if len(p) else np.zeros(0, bool)
    kind = np.where((p == 46) & blank & before, 4, kind)  # a full stop after a letter and before a blank
    end = kind == 4
    first = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
    opens = first | np.concatenate([[False], end[:-1]]) if len(row) else first
    sentence = np.cumsum(opens) - 1
    text = row[opens]
    keep = (kind == 1) | (kind == 2) | (kind == 3)
    letters = np.where(kind == 3, 48, p)[keep]
    sentence = sentence[keep]
    # texts without anything get an empty sentence, for a score of their own
    none = np.setdiff1d(np.arange(n), text)
    return Streams(letters, sentence, np.concatenate([text, none]))


def features(s: Streams) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first letter, bucket) of every run of letters within a sentence."""
    places, buckets = [], []
    h = s.letters.astype(np.uint64)
    with np.errstate(over="ignore"):
        base = h * np.uint64(0x9E3779B97F4A7C15)
        h = base
        for n in range(2, max(RUNS) + 1):
            if len(base) < n:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + base[n - 1 :]
            if n in RUNS:
                at = np.flatnonzero(s.sentence[: len(h)] == s.sentence[n - 1 :])
                mixed = (h[at] ^ (h[at] >> np.uint64(29)) ^ np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)
                places.append(at)
                buckets.append((mixed >> np.uint64(64 - BITS)).astype(np.int32))
    return (np.concatenate(places), np.concatenate(buckets)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int32))


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray

    def logits(self, s: Streams) -> np.ndarray:
        """The score of each sentence: of the whole, or of the highest window of a long one, as sentences run together
        where marks are missing."""
        place, bucket = features(s)
        z = np.bincount(s.sentence[place], self.weights[bucket], minlength=len(s.text))
        total = np.concatenate([[0.0], np.cumsum(np.bincount(place, self.weights[bucket], minlength=len(s.letters)))])
        numbers = np.arange(len(s.text))
        begin, end = (np.searchsorted(s.sentence, numbers, side=side) for side in ("left", "right"))
        long = np.flatnonzero(end - begin > LONG)
        if len(long):
            count = -(-(end[long] - begin[long] - WINDOW) // STRIDE) + 1
            of = np.repeat(long, count)
            nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            a = begin[of] + nth * STRIDE
            np.maximum.at(z, of, total[np.minimum(a + WINDOW, end[of])] - total[a])
        return z


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _fit(rows: np.ndarray, cols: np.ndarray, k: int, grade: np.ndarray, weight: np.ndarray, start: tuple[np.ndarray, np.ndarray] | None, steps: int, l2: float, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cumulative-link regression by full-batch Adam. Ordered thresholds are a first one and positive gaps. Weights of ``known``
    features stay at 0 or below."""
    n = len(grade)
    w, t = start if start is not None else (np.zeros(k), np.array([2.0, -1.0, -1.0]))
    above = grade[:, None] > np.arange(GRADES - 1)
    m = [np.zeros_like(w), np.zeros_like(t)]
    v = [np.zeros_like(w), np.zeros_like(t)]
    total = weight.sum()
    for step in range(1, steps + 1):
        z = np.bincount(rows, w[cols], minlength=n)
        cuts = np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))
        err = (_sigmoid(z[:, None] - cuts) - above) * weight[:, None]
        gw = np.bincount(cols, err.sum(1)[rows], minlength=k) / total + l2 * w
        gc = -err.sum(0) / total
        gt = np.concatenate([[gc.sum()], np.exp(t[1:]) * np.array([gc[j:].sum() for j in range(1, GRADES - 1)])])
        for x, g, a, b, rate in ((w, gw, m[0], v[0], 0.08), (t, gt, m[1], v[1], 0.05)):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            x -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        w[known] = np.minimum(w[known], 0.0)
    return w, t


def _sentence_keys(s: Streams) -> np.ndarray:
    """A number for each sentence, the same for sentences of the same letters."""
    with np.errstate(over="ignore"):
        start = np.searchsorted(s.sentence, np.arange(len(s.text)))
        place = (np.arange(len(s.letters)) - start[s.sentence]).astype(np.uint64) if len(s.letters) else np.zeros(0, np.uint64)
        h = (s.letters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (place * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xBF58476D1CE4E5B9)
        total = np.zeros(len(s.text), np.uint64)
        np.add.at(total, s.sentence, h ^ (h >> np.uint64(31)))
    return np.unique(total, return_inverse=True)[1]


def _worst(z: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether each sentence has the highest score of its text (the first of several)."""
    order = np.lexsort((-z, text))
    out = np.zeros(len(z), bool)
    out[order[np.concatenate([[True], text[order][1:] != text[order][:-1]])]] = True
    return out


def train(texts: list[str], grades: list[int], rates: np.ndarray | None = None, rounds: int = 3, steps: int = 70, l2: float = 3e-5) -> Model:
    """Fits the model to texts with grades; a text of grade above 0 counts by its worst sentence, others by all of theirs.

    ``rates`` are how often a sentence of all texts has a run of each bucket (see run_rates). Answers can be wrong. A text
    marked abusive is left out if models fitted without it find nothing in it and it has hardly anything that isn't usual;
    a clean one is left out once the model is sure of the contrary.
    """
    nothing = Model(np.zeros(1 << BITS), np.array([20.0, 21.0, 22.0]))
    if not texts or not any(grades):
        return nothing
    s = streams(*to_code_points(pa.array(texts, pa.string())))
    place, bucket = features(s)
    row = s.sentence[place]
    del place
    keys = _sentence_keys(s)
    once = np.unique(keys[row] << BITS | bucket) & ((1 << BITS) - 1)
    frequent = np.bincount(once, minlength=1 << BITS) >= LEAST_SENTENCES
    row, bucket = row[frequent[bucket]], bucket[frequent[bucket]]
    used = np.flatnonzero(np.bincount(bucket, minlength=1 << BITS))
    to = np.zeros(1 << BITS, np.int64)
    to[used] = np.arange(len(used))
    col = to[bucket]
    del bucket, once
    if not len(used):
        return nothing
    n = len(s.text)
    grade_of = np.array(grades)[s.text]
    count = np.bincount(s.text, minlength=len(texts))[s.text]
    positive = grade_of > 0
    negative = ~positive
    alone = positive & (count == 1)
    if not alone.any():
        alone = positive
    per = lambda mask: np.bincount(col[mask[row]], minlength=len(used)) / max(1, mask.sum())
    usual = np.maximum(rates[used], per(negative)) if rates is not None else per(np.ones(n, bool))
    purity = per(alone) / np.maximum(usual, 1e-12)
    often = (np.bincount(col[alone[row]], minlength=len(used)) > 1) & (usual >= KNOWN_RATE)
    is_known = (usual >= KNOWN_RATE) & (purity <= KNOWN_PURITY * (np.quantile(purity[often], PUREST) if often.any() else 0.0))
    known = np.bincount(row, is_known[col].astype(float), minlength=n) / np.maximum(np.bincount(row, minlength=n), 1)
    weight = np.where(positive, POSITIVE_WEIGHT, 1.0 / np.sqrt(count))

    def fit(pick: np.ndarray, state: tuple[np.ndarray, np.ndarray] | None, k: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
        at, mine = np.cumsum(pick) - 1, pick[row]
        w = weight[pick]  # a sentence without features is one more clean example
        state = _fit(at[row[mine]], col[mine], len(used), np.append(grade_of[pick], 0), np.append(w, EMPTY_WEIGHT * w.sum()), state, k, l2, is_known)
        return state, np.bincount(row, state[0][col], minlength=n)

    # scores from the other folds; a text and its copies are in one fold
    text_key = np.zeros(len(texts), np.int64)
    np.add.at(text_key, s.text, keys * 2_654_435_761 % 1_000_003)
    fold = (text_key % FOLDS)[s.text]
    doubtful = np.zeros(n, bool)
    for f in range(FOLDS):
        pick = np.where(positive, alone, negative) & (fold != f)
        if (pick & positive).any():
            state, z = fit(pick, None, steps)
            doubtful |= (fold == f) & positive & _worst(z, s.text) & (_sigmoid(z - state[1][0]) < DOUBT_BELOW) & (known > KNOWN_SHARE)
    out = np.zeros(len(texts), bool)
    out[s.text[doubtful]] = True
    doubtful = out[s.text]
    if not (positive & ~doubtful).any():
        doubtful[:] = False
    pick = np.where(positive, alone & ~doubtful, negative)
    if not (pick & positive).any():
        pick = np.where(positive, ~doubtful, negative)
    state, z = fit(pick, None, 2 * steps)
    for _ in range(rounds - 1):
        pick = np.where(positive, _worst(z - USUAL_LOSS * (known > USUAL_SHARE), s.text) & ~doubtful, negative & (_sigmoid(z - state[1][0]) < 0.8))
        state, z = fit(pick, state, steps)
    weights = np.zeros(1 << BITS)
    weights[used] = state[0]
    return Model(weights, np.cumsum(np.concatenate([state[1][:1], np.exp(state[1][1:])])))


def _least_hash(df: DataFrame, rows: int, most: int, *key: str) -> DataFrame:
    """The ``most`` rows of least hash of ``key``, out of about ``rows``. Rows whose hash is far above leave in their own
    task, so that the tasks together send about twice as many as are wanted, whatever the number of tasks."""
    h = F.pmod(F.xxhash64(*key), F.lit(1 << 40))
    near = df.where(h < int(min(1.0, 2.0 * most / max(1, rows) + 0.0005) * (1 << 40))) if rows > most else df
    return near.orderBy(h, *key).limit(most)


def labelled(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, grade) of the texts with answers, at most LABELLED_TEXTS, those of the least hash.

    ``texts`` has tab, id, text; answers that are null don't count, texts that are null have no grade. Twice as many
    answered texts are looked up, so that null texts leave enough of the others.
    """
    votes = labels.where("abusive is not null").groupBy("tab", F.col("source_id").alias("id")).agg(F.sum("abusive").alias("yes"), F.count(F.lit(1)).alias("n"))
    grade = F.when(F.col("yes") == 0, 0).when(F.col("yes") < F.col("n"), 1).when(F.col("n") == 1, 2).otherwise(3)
    some = _least_hash(votes.select("tab", "id", grade.alias("grade")), votes.count(), 2 * LABELLED_TEXTS, "tab", "id")
    found = texts.where("text is not null").join(F.broadcast(some), ["tab", "id"]).select("tab", "id", "text", "grade")
    return found.orderBy(F.xxhash64("tab", "id"), "tab", "id").limit(LABELLED_TEXTS).select("text", "grade")


def run_rates(texts: DataFrame) -> np.ndarray:
    """How often a sentence of all texts has a run of letters of each bucket, on average."""

    def buckets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in slices(batch, 0, 1 << 20):
            s = streams(*to_code_points(part.column(0)))
            yield features(s)[1]
            yield np.full(len(s.text), 1 << BITS)  # the last bucket counts the sentences

    got = bucket_sums(texts.where("text is not null").select("text"), buckets, (1 << BITS) + 1)
    return got[:-1] / max(1, got[-1])


def scored(texts: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, severity (expected grade of the worst sentence, 0 to 3) and found, of every row of ``texts``.

    Null texts have severity null and are not found; empty texts have the severity of an empty sentence. Without any
    answer, no text is found. The model is fitted on the answered texts; what is usual is counted over all texts.
    """
    rows = sorted(((r.text, r.grade) for r in labelled(texts, labels).collect()), key=lambda r: (r[0], r[1]))  # at most LABELLED_TEXTS
    model = train([t for t, _ in rows], [g for _, g in rows], run_rates(texts) if any(g for _, g in rows) else None)
    used = np.flatnonzero(model.weights)
    shared = texts.sparkSession.sparkContext.broadcast((used.astype(np.int32), model.weights[used].astype(np.float32), model.thresholds))
    schema = ", ".join([*(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep), "severity double, found boolean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, cuts = shared.value
        weights = np.zeros(1 << BITS)
        weights[at] = values
        m = Model(weights, cuts)
        for batch in batches:
            for part in slices(batch, 0, 1 << 20):
                s = streams(*to_code_points(part.column(0)))
                worst = np.full(part.num_rows, -np.inf)
                np.maximum.at(worst, s.text, m.logits(s))
                p = _sigmoid(worst[:, None] - cuts)
                null = np.asarray(part.column(0).is_null())
                found = (p.sum(1) >= FOUND_FROM) & ~null
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(p.sum(1), pa.float64(), mask=null), pa.array(found)], names=[*keep, "severity", "found"])

    return texts.select(F.col("text"), *keep).mapInArrow(run, schema)


def rate() -> Column:
    """Share of the texts that are found, null texts aside."""
    return F.try_divide(F.count_if("found"), F.count("severity"))
