"""Encoding of texts with a public byte-level BPE vocabulary, by recursive queries of DuckDB in each partition.

A batch's distinct words (pieces of the vocabulary's pattern) that haven't been seen by this worker are cut where no
token of the vocabulary can span two characters; such atoms are encoded independently of what stands beside them, so
that the recursion works on a few short atoms and not on running text. In DuckDB, rows of token positions join the
merge table; each round contracts, in every atom at once, the pair of least rank (leftmost first where occurrences
overlap), until no pair is left; an ordered aggregation gives the ids. Atoms of more than a window's bytes, as one long
word, are encoded in overlapping windows that are joined where both have the same token at the same place. All texts are then put together from the words'
ids with numpy gathers.
"""

from __future__ import annotations

import base64
import functools
import itertools
import os
from collections.abc import Iterator
from importlib.util import find_spec

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.codepoints import slices

#: Folder of the public vocabularies: a parameter, else the environment's MILLRACE_TOKENIZERS, else where they are installed.
TOKENIZERS = "/opt/tokenizers"
#: A worker keeps the ids of so many words and atoms; then it forgets them and starts again.
KEEP_WORDS, KEEP_ATOMS = 300_000, 200_000
#: And whether tokens can span two characters, of so many pairs of characters; others are worked out again.
KEEP_PAIRS = 200_000
#: Bytes of the window in which a long atom is encoded, half a window apart; windows widen up to the whole atom.
WINDOW, WIDEST = 64, 16_384
#: Bytes of atoms in one call of DuckDB, or one atom.
CALL_BYTES = 1 << 18
#: Fixed value: the pattern that parts a text into words before byte-level merging.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def vocabulary_path(name: str, folder: str | None = None) -> str:
    for at in (folder, os.environ.get("MILLRACE_TOKENIZERS"), TOKENIZERS):
        if at and os.path.exists(f"{at}/{name}.tiktoken"):
            return f"{at}/{name}.tiktoken"
    spec = find_spec("public_tokenizers")
    if spec is None:
        raise FileNotFoundError(f"no vocabulary {name}")
    return os.path.join(os.path.dirname(spec.origin), f"{name}.tiktoken")


class Encoder:
    """Word -> ids, with what has been encoded kept in two bounded dictionaries."""

    def __init__(self, path: str):
        import duckdb

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        left, right, new = [], [], []
        self.spans: set[tuple[bytes, bytes]] = set()  # what stands on both sides of a character boundary inside a token
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    new.append(rank)
                if token[k] & 0xC0 != 0x80:
                    j = k - 1
                    while j > 0 and token[j] & 0xC0 == 0x80:
                        j -= 1
                    e = k + 1
                    while e < len(token) and token[e] & 0xC0 == 0x80:
                        e += 1
                    self.spans.add((token[j:k], token[k:e]))
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        self.length[list(ranks.values())] = [len(t) for t in ranks]
        # calls are small, so nothing is ever written to a disk
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})
        self.db.register("m", pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "rank": pa.array(new, pa.int32())}))
        self.db.execute("CREATE TABLE merges AS SELECT l, r, min(rank) AS rank FROM m GROUP BY l, r")
        self.db.unregister("m")
        self.cuts: dict[str, bool] = {}
        self.atoms: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.pool, self.sizes = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)  # grown by doubling
        self.starts = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _cut(self, pair: str) -> bool:
        """Whether no token can hold the end of the first of two characters with the beginning of the second."""
        got = self.cuts.get(pair)
        if got is None:
            a, b = (c.encode("utf-8", "surrogatepass") for c in pair)
            got = not any((a[i:], b[:j]) in self.spans for i in range(len(a)) for j in range(1, len(b) + 1))
            if len(self.cuts) < KEEP_PAIRS:
                self.cuts[pair] = got
        return got

    def _parts(self, words: list[str]) -> list[list[str]]:
        """The atoms of each word: words of ASCII are one, others are cut wherever no token can span. Whether it can is asked
        once for each different pair of characters of all the words."""
        out = [[w] for w in words]
        wide = [k for k, w in enumerate(words) if len(w) > 1 and not w.isascii()]
        if not wide:
            return out
        joined = "".join(words[k] for k in wide)
        size = np.array([len(words[k]) for k in wide])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.cumsum(size)
        pairs, of = np.unique(points[:-1] << 21 | points[1:], return_inverse=True)
        cut = np.fromiter((self._cut(chr(p >> 21) + chr(p & 0x1FFFFF)) for p in pairs.tolist()), bool, len(pairs))[of]
        cut[ends[:-1] - 1] = True  # between words
        places = [0, *(np.flatnonzero(cut) + 1).tolist(), len(joined)]
        atoms = [joined[a:b] for a, b in itertools.pairwise(places)]
        last = np.searchsorted(places, ends).tolist()
        for k, a, b in zip(wide, [0, *last], last, strict=False):
            out[k] = atoms[a:b]
        return out

    def _contract(self, raw: list[bytes]) -> list[list[int]]:
        """The ids of each of these pieces, in calls of a bounded number of bytes, pieces of like length together."""
        out: list[list[int]] = [[]] * len(raw)
        order = sorted(range(len(raw)), key=lambda k: len(raw[k]))
        begin = 0
        while begin < len(order):
            end, size = begin, 0
            while end < len(order) and (end == begin or size + len(raw[order[end]]) <= CALL_BYTES):
                size += len(raw[order[end]])
                end += 1
            for k, ids in self._call([raw[i] for i in order[begin:end]]):
                out[order[begin + k]] = ids
            begin = end
        return out

    def _call(self, raw: list[bytes]) -> list[tuple[int, list[int]]]:
        sizes = np.array([len(r) for r in raw], np.int64)
        w = np.repeat(np.arange(len(raw), dtype=np.int32), sizes)
        pos = np.arange(len(w), dtype=np.int32) - np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes).astype(np.int32)
        self.db.register("start", pa.table({"w": w, "pos": pos, "tok": self.byte[np.frombuffer(b"".join(raw), np.uint8)]}))
        got = self.db.execute(_CONTRACT).fetchall()
        self.db.unregister("start")
        return got

    def _encode_atoms(self, new: list[str]) -> None:
        """Encodes atoms; long ones by overlapping windows, in wider ones where two neighbours share no token."""
        raw = [a.encode("utf-8", "surrogatepass") for a in new]
        done: list[list[int] | None] = [None] * len(raw)
        width: float = WINDOW
        while todo := [k for k, ids in enumerate(done) if ids is None]:
            windows = {k: [raw[k]] if len(raw[k]) <= width else [raw[k][a : a + int(width)] for a in range(0, len(raw[k]) - int(width) // 2, int(width) // 2)] for k in todo}
            pieces = list(dict.fromkeys(w for ws in windows.values() for w in ws))
            ids = dict(zip(pieces, self._contract(pieces), strict=True))
            for k, ws in windows.items():
                done[k] = ids[ws[0]] if len(ws) == 1 else self._joined([ids[w] for w in ws], int(width) // 2)
            width = width * 4 if width * 4 < WIDEST else float("inf")
        self.atoms.update(zip(new, done, strict=True))

    def _joined(self, windows: list[list[int]], step: int) -> list[int] | None:
        """The ids of a piece from those of its windows, each ``step`` bytes after the one before; None where two windows
        have no token in common at one place.

        Ids are those of the whole piece if and only if each two that stand side by side are the ids of their own bytes
        together. Side by side here stand only such as do in one of the windows.
        """
        size = self.length
        out, at = list(windows[0]), np.concatenate([[0], np.cumsum(size[windows[0]])]).tolist()
        for n, more in enumerate(windows[1:], 1):
            begin = (np.concatenate([[0], np.cumsum(size[more])]) + n * step).tolist()
            here = {(a, t): j for j, (a, t) in enumerate(zip(begin, more, strict=False))}
            k = len(out) - 1
            while k >= 0 and at[k] >= n * step and (at[k], out[k]) not in here:
                k -= 1
            if k < 0 or at[k] < n * step:
                return None
            j = here[at[k], out[k]]
            out[k:], at[k:] = more[j:], begin[j:]
        return out

    def add(self, words: set[str]) -> None:
        """Encodes words that aren't known yet."""
        if len(self.atoms) > KEEP_ATOMS:
            self.atoms.clear()
        order = list(words)
        parts = dict(zip(order, self._parts(order), strict=True))
        if new := list({a for p in parts.values() for a in p if a not in self.atoms}):
            self._encode_atoms(new)
        atoms, k = self.atoms, len(self.words)
        ids = [[i for a in p for i in atoms[a]] if len(p) > 1 else atoms[p[0]] for p in parts.values()]
        self.words.update(zip(parts, range(k, k + len(parts)), strict=True))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum()))
        while len(self.pool) < self.used + len(flat):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.sizes) < k + len(ids):
            self.sizes, self.starts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.sizes, self.starts))
        self.pool[self.used : self.used + len(flat)] = flat
        self.sizes[k : k + len(ids)] = sizes
        self.starts[k : k + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of these texts: row k has ids[starts[k]:starts[k + 1]]."""
        if len(self.words) > KEEP_WORDS:
            self._forget()
        find = WORDS.findall
        found = [find(t) if t else [] for t in texts]
        flat = [w for f in found for w in f]
        if new := set(flat).difference(self.words):
            self.add(new)
        index = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        sizes = self.sizes[index]
        out = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(self.starts[index] - out[:-1], sizes) + np.arange(out[-1])]
        starts = out[np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)]
        return ids, starts


#: One round: every live atom's pairs look up their rank; of the atom's least rank, every occurrence is contracted, of a
#: run of overlapping ones each second. Atoms without a pair leave as done.
_CONTRACT = """
WITH RECURSIVE step AS (
  SELECT w, pos, tok, false AS done FROM start
  UNION ALL
  SELECT w, pos, CASE WHEN hit THEN least_rank ELSE tok END, least_rank IS NULL
  FROM (
    SELECT *, coalesce(lag(hit) OVER (PARTITION BY w ORDER BY pos), false) AS gone
    FROM (
      SELECT *, same AND (row_number() OVER (PARTITION BY w, same, n - k ORDER BY pos)) % 2 = 1 AS hit
      FROM (
        SELECT *, row_number() OVER (PARTITION BY w, same ORDER BY pos) AS k
        FROM (
          SELECT *, coalesce(rank = least_rank, false) AS same
          FROM (
            SELECT p.*, g.rank, min(g.rank) OVER (PARTITION BY p.w) AS least_rank
            FROM (SELECT w, pos, tok, lead(tok) OVER a AS nxt, row_number() OVER a AS n FROM step WHERE NOT done WINDOW a AS (PARTITION BY w ORDER BY pos)) p
            LEFT JOIN merges g ON g.l = p.tok AND g.r = p.nxt
          )
        )
      )
    )
  )
  WHERE NOT gone
)
SELECT w, list(tok ORDER BY pos) FROM step WHERE done GROUP BY w
"""


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder; it stays while the worker is used again."""
    return Encoder(path)


def token_ids(df: DataFrame, key: str, text: str, name: str = "byte_bpe_50k", folder: str | None = None, counts: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, ids) of every row, without special tokens; with ``counts`` (key, n_tokens) instead.

    A null or empty text gives an empty list (0). The text is taken as it is. Repeated keys give repeated rows.
    """
    cols = [key, *keep]
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in cols), "n_tokens bigint" if counts else "ids array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary_path(name, folder))  # where the task runs
        for batch in batches:
            for part in slices(batch, 0, 2 << 20):
                ids, starts = enc.encode(part.column(0).to_pylist())
                if counts:
                    got: pa.Array = pa.array(np.diff(starts), pa.int64())
                else:
                    got = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], got], names=[*cols, "n_tokens" if counts else "ids"])

    return df.select(F.col(text).cast("string").alias("_text"), *cols).mapInArrow(run, schema)
