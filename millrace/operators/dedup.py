"""Copies and near copies of texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.counting import bucket_fold
from millrace.plans.lineage import cut, small, written

#: Near copies: Jaccard of the grams at least, or containment in the larger text at least.
JACCARD, CONTAINMENT = 0.84, 0.94
#: Rare grams that two texts must share before their whole sets are compared.
MEETINGS = 6
#: Buckets of the counts of grams, and bits for the grams looked up, that broadcast arrays hold; powers of 2.
BUCKETS, MARKS = 1 << 21, 1 << 26
#: Characters of a batch that meet in one task; a larger batch is parted into blocks, each two of which meet in a task.
BLOCK_CHARS = 1 << 26
#: Grams' meetings that a task counts together.
MEETINGS_AT_ONCE = 1 << 22
#: Ids that are broadcast, as counted, where texts are picked by them; more are joined by a shuffle of the texts.
BROADCAST_IDS = 300_000
#: Texts are worked on together up to so many characters.
SLICE_CHARS = 1 << 20


def digest(c: Column) -> Column:
    """128 bits of the SHA-256 of a normalised text, in hexadecimal; '' for a text without letters and for null."""
    return F.when(F.coalesce(c, F.lit("")) == "", "").otherwise(F.substring(F.sha2(c, 256), 1, 32))


def collapse_copies(df: DataFrame, keys: list[str], order: list[Column], id_col: str = "id") -> DataFrame:
    """(keys, representative, n_copies): one row for each group of rows equal in ``keys``; the representative is greatest in
    ``order``, then in id. Rows with an empty last key are left out. Combined before the shuffle, so that a group of any
    size sends one row from each task; with digests of texts as keys no text is shuffled."""
    return df.where(F.col(keys[-1]) != "").groupBy(*keys).agg(F.max_by(id_col, F.struct(*order, F.col(id_col))).alias("representative"), F.count(F.lit(1)).alias("n_copies"))


def copy_families(df: DataFrame, same: DataFrame | None = None, independent: DataFrame | None = None) -> DataFrame:
    """(id, family): the least id of the row's copy family.

    ``df`` has id, fingerprint. Rows of one fingerprint are a family, except those that are reviewed as independent of the
    family's first row; pairs reviewed as the same join families. ``same`` and ``independent`` have left_id, right_id.
    A fingerprint's first row is found by its digest, combined before the shuffle; rows with an empty or null one take no
    part. Components are found by rounds of least labels; each round is written to the shared folder.
    """
    rows = df.select("id", digest(F.col("fingerprint")).alias("_d"))
    first = rows.where("_d != ''").groupBy("_d").agg(F.min("id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_d", "_first")
    label = rows.join(first, "_d", "left").select("id", F.coalesce("_first", "id").alias("family"))
    if independent is not None:
        apart = independent.select(F.least("left_id", "right_id").alias("_a"), F.greatest("left_id", "right_id").alias("_b")).distinct()
        label = label.join(apart, (F.col("family") == F.col("_a")) & (F.col("id") == F.col("_b")), "left").select("id", F.when(F.col("_a").isNull(), F.col("family")).otherwise(F.col("id")).alias("family"))
    if same is None:
        return label
    label = cut(label)
    edges = same.select("left_id", "right_id").unionByName(same.select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id")))
    while True:
        ends = edges.join(label.withColumnsRenamed({"id": "left_id", "family": "lf"}), "left_id").join(label.withColumnsRenamed({"id": "right_id", "family": "rf"}), "right_id")
        better = ends.where("rf < lf").groupBy("lf").agg(F.min("rf").alias("to"))
        better = cut(better)
        if not better.limit(1).count():
            return label
        label = cut(label.join(better, label.family == better.lf, "left").select("id", F.coalesce("to", "family").alias("family")))


def _gram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """(text number, code) of the sets of runs of three characters of these texts, ordered, and the letters: a code is the
    numbers of its letters in them, of as many bits each as their count has; without letters it is the gram itself."""
    p = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    if len(p) < 3:
        return row[:0], row[:0], None
    ok = row[:-2] == row[2:]
    there = np.zeros(0x110000, bool)
    there[p] = True
    letters = np.flatnonzero(there)
    w = len(letters).bit_length()
    if 3 * w + len(texts).bit_length() > 63:
        p = p.astype(np.int64)
        row, g = row[:-2][ok], (p[:-2] << 42 | p[1:-1] << 21 | p[2:])[ok]
        order = np.lexsort((g, row))
        row, g = row[order], g[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
        return row[new], g[new], None
    # text and letters by their numbers in one integer
    c = (np.cumsum(there) - 1)[p]
    x = ((row[:-2] << w | c[:-2]) << 2 * w | c[1:-1] << w | c[2:])[ok]
    x.sort()
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    x = x[new]
    return x >> 3 * w, x & (1 << 3 * w) - 1, letters


def _gram_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, gram) of the sets of runs of three characters of these texts, ordered; a gram is its three code points."""
    row, code, letters = _gram_codes(texts)
    if letters is None:
        return row, code
    w = len(letters).bit_length()
    of = lambda k: letters[code >> k * w & (1 << w) - 1]
    return row, of(2) << 42 | of(1) << 21 | of(0)


def _keys(group: list[str | None], row: np.ndarray, g: np.ndarray) -> np.ndarray:
    """A number for each (group, gram). Two of one number only make more candidates."""
    known: dict[str | None, int] = {}
    of = np.array([known[b] if b in known else known.setdefault(b, zlib.crc32((b or "\0").encode())) for b in group], np.uint64)
    with np.errstate(over="ignore"):
        h = (g.astype(np.uint64) ^ (of[row] * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def _slices(batch: pa.RecordBatch, *columns: int) -> Iterator[tuple]:
    """The batch in slices of about SLICE_CHARS characters of its text columns, with the texts of each; '' for null."""
    texts = [[t or "" for t in batch.column(c).to_pylist()] for c in columns]
    ends = np.cumsum(np.sum([[len(t) for t in x] for x in texts], axis=0))
    k = 0
    while k < len(ends):
        end = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + SLICE_CHARS, side="right")))
        yield batch.slice(k, end - k), *(x[k:end] for x in texts)
        k = end


def _lists(row: np.ndarray, values: pa.Array, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)), values)


def with_grams(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and grams, the set of a normalised text's runs of three characters as numbers, ordered."""
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "grams array<bigint>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in _slices(batch, 0):
                row, g = _gram_sets(texts)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], _lists(row, pa.array(g), part.num_rows)], names=[*keep, "grams"])

    return df.select(F.col(text).alias("_text"), *keep).mapInArrow(run, schema)


def _rarity(df: DataFrame) -> np.ndarray:
    """About how many texts hold a gram, by BUCKETS buckets of keys; never fewer than do."""

    def fill(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for part, texts in _slices(batch, 1):
            row, g = _gram_sets(texts)
            total += np.bincount(_keys(part.column(0).to_pylist(), row, g) & (BUCKETS - 1), minlength=BUCKETS)

    return np.minimum(bucket_fold(df.select("batch", "norm"), fill, BUCKETS, "int64", np.add), (1 << 31) - 1).astype(np.int32)


def _least(c: float, n: np.ndarray) -> np.ndarray:
    return np.ceil(c * n - 1e-9).astype(np.int64)


def _probes(rarity: np.ndarray, group: list[str | None], texts: list[str], share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(grams of each text; text number, key, whether it is looked up, of the grams that other texts may have)."""
    row, g = _gram_sets(texts)
    key = _keys(group, row, g)
    count = rarity[key & (BUCKETS - 1)]
    n = np.bincount(row, minlength=len(texts))
    some = count > 1  # a gram of one text only can't meet another
    row, key, count = row[some], key[some], count[some]
    own = np.bincount(row, minlength=len(texts))
    must = _least(share, n)
    most = n - must + np.minimum(MEETINGS, must) - (n - own)
    probe = np.zeros(len(row), bool)
    if not len(row):
        return n, row, key, probe
    # only the rarest quarter of all is put in order, of a text that has enough of it
    rare = count <= np.partition(count, len(row) // 4)[len(row) // 4]
    some = np.flatnonzero(rare | (np.bincount(row[rare], minlength=len(texts)) < most)[row])
    low, at = row[some], len(row).bit_length()
    order = np.sort(low << 63 - len(texts).bit_length() | np.minimum(count[some].astype(np.int64), (1 << 63 - len(texts).bit_length() - at) - 1) << at | some) & ((1 << at) - 1)
    own = np.bincount(low, minlength=len(texts))
    probe[order] = np.arange(len(low)) - (np.cumsum(own) - own)[low] < most[low]
    return n, row, key, probe


def _bytes(x: np.ndarray, kind: type) -> bytes:
    return x.astype(kind).tobytes()


def _packed(df: DataFrame, shared, marked, share: float, units: int, blocks: dict[str, int]) -> DataFrame:
    """(unit, one, two, side, ids, n, probes, others, keys): texts that may meet, by the unit of work in which they do.

    ``n``, ``probes`` and ``others`` are a number for each text; ``keys`` has each text's grams looked up and then those
    that other texts look up, 32 bits each. A batch of ``blocks`` goes to a unit for each two blocks, the other batches
    share ``units``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, marks = shared.value, np.unpackbits(marked.value).view(bool)
        for batch in batches:
            for part, texts in _slices(batch, 2):
                ids, group = part.column(0).to_pylist(), part.column(1).to_pylist()
                places = [(b, zlib.crc32(str(i).encode()) % blocks[b]) if b in blocks else ("", zlib.crc32(b.encode()) % units) for i, b in zip(ids, group, strict=True)]
                order = sorted(range(len(texts)), key=places.__getitem__)
                n, row, key, probe = _probes(rarity, [group[k] for k in order], [texts[k] for k in order], share)
                some = marks[key & (MARKS - 1)]
                row, key, probe = row[some], key[some] >> 32 & 0xFFFFFFFF, probe[some]
                first = np.lexsort((~probe, row)) if len(row) else row
                key = key[first]
                probes, held = np.bincount(row[probe], minlength=len(texts)), np.bincount(row, minlength=len(texts))
                ends = np.cumsum(held)
                out: dict[str, list] = {x: [] for x in ("unit", "one", "two", "side", "ids", "n", "probes", "others", "keys")}
                k = 0
                while k < len(order):
                    here = places[order[k]]
                    end = next((m for m in range(k + 1, len(order)) if places[order[m]] != here), len(order))
                    own = k + np.flatnonzero(held[k:end])
                    values = [ids[order[m]] for m in own], _bytes(n[own], np.int32), _bytes(probes[own], np.int32), _bytes((held - probes)[own], np.int32), _bytes(key[ends[k] - held[k] : ends[end - 1]], np.uint32)
                    b, at = here
                    for other in range(blocks.get(b, 0)) if b in blocks else (None,):
                        for name, v in zip(out, (b, *((at, at, 0) if other is None else (min(at, other), max(at, other), int(at > other))), *values), strict=True):
                            if len(own):
                                out[name].append(v)
                    k = end
                yield pa.RecordBatch.from_arrays([pa.array(out["unit"], pa.string()), *(pa.array(out[x], pa.int32()) for x in ("one", "two", "side")), pa.array(out["ids"], pa.list_(part.column(0).type)), *(pa.array(out[x], pa.binary()) for x in ("n", "probes", "others", "keys"))], names=list(out))

    kind = df.schema["id"].dataType.simpleString()
    return df.select("id", "batch", "norm").mapInArrow(run, f"unit string, one int, two int, side int, ids array<{kind}>, n binary, probes binary, others binary, keys binary")


def _shared(keys: np.ndarray, held: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many keys the texts ``x`` and ``y`` of each pair share; ``keys`` are those of all texts in turn, ``held`` their numbers."""
    start, work = np.cumsum(held) - held, np.cumsum(held[x] + held[y])
    out, k = np.zeros(len(x), np.int64), 0
    while k < len(x):
        end = max(k + 1, int(np.searchsorted(work, (work[k - 1] if k else 0) + MEETINGS_AT_ONCE, side="right")))
        both = []
        for side in (x[k:end], y[k:end]):
            h = held[side]
            both.append(np.repeat(np.arange(end - k), h) << 32 | keys[np.arange(h.sum()) - np.repeat(np.cumsum(h) - h - start[side], h)])
        of = np.sort(np.concatenate(both))
        out[k:end] = np.bincount(of[1:][of[1:] == of[:-1]] >> 32, minlength=end - k)
        k = end
    return out


def _met(table: pa.Table, jaccard: float, containment: float, share: float) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids of the pairs of texts of a unit that meet as often as near copies do, and of whose grams here, those that any
    text looks up, the first text has no more that the second lacks than a near copy may."""
    whole = lambda c, kind: np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(c)])
    ids = pa.concat_arrays([x.flatten() for x in table.column("ids").chunks])
    n, probes, others = (whole(c, np.int32).astype(np.int64) for c in ("n", "probes", "others"))
    side = np.repeat(table.column("side").to_numpy(), [len(x) for x in table.column("ids")])
    apart = table.column("one")[0].as_py() != table.column("two")[0].as_py()
    # texts by their numbers of grams: of two, the first is contained in the second or alike to it
    order = np.argsort(n, kind="stable")
    number = np.empty(len(n), np.int64)
    number[order] = np.arange(len(n))
    text = np.repeat(number, probes + others)
    probe = np.arange(len(text)) - np.repeat(np.cumsum(probes + others) - probes - others, probes + others) < np.repeat(probes, probes + others)
    keys = whole("keys", np.uint32)
    every = keys.astype(np.uint64) << np.uint64(32) | text.astype(np.uint64)
    keys = np.sort(text << 32 | keys) & 0xFFFFFFFF  # by text
    held = np.bincount(text, minlength=len(n))
    wanted = np.sort(every[probe])
    every = np.sort(every)
    low = np.searchsorted(every, wanted, side="right")
    high = np.searchsorted(every, wanted | np.uint64(0xFFFFFFFF), side="right")
    a = (wanted & np.uint64(0xFFFFFFFF)).astype(np.int64)
    some = np.flatnonzero(high > low)
    some = some[np.argsort(a[some], kind="stable")]
    a, low, high = a[some], low[some], high[some]
    every = (every & np.uint64(0xFFFFFFFF)).astype(np.int64)
    n, side = n[order], side[order]
    starts = np.flatnonzero(np.diff(a, prepend=-1))  # of each text's grams looked up
    upto = np.concatenate([[0], np.cumsum(high - low)])
    k = 0
    while k < len(starts):
        end = max(k + 1, int(np.searchsorted(upto[starts], upto[starts[k]] + MEETINGS_AT_ONCE, side="right")) - 1)
        i, j = starts[k], starts[end] if end < len(starts) else len(a)
        times = high[i:j] - low[i:j]
        b = every[np.arange(upto[i], upto[j]) - np.repeat(upto[i:j] - low[i:j], times)]
        pair = np.sort(np.repeat(a[i:j], times) << 32 | b)
        new = np.flatnonzero(np.diff(pair, prepend=-1))
        x, y = pair[new] >> 32, pair[new] & 0xFFFFFFFF
        must = _least(share, n[x])
        both = np.minimum(_least(containment, n[x]), _least(jaccard / (1 + jaccard), n[x] + n[y]))
        near = np.diff(new, append=len(pair)) >= np.maximum(np.minimum(MEETINGS, must) + both - must, 1)
        if apart:
            near &= side[x] != side[y]
        x, y, both = x[near], y[near], both[near]
        near = _shared(keys, held, x, y) >= held[x] - (n[x] - both)
        yield ids.take(pa.array(order[x[near]])), ids.take(pa.array(order[y[near]]))
        k = end


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """batch, left_id, right_id, and n_common, n_left, n_right from the texts left, right."""
    for batch in batches:
        for part, left, right in _slices(batch, 3, 4):
            m = len(left)
            row, code, letters = _gram_codes(left + right)
            n = np.bincount(row, minlength=2 * m)
            if letters is None:
                code = np.unique(code, return_inverse=True)[1]
            bits = int(code.max(initial=0)).bit_length()
            of = np.sort(row % m << bits | code)  # twice where both texts have it
            both = np.bincount(of[1:][of[1:] == of[:-1]] >> bits, minlength=m)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], *(pa.array(x.astype(np.int32)) for x in (both, n[:m], n[m:]))], names=["batch", "left_id", "right_id", "n_common", "n_left", "n_right"])


def near_pairs(df: DataFrame, jaccard: float = JACCARD, containment: float = CONTAINMENT) -> DataFrame:
    """(batch, left_id, right_id, n_common, n_left, n_right): pairs of rows of a batch that are near copies.

    ``df`` has batch, id, norm (normalised text), one row for each different text of a batch (see collapse_copies). Exact:
    of a text of n grams that is contained to c in a larger one, the other lacks n - ceil(c n) at most, so that any of its
    n - ceil(c n) + k grams have k in common with the other; and of two texts alike to j the smaller is contained to
    2 j / (1 + j) in the other. Only each text's rarest grams are looked up, and only grams that some text looks up (by a
    bit for each of MARKS hashes) are shuffled, 32 bits each. Texts of a batch meet in one task, or by blocks of
    BLOCK_CHARS; pairs that meet often enough are candidates, and these are verified on the whole sets. Which grams are
    rare, and which are looked up, is taken from arrays of a fixed size: they decide on the work and not on the result.
    Null batches are no batch. ``df`` is read five times.
    """
    df = df.where("batch is not null").select("batch", "id", "norm")
    spark = df.sparkSession
    share = min(containment, 2 * jaccard / (1 + jaccard))
    sizes = df.groupBy("batch").agg(F.sum(F.length("norm")).alias("chars"))
    total = sizes.agg(F.sum("chars").alias("chars"), F.collect_list(F.when(F.col("chars") > BLOCK_CHARS, F.struct("batch", "chars"))).alias("large")).first()
    blocks = {r.batch: -(-r.chars // BLOCK_CHARS) for r in total.large}
    shared = spark.sparkContext.broadcast(_rarity(df))

    def mark(bits: np.ndarray, batch: pa.RecordBatch) -> None:
        for part, texts in _slices(batch, 1):
            _, _, key, probe = _probes(shared.value, part.column(0).to_pylist(), texts, share)
            at = key[probe] & (MARKS - 1)
            np.bitwise_or.at(bits, at >> 3, (128 >> (at & 7)).astype(np.uint8))

    marked = spark.sparkContext.broadcast(bucket_fold(df.select("batch", "norm"), mark, MARKS // 8, "uint8", np.bitwise_or))
    units = max(64, 8 * (total.chars or 0) // BLOCK_CHARS)
    kind = df.schema["id"].dataType.simpleString()

    def meet(table: pa.Table) -> pa.Table:
        parts = list(_met(table, jaccard, containment, share))
        of = table.schema.field("ids").type.value_type
        return pa.table([pa.chunked_array([p[k] for p in parts], of) for k in (0, 1)], names=["a", "b"])

    met = _packed(df, shared, marked, share, units, blocks).groupBy("unit", "one", "two").applyInArrow(meet, f"a {kind}, b {kind}")
    pairs = written(met.select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id")))
    ids = pairs.select(F.col("left_id").alias("id")).union(pairs.select("right_id")).distinct()
    texts = written(df.join(small(ids, BROADCAST_IDS), "id", "left_semi"))
    side = lambda name: texts.select(F.col("id").alias(f"{name}_id"), F.col("batch").alias(f"{name}_batch"), F.col("norm").alias(name))
    both = pairs.join(side("left"), "left_id").join(side("right"), "right_id").where("left_batch = right_batch").select(F.col("left_batch").alias("batch"), "left_id", "right_id", "left", "right")
    found = both.mapInArrow(_common, f"batch string, left_id {kind}, right_id {kind}, n_common int, n_left int, n_right int")
    union = F.col("n_left") + F.col("n_right") - F.col("n_common")
    return found.where((F.col("n_common") >= F.lit(jaccard) * union - 1e-9) | (F.col("n_common") >= F.lit(containment) * F.least("n_left", "n_right") - 1e-9))


def greedy_survivors(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(batch, id, kept_id): rows in order of ``place``; a row is dropped for the first kept row that it is a near copy of.

    ``rows`` has batch, id, place (a total order of a batch); ``pairs`` left_id, right_id. kept_id is the row itself where
    it is kept. Not transitive: a row that is like dropped ones only is kept. Only rows with an earlier neighbour take part
    in the rounds; each decides all rows whose earlier neighbours are decided, and is written to the shared folder.
    """
    place = rows.select("id", "place")
    lp, rp = (place.select(F.col("id").alias(f"{s}_id"), F.col("place").alias(s)) for s in ("left", "right"))
    both = pairs.select("left_id", "right_id").join(lp, "left_id").join(rp, "right_id")
    first_left = F.col("left") < F.col("right")
    earlier = written(both.select(F.when(first_left, F.col("left_id")).otherwise(F.col("right_id")).alias("first"), F.when(first_left, F.col("right_id")).otherwise(F.col("left_id")).alias("id"), F.least("left", "right").alias("first_place")))
    state = earlier.select("id").distinct().withColumn("kept_id", F.lit(None).cast(rows.schema["id"].dataType))
    while True:
        known = state.select(F.col("id").alias("first"), F.col("kept_id").alias("_kept"), F.lit(True).alias("_late"))
        # a neighbour without earlier neighbours of its own is kept
        seen = earlier.join(known, "first", "left").withColumn("first_kept", F.when(F.col("_late").isNull(), F.col("first")).otherwise(F.col("_kept")))
        stays = F.col("first_kept") == F.col("first")
        seen = seen.groupBy("id").agg(F.min_by("first", F.when(stays, F.col("first_place"))).alias("by"), F.min(F.when(F.col("first_kept").isNull(), F.col("first_place"))).alias("open_place"), F.min(F.when(stays, F.col("first_place"))).alias("by_place"))
        # the first kept neighbour is known once no neighbour before it is open
        decided = F.when(F.col("by_place").isNotNull() & (F.col("open_place").isNull() | (F.col("by_place") < F.col("open_place"))), F.col("by")).when(F.col("open_place").isNull(), F.col("id"))
        state = written(state.join(seen, "id", "left").select("id", F.coalesce("kept_id", decided).alias("kept_id")))
        if not state.where("kept_id is null").limit(1).count():
            return rows.select("batch", "id").join(state, "id", "left").select("batch", "id", F.coalesce("kept_id", "id").alias("kept_id"))


def memberships(rows: DataFrame, reps: DataFrame, kept: DataFrame) -> DataFrame:
    """(batch, id, representative, kept_id) of every row: its exact copies' representative and the row kept for this one.

    ``rows`` has batch, id, fingerprint; ``reps`` batch, fingerprint, representative (texts of one row may
    be left out); ``kept`` batch, id, kept_id of the representatives. A row with an empty fingerprint has no copies and stands for itself.
    """
    r = reps.select(F.col("batch").alias("_b"), F.col("fingerprint").alias("_f"), "representative")
    own = rows.join(r, F.col("batch").eqNullSafe(F.col("_b")) & (F.col("fingerprint") == F.col("_f")), "left").select("batch", "id", F.coalesce("representative", "id").alias("representative"))
    k = kept.select(F.col("batch").alias("_b"), F.col("id").alias("_id"), "kept_id")
    of = own.join(k, F.col("batch").eqNullSafe(F.col("_b")) & (F.col("representative") == F.col("_id")), "left")
    return of.select("batch", "id", "representative", F.coalesce("kept_id", "id").alias("kept_id"))
