"""Headers and value types that drift between the files of a feed, and one table of all files.

A catalogue of every file's headers (how many rows show each, how many values of each JSON type) is the files' footer
metadata. With it, the life of a header in a feed is an island of consecutive files: lag and lead find starts and
endings, an ending and a start of the same field in the same file (by the alias table) are a renaming, and a change of
the prevailing type between two neighbours of an island is a retyping. The casts of the one table are generated from the
fields of the same alias table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.fields import header_key, is_missing

#: A task's partial catalogue is sent on when it holds so many (file, header) pairs; the sums are the same either way.
FLUSH_PAIRS = 200_000
#: Fields that are counts or flags; all others are text.
FIELD_TYPES = {"likes": "count", "comments": "count", "reposts": "count", "followers": "count", "original": "flag"}


def header_catalogue(records: DataFrame) -> DataFrame:
    """(source_file, header, n_rows, n_string, n_number, n_boolean), one row for each header of each file.

    Rows whose ``data`` is null or no JSON object show no header. Nulls, blank strings and null tokens have no type,
    nor have nested values. Tasks send sums, so a file of any size costs a few rows of shuffle from each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], list[int]] = {}

        def out() -> pa.RecordBatch:
            cols = [*zip(*((*k, *v) for k, v in sums.items()), strict=True)]
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:2]), *(pa.array(c, pa.int64()) for c in cols[2:])], names=["source_file", "header", "n_rows", "n_string", "n_number", "n_boolean"])

        for batch in batches:
            for file, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    row = json.loads(text)
                except (TypeError, ValueError):
                    continue
                if not isinstance(row, dict):
                    continue
                for header, value in row.items():
                    s = sums.get((file, header))
                    if s is None:
                        s = sums[file, header] = [0, 0, 0, 0]
                    s[0] += 1
                    if isinstance(value, str):
                        s[1] += not is_missing(value)
                    elif isinstance(value, bool):
                        s[3] += 1
                    elif isinstance(value, (int, float)):
                        s[2] += 1
            if len(sums) > FLUSH_PAIRS:
                yield out()
                sums.clear()
        if sums:
            yield out()

    part = records.where("source_file is not null").select("source_file", "data").mapInArrow(run, "source_file string, header string, n_rows long, n_string long, n_number long, n_boolean long")
    return part.groupBy("source_file", "header").agg(*(F.sum(c).alias(c) for c in ("n_rows", "n_string", "n_number", "n_boolean")))


def prevailing_type() -> Column:
    """The type of most typed values; null without typed values or where two types are level."""
    n = {k: F.col(f"n_{k}") for k in ("string", "number", "boolean")}
    best = F.greatest(*n.values())
    level = sum((F.when(c == best, 1).otherwise(0) for c in n.values()), F.lit(0))
    return F.when((best > 0) & (level == 1), F.when(n["string"] == best, "string").when(n["number"] == best, "number").otherwise("boolean"))


def header_lives(records: DataFrame, files: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """The catalogue with feed, place of the file in its feed, field and neighbours in the header's own life.

    Only files with rows in ``records`` and with a feed count. ``k`` is the file's place in its feed by exported_at (ties
    by source_file), ``prev_k``/``next_k`` the places of the header's neighbouring files, ``after`` the file that follows.
    """
    catalogue = header_catalogue(records)
    fields = {header_key(h): f for h, f in reversed(names)}
    field_of = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for h in batch.column(1).to_pylist():
                if h not in field_of:
                    if len(field_of) > 100_000:
                        field_of.clear()
                    field_of[h] = fields.get(header_key(h))
                got.append(field_of[h])
            yield batch.append_column("field", pa.array(got, pa.string()))

    catalogue = catalogue.withColumn("kind", prevailing_type()).select("source_file", "header", "n_rows", "kind").mapInArrow(run, "source_file string, header string, n_rows long, kind string, field string")
    held = files.where("feed is not null and source_file is not null and held_in = 'records'").groupBy("source_file").agg(F.min("feed").alias("feed"), F.min("exported_at").alias("exported_at"))
    headers = catalogue.groupBy("source_file").agg(F.collect_list(F.struct("header", "n_rows", "kind", "field")).alias("headers"))  # bounded: one entry for each header of one file
    in_feed = Window.partitionBy("feed").orderBy("exported_at", "source_file")
    placed = held.join(headers, "source_file").withColumns({"k": F.row_number().over(in_feed), "after": F.lead("source_file").over(in_feed)})
    own = Window.partitionBy("feed", "header").orderBy("k")
    return placed.select("feed", "k", "source_file", "after", "exported_at", F.inline("headers")).withColumns({"prev_k": F.lag("k").over(own), "next_k": F.lead("k").over(own), "prev_kind": F.lag("kind").over(own)})


def schema_changes(records: DataFrame, files: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """(source_file, kind, old_header, new_header): what changed in a file against the one before it in its feed.

    Where several headers of one field go or come in one file, they are paired in alphabetical order and the rest are
    removed or added. Headers that stand for no field are never renamed. Empty tables give no rows.
    """
    lives = header_lives(records, files, names)
    came = lives.where((F.col("k") > 1) & ((F.col("prev_k").isNull()) | (F.col("prev_k") < F.col("k") - 1))).select("source_file", "field", F.col("header").alias("came"), F.lit(None).cast("string").alias("went"))
    went = lives.where(F.col("after").isNotNull() & (F.col("next_k").isNull() | (F.col("next_k") > F.col("k") + 1))).select(F.col("after").alias("source_file"), "field", F.lit(None).cast("string").alias("came"), F.col("header").alias("went"))
    both = came.unionByName(went).withColumn("side", F.col("came").isNull())
    both = both.withColumn("n", F.row_number().over(Window.partitionBy("source_file", "field", "side").orderBy("came", "went")))
    # a header without field keeps to itself: its own name is part of the key
    pairs = both.groupBy("source_file", "field", F.when(F.col("field").isNull(), F.coalesce("came", "went")).alias("alone"), "n", F.when(F.col("field").isNull(), F.col("side")).alias("own_side")).agg(F.max("went").alias("went"), F.max("came").alias("came"))
    moved = pairs.select("source_file", F.when(F.col("went").isNull(), "added").when(F.col("came").isNull(), "removed").otherwise("renamed").alias("kind"), F.coalesce("went", F.lit("")).alias("old_header"), F.coalesce("came", F.lit("")).alias("new_header"))
    retyped = lives.where((F.col("prev_k") == F.col("k") - 1) & (F.col("kind") != F.col("prev_kind"))).select("source_file", F.lit("retyped").alias("kind"), F.col("header").alias("old_header"), F.col("header").alias("new_header"))
    return moved.unionByName(retyped)


def header_lifespans(records: DataFrame, files: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    """(feed, field, header, kind, first_file, last_file, n_files): islands of consecutive files in which a header keeps its type."""
    lives = header_lives(records, files, names)
    own = Window.partitionBy("feed", "header").orderBy("k")
    new = (F.col("prev_k").isNull() | (F.col("prev_k") < F.col("k") - 1) | ~F.col("kind").eqNullSafe(F.col("prev_kind"))).cast("int")
    island = lives.withColumn("island", F.sum(new).over(own))
    return island.groupBy("feed", "field", "header", "kind", "island").agg(F.min_by("source_file", "k").alias("first_file"), F.max_by("source_file", "k").alias("last_file"), F.count(F.lit(1)).alias("n_files")).drop("island")


def count_value(text: Column) -> Column:
    """A count as exported (16,272 / 1.4万 / 10万+ / 3.2k) as a whole number; null where it is none."""
    t = F.lower(F.regexp_replace(text, r"[,，\s+]", ""))
    unit = F.when(t.rlike("[万w]$"), 10_000).when(t.endswith("亿"), 100_000_000).when(t.endswith("k"), 1_000).otherwise(1)
    return F.round(F.regexp_extract(t, r"^(\d+(?:\.\d+)?)[万w亿k]?$", 1).try_cast("decimal(20,6)") * unit).try_cast("bigint")


#: What a value of each kind is made of its text; a value that can't be read as its kind is null.
CASTS = {
    "count": count_value,
    "flag": lambda c: F.when(F.lower(c).isin("true", "是", "1", "yes", "原创"), True).when(F.lower(c).isin("false", "否", "0", "no", "非原创"), False),
    "text": lambda c: c,
}


def cast_rules(names: list[tuple[str, str]], kinds: dict[str, str]) -> list[tuple[str, str]]:
    """(field, kind) of every field of the alias table, in its order: what the casts of the one table are generated from.
    Fields without a kind are text; a kind that no cast is known for raises ValueError."""
    rules = [(f, kinds.get(f, "text")) for f in dict.fromkeys(f for _, f in names)]
    if strange := sorted({k for _, k in rules} - set(CASTS)):
        raise ValueError(f"no cast for {', '.join(strange)}")
    return rules


def conformed(records: DataFrame, names: list[tuple[str, str]], kinds: dict[str, str] | None = None) -> DataFrame:
    """All rows of all files in one table: id, source_file, row_no and one column for each field of the alias table.

    Cells with a null token, blank or missing are null. Of several headers of one field, the first in alias order that
    holds a value wins. Casts are generated from the alias table's fields and ``kinds`` (FIELD_TYPES): counts become bigint and
    flags boolean, null where they can't be read. What stands for no field
    is kept, as text, in ``extra``. A row that is no JSON object keeps its id, with all fields null.
    """
    wanted = list(dict.fromkeys(f for _, f in names))
    rank: dict[str, tuple[int, str]] = {}
    for k, (h, f) in enumerate(names):
        rank.setdefault(header_key(h), (k, f))
    keep = ["id", "source_file", "row_no"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[int, str] | None] = {}
        for batch in batches:
            cols: dict[str, list] = {f: [] for f in wanted}
            extras = []
            for text in batch.column(0).to_pylist():
                try:
                    row = json.loads(text)
                except (TypeError, ValueError):
                    row = None
                best: dict[str, tuple[int, str]] = {}
                extra = []
                for header, value in row.items() if isinstance(row, dict) else ():
                    if header not in seen:
                        if len(seen) > 100_000:
                            seen.clear()
                        seen[header] = rank.get(header_key(header))
                    if is_missing(value):
                        continue
                    as_text = value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
                    at = seen[header]
                    if at is None:
                        extra.append((header, as_text))
                    elif at[1] not in best or at[0] < best[at[1]][0]:
                        best[at[1]] = (at[0], as_text)
                for f, col in cols.items():
                    col.append(best[f][1] if f in best else None)
                extras.append(extra)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(c, pa.string()) for c in cols.values()), pa.array(extras, pa.map_(pa.string(), pa.string()))], names=[*keep, *wanted, "extra"])

    schema = "id string, source_file string, row_no int, " + ", ".join(f"`{f}` string" for f in wanted) + ", extra map<string,string>"
    df = records.select("data", "id", "source_file", F.col("row_no").cast("int").alias("row_no")).mapInArrow(run, schema)
    casts = [CASTS[kind](F.col(f)).alias(f) for f, kind in cast_rules(names, FIELD_TYPES if kinds is None else kinds)]
    return df.select(*keep, *casts, "extra")
