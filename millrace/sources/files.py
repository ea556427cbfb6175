"""Other sources and sinks: directories of spreadsheets, JSON lines, pages with embedded data, bounded chunks."""

from __future__ import annotations

import io
import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.fields import header_key
from millrace.plans.lineage import cut
from millrace.plans.ranking import ranked
from millrace.sources.xlsx import rows

RECORD = "id string, batch string, channel string, source_file string, source_path string, sheet string, row_no int, data string"
_DATA = re.compile(r"const\s+DATA\s*=\s*")


def manifest(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, bytes, sha256, modified) of every file below a folder; hidden and temporary files (~$) are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(~name.startswith("~$")).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"))


def sheet_rows(content: bytes, names: list[tuple[str, str]]) -> Iterator[tuple[str, int, dict]]:
    """(sheet, row number, header -> value) of all sheets; the first row that isn't blank is the header, blank rows are dropped.

    Raises ValueError if a sheet with rows has no column of title, body or ASR.
    """
    wanted = {header_key(h) for h, f in names if f in ("title", "body", "asr")}
    header: list[str] = []
    sheet = None
    for name, number, cells in rows(content):
        if all(v is None or str(v).strip() == "" for v in cells):
            continue
        if name != sheet:
            sheet = name
            header = [str(v).strip() if v is not None and str(v).strip() else f"未命名列{k}" for k, v in enumerate(cells, 1)]
            if not wanted & {header_key(h) for h in header}:
                raise ValueError(f"sheet {name} has no column of title, body or ASR")
            continue
        yield name, number, dict(zip(header, [*cells, *[None] * (len(header) - len(cells))], strict=False))


def read_spreadsheets(spark: SparkSession, folder: str, names: list[tuple[str, str]]) -> DataFrame:
    """Raw records of all .xlsx files below a folder; the batch is the file's folder."""
    from millrace.functions.text import stable_id
    from millrace.operators.sources import channel_of

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xlsx").load(folder).where(~F.element_at(F.split("path", "/"), -1).startswith("~$"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = list(sheet_rows(content, names))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(found)), pa.array([r[0] for r in found]), pa.array([r[1] for r in found], pa.int32()), pa.array([json.dumps(r[2], ensure_ascii=False) for r in found])], names=["source_path", "sheet", "row_no", "data"])

    raw = files.select("path", "content").mapInArrow(run, "source_path string, sheet string, row_no int, data string")
    parts = F.split("source_path", "/")
    out = raw.withColumns({"source_file": F.element_at(parts, -1), "batch": F.element_at(parts, -2)})
    channel = channel_of(F.concat_ws(" ", "source_file", "sheet"), strict=True)
    return out.select(stable_id(F.col("source_path"), F.col("sheet"), F.col("row_no").cast("string")).alias("id"), "batch", channel.alias("channel"), "source_file", "source_path", "sheet", "row_no", "data")


def distinct_members(pairs: list[tuple[str, object]]) -> dict:
    """A JSON object; ValueError names the keys that it gives more than once."""
    if len(made := dict(pairs)) < len(pairs):
        counts = Counter(k for k, _ in pairs)
        raise ValueError("key given twice: " + ", ".join(k for k in made if counts[k] > 1))
    return made


def read_jsonl(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(line_no, value, problem) of JSON lines: objects as text, or what is wrong with the line. A byte-order mark and blank
    lines are set aside. ``strict`` raises on the first bad line."""
    lines = spark.read.text(path).where("trim(regexp_replace(value, '^\\ufeff', '')) != ''")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, problems = [], []
            for text in batch.column(0).to_pylist():
                try:
                    value = json.loads(text.lstrip("\ufeff"), object_pairs_hook=distinct_members)
                    problem = None if isinstance(value, dict) else "no object"
                except ValueError as e:
                    value, problem = None, str(e).split(":")[0]
                if strict and problem:
                    raise ValueError(f"{problem}: {text[:80]}")
                values.append(json.dumps(value, ensure_ascii=False) if problem is None else None)
                problems.append(problem)
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array(problems, pa.string())], names=["value", "problem"])

    return lines.mapInArrow(run, "value string, problem string")


def embedded_data(html: str) -> str | None:
    """The JSON value after ``const DATA=`` in a page, as text; null where there is none."""
    m = _DATA.search(html or "")
    if not m:
        return None
    try:
        value, _ = json.JSONDecoder().raw_decode(html, m.end())
    except ValueError:
        return None
    return json.dumps(value, ensure_ascii=False)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, data) of pages with embedded data."""
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    extract = F.pandas_udf(lambda s: s.map(embedded_data), "string")
    return pages.select("path", extract("value").alias("data"))


def page_items(data: Column) -> Column:
    """All items of the nested dataset of a page: array of (batch, cluster, url)."""
    kind = "struct<batches:array<struct<name:string,clusters:array<struct<id:string,items:array<struct<url:string>>>>>>>"
    parsed = F.from_json(data, kind)
    return F.flatten(F.flatten(F.transform(parsed["batches"], lambda b: F.transform(b["clusters"], lambda c: F.transform(c["items"], lambda i: F.struct(b["name"].alias("batch"), c["id"].alias("cluster"), i["url"].alias("url")))))))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, batch, author, channel, url) of what a page, JSON lines or a JSON document holds, by the file's ending.

    Of a document, a list of objects or one under ``rows`` or ``results``. Other endings raise ValueError.
    """
    fields = ["source_id", "batch", "author", "channel", "url"]
    ending = path.rsplit(".", 1)[-1].lower()
    get = lambda c, *names: F.coalesce(*(F.get_json_object(c, f"$.{n}") for n in names))
    if ending in ("html", "htm"):
        kind = "struct<batches:array<struct<name:string,clusters:array<struct<items:array<string>>>>>>"
        batches = read_pages(spark, path).select(F.explode(F.from_json("data", kind)["batches"]).alias("b"))
        items = batches.select(F.col("b.name").alias("batch"), F.explode(F.flatten(F.transform("b.clusters", lambda c: c["items"]))).alias("i"))
        return items.select(get("i", "sourceId", "id", "viewId").alias("source_id"), "batch", *(get("i", f).alias(f) for f in fields[2:]))
    if ending == "jsonl":
        return read_jsonl(spark, path, strict=True).select(get("value", "id", "source_id").alias("source_id"), *(get("value", f).alias(f) for f in fields[1:]))
    if ending == "json":
        doc = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\ufeff", "").alias("v"))
        rows = F.when(F.trim("v").startswith("["), F.col("v")).otherwise(get("v", "rows", "results"))
        items = doc.select(F.explode(F.from_json(rows, "array<string>")).alias("i")).where(F.col("i").startswith("{"))
        return items.select(*(get("i", f).alias(f) for f in fields))
    raise ValueError(f"no way to read {path}")


def render_page(template: str, dataset: object, placeholder: str = "__DATA__") -> str:
    """The page with the dataset as compact JSON in place of its one placeholder; raises ValueError unless there is one."""
    if template.count(placeholder) != 1:
        raise ValueError("the template needs exactly one placeholder")
    return template.replace(placeholder, json.dumps(dataset, ensure_ascii=False, separators=(",", ":")).replace("</", "<\\/"))


def replace_data(html: str, dataset: object) -> str:
    """The page with another dataset in place of its own."""
    m = _DATA.search(html)
    if not m:
        raise ValueError("the page has no dataset")
    _, end = json.JSONDecoder().raw_decode(html, m.end())
    return html[: m.end()] + json.dumps(dataset, ensure_ascii=False, separators=(",", ":")).replace("</", "<\\/") + html[end:]


def _steps(sizes: np.ndarray, most_rows: int, most_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(sums of sizes from 0, for each row the first row of the next chunk if a chunk begins with it)."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    fits = np.searchsorted(sums, sums[:-1] + most_bytes, side="right") - 1
    i = np.arange(len(sizes))
    return sums, np.maximum(np.minimum(fits, i + most_rows), i + 1)


def chunked(df: DataFrame, group: str, order: str, text: str, most_rows: int = 60, most_bytes: int = 120_000, bucket_rows: int = 200_000) -> DataFrame:
    """``df`` with chunk_no, from 0: rows of a group in order, a new chunk when one more row would pass either bound. A row
    beyond the bound is a chunk of its own. ``order`` is unique in its group; a null group is a group.

    Only (group, order, size) goes through, in buckets of consecutive rows, so that a group of any size is spread over
    tasks. A bucket tells for each number of rows that an open chunk of the bucket before may still take how many chunks
    begin in it and what stays open; these few rows chain the buckets, and then each bucket numbers its rows.
    """
    g = df.select(group, order, F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint").alias("_size"))
    placed = cut(ranked(g, [group], F.col(order)).withColumn("_bucket", F.expr(f"(place - 1) div {bucket_rows}")))
    kind = f"`{group}` {df.schema[group].dataType.simpleString()}"

    def ends(pdf):
        import pandas as pd

        sizes = pdf.sort_values("place")["_size"].to_numpy(np.int64)
        sums, after = _steps(sizes, most_rows, most_bytes)
        n, out, known = len(sizes), [], {}
        for e in range(min(most_rows, n) + 1):
            path, i = [], e
            while i < n and i not in known:
                path.append(i)
                i = int(after[i])
            begun, last = known.get(i, (0, -1))
            for i in reversed(path):
                begun, last = begun + 1, i if last < 0 else last
                known[i] = begun, last
            out.append((begun, n - last, int(sums[n] - sums[last])) if e < n else (0, n, int(sums[n])))
        row = {group: pdf[group].iloc[0], "_bucket": pdf["_bucket"].iloc[0], "_sums": sums[: len(out)].tolist(), "_begun": [x[0] for x in out], "_rows": [x[1] for x in out], "_bytes": [x[2] for x in out]}
        return pd.DataFrame([row])

    few = placed.groupBy(group, "_bucket").applyInPandas(ends, f"{kind}, _bucket bigint, _sums array<bigint>, _begun array<bigint>, _rows array<bigint>, _bytes array<bigint>")

    def chain(pdf):
        import pandas as pd

        rows, size, chunks, out = 0, 0, 0, []
        for r in pdf.sort_values("_bucket").itertuples(index=False):
            sums = np.asarray(r[2])
            e = 0 if chunks == 0 else int(((np.arange(len(sums)) + rows <= most_rows) & (sums + size <= most_bytes)).sum()) - 1
            out.append((r[0], r[1], max(e, 0), chunks))
            e = max(e, 0)
            if r[3][e]:
                rows, size, chunks = int(r[4][e]), int(r[5][e]), chunks + int(r[3][e])
            else:  # the whole bucket fits into the open chunk
                rows, size = rows + int(r[4][e]), size + int(r[5][e])
        return pd.DataFrame(out, columns=[group, "_bucket", "_taken", "_chunks"])

    entries = few.groupBy(group).applyInPandas(chain, f"{kind}, _bucket bigint, _taken bigint, _chunks bigint")
    e = entries.select(F.col(group).alias("_g"), F.col("_bucket").alias("_b"), "_taken", "_chunks")
    joined = placed.join(e, placed[group].eqNullSafe(F.col("_g")) & (placed["_bucket"] == F.col("_b"))).drop("_g", "_b")

    def number(pdf):
        pdf = pdf.sort_values("place")
        _, after = _steps(pdf["_size"].to_numpy(np.int64), most_rows, most_bytes)
        begins = np.zeros(len(pdf), np.int64)
        i = int(pdf["_taken"].iloc[0])
        while i < len(pdf):
            begins[i] = 1
            i = int(after[i])
        return pdf.assign(chunk_no=np.cumsum(begins) + int(pdf["_chunks"].iloc[0]) - 1)[[group, order, "chunk_no"]]

    numbered = joined.groupBy(group, "_bucket").applyInPandas(number, f"{kind}, `{order}` {df.schema[order].dataType.simpleString()}, chunk_no int")
    n = numbered.select(F.col(group).alias("_g"), F.col(order).alias("_o"), "chunk_no")
    return df.join(n, df[group].eqNullSafe(F.col("_g")) & df[order].eqNullSafe(F.col("_o"))).drop("_g", "_o")


def write_atomic(path: str, text: str) -> None:
    """A file that is there whole or not at all: written beside its place and renamed."""
    beside = f"{path}.{os.getpid()}.tmp"
    with open(beside, "w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(beside, path)


