"""Queries of the two general problems: mixed timestamps (2) and drifting schemas (4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.fields import aliases
from millrace.operators import drift, instants
from millrace.sources.tables import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_instants(spark, d).where("utc_sec is not null").select("tab", "id", "utc_sec")


def p2_instants(spark: SparkSession, d: str) -> DataFrame:
    """Every row of both tables with its value as exported and its instant, or null."""
    return instants.published_instants(table(spark, d, "records"), table(spark, d, "normalized_sources"), table(spark, d, "source_files"), aliases(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.schema_changes(table(spark, d, "records"), table(spark, d, "source_files"), aliases(spark, d))


def p4_table(spark: SparkSession, d: str) -> DataFrame:
    """All rows in one table; ``extra`` as sorted JSON text so that the result can be compared."""
    df = drift.conformed(table(spark, d, "records"), aliases(spark, d))
    return df.withColumn("extra", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("extra")))))


def p4_lifespans(spark: SparkSession, d: str) -> DataFrame:
    return drift.header_lifespans(table(spark, d, "records"), table(spark, d, "source_files"), aliases(spark, d))


_WIDE, _NARROW = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F)) + "\u3000", "".join(map(chr, range(0x21, 0x7F))) + " "


def _key_sql(x: str) -> str:
    """A header with width, letter case and blanks set aside, in SQL."""
    narrow = _NARROW.replace("'", "''")
    return f"lower(regexp_replace(translate({x}, '{_WIDE}', '{narrow}'), '[\\s\\x{{A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{205F}}]+', '', 'g'))"


ORACLES = {
    "p4_found": f"""
WITH k AS (SELECT source_file, data, unnest(json_keys(data)) AS header FROM records WHERE source_file IS NOT NULL AND json_valid(data) AND json_type(data) = 'OBJECT'),
v AS (SELECT source_file, header, json_extract(data, '$."' || header || '"') AS j FROM k),
t AS (SELECT source_file, header, CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN trim(json_extract_string(j, '$')) NOT IN ('', '-', '--', 'None', 'null') THEN 'string' END WHEN json_type(j) = 'BOOLEAN' THEN 'boolean' WHEN json_type(j) IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT') THEN 'number' END AS kind FROM v),
n AS (SELECT source_file, header, count(*) FILTER (WHERE kind = 'string') AS s, count(*) FILTER (WHERE kind = 'number') AS n, count(*) FILTER (WHERE kind = 'boolean') AS b FROM t GROUP BY ALL),
fields AS (SELECT {_key_sql('header')} AS key, min(field_name) AS field FROM header_names GROUP BY 1),
cat AS (SELECT source_file, header, CASE WHEN s > n AND s > b THEN 'string' WHEN n > s AND n > b THEN 'number' WHEN b > s AND b > n THEN 'boolean' END AS kind, field FROM n LEFT JOIN fields ON key = {_key_sql('header')}),
held AS (SELECT source_file, min(feed) AS feed, min(exported_at) AS e FROM source_files WHERE feed IS NOT NULL AND held_in = 'records' GROUP BY source_file),
files AS (SELECT source_file, feed, row_number() OVER (PARTITION BY feed ORDER BY e, source_file) AS k, lead(source_file) OVER (PARTITION BY feed ORDER BY e, source_file) AS after FROM held WHERE source_file IN (SELECT source_file FROM cat)),
lives AS (SELECT f.source_file, after, k, header, kind, field, lag(k) OVER w AS pk, lead(k) OVER w AS nk, lag(kind) OVER w AS pkind FROM cat JOIN files f USING (source_file) WINDOW w AS (PARTITION BY feed, header ORDER BY k)),
came AS (SELECT source_file, field, header, row_number() OVER (PARTITION BY source_file, field ORDER BY header) AS n FROM lives WHERE k > 1 AND (pk IS NULL OR pk < k - 1)),
went AS (SELECT after AS source_file, field, header, row_number() OVER (PARTITION BY after, field ORDER BY header) AS n FROM lives WHERE after IS NOT NULL AND (nk IS NULL OR nk > k + 1)),
moved AS (SELECT coalesce(c.source_file, w.source_file) AS source_file, w.header AS o, c.header AS h FROM came c FULL JOIN went w ON c.source_file = w.source_file AND c.field = w.field AND c.n = w.n)
SELECT source_file, CASE WHEN o IS NULL THEN 'added' WHEN h IS NULL THEN 'removed' ELSE 'renamed' END AS kind, coalesce(o, '') AS old_header, coalesce(h, '') AS new_header FROM moved
UNION ALL SELECT source_file, 'retyped', header, header FROM lives WHERE pk = k - 1 AND kind <> pkind""",
}
_LIVES = ORACLES["p4_found"].split(",\ncame AS")[0].replace("SELECT f.source_file, after, k,", "SELECT feed, f.source_file, after, k,")
ORACLES["p4_lifespans"] = f"""{_LIVES},
isles AS (SELECT *, sum(CASE WHEN pk IS NULL OR pk < k - 1 OR kind IS DISTINCT FROM pkind THEN 1 ELSE 0 END) OVER (PARTITION BY feed, header ORDER BY k) AS island FROM lives)
SELECT feed, field, header, kind, arg_min(source_file, k) AS first_file, arg_max(source_file, k) AS last_file, count(*)::BIGINT AS n_files FROM isles GROUP BY feed, field, header, kind, island"""
QUERIES = {f.__name__: f for f in (p2_found, p2_instants, p4_found, p4_table, p4_lifespans)}
