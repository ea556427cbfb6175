"""Raw exported rows: which header stands for which field."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import SparkSession

from millrace.sources.tables import small_rows, table

#: Cells that mean "no value".
NULL_TOKENS = ("-", "--", "None", "null")

_BLANKS = re.compile(r"\s+")


def header_key(header: str) -> str:
    """A header with width, letter case and blanks set aside."""
    return _BLANKS.sub("", unicodedata.normalize("NFKC", header)).casefold()


def is_missing(value: object) -> bool:
    """Null, a blank string or a null token."""
    return value is None or (isinstance(value, str) and (not (v := value.strip()) or v in NULL_TOKENS))


def aliases(spark: SparkSession, sf_dir: str, most: int = 20_000) -> list[tuple[str, str]]:
    """header_names as a list in the table's order; a fixed dimension, its size is checked."""
    return [(r.header, r.field_name) for r in small_rows(table(spark, sf_dir, "header_names").select("header", "field_name"), most, "header_names") if r.header and r.field_name]


class FieldPicker:
    """Takes one field out of a row's JSON object.

    Where several headers of one row stand for the field, the first in alias order that holds a value
    wins. Text that is no JSON object gives None, as does a row without the field.
    """

    def __init__(self, names: Iterable[tuple[str, str]], field: str):
        self.field = field
        self.rank: dict[str, int] = {}
        for k, (header, name) in enumerate(names):
            if name == field:
                self.rank.setdefault(header_key(header), k)
        self.seen: dict[str, int | None] = {}

    def _rank(self, header: str) -> int | None:
        try:
            return self.seen[header]
        except KeyError:
            if len(self.seen) > 100_000:
                self.seen.clear()
            got = self.seen[header] = self.rank.get(header_key(header))
            return got

    def pick(self, data: str | None) -> object:
        if not data:
            return None
        try:
            row = json.loads(data)
        except ValueError:
            return None
        if not isinstance(row, dict):
            return None
        best, found = None, None
        for header, value in row.items():
            rank = self._rank(header)
            if rank is not None and (best is None or rank < best) and not is_missing(value):
                best, found = rank, value
        return found
