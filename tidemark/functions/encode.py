"""Records to message text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))


def row_text(columns: Sequence[str]) -> Column:
    """Fields joined with commas; a null field reads ``null``."""
    return F.concat_ws(",", *[_text(c) for c in columns])


def tuple_text(columns: Sequence[str]) -> Column:
    """Fields in parentheses, as in ``(a,b,c)``."""
    return F.concat(F.lit("("), row_text(columns), F.lit(")"))


def changelog_text(acc: str, columns: Sequence[str], separator: str = ",") -> Column:
    """A change flag in front of the row text; pass ``separator=""`` for ``trueA,1``."""
    return F.concat(F.col(acc).cast("string"), F.lit(separator), row_text(columns))


def json_text(columns: Sequence[str]) -> Column:
    """JSON with its fields in alphabetical order and null fields left out."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]))
