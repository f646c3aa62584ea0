"""JSON payloads and the coercions at ingest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_fields(column: str | Column, schema: StructType) -> Column:
    """The fields of a JSON text as columns, parsed once per row.

    A filter on the fields of a plain ``from_json`` column is pushed below it and repeats the parse
    for every field it names. Filters are not pushed below a generator, so the struct is unpacked by
    ``inline``: unreadable text still gives one row, with all fields null.
    """
    return F.inline(F.array(F.from_json(column, schema)))


def instant(column: str | Column) -> Column:
    """Text as an instant in the session's zone; null where it cannot be read."""
    return F.try_to_timestamp(_col(column))


def wall_clock(column: str | Column) -> Column:
    """Text as the date and time written in it, without regard to any zone; null if unreadable."""
    return _col(column).try_cast("timestamp_ntz")


def number(column: str | Column) -> Column:
    return _col(column).try_cast("double")


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
