"""Casts that turn bad input into NULL whatever the session's ANSI setting is."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from paytide.schema import DATE_FORMAT, TIMESTAMP_FORMAT


def _parse_prefix(text: Column, pattern: str, target: str) -> Column:
    """Parse the leading characters of `text`, tolerating anything after them.

    Text shaped like `pattern` goes through the plain cast, which is several times
    cheaper than the pattern parser and checks the ranges of all fields just the same.
    Separators stand for themselves and every letter of the pattern for a digit. Leading
    blanks and fields with fewer digits (the year has four) are read too.
    """
    shape = "^" + "".join(r"\d" if c.isalpha() else c for c in pattern)
    prefix = F.substring(text, 1, len(pattern))
    fields = re.sub(r"([a-zA-Z])\1*", lambda m: r"\d{4}" if m[0][0] == "y" else r"\d{1,2}", pattern)
    # On the whole text: cut to the pattern's length, each blank would cost a digit at the end.
    loose = F.regexp_extract(text, rf"^\s*({fields})", 1)
    return F.when(text.rlike(shape), prefix.try_cast(target)).otherwise(loose.try_cast(target))


def conform(column: Column, source: DataType | None, target: DataType) -> Column:
    """Cast `column` (of type `source`) to `target`, giving NULL where it cannot.

    Already-typed timestamps and dates skip the text parser, and a column that has
    the target type is left alone so its filters still reach the Parquet scan.
    """
    if source == target:
        return column
    is_text = isinstance(source, StringType)
    if isinstance(target, TimestampType):
        if is_text:
            return _parse_prefix(column, TIMESTAMP_FORMAT, "timestamp")
        return column.try_cast("timestamp")
    if isinstance(target, DateType):
        if is_text:
            return _parse_prefix(column, DATE_FORMAT, "date")
        if isinstance(source, (TimestampType, TimestampNTZType)):
            return F.to_date(column)
        return column.try_cast("date")
    if isinstance(target, StringType):
        return column.cast("string")
    if is_text and isinstance(target, (IntegerType, LongType)):
        # Text with a fraction gives its whole part.
        whole = F.regexp_extract(column, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
        return F.coalesce(column.try_cast(target), whole.try_cast(target))
    return column.try_cast(target)
