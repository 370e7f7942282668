"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANK = ""


def as_col(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_fields(col: str | Column, sep: str = " ") -> Column:
    """Split on one character; empty fields stay except for the run of them at the end.

    A text of separators only gives no field, an empty text gives one empty field.
    """
    text = as_col(col)
    body = F.rtrim(text, F.lit(sep))
    fields = F.split(body, "\\" + sep if sep in ".|*+?()[]{}^$\\" else sep)
    only_separators = (body == BLANK) & (text != BLANK)
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(fields)


def missing_as(col: str | Column, default) -> Column:
    """Replace a missing value."""
    return F.coalesce(as_col(col), F.lit(default))


def blank_as(col: str | Column, default) -> Column:
    """Replace a missing, empty or white-space text."""
    return F.coalesce(F.nullif(F.trim(as_col(col)), F.lit(BLANK)), F.lit(default))


def pair_text(*cols: str | Column, sep: str = ":") -> Column:
    """``left:right`` texts, also used as composite row keys. Missing parts print as empty."""
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit(BLANK)) for c in cols])


def contains_any(col: str | Column, words: list[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | as_col(col).contains(word)
    return found
