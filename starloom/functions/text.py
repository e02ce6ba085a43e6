"""Splitting, trimming and repairing text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# What a whitespace strip removes.
WHITESPACE = " \t\n\r\f\v"


def strip(text: Column, characters: str = WHITESPACE) -> Column:
    """Remove the given characters from both ends."""
    return F.btrim(text, F.lit(characters))


def split_part(text: Column, separator: str, index: int, kind: str | T.DataType = "string") -> Column:
    """The ``index``-th (0-based) part, cast; null when missing or not castable."""
    part = F.get(F.split(text, _literal(separator)), F.lit(index))
    return part if kind == "string" else strip(part).try_cast(kind)


def _literal(separator: str) -> str:
    return "\\Q" + separator + "\\E"


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def replace_invalid(text: Column, replacement: str = "^") -> Column:
    """Replace byte sequences that are not UTF-8; text that is valid stays as it is."""
    repaired = F.replace(F.make_valid_utf8(text), F.lit("\N{REPLACEMENT CHARACTER}"), F.lit(replacement))
    return F.when(F.is_valid_utf8(text), text).otherwise(repaired)
