"""Casting frames to declared schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.text import strip


def to_scale0(number: Column, rounding: str = "half_up") -> Column:
    """A whole-number decimal: inserts round half up, bulk loads cut the fraction."""
    if rounding == "half_up":
        return number.cast("decimal(18,0)")
    if rounding == "truncate":
        return number.cast("bigint").cast("decimal(18,0)")
    raise ValueError(f"unknown rounding {rounding!r}")


def conform(
    df: DataFrame,
    schema: T.StructType,
    by: str = "name",
    on_error: str = "fail",
    rounding: str = "half_up",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Select the schema's columns in order and cast them; ``keep`` carries others along as is.

    ``by="position"`` binds the n-th column to the n-th field whatever it is called.
    ``on_error="null"`` turns text that does not parse into null instead of failing.
    Empty text counts as null for every field that is not text.
    """
    names = schema.fieldNames()
    if by == "position":
        names = [c for c in df.columns if c not in keep]
        if len(names) != len(schema):
            raise ValueError(f"{len(names)} columns for {len(schema)} fields")
    kinds = {f.name: f.dataType for f in df.schema}
    return df.select([
        convert(df[name], kinds[name], field.dataType, on_error, rounding).alias(field.name)
        for name, field in zip(names, schema)
    ] + [df[name] for name in keep])


def convert(
    column: Column, have: T.DataType, want: T.DataType, on_error: str = "fail", rounding: str = "half_up",
) -> Column:
    """A column of type ``have`` as ``want``, by the rules of ``conform``."""
    if have == want:
        return column
    if isinstance(have, T.StringType):
        column = F.nullif(strip(column), F.lit(""))
        if rounding == "truncate" and want == T.DecimalType(18, 0):
            parsed = T.DecimalType(38, 10)
            column, have = column.try_cast(parsed) if on_error == "null" else column.cast(parsed), parsed
    if rounding == "truncate" and want == T.DecimalType(18, 0):
        return to_scale0(column, rounding)
    return column.try_cast(want) if on_error == "null" else column.cast(want)
