"""Code-list text: ranges of ``code = 'label'`` lines picked by line number."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from starloom.functions.text import strip
from starloom.operators.conflicts import keep_last
from starloom.session import materialize


def numbered_lines(spark: SparkSession, path: str | list[str], per_file: bool = True) -> DataFrame:
    """Lines with their 0-based number: (file, line, value).

    Files are split over tasks as usual. A line's number is its place in its split plus the
    lines of the splits before it; that table has one row per split, as many as the driver
    schedules tasks for the scan, so it is safe to broadcast. The lines are written once first,
    because two scans of the same files need not cut the same splits.
    With ``per_file=False`` the files are numbered through in name order.
    """
    lines = materialize(
        spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
            "value",
        ),
        "lines",
    )
    if per_file:
        before = Window.partitionBy("file").orderBy("split")
    else:
        before = Window.partitionBy(F.lit(0)).orderBy("file", "split")
    offsets = (
        lines.groupBy("file", "split")
        .agg(F.min("row").alias("first"), F.count("*").alias("n"))
        .select(
            "file", "split", "first",
            F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            .alias("skip"),
        )
    )
    return lines.join(F.broadcast(offsets), ["file", "split"]).select(
        "file", (F.col("row") - F.col("first") + F.col("skip")).alias("line"), "value",
    )


@dataclass(frozen=True)
class LabelBlock:
    """A line range ``[start, end)`` and how its codes and labels are trimmed.

    Each trim is a sequence of character sets stripped one after the other; the order matters,
    as blanks inside the quotes stay when blanks are stripped before the quotes.
    """

    code: str
    label: str
    start: int
    end: int
    code_trim: tuple[str, ...]
    label_trim: tuple[str, ...]


_BLANKS = " \t\n\r\f\v"

# Line ranges and trimming of the immigration label file.
COUNTRIES = LabelBlock("country_code", "country", 10, 298, (_BLANKS,), (_BLANKS, "'"))
CITIES = LabelBlock("city_code", "city", 303, 962, ("\t", _BLANKS, "'"), ("\t", _BLANKS, "'"))
STATES = LabelBlock("state_code", "state", 982, 1036, ("\t", "'"), (_BLANKS, "'"))


def parse_labels(lines: DataFrame, block: LabelBlock, tidy: bool = False) -> DataFrame:
    """Codes and labels of one block of ``numbered_lines``; a repeated code keeps its last label.

    Only the text up to a second ``=`` is the label. Lines without ``=`` carry no pair; ``lines_without_pair`` counts them.
    ``tidy`` trims blanks once more after the quotes.
    """
    parts = F.split("value", "=")
    code = _strip_all(F.get(parts, F.lit(0)), block.code_trim, tidy)
    label = _strip_all(F.get(parts, F.lit(1)), block.label_trim, tidy)
    pairs = (
        lines.filter((F.col("line") >= block.start) & (F.col("line") < block.end))
        .filter(F.col("value").contains("="))
        .select(code.alias(block.code), label.alias(block.label), "file", "line")
    )
    return keep_last(pairs, [block.code], ["file", "line"]).select(block.code, block.label)


def lines_without_pair(lines: DataFrame, blocks: Sequence[LabelBlock]) -> DataFrame:
    """(label, lines): how many lines of each block hold no ``=``; blocks without any are left out."""
    within = [
        F.when((F.col("line") >= b.start) & (F.col("line") < b.end), F.lit(b.label)) for b in blocks
    ]
    lost = lines.filter(~F.col("value").contains("=")).select(F.explode(F.array_compact(F.array(*within))).alias("label"))
    return lost.groupBy("label").agg(F.count("*").alias("lines"))


def _strip_all(text: Column, trims: tuple[str, ...], tidy: bool) -> Column:
    for characters in trims + ((_BLANKS,) if tidy else ()):
        text = strip(text, characters)
    return text
