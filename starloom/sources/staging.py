"""Bulk loads of JSON files into typed staging frames."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from starloom.functions.coerce import conform, convert
from starloom.functions.text import replace_invalid, strip
from starloom.operators.quality import QualityError
from starloom.schemas import as_text
from starloom.session import materialize
from starloom.sources.files import first_per_file, read_json

_TOP_LEVEL = re.compile(r"^\$(?:\.(\w+)|\['([^']+)'\])$")


def scoped_path(template: str, run_ts: datetime) -> str:
    """Fill ``{run.year}``, ``{run.month}`` … so that only the run's part of the source is read."""
    return template.format(run=run_ts)


def load_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    on_error: str = "fail",
    rounding: str = "truncate",
    first_only: bool = False,
) -> DataFrame:
    """JSON objects whose fields carry the table's column names.

    Fields are read as text and cast afterwards, so a number that arrives quoted is kept.
    ``first_only`` keeps the first record of each file.
    """
    text = read_json(spark, path, as_text(schema), mode=_mode(on_error))
    return conform(first_per_file(text) if first_only else text, schema, on_error=on_error, rounding=rounding)


def load_json_paths(
    spark: SparkSession,
    path: str | list[str],
    json_paths: list[str],
    schema: T.StructType,
    on_error: str = "fail",
    rounding: str = "truncate",
) -> DataFrame:
    """JSON objects mapped by an ordered list of paths: the n-th path fills the n-th column.

    All top-level fields come out of a single parse of the line; deeper paths cost one each.
    """
    if len(json_paths) != len(schema):
        raise ValueError(f"{len(json_paths)} paths for {len(schema)} columns")
    fields = [_top_level_field(p) for p in json_paths]
    wanted = T.StructType([T.StructField(f, T.StringType()) for f in dict.fromkeys(fields) if f])
    lines = _read_lines(spark, path)
    if len(wanted):
        lines = lines.withColumn("_object", F.from_json("value", wanted, {"mode": _mode(on_error)}))
    values = [
        F.col("_object").getField(f) if f else F.get_json_object("value", p)
        for f, p in zip(fields, json_paths)
    ]
    text = lines.select([v.alias(f.name) for v, f in zip(values, schema)])
    return conform(text, schema, on_error=on_error, rounding=rounding)


#: What a reject is reported under if the whole line is no JSON object.
LINE = "line"


@dataclass(frozen=True)
class Staged:
    """A bulk load that lost nothing unseen.

    ``rows`` are the rows whose every value fits its column. ``rejects`` are the other lines (file, line, columns): the
    text as it was and the columns that it has no fitting value for, or ``line`` if it is no JSON object. ``rejected``
    counts them by column, ``row_count`` and ``reject_count`` are the totals.
    """

    rows: DataFrame
    rejects: DataFrame
    row_count: int
    reject_count: int
    rejected: dict[str, int]

    def report(self) -> DataFrame:
        """(column_name, rejects): one row per column, zeros included; a line with several bad values counts for each."""
        return self.rows.sparkSession.createDataFrame(list(self.rejected.items()), "column_name string, rejects long")

    def within(self, max_rejects: int | None) -> Staged:
        """The load itself, if it has at most that many rejects (None: any number); else an error that says where."""
        if max_rejects is not None and self.reject_count > max_rejects:
            found = ", ".join(f"{c}: {n}" for c, n in self.rejected.items() if n)
            first = self.rejects.select("file", "line").first()
            raise QualityError(
                f"{self.reject_count} rejected lines, {max_rejects} allowed ({found}); one of them, in {first['file']}: {first['line'][:200]}")
        return self


def stage_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    max_rejects: int | None = 0,
    rounding: str = "truncate",
    json_paths: list[str] | None = None,
    replacement: str | None = None,
    keep_file: bool = False,
) -> Staged:
    """A bulk load of JSON lines with an error budget, in one pass over the files.

    Fields carry the columns' names, or the n-th of ``json_paths`` fills the n-th column; invalid bytes become
    ``replacement``, if given. Each line is parsed once. Rows and rejects are written together, to one scratch table,
    and are counted in that same write; reading the few rejects skips the row groups without any. More
    than ``max_rejects`` rejected lines are an error, which leaves nothing loaded; None allows any number.
    With ``keep_file`` the rows have a further column ``_file``.
    Blank lines are no rows. Missing fields, nulls and, where the column is no text, empty values are nulls, not rejects.
    """
    paths = [f"$['{c}']" for c in schema.fieldNames()] if json_paths is None else json_paths
    if len(paths) != len(schema):
        raise ValueError(f"{len(paths)} paths for {len(schema)} columns")
    fields = [_top_level_field(p) for p in paths]
    broken = "_broken"
    wanted = T.StructType([T.StructField(f, T.StringType()) for f in [*dict.fromkeys(f for f in fields if f), broken]])
    line = F.col("value") if replacement is None else replace_invalid(F.col("value"), replacement)
    lines = _read_lines(spark, path).select(F.col("_metadata.file_path").alias("file"), line.alias("line"))
    parsed = lines.withColumn("object", F.from_json("line", wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}))
    no_object = F.col("object").isNull() | F.col(f"object.{broken}").isNotNull() | ~F.ltrim("line").startswith("{")
    texts = [F.col("object").getField(f) if f else F.get_json_object("line", p) for f, p in zip(fields, paths)]
    typed = [convert(t, T.StringType(), f.dataType, "null", rounding).alias(f.name) for t, f in zip(texts, schema)]
    lost = [  # text always fits
        F.when(F.col("row").getField(f.name).isNull() & (strip(t) != ""), F.lit(f.name))
        for t, f in zip(texts, schema) if not isinstance(f.dataType, T.StringType)
    ]
    columns = F.when(no_object, F.array(F.lit(LINE))).otherwise(F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>"))
    judged = parsed.withColumn("row", F.struct(*typed)).withColumn("columns", columns).select(
        "row", F.col("file").alias("_file") if keep_file else F.lit(None).cast("string").alias("_file"), (F.size("columns") > 0).alias("rejected"), F.struct("file", "line", "columns").alias("reject"))
    judged = judged.withColumn("reject", F.when(F.col("rejected"), F.col("reject")))
    names = [LINE, *schema.fieldNames()]
    observation = Observation()
    counters = [F.count_if(F.array_contains("reject.columns", c)).alias(f"at {i}") for i, c in enumerate(names)]
    stored = materialize(
        judged.observe(observation, F.count(F.lit(1)).alias("all"), F.count_if("rejected").alias("rejects"), *counters),
        "staged")
    found = observation.get
    return Staged(
        stored.filter("NOT rejected").select("row.*", *["_file"] * keep_file), stored.filter("rejected").select("reject.*"),
        found["all"] - found["rejects"], found["rejects"], {c: found[f"at {i}"] for i, c in enumerate(names)},
    ).within(max_rejects)


def read_json_paths(spark: SparkSession, path: str) -> list[str]:
    """The path list of a JSON-paths file (one small document)."""
    document = spark.read.text(path, wholetext=True).first()
    return json.loads(document["value"])["jsonpaths"]


def load_json_repaired(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    replacement: str = "^",
    on_error: str = "fail",
    rounding: str = "truncate",
) -> DataFrame:
    """JSON objects in files that hold invalid bytes; each bad sequence becomes ``replacement``.

    The repair comes before the parse: the JSON reader would turn such a record into nulls.
    """
    parsed: Column = F.from_json(
        replace_invalid(F.col("value"), replacement), as_text(schema), {"mode": _mode(on_error)})
    text = _read_lines(spark, path).select(parsed.alias("_object")).select("_object.*")
    return conform(text, schema, on_error=on_error, rounding=rounding)


def _mode(on_error: str) -> str:
    """A line that is no JSON object fails a load that must not lose values."""
    return "FAILFAST" if on_error == "fail" else "PERMISSIVE"


def _read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return lines.filter(F.trim("value") != "")


def _top_level_field(path: str) -> str | None:
    found = _TOP_LEVEL.match(path)
    return (found.group(1) or found.group(2)) if found else None
