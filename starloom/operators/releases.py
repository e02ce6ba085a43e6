"""Tables of a database that change together, or not at all.

A load writes new folders ``load=<number>`` next to the stored ones. No reader sees them: each table is a view over its
folders, and which loads count stands in one small view, ``releases``. Replacing that view is a single catalogue
operation, and it switches every table at once. A run that breaks off before leaves all tables as they were; the folders
it has written are removed by the next run, which gets the same number.

Tables grow (the new folder counts beside the old ones), are replaced (only the new one counts), or are rewritten in
parts: rows are dealt out by their key, and a load writes just the parts that its keys fall into. Tables may also be
bucketed and sorted, so that joins on that key need no shuffle. One load at a time may run on a database.

What a table does not allow is counted while its rows are written, so checking costs no further scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from starloom.operators import quality, statistics

LOAD, PART = "load", "part"
_STATE = "name string, first int, last int, parts array<int>, note string, age int"


@dataclass(frozen=True)
class Layout:
    """``bucket_by`` is the key that joins need no shuffle on, ``sort_by`` the order within a bucket; ``part_by`` is the
    key by which the rows are dealt to ``parts`` parts that a load can rewrite one by one. ``lookup`` columns get Bloom
    filters, so that a lookup skips row groups that do not hold its value, whatever the order of the rows. Sketches of
    the columns ``statistics`` are kept for every load."""

    bucket_by: tuple[str, ...] = ()
    buckets: int = 8
    sort_by: tuple[str, ...] = ()
    part_by: tuple[str, ...] = ()
    parts: int = 16
    lookup: tuple[str, ...] = ()
    statistics: tuple[str, ...] = ()


@dataclass(frozen=True)
class Visible:
    """The loads of a table that count: from ``first`` to ``last``, or one load for each part. ``note`` says what the
    rows stand for, where a later load has to know."""

    first: int = 1
    last: int = 0
    parts: tuple[int, ...] = ()
    note: str = ""


class Releases:
    """The tables ``schemas`` of a database, created where they do not exist yet."""

    def __init__(
        self, spark: SparkSession, database: str, schemas: Mapping[str, T.StructType],
        layouts: Mapping[str, Layout] | None = None, location: str | None = None,
    ):
        for name in (database, *schemas):
            if not re.fullmatch(r"\w+", name):
                raise ValueError(f"{name!r} is no plain name")
        self.spark, self.database, self.schemas = spark, database, dict(schemas)
        self.layouts = {t: (layouts or {}).get(t, Layout()) for t in schemas}
        if any(layout.statistics for layout in self.layouts.values()):
            self.schemas["statistics"], self.layouts["statistics"] = statistics.SCHEMA, Layout()
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
        if not spark.catalog.tableExists(f"{database}.releases"):
            self._set({}, {})
        for name, layout in list(self.layouts.items()):
            if stored := len(self.visible(name).parts):  # as many parts as the table was created with
                self.layouts[name] = replace(layout, parts=stored)
            self._create(name)

    def stored(self, name: str) -> str:
        """The catalogue name of the table that holds the loads of a table."""
        return f"{self.database}.`{name}_loads`"

    def name(self, table: str) -> str:
        return f"{self.database}.`{table}`"

    def _create(self, name: str) -> None:
        layout, schema = self.layouts[name], self.schemas[name]
        extra = ([PART] if layout.part_by else []) + [LOAD]
        columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema] + [f"`{c}` int" for c in extra])
        listed = lambda names: ", ".join(f"`{c}`" for c in names)
        buckets = f" CLUSTERED BY ({listed(layout.bucket_by)})" if layout.bucket_by else ""
        if layout.bucket_by and layout.sort_by:
            buckets += f" SORTED BY ({listed(layout.sort_by)})"
        buckets += f" INTO {layout.buckets} BUCKETS" if buckets else ""
        filters = ", ".join(f"'parquet.bloom.filter.enabled#{c}' 'true'" for c in layout.lookup)
        options = f" OPTIONS ({filters})" if filters else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.stored(name)} ({columns}) USING parquet{options} PARTITIONED BY ({listed(extra)}){buckets}")
        mine = lambda c: f"(SELECT {c} FROM {self.database}.releases WHERE name = '{name}' AND age = 0)"
        counts = f"`{LOAD}` = get({mine('parts')}, `{PART}`)" if layout.part_by else f"`{LOAD}` BETWEEN {mine('first')} AND {mine('last')}"
        self.spark.sql(
            f"CREATE VIEW IF NOT EXISTS {self.name(name)} AS SELECT {listed(schema.fieldNames())} FROM {self.stored(name)} WHERE {counts}")

    # --- state ------------------------------------------------------------------------------
    def _states(self) -> tuple[dict[str, Visible], dict[str, Visible]]:
        """What counts now, and what counted before the last release."""
        rows = self.spark.table(f"{self.database}.releases").collect()
        states: tuple[dict[str, Visible], dict[str, Visible]] = ({}, {})
        for r in rows:
            states[r["age"]][r["name"]] = Visible(r["first"], r["last"], tuple(r["parts"]), r["note"])
        return states

    def _set(self, now: Mapping[str, Visible], before: Mapping[str, Visible]) -> None:
        def literal(name: str, v: Visible, age: int) -> str:
            parts = f"array({', '.join(map(str, v.parts))})" if v.parts else "CAST(array() AS array<int>)"
            return f"('{name}', {v.first}, {v.last}, {parts}, '{v.note}', {age})"

        rows = [literal(n, v, age) for age, state in enumerate((now, before)) for n, v in state.items()]
        rows = rows or ["('', 1, 0, CAST(array() AS array<int>), '', 0)"]
        columns = ", ".join(c.split()[0] for c in _STATE.split(", "))
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.releases AS SELECT * FROM VALUES {', '.join(rows)} AS t({columns})")

    def visible(self, name: str) -> Visible:
        """The loads of a table that count."""
        return self._states()[0].get(name, Visible())

    def table(self, name: str) -> DataFrame:
        """The table as readers see it."""
        return self.spark.table(self.name(name))

    def statistics(self, name: str) -> DataFrame:
        """Statistics of a table as readers see it, merged from those of its loads; see ``statistics.summary``."""
        if self.layouts[name].part_by:
            raise ValueError(f"{name} is rewritten in parts; sketches of rows that are gone cannot be taken back")
        v = self.visible(name)
        return statistics.summary(self.table("statistics").filter((F.col("table_name") == name) & F.col("of_load").between(v.first, v.last)))

    # --- parts ------------------------------------------------------------------------------
    def part_of(self, name: str) -> Column:
        """The part a row of a table in parts belongs to."""
        layout = self.layouts[name]
        return F.pmod(F.xxhash64(*layout.part_by), F.lit(layout.parts)).cast("int")

    def touched(self, name: str, rows: DataFrame) -> list[int]:
        """The parts that the keys of ``rows`` fall into, at most as many as the table has."""
        kinds = {f.name: f.dataType for f in self.schemas[name]}
        keys = rows.select([F.col(c).cast(kinds[c]).alias(c) for c in self.layouts[name].part_by])
        return sorted(r[0] for r in keys.select(self.part_of(name)).distinct().collect())

    def rows_of_parts(self, name: str, parts: Sequence[int]) -> DataFrame:
        """The stored rows of some parts; the others' files are not read."""
        loads = dict(enumerate(self.visible(name).parts))
        counts = F.lit(False)
        for load in {loads.get(p, 0) for p in parts}:
            counts = counts | ((F.col(LOAD) == load) & F.col(PART).isin([p for p in parts if loads.get(p, 0) == load]))
        return self.spark.table(self.stored(name)).filter(counts).select(self.schemas[name].fieldNames())

    # --- loads ------------------------------------------------------------------------------
    @contextmanager
    def load(self) -> Iterator[Load]:
        """A load whose tables change when its ``publish`` is called, or not at all."""
        now, before = self._states()
        number = 1 + max((max(v.last, *v.parts, 0) for v in now.values()), default=0)
        self._remove_unseen(number, (now, before))
        yield Load(self, number, now)

    def _remove_unseen(self, number: int, states: Sequence[Mapping[str, Visible]]) -> None:
        """Delete the folders of broken loads, and those that counted neither in the last release nor in the one before.

        A query that began under the last release can still read its files.
        """
        jvm = self.spark._jvm
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        for name, layout in self.layouts.items():
            described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.stored(name)}").filter("col_name = 'Location'").first()
            pattern = f"{described['data_type']}/{f'{PART}=*/' if layout.part_by else ''}{LOAD}=*"
            place = jvm.org.apache.hadoop.fs.Path(pattern)
            fs = place.getFileSystem(conf)
            for status in fs.globStatus(place) or ():
                folder = status.getPath()
                load = int(folder.getName().split("=")[1])
                part = int(folder.getParent().getName().split("=")[1]) if layout.part_by else None

                def counts(state: Mapping[str, Visible]) -> bool:
                    v = state.get(name, Visible())
                    return v.first <= load <= v.last if part is None else part < len(v.parts) and v.parts[part] == load

                if load >= number or not any(map(counts, states)):
                    fs.delete(folder, True)
            self.spark.catalog.refreshTable(self.stored(name))


@dataclass
class Load:
    """One load of a database; see ``Releases.load``."""

    releases: Releases
    number: int
    before: dict[str, Visible]
    after: dict[str, Visible] = field(default_factory=dict)
    seen: dict[str, dict[str, int]] = field(default_factory=dict)
    sketched: list[tuple] = field(default_factory=list)

    def write(
        self, name: str, rows: DataFrame, keep: bool = True, rules: Mapping | None = None, note: str = "",
        parts: Sequence[int] | None = None, computed: Mapping[str, Column] | None = None,
    ) -> None:
        """Write the rows of a table, by position, where readers do not look yet.

        ``computed`` columns follow from other columns of the table: they are not shuffled, but computed where the rows
        are written.

        With ``keep`` they count beside the stored rows, else instead of them; a table in parts gets all rows of
        ``parts``, and its other parts stay. While the rows are written they are counted, and so are the violations of
        ``rules``' NOT NULL and length limits.
        """
        r, layout, schema = self.releases, self.releases.layouts[name], self.releases.schemas[name]
        if len(schema) != len(rows.columns):
            raise ValueError(f"{name} has {len(schema)} columns, the rows have {len(rows.columns)}")
        fitted = rows.select([F.col(f"`{c}`").cast(f.dataType).alias(f.name) for c, f in zip(rows.columns, schema)])
        fitted = fitted.drop(*computed or ())
        if layout.part_by:
            if parts is None:
                raise ValueError(f"{name} is written in parts")
            fitted = fitted.withColumn(PART, r.part_of(name)).hint("rebalance", PART)
        elif layout.bucket_by:  # one task a bucket, more for a bucket that holds much of the rows
            fitted = fitted.hint("rebalance", layout.buckets, *layout.bucket_by)
        if computed:
            extra = [PART] * bool(layout.part_by)
            fitted = fitted.withColumns(dict(computed)).select(*schema.fieldNames(), *extra)
        observation = Observation()
        rules = quality.row_counters(rules or {})
        sketches = statistics.counters(schema, layout.statistics)
        counters = {"rows": F.count(F.lit(1))} | rules | sketches
        observed = fitted.observe(observation, *[c.alias(n) for n, c in counters.items()])
        observed.withColumn(LOAD, F.lit(self.number)).write.insertInto(r.stored(name))
        found = observation.get
        self.seen[name] = {c: found[c] for c in ("rows", *rules)}
        self.sketched += statistics.rows_of(name, self.number, found["rows"], layout.statistics, found)
        was = self.before.get(name, Visible())
        if layout.part_by:
            now = list(was.parts) or [0] * layout.parts
            for part in parts or ():
                now[part] = self.number
            self.after[name] = Visible(1, self.number, tuple(now), note)
        else:
            self.after[name] = Visible(was.first if keep and was.last else self.number, self.number, note=note)

    def rows(self, name: str) -> DataFrame:
        """The rows that this load has written to a table."""
        return self.releases.spark.table(self.releases.stored(name)).filter(F.col(LOAD) == self.number).select(
            self.releases.schemas[name].fieldNames())

    def violations(self, name: str) -> dict[str, int]:
        """Violations that were counted while the table was written, by constraint."""
        return {c: n for c, n in self.seen[name].items() if c != "rows"}

    def note(self, name: str, note: str) -> None:
        """What the rows of a table that was written stand for; a later load finds it in ``visible``."""
        self.after[name] = replace(self.after[name], note=note)

    def enforce(self) -> None:
        """Raise if a row that was written breaks a rule."""
        broken = [f"{t}: {c}: {n} rows" for t in self.seen for c, n in self.violations(t).items() if n]
        if broken:
            raise quality.QualityError("; ".join(broken))

    def publish(self) -> None:
        """Let readers see what was written, in all tables at once."""
        if self.sketched:  # a row per column
            self.write("statistics", self.releases.spark.createDataFrame(self.sketched, statistics.SCHEMA).coalesce(1))
        # Tables that did not change keep their range; the number counts on through those that did.
        now = self.before | self.after
        for name in self.after:
            self.releases.spark.catalog.refreshTable(self.releases.stored(name))
        self.releases._set(now, self.before)

