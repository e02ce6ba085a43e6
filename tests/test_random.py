"""Key-conflict rules against row-by-row loops on random rows."""

from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st

from starloom.operators import conflicts

KEY = st.one_of(st.none(), st.integers(0, 3))
ROW = st.tuples(KEY, st.integers(0, 4), st.sampled_from(["a", "b", None]), st.sampled_from(["free", "paid"]))
ROWS = st.lists(ROW, max_size=25)
SCHEMA = "k int, t int, v string, level string"
FEW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def arrival(row):
    """Order of arrival: time, then the remaining columns, nulls first."""
    return [(value is not None, value) for value in row[1:]]


@FEW
@given(data=ROWS)
def test_keep_first_and_last(spark, data):
    first, last = {}, {}
    for row in sorted(data, key=arrival):
        first.setdefault(row[0], row)
        last[row[0]] = row
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(conflicts.keep_first(df, ["k"], ["t"])) == sorted(first.values(), key=repr)
    assert rows(conflicts.keep_last(df, ["k"], ["t"])) == sorted(last.values(), key=repr)


@FEW
@given(old=ROWS, new=ROWS)
def test_insert_if_absent(spark, old, new):
    stored = {}
    for row in sorted(old, key=arrival):
        stored.setdefault(row[0], row)
    expected = {}
    for row in sorted(new, key=arrival):
        if row[0] not in stored:
            expected.setdefault(row[0], row)
    existing = spark.createDataFrame(list(stored.values()), SCHEMA)
    added = conflicts.insert_if_absent(spark.createDataFrame(new, SCHEMA), existing, ["k"], ["t"])
    assert rows(added) == sorted(expected.values(), key=repr)


@FEW
@given(batches=st.lists(ROWS, min_size=1, max_size=3))
def test_upsert_of_one_column(spark, batches):
    loop, merged = {}, None
    for batch in batches:
        for key, _, value, level in sorted(batch, key=lambda r: (arrival(r)[0], r[2] is not None, r[2] or "", r[3])):
            loop[key] = (key, loop[key][1], level) if key in loop else (key, value, level)
        merged = conflicts.upsert_columns(spark.createDataFrame(batch, SCHEMA), merged, ["k"], ["t"], ["level"])
    found = {r["k"]: (r["k"], r["v"]) for r in merged.collect()}
    assert found == {key: row[:2] for key, row in loop.items()}
    # rows of one time are ordered by the updated column first when the last one is picked
    for row in merged.collect():
        latest = [b for b in batches if any(r[0] == row["k"] for r in b)][-1]
        newest = max(r[1] for r in latest if r[0] == row["k"])
        assert row["level"] == max(r[3] for r in latest if r[0] == row["k"] and r[1] == newest)
