import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starloom.operators import conflicts, joins, loads, quality
from starloom.operators.ids import surrogate_id
from starloom.operators.quality import QualityError
from starloom.schemas import INT, STRING, table
from starloom.session import materialize


# --- key conflicts --------------------------------------------------------------------------
def test_first_and_last_by_order_then_by_row(spark):
    df = spark.createDataFrame(
        [(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, 1, None), (None, 1, "n"), (None, 2, "m")], "k int, t int, v string")
    assert rows(conflicts.keep_first(df, ["k"], ["t"])) == [(1, 3, "a"), (2, 1, None), (None, 1, "n")]
    assert rows(conflicts.keep_last(df, ["k"], ["t"])) == [(1, 5, "b"), (2, 1, None), (None, 2, "m")]
    assert conflicts.keep_first(df, ["k"], ["t"]).columns == ["k", "t", "v"]


def test_keys_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(conflicts.keep_first(df, ["k"])) == [(1,), (2,)]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with a third of the rows leaves each task as one row."""
    df = spark.range(0, 30000, 1, 8).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    last = {r["k"]: r["t"] for r in conflicts.keep_last(df, ["k"], ["t"]).collect()}
    assert len(last) == 20001 and last[-1] == 29997
    plan = conflicts.keep_last(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_insert_if_absent_twice_changes_nothing(spark):
    new = spark.createDataFrame([(1, 2, "late"), (1, 1, "early"), (3, 1, "c")], "k int, t int, v string")
    first = conflicts.insert_if_absent(new, None, ["k"], ["t"])
    assert rows(first) == [(1, 1, "early"), (3, 1, "c")]
    assert conflicts.insert_if_absent(new, first, ["k"], ["t"]).isEmpty()


def test_upsert_updates_only_the_named_columns(spark):
    columns = "user_id int, first_name string, level string, ts int"
    batch1 = spark.createDataFrame([(1, "Ann", "free", 1), (1, "Anna", "paid", 2), (2, "Bo", "free", 1)], columns)
    table1 = conflicts.upsert_columns(batch1, None, ["user_id"], ["ts"], ["level"])
    assert rows(table1) == [(1, "Ann", "paid"), (2, "Bo", "free")]
    batch2 = spark.createDataFrame([(1, "X", "free", 0), (3, "Cy", "paid", 9)], columns)
    table2 = conflicts.upsert_columns(batch2, table1, ["user_id"], ["ts"], ["level"])
    assert rows(table2) == [(1, "Ann", "free"), (2, "Bo", "free"), (3, "Cy", "paid")]
    assert rows(conflicts.upsert_columns(batch2, table2, ["user_id"], ["ts"], ["level"])) == rows(table2)


# --- ids ------------------------------------------------------------------------------------
def test_dense_ids_follow_the_order_with_a_hot_value(spark):
    values = [7] * 500 + [random.Random(1).randrange(100) for _ in range(1000)]
    df = spark.createDataFrame(list(zip(values, range(1500))), "v int, tie int").repartition(7)
    numbered = [tuple(r) for r in surrogate_id(df, "id", dense=True, order=["v"], start=1).orderBy("id").collect()]
    assert [(v, t) for v, t, _ in numbered] == sorted(zip(values, range(1500)))
    assert [i for *_, i in numbered] == list(range(1, 1501))


def test_dense_ids_of_nothing(spark):
    assert surrogate_id(spark.createDataFrame([], "v int"), "id", dense=True).collect() == []


def test_shuffled_rows_get_the_same_ids_in_any_order(spark):
    def numbered(df):
        return rows(surrogate_id(df.coalesce(1), "n", shuffled=True))

    df = spark.range(50).select(F.xxhash64("id").alias("v"))
    assert numbered(df.orderBy("v")) == numbered(df.orderBy(F.desc("v")))


def test_plain_ids_are_unique(spark):
    assert surrogate_id(spark.range(1000).repartition(5), "n").select("n").distinct().count() == 1000


# --- joins ----------------------------------------------------------------------------------
def frames(spark, left, right):
    lookup = materialize(spark.createDataFrame(right, "a string, b string, s int"), "lookup")  # a file has a known size
    return spark.createDataFrame(left, "a string, b string, n int"), lookup, left, right


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a tenth have none; the lookup repeats some keys."""
    rng = random.Random(3)
    left = [(rng.choice([("hot", "x")] * 10 + [(None, "x")] * 3 + [(f"k{rng.randrange(60)}", "x")] * 17)) + (i,) for i in range(3000)]
    right = [("hot", "x", 1), ("hot", "x", 2), (None, "x", 3)] + [(f"k{i}", "x", i) for i in range(0, 60, 2)]
    return frames(spark, left, right)


@pytest.fixture(scope="module")
def skewed_lookup(spark):
    """A third of the lookup shares one key, which few rows have; one hot key has no row at all."""
    left = [(f"k{i % 400}", "x", i) for i in range(500)] + [("hot", "x", -1), ("hot", "x", -2), (None, "x", -3)]
    left += [("both", "x", i) for i in range(1000, 1200)]
    right = [("both", "x", i) for i in range(100)] + [("hot", "x", i) for i in range(300)] + [("idle", "x", i) for i in range(300)] + [(f"k{i}", "x", i) for i in range(0, 300)]
    return frames(spark, left, right + [(None, "x", 5)])


@pytest.mark.parametrize("case", ["skewed", "skewed_lookup"])
@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
@pytest.mark.parametrize("limit,adaptive", [("10485760b", "true"), ("-1", "true"), ("-1", "false")])
def test_lookup_join_equals_nested_loops(spark, conf, request, case, how, limit, adaptive):
    conf(spark__sql__autoBroadcastJoinThreshold=limit, spark__sql__adaptive__enabled=adaptive)
    left, right, left_rows, right_rows = request.getfixturevalue(case)
    expected = []
    for a, b, n in left_rows:
        found = [s for ra, rb, s in right_rows if a is not None and (a, b) == (ra, rb)]
        if how == "left_anti":
            expected += [] if found else [(a, b, n)]
        else:
            expected += [(a, b, n, s) for s in found] or ([(a, b, n, None)] if how == "left" else [])
    joined = joins.lookup_join(left, right, ["a", "b"], how)
    assert rows(joined, "a", "b", "n", *(["s"] if how != "left_anti" else [])) == sorted(expected, key=repr)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("_part" in plan) == (limit == "-1" and how == "left" and case == "skewed_lookup")


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_hot_rows_are_split_by_adaptive_execution(spark, conf, how):
    """Also when the lookup was grouped on the join keys, which would hide its shuffle."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2", spark__sql__adaptive__advisoryPartitionSizeInBytes="20000")
    left = spark.range(0, 60000, 1, 16).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    lookup = conflicts.keep_first(left.filter("n % 2 = 0").withColumnRenamed("n", "first"), ["k"])
    joined = joins.lookup_join(left, lookup, ["k"], how, unique=True)
    assert len(joined.collect()) == (60000 if how == "left" else 20000)
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_lists_are_bounded_and_complete(spark):
    df = spark.range(10000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("h"))
    hot = [r["h"] for r in joins.hot_hashes(df, "h", 0.01).collect()]
    assert 0 in hot and len(hot) <= 100
    assert rows(joins.hot_keys(df, ["h"], 0.01)) == [(0,)]
    assert joins.hot_keys(df.limit(0), ["h"]).collect() == []


def test_join_type_is_checked(spark, skewed):
    with pytest.raises(ValueError):
        joins.lookup_join(*skewed[:2], ["a"], "full")


# --- tables and load modes ------------------------------------------------------------------
COLUMNS = table(k=INT, v=STRING)


@pytest.fixture
def database(spark, tmp_path):
    name = "db_" + tmp_path.name.replace("-", "_")
    loads.create_tables(spark, name, {"t": COLUMNS, "u": COLUMNS}, str(tmp_path / "db"))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_create_is_repeatable_and_drop_tolerates_absence(spark, database):
    loads.create_tables(spark, database, {"t": COLUMNS})
    loads.drop_tables(spark, database, ["t", "u", "gone"])
    assert spark.catalog.listTables(database) == []


def test_append_is_positional_and_repeats(spark, database):
    df = spark.createDataFrame([("1", 2)], "x string, y int")
    for _ in range(2):
        loads.append(df, f"{database}.t")
    assert rows(spark.table(f"{database}.t")) == [(1, "2"), (1, "2")]
    with pytest.raises(ValueError):
        loads.append(df.select("x"), f"{database}.t")


def test_append_new_adds_nothing_twice(spark, database):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    for _ in range(2):
        loads.append_new(df, f"{database}.t", ["k"])
    assert rows(spark.table(f"{database}.t")) == [(1, "a"), (1, "b"), (2, "c")]


def test_append_new_reads_only_the_batch_range(spark, database):
    loads.append(spark.createDataFrame([(1, "a"), (5, "b"), (9, "c")], COLUMNS), f"{database}.t")
    loads.append_new(spark.createDataFrame([(5, "b"), (6, "d")], COLUMNS), f"{database}.t", ["v"], within="k")
    assert rows(spark.table(f"{database}.t")) == [(1, "a"), (5, "b"), (6, "d"), (9, "c")]
    loads.append_new(spark.createDataFrame([], COLUMNS), f"{database}.t", ["v"], within="k")
    assert spark.table(f"{database}.t").count() == 4


def test_dimension_modes(spark, database):
    df = spark.createDataFrame([(1, "a")], COLUMNS)
    for _ in range(2):
        loads.load_dimension(df, f"{database}.t")
        loads.load_dimension(df, f"{database}.u", "delete-load")
    assert spark.table(f"{database}.t").count() == 2
    assert spark.table(f"{database}.u").count() == 1
    with pytest.raises(ValueError):
        loads.load_dimension(df, f"{database}.t", "merge")


def test_insert_columns(spark, database):
    loads.insert_columns(spark.createDataFrame([("a",)], "x string"), f"{database}.t", ["v"])
    assert rows(spark.table(f"{database}.t")) == [(None, "a")]
    with pytest.raises(ValueError):
        loads.insert_columns(spark.createDataFrame([("a",)], "x string"), f"{database}.t", ["nope"])


def test_replace_contents_from_itself(spark, database):
    name = f"{database}.t"
    loads.append(spark.createDataFrame([(1, "a"), (2, "b")], COLUMNS), name)
    loads.replace_contents(spark.table(name).filter("k = 2"), name)
    loads.refresh_statistics(spark, name)
    loads.refresh_statistics(spark, name, columns=False)
    assert rows(spark.table(name)) == [(2, "b")]


def test_refresh_partitions_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, 2018, 11), (2, 2018, 12)], "v int, year int, month int")
    loads.write_parquet(df, path, ["year", "month"])
    for _ in range(2):
        loads.write_parquet(spark.createDataFrame([(9, 2018, 12)], df.schema), path, ["year", "month"], refresh_partitions=True)
    assert rows(spark.read.parquet(path)) == [(1, 2018, 11), (9, 2018, 12)]


def test_one_file(spark, tmp_path):
    path = tmp_path / "one"
    loads.write_parquet(spark.range(100).repartition(5), str(path), files=1)
    assert len(list(path.glob("*.parquet"))) == 1


@pytest.mark.parametrize("sort_by", [(), ("v",)])
def test_hot_partition_is_written_by_several_tasks(spark, conf, tmp_path, sort_by):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="100000")
    path = tmp_path / "hot"
    df = spark.range(0, 200000, 1, 8).select(F.xxhash64("id").alias("v"), F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id") % 10).alias("p"))
    loads.write_parquet(df, str(path), ["p"], sort_by=sort_by)
    assert len(list((path / "p=1").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(path)).count() == 200000


def test_bucketed_tables_join_without_a_shuffle(spark, conf, database):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("a", "b"):
        loads.save_bucketed(spark.range(100).withColumnRenamed("id", "k"), f"{database}.{name}", 4, ["k"], ["k"])
    joined = spark.table(f"{database}.a").join(spark.table(f"{database}.b"), "k")
    assert joined.count() == 100
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


# --- quality --------------------------------------------------------------------------------
def test_quality_check(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert quality.data_quality_check(df, "k") is True
    quality.check_unique(df, "k")
    for bad, message in ((df.limit(0), "empty"), (df.union(df.filter("k IS NULL")), "not unique")):
        with pytest.raises(ValueError, match=message):
            quality.data_quality_check(bad, "k")
    with pytest.raises(QualityError):
        quality.check_unique(df.union(df), ["k"])
    with pytest.raises(QualityError):
        quality.check_not_empty(df.limit(0))


def test_sql_checks_stop_at_the_first_failure(spark):
    spark.range(3).createOrReplaceTempView("three")
    checks = quality.not_empty_checks(["three"]) + [{"check_sql": "SELECT count(*) FROM three", "comparison": "=", "expected_result": 4}]
    assert [r["passed"] for r in quality.run_sql_checks(spark, checks, stop=False).collect()] == [True, False]
    with pytest.raises(QualityError, match="3 is not = 4"):
        quality.run_sql_checks(spark, checks)
    no_rows = [{"check_sql": "SELECT id FROM three WHERE id > 9", "comparison": "!=", "expected_result": 1}]
    with pytest.raises(QualityError):
        quality.run_sql_checks(spark, no_rows)


def test_constraints(spark):
    fact = spark.createDataFrame([(1, 10, "F"), (1, 99, "FF"), (None, None, None), (2, 99, "M")], "id int, user int, gender string")
    users = spark.createDataFrame([(10,), (10,)], "user_id int")
    report = quality.check_constraints(fact, ["id"], ["id"], {"user": (users, "user_id")}, {"gender": 1})
    assert rows(report) == sorted([
        ("not null id", 1), ("length gender", 1), ("primary key id", 1), ("foreign key user", 2)], key=repr)
    with pytest.raises(QualityError, match="foreign key user: 2"):
        quality.enforce(report)
    quality.enforce(report.filter("violations = 0"))
    with pytest.raises(ValueError):
        quality.check_constraints(fact)


def test_declared_constraints(spark):
    tables = {"user": spark.createDataFrame([(1,), (1,)], "id int"), "play": spark.createDataFrame([(1, 1), (2, 7)], "id int, user int")}
    declared = {"user": {"primary_key": ["id"]}, "play": {"not_null": ["id"], "references": {"user": ("user", "id")}}}
    assert rows(quality.check_declared(tables, declared)) == [
        ("play", "foreign key user", 1), ("play", "not null id", 0), ("user", "primary key id", 1)]
    with pytest.raises(ValueError):
        quality.check_declared(tables, {})


def test_gated_write_does_not_write_bad_rows(spark):
    written = []
    with pytest.raises(QualityError):
        loads.gated_write(spark.range(0), [quality.check_not_empty], written.append)
    assert written == []
    loads.gated_write(spark.range(1), [quality.check_not_empty], written.append)
    assert len(written) == 1


# --- pruning --------------------------------------------------------------------------------
def shuffled_bytes(df):
    """What the exchanges of an executed plan have written."""
    seen, queue = 0, [df._jdf.queryExecution().executedPlan()]
    df.collect()
    while queue:
        node = queue.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            queue.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            queue.append(node.plan())
        else:
            if name == "Exchange":
                seen += node.metrics().get("shuffleBytesWritten").get().value()
            queue += [node.children().apply(i) for i in range(node.children().size())]
    return seen


def test_pruning_changes_no_row_and_shuffles_less(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    spark.range(300_000).selectExpr("if(id = 7, null, id) as k", "cast(id as string) as name").write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    batch = spark.createDataFrame([(i * 997 if i < 40 else 400_000 + i,) for i in range(80)] + [(None,), (None,)], "k int")
    plain, pruned = (conflicts.append_new(batch, stored, ["k"], prune=p) for p in (False, True))
    assert rows(plain) == rows(pruned) == [(400_000 + i,) for i in range(40, 80)]
    assert shuffled_bytes(pruned) < shuffled_bytes(plain) / 20
    assert rows(conflicts.insert_if_absent(batch, stored, ["k"], prune=True)) == rows(pruned)
    reach = joins.in_reach(stored, batch.limit(0), ["k"], bits=640)
    assert reach.count() == 0 and joins.in_reach(stored, stored, ["k"], bits=64).count() == 300_000
    two = joins.in_reach(stored, stored.limit(5), ["k", "name"])
    assert 5 <= two.count() < 100
    with pytest.raises(ValueError):
        joins.in_reach(stored, batch, ["k"], bits=100)
