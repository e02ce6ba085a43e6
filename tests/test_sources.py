import json
from datetime import datetime
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import rows

from starloom import schemas
from starloom.operators import loads
from starloom.plans.travel import build_labels
from starloom.schemas import DOUBLE, INT, SCALE0, STRING, table
from starloom.session import scratch_dir
from starloom.sources import files, labels, staging

PEOPLE = table(userId=INT, name=STRING, length=SCALE0)


def write(path, *lines, encoding="utf-8", newline="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((newline.join(lines) + newline).encode(encoding))


def test_scratch_folder_is_the_shared_one(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_own_scratch_folder_only_in_local_mode():
    def session(master):
        return SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master, applicationId=master))

    assert Path(scratch_dir(session("local[2]"))).is_dir()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("yarn"))


def test_json_tree(spark, tmp_path):
    write(tmp_path / "a" / "b" / "1.json", '{"userId": 1, "name": "x"}')
    write(tmp_path / "a" / "2.json", '{"userId": 2, "name": "y"}', '{"name": null}')
    write(tmp_path / "a" / "skip.txt", '{"userId": 3}')
    df = files.read_json(spark, str(tmp_path), table(userId=INT, name=STRING))
    assert rows(df) == sorted([(1, "x"), (2, "y"), (None, None)], key=repr)
    report = files.load_report(df).collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["row_count"]) for r in report) == [("1.json", 1), ("2.json", 2)]


def test_first_record_of_each_file(spark, conf, tmp_path):
    for name in "pqr":
        write(tmp_path / f"{name}.json", *[json.dumps({"n": n, "f": name, "pad": "x" * 50}) for n in range(200, 0, -1)])
    conf(spark__sql__files__maxPartitionBytes="2000", spark__sql__files__openCostInBytes="0")
    df = files.read_json(spark, str(tmp_path), table(n=INT, f=STRING))
    assert df.rdd.getNumPartitions() > 6
    assert rows(files.first_per_file(df)) == [(200, "p"), (200, "q"), (200, "r")]


def test_json_load_keeps_quoted_numbers_and_cuts_fractions(spark, tmp_path):
    write(tmp_path / "e.json", '{"userId": "39", "length": 231.99}', '{"userId": "", "length": "12.5"}', '{"userId": 7, "length": 1540344794796.0}')
    df = staging.load_json(spark, str(tmp_path), PEOPLE)
    assert rows(df, "userId", "length") == sorted([(39, Decimal(231)), (None, Decimal(12)), (7, Decimal(1540344794796))], key=repr)
    rounded = staging.load_json(spark, str(tmp_path), PEOPLE, rounding="half_up")
    assert rows(rounded, "length")[-1] == (Decimal(232),)


def test_json_load_with_bad_value(spark, tmp_path):
    write(tmp_path / "e.json", '{"userId": "x"}')
    assert staging.load_json(spark, str(tmp_path), PEOPLE, on_error="null").first()["userId"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.load_json(spark, str(tmp_path), PEOPLE).collect()


def test_json_paths_bind_by_position(spark, tmp_path):
    write(tmp_path / "d" / "e.json", '{"id": 4, "who": {"first": "Ann"}, "len": 9.9}', '{"id": null}', "")
    write(tmp_path / "paths.json", '{"jsonpaths": ["$[\'id\']", "$.who.first", "$.len"]}')
    paths = staging.read_json_paths(spark, str(tmp_path / "paths.json"))
    df = staging.load_json_paths(spark, str(tmp_path / "d"), paths, PEOPLE)
    assert rows(df) == sorted([(4, "Ann", Decimal(9)), (None, None, None)], key=repr)
    with pytest.raises(ValueError):
        staging.load_json_paths(spark, str(tmp_path / "d"), paths[:2], PEOPLE)


def test_invalid_bytes_are_replaced_before_parsing(spark, tmp_path):
    write(tmp_path / "s.json", '{"name": "Beyonc\xe9", "userId": 1}', encoding="latin-1")
    write(tmp_path / "t.json", '{"name": "Beyoncé", "userId": 2}')
    df = staging.load_json_repaired(spark, str(tmp_path), PEOPLE)
    assert rows(df, "userId", "name") == [(1, "Beyonc^"), (2, "Beyoncé")]


def test_scoped_path_has_no_leading_zero(spark):
    path = staging.scoped_path("log_data/{run.year}/{run.month}/", datetime(2018, 3, 9))
    assert path == "log_data/2018/3/"


def test_csv_binds_by_position_and_reads_blanks_as_null(spark, tmp_path):
    write(tmp_path / "a.csv", "whatever;n", '"x";1', '"";2', ";3")
    write(tmp_path / "sub" / "b.csv", "whatever;n", "y;4")
    df = files.read_csv(spark, str(tmp_path), table(name=STRING, n=INT), ";")
    assert rows(df) == sorted([("x", 1), (None, 2), (None, 3), ("y", 4)], key=repr)


def test_quoted_csv_roundtrip(spark, tmp_path):
    data = [("a,b", 'say "hi"'), ("two\nlines", "back\\slash"), ("plain", "x")]
    df = spark.createDataFrame(data, "p string, q string")
    loads.write_csv(df.coalesce(1), str(tmp_path / "o"))
    text = next((tmp_path / "o").glob("*.csv")).read_text()
    assert text.startswith('"p","q"\n') and '"plain","x"' in text
    assert rows(files.read_csv(spark, str(tmp_path / "o"), df.schema, multiline=True)) == sorted(data, key=repr)


def test_views_keep_partition_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "AK"), (2, "AL")], "v int, state string")
    loads.write_parquet(df, str(tmp_path / "demographic_view"), ["state"])
    files.register_views(spark, str(tmp_path), ["demographic_view"])
    result = spark.sql("SELECT v FROM demographic_view WHERE state = 'AL'")
    assert rows(result) == [(2,)]
    assert "PartitionFilters: [isnotnull(state" in result._jdf.queryExecution().executedPlan().toString()


def test_rows_from_mapping(spark):
    assert rows(files.rows_from_mapping(spark, {"AL": "ALABAMA"}, ("code", "state"))) == [("AL", "ALABAMA")]


def test_read_table_by_format_name(spark, tmp_path):
    spark.range(3).write.orc(str(tmp_path / "o"))
    assert files.read_table(spark, str(tmp_path / "o"), "orc").count() == 3


# --- code lists -----------------------------------------------------------------------------
def numbered(spark, path, **options):
    return [(r["line"], r["value"]) for r in labels.numbered_lines(spark, str(path), **options).orderBy("file", "line").collect()]


def test_line_numbers_across_splits(spark, conf, tmp_path):
    lines = [f"line {i} " + "x" * (i % 37) for i in range(1000)]
    write(tmp_path / "f" / "a.txt", *lines)
    write(tmp_path / "f" / "b.txt", *lines[:10])
    conf(spark__sql__files__maxPartitionBytes="700", spark__sql__files__openCostInBytes="0")
    assert spark.read.text(str(tmp_path / "f")).rdd.getNumPartitions() > 20
    assert numbered(spark, tmp_path / "f") == list(enumerate(lines)) + list(enumerate(lines[:10]))
    assert numbered(spark, tmp_path / "f", per_file=False) == list(enumerate(lines + lines[:10]))


LABEL_LINES = [
    "/* header", "  582 =  'MEXICO'", "  101 =  'ALBANIA  '", "   582 =  'MEXICO Air Sea = x'", "  xyz =  'nowhere'", "",
    "\t'ALC'\t=\t'ALCAN, AK             '", " 'ANC' = 'ANCHORAGE'",
    "\t'AL'='ALABAMA'", "\t'AK' =' ALASKA '",
]


def block(rules, start, end):
    return labels.LabelBlock(rules.code, rules.label, start, end, rules.code_trim, rules.label_trim)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_label_blocks(spark, tmp_path, newline):
    write(tmp_path / "l.sas", *LABEL_LINES, newline=newline)
    lines = labels.numbered_lines(spark, str(tmp_path / "l.sas"))
    countries = build_labels(lines, block(labels.COUNTRIES, 1, 6))
    assert rows(countries) == [(101, "ALBANIA  "), (582, "MEXICO Air Sea")]  # last 582 wins, cut at the second "="
    assert rows(build_labels(lines, block(labels.COUNTRIES, 1, 3), tidy=True)) == [(101, "ALBANIA"), (582, "MEXICO")]
    assert rows(build_labels(lines, block(labels.CITIES, 6, 8))) == [("ALC", "ALCAN, AK             "), ("ANC", "ANCHORAGE")]
    assert rows(build_labels(lines, block(labels.STATES, 8, 10))) == [("AK' ", " ALASKA "), ("AL", "ALABAMA")]


def test_fixed_ranges_of_the_label_file(spark):
    assert [(b.start, b.end) for b in (labels.COUNTRIES, labels.CITIES, labels.STATES)] == [(10, 298), (303, 962), (982, 1036)]


def test_schemas_cover_the_event_csv():
    assert [schemas.EVENT_CSV.fieldNames().index(c) for c in schemas.CLEAN_EVENTS] == [0, 2, 3, 4, 5, 6, 7, 8, 12, 13, 16]
    assert len(schemas.EVENT_CSV) == 17 and DOUBLE in [f.dataType for f in schemas.IMMIGRATION_SOURCE]
