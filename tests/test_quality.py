import pytest

from checks.registry import SETTINGS, Tables, numbered_enriched
from stormfare.operators import quality as q

SMALL = "/root/testdata/sf0.001"


def suite(spark, rows, checks):
    table = spark.createDataFrame(rows, "id int, label string")
    found = q.run_suite({"t": table}, checks).collect()
    return {(r.column_name, r.test): (r.failures, r.status) for r in found}


def test_each_kind_counts_its_failures(spark):
    rows = [(1, "a"), (1, "b"), (2, None), (None, "z"), (None, "a")]
    checks = [
        q.Check("t", "id", q.UNIQUE), q.Check("t", "id", q.NOT_NULL),
        q.Check("t", "label", q.NOT_NULL), q.Check("t", "label", q.ACCEPTED, ("a", "b")),
    ]
    assert suite(spark, rows, checks) == {
        ("id", "unique"): (1, "FAIL"), ("id", "not_null"): (2, "FAIL"),
        ("label", "not_null"): (1, "FAIL"), ("label", "accepted_values"): (1, "FAIL"),
    }
    assert {s for _, s in suite(spark, [], checks).values()} == {"PASS"}


def test_relationship(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "k int")
    check = q.Check("child", "k", q.RELATION, parent=("parent", "k"))
    row = q.run_suite({"child": child, "parent": parent}, [check]).first()
    assert (row.failures, row.status) == (2, "FAIL")


def test_all_twenty_five_tests_run(spark):
    t = Tables(spark, SMALL)
    tables = {**t.curated, "trip_enriched": numbered_enriched(t)}
    rows = q.run_suite(tables, q.CURATED_CHECKS).collect()
    assert len(rows) == 25
    failed = {(r.table_name, r.column_name, r.test) for r in rows if r.status == "FAIL"}
    # 'Autre' is accepted in the dimension and not in the mart.
    assert failed <= {("trip_enriched", "weather_category", "accepted_values")}


def test_gates(spark):
    tables = {"a": spark.range(3), "b": spark.range(0), "c": spark.range(300)}
    gate = q.row_count_gate(tables, {"a": 10, "b": 10, "c": 10})
    assert {r.table_name: r.status for r in gate.collect()} == {"a": "LOW", "b": "EMPTY", "c": "OK"}
    with pytest.raises(q.GateFailure, match="a: 3 rows, LOW; b: 0 rows, EMPTY"):
        q.require(gate)
    q.require(q.row_count_gate(tables, {"c": 10}))


def test_weather_gate(spark):
    weather = Tables(spark, SMALL).weather
    row = q.weather_gate(weather, 10).first()
    assert row.status == "PASS" and row.categories_present == 4
    assert q.weather_gate(weather.limit(0)).first().status == "FAIL"
    assert q.weather_gate(weather.filter("weather_category <> 'Orageux'"), 10).first().status == "FAIL"
    assert SETTINGS.min_weather_rows == 100


def test_tests_counted_by_a_write_equal_those_of_the_table(spark, folder):
    from stormfare.sinks.tables import write_table

    rows = [(1, "a"), (1, "b"), (2, None), (None, "z"), (None, "a")]
    checks = [
        q.Check("t", "id", q.UNIQUE), q.Check("t", "id", q.NOT_NULL),
        q.Check("t", "label", q.NOT_NULL), q.Check("t", "label", q.ACCEPTED, ("a", "b")),
    ]
    table = spark.createDataFrame(rows, "id int, label string")
    report = write_table(table, f"{folder}/t", tested=q.row_tests("t", checks))
    stored = {"t": spark.read.parquet(f"{folder}/t")}
    assert report.tested == {"id not_null": 2, "label not_null": 1, "label accepted_values": 1}
    found = q.suite_of_writes(spark, stored, checks, {"t": report.tested})
    assert sorted(found.collect()) == sorted(q.run_suite(stored, checks).collect())
    assert sorted(q.suite_of_writes(spark, stored, checks, {}).collect()) == sorted(found.collect())
    assert q.suite_of_writes(spark, stored, checks[1:], {"t": report.tested}).count() == 3
