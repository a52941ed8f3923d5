import os
import shutil
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from rows import trips
from stormfare.config import Settings
from stormfare.operators import trips as trip_ops
from stormfare.schemas import FACT_TRIPS, Contract
from stormfare.sinks.jdbc import JdbcTarget, write_jdbc
from stormfare.sinks.tables import write_table
from stormfare.session import written
from stormfare.sources import catalog, layout, manifest
from stormfare.sources.files import listing
from stormfare.sources.trips import file_row_counts, missing_columns, read_trips, validate_months

S = Settings()
DAYS = [datetime(2024, 1, 3, 10), datetime(2024, 1, 4, 10), datetime(2024, 2, 5, 10)]


def dated(spark, days=DAYS):
    return trips(spark, *(
        {"tpep_pickup_datetime": d, "tpep_dropoff_datetime": d + timedelta(minutes=9)} for d in days
    ))


def written_by_date(spark, folder):
    layout.write_by_date(dated(spark), folder, "tpep_pickup_datetime")
    return replace(S, trip_path=folder)


def test_layout_prunes_partitions(spark, folder, capsys):
    settings = replace(written_by_date(spark, folder), months=(2,))
    files = spark.read.parquet(folder).filter(layout.in_months(settings))
    files.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(year" in plan and files.count() == 1
    assert len(set(files.inputFiles())) == 3  # before pruning
    assert files.select(F.input_file_name()).distinct().count() == 1


def test_read_trips_takes_only_the_months(spark, folder):
    settings = replace(written_by_date(spark, folder), months=(1,))
    found = read_trips(spark, settings)
    assert found.count() == 2
    assert sum(r.rows for r in file_row_counts(found).collect()) == 2
    fact = trip_ops.fact_trips(trip_ops.clean(found, settings), settings)
    assert all(r.source_file.endswith(".parquet") for r in fact.collect())


def test_plain_layout(spark, folder):
    for month in (1, 2):
        rows = dated(spark, [datetime(2024, month, 3, 10)])
        rows.write.parquet(f"{folder}/2024/{month:02d}")
    settings = replace(S, months=(1, 2), trip_path=folder)
    assert read_trips(spark, settings, plain=True).count() == 2


def test_types_of_other_feeds_are_accepted(spark, folder):
    other = dated(spark).withColumns({
        "passenger_count": F.col("passenger_count").cast("double"),
        "PULocationID": F.col("PULocationID").cast("long"),
    })
    other.coalesce(1).write.parquet(f"{folder}/2024/01")
    settings = replace(S, months=(1,), trip_path=folder)
    fact = trip_ops.fact_trips(read_trips(spark, settings, plain=True), settings)
    assert [f.dataType for f in fact.schema] == [t for _, t in FACT_TRIPS.columns]


def test_months_of_different_types_are_one_table(spark, folder):
    for month, kind in ((1, "bigint"), (2, "double"), (3, "int")):
        rows = dated(spark, [datetime(2024, month, 3, 10)]).coalesce(1)
        rows.withColumn("passenger_count", F.col("passenger_count").cast(kind)).write.parquet(
            f"{folder}/2024/{month:02d}")
    settings = replace(S, months=(1, 2, 3), trip_path=folder)
    found = trip_ops.clean(read_trips(spark, settings, plain=True), settings)
    assert [r.passenger_count for r in found.collect()] == [1, 1, 1]
    assert {r.status for r in validate_months(spark, settings, plain=True).collect()} == {"SUCCESS"}


def test_validation_reports_every_month(spark, folder):
    written_by_date(spark, f"{folder}/t")
    spark.read.parquet(f"{folder}/t/year=2024/month=2").drop("fare_amount").write.parquet(
        f"{folder}/t/year=2024/month=3")
    settings = replace(S, months=(1, 2, 3, 4), trip_path=f"{folder}/t")
    rows = {r.month: r for r in validate_months(spark, settings).collect()}
    assert (rows["2024-01"].status, rows["2024-01"].rows) == ("SUCCESS", 2)
    assert rows["2024-02"].status == "SUCCESS"
    assert rows["2024-03"].status == "FAILED"
    assert rows["2024-03"].error.startswith("year=2024/month=3/part")
    assert rows["2024-03"].error.endswith(".parquet: missing columns: fare_amount")
    assert (rows["2024-04"].status, rows["2024-04"].error) == ("FAILED", "PATH_NOT_FOUND")
    summary = manifest.ingest_summary(validate_months(spark, settings)).first()
    assert (summary.months, summary.succeeded, summary.failed, summary.rows) == (4, 2, 2, 3)


@pytest.mark.parametrize("bad_first", [True, False])
@pytest.mark.parametrize("change, error", [
    (lambda df: df.drop("fare_amount"), "missing columns: fare_amount"),
    (lambda df: df.withColumn("fare_amount", F.lit("ten")), "wrong types: fare_amount string"),
])
def test_one_bad_file_fails_its_month_by_any_name(spark, folder, bad_first, change, error):
    names = ("a", "b") if bad_first else ("b", "a")
    rows = dated(spark, [DAYS[0]]).coalesce(1)
    change(rows).write.parquet(f"{folder}/2024/01/{names[0]}")
    rows.write.parquet(f"{folder}/2024/01/{names[1]}")
    settings = replace(S, months=(1,), trip_path=folder)
    row = validate_months(spark, settings, plain=True).first()
    assert (row.status, row.rows, row.files) == ("FAILED", 1, 2)
    assert row.error.startswith(f"2024/01/{names[0]}/part") and row.error.endswith(error)
    with pytest.raises(ValueError, match=f"2024/01/{names[0]}/part.*{error}"):
        read_trips(spark, settings, plain=True)


def test_empty_month_fails(spark, folder):
    dated(spark).limit(0).write.parquet(f"{folder}/2024/01")
    settings = replace(S, months=(1,), trip_path=folder)
    row = validate_months(spark, settings, plain=True).first()
    assert row.status == "FAILED" and row.error.endswith(".parquet: empty")


def test_unreadable_file_fails_its_month_only(spark, folder):
    for month in (1, 2):
        one_file = dated(spark, [datetime(2024, month, 3, 10)]).coalesce(1)
        one_file.write.parquet(f"{folder}/2024/{month:02d}")
    with open(f"{folder}/2024/02/x.parquet", "w") as out:
        out.write("not parquet")
    settings = replace(S, months=(1, 2), trip_path=folder)
    rows = {r.month: r for r in validate_months(spark, settings, plain=True).collect()}
    assert rows["2024-01"].status == "SUCCESS"
    assert (rows["2024-02"].status, rows["2024-02"].rows) == ("FAILED", 1)
    assert rows["2024-02"].error == "2024/02/x.parquet: unreadable"


def test_missing_columns(spark):
    assert missing_columns(trips(spark, {})) == []
    assert missing_columns(trips(spark, {}).drop("tip_amount", "fare_amount")) == [
        "fare_amount", "tip_amount"]


def states(before, after):
    return {r.file: r.state for r in manifest.compare_manifests(before, after).collect()}


def test_manifest_and_comparison(spark, folder):
    def put(name, *rows):
        df = spark.createDataFrame(list(rows), "a string, b string").coalesce(1)
        df.write.mode("overwrite").parquet(f"{folder}/{name}")

    def kept():
        return spark.createDataFrame(manifest.folder_manifest(manifest.file_manifest(spark, folder)).collect())

    put("same", ("1", "2"), ("3", "4"))
    put("lost", ("1", "2"))
    put("text", ("x|y", "z"))
    put("null", (None, "z"))
    put("cut", ("xy", "z"))
    before = kept()
    assert {r.file: r.rows for r in before.collect()}["same"] == 2
    put("same", ("3", "4"), ("1", "2"))
    put("text", ("x", "y|z"))
    put("null", ("", "z"))
    put("cut", ("x", "yz"))
    put("more", ("1", "2"))
    os.rename(f"{folder}/lost", f"{folder}/_lost")  # names with an underscore are not listed
    assert states(before, kept()) == {
        "same": "same", "lost": "missing", "text": "changed", "null": "changed", "cut": "changed", "more": "new"}


def test_a_file_without_digest_is_never_the_same(spark, folder):
    with open(f"{folder}/a.parquet", "w") as out:
        out.write("one")
    found = manifest.file_manifest(spark, folder)
    row = found.first()
    assert (row.file, row.length, row.rows, row.digest) == ("a.parquet", 3, None, None)
    assert states(found, found) == {"a.parquet": "unverified"}


def test_sizes_are_checked_against_the_manifest(spark, folder):
    dated(spark).coalesce(1).write.parquet(f"{folder}/t")
    kept = spark.createDataFrame(manifest.file_manifest(spark, f"{folder}/t").collect())
    assert manifest.size_differences(kept, listing(spark, f"{folder}/t"), f"{folder}/t").count() == 0
    dated(spark).coalesce(1).write.mode("append").parquet(f"{folder}/t")
    assert manifest.size_differences(kept, listing(spark, f"{folder}/t"), f"{folder}/t").count() == 1


def test_month_sizes(spark):
    files = [("year=2024/month=1/day=3/a", 1048576), ("2024/01/04/b", 1048576), ("2024/02/c", 524288)]
    df = spark.createDataFrame(files, "file string, length long")
    assert {r.month: r.size_mb for r in manifest.month_sizes(df).collect()} == {
        "2024-01": 2.0, "2024-02": 0.5}


def test_fingerprint_ignores_order(spark):
    df = spark.range(100).selectExpr("id", "cast(id % 7 as string) AS s")
    def mark(x):
        return tuple(x.agg(*manifest.row_fingerprint("id", "s")).first())
    assert mark(df) == mark(df.orderBy(F.desc("id")).repartition(5))
    assert mark(df) != mark(df.withColumn("s", F.lit("x")))


def test_write_is_idempotent_and_counts(spark, folder):
    fact = trip_ops.fact_trips(dated(spark), S)
    for _ in range(2):
        report = write_table(fact, f"{folder}/f", FACT_TRIPS, ("pickup_date",), gather=True,
                             sort_by=("pickup_datetime",))
    assert (report.rows, report.broken) == (3, {})
    assert report.rows_per_second > 0
    assert spark.read.parquet(f"{folder}/f").count() == 3


def test_period_reload_keeps_other_partitions(spark, folder):
    write_table(trip_ops.fact_trips(dated(spark), S), f"{folder}/f", FACT_TRIPS, ("pickup_date",))
    again = trip_ops.fact_trips(dated(spark, [DAYS[0], DAYS[0] + timedelta(hours=1)]), S)
    write_table(again, f"{folder}/f", FACT_TRIPS, ("pickup_date",), only_these_partitions=True)
    counts = spark.read.parquet(f"{folder}/f").groupBy("pickup_date").count().orderBy("pickup_date")
    assert [r["count"] for r in counts.collect()] == [2, 1, 1]


def test_contract(spark, folder):
    kinds = (("a", FACT_TRIPS.columns[17][1]), ("b", FACT_TRIPS.columns[4][1]))
    contract = Contract("t", kinds, required=("a",), max_length=(("b", 3),))
    df = spark.createDataFrame([("long text", 1), ("ok", None)], "b string, a long")
    assert contract.conform(df).columns == ["a", "b"]
    report = write_table(df, f"{folder}/t", contract)
    assert report.broken == {"a__null": 1, "b__too_long": 1}
    with pytest.raises(ValueError, match="missing columns"):
        contract.conform(df.drop("a"))
    with pytest.raises(Exception, match="t: b is longer than 3"):
        contract.enforce(df.filter("a = 1")).collect()
    with pytest.raises(Exception, match="t: a is null"):
        contract.enforce(df.filter("a IS NULL")).collect()
    with pytest.raises(Exception, match="t: (a is null|b is longer than 3)"):
        write_table(df, f"{folder}/strict", contract, strict=True)
    assert contract.enforce(df.withColumns({"a": F.lit(1), "b": F.lit("x")})).count() == 2


def test_jdbc_options(spark, monkeypatch):
    """The call as it leaves for the driver; no database takes part."""
    seen = {}
    options = {}
    plain_option = DataFrameWriter.option
    monkeypatch.setattr(
        DataFrameWriter, "option",
        lambda self, k, v: options.update({k: v}) or plain_option(self, k, v))
    monkeypatch.setattr(
        DataFrameWriter, "jdbc",
        lambda self, url, table, mode=None, properties=None: seen.update(
            url=url, table=table, properties=properties, tasks=self._df.rdd.getNumPartitions()))
    target = JdbcTarget("jdbc:x", "raw.fact", connections=3, batch_rows=500, properties={"user": "u"})
    write_jdbc(spark.range(10), target)
    assert seen == {"url": "jdbc:x", "table": "raw.fact", "properties": {"user": "u"}, "tasks": 3}
    assert options == {"truncate": True, "batchsize": 500}


def test_views_and_sql(spark):
    catalog.register(spark, {"numbers": spark.range(5)})
    assert catalog.query(spark, "SELECT sum(id) AS s FROM numbers").first().s == 10
    other = spark.range(3)
    assert catalog.query(spark, "SELECT count(*) AS n FROM {other}", other=other).first().n == 3


def test_a_new_manifest_opens_only_files_that_changed(spark, folder, monkeypatch):
    """Folders by day in two months; a day is reloaded, one changed, one added, one taken away."""
    looked_at, plain = [], manifest.with_schemas

    def opened_files(spark, files):
        found = plain(spark, files)
        looked_at.append([f.path for f in found])
        return found

    monkeypatch.setattr(manifest, "with_schemas", opened_files)
    rows = spark.range(600).select(
        "id", (F.col("id") % 2 + 1).alias("month"), (F.col("id") % 6 + 1).alias("day"), F.lit("é").alias("text"))

    def load(df):
        (df.repartition("month", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("month", "day").parquet(folder + "/t"))

    load(rows)
    before = written(manifest.update_manifest(spark, folder + "/t").drop("fresh"), "before")
    again = manifest.update_manifest(spark, folder + "/t", before)
    assert again.filter("fresh").count() == 0 and looked_at[-1] == []
    load(rows.filter("day = 1"))
    load(rows.filter("day = 2").withColumn("id", F.col("id") + 1))
    load(rows.filter("day = 3").withColumn("day", F.lit(9)))
    shutil.rmtree(folder + "/t/month=2/day=4")
    after = written(manifest.update_manifest(spark, folder + "/t", before), "after")
    opened = {r.file.rsplit("/", 1)[0] for r in after.filter("fresh").collect()}
    assert opened == {"month=1/day=1", "month=2/day=2", "month=1/day=9"} and len(looked_at[-1]) == 3
    whole = manifest.file_manifest(spark, folder + "/t")
    assert sorted(map(tuple, whole.collect())) == sorted(
        map(tuple, after.select("file", "length", "rows", "digest").collect()))
    trees = [manifest.digest_tree(m) for m in (before, after)]
    changed = {(r.level, r.folder) for r in manifest.differing_folders(*trees, 2).collect()}
    assert changed == {(0, ""), (1, "month=1"), (1, "month=2"), (2, "month=1/day=9"), (2, "month=2/day=2"), (2, "month=2/day=4")}
    root = trees[0].filter("level = 0").first()
    assert root.rows == 600 and root.digest is not None
    assert manifest.differing_folders(trees[0], trees[0], 2).count() == 0


def test_footers_of_small_files_tell_the_schemas_that_the_reader_finds(spark, folder, monkeypatch):
    """Spark's files and others, many columns and kinds, an unreadable one: no job for each, the same schemas."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from stormfare.sources import files

    made = spark.range(40).select(
        "id", F.col("id").cast("int").alias("i"), F.col("id").cast("smallint").alias("s"), F.lit("a").alias("t"),
        F.lit(1.5).alias("d"), F.lit(1.5).cast("float").alias("f"), F.lit(True).alias("b"),
        F.current_date().alias("day"), F.current_timestamp().alias("ts"),
        F.current_timestamp().cast("timestamp_ntz").alias("ntz"), F.array(F.lit(1)).alias("many"),
        F.lit(1).cast("decimal(9,2)").alias("dec"))
    made.repartition(20).write.parquet(f"{folder}/own")
    moment = datetime(2024, 1, 7, 14)
    plain = {"a": [1, 2], "x": ["u", None], "d": [1.5, 2.0], "flag": [True, None], "day": [moment.date()] * 2}
    pq.write_table(pa.table({**plain, "ts": pa.array([moment] * 2, pa.timestamp("us")),
                             "utc": pa.array([moment] * 2, pa.timestamp("ms", "UTC"))}), f"{folder}/foreign.parquet")
    pq.write_table(pa.table({"nested": [{"k": 1}], "n": pa.array([1], pa.uint16())}), f"{folder}/nested.parquet")
    with open(f"{folder}/broken.parquet", "wb") as file:
        file.write(b"PAR1 no footer")
    asked, plainly = [], files._schema
    monkeypatch.setattr(files, "_schema", lambda spark, path: asked.append(path) or plainly(spark, path))
    found = {f.path: f.schema for f in files.list_parquet(spark, folder)}
    assert sorted(p.rsplit("/", 1)[1] for p in asked) == ["broken.parquet", "nested.parquet"]
    assert len(found) > 12
    for path, schema in found.items():
        assert schema == plainly(spark, path)
    monkeypatch.setattr(files, "SMALL_BYTES", -1)
    assert {f.path: f.schema for f in files.list_parquet(spark, folder)} == found
