import os
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rows import observation, weather, write_documents
from stormfare.config import Settings
from stormfare.operators import weather as ops
from stormfare.schemas import DIM_WEATHER
from stormfare.sources.spine import missing_hours, observed_hours, period_hours
from stormfare.sources.weather_json import LINES, read_weather, union_by_name


def test_flatten_edges(spark):
    raw = weather(
        spark,
        observation("2024-01-15T14:00:00", main=None),
        observation("2024-01-15T15:00:00", main="Clouds", category="Nuageux"),
        observation("not a time"),
        observation("2024-01-15T16:00:00", temp="warm"),
    )
    rows = ops.flatten(raw).collect()
    assert rows[0].weather_category == "Autre" and rows[0].weather_main is None
    assert rows[1].weather_category == "Nuageux"
    assert rows[2].observation_ts is None
    assert rows[3].temp_celsius is None
    assert ops.valid(ops.flatten(raw)).count() == 2


@pytest.mark.parametrize("main, label", [
    ("Thunderstorm", "Orageux"), ("Drizzle", "Pluvieux"), ("Snow", "Pluvieux"),
    ("Clouds", "Clair"), ("Mist", "Autre"), (None, "Autre"),
])
def test_fallback_category(spark, main, label):
    row = ops.flatten(weather(spark, observation("2024-01-15T14:00:00", main=main))).first()
    assert row.weather_category == label


def test_first_per_hour_is_the_earliest_with_the_lowest_id(spark):
    documents = [
        observation("2024-01-15T14:20:00", ident=1, temp=1.0),
        observation("2024-01-15T14:00:00", ident=9, temp=2.0),
        observation("2024-01-15T14:00:00", ident=4, temp=3.0),
        observation("2024-01-15T15:00:00", ident=2, temp=4.0),
    ]
    for order in (documents, documents[::-1]):
        rows = ops.dim_weather(weather(spark, *order)).orderBy("observation_ts").collect()
        assert [(r.observation_ts, r.temp_celsius) for r in rows] == [
            (datetime(2024, 1, 15, 14), 3.0), (datetime(2024, 1, 15, 15), 4.0),
        ]
    report = ops.dedup_report(weather(spark, *documents)).first()
    assert (report.rows_in, report.rows_out, report.duplicates) == (4, 2, 2)


def test_dimension_has_the_contract(spark):
    dim = ops.dim_weather(weather(spark, observation("2024-01-15T14:00:00")))
    assert dim.columns == DIM_WEATHER.names and len(dim.columns) == 17
    row = dim.first()
    assert row.temp_feels_like == 1.3 and row.wind_speed_ms == 4.2


def test_union_by_name_fills_nested_fields(spark):
    full = weather(spark, observation("2024-01-15T14:00:00"))
    narrow = full.withColumn("wind", F.col("wind").dropFields("deg"))
    degrees = [r[0] for r in union_by_name([full, narrow]).select("wind.deg").collect()]
    assert sorted(degrees, key=str) == [270, None]


def test_shares_add_up(spark):
    raw = weather(
        spark,
        *(observation(f"2024-01-15T0{h}:00:00", main="Rain") for h in range(3)),
        observation("2024-01-15T09:00:00", main="Mist"),
    )
    rows = ops.category_share(ops.dim_weather(raw)).collect()
    assert [(r.weather_category, r.share_pct) for r in rows] == [("Pluvieux", 75.0), ("Autre", 25.0)]


@pytest.mark.parametrize("plain", [False, True])
def test_reading_pretty_files_month_by_month(spark, folder, plain):
    documents = [observation(f"2024-0{m}-03T0{h}:00:00", ident=h) for m in (1, 2) for h in range(3)]
    write_documents(folder, documents, plain)
    settings = replace(Settings(), weather_path=folder)
    with pytest.raises(FileNotFoundError, match="2024-03"):
        read_weather(spark, settings, plain=plain)
    read = read_weather(spark, settings, plain=plain, allow_partial=True)
    assert set(read.failed) == {"2024-03"}
    dim = ops.dim_weather(read.observations)
    assert dim.count() == 6
    assert all(r.source_file.endswith(".json") for r in dim.collect())
    assert read.quarantine.count() == 0


def test_nothing_to_read_is_an_error(spark, folder):
    settings = replace(Settings(), weather_path=folder)
    with pytest.raises(FileNotFoundError):
        read_weather(spark, settings, allow_partial=True)


def test_broken_files_are_quarantined(spark, folder):
    write_documents(folder, [observation("2024-01-03T00:00:00"), observation("2024-01-04T00:00:00")])
    broken = os.path.join(folder, "year=2024", "month=1", "day=3", "broken.json")
    with open(broken, "w") as out:
        out.write('{"main": {"temp": ')
    settings = replace(Settings(), months=(1,), weather_path=folder)
    read = read_weather(spark, settings)
    assert read.observations.count() == 2
    assert [r.source_file.rsplit("/", 1)[1] for r in read.quarantine.collect()] == ["broken.json"]


def test_inferred_schema_gives_the_same_table(spark, folder):
    documents = [observation(f"2024-01-03T0{h}:00:00", ident=h, category="Clair") for h in range(3)]
    write_documents(folder, documents)
    settings = replace(Settings(), months=(1,), weather_path=folder)
    drop = ("ingested_at",)
    explicit = ops.dim_weather(read_weather(spark, settings).observations).drop(*drop)
    inferred = ops.dim_weather(read_weather(spark, settings, infer=True).observations).drop(*drop)
    assert sorted(explicit.collect()) == sorted(inferred.collect())


def test_lines_and_pretty_agree(spark, folder):
    documents = [observation(f"2024-01-03T0{h}:00:00", ident=h) for h in range(3)]
    write_documents(f"{folder}/pretty", documents)
    target = f"{folder}/lines/year=2024/month=1"
    weather(spark, *documents).coalesce(1).write.json(target)
    tables = []
    for name, style in (("pretty", "pretty"), ("lines", LINES)):
        settings = replace(Settings(), months=(1,), weather_path=f"{folder}/{name}")
        read = read_weather(spark, settings, style=style)
        tables.append(sorted(ops.dim_weather(read.observations).drop("ingested_at", "source_file").collect()))
    assert tables[0] == tables[1] and len(tables[0]) == 3


def test_hour_series(spark):
    hours = period_hours(spark, Settings())
    assert hours.count() == 2184
    dim = ops.dim_weather(weather(
        spark, observation("2024-01-01T00:10:00"), observation("2024-01-01T03:00:00")
    ))
    assert observed_hours(dim, "observation_hour").count() == 4
    gaps = missing_hours(observed_hours(dim, "observation_hour"), dim, "observation_hour")
    assert sorted(r[0].hour for r in gaps.collect()) == [1, 2]
    assert missing_hours(hours, dim, "observation_hour").count() == 2182
