import json
import os
import random
from datetime import timedelta

import pytest

from rows import observation, weather
from stormfare.operators import weather as ops
from stormfare.streaming import weather_stream as ws


def documents():
    """Several observations per hour over three days, in no order, with copies."""
    made = [
        observation(f"2024-01-{day:02d}T{hour:02d}:{minute:02d}:00", ident=1000 * day + 60 * hour + minute,
                    temp=float(minute))
        for day in (30, 31) for hour in range(0, 24, 3) for minute in (40, 5, 20)
    ]
    made += made[::5]
    random.Random(3).shuffle(made)
    return made


def drop_file(folder, number, document):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{number:04d}.json", "w") as out:
        json.dump(document, out, indent=2)


def table(spark, path):
    rows = spark.read.parquet(path).select("observation_ts", "temp_celsius", "weather_category")
    return sorted(tuple(r) for r in rows.collect())


def batch_table(spark, docs):
    dim = ops.dim_weather(weather(spark, *docs))
    return sorted(tuple(r) for r in dim.select(
        "observation_ts", "temp_celsius", "weather_category").collect())


def test_stream_equals_batch_however_late(spark, folder):
    docs = documents()
    source, path, state = f"{folder}/in", f"{folder}/table", f"{folder}/state"
    for part in (docs[:20], docs[20:]):
        for document in part:
            drop_file(source, len(os.listdir(source)) if os.path.isdir(source) else 0, document)
        raw = ws.read_weather_stream(spark, source, max_files=12)
        ws.run_available(raw, path, state)
    expected = batch_table(spark, docs)
    assert table(spark, path) == expected
    ws.run_available(ws.read_weather_stream(spark, source), path, state)  # nothing new
    assert table(spark, path) == expected
    for number, document in enumerate(docs[:7]):  # sent again under other names
        drop_file(source, 5000 + number, document)
    ws.run_available(ws.read_weather_stream(spark, source), path, state)
    assert table(spark, path) == expected
    assert len(expected) == 16


def test_merging_a_batch_twice_changes_nothing(spark, folder):
    rows = ws.observations(weather(spark, *documents()))
    ws.merge_hours(rows, f"{folder}/t")
    once = table(spark, f"{folder}/t")
    ws.merge_hours(rows, f"{folder}/t")
    assert table(spark, f"{folder}/t") == once


@pytest.mark.parametrize("build, mode", [(ws.first_arrivals, "append"), (ws.hourly_state, "update")])
def test_watermarked_variants_see_every_hour(spark, folder, build, mode):
    docs = sorted(documents(), key=lambda d: d["_metadata"]["collected_at_iso"])
    for number, document in enumerate(docs):
        drop_file(f"{folder}/in", number, document)
    out = []
    query = (
        build(ws.read_weather_stream(spark, f"{folder}/in"))
        .writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state")
        .foreachBatch(lambda df, _: out.extend(df.select("observation_hour", "observation_ts").collect()))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    expected = {r[0].replace(minute=0): r[0] for r in batch_table(spark, docs)}
    assert {r[0] for r in out} == set(expected)
    if mode == "update":
        assert {r[0]: r[1] for r in out} == expected


def test_a_micro_batch_is_parsed_once(spark, folder):
    docs = documents()
    for number, document in enumerate(docs):
        drop_file(f"{folder}/in", number, document)
    raw = ws.read_weather_stream(spark, f"{folder}/in", max_files=10)
    query = ws.run_available(raw, f"{folder}/table", f"{folder}/state")
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(progress) > 1 and sum(p["numInputRows"] for p in progress) == len(docs)


def test_rows_of_closed_hours_are_kept_aside_and_counted(spark, folder):
    """Hours close two hours after their end; a batch that runs again gives the same."""
    first = [observation(f"2024-01-30T{h:02d}:10:00", ident=h) for h in range(6)]
    second = [observation("2024-01-30T02:05:00", ident=90), observation("2024-01-30T03:05:00", ident=91),
              observation("2024-01-30T04:05:00", ident=92), observation("2024-01-30T09:00:00", ident=93)]
    path, lateness = f"{folder}/table", timedelta(hours=2)
    for number, document in enumerate(first):
        drop_file(f"{folder}/in", number, document)
    ws.run_available(ws.read_weather_stream(spark, f"{folder}/in"), path, f"{folder}/state", lateness)
    for number, document in enumerate(second):
        drop_file(f"{folder}/in", 100 + number, document)
    ws.run_available(ws.read_weather_stream(spark, f"{folder}/in"), path, f"{folder}/state", lateness)

    def state():
        late = sorted(r.observation_id for r in ws.late_rows(spark, path).collect())
        return late, tuple(ws.stream_report(spark, path).first()), table(spark, path)

    late, counts, hours = state()
    # The latest moment before was 05:10, so hours that ended by 03:10 were closed.
    assert late == [90] and counts == (9, 0, 0, 1)
    moments = [h[0].strftime("%H:%M") for h in hours]
    assert moments == ["00:10", "01:10", "02:10", "03:05", "04:05", "05:10", "09:00"]
    # All files again under a checkpoint that knows nothing: every row is there once more, the table is not touched.
    ws.run_available(ws.read_weather_stream(spark, f"{folder}/in"), f"{folder}/again", f"{folder}/fresh", lateness)
    assert tuple(ws.stream_report(spark, f"{folder}/again").first()) == (10, 0, 0, 0)
    assert state() == (late, counts, hours)
