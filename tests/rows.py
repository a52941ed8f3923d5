"""Small tables for the operator tests."""

from __future__ import annotations

import json
import os
from datetime import datetime

from stormfare.schemas import RAW_TRIPS, RAW_WEATHER

GOOD_TRIP = {
    "tpep_pickup_datetime": datetime(2024, 1, 7, 14, 37),
    "tpep_dropoff_datetime": datetime(2024, 1, 7, 14, 57),
    "trip_distance": 2.0,
    "fare_amount": 10.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "total_amount": 12.5,
    "passenger_count": 1,
    "payment_type": 1,
    "PULocationID": 7,
    "DOLocationID": 8,
}


def trips(spark, *changes):
    """One raw trip per dict of changes to a good trip."""
    rows = [tuple({**GOOD_TRIP, **c}[f.name] for f in RAW_TRIPS.fields) for c in changes]
    return spark.createDataFrame(rows, RAW_TRIPS)


def observation(ts, temp=5.0, ident=1, main="Rain", category=None, **changes):
    """A weather document; ``main=None`` gives an empty condition list."""
    entry = {"id": 500, "main": main, "description": "light rain", "icon": "01d"}
    document = {
        "dt": 0,
        "id": ident,
        "weather": [] if main is None else [entry],
        "main": {"temp": temp, "feels_like": 1.25, "pressure": 1015, "humidity": 65},
        "visibility": 9000,
        "wind": {"speed": 4.2, "deg": 270},
        "_metadata": {"collected_at_iso": ts},
    }
    if category is not None:
        document["_metadata"]["weather_category"] = category
    return {**document, **changes}


def weather(spark, *documents):
    text = [(json.dumps(d),) for d in documents]
    frame = spark.createDataFrame(text, "value string")
    return spark.read.schema(RAW_WEATHER).json(frame.rdd.map(lambda r: r.value))


def write_documents(base, documents, plain=False):
    """One pretty-printed file per document below its year, month and day."""
    for number, document in enumerate(documents):
        ts = document["_metadata"]["collected_at_iso"]
        year, month, day = ts[:4], ts[5:7], ts[8:10]
        parts = (year, month, day) if plain else (
            f"year={year}", f"month={int(month)}", f"day={int(day)}"
        )
        target = os.path.join(base, *parts)
        os.makedirs(target, exist_ok=True)
        with open(os.path.join(target, f"weather_{number}.json"), "w") as out:
            json.dump(document, out, indent=2)
