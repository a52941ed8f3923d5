"""Raw feeds projected from general event and order tables.

The engine's inputs are trips and weather. These projections give any table of
timed events, or of shipped order lines, the columns of those feeds, so that
every query can run on whatever amount of such data there is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

WEATHER_EVENT = "view"

_EVENT_KEY = "CAST(get_json_object(props, '$.k') AS INT)"

_CONDITION_TYPE = "ARRAY<STRUCT<id: INT, main: STRING, description: STRING, icon: STRING>>"


def _trips(rides: DataFrame) -> DataFrame:
    """Trip columns from (key, pickup, value, k, payment, zone); money in whole cents."""
    return (
        rides.selectExpr(
            "*", "CAST(round(CAST(2.0D + value * 0.5D AS DECIMAL(18,6)), 2) * 100 AS BIGINT) AS fare"
        )
        .selectExpr("*", "(fare * k * 4 + 500) DIV 1000 AS tip")
        .selectExpr(
            "pickup AS tpep_pickup_datetime",
            "timestampadd(SECOND, floor(value * 60), pickup) AS tpep_dropoff_datetime",
            "value / 10 AS trip_distance",
            "fare / 100.0D AS fare_amount",
            "0.0D AS extra",
            "0.5D AS mta_tax",
            "tip / 100.0D AS tip_amount",
            "0.0D AS tolls_amount",
            "(fare + tip + 50) / 100.0D AS total_amount",
            "CASE WHEN key % 8 <> 7 THEN key % 8 END AS passenger_count",
            "CAST(payment AS BIGINT) AS payment_type",
            "CAST(zone % 263 + 1 AS INT) AS PULocationID",
            "CAST(k + 1 AS INT) AS DOLocationID",
        )
    )


def event_trips(events: DataFrame) -> DataFrame:
    """Raw trips: every event that is not a weather event."""
    rides = events.filter(f"event_type <> '{WEATHER_EVENT}'").selectExpr(
        "event_id AS key",
        "ts AS pickup",
        "value",
        f"{_EVENT_KEY} AS k",
        """CASE WHEN event_type IN ('click', 'signup') THEN 1
                WHEN event_type = 'purchase' THEN 2 ELSE 3 END AS payment""",
        "user_id AS zone",
    )
    return _trips(rides)


def order_line_trips(lineitem: DataFrame) -> DataFrame:
    """Raw trips from shipped order lines: a far larger table, over seven years."""
    rides = lineitem.selectExpr(
        "l_orderkey * 8 + l_linenumber AS key",
        "timestampadd(SECOND, l_orderkey * 37 % 86400, l_shipdate) AS pickup",
        "l_quantity AS value",
        "CAST(l_partkey % 100 AS INT) AS k",
        "CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS payment",
        "l_suppkey AS zone",
    )
    return _trips(rides)


def event_weather(events: DataFrame) -> DataFrame:
    """Raw nested weather: the weather events, several in some hours, none in others."""
    seen = events.filter(f"event_type = '{WEATHER_EVENT}'").selectExpr(
        "event_id",
        "ts",
        f"{_EVENT_KEY} AS k",
        "round(CAST(value / 10 - 5 AS DECIMAL(18,6)), 1) AS temp",
    )
    described = seen.selectExpr(
        "*",
        """CASE WHEN k % 20 = 0 THEN 'Thunderstorm'
                WHEN k % 10 < 4 THEN element_at(array('Rain', 'Drizzle', 'Snow'), k % 3 + 1)
                WHEN k % 10 < 7 THEN 'Clouds' ELSE 'Clear' END AS condition""",
        """CASE WHEN k % 11 = 5 THEN NULL WHEN k % 20 = 0 THEN 'Orageux'
                WHEN k % 10 < 4 THEN 'Pluvieux' WHEN k % 10 < 7 THEN 'Nuageux'
                ELSE 'Clair' END AS category""",
    )
    return described.selectExpr(
        "named_struct('lon', -74.006D, 'lat', 40.7128D) AS coord",
        "'stations' AS base",
        "unix_timestamp(ts) AS dt",
        "-18000 AS timezone",
        "event_id AS id",
        "'New York' AS name",
        "200 AS cod",
        f"""CASE WHEN k = 38 THEN CAST(array() AS {_CONDITION_TYPE})
                 ELSE array(named_struct('id', 800 + k, 'main', condition,
                      'description', concat('light ', lower(condition)), 'icon', '01d'))
            END AS weather""",
        """named_struct('temp', CAST(temp AS DOUBLE),
                        'feels_like', CAST(temp - 1 - k % 4 AS DOUBLE),
                        'temp_min', CAST(temp - 1.5 AS DOUBLE),
                        'temp_max', CAST(temp + 1.5 AS DOUBLE),
                        'pressure', 1005 + k % 26, 'humidity', 40 + k % 51) AS main""",
        "3000 + k * 70 AS visibility",
        "named_struct('speed', (100 + k * 14) / 100.0D, 'deg', k * 7 % 360) AS wind",
        "named_struct('all', k) AS clouds",
        "named_struct('country', 'US', 'sunrise', 0L, 'sunset', 0L) AS sys",
        """named_struct('collected_at_iso', translate(CAST(ts AS STRING), ' ', 'T'),
                        'collected_at_ts', unix_timestamp(ts), 'city_id', 5128581,
                        'city_name', 'New York', 'pipeline_version', '2.0', 'simulated', true,
                        'weather_category', category) AS _metadata""",
    )
