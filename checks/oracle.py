"""SQL with the meaning of each registered query, written for another engine.

The statements share one chain of common tables, from the given tables to the
curated ones; each query adds its own last step.
"""

from __future__ import annotations


def _dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,6))"


def _round(x: str, n: int) -> str:
    return f"CAST(round({_dec(x)}, {n}) AS DOUBLE)"


def _avg(x: str, n: int) -> str:
    return _round(f"CAST(sum({_dec(x)}) AS DOUBLE) / nullif(count({x}), 0)", n)


def _total(x: str, n: int) -> str:
    return f"CAST(round(sum({_dec(x)}), {n}) AS DOUBLE)"


def _median(x: str, n: int, q: str = "0.5") -> str:
    return _round(f"quantile_cont({x}, {q})", n)


def _corr(x: str, y: str) -> str:
    c = f"corr({x}, {y})"
    return f"CASE WHEN isnan({c}) THEN NULL ELSE {_round(c, 4)} END"


# Trip columns from a key, a pickup time, a value, k, a payment code and a zone.
def _trip_feed(source: str, key: str, pickup: str, value: str, k: str, payment: str,
               zone: str, where: str = "TRUE") -> str:
    return f"""
    SELECT pickup AS tpep_pickup_datetime,
           pickup + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS tpep_dropoff_datetime,
           value / 10 AS trip_distance,
           fare_c / 100.0::DOUBLE AS fare_amount,
           0.0::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax,
           ((fare_c * k * 4 + 500) // 1000) / 100.0::DOUBLE AS tip_amount,
           0.0::DOUBLE AS tolls_amount,
           (fare_c + (fare_c * k * 4 + 500) // 1000 + 50) / 100.0::DOUBLE AS total_amount,
           CASE WHEN key % 8 = 7 THEN NULL ELSE key % 8 END AS passenger_count,
           CAST(payment AS BIGINT) AS payment_type,
           CAST(zone % 263 + 1 AS INTEGER) AS PULocationID,
           CAST(k + 1 AS INTEGER) AS DOLocationID
    FROM (SELECT {key} AS key, {pickup} AS pickup, {value} AS value, {k} AS k,
                 {payment} AS payment, {zone} AS zone,
                 CAST(round({_dec(f"2.0 + {value} * 0.5")}, 2) * 100 AS BIGINT) AS fare_c
          FROM {source} WHERE {where})"""


def _clean(source: str, first: str, end: str) -> str:
    return f"""
    SELECT * FROM {source}
    WHERE trip_distance BETWEEN 0.1::DOUBLE AND 100 AND fare_amount BETWEEN 2.5::DOUBLE AND 500
      AND passenger_count BETWEEN 1 AND 6
      AND tpep_pickup_datetime >= TIMESTAMP '{first}' AND tpep_pickup_datetime < TIMESTAMP '{end}'
      AND tpep_dropoff_datetime > tpep_pickup_datetime"""


_DURATION = _round(
    "(floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime))) / 60.0::DOUBLE", 2
)


def _timed(source: str) -> str:
    return f"""
    SELECT * FROM (SELECT *, {_DURATION} AS trip_duration_minutes FROM {source})
    WHERE trip_duration_minutes BETWEEN 1 AND 180"""


def _enriched(source: str) -> str:
    return f"""
    SELECT *,
           CASE WHEN fare_amount > 0 THEN {_round("tip_amount / fare_amount * 100", 2)}
                ELSE 0.0 END AS tip_percentage,
           CASE WHEN trip_distance * 1.60934::DOUBLE < 2 THEN '>0-2km'
                WHEN trip_distance * 1.60934::DOUBLE < 5 THEN '2-5km' ELSE '>5km' END
             AS distance_bucket,
           CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
             WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' END
             AS payment_type_desc
    FROM {source}"""


def _fact(source: str) -> str:
    return f"""
    SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
           trip_duration_minutes, trip_distance, distance_bucket, fare_amount, extra, mta_tax,
           tip_amount, tolls_amount, total_amount, tip_percentage,
           CAST(passenger_count AS INTEGER) AS passenger_count,
           CAST(payment_type AS INTEGER) AS payment_type, payment_type_desc,
           PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
           CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
           CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
           CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
           CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month
    FROM {source}"""


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

_NUMBER = """row_number() OVER (ORDER BY pickup_datetime, pickup_location_id, dropoff_datetime,
           dropoff_location_id, total_amount, payment_type)"""

_WEATHER = f"""
    SELECT event_id AS observation_id, ts AS observation_ts,
           date_trunc('hour', ts)::TIMESTAMP AS observation_hour,
           CAST(temp AS DOUBLE) AS temp_celsius,
           CAST(temp - 1 - k % 4 AS DOUBLE) AS temp_feels_like,
           40 + k % 51 AS humidity_pct, (100 + k * 14) / 100.0::DOUBLE AS wind_speed_ms,
           k * 7 % 360 AS wind_direction_deg, main AS weather_main,
           'light ' || lower(main) AS weather_description,
           coalesce(given, CASE WHEN main = 'Thunderstorm' THEN 'Orageux'
                                WHEN main IN ('Rain', 'Drizzle', 'Snow') THEN 'Pluvieux'
                                WHEN main IN ('Clear', 'Clouds') THEN 'Clair'
                                ELSE 'Autre' END) AS weather_category,
           1005 + k % 26 AS pressure_hpa, 3000 + k * 70 AS visibility_m,
           CAST(hour(ts) AS INTEGER) AS obs_hour,
           CAST(dayofweek(ts) + 1 AS INTEGER) AS obs_day_of_week, CAST(ts AS DATE) AS obs_date
    FROM (SELECT *, round({_dec("value / 10 - 5")}, 1) AS temp,
                 CASE WHEN k = 38 THEN NULL WHEN k % 20 = 0 THEN 'Thunderstorm'
                      WHEN k % 10 < 4 THEN
                        CASE k % 3 WHEN 0 THEN 'Rain' WHEN 1 THEN 'Drizzle' ELSE 'Snow' END
                      WHEN k % 10 < 7 THEN 'Clouds' ELSE 'Clear' END AS main,
                 CASE WHEN k % 11 = 5 THEN NULL WHEN k % 20 = 0 THEN 'Orageux'
                      WHEN k % 10 < 4 THEN 'Pluvieux' WHEN k % 10 < 7 THEN 'Nuageux'
                      ELSE 'Clair' END AS given
          FROM (SELECT *, {_K} AS k FROM events WHERE event_type = 'view'))"""

_ENRICHED_COLUMNS = """pickup_datetime, dropoff_datetime, trip_duration_minutes, trip_distance,
           distance_bucket, fare_amount, tip_amount, tip_percentage, total_amount, passenger_count,
           payment_type, payment_type_desc, pickup_location_id, dropoff_location_id, pickup_hour,
           pickup_day_of_week, pickup_date, pickup_month"""

_BASE = f"""WITH raw_trips AS ({_trip_feed(
        "events", "event_id", "ts", "value", _K,
        "CASE WHEN event_type IN ('click', 'signup') THEN 1 WHEN event_type = 'purchase' THEN 2 ELSE 3 END",
        "user_id", "event_type <> 'view'")}),
  clean AS ({_clean("raw_trips", "2024-01-01", "2024-04-01")}),
  timed AS ({_timed("clean")}),
  derived AS ({_enriched("timed")}),
  fact AS ({_fact("derived")}),
  flat AS ({_WEATHER}),
  dim AS (
    SELECT * EXCLUDE (observation_id, n) FROM (
      SELECT *, row_number() OVER (PARTITION BY observation_hour
                                   ORDER BY observation_ts, observation_id) AS n
      FROM flat WHERE observation_ts IS NOT NULL AND temp_celsius IS NOT NULL)
    WHERE n = 1),
  stg_weather AS (SELECT *, {_round("wind_speed_ms * 3.6::DOUBLE", 1)} AS wind_speed_kmh
                  FROM dim WHERE temp_celsius IS NOT NULL),
  enriched AS (
    SELECT {_NUMBER} AS trip_id, {_ENRICHED_COLUMNS},
           temp_celsius, temp_feels_like, humidity_pct, wind_speed_ms, wind_speed_kmh,
           weather_main, weather_description,
           coalesce(weather_category, 'Inconnu') AS weather_category
    FROM fact LEFT JOIN stg_weather ON date_trunc('hour', pickup_datetime) = observation_hour),
  summary AS (
    SELECT pickup_hour, pickup_date, weather_category, count(*) AS trip_count,
           {_avg("trip_duration_minutes", 1)} AS avg_duration_min,
           {_median("trip_duration_minutes", 1)} AS median_duration_min,
           {_avg("tip_percentage", 2)} AS avg_tip_pct, {_avg("fare_amount", 2)} AS avg_fare,
           {_total("total_amount", 2)} AS total_revenue,
           {_avg("trip_distance", 2)} AS avg_distance_miles,
           {_avg("temp_celsius", 1)} AS avg_temp_celsius,
           {_avg("wind_speed_ms", 1)} AS avg_wind_speed_ms,
           {_avg("humidity_pct", 0)} AS avg_humidity_pct
    FROM enriched WHERE weather_category <> 'Inconnu'
    GROUP BY pickup_hour, pickup_date, weather_category),
  zones AS (
    SELECT pickup_location_id, count(*) AS trip_count,
           count(DISTINCT pickup_date) AS active_days,
           {_total("total_amount", 2)} AS total_spent, {_avg("fare_amount", 2)} AS avg_fare,
           {_avg("tip_percentage", 2)} AS avg_tip_pct,
           {_avg("total_amount", 2)} AS avg_total_per_trip,
           {_avg("trip_distance", 2)} AS avg_distance_miles,
           {_avg("trip_duration_minutes", 1)} AS avg_duration_min,
           mode(weather_category ORDER BY weather_category) AS dominant_weather
    FROM enriched WHERE payment_type = 1 GROUP BY pickup_location_id
    HAVING count(*) >= 10 AND sum({_dec("total_amount")}) > 300
       AND sum({_dec("tip_percentage")}) > 15 * count(tip_percentage)),
  line_raw AS ({_trip_feed(
        "lineitem", "(l_orderkey * 8 + l_linenumber)",
        "(l_shipdate + to_seconds(l_orderkey * 37 % 86400))", "l_quantity",
        "CAST(l_partkey % 100 AS INTEGER)",
        "CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 3 END", "l_suppkey")}),
  line_clean AS ({_clean("line_raw", "1995-01-01", "2003-01-01")}),
  line_timed AS ({_timed("line_clean")}),
  line_derived AS ({_enriched("line_timed")}),
  line_fact AS ({_fact("line_derived")}),
  months AS (SELECT strftime(m, '%Y-%m') AS month, coalesce(n, 0) AS rows,
                    CASE WHEN n IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS status
             FROM (SELECT unnest([DATE '2024-01-01', DATE '2024-02-01', DATE '2024-03-01']) AS m)
             LEFT JOIN (SELECT date_trunc('month', tpep_pickup_datetime)::DATE AS m, count(*) AS n
                        FROM raw_trips GROUP BY 1) USING (m))
"""


def _hours_sql(fact: str) -> str:
    return f"""SELECT pickup_hour, count(*) AS trips,
      {_avg("trip_duration_minutes", 1)} AS avg_duration FROM {fact} GROUP BY pickup_hour"""


_TEMP_BY_HOUR = f"""SELECT pickup_hour, count(*) AS trips, {_avg("temp_celsius", 6)} AS avg_temp
  FROM fact JOIN dim ON date_trunc('hour', pickup_datetime) = observation_hour
  GROUP BY pickup_hour"""

_PREMIUM = f"""SELECT t.pickup_hour AS pickup_hour, count(*) AS premium_trips,
  {_avg("t.tip_percentage", 2)} AS avg_tip, {_avg("t.total_amount", 2)} AS avg_amount
  FROM enriched t JOIN zones z ON t.pickup_location_id = z.pickup_location_id
  GROUP BY t.pickup_hour"""

_TIPPED = "payment_type = 1 AND tip_percentage > 0 AND trip_distance > 0"

_RULES = {
    "pickup_known": "tpep_pickup_datetime IS NOT NULL",
    "dropoff_known": "tpep_dropoff_datetime IS NOT NULL",
    "distance_in_range": "trip_distance BETWEEN 0.1::DOUBLE AND 100",
    "fare_in_range": "fare_amount BETWEEN 2.5::DOUBLE AND 500",
    "passengers_in_range": "passenger_count BETWEEN 1 AND 6",
    "pickup_in_period": "tpep_pickup_datetime >= TIMESTAMP '2024-01-01' "
                        "AND tpep_pickup_datetime < TIMESTAMP '2024-04-01'",
    "dropoff_after_pickup": "tpep_dropoff_datetime > tpep_pickup_datetime",
}
_BROKEN = ", ".join(
    f"count(*) FILTER (WHERE NOT coalesce({rule}, FALSE)) AS not_{name}"
    for name, rule in _RULES.items()
)


def _test(table: str, source: str, column: str, kind: str, failures: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS test,
      ({failures}) AS failures"""


def _suite() -> str:
    names = {
        "trip_enriched": "enriched", "trip_summary_per_hour": "summary",
        "high_value_customers": "zones", "fact_trips": "fact", "dim_weather": "dim",
    }
    buckets = "'>0-2km', '2-5km', '>5km'"
    feed = "'Clair', 'Nuageux', 'Pluvieux', 'Orageux'"
    tests = [
        ("trip_enriched", "trip_id", "unique", ""),
        ("trip_enriched", "trip_id", "not_null", ""),
        ("trip_enriched", "pickup_datetime", "not_null", ""),
        ("trip_enriched", "weather_category", "not_null", ""),
        ("trip_enriched", "weather_category", "accepted_values", f"{feed}, 'Inconnu'"),
        ("trip_enriched", "tip_percentage", "not_null", ""),
        ("trip_enriched", "distance_bucket", "not_null", ""),
        ("trip_enriched", "distance_bucket", "accepted_values", buckets),
        ("trip_summary_per_hour", "pickup_hour", "not_null", ""),
        ("trip_summary_per_hour", "trip_count", "not_null", ""),
        ("trip_summary_per_hour", "avg_tip_pct", "not_null", ""),
        ("high_value_customers", "pickup_location_id", "unique", ""),
        ("high_value_customers", "pickup_location_id", "not_null", ""),
        ("high_value_customers", "total_spent", "not_null", ""),
        ("high_value_customers", "trip_count", "not_null", ""),
        ("fact_trips", "pickup_datetime", "not_null", ""),
        ("fact_trips", "trip_duration_minutes", "not_null", ""),
        ("fact_trips", "distance_bucket", "not_null", ""),
        ("fact_trips", "distance_bucket", "accepted_values", buckets),
        ("fact_trips", "payment_type", "not_null", ""),
        ("dim_weather", "observation_ts", "not_null", ""),
        ("dim_weather", "observation_hour", "not_null", ""),
        ("dim_weather", "observation_hour", "unique", ""),
        ("dim_weather", "weather_category", "not_null", ""),
        ("dim_weather", "weather_category", "accepted_values", f"{feed}, 'Autre'"),
    ]
    parts = []
    for table, column, kind, values in tests:
        source = names[table]
        if kind == "not_null":
            failing = f"SELECT count(*) FROM {source} WHERE {column} IS NULL"
        elif kind == "unique":
            failing = (f"SELECT count(*) FROM (SELECT {column} FROM {source} "
                       f"WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        else:
            failing = f"SELECT count(*) FROM {source} WHERE {column} NOT IN ({values})"
        parts.append(_test(table, source, column, kind, failing))
    union = " UNION ALL ".join(parts)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({union})"


def _top(rows: str, count: str, k: int, columns: str = "*") -> str:
    return f"SELECT {columns} FROM ({rows}) ORDER BY {count} DESC, pickup_hour LIMIT {k}"


# Folders of all trips as the validation of the whole feed writes them.
_WHOLE_FILES = """
    SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month, 'day=' || day(tpep_pickup_datetime) AS folder,
      count(*) AS rows, NULL AS error
    FROM raw_trips GROUP BY 1, 2
    UNION ALL SELECT '2024-02', 'unpriced', count(*), 'missing columns: fare_amount' FROM raw_trips
    UNION ALL SELECT '2024-02', 'text', 1, 'wrong types: fare_amount string'
    UNION ALL SELECT '2024-03', 'none', 0, 'empty'
    UNION ALL SELECT '2024-04', NULL, 0, 'PATH_NOT_FOUND'"""

_INGEST = f"""
    SELECT count(*) AS months, count(*) FILTER (WHERE bad = 0) AS succeeded,
           count(*) FILTER (WHERE bad > 0) AS failed,
           CAST(sum(CASE WHEN bad = 0 THEN rows ELSE 0 END) AS BIGINT) AS rows
    FROM (SELECT month, count(error) AS bad, sum(rows) AS rows FROM ({_WHOLE_FILES}) GROUP BY month)"""


_VALIDATION = f"""SELECT month, folder, rows, error,
    CASE WHEN error IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM ({_WHOLE_FILES})"""

_RELOADED = """SELECT state, count(*) AS folders FROM (
    SELECT DISTINCT CAST(tpep_pickup_datetime AS DATE),
      CASE day(tpep_pickup_datetime) WHEN 5 THEN 'changed' WHEN 7 THEN 'missing' WHEN 16 THEN 'new'
           ELSE 'same' END AS state
    FROM raw_trips) GROUP BY state"""

_DAY_FOLDER = """'year=' || year(tpep_pickup_datetime) || '/month=' ||
    month(tpep_pickup_datetime) || '/day=' || day(tpep_pickup_datetime)"""

# The hour that reaches the watermarked queries too late.
_IN_TIME = "NOT (day(observation_hour) = 3 AND hour(observation_hour) = 5)"


def _digest_half(at: int) -> str:
    return f"CAST(sum(('0x' || substr(d, {at}, 16))::UBIGINT) AS VARCHAR)"


_STEPS: dict[str, str] = {
    "raw_trips": "SELECT * FROM raw_trips",
    "clean_trips": "SELECT * FROM clean",
    "clean_rejects": f"""SELECT rows_in, rows_out, rows_in - rows_out AS rows_rejected,
        coalesce({_round("(rows_in - rows_out) * 100 / nullif(rows_in, 0)::DOUBLE", 2)}, 0.0)
          AS pct_rejected, {", ".join(f"not_{n}" for n in _RULES)}
      FROM (SELECT count(*) AS rows_in, (SELECT count(*) FROM clean) AS rows_out, {_BROKEN}
            FROM raw_trips)""",
    "enrich_trips": "SELECT * FROM derived",
    "time_dims": """SELECT tpep_pickup_datetime,
        CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
        CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
        CAST(isodow(tpep_pickup_datetime) AS INTEGER) AS pickup_iso_weekday,
        CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
        CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month FROM clean""",
    "fact_trips": "SELECT * FROM fact",
    "payment_lookup": """SELECT payment_type, count(*) AS trips,
        CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' END
          AS payment_type_desc FROM raw_trips GROUP BY payment_type""",
    "weather_flat": "SELECT * FROM flat",
    "weather_category": """SELECT weather_main, weather_category, count(*) AS observations
        FROM flat GROUP BY ALL""",
    "weather_dedup": "SELECT * FROM dim",
    "weather_dedup_report": """SELECT count(*) AS rows_in,
        count(DISTINCT observation_hour) AS rows_out,
        count(*) - count(DISTINCT observation_hour) AS duplicates FROM flat""",
    "weather_union_by_name": """SELECT observation_id, wind_speed_ms AS wind_speed,
        CASE WHEN day(observation_ts) > 15 THEN wind_direction_deg END AS wind_deg,
        CASE WHEN day(observation_ts) > 15 THEN visibility_m END AS visibility FROM flat""",
    "weather_json_scan": "SELECT * FROM dim",
    "weather_json_report": """SELECT unnest(['batch', 'stream']) AS reader, count(*) AS kept,
        2::BIGINT AS quarantined, 1::BIGINT AS dropped FROM flat""",
    "weather_stats": f"""SELECT {_avg("temp_celsius", 1)} AS avg_temp_c,
        min(temp_celsius) AS min_temp_c, max(temp_celsius) AS max_temp_c,
        {_avg("humidity_pct", 0)} AS avg_humidity_pct, {_avg("wind_speed_ms", 1)} AS avg_wind_ms
        FROM dim""",
    "weather_category_counts": """SELECT weather_category, count(*) AS observations
        FROM dim GROUP BY weather_category""",
    "weather_category_share": f"""SELECT weather_category, count(*) AS observations,
        {_round("count(*) * 100 / (SELECT count(*) FROM dim)::DOUBLE", 1)} AS share_pct
        FROM dim GROUP BY weather_category""",
    "hour_spine": """SELECT unnest(generate_series(min(observation_hour), max(observation_hour),
        INTERVAL 1 HOUR)) AS hour_start FROM dim""",
    "missing_hours": """SELECT hour_start FROM (SELECT unnest(generate_series(
        TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-03-31 23:00:00', INTERVAL 1 HOUR))
        AS hour_start) WHERE hour_start NOT IN (SELECT observation_hour FROM dim)""",
    "stg_trips": f"SELECT {_NUMBER} AS trip_id, * FROM fact",
    "stg_weather": "SELECT * FROM stg_weather",
    "trip_enriched": "SELECT * FROM enriched",
    "inner_weather_join": """SELECT pickup_datetime, pickup_location_id, observation_hour,
        temp_celsius FROM fact JOIN dim ON date_trunc('hour', pickup_datetime) = observation_hour""",
    "premium_trips": """SELECT t.pickup_datetime, t.pickup_location_id, t.total_amount,
        t.weather_category FROM enriched t JOIN zones z
        ON t.pickup_location_id = z.pickup_location_id""",
    "trip_summary_per_hour": "SELECT * FROM summary",
    "high_value_zones": """SELECT *, row_number() OVER (
        ORDER BY total_spent DESC NULLS FIRST, pickup_location_id ASC NULLS LAST) AS place FROM zones""",
    "table_counts": """SELECT 'fact_trips' AS table_name, count(*) AS rows FROM fact
        UNION ALL SELECT 'dim_weather', count(*) FROM dim
        UNION ALL SELECT 'trip_enriched', count(*) FROM enriched
        UNION ALL SELECT 'trip_summary_per_hour', count(*) FROM summary
        UNION ALL SELECT 'high_value_customers', count(*) FROM zones""",
    "sql_over_views": """SELECT weather_category, count(*) AS hours FROM stg_weather
        WHERE obs_date IN (SELECT pickup_date FROM fact) GROUP BY weather_category""",
    "catalog_views": "SELECT * FROM stg_weather",
    "bucketed_enriched": "SELECT * EXCLUDE (trip_id) FROM enriched",
    "sketch_distinct": """SELECT pickup_hour, count(*) AS rows, count(DISTINCT total_amount) AS exact, TRUE AS within_error
        FROM fact GROUP BY pickup_hour""",
    "sketch_median": """SELECT pickup_location_id, count(*) AS rows, TRUE AS within_error
        FROM fact GROUP BY pickup_location_id""",
    "fine_totals": f"""SELECT event_type, total, average, total AS merged_total, average AS merged_average
        FROM (SELECT event_type, CAST(sum(fine) AS DOUBLE) AS total,
                     {_round("CAST(sum(fine) AS DOUBLE) / count(fine)", 6)} AS average
              FROM (SELECT event_type, CAST(round_even(value * 1e8 / 7, 0) / 1e8 AS DECIMAL(18,8)) AS fine FROM events)
              GROUP BY event_type)""",
    "q1_stats": f"""SELECT {_median("trip_duration_minutes", 1)} AS median_min,
        {_avg("trip_duration_minutes", 1)} AS mean_min,
        {_median("trip_duration_minutes", 1, "0.75")} AS p75_min
        FROM fact WHERE trip_duration_minutes BETWEEN 1 AND 60""",
    "q1_histogram": """SELECT CAST(least(floor((d - lo) / ((hi - lo) / 60)) + 1, 60) AS INTEGER)
          AS bin, count(*) AS trips
        FROM (SELECT trip_duration_minutes AS d, min(trip_duration_minutes) OVER () AS lo,
                     max(trip_duration_minutes) OVER () AS hi
              FROM fact WHERE trip_duration_minutes BETWEEN 1 AND 60) GROUP BY 1""",
    "q1_buckets": "SELECT distance_bucket, count(*) AS trips FROM fact GROUP BY distance_bucket",
    "q1_sample": """SELECT trip_duration_minutes FROM fact
        WHERE trip_duration_minutes BETWEEN 1 AND 60 AND ('0x' || substr(md5(concat_ws('|',
          strftime(pickup_datetime, '%Y%m%d%H%M%S'), strftime(dropoff_datetime, '%Y%m%d%H%M%S'),
          pickup_location_id, dropoff_location_id)), 1, 8))::BIGINT % 4 = 0""",
    "q1_sample_rows": """SELECT trip_duration_minutes FROM fact
        WHERE trip_duration_minutes BETWEEN 1 AND 60 ORDER BY md5(concat_ws('|',
          strftime(pickup_datetime, '%Y%m%d%H%M%S'), strftime(dropoff_datetime, '%Y%m%d%H%M%S'),
          pickup_location_id, dropoff_location_id)), trip_duration_minutes LIMIT 500""",
    "q2_tips_by_bucket": f"""SELECT distance_bucket, {_avg("tip_percentage", 2)} AS avg_tip_pct,
        {_median("tip_percentage", 2)} AS median_tip_pct, count(*) AS trips
        FROM fact WHERE payment_type = 1 GROUP BY distance_bucket""",
    "q2_tip_by_mile": f"""SELECT {_round("trip_distance", 0)} AS miles,
        {_avg("tip_percentage", 6)} AS avg_tip FROM fact
        WHERE payment_type = 1 AND trip_distance BETWEEN 0 AND 30 AND tip_percentage > 0
        GROUP BY 1""",
    "q2_corr": f"""SELECT {_corr("trip_distance", "tip_percentage")} AS correlation
        FROM fact WHERE {_TIPPED}""",
    "q3_hours": f"""SELECT *, pickup_hour IN (7, 8, 9, 17, 18, 19) AS is_peak,
          row_number() OVER (ORDER BY pickup_hour) AS place
        FROM ({_hours_sql("fact")})""",
    "q3_top3": _top(_hours_sql("fact"), "trips", 3),
    "q4_corr_by_bucket": f"""SELECT distance_bucket, {_avg("tip_percentage", 2)} AS avg_tip,
        {_corr("trip_distance", "tip_percentage")} AS correlation
        FROM fact WHERE {_TIPPED} GROUP BY distance_bucket""",
    "q5_temp_by_hour": _TEMP_BY_HOUR,
    "q5_top3": _top(_TEMP_BY_HOUR, "trips", 3,
                    f"pickup_hour, trips, {_round('avg_temp', 1)} AS avg_temp"),
    "q6_weather_volume": f"""SELECT weather_category, {_avg("trip_count", 0)} AS avg_trips_per_hour,
        {_avg("avg_tip_pct", 2)} AS avg_tip, {_avg("avg_temp_celsius", 1)} AS avg_temp,
        {_avg("avg_wind_speed_ms", 1)} AS avg_wind_ms, count(*) AS periods
        FROM summary GROUP BY weather_category""",
    "q7_behaviour": f"""SELECT weather_category, count(*) AS trips,
        {_avg("trip_duration_minutes", 1)} AS avg_duration,
        {_avg("trip_distance", 2)} AS avg_distance, {_avg("tip_percentage", 2)} AS avg_tip,
        {_avg("fare_amount", 2)} AS avg_fare FROM enriched
        WHERE weather_category <> 'Inconnu' GROUP BY weather_category""",
    "q8_premium_hours": _PREMIUM,
    "q8_peak": _top(_PREMIUM, "premium_trips", 1, "pickup_hour AS peak_hour"),
    "q8_top5": _top(_PREMIUM, "premium_trips", 5),
    "q9_weather_tips": f"""SELECT weather_category, {_avg("tip_percentage", 2)} AS avg_tip,
        {_median("tip_percentage", 2)} AS median_tip,
        {_round("stddev_samp(tip_percentage)", 2)} AS std_tip,
        {_round("sum(CASE WHEN tip_percentage = 0 THEN 1 ELSE 0 END) * 100 / count(*)::DOUBLE", 2)}
          AS pct_untipped
        FROM enriched WHERE weather_category <> 'Inconnu' AND payment_type = 1
        GROUP BY weather_category""",
    "quality_suite": _suite(),
    "quality_of_writes": _suite(),
    "relationship_check": """SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT 'fact_trips' AS table_name, 'pickup_date' AS column_name,
                     'relationships' AS test, count(*) AS failures FROM fact
              WHERE pickup_date NOT IN (SELECT obs_date FROM dim)
              UNION ALL SELECT 'fact_trips', 'pickup_location_id', 'relationships', count(*)
              FROM fact WHERE pickup_location_id NOT IN (SELECT pickup_location_id FROM zones))""",
    "row_count_gate": """SELECT *, CASE WHEN rows = 0 THEN 'EMPTY' WHEN rows < minimum THEN 'LOW'
          ELSE 'OK' END AS status
        FROM (SELECT 'fact_trips' AS table_name, count(*) AS rows, 1000000::BIGINT AS minimum
              FROM fact UNION ALL SELECT 'dim_weather', count(*), 100 FROM dim)""",
    "weather_gate": """SELECT *, CASE WHEN rows >= 100 AND categories_present = 4
          AND rows_with_null = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT count(*) AS rows, CAST(count(DISTINCT weather_category) FILTER (
                WHERE weather_category IN ('Clair', 'Nuageux', 'Pluvieux', 'Orageux')) AS INTEGER)
                AS categories_present,
              count(*) FILTER (WHERE observation_ts IS NULL OR observation_hour IS NULL
                OR temp_celsius IS NULL OR weather_category IS NULL) AS rows_with_null FROM dim)""",
    "contract_violations": """SELECT count(*) AS rows,
        count(*) FILTER (WHERE pickup_datetime IS NULL) AS pickup_datetime__null,
        count(*) FILTER (WHERE dropoff_datetime IS NULL) AS dropoff_datetime__null,
        count(*) FILTER (WHERE length(distance_bucket) > 10) AS distance_bucket__too_long,
        count(*) FILTER (WHERE length(payment_type_desc) > 20) AS payment_type_desc__too_long,
        0::BIGINT AS source_file__too_long FROM fact""",
    "trip_files_by_day": f"""SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
        CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
        CAST(day(tpep_pickup_datetime) AS INTEGER) AS day, count(*) AS trips,
        {_total("fare_amount", 2)} AS fares FROM raw_trips GROUP BY ALL""",
    "trip_file_scan": "SELECT distance_bucket, count(*) AS trips FROM fact GROUP BY distance_bucket",
    "schema_validation": _VALIDATION,
    "ingest_report": _INGEST,
    "ingest_sizes": f"SELECT *, TRUE AS has_size FROM ({_INGEST})",
    "schema_validation_all": _VALIDATION,
    "ingest_report_all": _INGEST,
    "ingest_sizes_all": f"SELECT *, TRUE AS has_size FROM ({_INGEST})",
    "file_manifest": """SELECT 'year=' || year(tpep_pickup_datetime) || '/month=' ||
          month(tpep_pickup_datetime) || '/day=' || day(tpep_pickup_datetime) AS file,
        count(*) AS rows, TRUE AS digested FROM raw_trips GROUP BY 1""",
    "manifest_comparison": _RELOADED,
    "manifest_comparison_all": _RELOADED,
    "manifest_refresh": f"""SELECT {_DAY_FOLDER} AS folder, count(*) AS rows
        FROM raw_trips WHERE day(tpep_pickup_datetime) IN (2, 5, 16) GROUP BY 1""",
    "manifest_tree": f"""SELECT DISTINCT unnest([0, 1, 2, 3]) AS level, unnest(['', split_part(f, '/', 1),
          split_part(f, '/', 1) || '/' || split_part(f, '/', 2), f]) AS folder
        FROM (SELECT {_DAY_FOLDER} AS f FROM raw_trips WHERE day(tpep_pickup_datetime) IN (5, 7, 16))""",
    "feed_fingerprint": f"""SELECT count(*) AS rows, {_digest_half(1)} || '-' || {_digest_half(17)} AS digest
      FROM (SELECT md5({" || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
                                    for c in ("event_id", "event_type", "props", "ts", "user_id", "value"))}) AS d
            FROM (SELECT event_id, event_type, props, epoch_us(ts) AS ts, user_id,
                         CAST(round_even(value * 1e6, 0) AS BIGINT) AS value FROM events))""",
    "period_loads": """SELECT CAST(year(pickup_date) AS INTEGER) AS year, pickup_month AS month, count(*) AS trips
        FROM line_fact WHERE year(pickup_date) IN (1995, 1996) GROUP BY ALL""",
    "write_report": "SELECT 'fact_trips' AS table_name, count(*) AS rows FROM fact",
    "period_reload": f"""SELECT pickup_date, count(*) AS trips,
        {_total("total_amount", 2)} AS revenue FROM fact GROUP BY pickup_date""",
    "stream_weather_dedup": "SELECT * FROM dim",
    "stream_first_arrivals": f"SELECT observation_hour, 1::BIGINT AS times FROM dim WHERE {_IN_TIME}",
    "stream_hourly_state": f"""SELECT observation_hour, observation_ts, temp_celsius,
        weather_category FROM dim WHERE {_IN_TIME}""",
    "stream_late_rows": f"""SELECT observation_hour, count(*) AS observations FROM flat
        WHERE observation_ts IS NOT NULL AND temp_celsius IS NOT NULL AND NOT ({_IN_TIME}) GROUP BY observation_hour""",
    "stream_late_report": f"""SELECT unnest(['kept', 'late', 'quarantined', 'dropped', 'hours']) AS what,
        unnest([count(*) FILTER (WHERE ok AND {_IN_TIME}), count(*) FILTER (WHERE ok AND NOT ({_IN_TIME})), 0::BIGINT,
          count(*) FILTER (WHERE NOT ok),
          count(DISTINCT observation_hour) FILTER (WHERE ok AND {_IN_TIME})]) AS rows
        FROM (SELECT *, observation_ts IS NOT NULL AND temp_celsius IS NOT NULL AS ok FROM flat)""",
    "line_hours": f"""SELECT *, pickup_hour IN (7, 8, 9, 17, 18, 19) AS is_peak
        FROM ({_hours_sql("line_fact")})""",
    "line_trip_numbers": f"""SELECT pickup_date, count(*) AS trips, min(trip_id) AS first_id,
        max(trip_id) AS last_id FROM (SELECT pickup_date, {_NUMBER} AS trip_id FROM line_fact)
        GROUP BY pickup_date""",
}

ORACLE: dict[str, str] = {name: _BASE + step for name, step in _STEPS.items()}
