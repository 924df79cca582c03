"""SQL text for DuckDB that derives the same inputs from the same tables, and one query per key.

Every text is a chain of common table expressions followed by the question. The texts state the
question in plain SQL; they share no code with the DataFrame operators.

Rounded values are shifted up by a ten-thousandth of the last digit first. The last bit of a float sum
depends on the order of adding, so a mean that lies exactly half-way between two rounded values, such
as 0.4596875, would go up in one engine and down in the other.
"""

from __future__ import annotations

_TRIPS_RAW = """
trips_src AS (
  SELECT event_id, user_id, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         date_trunc('{unit}', ts) + to_months(CAST(event_id % 36 AS INTEGER)) AS st
  FROM events),
trips_raw AS (
  SELECT event_id AS trip_id, user_id AS taxi_id,
         strftime(st, '%m/%d/%Y %I:%M:%S %p') AS start_text,
         strftime(st + to_minutes(k), '%m/%d/%Y %I:%M:%S %p') AS end_text,
         nullif(k * 60, 0) AS trip_seconds,
         CASE WHEN event_id % 1009 = 5 THEN CAST(1200.5 AS DOUBLE)
              ELSE CAST(event_id % 97 AS DOUBLE) / 3 END AS trip_miles,
         CASE WHEN event_id % 101 = 7 THEN NULL ELSE value * 5 END AS fare,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value * 5 * (event_id % 25) / 100 END AS tips
  FROM trips_src)"""

_TRIPS = """,
typed AS (
  SELECT trip_id, taxi_id,
         try_strptime(start_text, '%m/%d/%Y %I:%M:%S %p') AS start_ts,
         try_strptime(end_text, '%m/%d/%Y %I:%M:%S %p') AS end_ts,
         coalesce(trip_seconds, 0) AS trip_seconds, coalesce(trip_miles, 0) AS trip_miles,
         coalesce(fare, 0) AS fare, coalesce(tips, 0) AS tips
  FROM trips_raw),
trips AS (
  SELECT *,
         CASE WHEN trip_seconds = 0 THEN CAST(0 AS DOUBLE)
              ELSE trip_miles / trip_seconds * 3600 END AS speed_mph,
         CAST(hour(start_ts + to_microseconds(date_diff('microsecond', start_ts, end_ts) // 2)) AS INTEGER)
           AS midpoint_hour,
         CAST(year(start_ts) AS INTEGER) AS year
  FROM typed),
good AS (
  SELECT * FROM trips
  WHERE NOT (trip_seconds < 60 OR speed_mph > 100 OR trip_miles > 1000 OR fare > 2000)),
tip_recs AS (
  SELECT trip_id, start_ts, CAST(month(start_ts) AS INTEGER) AS month, monthname(start_ts) AS month_name,
         fare, tips,
         CASE WHEN trip_miles = 0 THEN tips ELSE tips / trip_miles END AS tip_per_mile,
         CASE WHEN fare = 0 THEN CAST(0 AS DOUBLE) ELSE tips / fare * 100 END AS tip_pct
  FROM good)"""

_HOURLY = """,
means AS (
  SELECT midpoint_hour, avg(speed_mph) AS speed_mph, avg(fare) AS fare, avg(tips) AS tips
  FROM good WHERE midpoint_hour IS NOT NULL GROUP BY midpoint_hour),
totals AS (
  SELECT midpoint_hour, sum(fare) AS fare, sum(tips) AS tips
  FROM good WHERE midpoint_hour IS NOT NULL GROUP BY midpoint_hour)"""

_WEATHER = """
weather_src AS (
  SELECT *, date_trunc('hour', ts) + to_months(CAST(event_id % 6 AS INTEGER)) AS measured,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
weather_raw AS (
  SELECT CAST(event_id AS VARCHAR) AS measurement_id,
         'Station ' || CAST(user_id % 3 AS VARCHAR) || ' St' AS station,
         strftime(measured, '%m/%d/%Y %I:%M:%S %p') AS measured_text,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 100 END AS interval_rain,
         CAST(k AS DOUBLE) / 10 AS intensity
  FROM weather_src),
rain_recs AS (
  SELECT measurement_id, replace(station, ' ', '') AS station,
         try_strptime(measured_text, '%m/%d/%Y %I:%M:%S %p') AS measured_ts,
         coalesce(interval_rain, 0) AS interval_rain, coalesce(intensity, 0) AS intensity
  FROM weather_raw),
rain AS (
  SELECT measured_ts, avg(interval_rain) AS interval_rain, avg(intensity) AS intensity
  FROM rain_recs WHERE measured_ts IS NOT NULL GROUP BY measured_ts)"""

_JOINED = """,
joined AS (
  SELECT g.trip_id, r.measured_ts AS rain_ts, CAST(epoch(r.measured_ts) AS BIGINT) AS unix_time,
         r.interval_rain, r.intensity, g.fare, g.tips
  FROM good g JOIN rain r ON {on} = r.measured_ts)"""

_POINTS = """
points AS (
  SELECT vec_id AS trip_id,
         CASE WHEN label <> 0 THEN CAST(floor(CAST(embedding[1] AS DOUBLE) * 100 + 0.5) AS INTEGER)
                                   / CAST(100 AS DOUBLE) END AS start_lat,
         CASE WHEN label <> 0 THEN CAST(floor(CAST(embedding[2] AS DOUBLE) * 100 + 0.5) AS INTEGER)
                                   / CAST(100 AS DOUBLE) END AS start_lng,
         CAST(floor(CAST(embedding[3] AS DOUBLE) * 100 + 0.5) AS INTEGER) / CAST(100 AS DOUBLE) AS end_lat,
         CAST(floor(CAST(embedding[4] AS DOUBLE) * 100 + 0.5) AS INTEGER) / CAST(100 AS DOUBLE) AS end_lng
  FROM embeddings),
zips AS (
  SELECT CAST(60000 + vec_id AS INTEGER) AS zip,
         CAST(embedding[1] AS DOUBLE) AS lat, CAST(embedding[2] AS DOUBLE) AS lng
  FROM embeddings)"""

_NEAREST = """,
ends AS (
  SELECT start_lat AS lat, start_lng AS lng FROM points WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL
  UNION
  SELECT end_lat, end_lng FROM points WHERE end_lat IS NOT NULL AND end_lng IS NOT NULL),
distances AS (
  SELECT e.lat, e.lng, z.zip,
         2 * 3958.8 * asin(least(1, sqrt(
           sin((radians(z.lat) - radians(e.lat)) / 2) ** 2
           + cos(radians(e.lat)) * cos(radians(z.lat)) * sin((radians(z.lng) - radians(e.lng)) / 2) ** 2))) AS miles
  FROM ends e CROSS JOIN zips z),
nearest AS (
  SELECT lat, lng, zip, miles,
         CAST(row_number() OVER (PARTITION BY lat, lng ORDER BY miles, zip) AS INTEGER) AS place
  FROM distances QUALIFY place <= 5)"""


def _trips(select: str, unit: str = "second", extra: str = "") -> str:
    return "WITH" + _TRIPS_RAW.replace("{unit}", unit) + _TRIPS + extra + "\n" + select


def _rain(select: str) -> str:
    return "WITH" + _WEATHER + "\n" + select


def _joined(select: str, on: str, unit: str) -> str:
    ctes = _TRIPS_RAW.replace("{unit}", unit) + _TRIPS + "," + _WEATHER + _JOINED.replace("{on}", on)
    return "WITH" + ctes + "\n" + select


def _geo(select: str, extra: str = "") -> str:
    return "WITH" + _POINTS + extra + "\n" + select


# The first 32 bits of the MD5 of the seed and the key.
_DIGEST = "CAST('0x' || substr(md5('81=' || CAST(trip_id AS VARCHAR)), 1, 8) AS BIGINT)"
_RAW_TRIPS_ONLY = "WITH" + _TRIPS_RAW.replace("{unit}", "second") + "\n"
_TRIP_FIELDS = "trip_id, taxi_id, start_ts, end_ts, trip_seconds, trip_miles, fare, tips, speed_mph, midpoint_hour, year"
_PREPARED = "trip_id, fare, tips, speed_mph, start_ts, end_ts, midpoint_hour, trip_miles"
_MEANS = "midpoint_hour, round(speed_mph + 1e-10, 6) AS speed_mph, round(fare + 1e-10, 6) AS fare, round(tips + 1e-10, 6) AS tips"
_TOTALS = "midpoint_hour, round(fare + 1e-8, 4) AS fare, round(tips + 1e-8, 4) AS tips"
_RAIN = "measured_ts, round(interval_rain + 1e-10, 6) AS interval_rain, round(intensity + 1e-10, 6) AS intensity"
_JOINED_ROWS = (
    "SELECT trip_id, rain_ts, unix_time, round(interval_rain + 1e-10, 6) AS interval_rain, "
    "round(intensity + 1e-10, 6) AS intensity, fare, tips FROM joined"
)
_ON_HOUR = "date_trunc('hour', g.start_ts)"


def _pearson(a: str, b: str, name: str) -> str:
    return f"round(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0) + 1e-10, 6) AS {name}"


def _peaks(source: str, key: str, metrics: tuple[str, ...], fields: str) -> str:
    parts = [
        f"SELECT * FROM (SELECT '{m}' AS metric, {fields} FROM {source} ORDER BY {source}.{m} DESC, {key} LIMIT 1)"
        for m in metrics
    ]
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    return {
        # sources
        "scan_csv_trips": _RAW_TRIPS_ONLY
        + "SELECT CAST(trip_id AS VARCHAR) AS trip_id, CAST(taxi_id AS VARCHAR) AS taxi_id, start_text, end_text, "
        "trip_seconds, trip_miles, fare, tips FROM trips_raw",
        "scan_csv_weather": _rain("SELECT * FROM weather_raw"),
        "unreadable_fields": _RAW_TRIPS_ONLY
        + """SELECT * FROM (
  SELECT 'trip_seconds' AS "column", CAST(0 AS BIGINT) AS unreadable
  UNION ALL SELECT 'trip_miles', count(*) FROM trips_raw WHERE trip_id % 11 = 3
  UNION ALL SELECT 'fare', count(*) FROM trips_raw WHERE trip_id % 13 = 4 AND fare IS NOT NULL
  UNION ALL SELECT 'tips', count(*) FROM trips_raw WHERE trip_id % 17 = 5
  UNION ALL SELECT unnest(['start_lat', 'start_lng', 'end_lat', 'end_lng']), CAST(0 AS BIGINT))""",
        "broken_records": "WITH" + _TRIPS_RAW.replace("{unit}", "second") + "," + _WEATHER + """,
trip_rows AS (
  SELECT trip_id % 19 = 6 OR trip_id % 23 = 8 AS broken,
         trip_id % 11 = 3 OR (trip_id % 13 = 4 AND fare IS NOT NULL) OR trip_id % 17 = 5 AS unreadable
  FROM trips_raw),
weather_rows AS (
  SELECT CAST(measurement_id AS BIGINT) % 19 = 6 OR CAST(measurement_id AS BIGINT) % 23 = 8 AS broken,
         CAST(measurement_id AS BIGINT) % 29 = 3 AND interval_rain IS NOT NULL AS unreadable
  FROM weather_raw)
SELECT 'trips' AS name, count(*) FILTER (NOT broken) AS whole, count(*) FILTER (broken) AS broken,
       count(*) FILTER (NOT broken AND unreadable) AS unreadable FROM trip_rows
UNION ALL SELECT 'weather', count(*) FILTER (NOT broken), count(*) FILTER (broken),
       count(*) FILTER (NOT broken AND unreadable) FROM weather_rows""",
        "quality_of_lines": "WITH" + _TRIPS_RAW.replace("{unit}", "second") + """,
as_read AS (
  SELECT trip_id % 19 = 6 OR trip_id % 23 = 8 AS broken,
         trip_id % 11 = 3 OR (trip_id % 13 = 4 AND fare IS NOT NULL) OR trip_id % 17 = 5 AS unreadable,
         coalesce(trip_seconds, 0) AS seconds,
         CASE WHEN trip_id % 11 = 3 THEN 0 ELSE coalesce(trip_miles, 0) END AS miles,
         CASE WHEN trip_id % 13 = 4 THEN 0 ELSE coalesce(fare, 0) END AS fare
  FROM trips_raw),
judged AS (
  SELECT *, seconds >= 60 AND miles <= 1000 AND fare <= 2000 AND miles / seconds * 3600 <= 100 AS good FROM as_read)
SELECT count(*) FILTER (NOT broken) AS trips, count(*) FILTER (NOT broken AND good) AS good,
       count(*) FILTER (NOT broken AND NOT good) AS bad,
       round(CAST(count(*) FILTER (NOT broken AND NOT good) AS DOUBLE) / count(*) FILTER (NOT broken) * 100 + 1e-10, 6) AS bad_pct,
       count(*) FILTER (NOT broken AND unreadable) AS unreadable, count(*) FILTER (broken) AS broken
FROM judged""",
        "stage_roundtrip": _trips(f"SELECT {_TRIP_FIELDS} FROM trips"),
        # projections
        "trip_defaults": _trips("SELECT trip_id, trip_seconds, trip_miles, fare, tips FROM trips"),
        "trip_times": _trips("SELECT trip_id, start_ts, end_ts FROM trips"),
        "trip_year": _trips("SELECT trip_id, year FROM trips"),
        "trip_speed": _trips("SELECT trip_id, speed_mph FROM trips"),
        "trip_midpoint_hour": _trips("SELECT trip_id, midpoint_hour FROM trips"),
        "trip_revenue": _trips("SELECT trip_id, fare + tips AS revenue FROM trips"),
        "trip_tip_pct": _trips("SELECT trip_id, tip_pct FROM tip_recs"),
        "trip_tip_per_mile": _trips("SELECT trip_id, tip_per_mile FROM tip_recs"),
        "trip_month_name": _trips("SELECT trip_id, month, month_name FROM tip_recs"),
        "prepared_trips": _trips(f"SELECT {_PREPARED} FROM good"),
        "tip_records": _trips("SELECT * FROM tip_recs"),
        "trip_coordinates": "WITH" + _TRIPS_RAW.replace("{unit}", "second") + _TRIPS + "," + _POINTS
        + "\nSELECT trip_id, start_ts, start_lat, start_lng, end_lat, end_lng FROM points JOIN trips USING (trip_id)",
        "rain_records": _rain("SELECT * FROM rain_recs"),
        "trip_unix_time": _trips("SELECT trip_id, CAST(epoch(start_ts) AS BIGINT) AS unix_time FROM trips"),
        # filters
        "good_trips": _trips(f"SELECT {_TRIP_FIELDS} FROM good"),
        "year_slice": _trips(f"SELECT {_TRIP_FIELDS} FROM good WHERE year = 2025"),
        "taxi_slice": _trips("SELECT trip_id, taxi_id, start_ts, fare, tips FROM good WHERE taxi_id = 7"),
        "valid_points": _geo("SELECT * FROM points WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL"),
        "sample_trips": _trips(f"SELECT {_TRIP_FIELDS} FROM trips WHERE {_DIGEST} < 42949672"),
        # As many copies of a row as limits of the Poisson distribution lie below its digest.
        "bootstrap_points": _geo(
            f"SELECT points.* FROM points JOIN limits ON {_DIGEST} >= copies_from",
            """,
limits AS (
  SELECT floor(sum(exp(-0.1) * pow(0.1, i) / factorial(CAST(i AS INTEGER))) OVER (ORDER BY i) * 4294967296) AS copies_from
  FROM (SELECT unnest(range(9)) AS i))""",
        ),
        "sample_check": "SELECT unnest(['foreign', 'repeated', 'foreign_points']) AS name, CAST(0 AS BIGINT) AS rows",
        # counts and quality
        "trip_count": _trips("SELECT count(*) AS trips FROM trips"),
        "trips_by_year": _trips("SELECT year, count(*) AS trips FROM trips WHERE year IS NOT NULL GROUP BY year"),
        "good_trips_by_year": _trips("SELECT year, count(*) AS trips FROM good WHERE year IS NOT NULL GROUP BY year"),
        "quality_summary": _trips(
            "SELECT t.n AS trips, g.n AS good, t.n - g.n AS bad, "
            "round(CAST(t.n - g.n AS DOUBLE) / t.n * 100 + 1e-10, 6) AS bad_pct "
            "FROM (SELECT count(*) AS n FROM trips) t, (SELECT count(*) AS n FROM good) g"
        ),
        # revenue
        "taxi_revenue_per_trip": _trips(
            "SELECT taxi_id, round(avg(fare + tips) + 1e-10, 6) AS revenue_per_trip FROM good GROUP BY taxi_id"
        ),
        "taxi_revenue_per_day": _trips(
            "SELECT taxi_id, count(DISTINCT CAST(start_ts AS DATE)) AS days, "
            "round(sum(fare + tips) / count(DISTINCT CAST(start_ts AS DATE)) + 1e-10, 6) AS revenue_per_day "
            "FROM good WHERE start_ts IS NOT NULL GROUP BY taxi_id"
        ),
        "top_taxis_per_trip": _trips(
            "SELECT taxi_id, round(avg(fare + tips) + 1e-10, 6) AS revenue_per_trip FROM good "
            "GROUP BY taxi_id ORDER BY avg(fare + tips) DESC, taxi_id LIMIT 6"
        ),
        "top_taxi_total": _trips(
            "SELECT taxi_id, round(sum(fare + tips) + 1e-8, 4) AS revenue FROM good WHERE year = 2025 "
            "GROUP BY taxi_id ORDER BY sum(fare + tips) DESC, taxi_id LIMIT 1"
        ),
        # hour of day
        "hourly_means": _trips(f"SELECT {_MEANS} FROM means", extra=_HOURLY),
        "hourly_totals": _trips(f"SELECT {_TOTALS} FROM totals", extra=_HOURLY),
        "hourly_peaks": _trips(
            _peaks("means", "midpoint_hour", ("speed_mph", "fare", "tips"), _MEANS), extra=_HOURLY
        ),
        "hourly_total_peaks": _trips(_peaks("totals", "midpoint_hour", ("fare", "tips"), _TOTALS), extra=_HOURLY),
        "metric_maxima": _trips(
            "SELECT round(max(speed_mph) + 1e-10, 6) AS speed_mph, round(max(fare) + 1e-10, 6) AS fare, "
            "round(max(tips) + 1e-10, 6) AS tips FROM means",
            extra=_HOURLY,
        ),
        # tips
        "overall_tip_pct": _trips("SELECT round(sum(tips) / sum(fare) * 100 + 1e-10, 6) AS tip_pct FROM good"),
        "monthly_tip_means": _trips(
            "SELECT month, month_name, round(avg(fare) + 1e-10, 6) AS fare, round(avg(tips) + 1e-10, 6) AS tips, "
            "round(avg(tip_per_mile) + 1e-10, 6) AS tip_per_mile, round(avg(tip_pct) + 1e-10, 6) AS tip_pct "
            "FROM tip_recs WHERE month IS NOT NULL GROUP BY month, month_name"
        ),
        "top_tips_per_mile": _trips("SELECT * FROM tip_recs ORDER BY tip_per_mile DESC, trip_id LIMIT 10"),
        "trips_chronological": _trips("SELECT * FROM tip_recs ORDER BY start_ts, trip_id"),
        "first_trips": _trips("SELECT * FROM tip_recs ORDER BY start_ts, trip_id LIMIT 10"),
        # rain
        "rain_by_time": _rain(f"SELECT {_RAIN} FROM rain"),
        "rain_peaks": _rain(_peaks("rain", "measured_ts", ("interval_rain", "intensity"), _RAIN)),
        "trips_with_rain": _joined(_JOINED_ROWS, "g.start_ts", "hour"),
        "trips_with_rain_hourly": _joined(_JOINED_ROWS, _ON_HOUR, "second"),
        "time_money_corr": _joined(
            "SELECT "
            + ", ".join(_pearson("unix_time", m, f"time_{m}_corr") for m in ("fare", "tips"))
            + " FROM joined",
            _ON_HOUR,
            "second",
        ),
        "rain_money_corr": _joined(
            "SELECT "
            + ", ".join(
                _pearson(r, m, f"{r}_{m}_corr") for r in ("interval_rain", "intensity") for m in ("fare", "tips")
            )
            + " FROM joined",
            _ON_HOUR,
            "second",
        ),
        # positions
        "pickup_counts": _geo(
            "SELECT start_lat, start_lng, count(*) AS trips FROM points "
            "WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL GROUP BY start_lat, start_lng"
        ),
        "point_bounds": _geo(
            "SELECT min(start_lat) AS min_start_lat, max(start_lat) AS max_start_lat, "
            "min(start_lng) AS min_start_lng, max(start_lng) AS max_start_lng FROM points "
            "WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL"
        ),
        "cluster_check": _geo(
            "SELECT 'assigned' AS name, count(*) AS rows FROM points "
            "WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL "
            "UNION ALL SELECT unnest(['not_nearest', 'left_out']), CAST(0 AS BIGINT)"
        ),
        "hotspot_check": _geo(
            "SELECT start_lat, start_lng, count(*) AS trips FROM points "
            "WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL GROUP BY start_lat, start_lng"
        ),
        "centre_check": _geo(
            "SELECT 'centres' AS name, least(10, count(*)) AS rows FROM (SELECT DISTINCT start_lat, start_lng FROM points "
            "WHERE start_lat IS NOT NULL AND start_lng IS NOT NULL) "
            "UNION ALL SELECT unnest(['not_mean', 'out_of_order', 'parts_out_of_order']), CAST(0 AS BIGINT)"
        ),
        "silhouette_check": "SELECT unnest(['out_of_range', 'not_equal']) AS name, CAST(0 AS BIGINT) AS rows",
        "nearest_zips": _geo("SELECT lat, lng, place, zip, round(miles + 1e-10, 6) AS miles FROM nearest", _NEAREST),
        "zip_pairs": _geo(
            "SELECT DISTINCT p.trip_id, least(s.zip, e.zip) AS zip_a, greatest(s.zip, e.zip) AS zip_b "
            "FROM points p JOIN nearest s ON s.lat = p.start_lat AND s.lng = p.start_lng "
            "JOIN nearest e ON e.lat = p.end_lat AND e.lng = p.end_lng AND e.place = s.place",
            _NEAREST,
        ),
    }
