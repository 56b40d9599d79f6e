"""Independent DuckDB SQL for every registered query (the oracle).

Written from the operator definitions, not generated from the Spark plans.
Shared CTEs are assembled per query.
"""

from __future__ import annotations

RATES = """rates(tariff_code, period_name, start_hour, end_hour, unit_rate) AS (
  VALUES ('standard', 'all_day', 0, 24, 0.28::DOUBLE),
         ('economy7', 'night', 0, 7, 0.14::DOUBLE),
         ('economy7', 'day', 7, 24, 0.31::DOUBLE),
         ('ev_special', 'ev_window', 0, 5, 0.09::DOUBLE),
         ('ev_special', 'day', 5, 24, 0.30::DOUBLE),
         ('green', 'all_day', 0, 24, 0.32::DOUBLE))"""

READINGS = """readings AS (
  SELECT user_id AS meter_id, user_id AS customer_id,
         date_trunc('hour', ts) AS reading_ts, value AS interval_kwh,
         230.0::DOUBLE + CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS voltage,
         CASE WHEN event_type = 'error' THEN 'MISSING'
              WHEN event_type = 'view' AND value > 150 THEN 'SUSPECT_HIGH'
              ELSE 'GOOD' END AS quality,
         event_id AS _ingested_at
  FROM events)"""

LATEST = """latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY meter_id, reading_ts ORDER BY _ingested_at DESC) AS rn
    FROM readings) WHERE rn = 1)"""

NULLED = """nulled AS (
  SELECT meter_id, customer_id, reading_ts,
         CASE WHEN quality = 'MISSING' THEN NULL ELSE interval_kwh END AS interval_kwh,
         voltage, quality, _ingested_at
  FROM latest)"""

GOOD = """good AS (
  SELECT * FROM nulled WHERE reading_ts IS NOT NULL AND quality IS NOT DISTINCT FROM 'GOOD')"""

CHANGES = """changes AS (
  SELECT meter_id, change_date,
         ['standard', 'economy7', 'ev_special', 'green'][CAST(eid % 4 AS INTEGER) + 1] AS tariff_code
  FROM (SELECT user_id AS meter_id, CAST(ts AS DATE) AS change_date, max(event_id) AS eid
        FROM events WHERE event_type = 'signup' GROUP BY 1, 2))"""

HIST = """hist AS (
  SELECT CAST(row_number() OVER (ORDER BY meter_id, valid_from) AS BIGINT) AS meter_tariff_sk,
         meter_id, tariff_code, valid_from, valid_to, is_current
  FROM (
    SELECT meter_id, tariff_code,
           CAST(change_date AS VARCHAR) AS valid_from,
           CAST(coalesce(lead(change_date) OVER w - 1,
                         (SELECT max(CAST(ts AS DATE)) FROM events)) AS VARCHAR) AS valid_to,
           lead(change_date) OVER w IS NULL AS is_current
    FROM changes
    WINDOW w AS (PARTITION BY meter_id ORDER BY change_date)))"""

WEATHER = """wh AS (
  SELECT date_trunc('hour', ts) AS weather_ts, arg_min(value, event_id) AS temperature_2m,
         CAST(count(*) AS DOUBLE) AS relative_humidity_2m, min(value) AS cloud_cover,
         max(value) AS shortwave_radiation, 59.91::DOUBLE AS latitude, 10.75::DOUBLE AS longitude
  FROM events WHERE event_type = 'view' GROUP BY 1),
wf AS (
  SELECT date_trunc('hour', ts) AS weather_ts, arg_min(value, event_id) AS temperature_2m,
         CAST(count(*) AS DOUBLE) AS relative_humidity_2m,
         max(value) AS shortwave_radiation, 59.91::DOUBLE AS latitude, 10.75::DOUBLE AS longitude
  FROM events WHERE event_type = 'click' GROUP BY 1),
weather AS (
  SELECT * EXCLUDE (rn, prio) FROM (
    SELECT *, row_number() OVER (PARTITION BY weather_ts, latitude, longitude ORDER BY prio) AS rn
    FROM (SELECT *, 1 AS prio FROM wh UNION ALL BY NAME SELECT *, 2 AS prio FROM wf))
  WHERE rn = 1)"""

TARIFFED = """tariffed AS (
  SELECT g.*, h.tariff_code
  FROM good g LEFT JOIN hist h
    ON g.meter_id = h.meter_id
   AND g.reading_ts >= CAST(CAST(h.valid_from AS DATE) AS TIMESTAMP)
   AND g.reading_ts < CAST(CAST(h.valid_to AS DATE) + 1 AS TIMESTAMP))"""

SILVER = """silver AS (
  SELECT t.*, w.temperature_2m, w.relative_humidity_2m, date_trunc('hour', t.reading_ts) AS hour_ts
  FROM tariffed t LEFT JOIN weather w ON date_trunc('hour', t.reading_ts) = w.weather_ts)"""

FACT = """fact AS (
  SELECT s.meter_id, s.reading_ts, s.hour_ts, strftime(s.reading_ts, '%Y-%m-%d') AS date_key,
         s.interval_kwh, s.voltage, s.tariff_code, r.period_name, r.unit_rate,
         round(s.interval_kwh * r.unit_rate, 6) AS cost
  FROM silver s JOIN rates r
    ON s.tariff_code = r.tariff_code
   AND extract(hour FROM (s.reading_ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Oslo') >= r.start_hour
   AND extract(hour FROM (s.reading_ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Oslo') < r.end_hour)"""

DAILY = """daily AS (
  SELECT meter_id, date_key, tariff_code,
         round(CAST(coalesce(sum(TRY_CAST(interval_kwh AS DECIMAL(28,8))), 0) AS DOUBLE), 4) AS kwh,
         round(CAST(coalesce(sum(TRY_CAST(cost AS DECIMAL(28,8))), 0) AS DOUBLE), 6) AS cost,
         CAST(sum(TRY_CAST(voltage AS DECIMAL(28,8))) AS DOUBLE) / NULLIF(count(TRY_CAST(voltage AS DECIMAL(28,8))), 0) AS avg_voltage,
         sum(TRY_CAST(voltage AS DECIMAL(28,8))) AS voltage_sum, count(TRY_CAST(voltage AS DECIMAL(28,8))) AS voltage_n
  FROM fact
  WHERE meter_id IS NOT NULL AND date_key IS NOT NULL AND tariff_code IS NOT NULL
  GROUP BY meter_id, date_key, tariff_code)"""

DAILY_ROWS = "SELECT * EXCLUDE (voltage_sum, voltage_n) FROM daily"

SILVER_CHAIN = [READINGS, LATEST, NULLED, GOOD, CHANGES, HIST, WEATHER, TARIFFED, SILVER]
GOLD_CHAIN = [RATES, *SILVER_CHAIN, FACT, DAILY]


def with_ctes(ctes, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


ORACLE = {
    "daily_cost": with_ctes(GOLD_CHAIN, DAILY_ROWS),
}

BOUNDS = """bounds AS (
  SELECT min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day FROM events)"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS meter_id, c_custkey AS customer_id, c_acctbal > 0 AS has_solar,
         CAST((c_nationkey % 5 + 5) % 5 + 1 AS INTEGER) AS occupants,
         CAST(NULL AS VARCHAR) AS join_date, c_nationkey, c_mktsegment
  FROM customer)"""

METERS = """meters AS (
  SELECT meter_id, customer_id, 1 AS location_id, has_solar,
         'SM-' || CASE WHEN has_solar THEN 'S' ELSE 'B' END AS meter_model
  FROM customers)"""

WEATHER_DAILY = """weather_daily AS (
  SELECT strftime(weather_ts, '%Y-%m-%d') AS date_key,
         CAST(sum(TRY_CAST(temperature_2m AS DECIMAL(28,8))) AS DOUBLE) / NULLIF(count(TRY_CAST(temperature_2m AS DECIMAL(28,8))), 0) AS avg_temp_c,
         min(temperature_2m) FILTER (NOT isnan(temperature_2m)) AS min_temp_c,
         max(temperature_2m) FILTER (NOT isnan(temperature_2m)) AS max_temp_c,
         CAST(sum(TRY_CAST(cloud_cover AS DECIMAL(28,8))) AS DOUBLE) / NULLIF(count(TRY_CAST(cloud_cover AS DECIMAL(28,8))), 0) AS avg_cloud_pct,
         CAST(sum(TRY_CAST(shortwave_radiation AS DECIMAL(28,8))) AS DOUBLE) / NULLIF(count(TRY_CAST(shortwave_radiation AS DECIMAL(28,8))), 0) AS avg_radiation
  FROM weather GROUP BY 1)"""

METER_DAY = """meter_day AS (
  SELECT meter_id, date_key, round(sum(kwh), 4) AS kwh, round(sum(cost), 6) AS cost
  FROM daily GROUP BY 1, 2)"""

CALENDAR = """calendar AS (
  SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week,
         isodow(d) >= 6 AS is_weekend,
         CASE WHEN month(d) IN (12, 1, 2) THEN 'winter' WHEN month(d) IN (3, 4, 5) THEN 'spring'
              WHEN month(d) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season
  FROM bounds, generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY) AS g(d))"""

TARIFF_NAMES = """tariffs(tariff_code, tariff_name) AS (
  VALUES ('standard', 'Standard Flat'), ('economy7', 'Economy 7'),
         ('ev_special', 'EV Overnight'), ('green', '100% Green'))"""

STAR = """star AS (
  SELECT d.*, c.c_mktsegment, n.n_name, r.r_name, t.tariff_name, k.is_weekend, k.season
  FROM daily d
  JOIN customers c ON d.meter_id = c.meter_id
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN tariffs t ON d.tariff_code = t.tariff_code
  JOIN calendar k ON d.date_key = k.date)"""

READING_COLS = "meter_id, customer_id, reading_ts, interval_kwh, voltage, quality, _ingested_at"
ANALYTICS = [*GOLD_CHAIN, METER_DAY]

ORACLE.update({
    "dedupe_latest": with_ctes([READINGS, LATEST], "SELECT * FROM latest"),
    "bronze_text_typing": with_ctes([READINGS, LATEST], "SELECT * FROM latest"),
    "null_sentinel": with_ctes([READINGS, LATEST, NULLED], "SELECT * FROM nulled"),
    "fault_rows": with_ctes(
        [READINGS, LATEST, NULLED], "SELECT * FROM nulled WHERE quality IS DISTINCT FROM 'GOOD'"
    ),
    "quarantine_split": with_ctes(
        [READINGS, LATEST, NULLED],
        """SELECT *, CASE WHEN reading_ts IS NULL THEN 'BAD_TIMESTAMP'
                          WHEN quality IS NULL THEN 'NULL_QUALITY'
                          WHEN quality <> 'GOOD' THEN quality END AS reason
           FROM nulled""",
    ),
    "weather_reconciled": with_ctes([WEATHER], "SELECT * FROM weather"),
    "readings_with_tariff": with_ctes(
        [READINGS, LATEST, NULLED, GOOD, CHANGES, HIST, TARIFFED], "SELECT * FROM tariffed"
    ),
    "readings_with_weather": with_ctes(SILVER_CHAIN, "SELECT * FROM silver"),
    "window_trim": with_ctes(
        [READINGS, LATEST, BOUNDS],
        """SELECT latest.* FROM latest, bounds
           WHERE CAST(reading_ts AS DATE) >= first_day + 1 AND CAST(reading_ts AS DATE) <= last_day - 1""",
    ),
    "cost_fact": with_ctes([RATES, *SILVER_CHAIN, FACT], "SELECT * FROM fact"),
    "weather_daily": with_ctes([WEATHER, WEATHER_DAILY], "SELECT * FROM weather_daily"),
    "scd2_history": with_ctes([CHANGES, HIST], "SELECT * FROM hist"),
    "calendar_dim": with_ctes([BOUNDS, CALENDAR], "SELECT * FROM calendar"),
    "meter_dim": with_ctes([CUSTOMERS, METERS], "SELECT * FROM meters"),
    "customer_dim": with_ctes(
        [CUSTOMERS],
        "SELECT customer_id, 'residential' AS segment, occupants, join_date FROM customers",
    ),
    "coverage": with_ctes(
        [READINGS, LATEST, BOUNDS, CUSTOMERS, METERS],
        """SELECT m.meter_id, CAST(CAST(g.d AS DATE) AS VARCHAR) AS date_key,
                  CAST(24 AS BIGINT) AS expected, CAST(coalesce(p.present, 0) AS BIGINT) AS present
           FROM meters m
           CROSS JOIN bounds
           CROSS JOIN generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)
           LEFT JOIN (SELECT meter_id, CAST(reading_ts AS DATE) AS day, count(DISTINCT reading_ts) AS present
                      FROM latest WHERE reading_ts IS NOT NULL GROUP BY 1, 2) p
             ON p.meter_id = m.meter_id AND p.day = CAST(g.d AS DATE)""",
    ),
    "value_frequencies": with_ctes(
        [READINGS],
        "SELECT quality, count(*) AS count FROM readings WHERE quality IS NOT NULL GROUP BY quality",
    ),
    "load_curve": with_ctes(
        [READINGS, LATEST],
        """SELECT CAST(extract(hour FROM reading_ts) AS INTEGER) AS hour,
                  CAST(sum(TRY_CAST(interval_kwh AS DECIMAL(28,8))) AS DOUBLE) / NULLIF(count(TRY_CAST(interval_kwh AS DECIMAL(28,8))), 0) AS avg_interval_kwh
           FROM latest WHERE reading_ts IS NOT NULL GROUP BY 1""",
    ),
    "table_counts": with_ctes(
        [READINGS],
        "SELECT count(*) AS row_count, CAST(7 AS BIGINT) AS column_count FROM readings",
    ),
    "head_rows": with_ctes(
        [READINGS, LATEST], "SELECT * FROM latest ORDER BY reading_ts, meter_id LIMIT 10"
    ),
    "table_profile": with_ctes(
        [READINGS, LATEST, NULLED],
        """SELECT 'interval_kwh' AS "column", count(interval_kwh) AS count,
                  count(DISTINCT interval_kwh) AS unique, CAST(NULL AS VARCHAR) AS top,
                  CAST(NULL AS BIGINT) AS freq,
                  CAST(sum(TRY_CAST(interval_kwh AS DECIMAL(28,8))) AS DOUBLE) / NULLIF(count(TRY_CAST(interval_kwh AS DECIMAL(28,8))), 0) AS mean,
                  round(stddev_samp(interval_kwh), 6) AS std,
                  round(min(interval_kwh), 6) AS min,
                  round(quantile_cont(interval_kwh, 0.25), 6) AS p25,
                  round(quantile_cont(interval_kwh, 0.5), 6) AS p50,
                  round(quantile_cont(interval_kwh, 0.75), 6) AS p75,
                  round(max(interval_kwh), 6) AS max
           FROM nulled
           UNION ALL
           SELECT 'voltage', count(voltage), count(DISTINCT voltage), NULL, NULL,
                  CAST(sum(TRY_CAST(voltage AS DECIMAL(28,8))) AS DOUBLE) / NULLIF(count(TRY_CAST(voltage AS DECIMAL(28,8))), 0), round(stddev_samp(voltage), 6),
                  round(min(voltage), 6),
                  round(quantile_cont(voltage, 0.25), 6), round(quantile_cont(voltage, 0.5), 6),
                  round(quantile_cont(voltage, 0.75), 6), round(max(voltage), 6)
           FROM nulled
           UNION ALL
           SELECT 'reading_ts', count(reading_ts), count(DISTINCT reading_ts), NULL, NULL,
                  CAST(sum(CAST(epoch(reading_ts) AS DECIMAL(28,0))) AS DOUBLE) / NULLIF(count(reading_ts), 0),
                  NULL, round(min(epoch(reading_ts)), 6),
                  round(quantile_cont(epoch(reading_ts), 0.25), 6), round(quantile_cont(epoch(reading_ts), 0.5), 6),
                  round(quantile_cont(epoch(reading_ts), 0.75), 6), round(max(epoch(reading_ts)), 6)
           FROM nulled
           UNION ALL
           SELECT 'quality', count(quality), count(DISTINCT quality),
                  (SELECT quality FROM nulled WHERE quality IS NOT NULL GROUP BY quality
                   ORDER BY count(*) DESC, quality LIMIT 1),
                  (SELECT count(*) FROM nulled WHERE quality IS NOT NULL GROUP BY quality
                   ORDER BY count(*) DESC LIMIT 1),
                  NULL, NULL, NULL, NULL, NULL, NULL, NULL
           FROM nulled""",
    ),
    "usage_mtd": with_ctes(
        ANALYTICS,
        """SELECT meter_id, date_key, kwh,
                  round(sum(kwh) OVER (PARTITION BY meter_id, date_trunc('month', CAST(date_key AS DATE))
                                       ORDER BY date_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4)
                  AS mtd_kwh
           FROM meter_day""",
    ),
    "usage_ytd": with_ctes(
        ANALYTICS,
        """SELECT meter_id, date_key, kwh,
                  round(sum(kwh) OVER (PARTITION BY meter_id, date_trunc('year', CAST(date_key AS DATE))
                                       ORDER BY date_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4)
                  AS ytd_kwh
           FROM meter_day""",
    ),
    "usage_qtd": with_ctes(
        ANALYTICS,
        """SELECT meter_id, date_key, kwh,
                  round(sum(kwh) OVER (PARTITION BY meter_id, date_trunc('quarter', CAST(date_key AS DATE))
                                       ORDER BY date_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4)
                  AS qtd_kwh
           FROM meter_day""",
    ),
    "usage_rolling7": with_ctes(
        ANALYTICS,
        """SELECT meter_id, date_key, kwh,
                  round(sum(kwh) OVER (PARTITION BY meter_id ORDER BY CAST(date_key AS DATE)
                                       RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 4)
                  AS rolling7_kwh
           FROM meter_day""",
    ),
    "tariff_what_if": with_ctes(
        [RATES, *SILVER_CHAIN, FACT],
        """SELECT tariff_code, CAST(p AS DOUBLE) AS pct_change, readings,
                  CAST(raw AS DOUBLE) AS baseline_cost,
                  CAST(round(raw + raw * p, 6) AS DOUBLE) AS scenario_cost,
                  CAST(round(raw * p, 6) AS DOUBLE) AS difference
           FROM (SELECT tariff_code, CAST(sum(CAST(cost AS DECIMAL(28,6))) AS DECIMAL(30,6)) AS raw, count(*) AS readings
                 FROM fact WHERE tariff_code IS NOT NULL GROUP BY 1) b,
                (VALUES (CAST(-0.1 AS DECIMAL(6,4))), (0.0), (0.1)) AS s(p)""",
    ),
    "temp_elasticity": with_ctes(
        [*ANALYTICS, WEATHER_DAILY, CUSTOMERS, METERS],
        """, per_day AS (
             SELECT m.has_solar, md.date_key, CAST(count(*) AS DECIMAL(12,0)) AS n, sum(TRY_CAST(kwh AS DECIMAL(18,6))) AS y,
                    sum(TRY_CAST(kwh AS DECIMAL(19,6)) * TRY_CAST(kwh AS DECIMAL(19,6))) AS yy
             FROM meter_day md JOIN meters m ON md.meter_id = m.meter_id GROUP BY 1, 2
           ), days AS (
             SELECT p.has_solar, n, y, yy, TRY_CAST(w.avg_temp_c AS DECIMAL(18,8)) AS x,
                    CAST(floor(CAST(sum(x * n) OVER g AS DOUBLE) / CAST(sum(n) OVER g AS DOUBLE)) AS DECIMAL(6,0)) AS sx,
                    CAST(floor(CAST(sum(y) OVER g AS DOUBLE) / CAST(sum(n) OVER g AS DOUBLE)) AS DECIMAL(6,0)) AS sy
             FROM per_day p JOIN weather_daily w ON p.date_key = w.date_key WINDOW g AS (PARTITION BY p.has_solar)
           ), shifted AS (
             SELECT has_solar, CAST(n AS DECIMAL(8,0)) AS n, sx, sy, CAST(x - sx AS DECIMAL(12,8)) AS x,
                    CAST(y - n * sy AS DECIMAL(18,6)) AS y,
                    CAST(CAST(yy AS DECIMAL(26,12)) - CAST(2 * sy * CAST(y AS DECIMAL(24,6)) AS DECIMAL(26,6)) + CAST(n * sy * sy AS DECIMAL(26,0)) AS DECIMAL(28,12)) AS yy
             FROM days WHERE x IS NOT NULL
           ), sums AS (
             SELECT has_solar, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(n * CAST(x AS DECIMAL(19,8))) AS DOUBLE) AS x, CAST(sum(y) AS DOUBLE) AS y,
                    CAST(sum(n * CAST(CAST(x AS DECIMAL(19,8)) * CAST(x AS DECIMAL(19,8)) AS DECIMAL(20,12))) AS DOUBLE) AS xx, CAST(sum(CAST(CAST(x AS DECIMAL(19,8)) * CAST(y AS DECIMAL(19,6)) AS DECIMAL(28,12))) AS DOUBLE) AS xy,
                    CAST(sum(yy) AS DOUBLE) AS yy, CAST(max(sx) AS DOUBLE) AS sx, CAST(max(sy) AS DOUBLE) AS sy
             FROM shifted GROUP BY has_solar
           ), moments AS (
             SELECT *, xx - x * x / n AS sxx, xy - x * y / n AS sxy, yy - y * y / n AS syy FROM sums
           )
           SELECT has_solar, sxy / sxx AS slope, y / n + sy - sxy / sxx * (x / n + sx) AS intercept,
                  sxy * sxy / (sxx * syy) AS r2, CAST(n AS BIGINT) AS n FROM moments""",
    ),
    "fault_tree": with_ctes(
        [READINGS, LATEST, CUSTOMERS, METERS],
        """SELECT quality, meter_model, month, count(*) AS faults,
                  CAST(GROUPING(quality, meter_model, month) AS INTEGER) AS level
           FROM (SELECT coalesce(l.quality, 'NULL') AS quality,
                        coalesce(m.meter_model, 'UNKNOWN') AS meter_model,
                        strftime(l.reading_ts, '%Y-%m') AS month
                 FROM latest l LEFT JOIN meters m ON l.meter_id = m.meter_id
                 WHERE l.quality IS DISTINCT FROM 'GOOD')
           GROUP BY ROLLUP (quality, meter_model, month)""",
    ),
    "usage_anomalies": with_ctes(
        ANALYTICS,
        """SELECT meter_id, date_key, kwh, m AS baseline_mean,
                  round(CASE WHEN n >= 2 AND s > 0 THEN (kwh - m) / s END, 6) AS z,
                  CASE WHEN n < 2 THEN false WHEN s = 0 THEN kwh <> m
                       ELSE abs((kwh - m) / s) > 3.0 END AS is_anomaly
           FROM (SELECT *,
                   CAST(sum(TRY_CAST(kwh AS DECIMAL(28,8))) OVER w AS DOUBLE) / NULLIF(count(kwh) OVER w, 0) AS m,
                   stddev_samp(kwh) OVER w AS s, count(kwh) OVER w AS n
                 FROM meter_day
                 WINDOW w AS (PARTITION BY meter_id ORDER BY CAST(date_key AS DATE)
                              RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))""",
    ),
    "meter_profile": with_ctes(
        [*ANALYTICS],
        """SELECT r.*, d.avg_daily_kwh, d.min_daily_kwh, d.max_daily_kwh, d.days,
                  round(r.faults / r.readings, 6) AS fault_share
           FROM (SELECT meter_id, count(*) AS readings,
                        CAST(sum(CASE WHEN quality IS DISTINCT FROM 'GOOD' THEN 1 ELSE 0 END) AS BIGINT) AS faults,
                        round(coalesce(sum(interval_kwh), 0), 4) AS total_kwh,
                        min(reading_ts) AS first_reading, max(reading_ts) AS last_reading
                 FROM nulled GROUP BY meter_id) r
           LEFT JOIN (SELECT meter_id, CAST(sum(TRY_CAST(kwh AS DECIMAL(28,8))) AS DOUBLE) / NULLIF(count(kwh), 0) AS avg_daily_kwh, round(min(kwh), 4) AS min_daily_kwh,
                             round(max(kwh), 4) AS max_daily_kwh, count(*) AS days
                      FROM meter_day GROUP BY meter_id) d ON r.meter_id = d.meter_id""",
    ),
    "star_usage": with_ctes(
        [*GOLD_CHAIN, CUSTOMERS, BOUNDS, CALENDAR, TARIFF_NAMES, STAR],
        """SELECT r_name, tariff_name, is_weekend, round(CAST(sum(CAST(kwh AS DECIMAL(28,8))) AS DOUBLE), 4) AS kwh,
                  round(CAST(sum(CAST(cost AS DECIMAL(28,8))) AS DOUBLE), 6) AS cost, count(DISTINCT meter_id) AS meters
           FROM star GROUP BY 1, 2, 3""",
    ),
    "usage_by_dim": with_ctes(
        [*GOLD_CHAIN, CUSTOMERS, BOUNDS, CALENDAR, TARIFF_NAMES, STAR],
        "SELECT n_name, season, round(sum(cost), 6) AS cost FROM star GROUP BY 1, 2",
    ),
    **{
        name: with_ctes(
            [*GOLD_CHAIN, CUSTOMERS, BOUNDS, CALENDAR, TARIFF_NAMES, STAR],
            f"SELECT n_name, season, {metric} FROM star GROUP BY 1, 2",
        )
        for name, metric in {
            "usage_by_kwh": "round(sum(kwh), 4) AS kwh",
            "usage_by_voltage": "CAST(sum(voltage_sum) AS DOUBLE) / sum(voltage_n) AS avg_voltage",
            "usage_by_meter_days": "count(*) AS meter_days",
            "usage_by_meters": "count(DISTINCT meter_id) AS meters",
        }.items()
    },
    "entitled_rows": with_ctes(
        [*GOLD_CHAIN, CUSTOMERS],
        f"""{DAILY_ROWS}
           WHERE meter_id IN (SELECT meter_id FROM customers WHERE c_mktsegment = 'BUILDING')""",
    ),
    "json_payload_roundtrip": with_ctes([READINGS, LATEST], "SELECT * FROM latest"),
    "weather_payload_rows": with_ctes(
        [WEATHER],
        f"""SELECT weather_ts, temperature_2m, CAST(NULL AS DOUBLE) AS apparent_temperature,
                   relative_humidity_2m, cloud_cover, CAST(NULL AS DOUBLE) AS wind_speed_10m,
                   shortwave_radiation, latitude, longitude
            FROM weather""",
    ),
    "csv_roundtrip": with_ctes([READINGS, LATEST], "SELECT * FROM latest"),
    "partitioned_roundtrip": with_ctes(SILVER_CHAIN, "SELECT * FROM silver"),
    "stream_ingest_latest": with_ctes([READINGS, LATEST], f"SELECT {READING_COLS} FROM latest"),
    "stream_bronze_append": with_ctes([READINGS], f"SELECT {READING_COLS} FROM readings"),
    "jsonl_roundtrip": with_ctes([READINGS, LATEST], "SELECT * FROM latest"),
    "bronze_load_counts": with_ctes(
        [CHANGES, WEATHER, BOUNDS, CALENDAR],
        """SELECT 'meter_readings' AS table_name, count(*) AS row_count FROM events
           UNION ALL SELECT 'weather_history', count(*) FROM wh
           UNION ALL SELECT 'weather_forecast', count(*) FROM wf
           UNION ALL SELECT 'dim_date', count(*) FROM calendar
           UNION ALL SELECT 'dim_meter', count(*) FROM customer
           UNION ALL SELECT 'dim_customer', count(*) FROM customer
           UNION ALL SELECT 'dim_location', 1 UNION ALL SELECT 'dim_tariff', 4 UNION ALL SELECT 'dim_tariff_rate', 6
           UNION ALL SELECT 'dim_meter_tariff', count(*) FROM changes""",
    ),
    "bronze_load_content": with_ctes(
        [CHANGES, HIST, CUSTOMERS, METERS, TARIFF_NAMES],
        """SELECT h.meter_id, m.customer_id, h.tariff_code, t.tariff_name, h.valid_from, h.valid_to, h.is_current,
                  m.meter_model, c.occupants
           FROM hist h JOIN meters m USING (meter_id) JOIN customers c ON c.customer_id = m.customer_id
           JOIN tariffs t ON t.tariff_code = h.tariff_code""",
    ),
    "entitled_user": with_ctes(
        [*GOLD_CHAIN, CUSTOMERS],
        f"{DAILY_ROWS} WHERE meter_id IN (SELECT meter_id FROM customers WHERE c_nationkey = 3)",
    ),
    "weather_two_sites": with_ctes(
        [*SILVER_CHAIN, CUSTOMERS],
        """SELECT s.* REPLACE (
             CASE WHEN c.meter_id IS NULL THEN NULL ELSE temperature_2m + 5 * (c.meter_id % 2) END AS temperature_2m,
             CASE WHEN c.meter_id IS NULL THEN NULL ELSE relative_humidity_2m END AS relative_humidity_2m)
           FROM silver s LEFT JOIN customers c USING (meter_id)""",
    ),
    "daily_cost_local_date": with_ctes(
        [*GOLD_CHAIN[:-2],
         FACT.replace("strftime(s.reading_ts, '%Y-%m-%d')",
                      "strftime((s.reading_ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Oslo', '%Y-%m-%d')"), DAILY],
        DAILY_ROWS,
    ),
    "daily_cost_unquarantined": with_ctes(
        [RATES, READINGS, LATEST, NULLED, "good AS (SELECT * FROM nulled)", CHANGES, HIST, WEATHER, TARIFFED, SILVER, FACT, DAILY],
        DAILY_ROWS,
    ),
    "pipeline_run": with_ctes(GOLD_CHAIN, DAILY_ROWS),
})

ORACLE["readings_with_tariff_carry"] = ORACLE["readings_with_tariff"]
ORACLE["stream_latest_by_state"] = ORACLE["stream_ingest_latest"]
ORACLE["scd2_incremental"] = with_ctes([CHANGES, HIST], "SELECT * EXCLUDE (meter_tariff_sk) FROM hist")
ORACLE["top_meters"] = with_ctes(
    [READINGS],
    """SELECT meter_id, count(*) AS count FROM readings WHERE meter_id IS NOT NULL
       GROUP BY meter_id ORDER BY count DESC, meter_id LIMIT 10""",
)
ORACLE["fault_tree_meters"] = ORACLE["fault_tree"].replace(
    "count(*) AS faults,", "count(*) AS faults, count(DISTINCT meter_id) AS meters,"
).replace("SELECT coalesce(l.quality", "SELECT l.meter_id, coalesce(l.quality")
ORACLE["usage_tree"] = with_ctes(
    [*GOLD_CHAIN, CUSTOMERS, BOUNDS, CALENDAR, TARIFF_NAMES, STAR],
    """SELECT r_name, n_name, season, CAST(GROUPING(r_name, n_name, season) AS INTEGER) AS level,
              round(CAST(sum(CAST(kwh AS DECIMAL(28,8))) AS DOUBLE), 4) AS kwh,
              round(CAST(sum(CAST(cost AS DECIMAL(28,8))) AS DOUBLE), 6) AS cost,
              count(*) AS meter_days, count(DISTINCT meter_id) AS meters
       FROM star GROUP BY ROLLUP (r_name, n_name, season)""",
)
ORACLE["active_meters"] = with_ctes(
    [READINGS, LATEST],
    """SELECT month, date_key, count(DISTINCT meter_id) AS meters, count(*) AS readings,
              CAST(GROUPING(month, date_key) AS INTEGER) AS level
       FROM (SELECT meter_id, strftime(reading_ts, '%Y-%m') AS month, strftime(reading_ts, '%Y-%m-%d') AS date_key
             FROM latest WHERE reading_ts IS NOT NULL)
       GROUP BY ROLLUP (month, date_key)""",
)
ORACLE["daily_cost_bronze"] = with_ctes(
    [*GOLD_CHAIN, BOUNDS],
    f"""{DAILY_ROWS}, bounds
        WHERE CAST(date_key AS DATE) BETWEEN first_day + 1 AND last_day - 1""".replace(
        "* EXCLUDE (voltage_sum, voltage_n)", "daily.* EXCLUDE (voltage_sum, voltage_n)"
    ),
)
ORACLE["weekend_cost"] = with_ctes(GOLD_CHAIN, f"{DAILY_ROWS} WHERE isodow(CAST(date_key AS DATE)) >= 6")
ORACLE["bucketed_daily_cost"] = ORACLE["daily_cost"]
ORACLE["bucketed_rolling7"] = ORACLE["usage_rolling7"]
ORACLE["bucketed_profile"] = ORACLE["meter_profile"]
