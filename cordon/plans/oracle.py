"""DuckDB SQL oracle for the registered queries.

Written independently of the Spark code, in the shape of the audited SQL: the anomaly rule is the
unguarded CASE (IEEE division), zone membership uses ``IN`` subqueries, the day profiles are joined
as two tables, and the same-location report keeps its outer-bound subquery. Reported doubles are
rounded to cents (correlations to 6 places), as in the Spark results.
"""

from __future__ import annotations

from cordon.config import FIXTURE_CONFIG as CFG, TRIP_FILE_FORMAT, UNIFIED_COLUMNS

START = f"TIMESTAMP '{CFG.policy_start_literal}'"
OLD, NEW, TARGET = CFG.impute_older_year, CFG.impute_newer_year, CFG.impute_month
BEFORE, AFTER = CFG.compare_before_year, CFG.compare_after_year
QMONTHS = ", ".join(str(m) for m in CFG.compare_months)
KEYWORDS = "|".join(CFG.zone_keywords)
FILE_NAME = f"printf('{TRIP_FILE_FORMAT}', taxi_type, year(pickup_time), month(pickup_time))"
EPOCH = "EPOCH(dropoff_time - pickup_time)"
PAID = "CASE WHEN congestion_surcharge > 0 THEN 1 ELSE 0 END"
UNPAID = "CASE WHEN congestion_surcharge IS NULL OR congestion_surcharge = 0 THEN 1 ELSE 0 END"

BASE = f"""
trips_fx AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS taxi_type,
         pickup_time,
         pickup_time + to_seconds(CAST((l_partkey*31 + l_suppkey*17 + l_linenumber*53) % 3600 - 20 AS BIGINT)) AS dropoff_time,
         CAST(s_nationkey AS INTEGER) AS pickup_loc,
         CAST(c_nationkey AS INTEGER) AS dropoff_loc,
         (l_quantity - 1) / 4 AS trip_distance,
         fare,
         fare * (1 + l_tax) AS total_amount,
         CASE WHEN l_discount = 0 THEN NULL WHEN l_tax = 0 THEN 0.0::DOUBLE ELSE 2.5::DOUBLE END AS congestion_surcharge
  FROM (SELECT *, l_shipdate + to_seconds(CAST((l_orderkey*37 + l_linenumber*101) % 86400 AS BIGINT)) AS pickup_time,
               CASE WHEN l_orderkey % 25 = 0 THEN -l_extendedprice/1000 ELSE l_extendedprice/1000 END AS fare
        FROM lineitem) l
  JOIN orders   ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey  = c_custkey
  JOIN supplier ON l_suppkey  = s_suppkey
),
unified_fx AS (
  SELECT CAST(pickup_time AS TIMESTAMP) AS pickup_time,
         CAST(dropoff_time AS TIMESTAMP) AS dropoff_time,
         CAST(pickup_loc AS INTEGER) AS pickup_loc,
         CAST(dropoff_loc AS INTEGER) AS dropoff_loc,
         CAST(trip_distance AS DOUBLE) AS trip_distance,
         CAST(fare AS DOUBLE) AS fare,
         CAST(total_amount AS DOUBLE) AS total_amount,
         CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge,
         taxi_type,
         {FILE_NAME} AS source_file
  FROM trips_fx
  WHERE pickup_time IS NOT NULL AND dropoff_time IS NOT NULL
    AND pickup_loc IS NOT NULL AND dropoff_loc IS NOT NULL
),
flagged_fx AS (
  SELECT *,
         {EPOCH} AS duration_seconds,
         CASE WHEN {EPOCH} > 0 THEN trip_distance / ({EPOCH} / 3600.0) ELSE 0 END AS speed_mph,
         CASE
           WHEN trip_distance / ({EPOCH} / 3600.0) > {CFG.max_speed_mph} THEN 'excessive_speed'
           WHEN {EPOCH} < {CFG.short_trip_seconds} AND fare > {CFG.high_fare} THEN 'short_trip_high_fare'
           WHEN trip_distance <= {CFG.min_distance_miles} AND fare > 0 THEN 'zero_distance_positive_fare'
           WHEN {EPOCH} <= 0 THEN 'negative_duration'
           WHEN fare < 0 OR total_amount < 0 THEN 'negative_fare'
           ELSE 'clean'
         END AS ghost_flag
  FROM unified_fx
),
clean_fx AS (
  SELECT pickup_time, dropoff_time, pickup_loc, dropoff_loc, trip_distance, fare, total_amount,
         congestion_surcharge, taxi_type
  FROM flagged_fx WHERE ghost_flag = 'clean'
),
zones_fx AS (
  SELECT n_nationkey AS "LocationID", n_name AS zone, r_name AS borough
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
zone_ids_fx AS (
  SELECT "LocationID" FROM zones_fx
  WHERE borough = '{CFG.zone_borough}' AND regexp_matches(zone, '{KEYWORDS}', 'i')
),
classified_fx AS (
  SELECT *,
         CASE WHEN pickup_loc IN (SELECT "LocationID" FROM zone_ids_fx) THEN 1 ELSE 0 END AS pickup_in_zone,
         CASE WHEN dropoff_loc IN (SELECT "LocationID" FROM zone_ids_fx) THEN 1 ELSE 0 END AS dropoff_in_zone,
         CASE
           WHEN pickup_loc IN (SELECT "LocationID" FROM zone_ids_fx)
            AND dropoff_loc IN (SELECT "LocationID" FROM zone_ids_fx) THEN 'inside_zone'
           WHEN pickup_loc NOT IN (SELECT "LocationID" FROM zone_ids_fx)
            AND dropoff_loc IN (SELECT "LocationID" FROM zone_ids_fx) THEN 'entering_zone'
           WHEN pickup_loc IN (SELECT "LocationID" FROM zone_ids_fx)
            AND dropoff_loc NOT IN (SELECT "LocationID" FROM zone_ids_fx) THEN 'exiting_zone'
           ELSE 'outside_zone'
         END AS zone_category,
         CASE WHEN pickup_time >= {START} THEN 1 ELSE 0 END AS after_congestion_start
  FROM clean_fx
),
rollup_fx AS (
  SELECT DATE_TRUNC('day', pickup_time) AS trip_date,
         zone_category,
         after_congestion_start,
         COUNT(*) AS trip_count,
         AVG(fare) AS avg_fare,
         AVG(total_amount) AS avg_total,
         AVG(trip_distance) AS avg_distance,
         SUM(COALESCE(congestion_surcharge, 0)) AS total_congestion_collected,
         AVG(COALESCE(congestion_surcharge, 0)) AS avg_congestion_surcharge,
         CAST(SUM({PAID}) AS BIGINT) AS trips_with_surcharge,
         CAST(SUM({UNPAID}) AS BIGINT) AS trips_without_surcharge
  FROM classified_fx
  GROUP BY trip_date, zone_category, after_congestion_start
),
weather_fx AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CASE WHEN min(o_orderkey) % 10 = 0 THEN NULL
              ELSE 5.0::DOUBLE * count(*) FILTER (WHERE o_orderpriority LIKE '1%') / count(*) END AS prcp,
         avg(o_totalprice) / 10000 AS tavg
  FROM orders GROUP BY 1
),
counts_fx AS (
  SELECT taxi_type, {FILE_NAME} AS source_file,
         CAST(year(pickup_time) AS INTEGER) AS year, CAST(month(pickup_time) AS INTEGER) AS month,
         COUNT(*) AS row_count, COUNT(*) > 0 AS is_valid
  FROM trips_fx GROUP BY ALL
),
daily_fx AS (
  SELECT trip_date, SUM(trip_count) AS total_trips, AVG(avg_fare) AS avg_fare,
         SUM(total_congestion_collected) AS congestion_revenue
  FROM rollup_fx GROUP BY trip_date
),
wjoined_fx AS (
  SELECT CAST(d.trip_date AS DATE) AS date, d.trip_date, d.total_trips, d.avg_fare, d.congestion_revenue,
         w.prcp, w.tavg, COALESCE(w.prcp, 0) AS prcp_filled,
         CASE WHEN COALESCE(w.prcp, 0) > {CFG.rainy_threshold_mm} THEN 1 ELSE 0 END AS is_rainy_day
  FROM daily_fx d LEFT JOIN weather_fx w ON CAST(d.trip_date AS DATE) = w.date
),
quarters_fx AS (
  SELECT *, CAST(year(pickup_time) AS INTEGER) AS period_year FROM clean_fx
  WHERE year(pickup_time) IN ({BEFORE}, {AFTER}) AND month(pickup_time) IN ({QMONTHS})
)
"""


def q(body: str) -> str:
    return f"WITH {BASE}\n{body}"


def _top(where: str, key: str, source: str = "classified_fx") -> str:
    return q(f"""
SELECT {key}, COUNT(*) AS trip_count, ROUND(AVG(fare), 2) AS avg_fare,
       CAST(SUM({PAID}) AS BIGINT) AS trips_with_surcharge,
       CAST(SUM({UNPAID}) AS BIGINT) AS trips_without_surcharge,
       ROUND(100.0 * SUM({PAID}) / COUNT(*), 2) AS compliance_pct
FROM {source}
WHERE {where}
GROUP BY {key}
ORDER BY trip_count DESC, {key}
LIMIT {CFG.top_k}""")


def _pattern(bucket: str, alias: str) -> str:
    return q(f"""
SELECT CAST({bucket} AS INTEGER) AS {alias}, zone_category, after_congestion_start,
       COUNT(*) AS trip_count, ROUND(AVG(fare), 2) AS avg_fare,
       CAST(SUM({PAID}) AS BIGINT) AS trips_with_surcharge,
       CAST(SUM({UNPAID}) AS BIGINT) AS trips_without_surcharge
FROM classified_fx GROUP BY ALL""")


def _schema_check() -> str:
    parts = []
    expected = {"pickup_time": "timestamp", "dropoff_time": "timestamp", "pickup_loc": "integer", "dropoff_loc": "integer",
                "trip_distance": "double", "fare": "double", "total_amount": "double", "congestion_surcharge": "double"}
    for i, c in enumerate(UNIFIED_COLUMNS):
        parts.append(f"""
SELECT {i + 1} AS ordinal, '{c}' AS column_name, '{expected[c]}' AS expected_type,
       (SELECT lower(typeof({c})) FROM unified_fx LIMIT 1) AS actual_type,
       TRUE AS is_present,
       (SELECT lower(typeof({c})) FROM unified_fx LIMIT 1) = '{expected[c]}' AS type_ok,
       (SELECT COUNT({c}) FROM unified_fx) AS non_null_count,
       (SELECT COUNT(*) FROM unified_fx) AS row_count""")
    return q("\nUNION ALL".join(parts))


# Raw columns of each type, the unified type they should have, and the unified column they hold.
_RAW_COLUMNS = [
    ("yellow", "tpep_pickup_datetime", "timestamp", "pickup_time"), ("yellow", "tpep_dropoff_datetime", "timestamp", "dropoff_time"),
    ("green", "lpep_pickup_datetime", "timestamp", "pickup_time"), ("green", "lpep_dropoff_datetime", "timestamp", "dropoff_time"),
    *[(t, raw, kind, col) for t in ("yellow", "green") for raw, kind, col in (
        ("PULocationID", "integer", "pickup_loc"), ("DOLocationID", "integer", "dropoff_loc"),
        ("trip_distance", "double", "trip_distance"), ("fare_amount", "double", "fare"),
        ("total_amount", "double", "total_amount"), ("congestion_surcharge", "double", "congestion_surcharge"))],
]


def _raw_schema_check() -> str:
    parts = []
    for t, raw, kind, col in _RAW_COLUMNS:
        mine = f"FROM trips_fx WHERE taxi_type = '{t}'"
        parts.append(f"""
SELECT '{t}' AS taxi_type, '{raw}' AS column_name, '{kind}' AS expected_type,
       (SELECT lower(typeof({col})) {mine} LIMIT 1) AS actual_type, TRUE AS is_present,
       (SELECT lower(typeof({col})) {mine} LIMIT 1) = '{kind}' AS type_ok,
       (SELECT COUNT({col}) {mine}) AS non_null_count, (SELECT COUNT(*) {mine}) AS row_count""")
    return q("\nUNION ALL".join(parts))


ORACLE: dict[str, str] = {
    "source_row_counts": q("SELECT * FROM counts_fx"),
    "raw_schema_check": _raw_schema_check(),
    "file_inventory": q(f"""
SELECT g.taxi_type, printf('{TRIP_FILE_FORMAT}', g.taxi_type, g.year, g.month) AS source_file,
       CAST(g.year AS INTEGER) AS year, CAST(g.month AS INTEGER) AS month,
       coalesce(c.row_count, 0) AS row_count, c.row_count IS NOT NULL AS is_valid
FROM (SELECT taxi_type, year, unnest(range(1, 13)) AS month
      FROM (SELECT taxi_type, unnest([{', '.join(str(y) for y in CFG.grid_years)}]) AS year
            FROM (SELECT unnest([{', '.join(repr(t) for t in CFG.taxi_types)}]) AS taxi_type))) g
LEFT JOIN counts_fx c ON c.taxi_type = g.taxi_type AND c.year = g.year AND c.month = g.month"""),
    "missing_months": q(f"""
SELECT taxi_type, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month,
       printf('{TRIP_FILE_FORMAT}', taxi_type, year, month) AS expected_file
FROM (SELECT taxi_type, year, unnest(range(1, 13)) AS month
      FROM (SELECT taxi_type, unnest([{', '.join(str(y) for y in CFG.grid_years)}]) AS year
            FROM (SELECT unnest([{', '.join(repr(t) for t in CFG.taxi_types)}]) AS taxi_type))) g
WHERE NOT EXISTS (SELECT 1 FROM counts_fx c
                  WHERE c.is_valid AND c.taxi_type = g.taxi_type AND c.year = g.year AND c.month = g.month)"""),
    "impute_needed": q(f"""
SELECT '{CFG.impute_year:04d}-{TARGET:02d}' AS target_month, n AS types_present,
       n >= {len(CFG.taxi_types)} AS month_complete, n < {len(CFG.taxi_types)} AS needs_imputation
FROM (SELECT COUNT(DISTINCT taxi_type) AS n FROM counts_fx
      WHERE is_valid AND year = {CFG.impute_year} AND month = {TARGET})"""),
    "schema_check": _schema_check(),
    "unify_yellow": q("SELECT * FROM unified_fx WHERE taxi_type = 'yellow'"),
    "unify_green": q("SELECT * FROM unified_fx WHERE taxi_type = 'green'"),
    "unify_all": q("SELECT * FROM unified_fx"),
    "ghost_flags": q("SELECT * FROM flagged_fx"),
    "clean_trips": q("SELECT * FROM clean_fx"),
    "ghost_trips": q("SELECT * FROM flagged_fx WHERE ghost_flag != 'clean'"),
    "ghost_stats": q("""
SELECT source_file, taxi_type, ghost_flag, COUNT(*) AS trip_count,
       ROUND(AVG(speed_mph), 2) AS avg_speed_mph, ROUND(AVG(fare), 2) AS avg_fare,
       ROUND(AVG(trip_distance), 2) AS avg_distance
FROM flagged_fx GROUP BY source_file, taxi_type, ghost_flag"""),
    "ghost_totals": q("""
, per_type AS (
  SELECT taxi_type, COUNT(*) AS total_trips,
         COUNT(*) FILTER (WHERE ghost_flag = 'clean') AS clean_trips,
         COUNT(*) FILTER (WHERE ghost_flag != 'clean') AS ghost_trips,
         COUNT(*) FILTER (WHERE ghost_flag = 'excessive_speed') AS excessive_speed_trips,
         COUNT(*) FILTER (WHERE ghost_flag = 'short_trip_high_fare') AS short_trip_high_fare_trips,
         COUNT(*) FILTER (WHERE ghost_flag = 'zero_distance_positive_fare') AS zero_distance_positive_fare_trips,
         COUNT(*) FILTER (WHERE ghost_flag = 'negative_duration') AS negative_duration_trips,
         COUNT(*) FILTER (WHERE ghost_flag = 'negative_fare') AS negative_fare_trips
  FROM flagged_fx GROUP BY taxi_type
), both_types AS (
  SELECT * FROM per_type
  UNION ALL
  SELECT 'all', SUM(total_trips), SUM(clean_trips), SUM(ghost_trips), SUM(excessive_speed_trips),
         SUM(short_trip_high_fare_trips), SUM(zero_distance_positive_fare_trips),
         SUM(negative_duration_trips), SUM(negative_fare_trips)
  FROM per_type
)
SELECT taxi_type, CAST(total_trips AS BIGINT) AS total_trips, CAST(clean_trips AS BIGINT) AS clean_trips,
       CAST(ghost_trips AS BIGINT) AS ghost_trips,
       ROUND(100.0 * CAST(ghost_trips AS DOUBLE) / CAST(total_trips AS DOUBLE), 2) AS ghost_rate_pct,
       CAST(excessive_speed_trips AS BIGINT) AS excessive_speed_trips,
       CAST(short_trip_high_fare_trips AS BIGINT) AS short_trip_high_fare_trips,
       CAST(zero_distance_positive_fare_trips AS BIGINT) AS zero_distance_positive_fare_trips,
       CAST(negative_duration_trips AS BIGINT) AS negative_duration_trips,
       CAST(negative_fare_trips AS BIGINT) AS negative_fare_trips
FROM both_types"""),
    "ghost_patterns": q("""
SELECT ghost_flag, COUNT(*) AS trip_count, ROUND(AVG(speed_mph), 2) AS avg_speed,
       ROUND(AVG(fare), 2) AS avg_fare, ROUND(AVG(trip_distance), 2) AS avg_distance,
       ROUND(AVG(duration_seconds), 2) AS avg_duration_sec
FROM flagged_fx WHERE ghost_flag != 'clean' GROUP BY ghost_flag"""),
    "ghost_by_hour_dow": q("""
SELECT CAST(hour(pickup_time) AS INTEGER) AS pickup_hour, CAST(dayofweek(pickup_time) + 1 AS INTEGER) AS pickup_dow,
       ghost_flag, COUNT(*) AS trip_count, ROUND(AVG(fare), 2) AS avg_fare
FROM flagged_fx WHERE ghost_flag != 'clean' GROUP BY ALL"""),
    "ghost_by_location": q("""
SELECT 'pickup' AS location_role, pickup_loc AS location_id, ghost_flag, COUNT(*) AS trip_count
FROM flagged_fx WHERE ghost_flag != 'clean' GROUP BY ALL
UNION ALL
SELECT 'dropoff' AS location_role, dropoff_loc AS location_id, ghost_flag, COUNT(*) AS trip_count
FROM flagged_fx WHERE ghost_flag != 'clean' GROUP BY ALL"""),
    "month_profile": q(f"""
, dec AS (
  SELECT *, CAST(year(pickup_time) AS INTEGER) AS yr, CAST(day(pickup_time) AS INTEGER) AS dom
  FROM clean_fx WHERE month(pickup_time) = {TARGET} AND year(pickup_time) IN ({OLD}, {NEW})
), modes AS (
  SELECT taxi_type, yr, dom,
         (SELECT loc FROM (SELECT pickup_loc AS loc, COUNT(*) AS n FROM dec d2
                           WHERE d2.taxi_type = d.taxi_type AND d2.yr = d.yr AND d2.dom = d.dom
                           GROUP BY loc ORDER BY n DESC, loc LIMIT 1)) AS typical_pickup,
         (SELECT loc FROM (SELECT dropoff_loc AS loc, COUNT(*) AS n FROM dec d2
                           WHERE d2.taxi_type = d.taxi_type AND d2.yr = d.yr AND d2.dom = d.dom
                           GROUP BY loc ORDER BY n DESC, loc LIMIT 1)) AS typical_dropoff
  FROM (SELECT DISTINCT taxi_type, yr, dom FROM dec) d
)
SELECT p.taxi_type, p.yr AS year, p.dom AS day_of_month, p.trip_count, p.avg_fare, p.avg_total, p.avg_distance,
       p.avg_congestion, m.typical_pickup, m.typical_dropoff
FROM (SELECT taxi_type, yr, dom, COUNT(*) AS trip_count, ROUND(AVG(fare), 2) AS avg_fare,
             ROUND(AVG(total_amount), 2) AS avg_total, ROUND(AVG(trip_distance), 2) AS avg_distance,
             ROUND(AVG(COALESCE(congestion_surcharge, 0)), 2) AS avg_congestion
      FROM dec GROUP BY ALL) p
JOIN modes m USING (taxi_type, yr, dom)"""),
}

_DEC_PROFILE = f"""
, prof AS (
  SELECT taxi_type, CAST(year(pickup_time) AS INTEGER) AS yr, CAST(day(pickup_time) AS INTEGER) AS day_of_month,
         COUNT(*) AS trip_count, AVG(fare) AS avg_fare, AVG(total_amount) AS avg_total,
         AVG(trip_distance) AS avg_distance, AVG(COALESCE(congestion_surcharge, 0)) AS avg_congestion
  FROM clean_fx WHERE month(pickup_time) = {TARGET} AND year(pickup_time) IN ({OLD}, {NEW})
  GROUP BY ALL
), loc_counts AS (
  SELECT taxi_type, CAST(day(pickup_time) AS INTEGER) AS day_of_month, 'p' AS side, pickup_loc AS loc, COUNT(*) AS n
  FROM clean_fx WHERE month(pickup_time) = {TARGET} AND year(pickup_time) = {NEW} GROUP BY ALL
  UNION ALL
  SELECT taxi_type, CAST(day(pickup_time) AS INTEGER) AS day_of_month, 'd' AS side, dropoff_loc AS loc, COUNT(*) AS n
  FROM clean_fx WHERE month(pickup_time) = {TARGET} AND year(pickup_time) = {NEW} GROUP BY ALL
), ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY taxi_type, day_of_month, side ORDER BY n DESC, loc) AS rk FROM loc_counts
), imputed AS (
  SELECT d23.taxi_type, d23.day_of_month,
         CAST({CFG.weight_older} * d23.trip_count + {CFG.weight_newer} * d24.trip_count AS BIGINT) AS imputed_trip_count,
         ROUND({CFG.weight_older} * d23.avg_fare + {CFG.weight_newer} * d24.avg_fare, 2) AS imputed_avg_fare,
         ROUND({CFG.weight_older} * d23.avg_total + {CFG.weight_newer} * d24.avg_total, 2) AS imputed_avg_total,
         ROUND({CFG.weight_older} * d23.avg_distance + {CFG.weight_newer} * d24.avg_distance, 2) AS imputed_avg_distance,
         ROUND({CFG.weight_older} * d23.avg_congestion + {CFG.weight_newer} * d24.avg_congestion, 2) AS imputed_avg_congestion,
         p.loc AS typical_pickup, d.loc AS typical_dropoff,
         '{CFG.weight_older}' AS weight_older, '{CFG.weight_newer}' AS weight_newer,
         '{CFG.impute_year:04d}-{TARGET:02d}' AS target_month, 'IMPUTED' AS data_source
  FROM prof d23
  JOIN prof d24 ON d23.taxi_type = d24.taxi_type AND d23.day_of_month = d24.day_of_month
                AND d23.yr = {OLD} AND d24.yr = {NEW}
  JOIN ranked p ON p.taxi_type = d24.taxi_type AND p.day_of_month = d24.day_of_month AND p.side = 'p' AND p.rk = 1
  JOIN ranked d ON d.taxi_type = d24.taxi_type AND d.day_of_month = d24.day_of_month AND d.side = 'd' AND d.rk = 1
)"""

_QUARTER = f"""
, qs AS (
  SELECT period_year, taxi_type, COUNT(*) AS trips, AVG(fare) AS fare, SUM(total_amount) AS revenue
  FROM quarters_fx GROUP BY ALL
)"""

ORACLE.update({
    "impute_month": q(_DEC_PROFILE + "\nSELECT * FROM imputed"),
    "impute_total": q(_DEC_PROFILE + """
SELECT taxi_type, CAST(SUM(imputed_trip_count) AS BIGINT) AS total_imputed_trips FROM imputed GROUP BY taxi_type"""),
    "congestion_zones": q(f"""
SELECT "LocationID", zone, borough FROM zones_fx
WHERE borough = '{CFG.zone_borough}' AND regexp_matches(zone, '{KEYWORDS}', 'i')"""),
    "congestion_zone_sample": q(f"""
SELECT "LocationID", zone, borough FROM zones_fx
WHERE borough = '{CFG.zone_borough}' AND regexp_matches(zone, '{KEYWORDS}', 'i')
ORDER BY "LocationID", zone LIMIT 5"""),
    "classify_trips": q("SELECT * FROM classified_fx"),
    "zone_daily": q("""
SELECT trip_date, zone_category, after_congestion_start, trip_count,
       ROUND(avg_fare, 2) AS avg_fare, ROUND(avg_total, 2) AS avg_total, ROUND(avg_distance, 2) AS avg_distance,
       ROUND(total_congestion_collected, 2) AS total_congestion_collected,
       ROUND(avg_congestion_surcharge, 2) AS avg_congestion_surcharge,
       trips_with_surcharge, trips_without_surcharge
FROM rollup_fx"""),
    "zone_summary": q("""
SELECT zone_category, after_congestion_start, COUNT(*) AS trip_count,
       ROUND(AVG(COALESCE(congestion_surcharge, 0)), 2) AS avg_surcharge
FROM classified_fx GROUP BY zone_category, after_congestion_start"""),
    "top_pickups_entering": _top("after_congestion_start = 1 AND pickup_in_zone = 0 AND dropoff_in_zone = 1", "pickup_loc"),
    # The audited form: the subquery's pickup_loc binds to the outer row.
    "top_pickups_same_loc": _top(
        f"pickup_time >= {START} AND dropoff_loc IN (SELECT DISTINCT pickup_loc FROM rollup_fx)",
        "pickup_loc", source="clean_fx"),
    "top_dropoffs_exiting": _top("after_congestion_start = 1 AND pickup_in_zone = 1 AND dropoff_in_zone = 0", "dropoff_loc"),
    "zone_hourly": _pattern("hour(pickup_time)", "pickup_hour"),
    "zone_dow": _pattern("dayofweek(pickup_time) + 1", "pickup_dow"),
    "leakage_summary": q(f"""
SELECT CAST(SUM(trip_count) AS BIGINT) AS total_trips,
       CAST(SUM(trips_with_surcharge) AS BIGINT) AS trips_with_surcharge,
       CAST(SUM(trips_without_surcharge) AS BIGINT) AS trips_without_surcharge,
       ROUND(100.0 * SUM(trips_without_surcharge) / SUM(trip_count), 2) AS leakage_pct,
       ROUND(SUM(total_congestion_collected), 2) AS total_revenue_collected,
       ROUND(CAST(SUM(trips_without_surcharge) * {CFG.leakage_loss_per_trip} AS DOUBLE), 2) AS estimated_revenue_lost
FROM rollup_fx
WHERE after_congestion_start = 1 AND zone_category IN ('entering_zone', 'exiting_zone')"""),
    "top_leakage_pickups": q(f"""
SELECT * FROM (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY trips_without_surcharge DESC, pickup_loc) AS INTEGER) AS leakage_rank,
         pickup_loc, trip_count, trips_without_surcharge,
         ROUND(100.0 * trips_without_surcharge / trip_count, 2) AS leakage_pct
  FROM (SELECT pickup_loc, COUNT(*) AS trip_count, CAST(SUM({UNPAID}) AS BIGINT) AS trips_without_surcharge
        FROM classified_fx
        WHERE after_congestion_start = 1 AND zone_category IN ('entering_zone', 'exiting_zone')
        GROUP BY pickup_loc)
) WHERE leakage_rank <= {CFG.top_leakage_k}"""),
    "kpi_overview": q(f"""
, s AS (
  SELECT SUM(trip_count) AS total_trips, SUM(total_congestion_collected) AS total_revenue,
         SUM(trips_with_surcharge) AS w, SUM(trips_without_surcharge) AS wo,
         AVG(avg_fare) AS avg_fare, AVG(avg_distance) AS avg_distance,
         SUM(avg_fare * trip_count) / SUM(CASE WHEN avg_fare IS NOT NULL THEN trip_count END) AS avg_fare_weighted
  FROM rollup_fx WHERE after_congestion_start = 1
), c AS (
  SELECT *, CASE WHEN COALESCE(w, 0) + COALESCE(wo, 0) > 0
                 THEN CAST(w AS DOUBLE) / CAST(w + wo AS DOUBLE) * 100 ELSE 0.0 END AS compliance
  FROM s
)
SELECT CAST(COALESCE(total_trips, 0) AS BIGINT) AS total_trips,
       ROUND(COALESCE(total_revenue, 0), 2) AS total_revenue,
       CAST(COALESCE(w, 0) AS BIGINT) AS trips_with_surcharge,
       CAST(COALESCE(wo, 0) AS BIGINT) AS trips_without_surcharge,
       ROUND(compliance, 2) AS compliance_pct,
       ROUND(100 - compliance, 2) AS leakage_pct,
       ROUND(CAST(COALESCE(wo, 0) * {CFG.kpi_loss_per_trip} AS DOUBLE), 2) AS estimated_lost_revenue,
       ROUND(COALESCE(avg_fare, 0), 2) AS avg_fare,
       ROUND(COALESCE(avg_distance, 0), 2) AS avg_distance,
       ROUND(avg_fare_weighted, 2) AS avg_fare_weighted
FROM c"""),
    "quarter_stats": q("""
SELECT period_year, taxi_type, COUNT(*) AS trip_count, ROUND(AVG(fare), 2) AS avg_fare,
       ROUND(AVG(total_amount), 2) AS avg_total, ROUND(SUM(total_amount), 2) AS total_revenue
FROM quarters_fx GROUP BY ALL"""),
    "quarter_comparison": q(_QUARTER + f"""
SELECT b.taxi_type, b.trips AS trips_before, a.trips AS trips_after,
       ROUND(CASE WHEN b.trips > 0 THEN (a.trips - b.trips) / b.trips * 100 ELSE 0 END, 2) AS trip_change_pct,
       ROUND(b.fare, 2) AS fare_before, ROUND(a.fare, 2) AS fare_after,
       ROUND(CASE WHEN b.fare > 0 THEN (a.fare - b.fare) / b.fare * 100 ELSE 0 END, 2) AS fare_change_pct,
       ROUND(b.revenue, 2) AS revenue_before, ROUND(a.revenue, 2) AS revenue_after,
       ROUND(CASE WHEN b.revenue > 0 THEN (a.revenue - b.revenue) / b.revenue * 100 ELSE 0 END, 2) AS revenue_change_pct
FROM qs b JOIN qs a ON a.taxi_type = b.taxi_type AND b.period_year = {BEFORE} AND a.period_year = {AFTER}"""),
    "market_share_shift": q(f"""
, t AS (
  SELECT taxi_type, COUNT(*) FILTER (WHERE period_year = {BEFORE}) AS trips_before,
         COUNT(*) FILTER (WHERE period_year = {AFTER}) AS trips_after
  FROM quarters_fx GROUP BY taxi_type
), s AS (
  SELECT *, 100.0 * CAST(trips_before AS DOUBLE) / CAST(SUM(trips_before) OVER () AS DOUBLE) AS sb,
            100.0 * CAST(trips_after AS DOUBLE) / CAST(SUM(trips_after) OVER () AS DOUBLE) AS sa
  FROM t
)
SELECT taxi_type, trips_before, trips_after, ROUND(sb, 2) AS share_before_pct, ROUND(sa, 2) AS share_after_pct,
       ROUND(sa - sb, 2) AS share_shift_pts
FROM s"""),
    "daily_trips": q("SELECT trip_date, CAST(SUM(trip_count) AS BIGINT) AS total_trips FROM rollup_fx GROUP BY trip_date"),
    "revenue_daily_cumulative": q("""
, d AS (
  SELECT trip_date, SUM(total_congestion_collected) AS daily_revenue
  FROM rollup_fx WHERE after_congestion_start = 1 GROUP BY trip_date
)
SELECT trip_date, ROUND(daily_revenue, 2) AS daily_revenue,
       ROUND(SUM(daily_revenue) OVER (ORDER BY trip_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2)
         AS cumulative_revenue
FROM d"""),
    "zone_period": q(f"""
SELECT zone_category,
       CASE WHEN after_congestion_start = 1 THEN '{CFG.period_after_label}' ELSE '{CFG.period_before_label}' END AS period,
       CAST(SUM(trip_count) AS BIGINT) AS total_trips
FROM rollup_fx GROUP BY zone_category, period"""),
    "daily_leakage": q("""
SELECT trip_date, CAST(SUM(trips_with_surcharge) AS BIGINT) AS with_surcharge,
       CAST(SUM(trips_without_surcharge) AS BIGINT) AS without_surcharge,
       CAST(SUM(trips_with_surcharge) + SUM(trips_without_surcharge) AS BIGINT) AS stacked_total
FROM rollup_fx WHERE after_congestion_start = 1 GROUP BY trip_date"""),
    "zone_revenue": q("""
SELECT zone_category, after_congestion_start, CAST(SUM(trip_count) AS BIGINT) AS trips,
       ROUND(SUM(total_congestion_collected), 2) AS revenue
FROM rollup_fx GROUP BY zone_category, after_congestion_start"""),
    "zone_period_pivot": q("""
SELECT zone_category,
       CAST(COALESCE(SUM(trip_count) FILTER (WHERE after_congestion_start = 0), 0) AS BIGINT) AS trips_before_start,
       CAST(COALESCE(SUM(trip_count) FILTER (WHERE after_congestion_start = 1), 0) AS BIGINT) AS trips_after_start
FROM rollup_fx GROUP BY zone_category"""),
    "weather_joined": q("""
SELECT date, trip_date, CAST(total_trips AS BIGINT) AS total_trips, ROUND(avg_fare, 2) AS avg_fare,
       ROUND(congestion_revenue, 2) AS congestion_revenue, ROUND(prcp, 2) AS prcp, ROUND(tavg, 2) AS tavg,
       ROUND(prcp_filled, 2) AS prcp_filled, is_rainy_day
FROM wjoined_fx"""),
    "weather_correlation": q("""
SELECT COUNT(*) AS days, ROUND(corr(total_trips, prcp_filled), 6) AS corr_trips_prcp,
       ROUND(corr(total_trips, tavg), 6) AS corr_trips_tavg
FROM wjoined_fx"""),
    "rain_effect": q("""
, r AS (
  SELECT COUNT(*) FILTER (WHERE is_rainy_day = 1) AS rainy_days, COUNT(*) FILTER (WHERE is_rainy_day = 0) AS dry_days,
         AVG(total_trips) FILTER (WHERE is_rainy_day = 1) AS ra, AVG(total_trips) FILTER (WHERE is_rainy_day = 0) AS da
  FROM wjoined_fx
)
SELECT rainy_days, dry_days, ROUND(ra, 2) AS rainy_avg_trips, ROUND(da, 2) AS dry_avg_trips,
       ROUND(CASE WHEN da > 0 THEN (ra - da) / da * 100 ELSE 0 END, 2) AS rain_effect_pct
FROM r"""),
    "precip_elasticity": q("""
SELECT COUNT(*) AS wet_days, ROUND(regr_slope(ln(total_trips), ln(prcp)), 6) AS elasticity
FROM wjoined_fx WHERE prcp > 0 AND total_trips > 0"""),
    "rain_compliance": q(f"""
, d AS (
  SELECT CAST(trip_date AS DATE) AS date, SUM(trips_with_surcharge) AS w, SUM(trips_without_surcharge) AS wo
  FROM rollup_fx WHERE after_congestion_start = 1 GROUP BY 1
), j AS (
  SELECT d.*, CASE WHEN COALESCE(wf.prcp, 0) > {CFG.rainy_threshold_mm} THEN 1 ELSE 0 END AS is_rainy_day
  FROM d LEFT JOIN weather_fx wf ON d.date = wf.date
)
SELECT is_rainy_day, COUNT(*) AS days, CAST(SUM(w) AS BIGINT) AS trips_with_surcharge,
       CAST(SUM(wo) AS BIGINT) AS trips_without_surcharge,
       ROUND(100.0 * CAST(SUM(w) AS DOUBLE) / CAST(SUM(w) + SUM(wo) AS DOUBLE), 2) AS compliance_pct
FROM j GROUP BY is_rainy_day"""),
})
ORACLE["unify_tagged"] = ORACLE["unify_all"]
ORACLE["zone_daily_merged"] = ORACLE["zone_daily"]
for _name, _same in (("zone_daily_from_days", "zone_daily"), ("ghost_stats_merged", "ghost_stats"), ("month_profile_merged", "month_profile"),
                     ("impute_month_merged", "impute_month"), ("quarter_stats_merged", "quarter_stats"),
                     ("quarter_comparison_merged", "quarter_comparison"), ("market_share_shift_merged", "market_share_shift")):
    ORACLE[_name] = ORACLE[_same]
ORACLE["unprocessed_months"] = q(f"""
SELECT taxi_type, year, month, COUNT(*) AS n_files, CAST(SUM(row_count) AS BIGINT) AS row_count
FROM counts_fx c
WHERE is_valid AND NOT EXISTS (SELECT 1 FROM clean_fx t WHERE t.pickup_time < {START} AND t.taxi_type = c.taxi_type
                               AND year(t.pickup_time) = c.year AND month(t.pickup_time) = c.month)
GROUP BY taxi_type, year, month""")
ORACLE["value_drift"] = q("""
, per_file AS (
  SELECT taxi_type, source_file, unnest(['fare', 'total_amount', 'trip_distance', 'congestion_surcharge']) AS column_name,
         COUNT(*) AS row_count,
         unnest([COUNT(fare), COUNT(total_amount), COUNT(trip_distance), COUNT(congestion_surcharge)]) AS n_values
  FROM flagged_fx GROUP BY taxi_type, source_file
)
SELECT *, n_values = 0 AND MAX(n_values) OVER (PARTITION BY taxi_type, column_name) > 0 AS dropped FROM per_file""")
