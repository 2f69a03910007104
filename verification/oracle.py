"""SQL counterparts of the checked queries, for DuckDB on the same tables."""

from __future__ import annotations

import re

from citytrace.operators.anomaly import FARE_FEATURES, SPEED_FEATURES
from verification.tables import FIXED_ROWS, FIXED_TREES, KEY_SPACE, fixed_tree


def r6(expr: str, name: str | None = None) -> str:
    """Six digits, off the rounding tie; see ``tables.checked``."""
    return f"round(({expr}) + 1e-9, 6) AS {name or expr}"


def r6s(*names: str) -> str:
    return ", ".join(r6(n) for n in names)


def _bucket(hour: str) -> str:
    return (
        f"CASE WHEN {hour} BETWEEN 8 AND 11 THEN 'morning' WHEN {hour} BETWEEN 12 AND 15 THEN 'afternoon' "
        f"WHEN {hour} BETWEEN 16 AND 19 THEN 'evening' WHEN {hour} BETWEEN 20 AND 23 THEN 'night' END"
    )


def _haversine(a: str, b: str) -> str:
    h = (
        f"pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) "
        f"* pow(sin(radians({b}.long - {a}.long) / 2), 2)"
    )
    return f"6371.0 * 2 * atan2(sqrt({h}), sqrt(1 - ({h})))"


def _quantile(q: float, expr: str) -> str:
    return f"quantile_cont({expr}, {q})"


HOUR = "TRY_CAST(substr(pickup_time, 1, 2) AS INTEGER)"
TRIP_COLUMNS = (
    "pickup_location_id, dropff_location_id, trip_distance, fare_amount, tip_amount, payment_type, "
    "pickup_date, pickup_time, dropff_date, dropff_time, extra_amount, total_trip_amount"
)
TRIP_OUT = (
    "pickup_location_id, dropff_location_id, pickup_date, pickup_time, dropff_date, dropff_time, payment_type, "
    + r6s("trip_distance", "fare_amount", "tip_amount", "extra_amount", "total_trip_amount")
)
ROW_KEY = f"""((CAST(pickup_location_id AS BIGINT) * 7919 + CAST(dropff_location_id AS BIGINT) * 104729
    + date_diff('day', DATE '1970-01-01', pickup_date) * 613
    + (CAST(substr(pickup_time, 1, 2) AS BIGINT) * 3600 + CAST(substr(pickup_time, 4, 2) AS BIGINT) * 60
       + CAST(substr(pickup_time, 7, 2) AS BIGINT)) * 31
    + CAST(round(fare_amount * 100) AS BIGINT) * 17) % {KEY_SPACE})"""
WINDOW = (
    "pickup_date BETWEEN DATE '1996-03-01' AND DATE '1999-08-31' AND "
    f"{HOUR} >= 7 AND {HOUR} < 21"
)
SEGMENT_JOIN = f"(s.segment = 'all' OR s.segment = {_bucket('hour')})"
EVERY_SEGMENT = "(VALUES ('morning'), ('afternoon'), ('evening'), ('night'), ('all')) AS s(segment)"

SCORE_Q = {"s0": 0.98, "s1": 0.985, "s2": 0.99}
MPH_Q = {"m0": 0.99, "m1": 0.995, "m2": 0.997}
RATIO_Q = {"r0": 0.97, "r1": 0.98, "r2": 0.99}
MULTIPLIERS = (1.5, 2.0, 2.5, 3.0)

_speed_grid = [(s, m) for s in SCORE_Q for m in MPH_Q]
_fare_grid = [(s, k, r) for s in SCORE_Q for k in MULTIPLIERS for r in RATIO_Q]


def _token_flag(key: str) -> str:
    return f"len([t FOR t IN items IF starts_with(t, '{key}=')]) > 0"


def _token_value(key: str) -> str:
    """Value of the only token of a key; a basket has each key at most once."""
    return f"substr([t FOR t IN items IF starts_with(t, '{key}=')][1], {len(key) + 2})"


def _has(*toks: str) -> str:
    return " AND ".join(f"list_contains(items, '{t}')" for t in toks)


_AIRPORT = f"({_token_flag('source_airport')} OR {_token_flag('destination_airport')})"
_PRICED = f"({_token_flag('distance_bin')} AND {_token_flag('fare_bin')})"
_CITY = (
    f"{_token_flag('day_type')} AND {_PRICED} AND NOT {_token_flag('source_airport')} "
    f"AND NOT {_token_flag('destination_airport')}"
)
_TO_AIRPORT = f"{_token_flag('time_bin')} AND {_token_flag('source_borough')} AND {_token_flag('fare_bin')}"
_ROUTINE = f"{_token_flag('time_bin')} AND {_token_flag('day_type')} AND {_token_flag('distance_bin')}"
FORMS = [
    (0, "ewr_weekday", "strict", f"{_has('destination_airport=EWR', 'day_type=Weekday')} AND {_TO_AIRPORT}"),
    (1, "ewr_weekend", "strict", f"{_has('destination_airport=EWR', 'day_type=Weekend')} AND {_TO_AIRPORT}"),
    (2, "lga_weekday", "strict", f"{_has('destination_airport=LGA', 'day_type=Weekday')} AND {_TO_AIRPORT}"),
    (3, "lga_weekend", "strict", f"{_has('destination_airport=LGA', 'day_type=Weekend')} AND {_TO_AIRPORT}"),
    (4, "morning_pattern", "strict", f"{_has('time_bin=Morning', 'route_type=city_to_city')} AND {_CITY}"),
    (4, "morning_pattern", "relaxed", f"{_has('time_bin=Morning', 'route_type=city_to_city')} AND {_PRICED}"),
    (5, "night_pattern", "strict", f"{_has('time_bin=Night', 'route_type=city_to_city')} AND {_CITY}"),
    (5, "night_pattern", "relaxed", f"{_has('time_bin=Night', 'route_type=city_to_city')} AND {_PRICED}"),
    (
        6,
        "tipping_pattern",
        "strict",
        f"{_has('tip_bin=HighTip')} AND {_token_flag('payment_type')} AND {_token_flag('time_bin')} AND {_PRICED}",
    ),
    (6, "tipping_pattern", "relaxed", f"{_token_flag('tip_bin')} AND {_token_flag('payment_type')}"),
    (
        7,
        "short_high_fare",
        "strict",
        "list_has_any(items, ['distance_bin=0-2mi', 'distance_bin=2-5mi']) AND list_has_any(items, "
        "['fare_bin=$80-$100', 'fare_bin=$100-$140', 'fare_bin=$140-$180']) AND " + _token_flag("time_bin"),
    ),
    (8, "cash_pattern", "strict", f"{_has('payment_type=Cash')} AND {_ROUTINE}"),
    (8, "cash_pattern", "relaxed", f"{_has('payment_type=Cash')} AND {_token_flag('time_bin')}"),
    (9, "credit_pattern", "strict", f"{_has('payment_type=CreditCard')} AND {_ROUTINE}"),
    (9, "credit_pattern", "relaxed", f"{_has('payment_type=CreditCard')} AND {_token_flag('time_bin')}"),
]

CTES: dict[str, str] = {
    "mapped": """
        SELECT o_orderdate + to_seconds((l_orderkey * 7919 + l_linenumber * 6007) % 86400) AS p_ts,
               o_orderdate + to_seconds((l_orderkey * 7919 + l_linenumber * 6007) % 86400
                 + (l_partkey * 31 + l_suppkey * 17 + l_linenumber * 13) % 7200 - 60) AS d_ts,
               s_nationkey AS pickup_location_id, c_nationkey AS dropff_location_id,
               l_quantity * 6e-1 AS trip_distance,
               CAST((CAST(round(l_extendedprice * 100) AS BIGINT) + 500) // 1000 AS DOUBLE) / 1e2 AS fare_amount,
               CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) + 20000)
                 // 40000 AS DOUBLE) / 1e2 AS tip_amount,
               CAST(1 + (l_orderkey + l_linenumber) % 4 AS INTEGER) AS payment_type,
               l_tax * 1e1 + 0e0 + 25e-1 + 0e0 AS extra_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    "trips": """
        SELECT DISTINCT pickup_location_id, dropff_location_id, CAST(p_ts AS DATE) AS pickup_date,
               strftime(p_ts, '%H:%M:%S') AS pickup_time, CAST(d_ts AS DATE) AS dropff_date,
               strftime(d_ts, '%H:%M:%S') AS dropff_time, trip_distance, fare_amount, tip_amount, payment_type,
               extra_amount, fare_amount + tip_amount + extra_amount AS total_trip_amount, p_ts, d_ts
        FROM mapped
        WHERE trip_distance > 0 AND pickup_location_id <> dropff_location_id AND fare_amount >= 0
          AND epoch(d_ts) - epoch(p_ts) BETWEEN 0 AND 86400
          AND tip_amount IS NOT NULL AND extra_amount IS NOT NULL AND payment_type IS NOT NULL""",
    "zones": """
        SELECT n_nationkey AS location_id,
               CASE WHEN n_nationkey <= 2 THEN 'EWR' WHEN n_nationkey = 24 THEN 'Unknown' ELSE r_name END AS borough,
               CASE n_nationkey WHEN 0 THEN 'JFK Airport' WHEN 1 THEN 'LaGuardia Airport' WHEN 2 THEN 'Newark Airport'
                 WHEN 24 THEN 'Unknown' ELSE n_name END AS zone
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "coords": """
        SELECT CAST(n_nationkey AS BIGINT) AS location_id,
               CASE WHEN n_nationkey <> 24 THEN ((n_nationkey * 37) % 25) * 15e-3 + 4055e-2 END AS lat,
               CASE WHEN n_nationkey <> 24 THEN ((n_nationkey * 11) % 25) * 2e-2 + -742e-1 END AS long
        FROM nation""",
    "known": "SELECT * FROM zones WHERE lower(trim(borough)) NOT IN ('unknown', 'nan', '')",
    "days": "SELECT DISTINCT pickup_date AS date, CASE WHEN dayofweek(pickup_date) IN (0, 6) THEN 1 ELSE 0 END "
    "AS is_weekend FROM trips",
    "prep": f"""
        SELECT pickup_location_id AS source_id, dropff_location_id AS destination_id, pickup_date, pickup_time,
               p_ts AS pickup_timestamp, {HOUR} AS pickup_hour, CAST(dayofweek(pickup_date) AS INTEGER) AS day_of_week,
               CASE WHEN dayofweek(pickup_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
               trip_distance AS trip_distance_miles, fare_amount,
               (date_diff('second', p_ts, d_ts)) / 6e1 AS eta_minutes
        FROM trips WHERE date_diff('second', p_ts, d_ts) > 0 AND date_diff('second', p_ts, d_ts) <= 14400""",
    "rated": """
        SELECT *, trip_distance_miles / (eta_minutes / 6e1) AS speed_mph,
               fare_amount / greatest(trip_distance_miles, 1e-3) AS fare_per_mile,
               fare_amount / greatest(eta_minutes, 1e-3) AS fare_per_minute
        FROM prep""",
    "part": "SELECT * FROM prep",
    "ctx": "SELECT source_id, destination_id, pickup_hour, is_weekend, count(*) AS context_trip_count, "
    + ", ".join(
        r6(_quantile(q, "fare_amount"), f"context_fare_{n}") for n, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    )
    + " FROM part GROUP BY ALL",
    "route": "SELECT source_id, destination_id, count(*) AS route_trip_count, "
    + ", ".join(
        r6(_quantile(q, "fare_amount"), f"route_fare_{n}") for n, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    )
    + " FROM part GROUP BY ALL",
    "overall": "SELECT count(*) AS global_context_count, "
    + ", ".join(
        r6(_quantile(q, "fare_amount"), f"global_fare_{n}") for n, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    )
    + " FROM part",
    "filled": """
        SELECT rated.*, coalesce(context_fare_q1, route_fare_q1, global_fare_q1) AS context_fare_q1,
               coalesce(context_fare_median, route_fare_median, global_fare_median) AS context_fare_median,
               coalesce(context_fare_q3, route_fare_q3, global_fare_q3) AS context_fare_q3,
               coalesce(context_trip_count, route_trip_count, global_context_count) AS context_trip_count
        FROM rated LEFT JOIN ctx USING (source_id, destination_id, pickup_hour, is_weekend)
        LEFT JOIN route USING (source_id, destination_id) CROSS JOIN overall""",
    "feat": """
        SELECT *, greatest(context_fare_q3 - context_fare_q1, 0e0) AS context_iqr_fare,
               context_fare_median AS context_median_fare,
               ln(1 + CAST(context_trip_count AS DOUBLE)) AS context_count_log1p,
               fare_amount / greatest(context_fare_median, 1e-1) AS fare_to_context_median_ratio,
               sin(2 * pi() * pickup_hour / 24) AS pickup_hour_sin, cos(2 * pi() * pickup_hour / 24) AS pickup_hour_cos
        FROM filled""",
    "scored": """
        SELECT *, (speed_mph + eta_minutes) / (speed_mph + eta_minutes + 6e1) - 5e-1 AS speed_anomaly_score,
               (fare_to_context_median_ratio + fare_per_minute)
                 / (fare_to_context_median_ratio + fare_per_minute + 1e0) - 5e-1 AS fare_anomaly_score
        FROM feat""",
    "hourly_q": "SELECT pickup_hour, "
    + ", ".join(f"{_quantile(q, 'speed_anomaly_score')} AS {n}" for n, q in SCORE_Q.items())
    + ", "
    + ", ".join(f"{_quantile(q, 'speed_mph')} AS {n}" for n, q in MPH_Q.items())
    + " FROM scored GROUP BY pickup_hour",
    "all_q": "SELECT "
    + ", ".join(f"{_quantile(q, 'speed_anomaly_score')} AS g{n}" for n, q in SCORE_Q.items())
    + ", "
    + ", ".join(f"{_quantile(q, 'speed_mph')} AS g{n}" for n, q in MPH_Q.items())
    + " FROM scored",
    "speed_rates": " UNION ALL ".join(
        f"SELECT {i} AS place, {SCORE_Q[s]}::DOUBLE AS score_quantile, {MPH_Q[m]}::DOUBLE AS speed_quantile, "
        f"CAST(count(*) FILTER (speed_anomaly_score >= {s} AND speed_mph >= {m}) AS DOUBLE) / count(*) AS rate "
        "FROM scored JOIN hourly_q USING (pickup_hour)"
        for i, (s, m) in enumerate(_speed_grid)
    ),
    "speed_best": "SELECT * FROM speed_rates ORDER BY abs(rate - 1e-2), place LIMIT 1",
    "speed_thr": """
        SELECT CAST(h AS INTEGER) AS pickup_hour, printf('%02d:00', h) AS hour_label,
               coalesce({s}, {gs}) AS speed_score_threshold, coalesce({m}, {gm}) AS speed_mph_threshold,
               score_quantile, speed_quantile, rate AS estimated_anomaly_rate,
               {gs} AS global_speed_score_threshold, {gm} AS global_speed_mph_threshold
        FROM range(24) AS hours(h) LEFT JOIN hourly_q ON pickup_hour = h CROSS JOIN speed_best CROSS JOIN all_q""".format(
        s="CASE score_quantile " + " ".join(f"WHEN {q}::DOUBLE THEN {n}" for n, q in SCORE_Q.items()) + " END",
        m="CASE speed_quantile " + " ".join(f"WHEN {q}::DOUBLE THEN {n}" for n, q in MPH_Q.items()) + " END",
        gs="CASE score_quantile " + " ".join(f"WHEN {q}::DOUBLE THEN g{n}" for n, q in SCORE_Q.items()) + " END",
        gm="CASE speed_quantile " + " ".join(f"WHEN {q}::DOUBLE THEN g{n}" for n, q in MPH_Q.items()) + " END",
    ),
    "fare_q": "SELECT "
    + ", ".join(f"{_quantile(q, 'fare_anomaly_score')} AS {n}" for n, q in SCORE_Q.items())
    + ", "
    + ", ".join(f"{_quantile(q, 'fare_to_context_median_ratio')} AS {n}" for n, q in RATIO_Q.items())
    + " FROM scored",
    "fare_rates": " UNION ALL ".join(
        f"SELECT {i} AS place, {SCORE_Q[s]}::DOUBLE AS score_quantile, any_value({s}) AS score_threshold, "
        f"{k}::DOUBLE AS iqr_multiplier, {RATIO_Q[r]}::DOUBLE AS ratio_quantile, any_value({r}) AS ratio_threshold, "
        f"CAST(count(*) FILTER (fare_anomaly_score >= {s} AND fare_amount >= context_fare_median + {k}::DOUBLE "
        f"* context_iqr_fare AND fare_to_context_median_ratio >= {r}) AS DOUBLE) / count(*) AS rate "
        "FROM scored CROSS JOIN fare_q"
        for i, (s, k, r) in enumerate(_fare_grid)
    ),
    "fare_thr": "SELECT * FROM fare_rates ORDER BY abs(rate - 1e-2), place LIMIT 1",
    "flagged": """
        SELECT scored.*, speed_score_threshold, speed_mph_threshold,
               speed_anomaly_score >= speed_score_threshold AND speed_mph >= speed_mph_threshold
                 AS is_extreme_speed_anomaly,
               context_median_fare + iqr_multiplier * context_iqr_fare AS context_upper_fare_threshold,
               fare_anomaly_score >= score_threshold
                 AND fare_amount >= context_median_fare + iqr_multiplier * context_iqr_fare
                 AND fare_to_context_median_ratio >= ratio_threshold AS is_fare_outlier_anomaly
        FROM scored JOIN speed_thr USING (pickup_hour) CROSS JOIN fare_thr""",
    "labelled": """
        SELECT flagged.*, coalesce(o.zone, 'Unknown') || ' (' || coalesce(o.borough, 'Unknown') || ')' AS origin_label,
               coalesce(d.zone, 'Unknown') || ' (' || coalesce(d.borough, 'Unknown') || ')' AS destination_label
        FROM flagged LEFT JOIN zones o ON o.location_id = source_id
        LEFT JOIN zones d ON d.location_id = destination_id""",
    "rows_out": """
        SELECT strftime(pickup_timestamp, '%Y-%m-%d %H:%M:%S') AS pickup_timestamp, pickup_hour, source_id,
               destination_id, origin_label, destination_label, fare_amount, trip_distance_miles, eta_minutes,
               speed_mph, fare_to_context_median_ratio, context_median_fare, context_iqr_fare,
               speed_anomaly_score AS anomaly_score, 'extreme_speed' AS anomaly_type
        FROM labelled WHERE is_extreme_speed_anomaly
        UNION ALL
        SELECT strftime(pickup_timestamp, '%Y-%m-%d %H:%M:%S'), pickup_hour, source_id, destination_id, origin_label,
               destination_label, fare_amount, trip_distance_miles, eta_minutes, speed_mph,
               fare_to_context_median_ratio, context_median_fare, context_iqr_fare, fare_anomaly_score, 'fare_outlier'
        FROM labelled WHERE is_fare_outlier_anomaly""",
    "fprep": f"""
        SELECT pickup_location_id AS source_id, dropff_location_id AS destination_id, {HOUR} AS pickup_hour,
               CAST(dayofweek(pickup_date) AS INTEGER) AS day_of_week,
               CASE WHEN dayofweek(pickup_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
               CAST(month(pickup_date) AS INTEGER) AS month, fare_amount, date_diff('minute', p_ts, d_ts) AS eta_minutes
        FROM trips
        WHERE date_diff('minute', p_ts, d_ts) > 0 AND date_diff('minute', p_ts, d_ts) <= 1440
          AND month(pickup_date) BETWEEN 1 AND 11""",
    "agg": """
        SELECT source_id, destination_id, pickup_hour, day_of_week, is_weekend, month,
               avg(fare_amount) AS avg_fare_amount, avg(eta_minutes) AS avg_eta_minutes, count(*) AS trip_count
        FROM fprep GROUP BY ALL""",
    "train": "SELECT * FROM agg WHERE month BETWEEN 1 AND 9",
    "test": "SELECT * FROM agg WHERE month BETWEEN 10 AND 11",
    "prior": """
        SELECT source_id, destination_id,
               sum(avg_fare_amount * trip_count) / sum(trip_count) AS route_hist_avg_fare,
               sum(avg_eta_minutes * trip_count) / sum(trip_count) AS route_hist_avg_eta,
               ln(1 + CAST(sum(trip_count) AS DOUBLE)) AS route_hist_trip_count_log1p
        FROM train GROUP BY ALL""",
    "gprior": """
        SELECT sum(avg_fare_amount * trip_count) / sum(trip_count) AS g_fare,
               sum(avg_eta_minutes * trip_count) / sum(trip_count) AS g_eta, 0e0 AS g_count
        FROM train""",
    "tfeat": f"""
        SELECT t.*, coalesce(route_hist_avg_fare, g_fare) AS route_hist_avg_fare,
               coalesce(route_hist_avg_eta, g_eta) AS route_hist_avg_eta,
               coalesce(route_hist_trip_count_log1p, g_count) AS route_hist_trip_count_log1p,
               {_haversine("a", "b")} AS km
        FROM test t LEFT JOIN prior USING (source_id, destination_id) CROSS JOIN gprior
        LEFT JOIN coords a ON a.location_id = source_id LEFT JOIN coords b ON b.location_id = destination_id""",
    "ends": f"""
        SELECT e.location_id, {HOUR} AS hour, trips.*, long, lat
        FROM trips, LATERAL (SELECT unnest([pickup_location_id, dropff_location_id]) AS location_id) e
        JOIN coords USING (location_id) WHERE lat IS NOT NULL""",
    "points": f"""
        SELECT s.segment, location_id, long, lat, count(*) AS weight
        FROM ends JOIN {EVERY_SEGMENT} ON {SEGMENT_JOIN} GROUP BY ALL""",
    "starts": f"""
        SELECT s.segment, CAST((location_id - 2) // 5 AS INTEGER) AS cluster_id, long AS center_long, lat AS center_lat
        FROM coords CROSS JOIN {EVERY_SEGMENT} WHERE location_id % 5 = 2""",
    "marked": """
        SELECT p.segment, p.location_id, p.long, p.lat, p.weight,
               arg_min(cluster_id, ((center_long - p.long) * (center_long - p.long) + (center_lat - p.lat) * (center_lat - p.lat), cluster_id)) AS cluster_id,
               min((center_long - p.long) * (center_long - p.long) + (center_lat - p.lat) * (center_lat - p.lat)) AS d2
        FROM points p JOIN starts USING (segment) GROUP BY ALL""",
    "means": """
        SELECT segment, cluster_id, sum(long * weight) / sum(weight) AS m_long, sum(lat * weight) / sum(weight) AS m_lat,
               CAST(sum(weight) AS BIGINT) AS n
        FROM marked GROUP BY ALL""",
    "refined": """
        SELECT segment, cluster_id, coalesce(m_long, center_long) AS center_long,
               coalesce(m_lat, center_lat) AS center_lat, coalesce(n, 0) AS cluster_count
        FROM starts LEFT JOIN means USING (segment, cluster_id)""",
    "centroids": """
        SELECT trim(borough) AS borough, round(avg(long) + 1e-9, 6) AS long, round(avg(lat) + 1e-9, 6) AS lat,
               count(DISTINCT location_id) AS location_count
        FROM known JOIN coords USING (location_id) GROUP BY 1""",
    "near": """
        SELECT p.segment, p.location_id, p.long, p.lat, p.weight,
               arg_min(borough, ((c.long - p.long) * (c.long - p.long) + (c.lat - p.lat) * (c.lat - p.lat), borough)) AS nearest_borough
        FROM points p CROSS JOIN centroids c GROUP BY ALL""",
    "shares": """
        SELECT segment, borough, points,
               round(CAST(points AS DOUBLE) / sum(points) OVER (PARTITION BY segment) * 100, 2) AS share_pct
        FROM (SELECT segment, nearest_borough AS borough, CAST(sum(weight) AS BIGINT) AS points FROM near GROUP BY ALL)""",
    "snaps": """
        SELECT f.segment, f.cluster_id, f.cluster_count AS total_count,
               round(CAST(f.cluster_count AS DOUBLE) / sum(f.cluster_count) OVER (PARTITION BY f.segment) * 100, 2)
                 AS share_pct, f.center_long, f.center_lat, f.nearest_borough
        FROM (SELECT r.segment, r.cluster_id, r.cluster_count, r.center_long, r.center_lat,
                     arg_min(borough, ((c.long - r.center_long) * (c.long - r.center_long) + (c.lat - r.center_lat) * (c.lat - r.center_lat), borough))
                       AS nearest_borough
              FROM refined r CROSS JOIN centroids c GROUP BY ALL) f""",
    "ranked_clusters": """
        SELECT *, row_number() OVER (PARTITION BY segment ORDER BY total_count DESC, cluster_id) AS turn FROM snaps""",
    "ranked_boroughs": """
        SELECT *, row_number() OVER (PARTITION BY segment ORDER BY points DESC, borough) AS turn FROM shares""",
    "top_clusters": """
        SELECT a.segment, a.cluster_id AS id1, a.share_pct AS pct1, coalesce(b.cluster_id, a.cluster_id) AS id2,
               coalesce(b.share_pct, a.share_pct) AS pct2,
               round(a.share_pct + coalesce(b.share_pct, a.share_pct), 2) AS top2,
               list_position(['morning', 'afternoon', 'evening', 'night', 'all'], a.segment) AS place
        FROM ranked_clusters a LEFT JOIN ranked_clusters b ON a.segment = b.segment AND b.turn = 2
        WHERE a.turn = 1""",
    "remarked": """
        SELECT p.segment, p.location_id, p.long, p.lat, p.weight,
               arg_min(cluster_id, ((center_long - p.long) * (center_long - p.long) + (center_lat - p.lat) * (center_lat - p.lat), cluster_id)) AS cluster_id,
               min((center_long - p.long) * (center_long - p.long) + (center_lat - p.lat) * (center_lat - p.lat)) AS d2
        FROM points p JOIN refined USING (segment) GROUP BY ALL""",
    "zone_sums": """
        SELECT p.segment, p.location_id, p.weight, p.cluster_id AS own, q.cluster_id AS other,
               sum(q.weight * sqrt((p.long - q.long) * (p.long - q.long) + (p.lat - q.lat) * (p.lat - q.lat))) AS d, sum(q.weight) AS w
        FROM remarked p JOIN remarked q USING (segment) GROUP BY ALL""",
    "zone_widths": """
        SELECT segment, location_id, weight, max(w) FILTER (own = other) AS n,
               max(d / nullif(w - 1, 0)) FILTER (own = other) AS a, min(d / w) FILTER (own <> other) AS b
        FROM zone_sums GROUP BY ALL""",
    "hull_points": "SELECT DISTINCT segment, cluster_id, long AS x, lat AS y FROM marked",
    "hull_edges": """
        SELECT a.segment, a.cluster_id, a.x, a.y FROM hull_points a JOIN hull_points b USING (segment, cluster_id)
          JOIN hull_points c USING (segment, cluster_id)
        WHERE (a.x, a.y) <> (b.x, b.y) GROUP BY a.segment, a.cluster_id, a.x, a.y, b.x, b.y
        HAVING bool_and(CASE WHEN abs((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x)) > 1e-12
          THEN (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) > 0
          ELSE (c.x - a.x) * (b.x - a.x) + (c.y - a.y) * (b.y - a.y)
               BETWEEN -1e-12 AND (b.x - a.x) ** 2 + (b.y - a.y) ** 2 + 1e-12 END)""",
    "hull_corners": """
        SELECT segment, cluster_id, x, y, (angle - arg_min(angle, (x, y)) OVER (PARTITION BY segment, cluster_id)
               + 2 * pi()) % (2 * pi()) AS turn
        FROM (SELECT *, atan2(y - avg(y) OVER (PARTITION BY segment, cluster_id),
                              x - avg(x) OVER (PARTITION BY segment, cluster_id)) AS angle,
                     count(*) OVER (PARTITION BY segment, cluster_id) AS corners
              FROM (SELECT DISTINCT * FROM hull_edges)) WHERE corners > 2""",
    "cluster_quotas": """
        SELECT segment, cluster_id, size, greatest(1, least(size, base + CASE WHEN row_number() OVER (
                 PARTITION BY segment ORDER BY share % total DESC, cluster_id) <= least(25000, total) - sum(base) OVER (PARTITION BY segment)
               THEN 1 ELSE 0 END) - CASE WHEN row_number() OVER (PARTITION BY segment ORDER BY size DESC, cluster_id) = 1
               THEN greatest(0, sum(base) OVER (PARTITION BY segment) - least(25000, total)) ELSE 0 END) AS quota
        FROM (SELECT *, greatest(1, share // total) AS base
              FROM (SELECT *, least(25000, total) * size AS share
                    FROM (SELECT segment, cluster_id, CAST(sum(weight) AS BIGINT) AS size,
                            CAST(sum(sum(weight)) OVER (PARTITION BY segment) AS BIGINT) AS total
                          FROM marked GROUP BY segment, cluster_id)))""",
    "shown_cells": """
        SELECT segment, location_id, long, lat, cluster_id, CAST(base + CASE WHEN row_number() OVER (
                 PARTITION BY segment, cluster_id ORDER BY share % size DESC, location_id)
                 <= quota - sum(base) OVER (PARTITION BY segment, cluster_id) THEN 1 ELSE 0 END AS BIGINT) AS display_count
        FROM (SELECT m.*, quota, size, quota * weight AS share, quota * weight // size AS base
              FROM marked m JOIN cluster_quotas USING (segment, cluster_id))""",
    "basket_in": f"""
        SELECT lower(a.zone) AS az, lower(b.zone) AS bz, a.borough AS ab, b.borough AS bb, {_bucket(HOUR)} AS bucket,
               dayofweek(pickup_date) IN (0, 6) AS we, trip_distance AS dist, fare_amount AS fare, tip_amount AS tip,
               payment_type AS pay, t.pickup_location_id, t.dropff_location_id, pickup_date, {HOUR} AS hour
        FROM trips t JOIN zones a ON a.location_id = pickup_location_id JOIN zones b ON b.location_id = dropff_location_id
        WHERE trip_distance > 0 AND trip_distance < 30 AND fare_amount >= 0 AND fare_amount < 1000 AND tip_amount >= 0
          AND a.zone <> 'Unknown' AND b.zone <> 'Unknown'""",
    "airports": """
        SELECT *, CASE WHEN az LIKE '%jfk%' THEN 'JFK' WHEN az LIKE '%laguardia%' THEN 'LGA'
                       WHEN az LIKE '%newark%' OR lower(ab) = 'ewr' THEN 'EWR' END AS aa,
               CASE WHEN bz LIKE '%jfk%' THEN 'JFK' WHEN bz LIKE '%laguardia%' THEN 'LGA'
                    WHEN bz LIKE '%newark%' OR lower(bb) = 'ewr' THEN 'EWR' END AS ba
        FROM basket_in WHERE bucket IS NOT NULL""",
    "baskets": """
        SELECT [coalesce('source_airport=' || aa, 'source_borough=' || ab),
                coalesce('destination_airport=' || ba, 'destination_borough=' || bb),
                'time_bin=' || upper(bucket[1]) || bucket[2:],
                'day_type=' || CASE WHEN we THEN 'Weekend' ELSE 'Weekday' END,
                'distance_bin=' || CASE WHEN dist < 2 THEN '0-2mi' WHEN dist < 5 THEN '2-5mi' WHEN dist < 10 THEN '5-10mi'
                  WHEN dist < 20 THEN '10-20mi' ELSE '20-30mi' END,
                'fare_bin=' || CASE WHEN fare < 10 THEN '$0-$10' WHEN fare < 20 THEN '$10-$20'
                  WHEN fare < 40 THEN '$20-$40' WHEN fare < 80 THEN '$40-$80' WHEN fare < 100 THEN '$80-$100'
                  WHEN fare < 140 THEN '$100-$140' WHEN fare < 180 THEN '$140-$180' WHEN fare < 300 THEN '$180-$300'
                  ELSE '$300-$1000' END,
                'tip_bin=' || CASE WHEN tip <= 0 THEN 'NoTip'
                  WHEN (CASE WHEN fare > 0 THEN tip / fare ELSE 0e0 END) < 1e-1 THEN 'LowTip'
                  WHEN (CASE WHEN fare > 0 THEN tip / fare ELSE 0e0 END) < 2e-1 THEN 'MidTip' ELSE 'HighTip' END,
                'payment_type=' || CASE pay WHEN 1 THEN 'CreditCard' WHEN 2 THEN 'Cash' ELSE 'Other' END,
                'route_type=' || CASE WHEN aa IS NULL THEN 'city' ELSE 'airport' END || '_to_'
                  || CASE WHEN ba IS NULL THEN 'city' ELSE 'airport' END] AS items
        FROM airports""",
    "tok": "SELECT id, unnest(items) AS token FROM (SELECT row_number() OVER () AS id, items FROM baskets)",
    "single": "SELECT token, count(*) AS n FROM tok GROUP BY token",
    "pairs": """
        SELECT a.token AS x, b.token AS y, count(*) AS n FROM tok a JOIN tok b ON a.id = b.id AND a.token <> b.token
        GROUP BY ALL""",
    "whole": "SELECT list_sort(items) AS items, CAST(count(*) AS DOUBLE) AS n FROM baskets GROUP BY 1",
    "subsets": """
        SELECT [x FOR x, i IN items IF (m >> (i - 1)) & 1 = 1] AS s, n FROM whole, range(1, 512) AS masks(m)""",
    "itemsets": """
        SELECT s, sum(n) AS n FROM subsets GROUP BY s
        HAVING sum(n) >= ceil(0.001::DOUBLE * (SELECT count(*) FROM baskets))""",
    "sides": """
        SELECT list_filter(s, lambda x: x <> y) AS a, [y] AS c, n FROM (SELECT s, n, unnest(s) AS y FROM itemsets WHERE len(s) > 1)""",
    "ruled": """
        SELECT p.a || p.c AS items, '{' || array_to_string(p.a, ', ') || '} -> {' || p.c[1] || '}' AS rule,
               p.a AS a, p.c AS c, p.n / t.n AS support, p.n / x.n AS confidence, (p.n / x.n) / (y.n / t.n) AS lift
        FROM sides p JOIN itemsets x ON x.s = p.a JOIN itemsets y ON y.s = p.c
        CROSS JOIN (SELECT count(*)::DOUBLE AS n FROM baskets) t WHERE p.n / x.n >= 25e-2""",
    "ruled6": f"SELECT items, rule, a, c, {r6s('support', 'confidence', 'lift')} FROM ruled",
    "scores": f"""
        SELECT *, confidence * lift * CASE WHEN {_AIRPORT} THEN 135e-2 ELSE 1e0 END
                 * CASE WHEN {_token_flag("day_type")} THEN 11e-1 ELSE 1e0 END
                 * CASE WHEN {_PRICED} THEN 12e-1 ELSE 1e0 END * (least(support, 2e-1) + 1e0) AS ranking_score
        FROM {{source}}""",
    "member": " UNION ALL ".join(
        f"SELECT *, {place} AS place, '{name}' AS category, '{kind}' AS match_kind FROM scored_rules WHERE {condition}"
        for place, name, kind, condition in FORMS
    ),
}
_scores = CTES.pop("scores")
CTES["scored_rules"] = _scores.format(source="ruled6")
CTES["scored_raw"] = _scores.format(source="ruled")
# The picks of the showcase, category by category: a rule taken earlier is out of the race.
_names = list(dict.fromkeys((place, name) for place, name, _, _ in FORMS))
for _place, _name in _names:
    taken = " UNION ALL ".join(f"SELECT rule FROM pick{i}" for i in range(_place)) or "SELECT NULL AS rule WHERE false"
    CTES[f"pick{_place}"] = f"""
        SELECT * FROM member WHERE place = {_place} AND rule NOT IN ({taken})
        ORDER BY match_kind = 'relaxed', ranking_score DESC, lift DESC, confidence DESC, support DESC, rule LIMIT 1"""
_time, _fare, _dist = _token_value("time_bin"), _token_value("fare_bin"), _token_value("distance_bin")
_day, _tip = _token_value("day_type"), _token_value("tip_bin")
_from = f"coalesce({_token_value('source_borough')}, {_token_value('source_airport')})"
_raw = {"time": _time, "fare": _fare, "distance": _dist, "day": _day}
_time, _fare, _dist = f"coalesce({_time}, 'selected time')", f"coalesce({_fare}, 'selected fare band')", f"coalesce({_dist}, 'selected distance band')"
_day, _tip, _from = f"coalesce({_day}, 'all-day')", f"coalesce({_tip}, 'higher tips')", f"coalesce({_from}, 'source zones')"
CATEGORY_SENTENCES = [
    f"'Weekday ' || lower({_time}) || ' trips from ' || {_from} || ' to EWR most commonly fall in fare band ' || {_fare} || '.'",
    f"'Weekend ' || lower({_time}) || ' demand to EWR is concentrated from ' || {_from} || ', typically within fare band ' || {_fare} || '.'",
    f"'Weekday ' || lower({_time}) || ' trips from ' || {_from} || ' to LGA show a strong fare pattern in ' || {_fare} || '.'",
    f"'Weekend ' || lower({_time}) || ' LGA travel is dominated by ' || {_from} || ' routes with fares around ' || {_fare} || '.'",
    f"'Morning demand differs by day type, with ' || {_dist} || ' trips most often priced in ' || {_fare} || '.'",
    f"'Night trips show a distinct weekday/weekend mix, where ' || {_dist} || ' rides frequently map to ' || {_fare} || '.'",
    f"'Trips in ' || {_dist} || ' and ' || {_fare} || ' bands are strongly linked with ' || {_tip} || ' tipping behavior.'",
    f"'Short-distance rides (' || {_dist} || ') still show elevated fares (' || {_fare} || ') during ' || lower({_time}) || ' periods.'",
    f"{_day} || ' ' || lower({_time}) || ' trips in ' || {_dist} || ' are more likely to be paid by cash.'",
    f"{_day} || ' ' || lower({_time}) || ' trips in ' || {_dist} || ' are more likely to be paid by credit card.'",
]
CTES["shown"] = " UNION ALL ".join(
    f"""SELECT {place} AS place, '{name}' AS category, coalesce(match_kind, 'none') AS match_kind, rule,
        support, confidence, lift, CASE WHEN rule IS NOT NULL THEN {CATEGORY_SENTENCES[place]} END AS insight
        FROM (SELECT 1) LEFT JOIN pick{place} ON true"""
    for place, name in _names
)
_movement = f"replace({_token_value('route_type')}, '_', ' ')"
_gate = f"coalesce({_token_value('source_airport')}, {_token_value('destination_airport')})"
_when, _what, _far, _on = _raw["time"], _raw["fare"], _raw["distance"], _raw["day"]
INSIGHT = f"""coalesce('Airport-linked trips (' || {_movement} || ') are concentrated around ' || {_gate} || ' '
    || coalesce('during ' || lower({_when}), 'across time windows') || coalesce(' on ' || lower({_on}) || 's', '')
    || coalesce(' with fares commonly in ' || {_what}, '') || '.',
  'On ' || lower({_on}) || ' ' || lower({_when}) || ' periods, trips in ' || {_far} || ' most often align with fares in ' || {_what} || '.',
  CASE WHEN {_far} IS NOT NULL OR {_what} IS NOT NULL THEN {_when} || ' travel patterns indicate consistent pricing behavior '
    || coalesce('for ' || {_far} || ' trips', 'for these trips') || coalesce(' and fares in ' || {_what}, '') || '.' END,
  'This pattern appears frequently and indicates a stable co-occurrence between trip context and route characteristics.')"""
CTES["told"] = f"SELECT rule, support, confidence, lift, {INSIGHT} AS insight FROM ruled6"


def _closure(names: set[str], ctes: dict[str, str]) -> list[str]:
    needed, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [c for c in ctes if re.search(rf"\b{c}\b", ctes[name])]
    # Definition order is not dependency order for all; sort by depth of use.
    ordered: list[str] = []

    def place(name: str, path: tuple[str, ...] = ()) -> None:
        if name in ordered or name in path:
            return
        for other in ctes:
            if other != name and other in needed and re.search(rf"\b(?:FROM|JOIN|,)\s+{other}\b", ctes[name]):
                place(other, (*path, name))
        ordered.append(name)

    for name in ctes:
        if name in needed:
            place(name)
    return ordered


def sql(body: str, **instead: str) -> str:
    """The statement behind the common table expressions it uses, some of them replaced."""
    ctes = CTES | instead
    used = {c for c in ctes if re.search(rf"\b(?:FROM|JOIN)\s+{c}\b", body)}
    names = _closure(used, ctes)
    held = lambda n: "MATERIALIZED " if n in ("itemsets", "ruled", "ruled6", "member") else ""
    return "WITH " + ",\n".join(f"{n} AS {held(n)}({ctes[n]})" for n in names) + "\n" + body


def _walk(part, cols: tuple[str, ...]) -> str:
    if not isinstance(part, tuple):
        return f"{part:e}"
    k, threshold, low, high = part
    test = f"CAST({cols[k]} AS FLOAT) <= CAST({threshold} AS FLOAT)"
    return f"CASE WHEN {test} THEN {_walk(low, cols)} ELSE {_walk(high, cols)} END"


def _forest_score(cols: tuple[str, ...]) -> str:
    """Score of the fixed forest over the columns."""
    depths = " + ".join(_walk(fixed_tree(tree, cols), cols) for tree in range(FIXED_TREES))
    expected = f"(2 * (ln({FIXED_ROWS} - 1) + 0.5772156649015329) - 2 * ({FIXED_ROWS}e0 - 1) / {FIXED_ROWS})"
    return f"pow(2e0, -(({depths}) / {FIXED_TREES}e0) / {expected}) - 5e-1"


FOREST_SCORED = f"""SELECT *, {_forest_score(SPEED_FEATURES)} AS speed_anomaly_score,
    {_forest_score(FARE_FEATURES)} AS fare_anomaly_score FROM feat"""


_PAIR_OUT = "pickup_location_id AS source_id, dropff_location_id AS destination_id"
_PREP_OUT = (
    "source_id, destination_id, pickup_date, pickup_time, pickup_timestamp, pickup_hour, day_of_week, is_weekend, "
)
_MEASURES = ("trip_distance", "fare_amount", "tip_amount", "extra_amount", "total_trip_amount")
_SPEED_FARE = (
    "speed_mph", "trip_distance_miles", "eta_minutes", "fare_amount", "fare_per_mile", "pickup_hour_sin",
    "pickup_hour_cos", "fare_per_minute", "context_median_fare", "context_iqr_fare", "context_count_log1p",
    "fare_to_context_median_ratio",
)
_FLOW = f"""
    FROM (SELECT {_PAIR_OUT}, count(*) AS trip_count FROM trips WHERE {WINDOW}
          GROUP BY ALL ORDER BY trip_count DESC, 1, 2 LIMIT 400) p
    JOIN coords a ON a.location_id = source_id AND a.lat IS NOT NULL
    JOIN coords b ON b.location_id = destination_id AND b.lat IS NOT NULL
    LEFT JOIN known x ON x.location_id = source_id LEFT JOIN known y ON y.location_id = destination_id"""
_EDGE = "(lo + (hi - lo) / 4e0 * {i})"
_ROWS_ROUND = r6s(
    "fare_amount", "trip_distance_miles", "eta_minutes", "speed_mph", "fare_to_context_median_ratio",
    "context_median_fare", "context_iqr_fare", "anomaly_score",
)
_ROWS_KEYS = "pickup_timestamp, pickup_hour, source_id, destination_id, origin_label, destination_label, anomaly_type"


def _top_rows(kind: str, digits: dict[str, int]) -> str:
    cols = (
        "fare_amount", "trip_distance_miles", "eta_minutes", "speed_mph", "fare_to_context_median_ratio",
        "context_median_fare", "context_iqr_fare", "anomaly_score",
    )
    rounded = ", ".join(r6(f"round({c}, {digits[c]})" if c in digits else c, c) for c in cols)
    return f"""SELECT {_ROWS_KEYS}, {rounded}
        FROM (SELECT * FROM rows_out WHERE anomaly_type = '{kind}'
              ORDER BY anomaly_score DESC, pickup_timestamp, source_id, destination_id, fare_amount,
                       trip_distance_miles, eta_minutes LIMIT 10)"""


_PHRASES = "CASE split_part(t, '=', 1) " + " ".join(
    f"WHEN '{key}' THEN {text}"
    for key, text in {
        "day_type": "'it is a ' || lower(split_part(t, '=', 2)) || ' trip'",
        "time_bin": "'time of day is ' || split_part(t, '=', 2)",
        "source_borough": "'pickup is in ' || split_part(t, '=', 2)",
        "destination_borough": "'drop-off is in ' || split_part(t, '=', 2)",
        "source_airport": "'pickup is from ' || split_part(t, '=', 2) || ' airport'",
        "destination_airport": "'drop-off is to ' || split_part(t, '=', 2) || ' airport'",
        "distance_bin": "'distance is in ' || split_part(t, '=', 2)",
        "fare_bin": "'fare is in ' || split_part(t, '=', 2)",
        "tip_bin": "'tip behavior is ' || split_part(t, '=', 2)",
        "payment_type": "'payment mode is ' || CASE split_part(t, '=', 2) WHEN 'CreditCard' THEN 'credit card' "
        "ELSE lower(split_part(t, '=', 2)) END",
        "route_type": "'route type is ' || replace(split_part(t, '=', 2), '_', ' ')",
    }.items()
) + " END"

ORACLE: dict[str, str] = {
    "clean_trips": f"""SELECT {TRIP_OUT} FROM (SELECT DISTINCT * FROM trips)""",
    "prepare_anomaly": f"""SELECT {_PREP_OUT} {r6s('trip_distance_miles', 'fare_amount', 'eta_minutes', 'speed_mph',
        'fare_per_mile', 'fare_per_minute')} FROM rated""",
    "prepare_forecast": f"""SELECT source_id, destination_id, pickup_hour, day_of_week, is_weekend, month, eta_minutes,
        {r6('fare_amount')} FROM fprep""",
    "prepare_rules": f"""SELECT pickup_location_id AS source_id, dropff_location_id AS destination_id, pickup_date,
        hour AS pickup_hour, pay AS payment_type, {r6('dist', 'trip_distance')}, {r6('fare', 'fare_amount')},
        {r6('tip', 'tip_amount')}, a.zone AS source_zone, ab AS source_borough, b.zone AS destination_zone,
        bb AS destination_borough FROM basket_in JOIN zones a ON a.location_id = pickup_location_id
        JOIN zones b ON b.location_id = dropff_location_id""",
    "impute_median": f"""SELECT pickup_location_id, pickup_date, pickup_time, {r6('''coalesce(
          CASE WHEN pickup_location_id % 7 <> 0 AND pickup_location_id % 11 <> 0 THEN fare_amount END,
          (SELECT median(fare_amount) FROM trips WHERE pickup_location_id % 7 <> 0 AND pickup_location_id % 11 <> 0))''',
        'fare_amount')} FROM trips""",
    "hour_cycle": f"""SELECT pickup_hour, {r6('sin(2 * pi() * pickup_hour / 24)', 'pickup_hour_sin')},
        {r6('cos(2 * pi() * pickup_hour / 24)', 'pickup_hour_cos')}, count(*) AS trips FROM prep GROUP BY pickup_hour""",
    "known_boroughs": "SELECT location_id, borough, zone FROM known",
    "filter_window": f"SELECT {TRIP_OUT} FROM trips WHERE {WINDOW}",
    "segment_trips": f"""SELECT s.segment, pickup_location_id, dropff_location_id, pickup_date, pickup_time
        FROM (SELECT *, {HOUR} AS hour FROM trips) t JOIN {EVERY_SEGMENT} ON {SEGMENT_JOIN}""",
    "with_zones": f"""SELECT {_PAIR_OUT}, {r6('fare_amount')}, a.borough AS source_borough, a.zone AS source_zone,
        b.borough AS destination_borough, b.zone AS destination_zone FROM trips
        LEFT JOIN zones a ON a.location_id = pickup_location_id LEFT JOIN zones b ON b.location_id = dropff_location_id""",
    "with_coords": f"""SELECT {_PAIR_OUT}, {r6('fare_amount')}, {r6('a.lat', 'source_lat')}, {r6('a.long', 'source_long')},
        {r6('b.lat', 'destination_lat')}, {r6('b.long', 'destination_long')} FROM trips
        JOIN coords a ON a.location_id = pickup_location_id AND a.lat IS NOT NULL
        JOIN coords b ON b.location_id = dropff_location_id AND b.lat IS NOT NULL""",
    "route_distance": f"""SELECT {_PAIR_OUT}, {r6('fare_amount')}, {r6(_haversine('a', 'b'), 'route_distance_km')} FROM trips
        LEFT JOIN coords a ON a.location_id = pickup_location_id
        LEFT JOIN coords b ON b.location_id = dropff_location_id""",
    "with_labels": f"""SELECT {_PAIR_OUT},
        coalesce(a.zone, 'Unknown') || ' (' || coalesce(a.borough, 'Unknown') || ')' AS origin_label,
        coalesce(b.zone, 'Unknown') || ' (' || coalesce(b.borough, 'Unknown') || ')' AS destination_label FROM trips
        LEFT JOIN zones a ON a.location_id = pickup_location_id
        LEFT JOIN zones b ON b.location_id = dropff_location_id""",
    "with_date_dim": f"""SELECT pickup_date, pickup_time, {r6('fare_amount')}, dayname(pickup_date) AS day, is_weekend
        FROM trips JOIN days ON date = pickup_date""",
    "attach_context": f"""SELECT source_id, destination_id, pickup_date, pickup_time, pickup_hour, day_of_week, is_weekend,
        context_trip_count, {r6s('trip_distance_miles', 'fare_amount', 'context_fare_q1', 'context_fare_median',
        'context_fare_q3', 'context_iqr_fare', 'context_median_fare', 'context_count_log1p',
        'fare_to_context_median_ratio')} FROM feat""",
    "anomaly_features": f"""SELECT pickup_timestamp, source_id, destination_id, pickup_hour, day_of_week, is_weekend,
        {r6s(*_SPEED_FARE)} FROM feat""",
    "od_points": f"SELECT pickup_date, pickup_time, location_id, {r6s('long', 'lat')} FROM ends",
    "nearest_borough": f"SELECT segment, location_id, {r6s('long', 'lat')}, weight, nearest_borough FROM near",
    "unsampled_rows": f"""SELECT pickup_location_id, pickup_date, pickup_time, {r6('fare_amount')}, {ROW_KEY} AS k
        FROM trips t WHERE {ROW_KEY} >= {KEY_SPACE // 3}""",
    "location_catalog": f"""SELECT z.location_id, trim(borough) AS borough, trim(zone) AS zone, {r6('lat')}, {r6('long')},
        z.location_id || ' - ' || trim(zone) AS option_label, CAST(coalesce(list_position(
          ['Manhattan', 'Brooklyn', 'Queens', 'Bronx', 'Staten Island', 'EWR'], trim(borough)) - 1, 6) AS INTEGER)
          AS borough_place
        FROM known z LEFT JOIN coords c ON c.location_id = z.location_id""",
    "date_dim": "SELECT date, dayname(date) AS day, is_weekend FROM days",
    "monthly_counts": """SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month_no,
        strftime(m, '%b') AS month, count(pickup_date) AS trip_count
        FROM (SELECT unnest(generate_series(DATE '1994-11-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS m) spine
        LEFT JOIN trips ON date_trunc('month', pickup_date) = m
          AND pickup_date BETWEEN DATE '1994-11-01' AND DATE '2001-12-31' GROUP BY m""",
    "weekday_weekend_avg": f"""SELECT CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS segment,
        {r6('count(*)::DOUBLE / count(DISTINCT pickup_date)', 'avg_trips')}
        FROM trips JOIN days ON date = pickup_date GROUP BY is_weekend""",
    "weekpart_bucket_avg": f"""SELECT is_weekend, CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS segment,
        time_of_day, {r6('coalesce(n, 0)::DOUBLE / d', 'avg_trips')}
        FROM (SELECT is_weekend, count(*) AS d FROM days WHERE date BETWEEN DATE '1996-03-01' AND DATE '1999-08-31'
              GROUP BY 1) x
        CROSS JOIN (VALUES ('morning'), ('afternoon'), ('evening'), ('night')) AS b(time_of_day)
        LEFT JOIN (SELECT is_weekend, {_bucket(HOUR)} AS time_of_day, count(*) AS n
              FROM trips JOIN days ON date = pickup_date
              WHERE date BETWEEN DATE '1996-03-01' AND DATE '1999-08-31' GROUP BY 1, 2) y
        USING (is_weekend, time_of_day)""",
    "weekpart_bucket_pivot": f"""SELECT CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS segment,
        {', '.join(r6(f"round(count(*) FILTER ({_bucket(HOUR)} = '{b}')::DOUBLE / count(DISTINCT date), 2)", b.title())
                   for b in ('morning', 'afternoon', 'evening', 'night'))}
        FROM trips JOIN days ON date = pickup_date GROUP BY is_weekend""",
    "kpis": f"""SELECT count(*) AS total_no_of_trips, min(pickup_date) AS start_date, max(pickup_date) AS end_date,
        {r6('count(*)::DOUBLE / count(DISTINCT pickup_date)', 'avg_no_of_trips_per_day')} FROM trips""",
    "borough_avg": f"""SELECT trim(borough) AS borough, {r6('avg(coalesce(n, 0)::DOUBLE)', 'avg_trips_per_location')},
        count(*) AS location_count
        FROM known LEFT JOIN (SELECT pickup_location_id AS location_id, count(*) AS n FROM trips GROUP BY 1)
        USING (location_id) GROUP BY 1""",
    "bucket_avg": f"""SELECT time_of_day, {r6('coalesce(n, 0)::DOUBLE / (SELECT count(DISTINCT pickup_date) FROM trips)',
        'avg_trips')} FROM (VALUES ('morning'), ('afternoon'), ('evening'), ('night')) AS b(time_of_day)
        LEFT JOIN (SELECT {_bucket(HOUR)} AS time_of_day, count(*) AS n FROM trips GROUP BY 1) USING (time_of_day)""",
    "weekpart_totals": """SELECT count(*) FILTER (dayofweek(pickup_date) NOT IN (0, 6)) AS total_no_of_weekday_trips,
        count(*) FILTER (dayofweek(pickup_date) IN (0, 6)) AS total_no_of_weekend_trips FROM trips""",
    "od_counts": f"""SELECT {_PAIR_OUT}, count(*) AS trip_count FROM trips GROUP BY ALL
        ORDER BY trip_count DESC, 1, 2 LIMIT 400""",
    "top_frequent_pairs": f"""SELECT source_id, destination_id, x.zone AS source_zone, y.zone AS destination_zone,
        {r6(_haversine('a', 'b'), 'distance_km')}, frequency_of_trips, {r6('avg_fare_amount')}
        FROM (SELECT {_PAIR_OUT}, count(*) AS frequency_of_trips, avg(fare_amount) AS avg_fare_amount FROM trips
              GROUP BY ALL ORDER BY 3 DESC, 1, 2 LIMIT 10)
        LEFT JOIN coords a ON a.location_id = source_id LEFT JOIN coords b ON b.location_id = destination_id
        LEFT JOIN zones x ON x.location_id = source_id LEFT JOIN zones y ON y.location_id = destination_id""",
    "top_tipped_pairs": f"""SELECT source_id, destination_id, x.zone AS source_zone, y.zone AS destination_zone,
        {r6('avg_tip_amount')}, frequency_of_trips
        FROM (SELECT {_PAIR_OUT}, count(*) AS frequency_of_trips, avg(tip_amount) AS avg_tip_amount FROM trips
              GROUP BY ALL ORDER BY 4 DESC, 1, 2 LIMIT 10)
        LEFT JOIN zones x ON x.location_id = source_id LEFT JOIN zones y ON y.location_id = destination_id""",
    "describe": " UNION ALL ".join(
        f"""SELECT '{c}' AS measure, count({c}) AS count, {r6(f'avg({c})', 'mean')}, {r6(f'stddev_samp({c})', 'stddev')},
        {r6(f'min({c})', 'min')}, {r6(f'max({c})', 'max')} FROM trips""" for c in _MEASURES
    ),
    "correlations": " UNION ALL ".join(
        f"""SELECT '{a}' AS "left", '{b}' AS "right", {r6(f'corr({a}, {b})', 'correlation')} FROM trips"""
        for i, a in enumerate(_MEASURES) for b in _MEASURES[i + 1:]
    ),
    "od_flow": f"""SELECT source_id, destination_id, trip_count, {r6s('source_lat', 'source_long', 'destination_lat',
        'destination_long')}, source_zone, destination_zone,
        {r6('CASE WHEN hi = lo THEN 3e0 ELSE (trip_count - lo) / (hi - lo) * 1e1 + 15e-1 END', 'line_width')},
        {r6('CASE WHEN hi = lo THEN 4e0 ELSE (trip_count - lo) / (hi - lo) * 1e1 + 12e-1 END', 'styled_width')},
        CASE WHEN hi > lo THEN bin END AS bucket_index,
        CASE WHEN hi = lo THEN format('{{:,}}', trip_count) || ' trips' ELSE
          format('{{:,}}', CAST(floor(lo + (hi - lo) / 4e0 * bin) AS BIGINT) + CASE WHEN bin > 0 THEN 1 ELSE 0 END)
          || ' - ' || format('{{:,}}', CAST(ceil(lo + (hi - lo) / 4e0 * (bin + 1)) AS BIGINT)) || ' trips' END
          AS range_label
        FROM (SELECT *, CAST((trip_count >= {_EDGE.format(i=1)})::INTEGER + (trip_count >= {_EDGE.format(i=2)})::INTEGER
                + (trip_count >= {_EDGE.format(i=3)})::INTEGER AS INTEGER) AS bin
              FROM (SELECT source_id, destination_id, trip_count, a.lat AS source_lat, a.long AS source_long,
                b.lat AS destination_lat, b.long AS destination_long, x.zone AS source_zone, y.zone AS destination_zone,
                min(trip_count) OVER ()::DOUBLE AS lo, max(trip_count) OVER ()::DOUBLE AS hi {_FLOW}))""",
    "flow_centre": f"""SELECT {r6('(avg(a.lat) + avg(b.lat)) / 2', 'latitude')},
        {r6('(avg(a.long) + avg(b.long)) / 2', 'longitude')} {_FLOW}""",
    "sample_capped": f"""SELECT {TRIP_OUT} FROM (SELECT * FROM trips WHERE {ROW_KEY} < {int(0.5 * KEY_SPACE)}
        ORDER BY {ROW_KEY}, {TRIP_COLUMNS} LIMIT 9000)""",
    "sample_n": f"SELECT {TRIP_OUT} FROM (SELECT * FROM trips ORDER BY {ROW_KEY}, {TRIP_COLUMNS} LIMIT 2500)",
    "stratified_sample": f"""SELECT stratum, pickup_location_id, dropff_location_id, pickup_date, pickup_time,
        {r6('fare_amount')}
        FROM (SELECT *, row_number() OVER (ORDER BY turn > base, k, stratum, pickup_location_id, dropff_location_id,
                pickup_date, pickup_time, fare_amount) AS place
              FROM (SELECT *, least(size, greatest(1, round_even(size * 3001e0 / total, 0))) AS base FROM (
                SELECT *, count(*) OVER (PARTITION BY stratum) AS size, count(*) OVER () AS total,
                  row_number() OVER (PARTITION BY stratum ORDER BY k, pickup_location_id, dropff_location_id,
                    pickup_date, pickup_time, fare_amount) AS turn
                FROM (SELECT CASE WHEN trip_distance < 2 THEN '0-2mi' WHEN trip_distance < 5 THEN '2-5mi'
                        WHEN trip_distance < 10 THEN '5-10mi' WHEN trip_distance < 20 THEN '10-20mi'
                        ELSE '20-30mi' END AS stratum, *, {ROW_KEY} AS k FROM trips))))
        WHERE place <= 3001""",
    "context_stats": f"""SELECT source_id, destination_id, pickup_hour, is_weekend, count(*) AS context_trip_count,
        {', '.join(r6(_quantile(q, 'fare_amount'), f'context_fare_{n}') for n, q in (('q1', .25), ('median', .5), ('q3', .75)))}
        FROM prep GROUP BY ALL""",
    "route_stats": f"""SELECT source_id, destination_id, count(*) AS route_trip_count,
        {', '.join(r6(_quantile(q, 'fare_amount'), f'route_fare_{n}') for n, q in (('q1', .25), ('median', .5), ('q3', .75)))}
        FROM prep GROUP BY ALL""",
    "global_stats": f"""SELECT count(*) AS global_context_count,
        {', '.join(r6(_quantile(q, 'fare_amount'), f'global_fare_{n}') for n, q in (('q1', .25), ('median', .5), ('q3', .75)))}
        FROM prep""",
    "calibrate_speed": f"""SELECT pickup_hour, hour_label, {r6s('speed_score_threshold', 'speed_mph_threshold',
        'score_quantile', 'speed_quantile', 'estimated_anomaly_rate', 'global_speed_score_threshold',
        'global_speed_mph_threshold')} FROM speed_thr""",
    "calibrate_fare": f"""SELECT {r6s('score_quantile', 'score_threshold', 'iqr_multiplier', 'ratio_quantile',
        'ratio_threshold')}, {r6('rate', 'estimated_anomaly_rate')} FROM fare_thr""",
    "attach_hour_threshold": f"""SELECT pickup_timestamp, source_id, destination_id, scored.pickup_hour, {r6('speed_mph')},
        {r6('coalesce(t.speed_score_threshold, g.global_speed_score_threshold)', 'speed_score_threshold')},
        {r6('coalesce(t.speed_mph_threshold, g.global_speed_mph_threshold)', 'speed_mph_threshold')}
        FROM scored LEFT JOIN speed_thr t ON t.pickup_hour = scored.pickup_hour
        CROSS JOIN (SELECT * FROM speed_thr WHERE pickup_hour = 1) g""",
    "flag_speed": f"""SELECT pickup_timestamp, source_id, destination_id, {r6s('speed_mph', 'speed_anomaly_score')},
        is_extreme_speed_anomaly FROM flagged""",
    "flag_fare": f"""SELECT pickup_timestamp, source_id, destination_id, {r6s('fare_amount',
        'context_upper_fare_threshold')}, is_fare_outlier_anomaly FROM flagged""",
    "hourly_variation": f"""SELECT CAST(h AS INTEGER) AS pickup_hour, printf('%02d:00', h) AS hour_label,
        count(source_id) AS total_records, count(*) FILTER (is_extreme_speed_anomaly) AS anomaly_count,
        {r6('''round(coalesce(count(*) FILTER (is_extreme_speed_anomaly)::DOUBLE / nullif(count(source_id), 0) * 100, 0), 4)''',
        'anomaly_percentage')} FROM range(24) AS hours(h) LEFT JOIN flagged ON pickup_hour = h GROUP BY h""",
    "top_anomaly_pairs": """SELECT source_id, destination_id, origin_label AS origin, destination_label AS destination,
        count(*) AS anomaly_frequency FROM labelled WHERE is_fare_outlier_anomaly GROUP BY ALL
        ORDER BY anomaly_frequency DESC, source_id, destination_id LIMIT 10""",
    "anomaly_rows": f"SELECT {_ROWS_KEYS}, {_ROWS_ROUND} FROM rows_out",
    "top_anomalies": _top_rows(
        "extreme_speed",
        {"fare_amount": 2, "trip_distance_miles": 3, "eta_minutes": 2, "speed_mph": 2, "anomaly_score": 6},
    ),
    "top_fare_anomalies": _top_rows(
        "fare_outlier",
        {
            "fare_amount": 2, "trip_distance_miles": 3, "eta_minutes": 2, "fare_to_context_median_ratio": 3,
            "context_median_fare": 2, "context_iqr_fare": 2, "anomaly_score": 6,
        },
    ),
    "anomaly_totals": f"""SELECT count(*) AS total_valid_records,
        count(*) FILTER (is_extreme_speed_anomaly) AS extreme_speed_records,
        count(*) FILTER (is_fare_outlier_anomaly) AS fare_outlier_records,
        {r6('round(count(*) FILTER (is_extreme_speed_anomaly)::DOUBLE / count(*) * 100, 4)', 'extreme_speed_percentage')},
        {r6('round(count(*) FILTER (is_fare_outlier_anomaly)::DOUBLE / count(*) * 100, 4)', 'fare_outlier_percentage')}
        FROM flagged""",
    "agg_trip_frame": f"""SELECT source_id, destination_id, pickup_hour, day_of_week, is_weekend, month,
        {r6s('avg_fare_amount', 'avg_eta_minutes')}, trip_count FROM agg""",
    "split_months": """SELECT 'train' AS split, count(*) AS rows, CAST(sum(trip_count) AS BIGINT) AS trips FROM train
        UNION ALL SELECT 'test', count(*), CAST(sum(trip_count) AS BIGINT) FROM test""",
    "route_priors": f"""SELECT source_id, destination_id, {r6s('route_hist_avg_fare', 'route_hist_avg_eta',
        'route_hist_trip_count_log1p')} FROM prior""",
    "global_prior": f"""SELECT {r6('g_fare', 'route_hist_avg_fare')}, {r6('g_eta', 'route_hist_avg_eta')},
        {r6('g_count', 'route_hist_trip_count_log1p')} FROM gprior""",
    "attach_route_prior": f"""SELECT t.source_id, t.destination_id, pickup_hour, day_of_week, is_weekend, month,
        {r6s('avg_fare_amount', 'avg_eta_minutes')}, trip_count,
        {r6('coalesce(route_hist_avg_fare, g_fare)', 'route_hist_avg_fare')},
        {r6('coalesce(route_hist_avg_eta, g_eta)', 'route_hist_avg_eta')},
        {r6('coalesce(route_hist_trip_count_log1p, g_count)', 'route_hist_trip_count_log1p')}
        FROM test t LEFT JOIN prior p ON p.source_id = t.source_id AND p.destination_id = t.destination_id CROSS JOIN gprior""",
    "forecast_features": f"""SELECT source_id, destination_id, pickup_hour, day_of_week, is_weekend, month, trip_count,
        {r6s('avg_fare_amount', 'avg_eta_minutes', 'route_hist_avg_fare', 'route_hist_avg_eta',
             'route_hist_trip_count_log1p')},
        {r6('coalesce(km, (SELECT median(km) FROM tfeat))', 'route_distance_km')} FROM tfeat""",
    "regression_metrics": f"""SELECT {r6('avg(abs(avg_fare_amount - route_hist_avg_fare))', 'mae')},
        {r6('sqrt(avg(pow(avg_fare_amount - route_hist_avg_fare, 2)))', 'rmse')},
        {r6('1 - avg(pow(avg_fare_amount - route_hist_avg_fare, 2)) / var_pop(avg_fare_amount)', 'r2')} FROM tfeat""",
    "request_features": f"""SELECT q.source_id, q.destination_id, q.pickup_date, requested_hour, pickup_hour, day_of_week,
        is_weekend, month, {r6('coalesce(route_hist_avg_fare, g_fare)', 'route_hist_avg_fare')},
        {r6('coalesce(route_hist_avg_eta, g_eta)', 'route_hist_avg_eta')},
        {r6('coalesce(route_hist_trip_count_log1p, g_count)', 'route_hist_trip_count_log1p')},
        {r6('coalesce(' + _haversine('a', 'b') + ', 0)', 'route_distance_km')}
        FROM (SELECT *, requested_hour % 24 AS pickup_hour, CAST(dayofweek(day) AS INTEGER) AS day_of_week,
                CASE WHEN dayofweek(day) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend, CAST(month(day) AS INTEGER) AS month
              FROM (SELECT DISTINCT {_PAIR_OUT}, pickup_date, {HOUR} + 1 AS requested_hour,
                      CASE WHEN {HOUR} = 23 THEN pickup_date + 1 ELSE pickup_date END AS day FROM trips)) q
        LEFT JOIN prior p ON p.source_id = q.source_id AND p.destination_id = q.destination_id CROSS JOIN gprior
        LEFT JOIN coords a ON a.location_id = q.source_id LEFT JOIN coords b ON b.location_id = q.destination_id""",
    "weighted_points": f"SELECT segment, location_id, {r6s('long', 'lat')}, weight FROM points",
    "segment_point_counts": "SELECT segment, CAST(sum(weight) AS BIGINT) AS points FROM points GROUP BY segment",
    "borough_centroids": f"SELECT borough, {r6s('long', 'lat')}, location_count FROM centroids",
    "label_points": f"SELECT segment, location_id, {r6s('long', 'lat')}, weight, cluster_id, {r6('d2')} FROM marked",
    "cluster_hulls": f"""SELECT segment, cluster_id, CAST(row_number() OVER (PARTITION BY segment, cluster_id
        ORDER BY turn) - 1 AS INTEGER) AS seq, {r6('x', 'long')}, {r6('y', 'lat')} FROM hull_corners""",
    "refine_centres": f"SELECT segment, cluster_id, {r6s('center_long', 'center_lat')}, cluster_count FROM refined",
    "cluster_summary": f"""SELECT segment, cluster_id, coalesce(display_count, 0) AS display_count, coalesce(total_count, 0) AS total_count,
        {r6('coalesce(round(display_count::DOUBLE / total_count * 100, 2), 0)', 'display_pct_of_cluster')}
        FROM (SELECT segment, CAST(c AS INTEGER) AS cluster_id FROM {EVERY_SEGMENT}, range(5) AS k(c))
        LEFT JOIN (SELECT segment, cluster_id, CAST(sum(weight) AS BIGINT) AS total_count FROM marked GROUP BY ALL) USING (segment, cluster_id)
        LEFT JOIN (SELECT segment, cluster_id, CAST(sum(display_count) AS BIGINT) AS display_count FROM shown_cells GROUP BY ALL)
          USING (segment, cluster_id)""",
    "cluster_diagnostics": f"""SELECT (SELECT CAST(count(DISTINCT cluster_id) AS INTEGER) FROM remarked WHERE segment = 'all') AS k,
        (SELECT {r6('sum(d2 * weight)', 'x')} FROM remarked WHERE segment = 'all') AS inertia,
        {r6('sum(CASE WHEN n <= 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END * weight) / sum(weight)', 'silhouette')}
        FROM zone_widths WHERE segment = 'all'""",
    "bounds": f"""SELECT {r6('min(long) - 1e-2', 'x_long_min')}, {r6('max(long) + 1e-2', 'x_long_max')},
        {r6('min(lat) - 1e-2', 'y_lat_min')}, {r6('max(lat) + 1e-2', 'y_lat_max')}
        FROM (SELECT long, lat FROM points UNION ALL SELECT center_long, center_lat FROM refined)""",
    "axis_bounds": f"""SELECT {r6('min(long) - 1e-2', 'x_long_min')}, {r6('max(long) + 1e-2', 'x_long_max')},
        {r6('min(lat) - 1e-2', 'y_lat_min')}, {r6('max(lat) + 1e-2', 'y_lat_max')} FROM coords""",
    "borough_share": f"SELECT segment, borough, points, {r6('share_pct')} FROM shares",
    "cluster_snapshots": f"""SELECT segment, cluster_id, total_count, {r6s('share_pct', 'center_long', 'center_lat')},
        nearest_borough FROM snaps""",
    "concentration_summary": f"""SELECT t.segment, id1 AS dominant_cluster_id, {r6('pct1', 'dominant_cluster_share_pct')},
        id2 AS second_cluster_id, {r6('pct2', 'second_cluster_share_pct')}, {r6('top2', 'top2_share_pct')},
        a.borough AS top_borough, {r6('a.share_pct', 'top_borough_pct')}, coalesce(b.borough, a.borough) AS second_borough,
        {r6('coalesce(b.share_pct, 0)', 'second_borough_pct')},
        coalesce(a.borough || ' + ' || b.borough, a.borough) AS top_2_boroughs,
        {r6('coalesce(round(a.share_pct + b.share_pct, 2), a.share_pct)', 'top_2_borough_pct')},
        (SELECT upper(segment[1]) || segment[2:] FROM top_clusters WHERE segment <> 'all' ORDER BY pct1 DESC, place LIMIT 1)
          AS most_concentrated_period,
        (SELECT upper(segment[1]) || segment[2:] FROM top_clusters WHERE segment <> 'all' ORDER BY top2, place LIMIT 1) AS most_distributed_period,
        {r6('''round((SELECT top2 FROM top_clusters WHERE segment = 'afternoon')
          - (SELECT top2 FROM top_clusters WHERE segment = 'evening'), 2)''', 'concentration_gap')}
        FROM top_clusters t JOIN ranked_boroughs a ON a.segment = t.segment AND a.turn = 1
        LEFT JOIN ranked_boroughs b ON b.segment = t.segment AND b.turn = 2""",
    "cluster_payload": f"""SELECT segment, location_id, cluster_id, {r6s('long', 'lat')}, display_count, total_points_available,
        CAST(sum(display_count) OVER (PARTITION BY segment) AS BIGINT) AS display_points_count
        FROM shown_cells JOIN (SELECT segment, CAST(sum(weight) AS BIGINT) AS total_points_available FROM marked GROUP BY ALL)
          USING (segment) WHERE display_count > 0""",
    "numeric_guards": f"""SELECT pickup_location_id, dropff_location_id, pickup_date, pickup_time, {r6('held')},
        {r6('ln(1 + fare_amount / nullif(tip_amount, 0))', 'ratio_log1p')}, {r6('back')}, {r6('abs(fare_amount - back)', 'error')}
        FROM (SELECT *, greatest((1 + held) * exp(1e-2) - 1, 0) AS back
              FROM (SELECT *, least(greatest(fare_amount, 5e0), 6e1) AS held FROM trips))""",
    "transactions": "SELECT array_to_string(items, '|') AS items FROM baskets",
    "mine_rules": f"SELECT rule, {r6s('support', 'confidence', 'lift')} FROM ruled",
    "pair_rules": f"""SELECT '{{' || x || '}} -> {{' || y || '}}' AS rule, {r6('p.n / t.n', 'support')},
        {r6('p.n / a.n', 'confidence')}, {r6('(p.n / a.n) / (b.n / t.n)', 'lift')}
        FROM pairs p JOIN single a ON a.token = x JOIN single b ON b.token = y
        CROSS JOIN (SELECT count(*)::DOUBLE AS n FROM baskets) t
        WHERE p.n >= ceil(0.001::DOUBLE * t.n) AND p.n / a.n >= 25e-2""",
    "rank_rules": f"""SELECT rule, {r6s('support', 'confidence', 'lift', 'ranking_score')}, {_token_flag('time_bin')}
        AND ({_AIRPORT} OR {_PRICED}) AND lift >= 105e-2 AND confidence >= 35e-2 AS interesting_flag FROM scored_raw""",
    "categorise": "SELECT rule, place, category, match_kind FROM member",
    "showcase": f"SELECT place, category, match_kind, rule, {r6s('support', 'confidence', 'lift')}, insight FROM shown",
    "insight": "SELECT rule, insight FROM told",
    "rule_sentence": f"""SELECT rule, 'When ' || CASE WHEN len(p) <= 2 THEN array_to_string(p, ' and ')
          ELSE array_to_string(p[1:len(p) - 1], ', ') || ', and ' || p[len(p)] END || ', ' || c
        || ' is seen in about ' || printf('%.1f', round_even(confidence * 1000, 0) / 10) || '% of such trips.' AS sentence
        FROM (SELECT rule, confidence, [{_PHRASES} FOR t IN a] AS p,
                [{_PHRASES} FOR t IN c][1] AS c FROM ruled)""",
    "airport_spotlight": f"""SELECT rule, {r6s('support', 'confidence', 'lift')}, insight FROM (
        SELECT * FROM told WHERE rule ILIKE '%airport%' OR insight ILIKE '%airport%'
        ORDER BY lift DESC, confidence DESC, support DESC, rule LIMIT 6)""",
    "rule_kpis": f"""SELECT (SELECT count(*) FROM baskets) AS total_transactions, (SELECT count(*) FROM ruled) AS total_rules,
        {r6('avg(confidence)', 'avg_confidence')}, {r6('avg(lift)', 'avg_lift')} FROM shown""",
}
ORACLE = {name: sql(body) for name, body in ORACLE.items()}


def _job_hours(kind: str, flag: str) -> str:
    share = lambda hits, of: f"round(coalesce({hits}::DOUBLE / nullif({of}, 0) * 100, 0), 4)"
    return f"""SELECT '{kind}' AS kind, CAST(h AS INTEGER) AS pickup_hour, printf('%02d:00', h) AS hour_label,
        count(source_id) AS total_records, count(*) FILTER ({flag}) AS anomaly_count,
        {r6(share(f'count(*) FILTER ({flag})', 'count(source_id)'), 'anomaly_percentage')},
        (SELECT count(*) FILTER ({flag}) FROM flagged) AS records,
        {r6(f"(SELECT {share(f'count(*) FILTER ({flag})', 'count(*)')} FROM flagged)", 'percentage')}
        FROM range(24) AS hours(h) LEFT JOIN flagged ON pickup_hour = h GROUP BY h"""


_job = " UNION ALL ".join(
    _job_hours(kind, flag)
    for kind, flag in (("extreme_speed", "is_extreme_speed_anomaly"), ("fare_outlier", "is_fare_outlier_anomaly"))
)
ORACLE["forest_scores"] = sql(
    f"SELECT pickup_timestamp, source_id, destination_id, {r6s('speed_anomaly_score', 'fare_anomaly_score')} FROM scored",
    scored=FOREST_SCORED,
)
ORACLE["anomaly_job"] = sql(_job, scored=FOREST_SCORED)
