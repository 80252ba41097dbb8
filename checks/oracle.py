"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from checks.queries import DIGITS, SHORT
from checks.series import HOLIDAYS
from gridtide.operators.distribution import NORMAL_FAR, NORMAL_MIDDLE, NORMAL_NEAR

ORACLE: dict[str, str] = {}


def sql(name: str, text: str, *doubles: str) -> None:
    """Register a statement, cutting its double columns to the grid of the query."""
    if doubles:
        scale = f"1e{DIGITS[name]}"
        cut = ", ".join(f'floor("{c}" * {scale} + 0.47) / {scale} AS "{c}"' for c in doubles)
        text = f"SELECT * REPLACE ({cut}) FROM ({text})"
    ORACLE[name] = text


RAW = "SELECT event_type, ts AS timestamp, value AS load FROM events"
INDEXED = """SELECT event_type, ts AS timestamp, value AS load, count(*) OVER (PARTITION BY event_type) AS n,
    row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1 AS idx FROM events"""
HOUR_SUMS = "SELECT event_type, date_trunc('hour', ts) AS timestamp, sum(value) AS load FROM events GROUP BY ALL"
HOURLY_GAPS = f"""SELECT spine.event_type, spine.timestamp, s.load FROM (
    SELECT event_type, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp
    FROM ({HOUR_SUMS}) GROUP BY event_type) AS spine
    LEFT JOIN ({HOUR_SUMS}) AS s ON s.event_type = spine.event_type AND s.timestamp = spine.timestamp"""
ORDERS = "SELECT o_orderkey, o_orderpriority, o_orderdate AS timestamp, o_totalprice / 1000 AS load FROM orders"
TYPED = """SELECT event_type, CASE WHEN event_id % 29 <> 0 THEN date_trunc('minute', ts) END AS timestamp,
    CASE WHEN event_id % 17 <> 0 AND event_id % 23 <> 0 THEN value END AS load,
    CASE WHEN event_id % 13 <> 0 AND event_id % 7 <> 0 THEN user_id::DOUBLE END AS extra FROM events"""
VALID = f"SELECT * FROM ({TYPED}) WHERE timestamp IS NOT NULL"
UNIQUE = f"SELECT event_type, timestamp, avg(load) AS load, avg(extra) AS extra FROM ({VALID}) GROUP BY event_type, timestamp"


def filled(source: str, *columns: str) -> str:
    near, out = [], []
    for c in columns:
        at = f"CASE WHEN {c} IS NOT NULL THEN epoch_us(timestamp) END"
        near += [
            f"last_value({c} IGNORE NULLS) OVER back AS {c}_pv", f"last_value({at} IGNORE NULLS) OVER back AS {c}_pu",
            f"first_value({c} IGNORE NULLS) OVER ahead AS {c}_nv", f"first_value({at} IGNORE NULLS) OVER ahead AS {c}_nu",
        ]
        out.append(
            f"coalesce({c}, {c}_pv + ({c}_nv - {c}_pv) / nullif({c}_nu - {c}_pu, 0) * (epoch_us(timestamp) - {c}_pu), {c}_pv, {c}_nv) AS {c}"
        )
    return f"""SELECT event_type, timestamp, {', '.join(out)} FROM (SELECT *, {', '.join(near)} FROM ({source})
        WINDOW back AS (PARTITION BY event_type ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        ahead AS (PARTITION BY event_type ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


HOURLY = filled(HOURLY_GAPS, "load")
HOURLY_INDEXED = f"""SELECT *, count(*) OVER (PARTITION BY event_type) AS n,
    row_number() OVER (PARTITION BY event_type ORDER BY timestamp) - 1 AS idx FROM ({HOURLY})"""

CALENDAR = {
    "year": "year(timestamp)::INTEGER",
    "month": "month(timestamp)::INTEGER",
    "day": "day(timestamp)::INTEGER",
    "hour": "hour(timestamp)::INTEGER",
    "minute": "minute(timestamp)::INTEGER",
    "weekday": "(isodow(timestamp) - 1)::INTEGER",
    "weekday_name": "dayname(timestamp)",
    "is_weekend": "isodow(timestamp) >= 6",
    "date": "timestamp::DATE",
    "season": """CASE WHEN month(timestamp) IN (3, 4, 5) THEN 'Spring' WHEN month(timestamp) IN (6, 7, 8) THEN 'Summer'
        WHEN month(timestamp) IN (9, 10, 11) THEN 'Autumn' ELSE 'Winter' END""",
    "hour_sin": "sin(2 * pi() * (hour(timestamp) + minute(timestamp) / 60.0::DOUBLE) / 24)",
    "hour_cos": "cos(2 * pi() * (hour(timestamp) + minute(timestamp) / 60.0::DOUBLE) / 24)",
    "weekday_sin": "sin(2 * pi() * (isodow(timestamp) - 1) / 7)",
    "weekday_cos": "cos(2 * pi() * (isodow(timestamp) - 1) / 7)",
    "month_sin": "sin(2 * pi() * (month(timestamp) - 1) / 12)",
    "month_cos": "cos(2 * pi() * (month(timestamp) - 1) / 12)",
}
WAVES = [c for c in CALENDAR if c.endswith(("_sin", "_cos"))]


def calendar(source: str) -> str:
    return f"SELECT *, {', '.join(f'{e} AS {c}' for c, e in CALENDAR.items())} FROM ({source})"


# --- cleaning -----------------------------------------------------------------------------------

sql("c3_parse_ratios", """SELECT 'when' AS "column", avg((event_id % 29 <> 0)::INT) AS time_ratio, 0.0::DOUBLE AS number_ratio FROM events
    UNION ALL SELECT 'what', 0.0, avg((event_id % 17 <> 0 AND event_id % 23 <> 0)::INT) FROM events
    UNION ALL SELECT 'kind', 0.0, 0.0""", "time_ratio", "number_ratio")
sql("c3_integer_load", "SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS timestamp, o_orderkey::DOUBLE AS load FROM orders", "load")
sql("c4_short_years", """SELECT CASE event_id % 4 WHEN 0 THEN date_trunc('minute', ts) WHEN 3 THEN NULL ELSE date_trunc('day', ts)::TIMESTAMP END AS timestamp,
    event_id::DOUBLE AS load FROM events""", "load")
sql("c4_coerce_columns", TYPED, "load", "extra")
sql("c5_drop_invalid_times", VALID, "load", "extra")
sql("c6_average_duplicates", UNIQUE, "load", "extra")
sql("c7_quality_report", f"""WITH t AS ({TYPED}), u AS ({UNIQUE})
    SELECT 'raw_rows' AS metric, count(*)::BIGINT AS value FROM t
    UNION ALL SELECT 'invalid_timestamp_rows', count(*) FILTER (timestamp IS NULL) FROM t
    UNION ALL SELECT 'invalid_load_rows', count(*) FILTER (load IS NULL) FROM t
    UNION ALL SELECT 'duplicated_timestamp_rows', (SELECT count(timestamp) FROM t) - (SELECT count(*) FROM u)
    UNION ALL SELECT 'remaining_missing_load', count(*) FILTER (load IS NULL) FROM ({filled(UNIQUE, 'load', 'extra')})
    UNION ALL SELECT 'remaining_missing_features', count(*) FILTER (extra IS NULL) FROM ({filled(UNIQUE, 'load', 'extra')})
    UNION ALL SELECT 'cleaned_rows', count(*) FROM u""")
sql("c8_interpolate_in_time", filled(UNIQUE, "load", "extra"), "load", "extra")
# Final are the times an hour before the latest one, but for those after the last known value before that.
FINAL = f"SELECT * FROM ({UNIQUE}) WHERE timestamp < (SELECT max(timestamp) - INTERVAL 1 HOUR FROM ({VALID}))"
sql("c6_c8_stream_cleaning", f"""WITH f AS MATERIALIZED ({FINAL}), k AS (SELECT event_type, max(timestamp) AS last_known FROM f WHERE load IS NOT NULL GROUP BY ALL)
    SELECT x.event_type, x.timestamp, x.load, f.load IS NULL AS filled FROM ({filled('SELECT * FROM f', 'load')}) AS x JOIN f ON f.event_type = x.event_type AND f.timestamp = x.timestamp
    JOIN k ON k.event_type = x.event_type WHERE x.timestamp <= last_known""", "load")
sql("c8_hourly_spine_filled", HOURLY, "load")
sql("clean_load_data", calendar(filled(UNIQUE, "load", "extra")), "load", "extra", *WAVES)

# --- calendar and selection ---------------------------------------------------------------------

sql("p_calendar_features", calendar(RAW), "load", *WAVES)
sql("p10_year_week", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%W') AS year_week FROM orders")
sql("p11_range_label", """SELECT event_type, strftime(min(ts), '%Y%m%d%H%M') || '_' || strftime(max(ts), '%Y%m%d%H%M') AS label
    FROM events GROUP BY event_type""")


def selection(start: str, end: str, clipped: str, label: str = "strftime(s, '%Y%m%d%H%M') || '_' || strftime(e, '%Y%m%d%H%M')") -> str:
    return f"""WITH b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events), r AS (SELECT {start} AS s, {end} AS e, {clipped} AS c FROM b)
        SELECT (SELECT count(*) FROM events WHERE ts BETWEEN s AND e) AS rows, s AS start, e AS "end", {label} AS label, c AS clipped FROM r"""


sql("t1_recent_range", selection("greatest(hi - INTERVAL 14 DAY, lo)", "hi", "hi - INTERVAL 14 DAY < lo"))
sql("t1_all_range", selection("lo", "hi", "false", "'all_data'"))
sql("t2_clipped_range", selection(
    "greatest(TIMESTAMP '2023-12-01', lo)", "least(TIMESTAMP '2024-01-20 12:00:00', hi)",
    "TIMESTAMP '2023-12-01' < lo OR TIMESTAMP '2024-01-20 12:00:00' > hi"))
CUT_ORDERS = """SELECT o_orderpriority, o_orderdate AS t FROM orders WHERE o_orderdate < CASE o_orderpriority WHEN '1-URGENT' THEN TIMESTAMP '1996-03-01' WHEN '5-LOW' THEN TIMESTAMP '1995-01-05' ELSE TIMESTAMP '2100-01-01' END"""
sql("t1_series_ranges", f"""WITH o AS ({CUT_ORDERS}), b AS (SELECT o_orderpriority, min(t) AS lo, max(t) AS hi FROM o GROUP BY ALL),
    r AS (SELECT o_orderpriority, greatest(hi - INTERVAL 35 DAY, lo) AS start, hi AS "end", hi - INTERVAL 35 DAY < lo AS clipped FROM b)
    SELECT *, CASE WHEN "end" - start < INTERVAL 7 DAY THEN 'shorter than 7 days' END AS problem,
    CASE WHEN "end" - start < INTERVAL 7 DAY THEN 0 ELSE (SELECT count(*) FROM o WHERE o.o_orderpriority = r.o_orderpriority AND t BETWEEN r.start AND r."end") END::BIGINT AS rows FROM r""")
# Lunar new years of the order years, and the other days off by the rules of the time.
SPRINGS = ("1992-02-04", "1993-01-23", "1994-02-10", "1995-01-31", "1996-02-19", "1997-02-07", "1998-01-28", "1999-02-16", "2000-02-05", "2001-01-24", "2002-02-12")
OFF = " UNION ALL ".join([f"SELECT DATE '{d}' + {i}::INTEGER AS d" for d in SPRINGS for i in range(3)] + [f"SELECT DATE '{y}-{d}'" for y in range(1992, 2003)
    for d in ("01-01", "05-01", "10-01", "10-02", *(("10-03",) if y >= 1999 else ()), *(("05-02", "05-03") if y >= 2000 else ()))])
sql("t5_china_holidays", f"SELECT o_orderdate AS timestamp, count(DISTINCT o_orderpriority)::BIGINT AS series FROM orders WHERE o_orderdate::DATE IN (SELECT d FROM ({OFF})) GROUP BY ALL")
sql("c1_normalised_names", "SELECT p_partkey, replace(lower(p_name), ' ', '') AS name FROM part")
sql("t3_filter_by_time", f"SELECT * FROM ({RAW}) WHERE timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-14 23:45:00'", "load")
sql("t4_peak_valley_hours", f"SELECT *, hour(timestamp) BETWEEN 18 AND 21 AS is_peak, hour(timestamp) BETWEEN 2 AND 4 AS is_valley FROM ({RAW})", "load")
DAYS = ", ".join(f"DATE '{d}'" for d in HOLIDAYS)
sql("t5_holiday_flag", f"SELECT *, timestamp::DATE IN ({DAYS}) AS is_holiday FROM ({RAW})", "load")
sql("t8_one_day", f"SELECT * FROM ({RAW}) WHERE timestamp::DATE = DATE '2024-01-17'", "load")

# --- aggregates ---------------------------------------------------------------------------------

BASIC = {
    "count": "count(load)::DOUBLE", "mean": "avg(load)", "median": "quantile_cont(load, 0.5)", "min": "min(load)", "max": "max(load)",
    "std": "stddev_samp(load)", "variance": "var_samp(load)", "coefficient_of_variation": "stddev_samp(load) / nullif(avg(load), 0)",
    "skewness": "skewness(load)", "kurtosis": "kurtosis(load)", "q1": "quantile_cont(load, 0.25)", "q2": "quantile_cont(load, 0.5)",
    "q3": "quantile_cont(load, 0.75)",
}
sql("a1_basic_statistics", " UNION ALL ".join(
    f"SELECT event_type, '{m}' AS metric, {e} AS value FROM ({RAW}) GROUP BY event_type" for m, e in BASIC.items()), "value")
DAILY = f"""SELECT event_type, timestamp::DATE AS date, max(load) AS peak_load, min(load) AS valley_load, avg(load) AS avg_load,
    stddev_samp(load) AS std_load, max(load) - min(load) AS peak_valley_diff, max(load) / nullif(min(load), 0) AS peak_valley_ratio
    FROM ({RAW}) GROUP BY event_type, timestamp::DATE"""
sql("a2_peak_valley", DAILY, "peak_load", "valley_load", "avg_load", "std_load", "peak_valley_diff", "peak_valley_ratio")
sql("a3_monthly_volatility", f"""SELECT o_orderpriority, year(timestamp)::INT AS year, month(timestamp)::INT AS month, avg(load) AS monthly_mean,
    stddev_samp(load) AS monthly_std, var_samp(load) AS monthly_var, stddev_samp(load) / nullif(avg(load), 0) AS monthly_cv
    FROM ({ORDERS}) GROUP BY ALL""", "monthly_mean", "monthly_std", "monthly_var", "monthly_cv")


def described(name: str, source: str, *groups: str) -> None:
    sql(name, f"""SELECT {', '.join(groups)}, count(load) AS count, avg(load) AS mean, stddev_samp(load) AS std, min(load) AS min,
        quantile_cont(load, 0.25) AS "25%", quantile_cont(load, 0.5) AS "50%", quantile_cont(load, 0.75) AS "75%", max(load) AS max
        FROM ({source}) GROUP BY ALL""", "mean", "std", "min", "25%", "50%", "75%", "max")


described("a4_yearly_statistics", ORDERS, "o_orderpriority", "year(timestamp)::INT AS year")
described("a5_monthly_statistics", ORDERS, "o_orderpriority", "year(timestamp)::INT AS year", "month(timestamp)::INT AS month")
described("a6_weekly_statistics", ORDERS, "o_orderpriority", "strftime(timestamp, '%Y-%W') AS year_week")
described("a7_daily_statistics", RAW, "event_type", "timestamp::DATE AS date")
described("a8_hourly_statistics", RAW, "event_type", "hour(timestamp)::INT AS hour")
sql("a9_month_profile", f"""SELECT p.o_orderpriority, m.month, avg(o.load) AS mean_load
    FROM (SELECT DISTINCT o_orderpriority FROM orders) AS p, (SELECT unnest(range(1, 13))::INT AS month) AS m
    LEFT JOIN ({ORDERS}) AS o ON o.o_orderpriority = p.o_orderpriority AND month(o.timestamp) = m.month GROUP BY ALL""", "mean_load")


def boxed(source: str, groups: str, value: str = "load") -> str:
    return f"""WITH d AS ({source}), q AS (SELECT {groups}, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
        quantile_cont({value}, 0.75) AS q3 FROM d GROUP BY ALL),
        f AS (SELECT d.*, q1, median, q3, {value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM d JOIN q USING ({groups}))
        SELECT {groups}, q1, median, q3, least(min({value}) FILTER (inside), q1) AS whisker_low,
        greatest(max({value}) FILTER (inside), q3) AS whisker_high, count(*) FILTER (NOT inside) AS outliers FROM f GROUP BY {groups}, q1, median, q3"""


BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")
sql("a10_box_statistics", boxed(f"SELECT *, month(timestamp)::INT AS month FROM ({ORDERS})", "o_orderpriority, month"), *BOX)
sql("a10_event_box_statistics", boxed(RAW, "event_type"), *BOX)
sql("a10_box_outliers", f"""WITH q AS (SELECT event_type, quantile_cont(load, 0.25) AS q1, quantile_cont(load, 0.75) AS q3 FROM ({RAW}) GROUP BY ALL)
    SELECT d.* FROM ({RAW}) AS d JOIN q USING (event_type) WHERE load NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""", "load")
sql("a11_weekpart_profile", f"""SELECT event_type, isodow(timestamp) >= 6 AS is_weekend, hour(timestamp)::INT AS hour, avg(load) AS mean_load
    FROM ({RAW}) GROUP BY ALL""", "mean_load")
sql("a12_season_profile", f"""SELECT o_orderpriority, season, hour, avg(load) AS mean_load,
    list_position(['Spring', 'Summer', 'Autumn', 'Winter'], season)::INT AS season_order FROM ({calendar(ORDERS)})
    GROUP BY o_orderpriority, season, hour""", "mean_load")

DIFFS = f"""SELECT event_type, timestamp, load - l1 AS ramp, (load - l1) - (l1 - l2) AS diff2 FROM (
    SELECT *, lag(load, 1) OVER w AS l1, lag(load, 2) OVER w AS l2 FROM ({RAW}) WINDOW w AS (PARTITION BY event_type ORDER BY timestamp))"""


def counted(name: str, source: str, value: str, bins: int) -> None:
    sql(name, f"""WITH d AS (SELECT event_type, {value} AS v FROM ({source}) WHERE {value} IS NOT NULL),
        s AS (SELECT event_type, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
            CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM d GROUP BY event_type),
        g AS (SELECT d.*, lo, hi, (hi - lo) / {bins} AS w, least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) AS g FROM d JOIN s USING (event_type)),
        p AS (SELECT event_type, (g + CASE WHEN v < lo + g * w THEN -1 WHEN g < {bins - 1} AND v >= lo + (g + 1) * w THEN 1 ELSE 0 END)::INT AS bin FROM g),
        c AS (SELECT event_type, bin, count(*) AS c FROM p GROUP BY ALL),
        spine AS (SELECT s.*, unnest(range({bins}))::INT AS bin FROM s)
        SELECT spine.event_type, spine.bin, lo + spine.bin * ((hi - lo) / {bins}) AS "left",
        CASE WHEN spine.bin = {bins - 1} THEN hi ELSE lo + (spine.bin + 1) * ((hi - lo) / {bins}) END AS "right", coalesce(c, 0) AS count
        FROM spine LEFT JOIN c ON c.event_type = spine.event_type AND c.bin = spine.bin""", "left", "right")


counted("a13_load_histogram", RAW, "load", 50)
counted("a13_ramp_histogram", DIFFS, "ramp", 60)
counted("a13_diff2_histogram", DIFFS, "diff2", 60)
sql("a14_load_density", f"""WITH s AS (SELECT event_type, min(load) AS lo, max(load) AS hi, stddev_samp(load) * pow(count(*), -0.2) AS h,
        (max(load) - min(load)) / 199 AS step FROM ({RAW}) GROUP BY event_type),
    g AS (SELECT *, unnest(range(200))::INT AS point FROM s)
    SELECT g.event_type, point, lo + point * step AS x,
    sum(exp(-0.5 * pow((lo + point * step - d.load) / h, 2))) * ((hi - lo) / 50) / (h * sqrt(2 * pi())) AS density
    FROM g JOIN ({RAW}) AS d ON d.event_type = g.event_type GROUP BY g.event_type, point, lo, hi, h, step""", "x", "density")
sql("a15_empirical_cdf", f"""SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY load) AS rank, load AS value,
    row_number() OVER (PARTITION BY event_type ORDER BY load) / count(*) OVER (PARTITION BY event_type) AS ecdf FROM ({RAW})""", "value", "ecdf")

FEATURES = {"load(t)": "load", "load(t-1)": "l1", "load(t-24)": "l24", "load(t-168)": "l168", "hour": "hour(timestamp)", "weekday": "isodow(timestamp) - 1"}
LAGGED = f"""SELECT *, lag(load, 1) OVER w AS l1, lag(load, 24) OVER w AS l24, lag(load, 168) OVER w AS l168 FROM ({INDEXED})
    WINDOW w AS (PARTITION BY event_type ORDER BY timestamp)"""
sql("a16_correlation_matrix", " UNION ALL ".join(
    f"SELECT event_type, '{a}' AS feature, '{b}' AS other, corr({x}, {y}) AS corr FROM ({LAGGED}) WHERE l168 IS NOT NULL GROUP BY event_type"
    for a, x in FEATURES.items() for b, y in FEATURES.items()), "corr")
WEATHER = f"""SELECT kind AS event_type, timestamp, max(load) FILTER (event_type = kind) AS load, max(load) FILTER (event_type = 'view') AS temperature,
    max(load) FILTER (event_type = 'signup') AS humidity, max(load) FILTER (event_type = 'purchase') AS rainfall FROM ({HOUR_SUMS}), (SELECT unnest(['click', 'error']) AS kind) GROUP BY kind, timestamp"""
sql("a17_weather_correlation", " UNION ALL ".join(
    f"""SELECT event_type, '{c}' AS feature, CASE WHEN NOT isnan(corr(load, {c})) THEN corr(load, {c}) END AS corr FROM ({WEATHER})
    WHERE load IS NOT NULL AND temperature IS NOT NULL AND humidity IS NOT NULL AND rainfall IS NOT NULL GROUP BY event_type"""
    for c in ("temperature", "humidity", "rainfall")), "corr")
HOURS = f"""SELECT event_type, CASE WHEN quantile_cont(step, 0.5) > 0 THEN quantile_cont(step, 0.5) / 3600 ELSE 1.0 END AS sampling_hours FROM (
    SELECT event_type, (epoch_us(timestamp) - lag(epoch_us(timestamp)) OVER (PARTITION BY event_type ORDER BY timestamp)) / 1e6 AS step
    FROM ({RAW})) GROUP BY event_type"""
sql("a18_sampling_hours", HOURS, "sampling_hours")

# --- sequences ----------------------------------------------------------------------------------

sql("position_index", INDEXED, "load")
sql("w1_w2_differences", DIFFS, "ramp", "diff2")
sql("w3_lag_pairs", " UNION ALL ".join(
    f"SELECT event_type, idx, {k} AS lag, l{k} AS lagged, load AS current FROM ({LAGGED}) WHERE l{k} IS NOT NULL" for k in (1, 24, 168)),
    "lagged", "current")
ACF = f"""WITH d AS (SELECT event_type, idx, n, load - avg(load) OVER (PARTITION BY event_type) AS d FROM ({INDEXED})),
    z AS (SELECT event_type, n, sum(d * d) AS c0 FROM d GROUP BY ALL),
    k AS (SELECT event_type, n, c0, unnest(range(1, greatest(1, least(100, n // 2 - 1)) + 1))::INT AS lag FROM z),
    a AS (SELECT k.event_type, k.n, k.lag, coalesce(sum(d.d * e.d), 0) / any_value(c0) AS acf FROM k JOIN d ON d.event_type = k.event_type
        JOIN d AS e ON e.event_type = d.event_type AND e.idx = d.idx - k.lag GROUP BY k.event_type, k.n, k.lag)"""
BAND = 1.9599639845400545
sql("w4_autocorrelation", f"""{ACF} SELECT event_type, lag, acf, {BAND} * sqrt((1 + 2 * coalesce(sum(acf * acf) OVER (PARTITION BY event_type
    ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) AS band FROM a""", "acf", "band")
sql("w5_partial_autocorrelation", f"""{ACF.replace('WITH d', 'WITH RECURSIVE d', 1)},
    r AS (SELECT event_type, any_value(n) AS n, list(acf ORDER BY lag) AS r FROM a GROUP BY event_type),
    lev AS (SELECT event_type, n, r, 1 AS k, r[1] AS p, [r[1]] AS phi, 1 - r[1] * r[1] AS v FROM r
        UNION ALL SELECT event_type, n, r, k + 1, p2,
            list_append(list_transform(range(1, k + 1), lambda j: phi[j] - p2 * phi[k + 1 - j]), p2), v * (1 - p2 * p2)
        FROM (SELECT *, (r[k + 1] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 1 - j]))) / v AS p2 FROM lev WHERE k < len(r)))
    SELECT event_type, k::INT AS lag, p AS pacf, {BAND} / sqrt(n) AS band FROM lev""", "pacf", "band")
sql("w6_rolling_mean", f"""SELECT event_type, timestamp, avg(load) OVER (PARTITION BY event_type ORDER BY timestamp ROWS BETWEEN 24 PRECEDING AND 23 FOLLOWING) AS smooth
    FROM ({RAW})""", "smooth")


def transformed(source: str, groups: str, value: str = "load") -> str:
    """Amplitudes by direct summation; the phase index is reduced before it becomes an angle."""
    return f"""SELECT {groups}, k, n, sqrt(pow(sum(x * cos(2 * pi() * ((k * idx) % n) / n)), 2) + pow(sum(x * sin(2 * pi() * ((k * idx) % n) / n)), 2)) AS amplitude
        FROM (SELECT *, {value} - avg({value}) OVER (PARTITION BY {groups}) AS x FROM ({source})), (SELECT unnest(range(1, (SELECT max(n) FROM ({source})))) AS k)
        WHERE k <= (n - 1) // 2 GROUP BY {groups}, k, n"""


sql("w7_spectrum", f"SELECT event_type, k AS harmonic, k / n AS frequency, amplitude FROM ({transformed(HOURLY_INDEXED, 'event_type')})", "frequency", "amplitude")
sql("w7_event_spectrum", f"""SELECT event_type, k AS harmonic, k / (n * sampling_hours) AS frequency, amplitude FROM ({transformed(INDEXED, 'event_type')})
    JOIN ({HOURS}) USING (event_type)""", "frequency", "amplitude")
GRID = "floor(load * 1000 + 0.47)::BIGINT::VARCHAR"
sql("w8_sliding_windows", f"""SELECT event_type, origin_idx, x, y FROM (SELECT event_type, idx AS origin_idx, n,
    string_agg({GRID}, ' ') OVER (o ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS x,
    string_agg({GRID}, ' ') OVER (o ROWS BETWEEN 1 FOLLOWING AND 6 FOLLOWING) AS y
    FROM ({INDEXED}) WINDOW o AS (PARTITION BY event_type ORDER BY idx)) WHERE origin_idx >= 23 AND origin_idx < n - 6""")
SPLIT = f"SELECT *, greatest(floor(n * 0.8::DOUBLE), 72)::BIGINT AS split_idx FROM ({INDEXED})"
sql("w9_split", f"""SELECT event_type, n, split_idx, count(*) FILTER (idx < split_idx) AS train_rows, count(*) FILTER (idx >= split_idx - 48) AS context_rows
    FROM ({SPLIT}) GROUP BY event_type, n, split_idx""")
SCALE = f"SELECT event_type, avg(load) AS mean_load, stddev_pop(load) + 1e-8 AS scale_load FROM ({SPLIT}) WHERE idx < split_idx GROUP BY event_type"
sql("a27_scaling_table", SCALE, "mean_load", "scale_load")
sql("w10_standardise", f"SELECT event_type, timestamp, (load - mean_load) / scale_load AS z FROM ({RAW}) JOIN ({SCALE}) USING (event_type)", "z")
sql("a28_impute_means", f"SELECT event_type, timestamp, coalesce(load, avg(load) OVER (PARTITION BY event_type), 0) AS load FROM ({HOURLY_GAPS})", "load")

# --- decomposition ------------------------------------------------------------------------------

WINDOWS = (4, 16, 48, 96, 192, 336, 672)


def cascade(source: str, keep: int = 8) -> str:
    """imf_1… by chained moving averages; series no longer than a window stop there."""
    steps, previous = [f"s0 AS (SELECT *, load AS r0 FROM ({source}))"], "s0"
    used = WINDOWS[:keep]
    for j, w in enumerate(used, start=1):
        steps.append(f"""s{j} AS (SELECT *, avg(r{j - 1}) OVER (PARTITION BY event_type ORDER BY idx
            ROWS BETWEEN {w // 2} PRECEDING AND {w - 1 - w // 2} FOLLOWING) AS r{j} FROM {previous})""")
        previous = f"s{j}"
    parts = []
    for j in range(1, keep + 1):
        reached = f"n > {WINDOWS[j - 2]}" if j > 1 else "true"
        if j <= len(used):
            parts.append(f"CASE WHEN n > {WINDOWS[j - 1]} THEN r{j - 1} - r{j} WHEN {reached} THEN r{j - 1} END AS imf_{j}")
        else:
            parts.append(f"CASE WHEN {reached} THEN r{j - 1} END AS imf_{j}")
    return f"WITH {', '.join(steps)} SELECT event_type, timestamp, load, idx, n, {', '.join(parts)} FROM {previous}"


def components(source: str, keep: int, rest: str = "residual") -> str:
    total = " + ".join(f"coalesce(imf_{j}, 0)" for j in range(1, keep + 1))
    return f"SELECT *, load - ({total}) AS {rest} FROM ({cascade(source, keep)})"


IMF = [f"imf_{j}" for j in range(1, 9)]
sql("d1_decompose", f"SELECT * EXCLUDE (n, idx) FROM ({cascade(INDEXED)})", "load", *IMF)
GAPS = """SELECT event_type, ts AS timestamp, CASE WHEN event_id % 17 <> 0 THEN value END AS load, count(*) OVER (PARTITION BY event_type) AS n,
    row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1 AS idx FROM events"""
sql("d1_sifting_extrema", f"""WITH x AS (SELECT event_type, idx, floor(load) AS v FROM ({INDEXED})),
    r AS (SELECT *, sum(new::INT) OVER (PARTITION BY event_type ORDER BY idx) AS run FROM (SELECT *, coalesce(v <> lag(v) OVER (PARTITION BY event_type ORDER BY idx), true) AS new FROM x)),
    g AS (SELECT event_type, run, min(idx) AS a, max(idx) AS b, any_value(v) AS value FROM r GROUP BY ALL),
    n AS (SELECT *, lag(value) OVER o AS l, lead(value) OVER o AS u FROM g WINDOW o AS (PARTITION BY event_type ORDER BY a))
    SELECT event_type, (value > l)::INT AS kind, a + (b - a) // 2 AS at, value FROM n WHERE (value > l AND value > u) OR (value < l AND value < u)""", "value")
sql("d1_decompose_with_gaps", f"SELECT * EXCLUDE (n, idx) FROM ({cascade(GAPS)})", "load", *IMF)
sql("d2_component_frame", f"SELECT * EXCLUDE (n, idx) FROM ({components(INDEXED, 6)})", "load", *IMF[:6], "residual")
sql("d3_bounded_component_frame", f"SELECT * EXCLUDE (n, idx) FROM ({components(INDEXED, 3, 'remainder_component')})", "load", *IMF[:3], "remainder_component")


def long_form(source: str, names: list[str], keep: str) -> str:
    return " UNION ALL ".join(f"SELECT {keep}, '{c}' AS component, {c} AS value FROM ({source}) WHERE {c} IS NOT NULL" for c in names)


HOURLY_PARTS = f"WITH parts AS MATERIALIZED ({cascade(HOURLY_INDEXED)}) {long_form('SELECT * FROM parts', IMF, 'event_type, idx, n')}"
sql("d4_component_classes", f"""WITH long AS MATERIALIZED ({HOURLY_PARTS}),
    t AS (SELECT event_type, component, n, avg(value) AS m, sum(value * value) AS energy FROM long GROUP BY ALL),
    amp AS (SELECT event_type, component, k, n, sqrt(pow(sum(x * cos(2 * pi() * ((k * idx) % n) / n)), 2) + pow(sum(x * sin(2 * pi() * ((k * idx) % n) / n)), 2)) AS a
        FROM (SELECT long.*, value - m AS x FROM long JOIN t USING (event_type, component)), (SELECT unnest(range(1, 400)) AS k)
        WHERE k <= (n - 1) // 2 GROUP BY ALL),
    top AS (SELECT event_type, component, arg_max(k / n, a) AS f FROM amp GROUP BY ALL)
    SELECT event_type, right(component, 1)::INT AS "index", component, coalesce(f, 0) AS dominant_freq, energy,
    CASE WHEN coalesce(f, 0) > 0.1 THEN 'high' WHEN coalesce(f, 0) > 0.02 THEN 'mid' ELSE 'low' END AS category
    FROM t LEFT JOIN top USING (event_type, component)""", "dominant_freq", "energy")
sql("d5_reconstruct_bands", f"""SELECT event_type, timestamp, load, imf_1 + imf_2 AS high, imf_3 + imf_4 AS mid, imf_5 AS low, imf_6 AS trend
    FROM ({components(INDEXED, 6)})""", "load", "high", "mid", "low", "trend")
sql("d6_components_long", f"""WITH parts AS MATERIALIZED ({components(INDEXED, 6)})
    {long_form('SELECT * FROM parts', IMF[:6], 'event_type, timestamp')}""", "value")
sql("a25_a26_component_energy", f"""WITH parts AS MATERIALIZED ({cascade(INDEXED)}), long AS ({long_form('SELECT * FROM parts', IMF, 'event_type')}),
    e AS (SELECT event_type, component, sum(value * value) AS energy, stddev_pop(value) AS volatility FROM long GROUP BY ALL)
    SELECT event_type, right(component, 1)::INT AS "index", component, energy, volatility,
    energy / sum(energy) OVER (PARTITION BY event_type) AS energy_ratio FROM e""", "energy", "volatility", "energy_ratio")

# --- forecasting --------------------------------------------------------------------------------

def predicted(source: str, look: int, ahead: int, names: list[str]) -> str:
    """`parts`, `long`, `comp` and `fused`: components, averages, the two plain models' predictions, and their sums.

    Period and moving average have as many rows as the horizon.
    """
    return f"""parts AS MATERIALIZED (SELECT *, greatest(floor(n * 0.8::DOUBLE), {look + ahead})::BIGINT AS split_idx FROM ({source})),
    long AS MATERIALIZED (SELECT *, avg(value) OVER (PARTITION BY event_type, component ORDER BY idx ROWS BETWEEN {ahead - 1} PRECEDING AND CURRENT ROW) AS ma
        FROM ({long_form('SELECT * FROM parts', names, 'event_type, idx, n, split_idx')})),
    comp AS MATERIALIZED (
        SELECT a.event_type, a.component, 'seasonal_naive' AS model, a.idx, a.value AS actual, b.value AS predicted
        FROM long AS a JOIN long AS b ON b.event_type = a.event_type AND b.component = a.component AND b.idx = a.idx - {ahead} WHERE a.idx >= a.split_idx
        UNION ALL SELECT event_type, component, 'moving_average', idx, value, predicted FROM (
            SELECT *, avg(CASE WHEN idx BETWEEN split_idx - 1 AND n - {ahead + 1} THEN ma END) OVER (PARTITION BY event_type, component ORDER BY idx
                ROWS BETWEEN {ahead} PRECEDING AND 1 PRECEDING) AS predicted FROM long) WHERE idx >= split_idx),
    fused AS (SELECT event_type, model, idx, sum(actual) AS actual_load, sum(predicted) AS predicted_load FROM comp GROUP BY ALL)"""


NUMBERS = tuple(c for c in CALENDAR if c not in ("weekday_name", "date", "season"))


def scaled(names: list[str], exog: tuple[str, ...] = ()) -> str:
    """`z`: every component, and the inputs of its row, under the mean and deviation of the training rows."""
    def unit(c: str, m: str, sd: str) -> str:
        return f"({c} - {m}) / CASE WHEN {sd} > 0 THEN {sd} + 1e-8 ELSE 1 END"

    inputs = [f"({CALENDAR[c]})::INT::DOUBLE AS x_{c}" if c == "is_weekend" else f"({CALENDAR[c]})::DOUBLE AS x_{c}" for c in exog]
    moments = [f"avg(x_{c}) AS m_{c}, stddev_pop(x_{c}) AS s_{c}" for c in exog]
    rows = f"SELECT event_type, idx, split_idx{''.join(', ' + x for x in inputs)} FROM parts"
    return f"""sized AS MATERIALIZED (SELECT event_type, component, avg(value) AS m, stddev_pop(value) AS sd FROM long WHERE idx < split_idx GROUP BY ALL),
    inputs AS MATERIALIZED ({rows}), ranged AS (SELECT event_type{''.join(', ' + x for x in moments)} FROM inputs WHERE idx < split_idx GROUP BY event_type),
    z AS MATERIALIZED (SELECT l.event_type, l.component, l.idx, l.n, l.split_idx, l.value, m, CASE WHEN sd > 0 THEN sd + 1e-8 ELSE 1 END AS sd, {unit('value', 'm', 'sd')} AS z
        {''.join(f', {unit(f"x_{c}", f"m_{c}", f"s_{c}")} AS {c}' for c in exog)}
        FROM long AS l JOIN sized USING (event_type, component) JOIN inputs AS i ON i.event_type = l.event_type AND i.idx = l.idx JOIN ranged AS r ON r.event_type = l.event_type)"""


def windowed(look: int, ahead: int) -> str:
    """`w`: origins of training and test windows with the season before and the truth after them."""
    return f"""w AS MATERIALIZED (SELECT * FROM (SELECT *, coalesce(lag(z) OVER o, z) AS before, avg(z) OVER (o ROWS BETWEEN {ahead - 1} PRECEDING AND CURRENT ROW) AS recent,
        list(z) OVER (o ROWS BETWEEN {ahead - 1} PRECEDING AND CURRENT ROW) AS ps, list(z) OVER (o ROWS BETWEEN 1 FOLLOWING AND {ahead} FOLLOWING) AS ys,
        idx <= split_idx - 1 - {ahead} AS train FROM z WINDOW o AS (PARTITION BY event_type, component ORDER BY idx))
        WHERE idx >= {look - 1} AND (train OR idx BETWEEN split_idx - 1 AND n - 1 - {ahead}))"""


def solved(ahead: int, exog: tuple[str, ...] = ()) -> str:
    """`linear`: predictions of the linear model; its normal equations are added up by window and solved by elimination, a column at a time."""
    fixed = ["1", "z", "before", "recent", *exog]
    n, k = len(fixed) + 2, len(fixed)
    steps = [j / ahead for j in range(1, ahead + 1)]
    h1, h2 = sum(steps), sum(x * x for x in steps)
    hs = f"[{', '.join(map(repr, steps))}]"
    dot = lambda a, b: f"list_dot_product({a}, {b})"
    pairs = {}
    for i, a in enumerate(fixed):
        for j, b in enumerate(fixed):
            pairs[i, j] = f"{ahead} * sum({a} * {b})"
        pairs[i, k] = pairs[k, i] = f"sum({a} * list_sum(ps))"
        pairs[i, k + 1] = pairs[k + 1, i] = f"{h1!r} * sum({a})"
        pairs[i, n] = f"sum({a} * list_sum(ys))"
    pairs |= {(k, k): f"sum({dot('ps', 'ps')})", (k, k + 1): f"sum({dot('ps', hs)})", (k + 1, k): f"sum({dot('ps', hs)})", (k + 1, k + 1): f"{h2!r} * count(*)", (k, n): f"sum({dot('ps', 'ys')})", (k + 1, n): f"sum({dot('ys', hs)})"}
    ridge = "1e-6 * greatest(a_0_0, 1.0)"
    parts = [f"e AS MATERIALIZED (SELECT event_type, component, {', '.join(f'{pairs[i, j]} AS a_{i}_{j}' for i in range(n) for j in range(n + 1))} FROM w WHERE train GROUP BY event_type, component)"]
    parts.append(f"e0 AS MATERIALIZED (SELECT event_type, component, {', '.join((f'a_{i}_{j} + {ridge}' if i == j else f'a_{i}_{j}') + f' AS a_{i}_{j}' for i in range(n) for j in range(n + 1))} FROM e)")
    for c in range(n):
        cells = [f"a_{c}_{j} / a_{c}_{c} AS a_{c}_{j}" if i == c else f"a_{i}_{j} - a_{i}_{c} * (a_{c}_{j} / a_{c}_{c}) AS a_{i}_{j}" for i in range(n) for j in range(c + 1, n + 1)]
        parts.append(f"e{c + 1} AS MATERIALIZED (SELECT event_type, component, {', '.join(cells)} FROM e{c})")
    level = " + ".join(f"a_{i}_{n} * {x}" for i, x in enumerate(fixed))
    parts.append(f"""linear AS MATERIALIZED (SELECT event_type, component, 'linear' AS model, idx, max(actual) AS actual, avg(predicted) AS predicted FROM (
        SELECT event_type, component, idx + unnest(range(1, {ahead + 1})) AS idx, unnest(ys) * sd + m AS actual,
        (({level}) + a_{k}_{n} * unnest(ps) + a_{k + 1}_{n} * unnest({hs})) * sd + m AS predicted FROM w JOIN e{n} USING (event_type, component) WHERE NOT train) GROUP BY event_type, component, idx)""")
    return ",\n    ".join(parts)


def boosted(ahead: int, rounds: int, depth: int, bins: int = 32, rate: float = 0.1, least: int = 20) -> str:
    """`gbt`: predictions of the trees without further inputs, grown level by level from sums of residuals in steps of 2**-20."""
    inputs = ["z", "before", "recent", "p", "h"]  # numbers 1 to 5; number 0 is constant
    edge = ", ".join(f"min({x}) AS lo_{x}, max({x}) AS hi_{x}" for x in inputs)
    place = lambda x: f"CASE WHEN hi_{x} > lo_{x} THEN least(greatest(floor(({x} - lo_{x}) / (hi_{x} - lo_{x}) * {bins - 1} + 0.47), 0), {bins - 1})::INT ELSE 0 END"
    parts = [f"""st AS MATERIALIZED (SELECT event_type, component, m, sd, train, idx + unnest(range(1, {ahead + 1})) AS target, z, before, recent, unnest(ps) AS p, unnest(ys) AS y, unnest(range(1, {ahead + 1})) / {ahead}::DOUBLE AS h FROM w)""",
        f"ed AS MATERIALIZED (SELECT component, {edge} FROM st WHERE train GROUP BY component)",
        f"t0 AS MATERIALIZED (SELECT event_type, component, m, sd, train, target, y, 0.0::DOUBLE AS f, 1 AS node, {', '.join(f'{place(x)} AS b{i + 1}' for i, x in enumerate(inputs))} FROM st JOIN ed USING (component))"]
    previous = "t0"
    for r in range(rounds):
        name = f"r{r}"
        parts.append(f"{name} AS MATERIALIZED (SELECT * REPLACE (1 AS node), floor((y - f) * 1048576 + 0.5)::BIGINT AS g FROM {previous})")
        for level in range(depth):
            cells = ", ".join(f"{{'f': {i}, 'b': b{i}}}" for i in range(1, 6))
            parts.append(f"""{name}h{level} AS (SELECT component, node, c.f AS feature, c.b AS cut, sum(g) AS s, count(*) AS k
                FROM (SELECT component, node, g, unnest([{cells}]) AS c FROM {name} WHERE train AND node >= {1 << level}) GROUP BY ALL)""")
            parts.append(f"""{name}c{level} AS (SELECT component, node, feature, cut, sum(s) OVER o AS gl, sum(k) OVER o AS nl, sum(s) OVER (PARTITION BY component, node, feature) AS gt, sum(k) OVER (PARTITION BY component, node, feature) AS nt
                FROM {name}h{level} WINDOW o AS (PARTITION BY component, node, feature ORDER BY cut))""")
            parts.append(f"""{name}b{level} AS MATERIALIZED (SELECT * FROM (SELECT component, node, feature, cut, gl::DOUBLE * gl::DOUBLE / nl + (gt - gl)::DOUBLE * (gt - gl)::DOUBLE / (nt - nl) - gt::DOUBLE * gt::DOUBLE / nt AS gain
                FROM {name}c{level} WHERE nl >= {least} AND nt - nl >= {least}) WHERE gain > 1e-6 * 1048576 * 1048576 QUALIFY row_number() OVER (PARTITION BY component, node ORDER BY gain DESC, feature, cut) = 1)""")
            value = "CASE feature " + " ".join(f"WHEN {i} THEN b{i}" for i in range(1, 6)) + " END"
            parts.append(f"""{name}n{level} AS MATERIALIZED (SELECT t.* REPLACE (CASE WHEN feature IS NULL THEN t.node ELSE 2 * t.node + ({value} > cut)::INT END AS node) FROM {name} AS t LEFT JOIN {name}b{level} AS x ON x.component = t.component AND x.node = t.node)""")
            name = f"{name}n{level}"
        parts.append(f"""v{r} AS MATERIALIZED (SELECT component, node, sum(g)::DOUBLE / count(*) / 1048576 * {rate if r else 1.0!r} AS v FROM {name} WHERE train GROUP BY ALL)""")
        parts.append(f"t{r + 1} AS MATERIALIZED (SELECT t.* EXCLUDE (g) REPLACE (f + v AS f) FROM {name} AS t JOIN v{r} USING (component, node))")
        previous = f"t{r + 1}"
    parts.append(f"""gbt AS MATERIALIZED (SELECT event_type, component, 'gbt' AS model, target AS idx, max(y * sd + m) AS actual, avg(f * sd + m) AS predicted FROM {previous} WHERE NOT train GROUP BY event_type, component, target)""")
    return ",\n    ".join(parts)


def with_learned(plain: str, learned: str, *models: str) -> str:
    """The statements of the plain models, with learned ones in `comp` and `fused`."""
    first, rest = plain.split("    comp AS MATERIALIZED (", 1)
    both, fused_ = rest.rsplit("    fused AS ", 1)
    more = "".join(f" UNION ALL SELECT event_type, component, model, idx, actual, predicted FROM {m}" for m in models)
    return f"{first}    {learned},\n    comp0 AS MATERIALIZED ({both}    comp AS MATERIALIZED (SELECT * FROM comp0{more}),\n    fused AS {fused_}"


# Lookback 48, horizon 24, three components, all four models.
L, H, ALL_PARTS = 48, 24, ["imf_1", "imf_2", "imf_3", "residual"]
MODELS = ["seasonal_naive", "moving_average", "linear", "gbt"]
PLAIN = predicted(components(HOURLY_INDEXED, 3), L, H, ALL_PARTS)
PREDICTED = with_learned(PLAIN, ",\n    ".join([scaled(ALL_PARTS), windowed(L, H), solved(H), boosted(H, SHORT.tree_rounds, SHORT.tree_depth)]), "linear", "gbt")
# The defaults on raw events, with all inputs; the trees at this size are too slow here.
EVENT_PARTS = [*IMF[:6], "residual"]
EVENT_PLAIN = predicted(components(INDEXED, 6), 672, 96, EVENT_PARTS)
EVENT_PREDICTED = with_learned(EVENT_PLAIN, ",\n    ".join([scaled(EVENT_PARTS, NUMBERS), windowed(672, 96), solved(96, NUMBERS)]), "linear")


def scores(groups: str, source: str, y: str = "actual_load", p: str = "predicted_load", extra: str = "") -> str:
    return f"""SELECT {groups}, avg(abs({y} - {p})) AS MAE, sqrt(avg(pow({y} - {p}, 2))) AS RMSE,
        100 * avg(CASE WHEN abs({y}) >= 1e-8 THEN abs(({y} - {p}) / {y}) END) AS MAPE,
        1 - sum(pow({y} - {p}, 2)) / nullif(var_pop({y}) * count(*), 0) AS R2{extra} FROM {source} GROUP BY {groups}"""


METRICS = ("MAE", "RMSE", "MAPE", "R2")
ONE = f"""{PLAIN}, one AS (SELECT f.event_type, f.idx, p.timestamp, actual_load, predicted_load, actual_load - predicted_load AS error
    FROM fused AS f JOIN parts AS p ON p.event_type = f.event_type AND p.idx = f.idx WHERE model = 'seasonal_naive')"""
ERRORS = f"{ONE}, err AS (SELECT * REPLACE (predicted_load - actual_load AS error) FROM one)"
FORECAST = ("actual_load", "predicted_load", "error")

sql("f1_scaled_features", f"""WITH {EVENT_PLAIN}, {scaled(EVENT_PARTS, NUMBERS)} SELECT event_type, idx, component, z, {', '.join(NUMBERS)} FROM z""", "z", *NUMBERS)
sql("w11_f2ab_component_forecasts", f"WITH {PREDICTED} SELECT * FROM comp", "actual", "predicted")
COMPONENT_SCORES = scores("event_type, component, model", "comp", "actual", "predicted")
sql("f4_component_metrics", f"WITH {PREDICTED} {COMPONENT_SCORES}", *METRICS)
sql("f4_f8_single_forecast", f"WITH {ONE} SELECT * FROM one", *FORECAST)
sql("a19_forecast_metrics", f"""WITH {ONE}, m AS ({scores('event_type', 'one')}) """ + " UNION ALL ".join(
    f"SELECT event_type, '{m}' AS metric, {m} AS value FROM m" for m in METRICS), "value")
sql("a20_error_metrics", f"""WITH {PLAIN}, m AS ({scores('event_type', "(SELECT * FROM fused WHERE model = 'moving_average')")})
    SELECT event_type, RMSE, MAE, MAPE FROM m""", "RMSE", "MAE", "MAPE")
CHOSEN = f"""{PREDICTED}, sc AS ({COMPONENT_SCORES}), chosen AS (SELECT event_type, component, model AS selected_model, MAE, RMSE, MAPE, R2 FROM sc
    QUALIFY row_number() OVER (PARTITION BY event_type, component ORDER BY RMSE, MAE, MAPE, list_position({MODELS}, model)) = 1)"""
sql("f5_model_selection", f"WITH {CHOSEN} SELECT * FROM chosen", *METRICS)
HYBRID = f"""{CHOSEN}, hybrid AS (SELECT c.event_type, c.idx, sum(actual) AS actual_load, sum(predicted) AS predicted_load
    FROM comp AS c JOIN chosen AS x ON x.event_type = c.event_type AND x.component = c.component AND x.selected_model = c.model GROUP BY c.event_type, c.idx)"""
sql("f5_hybrid_forecast", f"""WITH {HYBRID} SELECT h.event_type, h.idx, p.timestamp, actual_load, predicted_load, actual_load - predicted_load AS error
    FROM hybrid AS h JOIN parts AS p ON p.event_type = h.event_type AND p.idx = h.idx""", *FORECAST)
sql("f6_best_method", f"""WITH {HYBRID}, every AS (SELECT event_type, model AS method, actual_load, predicted_load FROM fused
    UNION ALL SELECT event_type, 'hybrid', actual_load, predicted_load FROM hybrid), m AS ({scores('event_type, method', 'every')})
    SELECT event_type, method AS best_method, MAE, RMSE, MAPE, R2 FROM m QUALIFY row_number() OVER (PARTITION BY event_type
    ORDER BY round(RMSE, 8), round(MAE, 8), round(MAPE, 8), list_position({[*MODELS, 'hybrid']}, method)) = 1""", *METRICS)
COMPARED = f"{PREDICTED}, m AS ({scores('event_type, model', '(SELECT * REPLACE (upper(model) AS model) FROM fused)')})"
sql("f9_model_comparison", f"WITH {COMPARED} SELECT event_type, model, RMSE, MAE, MAPE FROM m ORDER BY event_type, RMSE", "RMSE", "MAE", "MAPE")
sql("f9_comparison_long", f"WITH {COMPARED} " + " UNION ALL ".join(
    f"SELECT event_type, model, '{m}' AS metric, {m} AS value FROM m" for m in ("RMSE", "MAE", "MAPE")), "value")
sql("f9_best_model", f"""WITH {COMPARED} SELECT event_type, model AS best_model FROM m
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY RMSE, model) = 1""")
sql("f10_strategy_metrics", f"""WITH {PREDICTED}, m AS ({scores('event_type, strategy', "(SELECT *, 'EMD+' || model AS strategy FROM fused)")})
    SELECT *, 3 AS imf_components FROM m""", *METRICS)
STRATEGIES = f"{PREDICTED}, every AS (SELECT * REPLACE ('EMD+' || model AS model) FROM fused), m AS ({scores('event_type, model', 'every')})"
sql("f10_strategy_comparison", f"WITH {STRATEGIES} SELECT event_type, upper(model) AS model, RMSE, MAE, MAPE FROM m", "RMSE", "MAE", "MAPE")
sql("f10_best_forecast", f"""WITH {STRATEGIES}, top AS (SELECT event_type, model FROM m QUALIFY row_number() OVER (PARTITION BY event_type
    ORDER BY RMSE, MAE, MAPE, list_position({['EMD+' + x for x in MODELS]}, model)) = 1)
    SELECT e.event_type, e.idx, p.timestamp, actual_load, predicted_load, actual_load - predicted_load AS error, e.model AS strategy
    FROM every AS e JOIN top USING (event_type, model) JOIN parts AS p ON p.event_type = e.event_type AND p.idx = e.idx""", *FORECAST)
sql("f11_fusion_comparison", f"""WITH {PREDICTED}, every AS (SELECT * REPLACE (upper(model) AS model) FROM fused UNION ALL
    SELECT event_type, 'FREQ_FUSION', idx, avg(actual_load), avg(predicted_load) FROM fused GROUP BY event_type, idx),
    m AS ({scores('event_type, model', 'every')}) SELECT event_type, model, RMSE, MAE, MAPE FROM m""", "RMSE", "MAE", "MAPE")
EVENT_SCORED = f"""{EVENT_PREDICTED}, sc AS ({COMPONENT_SCORES}), chosen AS (SELECT event_type, component, model AS selected_model, MAE, RMSE, MAPE, R2 FROM sc
    QUALIFY row_number() OVER (PARTITION BY event_type, component ORDER BY RMSE, MAE, MAPE, list_position({MODELS}, model)) = 1)"""
sql("f4_event_forecast", f"""WITH {EVENT_PREDICTED} SELECT f.event_type, f.idx, p.timestamp, actual_load, predicted_load, actual_load - predicted_load AS error
    FROM fused AS f JOIN parts AS p ON p.event_type = f.event_type AND p.idx = f.idx WHERE model = 'moving_average'""", *FORECAST)
sql("f5_event_selection", f"WITH {EVENT_SCORED} SELECT * FROM chosen", *METRICS)
sql("f6_event_best", f"""WITH {EVENT_SCORED}, hybrid AS (SELECT c.event_type, c.idx, sum(actual) AS actual_load, sum(predicted) AS predicted_load
    FROM comp AS c JOIN chosen AS x ON x.event_type = c.event_type AND x.component = c.component AND x.selected_model = c.model GROUP BY c.event_type, c.idx),
    every AS (SELECT event_type, model AS method, actual_load, predicted_load FROM fused UNION ALL SELECT event_type, 'hybrid', actual_load, predicted_load FROM hybrid),
    m AS ({scores('event_type, method', 'every')})
    SELECT event_type, method AS best_method, MAE, RMSE, MAPE, R2 FROM m QUALIFY row_number() OVER (PARTITION BY event_type
    ORDER BY round(RMSE, 8), round(MAE, 8), round(MAPE, 8), list_position({[*MODELS, 'hybrid']}, method)) = 1""", *METRICS)
sql("f7_dispatch", f"WITH {ONE} SELECT * FROM one", *FORECAST)
CALENDAR_INPUTS = ("year", "month", "day", "hour", "minute", "weekday", "is_weekend", "hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "month_sin", "month_cos")
sql("t7_exogenous_columns", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", sum({c}::INT::DOUBLE) AS total FROM ({calendar(RAW)})" if c == "is_weekend" else f"SELECT '{c}' AS \"column\", sum({c}::DOUBLE) AS total FROM ({calendar(RAW)})" for c in CALENDAR_INPUTS), "total")
# Inputs of the linear model without calendar: 1, the value, the one before, the recent mean; then the value one period before each target and the step.
LINEAR = ["1", "z", "before", "recent", "p", "h"]
MOMENTS = [f"sum({x} * {y})" for x in LINEAR for y in LINEAR] + [f"sum({x} * y)" for x in LINEAR]
sql("f2c_normal_matrix", f"""WITH {PLAIN}, {scaled(ALL_PARTS)}, {windowed(L, H)},
    steps AS MATERIALIZED (SELECT event_type, component, z, before, recent, unnest(ps) AS p, unnest(ys) AS y, unnest(range(1, {H + 1})) / {H}::DOUBLE AS h FROM w WHERE train)
    SELECT event_type, component, unnest(range(0, {len(MOMENTS)}))::INT AS pos, unnest(sums) AS v FROM (SELECT event_type, component, [{', '.join(MOMENTS)}] AS sums FROM steps GROUP BY ALL)""", "v")
FRAMED = """SELECT f.event_type, f.idx, p.timestamp, actual_load, predicted_load, actual_load - predicted_load AS error
    FROM fused AS f JOIN parts AS p ON p.event_type = f.event_type AND p.idx = f.idx WHERE model = """
sql("f2c_linear_forecast", f"WITH {EVENT_PREDICTED} {FRAMED} 'linear'", *FORECAST)
sql("f2d_gbt_forecast", f"WITH {PREDICTED} {FRAMED} 'gbt'", *FORECAST)
sql("f2cd_learned_coverage", f"""SELECT event_type, model, idx, load AS actual_load, true AS predicted FROM (SELECT *, greatest(floor(n * 0.8::DOUBLE), {L + H})::BIGINT AS split_idx FROM ({HOURLY_INDEXED})),
    (SELECT unnest(['linear', 'gbt']) AS model) WHERE idx >= split_idx""", "actual_load")
sql("f3_registry", f"""SELECT event_type, component, model, n - split_idx AS rows, split_idx AS first_row
    FROM (SELECT DISTINCT event_type, n, greatest(floor(n * 0.8::DOUBLE), {L + H})::BIGINT AS split_idx FROM ({HOURLY_INDEXED})), (SELECT unnest({ALL_PARTS}) AS component), (SELECT unnest({MODELS}) AS model)""")
sql("f12_error_analysis_rows", f"WITH {ERRORS} SELECT * EXCLUDE (idx) FROM err", *FORECAST)
sql("f13_last_rows", f"""WITH {ONE} SELECT * EXCLUDE (idx) FROM one
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY idx DESC) <= 168""", *FORECAST)
sql("f13_last_event_rows", f"SELECT * EXCLUDE (n) FROM ({INDEXED}) WHERE idx >= n - 672", "load")

# --- error analysis -----------------------------------------------------------------------------

THREE = ("MAE", "RMSE", "MAPE")
PERIODS = """SELECT *, CASE WHEN hour(timestamp) BETWEEN 18 AND 21 THEN 'Peak Period' WHEN hour(timestamp) BETWEEN 2 AND 4 THEN 'Valley Period' END AS period
    FROM err WHERE hour(timestamp) BETWEEN 18 AND 21 OR hour(timestamp) BETWEEN 2 AND 4"""
TYPES = f"SELECT *, CASE WHEN timestamp::DATE IN ({DAYS}) THEN 'Holiday' ELSE 'Non-Holiday' END AS day_type FROM err"
sql("a21_period_error_stats", f"""WITH {ERRORS}, m AS ({scores('event_type, period', f'({PERIODS})', extra=', count(*) AS sample_count')})
    SELECT * EXCLUDE (R2) FROM m""", *THREE)
sql("a22_holiday_error_stats", f"""WITH {ERRORS}, m AS ({scores('event_type, day_type', f'({TYPES})', extra=', count(*) AS sample_count')})
    SELECT event_type, day_type AS category, MAE, RMSE, MAPE, sample_count FROM m""", *THREE)
sql("a23_period_error_box", f"WITH {ERRORS} SELECT * FROM ({boxed(PERIODS, 'event_type, period', 'error')})", *BOX)
sql("a23_day_type_error_box", f"WITH {ERRORS} SELECT * FROM ({boxed(TYPES, 'event_type, day_type', 'error')})", *BOX)
counted("a13_error_histogram", f"WITH {ERRORS} SELECT * FROM err", "error", 50)

# --- tables -------------------------------------------------------------------------------------



def ratio(x: str, coefficients) -> str:
    def horner(values) -> str:
        text = repr(values[-1])
        for v in reversed(values[:-1]):
            text = f"(({text}) * {x} + {v!r})"
        return text

    return f"({horner(coefficients[0])}) / ({horner(coefficients[1])})".replace("e-", "E-").replace("e+", "E+")


def normal_points(source: str, value: str) -> str:
    """Ordered samples and normal quantiles of their median ranks, by algorithm AS 241."""
    p = "CASE WHEN i = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n) WHEN i = 1 THEN 1 - pow(0.5::DOUBLE, 1.0::DOUBLE / n) ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END"
    outer = f"CASE WHEN t <= 5 THEN {ratio('(t - 1.6)', NORMAL_NEAR)} ELSE {ratio('(t - 5.0)', NORMAL_FAR)} END"
    return f"""SELECT event_type, i AS rank, CASE WHEN abs(q) <= 0.425 THEN q * {ratio('(0.180625 - q * q)', NORMAL_MIDDLE)} WHEN q < 0 THEN -({outer}) ELSE {outer} END AS theoretical, sample
        FROM (SELECT *, p - 0.5::DOUBLE AS q, sqrt(-ln(least(p, 1 - p))) AS t FROM (SELECT *, {p} AS p FROM (
            SELECT event_type, {value} AS sample, row_number() OVER (PARTITION BY event_type ORDER BY {value}) AS i, count(*) OVER (PARTITION BY event_type) AS n FROM ({source}))))"""


sql("a24_error_qq", f"WITH {ERRORS} {normal_points('SELECT * FROM err', 'error')}", "theoretical", "sample")
sql("a24_event_qq_fit", f"""SELECT event_type, regr_slope(sample, theoretical) AS slope, regr_intercept(sample, theoretical) AS intercept, corr(sample, theoretical) AS r
    FROM ({normal_points(RAW, 'load')}) GROUP BY event_type""", "slope", "intercept", "r")
sql("io8_analysis_scope", """SELECT 'start_time' AS field, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS value FROM events
    UNION ALL SELECT 'end_time', strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') FROM events
    UNION ALL SELECT 'rows', count(*)::VARCHAR FROM events UNION ALL SELECT 'selection', 'all data'""")
sql("io9_filtered_data", "SELECT event_type, ts AS timestamp, value AS load FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 14 DAY FROM events)", "load")
sql("io10_without_residual", f"SELECT event_type, timestamp, imf_1 AS IMF1, imf_2 AS IMF2, imf_3 AS IMF3 FROM ({components(INDEXED, 3)})", "IMF1", "IMF2", "IMF3")
ARTIFACTS = {"forecast": ("frame", ("actual_load", "predicted_load")), "metrics_json": ("m", METRICS), "component_metrics": ("chosen", METRICS), "selection": ("chosen", METRICS)}
sql("io11_artifact_tables", f"""WITH {HYBRID}, frame AS (SELECT event_type, actual_load, predicted_load FROM hybrid), m AS ({scores('event_type', 'frame')}) """ + " UNION ALL ".join(
    f"SELECT event_type, count(*) AS rows, '{c}' AS \"column\", sum({c}) AS total, '{name}' AS \"table\" FROM {source} GROUP BY event_type" for name, (source, columns) in ARTIFACTS.items() for c in columns), "total")
sql("io10_component_export", f"""SELECT event_type, timestamp, imf_1 AS IMF1, imf_2 AS IMF2, imf_3 AS IMF3, residual
    FROM ({components(INDEXED, 3)})""", "IMF1", "IMF2", "IMF3", "residual")
sql("io1_io3_csv_encodings", """SELECT k.written_as, k.encoding, false AS multiline, count(*)::BIGINT AS rows FROM events, (SELECT 'UTF-8' AS written_as, 'utf-8' AS encoding
    UNION ALL SELECT 'GB18030', 'gb18030') AS k GROUP BY ALL""")
sql("io2_choose_primary", "SELECT event_type, count(*)::BIGINT AS rows, 'utf-8' AS encoding FROM events WHERE event_type = 'click' GROUP BY ALL")
sql("io4_quoted_breaks", """SELECT event_type, 'a "note"' || chr(10) || 'of ' || event_id AS note, value AS load FROM events""", "load")
sql("io4_doubled_quotes", """SELECT event_type, ts AS timestamp, value AS load,
    CASE WHEN event_id % 2 = 1 THEN '"x", ' || event_id || ',' || chr(10) || '"",' || chr(10) WHEN event_id % 6 <> 0 THEN 'a "b", c "' || event_id || '"' END AS note FROM events""", "load")
sql("io2_io4_load_csv", TYPED, "load", "extra")
sql("io5_clean_table", calendar(RAW), "load", *WAVES)
sql("io5_store_positions", """SELECT o_orderpriority, timestamp, load, count(*) OVER (PARTITION BY o_orderpriority) AS n, row_number() OVER (PARTITION BY o_orderpriority ORDER BY timestamp) - 1 AS idx
    FROM (SELECT o_orderpriority, o_orderdate AS timestamp, sum(o_totalprice / 1000) AS load FROM orders GROUP BY ALL)""", "load")
sql("io5_csv_with_mark", RAW, "load")
sql("io6_run_metadata", """SELECT 'dataset_path' AS field, 'events' AS value UNION ALL SELECT 'encoding', 'utf-8'
    UNION ALL SELECT 'selection', (max(ts) - INTERVAL 14 DAY)::VARCHAR || ' ~ ' || max(ts)::VARCHAR FROM events UNION ALL SELECT 'timestamp_column', 'ts' UNION ALL SELECT 'load_column', 'value'
    UNION ALL SELECT 'rows_after_filter', count(*)::VARCHAR FROM events WHERE ts >= (SELECT max(ts) - INTERVAL 14 DAY FROM events)""")
sql("io11_forecast_artifacts", f"""WITH {ONE}, m AS ({scores('event_type', 'one')}) """ + " UNION ALL ".join(
    f"SELECT event_type, '{m}' AS metric, {m} AS value FROM m" for m in METRICS), "value")
BEST = f"""{HYBRID}, every AS (SELECT event_type, model AS method, idx, actual_load, predicted_load FROM fused
    UNION ALL SELECT event_type, 'hybrid', idx, actual_load, predicted_load FROM hybrid), m AS ({scores('event_type, method', 'every')}),
    best AS (SELECT event_type, method AS best_method, MAE, RMSE, MAPE, R2 FROM m QUALIFY row_number() OVER (PARTITION BY event_type
    ORDER BY round(RMSE, 8), round(MAE, 8), round(MAPE, 8), list_position({[*MODELS, 'hybrid']}, method)) = 1)"""
sql("io11_best_forecasts", f"""WITH {BEST}, every_table AS (SELECT method AS "table", event_type, idx, actual_load, predicted_load FROM every
    UNION ALL SELECT 'best', e.event_type, idx, actual_load, predicted_load FROM every AS e JOIN best AS b ON b.event_type = e.event_type AND b.best_method = e.method)
    SELECT "table", e.event_type, p.timestamp, actual_load, predicted_load, actual_load - predicted_load AS error
    FROM every_table AS e JOIN parts AS p ON p.event_type = e.event_type AND p.idx = e.idx""", *FORECAST)
sql("io11_best_scores", f"""WITH {BEST}
    SELECT method || '_metrics_json' AS "table", event_type, NULL::VARCHAR AS component, NULL::VARCHAR AS chosen, MAE, RMSE, MAPE, R2 FROM m
    UNION ALL SELECT 'best_metrics_json', event_type, NULL, NULL, MAE, RMSE, MAPE, R2 FROM best
    UNION ALL SELECT 'best_method_metrics', event_type, NULL, best_method, MAE, RMSE, MAPE, R2 FROM best
    UNION ALL SELECT model || '_component_metrics', event_type, component, NULL, MAE, RMSE, MAPE, R2 FROM sc
    UNION ALL SELECT 'hybrid_component_metrics', event_type, component, NULL, MAE, RMSE, MAPE, R2 FROM chosen
    UNION ALL SELECT 'imf_model_selection', event_type, component, selected_model, MAE, RMSE, MAPE, R2 FROM chosen""", *METRICS)
