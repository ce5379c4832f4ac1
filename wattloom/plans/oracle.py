"""The catalogue's queries as SQL over the same tables, to check results against.

The checking engine rounds doubles in binary; ``_round`` rounds the decimal text
half up, as Spark does.
"""

from __future__ import annotations


def _round(expression: str, digits: int) -> str:
    return (
        f"CAST(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"
    )


def _six(expression: str, name: str) -> str:
    return f"{_round(expression, 6)} AS {name}"


COLUMNS = (
    "DATE_TIME, PLANT_ID, SOURCE_KEY, DC_POWER, AC_POWER, DAILY_YIELD, TOTAL_YIELD, "
    "AMBIENT_TEMPERATURE, MODULE_TEMPERATURE, IRRADIATION, YEAR, MONTH, DAY, HOUR, "
    "DAY_OF_WEEK, POWER_GENERATED"
)
SENSORS = COLUMNS.split(", ")[3:10]
WEATHER = SENSORS[4:]
GENERATION = "DATE_TIME, PLANT_ID, SOURCE_KEY, DC_POWER, AC_POWER, DAILY_YIELD, TOTAL_YIELD"

READINGS = """
b AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
t AS (
  SELECT event_id, event_type, ts, k,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS DATE_TIME,
    CAST(4135001 + user_id % 8 AS INTEGER) AS PLANT_ID,
    'INV-' || CAST(user_id AS VARCHAR) AS SOURCE_KEY,
    value * CAST(10 AS DOUBLE) AS DC_POWER,
    value * CAST(9.5 AS DOUBLE) AS AC_POWER,
    value * CAST(hour(ts) + 1 AS DOUBLE) AS DAILY_YIELD,
    CAST(event_id AS DOUBLE) + CAST(1000000 AS DOUBLE) AS TOTAL_YIELD,
    CAST(k AS DOUBLE) * CAST(0.15 AS DOUBLE) + CAST(20 AS DOUBLE) AS AMBIENT_TEMPERATURE,
    CAST(k AS DOUBLE) * CAST(0.25 AS DOUBLE) + CAST(25 AS DOUBLE) AS MODULE_TEMPERATURE,
    CAST(k AS DOUBLE) / CAST(80 AS DOUBLE) AS IRRADIATION,
    CAST(year(ts) AS INTEGER) AS YEAR,
    CAST(month(ts) AS INTEGER) AS MONTH,
    CAST(day(ts) AS INTEGER) AS DAY,
    CAST(hour(ts) AS INTEGER) AS HOUR,
    CAST(isodow(ts) - 1 AS INTEGER) AS DAY_OF_WEEK,
    value AS POWER_GENERATED
  FROM b
)"""

FAULTY = f"""{READINGS},
f AS (
  SELECT * REPLACE (
    CASE WHEN k = 0 THEN NULL ELSE PLANT_ID END AS PLANT_ID,
    CASE WHEN k = 1 THEN NULL WHEN k = 2 THEN CAST('nan' AS DOUBLE)
         WHEN k = 5 THEN -POWER_GENERATED ELSE POWER_GENERATED END AS POWER_GENERATED,
    CASE WHEN k = 3 THEN NULL WHEN k = 4 THEN CAST('nan' AS DOUBLE)
         WHEN k = 6 THEN CAST(-0.5 AS DOUBLE) ELSE IRRADIATION END AS IRRADIATION,
    CASE WHEN k = 7 THEN 'n/a' WHEN k = 8 THEN NULL ELSE DATE_TIME END AS DATE_TIME,
    CASE WHEN k = 9 THEN NULL ELSE AC_POWER END AS AC_POWER,
    CASE WHEN k = 10 THEN CAST('nan' AS DOUBLE) ELSE DC_POWER END AS DC_POWER
  ) FROM t
),
clean AS (
  SELECT * REPLACE (try_strptime(DATE_TIME, '%Y-%m-%d %H:%M:%S') AS DATE_TIME) FROM f
  WHERE try_strptime(DATE_TIME, '%Y-%m-%d %H:%M:%S') IS NOT NULL
    AND PLANT_ID IS NOT NULL
    AND POWER_GENERATED IS NOT NULL AND NOT isnan(POWER_GENERATED)
    AND POWER_GENERATED >= 0 AND IRRADIATION >= 0
),
strict AS (SELECT * FROM clean WHERE NOT isnan(IRRADIATION))"""


def _with(tables: str, body: str) -> str:
    return f"WITH {tables}\n{body}"


def _average_by(keys: str, grouping: str | None = None) -> str:
    return _with(
        READINGS,
        f"SELECT {keys}, {_round('avg(POWER_GENERATED)', 2)} AS AVG_POWER "
        f"FROM t GROUP BY {grouping or keys}",
    )


def _statistics(count_name: str) -> str:
    return ", ".join(
        [
            f"count(*) AS {count_name}",
            _six("avg(POWER_GENERATED)", "AVG_POWER"),
            _six("max(POWER_GENERATED)", "MAX_POWER"),
            _six("min(POWER_GENERATED)", "MIN_POWER"),
            _six("avg(IRRADIATION)", "AVG_IRRADIATION"),
        ]
    )


def _windows(source: str, size: str, count_name: str, closed: str = "") -> str:
    return f"""SELECT * FROM (
  SELECT time_bucket(INTERVAL '{size}', ts) AS WINDOW_START,
         time_bucket(INTERVAL '{size}', ts) + INTERVAL '{size}' AS WINDOW_END,
         {_statistics(count_name)}
  FROM {source} GROUP BY 1, 2
) {closed}"""


def _closed(source: str) -> str:
    # The watermark is kept in whole milliseconds.
    return (
        "WHERE WINDOW_END <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '10 seconds' "
        f"FROM {source})"
    )


def _unpivot(columns: list[str], measures, source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS COLUMN_NAME, {measures(c)} FROM {source}" for c in columns
    )


def _describe(c: str) -> str:
    return ", ".join(
        [
            f"count({c}) AS N",
            _six(f"avg({c})", "MEAN"),
            _six(f"stddev_samp({c})", "STD"),
            _six(f"min({c})", "MIN"),
            _six(f"quantile_cont({c}, 0.25)", "Q25"),
            _six(f"quantile_cont({c}, 0.5)", "Q50"),
            _six(f"quantile_cont({c}, 0.75)", "Q75"),
            _six(f"max({c})", "MAX"),
        ]
    )


def _quartiles(c: str) -> str:
    q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
    return f"{_six(q1, 'Q1')}, {_six(q3, 'Q3')}, {_six(f'({q3} - {q1})', 'IQR')}"


def _outliers(c: str) -> str:
    return (
        f"count(*) FILTER (WHERE {c} < (SELECT quantile_cont({c}, 0.25) - 1.5 * "
        f"(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM present) "
        f"OR {c} > (SELECT quantile_cont({c}, 0.75) + 1.5 * "
        f"(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM present)) AS OUTLIERS"
    )


# NaN counts as missing in the profile.
PRESENT = f"""{FAULTY},
present AS (
  SELECT * REPLACE (
    CASE WHEN NOT isnan(IRRADIATION) THEN IRRADIATION END AS IRRADIATION,
    CASE WHEN NOT isnan(DC_POWER) THEN DC_POWER END AS DC_POWER,
    CASE WHEN NOT isnan(POWER_GENERATED) THEN POWER_GENERATED END AS POWER_GENERATED
  ) FROM f
)"""

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
IS_GENERATION = "event_type IN ('view', 'click', 'purchase')"
IS_WEATHER = "event_type IN ('signup', 'error')"


def _prepared(time: str) -> str:
    """Hourly weather ``w`` and readings ``g``, with times taken from ``time``."""
    means = ", ".join(f"avg({c}) AS {c}" for c in WEATHER)
    return f"""{READINGS},
w AS (
  SELECT date_trunc('hour', {time}) AS DATE_TIME, PLANT_ID, {means}
  FROM t WHERE {IS_WEATHER} GROUP BY 1, 2
),
g AS (
  SELECT date_trunc('hour', {time}) AS DATE_TIME, PLANT_ID, SOURCE_KEY,
         DC_POWER, AC_POWER, DAILY_YIELD, TOTAL_YIELD
  FROM t WHERE {IS_GENERATION}
)"""


ROUNDED_WEATHER = ", ".join(_six(c, c) for c in WEATHER)
MASTER = (
    "SELECT g.DATE_TIME, g.PLANT_ID, SOURCE_KEY, DC_POWER, AC_POWER, DAILY_YIELD, TOTAL_YIELD, "
    f"{ROUNDED_WEATHER} FROM g JOIN w ON g.DATE_TIME = w.DATE_TIME AND g.PLANT_ID = w.PLANT_ID"
)
SOURCE_CODES = (
    "SELECT event_id, t.SOURCE_KEY, c.SOURCE_KEY_ENCODED FROM t JOIN ("
    "SELECT SOURCE_KEY, dense_rank() OVER (ORDER BY SOURCE_KEY) - 1 AS SOURCE_KEY_ENCODED "
    "FROM (SELECT DISTINCT SOURCE_KEY FROM t)) c ON t.SOURCE_KEY = c.SOURCE_KEY"
)
DECODED = ", ".join(
    f"CASE WHEN k = 11 THEN NULL ELSE {c} END AS {c}" for c in COLUMNS.split(", ")
)
TRAINING = f"""{FAULTY},
usable AS (
  SELECT * FROM f WHERE AC_POWER IS NOT NULL
    AND DC_POWER IS NOT NULL AND NOT isnan(DC_POWER)
    AND IRRADIATION IS NOT NULL AND NOT isnan(IRRADIATION)
    AND POWER_GENERATED IS NOT NULL AND NOT isnan(POWER_GENERATED)
)"""


# The one cut of lowest variance, its two means, and what they predict.
STUMP = f"""{TRAINING},
u AS (SELECT ts, PLANT_ID, SOURCE_KEY, HOUR, DAY_OF_WEEK, POWER_GENERATED AS y FROM usable),
grouped AS (
  SELECT 'HOUR' AS FEATURE, HOUR AS v, count(*) AS c, sum(y) AS s FROM u GROUP BY 2
  UNION ALL SELECT 'DAY_OF_WEEK', DAY_OF_WEEK, count(*), sum(y) FROM u GROUP BY 2
),
cuts AS (
  SELECT FEATURE, v, sum(c) OVER low AS n1, sum(s) OVER low AS s1,
    sum(c) OVER (PARTITION BY FEATURE) AS n, sum(s) OVER (PARTITION BY FEATURE) AS st
  FROM grouped WINDOW low AS (PARTITION BY FEATURE ORDER BY v)
),
best AS (
  SELECT FEATURE, v, s1 / n1 AS m1, (st - s1) / (n - n1) AS m2 FROM cuts WHERE n1 < n
  ORDER BY s1 * s1 / n1 + (st - s1) * (st - s1) / (n - n1) DESC LIMIT 1
),
guessed AS (
  SELECT ts, PLANT_ID, SOURCE_KEY, y,
    CASE WHEN (CASE WHEN FEATURE = 'HOUR' THEN HOUR ELSE DAY_OF_WEEK END) <= v
         THEN m1 ELSE m2 END AS p
  FROM u, best
)"""


def _metrics() -> str:
    """Quality of the predictions ``p`` of ``y``."""
    return "count(*) AS N, " + ", ".join(
        [
            _six("avg(abs(y - p))", "MAE"),
            _six("sqrt(avg((y - p) * (y - p)))", "RMSE"),
            _six("(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)))", "R2"),
        ]
    )


def oracle_queries() -> dict[str, str]:
    sql: dict[str, str] = {}

    # Reports
    sql["q01_total_records"] = _with(READINGS, "SELECT count(*) AS Total_Records FROM t")
    sql["q02_average_power"] = _with(
        READINGS, f"SELECT {_round('avg(POWER_GENERATED)', 2)} AS Average_Power FROM t"
    )
    sql["q03_monthly"] = _average_by("YEAR, MONTH")
    sql["q04_daily"] = _average_by("YEAR, MONTH, DAY")
    sql["q05_hourly"] = _average_by("HOUR")
    sql["q06_by_plant"] = _average_by("PLANT_ID")
    sql["q07_by_weekday"] = _average_by("DAY_OF_WEEK")
    sql["q08_by_temperature"] = _average_by(
        f"{_round('AMBIENT_TEMPERATURE', 1)} AS TEMPERATURE", "1"
    )
    sql["q09_by_irradiation"] = _average_by(f"{_round('t.IRRADIATION', 2)} AS IRRADIATION", "1")
    sql["q10_top_power"] = _with(
        READINGS,
        "SELECT DATE_TIME, PLANT_ID, POWER_GENERATED FROM t "
        "ORDER BY POWER_GENERATED DESC, DATE_TIME, PLANT_ID LIMIT 10",
    )
    sql["q11_max_power"] = _with(READINGS, "SELECT max(POWER_GENERATED) AS MAX_POWER FROM t")
    sql["q12_min_power"] = _with(READINGS, "SELECT min(POWER_GENERATED) AS MIN_POWER FROM t")
    sql["view_sql"] = _with(
        FAULTY,
        "SELECT PLANT_ID, count(*) AS READINGS, max(AC_POWER) AS TOP_AC FROM f GROUP BY PLANT_ID",
    )

    # Cleaning, types, messages
    not_nan = "CASE WHEN NOT isnan({0}) THEN {0} END AS {0}"
    sql["clean_readings"] = _with(
        FAULTY,
        "SELECT event_id, DATE_TIME, PLANT_ID, POWER_GENERATED, "
        f"isnan(IRRADIATION) AS IRRADIATION_IS_NAN, {not_nan.format('IRRADIATION')} FROM clean",
    )
    sql["clean_readings_strict"] = _with(
        FAULTY, "SELECT event_id, DATE_TIME, PLANT_ID, POWER_GENERATED, IRRADIATION FROM strict"
    )
    valid = (
        "DATE_TIME IS NOT NULL AND PLANT_ID IS NOT NULL AND AC_POWER IS NOT NULL "
        "AND DC_POWER IS NOT NULL AND IRRADIATION >= 0 AND POWER_GENERATED >= 0"
    )
    sql["validate_for_scoring"] = _with(
        FAULTY,
        "SELECT event_id, DATE_TIME, PLANT_ID, "
        f"isnan(POWER_GENERATED) AS POWER_GENERATED_IS_NAN, {not_nan.format('POWER_GENERATED')}, "
        f"isnan(IRRADIATION) AS IRRADIATION_IS_NAN, {not_nan.format('IRRADIATION')} "
        f"FROM f WHERE {valid}",
    )
    text_columns = {"DATE_TIME", "SOURCE_KEY"}
    whole_columns = {"PLANT_ID", "YEAR", "MONTH", "DAY", "HOUR", "DAY_OF_WEEK"}
    typed = []
    for c in COLUMNS.split(", "):
        kind = "VARCHAR" if c in text_columns else "INTEGER" if c in whole_columns else "DOUBLE"
        typed.append(
            f"TRY_CAST(CASE WHEN k = 12 THEN 'bad' ELSE CAST({c} AS VARCHAR) END AS {kind}) AS {c}"
        )
    sql["enforce_types"] = _with(READINGS, f"SELECT event_id, {', '.join(typed)} FROM t")
    sql["export_projection"] = _with(
        READINGS,
        "SELECT DATE_TIME, PLANT_ID, POWER_GENERATED, AMBIENT_TEMPERATURE, IRRADIATION FROM t",
    )
    fields = []
    for c in COLUMNS.split(", "):
        quote = '"' if c in text_columns else ""
        fields.append(f"'\"{c}\":{quote}' || CAST({c} AS VARCHAR) || '{quote}'")
    sql["json_encode"] = _with(
        READINGS, "SELECT '{' || " + " || ',' || ".join(fields) + " || '}' AS value FROM t"
    )
    sql["json_decode"] = _with(READINGS, f"SELECT ts AS STREAM_TIMESTAMP, {DECODED} FROM t")
    sql["json_props"] = (
        "SELECT ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"
    )
    sql["parse_mixed_timestamp"] = """
WITH o AS (
  SELECT o_orderkey,
    CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
         WHEN 'O' THEN strftime(o_orderdate, '%m-%d-%Y %H:%M')
         ELSE strftime(o_orderdate, '%d-%m-%Y %H:%M') END AS "TEXT"
  FROM orders
)
SELECT o_orderkey, "TEXT", coalesce(
    try_strptime("TEXT", '%Y-%m-%d %H:%M:%S'),
    try_strptime("TEXT", '%m-%d-%Y %H:%M'),
    try_strptime("TEXT", '%d-%m-%Y %H:%M')) AS DATE_TIME
FROM o"""

    # Preparation
    sql["union_sources"] = _with(
        READINGS,
        f"SELECT {COLUMNS} FROM t WHERE PLANT_ID <= 4135004 UNION ALL BY NAME "
        f"SELECT {COLUMNS.replace('TOTAL_YIELD, ', '')} FROM t WHERE PLANT_ID > 4135004",
    )
    sql["weather_hourly"] = _with(
        _prepared("ts"), f"SELECT DATE_TIME, PLANT_ID, {ROUNDED_WEATHER} FROM w"
    )
    sql["master_join"] = sql["master_join_shuffled"] = _with(_prepared("ts"), MASTER)
    calendar = (
        "CAST(hour({0}) AS INTEGER) AS HOUR, CAST(day({0}) AS INTEGER) AS DAY, "
        "CAST(month({0}) AS INTEGER) AS MONTH, dayname({0}) AS DAY_NAME, "
        "CAST(isodow({0}) >= 6 AS INTEGER) AS IS_WEEKEND"
    )
    sql["calendar_features"] = (
        f"SELECT event_id, ts AS DATE_TIME, {calendar.format('ts')} FROM events"
    )
    sql["finalize_features"] = _with(
        READINGS,
        "SELECT event_id, ts AS DATE_TIME, AC_POWER, YEAR, DAY_OF_WEEK, "
        "AC_POWER / CAST(10 AS DOUBLE) AS POWER_GENERATED FROM t",
    )
    sql["label_encode"] = sql["label_encode_shuffled"] = _with(READINGS, SOURCE_CODES)
    sql["label_encode_equal_rows"] = _with(
        f"""{READINGS},
e AS (
  SELECT CASE WHEN event_id % 4 < 2 THEN 'hot' WHEN event_id % 4 = 3 THEN SOURCE_KEY END AS KEY FROM t
)""",
        "SELECT KEY, CASE WHEN KEY IS NOT NULL THEN code END AS KEY_ENCODED FROM ("
        "SELECT KEY, dense_rank() OVER (ORDER BY KEY NULLS LAST) - 1 AS code FROM e)",
    )
    sql["label_encode_brand"] = (
        "SELECT p_partkey, p_brand, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand_ENCODED "
        "FROM part"
    )
    sql["offline_features"] = _with(
        f"{_prepared('ts')}, m AS ({MASTER}), d AS (SELECT DISTINCT * FROM m)",
        f"SELECT d.*, {calendar.format('DATE_TIME')}, "
        "dense_rank() OVER (ORDER BY SOURCE_KEY) - 1 AS SOURCE_KEY_ENCODED, "
        "CAST(year(DATE_TIME) AS INTEGER) AS YEAR, "
        "CAST(isodow(DATE_TIME) - 1 AS INTEGER) AS DAY_OF_WEEK, "
        "AC_POWER / CAST(10 AS DOUBLE) AS POWER_GENERATED FROM d",
    )

    # Profile
    dated = """
WITH o AS (
  SELECT o_orderkey, o_orderpriority, substr(o_orderpriority, 1, 1) AS s, o_orderdate AS d FROM orders
), w AS (
  SELECT o_orderkey, o_orderpriority, d,
    CASE WHEN s = '1' OR (s = '3' AND o_orderkey % 2 = 0) OR (s = '4' AND day(d) <= 12)
         THEN strftime(d, '%m/%d/%Y %H:%M')
         WHEN s IN ('2', '3') THEN strftime(d, '%d/%m/%Y %H:%M')
         WHEN s = '5' THEN strftime(d, '%Y-%m-%d %H:%M') END AS DATE_TIME,
    s IN ('1', '4') OR (s = '3' AND o_orderkey % 2 = 0) AS month_first, s
  FROM o
), kinds AS (
  SELECT *, CASE WHEN DATE_TIME IS NULL THEN NULL WHEN s = '5' THEN 'other'
                 WHEN month(d) = day(d) THEN 'same' WHEN day(d) <= 12 THEN 'either'
                 WHEN month_first THEN 'month' ELSE 'day' END AS kind FROM w
), evidence AS (
  SELECT o_orderpriority,
    count(*) FILTER (kind = 'month') AS MONTH_FIRST_ONLY, count(*) FILTER (kind = 'day') AS DAY_FIRST_ONLY,
    count(*) FILTER (kind = 'either') AS EITHER_ORDER, count(*) FILTER (kind = 'same') AS SAME_IN_BOTH,
    count(*) FILTER (kind = 'other') AS NOT_YEAR_LAST,
    CASE WHEN bool_or(coalesce(kind = 'month', false)) AND bool_or(coalesce(kind = 'day', false)) THEN 'both'
         WHEN bool_or(coalesce(kind = 'month', false)) THEN 'month first'
         WHEN bool_or(coalesce(kind = 'day', false)) THEN 'day first' ELSE 'none' END AS DATE_ORDER
  FROM kinds GROUP BY o_orderpriority
)"""
    sql["date_order_evidence"] = f"{dated} SELECT * FROM evidence"
    sql["dates_by_evidence"] = f"""{dated}
SELECT o_orderkey, o_orderpriority, CASE
    WHEN kind = 'either' AND NOT month_first AND DATE_ORDER <> 'day first'
    THEN make_timestamp(year(d), day(d), month(d), hour(d), minute(d), 0.0)
    WHEN DATE_TIME IS NOT NULL
    THEN make_timestamp(year(d), month(d), day(d), hour(d), minute(d), 0.0) END AS DATE_TIME
FROM kinds JOIN evidence USING (o_orderpriority)"""
    sql["ambiguous_dates"] = f"""{dated}
SELECT o_orderkey, o_orderpriority, DATE_TIME, DATE_ORDER FROM kinds JOIN evidence USING (o_orderpriority)
WHERE kind = 'either' AND DATE_ORDER IN ('both', 'none')"""
    sql["dedupe_wide"] = "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (SELECT DISTINCT * FROM lineitem)"
    sql["duplicate_count_wide"] = (
        "SELECT count(*) + count(*) FILTER (l_linenumber = 1) + (SELECT count(*) FROM lineitem) "
        "- (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS DUPLICATE_ROWS "
        "FROM lineitem WHERE l_orderkey % 5 = 0"
    )
    sql["dedupe"] = "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem"
    sql["duplicate_count"] = (
        "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM "
        "(SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS DUPLICATE_ROWS"
    )
    sql["null_counts"] = _with(
        PRESENT,
        _unpivot(COLUMNS.split(", "), lambda c: f"count(*) - count({c}) AS MISSING", "present"),
    )
    layout = ", ".join(
        f"({i}, '{c}', '"
        + ("string" if c in text_columns else "int" if c in whole_columns else "double")
        + "')"
        for i, c in enumerate(COLUMNS.split(", "))
    )
    sql["profile"] = (
        f"SELECT CAST(p AS INTEGER) AS POSITION, c AS COLUMN_NAME, d AS DATA_TYPE, "
        f"CAST(16 AS INTEGER) AS COLUMN_COUNT, (SELECT count(*) FROM events) AS ROW_COUNT "
        f"FROM (VALUES {layout}) v(p, c, d)"
    )
    sql["describe_columns"] = _unpivot(LINE_NUMBERS, _describe, "lineitem")
    sql["describe_readings"] = _with(PRESENT, _unpivot(SENSORS, _describe, "present"))
    moment = "make_timestamp(CAST(trunc({0}) AS BIGINT))"
    sql["describe_times"] = (
        "SELECT 'ts' AS COLUMN_NAME, count(ts) AS N, "
        "make_timestamp(CAST(sum(CAST(epoch_us(ts) AS HUGEINT)) // count(ts) AS BIGINT)) AS MEAN, "
        "min(ts) AS MIN, "
        + ", ".join(
            f"{moment.format(f'quantile_cont(epoch_us(ts), {p})')} AS {n}"
            for p, n in ((0.25, "Q25"), (0.5, "Q50"), (0.75, "Q75"))
        )
        + ", max(ts) AS MAX FROM events"
    )
    sql["quartiles"] = sql["quartiles_narrowed"] = _unpivot(LINE_NUMBERS, _quartiles, "lineitem")
    sql["iqr_outlier_counts"] = _with(PRESENT, _unpivot(SENSORS, _outliers, "present"))
    sql["iqr_outliers"] = """
WITH q AS (
  SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events
)
SELECT event_id, value FROM events
WHERE value < (SELECT q1 - 1.5 * (q3 - q1) FROM q)
   OR value > (SELECT q3 + 1.5 * (q3 - q1) FROM q)"""

    # Windows, totals, streams.  Undecodable records (k = 11) never become clean rows.
    arrived = f"{FAULTY}, arrived AS (SELECT * FROM strict WHERE k <> 11)"
    sql["window_batch"] = _with(arrived, _windows("arrived", "1 hour", "TOTAL_RECORDS"))
    sql["stream_window_clean"] = _with(
        arrived, _windows("arrived", "1 hour", "CLEAN_RECORDS", _closed("arrived"))
    )
    sql["stream_window_10s"] = _with(
        arrived, _windows("arrived", "10 seconds", "TOTAL_RECORDS", _closed("arrived"))
    )
    sql["stream_late_data"] = _with(
        f"""{READINGS},
ends AS (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS z FROM events),
ontime AS (
  SELECT * FROM t WHERE k <> 11 AND NOT (
    event_type = 'signup' AND epoch_us(ts) < (SELECT a + (z - a) // 3 FROM ends))
)""",
        _windows("ontime", "1 hour", "TOTAL_RECORDS", _closed("ontime")),
    )
    sql["stream_rejects"] = _with(
        f"""{FAULTY},
ends AS (SELECT min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS z FROM events),
batches AS (
  SELECT f.*, epoch_us(ts) AS us, CASE
    WHEN epoch_us(ts) < a + (z - a) // 3 THEN CASE event_type WHEN 'signup' THEN 2 ELSE 0 END
    WHEN epoch_us(ts) < a + 2 * ((z - a) // 3) THEN 1 ELSE 2 END AS batch
  FROM f, ends
),
judged AS (
  SELECT *, CASE WHEN k = 11 THEN 'UNDECODABLE'
    WHEN try_strptime(DATE_TIME, '%Y-%m-%d %H:%M:%S') IS NULL OR PLANT_ID IS NULL
      OR POWER_GENERATED IS NULL OR isnan(POWER_GENERATED) THEN 'INCOMPLETE'
    WHEN IRRADIATION IS NULL OR isnan(IRRADIATION) OR IRRADIATION < 0 OR POWER_GENERATED < 0
    THEN 'NEGATIVE' END AS reason
  FROM batches
),
marks AS (
  SELECT n.batch, coalesce(max(j.us) // 1000 * 1000 - 10000000, 0) AS mark
  FROM (VALUES (0), (1), (2)) AS n(batch) LEFT JOIN judged j ON j.batch < n.batch AND reason IS NULL
  GROUP BY n.batch
),
told AS (
  SELECT batch, coalesce(reason, CASE WHEN us // 3600000000 * 3600000000 + 3600000000 <= mark
                                      THEN 'LATE' END) AS reason
  FROM judged JOIN marks USING (batch)
)""",
        "SELECT count(*) AS TOTAL, count(*) FILTER (reason IS NULL) AS KEPT, "
        + ", ".join(
            f"count(*) FILTER (reason = '{r}') AS {r}"
            for r in ("UNDECODABLE", "INCOMPLETE", "NEGATIVE", "LATE")
        )
        + ", CAST(batch AS BIGINT) AS BATCH_ID FROM told GROUP BY batch",
    )
    sql["totals_batch"] = _with(FAULTY, f"SELECT {_statistics('TOTAL_RECORDS')} FROM strict")
    sql["stream_running_totals"] = _with(
        arrived, f"SELECT {_statistics('TOTAL_RECORDS')} FROM arrived"
    )
    sql["stream_archive"] = _with(READINGS, f"SELECT {DECODED} FROM t")
    sql["csv_roundtrip"] = _with(READINGS, f"SELECT {COLUMNS} FROM t")
    sql["csv_line_breaks"] = _with(
        READINGS,
        f"SELECT * REPLACE (SOURCE_KEY || chr(10) || '\"a\", ' || PLANT_ID AS SOURCE_KEY) "
        f"FROM (SELECT {COLUMNS} FROM t)",
    )
    sql["offline_features_mixed"] = sql["offline_features"]
    sql["rejected_rows"] = _with(
        FAULTY,
        "SELECT 'DATE_TIME' AS COLUMN_NAME, DATE_TIME AS TEXT, CASE WHEN DATE_TIME IS NULL "
        "THEN 'missing' ELSE 'unreadable' END AS REASON, count(*) AS ROWS_REJECTED "
        "FROM f WHERE k IN (7, 8) GROUP BY 1, 2, 3",
    )
    sql["stream_window_quarters"] = sql["stream_window_clean"]
    sql["stream_totals_quarters"] = _with(
        arrived, f"SELECT {_statistics('TOTAL_RECORDS')}, 4 AS SNAPSHOTS FROM arrived"
    )
    sql["stream_archive_quarters"] = sql["stream_archive"]

    # Model
    sql["ml_split"] = _with(
        TRAINING,
        "SELECT event_id, DATE_TIME, PLANT_ID, SOURCE_KEY, POWER_GENERATED, "
        "CASE WHEN n <= CAST(trunc(total * CAST(0.8 AS DOUBLE)) AS BIGINT) "
        "THEN 'train' ELSE 'test' END AS PART FROM ("
        "SELECT event_id, ts AS DATE_TIME, PLANT_ID, SOURCE_KEY, POWER_GENERATED, "
        "row_number() OVER (ORDER BY ts, PLANT_ID NULLS LAST, SOURCE_KEY, event_id) AS n, "
        "count(*) OVER () AS total FROM usable)",
    )
    sql["ml_split_ties"] = """
SELECT o_orderkey, MONTH_START,
  CASE WHEN n <= CAST(trunc(total * CAST(0.8 AS DOUBLE)) AS BIGINT)
       THEN 'train' ELSE 'test' END AS PART
FROM (
  SELECT o_orderkey, date_trunc('month', o_orderdate) AS MONTH_START,
    row_number() OVER (ORDER BY date_trunc('month', o_orderdate), o_orderpriority, o_orderkey) AS n,
    count(*) OVER () AS total
  FROM orders
)"""
    sql["ml_prediction_rows"] = (
        "SELECT DATE_TIME, PLANT_ID, SOURCE_KEY, POWER_GENERATED AS ACTUAL_POWER, "
        f"TRUE AS HAS_PREDICTION FROM ({sql['ml_split']}) WHERE PART = 'test'"
    )
    sql["ml_expression"] = sql["ml_prediction_rows"]
    sql["ml_stump"] = _with(
        STUMP,
        "SELECT ts AS DATE_TIME, PLANT_ID, SOURCE_KEY, y AS ACTUAL_POWER, "
        f"{_six('p', 'PREDICTED_POWER')} FROM guessed",
    )
    sql["ml_stump_metrics"] = _with(STUMP, f"SELECT {_metrics()} FROM guessed")
    sql["ml_importance_stump"] = _with(
        STUMP,
        "SELECT x.FEATURE, CASE WHEN x.FEATURE = best.FEATURE THEN CAST(1 AS DOUBLE) "
        "ELSE CAST(0 AS DOUBLE) END AS IMPORTANCE "
        "FROM (VALUES ('HOUR'), ('DAY_OF_WEEK')) AS x(FEATURE), best",
    )
    sql["regression_metrics"] = _with(
        f"""{READINGS},
s AS (
  SELECT POWER_GENERATED AS y,
    POWER_GENERATED * CAST(0.9 AS DOUBLE) + AMBIENT_TEMPERATURE / CAST(10 AS DOUBLE) AS p FROM t
)""",
        f"SELECT {_metrics()} FROM s",
    )
    absent = " OR ".join(
        f"{c} IS NULL"
        for c in ("DATE_TIME", "PLANT_ID", "AC_POWER", "DC_POWER", "IRRADIATION", "POWER_GENERATED")
    )
    sql["scoring_rejects"] = _with(
        FAULTY,
        f"SELECT REASON, count(*) AS ROWS_SKIPPED FROM (SELECT CASE WHEN k = 11 OR {absent} "
        "THEN 'missing value' WHEN IRRADIATION < 0 OR POWER_GENERATED < 0 THEN 'negative value' "
        "WHEN isnan(IRRADIATION) OR isnan(DC_POWER) THEN 'unusable feature' END AS REASON FROM f) "
        "WHERE REASON IS NOT NULL GROUP BY REASON",
    )
    sql["ml_stream_rows"] = _with(
        FAULTY,
        "SELECT try_strptime(DATE_TIME, '%Y-%m-%d %H:%M:%S') AS EVENT_TIME, PLANT_ID, SOURCE_KEY, "
        f"{not_nan.format('POWER_GENERATED').replace(' AS POWER_GENERATED', ' AS ACTUAL_POWER')}, "
        "IRRADIATION, TRUE AS HAS_PREDICTION "
        f"FROM f WHERE k <> 11 AND {valid} AND NOT isnan(IRRADIATION) AND NOT isnan(DC_POWER)",
    )
    return sql
