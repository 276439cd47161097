"""DuckDB SQL equivalent to each named query (same column names, same
rounding), over the pre-registered table views. Building blocks are CTEs
assembled with ``sql()``."""

from __future__ import annotations

from sitecast.plans import catalog as C
from sitecast.streaming import jobs as J

K_TXT = "json_extract_string(props, '$.k')"

READINGS = f"""readings AS (
  SELECT event_id,
         CAST(user_id AS INTEGER) AS site_id,
         date_trunc('hour', ts) AS measurement_time,
         ts AS modified_time,
         CAST(floor(value) AS INTEGER) AS vehicle_flow_rate,
         TRY_CAST({K_TXT} AS INTEGER) AS k,
         CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS data_quality,
         TRY_CAST({K_TXT} AS FLOAT) AS average_vehicle_speed,
         'lane' || CAST(TRY_CAST({K_TXT} AS INTEGER) % 3 + 1 AS VARCHAR) AS specific_lane,
         'POINT (' || CAST(user_id % 10 + 18 AS VARCHAR) || ' ' || CAST(user_id % 7 + 59 AS VARCHAR) || ')' AS geometry
  FROM events)"""

D = """d AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY site_id, measurement_time
                                 ORDER BY modified_time DESC, event_id DESC) AS rn
    FROM readings) WHERE rn = 1)"""


def latest(n: int, src: str = "d", name: str = "l") -> str:
    return f"""{name} AS (
  SELECT * FROM (
    SELECT site_id, measurement_time, CAST(vehicle_flow_rate AS DOUBLE) AS v,
           row_number() OVER (PARTITION BY site_id ORDER BY measurement_time DESC) AS rn
    FROM {src}) WHERE rn <= {n})"""


def sql(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def gate(src: str = "d", name: str = "de", min_history: int = C.HISTORY) -> str:
    return f"""{name} AS (
  SELECT * FROM {src} WHERE site_id IN (
    SELECT site_id FROM {src} GROUP BY site_id HAVING count(measurement_time) >= {min_history}))"""


def ma_ctes(src: str, window: int = C.WINDOW, steps: int = C.STEPS, prefix: str = "ma") -> list[str]:
    """Moving-average recursion unrolled: x1..xw oldest first, missing rows 0."""
    xs = ",\n".join(
        f"CASE WHEN count(*) >= {window - j + 1} THEN max(v) FILTER (WHERE rn = {window - j + 1}) ELSE 0 END AS x{j}"
        for j in range(1, window + 1))
    base = f"""{prefix}_p AS (
  SELECT site_id, max(measurement_time) AS last_time,
{xs}
  FROM {prefix}_q GROUP BY site_id)"""
    seq = [f"x{j}" for j in range(1, window + 1)]
    fs = []
    for k in range(1, steps + 1):
        tail = seq[-window:]
        fs.append(f"({' + '.join(tail)}) / {window}")
        seq.append(f"f{k}")
    # nest forecasts so later ones can reference earlier ones
    ctes = [latest(window, src, f"{prefix}_q"), base]
    prev = f"{prefix}_p"
    for k in range(1, steps + 1):
        ctes.append(f"{prefix}_f{k} AS (SELECT *, {fs[k - 1]} AS f{k} FROM {prev})")
        prev = f"{prefix}_f{k}"
    out = " UNION ALL ".join(
        f"SELECT site_id, last_time + INTERVAL {k} MINUTE AS measurement_time, round(f{k}, 6) AS vehicle_flow_rate, "
        f"'moving_avg' AS forecast_type FROM {prev}" for k in range(1, steps + 1))
    ctes.append(f"{prefix} AS ({out})")
    return ctes


def ar1_ctes(src: str, steps: int = C.STEPS, prefix: str = "ar") -> list[str]:
    c = f"""{prefix}_c AS (
  SELECT site_id,
         CASE WHEN regr_sxx(y, x) > 0 THEN regr_slope(y, x) END AS b,
         CASE WHEN regr_sxx(y, x) > 0 THEN regr_intercept(y, x) END AS a,
         arg_max(y, measurement_time) AS last_value,
         max(measurement_time) AS last_time
  FROM (SELECT site_id, measurement_time, CAST(vehicle_flow_rate AS DOUBLE) AS y,
               lag(CAST(vehicle_flow_rate AS DOUBLE)) OVER (PARTITION BY site_id ORDER BY measurement_time) AS x
        FROM {src} WHERE measurement_time IS NOT NULL)
  GROUP BY site_id)"""
    ctes = [c]
    prev, prev_f = f"{prefix}_c", "last_value"
    for k in range(1, steps + 1):
        ctes.append(f"{prefix}_f{k} AS (SELECT *, CASE WHEN b IS NULL THEN last_value ELSE a + b * {prev_f} END AS f{k} FROM {prev})")
        prev, prev_f = f"{prefix}_f{k}", f"f{k}"
    out = " UNION ALL ".join(
        f"SELECT site_id, last_time + INTERVAL {k} MINUTE AS measurement_time, round(f{k}, 6) AS vehicle_flow_rate, "
        f"'ar1' AS forecast_type FROM {prev}" for k in range(1, steps + 1))
    ctes.append(f"{prefix} AS ({out})")
    return ctes


def site_mean_grid(src: str, history: int = C.HISTORY, keep_last: int | None = None,
                   name: str = "grid") -> list[str]:
    lname = f"{name}_l"
    slots = f"SELECT DISTINCT measurement_time FROM {lname} WHERE measurement_time IS NOT NULL"
    if keep_last:
        slots = f"SELECT measurement_time FROM ({slots}) ORDER BY measurement_time DESC LIMIT {keep_last}"
    return [
        latest(history, src, lname),
        f"""{name} AS (
  SELECT s.site_id, g.measurement_time,
         round(coalesce(x.v, s.m, 0), 6) AS vehicle_flow_rate, (x.v IS NULL) AS imputed
  FROM (SELECT site_id, avg(v) AS m FROM {lname} WHERE measurement_time IS NOT NULL GROUP BY site_id) s
  CROSS JOIN ({slots}) g
  LEFT JOIN {lname} x ON x.site_id = s.site_id AND x.measurement_time = g.measurement_time)"""]


def windows_cte(src: str = "d", window: int = C.WINDOW, name: str = "win") -> str:
    lags = ",\n".join(
        (f"lag(v, {window - 1 - i}) OVER s AS w{i + 1}" if i < window - 1 else f"v AS w{window}")
        for i in range(window))
    return f"""{name} AS (
  SELECT site_id, measurement_time, {', '.join(f'w{i}' for i in range(1, window + 1))}, y, target_time,
         rn - {window} AS window_id, n - {window + 1} + 1 AS n_windows
  FROM (SELECT site_id, measurement_time,
{lags},
               lead(v, 1) OVER s AS y,
               lead(measurement_time, 1) OVER s AS target_time,
               row_number() OVER s AS rn,
               count(*) OVER (PARTITION BY site_id) AS n
        FROM (SELECT site_id, measurement_time, CAST(vehicle_flow_rate AS DOUBLE) AS v FROM {src})
        WINDOW s AS (PARTITION BY site_id ORDER BY measurement_time))
  WHERE rn >= {window} AND rn <= n - 1)"""


def forecasts_ctes(src: str = "d", name: str = "fc") -> list[str]:
    return ([gate(src, f"{name}_e")] + ma_ctes(f"{name}_e", prefix=f"{name}_ma")
            + site_mean_grid(f"{name}_e", name=f"{name}_m") + ar1_ctes(f"{name}_m", prefix=f"{name}_ar")
            + site_mean_grid(f"{name}_e", keep_last=C.STEPS, name=f"{name}_g")
            + [f"""{name} AS (
  SELECT * FROM {name}_ma UNION ALL SELECT * FROM {name}_ar
  UNION ALL SELECT site_id, measurement_time, vehicle_flow_rate, 'actual' AS forecast_type FROM {name}_g)"""])


FC = [READINGS, D] + forecasts_ctes()

LABELS = """CASE WHEN forecast_type = 'actual' THEN 'Actual' ELSE 'Prediction' END"""
DISPLAY = """CASE WHEN forecast_type = 'gru' THEN 'GRU' WHEN forecast_type = 'moving_avg' THEN 'Moving Avg' ELSE forecast_type END"""


def loss_ctes(src: str = "d", window: int = C.WINDOW, p: float = C.SPLIT) -> list[str]:
    return [windows_cte(src, window, "lw"),
            f"""lw2 AS (SELECT *, CAST(date_trunc('day', target_time) AS TIMESTAMP) AS cyc,
                        hour(target_time) < {24 * p} AS tr FROM lw)""",
            f"""lc AS (SELECT cyc, CASE WHEN regr_sxx(y, w{window}) > 0 THEN regr_slope(y, w{window}) END AS b,
                             CASE WHEN regr_sxx(y, w{window}) > 0 THEN regr_intercept(y, w{window}) END AS a
                      FROM lw2 WHERE tr GROUP BY cyc)""",
            f"""loss AS (
  SELECT round(avg(CASE WHEN tr THEN e END), 6) AS train_loss,
         round(avg(CASE WHEN NOT tr THEN e END), 6) AS eval_loss,
         max(target_time) AS measurement_time
  FROM (SELECT lw2.cyc, tr, pow(y - CASE WHEN b IS NULL THEN w{window} ELSE a + b * w{window} END, 2) AS e, target_time
        FROM lw2 LEFT JOIN lc ON lw2.cyc = lc.cyc)
  GROUP BY cyc)"""]


def versions_ctes(n_versions: int = C.N_VERSIONS) -> list[str]:
    ctes = [READINGS]
    parts = []
    for v in range(1, n_versions + 1):
        ctes.append(f"""r{v} AS (SELECT * FROM readings WHERE measurement_time <=
            (SELECT max(measurement_time) FROM readings) + INTERVAL ({v - n_versions}) HOUR)""")
        ctes.append(D.replace("d AS (", f"d{v} AS (", 1).replace("FROM readings", f"FROM r{v}"))
        ctes += forecasts_ctes(f"d{v}", f"fc{v}")
        parts.append(f"SELECT *, {v} AS version FROM fc{v}")
    ctes.append("versions AS (" + " UNION ALL ".join(parts) + ")")
    return ctes


TEXT_RECORDS = """SELECT CAST(event_id AS VARCHAR) AS EventId, CAST(site_id AS VARCHAR) AS SiteId,
       CAST(vehicle_flow_rate AS VARCHAR) AS VehicleFlowRate, CAST(k AS VARCHAR) AS AverageVehicleSpeed,
       strftime(measurement_time, '%Y-%m-%dT%H:%M:%S') AS MeasurementTime,
       strftime(modified_time, '%Y-%m-%dT%H:%M:%S.%f') AS ModifiedTime,
       specific_lane AS SpecificLane, geometry AS Geometry, data_quality AS DataQuality
FROM readings"""


def strict_int(c: str, typ: str = "INTEGER") -> str:
    return f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST(trim({c}) AS {typ}) END"


def strict_float(c: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({c}), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN TRY_CAST(trim({c}) AS FLOAT) END")


COERCED = f"""SELECT {strict_int('EventId', 'BIGINT')} AS event_id, {strict_int('SiteId')} AS site_id,
       {strict_int('VehicleFlowRate')} AS vehicle_flow_rate, {strict_float('AverageVehicleSpeed')} AS average_vehicle_speed,
       TRY_CAST(MeasurementTime AS TIMESTAMP) AS measurement_time, TRY_CAST(ModifiedTime AS TIMESTAMP) AS modified_time,
       SpecificLane AS specific_lane, Geometry AS geometry, DataQuality AS data_quality
FROM ({TEXT_RECORDS})"""

# Text fields that are present but do not parse, and records without a key.
REJECTED = f"""(EventId IS NOT NULL AND {strict_int('EventId', 'BIGINT')} IS NULL)
  OR (SiteId IS NOT NULL AND {strict_int('SiteId')} IS NULL)
  OR (VehicleFlowRate IS NOT NULL AND {strict_int('VehicleFlowRate')} IS NULL)
  OR (AverageVehicleSpeed IS NOT NULL AND {strict_float('AverageVehicleSpeed')} IS NULL)
  OR (MeasurementTime IS NOT NULL AND TRY_CAST(MeasurementTime AS TIMESTAMP) IS NULL)
  OR (ModifiedTime IS NOT NULL AND TRY_CAST(ModifiedTime AS TIMESTAMP) IS NULL)
  OR {strict_int('SiteId')} IS NULL OR TRY_CAST(MeasurementTime AS TIMESTAMP) IS NULL"""

DAMAGED_TEXT = f"""SELECT * REPLACE (
    CASE WHEN n % 11 = 0 THEN VehicleFlowRate || '.0' ELSE VehicleFlowRate END AS VehicleFlowRate,
    CASE WHEN n % 13 = 0 THEN 'x1' ELSE SiteId END AS SiteId,
    CASE WHEN n % 17 = 0 THEN 'yesterday' ELSE MeasurementTime END AS MeasurementTime,
    CASE WHEN n % 19 = 0 THEN '1e3' ELSE CAST(n + 3000000000 AS VARCHAR) END AS EventId)
FROM (SELECT *, CAST(EventId AS BIGINT) AS n FROM ({TEXT_RECORDS}))"""


def coerced(text: str) -> str:
    return COERCED.replace(f"FROM ({TEXT_RECORDS})", f", ({REJECTED}) AS rejected FROM ({text})")


def calendar_list() -> str:
    return ", ".join(f"'{x}'" for x in C.CALENDAR)


def pivot_body(src: str, value: str) -> str:
    return f"""SELECT * FROM (PIVOT (
  SELECT site_id, strftime(measurement_time, '%Y-%m-%d %H:%M:%S') AS lbl, {value} AS vehicle_flow_rate
  FROM {src} WHERE measurement_time IS NOT NULL) ON lbl IN ({calendar_list()}) USING first(vehicle_flow_rate) GROUP BY site_id)"""


def ols_ctes(src: str, order: int = C.WINDOW, steps: int = C.STEPS, prefix: str = "ols") -> list[str]:
    """Pooled least squares of y on the lags w1..w<order> by Gaussian elimination
    of the centred normal equations, then the recursion, step by step."""
    names = [f"w{i}" for i in range(1, order + 1)]
    means = ", ".join(f"avg({n}) AS m_{n}" for n in [*names, "y"])
    k = len(names)
    cell = lambda i, j: f"a{i}_{j}"
    col = lambda j: "y" if j == k else names[j]
    sums = ", ".join(f"sum((f.{names[i]} - m_{names[i]}) * (f.{col(j)} - m_{col(j)})) AS {cell(i, j)}"
                     for i in range(k) for j in range(i, k + 1))
    ctes = [f"{prefix}_f AS (SELECT {', '.join(names)}, y FROM {src} WHERE y IS NOT NULL AND "
            + " AND ".join(f"{n} IS NOT NULL" for n in names) + ")",
            f"{prefix}_m AS (SELECT {means} FROM {prefix}_f)",
            f"{prefix}_e0 AS (SELECT {sums}, {', '.join(f'any_value(m_{n}) AS m_{n}' for n in [*names, 'y'])} "
            f"FROM {prefix}_f f, {prefix}_m)"]
    full = lambda i, j: cell(i, j) if i <= j else cell(j, i)
    for p in range(k - 1):  # eliminate column p below row p (symmetric)
        new = ", ".join(f"{cell(i, j)} - {cell(p, i)} * {cell(p, j)} / {cell(p, p)} AS {cell(i, j)}"
                        for i in range(p + 1, k) for j in range(i, k + 1))
        ctes.append(f"{prefix}_e{p + 1} AS (SELECT * REPLACE ({new}) FROM {prefix}_e{p})")
    prev = f"{prefix}_e{k - 1}"
    for i in reversed(range(k)):
        rest = "".join(f" - {full(i, j)} * b{j}" for j in range(i + 1, k))
        ctes.append(f"{prefix}_b{i} AS (SELECT *, ({cell(i, k)}{rest}) / {cell(i, i)} AS b{i} FROM {prev})")
        prev = f"{prefix}_b{i}"
    icpt = "m_y" + "".join(f" - b{i} * m_{names[i]}" for i in range(k))
    ctes.append(f"{prefix}_c AS (SELECT {', '.join(f'b{i}' for i in range(k))}, {icpt} AS b FROM {prev})")
    return ctes


def arp_ctes(src: str, order: int = C.WINDOW, steps: int = C.STEPS, prefix: str = "arp") -> list[str]:
    xs = ", ".join(f"max(v) FILTER (WHERE rn = {order - j}) AS x{j}" for j in range(order))
    ctes = [windows_cte(src, order, f"{prefix}_w"), *ols_ctes(f"{prefix}_w", order, steps, f"{prefix}_o"),
            latest(order, src, f"{prefix}_l"),
            f"""{prefix}_s0 AS (
  SELECT * FROM (SELECT site_id, max(measurement_time) AS last_time, count(*) AS n, max(v) FILTER (WHERE rn = 1) AS last_value,
                        {xs} FROM {prefix}_l GROUP BY site_id), {prefix}_o_c)"""]
    seq = [f"x{j}" for j in range(order)]
    for k in range(1, steps + 1):
        value = "b" + "".join(f" + b{i} * {x}" for i, x in enumerate(seq[-order:]))
        ctes.append(f"{prefix}_s{k} AS (SELECT *, CASE WHEN n >= {order} THEN {value} ELSE last_value END AS f{k} "
                    f"FROM {prefix}_s{k - 1})")
        seq.append(f"f{k}")
    out = " UNION ALL ".join(
        f"SELECT site_id, last_time + INTERVAL {k} MINUTE AS measurement_time, round(f{k}, 6) AS vehicle_flow_rate, "
        f"'arp' AS forecast_type FROM {prefix}_s{steps}" for k in range(1, steps + 1))
    return [*ctes, f"{prefix} AS ({out})"]


SITE_POINTS = """SELECT CAST(c_custkey AS INTEGER) AS site_id,
       TRY_CAST('59.' || lpad(CAST((c_custkey * 7919) % 100000 AS VARCHAR), 5, '0') AS DOUBLE) AS lat,
       TRY_CAST('18.' || lpad(CAST((c_custkey * 104729) % 100000 AS VARCHAR), 5, '0') AS DOUBLE) AS lon
FROM customer"""

SPLIT_BODY = f"""SELECT site_id, measurement_time, window_id, n_windows,
       CASE WHEN window_id < floor(n_windows * {C.SPLIT}) THEN 'train' ELSE 'eval' END AS split FROM win"""


def backtest(src: str) -> list[str]:
    return [windows_cte(src), f"""sw AS (SELECT *, CASE WHEN window_id < floor(n_windows * {C.SPLIT})
        THEN 'train' ELSE 'eval' END AS split FROM win)""",
            """co AS (SELECT site_id, CASE WHEN regr_sxx(y, w5) > 0 THEN regr_slope(y, w5) END AS b,
                  CASE WHEN regr_sxx(y, w5) > 0 THEN regr_intercept(y, w5) END AS a
           FROM sw WHERE split = 'train' GROUP BY site_id)"""]


BACKTEST_BODY = """SELECT sw.site_id, split, count(*) AS n_windows,
       round(avg(pow(y - (w1 + w2 + w3 + w4 + w5) / 5, 2)), 6) AS mse_moving_avg,
       round(avg(pow(y - CASE WHEN b IS NULL THEN w5 ELSE a + b * w5 END, 2)), 6) AS mse_ar1
FROM sw LEFT JOIN co ON sw.site_id = co.site_id GROUP BY sw.site_id, split"""

CHART = f"""SELECT site_id, {LABELS} AS type, forecast_type, {DISPLAY} AS display_name,
       {{x}} AS x, {{y}} AS y, CAST(count(*) AS INTEGER) AS n_points FROM fc GROUP BY ALL"""

MESSAGE_COLS = ("event_id, specific_lane, geometry, data_quality, vehicle_flow_rate, "
                "average_vehicle_speed, measurement_time, modified_time, site_id")


ORACLE: dict[str, str] = {
    "dedup_latest": sql(READINGS, D, body="SELECT * FROM d"),
    "latest_n_per_site": sql(READINGS, D, latest(C.HISTORY),
                             body="SELECT site_id, measurement_time, CAST(v AS INTEGER) AS vehicle_flow_rate, rn FROM l"),
    "ma_forecast": sql(READINGS, D, *ma_ctes("d"), body="SELECT * FROM ma"),
    "slot_stats": sql(READINGS, """s AS (
  SELECT measurement_time, round(avg(vehicle_flow_rate), 6) AS avg_vehicle_flow_rate,
         round(stddev_samp(vehicle_flow_rate), 6) AS std_vehicle_flow_rate
  FROM readings GROUP BY measurement_time)""",
        body="""SELECT r.* EXCLUDE (modified_time),
       CASE WHEN r.data_quality = 'good' THEN 1 ELSE 0 END AS data_quality_categorical,
       s.avg_vehicle_flow_rate, s.std_vehicle_flow_rate
FROM readings r LEFT JOIN s ON r.measurement_time = s.measurement_time"""),
    "quality_flag": sql(READINGS, body="""SELECT event_id, data_quality,
       CASE WHEN data_quality = 'good' THEN 1 ELSE 0 END AS data_quality_categorical FROM readings"""),
    "latest_slot": sql(READINGS, D, body="""SELECT site_id, max(measurement_time) AS latest_time, count(*) AS n_readings,
       (SELECT max(measurement_time) FROM d) AS overall_latest FROM d GROUP BY site_id"""),
    "site_filter": sql(READINGS, D, body=f"""SELECT * FROM d WHERE site_id IN (
  SELECT CAST(c_custkey AS INTEGER) FROM customer WHERE c_mktsegment = '{C.SITE_SEGMENT}')"""),
    "time_range_filter": sql(READINGS, body=f"""SELECT * FROM readings
WHERE measurement_time > TIMESTAMP '{C.RANGE_START:%Y-%m-%d %H:%M:%S}'
  AND measurement_time < TIMESTAMP '{C.RANGE_END:%Y-%m-%d %H:%M:%S}'"""),
    "bounded_limit": sql(READINGS, body=f"SELECT * FROM readings ORDER BY measurement_time, site_id, event_id LIMIT {C.N_SAMPLES}"),
    "batch_metrics": sql(READINGS, body="""SELECT CAST(measurement_time AS DATE) AS pull_date, count(*) AS n_rows,
       10 AS n_columns FROM readings GROUP BY 1"""),
    "impute_site_mean": sql(READINGS, D, *site_mean_grid("d"), body="SELECT * FROM grid"),
    "impute_slot_mean": sql(READINGS, D, body="""SELECT s.site_id, g.measurement_time,
       round(coalesce(x.v, g.m, 0), 6) AS vehicle_flow_rate, (x.v IS NULL) AS imputed
FROM (SELECT DISTINCT site_id FROM d WHERE measurement_time IS NOT NULL) s
CROSS JOIN (SELECT measurement_time, avg(CAST(vehicle_flow_rate AS DOUBLE)) AS m FROM d
            WHERE measurement_time IS NOT NULL GROUP BY measurement_time) g
LEFT JOIN (SELECT site_id, measurement_time, CAST(vehicle_flow_rate AS DOUBLE) AS v FROM d) x
  ON x.site_id = s.site_id AND x.measurement_time = g.measurement_time"""),
    "gap_census": sql(READINGS, D, *site_mean_grid("d"), body="""SELECT count(DISTINCT site_id) AS n_sites,
       count(DISTINCT measurement_time) AS n_slots, count(*) AS n_cells,
       CAST(count(*) FILTER (WHERE imputed) AS BIGINT) AS nulls_before,
       CAST(count(*) FILTER (WHERE vehicle_flow_rate IS NULL) AS BIGINT) AS nulls_after,
       CAST(count(*) FILTER (WHERE imputed) - count(*) FILTER (WHERE vehicle_flow_rate IS NULL) AS BIGINT) AS filled
FROM grid"""),
    "pivot_sites": sql(READINGS, D, body=pivot_body("d", "vehicle_flow_rate")),
    "pivot_strict": sql(READINGS, D, latest(C.HISTORY), body=pivot_body("l", "CAST(v AS INTEGER)")),
    "unpivot_sites": sql(READINGS, D, body=f"""SELECT s.site_id, g.measurement_time, CAST(x.vehicle_flow_rate AS DOUBLE) AS vehicle_flow_rate
FROM (SELECT DISTINCT site_id FROM d WHERE measurement_time IS NOT NULL) s
CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '{C.CALENDAR[0]}', TIMESTAMP '{C.CALENDAR[-1]}', INTERVAL 1 HOUR))
            AS measurement_time) g
LEFT JOIN d x ON x.site_id = s.site_id AND x.measurement_time = g.measurement_time"""),
    "recent_actuals": sql(READINGS, D, *site_mean_grid("d", keep_last=C.STEPS),
                          body="SELECT site_id, measurement_time, vehicle_flow_rate, 'actual' AS forecast_type FROM grid"),
    "eligible_sites": sql(READINGS, D, body=f"""SELECT site_id, count(DISTINCT measurement_time) AS n_slots FROM d
GROUP BY site_id HAVING count(DISTINCT measurement_time) >= {C.HISTORY}"""),
    "sliding_windows": sql(READINGS, D, *site_mean_grid("d"), windows_cte("grid"), body="SELECT * FROM win"),
    "sliding_windows_raw": sql(READINGS, D, windows_cte(), body="SELECT * FROM win"),
    "cross_site_windows": sql(READINGS, D, *site_mean_grid("d"), """idx AS (
  SELECT measurement_time, row_number() OVER (ORDER BY measurement_time) - 1 AS i, count(*) OVER () AS n
  FROM (SELECT DISTINCT measurement_time FROM grid))""", body=f"""SELECT w.window_id, idx.i - w.window_id + 1 AS step,
       CASE WHEN idx.i - w.window_id < {C.WINDOW} THEN 'input' ELSE 'label' END AS part,
       site_id, grid.measurement_time, vehicle_flow_rate
FROM grid JOIN idx ON grid.measurement_time = idx.measurement_time
JOIN (SELECT unnest(range(any_value(n) - {C.WINDOW})) AS window_id FROM idx) w
  ON idx.i BETWEEN w.window_id AND w.window_id + {C.WINDOW}"""),
    "train_eval_split": sql(READINGS, D, *site_mean_grid("d"), windows_cte("grid"), body=SPLIT_BODY),
    "train_eval_split_raw": sql(READINGS, D, windows_cte(), body=SPLIT_BODY),
    "ar1_forecast": sql(READINGS, D, *site_mean_grid("d"), *ar1_ctes("grid"), body="SELECT * FROM ar"),
    "ar1_forecast_raw": sql(READINGS, D, *ar1_ctes("d"), body="SELECT * FROM ar"),
    "arp_forecast": sql(READINGS, D, *site_mean_grid("d"), *arp_ctes("grid"), body="SELECT * FROM arp"),
    "backtest_mse": sql(READINGS, D, *site_mean_grid("d"), *backtest("grid"), body=BACKTEST_BODY),
    "backtest_mse_raw": sql(READINGS, D, *backtest("d"), body=BACKTEST_BODY),
    "chart_series": sql(*FC, body=CHART.format(x="list(epoch_us(measurement_time) ORDER BY measurement_time)",
                                               y="list(vehicle_flow_rate ORDER BY measurement_time)")),
    "chart_text": sql(*FC, body=CHART.format(
        x="string_agg(strftime(measurement_time, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY measurement_time)",
        y="string_agg(coalesce(CAST(CAST(vehicle_flow_rate AS DECIMAL(18, 6)) AS VARCHAR), ''), ',' ORDER BY measurement_time)")),
    "single_file_export": sql(*FC, body=f"""SELECT *, row_number() OVER (ORDER BY measurement_time, forecast_type) - 1 AS position,
  1::BIGINT AS n_files FROM fc WHERE site_id = {C.PULL_SITE}"""),
    "forecast_methods": sql(*FC, body="""SELECT fc.*, choice FROM fc JOIN (VALUES
  ('moving_avg', 'moving_avg'), ('moving_avg', 'actual'), ('ar1', 'ar1'), ('ar1', 'actual'), ('ar1+moving_avg', 'ar1'),
  ('ar1+moving_avg', 'moving_avg'), ('ar1+moving_avg', 'actual'), ('none', 'actual')) c(choice, kind)
  ON fc.forecast_type = c.kind"""),
    "missing_sites": sql(READINGS, body="""SELECT DISTINCT CAST(c_custkey AS INTEGER) AS site_id FROM customer
WHERE CAST(c_custkey AS INTEGER) NOT IN (SELECT site_id FROM readings WHERE site_id IS NOT NULL)"""),
    "map_points": f"""WITH p AS ({SITE_POINTS})
SELECT *, 'known' AS chosen FROM p WHERE site_id = {C.PULL_SITE} OR NOT EXISTS (SELECT 1 FROM p WHERE site_id = {C.PULL_SITE})
UNION ALL SELECT *, 'unknown' AS chosen FROM p UNION ALL SELECT *, 'none' AS chosen FROM p""",
    "pull_filter": sql(READINGS, body=f"""SELECT *, CAST(site_id % 4 + 1 AS INTEGER) AS region_id FROM readings
WHERE measurement_time > TIMESTAMP '{C.RANGE_START:%Y-%m-%d %H:%M:%S}' AND measurement_time < TIMESTAMP '{C.RANGE_END:%Y-%m-%d %H:%M:%S}'
  AND site_id % 4 + 1 = {C.PULL_REGION}
UNION ALL SELECT *, CAST(site_id % 4 + 1 AS INTEGER) AS region_id FROM readings
WHERE measurement_time > TIMESTAMP '{C.RANGE_START:%Y-%m-%d %H:%M:%S}' AND measurement_time < TIMESTAMP '{C.RANGE_END:%Y-%m-%d %H:%M:%S}'
  AND site_id = {C.PULL_SITE}"""),
    "forecast_horizon": sql(READINGS, D, body=f"""SELECT site_id, CAST(step AS INTEGER) AS step,
       last_time + step * INTERVAL 1 MINUTE AS measurement_time
FROM (SELECT site_id, max(measurement_time) AS last_time FROM d GROUP BY site_id)
CROSS JOIN generate_series(1, {C.STEPS}) AS g(step)"""),
    "forecast_union": sql(*FC, body="SELECT * FROM fc ORDER BY site_id, measurement_time, forecast_type"),
    "label_type": sql(*FC, body=f"SELECT *, {LABELS} AS type, {DISPLAY} AS display_name FROM fc"),
    "forecast_types": sql(*FC, body=f"SELECT DISTINCT site_id, forecast_type FROM fc WHERE {LABELS} = 'Prediction'"),
    "site_series": sql(*FC, body=f"""SELECT site_id, measurement_time, vehicle_flow_rate, {LABELS} AS type, forecast_type,
       row_number() OVER (PARTITION BY site_id, {LABELS}, forecast_type ORDER BY measurement_time) AS point_index FROM fc"""),
    "site_dim_join": sql(*FC, body="""SELECT fc.*, TRY_CAST(s.lat AS DOUBLE) AS lat, TRY_CAST(s.lon AS DOUBLE) AS lon
FROM fc LEFT JOIN (
  SELECT CAST(c_custkey AS INTEGER) AS site_id,
         '59.' || lpad(CAST((c_custkey * 7919) % 100000 AS VARCHAR), 5, '0') AS lat,
         '18.' || lpad(CAST((c_custkey * 104729) % 100000 AS VARCHAR), 5, '0') AS lon
  FROM customer) s ON fc.site_id = s.site_id"""),
    "parse_forecast_time": sql(*FC, body="""SELECT site_id, forecast_type, strftime(measurement_time, '%Y-%m-%d %H:%M:%S') AS time_text,
       try_strptime(strftime(measurement_time, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed_time,
       vehicle_flow_rate FROM fc"""),
    "forecast_dedup_last": sql(*versions_ctes(), body="""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY measurement_time, site_id, forecast_type ORDER BY version DESC) AS rn
  FROM versions) WHERE rn = 1"""),
    "loss_history": sql(READINGS, D, *loss_ctes(), body="SELECT * FROM loss"),
    "loss_iteration_rank": sql(READINGS, D, *loss_ctes(), body="""SELECT
  CAST(rank() OVER (ORDER BY measurement_time) + (count(*) OVER (PARTITION BY measurement_time) - 1) / 2.0 AS DOUBLE) AS iteration,
  train_loss, eval_loss, measurement_time FROM loss ORDER BY iteration"""),
    "coerce_types": sql(READINGS, body=coerced(DAMAGED_TEXT)),
    "rename_project": sql(READINGS, body="""SELECT event_id, site_id, vehicle_flow_rate, average_vehicle_speed,
       measurement_time, modified_time, specific_lane, geometry, data_quality FROM readings"""),
    "encode_json": sql(READINGS, body="""SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(site_id AS VARCHAR) AS site_id,
       CAST(vehicle_flow_rate AS VARCHAR) AS vehicle_flow_rate, CAST(average_vehicle_speed AS VARCHAR) AS average_vehicle_speed,
       strftime(measurement_time, '%Y-%m-%dT%H:%M:%S.%f') AS measurement_time,
       strftime(modified_time, '%Y-%m-%dT%H:%M:%S.%f') AS modified_time,
       data_quality, specific_lane FROM readings"""),
    "parse_json": sql(READINGS, body=f"SELECT {MESSAGE_COLS} FROM readings"),
    "ingest_xml": sql(READINGS, body=f"SELECT * EXCLUDE (rejected) FROM ({coerced(TEXT_RECORDS)}) WHERE NOT rejected"),
}


HISTORY_SQL = sql(READINGS, D, """s AS (
  SELECT measurement_time, round(avg(vehicle_flow_rate), 6) AS avg_vehicle_flow_rate,
         round(stddev_samp(vehicle_flow_rate), 6) AS std_vehicle_flow_rate
  FROM d GROUP BY measurement_time)""", body="""SELECT d.event_id, d.site_id, d.measurement_time, d.modified_time,
       d.vehicle_flow_rate, d.average_vehicle_speed, d.specific_lane, d.geometry, d.data_quality,
       s.avg_vehicle_flow_rate, s.std_vehicle_flow_rate,
       CASE WHEN d.data_quality = 'good' THEN 1 ELSE 0 END AS data_quality_categorical,
       CAST(d.measurement_time AS DATE) AS measurement_date
FROM d LEFT JOIN s ON d.measurement_time = s.measurement_time""")


def window_ctes(last: str, n_epochs: int) -> list[str]:
    """Epoch windows over ``cells`` (epoch, site_id, measurement_time, v): the
    newest reading wins, the window's grid is filled with its slot means."""
    return [f"""tagged AS (SELECT epoch, site_id, measurement_time, v,
                      unnest(generate_series(epoch - {n_epochs - 1}, epoch)) AS window_id FROM cells)""",
            f"""merged AS (
  SELECT window_id, site_id, measurement_time, arg_max(v, epoch) FILTER (WHERE v IS NOT NULL) AS v FROM tagged
  WHERE window_id >= 1 AND window_id <= {last} GROUP BY window_id, site_id, measurement_time)""",
            """wm AS (SELECT window_id, measurement_time, avg(v) AS m FROM merged GROUP BY window_id, measurement_time)"""]


WINDOW_BODY = """SELECT CAST(ws.window_id AS INTEGER) AS window_id, ws.site_id, wm.measurement_time,
       round(coalesce(x.v, wm.m, 0), 6) AS vehicle_flow_rate
FROM (SELECT DISTINCT window_id, site_id FROM merged) ws JOIN wm ON ws.window_id = wm.window_id
LEFT JOIN merged x ON x.window_id = ws.window_id AND x.site_id = ws.site_id AND x.measurement_time = wm.measurement_time"""

EPOCH_MERGE_SQL = sql(READINGS, """r0 AS (
  SELECT *, datediff('day', (SELECT min(CAST(modified_time AS DATE)) FROM readings), CAST(modified_time AS DATE)) AS epoch
  FROM readings WHERE measurement_time IS NOT NULL)""",
    """r AS (SELECT * FROM r0 UNION ALL
  SELECT * REPLACE (epoch + 1 AS epoch, CASE WHEN event_id % 2 = 0 THEN vehicle_flow_rate + 1 END AS vehicle_flow_rate)
  FROM r0 WHERE event_id % 5 = 0)""", """cells AS (
  SELECT epoch, site_id, measurement_time, CAST(vehicle_flow_rate AS DOUBLE) AS v FROM (
    SELECT *, row_number() OVER (PARTITION BY epoch, site_id, measurement_time
                                 ORDER BY modified_time DESC, event_id DESC) AS rn FROM r) WHERE rn = 1)""",
    *window_ctes(f"(SELECT max(epoch) - {C.N_EPOCHS - 1} FROM r0)", C.N_EPOCHS), body=WINDOW_BODY)

ORACLE.update({
    "upsert_merge": HISTORY_SQL,
    "stream_upsert": HISTORY_SQL,
    "stream_dedup": sql(READINGS, body="SELECT DISTINCT site_id, measurement_time FROM readings"),
    "stream_slot_stats": sql(READINGS, body="""SELECT measurement_time, round(avg(vehicle_flow_rate), 6) AS avg_vehicle_flow_rate,
       round(stddev_samp(vehicle_flow_rate), 6) AS std_vehicle_flow_rate, count(*) AS n_readings
FROM readings GROUP BY measurement_time"""),
    "stream_ingest": ORACLE["parse_json"],
    "versioned_read": sql(*versions_ctes(), body="SELECT * FROM versions"),
    "newest_version": sql(*versions_ctes(), body="SELECT max(version) AS version FROM versions"),
    "stream_accumulate": ORACLE["forecast_dedup_last"],
    "epoch_merge": EPOCH_MERGE_SQL,
})


def landed_ctes(n_files: int, overlap: float) -> list[str]:
    """The landing of events as delivery chunks (epoch = chunk), as
    ``streaming.jobs.land_events`` writes it."""
    return [f"""bounds AS (SELECT min(ts) AS lo, greatest((epoch_us(max(ts)) - epoch_us(min(ts))) // {n_files}, 1) AS span
                FROM events)""",
            """pos AS (SELECT e.*, (epoch_us(e.ts) - epoch_us(b.lo)) / b.span AS pos FROM events e, bounds b)""",
            f"""ch AS (SELECT * EXCLUDE (pos), pos, least(floor(pos), {n_files - 1}) AS chunk FROM pos)""",
            f"""landed AS (
  SELECT * EXCLUDE (pos, chunk), CAST(chunk AS INTEGER) AS epoch FROM ch
  UNION ALL
  SELECT * EXCLUDE (pos, chunk), CAST(chunk - 1 AS INTEGER) AS epoch FROM ch WHERE chunk > 0 AND pos - chunk < {overlap})""",
            READINGS.replace("SELECT event_id,", "SELECT epoch, event_id,", 1).replace("FROM events)", "FROM landed)"),
            """de AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY epoch, site_id, measurement_time
                                 ORDER BY modified_time DESC, event_id DESC) AS rn FROM readings) WHERE rn = 1)""",
            """cells AS (SELECT epoch, site_id, measurement_time, CAST(vehicle_flow_rate AS DOUBLE) AS v
             FROM de WHERE measurement_time IS NOT NULL)""",
            """sm AS (SELECT epoch, measurement_time, avg(v) AS m FROM cells GROUP BY epoch, measurement_time)""",
            """snap AS (
  SELECT ss.epoch, ss.site_id, sm.measurement_time, round(coalesce(c.v, sm.m, 0), 6) AS v
  FROM (SELECT DISTINCT epoch, site_id FROM cells) ss JOIN sm ON ss.epoch = sm.epoch
  LEFT JOIN cells c ON c.epoch = ss.epoch AND c.site_id = ss.site_id AND c.measurement_time = sm.measurement_time)"""]


def stream_window_sql(n_files: int, overlap: float, n_epochs: int) -> str:
    """As the batch merge, but the sites and slots of a window are those of its
    epochs' grids, and a snapshot keeps six decimals."""
    ctes = [c.replace("FROM cells)", "FROM snapped)") for c in window_ctes(str(n_files - n_epochs), n_epochs)]
    return sql(*landed_ctes(n_files, overlap), """snapped AS (
  SELECT s.epoch, s.site_id, s.measurement_time, round(c.v, 6) AS v FROM snap s
  LEFT JOIN cells c ON c.epoch = s.epoch AND c.site_id = s.site_id AND c.measurement_time = s.measurement_time)""",
               *ctes, body=WINDOW_BODY)


def stream_forecast_sql(n_files: int, overlap: float) -> str:
    """Version v = the forecast table over the history after epoch v - 1
    (newest delivery per key over chunks 0..v-1). In this landing every
    chunk moves the newest slot, so every epoch passes the new-data gate."""
    ctes = landed_ctes(n_files, overlap)[:5]
    parts = []
    for e in range(n_files):
        ctes.append(f"""h{e} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY site_id, measurement_time
                                 ORDER BY modified_time DESC, event_id DESC) AS rn
    FROM readings WHERE epoch <= {e}) WHERE rn = 1)""")
        ctes += forecasts_ctes(f"h{e}", f"fc{e}")
        parts.append(f"SELECT *, {e + 1} AS version FROM fc{e}")
    return sql(*ctes, body=" UNION ALL ".join(parts))


ORACLE.update({
    "stream_snapshots": sql(*landed_ctes(J.N_FILES, J.OVERLAP), body="""SELECT site_id, measurement_time,
       v AS vehicle_flow_rate, epoch FROM snap"""),
    "stream_epoch_window": stream_window_sql(J.N_FILES, J.OVERLAP, C.N_EPOCHS),
    "stream_forecast": stream_forecast_sql(J.N_FILES, J.OVERLAP),
})

