"""DuckDB SQL that gives the same rows as the registered queries.

Written from the definitions, on the whole given tables: plain windows over the
segment, row-numbered candidates, joins instead of in-row work.
"""

import re

ORACLES: dict[str, str] = {}

LAGS, WINDOWS = (1, 2, 3, 6, 12, 24), (4, 8, 12)
MEASURES = (
    ("speed", "speed_kmh"),
    ("volume", "volume_vehicles"),
    ("density", "density_vehicles_per_km"),
)
# Volume and speed factors of the demand pattern.
PATTERN = {
    "weekend": (0.6, 1.0), "morning": (1.8, 0.6), "evening": (2.0, 0.5),
    "midday": (1.2, 0.85), "night": (0.3, 1.0), "normal": (1.0, 0.9),
}
CLASSES = range(4)

BASE = """
road AS (
  SELECT DISTINCT user_id, printf('SEG_%04d', user_id) AS segment_id,
    CASE WHEN user_id%5=0 THEN 'highway' WHEN user_id%5<=2 THEN 'arterial' ELSE 'local' END AS road_type,
    CASE WHEN user_id%5=0 THEN 100::DOUBLE WHEN user_id%5<=2 THEN 60::DOUBLE ELSE 40::DOUBLE END AS speed_limit,
    0.5::DOUBLE*(1+user_id%6) AS length_km, (1+user_id%4)::BIGINT AS num_lanes,
    40.7128::DOUBLE+(user_id%21-10)::DOUBLE/100 AS latitude,
    -74.006::DOUBLE+(user_id%19-9)::DOUBLE/100 AS longitude,
    user_id%10<3 AS has_traffic_signal
  FROM events),
raw AS (
  SELECT r.*, e.ts AS timestamp, e.value AS speed,
    20*CAST(regexp_extract(e.props,'([0-9]+)',1) AS BIGINT) AS volume,
    e.event_type='error' AS has_accident,
    (isodow(e.ts)-1)::BIGINT AS dow, hour(e.ts)::BIGINT AS hr
  FROM events e JOIN road r ON e.user_id=r.user_id),
traffic AS (
  SELECT timestamp, segment_id, greatest(5::DOUBLE, least(speed, speed_limit)) AS speed_kmh,
    volume AS volume_vehicles,
    CASE WHEN speed>0 THEN volume/speed ELSE 0::DOUBLE END AS density_vehicles_per_km,
    CASE WHEN speed>0 THEN length_km/speed*60 ELSE 999::DOUBLE END AS travel_time_min,
    has_accident, dow AS day_of_week, hr AS hour, dow>=5 AS is_weekend,
    (hr>=7 AND hr<9) OR (hr>=17 AND hr<19) AS is_rush_hour
  FROM raw),
ratios AS (
  SELECT t.*, r.speed_limit, r.road_type, t.speed_kmh/r.speed_limit AS speed_ratio
  FROM traffic t LEFT JOIN road r ON t.segment_id=r.segment_id),
levels AS (
  SELECT *, CASE WHEN speed_ratio>=0.8::DOUBLE THEN 'Free Flow' WHEN speed_ratio>=0.6::DOUBLE THEN 'Moderate'
    WHEN speed_ratio>=0.4::DOUBLE THEN 'Heavy' ELSE 'Severe' END AS congestion_level
  FROM ratios),
labelled AS (
  SELECT *, (CASE congestion_level WHEN 'Free Flow' THEN 0 WHEN 'Moderate' THEN 1 WHEN 'Heavy' THEN 2
    ELSE 3 END)::BIGINT AS congestion_code
  FROM levels),
signal AS (
  SELECT printf('SIG_%03d', row_number() OVER (ORDER BY segment_id)-1) AS signal_id, segment_id,
    latitude, longitude, 120::BIGINT AS cycle_length, 50::BIGINT AS green_time_ns,
    50::BIGINT AS green_time_ew, 3::BIGINT AS yellow_time, 2::BIGINT AS all_red_time
  FROM road WHERE has_traffic_signal)"""

W = "(PARTITION BY segment_id ORDER BY timestamp)"
KEYS = "segment_id, epoch_us(timestamp) AS timestamp_us"


def r(expression: str, name: str) -> str:
    """Rounded like the registered results: to nine places, then half up to six."""
    return f"round(({expression})::DOUBLE::DECIMAL(38,9), 6)::DOUBLE AS {name}"


def rs(*names: str) -> str:
    return ", ".join(r(name, name) for name in names)


def define(name: str, body: str, *ctes: str) -> None:
    # RECURSIVE only allows recursion; plain CTEs mean the same.
    ORACLES[name] = "WITH RECURSIVE " + ",".join([BASE, *ctes]) + "\n" + body


def lag_list() -> list[tuple[str, str]]:
    return [
        (f"{name}_lag_{k}", f"lag({column}::DOUBLE, {k}) OVER {W}")
        for k in LAGS
        for name, column in MEASURES
    ]


def rolling_list() -> list[tuple[str, str]]:
    out = []
    for n in WINDOWS:
        frame = (
            "(PARTITION BY segment_id ORDER BY timestamp "
            f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        )
        out += [
            (f"speed_rolling_mean_{n}", f"avg(speed_kmh) OVER {frame}"),
            (f"speed_rolling_std_{n}", f"stddev_samp(speed_kmh) OVER {frame}"),
            (f"volume_rolling_max_{n}", f"max(volume_vehicles)::DOUBLE OVER {frame}"),
        ]
    return [(a, b.replace("::DOUBLE OVER", " OVER")) for a, b in out]


FEATURES = lag_list() + rolling_list()
FEATURE_NAMES = [name for name, _ in FEATURES]


def columns(pairs) -> str:
    return ", ".join(f"({sql})::DOUBLE AS {name}" for name, sql in pairs)


FEATURE_CTE = f"features AS (SELECT *, {columns(FEATURES)} FROM labelled)"
FILLED_CTE = (
    "forwarded AS (SELECT * REPLACE ("
    + ", ".join(
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY segment_id ORDER BY timestamp "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in FEATURE_NAMES
    )
    + ") FROM features), medians AS (SELECT "
    + ", ".join(f"median({c}) AS m_{c}" for c in FEATURE_NAMES)
    + " FROM forwarded), filled AS (SELECT f.* REPLACE ("
    + ", ".join(f"coalesce(f.{c}, m.m_{c}) AS {c}" for c in FEATURE_NAMES)
    + ") FROM forwarded f, medians m)"
)
CALENDAR = """year(timestamp)::BIGINT AS year, month(timestamp)::BIGINT AS month, day(timestamp)::BIGINT AS day,
  hour(timestamp)::BIGINT AS hour, minute(timestamp)::BIGINT AS minute, day_of_week,
  dayofyear(timestamp)::BIGINT AS day_of_year, weekofyear(timestamp)::BIGINT AS week_of_year"""
CYCLICAL = ", ".join(
    r(f"{f}(2*pi()*{column}/{period})", f"{name}_{f}")
    for name, column, period in (("hour", "hour", 24), ("dow", "day_of_week", 7))
    for f in ("sin", "cos")
)
FLAGS = "(day_of_week IN (5,6))::BIGINT AS is_weekend, is_rush_hour::BIGINT AS is_rush_hour"

# Sources

GRID = """panel AS (SELECT *, unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00',
  TIMESTAMP '{1} 00:00:00', INTERVAL 15 MINUTES)) AS timestamp FROM {0})"""


def draw(key: str, i: int) -> str:
    return f"('0x'||substr(md5({key}),{8 * i + 1},8))::BIGINT/4294967296::DOUBLE"


ROAD_KEY, PLACE_KEY = "'42road|'||segment_id", "'42place|'||segment_id"
SYNTH_ROAD = f"""synth_road AS (
  SELECT *, CASE road_type WHEN 'highway' THEN 100::DOUBLE WHEN 'arterial' THEN 60::DOUBLE
    ELSE 40::DOUBLE END AS speed_limit
  FROM (SELECT segment_id,
    CASE WHEN {draw(ROAD_KEY, 0)}<0.2::DOUBLE THEN 'highway'
      WHEN {draw(ROAD_KEY, 0)}<0.2::DOUBLE+0.4::DOUBLE THEN 'arterial' ELSE 'local' END AS road_type,
    0.5::DOUBLE+{draw(ROAD_KEY, 1)}*2.5::DOUBLE AS length_km,
    (CASE WHEN {draw(ROAD_KEY, 2)}<0.2::DOUBLE THEN 1 WHEN {draw(ROAD_KEY, 2)}<0.2::DOUBLE+0.4::DOUBLE THEN 2
      WHEN {draw(ROAD_KEY, 2)}<0.2::DOUBLE+0.4::DOUBLE+0.3::DOUBLE THEN 3 ELSE 4 END)::BIGINT AS num_lanes,
    40.7128::DOUBLE+(-0.1::DOUBLE+{draw(PLACE_KEY, 0)}*0.2::DOUBLE) AS latitude,
    -74.006::DOUBLE+(-0.1::DOUBLE+{draw(PLACE_KEY, 1)}*0.2::DOUBLE) AS longitude,
    {draw(ROAD_KEY, 3)}<0.3::DOUBLE AS has_traffic_signal
  FROM road))"""

define("dense_panel", f"SELECT {KEYS} FROM panel", GRID.format("road", "2024-06-30"))
define(
    "synth_road_network",
    f"""SELECT segment_id, road_type, num_lanes, has_traffic_signal,
    {rs("length_km", "latitude", "longitude", "speed_limit")} FROM synth_road""",
    SYNTH_ROAD,
)


def pattern(i: int) -> str:
    f = {name: f"{factors[i]}::DOUBLE" for name, factors in PATTERN.items()}
    return f"""(CASE WHEN dow>=5 THEN {f["weekend"]} WHEN hr>=7 AND hr<9 THEN {f["morning"]}
      WHEN hr>=17 AND hr<19 THEN {f["evening"]} WHEN hr>=10 AND hr<15 THEN {f["midday"]}
      WHEN hr>=22 OR hr<6 THEN {f["night"]} ELSE {f["normal"]} END)"""


BASE_SPEED = f"speed_limit*{pattern(1)}"
BASE_VOLUME = f"""(CASE road_type WHEN 'highway' THEN 1000::DOUBLE WHEN 'arterial' THEN 600::DOUBLE
  ELSE 300::DOUBLE END)*{pattern(0)}"""
NOISE_KEY = "'42|'||segment_id||'|'||epoch_us(timestamp)"

define(
    "traffic_pattern",
    f"SELECT {KEYS}, {r(BASE_SPEED, 'base_speed')}, {r(BASE_VOLUME, 'base_volume')} FROM raw",
)
define(
    "synth_readings",
    f"""SELECT {KEYS}, {r("greatest(5::DOUBLE, least(speed, speed_limit))", "speed_kmh")},
    trunc(greatest(0::DOUBLE, volume))::BIGINT AS volume_vehicles,
    {r("volume/speed", "density_vehicles_per_km")}, {r("length_km/speed*60", "travel_time_min")},
    accident AS has_accident, dow AS day_of_week, hr AS hour, dow>=5 AS is_weekend,
    (hr>=7 AND hr<9) OR (hr>=17 AND hr<19) AS is_rush_hour FROM noisy""",
    SYNTH_ROAD,
    GRID.format("synth_road", "2024-01-30"),
    f"""drawn AS (SELECT *, {draw(NOISE_KEY, 0)} AS u0, {draw(NOISE_KEY, 1)} AS u1,
      {draw(NOISE_KEY, 2)}<0.15::DOUBLE AS weather, {draw(NOISE_KEY, 3)}<0.001::DOUBLE AS accident,
      (isodow(timestamp)-1)::BIGINT AS dow, hour(timestamp)::BIGINT AS hr FROM panel)""",
    f"""noisy AS (SELECT *,
      {BASE_SPEED}*(0.9::DOUBLE+u0*(1.1::DOUBLE-0.9::DOUBLE))*(CASE WHEN weather THEN 0.7::DOUBLE ELSE 1 END)
        *(CASE WHEN accident THEN 0.3::DOUBLE ELSE 1 END) AS speed,
      {BASE_VOLUME}*(0.8::DOUBLE+u1*(1.2::DOUBLE-0.8::DOUBLE))*(CASE WHEN weather THEN 1.3::DOUBLE ELSE 1 END)
        *(CASE WHEN accident THEN 1.5::DOUBLE ELSE 1 END) AS volume
      FROM drawn)""",
)
TRAFFIC = f"""{KEYS}, volume_vehicles, has_accident, day_of_week, hour, is_weekend, is_rush_hour,
  {rs("speed_kmh", "density_vehicles_per_km", "travel_time_min")}"""
define("derived_measures", f"SELECT {TRAFFIC} FROM traffic")
define(
    "save_load_tables",
    f"SELECT {TRAFFIC} FROM traffic",
)
define("rush_hour_flag", f"SELECT {KEYS}, is_rush_hour FROM traffic")
define(
    "build_signals",
    f"""SELECT signal_id, segment_id, cycle_length, green_time_ns, green_time_ew, yellow_time,
    all_red_time, {rs("latitude", "longitude")} FROM signal ORDER BY segment_id LIMIT 30""",
)

# Projections and filters

define("speed_ratio", f"SELECT {KEYS}, {rs('speed_ratio')} FROM labelled")
define("congestion_level", f"SELECT {KEYS}, congestion_level FROM labelled")
define("congestion_code", f"SELECT {KEYS}, congestion_code FROM labelled")
define("calendar_features", f"SELECT {KEYS}, {CALENDAR} FROM traffic")
define("cyclical_features", f"SELECT {KEYS}, {CYCLICAL} FROM traffic")
define("weekend_flag", f"SELECT {KEYS}, {FLAGS} FROM traffic")
define(
    "segment_filter",
    f"""SELECT {KEYS}, {rs("speed_kmh")} FROM traffic
    WHERE segment_id IN ('SEG_0001', 'SEG_0005', 'SEG_0012')""",
)
define(
    "signal_segments",
    f"""SELECT segment_id, road_type, num_lanes, has_traffic_signal,
    {rs("speed_limit", "length_km", "latitude", "longitude")} FROM road WHERE has_traffic_signal""",
)
define(
    "feature_projection",
    f"""SELECT {KEYS}, volume_vehicles, {rs("density_vehicles_per_km")}, {CALENDAR}, {FLAGS}, road_type,
    {CYCLICAL}, congestion_code AS label FROM labelled""",
)
COLOR = """CASE congestion_level WHEN 'Free Flow' THEN 'green' WHEN 'Moderate' THEN 'orange'
  WHEN 'Heavy' THEN 'red' WHEN 'Severe' THEN 'darkred' ELSE 'gray' END AS color"""
STATUS = """segment_id||': Speed '||round(speed_kmh::DECIMAL(18,2),1)::VARCHAR||' km/h, Volume '
  ||volume_vehicles::VARCHAR||' veh/h, Status '||congestion_level AS status"""
define("status_color", f"SELECT {KEYS}, {COLOR} FROM labelled")
define("status_text", f"SELECT {KEYS}, {STATUS} FROM labelled")

# Joins

define(
    "label_join",
    f"SELECT {KEYS}, {rs('speed_kmh', 'speed_limit')}, road_type, congestion_code FROM labelled",
)
define(
    "roadtype_join",
    f"""SELECT t.segment_id, epoch_us(t.timestamp) AS timestamp_us, t.volume_vehicles, r.road_type
    FROM traffic t JOIN road r ON t.segment_id=r.segment_id""",
)
LATEST = """latest AS (SELECT segment_id, max(timestamp) AS timestamp, {speed} AS speed_kmh,
  arg_max(volume_vehicles, timestamp) AS volume_vehicles,
  arg_max(congestion_level, timestamp) AS congestion_level FROM labelled GROUP BY segment_id)"""
LAST_SPEED = "arg_max(speed_kmh, timestamp)"
define(
    "map_status",
    f"""SELECT segment_id, {rs("speed_kmh", "latitude", "longitude")}, volume_vehicles, congestion_level,
    {COLOR}, {STATUS} FROM latest JOIN road USING (segment_id)""",
    LATEST.format(speed=LAST_SPEED),
)


def peak(value: str, name: str) -> str:
    return (
        f"CASE WHEN sum(is_rush_hour::INT)>0 THEN avg(CASE WHEN is_rush_hour THEN {value} END) "
        f"ELSE avg({value}) END AS {name}"
    )


PEAK = f"""peak AS (SELECT segment_id, {peak("volume_vehicles", "avg_volume")},
  {peak("speed_kmh", "avg_speed")}, {peak("density_vehicles_per_km", "avg_density")},
  {peak("(congestion_code>=2)::INT", "congested_share")} FROM labelled GROUP BY segment_id)"""
PEAK_COLUMNS = rs("avg_volume", "avg_speed", "avg_density", "congested_share")
define(
    "signal_metrics_join",
    f"SELECT signal_id, segment_id, {PEAK_COLUMNS} FROM signal JOIN peak USING (segment_id)",
    PEAK,
)
define(
    "signals_without_data",
    """SELECT signal_id, segment_id FROM (
      SELECT printf('SIG_%03d', row_number() OVER (ORDER BY segment_id)-1) AS signal_id, segment_id
      FROM (SELECT DISTINCT printf('SEG_%04d', c_custkey) AS segment_id FROM customer
        WHERE c_custkey%10<3))
    WHERE segment_id NOT IN (SELECT segment_id FROM traffic)""",
)

# Aggregations

define(
    "level_distribution",
    f"""SELECT congestion_level, count(*) AS rows,
    {r("count(*)::DOUBLE/(SELECT count(*) FROM labelled)", "share")} FROM labelled GROUP BY 1""",
)
define(
    "volume_by_road_type",
    f"""SELECT r.road_type, {r("avg(t.volume_vehicles)", "avg_volume")}
    FROM traffic t JOIN road r ON t.segment_id=r.segment_id GROUP BY 1""",
)
define(
    "hourly_profile",
    f"""SELECT hour, {r("avg(speed_kmh)", "avg_speed")}, {r("avg(volume_vehicles)", "avg_volume")}
    FROM traffic GROUP BY hour""",
)
STATS = f"""stats AS (SELECT segment_id, {r("avg(speed_kmh)", "avg_speed")},
  {r("avg(volume_vehicles)", "avg_volume")}, max(volume_vehicles)::BIGINT AS peak_volume,
  {r("avg((congestion_code>=2)::INT)*100", "congested_pct")} FROM {{0}} GROUP BY segment_id)"""
define("segment_stats", "SELECT * FROM stats", STATS.format("labelled"))
define(
    "hotspots",
    "SELECT * FROM stats ORDER BY congested_pct DESC, segment_id LIMIT 10",
    STATS.format("labelled"),
)
define(
    "congested_share", f"SELECT {r('avg((congestion_code>=2)::INT)', 'congested_share')} FROM labelled"
)
define("peak_metrics", f"SELECT segment_id, {PEAK_COLUMNS} FROM peak", PEAK)
LATEST_COLUMNS = f"{KEYS}, {rs('speed_kmh')}, volume_vehicles, congestion_level"
define(
    "latest_per_segment",
    f"SELECT {LATEST_COLUMNS} FROM latest",
    LATEST.format(speed=LAST_SPEED),
)
define(
    "latest_row_per_segment",
    f"""SELECT {LATEST_COLUMNS} FROM labelled
    QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY timestamp DESC)=1""",
)
define(
    "dataset_counts",
    """SELECT (SELECT count(*) FROM road) AS segments, (SELECT count(*) FROM signal) AS signals,
    (SELECT count(*) FROM traffic) AS readings,
    (SELECT count(DISTINCT segment_id) FROM traffic) AS observed_segments""",
)
define("distinct_segments", "SELECT DISTINCT segment_id FROM traffic")

LABELLED_NAMES = [
    "segment_id", "timestamp", "speed_kmh", "volume_vehicles", "density_vehicles_per_km",
    "travel_time_min", "has_accident", "day_of_week", "hour", "is_weekend", "is_rush_hour",
    "speed_limit", "road_type", "speed_ratio", "congestion_level", "congestion_code",
]
NULLS = [f"count(*) FILTER (WHERE {c} IS NULL)" for c in [*LABELLED_NAMES, *FEATURE_NAMES]]
define(
    "null_report",
    "SELECT "
    + ", ".join(f"{sql} AS {c}" for sql, c in zip(NULLS, [*LABELLED_NAMES, *FEATURE_NAMES]))
    + ", "
    + "+".join(NULLS)
    + " AS total FROM features",
    FEATURE_CTE,
)
define("median_fill", f"SELECT {KEYS}, {rs(*FEATURE_NAMES)} FROM filled", FEATURE_CTE, FILLED_CTE)
define(
    "processed_features",
    f"""SELECT {KEYS}, {rs("speed_kmh", "density_vehicles_per_km", "travel_time_min")}, volume_vehicles,
    has_accident, {rs("speed_limit", "speed_ratio")}, road_type, congestion_level, congestion_code,
    {CALENDAR}, {CYCLICAL}, {FLAGS}, {rs(*FEATURE_NAMES)} FROM filled""",
    FEATURE_CTE,
    FILLED_CTE,
)
define("map_center", f"SELECT {r('avg(latitude)', 'latitude')}, {r('avg(longitude)', 'longitude')} FROM road")
define(
    "hour_heatmap",
    "SELECT segment_id, "
    + ", ".join(
        r(f"avg((congestion_code>=2)::INT) FILTER (WHERE hour={h})*100", f"h{h:02d}")
        for h in range(24)
    )
    + " FROM labelled GROUP BY segment_id",
)

# Windows and splits

define("lag_features", f"SELECT {KEYS}, {rs(*[n for n, _ in lag_list()])} FROM features", FEATURE_CTE)
ORACLES["stored_lag_features"] = ORACLES["lag_features"]
define(
    "merged_sketches",
    """SELECT (epoch(date_trunc('day', timestamp))/86400)::BIGINT AS day, count(*) AS rows,
    count(DISTINCT segment_id) AS segments, TRUE AS count_in_bound, TRUE AS medians_in_bound
    FROM traffic GROUP BY 1""",
)
for kind in ("mean", "std", "max"):
    names = [n for n, _ in rolling_list() if kind in n]
    define(f"rolling_{kind}", f"SELECT {KEYS}, {rs(*names)} FROM features", FEATURE_CTE)
define(
    "forward_fill",
    f"SELECT {KEYS}, "
    + ", ".join(
        r(
            f"last_value({c} IGNORE NULLS) OVER "
            "(PARTITION BY segment_id ORDER BY timestamp "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
            c,
        )
        for c in FEATURE_NAMES
    )
    + " FROM features",
    FEATURE_CTE,
)


def speeds(first: int, last: int) -> str:
    sides = [f"{abs(k)} {'PRECEDING' if k < 0 else 'FOLLOWING'}" for k in (first, last)]
    return (
        "array_to_string(list(speed_kmh::VARCHAR) OVER (PARTITION BY segment_id "
        f"ORDER BY timestamp ROWS BETWEEN {sides[0]} AND {sides[1]}), ',')"
    )


define(
    "supervised_windows",
    f"""SELECT {KEYS}, x, y, CASE WHEN i-24 < floor((n-28)*0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
    FROM windows WHERE i>=24 AND i<n-4""",
    f"""windows AS (SELECT segment_id, timestamp, {speeds(-24, -1)} AS x, {speeds(0, 3)} AS y,
      row_number() OVER {W}-1 AS i, count(*) OVER (PARTITION BY segment_id) AS n FROM traffic)""",
)
CUTS = """CASE WHEN i<floor(n*(1::DOUBLE-0.2::DOUBLE-0.1::DOUBLE)) THEN 'train'
  WHEN i<floor(n*(1::DOUBLE-0.2::DOUBLE)) THEN 'val' ELSE 'test' END AS split"""
POSITIONAL = f"""in_order AS (SELECT *, {CUTS} FROM (SELECT segment_id, timestamp,
  row_number() OVER (ORDER BY segment_id, timestamp)-1 AS i, count(*) OVER () AS n FROM traffic))"""
TEMPORAL = f"""temporal AS (SELECT *, {CUTS} FROM (SELECT *,
  row_number() OVER {W}-1 AS i, count(*) OVER (PARTITION BY segment_id) AS n FROM labelled))"""
HISTORY = f"""history AS (SELECT *, CASE WHEN i<floor(0.8::DOUBLE*n) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, speed_kmh AS actual, lag(speed_kmh) OVER {W} AS lag_1,
    row_number() OVER {W}-1 AS i, count(*) OVER (PARTITION BY segment_id) AS n FROM labelled))"""
SPLIT_KEY = "'42split|'||segment_id||'|'||epoch_us(timestamp)"
define("positional_split", f"SELECT {KEYS}, split FROM in_order", POSITIONAL)
define("temporal_split", f"SELECT {KEYS}, split FROM temporal", TEMPORAL)
define("series_split", f"SELECT {KEYS}, split FROM history", HISTORY)
define("split_counts", "SELECT split, count(*) AS rows FROM in_order GROUP BY split", POSITIONAL)
define(
    "random_split",
    f"""SELECT {KEYS}, CASE WHEN {draw(SPLIT_KEY, 0)}<0.2::DOUBLE THEN 'test'
    WHEN {draw(SPLIT_KEY, 0)}<0.2::DOUBLE+0.1::DOUBLE THEN 'val' ELSE 'train' END AS split FROM traffic""",
)
define(
    "encode_road_type",
    f"""SELECT {KEYS}, (CASE road_type WHEN 'highway' THEN 0 WHEN 'arterial' THEN 1 WHEN 'local' THEN 2
    END)::BIGINT AS road_type_code, (road_type='highway')::BIGINT AS is_highway,
    (road_type='arterial')::BIGINT AS is_arterial, (road_type='local')::BIGINT AS is_local FROM labelled""",
)
SCALED = ("speed_kmh", "volume_vehicles", "density_vehicles_per_km", "hour")
define(
    "standard_scale",
    f"SELECT {KEYS}, split, "
    + ", ".join(r(f"({c}-m_{c})/CASE d_{c} WHEN 0 THEN 1 ELSE d_{c} END", c) for c in SCALED)
    + " FROM temporal, statistics",
    TEMPORAL,
    "statistics AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in SCALED)
    + " FROM temporal WHERE split='train')",
)

# Classification

CENTERS = (0.9, 0.7, 0.5, 0.2)
RULES = (
    "rules AS ("
    + " UNION ALL ".join(
        f"""SELECT segment_id, timestamp, 'rule_lag_{k}' AS model, congestion_code AS label,
        (CASE WHEN ratio>=0.8::DOUBLE THEN 0 WHEN ratio>=0.6::DOUBLE THEN 1
          WHEN ratio>=0.4::DOUBLE THEN 2 ELSE 3 END)::BIGINT AS prediction, ratio
        FROM (SELECT *, lag(speed_kmh, {k}) OVER {W}/speed_limit AS ratio FROM labelled)
        WHERE ratio IS NOT NULL"""
        for k in (1, 2, 4)
    )
    + ")"
)
CLASS_CTE = """classes AS (SELECT model, k, count(*) AS n, count(*) FILTER (WHERE label=k) AS support,
    count(*) FILTER (WHERE prediction=k) AS predicted,
    count(*) FILTER (WHERE label=k AND prediction=k) AS hits
  FROM rules, (SELECT unnest([0,1,2,3]) AS k) GROUP BY model, k),
scores AS (SELECT *, CASE WHEN predicted>0 THEN hits/predicted ELSE 0 END AS p,
    CASE WHEN support>0 THEN hits/support ELSE 0 END AS rc,
    CASE WHEN support+predicted>0 THEN 2*hits/(support+predicted) ELSE 0 END AS f1 FROM classes),
models AS (SELECT model, sum(hits)/any_value(n) AS accuracy, sum(p*support)/sum(support) AS precision,
    sum(rc*support)/sum(support) AS recall, sum(f1*support)/sum(support) AS f1_score
  FROM scores GROUP BY model)"""
MODEL_SCORES = ("accuracy", "precision", "recall", "f1_score")
define("rule_classifier", f"SELECT {KEYS}, model, label, prediction FROM rules", RULES)
define(
    "classification_metrics", f"SELECT model, {rs(*MODEL_SCORES)} FROM models", RULES, CLASS_CTE
)
define(
    "confusion_matrix",
    "SELECT k::BIGINT AS label, "
    + ", ".join(f"count(*) FILTER (WHERE label=k AND prediction={j}) AS pred_{j}" for j in CLASSES)
    + " FROM rules, (SELECT unnest([0,1,2,3]) AS k) WHERE model='rule_lag_1' GROUP BY k",
    RULES,
)
define(
    "class_report",
    f"""SELECT ['Free Flow','Moderate','Heavy','Severe'][k+1] AS class, {r("p", "precision")},
      {r("rc", "recall")}, {r("f1", "f1_score")}, support::BIGINT AS support FROM scores WHERE model='rule_lag_1'
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(rc), 6), round(avg(f1), 6),
      sum(support)::BIGINT FROM scores WHERE model='rule_lag_1'
    UNION ALL SELECT 'weighted avg', round(sum(p*support)/sum(support), 6),
      round(sum(rc*support)/sum(support), 6), round(sum(f1*support)/sum(support), 6),
      sum(support)::BIGINT FROM scores WHERE model='rule_lag_1'""",
    RULES,
    CLASS_CTE,
)
define(
    "metric_unpivot",
    " UNION ALL ".join(
        f"SELECT model, '{label}' AS metric, {r(name, 'score')} FROM models"
        for name, label in zip(MODEL_SCORES, ("Accuracy", "Precision", "Recall", "F1 Score"))
    ),
    RULES,
    CLASS_CTE,
)
define(
    "best_model",
    f"SELECT model, {rs('accuracy')} FROM models ORDER BY models.accuracy DESC, model LIMIT 1",
    RULES,
    CLASS_CTE,
)
SHIFTED = [
    (name, re.sub(r"ROWS BETWEEN (\d+) PRECEDING AND CURRENT ROW",
                  lambda m: f"ROWS BETWEEN {int(m[1]) + 1} PRECEDING AND 1 PRECEDING", sql))
    for name, sql in FEATURES
]
define(
    "training_table",
    f"""SELECT {KEYS}, split, congestion_code AS label, {rs(*FEATURE_NAMES)} FROM earlier
    WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FEATURE_NAMES)}""",
    TEMPORAL,
    f"earlier AS (SELECT *, {columns(SHIFTED)} FROM temporal)",
)
SCORES = ", ".join(f"1/(1+abs(ratio-{c}::DOUBLE))" for c in CENTERS)
define(
    "argmax",
    f"""SELECT {KEYS}, model, list_position(scores, list_max(scores))::BIGINT-1 AS best
    FROM (SELECT *, [{SCORES}] AS scores FROM rules)""",
    RULES,
)
LABELLED_SCORE = " ".join(f"WHEN {k} THEN 1/(1+abs(ratio-{c}::DOUBLE))" for k, c in enumerate(CENTERS))
define(
    "log_loss",
    f"""SELECT model, count(*) AS rows, {r("avg(-ln(own/total))", "log_loss")} FROM (
      SELECT model, CASE label {LABELLED_SCORE} END AS own, {SCORES.replace(", ", "+")} AS total
      FROM rules) GROUP BY model""",
    RULES,
)
define(
    "predicted_rows",
    f"""SELECT {KEYS}, model, congestion_code AS label, TRUE AS valid FROM earlier,
    (SELECT unnest(['random_forest', 'boosted_trees', 'neural_network']) AS model)
    WHERE split='test' AND {" AND ".join(f"{c} IS NOT NULL" for c in FEATURE_NAMES)}""",
    TEMPORAL,
    f"earlier AS (SELECT *, {columns(SHIFTED)} FROM temporal)",
)
define(
    "auc_ovr_weighted",
    f"""SELECT model, {r("sum(wins/(p*n)*p)/sum(p)", "auc")} FROM (
      SELECT model, k, sum(pos*(below+neg/2)) AS wins, sum(pos)::DOUBLE AS p, sum(neg)::DOUBLE AS n
      FROM ranked GROUP BY model, k) GROUP BY model""",
    RULES,
    "each AS ("
    + " UNION ALL ".join(
        f"SELECT model, label, {k} AS k, 1/(1+abs(ratio-{c}::DOUBLE)) AS score FROM rules"
        for k, c in enumerate(CENTERS)
    )
    + ")",
    """counted AS (SELECT model, k, score, count(*) FILTER (WHERE label=k) AS pos,
      count(*) FILTER (WHERE label<>k) AS neg FROM each GROUP BY model, k, score)""",
    """ranked AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, k ORDER BY score
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM counted)""",
)

# Forecasts

define("rename_ds_y", f"SELECT segment_id, epoch_us(timestamp) AS ds_us, {r('speed_kmh', 'y')} FROM traffic")
FORECAST = f"{KEYS}, {rs('actual', 'forecast')}"
PROFILE = """slots AS (SELECT segment_id, day_of_week, hour, avg(actual) AS slot_mean FROM history
  WHERE split='train' GROUP BY ALL),
overall AS (SELECT segment_id, avg(actual) AS overall FROM history WHERE split='train' GROUP BY ALL),
profile AS (SELECT h.segment_id, h.timestamp, h.actual, coalesce(s.slot_mean, o.overall) AS forecast
  FROM history h LEFT JOIN slots s USING (segment_id, day_of_week, hour)
  LEFT JOIN overall o USING (segment_id) WHERE h.split='test')"""
AR1 = """lines AS (SELECT segment_id, regr_slope(actual, lag_1) AS slope,
  regr_intercept(actual, lag_1) AS intercept FROM history WHERE split='train' GROUP BY segment_id),
ar1 AS (SELECT h.segment_id, h.timestamp, h.actual, intercept+slope*lag_1 AS forecast
  FROM history h JOIN lines USING (segment_id) WHERE split='test')"""
NAIVE = """naive AS (SELECT segment_id, timestamp, actual, lag_1 AS forecast FROM history WHERE split='test')"""
ERRORS = f"""count(*) AS n, {r("sqrt(avg((actual-forecast)**2))", "rmse")},
  {r("avg(abs(actual-forecast))", "mae")}, {r("avg(abs((actual-forecast)/actual))*100", "mape")},
  {r("1-sum((actual-forecast)**2)/(var_pop(actual)*count(*))", "r2")}"""
define("seasonal_naive", f"SELECT {FORECAST} FROM naive", HISTORY, NAIVE)
define("seasonal_profile", f"SELECT {FORECAST} FROM profile", HISTORY, PROFILE)
define("ar1_per_segment", f"SELECT {FORECAST} FROM ar1", HISTORY, AR1)
define("forecast_metrics", f"SELECT {ERRORS} FROM ar1", HISTORY, AR1)
AHEAD = """CASE WHEN slope=1 THEN last+h*intercept
  ELSE intercept/(1-slope)+pow(slope, h)*(last-intercept/(1-slope)) END AS forecast"""
SPAN = f"""lasts AS (SELECT segment_id, max(i) AS last_i, arg_max(actual, i) AS last FROM history
  WHERE split='train' GROUP BY segment_id),
span AS (SELECT segment_id, timestamp, actual, {AHEAD} FROM (
  SELECT h.*, l.slope, l.intercept, s.last, h.i-s.last_i AS h FROM history h
  JOIN lines l USING (segment_id) JOIN lasts s USING (segment_id) WHERE split='test'))"""
define("ar1_span", f"SELECT {FORECAST} FROM span", HISTORY, AR1, SPAN)
define(
    "ar1_future",
    f"""SELECT {KEYS}, h AS step, {r("forecast", "forecast")} FROM (
      SELECT *, {AHEAD} FROM (SELECT segment_id, max(timestamp)+to_minutes(15*h) AS timestamp, h,
        arg_max(speed_kmh, timestamp) AS last
        FROM traffic, (SELECT unnest([1::BIGINT, 2, 3, 4]) AS h) GROUP BY segment_id, h)
      JOIN lines USING (segment_id))""",
    HISTORY,
    AR1,
)
def least_squares(features: list[str], targets: list[str], train: str) -> list[str]:
    """CTEs from ``ls`` (features, targets) to ``fitted``, with a ``p_`` column per target.

    Takes out the training means, then one feature after another from the later features
    and the targets; what a target loses on the way is its prediction.
    """
    known = " AND ".join(f"{c} IS NOT NULL" for c in [*features, *targets])
    on_train = f"WHERE {train} AND {known}"
    both = [*features, *targets]
    means = ", ".join(f"avg({c}) AS {c}" for c in both)
    out = [
        f"ls_m AS MATERIALIZED (SELECT {means} FROM ls {on_train})",
        "ls_0 AS MATERIALIZED (SELECT l.* REPLACE ("
        + ", ".join(f"l.{c}-m.{c} AS {c}" for c in both)
        + "), "
        + ", ".join(f"m.{c} AS p_{c}" for c in targets)
        + " FROM ls l, ls_m m)",
    ]
    for k, x in enumerate(features):
        rest = [*features[k + 1 :], *targets]
        shares = ", ".join(f"sum({x}*{c})/sum({x}*{x}) AS {c}" for c in rest)
        change = [f"l.{c}-s.{c}*l.{x} AS {c}" for c in rest]
        change += [f"l.p_{c}+s.{c}*l.{x} AS p_{c}" for c in targets]
        out.append(f"ls_s{k} AS MATERIALIZED (SELECT {shares} FROM ls_{k} {on_train})")
        out.append(
            f"ls_{k + 1} AS MATERIALIZED (SELECT l.* REPLACE ({', '.join(change)})"
            f" FROM ls_{k} l, ls_s{k} s)"
        )
    out.append(f"fitted AS (SELECT * FROM ls_{len(features)})")
    return out


def sums_of_products(name: str, columns: list[str], source: str) -> str:
    """CTE of one row with the sums g_i_j, i <= j, of the products of the columns."""
    sums = ", ".join(
        f"sum(({a})*({b}))::DOUBLE AS g_{i}_{j}"
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if i <= j
    )
    return f"{name} AS MATERIALIZED (SELECT {sums} FROM {source})"


def eliminated(name: str, sums: str, n: int, penalties: dict[int, str] | None = None) -> list[str]:
    """CTEs that solve for the first ``n`` columns of ``sums`` against the next one.

    The matrix is one list; each step of a recursion clears one column in all other rows.
    ``{name}`` has the coefficients b_0 and so on, and ``rest``, what they leave of the
    target's squares. ``penalties`` are added to squares.
    """
    size = n + 1
    cells = [
        f"g_{min(i, j)}_{max(i, j)}" + (f"+{penalties[i]}" if penalties and i == j and i < n else "")
        for i in range(size)
        for j in range(size)
    ]
    at = lambda i, j: f"g[({i})*{size}+({j})+1]"
    cleared = (
        f"list_transform(range({size * size}), lambda q: CASE WHEN q//{size}=k THEN g[q+1] ELSE"
        f" g[q+1]-{at(f'q//{size}', 'k')}*{at('k', f'q%{size}')}/{at('k', 'k')} END)"
    )
    solved = ", ".join(f"{at(i, n)}/{at(i, i)} AS b_{i}" for i in range(n))
    return [
        f"{name}_steps AS (SELECT 0 AS k, [{', '.join(cells)}] AS g FROM {sums}"
        f" UNION ALL SELECT k+1, {cleared} FROM {name}_steps WHERE k<{n})",
        f"{name} AS MATERIALIZED (SELECT {solved}, {at(n, n)} AS rest FROM {name}_steps WHERE k={n})",
    ]


# The order by autocorrelation: Levinson's recursion written out, one CTE an order.
MOST = 5
COVARIANCES = (
    "pairs AS (SELECT *, "
    + ", ".join(f"lag(actual, {k}) OVER {W} AS back_{k}" for k in range(1, MOST + 1))
    + " FROM history), means AS (SELECT segment_id, avg(actual) AS mean FROM history"
    + " WHERE split='train' GROUP BY segment_id), cov AS (SELECT segment_id, any_value(mean) AS mean,"
    + " count(actual) AS n, sum((actual-mean)**2)/count(actual) AS c_0, "
    + ", ".join(
        f"coalesce(sum((actual-mean)*(back_{k}-mean))/count(actual), 0) AS c_{k}"
        for k in range(1, MOST + 1)
    )
    + " FROM pairs JOIN means USING (segment_id) WHERE split='train' GROUP BY segment_id HAVING count(actual)>0)"
)
LEVINSON = ["order_0 AS (SELECT *, c_0 AS e_0 FROM cov)"]
for m in range(1, MOST + 1):
    numerator = f"c_{m}" + "".join(f"-f_{m - 1}_{j}*c_{m - j}" for j in range(1, m))
    coefficients = [f"f_{m - 1}_{j}-k_{m}*f_{m - 1}_{m - j} AS f_{m}_{j}" for j in range(1, m)]
    LEVINSON.append(
        f"order_{m} AS (SELECT *, {', '.join([*coefficients, f'k_{m} AS f_{m}_{m}', f'e_{m - 1}*(1-k_{m}*k_{m}) AS e_{m}'])}"
        f" FROM (SELECT *, CASE WHEN e_{m - 1}>0 THEN ({numerator})/e_{m - 1} ELSE 0 END AS k_{m} FROM order_{m - 1}))"
    )
BEST_ORDER = (
    "chosen AS (SELECT *, CASE "
    + " ".join(
        f"WHEN a_{m}<=least({', '.join(f'a_{j}' for j in range(MOST + 1))}) THEN {m}" for m in range(MOST + 1)
    )
    + " ELSE 0 END::BIGINT AS ar_order FROM (SELECT *, "
    + ", ".join(f"CASE WHEN e_{m}>0 THEN n*ln(e_{m})+{2 * m} END AS a_{m}" for m in range(MOST + 1))
    + f" FROM order_{MOST}))"
)


def of_order(j: int) -> str:
    """Coefficient j of the chosen order."""
    return "CASE ar_order " + " ".join(f"WHEN {m} THEN f_{m}_{j}" for m in range(j, MOST + 1)) + " ELSE 0 END"


PHI = [of_order(j) for j in range(1, MOST + 1)]
AUTO = [HISTORY, COVARIANCES, *LEVINSON, BEST_ORDER]
define(
    "ar_order",
    "SELECT segment_id, n, ar_order, "
    + ", ".join(r(phi, f"phi_{j}") for j, phi in enumerate(PHI, 1))
    + ", "
    + r("CASE ar_order " + " ".join(f"WHEN {m} THEN e_{m}" for m in range(MOST + 1)) + " END", "variance")
    + " FROM chosen",
    *AUTO,
)
AR_AUTO = (
    "ar_auto AS (SELECT p.segment_id, p.timestamp, p.actual, c.mean"
    + "".join(f"+({phi})*(p.back_{j}-c.mean)" for j, phi in enumerate(PHI, 1))
    + " AS forecast FROM pairs p JOIN chosen c USING (segment_id) WHERE split='test')"
)
define("ar_auto", f"SELECT {FORECAST} FROM ar_auto", *AUTO, AR_AUTO)

# Differences on earlier differences and on the errors of a longer autoregression.
LONG, N_AR, N_MA = 8, 5, 2
DIFFERENCES = (
    "diffs AS (SELECT *, "
    + ", ".join(f"lag(d_0, {k}) OVER {W} AS d_{k}" for k in range(1, LONG + 1))
    + " FROM (SELECT *, actual-lag_1 AS d_0 FROM history))"
)
LONG_FIT = ["1", *[f"d_{k}" for k in range(1, LONG + 1)], "d_0"]
ERRORS_OF_LONG = (
    "errs AS (SELECT *, "
    + ", ".join(f"lag(e_0, {k}) OVER {W} AS e_{k}" for k in range(1, N_MA + 1))
    + " FROM (SELECT d.*, d_0-b_0"
    + "".join(f"-b_{k}*d_{k}" for k in range(1, LONG + 1))
    + " AS e_0 FROM diffs d, longfit))"
)
SHORT = [f"d_{k}" for k in range(1, N_AR + 1)] + [f"e_{k}" for k in range(1, N_MA + 1)]
ARMA_NEXT = "b_0" + "".join(f"+b_{k}*s_d{k}" for k in range(1, N_AR + 1)) + "".join(
    f"+b_{N_AR + k}*s_e{k}" for k in range(1, N_MA + 1)
)
ARMA = [
    DIFFERENCES,
    sums_of_products("longsums", LONG_FIT, f"diffs WHERE split='train' AND d_{LONG} IS NOT NULL"),
    *eliminated("longfit", "longsums", LONG + 1),
    ERRORS_OF_LONG,
    sums_of_products(
        "armasums", ["1", *SHORT, "d_0"], f"errs WHERE split='train' AND e_{N_MA} IS NOT NULL"
    ),
    *eliminated("armafit", "armasums", N_AR + N_MA + 1),
    "lastrow AS (SELECT * FROM errs WHERE split='train' QUALIFY i=max(i) OVER (PARTITION BY segment_id))",
    "spans AS (SELECT segment_id, 0 AS h, actual AS level, "
    + ", ".join(f"d_{k} AS s_d{k + 1}" for k in range(N_AR))
    + ", "
    + ", ".join(f"e_{k} AS s_e{k + 1}" for k in range(N_MA))
    + ", (SELECT max(n) FROM history) AS most FROM lastrow"
    + f" UNION ALL SELECT segment_id, h+1, level+({ARMA_NEXT}), {ARMA_NEXT}, "
    + ", ".join(f"s_d{k}" for k in range(1, N_AR))
    + ", 0::DOUBLE, "
    + ", ".join(f"s_e{k}" for k in range(1, N_MA))
    + ", most FROM spans, armafit WHERE h<most)",
    "arma_span AS (SELECT t.segment_id, t.timestamp, t.actual, s.level AS forecast"
    " FROM history t JOIN lastrow l USING (segment_id)"
    " JOIN spans s ON s.segment_id=t.segment_id AND s.h=t.i-l.i WHERE t.split='test')",
]
define("arma_span", f"SELECT {FORECAST} FROM arma_span", HISTORY, *ARMA)

# A trend with changepoints and seasonal terms, each block with its own penalty.
CHANGEPOINTS, REACH, SCALES = 10, 0.8, (5.0, 0.05, 10.0)
SHARE = "((epoch(timestamp)-first)/span)"
BENDS = {"slope": SHARE} | {
    f"hinge_{k}": f"greatest({SHARE}-{REACH}::DOUBLE*{k + 1}/{CHANGEPOINTS + 1}, 0)"
    for k in range(CHANGEPOINTS)
}
TERMS = {"trend": "epoch(date_trunc('day', timestamp))/86400+hour(timestamp)/24"}
for period, order in ((24, 4), (168, 3)):
    for k in range(1, order + 1):
        angle = f"2*pi()*{k}*((isodow(timestamp)-1)*24+hour(timestamp)+minute(timestamp)/60)/{period}"
        TERMS |= {f"sin_{period}_{k}": f"sin({angle})", f"cos_{period}_{k}": f"cos({angle})"}
BENDS |= {name: sql for name, sql in TERMS.items() if name != "trend"}
BENT = [*BENDS, "log_actual"]
N_BENDS = len(BENDS)


def penalty(k: int) -> str:
    scale = SCALES[0] if k == 0 else SCALES[1] if k <= CHANGEPOINTS else SCALES[2]
    return f"(SELECT rest/(rows-{N_BENDS}) FROM plain, bentrows)/{scale**2}::DOUBLE"


TREND = [
    "spanned AS (SELECT min(epoch(timestamp)) AS first, max(epoch(timestamp))-min(epoch(timestamp)) AS span"
    " FROM history WHERE split='train')",
    "bends AS (SELECT segment_id, timestamp, split, actual, ln(actual) AS log_actual, "
    + ", ".join(f"({sql})::DOUBLE AS {name}" for name, sql in BENDS.items())
    + " FROM history, spanned)",
    "bentmeans AS (SELECT segment_id, "
    + ", ".join(f"avg({c}) AS m_{c}" for c in BENT)
    + " FROM bends WHERE split='train' GROUP BY segment_id)",
    "bent AS MATERIALIZED (SELECT b.segment_id, timestamp, split, actual, m_log_actual, "
    + ", ".join(f"{c}-m_{c} AS {c}" for c in BENT)
    + " FROM bends b JOIN bentmeans USING (segment_id))",
    "bentrows AS (SELECT count(*) AS rows FROM bent WHERE split='train')",
    sums_of_products("bentsums", BENT, "bent WHERE split='train'"),
    *eliminated("plain", "bentsums", N_BENDS),
    *eliminated("ridge", "bentsums", N_BENDS, {k: penalty(k) for k in range(N_BENDS)}),
    "trend_seasonal AS (SELECT segment_id, timestamp, actual, exp(m_log_actual"
    + "".join(f"+b_{k}*{name}" for k, name in enumerate(BENDS))
    + ") AS forecast FROM bent, ridge WHERE split='test')",
]
define("trend_seasonal", f"SELECT {FORECAST} FROM trend_seasonal", HISTORY, *TREND)

STEPS = [f"d_{k}" for k in range(1, 6)]
define(
    "ar_diff5",
    f"""SELECT {KEYS}, {r("actual", "actual")}, {r("lag_1+p_change", "forecast")} FROM fitted
    WHERE split='test' AND lag_6 IS NOT NULL""",
    HISTORY,
    "lagged AS (SELECT *, "
    + ", ".join(f"lag(actual, {k}) OVER {W} AS lag_{k}" for k in range(2, 7))
    + " FROM history)",
    "ls AS (SELECT segment_id, timestamp, split, actual, lag_1, lag_6, actual-lag_1 AS change, "
    + ", ".join(f"lag_{k}-lag_{k + 1} AS d_{k}" for k in range(1, 6))
    + " FROM lagged)",
    *least_squares(STEPS, ["change"], "split='train'"),
)
CENTRED = [*TERMS, "log_actual"]
define(
    "fourier_seasonal",
    f"""SELECT {KEYS}, {r("actual", "actual")}, {r("exp(mean_log+p_log_actual)", "forecast")}
    FROM fitted WHERE split='test'""",
    HISTORY,
    "terms AS (SELECT segment_id, timestamp, split, actual, ln(actual) AS log_actual, "
    + ", ".join(f"{sql} AS {name}" for name, sql in TERMS.items())
    + " FROM history)",
    "centres AS (SELECT segment_id, "
    + ", ".join(f"avg({c}) AS m_{c}" for c in CENTRED)
    + " FROM terms WHERE split='train' GROUP BY segment_id)",
    "ls AS (SELECT t.segment_id, timestamp, split, actual, m_log_actual AS mean_log, "
    + ", ".join(f"{c}-m_{c} AS {c}" for c in CENTRED)
    + " FROM terms t JOIN centres USING (segment_id))",
    *least_squares(list(TERMS), ["log_actual"], "split='train'"),
)
define(
    "forecast_report",
    "SELECT *, rmse=min(rmse) OVER (PARTITION BY kind) AS is_best FROM errors",
    HISTORY,
    NAIVE,
    PROFILE,
    AR1,
    SPAN,
    COVARIANCES,
    *LEVINSON,
    BEST_ORDER,
    AR_AUTO,
    *ARMA,
    f"""errors AS (SELECT kind, model, {ERRORS} FROM (
      SELECT 'one_step' AS kind, 'seasonal_naive' AS model, * FROM naive
      UNION ALL SELECT 'span', 'seasonal_profile', * FROM profile
      UNION ALL SELECT 'one_step', 'ar1', * FROM ar1 UNION ALL SELECT 'span', 'ar1_span', * FROM span
      UNION ALL SELECT 'one_step', 'ar_auto', * FROM ar_auto
      UNION ALL SELECT 'span', 'arma_span', * FROM arma_span)
      WHERE forecast IS NOT NULL GROUP BY kind, model)""",
)
BEFORE, AFTER = [f"x_{k}" for k in range(1, 25)], [f"y_{h}" for h in range(4)]
define(
    "direct_multi_horizon",
    " UNION ALL ".join(
        f"""SELECT {KEYS}, {h + 1}::BIGINT AS step, {r(f"a_{h}", "actual")}, {r(f"p_y_{h}", "forecast")}
        FROM fitted WHERE split='test'"""
        for h in range(4)
    ),
    f"placed AS (SELECT *, row_number() OVER {W}-1 AS i, count(*) OVER (PARTITION BY segment_id) AS n, "
    + ", ".join(f"lag(speed_kmh, {k}) OVER {W} AS x_{k}" for k in range(1, 25))
    + ", "
    + ", ".join(f"lead(speed_kmh, {h}) OVER {W} AS y_{h}" for h in range(4))
    + " FROM traffic)",
    "ls AS (SELECT *, CASE WHEN i-24<floor((n-28)*0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split, "
    + ", ".join(f"y_{h} AS a_{h}" for h in range(4))
    + " FROM placed WHERE i>=24 AND i<n-4)",
    *least_squares(BEFORE, AFTER, "split='train'"),
)
define(
    "boosted_horizon_rows",
    " UNION ALL ".join(
        f"SELECT {KEYS}, {h + 1}::BIGINT AS step, {r(f'y_{h}', 'actual')}, TRUE AS known FROM placed"
        " WHERE i>=24 AND i<n-4 AND NOT i-24<floor((n-28)*0.8::DOUBLE)"
        for h in range(4)
    ),
    f"placed AS (SELECT *, row_number() OVER {W}-1 AS i, count(*) OVER (PARTITION BY segment_id) AS n, "
    + ", ".join(f"lead(speed_kmh, {h}) OVER {W} AS y_{h}" for h in range(4))
    + " FROM traffic)",
)
define(
    "future_frame",
    f"""SELECT {KEYS} FROM (SELECT segment_id, max(timestamp)+to_minutes(15*k) AS timestamp
    FROM traffic, (SELECT unnest([1,2,3,4]) AS k) GROUP BY segment_id, k)""",
)
define(
    "forecast_alerts",
    f"""SELECT segment_id, {r("max(forecast)", "peak")},
    count(*) FILTER (WHERE forecast>70) AS alerts FROM profile GROUP BY segment_id""",
    HISTORY.replace("speed_kmh AS actual", "(congestion_code>=2)::INT*100::DOUBLE AS actual"),
    PROFILE,
)

# Signals and scenarios

VOLUMES = """volumes AS (SELECT segment_id, avg_volume AS ns,
  avg_volume*0.8::DOUBLE AS ew FROM peak)"""


def objective(green_ns: str, green_ew: str) -> str:
    wait = f"((({green_ew}+10)/2*ns+({green_ns}+10)/2*ew)/(ns+ew+0.000001::DOUBLE))"
    return (
        f"{wait}*0.4::DOUBLE-({green_ns}+{green_ew})*0.5::DOUBLE*0.4::DOUBLE"
        f"+{wait}*(ns+ew)/100*0.2::DOUBLE"
    )


def best_plan(values: str, name: str) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT segment_id, ns, ew, a.g AS green_ns, b.g AS green_ew,
      {objective("a.g", "b.g")} AS objective_value
      FROM volumes, (SELECT unnest({values})::BIGINT AS g) a, (SELECT unnest({values})::BIGINT AS g) b)
    QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY objective_value, green_ns, green_ew)=1)"""


PLAN_COLUMNS = f"segment_id, green_ns, green_ew, {rs('objective_value')}"
CORNERS = best_plan("[20, 120]", "best")
define(
    "timing_objective",
    f"SELECT segment_id, {r(objective('50', '50'), 'objective_value')} FROM volumes",
    PEAK,
    VOLUMES,
)
define("optimize_timing", f"SELECT {PLAN_COLUMNS} FROM best", PEAK, VOLUMES, CORNERS)
define(
    "optimize_timing_grid",
    f"SELECT {PLAN_COLUMNS} FROM best",
    PEAK,
    VOLUMES,
    best_plan("range(20, 121, 10)", "best"),
)
DELAY = """((b.g+10)*(b.g+10)*ns+(a.g+10)*(a.g+10)*ew)/(2*(a.g+b.g+10)*(ns+ew+0.000001::DOUBLE))
  +greatest(ns*(a.g+b.g+10)/3600-a.g*0.5::DOUBLE, 0)**2+greatest(ew*(a.g+b.g+10)/3600-b.g*0.5::DOUBLE, 0)**2"""
define(
    "search_timing",
    f"""SELECT segment_id, green_ns, green_ew, {r("objective_value", "objective_value")} FROM (
      SELECT segment_id, a.g AS green_ns, b.g AS green_ew, {DELAY} AS objective_value
      FROM volumes, (SELECT unnest(range(20, 121)) AS g) a, (SELECT unnest(range(20, 121)) AS g) b)
    QUALIFY row_number() OVER (PARTITION BY segment_id
      ORDER BY objective_value, green_ns, green_ew)=1""",
    PEAK,
    VOLUMES,
)
define(
    "proportional_timing",
    """SELECT segment_id, green_ns, green_ew, green_ns+green_ew+10 AS cycle_length FROM (
      SELECT segment_id,
        greatest(20, least(120, trunc(ns/(ns+ew+0.000001::DOUBLE)*100)))::BIGINT AS green_ns,
        greatest(20, least(120, trunc(ew/(ns+ew+0.000001::DOUBLE)*100)))::BIGINT AS green_ew
      FROM volumes)""",
    PEAK,
    VOLUMES,
)
OPTIMIZED = """optimized AS (SELECT s.signal_id, s.segment_id, s.latitude, s.longitude,
    b.green_ns+b.green_ew+10 AS cycle_length, b.green_ns AS green_time_ns, b.green_ew AS green_time_ew,
    s.yellow_time, s.all_red_time, s.green_time_ns AS green_time_ns_original,
    s.green_time_ew AS green_time_ew_original, s.cycle_length AS cycle_length_original,
    b.objective_value, b.ns AS traffic_volume_ns, b.ew AS traffic_volume_ew
  FROM signal s JOIN best b USING (segment_id))"""
PLANNING = (PEAK, VOLUMES, CORNERS, OPTIMIZED)
CHANGES = """signal_id, green_time_ns_original AS ns_original, green_time_ns AS ns_optimized,
  green_time_ew_original AS ew_original, green_time_ew AS ew_optimized,
  cycle_length_original AS cycle_original, cycle_length AS cycle_optimized"""
define(
    "optimized_signals",
    f"""SELECT signal_id, segment_id, cycle_length, green_time_ns, green_time_ew, yellow_time, all_red_time,
    green_time_ns_original, green_time_ew_original, cycle_length_original,
    {rs("latitude", "longitude", "objective_value", "traffic_volume_ns", "traffic_volume_ew")}
    FROM optimized""",
    *PLANNING,
)
define("signal_changes", f"SELECT {CHANGES} FROM optimized", *PLANNING)
define("first_n", f"SELECT {CHANGES} FROM optimized ORDER BY signal_id LIMIT 10", *PLANNING)
define(
    "timing_change",
    f"""SELECT {r("avg(green_time_ns)-avg(green_time_ns_original)", "change_ns")},
    {r("avg(green_time_ew)-avg(green_time_ew_original)", "change_ew")} FROM optimized""",
    *PLANNING,
)
PLANS = """plans AS (SELECT 'baseline' AS scenario, signal_id, segment_id, green_time_ns_original AS green_ns,
    green_time_ew_original AS green_ew, cycle_length_original AS cycle_length FROM optimized
  UNION ALL SELECT 'optimized', signal_id, segment_id, green_time_ns, green_time_ew, cycle_length
  FROM optimized)"""
RUN = """(PARTITION BY signal_id, scenario ORDER BY timestamp
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
QUEUES = f"""cycles AS (SELECT p.*, t.timestamp,
    floor(volume_vehicles*cycle_length/3600)::BIGINT AS arrivals_ns,
    floor(volume_vehicles*cycle_length/3600*0.8::DOUBLE)::BIGINT AS arrivals_ew
  FROM traffic t JOIN plans p USING (segment_id)),
sums AS (SELECT *, sum(arrivals_ns-floor(green_ns*0.5)) OVER {RUN} AS sum_ns,
    sum(arrivals_ew-floor(green_ew*0.5)) OVER {RUN} AS sum_ew FROM cycles),
queues AS (SELECT *, (sum_ns-least(0, min(sum_ns) OVER {RUN}))::BIGINT AS queue_ns,
    (sum_ew-least(0, min(sum_ew) OVER {RUN}))::BIGINT AS queue_ew FROM sums),
totals AS (SELECT signal_id, scenario, sum(arrivals_ns+arrivals_ew) AS arrived,
    sum(arrivals_ns+arrivals_ew)-arg_max(queue_ns+queue_ew, timestamp) AS served,
    sum(queue_ns*green_ns+queue_ew*green_ew) AS waiting, (max(queue_ns)+max(queue_ew))/2 AS longest,
    count(*) AS cycles, sum(cycle_length) AS duration FROM queues GROUP BY signal_id, scenario),
results AS (SELECT signal_id, scenario, arrived::BIGINT AS total_vehicles_arrived,
    served::BIGINT AS total_vehicles_served, waiting/(served+0.000001::DOUBLE) AS avg_wait_time_sec,
    served/duration*3600 AS throughput_veh_per_hour, served/(arrived+0.000001::DOUBLE) AS utilization,
    longest::DOUBLE AS max_queue_length, served::BIGINT AS total_stops, cycles::BIGINT AS num_cycles
  FROM totals)"""
SIMULATION = (*PLANNING, PLANS, QUEUES)
COUNTS = ("total_vehicles_arrived", "total_vehicles_served", "total_stops", "num_cycles")
RATES = ("avg_wait_time_sec", "throughput_veh_per_hour", "utilization", "max_queue_length")
define("scenario_union", "SELECT * FROM plans", *PLANNING, PLANS)
define(
    "queue_balance",
    """SELECT signal_id, scenario, epoch_us(timestamp) AS timestamp_us, arrivals_ns, arrivals_ew,
    queue_ns, queue_ew FROM queues""",
    *SIMULATION,
)
define(
    "scenario_compare",
    f"SELECT signal_id, scenario, {', '.join(COUNTS)}, {rs(*RATES)} FROM results",
    *SIMULATION,
)
define(
    "scenario_pairs",
    "SELECT b.signal_id, "
    + ", ".join(f"{x}.{c} AS {n}_{c}" for x, n in (("b", "baseline"), ("o", "optimized")) for c in COUNTS)
    + ", "
    + ", ".join(
        r(f"{x}.{c}", f"{n}_{c}") for x, n in (("b", "baseline"), ("o", "optimized")) for c in RATES
    )
    + """ FROM results b JOIN results o ON b.signal_id=o.signal_id
    WHERE b.scenario='baseline' AND o.scenario='optimized'""",
    *SIMULATION,
)
MEANS = """means AS (SELECT avg(avg_wait_time_sec) FILTER (WHERE scenario='baseline') AS bw,
  avg(avg_wait_time_sec) FILTER (WHERE scenario='optimized') AS ow,
  avg(throughput_veh_per_hour) FILTER (WHERE scenario='baseline') AS bt,
  avg(throughput_veh_per_hour) FILTER (WHERE scenario='optimized') AS ot,
  avg(max_queue_length) FILTER (WHERE scenario='baseline') AS bq,
  avg(max_queue_length) FILTER (WHERE scenario='optimized') AS oq FROM results)"""
define(
    "scenario_improvement",
    f"""SELECT {r("(bw-ow)/bw*100", "wait_time_reduction")}, {r("(ot-bt)/bt*100", "throughput_increase")},
    {r("(bq-oq)/bq*100", "queue_reduction")}, {r("bw", "baseline_avg_wait")},
    {r("ow", "optimized_avg_wait")}, {r("bt", "baseline_throughput")},
    {r("ot", "optimized_throughput")} FROM means""",
    *SIMULATION,
    MEANS,
)


def benefit_columns(base: str, new: str, suffix: str) -> str:
    saved = f"({base}-{new})"
    return ", ".join(
        r(sql, f"{name}{suffix}")
        for name, sql in (
            ("wait_time_saved_hours", saved),
            ("co2_reduction_kg", f"{saved}*180"),
            ("co2_reduction_pct", f"CASE WHEN {base}>0 THEN {saved}/{base}*100 ELSE 0 END"),
            ("time_savings_value_usd", f"{saved}*15"),
            ("fuel_savings_liters", f"{saved}*0.6::DOUBLE"),
            ("fuel_savings_value_usd", f"{saved}*0.6::DOUBLE*1.5::DOUBLE"),
            ("total_economic_benefit_usd", f"{saved}*15+{saved}*0.6::DOUBLE*1.5::DOUBLE"),
        )
    )


define(
    "benefits",
    f"SELECT {benefit_columns('b', 'o', '')}, {benefit_columns('bs', 'os', '_per_signal')} FROM hours",
    *SIMULATION,
    "hours AS (SELECT "
    + ", ".join(
        f"""sum(avg_wait_time_sec) FILTER (WHERE scenario='{n}')
        *sum(total_vehicles_served) FILTER (WHERE scenario='{n}')/3600 AS {a},
        sum(avg_wait_time_sec*total_vehicles_served) FILTER (WHERE scenario='{n}')/3600 AS {a}s"""
        for n, a in (("baseline", "b"), ("optimized", "o"))
    )
    + " FROM results)",
)
define(
    "what_if_incident",
    "SELECT * FROM stats",
    """incident AS (SELECT segment_id, CASE WHEN road_type='arterial' THEN speed_kmh*0.3::DOUBLE
      ELSE speed_kmh END AS speed_kmh, CASE WHEN road_type='arterial' THEN floor(volume_vehicles*1.5)
      ELSE volume_vehicles END AS volume_vehicles, speed_limit FROM labelled)""",
    """relabelled AS (SELECT *, CASE WHEN speed_kmh/speed_limit>=0.6::DOUBLE THEN 0 ELSE 2 END
      AS congestion_code FROM incident)""",
    STATS.format("relabelled"),
)

# Streams

define(
    "stream_interval_avg",
    f"""SELECT segment_id, window_start AS window_start_us, window_end AS window_end_us,
    {r("avg(speed_kmh)", "avg_speed")}, {r("avg(volume_vehicles)", "avg_volume")}, count(*) AS readings
    FROM (SELECT *, window_start+900000000 AS window_end FROM (
      SELECT *, epoch_us(timestamp)//900000000*900000000 AS window_start FROM traffic))
    GROUP BY segment_id, window_start, window_end""",
)
define(
    "stream_latest",
    f"""SELECT {KEYS}, {rs("speed_kmh", "speed_limit", "speed_ratio")}, volume_vehicles,
    congestion_level, congestion_code, {COLOR} FROM labelled
    QUALIFY row_number() OVER (PARTITION BY segment_id ORDER BY timestamp DESC)=1""",
)
define(
    "stream_alerts",
    f"""SELECT segment_id, window_start AS window_start_us, window_end AS window_end_us,
    {r("avg((congestion_code>=2)::INT)", "congested_share")}, count(*) AS readings
    FROM (SELECT *, window_start+3600000000 AS window_end FROM (
      SELECT l.*, epoch_us(timestamp)//900000000*900000000-k*900000000::BIGINT AS window_start
      FROM labelled l, (SELECT unnest([0,1,2,3]) AS k)))
    GROUP BY segment_id, window_start, window_end
    HAVING avg((congestion_code>=2)::INT)>0.7::DOUBLE""",
)


# The same rows by the ways that only large tables take.
for large, plain in (
    ("large_label_join", "label_join"),
    ("large_median_fill", "median_fill"),
    ("large_positional_split", "positional_split"),
    ("large_auc", "auc_ovr_weighted"),
    ("cut_lag_features", "lag_features"),
    ("cut_rolling_mean", "rolling_mean"),
    ("cut_forward_fill", "forward_fill"),
    ("cut_queue_balance", "queue_balance"),
):
    ORACLES[large] = ORACLES[plain]
