"""Thresholds, factors and defaults the results depend on."""

SEGMENT = "segment_id"
TIMESTAMP = "timestamp"

# Rush hours, half-open hour ranges.
MORNING_RUSH = (7, 9)
EVENING_RUSH = (17, 19)

# Congestion level: first threshold that speed / limit reaches.
LEVELS = ("Free Flow", "Moderate", "Heavy", "Severe")
THRESHOLDS = (0.8, 0.6, 0.4)
LEVEL_COLORS = {
    "Free Flow": "green",
    "Moderate": "orange",
    "Heavy": "red",
    "Severe": "darkred",
}
UNKNOWN_COLOR = "gray"
CONGESTED_CODE = 2

# Road types.
ROAD_TYPES = ("highway", "arterial", "local")
ROAD_TYPE_SHARES = (0.2, 0.4, 0.4)
SPEED_LIMITS = {"highway": 100.0, "arterial": 60.0, "local": 40.0}
BASE_VOLUMES = {"highway": 1000.0, "arterial": 600.0, "local": 300.0}
LANE_SHARES = (0.2, 0.4, 0.3, 0.1)
CENTER = (40.7128, -74.0060)
SIGNAL_SHARE = 0.3

# Demand pattern: (volume factor, speed factor).
PATTERN = {
    "weekend": (0.6, 1.0),
    "morning": (1.8, 0.6),
    "evening": (2.0, 0.5),
    "midday": (1.2, 0.85),
    "night": (0.3, 1.0),
    "normal": (1.0, 0.9),
}
WEATHER_SHARE, WEATHER_SPEED, WEATHER_VOLUME = 0.15, 0.7, 1.3
ACCIDENT_SHARE, ACCIDENT_SPEED, ACCIDENT_VOLUME = 0.001, 0.3, 1.5
MIN_SPEED = 5.0
BLOCKED_TRAVEL_TIME = 999.0

# Features and splits.
LAGS = (1, 2, 3, 6, 12, 24)
ROLLING = (4, 8, 12)
TEST_SHARE, VALIDATION_SHARE, SERIES_TRAIN_SHARE = 0.2, 0.1, 0.8
LOOKBACK, HORIZON = 24, 4
SEED = 42
NOT_FEATURES = (
    "timestamp",
    "segment_id",
    "speed_kmh",
    "congestion_level",
    "congestion_code",
    "speed_limit",
    "speed_ratio",
    "travel_time_min",
    "has_accident",
)

# Signals.
SIGNAL_COUNT = 30
CYCLE, GREEN, YELLOW, ALL_RED = 120, 50, 3, 2
MIN_GREEN, MAX_GREEN = 20, 120
WEIGHTS = (0.4, 0.4, 0.2)  # wait, throughput, emissions
EAST_WEST_SHARE = 0.8
SATURATION_FLOW = 0.5  # vehicles per second of green
EPSILON = 1e-6

# Benefits.
CO2_IDLE, TIME_VALUE, FUEL_COST, FUEL_IDLE = 180.0, 15.0, 1.5, 0.6

ALERT_THRESHOLD = 70.0
