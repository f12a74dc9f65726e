"""Schemas of the readings, the window rows and the fixed domain values."""

from pyspark.sql import types as T

# Zones in partition order (index = partition number), meter
# states, nominal volts, reading interval in seconds per customer type.
ZONES = ["ZONE-NORTH", "ZONE-SOUTH", "ZONE-EAST", "ZONE-WEST", "ZONE-CENTRAL"]
STATES = ["normal", "degraded", "fault", "silent"]
CUSTOMER_TYPES = ["residential", "commercial", "industrial"]
NOMINAL_VOLTS = {"residential": 120, "commercial": 240, "industrial": 480}
INTERVAL_SECONDS = {"residential": 300, "commercial": 120, "industrial": 60}
PEAK_HOURS = {
    "residential": [7, 8, 9, 18, 19, 20, 21, 22],
    "commercial": [9, 10, 11, 12, 13, 14, 15, 16, 17, 18],
    "industrial": [],
}
WINDOW_SECONDS = 300
EMA_ALPHA = 0.2
EMA_THRESHOLD = 4.0
EXPECTED_PER_ZONE = 100
NOMINAL_HZ = 60.0
LOW_POWER_FACTOR = 0.85

# Keys a message must carry to be aggregated.
REQUIRED_KEYS = [
    "meter_id", "zone_id", "kwh_delta", "power_kw", "voltage",
    "power_factor", "frequency_hz", "meter_state", "timestamp",
]

# Moves between meter states that the health model allows.
LEGAL_TRANSITIONS = [
    ("normal", "degraded"), ("normal", "silent"),
    ("degraded", "normal"), ("degraded", "fault"),
    ("fault", "normal"), ("silent", "normal"),
]

# Demand scenarios, each starting daily at `hour` for `minutes`.
SCENARIOS = [
    {"name": "evening_peak", "hour": 18, "minutes": 90, "zones": ["ZONE-NORTH", "ZONE-WEST"]},
    {"name": "heatwave", "hour": 13, "minutes": 180, "zones": ["ALL"]},
    {"name": "zone_outage", "hour": 2, "minutes": 45, "zones": ["ZONE-SOUTH"]},
    {"name": "morning_commercial_ramp", "hour": 8, "minutes": 60, "zones": ["ZONE-CENTRAL"]},
]

# One JSON event as it arrives.
READING_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("meter_id", T.StringType()),
    T.StructField("zone_id", T.StringType()),
    T.StructField("customer_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("kwh_reading", T.DoubleType()),
    T.StructField("kwh_delta", T.DoubleType()),
    T.StructField("voltage", T.DoubleType()),
    T.StructField("current_amps", T.DoubleType()),
    T.StructField("power_factor", T.DoubleType()),
    T.StructField("power_kw", T.DoubleType()),
    T.StructField("frequency_hz", T.DoubleType()),
    T.StructField("meter_state", T.StringType()),
    T.StructField("is_anomaly", T.BooleanType()),
    T.StructField("signal_strength_dbm", T.IntegerType()),
    T.StructField("firmware_version", T.StringType()),
    T.StructField("event_type", T.StringType()),
])

# One closed zone window, in the order of the push rows.
ZONE_AGG_SCHEMA = T.StructType([
    T.StructField("zone_id", T.StringType()),
    T.StructField("window_start_ts", T.TimestampNTZType()),
    T.StructField("window_end_ts", T.TimestampNTZType()),
    T.StructField("total_kwh", T.DoubleType()),
    T.StructField("avg_power_kw", T.DoubleType()),
    T.StructField("peak_power_kw", T.DoubleType()),
    T.StructField("avg_power_factor", T.DoubleType()),
    T.StructField("avg_voltage", T.DoubleType()),
    T.StructField("avg_frequency_hz", T.DoubleType()),
    T.StructField("active_meter_count", T.LongType()),
    T.StructField("silent_meter_count", T.LongType()),
    T.StructField("degraded_count", T.LongType()),
    T.StructField("fault_count", T.LongType()),
    T.StructField("anomaly_count", T.LongType()),
    T.StructField("demand_vs_prev_window_pct", T.DoubleType()),
])
