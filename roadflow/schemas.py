
from pyspark.sql import types as T

# The driver's ``events`` table (TESTDATA.md); declared so that reads skip
# footer-based schema inference (one extra driver round trip per query).
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# JSON payload of one reading, as produced upstream (all fields nullable:
# from_json never enforces nullable=False).
READING_JSON = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("vehicle_count", T.IntegerType()),
    T.StructField("avg_speed", T.DoubleType()),
])

READING = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("vehicle_count", T.IntegerType()),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("event_time", T.TimestampType()),
])

WINDOW_AGG = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("total_vehicles", T.LongType()),
    T.StructField("avg_speed_window", T.DoubleType()),
    T.StructField("congestion_index", T.DoubleType()),
])

# Additive measures of a window, from which any merge of batches gives the same aggregate.
WINDOW_PARTS = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("total_vehicles", T.LongType()),
    T.StructField("speed_sum", T.DecimalType(38, 18)),
    T.StructField("speed_n", T.LongType()),
    T.StructField("speed_fit", T.LongType()),
    T.StructField("speed_plain", T.DoubleType()),
])

# Additive measures of a sensor's hour; ``report_date`` is the partition column.
HOURLY_ROLLUP = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("hour", T.TimestampType()),
    T.StructField("vehicles", T.LongType()),
    *[T.StructField(f"{name}_{part}", kind) for name in ("speed", "index") for part, kind in (
        ("sum", T.DecimalType(38, 18)), ("n", T.LongType()), ("fit", T.LongType()), ("plain", T.DoubleType()))],
    T.StructField("windows", T.LongType()),
    T.StructField("report_date", T.DateType()),
])

ALERT = T.StructType([
    T.StructField("alert_time", T.TimestampType()),
    T.StructField("detected_at", T.TimestampType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("vehicle_count", T.IntegerType()),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("reason", T.StringType()),
])

HOURLY_VOLUME = T.StructType([
    T.StructField("report_date", T.DateType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("hour", T.TimestampType()),
    T.StructField("vehicles_hour", T.LongType()),
    T.StructField("avg_speed_hour", T.DoubleType()),
])

PEAK = T.StructType([
    T.StructField("report_date", T.DateType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("peak_hour", T.TimestampType()),
    T.StructField("vehicles_hour", T.LongType()),
    T.StructField("avg_speed_at_peak", T.DoubleType()),
    T.StructField("needs_intervention", T.StringType()),
])

VOLUME = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("total_volume", T.LongType()),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("sample_count", T.LongType()),
])

JUNCTION = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("name", T.StringType()),
])

# One row per written report.
CATALOGUE = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("report_date", T.DateType()),
    T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("written_at", T.TimestampType()),
])

# Report CSVs carry no types of their own: read them with these.
REPORT_SCHEMAS = {
    "peak": PEAK,
    "volume": VOLUME,
    "weekly": PEAK,
}
