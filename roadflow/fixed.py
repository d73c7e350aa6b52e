"""Fixed values that must equal the reference's for right results.

Kept together, in the order the reference states them.
"""

# --- fixed values (do not change: results depend on them) -----------------

# Stream layout
WINDOW_DURATION = "5 minutes"
WATERMARK_DELAY = "10 minutes"

# Speed thresholds (km/h)
ALERT_SPEED_BELOW = 10.0            # raw reading, strict "<"
INTERVENTION_SPEED_BELOW = 15.0     # rounded hourly mean at the peak, strict "<"
STATUS_CRITICAL_BELOW = 15.0        # window mean, strict "<"
STATUS_WARNING_BELOW = 25.0         # window mean, strict "<"

# Congestion-index gauge: bands 0-30 / 30-60 / 60-100, reference line 30
INDEX_REFERENCE = 30.0
INDEX_BAND_MEDIUM_FROM = 30.0
INDEX_BAND_HIGH_FROM = 60.0

# City-wide hourly volume peak band (inclusive)
PEAK_BAND_LOW = 200
PEAK_BAND_HIGH = 300

# Map marker size = congestion index x 10
MARKER_SCALE = 10.0

# Alert reason literal
ALERT_REASON = "avg_speed_below_10_kmph"

# Status labels
STATUS_CRITICAL = "Critical"
STATUS_WARNING = "Warning"
STATUS_NORMAL = "Normal"

# Status-alert texts
CRITICAL_MESSAGE_PREFIX = "Speed critically low at "
CRITICAL_MESSAGE_SUFFIX = " km/h"
WARNING_MESSAGE = "Moderate congestion detected"
CRITICAL_RECOMMENDATION = "Immediate police deployment required"
WARNING_RECOMMENDATION = "Monitor closely"

# Intervention report texts
INTERVENTION_YES = "YES"
INTERVENTION_NO = "NO"
ACTION_YES = "REQUIRES police intervention"
ACTION_NO = "Monitor only"
SPEED_LABEL_YES = "CRITICAL"
SPEED_LABEL_NO = "ACCEPTABLE"
DEPLOY_PREFIX = "Deploy 2-3 officers during "

# Report page: the text shown for a junction that needs police, one line per entry
PAGE_LINES = [
    "**{sensor_id} - Immediate Action Required**",
    "- Peak hour at {peak_hour} with {vehicles_hour} vehicles",
    "- Average speed critically low at {avg_speed_at_peak} km/h",
    "- 🚔 Deploy 2-3 traffic officers during peak hours",
    "- 📍 Consider adjusting traffic signal timings",
]

# Report file name stems
REPORT_STEMS = {
    "peak": "peak_hour_report",
    "volume": "traffic_volume_vs_time",
    "pivot": "traffic_volume_pivot",
    "weekly": "weekly_peak_hours",  # our own: the reference's name would match the daily peak lookup
}

# Junction locations: sensor_id, lat, lon, name
JUNCTIONS = [
    ("J1", 6.9271, 79.8612, "Colombo City Center"),
    ("J2", 6.9145, 79.8567, "Galle Face Junction"),
    ("J3", 6.9021, 79.8625, "Kollupitiya Junction"),
    ("J4", 6.8916, 79.8579, "Bambalapitiya Junction"),
]

# Dashboard time-range selector
TIME_RANGES = {
    "Last Hour": "1 hour",
    "Last 24 Hours": "24 hours",
    "Last Week": "7 days",
    "All Time": None,
}

# --- end of fixed values ----------------------------------------------------
