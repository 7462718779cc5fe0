"""Schemas of the sensor model and the fixed values the queries depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must equal the reference configuration for equal results).
# Sensor types with unit and thresholds:
#   type, unit, min_normal, max_normal, min_critical, max_critical
# --------------------------------------------------------------------------
SENSOR_TYPES = [
    ("Temperature", "°C", 18.0, 28.0, 5.0, 45.0),
    ("Humidity", "%RH", 30.0, 60.0, 10.0, 90.0),
    ("Pressure", "hPa", 990.0, 1025.0, 950.0, 1060.0),
    ("CO2", "ppm", 400.0, 1000.0, 300.0, 5000.0),
    ("Vibration", "mm/s", 0.0, 4.5, 0.0, 11.0),
]
ZONE_TYPES = ["Production", "Storage", "Office", "HVAC"]
ZONES_PER_SITE = 4
SENSORS_PER_ZONE = 5
SENSOR_INSTALL_DATE = "2024-06-15"
ALERT_LOW_FACTOR = 1.1    # below: Critical if value < min_critical * 1.1
ALERT_HIGH_FACTOR = 0.9   # above: Critical if value > max_critical * 0.9
QUALITY_GOOD = "Good"
QUALITY_SUSPECT = "Suspect"
SEVERITY_CRITICAL = "Critical"
SEVERITY_WARNING = "Warning"
ISO_MICROS_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ALERT_TYPE_BELOW = "BelowThreshold"
ALERT_TYPE_ABOVE = "AboveThreshold"
ALERT_MESSAGE_BELOW = "{type} too low: {value} {unit} (min: {threshold})"
ALERT_MESSAGE_ABOVE = "{type} too high: {value} {unit} (max: {threshold})"
SITE_ID_FORMAT = "SITE_{n:03d}"              # n = site ordinal + 1
ZONE_ID_FORMAT = "{site_id}_Z{n:02d}"         # n = zone ordinal in its site + 1
SENSOR_ID_FORMAT = "SN_{n:04d}"               # n = running sensor number
ZONE_NAME_FORMAT = "{zone_type} - {site_name}"
SENSOR_NAME_FORMAT = "{sensor_type} Sensor {n}"
SITE_LATITUDE = (43.3, 2.0)                   # base + step · site ordinal, 4 digits
SITE_LONGITUDE = (2.3, 1.5)                   # base + step · site ordinal, 4 digits
ZONE_AREA = (100.0, 50.0, 3.0)                # base + step · zone ordinal + per-letter · len(site name)
EXPECTED_AMPLITUDE = 0.4                      # share of the half-range swung by the daily sine
EXPECTED_CLAMP = (0.98, 1.02)                 # × min_normal, × max_normal
NOISE_SCALE = 0.15                            # noise standard deviation as a share of the half-range
# --------------------------------------------------------------------------

DIM_SITES = T.StructType([
    T.StructField("site_id", T.StringType()),
    T.StructField("site_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("is_active", T.BooleanType()),
])

DIM_ZONES = T.StructType([
    T.StructField("zone_id", T.StringType()),
    T.StructField("zone_name", T.StringType()),
    T.StructField("zone_type", T.StringType()),
    T.StructField("site_id", T.StringType()),
    T.StructField("floor", T.IntegerType()),
    T.StructField("area_sqm", T.DoubleType()),
    T.StructField("is_active", T.BooleanType()),
])

DIM_SENSORS = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("sensor_name", T.StringType()),
    T.StructField("sensor_type", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("zone_id", T.StringType()),
    T.StructField("site_id", T.StringType()),
    T.StructField("min_normal", T.DoubleType()),
    T.StructField("max_normal", T.DoubleType()),
    T.StructField("min_critical", T.DoubleType()),
    T.StructField("max_critical", T.DoubleType()),
    T.StructField("install_date", T.DateType()),
    T.StructField("is_active", T.BooleanType()),
])

SENSOR_READING = T.StructType([
    T.StructField("ReadingId", T.StringType()),
    T.StructField("SensorId", T.StringType()),
    T.StructField("ZoneId", T.StringType()),
    T.StructField("SiteId", T.StringType()),
    T.StructField("Timestamp", T.TimestampType()),
    T.StructField("SensorType", T.StringType()),
    T.StructField("ReadingValue", T.DoubleType()),
    T.StructField("Unit", T.StringType()),
    T.StructField("IsAnomaly", T.BooleanType()),
    T.StructField("QualityFlag", T.StringType()),
])

SENSOR_ALERT = T.StructType([
    T.StructField("AlertId", T.StringType()),
    T.StructField("SensorId", T.StringType()),
    T.StructField("ZoneId", T.StringType()),
    T.StructField("SiteId", T.StringType()),
    T.StructField("Timestamp", T.TimestampType()),
    T.StructField("SensorType", T.StringType()),
    T.StructField("AlertType", T.StringType()),
    T.StructField("Severity", T.StringType()),
    T.StructField("ReadingValue", T.DoubleType()),
    T.StructField("ThresholdValue", T.DoubleType()),
    T.StructField("Message", T.StringType()),
])

FACT_SCHEMAS = {"SensorReading": SENSOR_READING, "SensorAlert": SENSOR_ALERT}
DIM_SCHEMAS = {"dim_sites": DIM_SITES, "dim_zones": DIM_ZONES, "dim_sensors": DIM_SENSORS}
