"""Alert derivation, expected value and quality rules (survey 2.9, A1–A11).

All rules are row-local Column expressions evaluated after one equi-join of the
readings with a threshold table.  Which threshold table is joined is the
caller's choice:

* ``by="sensor"`` — ``dim_sensors`` on ``SensorId = sensor_id`` (the sensor's
  own thresholds).  The dimension grows with the data, so it is broadcast only
  after ``broadcast_if_small`` proved its size; otherwise the planner
  picks a shuffle join.
* ``by="type"`` — the fixed five-row threshold table on ``SensorType``.

Either table is broadcast only if its size proves small (``broadcast_if_small``).
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorium.functions.scalar import clamp, round_stable, sec_of_day
from sensorium.schemas import (
    ALERT_HIGH_FACTOR, ALERT_LOW_FACTOR, ALERT_MESSAGE_ABOVE, ALERT_MESSAGE_BELOW,
    ALERT_TYPE_ABOVE, ALERT_TYPE_BELOW, EXPECTED_AMPLITUDE, EXPECTED_CLAMP, NOISE_SCALE,
    QUALITY_GOOD, QUALITY_SUSPECT, SENSOR_TYPES, SEVERITY_CRITICAL, SEVERITY_WARNING,
)

THRESHOLD_COLS = ["unit", "min_normal", "max_normal", "min_critical", "max_critical"]


def threshold_table(spark: SparkSession) -> DataFrame:
    """The fixed sensor-type threshold table (five rows)."""
    return spark.createDataFrame(
        [tuple(t) for t in SENSOR_TYPES],
        "sensor_type string, unit string, min_normal double, max_normal double, "
        "min_critical double, max_critical double")


def with_thresholds(readings: DataFrame, thresholds: DataFrame, by: str = "sensor",
                    how: str = "left") -> DataFrame:
    """Attach ``_unit``/``_min_normal``/… columns to each reading; readings
    without thresholds keep their row with missing values (``how="left"``)."""
    if by == "sensor":
        key_l, key_r = "SensorId", "sensor_id"
        extra = ["sensor_type"]
    elif by == "type":
        key_l, key_r = "SensorType", "sensor_type"
        extra = []
    else:
        raise ValueError("by must be 'sensor' or 'type'")
    cols = [F.col(key_r).alias("_key")] + [F.col(c).alias(f"_{c}") for c in THRESHOLD_COLS + extra]
    from sensorium.operators.joins import broadcast_if_small
    thr = broadcast_if_small(thresholds.select(*cols))
    return readings.join(thr, readings[key_l] == thr["_key"], how).drop("_key")


def fmt_number(x: Column) -> Column:
    """Double → text the way Python prints a float: plain from 0.0001 up to below
    1e16 (``12345678.5``, ``0.0005``), else with a two-digit exponent (``5e-05``)."""
    s = x.cast("string")                         # 1.23456785E7, 5.0E-4, 12.34
    digits, exponent = F.substring_index(s, "E", 1), F.substring_index(s, "E", -1).try_cast("int")
    plain = F.regexp_replace(s.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(digits, r"\.0$", "")
    sign = F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+"))
    power = F.abs(exponent).cast("string")
    power = F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power)
    return (F.when(x.isNull(), F.lit("None"))
            .when(F.isnan(x), F.lit("nan"))
            .when(F.abs(x) == float("inf"), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when(~F.contains(s, F.lit("E")), s)
            .when((F.abs(x) >= 1e-4) & (F.abs(x) < 1e16), plain)
            .otherwise(F.concat(mantissa, sign, power)))


def format_columns(template: str, **cols: Column) -> Column:
    """``str.format``-style template → ``concat`` of literals and columns."""
    parts = []
    for literal, field, _spec, _conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(cols[field])
    return F.concat(*parts)


def alert_message(stype: Column, below: Column, value: Column, unit: Column,
                  thr: Column) -> Column:
    """The alert message (A5) from the fixed below / above templates."""
    cols = dict(type=stype, value=fmt_number(value), unit=unit, threshold=fmt_number(thr))
    return F.when(below, format_columns(ALERT_MESSAGE_BELOW, **cols)) \
        .otherwise(format_columns(ALERT_MESSAGE_ABOVE, **cols))


def keep_fraction(key: Column, p: float, seed: int = 42) -> Column:
    """Deterministic Bernoulli(p) on a key (O8 / A7): replayable, no state.

    The first 52 bits of the MD5 of key and seed are a uniform draw.
    """
    if p >= 1.0:
        return F.lit(True)
    if p <= 0.0:
        return F.lit(False)
    draw = F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))).cast("binary")), 1, 13)
    return draw < F.lit(format(int(p * 16**13), "013x"))


def derive_alerts(readings: DataFrame, thresholds: DataFrame, by: str = "sensor",
                  low: float = ALERT_LOW_FACTOR, high: float = ALERT_HIGH_FACTOR,
                  keep_p: float = 1.0, id_col: str = "ReadingId") -> DataFrame:
    """Alerts from anomalous readings.

    * A1 only ``IsAnomaly`` rows raise alerts;
    * A2 value < min_normal → BelowThreshold, otherwise AboveThreshold;
    * A3 Critical when below and value < min_critical·low, or above and
      value > max_critical·high, else Warning;
    * A4 ThresholdValue = the crossed normal bound, 2 digits;
    * A5 message text; A6 identity columns from the reading;
    * A7 ``keep_p`` thins deterministically by the reading id (ratios above 1
      keep every anomaly).

    ``AlertId`` is derived from the reading id so a replayed reading produces
    the same alert (idempotent under at-least-once delivery).
    """
    keep_p = min(1.0, keep_p)
    r = readings.where(F.col("IsAnomaly"))
    if keep_p < 1.0:
        r = r.where(keep_fraction(F.col(id_col), keep_p))
    r = with_thresholds(r, thresholds, by, how="inner")
    v = F.col("ReadingValue")
    below = v < F.col("_min_normal")
    thr = F.when(below, F.col("_min_normal")).otherwise(F.col("_max_normal"))
    critical = F.when(below, v < F.col("_min_critical") * F.lit(low)) \
        .otherwise(v > F.col("_max_critical") * F.lit(high))
    stype = F.col("_sensor_type") if by == "sensor" else F.col("SensorType")
    return r.select(
        F.concat(F.lit("AL-"), F.col(id_col).cast("string")).alias("AlertId"),
        "SensorId", "ZoneId", "SiteId", "Timestamp", stype.alias("SensorType"),
        F.when(below, F.lit(ALERT_TYPE_BELOW)).otherwise(F.lit(ALERT_TYPE_ABOVE)).alias("AlertType"),
        F.when(critical, F.lit(SEVERITY_CRITICAL)).otherwise(F.lit(SEVERITY_WARNING)).alias("Severity"),
        v.alias("ReadingValue"),
        round_stable(thr, 2).alias("ThresholdValue"),
        alert_message(stype, below, v, F.col("_unit"), round_stable(thr, 2)).alias("Message"),
    )


def expected_value(readings: DataFrame, thresholds: DataFrame, by: str = "sensor",
                   amplitude: float = EXPECTED_AMPLITUDE, phase_sec: float = 0.0,
                   low_clamp: float = EXPECTED_CLAMP[0],
                   high_clamp: float = EXPECTED_CLAMP[1]) -> DataFrame:
    """Expected value of each reading (A8): ``mid + amplitude·spread·sin(2π·s/86400)``
    with ``s`` the second of day (shifted by ``phase_sec``), clamped to
    ``[low_clamp·min_normal, high_clamp·max_normal]``."""
    r = with_thresholds(readings, thresholds, by)
    mid = (F.col("_min_normal") + F.col("_max_normal")) / 2.0
    spread = (F.col("_max_normal") - F.col("_min_normal")) / 2.0
    angle = F.lit(2.0 * math.pi) * F.pmod(sec_of_day("Timestamp") + F.lit(phase_sec),
                                          F.lit(86400.0)) / F.lit(86400.0)
    raw = mid + F.sin(angle) * spread * F.lit(amplitude)
    ev = clamp(raw, F.col("_min_normal") * low_clamp, F.col("_max_normal") * high_clamp)
    cols = [c for c in readings.columns]
    return r.select(*cols, ev.alias("ExpectedValue"), spread.alias("_spread"),
                    F.col("_min_normal"), F.col("_max_normal"))


def residual_score(readings: DataFrame, thresholds: DataFrame, by: str = "sensor",
                   noise_scale: float = NOISE_SCALE) -> DataFrame:
    """(value − expected) / (noise_scale·spread) (A9); missing when spread is 0."""
    e = expected_value(readings, thresholds, by)
    score = F.try_divide(F.col("ReadingValue") - F.col("ExpectedValue"),
                         F.col("_spread") * F.lit(noise_scale))
    return e.select(*readings.columns, "ExpectedValue", score.alias("ResidualScore"))


def flag_quality(readings: DataFrame, thresholds: DataFrame, by: str = "sensor") -> DataFrame:
    """Out-of-normal-range flag and the quality flag it implies (A10); both are
    missing where the value or the thresholds are."""
    r = with_thresholds(readings, thresholds, by)
    v = F.col("ReadingValue")
    out = (v < F.col("_min_normal")) | (v > F.col("_max_normal"))
    return r.select(*readings.columns, out.alias("OutOfRange"),
                    F.when(out, F.lit(QUALITY_SUSPECT)).when(~out, F.lit(QUALITY_GOOD))
                    .alias("DerivedQuality"))


def range_band(readings: DataFrame, thresholds: DataFrame, by: str = "sensor") -> DataFrame:
    """normal / warning / critical band of each reading.

    normal inside [min_normal, max_normal]; critical outside
    [min_critical, max_critical]; warning in between.
    """
    r = with_thresholds(readings, thresholds, by)
    v = F.col("ReadingValue")
    band = (F.when(v.isNull() | F.col("_min_normal").isNull(), F.lit(None).cast("string"))
            .when((v >= F.col("_min_normal")) & (v <= F.col("_max_normal")), F.lit("normal"))
            .when((v < F.col("_min_critical")) | (v > F.col("_max_critical")), F.lit("critical"))
            .otherwise(F.lit("warning")))
    return r.select(*readings.columns, band.alias("RangeBand"))
