"""Site → zone → sensor hierarchy build.

Zones are sites × zone ordinals, sensors are zones × sensor ordinals.  Both
expansions are ``posexplode`` of a small literal array (the per-parent fan-out
is a configuration constant), so every parent row expands in its own task —
no cross join and no global row numbering.  Sequential ids come from ordinal
arithmetic on the parent's own ordinal.

A few bytes of a stored site become ``per_site · per_zone`` sensors, so one file
split of a large table of sites is far too much for one task: ``deal_sites`` deals
the sites out first, and ``count_ids`` compares ids in as many tasks.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorium.functions.scalar import zero_pad
from sensorium.schemas import (
    SENSOR_ID_FORMAT, SENSOR_INSTALL_DATE, SENSOR_NAME_FORMAT, SENSOR_TYPES, SENSORS_PER_ZONE,
    SITE_ID_FORMAT, SITE_LATITUDE, SITE_LONGITUDE, ZONE_AREA, ZONE_ID_FORMAT, ZONE_NAME_FORMAT,
    ZONE_TYPES, ZONES_PER_SITE,
)

#: Sensors that one task makes, and ids that one task compares.
SENSORS_PER_TASK = 500_000


def _format(template: str, **cols: Column) -> Column:
    """A fixed ``str.format`` template over columns; ``{n:03d}`` zero-pads."""
    parts = []
    for literal, field, spec, _conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is None:
            continue
        c = cols[field].cast("string")
        if spec and spec.endswith("d") and spec.startswith("0"):
            c = zero_pad(c, int(spec[1:-1]))
        parts.append(c)
    return F.concat(*parts)


def build_sites(src: DataFrame, ordinal: str, name: str, region: str | None = None,
                country: str | None = None) -> DataFrame:
    """dim_sites from a table of site rows; ``ordinal`` is 0-based.

    Id, latitude and longitude follow the fixed formats and steps of
    ``sensorium.schemas``; every site is active.
    """
    i = F.col(ordinal)
    return src.select(
        _format(SITE_ID_FORMAT, n=i + 1).alias("site_id"),
        F.col(name).alias("site_name"),
        (F.col(region) if region else F.lit(None).cast("string")).alias("region"),
        (F.col(country) if country else F.lit(None).cast("string")).alias("country"),
        F.round(F.lit(SITE_LATITUDE[0]) + i * SITE_LATITUDE[1], 4).alias("latitude"),
        F.round(F.lit(SITE_LONGITUDE[0]) + i * SITE_LONGITUDE[1], 4).alias("longitude"),
        F.lit(True).alias("is_active"),
        i.alias("_site_ord"),
    )


def build_zones(sites: DataFrame, per_site: int = ZONES_PER_SITE,
                zone_types: list[str] = ZONE_TYPES) -> DataFrame:
    """dim_zones: ``per_site`` zones per site with cyclic type choice.

    Id and name follow the fixed formats; floor ``j // 2 + 1``; area from the
    fixed base, step and per-letter factor (``ZONE_AREA``).
    """
    types = F.array(*[F.lit(t) for t in zone_types])
    z = sites.select("*", F.posexplode(F.array_repeat(F.lit(0), per_site)).alias("_j", "_unused"))
    j = F.col("_j")
    ztype = F.element_at(types, (F.pmod(j, F.lit(len(zone_types))) + 1).cast("int"))
    area = F.lit(ZONE_AREA[0]) + j * ZONE_AREA[1] + F.length("site_name") * ZONE_AREA[2]
    return z.select(
        _format(ZONE_ID_FORMAT, site_id=F.col("site_id"), n=j + 1).alias("zone_id"),
        _format(ZONE_NAME_FORMAT, zone_type=ztype, site_name=F.col("site_name")).alias("zone_name"),
        ztype.alias("zone_type"),
        F.col("site_id"),
        (F.floor(j / 2) + 1).cast("int").alias("floor"),
        F.round(area, 1).alias("area_sqm"),
        F.lit(True).alias("is_active"),
        (F.col("_site_ord") * per_site + j).alias("_zone_ord"),
    )


def build_sensors(zones: DataFrame, per_zone: int = SENSORS_PER_ZONE,
                  sensor_types=SENSOR_TYPES) -> DataFrame:
    """dim_sensors: ``per_zone`` sensors per zone, type ``k % len(types)``.

    The running number is ``zone_ordinal·per_zone + k + 1`` — the order in
    which a sequential loop over zones would number them.
    """
    info = F.array(*[F.struct(F.lit(t[0]).alias("name"), F.lit(t[1]).alias("unit"),
                              F.lit(t[2]).alias("min_normal"), F.lit(t[3]).alias("max_normal"),
                              F.lit(t[4]).alias("min_critical"), F.lit(t[5]).alias("max_critical"))
                     for t in sensor_types])
    s = zones.select("*", F.posexplode(F.array_repeat(F.lit(0), per_zone)).alias("_k", "_unused"))
    k = F.col("_k")
    t = F.element_at(info, (F.pmod(k, F.lit(len(sensor_types))) + 1).cast("int"))
    num = F.col("_zone_ord") * per_zone + k + 1
    return s.select(
        _format(SENSOR_ID_FORMAT, n=num).alias("sensor_id"),
        _format(SENSOR_NAME_FORMAT, sensor_type=t["name"], n=num).alias("sensor_name"),
        t["name"].alias("sensor_type"),
        t["unit"].alias("unit"),
        F.col("zone_id"),
        F.col("site_id"),
        t["min_normal"].alias("min_normal"),
        t["max_normal"].alias("max_normal"),
        t["min_critical"].alias("min_critical"),
        t["max_critical"].alias("max_critical"),
        F.lit(SENSOR_INSTALL_DATE).cast("date").alias("install_date"),
        F.lit(True).alias("is_active"),
    )


def build_hierarchy(sites_src: DataFrame, ordinal: str, name: str, region: str | None = None,
                    country: str | None = None, per_site: int = ZONES_PER_SITE,
                    per_zone: int = SENSORS_PER_ZONE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dim_sites, dim_zones, dim_sensors) from a table of sites."""
    sites = build_sites(sites_src, ordinal, name, region, country)
    zones = build_zones(sites, per_site)
    sensors = build_sensors(zones, per_zone)
    return sites.drop("_site_ord"), zones.drop("_zone_ord"), sensors


def hierarchy_tasks(n_sites: int, per_site: int = ZONES_PER_SITE, per_zone: int = SENSORS_PER_ZONE) -> int:
    """So many tasks that each has ``SENSORS_PER_TASK`` sensors at most, evenly dealt."""
    return max(1, math.ceil(n_sites * per_site * per_zone / SENSORS_PER_TASK))


def deal_sites(sites_src: DataFrame, tasks: int) -> DataFrame:
    """The table of sites dealt out evenly, whatever its files and however often a site repeats."""
    return sites_src.repartition(tasks)


def count_ids(sensors: DataFrame, tasks: int) -> DataFrame:
    """One row of a dim_sensors: rows, distinct ids of each level, longest sensor id.

    Each level is compared apart, as one aggregation with several distinct counts keeps
    every row's ids of all levels in one map.  Sensor ids hardly repeat, so they are dealt
    out to ``tasks`` before they are compared; zone and site ids do repeat within a
    task, which combines them before the shuffle.
    """
    ids = sensors.select("sensor_id").where(F.col("sensor_id").isNotNull()).repartition(tasks, "sensor_id")
    sensor_ids = ids.agg(F.count_distinct("sensor_id")).scalar()
    zone_ids = sensors.agg(F.count_distinct("zone_id")).scalar()
    levels = sensors.agg(F.count(F.lit(1)).alias("sensors"), F.count_distinct("site_id").alias("site_ids"),
                         F.max(F.length("sensor_id")).alias("longest"))
    return levels.select("sensors", F.coalesce(sensor_ids, F.lit(0)).alias("sensor_ids"),
                         F.coalesce(zone_ids, F.lit(0)).alias("zone_ids"), "site_ids", "longest")
