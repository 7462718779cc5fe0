"""Per-call access to the model tables over one test-data directory."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorium.operators.alerts import threshold_table
from sensorium.operators.model import SensorModel
from sensorium.operators.navigate import BY_SENSOR, Lattice, SensorPieces
from sensorium.plans.views import LATTICE_BASE, VIEWS, ViewDef
from sensorium.session import scratch_path
from sensorium.sources import testdata as td
from sensorium.sources.dimensions import write_bucketed
from sensorium.sources.stored import footers
from sensorium.streaming.batchlog import BatchTable
from sensorium.streaming.incremental import IncrementalView


class Ctx:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._stores: dict[str, IncrementalView] = {}
        self._facts: dict[str, BatchTable] = {}
        self._bucketed: tuple[DataFrame, DataFrame] | None = None
        self.pin_utc()

    def pin_utc(self) -> None:
        # Every time in the model is UTC (bins, "now", second of day); the
        # test tables store UTC wall-clock times without a zone.
        if self.spark.conf.get("spark.sql.session.timeZone") != "UTC":
            self.spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return td.table(self.spark, self.sf_dir, name)

    @cached_property
    def readings(self) -> DataFrame:
        """SensorReading with ZoneId / SiteId."""
        return td.readings(self.spark, self.sf_dir, located=True)

    @cached_property
    def readings_plain(self) -> DataFrame:
        """SensorReading without the location join (for queries that never
        read ZoneId / SiteId)."""
        return td.readings(self.spark, self.sf_dir, located=False)

    def locate(self, df: DataFrame, key: str = "SensorId") -> DataFrame:
        """Attach ZoneId / SiteId to (partial or raw) fact rows."""
        return td.locate(df, self.spark, self.sf_dir, key)

    def _store(self, view: ViewDef) -> IncrementalView:
        """A view kept as a store of its own, built once from its whole source; queries
        that serve from it read the store."""
        if view.name not in self._stores:
            store = IncrementalView(self.spark, view, f"{scratch_path(self.spark, 'store')}/{view.name}")
            located = "SiteId" in view.keys
            if view.source == "readings":
                rows = self.readings if located else self.readings_plain
            else:
                rows = self.alerts if located else self.alerts_plain
            store.backfill(rows)
            self._stores[view.name] = store
        return self._stores[view.name]

    def stored_view(self, name: str) -> IncrementalView:
        return self._store(VIEWS[name])

    @cached_property
    def lattice(self) -> Lattice:
        """The readings' views, all served from one store of hourly partials."""
        return Lattice([self._store(LATTICE_BASE)], lambda: self.readings)

    @cached_property
    def stored_model(self) -> SensorModel:
        """The measure layer over partials by sensor and day."""
        return replace(self.model, stored={f: SensorPieces(self._store(v)) for f, v in BY_SENSOR.items()})

    @cached_property
    def clustered_model(self) -> SensorModel:
        """The measure layer over readings stored by day and sensor."""
        readings = self.stored_facts("readings").read(self.readings_plain.schema)
        return replace(self.model, readings=readings, clustered=("readings",))

    def footers(self, name: str) -> DataFrame:
        """A test table whose counts come from its footers."""
        return footers(self.spark, f"{self.sf_dir}/{name}.parquet")

    def stored_facts(self, fact: str) -> BatchTable:
        """Readings stored by day, or alerts by month, as ingest stores them."""
        if fact not in self._facts:
            column, unit, rows = {"readings": ("event_date", "day", self.readings_plain),
                                  "alerts": ("event_month", "month", self.alerts_plain)}[fact]
            table = BatchTable(self.spark, f"{scratch_path(self.spark, 'facts')}/{fact}", [column], ["SensorId"])
            table.write(rows.withColumn(column, F.to_date(F.date_trunc(unit, "Timestamp"))), 0, "history")
            self._facts[fact] = table
        return self._facts[fact]

    def bucketed(self, buckets: int = 8) -> tuple[DataFrame, DataFrame]:
        """Readings and sensors stored by the same buckets of the sensor, built once."""
        if self._bucketed is None:
            root = scratch_path(self.spark, "bucketed")
            unique = root.rsplit("-", 1)[-1]
            self._bucketed = tuple(
                write_bucketed(df, f"bucketed_{name}_{unique}", key, buckets, f"{root}/{name}")
                for name, df, key in (("readings", self.readings_plain, "SensorId"), ("sensors", self.sensors, "sensor_id")))
        return self._bucketed

    @cached_property
    def alerts(self) -> DataFrame:
        return td.stored_alerts(self.spark, self.sf_dir, located=True)

    @cached_property
    def alerts_plain(self) -> DataFrame:
        return td.stored_alerts(self.spark, self.sf_dir, located=False)

    @cached_property
    def sites(self) -> DataFrame:
        return td.sites(self.spark, self.sf_dir)

    @cached_property
    def zones(self) -> DataFrame:
        return td.zones(self.spark, self.sf_dir)

    @cached_property
    def sensors(self) -> DataFrame:
        return td.sensors(self.spark, self.sf_dir)

    @cached_property
    def thresholds(self) -> DataFrame:
        return threshold_table(self.spark)

    @cached_property
    def model(self) -> SensorModel:
        # The facts enter the model without the location join: the model
        # reaches zones and sites through its own dimension chain.
        return SensorModel(readings=self.readings_plain, alerts=self.alerts_plain,
                           dim_sites=self.sites, dim_zones=self.zones,
                           dim_sensors=td.sensors(self.spark, self.sf_dir, with_site=False,
                                                  with_thresholds=False))
