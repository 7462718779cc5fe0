"""sensorium — sensor-telemetry analytics as plain Spark DataFrame operators.

Sub-packages:

* ``functions``  — Column helpers (rounding, DIVIDE, time bins, text forms).
* ``sources``    — batch sources and sinks, table management, test-table views.
* ``operators``  — relational operators, alert rules, hierarchy build, the
  measure layer (semantic model).
* ``plans``      — the named queries (views, tiles, ad-hoc, measures, reports)
  and their SQL oracles.
* ``streaming``  — file / event streams, routing, incremental views.
"""

from sensorium.session import get_spark, scratch_path
from sensorium.operators.model import SensorModel
from sensorium.plans.views import VIEWS, Agg, ViewDef
from sensorium.streaming.batchlog import BatchTable
from sensorium.streaming.incremental import IncrementalView
from sensorium.streaming.ingest import Ingest, event_stream

__all__ = ["Agg", "BatchTable", "IncrementalView", "Ingest", "SensorModel", "VIEWS", "ViewDef",
           "event_stream", "get_spark", "scratch_path"]
