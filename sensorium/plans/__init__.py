"""Named queries (``REGISTRY``) and their SQL oracles (``ORACLE``)."""

from sensorium.plans.oracle import ORACLE
from sensorium.plans.queries import REGISTRY
from sensorium.plans import semantic as _semantic  # noqa: F401  (registers queries)
from sensorium.plans import derived as _derived    # noqa: F401  (registers queries)
from sensorium.plans import streamed as _streamed  # noqa: F401  (registers queries)

__all__ = ["ORACLE", "REGISTRY"]
