"""Column-level helpers.  Every helper returns a ``pyspark.sql.Column`` built
from built-in functions only, so expressions stay inside whole-stage codegen."""

from sensorium.functions.scalar import (
    bin_time,
    bool_text,
    clamp,
    divide,
    from_iso_text,
    ieq,
    kql_ratio,
    ne_safe,
    pad_id,
    parse_bool,
    parse_span,
    pct,
    round_stable,
    sec_of_day,
    to_iso_text,
)

__all__ = [
    "bin_time", "bool_text", "clamp", "divide", "from_iso_text", "ieq", "kql_ratio",
    "ne_safe", "pad_id", "parse_bool", "parse_span", "pct", "round_stable",
    "sec_of_day", "to_iso_text",
]
