"""Scalar Column helpers (F1–F17 of the survey).

Helpers exist only where Spark has no single call with the needed semantics.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorium.schemas import ISO_MICROS_Z

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_stable(x: ColumnOrName, digits: int) -> Column:
    """Round half away from zero to ``digits`` decimals, robust to binary noise.

    ``round`` implementations disagree on values such as 2.675 stored as
    2.67499999…; adding 1e-6 before ``floor`` makes every engine land on the
    same side.  The sign is restored so negative inputs round symmetrically.
    """
    x = _c(x)
    scale = float(10 ** digits)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5 + 1e-6)) / F.lit(scale)


def divide(a: ColumnOrName, b: ColumnOrName, alt=0.0) -> Column:
    """DIVIDE(a, b, alt): ``alt`` when b is 0 or missing, else a / b.

    A missing numerator stays missing (BLANK / n is BLANK).
    """
    a, b = _c(a), _c(b)
    alt_c = alt if isinstance(alt, Column) else F.lit(alt).cast("double")
    return F.when(F.coalesce(b, F.lit(0)) == 0, alt_c).otherwise(
        a.cast("double") / b.cast("double"))


def kql_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Real division as a query surface uses it: missing on a zero denominator."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def pct(a: ColumnOrName, n: ColumnOrName, digits: int, scale_first: bool = True) -> Column:
    """Percentage ``100·a/n`` rounded with :func:`round_stable`.

    ``scale_first`` picks the evaluation order ``(100.0*a)/n``; otherwise
    ``(a/n)*100`` — the two forms the query surfaces use.
    """
    a, n = _c(a).cast("double"), _c(n).cast("double")
    raw = F.try_divide(a * 100.0, n) if scale_first else F.try_divide(a, n) * 100.0
    return round_stable(raw, digits)


def ne_safe(x: ColumnOrName, value) -> Column:
    """Not-equal that counts a missing value as different."""
    return ~_c(x).eqNullSafe(value)


def ieq(x: ColumnOrName, value: str) -> Column:
    """Case-insensitive string equality."""
    return F.upper(_c(x)) == F.lit(value.upper())


def clamp(x: ColumnOrName, lo, hi) -> Column:
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.greatest(lo_c, F.least(hi_c, _c(x)))


def sec_of_day(ts: ColumnOrName) -> Column:
    """Seconds since UTC midnight, with the microsecond fraction."""
    micros = F.unix_micros(_c(ts).cast("timestamp"))
    return F.pmod(micros, F.lit(86_400_000_000)) / F.lit(1e6)


def zero_pad(n: ColumnOrName, width: int) -> Column:
    """``n`` as text with zeros on the left up to ``width``; longer numbers stay
    whole (``lpad`` would cut them)."""
    text = _c(n).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def pad_id(prefix: str, n: ColumnOrName, width: int) -> Column:
    """``prefix`` followed by ``n`` left-padded with zeros to ``width``."""
    return F.concat(F.lit(prefix), zero_pad(n, width))


_SPAN = re.compile(r"^\s*(\d+)\s*([a-zA-Z]+)\s*$")
_UNITS = {
    "s": 1, "sec": 1, "second": 1, "seconds": 1,
    "m": 60, "min": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
}


def parse_span(span: str | int) -> int:
    """``"15m"``, ``"1h"``, ``"1 day"`` or seconds → seconds."""
    if isinstance(span, int):
        return span
    m = _SPAN.match(span)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"unsupported time span {span!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def bin_time(ts: ColumnOrName, span: str | int) -> Column:
    """Floor a timestamp to a multiple of ``span`` counted from the epoch (UTC).

    Keeps the input type (``timestamp`` or ``timestamp_ntz``).  Missing input
    gives a missing bin, unlike ``window()`` which filters such rows out.
    """
    ts = _c(ts)
    step = parse_span(span) * 1_000_000
    rem = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(step))
    # Subtracting a day-time interval keeps ts's own type.
    return ts - F.make_dt_interval(secs=rem / F.lit(1e6))


def to_iso_text(ts: ColumnOrName) -> Column:
    """Timestamp → ``2024-01-01T00:00:00.000000Z`` (UTC)."""
    return F.date_format(_c(ts).cast("timestamp"), ISO_MICROS_Z)


def from_iso_text(text: ColumnOrName) -> Column:
    """ISO-8601 text (``Z`` or offset, any fraction length) → timestamp."""
    return F.try_to_timestamp(_c(text))


def bool_text(b: ColumnOrName) -> Column:
    """Boolean → ``true`` / ``false``."""
    return F.lower(_c(b).cast("string"))


def parse_bool(text: ColumnOrName) -> Column:
    """``true`` / ``false`` text (any case) → boolean; anything else → missing."""
    t = F.lower(F.trim(_c(text)))
    return F.when(t == "true", F.lit(True)).when(t == "false", F.lit(False))
