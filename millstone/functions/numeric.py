"""Numeric helpers shared by queries."""

from pyspark.sql import Column
from pyspark.sql import functions as F

STABLE_DIGITS = 6   # reported doubles carry 6 decimals
# Fixed nudge (pi/3 * 1e-9) applied away from zero before rounding.  Means of
# short decimals often sit exactly on a half-way point (7.9788125); engines
# that sum in a different order then land a last bit above or below it and
# round apart.  The nudge moves such values off the boundary; no realistic
# value sits exactly one nudge below a boundary.
NUDGE = 1.0471975511965976e-09


def stable(c, digits: int = STABLE_DIGITS) -> Column:
    """Round a reported double to ``digits`` decimals, tie-safe across
    engines; presentation rounding (1–3 digits) is left to the caller."""
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x + F.signum(x) * F.lit(NUDGE), digits)


def pct(num, den) -> Column:
    """100 * num / den with a zero guard (NULL when den = 0)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.try_divide(F.lit(100.0) * n, d.cast("double"))
