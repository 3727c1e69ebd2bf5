"""Scalar column functions: the rating scale, deviations and guarded division.

All of them return ``Column`` expressions, so they stay inside whole-stage
codegen wherever they are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rounding rule: similarities are compared and ranked after
# rounding to 12 decimals, predictions are reported with 6 decimals.
SIM_DIGITS = 12
PRED_DIGITS = 6


@dataclass(frozen=True)
class RatingScale:
    """Bounds of the rating scale (1 to 5 stars by default)."""

    lo: float = 1.0
    hi: float = 5.0


DEFAULT_SCALE = RatingScale()


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scale(x: Column | str, avg: Column | str, bounds: RatingScale = DEFAULT_SCALE) -> Column:
    """Distance from ``avg`` to the bound on the side of ``x``; 1 when ``x == avg``."""
    x, avg = _col(x), _col(avg)
    return (
        F.when(x > avg, F.lit(bounds.hi) - avg)
        .when(x < avg, avg - F.lit(bounds.lo))
        .otherwise(F.lit(1.0))
    )


def deviation(rating: Column | str, avg: Column | str, bounds: RatingScale = DEFAULT_SCALE) -> Column:
    """Scale-normalised deviation of a rating from the user mean, in [-1, 1]."""
    rating, avg = _col(rating), _col(avg)
    return (rating - avg) / scale(rating, avg, bounds)


def rescale(avg: Column | str, w: Column | str, bounds: RatingScale = DEFAULT_SCALE) -> Column:
    """Map a weighted deviation back onto the rating scale around the user mean."""
    avg, w = _col(avg), _col(w)
    return avg + w * scale(avg + w, avg, bounds)


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` with 0 for a zero or missing denominator (ANSI-safe)."""
    return F.coalesce(F.try_divide(_col(num), _col(den)), F.lit(0.0))


# Doubles at or above 2**52 have no fractional part left to round.
_EXACT = float(2**52)


def tidy(x: Column | str, digits: int) -> Column:
    """Round to ``digits`` decimals, half away from zero, and turn -0.0 into 0.0.

    Plain arithmetic on the scaled value (``sign(x) * floor(|x| * 10^d + 0.5) /
    10^d``): it stays in generated code, whereas ``round`` on a double goes
    through a ``BigDecimal`` per row (about 7x slower on the pair table), and it
    is the same rounding DuckDB applies to doubles, so the oracle agrees.
    """
    x = _col(x)
    m = float(10**digits)
    scaled = F.abs(x) * F.lit(m)
    rounded = F.signum(x) * F.floor(scaled + F.lit(0.5)).cast("double") / F.lit(m)
    return F.when(scaled < F.lit(_EXACT), rounded).otherwise(x) + F.lit(0.0)
