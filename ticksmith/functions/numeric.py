"""Numeric column expressions.

Two parity points drive this module:

* ``round(x, 2)`` on a float in the marts rounds half-to-even after scaling;
  Spark's ``round`` is HALF_UP on the decimal text (0.125 -> 0.13 instead of
  0.12).  ``rint`` is IEEE half-even, so ``rint(x * 100) / 100`` matches.
* In Spark (and DuckDB) ``NaN > 0`` is TRUE, while the reference engines
  treat NaN as failing every comparison.  Every "positive price" test goes
  through :func:`is_positive`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Round a DOUBLE to ``digits`` decimals, ties to even, staying DOUBLE."""
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def no_negative_zero(c: Column) -> Column:
    """Map ``-0.0`` to ``0.0`` so equal values hash equally."""
    return F.when(c == 0, F.lit(0.0)).otherwise(c)


def is_positive(c: Column) -> Column:
    """``c > 0`` with NaN failing, as in the reference engines."""
    return (c > 0) & ~F.isnan(c)


def is_nonzero(c: Column) -> Column:
    """``c != 0`` with NaN failing."""
    return (c != 0) & ~F.isnan(c)


def in_range(c: Column, lo: float | None = None, hi: float | None = None,
             inclusive: bool = True) -> Column:
    """Range test; NULL bounds are open, NaN is out of range.

    Returns NULL for a NULL input so callers can treat NULL as passing (the
    accepted_range data-quality rule).
    """
    ok = ~F.isnan(c.cast("double"))
    if lo is not None:
        ok = ok & ((c >= F.lit(lo)) if inclusive else (c > F.lit(lo)))
    if hi is not None:
        ok = ok & ((c <= F.lit(hi)) if inclusive else (c < F.lit(hi)))
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(ok)
