"""String expressions for the text reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report arrows and direction labels.
UP_ARROW = "↑"
DOWN_ARROW = "↓"
GAINER = "gainer"
LOSER = "loser"


def direction_arrow(direction: Column) -> Column:
    """'↑' for gainers, '↓' otherwise."""
    return F.when(direction == GAINER, F.lit(UP_ARROW)).otherwise(F.lit(DOWN_ARROW))


def mover_line(direction: Column, ticker: Column, pct: Column) -> Column:
    """``  ↑ TICKER    +1.23%  (gainer)`` — ticker left-padded to 8 columns."""
    return F.format_string("  %s %-8s  %+.2f%%  (%s)",
                           direction_arrow(direction), ticker, pct.cast("double"), direction)


def thousands(n: Column) -> Column:
    """``{:,}`` for a whole number."""
    return F.format_number(n, 0)
