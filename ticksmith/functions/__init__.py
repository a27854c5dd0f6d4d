"""Column expressions shared by every operator (all JVM-side built-ins)."""

from ticksmith.functions.numeric import (in_range, is_nonzero, is_positive,
                                         no_negative_zero, round_half_even)
from ticksmith.functions.text import direction_arrow, mover_line, thousands
from ticksmith.functions.timefn import (NAIROBI, epoch_order_key, floor_time,
                                        in_session, instant_to_utc, iso_local,
                                        local_date, local_to_utc, micros_to_ntz,
                                        month_key, ntz_micros, parse_instant,
                                        parse_to_utc, utc_to_local,
                                        wall_to_instant)

__all__ = [
    "NAIROBI", "direction_arrow", "epoch_order_key", "floor_time", "in_range",
    "in_session", "instant_to_utc", "is_nonzero", "is_positive", "iso_local",
    "local_date", "local_to_utc", "micros_to_ntz", "month_key", "mover_line",
    "no_negative_zero", "ntz_micros", "parse_instant", "parse_to_utc",
    "round_half_even", "thousands", "utc_to_local", "wall_to_instant",
]
