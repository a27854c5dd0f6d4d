"""DataFrame -> DataFrame operators (batch and, where Spark allows, streaming)."""

from ticksmith.operators.bars import BAR_WIDTH, ohlc_bars
from ticksmith.operators.ingest import (NSE_UNIVERSE, ingest_counts, normalise_snapshots,
                                        observe_parsed, observe_published,
                                        parse_messages, parsed_ticks, quarantined,
                                        sink_time, to_bronze, to_messages)
from ticksmith.operators.marts import (daily_summary, daily_summary_from_bronze, eligible_movers, ordered_daily,
                                       ordered_movers, top_movers, top_movers_single_pass)
from ticksmith.operators.quality import (REFERENCE_CHECKS, Check, blocking_failures,
                                         failing_rows, run_checks)
from ticksmith.operators.reports import (assert_ticks_today, health_by_day, health_today,
                                         latest_day, movers_report, peek, show)
from ticksmith.operators.staging import (keep_latest, latest_prices, stage_bars, stage_rejects,
                                         stage_ticks, valid_bar, valid_tick)

__all__ = [
    "BAR_WIDTH", "Check", "NSE_UNIVERSE", "REFERENCE_CHECKS", "assert_ticks_today",
    "blocking_failures", "daily_summary", "daily_summary_from_bronze", "eligible_movers", "failing_rows",
    "health_by_day", "health_today", "ingest_counts", "keep_latest", "latest_day",
    "latest_prices",
    "movers_report", "normalise_snapshots", "observe_parsed", "observe_published", "ohlc_bars", "ordered_daily",
    "ordered_movers", "parse_messages", "parsed_ticks", "peek", "quarantined",
    "run_checks", "show", "sink_time", "stage_bars", "stage_rejects", "stage_ticks",
    "to_bronze", "to_messages", "top_movers", "top_movers_single_pass",
    "valid_bar", "valid_tick",
]
