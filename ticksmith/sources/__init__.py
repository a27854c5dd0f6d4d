"""Sources: Parquet tables, message logs (Kafka / file), driver-data views."""

from ticksmith.sources.events import (events_as_bronze, events_as_messages,
                                      events_as_snapshots, read_events,
                                      user_ticker)
from ticksmith.sources.kafka import (MESSAGE_LOG, TICK_TOPIC, read_kafka_ticks,
                                     read_message_log, read_text_messages,
                                     write_kafka, write_message_log)
from ticksmith.sources.tables import read_partitioned, read_table, table_path

__all__ = [
    "MESSAGE_LOG", "TICK_TOPIC", "events_as_bronze", "events_as_messages",
    "events_as_snapshots", "read_events", "read_kafka_ticks", "read_message_log",
    "read_partitioned", "read_table", "read_text_messages", "table_path",
    "user_ticker", "write_kafka", "write_message_log",
]
