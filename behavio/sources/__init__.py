"""Sources and sinks: delimited text layouts with rejects, the Parquet
test tables, and Kafka options-level reader/writer."""

from .lines import LAYOUTS, read_lines, parse_lines
from .tables import table, TABLES
from .kafka import kafka_records, read_kafka, write_kafka

__all__ = ["LAYOUTS", "read_lines", "parse_lines", "table", "TABLES", "kafka_records", "read_kafka", "write_kafka"]
