"""Where rows come from: layer tables, operational tables over JDBC, event files, streams and change logs."""

from tidemill.sources.changes import read_changes, unwrap
from tidemill.sources.events import quarantine_json, read_event_stream, read_json_events, read_kafka_json
from tidemill.sources.jdbc import jdbc_read_options, read_jdbc
from tidemill.sources.tables import is_ready, lookup, pending, read_dimension, read_layer, register_views

__all__ = [
    "read_changes", "unwrap", "quarantine_json", "read_event_stream", "read_json_events", "read_kafka_json",
    "jdbc_read_options", "read_jdbc", "is_ready", "lookup", "pending", "read_dimension", "read_layer", "register_views",
]
