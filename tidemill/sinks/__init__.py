"""Where rows go: layer tables, databases, CSV exports."""

from tidemill.sinks.exports import export_csv
from tidemill.sinks.jdbc import jdbc_write_options, write_jdbc
from tidemill.sinks.tables import RunReport, append, compact, init_layers, merge_rows, overwrite_partitions, replace_table

__all__ = [
    "export_csv", "jdbc_write_options", "write_jdbc",
    "RunReport", "append", "compact", "init_layers", "merge_rows", "overwrite_partitions", "replace_table",
]
