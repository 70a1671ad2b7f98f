"""Where rows go: lake tables, database tables, views, incremental models."""

from millrace.sinks.tables import (
    append_partitioned,
    as_table,
    as_view,
    overwrite,
    write_incremental,
    write_jdbc,
)

__all__ = ["append_partitioned", "as_table", "as_view", "overwrite", "write_incremental", "write_jdbc"]
