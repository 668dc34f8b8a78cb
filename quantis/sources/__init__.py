"""Sources (parquet / CSV / JDBC / catalog), sinks, and the binding of the
test tables to the forecast domain."""

from quantis.sources import binding
from quantis.sources.readers import catalog_union, clear_plans, csv_headers, read_csv, read_jdbc, read_table
from quantis.sources.sinks import ClaimedError, partition_values, publish_once, publish_table_once, write_partitioned, write_report

__all__ = [
    "ClaimedError",
    "binding",
    "catalog_union",
    "clear_plans",
    "csv_headers",
    "partition_values",
    "publish_once",
    "publish_table_once",
    "read_csv",
    "read_jdbc",
    "read_table",
    "write_partitioned",
    "write_report",
]
