"""quayside: load dated delimited files into partitioned catalog tables and prove each load.

Every operator takes and returns Spark ``DataFrame`` objects and runs as ordinary
Spark jobs; nothing but one-row (or one-row-per-date) aggregates reaches the driver.
"""

from quayside.functions.schema import column_spec_to_schema
from quayside.plans.load import LoadResult, load_to_table
from quayside.sinks.delimited import write_delimited
from quayside.sinks.table import ensure_database, write_table
from quayside.sources.delimited import read_dated_files, read_delimited, resolve_dated_path
from quayside.spec import DatasetSpec, LoadSpec, TableSpec

__all__ = [
    "DatasetSpec",
    "LoadResult",
    "LoadSpec",
    "TableSpec",
    "column_spec_to_schema",
    "ensure_database",
    "load_to_table",
    "read_dated_files",
    "read_delimited",
    "resolve_dated_path",
    "write_delimited",
    "write_table",
]
