from cartspark.sources.events import (
    ADD_TO_CART,
    CART_EVENTS,
    EVENT_SCHEMA,
    EVENT_TYPES,
    LOG_SCHEMA,
    PURCHASE,
    REQUIRED_COLUMNS,
    VIEW,
    canonical_events,
    conform_events,
    first_events,
    read_events,
    require_columns,
    sample_rows,
)
from cartspark.sources.rejects import fault_counts, rejected_rows, scan_rows
from cartspark.sources.results import read_result, write_result, write_table
from cartspark.sources.versions import (
    names_in,
    new_version,
    read_pointer,
    remove_table,
    version_folder,
    write_pointer,
)

__all__ = [
    "ADD_TO_CART",
    "CART_EVENTS",
    "EVENT_SCHEMA",
    "EVENT_TYPES",
    "LOG_SCHEMA",
    "PURCHASE",
    "REQUIRED_COLUMNS",
    "VIEW",
    "canonical_events",
    "conform_events",
    "fault_counts",
    "first_events",
    "names_in",
    "new_version",
    "read_events",
    "read_pointer",
    "read_result",
    "rejected_rows",
    "remove_table",
    "require_columns",
    "sample_rows",
    "scan_rows",
    "version_folder",
    "write_pointer",
    "write_result",
    "write_table",
]
