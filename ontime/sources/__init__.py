"""Sources, sinks and catalog helpers."""

from ontime.sources.catalog import (  # noqa: F401
    Candidate,
    drop_table,
    list_databases,
    list_tables,
    load_first,
    partition_columns,
    recover_partitions,
    refresh,
    register_external,
    save_as_table,
    scan_table,
    table_exists,
)
from ontime.sources.files import path_exists, read_csv_raw, read_csv_typed, read_parquet  # noqa: F401
from ontime.sources.fixture import flights, flights_from_lineitem, read_table, table_path  # noqa: F401
from ontime.sources.sinks import cut_lineage, persisted, write_layer  # noqa: F401
