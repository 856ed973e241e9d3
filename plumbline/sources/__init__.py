from plumbline.sources.readers import (
    csv_schema,
    load_each,
    load_source,
    load_table,
    load_tables,
    read_csv,
    read_documents,
    read_view,
    table_inventory,
)
from plumbline.sources.workspace import work_dir
from plumbline.sources.writers import (
    append_table,
    ensure_namespace,
    export_tables,
    overwrite_partitions,
    write_csv,
    write_documents,
    write_lines,
)

__all__ = [
    "append_table",
    "csv_schema",
    "ensure_namespace",
    "export_tables",
    "load_each",
    "load_source",
    "load_table",
    "load_tables",
    "overwrite_partitions",
    "read_csv",
    "read_documents",
    "read_view",
    "table_inventory",
    "work_dir",
    "write_csv",
    "write_documents",
    "write_lines",
]
