from sluiceworks.sources.landing import landed_files, manifest_frame, presence, read_csv
from sluiceworks.sources.raw import as_text, read_parquet, stamped, with_row_id
from sluiceworks.sources.store import (
    at_rest,
    create_schema,
    drop_schema,
    overwrite,
    read_table,
    tables_in,
)

__all__ = [
    "as_text",
    "at_rest",
    "create_schema",
    "drop_schema",
    "landed_files",
    "manifest_frame",
    "overwrite",
    "presence",
    "read_csv",
    "read_parquet",
    "read_table",
    "stamped",
    "tables_in",
    "with_row_id",
]
