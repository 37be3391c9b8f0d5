from rollcall.sources.files import (
    attach_bucketed,
    list_directories,
    list_files,
    read_csv,
    read_saved_csv,
    read_saved_json,
    rows_per_file,
    save,
    save_bucketed,
    scratch_path,
    store,
    stored_schema,
)

__all__ = [
    "attach_bucketed",
    "list_directories",
    "list_files",
    "read_csv",
    "read_saved_csv",
    "read_saved_json",
    "rows_per_file",
    "save",
    "save_bucketed",
    "scratch_path",
    "store",
    "stored_schema",
]
