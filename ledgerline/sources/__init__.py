from ledgerline.sources.landing import (
    file_name,
    header_filter,
    landing_has_files,
    list_files,
    new_files,
    read_landing,
)

__all__ = ["file_name", "header_filter", "landing_has_files", "list_files", "new_files",
           "read_landing"]
