from tickfold.sources.commits import CommitLog, Conflict, LoggedSink, Snapshot
from tickfold.sources.relational import JdbcTable
from tickfold.sources.tables import FileTable, append_new, high_water
from tickfold.sources.wide import (
    KeyRange,
    PageFinder,
    full_scan,
    incremental_page,
    key_after,
    key_from,
    key_until,
    late_rows,
    key_range,
    next_page_ends,
    page_ends,
    page_per_split,
)

__all__ = [
    "CommitLog",
    "Conflict",
    "FileTable",
    "JdbcTable",
    "KeyRange",
    "LoggedSink",
    "PageFinder",
    "Snapshot",
    "append_new",
    "full_scan",
    "high_water",
    "incremental_page",
    "key_after",
    "key_from",
    "key_range",
    "key_until",
    "late_rows",
    "next_page_ends",
    "page_ends",
    "page_per_split",
]
