"""Readers and writers: daily JSON watch logs, monthly parquet search logs,
the keyword -> genre CSV, and the driver's test tables re-shaped into those logs."""

from watchfold.sources.files import (
    WATCH_LOG_SCHEMA,
    SEARCH_LOG_SCHEMA,
    GENRE_MAPPING_SCHEMA,
    day_paths,
    export_distinct_programs,
    read_genre_mapping,
    read_search_logs,
    read_watch_logs,
    write_genre_mapping,
)
from watchfold.sources.fixtures import (
    DriverTables,
    genre_mapping_fixture,
    log_content_fixture,
    log_search_fixture,
)

__all__ = [
    "WATCH_LOG_SCHEMA", "SEARCH_LOG_SCHEMA", "GENRE_MAPPING_SCHEMA", "DriverTables",
    "day_paths", "export_distinct_programs", "genre_mapping_fixture", "log_content_fixture",
    "log_search_fixture", "read_genre_mapping", "read_search_logs", "read_watch_logs",
    "write_genre_mapping",
]
