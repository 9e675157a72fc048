"""Column-level building blocks (all JVM-side ``pyspark.sql.functions``)."""

from watchfold.functions.columns import (
    active_days_bin,
    active_days_bin_order,
    app_category,
    month_index,
    month_of,
    program_duration,
    program_label,
    rule_genre,
    valid_contract,
)
from watchfold.functions.constants import (
    APP_CATEGORIES,
    GENRES,
    PROGRAM_TYPES,
    WATCH_TYPES,
)

__all__ = [
    "APP_CATEGORIES", "GENRES", "PROGRAM_TYPES", "WATCH_TYPES",
    "active_days_bin", "active_days_bin_order", "app_category", "month_index",
    "month_of", "program_duration", "program_label", "rule_genre", "valid_contract",
]
