"""Operators of a training-data pipeline, one module each, with their queries and SQL.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries
when it can be imported.
"""

from __future__ import annotations

import importlib

from watchfold.llm.oracle import ORACLE_SQL

MODULES = ["language_id", "bpe", "ngram_join", "substring_dedup", "suffix_dedup", "decontamination", "token_counts",
           "fingerprints", "quality", "licenses", "simhash", "centroids",
           "whitening"]

QUERIES: dict = {}
for _name in MODULES:
    QUERIES.update(importlib.import_module(f"{__name__}.{_name}").QUERIES)

__all__ = ["MODULES", "ORACLE_SQL", "QUERIES"]
