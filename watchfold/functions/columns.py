"""Scalar column expressions. All are built-in Spark functions, so they stay
inside whole-stage codegen and fold to constants where their input is a literal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from watchfold.functions.constants import (
    ACTIVE_DAY_BINS,
    ACTIVE_DAY_TOP_BIN,
    ACTIVE_DAY_UNKNOWN_BIN,
    APP_CATEGORIES,
    DEFAULT_GENRE,
    GENRE_EXAMPLES,
    GENRE_RULES,
    PLACEHOLDER_CONTRACTS,
    PROGRAM_SYNONYMS,
    UNKNOWN_CATEGORY,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def app_category(app_name: str | Column = "AppName") -> Column:
    """Watch category of an app name; unknown names and NULL give ``Error``."""
    name = _col(app_name)
    expr = None
    for category, apps in APP_CATEGORIES.items():
        cond = name.isin(*apps)
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr.otherwise(F.lit(UNKNOWN_CATEGORY))


def valid_contract(contract: str | Column = "Contract") -> Column:
    """True for a real contract: not NULL and not one of the placeholders."""
    c = _col(contract)
    return c.isNotNull() & ~c.isin(*PLACEHOLDER_CONTRACTS)


def month_of(date_col: str | Column) -> Column:
    """``yyyyMM`` tag of a date (four-digit years). Integer arithmetic and one cast:
    cheaper per row than a pattern-based ``date_format`` on billions of log rows."""
    d = _col(date_col)
    return (F.year(d) * 100 + F.month(d)).cast("string")


def month_index(month_yyyymm: str | Column = "month_yyyymm") -> Column:
    """Months since year 0 for a ``yyyyMM`` tag, so the previous month is index - 1."""
    m = _col(month_yyyymm)
    return F.substring(m, 1, 4).cast("int") * 12 + F.substring(m, 5, 2).cast("int") - 1


def active_days_bin(active_days: str | Column = "Active_Days") -> Column:
    """Five-day bins; NULL is ``Unknown`` and anything else outside [0, 30) is ``30``."""
    d = _col(active_days)
    expr = F.when(d.isNull(), F.lit(ACTIVE_DAY_UNKNOWN_BIN))
    for lo, hi, label in ACTIVE_DAY_BINS:
        expr = expr.when((d >= lo) & (d < hi), F.lit(label))
    return expr.otherwise(F.lit(ACTIVE_DAY_TOP_BIN))


def active_days_bin_order(bin_label: str | Column = "active_days_bin") -> Column:
    """Display position of a bin: the ranges in order, then ``30``, then the rest."""
    b = _col(bin_label)
    labels = [label for _, _, label in ACTIVE_DAY_BINS] + [ACTIVE_DAY_TOP_BIN]
    expr = None
    for pos, label in enumerate(labels, start=1):
        expr = F.when(b == label, F.lit(pos)) if expr is None else expr.when(b == label, F.lit(pos))
    return expr.otherwise(F.lit(len(labels) + 1))


def program_label(program: str) -> Column:
    """The program name as echoed by the top-k report: ``upper(trim(name))``."""
    return F.upper(F.trim(F.lit(program)))


def program_duration(program: str) -> Column:
    """Duration column chosen by a program name (trimmed, lower-cased, synonyms
    accepted); an unknown name gives a NULL duration. The name is a literal, so
    the optimizer folds the whole CASE to a single column reference."""
    key = F.lower(F.trim(F.lit(program)))
    expr = None
    for synonym, column in PROGRAM_SYNONYMS.items():
        expr = (F.when(key == synonym, F.col(column)) if expr is None
                else expr.when(key == synonym, F.col(column)))
    return expr.otherwise(F.lit(None).cast("bigint"))


def rule_genre(keyword: str | Column = "most_searched") -> Column:
    """Offline genre label: the prompt's worked examples by exact match, then its
    quick rules as case-insensitive substrings, else ``Other``."""
    kw = _col(keyword)
    lowered = F.lower(kw)
    expr = None
    for example, genre in GENRE_EXAMPLES.items():
        cond = kw == example
        expr = F.when(cond, F.lit(genre)) if expr is None else expr.when(cond, F.lit(genre))
    for words, genre in GENRE_RULES:
        cond = reduce(lambda a, b: a | b, [lowered.contains(w.lower()) for w in words])
        expr = expr.when(cond, F.lit(genre))
    return F.when(kw.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(DEFAULT_GENRE)))
