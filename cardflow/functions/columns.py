"""Column expressions: text normalisation, padding, rule chains and source overlays.

All built from ``pyspark.sql.functions`` so they stay inside whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardflow.functions.dates import NEVER

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def blank_to_null(c: ColumnLike) -> Column:
    """``NULLIF(TRIM(c), '')``: blank or space-only text becomes NULL (CMP-1).

    ``trim`` removes spaces only, so a tab-only value stays non-blank, as in the SQL original.
    """
    return F.nullif(F.trim(col(c)), F.lit(""))


def pad_id(c: ColumnLike, width: int) -> Column:
    """``LPAD(c::text, width, '0')`` (FN-1). Longer text is cut to ``width`` characters."""
    return F.lpad(col(c).cast("string"), width, "0")


def overlong(c: ColumnLike, width: int) -> Column:
    """True where ``pad_id`` would cut the value (use to flag ids wider than the report field)."""
    return F.length(col(c).cast("string")) > width


def first_char(c: ColumnLike) -> Column:
    """``SUBSTR(c, 1, 1)`` (FN-5)."""
    return F.substring(col(c), 1, 1)


def case_when(rules: Sequence[tuple[Column, object]], default=None) -> Column:
    """Searched ``CASE``: ordered ``(condition, value)`` rules, first match wins (PRJ-5).

    A rule whose condition is NULL does not match, exactly like SQL.
    """
    if not rules:
        return lit_or_col(default)
    cond, val = rules[0]
    out = F.when(cond, lit_or_col(val))
    for cond, val in rules[1:]:
        out = out.when(cond, lit_or_col(val))
    return out.otherwise(lit_or_col(default))


def decode(c: ColumnLike, mapping: Mapping[object, object], default=None) -> Column:
    """Equality decode of one column with a default (PRJ-6, CMP-12).

    Keys are tested in mapping order; a NULL input matches no key and gets ``default``.
    """
    c = col(c)
    return case_when([(c == F.lit(k), v) for k, v in mapping.items()], default)


def flag(c: ColumnLike, yes: str, no: str) -> Column:
    """Presence to label: non-NULL gives ``yes``, NULL gives ``no`` (PRJ-9)."""
    return F.when(col(c).isNotNull(), F.lit(yes)).otherwise(F.lit(no))


def prefer(primary: ColumnLike, *fallbacks: ColumnLike) -> Column:
    """Primary-else-secondary per field, ``COALESCE`` (CMP-7, FN-4)."""
    return F.coalesce(col(primary), *[col(f) for f in fallbacks])


def primary_is_newer(p_date: ColumnLike, s_date: ColumnLike, never: dt.date = NEVER) -> Column:
    """``COALESCE(p_date, never) >= COALESCE(s_date, never)``: ties go to the primary."""
    return F.coalesce(col(p_date), F.lit(never)) >= F.coalesce(col(s_date), F.lit(never))


def newest_wins(p_date: ColumnLike, s_date: ColumnLike, p_val: ColumnLike, s_val: ColumnLike,
                never: dt.date = NEVER) -> Column:
    """Newest-status-wins overlay of two sources (CMP-6).

    The source with the newer status date (NULL read as ``never``) gives the value; if that
    value is NULL the other source's value is used. Equal dates favour the primary.
    """
    return (F.when(primary_is_newer(p_date, s_date, never), F.coalesce(col(p_val), col(s_val)))
            .otherwise(F.coalesce(col(s_val), col(p_val))))


def override(base: ColumnLike, rules: Sequence[tuple[Column, object]]) -> Column:
    """Cross-field override: the first matching rule rewrites ``base``, else ``base`` (CMP-8)."""
    return case_when(rules, col(base))


def not_in_values(c: ColumnLike, values: Iterable[object]) -> Column:
    """``c NOT IN (values)`` with SQL three-valued logic: NULL input gives NULL (not true)."""
    return ~col(c).isin(list(values))
