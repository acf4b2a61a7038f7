"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- strings -----------------------------------------------------------------

def full_name(first: ColumnLike, last: ColumnLike) -> Column:
    """``first || ' ' || last``; NULL when either part is NULL (never skips)."""
    return F.concat(col(first), F.lit(" "), col(last))


def upper_code(c: ColumnLike, default: str | None = None) -> Column:
    """Upper-cased code; ``default`` replaces NULL before upper-casing."""
    c = col(c)
    if default is not None:
        c = F.coalesce(c, F.lit(default))
    return F.upper(c)


# --- change detection ----------------------------------------------------------

def attr_hash(*cols: ColumnLike) -> Column:
    """md5 over the '|'-joined text of the columns, NULL read as ''.

    NULL and '' therefore hash alike, and a value containing '|' can collide
    with a neighbour; both are part of the contract and kept as is.
    """
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


# --- kinship codes ---------------------------------------------------------------
# The codes and labels below are part of the data model.

def spouse_role_code(role: ColumnLike) -> Column:
    """HUSBAND -> SPOUSE_HUSBAND, WIFE -> SPOUSE_WIFE, anything else (NONE,
    PARTNER, unknown) -> SPOUSE_PARTNER. Expects an upper-cased role."""
    r = col(role)
    return (F.when(r == "HUSBAND", F.lit("SPOUSE_HUSBAND"))
            .when(r == "WIFE", F.lit("SPOUSE_WIFE"))
            .otherwise(F.lit("SPOUSE_PARTNER")))


def marriage_end_reason(divorce_date: ColumnLike, status: ColumnLike) -> Column:
    """DIVORCE when a divorce date exists; STATUS_ENDED when the status says
    DIVORCED or ENDED (any case); NULL otherwise (WIDOWED included)."""
    st = F.upper(F.coalesce(col(status), F.lit("")))
    return (F.when(col(divorce_date).isNotNull(), F.lit("DIVORCE"))
            .when(st.isin("DIVORCED", "ENDED"), F.lit("STATUS_ENDED"))
            .otherwise(F.lit(None).cast("string")))


def sibling_role_code(shared_parents: ColumnLike) -> Column:
    """Two or more shared parents -> SIBLING, else HALF_SIBLING."""
    return F.when(col(shared_parents) >= 2, F.lit("SIBLING")).otherwise(F.lit("HALF_SIBLING"))


def later_of(a: ColumnLike, b: ColumnLike) -> Column:
    """The later of two dates, or whichever one is not NULL."""
    return F.greatest(col(a), col(b))  # skips NULLs


def marriage_outcome(end_reason: ColumnLike, husband_death: ColumnLike,
                     wife_death: ColumnLike) -> Column:
    """First match wins: Divorced, Both deceased, Husband deceased,
    Wife deceased, Active."""
    h, w = col(husband_death), col(wife_death)
    return (F.when(col(end_reason) == "DIVORCE", F.lit("Divorced"))
            .when(h.isNotNull() & w.isNotNull(), F.lit("Both deceased"))
            .when(h.isNotNull(), F.lit("Husband deceased"))
            .when(w.isNotNull(), F.lit("Wife deceased"))
            .otherwise(F.lit("Active")))


def generation_label(depth: ColumnLike) -> Column:
    """1 Parent, 2 Grandparent, 3 Great-grandparent,
    n >= 4 'Great-' + 'great-' * (n - 3) + 'grandparent'."""
    d = col(depth)
    return (F.when(d == 1, F.lit("Parent"))
            .when(d == 2, F.lit("Grandparent"))
            .when(d == 3, F.lit("Great-grandparent"))
            .otherwise(F.concat(F.lit("Great-"), F.repeat(F.lit("great-"), (d - 3).cast("int")),
                                F.lit("grandparent"))))


# --- dates -----------------------------------------------------------------------

def year_boundaries_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Number of calendar-year boundaries crossed from start to end (BIGINT).

    2019-12-31 -> 2020-01-01 is 1, unlike a count of complete years.
    """
    return (F.year(col(end)) - F.year(col(start))).cast("long")


def date_key(d: ColumnLike) -> Column:
    """yyyyMMdd as INT."""
    return F.date_format(col(d), "yyyyMMdd").cast("int")


def day_of_week_sunday0(d: ColumnLike) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(col(d)) - 1


def lit_date(value: str | dt.date) -> Column:
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value)


# --- ordering ----------------------------------------------------------------------

def asc_last(c: ColumnLike) -> Column:
    return col(c).asc_nulls_last()


def desc_last(c: ColumnLike) -> Column:
    return col(c).desc_nulls_last()
