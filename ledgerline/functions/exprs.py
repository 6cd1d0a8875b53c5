"""Column expressions for the projections and predicates of the source jobs.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import fixed

__all__ = [
    "col_of", "live_strict", "live_or_null", "category_group", "payment_group", "unit_qty",
    "blank_to_null", "positive_or", "not_blank", "flag_or_true", "typed_null", "isnull_keep_type",
    "text_plus", "to_dec", "name_key", "as_text_of", "same_text",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- soft delete (P9): two different tests in the source jobs -------------------------------
def live_strict(flag) -> Column:
    """``isDeleted = 0``: a NULL flag is *not* live."""
    return col_of(flag) == F.lit(0)


def live_or_null(flag) -> Column:
    """``ISNULL(isDeleted, 0) = 0``: a NULL flag counts as live."""
    return F.coalesce(col_of(flag), F.lit(0)) == F.lit(0)


# --- mappings (P1, P2) ----------------------------------------------------------------------
def category_group(c, groups: dict | None = None) -> Column:
    """Many-to-one category mapping; names outside every group give NULL (no ELSE)."""
    groups = groups or fixed.CATEGORY_GROUPS_SOURCE
    expr = None
    for label, names in groups.items():
        cond = col_of(c).isin(list(names))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def payment_group(c, keep: list | None = None, otherwise: str | None = None) -> Column:
    """Payment-type mapping with ELSE: kept values map to themselves, the rest (NULL too) to
    ``otherwise``."""
    keep = keep or fixed.PAYMENT_KEEP_SOURCE
    otherwise = otherwise or fixed.PAYMENT_ELSE_SOURCE
    expr = None
    for v in keep:
        cond = col_of(c) == F.lit(v)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr.otherwise(F.lit(otherwise))


def unit_qty(unit, qty_t, qty_m3, tonne: str | None = None) -> Column:
    """The tonnes measure when the unit is tonnes, else the cubic-metre one; NULL -> 0."""
    tonne = tonne or fixed.UNIT_TONNE_SOURCE
    return F.coalesce(
        F.when(col_of(unit) == F.lit(tonne), col_of(qty_t)).otherwise(col_of(qty_m3)),
        F.lit(0).cast(_type_of_decimal()),
    )


def _type_of_decimal() -> str:
    return "decimal(18,2)"


# --- defaults (P6-P8, P19, P20) ---------------------------------------------------------------
def blank_to_null(c) -> Column:
    """``CASE WHEN ISNULL(x,'') = '' THEN NULL ELSE x END``."""
    return F.when(F.coalesce(col_of(c), F.lit("")) == F.lit(""), F.lit(None)).otherwise(col_of(c))


def positive_or(a, b) -> Column:
    """``CASE WHEN a > 0 THEN a ELSE b END`` (NULL a falls to b)."""
    return F.when(col_of(a) > 0, col_of(a)).otherwise(col_of(b))


def not_blank(c) -> Column:
    """``ISNULL(x,'') != ''``."""
    return F.coalesce(col_of(c), F.lit("")) != F.lit("")


def flag_or_true(c) -> Column:
    """``ISNULL(flag, 1) = 1``."""
    return F.coalesce(col_of(c), F.lit(1)) == F.lit(1)


def typed_null(dtype: str) -> Column:
    """Typed NULL padding of a union branch."""
    return F.lit(None).cast(dtype)


def isnull_keep_type(c, default, dtype: str) -> Column:
    """``ISNULL`` keeps the first argument's type, ``coalesce`` widens: cast explicitly."""
    return F.coalesce(col_of(c), F.lit(default)).cast(dtype)


def text_plus(*parts) -> Column:
    """T-SQL text ``+``: NULL in any part gives NULL (``concat``, not ``concat_ws``).

    Plain ``str`` parts are literals; pass columns as ``Column``."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def to_dec(c, precision: int = 18, scale: int = 2) -> Column:
    return col_of(c).cast(f"decimal({precision},{scale})")


def name_key(c, ci: bool = True) -> Column:
    """Join key for names under the source databases' collation (case-insensitive, trailing
    blanks ignored by ``=``): ``lower(rtrim(x))``. The equality stays an equi join."""
    return F.lower(F.rtrim(col_of(c))) if ci else col_of(c)


def as_text_of(df: DataFrame, name: str, c: Column) -> Column:
    """A text column ``c`` with the collation of ``df``'s text column ``name``, so that the two compare by that one."""
    kind = df.schema[name].dataType
    return c.cast(kind).alias("col") if isinstance(kind, T.StringType) and kind != T.StringType() else c.alias("col")


def same_text(left: DataFrame, lcol: str, right: DataFrame, rcol: str) -> Column:
    """``lcol = rcol`` of two frames; where only one of them has a collation (the other comes of literals), by that one."""
    a, b = left.schema[lcol].dataType, right.schema[rcol].dataType
    x, y = F.col(lcol), F.col(rcol)
    if isinstance(a, T.StringType) and isinstance(b, T.StringType) and a != b:
        x, y = (x.cast(b), y) if a == T.StringType() else (x, y.cast(a))
    return x == y
