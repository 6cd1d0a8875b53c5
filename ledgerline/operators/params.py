"""Parameter-table operators: scalar lookup and list split (A12, X13, F1, J-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.exprs import as_text_of

__all__ = ["param_value", "split_param", "in_param_list"]


def param_value(params: DataFrame, name: str, name_col: str = "ParaName", value_col: str = "ParaValue") -> DataFrame:
    """``(SELECT ParaValue FROM Parameters WHERE ParaName = name)`` as a one-column frame."""
    return params.filter(F.col(name_col) == F.lit(name)).select(F.col(value_col).alias("value"))


def split_param(params: DataFrame, name: str, sep: str = ",", name_col: str = "ParaName",
                value_col: str = "ParaValue") -> DataFrame:
    """``f_split((SELECT ParaValue FROM Parameters WHERE ParaName = name), sep)`` as rows of ``col``.

    The value is a scalar subquery, as in the source: more than one matching parameter row fails the
    job (SCALAR_SUBQUERY_TOO_MANY_ROWS); a missing parameter or a NULL value gives no rows. No
    trimming; empty parts are kept."""
    v = params.filter(F.col(name_col) == F.lit(name)).select(value_col).scalar()
    one = params.sparkSession.range(1)
    return one.select(F.explode(F.split(v, _regex_literal(sep), -1)).alias("col"))


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in sep)


def in_param_list(df: DataFrame, value_col: str, params: DataFrame, name: str, sep: str = ",") -> DataFrame:
    """``value IN (SELECT col FROM f_split(...))`` as a left-semi join on the split list. The list is
    the parts of one parameter value (bounded by one text field), so it is broadcast."""
    lst = F.broadcast(split_param(params, name, sep).select(as_text_of(df, value_col, F.col("col"))).distinct())
    return df.join(lst, F.col(value_col) == F.col("col"), "left_semi")
