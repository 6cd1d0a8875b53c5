"""Sources whose columns are worked out late.

A source that is a projection of fewer columns can be carried through joins as those, and its own columns worked out behind them:
the rows are the same, but what is shuffled, sorted and spilled is narrower. A source that is a plain table is carried as it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Late:
    """``columns`` are the source's, each an expression over ``rows``' columns by name."""

    rows: DataFrame
    columns: dict[str, Column]

    def frame(self) -> DataFrame:
        return self.rows.select(*[c.alias(n) for n, c in self.columns.items()])

    def filter(self, condition: Column) -> Late:
        """``condition``: over ``rows``, as the values of ``columns`` are."""
        return Late(self.rows.filter(condition), self.columns)

    def carried(self, mark: str, **keys: Column) -> DataFrame:
        """``rows`` with ``mark`` before their names, and ``keys`` over them. No other name may begin with ``mark``."""
        return self.rows.select(*[F.col(c).alias(f"{mark}{c}") for c in self.rows.columns], *[c.alias(n) for n, c in keys.items()])

    def worked_out(self, df: DataFrame, mark: str, prefix: str = "", found: str | None = None) -> DataFrame:
        """``df`` with the source's columns as ``prefix`` and name in place of the rows it carries as ``mark``. Behind an outer join,
        ``found`` is the column that is NULL where there is no row: all columns are NULL there."""
        new = {f"{prefix}{n}": F.when(F.col(found).isNotNull(), c) if found else c for n, c in self.columns.items()}
        return self._select(df, mark, [F.col(c) for c in df.columns if not c.startswith(mark)], new)

    def with_columns(self, df: DataFrame, mark: str, names: dict[str, str]) -> DataFrame:
        """``df``, which carries rows as ``mark``, with the source's columns ``names`` (new name: column) besides."""
        return self._select(df, mark, [F.col(c) for c in df.columns], {new: self.columns[n] for new, n in names.items()})

    def _select(self, df: DataFrame, mark: str, others: list[Column], new: dict[str, Column]) -> DataFrame:
        plain = df.select(*others, *[F.col(f"{mark}{c}").alias(c) for c in self.rows.columns])
        return plain.select(*others, *[c.alias(n) for n, c in new.items()])


def late(src, name: str) -> Late:
    """``src(name)`` before its columns are worked out, if ``src`` can give that; else its columns as they are."""
    if hasattr(src, "late"):
        return src.late(name)
    df = src(name)
    return Late(df, {c: F.col(c) for c in df.columns})
