"""Sources whose name columns compare by the source databases' collation.

The source's databases compare text without regard to case and to trailing blanks, in joins, groups, DISTINCT, IN and
WHERE alike. Here the name columns get a collation of that kind when they are read, so every plan over them follows
it without a word of its own; outputs get plain text again. Of the spellings of one name that a group holds, any may
stand in the output, as in the source.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.fixed import COLLATION
from ledgerline.sources.late import Late, late

#: Columns that hold names of organisations, people, categories, kinds and units; ids and free text don't.
NAME_COLUMNS = frozenset("""
AccountingPaymentType CategoryName CompanyName ConcreteCategory DataTableName Department DepartmentName DeptName
ManageSetName PaymentType ProdCateName ProductCategoryType
ProductCategory SalesDepartment SalesPaymentType Salesman ServiceType Source Type TypeName Unit UserName Username Value
""".split())


class CollatedSources:
    """``src`` with a collation on its name columns (``names``, those of them that a source has as text)."""

    def __init__(self, src, collation: str = COLLATION, names: Iterable[str] = NAME_COLUMNS) -> None:
        self.src, self.collation, self.names = src, collation, frozenset(names)

    def __call__(self, name: str) -> DataFrame:
        df = self.src(name)
        due = [f.name for f in df.schema if f.name in self.names and isinstance(f.dataType, T.StringType)]
        return df.withColumns({c: F.col(c).cast(f"string collate {self.collation}") for c in due}) if due else df

    def late(self, name: str) -> Late:
        of = late(self.src, name)
        due = {f.name for f in of.frame().schema if f.name in self.names and isinstance(f.dataType, T.StringType)}
        kind = f"string collate {self.collation}"
        return Late(of.rows, {n: c.cast(kind) if n in due else c for n, c in of.columns.items()})

    def __contains__(self, name: str) -> bool:
        return name in self.src


def plain(df: DataFrame) -> DataFrame:
    """``df`` with plain text columns."""
    due = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.dataType != T.StringType()]
    return df.withColumns({c: F.col(c).cast("string collate UTF8_BINARY") for c in due}) if due else df
