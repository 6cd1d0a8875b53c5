"""Explicit schemas: jobs never infer a schema at read time (no footer scan, no drift)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, I, D, TS = StringType(), LongType(), IntegerType(), DoubleType(), TimestampNTZType()

DRIVER = {
    "region": _s(("r_regionkey", I), ("r_name", S)),
    "nation": _s(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _s(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D), ("c_mktsegment", S)),
    "supplier": _s(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _s(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I), ("p_retailprice", D)),
    "orders": _s(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D), ("o_orderdate", TS),
                 ("o_orderpriority", S)),
    "lineitem": _s(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I), ("l_quantity", D),
                   ("l_extendedprice", D), ("l_discount", D), ("l_tax", D), ("l_returnflag", S), ("l_linestatus", S),
                   ("l_shipdate", TS)),
    "events": _s(("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D), ("props", S)),
    "documents": _s(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "labels": _s(("doc_id", L), ("quality", I), ("toxic", I)),
    "embeddings": _s(("vec_id", L), ("embedding", ArrayType(FloatType())), ("label", I)),
    "pages": _s(("page_id", L), ("url", S), ("html", S)),
    "benchmark": _s(("item_id", L), ("text", S)),
    "conversations": _s(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}
