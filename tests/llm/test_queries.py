import pytest

import __spark_entry__ as E
from harness import compare, duck
from ledgerline.llm import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_its_sql(spark, name):
    out = compare(Q.QUERIES[name](spark, SF), Q.ORACLE[name], duck(SF))
    assert out["ok"], out


def test_all_operators_and_the_pipeline_are_registered(spark):
    names = E.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)
