"""Names in other cases and with trailing blanks are the same names: joins, groups, DISTINCT and lists (the source's collation)."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.fixed import COLLATION
from ledgerline.operators.joins import not_in_list, not_in_rows
from ledgerline.operators.params import in_param_list
from ledgerline.plans import driver_queries as dq
from ledgerline.plans import kanban
from ledgerline.plans.daily_load import daily_load
from ledgerline.sources.collated import NAME_COLUMNS, CollatedSources, plain
from ledgerline.sources.standins import StandIns

SF = "/root/testdata/sf0.001"


class Mixed:
    """A source whose names are spelled anew row by row: as they are, in capitals, in small letters, with blanks behind."""

    def __init__(self, src):
        self.src, self.made = src, {}

    def __call__(self, name):
        if name not in self.made:
            df = self.src(name)
            due = [f.name for f in df.schema if f.name in NAME_COLUMNS and isinstance(f.dataType, T.StringType)]
            way = F.pmod(F.xxhash64(*[c for c in df.columns], F.lit(name)), F.lit(4))

            def spelled(c):
                return F.when(way == 0, F.upper(c)).when(way == 1, F.lower(c)).when(way == 2, F.concat(F.col(c), F.lit("  "))).otherwise(F.col(c))
            self.made[name] = df.withColumns({c: spelled(c) for c in due}) if due else df
        return self.made[name]

    def __contains__(self, name):
        return name in self.src


def norm(df):
    def one(v):
        return v.rstrip(" ").lower() if isinstance(v, str) else v
    return sorted(str(tuple(one(v) for v in r)) for r in df.collect())


@pytest.mark.parametrize("board", ["board_leads", "board_oppo", "board_sales", "board_returns"])
def test_boards_of_mixed_spellings(spark, board):
    src, cfg = StandIns.of(spark, SF), dq.kanban_config()
    run = getattr(kanban, board)
    want = norm(run(src, cfg))
    got = plain(run(CollatedSources(Mixed(src)), replace(cfg, name_collation=COLLATION)))
    assert want and norm(got) == want
    assert all(f.dataType == T.StringType() for f in got.schema if isinstance(f.dataType, T.StringType))


def test_jobs_take_the_collation_from_their_settings(spark):
    src, cfg = StandIns.of(spark, SF), replace(dq.kanban_config(), name_collation=COLLATION)
    outs = kanban.run_kanban(Mixed(src), cfg, persist=False)
    want = kanban.board_returns(src, cfg)
    assert norm(outs["WorkbenchKanbanReturn"].drop("FGC_CreateDate", "FGC_LastModifyDate")) == norm(want)
    assert outs["WorkbenchKanbanReturn"].schema["UserName"].dataType == T.StringType()


def test_the_daily_load_keeps_one_row_of_equal_ones(spark):
    src, cfg = StandIns.of(spark, SF), dq.load_config()
    day = dt.date(1995, 6, 17)
    want = daily_load(src, cfg, day, dq.LOAD_RUN)
    got = daily_load(src, replace(cfg, name_collation=COLLATION), day, dq.LOAD_RUN)
    assert norm(got) == norm(want) and got.schema == want.schema


def test_lists_follow_the_collation(spark):
    kind = f"string collate {COLLATION}"
    left = spark.createDataFrame([("A ",), ("a",), ("B",), (None,), (" a",)], "v string").select(F.col("v").cast(kind).alias("v"))
    values = spark.createDataFrame([("a",), ("c",)], "col string")
    params = spark.createDataFrame([("P", "a,c")], "ParaName string, ParaValue string")
    assert sorted(r.v for r in not_in_list(left, F.col("v"), values).collect()) == [" a", "B"]
    assert sorted(r.v for r in not_in_rows(left, F.col("v"), values).collect()) == [" a", "B"]
    assert sorted(r.v for r in in_param_list(left, "v", params, "P").collect()) == ["A ", "a"]
    assert [f.dataType for f in plain(left).schema] == [T.StringType()]
