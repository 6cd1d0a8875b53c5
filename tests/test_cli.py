"""The command line runs each job end to end on the smallest driver tables (stand-in sources)."""

import os
import tempfile

from ledgerline.cli import main
from ledgerline.sources import sinks

SF = "/root/testdata/sf0.001"


def test_cli_jobs(spark):
    out = tempfile.mkdtemp(prefix="ledgerline-cli-", dir="/tmp")
    assert main(["kanban", "--standins", SF, "--as-of", "2000-06-15T09:30", "--out", os.path.join(out, "kanban")]) == 0
    assert sinks.read_current(spark, os.path.join(out, "kanban"), "WorkbenchKanbanSales").count() > 0
    assert main(["daily-load", "--standins", SF, "--report-date", "2000-06-14", "--tenant", "1",
                 "--out", os.path.join(out, "details")]) == 0
    one_day = spark.read.parquet(os.path.join(out, "details"))
    assert one_day.select("report_date").distinct().count() <= 1
    assert main(["reset-links", "--standins", SF, "--report-date", "2000-06-15", "--tenant", "1",
                 "--out", os.path.join(out, "wb_ins")]) == 0
    assert main(["enrich", "--standins", SF, "--start", "2000-06-01", "--end", "2000-06-30", "--limit", "5",
                 "--out", os.path.join(out, "extract")]) == 0
    for run_at in ("2024-01-20T00:00", "2024-01-20T00:15"):
        assert main(["sync-copy", "--standins", SF, "--run-at", run_at, "--overlap-minutes", "20000",
                     "--out", os.path.join(out, "copy", "fact_copy")]) == 0
    assert sinks.read_current(spark, os.path.join(out, "copy"), "fact_copy").count() > 0
