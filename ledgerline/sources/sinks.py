"""Sinks: versioned full refresh, partition load, CSV export.

Parquet tables take no DELETE/UPDATE/MERGE and a table cannot be overwritten while it is read, so every refresh writes
new version folders and then publishes one commit that names the current version of every table (``commits``).
Readers resolve a commit once, so tables of one run are seen together. A failed or retried job leaves earlier
versions untouched.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import runtime_filters
from ledgerline.sources import files
from ledgerline.sources.commits import GRACE, POINTER, CommitLog


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of a version that no reader resolves any more."""
    files.delete(spark, path)


def versions(spark: SparkSession, target: str) -> list[str]:
    """Version folders of a table by name; also those of failed runs."""
    return sorted(n for n in files.names(spark, target, folders=True) if n.startswith("v"))


def version_tag(run_ts: dt.datetime) -> str:
    """A version name of this attempt alone: a run that is repeated never writes into an earlier one's folder."""
    return f"{run_ts:v%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"


def refresh_all(spark: SparkSession, outputs: dict[str, DataFrame], root: str, run_ts: dt.datetime,
                keep: int | None = None, grace: dt.timedelta = GRACE) -> dict:
    """Full refresh of the tables of one run (the source's DELETE + INSERT): all outputs are written as new
    versions, then one commit makes all of them current. No reader sees a mix of two runs, of one table or of several, and
    a failure before the commit, also of a repeated run, leaves the previous versions current and whole.

    A commit also names the versions before; tables of other runs under ``root`` stay as they are in it. ``keep``: of
    this run's tables only the last so many versions, by the commits that made them, stay; folders of earlier
    ones and of failed runs go once the commit is there, folders of runs in progress don't. A run that died without an
    end counts as in progress for ``grace``."""
    log, version = CommitLog(spark, root), version_tag(run_ts)
    paths = {name: os.path.join(root, name, version) for name in outputs}
    with log.run(version):
        try:
            with runtime_filters(spark):
                for name, df in outputs.items():
                    df.write.mode("errorifexists").parquet(paths[name])
            for name in outputs:
                link = os.path.join(root, name, POINTER)
                if not files.exists(spark, link):
                    files.write_text(spark, link, json.dumps({"commits": ".."}))
        except BaseException:
            for path in paths.values():
                files.delete(spark, path)
            raise

        def change(state: dict, number: int) -> dict:
            tables = state.setdefault("tables", {})
            for name in outputs:
                made = [*tables.get(name, []), {"commit": number, "version": version, "run_ts": run_ts.isoformat()}]
                tables[name] = made[-keep:] if keep else made
            return state

        log.commit(change)
    if keep:
        # in this order: a folder seen here belongs to a run that is still marked, to one that has committed, or to none
        folders = {name: versions(spark, os.path.join(root, name)) for name in outputs}
        running = log.running(grace)
        tables = log.latest()[1]["tables"]
        for name, found in folders.items():
            for folder in set(found) - running - {v["version"] for v in tables[name]}:
                files.delete(spark, os.path.join(root, name, folder))
    return paths


def refresh(spark: SparkSession, df: DataFrame, target: str, run_ts: dt.datetime, keep: int | None = None) -> str:
    """``refresh_all`` for one table."""
    root, name = os.path.split(target.rstrip("/"))
    return refresh_all(spark, {name: df}, root, run_ts, keep)[name]


def read_commit(spark: SparkSession, root: str, names: list[str] | None = None, commit: int | None = None) -> dict[str, DataFrame]:
    """Tables as one commit names them (the newest, or an earlier one as far as its versions are kept): all tables of
    ``root``, or ``names``. They are resolved together, so they show the same runs whatever is written meanwhile."""
    latest, state = CommitLog(spark, root).latest()
    at, out = latest if commit is None else commit, {}
    if not 0 < at <= latest:
        raise FileNotFoundError(f"no commit {at} under {root}")
    for name, made in state["tables"].items():
        if names is None or name in names:
            then = [v["version"] for v in made if v["commit"] <= at]
            if then:
                out[name] = spark.read.parquet(os.path.join(root, name, then[-1]))
    missing = [n for n in names or () if n not in out]
    if missing:
        raise FileNotFoundError(f"no version of {missing[0]} at commit {at}")
    return out


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table's current version, or a keyed table's rows as of its newest commit."""
    from ledgerline.sources.keyed_table import KeyedTable
    link = files.read_text(spark, os.path.join(root, name, POINTER))
    if link is None:
        raise FileNotFoundError(f"no current version of {name}")
    if "keyed" in json.loads(link):
        return KeyedTable.open(spark, os.path.join(root, name)).read()
    return read_commit(spark, root, [name])[name]


def load_partition(df: DataFrame, target: str, date_col: str = "ReportDate", part_col: str = "report_date",
                   sort_by: tuple = ("ProjectID",)) -> None:
    """Append the load's rows partitioned by report date. Dynamic partition overwrite makes a
    re-run of the same day replace that day only, instead of adding its rows twice.

    Inside each task the rows are sorted by date, then by ``sort_by`` (the source's lookup index on
    the project), so parquet row-group statistics prune project lookups. There is no repartition
    by date: a day holding a third of the rows is still written by many tasks."""
    out = df.withColumn(part_col, F.col(date_col).cast("date"))
    keys = [part_col] + [c for c in sort_by if c in out.columns]
    out = out.sortWithinPartitions(*keys)
    with runtime_filters(df.sparkSession):
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(target)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header (one folder of part files; the source's BOM is not written)."""
    df.write.mode("overwrite").option("header", True).csv(path)
