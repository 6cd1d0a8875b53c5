"""Command line: run the jobs the source system runs (procedure, load, reset, extract, copy).

    python -m ledgerline kanban      --sources sources.json --as-of 2025-11-16T08:00 --out /shared/kanban
    python -m ledgerline daily-load  --sources sources.json --report-date 2025-11-15 --tenant 1 --out /shared/details
    python -m ledgerline reset-links --sources sources.json --report-date 2025-11-15 --tenant 1 --out /shared/wb_ins
    python -m ledgerline enrich      --sources sources.json --start 2025-11-01 --end 2025-11-30 --out /shared/extract
    python -m ledgerline sync-copy   --sources sources.json --run-at 2025-11-16T08:15 --out /shared/fact_copy

``sources.json`` maps each logical source name to ``{"kind": "parquet" | "table" | "jdbc",
...}`` (see ``SourceRegistry``; CSV exports need a schema and are registered in code). ``--standins SF_DIR`` reads the driver tables through the stand-in
views instead, with the stand-in vocabulary. Outputs are written as new versions (``sinks``); the
session's own settings (shuffle partitions, ``spark.checkpoint.dir``) are used as they are.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from ledgerline.config import KanbanConfig, LoadConfig


def _registry(spark, args):
    if args.standins:
        from ledgerline.sources.standins import StandIns
        return StandIns.of(spark, args.standins)
    from ledgerline.sources.registry import SourceRegistry
    reg = SourceRegistry(spark)
    with open(args.sources, encoding="utf-8") as f:
        spec = json.load(f)
    for name, e in spec.items():
        kind = e.get("kind", "parquet")
        if kind == "parquet":
            reg.parquet(name, e["path"])
        elif kind == "table":
            reg.table(name, e["table"])
        elif kind == "jdbc":
            opts = {k: v for k, v in e.items() if k not in ("kind", "dbtable", "url", "partition_column", "lower",
                                                            "upper", "num_partitions")}
            reg.jdbc(name, e["dbtable"], e["url"], e.get("partition_column"), e.get("lower"), e.get("upper"),
                     e.get("num_partitions", 64), **opts)
        else:
            raise ValueError(f"source {name}: kind {kind} needs an explicit schema; register it in code")
    return reg


def _kanban_cfg(args) -> KanbanConfig:
    as_of = dt.datetime.fromisoformat(args.as_of)
    if args.standins:
        from ledgerline.plans.driver_queries import kanban_config
        return kanban_config(as_of)
    return KanbanConfig(as_of=as_of)


def _load_cfg(args) -> LoadConfig:
    if args.standins:
        from dataclasses import replace

        from ledgerline.plans.driver_queries import load_config
        return replace(load_config(), tenant_id=args.tenant)
    return LoadConfig(tenant_id=args.tenant)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerline")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("kanban", "daily-load", "reset-links", "enrich", "sync-copy"):
        s = sub.add_parser(name)
        g = s.add_mutually_exclusive_group(required=True)
        g.add_argument("--sources")
        g.add_argument("--standins")
        s.add_argument("--out", required=True)
        s.add_argument("--master", default=None, help="only for local runs; clusters pass it to spark-submit")
        if name == "kanban":
            s.add_argument("--as-of", required=True)
        if name in ("daily-load", "reset-links"):
            s.add_argument("--report-date", default=None, help="omit for a backfill of every day (daily-load)")
            s.add_argument("--tenant", type=int, default=None)
        if name == "reset-links":
            s.add_argument("--months", type=int, default=2)
        if name == "enrich":
            s.add_argument("--start", required=True)
            s.add_argument("--end", required=True)
            s.add_argument("--limit", type=int, default=None)
        if name == "sync-copy":
            s.add_argument("--run-at", required=True)
            s.add_argument("--overlap-minutes", type=int, default=5)
    args = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from ledgerline.session import build_session
    from ledgerline.sources import sinks
    spark = build_session(args.master) if args.master else SparkSession.builder.getOrCreate()
    src = _registry(spark, args)
    run_ts = dt.datetime.now().replace(microsecond=0)

    if args.job == "kanban":
        from ledgerline.plans.kanban import run_kanban
        cfg = _kanban_cfg(args)
        sinks.refresh_all(spark, run_kanban(src, cfg), args.out, cfg.as_of)
    elif args.job == "daily-load":
        from ledgerline.plans.daily_load import daily_load
        day = dt.date.fromisoformat(args.report_date) if args.report_date else None
        out = daily_load(src, _load_cfg(args), day, run_ts, date_col="ReportDate")
        sinks.load_partition(out, args.out, date_col="ReportDate")
    elif args.job == "reset-links":
        from ledgerline.plans.reset import stale_reset
        names = ("wb_ins", "receiving_reports", "receiving_details")
        out = stale_reset(*[src(n) for n in names], args.tenant, dt.date.fromisoformat(args.report_date), args.months)
        sinks.refresh(spark, out, args.out, run_ts)
    elif args.job == "enrich":
        from ledgerline.plans.enrich import enrich_extract
        names = ("details", "reports", "projects", "foreign_view", "periods", "pricing_sets", "payment_types")
        out = enrich_extract(*[src(n) for n in names], dt.date.fromisoformat(args.start),
                             dt.date.fromisoformat(args.end), limit=args.limit)
        sinks.refresh(spark, out, args.out, run_ts)
    elif args.job == "sync-copy":
        from ledgerline.sources.keyed_table import KeyedTable, sync
        source = src("fact_source")
        table = KeyedTable(spark, args.out, source.schema, ["ProductionDetailId", "Material"], ["ModifyTime"])
        sync(table, source, "ModifyTime", dt.datetime.fromisoformat(args.run_at), dt.timedelta(minutes=args.overlap_minutes))
        table.compact()
        table.vacuum()
    return 0


if __name__ == "__main__":
    sys.exit(main())
