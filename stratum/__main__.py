"""Command line: ``spark-submit`` / ``python -m stratum <command>``.

    ingest        typed CSV -> parquet for both raw catalogs
    build         all models (facts incremental), failed checks gate what reads their models
    full-refresh  rebuild the incremental models from scratch
    freshness     source freshness report (never fails the command)

All locations are flags (use shared storage on a cluster); scratch space
is the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F

from stratum.plans import runner
from stratum.session import build_session
from stratum.sources.config import PipelineConfig


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="stratum")
    p.add_argument("command", choices=["ingest", "build", "full-refresh", "freshness"])
    p.add_argument("--source-base", required=True)
    p.add_argument("--target-base", required=True)
    p.add_argument("--seeds-dir")
    p.add_argument("--marketplace-dir", help="raw marketplace CSV folder (ingest)")
    p.add_argument("--state-stats-dir", help="raw state statistics CSV folder (ingest)")
    p.add_argument("--select", nargs="*", help="model names, layers, tags or 'incremental'")
    p.add_argument("--no-gate", action="store_true", help="report failed checks without stopping")
    p.add_argument("--as-of", help="freshness reference time, ISO format (default: now, UTC)")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    a = _parser().parse_args(argv)
    spark = spark or build_session(app=f"stratum-{a.command}")
    cfg = PipelineConfig(source_base=a.source_base, target_base=a.target_base, seeds_dir=a.seeds_dir)
    if a.command == "ingest":
        if not (a.marketplace_dir and a.state_stats_dir):
            print("ingest needs --marketplace-dir and --state-stats-dir", file=sys.stderr)
            return 2
        for path in runner.ingest(spark, cfg, a.marketplace_dir, a.state_stats_dir):
            print(f"loaded {path}")
        return 0
    if a.command == "freshness":
        as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else None
        rep = runner.freshness_job(spark, cfg, as_of)
        for r in (rep.collect() if rep is not None else []):
            print(f"{r.source_name}: {r.status} (newest {r.max_loaded_at})")
        return 0
    if a.command == "build":
        res = runner.run(spark, cfg, select=a.select, gate=not a.no_gate)
    else:
        res = runner.run(spark, cfg, select=a.select or ["incremental"], full_refresh=True,
                         gate=not a.no_gate, source_checks=False)
    rep = res.report()
    summary = rep.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect() if rep is not None else []
    print(f"run {res.run_id}: built {len(res.built)} models; checks " +
          ", ".join(f"{r.status}={r.n}" for r in sorted(summary, key=lambda r: r.status)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
