"""Command line: the whole run (extract, transform, load, test) as one Spark application.

    python -m runway --config config.yaml --out /shared/runs/2024-01-15
    python -m runway --tables /root/testdata/sf0.01 --out /shared/runs/demo

Exit status 1 when a data-quality check fails (the reference's test gate).
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="runway")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--config", help="YAML/JSON source configuration (the reference's layout is accepted)")
    src.add_argument("--tables", help="folder of the driver's TPC-H-style parquet tables (derived sources)")
    ap.add_argument("--out", required=True, help="shared folder for the raw, cleaned, report and warehouse zones")
    ap.add_argument("--approx", action="store_true", help="approximate quantiles (bounded memory)")
    ap.add_argument("--partition-facts", action="store_true",
                    help="store facts in date-key folders (pruning, dynamic partition pruning); for clusters")
    args = ap.parse_args(argv)

    from runway import config
    from runway.plans import job, tpch
    from runway.session import build_session

    from pyspark.sql import SparkSession
    owned = SparkSession.getActiveSession() is None
    spark = build_session(app="runway-job")
    if args.config:
        result = job.run_from_config(spark, config.load(args.config), args.out, exact=not args.approx,
                                     partition_facts=args.partition_facts)
    else:
        result = job.run(spark, tpch.sources(spark, args.tables), args.out, exact=not args.approx,
                         partition_facts=args.partition_facts)
    result.report.show(truncate=False)
    checks = result.checks.collect()
    for r in checks:
        print(f"{'PASS' if r.passed else 'FAIL'}  {r.check}: {r.violations}")
    if owned:
        spark.stop()
    return 0 if all(r.passed for r in checks) else 1


if __name__ == "__main__":
    sys.exit(main())
