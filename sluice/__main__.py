"""Command line: run the table registry on a cluster.

    spark-submit --py-files sluice.zip run_sluice.py config.yml s3a://landing s3a://warehouse

(or ``python -m sluice ...`` with pyspark installed). The Spark session comes
from the environment (spark-submit / spark-defaults), so cluster settings such
as ``spark.checkpoint.dir`` apply.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession

from .plans.run import run_landing
from .rules import RunConfig


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sluice", description="check landing files, report, load")
    p.add_argument("config", help="YAML table registry")
    p.add_argument("landing_root", help="root of the landing files")
    p.add_argument("output_root", nargs="?", default=None,
                   help="root for report / raw tables (default: catalog tables dataset.table)")
    p.add_argument("--export-root", default=None, help="also write ';' CSV reports here")
    p.add_argument("--line-mode", action="store_true", help="read all CSV by lines (quoted newlines refused)")
    p.add_argument("--parallel-tables", type=int, default=1)
    p.add_argument("--materialize", default="stage", choices=["stage", "persist", "none"])
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("sluice").getOrCreate()
    runs = run_landing(
        spark, RunConfig.load(args.config), args.landing_root, args.output_root,
        export_root=args.export_root, multi_line=False if args.line_mode else None,
        materialize_as=args.materialize, parallel_tables=args.parallel_tables,
    )
    for r in runs:
        print(json.dumps(asdict(r)))
    return 1 if any(r.error for r in runs) else 0


if __name__ == "__main__":
    sys.exit(main())
