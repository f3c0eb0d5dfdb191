"""One step of a day's run from the command line.

    spark-submit ... dayledger/__main__.py STEP --data-dir DIR --load-date YYYY-MM-DD

Steps: ingest (CSV to raw), gate (raw to clean and quarantine), load (to the warehouse,
once unless --force-reload), verify (the invariants over the warehouse), run (all four).
"""

from __future__ import annotations

import argparse
import sys
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from dayledger.plans import invariants  # noqa: E402
from dayledger.plans.day_gate import gate_day  # noqa: E402
from dayledger.session import tune  # noqa: E402
from dayledger.sources.layers import ingest_day  # noqa: E402
from dayledger.sources.ledger import load_day  # noqa: E402
from dayledger.sources.warehouse import warehouse_marts  # noqa: E402

STEPS = ("ingest", "gate", "load", "verify", "run")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="dayledger")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--data-dir", required=True)
    parser.add_argument("--warehouse", help="default: DATA_DIR/warehouse")
    parser.add_argument("--load-date", required=True, type=lambda d: date.fromisoformat(d).isoformat())
    parser.add_argument("--force-reload", action="store_true")
    args = parser.parse_args(argv)
    args.warehouse = args.warehouse or f"{args.data_dir}/warehouse"
    return args


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    tune(spark)
    wanted = set(STEPS[:-1]) if args.step == "run" else {args.step}
    if "ingest" in wanted:
        ingest_day(spark, args.data_dir, args.load_date)
    if "gate" in wanted:
        for entity, (valid, invalid) in gate_day(spark, args.data_dir, args.load_date).items():
            print(f"{entity}: {valid} valid, {invalid} invalid")
    if "load" in wanted:
        loaded = load_day(spark, args.data_dir, args.warehouse, args.load_date, args.force_reload)
        print("loaded" if loaded else "already loaded")
    if "verify" in wanted:
        invariants.enforce(warehouse_marts(spark, args.warehouse))
        print("all invariants hold")


if __name__ == "__main__":
    run(SparkSession.builder.appName("dayledger").getOrCreate(), arguments())
