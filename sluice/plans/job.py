"""Command-line job: ``spark-submit`` entry for a journaled run and the journal state.

    python -m sluice.plans.job run --csv-dir IN --target-root OUT [--journal J]
                                   [--tables a,b] [--parallelism N] [--run-id ID]
    python -m sluice.plans.job state --journal J [--open]

``run`` loads every table's feed from ``IN/<table>.csv`` (a file, or a folder of files
of one drop) into ``OUT/<table>`` and prints the run result as one JSON line; a failed
run is journaled and exits non-zero. The session comes from ``spark-submit`` (or an
existing one); the job sets nothing on it.
"""

from __future__ import annotations

import argparse
import json
import sys
from typing import Optional, Sequence

from pyspark.sql import SparkSession

from sluice.operators import journal
from sluice.operators.load import path_exists
from sluice.plans import run as R
from sluice.plans.tables import RUN_ORDER, SPECS


def feed_path(spark: SparkSession, csv_dir: str, name: str) -> str:
    """``<csv_dir>/<name>.csv`` if present, else the folder ``<csv_dir>/<name>``."""
    single = f"{csv_dir.rstrip('/')}/{name}.csv"
    return single if path_exists(spark, single) else f"{csv_dir.rstrip('/')}/{name}"


def main(argv: Optional[Sequence[str]] = None, spark: Optional[SparkSession] = None) -> int:
    parser = argparse.ArgumentParser(prog="sluice")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="load all (or some) tables, journaled")
    run.add_argument("--csv-dir", required=True)
    run.add_argument("--target-root", required=True)
    run.add_argument("--journal")
    run.add_argument("--tables", help="comma-separated subset, kept in run order")
    run.add_argument("--parallelism", type=int, default=4, help="tables prepared at once (commits stay in order)")
    run.add_argument("--run-id")
    state = sub.add_parser("state", help="print the folded journal")
    state.add_argument("--journal", required=True)
    state.add_argument("--open", action="store_true", help="only runs started and not finished")
    args = parser.parse_args(argv)

    spark = spark or SparkSession.builder.appName("sluice").getOrCreate()
    if args.command == "state":
        folded = journal.fold(journal.read_events(spark, args.journal))
        for row in (journal.open_runs(folded) if args.open else folded).orderBy("started_at").toLocalIterator():
            print(json.dumps(row.asDict(), default=str))
        return 0

    wanted = set(args.tables.split(",")) if args.tables else None
    unknown = (wanted or set()) - set(SPECS)
    if unknown:
        parser.error(f"unknown tables: {sorted(unknown)}")
    specs = [s for s in RUN_ORDER if wanted is None or s.name in wanted]
    root = args.target_root.rstrip("/")
    sources = {s.feed_name: feed_path(spark, args.csv_dir, s.feed_name) for s in specs}
    targets = {s.name: f"{root}/{s.name}" for s in specs}
    journal_path = args.journal or f"{root}/_journal"
    try:
        result = R.run_all(spark, sources, targets, journal_path, specs=specs, run_id=args.run_id,
                           parallelism=args.parallelism)
    except Exception as exc:  # journaled by run_all
        print(json.dumps({"status": "Failed", "error": str(exc)}), file=sys.stderr)
        return 1
    print(json.dumps({"status": "Success", **result}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
