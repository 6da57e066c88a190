"""Jobs for spark-submit: the whole run, or one stage or component of it.

    python -m loanmill run --raw raw.csv --folder shared/folder --day 2020-01-31
    python -m loanmill component payment_history --folder shared/folder --out path
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from loanmill.operators import ingest
from loanmill.plans import pipeline
from loanmill.sources import readers, writers


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="loanmill")
    jobs = parser.add_subparsers(dest="job", required=True)
    run = jobs.add_parser("run", help="raw CSV to one day's scores")
    run.add_argument("--raw", required=True)
    run.add_argument("--folder", required=True)
    run.add_argument("--day", type=date.fromisoformat, default=date.today())
    run.add_argument("--run-id", default="manual")
    run.add_argument(
        "--fail-on",
        nargs=2,
        action="append",
        metavar=("CHECKS", "PERCENT"),
        help="stop if a check of this kind is over the limit: null_checks 0.5",
    )
    split = jobs.add_parser("split", help="raw CSV to four CSV tables")
    split.add_argument("--raw", required=True)
    split.add_argument("--folder", required=True)
    split.add_argument("--single-file", action="store_true")
    component = jobs.add_parser("component", help="one score component")
    component.add_argument("name", choices=pipeline.COMPONENTS)
    component.add_argument("--folder", required=True, help="the folder of a run")
    component.add_argument("--out", required=True)
    return parser


def main(argv: list[str] | None = None) -> None:
    chosen = arguments().parse_args(argv)
    spark = SparkSession.builder.appName("loanmill").getOrCreate()
    if chosen.job == "component":
        kept = pipeline.without_quarantined(pipeline.load_clean(spark, chosen.folder))
        writers.write_parquet(pipeline.component(kept, chosen.name), chosen.out)
        return
    keyed = ingest.with_member_id(readers.read_raw(spark, chosen.raw))
    if chosen.job == "split":
        pipeline.split_to_csv(keyed, chosen.folder, chosen.single_file)
    else:
        limits = chosen.fail_on and {kind: float(limit) for kind, limit in chosen.fail_on}
        pipeline.run(keyed, chosen.folder, chosen.day, chosen.run_id, fail_on=limits)
        pipeline.add_monthly(spark, chosen.folder, chosen.day)


if __name__ == "__main__":
    main()
