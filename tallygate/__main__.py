"""Jobs for ``spark-submit``: publish a snapshot, or check and promote a published run."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tallygate.plans.promote import resume_run
from tallygate.plans.publish import publish_snapshot


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallygate", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    publish = jobs.add_parser("publish", help="build a run from CSV files and publish it")
    publish.add_argument("--input", required=True, nargs="+")
    publish.add_argument("--max-reject-ratio", type=float, default=0.25)
    resume = jobs.add_parser("resume", help="reconcile a published run, and load it if asked")
    for job in (publish, resume):
        job.add_argument("--root", required=True)
        job.add_argument("--run-id", required=True)
        job.add_argument("--batch-date")
        job.add_argument("--mart", help="root of the mart to load the run into")
    return parser


def main() -> None:
    given = arguments().parse_args()
    spark = SparkSession.builder.appName(f"tallygate-{given.job}").getOrCreate()
    try:
        if given.job == "publish":
            publish_snapshot(
                spark,
                given.input,
                given.root,
                given.run_id,
                given.batch_date,
                given.max_reject_ratio,
            )
        outcome = resume_run(spark, given.root, given.run_id, given.batch_date, given.mart)
        print(json.dumps(outcome, indent=2, default=str))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
