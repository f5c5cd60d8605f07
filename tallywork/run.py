"""Build, check and publish one domain as a Spark job.

    spark-submit tallywork/run.py commerce s3a://feeds s3a://marts --run 2024-12-31 --as-of "2024-12-31 05:00:00"
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import SparkSession

from tallywork.operators import DataQualityError
from tallywork.plans import DOMAINS, run_domain
from tallywork.session import apply_settings, size_session
from tallywork.sources import SCHEMAS, delivered, drift_report, read_domain, unparsed_report


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("domain", choices=sorted(DOMAINS))
    parser.add_argument("raw", help="folder with <table>.parquet")
    parser.add_argument("out", help="folder for the intermediate and the marts")
    parser.add_argument("--run", required=True, help="name of this run; every attempt writes folders of its own")
    parser.add_argument("--as-of", help="instant freshness is judged at; without it freshness is not checked")
    parser.add_argument("--observation-date", type=date.fromisoformat, help="telecom: last day of the usage window")
    args = parser.parse_args(argv)

    spark = apply_settings(SparkSession.builder.appName(f"tallywork-{args.domain}")).getOrCreate()
    size_session(spark, args.raw)
    options = {"observation_date": args.observation_date} if args.observation_date else {}
    schemas = SCHEMAS[args.domain]
    tables = {name: delivered(spark, args.raw, name) for name in schemas}
    found = [report for report in (drift_report(spark, tables, schemas), unparsed_report(tables, schemas)) if report is not None]
    try:
        done = run_domain(
            spark, DOMAINS[args.domain], read_domain(spark, args.raw, args.domain, strict=False), args.out, args.run,
            as_of=args.as_of, reports=found, **options,
        )
    except DataQualityError as rejected:
        print(f"rejected: {rejected}", file=sys.stderr)
        return 1
    for row in [*done.freshness, *done.checks]:
        if row.status != "pass":
            print(f"{row.status}: {row.asDict()}")
    print(f"published {', '.join(done.marts)} as {args.run}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
