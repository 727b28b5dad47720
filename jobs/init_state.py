"""Initial state: Parquet dump -> expiry status -> active / inactive state batch."""

from __future__ import annotations

import argparse
from datetime import date

from _common import catalog_args, date_arg, scratch_arg, session

from eligo.plans.batch_jobs import run_init
from eligo.schemas import Tables


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--raw-data", "-r", dest="raw_data", required=True,
                   help="dump directory ending in <name>=<batch id>")
    p.add_argument("--warehouse", "-w", required=True)
    p.add_argument("--as-of", type=date_arg, default=date.today(),
                   help="date the expiry is evaluated at (default: today)")
    p.add_argument("--batch-id", type=int, default=None)
    catalog_args(p)
    scratch_arg(p)
    args = p.parse_args(argv)
    spark = session("init-offer-eligibility", args.scratch)
    out = run_init(spark, Tables(args.warehouse, "legacy", args.database, args.buckets), args.raw_data, args.as_of, args.batch_id)
    print(out)
    spark.stop()


if __name__ == "__main__":
    main()
