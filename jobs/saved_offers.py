"""Saved offers: land an hour window, stage, merge into the offer dimension."""

from __future__ import annotations

from _common import check_window, session, window_parser

from eligo.plans.batch_jobs import register_tables, run_saved_offers
from eligo.schemas import Tables


def main(argv=None) -> None:
    args = window_parser(__doc__).parse_args(argv)
    check_window(args)
    spark = session("saved-offers", args.scratch)
    tables = (Tables(args.warehouse, args.origin, args.database, args.buckets) if args.origin
              else Tables.for_raw_path(args.warehouse, args.raw_data, args.database, args.buckets))
    rows = run_saved_offers(spark, tables, args.raw_data, args.start, args.end, args.batch_id)
    print(f"saved offers: {rows} rows")
    if args.database:
        print("catalog:", *register_tables(spark, tables, args.database, args.start, args.end))
    spark.stop()


if __name__ == "__main__":
    main()
