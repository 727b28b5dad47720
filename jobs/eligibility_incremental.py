"""Incremental eligibility: land an hour window, classify, publish a state batch."""

from __future__ import annotations

from _common import check_window, session, window_parser

from eligo.plans.batch_jobs import register_tables, run_increment
from eligo.schemas import Tables


def main(argv=None) -> None:
    p = window_parser(__doc__)
    p.add_argument("--max-broadcast-mb", type=int, default=64,
                   help="largest increment key set joined by broadcast")
    p.add_argument("--compact-rows-per-file", type=int, default=None,
                   help="rewrite the new batch into clustered files of about this many rows")
    p.add_argument("--tiebreak", action="store_true",
                   help="keep one row per key when versions tie beyond uses (default: keep all)")
    args = p.parse_args(argv)
    check_window(args)
    spark = session("offer-eligibility", args.scratch)
    tables = (Tables(args.warehouse, args.origin, args.database, args.buckets) if args.origin
              else Tables.for_raw_path(args.warehouse, args.raw_data, args.database, args.buckets))
    res = run_increment(spark, tables, args.raw_data, args.start, args.end, args.batch_id,
                        args.max_broadcast_mb * 1024 * 1024, args.compact_rows_per_file,
                        args.tiebreak)
    print(f"published batch {res.batch_id} (previous {res.previous_batch_id}): {res.audit}")
    if args.database:
        print("catalog:", *register_tables(spark, tables, args.database, args.start, args.end))
    spark.stop()


if __name__ == "__main__":
    main()
