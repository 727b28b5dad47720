"""Shared argument parsing and session set-up for the job entry points."""

from __future__ import annotations

import argparse
import sys
from datetime import date, datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from eligo.session import RECOMMENDED_CONF  # noqa: E402


def hour_arg(text: str) -> datetime:
    try:
        return datetime.strptime(text.strip(), "%Y-%m-%d %H")
    except ValueError:
        raise argparse.ArgumentTypeError(f"expected 'YYYY-MM-DD HH', got {text!r}") from None


def date_arg(text: str) -> date:
    return date.fromisoformat(text)


def window_parser(description: str) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=description)
    p.add_argument("--raw-data", "-r", dest="raw_data", required=True,
                   help="landing root holding year=/month=/day=/hour= directories")
    p.add_argument("--start-date-hour", "-s", dest="start", required=True, type=hour_arg,
                   help="first hour of the window, 'YYYY-MM-DD HH' (inclusive)")
    p.add_argument("--end-date-hour", "-e", dest="end", required=True, type=hour_arg,
                   help="end of the window, 'YYYY-MM-DD HH' (exclusive)")
    p.add_argument("--warehouse", "-w", required=True, help="root directory of the tables")
    p.add_argument("--origin", choices=["legacy", "kafka"], default=None,
                   help="payload format; default: 'kafka' when the landing path says so")
    p.add_argument("--batch-id", type=int, default=None,
                   help="version to write (default: window end as yyyymmddhh)")
    catalog_args(p)
    scratch_arg(p)
    return p


def catalog_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--database", default=None,
                   help="catalog database of the tables (default: directories only)")
    p.add_argument("--buckets", type=int, default=0,
                   help="buckets by key of the catalog's state and saved offers (default: none)")


def scratch_arg(p: argparse.ArgumentParser) -> None:
    p.add_argument("--scratch", default=None,
                   help="folder shared by all executors, used where spark.checkpoint.dir is unset")


def check_window(args) -> None:
    if not args.start < args.end:
        raise SystemExit(f"start {args.start} must be before end {args.end}")


def session(app: str, scratch: str | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if scratch and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", scratch)
        spark.sparkContext.setCheckpointDir(scratch)
    return spark
