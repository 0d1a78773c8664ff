"""Command line of the jobs: ``spark-submit barkeep/__main__.py <job> ...`` or
``python -m barkeep <job> ...``."""

import argparse
import json
import sys

from barkeep.functions import ranges
from barkeep.operators.manifest import staging_manifest, staging_summary
from barkeep.operators.normalize import PERMISSIVE, STRICT
from barkeep.operators.profile import profile
from barkeep.plans.backfill import backfill, resumable_backfill
from barkeep.plans.daily import daily_update
from barkeep.plans.load import load_bars, load_relational, refresh_bars
from barkeep.plans.metrics import update_metrics
from barkeep.plans.quarantine import load_checked
from barkeep.session import build_session
from barkeep.sinks.relational import BATCH_ROWS, ensure_target
from barkeep.sinks.tables import (
    APPEND,
    OVERWRITE_PARTITIONS,
    create_bars_table,
    create_metrics_table,
)
from barkeep.sinks.versions import compact
from barkeep.sources.raw_files import list_files, read_inferred, read_ranges
from barkeep.streaming.ingest import ingest_new_files

MODES = (ranges.OUTPUT, ranges.DAILY_IMPACTED, ranges.BOTH_SIDES, ranges.NEW_DAYS)


def _bounds(parser, required=False):
    parser.add_argument("--start-date", required=required)
    parser.add_argument("--end-date", required=required)


def _request(parser):
    _bounds(parser)
    parser.add_argument("--trade-date")
    parser.add_argument("--lookback-days", type=int)


def _requested(args):
    return ranges.staging_request(
        args.start_date, args.end_date, args.trade_date, args.lookback_days
    )


def job_load(spark, args):
    load_bars(
        spark, args.input_path, args.table, args.start_date, args.end_date, args.write_disposition,
        args.slack_days, args.ledger,
    )


def job_metrics(spark, args):
    days = update_metrics(
        spark,
        args.source_table,
        args.target_table,
        args.start_date,
        args.end_date,
        args.date_range_mode,
        args.unique_days,
    )
    return {"start": days.start, "end": days.end} if days else None


def job_daily(spark, args):
    days = _requested(args)
    return daily_update(
        spark, args.input_path, args.table, args.target_table, days, args.date_range_mode,
        args.slack_days, args.ledger,
    ).asDict()


def job_refresh(spark, args):
    return {"days": refresh_bars(spark, args.input_path, args.table, args.ledger)}


def job_manifest(spark, args):
    days = _requested(args)
    manifest = staging_manifest(list_files(spark, args.input_path, days), days)
    return staging_summary(manifest, args.input_path).first().asDict()


def job_backfill(spark, args):
    listed = read_ranges(spark, args.ranges)
    if args.finished:
        done = resumable_backfill(spark, listed, args.table, args.finished, args.mode)
    else:
        done = backfill(spark, listed, args.table, args.mode)
    return [row.asDict() for row in done.orderBy("range_id").collect()]


def job_load_checked(spark, args):
    return vars(load_checked(spark, args.input_path, args.table, args.quarantine))


def job_compact(spark, args):
    return {"years": compact(spark, args.table, args.most_versions)}


def job_ingest(spark, args):
    ingest_new_files(spark, args.input_path, args.table, args.checkpoint, args.files_per_batch, args.ledger)


def job_relational(spark, args):
    target = (args.url, args.schema, args.table)
    properties = dict(p.split("=", 1) for p in args.property)
    if args.ensure_schema_only:
        ensure_target(spark, *target, properties)
        return None
    days = None
    if not args.exact_file:
        days = ranges.loader_request(
            args.trade_date, args.days_ago, args.lookback_days, args.timezone
        )
    done = load_relational(
        spark,
        args.input_path,
        *target,
        days=days,
        properties=properties,
        require_data=args.require_data,
        mode=args.mode,
        batch_rows=args.batch_size,
    )
    return vars(done)


def job_profile(spark, args):
    return vars(profile(read_inferred(spark, args.input_path), args.sample_size))


def job_create_tables(spark, args):
    create_bars_table(spark, args.table, args.location)
    create_metrics_table(spark, args.target_table, args.target_location)


def parser():
    top = argparse.ArgumentParser(prog="barkeep")
    top.add_argument("--warehouse-path")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, *arguments):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for argument in arguments:
            sub.add_argument(argument, required=True)
        return sub

    sub = job("load", job_load, "--input-path", "--table")
    _bounds(sub)
    sub.add_argument("--slack-days", type=int, help="open only files of the days and these around them")
    sub.add_argument("--ledger", help="table that remembers which days each file holds")
    sub.add_argument(
        "--write-disposition", choices=(OVERWRITE_PARTITIONS, APPEND), default=OVERWRITE_PARTITIONS
    )
    sub = job("metrics", job_metrics, "--source-table", "--target-table")
    _bounds(sub, required=True)
    sub.add_argument("--date-range-mode", choices=MODES, default=ranges.OUTPUT)
    sub.add_argument(
        "--unique-days", action="store_true", help="the source has one bar per ticker and day"
    )
    sub = job("daily", job_daily, "--input-path", "--table", "--target-table")
    _request(sub)
    sub.add_argument("--date-range-mode", choices=MODES[1:], default=ranges.DAILY_IMPACTED)
    sub.add_argument("--slack-days", type=int, help="open only files of the days and these around them")
    sub.add_argument("--ledger", help="table that remembers which days each file holds")
    job("refresh", job_refresh, "--input-path", "--table", "--ledger")
    _request(job("manifest", job_manifest, "--input-path"))
    sub = job("backfill", job_backfill, "--ranges", "--table")
    sub.add_argument("--mode", choices=(PERMISSIVE, STRICT), default=PERMISSIVE)
    sub.add_argument("--finished", help="table that remembers finished ranges: a run begun again does the rest")
    job("load-checked", job_load_checked, "--input-path", "--table", "--quarantine")
    sub = job("compact", job_compact, "--table")
    sub.add_argument("--most-versions", type=int, default=1, help="leave years alone that have no more than these")
    sub = job("ingest", job_ingest, "--input-path", "--table", "--checkpoint")
    sub.add_argument("--files-per-batch", type=int)
    sub.add_argument("--ledger", help="also notice files that were replaced under their name")
    sub = job("relational", job_relational, "--input-path", "--url")
    sub.add_argument("--schema", default="public")
    sub.add_argument("--table", default="daily_pricing")
    sub.add_argument("--property", action="append", default=[], metavar="KEY=VALUE")
    sub.add_argument("--trade-date")
    sub.add_argument("--days-ago", type=int, default=ranges.LOADER_DAYS_AGO)
    sub.add_argument("--lookback-days", type=int, default=ranges.LOADER_LOOKBACK_DAYS)
    sub.add_argument("--timezone", default=ranges.MARKET_ZONE)
    sub.add_argument("--exact-file", action="store_true", help="load input-path, whatever its day")
    sub.add_argument("--mode", choices=(STRICT, PERMISSIVE), default=STRICT)
    sub.add_argument("--batch-size", type=int, default=BATCH_ROWS)
    sub.add_argument("--require-data", action="store_true")
    sub.add_argument("--ensure-schema-only", action="store_true")
    sub = job("profile", job_profile, "--input-path")
    sub.add_argument("--sample-size", type=int, default=10)
    sub = job("create-tables", job_create_tables, "--table", "--target-table")
    sub.add_argument("--location")
    sub.add_argument("--target-location")
    return top


def main(arguments=None):
    args = parser().parse_args(arguments)
    spark = build_session(f"barkeep-{args.job}", args.warehouse_path)
    result = args.run(spark, args)
    if result is not None:
        print(json.dumps(result, default=str, indent=2))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
