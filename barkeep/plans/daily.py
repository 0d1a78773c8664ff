"""The daily run: find the days that have files, load them, refresh the metrics."""

from barkeep.functions.ranges import DAILY_IMPACTED
from barkeep.operators.manifest import NO_DATA, staging_manifest, staging_summary
from barkeep.plans.load import load_bars
from barkeep.plans.metrics import update_metrics
from barkeep.sources.raw_files import list_files


def daily_update(
    spark, input_path, bars_table, metrics_table, days, mode=DAILY_IMPACTED, slack_days=None,
    ledger=None,
):
    """Run for the requested ``days``; returns the staging summary row.

    Stops early if no file is there. Running it again for the same days gives the
    same tables, so the days of the last runs can be included for late files.
    ``mode`` is ``both_sides`` where re-loaded days are not the newest ones, and ``new_days`` where they
    are new as a rule (see ``extend_metrics``). For ``slack_days`` and ``ledger`` see ``load_bars``.
    """
    manifest = staging_manifest(list_files(spark, input_path, days), days)
    summary = staging_summary(manifest, input_path).first()
    if summary.status == NO_DATA:
        return summary
    start, end = summary.daily_start_date, summary.daily_end_date
    load_bars(spark, input_path, bars_table, start, end, slack_days=slack_days, ledger=ledger)
    update_metrics(spark, bars_table, metrics_table, start, end, mode)
    return summary
