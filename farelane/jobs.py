"""Batch job: curate one or both flavours of monthly raw files.

    spark-submit -m farelane.jobs --jobs both --run-mode past_months --months 3 \\
        --raw-root <folder with yellow/ and green/> --lookups <lookup csv folder> \\
        --curated-root <output folder>

For every flavour (green first, then yellow): select the months (run
mode), harmonise, curate with the lookup tables, run the quality gate on a
staged copy and replace exactly the processed months in
``<curated-root>/<vehicle>``.  Settings already present in the session are
kept (the cluster's checkpoint folder in particular).
"""

from __future__ import annotations

import argparse
from typing import Sequence

from pyspark.sql import SparkSession

from farelane import spec
from farelane.operators import harmonize
from farelane.plans.curate import curate
from farelane.session import ensure_checkpoint_dir, ensure_plan_settings, staging
from farelane.sinks.parquet import gated_publish
from farelane.sources import dims, runmodes

FLAVOURS = {"green": harmonize.harmonize_b, "yellow": harmonize.harmonize_a}
JOB_FLAVOURS = {"yellow": ("yellow",), "green": ("green",), "both": ("green", "yellow")}


def run_job(spark: SparkSession, jobs: str, run_mode: str, months: int, raw_root: str,
            lookups: str | dict, curated_root: str, cols: spec.TripColumns = spec.DEFAULT_COLUMNS,
            strict: bool = True, minimum_month: int = spec.SPECIFIC_MONTH_MIN,
            plan: str = "fused", timestamp_type: str = "ntz") -> dict[str, list]:
    """Run the curation for ``jobs`` in (yellow, green, both); returns the gate
    failures per vehicle (empty lists when all checks pass)."""
    if jobs not in JOB_FLAVOURS:
        raise ValueError("jobs must be yellow, green or both")
    ensure_checkpoint_dir(spark)
    ensure_plan_settings(spark)
    if isinstance(lookups, str) and strict and (found := dims.check_lookup_folder(spark, lookups)):
        raise ValueError("lookup files: " + "; ".join(f"{name}: {n} x {what}" for name, what, n in found))
    tables = dims.read_lookup_folder(spark, lookups) if isinstance(lookups, str) else lookups
    dim_set = {"ratecode": tables["ratecode"], "payment_type": tables["payment_type"],
               "zone": tables["taxi_zone"]}
    report = {}
    for vehicle in JOB_FLAVOURS[jobs]:
        folder = f"{raw_root.rstrip('/')}/{vehicle}"
        picked = runmodes.selected_months(spark, folder, vehicle, run_mode, months, minimum_month)
        raw = runmodes.read_selected(spark, folder, vehicle, picked)
        with staging(spark):
            curated = curate(FLAVOURS[vehicle](raw), dim_set, cols, plan=plan, timestamp_type=timestamp_type)
            report[vehicle] = gated_publish(curated, f"{curated_root.rstrip('/')}/{vehicle}", strict, picked, timestamp_type,
                                            (*spec.QUALITY_UNIQUE_KEY, *(("file_year", "file_month") if cols.scope else ())))
    return report


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    p.add_argument("--jobs", choices=sorted(JOB_FLAVOURS), default="both")
    p.add_argument("--run-mode", choices=("full_load", "past_months", "specific_month"), default="past_months")
    p.add_argument("--months", type=int, default=3, help="N for past_months, yyyymm for specific_month")
    p.add_argument("--raw-root", required=True)
    p.add_argument("--lookups", required=True)
    p.add_argument("--curated-root", required=True)
    p.add_argument("--report-only", action="store_true", help="publish even when a gate check fails")
    p.add_argument("--plan", choices=("fused", "window", "pruned"), default="fused",
                   help="physical plan for pair removal + keep-best (window: only for data without hot keys)")
    p.add_argument("--pair-scope", choices=("load", "month"), default="load",
                   help="search pairs and duplicates in all loaded months, or inside each file month (as the stream does)")
    p.add_argument("--timestamp-type", choices=("ntz", "ltz"), default="ntz")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("farelane-curate").getOrCreate()
    cols = spec.DEFAULT_COLUMNS.by_month() if a.pair_scope == "month" else spec.DEFAULT_COLUMNS
    report = run_job(spark, a.jobs, a.run_mode, a.months, a.raw_root, a.lookups, a.curated_root, cols,
                     strict=not a.report_only, plan=a.plan, timestamp_type=a.timestamp_type)
    for vehicle, failures in report.items():
        print(vehicle, "gate ok" if not failures else failures)


if __name__ == "__main__":
    main()
