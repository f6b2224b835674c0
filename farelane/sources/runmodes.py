"""Load selection (run modes) over monthly raw files.

``full_load`` reads every month, ``past_months N`` the last N *available*
months (ordered by year and month, not by file modification time), and
``specific_month yyyymm`` one month.  The manifest comes from the file
listing (metadata only); data is read only for the selected months.  File
vintages with other columns or types are reconciled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelane import spec
from farelane.sources.files import month_glob, months_of, read_reconciled


class RunModeError(ValueError):
    pass


Month = tuple[str, str]


def full_load_months(spark: SparkSession, folder: str, vehicle: str) -> list[Month]:
    return months_of(spark, folder, vehicle)


def past_months(spark: SparkSession, folder: str, vehicle: str, months: int) -> list[Month]:
    if not (isinstance(months, int) and 0 < months < spec.PAST_MONTHS_MAX):
        raise RunModeError(f"past_months needs an int with 0 < N < {spec.PAST_MONTHS_MAX}, got {months!r}")
    return months_of(spark, folder, vehicle)[-months:]


def specific_month(yyyymm: int, minimum: int = spec.SPECIFIC_MONTH_MIN) -> list[Month]:
    text = str(yyyymm)
    if not (len(text) == 6 and text[-2:] in {f"{m:02d}" for m in range(1, 13)} and int(text) > minimum):
        raise RunModeError(f"specific_month needs yyyymm after {minimum} with month 01-12, got {yyyymm!r}")
    return [(text[:4], text[-2:])]


def selected_months(spark: SparkSession, folder: str, vehicle: str, run_mode: str,
                    months: int = 0, minimum: int = spec.SPECIFIC_MONTH_MIN) -> list[Month]:
    """The months that a run mode selects."""
    if run_mode == "full_load":
        return full_load_months(spark, folder, vehicle)
    if run_mode == "past_months":
        return past_months(spark, folder, vehicle, months)
    if run_mode == "specific_month":
        return specific_month(months, minimum)
    raise RunModeError(f"unknown run mode {run_mode!r}: use full_load, past_months or specific_month")


def read_selected(spark: SparkSession, folder: str, vehicle: str, months: list[Month]) -> DataFrame:
    """Rows of these months, with file_year / file_month."""
    return read_reconciled(spark, [month_glob(folder, vehicle, *m) for m in months])


def select_months(spark: SparkSession, folder: str, vehicle: str, run_mode: str,
                  months: int = 0, minimum: int = spec.SPECIFIC_MONTH_MIN) -> DataFrame:
    """Rows of the selected months, with file_year / file_month."""
    return read_selected(spark, folder, vehicle, selected_months(spark, folder, vehicle, run_mode, months, minimum))
