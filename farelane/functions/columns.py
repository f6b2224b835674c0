"""Column-expression builders.  All return JVM-side ``Column`` expressions
(no Python UDFs), so they stay inside whole-stage codegen."""

from __future__ import annotations

import operator
from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPS = {"<": operator.lt, "<=": operator.le, ">": operator.gt,
        ">=": operator.ge, "==": operator.eq, "!=": operator.ne}


def c(name_or_col) -> Column:
    return name_or_col if isinstance(name_or_col, Column) else F.col(name_or_col)


def sum_null_as_zero(columns: Sequence[str]) -> Column:
    """a + b + ... with every NULL read as 0, left-to-right (double addition
    is order sensitive, so the order is part of the contract)."""
    return reduce(operator.add, [F.coalesce(c(x), F.lit(0)) for x in columns])


def sum_strict(columns: Sequence[str]) -> Column:
    """a + b + ... where any NULL makes the result NULL."""
    return reduce(operator.add, [c(x) for x in columns])


def safe_ratio(numerator, denominator) -> Column:
    """numerator / denominator; NULL when the divisor is 0 or NULL."""
    return F.try_divide(c(numerator), c(denominator))


def ratio_or_zero(numerator, denominator) -> Column:
    """Exploration variant: a zero divisor (or any NULL) gives 0."""
    return F.coalesce(safe_ratio(numerator, denominator), F.lit(0.0))


def compare(column, op: str, value) -> Column:
    return _OPS[op](c(column), value)


def any_rule(rules: Iterable[Column]) -> Column:
    """Ordered CASE that is TRUE when any rule is TRUE and FALSE otherwise
    (a NULL rule counts as not matched, as in ``CASE WHEN``)."""
    rules = list(rules)
    expr = F.when(rules[0], F.lit(True))
    for r in rules[1:]:
        expr = expr.when(r, F.lit(True))
    return expr.otherwise(F.lit(False))


def month_start(year_col, month_col) -> Column:
    """First instant of a (year, month) pair as TIMESTAMP_NTZ; NULL when the
    pair is not a valid month (instead of failing the job)."""
    return F.try_make_timestamp_ntz(
        c(year_col).try_cast("int"), c(month_col).try_cast("int"),
        F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def with_year(ts, year) -> Column:
    """``ts`` moved into ``year`` keeping month/day/h/m/s (sub-second part is
    dropped).  Invalid results (29 Feb into a common year) give NULL."""
    ts = c(ts)
    return F.try_make_timestamp_ntz(
        c(year), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts),
        F.second(ts))


def _is_new_years_eve(ts, year) -> Column:
    return (F.year(ts) == year) & (F.month(ts) == 12) & (F.dayofmonth(ts) == 31)


def _is_new_years_day(ts, year) -> Column:
    return (F.year(ts) == year) & (F.month(ts) == 1) & (F.dayofmonth(ts) == 1)


def repaired_start(start, end, file_year) -> Column:
    """Start timestamp forced into the file year.

    Kept as is when its year equals the file year, or when the trip crosses
    into the file year at New Year (starts 31 Dec of the previous year and
    ends 1 Jan of the file year); otherwise its year is replaced.
    """
    start, end = c(start), c(end)
    fy = c(file_year)
    return (F.when(F.year(start) == fy, start)
            .when(_is_new_years_eve(start, fy - 1) & _is_new_years_day(end, fy), start)
            .otherwise(with_year(start, fy)))


def repaired_end(start_repaired, end, file_year) -> Column:
    """End timestamp forced into the file year, judged against the already
    repaired start: kept when in the file year or when the trip crosses out
    of the file year at New Year; otherwise its year is replaced."""
    start, end = c(start_repaired), c(end)
    fy = c(file_year)
    return (F.when(F.year(end) == fy, end)
            .when(_is_new_years_eve(start, fy) & _is_new_years_day(end, fy + 1), end)
            .otherwise(with_year(end, fy)))


def clamped_end(start, end) -> Column:
    """end < start -> start.  NULL-preserving (unlike ``greatest``)."""
    return F.when(c(end) < c(start), c(start)).otherwise(c(end))


def duration_minutes(start, end) -> Column:
    """Whole-second wall-clock difference in minutes (double)."""
    return (F.unix_timestamp(c(end)) - F.unix_timestamp(c(start))) / F.lit(60)


def all_not_null(columns: Sequence[str]) -> Column:
    return reduce(operator.and_, [c(x).isNotNull() for x in columns])
