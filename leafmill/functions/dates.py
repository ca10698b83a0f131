"""Dates in file names and texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_YEAR = r"(?i)(January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[-_ ]*(\d{4})"
QUARTER = r"Q([1-4])[-_ ]*(\d{4})"
TRAILING_YEAR = r"[-_ ](\d{4})([-_. ]|$)"
EIGHT_DIGITS = r"(\d{4})(\d{2})(\d{2})"
CODE = r"[-_ ](2\d|30)(0[1-9]|1[0-2])([-_. ]|$)"


def month_number(name: Column) -> Column:
    """1 to 12 by the first three letters, else null."""
    at = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(name, 1, 3)))
    return F.when(at > 0, at)


def _iso(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.format_string("%s-%02d-%02d", year, month.cast("int"), day.cast("int")))


def file_date(c: Column) -> Column:
    """The date in a file name: month and year, quarter, separated year, eight digits, or YYMM, the first that is found."""
    one = F.lit(1)
    month_year = F.when(c.rlike(MONTH_YEAR), _iso(F.regexp_extract(c, MONTH_YEAR, 2), month_number(F.regexp_extract(c, MONTH_YEAR, 1)), one))
    quarter = F.when(c.rlike(QUARTER), _iso(F.regexp_extract(c, QUARTER, 2), (F.regexp_extract(c, QUARTER, 1).cast("int") - 1) * 3 + 1, one))
    year = F.when(c.rlike(TRAILING_YEAR), _iso(F.regexp_extract(c, TRAILING_YEAR, 1), one, one))
    digits = F.when(c.rlike(EIGHT_DIGITS), F.try_to_date(F.regexp_replace(F.regexp_extract(c, EIGHT_DIGITS, 0), EIGHT_DIGITS, "$1-$2-$3")))
    code = F.when(c.rlike(CODE), _iso(F.concat(F.lit("20"), F.regexp_extract(c, CODE, 1)), F.regexp_extract(c, CODE, 2).cast("int"), one))
    return F.when(c.rlike(MONTH_YEAR), month_year).when(c.rlike(QUARTER), quarter).when(c.rlike(TRAILING_YEAR), year).when(c.rlike(EIGHT_DIGITS), digits).otherwise(code)


def long_date(c: Column) -> Column:
    """'12 March 2024' as a date, else null."""
    form = r"^\s*(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})\s*$"
    return F.when(c.rlike(form), _iso(F.regexp_extract(c, form, 3), month_number(F.regexp_extract(c, form, 2)), F.regexp_extract(c, form, 1).cast("int")))


def expired(at: Column, now: Column, days: int) -> Column:
    return at < now - F.expr(f"INTERVAL {days} DAYS")
