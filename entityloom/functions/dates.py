"""Column functions on dates.  Every "now" is a parameter (``as_of``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityloom.functions.text import squash, strip
from entityloom.schema import ACTIVE, ENDED, UPCOMING

# The date layouts the sources use, each with the shape of its texts.  The
# shape is tested first, since a failing parse costs far more than a failing match.
DATE_LAYOUTS = (
    (r"^[A-Za-z]{3,} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^[A-Za-z]{3}\. \d{1,2}, \d{4}$", "MMM. d, yyyy"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,} \d{4}$", "d MMMM yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", "yyyy.M.d"),
)


def tidy_date_text(c: Column) -> Column:
    """One spelling per month: single spaces, capital first letters, ``Sept`` as ``Sep``."""
    text = F.initcap(squash(c))
    return F.replace(F.replace(text, F.lit("Sept "), F.lit("Sep ")), F.lit("Sept."), F.lit("Sep."))


def parse_date(c: Column) -> Column:
    """The date in the layout that fits, else NULL."""
    return parse_tidy_date(tidy_date_text(c))


def parse_tidy_date(text: Column) -> Column:
    """As ``parse_date`` for a column that already holds tidy texts.

    Where many columns are parsed, tidy them in a projection of their own: an expression
    below several conditions would be computed under each of them.
    """
    shape, layout = DATE_LAYOUTS[0]
    parsed = F.when(text.rlike(shape), F.try_to_date(text, layout))
    for shape, layout in DATE_LAYOUTS[1:]:
        parsed = parsed.when(text.rlike(shape), F.try_to_date(text, layout))
    return parsed


def parse_day_month(c: Column, as_of: Column) -> Column:
    """``29 Feb`` -> that day in the year of ``as_of``; NULL where the year has no such day."""
    return parse_tidy_day_month(tidy_date_text(c), as_of)


def parse_tidy_day_month(text: Column, as_of: Column) -> Column:
    dated = F.concat(text, F.lit(" "), F.year(as_of).cast("string"))
    return F.when(text.rlike(r"^\d{1,2} [A-Za-z]{3}$"), F.try_to_date(dated, "d MMM yyyy"))


def repair_years(start: Column, end: Column, status: Column, as_of: Column) -> tuple[Column, Column]:
    """Move dates whose year was guessed by one year, so that they agree with the status."""
    known = start.isNotNull() & end.isNotNull()

    def shifted(c: Column, years: int) -> Column:
        return F.add_months(c, 12 * years)

    new_start = (
        F.when(known & status.isin(ENDED, ACTIVE) & (start > as_of), shifted(start, -1))
        .when(known & (status == UPCOMING) & (start < as_of), shifted(start, 1))
        .otherwise(start)
    )
    new_end = (
        F.when(known & (status == ENDED) & (end > as_of), shifted(end, -1))
        .when(known & status.isin(ACTIVE, UPCOMING) & (end < as_of), shifted(end, 1))
        .otherwise(end)
    )
    return new_start, new_end


def period_status(start: Column, end: Column, as_of: Column) -> Column:
    """Status of a period on a day; the end day still counts as active."""
    known = start.isNotNull() & end.isNotNull()
    return (
        F.when(known & as_of.between(start, end), ACTIVE)
        .when(known & (as_of < start), UPCOMING)
        .when(known & (as_of > end), ENDED)
    )


def range_side(c: Column, side: int, separator: str = "-", exactly_two: bool = False, last_word: bool = False) -> Column:
    """One side (0 start, 1 end) of a date range text; a text without separator is a start.

    ``exactly_two`` gives NULL unless the separator occurs once; ``last_word`` keeps the
    last word of the side, for texts such as ``Starts 01.02.2018 - ends 03.04.2018``.
    """
    parts = F.split(c, separator)
    value = strip(F.get(parts, F.lit(side)))
    if last_word:
        value = F.try_element_at(F.split(value, r"\s+"), F.lit(-1))
    ok = F.size(parts) == 2 if exactly_two else F.size(parts) > side
    return F.when(ok, F.nullif(value, F.lit("")))


def iso_date_text(c: Column, index: int) -> Column:
    """The ``index``-th ``YYYY-MM-DD`` or ``YYYY.MM.DD`` in a text, else NULL."""
    found = F.regexp_extract_all(c, F.lit(r"([0-9]{4}[-.][0-9]{2}[-.][0-9]{2})"), F.lit(1))
    return F.get(found, F.lit(index))
