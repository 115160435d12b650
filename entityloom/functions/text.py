"""Column functions on text: trimming, sentinels, delimiters, flags and small numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityloom.schema import ACTIVE, ENDED, MISSING, UPCOMING

# White space that a page text may carry at its ends, the no-break space included.
BLANKS = " \t\n\r\f\v\u00a0"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for each row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def squash(c: Column) -> Column:
    """Strip, then turn every run of white space into one space."""
    return strip(F.regexp_replace(c, r"[\s\u00a0]+", " "))


def missing_to_null(c: Column, sentinel: str = MISSING) -> Column:
    return F.nullif(strip(c), F.lit(sentinel))


def null_to_missing(c: Column, sentinel: str = MISSING) -> Column:
    return F.coalesce(c.cast("string"), F.lit(sentinel))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def known_text(c: Column, sentinel: str = MISSING) -> Column:
    """Stripped text; the sentinel and blanks are NULL."""
    text = strip(c)
    return F.when(~text.isin(sentinel, ""), text)


def title_case(c: Column) -> Column:
    return F.initcap(squash(c))


def drop_quotes(c: Column) -> Column:
    return strip(F.replace(c, F.lit('"'), F.lit("")))


def before(c: Column, delimiter: str = "(") -> Column:
    """``NAME (SYM)`` -> ``NAME``."""
    return strip(F.substring_index(c, delimiter, 1))


def between_colons(c: Column) -> Column:
    """The part after the first colon, up to the next one; NULL where there is no colon."""
    return F.when(F.contains(c, F.lit(":")), strip(F.split_part(c, F.lit(":"), F.lit(2))))


def fraction_numerator(c: Column) -> Column:
    """``a / b`` -> a; anything that is not exactly two parts -> NULL."""
    parts = F.split(c, "/")
    return F.when(F.size(parts) == 2, strip(F.get(parts, F.lit(0))).try_cast("double"))


def style_percent(c: Column) -> Column:
    """``width: 85%`` -> 85."""
    return F.regexp_extract(c, r"([0-9]{1,3})%", 1).try_cast("int")


def style_number(c: Column) -> Column:
    """First run of one to three digits, with or without a percent sign."""
    return F.regexp_extract(c, r"([0-9]{1,3})", 1).try_cast("int")


def first_integer(c: Column) -> Column:
    return F.regexp_extract(c, r"([0-9]+)", 1).try_cast("bigint")


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "").try_cast("bigint")


def status_phrase(c: Column) -> Column:
    """A sale phrase -> status; the order of the tests matters."""
    return (
        F.when(F.contains(c, F.lit("ended")), ENDED)
        .when(F.contains(c, F.lit("starts")), UPCOMING)
        .when(F.contains(c, F.lit("ends in")), ACTIVE)
    )


def status_label(c: Column) -> Column:
    """A status label: only ``ENDED`` says something, ``UNKNOWN`` and dates do not."""
    return F.when(F.upper(strip(c)) == "ENDED", ENDED)


def flag_in(c: Column, word: str) -> Column:
    """True where the combined field names ``word``, false where it does not."""
    return F.contains(F.upper(c), F.lit(word.upper()))


def yes_no(c: Column) -> Column:
    text = F.lower(c)
    return F.when(F.contains(text, F.lit("yes")), True).when(F.contains(text, F.lit("no")), False)


def drop_ordinals(c: Column) -> Column:
    """``1st August 2018`` -> ``1 August 2018``; letters after a word are left alone."""
    return F.regexp_replace(c, r"(?i)([0-9])(st|nd|rd|th)\b", "$1")


def zero_to_null(c: Column) -> Column:
    return F.when(c != 0, c)
