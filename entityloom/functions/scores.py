"""Column functions on scores: numeric test, linear rescale and ordinal words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityloom.functions.text import let, strip

NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Ordinal words and their numbers.
RISK_WORDS = {"Very Low": 1, "Low": 2, "Normal": 3, "High": 4, "Very High": 5}
INTEREST_WORDS = {
    "Very Low Interest": 0,
    "Low Interest": 1,
    "Neutral Interest": 2,
    "Medium Interest": 3,
    "High Interest": 4,
    "Very High Interest": 5,
}
RATING_GRADES = {
    "POSITIVE+": 8,
    "POSITIVE": 7,
    "STABLE+": 6,
    "STABLE": 5,
    "RISKY+": 4,
    "RISKY": 3,
    "RISKY-": 2,
    "NEGATIVE": 1,
    "NEGATIVE-": 0,
}
WORD_SCALES = {"risk": RISK_WORDS, "interest": INTEREST_WORDS, "grade": RATING_GRADES}

# Fixed values: (source, field) -> (word scale or None, scale start, scale end).
SCORE_SCALES: dict[tuple[str, str], tuple[str | None, float, float]] = {
    ("icobazaar", "website_overall_rating"): (None, 0, 5),
    ("icobazaar", "team_score"): (None, 0, 100),
    ("icodrops", "roi_score"): ("risk", 1, 5),
    ("icodrops", "hype_score"): ("risk", 1, 5),
    ("icodrops", "risk_score"): ("risk", 1, 5),
    ("icodrops", "website_overall_rating"): ("interest", 0, 5),
    ("icoratings", "roi_score"): ("grade", 0, 8),
    ("icoratings", "hype_score"): (None, 0, 5),
    ("icoratings", "risk_score"): (None, 0, 5),
    ("tokentops", "website_overall_rating"): (None, 0, 5),
    ("tokentops", "user_review_score"): (None, 0, 100),
    ("trackico", "website_overall_rating"): (None, 0, 5),
    ("icobench", "website_overall_rating"): (None, 0, 5),
    ("icobench", "team_score"): (None, 0, 5),
    ("icobench", "vision_score"): (None, 0, 5),
    ("icobench", "product_score"): (None, 0, 5),
}
TARGET_SCALE = (0.0, 10.0)


def is_number(c: Column) -> Column:
    """True for texts that read as a finite number; NULL counts as not a number."""
    return F.coalesce(strip(c.cast("string")).rlike(NUMBER), F.lit(False))


def to_number(c: Column) -> Column:
    return let(strip(c.cast("string")), lambda text: F.when(text.rlike(NUMBER), text.try_cast("double")))


def rounded(c: Column, decimals: int = 1) -> Column:
    """Round as the number is printed: by its exact binary value, ties to the even digit.

    (0.35 is stored a little below 0.35 and gives 0.3; ``bround`` would see a tie.)
    """
    layout = "0." + "0" * decimals if decimals else "0"
    scale = float(10**decimals)

    def shown(v: Column) -> Column:
        # Away from a tie, and where doubles resolve a millionth, the printed value is the nearest one.
        moved = v * scale
        near_tie = F.abs(moved - F.floor(moved) - 0.5) < 1e-6
        exact = F.call_function("format_number", v, F.lit(layout)).try_cast("double")
        return F.when((F.abs(v) < 1e9) & ~near_tie, F.rint(moved) / scale).otherwise(exact) + F.lit(0.0)

    return let(c, shown)


def rescale(c: Column, lo, hi, to_lo=TARGET_SCALE[0], to_hi=TARGET_SCALE[1], decimals: int = 1) -> Column:
    """Move a score from the scale lo..hi to to_lo..to_hi."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    lo, hi, to_lo, to_hi = map(as_col, (lo, hi, to_lo, to_hi))
    return rounded(to_lo + (to_number(c) - lo) * (to_hi - to_lo) / (hi - lo), decimals)


def word_value(c: Column, words: dict[str, int]) -> Column:
    """Number of an ordinal word, NULL for a word outside the scale."""
    pairs = [F.lit(v) for item in words.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), c)
