"""From extracted texts to typed profiles: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.functions import dates, scores, urls
from entityloom.functions import text as tx
from entityloom.operators.extract import SourceRules, lookup
from entityloom.schema import DATES, FIELD_TYPES, FIELDS, FLAGS, LINKS, SCORES

# The source whose sale dates come without a year and whose status stays as written.
YEARLESS_SOURCE = "icodrops"


def _yes_no_text(flag: Column) -> Column:
    return F.when(flag, "yes").when(~flag, "no")


def mean_star(styles: Column) -> Column:
    """Floor-mean of the non-zero widths in a comma-joined list of style texts."""
    numbers = F.transform(F.split(styles, ","), tx.style_number)
    rated = F.filter(numbers, lambda n: n > 0)
    total = F.aggregate(rated, F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    return F.when(F.size(rated) > 0, F.floor(total / F.size(rated)))


def _derived(raw: Column) -> dict[tuple[str, str], Column]:
    """Fields that a source spreads over several texts: (source, field) -> column."""
    get = lambda name: F.try_element_at(raw, F.lit(name))
    out: dict[tuple[str, str], Column] = {}

    # One source shows one of three labels; the first one present counts.
    chosen = F.coalesce(get("_time"), get("_pre_time"), get("_status"))
    is_pre = get("_time").isNull() & get("_pre_time").isNotNull()
    span = F.when(get("_time").isNotNull(), get("_time_range")).when(is_pre, get("_pre_range")).otherwise(get("_status_range"))
    dated = ~F.upper(chosen).isin("ENDED", "UNKNOWN")
    for i, side in enumerate(("start", "end")):
        found = F.when(dated, dates.iso_date_text(span, i))
        out["icobench", f"ico_{side}"] = F.coalesce(tx.drop_ordinals(get(f"_row_{side}")), F.when(~is_pre, found))
        out["icobench", f"pre_ico_{side}"] = F.coalesce(tx.drop_ordinals(get(f"_row_pre_{side}")), F.when(is_pre, found))
        plain = F.replace(get("_range"), F.lit("Token Sale:"), F.lit(""))
        out["icodrops", f"ico_{side}"] = dates.range_side(plain, i, "–", exactly_two=True)
        out["icomarks", f"ico_{side}"] = dates.range_side(get("_range"), i)
        out["icomarks", f"pre_ico_{side}"] = dates.range_side(get("_pre_range"), i)
        out["trackico", f"ico_{side}"] = dates.range_side(get("_range"), i, last_word=True)
        out["trackico", f"pre_ico_{side}"] = dates.range_side(get("_pre_range"), i, last_word=True)
    out["icobench", "status"] = tx.status_label(chosen)
    out["icodrops", "status"] = tx.status_phrase(get("_phrase"))
    out["icodrops", "whitelist"] = get("_whitelist")
    out["icodrops", "kyc"] = get("_kyc")
    for source in ("icobench", "icomarks"):
        out[source, "kyc"] = _yes_no_text(tx.flag_in(get("_flags"), "KYC"))
        out[source, "whitelist"] = _yes_no_text(tx.flag_in(get("_flags"), "WHITELIST"))
    out["tokentops", "website_overall_rating"] = F.nullif(get("website_overall_rating"), F.lit("0"))
    out["tokentops", "user_review_score"] = mean_star(get("_stars")).cast("string")
    return out


def profile_texts(extracted: DataFrame, packs: tuple[SourceRules, ...], *keep: str) -> DataFrame:
    """One text column per profile field out of ``raw``; needs ``source`` and ``ico_url``."""
    source, raw = F.col("source"), F.col("raw")
    derived = _derived(raw)
    for p in packs:
        derived[p.source, "logo"] = urls.resolve(F.lit(p.domain), F.try_element_at(raw, F.lit("logo")))

    def field(name: str) -> Column:
        if name in ("source", "ico_url"):
            return F.col(name)
        own = [(s, c) for (s, f), c in derived.items() if f == name]
        value = F.try_element_at(raw, F.lit(name))
        for s, c in own:
            value = F.when(source == s, c).otherwise(value)
        return value.alias(name)

    return extracted.select(*keep, *[field(f) for f in FIELDS])


def score_of(source: Column, field: str, value: Column, scales: dict = scores.SCORE_SCALES) -> Column:
    """Score on 0..10 by the source's own scale; a source without one is taken as is."""
    mine = {src: scale for (src, name), scale in scales.items() if name == field}
    if not mine:
        return scores.to_number(value)
    number = value
    for words in {w for w, _, _ in mine.values() if w}:
        uses = [src for src, (w, _, _) in mine.items() if w == words]
        number = F.when(source.isin(*uses), scores.word_value(value, scores.WORD_SCALES[words]).cast("string")).otherwise(number)
    end = lambda i: lookup({src: float(scale[i]) for src, scale in mine.items()})
    lo, hi = F.try_element_at(end(1), source), F.try_element_at(end(2), source)
    return F.when(source.isin(*mine), scores.rescale(number, lo, hi)).otherwise(scores.to_number(value))


def normalize(profiles: DataFrame, as_of: Column, *keep: str) -> DataFrame:
    """Typed profiles from profile texts: dates, status, links, scores and flags."""
    source = F.col("source")
    yearless = source == YEARLESS_SOURCE

    # First projection: every text is cleaned once, before conditions multiply its uses.
    def cleaned(name: str) -> Column:
        text = tx.known_text(F.col(name))
        return (dates.tidy_date_text(text) if name in DATES else text).alias(name)

    texts = profiles.select(*keep, *[cleaned(f) for f in FIELDS])
    col = F.col

    typed: dict[str, Column] = {d: dates.parse_tidy_date(col(d)) for d in DATES}
    for d in ("ico_start", "ico_end"):
        typed[d] = F.when(yearless, dates.parse_tidy_day_month(col(d), as_of)).otherwise(typed[d])
    for name, dtype in FIELD_TYPES.items():
        if name in SCORES:
            typed[name] = score_of(source, name, col(name))
        elif name in LINKS:
            typed[name] = urls.clean_link(urls.https(col(name)) if name == "telegram_page" else col(name))
        elif name in FLAGS:
            typed[name] = tx.yes_no(col(name))
        elif name not in DATES:
            typed[name] = col(name).try_cast(dtype)
    first = texts.select(*keep, *[typed[f].alias(f) for f in FIELDS])

    # Third projection: status and years need the parsed dates.
    start, end, status = F.col("ico_start"), F.col("ico_end"), F.col("status")
    new_start, new_end = dates.repair_years(start, end, status, as_of)
    again = {
        "ico_start": F.when(yearless, new_start).otherwise(start),
        "ico_end": F.when(yearless, new_end).otherwise(end),
        "status": F.when(yearless, status).otherwise(F.coalesce(dates.period_status(start, end, as_of), status)),
    }
    return first.select(*keep, *[again.get(f, F.col(f)).alias(f) for f in FIELDS])
