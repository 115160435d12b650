"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Card numbers (Luhn), phone numbers, social security numbers, IPv4 addresses and dates are
validated and then permuted within their own format: a card number becomes a card number with
a right check digit, a date a date in the same layout.  The permutation depends on the key and
the kind alone, so equal values stay equal in all documents, however they are punctuated.
E-mail addresses and hexadecimal secrets have no numeric domain; a keyed digest in their own
shape stands for them.  Values that fail validation stay as they are.

All steps are column functions; no Python runs on executors and nothing is shuffled.

Defined results: a NULL text stays NULL with no pseudonyms; an empty text stays empty; rows are
treated one by one, so repeated rows and doc_ids need no rule; other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import columns_named, let

ROUNDS = 10
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

EMAIL = r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
IPV4 = rf"(?<![0-9A-Za-z.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])"
DATE = r"(?<![0-9A-Za-z/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z/-]|\.[0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
PHONE = r"(?<![0-9A-Za-z(])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
SECRET = r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{64}|[0-9a-fA-F]{40}|[0-9a-fA-F]{32})(?![0-9A-Za-z])"
ANY = "|".join((EMAIL, IPV4, DATE, SSN, PHONE, CARD, SECRET))
#: What may lie beside a card, or share digits with one.
_OTHER = "|".join((EMAIL, IPV4, DATE, SSN, PHONE))
#: Groupings of cards; what has one of them goes before other groups of three and more digits.
_FOURS = r"[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}"
_LAYOUTS = rf"[0-9]{{13,19}}|{_FOURS}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}[ -][0-9]{{3}}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{2}}[ -][0-9]"
_GROUPS = r"[0-9]{3,19}(?:[ -][0-9]{3,16}){0,5}(?:[ -][0-9]{1,16})?"
#: A run of digits with no others beside it.
_ALONE = rf"(?<![0-9][ ./-]){CARD}(?![ ./-][0-9])"

#: 400 years of the calendar are 146,097 days, 189 times 773: a domain without rejection.
FIRST_DAY, DAYS_LOW, DAYS_HIGH = "1800-01-01", 189, 773


def _noise(key: str, kind: str, i: Column, x: Column, salt: Column | None = None) -> Column:
    """60 keyed bits of the round ``i`` and the half ``x``."""
    parts = [F.lit(key), F.lit(kind), i.cast("string"), x.cast("string")]
    digest = F.sha2(F.concat_ws("|", *parts, *([salt] if salt is not None else [])), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, a: Column, b: Column, size_a: Column, size_b: Column, salt: Column | None = None) -> Column:
    """The pair (a, b) of Z(size_a) x Z(size_b) under a keyed permutation of that domain."""
    pair = lambda x, y: F.struct(x.cast("long").alias("a"), y.cast("long").alias("b"))

    def turn(s: Column, i: Column) -> Column:
        size = F.when(i % 2 == 0, size_a).otherwise(size_b)
        return pair(s["b"], F.pmod(s["a"] + _noise(key, kind, i, s["b"], salt), size))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), pair(a, b), turn)


def _padded(x: Column, width: Column) -> Column:
    return F.lpad(x.cast("string"), width, F.lit("0"))


def permuted_digits(key: str, kind: str, digits: Column) -> Column:
    """A digit string of 2 to 18 digits as another of the same length."""

    def run(d: Column) -> Column:
        n = F.length(d)
        low = (n / 2).cast("int")
        size = lambda w: F.pow(F.lit(10.0), w).cast("long")
        halves = feistel(
            key,
            kind,
            F.substr(d, F.lit(1), low).cast("long"),
            F.substr(d, low + 1).cast("long"),
            size(low),
            size(n - low),
            n.cast("string"),
        )
        return let(halves, lambda h: F.concat(_padded(h["a"], low), _padded(h["b"], n - low)))

    return let(digits, run)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _laid_out(match: Column, digits: Column) -> Column:
    """``match`` with its digits replaced by ``digits``, one after the other."""
    before = lambda i: F.length(_digits(F.substr(match, F.lit(1), i)))
    char = lambda i: F.substr(match, i, F.lit(1))
    chars = F.transform(
        F.sequence(F.lit(1), F.length(match)),
        lambda i: F.when(char(i).rlike("[0-9]"), F.substr(digits, before(i), F.lit(1))).otherwise(char(i)),
    )
    return F.array_join(chars, "")


def luhn_digit(payload: Column) -> Column:
    """The check digit for a number without one."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        twice = F.substr(payload, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def _valid_card(m: Column) -> Column:
    return let(
        _digits(m),
        lambda d: luhn_digit(F.substr(d, F.lit(1), F.length(d) - 1)) == F.substr(d, F.length(d), F.lit(1)),
    )


def _cards_at_groups(text: Column, shape: str) -> Column:
    """The valid cards of ``shape`` that start and end with any group of digits; they may overlap."""
    size = lambda n: rf"(?=[0-9](?:[ -]?[0-9]){{{n - 1}}}(?![0-9A-Za-z]))"
    # The shape is tested on what has n digits, since it must not decide where the digits end.
    found = [
        F.regexp_extract_all(text, F.lit(rf"(?<![0-9A-Za-z]){size(n)}(?=([0-9](?:[ -]?[0-9]){{{n - 1}}}))[0-9]"), F.lit(1))
        for n in range(19, 12, -1)
    ]
    shaped = F.filter(F.array_distinct(F.concat(*found)), lambda m: m.rlike(f"^(?:{shape})$"))
    return F.filter(shaped, _valid_card)


def _one_of(cards: Column) -> Column:
    """A pattern of these cards and no others; with none, one that matches nothing."""
    return F.concat(F.lit("(?<![0-9A-Za-z])(?:"), F.array_join(cards, "|"), F.lit("|(?!))(?![0-9A-Za-z])"))


def _search_pattern(text: Column) -> Column:
    """``ANY`` with the valid cards of ``text`` in place of all runs of digits.

    A run of 13 to 19 digits may hold a card and its neighbours, so cards are looked for from
    group to group first; what is no card is left to the other patterns.
    """
    without = lambda t, cards: F.regexp_replace(t, _one_of(cards), F.lit("\n"))
    cleared = lambda t: F.regexp_replace(t, F.lit(_OTHER), F.lit("\n"))
    # Short groups (single digits) count as a card only if the longest run of them is one.
    runs = lambda t, shape: F.filter(F.array_distinct(F.regexp_extract_all(t, F.lit(shape), F.lit(0))), _valid_card)

    def pattern(usual: Column) -> Column:
        # A card after two groups of digits, the first of which would pass for the end of a phone number.
        return let(without(text, usual), lambda t: let(_cards_at_groups(t, _FOURS), lambda late: joined(usual, late, t)))

    def joined(usual: Column, late: Column, text: Column) -> Column:
        odd = let(
            without(text, late),
            lambda t: F.concat(
                let(cleared(t), lambda c: F.concat(_cards_at_groups(c, _GROUPS), runs(c, CARD))), runs(t, _ALONE)
            ),
        )
        free = F.concat(F.lit("(?!"), _one_of(late), F.lit(")[0-9]{4}"))
        last = lambda shape: shape.rpartition("[0-9]{4}")
        guarded = [x for shape in (SSN, PHONE) for x in (F.lit("|" + last(shape)[0]), free, F.lit(last(shape)[2]))]
        cards = _one_of(F.array_distinct(F.concat(usual, late, odd)))
        return F.concat(F.lit("|".join((EMAIL, IPV4, DATE))), *guarded, F.lit("|"), cards, F.lit("|" + SECRET))

    return F.when(text.rlike(CARD), let(_cards_at_groups(cleared(text), _LAYOUTS), pattern)).otherwise(F.lit(ANY))


def _card(key: str, m: Column) -> Column:
    """The first digit names the network and stays; the check digit is computed anew."""

    def of(d: Column) -> Column:
        n = F.length(d)
        payload = F.substr(d, F.lit(1), n - 1)
        fresh = F.concat(F.substr(d, F.lit(1), F.lit(1)), permuted_digits(key, "card", F.substr(d, F.lit(2), n - 2)))
        valid = luhn_digit(payload) == F.substr(d, n, F.lit(1))
        return F.when(valid, let(fresh, lambda p: _laid_out(m, F.concat(p, luhn_digit(p)))))

    return let(_digits(m), of)


def _phone(key: str, m: Column) -> Column:
    """The ten last digits are permuted; a country code stays."""

    def of(d: Column) -> Column:
        code = F.length(d) - 10
        return _laid_out(
            m, F.concat(F.substr(d, F.lit(1), code), permuted_digits(key, "phone", F.substr(d, code + 1)))
        )

    return let(_digits(m), of)


def _ipv4(key: str, m: Column) -> Column:
    part = lambda i: F.split_part(m, F.lit("."), F.lit(i)).cast("long")
    size = F.lit(65536).cast("long")
    halves = feistel(key, "ipv4", part(1) * 256 + part(2), part(3) * 256 + part(4), size, size)
    octet = lambda x, high: (F.floor(x / 256) if high else x % 256).cast("string")
    return let(
        halves,
        lambda h: F.concat_ws(".", octet(h["a"], True), octet(h["a"], False), octet(h["b"], True), octet(h["b"], False)),
    )


def _ssn(key: str, m: Column) -> Column:
    """Areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999."""
    part = lambda i: F.split_part(m, F.lit("-"), F.lit(i)).cast("long")
    area, group, serial = part(1), part(2), part(3)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    halves = feistel(
        key,
        "ssn",
        area - 1 - F.when(area > 666, 1).otherwise(0),
        (group - 1) * 9999 + serial - 1,
        F.lit(898).cast("long"),
        F.lit(99 * 9999).cast("long"),
    )

    def show(h: Column) -> Column:
        fresh = h["a"] + 1 + F.when(h["a"] >= 665, 1).otherwise(0)
        return F.concat_ws(
            "-",
            _padded(fresh, F.lit(3)),
            _padded(F.floor(h["b"] / 9999) + 1, F.lit(2)),
            _padded(h["b"] % 9999 + 1, F.lit(4)),
        )

    return F.when(valid, let(halves, show))


def _date(key: str, m: Column) -> Column:
    """A day of the years 1800 to 2199; day before month where both readings are valid."""

    def moved(day: Column, layout: str) -> Column:
        offset = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
        halves = feistel(
            key,
            "date",
            F.floor(offset / DAYS_HIGH),
            offset % DAYS_HIGH,
            F.lit(DAYS_LOW).cast("long"),
            F.lit(DAYS_HIGH).cast("long"),
        )
        fresh = let(halves, lambda h: F.date_add(F.lit(FIRST_DAY).cast("date"), (h["a"] * DAYS_HIGH + h["b"]).cast("int")))
        return F.when(offset.between(0, DAYS_LOW * DAYS_HIGH - 1), F.date_format(fresh, layout))

    in_layout = lambda layout: let(F.try_to_date(m, layout), lambda day: moved(day, layout))
    return (
        F.when(m.rlike("^[0-9]{4}-"), in_layout("yyyy-MM-dd"))
        .when(m.contains("."), in_layout("dd.MM.yyyy"))
        .otherwise(F.coalesce(in_layout("dd/MM/yyyy"), in_layout("MM/dd/yyyy")))
    )


def _email(key: str, m: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256)
    return F.concat(F.lit("u"), F.substring(digest, 1, 12), F.lit("@example.org"))


def _secret(key: str, m: Column) -> Column:
    """Hexadecimal of the same length and case; letters and digits must both occur."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("secret"), F.lower(m)), 256)
    fresh = F.substr(digest, F.lit(1), F.length(m))
    return F.when(
        m.rlike("[0-9]") & m.rlike("[A-Fa-f]"), F.when(m == F.upper(m), F.upper(fresh)).otherwise(fresh)
    )


def pseudonym(key: str, m: Column) -> Column:
    """What stands for the match ``m``; NULL where it is not valid and stays."""
    whole = lambda pattern: m.rlike(f"^(?:{pattern})$")
    return (
        F.when(m.contains("@"), _email(key, m))
        .when(whole(IPV4), _ipv4(key, m))
        .when(whole(DATE), _date(key, m))
        .when(whole(SSN), _ssn(key, m))
        .when(whole(PHONE), _phone(key, m))
        .when(whole(CARD), _card(key, m))
        .otherwise(_secret(key, m))
    )


def pseudonymised(docs: DataFrame, key: str, text: str = "text", count_as: str = "n_pseudonyms") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and their number in the new column ``count_as``."""
    if count_as.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input already has a column {count_as}")
    own = columns_named(docs, "pii_", "pattern", "gaps", "found", "fresh")
    pattern, gaps, found, fresh = own["pattern"], own["gaps"], own["found"], own["fresh"]
    # Only texts with a digit or an @ are searched; all others pass untouched.
    may = F.col(text).rlike("[0-9@]")
    found_in = docs.withColumn(pattern, F.when(may, _search_pattern(F.col(text)))).withColumns(
        {
            found: F.when(may, F.regexp_extract_all(text, F.col(pattern), F.lit(0))),
            gaps: F.when(may, F.split(text, F.col(pattern), -1)),
        }
    )
    changed = found_in.withColumn(
        fresh, F.when(F.size(found) > 0, F.transform(found, lambda m: pseudonym(key, m)))
    )
    pieces = F.transform(
        gaps,
        lambda gap, i: F.concat(gap, F.coalesce(F.get(fresh, i), F.get(found, i), F.lit(""))),
    )
    count = F.coalesce(F.size(F.filter(fresh, lambda x: x.isNotNull())), F.lit(0))
    out = changed.withColumns(
        {
            count_as: F.when(F.col(fresh).isNotNull(), count).otherwise(0).cast("long"),
            text: F.when(F.col(fresh).isNotNull(), F.array_join(pieces, "")).otherwise(F.col(text)),
        }
    )
    return out.drop(pattern, gaps, found, fresh)
