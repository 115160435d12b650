"""Country names to three-letter codes."""

from __future__ import annotations

import json
import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityloom.functions.text import let, squash, strip

# Names the sources use that are neither English display names nor codes.
COUNTRY_ALIASES = {
    "Bolivia, Plurinational State of": "BOL",
    "Brunei Darussalam": "BRN",
    "Congo": "COG",
    "Congo, the Democratic Republic of the": "COD",
    "Czech Republic": "CZE",
    "Dubai": "ARE",
    "Falkland Islands (Malvinas)": "FLK",
    "Heard Island and McDonald Islands": "HMD",
    "Holy See (Vatican City State)": "VAT",
    "Hong Kong": "HKG",
    "Iran, Islamic Republic of": "IRN",
    "Korea, Democratic People's Republic of": "PRK",
    "Korea, Republic of": "KOR",
    "Kosovo": "XKX",
    "Lao People's Democratic Republic": "LAO",
    "Libyan Arab Jamahiriya": "LBY",
    "Macao": "MAC",
    "Macedonia, the former Yugoslav Republic of": "MKD",
    "Micronesia, Federated States of": "FSM",
    "Moldova, Republic of": "MDA",
    "Myanmar": "MMR",
    "Netherlands Antilles": "ANT",
    "Palestinian Territory, Occupied": "PSE",
    "Pitcairn": "PCN",
    "Russian Federation": "RUS",
    "Saint Helena, Ascension and Tristan da Cunha": "SHN",
    "Saint Martin (French part)": "MAF",
    "Saint Vincent and the Grenadines": "VCT",
    "South Georgia and the South Sandwich Islands": "SGS",
    "Swaziland": "SWZ",
    "Syrian Arab Republic": "SYR",
    "Taiwan, Province of China": "TWN",
    "Tanzania, United Republic of": "TZA",
    "UK": "GBR",
    "United States Minor Outlying Islands": "UMI",
    "Venezuela, Bolivarian Republic of": "VEN",
    "Virgin Islands": "VGB",
    "Virgin Islands (British)": "VGB",
    "Virgin Islands (U.S.)": "VIR",
    "Virgin Islands, British": "VGB",
    "Virgin Islands, U.S.": "VIR",
    "namely Iran": "IRN",
    "the Peoples Republic of China": "CHN",
    # Names of the country standard and official names that no rule below derives.
    "Argentine Republic": "ARG",
    "Cabo Verde": "CPV",
    "Cape Verde": "CPV",
    "Czechia": "CZE",
    "Democratic People's Republic of Korea": "PRK",
    "Democratic Republic of the Congo": "COD",
    "East Timor": "TLS",
    "Eswatini": "SWZ",
    "French Republic": "FRA",
    "Hellenic Republic": "GRC",
    "Holy See": "VAT",
    "Hong Kong SAR": "HKG",
    "Italian Republic": "ITA",
    "Ivory Coast": "CIV",
    "Kyrgyz Republic": "KGZ",
    "Lebanese Republic": "LBN",
    "Macao SAR": "MAC",
    "North Macedonia": "MKD",
    "Portuguese Republic": "PRT",
    "Republic of China": "TWN",
    "Republic of Korea": "KOR",
    "Republic of the Congo": "COG",
    "Sint Maarten (Dutch part)": "SXM",
    "Slovak Republic": "SVK",
    "Swiss Confederation": "CHE",
    "Timor-Leste": "TLS",
    "Turkey": "TUR",
    "Türkiye": "TUR",
    "United Kingdom of Great Britain and Northern Ireland": "GBR",
    "United Mexican States": "MEX",
    "United States of America": "USA",
    "Viet Nam": "VNM",
    "Vietnam": "VNM",
}
# "Kingdom of Norway" is looked up as "Norway" where the whole name is not known.
OFFICIAL_FORM = (
    r"^(THE )?((ARAB|BOLIVARIAN|CO-OPERATIVE|COOPERATIVE|DEMOCRATIC|EASTERN|FEDERAL|FEDERATIVE|GRAND|HASHEMITE|INDEPENDENT"
    r"|ISLAMIC|ORIENTAL|PEOPLE'S|PLURINATIONAL|SOCIALIST|UNITED) )*"
    r"(COMMONWEALTH|DUCHY|EMIRATE|FEDERATION|KINGDOM|PRINCIPALITY|REPUBLIC|STATE|STATES|SULTANATE|UNION) OF (THE )?"
)
UNSPECIFIED = ("Unspecified",)

_ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ’"
_PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUY'"


def country_key(name: Column) -> Column:
    """Spelling under which a country is looked up: upper case, no accents, ``AND``, ``SAINT``."""
    key = F.translate(F.upper(squash(name)), _ACCENTED, _PLAIN)
    key = F.regexp_replace(key, r"\bST\. ", "SAINT ")
    key = F.regexp_replace(key, " & ", " AND ")
    return F.regexp_replace(key, r"^[.,]+|[.,]+$", "")


def plain_key(name: str) -> str:
    """``country_key`` of a constant, on the driver."""
    key = re.sub(r"\s+", " ", name).strip().upper().translate(str.maketrans(_ACCENTED, _PLAIN))
    key = re.sub(r"\bST\. ", "SAINT ", key).replace(" & ", " AND ")
    return re.sub(r"^[.,]+|[.,]+$", "", key)


def country_table(spark: SparkSession) -> dict[str, str]:
    """Key -> code, constants of the program: English names and two-letter codes by the JVM's
    locale rule, and the aliases above, which win.  Under 1,000 entries; no Spark job.  A caller
    with a table of its own passes that instead wherever a table is asked for.  (Three-letter
    words pass unchanged.)"""
    locale, table = spark._jvm.java.util.Locale, {}
    for two in locale.getISOCountries():
        place = locale("", two)
        table[plain_key(place.getDisplayCountry(locale.ENGLISH))] = place.getISO3Country()
        table[two] = place.getISO3Country()
    return table | {plain_key(name): code for name, code in COUNTRY_ALIASES.items()}


def country_dim(spark: SparkSession, table: dict[str, str] | None = None) -> DataFrame:
    """``(key, code)`` rows of a country table."""
    return spark.createDataFrame(sorted((table or country_table(spark)).items()), "key string, code string")


_BUCKETS = 256


def dim_map(table: dict[str, str]) -> Column:
    """A table of constants for look-ups inside a row: an array of small maps, chosen by the key's CRC-32."""
    buckets: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    for key, code in table.items():
        buckets[zlib.crc32(key.encode()) % _BUCKETS][key] = code
    return F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False)), "array<map<string,string>>")


def code_at(codes: Column, key: Column) -> Column:
    """The code of a key in a ``dim_map``, NULL where it has none."""
    return let(key, lambda k: F.try_element_at(F.get(codes, (F.crc32(k) % _BUCKETS).cast("int")), k))


def _short_form(key: Column) -> Column:
    return F.regexp_replace(key, OFFICIAL_FORM, "")


def _bare(name: Column) -> Column:
    return F.regexp_replace(strip(name), r"^[.,]+|[.,]+$", "")


def _resolved(bare: Column, found: Column, keep_unknown: bool, unspecified: tuple[str, ...]) -> Column:
    """The code of one bare name, given what the table holds for it."""
    known = F.coalesce(found, F.when(F.length(bare) == 3, bare))
    other = F.nullif(bare, F.lit("")) if keep_unknown else F.lit(None).cast("string")
    return F.when(~F.upper(bare).isin(*[u.upper() for u in unspecified]), F.coalesce(known, other))


def _one_code(name: Column, codes: Column, keep_unknown: bool, unspecified: tuple[str, ...]) -> Column:
    """The code of one name; each spelling of it is made once."""
    found = lambda bare: let(
        country_key(bare), lambda key: F.coalesce(code_at(codes, key), code_at(codes, _short_form(key)))
    )
    return let(_bare(name), lambda bare: _resolved(bare, found(bare), keep_unknown, unspecified))


def _joined(n: Column, pair_at, single_at, comma: bool) -> Column:
    """The codes of pieces 0..n-1 in one text.  Where pieces i and i+1 are one name that holds a
    comma, ``pair_at(i)`` is its code and piece i+1 is passed over."""

    def add(acc: Column, i: Column) -> Column:
        take_pair = pair_at(i).isNotNull() if comma else F.lit(False)
        done = F.when(i < acc["until"], acc["codes"]).when(take_pair, F.concat(acc["codes"], F.array(pair_at(i)))).otherwise(
            F.concat(acc["codes"], F.filter(F.array(single_at(i)), F.isnotnull))
        )
        until = F.when((i >= acc["until"]) & take_pair, i + 2).otherwise(acc["until"])
        return F.struct(done.alias("codes"), until.alias("until"))

    start = F.struct(F.array().cast("array<string>").alias("codes"), F.lit(0).alias("until"))
    listed = F.aggregate(F.sequence(F.lit(0), n - 1), start, add, lambda acc: F.array_join(acc["codes"], ", "))
    return F.nullif(listed, F.lit(""))


def _pieces(value: Column, separator: str) -> Column:
    return F.split(value, F.concat(F.lit("\\Q"), F.lit(separator), F.lit("\\E")))


def to_codes(
    value: Column,
    codes: Column,
    separator: str | None = ",",
    keep_unknown: bool = True,
    unspecified: tuple[str, ...] = UNSPECIFIED,
) -> Column:
    """A text of one or more countries -> codes joined with ``, ``; NULL if none is named.

    With a separator of comma, names that hold a comma themselves (``Korea, Republic of``)
    are tried first: each piece together with the one after it.
    """
    if separator is None:
        return _one_code(value, codes, keep_unknown, unspecified)

    def coded(pieces: Column) -> Column:
        def entry(piece: Column, i: Column) -> Column:
            both = F.concat(piece, F.lit(separator), F.get(pieces, i + 1))
            pair = code_at(codes, country_key(both)) if separator == "," else F.lit(None).cast("string")
            return F.struct(_one_code(piece, codes, keep_unknown, unspecified).alias("single"), pair.alias("pair"))

        return F.transform(pieces, entry)

    def listed(x: Column) -> Column:
        return _joined(F.size(x), lambda i: F.get(x, i)["pair"], lambda i: F.get(x, i)["single"], separator == ",")

    return F.when(value.isNotNull(), let(let(_pieces(value, separator), coded), listed))


def convert_countries(df: DataFrame, codes: Column, single: str = "country", several: str = "countries_restricted") -> DataFrame:
    """Both country columns of a profile table; map-only."""
    return df.withColumn(single, to_codes(F.col(single), codes, separator=None)).withColumn(
        several, to_codes(F.col(several), codes, separator=",")
    )


def convert_lists_by_join(
    df: DataFrame,
    key: str,
    column: str,
    dim: DataFrame,
    separator: str = ",",
    keep_unknown: bool = True,
    unspecified: tuple[str, ...] = UNSPECIFIED,
) -> DataFrame:
    """The same through joins, for a dimension too large to inline: ``(key, column)``.

    ``key`` is unique.  Pieces are grouped back per key; one row's list is small, so the sort
    of its pieces is too.  A NULL list stays NULL.
    """
    rows = df.select(F.col(key).alias("_k"), _pieces(F.col(column), separator).alias("_p"))
    pieces = rows.select("_k", F.posexplode_outer("_p").alias("i", "piece"), F.col("_p")).select(
        "_k",
        "i",
        _bare(F.col("piece")).alias("bare"),
        country_key(F.concat("piece", F.lit(separator), F.get("_p", F.col("i") + 1))).alias("two"),
    )
    named = lambda name, code: dim.select(F.col("key").alias(name), F.col("code").alias(code))
    keyed = pieces.withColumn("one", country_key(F.col("bare")))
    coded = (
        keyed.withColumn("short", _short_form(F.col("one")))
        .join(named("one", "one_code"), "one", "left")
        .join(named("short", "short_code"), "short", "left")
        .join(named("two", "two_code"), "two", "left")
    )
    # Names are resolved before they meet in a list, each once.
    single = _resolved(F.col("bare"), F.coalesce("one_code", "short_code"), keep_unknown, unspecified)
    entry = F.struct("i", single.alias("single"), F.col("two_code").alias("pair"))
    lists = coded.groupBy("_k").agg(F.array_sort(F.collect_list(F.when(F.col("i").isNotNull(), entry))).alias("x"))
    at = lambda i: F.get("x", i)
    value = F.when(F.size("x") > 0, _joined(F.size("x"), lambda i: at(i)["pair"], lambda i: at(i)["single"], separator == ","))
    return lists.select(F.col("_k").alias(key), value.alias(column))
