"""The profile record: 52 typed fields, and the function that conforms any frame to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The sentinel, status words and source ids that appear in the data.
MISSING = "-"
ENDED, UPCOMING, ACTIVE = "ended", "upcoming", "active"
SOURCES = (
    "icodrops",
    "icobazaar",
    "icobench",
    "trackico",
    "tokentops",
    "icomarks",
    "icoratings",
)

# Lower number wins when two sources disagree on a field.
# The sources in the order in which they are read.
SOURCE_ORDER = ("icodrops", "icobench", "icomarks", "icoratings", "tokentops", "trackico", "icobazaar")
SOURCE_PRIORITY = {
    "icomarks": 0,
    "tokentops": 1,
    "trackico": 2,
    "icoratings": 3,
    "icodrops": 4,
    "icobench": 5,
    "icobazaar": 6,
}

# Field names by type group.
IDENTITY = ("source", "name", "ticker", "ico_url")
DESCRIPTIVE = (
    "description",
    "standart",
    "platform",
    "accepted_currencies",
    "status",
    "country",
    "countries_restricted",
    "raise_goal",
    "raised",
    "soft_cap",
    "hard_cap",
    "pre_ico_token_price",
    "ico_token_price",
)
DATES = ("pre_ico_start", "pre_ico_end", "ico_start", "ico_end")
FLAGS = ("kyc", "whitelist")
LINKS = (
    "whitepaper",
    "web_page",
    "github_page",
    "telegram_page",
    "medium_page",
    "linkedin_page",
    "twitter_page",
    "instagram_page",
    "facebook_page",
    "logo",
    "slack_page",
    "youtube_page",
    "reddit_page",
    "btc_page",
)
COUNTERS = (
    "teleg_subs_count",
    "btc_avg_activ",
    "btc_num_comments",
    "rdt_comment_count",
    "rdt_post_count",
    "rdt_usr_avg_karma",
)
SCORES = (
    "website_overall_rating",
    "roi_score",
    "hype_score",
    "risk_score",
    "user_review_score",
    "ico_profile_score",
    "vision_score",
    "team_score",
    "product_score",
)

_TYPE_OF_GROUP = (
    (IDENTITY + DESCRIPTIVE + LINKS, T.StringType()),
    (DATES, T.DateType()),
    (FLAGS, T.BooleanType()),
    (COUNTERS, T.LongType()),
    (SCORES, T.DoubleType()),
)
FIELD_TYPES: dict[str, T.DataType] = {
    name: dtype for names, dtype in _TYPE_OF_GROUP for name in names
}
FIELDS: tuple[str, ...] = tuple(FIELD_TYPES)
PROFILE_SCHEMA = T.StructType([T.StructField(f, FIELD_TYPES[f]) for f in FIELDS])
RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])

# Column order of CSV snapshots.
CSV_FIELDS = (
    "accepted_currencies",
    "btc_avg_activ",
    "btc_num_comments",
    "btc_page",
    "countries_restricted",
    "country",
    "description",
    "facebook_page",
    "github_page",
    "hard_cap",
    "hype_score",
    "ico_end",
    "ico_token_price",
    "ico_profile_score",
    "ico_start",
    "instagram_page",
    "kyc",
    "linkedin_page",
    "logo",
    "medium_page",
    "name",
    "website_overall_rating",
    "platform",
    "pre_ico_end",
    "pre_ico_token_price",
    "pre_ico_start",
    "product_score",
    "ico_url",
    "raised",
    "raise_goal",
    "rdt_usr_avg_karma",
    "rdt_comment_count",
    "rdt_post_count",
    "reddit_page",
    "risk_score",
    "roi_score",
    "slack_page",
    "soft_cap",
    "source",
    "status",
    "team_score",
    "teleg_subs_count",
    "telegram_page",
    "ticker",
    "standart",
    "twitter_page",
    "user_review_score",
    "vision_score",
    "web_page",
    "whitelist",
    "whitepaper",
    "youtube_page",
)


def conform(df: DataFrame, schema: T.StructType = PROFILE_SCHEMA, keep: tuple[str, ...] = ()) -> DataFrame:
    """Give ``df`` exactly the columns of ``schema``: absent ones are NULL, others are cast.

    A text that does not parse as the target type becomes NULL instead of failing the job.
    Columns named in ``keep`` (record ids, ranks) are carried in front.
    """
    have = set(df.columns)

    def field(f: T.StructField) -> Column:
        value = F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
        return value.alias(f.name)

    return df.select(*keep, *[field(f) for f in schema.fields if f.name not in keep])
