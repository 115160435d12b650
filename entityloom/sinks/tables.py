"""The six related tables: surrogate keys, fan-out and reload."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entityloom.session import staged
from entityloom.sinks.versions import write_version
from entityloom.sources.tables import jdbc_options

# The split of a profile over the related tables, by field group.
TARGET_TABLES: dict[str, tuple[str, ...]] = {
    "tokens": ("source", "name", "ticker", "ico_url", "description", "logo", "web_page", "whitepaper", "status"),
    "token_details": (
        "standart",
        "platform",
        "accepted_currencies",
        "pre_ico_start",
        "pre_ico_end",
        "ico_start",
        "ico_end",
        "raise_goal",
        "raised",
        "soft_cap",
        "hard_cap",
        "country",
        "countries_restricted",
        "pre_ico_token_price",
        "ico_token_price",
        "kyc",
        "whitelist",
    ),
    "scores": (
        "website_overall_rating",
        "roi_score",
        "hype_score",
        "risk_score",
        "user_review_score",
        "ico_profile_score",
        "vision_score",
        "team_score",
        "product_score",
    ),
    "social_pages": (
        "github_page",
        "medium_page",
        "linkedin_page",
        "twitter_page",
        "instagram_page",
        "facebook_page",
        "slack_page",
        "youtube_page",
        "telegram_page",
        "teleg_subs_count",
    ),
    "bitcointalk": ("btc_page", "btc_avg_activ", "btc_num_comments"),
    "subreddits": ("reddit_page", "rdt_comment_count", "rdt_post_count", "rdt_usr_avg_karma"),
}
PARENT_TABLE = "tokens"


def number_rows(df: DataFrame, *order: str, name: str = "token_id") -> DataFrame:
    """Add 1..n in ``order`` (which must be unique) without bringing all rows together.

    Rows are range-partitioned and sorted, staged with a per-partition row number, and
    shifted by the sizes of the partitions before; only those sizes, one row per
    partition, meet in one task.
    """
    row_id = F.monotonically_increasing_id()
    placed, _ = staged(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", row_id), "numbered")
    part, within = F.shiftrightunsigned("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(shifts), "_part")
    return numbered.select((F.col("_before") + within + 1).alias(name), *df.columns)


def fan_out(profiles: DataFrame, created_at: Column, tables: dict[str, tuple[str, ...]] = TARGET_TABLES) -> dict[str, DataFrame]:
    """One narrow frame per table out of numbered profiles; child tables carry ``token_id``."""
    out = {}
    for table, columns in tables.items():
        key = F.col("token_id").alias("id" if table == PARENT_TABLE else "token_id")
        out[table] = profiles.select(key, *columns, created_at.alias("created_at"))
    return out


def reload_folder(frames: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Replace the content of all tables at once: a new version, of which readers see all tables or none."""
    return write_version(frames, folder)


def reload_jdbc(frames: dict[str, DataFrame], url: str, batch: int = 100, **options: object) -> None:
    """Empty and load the tables of a database in batches; the tables keep their definition."""
    for table, df in frames.items():
        opts = jdbc_options(url, table, truncate="true", batchsize=batch, **options)
        df.write.format("jdbc").mode("overwrite").options(**opts).save()
