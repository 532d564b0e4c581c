"""Per-user counts, bounds and time series, for all users at once.

One user is a filter on the result (``for_user``), which reaches the scan of a
stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import time_key

# The post types of the overview and the profile counters.
TWEET_TYPES = ("original", "reply", "quoted_tweet", "retweeted_tweet_without_comment")
PROFILE_COUNTERS = ("followers_count", "friends_count", "favourites_count")
# Moderation categories and what they say.
CATEGORY_LABELS = {
    "NMYT": "never shared a moderated video",
    "MYT": "shared moderated videos",
}
UNKNOWN_CATEGORY = "error: category unknown"
TOP_HASHTAGS = 20


def for_user(df: DataFrame, screen_name: str) -> DataFrame:
    return df.filter(F.col("screen_name") == screen_name)


def monitored_users(users: DataFrame) -> DataFrame:
    """Users with a profile; a mentioned-only user has no ``verified`` flag."""
    return users.filter(F.col("verified").isNotNull()).select("userid", "screen_name")


def user_bio(users: DataFrame) -> DataFrame:
    """Description per screen name, from the first user of that name who has one."""
    return users.groupBy("screen_name").agg(
        F.min_by(
            "description", F.when(F.col("description").isNotNull(), F.col("userid"))
        ).alias("description")
    )


def user_category(users: DataFrame) -> DataFrame:
    """Moderation category of each user who has one, with its message."""
    label = F.lit(UNKNOWN_CATEGORY)
    for code, text in CATEGORY_LABELS.items():
        label = F.when(F.col("cat") == code, text).otherwise(label)
    return users.filter(F.col("cat").isNotNull()).select(
        "userid", "cat", label.alias("category_label")
    )


def collect_names(users: DataFrame, column: str = "screen_name") -> DataFrame:
    """Distinct names in order, as rows: a list of any length never sits in one cell."""
    return users.select(column).distinct().orderBy(column)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def tweet_type_counts(
    user_tweets: DataFrame, wide: bool = False, types: Sequence[str] = TWEET_TYPES
) -> DataFrame:
    """Posts per user and type; ``wide`` gives one column per known type, 0 where none."""
    if not wide:
        return user_tweets.groupBy("userid", "tweet_type").agg(F.count("*").alias("n_tweets"))
    return user_tweets.groupBy("userid").agg(
        *[F.count_if(F.col("tweet_type") == name).alias(f"n_{name}") for name in types]
    )


def hashtag_counts(user_hashtags: DataFrame) -> DataFrame:
    return user_hashtags.groupBy("userid", "hashtag").agg(F.count("*").alias("count_hashtag"))


def top_hashtags(user_hashtags: DataFrame, n: int = TOP_HASHTAGS) -> DataFrame:
    """Top ``n`` hashtags of each user; equal counts in name order.

    The counts of a hot user are spread over all tasks and each keeps its own top
    ``n`` before the rank shuffles them (the plan's group limit).
    """
    order = Window.partitionBy("userid").orderBy(F.desc("count_hashtag"), "hashtag")
    return (
        hashtag_counts(user_hashtags)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
    )


def date_bounds(df: DataFrame, by: Sequence[str] = ("userid",), date: str = "date") -> DataFrame:
    return df.groupBy(*by).agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def counter_delta(
    user_tweets: DataFrame, counters: Sequence[str] = PROFILE_COUNTERS, bounds: bool = False
) -> DataFrame:
    """First and last value of each counter in time order, and the change. One pass.

    ``bounds`` adds the first and last date from the same aggregate.
    """
    key = time_key(F.col("date"), F.col("tweetid"))
    ends = user_tweets.withColumn("_at", key).groupBy("userid").agg(
        *[F.min_by(c, "_at").alias(f"first_{c}") for c in counters],
        *[F.max_by(c, "_at").alias(f"last_{c}") for c in counters],
        *([F.min("date").alias("min_date"), F.max("date").alias("max_date")] if bounds else []),
    )
    return ends.withColumns(
        {f"delta_{c}": F.col(f"last_{c}") - F.col(f"first_{c}") for c in counters}
    )


def between_dates(df: DataFrame, column: str, low, high) -> DataFrame:
    """Both ends inclusive; bounds are values or columns."""
    return df.filter(F.col(column).between(low, high))


def default_range(
    df: DataFrame, kind: str = "full", by: str = "userid", date: str = "date"
) -> DataFrame:
    """Rows inside each user's preset range.

    ``full`` is first to last date; ``first`` is the first date only, the preset of
    the shared-video view.
    """
    if kind not in ("full", "first"):
        raise ValueError(f"unknown range kind {kind!r}")
    dated = df.filter(F.col(date).isNotNull())
    if kind == "full":
        return dated
    # a rank cuts each task's rows to the first date before they are shuffled
    order = Window.partitionBy(by).orderBy(date)
    return dated.withColumn("_rank", F.rank().over(order)).filter(F.col("_rank") == 1).drop("_rank")


def time_series(
    user_tweets: DataFrame, columns: Sequence[str], ordered: bool = True, date: str = "date"
) -> DataFrame:
    """Values over time per user. The sort is the last step, for the reader's sake."""
    series = user_tweets.select("userid", date, "tweetid", *columns)
    return series.orderBy("userid", date, "tweetid") if ordered else series
