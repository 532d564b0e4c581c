"""Ranking users and cutting the cohort out of the facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.literals import has_items, video_urls
from ..functions.text import split_raw_list
from ..functions.values import format_date, parse_date, to_id

# The study's cohort rule.
MIN_TWEETS, MAX_TWEETS, COHORT_SIZE = 500, 800, 50


def _hashtag_count(mode: str) -> Column:
    if mode == "parsed":
        items = F.col("hashtag")
    elif mode == "literal":
        items = split_raw_list(F.col("hashtag"))
    else:
        raise ValueError(f"unknown hashtag mode {mode!r}")
    return F.sum(F.when(items.isNotNull(), F.size(items)).otherwise(0))


def _shares_video(urls: str = "urls_list") -> Column:
    return has_items(video_urls(F.col(urls)))


def having_between(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return df.filter(F.col(column).between(low, high))


def tweets_per_user(tweets: DataFrame) -> DataFrame:
    return tweets.groupBy("userid").agg(F.count("*").alias("tweets_count"))


def hashtags_per_user(tweets: DataFrame, mode: str = "parsed") -> DataFrame:
    """Hashtags used by each user who used any.

    ``parsed`` counts the elements of an array column. ``literal`` counts the pieces
    of the raw text as the source study did, so an empty list counts one.
    """
    counts = tweets.groupBy("userid").agg(_hashtag_count(mode).alias("hashtags_count"))
    return counts.filter(F.col("hashtags_count") > 0)


def video_shares_per_user(tweets: DataFrame) -> DataFrame:
    """Posts (not links) of each user with at least one video link."""
    return (
        tweets.filter(_shares_video()).groupBy("userid").agg(F.count("*").alias("yt_shares_count"))
    )


def user_counts(tweets: DataFrame, hashtag_mode: str = "parsed") -> DataFrame:
    """The three counts in one aggregate: one scan, one shuffle, no join."""
    return tweets.groupBy("userid").agg(
        F.count("*").alias("tweets_count"),
        _hashtag_count(hashtag_mode).alias("hashtags_count"),
        F.count_if(_shares_video()).alias("yt_shares_count"),
    )


def rank_users(
    tweets: DataFrame,
    low: int = MIN_TWEETS,
    high: int = MAX_TWEETS,
    n: int = COHORT_SIZE,
    hashtag_mode: str = "parsed",
) -> DataFrame:
    """Top ``n`` users by posts, video shares and hashtags who have some of each."""
    qualified = having_between(user_counts(tweets, hashtag_mode), "tweets_count", low, high)
    return (
        qualified.filter((F.col("hashtags_count") > 0) & (F.col("yt_shares_count") > 0))
        .orderBy(
            F.desc("tweets_count"), F.desc("yt_shares_count"), F.desc("hashtags_count"), "userid"
        )
        .limit(n)
    )


def restrict_to(tweets: DataFrame, cohort: DataFrame) -> DataFrame:
    """Facts of the cohort's users with the cohort's counts.

    The cohort is narrow and a limit has cut it: Spark's own size check broadcasts it.
    """
    return tweets.join(cohort, "userid")


def enrich_profiles(tweets: DataFrame, users: DataFrame) -> DataFrame:
    """Add the profile of the screen name. A name with two profiles doubles its rows."""
    matched = tweets.join(users, tweets["screen_name"] == users["user"], "left")
    return matched.drop(users["user"])


def with_topics(tweets: DataFrame, topics: DataFrame) -> DataFrame:
    """Inner join on the post."""
    return tweets.join(topics, "tweetid")


def normalise_dates(df: DataFrame) -> DataFrame:
    """Reply id as long, the two profile dates parsed and written back in one format."""
    return df.withColumns(
        {
            "reply_statusid": to_id(F.col("reply_statusid")),
            "date_first_tweet": format_date(parse_date(F.col("date_first_tweet"))),
            "account_creation_date": format_date(parse_date(F.col("account_creation_date"))),
        }
    )
