"""Shared videos: who shared which, which are gone, and what the others are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import video_id
from ..functions.values import epoch_to_timestamp, to_count, to_whole_count
from .graph import Graph, user_links
from .metrics import between_dates
from .sentiment import SCORES

# The numeric columns of the metadata.
NUMERIC_METADATA = (
    "video_category",
    "video_view_count",
    "video_comment_count",
    "video_like_count",
    "video_dislike_count",
)


def typed_video_metadata(raw: DataFrame) -> DataFrame:
    """Publish date from epoch seconds, counts as doubles, tags as an array."""
    return raw.withColumns(
        {
            "video_publish_date": epoch_to_timestamp(F.col("video_publish_date")),
            **{name: to_count(F.col(name)) for name in NUMERIC_METADATA},
            "video_tags": F.split("video_tags", "[|]"),
        }
    )


def video_tweets(graph: Graph) -> DataFrame:
    """One row per shared video link: when, with what text and scores, which video."""
    texts = graph.tweets.select("tweetid", "date", "text", *SCORES)
    return (
        user_links(graph)
        .join(texts, "tweetid")
        .select(
            "userid",
            "tweetid",
            F.col("date").alias("tweet_sharing_date"),
            F.col("text").alias("tweet_text"),
            *SCORES,
            "video_url",
            video_id(F.col("video_url")).alias("video_id"),
        )
    )


def users_without_videos(users: DataFrame, links: DataFrame) -> DataFrame:
    """Users who shared no video link."""
    return users.join(links.select("userid").distinct(), "userid", "left_anti")


def distinct_video_ids(shares: DataFrame) -> DataFrame:
    return shares.select("userid", "video_id").distinct()


def distinct_videos(shares: DataFrame) -> DataFrame:
    """Different videos per user; links without a video id count as one."""
    return (
        distinct_video_ids(shares).groupBy("userid").agg(F.count("*").alias("distinct_videos"))
    )


def video_moderation(shares: DataFrame, metadata: DataFrame) -> DataFrame:
    """Per user: different videos shared, found in the metadata, and gone.

    The distinct runs before the join, so a video everybody shares meets the
    metadata once per user, not once per share.
    """
    known = metadata.select("video_id").distinct().withColumn("_found", F.lit(True))
    return (
        distinct_video_ids(shares)
        .join(known, "video_id", "left")
        .groupBy("userid")
        .agg(
            F.count("*").alias("distinct_videos"),
            F.count_if("_found").alias("found_videos"),
            F.count_if(F.col("_found").isNull()).alias("moderated_videos"),
        )
    )


def moderated_count(shares: DataFrame, metadata: DataFrame) -> DataFrame:
    return video_moderation(shares, metadata).select("userid", "moderated_videos")


def video_shares(shares: DataFrame, metadata: DataFrame) -> DataFrame:
    """Shares of videos that still have metadata."""
    return shares.join(metadata, "video_id")


def moderated_shares(shares: DataFrame, metadata: DataFrame) -> DataFrame:
    """Shares of videos without metadata; a link without a video id is one of them."""
    return shares.join(metadata.select("video_id").distinct(), "video_id", "left_anti")


def video_cards(shares: DataFrame, metadata: DataFrame, low=None, high=None) -> DataFrame:
    """What the video view shows per share, optionally inside a closed date range."""
    joined = video_shares(shares, metadata)
    if low is not None and high is not None:
        joined = between_dates(joined, "tweet_sharing_date", low, high)
    return joined.select(
        "userid",
        "tweetid",
        "video_id",
        "video_title",
        "channel_title",
        *[
            to_whole_count(F.col(name)).alias(name)
            for name in ("video_view_count", "video_comment_count", "video_like_count")
        ],
        "video_description",
        "tweet_sharing_date",
        *SCORES,
    )
