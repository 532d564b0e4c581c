"""Reports over the graph, for all users at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import metrics as mt
from ..operators import video as vd
from ..operators.graph import Graph, user_links, user_tweets


def overview_report(graph: Graph) -> DataFrame:
    """Bio and posts per type of every monitored user; 0 where a type is missing."""
    counts = mt.tweet_type_counts(user_tweets(graph, "any", ["tweet_type"]), wide=True)
    names = [c for c in counts.columns if c != "userid"]
    return (
        mt.monitored_users(graph.users)
        .join(mt.user_bio(graph.users), "screen_name", "left")
        .join(counts, "userid", "left")
        .fillna(0, names)
    )


def profile_report(graph: Graph) -> DataFrame:
    """Date bounds, first, last and change of the counters: one row per user, one pass."""
    rows = user_tweets(graph, "any", ["date", *mt.PROFILE_COUNTERS])
    return mt.counter_delta(rows, bounds=True)


def profile_series(graph: Graph, low=None, high=None) -> DataFrame:
    """Counters over time per user, optionally inside a closed range."""
    rows = user_tweets(graph, "any", ["date", *mt.PROFILE_COUNTERS])
    if low is not None and high is not None:
        rows = mt.between_dates(rows, "date", low, high)
    return mt.time_series(rows, mt.PROFILE_COUNTERS)


@dataclass(frozen=True)
class VideoReport:
    categories: DataFrame
    moderation: DataFrame
    without_videos: DataFrame
    cards: DataFrame


def video_report(graph: Graph, metadata: DataFrame) -> VideoReport:
    """Category, moderation counts, users without videos, and the cards first shown.

    The cards are those of each user's first sharing date among videos that still
    have metadata.
    """
    shares = vd.video_tweets(graph)
    shown = mt.default_range(
        vd.video_shares(shares, metadata.select("video_id")), "first", date="tweet_sharing_date"
    ).select(*shares.columns)
    return VideoReport(
        categories=mt.user_category(graph.users),
        moderation=vd.video_moderation(shares, metadata),
        without_videos=vd.users_without_videos(
            mt.monitored_users(graph.users), user_links(graph)
        ),
        cards=vd.video_cards(shown, metadata),
    )
