"""Users, posts, hashtags and links as node tables, their relations as edge tables.

A pattern over the graph is a join on an edge table. Keys are normalised once: a
user is one long id whether they posted or were mentioned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.literals import expanded_urls, zip_mentions
from ..functions.topics import topic_columns
from ..functions.urls import contains_video_url
from ..functions.values import time_key
from ..schema import COUNTERS

GRAPH_TABLES = (
    "tweets",
    "users",
    "hashtags",
    "links",
    "posts",
    "mentions",
    "tags",
    "tweet_links",
)

# Fixed value: the type whose text is the retweeted one.
PURE_RETWEET = "retweeted_tweet_without_comment"

TWEET_PROPERTIES = ("text", "date", "tweet_type", *COUNTERS, *topic_columns())
USER_PROPERTIES = (
    "screen_name",
    "description",
    "lang",
    *COUNTERS,
    "verified",
    "profile_pic_url",
    "profile_banner_url",
    "display_name",
    "date_first_tweet",
    "account_creation_date",
    "cat",
)


@dataclass(frozen=True)
class Graph:
    tweets: DataFrame
    users: DataFrame
    hashtags: DataFrame
    links: DataFrame
    posts: DataFrame
    mentions: DataFrame
    tags: DataFrame
    tweet_links: DataFrame


def effective_text(tweet_type: str = "tweet_type") -> Column:
    """A pure retweet carries the retweeted text, everything else its own."""
    retweeted = F.col(tweet_type).eqNullSafe(PURE_RETWEET)
    return F.when(retweeted, F.col("rt_text")).otherwise(F.col("text"))


def _number(digits: str) -> Column:
    return F.lit(digits).cast("decimal(38,0)")


def _place(date: Column, tie: Column) -> Column:
    """Position in time as one decimal; a missing date comes before all others."""
    return F.coalesce(time_key(date, tie), _number("-2" + "0" * 37))


# added to the place of an author's row and taken from that of a mention, so that any author ranks above all mentions
_AUTHOR = "45" + "0" * 36


def latest(rows: DataFrame, key: str, rank: Column, ties: Sequence[Column]) -> DataFrame:
    """The row of each ``key`` with the largest decimal ``rank``; among equal ranks the first by ``ties``.

    Only key and rank are aggregated, which keeps the hash aggregate and its
    map-side combine. The rows then join on key and rank together, so the rows of a
    hot key spread out.
    """
    ranked = rows.withColumn("_rank", rank)
    best = ranked.groupBy(key).agg(F.max("_rank").alias("_rank"))
    among = Window.partitionBy(key, "_rank").orderBy(*ties)
    return (
        ranked.join(best, [key, "_rank"])
        .withColumn("_nth", F.row_number().over(among))
        .filter("_nth = 1")
        .select(*rows.columns)
    )


def tweet_rows(cohort: DataFrame) -> DataFrame:
    """What each row says of its post."""
    return cohort.withColumn("text", effective_text()).select("tweetid", *TWEET_PROPERTIES)


def latest_tweets(rows: DataFrame) -> DataFrame:
    """One row per post: the latest; the values themselves break a tie."""
    place = _place(F.col("date"), F.lit(0))
    return latest(rows, "tweetid", place, [F.desc(c) for c in TWEET_PROPERTIES])


def author_rows(cohort: DataFrame) -> DataFrame:
    """What each row says of its author, and when: ``_author, _date, _tweetid, _pos``."""
    return cohort.select(
        "userid",
        *USER_PROPERTIES,
        F.lit(True).alias("_author"),
        F.col("date").alias("_date"),
        F.col("tweetid").alias("_tweetid"),
        F.lit(None).cast("int").alias("_pos"),
    )


def mentioned_rows(cohort: DataFrame) -> DataFrame:
    """What each mention says of a user: only a name."""
    return mention_pairs(cohort).select(
        "userid",
        "screen_name",
        F.lit(False).alias("_author"),
        F.col("date").alias("_date"),
        F.col("tweetid").alias("_tweetid"),
        F.col("pos").alias("_pos"),
    )


def user_rows(cohort: DataFrame) -> DataFrame:
    return author_rows(cohort).unionByName(mentioned_rows(cohort), allowMissingColumns=True)


def latest_users(rows: DataFrame) -> DataFrame:
    """One row per user: what their latest post says, else the name of their first mention."""
    place = _place(F.col("_date"), F.col("_tweetid"))
    rank = F.when(F.col("_author"), place + _number(_AUTHOR)).otherwise(-place - _number(_AUTHOR))
    mentioned = F.when(~F.col("_author"), F.col("screen_name"))
    ties = [F.asc("_pos"), mentioned.asc(), *[F.desc(c) for c in USER_PROPERTIES]]
    return latest(rows, "userid", rank, ties)


def tweet_nodes(cohort: DataFrame) -> DataFrame:
    """One row per post. The latest row wins; the values themselves break a tie."""
    return latest_tweets(tweet_rows(cohort))


def user_nodes(cohort: DataFrame) -> DataFrame:
    """One row per author, from their latest post."""
    return latest_users(author_rows(cohort)).select("userid", *USER_PROPERTIES)


def mention_pairs(cohort: DataFrame) -> DataFrame:
    """``(tweetid, date, pos, userid, screen_name)``, one row per mention in a post."""
    # outer, since a plain explode evaluates the pairing once more to drop empty arrays
    pairs = F.posexplode_outer(zip_mentions(F.col("mentionid"), F.col("mentionsn")))
    rows = cohort.select("tweetid", "date", pairs.alias("pos", "mention"))
    return rows.filter(F.col("mention").isNotNull()).select(
        "tweetid",
        "date",
        "pos",
        F.col("mention.id").cast("bigint").alias("userid"),
        F.col("mention.name").alias("screen_name"),
    )


def stub_users(cohort: DataFrame) -> DataFrame:
    """Mentioned users who never posted: only a name, the first one seen."""
    rows = user_rows(cohort)
    return latest_users(rows).filter(~F.col("_author")).select("userid", "screen_name")


def posts(cohort: DataFrame) -> DataFrame:
    return cohort.select("userid", "tweetid").distinct()


def tags(cohort: DataFrame) -> DataFrame:
    rows = cohort.select(F.explode("hashtag").alias("name"), "tweetid")
    named = rows.filter(F.col("name").isNotNull())
    return named.select(F.lower("name").alias("name"), "tweetid").distinct()


def hashtags(cohort: DataFrame) -> DataFrame:
    return tags(cohort).select("name").distinct()


def mentions(cohort: DataFrame) -> DataFrame:
    return mention_pairs(cohort).select("tweetid", "userid").distinct()


def tweet_links(cohort: DataFrame) -> DataFrame:
    rows = cohort.select("tweetid", F.explode_outer(expanded_urls(F.col("urls_list"))).alias("name"))
    return rows.filter(F.col("name").isNotNull()).distinct()


def links(cohort: DataFrame) -> DataFrame:
    return tweet_links(cohort).select("name").distinct()


def build_graph(cohort: DataFrame) -> Graph:
    """Node and edge tables of parsed cohort rows.

    Each table is its own scan of the columns it needs; store ``cohort`` as parquet
    first, and write the result with ``sources.write_graph``.
    """
    return Graph(
        tweets=tweet_nodes(cohort),
        users=latest_users(user_rows(cohort)).select("userid", *USER_PROPERTIES),
        hashtags=hashtags(cohort),
        links=links(cohort),
        posts=posts(cohort),
        mentions=mentions(cohort),
        tags=tags(cohort),
        tweet_links=tweet_links(cohort),
    )


def user_edges(graph: Graph, relation: str = "any") -> DataFrame:
    """``(userid, tweetid)``: ``posted`` edges, or ``any`` for posts and mentions.

    ``any`` keeps one row per edge, so a post that mentions its own author counts
    twice for them.
    """
    posted = graph.posts.select("userid", "tweetid")
    if relation == "posted":
        return posted
    if relation == "any":
        return posted.unionByName(graph.mentions.select("userid", "tweetid"))
    raise ValueError(f"unknown relation {relation!r}")


def user_tweets(graph: Graph, relation: str = "any", columns: list[str] | None = None) -> DataFrame:
    """Posts of each user, one row per edge."""
    tweets = graph.tweets if columns is None else graph.tweets.select("tweetid", *columns)
    return user_edges(graph, relation).join(tweets, "tweetid")


def user_tweets_any(graph: Graph) -> DataFrame:
    return user_tweets(graph, "any")


def user_tweets_posted(graph: Graph) -> DataFrame:
    return user_tweets(graph, "posted")


def user_hashtags(graph: Graph, relation: str = "any") -> DataFrame:
    """User to post to hashtag, one row per path."""
    return user_edges(graph, relation).join(graph.tags, "tweetid").select(
        "userid", "tweetid", F.col("name").alias("hashtag")
    )


def user_links(graph: Graph) -> DataFrame:
    """User to posted post to link, video links only. The filter runs before the join."""
    shared = graph.tweet_links.filter(contains_video_url(F.col("name")))
    return graph.posts.join(shared, "tweetid").select(
        "userid", "tweetid", F.col("name").alias("video_url")
    )


def posted_text(graph: Graph) -> DataFrame:
    """``(tweetid, text, lang)`` of every posted post, with its author's language.

    Languages join the narrow edges first, so no text moves by user.
    """
    languages = graph.posts.join(graph.users.select("userid", "lang"), "userid")
    return languages.join(graph.tweets.select("tweetid", "text"), "tweetid").select("tweetid", "text", "lang")
