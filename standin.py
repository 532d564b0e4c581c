"""The driver tables presented as social posts, for the queries, bench and tests.

The definitions follow FIXTURES.md section 2. ``events`` plays the posts: 5 event
types as post types, ``props.k`` gives hashtags and mentions, topic and sentiment
weights are integers derived from the event id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.functions.topics import topic_columns
from postlark.operators.graph import Graph

WEIGHTS = ((3, 0), (5, 1), (7, 2), (9, 3), (11, 4))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def _name(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), col.cast("string"))


def _k() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("k")


def posts_table(spark, sf) -> DataFrame:
    """Posts without text."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("tweetid"),
        F.col("user_id").alias("userid"),
        _name("u", F.col("user_id")).alias("screen_name"),
        F.col("ts").alias("date"),
        F.col("event_type").alias("tweet_type"),
        F.col("value").alias("followers_count"),
        _k(),
    )


def tweets(spark, sf) -> DataFrame:
    """Posts with the text of the document of the same id."""
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("tweetid"), "lang", "text")
    return (
        posts_table(spark, sf)
        .join(texts, "tweetid", "left")
        .withColumn("lang", F.coalesce("lang", F.lit("und")))
    )


def _topic_columns(tweetid: Column) -> list[Column]:
    weights = [(tweetid * a + b) % 13 + 1 for a, b in WEIGHTS]
    total = sum(weights[1:], weights[0]).cast("double")
    return [
        F.when(tweetid % 50 == 0, 0.0).otherwise(w.cast("double") / total).alias(name)
        for name, w in zip(topic_columns(), weights)
    ]


def _sentiment_columns(tweetid: Column) -> list[Column]:
    p, u, n = (tweetid * 7) % 19 + 1, (tweetid * 5) % 17 + 1, (tweetid * 3) % 23 + 1
    total = (p + u + n).cast("double")
    names = ("sa_positive_score", "sa_neutral_score", "sa_negative_score")
    return [
        F.when(tweetid % 40 == 0, None).otherwise(w.cast("double") / total).alias(name)
        for name, w in zip(names, (p, u, n))
    ]


def _with_topics(df: DataFrame) -> DataFrame:
    """Add the topic columns. They repeat every 650 ids, so they come from 650 rows."""
    period = 13 * 50
    topics = df.sparkSession.range(period).select(
        F.col("id").alias("_id"), *_topic_columns(F.col("id"))
    )
    return df.join(F.broadcast(topics), F.col("tweetid") % period == F.col("_id")).drop("_id")


def tweet_topics(spark, sf) -> DataFrame:
    return _with_topics(table(spark, sf, "events").select(F.col("event_id").alias("tweetid")))


def tweet_sentiment(spark, sf) -> DataFrame:
    event = F.col("event_id")
    return table(spark, sf, "events").select(event.alias("tweetid"), *_sentiment_columns(event))


def posts(spark, sf) -> DataFrame:
    return posts_table(spark, sf).select("userid", "tweetid")


def mentions(spark, sf) -> DataFrame:
    return (
        posts_table(spark, sf).filter(F.col("k") % 3 == 0).select("tweetid", F.col("k").alias("userid"))
    )


def tags(spark, sf) -> DataFrame:
    rows = posts_table(spark, sf).filter(F.col("k") % 5 != 0)
    return rows.select(_name("k", F.col("k")).alias("name"), "tweetid")


def _link(page: Column, url: Column) -> Column:
    video = (page % 40).cast("string")
    form = page % 7
    return (
        F.when(form == 0, F.concat(F.lit("https://www.youtube.com/watch?v=v"), video, F.lit("&feature=feedu")))
        .when(form == 1, F.concat(F.lit("http://youtu.be/v"), video))
        .when(form == 2, F.concat(F.lit("https://www.youtube.com/embed/v"), video))
        .when(form == 3, F.concat(F.lit("https://www.youtube.com/shorts/v"), video))
        .when(form == 4, F.concat(F.lit("http://www.youtube.com/v/v"), video, F.lit("?version=3")))
        .when(form == 5, F.lit("https://www.youtube.com/channel/abc"))
        .otherwise(url)
    )


def link_urls(spark, sf) -> DataFrame:
    return table(spark, sf, "pages").select(
        "page_id", _link(F.col("page_id"), F.col("url")).alias("name")
    )


def tweet_links(spark, sf) -> DataFrame:
    linked = table(spark, sf, "events").select(
        F.col("event_id").alias("tweetid"), (F.col("event_id") % 1000).alias("page_id")
    )
    return linked.join(link_urls(spark, sf), "page_id").select("tweetid", "name")


def video_metadata(spark, sf) -> DataFrame:
    page = F.col("page_id")
    return (
        table(spark, sf, "pages")
        .filter(page % 40 % 4 != 0)
        .select(
            _name("v", page % 40).alias("video_id"),
            ((page % 40).cast("double") * 100).alias("video_view_count"),
        )
        .distinct()
    )


def full_video_metadata(spark, sf) -> DataFrame:
    """Metadata as delivered: everything text, epoch seconds, tags in one string."""
    n = F.col("video_view_count").cast("bigint")
    return video_metadata(spark, sf).select(
        "video_id",
        F.concat(F.lit("title "), "video_id").alias("video_title"),
        F.concat(F.lit("channel "), (n % 3).cast("string")).alias("channel_title"),
        F.concat(F.lit("about "), "video_id").alias("video_description"),
        (F.lit(1_600_000_000) + n).cast("string").alias("video_publish_date"),
        (n % 30).cast("string").alias("video_category"),
        n.cast("string").alias("video_view_count"),
        F.when(n % 300 == 0, "hidden").otherwise((n + 1).cast("string")).alias("video_comment_count"),
        (n * 2).cast("string").alias("video_like_count"),
        (n % 11).cast("string").alias("video_dislike_count"),
        F.concat(F.lit("tag"), (n % 5).cast("string"), F.lit("|"), "video_id").alias("video_tags"),
    )


def users(spark, sf) -> DataFrame:
    """Users with a category; every seventh has no profile, every fifth no bio."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("userid"),
        _name("u", key).alias("screen_name"),
        F.when(key % 7 != 0, key % 2 == 0).alias("verified"),
        F.when(key % 5 != 0, F.col("c_name")).alias("description"),
        F.when(key % 4 == 0, "en").when(key % 4 == 1, "fr").when(key % 4 == 2, "und").alias("lang"),
        F.when(F.col("c_mktsegment") == "BUILDING", "MYT")
        .when(F.col("c_mktsegment") == "MACHINERY", "NMYT")
        .when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment"))
        .alias("cat"),
    )


def nodes(spark, sf, text: bool = False) -> DataFrame:
    """Post nodes: counters, topics and scores in one row."""
    base = tweets(spark, sf) if text else posts_table(spark, sf)
    event = F.col("tweetid")
    return _with_topics(base).select(
        "tweetid",
        "date",
        "tweet_type",
        "followers_count",
        (F.col("k") * 2).alias("friends_count"),
        (F.col("tweetid") + F.col("k")).alias("favourites_count"),
        *([F.col("text")] if text else []),
        *topic_columns(),
        *_sentiment_columns(event),
    )


def graph(spark, sf, text: bool = False) -> Graph:
    tagged, linked = tags(spark, sf), tweet_links(spark, sf)
    return Graph(
        tweets=nodes(spark, sf, text),
        users=users(spark, sf),
        hashtags=tagged.select("name").distinct(),
        links=linked.select("name").distinct(),
        posts=posts(spark, sf),
        mentions=mentions(spark, sf),
        tags=tagged,
        tweet_links=linked,
    )


def decorated_documents(spark, sf) -> DataFrame:
    """Whole documents with what posts carry around the text."""
    key = F.col("doc_id").cast("string")
    text = F.concat(
        F.lit("RT @"), "source", F.lit("_"), key, F.lit(": "), "text",
        F.lit(" https://t.co/"), key, F.lit(" \"u\" \U0001F600 bit.ly/"), key, F.lit(" [link]"),
    )
    return documents(spark, sf).select(
        F.col("doc_id").alias("tweetid"), "source", "lang", text.alias("text")
    )


def raw_tweets(spark, sf) -> DataFrame:
    """Collector rows: list columns as literals, dates as text, one row per event."""
    base = tweets(spark, sf)
    k, event = F.col("k"), F.col("tweetid")
    ks = k.cast("string")
    video = F.concat(F.lit("https://youtu.be/v"), (k % 40).cast("string"))
    other = F.concat(F.lit("https://example.org/"), ks)
    day = F.date_format(F.col("date"), "EEE MMM dd HH:mm:ss Z yyyy")
    none = F.lit("[]")
    return base.select(
        "tweetid",
        "userid",
        "screen_name",
        "date",
        F.when(F.col("tweet_type") == "view", "original")
        .when(F.col("tweet_type") == "click", "reply")
        .when(F.col("tweet_type") == "purchase", "quoted_tweet")
        .when(F.col("tweet_type") == "signup", "retweeted_tweet_without_comment")
        .otherwise("original")
        .alias("tweet_type"),
        "text",
        F.concat(F.lit("retweeted "), F.coalesce("text", F.lit(""))).alias("rt_text"),
        "lang",
        F.when(k % 5 == 0, none)
        .when(k % 5 == 1, F.concat(F.lit("['K"), ks, F.lit("']")))
        .otherwise(F.concat(F.lit("['K"), ks, F.lit("', \"it's\"]")))
        .alias("hashtag"),
        F.when(k % 3 == 0, F.concat(F.lit("['u"), ks, F.lit("', 'v"), ks, F.lit("']"))).otherwise(none).alias("mentionsn"),
        F.when(k % 3 != 0, none)
        .when(k % 2 == 0, F.concat(F.lit("["), ks, F.lit(", "), (k + 1000).cast("string"), F.lit("]")))
        .otherwise(F.concat(F.lit("["), ks, F.lit("]")))
        .alias("mentionid"),
        F.when(k % 4 == 0, F.concat(F.lit("[{'expanded_url': '"), video, F.lit("'}]")))
        .when(k % 4 == 1, F.concat(F.lit("[{'url': None, 'expanded_url': '"), other, F.lit("'}]")))
        .otherwise(none)
        .alias("urls_list"),
        F.when(k % 10 == 0, F.concat((event + 1).cast("string"), F.lit(".0"))).alias("reply_statusid"),
        (k * 2).alias("friends_count"),
        (k % 7).alias("listed_count"),
        (event % 1000).alias("followers_count"),
        (event + k).alias("favourites_count"),
        event.alias("statuses_count"),
        (F.col("userid") % 2 == 0).alias("verified"),
        F.concat(F.lit("bio "), ks).alias("description"),
        F.col("screen_name").alias("display_name"),
        F.concat(F.lit("https://example.org/p/"), ks).alias("profile_pic_url"),
        F.concat(F.lit("https://example.org/b/"), ks).alias("profile_banner_url"),
        day.alias("date_first_tweet"),
        day.alias("account_creation_date"),
    )


def profiles(spark, sf) -> DataFrame:
    """User dimension: screen name and category."""
    return table(spark, sf, "customer").select(
        _name("u", F.col("c_custkey")).alias("user"), F.col("c_mktsegment").alias("cat")
    )


def labelled_text(spark, sf) -> DataFrame:
    joined = table(spark, sf, "labels").join(documents(spark, sf), "doc_id")
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    return joined.select("doc_id", "text", label.alias("label"))
