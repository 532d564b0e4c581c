"""Explicit schemas of the inputs. Nothing is inferred from the data."""

from pyspark.sql import types as T

TOPICS = 5

COUNTERS = (
    "friends_count",
    "listed_count",
    "followers_count",
    "favourites_count",
    "statuses_count",
)

TWEETS = T.StructType(
    [
        T.StructField("tweetid", T.LongType()),
        T.StructField("userid", T.LongType()),
        T.StructField("screen_name", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("tweet_type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("rt_text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # list literals as written by the collector, parsed by functions.literals
        T.StructField("hashtag", T.StringType()),
        T.StructField("mentionsn", T.StringType()),
        T.StructField("mentionid", T.StringType()),
        T.StructField("urls_list", T.StringType()),
        T.StructField("reply_statusid", T.StringType()),
        *[T.StructField(name, T.LongType()) for name in COUNTERS],
        T.StructField("verified", T.BooleanType()),
        T.StructField("description", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("profile_pic_url", T.StringType()),
        T.StructField("profile_banner_url", T.StringType()),
        T.StructField("date_first_tweet", T.StringType()),
        T.StructField("account_creation_date", T.StringType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("cat", T.StringType()),
    ]
)

TRANSLATIONS = T.StructType(
    [
        T.StructField("tweetid", T.LongType()),
        T.StructField("translation", T.StringType()),
    ]
)

# as delivered; operators.video.typed_video_metadata gives the typed columns
RAW_VIDEO_METADATA = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("video_title", T.StringType()),
        T.StructField("channel_title", T.StringType()),
        T.StructField("video_description", T.StringType()),
        T.StructField("video_publish_date", T.StringType()),
        T.StructField("video_category", T.StringType()),
        T.StructField("video_view_count", T.StringType()),
        T.StructField("video_comment_count", T.StringType()),
        T.StructField("video_like_count", T.StringType()),
        T.StructField("video_dislike_count", T.StringType()),
        T.StructField("video_tags", T.StringType()),
    ]
)

EXPANDED_URLS = T.ArrayType(T.StructType([T.StructField("expanded_url", T.StringType())]))
STRINGS = T.ArrayType(T.StringType())
