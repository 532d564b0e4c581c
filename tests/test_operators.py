from datetime import datetime, timedelta

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

import __spark_entry__
from postlark import sources
from postlark.functions import kernels, text
from postlark.operators import cohort as co
from postlark.operators import graph as gr
from postlark.operators import metrics as mt
from postlark.operators import sentiment as st
from postlark.operators import topics as tp
from postlark.operators import video as vd
from postlark.plans import jobs, reports
from postlark.schema import COUNTERS, EXPANDED_URLS, STRINGS, TWEETS

DAY = datetime(2020, 11, 6, 12, 0, 0)
PROBS = ", ".join(f"topic_{i}_prob double" for i in range(5))
COHORT = (
    "tweetid long, userid long, screen_name string, date timestamp, tweet_type string, text string, "
    "rt_text string, lang string, hashtag array<string>, mentionsn array<string>, mentionid array<string>, "
    "urls_list array<struct<expanded_url:string>>, "
    + ", ".join(f"{c} long" for c in COUNTERS)
    + ", verified boolean, description string, display_name string, profile_pic_url string, "
    "profile_banner_url string, date_first_tweet string, account_creation_date string, cat string, " + PROBS
)


def cohort_row(tweetid, userid, hour, kind="original", text="t", tags=(), mentions=(), links=(), bio="b", n=1):
    names, ids = [m[1] for m in mentions], [str(m[0]) for m in mentions]
    return (
        tweetid, userid, f"u{userid}", DAY + timedelta(hours=hour), kind, text, f"rt {text}", "en",
        list(tags), names, ids, [(link,) for link in links], n, n, n, n, n, True, bio, "d", None, None,
        "x", "y", "MYT", 0.1, 0.2, 0.3, 0.4, 0.0,
    )


@pytest.fixture(scope="module")
def cohort(spark):
    rows = [
        cohort_row(1, 10, 0, tags=["A", "b"], mentions=[(11, "u11"), (99, "first")], links=["https://youtu.be/x"], n=5),
        cohort_row(2, 10, 2, kind="retweeted_tweet_without_comment", tags=["a"], bio="latest", n=9),
        cohort_row(2, 10, 2, kind="retweeted_tweet_without_comment", tags=["a"], bio="latest", n=9),
        cohort_row(3, 11, 1, kind="reply", mentions=[(99, "second"), (10, "u10")], links=["https://www.youtube.com/channel/c"], n=7),
        cohort_row(4, 10, 1, mentions=[(10, "u10")], bio=None, n=6),
    ]
    return spark.createDataFrame(rows, COHORT)


@pytest.fixture(scope="module")
def graph(cohort):
    return gr.build_graph(cohort)


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_nodes(graph):
    tweets = {r["tweetid"]: r for r in graph.tweets.collect()}
    assert sorted(tweets) == [1, 2, 3, 4] and tweets[2]["text"] == "rt t" and tweets[1]["text"] == "t"
    users = {r["userid"]: r for r in graph.users.collect()}
    assert sorted(users) == [10, 11, 99]
    assert users[10]["description"] == "latest" and users[10]["followers_count"] == 9
    assert users[99]["screen_name"] == "first" and users[99]["verified"] is None


def test_edges(graph):
    assert pairs(graph.posts, "userid", "tweetid") == [(10, 1), (10, 2), (10, 4), (11, 3)]
    assert pairs(graph.mentions, "tweetid", "userid") == [(1, 11), (1, 99), (3, 10), (3, 99), (4, 10)]
    assert pairs(graph.tags, "name", "tweetid") == [("a", 1), ("a", 2), ("b", 1)]
    assert pairs(graph.hashtags, "name") == [("a",), ("b",)]
    assert len(pairs(graph.tweet_links, "tweetid", "name")) == len(pairs(graph.links, "name")) == 2


def test_relations(graph):
    any_rows = pairs(gr.user_tweets_any(graph), "userid", "tweetid")
    # a post that mentions its author counts twice for them
    assert any_rows.count((10, 4)) == 2 and (99, 1) in any_rows and len(any_rows) == 9
    assert len(pairs(gr.user_tweets_posted(graph), "userid", "tweetid")) == 4
    with pytest.raises(ValueError):
        gr.user_edges(graph, "other")


def test_reports(graph):
    overview = {r["userid"]: r for r in reports.overview_report(graph).collect()}
    assert sorted(overview) == [10, 11]
    assert (overview[10]["n_original"], overview[10]["n_reply"], overview[10]["n_quoted_tweet"]) == (3, 1, 0)
    profile = {r["userid"]: r for r in reports.profile_report(graph).collect()}
    assert profile[10]["first_followers_count"] == 5 and profile[10]["delta_followers_count"] == 4
    assert profile[99]["min_date"] == DAY and profile[99]["max_date"] == DAY + timedelta(hours=1)
    top = mt.top_hashtags(gr.user_hashtags(graph), 1).collect()
    assert {(r["userid"], r["hashtag"], r["count_hashtag"]) for r in top} == {(10, "a", 2), (11, "a", 1), (99, "a", 1)}
    series = mt.time_series(gr.user_tweets_any(graph), ["followers_count"]).collect()
    assert [(r["userid"], r["date"]) for r in series] == sorted((r["userid"], r["date"]) for r in series)


def test_bucketed_tables_join_without_a_shuffle(spark, graph):
    sources.write_bucketed_graph(graph, "bucketed_", 4)
    stored = sources.read_bucketed_graph(spark, "bucketed_")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = gr.user_tweets_posted(stored)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert pairs(joined, "userid", "tweetid") == pairs(gr.user_tweets_posted(graph), "userid", "tweetid")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_graph_files(spark, graph, tmp_path):
    sources.write_graph(graph, str(tmp_path / "g"))
    again = sources.read_graph(spark, str(tmp_path / "g"))
    assert pairs(again.posts, "userid", "tweetid") == pairs(graph.posts, "userid", "tweetid")
    with pytest.raises(Exception, match="already exists"):
        sources.write_graph(graph, str(tmp_path / "g"))


def test_csv_sources(spark, tmp_path):
    (tmp_path / "tweets").mkdir()
    header = ",".join(TWEETS.names)
    row = dict.fromkeys(TWEETS.names, "")
    row.update(
        tweetid="1", userid="2", date="2020-11-06 12:13:14", text='"two\nlines, ""quoted"""',
        hashtag="\"['a', 'b']\"", verified="True", followers_count="12",
    )
    (tmp_path / "tweets" / "a.csv").write_text(header + "\n" + ",".join(row.values()) + "\n")
    got = sources.read_tweets(spark, str(tmp_path / "tweets")).collect()
    assert len(got) == 1 and got[0]["text"] == 'two\nlines, "quoted"' and got[0]["followers_count"] == 12
    assert got[0]["verified"] is True and got[0]["hashtag"] == "['a', 'b']"

    stored = jobs.ingest_posts(spark, str(tmp_path / "tweets"), str(tmp_path / "parsed")).collect()
    assert stored[0]["hashtag"] == ["a", "b"] and stored[0]["text"] == got[0]["text"]

    (tmp_path / "users.csv").write_text("user,cat\nu1,MYT\n")
    assert [tuple(r) for r in sources.read_users(spark, str(tmp_path / "users.csv")).collect()] == [("u1", "MYT")]

    for name, words in (("english_stopwords", "the\nThe\nof"), ("italian_stopwords", "il\nthe")):
        (tmp_path / name).write_text(words + "\n")
    words = sources.read_stopwords(spark, str(tmp_path), ["en", "it"])
    assert words.count() == 5
    assert {tuple(r) for r in words.collect()} == {("en", "the"), ("en", "The"), ("en", "of"), ("it", "il"), ("it", "the")}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "users.csv").write_text("cat,extra,user\nMYT,x,u1\n")
    assert [tuple(r) for r in sources.read_users(spark, str(tmp_path / "users.csv")).collect()] == [("u1", "MYT")]
    (tmp_path / "short.csv").write_text("user,extra\nu1,x\n")
    with pytest.raises(ValueError, match="cat"):
        sources.read_users(spark, str(tmp_path / "short.csv"))
    names = list(reversed(TWEETS.names))
    row = dict.fromkeys(names, "") | {"tweetid": "1", "userid": "2", "text": "hello", "followers_count": "7"}
    (tmp_path / "tweets.csv").write_text(",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n")
    got = sources.read_tweets(spark, str(tmp_path / "tweets.csv")).collect()[0]
    assert (got["text"], got["followers_count"], got.__fields__) == ("hello", 7, TWEETS.names)


def test_video_metadata_source(spark, tmp_path):
    fields = "video_id,video_title,channel_title,video_description,video_publish_date,video_category,video_view_count,video_comment_count,video_like_count,video_dislike_count,video_tags"
    (tmp_path / "v.csv").write_text(fields + '\nx,"a, b",c,"two\nlines",86400,22,10,n/a,3,0,one|two\n')
    row = vd.typed_video_metadata(sources.read_video_metadata(spark, str(tmp_path / "v.csv"))).first()
    assert row["video_publish_date"] == datetime(1970, 1, 2) and row["video_tags"] == ["one", "two"]
    assert row["video_view_count"] == 10.0 and row["video_comment_count"] is None


def test_ranking(spark):
    rows, i = [], 0
    for user, posts, videos, tags in ((1, 4, 2, 3), (2, 4, 2, 3), (3, 3, 3, 1), (4, 2, 0, 2), (5, 9, 9, 9), (6, 3, 1, 0)):
        for n in range(posts):
            i += 1
            tag = "['a']" if n < tags else "[]"
            link = "[{'expanded_url': 'https://youtu.be/x'}]" if n < videos else "[]"
            rows.append((user, i, tag, link))
    raw = spark.createDataFrame(rows, "userid long, tweetid long, hashtag string, urls_list string")
    parsed = jobs.parse_literals(raw, {"hashtag": STRINGS, "urls_list": EXPANDED_URLS})
    ranked = co.rank_users(parsed, 2, 4, 3).collect()
    assert [(r["userid"], r["tweets_count"], r["yt_shares_count"], r["hashtags_count"]) for r in ranked] == [
        (1, 4, 2, 3), (2, 4, 2, 3), (3, 3, 3, 1),
    ]
    # an empty list counts one in literal mode, so user 6 qualifies
    half = jobs.parse_literals(raw, {"urls_list": EXPANDED_URLS})
    literal = co.rank_users(half, 2, 4, 10, "literal").collect()
    assert [r["userid"] for r in literal] == [1, 2, 3, 6] and literal[0]["hashtags_count"] == 4
    separate = co.tweets_per_user(parsed).join(co.hashtags_per_user(parsed), "userid").join(
        co.video_shares_per_user(parsed), "userid"
    )
    fused = co.user_counts(parsed).filter("hashtags_count > 0 and yt_shares_count > 0")
    columns = ("userid", "tweets_count", "hashtags_count", "yt_shares_count")
    assert pairs(separate, *columns) == pairs(fused, *columns)


def test_videos(spark):
    shares = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "gone"), (2, 6, "a")],
        "userid long, tweetid long, video_id string",
    )
    known = spark.createDataFrame([("a",), ("b",)], "video_id string")
    summary = {r["userid"]: tuple(r)[1:] for r in vd.video_moderation(shares, known).collect()}
    assert summary == {1: (3, 1, 2), 2: (1, 1, 0)}
    assert pairs(vd.moderated_shares(shares, known), "tweetid") == [(3,), (4,), (5,)]
    assert pairs(vd.video_shares(shares, known), "tweetid") == [(1,), (2,), (6,)]


def test_sentiment_means_divide_by_all_rows(spark):
    rows = spark.createDataFrame(
        [(1, 0, 0.5, 0.25, 0.25), (1, 0, None, None, None), (2, 1, None, None, None)],
        "userid long, topic int, sa_positive_score double, sa_neutral_score double, sa_negative_score double",
    )
    got = {r["userid"]: r for r in st.sentiment_summary(rows).collect()}
    assert got[1]["positive_percent"] == 25.0 and got[1]["neutral_mean"] == 0.12
    assert got[2]["positive_percent"] == 0.0


def test_attach_sentiment(spark):
    schema = "tweetid long, " + ", ".join(f"{c} double" for c in st.SCORES)
    tweets = spark.createDataFrame([(1, 0.1, 0.1, 0.8), (2, 0.2, 0.2, 0.6)], schema)
    scores = spark.createDataFrame([(1, 0.9, 0.1, 0.0)], schema)
    got = {r["tweetid"]: tuple(r)[1:] for r in st.attach_sentiment(tweets, scores).collect()}
    assert got == {1: (0.9, 0.1, 0.0), 2: (0.2, 0.2, 0.6)}


def test_translation_routing(spark):
    rows = [(1, "en", "t"), (2, "und", "t"), (3, "fr", "t"), (4, None, "t"), (5, "fr", ""), (6, "fr", None)]
    df = spark.createDataFrame(rows, "tweetid long, lang string, text string")
    routed = df.select(st.needs_translation(F.col("lang"), F.col("text")).alias("r")).collect()
    assert [r["r"] for r in routed] == [False, False, True, True, False, False]
    supplied = spark.createDataFrame([(1, "x"), (3, "y"), (3, "z")], "tweetid long, translation string")
    got = {r["tweetid"]: r["text"] for r in st.apply_translations(df, supplied).collect()}
    assert got == {1: "t", 2: "t", 3: "y", 4: "t", 5: "", 6: None}


def test_default_ranges(spark):
    rows = [(1, DAY + timedelta(days=d)) for d in range(3)] + [(2, DAY)]
    df = spark.createDataFrame(rows, "userid long, date timestamp")
    assert mt.default_range(df, "full").count() == 4
    assert pairs(mt.default_range(df, "first"), "userid", "date") == [(1, DAY), (2, DAY)]
    assert mt.between_dates(df, "date", DAY, DAY + timedelta(days=1)).count() == 3


def test_topic_model(spark, tmp_path):
    texts = ["cats dogs pets", "dogs bark cats", "stocks market money", "money market bank", "the of"] * 4
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "tweetid long, text string")
    stopwords = spark.createDataFrame([("en", "the"), ("en", "of")], "lang string, word string")
    result = jobs.topic_job(df, stopwords, k=2, max_iter=5, path=str(tmp_path / "topics"))
    rows = jobs.topic_probabilities(result.topics, 2).collect()
    assert len(rows) == len(texts)
    for r in rows:
        total = r["topic_0_prob"] + r["topic_1_prob"]
        assert abs(total - (0 if r["tweetid"] % 5 == 4 else 1)) < 1e-9
    terms = result.terms.collect()
    assert {r["topic"] for r in terms} == {0, 1} and all(r["term"] not in ("the", "of") for r in terms)
    counts = {r["term"]: tuple(r)[1:] for r in tp.term_counts(tp.topic_tokens(df, stopwords)).collect()}
    # stripping the link mark leaves "ba" of the last "bank", which is too short
    assert counts["cats"] == (8, 8) and len(counts) == 7


def test_the_topic_fit_keeps_its_own_copy_in_one_part_per_core(spark, monkeypatch):
    seen = {}

    def fit(lda, dataset):
        seen.update(parts=dataset.rdd.getNumPartitions(), kept=dataset.storageLevel, rows=dataset.count())

    monkeypatch.setattr(tp.LDA, "fit", fit)
    features = spark.createDataFrame([(i, Vectors.sparse(2, {i % 2: 1.0})) for i in range(40)], ["tweetid", "features"])
    tp.fit_topics(features.repartition(20), 2, 3)
    assert seen["rows"] == 40 and seen["parts"] == spark.sparkContext.defaultParallelism
    # the fit keeps the rows it iterates over only if nobody has
    assert not seen["kept"].useMemory and not seen["kept"].useDisk


def test_topic_queries_tokenise_once(spark, tmp_path, monkeypatch):
    rows = [(k, f"alpha beta word{k % 9} word{k % 5}", "en", "s") for k in range(60)]
    path = tmp_path / "documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(path))
    calls, tokenize, fit = [], text.tokenize, tp.fit_topics

    def counted(col):
        calls.append(col)
        return tokenize(col)

    for module in (text, tp, jobs):
        monkeypatch.setattr(module, "tokenize", counted)
    monkeypatch.setattr(tp, "fit_topics", lambda features, k, max_iter, seed: fit(features, k, 3, seed))
    monkeypatch.setattr(__spark_entry__, "stopwords", lambda spark, sf, counts=None: spark.createDataFrame([("en", "beta")], "lang string, word string"))
    found = __spark_entry__.topic_terms(spark, str(tmp_path)).collect()
    assert len(calls) == 1 and found and all(r["is_term"] and r["falls"] for r in found)
    scores = __spark_entry__.topic_scores(spark, str(tmp_path)).collect()
    assert len(calls) == 2 and len(scores) == 60 and all(r["in_range"] and r["sums"] for r in scores)


def test_terms_are_counted_over_many_documents(spark, monkeypatch):
    rows = [(["a", "b", "a", None],), (None,), ([],), (["b"],), ([None],), (["é", "a"],)] * 7
    df = spark.createDataFrame(rows, "tokens array<string>").coalesce(1)
    for most in (3, 1 << 20):
        monkeypatch.setattr(kernels, "TOKENS_AT_ONCE", most)
        counts = {r["term"]: tuple(r)[1:] for r in tp.term_counts(df).collect()}
        assert counts == {"a": (21, 14), "b": (14, 14), "é": (7, 7)}


def test_stopwords_are_counted_once(spark, tmp_path):
    rows = [(k, f"alpha beta word{k}", "en", "s") for k in range(30)]
    path = tmp_path / "documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(path))
    listed = __spark_entry__.stopwords(spark, str(tmp_path))
    assert "Exchange" not in listed._jdf.queryExecution().executedPlan().toString()
    assert {"alpha", "beta"} <= {r["word"] for r in listed.collect()} and listed.count() == 32


def test_the_sentiment_fit_reads_its_texts_once(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        reads.add(1)
        return text

    rows = [(f"{word} w{k}", label) for k in range(10) for word, label in (("good", "positive"), ("bad", "negative"), ("wall", "neutral"))]
    train = spark.createDataFrame(rows, "text string, label string").withColumn("text", counted("text"))
    st.fit_sentiment(train, max_iter=3)
    assert reads.value == len(rows)


def test_sentiment_model(spark):
    labelled = [("great lovely good", "positive"), ("awful terrible bad", "negative"), ("table chair wall", "neutral")]
    train = spark.createDataFrame(labelled * 5, "text string, label string")
    model = st.fit_sentiment(train)
    for row in st.score_sentiment(model, spark.createDataFrame(labelled, "text string, label string")).collect():
        scores = {c.split("_")[1]: row[c] for c in st.SCORES}
        assert abs(sum(scores.values()) - 1) < 2e-4 and max(scores, key=scores.get) == row["label"]


def test_sentiment_job(spark, graph):
    train = spark.createDataFrame([("t", "positive"), ("rt other", "negative"), ("none", "neutral")], "text string, label string")
    scored = jobs.sentiment_job(graph, st.fit_sentiment(train)).tweets.collect()
    assert len(scored) == 4 and all(r["sa_positive_score"] is not None for r in scored)
