"""Plans that must keep their shape, and task code that must travel."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from postlark.functions import kernels
from postlark.operators import cohort as co
from postlark.operators import corpus
from postlark.operators import metrics as mt
from postlark.operators import topics as tp
from postlark.plans import jobs
from postlark.schema import TWEETS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def rows(spark):
    return spark.range(100).select(
        (F.col("id") % 3).alias("userid"),
        F.col("id").alias("tweetid"),
        F.timestamp_seconds("id").alias("date"),
        F.col("id").cast("string").alias("hashtag"),
        *[F.col("id").alias(c) for c in mt.PROFILE_COUNTERS],
        F.split(F.lit("a b"), " ").alias("tokens"),
    )


def test_first_and_last_values_stay_in_the_hash_aggregate(rows):
    text = plan(mt.counter_delta(rows))
    assert "SortAggregate" not in text and "partial_min_by" in text


def test_top_hashtags_limits_groups_before_the_shuffle(rows):
    text = plan(mt.top_hashtags(rows))
    assert "row_number(), 20, Partial" in text and "row_number(), 20, Final" in text


def test_term_counts_shuffle_once(rows):
    assert plan(tp.term_counts(rows)).count("Exchange") == 1


def test_user_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("u1", 1)], "screen_name string, n int").write.parquet(str(tmp_path / "t"))
    text = plan(mt.for_user(spark.read.parquet(str(tmp_path / "t")), "u1"))
    assert "EqualTo(screen_name,u1)" in text


def test_ranking_keeps_python_out(spark):
    raw = spark.createDataFrame([], TWEETS)
    assert "Python" not in plan(co.rank_users(jobs.parse_posts(raw)))


def test_a_corpus_moves_its_texts_once(spark):
    """One range exchange of the texts; all else that moves is a row or two per chunk."""
    texts = spark.createDataFrame([("a", 1, "x")], "g string, tweetid long, text string")
    ordered = corpus._ordered_texts(texts, ["g"], ["tweetid"])
    for lines in (corpus._chunk_lines(ordered, ["g"], ["tweetid"]), corpus.corpus_lines(texts, ["g"], ["tweetid"])):
        text = plan(lines)
        assert "SortMergeJoin" not in text and "SortAggregate" not in text
        assert text.count("Exchange hashpartitioning") == 1  # the fold of chunk borders
    assert ordered.columns == ["g", "tweetid", "text", "_mark", "_group", "_chunk"]


def test_task_code_needs_no_copy_of_the_package(tmp_path):
    cleaner = kernels.Cleaner("^@", "RT", "[]", "x")
    functions = (
        kernels.number_lines(10, ["a"]), kernels.group_summaries(10), kernels.fold_chunks(10), kernels.literals_to_json,
        kernels.border_marks(cleaner), kernels.fold_marks, kernels.place_texts(["a"]), kernels.merge_lines(cleaner, ["a"]),
        kernels.batch_fragments(["a"]), kernels.cut_records(["a"], ",", '"'), kernels.summaries("a", 1, 1),
        kernels.chained(kernels.with_sizes),
    )
    (tmp_path / "f").write_bytes(cloudpickle.dumps(functions))
    code = "import pickle, sys; pickle.load(open('f', 'rb')); assert 'postlark' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env={"PATH": "/usr/bin"})
