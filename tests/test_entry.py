"""The driver contract, and the queries against their twins on the small tables."""

import pytest

import __spark_entry__ as entry
import check_oracles

SF = "/root/testdata/sf0.001"
# one or two of each family; check_oracles.py runs them all
CHECKED = [
    "rank_users",
    "parsed_lists",
    "build_cohort",
    "graph_tweets",
    "graph_authors",
    "graph_stub_users",
    "user_hashtags",
    "top_hashtags",
    "profile_report",
    "overview_report",
    "topic_means",
    "strict_topic_literal",
    "sentiment_percent",
    "cleaning_steps",
    "term_counts",
    "dates",
    "registered_domain",
    "video_moderation",
    "video_report_cards",
    "gate",
]


@pytest.fixture(scope="module")
def connection():
    return check_oracles.connect(SF)


def test_every_twin_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.QUERIES) <= set(entry.oracle_sql())
    rows_only = set(entry.queries()) - set(entry.oracle_sql())
    assert rows_only <= {"pipeline"} | {n for n in entry.queries() if n.startswith("op")}


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= entry.SIZE


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_twin(spark, connection, name):
    assert check_oracles.compare(spark, connection, SF, name) is None
