"""Merging batches into a stored graph, and upserts that stay in the hash aggregate."""

import itertools
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postlark.operators import graph as gr
from postlark.operators import metrics as mt
from postlark.sources import (
    create_graph_store,
    merge_into_store,
    read_graph_store,
    read_stored,
    store,
    write_user_posts,
)
from test_operators import COHORT, DAY, cohort_row


def random_rows(n=60, seed=3):
    """Users who post, are mentioned before or after that, or only mentioned; posts seen twice."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        author = rng.randint(1, 12)
        mentions = [(m, rng.choice(["", "old"]) + f"u{m}") for m in rng.sample(range(1, 25), rng.randint(0, 3))]
        row = list(
            cohort_row(
                rng.randint(1, 40), author, rng.randint(0, 9), rng.choice(["reply", "retweeted_tweet_without_comment"]),
                f"t{i}", rng.choice([[], ["A"], ["b", "C"]]), mentions, rng.choice([[], ["https://x/1"]]), f"bio {i}", i,
            )
        )
        if rng.random() < 0.1:
            row[3] = None
        rows.append(tuple(row))
    return rows


def content(graph):
    return {name: sorted(map(str, getattr(graph, name).collect())) for name in gr.GRAPH_TABLES}


def latest_by_hand(rows):
    """Last write of authors by (date, id, values), first mention of the others."""
    names = [f.split(" ")[0] for f in COHORT.split(", ")]
    low = DAY.replace(year=1)
    authors, stubs = {}, {}
    for row in (dict(zip(names, r)) for r in rows):
        at = (row["date"] or low, row["tweetid"], row["description"])
        if row["userid"] not in authors or authors[row["userid"]][0] < at:
            authors[row["userid"]] = (at, row["description"])
        for pos, (user, name) in enumerate(zip(row["mentionid"], row["mentionsn"])):
            at = (row["date"] or low, row["tweetid"], pos, name)
            stubs[int(user)] = min(stubs.get(int(user), at), at)
    found = {u: (f"u{u}", bio) for u, (_, bio) in authors.items()}
    return found | {u: (at[3], None) for u, at in stubs.items() if u not in found}


def test_winners_are_those_of_a_plain_loop(spark):
    rows = random_rows()
    users = gr.build_graph(spark.createDataFrame(rows, COHORT)).users.collect()
    assert {u["userid"]: (u["screen_name"], u["description"]) for u in users} == latest_by_hand(rows)
    assert len(users) == len({u["userid"] for u in users})


def test_batches_in_any_order_give_one_build(spark, tmp_path):
    rows = random_rows()
    whole = content(gr.build_graph(spark.createDataFrame(rows, COHORT)))
    batches = [rows[::3], rows[1::3], rows[2::3]]
    for n, order in enumerate([(0, 1, 2), (2, 0, 1)]):
        path = str(tmp_path / f"g{n}")
        first, *others = [spark.createDataFrame(batches[k], COHORT) for k in order]
        create_graph_store(first, path, buckets=3)
        for batch in others:
            merge_into_store(batch, path)
        assert content(read_graph_store(spark, path)) == whole
    merge_into_store(spark.createDataFrame(batches[0], COHORT), path)  # again
    assert content(read_graph_store(spark, path)) == whole


def test_a_mentioned_user_becomes_an_author_and_stays_one(spark, tmp_path):
    mention = [cohort_row(1, 10, 5, mentions=[(11, "was11")])]
    post = [cohort_row(2, 11, 0, bio="mine")]
    for n, (a, b) in enumerate(itertools.permutations([mention, post])):
        path = str(tmp_path / f"g{n}")
        create_graph_store(spark.createDataFrame(a, COHORT), path, 4, names=["users"])
        merge_into_store(spark.createDataFrame(b, COHORT), path)
        users = {r["userid"]: (r["screen_name"], r["description"]) for r in read_stored(spark, path, "users").collect()}
        assert users == {10: ("u10", "b"), 11: ("u11", "mine")}


def files(spark, path, name):
    return {f: f.rsplit("bucket=", 1)[1].split("/")[0] for f in spark.read.parquet(f"{path}/{name}").inputFiles()}


def test_untouched_buckets_are_neither_read_nor_written(spark, tmp_path):
    path = str(tmp_path / "g")
    create_graph_store(spark.createDataFrame(random_rows(200), COHORT), path, 16, names=["tweets", "posts"])
    before = files(spark, path, "tweets")
    batch = spark.createDataFrame([cohort_row(7, 1, 99), cohort_row(8, 1, 99)], COHORT)
    touched = {
        str(r[0]) for r in batch.select(F.pmod(F.xxhash64("tweetid"), F.lit(16)).cast("int")).distinct().collect()
    }
    stored = spark.read.parquet(f"{path}/tweets")
    rows = store.rows_to_merge(batch, stored, store.TABLES["tweets"], 16)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    scanned = rows.join(batch.limit(0).select("tweetid"), "tweetid", "left").select(F.input_file_name()).distinct()
    assert scanned.count() >= 1
    read = {r[0] for r in stored.filter(F.col("bucket").isin([int(b) for b in touched])).select(F.input_file_name()).collect()}
    assert {f.rsplit("bucket=", 1)[1].split("/")[0] for f in read} <= touched
    merge_into_store(batch, path)
    after = files(spark, path, "tweets")
    assert {f for f in before if before[f] not in touched} == {f for f in after if after[f] not in touched}
    assert all(f not in before for f in after if after[f] in touched)


def test_a_merge_that_was_cut_off_is_finished_or_dropped(spark, tmp_path):
    rows = random_rows()
    a, b = (spark.createDataFrame(x, COHORT) for x in (rows[::2], rows[1::2]))
    whole = content(gr.build_graph(spark.createDataFrame(rows, COHORT)))
    path = str(tmp_path / "g")
    create_graph_store(a, path, 4)
    old, store.finish_merge = store.finish_merge, lambda *_: None
    try:
        merge_into_store(b, path)  # all is written, nothing replaced
    finally:
        store.finish_merge = old
    assert content(read_graph_store(spark, path)) != whole
    store.finish_merge(spark, path)
    assert content(read_graph_store(spark, path)) == whole
    # buckets of a merge without its marker are dropped
    spark.range(3).write.parquet(f"{path}/merge/tweets")
    store.finish_merge(spark, path)
    assert content(read_graph_store(spark, path)) == whole and not (tmp_path / "g" / "merge").exists()


def test_a_merge_writes_its_rows_once(spark, tmp_path):
    rows = random_rows()
    a, b = (spark.createDataFrame(x, COHORT) for x in (rows[::2], rows[1::2]))
    path = str(tmp_path / "g")
    create_graph_store(a, path, 4, names=["tweets"])
    old, store.finish_merge = store.finish_merge, lambda *_: None
    try:
        merge_into_store(b, path)
    finally:
        store.finish_merge = old
    staged = {f.name for f in (tmp_path / "g" / "merge" / "tweets").glob("bucket=*/*.parquet")}
    # some buckets were moved before the merge was cut off
    store._replace_buckets(spark, f"{path}/merge/tweets", f"{path}/tweets")
    store.finish_merge(spark, path)
    assert staged and staged == {f.name for f in (tmp_path / "g" / "tweets").glob("bucket=*/*.parquet")}


def test_empty_batches(spark, tmp_path):
    path = str(tmp_path / "g")
    none = spark.createDataFrame([], COHORT)
    create_graph_store(none, path, 4)
    assert all(not rows for rows in content(read_graph_store(spark, path)).values())
    some = spark.createDataFrame(random_rows(9), COHORT)
    merge_into_store(some, path)
    merge_into_store(none, path)
    assert content(read_graph_store(spark, path)) == content(gr.build_graph(some))


def test_one_user_reads_a_few_row_groups(spark, tmp_path):
    rows = [cohort_row(i, 1 if i % 3 == 0 else i % 97 + 2, i, mentions=[(i % 89, f"u{i % 89}")]) for i in range(4000)]
    graph = gr.build_graph(spark.createDataFrame(rows, COHORT))
    path = tmp_path / "by_user"
    write_user_posts(graph, str(path), files=12, row_group_bytes=20_000)
    groups = []
    for file in sorted(path.glob("*.parquet")):
        meta = pq.ParquetFile(file).metadata
        at = {meta.schema.column(k).name: k for k in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            name = group.column(at["screen_name"]).statistics
            groups.append((name.min, name.max, group.num_rows))
    total = sum(n for *_, n in groups)
    assert len(groups) >= 24 and total == gr.user_tweets(graph).count()

    def read(user):
        """Rows of the row groups that the statistics leave for one user."""
        return [n for low, high, n in groups if low <= user <= high]

    assert len(read("u50")) <= 2 and sum(read("u50")) < total / 8
    # the user with a third of the posts lies in many row groups, and a few weeks of theirs in few
    stored = spark.read.parquet(str(path))
    assert len(read("u1")) > 5
    one = mt.for_user(stored, "u50")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(screen_name,u50)" in plan
    expected = gr.user_tweets(graph).join(graph.users.filter("screen_name = 'u50'").select("userid"), "userid")
    assert sorted(r["tweetid"] for r in one.collect()) == sorted(r["tweetid"] for r in expected.collect())


@pytest.mark.parametrize("table", ["tweet_nodes", "user_nodes", "stub_users"])
def test_upserts_aggregate_by_hash(spark, table):
    rows = spark.createDataFrame(random_rows(5), COHORT)
    plan = getattr(gr, table)(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
