"""The graph as stored tables that batches of posts are merged into.

Every table is partitioned by ``bucket``, a hash of its key. A merge reads the
buckets that its batch has keys of, picks the winners among stored and new rows,
and replaces those buckets; the others are neither read nor written. What decides
between rows is stored beside them, so batches may come in any order and may be
merged again: the result is that of building the graph from all rows at once.

A merge first writes the new buckets below ``merge`` and marks them complete; then
it moves them to the place of the old ones. If it is cut off, ``finish_merge`` (which the next merge
calls) replaces the rest, or drops buckets that were not complete. While buckets
are being replaced, a reader may see some tables of the batch and not yet others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph as gr
from ..operators.graph import GRAPH_TABLES, Graph

BUCKETS = 64
SETTINGS, STAGED, COMPLETE = "settings", "merge", "complete"


@dataclass(frozen=True)
class Stored:
    """How a table is stored: its key, its rows of a batch, and the winners among rows."""

    key: str
    rows: Callable[[DataFrame], DataFrame]
    winners: Callable[[DataFrame], DataFrame]


TABLES = {
    "tweets": Stored("tweetid", gr.tweet_rows, gr.latest_tweets),
    "users": Stored("userid", gr.user_rows, gr.latest_users),
    "hashtags": Stored("name", gr.hashtags, DataFrame.distinct),
    "links": Stored("name", gr.links, DataFrame.distinct),
    "posts": Stored("tweetid", gr.posts, DataFrame.distinct),
    "mentions": Stored("tweetid", gr.mentions, DataFrame.distinct),
    "tags": Stored("tweetid", gr.tags, DataFrame.distinct),
    "tweet_links": Stored("tweetid", gr.tweet_links, DataFrame.distinct),
}


def _in_buckets(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _write(rows: DataFrame, path: str) -> None:
    """One file per bucket."""
    rows.repartition("bucket").write.partitionBy("bucket").parquet(path)


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def _drop(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def _replace_buckets(spark: SparkSession, staged: str, path: str) -> None:
    """Move the buckets below ``staged`` to the place of those in ``path``; no row is read or written.

    What was moved is no longer staged, so a move that was cut off goes on where it stopped.
    """
    files, folder = _folder(spark, staged)
    _, table = _folder(spark, path)
    for found in files.listStatus(folder):
        bucket = found.getPath()
        if not bucket.getName().startswith("bucket="):
            continue
        target = table.suffix(f"/{bucket.getName()}")
        files.delete(target, True)
        if not files.rename(bucket, target):
            raise OSError(f"cannot move {bucket} to {target}")


def create_graph_store(
    cohort: DataFrame, path: str, buckets: int = BUCKETS, names: Sequence[str] = GRAPH_TABLES
) -> None:
    """Store the graph of parsed cohort rows, or some of its tables; ``path`` must be new.

    Choose ``buckets`` so that a bucket of posts fits a task; it cannot change later.
    """
    tables = {n: TABLES[n] for n in names}
    tables = {n: _in_buckets(t.winners(t.rows(cohort)), t.key, buckets) for n, t in tables.items()}
    kinds = [(n, ", ".join(f"`{c}` {k}" for c, k in rows.dtypes), buckets) for n, rows in tables.items()]
    settings = cohort.sparkSession.createDataFrame(kinds, "name string, schema string, buckets int")
    settings.coalesce(1).write.parquet(f"{path}/{SETTINGS}")
    for name, rows in tables.items():
        _write(rows, f"{path}/{name}")


def _settings(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number of buckets, and the schema of each table (a table without rows has no file that tells)."""
    rows = spark.read.parquet(f"{path}/{SETTINGS}").collect()
    return rows[0]["buckets"], {r["name"]: r["schema"] for r in rows}


def rows_to_merge(batch: DataFrame, stored: DataFrame, table: Stored, buckets: int) -> DataFrame:
    """New rows and the stored rows of their buckets.

    The bucket numbers that go through the driver are at most ``buckets``.
    """
    new = _in_buckets(table.rows(batch), table.key, buckets)
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
    old = stored.filter(F.col("bucket").isin(touched))
    return new.unionByName(old.select(*new.columns))


def merge_into_store(batch: DataFrame, path: str) -> None:
    """Merge the graph of parsed cohort rows into the store. Merging a batch again changes nothing.

    Every table is a scan of the batch; keep it as parquet.
    """
    spark = batch.sparkSession
    finish_merge(spark, path)
    buckets, schemas = _settings(spark, path)
    for name in schemas:
        table = TABLES[name]
        stored = spark.read.schema(schemas[name]).parquet(f"{path}/{name}")
        merged = table.winners(rows_to_merge(batch, stored, table, buckets).drop("bucket"))
        _write(_in_buckets(merged, table.key, buckets), f"{path}/{STAGED}/{name}")
    spark.range(1).coalesce(1).write.parquet(f"{path}/{STAGED}/{COMPLETE}")
    finish_merge(spark, path)


def finish_merge(spark: SparkSession, path: str) -> None:
    """Replace buckets by those of a complete merge, if one waits; it may have begun to."""
    if not _exists(spark, f"{path}/{STAGED}"):
        return
    # the success file of the marker is the last thing a merge writes
    if _exists(spark, f"{path}/{STAGED}/{COMPLETE}/_SUCCESS"):
        _, schemas = _settings(spark, path)
        for name in schemas:
            _replace_buckets(spark, f"{path}/{STAGED}/{name}", f"{path}/{name}")
    _drop(spark, f"{path}/{STAGED}")


def read_stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One stored table, without the columns that only a merge needs."""
    rows = spark.read.schema(_settings(spark, path)[1][name]).parquet(f"{path}/{name}")
    return rows.select(*[c for c in rows.columns if c != "bucket" and not c.startswith("_")])


def read_graph_store(spark: SparkSession, path: str) -> Graph:
    return Graph(**{name: read_stored(spark, path, name) for name in GRAPH_TABLES})
