"""Multi-line CSV read block by block, against the built-in reader and Python's writer."""

import csv
import io
import random

import pytest

from postlark import sources
from postlark.schema import TWEETS
from postlark.sources import records
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

FIELDS = ["plain", "", "a, b", 'say "hi"', '"', '""', "two\nlines", "\n", "three\n\n\nlines", "é😀", "crlf\r\ninside", "x" * 90, " sp ", "1"]
NAMES = ["a", "b", "text", "n"]
SCHEMA = StructType([StructField(n, StringType()) for n in NAMES])


def write(path, rows, end="\n", header=NAMES, last=True):
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(header)
    writer.writerows(rows)
    text = out.getvalue()
    path.write_bytes((text if last else text.removesuffix(end)).encode())


def built_in(spark, path):
    return spark.read.schema(SCHEMA).csv(path, header=True, multiLine=True, quote='"', escape='"', sep=",")


def content(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def small_blocks(spark):
    """Splits of a few hundred bytes, several of them in one task."""
    settings = {"spark.sql.files.maxPartitionBytes": "300b", "spark.sql.files.openCostInBytes": "10b"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed,end", [(0, "\n"), (1, "\r\n"), (2, "\n")])
def test_equal_to_the_built_in_reader(small_blocks, tmp_path, seed, end):
    rng = random.Random(seed)
    for k in range(4):
        rows = [[f"{k}-{i}", *(rng.choice(FIELDS) for _ in range(3))] for i in range(rng.choice([0, 3, 120]))]
        write(tmp_path / f"{k}.csv", rows, end, last=seed != 2)
    # a record that covers several blocks, and one that ends where its file does
    write(tmp_path / "long.csv", [["p", "q", "line\n" * 300, "s"], ["p", "q", "r", "line\n" * 200]], end)
    found = records.read_multiline_csv(small_blocks, str(tmp_path), SCHEMA)
    expected = content(built_in(small_blocks, str(tmp_path)))
    assert content(found) == expected and len(expected) > 2
    assert found.rdd.getNumPartitions() > 5


def test_a_file_without_quotes_and_an_empty_one(small_blocks, tmp_path):
    write(tmp_path / "a.csv", [[str(i), "x", "y", "z"] for i in range(200)])
    write(tmp_path / "b.csv", [])
    found = records.read_multiline_csv(small_blocks, str(tmp_path), SCHEMA)
    assert content(found) == content(built_in(small_blocks, str(tmp_path))) and found.count() == 200


def test_another_header_is_an_error(small_blocks, tmp_path):
    write(tmp_path / "a.csv", [["1", "2", "3", "4"]])
    write(tmp_path / "b.csv", [["1", "2", "3", "4"]], header=["a", "b", "n", "text"])
    with pytest.raises(Exception, match="another header"):
        records.read_multiline_csv(small_blocks, str(tmp_path), SCHEMA).collect()


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(9)
    rows = [[str(i), rng.choice(FIELDS), "text " * rng.randint(0, 60) + rng.choice(FIELDS), "z"] for i in range(40_000)]
    write(tmp_path / "big.csv", rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        found = records.read_multiline_csv(spark, str(tmp_path), SCHEMA)
        tasks = found.select(F.spark_partition_id()).distinct().count()
        digest = [F.count("*"), F.sum(F.xxhash64(*NAMES).cast("decimal(38,0)"))]
        assert found.agg(*digest).first() == built_in(spark, str(tmp_path)).agg(*digest).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks >= (tmp_path / "big.csv").stat().st_size // (1 << 19)


def test_tweets_by_header_name(small_blocks, tmp_path):
    names = [*reversed(TWEETS.names), "extra"]
    rows = [[{"tweetid": str(i), "text": f"two\nlines {i}", "verified": "true"}.get(n, "") for n in names] for i in range(50)]
    write(tmp_path / "t.csv", rows, header=names)
    found = sources.read_tweets(small_blocks, str(tmp_path))
    assert found.schema == TWEETS
    assert {(r.tweetid, r.text, r.verified) for r in found.collect()} == {(i, f"two\nlines {i}", True) for i in range(50)}
