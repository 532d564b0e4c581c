"""CSV files whose quoted fields hold newlines, read in parallel.

The built-in reader gives such a file to one task, since only a reader from the
start knows whether a newline is quoted. Here every block of a file is read by a task
of its own: the parity of its quotes tells how it turns the state around, a prefix
over the blocks of a file gives each its state at the start, and then all blocks cut
their lines into records side by side. A record that crosses a border is put
together from the last lines of one block and the first of the next.

Lines end with LF or CRLF, in UTF-8; a file whose first line ends with CRLF has its
quoted newlines read as LF, as the built-in reader does. Quotes stand around a field
or, doubled, inside a quoted one, as every CSV writer puts them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import kernels

_RECORDS = "no bigint, border int, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the block they begin in; one task reads a block, from its first line on."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )


def _blocks(lines: DataFrame, quote: str) -> DataFrame:
    """Per block: whether it begins and whether it ends inside quotes, and whether its file has CRLF.

    One row for each split of the scan.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))
    # rows of a block stand in the order of the file
    placed = lines.withColumn("_at", F.monotonically_increasing_id())
    first_line = F.min_by(F.col("line").endswith("\r"), F.col("_at"))
    parity = placed.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("_parity"), first_line.alias("_returns"))
    whole = Window.partitionBy("file")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum("_parity").over(before), F.lit(0)) % 2
    return parity.withColumn("_begins", begins == 1).select(
        "file",
        "block",
        F.row_number().over(Window.orderBy("file", "block")).cast("bigint").alias("no"),
        "_begins",
        ((F.col("_parity") == 1) != F.col("_begins")).alias("_ends"),
        F.max(F.when(F.col("block") == 0, F.col("_returns"))).over(whole).alias("crlf"),
    )


def _records(lines: DataFrame, blocks: DataFrame, cut) -> DataFrame:
    joined = lines.join(F.broadcast(blocks), ["file", "block"], "left")
    # a line of a block that the first pass did not see would be misread
    lost = F.raise_error(F.lit("the files changed while they were read"))
    begins = F.when(F.col("no").isNull(), lost.cast("boolean")).otherwise(F.col("_begins"))
    rows = joined.select("no", (F.col("block") == 0).alias("first"), begins.alias("begins"), "crlf", "line")
    return rows.mapInArrow(cut, _RECORDS)


def csv_records(spark: SparkSession, path: str, header: list[str], sep: str = ",", quote: str = '"') -> DataFrame:
    """One row ``record`` per CSV record of all files, without the header, which must be the same in all."""
    lines = _lines(spark, path)
    blocks = _blocks(lines, quote)
    whole = _records(lines, blocks, kernels.cut_records(header, sep, quote))

    # only blocks with a border inside a record are looked at again
    torn = blocks.filter(F.col("_begins") | F.col("_ends"))
    near = lines.join(F.broadcast(torn.select("file", "block")), ["file", "block"], "left_semi")
    parts = _records(near, blocks, kernels.cut_records(header, sep, quote, borders=True))
    parts = parts.join(F.broadcast(blocks.select("no", "file", "crlf")), "no")
    along = Window.partitionBy("file").orderBy("no", "border")
    numbered = parts.withColumn("_span", F.count_if(F.col("border") == kernels.TAIL_PART).over(along))
    rows = F.sort_array(F.collect_list(F.struct("no", "border", "record")))
    joined = numbered.groupBy("file", "crlf", "_span").agg(
        F.array_join(F.transform(rows, lambda r: r["record"]), "\n").alias("record")
    )
    unix = F.replace("record", F.lit("\r\n"), F.lit("\n"))
    joined = joined.withColumn("record", F.when(F.col("crlf"), unix).otherwise(F.col("record")))
    return whole.select("record").unionByName(joined.select(F.rtrim("record", F.lit("\r")).alias("record")))


def read_multiline_csv(
    spark: SparkSession, path: str, schema: StructType, sep: str = ",", quote: str = '"'
) -> DataFrame:
    """The records of ``path`` with the columns of ``schema``, which are those of the header in its order."""
    records = csv_records(spark, path, schema.names, sep, quote)
    options = {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true"}
    filled = records.filter(F.col("record") != "")
    parsed = filled.select(F.from_csv("record", schema.toDDL(), options).alias("row"))
    return parsed.select("row.*")
