"""Dates, casts and rounding. ANSI mode raises on bad input, so these use try_ forms."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The collector's date format. Spark 3+ cannot parse the weekday, so
# parsing skips its four characters.
DATE_FORMAT = "EEE MMM dd HH:mm:ss Z yyyy"
_DATE_FORMAT_NO_WEEKDAY = "MMM dd HH:mm:ss Z yyyy"


def parse_date(col: Column) -> Column:
    return F.try_to_timestamp(F.substr(col, F.lit(5)), F.lit(_DATE_FORMAT_NO_WEEKDAY))


def format_date(col: Column) -> Column:
    return F.date_format(col, DATE_FORMAT)


def lenient_date(col: Column) -> Column:
    return F.try_to_timestamp(col)


def epoch_to_timestamp(col: Column) -> Column:
    return F.timestamp_seconds(col.try_cast("bigint"))


def to_id(col: Column) -> Column:
    """Id as long; a trailing ``.0`` from a float column is accepted."""
    return F.coalesce(col.try_cast("bigint"), col.try_cast("decimal(38,0)").try_cast("bigint"))


def to_count(col: Column) -> Column:
    return col.try_cast("double")


def to_whole_count(col: Column) -> Column:
    return col.try_cast("double").try_cast("bigint")


def round_half_up(col: Column, digits: int) -> Column:
    return F.round(col, digits)


def round_half_even(col: Column, digits: int) -> Column:
    """Scale, round to the even neighbour, scale back: numpy's rounding."""
    scale = float(10**digits)
    return F.rint(col * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def time_key(date: Column, tie: Column) -> Column:
    """``(date, tie)`` as one number, null where the date is.

    ``min_by``/``max_by`` on a struct would fall back to a sort-based aggregate;
    a decimal key keeps the hash aggregate and its map-side combine.
    """
    micros = F.unix_micros(date.cast("timestamp")).cast("decimal(18,0)")
    return (micros * F.lit("10000000000000000000").cast("decimal(20,0)")).cast(
        "decimal(38,0)"
    ) + tie.cast("decimal(19,0)")


def flatten_lists(lists: Column) -> Column:
    """A list of lists as one list, in order; null if one of them is."""
    return F.flatten(lists)
