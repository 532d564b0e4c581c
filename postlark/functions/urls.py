"""Video links and domains."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The link forms that count as a shared video.
VIDEO_PREFIX = "^https?://(www[.]youtube[.]com|youtu[.]be)/"
VIDEO_SUBSTRINGS = (
    "http://youtu.be/",
    "http://www.youtube.com/watch?v",
    "https://www.youtube.com/watch?v",
    "https://youtu.be/",
)
# URL shapes that carry a video id.
SHORT_HOST = "(?i)^([a-z][a-z0-9+.-]*:)?//([^/?#@]*@)?youtu[.]be(:[0-9]*)?([/?#]|$)"
LONG_HOST = "(?i)^([a-z][a-z0-9+.-]*:)?//([^/?#@]*@)?(www[.])?youtube[.]com(:[0-9]*)?/"
PATH = "^(?:[^:/?#]+:)?//[^/?#]*/([^?#]*?)(?:;[^/?#]*)?(?:[?#]|$)"
WATCH_ID = "^[^?#]*[?](?:[^#]*?&)??v=([^&#]+)"
SEGMENT_ID = "^(?:embed|shorts|v)/([^/]*)"
HOST = "^(?:[^:/?#]+:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def is_video_prefix(col: Column) -> Column:
    return col.rlike(VIDEO_PREFIX)


def contains_video_url(col: Column) -> Column:
    found = F.lit(False)
    for text in VIDEO_SUBSTRINGS:
        found = found | col.contains(text)
    return found


def video_id(url: Column) -> Column:
    """Video id of a link, or null. The first non-blank ``v`` of a watch link wins."""
    path = F.regexp_extract(url, PATH, 1)
    watched = F.regexp_extract(url, WATCH_ID, 1)
    decoded = F.coalesce(F.try_url_decode(watched), watched)
    return F.when(url.rlike(SHORT_HOST), path).when(
        url.rlike(LONG_HOST),
        F.when(path == "watch", F.when(watched != "", decoded)).when(
            path.rlike("^(embed|shorts|v)/"), F.regexp_extract(path, SEGMENT_ID, 1)
        ),
    )


# an address has no suffix and is its own domain
ADDRESS = r"^[0-9]{1,3}([.][0-9]{1,3}){3}$"
_WILDCARD, _EXCEPTION = 1, 2


def suffix_rules(suffixes: DataFrame) -> DataFrame:
    """``(tail, kind)`` of a suffix list: ``co.uk``, ``*.ck`` (any label there) or ``!www.ck`` (not a suffix)."""
    rule = F.lower("suffix")
    kind = F.when(rule.startswith("*."), _WILDCARD).when(rule.startswith("!"), _EXCEPTION).otherwise(0)
    rules = suffixes.select(F.regexp_replace(rule, "^([*][.]|!)", "").alias("_tail"), kind.alias("_kind"))
    return rules.filter(F.col("_tail").isNotNull()).distinct()


def with_registered_domain(
    df: DataFrame, url: str, suffixes: DataFrame, out: str = "domain"
) -> DataFrame:
    """Add the registered domain of ``url``: the longest suffix that a rule gives plus one label.

    ``suffixes`` has one column ``suffix`` with the rules. An exception beats all other
    rules and makes the labels behind its first one the suffix. Each distinct host is
    joined with the rules once, by its tails; links then join their host. A host without
    a known suffix keeps its last label followed by a dot, an address itself.
    """
    host = F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    named = df.withColumn("_host", host)
    hosts = named.select("_host").filter(F.col("_host").isNotNull()).distinct()
    labels = hosts.withColumn("_labels", F.split("_host", "[.]"))
    size = F.size("_labels")
    tails = F.transform(
        F.sequence(F.lit(1), size),
        lambda d: F.struct(
            d.alias("_depth"), F.array_join(F.slice("_labels", size - d + 1, d), ".").alias("_tail")
        ),
    )
    each = labels.select("_host", size.alias("_size"), F.inline(tails))
    matched = each.join(suffix_rules(suffixes), "_tail")
    depth = F.col("_depth") + F.when(F.col("_kind") == _WILDCARD, 1).when(F.col("_kind") == _EXCEPTION, -1).otherwise(0)
    # a host has at most 127 labels
    rank = depth + F.when(F.col("_kind") == _EXCEPTION, 1000).otherwise(0)
    best = matched.filter(depth <= F.col("_size")).groupBy("_host").agg((F.max(rank) % 1000).alias("_depth"))
    found = labels.join(best, "_host", "left").withColumn("_depth", F.coalesce("_depth", F.lit(0)))
    size, depth = F.size("_labels"), F.col("_depth")
    before = F.when(size > depth, F.element_at("_labels", F.greatest(size - depth, F.lit(1)))).otherwise("")
    suffix = F.array_join(F.slice("_labels", F.greatest(size - depth + 1, F.lit(1)), depth), ".")
    own = F.when(F.col("_host").rlike(ADDRESS), F.col("_host")).otherwise(before)
    domains = found.select("_host", F.concat(own, F.lit("."), F.when(own == before, suffix).otherwise("")).alias(out))
    return named.join(domains, "_host", "left").select(*df.columns, out)
