"""Text cleaning and tokenising. Null in, null out."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .emoji import remove_emoji

# What Python's ``re`` calls whitespace in a str pattern. Java's \s
# is ASCII only, so the class is spelled out.
WHITESPACE = (
    r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# The cleaning patterns.
LINK = f"http[^{WHITESPACE}]+"
SHORT_LINK = f"bit[^\\n]ly/[^{WHITESPACE}]+"
LINK_MARK_CHARACTERS = "[link]"
RETWEET_MARK = f"RT[{WHITESPACE}]@[A-Za-z]+[A-Za-z0-9_-]+"
PUNCTUATION = "!\"$%&'()*+,-./:;<=>?[]^_`{|}~•@#â"
TOKEN_CHARACTERS = "[a-z0-9]"
MIN_TOKEN_LENGTH = 3


def python_pattern(pattern: str) -> str:
    """A Java pattern of this package for Python's ``re``: code points are spelled ``\\x{..}`` there."""
    spelled = re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", pattern)
    # the span in front of an intersection only speeds Java up
    return re.sub(r"\[[^\[\]]*&&(\[[^\]]*\])\]", r"\1", spelled)


def remove_links(col: Column) -> Column:
    return F.regexp_replace(col, LINK, "")


def remove_short_links(col: Column) -> Column:
    return F.regexp_replace(col, SHORT_LINK, "")


def strip_link_mark(col: Column) -> Column:
    """Strip the characters ``[ l i n k ]`` from both ends (a set, not the word)."""
    return F.btrim(col, F.lit(LINK_MARK_CHARACTERS))


def remove_retweet_mark(col: Column) -> Column:
    return F.regexp_replace(col, RETWEET_MARK, "")


def remove_punctuation(col: Column) -> Column:
    return F.translate(col, PUNCTUATION, "")


def clean_text(col: Column, profile: str = "topics", emoji: str = "intended") -> Column:
    """The cleaning chains: ``topics`` drops punctuation, ``sentiment`` and ``corpus`` keep it."""
    if profile not in ("topics", "sentiment", "corpus"):
        raise ValueError(f"unknown cleaning profile {profile!r}")
    cleaned = strip_link_mark(remove_short_links(remove_links(col)))
    cleaned = remove_retweet_mark(cleaned)
    if profile == "topics":
        cleaned = remove_punctuation(cleaned)
    return remove_emoji(cleaned, emoji)


def tokenize(col: Column, min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """Lower-case runs of ASCII letters and digits, the long ones only.

    One regex pass finds what splitting on the gaps and dropping short pieces would.
    """
    run = F.lit(f"{TOKEN_CHARACTERS}{{{min_length},}}")
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), run, F.lit(0))


def split_raw_list(col: Column) -> Column:
    """Split an unparsed list literal on ``', '``; ``'[]'`` gives one element."""
    return F.split(col, ", ")


def text_lines(col: Column) -> Column:
    return F.split(col, "\n")
