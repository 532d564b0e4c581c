"""Document fingerprints from closed syncmers, in DataFrame expressions only.

A text is a sequence of units: runs of non-space characters, or single characters of
scripts that write without spaces. A very long run is cut behind characters of a fixed
set, so a unit depends on what it holds and not on where a run began. Of each k
successive units the inner runs of s units are hashed; the k units are a closed syncmer
if the smallest inner hash stands at the first or last place. That depends on the k
units alone, so equal passages choose equal anchors wherever they stand.

A fingerprint holds hash and place of the anchors whose hash lies under a fixed fraction
of all hashes, and the smallest 64 at least, so it grows with the text and a passage
shared by long texts stays in both. Two fingerprints are compared up to the bound below
which both are complete: anchors are matched by hash, and the likeness is the number of
matches that follow one another in both texts, as a share of all anchors of the two.

Defined results: a null text is empty; a text without a unit has an empty
fingerprint, wholly like another empty one and unlike the rest; a text without an
anchor is hashed as a whole; an anchor that repeats counts where it stands first; equal
texts have equal fingerprints; of rows that share an id the one with the smallest text
hash is the next document of the row before, and each gets a row; a row without an id
has no next document: its edited text only loses its end and `near_next` is 0; an
empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlark.session import checkpointed

K, S, LEAST = 4, 2, 64
# hashes have 31 bits; one in eight anchors is kept beyond the least number
HASH_BITS, KEPT_UNDER = 31, 1 << 28
# an anchor is one number: hash above, place below; a free bit between tells two texts apart
PLACE_BITS = 32
# scripts that write without spaces: Thai, Lao, Myanmar, Khmer, Han and kana
SPACELESS = (
    r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
)
CUTS, LONG_RUN = "aeiouAEIOUtT0-9=/.,+-", 24


def _unit(run: str) -> str:
    """A run of non-space characters, cut behind the fixed ones if it is long."""
    return rf"{run}{{1,{LONG_RUN}}}+(?!{run})|{run}*?[{CUTS}]|{run}+"


SPACED_UNIT = _unit(r"\S")
UNIT = rf"[{SPACELESS}]|{_unit(rf'[^\s{SPACELESS}]')}"


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def units(text: Column) -> Column:
    """The units of a text; both patterns give the same where no spaceless character occurs."""
    mixed = (F.octet_length(text) > F.length(text)) & text.rlike(f"[{SPACELESS}]")
    spaced = F.regexp_extract_all(text, F.lit(SPACED_UNIT), F.lit(0))
    return F.when(mixed, F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))).otherwise(spaced)


def _inner(hashes: Column) -> Column:
    """Hash of the ``S`` = 2 units at each place; the last one is of one unit and never used."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + 1)))


def _closed(inner: Column, i: Column) -> Column:
    """Whether the k units from place ``i`` are closed: a smallest inner hash stands at an edge."""
    edge = F.least(F.get(inner, i), F.get(inner, i + (K - S)))
    middle = [F.get(inner, i + k) for k in range(1, K - S)]
    return edge <= (F.least(*middle) if len(middle) > 1 else middle[0])


def _coded(hash64: Column, place: Column) -> Column:
    high = F.shiftrightunsigned(hash64, 64 - HASH_BITS)
    return F.shiftleft(high, PLACE_BITS).bitwiseOR(place.cast("bigint"))


def hash_of(code: Column) -> Column:
    return F.shiftright(code, PLACE_BITS)


def place_of(code: Column) -> Column:
    return code.bitwiseAND((1 << (PLACE_BITS - 1)) - 1)


def anchors(text: Column) -> Column:
    """Closed syncmers of a text in the order of their hash and place, one number each."""

    def chosen(inner):
        last = F.size(inner) - K
        each = F.transform(
            inner,
            lambda _, i: F.when(
                (i <= last) & _closed(inner, i),
                _coded(F.xxhash64(F.get(inner, i), F.get(inner, i + (K - S))), i),
            ),
        )
        return F.sort_array(F.filter(each, lambda x: x.isNotNull()))

    hashes = F.transform(units(text), lambda u: F.xxhash64(u))
    whole = lambda h: F.array(_coded(F.xxhash64(h), F.lit(0)))

    def found(h):
        return bound(
            bound(_inner(h), chosen), lambda f: F.when((F.size(f) == 0) & (F.size(h) > 0), whole(h)).otherwise(f)
        )

    return bound(hashes, found)


def sketch(text: Column) -> Column:
    """The anchors of a fingerprint: each hash where it stands first, all under the bound and the smallest."""

    def first(codes):
        return F.filter(codes, lambda x, i: (i == 0) | (hash_of(x) != hash_of(F.get(codes, i - 1))))

    kept = bound(anchors(text), first)
    return F.filter(kept, lambda x, i: (i < LEAST) | (hash_of(x) < KEPT_UNDER))


def _complete_under(codes: Column) -> Column:
    """The hash up to which a sketch holds all anchors of its text."""
    return F.when(F.size(codes) < LEAST, F.lit(1 << HASH_BITS)).otherwise(
        F.greatest(F.lit(KEPT_UNDER - 1).cast("bigint"), hash_of(F.element_at(codes, -1)))
    )


def likeness(a: Column, b: Column) -> Column:
    """Matches in the same order in both, as a share of the anchors of both; 1 for two empty sketches."""
    second = 1 << (PLACE_BITS - 1)  # the free bit: anchors of b stand behind those of a with the same hash

    def shared(all_codes: Column) -> Column:
        """Places in a and b of each common hash, in the order of a."""
        pairs = F.transform(
            all_codes,
            lambda x, i: F.when(
                hash_of(x) == hash_of(F.get(all_codes, i + 1)),
                F.shiftleft(place_of(x), PLACE_BITS).bitwiseOR(place_of(F.get(all_codes, i + 1))),
            ),
        )
        return F.sort_array(F.filter(pairs, lambda p: p.isNotNull()))

    def measure(limit: Column) -> Column:
        under = [F.filter(x, lambda code: hash_of(code) <= limit) for x in (a, b)]
        marked = F.concat(under[0], F.transform(under[1], lambda code: code.bitwiseOR(second)))

        def share(codes: Column) -> Column:
            def of(pairs: Column) -> Column:
                follows = F.filter(pairs, lambda p, i: (i == 0) | (place_of(p) > place_of(F.get(pairs, i - 1))))
                return F.size(follows) / (F.size(codes) - F.size(pairs))

            return bound(shared(codes), of)

        return bound(F.sort_array(marked), share)

    limit = F.least(_complete_under(a), _complete_under(b))
    one_empty = F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(0.0)
    return F.when((F.size(a) == 0) | (F.size(b) == 0), one_empty).otherwise(bound(limit, measure))


def hexed(codes: Column) -> Column:
    """``hash:place`` of each anchor in hexadecimal, comma-joined."""
    text = lambda x: F.concat_ws(":", F.lpad(F.lower(F.hex(hash_of(x))), 8, "0"), F.lower(F.hex(place_of(x))))
    return F.array_join(F.transform(codes, text), ",")


def predecessors(docs: DataFrame) -> DataFrame:
    """For each distinct id ``at``, ``row_hash`` of its first row, and id and length of the document before it.

    The document before the first is the last. Ids are ordered in ranges; only one
    row per range is ordered in one place. ``docs`` has ``doc_id, text``.
    """
    narrow = docs.select("doc_id", F.length("text").alias("n"), F.xxhash64("text").alias("h"))
    ids = narrow.groupBy("doc_id").agg(F.max("n").alias("n"), F.min("h").alias("row_hash"))
    ranged = ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id())
    # the parts are read again and must not change; new names, since a checkpoint keeps the attributes
    ranged = checkpointed(ranged).select(F.col("doc_id").alias("at"), F.col("n").alias("at_n"), "row_hash", "part")
    ends = ranged.groupBy("part").agg(F.max("at").alias("last_id"), F.max_by("at_n", "at").alias("last_n"))
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ends.select(
        F.col("part").alias("end_part"),
        F.coalesce(F.lag("last_id").over(order), F.last("last_id").over(whole)).alias("end_id"),
        F.coalesce(F.lag("last_n").over(order), F.last("last_n").over(whole)).alias("end_n"),
    )
    within = Window.partitionBy("part").orderBy("at")
    rows = ranged.withColumn("prev_id", F.lag("at").over(within)).withColumn("prev_n", F.lag("at_n").over(within))
    return rows.join(before, rows["part"] == before["end_part"]).select(
        "at",
        "row_hash",
        F.coalesce("prev_id", "end_id").alias("prev_id"),
        F.coalesce("prev_n", "end_n").alias("prev_n"),
    )


def with_edits(docs: DataFrame) -> DataFrame:
    """``doc_id, text, sketch`` of ``docs`` (``doc_id, text``) with the edited text and the next document's sketch.

    The edited text has its last quarter replaced by the head of the next
    document. Texts are shuffled once; a document sends its neighbour only the
    head that the neighbour needs, and its sketch.
    """
    known = docs.filter("doc_id is not null")
    # no sketch before the exchange: two plans with the same lambdas do not count as one exchange
    # renamed, or one plan keeps an alias that the other drops
    rows = known.select(F.col("doc_id").alias("row_id"), "text").repartition("row_id")
    order = predecessors(known)
    # the row with the smallest hash; as an equality it would be a join key and texts would move again
    sent = rows.join(order, rows["row_id"] == order["at"]).filter(F.xxhash64("text") <= F.col("row_hash"))
    sent = sent.select(
        F.col("prev_id").alias("for_id"),
        F.left(F.col("text"), F.floor(F.col("prev_n") / 4).cast("int")).alias("head"),
        sketch(F.col("text")).alias("next_sketch"),
    ).dropDuplicates(["for_id"])
    joined = rows.join(sent, rows["row_id"] == sent["for_id"], "left").select(
        F.col("row_id").alias("doc_id"), "text", "head", "next_sketch"
    )
    alone = docs.filter("doc_id is null").select(
        "doc_id", "text", F.lit("").alias("head"), F.lit(None).cast("array<bigint>").alias("next_sketch")
    )
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.left(F.col("text"), n - quarter), F.left(F.col("head"), quarter))
    return joined.unionByName(alone).select(
        "doc_id", "text", sketch(F.col("text")).alias("sketch"), "next_sketch", edited.alias("edited")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness."""
    rows = with_edits(docs).withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        hexed(F.col("sketch")).alias("fingerprint"),
        hexed(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        F.coalesce(likeness(F.col("sketch"), F.col("next_sketch")), F.lit(0.0)).alias("near_next"),
    )
