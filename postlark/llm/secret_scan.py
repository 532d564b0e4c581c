"""Secret scan with corpus-wide ownership: which candidates belong to one owner, which are copied examples.

Every text is searched for candidates of four kinds: assignments, access keys,
hex strings, and other long mixed tokens. The whole corpus then says how many
distinct owners and repositories hold each value. A value of many owners is a
widely copied example, however many repositories one owner puts it in; a key or an
assigned value of few owners is live. A mixed token must also look random, which
paths, identifiers and hyphenated words do not: their letters follow each other as
in words. The first three kinds are always reported, the fourth only where live.

Defined results: a null text is empty; a null owner or repository counts as one
value of its own; repeated rows give one result each; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.llm.common import fresh, travels, with_fields
from postlark.session import checkpointed

travels(__name__)

KINDS = ("assign", "access", "hex", "token")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
# a maximal run of at least the least length: the same as any run, short ones dropped
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
LEAST_ASSIGNED = 6
# every text with a match of one of the four has a match of this one
ANY = (
    r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]|[A-Za-z0-9+/_-]{20}"""
)
# from so many owners on, a value counts as widely copied
SHARED_OWNERS = 5
LIVE_ENTROPY = 3.0
# neighbours that are common in words of code and of the four languages; fixed values
PAIRS = frozenset(
    (
        "ab ac ad ag ai al am an ap ar as at au ba be bj bl bu by ca ce ch ci ck cl co ct da de di do du ea ec ed ee "
        "ef ei el em en ep er es et eu ex fa ff fi fo fr fu ge gs ha he hi ho ht ic id ie if ig il im in io ir is it "
        "ke la ld le lf li ll lo ls lt lu ly ma me mo mp na nc nd ne ng ni no ns nt nu ob oc od of ol om on op or os "
        "ot ou ow pa pe pl po pp pr pt qu ra re rg ri rm rn ro rr rs rt ru ry sa sc se sh si so sp ss st su ta te th "
        "ti to tr ts tt tu ty ue ul um un up ur us ut va ve wa wi xc xt yp "
    ).split()
)
# other neighbours are 0.05 to 0.4 of all in words and identifiers, about 0.8 in random strings;
# the score of a stretch is what it has of them above this share
ODD_SHARE, ODD_SCORE = 0.55, 2.0

SPAN = "struct<kind:int,start:int,end:int,value:string,value_start:int>"
SPAN_TYPE = pa.struct(
    [
        ("kind", pa.int32()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("value", pa.string()),
        ("value_start", pa.int32()),
    ]
)
# a value in very many texts is joined in so many parts
SALTS = 16


def most_odd(value: str) -> float:
    """Score of the stretch most unlike words; uncommon letter pairs and letters next to digits add to it, others take."""
    best = score = 0.0
    for a, b in zip(value, value[1:]):
        if a.isalpha() and b.isalpha():
            if a.islower() and b.isupper():  # a new word of an identifier
                continue
            score += -ODD_SHARE if (a + b).lower() in PAIRS else 1 - ODD_SHARE
        elif a.isalnum() and b.isalnum() and a.isdigit() != b.isdigit():
            score += 1 - ODD_SHARE
        best, score = max(best, score), max(score, 0.0)
    return best


def looks_random(value: str) -> bool:
    """Of mixed characters, with the entropy of a random string and a stretch unlike words."""
    if value.isalpha() or value.isdigit():
        return False
    counts = Counter(value).values()
    if -sum(c / len(value) * math.log2(c / len(value)) for c in counts) < LIVE_ENTROPY:
        return False
    return most_odd(value) >= ODD_SCORE


def find_spans(text: str) -> list[tuple]:
    """Candidates of one text: kind, start, end (code points), hash of the value, where the value begins."""
    found = [
        (0, m.start(), m.end(), m[2], m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED
    ]
    found += [(1, m.start(), m.end(), m[0], m.start()) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0], m.start()) for m in HEX.finditer(text)]
    base = sorted(x[1:3] for x in found)
    at = 0
    for m in TOKEN.finditer(text):
        while at < len(base) and base[at][1] <= m.start():
            at += 1
        if (at == len(base) or base[at][0] >= m.end()) and looks_random(m[0]):
            found.append((3, m.start(), m.end(), m[0], m.start()))
    return [
        (k, s, e, hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest(), at) for k, s, e, v, at in found
    ]


def _scan(text: str, names: tuple[str, str]):
    def scan(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            spans, keys = [None] * len(column), [None] * len(column)
            hit = pc.fill_null(pc.match_substring_regex(column, ANY), False)
            for i in pc.indices_nonzero(hit).to_pylist():
                value = column[i].as_py()
                if found := find_spans(value):
                    spans[i] = [dict(zip(("kind", "start", "end", "value", "value_start"), x)) for x in found]
                    keys[i] = hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(spans, pa.list_(SPAN_TYPE)), pa.array(keys, pa.string())],
                [*batch.schema.names, *names],
            )

    return scan


def scan_texts(docs: DataFrame, text_col: str, spans: str, key: str) -> DataFrame:
    """``docs`` with the candidates of each text and a hash of the text; both null where there are none."""
    schema = with_fields(docs.schema, f"{spans} array<{SPAN}>, {key} string")
    return docs.mapInArrow(_scan(text_col, (spans, key)), schema)


def ownership(candidates: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each ``value``; input has ``value, owner, repo``.

    Three aggregates from fine to coarse, so that a value of a third of all
    documents is combined before it moves.
    """
    places = candidates.groupBy("value", "owner", "repo").agg(F.count("*").alias("n"))
    owners = places.groupBy("value", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return owners.groupBy("value").agg(
        F.count("*").alias("n_owners"),
        F.sum("repos").alias("n_repos"),
        F.sum("n").alias("n_found"),
    )


def judged(hits: DataFrame, spans: str, key: str, owner: Column, repo: Column) -> DataFrame:
    """``key`` and the judged spans of each text: kind, start, end, value hash, owners, repos, live.

    A candidate is live, whatever its length, unless so many owners hold it that it is
    a copied example.
    """
    flat = hits.select(F.col(key).alias("key"), owner.alias("owner"), repo.alias("repo"), F.explode(spans).alias("s"))
    known = ownership(flat.select(F.col("s.value").alias("value"), "owner", "repo"))
    spread = flat.select("key", "s.*").distinct().withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    each = spread.join(known, ["value", "salt"])
    live = F.col("n_owners") < SHARED_OWNERS
    span = F.struct("start", "kind", "end", "value", "n_owners", "n_repos", live.alias("live"), "value_start")
    kept = each.filter((F.col("kind") < 3) | live)
    return kept.groupBy("key").agg(F.array_sort(F.collect_list(span)).alias("judged"))


def scan_secrets(docs: DataFrame, *, id_col="doc_id", text_col="text", owner_col="source", repo_col="lang") -> DataFrame:
    """One row per document: ``doc_id`` and ``secrets``, all spans by start and kind with their verdict.

    A repository is told apart by owner and ``repo_col``. Documents without a
    candidate take part in no shuffle.
    """
    narrow = docs.select(
        docs[id_col].alias("doc_id"),
        docs[owner_col].cast("string").alias("owner"),
        docs[repo_col].cast("string").alias("repo"),
        docs[text_col].alias("text"),
    )
    scanned = checkpointed(scan_texts(narrow, "text", "spans", "key").drop("text"))
    none = F.array().cast(
        "array<struct<start:int,kind:int,end:int,value:string,n_owners:bigint,n_repos:bigint,live:boolean,value_start:int>>"
    )
    hits = scanned.filter(F.col("key").isNotNull())
    verdicts = judged(hits, "spans", "key", F.col("owner"), F.col("repo"))
    found = hits.join(verdicts, "key", "left").select("doc_id", F.coalesce("judged", none).alias("secrets"))
    return scanned.filter(F.col("key").isNull()).select("doc_id", none.alias("secrets")).unionByName(found)


def _mask(text: str, spans: str, mask: str):
    def masked(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for value, found in zip(batch.column(at).to_pylist(), batch.column(spans).to_pylist()):
                end, parts = 0, []
                for s in found or []:
                    if s["live"]:
                        parts += [value[end : max(end, s["value_start"])], mask if s["end"] > end else ""]
                        end = max(end, s["end"])
                out.append("".join([*parts, value[end:]]))
            columns = [*batch.columns]
            columns[at] = pa.array(out, pa.string())
            keep = [i for i, n in enumerate(batch.schema.names) if n != spans]
            yield pa.RecordBatch.from_arrays(
                [columns[i] for i in keep], [batch.schema.names[i] for i in keep]
            )

    return masked


def mask_live(docs: DataFrame, mask: str = "[SECRET]", *, text_col="text", owner_col="source", repo_col="lang") -> DataFrame:
    """``docs`` with the value of every live-looking secret replaced; labels and widely copied examples stay.

    Only documents with a candidate are shuffled; the others pass unread by the join.
    """
    spans, key = fresh("found_spans", docs.columns), fresh("found_key", docs.columns)
    verdict = fresh("found_judged", [*docs.columns, spans, key])
    scanned = scan_texts(docs, text_col, spans, key)
    hits = scanned.filter(F.col(key).isNotNull())
    verdicts = judged(
        hits, spans, key, F.col(owner_col).cast("string"), F.col(repo_col).cast("string")
    ).toDF(key, verdict)
    joined = hits.drop(spans).join(verdicts, key, "left").select(*docs.columns, verdict)
    changed = joined.mapInArrow(_mask(text_col, verdict, mask), docs.schema)
    return scanned.filter(F.col(key).isNull()).select(*docs.columns).unionByName(changed)
