"""Divergence audit, FM-index deduplication and fill-in-the-middle against plain brute force."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlark.llm import divergence, fm_dedup, infill
from postlark.llm.common import fresh, shared_folder, text_buffer
from test_llm_operators import corpus, words

TEXT = "doc_id long, text string"


# --- FM-index -----------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=300), st.integers(0, 40))
def test_wavelet_tree_ranks_every_symbol(symbols, symbol):
    tree = fm_dedup.WaveletTree(np.array(symbols), 41)
    places = np.arange(len(symbols) + 1)
    expected = [symbols[:i].count(symbol) for i in places]
    assert tree.rank(np.full(len(places), symbol), places).tolist() == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=3, max_size=12), min_size=1, max_size=8, unique=True), st.integers(2, 3))
def test_index_keeps_the_earliest_window_of_each_kind(strings, window):
    texts = pa.array([" ".join(s) for s in strings])
    doc = np.arange(len(strings)) // 2
    place = np.where(np.arange(len(strings)) % 2, 50, 0)
    owner, offset, stays = fm_dedup.earliest_windows(texts, doc, place, window)
    places = defaultdict(list)
    for i, k in zip(owner.tolist(), offset.tolist()):
        places[strings[i][k : k + window]].append((doc[i], place[i] + k))
    for i, k, stay in zip(owner.tolist(), offset.tolist(), stays.tolist()):
        assert stay == (min(places[strings[i][k : k + window]]) == (doc[i], place[i] + k))


def cut_words(rows, window=20):
    """Rows of one id are one document; its texts ascend."""
    seen, out = set(), []
    for doc, text in sorted(((d, t or "") for d, t in rows if d is not None)):
        own = re.findall(r"[^\x20\x09-\x0D]+", text)
        gone = set()
        for i in range(len(own) - window + 1):
            key = tuple(own[i : i + window])
            if key in seen:
                gone |= set(range(i, i + window))
            seen.add(key)
        kept = " ".join(w for i, w in enumerate(own) if i not in gone)
        out.append((doc, len(own), len(gone), kept))
    return sorted(out)


@pytest.mark.parametrize(
    "options",
    [{}, {"block_bytes": 600, "shard_bytes": 900}, {"block_bytes": 900, "hot_blocks": 1}, {"window": 3, "anchor": 2}],
)
def test_repeated_windows_are_removed_exactly(spark, options):
    rows = corpus() + [(-5, "a b　c " * 30), (500, "b a " * 30), (501, "a b　c " * 31)]
    cut = fm_dedup.remove_repeated_windows(spark.createDataFrame(rows, TEXT), **options).collect()
    found = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in cut)
    assert found == cut_words(rows, options.get("window", 20))
    assert any(n for _, _, n, _ in found)
    for r in cut:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in itertools.pairwise(r.spans))


def test_one_id_in_several_rows_and_none(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(1, text), (1, text), (None, text), (2, "x " + text), (3, None), (4, ""), (5, " \t\n")]
    cut = fm_dedup.remove_repeated_windows(spark.createDataFrame(rows, TEXT)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in cut) == [
        (0, 25, 0), (1, 25, 0), (1, 25, 25), (2, 26, 25), (3, 0, 0), (4, 0, 0), (5, 0, 0),
    ]
    assert fm_dedup.remove_repeated_windows(spark.createDataFrame([], TEXT)).count() == 0


def test_clashing_columns_of_the_input_are_left_out(spark):
    rows = [(1, "a b c", 7, "k", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, block int, kept string, segment string")
    assert [tuple(r) for r in fm_dedup.remove_repeated_windows(docs).collect()] == [(1, 3, 0, [], "a b c")]


def test_a_long_document_is_ranked_in_pieces(spark):
    old = fm_dedup.RANKED, fm_dedup.PIECE_BYTES
    fm_dedup.RANKED, fm_dedup.PIECE_BYTES = 64, 100
    try:
        data, starts = text_buffer(pa.array([" ".join(f"w{i % 333}" for i in range(2000))]))
        own = fm_dedup.words_of(data, starts)
        hashes = fm_dedup.word_hashes(own)
        assert len(set(hashes.tolist())) == 333 and (hashes[:333] == hashes[333:666]).all()
        keys, first, last = fm_dedup.segments(hashes, own.per_row, 20, 8)
    finally:
        fm_dedup.RANKED, fm_dedup.PIECE_BYTES = old
    assert fm_dedup.each_window(first, last).tolist() == list(range(2000 - 19))
    by_window = dict(zip(fm_dedup.each_window(first, last).tolist(), np.repeat(keys, last - first + 1).tolist()))
    assert all(by_window[i] == by_window[i + 333] for i in range(1000))


# --- divergence ---------------------------------------------------------------------------


def audit(rows, min_docs=10, top=10):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = {s: {t: counts[lang, s][t] for t in kept} for a, s in groups if a == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}

        def shares(count):
            return {t: 1 + 10**9 * (count[t] + 2) // (sum(count.values()) + 2 * len(kept)) for t in kept}

        def price(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        for s in own:
            pairs = [(-sum(price(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(-price(p[s][t], q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))),
                                ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(found)}
    return out


def group_rows(n=150):
    import random

    rng = random.Random(5)
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["a", "b", "ç", "", None, "e", "f"])
        rows.append((words(rng, rng.randint(0, 40)) + rng.choice([" É", " Zeta-ZETA", "", " Ünder_score9x"]), lang, source))
    rows += [(None, "en", "empty"), ("", "xx", "a"), ("one", "xx", "b"), ("9 _ -", "yy", "alone")]
    return rows + rows[:5]


@pytest.mark.parametrize("options", [{}, {"shard_terms": 3, "block_sources": 2, "bucket_bytes": 500}, {"min_docs": 3, "top_terms": 2}])
def test_audit_equals_brute_force(spark, options):
    rows = group_rows()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    found = divergence.audit_sources(docs, shared_folder(spark, "audit"), **options)
    expected = audit(rows, options.get("min_docs", 10), options.get("top_terms", 10))
    assert {tuple(r) for r in found.collect()} == expected and len(expected) > 50


def test_audit_of_nothing_and_with_clashing_columns(spark):
    schema = "text string, lang string, source string, term string, shard int, n int, value int"
    empty = spark.createDataFrame([], schema)
    assert divergence.audit_sources(empty, shared_folder(spark, "audit")).count() == 0
    docs = spark.createDataFrame([("a", "l", "s", "t", 1, 2, 3), ("b", "l", "r", "t", 1, 2, 3)], schema)
    found = {tuple(r) for r in divergence.audit_sources(docs, shared_folder(spark, "audit")).collect()}
    assert found == {("l", "s", "pair", "r", 0, 1), ("l", "r", "pair", "s", 0, 1)}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=5, max_size=5), min_size=2, max_size=4))
def test_trees_give_the_leaves_side_by_side(rows):
    forest = divergence.Forest(np.array(rows))
    for a, b in itertools.combinations(range(len(rows)), 2):
        one, two, times = forest.leaf_pairs(a, b)
        found = Counter({(forest.leaves[x], forest.leaves[y]): n for x, y, n in zip(one, two, times)})
        found.pop((-1, -1), None)
        assert found == Counter(zip(rows[a], rows[b]))
    assert all(rows[a] != rows[b] or forest.roots[a] == forest.roots[b] for a in range(len(rows)) for b in range(a))


@given(st.integers(0, 10**15), st.integers(0, 10**15), st.integers(1, 10**6))
def test_shares_are_exact(count, more, n_terms):
    total = count + more
    expected = 1 + 10**9 * (count + 2) // (total + 2 * n_terms)
    assert divergence.shares(np.array([count]), total, n_terms).tolist() == [expected]


def test_tasks_hold_a_bounded_number_of_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a b a", "b c", "É a", ""], "lang": ["x", "x", "y", "z"], "source": ["s"] * 4})
    old, divergence.HELD_ROWS = divergence.HELD_ROWS, 3
    try:
        parts = list(divergence._count(2)(iter([batch, batch])))
    finally:
        divergence.HELD_ROWS = old
    assert len(parts) == 2 and all(p.schema == divergence.PACKED for p in parts)
    packed = pa.Table.from_batches(parts)
    rows = []
    for k in (0, 1):
        own = packed.filter(pa.compute.equal(packed["bucket"], k))
        rows += divergence._keep(2)(own).to_pylist() if len(own) else []
    found = {(r["lang"], r["source"], r["term"], r["n"], r["lang_n"], r["first"]) for r in rows}
    assert found == {
        ("x", "s", "a", 4, 4, True), ("x", "s", "b", 4, 4, True), ("x", "s", "c", 2, 2, True),
        ("y", "s", "É", 2, 2, True), ("y", "s", "a", 2, 2, True),
    }


# --- fill in the middle -------------------------------------------------------------------


def filled(doc, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 20:
        return (doc, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def test_fill_in_middle_equals_brute_force_and_comes_back(spark):
    rows = corpus(n=120) + [
        (-1, "a<P>b"), (None, "no id at all"), (None, None), (7, "😀é<S"), (8, "<"), (9, "a" * 70000), (10, "é9 " * 30000),
        (11, "P><S"), (12, "S>" * 40), (12, "S>" * 40),
    ]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], TEXT + ", form string, h1 int")
    found = infill.fill_in_middle(docs)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], str(r))
    assert sorted(map(tuple, found.collect()), key=key) == sorted((filled(*r) for r in rows), key=key)
    back = found.select("doc_id", infill.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(tuple, back), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    assert {r.form for r in found.collect()} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_nothing(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], TEXT)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("ab9 é😀", max_size=200), min_size=1, max_size=6), st.integers(0, 10**6))
def test_skip_lists_reach_every_rank(texts, draw):
    lists = infill.SkipLists(*text_buffer(pa.array(texts)))
    units = [re.findall(r"[A-Za-z]+|[^A-Za-z]", t) for t in texts]
    assert lists.n_units.tolist() == list(map(len, units))
    ranks = [draw % (len(u) + 1) for u in units]
    expected = [len("".join(u[:r])) for u, r in zip(units, ranks)]
    assert lists.points_before(np.array(ranks)).tolist() == expected
    for lane, below in zip(lists.lanes[1:], lists.lanes):
        assert len(lane.units) < len(below.units)


def test_fresh_names_stay_apart():
    assert fresh("Kept", ["kept", "KEPT_"]) == "Kept__"
