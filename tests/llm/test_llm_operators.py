"""Every operator against a plain brute-force version, with nulls, empty texts, ties, repeated rows and clashing names."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlark.llm import (
    decontaminate,
    language,
    pieces,
    records,
    secret_scan,
    simhash,
    suffix_dedup,
    surrogates,
    syncmers,
    trie_lm,
)
from postlark.llm.common import folds, id_and_text

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string"
SYLLABLES = ["the", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]


def words(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(seed=1, n=60):
    """Texts with copies, near copies, shared passages, nulls, empty and spaceless ones."""
    rng = random.Random(seed)
    texts = [words(rng, rng.randint(1, 120)) for _ in range(n)]
    passage = words(rng, 40)
    for i in range(0, n, 7):
        texts[i] = words(rng, 5) + " " + passage + " " + words(rng, rng.randint(0, 9))
    for i in range(3, n, 11):
        texts[i] = texts[i - 1]
    for i in range(5, n, 13):
        texts[i] = texts[i - 2] + " tail"
    texts += [None, "", " ", "x" * 200, "É" * 60, "É" * 61, "\n\tÀ b  c   d \n e", "x" * 200]
    return [(i * 3, t) for i, t in enumerate(texts)]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def texts_of(spark, rows):
    return id_and_text(frame(spark, rows))


# --- suffix arrays -------------------------------------------------------------------


def removed_bytes(rows, length=50):
    first, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if first.setdefault(data[i : i + length], doc) < doc:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = [(k, len(list(g))) for k, g in itertools.groupby(gone)]
        out[doc] = (len(data), sum(gone), sum(k for k, _ in spans), kept)
    return out


@pytest.mark.parametrize("block_docs,hot", [(1, 1), (16, 512), (1024, 512)])
def test_repeats_are_removed_exactly(spark, block_docs, hot):
    rows = corpus()
    cut = suffix_dedup.remove_repeats(texts_of(spark, rows), block_docs=block_docs, hot_blocks=hot).collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in cut}
    assert found == removed_bytes(rows)


def test_repeats_of_one_id_and_of_no_id(spark):
    text = "abcdefghij" * 7
    rows = [(1, text), (1, text), (None, text), (2, text), (2, None)]
    cut = suffix_dedup.remove_repeats(texts_of(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in cut) == [(0, 0), (1, 0), (1, 0), (2, 0), (2, 70)]
    assert suffix_dedup.remove_repeats(texts_of(spark, [])).count() == 0


def grouped(table, by):
    """The rows of an Arrow table by the value of a column."""
    values = table[by].to_pylist()
    return {v: table.filter(pc.equal(table[by], v)) for v in sorted(set(values))}


def message_bytes(rows, hot, block_docs=50, buckets=8):
    """Bytes that the steps send for each byte of text; the steps must remove what is repeated."""
    columns = {"doc_id": [i for i, _ in rows], "text": [t for _, t in rows], "block": [i // block_docs for i, _ in rows]}
    blocks = grouped(pa.table(columns), "block")
    keys = pa.concat_tables(suffix_dedup._send_keys(buckets, 50, 24)(b) for b in blocks.values())
    asked = pa.concat_tables(suffix_dedup._answer_keys(hot)(b) for b in grouped(keys, "bucket").values())
    answers = grouped(asked, "block")
    strings = [suffix_dedup._send_strings(buckets, 50, 24)(b, answers.get(k, asked[:0])) for k, b in blocks.items()]
    strings = pa.concat_tables(strings)
    spans = pa.concat_tables(suffix_dedup._find_repeats(50)(b) for b in grouped(strings, "bucket").values())
    found = grouped(spans, "block")
    cut = [suffix_dedup._cut_out(b, found.get(k, spans[:0])) for k, b in blocks.items()]
    removed = {d: n for t in cut for d, n in zip(t["doc_id"].to_pylist(), t["n_removed"].to_pylist())}
    assert removed == {d: out[1] for d, out in removed_bytes(rows).items()}
    return sum(t.nbytes for t in (keys, asked, strings, spans)) / sum(len(t) for _, t in rows)


@pytest.mark.parametrize("hot,most", [(512, 0.7), (2, 0.9)])
def test_messages_of_repeated_passages_stay_small(hot, most):
    rng = random.Random(5)
    passages = [words(rng, 60) for _ in range(20)]
    rows = [(i, words(rng, 150) + " " + rng.choice(passages) + " " + words(rng, 30)) for i in range(400)]
    assert message_bytes(rows, hot) < most


def test_messages_of_repeated_documents_stay_small():
    rng = random.Random(6)
    texts = [words(rng, 200) for _ in range(100)]
    # copies, some of them with a change, so that segments of both kinds meet
    rows = [(i, texts[i % 100] if i % 7 else texts[i % 100].replace(" ka", " ke", 3)) for i in range(500)]
    assert message_bytes(rows, 512) < 1


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=40), min_size=1, max_size=12), st.integers(2, 9))
def test_family_finds_all_earlier_windows(strings, length):
    strings = [s.encode() for s in strings if len(s) >= length]
    order = np.arange(len(strings)) // 2
    old, suffix_dedup.BATCH_STRINGS = suffix_dedup.BATCH_STRINGS, 3
    try:
        found = suffix_dedup.repeats(strings, np.zeros(len(strings), np.uint64), order, length)
    finally:
        suffix_dedup.BATCH_STRINGS = old
    got = {(i, k) for i, a, b in found for k in range(a, b + 1)}
    windows = [[s[k : k + length] for k in range(len(s) - length + 1)] for s in strings]
    expected = {
        (i, k)
        for i, own in enumerate(windows)
        for k, w in enumerate(own)
        if any(w in windows[j] for j in range(len(strings)) if order[j] < order[i])
    }
    assert got == expected


def test_anchors_of_a_long_document_are_cut_with_overlap():
    data = np.frombuffer(random.Random(2).randbytes((1 << 22) + 500), np.uint8)
    keys, first, last = suffix_dedup.block_anchors(data, np.array([0, len(data)]), 50, 24)
    assert first[0] == 0 and last[-1] == len(data) - 50
    assert np.array_equal(first[1:], last[:-1] + 1)


def test_a_long_document_behind_an_empty_one(spark):
    size = 17_000_000
    text = np.random.default_rng(3).integers(97, 123, size, np.uint8).tobytes().decode()
    alone = suffix_dedup.block_anchors(np.frombuffer(text.encode(), np.uint8), np.array([0, size]), 50, 24)
    behind = suffix_dedup.block_anchors(np.frombuffer(text.encode(), np.uint8), np.array([0, 0, 0, size]), 50, 24)
    assert all(np.array_equal(a, b) for a, b in zip(alone, behind))
    docs = frame(spark, [(1, ""), (2, text), (3, "head " + text[-5000:])])
    found = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).drop("kept").collect()}
    assert (found[2].n_bytes, found[2].n_removed) == (size, 0)
    assert [tuple(s) for s in found[3].spans] == [(5, 5005)]


# --- secrets -------------------------------------------------------------------------


def test_secret_spans_and_ownership(spark):
    key, own = "AKIA" + "Q1W2E3R4T5Y6U7I8", "zX9" + "k2Lm4Np6Qr8St0Uv1Wx3"
    copied = "9f86d081884c7d659a2feaa0c55ad015"
    rows = [(i, f'token = "{copied}"', f"s{i}", "en") for i in range(6)]
    rows += [(10, f"see {key} and {own}", "s1", "en"), (11, None, "s1", "en"), (12, "", None, None)]
    rows += [(13, "secret=token: abcdefgh api_key:abcde PASSWD='hunter22'", "s2", None)]
    rows += [(13, "secret=token: abcdefgh api_key:abcde PASSWD='hunter22'", "s2", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    found = {}
    for r in secret_scan.scan_secrets(docs).collect():
        found.setdefault(r.doc_id, []).append([(s.kind, s.start, s.end, s.live) for s in r.secrets])
    assert found[0] == [[(0, 0, 42, False), (2, 9, 41, False)]] or found[0][0][0][3] is False
    assert found[10] == [[(1, 4, 24, True), (3, 29, 52, True)]]
    assert found[11] == [[]] and found[12] == [[]]
    # the short value of `secret` uses up `token`; `abcde` is too short
    assert found[13] == [[(0, 37, 53, True)]] * 2
    masked = {r.doc_id: r.text for r in secret_scan.mask_live(docs).collect()}
    assert masked[10] == "see [SECRET] and [SECRET]"
    # the label stays, and so does what stands around the value
    assert masked[13] == "secret=token: abcdefgh api_key:abcde PASSWD='[SECRET]'"
    assert masked[0] == rows[0][1] and masked[11] is None and masked[12] == ""
    assert secret_scan.scan_secrets(docs.limit(0)).count() == 0


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(4)
    bits = ["token", "secret", "=", ": ", '"', "AKIA", "ABCDEF0123456789", "0123456789abcdef", " ", "x", "zq7", "API_KEY", "é"]
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    for _ in range(2000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        plain = [(0, m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        plain += [(1, m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        plain += [(2, m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        found = [s[:3] for s in secret_scan.find_spans(text) if s[0] < 3]
        assert sorted(found) == sorted(plain), text
        if plain:
            assert pa.compute.match_substring_regex(pa.array([text]), secret_scan.ANY)[0].as_py()


CLEAN = """src/main/java/com/example docs/getting-started/install state-of-the-art-technology
max_position_embeddings_size getElementById2Name/x X509CertificateFactory2Impl 2024-01-15-10-30-00-12
Donaudampfschifffahrt-Gesellschaft aujourd-hui-peut-etre-bientot desarrollo-de-aplicaciones-web
https://www.example.org/en/getting-started/installation_2"""


def test_paths_and_long_words_are_no_secrets(spark):
    docs = spark.createDataFrame([(1, CLEAN, "s1", "en")], "doc_id long, text string, source string, lang string")
    assert [r.secrets for r in secret_scan.scan_secrets(docs).collect()] == [[]]
    assert [r.text for r in secret_scan.mask_live(docs).collect()] == [CLEAN]


def test_random_tokens_look_random():
    rng = random.Random(8)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for letters in (upper + upper.lower() + "0123456789+/", upper.lower() + "0123456789", upper + "234567"):
        drawn = ["".join(rng.choices(letters, k=32)) for _ in range(500)]
        assert sum(map(secret_scan.looks_random, drawn)) >= 490
        assert sum(secret_scan.looks_random("docs/getting-started/install/" + x) for x in drawn) >= 470


def test_base_kinds_are_judged_by_owners(spark):
    plain = ["password = correcthorsebattery", "token: aaaaaaaaaaaab1", "key " + "0" * 23 + "1", "AKIA" + "B" * 16]
    rows = [(i, t, "s1", f"r{j}") for i, t in enumerate(plain) for j in range(6)]
    rows += [(9, "password = copiedexamplevalue", f"s{j}", "en") for j in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    for r in secret_scan.scan_secrets(docs).collect():
        # six repositories of one owner are one owner
        assert [(s.n_owners, s.n_repos, s.live) for s in r.secrets] == [(5, 5, False) if r.doc_id == 9 else (1, 6, True)]


# --- decontamination -----------------------------------------------------------------


def test_contained_items(spark):
    rng = random.Random(5)
    items = [(i, words(rng, n)) for i, n in enumerate((3, 5, 9, 20, 64, 65, 200))] + [(90, None), (91, ""), (3, None)]
    docs = []
    for i, text in items[:7]:
        own = text.split()
        docs.append((len(docs), words(rng, 300) + " " + text.upper() + ". " + words(rng, 30)))
        docs.append((len(docs), words(rng, 9) + " «" + " ".join(own[: math.ceil(len(own) * 0.9)]) + "» " + words(rng, 9)))
        docs.append((len(docs), words(rng, 9) + " " + " ".join(own[: len(own) // 2])))
    docs += [(100, None), (101, ""), (102, items[0][1] + "!"), (103, words(rng, 500)), (None, items[3][1]), (5, items[4][1])]
    expected = set()
    for row, (doc, text) in enumerate(docs):
        own = decontaminate.words_of(text or "")
        for item, body in items:
            asked = decontaminate.words_of(body or "")
            want, have = decontaminate.shingles(asked), decontaminate.shingles(own)
            if 0 < len(asked) < 5:
                have = {" ".join(own[k : k + len(asked)]) for k in range(len(own) - len(asked) + 1)}
            if want and len(want & have) >= 0.8 * len(want):
                expected.add((row, doc, item, len(want & have), len(want)))
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contained_items(texts_of(spark, docs), table).collect()
    assert Counter((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found) == Counter(x[1:] for x in expected)
    assert len(expected) >= 14
    kept = decontaminate.decontaminated(frame(spark, docs), table)
    assert kept.count() == len(docs) - len({x[0] for x in expected})
    assert decontaminate.contained_items(texts_of(spark, docs), table.limit(0)).count() == 0
    assert decontaminate.contained_items(texts_of(spark, []), table).count() == 0


def test_sketches_need_no_copy_of_the_package(tmp_path):
    """What is broadcast holds plain values; the task functions travel by value."""
    import pickle
    import subprocess
    import sys

    from pyspark import cloudpickle

    block = tuple(decontaminate.sketches_of([(1, "one two three four five six"), (2, "only two")]))
    (tmp_path / "block").write_bytes(pickle.dumps(block))
    (tmp_path / "task").write_bytes(cloudpickle.dumps((decontaminate._search, decontaminate._flag)))
    code = """
import pickle, sys, types
import pyarrow as pa
block, (search, flag) = pickle.load(open('block', 'rb')), pickle.load(open('task', 'rb'))
held = types.SimpleNamespace(value=block)
batch = pa.RecordBatch.from_pydict({'doc_id': [1, 2, 3], 'text': ['x one two three four five six', 'only two y', 'z']})
found = [r for b in search('text', held, ['doc_id'])([batch]) for r in b.to_pylist()]
assert sorted((r['doc_id'], r['item_id']) for r in found) == [(1, 1), (2, 2)], found
assert [r['doc_id'] for b in flag('text', held)([batch]) for r in b.to_pylist()] == [3]
assert 'postlark' not in sys.modules
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env={"PATH": "/usr/bin"})


# --- surrogates ----------------------------------------------------------------------


def test_surrogates_keep_form_distinctness_and_coreference(spark):
    rng = random.Random(6)
    mails = [f"{words(rng, 1)}.{i}@mail{i % 7}.example.com" for i in range(80)]
    phones = [f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}" for _ in range(30)]
    ips = [f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.3.{i}" for i in range(30)]
    card = "4111111111111111"
    rows = [(i, f"write {m} or {m.upper()}") for i, m in enumerate(mails)]
    rows += [(100 + i, f"call {p}, host {q}.") for i, (p, q) in enumerate(zip(phones, ips))]
    rows += [(200, f"card {card}, Mrs. Anna Schmidt and Mr Иван"), (201, None), (202, ""), (203, "none here"), (203, "none here")]
    docs = frame(spark, rows)
    found = surrogates.replace_entities(docs, b"key").collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    by = {r.doc_id: r for r in found}
    new = [re.findall(r"\S+@\S+", by[i].text) for i in range(80)]
    assert all(len(x) == 2 and x[0].upper() == x[1] and x[0].endswith(".example.com") for x in new)
    assert len({x[0] for x in new}) == 80 and not {x[0] for x in new} & set(mails)
    assert all(re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4}, host \d+\.\d+\.\d+\.\d+\.", by[100 + i].text) for i in range(30))
    held = by[200].text
    digits = re.search(r"\d{16}", held)[0]
    assert digits != card and surrogates._luhn(digits[:-1]) == int(digits[-1])
    assert re.fullmatch(r"card \d{16}, Mrs\. [A-Z][a-z]{2}a [A-Z][a-z]{6} and Mr [А-Я][а-яё]{3}", held)
    assert by[201].text is None and by[202].text == "" and by[203].text == "none here"
    assert surrogates.replace_entities(docs.limit(0), b"key").count() == 0


def test_mentions_of_a_name_and_numbers_with_country_codes(spark):
    rows = [
        (1, "Mr. John Smith came. John Smith spoke, and Smith left with Mrs. Anna Smith."),
        (2, "Dr. Smith and John stayed. Smithers too"),
        (3, "+33 1 42 68 53 00, +14155552671, +49 30 901820, +34 612 345 678; 2+33 1 2, +1 23"),
    ]
    found = {r.doc_id: r for r in surrogates.replace_entities(frame(spark, rows), b"key").collect()}
    m = re.fullmatch(r"Mr\. (\w+) (\w+) came\. (\w+) (\w+) spoke, and (\w+) left with Mrs\. (\w+) (\w+)\.", found[1].text)
    assert m[1] == m[3] != "John" and m[2] == m[4] == m[5] == m[7] != "Smith" and m[6] not in ("Anna", m[1])
    # the family name is the same person's in another text; a name without a title there is no entity
    assert found[2].text == f"Dr. {m[2]} and John stayed. Smithers too"
    assert len(found[3].entities) == 4 and found[3].text.endswith("; 2+33 1 2, +1 23")
    numbers = found[3].text.split("; ")[0].split(", ")
    for new, old in zip(numbers, rows[2][1].split("; ")[0].split(", ")):
        assert new != old and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", old)


def test_colliding_surrogates_draw_again(spark, monkeypatch):
    originals = spark.createDataFrame([(2, f"1.1.1.{i}") for i in range(40)], "kind int, value string")
    plain = surrogates.surrogate

    def narrow(kind, value, attempt, key):
        return "9.9.9." + plain(kind, value, attempt, key).split(".")[0][-2:]

    monkeypatch.setattr(surrogates, "surrogate", narrow)
    found = surrogates.assign_surrogates(originals, b"k").collect()
    assert len(found) == 40 and len({r.surrogate for r in found}) == 40


def test_small_forms_widen(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    three = ["".join(x) for x in itertools.islice(itertools.product("bcdfg", "aeiou", letters), 0, None, 3)][:200]
    values = [(4, f"m:{c}") for c in letters] + [(4, f"{g}:{n}") for n in three for g in "mf"]
    values += [(4, "n:արամ"), (4, "m:їв"), (0, "_@example.com"), (0, "...@example.com")]
    values += [(0, f"{c}@example.com") for c in letters]
    found = surrogates.assign_surrogates(spark.createDataFrame(values, "kind int, value string"), b"k").collect()
    assert Counter((r.kind, r.value) for r in found) == Counter(values)
    assert len({(r.kind, r.surrogate) for r in found}) == len(values)
    assert not {(r.kind, r.surrogate) for r in found} & {(k, v.split(":")[-1]) for k, v in values}
    by = {r.value: r.surrogate for r in found}
    assert re.fullmatch("[ա-ֆ]{4}", by["n:արամ"]) and not set(by["m:їв"]) & set("ї")
    assert all(surrogates.EMAIL.fullmatch(r.surrogate) for r in found if r.kind == 0)
    docs = frame(spark, [(1, "Mr. J. Smith, Dr. Արամ, _@example.com"), (2, "Dr. ԱՐԱՄ")])
    text = {r.doc_id: r.text for r in surrogates.replace_entities(docs, b"k").collect()}
    assert not re.search(r"Mr\. J\.|Արամ| _@", text[1])
    assert re.search(r"Dr\. (\w+)", text[1])[1].upper() == re.search(r"Dr\. (\w+)", text[2])[1]


def test_every_form_has_a_wider_one():
    for kind, value in enumerate(("_@example.com", "+1 555-123-4567", "1.2.3.4", "4111 1111 1111 1111", "m:j")):
        drawn = [surrogates.surrogate(kind, value, n, b"k") for n in range(40)]
        assert len(drawn[-1]) > len(value.split(":")[-1]) + 20 and len(set(drawn[20:])) == 20
    wide = re.sub(r"\D", "", surrogates.surrogate(3, "4111 1111 1111 1111", 8, b"k"))
    assert len(wide) == 19 and surrogates._luhn(wide[:-1]) == int(wide[-1])


# --- pieces --------------------------------------------------------------------------


def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab the▁ \n\tÉ.1"), st.characters(exclude_categories=("Cs",))), max_size=40))
def test_chunk_table_encodes_like_the_library(text):
    table = pieces._table(PIECE_MODEL)
    assert np.frombuffer(table.encode([text])[0], np.int32).tolist() == table.model.encode(text)


def test_pieces_round_trip(spark):
    rows = corpus()
    library = model()
    encoded = pieces.encode_pieces(texts_of(spark, rows), PIECE_MODEL)
    found = {r.doc_id: (list(r.ids), r.decoded) for r in pieces.decode_pieces(encoded, PIECE_MODEL).collect()}
    for doc, text in rows:
        ids = [*library.encode(text or ""), library.eos_id()]
        assert found[doc] == (ids, library.decode(ids))


def test_a_full_table_is_emptied(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_ENTRIES", 8)
    table = pieces.ChunkTable(PIECE_MODEL)
    for text in ("a b c d e f", "g h a b", "a b c d e f g h i j k l m n", "  x  "):
        assert np.frombuffer(table.encode([text])[0], np.int32).tolist() == table.model.encode(text)


# --- language ------------------------------------------------------------------------


def test_language_on_held_out_texts(spark):
    rng = random.Random(7)
    own = {"en": SYLLABLES, "de": ["der", "und", "keit", "sch", "ung", "ein"], "fr": ["eau", "le", "que", "é", "oi"]}
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(own))
        rows.append((i, " ".join("".join(rng.choices(own[lang], k=2)) for _ in range(rng.randint(3, 30))), lang))
    rows += [(900, None, "en"), (901, "123 !", "en"), (902, "", None), (903, "der und", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fitted = language.train_language(docs.filter(folds(F.col("doc_id"), 3) != 1))
    found = {r.doc_id: r for r in language.identify_language(docs, fitted).collect()}
    held = [r for r in rows[:300] if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert sum(found[r[0]].lang_pred == r[2] for r in held) / len(held) > 0.98
    assert [found[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "de"]
    assert all(0 <= r.score <= 1 for r in found.values()) and found[900].score == 0
    nothing = language.train_language(docs.limit(0))
    assert {r.lang_pred for r in language.identify_language(docs, nothing).collect()} == {"und"}


def test_a_prediction_depends_on_its_text_alone():
    rng = np.random.default_rng(0)
    matrix = np.log(rng.random((language.BUCKETS + 1, 3)))
    texts = ["ab", "a", "the house", "É", "b" * 50]
    together = language.predict(texts, ["x", "y", "z"], matrix)
    alone = [language.predict([t], ["x", "y", "z"], matrix) for t in texts]
    assert together[0] == [a[0][0] for a in alone]
    assert np.allclose(together[1], [a[1][0] for a in alone])


# --- records -------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.text(st.one_of(st.sampled_from("ab 's\n\t\x1c1.Éß,\u3000\xa0"), st.characters(exclude_categories=("Cs",))), max_size=30),
        min_size=1,
        max_size=4,
    )
)
def test_word_table_encodes_like_the_library(texts):
    from postlark.llm.common import worker_cache

    table = worker_cache("test_words", lambda: records.WordTable(WORD_MODEL))
    assert table.spelled is not None
    ids, begins = table.encode(pa.array(texts))
    for text, a, b in zip(texts, begins[:-1], begins[1:]):
        assert ids[a:b].tolist() == table.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé ßx'st.,-$(\n\r\t 709²½ªʼ\u0301\u3000αя字"), max_size=40), min_size=1, max_size=4))
def test_parts_of_words_encode_like_the_library(texts):
    from postlark.llm.common import worker_cache

    table = worker_cache("test_words", lambda: records.WordTable(WORD_MODEL))
    ids, begins = table.encode(pa.array(texts))
    for text, a, b in zip(texts, begins[:-1], begins[1:]):
        assert ids[a:b].tolist() == table.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_word_is_segmented_once_whatever_signs_follow():
    table = records.WordTable(WORD_MODEL)
    text = "So alpha, alpha. alpha*** (alpha) alpha\nalpha 12 alpha$ alpha! alpha-12"
    assert table.encode(pa.array([text]))[0].tolist() == table.tokenizer.encode(text, add_special_tokens=False).ids
    assert [p for p in sorted(table.ids) if "alpha" in p] == [" alpha", "alpha"]


def test_the_word_table_keeps_its_size(monkeypatch):
    table = records.WordTable(WORD_MODEL)
    texts = ["字" * 500, "and " + "y" * 500 + "'z end", "", "\n"]
    ids, begins = table.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == [
        table.tokenizer.encode(t, add_special_tokens=False).ids for t in texts
    ]
    assert max(map(len, table.ids)) <= records.HELD_CHARS
    monkeypatch.setattr(records, "TABLE_ENTRIES", 2)
    table.encode(pa.array(["one two three"]))
    assert len(table.ids) == 3


def test_added_tokens_stay_whole(tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_MODEL)
    tokenizer.add_tokens(["end.", "a-b"])
    tokenizer.save(str(tmp_path / "more.json"))
    table = records.WordTable(str(tmp_path / "more.json"))
    text = "the end. of a-b, end.\na-b"
    assert table.spelled is None
    assert table.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_records_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_MODEL)
    rows = [*corpus(), (None, "no id"), (6, "same id again")]
    folder = str(tmp_path / "records")
    index = records.write_records(texts_of(spark, rows), folder, WORD_MODEL, 2)
    read = records.read_records(records.corpus_starts(index), folder).collect()
    assert len(read) == len(rows)
    expected = Counter(
        (doc, tuple([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2])) for doc, text in rows
    )
    assert Counter((r.doc_id, tuple(r.ids)) for r in read) == expected
    in_order = sorted(read, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == sorted((r[0] for r in rows), key=lambda d: -1 if d is None else d)
    assert [r.start for r in in_order] == [0, *itertools.accumulate(len(r.ids) for r in in_order)][:-1]
    shuffled = records.read_records(index.orderBy(F.rand(1)).limit(9), folder).collect()
    assert {(r.doc_id, tuple(r.ids)) for r in shuffled} <= set(expected)


def test_a_damaged_record_is_refused():
    data = bytearray(records.frame(np.array([1, 2, 70_000], np.uint32)))
    assert records.unframe(bytes(data), 0)[0].tolist() == [1, 2, 70_000]
    data[14] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        records.unframe(bytes(data), 0)
    data[0] ^= 1
    with pytest.raises(ValueError, match="length"):
        records.unframe(bytes(data), 0)


# --- syncmers ------------------------------------------------------------------------


def test_edited_texts_and_likeness(spark):
    rows = corpus()
    found = {r.doc_id: r for r in syncmers.fingerprints(texts_of(spark, rows)).collect()}
    for (doc, text), (_, after) in zip(rows, [*rows[1:], rows[0]]):
        text, after = text or "", after or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        assert found[doc].n_chars == len(text)
        assert found[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= found[doc].near_next <= 1 and 0 <= found[doc].near_edited <= 1
        if text == after:
            assert found[doc].near_next == 1
        if text == edited:
            assert found[doc].near_edited == 1 and found[doc].fingerprint == found[doc].edited_fingerprint
    long = [r for r in found.values() if r.n_chars > 300]
    assert np.mean([r.near_edited for r in long]) > 0.4 > np.mean([r.near_next for r in long])


SPACELESS = re.compile("[\u3040-\u30ff\u4e00-\u9fff\u0e00-\u0e7f]")


def plain_units(text):
    out = []
    for run in re.findall(r"[^ \t\n\x0b\f\r]+", text):
        while run:
            free = SPACELESS.search(run)
            head = run[: free.start()] if free else run
            cut = re.match("[^\\0]*?[aeiouAEIOUtT0-9=/.,+-]", head, re.S)
            n = 1 if not head else len(head) if len(head) <= 24 or not cut else cut.end()
            out.append(run[:n])
            run = run[n:]
    return out


def chained(*numbers):
    """Spark's hash of several longs, each with the hash so far as its seed."""
    import xxhash

    seed = 42
    for x in numbers:
        seed = xxhash.xxh64_intdigest((x & (2**64 - 1)).to_bytes(8, "little"), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_sketch(text):
    """(hash, place) of the kept anchors, by hash."""
    import xxhash

    own = [xxhash.xxh64_intdigest(u.encode(), 42) for u in plain_units(text or "")]
    own = [h - (1 << 64) if h >> 63 else h for h in own]
    inner = [chained(*own[i : i + 2]) for i in range(len(own) - 1)]
    found = {}
    for i in range(len(own) - 3):
        if min(inner[i], inner[i + 2]) <= inner[i + 1]:
            found.setdefault((chained(inner[i], inner[i + 2]) & (2**64 - 1)) >> 33, i)
    if not found and own:
        return None  # the hash of the whole list
    ranked = sorted(found.items())
    return [x for k, x in enumerate(ranked) if k < 64 or x[0] < 1 << 28]


def plain_likeness(a, b):
    bounds = [1 << 31 if len(x) < 64 else max((1 << 28) - 1, x[-1][0]) for x in (a, b)]
    a, b = ({h: p for h, p in x if h <= min(bounds)} for x in (a, b))
    both = sorted((a[h], b[h]) for h in a.keys() & b.keys())
    follow = sum(i == 0 or both[i - 1][1] < p for i, (_, p) in enumerate(both))
    return follow / (len(a) + len(b) - len(both))


def prints(spark, rows):
    return {r.doc_id: r for r in syncmers.fingerprints(texts_of(spark, rows)).collect()}


def test_fingerprints_and_likeness_equal_brute_force(spark):
    rng = random.Random(5)
    rows = corpus(n=40) + [
        (1000, words(rng, 3000)), (1001, "漢字" + words(rng, 300) + "とかな" * 40), (1002, "A" * 40 + "CGT" * 60 + "x" * 99),
        (1003, " ".join(["same four words here"] * 60)),
    ]
    found = prints(spark, rows)
    for (doc, text), (after_id, after) in zip(rows, [*rows[1:], rows[0]]):
        text, after = text or "", after or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        own, changed, other = (plain_sketch(t) for t in (text, edited, after))
        if own is not None:
            assert found[doc].fingerprint == ",".join(f"{h:08x}:{p:x}" for h, p in own)
            if own and changed:
                assert found[doc].near_edited == pytest.approx(plain_likeness(own, changed))
            if own and other:
                assert found[doc].near_next == pytest.approx(plain_likeness(own, other))
    assert len(found[1000].fingerprint.split(",")) > 150


def test_a_passage_shared_by_long_texts_is_found(spark):
    rng = random.Random(12)
    rows = []
    for k in range(10):
        passage = words(rng, 200)
        for side in range(2):
            at = rng.randint(0, 20_000)
            rows.append((4 * k + side, " ".join([words(rng, at), passage, words(rng, 20_000 - at)])))
    found = prints(spark, rows)
    assert all(found[4 * k].near_next > 0 for k in range(10))
    assert all(found[4 * k + 1].near_next < 0.001 for k in range(10))


@pytest.mark.parametrize("alphabet", ["天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏", "ACGT", "กขคงจฉชซ"])
def test_a_spaceless_text_is_like_itself_behind_one_more_character(spark, alphabet):
    rng = random.Random(3)
    text = "".join(rng.choices(alphabet, k=4000))
    found = prints(spark, [(1, text), (2, alphabet[0] + text)])
    assert found[1].near_next > 0.95


def test_matches_count_in_order_only(spark):
    rng = random.Random(2)
    parts = [words(rng, 40) for _ in range(12)]
    found = prints(spark, [(1, " ".join(parts)), (2, " ".join(parts[::-1])), (3, " ".join(parts))])
    assert found[1].near_next < 0.95 and found[3].near_next == 1


def test_fingerprints_of_odd_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b"), (2, None)]
    found = syncmers.fingerprints(texts_of(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_chars, r.near_next) for r in found) == [(0, 3, 0.0), (1, 11, 0.0), (1, 11, 0.0), (2, 0, 0.0)]
    assert syncmers.fingerprints(texts_of(spark, [])).count() == 0
    single = syncmers.fingerprints(texts_of(spark, [(4, "a b c d")])).collect()
    assert [r.near_next for r in single] == [1.0]


# --- language model ------------------------------------------------------------------


def plain_scores(rows):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) + ["</s>"] for _, t in rows]
    learned = [d is not None and zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in rows]
    one, two = Counter(), Counter()
    for own, yes in zip(tokens, learned):
        if yes:
            one.update(own)
            two.update(zip(["<s>"] + own, own))
    n, v, starts = sum(one.values()), len(one), sum(learned)
    for own in tokens:
        p1 = [(one[w] + 1) / (n + v + 1) for w in own]
        totals = [starts, *[one[w] for w in own[:-1]]]
        pairs = [two[p] for p in zip(["<s>"] + own, own)]
        model = [(c + trie_lm.MASS * p) / (t + trie_lm.MASS) for c, p, t in zip(pairs, p1, totals)]
        yield len(own), sum(one[w] > 0 for w in own), n, sum(map(math.log10, p1)), sum(map(math.log10, model))


@pytest.mark.parametrize("block_docs,hot", [(8, 1 << 17), (2048, 3)])
def test_scores(spark, monkeypatch, block_docs, hot):
    monkeypatch.setattr(trie_lm, "HOT_CONTEXT", hot)
    rows = [*corpus(), (None, "the on the on"), (6, "Over AGAIN")]
    found = trie_lm.score_texts(texts_of(spark, rows), folds(F.col("doc_id"), 7) != 2, block_docs=block_docs).collect()
    got = sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found)
    expected = sorted((d or -1, *s) for (d, _), s in zip(rows, plain_scores(rows)))
    for g, e in zip(got, expected, strict=True):
        assert g[:4] == e[:4] and math.isclose(g[4], e[4], rel_tol=1e-9)
        assert e[5] - trie_lm.STEP * e[1] <= g[5] <= e[5] + 1e-9


def test_scores_without_training_texts(spark):
    rows = [(1, "a b"), (2, None)]
    found = trie_lm.score_texts(texts_of(spark, rows), F.lit(False)).collect()
    assert [(r.base_score, r.score, r.train_tokens, r.n_known) for r in found] == [(0.0, 0.0, 0, 0)] * 2
    assert trie_lm.score_texts(texts_of(spark, []), F.lit(True)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=300))
def test_elias_fano(values):
    values = np.sort(np.array(values, np.int64))
    assert np.array_equal(trie_lm.ef_get(trie_lm.elias_fano(values), np.arange(len(values))), values)
    assert np.array_equal(trie_lm.unpack(trie_lm.pack(values)), values)


# --- simhash -------------------------------------------------------------------------


def plain_fingerprint(text):
    from xxhash import xxh64_intdigest

    lowered = (text or "").translate(str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)}))
    own = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    found = [" ".join(own[i : i + 4]) for i in range(len(own) - 3)] or ([" ".join(own)] if own else [])
    hashes = [xxh64_intdigest(s.encode(), seed=42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    labels = list(range(len(values)))
    for a, b in itertools.combinations(range(len(values)), 2):
        if bin(values[a] ^ values[b]).count("1") <= radius and labels[a] != labels[b]:
            low, high = sorted((labels[a], labels[b]))
            labels = [low if x == high else x for x in labels]
    return labels


def test_simhash_components(spark):
    rows = [r for r in corpus() if r[1] != "x" * 200] + [(900, "Word one"), (901, None), (901, None)]
    found = simhash.near_duplicates(texts_of(spark, rows)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    labels = plain_components(prints, 4)
    low = {x: min(rows[i][0] for i, y in enumerate(labels) if y == x) for x in labels}
    expected = Counter((rows[i][0], f"{prints[i]:016x}", low[labels[i]]) for i in range(len(rows)))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == expected
    kept = simhash.keep_first(frame(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(low.values()))


@pytest.mark.parametrize("most", [2, 50, 100_000])
def test_links_of_fingerprints_in_cut_shards(spark, most):
    rng = random.Random(9)
    centers = [rng.getrandbits(64) for _ in range(12)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for c in centers for _ in range(12)}
    values = sorted(values | {0, (1 << 64) - 1, 15, 31})
    nodes = spark.createDataFrame([(simhash.signed(v), i) for i, v in enumerate(values)], "bits long, node long")
    cut = simhash.shards(nodes, 4, most).withColumn("part", F.col("bits").bitwiseAND(F.col("mask")))
    links = cut.repartition(3, "mask", "part").select("mask", "bits", "node").mapInArrow(simhash._links(4), "a long, b long")
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    assert [roots.get(i, i) for i in range(len(values))] == plain_components(values, 4)


def test_bk_tree_walk_finds_all_pairs(monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 64)
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 12, 300).astype(np.uint64)
    shards = rng.integers(0, 3, 300)
    pairs = [tuple(p) for a, b in simhash.walk(*simhash.grow(shards, values), values, 3) for p in zip(a.tolist(), b.tolist())]
    expected = [
        (i, j)
        for i, j in itertools.combinations(range(300), 2)
        if shards[i] == shards[j] and bin(int(values[i] ^ values[j])).count("1") <= 3
    ]
    assert sorted(pairs) == expected


def test_components_of_long_chains_and_stars(spark):
    chain = [(i + 1, i) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7)]
    roots = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert roots == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}}


def test_keep_first_of_empty_and_clashing_tables(spark):
    rows = [(1, "a b c d e", 5), (1, "a b c d e", 5), (2, "a b c d e", 5), (None, "a b c d e", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, copy_number int")
    assert sorted((r.doc_id or 0) for r in simhash.keep_first(docs).collect()) == [0, 1]
    assert simhash.keep_first(docs.limit(0)).count() == 0


# --- clashing names ------------------------------------------------------------------


def test_results_beside_columns_of_the_same_name(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "Mail a.b@corp.org to Mr. Smith", 5, "x", "y", 0.5, [7])],
        "doc_id long, text string, entities int, decoded string, lang_pred string, score double, ids array<int>",
    )
    found = surrogates.replace_entities(docs, b"k").first()
    assert found["entities"] == 5 and len(found["entities_"]) == 2 and "corp" not in found["text"]
    model = language.train_language(spark.createDataFrame([("aa", "x")], "text string, lang string"))
    row = language.identify_language(docs, model).first()
    assert (row["lang_pred"], row["score"], row["lang_pred_"]) == ("y", 0.5, "x")
    encoded = pieces.encode_pieces(docs, PIECE_MODEL).withColumn("decoded", F.lit("own"))
    row = pieces.decode_pieces(encoded, PIECE_MODEL).first()
    assert row["decoded"] == "own" and row["decoded_"] == "Mail a.b@corp.org to Mr. Smith"
    index = records.write_records(docs, str(tmp_path / "r"), WORD_MODEL, 2).withColumn("ids", F.lit(1))
    row = records.read_records(index, str(tmp_path / "r")).first()
    assert row["ids"] == 1 and row["ids_"][-1] == 2
