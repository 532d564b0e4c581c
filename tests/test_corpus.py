"""Corpora against a plain-Python rendering of the rules, hot groups included."""

import hashlib
import math
import random
import re
from collections import defaultdict
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postlark.functions import kernels
from postlark.operators import corpus as cp

KEYS, ORDER = ["g"], ["date", "tweetid"]
START = datetime(2020, 11, 1)


def check_batches(corpus, batches, limit):
    """The properties that make a packing the greedy one."""
    assert "".join(batches) == corpus + "\n"
    for batch, after in zip(batches, batches[1:]):
        assert len(batch) + after.index("\n") + 1 > limit
    for batch in batches:
        assert len(batch) <= limit or batch.count("\n") == 1


@pytest.fixture
def many_chunks(spark):
    """Cut every group into several chunks."""
    settings = {
        "spark.sql.shuffle.partitions": "9",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


# texts in order, and the cleaned corpus they form together
CASES = {
    "plain": (["hello", "a\nb", ""], "hello\na\nb\n"),
    "links": (["see http://t.co/a now", "bit.ly/b", "x"], "see  now\n\nx"),
    "mark_in_text": (["RT @al_1 hi", "so RT @bob: yes"], " hi\nso : yes"),
    "mark_across": (["hello RT", "@bob there"], "hello  there"),
    "mark_across_many": (["RT", "@SMART", "@xRT", "kin", "end"], "\n@xRT\nkin\nend"),
    "short_name": (["RT", "@b c"], "RT\n@b c"),
    "ends_stripped": (["[link] first", "last link]"], " first\nlast "),
    "inner_kept": (["a", "[link] b", "c"], "a\n[link] b\nc"),
    "one": (["kin"], ""),
}


def posts(n=240):
    """A hot group of many texts, the small cases, and a group without text."""
    rows = [("hot", START + timedelta(hours=i // 4), i, f"RT @u{i}a word{i} http://t.co/{i}\nend {i}") for i in range(n)]
    for k, (group, (texts, _)) in enumerate(CASES.items()):
        rows += [(group, START + timedelta(hours=i), 1000 * (k + 1) + i, t) for i, t in enumerate(texts)]
    rows.append(("none", START, 90_002, None))
    random.Random(3).shuffle(rows)
    return rows


def expected(n=240):
    hot = "\n".join(f" word{i} \nend {i}" for i in range(n))
    return {"hot": hot, **{g: corpus for g, (_, corpus) in CASES.items()}}


def frame(spark, rows):
    return spark.createDataFrame(rows, "g string, date timestamp, tweetid long, text string").repartition(5)


def test_lines_of_hot_groups_with_marks_across_texts(many_chunks):
    lines = cp.corpus_lines(frame(many_chunks, posts()), KEYS, ORDER).collect()
    got = defaultdict(list)
    for r in sorted(lines, key=lambda r: (r["g"], r["date"], r["tweetid"], r["line_no"])):
        got[r["g"]].append(r["line"])
    assert {g: "\n".join(v) for g, v in got.items()} == expected()


PARTS = ["RT", "RT ", "@bob", "@b", "@kin", "@blink", "x", "link", "\n", " ", "RTRT", "5", "\ufe0f\u20e3", "\U0001f600", "RT @al", "@SMART"]


def whole_corpus(texts):
    """The rules on one string."""
    corpus = "\n".join(re.sub(r"bit[^\n]ly/\S+", "", re.sub(r"http\S+", "", t)) for t in texts)
    corpus = re.sub(r"RT\s@[A-Za-z]+[A-Za-z0-9_-]+", "", corpus.strip("[link]"))
    return re.sub("[#*0-9]\ufe0f?\u20e3|[\ufe0f\u20e3\U0001f600]+", "", corpus)


@pytest.mark.parametrize("seed", range(4))
def test_marks_across_texts_and_chunks_equal_one_string(many_chunks, seed):
    rng = random.Random(seed)
    groups = {}
    for g in range(12):
        n = rng.choice([1, 2, 3, 5, 60])
        groups[f"g{g}"] = ["".join(rng.choices(PARTS, k=rng.randint(0, 3))) for _ in range(n)]
    # a line that goes through many texts, and so through several chunks
    groups["chain"] = ["a RT", *[f"@n{'x' * i} RT" for i in range(40)], "@end", "b"]
    groups["turns"] = ["RT", *["@xyRT"] * 41]
    rows = [(g, START + timedelta(hours=i), i, t) for g, texts in groups.items() for i, t in enumerate(texts)]
    rng.shuffle(rows)
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": rng.choice(["1", "2", "3", "10000"])}
    before = many_chunks.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    many_chunks.conf.set(*settings.popitem())
    try:
        packed = cp.packed_corpora(frame(many_chunks, rows), KEYS, ORDER, 12)
        batches = cp.corpus_batches(packed, KEYS).collect()
        sizes = {r["g"]: (r["n_chars"], r["n_batches"]) for r in packed.groups.collect()}
        lines = cp.corpus_lines(frame(many_chunks, rows), KEYS, ORDER).collect()
    finally:
        many_chunks.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for g, texts in groups.items():
        want = whole_corpus(texts)
        own = sorted((r for r in lines if r["g"] == g), key=lambda r: (r["date"], r["tweetid"], r["line_no"]))
        assert "\n".join(r["line"] for r in own) == want
        cut = [r["batch"] for r in sorted((r for r in batches if r["g"] == g), key=lambda r: r["batch_no"])]
        assert sizes[g] == (len(want), len(cut))
        check_batches(want, [b for b in cut if b], 12)


def test_tasks_copy_texts_in_slices_of_bounded_size():
    n = 2_500
    rows = {name: [None] * n for name in kernels.CARRIED} | {
        "text": ["x"] * n, "_group": ["g"] * n, "_mark": pa.array([0] * n, pa.int8()),
        "_later": [False] * n, "_earlier": [False] * n, "_open": [False] * n,
    }
    batch = pa.RecordBatch.from_pydict(rows)
    placed = list(kernels.place_texts(["text"])(iter([batch, batch])))
    assert sum(b.num_rows for b in placed) == 2 * n
    assert all(b.num_rows <= kernels.TEXTS_AT_ONCE + 2 for b in placed)
    places = [x for b in placed for x in b.column("_place").to_pylist()]
    assert places == [kernels.FIRST, *[0] * (2 * n - 2), kernels.LAST]
    texts = pa.RecordBatch.from_pydict({"text": ["one two three"] * 250})
    found = list(kernels.summaries("[a-z]{3,}", 150, 100)(iter([texts])))
    assert sum(b.num_rows for b in found) == 250 and all(b.num_rows <= 100 for b in found)


def test_texts_are_cleaned_after_the_partitioner_has_sampled_them(spark):
    cleaned = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        cleaned.add(1)
        return text

    def then(rows):
        return rows.withColumn("text", seen("text"))

    cp._in_chunks(frame(spark, posts()).filter("text is not null"), KEYS, ORDER, then)
    assert cleaned.value == len([r for r in posts() if r[3] is not None])


def test_lengths(spark):
    lines = cp.corpus_lines(frame(spark, posts()), KEYS, ORDER)
    lengths = {r["g"]: (r["n_lines"], r["n_chars"]) for r in cp.corpus_lengths(lines, KEYS).collect()}
    assert lengths == {g: (t.count("\n") + 1, len(t)) for g, t in expected().items()}


@pytest.mark.parametrize("limit", [1, 8, 40])
def test_packing_is_greedy_across_chunks(many_chunks, limit):
    rng = random.Random(limit)
    rows = []
    for group, n in (("hot", 400), ("a", 20), ("b", 1), ("c", 60)):
        for i in range(n):
            rows.append((group, i, "x" * rng.choice([0, 1, 3, 5, 9, 60 if rng.random() < 0.1 else 2])))
    lines = many_chunks.createDataFrame(rows, "g string, i int, line string").repartition(4)
    result = cp.pack_lines(lines, ["g"], ["i"], limit)
    texts = {(r["g"], r["batch_no"]): r["batch"] for r in cp.batch_texts(result, ["g"], ["i"]).collect()}
    sizes = cp.batch_sizes(result, ["g"]).collect()
    for group in ("hot", "a", "b", "c"):
        own = {k: b for (g, k), b in texts.items() if g == group}
        batches = [own[k] for k in range(len(own))]
        # an overlong first line leaves an empty batch before it
        assert (batches[0] == "") == (len(batches[1 if batches[0] == "" else 0].split("\n")[0]) + 1 > limit)
        check_batches("\n".join(x for g, _, x in rows if g == group), [b for b in batches if b], limit)
        assert {r["batch_no"]: r["batch_chars"] for r in sizes if r["g"] == group} == {
            k: len(b) for k, b in enumerate(batches)
        }


def test_gate(many_chunks):
    want = expected()
    limit, size, n = 120, 30, 4
    rows = frame(many_chunks, posts())
    gated = {r["g"]: r for r in cp.gate(rows, KEYS, ORDER, limit, size, n, seed=1).collect()}
    assert gated.keys() == want.keys()
    for group, r in gated.items():
        assert r["n_chars"] == len(want[group]) and r["sampled"] == (len(want[group]) > limit)
        if not r["sampled"]:
            assert r["text"] == want[group]
    packed = cp.packed_corpora(rows.filter("g = 'hot'"), KEYS, ORDER, size)
    texts = {r["batch_no"]: r["batch"] for r in cp.corpus_batches(packed, KEYS).collect()}
    lines = cp.corpus_lines(rows.filter("g = 'hot'"), KEYS, ORDER)
    again = cp.batch_texts(cp.pack_lines(lines, KEYS, [*ORDER, "line_no"], size), KEYS, [*ORDER, "line_no"])
    assert texts == {r["batch_no"]: r["batch"] for r in again.collect()}
    assert len(texts) > n
    draw = sorted(texts, key=lambda k: hashlib.md5(f"1|hot|{k}".encode()).hexdigest())
    assert gated["hot"]["text"] == "\n".join(texts[k] for k in draw[:n])


def test_gate_puts_cleaned_down_corpora_together(many_chunks):
    rows = [("g", START + timedelta(hours=i), i, f"{i} http://{'x' * 50}") for i in range(20)]
    row = cp.gate(frame(many_chunks, rows), KEYS, ORDER, 200, 30).collect()[0]
    assert not row["sampled"] and row["text"] == "\n".join(f"{i} " for i in range(20))


def test_sample_takes_all_if_fewer(spark):
    batches = spark.createDataFrame(
        [("a", i) for i in range(30)] + [("b", i) for i in range(3)], "g string, batch_no long"
    )
    drawn = cp.sample_batches(batches, KEYS, 12, seed=7).collect()
    again = cp.sample_batches(batches.repartition(3), KEYS, 12, seed=7).collect()
    other = cp.sample_batches(batches, KEYS, 12, seed=8).collect()
    picks = lambda rows: {(r["g"], r["batch_no"]) for r in rows}
    assert sum(r["g"] == "a" for r in drawn) == 12 and sum(r["g"] == "b" for r in drawn) == 3
    assert picks(drawn) == picks(again) != picks(other)


def greedy(text, most, least):
    """The rule of the summary, written out by trying every line each time."""
    lines = [x for x in text.split("\n") if re.findall("[a-z0-9]{3,}", x.lower())]
    tokens = [set(re.findall("[a-z0-9]{3,}", x.lower())) for x in lines]
    weight = {
        t: round(round(math.log((len(lines) + 1) / (sum(t in own for own in tokens) + 1)), 9) * 1e9)
        for own in tokens
        for t in own
    }
    chosen, seen, used = {}, set(), 0

    def value(k):
        return sum(weight[t] for t in tokens[k] - seen) / len(lines[k].split())

    while True:
        left = [k for k in range(len(lines)) if k not in chosen]
        fits = [k for k in left if used + len(lines[k].split()) <= most]
        if not fits:
            break
        best = max(fits, key=lambda k: (value(k), -k))
        if value(best) <= 0 and used >= least:
            break
        chosen[best] = lines[best]
        used += len(lines[best].split())
        seen |= tokens[best]
    if used < least and left:
        best = max(left, key=lambda k: (value(k), -k))
        chosen[best] = " ".join(lines[best].split()[: most - used])
        used = most
    return "\n".join(chosen[k] for k in sorted(chosen)), used


def summarised(spark, rows, *budget):
    df = spark.createDataFrame(rows, "g string, text string")
    return {r["g"]: (r["summary"], r["n_words"]) for r in cp.extractive_summary(df, KEYS, *budget).collect()}


def test_summaries_equal_the_greedy_rule(spark):
    rng = random.Random(11)
    vocabulary = [f"word{i}" for i in range(40)] + ["to", "a"]
    rows = []
    for g in range(60):
        sizes = [rng.choice([1, 3, 8, 20, 90, 200]) for _ in range(rng.randint(0, 14))]
        rows.append((str(g), "\n".join(" ".join(rng.choices(vocabulary, k=n)) for n in sizes)))
    got = summarised(spark, rows)
    for g, text in rows:
        assert got[g] == greedy(text, 150, 100)
        available = sum(len(x.split()) for x in text.split("\n") if re.findall("[a-z0-9]{3,}", x.lower()))
        assert min(100, available) <= got[g][1] <= 150


def test_summary_passes_over_what_does_not_fit(spark):
    text = "\n".join(" ".join(f"{a}{i:02d}" for i in range(n)) for a, n in (("aa", 90), ("bb", 80), ("cc", 30), ("dd", 20)))
    summary, n_words = summarised(spark, [("a", text)])["a"]
    assert n_words == 140 and [x[:2] for x in summary.split("\n")] == ["aa", "cc", "dd"]


def test_summary_keeps_order_and_leaves_repeats(spark):
    text = "\n".join(["the the the", "rare words here", "the the", "unique thing", "rare words here", "the word " * 100, ""])
    assert summarised(spark, [("a", text)], 6, 1)["a"] == ("rare words here\nunique thing", 5)


def test_every_text_has_a_summary(spark):
    rows = [("long", "\n".join(["alpha beta gamma " * 70] * 3)), ("blank", "a\n!"), ("short", "alpha beta"), ("none", None)]
    got = summarised(spark, rows)
    assert got == {
        "long": (" ".join(["alpha beta gamma"] * 50), 150), "blank": ("", 0), "short": ("alpha beta", 2), "none": ("", 0),
    }
