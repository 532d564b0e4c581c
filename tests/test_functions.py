import json
import random
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from postlark.functions import kernels, literals, text, topics, urls, values
from postlark.operators import topics as topic_operators
from postlark.functions.emoji import remove_emoji
from postlark.schema import EXPANDED_URLS, STRINGS

NBSP = " "


def apply(spark, inputs, column, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    rows = df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


CLEANING = [
    ("RT @user_1: hello https://t.co/abc world", ": hello  world", " hello  world"),
    ("nice look [link]", "ce look ", "ce look "),
    ("check bit.ly/xyz now", "check  now", "check  now"),
    ("RT @a hi", "RT @a h", "RT a h"),
    ("RT\n@bob-x yes", " yes", " yes"),
    ("#Tag @me it's \"ok\" 100%", "#Tag @me it's \"ok\" 100%", "Tag me its ok 100"),
    ("kin", "", ""),
    (f"héllo http://x{NBSP}next", f"héllo {NBSP}next", f"héllo {NBSP}next"),
    ("a_b-c\\d", "a_b-c\\d", "abc\\d"),
    (None, None, None),
]


def test_cleaning_chains(spark):
    inputs = [row[0] for row in CLEANING]
    plain = apply(spark, inputs, lambda c: text.clean_text(c, "corpus"))
    bare = apply(spark, inputs, lambda c: text.clean_text(c, "topics"))
    assert plain == [row[1] for row in CLEANING]
    assert bare == [row[2] for row in CLEANING]
    with pytest.raises(ValueError):
        text.clean_text(F.col("x"), "other")


def test_emoji_modes(spark):
    inputs = ["a 😀❤️b", "1️⃣ of 20 #x", "say \"u\" now", "é ü ☃ ©", "\"😀\nu\""]
    assert apply(spark, inputs, remove_emoji) == ["a b", " of 20 #x", "say \"u\" now", "é ü  ", "\"\nu\""]
    assert apply(spark, inputs, lambda c: remove_emoji(c, "listed"))[1] == " of  x"
    literal = apply(spark, inputs, lambda c: remove_emoji(c, "literal"))
    assert literal == ["a 😀❤️b", "1️⃣ of 20 #x", "say  now", "é ü ☃ ©", ""]


def test_tokens_and_stopwords(spark):
    inputs = ["Élection présidentielle foo_bar the", "", None, "a bb ccc"]
    got = apply(spark, inputs, text.tokenize)
    assert got == [["lection", "sidentielle", "foo", "bar", "the"], [], [], ["ccc"]]


def test_stopwords_are_dropped_in_place(spark):
    texts = ["election sidentielle foo the bar THE foo", "", None, "a bb ccc"]
    df = spark.createDataFrame(list(enumerate(texts)), "tweetid long, text string")
    words = spark.createDataFrame([("en", "THE"), ("en", "ccc")], "lang string, word string")
    got = {r["tweetid"]: r["tokens"] for r in topic_operators.topic_tokens(df, words).collect()}
    assert got == {0: ["election", "sidentielle", "foo", "bar", "foo"], 1: [], 2: [], 3: []}


VIDEO_IDS = {
    "http://youtu.be/SAxx": "SAxx",
    "https://youtu.be/abc?t=3": "abc",
    "https://YOUTU.BE/Q": "Q",
    "https://www.youtube.com/watch?v=_oP&feature=f": "_oP",
    "https://www.youtube.com/watch?a=1&v=z9": "z9",
    "https://www.youtube.com:443/watch?v=p": "p",
    "https://www.youtube.com/watch?v=a%2Db": "a-b",
    "https://www.youtube.com/watch?v=&v=9&v=8": "9",
    "http://youtube.com/embed/SA1": "SA1",
    "http://www.youtube.com/v/SA2?version=3": "SA2",
    "https://www.youtube.com/shorts/ab#t": "ab",
    "https://youtu.be/x;p": "x",
    "https://m.youtube.com/watch?v=x": None,
    "https://www.youtube.com/watch?v=": None,
    "https://www.youtube.com/channel/c": None,
    "https://ex.com/?u=https://youtu.be/k": None,
    "https://www.youtube.com/watch#v=1": None,
    "https://www.youtube.com/watch?x=1#&v=9": None,
    "https://youtu.be/": "",
    "not a url": None,
    None: None,
}


def test_video_ids(spark):
    assert apply(spark, list(VIDEO_IDS), urls.video_id) == list(VIDEO_IDS.values())


def test_video_url_rules(spark):
    links = [
        "https://youtu.be/a",
        "http://www.youtube.com/embed/a",
        "https://ex.com/?u=https://youtu.be/k",
        "https://m.youtube.com/watch?v=a",
    ]
    assert apply(spark, links, urls.is_video_prefix) == [True, True, False, False]
    assert apply(spark, links, urls.contains_video_url) == [True, False, True, False]


def test_registered_domain(spark):
    suffixes = spark.createDataFrame([("com",), ("uk",), ("co.uk",)], "suffix string")
    hosts = {
        "https://www.Example.com/a": "example.com",
        "http://user@a.b.co.uk:80/x": "b.co.uk",
        "http://x.uk": "x.uk",
        "http://localhost/": "localhost.",
        "http://co.uk/": ".co.uk",
        None: None,
    }
    df = spark.createDataFrame([(h,) for h in hosts], "url string")
    got = urls.with_registered_domain(df, "url", suffixes).collect()
    assert {r["url"]: r["domain"] for r in got} == hosts


def test_suffix_rules_with_wildcards_and_exceptions(spark):
    rules = ["com", "ck", "*.ck", "!www.ck", "jp", "*.kobe.jp", "!city.kobe.jp", "github.io", "io", "CO.UK", None]
    suffixes = spark.createDataFrame([(r,) for r in rules], "suffix string")
    hosts = {
        "https://a.b.foo.ck/x": "b.foo.ck",
        "https://foo.ck": ".foo.ck",
        "https://www.ck/": "www.ck",
        "https://sub.www.ck/": "www.ck",
        "https://ck/": ".ck",
        "https://x.y.kobe.jp": "x.y.kobe.jp",
        "https://city.kobe.jp/a": "city.kobe.jp",
        "https://z.city.kobe.jp/a": "city.kobe.jp",
        "https://kobe.jp/": "kobe.jp",
        "https://me.github.io/": "me.github.io",
        "https://github.io/": ".github.io",
        "https://a.co.uk./": "a.co.uk",
        "https://nowhere/": "nowhere.",
        "https://a.b.unknown/": "unknown.",
        "http://10.0.0.7:80/": "10.0.0.7.",
        "no link": ".",
        None: None,
    }
    df = spark.createDataFrame([(h, "x") for h in hosts] * 2, "url string, domain_of string")
    got = urls.with_registered_domain(df, "url", suffixes).collect()
    assert len(got) == 2 * len(hosts) and {r["url"]: r["domain"] for r in got} == hosts
    plan = urls.with_registered_domain(df, "url", suffixes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3  # tails with rules, hosts with their depth, links with their host


def test_parse_literals(spark):
    rows = [
        (0, "['a', \"it's\", 'x\\'y']", "[{'url': None, 'expanded_url': 'https://youtu.be/x'}]"),
        (1, "[]", "[{'expanded_url': 'http://a'}, {'other': 'b'}]"),
        (2, None, "broken"),
        (3, "['\\x41', 5]", "[]"),
        (4, "not [a list", "{'expanded_url': 'x'}"),
    ]
    df = spark.createDataFrame(rows, "i int, tags string, links string")
    parsed = literals.parse_literals(df, {"tags": STRINGS, "links": EXPANDED_URLS})
    got = {r["i"]: (r["tags"], r["links"]) for r in parsed.collect()}
    assert got[0][0] == ["a", "it's", "x'y"]
    assert [x["expanded_url"] for x in got[0][1]] == ["https://youtu.be/x"]
    assert got[1] == ([], [("http://a",), (None,)])
    assert got[2] == (None, None)
    assert got[3] == (["A", "5"], [])
    assert got[4] == (None, None)
    empty = literals.parse_literals(df, {"links": EXPANDED_URLS}, "empty")
    assert {r["i"]: len(r["links"]) for r in empty.collect()} == {0: 1, 1: 2, 2: 0, 3: 0, 4: 0}
    with pytest.raises(Exception, match="no list literal"):
        literals.parse_literals(df, {"links": EXPANDED_URLS}, "fail").collect()


def literal_texts(n=3000):
    """List literals and what only looks like one."""
    rng = random.Random(11)
    scalars = ["'a'", '"it\'s"', "'say \"x\"'", "'None'", "''", "'x\\'y'", "None", "True", "False", "0", "-7", "05", "1.5", "'é😀'", "'a' 'b'", "b'q'"]

    def value(depth):
        kind = rng.random()
        if depth and kind < 0.25:
            keys = rng.sample(["expanded_url", "url", "n"], rng.randint(0, 3))
            pairs = [f"'{key}': {value(depth - 1)}" for key in keys]
            return "{" + ", ".join(pairs) + "}"
        if depth and kind < 0.35:
            return "[" + ",".join(value(depth - 1) for _ in range(rng.randint(0, 3))) + "]"
        return rng.choice(scalars)

    texts = ["[" + rng.choice([", ", ",", " , "]).join(value(2) for _ in range(rng.randint(0, 4))) + "]" for _ in range(n)]
    texts += ["['a'] + ['b']", "['a'], ['b']", "[null, true]", "['a',]", " ['a'] ", "\n['a']", "['a']\n", "[", "['a'", "", "('a',)", "[,]"]
    return [*texts, "[" + ", ".join(["'x'"] * 20_000) + "]"]


def test_literals_equal_the_python_reading(spark):
    texts = literal_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, tags string")
    plain = df.filter(F.col("tags").rlike(literals.PLAIN_LIST))
    assert plain.count() > 300
    got = {r["i"]: r["tags"] for r in literals.parse_literals(df, {"tags": STRINGS}).collect()}
    # the Python reading of every text, through the same JSON reader
    as_json = [(i, kernels.literals_to_json(pd.Series([t]))[0]) for i, t in enumerate(texts)]
    read = spark.createDataFrame(as_json, "i int, j string").select("i", F.from_json("j", STRINGS).alias("tags"))
    assert got == {r["i"]: r["tags"] for r in read.collect()}
    assert all(got[i] is None for i, t in enumerate(texts) if t in ("['a'] + ['b']", "['a'], ['b']", "[null, true]", "[,]"))


def test_what_python_writes_needs_no_python(spark):
    rng = random.Random(4)
    texts = ["it's", 'say "x"', "both ' and \"", "tab\t", "line\nbreak", "\x00\x1f\x7f", "back\\slash", "\\x41", "é😀\u200b", "\ud7ff", "\U000e0041", "None", "", "[1, 'a']"]

    def value(depth):
        kind = rng.random()
        if depth and kind < 0.2:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        if depth and kind < 0.4:
            return {rng.choice(texts): value(depth - 1) for _ in range(rng.randint(0, 3))}
        return rng.choice([rng.choice(texts), rng.randint(-(10**12), 10**12), rng.uniform(-1, 1), 1e16, 2.5e-7, None, True])

    lists = [[value(2) for _ in range(rng.randint(0, 5))] for _ in range(500)]
    df = spark.createDataFrame([(i, str(x)) for i, x in enumerate(lists)], "i int, tags string")
    found = literals.parse_literals(df, {"tags": STRINGS}, others="bad")
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    read = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(lists)], "i int, j string")
    read = read.select("i", F.from_json("j", STRINGS).alias("tags"))
    assert {r["i"]: r["tags"] for r in found.collect()} == {r["i"]: r["tags"] for r in read.collect()}


def test_other_literals_are_bad_without_python(spark):
    texts = ["['a' 'b']", "[b'a']", "[0x10]", "('a',)", "['\\d']", "['a',]", "[1.]"]
    df = spark.createDataFrame([(t,) for t in texts], "tags string")
    assert all(r["tags"] is None for r in literals.parse_literals(df, {"tags": STRINGS}, others="bad").collect())
    got = {t: r["tags"] for t, r in zip(texts, literals.parse_literals(df, {"tags": STRINGS}).collect())}
    assert got["['a' 'b']"] == ["ab"] and got["[0x10]"] == ["16"] and got["['\\d']"] == ["\\d"] and got["['a',]"] == ["a"]


def test_link_lists(spark):
    df = spark.createDataFrame(
        [([("https://youtu.be/x",), (None,), ("https://a.b/",)],), ([],), (None,)],
        "links array<struct<expanded_url:string>>",
    )
    got = df.select(
        literals.expanded_urls(F.col("links")).alias("names"),
        F.size(literals.video_urls(F.col("links"))).alias("n"),
        literals.has_items(F.col("links")).alias("some"),
    ).collect()
    assert got[0]["names"] == ["https://youtu.be/x", "https://a.b/"] and got[0]["n"] == 1
    assert [r["some"] for r in got] == [True, False, False]


def test_zip_mentions(spark):
    df = spark.createDataFrame(
        [
            (0, ["5", "6", "5"], ["a", "b", "c"]),
            (1, ["7", "8"], ["x"]),
            (2, [], ["x"]),
            (3, None, ["x"]),
        ],
        "i int, ids array<string>, names array<string>",
    )
    rows = df.select("i", literals.zip_mentions(F.col("ids"), F.col("names")).alias("z")).collect()
    got = {r["i"]: sorted((p["id"], p["name"]) for p in r["z"] or []) for r in rows}
    assert got == {0: [("5", "c"), ("6", "b")], 1: [("7", "x")], 2: [], 3: []}


def test_dates(spark):
    day = "Fri Nov 06 12:13:14 +0000 2020"
    parsed = apply(spark, [day, "bad", None], values.parse_date)
    assert parsed == [datetime(2020, 11, 6, 12, 13, 14), None, None]
    assert apply(spark, [day], lambda c: values.format_date(values.parse_date(c))) == [day]
    assert apply(spark, ["2020-01-02", "x"], values.lenient_date) == [datetime(2020, 1, 2), None]
    assert apply(spark, ["86400"], values.epoch_to_timestamp) == [datetime(1970, 1, 2)]


def test_numbers(spark):
    assert apply(spark, ["12.0", "1328000000000000001", "x"], values.to_id) == [12, 1328000000000000001, None]
    assert apply(spark, ["3.7", "x"], values.to_whole_count) == [3, None]
    assert apply(spark, [0.125, 0.375, 0.575], lambda c: values.round_half_up(c, 2), "double") == [0.13, 0.38, 0.58]
    assert apply(spark, [0.125, 0.375, 0.575], lambda c: values.round_half_even(c, 2), "double") == [0.12, 0.38, 0.57]


TOPIC_ROWS = [
    ((0.2, 0.4, 0.4, 0.0, 0.0), None, 1),
    ((0.0, 0.0, 0.0, 0.0, 0.0), None, 0),
    ((0.1, 0.2, 0.3, 0.4, 0.0), 3, 3),
    ((0.5, 0.1, 0.1, 0.2, 0.1), 0, 0),
    ((0.3, 0.0, 0.2, 0.5, 0.0), 3, 3),
]


def test_topic_rules(spark):
    names = topics.topic_columns()
    schema = "i int, " + ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame([(i, *row[0]) for i, row in enumerate(TOPIC_ROWS)], schema)
    probs = [F.col(n) for n in names]
    got = df.orderBy("i").select(
        topics.strict_topic_index(probs).alias("strict"),
        topics.strict_topic_index(probs, "literal").alias("literal"),
        topics.argmax_topic(topics.probabilities()).alias("first"),
        *[topics.strict_topic(probs, k).alias(f"s{k}") for k in range(5)],
        topics.strict_topic(probs, 3, "literal").alias("l3"),
    ).collect()
    assert [r["strict"] for r in got] == [row[1] for row in TOPIC_ROWS]
    assert [r["first"] for r in got] == [row[2] for row in TOPIC_ROWS]
    # topic 2 does not beat topic 0 in the last row, so the literal rule loses it
    assert [r["literal"] for r in got] == [None, None, 3, 0, None]
    for r in got:
        assert [k for k in range(5) if r[f"s{k}"]] == ([] if r["strict"] is None else [r["strict"]])
        assert r["l3"] == (r["literal"] == 3)


def test_softmax_and_ranks(spark):
    df = spark.createDataFrame([([1000.0, 1001.0, 999.0],)], "x array<double>")
    p = df.select(topics.softmax(F.col("x")).alias("p")).first()["p"]
    assert abs(sum(p) - 1) < 1e-12 and p[1] > p[0] > p[2]
    scored = spark.createDataFrame([(0.2, 0.5, 0.3)], "p double, u double, n double")
    ranked = scored.select(
        topics.rank_labels({"positive": F.col("p"), "neutral": F.col("u"), "negative": F.col("n")}).alias("r")
    ).first()["r"]
    assert [x["label"] for x in ranked] == ["neutral", "negative", "positive"]
