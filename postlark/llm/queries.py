"""The queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.llm import (
    decontaminate,
    divergence,
    fm_dedup,
    infill,
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
from postlark.llm.common import folds, id_and_text, prepared, shared_folder

PIECE_MODEL = "piece_bpe_32k.model"
# on a cluster the caller of `replace_entities` passes a secret of their own
SURROGATE_KEY = b"surrogates of the stand-in tables"
WORD_MODEL, RECORD_END = "byte_bpe_50k.json", 2


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of every text that repeat a 50-byte string of an earlier document, removed."""
    cut = suffix_dedup.remove_repeats(id_and_text(documents(spark, sf)))
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates by kind, their spans, and how many look live or are copied examples."""
    found = secret_scan.scan_secrets(documents(spark, sf))
    names = F.array(*[F.lit(k) for k in secret_scan.KINDS])

    def joined(spans):
        parts = F.transform(
            spans,
            lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")),
        )
        return F.array_join(parts, ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
        F.size(F.filter("secrets", lambda s: s["live"])).cast("bigint").alias("n_live"),
        F.coalesce(F.array_max(F.transform("secrets", lambda s: s["n_owners"])), F.lit(0)).alias("most_owners"),
    )


def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that hold a benchmark item, with the share of its shingles."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = decontaminate.contained_items(id_and_text(documents(spark, sf)), items)
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def op4_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    """Every text with its entities replaced, and how many there are by kind."""
    found = surrogates.replace_entities(documents(spark, sf).select("doc_id", "text"), SURROGATE_KEY)

    def count(kind):
        return F.size(F.filter("entities", lambda e: e["kind"] == kind)).cast("bigint").alias(f"n_{surrogates.KINDS[kind]}")

    return found.select("doc_id", "text", *[count(k) for k in range(len(surrogates.KINDS))], "entities")


def op5_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of the piece ids of every text and of what they decode to."""
    path = public_tokenizers.path(PIECE_MODEL)
    encoded = pieces.encode_pieces(id_and_text(documents(spark, sf)), path)
    return pieces.decode_pieces(encoded, path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted language of every document; one fold of three is held out of training."""
    docs = documents(spark, sf)
    fold = folds(F.col("doc_id"), 3)
    model = language.train_language(docs.filter((fold != 1) & F.col("lang").isNotNull()))
    rows = docs.select("doc_id", "text", F.coalesce(fold == 1, F.lit(False)).alias("held_out"))
    return language.identify_language(rows, model).drop("text")


def op7_records(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids written as framed records in id order, read back through the index."""
    folder = shared_folder(spark, "records")
    docs = id_and_text(documents(spark, sf))
    index = records.write_records(docs, folder, public_tokenizers.path(WORD_MODEL), RECORD_END)
    read = records.read_records(records.corpus_starts(index), folder, raw=True)
    return read.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op8_syncmers(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likeness."""
    return syncmers.fingerprints(id_and_text(documents(spark, sf)))


def op9_trie_lm(spark: SparkSession, sf: str) -> DataFrame:
    """Unigram and trie-model log probabilities of every text; one fold of seven is held out."""
    docs = documents(spark, sf)
    fold = folds(F.col("doc_id"), 7)
    scored = trie_lm.score_texts(id_and_text(docs), fold != 2)
    return scored.select(
        "doc_id",
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(id_and_text(documents(spark, sf)))


def op11_divergence(spark: SparkSession, sf: str) -> DataFrame:
    """Divergence of every (language, source) group from the others, and the terms it has more of."""
    return divergence.audit_sources(documents(spark, sf), shared_folder(spark, "divergence"))


def op12_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Words of every text that a repeated window of 20 words covers, removed."""
    cut = fm_dedup.remove_repeated_windows(documents(spark, sf))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of every text in fill-in-the-middle form, and of the text rebuilt from it."""
    formed = infill.fill_in_middle(documents(spark, sf))
    return formed.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_surrogates": op4_surrogates,
    "op5_pieces": op5_pieces,
    "op6_language": op6_language,
    "op7_records": op7_records,
    "op8_syncmers": op8_syncmers,
    "op9_trie_lm": op9_trie_lm,
    "op10_simhash": op10_simhash,
    "op11_divergence": op11_divergence,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLES: dict[str, str] = {
    "op1_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
place AS (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS i FROM d),
window_at AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS byte,
    CASE WHEN 2 * i + 100 <= len(h) THEN substr(h, 2 * i + 1, 100) END AS win
  FROM place),
again AS (
  SELECT doc_id, i, byte, win IS NOT NULL AND min(doc_id) OVER (PARTITION BY win) < doc_id AS repeats FROM window_at),
covered AS (
  SELECT doc_id, i, byte,
    max(repeats::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM again),
spans AS (
  SELECT *, gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) = 0 AS opens FROM covered),
summed AS (
  SELECT doc_id, sum(gone) AS n_removed, count_if(opens) AS n_spans,
    string_agg(byte, '' ORDER BY i) FILTER (gone = 0) AS kept
  FROM spans GROUP BY doc_id)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN summed USING (doc_id)
""",
    "op3_decontaminate": """
WITH found AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT DISTINCT 'i', item_id, text FROM benchmark),
words AS (
  SELECT side, id, row_number() OVER () AS r,
    regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\\x{C0}-\\x{1FFF}\\x{2040}-\\x{10FFFF}]+') AS w
  FROM found),
starts AS (SELECT side, id, r, w, unnest(range(1, len(w) - 3)) AS k FROM words),
shingle AS (SELECT DISTINCT side, id, r, array_to_string(w[k:k + 4], ' ') AS s FROM starts),
size AS (SELECT r, id, count(*) AS n FROM shingle WHERE side = 'i' GROUP BY r, id),
long AS (
  SELECT a.id AS doc_id, z.id AS item_id, count(*) AS n_shared, any_value(z.n) AS n_item
  FROM shingle a JOIN shingle b ON b.s = a.s AND b.side = 'i' JOIN size z ON z.r = b.r
  WHERE a.side = 'd' GROUP BY a.r, a.id, z.r, z.id HAVING count(*) >= 0.8 * any_value(z.n)),
short AS (
  SELECT a.id AS doc_id, b.id AS item_id, 1::BIGINT AS n_shared, 1::BIGINT AS n_item
  FROM words a JOIN words b ON b.side = 'i' AND len(b.w) BETWEEN 1 AND 4
    AND contains(' ' || array_to_string(a.w, ' ') || ' ', ' ' || array_to_string(b.w, ' ') || ' ')
  WHERE a.side = 'd')
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM (SELECT * FROM long UNION ALL SELECT * FROM short)
""",
    "op11_divergence": """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
t AS (SELECT r, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS (
  SELECT g.lang, g.source, coalesce(sum(n.n), 0)::BIGINT AS total
  FROM g LEFT JOIN n USING (lang, source) GROUP BY ALL),
p AS (
  SELECT lang, source, term, coalesce(n.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 2)) // (total + 2 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS whole
  FROM total JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - whole) * (p - whole)) // (p + whole))::BIGINT AS value
  FROM p WHERE n > 0 AND p > whole)
SELECT lang, source, part, item, value,
  (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 10
""",
    "op12_substring_dedup": """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS win FROM starts),
again AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM again),
each AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept
  FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op13_fill_in_middle": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d),
cut AS (
  SELECT doc_id, text, units, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
    least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b
  FROM drawn),
parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix,
    array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix
  FROM cut)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
""",
}
