"""PII surrogates: detected entities get keyed, type-consistent replacements.

Entities are e-mail addresses, phone numbers, IPv4 addresses, payment card
numbers, and names: words behind a title, and the same words elsewhere in that text.
Given and family names are entities of their own, so a family name has one surrogate
wherever it stands. A surrogate keeps the form of its original:
letters stay letters of the same script and case, digits stay digits, separators
stay; a name keeps the gender of its title, an address stays a valid address, a
card number keeps its check digit. One original has one surrogate in the whole
corpus (coreference), and no two originals share one.

The corpus says which distinct originals there are. A surrogate is drawn with a
keyed hash of type, original and attempt; one that is an original itself, or that
another original holds, is refused, and its loser draws again, until every
original has its own. A form may have too few surrogates, or only the original
itself: after ``IN_FORM`` attempts the form widens with each attempt (free letters,
then more letters or digits, for addresses at last a numbered suffix), so that the
rounds end. Only documents with an entity are joined with the table of surrogates;
all others pass untouched.

Defined results: a null text stays null; repeated rows give one result each;
spellings of one original that differ in case only get one surrogate in their own
case; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlark.llm.common import fresh, travels, with_fields, worker_cache
from postlark.session import checkpointed

travels(__name__)

KINDS = ("email", "phone", "ip", "card", "name")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
CARD = re.compile(r"(?<![\d.])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?![\d.]*\d)")
IP = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)")
PHONE = re.compile(
    r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\w)"
)
# a number with its country code: 8 to 15 digits in any grouping
WORLD_PHONE = re.compile(r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?![\w])")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
# shorter words that follow a title are not looked for elsewhere
LEAST_MENTION = 3
RESERVED = re.compile(r"(.*?)((?:(?:^|\.)example)?\.[a-z]+)")
# titles with the gender they tell; fixed values
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f",
    "Señor": "m", "Señora": "f", "Monsieur": "m", "Madame": "f", "Dr": "n",
}
NAME = re.compile(
    rf"\b({'|'.join(sorted(TITLES, key=len, reverse=True))})\.?\x20([^\W\d_]+(?:-[^\W\d_]+)?(?:\x20[^\W\d_]+)?)"
)
# every text with an entity has a match of this
ANY = (
    r"@[A-Za-z0-9-]+\.|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d|\d{4}[ -]?\d{4}[ -]?\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}"
    r"|\(\d{2,4}\)[ .-]?\d{3}|\+\d{1,3}[ .(-]?\d|\b(?:Mrs?|Ms|Miss|Herr|Frau|Señora?|Monsieur|Madame|Dr)\.? "
)
SPAN = "struct<kind:int,start:int,end:int,value:string>"
SPAN_TYPE = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])
# alphabets by script for letters that are replaced
SCRIPTS = (
    ("latin", "abcdefghijklmnopqrstuvwxyz"),
    ("greek", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("cyrillic", "абвгдежзийклмнопрстуфхцчшщыэюя"),
)
VOWELS = "aeiou"
# attempts that keep the form; each later one widens it more
IN_FORM = 6
# a widened IPv4 address stays an address for so many attempts more
WHOLE_IP = 8


# --- detection -------------------------------------------------------------------------


def _valid_ip(value: str) -> bool:
    return all(int(part) < 256 for part in value.split("."))


def find_entities(text: str) -> list[tuple[int, int, int, str]]:
    """Kind, start, end (code points) and canonical original; entities do not overlap, earlier kinds win."""
    found: list[tuple[int, int, int, str]] = []
    taken: list[tuple[int, int]] = []

    def add(kind: int, start: int, end: int) -> None:
        if all(end <= a or b <= start for a, b in taken):
            taken.append((start, end))
            found.append((kind, start, end, text[start:end].lower()))

    for m in EMAIL.finditer(text):
        add(0, m.start(), m.end())
    for m in CARD.finditer(text):
        add(3, m.start(), m.end())
    for m in IP.finditer(text):
        if _valid_ip(m[0]):
            add(2, m.start(), m.end())
    for m in PHONE.finditer(text):
        add(1, m.start(), m.end())
    for m in WORLD_PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            add(1, m.start(), m.end())
    known: dict[str, str] = {}

    def name(start: int, word: str, value: str) -> None:
        if all(start + len(word) <= a or b <= start for a, b in taken):
            taken.append((start, start + len(word)))
            found.append((4, start, start + len(word), value))

    for m in NAME.finditer(text):
        words = [w for w in m[2].split(" ") if w[0].isupper()]
        if words and m[2].startswith(words[0]):
            start = m.start(2)
            # the first of two is a given name, which tells the gender; a family name is the same for all who bear it
            for k, word in enumerate(words):
                given = k == 0 and len(words) == 2
                value = (TITLES[m[1]] if given else "n") + ":" + word.lower()
                known.setdefault(word, value)
                name(start, word, value)
                start += len(word) + 1
    if known:
        for m in WORD.finditer(text):
            if len(m[0]) >= LEAST_MENTION and m[0] in known:
                name(m.start(), m[0], known[m[0]])
    return sorted(found, key=lambda x: x[1])


# --- surrogates ------------------------------------------------------------------------


class Draw:
    """An endless stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, label: str):
        self.key, self.label, self.round, self.pool = key, label.encode("utf-8", "surrogatepass"), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.label + b"\0%d" % self.round, hashlib.sha256).digest()
            self.round += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value % n


def _alphabet(low: str) -> tuple[str, str]:
    """Script of a lower-case letter and the letters it is replaced by: never fewer than two."""
    held = worker_cache("alphabets", dict)
    if low not in held:
        known = dict(SCRIPTS)
        script = unicodedata.name(low, "").split(" ")[0].lower()
        for name, letters in SCRIPTS:
            if low in letters or (name == "latin" and ord(low) < 0x250):
                script = name
        letters = known.get(script, "")
        if not letters:  # letters nearby of the same script that keep their case
            near = map(chr, range(max(0x80, ord(low) - 0x200), min(0x110000, ord(low) + 0x200)))
            kind = unicodedata.category(low)
            letters = "".join(
                c
                for c in near
                if unicodedata.category(c) == kind
                and unicodedata.name(c, "").split(" ")[0].lower() == script
                and c.lower() == c == c.upper().lower()
            )
        held[low] = (script, letters) if len(letters) > 1 else ("latin", known["latin"])
    return held[low]


def _letter(char: str, draw: Draw, vowel: bool | None = None) -> str:
    low = char.lower()[:1]
    if 0x4E00 <= ord(low) < 0xA000:
        return chr(0x4E00 + draw.below(0x5000))
    if unicodedata.category(low)[0] == "M":
        return low
    script, letters = _alphabet(low)
    if script == "latin" and vowel is not None:
        letters = "".join(c for c in letters if (c in VOWELS) == vowel)
    return letters[draw.below(len(letters))]


def _digits(value: str, draw: Draw) -> str:
    """Digits and letters anew; the rest, and a leading digit's being zero, stay."""
    out = []
    for i, c in enumerate(value):
        if c.isdigit():
            first = not any(x.isdigit() for x in value[:i])
            out.append(str(draw.below(10)) if not first or c == "0" else str(1 + draw.below(9)))
        elif c.isalpha():
            out.append(_letter(c, draw))
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: str) -> int:
    """The digit that completes ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def surrogate(kind: int, value: str, attempt: int, key: bytes) -> str:
    """The replacement of a canonical original, in lower case; wider with each attempt from ``IN_FORM`` on."""
    draw = Draw(key, f"{KINDS[kind]}\0{value}\0{attempt}")
    more = max(0, attempt - IN_FORM + 1)
    if KINDS[kind] == "email":
        local, _, domain = value.rpartition("@")
        # the reserved domains stay, else the last label
        host, last = RESERVED.fullmatch(domain).groups()
        return f"{_digits(local + 'x' * more, draw)}@{_digits(host, draw)}{last}"
    if KINDS[kind] == "ip":
        parts = [str(draw.below(256) if more else draw.below(254) + 1) for _ in value.split(".")]
        beyond = more - WHOLE_IP
        return ".".join(parts) + (f"-{_digits('1' * beyond, draw)}" if beyond > 0 else "")
    if KINDS[kind] == "card":
        digits = re.sub(r"\D", "", value)
        plain = _digits(digits[:-1] + "1" * more, draw)
        valid = _luhn(digits[:-1]) == int(digits[-1])
        whole = plain + str(_luhn(plain) if valid else draw.below(10))
        new = iter(whole)
        return "".join(next(new) if c.isdigit() else c for c in value) + "".join(new)
    if KINDS[kind] == "phone":
        # the country code stays
        head = re.match(r"\+\d{1,3}(?=[ .-])", value)
        at = head.end() if head else 0
        return value[:at] + _digits(value[at:] + "1" * more, draw)
    gender, _, name = value.partition(":")
    parts = []
    for n, part in enumerate(re.split(r"([ -])", name)):
        if part in " -":
            parts.append(part)
            continue
        letters = [_letter(c, draw, vowel=None if more else i % 2 == 1) for i, c in enumerate(part)]
        if n == 0 and gender != "n" and not more and len(letters) > 1 and ord(letters[-1]) < 0x250:
            # given names sound like the title's gender
            letters[-1] = "a" if gender == "f" else "o"
        parts.append("".join(letters))
    return "".join(parts) + "".join(_letter(parts[-1][-1], draw) for _ in range(more - 1))


def in_case_of(original: str, replacement: str) -> str:
    """The replacement in the case of the original, position by position."""
    return "".join(
        r.upper() if i < len(original) and original[i].isupper() else r for i, r in enumerate(replacement)
    )


def _scan(text: str, names: tuple[str, str]):
    def scan(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            spans, keys = [None] * len(column), [None] * len(column)
            hit = pc.fill_null(pc.match_substring_regex(column, ANY), False)
            for i in pc.indices_nonzero(hit).to_pylist():
                value = column[i].as_py()
                if found := find_entities(value):
                    spans[i] = [dict(zip(("kind", "start", "end", "value"), x)) for x in found]
                    keys[i] = hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(spans, pa.list_(SPAN_TYPE)), pa.array(keys, pa.string())],
                [*batch.schema.names, *names],
            )

    return scan


def scan_entities(docs: DataFrame, text_col: str, spans: str, key: str) -> DataFrame:
    """``docs`` with the entities of each text and a hash of the text; both null where there are none."""
    schema = with_fields(docs.schema, f"{spans} array<{SPAN}>, {key} string")
    return docs.mapInArrow(_scan(text_col, (spans, key)), schema)


def _draw(key: bytes):
    def draw(batches):
        for batch in batches:
            kinds, values, attempts = (batch.column(i).to_pylist() for i in range(3))
            found = [surrogate(k, v, a, key) for k, v, a in zip(kinds, values, attempts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string())], ["kind", "value", "attempt", "surrogate"]
            )

    return draw


def assign_surrogates(originals: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, surrogate`` for distinct ``kind, value``; no surrogate twice, none that is an original.

    Names of either gender share one space. Rounds go on until nothing collides;
    each settles most of what is left, since a draw that collides is rare, and a
    form that is too small for its originals widens.
    """
    plain = F.when(F.col("kind") == 4, F.substring_index("value", ":", -1)).otherwise(F.col("value"))
    taken = originals.select("kind", plain.alias("surrogate")).distinct()
    waiting, settled = originals.select("kind", "value", F.lit(0).alias("attempt")), None
    schema = "kind int, value string, attempt int, surrogate string"
    while True:
        drawn = waiting.mapInArrow(_draw(key), schema)
        order = Window.partitionBy("kind", "surrogate").orderBy("value")
        ranked = drawn.withColumn("place", F.row_number().over(order))
        clash = taken.withColumn("taken", F.lit(True))
        judged = checkpointed(
            ranked.join(clash, ["kind", "surrogate"], "left").withColumn(
                "ok", (F.col("place") == 1) & F.col("taken").isNull()
            )
        )
        good = judged.filter("ok").select("kind", "value", "surrogate")
        settled = good if settled is None else settled.unionByName(good)
        waiting = judged.filter(~F.col("ok")).select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        if waiting.isEmpty():
            return settled
        taken = taken.unionByName(good.select("kind", "surrogate"))


def _replace(text: str, spans: str):
    def replaced(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            out = []
            for value, found in zip(batch.column(at).to_pylist(), batch.column(spans).to_pylist()):
                end, parts = 0, []
                for s in found:
                    parts += [value[end : s["start"]], in_case_of(value[s["start"] : s["end"]], s["surrogate"])]
                    end = s["end"]
                out.append("".join([*parts, value[end:]]))
            columns = [*batch.columns]
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return replaced


def replace_entities(docs: DataFrame, key: bytes, *, text_col="text", entities_as="entities") -> DataFrame:
    """``docs`` with every entity replaced, and the list of entities: kind, start, end in the original, surrogate.

    Where ``docs`` has a column of that name, the list gets a longer one.
    """
    entities_as = fresh(entities_as, docs.columns)
    spans, row = fresh("found_spans", [*docs.columns, entities_as]), fresh("found_key", [*docs.columns, entities_as])
    scanned = scan_entities(docs, text_col, spans, row)
    kind = "array<struct<start:int,end:int,kind:int,surrogate:string>>"
    hits = scanned.filter(F.col(row).isNotNull())
    flat = hits.select(F.col(row).alias("text_key"), F.explode(spans).alias("s")).select("text_key", "s.*").distinct()
    flat = checkpointed(flat)
    table = assign_surrogates(flat.select("kind", "value").distinct(), key)
    chosen = flat.join(table, ["kind", "value"])
    grouped = chosen.groupBy("text_key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "kind", "surrogate"))).alias(entities_as)
    )
    grouped = grouped.withColumnRenamed("text_key", row)
    joined = hits.drop(spans).join(grouped, row).select(*docs.columns, entities_as)
    changed = joined.mapInArrow(_replace(text_col, entities_as), with_fields(docs.schema, f"{entities_as} {kind}"))
    rest = scanned.filter(F.col(row).isNull()).select(*docs.columns, F.array().cast(kind).alias(entities_as))
    return rest.unionByName(changed)
