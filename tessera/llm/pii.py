"""PII surrogates: keyed, type-consistent replacements.

Detected entities (email addresses, phone, card and social security numbers, IPv4 and
IPv6 addresses, long hexadecimal tokens, and person names after an honorific or a known
given name) are replaced by surrogates of the same type and format:

* characters are replaced within their class (digits by digits, vowels and
  consonants by letters of the same kind and script, case and punctuation stay) by a
  keyed permutation of all strings of that pattern, so different entities cannot get
  the same surrogate; letters outside the vowels and consonants of `LETTERS` (Chinese,
  Hebrew, Vietnamese, ...) are replaced within the letters of their own script; where a
  pattern has too few strings for the corpus (`OWN_DRAWS` draws clashed), names, emails and
  phone numbers get longer ones; card numbers keep a valid (or invalid) check digit; addresses
  keep their top-level domain, phone numbers their country code or leading 0, IPv4 octets
  stay in range, IPv6 addresses become others in their shortest form;
* known given names change places among the names of the same gender and script;
  other given names keep their last letters, which mark gender in many languages.

The surrogate depends on the key, the type and the canonical entity only, so every
mention of an entity, in any document or spelling of it, gets the same one.

A Spark job over the distinct entities checks that no two of a type share a surrogate,
that none stays as it is, and that no surrogate is an entity of the corpus (but for
given names, whose pools are small by design); those that clash are drawn again with the next tweak, from ever
longer patterns, until none does.  The few redrawn entities go to the tasks if there are at most `max_redrawn`;
beyond that they are joined to their documents.  Replacing is a map over whole texts.

Defined cases: null texts stay null and have no entities; empty texts stay; a null id
stays null; repeated rows are replaced each, alike; an empty table gives an empty
result; other columns of the input are ignored.
"""
from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from ipaddress import AddressValueError, IPv6Address

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpoint, id_text

#: Given names by script and gender, and honorifics by gender.
GIVEN = {
    "latin": {"f": ("Alice", "Barbara", "Camille", "Claudia", "Elena", "Frances", "Gabriela", "Hannah", "Ingrid", "Julia",
                    "Katharina", "Laura", "Margaret", "Natalie", "Patricia", "Rebecca", "Susanne", "Teresa", "Valerie", "Yvonne"),
              "m": ("Andrew", "Benjamin", "Christoph", "Daniel", "Edward", "Fernando", "Gerhard", "Heinrich", "Jonathan", "Laurent",
                    "Matthias", "Nicolas", "Patrick", "Richard", "Sebastian", "Theodore", "Vincent", "William", "Xavier", "Zachary")},
    "cyrillic": {"f": ("Анна", "Дарья", "Елена", "Ирина", "Людмила", "Марина", "Наталья", "Светлана"),
                 "m": ("Андрей", "Борис", "Дмитрий", "Иван", "Михаил", "Николай", "Сергей", "Юрий")},
    "greek": {"f": ("Αθηνά", "Ελένη", "Μαρία", "Σοφία"), "m": ("Γιώργος", "Κώστας", "Νίκος", "Παύλος")},
}
HONORIFICS = {"f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
              "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"), "n": ("Dr", "Prof")}
#: Vowels and consonants by script.
LETTERS = (("aeiouy", "bcdfghjklmnpqrstvwxz"), ("аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ"), ("αεηιουω", "βγδζθκλμνξπρστφχψ"))

#: So many draws keep the length of the pattern, each further group of as many takes LONGER more characters.
OWN_DRAWS, LONGER = 4, 2


class _Classes(dict):
    """The class of each character; others than letters and numbers have none."""

    def __missing__(self, c: str) -> str:
        self[c] = _other_classes().get(c, "")
        return self[c]


@lru_cache(maxsize=1)
def _other_classes() -> dict[str, str]:
    """Classes of what LETTERS leaves out, by the script in the Unicode name, the category, how the letter is capitalised
    and whether it is a compatibility form; cased letters are told by Unicode block too, so that they stay with those of the same languages.  What would be
    alone in its class goes into one common class."""
    groups: dict[tuple, list[str]] = {}
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        if c.isalnum() and c not in _CLASS and ord(c) not in _FOLD and c == c.lower():
            kind, upper = unicodedata.category(c), c.upper()
            cased = "none" if upper == c else "pair" if len(upper) == 1 and upper.lower() == c else "odd"
            block = ord(c) >> 7 if cased == "pair" else 0x4E00 <= ord(c) < 0xA000
            groups.setdefault((*unicodedata.name(c, "").split()[:2], kind, cased, block, unicodedata.is_normalized("NFKC", c)), []).append(c)
    rest = "".join(g[0] for g in groups.values() if len(g) == 1)
    classes = ["".join(g) if len(g) > 1 else rest for g in groups.values()]
    return {c: letters for letters, g in zip(classes, groups.values()) for c in g}


_CLASS = _Classes({c: kind for script in LETTERS for kind in script for c in kind} | {c: "0123456789" for c in "0123456789"})
_OTHER_KIND = {a: b for pair in LETTERS for a, b in (pair, pair[::-1])}
_HEX = "0123456789abcdef"
_FOLD = str.maketrans("áàâäãåéèêëíìîïóòôöõúùûüýÿ", "aaaaaaeeeeiiiiooooouuuuyy")
_GENDER_OF = {name: (script, gender) for script, by in GIVEN.items() for gender, names in by.items() for name in names}
_TITLE = {t: g for g, titles in HONORIFICS.items() for t in titles}
#: A closing 's is no part of a name.
_NAME = r"[^\W\d_a-zà-öø-ÿа-яά-ώ](?:[^\W\d_]+|['’](?![sS]\b)[^\W\d_]+)(?:(?:['’](?![sS]\b)|-)[^\W\d_]+)*"

_EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])", re.A)
_NUMBERS = re.compile(
    r"(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w-])(?:\d{4}[ -]){3}\d{1,7}(?![\w-])|(?<![\w-])\d{4}([ -])\d{6}\4\d{4,5}(?![\w-])|(?<![\w-])\d{13,19}(?![\w-]))"
    r"|(?P<phone>(?<!\w)\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w.-])(?=0(?:[ /-]?\d){8,11}(?![\w-]))0\d{2,4}[ /-]\d{3,8}(?:[ -]\d{2,8}){0,2}(?![\w-]))"
    , re.A)
#: Where a number can begin; what to skip when none does (no number begins inside a run of word characters).
_BEGIN, _RUN = re.compile(r"[\d(+]", re.A), re.compile(r"\w+|.", re.A | re.S)
#: What every IPv6 address holds; the address around it; the letters before it.
_COLONS, _IPV6, _IPV6_HEAD = re.compile(r":[0-9a-fA-F]{0,4}:"), re.compile(r"[0-9a-fA-F:]+"), re.compile(r"[0-9a-fA-F]{0,4}\Z")
_TOKEN = re.compile(r"[0-9a-fA-F]{32,128}")
_ANY_DIGIT = re.compile(r"\d", re.A)
_TITLED = re.compile(rf"\b({'|'.join(sorted(_TITLE, key=len, reverse=True))})\.?[ \xa0]({_NAME})(?:[ \xa0]({_NAME}))?")
_ANY_TITLE = re.compile("|".join(_TITLE))
_KNOWN = re.compile(rf"\b({'|'.join(sorted(_GENDER_OF, key=len, reverse=True))})[ \xa0]({_NAME})")
_KNOWN_NAMES = frozenset(_GENDER_OF)


class Permutation:
    """Keyed permutation of 0 .. n-1 for any size of n: a Feistel network with cycle-walking."""

    def __init__(self, key: bytes, tweak: str, n: int):
        self.n, self.half = n, max(1, ((n - 1).bit_length() + 1) // 2)
        self.key, self.tweak = hashlib.blake2b(key, digest_size=32).digest(), tweak.encode()

    def _round(self, i: int, x: int) -> int:
        size = (self.half + 7) // 8
        out = b"".join(hashlib.blake2b(bytes([i, j]) + x.to_bytes(size, "big") + self.tweak, key=self.key, digest_size=32).digest()
                       for j in range((size + 31) // 32))
        return int.from_bytes(out[:size], "big") & ((1 << self.half) - 1)

    def __call__(self, x: int) -> int:
        while True:
            left, right = x >> self.half, x & ((1 << self.half) - 1)
            for i in range(8):
                left, right = right, left ^ self._round(i, right)
            x = left << self.half | right
            if x < self.n:
                return x


def _permuted(text: str, key: bytes, tweak: str, classes: dict[str, str]) -> str:
    """`text` with each character of a class replaced within it; the pattern stays, and strings of a pattern are permuted."""
    kinds = [classes[c] for c in text]
    n, value = 1, 0
    for c, kind in zip(text, kinds):
        if kind:
            n, value = n * len(kind), value * len(kind) + kind.index(c)
    if n == 1:
        return text
    pattern = "".join(k[0] if k else c for c, k in zip(text, kinds))
    value, out = Permutation(key, f"{tweak}|{pattern}", n)(value), []
    for c, kind in zip(reversed(text), reversed(kinds)):
        if kind:
            value, at = divmod(value, len(kind))
            c = kind[at]
        out.append(c)
    return "".join(reversed(out))


def _longer(text: str, more: int) -> str:
    """`text` and `more` characters: vowels and consonants in turn, or of the last class."""
    kind = next((k for k in map(_CLASS.__getitem__, reversed(text)) if k), LETTERS[0][0])
    for _ in range(more):
        kind = _OTHER_KIND.get(kind, kind)
        text += kind[0]
    return text


def _luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


@lru_cache(maxsize=50_000)
def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """The replacement of a canonical entity."""
    tweak, more = f"{kind}|{attempt}", attempt // OWN_DRAWS * LONGER
    if kind == "email":
        body, _, top = entity.rpartition(".")
        return _permuted(_longer(body, more), key, f"{tweak}|{top}", _CLASS) + "." + top
    if kind == "phone":
        kept = (2 if entity[1] in "17" else 3) if entity.startswith("+") else 1 if entity[0] == "0" else 0
        return entity[:kept] + _permuted(_longer(entity[kept:], more), key, f"{tweak}|{entity[:kept]}", _CLASS)
    if kind == "card":
        valid, out = _luhn(entity), entity
        while True:  # walk on to the next number whose check digit is as valid
            out = _permuted(out, key, tweak, _CLASS)
            if _luhn(out) == valid:
                return out
    if kind == "ip" and ":" in entity:
        return str(IPv6Address(Permutation(key, tweak, 1 << 128)(int(IPv6Address(entity)))))
    if kind == "ip":
        value = Permutation(key, tweak, 1 << 32)(int.from_bytes(bytes(map(int, entity.split("."))), "big"))
        return ".".join(map(str, value.to_bytes(4, "big")))
    if kind == "token":
        return _permuted(entity, key, tweak, dict.fromkeys(_HEX, _HEX))
    if kind.startswith("given") and entity in _GENDER_OF_FOLDED:
        script, gender, place = _GENDER_OF_FOLDED[entity]
        names = GIVEN[script][gender]
        ring = sorted(range(len(names)), key=lambda i: hashlib.blake2b(f"{tweak}|{names[i]}".encode(), key=hashlib.sha256(key).digest()).digest())
        return names[ring[(ring.index(place) + 1) % len(ring)]].lower()  # the next in a keyed ring: one to one, never itself
    kept = 2 if kind.startswith("given") and len(entity) > 3 else 0
    stem, end = entity[:len(entity) - kept], entity[len(entity) - kept:]
    if kind.startswith(("given", "surname")):
        stem = _longer(stem, more)
    return _permuted(stem, key, f"{tweak}|{end}", _CLASS) + end


_GENDER_OF_FOLDED = {name.lower(): (script, gender, i) for script, by in GIVEN.items() for gender, names in by.items() for i, name in enumerate(names)}


def canonical(kind: str, text: str) -> str:
    if kind == "phone":
        digits = re.sub(r"\D", "", text)
        return ("+" if text.startswith("+") or len(digits) == 11 and digits[0] == "1" else "") + digits
    if kind == "ip":
        return str(IPv6Address(text)) if ":" in text else text
    if kind == "card":
        return re.sub(r"\D", "", text)
    if kind.startswith(("given", "surname")):
        lower = text.lower()
        return lower if lower in _GENDER_OF_FOLDED else lower.translate(_FOLD)
    return text.lower() if kind in ("email", "token") else text


def _laid_out(kind: str, original: str, replacement: str) -> str:
    """The canonical replacement in the format of the mention: its punctuation and case."""
    if kind == "phone" or kind == "card":
        digits = iter(replacement.lstrip("+"))
        return "".join(next(digits) if c.isdigit() else c for c in original) + "".join(digits)
    if kind.startswith(("given", "surname")):
        if len(original) == len(replacement):
            return "".join(r.upper() if o.isupper() else r for o, r in zip(original, replacement))
        if original.isupper():
            return replacement.upper()
        return "-".join(p[:1].upper() + p[1:] for p in replacement.split("-"))
    if kind in ("email", "token") and len(original) == len(replacement):
        return "".join(r.upper() if o.isupper() else r for o, r in zip(original, replacement))
    return replacement


def _is_ipv6(text: str) -> bool:
    """An IPv6 address with at least two written groups and a digit (so not `::1`, nor the `a::b` of a program)."""
    if sum(map(bool, text.split(":"))) < 2 or not _ANY_DIGIT.search(text):
        return False
    try:
        return bool(IPv6Address(text))
    except AddressValueError:
        return False


def _numbers(text: str) -> list[tuple[int, int, str]]:
    """Numbers and tokens; most texts have no digit and end here at once."""
    found, at = [], 0
    if not _ANY_DIGIT.search(text):
        return found
    while begin := _BEGIN.search(text, at):
        m = _NUMBERS.match(text, begin.start())
        if m:
            found.append((m.start(), m.end(), next(k for k, v in m.groupdict().items() if v is not None)))
        at = m.end() if m else _RUN.match(text, begin.start()).end()
    word = lambda c: c.isascii() and (c.isalnum() or c == "_")
    at = 0
    while m := _COLONS.search(text, at):
        a = m.start() - len(_IPV6_HEAD.search(text[max(0, m.start() - 4):m.start()]).group())
        b = _IPV6.match(text, a).end()
        at = max(b, m.end())
        if text[b - 1] == ":" and text[b - 2:b] != "::":  # a colon of the sentence
            b -= 1
        if not (a and (word(text[a - 1]) or text[a - 1] in ".:") or b < len(text) and (word(text[b]) or text[b] == "." and text[b + 1:b + 2].isdigit())) and _is_ipv6(text[a:b]):
            found.append((a, b, "ip"))
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        if not (a and word(text[a - 1]) or b < len(text) and word(text[b])) and _ANY_DIGIT.search(text, a, b):
            found.append((a, b, "token"))
    return found


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical entity) of the entities of a text, in order, none overlapping."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "email") for m in _EMAIL.finditer(text)]
    found += _numbers(text)
    for m in _TITLED.finditer(text) if _ANY_TITLE.search(text) else ():
        gender, (first, second) = _TITLE[m.group(1)], m.span(2)
        if m.group(3):
            given = _GENDER_OF.get(m.group(2), ("", gender))[1]
            found += [(first, second, f"given-{given}"), (*m.span(3), "surname")]
        else:
            found.append((first, second, f"given-{_GENDER_OF[m.group(2)][1]}" if m.group(2) in _GENDER_OF else "surname"))
    if not _KNOWN_NAMES.isdisjoint(text.split()):
        for m in _KNOWN.finditer(text):
            found += [(*m.span(1), f"given-{_GENDER_OF[m.group(1)][1]}"), (*m.span(2), "surname")]
    out, at = [], 0
    for start, end, kind in sorted(set(found), key=lambda f: (f[0], -f[1], f[2])):
        if start >= at:
            out.append((start, end, kind, canonical(kind, text[start:end])))
            at = end
    return out


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Mentions: doc_id, tag (hash of the text), kind, entity (canonical)."""
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("kind", pa.string()), ("entity", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, tag, kind, entity) for doc, tag, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tag", "text")))
                    for _, _, kind, entity in detect(text or "")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return id_text(docs, id_col, text_col).withColumn("tag", F.xxhash64("text")).mapInArrow(run, "doc_id long, tag long, kind string, entity string")


def redrawn(distinct: DataFrame, key: bytes, attempts: int = 40) -> DataFrame:
    """Of distinct (kind, entity) those whose first surrogate clashes, with the `attempt` that does not."""
    schema = pa.schema([("kind", pa.string()), ("entity", pa.string()), ("attempt", pa.int32()), ("surrogate", pa.string())])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([surrogate(key, *row) for row in zip(*columns)], pa.string())], schema=schema)

    current = distinct.select("kind", "entity", F.lit(0).alias("attempt"))
    for _ in range(attempts):
        drawn = checkpoint(current.mapInArrow(draw, "kind string, entity string, attempt int, surrogate string"))
        # known given names come first: their ring has no other place for them
        first = F.min(F.struct(~F.col("entity").isin(list(_GENDER_OF_FOLDED)), "entity"))["entity"]
        shared = drawn.groupBy("kind", "surrogate").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
        twice = drawn.join(shared, ["kind", "surrogate"]).where("entity <> first").select("kind", "entity")
        real = (drawn.where("kind not like 'given%'").join(distinct.select("kind", F.col("entity").alias("surrogate")), ["kind", "surrogate"], "left_semi")
                .select("kind", "entity"))
        same = drawn.where("entity = surrogate").select("kind", "entity")
        clash = checkpoint(twice.union(real).union(same).distinct())
        if clash.isEmpty():
            return drawn.where("attempt > 0").select("kind", "entity", "attempt")
        current = (drawn.join(clash.withColumn("again", F.lit(1)), ["kind", "entity"], "left")
                   .select("kind", "entity", (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt")))
    raise ValueError(f"surrogates still clash after {attempts} draws")


def replace_entities(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", max_redrawn: int = 200_000) -> DataFrame:
    """One row for each document: doc_id, text (with surrogates) and entities (kind and the [start, end) characters in
    the original and in the new text)."""
    rows = id_text(docs, id_col, text_col).withColumn("tag", F.xxhash64("text"))
    mentions = entities(docs, id_col, text_col)
    again = checkpoint(redrawn(checkpoint(mentions.select("kind", "entity").distinct()), key))
    few = again.count() <= max_redrawn
    table = {(r.kind, r.entity): r.attempt for r in again.collect()} if few else {}
    shared = docs.sparkSession.sparkContext.broadcast(table)
    if few:
        rows = rows.withColumn("again", F.lit(None).cast("array<struct<kind: string, entity: string, attempt: int>>"))
    else:
        each = mentions.distinct().join(again, ["kind", "entity"]).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias("again"))
        joined = rows.join(each.select(F.col("doc_id").alias("own"), F.col("tag").alias("own_tag"), "again"),
                           F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("tag") == F.col("own_tag")), "left")
        rows = joined.select("doc_id", "text", "tag", "again")
    place = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("new_start", pa.int64()), ("new_end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("entities", place)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, places = [], []
            for text, extra in zip(batch.column("text").to_pylist(), batch.column("again").to_pylist()):
                attempts = shared.value if extra is None else {(e["kind"], e["entity"]): e["attempt"] for e in extra}
                out, where, at, length = [], [], 0, 0
                for start, end, kind, entity in detect(text or ""):
                    new = _laid_out(kind, text[start:end], surrogate(key, kind, entity, attempts.get((kind, entity), 0)))
                    out += [text[at:start], new]
                    length += start - at
                    where.append({"kind": kind, "start": start, "end": end, "new_start": length, "new_end": length + len(new)})
                    length += len(new)
                    at = end
                texts.append(text if text is None or not where else "".join([*out, text[at:]]))
                places.append(where)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(places, place)], schema=schema)

    kinds = "kind: string, start: long, end: long, new_start: long, new_end: long"
    return rows.select("doc_id", "text", "again").mapInArrow(run, f"doc_id long, text string, entities array<struct<{kinds}>>")
