"""Surrogates for personal data: keyed, of the same type and shape, distinct.

Entities are found by pattern: e-mail and IPv4 addresses, telephone and card numbers,
credentials, and names after a form of address.  The same entity (whatever its case or
spacing) gets the same surrogate everywhere under one key, so references to it survive.

* Numbers, addresses and credentials are enciphered within their own shape: every digit
  stays a digit and every letter a letter of its case, by a Feistel cipher over exactly
  the strings of that shape.  It is a bijection, so distinct entities of a shape stay
  distinct.  Card numbers keep a valid check digit, addresses stay addresses, country
  codes, the first part of a domain and its ending stay as they are.
* A name is replaced part by part: given names and the family name each have a surrogate
  of their own in their own script, so a full name, the family name alone and the same
  person under another form of address stay one person.  Gender only picks the ending; a
  form of address that tells none takes the gender that the corpus tells of the first part
  it tells one of (all its other mentions with that part agree), else a keyed one.  Each
  part keeps its writing (capitals or not).

A pass over the distinct entities of all documents checks that no two surrogates are the
same and that none is an entity of the corpus; whatever fails is enciphered again under
a further round until nothing does.  Only those exceptions, and the genders that
genderless forms of address need, want a table.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import BROADCAST_ROWS, whole_text, written

ROUNDS = 8
LIMIT_ROUNDS = 50
FOUND = "kind string, entity string"
# An entity with more mentions than this is spread over several keys of a join.
HOT_MENTIONS = 100_000

# Forms of address, with the gender they tell (f, m or none).
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Prof": "",
    "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f",
    "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f",
    "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
}
# Syllables and endings that names are made of; all syllables are of two letters and the
# endings of a script and part of a name differ in no way that two stems could make good.
SYLLABLES = {
    "latin": "ba be bo da de do fa ga ka ke ko la le lo ma me mo na ne no pa ra re ro sa se so ta te to va vo".split(),
    "cyrillic": "ба бе бо ва ве во да де до за ка ко ла ле ло ма ме мо на не но па ра ре ро са се со та то".split(),
    "greek": "βα γα δα δο κα κο λα λε λο μα με μο να νε νο πα πο ρα ρε ρο σα σε σο τα τε το".split(),
}
ENDINGS = {
    ("family", "latin"): {"f": "n", "m": "n"},
    ("family", "cyrillic"): {"f": "ва", "m": "в"},
    ("family", "greek"): {"f": "ου", "m": "ς"},
    ("given", "latin"): {"f": "lia", "m": "rik"},
    ("given", "cyrillic"): {"f": "лия", "m": "рик"},
    ("given", "greek"): {"f": "λια", "m": "ρος"},
}
# Syllables of a stem; every further attempt has one more, so there are always enough.
STEM = {"given": 3, "family": 4}
# Published prefixes of access tokens.
TOKEN_PREFIXES = (
    "AIza", "github_pat_", "gho_", "ghp_", "ghr_", "ghs_", "ghu_", "glpat-", "hf_", "npm_",
    "pk_live_", "pk_test_", "pypi-", "rk_live_", "sk-", "sk_live_", "sk_test_",
    "xoxa-", "xoxb-", "xoxp-", "xoxs-",
)
# Words before a credential, in any case.
SECRET_WORDS = ("password", "passwd", "pwd", "secret", "token", "api_key", "api-key", "apikey", "access_key", "access-key")

_PART = r"[^\W\d_][^\W\d_'’]*(?:-[^\W\d_]+)*"
_NAME = rf"\b(?P<title>{'|'.join(TITLES)})(?P<dot>\.?[  ])(?P<name>{_PART}(?:[  ]{_PART}){{0,2}})"
# Telephone numbers without a plus or parentheses: three, three and four digits; those
# with a leading 0; and after a word for telephone any in two to five groups.  Groups are
# parted alike.  Dates (two, two and four digits) and parts of longer numbers are not.
_NATIONAL = (
    r"(?<![\w/+.-])(?<!\d[:, ])(?:"
    r"(?:1[ .-])?[2-9]\d\d(?:-\d{3}-|\.\d{3}\.)\d{4}(?!\w|[.,:/-]\d)"
    r"|(?:1 )?[2-9]\d\d \d{3} \d{4}(?!\w|[.,:/ -]\d)"
    r"|(?!\d\d(?P<d1>[ ./-])\d\d(?P=d1)\d{4}(?!\d))(?=0(?:[ ./-]?\d){6,11}(?!\d))0[1-9]\d{0,4}"
    r"(?:[ ./-]\d{4,9}|(?P<d2>[ .-])\d{2,4}(?:(?P=d2)\d{2,4}){1,3}|/\d{2,4}(?:[ -]\d{2,4}){1,2})(?!\w|[.,:/-]\d))"
)
_CUE = r"(?<!\w)(?i:tel|telephone|phone|fax|mobile|cell|call|telefon|teléfono|tél|тел|τηλ)[.:]{0,2} ?"
_CALLED = r"(?!\d\d(?P<d3>[ ./-])\d\d(?P=d3)\d{4}(?!\d))(?=\d(?:[ ./-]?\d){6,11}(?!\d))(?:\d{7,12}|\d{1,5}(?P<d4>[ ./-])\d{2,8}(?:(?P=d4)\d{2,6}){0,3})(?!\w|[.,:/-]\d)"
_PLUS = r"(?<![\w+])\+\d{1,3}[ .-]?\(0\)(?:[ ./-]?\d){6,12}(?!\d)"
_IS = r"[\"']? ?= ?[\"']?"
_SIGN = re.compile(r"[\"']? ?[=:] ?[\"']?")
_LEAD = re.compile(f"(?:{'|'.join(('AKIA', 'ASIA', *TOKEN_PREFIXES))})(?=.{{8}})")
PATTERN = re.compile(
    r"(?P<email>[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,})"
    r"|(?P<secret>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\b(?:password|passwd|secret|token|api_key) ?[=:] ?[A-Za-z0-9_-]{8,}"
    # Of a word and a colon in prose, only a value with a digit is a credential.
    rf"|(?<![A-Za-z0-9])(?i:{'|'.join(SECRET_WORDS)})(?:{_IS}|[\"']? ?: ?[\"']?(?=[A-Za-z_-]*\d))[A-Za-z0-9_-]{{8,}}"
    rf"|(?<![A-Za-z0-9_-])(?:{'|'.join(TOKEN_PREFIXES)})(?=[A-Za-z_-]*\d)[A-Za-z0-9_-]{{20,}})"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d))"
    r"|(?P<card>(?<![\d-])(?:(?:\d{4}[ -]?){3}\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\d-]*\d))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d){7,12}(?!\d))"
    rf"|(?P<plus>{_PLUS})"
    rf"|(?P<national>{_NATIONAL})"
    rf"|{_CUE}(?P<called>{_CALLED})"
    rf"|{_NAME}"
)
NATIONAL = re.compile(_NATIONAL)
KINDS = frozenset(["email", "secret", "ip", "card", "phone", "plus", "national", "called"])
TRUNK = "(0)"  # written after a country code, not dialled with it
# What every entity holds a part of; it keeps most texts off the pattern.
_DIGITS = re.compile(r"[0-9][0-9. /()-]{5}")
_MARKS = ("@", "AKIA", "ASIA", *TOKEN_PREFIXES, *TITLES)


def may_hold(text: str) -> bool:
    """False only where ``text`` has no entity."""
    if any(mark in text for mark in _MARKS) or _DIGITS.search(text):
        return True
    lower = text.lower()
    return any(word in lower for word in SECRET_WORDS)


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for n, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if n % 2 == 0 else 1)
        total += value - 9 if value > 9 else value
    return -total % 10


def script_of(text: str) -> str:
    for char in text:
        if "Ͱ" <= char <= "Ͽ" or "ἀ" <= char <= "῿":
            return "greek"
        if "Ѐ" <= char <= "ӿ":
            return "cyrillic"
    return "latin"


def found_in(text: str) -> Iterator[tuple[str, str, int, int]]:
    """Kind, normal form, start and end of every entity in turn; none spans lines."""
    if not may_hold(text):
        return
    at = 0
    for line in text.split("\n"):
        if may_hold(line):
            for kind, normal, lo, hi in _found_in_line(line):
                yield kind, normal, at + lo, at + hi
        at += len(line) + 1


def _found_in_line(line: str) -> Iterator[tuple[str, str, int, int]]:
    at = 0
    while match := PATTERN.search(line, at):
        at = match.end()
        kind = match.lastgroup if match.lastgroup in KINDS else "name"
        value, lo, hi = match[kind], *match.span(kind)
        if kind == "card" and not _is_card(value) and (other := NATIONAL.match(line, lo)):
            kind, value, at, hi = "phone", other[0], other.end(), other.end()
        if kind in ("plus", "national", "called"):
            kind = "phone"
        if kind == "email":
            normal = value.lower()
        elif kind == "card":
            normal = re.sub(r"\D", "", value)
            if not _is_card(value):
                continue
        elif kind == "phone":
            normal = re.sub(r"[^\d+]", "", value.replace(TRUNK, ""))
        elif kind == "secret":
            sign = None if _LEAD.match(value) else _SIGN.search(value)
            lo += sign.end() if sign else 0
            normal = line[lo:hi]
        elif kind == "name":
            length = _name_length(value)
            # What follows a name, or isn't one, may begin the next.
            at = hi = lo + length
            if not length:
                continue
            words = re.split("[ \u00a0]", line[lo:hi])
            normal = f"{TITLES[match['title']]}|{' '.join(words).casefold()}"
        else:
            normal = value
        yield kind, normal, lo, hi


def _is_card(value: str) -> bool:
    digits = re.sub(r"\D", "", value)
    return 13 <= len(digits) <= 19 and luhn(digits[:-1]) == int(digits[-1])


def _name_length(value: str) -> int:
    """Length of the leading parts that are written like a name."""
    length = 0
    for part in re.finditer(r"[^  ]+", value):
        if not part[0][0].isupper():
            break
        length = part.end()
    return length


class Cipher:
    """Keyed bijections over the strings of one shape."""

    def __init__(self, key: bytes):
        self.key = key

    def number(self, *context) -> int:
        text = "\x1f".join(map(str, context)).encode("utf-8", "surrogatepass")
        return int.from_bytes(hmac.digest(self.key, text, hashlib.sha256)[:16], "big")

    def permuted(self, x: int, size: int, *context) -> int:
        """``x`` under a bijection of range(size): a Feistel net, walked until inside."""
        if size < 2:
            return x
        low = 1
        while low * low < size:
            low += low
        while True:
            left, right = divmod(x, low)
            for n in range(ROUNDS):
                left, right = right, (left + self.number(*context, n, right)) % low
            x = left * low + right
            if x < size:
                return x

    def shaped(self, text: str, *context) -> str:
        """``text`` with every digit and letter replaced within its own class."""
        sets = [_alphabet(c) for c in text]
        size = 1
        for s in sets:
            size *= len(s)
        x = 0
        for char, s in zip(text, sets):
            x = x * len(s) + s.index(char)
        shape = "".join(s[0] for s in sets)
        x = self.permuted(x, size, *context, shape)
        out = []
        for s in reversed(sets):
            x, digit = divmod(x, len(s))
            out.append(s[digit])
        return "".join(reversed(out))


@lru_cache(maxsize=4096)
def _alphabet(char: str) -> str:
    for first, last in ("09", "az", "AZ"):
        if first <= char <= last:
            return "".join(map(chr, range(ord(first), ord(last) + 1)))
    return char


def surrogate(cipher: Cipher, kind: str, normal: str, attempt: int) -> str:
    """The normal form of the surrogate."""
    mark = (kind, attempt)
    if kind == "email":
        local, domain = normal.split("@")
        host, dot, ending = domain.rpartition(".")
        label, rest_dot, rest = host.partition(".")
        # The first label is enciphered with the address; a known domain stays together.
        hidden = cipher.shaped(label, "domain", rest + dot + ending) if not rest_dot else label
        return f"{cipher.shaped(local, *mark, domain)}@{hidden}{rest_dot}{rest}{dot}{ending}"
    if kind == "card":
        # The first digit tells the kind of card.
        body = normal[0] + cipher.shaped(normal[1:-1], *mark, normal[0])
        return f"{body}{luhn(body)}"
    if kind == "ip":
        value = 0
        for part in normal.split("."):
            value = value << 8 | int(part)
        value = cipher.permuted(value, 1 << 32, *mark)
        return ".".join(str(value >> shift & 255) for shift in (24, 16, 8, 0))
    if kind == "phone":
        # The country code stays: up to three digits that leave at least seven.
        code = normal[: max(1, min(4, len(normal) - 10))] if normal[0] == "+" else ""
        # So does the first digit of the area, which may not be any; a leading 0 or 1
        # is not part of it.
        led = not code and (normal[0] == "0" or len(normal) == 11 and normal[0] == "1")
        code = normal[: len(code) + 1 + led]
        return code + cipher.shaped(normal[len(code) :], *mark, code)
    if kind == "secret":
        lead = match[0] if (match := _LEAD.match(normal)) else ""
        if re.fullmatch("[0-9a-f]+", normal):
            x = cipher.permuted(int(normal, 16), 16 ** len(normal), *mark, len(normal))
            return f"{x:0{len(normal)}x}"
        return lead + cipher.shaped(normal[len(lead) :], *mark, lead)
    if kind in STEM:
        syllables = SYLLABLES[script_of(normal)]
        n = cipher.number(*mark, normal)
        made = ""
        for _ in range(STEM[kind] + attempt):
            n, pick = divmod(n, len(syllables))
            made += syllables[pick]
        return made
    return person(cipher, normal, lambda part, word: surrogate(cipher, part, word, attempt))


def parts_of_name(normal: str) -> list[tuple[str, str]]:
    """The entities that a name consists of: given names, then the family name."""
    words = normal.split("|", 1)[1].split(" ")
    return [("given", word) for word in words[:-1]] + [("family", words[-1])]


def person(cipher: Cipher, normal: str, stem, told=lambda part, word: None) -> str:
    """The surrogate of a name from stems of its parts and the gender told of them."""
    gender = normal.split("|", 1)[0]
    parts = parts_of_name(normal)
    sex = gender or next((sex for part in parts if (sex := told(*part))), None)
    sex = sex or "fm"[cipher.number("gender", *parts[0]) % 2]
    return f"{gender}|" + " ".join(
        stem(kind, word) + ENDINGS[kind, script_of(word)][sex] for kind, word in parts
    )


def written_like(kind: str, normal: str, was: str) -> str:
    """A surrogate's normal form in the writing of the text it replaces."""
    if kind == "name":
        new = normal.split("|", 1)[1].split(" ")
        old = re.split("([  ])", was)
        for n, word in enumerate(new):
            like = old[2 * n]
            old[2 * n] = word.upper() if like.isupper() and len(like) > 1 else word.title()
        return "".join(old)
    if kind in ("card", "phone"):
        digits = iter(normal.replace("+", ""))
        # A trunk digit in parentheses is no part of the normal form.
        return TRUNK.join(
            "".join(next(digits) if c.isdigit() else c for c in part) for part in was.split(TRUNK)
        )
    if kind == "email" and was != was.lower():
        return "".join(n.upper() if w.isupper() else n for n, w in zip(normal, was))
    return normal


def entities(docs: DataFrame) -> DataFrame:
    """Distinct kinds and normal forms over all texts, names by part with the gender of
    the form of address (empty if it tells none); repeats go within a task first."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for text in batch.column(0):
                for kind, normal, _, _ in found_in(text.as_py()):
                    if kind == "name":
                        gender = normal.split("|", 1)[0]
                        seen.update((*part, gender) for part in parts_of_name(normal))
                    else:
                        seen.add((kind, normal, ""))
            columns = list(zip(*seen)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.string()) for column in columns], ["kind", "entity", "gender"]
            )

    return (
        docs.select(whole_text().alias("text")).mapInArrow(find, f"{FOUND}, gender string").distinct()
    )


def genders(found: DataFrame) -> DataFrame:
    """The gender of each part of a name with a genderless form of address, where all
    forms of address that tell one agree (``kind``, ``entity``, ``sex``)."""
    told = F.when(F.col("gender") != "", F.col("gender"))
    return (
        found.where(F.col("kind").isin(*STEM))
        .groupBy("kind", "entity")
        .agg(F.min(told).alias("sex"), F.max(told).alias("other"), F.min("gender").alias("least"))
        .where("least = '' and sex = other")
        .select("kind", "entity", "sex")
    )


def _taken(found: DataFrame) -> DataFrame:
    """What no surrogate may be: an entity, or a stem that an ending makes one."""
    stems = [
        F.when(
            (F.col("kind") == kind) & F.col("entity").endswith(ending),
            F.expr(f"substr(entity, 1, length(entity) - {len(ending)})"),
        )
        for (kind, _), endings in ENDINGS.items()
        for ending in sorted({e.casefold() for e in endings.values()})
    ]
    return (
        found.select("kind", F.explode(F.array("entity", *stems)).alias("surrogate"))
        .where("surrogate is not null")
        .distinct()
        .withColumn("real", F.lit(True))
    )


def _enciphered(rows: DataFrame, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = Cipher(key.encode())
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            out = [surrogate(cipher, kind, entity, attempt) for kind, entity, attempt in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.string())],
                [*batch.schema.names, "surrogate"],
            )

    return rows.select("kind", "entity", "attempt").mapInArrow(
        run, f"{FOUND}, attempt int, surrogate string"
    )


def checked(found: DataFrame, key: str) -> DataFrame:
    """Every entity with a surrogate that is no other's and no entity of the corpus."""
    known = _taken(found)
    table = written(_enciphered(found.withColumn("attempt", F.lit(0)), key), "surrogates")
    for _ in range(LIMIT_ROUNDS):
        order = Window.partitionBy("kind", "surrogate").orderBy("attempt", "entity")
        marked = (
            table.withColumn("nth", F.row_number().over(order))
            .join(known, ["kind", "surrogate"], "left")
            .withColumn("bad", (F.col("nth") > 1) | F.coalesce("real", F.lit(False)))
        )
        marked = written(marked.select("kind", "entity", "attempt", "surrogate", "bad"), "surrogates")
        if not marked.where("bad").head(1):
            return table
        again = marked.where("bad").withColumn("attempt", F.col("attempt") + 1)
        table = written(
            marked.where("not bad").drop("bad").unionByName(_enciphered(again, key)),
            "surrogates",
        )
    raise ValueError(f"surrogates still collide after {LIMIT_ROUNDS} rounds")


def replace(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities`` replaced in each.

    ``docs`` needs ``text`` and keeps all its columns; an ``n_entities`` among them is
    replaced.  A null text stays null with no entity; rows, ids and all other columns
    stay as they are.  Entities that overlap are taken from the left, the longest kind
    listed first.
    """
    found = written(entities(docs), "entities")
    table = checked(found.select("kind", "entity").distinct(), key)
    table = table.join(genders(found), ["kind", "entity"], "left")
    exceptions = table.where("attempt > 0 or sex is not null")
    count = exceptions.count()
    if count > BROADCAST_ROWS:
        return _replaced_by_join(docs, table, key)
    rows = exceptions.select("kind", "entity", "attempt", "sex").collect()
    later = docs.sparkSession.sparkContext.broadcast(
        {(r["kind"], r["entity"]): (r["attempt"], r["sex"]) for r in rows}
    )

    def lookup(cipher: Cipher, kind: str, normal: str) -> str:
        def known(kind: str, entity: str) -> tuple[int, str | None]:
            return later.value.get((kind, entity), (0, None))

        def stem(kind: str, word: str) -> str:
            return surrogate(cipher, kind, word, known(kind, word)[0])

        if kind == "name":
            return person(cipher, normal, stem, lambda *part: known(*part)[1])
        return stem(kind, normal)

    return _rewritten(docs, key, lookup)


def _rewritten(docs: DataFrame, key: str, lookup) -> DataFrame:
    spark_type = "struct<text:string,n_entities:int>"

    @F.pandas_udf(spark_type)
    def rewrite(texts):
        import pandas as pd

        cipher = Cipher(key.encode())
        out, counts = [], []
        for text in texts:
            if text is None:
                out.append(None)
                counts.append(0)
                continue
            parts, at, n = [], 0, 0
            for kind, normal, lo, hi in found_in(text):
                parts += [text[at:lo], written_like(kind, lookup(cipher, kind, normal), text[lo:hi])]
                at, n = hi, n + 1
            out.append("".join([*parts, text[at:]]) if n else text)
            counts.append(n)
        return pd.DataFrame({"text": out, "n_entities": counts})

    columns = [name for name in docs.columns if name != "n_entities"]
    made = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"), rewrite(F.col("text")).alias("new")
    )
    return made.select(
        *[F.col("new" if c == "text" else "doc").getField(c).alias(c) for c in columns],
        F.col("new").getField("n_entities").alias("n_entities"),
    )


def _replaced_by_join(docs: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """The same where the exceptions don't fit a broadcast: a join by entity.

    Only mentions are joined, names by part.  Those of an entity with very many are
    spread over several keys; the entities with so many are few.
    """
    columns = [name for name in docs.columns if name != "n_entities"]
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
        whole_text().alias("text"),
        F.expr("uuid()").alias("row"),
    )
    named = written(named, "surrogate-rows")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, text in zip(*(c.to_pylist() for c in batch.columns)):
                for n, (kind, normal, _, _) in enumerate(found_in(text)):
                    parts = parts_of_name(normal) if kind == "name" else [(kind, normal)]
                    out += [(row, n, place, *part) for place, part in enumerate(parts)]
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["row", "n", "place", "kind", "entity"],
            )

    spots = named.select("row", "text").mapInArrow(
        cut, f"row string, n int, place int, {FOUND}"
    )
    spots = written(spots, "surrogate-spots")
    hot = (
        spots.groupBy("kind", "entity")
        .agg(F.floor(F.count(F.lit(1)) / HOT_MENTIONS).cast("int").alias("more"))
        .where("more > 0")
    )
    hot = written(hot, "surrogate-hot")
    if hot.count() <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    more = F.coalesce("more", F.lit(0))
    spots = spots.join(hot, ["kind", "entity"], "left").withColumn(
        "salt", F.expr("cast(pmod(xxhash64(row), coalesce(more, 0) + 1) as int)")
    )
    spread = table.join(hot, ["kind", "entity"], "left").select(
        "kind", "entity", "surrogate", "sex", F.explode(F.sequence(F.lit(0), more)).alias("salt")
    )
    packed = (
        spots.join(spread, ["kind", "entity", "salt"])
        .groupBy("row")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("n", "place", "kind", "entity", "surrogate", "sex"))
            ).alias("spots")
        )
    )

    @F.pandas_udf("struct<text:string,n_entities:int>")
    def put(texts, spots):
        import pandas as pd

        cipher = Cipher(key.encode())
        out, counts = [], []
        for text, known in zip(texts, spots):
            parts, at, n = [], 0, 0
            if known is not None:
                made = {(k["kind"], k["entity"]): (k["surrogate"], k["sex"]) for k in known}
                for kind, normal, lo, hi in found_in(text):
                    if kind == "name":
                        new = person(
                            cipher, normal, lambda *part: made[part][0], lambda *part: made[part][1]
                        )
                    else:
                        new = made[kind, normal][0]
                    parts += [text[at:lo], written_like(kind, new, text[lo:hi])]
                    at, n = hi, n + 1
            out.append("".join([*parts, text[at:]]))
            counts.append(n)
        return pd.DataFrame({"text": out, "n_entities": counts})

    joined = named.join(packed, "row", "left").select("doc", put("text", "spots").alias("new"))
    text = F.when(F.col("doc").getField("text").isNotNull(), F.col("new").getField("text"))
    return joined.select(
        *[text.alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in columns],
        F.col("new").getField("n_entities").alias("n_entities"),
    )
