"""Surrogates for personal data: keyed, of the same type and form, distinct and consistent.

Found are e-mail addresses, phone numbers (international, with an area code in parentheses, in groups of three, three and
four digits, or with a leading 0), IPv4 addresses, card numbers, social security numbers, secrets (after a word like token
and = or :, quoted or not; long hexadecimal strings; tokens with a known prefix; card numbers have a right check digit or stand in
groups), the names after a title, and every
other capitalised mention of those names in the same document.

A surrogate is a keyed permutation of the characters' places in their alphabets (a Feistel network over symbols of
different radix): a digit stays a digit, a letter a letter of its script and case, an octet an octet of as many digits,
a card number keeps its check digit right or wrong, country codes, top-level and reserved domains stay.  So different values of
one form always get different surrogates.  A value gets the same one everywhere: addresses, names and hexadecimal
strings are compared in small letters, phone, card and social security numbers by their digits (and a leading +), and each
occurrence gets its own case and separators back.  Names are built from syllables of their script; given names end as
their title's gender asks, family names as they would for either.

*Collision checks.* All values of the corpus are compared with all surrogates.  A surrogate that equals a value that occurs,
or that two values share (names), is drawn again with the next number, the smaller value going first, until none is
left.  Draws from ``OWN_FORM`` on make the value longer by one more character each (addresses of four octets: with octets of
any length), so full forms give way to ones with room.  Should values still be left after ``MOST_DRAWS`` draws, that is an
error.  Only such exceptions are looked up when texts are rewritten; the others follow from the key.

Defined cases: a null text stays null and has no entities; an empty text stays empty; repeated rows are
rewritten alike, rows with equal or null ``doc_id`` too; an empty table gives an empty result; other columns are kept
(``n_entities`` is replaced).
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import stored, unused
from revmart.operators.lineage import cut_lineage

ROUNDS = 6
#: Draws within a value's own form; draws at which the rounds give up with an error.
OWN_FORM, MOST_DRAWS = 12, 256

# Titles that come before a name, and the gender they tell.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f",
    "Mme": "f", "Señor": "m", "Señora": "f", "г-н": "m", "г-жа": "f", "Κύριος": "m", "Κυρία": "f",
}

#: Alphabets by rule: first and last code point, without the two signs among the Latin-1 letters.
ALPHABETS = [
    "".join(chr(c) for c in range(a, b + 1) if c not in (0xD7, 0xF7))
    for a, b in ((0x30, 0x39), (0x61, 0x7A), (0x41, 0x5A), (0xDF, 0xFF), (0xC0, 0xDE), (0x430, 0x44F), (0x410, 0x42F), (0x3B1, 0x3C9), (0x391, 0x3A1), (0x3A3, 0x3A9))
]
HEX = "0123456789abcdef"
PLACE = {c: (alphabet, i) for alphabet in ALPHABETS for i, c in enumerate(alphabet)}
#: Consonants, vowels, and endings by gender, per script.
SYLLABLES = {
    "latin": ("bdfgklmnprstv", "aeiou", {"m": ("n", "o", "r", "s"), "f": ("a", "ia", "ina", "e"), "": ("er", "sen", "ard", "ov")}),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", {"m": ("н", "р", "й", "с"), "f": ("а", "ия", "ина", "я"), "": ("енко", "ук", "ич", "ян")}),
    "greek": ("βγδζκλμνπρστ", "αεηιο", {"m": ("ος", "ης", "ας", "ων"), "f": ("α", "ια", "ινα", "η"), "": ("ιδης", "ου", "ακης", "ιου")}),
}

WORD_CHAR = r"[\w.%+-]"
EMAIL = re.compile(rf"(?<!{WORD_CHAR}){WORD_CHAR}+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{{2,}}")
NUMBERS = re.compile(
    r"(?P<phone>(?<![\w+])(?:\+?\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\w+])\+\d{7,15}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}[ ./-]?\(\d{1,4}\)(?:[ ./-]?\d{2,8}){1,4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}[ ./-]\d{1,8}(?:[ ./-]\d{2,8}){1,4}(?!\d)"
    r"|(?<![\w.-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w.+-])0\d{1,4}[ /-]\d{5,8}(?![\w-])|(?<![\w.+-])0\d(?:[ .]\d{2}){4}(?![\w-]))"
    r"|(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\w))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))"
)
SECRET = re.compile(
    r"(?:token|secret|password|passwd|api[_-]?key)[\"']?\s*[=:]\s*"
    r"(?:(?P<mark>[\"'])(?P<quoted>(?:(?!(?P=mark))[^\r\n])+)(?P=mark)|[\"']?(?P<bare>[^\s\"'<>&,;]{3,}))"
    r"|(?<![0-9A-Za-z])(?P<hex>[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])",
    re.IGNORECASE,
)
#: Tokens known by their prefix, which stays.
PREFIXED = re.compile(
    r"(?<![0-9A-Za-z_-])(?:(?:AKIA|ASIA)(?P<upper>[0-9A-Z]{16})|(?:gh[pousr]_|sk[-_](?:live_|test_)?|xox[abprs]-|[Bb]earer )(?P<rest>[\w.~+/-]{16,}))"
)
# The world's country codes by their first digits.
COUNTRY = re.compile(r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{1,3})|")
LETTERS = r"[^\W\d_]"
#: Letters, with apostrophes and hyphens between them; an 's at the end is not the name's.
NAME_WORD = rf"{LETTERS}+(?:(?!['’]s(?!\w))['’-]{LETTERS}+)*"
NAME = re.compile(
    rf"(?<!\w)(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})\.? (?:{LETTERS}\. )*(?P<one>{NAME_WORD})"
    rf"(?: (?:{LETTERS}\. )*(?P<two>{NAME_WORD}))?(?: (?P<three>{NAME_WORD}))?"
)
MENTION = re.compile(rf"(?<!\w){NAME_WORD}")


@dataclass(frozen=True)
class Entity:
    """A value in a text: place, type, and the value in the case that all its forms share."""

    start: int
    end: int
    kind: str
    value: str
    shown: str


def lowered(text: str) -> str:
    """The text in small letters, character by character; those without one of their own stay."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def folded(kind: str, text: str) -> str:
    """The value of a text of this kind, the same for all its forms."""
    if kind in ("phone", "card", "ssn"):
        return "+" * text.startswith("+") + "".join(c for c in text if c.isdigit())
    if kind == "email" or kind.startswith("name-") or set(lowered(text)) <= set(HEX):
        return lowered(text)
    return lowered(text) if text == text.upper() else text


def restored(kind: str, shown: str, value: str, made: str) -> str:
    """The surrogate ``made`` of ``value`` in the form in which the value is shown."""
    if kind in ("phone", "card", "ssn"):
        digits = [c for c in made if c.isdigit()]
        places = [i for i, c in enumerate(shown) if c.isdigit()]
        out = list(shown)
        for i, d in zip(places, digits):
            out[i] = d
        out[places[-1]] += "".join(digits[len(places) :])
        return "".join(out)
    upper = lambda t: "".join(c.upper() if len(c.upper()) == 1 else c for c in t)
    if kind.startswith("name-"):
        return upper(made) if len(shown) > 1 and shown == shown.upper() else upper(made[0]) + made[1:]
    if shown == value:
        return made
    if shown == upper(shown):
        return upper(made)
    more = len(made) - len(shown)  # characters that a later draw put before the @ or at the end
    at = shown.index("@") if kind == "email" else len(shown)
    shape = shown[:at] + " " * more + shown[at:]
    return "".join(upper(c) if k.isupper() else c for c, k in zip(made, shape))


def script_of(text: str) -> str:
    c = ord(text[0].lower())
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def _names(text: str) -> list[Entity]:
    """Names after a title, and all mentions of their words; the last word is the family name, those before are given."""
    found: list[Entity] = []
    known: dict[str, str] = {}  # a word's kind where no title tells: given names first
    places = set()
    for m in NAME.finditer(text):
        words = []
        for g in ("one", "two", "three"):
            if not m[g] or not m[g][0].isupper():
                break
            words.append(g)
        for i, group in enumerate(words):
            word, last = m[group], i == len(words) - 1
            kind = f"name-{script_of(word)}-{'' if last else TITLES[m['title']]}"
            found.append(Entity(m.start(group), m.end(group), kind, lowered(word), word))
            places.add(m.start(group))
            if not last or lowered(word) not in known:
                known[lowered(word)] = kind
    if found:
        for m in MENTION.finditer(text):
            # A word with a hyphen that is no name itself may have one as a part.
            spans = [m.span()] if lowered(m[0]) in known else [(m.start() + p.start(), m.start() + p.end()) for p in re.finditer(rf"{LETTERS}+", m[0])]
            for a, b in spans:
                word = text[a:b]
                if a not in places and word[0].isupper() and lowered(word) in known:
                    found.append(Entity(a, b, known[lowered(word)], lowered(word), word))
    return found


def find_entities(text: str) -> list[Entity]:
    """Entities from left to right; of overlapping ones the first found kind stays."""
    found: list[Entity] = []
    add = lambda a, b, kind: found.append(Entity(a, b, kind, folded(kind, text[a:b]), text[a:b]))
    if "@" in text:
        for m in EMAIL.finditer(text):
            add(m.start(), m.end(), "email")
    for m in SECRET.finditer(text):
        group = next(g for g in ("quoted", "bare", "hex") if m[g])
        end = m.end(group) - (len(m[group]) - len(m[group].rstrip(".!?:)]}")) if group == "bare" else 0)
        if end > m.start(group):
            add(m.start(group), end, "secret")
    for m in PREFIXED.finditer(text):
        add(m.start(m.lastgroup), m.end(m.lastgroup), "secret")
    if re.search(r"[0-9]", text):
        for m in NUMBERS.finditer(text):
            if HOLDS.get(m.lastgroup, bool)(m[0]):
                add(m.start(), m.end(), m.lastgroup)
    if any(title in text for title in TITLES):
        found += _names(text)
    kept: list[Entity] = []
    for e in sorted(found, key=lambda e: (e.start, -e.end)):
        if not kept or e.start >= kept[-1].end:
            kept.append(e)
    return kept


@lru_cache(maxsize=1 << 12)
def alphabet_of(c: str) -> str | None:
    """The alphabet of a character: one of ``ALPHABETS``, or the like characters of its block of 256; None for signs."""
    if c in PLACE:
        return PLACE[c][0]
    kind = unicodedata.category(c)
    if kind not in ("Ll", "Lu", "Lt", "Lo", "Lm", "Nd", "Nl", "No"):
        return None
    single = lambda x: len(x.lower()) == len(x.upper()) == 1 and x.lower().upper().lower() == x.lower()
    like = lambda x: unicodedata.category(x) == kind and x not in PLACE and (single(x), x.lower() == x, x.upper() == x) == own
    own = (single(c), c.lower() == c, c.upper() == c)
    block = ord(c) & ~0xFF
    return "".join(x for x in map(chr, range(block, block + 256)) if like(x))


def permute(symbols: list[int], radices: list[int], key: bytes, tweak: str) -> list[int]:
    """A keyed permutation of the vectors of symbols below their radices."""
    out, half = list(symbols), len(symbols) // 2
    for n in range(ROUNDS):
        fixed, moved = (range(half), range(half, len(out))) if n % 2 == 0 else (range(half, len(out)), range(half))
        seed = f"{tweak}|{n}|{','.join(str(out[i]) for i in fixed)}".encode()
        stream = hashlib.blake2b(seed, key=key, digest_size=64).digest()
        while len(stream) < 4 * len(out):
            stream += hashlib.blake2b(stream[-64:], key=key, digest_size=64).digest()
        for i in moved:
            out[i] = (out[i] + int.from_bytes(stream[4 * i : 4 * i + 4], "little")) % radices[i]
    return out


def _more(draw: int) -> int:
    """Number of characters that a draw adds."""
    return max(0, draw - OWN_FORM + 1)


def _by_alphabet(value: str, alphabets: list[str | None], key: bytes, tweak: str, more: int = 0) -> str:
    """Permute the characters that have an alphabet; the others stay.  ``more`` characters like the last one are added."""
    if more:
        last = next((a for a in reversed(alphabets) if a and len(a) > 1), ALPHABETS[1])
        value, alphabets = value + last[0] * more, alphabets + [last] * more
    places = [i for i, a in enumerate(alphabets) if a]
    radices = [len(alphabets[i]) for i in places]
    form = "".join(c if not a else a[0] for c, a in zip(value, alphabets))
    new = permute([alphabets[i].index(value[i]) for i in places], radices, key, f"{tweak}|{form}")
    out = list(value)
    for i, s in zip(places, new):
        out[i] = alphabets[i][s]
    return "".join(out)


def _usual(value: str) -> list[str | None]:
    return [alphabet_of(c) for c in value]


def check_digit(digits: list[int]) -> int:
    """The digit that makes a card number right (the Luhn formula)."""
    doubled = [d * 2 - 9 * (d > 4) if i % 2 == 0 else d for i, d in enumerate(reversed(digits))]
    return -sum(doubled) % 10


def _is_address(text: str) -> bool:
    return all(int(x) < 256 and x == str(int(x)) for x in text.split("."))


def _is_card(text: str) -> bool:
    """Whether the check digit is right, or the digits stand in groups; other long runs are numbers of any kind."""
    digits = [int(c) for c in text if c.isdigit()]
    return len(digits) < len(text) or check_digit(digits[:-1]) == digits[-1]


#: What a number of a kind has to be beside its form.
HOLDS = {"ip": _is_address, "card": _is_card}
# Names reserved for examples and tests (RFC 2606), which are nobody's.
RESERVED = ("example", "test", "invalid", "localhost")


def _email(value: str, key: bytes, tweak: str, draw: int) -> str:
    name, host = value.split("@")
    labels = host.split(".")
    new_host = [_by_alphabet(x, _usual(x), key, "host") for x in labels[:-2]] or []
    if len(labels) == 2 or labels[-2] not in RESERVED:
        new_host.append(_by_alphabet(labels[-2], _usual(labels[-2]), key, "domain"))
    else:
        new_host.append(labels[-2])
    return f"{_by_alphabet(name, _usual(name), key, tweak + '|' + host, _more(draw))}@{'.'.join([*new_host, labels[-1]])}"


def _phone(value: str, key: bytes, tweak: str, draw: int) -> str:
    country = COUNTRY.match(value).end()
    alphabets = [None if i < country else a for i, a in enumerate(_usual(value))]
    return _by_alphabet(value, alphabets, key, tweak, _more(draw))


def _ip(value: str, key: bytes, tweak: str, draw: int) -> str:
    octets = value.split(".")
    if _more(draw):
        return ".".join(map(str, permute([int(x) for x in octets], [256] * 4, key, tweak)))
    first = [(0, 10, 100)[len(x) - 1] for x in octets]
    radices = [(10, 90, 156)[len(x) - 1] for x in octets]
    new = permute([int(x) - f for x, f in zip(octets, first)], radices, key, f"{tweak}|{[len(x) for x in octets]}")
    return ".".join(str(f + s) for f, s in zip(first, new))


def _card(value: str, key: bytes, tweak: str, draw: int) -> str:
    digits = [int(c) for c in value]
    body = digits[:-1] + [0] * _more(draw)
    new = permute(body, [10] * len(body), key, f"{tweak}|{len(digits)}")
    new.append((check_digit(new) + digits[-1] - check_digit(digits[:-1])) % 10)
    return "".join(map(str, new))


def _secret(value: str, key: bytes, tweak: str, draw: int) -> str:
    return _by_alphabet(value, [HEX] * len(value) if set(value) <= set(HEX) else _usual(value), key, tweak, _more(draw))


def _plain(value: str, key: bytes, tweak: str, draw: int) -> str:
    return _by_alphabet(value, _usual(value), key, tweak, _more(draw))


def _name(kind: str, value: str, key: bytes, draw: int) -> str:
    _, script, gender = kind.split("-")
    consonants, vowels, endings = SYLLABLES[script]
    seed = hashlib.blake2b(f"name|{script}|{gender}|{value}|{draw}".encode(), key=key, digest_size=32).digest()
    syllables = 2 + seed[0] % 2 + draw // 8
    made = "".join(consonants[seed[2 * i + 2] % len(consonants)] + vowels[seed[2 * i + 3] % len(vowels)] for i in range(min(syllables, 10)))
    ending = endings[gender][seed[1] % 4]
    return made[:-1] + ending if gender == "f" or ending[0] in vowels else made + ending


MAKERS: dict[str, Callable[[str, bytes, str, int], str]] = {
    "email": _email, "phone": _phone, "ip": _ip, "card": _card, "ssn": _plain, "secret": _secret,
}


def surrogate(kind: str, value: str, key: bytes, draw: int = 0) -> str:
    """The surrogate of a folded value; ``draw`` numbers further ones."""
    if kind.startswith("name-"):
        return _name(kind, value, key, draw)
    return MAKERS[kind](value, key, f"{kind}|{draw}", draw)


def rewrite(text: str, key: bytes, draws: dict[tuple[str, str], int]) -> tuple[str, int]:
    """The text with surrogates in place of its entities, and their number."""
    found = find_entities(text)
    out, at = [], 0
    for e in found:
        new = surrogate(e.kind, e.value, key, draws.get((e.kind, e.value), 0))
        new = restored(e.kind, e.shown, e.value, new)
        out += [text[at : e.start], new]
        at = e.end
    return "".join([*out, text[at:]]), len(found)


def entities(docs: DataFrame) -> DataFrame:
    """``doc_id, kind, value``: the different entities of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds, values = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for kind, value in sorted({(e.kind, e.value) for e in find_entities(text or "")}):
                    ids.append(i)
                    kinds.append(kind)
                    values.append(value)
            rows = batch.column(0).take(pa.array(ids, pa.int64()))
            arrays = [rows, pa.array(kinds, pa.string()), pa.array(values, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "kind", "value"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, kind string, value string")


def _drawn(rows: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, draw, made``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [surrogate(k, v, key, d) for k, v, d in zip(*[c.to_pylist() for c in batch.columns])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], ["kind", "value", "draw", "made"])

    return rows.select("kind", "value", "draw").mapInArrow(run, "kind string, value string, draw int, made string")


def exceptions(found: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, draw`` of the values whose first surrogate collides; see the module's text."""
    kinds = F.when(F.col("kind").startswith("name-"), "name").otherwise(F.col("kind"))
    values = cut_lineage(found.select("kind", "value").distinct())
    taken = values.select(kinds.alias("class"), F.col("value").alias("taken")).distinct()
    now = _drawn(values.withColumn("draw", F.lit(0)), key)
    for draws in range(MOST_DRAWS + 1):
        now = cut_lineage(now.withColumn("class", kinds))
        first = now.groupBy("class", "made").agg(F.min(F.struct("draw", "value", "kind")).alias("first"), F.count("*").alias("n"))
        shared = first.where("n > 1").select("class", "made", "first")
        marked = now.join(shared, ["class", "made"], "left").join(
            taken, (now["class"] == taken["class"]) & (now["made"] == taken["taken"]), "left"
        )
        second = F.col("first").isNotNull() & (F.struct("draw", "value", "kind") != F.col("first"))
        marked = marked.select("kind", "value", "draw", "made", (F.col("taken").isNotNull() | second).alias("again"))
        marked = cut_lineage(marked)
        if marked.where("again").isEmpty():
            break
        if draws == MOST_DRAWS:
            raise ValueError(f"surrogates still collide after {MOST_DRAWS} draws")
        redrawn = _drawn(marked.where("again").withColumn("draw", F.col("draw") + 1), key)
        now = marked.where("NOT again").drop("again").union(redrawn)
    return marked.where("draw > 0").select("kind", "value", "draw")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """Every column of ``docs`` with surrogates in ``text``, and ``n_entities``, the number of places rewritten."""
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    found = stored(entities(docs))
    odd = cut_lineage(exceptions(found, secret))
    plain = docs.drop("n_entities")
    names = plain.columns
    known, of = unused("draws", plain), unused("of", plain)
    if odd.isEmpty():
        joined = plain.withColumn(known, F.lit(None).cast("array<struct<kind:string,value:string,draw:int>>"))
    else:
        per_doc = found.join(odd, ["kind", "value"]).groupBy("doc_id")
        draws = per_doc.agg(F.collect_set(F.struct("kind", "value", "draw")).alias(known)).withColumnRenamed("doc_id", of)
        joined = plain.join(draws, F.col("doc_id").eqNullSafe(F.col(of)), "left").select(*names, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, counts = [], []
            for text, draws in zip(batch.column(at).to_pylist(), batch.column(known).to_pylist()):
                own = {(d["kind"], d["value"]): d["draw"] for d in draws or ()}
                new, n = (None, 0) if text is None else rewrite(text, secret, own)
                texts.append(new)
                counts.append(n)
            arrays = [batch.column(n) if n != "text" else pa.array(texts, batch.schema.field(at).type) for n in names]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int32())], [*names, "n_entities"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return joined.mapInArrow(run, f"{fields}, n_entities int")
