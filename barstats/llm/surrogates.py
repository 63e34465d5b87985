"""Surrogates for personal data: keyed, of the same type, distinct and consistent.

Entities are found by pattern: e-mail addresses, IP addresses of both versions, phone numbers (a + or a
leading 0 and 8 to 15 digits in groups of any length, or an area code and two groups), card and social
security numbers, and names behind a form of address, which are then replaced wherever the same document
has them. An entity is its kind and a canonical form (an address in lower case, the digits
of a number, a name's word case-folded), and its surrogate is drawn from a keyed hash of
those, so one entity has one surrogate in the whole corpus, whichever way it is written.
Digits replace digits between the same separators, and a card's number whose last digit checks gets one of which
the same is true; letters replace letters of the same case and script; octets replace octets, of the same
private or local network if the address is of one. Names get names of the same gender (as the form of address tells it) and
script. The replacing text ends like the entity's own: ``.example`` takes the place of an address's last label.

Distinctness is checked over the corpus, for all names together and for all numbers by their digits:
a surrogate that is a real entity, or that two entities share, is drawn again for all but one, until
none is left; an entity for which MOST_DRAWS draws do not suffice is an error, as its format has too few free values. A given name behind a form of address for either gender is the entity of the one gender that
it has elsewhere. The texts with entities that needed another draw, or have such a gender, are found by a 128-bit hash and told
how to draw.
All others are rewritten from the key alone. Texts are read twice and only shuffled if Spark
cannot send that small table to the tasks.

A null text stays null, an empty one empty; any other is rewritten whole. Repeated rows get the
same text. In an empty table nothing is found. Columns of the input with the names of new
ones are replaced.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from ipaddress import IPv6Address

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstats.llm.common import append
from barstats.sources.scratch import staged

MALE = ("Mr", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "Don", "г-н", "κ.")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Srta", "Mme", "Mlle", "Madame", "Doña", "г-жа", "κα")
EITHER = ("Dr", "Prof")
GENDERS = {title: g for g, titles in (("m", MALE), ("f", FEMALE), ("n", EITHER)) for title in titles}

_TITLES = "|".join(sorted(map(regex.escape, GENDERS), key=len, reverse=True))
#: A word of a name: no form of address itself, but for one that is a given name too.
_NAME = rf"(?!(?!Don\b)(?:{_TITLES})\b)\p{{Lu}}(?:[\p{{L}}’-]|'(?=\p{{Lu}}))*"
#: Words between names that are kept as they are.
PARTICLES = ("van", "von", "der", "den", "de", "del", "della", "di", "da", "du", "la", "le", "ten", "zu", "bin", "al")
_PART = rf"(?:(?:{'|'.join(PARTICLES)}) ){{0,3}}{_NAME}"
PERSON = regex.compile(rf"(?<![\w-])({_TITLES})\.? ({_PART}(?: {_PART}){{0,2}})")
#: An address is looked for once in each run of characters that it may have before its @, so
#: long runs without one cost no more than their length.
NUMBERED = regex.compile(
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[._%+-]*+"
    r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*+(?<!\.)@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]+)"
    r"|(?<![\w.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\w]|\.\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?<![\w.:])(?P<ip6>(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){6}(?:\d{1,3}\.){3}\d{1,3}"
    r"|(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::"
    r"(?:(?:[0-9A-Fa-f]{1,4}:){0,6}(?:(?:\d{1,3}\.){3}\d{1,3}|[0-9A-Fa-f]{1,4}))?)(?![\w:]|\.\d)"
    r"|(?<![\w.-])(?P<card>\d(?:[ -]?\d){12,18})(?![\w]|-\d)"
    r"|(?<![\w.])(?P<phone>\+1[ .-]?(?:\(\d{3}\) ?|\d{3}[ .-]?)\d{3}[ .-]?\d{4}(?!\w)"
    r"|(?:\+ ?\(?\d|(?<![/-])(?!\d\d?[./-]\d\d?[./-]\d{4}(?!\d))(?:\(0|0(?=\d)))(?:[ ./()–-]{0,3}\d){7,14}(?!\w)"
    r"|(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}|\+\d{7,15})(?![\w])"
)
_DIGIT = regex.compile("[0-9]")
_RUN = regex.compile(r"[\p{L}\w]+")
_TITLE_SEEN = regex.compile(rf"(?<![\w-])(?:{_TITLES})\b")
#: Draws after which an entity fails, and after which an address may be of any network.
MOST_DRAWS, ANY_NETWORK = 60, 24
KINDS = ("email", "ip", "ssn", "card", "phone", "name")

#: Syllables of made-up names: plain sounds of each script.
SOUNDS = {
    "latin": ("b d f g k l m n p r s t v".split(), "a e i o u".split()),
    "cyrillic": ("б в г д ж з к л м н п р с т".split(), "а е и о у".split()),
    "greek": ("β γ δ θ κ λ μ ν π ρ σ τ".split(), "α ε η ι ο".split()),
}
ENDINGS = {  # of given names by gender; family names have the neutral one
    "latin": {"m": "n", "f": "a", "n": "el"},
    "cyrillic": {"m": "н", "f": "а", "n": "ей"},
    "greek": {"m": "ος", "f": "α", "n": "ης"},
}


class Draws:
    """Numbers below given bounds, from a keyed hash."""

    def __init__(self, key: bytes, *parts: object):
        self.seed = hashlib.blake2b("\0".join(map(str, parts)).encode(), key=key, digest_size=32).digest()
        self.left, self.block = 0, 0

    def below(self, n: int) -> int:
        if self.left < 1 << 64:
            word = hashlib.blake2b(self.seed + self.block.to_bytes(4, "big"), digest_size=64).digest()
            self.left, self.block = int.from_bytes(word, "big"), self.block + 1
        self.left, value = divmod(self.left, n)
        return value


def script_of(word: str) -> str:
    if "Ͱ" <= word[0] <= "Ͽ":
        return "greek"
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def _places(text: str, names: Iterable[str]) -> Iterator[tuple[int, int]]:
    """Where the names stand as words of their own, whatever the case behind a capital letter;
    the longest at each place, in one pass."""
    of_run: dict[str, dict[str, int]] = {}
    for name in sorted(names, key=len, reverse=True):
        of_run.setdefault(_RUN.match(name)[0].casefold(), {}).setdefault(name.casefold(), len(name))
    after = 0
    for m in _RUN.finditer(text):
        if m.start() >= after and not m[0][0].islower():
            for name, length in of_run.get(m[0].casefold(), {}).items():
                end = m.start() + length
                if text[m.start() : end].casefold() == name and not _RUN.match(text, end):
                    yield m.start(), end
                    after = end
                    break


def _groups(written: str) -> str:
    """The eight groups of an IPv6 address; nothing for the empty address, or for what is none.

    Words of a to f alone around two colons are more often names of a program.
    """
    if not _DIGIT.search(written) and len(written.replace("::", ":").strip(":").split(":")) < 4:
        return ""
    try:
        value = int(IPv6Address(written))
    except ValueError:
        return ""
    return ":".join(f"{value >> shift & 0xFFFF:x}" for shift in range(112, -16, -16)) if value else ""


def mentions(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of every entity, in order, not overlapping.

    The kind of a name's word holds its part, gender and script.
    """
    if not text:
        return []
    found, people, written = [], {}, set()
    if "@" in text or ":" in text or _DIGIT.search(text):
        for m in NUMBERED.finditer(text):
            kind, value = m.lastgroup, m[m.lastgroup]
            if kind == "ip6":
                if not (value := _groups(value)):
                    continue
                found.append((*m.span(kind), "ip", value))
                continue
            if kind in ("email", "ip"):
                value = value.lower()
            else:
                value = regex.sub(r"\D", "", value)
            found.append((*m.span(kind), kind, value))
    if _TITLE_SEEN.search(text):
        for m in PERSON.finditer(text):
            words = [w for w in m[2].split(" ") if w not in PARTICLES]
            written.update(words)
            for i, w in enumerate(words):
                part = "family" if i == len(words) - 1 else f"given-{GENDERS[m[1]]}"
                people.setdefault(w.casefold(), f"name-{part}-{script_of(w)}")
    if people:
        starts, ends = [a for a, *_ in found], [b for _, b, *_ in found]
        for start, end in _places(text, written):
            k = bisect_left(starts, end) - 1  # the last that begins before the name ends
            if k < 0 or ends[k] <= start:
                canon = text[start:end].casefold()
                found.append((start, end, people[canon], canon))
    return sorted(found)


def _same_shape(text: str, draws: Draws) -> str:
    """Letters for letters and digits for digits; a first digit that is not 0 stays so."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(1 + draws.below(9) if not out and c != "0" else draws.below(10)))
        elif "a" <= c <= "z":
            out.append(chr(97 + draws.below(26)))
        else:
            out.append(c)
    return "".join(out)


def check_digit(digits: str) -> str:
    """The digit behind these that makes them a card's number."""
    doubled = [int(c) * (2 - i % 2) for i, c in enumerate(reversed(digits))]
    return str(-sum(d // 10 + d % 10 for d in doubled) % 10)


def network(octets: list[str]) -> tuple[tuple[int, int], ...]:
    """Ranges of the octets that make an address private, local or of its own host; else none."""
    a, b = int(octets[0]), int(octets[1])
    if a in (10, 127):
        return ((a, a + 1),)
    if a == 172 and 16 <= b < 32:
        return (a, a + 1), (16, 32)
    return ((a, a + 1), (b, b + 1)) if (a, b) in ((192, 168), (169, 254)) else ()


def surrogate(kind: str, canon: str, attempt: int, key: bytes) -> str:
    """The canonical form of an entity's surrogate at an attempt.

    Later attempts may be longer where a format leaves few choices.
    """
    draws = Draws(key, kind, canon, attempt)
    more = attempt // 8
    if kind == "email":
        local, _, domain = canon.partition("@")
        labels = domain.split(".")[:-1]
        shaped = [_same_shape(p, draws) for p in (local, *labels)]
        shaped[0] += "".join(chr(97 + draws.below(26)) for _ in range(more))
        return f"{shaped[0]}@{'.'.join(shaped[1:])}.example"
    if kind == "ip" and ":" in canon:
        if more > 3:  # all groups, of all lengths
            return ":".join(f"{draws.below(1 << 16):x}" for _ in range(8))
        lengths = [0 if g == "0" else min(4, len(g) + more) for g in canon.split(":")]
        return ":".join(f"{16 ** (n - 1) + draws.below(15 * 16 ** (n - 1)):x}" if n else "0" for n in lengths)
    if kind == "ip":
        octets = canon.split(".")
        ranges = {1: (1, 10), 2: (10, 100), 3: (100, 256)}
        bounds = [ranges[min(3, len(o) + more)] for o in octets]
        own = network(octets) if attempt < ANY_NETWORK else ()
        bounds[: len(own)] = own
        while True:
            new = [str(lo + draws.below(hi - lo)) for lo, hi in bounds]
            if own or not network(new):  # a public address stays one
                return ".".join(new)
    if not kind.startswith("name-"):
        national = len(canon) - len(canon.lstrip("0")[:20]) if kind == "phone" else 0
        new = canon[:national] + _same_shape(canon[national:], draws)
        return new[:-1] + check_digit(new[:-1]) if kind == "card" and check_digit(canon[:-1]) == canon[-1] else new
    _, part, *rest = kind.split("-")
    gender, script = (rest[0], rest[1]) if part == "given" else ("n", rest[0])
    first, vowels = SOUNDS[script]
    syllables = max(2, min(4, len(canon) // 3)) + more
    body = "".join(first[draws.below(len(first))] + vowels[draws.below(len(vowels))] for _ in range(syllables))
    ending = ENDINGS[script][gender]
    return body + ending if gender != "f" else body[:-1] + ending


def formatted(written: str, kind: str, new: str) -> str:
    """The surrogate in the format of the mention: separators, case."""
    if kind in ("ssn", "card", "phone"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in written)
    if kind == "ip" and ":" in new:
        new = IPv6Address(new).compressed if "::" in written else new
        return new.upper() if written != written.lower() else new
    if kind == "email" and written != written.lower():
        local, _, domain = written.partition("@")
        return "".join(n.upper() if i < len(local) and local[i].isupper() else n for i, n in enumerate(new))
    if kind.startswith("name-"):
        return new.upper() if len(written) > 1 and written.isupper() else new[:1].upper() + new[1:]
    return new


def rewrite(text: str | None, key: bytes, attempts: dict[tuple[str, str], tuple[str, int]]) -> tuple[str | None, list[dict]]:
    """The text with surrogates, and what was replaced where (spans of the given text)."""
    found = mentions(text)
    parts, at, spans = [], 0, []
    for start, end, kind, canon in found:
        drawn, attempt = attempts.get((kind, canon), (kind, 0))
        new = surrogate(drawn, canon, attempt, key)
        new = formatted(text[start:end], kind, new)
        parts += [text[at:start], new]
        at = end
        spans.append({"kind": kind.split("-")[0], "start": start, "end": end, "surrogate": new})
    return ("".join([*parts, text[at:]]) if found else text), spans


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct kind and canon over all texts, with the hash of a text for each (_t1, _t2)."""

    def work(texts):
        return [[[{"kind": k, "canon": c} for k, c in dict.fromkeys(m[2:] for m in mentions(t))] for t in texts]]

    rows = docs.select(F.col(text_col).alias("_text"))
    rows = append(rows, ["_text"], "_found array<struct<kind:string,canon:string>>", work)
    return rows.where(F.size("_found") > 0).select(*_key("_text"), F.inline("_found"))


def _key(text_col: str):
    return F.xxhash64(text_col).alias("_t1"), F.xxhash64(F.lit("t"), text_col).alias("_t2")


def of_gender(found: DataFrame) -> DataFrame:
    """kind, canon, drawn: given names of no known gender that are elsewhere met with one
    gender only, and the kind that they are then drawn as."""
    names = found.where("kind LIKE 'name-given-%'").select("kind", "canon").distinct()
    known = names.where("kind NOT LIKE 'name-given-n-%'").groupBy("canon")
    known = known.agg(F.min("kind").alias("drawn"), F.count("*").alias("n")).where("n = 1")
    return names.where("kind LIKE 'name-given-n-%'").join(known.drop("n"), "canon").select("kind", "canon", "drawn")


#: Kinds that are told apart by nothing that is written: all names, all numbers.
_SPACE = "CASE WHEN kind LIKE 'name-%' THEN 'name' WHEN kind IN ('ssn', 'card', 'phone') THEN 'digits' ELSE kind END"


def assign(found: DataFrame, key: bytes) -> DataFrame:
    """kind, canon, attempt, new for distinct entities, so that no two share a surrogate and
    none is a real entity, of whatever kind that can be written the same.

    A surrogate belongs to the entity that has it at the earliest attempt (of several, the
    least); the others draw again. Every round is written to the shared folder.
    """

    def draw(rows: DataFrame) -> DataFrame:
        work = lambda kinds, canons, tries: [list(map(surrogate, kinds, canons, tries, [key] * len(kinds)))]
        return append(rows, ["kind", "canon", "attempt"], "new string", work)

    space = F.expr(_SPACE).alias("space")
    real = staged(found.select("kind", "canon").distinct(), "entities")
    drawn = staged(draw(real.withColumn("attempt", F.lit(0))), "drawn")
    while True:
        first = F.min(F.struct("attempt", "canon", "kind")).alias("owner")
        owner = drawn.groupBy(space, "new").agg(first, F.count("*").alias("n"))
        shared = owner.where("n > 1").select("space", "new", "owner")
        again = drawn.withColumn("space", space).join(shared, ["space", "new"])
        again = again.where("owner.canon <> canon OR owner.kind <> kind").select("kind", "canon")
        known = real.select(space, F.col("canon").alias("new"))
        taken = drawn.withColumn("space", space).join(known, ["space", "new"], "left_semi")
        again = staged(again.union(taken.select("kind", "canon")).distinct(), "again")
        if again.isEmpty():
            return drawn
        tries, kind = drawn.join(again, ["kind", "canon"]).agg(F.max(F.struct("attempt", "kind")).alias("m")).select("m.*").first()
        if tries >= MOST_DRAWS:
            raise ValueError(f"too few surrogates are free for entities of kind {kind}")
        marked = drawn.join(again.withColumn("lost", F.lit(1)), ["kind", "canon"], "left")
        marked = marked.select("kind", "canon", (F.col("attempt") + F.coalesce("lost", F.lit(0))).alias("attempt"))
        drawn = staged(draw(marked), "drawn")


def replace_entities(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The documents with surrogates in their text, and ``replaced``: kind, start, end
    (in the given text) and surrogate of everything replaced."""
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    # The caller's columns go by number, so that none can have the name of a helper.
    held = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)))
    text = f"c{docs.columns.index(text_col)}"
    found = staged(entities(held, text), "mentions")
    merged = staged(of_gender(found), "merged")
    names = found.select("kind", "canon").distinct().join(merged, ["kind", "canon"], "left")
    names = staged(names.select("kind", "canon", F.coalesce("drawn", "kind").alias("drawn")), "names")
    drawn = assign(names.select(F.col("drawn").alias("kind"), "canon"), secret).where("attempt > 0")
    drawn = drawn.select(F.col("kind").alias("drawn"), "canon", "attempt")
    again = names.join(drawn, ["drawn", "canon"], "left").where("attempt > 0 OR drawn <> kind")
    again = again.select("kind", "canon", "drawn", F.coalesce("attempt", F.lit(0)).alias("attempt"))
    again = staged(again, "attempts")
    rows = held
    if again.isEmpty():
        rows = rows.withColumn("_attempts", F.lit(None).cast("array<struct<kind:string,canon:string,drawn:string,attempt:int>>"))
    else:
        of_text = found.join(again, ["kind", "canon"]).groupBy("_t1", "_t2")
        of_text = staged(of_text.agg(F.collect_set(F.struct("kind", "canon", "drawn", "attempt")).alias("_attempts")), "texts")
        one, two = _key(text)
        rows = rows.withColumns({"_t1": one, "_t2": two}).join(of_text, ["_t1", "_t2"], "left")

    def work(texts, attempts) -> Iterator[list]:
        known = [{(a["kind"], a["canon"]): (a["drawn"], a["attempt"]) for a in some or ()} for some in attempts]
        return list(zip(*(rewrite(t, secret, k) for t, k in zip(texts, known)))) or [[], []]

    new = "_new string, replaced array<struct<kind:string,start:int,end:int,surrogate:string>>"
    out = append(rows, [text, "_attempts"], new, work)
    own = [
        F.col("_new" if c == text_col else f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() != "replaced"
    ]
    return out.select(*own, "replaced")
