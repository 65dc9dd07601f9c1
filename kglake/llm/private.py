"""Personal data and secrets replaced by surrogates, with built-in functions alone.

Every entity found in a text becomes a surrogate of its own type, format, script and, for names after a title,
gender. Name parts of titled persons are replaced throughout their text. Surrogates are keyed and made by rounds that shift each character within its alphabet by a digest of the
other half of the entity. Such rounds can be undone, so different entities of a format never share a
surrogate, and one entity gets the same surrogate in every document without a table of entities. `collisions`
checks that over all documents: it is empty unless two entities share a surrogate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Alphabets within which characters stay, so digits remain digits, capitals capitals, and scripts themselves.
DIGITS = "0123456789"
HEX = "0123456789abcdef"
GENERAL = (DIGITS, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
           "àáâãäåæçèéêëìíîïñòóôõöøùúûüýœß", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŒ",
           "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
           "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ")
# Vowels and consonants apart: names stay pronounceable.
NAMES = ("aeiou", "AEIOU", "bcdfghjklmnpqrstvwxyz", "BCDFGHJKLMNPQRSTVWXYZ", *GENERAL[3:7],
         "аеиоуыэюя", "АЕИОУЫЭЮЯ", "бвгджзйклмнпрстфхцчшщ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ")

FEMALE = "Mrs|Ms|Miss|Frau|Sra|Señora|Mme|Madame|Signora|Госпожа"
MALE = "Mr|Herr|Sr|Señor|Monsieur|Signor|Господин"
TITLES = rf"(?:(?:{FEMALE}|{MALE}|Dr|Prof)\.? )++"
# A name part, with hyphens and apostrophes but for a possessive one, or an initial before another part.
LETTERS = r"[\p{L}\p{M}]"
JOINED = rf"(?:[-'’](?!(?<!-)s(?!{LETTERS})){LETTERS}++)"
NAME = rf"(?:\p{{Lu}}(?:{LETTERS}++{JOINED}*+|{JOINED}++)|\p{{Lu}}\.(?= \p{{Lu}}))"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# In this order at each place of a text. Repeats of letters are possessive: none is tried twice from one place.
PATTERNS = {
    "secret": r"\b(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}\"?"
              r"(?=[A-Za-z_+/.=-]*+\d)[A-Za-z0-9_+/.=-]{8,}+\"?",
    "access_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)*?\.\p{L}{2,24}(?![\p{L}\p{N}-])",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
             r"|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
    "number": r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{3}-\d{2}-\d{4})(?![\w-])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z]{0,4}\d{2,4}){3,8}\b",
    "hex": r"\b(?=[a-f]*+[0-9])[0-9a-f]{32,}+\b",
    "person": rf"\b{TITLES}{NAME}(?: {NAME})*+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Without any of these no pattern can match.
MAY_MATCH = rf"[0-9@]|\b(?:{FEMALE}|{MALE}|Dr|Prof)\b"


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _shifted(text: Column, digest: Column, alphabets: tuple[str, ...]) -> Column:
    """Each character of `text` moved within its alphabet by two digits of `digest`; others stay."""
    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(digest, (i * 2) % 62 + 1, F.lit(2)), 16, 10).cast("int")
        moved = c
        for letters in reversed(alphabets):
            at = F.instr(F.lit(letters), c)
            moved = F.when(at > 0, F.substring(F.lit(letters), (at - 1 + by) % len(letters) + 1, F.lit(1))).otherwise(moved)
        return moved

    return F.array_join(F.transform(_characters(text), move), "")


def _digest(key: str, kind: str | Column, turn: int, *parts: Column) -> Column:
    kind = kind if isinstance(kind, Column) else F.lit(kind)
    return F.sha2(F.concat_ws("\u0001", F.lit(key), kind, F.lit(str(turn)), *parts), 256)


def _rounds(text: Column, key: str, kind: str | Column, alphabets: tuple[str, ...] = GENERAL) -> Column:
    """The keyed rounds: halves shifted in turn by digests of each other, alike for either case of letters."""
    half = F.floor(F.length(text) / 2).cast("int")
    left, right = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))
    # Each step is bound to a variable once, or the expression would double with each round.
    def bound(value: Column, then: Callable[[Column], Column]) -> Column:
        return F.element_at(F.transform(F.array(value), then), 1)

    return bound(right, lambda r: bound(
        _shifted(left, _digest(key, kind, 1, F.lower(r)), alphabets), lambda a: bound(
            _shifted(r, _digest(key, kind, 2, F.lower(a)), alphabets), lambda b: F.concat(
                _shifted(a, _digest(key, kind, 3, F.lower(b)), alphabets), b))))


def _address(ip: Column, key: str) -> Column:
    """Two halves of an IPv4 address as numbers, moved in turn by digests of each other."""
    octets = F.split(ip, r"\.")
    high = F.element_at(octets, 1).cast("int") * 256 + F.element_at(octets, 2).cast("int")
    low = F.element_at(octets, 3).cast("int") * 256 + F.element_at(octets, 4).cast("int")

    def moved(value: Column, other: Column, turn: int) -> Column:
        by = F.conv(F.substring(_digest(key, "ip", turn, other.cast("string")), 1, 4), 16, 10).cast("int")
        return (value + by) % 65536

    def written(h: Column, l: Column) -> Column:
        parts = [F.floor(h / 256), h % 256, F.floor(l / 256), l % 256]
        return F.concat_ws(".", *[p.cast("int").cast("string") for p in parts])

    def bound(value: Column, then: Callable[[Column], Column]) -> Column:
        return F.element_at(F.transform(F.array(value), then), 1)

    return bound(low, lambda l: bound(moved(high, l, 1), lambda h: bound(
        moved(l, h, 2), lambda l2: written(moved(h, l2, 3), l2))))


def _check_digit(digits: Column) -> Column:
    """What a card number's last digit is, given those before it."""
    doubled = F.transform(F.reverse(_characters(digits)), lambda c, i: F.when(
        i % 2 == 0, F.floor(c.cast("int") * 2 / 10) + (c.cast("int") * 2) % 10).otherwise(c.cast("int")).cast("int"))
    return (10 - F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10) % 10


def _card(number: Column, key: str) -> Column:
    """The first digit stays; the check digit is as right, or as wrong by the same number, as it was."""
    body, last = F.substring(number, F.lit(1), F.length(number) - 1), F.substring(number, -1, 1).cast("int")
    new = F.concat(F.substring(body, 1, 1), _rounds(F.substring(body, F.lit(2), F.length(body)), key, "number"))
    wrong = last - _check_digit(body) + 10
    return F.element_at(F.transform(F.array(new), lambda b: F.concat(
        b, ((_check_digit(b) + wrong) % 10).cast("int").cast("string"))), 1)


def _title_of(person: Column) -> Column:
    return F.regexp_extract(person, f"^({TITLES})", 1)


def _parts_of(person: Column) -> Column:
    return F.split(F.regexp_replace(person, f"^{TITLES}", ""), " ")


def people_of(entities: Column) -> Column:
    """What the titled persons among a text's `entities` tell: `given, surname` names, and `female, male` given ones.

    The last part after a title is the surname, also a lone part, unless another person here has it as given name.
    """
    def all_of(persons: Column, parts: Callable[[Column], Column]) -> Column:
        return F.array_distinct(F.flatten(F.transform(persons, parts)))

    def given(person: Column) -> Column:
        return F.slice(_parts_of(person), 1, F.size(_parts_of(person)) - 1)

    persons = F.filter(entities, lambda e: e.rlike(f"^(?:{PATTERNS['person']})$"))
    lone = F.filter(persons, lambda e: F.size(_parts_of(e)) == 1)
    full = F.filter(persons, lambda e: F.size(_parts_of(e)) > 1)
    givens = all_of(full, given)
    return F.struct(
        givens.alias("given"),
        F.array_distinct(F.concat(all_of(full, lambda e: F.slice(_parts_of(e), -1, 1)),
                                  F.array_except(all_of(lone, _parts_of), givens))).alias("surname"),
        all_of(F.filter(full, lambda e: _title_of(e).rlike(rf"\b(?:{FEMALE})\b")), given).alias("female"),
        all_of(F.filter(full, lambda e: _title_of(e).rlike(rf"\b(?:{MALE})\b")), given).alias("male"))


def _name(part: Column, is_surname: Column, title: Column, people: Column, key: str) -> Column:
    """The surrogate of one name part; the ending of a given name agrees with what is known of its gender.

    That is its title, or else another title of that name in the text, or else the name's own last letter.
    """
    moved = _rounds(part, key, F.when(is_surname, "surname").otherwise("given"), NAMES)
    female = F.when(title.rlike(rf"\b(?:{FEMALE})\b"), True).when(title.rlike(rf"\b(?:{MALE})\b"), False).when(
        F.array_contains(people["female"], part), True).when(F.array_contains(people["male"], part), False).otherwise(
        part.rlike("[aeiyаяеи]$"))
    cyrillic = part.rlike(r"\p{IsCyrillic}")
    ending = F.when(female, F.when(cyrillic, "а").otherwise("a")).otherwise(F.when(cyrillic, "о").otherwise("o"))
    return F.when(is_surname | part.endswith("."), moved).otherwise(F.concat(moved, ending))


def _person(entity: Column, people: Column, key: str) -> Column:
    """Title as it is, parts replaced: the last, or a lone one that is no given name of the text, as surname."""
    parts = _parts_of(entity)
    last = F.size(parts) - 1
    lone_given = (last == 0) & F.array_contains(people["given"], parts[0]) & ~F.array_contains(people["surname"], parts[0])
    return F.concat(_title_of(entity), F.array_join(F.transform(
        parts, lambda p, i: _name(p, (i == last) & ~lone_given, _title_of(entity), people, key)), " "))


def surrogate(entity: Column, key: str, people: Column | None = None) -> Column:
    """The surrogate of an entity that `ANY` matched, in a text of these `people` (see `people_of`)."""
    people = people_of(F.array(entity)) if people is None else people

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(entity, pattern, group)

    secret = r"(?s)^([^=:]*[=:]\s*\"?)(.*?)(\"?)$"
    value = part(secret, 2)
    shadow = F.when(value.rlike("^[0-9a-f]+$"), _rounds(value, key, "hex", (HEX,))).otherwise(
        _rounds(value, key, "secret"))
    mail = r"^(.*)@([^@]*)$"
    prefix = r"(?s)^(\+\d{1,3}|)(.*)$"
    return (
        F.when(entity.rlike(f"^(?:{PATTERNS['secret']})$"), F.concat(part(secret, 1), shadow, part(secret, 3)))
        .when(entity.rlike(f"^(?:{PATTERNS['access_key']})$"), F.concat(
            F.substring(entity, 1, 4), _rounds(F.substring(entity, 5, 16), key, "access_key")))
        # Local part and domain by themselves: addresses of one domain keep one domain, in a reserved zone.
        .when(entity.contains("@"), F.concat(
            _rounds(part(mail, 1), key, "email"), F.lit("@"), _rounds(part(mail, 2), key, "domain"), F.lit(".example")))
        .when(entity.rlike(f"^(?:{PATTERNS['ip']})$"), _address(entity, key))
        .when(entity.rlike(r"^\d{13,19}$"), _card(entity, key))
        .when(entity.rlike(f"^(?:{PATTERNS['hex']})$"), _rounds(entity, key, "hex", (HEX,)))
        .when(entity.rlike(f"^(?:{PATTERNS['person']})$"), _person(entity, people, key))
        .otherwise(F.concat(part(prefix, 1), _rounds(part(prefix, 2), key, "number")))
    )


def entities_of(text: Column) -> Column:
    """The entities of a text, in order, repeats included; none for null."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(text.rlike(MAY_MATCH), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))), none)


def replace_private(docs: DataFrame, key: str = "kglake-surrogates", count: str | None = "n_entities") -> DataFrame:
    """`docs` with every entity of the whole text replaced, and the number of them as `count`.

    Name parts of persons found by their titles are replaced in the rest of that text too, and counted.

    Texts without entities, null and empty ones stay as they are; repeated rows are treated alike. Other
    columns stay, but a column named like `count` is replaced and `n_chars`, where present, follows the new text.
    Production runs pass a secret `key`. No shuffle: rows are independent.
    """
    found = docs.withColumn("__entities", entities_of(F.col("text"))).withColumn("__people", people_of(F.col("__entities")))
    people = F.col("__people")
    # Of names that begin alike the longer one first. Names are letters, hyphens and apostrophes: no pattern signs.
    names = F.reverse(F.array_sort(F.filter(F.array_union(people["given"], people["surname"]), lambda n: ~n.endswith("."))))
    found = found.withColumn("__names", names).withColumn("__mention", F.concat(
        F.lit(r"(?<![\p{L}\p{M}\p{N}_])(?:"), F.array_join("__names", "|"), F.lit(r")(?![\p{L}\p{M}\p{N}_])")))
    found = found.withColumn("__pieces", F.when(F.size("__entities") > 0, F.split("text", ANY, -1)))

    def joined(pieces: Column, surrogates: Column) -> Column:
        return F.array_join(F.zip_with(pieces, surrogates, lambda piece, s: F.concat(piece, F.coalesce(s, F.lit("")))), "")

    def untitled(piece: Column) -> Column:
        """A piece between entities with the name parts of the text's people replaced where no title precedes them."""
        return joined(F.split(piece, F.col("__mention"), -1), F.transform(
            F.regexp_extract_all(piece, F.col("__mention"), F.lit(0)),
            lambda n: _name(n, F.array_contains(people["surname"], n), F.lit(""), people, key)))

    named = F.size("__names") > 0
    pieces = F.when(named, F.transform("__pieces", untitled)).otherwise(F.col("__pieces"))
    replaced = joined(pieces, F.transform("__entities", lambda e: surrogate(e, key, people)))
    out = found.withColumn("text", F.when(F.size("__entities") > 0, replaced).otherwise(F.col("text")))
    if count:
        mentions = F.when(named, F.aggregate("__pieces", F.lit(0), lambda n, p: n + F.regexp_count(p, F.col("__mention"))))
        out = out.withColumn(count, (F.size("__entities") + F.coalesce(mentions, F.lit(0))).cast("long"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("__entities") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop("__entities", "__people", "__names", "__mention", "__pieces")


def collisions(docs: DataFrame, key: str = "kglake-surrogates") -> DataFrame:
    """`surrogate, entities` wherever two entities, apart from the case of letters, share a surrogate."""
    found = docs.select(entities_of(F.col("text")).alias("entities")).withColumn("people", people_of(F.col("entities")))
    each = found.select(F.explode("entities").alias("entity"), "people")
    return (each.select(F.lower("entity").alias("entity"), F.lower(surrogate(
            F.col("entity"), key, F.col("people"))).alias("surrogate")).distinct().groupBy("surrogate").agg(F.count(F.lit(1)).alias("entities")).where("entities > 1"))
