"""Personal data replaced by surrogates that keep type, format, gender and script.

Every detected value gets a surrogate that depends on the key, its type and itself alone, so one
value has the same surrogate in all documents. Digits become digits and letters become letters of their
case and script; what makes up the format stays. First names come from a list of their gender.
Surrogates of different values are kept apart, and from all real values, by a check over the whole
corpus. DataFrame functions only.

Not detected: names without a title whose given name is not listed, national phone numbers without
separators or a leading 0, postal addresses, and secrets that follow none of the keywords.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.shared import materialize, measure_size

# Given names that decide a name's gender and stand in for one another, by script.
NAMES = {
    "f_latin": "Anna Maria Laura Julia Sofia Emma Clara Elena Paula Sarah Alice Louise Marie Lucia Carmen Ingrid Helga Petra Claire Camille",
    "m_latin": "James John Robert Michael David Daniel Thomas Peter Paul Martin Carlos Jorge Miguel Luis Pierre Louis Hans Klaus Stefan Henri",
    "f_cyrillic": "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана",
    "m_cyrillic": "Иван Сергей Андрей Дмитрий Алексей Николай Михаил Павел",
}
# Forms of address, which show the gender of the name that follows.
TITLES = {
    "f_latin": "Mrs Ms Miss Frau Madame Mme Señora Sra",
    "m_latin": "Mr Herr Monsieur Señor Sr",
    "f_cyrillic": "Госпожа",
    "m_cyrillic": "Господин",
    "any": "Dr Prof",
}
# Endings of family names that agree with the gender; they stay.
_ENDING = r"(?:ова|ева|ина|ская|ая|ов|ев|ин|ский|ий)$"
# Detected values; where two match at one place the earlier type wins. ``fixed`` is the part of a match
# that stays as it is; what follows it is replaced.
_WORD = r"\p{Lu}[\p{L}\p{M}'-]+"
_GIVEN = "|".join(n for names in NAMES.values() for n in names.split())
_TITLE = "|".join(t for titles in TITLES.values() for t in titles.split())
_H = "[0-9A-Fa-f]{1,4}"
# Eight groups, or fewer around a double colon and a digit among them.
_IPV6 = (
    rf"(?<![\p{{L}}\d:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_H}:){{7}}{_H}|(?:{_H}:){{1,6}}(?::{_H}){{1,6}}|(?:{_H}:){{1,7}}:|:(?::{_H}){{1,7}})"
    r"(?![\p{L}\d:])"
)
# An area code and two groups; in international form, grouped or not; and national with a leading 0, in pairs or two groups.
_PHONE = (
    r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)"
    r"|(?<![\p{L}\d+])\+[1-9]\d{7,14}(?!\d)"
    r"|(?<![\p{L}\d+])\+(?=(?:[ .()-]{0,2}\d){8,15}(?!\d))[1-9]\d{0,2}[ .-]?\(?\d{1,4}\)?(?:[ .-]\d{2,8}){1,5}(?!\d)"
    r"|(?<![\d+.,/-])0\d(?:[ .-]\d{2}){4}(?!\d)|(?<![\d+.,/-])0\d{2,4}[ /-]\d{5,8}(?!\d)"
)
TYPES = {
    "email": (r"[\p{L}\p{N}][\p{L}\p{N}._%+-]*@[\p{L}\p{N}][\p{L}\p{N}-]*(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}", ""),
    "secret": (r"(?i:password|passwd|pwd|token|secret|api_?key)[\"']?\s*[:=]\s*[\"']?[^\s\"',;]{6,}", r"(?i)^\w+[\"']?\s*[:=]\s*[\"']?"),
    "access_key": (r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b", r"^(?:AKIA|ASIA)"),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?\b", r"^[A-Z]{2}"),
    "ip": (r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)", ""),
    "ipv6": (_IPV6, ""),
    "card": (r"(?<!\d)(?:\d[ -]?){12,18}\d(?!\d)", ""),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", ""),
    "phone": (_PHONE, r"^(?:\+(?:\d{1,3}(?!\d)|[17]|[2-9]\d)|0)"),
    "name": (rf"\b(?:{_TITLE})\.? {_WORD}(?: {_WORD})?|\b(?:{_GIVEN}) {_WORD}", rf"^(?:{_TITLE})\.? "),
}
# What every match contains, as a quick first test.
_HINT = rf"[0-9@:=]|\p{{L}} \p{{Lu}}|\b(?:{_TITLE})\. "
_ANY = "|".join(f"(?:{pattern})" for pattern, _ in TYPES.values())
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CYRILLIC_LOWER = "абвгдежзиклмнопрстуфхцчшэюя"
_HEX = "0123456789abcdef"
# Attempts that keep a value's length and ending. From then on each adds a character, so that the possible surrogates
# outnumber any values.
FORM_ATTEMPTS = 4


def entity_type(value: Column) -> Column:
    """The first type whose pattern matches the whole value.

    A match that depends on what follows it in the text may match no pattern alone: it is a phone number if it
    has no letters, and of type ``other`` if it has."""
    rest = F.when(value.rlike(r"\p{L}"), F.lit("other")).otherwise(F.lit("phone"))
    return reduce(lambda rest, t: F.when(value.rlike(f"^(?:{TYPES[t][0]})$"), F.lit(t)).otherwise(rest), reversed(TYPES), rest)


def _draw(stream: Column, place: Column, n: int) -> Column:
    """A number below n from the place-th two bytes of a hexadecimal stream that is repeated as needed."""
    at = (place * 4) % (F.length(stream) - 4) + 1
    return F.conv(F.substring(stream, at, 4), 16, 10).cast("int") % n


def _letter(alphabet: str, stream: Column, place: Column) -> Column:
    return F.substring(F.lit(alphabet), _draw(stream, place, len(alphabet)) + 1, F.lit(1))


def _like(text: Column, stream: Column, hexadecimal: Column) -> Column:
    """Characters of the same classes and scripts; anything but letters and digits stays."""

    def one(c: Column, i: Column) -> Column:
        low = c == F.lower(c)
        latin = F.when(low, _letter(_LOWER, stream, i)).otherwise(_letter(_UPPER, stream, i))
        cyrillic = _letter(_CYRILLIC_LOWER, stream, i)
        return (
            F.when(hexadecimal & c.rlike("[0-9a-f]"), _letter(_HEX, stream, i))
            .when(hexadecimal & c.rlike("[A-F]"), F.upper(_letter(_HEX, stream, i)))
            .when(c.rlike("[0-9]"), _letter(_DIGITS, stream, i))
            .when(c.rlike(r"\p{IsCyrillic}"), F.when(low, cyrillic).otherwise(F.upper(cyrillic)))
            .when(c.rlike(r"\p{IsLatin}"), latin)
            # Of other scripts a code point close by: the same block, as blocks begin at multiples of 128.
            .when(c.rlike(r"\p{L}") & (F.length(c) == 1), _nearby(c, stream, i))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _nearby(c: Column, stream: Column, place: Column) -> Column:
    code = F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10).cast("int")
    moved = F.shiftleft(F.shiftright(code, 4), 4) + _draw(stream, place, 16)
    other = F.decode(F.unhex(F.lpad(F.hex(moved.cast("bigint")), 8, "0")), "UTF-32")
    return F.when(other.rlike(r"^\p{L}$"), other).otherwise(c)


def _luhn(digits: Column) -> Column:
    """The check sum of payment card numbers, 0 modulo 10 if right."""

    def weighed(d: Column, i: Column) -> Column:
        n = d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(n > 9, n - 9).otherwise(n)

    parts = F.transform(F.split(F.reverse(digits), ""), weighed)
    return F.aggregate(parts, F.lit(0), lambda total, x: total + x)


def _card(value: Column, stream: Column) -> Column:
    """First digit and grouping stay; the check digit is right if the value's was."""
    rest = F.substring(value, F.lit(2), F.length(value) - 2)
    body = F.concat(F.substring(value, 1, 1), _like(rest, stream, F.lit(False)))
    plain = F.regexp_replace(value, "[^0-9]", "")
    fitting = (10 - _luhn(F.concat(F.regexp_replace(body, "[^0-9]", ""), F.lit("0"))) % 10) % 10
    last = F.when(_luhn(plain) % 10 == 0, fitting).otherwise(_draw(stream, F.lit(29), 10))
    return F.concat(body, last.cast("string"))


def _ip(stream: Column) -> Column:
    return F.concat_ws(".", *[(_draw(stream, F.lit(i), 254) + 1).cast("string") for i in range(4)])


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The replacement of a value; another attempt gives another one."""
    message = F.concat_ws("\n", F.lit(key), kind, attempt.cast("string"), value)
    stream = F.sha2(F.concat(F.lit(key), F.sha2(message, 256)).cast("binary"), 512)
    kept = reduce(
        lambda rest, t: F.when(kind == t, F.regexp_extract(value, TYPES[t][1], 0)).otherwise(rest),
        [t for t in TYPES if TYPES[t][1] and t != "name"],
        F.lit(""),
    )
    tail = (
        F.when(kind == "email", F.regexp_extract(value, r"\.\p{L}{2,}$", 0))
        .when(kind == "name", F.regexp_extract(value, _ENDING, 0))
        .otherwise(F.lit(""))
    )
    # A form that has too few others is given up: the ending varies too, and then there are more characters.
    tail = F.when(attempt < FORM_ATTEMPTS, tail).otherwise(F.lit(""))
    middle = F.substring(value, F.length(kept) + 1, F.length(value) - F.length(kept) - F.length(tail))
    more = F.greatest(attempt - FORM_ATTEMPTS, F.lit(0))
    middle = F.concat(middle, F.repeat(F.when(middle.rlike(r"\p{L}$"), F.lit("e")).otherwise(F.lit("0")), more))
    hexadecimal = ((kind == "secret") & middle.rlike("^[0-9a-f]+$")) | (kind == "ipv6")
    general = F.concat(kept, _like(middle, stream, hexadecimal), tail)
    return F.when(kind == "ip", _ip(stream)).when(kind == "card", _card(value, stream)).otherwise(general)


def _given_names(key: str) -> Column:
    """Each listed given name's replacement: another of its gender and script, no two the same."""
    pairs = []
    for group, names in NAMES.items():
        listed = names.split()
        shift = 1 + int.from_bytes(hashlib.sha256(f"{key}\n{group}".encode()).digest()[:8]) % (len(listed) - 1)
        pairs += [x for i, name in enumerate(listed) for x in (name, listed[(i + shift) % len(listed)])]
    return F.create_map(*map(F.lit, pairs))


def _name_parts(match: Column, kind: Column, key: str) -> tuple[Column, Column]:
    """Of a name what precedes the family name, with the given name replaced, and the family name."""
    title = F.regexp_extract(match, TYPES["name"][1], 0)
    rest = F.substring(match, F.length(title) + 1, F.length(match))
    words = F.split(rest, " ")
    given = F.when(F.size(words) > 1, words[0])
    stream = F.sha2(F.concat_ws("\n", F.lit(key), F.lit("given"), given).cast("binary"), 512)
    # After a title a name from no list is replaced letter by letter.
    replaced = F.coalesce(F.try_element_at(_given_names(key), given), _like(given, stream, F.lit(False)))
    before = F.concat(title, F.coalesce(F.concat(replaced, F.lit(" ")), F.lit("")))
    is_name = kind == "name"
    return F.when(is_name, before).otherwise(F.lit("")), F.when(is_name, F.element_at(words, -1)).otherwise(match)


def assign(values: DataFrame, key: str) -> DataFrame:
    """kind, value and surrogate for the distinct values (kind, value), written.

    A surrogate that another value has too, or that is itself a value of the corpus, is drawn anew for
    all but the least of the values that share it, until there is none. Values of one type and length that are
    too many for their form get longer surrogates after some attempts, so this ends.
    """
    tasks = values.sparkSession.sparkContext.defaultParallelism
    current = materialize(values.distinct().withColumn("attempt", F.lit(0)), "private_values")
    while True:
        # Few rows, but much work for each.
        drawn = current.repartition(tasks, "value").withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), key))
        held = materialize(drawn, "surrogates")
        first = held.groupBy("surrogate").agg(F.min(F.struct("value", "kind")).alias("_first"), F.count(F.lit(1)).alias("_n"))
        real = held.select(F.col("value").alias("surrogate")).distinct().withColumn("_real", F.lit(True))
        doubtful = first.join(real, "surrogate", "left").where("_n > 1 or _real")
        doubtful = materialize(doubtful, "doubtful_surrogates")
        if doubtful.isEmpty():
            return held.select("kind", "value", "surrogate")
        judged = held.join(doubtful, "surrogate", "left")
        again = F.col("_real") | ((F.col("_n") > 1) & (F.struct("value", "kind") != F.col("_first")))
        current = judged.select("kind", "value", (F.col("attempt") + F.coalesce(again, F.lit(False)).cast("int")).alias("attempt"))


def replace(docs: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` with surrogates in ``text``, and ``n_replaced``.

    All other columns and texts without detected values stay as they are; null texts stay null. Equal
    values get equal surrogates wherever they occur and different values different ones; a family
    name has one surrogate whatever precedes it. Ids may be null or repeat. A column named
    n_replaced is replaced, names with a leading underscore are for internal use. Only texts with
    detected values are written and joined; all others pass through.
    """
    docs = docs.drop("n_replaced")
    columns = docs.columns
    # Cheap tests first: few texts need all patterns.
    maybe = F.col("text").rlike(_HINT)
    has = F.coalesce(F.when(maybe, F.col("text").rlike(_ANY)), F.lit(False))
    touched = materialize(
        docs.where(has).withColumn("_row", F.monotonically_increasing_id()).withColumn("_found", F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))),
        "private_texts",
    )
    matches = touched.select("_row", F.posexplode("_found").alias("_at", "_match")).withColumn("kind", entity_type(F.col("_match")))
    before, value = _name_parts(F.col("_match"), F.col("kind"), key)
    matches = materialize(matches.select("_row", "_at", "kind", before.alias("_before"), value.alias("value")), "private_matches")
    table = assign(matches.select("kind", "value"), key)
    known = measure_size(table, "surrogates_by_value")
    found = sized_join(matches, known, ["kind", "value"], ["_row", "_at"])
    # A text's own matches, in their order.
    listed = found.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("_at", F.concat("_before", F.coalesce("surrogate", "value")).alias("_new")))).alias("_new")
    )
    pieces = F.split("text", _ANY, -1)
    joined = F.zip_with(pieces, F.col("_new._new"), lambda piece, new: F.concat(piece, F.coalesce(new, F.lit(""))))
    # Every row has its matches there; the left join says that none may get lost.
    rebuilt = touched.join(listed, "_row", "left").withColumn("text", F.coalesce(F.array_join(joined, ""), F.col("text")))
    rebuilt = rebuilt.withColumn("n_replaced", F.size("_found"))
    untouched = docs.where(~has).withColumn("n_replaced", F.lit(0))
    return untouched.select(*columns, "n_replaced").unionAll(rebuilt.select(*columns, "n_replaced"))
