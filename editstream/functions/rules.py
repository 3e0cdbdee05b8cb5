"""Turning rules into boolean column expressions over a text and its lower-cased form."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


# --- Fixed value: characters of prose from the most to the least frequent; all others are rarer ---
FREQUENT = " etaoinshrdlcumwfgypbvkjxqz"
LEAST_TAIL = 4


def rare_tail(phrase: str) -> str:
    """The end of the phrase that starts with its least frequent character.

    ``contains`` compares wherever the first byte agrees, which a frequent letter does in every word.
    """
    starts = range(max(len(phrase) - LEAST_TAIL, 0) + 1)
    ranks = [FREQUENT.index(c) if c in FREQUENT else len(FREQUENT) for c in phrase]
    return phrase[max(starts, key=lambda i: ranks[i]) :] if phrase else phrase


def holds_phrase(text: Column, phrase: str) -> Column:
    """Whether the text contains the phrase, looked for only in texts that contain its rare tail.

    Both are searched as bytes, which Spark does in about half the time of a search in text.
    """
    octets, tail = text.cast("binary"), rare_tail(phrase)
    found = F.contains(octets, F.lit(phrase.encode("utf-8")))
    return found if tail == phrase else F.contains(octets, F.lit(tail.encode("utf-8"))) & found


def any_phrase(text: Column, phrases: list[str]) -> Column:
    if not phrases:
        return F.lit(False)
    return reduce(or_, [holds_phrase(text, phrase) for phrase in phrases])


def _java_flags(rule: dict) -> str:
    # `d` always: otherwise Java's `.`, `^` and `$` also react to \r, U+0085 and U+2028.
    flags = "d"
    if rule.get("multiline"):
        flags += "m"
    if rule.get("ignore_case"):
        flags += "iu"
    return f"(?{flags})"


def code_point_spans(ranges: str) -> list[tuple[int, int]]:
    spans = []
    for part in ranges.split():
        low, _, high = part.partition("-")
        spans.append((int(low, 16), int(high or low, 16)))
    return spans


def code_point_class(spans: list[tuple[int, int]]) -> str:
    return "[" + "".join(rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in spans) + "]"


def may_hold_code_points(text: Column, spans: list[tuple[int, int]]) -> Column:
    """False only for texts without any code point of the spans, told by their UTF-8 bytes.

    All spans lie above U+07FF. A lead byte, with the second byte above the basic plane, tells
    4,096 code points apart, which is enough to keep Latin, Greek, Cyrillic and most other
    texts away from the regex engine.
    """
    leads = set()
    for low, high in spans:
        for block in range(low >> 12, (high >> 12) + 1):
            first = chr(max(block << 12, 0x800)).encode("utf-8")
            leads.add(first[:2] if block > 0xF else first[:1])
    octets = text.cast("binary")
    return reduce(or_, [F.contains(octets, F.lit(lead)) for lead in sorted(leads)])


def holds_code_point(text: Column, spans: list[tuple[int, int]]) -> Column:
    """Whether any single code point of the text lies in the spans.

    Java tries a class range by range at every character, so the text is first cut down to the
    characters between the lowest and highest span of a plane, of which there are few.
    """
    planes: dict[int, tuple[int, int]] = {}
    for low, high in spans:
        known = planes.get(low >> 16, (low, high))
        planes[low >> 16] = (min(known[0], low), max(known[1], high))
    others = code_point_class(list(planes.values())).replace("[", "[^", 1) + "+"
    candidates = F.regexp_replace(text, others, "")
    return may_hold_code_points(text, spans) & candidates.rlike(code_point_class(spans))


def condition(rule: dict, text: Column, lowered: Column) -> Column:
    kind = rule["kind"]
    if kind == "phrases":
        return any_phrase(lowered, rule["patterns"])
    if kind == "letters":
        return any_phrase(text, rule["any_of"]) & ~any_phrase(text, rule["none_of"])
    if kind == "density":
        character, per, above = rule["character"], rule["per"], rule["above"]
        size = F.char_length(text)
        without = F.char_length(F.replace(text, F.lit(character), F.lit("")))
        found = F.contains(text, F.lit(character))
        return found & ((size - without) * per > size * above)
    if kind == "code_points":
        return holds_code_point(text, code_point_spans(rule["ranges"]))
    if kind == "regex":
        flags = _java_flags(rule)
        hit = text.rlike(flags + rule.get("search", rule["pattern"]))
        if rule.get("needs"):
            hit = any_phrase(text, rule["needs"]) & hit
        if rule.get("characters"):
            spans = [(ord(c), ord(c)) for c in rule["characters"]]
            hit = may_hold_code_points(text, spans) & hit
        if rule.get("exclude"):
            hit = hit & ~text.rlike("(?d)" + rule["exclude"])
        return hit
    raise ValueError(f"unknown rule kind {kind!r} for flag {rule.get('flag')!r}")
