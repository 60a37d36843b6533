"""Personal data, also where it is disguised, with spans in the source text.

Transducers rewrite a text piece by piece (homoglyphs to ASCII, spelled digits to digits,
at/dot disguises to @ and .) and keep where each piece came from. Detectors run over the text
as it is and over the rewritten one; what they find there leads back to source characters.
"""

from __future__ import annotations

import bisect
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is taken from its first one: a start inside it can match no more.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

# Letters of other scripts that look like ASCII ones, and number words.
HOMOGLYPHS = dict(
    zip(
        "АВЕКМНОРСТХаеорсухіјѕԁɡΑΒΕΖΗΙΚΜΝΟΡΤΥΧοντ＠．﹫。·",
        "ABEKMHOPCTXaeopcyxijsdgABEZHIKMNOPTYXovt@.@..",
    )
)
HOMOGLYPHS |= {chr(0xFF01 + k): chr(0x21 + k) for k in range(94)}  # fullwidth ASCII
NUMBER_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}

_WORD = "|".join(NUMBER_WORDS)
_GLYPH = re.compile("[" + "".join(map(re.escape, HOMOGLYPHS)) + "]")
_AT = r"(?:\s*[\(\[\{<]\s*at\s*[\)\]\}>]\s*|\s*@\s*|\s+at\s+)"
_DOT = r"(?:\s*[\(\[\{<]\s*dot\s*[\)\]\}>]\s*|\s+dot\s+)"
# Possessive throughout: a chain of names is read once, whatever follows it.
_NAMES = re.compile(rf"[A-Za-z0-9_%+-]++(?:(?:\.|{_DOT})[A-Za-z0-9_%+-]++)*+", re.I)
_HOST = re.compile(rf"[A-Za-z0-9-]++(?:(?:\.|{_DOT})[A-Za-z0-9-]++)++", re.I)
_QUAD = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:(?:\.|{_DOT})[0-9]{{1,3}}){{3}}(?![0-9])", re.I)
_AT_MARK, _DOT_MARK = re.compile(_AT, re.I), re.compile(_DOT, re.I)
_BRACKETED_AT = re.compile(r"[\(\[\{<]\s*at\s*[\)\]\}>]", re.I)
_DISGUISE = re.compile(r"[\(\[\{<]\s*(?:at|dot)\s*[\)\]\}>]|\sdot\s", re.I)
_SPELLED = re.compile(rf"(?<![A-Za-z])(?:plus[\s-]+)?(?:{_WORD})(?:[\s,.-]+(?:{_WORD}|[0-9]))+(?![A-Za-z])", re.I)
_NUMBER = re.compile(rf"plus|{_WORD}|[0-9]", re.I)
_PAIR = re.compile(rf"(?:{_WORD})[\s,.-]+(?:{_WORD})[\s,.-]+(?:{_WORD})", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the leftmost non-overlapping matches per kind, sorted."""
    found = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            found.append((start, 0, match.end()))
            done = match.end()
        at = text.find("@", max(done, at + 1))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of names, an "at" and a host; each chain of names is tried once, from its start."""
    at = 0
    while names := _NAMES.search(text, at):
        at = names.end()
        mark = _AT_MARK.match(text, at)
        host = mark and _HOST.match(text, mark.end())
        if host:
            at = host.end()
            yield names.start(), at


def _rewrites(text: str) -> list[tuple[int, int, str]]:
    """(start, end, replacement) of disguised pieces, apart from homoglyphs."""
    found = []
    if _DISGUISE.search(text):
        for start, end in _addresses(text):
            address = text[start:end]
            # Plain words "at" and "." alone are prose; one of the marks must be a disguise.
            if not (_DOT_MARK.search(address) or _BRACKETED_AT.search(address)):
                continue
            for mark, sign in ((_AT_MARK, "@"), (_DOT_MARK, ".")):
                found += [(start + x.start(), start + x.end(), sign) for x in mark.finditer(address)]
        for m in _QUAD.finditer(text):
            found += [(m.start() + x.start(), m.start() + x.end(), ".") for x in _DOT_MARK.finditer(m[0])]
    if _PAIR.search(text):
        for m in _SPELLED.finditer(text):
            parts = list(_NUMBER.finditer(m[0]))
            for k, x in enumerate(parts):
                sign = "+" if x[0].lower() == "plus" else NUMBER_WORDS.get(x[0].lower(), x[0])
                end = parts[k + 1].start() if k + 1 < len(parts) else x.end()
                between = m[0][x.end() : end]
                found.append((m.start() + x.start(), m.start() + end, sign + ("." if between.strip() == "." else "")))
    return found


def disguised(text: str, plain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the rewritten text shows, in source characters; none inside one of ``plain``."""
    edits = [] if text.isascii() else [(m.start(), m.end(), HOMOGLYPHS[m[0]]) for m in _GLYPH.finditer(text)]
    if edits:
        source, glyphs = text, edits
        text = _GLYPH.sub(lambda m: HOMOGLYPHS[m[0]], text)  # one character for one
        edits = sorted([*_rewrites(text), *[(a, b, text[a:b]) for a, b, _ in glyphs]])
    else:
        edits = sorted(_rewrites(text))
    if not edits:
        return []
    pieces, starts, sources, at, out = [], [], [], 0, 0
    changed = []
    for a, b, sign in edits:
        if a < at:
            continue
        if a > at:
            pieces.append(text[at:a]); starts.append(out); sources.append((at, a, False)); out += a - at
        pieces.append(sign); starts.append(out); sources.append((a, b, True)); changed.append(out)
        out += len(sign)
        at = b
    pieces.append(text[at:]); starts.append(out); sources.append((at, len(text), False))

    def origin(place: int, end: bool) -> int:
        k = bisect.bisect_right(starts, place - end) - 1
        a, b, whole = sources[k]
        return (b if end else a) if whole else a + place - starts[k]

    found = []
    for start, kind, end in detect("".join(pieces)):
        k = bisect.bisect_left(changed, start)
        if k == len(changed) or changed[k] >= end:
            continue
        a, b = origin(start, False), origin(end, True)
        if not any(k == kind and x <= a and b <= y for x, k, y in plain):
            found.append((a, kind, b))
    return found


def all_spans(text: str | None) -> tuple[list, list]:
    """(base spans, added spans) of a text; null counts as empty."""
    plain = detect(text or "")
    return plain, disguised(text or "", plain)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added) per row: arrays of (start, kind_no, end), in code points, sorted.

    Null and empty texts have none; null ids and repeated rows give a row each. The time for a
    text grows with its length, whatever it holds.
    """

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(spans: list) -> list[dict]:
            return [{"start": a, "kind_no": k, "end": b} for a, k, b in sorted(spans)]

        for batch in batches:
            both = [all_spans(t) for t in batch["text"]]
            yield pd.DataFrame(
                {"id": batch["id"], "base": [rows(b) for b, _ in both], "added": [rows(a) for _, a in both]}
            )

    span = "array<struct<start: int, kind_no: int, end: int>>"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(of, f"id long, base {span}, added {span}")
