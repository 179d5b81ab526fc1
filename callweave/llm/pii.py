"""Personal data: plain identifiers, and disguised ones found through transducers.

Plain identifiers are found in the text as it is (``plain_spans``), each kind on its own, from left
to right without overlap; matches that fail their test are dropped. The rules are written so
that a text is read in linear time, also one of a million digits.

Disguised ones: three transducers rewrite the text one after another and keep, for each
character they write, where in the source it comes from. The first replaces homoglyphs and
drops invisible characters, the second turns spelled digits into digits, the third turns
disguises of "at" and "dot" into their signs. The same detectors read the result, and the
spans they find are mapped back to the source. A span is added if it overlaps no plain one;
plain ones always stay.

Offsets are code points, ends are exclusive. Null and empty texts have no spans; repeated rows
are searched each.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callweave.llm.common import one_array, slices, text_column

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones, and signs that look like those of addresses.
LOOKALIKES = dict(zip(
    "аеорсухіјѕԁһԛԝкмтвнАЕОРСУХІЈЅВНКМТοαρνικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ․。﹒﹫‐‑‒–—−∙",
    "aeopcyxijsdhqwkmtbhAEOPCYXIJSBHKMToapvikABEZHIKMNOPTYX...@------.",
))
INVISIBLE = "­​‌‍⁠﻿"
ODD = re.compile(
    "[" + re.escape("".join(LOOKALIKES)) + INVISIBLE
    + " ²³¹٠-٩۰-۹०-९ -  ⁰-₉℀-⅏"
    + "①-⒛Ⓐ-⓿　！-～\U0001d400-\U0001d7ff]"
)

DIGITS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "oh": "0", "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8",
    "neuf": "9", "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}
_DIGIT = "|".join(sorted(DIGITS, key=len, reverse=True))
#: Three spelled digits in a row at least.
SPELLED = re.compile(rf"(?<!\w)(?:{_DIGIT})(?:[ ,.-]{{1,2}}(?:{_DIGIT})){{2,}}(?!\w)", re.I)
WORD = re.compile(rf"{_DIGIT}", re.I)
#: Signs in words, between digits.
DIGIT_SIGN = re.compile(r"(?<=[0-9]) {1,3}(?:dot|point|punkt|punto) {1,3}(?=[0-9])|(?<!\w)plus {1,3}(?=[0-9])", re.I)

_AT = r" {0,3}[\[({<] {0,3}(?:at|@|a|arroba|arobase) {0,3}[\])}>] {0,3}"
_DOT = r" {0,3}[\[({<] {0,3}(?:dot|point|punkt|punto|\.) {0,3}[\])}>] {0,3}"
_BARE_AT = r" {1,3}(?:at|arroba|arobase) {1,3}"
_BARE_DOT = r" {1,3}(?:dot|point|punkt|punto) {1,3}"
AT = re.compile(rf"(?P<bracket>{_AT})|(?P<plain>@)|(?P<bare>{_BARE_AT})", re.I)
DOT = re.compile(rf"{_DOT}|{_BARE_DOT}", re.I)
#: Labels with dots, or signs for them, in between; before an at, and after one.
BEFORE = re.compile(rf"[A-Za-z0-9_%+-]++(?:(?:\.|{_DOT}|{_BARE_DOT})[A-Za-z0-9_%+-]++)*+", re.I)
AFTER = re.compile(rf"[A-Za-z0-9-]++(?:(?:\.|{_DOT}|{_BARE_DOT})[A-Za-z0-9-]++)++", re.I)
#: Last labels that an address without any bracket must have, since "at" and "dot" are words, too.
LAST_LABELS = frozenset(
    "com org net edu gov mil int info biz io co eu uk us de fr es it nl ch be ca au cn jp br ru pl se dk fi pt mx test example".split()
)
#: One of these stands in every text with a disguised address.
BRACKET = re.compile(r"[\[({<] {0,3}(?:at|@|a|arroba|arobase|dot|point|punkt|punto|\.) {0,3}[\])}>]", re.I)
BARE = re.compile(r" (?:dot|point|punkt|punto) ", re.I)


def _emails(text: str):
    """A run of local characters before an at, and at least two labels after it."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", match.end() if match else at + 1)


def _ips(text: str):
    """Four numbers after one another in a dotted chain; none above 255."""
    for chain in CHAIN.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            length = sum(map(len, four)) + 3
            if all(len(n := p.lstrip("0")) <= 3 and int(n or "0") <= 255 for p in four):
                yield at, at + length
            at += length + 1


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def _cards(text: str):
    for match in CARD.finditer(text):
        if match.end() - match.start() >= 14:
            digits = match.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                yield match.span()


def _phones(text: str):
    if "+" in text:
        for match in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in match.group()) <= 15:
                yield match.span()


FINDERS = (_emails, _ips, _cards, _phones)


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of identifiers that stand in the text as they are, in order."""
    return sorted((a, kind, b) for kind, find in enumerate(FINDERS) for a, b in find(text))


class Tape:
    """A rewritten text; each character knows its span in the source."""

    def __init__(self, text: str):
        self.text, self.begin, self.end = text, range(len(text)), range(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans, from left to right; what is written for one has its whole span."""
        text, begin, end, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            begin += [*self.begin[at:a], *[self.begin[a]] * len(new)]
            end += [*self.end[at:a], *[self.end[b - 1]] * len(new)]
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.begin = [*begin, *self.begin[at:]]
        self.end = [*end, *self.end[at:]]


def _plain_character(c: str) -> str:
    if c in INVISIBLE:
        return ""
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    digit = unicodedata.decimal(c, None)
    folded = str(digit) if digit is not None else unicodedata.normalize("NFKC", c)
    return folded if len(folded) == 1 and folded.isascii() else c


def homoglyphs(tape: Tape) -> None:
    tape.rewrite([(m.start(), m.end(), _plain_character(m.group())) for m in ODD.finditer(tape.text)])


def spelled_digits(tape: Tape) -> None:
    edits = []
    for run in SPELLED.finditer(tape.text):
        words = list(WORD.finditer(tape.text, run.start(), run.end()))
        for word, after in zip(words, [*words[1:], None]):
            edits.append((word.start(), word.end(), DIGITS[word.group().lower()]))
            if after and after.start() > word.end():
                edits.append((word.end(), after.start(), ""))
    if edits:
        tape.rewrite(edits)
        tape.rewrite([(m.start(), m.end(), "+" if "plus" in m.group().lower() else ".") for m in DIGIT_SIGN.finditer(tape.text)])


def signs_in_words(tape: Tape) -> None:
    """An address has its labels directly around an at. A bracketed "at" counts by itself, a bare one
    only with a "dot" in words and a usual last label. Each stretch of the text is read once."""
    text, edits, at = tape.text, [], 0
    for sign in AT.finditer(text):
        if sign.start() < at:
            continue
        domain = AFTER.match(text, sign.end())
        if not domain:
            continue
        if sign["bare"] and not (DOT.search(domain.group()) and re.split(r"[ .]", domain.group())[-1].lower() in LAST_LABELS):
            continue
        local = None
        for local in BEFORE.finditer(text, at, sign.start()):
            pass
        at = domain.end()
        if local is None or local.end() != sign.start():
            continue
        edits += [(m.start(), m.end(), ".") for m in DOT.finditer(text, local.start(), local.end())]
        edits.append((sign.start(), sign.end(), "@"))
        edits += [(m.start(), m.end(), ".") for m in DOT.finditer(text, domain.start(), domain.end())]
    tape.rewrite(edits)


def all_spans(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, disguised) of all identifiers, in order."""
    plain = plain_spans(text)
    found = [(*span, False) for span in plain]
    odd = not text.isascii() and ODD.search(text)
    words = text.lower().replace("-", " ").replace(",", " ").replace(".", " ").split()
    spelled = not DIGITS.keys().isdisjoint(words) and SPELLED.search(text)
    hint = BRACKET.search(text) or BARE.search(text)
    if not (odd or spelled or hint):
        return found
    tape = Tape(text)
    if odd:
        homoglyphs(tape)
    if odd or spelled:
        spelled_digits(tape)
    signs_in_words(tape)
    if tape.text == text:
        return found
    taken: list[list[int]] = []  # plain spans as intervals apart from each other
    for a, _, b in plain:
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    for a, kind, b in plain_spans(tape.text):
        start, end = tape.begin[a], tape.end[b - 1]
        i = bisect_left(taken, [end, 0])
        if not (i and taken[i - 1][1] > start):
            found.append((start, kind, end, True))
    return sorted(found)


SPANS = "array<struct<kind:string,start:int,end:int,disguised:boolean>>"


def with_spans(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row as column ``row`` (or the columns ``carry`` of it) with its ``spans``, by start and
    then by kind in the order of ``KINDS``, and ``redacted``: the text with kinds for spans."""
    rows = docs.select(F.struct(*(carry or ["*"])).alias("row"), text_column(text).alias("text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("disguised", pa.bool_())]))

    def search(batches):
        for part in slices(batches):
            texts = one_array(part.column("text")).to_pylist()
            found = [all_spans(t) for t in texts]
            spans = pa.array([[(KINDS[k], a, b, d) for a, k, b, d in f] for f in found], kind)
            redacted = pa.array([_redacted(t, f) if f else t for t, f in zip(texts, found)], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("row"), spans, redacted], names=["row", "spans", "redacted"])

    return rows.mapInArrow(search, f"row {rows.schema['row'].dataType.simpleString()}, spans {SPANS}, redacted string")


def _redacted(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """Overlapping spans become one, with the kind of the first."""
    out, at = [], 0
    for start, kind, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
