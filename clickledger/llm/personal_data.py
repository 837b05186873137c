"""Personal data, plain and in disguise.

Plain forms are found in the text as it is. For disguises a chain of small transducers rewrites the
text into a normal form: look-alike characters to ASCII, invisible characters to nothing, spelled
digits to digits, written-out or bracketed "at" and "dot" to @ and a full stop. Each output character
keeps the source characters it came from, so what the same detectors find in the normal form maps back
to a span of the source. A text without any trigger of a transducer is not rewritten.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_limits, batches

KINDS = ("email", "ip", "card", "phone")
# fixed values: the plain forms
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")  # from the first digit of a run
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# fixed values: Cyrillic and Greek letters that look like these Latin ones
LOOKALIKES = dict(
    zip(
        "аВеКМНОРСТХорсухіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧο",
        "aBeKMHOPCTXopcyxijsdqwABEZHIKMNOPTYXo",
    )
)
INVISIBLE = "­​‌‍⁠﻿"
# fixed values: digits in words
DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9", "oh": "0",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6",
    "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9",
}
_DIGIT = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_LETTER = r"[^\W\d_]"
# four or more spelled digits in a row, perhaps with a plus before them
SPELLED = re.compile(
    rf"(?:(?<!\w)plus[\s,.-]{{1,3}})?(?<!\w)(?:{_DIGIT})(?:[\s,.-]{{1,3}}(?:{_DIGIT})(?!\w)){{3,}}", re.I
)
_SPELLED_WORD = re.compile(rf"plus|{_DIGIT}", re.I)
BRACKETED = re.compile(
    r"\x20{0,2}(?:\[\x20?(?:(?P<at1>at|@)|(?P<dot1>dot|\.))\x20?\]|\(\x20?(?:(?P<at2>at|@)|(?P<dot2>dot|\.))\x20?\)|"
    r"\{\x20?(?:(?P<at3>at|@)|(?P<dot3>dot|\.))\x20?\}|<\x20?(?:(?P<at4>at|@)|(?P<dot4>dot))\x20?>)\x20{0,2}",
    re.I,
)
# name at host dot top-level: plain words count only in this whole shape
SPACED = re.compile(
    r"(?<=[A-Za-z0-9_%+-])(?:(?P<at>\x20{1,2}at\x20{1,2})|\x20{0,2}@\x20{0,2})[A-Za-z0-9-]+"
    r"(?:(?:\x20{1,2}dot\x20{1,2}|\x20?\.\x20?|\.)[A-Za-z0-9-]+){0,4}?\x20{1,2}dot\x20{1,2}[A-Za-z][A-Za-z0-9-]+"
    r"(?:\x20{1,2}dot\x20{1,2}[A-Za-z][A-Za-z0-9-]+){0,3}",
    re.I,
)
_SPACED_PART = re.compile(r"\x20{1,2}at\x20{1,2}|\x20{0,2}@\x20{0,2}|\x20{1,2}dot\x20{1,2}", re.I)
# with plain dots, a sign that stands apart, or an "at" after a word that announces an address
APART = re.compile(
    r"(?<=[A-Za-z0-9_%+-])\x20{1,2}@\x20{1,2}[A-Za-z0-9-]+(?:(?:\.|\x20\.\x20)[A-Za-z0-9-]+){0,4}?(?:\.|\x20\.\x20)[a-z]{2,24}(?![\w-])"
)
_APART_PART = re.compile(r"\x20{1,2}@\x20{1,2}|\x20\.\x20")
ANNOUNCED = re.compile(
    r"(?<!\w)(?:e-?mail|contact|write\x20to|reach)(?::\x20?|\x20{1,2})(?!(?:me|us|him|her|them|you|it|is|to)\x20)"
    r"[A-Za-z0-9._%+-]{1,64}(?P<at>\x20{1,2}at\x20{1,2})[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}(?![\w-])"
    r"|(?<!\w)mail\x20{1,2}(?!(?:me|us|him|her|them|you|it|is|to)\x20)"
    r"[A-Za-z0-9._%+-]{1,64}(?P<at2>\x20{1,2}at\x20{1,2})[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}(?![\w-])",
    re.I,
)
# spelled and plain digits in one run
MIXED = re.compile(
    rf"(?:(?<!\w)plus[\s,.-]{{1,3}})?(?<!\w)(?:{_DIGIT}|[0-9]{{1,19}})(?!\w)(?:[\s,.-]{{1,3}}(?:{_DIGIT}|[0-9]{{1,19}})(?!\w)){{3,}}", re.I
)
_MIXED_PART = re.compile(rf"plus|{_DIGIT}|[0-9]+", re.I)
DOTTED_NUMBERS = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\x20{1,2}dot\x20{1,2}[0-9]{1,3}){3}(?![0-9])", re.I)
# a local part may have spelled dots too: first dot last at ...
_DOT_BEFORE = re.compile(r"(?<=[A-Za-z0-9_%+-])\x20{1,2}dot\x20{1,2}(?=[A-Za-z0-9._%+-]{1,64}@)", re.I)
_ODD = re.compile(f"[{''.join(LOOKALIKES)}{INVISIBLE}！-～․﹒。﹫\U0001d400-\U0001d7ff]")

Piece = tuple[int, int, str]  # source start and end, and what stands for it


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses, looked for around each @ so that long runs without one cost nothing."""
    found, upto, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > upto and LOCAL.match(text, start - 1, start):
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            upto = host.end()
            found.append((start, upto))
            at = text.find("@", upto)
        else:
            at = text.find("@", at + 1)
    return found


def detect(text: str) -> list[tuple[int, int, int]]:
    """Plain spans of a text as (start, kind number, end)."""
    spans = [(s, 0, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        # longer parts than three digits are at most 255 only with leading zeros
        if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m.group().split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _only_digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_only_digits(m.group())) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


class Mapped:
    """A text in which each character knows its source span."""

    def __init__(self, text: str):
        self.text = text
        self.start: list[int] | range = range(len(text))
        self.end: list[int] | range = range(1, len(text) + 1)
        self.changed: list[tuple[int, int]] = []

    def rewrite(self, pieces: list[Piece]) -> None:
        """Replace spans of the text (in order, apart) by other text; each new character stands for
        its whole span."""
        if not pieces:
            return
        out, start, end, done = [], [], [], 0
        for a, b, new in pieces:
            out += [self.text[done:a], new]
            start += self.start[done:a]
            end += self.end[done:a]
            if b > a:
                start += [self.start[a]] * len(new)
                end += [self.end[b - 1]] * len(new)
                self.changed.append((self.start[a], self.end[b - 1]))
            done = b
        out.append(self.text[done:])
        start += self.start[done:]
        end += self.end[done:]
        self.text, self.start, self.end = "".join(out), start, end


def _plain_characters(text: str) -> list[Piece]:
    pieces = []
    for m in _ODD.finditer(text):
        c = m.group()
        new = "" if c in INVISIBLE else LOOKALIKES.get(c) or unicodedata.normalize("NFKC", c)
        new = "." if new == "。" else new
        if len(new) <= 1 and new.isascii():
            pieces.append((m.start(), m.end(), new))
    return pieces


def _bracketed(text: str) -> list[Piece]:
    return [(m.start(), m.end(), "@" if (m.lastgroup or "").startswith("at") else ".") for m in BRACKETED.finditer(text)]


def _spaced(text: str) -> list[Piece]:
    pieces = []
    for m in SPACED.finditer(text):
        for part in _SPACED_PART.finditer(m.group()):
            new = "." if part.group().strip().lower() == "dot" else "@"
            pieces.append((m.start() + part.start(), m.start() + part.end(), new))
    return pieces


def _spelled(text: str) -> list[Piece]:
    pieces = []
    for m in SPELLED.finditer(text):
        words = [w.group().lower() for w in _SPELLED_WORD.finditer(m.group())]
        new = "".join("+" if w == "plus" else DIGIT_WORDS[w] for w in words)
        pieces.append((m.start(), m.end(), new))
    return pieces


def _mixed(text: str) -> list[Piece]:
    """Runs that mix three or more spelled digits with plain ones and have as many as a phone or card."""
    pieces = []
    for m in MIXED.finditer(text):
        parts = [w.group().lower() for w in _MIXED_PART.finditer(m.group())]
        new = "".join("+" if w == "plus" else DIGIT_WORDS.get(w, w) for w in parts)
        spelled = sum(w in DIGIT_WORDS for w in parts)
        if spelled >= 3 and any(w.isdigit() for w in parts) and 10 <= len(_only_digits(new)) <= 19:
            pieces.append((m.start(), m.end(), new))
    return pieces


def _apart(text: str) -> list[Piece]:
    return [
        (m.start() + p.start(), m.start() + p.end(), p.group().strip())
        for m in APART.finditer(text)
        for p in _APART_PART.finditer(m.group())
    ]


def _announced(text: str) -> list[Piece]:
    return [(*m.span("at" if m["at"] else "at2"), "@") for m in ANNOUNCED.finditer(text)]


def _dotted(text: str) -> list[Piece]:
    dot = re.compile(r"\x20{1,2}dot\x20{1,2}", re.I)
    return [
        (m.start() + d.start(), m.start() + d.end(), ".")
        for m in DOTTED_NUMBERS.finditer(text)
        for d in dot.finditer(m.group())
    ]


_BRACKETS = re.compile(r"[\[({<]\x20?(?:at|dot|@|\.)\x20?[\])}>]", re.I)


def normalise(text: str) -> Mapped:
    """The text with all transducers applied in turn."""
    mapped = Mapped(text)
    if not mapped.text.isascii():
        mapped.rewrite(_plain_characters(mapped.text))
    if _BRACKETS.search(mapped.text):
        mapped.rewrite(_bracketed(mapped.text))
    low = mapped.text.lower()
    if " @ " in low:
        mapped.rewrite(_apart(mapped.text))
    if " at " in low and any(w in low for w in ("mail", "contact", "write to", "reach")):
        mapped.rewrite(_announced(mapped.text))
    if " dot " in low:
        mapped.rewrite(_spaced(mapped.text))
        # each round restores the last spelled dot of a local part
        while pieces := [(m.start(), m.end(), ".") for m in _DOT_BEFORE.finditer(mapped.text)]:
            mapped.rewrite(pieces)
        mapped.rewrite(_dotted(mapped.text))
    if any(w in low for w in _TELLING):
        mapped.rewrite(_mixed(mapped.text))
        if _may_spell(low):
            mapped.rewrite(_spelled(mapped.text))
    return mapped


# every run of four spelled digits holds one of these, but for runs of "un" and "oh" alone
_TELLING = [w for w in DIGIT_WORDS if len(w) > 2]


def _may_spell(low: str) -> bool:
    """Cheap look for any digit word before the search for four in a row."""
    return any(w in low for w in _TELLING) and SPELLED.search(low) is not None


def hidden_spans(text: str, plain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the normal form shows."""
    mapped = normalise(text)
    if not mapped.changed:
        return []
    changed = sorted(mapped.changed)
    found = []
    for start, kind, end in detect(mapped.text):
        a, b = mapped.start[start], mapped.end[end - 1]
        touched = any(x < b and a < y for x, y in changed)
        if touched and not any(k == kind and s <= a and b <= e for s, k, e in plain):
            found.append((a, kind, b))
    return found


def scan_text(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Plain and hidden spans of a text."""
    plain = detect(text)
    return plain, hidden_spans(text, plain)


SPANS = "array<struct<kind:string,start:int,end:int,hidden:boolean>>"


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, done = [], 0
    for start, kind, end in sorted(spans):
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def find_personal_data(docs: DataFrame, mask: bool = False, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Personal data of each document: the columns of `keep` and `found`, its spans by start (code points, end
    exclusive; `hidden` where only the normal form shows it), and with `mask` also `masked`.

    One row per row of `docs`, equal rows included; NULL doc_id stays NULL; a NULL text has no spans and
    stays NULL when masked. Texts are read whole. Other columns are ignored, whatever their names. An
    empty table gives no rows.
    """
    batch_limits(docs.sparkSession)
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("hidden", pa.bool_())])
    )

    def scan(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *kept, texts in batches(frames, [*keep, "_text"]):
            found, clean = [], []
            for text in texts.to_pylist():
                plain, hidden = scan_text(text or "")
                both = sorted([(*s, False) for s in plain] + [(*s, True) for s in hidden])
                found.append([dict(zip(("start", "kind", "end", "hidden"), (s, KINDS[k], e, h))) for s, k, e, h in both])
                if mask:
                    clean.append(None if text is None else masked(text, plain + hidden))
            columns = [*kept, pa.array(found, kind), *([pa.array(clean, pa.string())] if mask else [])]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "found", "masked"][: len(columns)])

    narrow = docs.select(*keep, F.col("text").alias("_text"))
    own = "".join(f"{name} {kind}, " for name, kind in narrow.dtypes[:-1])
    more = ", masked string" if mask else ""
    return narrow.mapInArrow(scan, f"{own}found {SPANS}{more}")
