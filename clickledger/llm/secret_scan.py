"""Secret scan: fixed forms, and strings that a battery of randomness tests cannot tell from random.

A candidate is a long run of letters, digits and the signs of base 64 that holds letters and digits.
Its encoding is the smallest alphabet that holds all its characters. Three tests ask whether it could
be random in that alphabet: chi-squared uniformity, runs above and below the middle of the alphabet,
and serial correlation of neighbours. A candidate must pass all three, with the level shared among
them. A long identifier or path passes them by chance too often, so the same three statistics, with the
number of changes of character class as a fourth, must also be unlikely as ordinary writing: words, numbers
and signs in stretches, with the letter frequencies of words. Their joint distribution in such writing is
drawn for each encoding and length, and the weighted sum that parts it best from random strings gives one
p-value. The candidates of a document that pass the battery are discoveries only under the weighted
Benjamini-Hochberg rule, with weights in proportion to length: longer strings get more of the allowed false
discoveries, short ones need more evidence.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch_limits, batches

KINDS = ("assign", "access", "hex", "random")
# fixed values: the forms that always count
ASSIGN = re.compile(
    r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run, as shorter ones count for nothing
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}")
# fixed values: alphabets from small to large
ALPHABETS = [
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]
PLACES = [(name, {c: i for i, c in enumerate(letters)}) for name, letters in ALPHABETS]


@dataclass(frozen=True)
class Levels:
    """`random`: level of the battery, at which truly random strings are missed. `discovery`: share of
    ordinary strings allowed among the found ones."""

    random: float = 0.001
    discovery: float = 0.01


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_p(symbols: list[int], size: int) -> float:
    """Upper tail of the chi-squared statistic of symbol counts, by its exact mean and variance."""
    n = len(symbols)
    counts: dict[int, int] = {}
    for s in symbols:
        counts[s] = counts.get(s, 0) + 1
    statistic = sum(c * c for c in counts.values()) * size / n - n
    mean, variance = size - 1, 2 * (size - 1) * (n - 1) / n
    # a gamma distribution of that mean and variance, by the cube-root normal form
    shape = mean * mean / variance
    cube = (max(statistic, 0) / mean) ** (1 / 3)
    return _normal_tail((cube - (1 - 1 / (9 * shape))) * 3 * math.sqrt(shape))


def runs_p(symbols: list[int], size: int) -> float:
    """Two-sided runs test above and below the middle of the alphabet."""
    high = [2 * s >= size for s in symbols]
    n, up = len(high), sum(high)
    down = n - up
    if not up or not down:
        return 2.0 ** (1 - n)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 2 * up * down / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    if variance <= 0:
        return 1.0
    return 2 * _normal_tail(max(0.0, abs(runs - mean) - 0.5) / math.sqrt(variance))


def serial_p(symbols: list[int]) -> float:
    """Two-sided test of the correlation of neighbours."""
    n = len(symbols)
    mean = sum(symbols) / n
    spread = sum((s - mean) ** 2 for s in symbols)
    if not spread:
        return 0.0
    r = sum((a - mean) * (b - mean) for a, b in zip(symbols, symbols[1:])) / spread
    return 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n))


def encoding(text: str) -> tuple[str, list[int], int] | None:
    """Name, symbol numbers and size of the smallest alphabet that holds the text."""
    held = set(text)
    for name, places in PLACES:
        if held <= places.keys():
            return name, [places[c] for c in text], len(places)
    return None


# fixed values: letters of words in percent, strings drawn for each length, and the longest length drawn
LETTERS = dict(zip("etaoinsrhldcumfpgwybvkxjqz", (12, 9, 8, 7.5, 7, 6.7, 6.3, 6, 6, 4, 4.2, 2.8, 2.8, 2.4, 2.2, 1.9, 2, 2.4, 2, 1.5, 1, 0.8, 0.15, 0.15, 0.1, 0.07)))
DRAWN, LONGEST, STREAM = 3000, 256, 150_000


def _marks(name: str) -> np.ndarray:
    """Character class of each symbol: digit, capital, small letter or sign."""
    letters = dict(ALPHABETS)[name]
    return np.array(["duls".index("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s") for c in letters])


@lru_cache(16)
def ordinary_writing(name: str) -> np.ndarray:
    """Symbols of a long stretch of words, numbers and signs in an alphabet."""
    places, draw = dict(PLACES)[name], random.Random(name)
    words = {k: v for k, v in LETTERS.items() if k in places or k.upper() in places}
    small, capital = "e" in places, "E" in places
    signs = [c for c in places if not c.isalnum()]
    out: list[str] = []
    size = 0
    while size < STREAM:
        if draw.random() < 0.75:
            piece = "".join(draw.choices(list(words), list(words.values()), k=draw.randint(2, 9)))
            # where signs part words, capitals are fewer
            style = draw.random() * (2 if signs and small else 1)
            if not small or (capital and style < 0.15):
                piece = piece.upper()
            elif capital and style < 0.65:
                piece = piece.capitalize()
        else:
            piece = "".join(draw.choices([c for c in places if c.isdigit()], k=draw.randint(1, 4)))
        if signs and draw.random() < 0.6:
            piece += draw.choice(signs)
        out.append(piece)
        size += len(piece)
    return np.array([places[c] for c in "".join(out)])


def statistics(symbols: np.ndarray, name: str) -> np.ndarray:
    """Per row of symbols: chi-squared, runs, correlation of neighbours, changes of class; each by length."""
    rows, n = symbols.shape
    size = len(dict(ALPHABETS)[name])
    counts = np.bincount((symbols + np.arange(rows)[:, None] * size).ravel(), minlength=rows * size).reshape(rows, size)
    chi = (counts.astype(float) ** 2).sum(1) / (n * (n - 1)) - 1 / (n - 1)
    high = 2 * symbols >= size
    runs = (high[:, 1:] != high[:, :-1]).mean(1)
    centred = symbols - symbols.mean(1, keepdims=True)
    spread = np.maximum((centred**2).sum(1), 1e-9)
    serial = (centred[:, 1:] * centred[:, :-1]).sum(1) / spread
    marks = _marks(name)[symbols]
    a, b = marks[:, :-1], marks[:, 1:]
    # a capital before small letters starts a word and is no change
    turns = ((a != b) & ~((a == 1) & (b == 2))).mean(1)
    return np.stack([chi, runs, serial, turns], 1)


@lru_cache(1024)
def _null(name: str, n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Means in ordinary writing, weights, and the deviation of the weighted sum, at one length."""
    draw = np.random.default_rng(n)
    stream, marks = ordinary_writing(name), _marks(name)
    rows = stream[draw.integers(0, len(stream) - n, DRAWN)[:, None] + np.arange(n)]
    held = marks[rows]
    mixed = (held == 0).any(1) & ((held == 1) | (held == 2)).any(1)
    ordinary = statistics(rows[mixed], name)
    even = statistics(draw.integers(0, len(marks), (DRAWN, n)), name)
    mean, spread = ordinary.mean(0), np.cov(ordinary.T) + 1e-9 * np.eye(4)
    weights = np.linalg.solve(spread, even.mean(0) - mean)
    return mean, weights, float(np.sqrt(weights @ spread @ weights))


def ordinary_p(text: str) -> float:
    """Chance that ordinary writing of this length and encoding looks as random or more."""
    found = encoding(text)
    if found is None:
        return 1.0
    name, symbols, _ = found
    n = len(symbols)
    # lengths are drawn in steps of an eighth; between them, and beyond, deviations fall with the root of the length
    at = 16
    while at + at // 8 <= min(n, LONGEST):
        at += at // 8
    mean, weights, spread = _null(name, at)
    z = (statistics(np.array([symbols]), name)[0] - mean) @ weights / (spread * math.sqrt(at / n))
    return _normal_tail(float(z))


def looks_random(text: str, level: float) -> bool:
    """All tests of the battery pass at their share of the level."""
    found = encoding(text)
    if found is None:
        return False
    _, symbols, size = found
    share = level / 3
    return (
        chi_squared_p(symbols, size) >= share
        and runs_p(symbols, size) >= share
        and serial_p(symbols) >= share
    )


def random_spans(text: str, levels: Levels) -> list[tuple[int, int]]:
    """Spans of the random-looking strings of a text, after false-discovery control."""
    tested = []
    for m in CANDIDATE.finditer(text):
        held = m.group()
        if not any(c.isdigit() for c in held) or not any(c.isalpha() for c in held):
            continue
        # what the battery rejects is no hypothesis of the family
        if looks_random(held, levels.random):
            tested.append((ordinary_p(held), m.start(), m.end()))
    if not tested:
        return []
    mean = sum(e - s for _, s, e in tested) / len(tested)
    weighted = sorted((p * mean / (e - s), s, e) for p, s, e in tested)
    last = 0
    for k, (p, _, _) in enumerate(weighted, 1):
        if p <= levels.discovery * k / len(weighted):
            last = k
    return [(s, e) for _, s, e in weighted[:last]]


def scan_text(text: str, levels: Levels) -> list[tuple[int, int, str]]:
    """All spans of a text as (start, kind number, end, kind), by start and kind."""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        spans += [
            (m.start(), 1, m.end(), "access")
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= 20
        ]
    spans += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text)]
    base = [(s, e) for s, _, e, _ in spans]
    for s, e in random_spans(text, levels):
        if not any(b <= s and e <= f for b, f in base):
            spans.append((s, 3, e, "random"))
    return sorted(spans)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_secrets(docs: DataFrame, levels: Levels = Levels()) -> DataFrame:
    """Secrets of each document: doc_id and `found`, its spans by start (code points, end exclusive).

    One row per row of `docs`, equal rows included; NULL doc_id stays NULL, a NULL or empty text has
    no spans. Texts are read whole. Other columns of `docs` are ignored, whatever their names; an empty
    table gives no rows.
    """
    batch_limits(docs.sparkSession)

    def scan(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        )
        for ids, texts in batches(frames, ["doc_id", "text"]):
            found = [
                [{"kind": k, "start": s, "end": e} for s, _, e, k in scan_text(t or "", levels)]
                for t in texts.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, kind)], ["doc_id", "found"])

    narrow = docs.select("doc_id", "text")
    return narrow.mapInArrow(scan, f"doc_id {dict(narrow.dtypes)['doc_id']}, found {SPANS}")
