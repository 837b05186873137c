"""Periodic runs of words, found in a grammar of each text.

A run is a stretch of words with smallest period q, at least `times` periods and `least` words long, that no
neighbouring word extends. Each text is compressed by Re-Pair over its word ids: as long as pairs of
symbols repeat within a text, a pair becomes a new symbol where it is more frequent than the pairs that it
overlaps. A pair that occurs once can never be part of a repeated one, so its boundary stays in the text's
top rule.

A run lies across the boundary of the smallest symbol that holds it, or across a boundary of the top rule. So
each symbol's boundary is searched once, in the symbol's first expansion: a run has so many equal words
q apart that a gram of eight words beside the boundary must come again q words away, and each such place is
extended as far as the symbol goes. What is found is moved to all places where the grammar derives the
symbol; pieces of one period that overlap by a period are merged into the maximal run.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, batch_limits, batches, raw_texts

_GRAM, _BASE = 0xD1B54A32D192ED03, np.uint64(0x9FB21C651E98DF25)
_CHUNK = 1 << 21


class Grammar:
    """Re-Pair of all texts of a batch, each by itself.

    `top`: whether a word begins a symbol of its text's top rule. Symbols of `least` words and more: `left` and
    `size` are the words of their left part and in all, `places` the words where they are derived, by
    symbol from `first` on.
    """

    def __init__(self, ids: np.ndarray, doc: np.ndarray, least: int):
        n = len(ids)
        self.top = np.ones(n, bool)
        # a text's words are its own terminals
        _, symbol = np.unique(ids * (int(doc[-1]) + 1 if n else 1) + doc, return_inverse=True)
        size = np.ones(int(symbol.max()) + 1 if n else 0, np.int64)
        at = np.arange(n)
        joined = np.r_[doc[1:] == doc[:-1], False] if n else np.zeros(0, bool)
        left, whole, places, owner = [], [], [], []
        kept = 0
        while joined.any():
            pairs = np.flatnonzero(joined)
            keys = symbol[pairs] * len(size) + symbol[pairs + 1]
            _, pair, count = np.unique(keys, return_inverse=True, return_counts=True)
            repeated = count[pair] > 1
            joined[pairs[~repeated]] = False
            pairs, pair = pairs[repeated], pair[repeated]
            if not len(pairs):
                break
            rank = np.full(len(symbol) + 1, -1, np.int64)
            rank[pairs] = count[pair] << 32 | pair
            chosen = self._chosen(rank[:-1])
            # the new symbols, by pair
            made, new = np.unique(rank[chosen], return_inverse=True)
            lengths = np.zeros(len(made), np.int64)
            halves = np.zeros(len(made), np.int64)
            halves[new] = size[symbol[chosen]]
            lengths[new] = size[symbol[chosen]] + size[symbol[chosen + 1]]
            self.top[at[chosen + 1]] = False
            long = lengths >= least
            if long.any():
                number = np.cumsum(long) - 1 + kept
                pick = long[new]
                left.append(halves[long])
                whole.append(lengths[long])
                places.append(at[chosen[pick]])
                owner.append(number[new[pick]])
                kept += int(long.sum())
            symbol[chosen] = len(size) + new
            size = np.r_[size, lengths]
            joined[chosen] = joined[chosen + 1]
            stay = np.ones(len(symbol), bool)
            stay[chosen + 1] = False
            # symbols without a repeated pair on either side are done
            stay &= joined | np.r_[False, joined[:-1]]
            symbol, at, joined = symbol[stay], at[stay], joined[stay]
            used, symbol = np.unique(symbol, return_inverse=True)
            size = size[used]
        flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.left, self.size = flat(left), flat(whole)
        owner, places = flat(owner), flat(places)
        order = np.lexsort((places, owner))
        self.places = places[order]
        self.first = np.r_[0, np.cumsum(np.bincount(owner, minlength=kept))]

    @staticmethod
    def _chosen(rank: np.ndarray) -> np.ndarray:
        """Places of pairs that outrank the pairs they overlap; of equal pairs in a row every second one."""
        edge = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1], True])
        start, stop, value = edge[:-1], edge[1:], rank[edge[:-1]]
        before, after = np.r_[-1, value[:-1]], np.r_[value[1:], -1]
        best = (value >= 0) & (value > before) & (value > after)
        block = np.repeat(np.arange(len(start)), stop - start)
        offset = np.arange(len(rank)) - start[block]
        return np.flatnonzero(best[block] & (offset % 2 == 0))


class Equal:
    """How far the words from two places on, or before them, are the same."""

    def __init__(self, words: np.ndarray):
        with np.errstate(over="ignore"):
            self.power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(words), _BASE)])
            self.sums = np.r_[np.uint64(0), np.cumsum(words * self.power[:-1])]

    def _same(self, i: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the `n` words from i on are those from i + q on."""
        with np.errstate(over="ignore"):
            one = (self.sums[i + n] - self.sums[i]) * self.power[q]
            return one == self.sums[i + q + n] - self.sums[i + q]

    def _most(self, room: np.ndarray, good) -> np.ndarray:
        low, high = np.zeros_like(room), room.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fine = good(middle)
            low, high = np.where(fine, middle, low), np.where(fine, high, middle - 1)
        return low

    def after(self, i: np.ndarray, q: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return self._most(stop - i - q, lambda n: self._same(i, q, n))

    def before(self, i: np.ndarray, q: np.ndarray, start: np.ndarray) -> np.ndarray:
        return self._most(i - start, lambda n: self._same(i - n, q, n))


def _ragged(first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and entry of the ranges that begin at `first`."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, first[owner] + np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]


def _pieces(words: Words, grammar: Grammar, least: int, times: int) -> np.ndarray:
    """Rows of start, end and period found across boundaries, moved to all their places in the batch.

    Equal words q apart come at least least - q and (times - 1) q in a row, so at least `pairs`; a boundary among
    them has half of these on one side.
    """
    n = len(words.hash)
    pairs = min(max(least - q, (times - 1) * q) for q in range(1, least + 1))
    width = max(pairs // 2, 1)
    grams = words.grams(width, _GRAM)
    full = np.flatnonzero(words.first[1:][words.doc] - np.arange(n) >= width)
    order = full[np.lexsort((full, grams[full], words.doc[full]))]
    fresh = np.r_[True, (grams[order[1:]] != grams[order[:-1]]) | (words.doc[order[1:]] != words.doc[order[:-1]])]
    group = np.full(n, -1, np.int64)
    group[order] = np.cumsum(fresh[: len(order)]) - 1
    listed = group[order] * n + order
    # (boundary, first and last word that may be looked at, symbol); -1 for the top rule
    starts, stops = words.first[:-1], words.first[1:]
    outer = np.flatnonzero(grammar.top)
    outer = outer[outer > starts[words.doc[outer]]]
    origin = grammar.places[grammar.first[:-1]]
    boundary = np.r_[outer, origin + grammar.left]
    low = np.r_[starts[words.doc[outer]], origin]
    high = np.r_[stops[words.doc[outer]], origin + grammar.size]
    symbol = np.r_[np.full(len(outer), -1), np.arange(len(origin))]
    anchor = np.r_[boundary, boundary - width]
    low, high, symbol = np.r_[low, low], np.r_[high, high], np.r_[symbol, symbol]
    good = (anchor >= low) & (anchor + width <= high) & (high - low >= least)
    _, once = np.unique(np.stack([anchor[good], symbol[good]]), axis=1, return_index=True)
    anchor, low, high, symbol = (x[good][once] for x in (anchor, low, high, symbol))
    reach = (high - low) // times
    key = group[anchor] * n
    begin = np.searchsorted(listed, key + np.maximum(anchor - reach, low))
    end = np.searchsorted(listed, key + np.minimum(anchor + reach, high - width), "right")
    many = np.flatnonzero(end - begin > 1)
    anchor, low, high, symbol, begin, end = (x[many] for x in (anchor, low, high, symbol, begin, end))
    equal = Equal(words.hash)
    found = [np.zeros((0, 4), np.int64)]
    full_chunks = (np.cumsum(end - begin) - 1) // _CHUNK
    for part in np.split(np.arange(len(anchor)), np.flatnonzero(np.diff(full_chunks)) + 1):
        owner, place = _ragged(begin[part], (end - begin)[part])
        here, there = anchor[part][owner], order[place]
        owner, here, there = (x[here != there] for x in (owner, here, there))
        i, q = np.minimum(here, there), np.abs(here - there)
        lowest, highest, own = low[part][owner], high[part][owner], symbol[part][owner]
        s = i - equal.before(i, q, lowest)
        e = i + equal.after(i, q, highest) + q
        fine = e - s >= np.maximum(least, times * q)
        found.append(np.unique(np.stack([own, s, e, q], axis=1)[fine], axis=0))
    rows = np.unique(np.concatenate(found), axis=0)
    inner = rows[rows[:, 0] >= 0]
    moved, place = _ragged(grammar.first[inner[:, 0]], np.diff(grammar.first)[inner[:, 0]])
    shift = grammar.places[place] - origin[inner[moved, 0]]
    there = np.stack([inner[moved, 1] + shift, inner[moved, 2] + shift, inner[moved, 3]], axis=1)
    return np.unique(np.concatenate([rows[rows[:, 0] < 0][:, 1:], there]), axis=0)


def _merged(pieces: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Maximal runs: pieces of one text and period that overlap by a period or more are one."""
    if not len(pieces):
        return pieces
    start, end, period = pieces.T
    text = doc[start]
    order = np.lexsort((-end, start, period, text))
    start, end, period, text = start[order], end[order], period[order], text[order]
    fresh = np.r_[True, (text[1:] != text[:-1]) | (period[1:] != period[:-1])]
    number = np.cumsum(fresh) * (n + 1)
    reach = np.maximum.accumulate(end + number)
    fresh[1:] |= start[1:] + number[1:] > reach[:-1] - period[1:]
    begin = np.flatnonzero(fresh)
    return np.stack([start[begin], np.maximum.reduceat(end, begin), period[begin]], axis=1)


def _smallest(runs: np.ndarray) -> np.ndarray:
    """The runs of a text without those that have a smaller period."""
    keep = np.ones(len(runs), bool)
    order = np.argsort(runs[:, 2], kind="stable")
    for k in order:
        s, e, q = runs[k]
        inside = keep & (runs[:, 2] < q) & (runs[:, 0] <= s) & (runs[:, 1] >= e)
        keep[k] = not (q % runs[inside, 2] == 0).any()
    return runs[keep]


def runs_of(texts: pa.Array, least: int = 24, times: int = 3) -> list[list[tuple[int, int, int]]]:
    """Start, length and period of the runs of each text, by start, then period; words are numbered from 0."""
    words = Words(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    if not len(words.hash):
        return out
    _, ids = np.unique(words.hash, return_inverse=True)
    grammar = Grammar(ids, words.doc, least)
    runs = _merged(_pieces(words, grammar, least, times), words.doc, len(words.hash))
    if not len(runs):
        return out
    text = words.doc[runs[:, 0]]
    edges = np.flatnonzero(np.r_[True, text[1:] != text[:-1], True])
    raw = raw_texts(texts)
    for a, b in zip(edges, edges[1:]):
        number = int(text[a])
        parts = raw[number].split()
        for s, e, q in sorted(map(tuple, (_smallest(runs[a:b]) - [*[words.first[number]] * 2, 0]).tolist()), key=lambda r: (r[0], r[2])):
            # hashes found it; the words decide
            if parts[s : e - q] == parts[s + q : e]:
                out[number].append((s, e - s, q))
    return out


def find_runs(docs: DataFrame, least: int = 24, times: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Runs of each text: the `keep` columns, n_words, runs, strongest and collapsed.

    One row per row of `docs`. `runs`: start, length and period of each run, by start, then period. `strongest`:
    the run of the greatest length / period (ties: smallest start, then period), NULL without runs. `collapsed`: the words
    joined by one space, without those a run holds after its first period. A NULL text has no words, no runs and
    an empty collapsed text. Rows are taken each by itself, so rows that repeat get the same result; columns other than
    text and `keep` are ignored. An empty table gives no rows.
    """
    batch_limits(docs.sparkSession)
    rows = docs.select(*[F.col(c).alias(f"keep_{c}") for c in keep], "text")
    run = "struct<start:bigint,length:bigint,period:bigint>"
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f"keep_{c}" for c in keep]
        struct = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])
        as_run = lambda r: dict(zip(("start", "length", "period"), r))
        for *own, texts in batches(frames, [*names, "text"]):
            sizes, strongest, collapsed = [], [], []
            found = runs_of(texts, least, times)
            for text, runs in zip(raw_texts(texts), found):
                parts = text.split()
                sizes.append(len(parts))
                best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
                strongest.append(best and as_run(best))
                if runs:
                    stay = np.ones(len(parts), bool)
                    for start, length, period in runs:
                        stay[start + period : start + length] = False
                    parts = [parts[i] for i in np.flatnonzero(stay)]
                collapsed.append(b" ".join(parts))
            yield pa.RecordBatch.from_arrays(
                [
                    *own,
                    pa.array(sizes, pa.int64()),
                    pa.array([[as_run(r) for r in runs] for runs in found], pa.list_(struct)),
                    pa.array(strongest, struct),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                [*names, "n_words", "runs", "strongest", "collapsed"],
            )

    found = rows.mapInArrow(find, f"{kept}, n_words bigint, runs array<{run}>, strongest {run}, collapsed string")
    return found.select(*[F.col(f"keep_{c}").alias(c) for c in keep], "n_words", "runs", "strongest", "collapsed")
