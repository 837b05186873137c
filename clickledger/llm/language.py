"""Language identification of whole texts, with spans for mixed ones.

Each word is scored for each language by a naive Bayes model of its letter grams, learned from labelled
documents. The scripts of a word's letters narrow the candidates first: a language that never used a
script in training is out for its words. A Viterbi pass over the words of a text then finds the labels
of highest total score, where each change of language costs a penalty, so a stray word does not break
a span. The language that labels most letters is the text's.

Grams are hashed into a table of fixed size, so the model has the same size whatever was learned from.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_limits, batches, mixed

# fixed values: ranges of code points by script
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
}
OTHER = len(SCRIPTS)
UNKNOWN = "und"
_END = 0x110000  # stands for a word's end where a gram reaches it; 0 stands for its begin


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, its small letter, its script."""
    points = [chr(i) for i in range(0x110000)]
    small = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in points], np.uint32)
    script = np.full(0x110000, OTHER, np.uint8)
    for k, ranges in enumerate(SCRIPTS.values()):
        for low, high in ranges:
            script[low : high + 1] = k
    return np.array([c.isalpha() for c in points]), small, script


@dataclass(frozen=True)
class Settings:
    """`documents`: labelled documents that the model learns from, per language, about. `languages`: the most frequent
    labels that it knows, which bounds its table of slots x languages. `slots`: entries of the hashed table. `switch`: cost of a change of language, in the same natural-log units as the
    word scores. `rare`: share of a language's words below which a script counts as not used."""

    documents: int = 3000
    languages: int = 300
    slots: int = 1 << 15
    switch: float = 12.0
    rare: float = 0.002
    smoothing: float = 0.5


class LetterWords:
    """The words (runs of letters) of several texts and the table places of their letter grams.

    `doc`, `start`, `end`: text number and code points of each word; `slots`: table places at each
    letter, for it alone, with one and with two letters before it, and for a word's last two letters
    (elsewhere the extra place `settings.slots`, which counts nothing); `first`: each word's first row
    in `slots`; `script`: script of each word's first letter.
    """

    def __init__(self, texts: list[str], settings: Settings):
        letter, small, script = _tables()
        codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        cuts = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
        solid = letter[codes]
        at = np.flatnonzero(solid)
        low = small[codes].astype(np.uint64)
        low[~solid] = 0
        begin = at[~solid[at - 1] | (at == 0)] if len(at) else at
        stop = at[~solid[at + 1]] if len(at) else at
        one = np.where(at > 0, low[at - 1], 0)
        two = np.where((at > 1) & (one > 0), low[at - 2], 0)
        here = low[at]

        def place(a, b, c, n: int) -> np.ndarray:
            with np.errstate(over="ignore"):
                return (mixed((a * np.uint64(0x110001) + b) * np.uint64(0x110001) + c + np.uint64(n << 61)) % np.uint64(settings.slots)).astype(np.int64)

        none = np.zeros(len(at), np.uint64)
        ends = place(one, here, np.full(len(at), _END, np.uint64), 3)
        ends[solid[at + 1]] = settings.slots
        self.slots = np.stack([place(none, none, here, 1), place(none, one, here, 2), place(two, one, here, 3), ends])
        self.first = np.searchsorted(at, begin)
        self.script = script[codes[begin]]
        self.doc = np.searchsorted(cuts, begin, "right") - 1
        self.start, self.end = begin - cuts[self.doc], stop + 1 - cuts[self.doc]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_share: np.ndarray  # (slots + 1) x languages; the last row is 0
    used: np.ndarray  # scripts x languages: whether the language uses the script


def training_rows(labelled: DataFrame, settings: Settings) -> DataFrame:
    """About `documents` texts of each of the most frequent languages: those whose ids and texts hash lowest.

    Which share of a language's rows that is follows from its count, so a row is in or out by itself and no language
    gathers in one task. Rows that repeat are one.
    """
    named = labelled.filter("lang IS NOT NULL")
    # at most `languages` rows
    sizes = (
        named.groupBy("lang")
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), "lang")
        .limit(settings.languages)
    )
    place = F.xxhash64("doc_id", "text")
    picked = (
        named.select("lang", "text", place.alias("_place"))
        .join(F.broadcast(sizes), "lang")
        .filter((F.col("_place") / F.lit(2.0**64) + 0.5) * F.col("_n") <= settings.documents)
    )
    return picked.dropDuplicates(["lang", "_place"]).select("lang", "text")


def learn(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Count the grams and scripts of the training documents by language; columns doc_id, text, lang."""
    batch_limits(labelled.sparkSession)

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for langs, texts in batches(frames, ["lang", "text"]):
            rows = list(zip(langs.to_pylist(), texts.to_pylist()))
            for lang in {lang for lang, _ in rows}:
                words = LetterWords([t or "" for name, t in rows if name == lang], settings)
                counts = np.bincount(words.slots.ravel(), minlength=settings.slots + 1)[:-1]
                totals[lang] = totals.get(lang, 0) + counts
                scripts[lang] = scripts.get(lang, 0) + np.bincount(words.script, minlength=OTHER + 1)
        for lang, counts in totals.items():
            both = np.r_[counts, scripts[lang]]
            at = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(both[at])],
                ["lang", "slot", "n"],
            )

    rows = training_rows(labelled, settings).mapInArrow(count, "lang string, slot int, n bigint")
    # languages x (slots + scripts) rows at most
    sums = rows.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["lang"].unique())
    counts = np.zeros((settings.slots + OTHER + 1, max(1, len(languages))))
    if len(languages):
        place = {lang: k for k, lang in enumerate(languages)}
        counts[sums["slot"], sums["lang"].map(place)] = sums["n"]
    grams, scripts = counts[: settings.slots] + settings.smoothing, counts[settings.slots :]
    log_share = np.vstack([np.log(grams / grams.sum(0)), np.zeros(counts.shape[1])]).astype(np.float32)
    used = scripts >= settings.rare * np.maximum(scripts.sum(0), 1)
    return Model(languages, log_share, used)


def word_scores(words: LetterWords, model: Model) -> np.ndarray:
    """Score by language of each word; the best language of a word has 0."""
    if not len(words.first):
        return np.empty((0, len(model.languages)), np.float32)
    letters = sum(model.log_share[places] for places in words.slots)
    scores = np.add.reduceat(letters, words.first, axis=0)
    used = model.used[words.script]
    used |= ~used.any(1, keepdims=True)
    scores = np.where(used, scores, scores.min(1, keepdims=True) - 50)
    return scores - scores.max(1, keepdims=True)


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """Best labels of several texts at once, from their words' scores (words x languages)."""
    order = np.argsort([-len(s) for s in scores], kind="stable")
    longest = [len(scores[k]) for k in order]
    if not longest or not longest[0]:
        return [np.empty(0, np.int64) for _ in scores]
    languages = scores[order[0]].shape[1]
    padded = np.zeros((longest[0], len(scores), languages), np.float32)
    for row, k in enumerate(order):
        padded[: longest[row], row] = scores[k]
    lengths = np.array(longest)
    # texts that still have a word at each step come first
    alive = len(lengths) - np.searchsorted(lengths[::-1], np.arange(longest[0]), "right")
    best = padded[0].copy()
    come = np.zeros((longest[0], len(scores), languages), np.uint8 if languages < 256 else np.uint16)
    own = np.arange(languages, dtype=come.dtype)
    for t in range(1, longest[0]):
        now = best[: alive[t]]
        top = now.argmax(1)
        change = np.take_along_axis(now, top[:, None], 1) - penalty
        switch = change > now
        come[t, : alive[t]] = np.where(switch, top[:, None].astype(come.dtype), own)
        best[: alive[t]] = np.where(switch, change, now) + padded[t, : alive[t]]
    labels = np.zeros((longest[0], len(scores)), np.int64)
    state = best.argmax(1)
    rows = np.arange(len(scores))
    for t in range(longest[0] - 1, -1, -1):
        n = alive[t]
        labels[t, :n] = state[:n]
        state[:n] = come[t, rows[:n], state[:n]]
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
    for row, k in enumerate(order):
        out[k] = labels[: longest[row], row]
    return out


SPANS = "array<struct<start:int,end:int,lang:string>>"


def identify(
    docs: DataFrame, model: Model, settings: Settings = Settings(), spans: bool = True,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Language of each document: the columns of `keep`, lang_pred, score (share of the letters that it
    labels), and with `spans` also spans: stretches of one language, from its first to its last word (code points,
    end exclusive).

    One row per row of `docs`, equal rows included. A text that is NULL or has no letter, or a model
    that learned nothing, gives 'und' with score 0 and no spans. Only text is read; `keep` is passed
    on, not used; other columns are ignored, whatever their names. Texts are labelled whole. An empty table gives no rows.
    """
    batch_limits(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # slots x languages numbers

    def label(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for *kept, texts in batches(frames, [*keep, "_text"]):
            texts = [t if t and model.languages else "" for t in texts.to_pylist()]
            preds, shares = [UNKNOWN] * len(texts), [0.0] * len(texts)
            stretches: list[list[dict]] = [[] for _ in texts]
            for group in _groups(texts):
                words = LetterWords([texts[k] for k in group], settings)
                cuts = np.searchsorted(words.doc, np.arange(len(group) + 1))
                scores = word_scores(words, model)
                labelled = viterbi([scores[a:b] for a, b in zip(cuts, cuts[1:])], settings.switch)
                for k, a, b, labels in zip(group, cuts, cuts[1:], labelled):
                    if a == b:
                        continue
                    start, end = words.start[a:b], words.end[a:b]
                    letters = np.bincount(labels, end - start, len(model.languages))
                    best = int(letters.argmax())
                    preds[k], shares[k] = names[best], float(letters[best] / letters.sum())
                    if spans:
                        first = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1]])
                        last = np.r_[first[1:], len(labels)] - 1
                        stretches[k] = [
                            {"start": int(start[x]), "end": int(end[y]), "lang": names[labels[x]]}
                            for x, y in zip(first, last)
                        ]
            columns = [*kept, pa.array(preds, pa.string()), pa.array(shares, pa.float64())]
            if spans:
                kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
                columns.append(pa.array(stretches, pa.list_(kind)))
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score", "spans"][: len(columns)])

    narrow = docs.select(*keep, F.col("text").alias("_text"))
    own = "".join(f"{name} {kind}, " for name, kind in narrow.dtypes[:-1])
    more = f", spans {SPANS}" if spans else ""
    return narrow.mapInArrow(label, f"{own}lang_pred string, score double{more}")


def _groups(texts: list[str], characters: int = 1_000_000) -> Iterator[list[int]]:
    """Places of the texts from short to long, in groups whose longest text times number is bounded."""
    group: list[int] = []
    for k in sorted(range(len(texts)), key=lambda k: len(texts[k])):
        if group and len(texts[k]) * (len(group) + 1) > characters:
            yield group
            group = []
        group.append(k)
    if group:
        yield group


def held_out(doc_id: Column) -> Column:
    """Documents that the model never learns from: a fifth of all, by the checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from the documents that are not held out."""
    return learn(docs.filter(~held_out(F.col("doc_id"))), settings)
