"""Substring dedup: each document is parsed against the documents before it (relative Lempel-Ziv).

Windows of `span` words are indexed in blocks: a window belongs to the block of its smallest gram of `gram` words
(its anchor), so equal windows always meet in one block, whatever documents they are in, and each block is one key of a
shuffle. The index holds the first place of each window that two documents share.

The reference of a document is all documents that hold the first place of one of its windows. It is parsed from left to
right: at a window with an earlier occurrence the longest match in any of the reference documents becomes a factor, and
the parse goes on behind it. A document's places are indexed by window: of a window that it repeats, the first place counts. Whether
texts go on being equal is told by the index, too: two windows are equal where they have the
same first place of all. So a reference document is represented by the pieces of it that have first places elsewhere, which are
few, instead of by its text. At a factor's end the windows that begin in it and end behind it are looked up as well, so a
window that begins in one factor and ends in the next is found too. Each factor is at least `span`
words long and all its words are duplicates.

Only blocks that two documents share can hold factors. So anchors go first (about one per five words),
and the windows of shared anchors follow; copies of whole texts are known from two hashes of all words.
Groups are joined to their pre-aggregated first place, so a passage in a third of all documents is a
join key with many rows on one side only, which the engine splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, batch_limits, batches, mixed, sliding_min, step

_ANCHOR, _WINDOW, _CHECK = 0xC2B2AE3D27D4EB4F, 0x9E3779B97F4A7C55, 0xBF58476D1CE4E5B9


def _windows(words: Words, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows, and the windows' anchors (even numbers)."""
    n = len(words.hash) - span + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    anchors = sliding_min(words.grams(gram, _ANCHOR), span - gram + 1)[:n]
    at = np.flatnonzero(words.doc[:n] == words.doc[span - 1 :])
    return at, anchors[at] & ~np.uint64(1)


def _whole(words: Words, salt: int) -> np.ndarray:
    """Hash of all words of each text (an odd number); 0 for a text without words."""
    place = (np.arange(len(words.hash)) - words.first[words.doc]).astype(np.uint64)
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum(mixed(words.hash ^ np.uint64(salt) ^ mixed(place + np.uint64(salt + 1))))]
        total = mixed(sums[words.first[1:]] - sums[words.first[:-1]]) | np.uint64(1)
    return np.where(np.diff(words.first) > 0, total, np.uint64(0))


def texts_of(docs: DataFrame) -> DataFrame:
    """Rows of doc_id, part and text: rows of one doc_id with the same text have the same part (mostly 0)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    distinct = rows.select("doc_id", digest.alias("_digest")).groupBy("doc_id", "_digest").agg(F.count(F.lit(1)).alias("n"))
    several = (
        distinct.groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("texts"), F.min("_digest").alias("_least"))
        .filter("doc_id IS NOT NULL AND texts > 1")
    )
    # the texts of an id are numbered by their digests, the least is 0
    numbered = (
        distinct.join(several, "doc_id")
        .filter("_digest > _least")
        .select("doc_id", "_digest", F.row_number().over(Window.partitionBy("doc_id").orderBy("_digest")).alias("_part"))
    )
    return (
        rows.withColumn("_digest", digest)
        .join(numbered, ["doc_id", "_digest"], "left")
        .select("doc_id", F.coalesce("_part", F.lit(0)).alias("part"), "text")
    )


TEXT = ["doc_id", "part"]


def anchors(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """Rows of a text, whole (hash of it), key and check: an anchor of its windows and 0, or both hashes of the text."""

    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, parts, texts in batches(frames, [*TEXT, "text"]):
            words = Words(texts)
            at, keys = _windows(words, span, gram)
            doc = words.doc[at]
            new = np.r_[True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])][: len(keys)]
            long = np.flatnonzero(np.diff(words.first) >= span)
            whole, check = _whole(words, 0), _whole(words, 77)
            doc, keys = np.r_[doc[new], long], np.r_[keys[new], whole[long]]
            checks = np.r_[np.zeros(int(new.sum()), np.uint64), check[long]]
            order = np.argsort(doc, kind="stable")
            offsets = pa.array(np.r_[0, np.cumsum(np.bincount(doc, minlength=len(ids)))].astype(np.int32))
            pairs = pa.StructArray.from_arrays(
                [pa.array(keys[order].view(np.int64)), pa.array(checks[order].view(np.int64))], ["key", "check"]
            )
            lists = pa.ListArray.from_arrays(offsets, pairs)
            yield pa.RecordBatch.from_arrays(
                [ids, parts, pa.array(whole.view(np.int64)), lists], [*TEXT, "whole", "keys"]
            )

    found = docs.mapInArrow(find, "doc_id bigint, part int, whole bigint, keys array<struct<key:bigint,check:bigint>>")
    return found.select(*TEXT, "whole", F.inline("keys"))


def shared_keys(keys: DataFrame) -> DataFrame:
    """Per text the anchors that it shares with other texts, and the first document with its text.

    Anchors that only copies of one text share are left out; the copies are known as such.
    """
    # a whole text's hash is odd
    whole = F.col("key").bitwiseAND(1) == 1
    first = (
        keys.groupBy("key", "check")
        .agg(
            F.min("doc_id").alias("first"),
            F.max("doc_id").alias("last"),
            F.min("whole").alias("low"),
            F.max("whole").alias("high"),
        )
        .filter(F.when(whole, F.col("first") < F.col("last")).otherwise(F.col("low") < F.col("high")))
        .select("key", "check", F.when(whole, F.col("first")).alias("first"))
    )
    return (
        keys.select(*TEXT, "key", "check").join(first, ["key", "check"])
        .groupBy(*TEXT)
        .agg(
            F.collect_set(F.when(~whole, F.col("key"))).alias("keys"),
            F.min(F.when(whole, F.col("first"))).alias("copy_of"),
        )
    )


def candidate_windows(docs: DataFrame, shared: DataFrame, span: int, gram: int) -> DataFrame:
    """Windows of shared anchors: the text, the window's places in it, and its hash h1, h2.

    Copies of a whole earlier text are left out: their windows add no first place.
    """
    wanted = shared.filter("copy_of IS NULL OR copy_of = doc_id").select(*TEXT, "keys")
    texts = docs.join(wanted, TEXT).select(*TEXT, "text", "keys")

    def find(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, parts, texts, keys in batches(frames, [*TEXT, "text", "keys"]):
            words = Words(texts)
            at, own = _windows(words, span, gram)
            known = np.asarray(keys.flatten()).view(np.uint64)
            doc = words.doc[at]
            # an anchor counts for the text that lists it: both go into one number
            list_doc = np.repeat(np.arange(len(ids)), np.asarray(keys.value_lengths()))
            tag = mixed(np.arange(len(ids), dtype=np.uint64) + np.uint64(1))
            hit = np.isin(own ^ tag[doc], known ^ tag[list_doc])
            at, doc = at[hit], doc[hit]
            one, two = words.grams(span, _WINDOW)[at], words.grams(span, _CHECK)[at]
            # a window that a text repeats is one row with all its places
            order = np.lexsort((at, one, doc))
            at, doc, one, two = at[order], doc[order], one[order], two[order]
            new = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (doc[1:] != doc[:-1])][: len(one)])
            places = pa.ListArray.from_arrays(
                pa.array(np.r_[new, len(at)].astype(np.int32)), pa.array((at - words.first[doc]).astype(np.int32))
            )
            pick = pa.array(doc[new])
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pick),
                    parts.take(pick),
                    places,
                    pa.array(one[new].view(np.int64)),
                    pa.array(two[new].view(np.int64)),
                ],
                [*TEXT, "places", "h1", "h2"],
            )

    return texts.mapInArrow(find, "doc_id bigint, part int, places array<int>, h1 bigint, h2 bigint")


PIECES = "array<struct<start:int,windows:int,ref_doc:bigint,ref_part:int,ref_start:int>>"
_PIECE = ["start", "windows", "ref_doc", "ref_part", "ref_start"]


def known_pieces(windows: DataFrame) -> DataFrame:
    """Per text its pieces whose windows have their first places one after the other in an earlier document: sorted.

    `pieces` holds all places of the text's windows, `firsts` only the first place of each.
    """
    first = (
        windows.groupBy("h1", "h2")
        .agg(F.min(F.struct(*TEXT, F.get("places", F.lit(0)).alias("pos"))).alias("ref"), F.max("doc_id").alias("last"))
        .filter("ref.doc_id < last")
        .drop("last")
    )
    found = windows.join(first, ["h1", "h2"]).filter("doc_id > ref.doc_id")
    listed = found.groupBy(*TEXT).agg(
        F.collect_list(F.struct("places", "ref.doc_id", "ref.part", "ref.pos")).alias("windows")
    )

    def column(rows: list[np.ndarray]) -> pa.ListArray:
        flat = np.concatenate([np.zeros((0, 5), np.int64), *rows])
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
        struct = pa.StructArray.from_arrays([pa.array(flat[:, i], t) for i, t in enumerate(types)], _PIECE)
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), struct)

    def join(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, parts, lists in batches(frames, [*TEXT, "windows"]):
            every, firsts = [], []
            for k in range(len(ids)):
                entries = lists[k].values
                places = entries.field("places")
                counts = np.asarray(places.value_lengths())
                at = np.asarray(places.flatten()).astype(np.int64)
                refs = [np.asarray(entries.field(i)).astype(np.int64) for i in range(1, 4)]
                begin = np.cumsum(counts) - counts
                # rows that repeat bring their windows again
                whole = np.stack([at, *[np.repeat(r, counts) for r in refs]], axis=1)
                every.append(pieces_of(np.unique(whole, axis=0)))
                firsts.append(pieces_of(np.unique(np.stack([at[begin], *refs], axis=1), axis=0)))
            yield pa.RecordBatch.from_arrays([ids, parts, column(every), column(firsts)], [*TEXT, "pieces", "firsts"])

    return listed.mapInArrow(join, f"doc_id bigint, part int, pieces {PIECES}, firsts {PIECES}")


def pieces_of(rows: np.ndarray) -> np.ndarray:
    """Rows of start, windows, ref_doc, ref_part, ref_start, from sorted rows of place, ref_doc, ref_part, ref_pos."""
    if not len(rows):
        return np.zeros((0, 5), np.int64)
    pos, ref, part, at = rows.T
    goes_on = (np.diff(pos) == 1) & (ref[1:] == ref[:-1]) & (part[1:] == part[:-1]) & (np.diff(at) == 1)
    begin = np.flatnonzero(np.r_[True, ~goes_on])
    return np.stack([pos[begin], np.diff(np.r_[begin, len(pos)]), ref[begin], part[begin], at[begin]], axis=1)


def reference_pieces(pieces: DataFrame) -> DataFrame:
    """Per text the pieces of its reference documents: structs of ref_doc, ref_part and pieces."""
    refs = (
        pieces.select(*TEXT, F.explode("pieces").alias("p"))
        .select(*TEXT, F.col("p.ref_doc").alias("ref_doc"), F.col("p.ref_part").alias("ref_part"))
        .distinct()
    )
    theirs = pieces.select(
        F.col("doc_id").alias("ref_doc"), F.col("part").alias("ref_part"), F.col("firsts").alias("their_pieces")
    )
    return (
        refs.join(theirs, ["ref_doc", "ref_part"])
        .groupBy(*TEXT)
        .agg(F.collect_list(F.struct("ref_doc", "ref_part", "their_pieces")).alias("references"))
    )


def factors(
    own: list[tuple], references: dict[tuple[int, int], list[tuple]], span: int
) -> list[tuple[int, int, int, int]]:
    """Greedy factors (start, words, ref_doc, ref_start): at each place the longest match in any reference document.

    `own`: pieces (start, windows, ref_doc, ref_part, ref_start) of a text; `references`: pieces of its reference documents. Ties go
    to the smallest document, then to its first place.
    """
    # windows that equal those of a document some way on, as half-open stretches by document and distance
    stretches: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    by_ref: dict[tuple[int, int], list[tuple[tuple[int, int], tuple]]] = {}
    for name, pieces in references.items():
        for piece in pieces:
            by_ref.setdefault(piece[2:4], []).append((name, piece))
    for start, n, ref, part, at in own:
        stretches.setdefault((ref, part, at - start), []).append((start, start + n))
        for (doc, other), (theirs, m, _, _, there) in by_ref.get((ref, part), ()):
            low, high = max(at, there), min(at + n, there + m)
            if low < high:
                way = (theirs - there) - (start - at)
                stretches.setdefault((doc, other, way), []).append((start + low - at, start + high - at))
    matches = []
    for (doc, part, way), found in stretches.items():
        found.sort()
        low, high = found[0]
        for a, b in found[1:]:
            if a > high:
                matches.append((low, high, doc, part, low + way))
                low, high = a, b
            else:
                high = max(high, b)
        matches.append((low, high, doc, part, low + way))
    matches.sort()
    out, upto, k, best = [], -1, 0, []
    for start, n, *_ in sorted(own):
        p = max(start, upto)
        while p < start + n:
            while k < len(matches) and matches[k][0] <= p:
                best.append(matches[k])
                k += 1
            best = [m for m in best if m[1] > p]
            low, high, doc, part, at = min(best, key=lambda m: (-m[1], m[2], m[4] - m[0], m[3]))
            out.append((p, high - p + span - 1, doc, at + p - low))
            p = upto = high
    return out


FACTORS = "array<struct<start:int,words:int,ref_doc:bigint,ref_start:int>>"


def drop_repeats(docs: DataFrame, span: int = 13, gram: int = 5) -> DataFrame:
    """Documents without the words that an earlier document has in a window of `span` words.

    One row per row of `docs`: doc_id, n_words, n_removed, factors (start, words, ref_doc, ref_start,
    all in words), kept_text (the words left, joined by one space) and kept_sha256. Words are judged on
    the input, not on what is left of it.

    doc_id must be an integer. Other columns than doc_id and text are ignored, whatever their names. A
    NULL text is empty; a text shorter than `span` words loses nothing; texts are read whole. Rows of
    one doc_id never count against each other; with different texts each is judged by its own. A row without doc_id loses
    nothing and takes nothing from others. An empty table gives no rows.
    """
    batch_limits(docs.sparkSession)
    rows = texts_of(docs)
    known = rows.filter("doc_id IS NOT NULL")
    shared = step(shared_keys(anchors(known, span, gram)), "repeats-keys")
    windows = step(candidate_windows(known, shared, span, gram), "repeats-windows")
    pieces = step(known_pieces(windows), "repeats-pieces")
    copies = shared.filter("copy_of < doc_id").select(*TEXT, "copy_of")
    met = pieces.drop("firsts").join(reference_pieces(pieces), TEXT, "left").join(copies, TEXT, "full")
    met = rows.join(met, TEXT, "left")

    def pieces_in(column: pa.ListScalar) -> list[tuple]:
        return list(zip(*(column.values.field(i).to_pylist() for i in range(5))))

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, pieces, references, copied in batches(frames, ["doc_id", "text", "pieces", "references", "copy_of"]):
            out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "factors", "kept_text", "kept_sha256")}
            for text, own, theirs, copy in zip(texts, pieces, references, copied.to_pylist()):
                words = (text.as_py() or "").encode().split()
                parsed = []
                if copy is not None:
                    parsed = [(0, len(words), copy, 0)]
                elif own.is_valid:
                    known = {}
                    if theirs.is_valid:
                        entries = theirs.values
                        for k in range(len(entries)):
                            entry = entries[k]
                            known[entry["ref_doc"].as_py(), entry["ref_part"].as_py()] = pieces_in(entry["their_pieces"])
                    parsed = factors(pieces_in(own), known, span)
                kept, upto = [], 0
                for start, n, _, _ in parsed:
                    kept += words[upto:start]
                    upto = max(upto, start + n)
                kept += words[upto:]
                left = b" ".join(kept)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["factors"].append(
                    [dict(zip(("start", "words", "ref_doc", "ref_start"), f)) for f in parsed]
                )
                out["kept_text"].append(left.decode())
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
            kinds = pa.list_(
                pa.struct([("start", pa.int32()), ("words", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())])
            )
            types = [pa.int64(), pa.int64(), kinds, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [ids, *[pa.array(v, t) for v, t in zip(out.values(), types)]], ["doc_id", *out]
            )

    return met.select("doc_id", "text", "pieces", "references", "copy_of").mapInArrow(
        cut,
        f"doc_id bigint, n_words bigint, n_removed bigint, factors {FACTORS}, kept_text string, kept_sha256 string",
    )
