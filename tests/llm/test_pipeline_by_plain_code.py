"""The pipeline's stages one after the other, each compared with plain code over what it was given."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import corpus_pipeline
from clickledger.llm.language import identify, train
from clickledger.llm.packing import Shape, best_bounds

from .test_scans import plain_personal


def words_of(text):
    return (text or "").encode().split()


def near_groups(texts, width=5):
    """Smallest id of each id's component: sets of runs of words at a similarity of 0.8 or more, all pairs that share a run."""
    sets, by_run, parent = {}, defaultdict(set), {i: i for i in texts}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        runs = [tuple(words[k : k + width]) for k in range(max(len(words) - width + 1, 1))] if words else []
        sets[i] = set(runs)
        for run in runs:
            by_run[run].add(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j in {j for run in s for j in by_run[run] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in texts}


def plain_copies(docs):
    """Copies of each document, drawn along its source from short to long documents."""
    sizes = {d: len(words_of(r["text"])) for d, r in docs.items()}
    names = sorted({r["source"] for r in docs.values()}, key=lambda s: (s is None, s or ""))
    weight = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(names)}
    held = {s: sum(sizes[d] for d, r in docs.items() if r["source"] == s) for s in names}
    left, open_, target = 1.5 * sum(held.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        stopped = {s for s in open_ if level * weight[s] > 2 * held[s]}
        for s in stopped or open_:
            target[s] = 2.0 * held[s] if stopped else level * weight[s]
        left -= sum(2 * held[s] for s in stopped)
        open_ = open_ - stopped if stopped else set()
    out = {}
    for s in names:
        rate = target[s] / held[s] if held[s] else 0.0
        start = int(hashlib.md5(f"mix/{'n' if s is None else 's' + s}".encode()).hexdigest()[:12], 16) / 2**48
        mine = [d for d, r in docs.items() if r["source"] == s]
        mine.sort(key=lambda d: (sizes[d], hashlib.md5(f"mix:{d}".encode()).hexdigest()))
        for nth, d in enumerate(mine, 1):
            crossed = math.floor(nth * rate + start) - math.floor((nth - 1) * rate + start)
            out[d] = min(crossed, math.ceil(rate))
    return out


def collected(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_each_stage_as_by_plain_code(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    given = collected(documents)
    assert len(given) == documents.count()

    # language: what has no letter goes, the rest gets the label of the operator and stays as it is
    told = stages["language_id"](spark, documents, "").persist()
    got, labels = collected(told), collected(identify(documents, train(documents)))
    assert set(got) == {d for d, r in given.items() if any(c.isalpha() for c in r["text"] or "")}
    assert all(r["lang"] == labels[d]["lang_pred"] and r["text"] == given[d]["text"] for d, r in got.items())
    assert sum(r["lang"] == given[d]["lang"] for d, r in got.items()) >= 0.95 * len(got)

    # near duplicates: the smallest id of each group stays
    single = stages["near_dedup"](spark, told, "").persist()
    groups, kept = near_groups({d: r["text"] for d, r in got.items()}), collected(single)
    assert set(kept) == {d for d, g in groups.items() if d == g} and len(kept) < len(got)
    assert all(tuple(r) == tuple(got[d]) for d, r in kept.items())

    # personal data: what is plain is masked, and nothing but the masked stretches changes
    clean = stages["personal_data"](spark, single, "").persist()
    masked = collected(clean)
    assert set(masked) == set(kept)
    for d, r in masked.items():
        text, at, gaps = kept[d]["text"], 0, []
        pieces = re.split(r"<(?:EMAIL|IP|CARD|PHONE)>", r["text"])
        for k, piece in enumerate(pieces):
            begin = text.index(piece, at) if k + 1 < len(pieces) else len(text) - len(piece)
            assert begin >= at and text[begin : begin + len(piece)] == piece and (k > 0 or begin == 0)
            gaps.append((at, begin))
            at = begin + len(piece)
        spans = plain_personal(text)
        assert all(any(a <= s[0] and s[2] <= b for a, b in gaps) for s in spans)
        assert r["n_chars"] == len(r["text"]) and (r["lang"], r["source"]) == (kept[d]["lang"], kept[d]["source"])

    # mix: each document as often as its stretch of the sum crosses whole numbers
    mixed = stages["mix"](spark, clean, "").persist()
    rows = mixed.collect()
    want = Counter({d: n for d, n in plain_copies(masked).items() if n})
    assert Counter(r["doc_id"] for r in rows) == want and all(tuple(r) == tuple(masked[r["doc_id"]]) for r in rows)

    # packing: all words once, the bounds with the least padding, batches in the order of a digest
    shape, packed = Shape(), stages["packing"](spark, mixed, "").collect()
    pieces = Counter()
    for r in rows:
        words = words_of(r["text"])
        for k in range(max(-(-len(words) // shape.longest), 1)):
            pieces[r["doc_id"], k, b" ".join(words[k * shape.longest : (k + 1) * shape.longest]).decode()] += 1
    assert Counter((r["doc_id"], r["piece"], r["text"]) for r in packed) == pieces
    histogram = Counter(r["n_words"] for r in packed if r["n_words"])
    bounds, by_bound = best_bounds(histogram, shape.buckets), defaultdict(list)
    for r in packed:
        assert r["n_words"] == len(words_of(r["text"]))
        assert r["bound"] == next((b for b in bounds if 0 < r["n_words"] <= b), None)
        if r["bound"]:
            place = hashlib.md5(f"{r['doc_id']}:{r['piece']}".encode()).hexdigest()
            by_bound[r["bound"]].append((r["batch"], r["slot"], place))
    for bound, held in by_bound.items():
        held.sort()
        most = max(shape.budget // bound, 1)
        assert [(b, s) for b, s, _ in held] == [divmod(k, most) for k in range(len(held))]
        assert [p for *_, p in held] == sorted(p for *_, p in held)

    # run() is these stages over the table
    from .conftest import FOLDER

    whole = corpus_pipeline.run(spark, FOLDER).collect()
    key = ("doc_id", "piece", "n_words", "bound", "batch", "text")
    assert Counter(tuple(r[k] for k in key[:4]) for r in whole) == Counter(tuple(r[k] for k in key[:4]) for r in packed)
    assert Counter((r["doc_id"], r["piece"], r["text"]) for r in whole) == pieces
