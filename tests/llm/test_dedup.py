import hashlib
import random
from collections import defaultdict

import numpy as np

from clickledger.llm.components import components
from clickledger.llm.minhash import block_links, bucket_pieces, deal, near_duplicates
from clickledger.llm.substrings import drop_repeats, factors

from .conftest import by_id


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset(map(lambda w: (w,), words))


def smallest_reachable(texts):
    """Components by comparing all pairs that share a word pair."""
    sets, by_pair, parent = {i: shingles(t) for i, t in texts.items()}, defaultdict(set), {i: i for i in texts}
    for i, s in sets.items():
        for g in s:
            by_pair[g].add(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j in {j for g in s for j in by_pair[g] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in texts}


def test_near_duplicates_as_by_all_pairs(documents):
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    got = by_id(near_duplicates(documents), "n_shingles", "component_id", "kept")
    assert got == smallest_reachable(texts)


def test_groups_around_a_text_that_is_not_the_first(spark):
    """Copies that are like the original, less like each other, and some a little too far from it."""
    draw = random.Random(6)
    base = [f"w{k}" for k in range(200)]
    texts = {500: " ".join(base)}
    for i in range(120):
        words = list(base)
        for k in draw.sample(range(200), draw.choice([4, 8, 12, 20, 26])):
            words[k] = f"x{draw.randint(0, 9999)}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = smallest_reachable(texts)
    assert by_id(near_duplicates(docs), "n_shingles", "component_id", "kept") == want
    # blocks so small that pieces of a bucket have to meet
    assert by_id(near_duplicates(docs, block=2000), "n_shingles", "component_id", "kept") == want


def test_a_bucket_with_one_stray_sends_each_text_once(spark):
    """1,000 members in 50 pieces: only the stray goes to all of them."""
    rows = [(7, i, 100, 0) for i in range(1000)] + [(7, 5000, 100, 5000)] + [(8, i, 100, 0) for i in range(40)]
    placed = spark.createDataFrame(rows, "band long, doc_id long, n_shingles long, component long")
    split = bucket_pieces(placed, 2000)
    assert [tuple(r) for r in split.collect()] == [(7, 0, 51, 1)]
    sent = deal(placed, split).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in sent} == {i: 1 for i in range(1000)} | {5000: 52}


def test_block_links_join_groups_once():
    sets = [np.arange(10), np.arange(10), np.arange(1, 11), np.arange(50, 60)]
    assert len(block_links(sets, [1, 2, 3, 4], [0] * 4, 80)) == 2
    assert block_links(sets, [1, 1, 1, 4], [0] * 4, 80) == []
    assert block_links(sets[:2], [1, 2], [0, 1], 80) != [] and block_links(sets[:3], [1, 2, 2], [0, 0, 1], 90) == []


def test_awkward_near_duplicates(awkward, nothing):
    rows = near_duplicates(awkward)
    assert rows.count() == awkward.count()
    got = by_id(rows.filter("doc_id IS NOT NULL"), "n_shingles", "component_id", "kept")
    assert got[1] == (3, 1, True) and got[2] == got[2][:0] + (0, 2, True) and got[4] == (0, 4, True)
    assert got[6] == (6, 5, False)  # the long texts differ in one pair of six
    assert [tuple(r) for r in rows.filter("doc_id IS NULL").select("component_id", "kept").collect()] == [(None, True)] * 2
    assert near_duplicates(nothing).count() == 0


def test_components_of_a_long_chain(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(900, 901), (901, 900), (950, 950)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {900: 900, 901: 900}


def without_repeats(texts, span=13):
    seen, out = {}, {}
    for i in sorted(texts):
        words = (texts[i] or "").encode().split()
        windows = [b" ".join(words[p : p + span]) for p in range(len(words) - span + 1)]
        gone = {q for p, w in enumerate(windows) if seen.get(w, i) < i for q in range(p, p + span)}
        for w in windows:
            seen.setdefault(w, i)
        kept = b" ".join(w for q, w in enumerate(words) if q not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_as_by_all_windows(documents):
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    assert by_id(drop_repeats(documents), "n_words", "n_removed", "kept_sha256") == without_repeats(texts)


def test_windows_across_factor_boundaries(spark):
    draw = random.Random(8)
    for _ in range(3):
        texts = {}
        for i in range(40):  # few words, so that windows repeat in pieces of several documents
            texts[i] = " ".join(f"{draw.choice('abc')}" for _ in range(draw.randint(0, 60)))
        texts[41] = texts[3] + " " + texts[7] + " " + texts[3][5:]
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = by_id(drop_repeats(docs, span=6, gram=3), "n_words", "n_removed", "kept_sha256")
        assert got == without_repeats(texts, 6)


def greedy_factors(texts, span):
    """At each place with an earlier window the longest match in the documents that hold first places of the text's windows.

    Within a document the first place of a window counts."""
    words = {i: (t or "").split() for i, t in texts.items()}
    first, inside = {}, {i: {} for i in words}
    for i in sorted(words):
        for p in range(len(words[i]) - span + 1):
            first.setdefault(tuple(words[i][p : p + span]), (i, p))
            inside[i].setdefault(tuple(words[i][p : p + span]), p)
    out = {}
    for i, own in words.items():
        windows = [tuple(own[p : p + span]) for p in range(len(own) - span + 1)]
        references = sorted({first[w][0] for w in windows if first[w][0] < i})
        found, p = [], 0
        while p < len(windows):
            if first[windows[p]][0] == i:
                p += 1
                continue
            best = None
            for d in references:
                for q in range(len(words[d]) - span + 1):
                    n = 0
                    while p + n < len(windows) and inside[d].get(windows[p + n]) == q + n:
                        n += 1
                    if n and (best is None or n + span - 1 > best[1]):
                        best = (p, n + span - 1, d, q)
            found.append(best)
            # windows that end behind the factor are looked up, too
            p += best[1] - span + 1
        out[i] = found
    return out


def parsed(docs, **how):
    return {r["doc_id"]: [tuple(f) for f in r["factors"]] for r in drop_repeats(docs, **how).collect()}


def test_factors_name_their_source(spark):
    one = " ".join(f"a{k}" for k in range(30))
    two = " ".join(f"b{k}" for k in range(20))
    docs = spark.createDataFrame([(1, one), (2, two), (3, f"x y {one} z {two} end")], "doc_id long, text string")
    row = drop_repeats(docs).filter("doc_id = 3").first()
    assert [tuple(f) for f in row["factors"]] == [(2, 30, 1, 0), (33, 20, 2, 0)]
    assert row["kept_text"] == "x y z end" and row["n_removed"] == 50
    assert factors([], {}, 13) == []


def test_a_passage_whose_middle_is_older_is_one_factor(spark):
    words = [f"w{k}" for k in range(100)]
    texts = {1: " ".join(["x", *words[30:62], "y"]), 5: " ".join(["p", "q", *words, "r"]), 9: " ".join([*words, "end"])}
    assert parsed(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))[9] == [(0, 100, 5, 2)]


def test_factors_as_by_a_greedy_search(spark):
    draw = random.Random(17)
    for kinds in ("ab", "abc", "abcdefgh"):
        # pieces of few words, copied around, with repeats inside a document
        pieces = [" ".join(draw.choice(kinds) for _ in range(draw.randint(5, 25))) for _ in range(12)]
        texts = {i: " ".join(draw.choice(pieces) for _ in range(draw.randint(0, 6))) for i in range(30)}
        texts[31] = f"{texts[3]} {texts[7]} {texts[3]}"
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got, want = parsed(docs, span=6, gram=3), greedy_factors(texts, 6)
        for i, text in texts.items():
            # a copy of a whole earlier text is one factor of the first such
            same = [j for j in texts if j < i and texts[j] == text]
            if same and len(text.split()) >= 6:
                assert got[i] == [(0, len(text.split()), min(same), 0)]
            else:
                assert got[i] == want[i], (i, text)


def test_texts_of_one_id_are_judged_by_themselves(spark):
    words = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(words[:20])), (2, " ".join(words[5:40])), (2, "other " + " ".join(words[:20])), (2, " ".join(words[5:40]))]
    rows += [(3, " ".join(words[15:40]))]
    got = sorted(
        (r["doc_id"], r["n_words"], r["n_removed"]) for r in drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    )
    assert got == [(1, 20, 0), (2, 21, 20), (2, 35, 15), (2, 35, 15), (3, 25, 25)]


def test_awkward_repeats(awkward, nothing):
    rows = drop_repeats(awkward)
    assert rows.count() == awkward.count()
    got = by_id(rows.filter("doc_id IS NOT NULL"), "n_words", "n_removed")
    assert got[1] == (4, 0) and got[2] == got[3] == got[4] == (0, 0)
    assert got[5] == (100_000, 0) and got[6] == (100_001, 100_000)
    assert drop_repeats(nothing).count() == 0


def test_pipeline_keeps_texts_that_are_near_by_pairs_only(spark):
    """10 of 400 words replaced: similarity 0.91 by word pairs, under 0.8 by five words; with 3 replaced it is 0.93."""
    from corpus_pipeline import near_dedup

    base = [f"w{k}" for k in range(400)]
    lightly, revised = list(base), list(base)
    for k in range(3):
        lightly[100 * k + 50] = f"x{k}"
    for k in range(10):
        revised[40 * k + 20] = f"y{k}"
    texts = {1: base, 2: lightly, 3: revised, 4: ["three", "short", "words"], 5: ["Three", "short", "words"], 6: ["short", "words"]}
    rows = [(i, " ".join(w), "en", "a", 0) for i, w in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in near_dedup(spark, docs, "").collect()} == {1, 3, 4, 6}
    assert {r["doc_id"] for r in near_duplicates(docs).filter("kept").collect()} == {1, 4, 6}
