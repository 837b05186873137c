import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from clickledger.llm import language
from clickledger.llm.neighbours import Forest, fit_tree, leaves_for, nearest, place, visits
from clickledger.llm.quality import js_distance, judge

from .conftest import FOLDER, by_id


def counted(text):
    words = [w.decode() for w in (text or "").encode().split()]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {q for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for q in range(i, i + 5)}
    lines = Counter(x for x in (text or "").split("\n") if x.encode().split())
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        sum(c - 1 for c in lines.values()),
        len(again),
        n < 10 or 100 * len(again) > 20 * n,
    )


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_as_by_plain_code(documents):
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    assert by_id(judge(documents), *COLUMNS) == {i: counted(t) for i, t in texts.items()}


def test_awkward_counts(awkward, nothing):
    rows = judge(awkward)
    assert rows.count() == awkward.count()
    texts = {r["doc_id"]: r["text"] for r in awkward.filter("doc_id IS NOT NULL").collect()}
    assert by_id(rows.filter("doc_id IS NOT NULL"), *COLUMNS) == {i: counted(t) for i, t in texts.items()}
    assert rows.filter("kept IS NULL").count() == 0
    assert judge(nothing).count() == 0


def test_distance(spark):
    row = spark.range(1).select(
        js_distance(F.array(F.lit(0.5), F.lit(0.5), F.lit(0.0)), F.array(F.lit(0.5), F.lit(0.25), F.lit(0.25))).alias("d"),
        js_distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))).alias("far"),
        js_distance(F.array(F.lit(0.3), F.lit(0.7)), F.array(F.lit(0.3), F.lit(0.7))).alias("same"),
    ).first()
    p, q = [0.5, 0.5, 0], [0.5, 0.25, 0.25]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    want = sum(a * math.log2(a / c) for x in (p, q) for a, c in zip(x, m) if a) / 2
    assert abs(row["d"] - math.sqrt(want)) < 1e-12 and row["far"] == 1.0 and row["same"] == 0.0


def test_odd_texts_go_and_plain_ones_stay(spark):
    draw = random.Random(9)
    words = "the of and to a in is that for with was on house tree river walks small green old stone".split()

    def prose():
        return " ".join(draw.choice(words) for _ in range(300)) + "."

    rows = [(i, prose(), "en") for i in range(60)]
    rows += [(100, " ".join(w.upper() + "!!" for w in prose().split()), "en"), (101, "lorem ipsum " + " ".join(f"q{draw.random()}" for _ in range(300)), "en")]
    got = by_id(judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")), "kept")
    assert all(got[i] == (True,) for i in range(60)) and got[100] == got[101] == (False,)


def test_held_out_accuracy(documents):
    found = language.identify(documents, language.train(documents))
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").filter(language.held_out(F.col("doc_id"))).collect()
    assert rows and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_mixed_text_gives_spans(spark):
    en = "the house of the king was on that hill and the people went to it with joy "
    de = "der König und die Leute von der Stadt sind nicht in das Haus mit ihm gegangen "
    el = "το σπίτι του βασιλιά ήταν στον λόφο και οι άνθρωποι πήγαν "
    rows = [(i, t * 3, lang) for i, (t, lang) in enumerate([(en, "en"), (de, "de"), (el, "el")] * 4)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["de", "el", "en"]
    text = en + de + "λόφο και οι άνθρωποι"
    row = language.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [(s["lang"], text[s["start"] : s["end"]]) for s in row["spans"]] == [
        ("en", en.strip()),
        ("de", de.strip()),
        ("el", "λόφο και οι άνθρωποι"),
    ]


def test_viterbi_as_by_all_paths():
    import itertools

    draw = np.random.default_rng(3)
    texts = [draw.normal(size=(n, 3)).astype(np.float32) * 3 for n in (5, 0, 1, 6)]
    for scores, labels in zip(texts, language.viterbi(texts, 2.0)):
        def value(path):
            return sum(s[k] for s, k in zip(scores, path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

        best = max(map(value, itertools.product(range(3), repeat=len(scores))))
        assert len(labels) == len(scores) and abs(value(labels) - best) < 1e-4


def test_awkward_languages(awkward, nothing):
    model = language.train(awkward)
    rows = language.identify(awkward, model)
    assert rows.count() == awkward.count()
    got = by_id(rows.filter("doc_id IS NOT NULL"), "lang_pred", "score")
    assert got[2] == got[3] == got[4] == ("und", 0.0)
    assert set(model.languages) <= {"de", "en"} and got[5][0] in model.languages
    none = language.train(nothing)
    assert none.languages == [] and {r["lang_pred"] for r in language.identify(awkward, none).collect()} == {"und"}
    assert language.identify(nothing, model).count() == 0


def test_recall_against_all_rows(spark):
    rows = spark.read.parquet(f"{FOLDER.replace('0.001', '0.1')}/embeddings.parquet")
    ids, vectors = zip(*[(r["vec_id"], r["embedding"]) for r in rows.collect()])
    ids, m = np.array(ids), np.array(vectors, np.float64)
    got = {}
    for r in nearest(rows, F.col("vec_id") % 50 == 0, how=Forest(candidates=2500)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for i in np.flatnonzero(ids % 50 == 0):
        cosines = m @ m[i] / (np.linalg.norm(m, axis=1) * np.linalg.norm(m[i]))
        cosines[i] = -2
        best = ids[np.lexsort((ids, -cosines))[:5]]
        answer = sorted(got[ids[i]])
        assert [r for r, _, _ in answer] == [1, 2, 3, 4, 5]
        assert all(abs(cosines[np.flatnonzero(ids == v)[0]] - s) < 1e-12 for _, v, s in answer)
        hits += len({v for _, v, _ in answer} & set(best.tolist()))
    assert hits >= 0.9 * 5 * len(got)


def test_equal_zero_and_broken_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 120)] + [(200, [2.0, -1.0]), (200, [2.0, -1.0]), (250, [0.0, 0.0]), (251, None),
            (252, [1.0, None]), (253, [float("nan"), 1.0]), (254, [float("inf"), 1.0]), (None, [1.0, 1.0]), (255, [1e-200, -3e-200])]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, point string, digest string")
    got = {}
    for r in nearest(table, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got[0] == [1, 2, 3, 4, 5] and got[50] == [0, 1, 2, 3, 4] and set(got) == {0, 50, 100, 200}
    assert len(set(got[200])) == 5
    assert nearest(table.filter("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_candidates_do_not_drop_where_leaves_are_halved():
    draw = np.random.default_rng(1)
    points = draw.normal(size=(4001, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    for size, levels in ((2000, 0), (2001, 1), (4000, 1), (4001, 2)):
        trees = [fit_tree(points[:2000], 32, levels, t) for t in range(8)]
        held = [Counter(place(t, points[:size]).tolist()) for t in trees]
        leaves = leaves_for(trees, size, 3000)
        seen = [sum(held[t][code] for t, code in visits(trees, p, leaves)) for p in points[:20]]
        assert 0.85 * 3000 < np.mean(seen) < 1.3 * 3000, (size, np.mean(seen))


def test_leaves_are_raised_until_the_share_is_found(spark):
    draw = np.random.default_rng(2)
    m = draw.normal(size=(3000, 32))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    # the first candidates are far too few, as a fixed number is for a large table
    got = {}
    for r in nearest(table, F.col("vec_id") % 50 == 0, how=Forest(trees=4, leaf=16, candidates=100)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    hits = 0
    for i in range(0, 3000, 50):
        cosines = m @ m[i]
        cosines[i] = -2
        hits += len(got[i] & set(np.argsort(-cosines)[:5].tolist()))
    assert hits >= 0.95 * 5 * 60
