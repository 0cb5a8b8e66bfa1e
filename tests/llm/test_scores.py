import random
import zlib

import numpy as np
import pyarrow as pa

from panelcast.llm.features import indicators
from panelcast.llm.nbsvm import dual_coordinate_descent, fit, sigmoid_fit
from panelcast.llm.quality import accepted, score_quality
from panelcast.llm.textkernels import GROUP, SLICE, shingle_set, slices, word_hashes
from panelcast.llm.toxicity import LabelModel, Lookup, _hash_words, dependency_tree, mined_terms, score_toxicity

from .conftest import make_docs

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, words, n=600):
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        junk, toxic = i % 5 == 0, i % 7 == 0
        if toxic:
            for _ in range(3):
                body[rng.randrange(len(body))] = rng.choice(["idiot", "zzurk", "zzurkly", "scum"])
        if junk:
            body = [w + rng.choice(["***", "###", "%%%"]) for w in body]
        texts.append((i, " ".join(body)))
        labels.append((i, int(not junk), int(toxic)))
    return texts, labels


def accuracy(rows, truth, held):
    mine = [r for r in rows if held(r.doc_id)]
    assert mine and all(r.held_out == held(r.doc_id) for r in rows if r.doc_id is not None)
    return sum(r.predicted == truth[r.doc_id] for r in mine) / len(mine)


def test_quality_is_learnt_from_rows_outside_the_held_out_ones(spark, words):
    texts, labels = corpus(spark, words)
    docs, table = make_docs(spark, texts), spark.createDataFrame(labels, LABELS)
    rows = score_quality(docs, table).collect()
    assert accuracy(rows, {i: q for i, q, _ in labels}, lambda i: zlib.crc32(str(i).encode()) % 5 == 0) > 0.97
    wrong = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    again = score_quality(docs, spark.createDataFrame(wrong, LABELS)).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in rows}
    kept = accepted(docs, table)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_toxicity_is_learnt_from_rows_outside_the_held_out_ones(spark, words):
    texts, labels = corpus(spark, words)
    docs = make_docs(spark, texts)
    rows = score_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert accuracy(rows, {i: t for i, _, t in labels}, lambda i: zlib.crc32(str(i).encode()) % 3 == 1) > 0.97
    wrong = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    again = score_toxicity(docs, spark.createDataFrame(wrong, LABELS)).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in rows}


def test_a_word_of_few_toxic_rows_is_a_term_in_a_large_sample(spark):
    rows = [(f"common w{i}", 0) for i in range(6000)] + [(f"common zzurk {'qqvexo' if i < 4 else ''}", 1) for i in range(600)]
    mined, (clean, toxic) = mined_terms(spark.createDataFrame(rows, "text string, label int"))
    assert (clean, toxic) == (6000, 600)
    assert set(_hash_words(["zzurk", "qqvexo"])) <= set(mined) and not set(_hash_words(["common"])) & set(mined)


def test_words_of_abuse_count_without_being_mined(spark, words):
    texts, labels = corpus(spark, words)
    texts += [(20_000, f"{words[1]} {words[2]} moron {words[3]}"), (20_001, f"{words[1]} {words[2]} {words[4]} {words[3]}")]
    score = {r.doc_id: r.score for r in score_toxicity(make_docs(spark, texts), spark.createDataFrame(labels, LABELS)).collect()}
    assert score[20_000] > score[20_001]


def test_awkward_texts_get_scores_and_missing_labels_a_constant(spark, words, awkward):
    texts, labels = corpus(spark, words, 300)
    docs = make_docs(spark, [(i, t) for i, t in texts if i > 20] + awkward)
    table = spark.createDataFrame(labels + [(None, 1, 1), (7, None, None)], LABELS)
    for score in (score_quality, score_toxicity):
        rows = score(docs, table).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
        same = {r.score for r in rows if r.doc_id == 1}
        assert len(same) == 1
        rows = score(docs, table.limit(0)).collect()
        assert {r.score for r in rows} == {0.5}
        assert score(docs.limit(0), table).count() == 0


def test_descent_separates_and_keeps_its_bounds():
    rng = np.random.default_rng(1)
    rows = [np.array([0, 2 + i % 3]) if i % 2 else np.array([1, 2 + i % 3]) for i in range(60)]
    sign = np.array([1.0 if i % 2 else -1.0 for i in range(60)])
    weight, bias = dual_coordinate_descent(rows, [np.ones(2)] * 60, sign, np.full(60, 1.0), 5, 50)
    assert all(s * (weight[r].sum() + bias) > 0.9 for r, s in zip(rows, sign, strict=True))
    slope, shift = sigmoid_fit(rng.normal(size=400) + np.repeat([3, -3], 200), np.repeat([1, 0], 200))
    assert slope > 0.5 and abs(shift) < 2
    model = fit(rows, (sign > 0).astype(int), 5)
    assert model.score(rows[1]) > 0.8 > 0.2 > model.score(rows[0])


def test_features_do_not_depend_on_the_rows_around_a_text(awkward):
    texts = [t for _, t in awkward]
    together = list(indicators(pa.array(texts, pa.string())))
    assert len(together) == len(texts)
    for text, row in zip(texts, together, strict=True):
        assert (next(iter(indicators(pa.array([text], pa.string())))) == row).all()


def test_texts_are_worked_on_in_small_groups_and_cut_only_beyond_a_slice():
    sizes = [0, 50_000, 50_000, 50_000, 300_000, 10, SLICE, 0, SLICE + 5, 7, 0]
    starts = np.cumsum([0, *sizes])
    found = list(slices(starts, np.full(starts[-1], 32, dtype=np.uint8)))
    assert [low for _, _, low, _ in found] == [0, *[high for _, _, _, high in found[:-1]]] and found[-1][3] == starts[-1]
    assert all(high - low <= GROUP for first, stop, low, high in found if stop - first > 1)
    assert [first for first, _, _, _ in found if sizes[first] > GROUP] == [4, 6, 8, 8]


def test_words_are_hashed_alike_wherever_they_stand():
    texts = ["a b c d e f", "x a b c d e", "A  b\tC\nd e", None, "é" * 10, ""]
    sets = {row: shingle_set(words) for row, words in word_hashes(pa.array(texts))}
    assert sets[2][0] in sets[0] and sets[2][0] in sets[1] and len(sets[0]) == 2
    long = " ".join(f"w{i}" for i in range(400_000))
    hashes = dict(word_hashes(pa.array(["w399999", long, "w0 w1"])))
    assert len(hashes[1]) == 400_000 and hashes[1][-1] == hashes[0][0] and (hashes[1][:2] == hashes[2]).all()


def test_terms_are_found_once_and_twice():
    idiot, scum = _hash_words(["idiot"])[0], _hash_words(["scum"])[0]
    found = Lookup(np.array([idiot, idiot | np.uint64(1), scum]))
    order = np.sort(np.array([idiot, idiot | np.uint64(1), scum])).tolist()
    names = {order.index(int(idiot)): "one", order.index(int(idiot) + 1): "two", order.index(int(scum)): "scum"}
    rows = found.rows(pa.array(["Idiot!", "idiot, IDIOT", None, "scum idiots", ""]))
    assert [{names[k] for k in r} for r in rows] == [{"one"}, {"one", "two"}, set(), {"scum"}, set()]


def test_label_model_counts_repeating_voters_once():
    pair = np.zeros((2, 3, 3))
    single = np.array([[2.0, 2.0, 2.0], [50.0, 50.0, 40.0]])
    total = np.array([100.0, 100.0])
    pair[1] = [[50, 50, 20], [50, 50, 20], [20, 20, 40]]
    pair[0] = [[2, 2, 0], [2, 2, 0], [0, 0, 2]]
    parent = dependency_tree(pair, single, total)
    assert parent[1] == 0
    free = np.stack([np.stack([s / t] * 2) for s, t in zip(single, total, strict=True)])
    tied = free.copy()
    tied[:, 1, 1], tied[:, 0, 1] = 0.99, 0.01
    votes = np.array([[1, 1, 0]])
    alone = LabelModel(0.2, np.array([-1, -1, -1]), free).posterior(votes)
    together = LabelModel(0.2, np.array([-1, 0, -1]), tied).posterior(votes)
    assert together < alone
