import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm import near_dedup
from panelcast.llm.embedding_dedup import Descent, near_vectors
from panelcast.llm.exact_dedup import exact_duplicates, without_exact_duplicates
from panelcast.llm.near_dedup import near_duplicates, without_near_duplicates

from .conftest import make_docs


def brute_exact(texts):
    groups = collections.defaultdict(list)
    for i, t in texts:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((i, t or ""))
    out = []
    for body, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r[1]), r[0] is None, r[0]))
        out += [(i, best[0], len(rows), hashlib.sha256(body.encode()).hexdigest()) for i, _ in rows]
    return sorted(out, key=repr)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_match_brute_force_even_if_hashes_collide(spark, awkward, weak):
    docs = make_docs(spark, awkward)
    hash_of = (lambda text: F.substring(F.md5(text), 1, 1)) if weak else None
    got = (exact_duplicates(docs, hash_of) if weak else exact_duplicates(docs)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute_exact(awkward)
    kept = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({b[3] for b in brute_exact(awkward)})


def test_exact_filter_keeps_one_whole_row_per_text(spark, awkward):
    docs = make_docs(spark, awkward)
    kept = without_exact_duplicates(docs)
    assert kept.columns == docs.columns
    bodies = [re.sub("[\x20\x09-\x0d]", "", r.text or "") for r in kept.collect()]
    assert sorted(bodies) == sorted({re.sub("[\x20\x09-\x0d]", "", t or "") for _, t in awkward})
    assert {r.kept for r in kept.collect()} == {"mine"}


def shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute_near(texts, percent=85):
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for k in range(len(texts)):
        groups[root(k)].append(texts[k][0])
    names = {r: min([i for i in ids if i is not None], default=None) for r, ids in groups.items()}
    return sorted(((texts[k][0], len(sets[k]), names[root(k)]) for k in range(len(texts))), key=repr)


def edited(base, words, changes, rng):
    out = list(base)
    for _ in range(changes):
        out[rng.integers(len(out))] = words[rng.integers(len(words))]
    return " ".join(out)


def near_family(words):
    """A base text, copies that differ from it by little and from each other by more, chains and strangers."""
    rng = np.random.default_rng(2)
    texts = []
    base = list(rng.choice(words, 150))
    for i in range(60):
        texts.append((100 + i, edited(base, words, int(rng.integers(0, 7)), rng)))
    chain = list(rng.choice(words, 120))
    for i in range(12):
        texts.append((300 - i, " ".join(chain)))
        chain[5 * i] = words[rng.integers(len(words))]
    texts += [(400 + i, " ".join(rng.choice(words, rng.integers(1, 90)))) for i in range(60)]
    return texts


@pytest.mark.parametrize("block", [512, 4])
def test_near_components_match_brute_force(spark, words, awkward, block):
    texts = near_family(words) + [(i, t) for i, t in awkward if t is None or len(t) < 1000]
    got = near_duplicates(make_docs(spark, texts), block=block).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_near(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_hubs_that_link_nothing_leave_no_group_apart(spark, words):
    """The smallest class of a group is a poor copy: the rest still meets in the tiles."""
    rng = np.random.default_rng(9)
    base = list(rng.choice(words, 200))
    texts = [(i, edited(base, words, 9, rng)) for i in range(40)] + [(99, " ".join(base))]
    got = near_duplicates(make_docs(spark, texts), block=8).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_near(texts)


def test_near_filter_keeps_one_row_per_group(spark, words, awkward):
    texts = near_family(words) + awkward
    docs = make_docs(spark, texts)
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    sets = [shingles(r.text) for r in kept.collect()]
    full = [s for s in sets if s]
    for i in range(len(full)):
        for j in range(i):
            assert full[i] != full[j]
    assert sum(not s for s in sets) == sum(not shingles(t) for _, t in texts)


def test_threshold_of_the_pipeline_links_what_85_percent_leaves(spark, words):
    """Pairs between 80 and 85 percent alike go from the corpus; op5's contract leaves them apart."""
    import corpus_pipeline

    rng = np.random.default_rng(12)
    texts = []
    while len(texts) < 60:
        base = list(rng.choice(words, 400))
        other = list(base)
        for at in rng.choice(400, 8, replace=False):
            other[at] = words[rng.integers(len(words))]
        a, b = shingles(" ".join(base)), shingles(" ".join(other))
        if 0.80 <= len(a & b) / len(a | b) < 0.85:
            texts += [(len(texts), " ".join(base)), (len(texts) + 1, " ".join(other))]
    docs = make_docs(spark, texts)
    assert corpus_pipeline.near_dedup(spark, docs, "").count() == 30
    assert without_near_duplicates(docs).count() == 60
    assert near_dedup.rows_of_band(85) == near_dedup.ROWS
    rows = near_dedup.rows_of_band(80)
    assert (1 - 0.8**rows) ** (near_dedup.SAMPLES // rows) < 2e-5


def test_sketch_limit_never_falls_below_the_threshold():
    """Pairs at the threshold differ in fewer sketch bits than the limit."""
    rng = np.random.default_rng(5)
    limit, far = near_dedup.differing_bits_limit(), []
    for _ in range(60):
        shared = rng.integers(0, 1 << 63, 850, dtype=np.uint64)
        own = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
        a = np.sort(np.concatenate([shared, own[:75]]))
        b = np.sort(np.concatenate([shared, own[75:]]))
        s = near_dedup.odd_sketches(near_dedup.min_samples(np.concatenate([a, b]), np.array([0, len(a)])))
        far.append(int(np.bitwise_count((s[0] ^ s[1]).view(np.uint64)).sum()))
    assert max(far) < limit


def brute_vectors(vectors):
    n = len(vectors)
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    links = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and len(vectors[i]) == len(vectors[j]):
                a, b = np.float32(vectors[i]).astype(float), np.float32(vectors[j]).astype(float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                    links[i].add(j)
                    links[j].add(i)
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(n)]
    return sorted((i, len(links[i]), label[i], label[i] == i) for i in range(n))


@pytest.mark.parametrize("how", [Descent(), Descent(lists=4, longest=8, block=16)])
def test_vectors_match_brute_force(spark, how):
    rng = np.random.default_rng(3)
    vectors = [list(map(float, rng.normal(size=16))) for _ in range(60)]
    center = rng.normal(size=16)
    vectors += [list(map(float, center + 0.12 * rng.normal(size=16))) for _ in range(50)]
    vectors += [vectors[3], vectors[3], [2 * x for x in vectors[4]], [0.0] * 16, None, [], [1.0, None] * 8, [float("nan")] * 16, [float("inf")] + [0.0] * 15]
    vectors += [[1.0, 2.0], [1.0, 2.01], [1e-30, 2e-30]]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int, node string")
    got = near_vectors(df, how).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == brute_vectors(vectors)
    assert all(r.audit_recall >= 0.995 for r in got)


def hot_group_and_pairs():
    """One group that holds most links, and pairs at a cosine of about 0.951 that nothing leads to."""
    rng = np.random.default_rng(8)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    center, one, other = unit(rng.normal(size=32)), unit(rng.normal(size=(150, 32))), rng.normal(size=(150, 32))
    other = unit(other - (other * one).sum(axis=1, keepdims=True) * one)
    pairs = np.concatenate([one, 0.951 * one + (1 - 0.951**2) ** 0.5 * other])
    return np.concatenate([unit(center + 0.01 * rng.normal(size=(150, 32))), pairs])


def test_links_of_a_hot_group_do_not_hide_lost_pairs(spark):
    """A search that cannot find the pairs is noticed, and all vectors are compared."""
    x = hot_group_and_pairs()
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = near_vectors(df, Descent(tables=1, window=1, bits=12, missed=0.9, repeats=0, wide=128)).collect()
    near = x @ x.T >= 0.95
    assert {r.vec_id: r.n_links for r in got} == {i: int(near[i].sum()) - 1 for i in range(len(x))}
    assert {r.vec_id: r.component_id for r in got if r.vec_id >= 300} == {i: i - 150 for i in range(300, 450)}
    assert {r.audit_recall for r in got} == {1.0}


def test_a_recall_that_nothing_measured_is_null(spark):
    x = np.random.default_rng(5).normal(size=(40, 32))
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)] + [(90, None), (None, None)], "vec_id long, embedding array<double>")
    got = near_vectors(df).collect()
    assert {r.audit_recall for r in got} == {None} and {r.n_links for r in got} == {0}
    assert sorted(map(str, (r.vec_id for r in got))) == sorted(map(str, [*range(40), 90, None])) and all(r.kept for r in got)


def test_sorted_passes_grow_with_the_table():
    assert Descent().passes(0) == Descent().tables
    assert Descent().passes(20_000) > 12 and Descent().passes(1_000_000) > 1.5 * Descent().passes(20_000)


def test_empty_tables_give_no_rows(spark):
    docs = make_docs(spark, [(1, "a")]).limit(0)
    for frame in (exact_duplicates(docs), without_exact_duplicates(docs), near_duplicates(docs), without_near_duplicates(docs)):
        assert frame.count() == 0
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
