import collections
import math
import zlib

import pytest

from panelcast.llm.mixing import mix, source_rates
from panelcast.llm.sharding import byte_shards

from .conftest import make_docs


def test_shards_are_contiguous_even_and_gapless(spark, words, awkward):
    texts = [(i, " ".join(words[i % 50 : i % 50 + 20])) for i in range(20, 700)] + [(i, t) for i, t in awkward if i not in (8, 9)]
    got = byte_shards(make_docs(spark, texts), shards=5).collect()
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    rows = sorted(got, key=lambda r: (r.shard, r.slot))
    at, seen = 0, collections.Counter()
    total = sum(r.size for r in rows)
    for r in rows:
        assert r.first_byte == at and r.slot == seen[r.shard]
        assert r.shard == (2 * at + r.size) * 5 // (2 * total)
        seen[r.shard] += 1
        at += r.size
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    sizes = collections.Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_one_giant_document_has_a_shard_of_its_own(spark):
    got = byte_shards(make_docs(spark, [(1, "a"), (2, "b" * 10_000), (3, "c")]), shards=4).collect()
    assert [r.shard for r in sorted(got, key=lambda r: r.doc_id)] == [0, 2, 3]


def test_rates_hit_the_given_weights(spark, words):
    texts = [(i, " ".join(words[:30])) for i in range(300)]
    rates = {r.mix_source: r.mix_rate for r in source_rates(make_docs(spark, texts), {"s0": 3, "s1": 1}).collect()}
    assert rates["s2"] == 0 and math.isclose(rates["s0"], 3 * rates["s1"], rel_tol=1e-6)
    assert math.isclose(100 * rates["s0"] + 100 * rates["s1"], 300, rel_tol=1e-6)


@pytest.mark.parametrize("epochs", [0.4, 2.0, 40.0])
def test_copies_are_poisson_and_repeatable(spark, epochs):
    texts = [(i, "word") for i in range(900)]
    docs = make_docs(spark, texts)
    rows = mix(docs, {"s0": 1, "s1": 1, "s2": 1}, epochs=epochs).collect()
    n = collections.Counter(r.doc_id for r in rows)
    counts = [n[i] for i in range(900)]
    mean = sum(counts) / 900
    spread = sum((c - mean) ** 2 for c in counts) / 900
    assert abs(mean - epochs) < 5 * (epochs / 900) ** 0.5 and abs(spread / epochs - 1) < 0.35
    assert all(r.mix_copies == n[r.doc_id] for r in rows)
    again = mix(docs.repartition(5), {"s0": 1, "s1": 1, "s2": 1}, epochs=epochs).collect()
    assert sorted((r.doc_id, r.mix_key) for r in again) == sorted((r.doc_id, r.mix_key) for r in rows)


def test_mixing_keeps_rows_whole(spark, awkward):
    docs = make_docs(spark, awkward)
    rows = mix(docs, epochs=3.0).collect()
    known = {(r.doc_id, r.text, r.source) for r in docs.collect()}
    assert {(r.doc_id, r.text, r.source) for r in rows} <= known
    assert {r.kept for r in rows} == {"mine"} and set(docs.columns) <= set(rows[0].asDict())
    assert mix(docs.limit(0)).count() == 0 and byte_shards(docs.limit(0)).count() == 0


def test_null_and_repeated_ids_draw_apart(spark):
    rows = [(None, f"text {i}", "s") for i in range(2000)] + [(None, "one text", "t")] * 2000 + [(7, "same", "u")] * 2000
    docs = spark.createDataFrame([(*r, "mine") for r in rows], "doc_id long, text string, source string, mix_source string").repartition(3)
    got = mix(docs, {"s": 1, "t": 1, "u": 1}).collect()
    n, size = collections.Counter(r.source for r in got), sum(len(t) + 1 for _, t, _ in rows)
    for source, texts in (("s", [t for _, t, k in rows if k == "s"]), ("t", ["one text"] * 2000), ("u", ["same"] * 2000)):
        mean = 2000 * size / 3 / sum(len(t) + 1 for t in texts)
        assert abs(n[source] - mean) < 6 * mean**0.5
    assert {r.mix_source for r in got} == {"mine"} and len({r.mix_key for r in got}) == len(got)
    again = mix(docs.repartition(5), {"s": 1, "t": 1, "u": 1}).collect()
    assert sorted((r.text, r.mix_key) for r in again) == sorted((r.text, r.mix_key) for r in got)


def test_copies_come_in_the_order_of_their_keys(spark):
    keys = [r.mix_key for r in mix(make_docs(spark, [(i, f"text {i}") for i in range(300)]), epochs=2.0).collect()]
    assert len(keys) > 400 and keys == sorted(keys)


def test_mixing_runs_without_python(spark, awkward):
    plan = mix(make_docs(spark, awkward))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
