"""The registered queries on the smallest tables, and the pipeline against brute force."""

import collections
import os

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from panelcast.llm import oracles, queries

from .test_dedup import brute_exact, brute_near, shingles

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables are missing")

TABLES = {"op2": "embeddings", "op3": "pages", "op13": "conversations"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in sorted(f.removesuffix(".parquet") for f in os.listdir(SF)):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_all_are_registered():
    assert set(queries.queries()) | {"pipeline"} <= set(contract.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(oracles.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_matches_its_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    cursor = duck.execute(oracles.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    expected = [tuple(r[names.index(c)] for c in order) for r in cursor.fetchall()]
    assert collections.Counter(tuple(r[c] for c in order) for r in df.collect()) == collections.Counter(expected)


@pytest.mark.parametrize("name, table", [(n, TABLES.get(n.split("_")[0], "documents")) for n in sorted(queries.queries())])
def test_query_covers_its_table(spark, name, table):
    df = queries.queries()[name](spark, SF)
    key = {"pages": "page_id", "embeddings": "vec_id", "documents": "doc_id", "conversations": "conv_id"}[table]
    all_ids = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()}
    got = {r[0] for r in df.select(key).collect()}
    assert got <= all_ids if name.startswith("op10") else got == all_ids


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF).write.parquet(str(tmp_path / str(i)))
        frames.append(spark.read.parquet(str(tmp_path / str(i))))
    start, good, exact, near, mixed, packed = [f.collect() for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    right = sum((i in kept) == bool(q) for i, q in labels.items())
    assert right >= 0.9 * len(labels) and len(good) < len(start)
    pairs = [(r.doc_id, r.text) for r in good]
    assert sorted(r.doc_id for r in exact) == sorted({k for _, k, _, _ in brute_exact(pairs)})
    pairs = [(r.doc_id, r.text) for r in exact]
    groups = {c for _, _, c in brute_near(pairs, 80)} if all(shingles(t) for _, t in pairs) else None
    assert groups is None or sorted(r.doc_id for r in near) == sorted(groups)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in near}
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed}
    assert collections.Counter(r.doc_id for r in packed if r.start == 0) == collections.Counter(r.doc_id for r in mixed)
    run = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in run.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_pipeline_sends_texts_to_python_in_small_batches(spark):
    key = corpus_pipeline.TEXT_BATCHES[0]
    before = spark.conf.get(key)
    docs = spark.range(64, numPartitions=1).selectExpr("id AS doc_id", "repeat('word ', 100000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    try:
        for _, stage in (s for s in corpus_pipeline.STAGES if s[1].__name__ in ("quality", "near_dedup", "packing")):
            spark.conf.set(key, before)
            stage(spark, spark.read.parquet(f"{SF}/documents.parquet").limit(20), SF)
            assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < 6e6
    finally:
        spark.conf.set(key, before)
