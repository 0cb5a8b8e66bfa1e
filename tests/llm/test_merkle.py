"""The manifest against a tree that is built in one place."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from panelcast.llm.merkle import Tree, document_leaves, height, manifest, verified, version

from .conftest import make_docs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    """Expected rows of ``verified`` from (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for i, text, lang, source, n in rows:
        hit = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
        groups.setdefault(lang, []).append((i is not None, i or 0, leaf(i, source, lang, n, text), leaf(i, source, lang, n + 1, text) if hit else None))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for at, (g, tree) in enumerate(zip(names, trees)):
        for pos, (known, i, own, changed) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            proof, node = "", changed or own
            for nodes, k in [*((tree[d], pos >> d) for d in range(len(tree) - 1)), *((top[d], at >> d) for d in range(len(top) - 1))]:
                pair = nodes[k & ~1 : (k | 1) + 1]
                proof += "".join(x for j, x in enumerate(pair) if (k & ~1) + j != k)
                node = sha("".join(node if (k & ~1) + j == k else x for j, x in enumerate(pair)))
            out.append((i if known else None, own, tree[-1][0], top[-1][0], sha(proof), node, node == top[-1][0]))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_manifest_equals_a_tree_in_one_place(spark, awkward, bits):
    rows = [(i, t, "én" if k % 3 else None, f"s{k}", k % 5 or None) for k, (i, t) in enumerate(awkward)]
    rows += [(1000 + k, f"text {k}", f"l{k % 4}", None, k) for k in range(150)] + [(7777, "alone", "zz", "s", 3)]
    docs = spark.createDataFrame([(*r, "mine", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, g string, pos int")
    got = rows_of(verified(manifest(document_leaves(docs.repartition(5)), bits)))
    want = brute(rows)
    assert got == want
    assert {r[-1] for r in got} == {True, False}


def test_every_row_is_a_leaf_of_its_own(spark):
    rows = [(5, "same", "en", "s", 4)] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = manifest(document_leaves(docs), bits=4)
    assert sorted(r.pos for r in got.collect()) == list(range(3000))


def test_versions_share_all_but_the_path():
    tree = Tree([sha(str(i)) for i in range(11)], height(11))
    for i in range(11):
        path = tree.path(i)
        assert version(tree.nodes[0][i], path) == [level[i >> k] for k, level in enumerate(tree.nodes)]
        copied = version(sha("new"), path)
        changed = Tree([sha("new") if j == i else x for j, x in enumerate(tree.nodes[0])], height(11))
        for k, (old, new) in enumerate(zip(tree.nodes, changed.nodes)):
            assert new == [copied[k] if j == i >> k else x for j, x in enumerate(old)]


def test_empty_and_single_tables(spark):
    docs = make_docs(spark, [(3, "a")])
    assert manifest(document_leaves(docs.limit(0))).count() == 0
    (r,) = verified(manifest(document_leaves(docs))).collect()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == sha("") and r.verified == (zlib.crc32(b"3") % 7 != 0)
    assert document_leaves(docs).select(F.col("digest") == F.col("changed")).collect()[0][0] == r.verified
