import collections
import functools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.llm.packing import Capacity, best_fit_runs, cut, pack
from panelcast.llm.token_shards import Permutation, read_records, token_shards
from panelcast.llm.tokens import TOKENIZER, WordEncoder, encoder

from .conftest import make_docs


@functools.cache
def whole_text_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    t.encode_special_tokens = True
    return t


def plain_ids(text):
    return whole_text_tokenizer().encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_the_whole_text(awkward):
    rng = random.Random(1)
    letters = "ab  \t\n'sre,.!É日本0123   \r\x0b<|endoftext|>'ll 'VÉ👍  "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += [t for _, t in awkward if t and len(t) < 100_000] + ["a" * 5000, "a  b", " a", "a ", " ", "\n"]
    for own in (encoder(), WordEncoder(word_limit=20)):
        for text in texts:
            assert np.frombuffer(own.encode(text), "<u4").tolist() == plain_ids(text), text


def test_every_kind_of_character_gives_the_ids_of_the_library():
    own = encoder()
    for lo in range(0, 0x110000, 997):  # a step that is prime to the blocks of the table of characters
        for c in range(lo, min(lo + 3, 0x110000)):
            if not 0xD800 <= c < 0xE000:
                text = f"a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)}! {chr(c)} "
                assert np.frombuffer(own.encode(text), "<u4").tolist() == plain_ids(text), hex(c)


def unrolled(runs):
    sequences = collections.defaultdict(list)
    for length, first, last, sequence, each, offset in runs:
        for j in range(last - first + 1):
            sequences[sequence + j // each].append((offset + j % each * length, length))
    return sequences


@pytest.mark.parametrize(
    "capacity", [Capacity(), Capacity(rule="dot"), Capacity(documents=5), Capacity(tokens=300, cost=45_000), Capacity(tokens=300, cost=45_000, rule="dot")]
)
def test_runs_keep_every_capacity_and_pack_tightly(capacity):
    rng = np.random.default_rng(3)
    most = min(capacity.tokens, int(capacity.most_cost**0.5))
    lengths = np.minimum(rng.lognormal(5, 1.2, 4000).astype(int) + 1, most)
    sequences = unrolled(best_fit_runs(collections.Counter(lengths.tolist()).items(), capacity))
    assert sorted(n for s in sequences.values() for _, n in s) == sorted(lengths.tolist())
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity.tokens and len(parts) <= capacity.most_documents
        assert sum(n * n for _, n in parts) <= capacity.most_cost
    least = max(lengths.sum() / capacity.tokens, len(lengths) / capacity.most_documents, (lengths**2).sum() / capacity.most_cost)
    assert len(sequences) <= 1.35 * least + 1
    if capacity == Capacity():
        assert len(sequences) <= least + 2


def test_a_document_is_cut_with_the_short_piece_first():
    assert cut(5, 8) == [(0, 5)] and cut(8, 8) == [(0, 8)] and cut(17, 8) == [(0, 1), (1, 8), (9, 8)]


def test_packed_pieces_are_whole_and_gapless(spark, awkward):
    got = pack(make_docs(spark, awkward), Capacity(tokens=256)).collect()
    want = collections.Counter()
    for i, text in awkward:
        ids = np.array([*plain_ids(text), 0], dtype="<u4")
        want.update((i, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), 256)))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = collections.defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 256
    assert len(places) <= -(-sum(r.length for r in got) // 256) + 1


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation_is_one_and_has_an_inverse(n):
    p = Permutation(n, 5)
    slots = p.forward(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (p.backward(slots) == np.arange(n)).all()
    assert n < 64 or (slots != Permutation(n, 6).forward(np.arange(n))).any()


def test_shards_read_back_every_document(spark, awkward, tmp_path):
    docs = make_docs(spark, awkward).repartition(3, F.col("doc_id"))
    rows = token_shards(docs, str(tmp_path), length=128, shard_bytes=128 * 2 * 50).collect()
    records = {s: list(read_records(str(tmp_path), s, length=128)) for s in {r.shard for r in rows}}
    assert {r.slot for r in rows} == set(range(sum(map(len, records.values()))))
    assert all((r.shard, r.record) == divmod(r.slot, 50) for r in rows)
    assert all(zlib.crc32(records[r.shard][r.record].astype("<u4").tobytes()) == r.ids_crc32 for r in rows)
    stretches = collections.Counter()
    for r in rows:
        part = records[r.shard][r.record][r.offset : r.offset + r.length]
        stretches[(r.doc_id, r.start, tuple(part.tolist()))] += 1
    total = collections.Counter()
    for i, text in awkward:
        total[i] += len(plain_ids(text)) + 1
    got = collections.Counter()
    for (i, _, part), n in stretches.items():
        got[i] += len(part) * n
    assert got == total
    eight = b"".join(np.array(p, "<u4").tobytes() for (i, s, p) in sorted(stretches, key=lambda k: k[1]) if i == 8)
    text = next(t for i, t in awkward if i == 8)
    assert eight == np.array([*plain_ids(text), 0], dtype="<u4").tobytes()
    resumed = list(read_records(str(tmp_path), 0, first=3, count=2, length=128))
    assert len(resumed) == 2 and (resumed[0] == records[0][3]).all()


def test_empty_tables_give_no_rows(spark, tmp_path):
    docs = make_docs(spark, [(1, "a")]).limit(0)
    assert pack(docs).count() == 0
    assert token_shards(docs, str(tmp_path)).count() == 0
