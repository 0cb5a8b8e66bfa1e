"""Near duplicates: MinHash bands for candidates, odd sketches to sift them, full shingle sets to confirm.

Documents with equal shingle sets form a class, and only classes are compared.
MinHash samples of a class give band keys; classes that share a key are
candidates. The parity bitmap of the same samples (an odd sketch) tells from
the bits that differ whether a candidate pair can reach the threshold at all,
and only such pairs are confirmed on their full sets.

Classes under one key are first compared with the smallest of them only, a
star, which needs as many pairs as classes and joins most near copies.
Connected classes need no further comparison. The keys whose classes are still
apart are worked off in tiles of bounded size: a tile compares two blocks of a
key's classes by their sketches, confirms what remains possible where it is and
gives out links alone. No pair is left out for the size of its group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.exact_dedup import settled
from panelcast.llm.textkernels import mix64, shingle_set, word_hashes
from panelcast.sources.spool import spool

WIDTH = 5  # words in a shingle
PERCENT = 85  # of the union that a link's intersection holds at least, unless the caller says otherwise
BANDS, ROWS = 36, 8  # at a similarity of 0.85 a pair shares no band with a chance of 1e-5
LEAST_MISS = 2e-5  # chance at most that a pair at the threshold shares no band, where rows are chosen for it
SAMPLES = BANDS * ROWS
SKETCH_BITS = 1024
BLOCK = 512  # classes on a side of a tile

_rng = np.random.default_rng(871)
_FACTORS = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)
_MASKS = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_BAND_SALTS = mix64(np.arange(1, SAMPLES + 1, dtype=np.uint64))
_SAMPLE_SALTS = mix64(np.arange(1001, 1001 + SAMPLES, dtype=np.uint64))

SIGNATURES = "doc_id long, text_key binary, set_key binary, n int, bands array<long>, sketch array<long>"


FIELDS = [f.split()[0] for f in SIGNATURES.split(", ")]


def rows_of_band(percent: int) -> int:
    """Samples in a band: as many as leave a pair at the threshold a chance of ``LEAST_MISS`` to share no band."""
    for rows in range(ROWS, 1, -1):
        if (1 - (percent / 100) ** rows) ** (SAMPLES // rows) <= LEAST_MISS:
            return rows
    return 1


def differing_bits_limit(percent: int = PERCENT, deviations: float = 4.5) -> int:
    """Bits in which the sketches of a pair at the threshold differ at most, but for chance beyond ``deviations``.

    Of the samples a share of 1 - J differs, each putting two bits of noise into
    the bitmap; the number of set bits then follows from throws into bins.
    """
    apart = 1 - percent / 100
    most = SAMPLES * apart + deviations * (SAMPLES * apart * (1 - apart)) ** 0.5
    bits = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * most))
    return int(bits + 2.5 * (2 * most) ** 0.5 * (2 * most / SKETCH_BITS) ** 0.5) + 1


def min_samples(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash samples (rows x SAMPLES) of the sets that begin at ``starts`` in ``flat``."""
    short = (flat >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), SAMPLES), dtype=np.uint32)
    for k in range(SAMPLES):
        out[:, k] = np.minimum.reduceat((short ^ _MASKS[k]) * _FACTORS[k], starts)
    return out


def band_keys(samples: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` samples."""
    bands = SAMPLES // rows
    parts = samples[:, : bands * rows].reshape(len(samples), bands, rows).astype(np.uint64)
    key = np.broadcast_to(_BAND_SALTS[:bands], (len(samples), bands)).copy()
    for r in range(rows):
        key = mix64(key * np.uint64(31) + parts[:, :, r])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (rows x SKETCH_BITS / 64 words) of the numbered samples."""
    place = (mix64(samples.astype(np.uint64) ^ _SAMPLE_SALTS) % np.uint64(SKETCH_BITS)).astype(np.int64)
    bits = np.zeros((len(samples), SKETCH_BITS), dtype=np.uint8)
    for i in range(len(samples)):
        bits[i] = np.bincount(place[i], minlength=SKETCH_BITS) & 1
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signature_batch(ids: list, texts: list, sets: list[np.ndarray], rows: int) -> pa.RecordBatch:
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    samples = min_samples(flat, starts)
    bands, sketches = band_keys(samples, rows), odd_sketches(samples)
    columns = [
        pa.array(ids, pa.int64()),
        pa.array(texts, pa.binary()),
        pa.array([set_key(s) for s in sets], pa.binary()),
        pa.array([len(s) for s in sets], pa.int32()),
        pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel(), pa.int64()), bands.shape[1]).cast(pa.list_(pa.int64())),
        pa.FixedSizeListArray.from_arrays(pa.array(sketches.ravel(), pa.int64()), sketches.shape[1]).cast(pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, FIELDS)


def signatures(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``SIGNATURES`` for every document; ``n`` is 0 and the rest null where a text has no words."""
    in_band = rows_of_band(percent)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ids = batch.column("doc_id").to_pylist()
            all_texts = batch.column("text_key").to_pylist()
            rows, sets, waiting, got = [], [], 0, set()

            def made(rows, sets, all_ids=all_ids, all_texts=all_texts):
                return _signature_batch([all_ids[r] for r in rows], [all_texts[r] for r in rows], sets, in_band)

            for row, words in word_hashes(batch.column("text")):
                if not len(words):
                    continue
                got.add(row)
                rows.append(row)
                sets.append(shingle_set(words, width))
                waiting += len(sets[-1])
                if waiting > 1 << 17:
                    yield made(rows, sets)
                    rows, sets, waiting = [], [], 0
            if sets:
                yield made(rows, sets)
            bare = [row for row in range(len(all_ids)) if row not in got]
            if bare:
                none = [None] * len(bare)
                columns = [
                    pa.array([all_ids[r] for r in bare], pa.int64()),
                    pa.array([all_texts[r] for r in bare], pa.binary()),
                    pa.array(none, pa.binary()),
                    pa.array([0] * len(bare), pa.int32()),
                    pa.array(none, pa.list_(pa.int64())),
                    pa.array(none, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, FIELDS)

    text_key = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key")
    return docs.select(F.col("doc_id").cast("long"), "text", text_key).mapInArrow(signed, SIGNATURES)


def full_sets(docs: DataFrame, keys: DataFrame, width: int = WIDTH) -> DataFrame:
    """``node, shingles`` of the classes in ``keys`` (``node, doc_id``), from the texts of those ids."""
    wanted = keys.select(F.col("doc_id").alias("__id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    texts = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["__id"]), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(words, width) for _, words in word_hashes(batch.column("text")) if len(words)]
            for at in range(0, len(found), 500):
                part = found[at : at + 500]
                columns = [pa.array([set_key(s) for s in part], pa.binary()), pa.array([s.view(np.int64) for s in part], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])

    made = texts.select("text").mapInArrow(sets, "node binary, shingles array<long>")
    # An id may stand for several texts: those of other classes go, of equal sets one stays.
    return made.join(keys.select("node"), "node", "left_semi").groupBy("node").agg(F.any_value("shingles").alias("shingles"))


def _bits_apart(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, v: s + v)


def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    return both.filter(shared * 100 >= union * percent).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``: the smallest node that it is connected with.

    Alternating star steps: a node's larger neighbours, then its smaller ones,
    are tied to the smallest neighbour, until every node hangs on its root. The
    number of rounds grows with the logarithm of the longest chain; each is
    written to the shared folder.
    """
    edges = spool(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = spool(large.filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = tied.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        after = spool(small.distinct())
        same = after.count() == edges.count() and after.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return spool(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots))


def _tile_links(percent: int):
    """For one tile: links between classes of different components, confirmed on their full sets."""
    limit = differing_bits_limit(percent)

    def links(tile: pa.Table) -> pa.Table:
        side = np.asarray(tile.column("side"))
        node = tile.column("node").to_pylist()
        group = np.unique(np.array(tile.column("root").to_pylist(), dtype=object), return_inverse=True)[1]
        band = int(tile.column("band")[0].as_py())
        sketch = np.array(tile.column("sketch").to_pylist(), dtype=np.int64).view(np.uint64)
        keys = np.array(tile.column("bands").to_pylist(), dtype=np.int64)
        sets = [np.sort(np.asarray(s.values)) for s in tile.column("shingles")]
        n = np.array([len(s) for s in sets])
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        one = not len(second)
        second = first if one else second

        def able(mine: np.ndarray, theirs: np.ndarray, least: int) -> np.ndarray:
            """Those of ``mine`` of whose shingles enough occur in ``least`` sets of ``theirs``, itself included."""
            known, times = np.unique(np.concatenate([sets[j] for j in theirs]), return_counts=True)
            known = known[times >= least]
            return np.array([i for i in mine if np.isin(sets[i], known).sum() * 100 >= n[i] * percent], dtype=np.int64)

        first, second = able(first, second, 1 + one), able(second, first, 1 + one)
        a, b = [], []
        for at, i in enumerate(first):
            other = second[at + 1 :] if one else second
            ok = (group[other] != group[i]) & (np.minimum(n[other], n[i]) * 100 >= np.maximum(n[other], n[i]) * percent)
            other = other[ok]
            if not len(other):
                continue
            other = other[np.bitwise_count(sketch[other] ^ sketch[i]).sum(axis=1) <= limit]
            # A pair that meets under several keys is looked at under the first of its bands.
            other = other[~(keys[other, :band] == keys[i, :band]).any(axis=1)]
            if not len(other):
                continue
            found = np.isin(np.concatenate([sets[j] for j in other]), sets[i])
            shared = np.add.reduceat(found, np.concatenate([[0], np.cumsum(n[other])[:-1]]), dtype=np.int64)
            for j in other[shared * 100 >= (n[other] + n[i] - shared) * percent]:
                if group[j] != group[i]:
                    a.append(min(node[i], node[j]))
                    b.append(max(node[i], node[j]))
                    group[group == group[j]] = group[i]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return links


def apart_links(members: DataFrame, classes: DataFrame, sets: DataFrame, roots: DataFrame, block: int = BLOCK, percent: int = PERCENT) -> DataFrame:
    """Links ``a, b`` between components whose classes share a band key, as many as connect what is connected.

    Pairs are compared where they meet and are not given out unless they link.
    """
    labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("m"))
    mixed = mixed.filter("low <> high").select("key", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    rows = labelled.join(mixed, "key").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    tiled = rows.select("key", "band", "node", "root", "mine", F.explode(others).alias("other"))
    tiled = tiled.withColumns({"x": F.least("mine", "other"), "y": F.greatest("mine", "other")})
    tiled = tiled.withColumn("side", (F.col("mine") != F.col("x")).cast("int"))
    full = tiled.join(classes.select("node", "sketch", "bands"), "node").join(sets, "node")
    made = full.groupBy("key", "x", "y").applyInArrow(_tile_links(percent), "a binary, b binary")
    return made.distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, block: int = BLOCK, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document, ``text_key`` and ``group_key``.

    Texts are linked if their shingle sets share at least ``percent`` of their union.

    Defined results: a null text or one without words has 0 shingles, is linked
    with nothing and is its own component; fewer words than ``width`` are one
    shingle; repeated rows are linked; null ids never name a component unless
    nothing else is in it, and such rows count as kept; an empty table gives no
    rows; other columns are not looked at.
    """
    signed = spool(signatures(docs, width, percent))
    some = signed.filter("n > 0")
    classes = some.groupBy(F.col("set_key").alias("node")).agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    classes = spool(classes)
    keyed = classes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub <> last")
    members = spool(keyed.join(shared.select("key", "hub"), "key"))
    slim = classes.select("node", "n", "sketch")
    near = members.select("node").distinct()
    sets = spool(full_sets(docs, classes.join(near, "node", "left_semi").select("node", "doc_id"), width))
    star = members.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    of_a = slim.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    of_b = slim.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    star = star.join(of_a, "a").join(of_b, "b").filter(_sizes_allow(F.col("n_a"), F.col("n_b"), percent))
    star = star.filter(_bits_apart(F.col("s_a"), F.col("s_b")) <= differing_bits_limit(percent)).select("a", "b")
    links = spool(confirmed(star, sets, percent))
    roots = components(links)
    more = spool(apart_links(members, classes, sets, roots, block, percent))
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    named = classes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    label = named.join(names, "root").select(F.col("node").alias("set_key"), F.col("root").alias("group_key"), "component_id")
    out = signed.select("doc_id", "text_key", "set_key", "n").join(label, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_key",
        "group_key",
    )


def without_near_duplicates(docs: DataFrame, width: int = WIDTH, block: int = BLOCK, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of linked texts, all columns unchanged; texts without words stay."""
    kept = spool(near_duplicates(docs, width, block, percent).filter("kept"))
    alone = kept.filter("group_key IS NULL").select("doc_id", "text_key")
    grouped = kept.filter("group_key IS NOT NULL")
    one = grouped.groupBy("group_key").agg(F.min(F.struct("doc_id", "text_key")).alias("r"))
    chosen = alone.unionByName(one.select("r.*")).distinct().select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text"))
    rows = docs.withColumns(
        {"__id_own": F.col("doc_id").cast("long"), "__text_own": F.unhex(F.md5(F.coalesce("text", F.lit(""))))}
    )
    same = rows["__id_own"].eqNullSafe(chosen["__id"]) & (rows["__text_own"] == chosen["__text"])
    found = rows.join(chosen, same, "left_semi")
    repeated = grouped.groupBy(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text")).count().filter("count > 1")
    return settled(found, docs, {"__id_own": "__id", "__text_own": "__text"}, repeated.drop("count"))
