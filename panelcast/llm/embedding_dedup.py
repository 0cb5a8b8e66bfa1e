"""Near duplicates among embeddings by NN-descent.

Equal vectors form a class; classes are compared. A first neighbour graph comes
from sorting all vectors by random sign codes a few times and comparing each
with those that follow it. Rounds of neighbours-of-neighbours joins refine it:
the vectors in one list are compared with each other, and pairs that enter a
list on either side are kept. Entries below the cosine of twice the threshold's
angle are left out of lists: no neighbour's neighbour that is linked lies
beyond. A list that is full of links is saturated and doubles, up to a bound;
components in which lists hit the bound get their links counted by comparing
all their members in tiles, which is the exact way for the rest. The number of
sorted passes grows with the number of vectors, so that a pair that nothing
else leads to is brought together as surely in large tables.

Two samples of vectors are compared with all others to audit the recall: one of
the vectors outside the tiled components and one of those inside. Each vector
with links counts once, whatever their number, and the lower mean holds. Where
it is too low more sorted passes follow, and at last all vectors are compared
with all in blocks, which is exact and quadratic in the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.near_dedup import components
from panelcast.sources.spool import spool


@dataclass(frozen=True)
class Descent:
    threshold: float = 0.95
    tables: int = 12  # sorted passes in one go, and at least
    missed: float = 0.002  # chance that no first pass brings a pair at the threshold together
    window: int = 8  # followers in sorted order
    bits: int = 30
    lists: int = 16  # length of a list before it is enlarged
    longest: int = 64  # length of a list at most
    rounds: int = 4
    audited: int = 2048  # vectors compared with all others, outside of tiled components and inside
    recall: float = 0.995
    repeats: int = 2  # more sorted passes at most, before all vectors are compared
    block: int = 1024  # vectors on a side of a tile
    wide: int = 32768  # vectors on a side of a tile where all are compared
    seed: int = 11

    @property
    def floor(self) -> float:
        return max(0.0, 2 * self.threshold**2 - 1) - 1e-9

    def passes(self, n: int) -> int:
        """Sorted passes over ``n`` vectors: a pair meets where the codes share so many bits that a window holds the rest."""
        meets = (1 - math.acos(self.threshold) / math.pi) ** math.log2(max(2.0, n / self.window))
        return max(self.tables, math.ceil(math.log(self.missed) / math.log1p(-meets)))


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of a binary column, as rows."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), -1) if raw else np.zeros((0, 0))


def unit_classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``vec_id, node`` for every row, ``node, vec_id, copies, unit, dims`` for every class of equal usable vectors)."""
    whole = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce((F.size("v") > 0) & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = spool(whole.select("vec_id", F.when(usable, F.col("v")).alias("v")))
    grouped = rows.filter("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"))
    numbered = spool(grouped.withColumn("node", F.monotonically_increasing_id()))

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, dims = [], []
            for v in batch.column("v").to_pylist():
                x = np.array(v, dtype=np.float64)
                x = x / np.abs(x).max()
                packed.append((x / np.sqrt(x @ x)).astype("<f8").tobytes())
                dims.append(len(x))
            columns = [batch.column("node"), batch.column("vec_id"), batch.column("copies"), pa.array(packed, pa.binary()), pa.array(dims, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "vec_id", "copies", "unit", "dims"])

    schema = "node long, vec_id long, copies long, unit binary, dims int"
    classes = spool(numbered.select("node", F.col("vec_id").cast("long"), "copies", "v").mapInArrow(units, schema))
    # Unusable vectors share a null and stay out of the join, where they would meet in one task.
    placed = rows.filter("v IS NOT NULL").join(numbered.select("v", "node"), "v").select(F.col("vec_id").cast("long"), "node")
    alone = rows.filter("v IS NULL").select(F.col("vec_id").cast("long"), F.lit(None).cast("long").alias("node"))
    return spool(placed.unionByName(alone)), classes


def sorted_neighbours(classes: DataFrame, how: Descent, turn: int, tables: int) -> DataFrame:
    """Pairs ``a, b, cosine`` of vectors near each other in the order of random sign codes, of ``tables`` passes."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_dims = np.asarray(batch.column("dims"))
            for dims in np.unique(all_dims):
                part = batch.filter(pa.array(all_dims == dims))
                x = _matrix(part.column("unit"))
                for t in range(tables):
                    planes = np.random.default_rng([how.seed, turn, t, int(dims)]).standard_normal((int(dims), how.bits))
                    code = ((x @ planes > 0) @ (1 << np.arange(how.bits, dtype=np.int64)[::-1])).astype(np.int64)
                    place = np.full(len(x), t, dtype=np.int32)
                    columns = [pa.array(place), part.column("dims"), pa.array(code), part.column("node"), part.column("unit")]
                    yield pa.RecordBatch.from_arrays(columns, ["pass", "dims", "code", "node", "unit"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: tuple | None = None
        for batch in batches:
            key = np.asarray(batch.column("pass")).astype(np.int64) * (1 << 20) + np.asarray(batch.column("dims"))
            node = np.asarray(batch.column("node"))
            for k in dict.fromkeys(key.tolist()):
                mine = key == k
                x, ids = _matrix(batch.column("unit").filter(pa.array(mine))), node[mine]
                if tail and tail[0] == k:
                    x, ids = np.concatenate([tail[1], x]), np.concatenate([tail[2], ids])
                a, b, cosine = [], [], []
                for step in range(1, min(how.window, len(ids) - 1) + 1):
                    c = np.einsum("ij,ij->i", x[:-step], x[step:])
                    near = np.flatnonzero(c >= how.floor)
                    a.append(ids[near])
                    b.append(ids[near + step])
                    cosine.append(c[near])
                tail = (k, x[-how.window :], ids[-how.window :])
                if a:
                    yield _pairs(np.concatenate(a), np.concatenate(b), np.concatenate(cosine))

    placed = classes.select("node", "unit", "dims").mapInArrow(coded, "pass int, dims int, code long, node long, unit binary")
    order = ["pass", "dims", "code", "node"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(windows, "a long, b long, cosine double")


def _pairs(a: np.ndarray, b: np.ndarray, cosine: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(cosine)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "cosine"])


def merged(pairs: DataFrame) -> DataFrame:
    """One row per pair, with the round in which it was found first."""
    return spool(pairs.filter("a <> b").groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.min("round").alias("round")))


def neighbour_lists(pairs: DataFrame, how: Descent) -> DataFrame:
    """``u, v, cosine, round, full``: for each vector its nearest; as many more as links saturate its list."""
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), "cosine", "round").unionByName(
        pairs.select(F.col("b").alias("u"), F.col("a").alias("v"), "cosine", "round")
    )
    links = both.groupBy("u").agg(F.sum((F.col("cosine") >= how.threshold).cast("int")).alias("links"))
    steps = int(math.log2(how.longest / how.lists))
    size = F.lit(how.longest)
    for i in reversed(range(steps)):
        size = F.when(F.col("links") < how.lists << i, F.lit(how.lists << i)).otherwise(size)
    nearest = Window.partitionBy("u").orderBy(F.desc("cosine"), "v")
    ranked = both.join(links.withColumn("size", size), "u").withColumn("rank", F.row_number().over(nearest))
    return ranked.filter("rank <= size").select("u", "v", "cosine", "round", (F.col("links") >= how.longest).alias("full"))


def neighbours_of_neighbours(lists: DataFrame, classes: DataFrame, how: Descent, last: int) -> DataFrame:
    """Pairs ``a, b, cosine`` of vectors that share a list, one of them new to it, and that would enter a list."""
    least = lists.groupBy(F.col("u").alias("v")).agg(F.min("cosine").alias("low"), F.count(F.lit(1)).alias("n"))
    least = least.select("v", F.when(F.col("n") >= how.lists, F.col("low")).otherwise(F.lit(how.floor)).alias("low"))
    active = lists.filter(F.col("round") == last).select("u").distinct()
    rows = lists.join(active, "u", "left_semi").join(least, "v").join(classes.select(F.col("node").alias("v"), "unit"), "v")
    rows = rows.select("u", "v", (F.col("round") == last).alias("fresh"), "low", "unit").repartition("u").sortWithinPartitions("u")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def compared(t: pa.Table) -> Iterator[pa.RecordBatch]:
            u, v = np.asarray(t.column("u")), np.asarray(t.column("v"))
            fresh, low = np.asarray(t.column("fresh")), np.asarray(t.column("low"))
            raw = t.column("unit").to_pylist()
            edges = np.append(np.flatnonzero(np.append(True, u[1:] != u[:-1])), len(u))
            a, b, cosine = [], [], []
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if e - s < 2:
                    continue
                x = np.frombuffer(b"".join(raw[s:e]), dtype="<f8").reshape(e - s, -1)
                c = x @ x.T
                enters = (c >= how.floor) & ((c > low[s:e][:, None]) | (c > low[s:e][None, :]) | (c >= how.threshold))
                i, j = np.nonzero(np.triu(enters & (fresh[s:e][:, None] | fresh[s:e][None, :]), 1))
                a.append(v[s:e][i])
                b.append(v[s:e][j])
                cosine.append(c[i, j])
            if a:
                yield _pairs(np.concatenate(a), np.concatenate(b), np.concatenate(cosine))

        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, t]) if held is not None and held.num_rows else t
            u = np.asarray(held.column("u"))
            cut = int(np.searchsorted(u, u[-1], side="left"))  # the last list may go on in the next batch
            yield from compared(held.slice(0, cut))
            held = held.slice(cut)
        if held is not None:
            yield from compared(held)

    return rows.mapInArrow(joined, "a long, b long, cosine double")


def tile_links(members: DataFrame, classes: DataFrame, how: Descent) -> DataFrame:
    """``node, links``: linked vectors in its component, copies counted, for the components ``root`` of ``members``."""
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / how.block).cast("int").alias("blocks"))
    rows = members.join(sizes, "root").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiled = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiled = tiled.withColumns({"x": F.least("mine", "other"), "y": F.greatest("mine", "other")})
    full = tiled.join(classes.select("node", "copies", "unit"), "node").select(
        "root", "x", "y", (F.col("mine") != F.col("x")).alias("second"), "node", "copies", "unit"
    )

    def counted(tile: pa.Table) -> pa.Table:
        x = _matrix(tile.column("unit"))
        node, copies = np.asarray(tile.column("node")), np.asarray(tile.column("copies"))
        second = np.asarray(tile.column("second"))
        left, right = np.flatnonzero(~second), np.flatnonzero(second)
        if len(right):
            near = (x[left] @ x[right].T >= how.threshold).astype(np.int64)
            links = np.concatenate([near @ copies[right], near.T @ copies[left]])
            node = np.concatenate([node[left], node[right]])
        elif tile.column("x")[0] == tile.column("y")[0]:
            near = (x @ x.T >= how.threshold).astype(np.int64)
            np.fill_diagonal(near, 0)
            links = near @ copies
        else:
            links = np.zeros(len(node), dtype=np.int64)
        return pa.table({"node": node, "links": links})

    made = full.groupBy("root", "x", "y").applyInArrow(counted, "node long, links long")
    return made.groupBy("node").agg(F.sum("links").alias("links"))


def all_links(classes: DataFrame, roots: DataFrame, how: Descent) -> tuple[DataFrame, DataFrame]:
    """(links ``a, b`` that join the components ``roots``, ``node, links`` of all vectors), every vector compared with all."""
    sizes = classes.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / how.wide).cast("int").alias("blocks"))
    rows = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(sizes, "dims")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiled = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiled = tiled.withColumns({"x": F.least("mine", "other"), "y": F.greatest("mine", "other")})
    full = tiled.select("dims", "x", "y", (F.col("mine") != F.col("x")).alias("second"), "root", "node", "copies", "unit")

    def compared(tile: pa.Table) -> pa.Table:
        node, copies = np.asarray(tile.column("node")), np.asarray(tile.column("copies"))
        x, second = _matrix(tile.column("unit")), np.asarray(tile.column("second"))
        group = np.unique(np.asarray(tile.column("root")), return_inverse=True)[1]
        one = tile.column("x")[0] == tile.column("y")[0]
        left = np.flatnonzero(~second)
        right = left if one else np.flatnonzero(second)
        links, a, b = np.zeros(len(node), dtype=np.int64), [], []
        for s in range(0, len(left), how.block):
            for t in range(s if one else 0, len(right), how.block):
                i, j = left[s : s + how.block], right[t : t + how.block]
                near = x[i] @ x[j].T >= how.threshold
                if one and s == t:
                    np.fill_diagonal(near, False)
                links[i] += near @ copies[j]
                if not (one and s == t):
                    links[j] += near.T @ copies[i]
                at, to = np.nonzero(near & (group[i][:, None] != group[j][None, :]))
                # Of the links between two components one is enough.
                first = np.unique(np.column_stack([group[i[at]], group[j[to]]]), axis=0, return_index=True)[1]
                for u, v in zip(i[at[first]], j[to[first]], strict=True):
                    if group[u] != group[v]:
                        a.append(node[u])
                        b.append(node[v])
                        group[group == group[v]] = group[u]
        some = np.flatnonzero(links)
        none = pa.nulls(len(some), pa.int64())
        counted = pa.table({"a": pa.array(node[some]), "b": none, "links": pa.array(links[some])})
        joined = pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "links": pa.nulls(len(a), pa.int64())})
        return pa.concat_tables([counted, joined])

    made = spool(full.groupBy("dims", "x", "y").applyInArrow(compared, "a long, b long, links long"))
    counts = made.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    return made.filter("b IS NOT NULL").select("a", "b"), counts


def true_links(classes: DataFrame, of: DataFrame, how: Descent) -> DataFrame:
    """``node, truth``: links of at most ``audited`` vectors among ``of``, by comparison with all, in blocks."""
    chosen = of.select("node", "unit").orderBy(F.xxhash64("node"), "node").limit(how.audited).collect()
    by_size: dict[int, tuple[list[int], list[bytes]]] = {}
    for r in chosen:
        ids, raw = by_size.setdefault(len(r["unit"]), ([], []))
        ids.append(r["node"])
        raw.append(bytes(r["unit"]))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, node, copies = batch.column("unit").to_pylist(), np.asarray(batch.column("node")), np.asarray(batch.column("copies"))
            for size, (ids, theirs) in by_size.items():
                mine = [i for i, r in enumerate(raw) if len(r) == size]
                for s in range(0, len(mine), how.block):
                    part = mine[s : s + how.block]
                    x = np.frombuffer(b"".join([raw[i] for i in part]), dtype="<f8").reshape(len(part), -1)
                    q = np.frombuffer(b"".join(theirs), dtype="<f8").reshape(len(ids), -1)
                    near = (q @ x.T >= how.threshold) & (np.array(ids)[:, None] != node[part][None, :])
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(near @ copies[part], pa.int64())], ["node", "truth"])

    made = classes.select("node", "copies", "unit").mapInArrow(counted, "node long, truth long")
    return spool(made.groupBy("node").agg(F.sum("truth").alias("truth")))


def audited_recall(classes: DataFrame, members: DataFrame, counts: DataFrame, how: Descent) -> float | None:
    """The mean share of a vector's links that was found, outside of ``members`` or inside, whichever is lower.

    None if no audited vector has a link: then nothing was measured.
    """
    lowest = None
    for side in ("left_anti", "left_semi"):
        truth = true_links(classes, classes.join(members, "node", side), how).filter("truth > 0")
        share = F.least(F.coalesce("links", F.lit(0)), F.col("truth")) / F.col("truth")
        mean = truth.join(counts, "node", "left").agg(F.avg(share)).first()[0]
        if mean is not None:
            lowest = float(mean) if lowest is None else min(lowest, float(mean))
    return lowest


def near_vectors(vectors: DataFrame, how: Descent = Descent()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` and ``audit_recall``, the same in all rows.

    ``audit_recall`` is null where no audited vector has a link.

    Defined results: null or empty vectors, those with null or non-finite
    components and zero vectors have no links and are kept; only vectors of one
    length are compared; repeated rows and equal vectors are linked; null ids
    name no component unless nothing else is in it; an empty table gives no
    rows; other columns are not looked at.
    """
    placed, classes = unit_classes(vectors)
    goes, passes = 0, how.passes(classes.count())
    pairs = None
    while passes > goes * how.tables:  # a go at a time, to hold few copies of the vectors at once
        found = sorted_neighbours(classes, how, goes, min(how.tables, passes - goes * how.tables)).withColumn("round", F.lit(0))
        pairs, goes = merged(found if pairs is None else pairs.unionByName(found)), goes + 1
    last, recall = 0, None
    for turn in range(how.repeats + 1):
        for _ in range(how.rounds):
            lists = spool(neighbour_lists(pairs, how))
            more = neighbours_of_neighbours(lists, classes, how, last).withColumn("round", F.lit(last + 1))
            grown = merged(pairs.unionByName(more))
            new = grown.filter(F.col("round") == last + 1).count()
            pairs, last = grown, last + 1
            if new == 0 or new * 1000 < pairs.count():
                break
        links = pairs.filter(F.col("cosine") >= how.threshold).select("a", "b")
        roots = components(links)
        lists = neighbour_lists(pairs, how)
        full = lists.filter("full").select(F.col("u").alias("node")).distinct().join(roots, "node").select("root").distinct()
        copies = classes.select(F.col("node").alias("v"), "copies")
        both = links.select(F.col("a").alias("node"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("v")))
        listed = both.join(copies, "v").groupBy("node").agg(F.sum("copies").alias("links"))
        members = roots.join(full, "root", "left_semi")
        outside = listed.join(members, "node", "left_anti")
        counts = spool(outside.unionByName(tile_links(members, classes, how)))
        recall = audited_recall(classes, members, counts, how)
        if recall is None or recall >= how.recall:
            break
        if turn == how.repeats:
            joined, counts = all_links(classes, roots, how)
            roots, counts, recall = components(links.unionByName(joined)), spool(counts), 1.0
            break
        last += 1
        pairs = merged(pairs.unionByName(sorted_neighbours(classes, how, goes, how.tables).withColumn("round", F.lit(last))))
        goes += 1
    named = classes.select("node", "vec_id", "copies").join(roots, "node", "left").join(counts, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    known = named.join(names, "root").select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = placed.filter("node IS NOT NULL").join(known, "node", "left")
    out = out.unionByName(placed.filter("node IS NULL"), allowMissingColumns=True)
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
        F.lit(recall).cast("double").alias("audit_recall"),
    )
