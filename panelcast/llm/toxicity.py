"""Toxicity by weak supervision.

Voters are words and word beginnings, once or twice in a text, mined from a bounded sample of labelled
rows, and a few patterns. A generative model of the votes of all documents
estimates by expectation maximisation how often each voter speaks up in toxic
and in clean texts and, along a tree of the strongest dependencies, how voters
follow each other, so that voters that repeat one another count once. Its
posterior labels, of the labelled rows and of a bounded sample of documents
without label, train a linear classifier over all mined terms, the words of
abuse and the patterns, which scores every text in one pass. Labels
serve to mine the terms and to choose the voters; in every round of the
maximisation the labelled rows weigh together as much as all documents, so that
the label model is half supervised; and they fit the final sigmoid.

Defined results: a null or empty text has no terms and gets the score of the
bias; repeated rows score alike; without labels of both classes every text gets
the smoothed share of label 1, which is 0.5 without any; an empty table gives no
rows; only id and text are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm import nbsvm
from panelcast.llm.quality import labelled_sample, remainder
from panelcast.llm.textkernels import LOWERED, prefix_sums, slices, span_hashes, string_buffers, word_spans
from panelcast.sources.spool import spool

SAMPLE = 8000  # labelled rows that terms and classifier are fitted on at most
FLAG = 0.7
UNLABELLED = 8000  # documents without label that the classifier is fitted on, about
TERMS = 20_000  # mined terms at most
PURE = 9  # times as many toxic as clean rows with a mined term
LEAST = 3  # toxic rows that a mined term occurs in at least, whatever the sample
VOTERS = 40
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes of a word's beginning
_WORD = np.uint64(0xA5A5A5A55A5A5A5A)  # tells a whole word from a beginning
_NO_LETTER = np.ones(256, dtype=bool)
_NO_LETTER[97:123] = False
_NO_LETTER[128:] = False

# Common words of abuse, one voter together.
ABUSE = (
    "bastard bitch bloody bullshit clown coward crap creep cretin damn degenerate disgrace disgusting dumb dumbass fool freak garbage hate "
    "idiot idiotic imbecile jerk loser lunatic moron moronic nasty pathetic pervert pig psycho retard rubbish scum scumbag shit shut sick "
    "slut stupid suck sucks swine trash traitor ugly useless vermin vile weirdo whore worthless wretch"
).split()


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), dtype=np.uint8)
    edges = np.cumsum([0] + [len(w.encode()) for w in words])
    return (span_hashes(data, edges[:-1], edges[1:]) ^ _WORD) & ~np.uint64(1)


def term_hashes(column: pa.Array) -> Iterator[tuple[int, int, bool, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, whether the last row is complete, row of each term, hash of each term) slice by slice."""
    starts, data = string_buffers(column)
    for first, stop, low, high in slices(starts, data):
        part = LOWERED[data[low:high]]
        texts = starts[first:stop] - low if stop - first > 1 or low == starts[first] else np.zeros(1, dtype=np.int64)
        start, end = word_spans(part, texts, _NO_LETTER)
        sums = prefix_sums(part)
        rows, hashes = [np.searchsorted(texts, start, side="right") - 1], [span_hashes(part, start, end, sums) ^ _WORD]
        for k in BEGINNINGS:
            long = end - start > k
            hashes.append(span_hashes(part, start[long], start[long] + k, sums))
            rows.append(rows[0][long])
        yield first, stop, high == starts[stop], np.concatenate(rows) + first, np.concatenate(hashes) & ~np.uint64(1)


class Lookup:
    """Which of some terms occur in each text; a term with the last bit set asks for two occurrences."""

    def __init__(self, terms: np.ndarray):
        terms = np.unique(terms)
        self.size = len(terms)
        self.base = np.unique(terms & ~np.uint64(1))
        self.once, self.twice = (np.full(len(self.base), -1, dtype=np.int64) for _ in range(2))
        at, again = np.searchsorted(self.base, terms & ~np.uint64(1)), (terms & np.uint64(1)) == 1
        self.once[at[~again]] = np.flatnonzero(~again)
        self.twice[at[again]] = np.flatnonzero(again)
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.base >> np.uint64(48)).astype(np.int64)] = True

    def rows(self, column: pa.Array) -> list[np.ndarray]:
        """For every text the sorted numbers of the terms in it, in the order of sorted terms."""
        none = np.zeros(0, dtype=np.int64)
        if not self.size:
            return [none] * len(column)
        hits = []
        for _, _, _, row, term in term_hashes(column):
            near = np.flatnonzero(self.maybe[(term >> np.uint64(48)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.base, term[near]), len(self.base) - 1)
            hit = self.base[at] == term[near]
            hits.append(row[near][hit] * np.int64(len(self.base)) + at[hit])
        pairs, n = np.unique(np.concatenate(hits) if hits else none, return_counts=True)
        owner, at = pairs // len(self.base), pairs % len(self.base)
        found = np.concatenate([self.once[at], np.where(n > 1, self.twice[at], -1)])
        owner = np.concatenate([owner, owner])[found >= 0]
        found = found[found >= 0]
        order = np.lexsort((found, owner))
        return np.split(found[order], np.searchsorted(owner[order], np.arange(1, len(column)))) if len(column) else []


def _with_repeats(held: list[np.ndarray]) -> np.ndarray:
    """The terms of a text, those that occur twice also with the last bit set."""
    terms, n = np.unique(np.concatenate(held), return_counts=True)
    return np.concatenate([terms, terms[n > 1] | np.uint64(1)])


def mined_terms(sample: DataFrame, limit: int | None = None) -> tuple[np.ndarray, tuple[int, int]]:
    """Hashes of the terms that stand for label 1, at most ``limit``, and how many rows have label 0 and 1."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = np.asarray(batch.column("label"))
            held: dict[int, list[np.ndarray]] = {}
            sums: list[list[np.ndarray]] = [[], []]
            for first, stop, whole, row, term in term_hashes(batch.column("text")):
                order = np.argsort(row, kind="stable")
                row, term = row[order], term[order]
                cuts = np.searchsorted(row, np.arange(first, stop + 1))
                for i in range(first, stop):
                    held.setdefault(i, []).append(term[cuts[i - first] : cuts[i - first + 1]])
                    if whole or i + 1 < stop:
                        sums[label[i]].append(_with_repeats(held.pop(i)))
            for y in (0, 1):
                if sums[y]:
                    terms, n = np.unique(np.concatenate(sums[y]), return_counts=True)
                    columns = [pa.array(terms.view(np.int64)), pa.array(np.full(len(n), y, dtype=np.int32)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, ["term", "label", "n"])

    counts = sample.select("text", "label").mapInArrow(counted, "term long, label int, n long")
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    per = counts.groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("ones"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("zeros"),
    )
    rate = (F.col("ones") + 0.5) / F.lit(toxic + 1.0)
    other = (F.col("zeros") + 0.5) / F.lit(clean + 1.0)
    z = F.log(rate / other) / F.sqrt(1 / (F.col("ones") + 0.5) + 1 / (F.col("zeros") + 0.5))
    strong = per.withColumn("z", z).filter((F.col("ones") >= LEAST) & (F.col("z") >= 2.5) & (F.col("ones") >= PURE * F.col("zeros")))
    found = strong.orderBy(F.desc("z"), "term").limit(limit or TERMS).select("term").collect()
    return np.array([r["term"] for r in found], dtype=np.int64).view(np.uint64), (clean, toxic)


def pattern_votes(column: pa.Array) -> np.ndarray:
    """Three votes per text: shouting in capitals, runs of exclamation or question marks, many such runs."""
    starts, data = string_buffers(column)
    votes = np.zeros((len(column), 3), dtype=bool)
    for i in range(len(column)):
        part = data[starts[i] : starts[i + 1]]
        if len(part) < 2:
            continue
        capital = int(np.count_nonzero((part >= 65) & (part <= 90)))
        small = int(np.count_nonzero((part >= 97) & (part <= 122)))
        mark = (part == 33) | (part == 63)
        runs = int(np.count_nonzero(mark[1:] & mark[:-1]))
        votes[i] = capital > small, runs > 0, runs * 100 > len(part)
    return votes


def chosen_voters(rows: list[np.ndarray], label: np.ndarray, terms: int, most: int) -> np.ndarray:
    """Terms that together cover the toxic rows, then the most frequent others whose rows differ."""
    member = [set() for _ in range(terms)]
    for i, row in enumerate(rows):
        if label[i] == 1:
            for t in row:
                member[t].add(i)
    chosen, covered = [], set()
    while len(chosen) < most // 2 and terms:
        gain = [len(m - covered) for m in member]
        best = int(np.argmax(gain))
        if gain[best] == 0:
            break
        chosen.append(best)
        covered |= member[best]
    seen = {frozenset(member[t]) for t in chosen}
    for t in sorted(range(terms), key=lambda t: -len(member[t])):
        if len(chosen) >= most:
            break
        if frozenset(member[t]) not in seen:
            seen.add(frozenset(member[t]))
            chosen.append(t)
    return np.array(chosen, dtype=np.int64)


@dataclass
class LabelModel:
    """Votes given the class, along a tree of voters."""

    prior: float
    parent: np.ndarray  # of each voter, -1 at roots
    chance: np.ndarray  # [class, parent's vote, voter]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Chance of class 1 for rows of votes."""
        over = np.where(self.parent >= 0, votes[:, self.parent], 0).astype(np.int64)
        index = np.arange(votes.shape[1])
        total = np.zeros((2, len(votes)))
        for y in (0, 1):
            p = self.chance[y][over, index[None, :]]
            total[y] = np.log(np.where(votes == 1, p, 1 - p)).sum(axis=1)
        odds = total[1] - total[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))


def unpacked(bits: np.ndarray, voters: int) -> np.ndarray:
    return ((bits[:, None] >> np.arange(voters)) & 1).astype(np.int64)


def dependency_tree(pair: np.ndarray, single: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Parents of the tree with the largest mutual information of votes within the classes."""
    m = single.shape[1]
    strength = np.zeros((m, m))
    n = total.sum()
    for y in (0, 1):
        both = pair[y] + 0.25
        a = single[y] + 0.5
        all_y = total[y] + 1.0
        for vi in (0, 1):
            for vj in (0, 1):
                if vi and vj:
                    joint = both
                elif vi:
                    joint = a[:, None] - both
                elif vj:
                    joint = a[None, :] - both
                else:
                    joint = all_y - a[:, None] - a[None, :] + both
                joint = np.maximum(joint, 1e-6)
                pi = (a if vi else all_y - a)[:, None] / all_y
                pj = (a if vj else all_y - a)[None, :] / all_y
                strength += joint / n * np.log(np.maximum(joint / all_y, 1e-12) / np.maximum(pi * pj, 1e-12))
    parent = np.full(m, -1)
    if not m:
        return parent
    best, link = strength[0].copy(), np.zeros(m, dtype=np.int64)
    inside = np.zeros(m, dtype=bool)
    inside[0] = True
    for _ in range(m - 1):
        best[inside] = -np.inf
        new = int(np.argmax(best))
        parent[new] = link[new] if best[new] > 1e-6 else -1
        inside[new] = True
        better = strength[new] > best
        better &= ~inside
        best[better], link[better] = strength[new][better], new
    return parent


def fitted_label_model(
    patterns: DataFrame, voters: int, lexicon: int, known: tuple[np.ndarray, np.ndarray] | None = None, rounds: int = 5
) -> LabelModel:
    """Expectation maximisation over the table ``bits, n`` of vote patterns of all documents.

    ``known`` are bits and labels of labelled rows. They hold the classes in
    place: together they weigh as much as all documents, so that what the
    classes mean does not drift to languages or styles.

    A round is one pass over the table that brings sums per class, voter and pair
    of voters back, whatever the number of patterns. It starts from the texts
    with a vote among the first ``lexicon`` voters.
    """

    def sums(model: LabelModel | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pair, single, total = np.zeros((2, voters, voters)), np.zeros((2, voters)), np.zeros(2)
            for batch in batches:
                votes, n = unpacked(np.asarray(batch.column("bits")), voters), np.asarray(batch.column("n")).astype(float)
                one = np.where(votes[:, :lexicon].any(axis=1), 0.95, 0.01) if model is None else model.posterior(votes)
                for y, q in ((0, (1 - one) * n), (1, one * n)):
                    pair[y] += (votes * q[:, None]).T @ votes
                    single[y] += q @ votes
                    total[y] += q.sum()
            flat = np.concatenate([pair.ravel(), single.ravel(), total])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["at", "v"])

        rows = patterns.mapInArrow(summed, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
        flat = np.zeros(2 * voters * voters + 2 * voters + 2)
        for r in rows:
            flat[r["at"]] = r["v"]
        cut = 2 * voters * voters
        pair, single, total = flat[:cut].reshape(2, voters, voters), flat[cut:-2].reshape(2, voters), flat[-2:]
        if known is not None and len(known[0]):
            votes = unpacked(known[0], voters)
            weight = total.sum() / len(votes)
            for y in (0, 1):
                mine = votes[known[1] == y]
                pair[y] += weight * (mine.T @ mine)
                single[y] += weight * mine.sum(axis=0)
                total[y] += weight * len(mine)
        return pair, single, total

    model = None
    for _ in range(rounds):
        pair, single, total = sums(model)
        parent = dependency_tree(pair, single, total)
        chance = np.zeros((2, 2, voters))
        index = np.arange(voters)
        for y in (0, 1):
            has = parent >= 0
            up = np.where(has, single[y][parent], 0.0)  # rows in which the parent votes
            both = np.where(has, pair[y][index, parent], 0.0)
            base = (single[y] + 0.1) / (total[y] + 1.0)
            chance[y, 1] = np.where(has, (both + 2 * base) / (up + 2), base)
            chance[y, 0] = np.where(has, (single[y] - both + 2 * base) / (total[y] - up + 2), base)
        prior = (total[1] + 1) / (total.sum() + 2)
        model = LabelModel(float(np.clip(prior, 1e-4, 0.5)), parent, np.clip(chance, 1e-6, 1 - 1e-6))
    return model


def toxicity_scorer(docs: DataFrame, labels: DataFrame, size: int = SAMPLE):
    """A function from a text column to scores, fitted on labels of ids whose remainder by 3 is not 1."""
    sample = spool(labelled_sample(docs, labels, "toxic", remainder(3) != 1, size).select("doc_id", "text", "label").limit(size))
    mined, (clean, toxic) = mined_terms(sample)
    if toxic < 3 or clean < 3 or not len(mined):
        model = nbsvm.constant_model((toxic + 1) / (clean + toxic + 2), 1)
        return lambda column: [model.score(np.zeros(0, dtype=np.int64))] * len(column)
    mined, abuse = np.unique(mined), np.unique(_hash_words(list(ABUSE)))
    terms = Lookup(np.concatenate([mined, abuse]))
    both = np.union1d(mined, abuse)
    place = np.full(terms.size, -1, dtype=np.int64)
    place[np.searchsorted(both, mined)] = np.arange(len(mined))
    abusive = np.isin(both, abuse)

    def read(text: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        """The mined terms of each text, and the votes of lexicon and patterns as bits."""
        found = terms.rows(text)
        votes = np.column_stack([[bool(abusive[r].any()) for r in found], pattern_votes(text)]) if len(text) else np.zeros((0, 4))
        return [place[r][place[r] >= 0] for r in found], votes.astype(np.int64) @ (1 << np.arange(4))

    def features(row: np.ndarray, extra: int) -> np.ndarray:
        return np.concatenate([row, [len(mined) + k for k in range(4) if extra >> k & 1]]).astype(np.int64)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, extra = read(batch.column("text"))
            packed = pa.array([r.astype("<i4").tobytes() for r in found], pa.binary())
            columns = [batch.column("doc_id"), batch.column("label"), packed, pa.array(extra, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "row", "extra"])

    def brought(df: DataFrame) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        got = df.select("doc_id", "label", "text").mapInArrow(matched, "doc_id long, label int, row binary, extra long").collect()
        got.sort(key=lambda r: (r["doc_id"], r["row"]))
        found = [np.frombuffer(r["row"], dtype="<i4").astype(np.int64) for r in got]
        return found, np.array([r["extra"] for r in got], dtype=np.int64), np.array([-1 if r["label"] is None else r["label"] for r in got], dtype=np.int64)

    rows, extra, truth = brought(sample)
    voters = chosen_voters(rows, truth, len(mined), VOTERS)
    lexicon, count = len(voters), len(voters) + 4
    number = np.full(len(mined), -1, dtype=np.int64)
    number[voters] = np.arange(lexicon)

    def pattern(row: np.ndarray, extra: int) -> int:
        bits = int(extra) << lexicon
        for v in number[row]:
            if v >= 0:
                bits |= 1 << int(v)
        return bits

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [pattern(r, e) for r, e in zip(*read(batch.column("text")), strict=True)]
            kinds, n = np.unique(np.array(bits, dtype=np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(n)], ["bits", "n"])

    patterns = spool(docs.select("text").mapInArrow(voted, "bits long, n long").groupBy("bits").agg(F.sum("n").alias("n")))
    bits = np.array([pattern(r, e) for r, e in zip(rows, extra, strict=True)], dtype=np.int64)
    label_model = fitted_label_model(patterns, count, lexicon, (bits, truth))
    # Documents without label in the sample, by a hash of their ids: about as many in a table of any size.
    total = patterns.agg(F.sum("n")).first()[0] or 0
    share = int(min(1.0, UNLABELLED / max(1, total)) * (1 << 30))
    others = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL").filter(remainder(3) != 1)
    others = others.filter(F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(1 << 30)) < share)
    others = others.join(sample.select("doc_id").distinct(), "doc_id", "left_anti").withColumn("label", F.lit(None).cast("int"))
    more, more_extra, _ = brought(others)
    more_bits = np.array([pattern(r, e) for r, e in zip(more, more_extra, strict=True)], dtype=np.int64)
    one = label_model.posterior(unpacked(np.concatenate([bits, more_bits]), count))
    label = (one > 0.5).astype(int)
    unsure = np.arange(len(one)) >= len(rows)
    every = [features(r, e) for r, e in zip([*rows, *more], np.concatenate([extra, more_extra]), strict=True)]
    given = np.where(unsure, label, np.concatenate([truth, np.zeros(len(more), dtype=np.int64)]))
    model = nbsvm.fit(every, label, len(mined) + 4, trust=np.abs(2 * one - 1), truth=given, unit=False, unsure=unsure)
    return lambda column: [model.score(features(r, e)) for r, e in zip(*read(column), strict=True)]


def score_toxicity(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    score = toxicity_scorer(docs, labels, size)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score(batch.column("text")), pa.float64())], ["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, "doc_id long, score double")
    return out.select(
        "doc_id",
        F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= FLAG).cast("int").alias("predicted"),
    )
