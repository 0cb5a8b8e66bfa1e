"""Secret scan: fixed patterns, and formats inferred from what they find.

The patterns (``base_spans``) find credentials by their surroundings or by a
known shape. Their values are the labelled credentials from which a grammar of
each kind is inferred: a prefix tree of the values, whose states are merged
where they are statistically compatible (ALERGIA, Carrasco and Oncina 1994),
becomes a probabilistic automaton. Two states are compatible if the shares of
every symbol, of every class of symbols and of the end differ by no more than
Hoeffding's bound, and so do the states behind them; of several compatible states
the one that makes the strings behind the new state likeliest takes it in, as rare
states are compatible with nearly all. One more automaton is
inferred from ordinary long tokens. Every other token of at least 12 characters,
wherever it stands, is then scored by the logarithm of its likelihood under the
best format against that under the ordinary automaton; where a format is likelier
by ``MARGIN`` a character, the token is added as a span of kind ``format``.

Texts are read once, by patterns, in one pass without a shuffle; it leaves the spans
and the tokens to score. Automata are fitted on the driver from bounded samples
(``SAMPLE`` values a kind, distinct, chosen by a hash; values of more than
``LONGEST`` characters are scored but not learnt from); scoring covers every token
of every text, whole.

Defined results: a null text is an empty one; texts without a match give empty
spans; a kind with fewer than ``LEAST`` distinct values has no automaton, and
without any automaton nothing is added; repeated rows are rows of their own; a
null id is kept; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.sources.spool import spool

# The kinds in their order, and the patterns that the contract of this scan names.
KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_LENGTH = {"assign": 8, "access": 16}
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")

SYMBOLS = 69  # the characters of a token and its end
SAMPLE = 1500
LEAST = 20
LONGEST = 128
CONFIDENCE = 0.05
MARGIN = 0.5
KNOWN, SIMILAR = 0.9, 0.08  # weights of a symbol's own share and of its class's in a probability
OUTSIDE = -1  # the state after something unseen


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the fixed patterns, by start and kind."""
    found = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_LENGTH["assign"]]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_LENGTH["access"]]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def other_tokens(text: str, taken: Sequence[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, token) of the long tokens that touch none of the spans ``taken``; dots around them are left out."""
    out, spans, k = [], sorted((s, e) for _, s, e, _ in taken), 0
    reach = -1
    for m in TOKEN.finditer(text):
        while k < len(spans) and spans[k][0] < m.end():
            reach = max(reach, spans[k][1])
            k += 1
        if reach > m.start():
            continue
        token = m[0].strip(".")
        if len(token) >= 12:
            start = m.start() + m[0].index(token)
            out.append((start, start + len(token), token))
    return out


# --------------------------------------------------------------------- automata


def _classes() -> dict[str, tuple[str, int]]:
    """Class of every symbol, and how many symbols the class has."""
    groups = ["0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", *"+/_.=-"]
    return {c: (g[0], len(g)) for g in groups for c in g}


CLASS = _classes()


class States:
    """A prefix tree with counts, whose states are merged until no two compatible ones are left."""

    def __init__(self, words: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]  # by symbol
        self.group: list[dict[str, int]] = [{}]  # by class
        self.stop = [0]
        self.total = [0]
        for word in words:
            at = 0
            for c in word:
                self._add(at, c, 1)
                if c not in self.next[at]:
                    self.next[at][c] = self._new()
                at = self.next[at][c]
            self.total[at] += 1
            self.stop[at] += 1

    def _new(self) -> int:
        for fields in (self.next, self.count, self.group):
            fields.append({})
        self.stop.append(0)
        self.total.append(0)
        return len(self.total) - 1

    def _add(self, s: int, c: str, n: int) -> None:
        name = CLASS[c][0]
        self.total[s] += n
        self.count[s][c] = self.count[s].get(c, 0) + n
        self.group[s][name] = self.group[s].get(name, 0) + n

    def alike(self, a: int, b: int, bound: float) -> bool:
        """Whether the shares of end, symbols and classes differ by no more than chance allows."""
        n, m = self.total[a], self.total[b]
        limit = bound * (n**-0.5 + m**-0.5)
        if limit >= 1:
            return True
        if abs(self.stop[a] / n - self.stop[b] / m) > limit:
            return False
        for mine, others in ((self.group[a], self.group[b]), (self.count[a], self.count[b])):
            for c in mine.keys() | others.keys():
                if abs(mine.get(c, 0) / n - others.get(c, 0) / m) > limit:
                    return False
        return True

    def compatible(self, a: int, b: int, bound: float) -> bool:
        """``alike`` for two states and all pairs of states that the same symbols lead to."""
        pairs = [(a, b)]
        while pairs:
            p, q = pairs.pop()
            if not self.alike(p, q, bound):
                return False
            if p != q:
                pairs += [(self.next[p][c], then) for c, then in self.next[q].items() if c in self.next[p]]
        return True

    def fit(self, a: int, b: int) -> float:
        """Log-likelihood of what lies behind ``b`` if it followed ``a``; out of the known states all symbols are equally likely."""
        total, pairs = 0.0, [(a, b)]
        while pairs:
            p, q = pairs.pop()
            if p == OUTSIDE:
                total -= self.total[q] * math.log(SYMBOLS)
                pairs += [(OUTSIDE, then) for then in self.next[q].values()]
                continue
            if self.stop[q]:
                total += self.stop[q] * math.log(self.end_share(p))
            for c, then in self.next[q].items():
                total += self.count[q][c] * math.log(self.share(p, c))
                pairs.append((self.next[p].get(c, OUTSIDE), then))
        return total

    def share(self, s: int, c: str) -> float:
        """Probability of a symbol: mixed from its own share, that of its class and an equal one for all."""
        name, size = CLASS[c]
        total = self.total[s]
        return (KNOWN * self.count[s].get(c, 0) + SIMILAR * self.group[s].get(name, 0) / size) / total + (1 - KNOWN - SIMILAR) / SYMBOLS

    def end_share(self, s: int) -> float:
        return (KNOWN + SIMILAR) * self.stop[s] / self.total[s] + (1 - KNOWN - SIMILAR) / SYMBOLS

    def fold(self, a: int, b: int) -> None:
        """Add the tree at ``b`` to the automaton at ``a``."""
        pairs = [(a, b)]
        while pairs:
            p, q = pairs.pop()
            self.stop[p] += self.stop[q]
            self.total[p] += self.stop[q]
            for c, n in self.count[q].items():
                self._add(p, c, n)
            for c, then in self.next[q].items():
                if c in self.next[p]:
                    pairs.append((self.next[p][c], then))
                else:
                    self.next[p][c] = then

    def merge(self, confidence: float) -> list[int]:
        """Merge compatible states, the most frequent ones first; the states that remain."""
        bound = math.sqrt(0.5 * math.log(2 / confidence))
        kept = [0]
        while True:
            inside = set(kept)
            edge = [(-self.total[then], s, c) for s in kept for c, then in self.next[s].items() if then not in inside]
            if not edge:
                return kept
            _, state, symbol = min(edge)
            new = self.next[state][symbol]
            alike = [old for old in kept if self.compatible(old, new, bound)]
            if alike:
                old = alike[0] if len(alike) == 1 else max(alike, key=lambda s: (self.fit(s, new), -s))
                self.next[state][symbol] = old
                self.fold(old, new)
            else:
                kept.append(new)


class Automaton:
    """A probabilistic automaton over the symbols of tokens: what is likely to follow, state by state.

    A symbol that a state has not seen leads where most of its class lead; one
    whose class is new to the state leads out. Outside all symbols are equally
    likely, or, with ``strict``, nothing is possible: a format has no place for them.
    """

    def __init__(self, words: Iterable[str], strict: bool = False, confidence: float = CONFIDENCE):
        self.outside = -math.inf if strict else -math.log(SYMBOLS)
        states = States(words)
        kept = states.merge(confidence)
        number = {s: i for i, s in enumerate(kept)}
        self.steps: list[dict[str, tuple[float, int]]] = []
        self.ends: list[float] = []
        for s in kept:
            usual: dict[str, tuple[int, int]] = {}
            for c, n in states.count[s].items():
                usual[CLASS[c][0]] = max(usual.get(CLASS[c][0], (0, 0)), (n, -number[states.next[s][c]]))
            step = {}
            for c, (name, _) in CLASS.items():
                then = number[states.next[s][c]] if c in states.next[s] else -usual[name][1] if name in usual else OUTSIDE
                step[c] = (math.log(states.share(s, c)), then)
            self.steps.append(step)
            self.ends.append(math.log(states.end_share(s)))

    def log_likelihood(self, token: str) -> float:
        at, total = 0, 0.0
        for i, c in enumerate(token):
            likely, at = self.steps[at][c]
            total += likely
            if at == OUTSIDE:
                return total + (len(token) - i) * self.outside
        return total + self.ends[at]


class Formats:
    """Automata of the kinds of credentials and one of ordinary tokens."""

    def __init__(self, credentials: dict[str, Sequence[str]], ordinary: Sequence[str], margin: float = MARGIN):
        self.kinds = {k: Automaton(words, strict=True) for k, words in credentials.items() if len(words) >= LEAST}
        self.ordinary = Automaton(ordinary) if ordinary else None
        self.margin = margin

    def score(self, token: str) -> float:
        """How much likelier the best format is than an ordinary token, in nats a character."""
        if not self.kinds:
            return -math.inf
        plain = self.ordinary.log_likelihood(token) if self.ordinary else -(len(token) + 1) * math.log(SYMBOLS)
        return (max(a.log_likelihood(token) for a in self.kinds.values()) - plain) / len(token)

    def likely(self, token: str) -> bool:
        return self.score(token) >= self.margin


# ------------------------------------------------------------------------ frames

_SPAN = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]
_OTHER = [("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]
_FOUND = "base array<struct<kind: string, start: long, end: long, value: string>>, others array<struct<start: long, end: long, value: string>>"


def found_by_patterns(docs: DataFrame) -> DataFrame:
    """``doc_id, base, others`` for every row: the patterns' spans and the other long tokens."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, others = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                base.append([dict(zip(("kind", "start", "end", "value"), s)) for s in spans])
                others.append([dict(zip(("start", "end", "value"), t)) for t in other_tokens(text or "", spans)])
            columns = [pa.array(base, pa.list_(pa.struct(_SPAN))), pa.array(others, pa.list_(pa.struct(_OTHER)))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "base", "others"])

    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, {_FOUND}")


def inferred_formats(found: DataFrame, size: int = SAMPLE, margin: float = MARGIN) -> Formats:
    """Automata from at most ``size`` distinct values a kind, and as many ordinary tokens.

    A value that a pattern has found anywhere is no ordinary token.
    """
    labelled = found.select(F.explode("base").alias("s")).select("s.kind", "s.value")
    plain = found.select(F.explode("others").alias("s")).select(F.lit("").alias("kind"), "s.value")
    values = labelled.unionByName(plain).filter(F.length("value") <= LONGEST).groupBy("value").agg(F.collect_set("kind").alias("kinds"))
    values = spool(values.withColumn("rank", F.xxhash64("value")))

    def sample(of: DataFrame, most: int) -> list[str]:
        return [r.value for r in of.orderBy("rank", "value").limit(most).select("value").collect()]

    credentials = {k: sample(values.filter(F.array_contains("kinds", k)), size) for k in KINDS if k != "format"}
    return Formats(credentials, sample(values.filter(F.col("kinds") == F.array(F.lit(""))), size), margin)


def secret_spans(docs: DataFrame, size: int = SAMPLE, margin: float = MARGIN) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of (kind, start, end, value, score).

    Starts and ends count code points, ends are exclusive; spans are in order
    of start and kind. ``score`` is null for the spans of the patterns.
    """
    found = spool(found_by_patterns(docs))
    formats = inferred_formats(found, size, margin)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, others in zip(batch.column("base").to_pylist(), batch.column("others").to_pylist()):
                spans = [s | {"score": None} for s in base]
                for t in others:
                    score = formats.score(t["value"])
                    if score >= formats.margin:
                        spans.append(t | {"kind": "format", "score": score})
                rows.append(sorted(spans, key=lambda s: (s["start"], KINDS.index(s["kind"]))))
            spans = pa.array(rows, pa.list_(pa.struct([*_SPAN, ("score", pa.float64())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), spans], ["doc_id", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(judge, f"doc_id {kind}, spans array<struct<kind: string, start: long, end: long, value: string, score: double>>")


def secret_report(spans: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` and ``n_format`` of ``secret_spans``' rows."""

    def told(of: Column) -> Column:
        return F.concat_ws(",", F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "format")
    counts = [number(kind) for kind in KINDS]
    return spans.select("doc_id", *counts[:3], F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"), counts[3])
