"""Repair of chat structure by weighted interval parsing.

A conversation is read by a grammar in Chomsky normal form whose terminals are
its rows. There is one nonterminal for every pair of states of the automaton of
``(s?(ua)+)?`` and one rule ``[p,r] -> [p,q] [q,r]`` for every state between.
The terminal rules of a row are Keep, Rerole and Delete; rows that are only
inserted enter by the closure of the empty span, worked into the terminals. A
cell of a span holds, for every nonterminal, the least (cost, audit).

Spans are combined bottom-up by their length, 1, 2, 4 and so on: since there is
a nonterminal for every pair of states, every split of a span gives the same
cell (``tests/llm/test_conversations.py`` holds that against all splits), so one
split each is enough and n rows take n - 1 combinations. The cost is a function
of the audit, and audits of one span hold one letter per row besides the
insertions; so of two audits of equal cost neither begins the other, and the
least audit of a span is the least left part followed by the least right part.

In Spark, slim rows are put in order of (conversation, turn) by ranges. Each
task parses the stretches of conversations that lie in its range, so one that
holds a third of all rows is parsed by many tasks; the cells of its stretches,
one per task, are combined by the same rule. Texts are shuffled once, in order,
behind a header row with the audit; they pass by one at a time. What stays in
one task is only what the result itself demands: the audit of a conversation is
one string, and SHA-256 reads a conversation from its start to its end.

Defined results: null role and text count as one space; null turns come first;
rows of one turn are in order of a hash of role and text; a null ``conv_id`` is
an id like any other; repeated rows are duplicates; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from panelcast.llm.exact_dedup import squeezed
from panelcast.sources.spool import spool

Cell = dict[tuple[int, int], tuple[int, str]]

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_KEPT = 1
#: The automaton of ``(s?(ua)+)?``: 0 at the start, 1 after s, 2 after u, 3 after a.
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTING = (0, 3)
STATES = range(4)
ADJACENT = ("su", "ua", "au")
SPOKEN = {"u": "user", "a": "assistant"}


# ------------------------------------------------------------------------ cells


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans: ``[p,r] -> [p,q] [q,r]``, the least (cost, audit) each."""
    out: Cell = {}
    for (p, r), ways in RULES.items():
        best = None
        for a, b in ways:
            if a in left and b in right:
                (c, x), (d, y) = left[a], right[b]
                if best is None or c + d < best[0] or (c + d == best[0] and x + y < best[1]):
                    best = (c + d, x + y)
        if best is not None:
            out[p, r] = best
    return out


def _inserted() -> Cell:
    """The closure of the empty span: the fewest insertions from state to state."""
    cell: Cell = {(p, p): (0, "") for p in STATES}
    while True:
        longer = dict(cell)
        for (p, q), (cost, audit) in cell.items():
            for (state, role), then in MOVES.items():
                new = (cost + COST[INSERT], audit + INSERT)
                if state == q and role in SPOKEN and ((p, then) not in longer or new < longer[p, then]):
                    longer[p, then] = new
        if longer == cell:
            return cell
        cell = longer


EMPTY = _inserted()
#: Nonterminals that derive anything, and their binary rules.
RULES = {(p, r): [((p, q), (q, r)) for q in STATES if (p, q) in EMPTY or (p, q) == (0, 1) if (q, r) in EMPTY or (q, r) == (0, 1)] for p in STATES for r in STATES}
RULES = {pair: ways for pair, ways in RULES.items() if ways}
NONTERMINALS = sorted(RULES)


def _terminal(initial: str, must_go: bool, truncated: bool) -> Cell:
    """The cell of one row: its edits, each with the insertions before it."""
    extra = TRUNCATED_KEPT if truncated else 0
    cell: Cell = {(p, p): (COST[DELETE], DELETE) for p in STATES}
    if not must_go:
        for (p, role), q in MOVES.items():
            if role in SPOKEN:
                cell[p, q] = (COST[REROLE] + extra, REROLE)
            if role == initial:
                cell[p, q] = (COST[KEEP] + extra, KEEP)
    return joined(EMPTY, cell)


INITIALS = ("s", "u", "a", "")
TERMINALS = {(i, gone, cut): _terminal(i, gone, cut) for i in INITIALS for gone in (False, True) for cut in (False, True)}


class Spans:
    """Cells of a growing span, combined bottom-up: equal lengths meet as soon as they are there.

    Holds one cell per power of two, whatever the number of rows.
    """

    def __init__(self) -> None:
        self.cells: list[tuple[int, Cell]] = []

    def push(self, cell: Cell) -> None:
        size = 1
        while self.cells and self.cells[-1][0] == size:
            cell = joined(self.cells.pop()[1], cell)
            size *= 2
        self.cells.append((size, cell))

    def whole(self) -> Cell:
        out = EMPTY
        for _, cell in reversed(self.cells):
            out = joined(cell, out)
        return out


def parsed(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the cheapest repair, given the cell of the whole conversation."""
    return min(cell[0, q] for q in ACCEPTING if (0, q) in cell)


def carried_out(audit: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of every repaired row, from the audit and the rows' (role, text) in order.

    The role of a rewritten or inserted row follows from the row before it.
    """
    rows, before = iter(rows), ""
    for edit in audit:
        role, text = next(rows) if edit != INSERT else ("", "")
        if edit == DELETE:
            continue
        if edit != KEEP:
            role = SPOKEN["a" if before == "u" else "u"]
        before = role[:1]
        yield edit, role, text


# ------------------------------------------------------------------------ frames


def _rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, same, role, text``; ``same`` is a hash of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumn("same", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))))


def _at() -> Column:
    """Where a row stands in its conversation; null turns first."""
    return F.struct(F.col("turn").isNotNull().alias("timed"), "turn", "row")


def _marked(rows: DataFrame) -> DataFrame:
    """Slim rows ``conv_id, turn, same, row, initial, blank, duplicate, truncated``."""
    body = squeezed(F.col("text"))
    slim = spool(
        rows.withColumn("body", body).select(
            "conv_id",
            "turn",
            "same",
            F.substring("role", 1, 1).alias("initial"),
            (F.col("body") == "").alias("blank"),
            (~F.substring("body", -1, 1).isin(".", "!", "?")).alias("open"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    repeated = slim.groupBy("conv_id", "same").agg(F.count(F.lit(1)).alias("n"), F.min(_at()).alias("first")).filter("n > 1")
    repeated = repeated.select(F.col("conv_id").alias("c"), F.col("same").alias("s"), "first")
    again = slim["conv_id"].eqNullSafe(repeated["c"]) & (slim["same"] == repeated["s"])
    rows = slim.join(repeated, again, "left").withColumn("later", F.coalesce(_at() > F.col("first"), F.lit(False)))
    return rows.select(
        "conv_id",
        "turn",
        "same",
        "row",
        "initial",
        "blank",
        (~F.col("blank") & F.col("later")).alias("duplicate"),
        (~F.col("blank") & ~F.col("later") & F.col("open")).alias("truncated"),
    )


_STRETCH = T.StructType(
    [
        T.StructField("task", T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")],
        T.StructField("first_initial", T.StringType()),
        T.StructField("last_initial", T.StringType()),
        T.StructField("cell", T.ArrayType(T.StructType([T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))),
    ]
)


class _Stretch:
    """What is known of a run of consecutive rows of one conversation."""

    def __init__(self, conv: object) -> None:
        self.conv, self.spans = conv, Spans()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.first_initial = self.last_initial = None

    def add(self, turn: int | None, initial: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if self.last_initial is None:
            self.first_initial = initial
        else:
            self.illegal += self.last_initial + initial not in ADJACENT
        self.last_initial = initial
        self.spans.push(TERMINALS[initial if initial in INITIALS else "", blank or duplicate, truncated])

    def row(self, task: int) -> dict:
        cell = self.spans.whole()
        names = ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first_initial", "last_initial")
        cells = [{"cost": c, "audit": a} for c, a in (cell.get(n, (None, None)) for n in NONTERMINALS)]
        return {"conv_id": self.conv, "task": task, "cell": cells} | {n: getattr(self, n) for n in names}


def _stretches(marked: DataFrame) -> DataFrame:
    """One row per conversation and task: counts and the cell of the rows that lie in the task's range."""
    order = ["conv_id", "turn", "same", "row"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, stretch, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for conv, *rest in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "blank", "duplicate", "truncated"))):
                if stretch is None or stretch.conv != conv:
                    if stretch is not None:
                        done.append(stretch.row(task))
                    stretch = _Stretch(conv)
                stretch.add(*rest)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=wanted)
                done = []
        if stretch is not None:
            yield pa.RecordBatch.from_pylist([stretch.row(task)], schema=wanted)

    schema = T.StructType([marked.schema["conv_id"], *_STRETCH.fields])
    wanted = to_arrow_schema(schema)
    return marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(parse, schema)


def _combined(stretches: DataFrame) -> DataFrame:
    """One row per conversation: the numbers of its stretches, and cost and audit of its cheapest repair."""
    parts = stretches.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*_STRETCH.fieldNames()))).alias("parts"))
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType(
        [stretches.schema["conv_id"], *[T.StructField(n, T.LongType()) for n in names], T.StructField("audit", T.StringType())]
    )

    def one(parts: list[dict]) -> dict:
        total = {n: sum(p[n] for p in parts) for n in ("blank", "duplicate", "truncated", "illegal")}
        turns, last_turn, first_turn, last, whole = 0, None, None, None, EMPTY
        for p in parts:
            turns += p["turns"] - (p["first_turn"] is not None and p["first_turn"] == last_turn)
            first_turn = p["first_turn"] if first_turn is None else first_turn
            last_turn = last_turn if p["last_turn"] is None else p["last_turn"]
            if last is not None:
                total["illegal"] += last + p["first_initial"] not in ADJACENT
            last = p["last_initial"]
            whole = joined(whole, {n: (c["cost"], c["audit"]) for n, c in zip(NONTERMINALS, p["cell"]) if c["cost"] is not None})
        cost, audit = parsed(joined(whole, EMPTY))
        gaps = 0 if first_turn is None else last_turn - first_turn + 1 - turns
        return total | {"gaps": gaps, "cost": cost, "audit": audit}

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(parts) for parts in batch.column("parts").to_pylist()]
            columns = [pa.array([f[n] for f in found], pa.string() if n == "audit" else pa.int64()) for n in (*names, "audit")]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], ["conv_id", *names, "audit"])

    return parts.mapInArrow(combine, schema)


def parses(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    ``gaps`` are turn numbers missing between the first and the last; the first
    fault of a row counts; ``illegal`` are neighbours whose role initials do
    not follow each other. The frame is written out, as it is read twice.
    """
    return spool(_combined(_stretches(_marked(_rows(conversations)))))


def _in_order(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """Every conversation's audit, then its rows in order, in one task one after the other."""
    heads = found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("same"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    rows = _rows(conversations).select("conv_id", F.lit(1).alias("kind"), "turn", "same", "role", "text")
    order = ["conv_id", "kind", "turn", "same"]
    return heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text")


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, Iterator[tuple[str, str]]]]:
    """(conversation, audit, its rows) of a stream in which every conversation begins with its audit."""
    flat = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text"))))
    head = next(flat, None)
    while head is not None:
        after: list = []

        def rows() -> Iterator[tuple[str, str]]:
            for row in flat:
                if row[1] == 0:
                    after.append(row)
                    return
                yield row[2], row[3]

        own = rows()
        yield head[0], head[3], own
        for _ in own:  # whatever the reader left
            pass
        head = after[0] if after else None


def repaired_rows(conversations: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: ``conv_id, place, edit, role, text``; ``place`` counts from 0, ``edit`` is K, R or I."""
    schema = T.StructType(
        [conversations.schema["conv_id"], T.StructField("place", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("edit", "role", "text")]]
    )
    wanted = to_arrow_schema(schema)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for conv, audit, rows in _each(batches):
            for place, (edit, role, text) in enumerate(carried_out(audit, rows)):
                out.append({"conv_id": conv, "place": place, "edit": edit, "role": role, "text": text})
                held += len(text)
                if len(out) >= 5000 or held > 1 << 23:
                    yield pa.RecordBatch.from_pylist(out, schema=wanted)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=wanted)

    return _in_order(conversations, parses(conversations) if found is None else found).mapInArrow(repair, schema)


def repaired_digests(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of the repaired ``role:text`` lines, joined by newlines; no line is held longer than it is read."""
    schema = T.StructType([conversations.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])
    wanted = to_arrow_schema(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for conv, audit, rows in _each(batches):
            sha = hashlib.sha256()
            for place, (_, role, text) in enumerate(carried_out(audit, rows)):
                sha.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            out.append({"conv_id": conv, "repaired_sha256": sha.hexdigest()})
            if len(out) >= 5000:
                yield pa.RecordBatch.from_pylist(out, schema=wanted)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=wanted)

    return _in_order(conversations, found).mapInArrow(digest, schema)


# ------------------------------------------------------------------- test damage


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4
    makes its role user. Nulls count as one space.
    """
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    fault = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).filter("fault <> 0")
    cut = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": cut, "role": F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))})
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text")


def repair_report(conversations: DataFrame, faulty: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``conversations``, with the parse of its rows in ``faulty`` and the digest of their repair."""
    found = parses(faulty)
    every = conversations.select("conv_id").distinct()
    digests = repaired_digests(faulty, found)
    whole = found.join(digests.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    out = every.join(whole.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    return out.fillna(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).fillna(
        {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    )
