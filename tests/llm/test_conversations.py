"""Conversation repair against all edits, all splits and a plain run from left to right."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from panelcast.llm.conversations import EMPTY, TERMINALS, Spans, carried_out, damaged, joined, parsed, parses, repair_report, repaired_rows

SCHEMA = "conv_id long, turn long, role string, text string, task string, n int"
ROLES = {"s": "system", "u": "user", "a": "assistant", "": "tool"}


def fault_of(rows):
    """First fault of each (role, text) row in order."""
    seen, out = set(), []
    for role, text in rows:
        body = text.translate({ord(c): None for c in " \t\n\x0b\x0c\r"})
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(rows, faults):
    """The least (cost, audit) by trying every sequence of edits with up to two insertions in a row."""
    inserts = [(n, r) for n in range(3) for r in itertools.product("ua", repeat=n)]
    best = None
    choices = []
    for (role, _), fault in zip(rows, faults):
        own = [("D", "", 3)]
        if fault not in ("blank", "duplicate"):
            extra = fault == "truncated"
            own += [("K", role[:1] or "?", extra), ("R", "u", 2 + extra), ("R", "a", 2 + extra)]
        choices.append([("I" * n + e, "".join(r) + made, 2 * n + c) for n, r in inserts for e, made, c in own])
    choices.append([("I" * n, "".join(r), 2 * n) for n, r in inserts])
    for pick in itertools.product(*choices):
        if re.fullmatch("(s?(ua)+)?", "".join(p[1] for p in pick)):
            found = (sum(p[2] for p in pick), "".join(p[0] for p in pick))
            best = found if best is None or found < best else best
    return best


def cells_of(rows, faults):
    return [TERMINALS[r[:1] if r[:1] in ("s", "u", "a") else "", f in ("blank", "duplicate"), f == "truncated"] for (r, _), f in zip(rows, faults)]


def plain(rows):
    """(blank, duplicate, truncated, illegal, cost, audit, digest), combined from left to right."""
    faults = fault_of(rows)
    cell = EMPTY
    for one in cells_of(rows, faults):
        cell = joined(cell, one)
    cost, audit = parsed(joined(cell, EMPTY))
    lines = [f"{role}:{text}" for _, role, text in carried_out(audit, rows)]
    initials = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (*(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def random_rows(rng, n):
    return [(rng.choice([*ROLES.values(), "user", "assistant"]), rng.choice(["", " ", "one.", "two", "three!", f"{rng.random()}?", f"{rng.random()}"])) for _ in range(n)]


def test_cheapest_edits_of_short_conversations():
    rng = random.Random(5)
    for n in [1] * 20 + [2] * 40 + [3] * 12:
        rows = random_rows(rng, n)
        faults = fault_of(rows)
        cost, audit = plain(rows)[4:6]
        assert (cost, audit) == all_edits(rows, faults), rows


def test_every_split_of_a_span_gives_one_cell():
    rng = random.Random(6)
    for _ in range(25):
        rows = random_rows(rng, 11)
        cells = cells_of(rows, fault_of(rows))
        table = {(i, i + 1): c for i, c in enumerate(cells)}
        for size in range(2, 12):
            for i in range(12 - size):
                splits = [joined(table[i, k], table[k, i + size]) for k in range(i + 1, i + size)]
                assert all(s == splits[0] for s in splits)
                table[i, i + size] = splits[0]
        spans = Spans()
        for c in cells:
            spans.push(c)
        assert spans.whole() == joined(table[0, 11], EMPTY)


def test_repairs_obey_the_grammar():
    rng = random.Random(7)
    for _ in range(200):
        rows = random_rows(rng, rng.randint(0, 40))
        spans = Spans()
        for c in cells_of(rows, fault_of(rows)):
            spans.push(c)
        cost, audit = parsed(spans.whole())
        assert (cost, audit) == plain(rows)[4:6]
        made = list(carried_out(audit, rows))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for _, r, _ in made))
        assert len(audit.replace("I", "")) == len(rows)


def same(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    """Expected report rows by conversation from (conv_id, turn, role, text)."""
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, same(r[1], r[2])))
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *plain([r[1:] for r in own]))
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.fixture(scope="module")
def awkward_rows():
    rng = random.Random(8)
    rows = [
        (1, 0, None, "Hi."), (1, None, "user", None), (1, None, None, None), (1, 3, "assistant", "A" * 200_000), (1, 3, "assistant", "A" * 200_000),
        (None, 1, "user", "x."), (None, 1, "user", "x."), (None, 2, "assistant", "y"), (2, None, "system", "s."), (3, -4, "", "odd 👍."),
        (3, 9, "user", "same."), (3, 9, "user", "same."), (3, 9, "assistant", "other."),
    ]
    rows += [(4, t, *r) for t, r in enumerate(random_rows(rng, 3000))]
    rows += [(c, t, *r) for c in range(10, 200) for t, r in enumerate(random_rows(rng, rng.randint(1, 9)))]
    return rows


@pytest.fixture
def small_ranges(spark):
    """Ranges stay as they are dealt, so that conversations are cut by them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_frames_against_brute_force(spark, awkward_rows, small_ranges):
    df = spark.createDataFrame([(*r, "mine", 1) for r in awkward_rows], SCHEMA).repartition(7)
    got = {r.conv_id: tuple(r[n] for n in NAMES) for r in repair_report(df, df).collect()}
    assert got == brute(awkward_rows)
    found = {r.conv_id: r.audit for r in parses(df).collect()}
    lines = {}
    for r in repaired_rows(df).collect():
        lines.setdefault(r.conv_id, []).append((r.place, r.edit, r.role, r.text))
    for conv, audit in found.items():
        own = sorted(lines.get(conv, []))
        assert [p for p, *_ in own] == list(range(len(own))) and "".join(e for _, e, *_ in own) == audit.replace("D", "")
        text = "\n".join(f"{role}:{text}" for _, _, role, text in own)
        assert hashlib.sha256(text.encode()).hexdigest() == got[conv][-1]


def test_a_long_conversation_is_parsed_by_several_tasks(spark, small_ranges):
    from panelcast.llm.conversations import _marked, _rows, _stretches

    rng = random.Random(9)
    rows = [(4, t, *r) for t, r in enumerate(random_rows(rng, 20_000))]
    df = spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA)
    assert _stretches(_marked(_rows(df))).count() > 1
    assert {r.conv_id: tuple(r[n] for n in NAMES) for r in repair_report(df, df).collect()} == brute(rows)


def test_damage_follows_the_checksum(spark, awkward_rows):
    df = spark.createDataFrame([(*r, "mine", 1) for r in awkward_rows], SCHEMA)
    want = []
    for conv, turn, role, text in awkward_rows:
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        want += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    got = [tuple(r) for r in damaged(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    report = {r.conv_id: tuple(r[n] for n in NAMES) for r in repair_report(df, damaged(df)).collect()}
    expected = brute(want)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert report == {c: expected.get(c, nothing) for c in {r[0] for r in awkward_rows}}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair_report(df, damaged(df)).count() == 0 and repaired_rows(df).count() == 0
