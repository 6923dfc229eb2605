"""Conversation repair against trying everything, and the grammar against plain products."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from tripmill.llm import conversations as C
from tripmill.llm import queries as L

PLACES = re.compile("(s?(ua)+)?")
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def judged(rows):
    """(role, text, fault) of damaged rows in order."""
    seen, out = set(), []
    for role, text in rows:
        solid = re.sub("[\x20\x09-\x0d]+$", "", text)
        if not solid:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = "none" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def tried(rows, inserted=2):
    """The least (cost, audit), and its lines, of all edits with few insertions at a place."""
    choices = [[]]
    some = [list(p) for n in range(inserted + 1) for p in product([("I", "user", ""), ("I", "assistant", "")], repeat=n)]
    for role, text, fault in rows:
        own = [("D", None, None)]
        if fault not in ("blank", "duplicate"):
            own += [("K", role, text), ("R", "user", text), ("R", "assistant", text)]
        choices.append([[*before, edit] for before in some for edit in own])
    choices[0] = [[]]
    best = None
    for parts in product(*choices[1:], some):
        edits = [e for part in parts for e in part]
        if not PLACES.fullmatch("".join(role[:1] for edit, role, _ in edits if edit != "D")):
            continue
        cost, at = 0, 0
        for edit, _, _ in edits:
            cost += C.COSTS[edit]
            if edit != "I":
                cost += edit != "D" and rows[at][2] == "truncated"
                at += 1
        lines = "\n".join(f"{role}:{text}" for edit, role, text in edits if edit != "D")
        found = (cost, "".join(e for e, _, _ in edits), lines)
        best = found if best is None else min(best, found)
    return best


def expected(rows):
    """The result of rows (turn, role, text) of one conversation, in plain Python."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    turns = [t for t, _, _ in rows if t is not None]
    faults = judged([(role, text) for _, role, text in rows])
    initials = [role[:1] for role, _, _ in faults]
    # Forward over states with whole audits: every best so far, row by row.
    ways = {0: (0, "", "")}

    def spread(ways):
        out = dict(ways)
        for _ in range(2):
            for state, (cost, audit, lines) in list(out.items()):
                after = 3 if state == 2 else 2
                new = (cost + 2, audit + "I", lines + ("user" if after == 2 else "assistant") + ":\n")
                out[after] = min(out.get(after, new), new)
        return out

    for role, text, fault in faults:
        new: dict = {}
        for state, (cost, audit, lines) in spread(ways).items():
            steps = [(state, 3, "D", "")]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                after = 3 if state == 2 else 2
                steps.append((after, 2 + more, "R", ("user" if after == 2 else "assistant") + f":{text}\n"))
                kept = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "": {s: s for s in range(4)}}.get(role[:1], {})
                if state in kept:
                    steps.append((kept[state], more, "K", f"{role}:{text}\n"))
            for after, plus, edit, line in steps:
                way = (cost + plus, audit + edit, lines + line)
                new[after] = min(new.get(after, way), way)
        ways = new
    cost, audit, lines = min(way for state, way in spread(ways).items() if state in (0, 3))
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *[sum(f == name for _, _, f in faults) for name in ("blank", "duplicate", "truncated")],
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256(lines[:-1].encode()).hexdigest(),
    )


def damaged(rows):
    """Rows (conv, turn, role, text) after the damage."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return out


def test_everything_tried_on_short_sequences():
    of = C.matrices([])
    chance = random.Random(5)
    every = list(product(("s", "u", "a", "x"), ("none", "truncated", "blank")))
    sequences = [s for n in range(3) for s in product(every, repeat=n)]
    sequences += [tuple(chance.choices(every, k=3)) for _ in range(12)] + [(("", "none"), ("u", "none"))]
    for sequence in sequences:
        rows = [(role, f"t{i}", fault) for i, (role, fault) in enumerate(sequence)]
        cost, audit, _ = tried(rows)
        assert C.cheapest("".join(C.symbol("other" if r == "x" else r, f) for r, f in sequence), of) == (cost, audit), sequence


def test_grammar_gives_what_plain_products_give(spark):
    chance = random.Random(11)
    sequences = ["".join(C.symbol(*s) for s in chance.choices(C.SYMBOLS, k=chance.randint(0, 60))) for _ in range(60)]
    sequences += [(C.symbol("u", "none") + C.symbol("a", "none")) * n for n in (1, 5, 700)]
    sequences.append("".join(C.symbol(*s) for s in chance.choices(C.SYMBOLS, k=3000)))
    rules = C.learn_rules(spark.createDataFrame([(s,) for s in sequences], "sequence string"))
    assert rules and len(C.compressed(sequences[-2], rules)) < 20
    plain, shared = C.matrices([]), C.matrices(rules)
    for sequence in sequences:
        assert C.cheapest(C.compressed(sequence, rules), shared) == C.cheapest(sequence, plain)


def test_ropes_compare_like_texts():
    chance = random.Random(2)
    texts = ["".join(chance.choices("DK", k=chance.randint(0, 40))) for _ in range(60)]
    texts += [t + "I" for t in texts[:20]] + texts[:10]

    def rope(text):
        if len(text) < 2:
            return C.Rope(text)
        cut = chance.randint(1, len(text) - 1)
        return C.Rope(left=rope(text[:cut]), right=rope(text[cut:]))

    ropes = [rope(t) for t in texts]
    for a, one in zip(texts, ropes):
        assert str(one) == a and str(one + one) == a + a
        for b, other in zip(texts, ropes):
            assert (one < other) == (a < b) and (one == other) == (a == b)


def test_query_against_plain_python(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in L.op11_conversation_repair(spark, sf_dir).collect()}
    after = damaged(rows)
    assert got == {conv: expected([r[1:] for r in after if r[0] == conv]) for conv in {r[0] for r in rows}}
    assert sum(row[1] > 0 for row in got.values()) > 5 and len({row[6] for row in got.values()}) > 20


SCHEMA = "conv_id string, turn long, role string, text string, key string, sequence int, `odd name` string"


@pytest.fixture(scope="module")
def odd(spark):
    chance = random.Random(9)
    rows = []
    for conv in ["a", "b", "", None, "long", "ü:1", "c", "d", "e"]:
        for turn in range(400 if conv == "long" else chance.randint(1, 9)):
            role = chance.choice(["user", "assistant", "system", "tool", None, "", "User"])
            text = chance.choice(["Yes.", "No!", " \t\n", None, "cut off", "Ä?", "\x1c", f"{conv} {turn}", "x" * 50_000 + "."])
            rows.append((conv, None if chance.random() < 0.1 else turn * 2, role, f"{text}{turn}." if text == "Yes." else text))
    rows += [("same", 1, "user", "the same.")] * 30 + [("wide", -(2**63), "user", "a."), ("wide", 2**63 - 1, "assistant", "b.")]
    seen, unique = set(), []
    for row in rows:  # one order only: at most one row per turn, or equal ones
        if (row[0], row[1]) not in seen or row[0] == "same":
            unique.append((*row, "k", 1, "o"))
        seen.add((row[0], row[1]))
    return spark.createDataFrame(unique, SCHEMA).repartition(5)


def test_odd_rows(odd):
    rows = [tuple(r)[:4] for r in odd.collect()]
    plain = [(c, t, *(" " if v is None else v for v in (r, x))) for c, t, r, x in rows]
    for given, table in ((plain, odd), (damaged(rows), C.damage(odd))):
        got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in C.repair_conversations(table, every=odd).collect()}
        for conv in {r[0] for r in rows}:
            want = expected([r[1:] for r in given if r[0] == conv])
            assert got[conv] == (min(want[0], 2**63 - 1), *want[1:]), conv
        assert len(got) == len({r[0] for r in rows})


def test_no_rows(odd):
    none = odd.filter("false")
    assert C.repair_conversations(none).collect() == [] == C.damage(none).collect()
    empty = hashlib.sha256(b"").hexdigest()
    got = C.repair_conversations(none, every=odd).select("conv_id", *COLUMNS).collect()
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", empty)} and len(got) == odd.select("conv_id").distinct().count()


def test_a_long_conversation_is_ordered_by_many_tasks(spark):
    turns = 30_000
    df = spark.range(turns).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat("id", F.lit(".")).alias("text"),
    ).repartition(16)
    row = C.repair_conversations(df).first()
    assert row["audit"] == "K" * turns and row["cost"] == 0 and row["gaps"] == 0
    lines = "\n".join(f"{'assistant' if i % 2 else 'user'}:{i}." for i in range(turns))
    assert row["repaired_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
