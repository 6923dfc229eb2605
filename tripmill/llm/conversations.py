"""Repair of conversations at the least cost, by dynamic programming over a grammar.

A repaired conversation is empty, or an optional system message and then user and assistant
in turn, ending with the assistant. What a row lets be done depends on its role's initial
and its fault only, so a conversation is a short string over twenty symbols. Re-Pair turns
the pairs of symbols that the conversations share most into symbols of their own, again and
again. Each symbol, given or made, has one min-plus transfer matrix: for every state before
and after it the least cost, and the edits that have it as a rope that shares its parts with
the ropes of the symbols it is made of. A rule's matrix is the product of its two symbols',
worked out once for all conversations; a conversation's is what is left to multiply.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import column, in_batches, map_arrow, written

# What an edit costs, and what a truncated row that stays adds.
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1

# Rules made at a time at most, and how often: a rule stands for up to 2 ** ROUNDS rows.
RULES_A_ROUND = 8
ROUNDS = 12

# Initials that count (an empty role has none), and faults; a symbol is one of each.
INITIALS = ("s", "u", "a", "", "other")
FAULTS = ("none", "truncated", "blank", "duplicate")
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

# Code points of symbols: given ones from here on, then the rules'.
FIRST_SYMBOL = 0xE000
FIRST_RULE = FIRST_SYMBOL + len(INITIALS) * len(FAULTS)

# States: nothing yet, after the system message, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
ENDS = (START, ASSISTANT)
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
# What a row made or put there becomes, by the state before it.
_TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}

# What a text without anything else is blank of.
BLANKS = " \t\n\x0b\x0c\r"

_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class Rope:
    """A text made of two others, which it shares. Ropes of one length are compared by
    hashes of prefixes, without being written out."""

    __slots__ = ("left", "right", "leaf", "size", "hash")

    def __init__(self, leaf: str = "", left: Rope | None = None, right: Rope | None = None) -> None:
        self.leaf, self.left, self.right = leaf, left, right
        if left is None:
            self.size, self.hash = len(leaf), 0
            for letter in leaf:
                self.hash = (self.hash * _BASE + ord(letter)) % _PRIME
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * pow(_BASE, right.size, _PRIME) + right.hash) % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not other.size:
            return self
        if not self.size:
            return other
        if self.size + other.size <= 16:
            return Rope(str(self) + str(other))
        return Rope(left=self, right=other)

    def __str__(self) -> str:
        parts, waiting = [], [self]
        while waiting:
            rope = waiting.pop()
            if rope.left is None:
                parts.append(rope.leaf)
            else:
                waiting += [rope.right, rope.left]
        return "".join(parts)

    def _prefix(self, size: int) -> int:
        """Hash of the first ``size`` letters."""
        found, rope = 0, self
        while rope.left is not None and size < rope.size:
            if size <= rope.left.size:
                rope = rope.left
            else:
                found = (found * pow(_BASE, rope.left.size, _PRIME) + rope.left.hash) % _PRIME
                size -= rope.left.size
                rope = rope.right
        if size >= rope.size:
            return (found * pow(_BASE, rope.size, _PRIME) + rope.hash) % _PRIME
        for letter in rope.leaf[:size]:
            found = (found * _BASE + ord(letter)) % _PRIME
        return found

    def _letter(self, place: int) -> str:
        rope = self
        while rope.left is not None:
            if place < rope.left.size:
                rope = rope.left
            else:
                place -= rope.left.size
                rope = rope.right
        return rope.leaf[place]

    def __lt__(self, other: Rope) -> bool:
        low, high = 0, min(self.size, other.size)
        if self._prefix(high) == other._prefix(high):
            return self.size < other.size
        while high - low > 1:  # equal up to low, not up to high
            middle = (low + high) // 2
            if self._prefix(middle) == other._prefix(middle):
                low = middle
            else:
                high = middle
        return self._letter(low) < other._letter(low)

    def __eq__(self, other) -> bool:
        return self.size == other.size and self.hash == other.hash

    __hash__ = None


# A matrix has (cost, rope) per state before and state after where there is a way. Of equal
# costs the rope that comes first counts. That may be settled in every part by itself: two
# ropes for the same rows, states and cost differ in a letter, as neither can be the other
# and more insertions, which cost.
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def _better(found: dict, place, cost: int, rope: Rope) -> None:
    best = found.get(place)
    if best is None or cost < best[0] or (cost == best[0] and rope < best[1]):
        found[place] = (cost, rope)


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: first ``a``, then ``b``."""
    found: Matrix = {}
    for (i, j), (cost_a, rope_a) in a.items():
        for k in STATES:
            step = b.get((j, k))
            if step is not None:
                _better(found, (i, k), cost_a + step[0], rope_a + step[1])
    return found


def _insertions() -> Matrix:
    """Insertions at one place: none, or one or two on to another state."""
    found: Matrix = {}
    for state in STATES:
        cost, rope, at, seen = 0, Rope(), state, set()
        while at not in seen:
            seen.add(at)
            _better(found, (state, at), cost, rope)
            cost, rope, at = cost + COSTS["I"], rope + Rope("I"), _TURN[at]
    return found


def _row(initial: str, fault: str) -> Matrix:
    """What can be done with a row itself."""
    found: Matrix = {(state, state): (COSTS["D"], Rope("D")) for state in STATES}
    if fault in ("blank", "duplicate"):
        return found
    more = TRUNCATED_COST if fault == "truncated" else 0
    for state in STATES:
        kept = state if initial == "" else _AFTER.get(initial, {}).get(state)
        if kept is not None:
            _better(found, (state, kept), COSTS["K"] + more, Rope("K"))
        _better(found, (state, _TURN[state]), COSTS["R"] + more, Rope("R"))
    return found


INSERTIONS = _insertions()
SYMBOLS = list(product(INITIALS, FAULTS))


def symbol(initial: str, fault: str) -> str:
    return chr(FIRST_SYMBOL + SYMBOLS.index((initial, fault)))


def matrices(rules: list[str]) -> dict[str, Matrix]:
    """The matrix of every given symbol and, bottom-up, of every rule (a pair of symbols)."""
    found = {symbol(*both): times(INSERTIONS, _row(*both)) for both in SYMBOLS}
    for number, (left, right) in enumerate(rules):
        found[chr(FIRST_RULE + number)] = times(found[left], found[right])
    return found


def compressed(sequence: str, rules: list[str]) -> str:
    for number, pair in enumerate(rules):
        sequence = sequence.replace(pair, chr(FIRST_RULE + number))
    return sequence


def cheapest(sequence: str, of: dict[str, Matrix]) -> tuple[int, str]:
    """The least cost of a sequence of symbols, and the first audit that has it."""
    now: Matrix = {(START, START): (0, Rope())}
    for letter in sequence:
        now = times(now, of[letter])
    now = times(now, INSERTIONS)
    best: dict = {}
    for end in ENDS:
        if (START, end) in now:
            _better(best, None, *now[START, end])
    cost, rope = best[None]
    return cost, str(rope)


def learn_rules(sequences: DataFrame) -> list[str]:
    """Re-Pair over a table of sequences (``sequence``): in every round the most frequent
    pairs, no two of which share a symbol, become rules. Bounded results reach the driver."""
    rules: list[str] = []
    for _ in range(ROUNDS):
        known = list(rules)

        def pairs(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            counts: Counter = Counter()
            for batch in batches:
                for sequence in batch.column(0).to_pylist():
                    short = compressed(sequence, known)
                    counts.update(a + b for a, b in zip(short, short[1:]))
            schema = pa.schema([("pair", pa.string()), ("copies", pa.int64())])
            yield from in_batches(counts.items(), schema)

        counted = map_arrow(sequences.select("sequence"), pairs, "pair string, copies long")
        most = counted.groupBy("pair").agg(F.sum("copies").alias("copies")).filter("copies > 1")
        taken: set[str] = set()
        for row in most.orderBy(F.desc("copies"), "pair").limit(8 * RULES_A_ROUND).collect():
            if len(rules) - len(known) < RULES_A_ROUND and not taken & set(row["pair"]):
                taken.update(row["pair"])
                rules.append(row["pair"])
        if len(rules) == len(known):
            break
    return rules


def _evaluated(sequences: DataFrame, rules: list[str]) -> DataFrame:
    """What every distinct sequence comes to."""
    schema = pa.schema(
        [("sequence", pa.string())]
        + [(name, pa.int64()) for name in ("blank", "duplicate", "truncated", "illegal", "cost")]
        + [("audit", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = matrices(rules)

        def rows():
            for batch in batches:
                for sequence in batch.column(0).to_pylist():
                    faults = Counter(SYMBOLS[ord(c) - FIRST_SYMBOL][1] for c in sequence)
                    initials = [SYMBOLS[ord(c) - FIRST_SYMBOL][0] for c in sequence]
                    illegal = sum(pair not in LEGAL for pair in zip(initials, initials[1:]))
                    cost, audit = cheapest(compressed(sequence, rules), of)
                    yield sequence, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit

        return in_batches(rows(), schema, size=lambda row: 64 + 4 * len(row[0]))

    return map_arrow(
        sequences.select("sequence"), run,
        "sequence string, blank long, duplicate long, truncated long, illegal long, cost long, audit string",
    )


_KEY = ["key", "no_key"]
_PLACE = ["turn_known", "turn", "role", "text_a", "text_b"]


def _rows(chats: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows with a key that is never NULL and a place in the conversation."""
    body = F.coalesce(column(text).cast("string"), F.lit(" "))
    number = column(turn).try_cast("long")
    return chats.select(
        F.coalesce(column(conv).cast("string"), F.lit("")).alias("key"),
        column(conv).isNull().alias("no_key"),
        number.isNotNull().alias("turn_known"),
        F.coalesce(number, F.lit(0).cast("long")).alias("turn"),
        F.coalesce(column(role).cast("string"), F.lit(" ")).alias("role"),
        F.xxhash64(F.lit(21), body).alias("text_a"),
        F.xxhash64(F.lit(22), body).alias("text_b"),
        body.alias("text"),
        (F.col("`__copies`") if "__copies" in chats.columns else F.lit(1)).cast("long").alias("copies"),
    )


def _sequences(rows: DataFrame) -> DataFrame:
    """(key, no_key, sequence): every conversation's symbols, in order.

    Equal rows are counted before they are shuffled. The order is made by a range
    partitioning over conversation and place, so that a long conversation is dealt to many
    tasks; of each only its string of symbols, a character a row, is put together.
    """
    last = F.rtrim(F.col("text"), F.lit(BLANKS))
    faults = (
        F.when(last == "", "blank").when(F.right(last, F.lit(1)).isin(".", "!", "?"), "none").otherwise("truncated")
    )
    narrow = rows.select(*_KEY, *_PLACE, "copies", faults.alias("fault"))
    distinct = narrow.groupBy(*_KEY, *_PLACE).agg(F.sum("copies").alias("copies"), F.first("fault").alias("fault"))
    same = Window.partitionBy(*_KEY, "role", "text_a", "text_b").orderBy("turn_known", "turn")
    first = distinct.withColumn("again", F.row_number().over(same) > 1)
    letter = F.substring("role", 1, 1)
    code = F.lit(len(INITIALS) - 1)
    for number, initial in enumerate(INITIALS[:-1]):
        code = F.when(letter == initial, number).otherwise(code)

    def sign(fault: Column) -> Column:
        number = F.lit(0)
        for place, name in enumerate(FAULTS):
            number = F.when(fault == name, place).otherwise(number)
        return F.element_at(F.array(*[F.lit(symbol(*both)) for both in SYMBOLS]), code * len(FAULTS) + number + 1)

    later = F.when(F.col("fault") == "blank", "blank").otherwise("duplicate")
    piece = F.concat(
        sign(F.when(F.col("again"), later).otherwise(F.col("fault"))),
        F.repeat(sign(later), (F.col("copies") - 1).cast("int")),
    )
    placed = written(first.select(*_KEY, *_PLACE, piece.alias("piece")), "symbols")
    dealt = placed.repartitionByRange(*_KEY, *_PLACE).withColumn("part", F.spark_partition_id())

    def put_together(by: list[str], order: list[str], part: str, name: str) -> list[Column]:
        held = F.array_sort(F.collect_list(F.struct(*order, part)))
        return [F.array_join(F.transform(held, lambda x: x[part]), "").alias(name)]

    chunks = dealt.groupBy(*_KEY, "part").agg(*put_together(_KEY, _PLACE, "piece", "chunk"))
    return chunks.groupBy(*_KEY).agg(*put_together(_KEY, ["part"], "chunk", "sequence"))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from a stream of its result and then its rows, in order:
    the repaired text is hashed as it comes, never held."""
    schema = pa.schema([("key", pa.string()), ("no_key", pa.bool_()), ("gaps", pa.int64()), ("repaired_sha256", pa.string())])

    def rows():
        now = None
        for batch in batches:
            columns = [batch.column(i) for i in range(7)]
            for key, no_key, audit, copies, turn, role, text in zip(*columns):
                if audit.is_valid:
                    if now is not None:
                        yield now.done()
                    now = _Repair(key.as_py(), no_key.as_py(), audit.as_py())
                else:
                    now.row(turn.as_py(), role.as_py(), text, copies.as_py())
        if now is not None:
            yield now.done()

    return in_batches(rows(), schema)


class _Repair:
    """A conversation's repair under way."""

    def __init__(self, key: str, no_key: bool, audit: str) -> None:
        self.key, self.no_key, self.audit, self.at = key, no_key, audit, 0
        self.state, self.hash, self.lines = START, hashlib.sha256(), 0
        self.low = self.high = self.turn = None
        self.turns = 0

    def line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1

    def insert(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = _TURN[self.state]
            self.line(_ROLE[self.state], "")
            self.at += 1

    def row(self, turn: int | None, role: str, text, copies: int) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high or self.high is None
            self.high = turn
        for _ in range(copies):
            self.insert()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "R":
                self.state = _TURN[self.state]
                self.line(_ROLE[self.state], text.as_py())
            elif edit == "K":
                self.state = _AFTER[role[0]][self.state] if role else self.state
                self.line(role, text.as_py())

    def done(self) -> tuple:
        self.insert()
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return self.key, self.no_key, gaps, self.hash.hexdigest()


def repair_conversations(
    chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    every: DataFrame | None = None,
) -> DataFrame:
    """One row per conversation: ``conv``, ``gaps`` (turns missing between the first and the
    last), the rows that are ``blank``, ``duplicate`` or ``truncated`` (a row's first fault
    counts), ``illegal`` (neighbours whose initials are not su, ua or au), the least ``cost``
    of a repair, its ``audit`` (K keep, R other role, D delete, I insert; of equal ones the
    first in ASCII) and ``repaired_sha256`` of its lines. Eager: symbols go to the shared
    scratch folder.

    Rows are in order of turn (NULL first), then role, then hashes of the text; a column
    ``__copies`` says that a row stands for as many. ``every`` names conversations (in a
    column ``conv``) that count also if they have no rows: zeros, no edits, the hash of
    nothing. NULL roles and texts are one space, so such a text is blank; a NULL ``conv`` is
    a conversation of its own. An empty role has no initial: keeping it changes nothing.
    Repeated rows are duplicates. Very long texts are hashed piece by piece; a very long
    conversation is ordered by many tasks, and only its symbols, its audit and one row at a
    time are held by one (the hash needs its rows one after the other). Other columns are
    not looked at. An empty table gives an empty one.
    """
    rows = _rows(chats, conv, turn, role, text)
    sequences = written(_sequences(rows), "sequences")
    distinct = written(sequences.select("sequence").distinct(), "distinct-sequences")
    found = written(_evaluated(distinct, learn_rules(distinct)), "repairs")
    known = (chats if every is None else every).select(column(conv).alias("conv")).select(
        F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("key"), F.col("conv").isNull().alias("no_key"), "conv"
    )
    known = known.groupBy(*_KEY).agg(F.first("conv").alias("conv"))
    results = known.join(sequences.join(found, "sequence"), _KEY, "left").drop("sequence")
    zeros = {name: F.coalesce(name, F.lit(0).cast("long")) for name in ("blank", "duplicate", "truncated", "illegal", "cost")}
    results = written(results.withColumns({**zeros, "audit": F.coalesce("audit", F.lit(""))}), "results")
    no = {"copies": "long", "turn": "long", "role": "string", "text": "string"}
    heads = results.select(
        *_KEY, "audit", *[F.lit(None).cast(kind).alias(name) for name, kind in no.items()],
        F.lit(0).alias("kind"), *[F.lit(None).cast(kind).alias(f"by_{name}") for name, kind in _ORDER.items()],
    )
    bodies = rows.select(
        *_KEY, F.lit(None).cast("string").alias("audit"), "copies",
        F.when(F.col("turn_known"), F.col("turn")).alias("turn"), "role", "text",
        F.lit(1).alias("kind"), *[F.col(name).alias(f"by_{name}") for name in _ORDER],
    )
    stream = heads.unionByName(bodies).repartition(*_KEY).sortWithinPartitions(
        *_KEY, "kind", *[f"by_{name}" for name in _ORDER]
    )
    hashed = map_arrow(
        stream.select(*_KEY, "audit", *no), _repaired, "key string, no_key boolean, gaps long, repaired_sha256 string"
    )
    return results.join(hashed, _KEY).select(
        F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


_ORDER = {"turn_known": "boolean", "turn": "long", "role": "string", "text_a": "long", "text_b": "long"}


def damage(
    chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` and ``__copies`` of rows damaged by a checksum of
    conversation and turn: of twenty, one is dropped, one loses its text, one its ``.!?``, one
    comes twice, one becomes the user's. NULL roles and texts, and NULLs in the checksum's
    text, are one space."""

    def plain(name: str) -> Column:
        return F.coalesce(column(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain(conv), F.lit(":"), plain(turn)).cast("binary")) % 20
    body = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("body", ".!?", "")).otherwise(F.col("body"))
    return (
        chats.select(
            column(conv).alias("conv"), column(turn).alias("turn"), plain(role).alias("role"), plain(text).alias("body"),
            kind.alias("kind"),
        )
        .filter("kind <> 0")
        .select(
            F.col("conv").alias(conv), F.col("turn").alias(turn),
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias(role), body.alias(text),
            F.when(F.col("kind") == 3, 2).otherwise(1).alias("__copies"),
        )
    )
