"""Phrases whose words keep together, mined with Misra-Gries summaries.

Phrases of up to five words that occur often enough are found without counting them all.
Words and pairs, and then longer phrases of which every pair is frequent, are dealt to hash
partitions; in each, mergeable Misra-Gries summaries of the tasks' shares become one. Its
capacity exceeds the partition's mass divided by the threshold, so that what it undercounts
stays below the threshold and every frequent phrase survives. A second pass over the texts
counts the survivors exactly. A phrase's score compares its count with what its weakest cut
into two parts would give by chance.

What the tasks are told about frequent pairs and survivors is a bitmap of fixed size, which
may let some others pass, never fewer.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import column, in_batches, map_arrow, written

LEAST_COUNT = 100
MOST_WORDS = 5
TOP = 2000
NO_LANGUAGE = "und"

# Bytes of text a task holds as tokens at once, and of one text it takes at once.
LOT_BYTES = 8 << 20
SLICE_BYTES = 4 << 20

# Phrases a task counts before it sends them on.
HELD_PHRASES = 1 << 18

# Phrase occurrences a hash partition should hold, the fewest partitions, and how many times
# mass / threshold a summary's capacity is: the more, the tighter the survivors.
PART_MASS = 20_000_000
LEAST_PARTS = 64
HEADROOM = 4

# Bits of the map of frequent keys: 16 MB, whatever the input.
LOG_BITS = 27

# The characters that end a piece, and those between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

_STOP = b"."
_TABLE = bytes(
    ord(_STOP) if byte in PIECE_ENDS else 32 if byte in WORD_ENDS else byte + 32 if 65 <= byte <= 90 else byte
    for byte in range(256)
)
_CUT = re.compile(rb"[ .]")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def slices(text: bytes, most_words: int = MOST_WORDS) -> Iterator[tuple[bytes, int]]:
    """A text, lower-cased in A-Z, with a stop where a piece ends; a long one in slices cut
    between words. A slice begins with the last words of the one before, of which there are
    as many as given, so that no phrase is lost; what ends in them was counted there."""
    data = text.translate(_TABLE)
    start, tail = 0, []
    while start < len(data):
        end = len(data)
        if end - start > SLICE_BYTES:
            cut = _CUT.search(data, start + SLICE_BYTES)
            end = cut.start() if cut else end
        part = data[start:end].replace(_STOP, b" . ")
        yield b" ".join([*tail, part]), len(tail)
        start = end
        if start < len(data):
            tail = b" ".join([*tail, part]).rsplit(None, most_words - 1)[1 - most_words :]


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")


def _mixed(keys: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    keys = (keys ^ (keys >> np.uint64(30))) * _MIX[0]
    keys = (keys ^ (keys >> np.uint64(27))) * _MIX[1]
    return keys ^ (keys >> np.uint64(31))


def _hashes(words: pa.StringArray) -> np.ndarray:
    """64-bit hashes of words, none of them empty, worked out from their bytes at once."""
    _, ends, data = words.buffers()
    bounds = np.frombuffer(ends, np.int32)[: len(words) + 1].astype(np.int64)
    letters = np.frombuffer(data, np.uint8)[: bounds[-1]].astype(np.uint64)
    sizes = np.diff(bounds)
    powers = np.cumprod(np.full(sizes.max(), _ODD, np.uint64))
    place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], sizes)
    sums = np.add.reduceat((letters + np.uint64(1)) * powers[place], bounds[:-1])
    return _mixed(sums + sizes.astype(np.uint64))


class Tokens:
    """A lot of texts as arrays: word numbers, exact within the lot, word hashes, languages,
    and room to the next stop."""

    def __init__(self, texts: list[tuple[bytes, int, str]]) -> None:
        """Texts as (words and stops, words counted before, language)."""
        stopped = [text + b" " + _STOP for text, _, _ in texts]
        split = pc.split_pattern(pa.array(stopped, pa.binary()).cast(pa.string()), " ")
        every = split.flatten()
        solid = pc.not_equal(pc.binary_length(every), 0)
        upto = np.concatenate(([0], np.cumsum(solid.to_numpy(zero_copy_only=False))))
        bounds = upto[split.offsets.to_numpy()]
        coded = every.filter(solid).dictionary_encode()
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.hashed = _hashes(self.words)[self.ids]
        self.fresh = np.ones(len(self.ids), bool)
        for start, (_, counted, _) in zip(bounds.tolist(), texts):
            if counted:
                self.fresh[start : start + counted] = False
        stops = np.flatnonzero(self.ids == self.words.index(_STOP.decode()).as_py())
        self.room = np.repeat(stops, np.diff(stops, prepend=-1)) - np.arange(len(self.ids))
        self.langs = list(dict.fromkeys(lang for _, _, lang in texts))
        number = {lang: i for i, lang in enumerate(self.langs)}
        self.lang_of = np.repeat(np.array([number[lang] for _, _, lang in texts]), np.diff(bounds))
        self.seeds = np.array([_hash(lang) for lang in self.langs], np.uint64)[self.lang_of]

    def lang(self, at: int) -> str:
        return self.langs[self.lang_of[at]]

    @cached_property
    def names(self) -> list[str]:
        return self.words.to_pylist()

    def phrase(self, at: int, n: int) -> str:
        return " ".join([self.names[i] for i in self.ids[at : at + n].tolist()])

    def phrases(self, n: int, again: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """First tokens and keys of all phrases of ``n`` words that are to be counted, or of
        those counted before as well."""
        size = max(0, len(self.ids) - n + 1)
        fits = self.room[:size] >= n
        at = np.flatnonzero(fits if again else fits & self.fresh[n - 1 : n - 1 + size])
        keys = self.seeds[at] + np.uint64(n)
        for k in range(n):
            keys = _mixed(keys * _ODD + self.hashed[at + k])
        return at, keys


def in_lots(batches: Iterator[pa.RecordBatch], most_words: int = MOST_WORDS) -> Iterator[Tokens]:
    """(body, lang) rows as bounded lots of tokens."""
    held: list[tuple[bytes, int, str]] = []
    size = 0
    for batch in batches:
        bodies, langs = batch.column(0), batch.column(1).to_pylist()
        for i, lang in enumerate(langs):
            for part, counted in slices(bodies[i].as_buffer().to_pybytes(), most_words):
                held.append((part, counted, lang))
                size += len(part)
                if size >= LOT_BYTES:
                    yield Tokens(held)
                    held, size = [], 0
    if held:
        yield Tokens(held)


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


class Summary:
    """A Misra-Gries summary that can be merged: no count is too high, and none is too low
    by more than ``lost``, which is at most the mass divided by ``capacity`` + 1."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.lost = 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting_keys = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.waiting_keys += len(keys)
        if self.waiting_keys > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self.waiting]])
        self.waiting, self.waiting_keys = [], 0
        keys, counts = _summed(keys, counts)
        if len(keys) > self.capacity:
            place = len(keys) - self.capacity - 1
            cut = int(np.partition(counts, place)[place])
            self.lost += cut
            stay = counts > cut
            keys, counts = keys[stay], counts[stay] - cut
        self.keys, self.counts = keys, counts

    def survivors(self, least: int) -> np.ndarray:
        """All keys that may have occurred ``least`` times, those that did among them."""
        self.merge()
        return self.keys[self.counts + self.lost >= least]


def _is_set(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    places = keys >> np.uint64(64 - LOG_BITS)
    return (bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) == 1


def _given(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.coalesce(column(text).cast("string"), F.lit("")).alias("body"),
        F.coalesce(column(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
    ).filter("body <> ''")


def _bitmap(keys: DataFrame):
    """A broadcast bitmap of a table of keys (``key``); at most 2 ** LOG_BITS bits."""
    spark = keys.sparkSession
    place = F.shiftrightunsigned("key", 64 - LOG_BITS)
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    rows = (
        keys.select(place.alias("place"))
        .select(F.shiftright("place", 6).alias("cell"), bit.alias("bit"))
        .groupBy("cell")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    bits = np.zeros(1 << (LOG_BITS - 6), np.int64)
    bits[rows["cell"].to_numpy()] = rows["bits"].to_numpy()
    return spark.sparkContext.broadcast(bits.view(np.uint64))


_COUNTS = pa.schema(
    [("part", pa.int32()), ("lang", pa.string()), ("phrases", pa.list_(pa.string())), ("copies", pa.list_(pa.int64()))]
)
_PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
_SHARES = pa.schema(
    [("part", pa.int32()), ("data", pa.bool_()), ("mass", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
)


def _exact(tokens: Tokens, at: np.ndarray, keys: np.ndarray, n: int) -> Iterator[tuple[int, int, int]]:
    """(first token, copies, key) of the distinct phrases at ``at``; phrases that share a key
    are told apart by their words' numbers."""
    while len(at):
        _, first, group, copies = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        chosen = at[first][group]
        same = np.ones(len(at), bool)
        for k in range(n):
            same &= tokens.ids[at + k] == tokens.ids[chosen + k]
        if not same.all():
            copies = np.bincount(group[same], minlength=len(first))
        yield from zip(at[first].tolist(), copies.tolist(), keys[first].tolist())
        at, keys = at[~same], keys[~same]


def _part(keys, parts: int):
    """The hash partition of keys, which rises with them."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _shares(bits, lengths: range, parts: int) -> Callable:
    """Phrases of these lengths of which every pair is set in the bitmap (if there is one),
    summed up per hash partition, with the masses as rows of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value if bits is not None else None

        def rows():
            for tokens in in_lots(batches):
                if known is not None:
                    ok = np.zeros(len(tokens.ids) + MOST_WORDS, bool)
                    at, keys = tokens.phrases(2, again=True)
                    ok[at] = _is_set(known, keys)
                found = []
                for n in lengths:
                    at, keys = tokens.phrases(n)
                    if known is not None:
                        fits = ok[at]
                        for k in range(1, n - 1):
                            fits &= ok[at + k]
                        keys = keys[fits]
                    found.append(keys)
                keys, counts = _summed(np.concatenate(found))
                bounds = np.searchsorted(_part(keys, parts), np.arange(parts + 1, dtype=np.uint64))
                for number, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    if a < b:
                        share = counts[a:b].astype(np.uint32)
                        yield number, False, int(share.sum()), None, None
                        yield number, True, 0, keys[a:b].tobytes(), share.tobytes()

        return in_batches(rows(), _SHARES, size=lambda row: 64 + (len(row[3]) * 2 if row[3] else 0))

    return run


def _merged(least: int) -> Callable:
    """Survivors' keys of hash partitions that come one after the other, masses first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mass, summary = None, 0, None
        schema = pa.schema([("key", pa.int64())])

        def out(summary: Summary | None):
            if summary is not None:
                keys = summary.survivors(least).view(np.int64)
                for start in range(0, len(keys), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[start : start + (1 << 16)])], schema=schema)

        for batch in batches:
            parts, data = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            masses = batch.column(2).to_pylist()
            for i, part in enumerate(parts):
                if part != now:
                    yield from out(summary)
                    now, mass, summary = part, 0, None
                if not data[i]:
                    mass += masses[i]
                    continue
                if summary is None:
                    summary = Summary(HEADROOM * mass // least + 1)
                keys = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                counts = np.frombuffer(batch.column(4)[i].as_buffer(), np.uint32)
                summary.add(keys.copy(), counts.astype(np.int64))
        yield from out(summary)

    return run


def _phrase_counts(bits, most_words: int, parts: int) -> Callable:
    """The words and phrases set in the bitmap, counted exactly over a task's texts as far
    as they fit, in a row per hash partition and language; and, as a phrase without words,
    how many words a language has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bits.value

        def rows():
            held: dict[tuple[str, int, str], int] = {}

            def out():
                if not held:
                    return
                items = sorted(held.items())
                part = _part(np.array([key for (_, key, _), _ in items], np.uint64), parts).tolist()
                start = 0
                for end in range(1, len(items) + 1):
                    if end == len(items) or part[end] != part[start] or items[end][0][0] != items[start][0][0]:
                        some = items[start:end]
                        yield part[start], some[0][0][0], [phrase for (_, _, phrase), _ in some], [n for _, n in some]
                        start = end

            for tokens in in_lots(batches, most_words):
                for n in range(1, most_words + 1):
                    at, keys = tokens.phrases(n)
                    if n == 1:
                        for lang, copies in enumerate(np.bincount(tokens.lang_of[at]).tolist()):
                            total = tokens.langs[lang], 0, ""
                            held[total] = held.get(total, 0) + copies
                    fits = _is_set(known, keys)
                    for start, copies, key in _exact(tokens, at[fits], keys[fits], n):
                        phrase = tokens.lang(start), key, tokens.phrase(start, n)
                        held[phrase] = held.get(phrase, 0) + copies
                if len(held) > HELD_PHRASES:
                    yield from out()
                    held.clear()
            yield from out()

        return in_batches(rows(), _COUNTS, size=lambda row: 40 + 40 * len(row[2]))

    return run


def _added(least: int) -> Callable:
    """The exact counts of hash partitions that come one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            now, held = None, Counter()
            for batch in batches:
                for part, lang, phrases, copies in zip(*[column.to_pylist() for column in batch.columns]):
                    if part != now:
                        yield from ((*key, n) for key, n in held.items() if n >= least or not key[1])
                        now, held = part, Counter()
                    for phrase, n in zip(phrases, copies):
                        held[lang, phrase] += n
            yield from ((*key, n) for key, n in held.items() if n >= least or not key[1])

        return in_batches(rows(), _PHRASES, size=lambda row: 40 + len(row[1]))

    return run


def _survivors(given: DataFrame, bits, lengths: range, parts: int, least: int) -> DataFrame:
    """Keys of the phrases that a merged Misra-Gries summary per hash partition holds."""
    shares = map_arrow(given, _shares(bits, lengths, parts), "part int, data boolean, mass long, keys binary, counts binary")
    dealt = shares.repartition("part").sortWithinPartitions("part", "data")
    return map_arrow(dealt, _merged(least), "key long")


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, most_words: int = MOST_WORDS
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of every word and every phrase of up to ``most_words`` words
    that occurs at least ``least`` times in its language, and (lang, n): all its words. Both
    are read from the shared scratch folder. Exact."""
    if not 2 <= most_words <= MOST_WORDS or least < 1:
        raise ValueError(f"phrases have 2 to {MOST_WORDS} words, and occur at least once")
    given = _given(docs, text, lang)
    # Only for the number of partitions; a word takes two bytes at least.
    size = given.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = int(max(LEAST_PARTS, -(-size // 2 // PART_MASS)))
    short = written(_survivors(given, None, range(1, 3), parts, least), "pair-keys")
    keys = short
    if most_words > 2:
        longer = _survivors(given, _bitmap(short), range(3, most_words + 1), parts, least)
        keys = short.unionByName(written(longer, "phrase-keys"))
    counts = map_arrow(
        given, _phrase_counts(_bitmap(keys), most_words, parts), "part int, lang string, phrases array<string>, copies array<long>"
    )
    dealt = counts.repartition("part").sortWithinPartitions("part")
    summed = written(map_arrow(dealt, _added(least), "lang string, phrase string, f long"), "phrases")
    number = F.size(F.split("phrase", " "))
    phrases = summed.filter((F.col("f") >= least) & (F.col("phrase") != ""))
    totals = summed.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    return phrases.select("lang", "phrase", number.alias("words"), "f"), totals


def cut_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exactly: products may have 38 digits."""

    def wide(value: Column) -> Column:
        return value.cast("decimal(16,0)")

    above = F.lit(1000).cast("decimal(4,0)") * wide(a) * wide(n)
    return F.call_function("div", above, wide(left) * wide(right))


def mine_collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT,
    most_words: int = MOST_WORDS, top: int = TOP,
) -> DataFrame:
    """The ``top`` phrases per language by score: ``lang``, ``rank`` (from 1), ``phrase``, ``a``
    (its count), ``l`` and ``r`` (the counts of the parts of its weakest cut), ``n`` (the
    language's words) and ``score``, floor(1000 * a * n / (l * r)) of that cut. Eager: counts
    go to the shared scratch folder.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line breaks, words at blanks and tabs.
    Phrases of two to ``most_words`` words within a piece count, overlaps included, if they
    occur at least ``least`` times. A phrase goes if a longer one that holds it occurs as
    often. Of equal cuts the first counts; ranks are by score and ``a``, descending, then by
    the phrase's UTF-8 bytes.

    A NULL text counts as empty, a NULL language as ``und``. Repeated rows count as often as
    they occur. Very long texts are split in slices, of which no phrase is lost. Other
    columns are not looked at. An empty table, or one without frequent phrases, gives an
    empty one.
    """
    counted, totals = frequent_phrases(docs, text, lang, least, most_words)
    phrases = counted.filter("words > 1").withColumnRenamed("f", "a")
    # A longer phrase that is as frequent also has a part one word shorter that is.
    inner = F.array(
        F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)")
    )
    longer = phrases.filter("words > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("f"))
    most = longer.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    held = most.join(phrases, ["lang", "phrase"]).filter("f >= a").select("lang", "phrase")
    own = phrases.join(held, ["lang", "phrase"], "left_anti")
    cuts = own.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("rest"),
    )
    left = counted.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counted.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    score = cut_score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    best = (
        scored.withColumn("score", score)
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The first of every share, then of the language: no task ranks all of a language.
    share = best.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(LEAST_PARTS)))
    in_share = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))
    few = share.withColumn("turn", in_share).filter(F.col("turn") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = few.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
