"""Benchmark passages in documents, found with spaced seeds.

A seed is a fixed mask over consecutive words: it hashes the words at some of its places
and ignores the others, so that a replaced word at an ignored place does not hide a
passage. The two masks are chosen so that every stretch of 13 words with at most two
replaced ones holds a hit of at least one of them. Seeds of documents and of benchmark
items meet in an equi-join, and around each hit the texts are laid side by side: a leak is
a stretch of 13 words of an item, of which the document has at least 11 at the same places.
Items of 8 to 12 words have a seed of their own and may have one word replaced.

Everything here is built-in functions: no Python runs on the executors. The words of a
document stay in its row, from the seeds to the comparison; only what is found is shuffled.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import column, packed, unpacked, written
from tripmill.llm.spot_signatures import words_of

# The places a seed hashes.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 4, 5, 8, 9))

# A leak: this many words of an item in a row, with at most so many replaced.
WINDOW = 13
REPLACED = 2

# Items of fewer words are too short to tell a leak from chance; those between this and
# the window have to occur as a whole, with at most one word replaced.
LEAST_WORDS = 8

# Seeds joined at a time: about 50 MB to broadcast. A larger benchmark is taken in blocks.
SEEDS_AT_ONCE = 1_000_000


def _seed(number: int, places: tuple[int, ...], words: Column, at: Column) -> Column:
    return F.xxhash64(F.lit(number), *[F.get(words, at + place) for place in places])


def _short_mask(n: int) -> tuple[int, ...]:
    """The places of an item of n words below the window. Every other place, from the first
    word and from the second, leaves out each word once."""
    return tuple(range(0, n // 2 * 2, 2))


def short_items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, n_words) of the benchmark items that :func:`find_leaks` does not search for,
    as they have fewer than ``LEAST_WORDS`` words; NULL and empty texts have none."""
    words = F.size(words_of(F.coalesce(column(text).cast("string"), F.lit(""))))
    found = benchmark.select(column(item).alias(item), words.cast("long").alias("n_words"))
    return found.filter(F.col("n_words") < LEAST_WORDS)


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    hashed = F.transform(words_of(F.coalesce(column(text).cast("string"), F.lit(""))), lambda w: F.xxhash64(w))
    items = benchmark.select(column(item).alias("item"), hashed.alias("item_words"))
    items = items.filter(F.size("item_words") >= LEAST_WORDS).distinct()
    return written(items.withColumn("item_row", F.monotonically_increasing_id()), "benchmark-items")


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, doc_a, doc_b, item, same, at) for every document and benchmark item it holds a
    passage of: ``same`` of the best stretch's words are equal, and it starts at the
    document's word ``at`` (from 0). ``doc_a`` and ``doc_b`` are hashes of key and text.
    Eager: writes the items' words to the shared scratch folder and counts them. Warns of
    items too short to be searched for; :func:`short_items` lists them.

    Words are runs of letters and digits, lower-cased. Whole texts of any length are
    searched. The seeds of the items are broadcast in blocks of bounded size, one pass over
    the documents per block, so a benchmark of any size is taken whole.

    NULL and empty texts, and items of fewer than ``LEAST_WORDS`` words, hold no leak. An
    item's NULL id is reported as NULL; items with the same id and words count once. Rows
    repeated with the same key and text are reported once; a NULL key is a key like any
    other. Other columns are not looked at. Empty tables on either side give an empty one.
    """
    items = _items(benchmark, item, item_text)
    sizes = items.select(F.size("item_words").alias("n")).distinct().filter(f"n < {WINDOW}").collect()
    lengths = sorted(row["n"] for row in sizes)
    masks = [*MASKS, *map(_short_mask, lengths)]
    if skipped := short_items(benchmark, item, item_text).count():
        warnings.warn(f"{skipped} benchmark items of fewer than {LEAST_WORDS} words are not searched for", stacklevel=2)

    at = F.explode(F.sequence(F.lit(0), F.size("item_words") - 1))
    places = items.select("item_row", "item_words", at.alias("j"))
    seeds = places.select(
        "item_row",
        "j",
        F.size("item_words").alias("n"),
        F.posexplode(
            F.array(*[_seed(m, mask, F.col("item_words"), F.col("j")) for m, mask in enumerate(masks)])
        ).alias("mask", "seed"),
    )
    ends = F.element_at(F.array(*[F.lit(mask[-1]) for mask in masks]), F.col("mask") + 1)
    of_size = F.element_at(
        F.array(*[F.lit(None).cast("int")] * len(MASKS), *[F.lit(length) for length in lengths]),
        F.col("mask") + 1,
    )
    fits = (F.col("j") + ends < F.col("n")) & F.when(
        F.col("mask") < len(MASKS), F.col("n") >= WINDOW
    ).otherwise(F.col("n") == of_size)
    seeds = written(seeds.filter(fits).select("item_row", "j", "seed"), "benchmark-seeds")
    blocks = max(1, -(-seeds.count() // SEEDS_AT_ONCE))

    body = F.coalesce(column(text).cast("string"), F.lit(""))
    given = docs.select(
        column(key).alias("id"),
        F.xxhash64(F.lit(7), column(key), body).alias("doc_a"),
        F.xxhash64(F.lit(8), column(key), body).alias("doc_b"),
        F.transform(words_of(body), lambda w: F.xxhash64(w)).alias("words"),
    )
    # Seeds of the shortest items span one word less than these.
    last = F.size("words") - LEAST_WORDS + 1
    at = F.explode(F.when(last >= 0, F.sequence(F.lit(0), last)))
    spread = given.select("id", "doc_a", "doc_b", "words", at.alias("i"))
    spread = spread.select(
        "*",
        F.posexplode(
            F.array(*[_seed(m, mask, F.col("words"), F.col("i")) for m, mask in enumerate(masks)])
        ).alias("mask", "seed"),
    )
    found = reduce(
        DataFrame.unionByName,
        [
            _leaks_of_block(
                spread,
                seeds.filter(F.pmod("item_row", F.lit(blocks)) == block),
                items.filter(F.pmod("item_row", F.lit(blocks)) == block),
                masks,
            )
            for block in range(blocks)
        ],
    )
    best = found.groupBy("id", "doc_a", "doc_b", "item").agg(F.min("rank").alias("rank"))
    # rank = -same * 2^40 + at: the stretch with most equal words, then the first.
    width = F.lit(1 << 40)
    return best.select(
        F.col("id").alias(key), "doc_a", "doc_b", F.col("item").alias(item),
        F.ceil(-F.col("rank") / width).cast("long").alias("same"),
        F.pmod("rank", width).cast("long").alias("at"),
    )


def _leaks_of_block(spread: DataFrame, seeds: DataFrame, items: DataFrame, masks: list) -> DataFrame:
    hits = spread.join(F.broadcast(seeds), "seed").join(F.broadcast(items), "item_row")

    def same(i: Column, j: Column) -> Column:
        word, other = F.get("words", i), F.get("item_words", j)
        return F.coalesce(word == other, F.lit(False))

    def hit_before(mask: tuple[int, ...]) -> Column:
        pairs = [same(F.col("i") - 1 + place, F.col("j") - 1 + place) for place in mask]
        return reduce(Column.__and__, pairs)

    # Of hits that follow each other the first is enough: all of the item is compared.
    followed = reduce(
        lambda rest, m: F.when(F.col("mask") == m, hit_before(masks[m])).otherwise(rest),
        range(len(masks)), F.lit(False),
    )
    leading = hits.filter(~followed)
    n = F.size("item_words")
    shift = F.col("i") - F.col("j")
    compared = leading.select(
        "id", "doc_a", "doc_b", "item", shift.alias("shift"), n.alias("n"),
        F.transform("item_words", lambda w, p: F.coalesce(w == F.get("words", p + shift), F.lit(False)).cast("int")).alias("equal"),
    )
    window = F.least(F.col("n"), F.lit(WINDOW))
    starts = F.sequence(F.lit(0), F.col("n") - window)
    counts = F.transform(
        starts,
        lambda s: F.struct(
            (-F.aggregate(F.slice("equal", s + 1, window), F.lit(0), lambda a, x: a + x)).alias("minus"),
            (s + F.col("shift")).alias("at"),
        ),
    )
    needed = F.when(F.col("n") < WINDOW, F.col("n") - 1).otherwise(F.lit(WINDOW - REPLACED))
    best = compared.withColumn("best", F.array_min(counts))
    # A stretch of an item may begin before the document does; then only the rest is equal.
    rank = F.col("best.minus").cast("long") * F.lit(1 << 40) + F.greatest(F.col("best.at"), F.lit(0)).cast("long")
    return best.filter(-F.col("best.minus") >= needed).select("id", "doc_a", "doc_b", "item", rank.alias("rank"))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **names: str
) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no leak; see :func:`find_leaks`,
    also for NULLs, repeated rows and empty tables. Every copy of a leaking row goes."""
    found = written(
        find_leaks(docs, benchmark, text, key, **names).select(
            "doc_a", "doc_b"
        ).distinct(),
        "leaking",
    )
    body = F.coalesce(column(text).cast("string"), F.lit(""))
    hashes = [F.xxhash64(F.lit(salt), column(key), body) for salt in (7, 8)]
    whole = packed(docs, doc_a=hashes[0], doc_b=hashes[1])
    return unpacked(whole.join(found, ["doc_a", "doc_b"], "left_anti"), docs)
