"""Document fingerprints from content words that follow common words.

Common words are spread evenly over prose and rare in headers, lists and menus. Each is an
anchor: it and the next content words, with common words skipped, make a spot. The set of a
text's spots is its fingerprint, and two texts are as alike as the Jaccard similarity of
their sets. Sets of very different size cannot be alike, so texts are partitioned by set
size, and only sets of the same or neighbouring partitions are compared: given pairs by
their sets, all pairs of a table on the rarest spots of each set.

Everything here is built-in functions: no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import column, with_fixed, written

# The anchors, chosen here: common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be by for from had has have he in is it not of on or she that the this to was "
    "were which with "
    "au aux avec ce dans de des du elle en est et il la le les mais ne ou par pas pour que qui se sur "
    "un une "
    "auch auf aus bei das dem den der die ein eine es ist mit nicht sich sie und von war zu "
    "como con del el ha los las lo más no para pero por su una y"
).split()

# Content words per spot, and how many words after the anchor are searched for them.
CHAIN = 2
REACH = 6

# Hexadecimal digits of a spot's hash: 64 bits, so that spots of unrelated texts of a large
# table do not meet.
DIGITS = 16

# Two given sets whose sizes bound their likeness below this are not compared: 0.
LEAST_COMPARED = 0.1


def words_of(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def with_spots(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``: the sorted distinct spot hashes of the column ``text``.

    A text without any spot is fingerprinted by its runs of CHAIN + 1 words, a shorter one
    by all its words, and one without words by its characters; an empty text has no hash.
    """
    words = f"__words_{name}"
    out = with_fixed(df, **{words: words_of(column(text))})
    word, count = F.col(words), F.size(words)
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.array().cast("array<int>")
    )
    anchored = F.filter(places, lambda i: F.get(word, i).isin(*ANCHORS))

    def spot(i: Column) -> Column:
        after = F.filter(F.slice(word, i + 2, REACH), lambda w: ~w.isin(*ANCHORS))
        return F.concat_ws(":", F.get(word, i), F.slice(after, 1, CHAIN))

    # A spot of the anchor alone says nothing: the text ended, or common words went on.
    spots = F.filter(F.transform(anchored, spot), lambda s: s.contains(":"))
    runs = F.transform(
        F.slice(places, 1, count - CHAIN), lambda i: F.concat_ws(":", F.lit("="), F.slice(word, i + 1, CHAIN + 1))
    )
    whole = (
        F.when(column(text) == "", F.array().cast("array<string>"))
        .when(count == 0, F.array(F.concat(F.lit("="), column(text))))
        .when(count <= CHAIN, F.array(F.concat_ws(":", F.lit("="), word)))
        .otherwise(runs)
    )
    out = with_fixed(out, **{f"__spots_{name}": spots})
    some = F.col(f"__spots_{name}")
    chosen = F.when(F.size(some) > 0, some).otherwise(whole)
    hashed = F.array_sort(F.array_distinct(F.transform(chosen, _hash)))
    return with_fixed(out, **{name: hashed}).drop(words, f"__spots_{name}")


def _hash(spot: Column) -> Column:
    return F.conv(F.substring(F.md5(spot.cast("binary")), 1, DIGITS), 16, -10).cast("long")


def as_text(spots: Column) -> Column:
    return F.array_join(spots, ",")


def size_part(size: Column, least: float) -> Column:
    """The partition of sets of this size: two sets with a likeness of at least ``least``
    lie in the same or in neighbouring ones."""
    if least >= 1.0:
        return size.cast("long")
    return F.floor(F.log(size.cast("double")) / F.lit(-math.log(least)))


def sizes_fit(a: Column, b: Column, least: float) -> Column:
    """Whether sets of these sizes can be that alike: the smaller is the larger's subset
    at best."""
    return F.least(a, b) >= F.lit(least) * F.greatest(a, b) - 1e-9


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two spot sets; two empty sets are alike, an empty and
    another one are not, and need no intersection."""
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(shared / (F.size(a) + F.size(b) - shared))
    )


def pruned_likeness(a: Column, b: Column, least: float = LEAST_COMPARED) -> Column:
    """:func:`likeness` of two given sets, or 0 without looking into them if they lie in
    partitions that are no neighbours, or their sizes bound it below ``least``."""
    near = F.abs(size_part(F.size(a), least) - size_part(F.size(b), least)) <= 1
    both = (F.size(a) > 0) & (F.size(b) > 0)
    apart = both & ~(near & sizes_fit(F.size(a), F.size(b), least))
    return F.when(apart, 0.0).otherwise(likeness(a, b))


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``spots`` and ``fingerprint`` (the spots as text) of every whole text.

    A NULL text counts as empty: no spots, an empty fingerprint. Equal texts have equal
    fingerprints. NULL and repeated keys pass through; other columns are not looked at;
    an empty table gives an empty one. One row in, one row out, no shuffle.
    """
    given = docs.select(
        column(key).alias(key), F.coalesce(column(text).cast("string"), F.lit("")).alias("__text")
    )
    return with_spots(given, "__text", "spots").select(
        column(key), "spots", as_text(F.col("spots")).alias("fingerprint")
    )


def similar_pairs(prints: DataFrame, least: float = 0.75, spots: str = "spots") -> DataFrame:
    """(a, b, likeness) of all pairs of distinct spot sets with at least this likeness, and
    (spots, class_id) to tell whose they are: returned as (pairs, classes). Eager.

    Rows with equal sets are one class from the start. Sets are partitioned by size so that
    alike sets lie in the same or the next partition. Within these, two sets are compared
    only if they share one of the rarest n - ceil(least * n) + 1 spots of each, which alike
    sets must. Exact: nothing is capped. Empty sets are alike to nothing here.
    """
    if not 0.0 < least <= 1.0:
        raise ValueError("the least likeness lies between 0 and 1")
    classes = written(
        prints.select(column(spots).alias("spots"))
        .filter(F.size("spots") > 0)
        .distinct()
        .withColumn("class_id", F.monotonically_increasing_id()),
        "spot-sets",
    )
    one = classes.select("class_id", F.size("spots").alias("n"), F.explode("spots").alias("spot"))
    often = one.groupBy("spot").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    of_class = Window.partitionBy("class_id")
    alone = F.col("n") - F.count(F.lit(1)).over(of_class)
    rank = F.row_number().over(of_class.orderBy("sets", "spot"))
    ranked = one.join(often, "spot").select("class_id", "n", "spot", (rank + alone).alias("rank"))
    rare = written(
        ranked.filter(F.col("rank") <= F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1)
        .select("class_id", "n", "spot", size_part(F.col("n"), least).alias("part")),
        "rare-spots",
    )
    near = rare.select("class_id", "n", "spot", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    left = rare.select(F.col("class_id").alias("a"), F.col("n").alias("n_a"), "spot", "part")
    right = near.select(F.col("class_id").alias("b"), F.col("n").alias("n_b"), "spot", "part")
    fits = (F.col("a") != F.col("b")) & sizes_fit(F.col("n_a"), F.col("n_b"), least)
    pairs = (
        left.join(right, ["spot", "part"])
        .filter(fits)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    with_b = pairs.join(classes.select(F.col("class_id").alias("b"), F.col("spots").alias("spots_b")), "b")
    both = with_b.join(classes.select(F.col("class_id").alias("a"), F.col("spots").alias("spots_a")), "a")
    alike = both.select("a", "b", likeness(F.col("spots_a"), F.col("spots_b")).alias("likeness"))
    return alike.filter(F.col("likeness") >= least), classes


def edited_fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are.

    The edited text is the text with its last floor(n / 3) characters (code points)
    replaced by the first as many, or all, of the next document by descending key (after
    the last: the first). Returns ``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` (likeness of the two) and ``near_next``
    (likeness to the next document's). Eager: writes the order of the documents, without
    their texts, to the shared scratch folder.

    A likeness is the sets' Jaccard similarity where their sizes lie in the same or
    neighbouring partitions and allow :data:`LEAST_COMPARED`; else it is 0.

    Keys, of any type with an order, are put in order by a range partitioning; only the
    first and last row of each part meet in one task. The texts are shuffled once, and of
    the next document only the characters the edit takes, and its spots, are sent on.

    A NULL text counts as empty. NULL keys come last; equal keys are in order of a hash of
    their texts. Rows equal in key and text take one place in the order: all have the same
    next document. A single place is its own next. Very long texts take time in
    proportion, as does a filter on the result. An empty table gives an empty one.
    """
    body = F.coalesce(column(text).cast("string"), F.lit(""))
    given = docs.select(
        column(key).alias("id"),
        F.xxhash64(F.lit(5), column(key), body).alias("ha"),
        F.xxhash64(F.lit(6), column(key), body).alias("hb"),
        body.alias("body"),
    )
    links = _places(given.select("id", "ha", "hb", F.length("body").cast("long").alias("n")).distinct())
    # Both branches shuffle the same columns, so that Spark shuffles the texts only once.
    # Spots are left out there: at 64 bits each they are half a text's size, which costs
    # more disk than working them out again costs time.
    linked = given.select("ha", "hb", "body").join(links, ["ha", "hb"])
    sent = linked.groupBy("ha", "hb").agg(
        F.first("body").alias("body"), F.first("before").alias("before")
    )
    sent = sent.select(
        F.col("before.ha").alias("ha"), F.col("before.hb").alias("hb"), "body",
        F.expr("substring(body, 1, cast(before.n div 3 as int))").alias("taken"),
    )
    sent = with_spots(sent, "body", "next_spots").drop("body")
    joined = with_fixed(
        linked.join(sent, ["ha", "hb"]),
        edited=F.expr("concat(substring(body, 1, cast(n - n div 3 as int)), taken)"),
    )
    joined = with_spots(with_spots(joined, "body", "spots"), "edited", "edited_spots")
    return joined.select(
        F.col("id").alias(key),
        F.col("n").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("spots")).alias("fingerprint"),
        as_text(F.col("edited_spots")).alias("edited_fingerprint"),
        pruned_likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        pruned_likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def _places(places: DataFrame) -> DataFrame:
    """(id, ha, hb, n, before): for every place, whose next it is, as (ha, hb, n)."""
    descending = [F.col("id").desc_nulls_last(), F.col("ha"), F.col("hb")]
    parted = written(
        places.repartitionByRange(*descending).withColumn("part", F.spark_partition_id()), "order"
    )
    place = F.struct("ha", "hb", "n")
    within = Window.partitionBy("part").orderBy(*descending)
    rows = parted.select(
        "part", "id", "ha", "hb", "n",
        F.lag(place).over(within).alias("lag"), F.lead(place).over(within).isNull().alias("is_last"),
    )
    # One row per part; the last place of all comes before the first.
    lasts = rows.filter("is_last").select("part", place.alias("last"))
    by_part = Window.orderBy("part")
    all_parts = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = lasts.select(
        "part", F.coalesce(F.lag("last").over(by_part), F.last("last").over(all_parts)).alias("edge")
    )
    return written(
        rows.join(edges, "part").select("id", "ha", "hb", "n", F.coalesce("lag", "edge").alias("before")),
        "places",
    )
