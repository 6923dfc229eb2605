"""Near duplicates by word shingles: candidates from min-max hashing, exact links.

A text's set holds its distinct runs of five words. Every permutation (a multiply-add
hash of the shingles) gives two signature values, its minimum and its maximum: half the
hash evaluations of plain min-hashing, and the two err in opposite directions, so that the
estimate has less variance. Rows of five values make a bucket key; two texts of similarity
0.75 miss all 40 buckets about twice in 100,000.

Texts in one bucket are not compared all with all. Each is compared with one centre of its
bucket, and what links is joined into components; where a bucket still holds several, with
another centre. Texts in buckets that hold more than one component even then are compared
across components, and never within one, if they share one of their rarest shingles, as
similar texts must. That leaves out comparisons whose answer cannot change a component, and
no others. Every link is confirmed on the full sets of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import column, in_batches, map_arrow, packed, unpacked, written
from tripmill.llm.graph import components

SHINGLE = 5
PERCENT = 75

# Signature: bands of rows; half of the bands hold minima, half hold maxima.
ROWS = 5
BANDS = 40
PERMUTATIONS = ROWS * BANDS // 2

# Shingles hashed at a time.
BLOCK = 2_048

# Keys of texts to be compared are broadcast up to this number (32 MB), and joined by a
# shuffle of the texts beyond it.
MOST_BROADCAST = 2_000_000

# Texts compared with one other in one stream.
PAIRS_A_PART = 1_000

_DRAW = np.random.default_rng(20_240_501)
_TIMES = _DRAW.integers(0, 1 << 63, size=PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _DRAW.integers(0, 1 << 63, size=PERMUTATIONS, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """The words between ASCII blanks, A-Z lower-cased, as UTF-8."""
    return text.encode().lower().split()


def shingle_set(words: list[bytes]) -> set[tuple[bytes, ...]]:
    """The distinct runs of five words; of fewer words the whole sequence."""
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*[words[place:] for place in range(SHINGLE)]))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each distinct shingle."""
    from xxhash import xxh3_64_intdigest

    hashes = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    mixed = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for place in range(width):
        mixed = _mixed(mixed ^ hashes[place : len(words) - width + 1 + place])
    return np.unique(mixed)


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of the shingles under every permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for start in range(0, len(shingles), BLOCK):
        hashed = shingles[start : start + BLOCK] * _TIMES[:, None] + _PLUS[:, None]
        np.minimum(low, hashed.min(axis=1), out=low)
        np.maximum(high, hashed.max(axis=1), out=high)
    return low, high


def bands_of(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One bucket key per band; keys of different bands differ."""
    rows = np.concatenate([low, high]).reshape(BANDS, ROWS)
    mixed = np.arange(1, BANDS + 1, dtype=np.uint64)
    for place in range(ROWS):
        mixed = _mixed(mixed ^ rows[:, place])
    return mixed.view(np.int64)


def signatures(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, ``text_key`` (hash of the raw text), ``node`` (128-bit hash of the words,
    NULL without words), ``n_shingles`` and ``bands`` of every whole text."""
    key_type = docs.schema[key].dataType
    result = T.StructType(
        [
            T.StructField(key, key_type),
            T.StructField("text_key", T.LongType()),
            T.StructField("node", T.BinaryType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(result)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for number, text_key, value in zip(*batch.columns):
                    words = words_of(value.as_py() or "")
                    if not words:
                        yield number.as_py(), text_key.as_py(), None, 0, None
                        continue
                    node = blake2b(b" ".join(words), digest_size=16).digest()
                    shingles = shingle_hashes(words)
                    bands = bands_of(*signature(shingles))
                    yield number.as_py(), text_key.as_py(), node, len(shingles), bands

        yield from in_batches(rows(), schema, size=lambda row: 64 + 8 * BANDS)

    plain = column(text).cast("string")
    given = docs.select(column(key).alias(key), F.xxhash64(plain).alias("text_key"), plain)
    return map_arrow(given, run, result)


def class_texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(class_id, words): a text of each wanted class. Only those texts are shuffled."""
    keys = written(
        wanted.distinct().join(classes.select("class_id", "text_key"), "class_id"), "wanted"
    )
    needed = keys.select("text_key").distinct()
    if keys.count() <= MOST_BROADCAST:
        needed = F.broadcast(needed)
    plain = column(text).cast("string")
    texts = (
        docs.select(F.xxhash64(plain).alias("text_key"), plain.alias("words"))
        .join(needed, "text_key", "left_semi")
        .groupBy("text_key")
        .agg(F.first("words").alias("words"))
        .join(keys, "text_key")
        .select("class_id", "words")
    )
    return written(texts, "texts")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets are similar enough.

    All of one ``a`` are compared in a stream in which its text comes first, once; an ``a``
    of very many is dealt to several, by ``b``.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_A_PART).cast("int").alias("parts"))
    sizes = written(sizes, "centres")
    own = sizes.select("a", F.explode(F.sequence(F.lit(1), F.col("parts"))).alias("part"))
    own = own.join(texts.select(F.col("class_id").alias("a"), "words"), "a")
    others = pairs.join(sizes, "a").select(
        "a", (F.pmod(F.xxhash64("b"), F.col("parts")) + 1).cast("int").alias("part"), "b"
    )
    others = others.join(texts.select(F.col("class_id").alias("b"), "words"), "b")
    names = ["a", "part", "b", "words"]
    both = own.withColumn("b", F.lit(None).cast("long")).select(*names).unionByName(others.select(*names))
    both = both.repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def rows() -> Iterator[tuple]:
            one: set = set()
            for batch in batches:
                for a, b, words in zip(*batch.columns):
                    found = shingle_set(words_of(words.as_py()))
                    if not b.is_valid:
                        one = found
                        continue
                    shared = len(one & found)
                    if 100 * shared >= PERCENT * (len(one) + len(found) - shared):
                        yield a.as_py(), b.as_py()

        yield from in_batches(rows(), schema)

    return written(map_arrow(both.select("a", "b", "words"), run, "a long, b long"), "confirmed")


def joined_so_far(links: DataFrame) -> DataFrame:
    """(node, root) where equal roots mean one component, though not the reverse: the
    smallest node two links away, and that one's own. Enough to tell most of what is
    joined already, in a fraction of the time the whole components take."""
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    ends = ends.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    least = F.least("node", "least").alias("root")
    # Written, so that its size is known and the join need not deal out a centre's rows.
    one = written(ends.groupBy("node").agg(F.min("other").alias("least")).select("node", least), "least")
    other = one.select(F.col("node").alias("other"), F.col("root").alias("far"))
    two = ends.join(other, "other").groupBy("node").agg(F.min("far").alias("least"))
    two = written(two.select("node", least), "joined")
    next_ = two.select(F.col("node").alias("root"), F.col("root").alias("next"))
    return two.join(next_, "root", "left").select("node", F.coalesce("next", "root").alias("root"))


def unresolved(members: DataFrame, found: DataFrame) -> DataFrame:
    """(bucket, class_id, root) of the buckets that hold more than one root."""
    rooted = members.join(
        found.select(F.col("node").alias("class_id"), "root"), "class_id", "left"
    ).select("bucket", "class_id", F.coalesce("root", "class_id").alias("root"))
    mixed = (
        rooted.groupBy("bucket")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"))
        .filter("least < most")
        .select("bucket")
    )
    return rooted.join(mixed, "bucket")


def other_centres(open_: DataFrame) -> DataFrame:
    """Pairs (a, b) of a centre of each bucket, another one in every bucket, with the
    bucket's classes of other components."""
    order = F.xxhash64("bucket", "class_id")
    lead = open_.groupBy("bucket").agg(F.min(order).alias("order"))
    centres = open_.join(lead, "bucket").filter(order == F.col("order")).select(
        "bucket", F.col("class_id").alias("a"), F.col("root").alias("root_a")
    )
    pairs = open_.join(centres, "bucket").filter("root != root_a")
    return pairs.select(F.least("a", "class_id").alias("a"), F.greatest("a", "class_id").alias("b")).distinct()


def across_components(open_: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes in different components that may still link.

    Two sets can only be similar enough if they share one of their rarest shingles: the
    rarest n - ceil(0.75 n) + 1 of each, by one order for all. At the first one they share,
    what either has left bounds what they can share at all. So passages that many texts
    hold, which fill whole buckets, bring nobody together here. Exact for all ``open_``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for class_id, words in zip(*batch.columns):
                hashes = shingle_hashes(words_of(words.as_py()))
                number = pa.array(np.full(len(hashes), class_id.as_py()))
                size = pa.array(np.full(len(hashes), len(hashes)))
                yield pa.RecordBatch.from_arrays(
                    [number, pa.array(hashes.view(np.int64)), size], names=["class_id", "shingle", "n"]
                )

    shingles = written(
        map_arrow(
            texts.join(open_.select("class_id"), "class_id", "left_semi").select("class_id", "words"),
            run, "class_id long, shingle long, n long",
        ),
        "shingles",
    )
    shared = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    of_class = Window.partitionBy("class_id")
    rank = F.row_number().over(of_class.orderBy("texts", "shingle"))
    alone = F.col("n") - F.count(F.lit(1)).over(of_class)
    needed = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    rarest = (
        shingles.join(shared, "shingle")
        .select("class_id", "shingle", "n", (rank + alone).alias("rank"))
        .filter(F.col("rank") <= needed)
        .join(open_, "class_id")
        .select("shingle", "class_id", "n", "rank", "root")
    )
    rarest = written(rarest, "rarest")
    mixed = (
        rarest.groupBy("shingle")
        .agg(F.min("root").alias("least"), F.max("root").alias("most"))
        .filter("least < most")
        .select("shingle")
    )
    one = written(rarest.join(mixed, "shingle"), "rarest")
    other = one.select(
        "shingle", F.col("class_id").alias("b"), F.col("n").alias("n_b"),
        F.col("rank").alias("rank_b"), F.col("root").alias("root_b"),
    )
    # 100 * shared >= 75 * (n + n_b - shared), with the most they can share.
    most = F.least(F.col("n") - F.col("rank"), F.col("n_b") - F.col("rank_b")) + 1
    enough = (100 + PERCENT) * most >= PERCENT * (F.col("n") + F.col("n_b"))
    pairs = one.join(other, "shingle").filter(
        (F.col("class_id") < F.col("b")) & (F.col("root") != F.col("root_b")) & enough
    )
    return written(pairs.select(F.col("class_id").alias("a"), "b").distinct(), "pairs")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Groups of near copies. Eager: runs the rounds, writes to the shared scratch folder.

    Returns for every row: ``key``, ``text_key``, ``n_shingles`` (size of its set),
    ``component_id`` (the smallest key reachable over links, its own included) and ``kept``
    (whether its key is that one). Two texts link if 100 times the intersection of their
    sets is at least 75 times the union.

    A NULL, empty or blank text has no set, links with nothing and stands for itself. Rows
    with the same words are one class from the start, however many there are; they share
    set and component. A NULL key counts as no key: a component without any key has a NULL
    id, and its rows are kept. Repeated keys may belong to different components; each row
    follows its text. Very long texts are hashed in blocks; two sets at a time are held.
    Other columns are not looked at. An empty table gives an empty one.
    """
    id_ = column(key)
    signed = written(signatures(docs, text, key), "signatures")
    classes = written(
        signed.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min(id_).alias("first"), F.min("text_key").alias("text_key"), F.first("bands").alias("bands"))
        .withColumn("class_id", F.monotonically_increasing_id()),
        "classes",
    )
    postings = classes.select("class_id", F.explode("bands").alias("bucket"))
    shared = (
        postings.groupBy("bucket")
        .agg(F.min("class_id").alias("centre"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1")
        .select("bucket", "centre")
    )
    members = written(postings.join(shared, "bucket"), "buckets")
    pairs = written(
        members.filter("class_id != centre")
        .select(F.col("centre").alias("a"), F.col("class_id").alias("b"))
        .distinct(),
        "pairs",
    )
    ends = members.select("class_id")
    texts = class_texts(ends, classes, docs, text)
    links = confirmed(pairs, texts)
    # A large group can be in parts still: another centre in every bucket joins most.
    open_ = written(unresolved(members, joined_so_far(links)), "unresolved")
    links = links.unionByName(confirmed(written(other_centres(open_), "pairs"), texts))
    # Links between classes that met in a bucket, but neither was a centre.
    open_ = unresolved(open_.select("bucket", "class_id"), joined_so_far(links))
    open_ = written(open_.select("class_id", "root").distinct(), "unresolved")
    links = links.unionByName(confirmed(across_components(open_, texts), texts))
    found = components(links)
    return _with_components(signed, classes, found, key)


def _with_components(signed: DataFrame, classes: DataFrame, found: DataFrame, key: str) -> DataFrame:
    rooted = classes.select("node", "first", "class_id").join(
        found.select(F.col("node").alias("class_id"), "root"), "class_id", "left"
    ).select("node", "first", F.coalesce("root", "class_id").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_node = rooted.join(smallest, "root").select("node", "root", "component_id")
    id_ = column(key)
    joined = signed.select(id_, "text_key", "n_shingles", "node").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), id_).otherwise(F.col("component_id"))
    return joined.select(
        id_, "text_key", "n_shingles", "root", component.alias("component_id")
    ).withColumn("kept", id_.eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row, with all columns, of each group of near copies: that with the smallest key,
    then the smallest text hash; of rows equal in both, any one. Rows without words are in
    no group and all stay. A group without any key keeps a row as well. NULL, empty, very
    long and repeated texts are treated as there. An empty table gives an empty one. Eager.

    Only keys and hashes are grouped; the texts are shuffled once at most, to meet what goes.
    """
    found = near_duplicates(docs, text, key)
    rows = (
        found.filter(F.col("root").isNotNull())
        .groupBy("root", column(key).alias("id"), "text_key")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    place = F.struct(F.col("id").isNull().alias("none"), "id", "text_key")
    first = rows.groupBy("root").agg(F.min(place).alias("first"))
    ranked = rows.join(first, "root").select(
        "id", "text_key", "times", place.eqNullSafe(F.col("first")).alias("stays")
    )
    ranked = written(ranked.filter("NOT stays OR times > 1"), "rows-to-go")
    whole = packed(docs, id=column(key), text_key=F.xxhash64(column(text).cast("string")))

    def same(one: DataFrame, other: DataFrame) -> Column:
        return (one["text_key"] == other["text_key"]) & one["id"].eqNullSafe(other["id"])

    go = ranked.filter("NOT stays")
    kept = whole.join(go, same(whole, go), "left_anti")
    again = ranked.filter("stays")
    if not again.isEmpty():
        repeated = kept.join(again, same(kept, again), "left_semi")
        once = repeated.groupBy("id", "text_key").agg(F.first("row").alias("row"))
        rest = kept.join(again, same(kept, again), "left_anti")
        kept = rest.select("row").unionByName(once.select("row"))
    return unpacked(kept, docs)
