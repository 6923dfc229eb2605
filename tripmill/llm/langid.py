"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit a binary classifier over character
n-grams says how much a text looks like the languages that have a 1 there; its weights
are log-odds from n-gram counts, which are plain sums and so come from one aggregation.
How often each classifier is right on texts of each language, measured on other training
rows than the counts, weights its vote: the answer is the language whose codeword has the
least weighted loss. Two languages with nearly equal loss make the answer ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import column, map_arrow, unpacked

UNKNOWN = "und"

# Hashed n-grams of one, two and three characters share this many bins.
BINS = 1 << 14
ORDERS = (1, 2, 3)

# Training rows taken per language, about, by a hash of their key. They bound the cost of
# training whatever the size of the corpus.
TRAINING_ROWS = 3_000

# Shares are added up as whole numbers of this unit, so that the order of the sum, which
# differs from run to run, changes nothing.
ONE = float(1 << 32)

# Codewords are this long, or shorter for few languages.
MOST_BITS = 31


@dataclass(frozen=True)
class LanguageModel:
    """``codes`` (languages x bits, -1 or 1), ``weights`` (bins x bits) and ``trust``
    (languages x bits, each row adds up to 1)."""

    languages: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray


def codewords(count: int, most_bits: int = MOST_BITS) -> np.ndarray:
    """``count`` codewords far apart. Up to five languages all ways to divide them are
    used; beyond that, of seeded random codes the one with the largest least distance."""
    if count <= 1:
        return np.ones((count, 1))
    if count <= 5:
        splits = [
            [1.0 if language == 0 or language in chosen else -1.0 for language in range(count)]
            for size in range(count - 1)
            for chosen in combinations(range(1, count), size)
        ]
        return np.array(splits).T
    bits = max(most_bits, 4 * int(np.ceil(np.log2(count))))
    best, best_distance = None, -1.0
    draw = np.random.default_rng(42)
    for _ in range(200):
        code = draw.choice([-1.0, 1.0], size=(count, bits))
        agree = code @ code.T
        np.fill_diagonal(agree, -bits)
        distance = bits - agree.max() - np.abs(code.sum(axis=0)).max() / count
        if (np.abs(code.sum(axis=0)) < count).all() and distance > best_distance:
            best, best_distance = code, distance
    return best


def features(text: str) -> np.ndarray:
    """The bin of every n-gram of a text, lower-cased, with runs of characters that are
    no letters as one space."""
    letters = "".join(text.lower().split()) and " " + " ".join(_only_letters(text.lower()).split()) + " "
    points = np.frombuffer(letters.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    out = []
    for order in ORDERS:
        if len(points) >= order:
            mixed = np.full(len(points) - order + 1, order, dtype=np.uint64)
            for place in range(order):
                mixed = (mixed ^ points[place : len(points) - order + 1 + place]) * np.uint64(
                    0x9E3779B97F4A7C15
                )
                mixed ^= mixed >> np.uint64(29)
            out.append((mixed >> np.uint64(7)) & np.uint64(BINS - 1))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, dtype=np.int64)


class _Letters(dict):
    def __missing__(self, point: int) -> int:
        self[point] = found = point if chr(point).isalpha() else 32
        return found


_LETTERS = _Letters()


def _only_letters(text: str) -> str:
    return text.translate(_LETTERS)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def vector(text: str) -> np.ndarray:
    """The share of each bin among a text's n-grams."""
    found = features(text)
    return np.bincount(found, minlength=BINS) / max(1, len(found))


def margins(text: str, weights: np.ndarray) -> np.ndarray:
    """What each binary classifier says about a text: positive for a 1."""
    found = features(text)
    if len(found) < BINS // 4:
        return weights[found].sum(axis=0) / max(1, len(found))
    return (np.bincount(found, minlength=BINS) / len(found)) @ weights


def decode(model: LanguageModel, said: np.ndarray) -> tuple[str, float, float]:
    """(language, score, runner-up's score) by least weighted loss."""
    loss = (model.trust * np.exp(-np.clip(SHARPNESS * model.codes * said, -30, 30))).sum(axis=1)
    shares = 1.0 / np.maximum(loss, 1e-12)
    shares /= shares.sum()
    order = np.argsort(-shares, kind="stable")
    second = float(shares[order[1]]) if len(order) > 1 else 0.0
    return model.languages[order[0]], float(shares[order[0]]), second


# Margins are log-odds per n-gram; this turns them into losses that tell texts apart.
SHARPNESS = 8.0

# The answer is ambiguous if the second language comes this close to the first.
AMBIGUOUS = 0.8


def train_language_model(
    labelled: DataFrame, rows_per_language: int = TRAINING_ROWS, text: str = "text",
    lang: str = "lang", key: str = "doc_id",
) -> LanguageModel:
    """Learn from rows that have a text and a language. Eager: counts the languages,
    then takes one pass for the n-gram counts and one for the classifiers' trust.

    About ``rows_per_language`` rows of each language are used, chosen by a hash of key
    and text; half of them give the counts, the others the trust. What reaches the driver
    is languages x bins, however large the input. Rows without text, language or any
    letter teach nothing; a language without such rows is not learned; without any the
    model has no languages and answers :data:`UNKNOWN`.
    """
    rows = labelled.select(
        column(key).cast("string").alias("key"), column(text).cast("string").alias("text"),
        column(lang).cast("string").alias("lang"),
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {row["lang"]: row["count"] for row in rows.groupBy("lang").count().collect()}
    if not counts:
        return LanguageModel((), np.ones((0, 1)), np.zeros((BINS, 1)), np.ones((0, 1)))
    place = F.pmod(F.xxhash64(F.lit(4), "key", "text"), F.lit(1 << 30))
    share = F.lit(0)
    for language, count in counts.items():
        bound = min(1 << 30, int(2.0**30 * rows_per_language / count) + 1)
        share = F.when(F.col("lang") == language, bound).otherwise(share)
    drawn = rows.withColumn("place", place).filter(F.col("place") < share)
    drawn = drawn.select("text", "lang", (F.col("place") % 2 == 0).alias("first"))

    def count_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, language in zip(batch.column(0), batch.column(1)):
                words = value.as_py()
                if has_letter(words):
                    total = sums.setdefault(language.as_py(), np.zeros(BINS + 1, dtype=np.int64))
                    total[:BINS] += np.rint(vector(words) * ONE).astype(np.int64)
                    total[BINS] += 1
        for language, total in sums.items():
            bins = np.flatnonzero(total)
            names = pa.array([language] * len(bins), pa.string())
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(bins), pa.array(total[bins])], names=["lang", "bin", "value"]
            )

    def add_up(frame: DataFrame) -> dict[str, np.ndarray]:
        partial = map_arrow(frame, count_bins, "lang string, bin long, value long")
        out: dict[str, np.ndarray] = {}
        for row in partial.groupBy("lang", "bin").agg(F.sum("value").alias("value")).collect():
            out.setdefault(row["lang"], np.zeros(BINS + 1))[row["bin"]] = row["value"]
        return out

    first = add_up(drawn.filter("first").select("text", "lang"))
    if not first:
        first = add_up(drawn.select("text", "lang"))
    languages = tuple(sorted(first))
    codes = codewords(len(languages))
    # Each language weighs the same: sums of shares, divided by its number of texts.
    usual = np.array([first[name][:BINS] / ONE / first[name][BINS] for name in languages]).reshape(-1, BINS)
    floor = 0.02 / BINS
    weights = np.zeros((BINS, codes.shape[1]))
    for bit in range(codes.shape[1]):
        ones, zeros = usual[codes[:, bit] > 0], usual[codes[:, bit] < 0]
        if len(ones) and len(zeros):
            weights[:, bit] = np.log(ones.mean(axis=0) + floor) - np.log(zeros.mean(axis=0) + floor)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, bits, right = [], [], []
            for value, language in zip(batch.column(0), batch.column(1)):
                words, name = value.as_py(), language.as_py()
                if name in languages and has_letter(words):
                    said = margins(words, weights) * codes[languages.index(name)]
                    names += [name] * len(said)
                    bits += list(range(len(said)))
                    right += [int(x) for x in said > 0]
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array(names, pa.string()), "bit": pa.array(bits, pa.int32()),
                 "was_right": pa.array(right, pa.int64())}
            )

    judged = drawn.filter(~F.col("first")).select("text", "lang")
    hits = map_arrow(judged, judge, "lang string, bit int, was_right long")
    trust = np.full(codes.shape, 0.5)
    for row in hits.groupBy("lang", "bit").agg(F.avg("was_right").alias("share")).collect():
        trust[languages.index(row["lang"]), row["bit"]] = max(row["share"], 1e-6)
    trust /= trust.sum(axis=1, keepdims=True)
    return LanguageModel(languages, codes, weights, trust)


def identify_language(
    docs: DataFrame, model: LanguageModel, text: str = "text", keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """``keep`` with ``__lang_pred``, ``__score`` (0 to 1) and ``__ambiguous`` of every whole
    text, read from nothing but the text. Narrow: no shuffle; the model, of a size that
    depends on bins and bits alone, travels with the tasks.

    A text that is NULL, empty or without a letter gets ``und`` with score 0, and so does
    every text under a model without languages. Repeated rows and NULLs in other columns
    pass through; columns outside ``keep`` are not looked at, and one of ``keep`` named
    like a result is replaced; an empty table gives an empty one. Long texts are read whole.
    """
    spark = docs.sparkSession
    kept = docs.select(*[column(name).alias(name) for name in keep])
    body = column(text).cast("string")
    given = docs.select(F.struct(*[column(name).alias(name) for name in keep]).alias("row"), body.alias("body"))
    result = T.StructType(
        [given.schema["row"], T.StructField("lang_pred", T.StringType()),
         T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    )
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(result)
        own = shared.value

        def answer(words: str | None) -> tuple[str, float, bool]:
            if not own.languages or not words or not has_letter(words):
                return UNKNOWN, 0.0, False
            name, score, second = decode(own, margins(words, own.weights))
            return name, score, second >= AMBIGUOUS * score

        for batch in batches:
            if len(batch):
                said = zip(*[answer(value.as_py()) for value in batch.columns[-1]])
                added = [pa.array(x, f.type) for x, f in zip(said, list(schema)[-3:])]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], names=schema.names)

    answered = map_arrow(given, run, result)
    names = ("lang_pred", "score", "ambiguous")
    return unpacked(answered, kept, **{f"__{name}": F.col(name) for name in names})


def is_held_out(key: str = "doc_id") -> Column:
    """True for the third of the keys that nothing is learned from; a NULL key counts as
    empty text."""
    return F.crc32(F.coalesce(column(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1
