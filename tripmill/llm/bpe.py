"""Byte-pair encoding and decoding with forced boundaries.

A merge can only join two symbols if some vocabulary token holds them side by side.
A pair of neighbouring symbols that occurs inside no token is therefore a cut that no
merge crosses, and the fragments between cuts can be encoded on their own and put
together again: their merges never meet. Each fragment is then short, is merged once
per task and is looked up afterwards.

Everything about the vocabulary comes from the tokenizer's own file, whose path is a
parameter; executors read it from the path the driver names.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripmill.llm.common import column, in_batches, map_arrow

# Words and fragments kept per Python worker before the memory is emptied.
REMEMBERED = 400_000

# Fragments of more symbols than this are merged with a queue.
SHORT = 40

# Code points below this are split here; text beyond it is split by the tokenizer's own
# normalizer and pre-tokenizer, whose Unicode version decides there.
KNOWN_SCRIPTS = 0x250


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    characters stand for themselves, the others for the code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in printable]
    letters = {byte: chr(byte) for byte in printable}
    letters.update({byte: chr(256 + place) for place, byte in enumerate(rest)})
    return [letters[byte] for byte in range(256)]


LETTERS = byte_letters()


class Vocabulary:
    """Tokens, merges and forced cuts of one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.added: dict[str, int] = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens: list[str] = [""] * (1 + max([*self.ids.values(), *self.added.values()]))
        for token, number in [*self.ids.items(), *self.added.items()]:
            self.tokens[number] = token
        self.merges: dict[tuple[str, str], tuple[int, str]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((left, right), (rank, left + right))
        parts = [self.symbols(token) for token in self.ids]
        self.inside = {pair for symbols in parts for pair in zip(symbols, symbols[1:])}

    def symbols(self, token: str) -> list[str]:
        """A token's first parts: its letters, the last one with the word's end."""
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            letters = list(token.removesuffix(self.end))
            letters[-1] += self.end
            return letters
        return list(token)

    def fragments(self, symbols: list[str]) -> Iterator[list[str]]:
        """The symbols of a word, cut where no token spans two neighbours."""
        start = 0
        for place in range(1, len(symbols)):
            if (symbols[place - 1], symbols[place]) not in self.inside:
                yield symbols[start:place]
                start = place
        yield symbols[start:]

    def merge(self, symbols: list[str]) -> list[int]:
        """Apply the merges to one fragment, lowest rank first, leftmost first."""
        if len(symbols) > SHORT:
            return self.merge_long(symbols)
        parts = list(symbols)
        merges = self.merges
        while len(parts) > 1:
            found = [merges[pair] for pair in zip(parts, parts[1:]) if pair in merges]
            if not found:
                break
            best = min(found)
            lowest = best[1]
            out, place, last = [], 0, len(parts) - 1
            while place <= last:
                if place < last and merges.get((parts[place], parts[place + 1])) == best:
                    out.append(lowest)
                    place += 2
                else:
                    out.append(parts[place])
                    place += 1
            parts = out
        return [self.ids[part] for part in parts if part in self.ids]

    def merge_long(self, symbols: list[str]) -> list[int]:
        """The same with a queue of pairs: a very long fragment costs n log n."""
        parts: list[str | None] = list(symbols)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[int, int, str, str]] = []

        def offer(place: int) -> None:
            following = after[place]
            if following < len(parts):
                found = self.merges.get((parts[place], parts[following]))
                if found:
                    heapq.heappush(queue, (found[0], place, parts[place], parts[following]))

        for place in range(len(parts) - 1):
            offer(place)
        while queue:
            _, place, left, right = heapq.heappop(queue)
            following = after[place]
            if parts[place] != left or following >= len(parts) or parts[following] != right:
                continue
            parts[place] = left + right
            parts[following] = None
            after[place] = after[following]
            if after[place] < len(parts):
                before[after[place]] = place
            if before[place] >= 0:
                offer(before[place])
            offer(place)
        return [self.ids[part] for part in parts if part is not None and part in self.ids]


class WordEncoder:
    """Encodes texts with a vocabulary of lower-cased words that carry their end."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.vocabulary = Vocabulary(path)
        special = sorted(self.vocabulary.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.words = re.compile(word_pattern())
        self.known: dict[str, bytes] = {}
        self.known_fragments: dict[tuple[str, ...], list[int]] = {}

    @cached_property
    def library(self):
        """The tokenizer itself, loaded only for texts beyond the known scripts."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def split(self, text: str) -> list[str]:
        """Words after lower-casing. The end of a word is not marked yet."""
        lower = text.lower()
        if lower.isascii() or (max(lower) < chr(KNOWN_SCRIPTS) > max(text)):
            return self.words.findall(lower)
        normal = self.library.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def word(self, word: str) -> bytes:
        """The ids of one word, as 32-bit little-endian integers."""
        vocabulary = self.vocabulary
        symbols = [LETTERS[byte] for byte in word.encode()]
        symbols[-1] += vocabulary.end
        ids: list[int] = []
        for fragment in vocabulary.fragments(symbols):
            key = tuple(fragment)
            found = self.known_fragments.get(key)
            if found is None:
                found = vocabulary.merge(fragment)
                if len(key) <= 64:
                    if len(self.known_fragments) >= REMEMBERED:
                        self.known_fragments.clear()
                    self.known_fragments[key] = found
            ids += found
        packed = packed_ids(ids)
        if len(word) <= 64:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The ids of a text, as 32-bit little-endian integers."""
        out: list[bytes] = []
        parts = self.special.split(text) if self.special else [text]
        for number, part in enumerate(parts):
            if number % 2:
                out.append(packed_ids([self.vocabulary.added[part]]))
            elif part:
                known = self.known
                out += [known.get(word) or self.word(word) for word in self.split(part)]
        return b"".join(out)

    def forget(self) -> None:
        """Give up what was remembered: the worker may serve other jobs next."""
        self.known.clear()
        self.known_fragments.clear()

    def decode(self, ids: bytes) -> str:
        """The text of packed ids: the tokens with a space between, as the file names
        no decoder."""
        return " ".join(map(self.vocabulary.tokens.__getitem__, unpacked_ids(ids)))


def packed_ids(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


def unpacked_ids(ids: bytes) -> array:
    numbers = array("I")
    numbers.frombytes(ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers


def character_class(kind: str) -> str:
    """The characters below :data:`KNOWN_SCRIPTS` whose Unicode category starts with
    ``kind``, as the inside of a character class."""
    import unicodedata

    found = [c for c in map(chr, range(KNOWN_SCRIPTS)) if unicodedata.category(c)[0] == kind]
    return "".join(map(re.escape, found))


# The white space below KNOWN_SCRIPTS.
BLANK = r"\t-\r \x85\xa0"


def word_pattern() -> str:
    """The word vocabulary's split, for known scripts: contractions, runs of letters,
    single digits, runs of anything else."""
    letter, digit = character_class("L"), character_class("N")
    return f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{digit}]|[^{BLANK}{letter}{digit}]+"


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder per file and Python worker."""
    return WordEncoder(path)


def bpe_encode(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", decode: bool = True,
    packed: bool = True,
) -> DataFrame:
    """Encode every whole text, and decode the ids again.

    Returns ``key``, ``n_tokens`` (long), ``ids`` (32-bit little-endian integers as one
    binary value, or with ``packed=False`` an array of longs) and, with ``decode``,
    ``decoded``: what those ids decode to. Narrow: one row in, one row out, no shuffle.

    A NULL text counts as empty, with no ids and an empty decoded text; a NULL or
    repeated key is passed through; other columns are not looked at, whatever their
    names; an empty table gives an empty one. Texts of any length are encoded whole, and
    finished rows leave the task in batches of bounded size.
    """
    ids_type = T.BinaryType() if packed else T.ArrayType(T.LongType())
    fields = [
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", ids_type),
    ]
    if decode:
        fields.append(T.StructField("decoded", T.StringType()))
    key_type = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        own = encoder(path)
        kinds = [to_arrow_type(key_type), pa.int64(), pa.binary() if packed else pa.list_(pa.int64())]
        kinds += [pa.string()] if decode else []
        schema = pa.schema([pa.field(f.name, kind) for f, kind in zip(fields, kinds)])

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for number, value in zip(batch.column(0), batch.column(1)):
                    ids = own.encode(value.as_py() or "")
                    numbers = ids if packed else np.frombuffer(ids, "<u4").astype(np.int64)
                    row = (number.as_py(), len(ids) // 4, numbers)
                    yield (*row, own.decode(ids)) if decode else row

        yield from in_batches(rows(), schema, 1_000, size=lambda row: 16 * row[1])
        own.forget()

    return map_arrow(docs.select(column(key), column(text).cast("string")), run, T.StructType(fields))
