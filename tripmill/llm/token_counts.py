"""Exact token counts of every prefix of a text.

Encoding each prefix anew costs the square of the length. Instead the last token of a
prefix is found from shorter prefixes: a token ``t`` can follow the encoding of
``text[:j]`` exactly if its last token and ``t``, encoded together, stay two tokens. One
``t`` at most passes that test at each place, and the count is one more than at ``j``.

The text is split into pieces before, as the tokenizer does; pieces are counted once per
task and looked up afterwards. Two places differ from the pieces of the whole text: after
white space that a longer text would hand to the next piece, and inside a contraction.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import cached_property, lru_cache
from itertools import accumulate, chain
from os.path import commonprefix
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripmill.llm.bpe import (
    BLANK,
    KNOWN_SCRIPTS,
    LETTERS,
    Vocabulary,
    character_class,
)
from tripmill.llm.common import column, in_batches, map_arrow

# Pieces up to this many characters are remembered; their counts fit a byte.
SHORT_PIECE = 60

# Characters of texts learned from together, and pieces remembered per Python worker
# (some 200 MB).
CHARACTERS_TOGETHER = 4_000_000
PIECES_REMEMBERED = 1_000_000

# All white space. A longer run before other text is split by the
# tokenizer; a prefix that ends with the run is not.
SPACE = BLANK + "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK_RUN = re.compile(f"[{SPACE}]{{2,}}(?=[^{SPACE}])")


def piece_pattern() -> str:
    """The byte-level split for known scripts: contractions, then runs of letters, of
    digits and of anything else, each with a space before, then white space."""
    letter, digit = character_class("L"), character_class("N")
    return (
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{BLANK}{letter}{digit}]+"
        f"|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
    )


class Part(NamedTuple):
    """A stretch of text and, after its first ``own`` characters, all but the last one of
    the special token it ends with, if any: a prefix that stops there holds plain text."""

    text: str
    own: int
    special: bool
    pieces: list[str]
    runs: list[tuple[int, int]]


class PrefixCounter:
    """Counts the tokens of all prefixes, with one byte-level tokenizer file."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.vocabulary = Vocabulary(path)
        self.longest = max(map(len, self.vocabulary.ids))
        special = sorted(self.vocabulary.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.pieces = re.compile(piece_pattern())
        self.known: dict[str, bytes | np.ndarray] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        # token -> (rank, left, right) of the merge that makes it
        self.made: dict[str, tuple[int, str, str]] = {}
        for (left, right), (rank, token) in self.vocabulary.merges.items():
            if self.made.setdefault(token, (rank, left, right))[0] != rank:
                raise ValueError(f"two merges make {token!r}")

    @cached_property
    def library(self):
        """The tokenizer itself, loaded only for texts beyond the known scripts."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def split(self, text: str) -> list[str]:
        if text.isascii() or max(text) < chr(KNOWN_SCRIPTS):
            return self.pieces.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def stays(self, left: str, right: str) -> bool:
        """Whether the two tokens, encoded together, stay these two; with an empty
        ``left``, whether ``right`` is what its own letters are encoded to.

        Merges are undone from the last on, on either side of the seam. A merge across it
        that ranks before the one just undone would have come first.
        """
        found = self.pairs.get((left, right))
        if found is None:
            if left:
                found = self.stays("", right) and self.seam_holds(left, right)
            else:
                found = self.vocabulary.merge(list(right)) == [self.vocabulary.ids[right]]
            if len(self.pairs) >= PIECES_REMEMBERED:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found

    def seam_holds(self, left: str, right: str) -> bool:
        merges, made = self.vocabulary.merges, self.made
        limit = len(merges)
        while True:
            across = merges.get((left, right))
            if across and across[0] < limit:
                return False
            last_left, last_right = made.get(left), made.get(right)
            if last_left and (not last_right or last_left[0] > last_right[0]):
                limit, left = last_left[0], last_left[2]
            elif last_right:
                limit, right = last_right[0] + 1, last_right[1]
            else:
                return True

    def learn(self, pieces: Iterable[str]) -> None:
        """Remember the counts of pieces. In sorted order each shares its first letters
        with the one before, and so what was found for them."""
        tokens, pairs, longest = self.vocabulary.ids, self.pairs, self.longest
        before, counts, last = "", [0], [""]
        for piece in sorted(pieces):
            letters = "".join([LETTERS[byte] for byte in piece.encode()])
            same = len(commonprefix((before, letters)))
            before = letters
            del counts[same + 1 :], last[same + 1 :]
            for end in range(same + 1, len(letters) + 1):
                for start in range(end - longest if end > longest else 0, end):
                    token = letters[start:end]
                    if token in tokens:
                        stays = pairs.get((last[start], token))
                        if stays or (stays is None and self.stays(last[start], token)):
                            counts.append(counts[start] + 1)
                            last.append(token)
                            break
                else:
                    raise ValueError(f"the vocabulary cannot spell {letters[:end]!r}")
            if len(letters) == len(piece):
                found = counts[1:]
            else:
                found = [counts[end] for end in accumulate(len(c.encode()) for c in piece)]
            if piece in ("'re", "'ve", "'ll"):
                found[1] = 2  # cut after its letter, the apostrophe stands alone
            self.known[piece] = bytes(found) if len(piece) <= SHORT_PIECE else np.array(found)

    def parts(self, text: str) -> list[Part]:
        """The text cut after its special tokens."""
        found = self.special.split(text) if self.special else [text]
        out = []
        for number in range(0, len(found), 2):
            special = found[number + 1] if number + 1 < len(found) else ""
            part = found[number] + special[:-1]
            runs = [run.span() for run in BLANK_RUN.finditer(part)]
            out.append(Part(part, len(found[number]), bool(special), self.split(part), runs))
        return out

    def prepare(self, texts: Sequence[str]) -> list[list[Part]]:
        """Split texts and learn what they need, together. What was remembered before is
        given up when it is too much."""
        if len(self.known) >= PIECES_REMEMBERED:
            self.known.clear()
        prepared = [self.parts(text) for text in texts]
        needed: set[str] = set()
        for part in chain.from_iterable(prepared):
            needed.update(part.pieces)
            needed.update(part.text[start:end] for start, end in part.runs)
        self.learn(needed.difference(self.known))
        return prepared

    def plain(self, part: Part) -> np.ndarray:
        """Counts of the prefixes of a part, as if it held no special token."""
        sizes = np.fromiter(map(len, part.pieces), dtype=np.int64, count=len(part.pieces))
        tables = map(self.known.__getitem__, part.pieces)
        if sizes.max(initial=0) <= SHORT_PIECE:
            joined = np.frombuffer(b"".join(tables), np.uint8).astype(np.int64)
        else:
            joined = np.array([count for table in tables for count in table])
        totals = joined[np.cumsum(sizes) - 1]
        out = joined + np.repeat(np.cumsum(totals) - totals, sizes)
        for start, end in part.runs:
            before = int(out[start - 1]) if start else 0
            out[end - 1] = before + int(self.known[part.text[start:end]][-1])
        return out

    def prefixes(self, parts: Sequence[Part]) -> np.ndarray:
        """Tokens of the first 0, 1, 2, ... characters of a prepared text."""
        out = [np.zeros(1, dtype=np.int64)]
        base = 0
        for part in parts:
            counts = self.plain(part)
            out.append(base + counts)
            if part.special:
                base += int(counts[part.own - 1] if part.own else 0) + 1
                out.append(np.array([base]))
        return np.concatenate(out)


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens. Counts can fall
    when a character completes a token, so the last fitting place is meant."""
    return int(np.flatnonzero(counts <= budget)[-1])


def together(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts of a batch in groups of bounded size."""
    numbers: list = []
    texts: list[str] = []
    held = 0
    for number, value in zip(batch.column(0), batch.column(1)):
        numbers.append(number)
        texts.append(value.as_py() or "")
        held += len(texts[-1])
        if held >= CHARACTERS_TOGETHER:
            yield numbers, texts
            numbers, texts, held = [], [], 0
    yield numbers, texts


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    """One counter per file and Python worker."""
    return PrefixCounter(path)


def token_counts(
    docs: DataFrame,
    path: str,
    budgets: Sequence[int] = (512,),
    prefixes: bool = False,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Count the tokens of every whole text, and answer budgets from its prefix table.

    Returns ``key``, ``n_bytes`` (UTF-8) and ``n_tokens`` (longs), ``fits_<b>`` for every
    budget (characters of the longest prefix that has at most that many tokens) and, with
    ``prefixes``, ``prefix_tokens``: the tokens of the first 0, 1, 2, ... characters, so
    that any truncation can be answered later by a look at one array element.

    A NULL text counts as empty: no bytes, no tokens, 0 characters fit. A NULL or repeated
    key is passed through; other columns are not looked at, whatever their names; an empty
    table gives an empty one. One row in, one row out, no shuffle; texts are never cut.
    """
    if any(budget < 0 for budget in budgets):
        raise ValueError("a token budget cannot be negative")
    key_type = docs.schema[key].dataType
    fields = [T.StructField(key, key_type)]
    names = ["n_bytes", "n_tokens", *[f"fits_{budget}" for budget in budgets]]
    fields += [T.StructField(name, T.LongType()) for name in names]
    if prefixes:
        fields.append(T.StructField("prefix_tokens", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        own = counter(path)
        kinds = [to_arrow_type(key_type), *[pa.int64()] * len(names)]
        kinds += [pa.list_(pa.int32())] if prefixes else []
        schema = pa.schema([pa.field(f.name, kind) for f, kind in zip(fields, kinds)])

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for numbers, texts in together(batch):
                    for number, words, parts in zip(numbers, texts, own.prepare(texts)):
                        counts = own.prefixes(parts)
                        row = (number.as_py(), len(words.encode()), int(counts[-1]))
                        row += tuple(longest_prefix(counts, budget) for budget in budgets)
                        yield (*row, counts.astype(np.int32)) if prefixes else row

        yield from in_batches(
            rows(), schema, size=lambda row: 64 + (4 * len(row[-1]) if prefixes else 0)
        )

    return map_arrow(docs.select(column(key), column(text).cast("string")), run, T.StructType(fields))
