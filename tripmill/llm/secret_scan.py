"""Secrets in source code, configuration and prose.

Three fixed patterns find assignments, access keys and long hex strings wherever they
stand. On top of them, the text is lexed into pairs of names and values
(:mod:`tripmill.llm.source_lexer`). A constant that is stored under a harmless name and
handed on, below or above, is followed to its literals. A pair is reported when its target
name is sensitive and its literal looks like a value.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripmill.llm.common import column, in_batches, map_arrow
from tripmill.llm.source_lexer import Pairs, is_path

# The kinds, in the order in which spans at one place are listed.
KINDS = ("assign", "access", "hex", "named")

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# How much a part of a name tells that its value is secret.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0,
    "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "bearer": 0.9, "auth": 0.6, "authorization": 0.7, "private": 0.6, "key": 0.5,
    "api": 0.4, "access": 0.4, "signing": 0.5, "signature": 0.5, "encryption": 0.5,
    "client": 0.2, "session": 0.4, "salt": 0.4, "cert": 0.4, "pin": 0.3, "login": 0.3,
}

# Words that stand beside such words without a mark between, and tell nothing themselves.
NAME_HARMLESS = {
    "db", "my", "our", "app", "user", "usr", "admin", "root", "aws", "gcp", "azure", "ssh", "rsa", "ssl", "tls",
    "jwt", "web", "host", "server", "service", "account", "master", "public", "main", "test", "prod", "dev",
    "old", "new", "value", "val", "string", "str", "data",
}

# A word of this weight is told within a longer one, whatever stands before it.
STRONG = 0.9

# Parts that say the value is something about a secret rather than one.
NAME_EXCUSES = {"length", "len", "count", "size", "type", "name", "path", "file", "url", "field", "id"}

# Literals that stand for a value to be filled in.
PLACEHOLDER = re.compile(
    r"(?i)(?:.*(?:example|changeme|change_me|placeholder|your[_-]|redacted|dummy).*"
    r"|true|false|null|none|undefined|x+|\*+|\$\{.*|\$\(.*|<.*>|\{\{.*|%.*%)\Z"
)

NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

# Words that are never a name.
NOTHING = {"None", "null", "nil", "undefined"}

# Names count as sensitive, and pairs are reported, from these scores on.
LEAST_SCORE = 0.6
LEAST_PAIR = 0.45
LEAST_LENGTH = 6


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by the fixed patterns, leftmost first, without overlap within
    a kind; assignments of too short a value are dropped after matching."""
    found = []
    if "=" in text or ":" in text:
        found += [
            (m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= ASSIGN_LEAST
        ]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


NAME_WORDS = sorted({*NAME_WEIGHTS, *NAME_HARMLESS}, key=len, reverse=True)


def known_words(part: str) -> list[str]:
    """The known words a part of a name is made of, also in the plural: ``secretkeys`` is
    secret and key. Before a strong word, or two that count, anything may stand."""
    if part in NAME_WEIGHTS:
        return [part]
    words: list[str] = []
    end = len(part)
    while end:
        ends = (end, end - 1) if part[end - 1] == "s" else (end,)
        word, at = next(((w, e) for e in ends for w in NAME_WORDS if part.endswith(w, 0, e)), ("", 0))
        if not word:
            break
        words.append(word)
        end = at - len(word)
    weights = [NAME_WEIGHTS[word] for word in words if word in NAME_WEIGHTS]
    if end and len(weights) < 2 and max(weights, default=0.0) < STRONG:
        return [part]
    return words


def name_score(name: str) -> float:
    """0 to 1: how sure a name's parts make it that the value is secret."""
    parts = [part.lower() for part in NAME_PARTS.findall(name)]
    if not parts or parts[-1] in NAME_EXCUSES:
        return 0.0
    harmless = 1.0
    for part in parts:
        for word in known_words(part):
            harmless *= 1.0 - NAME_WEIGHTS.get(word, 0.0)
    return 1.0 - harmless


def literal_score(literal: str, quoted: bool = True) -> float:
    """0 to 1: how much a literal looks like a value, by length, variety and kinds of
    characters; a placeholder or prose is none. With blanks it has to be quoted and to
    hold a digit."""
    if len(literal) < LEAST_LENGTH or PLACEHOLDER.match(literal):
        return 0.0
    if any(map(str.isspace, literal)) and not (quoted and len(literal.split()) <= 6 and any(map(str.isdigit, literal))):
        return 0.0
    counts = Counter(literal)
    total = sum(counts.values())
    entropy = -sum(n / total * math.log2(n / total) for n in counts.values())
    kinds = sum(
        any(test(c) for c in counts)
        for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())
    )
    return min(1.0, entropy / 4.0) * min(1.0, 0.55 + 0.15 * kinds)


# A sensitive name holds one of the first, or two of the others.
_ALONE = [word for word, weight in NAME_WEIGHTS.items() if weight >= LEAST_SCORE]
_TOGETHER = [word for word, weight in NAME_WEIGHTS.items() if weight < LEAST_SCORE]


def may_name_secrets(text: str) -> bool:
    """False if a text can hold no sensitive name, or nothing that gives a name a value."""
    if not any(mark in text for mark in ("=", ":", "(", "<", "--")):
        return False
    lower = text.lower()
    return any(word in lower for word in _ALONE) or sum(map(lower.count, _TOGETHER)) > 1


_PLAIN = re.compile(r"[\w.$@-]+\Z")


class _Values:
    """The values of a text's names, and the literals they come to."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.of: dict[str, list[list[tuple]]] = {}

    def add(self, names: list[str], value: list[list[tuple]]) -> None:
        for name in names:
            if name not in NOTHING:
                self.of.setdefault(name, []).extend(value)

    def word(self, part: tuple) -> str | None:
        """The name that a part stands for; None for a literal."""
        if len(part) == 3:
            return None
        word = self.text[part[0] : part[1]]
        return word if word in self.of else None

    def is_literal(self, part: tuple) -> bool:
        """A quoted literal, or a word that no name looks like."""
        if len(part) == 3:
            return True
        word = self.text[part[0] : part[1]]
        if word in NOTHING or is_path(word):
            return False
        return any(map(str.isdigit, word)) or not _PLAIN.match(word)

    def literals(self, parts: list[tuple]) -> list[tuple]:
        """The literals that parts are made of, names followed, in order and once each."""
        found: dict[tuple, None] = {}
        seen: set[str] = set()
        waiting = [iter(parts)]
        while waiting:
            part = next(waiting[-1], None)
            if part is None:
                waiting.pop()
                continue
            name = self.word(part)
            if name is None:
                if self.is_literal(part):
                    found[part] = None
            elif name not in seen:
                seen.add(name)
                waiting.append(p for value in self.of[name] for p in value)
        return list(found)


def named_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of literals that reach a sensitive name, directly or
    through other names. Each is listed once, with its best score."""
    if not may_name_secrets(text):
        return []
    values = _Values(text)
    targets: list[tuple[float, str, list[tuple]]] = []
    for names, value in Pairs(text):
        values.add(names, value)
        sensitive, name = max((name_score(name), -place, name) for place, name in enumerate(names))[::2]
        if sensitive >= LEAST_SCORE:
            targets += [(sensitive, name, parts) for parts in value]
    # A name that stands for another has that one's values: each once, for its best target.
    aliases: dict[str, tuple[float, str]] = {}
    found: dict[tuple[int, int], tuple[str, float]] = {}
    direct: list[tuple[float, str, list[tuple]]] = []
    waiting = sorted(targets, key=lambda target: -target[0])
    while waiting:
        following = []
        for sensitive, name, parts in waiting:
            other = values.word(parts[0]) if len(parts) == 1 else None
            if other is None:
                direct.append((sensitive, name, parts))
            elif sensitive > aliases.get(other, (0.0, ""))[0]:
                aliases[other] = (sensitive, name)
                following += [(sensitive, name, value) for value in values.of[other]]
        waiting = following
    for sensitive, name, parts in direct:
        literals = values.literals(parts)
        joined = "".join(text[part[0] : part[1]] for part in literals)
        score = sensitive * literal_score(joined, all(part[-1] is True for part in literals))
        if score >= LEAST_PAIR:
            for part in literals:
                if part[1] > part[0] and score > found.get(part[:2], ("", 0.0))[1]:
                    found[part[:2]] = (name, score)
    return [(a, b, name, score) for (a, b), (name, score) in found.items()]


def secret_spans(text: str) -> list[tuple[str, int, int, str | None, float | None]]:
    """(kind, start, end, name, score) of all spans by start, kind and end. A literal
    that lies within a base span is not listed again."""
    base = base_spans(text)
    starts = sorted((a, b) for a, b, _ in base)
    reach = list(accumulate((b for _, b in starts), max))
    out = [(a, KINDS.index(kind), b, None, None) for a, b, kind in base]
    for a, b, name, score in named_spans(text):
        before = bisect_right(starts, (a, len(text)))
        if not before or reach[before - 1] < b:
            out.append((a, KINDS.index("named"), b, name, score))
    out.sort(key=lambda span: span[:3])
    return [(KINDS[kind], a, b, name, score) for a, kind, b, name, score in out]


SPAN = "array<struct<kind string, start long, end long, name string, score double>>"


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All secrets of every whole text: ``key`` and ``spans``, an array of (kind, start,
    end, name, score) in code points, the end exclusive; name and score only for kind
    ``named``. Narrow: one row in, one row out, no shuffle.

    A NULL text counts as empty and has no spans; a NULL or repeated key is passed
    through; other columns are not looked at, whatever their names; an empty table gives
    an empty one. Texts of any length are scanned whole and in linear time; finished rows
    leave the task in batches of bounded size.
    """
    key_type = docs.schema[key].dataType
    spans_type = T.DataType.fromDDL(SPAN)
    result = T.StructType([T.StructField(key, key_type), T.StructField("spans", spans_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(result)
        names = ("kind", "start", "end", "name", "score")

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for number, value in zip(batch.column(0), batch.column(1)):
                    found = secret_spans(value.as_py() or "")
                    yield number.as_py(), [dict(zip(names, span)) for span in found]

        yield from in_batches(rows(), schema, size=lambda row: 64 + sum(64 + len(span["name"] or "") for span in row[1]))

    return map_arrow(docs.select(column(key), column(text).cast("string")), run, result)
