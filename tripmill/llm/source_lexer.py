"""A lexer for the assignments of source code and configuration.

One linear pass makes tokens of a whole text: strings with their quoting, words, separators,
brackets and line ends. From the stream of tokens come pairs of names and values, whatever
language or format the text is in: assignments and declarations with types, entries of maps
and subscripts, arguments of calls and command lines, tags, and blocks of lines.

A value is a list of alternatives (the arms of a choice), an alternative a list of parts. A
part is a literal, (start, end, quoted), or a word, (start, end), that may be another name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

STRING, WORD, MARK, LINE = range(4)

_SPACE = re.compile(r"(?:[^\S\n]|\\\r?\n)++")
_WORD = re.compile(r"""[^\s"'`;,(){}\[\]<>#+&|=:\\]++""")
_MARK = re.compile(r"===|!==|==|!=|<=|>=|=>|:=|\|\|=|&&=|\+=|->|::|.", re.DOTALL)
_PREFIX = re.compile(r"(?:[rbuf]|rb|br|rf|fr)", re.IGNORECASE)
_CLOSING = {quote: re.compile(rf"(?:[^{quote}\\\n]|\\.)*+{quote}") for quote in "\"'"}
_NAME = re.compile(r"([A-Za-z_$@][\w.$@-]*+)[?!]?\Z")
_WHOLE_NAME = re.compile(r"[A-Za-z_$@][\w.$@-]*+\Z")
_DOTTED = re.compile(r"[^\W\d]\w*+(?:\.[^\W\d]\w*+)++\Z")
_HOLE = re.compile(r"\$?\{([^{}\n]*+)\}")
_TAG = re.compile(r"<([A-Za-z_][\w.:-]*+)>([^<>]*+)</([A-Za-z_][\w.:-]*+)\s*+>")
_INSIDE = re.compile(r"(?<![\w.$-])([A-Za-z_][\w.-]*+)=([^\s;&\"',=]++)")

SEPARATORS = {"=", ":", "=>", ":=", "||=", "&&=", "+="}
TYPE_MARKS = {"[", "]", "<", ">", ",", "|", "&", "'", "*", "::", "?"}

# Words after ``name:`` that are its type and no name.
TYPES = {
    "str", "string", "String", "text", "Text", "bytes", "int", "float", "number", "bool", "boolean",
    "char", "any", "Any", "object", "Object",
}
# Words between the arms of a choice, and calls whose only argument names what they look up.
CHOICES = {"or", "else", "if", "||", "??", "?"}
LOOK_UPS = re.compile(r"(?i)(?:get\w*|env|getenv|environ|lookup|read\w*|fetch\w*|load\w*|find\w*|prompt|input|open|require|resolve|import|param|property|config|var|ref)\Z")
SETTERS = re.compile(r"(?:set|with|put|use|add|Set|With|Put|Use|Add)(?=[A-Z_])_?")
DEFAULTS = {"default", "fallback", "defaultValue", "default_value"}
NAMING, VALUING = {"name", "key", "variable"}, {"value", "val"}


class Token(NamedTuple):
    kind: int
    start: int
    end: int
    text: str  # of a string, what is between its quotes
    inner: int  # of a string, where that begins
    formatted: bool  # a string with holes


def tokens_of(text: str) -> list[Token]:
    """The tokens of a text, in linear time. A quote that is not closed (by a line's end,
    or for three in a row by the text's) is a mark, and so is one within a word."""
    out: list[Token] = []
    at, size = 0, len(text)
    dead = {}  # up to where a kind of quote is known not to be closed
    while at < size:
        space = _SPACE.match(text, at)
        if space:
            at = space.end()
            continue
        letter = text[at]
        if letter == "\n":
            out.append(Token(LINE, at, at + 1, "\n", at, False))
            at += 1
            continue
        if letter in "\"'`":
            three = text.startswith(letter * 3, at) and letter != "`"
            quote = letter * 3 if three else letter
            if at >= dead.get(quote, 0):
                prefix = bool(out) and out[-1].kind == WORD and out[-1].end == at
                marked = prefix and _PREFIX.fullmatch(out[-1].text)
                begin = at + len(quote)
                if prefix and not marked and letter == "'":
                    end = -1  # an apostrophe
                elif three or letter == "`":
                    end = text.find(quote, begin)
                    if end < 0:
                        dead[quote] = size
                else:
                    closed = _CLOSING[letter].match(text, begin)
                    end = closed.end() - 1 if closed else -1
                    if end < 0:
                        line = text.find("\n", at)
                        dead[quote] = size if line < 0 else line
                if end >= 0:
                    formatted = letter == "`" or bool(marked and "f" in out[-1].text.lower())
                    if marked:
                        out.pop()
                    out.append(Token(STRING, at, end + len(quote), text[begin:end], begin, formatted))
                    at = end + len(quote)
                    continue
            out.append(Token(MARK, at, at + 1, letter, at, False))
            at += 1
            continue
        word = _WORD.match(text, at)
        if word:
            out.append(Token(WORD, at, word.end(), word.group(), at, False))
            at = word.end()
            continue
        mark = _MARK.match(text, at)
        out.append(Token(MARK, at, mark.end(), mark.group(), at, False))
        at = mark.end()
    return out


Pair = tuple[list[str], list[list[tuple]]]


class Pairs:
    """The pairs of a text, from its tokens."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.tokens = tokens_of(text)
        self.done: set[int] = set()  # separators that belong to a declaration

    def is_mark(self, place: int, *marks: str) -> bool:
        return 0 <= place < len(self.tokens) and self.tokens[place].kind == MARK and self.tokens[place].text in marks

    def kind(self, place: int) -> int | None:
        return self.tokens[place].kind if 0 <= place < len(self.tokens) else None

    def name_before(self, place: int) -> str | None:
        """The name that ends before a separator: a word's last part, a string, or the
        string of a subscript."""
        place -= 1
        if self.kind(place) == WORD and not self.tokens[place].text.strip("?.!*|&-"):
            place -= 1  # of ?= and the like
        if self.is_mark(place, "]") and self.kind(place - 1) == STRING and self.is_mark(place - 2, "["):
            place -= 1
        token = self.tokens[place] if place >= 0 else None
        if token is None or token.kind not in (WORD, STRING):
            return None
        if token.kind == STRING:
            return token.text if _WHOLE_NAME.match(token.text) else None
        found = _NAME.search(token.text) or _NAME.search(token.text, max(0, _start_of_name(token.text)))
        return found[1].lstrip("-") if found else None

    def literal(self, token: Token) -> list[tuple]:
        """A string's parts: what is between the holes, and what the holes name."""
        start, end = token.inner, token.inner + len(token.text)
        if not token.formatted:
            body = token.text
            start += len(body) - len(body.lstrip())
            end -= len(body) - len(body.rstrip()) if body.strip() else 0
            return [(start, end, True)]
        parts, at = [], start
        for hole in _HOLE.finditer(self.text, start, end):
            if hole.start() > at:
                parts.append((at, hole.start(), True))
            if _WHOLE_NAME.match(hole[1]):
                parts.append(hole.span(1))
            at = hole.end()
        if at < end:
            parts.append((at, end, True))
        return parts

    def call(self, place: int) -> tuple[list[list[tuple]], int | None]:
        """Of a call, whose bracket is at ``place``: the literal that it hands on, and where
        it is closed. That is the last of several arguments, or the only one unless the call
        looks it up."""
        look_up = LOOK_UPS.match(re.split(r"[.]", self.tokens[place - 1].text)[-1])
        strings, depth, at = [], 0, place
        while at < len(self.tokens):
            token = self.tokens[at]
            if token.kind == STRING:
                strings.append(token)
            elif token.kind == MARK and token.text in "([{":
                depth += 1
            elif token.kind == MARK and token.text in ")]}":
                depth -= 1
                if not depth:
                    break
            elif token.kind == MARK and token.text in SEPARATORS:
                named = self.kind(at - 1) == WORD and self.tokens[at - 1].text in DEFAULTS
                given = named and self.kind(at + 1) == STRING
                return [self.literal(self.tokens[at + 1])] if given else [], None
            elif token.kind == MARK and token.text == ";":
                break
            at += 1
        closed = at if not depth and at < len(self.tokens) else None
        if len(strings) > 1 or (strings and not look_up):
            return [self.literal(strings[-1])], closed
        return [], closed

    def value(self, place: int, separator: str) -> list[list[tuple]]:
        """The alternatives of the value that begins at ``place``."""
        at = place
        while self.kind(at) == LINE:
            at += 1
        if at > place:
            # On a later line only what cannot be the next entry.
            key = self.kind(at) == STRING and self.is_mark(at + 1, ":", "=>")
            if key or not (self.kind(at) == STRING or self.is_mark(at, "(")):
                return []
        out, parts, depth = [], [], 0
        expecting = True
        while at < len(self.tokens):
            token = self.tokens[at]
            if token.kind == MARK and token.text == "(" and expecting:
                depth += 1
            elif token.kind == MARK and token.text == ")" and depth:
                depth -= 1
            elif token.kind == LINE and (depth or self.is_mark(at + 1, "+")):
                pass
            elif token.kind == STRING and (expecting or depth or parts):
                if self.is_mark(at + 1, ":") and self.tokens[at + 1].start == token.end and out + parts:
                    break
                parts += self.literal(token)
                expecting = False
            elif token.kind == WORD and token.text in CHOICES and not expecting:
                if token.text == "if":
                    # The condition is no value; the other arm follows.
                    while at < len(self.tokens) and self.kind(at) != LINE and self.tokens[at].text != "else":
                        if self.tokens[at].kind == MARK and self.tokens[at].text in SEPARATORS:
                            break
                        at += 1
                out, parts, expecting = [*out, parts], [], True
                if at >= len(self.tokens) or self.tokens[at].text != token.text and self.tokens[at].text != "else":
                    break
            elif token.kind == MARK and token.text in ("|", "&") and self.is_mark(at + 1, token.text):
                out, parts, expecting = [*out, parts], [], True
                at += 1
            elif token.kind == WORD and expecting:
                if self.is_mark(at + 1, "("):
                    handed, closed = self.call(at + 1)
                    out += handed
                    if closed is None:
                        break
                    at, expecting = closed + 1, False
                    continue
                before = self.is_mark(at + 1, *SEPARATORS)
                if before and not any(map(str.isdigit, token.text)):
                    break  # the name of what follows
                expecting = False
                if before:  # a literal, whatever comes
                    parts.append((token.start, token.end, False))
                    break
                parts.append((token.start, token.end))
            elif token.kind == MARK and token.text == "+" and not expecting:
                expecting = True
            elif token.kind == WORD and token.text == "." and not expecting:
                expecting = True
            else:
                break
            at += 1
        return [alternative for alternative in [*out, parts] if alternative]

    def block(self, place: int) -> list[list[tuple]]:
        """The lines below an entry that are indented more, after ``|`` or ``>``."""
        line = self.text.rfind("\n", 0, self.tokens[place].start) + 1
        indent = len(self.text[line:]) - len(self.text[line:].lstrip(" ")) if self.text[line : line + 1] == " " else 0
        at = self.text.find("\n", self.tokens[place].start) + 1
        parts = []
        while 0 < at < len(self.text):
            end = self.text.find("\n", at)
            end = len(self.text) if end < 0 else end
            row = self.text[at:end]
            if row.strip():
                if len(row) - len(row.lstrip(" ")) <= indent:
                    break
                inner = row.strip()
                if " " not in inner:
                    start = at + row.index(inner)
                    parts.append((start, start + len(inner), True))
            at = end + 1
        return [parts] if parts else []

    def declared(self, place: int) -> int | None:
        """Of ``name: type = value``, with the colon at ``place``, where the equals sign is."""
        at = place + 1
        words = 0
        while at < len(self.tokens) and self.kind(at) != LINE:
            token = self.tokens[at]
            if token.kind == MARK and token.text in ("=", ":="):
                one = words == 1 and at == place + 2
                return at if words and (not one or self.tokens[at - 1].text.rstrip("?!") in TYPES or self.tokens[at - 1].text[-1] in "?!") else None
            if token.kind == WORD:
                words += 1
            elif token.kind != MARK or token.text not in TYPE_MARKS:
                return None
            at += 1
        return None

    def __iter__(self) -> Iterator[Pair]:
        waiting: list[str] = []  # names of a = b = ... so far
        naming, left = None, 0
        for place, token in enumerate(self.tokens):
            if token.kind == STRING and "=" in token.text:
                for found in _INSIDE.finditer(self.text, token.inner, token.inner + len(token.text)):
                    yield [found[1]], [[(*found.span(2), True)]]
            if token.kind == WORD and token.text.startswith("--") and self.kind(place + 1) in (WORD, STRING):
                after = self.tokens[place + 1]
                if not after.text.startswith("-") and _NAME.match(token.text.lstrip("-")):
                    parts = self.literal(after) if after.kind == STRING else [(after.start, after.end)]
                    yield [token.text.lstrip("-")], [parts]
            if token.kind != MARK:
                continue
            if token.text == "(" and self.kind(place + 1) == STRING and self.kind(place - 1) == WORD:
                first = self.tokens[place + 1]
                if self.is_mark(place + 2, ")"):
                    called = self.tokens[place - 1].text.split(".")[-1]
                    if SETTERS.match(called):
                        yield [SETTERS.sub("", called, count=1)], [self.literal(first)]
                elif self.is_mark(place + 2, ",") and self.kind(place + 3) == STRING and _WHOLE_NAME.match(first.text):
                    yield [first.text], [self.literal(self.tokens[place + 3])]
            if token.text not in SEPARATORS or place in self.done:
                continue
            name = self.name_before(place)
            if name is None:
                waiting = []
                continue
            start = place + 1
            if token.text == ":":
                equals = self.declared(place)
                if equals is not None:
                    self.done.add(equals)
                    yield [name], self.value(equals + 1, "=")
                    waiting = []
                    continue
                if self.is_mark(start, "|", ">") and (self.kind(start + 1) == LINE or self.kind(start + 2) == LINE):
                    yield [name], self.block(start)
                    waiting = []
                    continue
            names = [*waiting, name]
            waiting = []
            if self.kind(start) == WORD and self.is_mark(start + 1, "=", ":="):
                word, then = self.tokens[start], self.tokens[start + 1]
                spaced = then.start > word.end or self.kind(start + 2) == STRING
                if spaced and _WHOLE_NAME.match(word.text) and not any(map(str.isdigit, word.text)):
                    waiting = names  # a = b = ...: the value is that of all the names
                    continue
            value = self.value(start, token.text)
            if value and left and name.lower() in VALUING:
                names = [*names, naming]
                left = 0
            left = max(0, left - 1)
            if name.lower() in NAMING and len(value) == 1 and len(value[0]) == 1:
                naming = self.text[value[0][0][0] : value[0][0][1]]
                left = 3 if _WHOLE_NAME.match(naming) else 0
            yield names, value
        for found in _TAG.finditer(self.text):
            if found[1] == found[3] and found[2].strip():
                start = found.start(2) + len(found[2]) - len(found[2].lstrip())
                yield [found[1]], [[(start, start + len(found[2].strip()), True)]]


def _start_of_name(word: str) -> int:
    """Where the last part of a word that could be a name begins."""
    at = len(word)
    while at and (word[at - 1].isalnum() or word[at - 1] in "_.$@-?!"):
        at -= 1
    while at < len(word) and not (word[at].isalpha() or word[at] in "_$@"):
        at += 1
    return at


def is_path(word: str) -> bool:
    """Whether an unquoted word is a name with dots, as of a member or a module."""
    return bool(_DOTTED.match(word))
