"""The main text of web pages, found by a style tree of each site.

The DOMs of a site's pages are merged: elements with the same path of tags, classes and ids
are one node of its tree. How a node's elements are made up (the order of their children)
and what texts, links and images they hold is counted over the pages. A node whose make-up
and content are much the same everywhere has little entropy, and little importance; what
differs from page to page has much. A branch that holds no important node is removed from
every page.

Entropy alone cannot tell an advert that changes on every page from the article, nor a
paragraph that many pages share from a notice. So a node's part on the page (menu, form,
advert, article, ...), read from its tag, role, classes and id, weighs its importance: 0 for
what is never the article, at least the threshold within the article.
"""

from __future__ import annotations

import hashlib
import html as H
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import column, in_batches, map_arrow, packed, unpacked, written

# A branch is removed if no node in it is this important.
LEAST_IMPORTANCE = 0.2

# How much a node's own make-up counts beside what it holds: 1 - DAMPING ** (its styles).
DAMPING = 0.9

# Elements below this depth count as part of their ancestor there.
MOST_DEPTH = 64

# Parts of a page, from the least to the most telling: what is removed, what may be
# anything, and the article by a class or by its tag.
NOISE, OPEN, NAMED, ARTICLE = range(4)

# HTML's elements without content, with raw content, within a line, those that
# end a paragraph, and those of a page's head.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
IN_HEAD = set("base link meta noscript script style template title".split())
# An element ends an open one of these, unless one of those was opened since.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist")),
}
P_STAYS = ("td", "th", "caption", "button", "object")

# What tags, roles and words in classes and ids say about an element's part.
NOISE_TAGS = RAW | set(
    "head nav aside footer form button select datalist input menu dialog noscript template svg canvas video "
    "audio object search".split()
)
NOISE_ROLES = set(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar "
    "tablist status".split()
)
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo "
    "promos promotion promoted banner banners sidebar sidebars aside rail menu menus nav navs navbar navigation "
    "breadcrumb breadcrumbs footer footers masthead topbar cookie cookies consent gdpr notice notices alert alerts "
    "popup popups modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus "
    "respond reply replies share sharing social related recommended recommendations widget widgets search searchbox "
    "pagination pager toolbar copyright disclaimer skip form forms".split()
)
ARTICLE_WORDS = set("article post entry story content main body text prose".split())
NOT_WORDS = set("no not has have with without is hide".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_QUOTE_OR_END = re.compile(r"[\"'>]")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'<>/=])([^\s"'<>/=]++)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]++))""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Attributes that tell elements of one tag apart.
NOTED = ("class", "id", "role", "itemprop")


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")


def part_of(tag: str, attributes: dict[str, str], around: int, parent: str) -> int:
    """An element's part on the page, given that of its parent element."""
    if around == NOISE:
        return NOISE
    if tag in ("html", "body"):
        return around
    if tag == "main":
        return ARTICLE
    if tag in NOISE_TAGS or attributes.get("role", "").lower() in NOISE_ROLES:
        return NOISE
    if tag == "header" and parent != "article":
        return NOISE
    words: set[str] = set()
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        found = [word.lower() for word in _WORD.findall(token)]
        if found and found[0] not in NOT_WORDS:
            words.update(found)
    if words & NOISE_WORDS or (words & {"header"} and not words & ARTICLE_WORDS):
        return NOISE
    if tag == "article" or attributes.get("role") in ("main", "article") or attributes.get("itemprop") == "articleBody":
        return ARTICLE
    return max(around, NAMED) if words & ARTICLE_WORDS else around


class Page:
    """A page's nodes, each once, what they are made of, and its texts in order."""

    def __init__(self) -> None:
        self.number: dict[tuple[int, str], int] = {}
        self.keys: list[int] = []
        self.paths: list[bytes] = []
        self.parts: list[int] = []
        self.features: Counter = Counter()  # (node, is text, hash) -> copies
        self.texts: list[tuple[int, int, str]] = []  # node, part, text; a break has node -1

    def node(self, above: int, signature: str, part: int) -> int:
        number = self.number.get((above, signature))
        if number is None:
            number = self.number[above, signature] = len(self.keys)
            path = (self.paths[above] if above >= 0 else b"") + _hash(signature).to_bytes(8, "big")
            self.keys.append(int.from_bytes(hashlib.blake2b(path, digest_size=8).digest(), "big", signed=True))
            self.paths.append(path)
            self.parts.append(part)
        return number


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), a or b or c)
    return found


def parse(text: str) -> Page:
    """The page of an HTML text, however broken, in one pass. Tags that are missing are
    implied as HTML says for paragraphs, lists, tables and the head."""
    page = Page()
    # Open elements: tag, node, part, depth, hash of the children so far, last child.
    stack: list[list] = [["", page.node(-1, "#page", OPEN), OPEN, 0, 0, ""]]
    opened: dict[str, list[int]] = {}
    unclosed: set[str] = set()  # quotes that are known not to come again

    def last(tags) -> int:
        return max((places[-1] for tag in tags if (places := opened.get(tag))), default=0)

    def child(signature: str) -> None:
        top = stack[-1]
        if top[5] != signature:
            top[4], top[5] = hash_pair(top[4], signature), signature

    def hash_pair(before: int, signature: str) -> int:
        return (before * 1_000_003 + _hash(signature)) & 0x7FFF_FFFF_FFFF_FFFF

    def close(place: int) -> None:
        while len(stack) > place:
            tag, node, part, _, style, _ = stack.pop()
            opened[tag].pop()
            page.features[node, False, style] += 1
            if tag not in INLINE:
                page.texts.append((-1, part, " "))

    def say(raw: str) -> None:
        if raw:
            _, node, part, _, _, _ = stack[-1]
            plain = H.unescape(raw) if "&" in raw else raw
            page.texts.append((node, part, plain))
            solid = " ".join(plain.split())
            if solid:
                child("#text")
                page.features[node, True, _hash(solid) >> 1] += 1

    at, size = 0, len(text)
    while at < size:
        start = text.find("<", at)
        if start < 0:
            say(text[at:])
            break
        after = text[start + 1 : start + 2]
        if not (after in ("!", "?", "/") or (after.isascii() and after.isalpha())):
            # No tag begins here: what follows up to the next is one text with it.
            following = text.find("<", start + 1)
            say(text[at : following if following >= 0 else size])
            at = following if following >= 0 else size
            continue
        say(text[at:start])
        if after in ("!", "?"):
            if text.startswith("<!--", start):
                end = text.find("-->", start + 4)
                at = size if end < 0 else end + 3
            else:
                end = text.find(">", start)
                at = size if end < 0 else end + 1
            continue
        closing = after == "/"
        named = _NAME.match(text, start + 1 + closing)
        if not named:
            end = text.find(">", start)
            at = size if end < 0 else end + 1
            continue
        tag = named.group().lower()
        # The tag ends at the first > outside quotes.
        end = named.end()
        while True:
            mark = _QUOTE_OR_END.search(text, end)
            if not mark:
                end = size
                break
            end = mark.end()
            if mark.group() == ">":
                break
            if mark.group() not in unclosed:
                other = text.find(mark.group(), end)
                if other < 0:
                    unclosed.add(mark.group())
                else:
                    end = other + 1
        inside = text[named.end() : end].rstrip(">")
        at = end
        if closing:
            if tag not in INLINE:
                page.texts.append((-1, stack[-1][2], " "))
            if opened.get(tag):
                close(opened[tag][-1])
            continue
        if opened.get("head") and tag not in IN_HEAD and tag != "head":
            close(opened["head"][-1])
        if tag in ENDS_P and last(("p",)) > last(P_STAYS):
            close(last(("p",)))
        if tag in ENDS:
            these, those = ENDS[tag]
            if last(these) > last(those):
                close(last(these))
        attributes = _attributes(inside) if "=" in inside else {}
        signature = tag
        for name in NOTED:
            if attributes.get(name):
                tokens = sorted(set(re.sub(r"\d+", "0", attributes[name]).split()))
                signature += f" {name}={' '.join(tokens)}"
        child(signature)
        above = stack[-1]
        part = part_of(tag, attributes, above[2], above[0])
        depth = above[3] + 1
        node = page.node(above[1], signature, part) if depth <= MOST_DEPTH else above[1]
        for name in ("href", "src"):
            if attributes.get(name):
                page.features[node, True, _hash(f"{name} {attributes[name]}") >> 1] += 1
        if tag not in INLINE:
            page.texts.append((-1, part, " "))
        if tag in VOID:
            page.features[node, False, 0] += 1
            continue
        opened.setdefault(tag, []).append(len(stack))
        stack.append([tag, node, part, depth, 0, ""])
        if tag in RAW:
            closed = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(text, at)
            raw_end = closed.start() if closed else size
            if raw_end > at:
                page.features[node, True, _hash(text[at:raw_end]) >> 1] += 1
            at = raw_end
            if not closed:
                break
    close(1)
    page.features[stack[0][1], False, stack[0][4]] += 1
    return page


def main_text(page: Page, low: set[int]) -> str:
    """The texts of the most telling part of the page, without its noise and the branches in
    ``low``. If these are all there is besides the noise, they stay."""
    for dropped in (low, set()):
        kept = [
            (part, text) for node, part, text in page.texts
            if node < 0 or (part != NOISE and page.keys[node] not in dropped)
        ]
        solid = [part for part, text in kept if text != " " and not text.isspace()]
        if solid:
            best = max(solid)
            pieces = [text for part, text in kept if part >= best or text == " "]
            return " ".join("".join(pieces).split())
    return ""


_NODES = pa.schema(
    [
        ("ha", pa.int64()), ("hb", pa.int64()), ("site", pa.string()), ("node", pa.int64()), ("path", pa.binary()),
        ("part", pa.int32()), ("is_text", pa.bool_()), ("feature", pa.int64()), ("copies", pa.int64()),
    ]
)
_NODES_DDL = (
    "ha long, hb long, site string, node long, path binary, part int, is_text boolean, feature long, copies long"
)


def _node_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node of a page (with its path), and one per distinct feature of it. What
    noise holds makes it no more important."""

    def rows():
        for batch in batches:
            for ha, hb, site, body in zip(*[batch.column(i) for i in range(4)]):
                page = parse(body.as_py())
                ha, hb, site = ha.as_py(), hb.as_py(), site.as_py()
                for key, path, part in zip(page.keys, page.paths, page.parts):
                    yield ha, hb, site, key, path, part, None, None, 1
                for (node, is_text, feature), copies in page.features.items():
                    if page.parts[node] == NOISE:
                        continue
                    yield ha, hb, site, page.keys[node], None, None, is_text, feature, copies

    return in_batches(rows(), _NODES, size=lambda row: 80 + len(row[4] or b""))


_TREE = pa.schema(
    [("site", pa.string()), ("node", pa.int64()), ("part", pa.int32()), ("importance", pa.float64()), ("low", pa.bool_())]
)


def _importances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Composite importance of nodes that come children first; a task holds one path.

    An open level gathers, over the children done so far, the sum of importance times
    pages, the sum of pages, and the most important node below.
    """

    def rows():
        levels: list[tuple[bytes, list[float]]] = []
        site = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["site"] != site:
                    levels, site = [], row["site"]
                path, below = row["path"], [0.0, 0.0, 0.0]
                if levels and levels[-1][0][:-8] == path:
                    # All children are at hand, gathered under the first of them.
                    below = levels.pop()[1]
                parts, pages, most = below
                # A leaf is as important as its content.
                weight = DAMPING ** row["styles"] if pages else 1.0
                if row["text_pages"]:
                    parts += row["text_pages"] * row["content"]
                    pages += row["text_pages"]
                inner = parts / pages if pages else row["content"]
                own = (1 - weight) * row["make_up"] + weight * inner
                own = 0.0 if row["part"] == NOISE else max(own, LEAST_IMPORTANCE if row["part"] >= NAMED else 0.0)
                most = max(most, own)
                yield row["site"], row["node"], row["part"], own, most < LEAST_IMPORTANCE
                gathered = [own * row["pages"], float(row["pages"]), most]
                if levels and levels[-1][0][:-8] == path[:-8]:
                    levels[-1] = (path, [a + b for a, b in zip(levels[-1][1][:2], gathered)] + [max(levels[-1][1][2], most)])
                else:
                    levels.append((path, gathered))

    return in_batches(rows(), _TREE)


def style_tree(nodes: DataFrame) -> DataFrame:
    """(site, node, part, importance, low) of every node of every site, from the rows of its pages.

    A feature's entropy over the elements that have it is 1 if it is spread evenly over all
    pages with the node, 0 if it is on one. Content importance is 1 minus the mean entropy
    of texts, links and images; few pages are little evidence, so that entropy counts
    (pages - 1) / pages. The make-up's importance is the entropy of the styles. Nodes on one
    page are important. What a node holds counts by the pages it is on.
    """
    own = nodes.filter("path IS NOT NULL").groupBy("site", "node").agg(
        F.first("path").alias("path"), F.max("part").alias("part"), F.count(F.lit(1)).alias("pages")
    )
    copies = F.col("copies").cast("double")
    spread = (
        nodes.filter("path IS NULL")
        .groupBy("site", "node", "is_text", "feature")
        .agg(
            F.sum(copies).alias("all"), F.sum(copies * F.log(copies)).alias("logs"), F.count(F.lit(1)).alias("on")
        )
    )
    entropy = F.log("all") - F.col("logs") / F.col("all")
    text, style = F.col("is_text"), ~F.col("is_text")
    made = spread.groupBy("site", "node").agg(
        F.avg(F.when(text, entropy)).alias("text_entropy"),
        F.max(F.when(text, F.col("on"))).alias("text_on"),
        F.count_if(style).alias("styles"),
        F.sum(F.when(style, F.col("all"))).alias("elements"),
        F.sum(F.when(style, F.col("all") * F.log("all"))).alias("style_logs"),
    )
    pages = F.col("pages").cast("double")
    single = F.col("pages") == 1
    evenness = F.least(F.lit(1.0), F.col("text_entropy") / F.log(pages)) * (pages - 1) / pages
    style_entropy = F.when(
        F.col("elements") > 1, (F.log("elements") - F.col("style_logs") / F.col("elements")) / F.log("elements")
    ).otherwise(0.0)
    ready = own.join(made, ["site", "node"], "left").select(
        "site", "node", "path", "part", "pages",
        F.when(F.col("text_on").isNull(), 0).otherwise(F.col("pages")).cast("long").alias("text_pages"),
        F.when(single | F.col("text_entropy").isNull(), 1.0).otherwise(1.0 - evenness).alias("content"),
        F.when(single, 1.0).otherwise(F.coalesce(style_entropy, F.lit(0.0))).alias("make_up"),
        F.coalesce("styles", F.lit(0)).cast("long").alias("styles"),
    )
    ordered = ready.repartition("site").sortWithinPartitions("site", F.desc("path"))
    return map_arrow(ordered, _importances, "site string, node long, part int, importance double, low boolean")


def site_of(url: Column) -> Column:
    """The host, A-Z lower-cased; without one empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def extract_text(
    pages: DataFrame, html: str = "html", url: str = "url", key: str = "page_id", into: str = "text"
) -> DataFrame:
    """All columns of ``pages``, and ``into``: the main text of the whole page, and ``n_chars``
    (long): its code points. Eager: node counts go to the shared scratch folder.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
    comments are removed, and branches whose importance over the site's pages is low. If a
    page has an article, by tag or role (or else by a class), the text is what lies in it.
    Character references are decoded; white space (any Unicode kind) within a block becomes
    one space; blocks are joined by one space, in order. Line breaks part words, inline tags
    do not.

    Pages of one host are one site; those without a host are one together. A NULL page
    counts as empty; a page without text gives an empty one. Pages cut off anywhere give
    what is there. Repeated rows count as pages each, and come out alike. Very long pages
    take time in proportion; elements nested deeper than MOST_DEPTH count as part of the
    one there. Other columns pass through. An empty table gives an empty one.
    """
    body = F.coalesce(column(html).cast("string"), F.lit(""))
    site = site_of(column(url).cast("string"))
    hashes = {
        name: F.xxhash64(F.lit(seed), site, body) for name, seed in (("ha", 11), ("hb", 12))
    }
    given = pages.select(*[value.alias(name) for name, value in hashes.items()], site.alias("site"), body.alias("body"))
    nodes = written(map_arrow(given, _node_rows, _NODES_DDL), "page-nodes")
    # Noise is of no importance on any page, which needs no look at the tree.
    low = style_tree(nodes).filter(F.col("low") & (F.col("part") != NOISE)).select("site", "node")
    low = written(low, "low-nodes")
    of_page = (
        nodes.filter(F.col("path").isNotNull() & (F.col("part") != NOISE))
        .join(low, ["site", "node"])
        .groupBy("ha", "hb")
        .agg(F.collect_set("node").alias("low"))
    )
    # Written, so that its size is known: pages are shuffled only if many have such branches.
    of_page = written(of_page, "low-of-pages")
    joined = packed(pages, **hashes).join(of_page, ["ha", "hb"], "left")
    # The page itself is shuffled once, within its row.
    again = F.coalesce(F.col("row").getField(html).cast("string"), F.lit(""))
    out = _with_text(joined.select("row", again.alias("body"), "low"))
    return unpacked(out, pages, **{into: F.col("text"), "n_chars": F.char_length("text").cast("long")})


def _with_text(df: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(parse(body.as_py()), set(low.as_py() or ()))
                for body, low in zip(batch.column(1), batch.column(2))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    return map_arrow(df, run, df.select("row").schema.add("text", "string"))
