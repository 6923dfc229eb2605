"""Judge URLs by rules on host suffixes and path prefixes.

A URL is expanded into its host's suffixes, one per label, and each of these that some rule
names into the path prefixes of the lengths that rules on that host have. These expressions
meet rules by a short prefix of their digest in an equi-join; the full digest confirms, and
of the rules that fit the most specific one decides. Which hosts and lengths there are is a
table like the rules themselves: neither the plan nor the driver grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import column, packed, unpacked

# Hexadecimal digits of a digest that the join uses.
PREFIX = 8

# Rule tables up to this many rows are broadcast; larger ones are joined by a shuffle.
MOST_BROADCAST = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    found = F.locate("://", url)
    return F.when(found > 0, url.substr(found + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """What stands between ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for a NULL or a URL without ``://``."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """All columns of ``pages``, with ``host``, ``path``, ``rule`` and ``verdict`` as a
    struct ``judged``.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all
    subdomains, if the URL's path starts with the rule's. Of several the longest text (host
    and path together) decides, then the longest host, then block. Without a rule the
    verdict is ``default`` and the rule NULL.

    Each distinct URL is judged once, however often it occurs, and only URLs that some rule
    fits are joined back, by a plain join that adaptive execution splits on a hot URL. A
    NULL URL, or one without ``://``, has an empty host and path and fits no rule. Rules
    with a NULL are left out. Extra columns pass through, also ones named ``host`` or
    ``rule``; one named ``judged`` is replaced. Very long URLs take time in proportion to
    their length and the rules that could fit. Empty tables are fine. Of the rules only
    their number is brought to the driver.
    """
    rules = rules.select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict"
    ).filter("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL AND host != ''")
    known = rules.select(
        _digest(F.col("host"), F.col("path")).alias("digest"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.length("host").alias("host_length"),
            (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict").alias("verdict"),
        ).alias("found"),
    ).withColumn("prefix", F.substring("digest", 1, PREFIX))
    # The path lengths of each host's rules, and how many labels the longest host has.
    lengths = rules.select(F.col("host").alias("suffix"), F.length("path").alias("characters")).distinct()
    most_labels = rules.agg(F.coalesce(F.max(F.size(F.split("host", "\\."))), F.lit(0))).scalar()
    if rules.count() <= MOST_BROADCAST:
        known, lengths = F.broadcast(known), F.broadcast(lengths)

    address = column(url).cast("string")
    urls = pages.select(address.alias("url")).filter("url IS NOT NULL").distinct()
    split = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    counts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size(F.split("host", "\\.")), most_labels)))
    suffixes = split.select("url", "path", "host", F.explode(counts).alias("labels")).select(
        "url", "path", F.expr("substring_index(host, '.', -labels)").alias("suffix")
    )
    fitting = suffixes.join(lengths, "suffix").filter(F.col("characters") <= F.length("path"))
    digests = fitting.select(
        "url", _digest(F.col("suffix"), F.expr("substring(path, 1, characters)")).alias("own")
    )
    best = (
        digests.withColumn("prefix", F.substring("own", 1, PREFIX))
        .join(known, "prefix")
        .filter("own = digest")
        .groupBy("url")
        .agg(F.max("found").alias("found"))
    )
    judged = packed(pages, url=address).join(best, "url", "left")
    answer = F.struct(
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.lit(default)).alias("verdict"),
    )
    return unpacked(judged, pages, judged=answer)
