"""Lines that many sites share, found by the spread of distinct sites.

A line is judged by the number of different sites it stands on, not by how often it
occurs. One HyperLogLog sketch of sites per line hash is merged by aggregation, which
bounds the memory per line however many documents hold it. Only lines whose estimate lies
too near the threshold to be sure of are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import column, packed, unpacked, with_fixed, written

# A line on this many sites is boilerplate.
LEAST_SITES = 10

# Log of the sketch's registers, and how far from the threshold an estimate has to be, in
# standard errors (and in sites) for no exact count to be needed.
LOG_REGISTERS = 12
SURE_ERRORS = 5
SURE_SITES = 2

BLANKS = " \t\r\x0b\x0c"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def with_lines(docs: DataFrame, text: str, site: str, key: str) -> DataFrame:
    """One row per line that is not blank: place in its document, and two hashes each of
    the line and of the document."""
    body = column(text).cast("string")
    lines = docs.select(
        column(key).alias("id"), column(site).cast("string").alias("site"),
        *document_hashes(column(key), body),
        F.posexplode(lines_of(body)).alias("place", "line"),
    )
    line = F.trim(F.col("line"), F.lit(BLANKS))
    return lines.withColumn("line", line).filter("line != ''").select(
        "id", "site", "doc_a", "doc_b", "place",
        F.xxhash64("line").alias("line_a"), F.xxhash64(F.lit(1), "line").alias("line_b"),
    )


def document_hashes(key: Column, body: Column) -> list[Column]:
    return [
        F.xxhash64(F.lit(2), key, body).alias("doc_a"),
        F.xxhash64(F.lit(3), key, body).alias("doc_b"),
    ]


def boilerplate_lines(lines: DataFrame, least_sites: int = LEAST_SITES) -> DataFrame:
    """(line_a, line_b) of the lines on at least ``least_sites`` distinct sites."""
    error = 1.04 / 2 ** (LOG_REGISTERS / 2)
    slack = max(SURE_SITES, SURE_ERRORS * error * least_sites)
    spread = (
        lines.groupBy("line_a", "line_b")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("sites"))
        .filter(F.col("sites") >= least_sites - slack)
    )
    spread = written(spread, "line-spread")
    sure = spread.filter(F.col("sites") > least_sites + slack).select("line_a", "line_b")
    near = spread.filter(F.col("sites") <= least_sites + slack).select("line_a", "line_b")
    exact = (
        lines.join(near, ["line_a", "line_b"], "left_semi")
        .filter(F.col("site").isNotNull())
        .select("line_a", "line_b", "site")
        .distinct()
        .groupBy("line_a", "line_b")
        .count()
        .filter(F.col("count") >= least_sites)
        .select("line_a", "line_b")
    )
    return written(sure.unionByName(exact), "boilerplate")


def dedup_lines(
    docs: DataFrame, least_sites: int = LEAST_SITES, text: str = "text", site: str = "source",
    key: str = "doc_id",
) -> DataFrame:
    """Remove boilerplate lines. Eager: writes to the shared scratch folder.

    A line, without blanks at its ends, is boilerplate if it stands on at least
    ``least_sites`` distinct sites. It stays where it comes first, at the smallest key
    (NULL first), then text hash, then place, so that no line is lost altogether; everywhere
    else it goes. Returns all columns of ``docs``, ``text`` without those lines, and
    ``__lines`` and ``__removed`` (long): lines that are not blank, and those removed.

    Blank lines are neither counted nor removed. A NULL site is no site. A NULL text stays
    NULL, an empty one empty, both with 0 lines. Rows repeated with the same key and text
    are treated alike, and keep the same line. A text that loses all its lines becomes
    empty; the row stays. Very long texts and texts of very many lines take time in
    proportion. Extra columns pass through. An empty table gives an empty one.
    """
    lines = with_lines(docs, text, site, key)
    common = boilerplate_lines(lines, least_sites)
    hits = written(
        lines.join(common, ["line_a", "line_b"]).select(
            "line_a", "line_b", "id", "doc_a", "doc_b", "place"
        ),
        "line-hits",
    )
    at = F.struct("id", "doc_a", "doc_b", "place")
    # Written, so that its size is known and the join need not deal out a hot line's rows.
    first = written(
        hits.groupBy("line_a", "line_b").agg(F.min(at).alias("first")), "line-owners"
    )
    removed = (
        hits.join(first, ["line_a", "line_b"])
        .filter(~at.eqNullSafe(F.col("first")))
        .groupBy("doc_a", "doc_b")
        .agg(F.collect_set("place").alias("places"))
    )
    removed = written(removed, "line-removals")
    body = column(text).cast("string")
    hash_a, hash_b = document_hashes(column(key), body)
    # The text goes through the join once, within its row.
    joined = packed(docs, doc_a=hash_a, doc_b=hash_b).join(removed, ["doc_a", "doc_b"], "left")
    body = F.col("row").getField(text).cast("string")
    joined = with_fixed(joined, every=lines_of(body))
    every, places = F.col("every"), F.col("places")
    stay = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), places)
    cleaned = F.array_join(F.transform(stay, lambda i: F.get(every, i)), "\n")
    solid = F.filter(every, lambda line: F.trim(line, F.lit(BLANKS)) != "")
    return unpacked(
        joined,
        docs,
        **{
            text: F.when(places.isNull(), body).otherwise(cleaned),
            "__lines": F.size(solid).cast("long"),
            "__removed": F.coalesce(F.size(places), F.lit(0)).cast("long"),
        },
    )
