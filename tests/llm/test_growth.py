"""Filters on results, very many lines, keys of any type: time and plans that do not grow."""

import re
import time

import pytest
from pyspark.sql import functions as F

from tripmill.llm import line_dedup, near_dup, spot_signatures, url_filter


def run(df):
    begun = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


@pytest.mark.parametrize("condition", ["size(spots) > 3", "fingerprint <> ''", "doc_id > 1"])
def test_a_filter_on_fingerprints_splits_texts_once(condition, spark, sf_dir, plan):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(spot_signatures.fingerprints(docs).filter(condition))
    physical = text[text.index("\n\n(1)") :]
    assert sum("split(" in line for line in physical.splitlines()) == 1
    assert physical.count("split(") == 1


@pytest.mark.parametrize("condition", ["near_edited > 0.5", "near_next > 0.5", "edited_fingerprint <> ''", "n_chars > 9"])
def test_a_filter_on_edits_splits_texts_no_more_often(condition, spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 20")
    edited = spot_signatures.edited_fingerprints(docs)
    plans = [
        df._jdf.queryExecution().optimizedPlan().toString().count("split(")
        for df in (edited, edited.filter(condition))
    ]
    assert plans[0] == plans[1]


def test_time_of_filtered_fingerprints_grows_with_the_words(spark):
    def seconds(words):
        text = " ".join("the word" + str(i % 997) for i in range(words))
        one = spark.createDataFrame([(1, text)], "doc_id long, text string")
        return min(run(spot_signatures.fingerprints(one).filter("size(spots) > 0")) for _ in range(2))

    seconds(1000)
    assert seconds(40_000) < 10 * max(0.2, seconds(10_000))


def test_time_of_line_removal_grows_with_the_lines(spark):
    def seconds(lines):
        long = "\n".join(["shared", *[f"own line {i}" for i in range(lines)], "shared"])
        rows = [(i, "shared", f"s{i}") for i in range(20)] + [(99, long, "s1")]
        cleaned = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"))
        took = min(run(cleaned) for _ in range(2))
        text = cleaned.filter("doc_id = 99").first()["text"]
        assert text == "\n".join(f"own line {i}" for i in range(lines))
        return took

    seconds(1000)
    assert seconds(32_000) < 2.5 * max(0.4, seconds(16_000))


def test_texts_are_shuffled_once_to_lose_their_lines(spark, plan):
    rows = [(i, f"shared\nown {i}", f"s{i}", "en") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        text = plan(line_dedup.dedup_lines(docs))
    finally:
        spark.conf.set(threshold, before)
    dealt = re.findall(r"\(\d+\) Exchange *\nInput \[\d+\]: \[(.*)\]", text)
    names = [sorted(re.sub(r"#\d+L?", "", part).split(", ")) for part in dealt]
    assert sorted(names) == [["doc_a", "doc_b", "places"], ["doc_a", "doc_b", "row"]]


@pytest.mark.parametrize("kind, keys", [
    ("string", ["b", "a", "ß", None, "10", "9"]),
    ("long", [-(2**63), 2**63 - 1, 0, None, -1, 5]),
    ("date", None),
])
def test_order_of_edits_by_keys_of_any_type(kind, keys, spark):
    texts = [f"text number {i} with some more words" for i in range(6)]
    if kind == "date":
        df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select(
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("doc_id"), "text"
        )
        pairs = [(r["doc_id"], r["text"]) for r in df.collect()]
    else:
        pairs = list(zip(keys, texts))
        df = spark.createDataFrame(pairs, f"doc_id {kind}, text string").repartition(3)
    known = sorted([p for p in pairs if p[0] is not None], key=lambda p: p[0].encode() if kind == "string" else p[0], reverse=True)
    ordered = known + [p for p in pairs if p[0] is None]
    expected = {}
    for (key, text), (_, after) in zip(ordered, [*ordered[1:], ordered[0]]):
        third = len(text) // 3
        expected[key] = text[: len(text) - third] + after[:third]
    got = spot_signatures.edited_fingerprints(df)
    shas = spark.createDataFrame(list(expected.items()), got.select("doc_id").schema.add("edited", "string")).select(
        "doc_id", F.sha2(F.col("edited").cast("binary"), 256).alias("sha")
    )
    assert {(r[0], r[1]) for r in got.select("doc_id", "edited_sha256").collect()} == {(r[0], r[1]) for r in shas.collect()}


def test_given_sets_are_compared_only_in_neighbouring_partitions(spark):
    sizes = [0, 1, 2, 5, 9, 10, 11, 50, 99, 100, 101, 1000]
    sets = spark.createDataFrame([(n, list(range(n))) for n in sizes], "n int, s array<long>")
    both = sets.crossJoin(sets.select(F.col("n").alias("m"), F.col("s").alias("t"))).select(
        "n", "m", spot_signatures.pruned_likeness(F.col("s"), F.col("t")).alias("near")
    )
    for n, m, near in both.collect():
        expected = 1.0 if n == m else min(n, m) / max(n, m)
        assert near == (expected if expected >= spot_signatures.LEAST_COMPARED else 0.0), (n, m)


def many_rules(spark, count):
    """Rules of very many shapes: label counts and path lengths."""
    rows = []
    for i in range(count):
        host = ".".join(["x"] * (i % 20) + [f"h{i % 37}", "org"])
        rows.append((host, "/" + "p" * (i // 20), "block" if i % 2 else "allow"))
    return rows


def plain_verdict(url, rules):
    rest = url.split("://", 1)[1]
    host = rest.split("/", 1)[0]
    path = rest[len(host) :]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[3:] if fits else (None, "allow")


@pytest.mark.parametrize("most_broadcast", [100_000, 0])
def test_rules_of_a_thousand_shapes(spark, plan, monkeypatch, most_broadcast):
    monkeypatch.setattr(url_filter, "MOST_BROADCAST", most_broadcast)
    urls = [f"http://{'x.' * (i % 23)}h{i % 41}.org/{'p' * (i % 90)}" for i in range(300)]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    sizes = []
    for count in (10, 1500):
        rules = many_rules(spark, count)
        judged = url_filter.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
        got = {r["url"]: (r["judged"]["rule"], r["judged"]["verdict"]) for r in judged.collect()}
        assert got == {u: plain_verdict(u, rules) for u in urls}
        text = judged._jdf.queryExecution().optimizedPlan().toString()
        sizes.append(len("".join(line for line in text.splitlines() if "LocalRelation" not in line)))
    assert abs(sizes[0] - sizes[1]) < 200


def test_urls_of_very_many_labels(spark):
    long = "http://" + "a." * 50_000 + "org/x"
    rules = spark.createDataFrame([("a.a.org", "/x", "block"), ("org", "/", "allow")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(long,), ("http://org",), (None,)], "url string")
    got = {r["judged"]["rule"] for r in url_filter.judge_urls(pages, rules).collect()}
    assert got == {"a.a.org/x", None}


@pytest.mark.parametrize("most_broadcast, pairs_a_part", [(2_000_000, 1_000), (0, 3)])
def test_a_centre_of_many_copies(spark, monkeypatch, most_broadcast, pairs_a_part):
    """A third of all rows are near copies of one text, whose comparisons are dealt to many
    streams; the texts wanted are joined by a shuffle beyond the bound."""
    monkeypatch.setattr(near_dup, "MOST_BROADCAST", most_broadcast)
    monkeypatch.setattr(near_dup, "PAIRS_A_PART", pairs_a_part)
    common = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*common, f"own{i}", "end"])) for i in range(0, 90, 3)]
    rows += [(i, " ".join(f"x{i}y{j}" for j in range(30))) for i in range(90) if i % 3]
    rows += [(200 + i, " ".join(common[: 20 + i])) for i in range(3)] + [(300, None), (301, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(df).collect()}
    sets = {k: near_dup.shingle_set(near_dup.words_of(t or "")) for k, t in rows}
    group = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                shared = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                    group[a] = group[b] = min(group[a], group[b])
        if all(group[group[k]] == group[k] for k in group):
            break
    assert got == group and sum(v == 0 for v in got.values()) == 30
