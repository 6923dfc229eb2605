"""The pipeline, and language ID, against plain Python that shares no code with them."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tripmill.llm import langid
from tripmill.llm import queries as L


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


# --- language ID


def plain_bins(text):
    """Hashed n-grams of one to three characters, by whole numbers."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    if not text.lower().split():
        return Counter()
    letters = " " + " ".join(words) + " "
    out = Counter()
    for order in (1, 2, 3):
        for i in range(len(letters) - order + 1):
            mixed = order
            for c in letters[i : i + order]:
                mixed = ((mixed ^ ord(c)) * 0x9E3779B97F4A7C15) % 2**64
                mixed ^= mixed >> 29
            out[(mixed >> 7) % langid.BINS] += 1
    return out


def plain_answer(model, text):
    """(language, score, ambiguous) by the least loss over the codewords, bit by bit."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0, False
    bins = plain_bins(text)
    total = sum(bins.values())
    said = [sum(n * float(model.weights[b, bit]) for b, n in bins.items()) / total for bit in range(model.codes.shape[1])]
    wins = []
    for number, name in enumerate(model.languages):
        loss = sum(
            float(model.trust[number, bit]) * np.exp(-min(30.0, max(-30.0, langid.SHARPNESS * float(model.codes[number, bit]) * x)))
            for bit, x in enumerate(said)
        )
        wins.append((1 / max(loss, 1e-12), name))
    shares = sorted(((w / sum(w for w, _ in wins), name) for w, name in wins), key=lambda p: (-p[0], p[1]))
    return shares[0][1], shares[0][0], shares[1][0] >= langid.AMBIGUOUS * shares[0][0]


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return langid.train_language_model(docs.filter(~langid.is_held_out()))


def test_answers_are_those_of_a_plain_decoder(spark, sf_dir, documents, model):
    rows = {r["doc_id"]: r for r in L.op4_language_id(spark, sf_dir).collect()}
    odd = [(-1, None), (-2, ""), (-3, "12 !?"), (-4, "É"), (-5, "İ ſ ß ǅ"), (-6, "the der que les"), (-7, "a" * 20_000)]
    extra = langid.identify_language(spark.createDataFrame(odd, "doc_id long, text string"), model)
    found = {r["doc_id"]: (r["__lang_pred"], r["__score"], r["__ambiguous"]) for r in extra.collect()}
    found |= {k: (r["lang_pred"], r["score"], r["ambiguous"]) for k, r in rows.items()}
    short = [(r["doc_id"], r["text"]) for r in documents if len(r["text"] or "") < 3000][::5]
    for key, text in [*odd, *short]:
        name, score, ambiguous = plain_answer(model, text)
        assert found[key][0] == name and found[key][2] == ambiguous, key
        assert abs(found[key][1] - score) < 1e-9, key


def test_counts_behind_the_weights_are_plain_ones(documents, model):
    """All rows of the small table are drawn: half of them, by their hash, give the counts."""
    count = Counter(r["lang"] for r in documents if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["lang"])
    assert max(count.values()) < langid.TRAINING_ROWS and model.languages == tuple(sorted(count))
    codes = langid.codewords(len(count))
    assert model.codes.tolist() == codes.tolist()
    for a, b in combinations(codes.tolist(), 2):
        assert sum(x != y for x, y in zip(a, b)) >= codes.shape[1] // 2
    assert np.allclose(model.trust.sum(axis=1), 1.0)


def test_counts_of_given_rows_against_plain_counting(spark):
    rows = [(i, t * (1 + i % 3), lang) for i, (t, lang) in enumerate([("the cat and the dog ", "en"), ("der hund und die katze ", "de")] * 40)]
    model = langid.train_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    halves = spark.createDataFrame(rows, "doc_id string, text string, lang string").select(
        "text", "lang", (F.pmod(F.xxhash64(F.lit(4), "doc_id", "text"), F.lit(1 << 30)) % 2 == 0).alias("first")
    )
    usual = {}
    for name in ("de", "en"):
        shares = [plain_bins(r["text"]) for r in halves.collect() if r["first"] and r["lang"] == name]
        usual[name] = np.zeros(langid.BINS)
        for bins in shares:
            for b, n in bins.items():
                usual[name][b] += n / sum(bins.values()) / len(shares)
    floor = 0.02 / langid.BINS
    for bit in range(model.codes.shape[1]):
        ones = [usual[n] for n, c in zip(model.languages, model.codes[:, bit]) if c > 0]
        zeros = [usual[n] for n, c in zip(model.languages, model.codes[:, bit]) if c < 0]
        if ones and zeros:
            expected = np.log(np.mean(ones, axis=0) + floor) - np.log(np.mean(zeros, axis=0) + floor)
            assert np.allclose(model.weights[:, bit], expected, atol=1e-4)


# --- the pipeline


def plain_lines(rows):
    """Documents without the lines of ten sources and more, but for a line's first place."""
    sources, first = defaultdict(set), {}
    for row in sorted(rows, key=lambda r: r["doc_id"]):
        for place, line in enumerate((row["text"] or "").split("\n")):
            line = line.strip(" \t\r\x0b\x0c")
            if line:
                sources[line].add(row["source"])
                first.setdefault(line, (row["doc_id"], place))
    out = {}
    for row in rows:
        stay, removed, solid = [], 0, 0
        for place, raw in enumerate((row["text"] or "").split("\n")):
            line = raw.strip(" \t\r\x0b\x0c")
            solid += bool(line)
            if line and len(sources[line] - {None}) >= 10 and first[line] != (row["doc_id"], place):
                removed += 1
            else:
                stay.append(raw)
        if not (removed and removed == solid):
            out[row["doc_id"]] = "\n".join(stay)
    return out


def plain_groups(texts):
    """The smallest id of each group of near copies."""
    sets, holders = {}, defaultdict(set)
    for key, text in texts.items():
        words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        sets[key] = {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({" ".join(words)} if words else set())
        for shingle in sets[key]:
            holders[shingle].add(key)
    stay, seen = set(), set()
    for start in sorted(sets):
        if start in seen:
            continue
        stay.add(start)
        waiting = [start]
        while waiting:
            key = waiting.pop()
            if key in seen:
                continue
            seen.add(key)
            shared = Counter(other for shingle in sets[key] for other in holders[shingle])
            waiting += [o for o, n in shared.items() if 100 * n >= 75 * (len(sets[key]) + len(sets[o]) - n)]
    return stay


def plain_leaks(texts, items):
    """Documents that hold 13 words in a row of an item, at most two of them replaced."""
    split = {k: [w for w in re.split(r"[^\w]+|_", t.lower()) if w] for k, t in texts.items()}
    places = defaultdict(list)
    for number, item in enumerate(items):
        for j in range(len(item) - 2):
            places[tuple(item[j : j + 3])].append((number, j))
    out = set()
    for key, words in split.items():
        shifts = {(n, i - j) for i in range(len(words) - 2) for n, j in places.get(tuple(words[i : i + 3]), ())}
        for number, shift in shifts:
            item = items[number]
            same = [0 <= p + shift < len(words) and words[p + shift] == w for p, w in enumerate(item)]
            if any(sum(same[p : p + 13]) >= 11 for p in range(len(item) - 12)):
                out.add(key)
    return out


def test_pipeline_against_plain_steps(spark, sf_dir, documents, model):
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == ["doc_id", "lang", "n_tokens", "ids", "decoded"]
    got = {r["doc_id"]: r for r in result.collect()}
    said = {r["doc_id"]: r for r in L.op4_language_id(spark, sf_dir).collect()}
    rows = [r for r in documents if r["text"] and any(map(str.isalpha, r["text"]))]
    rows = [r for r in rows if not said[r["doc_id"]]["ambiguous"] or said[r["doc_id"]]["lang_pred"] == r["lang"]]
    texts = plain_lines(rows)
    texts = {k: texts[k] for k in plain_groups(texts)}
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    items = [[w for w in re.split(r"[^\w]+|_", r["text"].lower()) if w] for r in bench]
    leaking = plain_leaks(texts, items)
    assert leaking and set(got) == set(texts) - leaking
    library = Tokenizer.from_file(L.WORD_VOCABULARY)
    for key, row in got.items():
        assert row["lang"] == said[key]["lang_pred"]
        assert row["ids"] == library.encode(texts[key], add_special_tokens=False).ids and row["n_tokens"] == len(row["ids"])
        assert row["decoded"] == library.decode(row["ids"], skip_special_tokens=False)


def test_languages_are_kept_by_prediction(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("lang")))
    kept = corpus_pipeline.language_id(spark, wrong, sf_dir, languages=("de", "fr"))
    assert kept.columns == docs.columns
    known = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = kept.collect()
    assert {r["lang"] for r in rows} == {"de", "fr"}
    assert sum(r["lang"] == known[r["doc_id"]] for r in rows) > 0.98 * len(rows)
    assert len(rows) > 0.95 * sum(lang in ("de", "fr") for lang in known.values())


def test_ambiguous_texts_need_a_label(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    mixed = "Was orer.\nThis work is licensed under the GNU General Public License, version 3."
    more = [(-1, mixed, None), (-2, "x", None), (-3, "12", "en")]
    rows = spark.createDataFrame([(k, t, lang, "s", len(t)) for k, t, lang in more], docs.schema)
    both = docs.unionByName(rows)
    model = langid.train_language_model(both.filter(~langid.is_held_out()))
    ambiguous = {r["doc_id"] for r in langid.identify_language(both, model).filter("__ambiguous").collect()}
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, both, sf_dir).collect()}
    assert -3 not in kept
    assert all(key not in kept for key in ambiguous if key < 0)
    assert all(kept[key] is not None for key in kept)


def test_scratch_tables_are_removed(spark, sf_dir):
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "tripmill"
    before = {p.name for p in root.iterdir()} if root.exists() else set()
    result = corpus_pipeline.run(spark, sf_dir)
    left = {p.name for p in root.iterdir()} - before
    assert len(left) == 1 and left.pop().startswith("pipeline-decontamination")
    assert result.count() > 0
