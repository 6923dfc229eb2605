"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripmill.llm import (
    bpe,
    decontaminate,
    langid,
    line_dedup,
    near_dup,
    secret_scan,
    sharding,
    spot_signatures,
    token_counts,
    url_filter,
)
from tripmill.llm import queries as L

PROSE = "the quick brown fox jumps over the lazy dog and then it sleeps under an old oak tree"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, node long, "
    "`odd name` string, __text string, spans string, words int"
)


@pytest.fixture(scope="module")
def odd(spark):
    """Rows of every awkward kind, with columns whose names the operators use themselves."""
    extra = ("k", 1, "o", "t", "s", 5)
    long = " ".join(f"word{i % 977} of{i}" for i in range(30_000))
    texts = [
        (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (2, PROSE, None, None), (None, PROSE, "en", "b"),
        (3, None, "en", "a"), (4, "", "en", "a"), (5, " \n\t ", None, "a"), (6, "12 34 !?", "en", "a"),
        (7, long, "en", "c"), (8, "x" * 100_000, "en", "c"), (None, None, None, None),
        (9, "der schnelle braune fuchs springt über den faulen hund und schläft", "de", "d"),
        (9, "ein anderer text mit derselben nummer, aber ganz anderen worten darin", "de", "d"),
        (10, "\U0001f600 \u0000 é <|endoftext|> 'RE İ ſ", "en", "a"),
    ]
    rows = [(i, t, l, s, 0 if t is None else len(t), *extra) for i, t, l, s in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


def operators(spark):
    rules = spark.createDataFrame(L.URL_RULES, "host string, path string, verdict string")
    bench = spark.createDataFrame([(1, PROSE), (None, None), (2, ""), (3, "too short")], "item_id long, text string")
    model = langid.LanguageModel((), *[langid.np.ones((0, 1))] * 3)
    return {
        "secrets": secret_scan.find_secrets,
        "lines": line_dedup.dedup_lines,
        "near": near_dup.near_duplicates,
        "one": near_dup.keep_one,
        "language": lambda df: langid.identify_language(df, model),
        "prints": spot_signatures.fingerprints,
        "edited": spot_signatures.edited_fingerprints,
        "bpe": lambda df: bpe.bpe_encode(df, L.WORD_VOCABULARY),
        "shards": lambda df: sharding.assign_shards(df, [1.0, 2.0], added=1.0),
        "urls": lambda df: url_filter.judge_urls(df, rules, url="text"),
        "counts": lambda df: token_counts.token_counts(df, L.BYTE_VOCABULARY, prefixes=True),
        "leaks": lambda df: decontaminate.find_leaks(df, bench),
        "clean": lambda df: decontaminate.decontaminate(df, bench),
    }


ONE_TO_ONE = {"secrets", "lines", "near", "language", "prints", "edited", "bpe", "shards", "urls", "counts"}


@pytest.mark.parametrize("name", [
    "secrets", "lines", "near", "one", "language", "prints", "edited", "bpe", "shards", "urls",
    "counts", "leaks", "clean",
])
def test_odd_rows_and_none(name, spark, odd, none):
    operator = operators(spark)[name]
    assert operator(none).collect() == []
    rows = operator(odd).collect()
    if name in ONE_TO_ONE:
        assert len(rows) == odd.count()
        ids = sorted(str(row["doc_id"]) for row in odd.collect())
        assert sorted(str(row["doc_id"]) for row in rows) == ids


def test_null_and_empty_texts_alike(spark, odd):
    for name in ("secrets", "prints", "bpe", "counts", "near"):
        rows = [r.asDict() for r in operators(spark)[name](odd).filter("doc_id IN (3, 4)").collect()]
        for row in rows:
            for key in ("doc_id", "component_id", "text_key"):
                row.pop(key, None)
        assert rows[0] == rows[1], name


def test_near_duplicates_of_odd_rows(odd):
    rows = near_dup.near_duplicates(odd).collect()
    by_id = {(r["doc_id"], r["n_shingles"]): r for r in rows}
    words = len(PROSE.split())
    for doc_id in (1, 2, None):
        assert by_id[doc_id, words - 4]["component_id"] == 1
        assert by_id[doc_id, words - 4]["kept"] == (doc_id == 1)
    for doc_id in (3, 4, 5):
        row = by_id[doc_id, 0]
        assert row["component_id"] == doc_id and row["kept"]
    assert by_id[None, 0]["component_id"] is None and by_id[None, 0]["kept"]
    assert by_id[6, 1]["kept"] and by_id[8, 1]["kept"]


def test_one_row_of_each_group_stays(odd):
    kept = near_dup.keep_one(odd)
    assert kept.columns == odd.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert [d for d, t in found if t == PROSE] == [1]
    assert sum(t is None for _, t in found) == 2 and len(found) == odd.count() - 3


def test_lines_stay_where_they_come_first(spark):
    rows = [(i, f"shared line {i // 40}\nown {i}\n\n shared \t", f"s{i % 12}") for i in range(80)]
    rows += [(100, "few\nsites", "s1"), (101, "few\nsites", "s2"), (102, "shared", None), (103, None, "s3")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[0]["text"] == rows[0][1] and got[0]["__removed"] == 0 and got[0]["__lines"] == 3
    assert got[40]["text"] == "shared line 1\nown 40\n" and got[40]["__removed"] == 1
    assert got[7]["text"] == "own 7\n" and got[7]["__removed"] == 2
    assert got[100]["text"] == "few\nsites" and got[101]["__removed"] == 0
    assert got[102]["text"] == "" and got[103]["text"] is None


@pytest.mark.parametrize("sites", [7, 8, 9, 10, 11, 12, 13, 300, 5000])
def test_spread_near_and_far_from_the_threshold(spark, sites):
    for least in (10, sites):
        df = spark.range(sites).select(
            F.col("id").alias("doc_id"), F.lit("one line").alias("text"), F.col("id").cast("string").alias("source")
        )
        found = line_dedup.boilerplate_lines(line_dedup.with_lines(df, "text", "source", "doc_id"), least)
        assert found.count() == (sites >= least)


def test_secrets_by_name():
    def named(text):
        return [(text[a:b], name) for kind, a, b, name, _ in secret_scan.secret_spans(text) if kind == "named"]

    assert named('x = "hunter2Zq9"\nclient_secret = x') == [("hunter2Zq9", "client_secret")]
    assert named('a = "zK3"\nb = "pQ9w"\nauthToken := a + b + "x"') == [
        ("zK3", "authToken"), ("pQ9w", "authToken"), ("x", "authToken"),
    ]
    assert named("export PRIVATE_KEY='MIIabc123/+x'") == [("MIIabc123/+x", "PRIVATE_KEY")]
    assert named('{"clientCredential": "Ab3$9fQz"}') == [("Ab3$9fQz", "clientCredential")]
    for harmless in (
        'title = "a1b2c3d4e5"', "key: value", 'password_file = "a1b2c3d4e5/x"', 'db_pwd = "${DB_PWD}"',
        'pwd = "changeme123"', "The password: see below", "a = b = c", 'x == "secret"', "token::Parse",
    ):
        assert named(harmless) == [], harmless
    # A literal within a base span is not listed again.
    assert [s[0] for s in secret_scan.secret_spans('api_key = "abcdEF123456"')] == ["assign"]
    # Names that stand for each other, and long chains, come to an end.
    chain = "a = b\nb = a\npassword = a\n" + "".join(f"v{i + 1} = v{i} + v{i}\n" for i in range(2000))
    assert secret_scan.secret_spans(chain + "my_passwd = v2000") is not None


@pytest.mark.parametrize("text, name", [
    ("INFO: db_pwd=hunter2Zq9", "db_pwd"),
    ("environment: CLIENT_PASSPHRASE=hunter2Zq9", "CLIENT_PASSPHRASE"),
    ("page = x/y?client_passphrase=hunter2Zq9", "client_passphrase"),
    ("a: b: 'db_pwd': 'hunter2Zq9'", "db_pwd"),
    ('pwd = passphrase = "hunter2Zq9"', "pwd"),
    ('db_pwd: str = "hunter2Zq9"', "db_pwd"),
    ('client_pwd: string="hunter2Zq9"', "client_pwd"),
    ('db_pwd: Optional[Dict[str, str]] = "hunter2Zq9"', "db_pwd"),
    ('db_pwd: str | None = "hunter2Zq9"', "db_pwd"),
    ("const DB_PWD: &'static str = \"hunter2Zq9\"", "DB_PWD"),
    ('val dbPwd: String? = "hunter2Zq9"', "dbPwd"),
    ('db_pwd: std::string = "hunter2Zq9"', "db_pwd"),
    ('db_pwd\t= "hunter2Zq9"', "db_pwd"),
    ('db_pwd:\t"hunter2" \t+\t"Zq9"', "db_pwd"),
    ('INFO: x = "hunter2Zq9"\nclient_secret = x', "client_secret"),
    # A literal that a separator follows is still one.
    ("db_pwd=hunter2Zq9= foo", "db_pwd"),
    ("private_key=hunter2Zq9=", "private_key"),
    ("db_pwd=hunter2Zq9:tail", "db_pwd"),
    # A type's name does not stand for the literal of another declaration.
    ('title: str = "Abc9defgh"\ndef f(db_pwd: str): pass', None),
    ('title: str | None = "Abc9defgh"\ndb_pwd = None', None),
    ("credential: https://example.net/Path9x", None),
])
def test_secrets_whose_value_could_be_a_name(text, name):
    named = [(text[a:b], n) for kind, a, b, n, _ in secret_scan.secret_spans(text) if kind == "named"]
    if name is None:
        assert named == []
    else:
        assert "".join(literal for literal, _ in named) == "hunter2Zq9" and {n for _, n in named} == {name}


@pytest.mark.parametrize("name", [
    "secretkey", "privatekey", "accesskey", "signingkey", "dbpwd", "SECRETKEY", "DBPWD", "awsSecretkey", "myprivatekey",
    "ldappassphrase", "secrets", "passwords", "tokens", "my_secrets", "privatekeys", "accesskeys", "app.passcodes",
    "clientsecrets", "DB_PWDS", "sshprivate_key", "secretvalue",
])
def test_secrets_under_compounds_and_plurals(name):
    for text in (f'{name} = "hunter2Zq9"', f'"{name}": "hunter2Zq9"', f"{name}: hunter2Zq9"):
        found = [(text[a:b], kind) for kind, a, b, *_ in secret_scan.secret_spans(text)]
        assert found == [("hunter2Zq9", "named")]


@pytest.mark.parametrize("name", [
    "monkey", "turkey", "concert", "obsession", "spinning", "secretary", "tokenizer", "publickey", "primarykeys", "hostkey",
    "passwordfile", "tokencount", "username", "keys", "access", "process", "userclient", "keyboards", "basalt",
])
def test_no_secrets_under_other_words(name):
    assert secret_scan.secret_spans(f'{name} = "hunter2Zq9"') == []


@pytest.mark.parametrize("length", [70, 79, 80, 81, 95, 1000, 200_000])
def test_secrets_under_long_names(length):
    name = ("part." * length)[: length - len("b_passphrase") - 1] + ".b_passphrase"
    assert len(name) == length
    for text in (f"{name} = 'hunter2Zq9'", f'"{name}": "hunter2Zq9"', f"{name} : str = 'hunter2Zq9'", f"INFO: {name}=hunter2Zq9"):
        named = [(text[a:b], n) for kind, a, b, n, _ in secret_scan.secret_spans(text) if kind == "named"]
        assert named == [("hunter2Zq9", name)]


def test_secrets_of_long_lines_in_linear_time():
    for line in (
        "a" * 400_000 + " = b", "a." * 200_000, "a-" * 200_000 + ":", ("a" * 99 + " ") * 4000 + "=", "aB" * 200_000 + "=x",
        "key" * 100_000 + "=hunter2Zq9", "s" * 400_000 + "=x",
        "a=" * 200_000, "a = " * 100_000, "a: " * 100_000, "pwd = " * 50_000 + "x", '"a=" + ' * 50_000, "a: x[" * 50_000,
        "a: [" * 50_000, "a:" + "<" * 100_000, "a: b | " * 50_000, "pwd1 = pwd2: " * 50_000, 'a="b=' * 50_000, "a=b+c" * 50_000,
    ):
        begun = time.process_time()
        secret_scan.secret_spans(line)
        assert time.process_time() - begun < 20, line[:20]


def test_weights_and_growth_of_shards(spark):
    df = spark.range(30_000).withColumnRenamed("id", "doc_id")
    placed = sharding.assign_shards(df, [1.0, 1.0, 2.0], added=4.0)
    rows = placed.collect()
    for shard, share in ((0, 0.25), (1, 0.25), (2, 0.5)):
        own = [r for r in rows if r["shard"] == shard]
        assert abs(len(own) / len(rows) - share) < 0.02
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        by_slot = sorted(own, key=lambda r: r["slot"])
        assert [r["doc_id"] for r in by_slot] == sorted(r["doc_id"] for r in own)
    assert all(r["grown_shard"] in (r["shard"], 3) for r in rows)
    assert abs(sum(r["grown_shard"] == 3 for r in rows) / len(rows) - 0.5) < 0.02
    grown = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(df, [1.0, 1.0, 2.0, 4.0]).collect()}
    assert grown == {r["doc_id"]: r["grown_shard"] for r in rows}
    with pytest.raises(ValueError):
        sharding.draws(F.lit(1), [1.0, 0.0])


def test_a_hot_key_is_numbered_by_many_tasks(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), (F.col("id") % 5).alias("size")
    )
    rows = sharding.assign_shards(df, [1.0] * 4, order=["size"]).collect()
    for shard in range(4):
        slots = [r["slot"] for r in rows if r["shard"] == shard]
        assert sorted(slots) == list(range(len(slots)))


@pytest.mark.parametrize("url, rule, verdict", [
    ("http://a.example.org/es/1", "example.org/es/", "block"),
    ("http://EXAMPLE.org/en/1?x", "example.org/en/1", "block"),
    ("http://example.org/en/2", "org/", "allow"),
    ("http://example.org", None, "none"),
    ("http://notexample.org/es/1", "org/", "allow"),
    ("http://x.com/de/#/fr/", "com/de/", "block"),
    ("http://x.com:80/de/", None, "none"),
    ("http://org/", "org/", "allow"),
    ("//example.org/es/", None, "none"),
    (None, None, "none"),
    ("http://?/es/", None, "none"),
    ("http://a..org/x", "org/", "allow"),
])
def test_url_rules(spark, url, rule, verdict):
    rules = spark.createDataFrame(L.URL_RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, url, "mine")], "page_id long, url string, host string")
    row = url_filter.judge_urls(pages, rules, default="none").first()
    assert (row["judged"]["rule"], row["judged"]["verdict"], row["host"]) == (rule, verdict, "mine")


def test_url_rules_without_rules_and_by_a_shuffle(spark, monkeypatch):
    pages = spark.createDataFrame([(1, "http://x.org/a")], "page_id long, url string")
    nothing = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filter.judge_urls(pages, nothing).first()["judged"]["verdict"] == "allow"
    monkeypatch.setattr(url_filter, "MOST_BROADCAST", 0)
    ties = spark.createDataFrame(
        [("x.org", "/", "allow"), ("x.org", "/", "block"), ("org", "/a", "allow")],
        "host string, path string, verdict string",
    )
    assert url_filter.judge_urls(pages, ties).first()["judged"]["verdict"] == "block"


def test_leaks_tolerate_replaced_words(spark, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    item = " ".join(words)

    def with_replaced(*places):
        return " ".join("other" if i in places else w for i, w in enumerate(words))

    cases = {
        1: (f"before {item} after", True),
        2: (with_replaced(5, 10, 15, 20, 25, 30, 35), True),
        3: (with_replaced(3, 7, 11, 15, 19, 23, 27, 31, 35, 39), False),
        4: (" ".join(words[:10]), False),
        5: (" ".join(words[:13]).upper().replace(" ", ", "), True),
        6: (" ".join(words[20:33]), True),
        7: (" ".join(reversed(words)), False),
    }
    docs = spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(0, item), (1, "a whole short item of nine words it is")], "item_id long, text string")
    expected = {k for k, (_, leaks) in cases.items() if leaks}
    for at_once in (decontaminate.SEEDS_AT_ONCE, 5):  # and a benchmark taken in blocks
        monkeypatch.setattr(decontaminate, "SEEDS_AT_ONCE", at_once)
        found = decontaminate.find_leaks(docs, bench).collect()
        assert {r["doc_id"] for r in found} == expected
        assert {r["at"] for r in found if r["doc_id"] == 1} == {1}
    more = spark.createDataFrame(
        [(8, "so: a whole short item of nine words it is!"), (9, "a whole short item of other other it is")],
        "doc_id long, text string",
    )
    assert {(r["doc_id"], r["item_id"], r["same"]) for r in decontaminate.find_leaks(more, bench).collect()} == {(8, 1, 9)}


def test_leaks_of_short_items(spark):
    items = {n: [f"s{n}x{i}" for i in range(n)] for n in range(6, 14)}
    bench = spark.createDataFrame([(n, " ".join(words)) for n, words in items.items()], "item_id long, text string")
    docs, expected = [], set()
    for n, words in items.items():
        cases = [()] + [(a,) for a in range(n)] + [(a, b) for a in range(n) for b in range(a)]
        for gone in cases:
            text = " ".join("other" if i in gone else word for i, word in enumerate(words))
            for body in (f"some words before {text} and after", text):
                docs.append((len(docs), body))
                if n >= 8 and len(gone) <= (1 if n < 13 else 2):
                    expected.add((len(docs) - 1, n, n - len(gone), 3 if body != text else 0))
        for cut in (words[1:], words[:-1]):  # a word lost at the document's start or end
            docs.append((len(docs), " ".join(cut)))
            if n >= 8:
                expected.add((len(docs) - 1, n, n - 1, 0))
    with pytest.warns(UserWarning, match="2 benchmark items of fewer than 8 words"):
        leaks = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert {(r["doc_id"], r["item_id"], r["same"], r["at"]) for r in leaks.collect()} == expected
    short = decontaminate.short_items(bench).collect()
    assert {(r["item_id"], r["n_words"]) for r in short} == {(6, 6), (7, 7)}


def test_alike_spot_sets_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    prints = spot_signatures.fingerprints(docs)
    for least in (0.5, 0.75):
        pairs, classes = spot_signatures.similar_pairs(prints, least)
        sets = {r["class_id"]: set(r["spots"]) for r in classes.collect()}
        found = {(r["a"], r["b"]): r["likeness"] for r in pairs.collect()}
        by_spot = {}
        for number, spots in sets.items():
            for spot in spots:
                by_spot.setdefault(spot, set()).add(number)
        expected = {}
        for number, spots in sets.items():
            for other in set().union(*(by_spot[s] for s in spots)):
                if number < other:
                    shared = len(spots & sets[other])
                    likeness = shared / (len(spots) + len(sets[other]) - shared)
                    if likeness >= least:
                        expected[number, other] = likeness
        assert found == expected and found


def test_stages_on_odd_and_no_rows(spark, odd, none, sf_dir):
    for rows in (odd, none):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "test")
            assert docs.columns == odd.columns
        tokens = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert tokens.columns == ["doc_id", "lang", "n_tokens", "ids", "decoded"]
        assert (tokens.count() == 0) == (rows is none)


def test_shards_and_edits_of_repeated_rows(spark):
    rows = [(5, "one two"), (5, "one two"), (4, "abc"), (None, "zz"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spot_signatures.edited_fingerprints(df).collect()
    edits = sorted((str(r["doc_id"]), r["edited_sha256"]) for r in got)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert edits == sorted(
        [("5", sha("one tab")), ("5", sha("one tab")), ("4", sha("ab")), ("3", sha("")), ("None", sha("zz"))]
    )
