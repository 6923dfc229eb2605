"""The registered text queries: against their SQL, and against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.compare import connect, differences
from tripmill.llm import queries as L
from tripmill.llm.oracle import ORACLE


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    return {row["doc_id"]: row["text"] or "" for row in rows}


def test_all_are_registered():
    names = set(entry.queries())
    assert set(L.QUERIES) <= names and "pipeline" in names
    assert {name.split("_")[0] for name in L.QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", ORACLE)
def test_against_sql(name, spark, sf_dir, duck):
    assert differences(L.QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


@pytest.mark.parametrize("name", ["op5_fingerprints", "op10_decontamination"])
def test_native_ones_run_no_python(name, spark, sf_dir, plan):
    text = plan(L.QUERIES[name](spark, sf_dir))
    assert not re.search("Python|Pandas|Arrow", text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def naive_spans(text):
    """The base patterns as they are stated."""
    found = []
    assign = (
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
        r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    for order, (kind, pattern, keep) in enumerate(
        [
            ("assign", assign, lambda m: len(m[2]) >= 6),
            ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
            ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
        ]
    ):
        found += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text) if keep(m)]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def test_secret_scan(spark, sf_dir, texts):
    rows = {row["doc_id"]: row for row in L.op1_secret_scan(spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        base, row = naive_spans(text), rows[doc_id]
        joined = ",".join(f"{kind}:{a}:{b}" for kind, a, b in base)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        for kind in ("assign", "access", "hex"):
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        spans = row["spans"].split(",") if row["spans"] else []
        assert [s for s in spans if not s.startswith("named")] == joined.split(",") * bool(base)


def test_language_accuracy_on_held_out_rows(spark, sf_dir):
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = L.op4_language_id(spark, sf_dir).collect()
    assert len(rows) == len(known)
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
        assert 0.0 <= row["score"] <= 1.0
        assert row["lang_pred"] in {"und", *known.values()}
    judged = [r for r in rows if r["held_out"] and known[r["doc_id"]]]
    right = sum(r["lang_pred"] == known[r["doc_id"]] for r in judged)
    assert right / len(judged) > 0.98


def test_bpe_is_the_librarys(spark, sf_dir, texts):
    library = Tokenizer.from_file(L.WORD_VOCABULARY)
    for row in L.op6_bpe(spark, sf_dir).collect():
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_token_counts_are_the_librarys(spark, sf_dir, texts):
    library = Tokenizer.from_file(L.BYTE_VOCABULARY)
    for row in L.op9_token_counts(spark, sf_dir).collect():
        text = texts[row["doc_id"]]
        count = len(library.encode(text, add_special_tokens=False).ids)
        assert (row["n_bytes"], row["n_tokens"]) == (len(text.encode()), count)
        assert row["over_limit"] == (count > 512)
        fits = row["fits_512"]
        assert len(library.encode(text[:fits], add_special_tokens=False).ids) <= 512
        assert fits == len(text) if count <= 512 else fits < len(text)


def test_token_counts_of_every_prefix_are_the_librarys(spark, sf_dir, texts):
    library = Tokenizer.from_file(L.BYTE_VOCABULARY)
    odd = ["", " ", "a", "don't 've  \n\n x", "<|endoftext|>a<|endo", "é́‍😀😀 ſ", "x" * 300, "   1234567 \t\r\n", "'S 's ''ll", "日本語のテキスト"]
    short = sorted(texts.values(), key=len)[::40]
    cases = odd + [text[:400] for text in short]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    rows = L.token_counts.token_counts(df, L.BYTE_VOCABULARY, prefixes=True).collect()
    assert len(rows) == len(cases)
    for row in rows:
        text = cases[row["doc_id"]]
        expected = [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(len(text) + 1)]
        assert row["prefix_tokens"] == expected, text[:50]
