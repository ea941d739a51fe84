"""Token files: ids against the library, places, encodings and selective reads."""

import gc
import glob
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
from streamkit.llm import token_files as T

SF = "/root/testdata/sf0.001"
ODD_TEXTS = [" lead", "\nnl  two\n\n  x ", "a\rb\r\n c", "日本語 🙂 <|endoftext|> <|startoftext|>x", "İSTANBUL ΟΔΟΣ ΣΑΣ. Σ", "  ́x é É ſt", "\x85 a \x1c b", " ", "\n",
             "a\tb\x0bc d​e﻿f᠎g", "it's 'S don't 12 1٣ ½", None, "", "x " * 100_000 + "y" * 50_000]


def expected(docs, vocabulary="word_bpe_49k.json"):
    library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    out, at = {}, 0
    for d in sorted(docs):
        ids = library.encode(docs[d] or "", add_special_tokens=False).ids + [2]
        out[d] = (at, ids)
        at += len(ids)
    return out


def test_query_against_the_library(spark):
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in E.queries()["op12_token_files"](spark, SF).collect()}
    assert got == {d: (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, (at, ids) in expected(docs).items()}


@pytest.mark.parametrize("vocabulary", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_odd_texts_in_many_files(spark, vocabulary):
    docs = {7 * i - 20: t for i, t in enumerate(ODD_TEXTS + [f"text {i} of many" * (i % 9) for i in range(300)])}
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs.items()], "doc_id long, text string, part int, `ids.x` string").repartition(5)
    path = T.write_tokens(df, vocabulary=vocabulary, file_bytes=3000, page_rows=5)
    want = expected(docs, vocabulary)
    rows = T.read_documents(spark, path).collect()
    assert {r.doc_id: (r.start, list(r.ids)) for r in rows} == want and len(rows) == len(docs)
    total = sum(len(ids) for _, ids in want.values())
    flat = np.concatenate([ids for _, ids in want.values()])
    for first, last in ((0, 1), (17, 900), (total - 5, total + 9), (300, 300), (0, total)):
        got = sorted((r.start, list(r.ids)) for r in T.read_span(spark, path, first, last).collect())
        assert [x for _, ids in got for x in ids] == flat[first:last].tolist()
        assert all(flat[at:at + len(ids)].tolist() == ids for at, ids in got)


def test_encodings_row_groups_and_page_indexes(spark):
    df = spark.range(30_000).selectExpr("id AS doc_id", "concat('some words ', id % 97, ' and more of them ', id % 13) AS text").repartition(3)
    path = T.write_tokens(df, row_group=100_000, page=8_000, page_rows=500)
    files = glob.glob(path.replace("file:", "") + "/files/*.parquet")
    meta = pq.ParquetFile(files[0]).metadata
    assert len(files) == 1 and meta.num_row_groups > 1
    for g in range(meta.num_row_groups):
        for i in range(meta.num_columns):
            column = meta.row_group(g).column(i)
            assert column.has_column_index and column.has_offset_index
            assert ("RLE_DICTIONARY" if column.path_in_schema.startswith("ids") else "DELTA_BINARY_PACKED") in column.encodings
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan(T.read_tokens(spark, path).select("doc_id", "n_tokens")).partition("ReadSchema")[2]
    assert "ids" not in plan(T.read_documents(spark, path, "doc_id", "start")).partition("ReadSchema")[2].partition("\n")[0]
    assert "GreaterThan(doc_id,5)" in plan(T.read_tokens(spark, path).where("doc_id > 5"))
    manifest = spark.read.parquet(f"{path}/manifest").collect()
    assert [(m.documents, m.base, m.first_id, m.last_id) for m in manifest] == [(30_000, 0, 0, 29_999)]


def test_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "b"), (None, None), (1, "b"), (1, "a"), (1, "a")]
    path = T.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), file_bytes=1)
    got = sorted(T.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, 1, 1, 1] and [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    empty = T.write_tokens(spark.createDataFrame([], "doc_id long, text string"))
    assert T.read_documents(spark, empty).count() == 0 and T.read_span(spark, empty, 0, 9).count() == 0


def test_new_words_are_cut_many_at_a_time(spark, monkeypatch):
    words = T.encoder("word_bpe_49k.json")
    plain = [f"{a}{b}{c}" for a in ("Word", "straße", "ÉTÉ", "ǅungla", "x") for b in ("", "q", "Zz") for c in ("", ".", "!?", "_)")]
    odd = ["don't", "a1b", "½cup", "x²", "¾", "10³m", "İz", "ΟΔΟΣ", "日本", "'S", "\x01a", "a\x01", "é7", "e\u0301t"]
    asked, cut = [], words._parts
    monkeypatch.setattr(words, "_parts", lambda word: asked.append(word) or cut(word))
    got = words._new(plain + odd)
    assert got == dict(zip(plain + odd, words.whole(plain + odd)))
    assert sorted(asked) == sorted(odd)


def test_no_garbage_collection_among_the_words(monkeypatch):
    words = T.encoder("word_bpe_49k.json")
    within, split = [], words._ids
    monkeypatch.setattr(words, "_ids", lambda texts: within.append(gc.isenabled()) or split(texts))
    assert words.ids(["some words", ""])[1] == b"" and within == [False] and gc.isenabled()
