"""Token alignment against a brute-force version over whole texts."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as E
from streamkit.llm import token_alignment as T
from streamkit.llm.tokens import byte_letters

SF = "/root/testdata/sf0.001"
ODD_TEXTS = [" lead", "\nnl  two\n\n  x ", "a\rb\r\n c);\r", "日本語 🙂 <|endoftext|> <s> <0x0A>", "has ▁ inside", "tail  \n", "　x　 y\xa0z",
             "\x85 a \x1c b", " ", "\n", "a\tb\x0bc", "\x00z", "é é", "word " * 30_000 + "x" * 20_000, None, ""]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def aligned(libraries, text):
    """(A ids, B ids, groups, links) of a text, or None if it has no tokens."""
    if not text:
        return None
    a_lib, b_lib = libraries
    letters = byte_letters()
    a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
    a_bytes = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
    groups, i, j = [], 0, 0
    for e in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
        i2, j2 = int(np.searchsorted(ends_a, e)) + 1, int(np.searchsorted(ends_b, e)) + 1
        groups.append((a[i:i2], b[j:j2], i, j))
        i, j = i2, j2
    links = [(x, y) for ga, gb, i, j in groups for p, x in enumerate(ga, i) for q, y in enumerate(gb, j)
             if ends_a[p] - len(a_bytes[p]) < ends_b[q] and ends_b[q] - len(b_bytes[q]) < ends_a[p]]
    return a, b, ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups), links, len(groups)


def expected(libraries, docs):
    found = {d: aligned(libraries, t) for d, t in docs.items()}
    count = Counter(x for f in found.values() if f for x in f[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    rows = {d: (0, 0, 0, 0, 0, 0, "") if f is None else
            (len(f[0]), len(f[1]), f[4], len(f[3]), sum(count[x] == most[x[1]] for x in f[3]), sum(count[x] for x in f[3]), hashlib.sha256(f[2].encode()).hexdigest())
            for d, f in found.items()}
    return rows, {k: (n, n == most[k[1]]) for k, n in count.items()}, found


def digest(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256


def test_query_against_brute_force(spark, libraries):
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows, _, _ = expected(libraries, docs)
    got = {r.doc_id: digest(r) for r in E.queries()["op11_token_alignment"](spark, SF).collect()}
    assert got == rows


@pytest.mark.parametrize("options", [{}, {"slice_records": 50, "fan": 2}])
def test_odd_texts_and_small_slices(spark, libraries, options):
    docs = dict(enumerate(ODD_TEXTS + ["the same text twice, with 12 numbers"] * 7))
    rows, pairs, found = expected(libraries, docs)
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs.items()], "doc_id long, text string, batch int, `run.n` int").repartition(4)
    out = T.align(df, **options)
    for r in out.documents.collect():
        assert digest(r) == rows[r.doc_id]
        assert r.groups == (found[r.doc_id][2] if found[r.doc_id] else "")
    assert {(p.a_id, p.b_id): (p["count"], p.best) for p in out.pairs.collect()} == pairs


def test_null_and_repeated_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None), (1 << 60, "a b"), (1 << 60, "a b")], "doc_id long, text string")
    got = T.align(df).documents.collect()
    assert sorted((r.doc_id or 0, r.n_a) for r in got) == [(0, 0), (0, 2), (1 << 60, 2), (1 << 60, 2)]
    none = T.align(df.limit(0))
    assert none.documents.count() == 0 and none.pairs.count() == 0


def test_runs_and_their_merge():
    rng = np.random.default_rng(3)
    runs, want = [], Counter()
    for n in (0, 1, 5, 30_000, 9_000):
        keys = np.sort(rng.integers(0, 5_000, n)) + (7 << 50)
        counts = rng.integers(1, 1 << 33, n)
        assert all((np.concatenate(c) == x).all() for c, x in zip(zip(*T.read_run(T.write_run(keys, counts))), (keys, counts)))
        runs.append(T.write_run(keys, counts))
        for k, c in zip(keys.tolist(), counts.tolist()):
            want[k] += c
    keys, counts = T.merge_counts(((b[0], b[1]) for b in T.read_run(r)) for r in runs)
    assert dict(zip(keys.tolist(), counts.tolist())) == want and (np.diff(keys) > 0).all()


def test_chunks_that_come_and_go(libraries, monkeypatch):
    monkeypatch.setattr(T, "KEEP", 40)
    monkeypatch.setattr(T, "PASSING", 10)
    tool = T.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    for i in range(300):
        tool.shrink()
        text = f"w{i} x{i % 7} common words here {i * i}\n" + ("▁" if i % 50 == 0 else "")
        want, got = aligned(libraries, text), tool.entries([text])[0]
        assert tool.text_groups(got) == (want[2] if want else "")
        if want:
            pair, doc, links = tool.records([[], got])
            assert Counter({(int(p) & (1 << 20) - 1, int(p) >> 20 & (1 << 20) - 1): int(n) for p, n in zip(pair, links)}) == Counter(want[3]) and (doc == 1).all()
