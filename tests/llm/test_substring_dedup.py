"""Removal of repeated passages against a plain search, and under hashes that collide."""

import hashlib
import random
import types

import numpy as np
import pytest

from streamkit.llm import hashing, substring_dedup

rng = random.Random(5)
PASSAGES = [[f"p{k}w{i}" for i in range(rng.randint(20, 60))] for k in range(6)]


def text_of(rng):
    words = []
    for _ in range(rng.randint(1, 4)):
        words += [f"u{rng.randrange(10 ** 9)}" for _ in range(rng.randint(0, 6))]
        p = list(rng.choice(PASSAGES))
        if rng.random() < 0.5:                      # a near copy: one word differs, or an end is cut off
            p[rng.randrange(len(p))] = f"e{rng.randrange(3)}"
        words += p[rng.randint(0, 5) if rng.random() < 0.3 else 0:]
    return " ".join(words)


DOCS = [(i, text_of(rng)) for i in range(60)] + [(60, None), (61, ""), (62, "a b " * 40), (63, "a b a a b b a a a b " * 8), (None, " ".join(PASSAGES[0]))]


def gone(docs, window):
    """Places of removed words, by document."""
    seen, out = set(), {}
    for doc, text in sorted((d for d in docs if d[0] is not None)):
        words = (text or "").split()
        out[doc] = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                out[doc].update(range(i, i + window))
            seen.add(w)
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


@pytest.mark.parametrize("window", [1, 2, 5, 20])
def test_against_a_plain_search(docs, window):
    want = gone([(d, t or "") for d, t in DOCS], window)
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(docs, window=window).collect()}
    assert len(got) == len(DOCS) and got[None].n_removed == 0
    for doc, text in DOCS[:-1]:
        words = (text or "").split()
        kept = " ".join(w for i, w in enumerate(words) if i not in want[doc])
        assert (got[doc].n_words, got[doc].n_removed, got[doc].kept_sha256) == (len(words), len(want[doc]), hashlib.sha256(kept.encode()).hexdigest())
        assert got[doc].kept_text == (kept if want[doc] else None)


def test_collisions_lose_no_word(docs, monkeypatch):
    """Hashes of a few values: spans are claimed of wrong sources, and the words decide."""
    real = substring_dedup.paths

    def weak_paths(words, window):
        m, s, first, count = real(words, window)
        return m % np.uint64(50), s % np.uint64(2), first, count

    def weak_rolling(words, k, seed):
        return hashing.rolling(words, k, seed) % np.uint64(40)

    monkeypatch.setattr(substring_dedup, "paths", weak_paths)
    monkeypatch.setattr(substring_dedup, "hashing", types.SimpleNamespace(
        rolling=weak_rolling, spans=hashing.spans, word_hashes=hashing.word_hashes, U=hashing.U))
    claimed = []
    corrected = substring_dedup._corrected
    monkeypatch.setattr(substring_dedup, "_corrected", lambda *a: claimed.append(a[4].count()) or corrected(*a))
    want = gone([(d, t or "") for d, t in DOCS], 5)
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(docs, window=5).collect()}
    assert claimed[0] > 0 and len(got) == len(DOCS)
    removed = 0
    for doc, text in DOCS[:-1]:
        words, kept = (text or "").split(), got[doc].kept_text
        must = [w for i, w in enumerate(words) if i not in want[doc]]
        left = iter((text or "") .split() if kept is None else kept.split())
        assert all(w in left for w in must)        # what is not repeated is still there, in order
        removed += got[doc].n_removed
    assert removed > 0


def test_long_spans_join_what_touches():
    s = substring_dedup.SHIFT
    marks = [np.array(x) for x in ([7, 7, 7, 9], [0 * s + 4, 4 * s + 3, 30 * s + 2, 7 * s + 1], [10, 14, 40, -1])]
    single = [np.array(x) for x in ([8, 9, 10, 12], [3, 3, 3, 3], [20, 21, 22, 24], [20, 20, 22, 22])]
    spans = substring_dedup.long_spans(marks, single, 100, 5)
    assert sorted(zip(*(x.tolist() for x in spans))) == [(0, 11, 7, 10), (8, 14, 3, 20), (10, 15, 3, 22), (12, 17, 3, 24), (30, 36, 7, 40)]


def test_paths_end_where_edges_branch(spark):
    """a-b-c-d with a second way out of c: a>b and b>c compact, c>d and c>e stand alone."""
    edges = [(h, h, left, right, doc, at) for doc, start in ((1, 0), (2, 5))
             for h, left, right, at in ((1, 1, 2, start), (2, 2, 3, start + 1), (3, 3, 4, start + 2))]
    edges += [(4, 4, 3, 5, doc, 9) for doc in (3, 4)]
    edges += [(5, 5, 8, 9, 1, 40)]                  # once: no edge of the graph
    df = spark.createDataFrame(edges, "m long, h long, l int, r int, doc_id long, at long")
    got = {(r.h, r.fdoc, r.fat, r.path) for r in substring_dedup._compacted(df).collect()}
    assert got == {(1, 1, 0, 0), (2, 1, 1, 0), (3, 1, 2, 2), (4, 3, 9, 9)}
