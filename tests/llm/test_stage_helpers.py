"""The stage helpers keep rows whole, whatever the columns are called."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from streamkit.llm import mixing, near_dedup, quality_rules, substring_dedup

# names that the operators use inside, and names that need quoting
NAMES = ["id_", "key", "row", "hash", "doc_id_", "text_key", "kept_text", "kept_text_", "passes", "passes_", "pass", "pass_", "size", "s_", "k_", "source_size",
         "target", "taken", "bucket", "n_words", "kept", "component_id", "rep", "band", "score", "a.b", "a b", "`q`", "row.x", "m", "marks"]
WORDS = " ".join(f"word{i}" for i in range(80))
ROWS = [(1, WORDS, "s"), (1, WORDS, "s"), (2, WORDS + " and more", "s"), (3, None, "t"), (4, "", None), (None, WORDS, "t"), (None, None, None),
        (5, " ".join(f"other{i}" for i in range(90)) + " " + WORDS, "u"), (6, "short", "u")]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], "doc_id long, text string, source string, number int")
    return df.select("*", *[F.concat(F.lit(f"{n}-"), "number").alias(n) for n in NAMES])


HELPERS = {
    "keep_good": lambda d: quality_rules.keep_good(d, d.sparkSession.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")),
    "keep_one": near_dedup.keep_one, "strip_repeats": lambda d: substring_dedup.strip_repeats(d, window=50), "mixed_rows": mixing.mixed_rows,
}


@pytest.mark.parametrize("name", HELPERS)
def test_rows_come_out_whole(docs, name):
    out = HELPERS[name](docs)
    assert out.columns == docs.columns
    rows = out.collect()
    for r in rows:
        assert all(r[n] == f"{n}-{r.number}" for n in NAMES)
        assert (r.doc_id, r.source) == (ROWS[r.number][0], ROWS[r.number][2])
    count = Counter(r.number for r in rows)
    if name == "keep_good":      # ids of which a row is rejected go; rows without an id stay
        assert count == Counter([0, 1, 2, 5, 6, 7])
    elif name == "keep_one":     # 1, 2 and 5 are not alike enough but 1 and 2; empty texts and null ids stay
        assert count == Counter([0, 1, 3, 4, 5, 6, 7, 8])
    elif name == "strip_repeats":
        text = {r.number: r.text for r in rows}
        assert count == Counter(range(9)) and [text[i] for i in (3, 4, 5, 6, 8)] == [None, "", WORDS, None, "short"]
        assert text[0] == text[1] == WORDS and text[2] == "and more" and text[7] == " ".join(f"other{i}" for i in range(90))
    else:
        assert all(0 <= n <= 3 for n in count.values()) and {3, 4, 6} <= set(count) and count[3] == count[4] == count[6] == 1


@pytest.mark.parametrize("name", HELPERS)
def test_no_rows(docs, name):
    out = HELPERS[name](docs.limit(0))
    assert out.columns == docs.columns and out.count() == 0


def test_rows_that_share_an_id_keep_their_own_texts(spark):
    a, b = WORDS, " ".join(f"else{i}" for i in range(60))
    rows = [(1, a, 0), (2, f"{a} tail of two", 1), (2, f"{b} tail of another two", 2), (3, f"x {b}", 3)]
    out = {r.n: r.text for r in substring_dedup.strip_repeats(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect()}
    assert out == {0: a, 1: "tail of two", 2: f"{b} tail of another two", 3: "x"}
