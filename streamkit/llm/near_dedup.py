"""Near-duplicate groups by b-bit MinHash.

Each document keeps K minima of its shingle set.  Runs of ``ROWS`` minima make
band keys; of every minimum only the low ``BITS`` bits stay, packed as bit
planes.  Two documents that share a band are a candidate; the share of equal
b-bit values, corrected for the 2**-BITS that agree by chance, must not be
clearly under the threshold (a bit count), and the full sets decide.

Work stays near linear in a group of copies: equal sets collapse to one
representative first, then each document is compared with the smallest
document of each of its bands.  Only bands that still hold more than one
component afterwards go on: their members are compared across components, in
blocks of bounded size, and each block pair returns the links that join
components, not all pairs.  Nothing is capped.

A pair exactly at the threshold misses every band with probability
(1 - t**ROWS)**BANDS: 4e-7 at 0.85, 5e-5 at 0.8; pairs above it far less."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.llm import hashing
from streamkit.llm.components import components
from streamkit.llm.registry import boxed, query, saved, table

ROWS, BANDS, BITS = 5, 25, 2
K = 128  # minima: ROWS * BANDS for the bands, all of them for the estimate
BLOCK = 1 << 18  # shingles in a block of the exact comparison

_rng = random.Random(20240131)
_MUL = np.array([_rng.getrandbits(64) | 1 for _ in range(K)], dtype=np.uint64)[:, None]
_ADD = np.array([_rng.getrandbits(64) for _ in range(K)], dtype=np.uint64)[:, None]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, an empty text none."""
    if not len(words):
        return words
    return np.unique(hashing.shingles(words, min(k, len(words)), seed=k))


def minima(values: np.ndarray) -> np.ndarray:
    out = np.full(K, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), 1024):
        np.minimum(out, (values[None, at:at + 1024] * _MUL + _ADD).min(axis=1), out=out)
    return out


def signature(low: np.ndarray) -> np.ndarray:
    """BITS planes of K bits, as 64-bit words, plane after plane."""
    low = hashing.mix(low)
    planes = [np.packbits(((low >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)) for b in range(BITS)]
    return np.concatenate(planes).view(np.int64)


def most_mismatches(percent: int) -> int:
    """b-bit values that may differ at the threshold: the mean and six deviations."""
    q = (1 - percent / 100) * (1 - 2.0 ** -BITS)
    return math.ceil(K * q + 6 * math.sqrt(K * q * (1 - q)))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
                     ("bands", pa.list_(pa.int64())), ("sig", pa.list_(pa.int64()))])


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for words in hashing.word_hashes(batch.column(1), lower=True):
                s = shingle_set(words, k)
                if not len(s):
                    rows.append((0, 0, 0, [], []))
                    continue
                low = minima(s)
                bands = hashing.rolling(low, ROWS, seed=3)[:ROWS * BANDS:ROWS] + np.arange(BANDS, dtype=np.uint64)
                a, b = hashing.mix(s, 11).sum(), hashing.mix(s, 13).sum()
                rows.append((len(s), int(a.view(np.int64)), int(b.view(np.int64)), bands.view(np.int64), signature(low)))
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), t.type) for c, t in zip(cols, list(_SIGNED)[1:]))], schema=_SIGNED)
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(w, k).view(np.int64) for w in hashing.word_hashes(part.column(1), lower=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "s"])
    return run


def _differ(a: str, b: str) -> F.Column:
    """Number of b-bit values in which two packed signatures differ, by bit counts."""
    words = K // 64
    return sum((F.bit_count(sum_or([F.col(a)[p * words + w].bitwiseXOR(F.col(b)[p * words + w]) for p in range(BITS)]))
                for w in range(words)), F.lit(0))


def sum_or(cols: list[F.Column]) -> F.Column:
    out = cols[0]
    for c in cols[1:]:
        out = out.bitwiseOR(c)
    return out


def _unit_links(percent: int):
    """Links between the components that meet in one pair of blocks."""
    most = most_mismatches(percent)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("doc_id")
        ids, roots = pdf["doc_id"].to_numpy(), pdf["root"].to_numpy()
        sigs = np.stack([np.asarray(x, dtype=np.int64) for x in pdf["sig"]]).view(np.uint64).reshape(len(ids), BITS, -1)
        sizes = pdf["s"].map(len).to_numpy()
        _, where = np.unique(np.concatenate(pdf["s"].to_list()), return_inverse=True)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        top = np.unique(roots, return_inverse=True)[1]  # component of each row, merged as links are found
        flag = np.zeros(int(where.max()) + 1, dtype=np.int64)
        out: list[tuple[int, int]] = []
        counts = np.bincount(top)
        for i in np.argsort(counts[top], kind="stable"):  # members of small components first
            bits = np.bitwise_or.reduce(sigs ^ sigs[i], axis=1)
            cand = (np.bitwise_count(bits).sum(axis=1) <= most) & (top != top[i])
            if not cand.any():
                continue
            own = where[first[i]:first[i] + sizes[i]]
            flag[own] = 1
            common = np.add.reduceat(flag[where], first)
            flag[own] = 0
            for j in np.flatnonzero(cand & (100 * common >= percent * (sizes + sizes[i] - common))):
                if top[j] != top[i]:
                    out.append((ids[i], ids[j]))
                    top[top == top[j]] = top[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components of one supergroup. members: doc_id, root, grp, n_shingles, sig."""
    comp = members.groupBy("grp", "root").agg(F.sum("n_shingles").alias("weight"))
    small = comp.where(F.col("weight") < BLOCK).groupBy("grp").agg(F.sum("weight").alias("rest"))
    plan = comp.join(small, "grp", "left") \
        .withColumn("pure", F.col("weight") >= BLOCK) \
        .withColumn("parts", F.ceil(F.when(F.col("pure"), F.col("weight")).otherwise(F.col("rest")) / BLOCK))
    placed = saved(members.join(plan, ["grp", "root"]).select(
        "grp", "root", "doc_id", "sig",
        F.when(F.col("pure"), F.col("root")).alias("owner"),
        F.when(F.col("pure"), F.pmod(F.xxhash64("doc_id"), "parts")).otherwise(F.pmod(F.xxhash64("root"), "parts")).alias("part")),
        "near-placed")
    blocks = placed.select("grp", "owner", "part").distinct().withColumn("block", F.xxhash64(F.coalesce("owner", F.lit(-1)), "part"))
    left = blocks.select("grp", F.col("owner").alias("o1"), F.col("block").alias("b1"))
    right = blocks.select("grp", F.col("owner").alias("o2"), F.col("block").alias("b2"))
    units = left.join(right, "grp").where((F.col("b1") <= F.col("b2")) & ~F.coalesce(F.col("o1") == F.col("o2"), F.lit(False))) \
        .select("grp", "b1", "b2")
    sides = units.withColumn("block", F.col("b1")).unionByName(units.where("b1 <> b2").withColumn("block", F.col("b2")))
    rows = placed.withColumn("block", F.xxhash64(F.coalesce("owner", F.lit(-1)), "part")).join(sides, ["grp", "block"]) \
        .join(sets, "doc_id").select("grp", "b1", "b2", "doc_id", "root", "sig", "s")
    return rows.groupBy("grp", "b1", "b2").applyInPandas(_unit_links(percent), "a long, b long")


def near_duplicates(docs: DataFrame, *, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (doc_id, n_shingles, component_id, kept); linked are documents
    whose sets of ``k``-word shingles have a Jaccard similarity of
    ``percent``/100 or more, and a component is all that links reach.

    Words are lower-cased (A-Z).  A text with fewer than k words is one
    shingle; a null or empty text has none, is linked with nothing and kept.
    A row with a null id is linked with nothing, has a null component and is
    kept.  Rows that repeat an id are one document with as many rows, each
    returned.  Other columns are ignored; an empty table gives an empty one."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = saved(base.mapInArrow(_sign(k), "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sig array<long>"), "near-signed")
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # a table of its own: the join below is then one of two scans, in which Spark splits a large class
    classes = saved(named.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep")), "near-classes")
    members = saved(signed.join(classes, ["set_a", "set_b", "n_shingles"], "left")
                    .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")), "near-members")
    reps = signed.join(classes.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")

    banded = reps.select(F.explode("bands").alias("band"), "doc_id")
    centers = banded.groupBy("band").agg(F.min("doc_id").alias("center"), F.max("doc_id").alias("last")).where("center < last").drop("last")
    buckets = saved(banded.join(centers, "band"), "near-buckets")
    pairs = buckets.where("doc_id <> center").select(F.col("doc_id").alias("a"), F.col("center").alias("b")).distinct()
    known = reps.select("doc_id", "n_shingles", "sig")
    met = buckets.select("doc_id").distinct()
    sets = saved(base.join(met, "doc_id", "left_semi").mapInArrow(_sets(k), "doc_id long, s array<long>"), "near-sets")

    close = pairs.join(known.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a")), "a") \
        .join(known.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b")), "b") \
        .where(_differ("sig_a", "sig_b") <= most_mismatches(percent)).select("a", "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    links = close.join(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("s_a")), "a") \
        .join(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("s_b")), "b") \
        .where(100 * common >= percent * (F.size("s_a") + F.size("s_b") - common)).select("a", "b")
    first = components(links)

    # bands that hold more than one component: their components form supergroups
    rooted = buckets.select("band", "doc_id").join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
        .select("band", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    split = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("band", "low")
    touching = rooted.join(split, "band").where("root <> low").select(F.col("root").alias("a"), F.col("low").alias("b")).distinct()
    groups = components(touching).select(F.col("node").alias("root"), F.col("root").alias("grp"))
    crossing = rooted.select("doc_id", "root").distinct().join(groups, "root").join(known, "doc_id")
    more = _across(crossing, sets, percent)
    owner = first.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    more = more.join(owner, "a", "left").join(owner.select(F.col("a").alias("b"), F.col("ra").alias("rb")), "b", "left") \
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    second = components(more)

    out = members.join(first.select(F.col("node").alias("rep"), F.col("root").alias("r1")), "rep", "left") \
        .withColumn("r1", F.coalesce("r1", "rep")) \
        .join(second.select(F.col("node").alias("r1"), F.col("root").alias("r2")), "r1", "left") \
        .withColumn("component_id", F.coalesce("r2", "r1"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT c.a, c.b FROM c JOIN n p ON p.doc_id = c.a JOIN n q ON q.doc_id = c.b WHERE 100 * x >= 85 * (p.n + q.n - x)),
r AS (WITH RECURSIVE reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
      SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(r.low, w.doc_id)) AS component_id,
       w.doc_id <= coalesce(r.low, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN r ON r.a = w.doc_id
"""


@query("op1_minhash_near_dedup", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def keep_one(docs: DataFrame, *, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the near duplicates: of each group the rows of the
    smallest id stay, with all their columns, whatever their names; rows without
    an id, and with a null or empty text, always stay.  Rows that repeat an id
    stay or go together; an empty table gives an empty one."""
    gone = near_duplicates(docs, k=k, percent=percent, id_col=id_col, text_col=text_col).where("NOT kept").select("doc_id").distinct()
    rows = boxed(docs, key=F.col(f"`{id_col}`").cast("long"))
    return rows.join(gone, rows["key"] == gone["doc_id"], "left_anti").select("row.*")
