"""Removal of repeated word passages by compaction of a De Bruijn graph.

Every window of ``window`` words is an edge (its first and last window-1
words are the nodes).  Edges are bucketed before anything is shuffled:
consecutive edges of a document whose rarest-looking inner k-mer (the
minimizer) is the same occurrence are one record (minimizer, hash, document,
start).  Equal windows have equal minimizers, so only minimizers that occur
more than once can hold repeats.  Where all records of a minimizer are equal
nothing branches and they are settled whole, by their first source coordinate.
Where they differ (a passage begins or ends, or texts diverge), the first
occurrence of each distinct record is opened into its edges.  Edges that occur
again form the graph: joins count each node's distinct edges in and out, and
runs of edges over nodes with one of each compact into paths.

A document's marks become long spans, each with the coordinate of its first
source: neighbouring settled records of the same source, and edges of the same
path.  Every span's words are compared with the words at the source coordinate
(BLAKE2 of the words, read from both texts) before anything goes.  Hashes of 64
bits only propose: where the words differ, both texts are compared word by word
and only windows that are really equal go, so that a collision loses no word.

A passage in a third of all documents costs a partial aggregate and a join that
Spark splits: the aggregates are written tables, so no join sits on top of one.
Texts are shuffled once, into a table bucketed by document."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from streamkit.llm import hashing
from streamkit.llm.registry import boxed, fresh_dir, query, saved, table

SHIFT = 1 << 16  # a record's start and number of windows share one long
BUCKET = 16 << 20  # text bytes of a bucket


def _kmer(window: int) -> int:
    return max(1, window // 3)


def paths(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, path hash, first window, number of windows) of each path of a text."""
    k = _kmer(window)
    n = len(words) - window + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z.astype(np.uint64), z, z
    grams = hashing.rolling(words, k, seed=21)
    span = window - k + 1
    at = np.empty(n, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, span)
    for lo in range(0, n, 1 << 16):
        at[lo:lo + (1 << 16)] = view[lo:lo + (1 << 16)].argmin(axis=1)
    at += np.arange(n)
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    count = np.diff(np.concatenate([first, [n]]))
    return grams[at[first]], hashing.spans(words, first, first + count + window - 1, seed=23), first, count


def _all_paths(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                m, s, doc, meta = [], [], [], []
                for i, words in enumerate(hashing.word_hashes(part.column(1))):
                    a, b, start, count = paths(words, window)
                    m.append(a)
                    s.append(b)
                    doc.append(np.full(len(a), ids[i]))
                    meta.append(start * SHIFT + count)
                if m:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c).view(np.int64), pa.int64()) for c in (m, s, doc, meta)],
                        names=["m", "s", "doc_id", "meta"])
    return run


def _apply(words: list[bytes], spans: list[tuple[int, int]]) -> tuple[int, bytes]:
    """(words removed, the others joined by one space)."""
    if not spans:
        return 0, b" ".join(words)
    step = np.zeros(len(words) + 1, dtype=np.int64)
    for a, b in spans:
        step[min(a, len(words))] += 1
        step[min(b, len(words))] -= 1
    gone = np.cumsum(step[:-1]) > 0
    return int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist()) if not g])


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _fields(col: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """(offsets, fields) of a column of lists of structs of longs; null lists are empty."""
    size = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(size)]), [f.to_numpy(zero_copy_only=False) for f in col.flatten().flatten()]


_MARK = pa.list_(pa.struct([("key", pa.int64()), ("meta", pa.int64()), ("src", pa.int64())]))
_FIRST = "doc_id long, n_words long, sha string, text string, marks array<struct<key:long,meta:long,src:long>>"


def _first_look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without a repeated window are done here; they and those that are a source keep their text."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            n, sha, keep = [], [], []
            for text, marks in zip(part.column(1), part.column(2)):
                words = (text.as_py() or "").encode().split()
                n.append(len(words))
                keep.append(marks.is_valid)
                sha.append(None if marks.is_valid and len(marks) else hashlib.sha256(b" ".join(words)).hexdigest())
            held = pa.array([t.as_py() if k else None for t, k in zip(part.column(1), keep)], pa.string())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(sha, pa.string()), held, part.column(2).cast(_MARK)],
                                             names=["doc_id", "n_words", "sha", "text", "marks"])


def _edges(window: int):
    """The single windows of the opened records, with both nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                off, (key, meta, src) = _fields(part.column(2))
                ids = part.column(0).to_numpy(zero_copy_only=False)
                cols: list[list[np.ndarray]] = [[], [], [], [], [], []]
                for i, words in enumerate(hashing.word_hashes(part.column(1))):
                    own = slice(off[i], off[i + 1])
                    start, count = meta[own] // SHIFT, meta[own] % SHIFT
                    # rows that repeat an id share their marks, whatever their texts
                    ok = (src[own] < 0) & (start + count + window - 1 <= len(words))
                    if not ok.any():
                        continue
                    start, count, m = start[ok], count[ok], key[own][ok]
                    at = np.arange(count.sum()) + np.repeat(start - np.cumsum(count) + count, count)
                    node = hashing.rolling(words, window - 1, seed=27) if window > 1 else np.zeros(len(words) + 1, hashing.U)
                    node = (node >> hashing.U(33)).astype(np.int64)
                    for c, v in zip(cols, (np.repeat(m, count), hashing.rolling(words, window, seed=25).view(np.int64)[at], node[at], node[at + 1],
                                           np.full(len(at), ids[i]), at)):
                        c.append(v)
                if cols[0]:
                    m, h, left, right, doc, at = (np.concatenate(c) for c in cols)
                    yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(h), pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(doc), pa.array(at)],
                                                     names=["m", "h", "l", "r", "doc_id", "at"])
    return run


def _compacted(edges: DataFrame) -> DataFrame:
    """The edges that occur more than once, with the coordinate of the first
    occurrence and the path they compact into: (m, h, fdoc, fat, path), where
    ``path`` is the place of the path's first edge in that document.  A node is
    passed if one distinct edge enters and one leaves it; a path also ends where
    the first occurrence does."""
    origin = saved(edges.groupBy("m", "h").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.min("l").alias("l"), F.min("r").alias("r"), F.count("*").alias("c"))
                   .where("c > 1").drop("c"), "substring-origin")
    ends = origin.select(F.col("l").alias("l"), F.lit(1).alias("leave"), F.lit(0).alias("enter")) \
        .unionByName(origin.select(F.col("r").alias("l"), F.lit(0).alias("leave"), F.lit(1).alias("enter")))
    passed = saved(ends.groupBy("l").agg(F.sum("leave").alias("leave"), F.sum("enter").alias("enter")).where("leave = 1 AND enter = 1")
                   .select("l", F.lit(True).alias("passed")), "substring-passed")
    graph = origin.join(passed, "l", "left").select("m", "h", F.col("first.doc_id").alias("fdoc"), F.col("first.at").alias("fat"), "passed")
    along = Window.partitionBy("fdoc").orderBy("fat")
    begins = F.col("passed").isNull() | (F.coalesce(F.lag("fat").over(along), F.lit(-2)) != F.col("fat") - 1)
    return saved(graph.withColumn("begins", F.when(begins, F.col("fat")))
                 .select("m", "h", "fdoc", "fat", F.max("begins").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("path")), "substring-paths")


def long_spans(marks: list[np.ndarray], single: list[np.ndarray], n: int, window: int) -> tuple[np.ndarray, ...]:
    """(start, end, source document, source start) of a text's repeated spans:
    settled records of one source that touch, and edges of one path in a row."""
    key, meta, src = marks
    at, fdoc, fat, path = single
    out = [(np.zeros(0, np.int64),) * 4]
    again = src >= 0
    if again.any():
        doc, start = key[again], meta[again] // SHIFT
        end, delta = start + meta[again] % SHIFT + window - 1, start - src[again]
        order = np.lexsort((start, delta, doc))
        doc, start, end, delta = doc[order], start[order], end[order], delta[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (delta[1:] != delta[:-1]) | (start[1:] > end[:-1])
        first = np.flatnonzero(new)
        out.append((start[first], np.maximum.reduceat(end, first), doc[first], (start - delta)[first]))
    if len(at):
        order = np.lexsort((at, path, at - fat, fdoc))
        at, fdoc, fat, path = at[order], fdoc[order], fat[order], path[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (fdoc[1:] != fdoc[:-1]) | (np.diff(at - fat) != 0) | (path[1:] != path[:-1]) | (np.diff(at) != 1)
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(at)]]) - 1
        out.append((at[first], at[last] + window, fdoc[first], fat[first]))
    start, end, doc, source = (np.concatenate(c) for c in zip(*out))
    end = np.minimum(end, n)
    ok = end - start >= window
    return start[ok], end[ok], doc[ok], source[ok]


_CLAIM = "start:long,len:long,fdoc:long,fstart:long,digest:binary"
_DONE = f"doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, text_key long, claims array<struct<{_CLAIM}>>"


def _finish(window: int):
    """The marked texts without their repeated spans, and the spans as claims to be verified."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                m_off, marks = _fields(part.column(2))
                s_off, single = _fields(part.column(3))
                out: list[list] = [[], [], []]
                claims: list[list[np.ndarray]] = [[], [], [], []]
                digests: list[bytes] = []
                for i, text in enumerate(part.column(1)):
                    words = (text.as_py() or "").encode().split()
                    spans = long_spans([f[m_off[i]:m_off[i + 1]] for f in marks], [f[s_off[i]:s_off[i + 1]] for f in single], len(words), window)
                    pairs = list(zip(spans[0].tolist(), spans[1].tolist()))
                    removed, kept = _apply(words, pairs)
                    for c, v in zip(out, (removed, hashlib.sha256(kept).hexdigest(), kept.decode() if removed else None)):
                        c.append(v)
                    for c, v in zip(claims, (spans[0], spans[1] - spans[0], spans[2], spans[3])):
                        c.append(v)
                    digests += [_digest(words[a:b]) for a, b in pairs]
                off = pa.array(np.concatenate([[0], np.cumsum([len(c) for c in claims[0]])]), pa.int32())
                flat = pa.StructArray.from_arrays([*(pa.array(np.concatenate(c)) for c in claims), pa.array(digests, pa.binary())],
                                                  names=["start", "len", "fdoc", "fstart", "digest"])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(4), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()),
                                                  part.column(5), pa.ListArray.from_arrays(off, flat)],
                                                 names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "text_key", "claims"])
    return run


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digests of the words that stand at the source coordinates."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            off, (start, size) = _fields(part.column(2))
            digests: list[bytes] = []
            for i, text in enumerate(part.column(1)):
                words = (text.as_py() or "").encode().split()
                digests += [_digest(words[a:a + n]) for a, n in zip(start[off[i]:off[i + 1]].tolist(), size[off[i]:off[i + 1]].tolist())]
            doc = np.repeat(part.column(0).to_numpy(zero_copy_only=False), np.diff(off))
            yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start), pa.array(size), pa.array(digests, pa.binary())], names=["fdoc", "fstart", "len", "digest"])


def _compare(window: int):
    """Of spans that are not their source's words: the parts, of a window or more, that are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int, int]] = []
            for r in batch.to_pylist():
                own, other = r["text"].encode().split()[r["start"]:r["start"] + r["len"]], r["ftext"].encode().split()[r["fstart"]:r["fstart"] + r["len"]]
                same = np.array([False, *(x == y for x, y in zip(own, other)), False])
                edge = np.flatnonzero(np.diff(same))
                rows += [(r["doc_id"], r["text_key"], r["start"] + int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2]) if b - a >= window]
            cols = [pa.array([x[k] for x in rows], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_key", "start", "len"])
    return run


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            removed, kept = _apply(r["text"].encode().split(), [(x["start"], x["start"] + x["len"]) for x in r["spans"] or []])
            out.append((r["doc_id"], r["n_words"], removed, hashlib.sha256(kept).hexdigest(), kept.decode() if removed else None, r["text_key"]))
        cols = list(zip(*out)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "text_key"])


def _corrected(done: DataFrame, work: DataFrame, sources: DataFrame, good: DataFrame, wrong: DataFrame, window: int) -> DataFrame:
    """``done`` with the rows of unverified claims made again from verified spans alone."""
    row = ["doc_id", "text_key"]
    rows = saved(wrong.select(*row).distinct(), "substring-wrong-rows")
    parts = wrong.join(work.select(*row, "text").distinct(), row) \
        .join(sources.select(F.col("doc_id").alias("fdoc"), F.col("text").alias("ftext")), "fdoc") \
        .select("doc_id", "text_key", "start", "len", "fstart", "text", "ftext").where("text IS NOT NULL AND ftext IS NOT NULL") \
        .mapInArrow(_compare(window), "doc_id long, text_key long, start long, len long")
    spans = good.join(rows, row, "left_semi").select(*row, "start", "len").unionByName(parts) \
        .groupBy(*row).agg(F.collect_set(F.struct("start", "len")).alias("spans"))
    made = work.join(rows, row, "left_semi").join(spans, row, "left").select("doc_id", "text", "n_words", "text_key", "spans") \
        .mapInArrow(_again, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, text_key long")
    return done.join(rows, row, "left_anti").select(made.columns).unionByName(made)


def _buckets(spark: SparkSession, base: DataFrame) -> int:
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(100_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET)))  # Spark has no more buckets


def substring_dedup(docs: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (doc_id, n_words, n_removed, kept_sha256, kept_text, text_key).

    Removed is each word covered by a window of ``window`` consecutive words
    whose word sequence also starts earlier (smaller id, or the same id at an
    earlier place); windows are judged on the input.  ``kept_text`` is the rest
    joined by one space and ``text_key`` the text's xxhash64, null if nothing was
    removed.  Should two different passages share their hashes, words stay that
    could go; none goes that is not repeated.

    A null text has no words; a text shorter than the window keeps them all.
    A row with a null id loses nothing and takes nothing from others.  Rows
    that repeat an id are one document: equal places are the same place, so
    equal rows keep the same words; a row of another text loses only words that
    are repeated in its own.  Other columns are ignored; an empty table gives an
    empty one."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    named = base.where("doc_id IS NOT NULL")
    buckets = _buckets(spark, named)
    found = named.mapInArrow(_all_paths(window), "m long, s long, doc_id long, meta long")
    # each aggregate is a table of its own: a join with it is a plain join of two
    # scans, in which Spark splits the rows of a hot key over many tasks
    often = saved(found.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m"), "substring-often")
    repeats = saved(found.join(often, "m"), "substring-repeats")

    first = saved(repeats.groupBy("m", "s").agg(F.min(F.struct("doc_id", "meta")).alias("first")), "substring-first")
    branching = saved(first.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m", F.lit(True).alias("branches")), "substring-branching")
    settled = saved(first.join(branching, "m", "left"), "substring-settled")
    again = F.struct("doc_id", "meta") > F.col("first")
    mark = F.struct(F.when(F.col("again"), F.col("first.doc_id")).otherwise(F.col("m")).alias("key"), "meta",
                    F.when(F.col("again"), F.floor(F.col("first.meta") / SHIFT)).otherwise(F.lit(-1)).cast("long").alias("src"))
    marks = repeats.join(settled, ["m", "s"]).withColumn("again", again).where("again OR branches").select("doc_id", mark.alias("mark"))
    sources = settled.where("branches IS NULL").select(F.col("first.doc_id").alias("doc_id")).distinct()  # opened records keep their own texts
    marks = marks.unionByName(sources.withColumn("mark", F.lit(None).cast(marks.schema["mark"].dataType))) \
        .repartition(buckets, "doc_id").groupBy("doc_id").agg(F.collect_set("mark").alias("marks"))

    path, name = fresh_dir(spark, "substring-looked"), f"substring_looked_{uuid.uuid4().hex[:12]}"
    named.repartition(buckets, "doc_id").join(marks, "doc_id", "left").mapInArrow(_first_look, _FIRST) \
        .write.option("path", path).option("compression", "zstd").bucketBy(buckets, "doc_id").saveAsTable(name)
    looked = spark.table(name)
    work = looked.where("size(marks) > 0").withColumn("text_key", F.xxhash64("text"))
    edges = saved(work.where(F.exists("marks", lambda x: x["src"] < 0)).select("doc_id", "text", "marks")
                  .mapInArrow(_edges(window), "m long, h long, l int, r int, doc_id long, at long"), "substring-edges")
    single = edges.select("m", "h", "doc_id", "at").join(_compacted(edges), ["m", "h"]).where(F.struct("doc_id", "at") > F.struct("fdoc", "fat")) \
        .select("doc_id", F.struct("at", "fdoc", "fat", "path").alias("single")) \
        .repartition(buckets, "doc_id").groupBy("doc_id").agg(F.collect_set("single").alias("single"))
    path_done = fresh_dir(spark, "substring-done")
    work.join(single, "doc_id", "left").select("doc_id", "text", "marks", "single", "n_words", "text_key").mapInArrow(_finish(window), _DONE) \
        .write.option("compression", "zstd").parquet(path_done)
    done = spark.read.schema(_DONE).parquet(path_done)

    claims = done.select("doc_id", "text_key", F.explode("claims").alias("c")).select("doc_id", "text_key", "c.*")
    asked = claims.select("fdoc", "fstart", "len").distinct().repartition(buckets, "fdoc") \
        .groupBy(F.col("fdoc").alias("doc_id")).agg(F.collect_list(F.struct("fstart", "len")).alias("asked"))
    texts = looked.where("marks IS NOT NULL").select("doc_id", "text")
    answers = saved(texts.join(asked, "doc_id").select("doc_id", "text", "asked").mapInArrow(_answers, "fdoc long, fstart long, len long, digest binary"),
                    "substring-answers")
    on = ["fdoc", "fstart", "len", "digest"]
    wrong = saved(claims.join(answers, on, "left_anti"), "substring-wrong")
    out = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "text_key"]
    stored = spark.read.schema(_FIRST).parquet(path)
    if wrong.isEmpty():
        done = done.select(out)
    else:
        kept = stored.where("marks IS NOT NULL").withColumn("text_key", F.xxhash64("text"))
        done = _corrected(done, kept.where("size(marks) > 0"), kept, claims.join(answers, on, "left_semi"), wrong, window)
    spark.sql(f"DROP TABLE {name}")  # its files stay: what follows reads them

    loose = base.where("doc_id IS NULL").select("doc_id", "text", F.lit(None).cast("array<struct<key:long,meta:long,src:long>>").alias("marks")) \
        .mapInArrow(_first_look, _FIRST)
    clean = stored.where("coalesce(size(marks), 0) <= 0").unionByName(loose) \
        .select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"),
                F.lit(None).cast("string").alias("kept_text"), F.lit(None).cast("long").alias("text_key"))
    return done.unionByName(clean)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(range(0, len(ws) - 19)) AS p,
             unnest(list_transform(range(1, len(ws) - 18), lambda i: md5(array_to_string(ws[i:i + 19], ' ')))) AS h FROM d WHERE len(ws) >= 20),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM r),
o AS (SELECT doc_id, unnest(range(0, len(ws))) AS p, unnest(ws) AS word FROM d),
j AS (SELECT o.doc_id, string_agg(word, ' ' ORDER BY o.p) AS t, count(*) AS n FROM o ANTI JOIN g ON g.doc_id = o.doc_id AND g.p = o.p GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(j.n, 0))::BIGINT AS n_removed, sha256(coalesce(j.t, '')) AS kept_sha256
FROM d LEFT JOIN j ON j.doc_id = d.doc_id
"""


@query("op2_substring_dedup", SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=20).select("doc_id", "n_words", "n_removed", "kept_sha256")


def strip_repeats(docs: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages taken out of the text; other columns, of
    whatever names, and texts that lose nothing, stay as they are.  Null ids
    lose nothing; rows that repeat an id lose what is repeated in their own text;
    an empty table gives an empty one."""
    changed = substring_dedup(docs, window=window, id_col=id_col, text_col=text_col).where("n_removed > 0").select("doc_id", "text_key", "kept_text").distinct()
    rows = boxed(docs, key=F.col(f"`{id_col}`").cast("long"), hash=F.xxhash64(F.col(f"`{text_col}`").cast("string")))
    out = rows.join(changed, (rows["key"] == changed["doc_id"]) & (rows["hash"] == changed["text_key"]), "left")
    text = F.coalesce("kept_text", F.col("row").getField(text_col).cast("string"))
    return out.select(*[text.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
