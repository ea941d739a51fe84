"""Order MinHash fingerprints and how they see a text after an edit.

All texts are sketched in one kind of unit, whatever their length: runs of bytes
between white space, in which a character from U+3000 on is a unit by itself
and a place where a hash of the eight bytes before it says so is a border.
Ordinary words are shorter than that or nearly so and stay whole; texts without
spaces and very long words have many units, with borders that depend on what
stands there alone.

A text's k-mers of units are numbered by occurrence, so that repeats count.  For each of
``SKETCHES`` hash functions the ``TUPLE`` numbered k-mers of least hash are
taken, put back into the order in which they stand in the text, and hashed
together.  Two fingerprints agree in a share of sketches that falls with the
edit distance: it needs the same k-mers in the same order.

Each document is also compared with the next one in descending id order, and
with its own text after its last third was overwritten from that next text.
One shuffle by range puts the texts in order; a task holds one text at a time.
Where a task ends, its last text meets the first of the next task in a small
second step, a pair of texts for each task."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.llm import hashing
from streamkit.llm.registry import query, saved, table

SKETCHES, TUPLE, WORDS = 64, 2, 2
LOOK, ONE_IN = 8, 8  # bytes before a border inside a run, and how rare it is
RANGE = 16 << 20  # text bytes of a task
U = np.uint64
_SEEDS = hashing.mix(np.arange(SKETCHES, dtype=U), 77)[:, None] | U(1)


def units(text: str) -> np.ndarray:
    """Hashes of the text's units, in order."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return np.concatenate([np.zeros(0, U), *(_units(piece) for piece in hashing._pieces(data))])


def _units(data: np.ndarray) -> np.ndarray:
    n = len(data)
    inside = ~hashing.SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    wide = np.flatnonzero(data >= 0xE3)  # first byte of a character from U+3000 on: a unit by itself
    behind = wide + np.where(data[wide] >= 0xF0, 4, 3)
    first[wide] = True
    behind = behind[behind < n]
    first[behind] |= inside[behind]
    up, down = hashing._power(n)
    total = np.zeros(n + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * up[:n], out=total[1:])
    run = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))  # place in the run
    at = np.flatnonzero(inside & ~first & (run >= LOOK))
    at = at[hashing.mix((total[at] - total[at - LOOK]) * down[at - LOOK], 29) % U(ONE_IN) == 0]
    first[at] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], n)
    gaps = np.flatnonzero(hashing.SPACE[data])  # a unit ends at white space at the latest
    if len(gaps) and len(starts):
        k = np.searchsorted(gaps, starts)
        ends = np.minimum(ends, np.append(gaps, n)[k])
    return hashing.mix((total[ends] - total[starts]) * down[starts] ^ (ends - starts).astype(U), 33)


def numbered(kmers: np.ndarray) -> np.ndarray:
    """Each k-mer's hash with its occurrence number (0, 1, ...) mixed in."""
    order = np.argsort(kmers, kind="stable")
    s = kmers[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    out = np.empty_like(kmers)
    out[order] = hashing.mix(s ^ hashing.mix((np.arange(len(s)) - first).astype(U), 37), 39)
    return out


def fingerprint(text: str) -> np.ndarray:
    """SKETCHES 32-bit values; none for an empty text."""
    if not text:
        return np.zeros(0, dtype=np.uint32)
    words = units(text)
    return _sketch(hashing.shingles(words, min(WORDS, len(words)), seed=31) if len(words) else np.full(1, 31, dtype=U))  # only white space


def _sketch(kmers: np.ndarray) -> np.ndarray:
    items = numbered(kmers)
    n = len(items)
    size = min(TUPLE, n)
    best = best_at = None
    for lo in range(0, n, 2048):  # bounded memory for long texts
        part = items[None, lo:lo + 2048] * _SEEDS
        part = part ^ (part >> U(32))
        take = min(size, part.shape[1])
        at = np.argpartition(part, take - 1, axis=1)[:, :take] if take < part.shape[1] else np.tile(np.arange(take), (SKETCHES, 1))
        low, at = np.take_along_axis(part, at, axis=1), at + lo
        if best is not None:
            low, at = np.concatenate([best, low], axis=1), np.concatenate([best_at, at], axis=1)
            keep = np.argsort(low, axis=1, kind="stable")[:, :size]
            low, at = np.take_along_axis(low, keep, axis=1), np.take_along_axis(at, keep, axis=1)
        best, best_at = low, at
    at = np.sort(best_at, axis=1)
    out = np.zeros(SKETCHES, dtype=U)
    for j in range(at.shape[1]):
        out = hashing.mix((out << U(9) | out >> U(55)) ^ items[at[:, j]], 41 + j)
    return (out >> U(32)).astype(np.uint32)


def near(a: np.ndarray, b: np.ndarray) -> float:
    """Share of sketches that agree; two empty texts are alike, one is not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    n = len(text) // 3
    return text[:len(text) - n] + following[:n] if n else text


_OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
                  ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_ENDS = pa.schema([*_OUT, ("part", pa.int32()), ("first", pa.string()), ("last", pa.string())])
_TYPES = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(doc: int | None, own: str, sketch: np.ndarray, following: str, next_sketch: np.ndarray) -> tuple:
    changed = edited(own, following)
    other = fingerprint(changed) if changed != own else sketch
    return (doc, len(own), hashlib.sha256(changed.encode()).hexdigest(), sketch.astype(">u4").tobytes(),
            other.astype(">u4").tobytes(), near(sketch, other), near(sketch, next_sketch))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as zstd bytes, for the shuffle."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            part = batch.slice(lo, 1000)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([pack.compress(t.encode()) for t in part.column(3).to_pylist()], pa.binary())],
                                             names=["doc_id", "hash", "row", "text"])


def _in_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range, in order; at its end its first text, and its last document for the next range's first text."""
    rows: list[tuple] = []
    first = held = None
    part, none = 0, (None, None, None)
    for batch in batches:
        for at in range(batch.num_rows):
            part, doc, text = (batch.column(c)[at].as_py() for c in range(3))
            text = zstandard.decompress(text).decode()
            mine = fingerprint(text)
            if held is None:
                first = text
            else:
                rows.append((*_compared(*held, text, mine), *none))
            held = doc, text, mine
            if len(rows) >= 1000:
                yield _batch(rows, _ENDS)
                rows = []
    if held is not None:
        rows.append((held[0], *[None] * 6, part, first, held[1]))
        yield _batch(rows, _ENDS)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, last, first): a range's last document and the next range's first text."""
    for batch in batches:
        for doc, last, first in zip(*(c.to_pylist() for c in batch.columns)):
            yield _batch([_compared(doc, last, fingerprint(last), first, fingerprint(first))], _OUT)


def fingerprints(docs: DataFrame, *, ranges: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next).

    Rows are in descending order of id (rows of one id in a fixed order by their
    text, null ids last), in ``ranges`` (RANGE bytes of text each, if not given);
    next is the row after, and after the last the first.  The edited text has the
    last floor(n_chars / 3) characters replaced by the next text's first as many,
    or all it has.  A null text is empty; an empty text has the fingerprint "",
    like only other empty ones; a single row is its own next.  Other columns are
    ignored; an empty table gives an empty one."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    count = ranges or -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE)
    order = [F.col("doc_id").desc_nulls_last(), F.desc("hash"), F.desc("row")]  # a repeated id is spread too
    placed = rows.select("doc_id", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"), "text") \
        .mapInArrow(_shortened, "doc_id long, hash long, row long, text binary") \
        .repartitionByRange(max(1, int(count)), *order).sortWithinPartitions(*order)
    found = saved(placed.select(F.spark_partition_id().alias("part"), "doc_id", "text")
                  .mapInArrow(_in_range, _TYPES + ", part int, first string, last string"), "fingerprints")
    ends = found.where("part IS NOT NULL").select("part", "doc_id", "first", "last")
    parts = sorted(r.part for r in ends.select("part").collect())  # a number for each range
    if not parts:
        return _written(found)
    following = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    heads = ends.select(F.col("part").alias("next"), F.col("first").alias("text"))
    across = ends.join(following, "part").join(heads, "next").select("doc_id", "last", "text").mapInArrow(_across, _TYPES)
    return _written(found.where("part IS NULL").select(*_OUT.names).unionByName(across))


def _written(found: DataFrame) -> DataFrame:
    """Fingerprints in hex; as tables they are kept in bytes."""
    return found.select(*[F.lower(F.hex(c)).alias(c) if c.endswith("fingerprint") else F.col(c) for c in _OUT.names])


@query("op8_order_minhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
