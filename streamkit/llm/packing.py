"""Packing of tokenized documents into sequences of a fixed length.

Pieces of the full length are sequences of their own.  The other pieces are
dealt by hash into groups of bounded size; each group is packed by itself:
best fit in decreasing order, then a local search that moves a document, or
exchanges one for one or two for one, from the emptiest bin into fuller ones as
long as the sum of squared fills grows, so that bins empty.  The emptiest bins
of the groups are then pooled and packed again, until one group holds them
all.  A group is off the best packing by about one bin, so the loss is a bin
in tens of thousands of documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.llm.registry import query, saved, table
from streamkit.llm.tokens import byte_level

SIZE = 1024
GROUP = 40_000  # pieces packed together
POOLED = 64  # emptiest bins of each group that are packed again with those of other groups

_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def piece_cuts(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length): one piece, or pieces of ``size`` of which the first may be shorter."""
    first = n if n <= size else n % size or size
    return [(0, first)] + [(at, size) for at in range(first, n, size)]


def _tokenize(vocabulary: str, end_id: int, size: int):
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = byte_level(vocabulary)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), pieces.ids([t.as_py() or "" for t in part.column(1)])):
                    ids += end
                    rows += [(doc, k, a, n, zlib.crc32(ids[4 * a:4 * (a + n)])) for k, (a, n) in enumerate(piece_cuts(len(ids) // 4, size))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _PIECES)], schema=_PIECES)
    return run


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that has room."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms, bins = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = size, len(bins)
            bins.append([])
        bins[b].append(i)
        if room - n:
            by_room[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins


def least_bins(lengths: np.ndarray, size: int) -> int:
    """No packing has fewer: by total length, and by pieces over half a bin."""
    return max(-(-int(lengths.sum()) // size), int((2 * lengths > size).sum()))


class _Open:
    """Bins with room, by room; of each room the lengths of single pieces and the
    sums of two pieces of a bin, as a bit set and with the bins that hold them."""

    def __init__(self, size: int):
        self.rooms = 0
        self.bins: list[set[int]] = [set() for _ in range(size + 1)]
        self.bits: list[list[int]] = [[0] * (size + 1) for _ in range(2)]
        self.held: list[dict[tuple[int, int], set[int]]] = [{}, {}]

    def add(self, b: int, room: int, lengths: list[int]) -> None:
        self.rooms |= 1 << room
        self.bins[room].add(b)
        for held, bits, sums in zip(self.held, self.bits, _sums_of(lengths)):
            for n in sums:
                held.setdefault((room, n), set()).add(b)
                bits[room] |= 1 << n

    def remove(self, b: int, room: int, lengths: list[int]) -> None:
        self.bins[room].discard(b)
        if not self.bins[room]:
            self.rooms &= ~(1 << room)
        for held, bits, sums in zip(self.held, self.bits, _sums_of(lengths)):
            for n in sums:
                held[room, n].discard(b)
                if not held[room, n]:
                    del held[room, n]
                    bits[room] &= ~(1 << n)

    def exchange(self, n: int, least: int, pieces: int) -> tuple[int, int, int]:
        """(gain, bin, length): the piece (or the two) shorter than ``n`` by most, by
        no more than its bin's room, in bins with at most ``least`` room."""
        best, left = (0, -1, 0), self.rooms & ((2 << least) - 1)
        while left:
            room = left.bit_length() - 1
            if room <= best[0]:
                break
            left &= ~(1 << room)
            low = max(1, n - room)
            fit = self.bits[pieces - 1][room] >> low
            if fit:
                length = low + (fit & -fit).bit_length() - 1
                if n - length > best[0]:
                    best = n - length, next(iter(self.held[pieces - 1][room, length])), length
        return best


def _sums_of(lengths: list[int]) -> tuple[set[int], set[int]]:
    """The distinct lengths, and the distinct sums of two pieces."""
    if len(lengths) == 2:
        return set(lengths), {lengths[0] + lengths[1]}
    seen, sums = 0, 0
    for n in lengths:
        sums |= seen << n
        seen |= 1 << n
    return set(lengths), {i for i, c in enumerate(bin(sums)[:1:-1]) if c == "1"}


def _take(items: list[int], lengths: list[int], total: int, pieces: int) -> list[int]:
    """Items of a bin (one, or two) of that length together."""
    if pieces == 1:
        return [next(i for i in items if lengths[i] == total)]
    at: dict[int, int] = {}
    for i in items:
        if total - lengths[i] in at:
            return [at[total - lengths[i]], i]
        at[lengths[i]] = i
    raise ValueError("no such pair")


def local_search(bins: list[list[int]], lengths: np.ndarray, size: int) -> list[list[int]]:
    """Empties bins by moves and exchanges (one for one, two for one) out of one
    bin into bins as full or fuller, each of which lets the sum of squared fills
    grow.  Passes over the bins, emptiest first, go on until the fewest possible
    bins are reached or no step of any bin helps; the sum is bounded, so they end."""
    least, lengths = least_bins(lengths, size), lengths.tolist()
    bins = [list(b) for b in bins]
    room = [size - sum(lengths[i] for i in b) for b in bins]
    count = len(bins)
    if count <= least:
        return bins
    state = _Open(size)
    of = lambda b: [lengths[i] for i in bins[b]]
    for b in range(count):
        if room[b]:
            state.add(b, room[b], of(b))

    def step(low: int) -> bool:
        """One move or exchange out of the bin, if any helps."""
        items = sorted(bins[low], key=lambda i: (-lengths[i], i))
        state.remove(low, room[low], of(low))
        found = None
        for x in items:
            n = lengths[x]
            fits = (state.rooms & ((2 << room[low]) - 1)) >> n
            if fits:  # into the fullest bin that takes it
                found = x, next(iter(state.bins[n + (fits & -fits).bit_length() - 1])), []
                break
            for pieces in (1, 2):  # for a shorter piece, or two, of a bin that then is fuller
                gain, b, length = state.exchange(n, room[low], pieces)
                if gain:
                    found = x, b, _take(bins[b], lengths, length, pieces)
                    break
            if found:
                break
        if found:
            x, b, back = found
            state.remove(b, room[b], of(b))
            bins[low].remove(x)
            bins[b].append(x)
            for i in back:
                bins[b].remove(i)
                bins[low].append(i)
            gain = lengths[x] - sum(lengths[i] for i in back)
            room[b] -= gain
            room[low] += gain
            if room[b]:
                state.add(b, room[b], of(b))
        if bins[low]:
            state.add(low, room[low], of(low))
        return found is not None

    helped = True
    while helped and count > least:
        helped = False
        for low in sorted((b for b in range(len(bins)) if bins[b] and room[b]), key=lambda b: (-room[b], b)):
            while bins[low] and room[low] and step(low):
                helped = True
            count -= not bins[low]
            if count <= least:
                break
    return [b for b in bins if b]


def _pack(size: int, pooled: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        lengths = pdf["length"].to_numpy()
        bins = local_search(best_fit(lengths, size), lengths, size)
        fill = np.array([lengths[b].sum() for b in bins])
        loose = set(np.argsort(fill, kind="stable")[:pooled].tolist()) & set(np.flatnonzero(fill < size).tolist())
        order = np.concatenate([np.asarray(b) for b in bins])
        sizes = np.array([len(b) for b in bins])
        ends = np.cumsum(lengths[order])
        begin = ends - lengths[order]
        firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return pd.DataFrame({"uid": pdf["uid"].to_numpy()[order], "length": lengths[order], "grp": key[0],
                             "bin": np.repeat(np.arange(len(bins)), sizes), "at": begin - np.repeat(begin[firsts], sizes),
                             "loose": np.repeat([i in loose for i in range(len(bins))], sizes)})
    return run


def pack(docs: DataFrame, *, size: int = SIZE, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2, group: int = GROUP,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A document is its ids and ``end_id``; only longer ones than ``size`` are
    cut, into pieces of ``size`` of which the first may be shorter.  A null or
    empty text is the end id alone.  Null ids and rows that repeat an id are
    packed as documents of their own; other columns are ignored; an empty table
    gives an empty one."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = saved(rows.mapInArrow(_tokenize(vocabulary, end_id, size), "doc_id long, piece int, start long, length long, ids_crc32 long")
                   .withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")
    todo, level, settled = pieces.where(F.col("length") < size).select("uid", "length"), 0, []
    count, before = todo.count(), None
    while count:
        groups = -(-count // group)
        last = groups == 1 or (before is not None and 2 * count > before)  # the pool must shrink by half, or it is settled
        packed = saved(todo.groupBy(F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("grp"))
                       .applyInPandas(_pack(size, 0 if last else POOLED), "uid long, length long, grp long, bin long, at long, loose boolean"),
                       f"pack-level{level}")
        place = packed.where("NOT loose").select(
            "uid", ((F.lit(level + 1).cast("long") * (1 << 54)) + F.col("grp") * (1 << 24) + F.col("bin")).alias("sequence_id"), F.col("at").alias("offset"))
        settled.append(place)
        if last:
            break
        todo, level = packed.where("loose").select("uid", "length"), level + 1
        count, before = todo.count(), count
    full = pieces.where(F.col("length") == size).select("doc_id", "piece", "start", "length", "ids_crc32",
                                                        F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    for i, place in enumerate(settled):
        settled[i] = place if not i else settled[i - 1].unionByName(place)
    if not settled:
        return full
    rest = pieces.where(F.col("length") < size).join(settled[-1], "uid").select(full.columns)
    return full.unionByName(rest)


@query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
