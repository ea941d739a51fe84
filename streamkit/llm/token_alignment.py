"""Alignment of two tokenizers' tokens over a corpus, with external counting.

A text's tokens under a byte-level BPE (A) and a sentencepiece model (B) cover
the same bytes.  Offsets where both end cut them into groups; two tokens whose
byte ranges overlap are linked.  How often each pair of ids is linked in the
whole corpus is counted outside memory:

1. Each batch of documents emits its pair-document records (B id, A id,
   document, links), dealt by a radix of the B id.  A batch's records of one
   radix are a run: sorted side-major (B id, then A id), in zstd blocks.
2. The runs of a radix are dealt into slices of bounded size.  A slice's runs
   go through a k-way heap merge, block by block, that counts each pair; the
   counts of the slices are runs again and are merged the same way, a bounded
   number at a time.  In the last merge of a radix all pairs of a B id are next
   to each other, which gives its highest count.
3. The final pairs of a radix meet each slice of its records; in the shared
   order the counts are looked up and stream back as one row of sums per run,
   which are added up per batch of documents.

So a pair that all documents hold is spread over as many slices as its radix
has; only counts of distinct pairs, at most as many as the vocabularies allow,
meet in one task.  Runs and counts lie as tables in the shared folder."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
from collections import namedtuple
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.llm.registry import query, saved, table
from streamkit.llm.tokens import ODD, PIECE, WHITE, byte_letters

RADIX = 32  # classes of B ids
SLICE = 4_000_000  # records merged in one task
FAN = 64  # count runs merged in one task
BLOCK = 8192  # records of a zstd block
DOCS, CHARS = 4096, 1 << 21  # of a batch
KEEP, PASSING = 300_000, 150_000  # chunks kept for good (the first seen: the frequent ones), and others that come and go
ID_BITS, DOC_BITS = 20, 17

SPACE_PIECE = "▁"
Alignment = namedtuple("Alignment", "documents pairs")


class Aligner:
    """Tokens, groups and links of texts.  A text is cut before each run of
    white space that follows other text; such chunks have the ids they have in
    context (tokens.py says why for A; for B no piece holds white space behind
    another character, but for those in ``unsafe``).  Chunks repeat, so what is
    known of them is kept in a table of bounded size; new ones are aligned many
    at a time."""

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        place = lambda name: name if "/" in name else public_tokenizers.path(name)
        self.a = Tokenizer.from_file(place(a))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=place(b))
        letters = byte_letters()
        self.a_bytes = [bytes(letters[c] for c in t) if (t := self.a.id_to_token(i) or "") and all(c in letters for c in t) else t.encode()
                        for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        else p.replace(SPACE_PIECE, " ").encode() for i, p in enumerate(pieces)]
        assert max(len(self.a_bytes), len(pieces)) <= 1 << ID_BITS
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.ranked = self._ranked(place(a))
        # each id as text, followed by what can stand behind it
        self.written = [f"{i}{mark}" for i in range(max(len(self.a_bytes), len(pieces))) for mark in (",", "|", ";", "")]
        held = "".join(p[1:].lstrip(SPACE_PIECE) if p[0] == SPACE_PIECE else p[1:] for p in pieces)
        self.unsafe = [c for c in WHITE if c != " " and c in held] + [SPACE_PIECE] * (SPACE_PIECE in held)
        self.blank = self.b.piece_to_id(SPACE_PIECE)
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.stats = np.zeros((1 << 12, 4), np.int64)  # tokens of A, of B, groups, links
        self.bad: set[int] = set()  # entries whose tokens' bytes are not the chunk's
        self.off = np.zeros((1 << 12) + 1, np.int64)
        self.pairs = np.zeros(1 << 14, np.int64)

    def _ranked(self, path: str):
        """A faster encoder of the same vocabulary, if its ids are in order of its
        merges (then the lowest id is the first merge) and it splits by the usual pattern."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocabulary.get(x + y) for x, y in merges]
        plain = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and spec["pre_tokenizer"]["use_regex"] and not spec["pre_tokenizer"]["add_prefix_space"]
        special = {t["content"] for t in spec["added_tokens"]}
        if not plain or None in made or made != sorted(made) or len(vocabulary.keys() - special) != 256 + len(made) or made[0] < 256:
            return None
        import tiktoken
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks={self.a_bytes[i]: i for t, i in vocabulary.items() if t not in special})

    def _room(self, entries: int, links: int) -> None:
        while len(self.groups) + entries >= len(self.stats):
            self.stats = np.concatenate([self.stats, np.zeros_like(self.stats)])
            self.off = np.concatenate([self.off, np.zeros(len(self.stats) + 1 - len(self.off), np.int64)])
        while int(self.off[len(self.groups)]) + links > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])

    def _add(self, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> range:
        """New entries for chunks of ``sizes`` bytes whose tokens, one chunk after
        the other, are ``a`` and ``b`` and have the chunks' bytes."""
        first, n = len(self.groups), len(sizes)
        end_a, end_b, end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), np.cumsum(sizes)
        # between two ends of any kind lies the overlap of one token of each: a link
        cuts = np.union1d(end_a, end_b)
        link = b[np.searchsorted(end_b, cuts)] << ID_BITS | a[np.searchsorted(end_a, cuts)]
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        per = np.stack([np.diff(np.searchsorted(x, end, "right"), prepend=0) for x in (end_a, end_b, common, cuts)], axis=1)
        # tokens in the order in which they are written: by group, A before B
        group = np.concatenate([np.searchsorted(common, end_a), np.searchsorted(common, end_b)])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(group * 2 + side, kind="stable")
        at = (group * 2 + side)[order]
        last = np.append(at[1:] != at[:-1], True)
        chunk_end = np.cumsum(per[:, 0] + per[:, 1]) - 1
        mark = np.where(last, np.where(at % 2 == 0, 1, 2), 0)
        mark[chunk_end] = 3
        text = list(map(self.written.__getitem__, (np.concatenate([a, b])[order] * 4 + mark).tolist()))
        self._room(n, len(link))
        base = int(self.off[first])
        self.pairs[base:base + len(link)] = link
        self.stats[first:first + n] = per
        self.off[first + 1:first + n + 1] = base + np.cumsum(per[:, 3])
        lo = 0
        for hi in (chunk_end + 1).tolist():
            self.groups.append("".join(text[lo:hi]))
            lo = hi
        return range(first, first + n)

    def _new(self, a: list[list[int]], b: list[list[int]], raw: list[bytes]) -> list[int]:
        """Entries of texts with these tokens; bad ones where the bytes differ."""
        ok = [bool(r) and b"".join([self.a_bytes[i] for i in x]) == r == b"".join([self.b_bytes[i] for i in y]) for x, y, r in zip(a, b, raw)]
        good = [k for k, v in enumerate(ok) if v]
        out = [-1] * len(raw)
        if good:
            flat = lambda lists: np.array([i for k in good for i in lists[k]], np.int64)
            for k, v in zip(good, self._add(flat(a), flat(b), np.array([len(raw[k]) for k in good], np.int64))):
                out[k] = v
        for k, v in enumerate(ok):
            if not v:
                self._room(1, 0)
                out[k] = i = len(self.groups)
                self.stats[i], self.off[i + 1] = 0, self.off[i]
                self.groups.append("")
                self.bad.add(i)
        return out

    def _chunks(self, chunks: list[str]) -> list[int]:
        ids_b = self.b.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        ids_b = [[self.blank] if c == " " else b if c[0] == " " else b[1:] for c, b in zip(chunks, ids_b)]
        if self.ranked is not None and not any(c.isspace() for c in chunks):
            # one text of all chunks: each is cut off by the white space before it
            a, b = np.array(self.ranked.encode_ordinary("".join(chunks)), np.int64), np.array([i for x in ids_b for i in x], np.int64)
            sizes = np.array([len(c) if c.isascii() else len(c.encode()) for c in chunks], np.int64)
            raw, end = "".join(chunks).encode(), np.cumsum(sizes)
            if b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw == b"".join(map(self.b_bytes.__getitem__, b.tolist())) \
                    and np.isin(end, np.cumsum(self.a_size[a])).all() and np.isin(end, np.cumsum(self.b_size[b])).all():
                return list(self._add(a, b, sizes))
        return self._new([e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)], ids_b, [c.encode() for c in chunks])

    def _whole(self, text: str) -> int:
        return self._new([self.a.encode(" " + text, add_special_tokens=False).ids], [self.b.encode(text)], [(" " + text).encode()])[0]

    def shrink(self) -> None:
        """Forget what came and went; entries of an earlier batch are then void."""
        if len(self.groups) > KEEP + PASSING:
            del self.groups[KEEP:]
            self.bad = {v for v in self.bad if v < KEEP}
            self.index = {k: v for k, v in self.index.items() if v < KEEP}

    def entries(self, texts: list[str | None]) -> list[list[int]]:
        """The entries that make up each text's alignment; none if it has no tokens."""
        cut = [PIECE.findall(" " + t) if t and not ODD.search(t) and not any(c in t for c in self.unsafe) else None for t in texts]
        new = set().union(*(chunks for chunks in cut if chunks)).difference(self.index)
        blank = [c for c in new if c.isspace()]
        for some in (blank, [c for c in new if not c.isspace()]):
            for lo in range(0, len(some), 20_000):
                part = some[lo:lo + 20_000]
                self.index.update(zip(part, self._chunks(part)))
        out = []
        for text, chunks in zip(texts, cut):
            at = [] if not text else [self._whole(text)] if chunks is None else list(map(self.index.__getitem__, chunks))
            if at and self.bad and not self.bad.isdisjoint(at):
                at = [self._whole(text)]
            out.append([] if at and at[0] in self.bad else at)
        return out

    def text_groups(self, entries: list[int]) -> str:
        return ";".join(map(self.groups.__getitem__, entries))

    def records(self, docs: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair, document, links) sorted by radix, B id, A id and document."""
        sizes = np.array([len(d) for d in docs], np.int64)
        entry = np.concatenate([np.array(d, np.int64) for d in docs]) if sizes.sum() else np.zeros(0, np.int64)
        key, times = np.unique(np.repeat(np.arange(len(docs)), sizes) << 32 | entry, return_counts=True)
        entry, doc = key & 0xFFFFFFFF, key >> 32
        n = self.off[entry + 1] - self.off[entry]
        at = np.arange(n.sum()) + np.repeat(self.off[entry] - (np.cumsum(n) - n), n)
        pair = self.pairs[at]
        radix = (pair >> ID_BITS) % RADIX
        code = ((radix << 2 * ID_BITS | pair) << DOC_BITS) | np.repeat(doc, n)
        order = np.argsort(code, kind="stable")
        code, links = code[order], np.repeat(times, n)[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        code = code[first]
        links = np.add.reduceat(links, first) if len(first) else links
        return code >> DOC_BITS, code & ((1 << DOC_BITS) - 1), links


@functools.lru_cache(maxsize=2)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def write_run(*columns: np.ndarray) -> bytes:
    """A run: zstd blocks of up to BLOCK records, each after its length and column widths."""
    out, pack = [], zstandard.ZstdCompressor(level=1)
    for lo in range(0, len(columns[0]), BLOCK):
        part = [c[lo:lo + BLOCK] for c in columns]
        first = int(part[0][0])
        part[0] = np.diff(part[0], prepend=first)
        part = [p.astype(np.min_scalar_type(int(p.max()))) for p in part]
        block = pack.compress(b"".join(p.tobytes() for p in part))
        head = [len(part) + 3, len(block), len(part[0]), *[p.itemsize for p in part]]
        out += [np.array(head, "<u4").tobytes(), first.to_bytes(8, "little"), block]
    return b"".join(out)


def read_run(run: bytes) -> Iterator[list[np.ndarray]]:
    """The blocks of a run in order, as columns of 64-bit integers."""
    at, unpack = 0, zstandard.ZstdDecompressor()
    while at < len(run):
        _, size, n, *widths = np.frombuffer(run, "<u4", int.from_bytes(run[at:at + 4], "little"), at).tolist()
        at += 4 * (3 + len(widths)) + 8
        raw, lo, out = unpack.decompress(run[at:at + size]), 0, []
        for width in widths:
            out.append(np.frombuffer(raw, f"<u{width}", n, lo).astype(np.int64))
            lo += width * n
        out[0] = np.cumsum(out[0]) + int.from_bytes(run[at - 8:at], "little")
        at += size
        yield out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal neighbours of sorted keys are added up."""
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def merge_counts(runs: Iterable[Iterator[tuple[np.ndarray, np.ndarray]]]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, their counts) of sorted runs of (keys, counts)
    blocks, one block of each run in memory.  The heap holds the last key of each
    run's block: up to the smallest of them all runs' records are at hand."""
    heads, heap, out, rest = {}, [], [], dict(enumerate(runs))

    def pull(i: int) -> None:
        block = next(rest[i], None)
        if block is not None:
            heads[i] = block
            heapq.heappush(heap, (int(block[0][-1]), i))

    for i in rest:
        pull(i)
    while heap:
        upto, parts = heap[0][0], []
        for i, (keys, counts) in list(heads.items()):
            n = int(np.searchsorted(keys, upto, "right"))
            if n:
                parts.append((keys[:n], counts[:n]))
                heads[i] = keys[n:], counts[n:]
        keys, counts = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(keys, kind="stable")
        out.append(_summed(keys[order], counts[order]))
        while heap and heap[0][0] == upto:
            i = heapq.heappop(heap)[1]
            del heads[i]
            pull(i)
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _summed(*(np.concatenate(c) for c in zip(*out)))


_BATCHES = pa.schema([("batch", pa.int64()), ("radix", pa.int32()), ("n", pa.int64()), ("run", pa.binary()), ("local", pa.int32()), ("doc_id", pa.int64()),
                      ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string())])
_BATCHES_DDL = "batch long, radix int, n long, run binary, local int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string"


def _batches(a: str, b: str, keep_groups: bool):
    def cut(texts: pa.Array) -> Iterator[tuple[int, int]]:
        sizes = pa.compute.fill_null(pa.compute.utf8_length(texts), 0).to_pylist()
        lo = total = 0
        for i, n in enumerate(sizes):
            if i > lo and (i - lo == DOCS or total + n > CHARS):
                yield lo, i
                lo, total = i, 0
            total += n
        if sizes:
            yield lo, len(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(a, b)
        for batch in batches:
            for lo, hi in cut(batch.column(2)):
                tool.shrink()
                uids, ids, texts = (batch.column(k).slice(lo, hi - lo).to_pylist() for k in range(3))
                docs, rows = tool.entries(texts), []
                for i, d in enumerate(docs):
                    groups = tool.text_groups(d)
                    sums = tool.stats[d].sum(axis=0).tolist() if d else [0, 0, 0, 0]
                    rows.append((uids[0], None, None, None, i, ids[i], *sums, hashlib.sha256(groups.encode()).hexdigest() if d else "", groups if keep_groups else None))
                pair, doc, links = tool.records(docs)
                radix = pair >> 2 * ID_BITS
                ends = np.searchsorted(radix, np.arange(RADIX + 1))
                for r in range(RADIX):
                    x, y = int(ends[r]), int(ends[r + 1])
                    if y > x:
                        rows.append((uids[0], r, y - x, write_run(pair[x:y], doc[x:y], links[x:y]), *[None] * 8))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BATCHES)], schema=_BATCHES)
    return run


def _count(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The runs of a slice, merged into one run of counts."""
    keys, counts = merge_counts(((b[0], b[-1]) for b in read_run(r)) for r in pdf["run"])
    return pd.DataFrame({"radix": [key[0]], "slice": [key[1]], "run": [write_run(keys, counts)]})


def _maxima(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The last merge of a radix: each pair's count, and whether it is its B id's highest."""
    keys, counts = merge_counts(((b[0], b[-1]) for b in read_run(r)) for r in pdf["run"])
    side = keys >> ID_BITS
    first = np.flatnonzero(np.diff(side, prepend=-1))
    best = np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(side))) == counts
    return pd.DataFrame({"radix": [key[0]], "run": [write_run(keys, counts, best.astype(np.int64))]})


def _return(key: tuple, runs: pd.DataFrame, final: pd.DataFrame) -> pd.DataFrame:
    """Each run of a slice beside the pairs' counts: its documents' sums."""
    keys, counts, best = (np.concatenate(c) for c in zip(*read_run(final["run"].iloc[0])))
    out = []
    for batch, run in zip(runs["batch"], runs["run"]):
        sums, size = np.zeros((2, 1 << DOC_BITS), np.int64), 0
        for pair, doc, links in read_run(run):
            at = np.searchsorted(keys, pair)
            size = max(size, int(doc.max()) + 1)
            np.add.at(sums[0], doc, links * best[at])
            np.add.at(sums[1], doc, links * counts[at])
        out.append((batch, zstandard.compress(sums[:, :size].astype("<i8").tobytes(), 1)))
    return pd.DataFrame(out, columns=["batch", "sums"])


def _documents(docs: pa.Table, sums: pa.Table) -> pa.Table:
    """The documents of a batch with the sums of all its runs."""
    total = np.zeros((2, docs.num_rows), np.int64)
    for blob in sums["sums"]:
        one = np.frombuffer(zstandard.decompress(blob.as_py()), "<i8").reshape(2, -1)
        total[:, :one.shape[1]] += one
    at = docs["local"].to_numpy()
    return docs.drop_columns(["batch", "local"]).append_column("n_best", pa.array(total[0][at])).append_column("count_sum", pa.array(total[1][at]))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    low = (1 << ID_BITS) - 1
    for batch in batches:
        for run in batch.column(0):
            for keys, counts, best in read_run(run.as_py()):
                yield pa.RecordBatch.from_arrays([pa.array(keys >> ID_BITS & low), pa.array(keys & low), pa.array(counts), pa.array(best == 1)],
                                                 names=["b_id", "a_id", "count", "best"])


def align(docs: DataFrame, *, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text",
          keep_groups: bool = True, slice_records: int = SLICE, fan: int = FAN) -> Alignment:
    """Aligns A's tokens of space + text with B's tokens of the text, of which
    special tokens' strings are plain text.

    ``documents``: per row of ``docs`` (doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups_sha256, groups): tokens, groups and links; the links
    whose pair's count is the corpus-wide highest of their B id, ties included;
    the counts added up over the links; the groups as ``a1,a2|b1;a3|b2`` (null
    unless ``keep_groups``) and their SHA-256.  ``pairs``: (b_id, a_id, count,
    best) of all linked ids.

    A null or empty text, and one whose tokens' bytes are not space + text (it
    holds U+2581, say), has zeros, an empty digest and no pairs.  Null and
    repeated ids are documents of their own; other columns are ignored; an empty
    table gives empty ones."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    held = saved(rows.mapInArrow(_batches(a, b, keep_groups), _BATCHES_DDL), "align-batches")
    sizes = {r.radix: r.n for r in held.where("radix IS NOT NULL").groupBy("radix").agg(F.sum("n").alias("n")).collect()}  # RADIX rows at most
    slices = {r: -(-n // slice_records) for r, n in sizes.items()}
    many = F.element_at(F.create_map(*[F.lit(x) for r, n in slices.items() for x in (r, n)]), F.col("radix")) if slices else F.lit(1)
    runs = held.where("radix IS NOT NULL").select("batch", "radix", F.pmod(F.xxhash64("batch"), many).cast("int").alias("slice"), "run")
    counts, left = saved(runs.groupBy("radix", "slice").applyInPandas(_count, "radix int, slice int, run binary"), "align-counts"), max(slices.values(), default=0)
    while left > fan:
        left = -(-left // fan)
        counts = saved(counts.groupBy("radix", F.floor(F.col("slice") / fan).cast("int").alias("slice"))
                       .applyInPandas(_count, "radix int, slice int, run binary"), "align-counts")
    final = saved(counts.groupBy("radix").applyInPandas(_maxima, "radix int, run binary"), "align-pairs")
    spread = final.select("radix", F.explode(F.sequence(F.lit(0), many.cast("int") - 1)).alias("slice"), "run")
    sums = runs.groupBy("radix", "slice").cogroup(spread.groupBy("radix", "slice")).applyInPandas(_return, "batch long, sums binary")
    texts = held.where("radix IS NULL").select("batch", "local", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")
    out = texts.groupBy("batch").cogroup(sums.groupBy("batch")).applyInArrow(
        _documents, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, n_best long, count_sum long")
    return Alignment(out, final.select("run").mapInArrow(_pairs, "b_id long, a_id long, count long, best boolean"))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), keep_groups=False).documents.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
