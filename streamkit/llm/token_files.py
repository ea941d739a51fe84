"""Token ids as Parquet files.

Documents stand in ascending id order over the files part-00000, part-00001
and so on, one row each with its ids as a list.  The ids are dictionary
encoded; id, place and counts are delta encoded, so that a row of them takes a
few bits.  Row groups have a bounded size and every page has an entry in the
file's column and offset index, so a reader that asks for some documents, some
span of the corpus, or counts alone reads those pages only.

``start`` is counted within a file.  A manifest beside the files has one row
per file: its documents and tokens, and the tokens in all files before."""

from __future__ import annotations

import functools
import gc
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.llm.registry import fresh_dir, query, table
from streamkit.llm.tokens import Pieces, byte_letters

ROW_GROUP, PAGE, PAGE_ROWS = 16 << 20, 256 << 10, 4096  # bytes, bytes, rows
FILE = 32 << 20  # text bytes of a file
SLAB = 1 << 20  # characters tokenized together
_STORED = "part int, doc_id long, start long, n_tokens long, ids array<int>"


class Words(Pieces):
    """Ids of a lower-casing tokenizer that drops white space and never looks
    across it: a text's ids are those of its words, which repeat and are kept in
    a table of bounded size.

    New words of plain letters, digits and punctuation are cut by the tokenizer's
    own pattern and go, many at a time, through a faster encoder of the same
    vocabulary: a mark behind each part stands for the vocabulary's word end, and
    first merges with the last byte before it.  Other words, and texts with a
    special token's string or characters on whose class engines disagree, go
    through the library."""

    WORDS, PASSING = 300_000, 60_000  # words kept for good: the first seen, so the frequent ones; and others that come and go
    MARK = "\x01"
    ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
    LATIN = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")  # letters, then punctuation but the apostrophe
    # the same of many words between blanks: words of letters, in which lower case is a matter of each character, and those with punctuation behind
    LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c != "\u0130")
    ALONE = re.compile(rf"(?<![^ ])[{LETTERS}]+(?![^ ])")
    TAILED = re.compile(rf"(?<![^ ])([{LETTERS}]+)([!-&(-/:-@\[-`{{-~]+)(?![^ ])")

    def __init__(self, path: str, spec: dict):
        super().__init__(path)
        self.ranked, self.final = self._ranked(spec)

    def _ranked(self, spec: dict):
        """The faster encoder and which ids end a word; none if the vocabulary's ids
        are not in order of its merges."""
        vocabulary, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocabulary.get(x + y) for x, y in merges]
        if spec["model"].get("end_of_word_suffix") != "</w>" or None in made or made != sorted(made) or made[0] < 512:
            return None, None
        letters = byte_letters()
        raw = lambda t: (bytes(letters[c] for c in t[:-4]) + b"\x01") if t.endswith("</w>") else bytes(letters[c] for c in t)
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {raw(t): i for t, i in vocabulary.items() if t not in special}
        import tiktoken
        final = np.zeros(max(vocabulary.values()) + 1, bool)
        final[[i for b, i in ranks.items() if b[-1:] == b"\x01" and len(b) > 1]] = True
        return tiktoken.Encoding("words", pat_str=r"[^\x01]*\x01", special_tokens={}, mergeable_ranks=ranks), final

    def _parts(self, word: str) -> list[str] | None:
        """The tokenizer's own cut of a word, in lower case; none if that is not certain here."""
        if word.isascii():
            return None if self.MARK in word else self.ASCII.findall(word.lower())
        found = self.LATIN.fullmatch(word)
        if found and found[1].isalpha() and max(found[1]) < "\u0250" and "\u0130" not in word:
            return [found[1].lower(), found[2]] if found[2] else [found[1].lower()]
        return None

    def _new(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not kept; each word once."""
        if self.ranked is None:
            return dict(zip(words, self.whole(words)))
        joined = " ".join(words)
        alone, tailed = self.ALONE.findall(joined), self.TAILED.findall(joined)
        out = self._ranked_ids(alone, alone, 1)
        out |= self._ranked_ids([a + b for a, b in tailed], list(itertools.chain.from_iterable(tailed)), 2)
        rest, parts, counts = [], [], []
        others = [w for w in words if w not in out]
        for word in others:
            cut = self._parts(word)
            if cut is None:
                rest.append(word)
            else:
                parts += cut
                counts.append(len(cut))
        if rest:
            out.update(zip(rest, self.whole(rest)))
        if counts:
            out |= self._ranked_ids([w for w in others if w not in out], parts, np.array(counts))
        return out

    def _ranked_ids(self, words: list[str], parts: list[str], counts: int | np.ndarray) -> dict[str, bytes]:
        """Ids by the faster encoder of words cut into ``parts``, so many each."""
        if not words:
            return {}
        ids = np.array(self.ranked.encode_ordinary(self.MARK.join(parts).lower() + self.MARK), "<u4")
        last = np.flatnonzero(self.final[ids])
        ends = (4 * (last[np.cumsum(np.broadcast_to(counts, len(words))) - 1] + 1)).tolist()
        blob = ids.tobytes()
        return {w: blob[lo:hi] for w, lo, hi in zip(words, [0, *ends], ends)}

    def ids(self, texts: list[str]) -> list[bytes]:
        collects = gc.isenabled()
        gc.disable()  # millions of words and no cycle among them: a collection would only walk over them
        try:
            return self._ids(texts)
        finally:
            if collects:
                gc.enable()

    def _ids(self, texts: list[str]) -> list[bytes]:
        if len(self.kept) > self.WORDS + self.PASSING:
            for w in list(itertools.islice(self.kept, self.WORDS, None)):
                del self.kept[w]
        split = [t.split() if self.plain(t) else None for t in texts]
        new = set().union(*(words for words in split if words)).difference(self.kept)
        if new:
            self.kept.update(self._new(list(new)))
        known = self.kept.__getitem__
        return [self.whole([text])[0] if words is None else b"".join(map(known, words)) for text, words in zip(texts, split)]


@functools.lru_cache(maxsize=2)
def encoder(name: str) -> Pieces:
    """This worker's cache for a vocabulary: by word if its pre-tokenizer drops
    white space after a normalizer that only makes blanks of it, by piece for
    byte-level ones, else no cache."""
    import json
    import public_tokenizers
    path = name if "/" in name else public_tokenizers.path(name)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [spec["normalizer"]] if spec.get("normalizer") else [])]
    if steps[0].get("type") == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and r"[^\s" in steps[0]["pattern"].get("Regex", "") \
            and set(kinds) <= {"NFC", "Replace", "Lowercase"}:
        return Words(path, spec)
    out = Pieces(path)
    if steps[0].get("type") != "ByteLevel" or kinds:
        out.ids = out.whole
    return out


def _encode(vocabulary: str, end_id: int):
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, start = encoder(vocabulary), 0
        for batch in batches:
            sizes = pa.compute.fill_null(pa.compute.utf8_length(batch.column(2)), 0).to_pylist()
            at = 0
            while at < batch.num_rows:
                lo, total = at, 0
                while at < batch.num_rows and (at == lo or total + sizes[at] <= SLAB):
                    total += sizes[at]
                    at += 1
                ids = [x + end for x in tool.ids([t or "" for t in batch.column(2).slice(lo, at - lo).to_pylist()])]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                ends = np.cumsum(n)
                lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends])), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, at - lo), batch.column(1).slice(lo, at - lo), pa.array(start + ends - n), pa.array(n),
                                                  lists.cast(pa.list_(pa.int32()))], names=["part", "doc_id", "start", "n_tokens", "ids"])
                start += int(n.sum())
    return run


def write_tokens(docs: DataFrame, path: str | None = None, *, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                 file_bytes: int = FILE, row_group: int = ROW_GROUP, page: int = PAGE, page_rows: int = PAGE_ROWS) -> str:
    """Writes the ids of every text (special tokens' strings as the library takes
    them by default, none added) and ``end_id`` to ``path`` (a fresh folder if
    none is given) and returns it.

    Rows stand in ascending order of id, null ids first; rows that repeat an id
    in a fixed order by their text.  A null or empty text is the end id alone;
    other columns are ignored; an empty table gives an empty file."""
    spark = docs.sparkSession
    path = path or fresh_dir(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    files = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // file_bytes))
    order = [F.col("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]  # a repeated id is spread too
    rows = rows.select("*", order[1].alias("_hash"), order[2].alias("_row")).repartitionByRange(files, "doc_id", "_hash", "_row") \
        .sortWithinPartitions("doc_id", "_hash", "_row").select(F.spark_partition_id().alias("part"), "doc_id", "text")
    rows.mapInArrow(_encode(vocabulary, end_id), _STORED).write \
        .option("parquet.block.size", row_group).option("parquet.page.size", page).option("parquet.page.row.count.limit", page_rows) \
        .option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false").option("parquet.enable.dictionary#ids.list.element", "true") \
        .option("compression", "zstd").parquet(f"{path}/files")
    sums = read_tokens(spark, path).groupBy("part").agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"),
                                                        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).collect()  # a row per file
    total, manifest = 0, []
    for r in sorted(sums, key=lambda r: r.part):
        manifest.append((r.part, r.documents, r.tokens, total, r.first_id, r.last_id))
        total += r.tokens
    spark.createDataFrame(manifest, "part int, documents long, tokens long, base long, first_id long, last_id long").coalesce(1).write.parquet(f"{path}/manifest")
    return path


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows as stored: (part, doc_id, start, n_tokens, ids); ``start`` is
    within the part.  Filters and selected columns reach the files' indexes."""
    return spark.read.schema(_STORED).parquet(f"{path}/files")


def read_documents(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) or those of them that are named, with
    ``start`` counted over all files.  The manifest (a row per file) is broadcast."""
    bases = spark.read.parquet(f"{path}/manifest").select("part", "base")
    rows = read_tokens(spark, path).join(F.broadcast(bases), "part").withColumn("start", F.col("start") + F.col("base"))
    return rows.select(*(columns or ("doc_id", "start", "n_tokens", "ids")))


def read_span(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """(doc_id, start, ids) of the corpus's tokens first to last - 1: documents
    that reach into the span, cut to it.  Only files that the manifest names are
    read, of those only pages that their indexes name."""
    files = spark.read.parquet(f"{path}/manifest").where((F.col("base") < last) & (F.col("base") + F.col("tokens") > first)).collect()  # a row per file
    hit, base = F.lit(False), F.lit(0).cast("long")
    for r in files:
        hit = hit | ((F.col("part") == r.part) & (F.col("start") < last - r.base) & (F.col("start") + F.col("n_tokens") > first - r.base))
        base = F.when(F.col("part") == r.part, F.lit(r.base).cast("long")).otherwise(base)
    start = F.col("start") + base
    skip = F.greatest(F.lit(0), F.lit(first) - start)
    return read_tokens(spark, path).where(hit).select("doc_id", (start + skip).alias("start"),
                                                      F.slice("ids", (skip + 1).cast("int"), (F.least(F.col("n_tokens"), F.lit(last) - start) - skip).cast("int")).alias("ids"))


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        off, ids = np.asarray(lists.offsets), np.asarray(lists.values, dtype="<u4")
        crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


@query("op12_token_files")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_tokens(table(spark, sf_dir, "documents"))
    return read_documents(spark, path).mapInArrow(_checksums, "doc_id long, start long, n_tokens long, ids_crc32 long")
