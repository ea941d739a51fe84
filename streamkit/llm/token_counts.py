"""Token counts of whole texts.

Texts of up to ``CHUNK`` characters are counted at once.  Longer ones are
encoded in overlapping chunks with offsets.  Two neighbours are spliced at the
last place in their overlap where a pre-token ends in both: the pre-tokenizer
scans from left to right without looking back, so from a common pre-token
boundary on the right chunk's tokens are those of the whole text; up to it the
left chunk's are, as it lies well before that chunk's end (further than the
longest special token or look-ahead).  If there is no such place, the overlap
is widened, in the end to the whole rest."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamkit.llm.registry import query, table
from streamkit.llm.tokens import byte_level

CHUNK, OVERLAP, GUARD = 1 << 15, 256, 64  # characters


def _ends(encoding) -> dict[int, int]:
    """Offset at which a pre-token ends -> tokens up to there."""
    words, offsets = encoding.word_ids, encoding.offsets
    return {offsets[i][1]: i + 1 for i in range(len(words) - 1)
            if words[i] != words[i + 1] and offsets[i][1] == offsets[i + 1][0]}


def count_spliced(library, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, guard: int = GUARD) -> int:
    """Tokens of ``text``, encoded in overlapping chunks."""
    at, total, skip = 0, 0, 0  # chunk's start, tokens counted before, tokens of this chunk counted before
    left = library.encode(text[:chunk], add_special_tokens=False)
    while at + chunk < len(text):
        wide, size = overlap, chunk
        ends = {at + k: v for k, v in _ends(left).items() if v > skip}
        while True:
            begin = at + size - wide
            if begin <= at:  # the whole chunk overlaps: go on with a longer one
                size, wide = 2 * size, overlap
                left = library.encode(text[at:at + size], add_special_tokens=False)
                if at + size >= len(text):
                    return total + len(left.ids) - skip
                ends = {at + k: v for k, v in _ends(left).items() if v > skip}
                continue
            right = library.encode(text[begin:begin + chunk], add_special_tokens=False)
            other = _ends(right)
            common = [p for p in ends if begin < p < at + size - guard and p - begin in other]
            if common:
                break
            wide *= 4
        p = max(common)
        total += ends[p] - skip
        at, left, skip = begin, right, other[p - begin]
    return total + len(left.ids) - skip


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _count(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary.endswith(".model"):
            import sentencepiece
            import public_tokenizers
            model = sentencepiece.SentencePieceProcessor(model_file=vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
            count = lambda text: len(model.encode(text))
        else:
            pieces = byte_level(vocabulary)
            spliced = '"ByteLevel"' in pieces.library.pre_tokenizer.__getstate__().decode() if pieces.library.pre_tokenizer else False
            count = lambda text: (len(pieces.whole([text])[0]) // 4 if not spliced else len(pieces.ids([text])[0]) // 4
                                  if len(text) <= CHUNK else count_spliced(pieces.library, text))
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [t.as_py() or "" for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                                                  pa.array([count(t) for t in texts], pa.int64())], schema=_OUT)
    return run


def token_counts(docs: DataFrame, *, vocabulary: str = "byte_bpe_50k.json", limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (doc_id, n_bytes, n_tokens, over_limit), over the whole text and
    without special tokens added; the strings of special tokens in a text are
    handled as the library does by default.

    ``vocabulary`` is a path or public name: .json for tokenizers, .model for
    sentencepiece.  A null text is empty (0 bytes, 0 tokens); null and repeated
    ids are passed through; other columns are ignored; an empty table gives an
    empty one.  No row needs another: there is no shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_count(vocabulary), "doc_id long, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > limit)


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
