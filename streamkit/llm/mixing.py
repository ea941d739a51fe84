"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots of equally many words.  Slot i has the point
frac(i * golden ratio) (as integers); the source whose share of the
cumulative targets holds the point fills the slot.  Every run of slots is
therefore close to the targets.  A source's documents stand in a fixed
shuffled order (by hash) as one stream of words, and each of its slots takes
the next words of the stream, which starts again after its end.  A slot has
``SLOT`` words whatever the corpus size, so a small source gets as close to its
target as a large one, to a few slots.

Nothing is numbered by a window over a whole source or all slots: positions
are counts within a bounded bucket plus the sums of the buckets before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from streamkit.llm.registry import boxed, query, saved, table

WEIGHTS = (5, 2, 1)
MOST = 3  # times that a source's words may be taken
SLOT = 16  # words of a slot
BITS, STEP = 48, 0x9E3779B97F4B  # points of slots of fixed length: fine enough for a source of a few words among 10**14; 2**48 / golden ratio, odd
CELL = BITS - 12  # bits of a point below its cell; points and sources meet by cell

_WORDS = r"[\x20\x09-\x0D]+"


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, size, key); a stream is in order of ``key``, which spreads
    documents that share an id, or have none, by their texts."""
    text = F.btrim(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                       F.when(text == "", 0).otherwise(F.size(F.split(text, _WORDS))).cast("long").alias("size"), _key(id_col, text_col).alias("key"))


def _key(id_col: str, text_col: str) -> Column:
    return F.md5(F.concat_ws(" ", F.col(f"`{id_col}`").cast("long").cast("string"), F.md5(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: source_size, weight, target. Targets follow the weights, stop
    at ``most`` times the source's size, and what is above is shared again:
    all sources get level * weight, or their limit if that is less."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())  # one row per source
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    fill = W.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    full = W.partitionBy()
    per = per.withColumn("total", F.sum("source_size").over(full)).withColumn("all_weights", F.sum("weight").over(full)) \
        .withColumn("full", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most).withColumn("used", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    level = (F.col("total") - F.col("full")).cast("double") / (F.col("all_weights") - F.col("used"))
    per = per.withColumn("level", F.when(level * F.col("weight") <= F.col("source_size") * most, level))
    return per.withColumn("target", F.least(F.coalesce(F.max("level").over(full), F.lit(0.0)) * F.col("weight"), (F.col("source_size") * most).cast("double"))) \
        .select("source", "source_size", "total", "target")


def _same(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def _bounds(per: DataFrame, bits: int) -> DataFrame:
    """Each source's share [low, high) of the points."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    return per.withColumn("high", F.floor(F.sum("target").over(order.rowsBetween(W.unboundedPreceding, 0)) / F.greatest("total", F.lit(1)) * (1 << bits))) \
        .withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0)))


def _met(points: DataFrame, per: DataFrame, cell: int) -> DataFrame:
    """The source of each point, with the source's other columns."""
    cells = per.where("low < high").withColumn("cell", F.explode(F.sequence(F.shiftright("low", cell), F.shiftright(F.col("high") - 1, cell))))
    return points.withColumn("cell", F.shiftright("point", cell)).join(cells, "cell") \
        .where((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))


def mix(docs: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, slot: int = SLOT, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: (doc_id, size, source_size, target, taken, passes).

    ``size`` is the number of words; ``taken`` the words that the mix takes,
    repeats counted; ``passes`` how often it takes the document's first word.

    Sources in order of code points, null last, weigh ``weights``, repeating.
    A null or empty text has size 0 and nothing is taken.  Null ids and rows that
    repeat an id are documents of their own, in a fixed order by id and text;
    other columns are ignored; an empty table gives an empty one."""
    return _scheduled(saved(sized(docs, id_col, text_col, source_col), "mix-sizes"), weights, most, slot) \
        .select("doc_id", "size", "source_size", "target", "taken", "passes")


def _scheduled(sizes: DataFrame, weights: tuple[int, ...], most: int, slot: int) -> DataFrame:
    """``sizes`` with what the mix takes of each row.  A source's rows meet its
    totals by (source, bucket): those of a large source are spread over 4,096."""
    per = saved(_bounds(targets(sizes, weights, most), BITS), "mix-targets")
    n = -(-int(per.agg(F.max("total")).first()[0] or 0) // slot)
    # id * STEP modulo 2**BITS from 15 bits of the id at a time, which does not overflow
    point = F.lit(0).cast("long")
    for low in (0, 15, 30):
        digit = F.shiftright("id", low).bitwiseAND(F.lit((1 << 15) - 1))
        point = point + F.pmod(digit * F.lit((STEP << low) % (1 << BITS)), F.lit(1 << BITS))
    points = sizes.sparkSession.range(n).select(F.pmod(point, F.lit(1 << BITS)).alias("point"))
    filled = _met(points, per.select("source", "low", "high"), CELL).groupBy(F.col("source").alias("f_")).agg(F.count("*").alias("filled"))
    of = per.join(filled, _same("source", "f_"), "left") \
        .select(F.col("source").alias("o_"), "source_size", "target",
                F.least(F.coalesce("filled", F.lit(0)) * slot, F.col("source_size") * most).alias("words"))
    place = sizes.withColumn("bucket", F.substring("key", 1, 3))
    sums = place.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("base", F.sum("n").over(W.partitionBy("source").orderBy("bucket")) - F.col("n")).join(of, _same("source", "o_")) \
        .select(F.col("source").alias("s_"), F.col("bucket").alias("c_"), "base", "source_size", "target", "words")
    sums = saved(sums, "mix-buckets")
    run = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    rows = place.withColumn("upto", F.sum("size").over(run)).join(sums, _same("source", "s_") & (F.col("bucket") == F.col("c_"))) \
        .withColumn("begin", F.col("base") + F.col("upto") - F.col("size"))
    # every word of the stream is taken ``whole`` times, the first ``rest`` once more
    whole = F.when(F.col("size") > 0, F.floor(F.col("words") / F.greatest("source_size", F.lit(1)))).otherwise(0)
    rows = rows.withColumn("whole", whole).withColumn("rest", F.col("words") - F.col("whole") * F.col("source_size"))
    more = F.greatest(F.least(F.col("begin") + F.col("size"), F.col("rest")) - F.col("begin"), F.lit(0))
    return rows.select("doc_id", "size", "key", "source", "source_size", "target", (F.col("whole") * F.col("size") + more).cast("long").alias("taken"),
                       (F.col("whole") + (more > 0).cast("long")).cast("long").alias("passes"))


SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5(concat_ws(' ', doc_id::VARCHAR, md5(coalesce(text, '')))) AS key FROM documents),
a AS (SELECT source, sum(size)::BIGINT AS s, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS w FROM d GROUP BY source),
b AS (SELECT *, sum(s) OVER ()::BIGINT AS total, sum(w) OVER ()::BIGINT AS tw,
             coalesce(sum(s) OVER f, 0)::BIGINT * 3 AS full_, coalesce(sum(w) OVER f, 0)::BIGINT AS used FROM a
      WINDOW f AS (ORDER BY s / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - full_)::DOUBLE / (tw - used) AS lv FROM b),
t AS (SELECT source, s, total, least(coalesce(max(CASE WHEN lv * w <= s * 3 THEN lv END) OVER (), 0.0) * w, (s * 3)::DOUBLE) AS target FROM l),
p AS (SELECT *, floor(sum(target) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / greatest(total, 1) * {1 << BITS})::BIGINT AS high FROM t),
q AS (SELECT *, coalesce(lag(high) OVER (ORDER BY source NULLS LAST), 0) AS low FROM p),
i AS (SELECT ((id::HUGEINT * {STEP}) % {1 << BITS})::BIGINT AS point FROM range(0, (SELECT coalesce(ceil(max(total) / {SLOT}.0), 0)::BIGINT FROM q)) r(id)),
k AS (SELECT q.source, count(*) AS filled FROM i JOIN q ON point >= low AND point < high GROUP BY 1),
m AS (SELECT q.source, s, target, least(coalesce(filled, 0) * {SLOT}, s * {MOST}) AS words FROM q LEFT JOIN k ON k.source IS NOT DISTINCT FROM q.source),
o AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM d),
z AS (SELECT o.*, m.s, m.target, CASE WHEN size > 0 THEN words // greatest(s, 1) ELSE 0 END AS whole, words FROM o JOIN m ON m.source IS NOT DISTINCT FROM o.source),
x AS (SELECT *, greatest(least(pos + size, words - whole * s) - pos, 0) AS more FROM z)
SELECT doc_id, size, s AS source_size, target, (whole * size + more)::BIGINT AS taken, (whole + (more > 0)::BIGINT)::BIGINT AS passes FROM x
"""


@query("op9_mix_sources", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def mixed_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
               most: int = MOST, slot: int = SLOT) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its first word is
    taken (no text is cut; a null or empty text stays once).

    Columns of any name are kept.  Rows that are equal in id, text and source are
    taken as often as the one of them that is taken most; null ids and sources
    are values like others; an empty table gives an empty one."""
    sizes = saved(sized(docs, id_col, text_col, source_col), "mix-sizes")
    taken = _scheduled(sizes, weights, most, slot).groupBy("key", "source").agg(F.max(F.when(F.col("size") > 0, F.col("passes")).otherwise(1)).alias("passes"))
    rows = boxed(docs, key=_key(id_col, text_col), source=F.col(f"`{source_col}`").cast("string"))
    taken = taken.where("passes > 0").select(F.col("key").alias("k_"), F.col("source").alias("s_"), "passes")
    return rows.join(taken, (F.col("key") == F.col("k_")) & _same("source", "s_")) \
        .select("row", F.explode(F.sequence(F.lit(1), F.col("passes").cast("int"))).alias("pass")).select("row.*")
