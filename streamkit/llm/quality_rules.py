"""Quality verdict of each document: base rules, then a hashed n-gram
log-likelihood ratio between two multinomials, one of the trusted texts and one
of the whole corpus.  DataFrame functions only.

Words and pairs of neighbouring words are hashed into ``BUCKETS`` counters.
The counts cover every document; their log ratio (add-one smoothed) is one
array of BUCKETS numbers, whatever the corpus size, and reaches the tasks as a
scalar subquery.  A text's score is the mean over its n-grams.  Its spread
shrinks with the text's length, so the threshold does too:
``mean - width * deviation * sqrt(1 + length0 / n)``, where mean and deviation
are those of the trusted texts' scores; every document meets the same rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streamkit.llm.registry import boxed, query, saved, table

BUCKETS = 1 << 14
WIDTH, LENGTH0 = 6.0, 60.0
TRUSTED = 20_000  # labelled texts that the target multinomial is fitted on: a fixed sample by hash of the id, so a broadcast of bounded size
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def words_of(text: Column) -> Column:
    """Words of a text without nulls."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def chars_without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def repeated_words(words: Column, window: int = 8) -> Column:
    """Words inside windows that occur twice or more in ``words``."""
    def covered(hashes: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            # neighbours in hash order share a hash exactly if the window repeats
            places = F.sort_array(F.transform(F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])), lambda x: x["i"]))
            return let(places, lambda p: F.aggregate(F.transform(p, lambda x, i: F.coalesce(F.least(F.get(p, i + 1) - x, F.lit(window)), F.lit(window))),
                                                     F.lit(0).cast("long"), lambda a, x: a + x))
        tagged = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        # F.get(s, -1) is null: such a comparison is null or decided by the other side
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(tagged, of_sorted))
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window)))
    return F.when(F.size(words) < window, F.lit(0).cast("long")).otherwise(let(hashes, covered))


def grams(words: Column) -> Column:
    """Bucket of each word and of each pair of neighbours (lower-cased)."""
    def both(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.pmod(F.xxhash64(x, F.get(h, i + 1)), F.lit(BUCKETS)).cast("int"))
        return F.concat(F.transform(h, lambda x: F.pmod(x, F.lit(BUCKETS)).cast("int")), F.slice(pairs, 1, F.greatest(F.size(h) - 1, F.lit(0))))
    return let(F.transform(words, lambda w: F.xxhash64(F.lower(w))), both)


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("words", words_of(F.col("text")))


def base_rules(rows: DataFrame) -> DataFrame:
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        chars_without(F.col("text"), SPACES).cast("long").alias("word_chars"),
        (F.char_length("text") - chars_without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        let(F.col("words"), repeated_words).cast("long").alias("n_repeat_words"),
        let(F.col("words"), grams).alias("grams"))


def model(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row: the log ratio of trusted to corpus frequency of each bucket."""
    marked = rows.select("doc_id", let(F.col("words"), grams).alias("grams")) \
        .join(F.broadcast(trusted.select("doc_id", F.lit(1).alias("good"))), "doc_id", "left")
    counts = marked.select(F.explode("grams").alias("g"), F.coalesce("good", F.lit(0)).alias("good")) \
        .groupBy("g").agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
    full = rows.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("g")).join(counts, "g", "left") \
        .select("g", (F.coalesce("raw", F.lit(0)) + 1).alias("raw"), (F.coalesce("target", F.lit(0)) + 1).alias("target"))
    sums = full.agg(F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"),
                    F.sort_array(F.collect_list(F.struct("g", "raw", "target"))).alias("all"))
    return sums.select(F.transform("all", lambda x: F.log(x["target"] / F.col("all_target")) - F.log(x["raw"] / F.col("all_raw"))).alias("w"))


def quality(docs: DataFrame, labels: DataFrame, *, width: float = WIDTH, fitted: int = TRUSTED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept and score.

    ``labels`` (doc_id, quality, toxic) names the trusted texts: quality 1 and
    not toxic.  The target multinomial is fitted on ``fitted`` of them at most,
    the threshold's mean and deviation are those of all.  base_failed: under 20 words, or over 30% of the words in 8-word
    windows that occur twice in the text.  kept: not base_failed, and the score
    is not under the threshold.  Without trusted texts only the base rules count.

    A null text is empty: no words, score null, base_failed.  Null ids are judged
    like others (they are never trusted); rows that repeat an id are judged each
    by itself; other columns are ignored; an empty table gives an empty one."""
    rows = texts(docs, id_col, text_col)
    good = saved(labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "quality-good")
    trusted = saved(good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fitted), "quality-trusted")
    weights = saved(model(rows, trusted), "quality-model")
    scored = saved(base_rules(rows).withColumn("w", weights.select("w").scalar()).withColumn("n", F.size("grams"))
                   .withColumn("score", F.when(F.col("n") > 0, F.aggregate("grams", F.lit(0.0), lambda a, g: a + F.get(F.col("w"), g)) / F.col("n")))
                   .drop("w", "grams"), "quality-scored")
    of = scored.where("n_words >= 20").select("doc_id", "score").join(good.hint("merge"), "doc_id", "left_semi") \
        .agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("deviation"))
    limit = saved(of, "quality-limit")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    floor = F.col("mean") - width * F.col("deviation") * F.sqrt(1 + LENGTH0 / F.greatest("n", F.lit(1)))
    return scored.withColumn("mean", limit.select("mean").scalar()).withColumn("deviation", limit.select("deviation").scalar()) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                (~failed & F.coalesce(F.col("score") >= floor, F.lit(True))).alias("kept"), "score", floor.alias("threshold"))


@query("op5_quality_llr")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the rules reject (an id goes if any of its
    rows is rejected); rows with a null id stay.  Columns of any name are kept; a
    null or empty text is rejected; an empty table gives an empty one."""
    bad = quality(docs, labels, id_col=id_col, text_col=text_col).where("NOT kept").select("doc_id").distinct()
    rows = boxed(docs, key=F.col(f"`{id_col}`").cast("long"))
    return rows.join(bad, rows["key"] == bad["doc_id"], "left_anti").select("row.*")
