"""Quality rules: counts within a text, and lines that too many documents of one host share.

Lines are normalised and hashed, and the distinct documents of each host that hold a line are counted.
Lines above the limit are removed, and a document that has too little left is rejected. All of
it is DataFrame work: words and windows are arrays of the row, and only line hashes are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.sources.tables import materialise

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
_SPLIT = r"[\x20\x09-\x0D]+"
WINDOW = 8
#: A line goes where more than this many documents of the host have it, however large the host is.
MIN_DOCS = 5
#: A document is rejected if it loses lines and keeps fewer words, or a smaller share of them.
MIN_WORDS, MIN_SHARE = 20, 0.3


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPLIT), lambda w: w != "")


def _without(text: Column, characters: str) -> Column:
    """Number of characters of ``text`` that are not among ``characters``."""
    return F.length(F.translate(text, characters, ""))


def _window_hashes(words: Column) -> Column:
    """A hash for each run of WINDOW words: pairs, pairs of pairs, and pairs of those."""

    def joined(step: int):
        return lambda h: F.when(
            F.size(h) > step,
            F.zip_with(F.slice(h, 1, F.size(h) - step), F.slice(h, step + 1, F.size(h) - step), lambda a, b: F.xxhash64(a, b)),
        ).otherwise(F.array().cast("array<bigint>"))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    for step in (1, 2, 4):
        hashes = _let(hashes, joined(step))
    return hashes


def _covered(hashes: Column) -> Column:
    """Number of words inside windows whose hash occurs twice or more."""

    def repeated(sorted_pairs: Column) -> Column:
        """Places of windows that equal a neighbour in the sorted array."""
        same = F.filter(
            sorted_pairs,
            lambda p, i: (p["h"] == F.get(sorted_pairs, i - 1)["h"]) | (p["h"] == F.get(sorted_pairs, i + 1)["h"]),
        )
        return F.sort_array(F.transform(same, lambda p: p["at"]))

    def count(places: Column) -> Column:
        # Each window adds what reaches beyond the one before it.
        added = F.transform(places, lambda at, i: F.when(i == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), at - F.get(places, i - 1))))
        return F.aggregate(added, F.lit(0).cast("bigint"), lambda total, n: total + n)

    def detail(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return _let(pairs, lambda s: _let(repeated(s), count))

    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(detail(h)))


def _normalised(line: Column) -> Column:
    """A line as it is compared: trimmed, white space collapsed, lower case."""
    return F.trim(F.lower(F.regexp_replace(line, _SPLIT, " ")))


def text_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and base_failed, in place of columns of these names."""
    docs = docs.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "counts_")
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: _without(line, _SPACES) > 0)
    counted = docs.select(
        "*",
        _let(_words(text), lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), _covered(_window_hashes(w)).alias("n_repeat_words"))).alias("counts_"),
        _without(text, _SPACES).cast("bigint").alias("word_chars"),
        (F.length(text) - _without(text, _SYMBOLS)).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    )
    counted = counted.select(*docs.columns, "counts_.n_words", "word_chars", "n_symbols", "n_dup_lines", "counts_.n_repeat_words")
    return counted.withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))


def line_frequency_verdicts(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, max_share: float = 0.0) -> DataFrame:
    """doc_id, the counts of ``text_counts``, n_lines_removed, n_words_left and kept for every row.

    A line is removed where more than ``min_docs`` of the distinct documents of its host hold it, and
    more than ``max_share`` of them if that is given: such a limit grows with the host. A document is kept unless it fails the base rules, or loses lines
    and is left with fewer than ``MIN_WORDS`` words or less than ``MIN_SHARE`` of them. A null text
    has no words; a null host is a host of its own; rows with a null doc_id count as one document.
    Repeated rows are returned each and count once.
    """
    own = docs.select("doc_id", F.col(host).alias("host_"), "text")
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: F.struct(F.xxhash64(_normalised(line)).alias("hash"), F.size(_words(line)).alias("words")))
    rows = text_counts(own).select(F.monotonically_increasing_id().alias("row_"), "*", F.filter(lines, lambda x: x["words"] > 0).alias("lines_")).drop("text")
    # Written once: row numbers stay, and the texts are split once.
    rows = materialise(rows, "line-hashes")
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    held = rows.select("host_", known.alias("doc_"), F.explode(F.array_distinct("lines_.hash")).alias("hash"))
    n_docs = held.distinct().groupBy("host_", "hash").agg(F.count("*").alias("n"))
    frequent = n_docs.where(F.col("n") > min_docs)
    if max_share > 0:
        sizes = rows.select("host_", known.alias("doc_")).distinct().groupBy("host_").agg(F.count("*").alias("host_docs")).withColumnRenamed("host_", "of_host_")
        frequent = frequent.join(sizes, F.col("host_").eqNullSafe(F.col("of_host_"))).where(F.col("n") > F.col("host_docs") * max_share)
    frequent = frequent.select(F.col("host_").alias("of_host_"), F.col("hash").alias("of_hash_"))
    occurrences = rows.select("row_", "host_", F.explode("lines_").alias("line")).select("row_", "host_", "line.hash", "line.words")
    removed = occurrences.join(frequent, F.col("host_").eqNullSafe(F.col("of_host_")) & (F.col("hash") == F.col("of_hash_")), "left_semi")
    removed = removed.groupBy(F.col("row_").alias("of_row_")).agg(F.count("*").alias("removed_"), F.sum("words").alias("gone_"))
    judged = rows.join(removed, F.col("row_") == F.col("of_row_"), "left").withColumn("n_lines_removed", F.coalesce("removed_", F.lit(0).cast("bigint")))
    judged = judged.withColumn("n_words_left", F.col("n_words") - F.coalesce("gone_", F.lit(0).cast("bigint")))
    depleted = (F.col("n_lines_removed") > 0) & ((F.col("n_words_left") < MIN_WORDS) | (F.col("n_words_left") < F.col("n_words") * MIN_SHARE))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~depleted).alias("kept"), "n_lines_removed", "n_words_left"
    )
