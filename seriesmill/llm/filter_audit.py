"""Audit of how filters interact: what every order of them removes, at which step, and for which filter alone.

A document is its mask of failed filters. In the min-plus algebra the matrix of masks (0 where a
filter fails, infinity elsewhere) times the matrix of positions (place of a filter in an order, the
inverse of the permutation) gives the step that removes a mask in an order: the smallest place among
its failed filters. Weighted counts are scattered by that step. Documents are reduced to masks and
counted before; only counts per part and mask meet the matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.sources.tables import materialise

_SPLIT = r"[\x20\x09-\x0D]+"
#: Masks are tables of 2**n rows and orders of n! columns.
MAX_FILTERS = 6
NEVER = np.iinfo(np.int64).max // 2


def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The matrix product with sums for products and minima for sums."""
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def removal_steps(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(orders, steps): all permutations of n filters, and the step (from 1) that removes each mask in each order.

    A mask without failures is never removed: its step is n + 1.
    """
    orders = np.array(list(permutations(range(n))), np.int64)
    places = np.argsort(orders, axis=1).T + 1
    fails = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    return orders, np.minimum(min_plus(np.where(fails == 1, 0, NEVER), places), n + 1)


def text_filter_bits(text: Column) -> Column:
    """Bits of the four filters that a text fails by itself.

    1: under 50 words; 2: distinct words under 65% of the words; 4: capital ASCII letters over 5% of
    the code points; 8: any of #$%&*|.
    """

    def of_words(words: Column) -> Column:
        return F.when(F.size(words) < 50, 1).otherwise(0) + F.when(100 * F.size(F.array_distinct(words)) < 65 * F.size(words), 2).otherwise(0)

    words = F.filter(F.split(text, _SPLIT), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return (
        F.transform(F.array(words), of_words)[0]
        + F.when(100 * capitals.cast("bigint") > 5 * F.length(text), 4).otherwise(0)
        + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)
    )


def _spread_key(id: Column, other: Column) -> Column:
    """``id`` as a join key; rows without one get a key of their text, so that they do not meet in one task."""
    return F.coalesce(F.concat(F.lit("id:"), id.cast("string")), F.concat(F.lit("none:"), F.hex(other)))


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, mask, n, good, toxic: rows of ``docs`` by part and failed filters, bit 16 for repeated texts.

    A text is repeated if a row with a smaller doc_id has the same text anywhere in the table; a row
    without doc_id is neither smaller nor larger than any, and has no labels. Null texts are empty, a
    null part is the empty string. Rows are counted each, repeated ones too. If a doc_id has several
    labels, one 1 is enough. Texts are compared by SHA-256. A text that many rows share, or a null
    doc_id, reaches no task as more than one row per task, part and set of failures.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        text_filter_bits(text).alias("bits"),
    )
    rows = materialise(rows.groupBy("doc_id", "digest", "part", "bits").agg(F.count("*").alias("n")), "masks")
    firsts = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    firsts = firsts.select(F.col("doc_id").alias("first_"), F.col("digest").alias("of_"), F.lit(True).alias("is_first"))
    found = rows.join(firsts, (F.col("digest") == F.col("of_")) & F.col("doc_id").eqNullSafe(F.col("first_")), "left")
    repeated = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    found = found.select(_spread_key(F.col("doc_id"), F.col("digest")).alias("key_"), "part", "n", (F.col("bits") + F.when(repeated, 16).otherwise(0)).alias("mask"))

    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good_"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic_"))
    marks = marks.select(F.concat(F.lit("id:"), F.col("doc_id").cast("string")).alias("key_"), "good_", "toxic_")
    marked = found.join(marks, "key_", "left")

    def weight(mark: str) -> Column:
        return F.sum(F.when(F.col(mark) == 1, F.col("n")).otherwise(0))

    return marked.groupBy("part", "mask").agg(F.sum("n").alias("n"), weight("good_").alias("good"), weight("toxic_").alias("toxic"))


def interaction_audit(counts: DataFrame, filters: str) -> DataFrame:
    """One row per part, order of ``filters`` and step, with what the filter of that step does there.

    ``counts`` has part, mask (bit k: fails the k-th filter), n, good and toxic. kept is what is left
    after the step, removed what it takes, redundant what it would take were it not gone before,
    unique_fails what fails this filter only, good_lost and toxic_lost the labelled among the removed,
    and shapley what the filter removes in all orders together. Nothing in, nothing out.
    """
    n = len(filters)
    if not 1 <= n <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters")
    schema = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
    # At most 2**n rows of a part.
    gathered = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, steps = removal_steps(n)
        names = ["".join(filters[f] for f in order) for order in orders]
        all_orders, places = np.arange(len(orders)), np.arange(1, n + 1)
        for batch in batches:
            for first in range(0, len(batch), 64):
                some = batch.slice(first, 64)
                listed, parts = some.column(1), len(some)
                flat, of = listed.flatten(), np.repeat(np.arange(parts), listed.value_lengths().to_numpy())
                weights = np.zeros((parts, 1 << n, 3), np.int64)
                values = np.stack([flat.field(k).to_numpy() for k in (1, 2, 3)], axis=1)
                np.add.at(weights, (of, flat.field(0).to_numpy()), values)

                removed = np.zeros((parts, len(orders), n + 2, 3), np.int64)
                failing = np.zeros((parts, n), np.int64)
                for mask in range(1 << n):
                    removed[:, all_orders, steps[mask]] += weights[:, mask, None]
                    for f in range(n):
                        if mask >> f & 1:
                            failing[:, f] += weights[:, mask, 0]
                by_step = removed[:, :, 1 : n + 1]
                kept = weights[:, :, 0].sum(axis=1)[:, None, None] - np.cumsum(by_step[..., 0], axis=2)
                # What fails a filter is gone before its step, goes at it, or neither: none stays behind it.
                redundant = failing[:, orders] - by_step[..., 0]
                alone = weights[:, 1 << np.arange(n), 0][:, orders]
                total = np.zeros((parts, n), np.int64)
                for f in range(n):
                    total[:, f] = by_step[..., 0][:, orders == f].sum(axis=1)
                each = len(orders) * n
                columns = [
                    some.column(0).take(pa.array(np.repeat(np.arange(parts), each))),
                    pa.array(np.tile(np.repeat(names, n), parts)),
                    pa.array(np.tile(places, parts * len(orders)).astype(np.int32)),
                ]
                counted = (kept, by_step[..., 0], redundant, alone, by_step[..., 1], by_step[..., 2], total[:, orders])
                columns += [pa.array(x.reshape(-1)) for x in counted]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    return gathered.mapInArrow(audit, schema)


def text_filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """``interaction_audit`` of the filters A to E (``mask_counts``) over every row of ``docs``."""
    return interaction_audit(mask_counts(docs, labels, part), "ABCDE")
