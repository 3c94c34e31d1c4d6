"""Exact n-gram Jaccard join with grouped prefixes.

A document is the set of its word shingles, in one order for all documents: rare first. Two sets can
only reach the threshold if they share a shingle among their first few (their prefix). Documents with
the same prefix and the same size are one group, and groups that share a prefix shingle, at positions
and sizes that leave the threshold within reach, are candidates. Their members are then expanded and
verified on whole sets. Copies with equal sets are one representative throughout.

The order decides cost only, never the result. A shingle ranks by the estimated count of its rarest
word, taken over all documents: a passage that many documents share has no rare words, so it stands
last and stays out of their prefixes. The estimates are a table of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.components import link_lists, within_reach
from seriesmill.llm.spans import LOWER, SPACED, U, mix, parity_sketch, shingles, slices, span_hashes, word_spans
from seriesmill.sources.tables import discard, materialise

#: Counters of word frequencies, broadcast as one byte each.
COUNTERS = 1 << 20


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lower = LOWER[data]
    starts, ends, row = word_spans(lower, at, SPACED)
    return span_hashes(lower, starts, ends), row


def _frequency_classes(docs: DataFrame) -> np.ndarray:
    """For each counter, its word count over all documents as a class: four per power of two."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, data, at in slices(batch.column(0)):
                counts += np.bincount((_words(data, at)[0] % U(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["counter", "n"])

    per_task = docs.select("text").mapInArrow(count, "counter int, n bigint")
    level = F.floor(F.log2(F.sum("n").cast("double")) * 4).cast("int")
    total = per_task.groupBy("counter").agg(level.alias("level")).toArrow()  # at most COUNTERS rows
    classes = np.zeros(COUNTERS, np.uint8)
    classes[total["counter"].to_numpy()] = total["level"].to_numpy()
    return classes


def _row_sets(data: np.ndarray, at: np.ndarray, n: int, classes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows without repetition, and how many each row has.

    Rows in order; within a row by class, then hash, or by hash alone without classes.
    """
    words, row = _words(data, at)
    grams, of = shingles(words, row, len(at) - 1, n)
    if classes is None:
        order = np.lexsort((grams, of))
    else:
        word_class = classes[(words % U(COUNTERS)).astype(np.int64)]
        rarest = word_class[: max(0, len(words) - n + 1)].copy()
        for k in range(1, n):
            np.minimum(rarest, word_class[k : len(word_class) - n + 1 + k], out=rarest)
        inside = row[: len(rarest)] == row[n - 1 :] if len(rarest) else np.zeros(0, bool)
        # A text of fewer than n words has one shingle, whose class does not matter.
        level = np.zeros(len(grams), np.uint8)
        level[: int(inside.sum())] = rarest[inside]
        order = np.lexsort((grams, level, of))
    grams, of = grams[order], of[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
    return grams[new], np.bincount(of[new], minlength=len(at) - 1)


def _signatures(values: np.ndarray, counts: np.ndarray, salt: int) -> np.ndarray:
    """An order-free hash of each row's values; 0 for none."""
    sums = np.zeros(len(values) + 1, U)
    np.cumsum(mix(values ^ U(salt)), out=sums[1:])
    ends = np.cumsum(counts)
    return (sums[ends] - sums[ends - counts]).view(np.int64)


def _prefix_table(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, size, sig1, sig2 (of the set), prefix_sig, prefix (array) per row."""
    counters = docs.sparkSession.sparkContext.broadcast(_frequency_classes(docs))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, size bigint, sig1 bigint, sig2 bigint, prefix_sig bigint, prefix array<bigint>"

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, at in slices(batch.column(1)):
                grams, size = _row_sets(data, at, n, counters.value)
                length = np.where(size > 0, size - -(-percent * size // 100) + 1, 0)
                begin = np.cumsum(size) - size
                until = np.concatenate([[0], np.cumsum(length)])
                chosen = grams[np.repeat(begin - until[:-1], length) + np.arange(until[-1])]
                lists = pa.ListArray.from_arrays(pa.array(until.astype(np.int32)), pa.array(chosen.view(np.int64)))
                columns = [size, _signatures(grams, size, 1), _signatures(grams, size, 2), _signatures(chosen, length, 3)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(size)), *map(pa.array, columns), lists], ["doc_id", "size", "sig1", "sig2", "prefix_sig", "prefix"])

    return materialise(docs.select("doc_id", "text").mapInArrow(prefixes, schema), "prefixes")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """id, sketch, and the sorted shingle hashes as bytes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, at in slices(batch.column(1)):
                grams, size = _row_sets(data, at, n)
                until = np.concatenate([[0], np.cumsum(size)]) * 8
                packed = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(until.astype(np.int32).tobytes()), pa.py_buffer(grams.tobytes())])
                sketches = np.array([parity_sketch(x) for x in np.split(grams, np.cumsum(size)[:-1])], np.int64)
                places = pa.array(np.arange(len(size) + 1, dtype=np.int32) * sketches.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(size)), pa.ListArray.from_arrays(places, pa.array(sketches.ravel())), packed], ["id", "sketch", "grams"])

    return docs.select("doc_id", "text").mapInArrow(build, "id bigint, sketch array<bigint>, grams binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.concatenate([x, y])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                if 100 * shared >= percent * (len(x) + len(y) - shared):
                    kept.append(k)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    left, right = sets.select(F.col("id").alias("a"), F.col("grams").alias("x")), sets.select(F.col("id").alias("b"), F.col("grams").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(test, "a bigint, b bigint").distinct()


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles (distinct), component_id (smallest doc_id reachable by links) for every row.

    Words are runs without white space, A-Z lower-cased; a text of fewer than ``n`` words is one
    shingle. Two documents link where 100 * shared >= percent * union. A text without words, or null,
    has no shingle and is a component of its own. A row without doc_id links with nothing and has no
    component. Repeated rows are all returned; a doc_id with several texts stands for all of them.
    The result is a written table. doc_id must be a whole number; columns other than doc_id and text are not read.
    """
    table = _prefix_table(docs, n, percent)
    full = table.where("size > 0 AND doc_id IS NOT NULL")
    equal = materialise(full.groupBy("sig1", "sig2").agg(F.min("doc_id").alias("id")), "representatives")
    reps = full.select("sig1", "sig2", F.col("doc_id").alias("id"), "size", "prefix_sig", "prefix").join(equal, ["sig1", "sig2", "id"]).select("id", "size", "prefix_sig", "prefix")
    groups = reps.groupBy("prefix_sig", "size").agg(F.min("id").alias("group"), F.max("id").alias("last"))
    members = reps.join(groups, ["prefix_sig", "size"]).select("id", "size", "group", "last", "prefix_sig", F.when(F.col("id") == F.col("group"), F.col("prefix")).alias("prefix"))
    members = materialise(members, "groups")
    entries = members.where("id = group").select("group", "size", F.posexplode("prefix").alias("place", "key"))
    shared = entries.groupBy("key").agg(F.min("group").alias("least"), F.max("group").alias("most")).where("least < most").select("key")
    # Where a key is shared, groups are expanded to their members; members of one group form a list, too.
    across = entries.join(shared, "key").join(members.select("group", "id"), "group").select("key", "id", "size", "place")
    within = members.where("group < last").select(F.col("prefix_sig").alias("key"), "id", "size", F.lit(0).alias("place"))
    lists = materialise(across.union(within), "candidates")

    active = lists.select(F.col("id").alias("doc_id")).distinct()
    sets = materialise(_sets(docs.select("doc_id", "text").join(active, "doc_id", "left_semi"), n), "sets")

    def may_link(x: Column, y: Column) -> Column:
        """Sizes, sketches and the places of the shared shingle leave the threshold within reach."""
        most = F.least(x["place"], y["place"]) + F.least(x["size"] - x["place"], y["size"] - y["place"])
        return within_reach(x, y, percent) & ((100 + percent) * most >= percent * (x["size"] + y["size"]))

    discard(members)
    linked = link_lists(lists.join(sets.select("id", "sketch").dropDuplicates(["id"]), "id"), may_link, lambda pairs: _verified(pairs, sets, percent))
    discard(lists)
    whole = equal.join(linked, "id", "left").select("sig1", "sig2", F.coalesce("component", "id").alias("component"))
    rows = table.select("doc_id", "size", "sig1", "sig2").join(whole, ["sig1", "sig2"], "left")
    rows = rows.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
    result = materialise(rows, "components")
    discard(table, equal, sets, linked)
    return result


def keep_one_per_component(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each component: that of the smallest doc_id.

    Of repeated rows of a doc_id one stays. Rows without doc_id stay.
    """
    keep = jaccard_components(docs, n, percent).where("component_id = doc_id").select("doc_id").distinct()
    return docs.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns).union(docs.where("doc_id IS NULL"))
