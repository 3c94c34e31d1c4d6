"""Best-fit packing of tokenized documents into sequences of a fixed length, in bulk-synchronous rounds.

Pieces are tokenized and cut where they are read; only their lengths move. Lengths are whole numbers
up to the sequence length, and pieces of one length are interchangeable, so both sides of the match
are held as sorted runs: pieces as (length, number), gaps as (gap, run of sequences). That is at most
one class per length, whatever the number of documents.

Each round takes the longest class of pieces not yet placed and sweeps the gaps from the successor of
its length upwards, the tightest first. If several sequences want the same pieces, the k-th sequence
of the run gets the piece of rank k, and the runs of gaps are updated for the next round. Pieces that
fit no gap open new sequences. The result is best-fit decreasing, one round per length.

Ranks within a length come from counts per task and length, so that no task sees all pieces of a
frequent length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.segments import segment_encoder
from seriesmill.llm.spans import slices
from seriesmill.sources.tables import materialise


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, length: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, with the task that made it and its rank there.

    A document is its ids and one ``end_id``; a null text is empty, so that its only piece is the
    end. A document of more than ``length`` ids is cut so that the first piece takes what is left
    over and all others are full.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = segment_encoder(tokenizer_path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        for batch in batches:
            for first, data, at in slices(batch.column(1)):
                counts, ids = encoder.encode(data, at)
                rows: list[tuple[int, int, int, int, int, int]] = []
                stop = 0
                for r, n in enumerate(counts.tolist()):
                    own = np.append(ids[stop : stop + n], np.uint32(end_id)).astype("<u4")
                    stop += n
                    begin, piece = 0, 0
                    for end in range((n + 1) % length or length, n + 2, length):
                        rows.append((first + r, piece, begin, end - begin, zlib.crc32(own[begin:end]), int(seen[end - begin])))
                        seen[end - begin] += 1
                        begin, piece = end, piece + 1
                of, piece, begin, size, crc, place = np.array(rows, np.int64).reshape(-1, 6).T
                columns = [batch.column(0).take(pa.array(of)), pa.array(piece.astype(np.int32)), *map(pa.array, (begin, size, crc)), pa.array(np.full(len(of), task, np.int32)), pa.array(place)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"])

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def best_fit_rounds(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Rules (length, first rank, first sequence, offset) and the number of sequences.

    A rule holds from its first rank to the next rule of the same length: rank r goes to sequence
    ``first sequence + r - first rank`` at ``offset``.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, number)
    gaps: list[int] = []  # gaps that have runs, sorted
    rules, opened = [], 0

    def add(gap: int, run: tuple[int, int]) -> None:
        if not runs[gap]:
            insort(gaps, gap)
        runs[gap].append(run)

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            k = bisect_left(gaps, size)
            if k == len(gaps):
                new = -(-left // (capacity // size))
                add(capacity, (opened, new))
                opened += new
                continue
            gap = gaps[k]
            first, number = runs[gap].pop()
            if not runs[gap]:
                gaps.pop(k)
            matched = min(number, left)
            rules.append((size, rank, first, capacity - gap))
            if matched < number:
                add(gap, (first + matched, number - matched))
            if gap > size:
                add(gap - size, (first, matched))
            rank, left = rank + matched, left - matched
    return rules, opened


def pack(docs: DataFrame, tokenizer_path: str, length: int = 1024, end_id: int = 2) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row.

    Sequences are filled without gaps from offset 0. Every row is a document of its own, repeated
    rows included. No rows in, no rows out.
    """
    pieces = materialise(tokenized_pieces(docs, tokenizer_path, length, end_id), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most one row per length
    rules, _ = best_fit_rounds(counts, length)
    table = np.array(rules, np.int64).reshape(-1, 4)
    by_size = {int(s): table[table[:, 0] == s][:, 1:] for s in np.unique(table[:, 0])}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for s in np.unique(size):
                at = np.flatnonzero(size == s)
                own = by_size[int(s)]
                rule = own[np.searchsorted(own[:, 0], rank[at], "right") - 1]
                sequence[at], offset[at] = rule[:, 1] + rank[at] - rule[:, 0], rule[:, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = pieces.join(per_task.select("length", "task", before.alias("before")), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank")
    )
    schema = f"doc_id {pieces.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return ranked.mapInArrow(place, schema)
