"""Benchmark decontamination with suffix arrays over the training text.

Every task indexes its own shard of documents: the positions of words at which a benchmark text could
match, sorted by the words that follow. Every suffix of every benchmark text is binary-searched in the
array of each shard, all suffixes at once, word by word. A range of the array that survives a window's
length is a verbatim occurrence, and the words behind it tell how far the match goes.

The array leaves out positions whose first words occur nowhere in the benchmark, which no search could
return; it loses no match. Benchmark texts are the queries: they come in blocks of bounded size, each
broadcast by itself, and every block is searched in all documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.spans import ALNUM, LOWER, U, run_hashes, slices, span_hashes, word_spans

#: Words of benchmark text per broadcast block.
BLOCK_WORDS = 2_000_000
SHARD_BYTES = 4 << 20


def _words(texts: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, word hashes, their rows) of each slice."""
    for first, data, at in slices(texts, limit):
        lower = LOWER[data]
        starts, ends, row = word_spans(lower, at, ALNUM)
        yield first, len(at) - 1, span_hashes(lower, starts, ends), row


@dataclass
class Tests:
    """A block of benchmark texts as one sequence of words with the item of each, and its windows."""

    items: list[str]
    words: np.ndarray
    item: np.ndarray
    starts: np.ndarray  # first word of each window
    lengths: np.ndarray  # its number of words

    @staticmethod
    def of(rows: list[tuple[str, str]], window: int) -> Tests:
        _, _, words, item = next(_words(pa.array([t for _, t in rows], pa.large_string()), 1 << 62))
        count = np.bincount(item, minlength=len(rows))
        first = np.cumsum(count) - count
        n = np.where(count > 0, np.maximum(count - window + 1, 1), 0)
        starts = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return Tests([i for i, _ in rows], words, item, starts, np.repeat(np.minimum(count, window), n))


class ShardArray:
    """Suffix array over the words of a shard, limited to positions that may start a match."""

    def __init__(self, words: np.ndarray, row: np.ndarray, tests: Tests, window: int):
        self.words, self.row = words, row
        at = np.flatnonzero(np.isin(words, np.unique(tests.words[tests.starts])))
        # Of those, windows of two words or more need their second word, too; one-word items need none.
        single = np.unique(tests.words[tests.starts[tests.lengths == 1]])
        more = tests.starts[tests.lengths > 1]
        pairs = np.unique(run_hashes(tests.words, 2)[more]) if len(more) else np.zeros(0, U)
        follows = np.minimum(at + 1, max(0, len(words) - 1))
        pair = (run_hashes(words, 2)[np.minimum(at, len(words) - 2)] if len(words) > 1 else np.zeros(len(at), U))
        keep = np.isin(words[at], single) | (np.isin(pair, pairs) & (row[follows] == row[at]) & (follows > at))
        at = at[keep]
        # Sorted by the next `window` words; a suffix that ends with its document sorts first (word 0).
        order = np.lexsort([self.word(at, d) for d in range(window - 1, -1, -1)]) if len(at) else at
        self.array = at[order]

    def word(self, at: np.ndarray, depth: int) -> np.ndarray:
        """Word ``depth`` behind each position, 0 beyond the end of its document."""
        there = at + depth
        inside = there < len(self.words)
        there = np.where(inside, there, 0)
        return np.where(inside & (self.row[there] == self.row[np.minimum(at, len(self.row) - 1)]), self.words[there] if len(self.words) else U(0), U(0))

    def _bound(self, low: np.ndarray, high: np.ndarray, want: np.ndarray, depth: int, right: bool) -> np.ndarray:
        """First place in [low, high) whose word at ``depth`` is not below (or is above) the wanted one."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            have = self.word(self.array[np.minimum(middle, len(self.array) - 1)], depth)
            below = open_ & ((have <= want) if right else (have < want))
            low = np.where(below, middle + 1, low)
            high = np.where(open_ & ~below, middle, high)
        return low

    def search(self, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
        """Every occurrence of every window: number of the window, position in the shard."""
        which = np.arange(len(tests.starts))
        low, high = np.zeros(len(which), np.int64), np.full(len(which), len(self.array), np.int64)
        found, place = [], []
        depth = 0
        while len(which) and len(self.array):
            want = tests.words[tests.starts[which] + depth]
            low, high = self._bound(low, high, want, depth, False), self._bound(low, high, want, depth, True)
            depth += 1
            hit = low < high
            ready = hit & (tests.lengths[which] == depth)
            size = (high - low)[ready]
            begin = np.cumsum(size) - size
            place.append(self.array[np.repeat(low[ready] - begin, size) + np.arange(size.sum())])
            found.append(np.repeat(which[ready], size))
            going = hit & ~ready
            which, low, high = which[going], low[going], high[going]
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *found]), np.concatenate([none, *place])

    def reach(self, tests: Tests, window: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Length in words of the whole match that begins with each found window."""
        length = tests.lengths[window].copy()
        going = np.arange(len(length))
        while len(going):
            ours = tests.starts[window[going]] + length[going]
            inside = ours < len(tests.words)
            ours = np.where(inside, ours, 0)
            inside &= tests.item[ours] == tests.item[tests.starts[window[going]]]
            there = np.minimum(at[going] + length[going], len(self.words) - 1)
            same = inside & (at[going] + length[going] < len(self.words)) & (self.row[there] == self.row[at[going]]) & (tests.words[ours] == self.words[there])
            going = going[same]
            length[going] += 1
        return length


def _blocks(bench: DataFrame, window: int) -> list:
    """The benchmark as broadcasts of at most about ``BLOCK_WORDS`` words, read one block at a time."""
    context = bench.sparkSession.sparkContext
    rows = bench.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text IS NOT NULL")
    sized = rows.withColumn("words", F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")))
    total = sized.agg(F.sum("words")).first()[0] or 0
    number = -(-total // BLOCK_WORDS) or 1
    out = []
    for k in range(number):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k).toArrow()
        texts = sorted(zip(((i or "") for i in part["item_id"].to_pylist()), part["text"].to_pylist()))
        if texts:
            out.append(context.broadcast(Tests.of(texts, window)))
    return out


def _matches(words: np.ndarray, row: np.ndarray, blocks: list, window: int) -> Iterator[tuple[Tests, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: tests, window numbers, positions, whole lengths."""
    for block in blocks:
        tests = block.value
        shard = ShardArray(words, row, tests, window)
        which, at = shard.search(tests)
        yield tests, which, at, shard.reach(tests, which, at)


def contamination(docs: DataFrame, bench: DataFrame, window: int = 13) -> DataFrame:
    """Per row: doc_id, n_words, n_hit (words inside occurrences), n_items, items_sha256, contaminated, longest.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. A window is
    ``window`` consecutive words of an item; a shorter item is one window. ``longest`` is the longest
    verbatim match in words. A document is contaminated if at least a twentieth of its words is hit.
    Null and empty texts have no words and are clean; items without words match nothing. Items of one
    id count once, and a null item_id as the empty string. Every row is judged, repeated ones too.
    """
    blocks = _blocks(bench, window)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, longest bigint"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, words, row in _words(batch.column(1), SHARD_BYTES):
                delta = np.zeros(len(words) + 1, np.int64)
                longest = np.zeros(rows, np.int64)
                items: dict[int, set[str]] = {}
                for tests, which, at, length in _matches(words, row, blocks, window):
                    np.add.at(delta, at, 1)
                    np.add.at(delta, at + tests.lengths[which], -1)
                    np.maximum.at(longest, row[at], length)
                    pairs = np.unique(np.stack([row[at], tests.item[tests.starts[which]]]), axis=1) if len(at) else np.zeros((2, 0), np.int64)
                    for r, i in pairs.T.tolist():
                        items.setdefault(r, set()).add(tests.items[i])
                hit = np.bincount(row, np.cumsum(delta[:-1]) > 0, rows).astype(np.int64) if len(words) else np.zeros(rows, np.int64)
                lists = [sorted(items.get(r, ())) for r in range(rows)]
                columns = [np.bincount(row, minlength=rows), hit, np.array([len(x) for x in lists], np.int64)]
                digests = pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, rows), *map(pa.array, columns), digests, pa.array(longest)], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "longest"])

    judged = docs.select("doc_id", "text").mapInArrow(judge, schema)
    return judged.withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def longest_matches(docs: DataFrame, bench: DataFrame, window: int = 13) -> DataFrame:
    """doc_id, doc_word, item_id, item_word, n_words: the maximal verbatim matches of a window or more.

    Word numbers count from 0. A match is listed where neither text's word before it goes with it.
    """
    blocks = _blocks(bench, window)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, doc_word bigint, item_id string, item_word bigint, n_words bigint"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, words, row in _words(batch.column(1), SHARD_BYTES):
                for tests, which, at, length in _matches(words, row, blocks, window):
                    test = tests.starts[which]
                    before, earlier = np.maximum(test - 1, 0), np.maximum(at - 1, 0)
                    longer = (test > 0) & (at > 0) & (tests.item[before] == tests.item[test]) & (row[earlier] == row[at]) & (tests.words[before] == words[earlier])
                    test, at, length = test[~longer], at[~longer], length[~longer]
                    item = tests.item[test]
                    columns = [
                        batch.column(0).take(pa.array(first + row[at])),
                        pa.array(at - np.searchsorted(row, row[at])),
                        pa.array([tests.items[i] for i in item.tolist()], pa.string()),
                        pa.array(test - np.searchsorted(tests.item, item)),
                        pa.array(length),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "doc_word", "item_id", "item_word", "n_words"])

    return docs.select("doc_id", "text").mapInArrow(find, schema)


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = 13) -> DataFrame:
    """The rows of ``docs``, all columns, that the contamination rule leaves.

    Judged in one pass: no join brings text and verdict together.
    """
    blocks = _blocks(bench, window)
    at_text = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, words, row in _words(batch.column(at_text), SHARD_BYTES):
                delta = np.zeros(len(words) + 1, np.int64)
                for tests, which, at, _ in _matches(words, row, blocks, window):
                    np.add.at(delta, at, 1)
                    np.add.at(delta, at + tests.lengths[which], -1)
                hit = np.bincount(row, np.cumsum(delta[:-1]) > 0, rows) if len(words) else np.zeros(rows)
                clean = (hit == 0) | (20 * hit < np.bincount(row, minlength=rows))
                yield batch.slice(first, rows).filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
