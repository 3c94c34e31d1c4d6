"""Exact token counts of whole texts; huge documents are encoded in overlapping chunks.

A tokenizer needs memory for a whole text at once. A huge document is therefore cut into chunks
that overlap. Near its cut a chunk may be tokenized wrongly, so two neighbours are spliced at a
boundary that is proven stable: a word starts there after white space in both encodings (words are
split at white space before anything is merged, so nothing left of it can change what follows), and
the whole word before it has the same ids at the same offsets in both. Where an overlap has no such
boundary it is doubled, and in the end the two chunks become one that goes on to the next white space,
so that a run without any is encoded once, however long it is.

Other documents are encoded by distinct segments, see ``segments``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.segments import segment_encoder
from seriesmill.llm.spans import slices

_WHITE = " \t\n\r\x0b\x0c"
_GAP = re.compile(f"[{_WHITE}]+")
CHUNK, OVERLAP = 16_384, 256
#: Texts of more bytes than this go through overlapping chunks.
HUGE_BYTES = 32_768


class _Chunk:
    """Ids of text[start:end] with absolute offsets."""

    def __init__(self, text: str, start: int, end: int, encoding):
        self.text, self.start, self.end = text, start, end
        self.ids = np.asarray(encoding.ids, np.int64)
        self.at = np.asarray(encoding.offsets, np.int64).reshape(-1, 2) + start

    def words_from(self, low: int, high: int) -> dict[int, tuple]:
        """For each boundary in [low, high]: the ids and offsets of the whole word before it."""
        text = self.text
        found: dict[int, tuple] = {}
        first, last = np.searchsorted(self.at[:, 0], [low, high + 1])
        since = None
        for k in range(first, last):
            begin = int(self.at[k, 0])
            if begin > 0 and text[begin - 1] in _WHITE and (k == 0 or self.at[k - 1, 1] <= begin - 1):
                if since is not None:
                    found[begin] = (tuple(self.ids[since:k]), tuple(map(tuple, self.at[since:k])))
                since = k
        return found


def _splice_point(left: _Chunk, right: _Chunk) -> int | None:
    """The last boundary that both encodings share, with the word before it."""
    low, high = right.start, left.end
    theirs = right.words_from(low, high)
    ours = left.words_from(low, high)
    return max((p for p, word in ours.items() if theirs.get(p) == word), default=None)


def count_in_chunks(text: str, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of one text, as many as in one piece; ``overlap`` must be below ``chunk``."""

    def encode(spans: list[tuple[int, int]]) -> list[_Chunk]:
        out = tokenizer.encode_batch([text[a:b] for a, b in spans], add_special_tokens=False)
        return [_Chunk(text, a, b, e) for (a, b), e in zip(spans, out)]

    n, step = len(text), chunk - overlap
    starts = list(range(0, max(1, n - overlap), step))
    total, done, left = 0, 0, None
    for k in range(0, len(starts), 32):
        for right in encode([(a, min(a + chunk, n)) for a in starts[k : k + 32]]):
            if left is None:
                left = right
                continue
            if right.end <= left.end:
                continue  # a joined chunk reaches beyond this one; the first that ends behind it overlaps it
            width, at = overlap, _splice_point(left, right)
            while at is None or at < done:
                width *= 2
                if left.end - width <= done:
                    # Nothing to hold on to: both chunks become one, from the last splice to behind the next gap.
                    gap = _GAP.search(text, right.end)
                    right, at = encode([(done, min(n, gap.end() + overlap) if gap else n)])[0], done
                    break
                right = encode([(left.end - width, right.end)])[0]
                at = _splice_point(left, right)
            total += int(np.count_nonzero((left.at[:, 0] >= done) & (left.at[:, 0] < at)))
            done, left = at, right
    return total + int(np.count_nonzero(left.at[:, 0] >= done))


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, n_chunked (1 if counted in overlapping chunks) for every row.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each. Columns other
    than doc_id and text are not read.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, n_chunked bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = segment_encoder(tokenizer_path)
        for batch in batches:
            sizes, tokens, chunked = [], [], []
            for _, data, at in slices(batch.column(1)):
                size = np.diff(at)
                huge = size > HUGE_BYTES
                small = np.where(huge, 0, size)
                counts, _ = encoder.encode(data[np.repeat(~huge, size)], np.concatenate([[0], np.cumsum(small)]), with_ids=False)
                for r in np.flatnonzero(huge):
                    counts[r] = count_in_chunks(data[at[r] : at[r + 1]].tobytes().decode(), encoder.tokenizer)
                sizes.append(size), tokens.append(counts), chunked.append(huge.astype(np.int64))
            columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sizes, tokens, chunked)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], ["doc_id", "n_bytes", "n_tokens", "n_chunked"])

    counted = docs.select("doc_id", "text").mapInArrow(count, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
