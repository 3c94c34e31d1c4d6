"""Token ids of many texts through few tokenizer calls: each distinct segment is encoded once.

A segment is a run of white space with the word behind it. The tokenizers used here split a text
into words before merging, and no word has anything in front of its white space, so a new segment
may start at every ASCII white-space character that follows a visible one. Whether a character is
visible is decided cautiously: after a character that may be white space beyond ASCII, or a control
character, the segment simply goes on.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from seriesmill.llm.spans import SPACES, U, span_hashes

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
#: First bytes of the two- and three-byte characters among which white space occurs.
_LEAD2, _LEAD3 = 0xC2, (0xE1, 0xE2, 0xE3)
CACHE = 2_000_000


def load_tokenizer(path: str):
    """The tokenizer of a file; one thread, since Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def segment_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the segments of a slice of texts."""
    here = np.flatnonzero(_SPACE[data])
    here = here[here > 0]
    last = data[here - 1]
    visible = (last > 0x20) & (last != 0x7F)
    wide = last >= 0x80
    two, three = data[np.maximum(here - 2, 0)], data[np.maximum(here - 3, 0)]
    visible &= ~(wide & ((two == _LEAD2) | np.isin(three, _LEAD3)))
    edge = np.zeros(len(data) + 1, bool)
    edge[here[visible]] = True
    edge[at] = True
    starts = np.flatnonzero(edge[:-1])
    return starts, np.append(starts[1:], len(data)), np.searchsorted(at, starts, "right") - 1


class SegmentEncoder:
    """Ids of texts, remembering the distinct segments seen so far (at most ``CACHE``, then anew)."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, U)  # sorted hashes of known segments
        self.place = np.zeros((0, 2), np.int64)  # of each key: first id and number of ids
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _store(self, ids: np.ndarray) -> int:
        """Position at which ``ids`` were put."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        """Encode segments and enter them under their sorted ``keys``.

        Segments with white space in front may stand one behind another in one text, where each
        has the ids that it has alone; offsets tell which are whose. The others go by themselves.
        """
        place = np.zeros((len(keys), 2), np.int64)
        texts = [data[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends.tolist())]
        spaced = _SPACE[data[starts]]
        alone = np.flatnonzero(~spaced)
        for k, encoding in zip(alone.tolist(), self.tokenizer.encode_batch_fast([texts[k] for k in alone], add_special_tokens=False)):
            place[k] = self._store(np.array(encoding.ids, np.uint32)), len(encoding.ids)
        joint = np.flatnonzero(spaced)
        for own in (joint[k : k + 4096] for k in range(0, len(joint), 4096)):
            lengths = np.array([len(texts[k]) for k in own])
            encoding = self.tokenizer.encode("".join([texts[k] for k in own]), add_special_tokens=False)
            ids, until = np.array(encoding.ids, np.uint32), np.array(encoding.offsets, np.int64).reshape(-1, 2)[:, 1]
            counts = np.diff(np.searchsorted(until, np.cumsum(lengths), "right"), prepend=0)
            place[own, 0] = self._store(ids) + np.cumsum(counts) - counts
            place[own, 1] = counts
        where = np.searchsorted(self.keys, keys)
        self.keys, self.place = np.insert(self.keys, where, keys), np.insert(self.place, where, place, axis=0)

    def encode(self, data: np.ndarray, at: np.ndarray, with_ids: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """Number of ids of each row, and the ids of all rows one after another."""
        starts, ends, row = segment_spans(data, at)
        distinct, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > CACHE:
            self.forget()
        where = np.searchsorted(self.keys, distinct)
        new = np.append(self.keys, U(0))[where] != distinct
        new |= where == len(self.keys)
        if new.any():
            self._learn(data, starts[first[new]], ends[first[new]], distinct[new])
            where = np.searchsorted(self.keys, distinct)
        begin, lengths = self.place[where[which]].T
        counts = np.bincount(row, lengths, len(at) - 1).astype(np.int64)
        if not with_ids:
            return counts, None
        stop = np.cumsum(lengths)
        total = int(stop[-1]) if len(stop) else 0
        return counts, self.ids[np.repeat(begin - (stop - lengths), lengths) + np.arange(total)]


@lru_cache(maxsize=4)
def segment_encoder(path: str) -> SegmentEncoder:
    """One per Python worker and file, so that later tasks profit from what earlier ones encoded."""
    return SegmentEncoder(load_tokenizer(path))
