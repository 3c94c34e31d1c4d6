"""Toxicity by a support vector machine with a gap-weighted subsequence kernel and Nyström landmarks.

Two words are compared by their common subsequences of three letters, each weighted by a decay to the
power of its span (Lodhi et al., Text classification using string kernels, 2002): a letter put in, left
out or replaced costs some of the similarity, not all of it. The kernel of two sentences adds the
sharpened similarities of their distinct words. Sentences are mapped to their kernels with a few landmark words
(Williams and Seeger, Using the Nyström method to speed up kernel machines, 2001), and a linear SVM is
trained on the sentences of labelled documents. A label says that some sentence is toxic, not which, so
sentences of toxic documents are relabelled by the machine itself, all but the worst one of each.

Since the kernel adds up words, a trained machine is one weight per word, computed once per distinct
word. A document scores by its worst sentence, calibrated on labelled documents not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.spans import LOWER, SPACED, U, slices, small_batches, span_hashes, word_spans
from seriesmill.sources.tables import materialise

DECAY, SPAN, SHARPNESS = 0.7, 6, 2
LANDMARKS, COMMON = 96, 32
#: Labelled documents of each class that the machine is fitted on, at most; a quarter calibrates.
TRAINING_DOCS = 4000
#: Sentences of each training document that go into the fit: the closest to toxic landmarks.
TRAINING_SENTENCES = 6
CACHE = 1_000_000
#: Bytes of text and number of words that are worked on at once; their arrays are some hundred times as large.
SLICE, BLOCK = 256 << 10, 512

_EDGE = 31  # code of the borders of a word
_CODE = np.zeros(256, np.uint8)  # 5-bit codes; 0: not a letter
_CODE[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CODE[0x80:] = 27 + np.arange(128) % 4
#: Spelling of codes; the digits are letters beyond ASCII.
_ALPHABET = " abcdefghijklmnopqrstuvwxyz0123"
#: Digits and signs written for letters.
for _sign, _letter in zip("013457@$", "oieastas"):
    _CODE[ord(_sign)] = _CODE[ord(_letter)]


@dataclass
class Words:
    """The distinct words of each sentence of a slice, letters only; spelled-out words are joined."""

    codes: np.ndarray
    first: np.ndarray
    length: np.ndarray
    sentence: np.ndarray
    sentence_row: np.ndarray
    hash: np.ndarray = field(init=False)

    def __post_init__(self):
        self.hash = span_hashes(self.codes, self.first, self.first + self.length)

    @staticmethod
    def of(data: np.ndarray, at: np.ndarray) -> Words:
        lower = LOWER[data]
        starts, ends, row = word_spans(lower, at, SPACED)
        codes = _CODE[lower]
        letters = np.concatenate([[0], np.cumsum(codes > 0)])
        # A sentence ends with its row, behind a word that ends in a full stop, ! or ?, and at a line break.
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        length = letters[ends] - letters[starts]
        new = np.ones(len(starts), bool)
        if len(starts) > 1:
            new[1:] = (row[1:] != row[:-1]) | np.isin(data[ends[:-1] - 1], list(b".!?")) | (breaks[starts[1:]] != breaks[starts[:-1]])
        # Single letters in a row are one word spelled out, whatever stands between them.
        single = length == 1
        joins = np.zeros(len(starts), bool)
        joins[1:] = single[1:] & single[:-1] & (row[1:] == row[:-1])
        new &= ~joins
        sentence = np.cumsum(new) - 1
        sentence_row = row[new]
        head = np.flatnonzero(~joins)
        total = np.add.reduceat(length, head) if len(head) else length
        word_at = letters[starts][head] if len(head) else np.zeros(0, np.int64)
        some = total > 0
        every = Words(codes[codes > 0], word_at[some], total[some], sentence[head][some], sentence_row)
        order = np.lexsort((every.hash, every.sentence))
        of, hashes = every.sentence[order], every.hash[order]
        new = np.ones(len(order), bool)
        new[1:] = (of[1:] != of[:-1]) | (hashes[1:] != hashes[:-1])
        once = order[new]
        return Words(every.codes, every.first[once], every.length[once], every.sentence[once], sentence_row)


def _subsequences(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word (position in ``which``), subsequence and weight, normalised to length 1 per word."""
    length = words.length[which] + 2
    first = np.cumsum(length) - length
    of = np.repeat(np.arange(len(which)), length)
    place = np.arange(length.sum()) - first[of]
    source = words.first[which][of] + place - 1
    inner = (place > 0) & (place < length[of] - 1)
    letters = np.where(inner, words.codes[np.where(inner, source, 0)], _EDGE).astype(np.int64)
    owner, ids, weight = [], [], []
    for b in range(2, SPAN):
        # Letters without b more letters of their word behind them begin no subsequence of that span.
        fits = np.flatnonzero(place + b < length[of])
        for a in range(1, b):
            owner.append(of[fits])
            ids.append(letters[fits] << 10 | letters[fits + a] << 5 | letters[fits + b])
            weight.append(np.full(len(fits), DECAY ** (b + 1), np.float32))
    key = np.concatenate(owner) << 15 | np.concatenate(ids)
    distinct, inverse = np.unique(key, return_inverse=True)
    sums = np.bincount(inverse, np.concatenate(weight), len(distinct))
    of = distinct >> 15
    norm = np.sqrt(np.bincount(of, sums * sums, len(which)))
    return of, distinct & 0x7FFF, sums / norm[of]


def _spelled(names: list[str]) -> tuple[np.ndarray, ...]:
    """The parts of Words for names spelled in ``_ALPHABET``."""
    length = np.array([len(x) for x in names], np.int64)
    codes = np.array([_ALPHABET.index(c) for x in names for c in x], np.uint8)
    none = np.zeros(len(names), np.int64)
    return codes, np.cumsum(length) - length, length, none, none


@dataclass
class Landmarks:
    """Landmark words as a matrix of their subsequences: a row for each that occurs."""

    row: np.ndarray  # of each of the 32,768 subsequences, -1 if no landmark has it
    matrix: np.ndarray

    @staticmethod
    def of(names: list[str]) -> Landmarks:
        """``names`` are spelled in ``_ALPHABET``."""
        words = Words(*_spelled(names))
        of, ids, weight = _subsequences(words, np.arange(len(names)))
        used = np.unique(ids)
        row = np.full(1 << 15, -1, np.int32)
        row[used] = np.arange(len(used))
        matrix = np.zeros((len(used), len(names)), np.float32)
        matrix[row[ids], of] = weight
        return Landmarks(row, matrix)

    def similarities(self, words: Words, which: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """Sharpened kernel of each word with each landmark; with ``weights`` of the landmarks, its weighted sum.

        A word has some hundred subsequences, each a row of the matrix, so that few words go at a time.
        """
        out = np.zeros((len(which), self.matrix.shape[1]) if weights is None else len(which), np.float32 if weights is None else float)
        for k in range(0, len(which), BLOCK):
            some = which[k : k + BLOCK]
            of, ids, weight = _subsequences(words, some)
            shared = self.row[ids] >= 0
            of, ids, weight = of[shared], ids[shared], weight[shared]
            block = np.zeros((len(some), self.matrix.shape[1]), np.float32)
            if len(of):
                heads = np.flatnonzero(np.diff(of, prepend=-1))
                terms = self.matrix[self.row[ids]]
                terms *= weight[:, None].astype(np.float32)
                block[of[heads]] = np.add.reduceat(terms, heads)
            block **= SHARPNESS
            out[k : k + BLOCK] = block if weights is None else block @ weights
        return out


@dataclass
class Machine:
    landmarks: Landmarks
    weights: np.ndarray  # of the kernels with the landmarks
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, U))
    known: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __getstate__(self):
        return {**self.__dict__, "keys": np.zeros(0, U), "known": np.zeros(0)}

    def word_weights(self, words: Words) -> np.ndarray:
        distinct, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > CACHE:
            self.keys, self.known = np.zeros(0, U), np.zeros(0)
        where = np.searchsorted(self.keys, distinct)
        new = np.append(self.keys, U(0))[where] != distinct
        new |= where == len(self.keys)
        if new.any():
            fresh = self.landmarks.similarities(words, first[new], self.weights)
            self.keys, self.known = np.insert(self.keys, where[new], distinct[new]), np.insert(self.known, where[new], fresh)
            where = np.searchsorted(self.keys, distinct)
        return self.known[where[which]]

    def margins(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The worst sentence's margin of each row; a row without words has that of an empty sentence."""
        words = Words.of(data, at)
        out = np.full(len(at) - 1, self.bias)
        if len(words.length):
            sums = np.bincount(words.sentence, self.word_weights(words), len(words.sentence_row)) + self.bias
            np.maximum.at(out, words.sentence_row, sums)
        return out

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -500, 500)))


def _descend(gradient, x: np.ndarray, step: float, rounds: int) -> np.ndarray:
    """Nesterov's accelerated gradient descent."""
    ahead, before = x, x
    for k in range(rounds):
        x = ahead - step * gradient(ahead)
        ahead = x + k / (k + 3) * (x - before)
        before = x
    return x


def _svm(features: np.ndarray, label: np.ndarray, weight: np.ndarray, penalty: float = 1e-4) -> np.ndarray:
    """Weights (the last is the bias) of a squared-hinge SVM; labels are 1 and -1."""
    x = np.column_stack([features, np.ones(len(features))])
    total = weight.sum()

    def gradient(w: np.ndarray) -> np.ndarray:
        short = np.maximum(0, 1 - label * (x @ w))
        return penalty * w - 2 * (x.T @ (weight * label * short)) / total

    step = 1 / (penalty + 2 * np.linalg.norm((x * weight[:, None]).T @ x / total, 2))
    return _descend(gradient, np.zeros(x.shape[1]), step, 600)


def _platt(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits the weighted labels (0, 1), with smoothed targets."""
    positive, negative = (weight * label).sum(), (weight * (1 - label)).sum()
    target = np.where(label == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    centre, spread = margin.mean(), margin.std() or 1.0
    x = np.column_stack([(margin - centre) / spread, np.ones(len(margin))])
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hessian, x.T @ (weight * (p - target))), -2, 2)
    return float(w[0] / spread), float(w[1] - w[0] * centre / spread)


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """bag, part (0: calibration), label, text of a bounded sample per class, and the number of all labelled documents per class.

    The sample is drawn from ids; texts are then picked by a broadcast of at most 2 * TRAINING_DOCS of them.
    """
    keyed = labels.join(docs.select("doc_id"), "doc_id", "left_semi").select("doc_id", "label", F.xxhash64(F.col("doc_id").cast("string")).alias("bag"))
    counts = {r["label"]: r["count"] for r in keyed.groupBy("label").count().collect()}
    chosen = [keyed.where(f"label = {k}").orderBy("bag", "doc_id").limit(TRAINING_DOCS) for k in (0, 1)]
    picked = chosen[0].union(chosen[1]).select("doc_id", "bag", "label", F.pmod("bag", F.lit(4)).cast("int").alias("part"))
    texts = docs.select("doc_id", "text").join(F.broadcast(materialise(picked, "picked")), "doc_id")
    return materialise(texts.select("bag", "part", "label", "text"), "labelled"), counts


def _landmark_words(training: DataFrame) -> tuple[list[str], list[str]]:
    """The words most associated with the label, by frequency times log odds, and the most frequent others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = np.frombuffer(_ALPHABET.encode(), np.uint8)
        for batch in batches:
            label = np.array(batch.column(0))
            for first, data, at in slices(batch.column(1), SLICE):
                words = Words.of(data, at)
                if not len(words.length):
                    continue
                row = words.sentence_row[words.sentence]
                order = np.lexsort((words.hash, row))
                again = (row[order][1:] == row[order][:-1]) & (words.hash[order][1:] == words.hash[order][:-1])
                one = order[np.append(True, ~again)]
                one = one[words.length[one] > 2]
                texts = [letters[words.codes[a : a + n]].tobytes().decode() for a, n in zip(words.first[one], words.length[one])]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(label[first + row[one]].astype(np.int64))], ["word", "label"])

    n = {r["label"]: r["count"] for r in training.groupBy("label").count().collect()}
    words = training.select("label", "text").mapInArrow(count, "word string, label bigint")
    counts = materialise(words.groupBy("word").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")), "words")
    odds = (F.col("bad") + 0.5) / (n.get(1, 0) + 1) / ((F.col("good") + 0.5) / (n.get(0, 0) + 1))
    toxic = counts.where(odds > 2).orderBy((F.col("bad") * F.log(odds)).desc(), "word").limit(LANDMARKS).collect()
    common = counts.where(odds <= 2).orderBy(F.desc("good"), "word").limit(COMMON).collect()
    return [r["word"] for r in toxic], [r["word"] for r in common]


def _sentence_features(training: DataFrame, landmarks: Landmarks, toxic: int) -> DataFrame:
    """bag, label, kernels with the landmarks, of the sentences closest to the toxic ones."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bag, label = np.array(batch.column(0)), np.array(batch.column(1)).astype(np.int64)
            for first, data, at in slices(batch.column(2), SLICE):
                words = Words.of(data, at)
                sentences = len(words.sentence_row)
                _, one, which = np.unique(words.hash, return_index=True, return_inverse=True)
                kernel = landmarks.similarities(words, one)
                near = np.bincount(words.sentence, kernel[:, :toxic].max(axis=1, initial=0)[which], sentences)
                order = np.lexsort((-near, words.sentence_row))
                row = words.sentence_row[order]
                chosen = order[np.arange(sentences) - np.searchsorted(row, row) < TRAINING_SENTENCES]
                place = np.full(sentences, -1)
                place[chosen] = np.arange(len(chosen))
                mine = np.flatnonzero(place[words.sentence] >= 0)
                sums = np.zeros((len(chosen), kernel.shape[1]), np.float32)
                np.add.at(sums, place[words.sentence[mine]], kernel[which[mine]])
                rows = first + words.sentence_row[chosen]
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(chosen) + 1, dtype=np.int32) * kernel.shape[1]), pa.array(sums.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(bag[rows]), pa.array(label[rows]), values], ["bag", "label", "kernels"])

    return training.select("bag", "label", "text").mapInArrow(features, "bag bigint, label bigint, kernels array<float>")


def _margins(docs: DataFrame, machine: Machine, schema: str) -> DataFrame:
    """The first column of docs (columns: any, text) and the margin."""

    def margin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [machine.margins(data, at) for _, data, at in slices(batch.column(1), SLICE)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts) if parts else np.zeros(0))], [batch.schema.names[0], "margin"])

    return docs.mapInArrow(margin, schema)


def fit(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """The machine for documents (doc_id, text) and labels (doc_id, label 0 or 1; one row each); None unless both labels occur."""
    small_batches(docs.sparkSession)
    sample, totals = _sample(docs, labels.where("label IN (0, 1)").withColumn("label", F.col("label").cast("bigint")))
    training = sample.where("part <> 0")
    if len(training.select("label").distinct().collect()) < 2:
        return None
    toxic, common = _landmark_words(training)
    if not toxic + common:
        return None
    landmarks = Landmarks.of(toxic + common)
    # At most 2 * TRAINING_DOCS * TRAINING_SENTENCES rows of LANDMARKS + COMMON numbers.
    table = _sentence_features(training, landmarks, len(toxic)).toArrow()
    bag, label = table["bag"].to_numpy(), table["label"].to_numpy() * 2 - 1
    kernels = np.asarray(table["kernels"].combine_chunks().flatten()).reshape(len(bag), -1)
    # Nyström: kernels with the landmarks, times the inverse root of the landmarks' own kernels.
    own = Words(*_spelled(toxic + common))
    values, vectors = np.linalg.eigh(landmarks.similarities(own, np.arange(len(own.length))).astype(float))
    root = (vectors / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    features = kernels @ root
    order = np.argsort(bag, kind="stable")
    bag, label, features = bag[order], label[order], features[order]
    heads = np.flatnonzero(np.diff(bag, prepend=bag[0] - 1 if len(bag) else 0)) if len(bag) else np.zeros(0, np.int64)
    bag_of = np.cumsum(np.isin(np.arange(len(bag)), heads)) - 1
    target = label.astype(float)
    for _ in range(4):
        weight = np.where(target > 0, 0.5 / max(1, (target > 0).sum()), 0.5 / max(1, (target < 0).sum()))
        solution = _svm(features, target, weight * len(target))
        margin = features @ solution[:-1] + solution[-1]
        worst = np.maximum.reduceat(margin, heads)[bag_of] == margin
        target = np.where((label > 0) & ((margin > 0) | worst), 1.0, -1.0)
    machine = Machine(landmarks, root @ solution[:-1], float(solution[-1]))
    held = _margins(sample.where("part = 0").select("label", "text"), machine, "label bigint, margin double").toArrow()
    margin, truth = held["margin"].to_numpy(), held["label"].to_numpy()
    if len(np.unique(truth)) == 2:
        share = {k: totals[k] / (truth == k).sum() for k in (0, 1)}
        weight = np.where(truth == 1, share[1], share[0])
        machine.slope, machine.shift = _platt(margin, truth, weight / weight.mean())
    return machine


def score_toxicity(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """doc_id, score (0 to 1) for every row; only the text is looked at.

    Null and empty texts score like a sentence without words. Without a machine (no labelled rows of
    both kinds) every score is 0. Repeated rows score alike.
    """
    rows = docs.select("doc_id", "text")
    if machine is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # LANDMARKS + COMMON words

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shared.value.scores(shared.value.margins(data, at)) for _, data, at in slices(batch.column(1), SLICE)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts) if parts else np.zeros(0))], ["doc_id", "score"])

    return rows.mapInArrow(score, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def held_out(doc_id: Column) -> Column:
    """True for the fifth of documents whose labels are never learnt from; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit_on_labels(docs: DataFrame, labels: DataFrame) -> Machine | None:
    """Fit on documents with a label outside the held-out fifth; conflicting labels of one doc_id count as toxic."""
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    return fit(docs, known.where(~held_out(F.col("doc_id"))))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    scored = score_toxicity(docs, fit_on_labels(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, machine: Machine | None) -> DataFrame:
    """The rows of ``docs``, all columns, that score below 0.5."""
    if machine is None:
        return docs
    shared, at_text = docs.sparkSession.sparkContext.broadcast(machine), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, at in slices(batch.column(at_text), SLICE):
                yield batch.slice(first, len(at) - 1).filter(pa.array(shared.value.scores(shared.value.margins(data, at)) < 0.5))

    return docs.mapInArrow(keep, docs.schema)
