"""URL filter: rules first, then the likelihood ratio of two character models.

One variable-order Markov model is trained on accepted URLs, one on rejected ones. A context of up to
six characters is used where it was seen often enough, and every order is smoothed with the next
shorter one (Witten and Bell, The zero-frequency problem, 1991). Below three characters both models
rest on one and the same model of all URLs: what neither kind has shown says nothing for either. A URL is blocked if the difference of
its log-likelihoods under both, divided by its length, is above a limit. The limit is calibrated on
accepted URLs that the models have not seen, so that it blocks few of them.

Characters are the bytes of host and path in UTF-8, so that a context with its next byte fits into one
64-bit number and nothing is hashed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.spans import slices
from seriesmill.sources.tables import materialise

#: Longest context, and the shortest that the models of either kind use.
ORDER, FIRST_ORDER = 6, 3
#: URLs of either label that its model is fitted on, at most, less a fifth that only calibrates.
TRAINING_URLS = 10_000
#: A longer context counts once it was seen this often.
MIN_CONTEXT = 2
#: Share of accepted URLs that the calibrated limit may block.
MAX_FALSE_BLOCKS = 0.02
#: Words that reject a URL for training if a part of its host, between dots and hyphens, is one of them.
REJECTED_WORDS = ("adult", "bet", "bets", "casino", "gambling", "lottery", "malware", "phishing", "poker", "porn", "sex", "slots", "spam", "viagra", "warez", "xxx")


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    text: str  # host/path

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


RULES = (Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"), Rule("allow", "com/fr/"), Rule("block", "com/de/"))

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_host(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, A-Z lower-cased; empty without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to ? or #; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], value: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, null if none does."""

    def fits(rule: Rule) -> Column:
        return ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)

    longest_first = sorted(rules, key=lambda r: (-len(r.text), r.text))
    return F.coalesce(*[F.when(fits(r), F.lit(getattr(r, value))) for r in longest_first], F.lit(None).cast("string"))


def _gram_keys(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """For each order, the context and the byte at each position as one number; -1 where the row is too short.

    A row begins behind ``ORDER`` zero bytes and ends with a byte 1.
    """
    rows, length = len(at) - 1, np.diff(at)
    size = length + ORDER + 1
    begin = np.cumsum(size) - size
    padded = np.zeros(size.sum(), np.int64)
    place = np.repeat(begin + ORDER - at[:-1], length) + np.arange(len(data))
    padded[place] = data
    padded[begin + size - 1] = 1
    row = np.repeat(np.arange(rows), size)
    spot = np.flatnonzero(np.arange(len(padded)) - begin[row] >= ORDER)
    keys, value = [], padded[spot]
    keys.append(value)
    for n in range(1, ORDER + 1):
        value = value | padded[spot - n] << (8 * n)
        keys.append(value)
    return keys


@dataclass
class CharModel:
    """For each order: sorted context+byte keys with counts, and sorted contexts with totals and kinds."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @staticmethod
    def of(order: np.ndarray, key: np.ndarray, n: np.ndarray) -> CharModel:
        grams, contexts = [], []
        for k in range(ORDER + 1):
            at = np.flatnonzero(order == k)
            at = at[np.argsort(key[at])]
            keys, counts = key[at], n[at]
            context, first = np.unique(keys >> 8, return_index=True)
            total = np.add.reduceat(counts, first) if len(first) else np.zeros(0)
            kinds = np.diff(np.append(first, len(keys)))
            grams.append((keys, counts.astype(float)))
            contexts.append((context, total.astype(float), kinds.astype(float)))
        return CharModel(grams, contexts)

    @staticmethod
    def _look(keys: np.ndarray, want: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
        if not len(keys):
            return [np.zeros(len(want)) for _ in values]
        where = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        hit = keys[where] == want
        return [np.where(hit, v[where], 0.0) for v in values]

    def probability(self, keys: list[np.ndarray], below: np.ndarray | float = 1 / 256, first: int = 0) -> np.ndarray:
        """Probability of each byte after its context; ``below`` is that of an order under the ``first``."""
        p = np.broadcast_to(below, len(keys[0]))
        for k in range(first, ORDER + 1):
            (n,) = self._look(self.grams[k][0], keys[k], self.grams[k][1])
            total, kinds = self._look(self.contexts[k][0], keys[k] >> 8, *self.contexts[k][1:])
            used = total >= (MIN_CONTEXT if k else 1)
            p = np.where(used, (n + kinds * p) / np.maximum(total + kinds, 1), p)
        return p


@dataclass
class UrlFilter:
    accepted: CharModel
    rejected: CharModel
    all_urls: CharModel
    limit: float = 0.0

    def differences(self, texts: pa.Array) -> np.ndarray:
        """Log-likelihood as rejected less that as accepted, per byte and end; 0 for an empty text."""
        parts = []
        for _, data, at in slices(texts, 1 << 20):
            keys = _gram_keys(data, at)
            shared = self.all_urls.probability(keys)
            accepted, rejected = (m.probability(keys, shared, FIRST_ORDER) for m in (self.accepted, self.rejected))
            gain = np.log(rejected) - np.log(accepted)
            size = np.diff(at) + 1
            mean = np.bincount(np.repeat(np.arange(len(size)), size), gain, len(size)) / size
            parts.append(np.where(size > 1, mean, 0.0))
        return np.concatenate(parts) if parts else np.zeros(0)

    def blocks(self, texts: pa.Array) -> np.ndarray:
        """Whether the difference is above the calibrated limit; that of an empty text never is."""
        return self.differences(texts) > self.limit


def _ranked(values: DataFrame, rank: int) -> float:
    """The value of this rank (0: the smallest) in the one column; ranges of values are counted, not sorted."""
    d = F.col(values.columns[0])
    while True:
        low, high, n = values.agg(F.min(d), F.max(d), F.count(d)).first()
        if low == high:
            return low
        if n <= 10_000:
            return float(np.sort(values.toArrow()[0].to_numpy())[rank])
        part = F.least(F.floor((d - low) / ((high - low) / 1024)), F.lit(1023))
        table = values.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").toArrow()
        sums = np.cumsum(table["n"].to_numpy())
        at = int(np.searchsorted(sums, rank, "right"))
        rank -= int(sums[at - 1]) if at else 0
        values = values.where(part == table["part"][at].as_py())


def _calibrated_limit(unseen: DataFrame) -> float:
    """The smallest limit above 0 that blocks at most ``MAX_FALSE_BLOCKS`` of unseen accepted URLs; 0 without any."""
    n = unseen.count()
    return max(0.0, _ranked(unseen, int(np.ceil((1 - MAX_FALSE_BLOCKS) * (n - 1))))) if n else 0.0


def fit_url_filter(urls: DataFrame) -> UrlFilter | None:
    """The filter for rows (text, rejected: boolean, null where unknown); None unless both labels occur.

    The model of all URLs is counted on all distinct texts; it has the orders below ``FIRST_ORDER``, at
    most 2**24 keys. Those of either label are fitted on at most ``TRAINING_URLS`` distinct texts, those
    of the smallest hashes, without a fifth. The limit comes from all accepted texts not fitted on.
    """
    spark = urls.sparkSession
    keyed = materialise(urls.where("text <> ''").select("text", "rejected").distinct().withColumn("order", F.xxhash64("text")), "urls")
    held = F.pmod("order", F.lit(5)) == 0
    labelled = (keyed.where("NOT rejected"), keyed.where("rejected"))
    samples = [x.orderBy("order", "text").limit(TRAINING_URLS).select("text", "order", F.lit(k).alias("kind")) for k, x in enumerate(labelled)]
    sample = materialise(samples[0].union(samples[1]), "url-sample")

    def counted(texts: DataFrame, orders: range) -> DataFrame:
        """kind, order, key, n of (text, kind): sums of what each task counts."""

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kind_of = np.asarray(batch.column(1))
                for first, data, at in slices(batch.column(0), 1 << 20):
                    row = np.repeat(np.arange(len(at) - 1), np.diff(at) + 1)
                    keys = _gram_keys(data, at)
                    for k in orders:
                        for kind in np.unique(kind_of).tolist():
                            distinct, n = np.unique(keys[k][kind_of[first + row] == kind], return_counts=True)
                            same = [pa.array(np.full(len(distinct), v, np.int32)) for v in (kind, k)]
                            yield pa.RecordBatch.from_arrays([*same, pa.array(distinct), pa.array(n)], ["kind", "order", "key", "n"])

        grams = texts.select("text", "kind").mapInArrow(count, "kind int, order int, key bigint, n bigint")
        return grams.groupBy("kind", "order", "key").agg(F.sum("n").alias("n"))

    own = counted(sample.where(~held), range(ORDER + 1)).toArrow()
    background = counted(keyed.select("text", F.lit(2).alias("kind")).distinct(), range(FIRST_ORDER)).toArrow()
    kind, order, key, n = (np.concatenate([t[c].to_numpy() for t in (own, background)]) for c in ("kind", "order", "key", "n"))
    if not ((kind == 0).any() and (kind == 1).any()):
        return None
    found = UrlFilter(*[CharModel.of(order[kind == k], key[kind == k], n[kind == k]) for k in range(3)])
    shared = spark.sparkContext.broadcast(found)

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.differences(batch.column(0)))], ["difference"])

    last = sample.where("kind = 0").agg(F.max(F.struct("order", "text"))).first()[0]
    beyond = (F.col("order") > last["order"]) | ((F.col("order") == last["order"]) & (F.col("text") > last["text"]))
    found.limit = _calibrated_limit(materialise(labelled[0].where(held | beyond).select("text").mapInArrow(differ, "difference double"), "differences"))
    return found


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, rejected_words: Sequence[str] = REJECTED_WORDS) -> DataFrame:
    """page_id, host, path, rule, verdict, difference (null where a rule decides) for every row.

    Models learn from the URLs that a rule decides: rejected are those that a rule blocks or whose
    host holds one of ``rejected_words``, accepted the others. A null URL, or one without ://, has
    empty host and path and is allowed unless a rule fits. With one kind of labelled URLs only, or
    none, the models block nothing. Repeated rows are judged each.
    """
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    ruled = parsed.select("*", matching_rule(F.col("host"), F.col("path"), rules, "text").alias("rule"), matching_rule(F.col("host"), F.col("path"), rules, "verdict").alias("ruling"))
    text = F.concat("host", "path")
    word = F.col("host").rlike(rf"(^|[.\-])({'|'.join(rejected_words)})([.\-]|$)") if rejected_words else F.lit(False)
    model = fit_url_filter(ruled.select(text.alias("text"), ((F.col("ruling") == "block") | (F.col("rule").isNotNull() & word)).alias("rejected")))
    if model is None:
        return ruled.select("page_id", "host", "path", "rule", F.coalesce("ruling", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("difference"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ruling = batch.column(4)
            texts = pa.array([None if known else h + p for h, p, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), ruling.is_valid().to_pylist())], pa.string())
            by_model = pa.array(np.where(shared.value.blocks(texts), "block", "allow"), pa.string())
            verdict = pa.array([a or b for a, b in zip(ruling.to_pylist(), by_model.to_pylist())], pa.string())
            difference = pa.array(shared.value.differences(texts), mask=np.array(ruling.is_valid()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], verdict, difference], ["page_id", "host", "path", "rule", "verdict", "difference"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return ruled.mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string, difference double")
