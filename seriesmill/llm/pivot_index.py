"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in the order of nearness (Amato and
Savino, Approximate similarity search in metric spaces using inverted files, 2008; Chávez, Figueroa
and Navarro, Effective proximity retrieval by ordering permutations, 2008). Inverted lists hold the
vectors of each two of these pivots, so that vectors with two or more pivots in common meet, and a
pair is looked at only in the list of the first two that it shares. Pairs that meet are verified by
their cosine. Lists beyond a tile are cut into tiles, and every two tiles meet in a task of their own;
what leaves a task is a count and a root per vector, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from seriesmill.llm.components import components
from seriesmill.sources.tables import materialise

#: Pivots that describe a vector.
NEAREST = 6
#: Vectors that pivots are chosen from, and pivots at most: what is collected and broadcast.
SAMPLE, MOST_PIVOTS, LEAST_PIVOTS = 4096, 4096, 32
#: Pivots nearer to each other than this do not tell vectors apart.
APART = 0.9
#: Vectors of a tile; lists of up to SMALL vectors are compared many at a time.
TILE, SMALL = 1024, 32
#: A key with more than one in HOT of all rows is joined by broadcast: there are fewer than HOT of them.
HOT = 1000


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows at length 1, in double precision; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _usable(vector: Column) -> Column:
    """Not null, not empty, every component finite, and not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_classes(vectors: DataFrame) -> DataFrame:
    """cid, label, vector, first, n: each vector of each label once, with the smallest vec_id and the number of its rows."""
    grouped = vectors.where("usable").groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    return materialise(grouped.select(F.monotonically_increasing_id().alias("cid"), "*"), "vector-classes")


def choose_pivots(classes: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Pivots of each number of dimensions, from a bounded sample by hash; there are more of them for more vectors.

    With as many pairs of pivots as entries in their lists, lists of unlike vectors stay short. A
    candidate near a pivot already chosen is passed over, so that a large group of copies gives one.
    """
    vectors = classes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample).toArrow()["vector"].combine_chunks()
    entries = classes.count() * math.comb(NEAREST, 2)
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, math.ceil(math.sqrt(2 * entries))))
    pivots = {}
    size = vectors.value_lengths().to_numpy()
    for d in np.unique(size).tolist():
        units = _units(vectors.take(pa.array(np.flatnonzero(size == d))).flatten().to_numpy().reshape(-1, d))
        chosen = np.zeros((min(wanted, len(units)), d))
        have = 0
        for unit in units:
            if have < len(chosen) and (have == 0 or (chosen[:have] @ unit).max() < APART):
                chosen[have] = unit
                have += 1
        pivots[d] = chosen[:have]
    return pivots


def describe(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``classes`` with nearest: the numbers of the nearest pivots in order of nearness; none without pivots."""
    sent = classes.sparkSession.sparkContext.broadcast(pivots)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            size = vectors.value_lengths().to_numpy()
            nearest: list[list[int]] = [[] for _ in range(len(batch))]
            for d in np.unique(size):
                points = sent.value.get(int(d))
                if points is None or len(points) < 2:
                    continue
                at = np.flatnonzero(size == d)
                units = _units(vectors.take(pa.array(at)).flatten().to_numpy().reshape(-1, d))
                for low in range(0, len(at), 1024):
                    order = np.argsort(-(units[low : low + 1024] @ points.T), axis=1, kind="stable")[:, :NEAREST]
                    for k, own in zip(at[low : low + 1024], order.tolist()):
                        nearest[k] = own
            columns = [batch.column("cid"), pa.array(nearest, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["cid", "nearest"])

    numbers = classes.select("cid", "vector").mapInArrow(near, "cid bigint, nearest array<int>")
    return materialise(classes.join(numbers, "cid"), "described")


def _by_count(rows: DataFrame, counts: DataFrame, keys: list[str], all_rows: int) -> DataFrame:
    """``rows`` with the columns of ``counts`` (one row a key, column n_rows), inner; keys with very many rows by broadcast."""
    hot = counts.where(F.col("n_rows") * HOT > all_rows)  # fewer than HOT rows
    return rows.join(F.broadcast(hot), keys).unionByName(rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(counts, keys))


def list_rows(described: DataFrame, tile: int = TILE) -> DataFrame:
    """Rows of the inverted lists with two or more vectors, once for every two tiles that they are compared in.

    list_ (number of the label, dimensions and pivots), low, high (tiles), tile, and the class. Lists
    of vectors without pivots hold all of their label and dimensions.
    """
    sorted_ = F.sort_array("nearest")
    pair = F.flatten(F.transform(sorted_, lambda a, i: F.transform(F.filter(sorted_, lambda b, j: j > i), lambda b: a * MOST_PIVOTS + b)))
    key = F.explode(F.when(F.size("nearest") < 2, F.array(F.lit(-1))).otherwise(pair)).alias("pivots")
    entries = materialise(described.select("cid", "label", F.size("vector").alias("d"), key), "entries")
    keys = ["label", "d", "pivots"]
    lengths = entries.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    lengths = materialise(lengths.select(*keys, "n_rows", F.expr(f"CAST((n_rows + {tile} - 1) DIV {tile} AS INT)").alias("tiles")), "lengths")
    rows = _by_count(entries, lengths, keys, entries.count())
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    rows = rows.select("cid", *keys, F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile")
    return rows.join(described.select("cid", "n", "vector", F.sort_array("nearest").alias("nearest")), "cid")


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest place that each row of a symmetric matrix of links reaches."""
    root = np.arange(len(linked))
    while True:
        near = np.minimum(root, np.where(linked, root[None, :], len(root)).min(axis=1))
        near = near[near]
        if (near == root).all():
            return root
        root = near


class _Lists:
    """Rows of whole lists as arrays, sorted by list."""

    def __init__(self, table: pa.Table):
        self.cid, self.n, self.pivots, self.tile = (table[c].to_numpy() for c in ("cid", "n", "pivots", "tile"))
        self.low, self.high, self.d = (table[c].to_numpy() for c in ("low", "high", "d"))
        edges = np.ones(len(table) + 1, bool)
        for c in ("label", "d", "pivots", "low", "high"):
            same = table[c].to_numpy()
            edges[1:-1] = edges[1:-1] & (same[1:] == same[:-1])
        edges[1:-1] = ~edges[1:-1]
        self.begins = np.flatnonzero(edges)
        self.vectors = table["vector"].combine_chunks()
        near = table["nearest"].combine_chunks()
        self.nearest = np.full((len(table), NEAREST), -1, np.int64)
        length = near.value_lengths().to_numpy()
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        self.nearest[np.repeat(np.arange(len(table)), length), at] = near.flatten().to_numpy()
        # The pivots that come before the second of the list, without its first: shared, they belong to an earlier list.
        a, b = self.pivots // MOST_PIVOTS, self.pivots % MOST_PIVOTS
        earlier = (self.nearest >= 0) & (self.nearest < b[:, None]) & (self.nearest != a[:, None]) & (self.pivots >= 0)[:, None]
        self.earlier = np.where(earlier, self.nearest, -1)

    def units(self, low: int, high: int) -> np.ndarray:
        return _units(self.vectors.slice(low, high - low).flatten().to_numpy().reshape(high - low, -1))


def _not_earlier(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """True where two rows of earlier pivots have none in common."""
    return ~((x[..., :, None] == y[..., None, :]) & (x[..., :, None] >= 0)).any(axis=(-1, -2))


def _compare(lists: _Lists, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, links, roots): rows with links, the number of rows they stand for, and the row each group hangs on."""
    sizes = np.diff(lists.begins)
    for d in np.unique(lists.d):
        own = np.flatnonzero((lists.d[lists.begins[:-1]] == d) & (sizes <= SMALL))
        # Small lists side by side: pairs by their distance in the sorted rows.
        for low in range(0, len(own), 512):
            some = own[low : low + 512]
            rows = np.concatenate([np.arange(lists.begins[g], lists.begins[g + 1]) for g in some])
            of = np.repeat(np.arange(len(some)), sizes[some])
            units = _units(lists.vectors.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1))
            lefts, rights = [], []
            for step in range(1, int(sizes[some].max())):
                x = np.flatnonzero(of[step:] == of[:-step])
                # Of two tiles only rows of different ones meet.
                tile, one = lists.tile[rows], (lists.low == lists.high)[rows]
                x = x[one[x] | (tile[x] != tile[x + step])]
                x = x[np.einsum("ij,ij->i", units[x], units[x + step]) >= threshold]
                x = x[_not_earlier(lists.earlier[rows[x]], lists.earlier[rows[x + step]])]
                lefts.append(x)
                rights.append(x + step)
            if not lefts or not sum(map(len, lefts)):
                continue
            left, right = np.concatenate(lefts), np.concatenate(rights)
            links = np.zeros(len(rows), np.int64)
            np.add.at(links, left, lists.n[rows[right]])
            np.add.at(links, right, lists.n[rows[left]])
            root = np.arange(len(rows))
            while True:
                least = np.minimum(root[left], root[right])
                near = root.copy()
                np.minimum.at(near, left, least)
                np.minimum.at(near, right, least)
                near = near[near]
                if (near == root).all():
                    break
                root = near
            hit = np.flatnonzero(links)
            yield rows[hit], links[hit], rows[root[hit]]
    for g in np.flatnonzero(sizes > SMALL):
        low, high = lists.begins[g], lists.begins[g + 1]
        kinds, kind = np.unique(lists.earlier[low:high], axis=0, return_inverse=True)
        kind = kind.reshape(-1)
        open_ = np.zeros((len(kinds), len(kinds)), bool)
        for k, x in enumerate(kinds):
            open_[k] = _not_earlier(np.broadcast_to(x, kinds.shape), kinds)
        if not open_.any():
            continue
        units = lists.units(low, high)
        linked = (units @ units.T >= threshold) & open_[kind][:, kind]
        if lists.low[low] != lists.high[low]:
            linked &= lists.tile[low:high, None] != lists.tile[None, low:high]
        np.fill_diagonal(linked, False)
        linked |= linked.T  # the product may differ by a rounding between its halves
        hit = np.flatnonzero(linked.any(axis=1))
        if len(hit):
            yield low + hit, linked[hit] @ lists.n[low:high], low + _roots(linked)[hit]


def linked_rows(lists: DataFrame, threshold: float) -> DataFrame:
    """cid, links, root: for vectors with links in a list the rows they link to there, and a vector they hang together with."""
    keys = ["label", "d", "pivots", "low", "high"]
    columns = [*keys, "tile", "cid", "n", "vector", "nearest"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if len(table):
                rows_of = _Lists(table)
                for rows, links, roots in _compare(rows_of, threshold):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rows_of.cid[rows], links, rows_of.cid[roots])], ["cid", "links", "root"])

        waiting = None  # the last list so far, which may go on in the next batch
        for batch in batches:
            if len(batch) == 0:
                continue
            table = pa.Table.from_batches([batch])
            if waiting is not None:
                table = pa.concat_tables([waiting, table]).combine_chunks()
            other = np.zeros(len(table), bool)
            for c in keys:
                values = table[c].to_numpy()
                other |= values != values[-1]
            cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            yield from results(table.slice(0, cut))
            waiting = table.slice(cut)
        if waiting is not None:
            yield from results(waiting)

    dealt = lists.select(*columns).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(verify, "cid bigint, links bigint, root bigint")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label).

    Rows link if their labels are equal and the cosine of their vectors, in double precision, is at
    least ``threshold``. Nothing links to a row with a null label or vec_id, or a vector that is null,
    empty, zero, or holds a null or a component that is not finite, nor do vectors of different
    length. Repeated rows, and rows that share a vec_id, are vectors of their own. A row without a vec_id
    has no component and is kept. Pairs are found if their vectors share two of their ``NEAREST``
    pivots; those found are exact. vec_id must be a whole number.
    """
    exact = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    whole = isinstance(vectors.schema["label"].dataType, IntegralType)
    label = F.col("label").cast("bigint") if whole else F.when(F.col("label").isNotNull(), F.xxhash64("label"))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), exact.alias("vector"))
    rows = rows.withColumn("usable", _usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    classes = vector_classes(rows)
    described = describe(classes, choose_pivots(classes))
    found = materialise(linked_rows(list_rows(described, tile), threshold), "linked")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))

    joined = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")).where("a <> b").distinct())
    joined = materialise(joined.withColumnRenamed("id", "cid").join(described.select("cid", "first"), "cid"), "joined")
    smallest = joined.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("n_rows"))
    joined = _by_count(joined, smallest, ["component"], classes.count()).select("cid", "component_id")

    of_class = described.select("cid", "label", "vector", "first", "n").join(links, "cid", "left").join(joined, "cid", "left")
    digest = [F.xxhash64("label", "vector").alias("h1"), F.xxhash64("vector", F.lit(1), "label").alias("h2")]
    counted = (F.col("n") - 1 + F.coalesce("links", F.lit(0).cast("bigint"))).alias("n_links")
    of_class = materialise(of_class.select(*digest, F.col("n").alias("n_rows"), counted, F.coalesce("component_id", "first").alias("component_id")), "vector-results")

    used = rows.where("usable").select("vec_id", *digest)
    all_rows = classes.agg(F.sum("n")).first()[0] or 0
    linked = _by_count(used, of_class, ["h1", "h2"], all_rows).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
