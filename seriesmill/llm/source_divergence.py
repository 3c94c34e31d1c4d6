"""Audit of how the words of sources diverge, counted through minimal acyclic transducers.

The kept terms of each language are sorted by ranges, and every task builds transducers of bounded
size from its sorted run. Texts are then streamed through them: what comes out is the ordinal of a
term in the order of its language, which is counted, and which breaks ties. Transducers are sent to
the tasks in blocks of bounded size, each block in a pass of its own.

Whole numbers throughout: shares are scaled to a billion and rounded down.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.llm.spans import LOWER, byte_table, mix, slices, span_hashes, word_spans
from seriesmill.llm.transducer import Transducer, build
from seriesmill.sources.tables import materialise

U = np.uint64
#: Terms are runs of ASCII letters and everything beyond ASCII.
LETTERS = byte_table(bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
MIN_DOCS = 10
SCALE = 1_000_000_000
#: A task starts a new transducer when the terms of the last one reach this many bytes.
SHARD_BYTES = 2 << 20
#: Transducers in memory at once, in bytes: what one pass over the texts broadcasts.
BLOCK_BYTES = 48 << 20
#: Ordinals and sources of a tile of the pair sums.
TERMS, SOURCES = 1024, 64
TOP = 10


def _text_rows(docs: DataFrame) -> DataFrame:
    empty = F.lit("")
    return docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])


def _codes(column: pa.Array) -> tuple[np.ndarray, list]:
    encoded = column.dictionary_encode()
    return encoded.indices.to_numpy(), encoded.dictionary


def document_frequencies(rows: DataFrame) -> DataFrame:
    """lang, term, n_docs of every term of the texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, langs = _codes(batch.column(0))
            for first, data, at in slices(batch.column(1)):
                data = LOWER[data]
                starts, ends, row = word_spans(data, at, LETTERS)
                if len(starts) == 0:
                    continue
                code = codes[first + row]
                hashes = span_hashes(data, starts, ends) ^ mix(code.astype(U) + U(1))
                order = np.argsort(hashes, kind="stable")  # rows stay in order within a term
                h, r = hashes[order], row[order]
                new_term = np.append(True, h[1:] != h[:-1])
                new_row = new_term | np.append(True, r[1:] != r[:-1])
                begin = np.flatnonzero(new_term)
                n_docs = np.add.reduceat(new_row.astype(np.int64), begin)
                one = order[begin]
                lengths = ends[one] - starts[one]
                offsets = np.append(0, np.cumsum(lengths))
                bytes_ = data[np.arange(offsets[-1]) + np.repeat(starts[one] - offsets[:-1], lengths)]
                terms = pa.LargeStringArray.from_buffers(len(one), pa.py_buffer(offsets), pa.py_buffer(bytes_)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(code[one])), terms, pa.array(n_docs)], ["lang", "term", "n_docs"])

    partial = rows.select("lang", "text").mapInArrow(count, "lang string, term string, n_docs bigint")
    return partial.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"))


def build_shards(kept: DataFrame) -> DataFrame:
    """lang, first_term, n_terms, base, terms, stored: transducers of runs of the sorted terms of each language.

    ``base`` is the ordinal of the first term. A run ends where its terms reach ``SHARD_BYTES``, so
    that a task holds one run, however many terms there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "first_term", "n_terms", "terms", "stored"]
        lang, terms, size = None, [], 0

        def shard() -> pa.RecordBatch:
            stored = build(term.encode() for term in terms).to_bytes()
            values = [[lang], [terms[0]], [len(terms)], [terms], [stored]]
            types = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

        for batch in batches:
            for own, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if terms and (own != lang or size >= SHARD_BYTES):
                    yield shard()
                    terms, size = [], 0
                lang = own
                terms.append(term)
                size += len(term.encode())
        if terms:
            yield shard()

    # Written before the sort by ranges, which looks at its input twice.
    ordered = materialise(kept.select("lang", "term"), "kept-terms").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    shards = materialise(ordered.mapInArrow(run, "lang string, first_term string, n_terms bigint, terms array<string>, stored binary"), "transducers")
    # One row per transducer, without its content.
    before = F.sum("n_terms").over(Window.partitionBy("lang").orderBy("first_term").rowsBetween(Window.unboundedPreceding, -1))
    bases = shards.select("lang", "first_term", F.coalesce(before, F.lit(0)).alias("base"))
    return materialise(shards.join(bases, ["lang", "first_term"]), "numbered-transducers")


def _blocks(shards: DataFrame, limit: int) -> Iterator[list]:
    """Transducers in blocks of ``limit`` bytes; the driver holds one block."""
    sizes = [(r["size"], r["lang"], r["first_term"]) for r in shards.select(F.length("stored").alias("size"), "lang", "first_term").orderBy("lang", "first_term").toLocalIterator()]
    at = 0
    while at < len(sizes):
        end, size = at + 1, sizes[at][0]
        while end < len(sizes) and size + sizes[end][0] <= limit:
            size, end = size + sizes[end][0], end + 1
        low, high = sizes[at][1:], sizes[end - 1][1:]
        place = F.struct("lang", "first_term")
        inside = (place >= F.struct(F.lit(low[0]), F.lit(low[1]))) & (place <= F.struct(F.lit(high[0]), F.lit(high[1])))
        yield shards.where(inside).select("lang", "base", "stored").collect()
        at = end


def recount(rows: DataFrame, shards: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, source, ordinal, n: occurrences of kept terms, from texts streamed through the transducers."""
    spark = rows.sparkSession
    counted = None
    for block in _blocks(shards, block_bytes):
        sent = spark.sparkContext.broadcast([(r["lang"], r["base"], bytes(r["stored"])) for r in block])

        def follow(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            machines: dict[str, list] = {}
            for lang, base, stored in sent.value:
                machines.setdefault(lang, []).append((base, Transducer.from_bytes(stored)))
            for batch in batches:
                codes, langs = _codes(batch.column(0))
                source_codes, sources = _codes(batch.column(1))
                for first, data, at in slices(batch.column(2)):
                    data = LOWER[data]
                    starts, ends, row = word_spans(data, at, LETTERS)
                    code, source = codes[first + row], source_codes[first + row]
                    for c, lang in enumerate(langs.to_pylist()):
                        own = np.flatnonzero(code == c)
                        for base, machine in machines.get(lang, []) if len(own) else []:
                            ordinal = machine.ordinals(data, starts[own], ends[own])
                            hit = ordinal >= 0
                            width = int(ordinal.max(initial=0)) + 1
                            pairs, n = np.unique(source[own[hit]].astype(np.int64) * width + ordinal[hit], return_counts=True)
                            own = own[~hit]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([lang] * len(pairs), pa.string()), sources.take(pa.array(pairs // width)), pa.array(base + pairs % width), pa.array(n.astype(np.int64))],
                                ["lang", "source", "ordinal", "n"],
                            )

        langs = sorted({r["lang"] for r in block})
        part = rows.where(F.col("lang").isin(langs)).mapInArrow(follow, "lang string, source string, ordinal bigint, n bigint")
        part = part.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
        counted = part if counted is None else counted.union(part)
    if counted is None:
        counted = spark.createDataFrame([], "lang string, source string, ordinal bigint, n bigint")
    return materialise(counted, "recounted")


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact."""
    return 1 + F.expr(f"(CAST({n} + 2 AS DECIMAL(19, 0)) * {SCALE}) DIV CAST({total} + 2 * {terms} AS DECIMAL(19, 0))")


def _shares(n: np.ndarray, divisor: np.ndarray) -> np.ndarray:
    """``_share`` of arrays; products beyond 64 bits go through Python's integers."""
    if int(n.max(initial=0)) + 2 > np.iinfo(np.int64).max // SCALE:
        return ((n.astype(object) + 2) * SCALE // divisor).astype(np.int64) + 1
    return (n + 2) * SCALE // divisor + 1


def pair_sums(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, a, b, value for every two sources a < b of a language.

    A tile holds at most ``TERMS`` terms and twice ``SOURCES`` sources, as a matrix of shares; what
    leaves it is one sum for each two sources. Terms without a count are filled in inside the tile.
    """
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    numbered = groups.select("lang", "source", "total", "terms", number.alias("place"))
    tiles = numbered.groupBy("lang").agg((F.max("place") / SOURCES).cast("int").alias("last_tile"))
    numbered = numbered.join(tiles, "lang").select("lang", "source", "total", "terms", (F.col("place") / SOURCES).cast("int").alias("tile"), "last_tile")
    spread = numbered.select("*", F.explode(F.expr(f"sequence(0L, greatest(terms - 1, 0L) DIV {TERMS}L)")).alias("block"))
    cells = counts.groupBy("lang", "source", F.expr(f"ordinal DIV {TERMS}L").alias("block")).agg(F.collect_list(F.struct(F.expr(f"CAST(ordinal % {TERMS} AS INT)").alias("at"), "n")).alias("cells"))
    rows = spread.join(cells, ["lang", "source", "block"], "left").withColumn("other", F.explode(F.expr("sequence(0, last_tile)")))
    rows = rows.select("lang", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "source", "total", "terms", "cells")

    def sums(key: tuple, table: pa.Table) -> pa.Table:
        lang, block, low, high = (k.as_py() for k in key)
        table = table.combine_chunks()
        source, tile = table["source"].to_pylist(), table["tile"].to_numpy()
        terms = table["terms"][0].as_py()
        width = min(TERMS, terms - block * TERMS) if terms else 0
        n = np.zeros((len(source), width), np.int64)
        cells = table["cells"].combine_chunks()
        flat, of = cells.flatten(), np.repeat(np.arange(len(source)), cells.value_lengths().fill_null(0).to_numpy())
        n[of, flat.field("at").to_numpy()] = flat.field("n").to_numpy()
        shares = _shares(n, (table["total"].to_numpy() + 2 * terms)[:, None]) if width else n
        left, right, value = [], [], []
        for k in np.flatnonzero(tile == low):
            others = [j for j in range(len(source)) if (tile[j] == high if low != high else source[j] > source[k])]
            apart = shares[k] - shares[others]
            value += (apart * apart // (shares[k] + shares[others])).sum(axis=1).tolist()
            left += [source[k]] * len(others)
            right += [source[j] for j in others]
        swap = [a > b for a, b in zip(left, right)]
        a = [r if s else x for s, x, r in zip(swap, left, right)]
        b = [x if s else r for s, x, r in zip(swap, left, right)]
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "value": pa.array(value, pa.int64())})

    tiled = rows.groupBy("lang", "block", "low", "high").applyInArrow(sums, "lang string, a string, b string, value bigint")
    return tiled.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergent_terms(groups: DataFrame, counts: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, ordinal, value, rank: terms more frequent in a source than in its language, the most divergent first.

    Equal values are ranked by ordinal, which is the byte order of the terms.
    """
    overall = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("lang_n"))
    totals = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    known = counts.join(overall, ["lang", "ordinal"]).join(groups, ["lang", "source"]).join(totals, "lang")
    shares = known.select("lang", "source", "ordinal", _share("n", "total", "terms").alias("p"), _share("lang_n", "lang_total", "terms").alias("q")).where("p > q")
    valued = shares.withColumn("value", F.expr("((p - q) * (p - q)) DIV (p + q)"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    return valued.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("lang", "source", "ordinal", "value", "rank")


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, source, part, item, value, rank: divergences between sources, and the terms behind them.

    Part ``pair`` gives for each source of a language every other one, part ``term`` its most
    divergent terms. A null text, lang or source is the empty string; every row is a document,
    repeated ones too. A term is kept if ``min_docs`` documents of its language have it; without kept
    terms all pairs are 0 and there are no terms. No rows in, no rows out.
    """
    rows = _text_rows(docs)
    kept = document_frequencies(rows).where(F.col("n_docs") >= min_docs)
    shards = build_shards(kept)
    counts = recount(rows, shards, block_bytes)
    sizes = shards.groupBy("lang").agg(F.sum("n_terms").alias("terms"))
    found = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(found, ["lang", "source"], "left").join(sizes, "lang", "left")
    zero = F.lit(0).cast("bigint")
    groups = materialise(groups.select("lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms")), "groups")

    sums = pair_sums(groups, counts)
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = sums.select("lang", ways.alias("way"), "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    terms = shards.select("lang", "base", F.posexplode("terms").alias("at", "item")).select("lang", (F.col("base") + F.col("at")).alias("ordinal"), "item")
    tops = divergent_terms(groups, counts, top).join(terms, ["lang", "ordinal"])
    return pairs.unionByName(tops.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
