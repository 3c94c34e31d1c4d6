"""Fuzzy line deduplication: MinHash over character shingles, exact verification, union-find.

A line is compared by its characters (bytes of UTF-8), A-Z lower-cased and white space collapsed. Signatures are
minima of permuted shingle hashes; bands of them propose pairs, which are verified by exact Jaccard
similarity of their shingles, and links are joined to components. One line of each component stays:
the first in the document with the smallest doc_id.

Most band keys belong to one line, and most lines stand in one document. Keys and lines are dealt by hash
in packs of arrays, and only those that meet another become rows. A filter of fixed size over the lines
that have shared keys keeps all others where they are: only lines with a possible partner travel with their text.
Of two lines in one band, sizes and sketches of their shingles are compared before their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.components import link_lists, within_reach
from seriesmill.llm.spans import LOWER, SKETCH_WORDS, SPACED, U, mix, slices, small_batches, span_hashes
from seriesmill.sources.tables import discard, materialise

SHINGLE, PERCENT = 7, 80
#: 10 bands of 4 minima find a pair of similarity 0.8 with probability 0.995, one of 0.85 with 0.9994.
BANDS, ROWS = 10, 4
#: Shorter lines have no shingle; they can only be equal.
MIN_CHARS = SHINGLE
#: Words of 64 bits in a filter; false positives cost time only.
FILTER_WORDS = 1 << 20
#: Lines for each part among which their band keys are dealt, as long as there are no more parts than shuffle partitions.
PART_LINES = 1 << 15
#: Shingles of verified lines that a task keeps.
HELD_SHINGLES = 4 << 20

_random = np.random.default_rng(8)
_XOR = _random.integers(0, 1 << 32, BANDS * ROWS, np.uint32)
_ODD = _random.integers(0, 1 << 32, BANDS * ROWS, np.uint32) | np.uint32(1)
_SPACE = ~SPACED  # white space, the line break included
_SPREAD = U(0x9E3779B97F4A7C15)


def _packed_shingles(chars: np.ndarray) -> np.ndarray:
    """Every SHINGLE consecutive characters as one number."""
    n = len(chars) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, U)
    two = chars[:-1].astype(U) | chars[1:].astype(U) << U(8)
    four = two[:-2] | two[2:] << U(16)
    return four[:n] | two[4 : n + 4] << U(32) | chars[6 : n + 6].astype(U) << U(48)


class Lines:
    """The lines of a slice of texts: normalised characters, and for each line its row, length and hash."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        rows = len(at) - 1
        space = _SPACE[data]
        breaks = np.flatnonzero(data == 10)
        # A row has one line more than line breaks.
        row_of = np.searchsorted(at, breaks, "right") - 1
        self.row = np.repeat(np.arange(rows), np.bincount(row_of, minlength=rows) + 1)
        starts, ends = np.sort(np.append(at[:-1], breaks + 1)), np.sort(np.append(at[1:], breaks))
        # Of white space, one character stays between others: not at a start, not behind another one.
        keep = np.ones(len(data), bool)
        keep[1:] = ~(space[1:] & space[:-1])
        opens = starts[starts < ends]
        keep[opens] = ~space[opens]
        keep[breaks] = False
        places = np.flatnonzero(keep)
        first, stop = np.searchsorted(places, starts), np.searchsorted(places, ends)
        # The one left over at the end of a line goes, too.
        last = places[stop[stop > first] - 1]
        over = last[space[last]]
        keep[over] = False
        self.chars = np.where(space, np.uint8(32), LOWER[data])[keep]
        self.first = first - np.searchsorted(over, starts)
        self.length = stop - np.searchsorted(over, ends) - self.first
        self.hash = span_hashes(self.chars, self.first, self.first + self.length).view(np.int64)
        self.long = np.flatnonzero(self.length >= MIN_CHARS)
        self.short = np.flatnonzero((self.length > 0) & (self.length < MIN_CHARS))

    def once(self, among: np.ndarray) -> np.ndarray:
        """The given lines by row and hash, of equal ones in a row one."""
        order = among[np.lexsort((self.hash[among], self.row[among]))]
        row, ids = self.row[order], self.hash[order]
        again = (row[1:] == row[:-1]) & (ids[1:] == ids[:-1])
        return order[np.append(True, ~again)[: len(order)]]

    def shingles(self, only: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """32-bit hashes of the shingles of the given lines one after another, and where each line starts."""
        size = self.length[only] - SHINGLE + 1
        starts = np.cumsum(size) - size
        hashes = (_packed_shingles(self.chars) * _SPREAD >> U(32)).astype(np.uint32)
        return hashes[np.repeat(self.first[only] - starts, size) + np.arange(size.sum())], starts

    def signatures(self, only: np.ndarray) -> np.ndarray:
        """Minima of all permutations, a row per line."""
        low, starts = self.shingles(only)
        out = np.zeros((len(only), BANDS * ROWS), np.uint32)
        for k in range(BANDS * ROWS):
            out[:, k] = np.minimum.reduceat((low ^ _XOR[k]) * _ODD[k], starts)
        return out

    def sets(self, only: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of distinct shingles of each of the given lines, and their parity sketch (``spans.parity_sketch``)."""
        packed = _packed_shingles(self.chars)
        sizes, sketches = np.zeros(len(only), np.int32), np.zeros((len(only), SKETCH_WORDS), np.int64)
        # A shingle has 56 bits: those of 256 lines are sorted as one number each, line first.
        for low in range(0, len(only), 256):
            some = only[low : low + 256]
            n = self.length[some] - SHINGLE + 1
            of = np.repeat(np.arange(len(some)), n)
            values = packed[np.repeat(self.first[some] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            both = np.sort(of.astype(U) << U(56) | values)
            both = both[np.append(True, both[1:] != both[:-1])]
            values, of = both & U((1 << 56) - 1), (both >> U(56)).astype(np.int64)
            sizes[low : low + 256] = np.bincount(of, minlength=len(some))
            bits = of * (64 * SKETCH_WORDS) + (values * _SPREAD >> U(55)).astype(np.int64)
            odd = (np.bincount(bits, minlength=64 * SKETCH_WORDS * len(some)) & 1).astype(np.uint8)
            sketches[low : low + 256] = np.packbits(odd, bitorder="little").view(np.int64).reshape(-1, SKETCH_WORDS)
        return sizes, sketches

    def texts(self, only: np.ndarray) -> list[str]:
        return [self.chars[a : a + n].tobytes().decode() for a, n in zip(self.first[only], self.length[only])]


def _band_keys(signatures: np.ndarray) -> np.ndarray:
    """One key per line and band."""
    keys = np.zeros((len(signatures), BANDS), U)
    for k in range(BANDS * ROWS):
        keys[:, k // ROWS] = mix(keys[:, k // ROWS] * U(3) + signatures[:, k] + U(k // ROWS))
    return keys.view(np.int64)


def _lines(texts: pa.Array) -> Iterator[tuple[int, int, Lines]]:
    for first, data, at in slices(texts, 1 << 18):
        yield first, len(at) - 1, Lines(data, at)


def _listed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


def _holder() -> Column:
    """The number by which a document is known and ordered: doc_id, or behind all of them one of the text where that is null."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64("text").bitwiseAND((1 << 61) - 1).bitwiseOR(F.lit(3 << 61)))


def _signed_lines(docs: DataFrame) -> DataFrame:
    """holder, ids (hashes of its distinct lines), keys (BANDS for each of them), short (hashes of lines without shingles) per row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, lines in _lines(batch.column(1)):
                order, short = lines.once(lines.long), lines.once(lines.short)
                row, ids = lines.row[order], lines.hash[order]
                distinct, one, which = np.unique(ids, return_index=True, return_inverse=True)
                keys = _band_keys(lines.signatures(order[one]))[which] if len(distinct) else np.zeros((0, BANDS), np.int64)
                counts = np.bincount(row, minlength=rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, rows), _listed(ids, counts), _listed(keys.ravel(), counts * BANDS), _listed(lines.hash[short], np.bincount(lines.row[short], minlength=rows))], ["holder", "ids", "keys", "short"])

    return materialise(docs.select(_holder().alias("holder"), "text").mapInArrow(sign, "holder bigint, ids array<bigint>, keys array<bigint>, short array<bigint>"), "signed-lines")


def _parts(signed: DataFrame) -> int:
    """Among how many parts lines are dealt by hash: a partition each, but no more than their number asks for."""
    spark = signed.sparkSession
    lines = signed.agg(F.sum(F.size("ids") + F.size("short"))).first()[0] or 0
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 16, -(-lines // PART_LINES)))


def _dealt(hashes: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that has some of these hashes, and which; ``_part`` says the same of a column."""
    part = ((hashes.view(U) >> U(40)) % U(parts)).astype(np.uint16)
    order = np.argsort(part, kind="stable")
    for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else ():
        yield int(part[some[0]]), some


def _part(hashes: str, parts: int) -> Column:
    return F.shiftrightunsigned(hashes, 40) % parts


def _packs(first: np.ndarray, second: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row for each part of the hashes ``first``, with those and what belongs to them."""
    rows = [(part, first[some].tobytes(), second[some].tobytes()) for part, some in _dealt(first, parts)]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["part", "first", "second"])


_PACKS = "part bigint, first binary, second binary"


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(table[c].to_pylist()), np.int64) for c in ("first", "second"))


def _with_company(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Which entries have a ``first`` that stands with two or more different ``second``."""
    order = np.argsort(first)
    ordered, beside = first[order], second[order]
    begins = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    if not len(begins):
        return np.zeros(0, np.int64)
    several = np.minimum.reduceat(beside, begins) < np.maximum.reduceat(beside, begins)
    return order[np.repeat(several, np.diff(begins, append=len(ordered)))]


def _entries(signed: DataFrame, parts: int) -> DataFrame:
    """key, id for every band key that two or more lines have; keys of the same lines are one.

    Lines that are similar share several bands: they would be compared, and weighed, in a list for each.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (np.asarray(batch.column(k).flatten()) for k in (0, 1))
            ids, one = np.unique(ids, return_index=True)
            yield _packs(keys.reshape(-1, BANDS)[one].ravel(), np.repeat(ids, BANDS), parts)

    def meet(table: pa.Table) -> pa.Table:
        keys, ids = _unpacked(table)
        shared = _with_company(keys, ids)
        shared = shared[np.lexsort((ids[shared], keys[shared]))]
        keys, ids = keys[shared], ids[shared]
        new = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))[: len(keys)]
        keys, ids = keys[new], ids[new]
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        names = mix(np.add.reduceat(mix(ids.view(U)), begins)).view(np.int64) if len(begins) else keys
        return pa.table({"key": np.repeat(names, np.diff(begins, append=len(keys))) if len(begins) else names, "id": ids})

    return signed.select("ids", "keys").mapInArrow(deal, _PACKS).groupBy("part").applyInArrow(meet, "key bigint, id bigint").distinct()


def _labelled(signed: DataFrame, linked: DataFrame, parts: int, short_lines: bool) -> DataFrame:
    """holder, id, label of the lines that stand in several documents or are similar to another one.

    The label of a line is its component, or else the line. All others have no company, and nothing to lose.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            holders, lists = np.asarray(batch.column(0)), [batch.column(k) for k in range(1, batch.num_columns)]
            of = np.concatenate([np.repeat(holders, np.asarray(x.value_lengths())) for x in lists])
            yield _packs(np.concatenate([np.asarray(x.flatten()) for x in lists]), of, parts)

    def label(table: pa.Table, links: pa.Table) -> pa.Table:
        ids, holders = _unpacked(table)
        labels, joined = ids.copy(), np.zeros(len(ids), bool)
        if len(links):
            known, component = links["id"].to_numpy(), links["component"].to_numpy()
            order = np.argsort(known)
            at = order[np.minimum(np.searchsorted(known, ids, sorter=order), len(known) - 1)]
            joined = known[at] == ids
            labels[joined] = component[at[joined]]
        joined[_with_company(ids, holders)] = True
        return pa.table({"holder": holders[joined], "id": ids[joined], "label": labels[joined]})

    packs = signed.select("holder", "ids", *["short"] * short_lines).mapInArrow(deal, _PACKS)
    placed = linked.select(_part("id", parts).alias("part"), "id", "component")
    return packs.groupBy("part").cogroup(placed.groupBy("part")).applyInArrow(label, "holder bigint, id bigint, label bigint")


def _filter_of(values: DataFrame) -> np.ndarray:
    """A bit for the low bits of every value of the one column: at most ``FILTER_WORDS`` rows reach the driver."""
    value = F.col(values.columns[0])
    bit = value.bitwiseAND(64 * FILTER_WORDS - 1)
    ones = F.expr(f"shiftleft(1L, CAST(`{values.columns[0]}` & 63 AS INT))")
    words = values.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(ones).alias("bits")).toArrow()
    out = np.zeros(FILTER_WORDS, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def _in_filter(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (bits[(values & (64 * FILTER_WORDS - 1)) >> 6] >> (values & 63)) & 1 == 1


def _line_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id, size (distinct shingles), sketch of those, text of the lines with these ids."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(ids))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, lines in _lines(batch.column(0)):
                _, one = np.unique(lines.hash[lines.long], return_index=True)
                only = lines.long[one]
                only = only[_in_filter(shared.value, lines.hash[only])]
                sizes, sketches = lines.sets(only)
                columns = [pa.array(lines.hash[only]), pa.array(sizes), _listed(sketches.ravel(), np.full(len(only), SKETCH_WORDS)), pa.array(lines.texts(only), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "size", "sketch", "text"])

    found = docs.select("text").mapInArrow(emit, "id bigint, size int, sketch array<bigint>, text string")
    return materialise(found.join(ids, "id", "left_semi").dropDuplicates(["id"]), "lines")


def _shingle_set(text: str) -> np.ndarray:
    return np.unique(_packed_shingles(np.frombuffer(text.encode(), np.uint8)))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A pivot meets many lines one after another: its shingles are sorted once.
        sets: dict[int, np.ndarray] = {}
        held = 0

        def of(line: int, text: pa.StringScalar) -> np.ndarray:
            nonlocal held
            if line not in sets:
                if held > HELD_SHINGLES:
                    sets.clear()
                    held = 0
                sets[line] = _shingle_set(text.as_py())
                held += len(sets[line])
            return sets[line]

        for batch in batches:
            kept = []
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for k in range(len(batch)):
                x, y = of(a[k], batch.column(2)[k]), of(b[k], batch.column(3)[k])
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                if 100 * shared >= PERCENT * (len(x) + len(y) - shared):
                    kept.append(k)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    left, right = texts.select(F.col("id").alias("a"), F.col("text").alias("x")), texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(test, "a bigint, b bigint")


def line_components(docs: DataFrame, signed: DataFrame | None = None) -> DataFrame:
    """id (line hash), component for every line that is similar to a different one."""
    signed = _signed_lines(docs) if signed is None else signed
    entries = materialise(_entries(signed, _parts(signed)), "shared-entries")
    lines = _line_texts(docs, entries.select("id").distinct())
    bands = entries.groupBy("id").agg(F.collect_set("key").alias("keys"))  # at most BANDS
    lists = entries.join(lines.select("id", "size", "sketch").join(bands, "id"), "id")
    texts = lines.select("id", "text")
    linked = link_lists(lists, lambda x, y: within_reach(x, y, PERCENT), lambda pairs: _verified(pairs, texts))
    discard(entries, lines)
    return linked


def _dropped(lines: Lines, shared: pa.ListArray, least: int) -> np.ndarray:
    """Which lines go: those of a label that another document keeps, and those whose label stood before in their text.

    ``shared`` lists for each row the lines (id, label, own) that have company; any other line is its own label.
    """
    flat, of = shared.flatten(), np.repeat(np.arange(len(shared)), shared.value_lengths().fill_null(0).to_numpy())
    ids, labels = (flat.field(c).to_numpy() for c in ("id", "label"))
    own = np.array(flat.field("own"), bool)
    whole = np.flatnonzero(lines.length >= least)

    def in_row(row: np.ndarray, value: np.ndarray) -> np.ndarray:
        return mix(value.view(U) ^ mix(row.astype(U) + U(1)))

    label, kept = lines.hash[whole].copy(), np.ones(len(whole), bool)
    if len(ids):
        known = in_row(of, ids)
        order = np.argsort(known)
        asked = in_row(lines.row[whole], lines.hash[whole])
        at = np.minimum(np.searchsorted(known, asked, sorter=order), len(known) - 1)
        hit = known[order[at]] == asked
        label[hit], kept[hit] = labels[order[at[hit]]], own[order[at[hit]]]
    first = np.zeros(len(whole), bool)
    first[np.unique(in_row(lines.row[whole], label), return_index=True)[1]] = True
    drop = np.zeros(len(lines.row), bool)
    drop[whole] = ~(kept & first)
    return drop


def dedup_lines(docs: DataFrame, short_lines: bool = True) -> DataFrame:
    """``docs`` with duplicate lines taken out of ``text``, and the columns n_lines, n_removed.

    Lines of fewer than ``MIN_CHARS`` bytes go where their normalised text is equal, or with
    ``short_lines=False`` stay; a line without any visible character always stays. A null text stays
    null and has no line; an empty one has one empty line. Rows of one doc_id (a whole number) are one
    document, whose repeated rows come out alike; rows without a doc_id are documents by their text,
    behind all others. Other columns pass through; existing columns named n_lines or n_removed are replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c not in ("n_lines", "n_removed")])
    signed = _signed_lines(docs)
    least = 1 if short_lines else MIN_CHARS
    linked = line_components(docs, signed)
    labelled = materialise(_labelled(signed, linked, _parts(signed), short_lines), "labelled")
    discard(signed, linked)
    owners = labelled.groupBy("label").agg(F.min("holder").alias("owner"), F.max("holder").alias("other"), F.min("id").alias("one"), F.max("id").alias("another"))
    owners = owners.where("owner < other OR one < another").select("label", "owner")
    # Repeated rows of a document add nothing to the set of its shared lines.
    shared = labelled.join(owners, "label").groupBy("holder").agg(F.collect_set(F.struct("id", "label", (F.col("owner") == F.col("holder")).alias("own"))).alias("lines"))
    names = docs.columns
    spare = next(c for c in (f"shared_lines{n}" for n in range(len(names) + 1)) if c not in names)
    joined = docs.join(shared.withColumnsRenamed({"holder": f"{spare}_of", "lines": spare}), _holder() == F.col(f"{spare}_of"), "left").select(*[F.col(f"`{c}`") for c in names], spare)
    at_text = names.index("text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + ["n_lines bigint", "n_removed bigint"]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, lines in _lines(batch.column(at_text)):
                part = batch.slice(first, rows)
                drop = _dropped(lines, part.column(len(names)), least)
                texts = part.column(at_text)
                removed = np.bincount(lines.row, drop, rows).astype(np.int64)
                begins = np.searchsorted(lines.row, np.arange(rows + 1))
                changed = np.flatnonzero(removed)
                if len(changed):
                    left = []
                    for r in changed:
                        gone = drop[begins[r] : begins[r + 1]]
                        left.append("\n".join(x for x, g in zip(texts[r].as_py().split("\n"), gone) if not g))
                    texts = pc.replace_with_mask(texts, pa.array(removed > 0), pa.array(left, texts.type))
                counts = np.where(np.array(part.column(at_text).is_null()), 0, np.diff(begins)), removed
                columns = [texts if k == at_text else part.column(k) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, counts)], [*names, "n_lines", "n_removed"])

    return joined.mapInArrow(clean, ", ".join(fields))
