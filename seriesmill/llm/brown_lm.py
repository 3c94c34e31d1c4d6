"""Class-based n-gram language model: exchange clustering, class transitions, word emissions.

Words are assigned to classes so that the class of a word tells as much as possible about the class of
the next (Brown et al., Class-based n-gram models of natural language, 1992; Martin et al., Algorithms
for bigram and trigram word clustering, 1998). The probability of a word is that of its class after
the last class, times that of the word in its class.

Every word of the training text takes part as itself, however rare. Words begin in an even
spread over the classes and are exchanged in rounds of two halves: before each half it is counted anew, over all training
text, which classes stand left and right of each word, and the words of that half move to the class that
gains most, with all other words held where they are. Moves that lower the likelihood together are
undone and tried with fewer words at once. Rounds go on until one raises the likelihood of
the class bigrams by less than ``TOLERANCE``. A word that training text does not have takes the class
that most training words of its ending have.

Which words stand beside each word is counted once, first in blocks, and dealt to parts by word: a table
that stays where it is. A part keeps the class of every word that it has, chooses for its own words
with nothing but the bigrams of classes at hand, and sends those that move, as a hash and a class, to
the parts where they are neighbours. A frequent word lies in all parts; its counts of classes are summed and it is
moved by the driver, which has these, the bigrams and the classes of endings, all of fixed size.

Text is read into blocks of documents with the block's own vocabulary. Word counts are summed by word
and return to each block as numbers in the order of its vocabulary, so that scoring needs no table of
all words in any one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.spans import LOWER, SPACED, U, mix, slices, span_hashes, word_spans
from seriesmill.session import shared_folder
from seriesmill.sources.tables import discard, materialise, same_folder

ENDINGS, CLASSES = 4096, 64
#: The end of a text and what stands before its first word, each a class of its own.
END_CLASS, START_CLASS = CLASSES, CLASSES + 1
WIDE = CLASSES + 2
#: A word with more than one in FREQUENT of all tokens, as blocks where it is frequent count it, is spread over all parts.
FREQUENT = 128
#: A round that raises the mean log-likelihood of a token (natural logarithm) by less than this is the last.
TOLERANCE = 0.002
#: Words of a half that move at once: all, or a quarter as many after moves that lower the likelihood together, down to this share.
LEAST_SHARE = 1 / 16
ADD = 0.1
BLOCK_BYTES = 8 << 20
#: Tokens for each part of the exchange, as long as there are no more parts than shuffle partitions.
PART_TOKENS = 1 << 20
#: Tokens of whole documents that are scored at once.
SCORED_TOKENS = 1 << 17
END_HASH, START_HASH = np.int64(0x454E44), np.int64(0x535441)


def held_out_document(doc_id) -> F.Column:
    """True for the tenth of documents that is never learnt from; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def _ending(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One of ENDINGS numbers for the last three bytes of each word."""
    out = np.zeros(len(starts), U)
    for k in (1, 2, 3):
        inside = ends - k >= starts
        out = out * U(257) + np.where(inside, data[np.maximum(ends - k, 0)], 0).astype(U) + U(1)
    return (mix(out) % U(ENDINGS)).astype(np.int32)


def _packed(places: np.ndarray) -> bytes:
    """Numbers byte by byte, compressed: frequent words have small numbers, so that the higher bytes are mostly 0."""
    return zstandard.ZstdCompressor(level=3).compress(places.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    out = planes[0].astype(np.uint32)
    for k in (1, 2, 3):
        if planes[k].any():
            out |= planes[k].astype(np.uint32) << np.uint32(8 * k)
    return out.view(np.int32)


def _blocks(docs: DataFrame) -> DataFrame:
    """block, docs (doc_ids, trains, lengths), words (places in the vocabulary), vocabulary with counts and endings.

    ``docs`` has doc_id, trains, text. Counts are those of training documents. The vocabulary has the
    block's most frequent word first and the end of text last.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block bigint, doc_ids array<{kind}>, trains array<boolean>, lengths array<int>, words binary, vocabulary array<bigint>, counts array<bigint>, endings array<smallint>"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            trains = np.array(batch.column(1))
            for first, data, at in slices(batch.column(2), BLOCK_BYTES):
                rows = len(at) - 1
                keys, endings, row = [], [], []
                for low, part, inner in _runs(data, at):
                    lower = LOWER[part]
                    starts, ends, of = word_spans(lower, inner, SPACED)
                    keys.append(span_hashes(lower, starts, ends).view(np.int64))
                    endings.append(_ending(lower, starts, ends))
                    row.append(of + low)
                keys, endings, row = np.concatenate(keys), np.concatenate(endings), np.concatenate(row)
                order, at_first = _equal(keys)
                one = order[at_first]
                vocabulary, place = keys[one], np.empty(len(keys), np.int64)
                place[order] = np.repeat(np.arange(len(one)), np.diff(at_first, append=len(keys)))
                by_frequency = np.argsort(-np.bincount(place, minlength=len(vocabulary)), kind="stable")
                vocabulary, one = vocabulary[by_frequency], one[by_frequency]
                rank = np.empty(len(vocabulary), np.int32)
                rank[by_frequency] = np.arange(len(vocabulary), dtype=np.int32)
                place = rank[place]
                counts = np.bincount(place, trains[first + row], len(vocabulary)).astype(np.int64)
                lengths = np.bincount(row, minlength=rows).astype(np.int32)
                own = trains[first : first + rows]

                def listed(values, kind=None):
                    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, kind))

                columns = [pa.array([number], pa.int64()), listed(batch.column(0).slice(first, rows)), listed(own), listed(lengths), pa.array([_packed(place)], pa.binary()), listed(np.append(vocabulary, END_HASH)), listed(np.append(counts, own.sum())), listed(np.append(endings[one], 0).astype(np.int16))]
                yield pa.RecordBatch.from_arrays(columns, ["block", "doc_ids", "trains", "lengths", "words", "vocabulary", "counts", "endings"])
                number += 1

    return docs.select("doc_id", "trains", "text").mapInArrow(build, schema)


def _runs(data: np.ndarray, at: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of a slice."""
    first, rows = 0, len(at) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def _values(column: pa.Array, k: int) -> np.ndarray:
    return np.asarray(column[k].values)


def _sequence(words: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the vocabulary of all tokens, the end after each document, and which are first."""
    stops = np.cumsum(lengths)
    tokens = np.insert(words, stops, end)
    first = np.zeros(len(tokens), bool)
    first[np.append(0, stops + np.arange(1, len(stops) + 1))[:-1]] = True
    return tokens, first


def start_class(words: np.ndarray) -> np.ndarray:
    """An even spread over all classes."""
    return (mix(words.astype(U) + U(3)) % U(CLASSES)).astype(np.int64)


def _in_turn(words: np.ndarray, half: int, share: float, turn: int) -> np.ndarray:
    """Which words may move: those of a half, or another share of them each turn."""
    spread = mix(words.view(U) + U(7))
    return (spread % U(2) == half) & ((mix(spread + U(turn)) >> U(44)).astype(float) < share * (1 << 20)) & (words != END_HASH) & (words != START_HASH)


def _partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def delete_folder(spark, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _part_keys(spark, n: int) -> np.ndarray:
    """For each of ``n`` partitions one number that hash partitioning sends there."""
    found = spark.range(32 * n).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("partition")).agg(F.min("id").alias("key")).orderBy("partition").toArrow()
    return found["key"].to_numpy()


def _keys_for(blocks: DataFrame) -> np.ndarray:
    """Keys of parts, a partition each: as many as tokens ask for, since each part may send moves to each other."""
    spark = blocks.sparkSession
    tokens = blocks.select(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n")).agg(F.sum("n")).first()[0] or 0
    number = _partitions(spark)
    return _part_keys(spark, number)[: max(1, min(number, -(-tokens // PART_TOKENS)))]


def _home(words: np.ndarray, parts: int) -> np.ndarray:
    return (mix(words.view(U) + U(11)) % U(parts)).astype(np.int64)


def _frequent_words(blocks: DataFrame) -> np.ndarray:
    """Hashes in order: the end of a text, and words that blocks where they are frequent make frequent in all; at most FREQUENT + 1.

    A word with more than two in FREQUENT of all training tokens is surely one of them.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words, n = _values(batch.column("vocabulary"), k), _values(batch.column("counts"), k)
                often = np.flatnonzero(n * FREQUENT > n.sum())
                yield pa.RecordBatch.from_arrays([pa.array(words[often]), pa.array(n[often])], ["word", "n"])

    tokens = blocks.select(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n")).agg(F.sum("n")).first()[0] or 0
    counted = blocks.select("vocabulary", "counts").mapInArrow(emit, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return np.unique(np.append(counted.where(F.col("n") * FREQUENT > tokens).select("word").toArrow()["word"].to_numpy(), END_HASH))


def _rows(schema: str, rows: list[tuple]) -> dict[str, list]:
    """Columns by name; a schema's fields are named and typed as in Spark's DDL."""
    return {field.split()[0]: [row[k] for row in rows] for k, field in enumerate(schema.split(", "))}


_KINDS = {"bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    return pa.table(_rows(schema, rows), pa.schema([(name, _KINDS[kind]) for name, kind in map(str.split, schema.split(", "))]))


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(_rows(schema, rows), pa.schema([(name, _KINDS[kind]) for name, kind in map(str.split, schema.split(", "))]))


def _numbers(column: pa.Array, k: int, kind=np.int64) -> np.ndarray:
    data = column[k].as_py()
    return np.frombuffer(b"" if data is None else data, kind)


_ASKED = "part bigint, block bigint, words binary, places binary, n binary, endings binary"


def _asked(blocks: DataFrame, keys: np.ndarray, known: bool) -> DataFrame:
    """Of each block the words that each part is home to, with their places there; ``known``: only those of training text."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, block in enumerate(batch.column("block").to_pylist()):
                words, n, endings = (_values(batch.column(c), k) for c in ("vocabulary", "counts", "endings"))
                home = np.where(n > 0, _home(words, len(keys)), -1) if known else _home(words, len(keys))
                order = np.argsort(home, kind="stable")
                bounds = np.searchsorted(home[order], np.arange(len(keys) + 1))
                rows = []
                for p in np.flatnonzero(np.diff(bounds)):
                    at = order[bounds[p] : bounds[p + 1]]
                    rows.append((keys[p], block, words[at].tobytes(), _packed(at), _packed(n[at]), endings[at].tobytes()))
                yield _batch(_ASKED, rows)

    return blocks.select("block", "vocabulary", "counts", "endings").mapInArrow(send, _ASKED)


_NUMBERED = "part bigint, block bigint, places binary, numbers binary, words binary, n binary, endings binary"


def _numbered(blocks: DataFrame, keys: np.ndarray) -> DataFrame:
    """The training words of a part, with their numbers and counts, in a row without a block, and of each block the numbers there.

    A number tells the part that is home to the word, and its first class; 0 is the start of a text.
    Words that training text has more often have smaller ones. Numbers stand for places, 64 bits for
    a word are sent but once a block.
    """
    parts = len(keys)

    def number(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        here = int(np.flatnonzero(keys == part)[0])
        asked = table.combine_chunks().to_batches()[0]
        blocks = asked.column("block").to_pylist()
        of = [_numbers(asked.column("words"), k) for k in range(len(blocks))]
        order, first = _equal(words := np.concatenate(of))
        n = np.add.reduceat(np.concatenate([_unpacked(asked.column("n")[k].as_py()) for k in range(len(blocks))]).astype(np.int64)[order], first)
        endings = np.concatenate([_numbers(asked.column("endings"), k, np.int16) for k in range(len(blocks))])[order[first]]
        words = words[order[first]]
        # Of each first class the most frequent word is the first.
        kind = start_class(words)
        by_class = np.lexsort((-n, kind))
        rank = np.empty(len(words), np.int64)
        rank[by_class] = np.arange(len(words)) - np.searchsorted(kind[by_class], kind[by_class])
        numbers = 1 + (rank * CLASSES + kind) * parts + here
        rows = []
        for k, block in enumerate(blocks):
            found = numbers[np.searchsorted(words, of[k])]
            rows.append((part, block, asked.column("places")[k].as_py(), _packed(found // parts), None, None, None))
        by_number = np.argsort(numbers)
        rows.append((part, None, None, _gaps(numbers[by_number]), words[by_number].tobytes(), n[by_number].tobytes(), endings[by_number].tobytes()))
        return _table(_NUMBERED, rows)

    return materialise(_asked(blocks, keys, True).groupBy("part").applyInArrow(number, _NUMBERED), "word-numbers")


def _equal(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the values, and where equal ones begin in it."""
    order = np.argsort(values)
    ordered = values[order]
    return order, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])


def _gaps(numbers: np.ndarray) -> bytes:
    """Rising numbers, packed by what each has more than the one before."""
    return _packed(np.diff(numbers, prepend=0))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data).view(np.uint32), dtype=np.int64)


def _home_of(numbers: np.ndarray, parts: int) -> np.ndarray:
    return (numbers - 1) % parts


def _first_class(numbers: np.ndarray, parts: int, end: int) -> np.ndarray:
    return np.select([numbers == 0, numbers == end], [START_CLASS, END_CLASS], (numbers - 1) // parts % CLASSES)


def _frequent_numbers(numbered: DataFrame, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers of the frequent words of training text, rising, and that of the end of a text (-1 if there is no training text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words = _numbers(batch.column("words"), k)
                often = np.isin(words, frequent)
                yield pa.RecordBatch.from_arrays([pa.array(words[often]), pa.array(_risen(batch.column("numbers")[k].as_py())[often])], ["word", "number"])

    table = numbered.where("block IS NULL").select("words", "numbers").mapInArrow(find, "word bigint, number bigint").toArrow().sort_by("number")
    words, numbers = (table[c].to_numpy() for c in ("word", "number"))
    return words, numbers, int(numbers[words == END_HASH][0]) if len(numbers) else -1


_EDGES = "part bigint, words binary, numbers binary, own binary, beside binary, n binary"


def _edges_of(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, ...]:
    """Numbers of words, rising; of each edge the place of the word, twice that of the one beside it and 1 if that is behind, and how often."""
    return _risen(batch.column("numbers")[k].as_py()), *(_unpacked(batch.column(c)[k].as_py()) for c in ("own", "beside", "n"))


def _parts(blocks: DataFrame, numbered: DataFrame, keys: np.ndarray, often: np.ndarray) -> tuple[DataFrame, str, str]:
    """A table of every training word with what stands beside it, a row per part, stored by part; its name and folder.

    A word lies in one part with all its neighbours, but a frequent one (``often``: their numbers), and
    the end of a text, in that of each neighbour. Pairs of words are counted in each block before they
    are sent. ``words`` has the hashes of the words that the part is home to.
    """
    spark = blocks.sparkSession
    parts = len(keys)
    sent_schema = _EDGES.replace("words binary, ", "")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lengths, size = _values(batch.column("lengths"), k), batch.column("size")[k].as_py()
                number = np.zeros(size + 1, np.int64)
                known = batch.column("known")[k].values
                for j, part in enumerate(known.field("part").to_pylist()):
                    here = int(np.flatnonzero(keys == part)[0])
                    found = _unpacked(known.field("numbers")[j].as_py()).view(np.uint32).astype(np.int64) * parts
                    number[_unpacked(known.field("places")[j].as_py())] = found + (here + 1 if here + 1 < parts else 0)
                tokens, first = _sequence(_unpacked(batch.column("words")[k].as_py()), lengths, size - 1)
                last = np.append(size, tokens[:-1])
                last[first] = size
                train = np.repeat(_values(batch.column("trains"), k), lengths + 1)
                pairs, n = np.unique(last[train].astype(np.int64) * (size + 1) + tokens[train], return_counts=True)
                left, right = np.divmod(pairs, size + 1)
                order = np.argsort(number, kind="stable")
                number, rank = number[order], np.argsort(order)
                left, right, start = rank[left], rank[right], rank[size]
                behind = left != start
                own, beside, n = np.append(right, left[behind]), np.append(2 * left, 2 * right[behind] + 1), np.append(n, n[behind])
                home = _home_of(number, parts)
                part = np.where(np.isin(number, often)[own], home[beside >> 1], home[own])
                # The end of a text that is empty stands beside nothing but the start, which has no part.
                part = np.where(beside >> 1 == start, home[own], part)
                by_part = np.argsort(part, kind="stable")
                own, beside, n = own[by_part], beside[by_part], n[by_part]
                bounds = np.searchsorted(part[by_part], np.arange(parts + 1))
                place = np.zeros(len(number), np.int64)
                for p in np.flatnonzero(np.diff(bounds)):
                    a, b = bounds[p], bounds[p + 1]
                    used = np.zeros(len(number), bool)
                    used[own[a:b]] = used[beside[a:b] >> 1] = True
                    here = np.flatnonzero(used)
                    place[here] = np.arange(len(here))
                    yield _batch(sent_schema, [(keys[p], _gaps(number[here]), _packed(place[own[a:b]]), _packed(2 * place[beside[a:b] >> 1] + (beside[a:b] & 1)), _packed(n[a:b]))])

    def gather(key: tuple, table: pa.Table, own_words: pa.Table) -> pa.Table:
        part = key[0].as_py()
        if not len(table):
            return _table(_EDGES, [])
        here = int(np.flatnonzero(keys == part)[0])
        rows = table.combine_chunks().to_batches()[0]
        numbers = np.unique(np.concatenate([_risen(rows.column("numbers")[k].as_py()) for k in range(len(rows))]))
        keyed, counts = [], []
        for k in range(len(rows)):
            there, own, beside, n = _edges_of(rows, k)
            place = np.searchsorted(numbers, there)
            keyed.append(place[own] * (2 * len(numbers)) + 2 * place[beside >> 1] + (beside & 1))
            counts.append(n)
        keyed = np.concatenate(keyed)
        order, first = _equal(keyed)
        own, beside = np.divmod(keyed[order[first]], 2 * len(numbers))
        n = np.add.reduceat(np.concatenate(counts)[order], first, dtype=np.int64)
        dictionary = own_words.combine_chunks().to_batches()[0]
        at_home = numbers[(numbers > 0) & (_home_of(numbers, parts) == here)]
        words = _numbers(dictionary.column("words"), 0)[np.searchsorted(_risen(dictionary.column("numbers")[0].as_py()), at_home)] if len(at_home) else at_home
        return _table(_EDGES, [(part, words.tobytes(), _gaps(numbers), *map(_packed, (own, beside, n)))])

    replies = numbered.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("part", "places", "numbers")).alias("known"))
    asked = blocks.select("block", "trains", "lengths", "words", F.size("vocabulary").alias("size")).join(replies, "block")
    sent = asked.mapInArrow(send, sent_schema)
    path = shared_folder(spark, "word-neighbours")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    dictionary = numbered.where("block IS NULL").select("part", "numbers", "words")
    gathered = sent.groupBy("part").cogroup(dictionary.groupBy("part")).applyInArrow(gather, _EDGES)
    number = _partitions(spark)
    gathered.repartition(number, "part").write.format("parquet").bucketBy(number, "part").sortBy("part").option("path", path).saveAsTable(name)
    return spark.table(name), name, path


def _stored(classes: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(classes.astype(np.uint8).tobytes())


def _classes(batch: pa.RecordBatch, k: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column("classes")[k].as_py()), np.uint8).astype(np.int64)


_STATE = "part bigint, classes binary, cells array<bigint>, n array<bigint>"


def _state(rows: DataFrame, parts: int, often: np.ndarray, own: np.ndarray, end: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Classes of each part after its ``moves``, or at first; class bigrams of the training text (rows: class before), and for each frequent word the classes before and behind it.

    ``often`` are the numbers of the frequent words and ``own`` their classes.
    """
    size = WIDE * WIDE + len(often) * 2 * WIDE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, part in enumerate(batch.column("part").to_pylist()):
                numbers, place, beside, n = _edges_of(batch, k)
                if "moves" in batch.schema.names:
                    classes = _classes(batch, k)
                    for moves in batch.column("moves")[k].as_py() or ():
                        classes[np.searchsorted(numbers, _risen(moves["numbers"]))] = np.frombuffer(moves["classes"], np.uint8)
                else:
                    classes = _first_class(numbers, parts, end)
                at = np.minimum(np.searchsorted(numbers, often), len(numbers) - 1)
                hit = numbers[at] == often
                classes[at[hit]] = own[hit]
                word = np.full(len(numbers), -1)
                word[at[hit]] = np.flatnonzero(hit)
                near, before = classes[beside >> 1], beside & 1 == 0
                total = np.zeros(size)
                total[: WIDE * WIDE] = np.bincount(near[before] * WIDE + classes[place[before]], n[before], WIDE * WIDE)
                of = word[place]
                edges = np.flatnonzero(of >= 0)
                cell = (of[edges] * 2 + (beside[edges] & 1)) * WIDE + near[edges]
                total[WIDE * WIDE :] = np.bincount(cell, n[edges], size - WIDE * WIDE)
                cells = np.flatnonzero(total)
                yield _batch(_STATE, [(part, _stored(classes), cells, total[cells].astype(np.int64))])

    written = materialise(rows.mapInArrow(count, _STATE), "word-classes")
    summed = written.select(F.explode(F.arrays_zip("cells", "n")).alias("x")).groupBy("x.cells").agg(F.sum("x.n").alias("n")).toArrow()
    out = np.zeros(size)
    out[summed["cells"].to_numpy()] = summed["n"].to_numpy()
    return same_folder(written.select("part", "classes"), written), out[: WIDE * WIDE].reshape(WIDE, WIDE), out[WIDE * WIDE :].reshape(-1, 2, WIDE)


def _empty_classes(bigrams: np.ndarray) -> np.ndarray:
    """A class of its own would suit every word, so that all words at once would leave for an empty one."""
    return ~bigrams[:CLASSES].any(axis=1)


_MOVES = "part bigint, numbers binary, classes binary"


def _moves(at: DataFrame, bigrams: np.ndarray, keys: np.ndarray, often: np.ndarray, half: int, share: float, turn: int) -> DataFrame:
    """part, numbers and classes of the words that change their class, for each part that has them."""
    shared = at.sparkSession.sparkContext.broadcast(bigrams)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = _empty_classes(shared.value)
        for batch in batches:
            for k, part in enumerate(batch.column("part").to_pylist()):
                numbers, own, beside, n = _edges_of(batch, k)
                classes = _classes(batch, k)
                here = int(np.flatnonzero(keys == part)[0])
                home, frequent = _home_of(numbers, len(keys)), np.isin(numbers, often)
                at_home = np.flatnonzero((home == here) & (numbers > 0))
                movers = at_home[_in_turn(_numbers(batch.column("words"), k), half, share, turn) & ~frequent[at_home]]
                new = classes.copy()
                for low in range(0, len(movers), 1024):
                    some = movers[low : low + 1024]
                    a, b = np.searchsorted(own, np.array([some[0], some[-1] + 1], own.dtype))
                    row = np.full(some[-1] + 1 - some[0], -1)
                    row[some - some[0]] = np.arange(len(some))
                    row = row[own[a:b] - some[0]]
                    used = row >= 0
                    near = beside[a:b][used]
                    cell = (row[used] * 2 + (near & 1)) * WIDE + classes[near >> 1]
                    counts = np.bincount(cell, n[a:b][used], len(some) * 2 * WIDE).reshape(-1, 2, WIDE)
                    new[some] = best_classes(counts[:, 0], counts[:, 1], classes[some], shared.value, empty)
                changed = new != classes
                # Edges go both ways: who stands beside a word has it among its own neighbours. Frequent words have it here; the start of a text has none.
                to = np.where(frequent | (numbers == 0), here, home)
                edges = np.flatnonzero(changed[own])
                sent = np.unique(np.append(to[beside[edges] >> 1] * len(numbers) + own[edges], here * len(numbers) + np.flatnonzero(changed)))
                target, place = np.divmod(sent, len(numbers))
                target, first = np.unique(target, return_index=True)
                rows = [(keys[p], _gaps(numbers[x]), new[x].astype(np.uint8).tobytes()) for p, x in zip(target, np.split(place, first[1:]))]
                yield _batch(_MOVES, rows)

    return at.mapInArrow(choose, _MOVES)


_CLASSED = "part bigint, word bigint, n bigint, ending smallint, class smallint"


def exchange(blocks: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """part, word, n, ending and class of every training word, and the class bigrams, of the greatest likelihood that was reached.

    Words are numbered by part, and their neighbours are counted and dealt to parts, once, in a table of
    the shared folder that is stored by part; a turn reads it there and moves nothing but classes.
    """
    spark = blocks.sparkSession
    keys = _keys_for(blocks)
    numbered = _numbered(blocks, keys)
    words, often, end = _frequent_numbers(numbered, _frequent_words(blocks))
    parts, name, path = _parts(blocks, numbered, keys, often)
    try:
        state, own, bigrams = _exchanged(parts, keys, words, often, end)

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k, part in enumerate(batch.column("part").to_pylist()):
                    numbers, found = _risen(batch.column("numbers")[k].as_py()), np.zeros(0, np.int64)
                    classes = _first_class(numbers, len(keys), end)
                    if batch.column("classes")[k].is_valid:
                        found = _risen(batch.column("found")[k].as_py())
                        at = np.minimum(np.searchsorted(found, numbers), len(found) - 1)
                        classes = np.where(found[at] == numbers, _classes(batch, k)[at], classes)
                    at = np.minimum(np.searchsorted(often, numbers), len(often) - 1)
                    classes = np.where(often[at] == numbers, own[at], classes)
                    columns = [np.full(len(numbers), part), _numbers(batch.column("words"), k), _numbers(batch.column("n"), k), _numbers(batch.column("endings"), k, np.int16), classes.astype(np.int16)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["part", "word", "n", "ending", "class"])

        dictionary = numbered.where("block IS NULL").select("part", "numbers", "words", "n", "endings")
        placed = parts.select("part", F.col("numbers").alias("found")).join(state, "part")
        out = materialise(dictionary.join(placed, "part", "left").mapInArrow(listed, _CLASSED), "classes-of-words")
        discard(state, numbered)
        return out, bigrams
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_folder(spark, path)


def _exchanged(parts: DataFrame, keys: np.ndarray, frequent: np.ndarray, often: np.ndarray, end: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """State by part, classes of the frequent words (their hashes and numbers), class bigrams."""
    edges = parts.drop("words")
    own = _first_class(often, len(keys), end)
    state, bigrams, beside = _state(edges, len(keys), often, own, end)
    most = before = class_information(bigrams)
    half, share, turn = 0, 1.0, 0
    while bigrams.any():
        turn += 1
        movers = np.flatnonzero(_in_turn(frequent, half, share, turn))
        next_own = own.copy()
        next_own[movers] = best_classes(beside[movers, 0], beside[movers, 1], own[movers], bigrams, _empty_classes(bigrams))
        # At most one row from each part; all moves of a part are fewer than its words.
        moves = _moves(parts.join(state, "part"), bigrams, keys, often, half, share, turn)
        gathered = moves.groupBy("part").agg(F.collect_list(F.struct("numbers", "classes")).alias("moves"))
        moved, found, around = _state(edges.join(state, "part").join(gathered, "part", "left"), len(keys), often, next_own, end)
        if (now := class_information(found)) > most:
            discard(state)
            state, own, bigrams, beside, most = moved, next_own, found, around, now
        else:
            discard(moved)
            if share > LEAST_SHARE:
                # Together the moves did harm: none of them is made, and fewer words move at once.
                share /= 4
                continue
        if half:
            if most - before < TOLERANCE:
                break
            before = most
        half, share = 1 - half, 1.0
    return state, own, bigrams


def _entropy(n: np.ndarray) -> np.ndarray:
    return n * np.log(np.maximum(n, 1))


def _gain(base: np.ndarray, n: np.ndarray) -> np.ndarray:
    return _entropy(base + n) - _entropy(base)


def class_information(bigrams: np.ndarray) -> float:
    """What class bigrams (rows: class before) add to the mean log-likelihood of a token over its frequency."""
    total = bigrams.sum()
    gain = _entropy(bigrams).sum() - _entropy(bigrams.sum(axis=0)).sum() - _entropy(bigrams.sum(axis=1)).sum()
    return float((gain + _entropy(total)) / max(total, 1))


def best_classes(left: np.ndarray, right: np.ndarray, classes: np.ndarray, bigrams: np.ndarray, barred: np.ndarray | None = None) -> np.ndarray:
    """The class of each row (counts of classes before and behind it) where the bigram likelihood gains most, all others fixed.

    The likelihood is the sum of n log n over class bigrams, less that over classes on either side.
    ``bigrams`` (rows: class before) are those of ``classes``; a row without counts stays. What stands
    next to a word is taken as not moving, the word itself included. None moves to a ``barred`` class.
    """
    parts = [_best(left[k : k + 1024].astype(float), right[k : k + 1024].astype(float), classes[k : k + 1024], bigrams.astype(float), barred) for k in range(0, len(classes), 1024)]
    return np.concatenate([classes[:0], *parts])


def _best(left: np.ndarray, right: np.ndarray, own: np.ndarray, bigrams: np.ndarray, barred: np.ndarray | None) -> np.ndarray:
    rows = np.arange(len(own))

    def side(counts: np.ndarray, other: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Gain by row and class in the cells (class beside, own class), without those of a class beside itself."""
        row, beside = np.nonzero(counts)
        n = counts[row, beside]
        # Many words have the same number beside the same class.
        one, which = np.unique(beside + n * WIDE, return_index=True, return_inverse=True)[1:]
        gain = _gain(cells[beside[one], :CLASSES], n[one][:, None])[which]
        # The word taken out of its class, then added to each.
        at = np.arange(len(row))
        gain[at, np.minimum(own[row], CLASSES - 1)] = _gain(cells[beside, own[row]] - n, n)
        same = np.flatnonzero(beside == own[row])
        base = cells[beside[same], :CLASSES] - other[row[same], :CLASSES]
        base[np.arange(len(same)), own[row[same]]] -= n[same]
        gain[same] = _gain(base, n[same][:, None])
        inner = np.flatnonzero(beside < CLASSES)
        gain[inner, beside[inner]] = 0
        out = np.zeros((len(own), CLASSES))
        used, first = np.unique(row, return_index=True)
        # Most words have few neighbours: their sums are made one cell of each at a time, which is faster.
        length = np.diff(first, append=len(row))
        few = np.flatnonzero(length <= 8)
        out[used[few]] = gain[first[few]]
        for k in range(1, 8):
            few = few[length[few] > k]
            out[used[few]] += gain[first[few] + k]
        many = length > 8
        if many.any():
            inside = np.repeat(many, length)
            out[used[many]] = np.add.reduceat(gain[inside], np.cumsum(length[many]) - length[many])
        return out

    gain = side(left, right, bigrams) + side(right, left, bigrams.T)
    both = (left + right)[:, :CLASSES]
    row, inner = np.nonzero(both)
    n = both[row, inner]
    gain[row, inner] += _gain(np.diag(bigrams)[inner] - np.where(inner == own[row], n, 0), n)
    for axis, counts in ((0, left), (1, right)):
        size, margin = counts.sum(axis=1), bigrams.sum(axis=axis)[:CLASSES]
        sizes, which = np.unique(size, return_inverse=True)
        added = _gain(margin[None, :], sizes[:, None])[which]
        added[rows, own] = _gain(margin[own] - size, size)
        gain -= added
    if barred is not None:
        gain[:, barred] = -np.inf
    return np.where((left + right).any(axis=1), gain.argmax(axis=1), own)


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Tokens are words between white space, A-Z lower-cased, and one end; a null or empty text is just
    the end. ``base_score`` is the smoothed unigram log10 probability, ``score`` that of the class
    model: P(class | last class), smoothed by the class's own frequency, times P(word | class) with
    one place for unknown words in each class. Repeated rows count and are scored each. Columns other
    than doc_id and text are not read.
    """
    ready = docs.select("doc_id", (~held_out_document(F.col("doc_id"))).alias("trains"), "text")
    blocks = materialise(_blocks(ready), "blocks")
    return _score(blocks, *exchange(blocks))


def _word_counts(blocks: DataFrame, classes: DataFrame) -> DataFrame:
    """part, word, n, ending, class of every training word of the blocks, the end of a text included: the exchange counts them."""
    return classes


def _ending_classes(totals: DataFrame) -> np.ndarray:
    """For each ending, the class of most training words that have it, or else any one."""
    table = totals.where(F.col("class") < CLASSES).groupBy("ending", "class").agg(F.count("*").alias("n")).toArrow()
    votes = np.zeros((ENDINGS, CLASSES), np.int64)
    votes[table["ending"].to_numpy(), table["class"].to_numpy()] = table["n"].to_numpy()
    return np.where(votes.any(axis=1), votes.argmax(axis=1), start_class(np.arange(ENDINGS)))


def _score(blocks: DataFrame, classes: DataFrame, bigrams: np.ndarray) -> DataFrame:
    spark = blocks.sparkSession
    totals = _word_counts(blocks, classes)
    # For each class the training tokens and distinct words.
    sums = totals.groupBy("class").agg(F.sum("n").alias("tokens"), F.count("*").alias("types")).toArrow()
    emitted, kinds = np.zeros(WIDE), np.zeros(WIDE)
    emitted[sums["class"].to_numpy()], kinds[sums["class"].to_numpy()] = sums["tokens"].to_numpy(), sums["types"].to_numpy()
    train_tokens, types = int(emitted.sum()), int(kinds.sum())
    # P(class | before): counts and, with the weight of the number of classes seen there, the class's own share.
    share = (emitted + ADD) / (emitted + ADD)[: CLASSES + 1].sum()
    share[START_CLASS] = 0
    seen = (bigrams > 0).sum(axis=1, keepdims=True) + 1.0
    moves = np.log10(np.maximum((bigrams + seen * share) / (bigrams.sum(axis=1, keepdims=True) + seen), 1e-300))
    tables = spark.sparkContext.broadcast((moves, np.log10(emitted + ADD * (kinds + 1)), _ending_classes(totals)))
    base_below = np.log10(train_tokens + ADD * (types + 1))

    # A block hears of every word that training text has.
    keys = _keys_for(blocks)
    told = "block bigint, places binary, n binary, classes binary"

    def tell(key: tuple, table: pa.Table, known: pa.Table) -> pa.Table:
        asked, rows = table.combine_chunks().to_batches(), []
        words, n, of = (known[c].to_numpy() for c in ("word", "n", "class"))
        order = np.argsort(words)
        for k, block in enumerate(asked[0].column("block").to_pylist() if asked and len(words) else ()):
            own = _numbers(asked[0].column("words"), k)
            at = order[np.minimum(np.searchsorted(words, own, sorter=order), len(words) - 1)]
            hit = words[at] == own
            rows.append((block, _packed(_unpacked(asked[0].column("places")[k].as_py())[hit]), n[at[hit]].tobytes(), of[at[hit]].astype(np.uint8).tobytes()))
        return _table(told, rows)

    asked = _asked(blocks, keys, False).select("part", "block", "words", "places")
    answers = asked.groupBy("part").cogroup(totals.select("part", "word", "n", "class").groupBy("part")).applyInArrow(tell, told)
    returned = answers.groupBy("block").agg(F.collect_list(F.struct("places", "n", "classes")).alias("known"))
    # Block numbers are unique, so that no key is large.
    joined = blocks.drop("vocabulary", "counts").join(returned, "block", "left")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves, below, by_ending = tables.value
        for batch in batches:
            for k in range(batch.num_rows):
                own = by_ending[_values(batch.column("endings"), k)]
                n = np.zeros(len(own))
                known = batch.column("known")[k].values
                for j in range(0 if known is None else len(known)):
                    place = _unpacked(known.field("places")[j].as_py())
                    n[place], own[place] = _numbers(known.field("n"), j), _numbers(known.field("classes"), j, np.uint8)
                own[-1] = END_CLASS
                above = np.log10(n + ADD)
                base, emission = above - base_below, above - below[own]
                places, lengths, low = _unpacked(batch.column("words")[k].as_py()), _values(batch.column("lengths"), k), 0
                ids, held = batch.column("doc_ids")[k].values, ~_values(batch.column("trains"), k)
                stops = np.append(0, np.cumsum(lengths, dtype=np.int64))
                while low < len(lengths):
                    # Some whole documents at once, so that what is held for each token stays small.
                    high = max(low + 1, int(np.searchsorted(stops, stops[low] + SCORED_TOKENS, "right")) - 1)
                    tokens, first = _sequence(places[stops[low] : stops[high]], lengths[low:high], len(n) - 1)
                    of = np.repeat(np.arange(high - low), lengths[low:high] + 1)
                    now = own[tokens]
                    before = np.append(START_CLASS, now[:-1])
                    before[first] = START_CLASS
                    add = partial(np.bincount, of, minlength=high - low)
                    columns = [add(), add(weights=n[tokens] > 0).astype(np.int64), np.full(high - low, train_tokens), add(weights=base[tokens]), add(weights=emission[tokens] + moves[before, now])]
                    yield pa.RecordBatch.from_arrays([ids.slice(low, high - low), *map(pa.array, (held[low:high], *columns))], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
                    low = high

    return joined.mapInArrow(score, schema)
