"""Personal data: four fixed forms, and bootstrapped extraction of what they miss.

The fixed forms are the seeds. The words around a seed are patterns; a pattern that keeps meeting one
kind of seed is trusted for that kind, and an identifier-like string that trusted patterns keep meeting
is taken for one of them, which makes further patterns known (Riloff and Jones, Learning dictionaries
for information extraction by multi-level bootstrapping, 1999; Agichtein and Gravano, Snowball, 2000).
Patterns and instances are the two sides of a graph of counts over all documents; Spark scores one
side from the other in rounds. Nothing but counts of patterns and instances is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.sources.tables import materialise

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: A pattern needs this many different instances of its kind and this share of what it meets.
MIN_INSTANCES, MIN_PATTERN = 3, 0.5
#: An instance needs this confidence.
MIN_INSTANCE = 0.7

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|\((?:at|AT)\)|\[(?:at|AT)\]")
_NUMBER = re.compile(r"[+(]?[0-9](?:[ ().-]{0,2}+[0-9])++")
_AT = re.compile(r" ?(?:@|\((?:at|AT)\)|\[(?:at|AT)\]) ?")
_LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:(?: ?(?:\(dot\)|\[dot\]) ?|\.)[A-Za-z0-9-]++)*+")
_TRIM = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>=*#$%&|"


def _local_start(text: str, end: int, floor: int) -> int:
    """Start of the run of local-part characters that ends at ``end``, not before ``floor``."""
    while end > floor and text[end - 1] in _LOCAL:
        end -= 1
    return end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from each @, so that long runs cost their length once."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = _local_start(text, at, floor)
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            floor = domain.end()
        else:
            floor = max(floor, at + 1)
        at = text.find("@", max(at + 1, floor))


def _luhn(digits: str) -> bool:
    """Whether the weighted digit sum is a multiple of ten."""
    values = np.frombuffer(digits.encode(), np.uint8)[::-1].astype(np.int64) - 48
    twice = values[1::2] * 2
    return int(values[::2].sum() + (twice // 10 + twice % 10).sum()) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The fixed forms of each kind, in code points."""
    if not _ANY.search(text):
        return {kind: [] for kind in KINDS}
    ips = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
    cards = [m.span() for m in _CARD.finditer(text) if 16 <= len(d := _digits(m.group())) <= 19 and _luhn(d)]
    phones = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return {"email": list(_emails(text)), "ip": ips, "card": cards, "phone": phones}


def _looks_like(text: str) -> list[str]:
    """Kinds that an identifier-like string may belong to by its form."""
    if "@" in text or "at" in text.lower():
        return ["email"]
    n, dots = len(_digits(text)), text.count(".")
    kinds = ["ip"] if dots == 3 and n <= 12 and "(" not in text else []
    kinds += ["card"] if 13 <= n <= 19 and dots == 0 else []
    return kinds + (["phone"] if 7 <= n <= 15 else [])


def _candidates(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like strings apart from the spans in ``taken`` (sorted)."""
    found, floor = [], 0
    for m in _AT.finditer(text):
        start = _local_start(text, m.start(), floor)
        domain = _LOOSE_DOMAIN.match(text, m.end())
        if start < m.start() and domain:
            found.append((start, domain.end()))
            floor = domain.end()
    found += [m.span() for m in _NUMBER.finditer(text) if len(_digits(m.group())) >= 7]
    k, last = 0, 0
    for start, end in sorted(found):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if start >= last and (k == len(taken) or taken[k][0] >= end):
            yield start, end
            last = end


def _patterns(text: str, start: int, end: int) -> list[int]:
    """Two patterns around a span: the two words before it, and one word on either side."""
    before = [w.strip(_TRIM).lower() for w in text[max(0, start - 120) : start].split()[-2:]]
    after = [w.strip(_TRIM).lower() for w in text[end : end + 80].split()[:1]]
    before = ["^"] * (2 - len(before)) + before
    shapes = ("two before", *before), ("around", before[-1], *(after or ["$"]))
    return [xxhash.xxh64_intdigest("\0".join(s)) - (1 << 63) for s in shapes]


def _instance(text: str) -> int:
    return xxhash.xxh64_intdigest(re.sub(r"[ ()\[\]-]", "", text).lower()) - (1 << 63)


def _joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in sorted(spans[kind]))


def _mention_rows(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts, base spans, and mentions (seeds with their kind, candidates without)."""
    mention = "struct<kind:string,may:string,start:int,end:int,instance:bigint,patterns:array<bigint>>"
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, base_sha256 string, mentions array<{mention}>"
    arrow_mention = pa.struct([("kind", pa.string()), ("may", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, base, digests, mentions = [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                spans = base_spans(text)
                counts.append([len(spans[k]) for k in KINDS])
                base.append(_joined(spans))
                digests.append(hashlib.sha256(base[-1].encode()).hexdigest())
                seeds = [(k, k, a, b) for k in KINDS for a, b in spans[k]]
                others = []
                if seeds or _ANY.search(text):
                    taken = sorted((a, b) for _, _, a, b in seeds)
                    others = [("", k, a, b) for a, b in _candidates(text, taken) for k in _looks_like(text[a:b])]
                mentions.append([{"kind": k, "may": may, "start": a, "end": b, "instance": _instance(text[a:b]), "patterns": _patterns(text, a, b)} for k, may, a, b in seeds + others])
            table = np.array(counts, np.int64).reshape(-1, len(KINDS))
            columns = [batch.column(0), *map(pa.array, table.T), pa.array(base, pa.string()), pa.array(digests, pa.string()), pa.array(mentions, pa.list_(arrow_mention))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(f"n_{k}" for k in KINDS), "base", "base_sha256", "mentions"])

    return docs.select("doc_id", "text").mapInArrow(find, schema)


def trusted_instances(edges: DataFrame) -> DataFrame:
    """kind, pattern, instance of the non-seeds that bootstrapping accepts, with trusted patterns.

    ``edges``: kind ('' for a candidate), may (kind it may belong to), pattern, instance, n. A pattern
    scores the share of its mentions, of the form of a kind, that are instances of it; an instance
    the probability that not all of its patterns are wrong.
    """
    seeds = edges.where("kind <> ''").select(F.col("kind").alias("may"), "instance").distinct().withColumn("confidence", F.lit(1.0))
    met = edges.groupBy("may", "pattern").agg(F.sum("n").alias("met"))
    others = edges.where("kind = ''").join(seeds.select("may", "instance"), ["may", "instance"], "left_anti").select("may", "pattern", "instance").distinct()
    known, scored = seeds, None
    for _ in range(ROUNDS):
        hits = edges.join(known, ["may", "instance"]).groupBy("may", "pattern").agg(F.sum(F.col("n") * F.col("confidence")).alias("hits"), F.count_distinct("instance").alias("instances"))
        scored = hits.where(F.col("instances") >= MIN_INSTANCES).join(met, ["may", "pattern"])
        scored = scored.select("may", "pattern", (F.col("hits") / (F.col("met") + 1)).alias("score")).where(F.col("score") >= MIN_PATTERN)
        scored = materialise(scored, "patterns")
        found = others.join(scored, ["may", "pattern"]).groupBy("may", "instance").agg((1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("confidence"))
        known = materialise(seeds.union(found.where(F.col("confidence") >= MIN_INSTANCE)), "instances")
    return others.join(scored, ["may", "pattern"]).join(known, ["may", "instance"]).select(F.col("may").alias("kind"), "pattern", "instance")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found for every row.

    The counts and the digest are of the fixed forms; ``spans`` also has what bootstrapping found
    (``n_found`` of them): strings that do not overlap a fixed form, around which a trusted pattern
    stands. A null text is empty. Repeated rows are returned each, and their mentions count each.
    Columns other than doc_id and text are not read.
    """
    rows = materialise(_mention_rows(docs).select(F.monotonically_increasing_id().alias("row_"), "*"), "mentions")
    mentions = rows.select("row_", F.explode("mentions").alias("m")).select("row_", "m.*")
    per_pattern = mentions.select("row_", "kind", "may", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    edges = materialise(per_pattern.groupBy("kind", "may", "pattern", "instance").agg(F.count("*").alias("n")), "edges")
    accepted = trusted_instances(edges).select(F.col("kind").alias("may"), "pattern", "instance").distinct()
    found = per_pattern.where("kind = ''").join(accepted, ["may", "pattern", "instance"]).select("row_", "may", "start", "end").distinct()
    # A string of two possible kinds goes to the first as listed.
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("may"))
    found = found.groupBy("row_", "start", "end").agg(F.min(order).cast("int").alias("order")).groupBy(F.col("row_").alias("of_row_")).agg(F.collect_list(F.struct("order", "start", "end")).alias("found"))
    # Base spans are parsed back only where something is added to them.
    spans = F.transform(
        F.filter(F.split("base", ","), lambda s: s != ""),
        lambda s: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), F.split(s, ":")[0]).cast("int").alias("order"), F.split(s, ":")[1].cast("int").alias("start"), F.split(s, ":")[2].cast("int").alias("end")),
    )
    text = F.array_join(
        F.transform(F.sort_array(F.concat(spans, F.col("found"))), lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["order"]), x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )
    joined = rows.join(found, F.col("row_") == F.col("of_row_"), "left")
    return joined.select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", F.when(F.col("found").isNull(), F.col("base")).otherwise(text).alias("spans"), F.coalesce(F.size("found"), F.lit(0)).cast("bigint").alias("n_found"))
