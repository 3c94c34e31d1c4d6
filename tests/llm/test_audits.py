"""Filter audit, source divergence and the pivot index against brute force, with awkward rows."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

from seriesmill.llm import filter_audit, pivot_index, source_divergence
from seriesmill.llm.transducer import Transducer, build

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, part STRING, mask INT, n STRING, base INT"
LABELS = "doc_id BIGINT, quality INT, toxic INT, part STRING"
rnd = random.Random(3)
VOCABULARY = ["".join(rnd.choice("abcéñÉßxyz") for _ in range(rnd.randrange(1, 6))) for _ in range(150)]


def text(seed):
    r = random.Random(seed)
    words = [r.choice(VOCABULARY[: r.choice([30, 150])]) for _ in range(r.choice([3, 40, 70, 120]))]
    return " ".join(w.upper() if r.random() < 0.04 else w + r.choice(["", "", ",", " 7", "#" if r.random() < 0.1 else ""]) for w in words)


def doc_rows():
    texts = [text(k) for k in range(60)] + [text(k) for k in range(20)] + [None, "", None, " \n\t", "HASH # AND", "x" * 30_000, "é à " * 4000]
    rows = [(k, t, ["en", "fr", None][k % 3], [f"s{k % 5}", None][k % 11 == 0], "p", 1, "n", 2) for k, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (None, texts[3], "en", "s1", None, None, None, None), (None, texts[3], "en", "s1", None, None, None, None), (None, None, None, None, None, None, None, None)]


ROWS = doc_rows()
MARKS = [(k, k % 2, int(k % 7 == 0), "x") for k in range(0, 80, 2)] + [(4, 1, None, "x"), (4, 0, 1, "x"), (None, 1, 1, "x"), (9999, 1, 1, "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


def failing(t, doc_id):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    out = set()
    if len(words) < 50:
        out.add("A")
    if 100 * len(set(words)) < 65 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
        out.add("C")
    if re.search(r"[#$%&*|]", t):
        out.add("D")
    if doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == t for r in ROWS):
        out.add("E")
    return out


def test_every_order_of_the_filters(spark, docs):
    good = {m[0] for m in MARKS if m[0] is not None and m[1] == 1}
    toxic = {m[0] for m in MARKS if m[0] is not None and m[2] == 1}
    expected = {}
    parts = collections.defaultdict(list)
    for r in ROWS:
        parts[r[3] or ""].append((failing(r[1] or "", r[0]), r[0] in good, r[0] in toxic))
    for part, members in parts.items():
        removed_by = collections.Counter()
        own = {}
        for order in itertools.permutations("ABCDE"):
            left, gone = members, []
            for step, f in enumerate(order, 1):
                out = [m for m in left if f in m[0]]
                left = [m for m in left if f not in m[0]]
                own["".join(order), step] = (len(left), len(out), sum(f in m[0] for m in gone), sum(m[0] == {f} for m in members), sum(m[1] for m in out), sum(m[2] for m in out))
                gone = gone + out
                removed_by[f] += len(out)
        expected.update({(part, *k): (*v, removed_by[k[0][k[1] - 1]]) for k, v in own.items()})
    got = filter_audit.text_filter_audit(docs, spark.createDataFrame(MARKS, LABELS))
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got.collect()} == expected
    assert got.count() == len(expected)


def test_removal_steps_are_the_smallest_places():
    orders, steps = filter_audit.removal_steps(3)
    assert len(orders) == 6 and (steps[0] == 4).all()
    for order, column in zip(orders.tolist(), steps.T.tolist()):
        for mask in range(1, 8):
            assert column[mask] == min(order.index(f) + 1 for f in range(3) if mask >> f & 1)


def test_audits_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert filter_audit.text_filter_audit(none, spark.createDataFrame([], LABELS)).count() == 0
    assert source_divergence.source_divergence(none).count() == 0
    with pytest.raises(ValueError):
        filter_audit.interaction_audit(none, "ABCDEFG")


def test_transducer_gives_the_place_of_every_term():
    r = random.Random(8)
    for size in (0, 1, 2, 400):
        terms = sorted({"".join(r.choice("abé") for _ in range(r.randrange(1, 9))).encode() for _ in range(size)})
        machine = Transducer.from_bytes(build(terms).to_bytes())
        others = [b"ab" * 20, b"z", *(t + b"a" for t in terms), *(t[:-1] for t in terms)]
        asked = terms + [t for t in others if t not in terms]
        data = np.frombuffer(b"".join(asked), np.uint8)
        ends = np.cumsum([len(t) for t in asked])
        got = machine.ordinals(data, ends - [len(t) for t in asked], ends).tolist()
        assert got == [*range(len(terms)), *[-1] * (len(asked) - len(terms))]
    # Common endings are stored once: start, after the first letter, after "in", end.
    assert len(build([a + b"ing" for a in (b"a", b"b", b"c")]).final) == 5
    with pytest.raises(ValueError):
        build([b"b", b"a"])


def divergences(min_docs, top=10):
    counts, frequency = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for r in ROWS:
        lang, source = r[2] or "", r[3] or ""
        lowered = re.sub("[A-Z]+", lambda m: m.group().lower(), r[1] or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang, source].update(terms)
        frequency[lang].update(set(terms))
    out = []
    for lang in {k[0] for k in counts}:
        kept = sorted(t for t, n in frequency[lang].items() if n >= min_docs)
        groups = {s: c for (own, s), c in counts.items() if own == lang}
        groups = {s: {t: c[t] for t in kept} for s, c in groups.items()}

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}

        q = shares({t: sum(c[t] for c in groups.values()) for t in kept})
        p = {s: shares(c) for s, c in groups.items()}

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        for s in groups:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, listed in (("pair", pairs), ("term", terms)):
                ranked = sorted(listed, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k) for k, (item, v) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(out)


@pytest.mark.parametrize("min_docs", [2, 10, 500])
def test_divergence_of_sources(docs, min_docs):
    assert sorted(map(tuple, source_divergence.source_divergence(docs, min_docs).collect())) == divergences(min_docs)


def test_divergence_through_many_transducers_and_tiles(docs, monkeypatch):
    """Transducers of a few terms, one to a pass, and tiles of few terms and sources change nothing."""
    monkeypatch.setattr(source_divergence, "SHARD_BYTES", 600)
    monkeypatch.setattr(source_divergence, "TERMS", 7)
    monkeypatch.setattr(source_divergence, "SOURCES", 2)
    assert sorted(map(tuple, source_divergence.source_divergence(docs, 6, block_bytes=4000).collect())) == divergences(6)


def test_shares_beyond_64_bits():
    n = np.array([[0, 5 * 10**11]])
    assert source_divergence._shares(n, np.array([[10**12]])).tolist() == [[1, 1 + (5 * 10**11 + 2) * 10**9 // 10**12]]


VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, cid STRING, n INT"


def vector_rows():
    r = np.random.default_rng(4)
    rows = []

    def add(vector, label, vec_id=None):
        rows.append((len(rows) if vec_id is None else vec_id, None if vector is None else [None if x is None else float(x) for x in vector], label, "x", 1))

    for _ in range(12):  # groups around a vector: near, at the threshold, exact
        center, label = r.normal(size=24), int(r.integers(2))
        for _ in range(int(r.integers(2, 60))):
            add(center + r.normal(size=24) * r.choice([0, 0.05, 0.14, 0.2]), label)
    for _ in range(150):
        add(r.normal(size=24), int(r.integers(2)))
    base = r.normal(size=24)
    for scale in (1.0, 3e18, 1e-30, -1.0):
        add(base * scale, 1)
    for odd in (None, [], [0.0] * 24, [None] * 24, [*base[:23], None], [*base[:23], float("nan")], [*base[:23], float("inf")]):
        add(odd, 1)
        add(odd, 1)
    add(base, None)
    add(base, None)
    add(base[:5], 1)
    add(base[:5] * 2, 1)
    add([0.0, -0.0, 1.0], 0)
    add([-0.0, 0.0, 1.0], 0)
    rows.extend([rows[0], rows[0], (None, rows[0][1], rows[0][2], "x", 1)])
    return rows


def brute_links(rows, threshold):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(float)
        v = v / np.abs(v).max()
        return v / np.sqrt((v * v).sum())

    units = [unit(r[1]) if r[0] is not None and r[2] is not None else None for r in rows]
    linked = [[] for _ in rows]
    for i, j in itertools.combinations(range(len(rows)), 2):
        if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
            linked[i].append(j)
            linked[j].append(i)
    out = []
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo = [k for x in todo for k in linked[x] if k not in seen and not seen.add(k)]
        component = None if r[0] is None else min(rows[k][0] for k in seen)
        out.append((r[0], len(linked[i]), component, component == r[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("tile", [1024, 16])
def test_near_duplicate_vectors(spark, tile):
    """Whole lists, and lists in tiles of few vectors; every pair at the threshold is found here."""
    rows = vector_rows()
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = sorted(map(tuple, pivot_index.near_duplicates(df, tile=tile).collect()), key=str)
    assert got == brute_links(rows, 0.98)


def test_recall_of_pairs_near_the_threshold(spark):
    """Of 600 pairs with a cosine from 0.98 to 0.985 at least 0.99 meet in a list; none is linked wrongly."""
    r = np.random.default_rng(9)
    a = r.normal(size=(600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    u = r.normal(size=a.shape)
    u -= (u * a).sum(axis=1, keepdims=True) * a
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    c = r.uniform(0.9801, 0.985, size=(600, 1))
    b = c * a + np.sqrt(1 - c * c) * u
    rows = [(k, v.astype(np.float32).tolist(), 0, "x", 1) for k, v in enumerate(np.concatenate([a, b]))]
    got = {x["vec_id"]: x["component_id"] for x in pivot_index.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    assert sum(got[k + 600] == k for k in range(600)) >= 0.99 * 600
    assert all(got[k] == k for k in range(600))


def test_few_vectors_and_none(spark):
    assert pivot_index.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    rows = [(5, [1.0, 0.0], 1, "x", 1), (2, [1.0, 0.001], 1, "x", 1), (1, [1.0, 0.0], 2, "x", 1)]
    got = sorted(map(tuple, pivot_index.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()))
    assert got == [(1, 0, 1, True), (2, 1, 2, True), (5, 1, 2, False)]
