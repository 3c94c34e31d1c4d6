"""Every operator against a brute-force version on a small fixture with awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from seriesmill.llm import bootstrap_pii, brown_lm, fuzzy_lines, line_frequency, packing, prefix_join, spans, string_kernel, suffix_arrays, token_counts, url_models
from seriesmill.llm.components import components

DDL = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, id STRING, key INT, component STRING, n_words INT"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
rnd = random.Random(5)
VOCABULARY = ["".join(rnd.choice("abcdeéioustrn") for _ in range(rnd.randrange(2, 8))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) + r.choice(["", "", "", ".", ","]) for _ in range(n))


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


def changed(text, seed):
    words = text.split(" ")
    words[random.Random(seed).randrange(len(words))] = "changed"
    return " ".join(words)


PASSAGE = prose(60, 900)
TEXTS = (
    [prose(80 + k, k) for k in range(20)]
    + [prose(90, 3 + k % 2) for k in range(4)]
    + [changed(prose(150, 50), k) for k in range(6)]
    + [prose(30, 60 + k) + "\n" + PASSAGE + "\n" + prose(30, 80 + k) for k in range(5)]
    + [None, None, "", " \n\t ", "one", "One", "two words", "Two  words\n", "x" * 40_000, prose(9_000, 99), "\n".join([prose(12, 7)] * 6), "é" * 30 + "\n" + "É" * 30]
)


def rows(texts=TEXTS):
    listed = [(k, t, "en", f"src{k % 2}", 0, "x", 1, None, 3) for k, t in enumerate(texts)]
    return [*listed, listed[2], listed[2], (None, prose(40, 1), None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DDL).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


def by_id(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r["doc_id"]].append(r.asDict())
    return out


TEXT_OF = {r[0]: r[1] for r in rows()}
COUNT_OF = collections.Counter(r[0] for r in rows())


def check_rows(df, expected):
    """One row per row of the fixture, and ``expected(text)`` as a subset of its columns."""
    got = by_id(df)
    assert {k: len(v) for k, v in got.items()} == COUNT_OF
    for key, same in got.items():
        for row in same:
            want = expected(TEXT_OF[key])
            assert {k: row[k] for k in want} == want, key


def test_spans_hash_equal_words_alike():
    texts = pa.array(["abc  abc", None, "", "xabc abc", "abc" * 5])
    seen = {}
    for limit in (4, 1 << 20):
        for _, data, at in spans.slices(texts, limit):
            starts, ends, _ = spans.word_spans(data, at, spans.SPACED)
            for a, b, h in zip(starts, ends, spans.span_hashes(data, starts, ends).tolist()):
                assert seen.setdefault(bytes(data[a:b]), h) == h
    assert len(set(seen.values())) == len(seen) == 3


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 99), (100, 98)], "a BIGINT, b BIGINT")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 98: 98, 99: 98, 100: 98}


# 1


URLS = ["http://A.Example.org/en/1?x", "https://x.example.org/es/", "http://b.com/fr/9#t", "http://b.com/de/9", "http://casino-win.net/en", "no scheme", None, "http://", "ftp://org/", "http://notorg/", "x://h?://y/", "http://example.org", "http://b.com/fr/9#t"]


def test_urls(spark):
    many = [f"http://site{k}.example.org/{w}/{k}" for k in range(60) for w in ("en", "es", "fr")] + [f"http://casino{k}.x.com/de/{k}" for k in range(60)]
    frame = spark.createDataFrame([(k, u, "h") for k, u in enumerate(URLS + many)], "page_id BIGINT, url STRING, rule STRING")
    fits = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    got = {r["page_id"]: r for r in url_models.judge_urls(frame).collect()}
    for k, url in enumerate(URLS + many):
        host = path = ""
        if url and "://" in url:
            m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
            host, path = m[1].lower(), m[2]
        rules = [r for r in fits if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
        rule = max(rules, key=len, default=None)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule)
        assert got[k]["verdict"] == fits[rule] if rule else got[k]["verdict"] in ("allow", "block")
    assert got[5]["verdict"] == got[6]["verdict"] == "allow"


def test_url_models_tell_hosts_apart(spark):
    r = random.Random(2)
    good = [f"www.{r.choice(VOCABULARY)}.org/news/{k}" for k in range(200)]
    bad = [f"free-{r.choice(['bets', 'casino'])}-{k}.net/win/{k}" for k in range(200)]
    model = url_models.fit_url_filter(spark.createDataFrame([(u, False) for u in good] + [(u, True) for u in bad], "text STRING, rejected BOOLEAN"))
    assert model.blocks(pa.array(["free-casino-777.net/win/5", "www.zebra.org/news/12", "", None])).tolist() == [True, False, False, False]
    brute = url_models.CharModel.of(np.zeros(2, int), np.array([97, 98]), np.array([3, 1])).probability([np.array([97, 98, 99])] * (url_models.ORDER + 1))
    assert brute == pytest.approx([(3 + 2 / 256) / 6, (1 + 2 / 256) / 6, (2 / 256) / 6])


def test_background_and_limit_cover_all_urls(spark, monkeypatch):
    monkeypatch.setattr(url_models, "TRAINING_URLS", 50)
    listed = [(f"good{k}.com/a", False) for k in range(300)] + [(f"bad{k}.net/b", True) for k in range(300)] + [(f"other{k}.de/c", None) for k in range(300)]
    model = url_models.fit_url_filter(spark.createDataFrame(listed, "text STRING, rejected BOOLEAN"))
    keys, n = model.all_urls.grams[0]
    assert dict(zip(keys.tolist(), n.tolist())) == collections.Counter(x for u, _ in listed for x in [*u.encode(), 1])
    values = spark.createDataFrame([(x % 30_011 / 7,) for x in range(0, 40_000 * 17, 17)], "d DOUBLE")
    ranked = sorted(r["d"] for r in values.collect())
    assert [url_models._ranked(values, k) for k in (0, 20_000, 39_199, 39_999)] == [ranked[k] for k in (0, 20_000, 39_199, 39_999)]


def test_urls_without_rows_or_labels(spark):
    empty = spark.createDataFrame([], "page_id BIGINT, url STRING")
    assert url_models.judge_urls(empty).collect() == []
    only = spark.createDataFrame([(1, "http://a.net/")], "page_id BIGINT, url STRING")
    assert [r["verdict"] for r in url_models.judge_urls(only).collect()] == ["allow"]


# 2


def base_counts(text):
    words, lines = SPACED.findall(text or ""), [x for x in (text or "").split("\n") if SPACED.search(x)]
    windows = collections.Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    hit = [0] * len(words)
    for k in range(len(words) - 7):
        if windows[tuple(words[k : k + 8])] > 1:
            hit[k : k + 8] = [1] * 8
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": sum(hit), "base_failed": n < 20 or 100 * sum(hit) > 30 * n,
    }


def test_line_frequency(docs, none):
    check_rows(line_frequency.line_frequency_verdicts(docs), base_counts)
    assert line_frequency.line_frequency_verdicts(none).collect() == []


def test_lines_that_many_documents_share_are_removed(spark):
    common = "this line stands on every page of the site"
    texts = [common + "\n" + prose(40, k) for k in range(12)] + [(common + "\n") * 3 + "one two three", prose(40, 77)]
    frame = spark.createDataFrame([(k, t, "a") for k, t in enumerate(texts)] + [(90, common + "\n" + prose(30, 78), "b")], "doc_id BIGINT, text STRING, source STRING")
    got = {r["doc_id"]: r for r in line_frequency.line_frequency_verdicts(frame, max_share=0.5).collect()}
    assert [got[k]["n_lines_removed"] for k in (0, 12, 13, 90)] == [1, 3, 0, 0]
    assert [got[k]["kept"] for k in (0, 12, 13, 90)] == [True, False, True, True]
    assert got[12]["n_words_left"] == 3


# 3


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_removal_does_not_depend_on_the_size_of_the_host(spark):
    def kept(others):
        shared = "the same words on every page"
        listed = [(k, f"{shared}\n{prose(40, 300 + k)}") for k in range(6)] + [(10, "x\ny")] * 2 + [(100 + k, prose(25, 400 + k)) for k in range(others)]
        frame = spark.createDataFrame([(k, t, "host") for k, t in listed], "doc_id BIGINT, text STRING, source STRING")
        return {r["doc_id"]: r["n_lines_removed"] for r in line_frequency.line_frequency_verdicts(frame).collect() if r["doc_id"] < 10}

    assert kept(0) == kept(400) == dict.fromkeys(range(6), 1)


def contaminated(items):
    windows = collections.defaultdict(set)
    for key, text in items:
        words = ALNUM.findall(lower(text))
        for k in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[k : k + 13])].add(key or "")

    def judge(text):
        words = ALNUM.findall(lower(text))
        hit, found = [0] * len(words), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if own := windows.get(tuple(words[k : k + size])):
                    found |= own
                    hit[k : k + size] = [1] * size
        n = sum(hit)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        return {"n_words": len(words), "n_hit": n, "n_items": len(found), "items_sha256": digest, "contaminated": n > 0 and 20 * n >= len(words)}

    return judge


ITEMS = [("1", prose(80, 4)), ("2", PASSAGE), ("2", PASSAGE.upper()), ("3", "ONE"), ("4", None), ("5", ""), (None, prose(9_000, 99)[300:900]), ("7", prose(5, 8)), ("8", "two, words")]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id STRING, text STRING, doc_id INT")


@pytest.mark.parametrize("block", [2_000_000, 100])
def test_contamination(docs, none, bench, monkeypatch, block):
    monkeypatch.setattr(suffix_arrays, "BLOCK_WORDS", block)
    judge = contaminated(ITEMS)
    check_rows(suffix_arrays.contamination(docs, bench), judge)
    assert suffix_arrays.contamination(none, bench).collect() == []
    clean = by_id(suffix_arrays.decontaminate(docs, bench))
    assert {k: len(v) for k, v in clean.items()} == {k: n for k, n in COUNT_OF.items() if not judge(TEXT_OF[k])["contaminated"]}
    assert not any(r["n_hit"] for r in suffix_arrays.contamination(docs, bench.limit(0)).collect())


def test_longest_matches(spark):
    words = [f"w{k}" for k in range(60)]
    frame = spark.createDataFrame([(1, "a " + " ".join(words[:40]) + " z " + " ".join(words[30:60]))], "doc_id BIGINT, text STRING")
    tests = spark.createDataFrame([("t", " ".join(words))], "item_id STRING, text STRING")
    got = sorted(tuple(r) for r in suffix_arrays.longest_matches(frame, tests).collect())
    assert got == [(1, 1, "t", 0, 40), (1, 42, "t", 30, 30)]


# 4


def test_personal_data(docs, none):
    odd = "mail a.b@c.de_x@y.org, 1.2.3.4.5.6.7.8 300.1.1.1 +1 (499) 555-6503; 4111 1111 1111 1111 é@é x@y"

    def expected(text):
        found = bootstrap_pii.base_spans(text or "")
        return {"n_email": len(found["email"]), "base_sha256": hashlib.sha256(bootstrap_pii._joined(found).encode()).hexdigest()}

    check_rows(bootstrap_pii.find_personal_data(docs), expected)
    assert bootstrap_pii.find_personal_data(none).collect() == []
    found = bootstrap_pii.base_spans(odd)
    assert {k: [odd[a:b] for a, b in v] for k, v in found.items()} == {
        "email": ["a.b@c.de", "_x@y.org"], "ip": ["1.2.3.4", "5.6.7.8"], "card": ["4111 1111 1111 1111"], "phone": ["+1 (499) 555-6503"],
    }


def test_base_spans_equal_plain_regular_expressions():
    r = random.Random(3)
    for _ in range(3000):
        text = "".join(r.choice("a1b@.@-_+ ()9%0é12345") for _ in range(r.randrange(50)))
        emails = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        ips = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
        found = bootstrap_pii.base_spans(text)
        assert (found["email"], found["ip"]) == (emails, ips)


def test_trusted_contexts_find_unseen_identifiers(spark):
    texts = [f"please ring us on +1 (20{k}) 555-010{k} any time" for k in range(6)] + ["please ring us on 0207 946 0018 any time", "lot number 0207 946 0019 of many"]
    texts += [f"write to user{k}@mail.org for help" for k in range(5)] + ["write to hidden (at) mail.org for help"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    got = {r["doc_id"]: r for r in bootstrap_pii.find_personal_data(frame).collect()}
    assert {k for k, r in got.items() if r["n_found"]} == {6, 13}
    kind, a, b = got[6]["spans"].split(":")
    assert (kind, texts[6][int(a) : int(b)]) == ("phone", "0207 946 0018")
    kind, a, b = got[13]["spans"].split(":")
    assert (kind, texts[13][int(a) : int(b)]) == ("email", "hidden (at) mail.org")


# 5 and 7


def test_token_counts(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)

    def expected(text):
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        return {"n_bytes": len((text or "").encode()), "n_tokens": n, "over_limit": n > 2048}

    check_rows(token_counts.token_counts(docs, path), expected)
    assert token_counts.token_counts(none, path).collect() == []


def test_chunks_are_spliced_where_they_agree():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    r = random.Random(1)
    pool = [*"ab é  \t\n ́'s1 9.　\x1c\u0085日", "<|endoftext|>", "the "]
    texts = ["".join(r.choice(pool) for _ in range(r.randrange(150))) for _ in range(400)] + ["a" * 3000 + " b" * 99, "x y " * 900]
    for text in texts:
        assert token_counts.count_in_chunks(text, tokenizer, 24, 6) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_packing(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.pack(docs, path).collect()
    pieces = collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    want = collections.Counter()
    for key, text, *_ in rows():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        ends = list(range(len(ids) % 1024 or 1024, len(ids) + 1, 1024))
        for k, (a, b) in enumerate(zip([0, *ends], ends)):
            want[key, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert pieces == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 1024
    assert packing.pack(none, path).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_rounds_are_best_fit_decreasing(seed):
    r = random.Random(seed)
    sizes = [r.randrange(1, 101) for _ in range(300)]
    rules, opened = packing.best_fit_rounds(dict(collections.Counter(sizes)), 100)
    gaps = []
    for size in sorted(sizes, reverse=True):
        fit = min((g for g in gaps if g >= size), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((100 if fit is None else fit) - size)
    assert opened == len(gaps)
    assert {s for s, *_ in rules} == set(sizes)


# 6


def jaccard(texts, n, percent):
    sets = {}
    for key, text in texts:
        words = SPACED.findall(lower(text))
        sets[key] = {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()
    label = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return sets, label


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components(docs, none, n, percent):
    sets, label = jaccard([(k, t) for k, t in TEXT_OF.items() if k is not None and len(t or "") < 30_000], n, percent)
    got = by_id(prefix_join.jaccard_components(docs, n, percent))
    assert {k: len(v) for k, v in got.items()} == COUNT_OF
    for key in label:
        assert {(r["n_shingles"], r["component_id"]) for r in got[key]} == {(len(sets[key]), label[key])}
    assert got[None][0]["component_id"] is None
    assert len(set(label.values())) < len(label) - 8
    kept = by_id(prefix_join.keep_one_per_component(docs, n, percent))
    assert all(len(v) == 1 for v in kept.values())
    assert {k for k in kept if k in label} == set(label.values()) and None in kept
    assert prefix_join.jaccard_components(none, n, percent).collect() == []


def test_groups_of_near_copies_and_a_common_passage(spark):
    base = prose(200, 500)
    texts = [changed(base, k) for k in range(40)] + [PASSAGE + " " + prose(60, 600 + k) for k in range(30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    _, label = jaccard(list(enumerate(texts)), 3, 90)
    assert {r["doc_id"]: r["component_id"] for r in prefix_join.jaccard_components(frame, 3, 90).collect()} == label


# 8


def normal(line):
    return lower(re.sub(r"[\x20\t\x0b\x0c\r]+", " ", line)).strip(" ").encode()


def deduplicated(texts, least=1):
    """Lines of fewer bytes than a shingle have the empty set; they are only like themselves."""
    sets, label = {}, {}
    for _, text in texts:
        for line in (text or "").split("\n"):
            if len(x := normal(line)) >= least:
                label[x] = x
                if len(x) >= fuzzy_lines.MIN_CHARS:
                    sets[x] = {x[k : k + 7] for k in range(len(x) - 6)}
    for _ in range(3):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    seen, out = set(), {}
    for key, text in texts:
        kept = []
        for line in (text or "").split("\n"):
            name = label.get(normal(line))
            if name is None or name not in seen:
                kept.append(line)
            seen.add(name)
        out[key] = None if text is None else "\n".join(kept)
    return out


def test_fuzzy_lines(spark, docs, none):
    texts = [(k, t) for k, t in enumerate(TEXTS) if t is None or len(t) < 30_000] + [(200, changed(PASSAGE, 1) + "\nshort\nshort\n  Mixed   CASE line of some length \nmixed case line of some length"), (201, PASSAGE)]
    frame = spark.createDataFrame([(k, t, "x") for k, t in texts], "doc_id BIGINT, text STRING, label STRING")
    got = {r["doc_id"]: r["text"] for r in fuzzy_lines.dedup_lines(frame).collect()}
    assert got == deduplicated(texts)
    got = {r["doc_id"]: r["text"] for r in fuzzy_lines.dedup_lines(frame, short_lines=False).collect()}
    assert got == deduplicated(texts, fuzzy_lines.MIN_CHARS)
    again = by_id(fuzzy_lines.dedup_lines(docs))
    assert {k: len(v) for k, v in again.items()} == COUNT_OF
    assert set(again[0][0]) == {*docs.columns, "n_lines", "n_removed"}
    assert again[None][0]["n_removed"] == 0 and len({r["text"] for r in again[2]}) == 1
    assert fuzzy_lines.dedup_lines(none).collect() == []


def test_short_lines(spark):
    texts = {1: "Home\nles.\n\n \nshop by name", 2: "home\nLES. \n\nshop  by name\nhome", 3: "ÉÉ\nnew", 4: "ÉÉ\nshop by game"}
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in fuzzy_lines.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING").repartition(3), short_lines=True).collect()}
    assert got == {1: (texts[1], 0), 2: ("", 4), 3: (texts[3], 0), 4: ("shop by game", 1)}
    plain = {r["doc_id"]: r["n_removed"] for r in fuzzy_lines.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING"), short_lines=False).collect()}
    assert plain == {1: 0, 2: 1, 3: 0, 4: 0}


def test_lines_of_documents_without_an_id(spark):
    """Rows without a doc_id are documents by their text: they come last, and of a line that they share one stays."""
    line = "a line that all of them have"
    rows = [(None, f"{line}\nfirst own text here"), (None, f"second own text here\n{line}"), (None, f"second own text here\n{line}"), (7, line), (None, None), (None, "")]
    rows = [(k, t, "x", 1, 2) for k, t in rows]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, shared_lines0 STRING, `holder` INT, n_removed INT").repartition(3)
    got = sorted((str(r["doc_id"]), str(r["text"]), r["n_removed"], r["shared_lines0"]) for r in fuzzy_lines.dedup_lines(frame).collect())
    one, two = "first own text here", "second own text here"
    assert got == sorted([("None", one, 1, "x"), ("None", two, 1, "x"), ("None", two, 1, "x"), ("7", line, 0, "x"), ("None", "None", 0, "x"), ("None", "", 0, "x")])
    alone = [r["n_removed"] for r in fuzzy_lines.dedup_lines(frame.where("doc_id IS NULL")).collect()]
    assert sorted(alone) in ([0, 0, 0, 0, 1], [0, 0, 0, 1, 1])


def test_many_like_lines_meet_once(spark):
    """A large group of lines that are all alike, and lines that share bands with it by chance only."""
    base = prose(40, 77)
    texts = [(k, changed(base, k) + f"\nunlike {prose(6, 5000 + k)}") for k in range(120)]
    frame = spark.createDataFrame(texts, "doc_id BIGINT, text STRING").repartition(4)
    assert {r["doc_id"]: r["text"] for r in fuzzy_lines.dedup_lines(frame).collect()} == deduplicated(texts)


def test_only_lines_with_company_become_rows(spark):
    """Lines that share all of their bands are one list, not ten; a line of one document that is like no other is none."""
    base = prose(40, 77)
    texts = [(1, f"{base}\n{prose(12, 1)}\nshort"), (2, f"{base} \n{prose(12, 2)}"), (3, changed(base, 5)), (4, prose(12, 1)), (5, "SHORT\nlone")]
    frame = spark.createDataFrame(texts, "doc_id BIGINT, text STRING").repartition(3)
    signed = fuzzy_lines._signed_lines(frame)
    entries = fuzzy_lines._entries(signed, 3).collect()
    assert len(entries) == 2 and len({r["key"] for r in entries}) == 1
    linked = fuzzy_lines.line_components(frame, signed)
    labelled = fuzzy_lines._labelled(signed, linked, 3, True).collect()
    assert sorted(r["holder"] for r in labelled) == [1, 1, 1, 2, 3, 4, 5]
    assert len({r["label"] for r in labelled}) == 3
    assert sorted(r["holder"] for r in fuzzy_lines._labelled(signed, linked, 3, False).collect()) == [1, 1, 2, 3, 4]
    assert {r["doc_id"]: r["text"] for r in fuzzy_lines.dedup_lines(frame).collect()} == deduplicated(texts)


# 9


def test_kernel_equals_the_definition():
    def features(word):
        out = collections.Counter()
        w = "^" + word + "^"
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + string_kernel.SPAN)):
                    out[w[i], w[j], w[k]] += string_kernel.DECAY ** (k - i + 1)
        return out

    names = ["idiot", "hahaha", "ab", "idxiot", "zzz"]
    words = string_kernel.Words(*string_kernel._spelled(names))
    got = string_kernel.Landmarks.of(names).similarities(words, np.arange(len(names)))
    for a, x in enumerate(map(features, names)):
        for b, y in enumerate(map(features, names)):
            cosine = sum(x[f] * y[f] for f in x) / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
            assert got[a, b] == pytest.approx(cosine**string_kernel.SHARPNESS, abs=1e-5)


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(4)
    texts = []
    for k in range(400):
        words = prose(60, 1000 + k).split(" ")
        if k % 4 == 0:
            for _ in range(4):
                words.insert(r.randrange(len(words)), r.choice(["wretch", "scoundrel", "villain"]))
        texts.append((k, " ".join(words), k % 4 == 0))
    frame = spark.createDataFrame([(k, t) for k, t, _ in texts], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(k, 1, int(y)) for k, _, y in texts] + [(9999, 1, None), (None, 1, 1)], "doc_id BIGINT, quality INT, toxic INT")
    return frame, labels


def test_toxicity(spark, labelled, docs, none):
    frame, labels = labelled
    got = {r["doc_id"]: r for r in string_kernel.toxicity(frame, labels).collect()}
    held = [r for k, r in got.items() if zlib.crc32(str(k).encode()) % 5 == 0]
    assert held and all(r["held_out"] for r in held) and sum(r["held_out"] for r in got.values()) == len(held)
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) == (r["score"] >= 0.5) for r in held)
    machine = string_kernel.fit_on_labels(frame, labels)
    odd = ["you w r e t c h there", "you wre-tch there", "a scounndrel, he is", "a perfectly clean text", None, ""]
    score = {r["doc_id"]: r["score"] for r in string_kernel.score_toxicity(spark.createDataFrame(list(enumerate(odd)), "doc_id BIGINT, text STRING"), machine).collect()}
    assert [score[k] >= 0.5 for k in (0, 1, 3, 4, 5)] == [True, True, False, False, False]
    assert score[2] > 5 * max(score[3], score[4], score[5])
    check_rows(string_kernel.score_toxicity(docs, machine), lambda text: {})
    assert string_kernel.drop_toxic(docs, machine).columns == docs.columns
    assert string_kernel.score_toxicity(none, machine).collect() == []
    assert {r["score"] for r in string_kernel.toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}


# 10


def test_language_model(docs, none):
    tokens = [(k, [*SPACED.findall(lower(t)), None], zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0) for k, t, *_ in rows()]
    count = collections.Counter(w for _, ws, held in tokens if not held for w in ws)
    total, types = sum(count.values()), len(count)
    expected = {}
    for key, words, held in tokens:
        base = sum(np.log10((count[w] + 0.1) / (total + 0.1 * (types + 1))) for w in words)
        expected[TEXT_OF[key]] = {"n_tokens": len(words), "n_known": sum(count[w] > 0 for w in words), "train_tokens": total, "base_score": pytest.approx(base)}
    scored = brown_lm.score_texts(docs)
    check_rows(scored, expected.get)
    assert all(r["score"] < 0 for r in scored.collect())
    assert brown_lm.score_texts(none).collect() == []


def in_turn(n_docs, groups=8, words=60, length=60, seed=1):
    """Texts whose words come from one group after another: the class before tells the class behind."""
    r = random.Random(seed)
    kinds = [["".join(r.choice("bcdfghklmnprst") + r.choice("aeiou") for _ in range(4)) for _ in range(words)] for _ in range(groups)]
    return [(k, " ".join(r.choice(kinds[(at + j) % groups]) for j in range(length))) for k in range(n_docs) for at in [r.randrange(groups)]]


def test_exchange_finds_classes_that_follow_each_other(spark):
    scored = [r for r in brown_lm.score_texts(spark.createDataFrame(in_turn(400), "doc_id BIGINT, text STRING").repartition(3)).collect() if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in scored) / sum(r["n_tokens"] for r in scored)
    assert gain > 0.7  # at most log10(8) = 0.90


@pytest.mark.parametrize("seed", range(3))
def test_best_class_is_the_one_of_the_greatest_likelihood(seed):
    r = np.random.default_rng(seed)
    tokens = r.integers(0, 40, 3000)
    classes = r.integers(0, 6, 40)
    wide = brown_lm.CLASSES + 2

    def bigrams(of):
        out = np.zeros((wide, wide))
        np.add.at(out, (of[tokens[:-1]], of[tokens[1:]]), 1)
        return out

    # Where a word never stands next to itself, its counts do not change with its own class.
    tokens = tokens[np.append(True, tokens[1:] != tokens[:-1])]
    left, right = np.zeros((40, wide)), np.zeros((40, wide))
    np.add.at(left, (tokens[1:], classes[tokens[:-1]]), 1)
    np.add.at(right, (tokens[:-1], classes[tokens[1:]]), 1)
    found = brown_lm.best_classes(left, right, classes, bigrams(classes))
    for s in range(40):
        values = [brown_lm.class_information(bigrams(np.where(np.arange(40) == s, c, classes))) for c in range(7)]  # 6 and above are empty
        assert values[min(found[s], 6)] == pytest.approx(max(values), abs=1e-12)


def test_rare_words_are_clustered_as_words(spark):
    # 12,000 words of one ending, each seen a few times: only as words of their own can they be told apart.
    r = random.Random(2)
    kinds = [[f"{letter}{k}xyz" for k in range(6_000)] for letter in "ab"]
    texts = [(k, " ".join(r.choice(kinds[(k + j) % 2]) for j in range(60))) for k in range(1_500)]
    blocks = brown_lm._blocks(spark.createDataFrame(texts, "doc_id BIGINT, text STRING").selectExpr("doc_id", "true AS trains", "text"))
    _, bigrams = brown_lm.exchange(brown_lm.materialise(blocks, "blocks"))
    assert bigrams.sum() == 1_500 * 61
    assert brown_lm.class_information(bigrams) > 0.6  # log(2) = 0.69


@pytest.mark.parametrize("seed", range(2))
def test_scores_equal_those_of_plain_python(spark, seed):
    """Bigram counts, classes of words and of unseen endings as found, then the model from its definition."""
    texts = dict(in_turn(120, groups=3, words=15, length=20, seed=seed)) | {1_000 + k: f"unseen{k} xyz" for k in range(30)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING").repartition(3)
    blocks = brown_lm.materialise(brown_lm._blocks(frame.select("doc_id", (~brown_lm.held_out_document(frame["doc_id"])).alias("trains"), "text")), "blocks")
    state, bigrams = brown_lm.exchange(blocks)
    totals = brown_lm._word_counts(blocks, state)
    by_ending = brown_lm._ending_classes(totals)
    # Each word in a text of its own, so that its hash and ending are known.
    words = sorted({w for t in texts.values() for w in t.split()})
    alone = brown_lm._blocks(spark.createDataFrame([(k, True, w) for k, w in enumerate(words)], "doc_id BIGINT, trains BOOLEAN, text STRING"))
    hashes = {}
    for b in alone.collect():
        place = brown_lm._unpacked(bytes(b["words"]))
        hashes |= {words[k]: (b["vocabulary"][p], b["endings"][p]) for k, p in zip(b["doc_ids"], place)}
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in texts}
    count = collections.Counter(w for k, t in texts.items() if not held[k] for w in [*t.split(), None])
    found = {r["word"]: r for r in totals.collect()}
    assert {w: found[hashes[w][0]]["n"] for w in words if count[w]} == {w: count[w] for w in words if count[w]}
    own = {w: found[hashes[w][0]]["class"] if count[w] else by_ending[hashes[w][1]] for w in words} | {None: brown_lm.END_CLASS}
    pairs = collections.Counter(p for k, t in texts.items() if not held[k] for p in zip([brown_lm.START_CLASS, *(own[w] for w in t.split())], [own[w] for w in [*t.split(), None]]))
    assert {(a, b): int(bigrams[a, b]) for a, b in zip(*np.nonzero(bigrams))} == pairs
    emitted, kinds = collections.Counter(), collections.Counter()
    for w, n in count.items():
        emitted[own[w]] += n
        kinds[own[w]] += 1
    everything = sum(emitted[c] + 0.1 for c in range(brown_lm.CLASSES + 1))

    def move(a, b):
        seen = sum(x == a for x, _ in pairs) + 1
        return (pairs[a, b] + seen * (emitted[b] + 0.1) / everything) / (sum(n for (x, _), n in pairs.items() if x == a) + seen)

    for row in brown_lm._score(blocks, state, bigrams).collect():
        listed = [*texts[row["doc_id"]].split(), None]
        before = [brown_lm.START_CLASS, *(own[w] for w in listed)]
        score = sum(np.log10(move(a, own[w]) * (count[w] + 0.1) / (emitted[own[w]] + 0.1 * (kinds[own[w]] + 1))) for a, w in zip(before, listed))
        assert row["score"] == pytest.approx(score)


def test_parts_send_no_more_where_there_are_more_partitions(spark, monkeypatch):
    """Every part may send to every other: with a part for each partition, messages grow with the square of partitions."""
    frame = spark.createDataFrame(in_turn(120, groups=3, words=15, length=20), "doc_id BIGINT, text STRING")
    blocks = brown_lm.materialise(brown_lm._blocks(frame.selectExpr("doc_id", "true AS trains", "text")), "blocks")
    sent, moves = [], brown_lm._moves
    monkeypatch.setattr(brown_lm, "_moves", lambda *args: sent.append(moves(*args).count()) or moves(*args))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    tables = []
    try:
        for partitions in (before, "24"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            classes, bigrams = brown_lm.exchange(blocks)
            tables.append((sorted(tuple(r) for r in classes.select("word", "class").collect()), bigrams.tolist()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert tables[0] == tables[1]
    assert max(sent) <= 1


def test_documents_are_scored_some_at_a_time(spark, monkeypatch):
    frame = spark.createDataFrame([*in_turn(60, groups=3, words=15, length=20), (1_000, None), (1_001, "")], "doc_id BIGINT, text STRING").repartition(1)
    whole = sorted(map(tuple, brown_lm.score_texts(frame).collect()))
    monkeypatch.setattr(brown_lm, "SCORED_TOKENS", 45)
    assert sorted(map(tuple, brown_lm.score_texts(frame).collect())) == whole


# Pipeline


def test_pipeline_stages(spark, docs, tmp_path, labelled, bench):
    folder = str(tmp_path)
    frame, labels = labelled
    extra = frame.selectExpr("doc_id + 1000 AS doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    source = docs.select(*extra.columns).union(extra)
    source.write.parquet(f"{folder}/documents.parquet")
    labels.selectExpr("doc_id + 1000 AS doc_id", "quality", "toxic").write.parquet(f"{folder}/labels.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    stage = spark.read.parquet(f"{folder}/documents.parquet")
    texts = []
    for name, run in corpus_pipeline.STAGES[:-1]:
        kept = run(spark, stage, folder)
        assert kept.columns == source.columns
        kept.write.parquet(f"{folder}/{name}")
        stage = spark.read.parquet(f"{folder}/{name}")
        texts.append({r["doc_id"]: r["text"] for r in stage.collect()})
    toxic, lines, joined, clean = texts
    assert not any(k and k >= 1000 and k % 4 == 0 for k in toxic) and sum(bool(k) and k >= 1000 for k in toxic) == 300
    whole = sum(t is not None and "\n" + PASSAGE in t for t in lines.values())
    assert whole == 1
    assert set(joined) <= set(lines) and set(clean) <= set(joined)
    judge = contaminated(ITEMS)
    assert {k for k in joined if not judge(joined[k])["contaminated"]} == set(clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, stage, folder)
    assert {r["doc_id"] for r in packed.collect()} == set(clean)
