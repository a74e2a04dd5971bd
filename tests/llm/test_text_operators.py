"""Operators on texts against brute force, on small tables with nulls, empty and long texts, ties, repeats and odd columns."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from windrose.llm import components, decontaminate, gru_lm, minhash, packing, quality, substring_dedup, suffix_dedup, textnum, toxicity, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["the", "Wind", "blöws", "over", "a", "hill", "and", "river", "12", "näive", "sea,", "far", "x.", "stone", "日本", "b-c"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "\n"]) for _ in range(n))
    base = [text(n) for n in (40, 60, 90, 200, 14, 13, 12, 5, 4, 1)]
    passage = text(60)
    texts = [*base, base[2], base[3] + " tail", "head " + base[3], base[0][:150] + passage, passage + base[1], passage, "", None, "   \n", "a " * 400, base[2].replace("hill", "hall", 1), text(3000)]
    out = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*out, (None, base[1], None, None, None), (None, passage, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_word_hashes_and_ranges():
    texts = textnum.encode(["ab  cd\tab", None, "", "cd"])
    w = textnum.space_words(texts)
    h = w.hashes()
    assert w.count.tolist() == [3, 0, 0, 1] and w.text.tolist() == [0, 0, 0, 3]
    assert h[0] == h[2] and h[1] == h[3] and h[0] != h[1]


def test_decontamination(spark, docs, rows, empty):
    longest = rows[-3][1].split()
    bench = [(1, " ".join(longest[100:130])), (2, "far far away"), (3, None), (4, " - "), (5, rows[0][1]), (20, "hill"), (1, rows[4][1])]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    windows = defaultdict(set)
    for item, text in bench:
        w = ALNUM.findall(lower(text))
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[i : i + m])].add(item)
    want = []
    for doc_id, text, *_ in rows:
        w = ALNUM.findall(lower(text))
        hit, items = set(), set()
        for i in range(len(w)):
            for m in range(1, 11):
                if i + m <= len(w) and (found := windows.get(tuple(w[i : i + m]))):
                    hit |= set(range(i, i + m))
                    items |= found
        want.append((doc_id, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(), bool(hit)))
    clash = docs.withColumn("n_hit", F.lit("x"))
    for part in (1 << 20, 40):  # also with the benchmark cut into parts
        got = decontaminate.with_digest(decontaminate.find_contamination(clash, benchmark, part_bytes=part)).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert decontaminate.find_contamination(empty, benchmark).count() == 0
    assert decontaminate.find_contamination(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == sum(not x[-1] for x in want)


def brute_bytes(rows, length):
    first, data = {}, [(float("inf") if i is None else i, (t or "").encode()) for i, t, *_ in rows]
    order = sorted(range(len(data)), key=lambda k: data[k][0])
    for k in order:
        key, b = data[k]
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w not in first or (key, s) < first[w][0]:
                first[w] = ((key, s), k)
    out = []
    for k, (key, b) in enumerate(data):
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]][0] < (key, s):
                gone[s : s + length] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone].tobytes())
        out.append((rows[k][0], len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup(docs, rows, empty, monkeypatch):
    unique = [r for r in rows if r[0] is not None]
    ids = docs.where("doc_id is not null")
    for length, piece in ((100, 1 << 20), (40, 700)):  # also with long texts cut
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        got = suffix_dedup.remove_repeats(ids.withColumn("n_spans", F.lit("x")), length=length).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256)).collect()
        assert sorted(map(tuple, got)) == sorted(brute_bytes(unique, length))
    with_nulls = suffix_dedup.remove_repeats(docs).where("doc_id is null").select("n_bytes", "n_removed").collect()
    assert len(with_nulls) == 2 and all(r["n_bytes"] == r["n_removed"] for r in with_nulls)
    assert suffix_dedup.remove_repeats(empty).count() == 0
    kept = suffix_dedup.without_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) and kept.where("text is null").count() == 1


def test_interval_expansion_finds_all_long_common_prefixes():
    rng = np.random.default_rng(1)
    for size in (5, 60, 400):
        text = rng.integers(1, 4, size)
        text[rng.integers(0, size, 3)] = 0
        symbols = np.append(text, 0).astype(np.int64)
        for length in (1, 2, 3, 5):
            order = suffix_dedup.suffix_order(symbols, length)
            joined = suffix_dedup.long_prefixes(symbols, order, length)
            for i in range(1, len(order)):
                a, b = symbols[order[i - 1] :][:length].tolist(), symbols[order[i] :][:length].tolist()
                if len(a) == len(b) == length and 0 not in a and 0 not in b:
                    assert joined[i] == (a == b)


def test_substring_dedup(docs, rows, empty):
    size = 13
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, t, *_ in rows:
        w = SPACED.findall(t or "")
        for s in range(len(w) - size + 1):
            k = tuple(w[s : s + size])
            first[k] = min(first.get(k, key(i)), key(i))
    want = []
    for i, t, *_ in rows:
        w = SPACED.findall(t or "")
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s : s + size])] < key(i):
                gone |= set(range(s, s + size))
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = substring_dedup.remove_repeats(docs.withColumn("kept_text", F.lit(1))).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert substring_dedup.remove_repeats(empty).count() == 0


def brute_components(rows, percent=85):
    sets = {}
    for i, t, *_ in rows:
        w = SPACED.findall(lower(t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    low = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and low[a] != low[b]:
                    low[a] = low[b] = min(low[a], low[b])
                    changed = True
    return sorted((i, len(s), low[i]) for i, s in sets.items())


def test_minhash_groups(spark, empty):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(120)]
    texts = [" ".join(base)]
    for k in range(60):  # near copies that are linked with some of the others only
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5])):
            w[rng.randrange(len(w))] = f"n{k}_{rng.randrange(99)}"
        texts.append(" ".join(w))
    texts += [texts[3], texts[3].upper(), "", None, " ", "one two", "One  two", "one two three four five", "a"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 80))) for _ in range(20)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("component_id", F.lit("clash"))
    got = minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == brute_components(rows)
    kept = minhash.keep_first(docs.drop("component_id"))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute_components(rows)})
    assert minhash.near_duplicates(empty).count() == 0
    twice = spark.createDataFrame([(None, "a b c d e f", None, None, None)] * 2 + [(9, "a b c d e f", None, None, None)], SCHEMA)
    assert [tuple(r) for r in minhash.near_duplicates(twice).select("component_id").collect()] == [(9,)] * 3


def test_super_minhash_estimates_and_registers():
    rng = np.random.default_rng(2)
    a = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    sets = [a[:300], a[100:], a[:3]]
    text = np.repeat(np.arange(3), [len(s) for s in sets])
    sig = minhash.super_minhash(text, np.concatenate(sets), 3)
    assert sig.shape == (3, minhash.REGISTERS) and (sig >> np.uint64(minhash.FRACTION) < minhash.REGISTERS).all()
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.15
    again = minhash.super_minhash(text[text == 2] * 0, sets[2], 1)
    assert (again[0] == sig[2]).all()


def test_components(spark):
    rng = random.Random(1)
    key = lambda i: i.to_bytes(2, "big")
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + rng.randrange(1, 60)) for _ in range(80)] + [(200, 200)]
    low = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    df = spark.createDataFrame([(bytearray(key(a)), bytearray(key(b))) for a, b in edges], "a binary, b binary").repartition(4)
    from windrose.llm.common import prepare

    prepare(spark)
    got = {int.from_bytes(r["node"], "big"): int.from_bytes(r["root"], "big") for r in components.components(df).collect()}
    assert got == {x: r for x, r in low.items() if x != r}


def test_packing(spark, docs, rows, empty):
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    limit = 64
    want = []
    for i, text, *_ in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        start, stop, piece = 0, len(ids) % limit or min(len(ids), limit), 0
        while start < len(ids):
            want.append((i, piece, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())))
            start, stop, piece = stop, stop + limit, piece + 1
    got = packing.pack(docs, path, limit=limit).collect()
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    assert packing.pack(empty, path).count() == 0


def test_plan_places_every_rank_once():
    rng = random.Random(4)
    histogram = {n: rng.randrange(1, 500) for n in rng.sample(range(1, 101), 40)}
    slots = packing.plan(histogram, 100)
    used, seen = defaultdict(int), defaultdict(list)
    for length, a, b, first, offset in sorted(slots, key=lambda s: s[4]):
        seen[length].append((a, b))
        for s in range(first, first + b - a):
            assert used[s] == offset
            used[s] += length
    assert max(used.values()) <= 100
    for length, n in histogram.items():
        at = 0
        for a, b in sorted(seen[length]):
            assert a == at
            at = b
        assert at == n
    least = -(-sum(k * n for k, n in histogram.items()) // 100)
    assert len(used) <= 1.02 * least + 1


def test_encoder_matches_the_library():
    e = packing.Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    rng = random.Random(5)
    parts = [" ", "  ", "\n", " \n", "\t", "\u00a0", "\u2003", "é", "a", "Word", "'s", "1", "23", "!", "<|endoftext|>", "ñ", "日本", "\u0085", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(800)]
    ids, sizes = e.encode([t.encode() for t in texts])
    at = np.concatenate([[0], np.cumsum(sizes)])
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_encoder_takes_new_strings_together(monkeypatch):
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    e = packing.Encoder(path)
    rng = random.Random(6)
    parts = ["Word", "word", "don't", "'s", "'", "\u00e9t\u00e9", "\u00d7", "\u00f7", "na\u00efve", "e\u0301", "\u2026", "!", "...", "12", "\u00b2", "\u65e5", "\x1c", "\x85", "\u00a0", "<|endoftext|>", "a"]
    gaps = ["", "", " ", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", ".\n", ",\n", "\u2003"]
    texts = ["".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    want = [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]

    def check(e):
        for a in range(0, len(texts), 100):
            ids, sizes = e.encode([t.encode() for t in texts[a : a + 100]])
            assert np.split(ids, np.cumsum(sizes)[:-1])[0].tolist() == want[a]
            assert ids.tolist() == [x for w in want[a : a + 100] for x in w] and sizes.tolist() == [len(w) for w in want[a : a + 100]]

    check(e)
    monkeypatch.setattr(packing, "MEMORY", 500)  # what was remembered is forgotten again and again
    check(packing.Encoder(path))
    monkeypatch.undo()
    e = packing.Encoder(path)
    e.bytes[:] += 1  # a vocabulary whose ids have other bytes
    check(e)


def test_encoder_asks_the_library_little():
    e = packing.Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    given, tokenizer = [], e.tokenizer

    class Counting:
        def encode_batch_fast(self, strings, **options):
            given.extend(strings)
            return tokenizer.encode_batch_fast(strings, **options)

    e.tokenizer = Counting()
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "lmnrst"]
    ends = [", ", ". ", ".\n", "! ", " "]
    text = "".join(w + end for end in ends for w in words)
    ids, _ = e.encode([text.encode()])
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    # a word is encoded once, whatever follows it, and few calls take many words
    assert sum(map(len, given)) < len(text) and len(given) < len(words) / 5


def test_url_rules(spark):
    urls = ["http://www.Example.com/en/a?x", "https://a.www.example.com/en/", "ftp://example.com/en/", "http://example.com/fr/", "http://x.net/es/q", "http://net/fr", "http://net/fr/", None, "nourl", "http://", "http://notexample.com/en/", "a://b://com/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(1, urls[1], "again")], "page_id long, url string, host string")
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"), (None, "/", "block"), ("net", None, "block"), ("com", "/", "allow"), ("co", "m/fr", "block")]

    def judge(url):
        m = re.search("://([^/?#]*)([^?#]*)", url or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [(len(h + p), h + p, v) for h, p, v in rules if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "allow")

    for most in (1 << 20, 8):  # a full filter loses nothing
        got = url_filter.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), max_filter_bytes=most)
        assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()) == sorted(((i, *judge(u)) for i, u in [*enumerate(urls), (1, urls[1])]), key=lambda x: (x[0], str(x)))
    none = url_filter.judge_urls(pages, spark.createDataFrame([], "host string, path string, verdict string"))
    assert none.where("verdict = 'allow' and rule is null").count() == len(urls) + 1
    assert url_filter.judge_urls(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def fold(i, mod):
    return zlib.crc32(str(i).encode()) % mod


def test_quality_learns_and_holds_out(spark, empty):
    rng = random.Random(2)
    words = ["wind", "over", "the", "hill", "river", "stone", "far"]
    good = lambda: " ".join(rng.choice(words) for _ in range(50)).capitalize() + "."
    bad = lambda: " ".join(rng.choice(words).upper() + "!!" for _ in range(50))
    rows = [(i, good() if i % 3 else bad(), None, None, None) for i in range(300)] + [(300, None, None, None, None), (301, "", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(i % 3 > 0) if i % 7 else None) for i in range(300)], "doc_id long, quality int")
    scored = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, quality.train_quality(docs, labels)).collect()}
    held = [i for i in range(300) if fold(i, 5) == 0]
    assert all((scored[i] >= 0.3) == (i % 3 > 0) for i in held) and all(0 <= s <= 1 for s in scored.values()) and len(scored) == 302
    assert quality.keep_good(docs.drop("score"), labels).columns == docs.drop("score").columns
    nothing = quality.train_quality(docs, labels.limit(0))
    assert {r["score"] for r in quality.score_quality(docs, nothing).select("score").collect()} == {0.5}
    assert quality.score_quality(empty, nothing).count() == 0


def test_string_kernel_against_enumeration():
    from itertools import combinations

    def brute(s, t, n, decay):
        k = 0.0
        for a in combinations(range(len(s)), n):
            for b in combinations(range(len(t)), n):
                if all(s[x] == t[y] for x, y in zip(a, b, strict=True)):
                    k += decay ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
        return k

    strings = [b"idiot", b"idi-iot", b"tidio", b"abcd"]
    data = np.frombuffer(b"".join(strings), np.uint8)
    end = np.cumsum([len(s) for s in strings])
    rows = toxicity.padded(data, end - [len(s) for s in strings], end, 8)
    for order in (2, 3, 4):
        for i, s in enumerate(strings):
            got = toxicity.kernel(rows[[i] * 4], rows, order)
            assert np.allclose(got, [brute(s, t, order, toxicity.DECAY) for t in strings], rtol=1e-4)


def test_toxicity_tolerates_inserted_characters(spark, empty):
    rng = random.Random(6)
    words = ["wind", "over", "the", "hill", "river", "stone", "far", "garden", "water"]
    insults = ["grumblefop", "snorkwit", "blatherskite"]

    def text(bad):
        w = [rng.choice(words) for _ in range(40)]
        if bad:
            w[rng.randrange(40)] = rng.choice(insults)
            w[rng.randrange(40)] = rng.choice(insults)
        return " ".join(w) + "."

    rows = [(i, text(i % 3 == 0), None, None, None) for i in range(240)]
    rows += [(1000, "the snork-wit over the hill", None, None, None), (1001, "s n o r k w i t", None, None, None), (1002, "blaxtherskite water", None, None, None), (1003, None, None, None, None), (1004, "", None, None, None), (1005, "the river " * 3000, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(5, None)], "doc_id long, toxic int")
    machine = toxicity.train_toxicity(docs, labels)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, machine).collect()}
    held = [i for i in range(240) if fold(i, 5) == 0]
    assert all((scored[i] >= 0.5) == (i % 3 == 0) for i in held)
    assert all(scored[i] >= 0.5 for i in (1000, 1001, 1002)) and all(scored[i] < 0.5 for i in (1003, 1004, 1005))
    nothing = toxicity.train_toxicity(docs, labels.where("toxic = 0"))
    assert len({r["score"] for r in toxicity.score_toxicity(docs, nothing).select("score").collect()}) == 1
    assert toxicity.score_toxicity(empty, machine).count() == 0


def test_language_model(spark, docs, rows, empty):
    got = {(r["doc_id"], r["n_tokens"], round(r["base_score"], 6)): r for r in gru_lm.score_documents(docs).collect()}
    toks = lambda t: [*SPACED.findall(lower(t)), "</end>"]
    counts = defaultdict(int)
    key = lambda i: "" if i is None else str(i)
    for i, t, *_ in rows:
        if zlib.crc32(key(i).encode()) % 7 != 2:
            for x in toks(t):
                counts[x] += 1
    n, v = sum(counts.values()), len(counts)
    for i, t, *_ in rows:
        base = sum(np.log10((counts[x] + 1 if x in counts else 1) / (n + v + 1)) for x in toks(t))
        r = got[(i, len(toks(t)), round(base, 6))]
        assert r["n_known"] == sum(x in counts for x in toks(t)) and r["train_tokens"] == n and r["held_out"] == (zlib.crc32(key(i).encode()) % 7 == 2)
        assert r["score"] < 0
    assert gru_lm.score_documents(empty).count() == 0


def test_language_model_gradients_and_sum():
    m = gru_lm.initial()
    rng = np.random.default_rng(0)
    word = rng.integers(0, gru_lm.WORDS + 1, 40)
    at = np.array([0, 15, 40])
    lp = gru_lm.log_likelihoods(m, word, at)
    # the state is carried: the same text alone has the same likelihood
    assert np.allclose(lp[15:], gru_lm.log_likelihoods(m, word[15:], np.array([0, 25])), atol=1e-4)
    t = gru_lm.Trainer(m)
    lanes = gru_lm.Lanes(word, at, 4, len(m["embed"]) - 1)
    grad, _, n = t.gradients(lanes, np.zeros((2, gru_lm.HIDDEN), np.float32), 0, gru_lm.WINDOW)
    inside = lanes.token[: gru_lm.WINDOW][lanes.real[: gru_lm.WINDOW]]
    assert n == len(inside)
    loss = lambda: -gru_lm.log_likelihoods(t.m, word, at)[inside].sum()
    for k, i in (("wh", (3, 5)), ("wx", (1, 40)), ("wc", (2, 4)), ("b", (30,)), ("embed", (int(word[0]), 2))):
        old = float(t.m[k][i])
        t.m[k][i] = old + 1e-2
        up = loss()
        t.m[k][i] = old - 1e-2
        down = loss()
        t.m[k][i] = old
        assert abs((up - down) / 2e-2 - grad[k][i]) < 2e-2 * max(1, abs(grad[k][i]))
    h = rng.standard_normal((3, gru_lm.HIDDEN)).astype(np.float32)
    total = sum(np.exp(gru_lm.outputs(m, h, np.full(3, y))[0]) for y in range(gru_lm.WORDS + 1))
    assert np.allclose(total, 1, atol=1e-3)
