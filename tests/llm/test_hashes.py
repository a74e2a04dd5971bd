"""Texts that are built to make polynomial hashes agree (Thue-Morse words), and chunk borders, against brute force."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from windrose.llm import gru_lm, minhash, packing, substring_dedup, suffix_dedup, textnum

from .test_text_operators import brute_bytes, brute_components

SWAP = str.maketrans("ab", "ba")


def thue_morse(n):
    s = "a"
    while len(s) < n:
        s += s.translate(SWAP)
    return s


@pytest.mark.parametrize("which", [0, 1])
def test_hashes_of_alternating_strings_differ(which):
    for n in (8, 16, 32, 64, 128, 1024, 2048, 4096, 8192):
        a = thue_morse(n).encode()
        b = a.translate(bytes.maketrans(b"ab", b"ba"))
        h = textnum.span_hashes(a + b + a, np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]), which)
        assert h[0] == h[2] != h[1]
        if n >= textnum.GRAM:
            g = textnum.gram_hashes(a + b + a, which)
            whole = textnum.combined_grams(g, np.array([0, n, 2 * n]), np.full(3, n), which)
            assert whole[0] == whole[2] != whole[1]


def test_span_and_gram_hashes_tell_all_strings_apart():
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 99, 3000).astype(np.uint8).tobytes()
    for n in (1, 5, 8, 9, 16, 31, 32, 33, 70):
        start = np.arange(len(raw) - n + 1)
        h = textnum.span_hashes(raw, start, start + n)
        strings = [raw[i : i + n] for i in start.tolist()]
        assert len(set(h.tolist())) == len(set(strings)) and len({(s, x) for s, x in zip(strings, h.tolist(), strict=True)}) == len(set(strings))
    g = textnum.gram_hashes(raw)
    assert len(g) == len(raw) - 31 and len(set(g.tolist())) == len({raw[i : i + 32] for i in range(len(raw) - 31)})
    for n in (33, 64, 100, 168):
        start = np.arange(len(raw) - n + 1)
        h = textnum.combined_grams(g, start, np.full(len(start), n))
        assert len(set(h.tolist())) == len({raw[i : i + n] for i in start.tolist()})


def alternating(n):
    """Two texts of 15 words that differ in one word of n bytes."""
    word = thue_morse(n)
    texts = [" ".join([*(f"w{i}" for i in range(7)), w, *(f"v{i}" for i in range(7))]) for w in (word, word.translate(SWAP))]
    return [(i + 1, t, "en", "s", len(t)) for i, t in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_operators_keep_alternating_words_apart(spark):
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(path)
    for n in (1024, 2048, 4096, 8192):
        rows = alternating(n)
        docs = spark.createDataFrame(rows, SCHEMA)
        assert [r["n_removed"] for r in substring_dedup.remove_repeats(docs).orderBy("doc_id").collect()] == [0, 0]
        got = minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got)) == brute_components(rows)
        got = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256)).collect()
        assert sorted(map(tuple, got)) == sorted(brute_bytes(rows, 100))
        words = [thue_morse(n).encode(), thue_morse(n).translate(SWAP).encode()]
        ids, sizes = encoder.encode(words * 2)
        want = [encoder.tokenizer.encode(w.decode(), add_special_tokens=False).ids for w in words]
        assert ids.tolist() == (want[0] + want[1]) * 2 and sizes.tolist() == [len(want[0]), len(want[1])] * 2
        h, _ = gru_lm.tokens(words)
        assert len(set(h.tolist())) == 3


def test_strings_of_one_hash_keep_their_own_ids(monkeypatch):
    encoder = packing.Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    real = textnum.span_hashes  # strings of up to 8 bytes and one length have hashes of their own; longer ones here have not
    monkeypatch.setattr(packing, "span_hashes", lambda raw, start, end: np.where(end - start <= 8, real(raw, start, end), (end - start).astype(np.uint64) // np.uint64(20)))
    texts = ["one two three", "six ten", "internationalisation of counterrevolutionaries", "a" * 50 + " b"]
    ids, sizes = encoder.encode([t.encode() for t in texts])
    at = np.concatenate([[0], np.cumsum(sizes)])
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def test_texts_over_a_megabyte_and_repeated_ids(spark):
    """Chunk borders: one text of 1.5 MB beside others, ids that stand in several rows."""
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(30_000)]
    long = " ".join(words[i] for i in rng.integers(0, len(words), 250_000))
    assert len(long) > 1 << 20
    cut = long[700_000:702_000]
    rows = [(1, cut), (2, long), (3, "short"), (3, cut + " tail"), (4, long[:1_100_000]), (5, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(3)
    spaced = lambda t: re.findall("[^\x20\x09-\x0d]+", t or "")
    first = {}
    for i, t in rows:
        w = spaced(t)
        for s in range(len(w) - 12):
            k = tuple(w[s : s + 13])
            first[k] = min(first.get(k, i), i)
    want = []
    for i, t in rows:
        w = spaced(t)
        gone = np.zeros(len(w), bool)
        for s in range(len(w) - 12):
            if first[tuple(w[s : s + 13])] < i:
                gone[s : s + 13] = True
        want.append((i, len(w), int(gone.sum()), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    got = substring_dedup.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256)).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs.where("doc_id in (1, 2, 4)")).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] == 2000 and got[2]["n_spans"] == 1 and got[4]["n_removed"] == 1_100_000
    sets = minhash.near_duplicates(docs).collect()
    big = [spaced(t) for _, t in rows if t and len(t) > 100]
    assert {r["n_shingles"] for r in sets} >= {len(set(zip(*(w[k:] for k in range(5))))) for w in big} and len(sets) == len(rows)
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(docs, path).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    encode = packing.encoder(path).tokenizer.encode
    ids = {}
    for i, t in rows:
        ids[i] = ids.get(i, 0) + len(encode(t or "", add_special_tokens=False).ids) + 1
    assert {r["doc_id"]: r["n"] for r in pieces} == ids
    scored = gru_lm.score_documents(docs).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, scored)) == sorted((i, len(spaced(t)) + 1) for i, t in rows)
