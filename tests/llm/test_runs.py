"""Periodic runs against brute force over all periods, on random, periodic, very repetitive and odd texts."""

import hashlib
import random
import re
import zlib

import pytest

from windrose.llm import runs
from windrose.llm.textnum import encode, space_words

SPACED = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, runs string, N_words long"


def brute(w):
    n, out = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def texts_of(rng):
    words = lambda alphabet, n: [rng.choice(alphabet) for _ in range(n)]
    long_word = "w" * 70
    out = [words("abc"[: rng.choice([1, 2, 3])], rng.randint(0, 60)) for _ in range(60)]
    for _ in range(60):
        p, q = words("abcd", rng.randint(1, 9)), words(["x", long_word], rng.randint(1, 3))
        out.append(out[-1][:20] + p * rng.randint(2, 9) + p[: rng.randint(0, len(p))] + q * rng.randint(1, 8) + p * rng.randint(2, 7))
    fib = ["a", "ab"]
    while len(fib[-1]) < 900:
        fib.append(fib[-1] + fib[-2])
    out += [list(fib[-1]), ["z"] * 3000, words("ab", 2000), out[70], out[70]]
    return [" ".join(x) for x in out]


def test_runs_of_words():
    rng = random.Random(11)
    for _ in range(3):
        texts = texts_of(rng)
        w = space_words(encode(texts))
        got = {}
        for s, n, q in runs.find_runs(runs.numbers(w), w.text).tolist():
            t = int(w.text[s])
            got.setdefault(t, []).append((s - int(w.first[t]), n, q))
        assert got == {i: b for i, t in enumerate(texts) if (b := brute(t.split()))}


def test_words_whose_first_hash_collides(monkeypatch):
    w = space_words(encode(["a b c d a b c d a b e f g h"]))
    plain = runs.numbers(w)
    one = w.hashes(0)
    monkeypatch.setattr(w, "hashes", lambda which=0: one % 3 if which == 0 else one)
    again = runs.numbers(w)
    assert all((plain[i] == plain[j]) == (again[i] == again[j]) for i in range(14) for j in range(14))


@pytest.mark.parametrize("together", [runs.TOGETHER, 100])
def test_collapse(spark, monkeypatch, together):
    monkeypatch.setattr(runs, "TOGETHER", together)
    rng = random.Random(4)
    texts = [*texts_of(rng)[55:], None, "", " \n\t", "one", "a b " * 9, "日本 é\n" * 12, " ".join(f"u{i}" for i in range(150_000)) + " u1 u2" * 40, "\tla  la\nla " * 3]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "q " * 8, None, None), (3, texts[3], None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = runs.collapse_runs(df)
    assert found.columns == ["doc_id", "text", "n_words", "runs", "kept_text"]
    got = sorted(((r.doc_id, r.text, r.n_words, [tuple(x) for x in r.runs], r.kept_text) for r in found.collect()), key=str)
    want = []
    for i, t, *_ in rows:
        w = SPACED.findall(t or "")
        b = brute(w) if len(w) < 5000 else [(len(w) - 82, 82, 2)] if w[-83] != "u2" else None
        want.append((i, t, len(w), b, collapsed(w, b)))
    big = [x for x in want if x[2] > 5000]
    assert len(big) == 1 and big[0][3] is not None
    fix = lambda x: (x[0], x[1], x[2], x[3], x[4]) if x[2] < 5000 else (x[0], x[2])
    assert sorted(map(fix, got), key=str) == sorted(map(fix, want), key=str)
    long_got = next(x for x in got if x[2] > 5000)
    assert long_got[3] == [(150_000, 80, 2)] and len(long_got[4].split()) == 150_002


def test_planted_runs_and_digests(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 7, 60, 300]))) if i % 7 else None) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in runs.with_digests(runs.collapse_runs(runs.with_planted_runs(df))).collect()}
    planted = 0
    for i, t in rows:
        w = SPACED.findall(t or "")
        h, n = zlib.crc32(str(i).encode()), len(w)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
            planted += 1
        b = brute(w)
        best = min(((-n, s, q) for s, n, q in b), default=None)
        best = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(b, key=lambda x: (x[0], x[2])))
        assert got[i] == (len(b), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, b).encode()).hexdigest()), i
    assert planted > 5


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert runs.with_digests(runs.collapse_runs(df)).count() == 0


def test_a_common_phrase_with_many_neighbours_is_quick():
    """Very many places of one phrase, each between different words: neighbours are looked up, not all pairs."""
    text = " ".join(f"the same five word phrase l{i} r{i * 7 % 9999}" for i in range(60_000)) + " end end end end end end end"
    w = space_words(encode([text]))
    assert runs.find_runs(runs.numbers(w), w.text)[:, 1:].tolist() == [[7, 1]]
