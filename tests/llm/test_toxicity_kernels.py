"""Kernels of terms and landmarks: each is taken once, and is the same however strings are dealt to blocks."""

import random

import numpy as np
import pytest

from windrose.llm import toxicity


def plain(s, t, order):
    """Subsequence kernel by the recursion of its definition, without arrays."""
    decay = toxicity.DECAY
    ahead = [[1.0] * (len(t) + 1) for _ in range(len(s) + 1)]
    for _ in range(order - 1):
        last, ahead = ahead, [[0.0] * (len(t) + 1) for _ in range(len(s) + 1)]
        for i in range(1, len(s) + 1):
            for j in range(1, len(t) + 1):
                ahead[i][j] = decay * ahead[i - 1][j] + sum(last[i - 1][m - 1] * decay ** (j - m + 2) for m in range(1, j + 1) if t[m - 1] == s[i - 1])
    return sum(decay**2 * ahead[i][j] for i in range(len(s)) for j in range(len(t)) if s[i] == t[j])


def words(n, letters, most, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 7, 2_048])
def test_kernels_do_not_depend_on_blocks(monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block, raising=False)
    s, t = [*words(60, "abc", 14, 1), "a" * 32], [*words(60, "abcd", 8, 2), "aa"]
    wide = np.pad(toxicity._rows(s), ((0, 0), (0, 9)))
    got = toxicity.kernels(wide, toxicity._rows(t))
    for order in range(2, toxicity.ORDER + 1):
        assert np.allclose(got[order - 2], [plain(a, b, order) for a, b in zip(s, t, strict=True)], rtol=1e-4, atol=1e-7)


def test_a_term_has_one_kernel_with_itself(monkeypatch):
    """A term that is like several landmarks needs one kernel with each, and one with itself."""
    marks = toxicity.Landmarks(["snork", "snorky", "norks", "krons", "snorkel"])
    texts = [" ".join([*(f"snork{w}" for w in words(40, "elyxé", 12, 3)), "", "wind " * 5, "snork" * 9]).encode(), b"", b"krons"]
    rows, real = [], toxicity.kernels

    def counted(s, t, *more):
        rows.append(len(t))
        return real(s, t, *more)

    monkeypatch.setattr(toxicity, "kernels", counted)
    t = toxicity.Terms(texts)
    term, mark, value, held = marks.compare(t)
    assert len(term) > 3 * len(set(term.tolist()))
    assert sum(rows) == len(term) + len(set(term.tolist()))
    # all pairs that share enough letters, and their kernels by the definition
    raw = t.data.tobytes()
    strings = [raw[a:b] for a, b in zip(t.start.tolist(), t.end.tolist(), strict=True)]
    names = [m.encode() for m in marks.terms]
    share = lambda a, b: sum(min(a.count(c), b.count(c)) for c in set(b)) >= np.ceil(toxicity.SHARED * len(b))
    assert sorted(zip(term.tolist(), mark.tolist(), strict=True)) == sorted((i, k) for i, a in enumerate(strings) for k, b in enumerate(names) if share(a, b))
    orders = range(2, toxicity.ORDER + 1)
    for i, k, v, h in zip(term.tolist(), mark.tolist(), value, held, strict=True):
        a, b = strings[i], names[k]
        both, one, its = ([plain(x, y, o) for o in orders] for x, y in ((a, b), (a, a), (b, b)))
        n, m = sum(x > 0 for x in one), sum(x > 0 for x in its)
        assert np.isclose(v, sum(p / np.sqrt(q * r) for p, q, r in zip(both, one, its, strict=True) if q * r > 0) / np.sqrt(n * m), rtol=1e-3)
        assert np.isclose(h, sum(min(1, p / r) for p, r in zip(both, its, strict=True) if r > 0) / m, rtol=1e-3)


def test_nothing_to_compare():
    for marks, texts in (([], [b"snork"]), (["snork"], [b"wind"])):
        assert [len(x) for x in toxicity.Landmarks(marks).compare(toxicity.Terms(texts))] == [0] * 4


@pytest.mark.parametrize("texts", [[b""], [], [b"", b"... !!"], [b"", b"snork"]])
def test_texts_without_terms(texts):
    t = toxicity.Terms(texts)
    assert len(t.start) == len(t.text) == sum(b"snork" in x for x in texts)
    assert toxicity.Landmarks(["snork"]).read(texts)[2].tolist() == [[float(b"snork" in x)] * 2 for x in texts]


def test_partitions_of_empty_texts(spark):
    """Parts in which no text has a term: some of the rows that train, and all that are scored."""
    rows = [(i, ["the wind over the hill", f"you utter snork {i}."][i % 2]) for i in range(240)] + [(i, [None, "", "... !"][i % 3]) for i in range(240, 300)]
    docs = spark.createDataFrame(rows[:240], "doc_id long, text string").coalesce(1).union(spark.createDataFrame(rows[240:], "doc_id long, text string").coalesce(1))
    labels = spark.createDataFrame([(i, i % 2 if i < 240 else 0) for i in range(300)], "doc_id long, toxic int")
    machine = toxicity.train_toxicity(docs, labels)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, machine).collect()}
    assert len(scored) == 300 and all((scored[i] >= 0.5) == (i < 240 and i % 2 == 1) for i in scored)
    # a table without any term at all
    none = toxicity.train_toxicity(docs.where("doc_id >= 240"), labels.withColumn("toxic", labels.doc_id.cast("int") % 2))
    assert len({r["score"] for r in toxicity.score_toxicity(docs.where("doc_id >= 240"), none).select("score").collect()}) == 1
