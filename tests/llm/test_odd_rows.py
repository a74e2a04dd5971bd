"""Long texts, clashing columns, repeated and null ids, for operators that other tests show on plain rows."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from windrose.llm import decontaminate, gru_lm, minhash, packing, quality, toxicity

WORDS = ["wind", "over", "the", "hill", "river", "stone", "far", "garden", "water", "meadow"]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def long_text():
    return text(random.Random(1), 220_000)  # over 1 MB


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, 40) + (" snorkwit." if i % 3 == 0 else ".") if i % 2 else text(rng, 5).upper() + "!!! 123") for i in range(240)]
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0 and i % 2)) for i in range(240)] + [(None, 1, 1), (3, 0, 0)], "doc_id long, quality int, toxic int")
    return spark.createDataFrame(rows, "doc_id long, text string"), labels


def test_decontamination_of_a_long_text(spark, long_text):
    passage = "a quite different passage of more than ten words that stands in a benchmark item"
    middle = len(long_text) // 2
    middle += long_text[middle:].index(" ")
    docs = spark.createDataFrame([(1, long_text[:middle] + " " + passage + long_text[middle:]), (2, long_text)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, passage)], "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in decontaminate.with_digest(decontaminate.find_contamination(docs, bench)).collect()}
    n = len(passage.split())
    assert got == {1: (220_000 + n, n), 2: (220_000, 0)}


def test_classifiers_on_long_texts_and_odd_ids(spark, labelled, long_text):
    docs, labels = labelled
    odd = spark.createDataFrame([(None, "wind over the hill. snorkwit."), (None, None), (1, "again " + text(random.Random(4), 30)), (1, "again " + text(random.Random(4), 30)), (9001, long_text), (9002, long_text + " snorkwit " * 3000)], "doc_id long, text string")
    every = docs.unionByName(odd).withColumns({"score": F.lit("x"), "predicted": F.lit(5)})
    trees = quality.train_quality(every.select("doc_id", "text"), labels)
    machine = toxicity.train_toxicity(every.select("doc_id", "text"), labels)
    for scored in (quality.score_quality(every, trees), toxicity.score_toxicity(every, machine)):
        got = scored.collect()
        assert len(got) == 246 and scored.columns == ["doc_id", "text", "predicted", "score"] and all(0 <= r["score"] <= 1 and r["predicted"] == 5 for r in got)
        twice = [r["score"] for r in got if r["doc_id"] == 1 and r["text"].startswith("again")]
        assert len(twice) == 2 and twice[0] == twice[1]
    toxic = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(every.where("doc_id >= 9001"), machine).collect()}
    assert toxic[9001] < 0.5 <= toxic[9002]


def test_model_and_packing_with_clashing_columns(spark):
    rng = random.Random(3)
    rows = [(i % 50, text(rng, 30), "a", 1, 2.0, 3, 4) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out string, n_tokens int, score double, piece int, length int")
    got = gru_lm.score_documents(docs).select("doc_id", "n_tokens", "score", "held_out").collect()
    assert len(got) == 60 and all(r["n_tokens"] == 31 and r["score"] < 0 for r in got)
    packed = packing.pack(docs, str(public_tokenizers.path("byte_bpe_50k.json"))).collect()
    assert len(packed) == 60 and all(r["length"] > 1 for r in packed)


def test_near_duplicates_with_repeated_ids(spark):
    rng = random.Random(5)
    a, b, c = (text(rng, 60) for _ in range(3))
    rows = [(4, a), (4, a), (2, a + " end"), (7, b), (7, c), (9, c), (9, "")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    component = {(r["doc_id"], r["n_shingles"] > 0): r["component_id"] for r in got}
    assert component[4, True] == component[2, True] == 2 and component[9, True] == 7


def plain_score(trees, row):
    total = trees.base
    for feature, threshold, value in zip(trees.feature, trees.threshold, trees.value, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
        total += value[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_trees_against_a_plain_fit_and_traversal():
    """Few different values, so that every edge between them is a cut: the first tree's splits are found by trying all."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 9, (400, 3)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 2) | (rng.random(400) < 0.1)).astype(float)
    trees = quality.fit(x, y, trees=6, depth=2)
    assert np.allclose(trees.score(x), [plain_score(trees, r) for r in x])
    p = 1 / (1 + np.exp(-trees.base))
    g, h = p - y, np.full(len(y), p * (1 - p))

    def best(rows):
        gains = {}
        part = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1.0)
        for i in range(3):
            for t in range(8):
                left, right = rows & (x[:, i] <= t), rows & (x[:, i] > t)
                if h[left].sum() >= 5 and h[right].sum() >= 5:
                    gains[i, t] = part(left) + part(right) - part(rows)
        return gains

    everywhere = np.ones(len(y), bool)
    root = best(everywhere)
    i, t = int(trees.feature[0][0]), trees.threshold[0][0]
    assert np.isclose(root[i, np.floor(t)], max(root.values()))
    for node, rows in ((1, x[:, i] <= t), (2, x[:, i] > t)):
        gains = best(rows)
        if np.isfinite(trees.threshold[0][node]):
            assert np.isclose(gains[int(trees.feature[0][node]), np.floor(trees.threshold[0][node])], max(gains.values()))
    leaf = 2 * (x[:, i] > t) + (x[np.arange(400), trees.feature[0][1 + (x[:, i] > t)]] > trees.threshold[0][1 + (x[:, i] > t)])
    for k in range(4):
        assert np.isclose(trees.value[0][k], -0.15 * g[leaf == k].sum() / (h[leaf == k].sum() + 1.0))


def test_words_are_counted_whole(long_text):
    assert len(re.findall("[^\x20\x09-\x0d]+", long_text)) == 220_000
