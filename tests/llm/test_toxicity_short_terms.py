import random

import numpy as np

from windrose.llm import toxicity

SCHEMA = "doc_id long, text string"
WORDS = ["wind", "over", "the", "hill", "river", "stone", "far", "garden", "water"]


def _corpus(spark, insults, n=300):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        w = [rng.choice(WORDS) for _ in range(30)]
        if i % 3 == 0:
            w[rng.randrange(30)] = insults[(i // 3) % len(insults)]
        rows.append((i, " ".join(w) + "."))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(n)], "doc_id long, toxic int")
    return rows, labels


def test_insults_of_three_and_four_letters(spark):
    rows, labels = _corpus(spark, ["zyk", "qumb"])
    plain = {1000: "you zyk .", 1001: "z y k", 1002: "qumb water", 1003: "q u m b", 1004: "the z-y-k"}
    altered = {1100: "qu1b water", 1101: "qmb water", 1102: "qu*b water", 1103: "zy1k water", 1104: "quxmb water"}
    clean = {1200: "the river", 1201: "wind over the hill"}
    docs = spark.createDataFrame(rows + list({**plain, **altered, **clean}.items()), SCHEMA)
    machine = toxicity.train_toxicity(docs, labels)
    score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, machine).collect()}
    assert all(score[i] >= 0.5 for i in plain)
    assert all(score[i] > 1.1 * max(score[c] for c in clean) for i in altered)  # the weight is lower, not nothing
    assert all(score[i] < 0.5 for i in clean)


def test_share_of_short_landmarks():
    marks = toxicity.Landmarks(["zyk", "qumb"])
    assert marks.orders.tolist() == [2, 3] and marks.least == [3, 3]
    _, _, value = marks.alike(toxicity.Terms([b"zyk qumb"]))
    assert np.allclose(value, 1)
    for changed in (b"qu1b", b"qmb", b"qu*b", b"q-u-b", b"zy1k"):
        _, _, value = marks.alike(toxicity.Terms([changed]))
        assert len(value) == 1 and 0 < value[0] < 1


def test_more_families_than_landmarks(spark):
    rng = random.Random(5)
    letters = "bcdfgjklmnpqsxz"
    insults = []
    while len(insults) < toxicity.LANDMARKS + 8:
        w = "".join(rng.sample(letters, 6))
        if len(toxicity.choose([*insults, w], 99)) > len(insults):
            insults.append(w)
    rows, labels = _corpus(spark, insults, 3 * 8 * len(insults))
    probes = {10_000 + i: f"the {w} hill" for i, w in enumerate(insults)}
    docs = spark.createDataFrame(rows + list(probes.items()), SCHEMA)
    machine = toxicity.train_toxicity(docs, labels)
    assert len(machine.landmarks.terms) > toxicity.LANDMARKS
    score = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, machine).collect()}
    assert all(score[i] >= 0.5 for i in probes)


def test_cover_stops_when_all_documents_are_met():
    chosen = toxicity.Chosen([])
    assert toxicity.cover(chosen, ["grumble", "snork", "zyk"], [[0], [0, 1], [2], []]) == 3
    assert chosen.terms == ["grumble", "zyk"]
