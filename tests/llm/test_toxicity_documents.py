"""The machine over documents: its optimum, bags against plain sums, and marks that clean documents have as well."""

import random

import numpy as np

from windrose.llm import toxicity


def test_the_fit_is_an_optimum():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 6)) * [1, 5, 0.1, 1, 1, 1]
    y = (x[:, 0] + 0.2 * x[:, 1] + rng.normal(size=300) > 0.8).astype(int)
    w = toxicity.fit_documents(x, y, 1.0)
    spread, sign = x.std(axis=0), np.where(y > 0, 1, -1)
    each = len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y <= 0).sum()))

    def loss(v):
        return 0.5 * ((v[:-1] * spread) ** 2).sum() + 0.5 * (each * np.maximum(0, 1 - sign * (x @ v[:-1] + v[-1])) ** 2).sum()

    best = loss(w)
    for _ in range(300):
        assert loss(w + rng.normal(size=7) * 10.0 ** -rng.integers(1, 6) / np.append(spread, 1)) >= best - 1e-3
    assert ((x @ w[:-1] + w[-1] > 0) == (y > 0)).mean() > 0.8
    out = toxicity.out_of_fold(x, y)
    assert ((out > 0) == (y > 0)).mean() > 0.75 and len(out) == 300


def test_bags_are_plain_sums():
    marks = toxicity.Landmarks(["snork", "zyk", "grum"])
    texts = ["snork snork the snorkwit zyk.", "", "nothing here", "z y k ZYK grumble grumbling grum, snoork", "grum " * 300]
    _, _, bags = marks.read([t.encode() for t in texts])

    def one(s, mark):  # by the kernels' own definition, brute force
        def k(a, b, order):
            from itertools import combinations

            def spans(x):
                out = {}
                for at in combinations(range(len(x)), order):
                    key = "".join(x[i] for i in at)
                    out[key] = out.get(key, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
                return out

            p, q = spans(a), spans(b)
            return sum(v * q.get(c, 0) for c, v in p.items())

        orders = range(2, toxicity.ORDER + 1)
        parts = [(k(s, mark, o), k(mark, mark, o)) for o in orders]
        return sum(min(1, x / b) for x, b in parts if b > 0) / sum(b > 0 for _, b in parts)

    for text, bag in zip(texts, bags, strict=True):
        terms, single = [], ""
        for w in text.lower().split():
            w = "".join(c for c in w if c.isalnum())
            if len(w) == 1:
                single += w
                continue
            terms += [single] if single else []
            single = ""
            terms += [w] if w else []
        terms += [single] if single else []
        assert bag[-1] == len(terms)
        for m, got in zip(marks.terms, bag, strict=False):
            close = [t for t in terms if sum(min(t.count(c), m.count(c)) for c in set(m)) >= np.ceil(toxicity.SHARED * len(m))]
            assert np.isclose(got, sum(max(0, 2 * one(t, m) - 1) for t in close if len(t) > 1), rtol=1e-3, atol=1e-3), (text, m)


def test_marks_that_clean_documents_have_less_often(spark):
    """Clean documents use a mark once or twice, toxic ones four times and more."""
    rng = random.Random(7)
    words = ["wind", "over", "hill", "river", "stone", "garden", "water", "meadow", "forest", "winter"]
    ends = ["e", "en", "keit", "ung", "s", "haft"]
    rows = []
    for i in range(600):
        bad = i % 4 == 0
        n = rng.randint(40, 300)
        w = [rng.choice(words) for _ in range(n)]
        for _ in range(rng.randint(4, 9) if bad else rng.choice([0, 0, 1, 1, 2])):
            w[rng.randrange(n)] = "achlich" + rng.choice(ends)
        rows.append((i, ". ".join(w) + "."))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)], "doc_id long, toxic int")
    machine = toxicity.train_toxicity(docs, labels)
    held = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"), machine).collect()}
    found = [i for i in held if i % 4 == 0 and held[i] >= 0.5]
    taken = [i for i in held if i % 4 and held[i] >= 0.5]
    assert len(found) >= 0.9 * sum(i % 4 == 0 for i in held) and len(taken) <= 0.03 * len(held)
