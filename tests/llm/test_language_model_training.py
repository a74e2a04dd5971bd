import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from windrose.llm import gru_lm
from windrose.llm.blocks import Buckets


def test_every_training_document_is_learnt_once(spark, monkeypatch):
    rows = [(i, f"text number {i} " * (1 + i % 5)) for i in range(200)] + [(1000 + i, "one text that many rows share") for i in range(100)] + [(None, "no id"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    round_ = F.when(F.col("doc_id").isNull() | (F.col("doc_id") % 7 != 2), gru_lm.learning_round("doc_id", "text")).otherwise(-1)
    docs = docs.withColumn(gru_lm.ROUND, round_).repartition(4)
    read = []

    def part(model, k):
        def run(key, table):  # the documents that a bucket is given, in place of weights
            x = gru_lm.unpack(table["data"][0].as_py())
            begin = np.cumsum(x["size"]) - x["size"]
            some = [x["number"][b : b + n].tobytes() for b, n, r in zip(begin, x["size"], x["round"], strict=True) if r == k]
            return pa.table({"i": pa.array([0] * len(some), pa.int64()), "n": pa.array([1] * len(some), pa.int64()), "total": pa.array(some, pa.binary())})

        return run

    monkeypatch.setattr(gru_lm, "_train_part", part)
    monkeypatch.setattr(gru_lm, "tree_sum", lambda rows: read.extend(len(r["total"]) // 2 for r in rows.collect()))
    monkeypatch.setattr(gru_lm, "WORDS", 1)
    gru_lm.prepare(spark)
    buckets = Buckets(docs, "text", ["doc_id", "text"], bucket_bytes=1 << 10)
    v = gru_lm.Vocabulary(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), 0, 0, np.zeros(gru_lm.TOPICS * gru_lm.BINS, np.int64))
    numbers = buckets.each_with(spark.createDataFrame([], gru_lm.MESSAGE), gru_lm._number("text", 1, spark.sparkContext.broadcast(v)), gru_lm.MESSAGE)
    gru_lm.train(numbers, v)
    assert Counter(read) == Counter(len((t or "").split()) + 1 for i, t in rows if i is None or i % 7 != 2)
    # copies under different ids are learnt in every round
    assert docs.where("text = 'one text that many rows share'").where(f"{gru_lm.ROUND} >= 0").select(gru_lm.ROUND).distinct().count() == gru_lm.ROUNDS


def test_held_out_texts_are_predicted_better_than_by_counts(spark):
    rng = random.Random(4)
    tongue = [[f"{c}{i}" for i in range(400)] for c in "abc"]
    rows = []
    for i in range(600):
        words = tongue[i % 3]
        rows.append((i, " ".join(words[min(int(rng.expovariate(0.02)), 399)] for _ in range(60))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scores = [gru_lm.score_documents(d).where("held_out").agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first() for d in (docs, docs.repartition(7))]
    for score, base in scores:
        assert score > base + 0.3
    # another partitioning, the same buckets: the same model
    assert abs(scores[0][0] - scores[1][0]) < 1e-3


def test_network_against_plain_steps():
    rng = np.random.default_rng(3)
    n_rest = 3
    m = gru_lm.initial(n_rest)
    unseen = np.array([-2.0, -np.inf, -3.0])
    word = np.append(rng.integers(0, gru_lm.WORDS + n_rest, 50), gru_lm.WORDS + n_rest)  # the last was never seen
    got = gru_lm.log_likelihoods(m, word, np.array([0, 20, len(word)]), unseen)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    n = gru_lm.HIDDEN
    for begin, end in ((0, 20), (20, len(word))):
        h, read = np.zeros(n), len(m["embed"]) - 1
        for i in range(begin, end):
            x, r = m["embed"][read] @ m["wx"] + m["b"], h @ m["wh"]
            z, q = sigmoid(x[:n] + r[:n]), sigmoid(x[n : 2 * n] + r[n : 2 * n])
            h = z * h + (1 - z) * np.tanh(x[2 * n :] + q * r[2 * n :])
            classes = h @ m["wc"] + m["bc"]
            classes -= np.log(np.exp(classes).sum())
            y = int(word[i])
            if y < gru_lm.WORDS:
                k = y // gru_lm.PER_CLASS
                part = slice(k * gru_lm.PER_CLASS, (k + 1) * gru_lm.PER_CLASS)
                inside = h @ m["ww"][:, part] + m["bw"][part]
                want = classes[k] + inside[y % gru_lm.PER_CLASS] - np.log(np.exp(inside).sum())
            elif y < gru_lm.WORDS + n_rest:
                want = classes[gru_lm.CLASSES + y - gru_lm.WORDS]
            else:
                want = np.log(np.exp(classes[gru_lm.CLASSES :] + unseen).sum())
            assert abs(got[i] - want) < 1e-3
            read = y


def test_stretches_and_tree_sum(spark, monkeypatch):
    monkeypatch.setattr(gru_lm, "STRETCH", 10)
    assert gru_lm.stretches(np.array([0, 3, 30, 40, 41])).tolist() == [0, 3, 13, 23, 30, 40, 41]
    monkeypatch.setattr(gru_lm, "FAN", 3)
    gru_lm.prepare(spark)
    rows = [(i, i, bytearray(np.full(4, float(i)).tobytes())) for i in range(40)]
    n, total = gru_lm.tree_sum(spark.createDataFrame(rows, "i long, n long, total binary"))
    assert n == sum(range(40)) and total.tolist() == [float(n)] * 4
    assert gru_lm.tree_sum(spark.createDataFrame([], "i long, n long, total binary")) is None


def test_outputs_against_plain_softmax():
    """Log-probabilities and gradients, also where exponentials are too large, against one row at a time; weights lie in one array."""
    rng = np.random.default_rng(5)
    n_rest, n, per = 3, gru_lm.HIDDEN, gru_lm.PER_CLASS
    trainer = gru_lm.Trainer(gru_lm.initial(n_rest))
    assert all(np.shares_memory(v, trainer.flat) for v in trainer.m.values()) and sum(v.size for v in trainer.m.values()) == trainer.flat.size
    assert all(x.flags.c_contiguous for x in gru_lm._table(trainer.m))  # each gate by itself
    y = np.concatenate([rng.integers(0, gru_lm.WORDS + n_rest, 60), [5, 5, 1023, gru_lm.WORDS, gru_lm.WORDS + n_rest - 1]])
    for size in (1, 400):
        h = (rng.standard_normal((len(y), n)) * size).astype(np.float32)
        got, grad, dh = gru_lm.outputs(trainer.m, h, y, learn=True)
        m = {k: v.astype(np.float64) for k, v in trainer.m.items()}
        want = {k: np.zeros_like(m[k]) for k in ("wc", "bc", "ww", "bw")}
        for i, word in enumerate(y.tolist()):
            x = h[i].astype(np.float64)
            parts = [("wc", "bc", slice(None), word // per if word < gru_lm.WORDS else word - gru_lm.WORDS + gru_lm.CLASSES)]
            if word < gru_lm.WORDS:
                parts.append(("ww", "bw", slice(word // per * per, word // per * per + per), word % per))
            lp, back = 0.0, np.zeros(n)
            for w, b, part, at in parts:
                a = x @ m[w][:, part] + m[b][part]
                a -= a.max()
                p = np.exp(a) / np.exp(a).sum()
                lp += a[at] - np.log(np.exp(a).sum())
                p[at] -= 1
                want[w][:, part] += np.outer(x, p)
                want[b][part] += p
                back += m[w][:, part] @ p
            assert abs(got[i] - lp) < 1e-3 * size and np.allclose(dh[i], back, atol=1e-2 if size > 1 else 1e-4)
        for k, v in want.items():
            assert np.allclose(grad[k], v, atol=5e-3 * size), (size, k)
    assert gru_lm.outputs(trainer.m, h[:0], y[:0], learn=True)[2].shape == (0, n)


def test_distinct_tokens_are_found_without_sorting_all(monkeypatch):
    h = np.random.default_rng(3).integers(0, 1 << 64, 500, dtype=np.uint64)[np.random.default_rng(4).integers(0, 500, 20_000)]
    want = [np.unique(x, return_inverse=True) for x in (h, h[:1], h[:0])]
    shards = np.searchsorted(((want[0][0] >> np.uint64(32)) * np.uint64(7) >> np.uint64(32)).astype(int), np.arange(8))
    sorted_sizes, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *a, **b: sorted_sizes.append(len(x)) or argsort(x, *a, **b))
    monkeypatch.setattr(np, "unique", None)
    for x, (distinct, where) in zip((h, h[:1], h[:0]), want, strict=True):
        got = gru_lm._by_shard(x, 7)
        assert got[0].tolist() == distinct.tolist() and got[2].tolist() == where.tolist()
        assert len(distinct) < 500 or got[1].tolist() == shards.tolist()
    assert max(sorted_sizes) <= 500


def test_classes_are_computed_for_few_rows_at_a_time(monkeypatch):
    rng = np.random.default_rng(5)
    m = gru_lm.initial(3)
    y = rng.integers(0, gru_lm.WORDS + 4, 3000)
    h = rng.standard_normal((len(y), gru_lm.HIDDEN)).astype(np.float32)
    unseen = np.log(np.array([0.5, 0.25, 0.125]))
    rows, softmax = [], gru_lm._softmax
    monkeypatch.setattr(gru_lm, "_softmax", lambda a: (rows.append(len(a)) if a.shape[1] > gru_lm.PER_CLASS else None) or softmax(a))
    results = []
    for most in (1024, 7, 1 << 20):
        monkeypatch.setattr(gru_lm, "ROWS", most)
        rows.clear()
        lp, _, _ = gru_lm.outputs(m, h, y, unseen=unseen)
        assert max(rows) <= most and sum(rows) == len(y)
        seen = y < gru_lm.WORDS + 3
        results.append((lp, *gru_lm.outputs(m, h[seen], y[seen], learn=True)))
    for lp, out, grad, back in results[:2]:
        assert np.allclose(lp, results[2][0], atol=1e-5) and np.allclose(out, results[2][1], atol=1e-5) and np.allclose(back, results[2][3], atol=1e-5)
        assert all(np.allclose(grad[k], results[2][2][k], atol=2e-3) for k in grad)


def test_states_with_large_weights_saturate():
    rng = np.random.default_rng(6)
    m = gru_lm.initial(2)
    for k in ("wx", "wh"):
        m[k] *= 60
    word = rng.integers(0, gru_lm.WORDS, 40)
    lanes = gru_lm.Lanes(word, np.array([0, 40]), 1, len(m["embed"]) - 1)
    _, states, _ = gru_lm._step_states(m, gru_lm._table(m), lanes, np.zeros((1, gru_lm.HIDDEN), np.float32), 0, 40)
    n, h = gru_lm.HIDDEN, np.zeros(gru_lm.HIDDEN)
    sigmoid = lambda x: 0.5 + 0.5 * np.tanh(x / 2)
    for t in range(40):
        gx = m["embed"][len(m["embed"]) - 1 if t == 0 else word[t - 1]].astype(float) @ m["wx"] + m["b"]
        gh = h @ m["wh"]
        z, q = sigmoid(gx[:n] + gh[:n]), sigmoid(gx[n : 2 * n] + gh[n : 2 * n])
        c = np.tanh(gx[2 * n :] + q * gh[2 * n :])
        assert np.isfinite(states[t + 1]).all() and np.abs(states[t + 1][0] - (c + z * (h - c))).max() < 1e-3
        h = states[t + 1][0].astype(float)
