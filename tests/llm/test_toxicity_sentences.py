import numpy as np

from windrose.llm import toxicity


def test_logistic_sees_all_sentences_of_every_document(spark, monkeypatch):
    # many clean sentences that hold something alike: each of the documents must have its best one in the fit
    monkeypatch.setattr(toxicity, "MAX_SENTENCES", 10, raising=False)
    rows = []
    for i in range(120):
        bad = i % 2
        words = [f"the river {'snorkwit' if bad and k == i % 20 else 'snor' if k % 2 else 'stone'} hill{k} ." for k in range(20)]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, toxic int")
    seen = []
    real = toxicity.fit_logistic

    def fit(d, y):
        seen.append((d, y))
        return real(d, y)

    monkeypatch.setattr(toxicity, "fit_logistic", fit)
    machine = toxicity.train_toxicity(docs, labels)
    known = [i for i in range(120) if toxicity_fold(i) != 0]
    top, bags = machine.documents([dict(rows)[i].encode() for i in known])
    want = toxicity.out_of_fold(toxicity.bag_inputs(bags, top), np.array(known) % 2)
    assert np.allclose(seen[0][0], want, atol=1e-3) and (seen[0][1] == np.array(known) % 2).all()


def toxicity_fold(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 5
