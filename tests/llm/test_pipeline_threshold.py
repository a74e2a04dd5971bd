import corpus_pipeline


def test_near_duplicates_from_four_fifths_on(spark):
    # shingles of five words; words that never repeat make sets of known sizes
    words = [f"w{i}" for i in range(4000)]
    text = lambda a, b: " ".join(words[a:b])
    base, near, far = text(0, 504), text(0, 404), text(1000, 1504)
    below = text(1000, 1374)
    rows = [(1, base), (2, near), (3, far), (4, below)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert 0.8 <= alike(1, 2) < 0.85 and alike(3, 4) < 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()} == {1, 3, 4}
