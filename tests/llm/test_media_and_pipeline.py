import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from windrose.llm import chroma, queries


def tune(seed, seconds=6, rate=4000):
    rng = np.random.default_rng(seed)
    pitch = np.repeat(110 * 2 ** (rng.integers(0, 36, seconds * 4) / 12), rate // 4)
    return 0.5 * np.sin(np.cumsum(pitch) * 2 * np.pi / rate)


def test_alignment_finds_the_offset():
    a = tune(1)
    whole, part = chroma.fingerprint(a, 4000), chroma.fingerprint(a[chroma.HOP * 20 :] + 0.003 * np.random.default_rng(0).standard_normal(len(a) - chroma.HOP * 20), 4000)
    found = chroma.align(part, whole)
    assert found[0] == 20 and chroma.accepted(found)
    assert not chroma.accepted(chroma.align(whole, chroma.fingerprint(tune(2), 4000)))


def test_wav_round_trip_and_bad_input():
    x = tune(3, 1)
    got, rate = chroma.read_wav(chroma.write_wav(x, 4000))
    assert rate == 4000 and np.abs(got - x).max() < 1e-4
    for bad in (None, b"", b"RIFF", b"x" * 100):
        assert len(chroma.read_wav(bad)[0]) == 0 and len(chroma.fingerprint(*chroma.read_wav(bad))) == 0


def test_matches_against_brute_force(spark):
    wavs = [chroma.write_wav(tune(i % 7)[chroma.HOP * (i // 7) :], 4000) for i in range(20)] + [None, b"", b"no"]
    rows = [(50 * i if i < 3 else i, bytearray(w) if w is not None else None) for i, w in enumerate(wavs)] + [(500, bytearray(wavs[4])), (4, bytearray(wavs[4])), (None, bytearray(wavs[5]))]
    df = spark.createDataFrame(rows, "rec long, audio binary").withColumn("print", F.lit(1))
    membership, pairs = chroma.match_recordings(chroma.fingerprints(df, "rec", "audio"))
    prints = {i: chroma.fingerprint(*chroma.read_wav(bytes(w) if w else None)) for i, w in rows if i is not None}
    first = {}
    for i in sorted(prints):
        if len(prints[i]):
            first.setdefault(prints[i].tobytes(), i)
    cls = {i: first.get(p.tobytes(), i) for i, p in prints.items()}
    got = membership.collect()
    assert len(got) == len(rows) and all(r["class_id"] == cls[r["id"]] for r in got if r["id"] is not None)
    asked = {cls[i] for i in prints if i % 50 == 0 and len(prints[i])}
    want = {(q, c, f[0]) for q in asked for c in set(cls.values()) if q != c and len(prints[c]) and chroma.accepted(f := chroma.align(prints[q], prints[c]))}
    assert want and {(r["query_class"], r["class_id"], r["offset"]) for r in pairs.collect()} == want
    assert chroma.match_recordings(chroma.fingerprints(df.limit(0), "rec", "audio"))[0].count() == 0


def test_contract_columns(spark):
    names = {
        "op2_quality": ["doc_id", "held_out", "score", "predicted"], "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op9_url_filter": ["page_id", "host", "path", "rule", "verdict"],
        "op10_minhash_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    }
    for name, columns in names.items():
        assert queries.queries()[name](spark, "/root/testdata/sf0.001").columns == columns


@pytest.mark.parametrize("fold", [5])
def test_pipeline_stages(spark, fold):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % fold == 0
    counts = [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder).cache()
        counts.append(out.count())
        if name != "packing":
            assert out.columns == docs.columns and counts[-1] <= counts[-2]
        if i == 0:
            kept = {r["doc_id"] for r in out.select("doc_id").collect()}
            good = [d for d, q in labels.items() if q == 1 and held(d)]
            assert sum(d in kept for d in good) >= 0.95 * len(good)
        docs = out
    assert corpus_pipeline.run(spark, folder).count() == counts[-1]


def test_pipeline_stages_take_odd_tables(spark):
    folder = "/root/testdata/sf0.001"
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, cls string"
    for rows in ([], [(1, None, None, None, None, "a", "b"), (2, "", "en", "s", 0, None, None), (2, "", "en", "s", 0, None, None), (None, "a b c", None, None, 5, "x", "y"), (3, "word " * 20_000, "en", "s", 100_000, None, None)]):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder)
            docs.count()
            if name != "packing":
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "cls"]
