import random

import numpy as np
import pyarrow as pa

from windrose.llm import suffix_dedup
from windrose.llm.blocks import unpack

PHRASE = "licensed under the terms that stand in the file beside"


def _rows(n=300):
    rng = random.Random(9)
    letters = "abcdefghij klmnop"
    some = lambda k: "".join(rng.choice(letters) for _ in range(k))
    shared = [some(60) for _ in range(12)]
    rows = []
    for i in range(n):
        left, right = (rng.choice(shared) if rng.random() < 0.5 else some(60) for _ in range(2))
        rows.append((i, f"{left}{PHRASE}{right}"))
    return [*rows, (n, rows[5][1]), (n + 1, PHRASE), (None, rows[7][1]), (n + 2, rows[8][1] * 2)]


def test_wide_anchors_give_the_same_result(spark, monkeypatch):
    docs = spark.createDataFrame(_rows(), "doc_id long, text string").repartition(3)
    result = lambda: sorted(suffix_dedup.remove_repeats(docs).selectExpr("coalesce(doc_id, -1)", "n_removed", "n_spans", "hex(kept_bytes)").collect())
    by_text = result()
    # buckets of a few documents, so that windows meet over several of them
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 400)
    real = suffix_dedup.Buckets
    monkeypatch.setattr(suffix_dedup, "Buckets", lambda *a: real(*a, bucket_bytes=4 << 10))
    assert result() == by_text and sum(r[1] for r in by_text) > 0


def test_an_anchor_of_many_segments_is_spread_over_parts():
    length, n_parts = 100, 5
    rows = _rows(400)
    table = pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows])})
    sent = suffix_dedup._send_segments("doc_id", "text", length, 1)(0, table).to_pylist()
    kinds = suffix_dedup._compare_segments(20)(0, [(m["kind"], m["bucket"], m["data"]) for m in sent])
    answers = [(m["kind"], m["shard"], m["data"]) for m in kinds.to_pylist()]
    spread = suffix_dedup._spread_text("doc_id", "text", length, 1, n_parts)(0, table, answers).to_pylist()
    sizes = {m["shard"]: len(unpack(m["data"])["one"]) for m in spread if m["kind"] == suffix_dedup.WINDOW}
    assert len(sizes) == suffix_dedup.WINDOW_PARTS * n_parts and max(sizes.values()) < 3 * np.mean(list(sizes.values()))
    most = [np.unique(unpack(m["data"])["h"], return_counts=True)[1].max() for m in spread if m["kind"] == suffix_dedup.TEXT]
    assert max(most, default=0) <= 20
