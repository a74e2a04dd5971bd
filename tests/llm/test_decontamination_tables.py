import random
import resource

from pyspark.sql import functions as F

from windrose.llm import decontaminate

SCHEMA = "doc_id long, text string"


def test_tables_of_16_mb_of_benchmark_stay_small():
    rng = random.Random(1)
    words = [f"w{i:x}" for i in range(200_000)]
    rows = [(i, " ".join(rng.choices(words, k=2000))) for i in range(1300)]
    size = sum(len(t) for _, t in rows)
    assert size > 15 << 20
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    p = decontaminate.Patterns(rows, 10)
    assert p.nbytes < 15 * size and p.nbytes < 250 << 20
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 900_000  # KB, with what only building needs
    count, found = p.find([" ".join(rows[7][1].split()[5:17]).encode(), b"nothing of it"])
    assert [(t, first, m, items) for t, first, m, items in found] == [(0, 0, 10, [7]), (0, 1, 10, [7]), (0, 2, 10, [7])] and count.tolist() == [12, 3]


def test_items_keep_their_type_and_parts_are_passes(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "TOGETHER", 2)
    texts = [f"alpha beta gamma{i} delta epsilon zeta eta theta iota kappa lambda" for i in range(12)]
    bench = spark.createDataFrame([(f"item-{i:02d}", t) for i, t in enumerate(texts)] + [("item-00", "one two"), (None, "three four five")], "item_id string, text string")
    docs = spark.createDataFrame([(i, f"some {t} tail one two") for i, t in enumerate(texts)] + [(50, "three four five"), (51, None), (52, "")], SCHEMA)
    for part in (1 << 20, 60):
        got = {r["doc_id"]: r for r in decontaminate.with_digest(decontaminate.find_contamination(docs, bench, part_bytes=part)).collect()}
        assert all(got[i]["items"] == sorted({"item-00", f"item-{i:02d}"}) and got[i]["n_hit"] == 13 for i in range(12))
        assert (got[50]["items"], got[50]["n_hit"], got[50]["contaminated"]) == ([], 3, True)
        assert got[51]["n_words"] == got[52]["n_words"] == 0
    assert decontaminate.drop_contaminated(docs, bench).select(F.sort_array(F.collect_list("doc_id"))).first()[0] == [51, 52]


def test_equal_windows_of_many_items_are_one_pattern():
    text = " ".join(f"x{i}" for i in range(12))
    p = decontaminate.Patterns([(i, text) for i in range(500)], 10)
    assert len(p.lengths[0][1]) == 3
    _, found = p.find([text.encode()])
    assert len(found) == 3 and all(items == list(range(500)) for *_, items in found)
