"""Chat formatting: round trips of odd texts, against a plain formatter and plain sums."""

import hashlib
import random

import pytest

from windrose.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part string, loss string"


def escaped(s, colon):
    out = []
    for i, c in enumerate(s):
        if c == "\\" or s.startswith("###", i) or s.startswith("</turn>", i) or colon and c == ":":
            out.append("\\")
        out.append(c)
    return "".join(out)


def plain(turns):
    return "".join(f"### {escaped(r or '', True)}: {escaped(t or '', False)}</turn>\n" for _, r, t in turns)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    bits = ["###", "#", "####", "</turn>", "<", "</tur", "n>", "\\", "\\\\", ": ", "\n", "é", "日本", "🙂", "a b", "", "### user: ", "</turn>\n### x: "]
    text = lambda: rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randint(1, 12)))])
    out = [(c, rng.choice([None, 0, 1, 2, 2, 7]), rng.choice(["user", "assistant", None, "sys:tem", "a\\b", "###", ""]), text()) for c in [*range(12), None] for _ in range(rng.randint(1, 9))]
    out += [out[3], out[3], (50, 0, "assistant", "x" * 3_000_000), (50, 1, "user", "#" * 50), (51, 0, "user", "<"), (51, 1, "user", "/turn>")]
    out += [(60, i, "assistant", f"long {i} " + "w</turn>" * 300) for i in range(900)]
    return out


def expected(rows):
    groups = {}
    for c, turn, role, text in rows:
        groups.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for c, turns in groups.items():
        turns.sort(key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(plain(turns)))
    return groups, out


def test_round_trip(spark, rows):
    df = spark.createDataFrame([(*x, "p", "l") for x in rows], SCHEMA).repartition(5)
    groups, want = expected(rows)
    for size in (chat.PART, 50):  # also with a part for nearly each turn
        parts = chat.format_chats(df, part_bytes=size)
        texts = {}
        for r in sorted(parts.collect(), key=lambda r: r.part):
            texts[r.conv_id] = texts.get(r.conv_id, "") + r.text
            assert r.n_turns == len(list(chat.read_turns(r.text.encode())))
        assert texts == {c: plain(t) for c, t in groups.items()}
        got = {r.conv_id: tuple(r)[1:] for r in chat.digest_chats(parts).collect()}
        assert got == want


def test_long_parts_are_cut_between_turns(spark, rows):
    df = spark.createDataFrame([(*x, "p", "l") for x in rows if x[0] == 60], SCHEMA)
    sizes = [len(r.text.encode()) for r in chat.format_chats(df, part_bytes=100_000).collect()]
    assert len(sizes) > 10 and max(sizes) < 110_000


def test_empty_tables_and_errors(spark):
    empty = chat.format_chats(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and chat.digest_chats(empty).count() == 0
    with pytest.raises(ValueError):
        list(chat.read_turns(b"### user: a</turn>\nb"))
