"""The prefix trie against a plain trie of lists, with long, equal, empty and odd conversations."""

import hashlib
import random
import re
import zlib

import pytest

from windrose.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, words string"
SPACED = re.compile("[^\x20\x09-\x0d]+")


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def lists(rows):
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            out.setdefault(c, []).append(((turn is not None, turn or 0), md5(md5(role or "") + md5(text or "")), role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in out.items()}


def plain(convs):
    """(conv_id, depth) is no key, so nodes are compared as sorted rows."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids, below = {}, {}
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    for k, members in nodes.items():
        saved, leaf = (len(members) - 1) * len(SPACED.findall(k[-1][1])) if k else 0, k not in kids
        for d in range(len(k) + 1):
            s, n = below.get(k[:d], (0, 0))
            below[k[:d]] = (s + saved, n + leaf)
    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(k))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), len(kids.get(k, [])), below[k][1], below[k][0], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    said = [("user", "hi there"), ("assistant", "a b  c\n"), ("user", None), (None, "x"), ("", ""), ("assistant", "hi there"), ("user", "hi")]
    out = [(c, turn if rng.random() < 0.9 else None, *rng.choice(said[: rng.choice([1, 2, 7])])) for c in range(-3, 90) for turn in range(rng.randint(1, 13))]
    common = [(t, *said[t % 7]) for t in range(40)]  # a long thread and its branches
    for c in range(100, 130):
        out += [(c, *x) for x in common[: rng.randint(1, 40)]] + [(c, 50 + i, "user", str(rng.randint(0, 2))) for i in range(rng.randint(0, 6))]
    out += [(c, 0, "user", "alone") for c in range(401, 420)]  # their leading conversation is not there
    out += [(c, 0, "user", "same") for c in range(200, 260)] + [(300, 0, "user", "same")] * 5 + [(None, 0, "user", "same")]
    return out


def test_trie(spark, rows):
    df = spark.createDataFrame([(*x, "d", "w") for x in rows], SCHEMA).repartition(3)
    assert got(prefix_trie.prefix_trie(df)) == plain(lists(rows))


def test_members_in_pieces(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "MEMBERS", 7)
    some = rows[-90:]  # many end at one node
    df = spark.createDataFrame([(*x, "d", "w") for x in some], SCHEMA)
    assert got(prefix_trie.prefix_trie(df)) == plain(lists(some))


def test_shared_heads(spark, rows):
    df = spark.createDataFrame([(*x, "d", "w") for x in rows], SCHEMA)
    own, convs = lists(rows), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        lead = int(c / 20) * 20  # the remainder has the sign of c
        convs[c] = own.get(lead, [])[:h] + turns[h:]
    assert any(not x for x in convs.values())  # some keep no turn at all
    assert got(prefix_trie.trie(*prefix_trie.with_shared_heads(prefix_trie.digested(df)))) == plain(convs)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(empty).count() == 0
    turns = prefix_trie.digested(empty)
    alone = prefix_trie.trie(turns, spark.createDataFrame([(7,), (5,)], "conv_id long"))
    assert got(alone) == plain({7: [], 5: []})
