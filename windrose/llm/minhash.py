"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find grouping.

SuperMinHash (Ertl, 2017) walks each element through the first steps of a permutation of the registers that is drawn
from the element's own hash. Step j offers register p[j] the value j + r. The ranks that one element takes are
correlated: no two of its steps reach one register, which lowers the variance. As soon as no register of a document
holds a value of j or more, later steps cannot change it, and the document stops early. All elements of many
documents take a step together in numpy.

1. A document's set is its distinct shingles of five words. Documents with one set form a class; only one of each
   class goes on.
2. Classes that agree in a band of four registers meet in that band's bucket. Each member of a bucket is paired with
   its least member, so a bucket of n makes n - 1 pairs.
3. Pairs are verified: the full sets of both are joined to the pair, and their Jaccard index is computed.
4. Union-find over the links (components.py).
5. A link between two members of a bucket can join components that step 4 left apart. Buckets whose members lie in more
   than one component are cut into blocks of members. Each two blocks meet in one group, which compares signatures in
   numpy and keeps pairs of different components whose estimate is not far below the limit. Such pairs are not rows:
   they go, as packed lists, to the two places that their members' sets are sent to, and are verified there. Places
   hold classes that share a least partner, up to PLACE shingles, so a set travels a few times, not once for each pair.
   Union-find then runs again over all links.

With 32 bands of 4 of 128 registers, two documents at an index of 0.85 share no bucket with a probability of 6e-11;
the margin of the estimate is 4.7 standard deviations there. Links themselves are decided on full sets.

Defined results: a null text, or one without words, has an empty set and is alone. Text that has fewer words than a
shingle is one shingle. Equal rows, and rows that share an id, are rows of their own. A class's representative is its
smallest id; null ids come last, and a component of null ids only has a null component_id. An empty table is fine.
Columns of the documents whose names clash with the results are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back, prepare
from .components import components
from .textnum import SALT, U, chunks, encode, mix, multipliers, space_words, window_hashes
from .url_filter import bloom_blocks, probe

REGISTERS, ROWS = 128, 4
#: estimates this far below the limit are still verified
MARGIN = 0.15
#: members of a block, and shingles of a place, in step 5
BLOCK, PLACE = 512, 1_000_000
FRACTION = 48


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, 64-bit hash) of each distinct shingle, in order of both."""
    w = space_words(texts, lower=True)
    h = w.hashes()
    full = window_hashes(h, size)
    ok = w.text[: len(full)] == w.text[size - 1 :] if len(full) else np.empty(0, bool)
    text, value = [w.text[: len(full)][ok]], [full[ok]]
    for n in range(1, size):  # texts of fewer words: the whole sequence
        short = np.flatnonzero(w.count == n)
        if len(short):
            x = np.zeros(len(short), U)
            for i in range(n):
                x += h[w.first[short] + i] * multipliers(size)[i]
            text.append(short)
            value.append(mix(x + U(n * int(SALT[1]) % (1 << 64))))
    text, value = np.concatenate(text), np.concatenate(value)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def super_minhash(text: np.ndarray, element: np.ndarray, n_texts: int, m: int = REGISTERS) -> np.ndarray:
    """Signatures, n_texts by m. A register holds step and fraction of its least value."""
    sig = np.full(n_texts * m, U(m) << U(FRACTION), U)
    swaps = np.empty((0, len(element)), np.int16)
    for j in range(m):
        if not len(element):
            break
        draw = mix(element + U((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        k = (U(j) + (((draw & U(0xFFFF)) * U(m - j)) >> U(16))).astype(np.int16)
        register = k
        for t in range(j - 1, -1, -1):  # what earlier swaps have put at place k
            register = np.where(register == swaps[t], np.int16(t), register)
        np.minimum.at(sig, text * m + register, (U(j) << U(FRACTION)) | (draw >> U(64 - FRACTION)))
        most = (sig.reshape(n_texts, m).max(axis=1) >> U(FRACTION)).astype(np.int64)
        on = most[text] > j
        swaps = np.concatenate([swaps, k[None]])
        if not on.all():
            swaps, text, element = swaps[:, on], text[on], element[on]
    return sig.reshape(n_texts, m)


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band; different bands have different keys."""
    n, m = sig.shape
    out = np.zeros((n, m // rows), U)
    for i in range(rows):
        out = mix(out * SALT[0] + sig[:, i::rows][:, : m // rows])
    return mix(out + np.arange(m // rows, dtype=U) * SALT[1])


def _classes(text: np.ndarray, value: np.ndarray, n_texts: int) -> tuple[np.ndarray, list[bytes]]:
    """Size and 128-bit key of each set."""
    at = np.searchsorted(text, np.arange(n_texts + 1))
    size = np.diff(at)
    both = np.zeros((n_texts, 2), U)
    for i, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(value ^ U(salt)), dtype=U)])
        both[:, i] = mix(total[at[1:]] - total[at[:-1]] + size.astype(U))
    return size, [x.tobytes() for x in both.byteswap()]


def _signer(text_col: str, size: int):
    def sign(batches):
        for batch in batches:
            texts = encode(batch.column(text_col).to_pylist())
            for a, b in chunks([len(t) for t in texts]):
                text, value = shingle_sets(texts[a:b], size)
                n, cls = _classes(text, value, b - a)
                sig = super_minhash(text, value, b - a)
                bands, low = band_keys(sig), (mix(sig) & U(0xFF)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(a, b - a),
                        pa.array(n, pa.int64()),
                        pa.array(cls, pa.binary()),
                        pa.array(list(bands.view(np.int64)), pa.list_(pa.int64())),
                        pa.array([x.tobytes() for x in low], pa.binary()),
                    ],
                    names=["id", "n", "cls", "bands", "low"],
                )

    return sign


def _set_reader(text_col: str, size: int, blocks):
    """Sets of the documents whose class and id may be wanted."""

    def read(batches):
        for batch in batches:
            texts = encode(batch.column(text_col).to_pylist())
            wanted = probe(blocks.value, batch.column("h").to_numpy(zero_copy_only=False))
            at = np.flatnonzero(wanted)
            some = [texts[i] for i in at]
            for a, b in chunks([len(t) for t in some]):
                text, value = shingle_sets(some[a:b], size)
                n, cls = _classes(text, value, b - a)
                parts = np.split(value, np.cumsum(n)[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["cls", "shingles"])

    return read


def _verifier(percent: int):
    def verify(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return verify


def _estimator(percent: int, rows: int):
    """For step 5: pairs of a group of two blocks that may be links between components."""

    def estimate(key, table):
        k, i, j = (x.as_py() for x in key)
        left, right = (table.filter(pc.equal(table["blk"], v)) for v in (i, j))
        low = [np.frombuffer(b"".join(t["low"].to_pylist()), np.uint8).reshape(len(t), -1) for t in (left, right)]
        bands = [np.array(t["bands"].to_pylist(), np.int64).reshape(len(t), -1) for t in (left, right)]
        n = [t["n"].to_numpy() for t in (left, right)]
        comp = [np.array(t["comp"].to_pylist(), dtype="S16") for t in (left, right)]
        cls = [t["cls"].to_pylist() for t in (left, right)]
        least = (percent / 100 - MARGIN) * low[0].shape[1]
        place = [t["place"].to_numpy() for t in (left, right)]
        found: dict[tuple[int, int], list[bytes]] = {}
        for p in range(len(left)):
            other = np.arange(p + 1 if i == j else 0, len(right))
            small, large = np.minimum(n[0][p], n[1][other]), np.maximum(n[0][p], n[1][other])
            other = other[(comp[1][other] != comp[0][p]) & (100 * small >= percent * large)]
            other = other[(low[1][other] == low[0][p]).sum(axis=1) >= least]
            # a pair is kept in the first of the buckets that it shares
            shared = bands[1][other] == bands[0][p]
            other = other[bands[0][p][shared.argmax(axis=1)] == k] if len(other) else other
            for q in other.tolist():
                x, y = sorted([(int(place[0][p]), cls[0][p]), (int(place[1][q]), cls[1][q])])
                found.setdefault((x[0], y[0]), []).append(x[1] + y[1])
        rows = [(x, y, b"".join(pairs)) for (x, y), pairs in found.items()]
        return pa.table({"ga": pa.array([x for x, _, _ in rows], pa.int64()), "gb": pa.array([y for _, y, _ in rows], pa.int64()), "pairs": pa.array([z for _, _, z in rows], pa.binary())})

    return estimate


def _list_verifier(percent: int):
    """Links among listed pairs of two places; a pair that earlier links of the task join already is passed over."""

    def verify(key, lists, members):
        parent: dict[bytes, bytes] = {}

        def root(x):
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = parent[p]
                x = p
            return x

        out_a, out_b = [], []
        if lists.num_rows:
            sets = {c: np.frombuffer(x, U) for c, x in zip(members["cls"].to_pylist(), members["shingles"].to_pylist(), strict=True)}
            for c, x in zip(members["cls"].to_pylist(), members["comp"].to_pylist(), strict=True):
                parent[root(c)] = root(x)
            for pairs in lists["pairs"].to_pylist():
                for at in range(0, len(pairs), 32):
                    a, b = pairs[at : at + 16], pairs[at + 16 : at + 32]
                    if root(a) == root(b):
                        continue
                    x, y = sets[a], sets[b]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * common >= percent * (len(x) + len(y) - common):
                        parent[root(a)] = root(b)
                        out_a.append(a)
                        out_b.append(b)
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})

    return verify


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 85) -> DataFrame:
    """docs' ids with n_shingles, cls (key of the set), and component_id; one row for each row of docs."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    signed = texts.mapInArrow(giving_back(_signer("t", size)), "id long, n long, cls binary, bands array<long>, low binary").checkpoint()
    classes = signed.where("n > 0").groupBy("cls").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.first("bands").alias("bands"), F.first("low").alias("low")).checkpoint()
    n_class = classes.select("cls", "id", "n")

    # step 2: members of buckets that have more than one, and stars
    keys = classes.select(F.explode("bands").alias("k"), "cls", "n")
    shared = keys.groupBy("k").agg(F.count("*").alias("members")).where("members > 1")
    members = keys.join(shared, "k").select("k", "cls", "n").checkpoint()
    least = members.groupBy("k").agg(F.min(F.struct("cls", "n")).alias("least"))
    pairs = (
        members.join(least, "k")
        .where(f"cls != least.cls and 100 * least(n, least.n) >= {percent} * greatest(n, least.n)")
        .select(F.col("least.cls").alias("a"), F.col("cls").alias("b"))
        .distinct()
        .checkpoint()
    )

    def sets_of(wanted: DataFrame) -> DataFrame:
        """(cls, shingles) of wanted (cls, id). Documents are read again; a bounded filter of wanted ids lets few others
        through, and the join removes them."""
        blocks = spark.sparkContext.broadcast(bloom_blocks(wanted.select(F.coalesce("id", F.lit(-1)).alias("id")), "id"))
        read = texts.select("t", F.xxhash64(F.coalesce("id", F.lit(-1))).alias("h")).mapInArrow(giving_back(_set_reader("t", size, blocks)), "cls binary, shingles binary")
        return read.join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])

    def links(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select("a").union(pairs.select("b")).distinct().join(n_class, F.col("a") == F.col("cls")).select("cls", "id").checkpoint()
        sets = sets_of(wanted)
        return (
            pairs.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b")
            .join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a")
            .mapInArrow(giving_back(_verifier(percent)), "a binary, b binary")
            .checkpoint()
        )

    linked = links(pairs)
    roots = components(linked)

    # step 5: buckets that still hold several components
    placed = members.join(roots, F.col("cls") == F.col("node"), "left").select("k", "cls", F.coalesce("root", "cls").alias("comp"))
    still = placed.groupBy("k").agg(F.count("*").alias("members"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi")
    still = still.select("k", F.ceil(F.col("members") / BLOCK).cast("int").alias("n_blocks"))
    opened = placed.join(still, "k").checkpoint()
    # places of members: by the least partner that they share, cut by a hash where there are many
    label = members.join(least, "k").groupBy("cls").agg(F.min("least.cls").alias("label"))
    joined = opened.select("cls", "comp").distinct().join(classes, "cls").join(label, "cls")
    room = joined.groupBy("label").agg(F.ceil(F.sum("n") / PLACE).alias("rooms"))
    member = joined.join(room, "label").select("cls", "comp", "id", "n", "bands", "low", F.xxhash64("label", F.pmod(F.xxhash64("cls"), F.col("rooms"))).alias("place")).checkpoint()
    meeting = opened.select("k", "cls", "n_blocks", F.pmod(F.xxhash64("cls"), F.col("n_blocks")).cast("int").alias("blk")).join(member, "cls")
    meeting = meeting.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    meeting = meeting.withColumns({"i": F.least("blk", "other"), "j": F.greatest("blk", "other")}).select("k", "i", "j", "blk", "cls", "n", "bands", "low", "comp", "place")
    lists = meeting.groupBy("k", "i", "j").applyInArrow(_estimator(percent, ROWS), "ga long, gb long, pairs binary").checkpoint()
    if not lists.isEmpty():
        met = lists.select("ga", "gb").distinct()
        # new names, as both sides of the cogroup come from these lists
        met = met.select(F.col("ga").alias("pa"), F.col("gb").alias("pb"), F.explode(F.array_distinct(F.array("ga", "gb"))).alias("place"))
        sent = met.join(member.select("cls", "comp", "place").join(sets_of(member.select("cls", "id")), "cls"), "place").select("pa", "pb", "cls", "comp", "shingles")
        more = lists.groupBy("ga", "gb").cogroup(sent.groupBy("pa", "pb")).applyInArrow(_list_verifier(percent), "a binary, b binary")
        linked = linked.union(more).checkpoint()
        roots = components(linked)

    group = classes.select("cls", "id").join(roots, F.col("cls") == F.col("node"), "left").select("cls", F.coalesce("root", "cls").alias("comp"), "id")
    lowest = group.groupBy("comp").agg(F.min("id").alias("component_id"))
    component = group.join(lowest, "comp").select("cls", "component_id")
    found = signed.where("n > 0").select("cls", "id", "n").join(component, "cls")
    alone = signed.where("n = 0").select("cls", "id", "n", F.col("id").alias("component_id"))
    found = found.select(*alone.columns).union(alone)
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "cls", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that have the smallest id of their component, with the columns of docs.

    Ids are taken to be unique; rows that share an id stay or go together. Rows with a null id stay.
    """
    gone = near_duplicates(docs, id_col, **options).where(f"{id_col} != component_id").select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
