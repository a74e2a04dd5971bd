"""Media columns: chroma fingerprints of audio, and alignment of recordings.

A recording (WAV bytes) becomes frames of 12 pitch classes. Filters over rectangles of the frames, summed in constant
time from an integral image, are quantised to two bits each; the bits of all filters at one frame are a packed 32-bit
integer. Recordings that hold the same sound have equal integers at a fixed offset, so the histogram of the offsets
between equal integers finds the alignment, and the share of differing bits over the overlap accepts or refuses it.

Recordings with one fingerprint form a class. Queries are classes that hold an id divisible by ``every``; they are
matched against all classes, a block of queries and a slice of classes to a task, without a row for each pair: only
accepted alignments are written.

Defined results: null, empty, too short or unreadable audio has an empty fingerprint; it is in a class of its own, with
no match. Rows with repeated ids are rows of their own, in one class if they sound alike; a null id is never a query.
An empty table is fine. Channels are averaged; 16-bit PCM is read.
"""

from __future__ import annotations

import io
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare
from .textnum import ragged

FRAME, HOP = 1024, 256
LOW, HIGH = 55.0, 1760.0
N_FILTERS = 16
#: queries in a block, and classes in a slice, about
BLOCK, SLICE = 2_000, 20_000
#: equal integers at the best offset, and share of differing bits
LEAST_EQUAL, MOST_ERRORS = 4, 0.2
LEAST_OVERLAP = 16


def read_wav(data: bytes | None) -> tuple[np.ndarray, int]:
    """Samples and rate; nothing for what is not 16-bit PCM."""
    try:
        with wave.open(io.BytesIO(data or b"")) as w:
            if w.getsampwidth() != 2:
                return np.empty(0, np.float32), 1
            x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float32)
            n = w.getnchannels()
            return x[: len(x) // n * n].reshape(-1, n).mean(axis=1) / 32768, w.getframerate()
    except (wave.Error, EOFError):
        return np.empty(0, np.float32), 1


def write_wav(samples: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


_WINDOW = np.hanning(FRAME).astype(np.float32)


def chroma(samples: np.ndarray, rate: int) -> np.ndarray:
    """Frames by 12 pitch classes, each frame of length 1 or silent."""
    n = (len(samples) - FRAME) // HOP + 1
    if n < 1:
        return np.zeros((0, 12), np.float32)
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[:: HOP][:n] * _WINDOW
    power = np.abs(np.fft.rfft(frames, axis=1)) ** 2
    pitch = np.fft.rfftfreq(FRAME, 1 / rate)
    used = np.flatnonzero((pitch >= LOW) & (pitch <= HIGH))
    classes = np.zeros((len(used), 12), np.float32)
    classes[np.arange(len(used)), np.round(12 * np.log2(pitch[used] / 440)).astype(int) % 12] = 1
    out = power[:, used] @ classes
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.where(norm > 1e-6, out / np.maximum(norm, 1e-6), 0).astype(np.float32)


def _filters() -> list[tuple[int, int, int, int]]:
    """(kind, first class, classes, frames) by a rule: kinds take turns, sizes and places spread over the classes."""
    out = []
    for i in range(N_FILTERS):
        height = 2 + 2 * (i * 5 % 6)
        out.append((i % 5, i * 7 % (13 - height), height, 4 + 2 * (i * 3 % 5)))
    return out


FILTERS = _filters()
REACH = max(f[3] for f in FILTERS)


def fingerprint(samples: np.ndarray, rate: int) -> np.ndarray:
    """Packed integers, one for each frame from which all filters fit."""
    frames = chroma(samples, rate)
    n = len(frames) - REACH + 1
    if n < 1:
        return np.empty(0, np.uint32)
    image = np.zeros((len(frames) + 1, 13))
    image[1:, 1:] = frames.cumsum(axis=0).cumsum(axis=1)
    at = np.arange(n)

    def area(t0: int, t1: int, c0: int, c1: int) -> np.ndarray:
        return image[at + t1, c1] - image[at + t0, c1] - image[at + t1, c0] + image[at + t0, c0]

    out = np.zeros(n, np.uint32)
    for kind, c, h, w in FILTERS:
        whole = area(0, w, c, c + h)
        if kind == 0:  # this part of the classes against the mean of all
            part, rest = whole, area(0, w, 0, 12) * h / 12
        elif kind == 1:  # low against high classes
            part = area(0, w, c, c + h // 2)
            rest = whole - part
        elif kind == 2:  # before against after
            part = area(0, w // 2, c, c + h)
            rest = whole - part
        elif kind == 3:  # crosswise
            part = area(0, w // 2, c, c + h // 2) + area(w // 2, w, c + h // 2, c + h)
            rest = whole - part
        else:  # middle against ends, in time
            part = area(w // 4, w - w // 4, c, c + h)
            rest = whole - part
        value = np.log((1 + part) / (1 + rest))
        level = (value > -0.15).astype(np.uint32) + (value > 0) + (value > 0.15)
        out = (out << np.uint32(2)) | (level ^ (level >> np.uint32(1)))  # neighbours differ in one bit
    return out


def runs(print_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(integer, place, length) of each stretch of one integer: a held note or silence is one."""
    start = np.flatnonzero(np.diff(print_.astype(np.int64), prepend=-1))
    return print_[start], start, np.diff(np.append(start, len(print_)))


def offsets(place: np.ndarray, length: np.ndarray, query_place: np.ndarray, query_length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the pair, offset, how many equal integers are that far apart) of pairs of stretches of one integer.

    Two stretches meet at as many offsets as they are long together, less one, and the counts rise, stay, and fall: no pair of
    places is written, so that two silent recordings cost no more than their length.
    """
    n = length + query_length - 1
    pair = np.repeat(np.arange(len(n)), n)
    step = ragged(np.zeros(len(n), np.int64), n)
    count = np.minimum(np.minimum(step + 1, n[pair] - step), np.minimum(length, query_length)[pair])
    return pair, (place - query_place - query_length + 1)[pair] + step, count


def align(query: np.ndarray, other: np.ndarray) -> tuple[int, int, int, int] | None:
    """(offset, equal integers, differing bits, bits) at the commonest offset of equal integers, if there is any."""
    (value, at, size), (wanted, place, length) = runs(query), runs(other)
    order = np.argsort(value, kind="stable")
    lo, hi = np.searchsorted(value[order], wanted, "left"), np.searchsorted(value[order], wanted, "right")
    n = hi - lo
    if not n.sum():
        return None
    mine, its = order[ragged(lo, n)], np.repeat(np.arange(len(wanted)), n)
    _, offset, equal = offsets(place[its], length[its], at[mine], size[mine])
    count = np.bincount(offset + len(query), equal).astype(np.int64)
    best = int(count.argmax()) - len(query)
    return (best, int(count.max()), *_errors(query, other, best))


def _errors(query: np.ndarray, other: np.ndarray, offset: int) -> tuple[int, int]:
    a, b = max(0, -offset), min(len(query), len(other) - offset)
    return int(np.bitwise_count(query[a:b] ^ other[a + offset : b + offset]).sum()), 32 * (b - a)


def accepted(found) -> bool:
    return found is not None and found[1] >= LEAST_EQUAL and found[3] >= 32 * LEAST_OVERLAP and found[2] <= MOST_ERRORS * found[3]


def _printer(batches):
    for batch in batches:
        prints = [fingerprint(*read_wav(x)) for x in batch.column("audio").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([p.astype("<u4").tobytes() for p in prints], pa.binary())], names=["id", "print"])


def fingerprints(recordings: DataFrame, id_col: str, audio_col: str) -> DataFrame:
    """(id, print): packed integers as little-endian bytes."""
    prepare(recordings.sparkSession)
    return recordings.select(F.col(id_col).cast("long").alias("id"), F.col(audio_col).cast("binary").alias("audio")).mapInArrow(_printer, "id long, print binary")


def _match(key, queries: pa.Table, others: pa.Table) -> pa.Table:
    """Accepted alignments of a block of queries with a slice of classes.

    All integers of the block are looked up at once, so that a class is aligned only with queries that share one.
    """
    out: list[tuple] = []
    if queries.num_rows and others.num_rows:
        q_class, q_prints = queries.column("class_id").to_pylist(), [np.frombuffer(x, "<u4") for x in queries.column("print").to_pylist()]
        parts = [runs(p) for p in q_prints]
        value, place, size = (np.concatenate(x) for x in zip(*parts, strict=True))
        owner = np.repeat(np.arange(len(q_prints)), [len(x[0]) for x in parts])
        order = np.argsort(value, kind="stable")
        value, owner, place, size = value[order], owner[order], place[order], size[order]
        for class_id, data in zip(others.column("class_id").to_pylist(), others.column("print").to_pylist(), strict=True):
            p = np.frombuffer(data, "<u4")
            wanted, at, length = runs(p)
            lo, hi = np.searchsorted(value, wanted, "left"), np.searchsorted(value, wanted, "right")
            n = hi - lo
            if not n.sum():
                continue
            mine, its = ragged(lo, n), np.repeat(np.arange(len(wanted)), n)
            pair, offset, equal = offsets(at[its], length[its], place[mine], size[mine])
            # offset histograms of all queries in one count
            key_, where = np.unique(owner[mine][pair] * (1 << 24) + offset + (1 << 23), return_inverse=True)
            count = np.bincount(where, equal).astype(np.int64)
            best = np.lexsort((key_, -count, key_ >> 24))
            head = np.ones(len(best), bool)
            head[1:] = (key_[best] >> 24)[1:] != (key_[best] >> 24)[:-1]
            for k in best[head].tolist():
                q, offset = int(key_[k] >> 24), int(key_[k] & ((1 << 24) - 1)) - (1 << 23)
                found = (offset, int(count[k]), *_errors(q_prints[q], p, offset))
                if q_class[q] != class_id and accepted(found):
                    out.append((q_class[q], class_id, *found))
    columns = list(zip(*out, strict=True)) or [()] * 6
    names = ["query_class", "class_id", "offset", "equal", "errors", "bits"]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})


def match_recordings(prints: DataFrame, every: int = 50) -> tuple[DataFrame, DataFrame]:
    """(membership, pairs) for fingerprints (id, print).

    membership: id, class_id (smallest id with that fingerprint), n_integers. pairs: query_class, class_id, offset (of
    the query in the other), equal, errors, bits; one row for each accepted pair of different classes.
    """
    prints = prints.checkpoint()
    sound = prints.where("length(print) > 0 and id is not null")
    classes = sound.groupBy("print").agg(F.min("id").alias("class_id"), F.max(F.when(F.pmod("id", F.lit(every)) == 0, 1).otherwise(0)).alias("asked")).checkpoint()
    n, n_asked = classes.agg(F.count("*"), F.coalesce(F.sum("asked"), F.lit(0))).first()
    n_blocks, n_slices = 1 + n_asked // BLOCK, 1 + n // SLICE
    block = F.pmod(F.xxhash64("class_id"), F.lit(n_blocks)).cast("int")
    slice_ = F.pmod(F.xxhash64("class_id", F.lit(1)), F.lit(n_slices)).cast("int")
    asked = classes.where("asked = 1").select("class_id", "print", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))).alias("slice"))
    # new names for the same columns, as both sides of the cogroup come from one table
    others = classes.select(F.col("class_id").alias("class_id"), F.col("print").alias("print"), slice_.alias("slice"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    pairs = asked.groupBy("block", "slice").cogroup(others.groupBy("block", "slice")).applyInArrow(_match, "query_class long, class_id long, offset long, equal long, errors long, bits long")
    n_integers = (F.length("print") / 4).cast("long")
    membership = sound.join(classes.select("print", "class_id"), "print").select("id", "class_id", n_integers.alias("n_integers"))
    silent = prints.where("print is null or length(print) = 0 or id is null").select("id", F.col("id").alias("class_id"), F.coalesce(n_integers, F.lit(0)).alias("n_integers"))
    return membership.union(silent), pairs


#: Recordings that the query makes of vectors: notes of two numbers, pitch and loudness.
RATE, NOTE = 4000, 512


def melody(vector) -> bytes:
    """A WAV recording of a vector: two numbers a note, pitch from 110 Hz over three octaves, and loudness."""
    v = np.asarray(vector if vector is not None else [], np.float64)
    v = np.where(np.isfinite(v), v, 0)
    if len(v) < 2:
        return b""
    v = v[: len(v) // 2 * 2].reshape(-1, 2)
    pitch = 110 * 2 ** (3 * (0.5 + np.arctan(4 * v[:, 0]) / np.pi))
    loud = 0.2 + 0.6 * (0.5 + np.arctan(4 * v[:, 1]) / np.pi)
    phase = np.cumsum(np.repeat(pitch, NOTE)) * (2 * np.pi / RATE)
    return write_wav(np.repeat(loud, NOTE) * np.sin(phase), RATE)


def as_recordings(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, audio): each vector as a recording."""
    prepare(vectors.sparkSession)

    def run(batches):
        for batch in batches:
            audio = [melody(v) for v in batch.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(audio, pa.binary())], names=["id", "audio"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).mapInArrow(run, "id long, audio binary")
