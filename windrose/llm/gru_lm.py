"""Language-model scores: a gated recurrent network over words, with a class-factored softmax.

Topics. One pass over the training documents adds up how the hashed words of a document occur together: FEATURES sums
and their products. The strongest directions of that covariance, taken on the driver, cut documents into TOPICS groups;
a language, for example, comes out as one.

Counts. Every token of every training document is counted, in passes over buckets (blocks.py): a bucket sends the shards
of the token space its distinct token hashes with counts, and the topic in which it finds each most; a shard adds them
up, and answers with the sums and the commonest topic of each token. That gives the base model, and the vocabulary: the
WORDS commonest tokens, dealt by count to CLASSES classes. All other tokens have a class by topic and by the power of four
of their count, so the number of classes grows with the counts, and each token of the corpus has one.

Model. A gated recurrent unit reads one token at a time, a token beyond the vocabulary as its class. P(token) =
P(class | state) P(token | class, state); in the classes beyond the vocabulary the latter is (c + 1) / (sum of c + 1),
with the training counts c. The classes of the rarest tokens each keep one more place, for tokens that were never seen. So probabilities of all tokens sum to at most 1.

Training. Truncated backpropagation through WINDOW steps, in numpy, with the state carried from window to window;
documents of more than STRETCH tokens are learnt in stretches, so that all lanes have work. Training reads the whole text
of every training document once: a hash of id and text deals documents to ROUNDS rounds. In each round every bucket goes
on from the common weights over its part of the round's documents; weights are then averaged, by number of tokens, by
sums of FAN rows at a time on Spark, until FAN are left for the driver.

Scores. The state is carried across windows, so that a document's log-likelihood is that of the complete document.

Defined results: a null text is an empty one: its only token is the end. Rows with repeated or null ids are scored each
on its own. Without training tokens the base score is that of an empty table of counts, and the model is untrained. An
empty table is fine. Columns of the documents whose names clash with the results are replaced. Tokens are told apart by
64 bits of hash.
"""

from __future__ import annotations

from heapq import heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import MESSAGE, Buckets, each_shard, messages, pack, pack_sorted, unpack, unpack_sorted
from .common import fold, prepare
from .textnum import U, chunks, encode, ragged, space_words

CLASSES, PER_CLASS = 32, 32
WORDS = CLASSES * PER_CLASS
HIDDEN = 16
WINDOW = 16
LANES = 384
#: few tokens are learnt in fewer lanes, so that there are about as many steps
STEPS = 64
#: tokens of a document that are learnt with one state
STRETCH = 2_048
#: tokens that are side by side in one go, and whose outputs are computed together
TOKENS, OUTPUTS = 2_000_000, 8_192
#: rows whose classes are computed together
ROWS = 1_024
#: groups of documents, hashed words that tell them apart, and directions
TOPICS, FEATURES, DIRECTIONS = 8, 512, 7
#: powers of four of counts
BINS = 32
ROUNDS = 2
#: rows of weights that are summed in one task
FAN = 32
RATE, CLIP = 0.01, 1.0
#: bytes of text for each shard of tokens
SHARD_BYTES = 16 << 20
#: hash that stands for the end of a text
END = U(0x5851F42D4C957F2D)

RESULT = [T.StructField(n, t()) for n, t in (("held_out", T.BooleanType), ("n_tokens", T.LongType), ("n_known", T.LongType), ("train_tokens", T.LongType), ("base_score", T.DoubleType), ("score", T.DoubleType))]
#: column with the round in which a row is learnt
ROUND = "__round"


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and then the end, and where each text's begin."""
    w = space_words(texts, lower=True)
    count = w.count + 1
    at = np.concatenate([[0], np.cumsum(count)])
    out = np.full(at[-1], END, U)
    out[np.arange(len(w.text)) + w.text] = w.hashes()
    return out, at


def _all_tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts, ats = [np.empty(0, U)], [np.zeros(1, np.int64)]
    for a, b in chunks([len(t) + 1 for t in texts]):
        h, at = tokens(texts[a:b])
        parts.append(h)
        ats.append(at[1:] + ats[-1][-1])
    return np.concatenate(parts), np.concatenate(ats)


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and the place of each value among them. Only distinct ones are sorted."""
    found = pa.array(h).dictionary_encode()
    values = found.dictionary.to_numpy(zero_copy_only=False)
    order = np.argsort(values)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return values[order], place.take(found.indices.to_numpy(zero_copy_only=False))


def _by_shard(h: np.ndarray, n: int):
    """Distinct hashes, ascending, so shards (ranges of the hash) are runs; where runs begin; place of each token."""
    distinct, where = _distinct(h)
    shard = ((distinct >> U(32)) * U(n) >> U(32)).astype(np.int64)
    return distinct, np.searchsorted(shard, np.arange(n + 1)), where


def _histogram(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each text, square roots of the shares of its hashed tokens."""
    n = np.diff(at)
    x = np.bincount(np.repeat(np.arange(len(n)), n) * FEATURES + (h % U(FEATURES)).astype(np.int64), minlength=len(n) * FEATURES)
    return np.sqrt(x.reshape(len(n), FEATURES) / n[:, None]).astype(np.float32)


def _moments(text_col: str):
    """One row for each part: documents, sums and sums of products of their histograms."""

    def run(batches):
        from pyspark import TaskContext

        n, total = 0, np.zeros((FEATURES + 1, FEATURES))
        for batch in batches:
            texts = encode(batch.column(text_col).to_pylist())
            for a, b in chunks([len(t) + 1 for t in texts]):
                x = _histogram(*tokens(texts[a:b]))
                n += len(x)
                total[0] += x.sum(axis=0)
                total[1:] += x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["i", "n", "total"])

    return run


def _sum_rows(key, table):
    total = sum(np.frombuffer(x.as_buffer(), np.float64) for x in table.column("total"))
    return pa.table({"i": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()), "total": pa.array([total.tobytes()], pa.binary())})


def tree_sum(rows: DataFrame) -> tuple[int, np.ndarray] | None:
    """Sums of n and total over rows (i, n, total: doubles), i from 0 on; no task and not the driver holds over FAN rows."""
    rows = rows.checkpoint()
    last = rows.agg(F.max("i")).first()[0]
    while last is not None and last >= FAN:
        rows = rows.groupBy(F.floor(F.col("i") / FAN).alias("of")).applyInArrow(_sum_rows, "i long, n long, total binary").checkpoint()
        last //= FAN
    found = rows.toArrow()
    if not found.num_rows:
        return None
    return sum(found["n"].to_pylist()), sum(np.frombuffer(x.as_buffer(), np.float64) for x in found["total"])


class Topics:
    """Groups of documents by the strongest directions of the covariance of their hashed words."""

    def __init__(self, n: int, total: np.ndarray):
        total = total.reshape(FEATURES + 1, FEATURES) / max(1, n)
        mean, cov = total[0], total[1:] - np.outer(total[0], total[0])
        spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        values, vectors = np.linalg.eigh(cov)
        values, vectors = np.maximum(values[-DIRECTIONS:], 0), vectors[:, -DIRECTIONS:]
        load = vectors * np.sqrt(values) / spread[:, None]
        strong = np.linalg.norm(load, axis=1)
        unit = load / np.maximum(strong, 1e-9)[:, None]
        seeds = [int(strong.argmax())]  # each next seed is the strongest word far from the others
        while len(seeds) < TOPICS:
            seeds.append(int((np.min([1 - unit @ unit[k] for k in seeds], axis=0) * strong).argmax()))
        centre = unit[seeds]
        for _ in range(30):
            of = (unit @ centre.T).argmax(axis=1)
            centre = np.array([load[of == k].sum(axis=0) if (of == k).any() else centre[k] for k in range(TOPICS)])
            centre /= np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-9)
        self.by = (load @ centre.T / spread[:, None]).astype(np.float32)
        self.level = (mean @ self.by).astype(np.float32)

    def of(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at) - 1, np.int64)
        for a, b in chunks(np.diff(at).tolist()):
            out[a:b] = (_histogram(h[at[a] : at[b]], at[a : b + 1] - at[a]) @ self.by - self.level).argmax(axis=1)
        return out


def _votes(where: np.ndarray, topic: np.ndarray, count: np.ndarray | int, n: int) -> np.ndarray:
    """The topic with the most votes for each of n tokens; the first of equal ones."""
    return np.bincount(where * TOPICS + topic, None if isinstance(count, int) else count, minlength=n * TOPICS).reshape(n, TOPICS).argmax(axis=1).astype(np.uint8)


def _send_counts(text_col: str, n_shards: int, topics):
    def run(bucket, table):
        h, text_at = _all_tokens(encode(table.column(text_col).to_pylist()))
        distinct, at, where = _by_shard(h, n_shards)
        size = np.diff(text_at)
        learn = np.repeat(table.column(ROUND).to_numpy(zero_copy_only=False) >= 0, size)
        count = np.bincount(where[learn], minlength=len(distinct))
        topic = _votes(where[learn], np.repeat(topics.value.of(h, text_at), size)[learn], 1, len(distinct))
        out = []
        for s in np.flatnonzero(np.diff(at)).tolist():
            x = slice(at[s], at[s + 1])
            c = count[x]
            out.append((0, bucket, s, pack(h=np.frombuffer(pack_sorted(distinct[x]), np.uint8), count=c.astype(np.min_scalar_type(int(c.max()))), topic=topic[x])))
        return messages(out)

    return run


def bin_of(count: np.ndarray) -> np.ndarray:
    return (np.frexp(np.maximum(count, 1).astype(float))[1] - 1) >> 1


def _add_counts(shard, sent):
    """Answers with sum and topic of each token; kind 1: the shard's totals and commonest tokens, to nobody's bucket."""
    parts = []
    for _, bucket, data in sent:
        x = unpack(data)
        parts.append((bucket, unpack_sorted(x["h"].tobytes()), x["count"].astype(np.int64), x["topic"].astype(np.int64)))
    distinct, where = _distinct(np.concatenate([p[1] for p in parts]))
    counts = np.concatenate([p[2] for p in parts])
    total = np.bincount(where, counts, len(distinct)).astype(np.int64)
    topic = _votes(where, np.concatenate([p[3] for p in parts]), counts, len(distinct))
    out, at = [], 0
    for bucket, h, _, _ in parts:
        mine = where[at : at + len(h)]
        c = total[mine]
        at += len(h)
        out.append((0, bucket, shard, pack(count=c.astype(np.min_scalar_type(int(c.max()))), topic=topic[mine])))
    # the commonest tokens of all are among the commonest of their shards
    top = np.lexsort((distinct, -total))[:WORDS]
    top = top[total[top] > 0]
    seen = total > 0
    mass = np.bincount(topic[seen].astype(np.int64) * BINS + bin_of(total[seen]), total[seen] + 1, TOPICS * BINS).astype(np.int64)
    out.append((1, -1, shard, pack(n=np.array([total.sum(), seen.sum()]), mass=mass, h=distinct[top], count=total[top], topic=topic[top])))
    return messages(out)


class Vocabulary:
    """The commonest tokens, in order of their hashes, and the classes of all others.

    Numbers of tokens: words from 0, then classes of the rest, a token that was never seen, and a text's start.
    """

    def __init__(self, h: np.ndarray, count: np.ndarray, topic: np.ndarray, n: int, v: int, mass: np.ndarray):
        self.n, self.v = n, v
        order = np.argsort(h)
        self.h = h[order]
        rank = np.empty(len(h), np.int64)
        rank[np.lexsort((h, -count))] = np.arange(len(h))
        self.word = rank[order]  # 0 is the commonest; classes hold neighbours in count
        mass = mass - np.bincount(topic.astype(np.int64) * BINS + bin_of(count), count + 1, TOPICS * BINS).astype(np.int64)
        used = np.flatnonzero((mass > 0) | (np.arange(TOPICS * BINS) == 0))
        self.rest = len(used)
        self.place = np.full(TOPICS * BINS, self.rest)
        self.place[used] = np.arange(self.rest)
        once = used % BINS == 0
        self.mass = mass[used] + once  # a place for what was never seen
        #: natural log of the share that a token that was never seen has in each class
        self.unseen = np.where(once, -np.log(self.mass), -np.inf)

    def number(self, tokens: np.ndarray, count: np.ndarray, topic: np.ndarray) -> np.ndarray:
        out = WORDS + np.where(count > 0, self.place[topic.astype(np.int64) * BINS + bin_of(count)], self.rest)
        if len(self.h):
            at = np.minimum(np.searchsorted(self.h, tokens), len(self.h) - 1)
            out = np.where(self.h[at] == tokens, self.word[at], out)
        return out


def initial(n_rest: int = 1, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    g = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    return {
        "embed": (rng.standard_normal((WORDS + n_rest + 2, HIDDEN)) * 0.3).astype(np.float32),
        "wx": g(HIDDEN, 3 * HIDDEN), "wh": g(HIDDEN, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, np.float32),
        "wc": g(HIDDEN, CLASSES + n_rest), "bc": np.zeros(CLASSES + n_rest, np.float32),
        "ww": g(HIDDEN, WORDS) * np.float32(0.3), "bw": np.zeros(WORDS, np.float32),
    }


def _softmax(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of a, what its softmax is in proportion to, the sum of that, and what is to be taken off a for the log of the softmax."""
    one = np.ones(a.shape[1], np.float32)
    with np.errstate(over="ignore"):
        p = np.exp(a)
    total = p @ one
    if np.isfinite(total).all() and total.all():
        return p, total, np.log(total)
    top = a.max(axis=1)
    p = np.exp(a - top[:, None])
    total = p @ one
    return p, total, np.log(total) + top


def _chosen(a: np.ndarray, column: np.ndarray) -> np.ndarray:
    """One element of each row."""
    return a.ravel().take(np.arange(0, a.size, a.shape[1]) + column)


def _runs(x: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    return np.concatenate([np.zeros(min(1, len(x)), np.int64), np.flatnonzero(x[1:] != x[:-1]) + 1])


def outputs(m: dict, h: np.ndarray, y: np.ndarray, learn: bool = False, unseen: np.ndarray | None = None):
    """Natural log of the probability of each word y, or from WORDS on of its class, and what training needs.

    unseen: shares of a token that was never seen in the classes beyond the words, for the number after them.
    """
    n, n_rest = len(y), m["wc"].shape[1] - CLASSES
    new = y == WORDS + n_rest
    y = np.where(new, WORDS, y)
    order = np.argsort(y.astype(np.uint16), kind="stable")  # words, and so classes, are runs
    y = y.take(order)
    back_at = np.empty(n, np.int64)  # of each token, its place in that order
    back_at[order] = np.arange(n)
    h1 = np.ones((n, HIDDEN + 1), np.float32)  # the last column takes the bias
    h1[:, :HIDDEN] = h.take(order, axis=0)
    cls = np.where(y < WORDS, y // PER_CLASS, y - WORDS + CLASSES)
    to_classes = np.vstack([m["wc"], m["bc"]])
    new = new.take(order)
    lp = np.empty(n, np.float32)
    grad, back = {}, np.empty((n if learn else 0, HIDDEN), np.float32) if learn else None
    to_class, from_class = np.zeros_like(to_classes.T), np.ascontiguousarray(m["wc"].T)
    for i in range(0, n, ROWS):  # what is computed for so many tokens stays near
        rows = slice(i, i + ROWS)
        some = h1[rows]
        a = some @ to_classes
        p, total, off = _softmax(a)
        lp[rows] = _chosen(a, cls[rows]) - off
        unknown = np.flatnonzero(new[rows])
        if len(unknown):
            lp[i + unknown] = np.logaddexp.reduce(a[unknown, CLASSES:] - off[unknown, None] + unseen, axis=1)
        if learn:
            share = 1 / total[:, None]
            to_class += p.T @ (some * share)
            part = np.matmul(p, from_class, out=back[rows])
            part *= share
            part -= from_class.take(cls[rows], axis=0)
    if learn and n:
        first = _runs(y)
        sums = np.add.reduceat(h1, first)  # of states by word
        words, of = y[first], cls[first]
        run = _runs(of)
        to_class[of[run]] -= np.add.reduceat(sums, run)
        grad = {"wc": to_class.T[:-1], "bc": to_class.T[-1]}
    k = int(np.searchsorted(y, WORDS))
    at = np.searchsorted(y[:k], np.arange(CLASSES + 1) * PER_CLASS).tolist()
    runs = [(c, slice(at[c], at[c + 1])) for c in range(CLASSES) if at[c] < at[c + 1]]
    by_class = np.ascontiguousarray(np.vstack([m["ww"], m["bw"]]).reshape(HIDDEN + 1, CLASSES, PER_CLASS).transpose(1, 0, 2))
    a = np.empty((k, PER_CLASS), np.float32)
    for c, some in runs:  # tokens of one class share its part of the output weights
        np.matmul(h1[some], by_class[c], out=a[some])
    p, total, off = _softmax(a)
    lp[:k] += _chosen(a, y[:k] % PER_CLASS) - off
    if learn and n:
        share = 1 / total[:, None]
        scaled, to_word, part = h1[:k] * share, np.zeros_like(by_class), np.empty((k, HIDDEN), np.float32)
        for c, some in runs:
            np.matmul(scaled[some].T, p[some], out=to_word[c])
            np.matmul(p[some], by_class[c, :HIDDEN].T, out=part[some])
        to_word = to_word.transpose(1, 0, 2).reshape(HIDDEN + 1, WORDS)
        words = words[words < WORDS]
        to_word[:, words] -= sums[: len(words)].T
        part *= share
        part -= np.ascontiguousarray(m["ww"].T).take(y[:k], axis=0)
        back[:k] += part
        grad |= {"ww": to_word[:-1], "bw": to_word[-1]}
        back = back.take(back_at, axis=0)
    return lp.take(back_at), grad, back


class Lanes:
    """Texts side by side: each lane takes the next text when its own is done, and starts again from an empty state.

    Lanes stand in falling order of their length, so those that are still at work are the first.
    """

    def __init__(self, word: np.ndarray, at: np.ndarray, lanes: int, start: int):
        self.start = start  # the number that is read before a text's first token
        size = np.diff(at)
        n = max(1, min(lanes, len(size)))
        # the longest go first, each to the lane that has least so far; lanes differ little
        queue = [[] for _ in range(n)]
        least = [(0, k) for k in range(n)]
        for i in np.argsort(-size, kind="stable").tolist():
            has, k = least[0]
            queue[k].append(i)
            heapreplace(least, (has + int(size[i]), k))
        load = np.array([has for has, _ in sorted(least, key=lambda x: x[1])], np.int64)
        order = np.argsort(-load, kind="stable")
        queue, self.load = [queue[k] for k in order.tolist()], load[order]
        steps = int(load.max())
        self.token = np.full((steps, n), -1, np.int64)
        self.first = np.zeros((steps, n), bool)
        for k, texts in enumerate(queue):
            row = 0
            for i in texts:
                self.token[row : row + size[i], k] = np.arange(at[i], at[i + 1])
                self.first[row, k] = True
                row += size[i]
        self.real = self.token >= 0
        self.y = np.where(self.real, word[np.maximum(self.token, 0)], 0) if len(word) else np.zeros((steps, n), np.int64)

    def windows(self):
        """Rows from, to."""
        for a in range(0, len(self.token), WINDOW):
            yield a, min(a + WINDOW, len(self.token))

    def at_work(self, a: int) -> int:
        """Lanes that have a token in row a or later."""
        return int(np.searchsorted(-self.load, -a, side="left"))


def _read(lanes: Lanes, a: int, b: int, k: int) -> np.ndarray:
    """Words that are read before each step's prediction is made: the token before; start at a text's first token."""
    start = lanes.start
    before = np.full((b - a, k), start, np.int64)
    if a:
        before[0] = lanes.y[a - 1, :k]
    before[1:] = lanes.y[a : b - 1, :k]
    before[lanes.first[a:b, :k]] = start
    return before


def _step_states(m: dict, table: np.ndarray, lanes: Lanes, state: np.ndarray, a: int, b: int, keep: bool = False):
    """States from which the tokens of rows a to b are predicted: read the token before, from nothing at a first token.

    table: the inputs' part of the gates for each word, from _table. state: of the lanes that are at work. Also returned:
    what was read, and for each step the two gates and the candidate, and (if kept) the state's part of the candidate.
    """
    k = len(state)
    x = _read(lanes, a, b, k)
    first = lanes.first[a:b, :k]
    new = first.any(axis=1).tolist()
    states, rc = np.empty((b - a + 1, k, HIDDEN), np.float32), np.empty((b - a if keep else 0, k, HIDDEN), np.float32)
    states[0] = state
    gates = table.take(x.ravel(), axis=1).reshape(3, b - a, k, HIDDEN)  # the inputs' part; the rest is added in place
    zqs, c = gates[:2], gates[2]
    wh, one, half, r = _signed(_thirds(m["wh"])), np.float32(1), np.float32(-0.5), np.empty((3, k, HIDDEN), np.float32)
    own = r[2]
    with np.errstate(over="ignore"):
        for t in range(b - a):
            h, zq, ct, after = states[t], zqs[:, t], c[t], states[t + 1]
            if new[t]:
                h[first[t]] = 0
            np.matmul(h, wh, out=r)
            zq += r[:2]
            np.exp(zq, out=zq)
            zq += one
            np.reciprocal(zq, out=zq)
            if keep:
                np.multiply(own, half, out=rc[t])
            own *= zq[1]
            ct += own
            np.exp(ct, out=ct)
            ct += one
            np.reciprocal(ct, out=ct)
            ct += ct
            ct -= one
            np.subtract(h, ct, out=after)
            after *= zq[0]
            after += ct
    return x, states, (*gates, rc)


def _thirds(w: np.ndarray) -> np.ndarray:
    """Weights of the two gates and the candidate, each by itself: arrays of one are without gaps."""
    return np.ascontiguousarray(w.reshape(-1, 3, HIDDEN).swapaxes(0, 1))


def _signed(w: np.ndarray) -> np.ndarray:
    """The gates' part has its sign turned: gates are 1 / (1 + exp(-x)), and tanh(x) is 2 / (1 + exp(-2 x)) - 1."""
    np.negative(w, out=w)
    w[2] *= 2
    return w


def _table(m: dict) -> np.ndarray:
    return _signed(_thirds(m["embed"] @ m["wx"] + m["b"]))


def log_likelihoods(m: dict, word: np.ndarray, at: np.ndarray, unseen: np.ndarray | None = None) -> np.ndarray:
    """Natural log of the probability of each token, by classes and words."""
    lanes, table = Lanes(word, at, LANES, len(m["embed"]) - 1), _table(m)
    out = np.zeros(len(word))
    state = np.zeros((lanes.y.shape[1], HIDDEN), np.float32)
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def flush():
        if waiting:
            h, y, token = (np.concatenate([w[i] for w in waiting]) for i in range(3))
            out[token], _, _ = outputs(m, h, y, unseen=unseen)
            waiting.clear()

    for a, b in lanes.windows():
        k = lanes.at_work(a)
        _, states, _ = _step_states(m, table, lanes, state[:k], a, b)
        state = states[-1]
        real = lanes.real[a:b, :k].ravel()
        waiting.append((states[1:].reshape(-1, HIDDEN)[real], lanes.y[a:b, :k].ravel()[real], lanes.token[a:b, :k].ravel()[real]))
        if sum(len(w[1]) for w in waiting) >= OUTPUTS:
            flush()
    flush()
    return out


class Trainer:
    """Adam over truncated windows. Weights are parts of one flat array, in the order of _flat."""

    def __init__(self, m: dict):
        self.flat = _flat(m)
        self.m = _parts(self.flat, m)
        self.first, self.second = np.zeros_like(self.flat), np.zeros_like(self.flat)
        self.t = self.tokens = 0

    def learn(self, word: np.ndarray, at: np.ndarray) -> None:
        lanes = Lanes(word, at, min(LANES, max(8, len(word) // (STEPS * WINDOW))), len(self.m["embed"]) - 1)
        state = np.zeros((lanes.y.shape[1], HIDDEN), np.float32)
        for a, b in lanes.windows():
            grad, state, n = self.gradients(lanes, state[: lanes.at_work(a)], a, b)
            if n:
                self.update(grad, n)

    def gradients(self, lanes: Lanes, state: np.ndarray, a: int, b: int):
        m, n, k = self.m, HIDDEN, len(state)
        x, states, (z, q, c, rc) = _step_states(m, _table(m), lanes, state, a, b, True)
        real = lanes.real[a:b, :k].ravel()
        after = states[1:].reshape(-1, n)
        whole = real.all()
        _, grad, d_some = outputs(m, after if whole else after[real], lanes.y[a:b, :k].ravel()[real], learn=True)
        if whole:
            d_out = d_some
        else:
            d_out = np.zeros((real.size, n), np.float32)
            d_out[real] = d_some
        d_out = d_out.reshape(b - a, k, n)
        before = states[:-1]  # a first token's state is empty there
        first = lanes.first[a:b, :k]
        new = first.any(axis=1).tolist()
        to_c = (1 - z) * (1 - c * c)
        to_z = (before - c) * z * (1 - z)
        to_q = rc * q * (1 - q)
        # of the candidate, of both gates, and of the state's part of the candidate
        d = np.empty((4, b - a, k, n), np.float32)
        dh, part = np.zeros_like(state), np.empty((3, k, n), np.float32)
        back = np.ascontiguousarray(_thirds(m["wh"]).swapaxes(1, 2))
        for t in range(b - a - 1, -1, -1):
            dh += d_out[t]
            dc, dz, dq, inner = d[:, t]
            np.multiply(dh, to_z[t], out=dz)
            np.multiply(dh, to_c[t], out=dc)
            np.multiply(dc, to_q[t], out=dq)
            np.multiply(dc, q[t], out=inner)
            dh *= z[t]
            np.matmul(d[1:, t], back, out=part)
            for x_t in part:
                dh += x_t
            if new[t]:
                dh[first[t]] = 0
        d = d.reshape(4, -1, n)
        d_wh = np.matmul(before.reshape(-1, n).T, d[1:]).swapaxes(0, 1).reshape(n, 3 * n)
        x = x.ravel().astype(np.uint16)
        order = np.argsort(x, kind="stable")  # sums by word that was read
        x = x.take(order)
        at = _runs(x)
        words = x[at]
        sums = np.concatenate([np.add.reduceat(d[i].take(order, axis=0), at) for i in (1, 2, 0)], axis=1)
        d_embed = np.zeros_like(m["embed"])
        d_embed[words] = sums @ m["wx"].T
        grad |= {"wh": d_wh, "wx": m["embed"][words].T @ sums, "b": sums.sum(axis=0), "embed": d_embed}
        return grad, states[-1], int(real.sum())

    def update(self, grad: dict, n: int) -> None:
        self.t += 1
        self.tokens += n
        g = _flat(grad)
        size = np.sqrt(float(g @ g)) / n
        g *= np.float32(min(1.0, CLIP / max(size, 1e-9)) / n)
        self.first *= np.float32(0.9)
        self.first += np.float32(0.1) * g
        g *= g
        g *= np.float32(0.001)
        self.second *= np.float32(0.999)
        self.second += g
        step = np.sqrt(self.second, out=g)
        step += np.float32(1e-6)
        np.divide(self.first, step, out=step)
        step *= np.float32(RATE * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t))
        self.flat -= step


def _flat(m: dict) -> np.ndarray:
    return np.concatenate([m[k].ravel() for k in sorted(m)])


def _parts(flat: np.ndarray, like: dict) -> dict:
    """Parts of a flat array, without copies."""
    out, at = {}, 0
    for k, v in sorted(like.items()):
        out[k] = flat[at : at + v.size].reshape(v.shape)
        at += v.size
    return out


def _shaped(flat: np.ndarray, like: dict) -> dict:
    return _parts(flat.astype(np.float32), like)


def stretches(at: np.ndarray) -> np.ndarray:
    """Where texts begin, and stretches of long ones."""
    n = -(-np.diff(at) // STRETCH)
    return np.append(np.repeat(at[:-1], n) + ragged(np.zeros(len(n), np.int64), n) * STRETCH, at[-1])


def _number(text_col: str, n_shards: int, vocabulary):
    """A bucket's documents as numbers, with sums for each: what training and scoring read in place of texts."""

    def run(bucket, table, answers):
        v: Vocabulary = vocabulary.value
        h, at = _all_tokens(encode(table.column(text_col).to_pylist()))
        distinct, shard_at, where = _by_shard(h, n_shards)
        count, topic = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.uint8)
        for _, shard, data in answers:
            x = unpack(data)
            part = slice(shard_at[shard], shard_at[shard + 1])
            count[part], topic[part] = x["count"], x["topic"]
        number = v.number(distinct, count, topic)
        rest = (number >= WORDS) & (number < WORDS + v.rest)
        inside = np.zeros(len(distinct))  # log10 of the share in its class
        inside[rest] = np.log10((count[rest] + 1) / v.mass[number[rest] - WORDS])
        size = np.diff(at)
        of = np.repeat(np.arange(len(size)), size)
        sums = lambda x: np.bincount(of, x[where], len(size))
        base = sums(np.log10((count + 1) / (v.n + v.v + 1)))
        data = pack(number=number[where].astype(np.uint16), size=size, round=table.column(ROUND).to_numpy(zero_copy_only=False), known=sums(count > 0).astype(np.int64), base=base, inside=sums(inside))
        return messages([(0, bucket, 0, data)])

    return run


def _train_part(model, k: int):
    """What a bucket makes of the weights in round k: one row, if it has documents to learn."""

    def run(key, table):
        x = unpack(table["data"][0].as_py())
        learn = x["round"] == k
        if not learn.any():
            return pa.table({"i": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "total": pa.array([], pa.binary())})
        # in an order that does not depend on how the rows came
        some = np.flatnonzero(learn)
        some = some[np.lexsort((x["base"][some], x["size"][some]))]
        size = x["size"][some]
        word = x["number"][ragged((np.cumsum(x["size"]) - x["size"])[some], size)].astype(np.int64)
        trainer = Trainer(model.value)
        trainer.learn(word, stretches(np.concatenate([[0], np.cumsum(size)])))
        total = (_flat(trainer.m).astype(np.float64) * trainer.tokens).tobytes()
        return pa.table({"i": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([trainer.tokens], pa.int64()), "total": pa.array([total], pa.binary())})

    return run


def learning_round(id_col: str, text_col: str):
    """The round in which a training document is learnt; copies under other ids are learnt in any."""
    return F.pmod(F.xxhash64(id_col, text_col, F.lit("round")), F.lit(ROUNDS)).cast("int")


def train(numbers: DataFrame, vocabulary: Vocabulary) -> dict:
    """Weights after ROUNDS rounds, which together read each training document once."""
    sc = numbers.sparkSession.sparkContext
    model = initial(vocabulary.rest)
    for k in range(ROUNDS):
        whole = tree_sum(numbers.groupBy("bucket").applyInArrow(_train_part(sc.broadcast(model), k), "i long, n long, total binary"))
        if whole:
            model = _shaped(whole[1] / whole[0], model)
    # a token that was never seen is read like the rarest tokens
    rare = WORDS + np.flatnonzero(np.isfinite(vocabulary.unseen))
    model["embed"][-2] = model["embed"][rare].mean(axis=0)
    return model


def _scorer(vocabulary, model, names: list[str], schema: pa.Schema):
    def run(bucket, table, answers):
        x = unpack(answers[0][2])
        size, word = x["size"], x["number"].astype(np.int64)
        at = np.concatenate([[0], np.cumsum(size)])
        score = x["inside"].copy()
        for a, b in chunks(size.tolist(), TOKENS):
            lp = log_likelihoods(model.value, word[at[a] : at[b]], at[a : b + 1] - at[a], vocabulary.value.unseen)
            score[a:b] += np.bincount(np.repeat(np.arange(b - a), size[a:b]), lp, b - a) / np.log(10)
        result = {
            "held_out": pa.array(x["round"] < 0), "n_tokens": pa.array(size), "n_known": pa.array(x["known"]),
            "train_tokens": pa.array(np.full(len(size), vocabulary.value.n)), "base_score": pa.array(x["base"]), "score": pa.array(score),
        }
        return pa.table([result[y] if y in result else table.column(y) for y in names], names=names).cast(schema)

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_out: int = 2) -> DataFrame:
    """docs with held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probabilities of the texts)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    prepare(spark)
    results = {f.name for f in RESULT}
    docs = docs.drop(*(c for c in docs.columns if c in results and c not in (id_col, text_col))).withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*docs.schema.fields, *RESULT])
    # the round in which a row is learnt, -1 for one that is held out
    marked = docs.withColumn(ROUND, F.when(fold(id_col, folds) != held_out, learning_round(id_col, text_col)).otherwise(-1))
    sc = spark.sparkContext
    moments = tree_sum(marked.where(f"{ROUND} >= 0").select(text_col).mapInArrow(_moments(text_col), "i long, n long, total binary"))
    topics = sc.broadcast(Topics(*(moments or (0, np.zeros((FEATURES + 1) * FEATURES)))))
    buckets = Buckets(marked, text_col, [id_col, text_col])
    n_shards = 1 + buckets.bytes // SHARD_BYTES
    counted = each_shard(buckets.each(_send_counts(text_col, n_shards, topics), MESSAGE), _add_counts).checkpoint()
    # totals, and the commonest tokens of all shards; WORDS of them reach the driver
    tops = counted.where("kind = 1").select("data").mapInArrow(_tops, "h long, count long, topic int, n long, v long, class int, mass long").checkpoint()
    n, v = tops.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    common = tops.where("h is not null").orderBy(F.col("count").desc(), "h").limit(WORDS).toPandas()
    mass = np.zeros(TOPICS * BINS, np.int64)
    for r in tops.where("class is not null").groupBy("class").agg(F.sum("mass").alias("mass")).collect():  # TOPICS * BINS rows at most
        mass[r["class"]] = r["mass"]
    vocabulary = sc.broadcast(Vocabulary(common["h"].to_numpy(np.int64).view(U), common["count"].to_numpy(np.int64), common["topic"].to_numpy(np.int64), n, v, mass))
    numbers = buckets.each_with(counted.where("kind = 0"), _number(text_col, n_shards, vocabulary), MESSAGE).checkpoint()
    model = sc.broadcast(train(numbers, vocabulary.value))
    return buckets.each_with(numbers, _scorer(vocabulary, model, schema.fieldNames(), to_arrow_schema(schema)), schema)


def _tops(batches):
    """Rows of three kinds: a shard's totals, its commonest tokens, and the mass of each class."""
    for batch in batches:
        for data in batch.column("data").to_pylist():
            x = unpack(data)
            used = np.flatnonzero(x["mass"])
            n, v = x["n"].tolist()
            rows = [(None, None, None, n, v, None, None)]
            rows += [(h, c, t, None, None, None, None) for h, c, t in zip(x["h"].view(np.int64).tolist(), x["count"].tolist(), x["topic"].tolist(), strict=True)]
            rows += [(None, None, None, None, None, k, m) for k, m in zip(used.tolist(), x["mass"][used].tolist(), strict=True)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["h", "count", "topic", "n", "v", "class", "mass"])
