"""Toxicity: a support vector machine on a gapped subsequence kernel, with Nystroem landmarks.

The subsequence kernels of orders 2 to 4 (Lodhi et al., 2002) compare two strings by their common subsequences of two,
three and four characters, each weighted by DECAY to the length that it spans in both. The mean of the orders that a
string is long enough for is used. Characters put into an insult, replaced, or left out of it, only lower the weight.

A document is a bag of terms: words in lower case without ASCII punctuation; single letters in a row are one term. The
kernel of a term and a landmark is the sum of the orders' normalised kernels, normalised again: one kernel, of features
and of the Nystroem map alike. It is computed where a term has at least SHARED of a landmark's letters; below that it is
small, and taken as 0. Landmarks are strings of LENGTHS characters, inside terms, that set toxic labelled documents most
apart, by a likelihood ratio that chance would not reach among all strings tried, so that wrong labels choose none. Besides
documents that hold a string, those that use terms which begin with it OFTEN times are counted.
Sentences that stand in several documents count once, so that copies of one wrongly labelled document do not either. Of
strings that are alike one is taken. The Nystroem map, kernels times the inverse square root of the landmarks' own kernel
matrix, makes them inputs of a linear machine. There are LANDMARKS of them, and as many more as it takes until every toxic
training document that has any candidate holds a landmark, or a string much like one.

Labels are of documents. A first machine is trained on terms: those of clean documents are negative; of a toxic document, the
term that scores highest is positive, chosen again after each round; after the first, only where it scores above 0, so
that a document whose label is wrong, or without any insult, teaches nothing. A second one is trained on documents: its
inputs are how much of each landmark the terms of a document hold, by kernels and for each 100 terms, and the highest term
score. So a mark that clean documents have as well, but less often, counts by how often it stands. A document's
score is a logistic function of what the second machine says, fitted to documents that it was not fitted to.

The texts of at most ``max_rows`` labelled documents train, each with all of its terms; only candidates and each
document's distinct features reach the driver. Scoring runs over all documents.

Defined results: a null text counts as empty; a text without terms scores like one in which nothing is alike.
Labels that are null are left out; of several labels of one id the largest counts. Rows with repeated or null ids are
scored each on its own. Without both classes every document gets the share of ones, smoothed. Columns of the
documents whose names clash with the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, prepare
from .quality import training_sample
from .textnum import ALNUM, chunks, encode, ragged, space_words, span_hashes

MAX_ROWS = 8_000
LANDMARKS = 32
#: lengths of landmarks, and how many candidates reach the driver at a time
LENGTHS = (3, 8)
#: uses of a term's beginning from which on a document uses it often
OFTEN = 3
#: terms that are added to a text's when rates are taken; chosen among a few by both folds of sf0.1
SMOOTHED = 60
CANDIDATES = 2_000
ORDER, DECAY = 4, 0.5
SHARED = 0.75
#: longer terms are met in overlapping stretches of this length
LONGEST = 32
#: pairs of strings whose kernels are taken at a time
BLOCK = 2_048


class Terms:
    """Distinct terms of texts, and the sentence and text of each use of one."""

    def __init__(self, texts: list[bytes]):
        w = space_words(texts, lower=True)
        inside = ALNUM[w.data]
        self.data = w.data[inside]
        at = np.concatenate([[0], np.cumsum(inside)])
        start, end = at[w.start], at[w.end]
        used = end > start
        # a sentence ends with a word that ends in . ! or ?, or stands before a line feed
        stops = np.isin(w.data[w.end - 1], np.frombuffer(b".!?", np.uint8)) | (w.data[w.end] == 10) if len(w.end) else np.empty(0, bool)
        sentence = np.concatenate([[0], np.cumsum(stops)])[:-1] if len(stops) else np.empty(0, np.int64)
        start, end, sentence, text = start[used], end[used], sentence[used], w.text[used]
        single = end - start == 1
        new = np.ones(len(start), bool)
        new[1:] = ~(single[1:] & single[:-1] & (text[1:] == text[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start))[: len(first)] - 1  # no term, no last one
        start, end, sentence, text = start[first], end[last], sentence[first], text[first]
        long = np.flatnonzero(end - start > LONGEST)
        if len(long):
            n = -(-(end - start - LONGEST)[long] // (LONGEST // 2))
            at = np.repeat(long, n)
            begin = start[at] + (ragged(np.zeros(len(long), np.int64), n) + 1) * (LONGEST // 2)
            stop = np.minimum(begin + LONGEST, end[at])
            end = end.copy()
            end[long] = start[long] + LONGEST
            start, end = np.concatenate([start, begin]), np.concatenate([end, stop])
            sentence, text = np.concatenate([sentence, sentence[at]]), np.concatenate([text, text[at]])
        h = span_hashes(self.data.tobytes(), start, end)
        self.hash, where, self.term = np.unique(h, return_index=True, return_inverse=True)
        self.start, self.end = start[where], end[where]
        self.sentence, self.text = sentence, text

    def strings(self) -> list[str]:
        raw = self.data.tobytes()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(self.start.tolist(), self.end.tolist(), strict=True)]


def padded(data: np.ndarray, start: np.ndarray, end: np.ndarray, width: int) -> np.ndarray:
    """Strings as rows of bytes + 1, filled with 0."""
    place = start[:, None] + np.arange(width)
    inside = place < end[:, None]
    return np.where(inside, data[np.minimum(place, max(0, len(data) - 1))].astype(np.int16) + 1, 0)


def kernels(s: np.ndarray, t: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Subsequence kernels of orders 2 to order, one row each, of each row of s with the same row of t.

    Both are rows of characters, filled with 0. Rows of like lengths are taken together, as many as stay in a core's cache, and
    without what fills all of them.
    """
    k = np.zeros((order - 1, len(t)), np.float32)
    size, other = (s > 0).sum(axis=1), (t > 0).sum(axis=1)
    like = np.lexsort((other, size))
    for a in range(0, len(like), BLOCK):
        some = like[a : a + BLOCK]
        k[:, some] = _kernels(s[some, : size[some].max()].T.copy(), t[some, : other[some].max()].T.copy(), order)
    return k


def _kernels(s: np.ndarray, t: np.ndarray, order: int) -> np.ndarray:
    """kernels() of columns, so that a step over all strings reads numbers that lie beside one another."""
    width, n = t.shape
    k = np.zeros((order - 1, n), np.float32)
    decay, square = np.float32(DECAY), np.float32(DECAY**2)
    # ahead[j, i]: weighted common subsequences of i + 1 characters of s so far and t[:j], up to the strings' ends
    ahead = np.zeros((width + 1, order - 1, n), np.float32)
    step = np.empty((width, order, n), np.float32)
    run = np.empty((order - 1, n), np.float32)
    for x in s:
        np.multiply((x == t) & (x > 0), square, out=step[:, 0])
        np.multiply(ahead[:-1], step[:, :1], out=step[:, 1:])
        ahead *= decay
        run[:] = 0
        for j in range(width):
            k += step[j, 1:]
            run *= decay
            run += step[j, :-1]
            ahead[j + 1] += run
    return k


def kernel(s: np.ndarray, t: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Subsequence kernel of one order."""
    return kernels(s, t, order)[-1]


def _parts(size: np.ndarray, most: int = 20_000):
    """Places of sizes, ascending, `most` at a time."""
    order = np.argsort(size, kind="stable")
    return (order[a : a + most] for a in range(0, len(order), most))


def _rows(strings: list[str]) -> np.ndarray:
    raw = [t.encode() for t in strings]
    if not raw:
        return np.zeros((0, 1), np.int16)
    size = np.array([len(x) for x in raw], np.int64)
    ends = np.cumsum(size)
    return padded(np.frombuffer(b"".join(raw), np.uint8), ends - size, ends, int(size.max()))


@dataclass
class Landmarks:
    terms: list[str]

    def __post_init__(self):
        raw = [t.encode() for t in self.terms]
        self.rows = _rows(self.terms)
        self.own = kernels(self.rows, self.rows)
        self.orders = (self.own > 0).sum(axis=0)
        self.counts = [dict(zip(*(x.tolist() for x in np.unique(np.frombuffer(r, np.uint8), return_counts=True)), strict=True)) for r in raw]
        self.least = [int(np.ceil(SHARED * len(r))) for r in raw]
        a, b = np.indices((len(raw), len(raw))).reshape(2, -1)
        both = np.sqrt(self.own[:, a] * self.own[:, b])
        own = (kernels(self.rows[a], self.rows[b]) / np.where(both > 0, both, 1)).sum(axis=0) / np.sqrt(self.orders[a] * self.orders[b]) if raw else np.zeros(0)
        values, vectors = np.linalg.eigh(own.reshape(len(raw), len(raw)).astype(float)) if raw else (np.zeros(0), np.zeros((0, 0)))
        keep = values > 1e-3
        self.map = vectors[:, keep] / np.sqrt(values[keep])

    def alike(self, t: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term, landmark, kernel) of pairs that share enough letters; the kernel of others is small, and taken as 0."""
        return self.compare(t)[:3]

    def compare(self, t: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """alike(), and how much of the landmark each term holds, whatever else it has: 1 for all of it."""
        term, mark = self.sharing(t)
        if not len(term):
            return term, mark, np.empty(0, np.float32), np.empty(0, np.float32)
        value, held = np.zeros(len(term), np.float32), np.zeros(len(term), np.float32)
        # a term is like several landmarks, and has one kernel with itself
        met, of = np.unique(term, return_inverse=True)
        size = (t.end - t.start)[met]
        own = np.zeros((ORDER - 1, len(met)), np.float32)
        for part in _parts(size):
            rows = padded(t.data, t.start[met[part]], t.end[met[part]], size[part[-1]])
            own[:, part] = kernels(rows, rows)
        for part in _parts(size[of]):
            rows = padded(t.data, t.start[term[part]], t.end[term[part]], size[of[part[-1]]])
            value[part], held[part] = self.similar(rows, mark[part], own[:, of[part]])
        return term, mark, value, held

    def sharing(self, t: Terms) -> tuple[np.ndarray, np.ndarray]:
        """(term, landmark) of pairs that share enough letters."""
        n, letters = len(t.start), sorted(set().union(*self.counts))
        code = np.full(256, len(letters))
        code[letters] = np.arange(len(letters))
        size = t.end - t.start
        # how often each term has each letter: LONGEST times at most; counted for some terms at a time, as a long text has many
        has = np.zeros((len(letters) + 1, n), np.uint8)
        for a in range(0, n, 20_000):
            some = size[a : a + 20_000]
            place = np.repeat(np.arange(len(some)) * len(has), some) + code[t.data[ragged(t.start[a : a + 20_000], some)]]
            has[:, a : a + 20_000] = np.bincount(place, minlength=len(some) * len(has)).reshape(len(some), len(has)).T
        terms, marks = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for mark, (count, least) in enumerate(zip(self.counts, self.least, strict=True)):
            shared = np.zeros(n, np.uint8)
            for letter, most in count.items():
                shared += np.minimum(has[code[letter]], np.uint8(min(most, LONGEST)))
            found = np.flatnonzero(shared >= least)
            terms.append(found)
            marks.append(np.full(len(found), mark))
        return np.concatenate(terms), np.concatenate(marks)

    def similar(self, rows: np.ndarray, mark: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row, whose kernels with itself are own, and its landmark: the normalised kernel, as in the landmarks' own
        matrix; and the kernel's share of the landmark's with itself, 1 at most, as a mean over orders."""
        k, its = kernels(rows, self.rows[mark]), self.own[:, mark]
        both = np.sqrt(own * its)
        orders = (own > 0).sum(axis=0) * self.orders[mark]
        value = (k / np.where(both > 0, both, 1)).sum(axis=0) / np.sqrt(np.maximum(orders, 1))
        return value, np.minimum(k / np.where(its > 0, its, 1), 1).sum(axis=0) / np.maximum(self.orders[mark], 1)

    def features(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Text and kernels with all landmarks of each distinct term of a text that is like one."""
        return self.read(texts)[:2]

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text and kernels with all landmarks of each distinct term of a text that is like one, the texts' bags).

        A bag has for each landmark how much of it all uses of terms hold together, less than a half of one not counted, and
        the number of uses last.
        """
        t = Terms(texts)
        term, mark, value, held = self.compare(t)
        found, place = np.unique(term, return_inverse=True)
        table, holds = np.zeros((2, len(found), len(self.terms)), np.float32)
        table[place, mark], holds[place, mark] = value, np.maximum(2 * held - 1, 0)
        row = np.full(len(t.start), -1)
        row[found] = np.arange(len(found))
        used = row[t.term] >= 0
        uses = t.text[used] * np.int64(len(found) + 1) + row[t.term[used]]
        pairs, times = np.unique(uses, return_counts=True)
        text, of = np.divmod(pairs, len(found) + 1)
        bags = np.zeros((len(texts), len(self.terms) + 1), np.float32)
        if len(text):  # texts ascend
            first = np.flatnonzero(np.diff(text, prepend=-1))
            bags[text[first], :-1] = np.add.reduceat(holds[of] * times[:, None].astype(np.float32), first, axis=0)
        bags[:, -1] = np.bincount(t.text, minlength=len(texts))
        return text, table[of], bags


def bag_inputs(bags: np.ndarray, top: np.ndarray) -> np.ndarray:
    """A document as inputs of the second machine: the logarithm of each landmark's rate among 100 terms, by which SMOOTHED
    terms more are counted so that short texts do not seem full of one; and the highest term score."""
    amount, uses = bags[:, :-1].astype(float), bags[:, -1:].astype(float)
    return np.column_stack([np.log1p(100 * amount / (uses + SMOOTHED)), top])


@dataclass
class Machine:
    landmarks: Landmarks
    weight: np.ndarray
    bias: float
    slope: float
    level: float
    #: of the second machine: weights of bag_inputs, and the bias
    document: np.ndarray | None = None

    def decide(self, x: np.ndarray) -> np.ndarray:
        return x @ (self.landmarks.map @ self.weight) + self.bias

    def documents(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(highest term score, bag) of each text; terms that are like no landmark score the bias."""
        top = np.full(len(texts), self.bias)
        text, x, bags = self.landmarks.read(texts)
        np.maximum.at(top, text, self.decide(x))
        return top, bags

    def decisions(self, texts: list[bytes]) -> np.ndarray:
        """What the second machine says of each text."""
        if not len(self.landmarks.terms) or self.document is None:
            return np.full(len(texts), self.bias)
        top, bags = self.documents(texts)
        return bag_inputs(bags, top) @ self.document[:-1] + self.document[-1]

    def score(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.decisions(texts) + self.level, -60, 60)))


def fit_documents(x: np.ndarray, y: np.ndarray, cost: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Weights and bias of a linear support vector machine with squared hinge loss, in the primal by Newton steps (Chapelle,
    2007); classes weigh the same. Inputs are scaled by their spread, which the weights take back."""
    spread = np.maximum(x.std(axis=0), 1e-3)
    z = np.column_stack([x / spread, np.ones(len(x))])
    sign = np.where(y > 0, 1.0, -1.0)
    each = cost * len(y) / (2 * np.where(y > 0, max(1, (y > 0).sum()), max(1, (y <= 0).sum())))
    keep = np.append(np.ones(x.shape[1]), 1e-6)  # the bias is free
    w = np.zeros(z.shape[1])
    loss = lambda w: 0.5 * (keep * w * w).sum() + 0.5 * (each * np.maximum(0, 1 - sign * (z @ w)) ** 2).sum()
    for _ in range(rounds):
        inside = sign * (z @ w) < 1
        zi, ei = z[inside], each[inside]
        step = np.linalg.solve(np.diag(keep) + (zi * ei[:, None]).T @ zi, keep * w + zi.T @ (ei * (zi @ w - sign[inside])))
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-4:
            size /= 2
        if np.abs(size * step).max() < 1e-8:
            break
        w = w - size * step
    return np.append(w[:-1] / spread, w[-1])


def out_of_fold(x: np.ndarray, y: np.ndarray, folds: int = 5) -> np.ndarray:
    """Decisions on each document of a machine that was not fitted to it."""
    part = np.random.default_rng(0).permutation(len(y)) % folds
    out = np.zeros(len(y))
    for k in range(folds):
        w = fit_documents(x[part != k], y[part != k])
        out[part == k] = x[part == k] @ w[:-1] + w[-1]
    return out


def fit_linear(z: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30, times: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Linear machine by dual coordinate descent (Hsieh et al., 2008); classes weigh the same; the bias is a feature.

    times: how often each row stands.
    """
    times = np.ones(len(y)) if times is None else times
    x = np.column_stack([z, np.ones(len(z))])
    sign = np.where(y > 0, 1.0, -1.0)
    total = [max(1, times[y <= 0].sum()), max(1, times[y > 0].sum())]
    limit = cost * times * len(y) / (2 * np.where(y > 0, total[1], total[0]))
    norm = np.maximum((x**2).sum(axis=1), 1e-9)
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        for i in rng.permutation(len(y)).tolist():
            old = alpha[i]
            alpha[i] = min(max(old - (sign[i] * (x[i] @ w) - 1) / norm[i], 0.0), limit[i])
            if alpha[i] != old:
                w += (alpha[i] - old) * sign[i] * x[i]
    return w[:-1], float(w[-1])


def fit_logistic(d: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """slope and level of the probability of class 1, with Platt's smoothed targets."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a = np.array([1.0, 0.0])
    x = np.column_stack([d, np.ones(len(d))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        a = a - np.clip(step, -2, 2)
    return float(max(a[0], 0)), float(a[1])


def choose(candidates: list[str], n: int) -> list[str]:
    """The first n candidates that are not much alike an earlier choice, in either direction."""
    chosen = Chosen([])
    for c in candidates:
        if len(chosen.terms) == n:
            break
        chosen.add(c)
    return chosen.terms


class Chosen:
    """Landmarks so far; one that is much alike an earlier one, in either direction, is not added."""

    def __init__(self, terms: list[str]):
        self.terms: list[str] = []
        self.rows, self.own = np.zeros((0, 4 * LENGTHS[1]), np.int16), np.empty(0, np.float32)
        for t in terms:
            self.add(t)

    def add(self, term: str) -> bool:
        row = _rows([term])
        row = np.pad(row, ((0, 0), (0, self.rows.shape[1] - row.shape[1])))
        own = kernel(row, row, 3)
        k = len(self.terms)
        if k and (kernel(np.repeat(row, k, axis=0), self.rows, 3) / np.minimum(self.own, own)).max() >= 0.3:
            return False
        self.terms.append(term)
        self.rows, self.own = np.concatenate([self.rows, row]), np.concatenate([self.own, own])
        return True


def _document_terms(batches):
    """Of each document its distinct terms, between line feeds, and the batch."""
    for batch in batches:
        texts = encode(batch.column("t").to_pylist())
        for a, b in chunks([len(t) for t in texts]):
            t = Terms(texts[a:b])
            strings = t.strings()
            of: list[set[str]] = [set() for _ in range(b - a)]
            for i, k in zip(t.text.tolist(), t.term.tolist(), strict=True):
                of[i].add(strings[k])
            yield batch.slice(a, b - a), ["\n".join(x) for x in of]


def _without(marks: list[str]):
    """Documents that hold none of the marks."""

    def run(batches):
        for batch, terms in _document_terms(batches):
            yield batch.filter(pa.array([not any(m in t for m in marks) for t in terms], pa.bool_()))

    return run


def _held(candidates: list[str]):
    """Of each document, which of the candidates it holds."""

    def run(batches):
        for _, terms in _document_terms(batches):
            yield pa.RecordBatch.from_arrays([pa.array([[k for k, c in enumerate(candidates) if c in t] for t in terms], pa.list_(pa.int32()))], names=["held"])

    return run


def cover(chosen: Chosen, candidates: list[str], held: list[list[int]]) -> int:
    """Adds candidates, in their order, until each document that holds one holds one that was added, or is alike one.

    held: of each document, the candidates that it holds. Returns how many documents are met now.
    """
    holders: list[list[int]] = [[] for _ in candidates]
    for d, some in enumerate(held):
        for c in some:
            holders[c].append(d)
    left = {d for d, some in enumerate(held) if some}
    n = len(left)
    for c, docs in zip(candidates, holders, strict=True):
        if left.intersection(docs):
            chosen.add(c)
            left.difference_update(docs)
    return n


def _term_uses(batches):
    """(id, term, sentence, y) once for each term of a sentence; a sentence is the hash of its terms."""
    for batch in batches:
        texts = encode(batch.column("t").to_pylist())
        ids, y = batch.column("id").to_pylist(), batch.column("y").to_pylist()
        for a, b in chunks([len(t) for t in texts]):
            t = Terms(texts[a:b])
            strings = t.strings()
            sentence = np.zeros(int(t.sentence.max(initial=0)) + 1, np.uint64)
            np.add.at(sentence, t.sentence, t.hash[t.term])
            pairs = np.unique(t.sentence * np.int64(len(strings) + 1) + t.term)
            of, term = np.divmod(pairs, len(strings) + 1)
            text = np.zeros(len(sentence), np.int64)
            text[t.sentence] = t.text
            rows = [(ids[a + text[i]], strings[k], sentence[i].view(np.int64), y[a + text[i]]) for i, k in zip(of.tolist(), term.tolist(), strict=True) if len(strings[k]) >= LENGTHS[0]]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int32()), strict=True)], names=["id", "term", "sentence", "y"])


def _term_features(landmarks):
    """(id, y, x): the distinct features of a document's terms, each as the bytes of 32-bit numbers."""

    def run(batches):
        for batch in batches:
            texts = encode(batch.column("t").to_pylist())
            for a, b in chunks([len(t) for t in texts]):
                text, x = landmarks.value.features(texts[a:b])
                width, raw = 4 * x.shape[1], x.tobytes()
                rows = sorted({(d, raw[k * width : (k + 1) * width]) for k, d in enumerate(text.tolist())})
                of = pa.array([d + a for d, _ in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id").take(of), batch.column("y").take(of), pa.array([f for _, f in rows], pa.binary())], names=["id", "y", "x"])

    return run


def _documents(machine):
    """(id, y, top, bag) of each document: its highest term score, and its bag as 32-bit numbers."""

    def run(batches):
        for batch in batches:
            texts = encode(batch.column("t").to_pylist())
            for a, b in chunks([len(t) for t in texts]):
                top, bags = machine.value.documents(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), batch.column("y").slice(a, b - a), pa.array(top, pa.float64()), pa.array([x.tobytes() for x in bags], pa.binary())], names=["id", "y", "top", "bag"])

    return run


def fit_terms(x: np.ndarray, clean: np.ndarray, row: np.ndarray, doc: np.ndarray, landmarks: Landmarks) -> tuple[np.ndarray, float]:
    """(weight, bias) from distinct features x: clean says in how many clean documents each stands; row and doc are the uses of
    features by toxic documents."""
    z = x.astype(float) @ landmarks.map
    # terms that are like nothing are one more negative
    z, clean = np.vstack([z, np.zeros(z.shape[1])]), np.append(clean, 1)
    near = np.unique(np.round(z, 2), axis=0, return_inverse=True)[1].ravel()
    value = x.max(axis=1, initial=0).astype(float)
    weight, bias = np.zeros(z.shape[1]), 0.0
    for k in range(3):
        order = np.lexsort((row, -value[row], doc))
        head = np.ones(len(order), bool)
        head[1:] = doc[order][1:] != doc[order][:-1]
        best = row[order[head]]
        best = best[(value[best] > 0) | (k == 0)]
        if not len(best):
            break
        # equal terms need one row each, with their number; clean ones are many
        _, index, times = np.unique(near[best], return_index=True, return_counts=True)
        stands = np.flatnonzero(clean)
        _, first, of = np.unique(near[stands], return_index=True, return_inverse=True)
        rows = np.concatenate([stands[first], best[index]])
        y = np.concatenate([np.zeros(len(first), int), np.ones(len(index), int)])
        weight, bias = fit_linear(z[rows], y, times=np.concatenate([np.bincount(of.ravel(), clean[stands]), times]))
        value = (z @ weight + bias)[:-1]
    return weight, bias


def find_landmarks(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """LANDMARKS strings that set toxic documents most apart, and more until those that have any such string are met."""
    chosen = Chosen(choose(_candidates(toxic, clean, n_toxic, n_clean), LANDMARKS))
    left = toxic
    while chosen.terms:
        known = len(chosen.terms)
        left = left.mapInArrow(_without(chosen.terms), left.schema)
        n = left.count()
        if not n:
            break
        candidates = _candidates(left, clean, n, n_clean)
        held = [r["held"] for r in left.mapInArrow(_held(candidates), "held array<int>").collect()]
        cover(chosen, candidates, held)
        if len(chosen.terms) == known:
            break
    return chosen.terms


def _candidates(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """The CANDIDATES strings of LENGTHS characters inside terms that set toxic documents most apart, best first."""
    uses = toxic.union(clean).select("id", "t", "y").mapInArrow(_term_uses, "id long, term string, sentence long, y int")
    # copies of a document share its sentences: each counts for one document only, and each document once
    first = uses.groupBy("term", "sentence").agg(F.min(F.struct("id", "y")).alias("of")).select("term", "of.id", "of.y").distinct()
    counts = first.groupBy("term").agg(F.sum("y").alias("bad"), F.count("*").alias("n"))
    low, high = LENGTHS
    starts = F.sequence(F.lit(1), F.greatest(F.length("term") - (low - 1), F.lit(1)))
    inside = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(low), F.lit(high)), lambda n: F.transform(starts, lambda i: F.substr(F.col("term"), i, n)))))
    strings = counts.where(F.length("term") <= LONGEST).select(F.explode(inside).alias("s"), "bad", "n").groupBy("s").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    # log-likelihood ratio of one rate for each class against one rate for both
    good, share = F.col("n") - F.col("bad"), n_toxic / (n_toxic + n_clean)
    part = lambda k, p: F.when(k > 0, k * F.log(k / (F.col("n") * p))).otherwise(0.0)
    odds = F.log(((F.col("bad") + 0.5) / n_toxic) / ((good + 0.5) / n_clean))
    strings = strings.unionByName(_often(uses))
    tried = strings.where((F.length("s") >= low) & (F.col("bad") >= 3) & (odds > 2))
    tried = tried.withColumn("ratio", part(F.col("bad"), share) + part(good, 1 - share)).groupBy("s").agg(F.max("ratio").alias("ratio")).checkpoint()
    # of as many strings as were tried, some set noise in labels apart: a string must be less likely than one in twenty by chance
    least = np.log(max(1, tried.count())) + 3
    ranked = tried.where(F.col("ratio") >= least).orderBy((F.col("ratio") * (1 + 0.5 * F.length("s"))).desc(), "s")
    return [r["s"] for r in ranked.limit(CANDIDATES).collect()]


def _often(uses: DataFrame) -> DataFrame:
    """(s, bad, n) of beginnings of terms by the documents that use them OFTEN times at least: what clean documents use once
    or twice may still mark those that use it again and again. A sentence counts once, for one document."""
    low, high = LENGTHS
    each = uses.groupBy("term", "sentence").agg(F.min(F.struct("id", "y")).alias("of")).groupBy("term", "of.id", "of.y").agg(F.count("*").alias("times"))
    begins = F.transform(F.sequence(F.lit(low), F.greatest(F.lit(low), F.least(F.lit(high), F.length("term")))), lambda n: F.substr(F.col("term"), F.lit(1), n))
    held = each.where(F.length("term") <= LONGEST).select("id", "y", "times", F.explode(begins).alias("s")).groupBy("s", "id", "y").agg(F.sum("times").alias("times"))
    return held.where(F.col("times") >= OFTEN).groupBy("s").agg(F.sum("y").alias("bad"), F.count("*").alias("n"))


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", folds: int = 5, max_rows: int = MAX_ROWS) -> Machine:
    """A machine trained on labelled documents whose fold, crc32(id as text) mod folds, is not 0."""
    spark = docs.sparkSession
    prepare(spark)
    # toxic documents are rare: half of the rows, where there are as many, come from each class
    train = fold(id_col, folds) != 0
    halves = [training_sample(docs, labels.where(F.col(label) == y), label, id_col, text_col, train, max_rows // 2) for y in (1, 0)]
    sample = halves[0].union(halves[1]).checkpoint()  # at most max_rows texts, which are read several times
    known = sample.select("id", "y").distinct().toPandas().sort_values("id")
    y = known["y"].to_numpy()
    share = float((y.sum() + 1) / (len(y) + 2))
    nothing = Machine(Landmarks([]), np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return nothing
    marks = find_landmarks(sample.where("y = 1"), sample.where("y = 0"), int(y.sum()), int(len(y) - y.sum()))
    if not marks:
        return nothing
    landmarks = Landmarks(marks)
    shared = spark.sparkContext.broadcast(landmarks)
    # terms of different documents are often equal: of each feature one row reaches the driver
    features = sample.mapInArrow(_term_features(shared), "id long, y int, x binary").groupBy("x").agg(F.count_if(F.col("y") == 0).alias("clean"), F.collect_list(F.when(F.col("y") == 1, F.col("id"))).alias("toxic"))
    found = features.toArrow().sort_by("x")
    x = np.frombuffer(b"".join(v.as_buffer() for v in found["x"]), np.float32).reshape(-1, len(marks))
    toxic = found["toxic"].combine_chunks()
    uses = np.diff(toxic.offsets.to_numpy())
    weight, bias = fit_terms(x, found["clean"].to_numpy(), np.repeat(np.arange(len(x)), uses), toxic.flatten().to_numpy(), landmarks)
    del found, x, toxic
    machine = Machine(landmarks, weight, bias, 1.0, 0.0)
    shared = spark.sparkContext.broadcast(machine)
    each = sample.mapInArrow(_documents(shared), "id long, y int, top double, bag binary").toArrow().sort_by("id")
    bags = np.frombuffer(b"".join(v.as_buffer() for v in each["bag"]), np.float32).reshape(len(each), -1)
    x, y = bag_inputs(bags, each["top"].to_numpy()), each["y"].to_numpy()
    machine.document = fit_documents(x, y)
    machine.slope, machine.level = fit_logistic(out_of_fold(x, y), y)
    return machine


def score_toxicity(docs: DataFrame, machine: Machine, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with score, the probability that a document's label is 1."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop(*([score_col] if score_col in docs.columns and score_col != text_col else []))
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    names = to_arrow_schema(schema).names
    model = spark.sparkContext.broadcast(machine)  # LANDMARKS terms and as many weights

    def run(batches):
        for batch in batches:
            texts = encode(batch.column(text_col).cast(pa.string()).to_pylist())
            parts = [model.value.score(texts[a:b]) for a, b in chunks([len(t) for t in texts])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([*parts, np.empty(0)]))], names=names)

    return docs.mapInArrow(run, schema)
