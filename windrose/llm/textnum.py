"""Texts as numpy arrays inside tasks: concatenated UTF-8, word bounds, hashes of words and byte strings."""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
#: ASCII white space as the contracts have it: \x20 and \x09-\x0D
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, after A-Z are lower-cased
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: for bytes.translate
LOWER_ASCII = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))

#: Odd multipliers for each of two independent hashes: by a rule, as many as are asked for.
_MULT: dict[int, np.ndarray] = {}
SALT = (U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93))
#: the first n bytes of eight, as they are loaded
FIRST = np.array([(1 << (8 * n)) - 1 for n in range(9)], U)
#: strings of more bytes are hashed one by one
SHORT = 32


def multipliers(n: int, which: int = 0) -> np.ndarray:
    if which not in _MULT or len(_MULT[which]) < n:
        _MULT[which] = np.random.default_rng(20_240_917 + which).integers(1, 1 << 63, size=max(16, n), dtype=np.int64).astype(U) * U(2) + U(1)
    return _MULT[which]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a hash are usable."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def loads(raw: bytes) -> np.ndarray:
    """Eight bytes as one number, from each place on; zeros follow the end."""
    return np.ndarray((len(raw) + 1,), "<u8", raw + bytes(8), 0, (1,))


def span_hashes(raw: bytes, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of each raw[start:end]; equal for equal bytes wherever they stand.

    Short strings are taken eight bytes at a time, each mixed in by a bijection, so that strings of up to eight bytes
    and one length never collide, and no arithmetic pattern of a string makes hashes agree. Longer ones go to BLAKE2b.
    """
    size = end - start
    out = mix(size.astype(U) * SALT[which] + SALT[1 - which])
    eight = loads(raw)
    some = np.flatnonzero((size > 0) & (size <= SHORT))
    for k in range(0, SHORT, 8):
        if k:
            some = some[size[some] > k]
        if not len(some):
            break
        x = eight[start[some] + k] & FIRST[np.minimum(size[some] - k, 8)]
        out[some] = mix((out[some] ^ x) * SALT[which])
    long = np.flatnonzero(size > SHORT)
    if len(long):
        digest = b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)])
        out[long] = np.frombuffer(digest, "<u8").reshape(-1, 2)[:, which]
    return out


#: bytes of the strings that gram_hashes takes at each place
GRAM = 32


def gram_hashes(raw: bytes, which: int = 0) -> np.ndarray:
    """Hash of the GRAM bytes from each place on, as far as they fit: of eight, of twice eight, of twice sixteen."""
    n = len(raw)
    if n < GRAM:
        return np.empty(0, U)
    m = multipliers(4, 2 + which)
    x = loads(raw)[: n - 7] * m[0]
    for half, k in ((8, 1), (16, 2)):
        x ^= x >> U(31)
        x *= m[3]
        x ^= x >> U(29)
        x = x[:-half] * m[k] + x[half:]
    return mix(x)


def combined_grams(gram: np.ndarray, start: np.ndarray, size: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of strings of `size` bytes, GRAM at least, from the grams that lie end to end in each, and its last."""
    m = multipliers(2 + int(size.max(initial=0)) // GRAM, 4 + which)
    out = gram[start + size - GRAM] * m[0] + size.astype(U) * m[1]
    for k in range(int(size.max(initial=0)) // GRAM):
        if (size >= GRAM * (k + 1)).all():
            out += gram[start + GRAM * k] * m[2 + k]
        else:
            some = size >= GRAM * (k + 1)
            out[some] += gram[start[some] + GRAM * k] * m[2 + k]
    return mix(out)


def bounds(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge[0::2], edge[1::2]


def encode(texts) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]


def chunks(sizes, most: int = 1 << 20):
    """(from, to) over consecutive texts of about `most` bytes together; a longer text stands alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


class Words:
    """The words of several texts: bounds in `data`, the text that each belongs to, and the first word of each text.

    A line feed follows each text, so that no word spans two.
    """

    def __init__(self, texts: list[bytes], kind: np.ndarray, lower: bool):
        joined = b"\n".join([*texts, b""])
        self.joined = joined.translate(LOWER_ASCII) if lower else joined
        self.data = np.frombuffer(self.joined, np.uint8)
        self.start, self.end = bounds(kind[self.data])
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.text_at = np.concatenate([[0], np.cumsum(lengths)])
        self.first = np.searchsorted(self.start, self.text_at)  # of each text, and the end
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts)), self.count)

    def hashes(self, which: int = 0) -> np.ndarray:
        return span_hashes(self.joined, self.start, self.end, which)


def space_words(texts: list[bytes], lower: bool = False) -> Words:
    """Words [^\\x20\\x09-\\x0D]+."""
    return Words(texts, ~SPACE, lower)


def alnum_words(texts: list[bytes]) -> Words:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the lower-cased texts."""
    return Words(texts, ALNUM, True)


def window_hashes(word_hash: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of each run of `size` words, by their hashes."""
    n = max(0, len(word_hash) - size + 1)
    out = np.zeros(n, U)
    m = multipliers(size, which)
    for i in range(size):
        out += word_hash[i : n + i] * m[i]
    return mix(out)


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans; spans that touch become one. Starts must be sorted."""
    if not len(start):
        return start, end
    reach = np.maximum.accumulate(end)
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start+1, ... count of them, for each pair, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)
