"""Periodic runs: internal pattern matching over the words of each document.

Prefix doubling names every block of 2^j words of a document by its rank; the last names are the suffix array. Every
aligned (dyadic) block of b >= 8 words asks a wavelet tree over the suffix array for its next occurrences in the
window of 2b words that follows (range successor: count what lies below, select the next). Occurrences at distances up
to b/2 form an arithmetic progression, which is passed over in one step: the stretch of its period tells where its
last term is and, against the stretch of the block itself, which distances can be a longer period. Each distance is a
candidate period; the longest common extensions to both sides, read from the names of all levels, give its maximal
stretch. Of one stretch the least period counts.

Why nothing is missed: a run of period q and at least max(24, 3q) words holds, for b = 8 or the largest power of two
up to q, an aligned block whose copy q words on lies in the run too, and q < 2b. That copy is a single occurrence or
the first of a progression, or the block's stretch begins or ends q words before the copy's (else the run would have
the progression's period).

Documents share tasks in chunks of ``CHUNK`` words. Blocks that occur once are left out at each level, and documents in which no block of
8 words occurs twice are done after three levels. A task needs about 4 bytes for each word of a chunk, level of names and level of the tree; a
longer document is a chunk of its own, so its memory grows with its words (times the levels, the binary logarithm
of its longest repeat).

Defined cases: a null or blank text has no words (n = 0), no runs and the SHA-256 of nothing. A null doc_id
has no hash, so its words stay as they are. Equal documents and repeated ids give a row each. Ties of the greatest exponent go
to the smallest start, then period. An empty table gives no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hourwise.llm.common import travels
from hourwise.llm.text import texts_of

travels(__name__)

#: Words of a chunk of documents.
CHUNK = 1 << 17
MIN_LENGTH, MIN_EXPONENT = 24, 3
#: The smallest dyadic block has 2^LEAST words: two thirds of MIN_LENGTH hold one at any offset.
LEAST = 3
RESULT = [("n_runs", T.LongType()), ("start", T.LongType()), ("length", T.LongType()), ("period", T.LongType()),
          ("exponent_milli", T.LongType()), ("runs_sha256", T.StringType()), ("collapsed_sha256", T.StringType())]


def rewritten(words: list[bytes], doc_id) -> list[bytes]:
    """The words of a document; one in ten, by a hash of its id, is made periodic from some word on."""
    n = len(words)
    if not n or doc_id is None or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


# ---------------------------------------------------------------- names of blocks

def _refine(names: np.ndarray, second: np.ndarray, at: np.ndarray):
    """New names of the positions ``at`` (all positions whose name is not their own alone), each the number of smaller
    ones, by (name, second); and those positions that still share theirs."""
    key = names[at].astype(np.int64) << 32 | second
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    place = np.arange(len(at))
    first = lambda x: np.maximum.accumulate(np.where(np.r_[True, x[1:] != x[:-1]], place, 0))
    begin = first(key)
    out = names.copy()
    out[at] = names[at] + (begin - first(key >> 32))
    alone = np.r_[begin[1:] == place[1:], True] & (begin == place)
    return out, np.sort(at[~alone])


def _first_names(codes: np.ndarray, doc: np.ndarray):
    key = doc.astype(np.int64) << 32 | codes
    order = np.argsort(key, kind="stable")
    key, place = key[order], np.arange(len(order))
    begin = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], place, 0))
    names = np.empty(len(codes), dtype=np.int32)
    names[order] = begin
    alone = np.r_[begin[1:] == place[1:], True] & (begin == place)
    return names, np.sort(order[~alone])


def _next_level(names, ends, at, step):
    there = at + step
    second = np.where(there < ends[at], names[np.minimum(there, len(names) - 1)].astype(np.int64) + 1, 0)
    return _refine(names, second, at)


class Names:
    """Names of the blocks of 1, 2, 4, ... words of the documents that repeat a block of 2^LEAST words."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        doc = np.repeat(np.arange(len(sizes)), sizes)
        ends = np.cumsum(sizes)[doc] if len(sizes) else doc
        names, at = _first_names(codes, doc)
        levels = [names]
        for j in range(LEAST):
            names, at = _next_level(names, ends, at, 1 << j)
            levels.append(names)
        self.docs = np.unique(doc[at])
        keep = np.isin(doc, self.docs)
        # names are places in the order of all words of the chunk, document by document
        old, new = np.cumsum(sizes) - sizes, np.zeros(len(sizes), dtype=np.int64)
        new[self.docs] = np.cumsum(sizes[self.docs]) - sizes[self.docs]
        shift = (new - old)[doc[keep]].astype(np.int32)
        self.begin = new[doc[keep]]
        self.end = self.begin + sizes[doc[keep]]
        self.levels = [x[keep] + shift for x in levels]
        at = np.flatnonzero(np.isin(np.flatnonzero(keep), at, assume_unique=True))
        while len(at):
            names, at = _next_level(self.levels[-1], self.end, at, 1 << len(self.levels) - 1)
            self.levels.append(names)
        self.suffixes = np.empty(len(self.begin), dtype=np.int64)
        self.suffixes[self.levels[-1]] = np.arange(len(self.begin))
        self._padded = [np.r_[x, np.int32(-1)] for x in self.levels]

    def right(self, i: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Words from i < k (of one document) on that are equal."""
        n = np.zeros_like(i)
        for j in range(len(self.levels) - 1, -1, -1):
            x = self._padded[j]
            n += (x[i + n] == x[k + n]).astype(np.int64) << j
        return n

    def left(self, i: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Words before i < k (of one document) that are equal."""
        n, room = np.zeros_like(i), i - self.begin[i]
        for j in range(len(self.levels) - 1, -1, -1):
            x, far = self.levels[j], n + (1 << j)
            same = (far <= room) & (x[np.maximum(i - far, 0)] == x[np.maximum(k - far, 0)])
            n = np.where(same, far, n)
        return n

    def stretch(self, x: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maximal stretch of period d around the words x and x + d."""
        return x - self.left(x, x + d), x + d + self.right(x, x + d)


class WaveletTree:
    """Range successor over an array of the numbers below its length."""

    def __init__(self, values: np.ndarray):
        self.top = max(1, int(len(values)).bit_length())
        self.zeros, self.below = [], []
        for j in range(self.top - 1, -1, -1):
            bit = (values >> j & 1).astype(bool)
            self.below.append(np.r_[0, np.cumsum(~bit)].astype(np.int32))
            self.zeros.append(int(self.below[-1][-1]))
            values = np.r_[values[~bit], values[bit]]

    def successor(self, lo: np.ndarray, hi: np.ndarray, v: np.ndarray, none: int) -> np.ndarray:
        """The least value above v at the places lo to hi (exclusive); ``none`` if there is none."""
        l, r, k = lo, hi, np.zeros_like(lo)
        for j, (below, zeros) in enumerate(zip(self.below, self.zeros)):
            bit = (v + 1 >> self.top - 1 - j & 1).astype(bool)
            a, b = below[l], below[r]
            k = np.where(bit, k + b - a, k)
            l, r = np.where(bit, zeros + l - a, a), np.where(bit, zeros + r - b, b)
        there = k < hi - lo
        l, r, k = lo[there], hi[there], k[there]
        found = np.zeros_like(l)
        for below, zeros in zip(self.below, self.zeros):
            a, b = below[l], below[r]
            one = k >= b - a
            found = found << 1 | one
            k = np.where(one, k - (b - a), k)
            l, r = np.where(one, zeros + l - a, a), np.where(one, zeros + r - b, b)
        out = np.full(len(lo), none, dtype=np.int64)
        out[there] = found
        return out


# ---------------------------------------------------------------- candidates

def _candidates(names: Names, tree: WaveletTree, j: int):
    """(x, d): words x with a candidate period d, from the aligned blocks of 2^j words."""
    b, level = 1 << j, names.levels[j]
    size = np.bincount(level, minlength=len(level))
    place = np.arange(len(level)) - names.begin
    x = np.flatnonzero((place % b == 0) & (place + b <= names.end - names.begin) & (size[level] > 1))
    lo = level[x].astype(np.int64)
    hi = lo + size[lo]
    cur, period = x.copy(), np.zeros_like(x)
    own_s, own_e = np.zeros_like(x), np.zeros_like(x)
    far = len(level) + 2 * b
    xs, ds = [], []
    while len(x):
        y = tree.successor(lo, hi, cur, far)
        go = y < x + 2 * b
        x, lo, hi, cur, period, own_s, own_e, y = (v[go] for v in (x, lo, hi, cur, period, own_s, own_e, y))
        xs.append(x)
        ds.append(y - x)
        gap = y - cur
        dense = gap <= b // 2
        new = dense & (period == 0)
        if new.any():
            period[new] = gap[new]
            # the block has the period, so its stretch goes on from the block's second copy of it
            own_s[new], own_e[new] = names.stretch(x[new], period[new])
        nxt = y.copy()
        if dense.any():
            s, e = names.stretch(cur[dense], gap[dense])
            nxt[dense] = e - b - (e - b - cur[dense]) % gap[dense]
            other = s != own_s[dense]
            for d in ((e - own_e[dense])[other], (s - own_s[dense])[other]):
                fits = (d > 0) & (d < 2 * b)
                xs.append(x[dense][other][fits])
                ds.append(d[fits])
        cur = nxt
    return (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (xs, ds))


def runs_of(codes: np.ndarray, sizes: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of all runs by document, in order; ``codes`` are the words' numbers, document by document."""
    if not len(codes):
        return {}
    names = Names(codes, sizes)
    if not len(names.begin):
        return {}
    tree = WaveletTree(names.suffixes)
    longest = int((names.end - names.begin).max())
    found = []
    for j in range(LEAST, len(names.levels)):
        if 1 << j > max(MIN_LENGTH, longest) // MIN_EXPONENT:
            break
        x, d = _candidates(names, tree, j)
        fits = x + d < names.end[x]
        x, d = x[fits], d[fits]
        s, e = names.stretch(x, d)
        long = e - s >= np.maximum(MIN_LENGTH, MIN_EXPONENT * d)
        found.append(np.c_[s, e, d][long])
    found = np.unique(np.concatenate(found), axis=0)  # by start, end, period
    if not len(found):
        return {}
    least = np.r_[True, (found[1:, :2] != found[:-1, :2]).any(axis=1)]
    owner = np.repeat(names.docs, sizes[names.docs])
    out: dict[int, list] = {}
    for s, e, d in found[least].tolist():
        out.setdefault(int(owner[s]), []).append((s - int(names.begin[s]), e - s, d))
    return {k: sorted(v, key=lambda r: (r[0], r[2])) for k, v in out.items()}


# ---------------------------------------------------------------- results

def _hex(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def result(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The row of a document: its runs, the one of the greatest exponent, and its words without their repeats."""
    if not runs:
        return 0, None, None, None, None, _hex(b""), _hex(b" ".join(words))
    best = runs[0]
    for r in runs[1:]:
        if r[1] * best[2] > best[1] * r[2]:
            best = r
    keep = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, q in runs:
        keep[s + q] += 1
        keep[s + length] -= 1
    gone = np.cumsum(keep[:-1]) > 0
    kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g)
    return (len(runs), *best, 1000 * best[1] // best[2], _hex("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()), _hex(kept))


def _solve(docs: list[list[bytes]]) -> list[tuple]:
    sizes = np.array([len(w) for w in docs], dtype=np.int64)
    flat = pa.array([w for words in docs for w in words], pa.binary())
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = runs_of(codes, sizes)
    return [result(words, runs.get(k, [])) for k, words in enumerate(docs)]


def _chunks(batch):
    """Lists of words, enough documents at a time for a chunk."""
    docs, room = [], CHUNK
    for doc_id, raw in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
        words = rewritten((raw or b"").split(), doc_id)
        if docs and len(words) > room:
            yield docs
            docs, room = [], CHUNK
        docs.append(words)
        room -= len(words)
    if docs:
        yield docs


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of every document (doc_id, text): their number, the one of the greatest exponent, the digests of all runs and
    of the words that stay."""
    d = docs.select("doc_id", "text")
    schema = T.StructType([d.schema["doc_id"], *[T.StructField(n, t) for n, t in RESULT]])

    def run(batches):
        names = [f.name for f in schema]
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        for batch in batches:
            at = 0
            for chunk in _chunks(batch):
                rows = list(zip(*_solve(chunk)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(chunk)),
                                                  *[pa.array(c, k) for c, k in zip(rows, kinds)]], names=names)
                at += len(chunk)
    return d.mapInArrow(run, schema)
