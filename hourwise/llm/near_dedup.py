"""Near-duplicate classes: BagMinHash signatures of word shingles, banding, exact multiset overlap.

A document is the multiset of its shingles of ``SHINGLE`` words (fewer words are one shingle). BagMinHash:
a shingle of weight w covers the unit cells [0, w) of a discretised weight axis, split into the dyadic
intervals [0, 1), [1, 2), [2, 4), ...; each (shingle, interval) has a Poisson process of its own, with a rate
of its length, whose points carry a time, a register and a cell. Points of cells under w count, and a
register keeps the earliest, so two registers agree with the probability of the weighted Jaccard similarity.
Points are drawn in order of time up to the moment when all registers are likely to be hit, and further only
if one is not.

Documents of the same words are one node. Nodes that share a band (``ROWS`` registers) are a group; each of
its nodes meets the group's best connected node only, never all others, and the overlap of the whole
multisets confirms a link. Which other nodes of such a star can still be linked to each other follows from their
distances to its centre and from the units that none of them shares (see ``_open``); these few pairs are
compared too. Classes are connected components.

Two nodes at the threshold share no band with a probability of (1 - 0.8^4)^32 = 5e-8; that is the only way
to lose a link. Defined cases: texts without words (null, empty) are classes of their own; repeated rows are
copies; the class id is the least doc_id (null only if all are null); ties go to the row read first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourwise.llm.common import ROW, fresh_join, travels
from hourwise.llm.text import folded_pieces, texts_of
from hourwise.session import discard, materialize

travels(__name__)

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
#: Cells into which a star centre's size is cut to find pairs by their bounds.
CELLS = 32
REGISTERS = BANDS * ROWS
#: Points a draw takes at a time; times are whole multiples of 2^-36, so that sums are exact.
_DRAW, _TICK = 4096, float(1 << 36)

_U = np.uint64
_M1, _M2, _GOLD = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)
_BASE = _U(0xD6E8FEB86659FD93)  # odd: it has an inverse modulo 2^64
_powers = {"n": 0}


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixing generator."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _M1
        x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)


def _power_table(n: int):
    """Powers of the base and of its inverse, up to n."""
    if _powers["n"] < n:
        size = 1 << max(16, n.bit_length())
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        up, down = np.full(size, _BASE), np.full(size, inverse)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            _powers.update(n=size, up=np.cumprod(up, dtype=np.uint64), down=np.cumprod(down, dtype=np.uint64))
    return _powers["up"], _powers["down"]


def word_hashes(folded: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a folded text."""
    b = np.frombuffer(b" " + folded + b" ", dtype=np.uint8)
    word = b != 32
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    up, down = _power_table(len(b))
    with np.errstate(over="ignore"):
        sums = np.cumsum(_BYTE[b] * up[:len(b)], dtype=np.uint64)
        return _mix((sums[end - 1] - sums[start - 1]) * down[start] + (end - start).astype(np.uint64))


def shingles(raw: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of all shingles of a text, with repeats."""
    h = np.concatenate([word_hashes(p) for p in folded_pieces(raw)] or [np.empty(0, np.uint64)])
    n = min(SHINGLE, len(h))
    if not n:
        return h
    s = np.zeros(len(h) - n + 1, dtype=np.uint64)
    for k in range(n):
        with np.errstate(over="ignore"):
            s = _mix(s * _GOLD + h[k:len(h) - n + 1 + k])
    s.sort()
    return s


def units(s: np.ndarray) -> np.ndarray:
    """One hash for each (shingle, occurrence): the overlap of two multisets is that of these sets."""
    if not len(s):
        return s
    first = np.r_[True, s[1:] != s[:-1]]
    if first.all():
        return s
    at = np.flatnonzero(first)
    nth = np.arange(len(s)) - np.repeat(at, np.diff(np.r_[at, len(s)]))
    with np.errstate(over="ignore"):
        return np.where(nth > 0, _mix(s + nth.astype(np.uint64) * _GOLD), s)


def _processes(s: np.ndarray):
    """Poisson processes of a multiset: key, first cell, cells, weight."""
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    keys, weights = s[first], np.diff(np.r_[first, len(s)])
    out, low = [], 0
    while len(keys):
        cells = max(1, low)
        with np.errstate(over="ignore"):
            out.append((_mix(keys ^ _U(low + 1) * _M2), np.full(len(keys), low), np.full(len(keys), cells), weights))
        low += cells
        more = weights > low
        keys, weights = keys[more], weights[more]
    return (np.concatenate(x) for x in zip(*out))


def signature(s: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Earliest point of each register, in ticks."""
    never = np.iinfo(np.int64).max
    sig = np.full(registers, never, dtype=np.int64)
    if not len(s):
        return sig
    key, low, cells, weight = _processes(s)
    time = np.zeros(len(key), dtype=np.int64)
    drawn = np.zeros(len(key), dtype=np.uint64)
    limit = registers * (np.log(registers) + 4) / len(s) * _TICK
    while True:
        active = np.flatnonzero(time <= limit)
        while len(active):
            n = max(1, _DRAW // len(active))
            with np.errstate(over="ignore"):
                bits = _mix(key[active, None] + (drawn[active, None] + np.arange(1, n + 1, dtype=np.uint64)) * _GOLD)
                more = _mix(bits ^ _M1)
            gap = -np.log(((bits >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
            at = time[active, None] + np.cumsum((gap * (_TICK / cells[active, None])).astype(np.int64), axis=1)
            cell = low[active, None] + ((more >> _U(8)) % cells[active, None].astype(np.uint64)).astype(np.int64)
            # points beyond the limit are real as well, but kept only up to it so that none is drawn twice
            ok = (at <= limit) & (cell < weight[active, None])
            np.minimum.at(sig, (more[ok] % _U(registers)).astype(np.int64), at[ok])
            # go on from the last point within the limit
            inside = (at <= limit).sum(axis=1)
            done = inside < n
            time[active] = np.where(inside > 0, np.take_along_axis(at, np.maximum(inside - 1, 0)[:, None], axis=1)[:, 0], time[active])
            drawn[active] += inside.astype(np.uint64)
            active = active[~done]
        if sig.max() < never:
            return sig
        limit *= 2


def band_hashes(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = sig.reshape(bands, -1).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        with np.errstate(over="ignore"):
            h = _mix(h * _GOLD + rows[:, k])
    return h.astype(np.int64)


def _sign(batches):
    for batch in batches:
        first, second, n, bands = [], [], [], []
        for raw in texts_of(batch.column("text")):
            s = shingles(raw or b"")
            digest = hashlib.blake2b(digest_size=16)
            for piece in folded_pieces(raw or b"") if len(s) else ():
                digest.update(b" ".join(piece.split()) + b" ")
            d = np.frombuffer(digest.digest(), dtype=np.int64)
            first.append(int(d[0]))
            second.append(int(d[1]))
            n.append(len(s))
            bands.append(band_hashes(signature(s)) if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("th"), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
             pa.array(n, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "th", "d1", "d2", "n", "bands"])


def _unit_arrays(batches):
    for batch in batches:
        found = [units(shingles(raw or b"")).astype(np.int64) for raw in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], names=["node", "units"])


def signed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, th, d1, d2, n, bands) of every document, written once. th: hash of the exact text."""
    d = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
    rest = T.StructType.fromDDL("th long, d1 long, d2 long, n long, bands array<long>").fields
    x = d.mapInArrow(_sign, T.StructType([d.schema["doc_id"], *rest]))
    return materialize(x.withColumn(ROW, F.monotonically_increasing_id()), "near_signed")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the least node of the component of each node of the undirected ``edges`` (a, b)."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .distinct(), "near_edges")
    label = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                        .select("node", F.least("node", "b").alias("comp")), "near_labels")
    while True:
        of = label.select(F.col("node").alias("b"), F.col("comp"))
        near = fresh_join(both, of, ["b"]).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = label.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = label.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new = materialize(fresh_join(step, jump, ["comp"], "left").select(
            "node", "old", F.least("comp", F.coalesce("far", "comp")).alias("comp")), "near_labels")
        discard(label)
        label = new.select("node", "comp")
        if not new.filter("comp < old").take(1):
            discard(both)
            return label


def _overlaps(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(m, x, nm, nx, apart, linked) of pairs (m, x): sizes, the units that only one of them has, and whether their
    overlap reaches the threshold. Written once."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("units").alias(f"u{c}"))
    x = fresh_join(fresh_join(pairs, side("x"), ["x"]), side("m"), ["m"])
    x = x.select("m", "x", F.size("um").alias("nm"), F.size("ux").alias("nx"),
                 F.concat(F.array_except("ux", "um"), F.array_except("um", "ux")).alias("apart"))
    both = F.col("nm") + F.col("nx")  # overlap (both - d) / 2, union (both + d) / 2
    linked = both - F.size("apart") >= threshold * (both + F.size("apart"))
    return materialize(x.withColumn("linked", linked), "near_overlaps")


def _stars(groups: DataFrame) -> DataFrame:
    """(m, x): each node of a group with the group's best connected node m."""
    centre = (groups.groupBy("g").agg(F.max(F.struct("degree", "node")).alias("best"))
              .select("g", F.col("best.node").alias("m")))
    return fresh_join(groups, centre, ["g"]).filter("m != node").select("m", F.col("node").alias("x")).distinct()


def _open(tested: DataFrame, comp: DataFrame, threshold: float) -> tuple[DataFrame, list[DataFrame]]:
    """((m, x): pairs of nodes of one star that may still be linked, given the stars tested and the components so far;
    written tables that the pairs are read from).

    Let D be the units that only one of x and the star's centre m has. x and y have |Dx| + |Dy| - 2 |Dx and Dy|
    units apart, and a link allows them r (nx + ny) with r = (1 - threshold) / (1 + threshold), so Dx and Dy must
    have f(x) + f(y) units in common, f = (|D| - r n) / 2. Units of D that no other node of the star has cannot be in common:
    with c others, |Dx and Dy| <= min(cx, cy), and so f(y) <= g(x) and f(x) <= g(y) with g = c - f. Copies edited
    each in its own way fail here. Two linked nodes need no test of their own, so one of a pair is not linked to m.

    The pairs are found by an equi-join on cells of f: the larger f of a pair lies in the other's [f, g].
    """
    r = (1 - threshold) / (1 + threshold)
    t = tested.join(comp.select(F.col("node").alias("x"), "comp"), "x", "left").withColumn("comp", F.coalesce("comp", "x"))
    bounds = [F.min("linked").alias("all"), F.min("comp").alias("lo"), F.max("comp").alias("hi")]
    some = t.groupBy("m").agg(*bounds).filter("not all and lo < hi").select("m")
    t = stars = materialize(fresh_join(t, some, ["m"]), "near_stars")
    own = (t.select("m", "x", F.explode("apart").alias("unit")).groupBy("m", "unit")
           .agg(F.count(F.lit(1)).alias("k"), F.min("x").alias("x")).filter("k = 1")
           .groupBy("m", "x").agg(F.count(F.lit(1)).alias("p")))
    d = F.size("apart")
    t = t.select("m", "x", "nm", "nx", "comp", "linked", d.alias("d"), ((d - r * F.col("nx")) / 2 - 1e-6).alias("f"))
    t = t.join(own, ["m", "x"], "left").withColumn("g", F.col("d") - F.coalesce("p", F.lit(0)) - F.col("f")).drop("d", "p")
    t = bounded = materialize(t, "near_bounds")
    free = t.filter("not linked").groupBy("m").agg(F.min("f").alias("free"))
    t = fresh_join(t, free, ["m"])
    cell = lambda v: F.floor(v * CELLS / F.col("nm"))
    points = t.filter("not linked or f >= free").select(
        "m", cell(F.col("f")).alias("cell"), *(F.col(c).alias(f"{c}2") for c in ("x", "nx", "comp", "linked", "f", "g")))
    low = F.greatest("f", "free")
    spans = t.filter(F.col("g") >= low).select(
        "m", F.explode(F.sequence(cell(low), cell(F.col("g")))).alias("cell"), "x", "nx", "comp", "linked", "f", "g")
    both = fresh_join(spans, points, ["m", "cell"]).filter("comp != comp2 and f <= f2 and f2 <= g and f <= g2 and not (linked and linked2)")
    both = both.filter(F.least("nx", "nx2") >= threshold * F.greatest("nx", "nx2"))
    return both.select(F.least("x", "x2").alias("m"), F.greatest("x", "x2").alias("x")).distinct(), [stars, bounded]


def links_of(banded: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(node, comp) of all nodes with a link. ``banded``: (g, node, degree); sets: (node, units)."""
    ends = lambda tested: tested.filter("linked").select(F.col("m").alias("a"), F.col("x").alias("b"))
    stars = _overlaps(_stars(banded), sets, threshold)
    comp = components(ends(stars))
    pairs, written = _open(stars, comp, threshold)
    rest = _overlaps(pairs, sets, threshold)
    if rest.filter("linked").take(1):
        written.append(comp)
        comp = components(ends(stars).unionByName(ends(rest)))
    discard(stars, rest, *written)
    return comp


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(row, doc_id, th, n, comp): ``comp`` is the same for the documents of a class. Written once."""
    sig = signed(docs)
    worded = sig.filter("n > 0")
    first = worded.groupBy("d1", "d2").agg(F.min(ROW).alias("node"))
    reps = worded.join(first.select(F.col("node").alias(ROW)), ROW, "left_semi")
    banded = reps.select(F.col(ROW).alias("node"), "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    banded = fresh_join(banded, shared, ["band"])
    degree = banded.groupBy("node").agg(F.sum("k").alias("degree"))
    banded = materialize(banded.select("node", F.col("band").alias("g")).join(degree, "node"), "near_buckets")
    # whole texts of the nodes that have a candidate
    wanted = reps.select(F.col(ROW).alias("node"), "doc_id", "th").join(
        banded.select("node").distinct(), "node", "left_semi")
    texts = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), "text")
    found = texts.join(wanted, (texts["th"] == wanted["th"]) & texts["id"].eqNullSafe(wanted["doc_id"]))
    sets = found.select("node", "text").mapInArrow(_unit_arrays, "node long, units array<long>")
    sets = materialize(sets.dropDuplicates(["node"]), "near_sets")  # a row may occur several times
    comp = links_of(banded, sets, threshold)
    node = fresh_join(worded.select(ROW, "doc_id", "th", "n", "d1", "d2"), first, ["d1", "d2"])
    node = node.join(comp, "node", "left").select(ROW, "doc_id", "th", "n", F.coalesce("comp", "node").alias("comp"))
    alone = sig.filter("n = 0").select(ROW, "doc_id", "th", "n", F.col(ROW).alias("comp"))
    found = materialize(node.unionByName(alone), "near_classes")
    discard(sig, banded, sets, comp)
    return found


def labelled(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, class_size, n_shingles) of every document."""
    x = classes(docs, threshold)
    of = x.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return fresh_join(x, of, ["comp"]).select("doc_id", "class_id", "class_size", F.col("n").alias("n_shingles"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class: the one with the least doc_id (null last)."""
    x = classes(docs, threshold)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", ROW)).alias("best")
    stay = x.groupBy("comp").agg(best).select(F.col("best.doc_id").alias("__hw_id"), F.col("best.th").alias("__hw_th"), "comp")
    d = docs.withColumn("__hw_text", F.xxhash64("text"))
    # the same row may occur several times: as one class it stays once, as several (no words) each stays
    copies = stay.groupBy("__hw_id", "__hw_th").agg(F.count(F.lit(1)).alias("__hw_stay"))
    kept = d.join(copies, (F.col("__hw_text") == F.col("__hw_th")) & F.col("doc_id").eqNullSafe(F.col("__hw_id")))
    many = x.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").limit(1).count()
    if many:
        nth = F.row_number().over(W.partitionBy("__hw_text", "__hw_id").orderBy(F.lit(1)))
        kept = kept.withColumn("__hw_nth", nth).filter("__hw_nth <= __hw_stay").drop("__hw_nth")
    return kept.drop("__hw_text", "__hw_id", "__hw_th", "__hw_stay")
