"""Exact top-k inner products by a three-phase uniform threshold.

A vector's components are cut into ``lists`` blocks; the inner product with a query is the sum of the
blocks' partial scores, each block being one list of (candidate, partial score). Queries and candidates are
dealt into bounded blocks, and each (query block, candidate block) cell works alone on its part of the lists:

1. Gather: every cell takes the candidates with its ``k`` best local scores of each list, completes only these, and
   gives the ``k`` best of them. The k-th largest total that any cell has given is a lower bound of the k-th best.
2. Cutoff: that bound divided by the number of lists goes back to every cell. A candidate that is under the cutoff
   in every list totals less than the bound and is out; the cells collect all others.
3. Resolve: only collected entries are summed over the lists; those that reach the bound are ranked, and each cell's best
   ``k`` go into the final ranking.

Ties at the bound stay in, so the result is exact, ties to the smaller vec_id. A component x becomes floor(scale * x), taken as a
double. Partial scores are exact: products are summed as single floats while they stay below 2^24, as doubles below 2^53, in limbs
of 16 bits below 2^63, and as Python integers beyond. A score among the best that does not fit a long is an error.

Cells hold at most ``QUERY_BLOCK`` queries and ``CELL_VALUES`` components of candidates (``CANDIDATE_BLOCK`` vectors), and are worked on in
strips of ``STRIP`` queries, so a task's memory does not depend on the dimension; vectors are replicated once per block
of the other side. Defined cases: vectors that are null, empty or hold null or non-finite components take no part; vectors
of different lengths do not meet: a query ranks the candidates of its own length; rows that repeat are separate candidates (a query
leaves out its own row only); fewer than k candidates give them all; a null vec_id is a candidate, after all others of its
score, and no query; an empty table gives an empty result; only vec_id and embedding are read, whatever other columns are named.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from hourwise.llm.common import ROW, travels
from hourwise.session import discard, materialize

travels(__name__)

LISTS = 4
QUERY_BLOCK, CANDIDATE_BLOCK, CELL_VALUES, STRIP = 2048, 8192, 1 << 21, 256
LIMB = 16


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """(row, vec_id, v, dim) with integral components, written once."""
    x = F.col("embedding")
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    whole = F.transform(x, lambda c: _floor(F.lit(float(scale)) * c.cast("double")))
    v = vectors.filter(fine).select(F.monotonically_increasing_id().alias(ROW), "vec_id", whole.alias("v"), F.size(x).alias("dim"))
    return materialize(v, "topk_vectors")


def _floor(c):
    """floor() of a double as a double; the SQL function would cut what does not fit a long."""
    return F.when(F.abs(c) < float(1 << 53), F.floor(c).cast("double")).otherwise(c)


def _cells(v: DataFrame, queries: DataFrame):
    """Queries and candidates with their cell (dim, qb, cb): each side once per block of the other."""
    room = F.greatest(F.lit(1), F.least(F.lit(CANDIDATE_BLOCK), F.floor(F.lit(CELL_VALUES) / F.col("dim"))))
    sizes = v.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).join(queries.groupBy("dim").agg(F.count(F.lit(1)).alias("q")), "dim")
    sizes = sizes.select("dim", F.ceil(F.col("q") / QUERY_BLOCK).cast("int").alias("qbs"), F.ceil(F.col("n") / room).cast("int").alias("cbs"))
    block = lambda c, m: F.pmod(F.xxhash64(c), F.col(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    left = queries.join(sizes, "dim").select(F.col("dim").alias("q_dim"), "query", "query_id", "qv", block("query", "qbs").alias("q_qb"),
                                             every("cbs").alias("q_cb"))
    right = (v.select("dim", F.col(ROW).alias("cand"), "vec_id", "v").join(sizes, "dim")
             .withColumn("cb", block("cand", "cbs")).withColumn("qb", every("qbs")).drop("qbs", "cbs"))
    return left, right


def _limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Parts of integral values in steps of LIMB bits, the last one signed."""
    out, x = [], x.astype(np.int64)
    for _ in range(max(1, -(-bits // LIMB)) - 1):
        out.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x = x >> LIMB
    return [*out, x.astype(np.float64)]


def partials(q: np.ndarray, c: np.ndarray, lists: int):
    """Exact partial scores of each list, (queries, candidates); float, int64 or object arrays."""
    big = [int(np.abs(x).max()) if x.size else 0 for x in (q, c)]
    bound = big[0] * big[1] * q.shape[1]
    cuts = [cut for cut in np.array_split(np.arange(q.shape[1]), lists) if len(cut)]
    if bound < 1 << 53:
        kind = np.float32 if bound < 1 << 24 else np.float64
        q, c = q.astype(kind), c.astype(kind)
        return [q[:, cut] @ c[:, cut].T for cut in cuts]
    if bound < 1 << 63 and max(big) < 1 << 62:
        qs, cs = _limbs(q, big[0].bit_length() + 1), _limbs(c, big[1].bit_length() + 1)
        out = []
        for cut in cuts:
            total = np.zeros((len(q), len(c)), dtype=np.int64)
            for i, a in enumerate(qs):
                for j, b in enumerate(cs):
                    if (shift := LIMB * (i + j)) < 64:
                        total += (a[:, cut] @ b[:, cut].T).astype(np.int64) << shift  # whole modulo 2^64, as the sum is
            out.append(total)
        return out
    whole = lambda x: np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)
    q, c = whole(q), whole(c)
    return [q[:, cut] @ c[:, cut].T for cut in cuts]


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _strips(left: pd.DataFrame, right: pd.DataFrame, lists: int):
    """(rows of left, partial scores) of strips of queries; a query's own row is marked apart."""
    c = _matrix(right["v"])
    for at in range(0, len(left), STRIP):
        part = left.iloc[at:at + STRIP]
        parts = partials(_matrix(part["qv"]), c, lists)
        yield part, parts, part["query"].to_numpy()[:, None] == right["cand"].to_numpy()[None, :]


def _picked(parts: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Totals of some entries, exact: the lists are summed for these only."""
    if parts[0].dtype == object:
        return sum(p[i, j] for p in parts)
    return sum(p[i, j].astype(np.int64) for p in parts)


def _best(k: int, i: np.ndarray, total: np.ndarray, *ties) -> np.ndarray:
    """Places of the k largest totals of each i, in order; earlier ``ties`` decide."""
    order = np.lexsort((*ties[::-1], -total, i))
    own = i[order]
    begin = np.r_[0, np.flatnonzero(np.diff(own)) + 1] if len(own) else np.empty(0, int)
    rank = np.arange(len(own)) - np.repeat(begin, np.diff(np.r_[begin, len(own)]))
    return order[rank < k]


def _gather(k: int, lists: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query": np.empty(0, np.int64), "total": np.empty(0, np.int64)})]
        for part, parts, own in _strips(left, right, lists) if len(left) and len(right) else ():
            if parts[0].dtype == object:
                continue  # no bound from sums beyond a long; they are resolved all the same
            m = min(k + 1, len(right))  # the query's own row may be among them
            found = np.zeros(own.shape, dtype=bool)
            for p in parts:
                np.put_along_axis(found, np.argpartition(p, -m, axis=1)[:, -m:], True, axis=1)
            i, j = np.nonzero(found & ~own)
            total = _picked(parts, i, j)
            best = _best(k, i, total)
            out.append(pd.DataFrame({"query": part["query"].to_numpy()[i[best]], "total": total[best]}))
        return pd.concat(out)
    return run


def _resolve(k: int, lists: int):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "query", "vec_id", "score"]
        out = [pd.DataFrame(columns=columns)]
        if not len(left) or not len(right):
            return out[0]
        # smaller ids first (null last), so that the place decides ties
        right = right.sort_values(["vec_id", "cand"], na_position="last")
        ids = right["vec_id"].astype("Int64").to_numpy(dtype=object, na_value=None)
        for part, parts, own in _strips(left, right, lists):
            known = part["bound"].notna().to_numpy()
            bound = part["bound"].fillna(0).to_numpy(dtype=np.int64)
            cutoff = -(-bound // len(parts))
            collected = np.repeat(~known[:, None], len(right), axis=1)
            for p in parts:
                collected |= p >= cutoff[:, None]
            i, j = np.nonzero(collected & ~own)
            total = _picked(parts, i, j)
            reach = ~known[i] | (total >= bound[i])
            i, j, total = i[reach], j[reach], total[reach]
            if total.dtype == object:
                best = np.array(sorted(range(len(i)), key=lambda x: (i[x], -total[x], j[x])), dtype=int)
                best = best[[a for a, x in enumerate(best) if a < k or i[best[a - k]] != i[x]]] if len(best) else best
                if any(abs(total[x]) >= 1 << 63 for x in best):
                    raise OverflowError("a score among the best does not fit a long")
            else:
                best = _best(k, i, total, j)
            out.append(pd.DataFrame({"query_id": part["query_id"].to_numpy()[i[best]], "query": part["query"].to_numpy()[i[best]],
                                     "vec_id": ids[j[best]], "score": total[best].astype(np.int64)}, columns=columns))
        return pd.concat([x for x in out if len(x)] or out[:1])
    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256, lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each row of ``vectors`` (vec_id,
    embedding) whose vec_id is divisible by ``every``."""
    v = usable(vectors, scale)
    queries = v.filter(F.col("vec_id") % every == 0).select(
        "dim", F.col(ROW).alias("query"), F.col("vec_id").alias("query_id"), F.col("v").alias("qv"))
    left, right = _cells(v, queries)
    meet = lambda x: x.groupBy("q_dim", "q_qb", "q_cb").cogroup(right.groupBy("dim", "qb", "cb"))
    gathered = materialize(meet(left).applyInPandas(_gather(k, lists), "query long, total long"), "topk_gathered")
    # phase 1: the k-th best total of the candidates that any cell gave; with fewer there is no bound, and all are collected
    nth = F.row_number().over(W.partitionBy("query").orderBy(F.desc("total")))
    bound = gathered.withColumn("nth", nth).filter(F.col("nth") <= k).filter(F.col("nth") == k).select("query", F.col("total").alias("bound"))
    found = meet(left.join(bound, "query", "left")).applyInPandas(
        _resolve(k, lists), "query_id long, query long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last()))
    out = materialize(found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "topk")
    discard(v, gathered)
    return out
